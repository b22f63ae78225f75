"""Licence scans: entire texts against known licence digests.

A text is brought to a canonical form, in which case, punctuation, white space, copyright
lines and equivalent spellings make no difference, and its SHA-256 digest is joined with the
digests of known licences. A document matches when its entire text is one of the known forms
of a licence: with or without its title lines and, where it has one, its appendix. The README
lists the licences; other licences and wordings are not known.

Only DataFrame functions are used. Each text is folded inside its row; the join is on
digests, and the built-in table of known digests has a fixed number of rows.

Defined results: null, empty and blank texts, and texts of nothing but copyright lines, have
an empty canonical form and match nothing; repeated rows give repeated results; an empty
table gives no rows; columns of the input stay, clashing ones are replaced.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lines that name a holder, and phrases that carry no terms.
COPYRIGHT_LINE = (
    r"(^|\n)[^a-z0-9\n©]*(copyright[ \t]*(\([c]\)|©|[0-9<\[{])|\([c]\)[ \t]*[0-9<\[{]|©)[^\n]*"
)
RESERVED = r"all rights reserved\.?"
NO_WORD = r"[^\p{L}\p{N}]+"
#: Spellings that count as equal, applied to every text in this order.
SPELLINGS = (
    ("https", "http"),
    ("z", "s"),
    ("licence", "license"),
    ("practice", "practise"),
    ("offence", "offense"),
    ("defence", "defense"),
    ("our", "or"),
    ("ll", "l"),
    ("ogue", "og"),
    ("centre", "center"),
    ("calibre", "caliber"),
    ("dgement", "dgment"),
    ("programme", "program"),
    ("artefact", "artifact"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"),
)

# Digests of the canonical forms of published licence texts, without and with
# their titles and appendices.
KNOWN = {
    "3ea7ea59c93b8fbb74acce7aae74fbe5c7d5a44ad0cb7d51d79c0d6907b69645": "MIT",
    "cb1cde23d0e34427eeff41b1efa4701cfe0cc4e83e1c41c5392165f9d13b57a0": "MIT",
    "2c078669d96f3da0206651ef0f79be495afbade4ab334136e326c4abc2dfc756": "MIT",
    "029664b9b70eecdf8fe94d67c519e23d367743fa88f3b0e9b39096a2395b0cbe": "MIT",
    "e66928e6b83a9dfd0b809e7d27e4c0ee5404de20c642093f0af4e8f64fe49a39": "ISC",
    "e6cddd210605427899553430f48266f2cef2d267814d4cae9636348f8c30c3cc": "ISC",
    "f2832ce86096c3fd89d7208c117d762ee6982c97044de24be72f52a62562a7de": "ISC",
    "88e761eba5917e3f6544ed4fec73e52378662333bb9a547acb67992af2de9c22": "BSD-2-Clause",
    "cfb6275c5ec47bf2972daece6bfcc66a4b014abcb4525140f9c05d5a83fb562d": "BSD-2-Clause",
    "d9225716724600d2c8b134a8034ad9220673a9a25ed56c599347748a72ce3710": "BSD-2-Clause",
    "50f8499004f2ab58269757f41422a1b2c32090a21b65749ab87b09edc5f87f5b": "BSD-3-Clause",
    "ce3fb14eb0ae5706320b6f0e5cfe354ceeb4bd9319b81216ddbfdf818315228e": "BSD-3-Clause",
    "6a38478072e5fecb1992a9734b74284735a90b910bc9a0386213c2ccad058eb4": "BSD-3-Clause",
    "088bea804b2cb12a9fd4f322c838225fe1ff8c3ec8bc877698faacd91e65618e": "Unlicense",
    "05907c5ab01193a324655962eb7529418df3fc76906c89f48bdd34044f42c2d9": "Unlicense",
    "8164346c55e4a78b8415bbeef123958897e6bc4f51c593d70b8d9ab9d32138ca": "Apache-2.0",
    "f800840f628835aeccd00b19d7e22e872cde3023559b8eb538edd1a99ec3c448": "GPL-2.0",
    "bcc9f4569f49b33ce13317035d45f7fb83ccdd60df5e1d319aaaa74c195840b3": "GPL-3.0",
    "ac5c2ed78cc5a219f04a75b91c98c6559a423f2b49a4aef53fe4067a1d0be449": "LGPL-2.1",
    "198f9dbe2ed184b5324d1102ff67b5b694f7fe9d0139a7b1ecde55c7006176ce": "LGPL-3.0",
    "cfeadb18ef657ef5521755a8df1d15e0f646a5d530b69a4975b400edc8d1bc02": "MPL-2.0",
    "7be9c0184fee40748f7ecac9dc9aaf645d39e6f175af67a485f225c0c736c7df": "CC0-1.0",
    "300aa588b2603bcc8e4f396e3809f7ae55e73b801b30e383a53f1d7a80a6087d": "Apache-2.0",
    "39e99f8e2229bc2d5c34848344bd9d73098e414127c8e640ae07966de8d86e1a": "Apache-2.0",
    "3a8c660113ef18f1574293a5ef989f7a50fbd20bf12ea8da5e92d3dd8558b0c4": "Apache-2.0",
    "5454c141b33623948b546e23fc24c2a218fb1a106e4c1d8b68c19519a81dcd41": "Apache-2.0",
    "5ce7ba2c6e947add48428cf6c6c6693145b693e9c09102eb7f52e3fdaaaf6a1e": "Apache-2.0",
    "685a0becc50abb3754a399cd2840330ab08fa199b216c038a5b9260f6252c4bd": "Apache-2.0",
    "92a479c82b45ef30cd982d308c257c997645a12e27422afc91c5e18dddf2dce4": "Apache-2.0",
    "e16dc780a707b2117303a94f49897167e21004ccfe6d20605b6e883e1fae14df": "Apache-2.0",
    "e25626b7cb4f03f642699550c7a09f3eb0406dbdb271e78f6ba8531c0ec6fe26": "Apache-2.0",
    "e8dda59866e43a2db42cc29c1660aad1d0adad1b585c4043375daf6de8bd12d9": "Apache-2.0",
    "e933ca061fca161db381fac8db41ba8010daafdde444a98b7cd80a4dfec0733a": "Apache-2.0",
    "25b4db1f04d122a3c1cea4521c2b61b0c665609edd605e718768519f0734edad": "GPL-1.0",
    "592b8d9b775bfb37c76b15b011761d11211992567820848afd74d42b2dffcd3f": "GPL-1.0",
    "60803fe3f5cc8cdd85328d5bbf79c6f342c476cdea9ceef9a4681a95ae4ac64d": "GPL-1.0",
    "649a84150054657d7459fe5b0613264be7e4efacd6685c237d639c54b1f72e6e": "GPL-1.0",
    "bbeaecad30c7df89aed3157aaed2b27f0d5060677870085d94582def55a455e4": "GPL-1.0",
    "c0f2024731e3bce4ce68b31c3cfc67acb6b7252564edc3eedc5a0f49d55f0c77": "GPL-1.0",
    "d3b4f7da2628dfd866a3005ad4f5fbd1d082c10d6b5fafdd8f7fdd55a03104c7": "GPL-1.0",
    "e4e7752676e5bf8b8a780fcc32c72b55ced9502801801706e3ce5a43a670c469": "GPL-1.0",
    "ff923f75166f93a5d806e13a54e6809aedd1be4ac030f3a3de48d6e124b382ff": "GPL-1.0",
    "34861a8d6d96cbb4bf4ab78d5fa6cea4dab19107cd24a426b753ef8231cc8d4a": "GPL-2.0",
    "34e595c975c1272a2f3ef950790eb7d82aa57b97af8c3a1b8b00cdd473358573": "GPL-2.0",
    "3e7c5bc6f518d6f99ed27c422ebb1fdea96f55ed89933779cbb66dd63a9893a2": "GPL-2.0",
    "44cd601df4797a88f9f16d9a079862af41ccd1df5357687892b40bf1ed1755c2": "GPL-2.0",
    "54d479302ab84dcd318e8c32e6b66faa56e7fe93d245593f44b03378a748dd53": "GPL-2.0",
    "6c69b08bf229dfe6c7ca64e842876afe40ac5b7f1cc7519fc2e8d404e73449b9": "GPL-2.0",
    "71294d54e29270cc16a04c75e9f0054e15c30c7580e13d493e676227efede85f": "GPL-2.0",
    "e6e514c99d1a18589f1ecad77a993285ae394c9029a4ce1ab501bb1a91d0b1a8": "GPL-2.0",
    "1b749e89ad12ff992924c3be6170086460a5ceeb97c92dc6c758010a4f5b8d68": "GPL-3.0",
    "72ef82a79c2cbbe1f0f20adca3bf4abb8da7b677b3bd767387a436fc2cad69d6": "GPL-3.0",
    "74dfc35045c52bd6d48bad5f95d29391ba154388a494cd738a944113edb5d445": "GPL-3.0",
    "86cdeaf07178ed67803db43e61ee5b5b00b90dec86ac9831940ec062c875e340": "GPL-3.0",
    "ade906874531dfbec8204081e88701f178e15b6668c1363401b50eb5995916f6": "GPL-3.0",
    "bece248340f769737337ec6d65a548c4a7e21850b63ad791b32ea3ea06528d17": "GPL-3.0",
    "c8328318678438951327120b279c1d45e0e160a430acc411600802095304a3e5": "GPL-3.0",
    "eadad7d19628a898d78c6d2766f8777df2e7784214576256f1aecef31e2d52ad": "GPL-3.0",
    "15240c36f7caeb22ce7602ca86378bfd85c166fd0ef35cc943a7c8385df99494": "LGPL-2.0",
    "1732a15e0dc245e5408629d4931f838e3371c60aa992985e2a1780687258cf58": "LGPL-2.0",
    "20e501a597e2426d4d0d01ad87e53ec884363e0ed19fec5c6c165b8af31d23ed": "LGPL-2.0",
    "2eee626c86177ce6f3f05404056391f1482f4380b5ae181fb5aa0c33a9751e31": "LGPL-2.0",
    "394768f118b6d7469d579a1345263811f774cd85dcd7aea466207004b37da50b": "LGPL-2.0",
    "743027cffd8dc74c9b49272d56185e5bc5f3d1eb430c15a7254f13102a78586a": "LGPL-2.0",
    "7c97e59b894f8180115245c79bd16ce7db589429b04c9ff65f0cb7ca866a0158": "LGPL-2.0",
    "9afd07f4f28bf912cab1293964bf11f1ae1d7764464e58af923344d7a59c4c05": "LGPL-2.0",
    "f1ca2c975660ce2aaa40b2c7563d27109473f12657739ec2ede7dac7f7db749d": "LGPL-2.0",
    "0c2a4797dd63919c13b244ff2608bb9089be269c81a20108e716834337465fb0": "LGPL-2.1",
    "29ca732f81534206e844c9e542290abd6e167bad7e8fda296a81ab1f7fe48565": "LGPL-2.1",
    "2c790f1ec50516b10712f8ddd075dbdc574e03fb5264aed824162f60d6958ab2": "LGPL-2.1",
    "a1c9801621932abdf8391e7b06fdd708d8a2f06745579f97c9b7a131ec816d62": "LGPL-2.1",
    "b65e58a936845485b89150ba2c9de79068709445a4bb2bd927138f3acad20ca3": "LGPL-2.1",
    "c7933f91a5e9fdb405f25c50858565f789ceebb941ae85e1875ffc0fa0a6be82": "LGPL-2.1",
    "d71da3573e4174a1543658f07a4775cd5b1e5e95e952a0f7ac8deb229b07045e": "LGPL-2.1",
    "fef181e155fcff2958479889e10360ad0cd6f9ea0916733a08b3c83d31d469ab": "LGPL-2.1",
    "675ddc79329d0207fa753b236d4bbe593b54171825f47af8a97edcbb4b078370": "LGPL-3.0",
    "b992bc03028fd0bb87e550600666c495bdcae70fa4153ea5512cb1225ca7a414": "LGPL-3.0",
    "0894c0e482fb4ad9a9244d8b42829b2d0172e4c9c1b77d615e18a0aeb7b82a91": "MPL-1.1",
    "416c00e30e1542ce00f991ba78898d7586791f069568a4418d2cf314eb17165c": "MPL-1.1",
    "46e2cce9b06bcee5cec499804c7eb7d69f962b08145fda012cef7fe3f4ed480e": "MPL-1.1",
    "565dc1621e27d6dab386ec9c9aa29f11d73573dc925405afe1abd0c387b08a36": "MPL-1.1",
    "6c0eb3514c6788bc8ff5f5b3a290e668c4febfc32d300c0b1b1c9041be918b46": "MPL-1.1",
    "d91aae747bda3fb68a8ba49996545eb7ee85007edbe3c889a14266cab04c0301": "MPL-1.1",
    "54541bc744178939d6e80740090956046cce2211c7070b72a3ba2ba49c6bef76": "MPL-2.0",
    "7b3b2c39885507b86279f05d8c5cc5e89ef228427168949c2d28b8dc1763ddc3": "MPL-2.0",
    "be7e2e74c530fe5b94db0c7e0104b6705097cdfcb8f4744f34a2aae2b6cce9bf": "MPL-2.0",
    "f7d91cb31b7e8a16d1d04ad0f7d2ed931c6d1e9b122c3224219306dd8ff09819": "CC0-1.0",
    "fb11749ce1572d004e068ac651e493c9bb8b8cba4d8f7e41c47a887130cedaaf": "CC0-1.0",
    "b1071127b2ccf95d5f1a960c273d4bb05d5dc0b6209cf3e0eb20c98f66aae364": "Artistic-1.0-Perl",
    "eb7aca4af571588da93bdcc1bdb3f5ac5bbe4823b0a603ee0c55e0b0ba4084fc": "Artistic-1.0-Perl",
    "09c1d872f298c10d846d84d8ea99f6489986cfed4f1885bcd2de1bb2737dbf25": "GFDL-1.2",
    "1f36f77a35b8b652fa466b68b8397e41252068716789c41b269458855b527fe2": "GFDL-1.2",
    "7af7f39ba9ab32dfd9c37c7b7cfbe93bd59c121bb28155e23a793f8a75ede238": "GFDL-1.2",
    "98ce044f8334426e32dbef5265164fbad70414bd6eb1f79a88ca5ed8c29e2cd0": "GFDL-1.2",
    "a87670257cc8895cd7ce06d6da28e83e06db407d44f11afbcffe8af1af8ef5bb": "GFDL-1.2",
    "db3be4c3d9f958cd2f6cbe9dcce5ada6070eef3502acf4a8f2be4403734a7d50": "GFDL-1.2",
    "0a51b34974b260f0bbe1d18f1f2c00133aa4f15dfdab1f105e25abb940c6386f": "GFDL-1.3",
    "4c65e14455cd7607ff9e013acae43b645426358ba8add7d12c2b3da4359258d9": "GFDL-1.3",
    "617efa65a19640d0ed790960c152f24de9fa44e4dcc805353dd54e07fc40126d": "GFDL-1.3",
    "a0dfbf177a454fbb9749fb5f7548776a49099a68b99adc56d3469fb9e29c6358": "GFDL-1.3",
    "b3594999b79125ed1dcfd94f4917595c7270ac9743da43bdda8f2e055bbb4f6b": "GFDL-1.3",
    "b7ddc6971e7ac50b8cd578925208405875eea122317e0e13cd0c4db234b63d36": "GFDL-1.3",
    "6dbbe47921f6794cef1badbab4a929db29c14d787511bede2023446c328f907c": "BSD-3-Clause",
    "5797f6c7a50b1d20855506ccf0d7a557e5f3c8290132433820fdc88765553b05": "BSL-1.0",
    "79a5d34eb81ecd8cf1f4c7e2805a12852ed1ce32d3c50448ae029e216fdf0a72": "BSL-1.0",
    "28d4cde2dd08115d552200f6678bdfbfa241202d27c71f628cd3ab3a9d1fd9b3": "Zlib",
    "357537c6460dfeb38cb8ec5658893e1a47db7ca0d28fa8e1984faa57080523dc": "Zlib",
    "b8903b3696489c030a26974567a039590a6a5a92bcfa4d25891c16d87947c7c9": "Zlib",
}


def canonical(text: Column) -> Column:
    """The canonical form of a text; an empty string where nothing is left."""
    folded = F.lower(F.coalesce(text, F.lit("")))
    folded = F.regexp_replace(F.regexp_replace(folded, COPYRIGHT_LINE, "\n"), RESERVED, " ")
    folded = F.trim(F.regexp_replace(folded, NO_WORD, " "))
    return functools.reduce(
        lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, folded
    )


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the canonical form; null where that is empty."""
    form = canonical(text)
    return F.sha2(F.when(form != "", form), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """The built-in table (license_digest, license_id)."""
    values = ", ".join(f"('{k}', '{v}')" for k, v in KNOWN.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS known(license_digest, license_id)")


def licenses_of(texts: DataFrame, license_id: str = "license_id", text: str = "text") -> DataFrame:
    """A table of known digests from licence texts; equal ones keep the smallest name."""
    rows = texts.select(digest(F.col(text)).alias("license_digest"), F.col(license_id).alias("license_id"))
    return rows.where("license_digest IS NOT NULL").groupBy("license_digest").agg(
        F.min("license_id").alias("license_id")
    )


def scan_licenses(
    documents: DataFrame, known: DataFrame | None = None, text: str = "text"
) -> DataFrame:
    """Add license_digest, license_id (null if none) and is_license to every document.

    ``known`` (license_digest, license_id) has one row for a digest.
    """
    known = known_licenses(documents.sparkSession) if known is None else known
    added = ("license_digest", "license_id", "is_license")
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in added]
    digested = documents.select(*kept, digest(F.col(f"`{text}`")).alias("license_digest"))
    return digested.join(known, "license_digest", "left").select(
        *kept, "license_digest", "license_id", F.col("license_id").isNotNull().alias("is_license")
    )


def oracle_sql() -> str:
    """The same scan of ``documents`` in SQL."""
    quoted = functools.reduce(
        lambda x, pair: f"replace({x}, '{pair[0]}', '{pair[1]}')",
        SPELLINGS,
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), "
        f"'{COPYRIGHT_LINE}', chr(10), 'g'), '{RESERVED}', ' ', 'g'), '{NO_WORD}', ' ', 'g'))",
    )
    values = ", ".join(f"('{k}', '{v}')" for k, v in KNOWN.items())
    return f"""
        WITH digested AS (
            SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS license_digest
            FROM (SELECT doc_id, {quoted} AS form FROM documents)
        ), known(license_digest, license_id) AS (VALUES {values})
        SELECT doc_id, license_digest, license_id, license_id IS NOT NULL AS is_license
        FROM digested LEFT JOIN known USING (license_digest)
    """
