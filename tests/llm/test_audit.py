"""Manifest, toxicity and divergence against plain versions."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import PROSE, TEXTS

from tempspan.llm import merkle_manifest, source_divergence, toxicity

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """Null values in every column, hot ids, equal rows, long texts, a column that clashes."""
    rows = [(k, t, "en" if i % 2 else None, "s" if i % 3 else None, None) for i, (k, t) in enumerate(TEXTS)]
    rows += [(i, f"Text {i}", "de", "a", 7) for i in range(70)] + [(3, "Same Text", "fr", "b", 9)] * 20
    rows += [(None, None, None, None, None), (12, "Alone", "xx", "b", 5)]
    return rows, spark.createDataFrame(rows, DOCUMENT).withColumn("leaf", F.lit(1)).repartition(5)


# --- Merkle manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def plain_tree(leaves):
    """All levels of a tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_way(levels, i):
    """(left, right) siblings of leaf i on each level."""
    way = []
    for level in levels[:-1]:
        start = i // 8 * 8
        way.append((level[start:i], level[i + 1 : start + 8]))
        i //= 8
    return way


def plain_manifest(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, plain_leaf(*row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, x or ""))
    trees = {x: plain_tree([r[2] for r in sorted(by_lang[x], key=lambda r: r[:3])]) for x in langs}
    top = plain_tree([trees[x][-1][0] for x in langs])
    result = []
    for number, lang in enumerate(langs):
        for i, (*_, leaf, row) in enumerate(sorted(by_lang[lang], key=lambda r: r[:3])):
            way = plain_way(trees[lang], i) + plain_way(top, number)
            text = row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            digest = plain_leaf(row[0], text, *row[2:])
            for left, right in way:
                digest = h(*left, digest, *right)
            proof = h(*(x for left, right in way for x in (*left, *right)))
            root = top[-1][0]
            result.append((row[0], leaf, trees[lang][-1][0], root, proof, digest, digest == root))
    return result


def test_manifest_is_that_of_a_plain_tree(spark):
    rows, frame = odd_documents(spark)
    found = merkle_manifest.audited(frame)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_manifest(rows), key=repr)
    assert found.where("NOT verified").count() > 10 and found.where("verified").count() > 10


def test_manifest_of_several_tiers(spark):
    rows = [(i, f"Row {i}", "en", "s", i) for i in range(9000)]
    rows += [(i, "x", f"lang {i}", "s", 1) for i in range(600)]
    frame = spark.createDataFrame(rows, DOCUMENT)
    found = merkle_manifest.audited(frame).collect()
    assert sorted(map(tuple, found)) == sorted(plain_manifest(rows))


def test_manifest_of_one_row_and_of_none(spark):
    row = (5, "One", "en", "s", 3)
    frame = spark.createDataFrame([row], DOCUMENT)
    found = [tuple(r) for r in merkle_manifest.audited(frame).collect()]
    assert found == plain_manifest([row]) and found[0][4] == h()
    assert merkle_manifest.audited(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 100, 511, 512])
def test_postorder_places_are_those_of_completion(n):
    levels = merkle_manifest.levels_of(n)
    log = merkle_manifest.append_log([h(str(i)) for i in range(n)], levels)
    tree = plain_tree([h(str(i)) for i in range(n)])
    assert len(tree) == levels + 1 and len(log) == sum(map(len, tree))
    for level, nodes in enumerate(tree):
        places = merkle_manifest.postorder(level, np.arange(len(nodes)), n)
        assert [log[p] for p in places] == nodes


# --- source divergence


def plain_divergence(rows, min_documents=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in term.findall(text or "")]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    result = []
    for lang in {x for x, _ in counts}:
        kept = [w for w, n in docs[lang].items() if n >= min_documents]
        sources = [s for x, s in counts if x == lang]
        groups = {s: {w: counts[lang, s][w] for w in kept} for s in sources}
        whole = {w: sum(g[w] for g in groups.values()) for w in kept}

        def shares(of):
            total = sum(of.values()) + len(kept)
            return {w: 1 + 10**9 * (of[w] + 1) // total for w in kept}

        p, q = {s: shares(groups[s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(-f(p[s][w], q[w]), w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (x[0], x[1].encode()))
                items = items if part == "pair" else items[:top]
                result += [(lang, s, part, i, -v, k + 1) for k, (v, i) in enumerate(items)]
    return result


def test_divergence_is_that_of_plain_sums(spark, monkeypatch):
    rows, frame = odd_documents(spark)
    words = ["a", "ab", "éa", "Zebra", "sixteenletters16", "sixteen_letters", "x" * 16, "x" * 17, "é" * 9, "y" * 300]
    for i in range(60):
        text = " ".join(words[(i * k) % len(words)].upper() if k % 2 else words[(i * k) % len(words)] for k in range(i % 9))
        rows.append((i, text, ["en", "de", None][i % 3], f"s{i % 5}", 1))
    rows += [(1, "z" * 100_000, "en", "s1", 1)] * 3
    monkeypatch.setattr(source_divergence, "PAIRS_AT_ONCE", 7)
    frame = spark.createDataFrame(rows, DOCUMENT).withColumn("rank", F.lit("x")).repartition(4)
    found = source_divergence.source_divergence(frame).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, found.collect())) == sorted(plain_divergence(rows))
    assert source_divergence.source_divergence(frame.limit(0)).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 10**13 + 7, 3 * 10**13 + 1, 12345
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    found = row.select(source_divergence.share("n", "total", "terms").cast("long").alias("p")).first().p
    assert found == 1 + 10**9 * (n + 1) // (total + terms)


def test_radix_order_is_stable_and_sorted():
    words = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) << np.uint64(1)
    words[::7] = words[0]
    assert (source_divergence.radix_order([words], 8) == np.argsort(words, kind="stable")).all()
    two = [words & np.uint64(3), words]
    assert (source_divergence.radix_order(two, 16) == np.lexsort([two[1], two[0]])).all()


# --- toxicity


def scored(text, lexicon=None):
    use = toxicity.Grammar(lexicon or {"idiot$": 1.0, "zorg": 1.0})
    return dict(zip(toxicity.OUTCOMES, use.evidence(text) > 0))


@pytest.mark.parametrize("text, expected", [
    ("what an idiot.", "insult"),
    ("you are an IDIOT", "aimed insult"),
    ("you zorgling. fine day", "aimed insult"),
    ("he is not an idiot", "denied insult"),
    ("she said that he was an idiot", "told insult"),
    ('"Go away, idiot! You idiot," and left', "told insult"),
    ('“fine.” You idiot', "aimed insult"),
    ("you idiot said nothing", "aimed insult"),
    ("I will kill you", "threat"),
    ("I will not hurt you", "denied threat"),
    ("she told them he would burn you", "told threat"),
    ("go, and I shall beat them", "threat"),
    ("beat the eggs\nyou", None),
    ("burn the letter", None),
    ("idiotic zor", None),
    ("", None),
])
def test_clauses_come_out_as_the_grammar_says(text, expected):
    assert {k for k, hit in scored(text).items() if hit} == ({expected} if expected else set())


def test_table_is_the_composition_step_by_step():
    table = toxicity.Table()
    machine = toxicity.compose(
        toxicity.Transducer((0,), toxicity._negate),
        toxicity.Transducer((False, False), toxicity._tell),
        toxicity.Transducer((False, False, 0, 0), toxicity._aim),
    )
    random = np.random.default_rng(2)
    for _ in range(200):
        symbols = random.integers(0, 8, random.integers(0, 12)).tolist()
        state = machine.start
        for s in symbols:
            state, _ = machine.step(state, s)
        found = table.run(symbols, quoted=False)
        assert (None if found is None else list(toxicity.OUTCOMES)[found]) == toxicity.outcome(state[2])


def made_up(n):
    """Documents of which every fifth is toxic by stems that no list holds; others quote copies."""
    random = np.random.default_rng(4)
    syllables = [a + b for a in "bdfglmnprst" for b in "aeiou"]
    for i in range(n):
        words = ["".join(random.choice(syllables, 3)) for _ in range(60)]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                words[random.integers(60)] = random.choice(["qualx", "wexy"]) + random.choice(syllables)
        yield i, " ".join(words), toxic


def test_stems_are_learned_and_held_out_documents_are_found(spark):
    rows = list(made_up(1500))
    copies = [(10_000 + i, rows[0][1] + f" w{i}", 1) for i in range(200)]
    frame = spark.createDataFrame(rows + copies, "doc_id long, text string, toxic int").repartition(6)
    documents = frame.withColumn("score", F.lit("clash")).drop("toxic")
    model = toxicity.fit(documents, frame.select("doc_id", "toxic"))
    assert set(model.lexicon) - {w + "$" for w in toxicity.INSULTS} == {"qualx", "wexy"}
    found = toxicity.score_toxicity(documents, frame.select("doc_id", "toxic"))
    right = found.join(frame.select("doc_id", "toxic"), "doc_id").where("held_out AND predicted = toxic")
    assert right.count() == found.where("held_out").count() > 400
    for r in found.select("doc_id", "held_out").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_toxicity_of_odd_rows(spark, edge):
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (5, None), (None, 1), (77, 1), (8, 0), (8, 0)], "doc_id long, toxic int"
    )
    found = toxicity.score_toxicity(edge, labels)
    assert found.count() == len(TEXTS) and found.where("predicted = 1").count() == 0
    assert found.select("score").distinct().count() == 1 and "lang" in found.columns
    none = toxicity.score_toxicity(edge, labels.limit(0))
    assert none.count() == len(TEXTS) and none.where("score IS NULL").count() == 0
    assert toxicity.score_toxicity(edge.limit(0), labels).count() == 0
    insulted = spark.createDataFrame([(1, PROSE + " You pathetic idiot!"), (2, "x " * 50_000 + "you idiot")], "doc_id long, text string")
    assert {r.predicted for r in toxicity.score_toxicity(insulted, labels.limit(0)).collect()} == {1}
