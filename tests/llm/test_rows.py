"""Operators that work inside a row: rules, pages, languages, licences, counts, BPE."""

import html
import os
import re
import unicodedata
import warnings
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import tokenizers
from samples import LONG, PROSE, TEXTS, by_id
from pyspark.sql import functions as F

from tempspan.llm import (
    byte_bpe, html_text, language_id, license_scan, quality_rules, token_counts, token_files,
)

warnings.simplefilter("ignore")
PATTERN = public_tokenizers.PATTERN
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    words = re.findall(WORD, text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if times[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, edge, documents):
    for frame in (edge, documents):
        for r in quality_rules.apply_quality_rules(frame).collect():
            counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert counts == plain_counts(r.text)


def test_quality_verdicts(spark):
    junk = "Home | About | News | Contact us | Log in | Help | Terms | Imprint\n" * 3
    texts = [
        (1, PROSE), (2, junk + "\n".join(f"{w} | {w}s | un{w}" for w in PROSE.split())),
        (3, " ".join(f"{w}!!" for w in PROSE.split())), (4, " ".join(f"{w}%%%" for w in PROSE.split())),
        (5, PROSE + "\nRead more about cookies. Click here."), (6, "Same words here again. " * 40), (7, None),
    ]
    found = by_id(quality_rules.apply_quality_rules(spark.createDataFrame(texts, "doc_id long, text string")))
    assert {k for k, r in found.items() if r.kept} == {1, 5}
    assert found[1].clean_text == PROSE and found[5].clean_text == PROSE
    assert found[6].base_failed and found[7].base_failed and found[7].clean_text == ""


def test_quality_filter_is_planned_quickly(edge):
    assert quality_rules.apply_quality_rules(edge).where("kept").count() == 5


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<div id="main-menu"><a href=a>Home</a> <a href=b>News</a></div><nav><ul><li>x</ul></nav>
<div class="cookie-notice">We use cookies</div><form><p>Your name</p></form>
<div class=content><h2>Caf&eacute; &lt;1&gt;</h2><p>A first   paragraph with<br>many words, and <b>bold</b> ones too.
<p>Short.<script>var x = "</p>";</script><div>And one more block with enough text to count.</div></div>
<div class="sidebar">links</div><div id=comments><p>A very long reader comment that is no article at all</p></div>
<footer>(c)</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Café <1>\n\nA first paragraph with many words, and bold ones too.\n\nShort.\n\n"
        "And one more block with enough text to count."
    )
    assert [html_text.main_text(x) for x in (None, "", "<p>", "only text")] == ["", "", "", "only text"]
    for odd in ("<" * 50_000, "<!--" * 50_000 + "x", "<div>a" * 20_000, "</p>" * 20_000):
        html_text.main_text(odd)


STORY = [f"{w} paragraph, with words enough that nobody would take it for a menu, {PROSE[:89]}" for w in ("First", "Second", "Last")]
BODY = "".join(f"<p>{x}</p>" for x in STORY)
SIDE = "<div class=sidebar><p>About this site and its many friends</p></div><ul class=menu><li><a href=a>Home</a></ul>"


@pytest.mark.parametrize("page", [
    f"<div class='content-sidebar-wrap'><div class=content>{BODY}</div>{SIDE}</div>",
    f"<div class='has-sidebar'><article>{BODY}</article>{SIDE}</div>",
    f"<div class='no-sidebar'><main>{BODY}</main></div>{SIDE}",
    f"<div id=top><div>{BODY}</div>{SIDE}</div>",
    f"<form id=aspnetForm><div>{BODY}</div>{SIDE}</form>",
    f"<div class=with-sidebar><article><p>{STORY[0]}</p></article></div><div id=comments>"
    + f"<article class=comment><p>{PROSE}</p></article>" * 9 + "</div>",
    "".join(f"<div class=elementor-widget><p>{x}</p></div>" for x in STORY),
])
def test_names_of_wrappers_are_no_furniture(page):
    story = STORY[:1] if "comments" in page else STORY
    assert html_text.main_text(f"<html><body>{page}<footer>(c)</footer></body></html>") == "\n\n".join(story)


@pytest.mark.parametrize("n", [1, 40])
@pytest.mark.parametrize("page", [
    "<div class=page><h1>Title</h1><p class=lead>{lead}</p><div class=body>{body}</div></div>",
    "<main><h1>Title</h1><p>{lead}</p><article>{body}</article></main>",
    "<div class=page><div><h1>Title</h1><p>{lead}</p></div><section>{body}</section></div>",
])
def test_nothing_beside_the_longest_part_is_dropped(page, n):
    lead = "A lead of some words that says what the story is about, as leads do."
    html_ = page.format(lead=lead, body=BODY * n)
    side = "<div class=sidebar>links</div><ul class=list><li><a href=a>Home</a><li><a href=b>News</a></ul>"
    found = html_text.main_text(f"<html><body>{side}{html_}<footer>(c)</footer></body></html>")
    assert found == "\n\n".join(["Title", lead, *STORY * n])


def test_pages_against_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = html_text.with_main_text(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", inner.replace("<b>", "").replace("</b>", ""))
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, 3), (1, None, 3)], "page_id long, html string, n_chars int")
    assert [(r.text, r.n_chars) for r in html_text.with_main_text(odd).collect()] == [("", 0)] * 2


def test_languages(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify_languages(documents).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 200 < len(held) < 300
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, edge):
    found = language_id.identify_languages(edge).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        if not re.search("[^\\W\\d_]", r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    none = language_id.identify_languages(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language_id.identify_languages(edge.limit(0)).count() == 0


def test_temperature_is_that_of_least_loss():
    random = np.random.default_rng(1)
    scores = random.normal(size=(4000, 3)) * 2
    p = language_id._softmax(scores)
    labels = np.array([random.choice(3, p=x) for x in p])
    assert abs(language_id.temperature_of(scores * 5, labels) - 5) < 0.5


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def test_licenses(spark, edge):
    variants = [
        MIT, "MIT License\n\nCopyright (c) 2020 Some One\n\n" + MIT, MIT.upper().replace(",", " ,"),
        "The MIT License (MIT)\n© 2001-2003 A\n(c) 1999 B. All rights reserved.\n" + MIT.replace("sublicense", "sub-license"),
        MIT + " And more.", "Released under the MIT License.", None, "", "Copyright 2020 X",
    ]
    rows = spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string")
    found = by_id(license_scan.scan_licenses(rows))
    assert {k for k, r in found.items() if r.license_id == "MIT"} == {0, 1, 2, 3}
    assert all(found[k].license_id is None for k in range(4, 9))
    assert all(found[k].license_digest is None for k in range(6, 9))
    own = license_scan.licenses_of(spark.createDataFrame([("p", PROSE), ("e", "")], "license_id string, text string"))
    scanned = license_scan.scan_licenses(edge.drop("score"), own).collect()
    assert len(scanned) == len(TEXTS) and sum(r.is_license for r in scanned) == 5


LICENSES = {
    "Apache-2.0": ("Apache-2.0", 3), "Artistic": ("Artistic-1.0-Perl", 1), "BSD": ("BSD-3-Clause", 0), "CC0-1.0": ("CC0-1.0", 2),
    "GFDL-1.2": ("GFDL-1.2", 2), "GFDL-1.3": ("GFDL-1.3", 2), "GPL-1": ("GPL-1.0", 2), "GPL-2": ("GPL-2.0", 2),
    "GPL-3": ("GPL-3.0", 2), "LGPL-2": ("LGPL-2.0", 2), "LGPL-2.1": ("LGPL-2.1", 2), "LGPL-3": ("LGPL-3.0", 2),
    "MPL-1.1": ("MPL-1.1", 2), "MPL-2.0": ("MPL-2.0", 1),
}


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="has no licence texts")
def test_licenses_without_title_and_appendix(spark):
    rows = []
    for file, (name, n_title) in LICENSES.items():
        with open(f"/usr/share/common-licenses/{file}") as text:
            lines = text.read().split("\n")
        body = [i for i, line in enumerate(lines) if line.strip()][n_title]
        ends = [i for i, line in enumerate(lines) if re.match(r"\s*END OF TERMS|ADDENDUM: |EXHIBIT A -|Exhibit A - ", line)]
        for first in (0, body):
            rows += [(name, "\n".join(lines[first:last])) for last in (None, *ends)]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "name string, text string")).collect()
    assert len(found) == len(rows) and all(r.license_id == r.name for r in found)


def test_token_counts(spark, edge, documents):
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    for frame in (edge, documents):
        for r in token_counts.with_token_counts(frame, BYTE_BPE, PATTERN).collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
    assert token_counts.with_token_counts(edge.limit(0), BYTE_BPE, PATTERN).count() == 0


@pytest.mark.parametrize("text", ["=" * 3000, "ab" * 500 + " " * 90, "\u0085 \x1c ", "don't  I'LL\n\n x"])
def test_token_counts_of_runs(text):
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    assert token_counts.count_text(text, BYTE_BPE, PATTERN) == len(library.encode(text, add_special_tokens=False).ids)


def test_bpe_ids_and_round_trip(spark, edge, documents):
    encoding = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    for frame in (edge, documents):
        for r in byte_bpe.encode_and_decode(frame, RANKS, PATTERN).collect():
            ids = encoding.encode_ordinary(r.text or "")
            assert np.frombuffer(r.token_ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
            assert r.decoded.decode() == (r.text or "")
    apart = byte_bpe.decode(byte_bpe.encode(edge, RANKS, PATTERN), RANKS, PATTERN)
    assert all(r.decoded.decode() == (r.text or "") for r in apart.collect())
    assert byte_bpe.encode(edge.limit(0), RANKS, PATTERN).count() == 0


def test_bpe_memory_limit_changes_nothing(monkeypatch, texts):
    whole = [t for t in texts.values() if t][:20] + [LONG, "z" * 300]
    expected = byte_bpe.Codec(RANKS, PATTERN).encode(whole)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    monkeypatch.setattr(byte_bpe, "QUERY_SYMBOLS", 100)
    small = byte_bpe.Codec(RANKS, PATTERN)
    assert [small.encode([t])[0] for t in whole] == expected
    assert [small.decode([i])[0].decode() for i in expected] == whole


def test_words_of_every_letter_before_a_comma_have_the_librarys_ids():
    """Every assigned character below the large blocks, before commas, full stops and an s."""
    rule = token_files.WordIds(WORD_BPE)
    codes = [c for c in (*range(0x20, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x10000, 0x13000), *range(0x1D000, 0x1FB00))
             if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    texts = [f"X{chr(c)}, b X{chr(c)}. b {chr(c)}'s" for c in codes]
    texts += ["वह क़लम, और ख़त. फिर", "ড়, ঢ়. য়, কথা", "שׁלום, שׂ. בּ", "e\u0301, e\u0301. a\u0300", "İ, İ. i\u0307, b"]
    plain = rule.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, expected in zip(texts, rule.encode(texts), plain):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text


def test_letters_newer_than_the_libraries_are_none():
    newer = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and regex.match(r"[\p{L}\p{N}]", chr(c))]
    assert len(newer) > 100
    count = tokenizers.Tokenizer.from_file(BYTE_BPE)
    ranks = byte_bpe.read_ranks(RANKS)
    coder = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    for c in newer[::7]:
        text = f"ab{chr(c)}cd 12{chr(c)}3 {chr(c)}{chr(c)}!"
        assert token_counts.count_text(text, BYTE_BPE, public_tokenizers.PATTERN) == len(count.encode(text, add_special_tokens=False).ids)
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == coder.encode_ordinary(text)


def test_sample_of_rows_without_id_keeps_its_bound(spark):
    rows = [(None, f"text number {i} of many", "en") for i in range(5000)] + [(None, "gleich", "de")] * 3000
    rows += [(i, f"autre {i}", "fr") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id._sample(frame, "text", "lang", "doc_id", language_id.Settings(sample_per_language=300))
    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert counts == {"en": 300, "de": 1, "fr": 50}


def test_follow_the_leader_is_that_of_a_plain_loop():
    settings = language_id.Settings(epochs=2)
    random = np.random.default_rng(0)
    rows = [
        (np.sort(random.choice(12, 4, replace=False)), random.random(4), int(random.integers(3))) for _ in range(40)
    ]
    z, n = [[0.0] * 3 for _ in range(12)], [[0.0] * 3 for _ in range(12)]

    def weight(i, k):
        if abs(z[i][k]) <= settings.l1:
            return 0.0
        sign = 1 if z[i][k] > 0 else -1
        return -(z[i][k] - sign * settings.l1) / ((settings.beta + n[i][k] ** 0.5) / settings.alpha + settings.l2)

    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for r in order.permutation(len(rows)):
            at, values, label = rows[r]
            w = {(i, k): weight(i, k) for i in at for k in range(3)}
            scores = [sum(v * w[i, k] for i, v in zip(at, values)) for k in range(3)]
            total = sum(np.exp(s) for s in scores)
            for i, v in zip(at, values):
                for k in range(3):
                    g = v * (np.exp(scores[k]) / total - (k == label))
                    sigma = ((n[i][k] + g * g) ** 0.5 - n[i][k] ** 0.5) / settings.alpha
                    z[i][k] += g - sigma * w[i, k]
                    n[i][k] += g * g
    plain = np.array([[weight(i, k) for k in range(3)] for i in range(12)])
    assert np.allclose(plain, language_id.train_ftrl(rows, 12, 3, settings))


def test_clean_lines_of_any_script_stay(spark):
    clean = [
        "The design in question was older than the house it stood in.", "He opened the catalog in the hall.",
        "One thread more and the coat would be done.", "Her last log increased the pile.",
        "वह नदी पुरानी चक्की के पास से धीरे बहती थी।", "کیا آپ نے وہ کتاب پڑھی ہے؟", "یہ ایک پرانی کہانی ہے۔",
        "هل قرأت الكتاب؟", "แม่น้ำไหลผ่านโรงสีเก่าอย่างช้าๆ", "그는 집에 갔다.", "ተማሪው ወደ ቤት ሄደ።",
    ]
    junk = ["Please sign in to continue.", "Read more.", "Click here!", "no end of a line", "อ a line that has one letter"]
    frame = spark.createDataFrame([(1, "\n".join(clean + junk))], "doc_id long, text string")
    found = quality_rules.apply_quality_rules(frame).first()
    assert found.clean_text.split("\n") == clean and found.n_lines_removed == len(junk)
    db = duckdb.connect()
    documents = frame.toPandas()
    db.register("documents", documents)
    assert db.execute(quality_rules.oracle_sql()).df().n_lines_removed[0] == len(junk)


PARTS = [f"Part {i} of the story tells at some length what happened on day {i}, and why nobody spoke of it then." for i in range(6)]


def paragraphs(texts, attributes=""):
    return "".join(f"<p{attributes}>{t}</p>" for t in texts)


@pytest.mark.parametrize("page, expected", [
    ("<article><p>%s</p><svg class='i' /><p>%s</p><math/><p>%s</p></article>" % tuple(PARTS[:3]), PARTS[:3]),
    ("<article><h1>Title</h1>" + paragraphs(PARTS[:1], " class='notice-board'") + paragraphs(PARTS[1:2], " class='social-policy'")
     + paragraphs(PARTS[2:3], " id='promoted-works'") + "</article>", ["Title", *PARTS[:3]]),
    ("<article><h1>Title</h1><div class='newsletter-text'>" + paragraphs(PARTS) + "</div><div class='newsletter'>Join us</div></article>",
     ["Title", *PARTS, "Join us"]),
    ("<article><h1>Title</h1>" + paragraphs(PARTS) + "<div class='newsletter'>Join us</div></article>", ["Title", *PARTS]),
    ("<main><article><h1>Title</h1>" + paragraphs(PARTS) + "</article>"
     + "".join(f"<article><h3><a href='/x{i}'>Other {i}</a></h3><p>A teaser that says little.</p></article>" for i in range(4)) + "</main>",
     ["Title", *PARTS]),
    ("<main><h1>Title</h1>" + paragraphs(PARTS) + "<section><h2>Read next</h2>"
     + "".join(f"<div><h3>Other {i}</h3><p>A teaser that says little.</p></div>" for i in range(3)) + "</section></main>", ["Title", *PARTS]),
    ("<main><h1>Title</h1>" + paragraphs(PARTS[:3]) + "<h2>Related</h2><p>A teaser.</p><h2>The end</h2>" + paragraphs(PARTS[3:]) + "</main>",
     ["Title", *PARTS[:3], "The end", *PARTS[3:]]),
    ("<article><h1>Title</h1><p>%s</p><div id='reader-feedback'>%s</div></article>" % (PARTS[0], paragraphs(PARTS[1:])), ["Title", PARTS[0]]),
])
def test_article_stays_whole_without_its_neighbours(page, expected):
    html_page = f"<html><body><nav><a href='/'>Home</a></nav>{page}<footer>Imprint</footer></body></html>"
    assert html_text.main_text(html_page).split("\n\n") == expected


def test_clustering_settles_pages_without_article_and_main():
    menu = "".join(f"<div><a href='/{i}'>Item {i}</a></div>" for i in range(12))
    page = f"<body><div>{menu}</div><div><div>{paragraphs(PARTS)}</div></div><div>{menu}</div></body>"
    assert html_text.main_text(page).split("\n\n") == PARTS
    found = html_text.parse(page)
    ratios = [len(x.text) / x.n_tags for x in found.lines]
    smooth = []
    for i in range(len(ratios)):  # the plain sums of a kernel of three sigmas
        near = [(np.exp(-0.5 * (i - j) ** 2), r) for j, r in enumerate(ratios) if abs(i - j) <= 3]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    border = sum(smooth) / len(smooth)
    for _ in range(100):
        low, high = [s for s in smooth if s < border], [s for s in smooth if s >= border]
        border = (sum(low) / len(low) + sum(high) / len(high)) / 2
    plain = [s >= border for s in smooth]
    assert html_text.marked_lines(found.lines, 1.0).tolist() == plain and 0 < sum(plain) < len(plain)


def test_bpe_of_many_new_words_fits_a_small_database(monkeypatch):
    """200000 symbols merge in 80 MB, and stretches of ids decode to the same bytes."""
    random = np.random.default_rng(0)
    words = [bytes(w) for w in random.choice(np.frombuffer(b"etaoinsr", np.uint8), (20000, 10))]
    words += [b"a" * 128, b"\x00\xff", "é".encode() * 40]
    encoding = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    codec = byte_bpe.Codec(RANKS, PATTERN)
    codec.db.execute("SET memory_limit = '80MB'")
    found = dict(codec._merge(words))
    ids = [found[i] for i in range(len(words))]
    assert all(np.frombuffer(i, "<u4").tolist() == encoding._encode_single_piece(w) for w, i in zip(words, ids))
    monkeypatch.setattr(byte_bpe, "STRETCH", 8)
    monkeypatch.setattr(byte_bpe, "QUERY_IDS", 4000)
    assert codec.decode([*ids[-2000:], b""]) == [*words[-2000:], b""]


def test_words_of_letters_and_marks_are_asked_for_between_blanks(monkeypatch):
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{a}{m}{k} {a}{m} {m}{a} {a}{k}{m}, {a}{m}{k}. A" for a in ("ab", "Éa", "ßÀ", "ª", "İ", "ǅ") for m in marks for k in marks]
    rule = token_files.WordIds(WORD_BPE)
    plain = rule.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, expected in zip(texts, rule.encode(texts), plain):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text
    apart = []
    monkeypatch.setattr(token_files.WordIds, "_learn_apart", lambda self, words: apart.extend(words))
    token_files.WordIds(WORD_BPE)._learn(["house", "Élan!?", "o'clock", "x2", "ab<"])
    assert apart == ["o'clock", "x2", "ab<"]


def test_words_differ_by_neither_ascii_capitals_nor_marks_nor_digits_around_them():
    rule = token_files.WordIds(WORD_BPE)
    text = "House, house. HOUSE!? (house) house2 12house\n'house' élan×élan Élan; don't"
    ids = np.frombuffer(rule.encode([text])[0], "<u4").tolist()
    assert ids == rule.tokenizer.encode(text, add_special_tokens=False).ids
    assert set(rule.known) == {
        "", "house", ",", ".", "!?", "(", ")", "1", "2", "'house", "'", "élan×élan", "Élan", ";", "don", "'t",
    }


def test_words_of_any_neighbours_have_the_librarys_ids():
    signs = [*"abSŜstÉé×÷ßµªİıK²٣२'’.,<>|=-&_ \n\t\x0b\x1c\x85\xa0 ̸́̇⃣각日😀12", "'s", "'RE", "'ll", ", ", ". ", "<|endoftext|>", "<|"]
    r = np.random.default_rng(5)
    texts = ["".join(r.choice(signs, r.integers(0, 14))) for _ in range(6000)]
    rule = token_files.WordIds(WORD_BPE)
    plain = [e.ids for e in rule.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for size in (1, 7, 6000):
        found = [i for k in range(0, len(texts), size) for i in rule.encode(texts[k : k + size])]
        for text, ids, expected in zip(texts, found, plain, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == expected, text
    assert rule.encode(["", " \n"]) == [b"", b""] and rule.encode([]) == []
