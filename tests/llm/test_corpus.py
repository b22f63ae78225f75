"""Operators that bring documents together: joins, decontamination, files, shards, pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F
from samples import PROSE, SF, TEXTS, by_id

import corpus_pipeline
from tempspan.llm import components, decontamination, huffman, jaccard_join, sharding, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def plain_classes(texts, threshold=0.8):
    """(class, links) of every document by comparing all pairs."""
    sets = {k: set(jaccard_join.ngram_set(t, 5).tolist()) for k, t in texts.items()}
    ids, root, links = sorted(texts), {k: k for k in texts}, Counter()

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                links.update((a, b))
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (find(k), links[k]) for k in ids}


def near(random_, words, changes):
    words = list(words)
    for _ in range(changes):
        words[random_.randrange(len(words))] = f"new{random_.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("chunk", [1024, 16])
def test_jaccard_join_is_that_of_all_pairs(spark, texts, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK_SETS", chunk)
    r = random.Random(3)
    mine = dict(texts) | {9000 + k: t for k, t in dict(TEXTS).items() if k}
    base = [f"w{r.randrange(900)}" for _ in range(300)]
    mine |= {5000 + i: near(r, base, r.randrange(9)) for i in range(60)}
    frame = spark.createDataFrame(list(mine.items()), "doc_id long, text string").repartition(4)
    found = {x.doc_id: (x.class_id, x.n_links) for x in jaccard_join.jaccard_join(frame).collect()}
    assert found == plain_classes(mine)


def test_jaccard_join_of_odd_rows(spark, edge):
    found = jaccard_join.jaccard_join(edge).collect()
    assert len(found) == len(TEXTS)
    rows = {(r.doc_id, r.class_id, r.n_links) for r in found}
    assert {(4, 4, 3), (5, 4, 3), (6, 4, 3), (None, None, 0), (1, 1, 0), (3, 3, 0), (7, 7, 0)} <= rows
    assert jaccard_join.jaccard_join(edge.limit(0)).count() == 0


def test_bands_reach_the_recall():
    rule = jaccard_join.JaccardRule()
    bands, rows = rule.bands_and_rows()
    assert 1 - (1 - rule.threshold**rows) ** bands >= rule.recall and bands * rows <= rule.max_hashes


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(41)} | {
        (i, 100) for i in range(100, 160)
    }


ITEM = (
    "Seven lanterns hung above the ferry landing, and the keeper counted them twice before he wrote "
    "the number into the book that his father had begun in the year of the great flood."
)


def edited(r, text, n):
    letters = list(text)
    for _ in range(n):
        i = r.randrange(len(letters))
        kind = r.choice("sid")
        if kind == "d":
            del letters[i]
        else:
            letters[i : i + (kind == "s")] = r.choice("bcdfg")
    return "".join(letters)


def test_passages_are_found_and_clean_texts_are_not(spark, edge):
    r = random.Random(5)
    rows = [(i, PROSE + " " + edited(r, ITEM, 4).replace(" ", "\n", 2) + " " + PROSE) for i in range(50)]
    rows += [(100, PROSE), (101, ITEM[:60] + PROSE), (102, ITEM.upper()), (103, None), (104, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(
        [(7, ITEM), (7, ITEM), (8, None), (9, ""), (10, "short"), (None, ITEM)], "item_id long, text string"
    )
    found = by_id(decontamination.decontaminate(documents, benchmark))
    assert {k for k, x in found.items() if x.contaminated} == {*range(50), 102}
    assert all(x.item_ids == [7] for x in found.values() if x.contaminated)
    part = found[102].regions[0]
    assert (part.start, part.end, part.edits) == (0, len(ITEM) - 1, 0)
    # in blocks of one window each
    rule = decontamination.MatchRule(block_grams=1)
    blocks = by_id(decontamination.decontaminate(documents.where("doc_id > 40"), benchmark.limit(1), rule))
    assert {k for k, x in blocks.items() if x.contaminated} == {*range(41, 50), 102}
    clean = decontamination.decontaminate(edge, benchmark)
    assert clean.count() == len(TEXTS) and clean.where("contaminated").count() == 0
    assert decontamination.decontaminate(edge, benchmark.limit(0)).where("contaminated").count() == 0


def distance_at_most(a, b, k):
    """Whether two strings are within k edits."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
        if min(row) > k:
            return False
    return row[-1] <= k


def test_windows_within_the_budget_are_those_of_all_edit_distances():
    """Every window of every item against every stretch of every text."""
    r = random.Random(8)
    rule = decontamination.MatchRule(q=4, window=24, edit_share=0.1)
    items = ["abcab cabca bcabc abcab cabca", "the keeper counted lanterns twice", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    block = decontamination.Block([w for i, t in enumerate(items) for w in decontamination.item_windows(i, t, rule)], rule)
    k, m = rule.budget(24), 24
    for _ in range(40):
        item = r.choice(items)
        start = r.randrange(len(item) - m + 1)
        text = "x" * r.randrange(5) + edited(r, item[start : start + m], r.randrange(k + 3)) + r.choice(["", " zz", " aaaa"])
        found = {x["item_id"] for x in decontamination.text_regions(text, block)}
        plain = {
            i
            for i, t in enumerate(items)
            if any(
                distance_at_most(t[a : a + m], text[b : b + n], k)
                for a in range(len(t) - m + 1) for n in range(m - k, m + k + 1) for b in range(max(len(text) - n + 1, 0))
            )
        }
        assert found == plain, text


def test_parts_and_blocks_give_the_same_regions(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = by_id(decontamination.decontaminate(documents, benchmark))
    rule = decontamination.MatchRule(block_grams=3000)
    assert len(list(decontamination.blocks(benchmark, "item_id", "text", rule))) > 2
    blocks = by_id(decontamination.decontaminate(documents.withColumn("_other", F.lit(1)), benchmark, rule))
    assert blocks.keys() == whole.keys()
    for key, row in whole.items():
        assert sorted(blocks[key].regions) == sorted(row.regions) and blocks[key].item_ids == row.item_ids
    monkeypatch.setattr(decontamination, "POSTINGS", 50)
    texts = {r.doc_id: r.text for r in documents.collect()}
    items = [w for r in benchmark.collect() for w in decontamination.item_windows(r.item_id, r.text, decontamination.MatchRule())]
    block = decontamination.Block(items, decontamination.MatchRule())
    for key, text in texts.items():
        found = [tuple(x.values()) for x in decontamination.text_regions(text, block)]
        assert sorted(found) == sorted(map(tuple, whole[key].regions))


def test_repeated_words_take_little_memory():
    import tracemalloc

    rule = decontamination.MatchRule()
    block = decontamination.Block(decontamination.item_windows(1, "a " * 300, rule), rule)
    tracemalloc.start()
    (region,) = decontamination.text_regions("a " * 15_000, block)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert (region["start"], region["item_id"]) == (0, 1) and region["end"] >= 29_990


def test_quotations_of_100_characters_are_found_at_any_offset(spark):
    rule, r = decontamination.MatchRule(), random.Random(4)
    words = "".join(r.choice("abcdefghijklmnopqrstuvwxyz" + " " * 4) for _ in range(300)).split()
    item = " ".join(words)[:233].strip()
    block = decontamination.Block(decontamination.item_windows(1, item, rule), rule)
    plain = lambda text: decontamination.folded(text)[0]
    for start in range(len(item) - 99):
        quoted = plain(PROSE + " " + item[start : start + 100].strip() + " " + PROSE)
        assert [x[0] for x in block.regions(quoted)] == [1]
        changed = list(item[start : start + 100].strip())
        for i in r.sample(range(len(changed)), 4):
            changed[i] = "0"
        assert [x[0] for x in block.regions(plain(PROSE + " " + "".join(changed) + " " + PROSE))] == [1]
        assert block.regions(plain(PROSE + item[start : start + 60] + PROSE)) == []
    found = block.regions(plain(item[26:140]))
    assert len(found) == 1 and found[0][1:3] == (0, len(item[26:140]))
    documents = spark.createDataFrame([(1, PROSE + " " + item[26:140]), (2, PROSE)], "doc_id long, text string")
    nameless = spark.createDataFrame([(None, item)], "item_id long, text string")
    rows = by_id(decontamination.decontaminate(documents, nameless))
    assert [(rows[k].contaminated, rows[k].n_regions, rows[k].item_ids) for k in (1, 2)] == [(True, 1, []), (False, 0, [])]


def test_edit_distance_of_alignment():
    rule = decontamination.MatchRule()
    r = random.Random(9)
    item = decontamination.item_windows(1, ITEM[:95], rule)
    block = decontamination.Block(item, rule)
    for _ in range(200):
        text = edited(r, "".join(map(chr, item[0][1])).replace(" ", "x"), 0)
        changed = list(text)
        for i in r.sample(range(len(changed)), 5):
            changed[i] = "q"
        windows = decontamination.Block([(1, np.array(list(map(ord, text)), np.uint32))], rule)
        plain = np.array(list(map(ord, "zz" * 9 + "".join(changed) + "zz")), np.uint32)
        found = windows.regions(plain)
        assert found and found[0][3] <= 5
    assert block.regions(np.empty(0, np.uint32)) == []


def test_huffman_round_trip_and_limit():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 300, 40_000):
        counts = np.zeros(50_000, np.int64)
        counts[r.choice(50_000, n, replace=False)] = r.zipf(1.3, n).clip(1, 10**9)
        lengths = huffman.code_lengths(counts)
        assert (lengths[counts == 0] == 0).all() and lengths.max() <= huffman.MAX_BITS
        assert (2.0 ** -lengths[counts > 0].astype(float)).sum() <= 1 + 1e-12
        code = huffman.Code.of(lengths)
        for m in (1, 511, 512, 513, 2000):
            ids = r.choice(np.flatnonzero(counts), m)
            bits, checkpoints = huffman.encode_block(ids, code)
            assert (huffman.decode_block(bits, checkpoints, m, code) == ids).all()


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_token_files(spark, documents, edge, monkeypatch, tmp_path, block):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", block)
    library = tokenizers.Tokenizer.from_file(WORD_BPE)
    for name, frame in (("some", documents), ("odd", edge)):
        folder = token_files.store_tokens(frame, WORD_BPE, 2, str(tmp_path / f"{name}{block}"))
        rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda k: -1 if k is None else k)
        texts = defaultdict(list)
        for r in frame.collect():
            texts[r.doc_id].append(r.text or "")
        at = 0
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert any(ids == library.encode(t, add_special_tokens=False).ids + [2] for t in texts[r.doc_id])
            assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(r.ids))
            at += len(ids)
    empty = token_files.store_tokens(edge.limit(0), WORD_BPE, 2, str(tmp_path / f"none{block}"))
    assert token_files.read_token_files(spark, empty).count() == 0


def check_shards(rows, n_shards=24):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(n_shards)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_shards_keep_copies_together(spark, documents, texts):
    rows = sharding.shard_documents(documents).collect()
    assert len(rows) == len(texts)
    check_shards(rows)
    shards = defaultdict(set)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        shards[data].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_shards_of_a_hot_group_and_of_odd_rows(spark, edge):
    texts = ["hot" if i % 3 == 0 else f"pair {i // 2}" if i % 5 == 0 else f"own {i}" for i in range(1200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sharding.shard_documents(frame).collect()
    check_shards(rows)
    assert len({r.shard for r in rows if texts[r.doc_id] == "hot"}) == 8  # 400 of 50 each
    odd = sharding.shard_documents(edge, n_shards=4).collect()
    check_shards(odd, 4)
    assert len(odd) == len(TEXTS) and {(r.doc_id, r.size, r.text_crc32) for r in odd} >= {(1, 8, 0), (2, 8, 0)}
    assert sharding.shard_documents(edge.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage against its operator or a plain version, on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        path = str(tmp_path / str(number))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            after = {r.doc_id: r.text for r in docs.collect()}
            assert docs.count() == len(after) and set(after) <= set(before)
        if number == 2:
            assert set(after) == {k for k, (c, _) in plain_classes(before).items() if c == k}
        if number == 3:
            plain = [" ".join(b.lower().split()) for b in benchmark]
            for k in before:
                text = " ".join(before[k].lower().split())
                assert (k in after) or any(b[:80] in text for b in plain)
                assert (k not in after) or not any(b in text for b in plain)
    ids = sorted(r.doc_id for r in docs.collect())
    assert ids == sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())


def test_pipeline_keeps_one_of_repeated_rows(spark):
    rows = [(1, PROSE), (1, PROSE), (2, PROSE + " More."), (3, "other text"), (4, None)]
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.near_duplicates(spark, frame, SF).collect()
    assert sorted(r.doc_id for r in found) == [1, 3, 4]


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, row string"


def test_pipeline_loses_no_text_for_anothers_id(spark):
    other = " ".join(reversed(PROSE.split()))
    rows = [(1, PROSE), (2, PROSE + " More."), (2, other), (3, "a third text of its own"), (2, other + " again."),
            (None, PROSE), (None, "without an id"), (7, "seven"), (7, "another seven"), (7, "seven")]
    frame = spark.createDataFrame([(k, t, "en", "s", 1, "clash") for k, t in rows], DOCUMENT).repartition(3)
    found = corpus_pipeline.near_duplicates(spark, frame, SF)
    assert found.columns == list(corpus_pipeline.COLUMNS)
    texts = Counter(r.text.removesuffix(" again.") for r in found.collect())
    assert texts == Counter([PROSE, other, "a third text of its own", "without an id", "seven", "another seven"])
    assert {r.doc_id for r in found.collect() if r.text == PROSE} == {1}


def test_pipeline_of_odd_and_no_rows(spark):
    long = (PROSE + "\n") * 2_000
    rows = [(1, None), (2, ""), (3, " \n"), (None, PROSE), (4, long), (5, "!!! ???"), (5, PROSE * 2)]
    frame = spark.createDataFrame([(k, t, None, None, None, "x") for k, t in rows], DOCUMENT)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, frame, SF)
        assert out.columns == list(corpus_pipeline.COLUMNS) and out.count() <= len(rows)
    assert corpus_pipeline.byte_bpe(spark, frame, SF).count() == len(rows)
    assert corpus_pipeline.language_id(spark, frame, SF).count() == 0  # no language to learn
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), SF).count() == 0


def test_small_groups_end_whole(spark):
    """Groups that fill the shards exactly, and groups of which a shard holds one."""
    for n_groups, size, whole in ((24, 20, 24), (30, 16, 24), (5, 100, 0), (48, 10, 48)):
        rows = [(i, f"text {i % n_groups}") for i in range(n_groups * size)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = sharding.shard_documents(frame).collect()
        check_shards(found)
        shards = defaultdict(set)
        for r in found:
            shards[r.doc_id % n_groups].add(r.shard)
        assert sum(len(s) == 1 for s in shards.values()) >= whole
        fewest = -(-size // (n_groups * size // 24))
        assert all(len(s) <= fewest + 4 for s in shards.values())
