"""Token ids in binary files: canonical length-limited Huffman coding in blocks.

Documents are dealt by ranges of their id and sorted, encoded by the tokenizer library, and
closed by an end id. Global counts of ids give one code for all files. A file is a Parquet
container whose rows are independent blocks of whole documents: the ids of the documents,
their lengths, the coded bits, and checkpoints, the bit offset of every 512th token, from
which a table-driven decoder reads all stretches of a block at once. The code lengths, which
define the canonical code, are a file beside the blocks, and so are the token totals of the
file parts, from which a document's place among all tokens follows.

Ids leave a task only for the shared folder; counts are added up inside each task first. A
block has about ``BLOCK_TOKENS`` tokens, more only if a single document has.

Defined results: null and empty texts have the end id alone; repeated rows are documents of
their own, in the order of their texts' hashes; documents without an id come first; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempspan.llm.byte_bpe import portions
from tempspan.llm.huffman import Code, code_lengths, decode_block, encode_block
from tempspan.llm.tables import worker_memory
from tempspan.runtime import fresh_folder

BLOCK_TOKENS = 1 << 20
PORTION_CHARS = 4_000_000
REMEMBERED, REMEMBERED_CHARS = 800_000, 64
WORDS_AT_ONCE = 2_000
IDS_SCHEMA = "part int, seq long, first long, doc_id long, n_tokens long, ids binary"
BLOCK_SCHEMA = (
    "part int, seq long, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "checkpoints array<long>, bits binary"
)


def _classes() -> tuple[bytes, np.ndarray]:
    """The class of each byte, and for two classes (first << 3 | second) whether a word starts
    between them: where the library's pattern always cuts. What ASCII and the Latin letters do
    not tell is of the last class, before and after which nothing is cut but at blanks; marks
    stay together, and an apostrophe stays with letters behind it."""
    blank, letter, digit, mark, apostrophe, other = range(6)
    of = np.full(256, other, np.uint8)
    of[33:127] = mark
    for first, last in ("az", "AZ"):
        of[ord(first) : ord(last) + 1] = letter
    of[ord("0") : ord("9") + 1] = digit
    of[ord("'")] = apostrophe
    of[[ord(c) for c in " \n\t\r"]] = blank
    cut = np.zeros(64, bool)
    cut[[blank << 3 | k for k in range(1, 6)]] = True
    cut[[digit << 3 | k for k in (letter, digit, mark, apostrophe)]] = True
    cut[[letter << 3 | k for k in (digit, mark, apostrophe)]] = True
    cut[[mark << 3 | letter, mark << 3 | digit, apostrophe << 3 | digit]] = True
    return of.tobytes(), cut


CLASS_OF, CUT = _classes()
AT_BLANKS = CUT & (np.arange(64) < 8)
BLANK, LETTER = 0, 1
#: The first byte of the Latin letters from A with grave on, and the second bytes of its two marks.
LATIN, TIMES, DIVIDED = 0xC3, 0x97, 0xB7


def cut_words(texts: list[bytes], cut: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of UTF-8 texts without blanks, and where each text's words end among them."""
    joined = b"\n".join([b"", *texts])
    data = np.frombuffer(joined, np.uint8)
    kind = np.frombuffer(bytearray(joined.translate(CLASS_OF)), np.uint8)
    lead = np.flatnonzero(data == LATIN)
    follows = data[lead + 1]
    lead = lead[(follows != TIMES) & (follows != DIVIDED)]
    kind[lead] = kind[lead + 1] = LETTER
    starts = np.zeros(len(data), bool)
    pairs = (kind[:-1] << 3 | kind[1:]).tobytes()
    starts[1:] = np.frombuffer(pairs.translate(np.resize(cut, 256).tobytes()), bool)
    text_ends = np.cumsum([1 + len(t) for t in texts])
    ends = np.searchsorted(np.flatnonzero(starts), text_ends)
    full = kind != BLANK
    data = data[full]
    offsets = np.append(np.flatnonzero(starts[full]), len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)), ends


def cuts_of(text: str) -> tuple[bytes, bool]:
    """A text's bytes, and whether they may be cut where bytes tell it, not at blanks alone.

    ASCII capitals, which the library's normaliser lowers, are lowered, if no combining mark
    could join the small letter and there may be no special string. A text that its normaliser
    composes otherwise is cut at blanks alone.
    """
    data = text.encode("utf-8")
    lowered = data.lower()
    if "<|" in text or not (text.isascii() or unicodedata.is_normalized("NFC", lowered.decode("utf-8"))):
        return data, False
    return lowered, True


#: A word of letters with marks behind it or none: the library's pattern cuts between the two and
#: nowhere else, and its normaliser only lowers the letters.
LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=>?@\[-`{|}~]*)")


class WordIds:
    """Ids of texts by the tokenizer library, asked once for each word between cuts.

    The library's normaliser drops white space and its pattern never spans it, so a text's
    ids are those of its words in order. Words are cut by their bytes, numbered by Arrow for a
    portion of texts, and asked for together. Those of letters and
    marks stand between blanks, and the library's marks of a word's end tell their ids apart;
    as normaliser and pattern leave nothing else to do there, a second tokenizer with the same
    model passes them over. Between all other words stands the library's own special string,
    which never meets its neighbours.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.of_blanks = Tokenizer.from_file(path)
        self.of_blanks.normalizer = normalizers.Sequence([])
        self.of_blanks.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        ending = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if ending and t.endswith(ending)]] = True
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.between_id, self.between = special[-1]
        self.known: dict[str, bytes] = {"": b""}

    def _learn(self, words: list[str]) -> None:
        others, plain = [], []
        for word in words:
            if word.isascii() and word.isalpha():
                plain.append((word, word, ""))
                continue
            found = LETTERS_AND_MARKS.fullmatch(word)
            plain.append((word, *found.groups())) if found else others.append(word)
        for start in range(0, len(plain), WORDS_AT_ONCE):
            part = plain[start : start + WORDS_AT_ONCE]
            asked = " ".join([f"{a} {b}" if b else a for _, a, b in part]).lower()
            found = self.of_blanks.encode_batch_fast([asked], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            last = np.cumsum([2 if b else 1 for _, _, b in part]) - 1
            if len(ends) != last[-1] + 1:  # a model that marks no ends
                others += [w for w, _, _ in part]
                continue
            ends, data = ends[last].tolist(), ids.tobytes()
            self.known.update((w[0], data[a:b]) for w, a, b in zip(part, [0, *ends], ends))
        self._learn_apart(others)

    def _learn_apart(self, words: list[str]) -> None:
        plain = [w for w in words if self.between not in w]
        for start in range(0, len(plain), WORDS_AT_ONCE):
            part = plain[start : start + WORDS_AT_ONCE]
            found = self.tokenizer.encode_batch_fast([self.between.join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            at, data = 4 * np.flatnonzero(ids == self.between_id), ids.tobytes()
            starts, ends = [0, *(at + 4).tolist()], [*at.tolist(), len(data)]
            self.known.update((w, data[a:b]) for w, a, b in zip(part, starts, ends))
        for word in words:
            if self.between in word:
                found = self.tokenizer.encode(word, add_special_tokens=False)
                self.known[word] = np.array(found.ids, "<u4").tobytes()

    def _look_up(self, used: list[str]) -> list[bytes]:
        """Ids of different words."""
        found = list(map(self.known.get, used))
        new = [w for w, ids in zip(used, found) if ids is None]
        if new and len(self.known) + len(new) > REMEMBERED:
            self.known = {"": b""} | {w: ids for w, ids in zip(used, found) if ids is not None}
        self._learn(new)
        result = [self.known[w] if ids is None else ids for w, ids in zip(used, found)]
        for word in new:
            if len(word) > REMEMBERED_CHARS:
                del self.known[word]
        return result

    def _of_alike(self, texts: list[bytes], cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids_of`` for texts that are cut at the same places."""
        words, ends = cut_words(texts, cut)
        words = words.dictionary_encode()
        ids = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = words.indices.to_numpy()
        n = np.array([len(i) // 4 for i in ids], np.int64)
        starts, flat = (np.cumsum(n) - n)[at], np.frombuffer(b"".join(ids), "<u4")
        n = n[at]
        ends = np.append(0, np.cumsum(n))[ends]
        n_before = np.cumsum(n) - n
        return flat[np.repeat(starts - n_before, n) + np.arange(n.sum())], np.diff(ends, prepend=0)

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and the number of each text's ids."""
        cuts = [cuts_of(t) for t in texts]
        plain = np.array([p for _, p in cuts], bool)
        if plain.all():
            return self._of_alike([t for t, _ in cuts], CUT)
        ids, n = [None] * len(texts), np.zeros(len(texts), np.int64)
        for kind, cut in ((True, CUT), (False, AT_BLANKS)):
            where = np.flatnonzero(plain == kind)
            found, n[where] = self._of_alike([cuts[i][0] for i in where], cut)
            for i, part in zip(where, np.split(found, np.cumsum(n[where])[:-1])):
                ids[i] = part
        return np.concatenate(ids), n

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, n = self.ids_of(texts)
        ends, data = 4 * np.cumsum(n), ids.tobytes()
        return [data[b - 4 * k : b] for b, k in zip(ends.tolist(), n.tolist())]


def word_ids(path: str) -> WordIds:
    """The Python worker's memory of words."""
    return worker_memory(("word ids", path), lambda: WordIds(path))


def _narrow(n_symbols: int) -> str:
    return "<u2" if n_symbols <= 1 << 16 else "<u4"


def binary_array(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Bytes of consecutive stretches of an array, given where each ends."""
    offsets = np.append(0, ends * values.itemsize)
    if offsets[-1] >= 1 << 31:
        raise ValueError(f"{offsets[-1]} bytes do not fit into one Arrow array")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def joined_values(column: pa.BinaryArray, kind: str) -> np.ndarray:
    """The bytes of all rows of a column without nulls, one after another, as numbers."""
    if not len(column):
        return np.zeros(0, kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)


def encode_in_order(
    documents: DataFrame, path: str, end_id: int, n_symbols: int, key: str, text: str
) -> DataFrame:
    """Rows of ``IDS_SCHEMA`` in ascending order of (part, seq): parts are ranges of ids."""
    kind = _narrow(n_symbols)
    given = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = first = 0
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_numpy(zero_copy_only=False)]
            at = 0
            for part in portions(texts, PORTION_CHARS):
                ids, n = word_ids(path).ids_of(part)
                ids = np.insert(ids.astype(kind), np.cumsum(n), end_id)
                n += 1
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)), pa.array(np.arange(seq, seq + len(part))),
                        pa.array(first + ends - n), batch.column(1).slice(at, len(part)), pa.array(n),
                        binary_array(ids, ends),
                    ],
                    names=["part", "seq", "first", "doc_id", "n_tokens", "ids"],
                )
                at, seq, first = at + len(part), seq + len(part), first + int(ends[-1])

    return dealt.mapInArrow(run, IDS_SCHEMA)


def count_ids(encoded: DataFrame, n_symbols: int) -> np.ndarray:
    """How often each id occurs; at most one row for each id leaves a task."""
    kind = _narrow(n_symbols)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_symbols, np.int64)
        for batch in batches:
            total += np.bincount(joined_values(batch.column(0), kind), minlength=n_symbols)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(n_symbols, np.int64)
    for row in rows.collect():  # one row for each id of the vocabulary at most
        counts[row.id] = row.n
    return counts


def write_token_files(encoded: DataFrame, n_symbols: int, folder: str) -> None:
    """Write blocks, code and totals of ids in order below a folder."""
    spark = encoded.sparkSession
    kind = _narrow(n_symbols)
    lengths = code_lengths(count_ids(encoded, n_symbols))
    code = spark.sparkContext.broadcast(Code.of(lengths))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, last = [], 0, None

        def block() -> pa.RecordBatch:
            ids = np.concatenate([joined_values(b.column(5), kind) for b in held])
            bits, checkpoints = encode_block(ids, code.value)
            part, seq, first = (held[0].column(k)[0].as_py() for k in range(3))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([v], k) for v, k in zip((part, seq, first, len(ids)), kinds)]
            for k in (3, 4):
                values = pa.concat_arrays([b.column(k) for b in held])
                columns.append(pa.ListArray.from_arrays([0, len(values)], values))
            columns += [pa.array([checkpoints], pa.list_(pa.int64())), pa.array([bits], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            start = 0
            for at, (part, seq, n) in enumerate(zip(*(batch.column(k).to_numpy().tolist() for k in (0, 1, 4)))):
                if last and ((part, seq) != last or n_held + n > BLOCK_TOKENS):
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    yield block()
                    start, n_held = at, 0
                last, n_held = (part, seq + 1), n_held + n
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield block()

    columns = [c.split()[0] for c in IDS_SCHEMA.split(", ")]
    encoded.select(*columns).mapInArrow(pack, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{folder}/code")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).write.parquet(
        f"{folder}/parts"
    )


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32[, ids]) of files; ids little-endian, 32 bits."""
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/code").first().lengths, np.uint8)
    code = spark.sparkContext.broadcast(Code.of(lengths))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(row["bits"], row["checkpoints"], row["n_tokens"], code.value)
                data, n = ids.astype("<u4").tobytes(), np.array(row["doc_tokens"], np.int64)
                ends = 4 * np.cumsum(n)
                cut = [data[b - 4 * k : b] for b, k in zip(ends.tolist(), n.tolist())]
                columns = [
                    pa.array([row["part"]] * len(n), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first"] + np.cumsum(n) - n),
                    pa.array(n),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                ]
                names = ["part", "doc_id", "first", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(cut, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, doc_id long, first long, n_tokens long, ids_crc32 long"
    columns = ["part", "first", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "bits"]
    found = blocks.select(*columns).mapInArrow(unpack, schema + (", ids binary" if with_ids else ""))
    placed = found.join(spark.read.parquet(f"{folder}/parts"), "part")
    return placed.select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def vocabulary_size(path: str) -> int:
    return word_ids(path).tokenizer.get_vocab_size(with_added_tokens=True)


def store_tokens(
    documents: DataFrame, path: str, end_id: int, folder: str | None = None,
    key: str = "doc_id", text: str = "text",
) -> str:
    """Encode documents and write their files; returns the folder."""
    spark = documents.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    n_symbols = max(vocabulary_size(path), end_id + 1)
    encoded = encode_in_order(documents, path, end_id, n_symbols, key, text)
    encoded.write.option("compression", "zstd").parquet(f"{folder}/ids")
    write_token_files(spark.read.schema(IDS_SCHEMA).parquet(f"{folder}/ids"), n_symbols, folder)
    return folder
