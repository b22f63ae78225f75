"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Texts are folded to lower-case letters and single spaces and cut into character n-grams,
which are hashed into a fixed number of buckets. Document frequencies are counted over all
training documents; a feature is the n-gram's share of the text times its inverse document
frequency. The model is trained by follow-the-regularised-leader with L1 and L2 penalties
on a sample of training documents, at most ``Settings.sample_per_language`` of each language
with the least hashes of id and text, equal rows once, and one fifth of the sample sets the temperature that calibrates its scores.

Training: one pass of aggregation by bucket, pre-aggregated in each task to at most one row
per bucket, and the sample's features, whose size is bounded, on the driver. Prediction: one
pass in which texts stay in their rows; the weights (buckets times languages, four bytes
each) are broadcast.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
every text when there is nothing to learn from; repeated rows give repeated results; an
empty table gives no rows; other columns stay, clashing ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns, worker_memory
from tempspan.runtime import write_shared

UNDETERMINED = "und"
#: N-grams that are hashed at once; odd multipliers of the hash.
BLOCK = 1 << 18
MIX_ONE, MIX_TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (1, 2, 3)
    bucket_bits: int = 16
    sample_per_language: int = 1000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 1e-3
    l2: float = 1e-3
    #: Features are small shares; this brings them to the order of one.
    scale: float = 100.0


@dataclass(frozen=True)
class Model:
    """Languages, and for each bucket the weights times the inverse document frequency."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    settings: Settings


def fold_table() -> np.ndarray:
    return worker_memory("letters", _fold_table)


def _fold_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def buckets(text: str, settings: Settings) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text, one for each occurrence; nothing without letters.

    They come in blocks, so that a very long text takes no more memory than a block of it
    and its letters.
    """
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), "<u4")
    folded = fold_table()[codes]
    blank = folded == 32
    folded = folded[np.append(True, ~(blank[1:] & blank[:-1]))]
    if len(folded) < 3:
        return
    for start in range(0, len(folded), BLOCK):
        for order in settings.orders:
            n = min(BLOCK, len(folded) - start - order + 1)
            if n < 1:
                continue
            gram = np.full(n, order, np.uint64)
            for k in range(order):
                gram = (gram * MIX_ONE) ^ folded[start + k : start + k + n].astype(np.uint64)
            yield ((gram * MIX_TWO) >> np.uint64(64 - settings.bucket_bits)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out of training; one without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [x.as_py() or "" for x in batch.column(batch.schema.get_field_index(name))]


def document_frequencies(documents: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """In how many documents each bucket occurs; the last entry counts the documents."""
    size = 1 << settings.bucket_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for value in _texts(batch, text):
                seen = np.zeros(size, bool)
                for found in buckets(value, settings):
                    seen[found] = True
                total[:size] += seen
                total[size] += seen.any()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total[used])], names=["bucket", "n"]
        )

    counted = documents.select(text).mapInArrow(count, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    result = np.zeros(size + 1, np.int64)
    result[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return result


def _sample(documents: DataFrame, text: str, language: str, key: str, settings: Settings) -> DataFrame:
    """Rows (language, text): of each language those with the least hashes of id and text, at
    most as many as the bound says; rows equal in all three are one."""
    most, steps = settings.sample_per_language, 1 << 40
    # Where all ids and texts are alike, hashes alone say how many there are.
    hashed = documents.withColumn("_h", F.xxhash64(F.col(key).cast("string"), F.coalesce(text, F.lit(""))))
    counts = hashed.groupBy(language).agg(F.approx_count_distinct("_h").alias("n")).collect()
    # About twice the wanted rows pass a first cut by hash, so that few are ranked.
    below = {r[language]: int(steps * min(1.0, 2 * most / max(r["n"], 1))) for r in counts}
    if not below:
        return documents.select(language, text).limit(0)
    limit = F.create_map(*(F.lit(x) for pair in below.items() for x in pair))[F.col(language)]
    near = hashed.where(F.pmod("_h", F.lit(steps)) < limit).select(language, "_h", F.pmod("_h", F.lit(steps)).alias("_at"))
    ranked = W.partitionBy(language).orderBy("_at", "_h")
    least = near.distinct().withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= most)
    chosen = write_shared(least.select(language, "_h"), "sampled")  # at most ``most`` rows a language
    met = hashed.join(F.broadcast(chosen), [language, "_h"])
    return write_shared(met.groupBy(language, "_h").agg(F.first(text).alias(text)).drop("_h"), "sample")


def _features(sample: DataFrame, text: str, language: str, settings: Settings) -> list[tuple]:
    """(language, bucket numbers, shares) of each sampled text, in a fixed order."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, numbers, shares = [], [], []
            labels = batch.column(batch.schema.get_field_index(language)).to_pylist()
            for label, value in zip(labels, _texts(batch, text)):
                times = np.zeros(1 << settings.bucket_bits, np.int64)
                for found in buckets(value, settings):
                    times += np.bincount(found, minlength=len(times))
                used = np.flatnonzero(times)
                if len(used):
                    langs.append(label)
                    numbers.append(used.astype(np.int32).tobytes())
                    shares.append((times[used] / times.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(numbers, pa.binary()), pa.array(shares, pa.binary())],
                names=["lang", "buckets", "shares"],
            )

    rows = sample.mapInArrow(make, "lang string, buckets binary, shares binary").collect()
    return [
        (r.lang, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.shares, np.float32))
        for r in sorted(rows, key=lambda r: (r.lang, bytes(r.buckets), bytes(r.shares)))
    ]


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, settings: Settings
) -> np.ndarray:
    """Weights (features by classes) by follow-the-regularised-leader, elastic net included."""
    s = settings
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    random = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in random.permutation(len(rows)):
            at, values, label = rows[i]
            z_at, n_at = z[at], n[at]
            w = weights(z_at, n_at)
            error = _softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error[None, :]
            step = (np.sqrt(n_at + g * g) - np.sqrt(n_at)) / s.alpha
            z[at] = z_at + g - step * w
            n[at] = n_at + g * g
    return weights(z, n)


def temperature_of(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    a, b, golden = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - golden * (b - a), a + golden * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(
    documents: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id",
    settings: Settings = Settings(),
) -> Model:
    """Learn from all given documents that have a language."""
    labelled = documents.where(F.col(language).isNotNull()).select(key, text, language)
    frequency = document_frequencies(labelled, text, settings)
    rows = _features(_sample(labelled, text, language, key, settings), text, language, settings)
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    size = 1 << settings.bucket_bits
    idf = settings.scale * np.log((1 + frequency[size]) / (1 + frequency[:size])) + settings.scale * 0.1
    prepared = [
        (np.append(at, size), np.append(share * idf[at], 1.0), number[name]) for name, at, share in rows
    ]
    calibrating = prepared[::5] if len(prepared) >= 50 else []
    learning = [r for i, r in enumerate(prepared) if i % 5 or not calibrating]
    weights = train_ftrl(learning, size + 1, max(len(languages), 1), settings)
    scores = np.array([values @ weights[at] for at, values, _ in calibrating])
    labels = np.array([label for *_, label in calibrating], np.int64)
    return Model(
        languages, (weights[:size] * idf[:, None]).astype(np.float32), weights[size],
        temperature_of(scores, labels), settings,
    )


def predict_text(text: str | None, model: Model) -> tuple[str, float]:
    total, n = np.zeros(len(model.languages)), 0
    if text and model.languages:
        for found in buckets(text, model.settings):
            total += model.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
    if not n:
        return UNDETERMINED, 0.0
    p = _softmax((total / n + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def with_language(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every document."""
    added = {"lang_pred": T.StringType(), "score": T.DoubleType()}
    kept = [f for f in documents.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in added.items())])
    names = [f.name for f in kept]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict_text(x.as_py(), shared.value) for x in batch.column(at)]
            made = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, *added])

    given, at = given_columns(documents, names, text)
    return given.mapInArrow(predict, schema)


def identify_languages(
    documents: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id",
    settings: Settings = Settings(),
) -> DataFrame:
    """Fit on the documents that are not held out and predict for all; adds ``held_out``."""
    model = fit(documents.where(~held_out(F.col(key))), text, language, key, settings)
    return with_language(documents.withColumn("held_out", held_out(F.col(key))), model, text)
