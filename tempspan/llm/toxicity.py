"""Toxicity by a weighted grammar of clauses: who is insulted or threatened, and who says so.

A text is cut into clauses. The words of a clause become symbols (insult, threat, target,
intent, negation, report, quotation mark, other), by word lists and by an insult lexicon that
is learned from labels. Finite-state transducers, composed into one table, rewrite them: one
marks insults and threats in the scope of a negation, one those that are quoted or reported, one
lets a threat stand only beside a target, one tells whether the clause has a target. A clause
comes out as one of ``OUTCOMES`` with the weight of its words; isolated words are never
scored. Evidence of each outcome adds up over the document, on a logarithmic scale, and a
logistic model with a prior turns it into the score.

Learned from at most ``Settings.sample_toxic`` and ``sample_clean`` labelled documents that are
not held out, chosen by hashes of id and text: (1) the lexicon, words and beginnings of words
that are significantly more frequent in toxic documents. Their counts are aggregated by
Spark; at most ``max_candidates`` of the most significant come to the driver. Of beginnings with about the same
documents the longest stays, and further ones are taken as long as they explain documents that no
other one does; (2) the weights of the outcomes. Scoring is one pass in which texts
stay in their rows; a text without a word of the lexicon costs one automaton scan.

Defined results: a null text counts as empty; texts without a matched clause, empty ones
included, share the lowest score; documents without id are never learned from and not held
out; labels that are null or have no document are passed over, contradicting ones both
count; equal rows get equal scores; without labels the word lists and the prior decide; an
empty table gives no rows; very long texts are scored whole, in time linear in their length; other
columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns, worker_memory
from tempspan.runtime import write_shared

# Word lists in English, German, French and Spanish.
INSULTS = (
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash garbage worthless pathetic "
    "disgusting clown filth filthy vermin pig pigs jerk bastard bastards fool fools coward parasite parasites "
    "dummkopf trottel vollidiot abschaum versager arschloch idioten "
    "connard connards crétin imbécile salaud ordure débile "
    "imbécil estúpido estúpida basura cabrón escoria inútil"
).split()
THREATS = (
    "kill hurt beat burn shoot stab destroy punch strangle murder töten umbringen schlagen verbrennen "
    "tuer frapper brûler étrangler matar golpear quemar destruir"
).split()
INTENTS = (
    "will gonna going shall must should ll werde werden wird sollst sollte vais va allons vas doit voy vamos debe"
).split()
TARGETS = (
    "you your yours u ya you're youre he she they him her them du dich dir dein deine euch ihr sie "
    "tu toi te ton ta vous votre il elle ils elles tú ti usted ustedes eres él ella ellos"
).split()
NEGATIONS = (
    "not no never nobody none neither nor isn't aren't wasn't don't doesn't didn't won't can't cannot "
    "nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna"
).split()
REPORTS = (
    "said says say called calls told tells wrote writes claimed claims quoted reported allegedly "
    "sagte sagt schrieb nannte behauptete dit disait écrit appelé raconté dijo dice escribió llamó"
).split()

WORD, INSULT, THREAT, TARGET, INTENT, NEGATION, REPORT, QUOTE = range(8)
#: What transducers rewrite insults and threats to.
DENIED_INSULT, DENIED_THREAT, TOLD_INSULT, TOLD_THREAT = range(8, 12)
#: How many words a negation reaches.
SCOPE = 3

#: Outcomes of a clause, the strongest last, each with its prior weight.
OUTCOMES = {
    "denied threat": 0.5, "denied insult": 1.0, "told threat": 1.0, "told insult": 1.5,
    "insult": 6.0, "aimed insult": 8.0, "threat": 8.0,
}
PRIOR_BIAS = -4.0

#: Odd multipliers, one for each number of a sketch.
SKETCH = np.array([0x9E3779B97F4A7C15 + 0xD6E8FEB86659FD92 * k & (1 << 64) - 1 for k in range(8)], np.uint64)

CLAUSE_END = re.compile(r"[.!?;:\n…。！？]+")
QUOTES = re.compile(r'["“”„«»\n]')
TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«»]")
WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    sample_toxic: int = 2000
    sample_clean: int = 4000
    max_candidates: int = 4000
    shortest: int = 3
    longest: int = 12
    #: False entries of the lexicon to be expected.
    false_entries: float = 0.1
    #: A lexicon entry may occur in clean documents this much less often than in toxic ones.
    least_ratio: float = 10.0
    prior_deviation: float = 3.0
    threshold: float = 0.7


# --- transducers -------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """States from ``start``; a step takes (state, symbol) to (state, symbol)."""

    start: tuple
    step: Callable[[tuple, int], tuple[tuple, int]]


def _negate(state: tuple, symbol: int) -> tuple[tuple, int]:
    (left,) = state
    if symbol == NEGATION:
        return (SCOPE,), symbol
    if left and symbol in (INSULT, THREAT):
        return (left - 1,), DENIED_INSULT if symbol == INSULT else DENIED_THREAT
    return (max(0, left - (symbol != QUOTE)),), symbol


def _tell(state: tuple, symbol: int) -> tuple[tuple, int]:
    quoted, told = state
    if symbol == QUOTE:
        return (not quoted, told), symbol
    if symbol == REPORT:
        return (quoted, True), symbol
    if quoted or told:
        symbol = {INSULT: TOLD_INSULT, THREAT: TOLD_THREAT}.get(symbol, symbol)
    return state, symbol


def _aim(state: tuple, symbol: int) -> tuple[tuple, int]:
    """(a target was seen, threat or told threat seen, the strongest insult so far)."""
    target, threat, told, insult = state
    rank = {DENIED_INSULT: 1, TOLD_INSULT: 2, INSULT: 3}.get(symbol, 0)
    return (
        target or symbol == TARGET,
        threat or symbol == THREAT,
        max(told, {DENIED_THREAT: 1, TOLD_THREAT: 2}.get(symbol, 0)),
        max(insult, rank),
    ), symbol


def compose(*transducers: Transducer) -> Transducer:
    """Each transducer reads what the one before writes."""

    def step(states: tuple, symbol: int) -> tuple[tuple, int]:
        result = []
        for transducer, state in zip(transducers, states):
            state, symbol = transducer.step(state, symbol)
            result.append(state)
        return tuple(result), symbol

    return Transducer(tuple(t.start for t in transducers), step)


def outcome(aimed: tuple) -> str | None:
    """What a clause that ended in this state of the last transducer says."""
    target, threat, told, insult = aimed
    if threat and target:
        return "threat"
    if insult == 3:
        return "aimed insult" if target else "insult"
    if insult == 2:
        return "told insult"
    if told == 2 and target:
        return "told threat"
    if insult == 1:
        return "denied insult"
    return "denied threat" if told == 1 and target else None


class Table:
    """The composed transducer as a table over its reachable states."""

    def __init__(self) -> None:
        machine = compose(
            Transducer((0,), _negate),
            Transducer((False, False), _tell),
            Transducer((False, False, 0, 0), _aim),
        )
        names = list(OUTCOMES)
        self.number: dict[tuple, int] = {}
        self.next: list[list[int]] = []
        self.outcome: list[int | None] = []
        waiting = []

        def add(state: tuple) -> int:
            if state not in self.number:
                self.number[state] = len(self.next)
                self.next.append([])
                found = outcome(state[2])
                self.outcome.append(None if found is None else names.index(found))
                waiting.append(state)
            return self.number[state]

        self.start = add(machine.start)
        self.quoted = add((machine.start[0], (True, False), machine.start[2]))
        while waiting:
            state = waiting.pop()
            self.next[self.number[state]] = [add(machine.step(state, s)[0]) for s in range(QUOTE + 1)]

    def run(self, symbols: list[int], quoted: bool) -> int | None:
        state = self.quoted if quoted else self.start
        for symbol in symbols:
            state = self.next[state][symbol]
        return self.outcome[state]


# --- model -------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Insult words and beginnings of words (those end in no ``$``) with their weights, and the
    logistic model over the outcomes."""

    lexicon: dict[str, float]
    bias: float = PRIOR_BIAS
    weights: tuple[float, ...] = tuple(OUTCOMES.values())
    settings: Settings = field(default_factory=Settings)


class Grammar:
    """A model ready for use in a worker."""

    def __init__(self, lexicon: dict[str, float]):
        self.table = Table()
        self.classes: dict[str, int] = {}
        for words, symbol in (
            (TARGETS, TARGET), (INTENTS, INTENT), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT)
        ):
            self.classes |= dict.fromkeys(words, symbol)
        self.whole = {e[:-1]: w for e, w in lexicon.items() if e.endswith("$")}
        self.beginnings = {e: w for e, w in lexicon.items() if not e.endswith("$")}
        self.lengths = sorted({len(e) for e in self.beginnings})
        self.finder = ahocorasick.Automaton()
        for entry in (*self.whole, *self.beginnings, *THREATS):
            self.finder.add_word(entry, len(entry))
        self.finder.make_automaton()

    def insult(self, word: str) -> float:
        """The weight of a word as an insult, 0 for none."""
        weight = self.whole.get(word, 0.0)
        for n in self.lengths:
            if n > len(word):
                break
            weight = max(weight, self.beginnings.get(word[:n], 0.0))
        return weight

    def evidence(self, text: str) -> np.ndarray:
        """For each outcome, the weight of the text's clauses on a logarithmic scale."""
        total = np.zeros(len(OUTCOMES))
        text = text.lower()
        starts = [
            end - n + 1 for end, n in self.finder.iter(text) if end < n or not text[end - n].isalpha()
        ]
        if not starts:
            return total
        ends = [m.end() for m in CLAUSE_END.finditer(text)]
        # After each quotation mark and line end: whether a quotation is open.
        marks, is_open = [], []
        for mark in QUOTES.finditer(text):
            marks.append(mark.end())
            before = bool(is_open) and is_open[-1]
            is_open.append({"\n": False, "“": True, "„": True, "«": True, "”": False, "»": False}.get(mark[0], not before))
        for k in sorted({bisect.bisect_right(ends, s) for s in starts}):
            begin, end = ends[k - 1] if k else 0, ends[k] if k < len(ends) else len(text)
            symbols, weight = [], 0.0
            for token in TOKENS.findall(text, begin, end):
                insult = self.insult(token)
                weight += insult
                symbols.append(
                    INSULT if insult else QUOTE if len(token) == 1 and token in '"“”„«»' else self.classes.get(token, WORD)
                )
            quote = bisect.bisect_right(marks, begin)
            found = self.table.run(symbols, bool(quote) and is_open[quote - 1])
            if found is not None:
                total[found] += weight or 1.0
        return np.log1p(total)


def grammar(model: Model) -> Grammar:
    """The Python worker's grammar."""
    key = ("toxicity", tuple(sorted(model.lexicon.items())))
    return worker_memory(key, lambda: Grammar(model.lexicon))


def score(evidence: np.ndarray, model: Model) -> float:
    return 1 / (1 + math.exp(-max(-700.0, model.bias + float(evidence @ np.array(model.weights)))))


# --- learning ----------------------------------------------------------------------


def held_out(key: Column) -> Column:
    """Whether a document is held out of learning; one without id is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_rows(documents: DataFrame, labels: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(h, toxic, text) of the chosen documents: at most as many of each class as ``settings`` says."""
    usable = labels.where(~held_out(F.col(key)) & F.col(key).isNotNull()).select(key, "toxic")
    digest = F.xxhash64(F.col(key).cast("string"), F.coalesce(text, F.lit(""))).alias("h")
    chosen = None
    for toxic, most in ((1, settings.sample_toxic), (0, settings.sample_clean)):
        ids = usable.where(F.col("toxic") == toxic).select(key).distinct()
        ids = ids.orderBy(F.xxhash64(key), key).limit(most)  # bounded, hence the broadcast
        met = documents.select(key, digest).join(F.broadcast(ids), key).select("h").distinct()
        some = met.orderBy("h").limit(most).withColumn("toxic", F.lit(toxic))
        chosen = some if chosen is None else chosen.union(some)
    chosen = write_shared(chosen, "chosen")
    met = documents.where(F.col(key).isNotNull()).select(digest, F.coalesce(text, F.lit("")).alias("text"))
    met = met.join(F.broadcast(chosen), "h")
    sample = write_shared(met.groupBy("h", "toxic").agg(F.first("text").alias("text")), "sample")
    copies = near_copies(sample)
    return sample.join(F.broadcast(copies), ["h", "toxic"], "left_anti") if copies else sample


def sketch(text: str) -> np.ndarray:
    """The least hashes of a text's three-word windows, one for each of ``SKETCH``."""
    words = np.array([crc32(w.encode()) for w in WORDS.findall(text.lower())] or [0], np.uint64)
    windows = words.copy()
    for k in range(1, min(3, len(words))):
        windows = windows[: len(words) - k] * SKETCH[0] + words[k:]
    windows ^= windows >> np.uint64(29)
    return np.array([((windows * odd) ^ ((windows * odd) >> np.uint64(32))).min() for odd in SKETCH], np.uint64)


def near_copies(sample: DataFrame) -> DataFrame | None:
    """(h, toxic) of the sample's documents that copy, or nearly copy, another one of it.

    Copies repeat all words of their text, so each family of copies counts once. Two
    documents are of a family when any of their sketches' numbers agrees.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [sketch(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("toxic"), pa.array(sketches, pa.binary())], names=["h", "toxic", "sketch"]
            )

    given, _ = given_columns(sample, ["h", "toxic", "text"], "text")
    rows = sorted(given.mapInArrow(draw, "h long, toxic int, sketch binary").collect())
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[tuple, int] = {}
    for i, row in enumerate(rows):
        for k, number in enumerate(np.frombuffer(row.sketch, np.uint64).tolist()):
            one, other = sorted((find(i), find(first.setdefault((row.toxic, k, number), i))))
            root[other] = one
    copies = [(row.h, row.toxic) for i, row in enumerate(rows) if find(i) != i]
    return sample.sparkSession.createDataFrame(copies, "h long, toxic int") if copies else None


def features_of(text: str, settings: Settings) -> set[str]:
    """Words, with a ``$`` at their end, and beginnings of words."""
    found = set()
    for word in set(WORDS.findall(text.lower())):
        if len(word) <= 2 * settings.longest:
            found.add(word + "$")
        found.update(word[:n] for n in range(settings.shortest, min(settings.longest, len(word)) + 1))
    return found


def feature_counts(sample: DataFrame, settings: Settings) -> DataFrame:
    """(feature, toxic, clean): documents of each class that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                counts[toxic].update(features_of(text, settings))
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
                 pa.array([counts[0][f] for f in names], pa.int64())],
                names=["feature", "toxic", "clean"],
            )

    given, _ = given_columns(sample, ["toxic", "text"], "text")
    counted = given.mapInArrow(count, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def surprise(k: int, n1: int, c: int, n0: int) -> float:
    """The log-likelihood ratio of ``k`` of ``n1`` against ``c`` of ``n0``."""
    both, n = k + c, n1 + n0

    def part(x: float, of: float, share: float) -> float:
        return x * math.log(x / (of * share)) if x else 0.0

    return 2 * (
        part(k, n1, both / n) + part(c, n0, both / n) + part(n1 - k, n1, 1 - both / n) + part(n0 - c, n0, 1 - both / n)
    )


def learn_lexicon(sample: DataFrame, settings: Settings) -> dict[str, float]:
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    prior = {word + "$": 1.0 for word in INSULTS}
    if not n1 or not n0:
        return prior
    counts = write_shared(feature_counts(sample, settings), "features")
    # Rarer features could not be significant, whatever their labels.
    n_features = counts.where("toxic + clean >= 4").count()
    ratio = (F.col("toxic") + 0.0) / n1 / ((F.col("clean") + 0.5) / n0)
    rows = (
        counts.where((F.col("toxic") >= 2) & (ratio >= settings.least_ratio))
        .orderBy(F.desc(ratio * F.col("toxic")), "feature").limit(settings.max_candidates).collect()
    )
    known = {r.feature: r for r in counts.where(F.col("feature").isin(list(prior))).collect()}
    for entry, row in known.items():  # the word lists yield to the labels
        if row.clean > max(2, n0 * (row.toxic + 1) / (n1 + 1)):
            del prior[entry]
    clean = {r.feature: r.clean for r in rows}
    toxic = {r.feature: r.toxic for r in rows}
    documents = _documents_of(sample, set(clean), settings)
    least = 2 * math.log(max(n_features, 1) / settings.false_entries)
    taken = [f for f in prior if f in documents]

    def best_first(of: set[int]) -> list[tuple[float, int, str]]:
        found = ((surprise(len(docs & of), len(of), clean[f], n0), len(f), f) for f, docs in documents.items() if len(docs & of) >= 2)
        return sorted((g for g in found if g[0] >= least), reverse=True)

    def take(ranked: list[tuple[float, int, str]]) -> bool:
        """Take the best that is not there yet, as its longest continuation in nearly the same documents."""
        for _, _, f in ranked:
            if not any(f.startswith(t) or t.startswith(f) for t in taken):
                alike = [g for g in documents if g.startswith(f) and len(documents[g]) >= 0.95 * len(documents[f])]
                taken.append(max(alike, key=lambda g: (len(g), g)))
                return True
        return False

    ranked = best_first(set(range(n1)))
    while take(ranked):
        pass
    # What is significant only among the documents that nothing explains yet.
    unexplained = set(range(n1)).difference(*(documents[t] for t in taken))
    while unexplained and take(best_first(unexplained)):
        unexplained -= documents[taken[-1]]

    def weight(f: str) -> float:
        odds = math.log((toxic[f] + 0.5) / (n1 + 1)) - math.log((clean[f] + 0.5) / (n0 + 1))
        return max(0.1, min(1.0, odds / 3))

    return {f: weight(f) for f in taken} | prior


def _documents_of(sample: DataFrame, features: set[str], settings: Settings) -> dict[str, set[int]]:
    """Numbers of the toxic documents of the sample that have each of some features."""
    shared = sample.sparkSession.sparkContext.broadcast(features)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, names = [], []
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                found = sorted(features_of(text, settings) & shared.value)
                hashes += [h] * len(found)
                names += found
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(names, pa.string())], names=["h", "feature"])

    given, _ = given_columns(sample.where("toxic = 1"), ["h", "text"], "text")
    rows = given.mapInArrow(find, "h long, feature string").collect()
    number = {h: i for i, h in enumerate(sorted({r.h for r in rows}))}  # the others come after
    result: dict[str, set[int]] = {}
    for r in rows:
        result.setdefault(r.feature, set()).add(number[r.h])
    return result


def fit_weights(evidence: np.ndarray, toxic: np.ndarray, share: np.ndarray, settings: Settings) -> np.ndarray:
    """Bias and weights of the logistic model, by Newton steps from its Gaussian prior."""
    x = np.hstack([np.ones((len(evidence), 1)), evidence])
    prior = np.array([PRIOR_BIAS, *OUTCOMES.values()])
    precision = np.eye(len(prior)) / settings.prior_deviation**2
    w = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(share @ (np.logaddexp(0, z) - toxic * z) + (w - prior) @ precision @ (w - prior) / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (share * (p - toxic)) + precision @ (w - prior)
        curvature = (x * (share * p * (1 - p))[:, None]).T @ x + precision
        step, size = np.linalg.solve(curvature, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> Model:
    """Learn lexicon and weights from the labels of documents that are not held out."""
    sample = sample_rows(documents, labels, key, text, settings)
    lexicon = learn_lexicon(sample, settings)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grammar(Model(lexicon)).evidence(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), pa.array(found, pa.binary())], names=["h", "toxic", "evidence"])

    given, _ = given_columns(sample, ["h", "toxic", "text"], "text")
    rows = given.mapInArrow(judge, "h long, toxic int, evidence binary").orderBy("h", "toxic").collect()
    if not rows:
        return Model(lexicon, settings=settings)
    evidence = np.array([np.frombuffer(r.evidence) for r in rows])
    toxic = np.array([r.toxic for r in rows], float)
    # Both classes of the sample stand for all labelled documents of theirs.
    usable = labels.where(~held_out(F.col(key)) & F.col(key).isNotNull())
    totals = {r.toxic: r["count"] for r in usable.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    share = np.array([totals[int(t)] / (toxic == t).sum() for t in toxic])
    bias, *weights = fit_weights(evidence, toxic, share * len(rows) / share.sum(), settings)
    return Model(lexicon, float(bias), tuple(float(w) for w in np.maximum(weights, 0.0)), settings)


def with_toxicity(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` to every document."""
    added = {"score": T.DoubleType(), "predicted": T.IntegerType()}
    kept = [f for f in documents.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in added.items())])
    names = [f.name for f in kept]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = grammar(shared.value)
            scores = [score(use.evidence(x.as_py() or ""), shared.value) for x in batch.column(at)]
            predicted = [int(s >= shared.value.settings.threshold) for s in scores]
            made = [pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, *added])

    given, at = given_columns(documents, names, text)
    return given.mapInArrow(judge, schema)


def score_toxicity(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Learn from ``labels`` (key, toxic) and score all documents; adds ``held_out`` too."""
    model = fit(documents, labels, key, text, settings)
    return with_toxicity(documents.withColumn("held_out", held_out(F.col(key))), model, text)
