"""Quality rules: line-first cleaning, then rejection of documents that lose too much.

Every line of a text that holds a word is tried against punctuation, navigation and boilerplate rules, the
failing lines are removed, and a document is rejected when the lines that remain hold too
small a share of its characters. Before that, two counts of the whole text reject documents
that are too short or that mostly repeat themselves.

Only DataFrame functions are used and nothing is shuffled: a document is judged inside its
own row, so hot sources and groups of copies make no difference.

Defined results: a null text counts as an empty one; an empty text has no words and fails
the length rule; repeated rows give repeated results; an empty table gives no rows; columns
of the input that clash with the result's names are replaced, other columns stay; equal lines
get equal verdicts; very long texts and lines are judged whole, in time linear in their length.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word gaps and symbol characters as the counts define them.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Sentence ends, of other scripts too.
TERMINAL = ".!?…。！？｡।॥۔؟։።፧။។៕།"
#: Letters of scripts that set no mark at the end of a sentence (Thai, Lao); a line that is half of
#: them needs none.
UNMARKED = "\u0e01-\u0e4e\u0e81-\u0ede"
CLOSING = "\"'”’»)]"
SEPARATORS = "|»•·›→"
MARKUP = "#*$%&<>{}=~^"
#: Phrases of page furniture, as whole words; a short line that holds one of them fails.
BOILERPLATE = (
    "all rights reserved",
    "privacy policy",
    "terms of service",
    "terms of use",
    "cookie policy",
    "uses cookies",
    "use of cookies",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "click here",
    "read more",
    "sign in",
    "sign up",
    "log in",
    "subscribe to our newsletter",
    "share this",
    "follow us",
    "back to top",
    "skip to content",
    "powered by",
)
PHRASE = f"(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(BOILERPLATE)})($|[^\\p{{L}}\\p{{N}}_])"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost_percent: int = 50
    #: A line fails with at least this many separators (or markup characters, or runs of
    #: exclamation and question marks), if there is also one in so many characters.
    min_marks: int = 3
    chars_per_mark: int = 24
    boilerplate_chars: int = 240


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _count(text: Column, characters: str) -> Column:
    return sum(
        (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in characters),
        start=F.lit(0),
    )


def line_passes(line: Column, rules: LineRules) -> Column:
    """Whether a line passes the three groups of rules."""

    def many(count: Column) -> Column:
        return (count >= rules.min_marks) & (count * rules.chars_per_mark >= F.length(line))

    closing = re.escape(CLOSING)
    last = F.right(F.rtrim(line, F.lit(CLOSING + SPACES)), F.lit(1))
    ends = last.isin(*TERMINAL, ":", ";")
    inside = line.rlike(f"[{TERMINAL}][{closing}]*[\\x20\\x09-\\x0D]+[^\\x20\\x09-\\x0D]")
    plain = ~line.rlike(f"[{re.escape(SEPARATORS + MARKUP)}]|[!?]{{2}}")
    marked = (
        many(F.size(F.split(line, "[!?]{2,}")) - 1)
        | many(_count(line, SEPARATORS))
        | many(_count(line, MARKUP))
    )
    furniture = F.exists(
        F.array(F.lower(line)),
        lambda low: functools.reduce(operator.or_, (low.contains(p) for p in BOILERPLATE)) & low.rlike(PHRASE),
    )
    unmarked = line.rlike(f"[{UNMARKED}]") & (
        2 * F.length(F.regexp_replace(line, f"[^{UNMARKED}]", "")) >= F.length(line)
    )
    return (
        (ends | inside | unmarked)
        & (plain | ~marked)
        & ((F.length(line) > rules.boilerplate_chars) | ~furniture)
    )


def _repeated(ordered: str, key: Callable[[Column], Column]) -> Column:
    """The entries of a sorted array whose key is also a neighbour's."""
    return F.filter(
        ordered,
        lambda x, k: F.coalesce(key(x) == key(F.get(ordered, k - 1)), F.lit(False))
        | F.coalesce(key(x) == key(F.get(ordered, k + 1)), F.lit(False)),
    )


def _repeat_words(frame: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside three-word windows that occur twice or more.

    Windows meet by hash first, which cannot miss a repeat; those that meet are compared as
    strings of three words with single spaces, so the count is exact. A hash shares its
    number with its place (the low 31 bits), so that one array of numbers is sorted.
    """
    n = F.size("words")
    rest = F.greatest(n - 2, F.lit(0))
    pairs = F.zip_with("words", F.slice("words", F.lit(2), rest), lambda a, b: F.xxhash64(a, b))
    frame = frame.withColumn("n_words", n.cast("long")).withColumn(
        "hashes",
        F.zip_with(
            F.slice(pairs, F.lit(1), rest), F.slice("words", F.lit(3), rest),
            lambda p, c: F.xxhash64(p, c),
        ),
    )
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.transform("hashes", lambda h, i: F.shiftleft(h, 31).bitwiseOR(i.cast("long")))
    frame = frame.withColumn("by_hash", F.when(repeats, F.sort_array(placed)))
    place = F.lit((1 << 31) - 1)
    window = F.transform(
        F.transform(
            _repeated("by_hash", lambda x: F.shiftrightunsigned(x, 31)),
            lambda x: x.bitwiseAND(place).cast("int"),
        ),
        lambda i: F.struct(
            F.concat_ws(" ", *(F.get("words", i + k) for k in range(3))).alias("g"), i.alias("i")
        ),
    )
    frame = frame.withColumn("by_window", F.sort_array(window))
    frame = frame.withColumn(
        "starts", F.sort_array(F.transform(_repeated("by_window", lambda x: x.g), lambda x: x.i))
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, s: F.struct((a.n + F.least(F.lit(3), s - a.last)).alias("n"), s.alias("last")),
        lambda a: a.n,
    )
    return frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def apply_quality_rules(
    documents: DataFrame, text: str = "text", rules: LineRules = LineRules()
) -> DataFrame:
    """Add counts, verdicts and the cleaned text to every document.

    Added columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    n_lines_removed (int), clean_text, base_failed, kept.
    """
    added = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines_removed", "clean_text", "base_failed", "kept",
    )
    others = [c for c in documents.columns if c not in added]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    given = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("given"), whole.alias("whole")
    )
    counted = _repeat_words(given.withColumn("words", _words(F.col("whole"))))
    lines = counted.select(
        "given", "whole", "n_words", "n_repeat_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.filter(F.split("whole", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    passing = lines.select(
        *lines.columns, F.filter("lines", lambda line: line_passes(line, rules)).alias("passing"),
        F.size("lines").alias("n_lines"),
    )
    judged = passing.select(
        "given", "n_words", "n_repeat_words", "word_chars",
        F.when(F.col("whole").rlike(f"[{re.escape(SYMBOLS)}]"), _count(F.col("whole"), SYMBOLS))
        .otherwise(0).cast("long").alias("n_symbols"),
        (F.col("n_lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.col("n_lines") - F.size("passing")).alias("n_lines_removed"),
        F.when(F.size("passing") == F.col("n_lines"), F.col("whole"))
        .otherwise(F.array_join("passing", "\n")).alias("clean_text"),
    )
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    left = F.when(F.col("n_lines_removed") == 0, F.col("word_chars")).otherwise(
        F.length(F.regexp_replace("clean_text", GAP, ""))
    )
    enough = 100 * left >= (100 - rules.max_lost_percent) * F.col("word_chars")
    verdict = judged.select(
        "given",
        # A filter on the verdict must not be moved below the arrays it comes from: it would
        # take a copy of all their expressions with it. Filters stay above a generator.
        F.inline(F.array(F.struct(
            *added[:5], "n_lines_removed", "clean_text",
            base_failed.alias("base_failed"), (~base_failed & enough).alias("kept"),
        ))),
    )
    return verdict.select("given.*", *added)


def oracle_sql(rules: LineRules = LineRules()) -> str:
    """The same counts and verdicts of ``documents`` in SQL."""
    word, blank = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
    closing = "[" + re.escape(CLOSING).replace("'", "''") + "]"
    marks = re.escape(SEPARATORS + MARKUP)

    def count(characters: str) -> str:
        return f"length(line) - length(translate(line, '{characters}', ''))"

    def many(n: str) -> str:
        return f"(({n}) >= {rules.min_marks} AND ({n}) * {rules.chars_per_mark} >= length(line))"

    ends = f"regexp_matches(line, '[{TERMINAL}:;]({closing}|{blank})*$')"
    inside = f"regexp_matches(line, '[{TERMINAL}]{closing}*{blank}+[^\\x20\\x09-\\x0D]')"
    shouted = "len(string_split_regex(line, '[!?]{2,}')) - 1"
    furniture = f"regexp_matches(lower(line), '{PHRASE}')"
    unmarked = (
        f"(regexp_matches(line, '[{UNMARKED}]')"
        f" AND 2 * length(regexp_replace(line, '[^{UNMARKED}]', '', 'g')) >= length(line))"
    )
    return f"""
        WITH texts AS (
            SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS whole FROM documents
        ), words AS (
            SELECT n, doc_id, whole, regexp_extract_all(whole, '{word}') AS words FROM texts
        ), windows AS (
            SELECT n, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
            FROM words, unnest(range(1, greatest(len(words) - 1, 1))) AS t(i)
        ), covered AS (
            SELECT n, count(DISTINCT i + k) AS n_repeat_words
            FROM (SELECT n, i, count(*) OVER (PARTITION BY n, g) AS times FROM windows),
                 (VALUES (0), (1), (2)) AS o(k)
            WHERE times > 1 GROUP BY n
        ), lines AS (
            SELECT n, line,
                   ({ends} OR {inside} OR {unmarked})
                   AND NOT (regexp_matches(line, '[{marks}]|[!?]{{2}}')
                            AND ({many(shouted)} OR {many(count(SEPARATORS))} OR {many(count(MARKUP))}))
                   AND (length(line) > {rules.boilerplate_chars} OR NOT ({furniture})) AS passes
            FROM (SELECT n, unnest(string_split(whole, chr(10))) AS line FROM words)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
        ), judged AS (
            SELECT n, count(*) - count(DISTINCT line) AS n_dup_lines,
                   count(*) FILTER (NOT passes) AS n_lines_removed,
                   sum(length(regexp_replace(line, '{blank}+', '', 'g'))) FILTER (passes) AS left_chars
            FROM lines GROUP BY n
        ), counted AS (
            SELECT doc_id, len(words) AS n_words,
                   length(regexp_replace(whole, '{blank}+', '', 'g')) AS word_chars,
                   length(whole) - length(translate(whole, '{SYMBOLS}', '')) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_lines_removed, 0)::INTEGER AS n_lines_removed,
                   coalesce(left_chars, 0) AS left_chars
            FROM words LEFT JOIN covered USING (n) LEFT JOIN judged USING (n)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_removed,
               n_words < {rules.min_words}
                   OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
               NOT (n_words < {rules.min_words}
                    OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)
                   AND 100 * left_chars >= {100 - rules.max_lost_percent} * word_chars AS kept
        FROM counted
    """
