"""Quality rules as a short-circuit cascade, in Spark's own functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = r"[ \t\n\x0B\f\r]"
_SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = CAPITALS + CAPITALS.lower()

#: Rows the costs and selectivities are estimated on.
SAMPLE_ROWS = 2_000
#: Timed passes of each rule over the sample.
PASSES = 5


def _count_of(characters: str) -> Column:
    return (F.length("text") - F.length(F.translate("text", characters, ""))).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a text to reject; it may use the columns of :func:`measured`."""

    name: str
    fails: Column


def default_rules() -> list[Rule]:
    n_words, lines = F.col("n_words"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        Rule("capitals", 2 * _count_of(CAPITALS) > _count_of(LETTERS)),
        Rule("symbols", 10 * F.col("n_symbols") > n_words),
        Rule("exclamations", 5 * _count_of("!") > n_words),
        Rule("repeated lines", 2 * F.col("n_dup_lines") > F.size(lines)),
        Rule("word length", (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 20 * n_words)),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the base counts.

    Repeated three-word windows are neighbours once the window hashes of a text
    are sorted; a word counts once however many of them cover it. All of it stays in
    the row: no window leaves its document and nothing is shuffled.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("words", F.filter(F.split("text", f"{_BLANK}+", -1), lambda x: x != ""))
    size = F.size("words")

    def word(i, k):
        return F.get("words", i + k)

    grams = F.when(
        size >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), size - 3),
                lambda i: F.struct(F.xxhash64(word(i, 0), word(i, 1), word(i, 2)).alias("h"), i.alias("i")),
            )
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = rows.withColumn("grams", grams)
    again = F.filter(
        "grams",
        lambda x, k: (F.get("grams", k + 1)["h"] == x["h"]) | F.coalesce(F.get("grams", k - 1)["h"] == x["h"], F.lit(False)),
    )
    rows = rows.withColumn("again", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("again", lambda x, k: F.coalesce(F.least(F.get("again", k + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0).cast("bigint"),
        lambda n, x: n + x,
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "doc_id",
        "text",
        size.cast("bigint").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("bigint").alias("word_chars"),
        _count_of(SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejects: float  #: share of the sample
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejects / self.seconds


def estimated(sample: DataFrame, rules: list[Rule], passes: int = PASSES) -> list[Estimate]:
    """Rules by rejection per cost, best first.

    ``sample`` has the columns of :func:`measured`. It is measured once and kept in memory
    while each rule runs over it alone. Every rule and an empty pass run once to be compiled
    and then ``passes`` times in turn; the cost is the quickest pass less the quickest empty
    one, so neither start-up nor a busy moment puts a rule back.
    """
    sample = sample.persist()
    try:
        sample.count()

        def run(column: Column) -> tuple[float, float]:
            start = time.perf_counter()
            value = sample.agg(F.avg(column.cast("int")).alias("v")).first()["v"]
            return value or 0.0, time.perf_counter() - start

        columns = [F.lit(False), *(rule.fails for rule in rules)]
        shares = [run(column)[0] for column in columns]
        turns = [[run(column)[1] for column in columns] for _ in range(passes)]
    finally:
        sample.unpersist()
    empty, *quickest = (min(times) for times in zip(*turns, strict=True))
    found = [
        Estimate(rule, share, max(took - empty, 1e-3))
        for rule, share, took in zip(rules, shares[1:], quickest, strict=True)
    ]
    return sorted(found, key=lambda e: (-e.worth, e.rule.name))


def cascade(ordered: list[Rule]) -> Column:
    """True for a text that no rule rejects; rules after the first that does are not run."""
    verdict = F.when(F.lit(False), F.lit(False))
    for rule in ordered:
        verdict = verdict.when(rule.fails, F.lit(False))
    return verdict.otherwise(F.lit(True))


def judged(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null text is empty:
    no words, so it fails the base. The order of the rules is learnt from a sample and
    changes the time a row takes, never its verdict. Repeated rows and rows without
    an id are judged each on its own.
    """
    rules = default_rules() if rules is None else rules
    ordered = [e.rule for e in estimated(measured(first_rows(docs, sample_rows)), rules)]
    rows = measured(docs).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered)).alias("kept"),
    )


def first_rows(docs: DataFrame, rows: int) -> DataFrame:
    """The first rows by id hash. Only the ids are ordered; texts are read where they pass."""
    place = F.xxhash64(F.col("doc_id").cast("bigint"))
    last = docs.select(place.alias("place")).orderBy("place").limit(rows).agg(F.max("place")).first()[0]
    chosen = docs.select("doc_id", "text")
    return chosen.where(place <= last).limit(rows) if last is not None else chosen.limit(0)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM d
), g AS (
  SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), r AS (
  SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
), n AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, text, lines, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN n ON w.rid = n.rid
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^A-Za-z]', '', 'g'))
    OR 10 * n_symbols > n_words
    OR 5 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
    OR 2 * n_dup_lines > len(lines)
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""
