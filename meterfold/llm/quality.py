"""Quality classifier with hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.decontaminate import words_of

#: Labelled documents the classifier is fitted on, the first by id hash.
SAMPLE_DOCS = 20_000
#: Words a lexicon may have; the standard errors, log odds ratio and documents that set
#: a word apart.
LEXICON_WORDS, LEXICON_Z, LEXICON_RATIO, LEXICON_DOCS = 400, 3.5, 2.0, 5
REJECT_FROM = 0.5

SHAPES = (
    "log words", "repeats next", "distinct words", "capitals", "symbols", "exclamations", "digits",
    "word length", "repeated lines", "repeated threes",
)
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


def shapes(data: bytes) -> list[float]:
    """Figures of a text that do not depend on its vocabulary."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(SHAPES)

    def amount(of: bytes) -> int:
        return len(data) - len(data.translate(None, of))

    lines = [x for x in data.split(b"\n") if x.strip()]
    threes = Counter(zip(words, words[1:], words[2:]))
    again = sum(c for c in threes.values() if c > 1)
    return [
        math.log1p(n),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        math.log1p(len(set(words))) / math.log1p(n),
        amount(_CAPITALS) / max(1, amount(_LETTERS)),
        min(2.0, amount(_SYMBOLS) / n),
        min(2.0, amount(b"!") / n),
        min(2.0, amount(b"0123456789") / n),
        min(30.0, sum(map(len, words)) / n),
        1 - len(set(lines)) / len(lines),
        again / max(1, n - 2),
    ]


@dataclass
class Head:
    """One yes-or-no question: its lexicon and a logistic model over shapes and lexicon."""

    lexicon: dict[bytes, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    base: float = -20.0  # log odds without evidence; so low if nothing was labelled

    def evidence(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(features))
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.weights[1:] + self.weights[0] - self.base, -30, 30)


HEADS = ("low", "toxic")


def _lexicon_features(words: set[bytes], lexicon: dict[bytes, float]) -> list[float]:
    found = [lexicon[w] for w in words if w in lexicon]
    total = sum(found)
    return [min(10.0, total / 4), float(len(found) > 0), float(len(found) > 1), 20 * total / (20 + len(words))]


def features(text: str | None, lexicons: list[dict[bytes, float]]) -> list[float]:
    found = shapes((text or "").encode("utf-8", "replace"))
    words = set(words_of(text))
    for lexicon in lexicons:
        found += _lexicon_features(words, lexicon)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word, by label; the word null stands for all documents."""
    for batch in batches:
        counts: dict[bytes | None, list[int]] = {}
        for text, *marks in zip(batch.column("text"), *(batch.column(h) for h in HEADS)):
            marks = [m.as_py() for m in marks]
            for word in [None, *set(words_of(text.as_py()))]:
                row = counts.setdefault(word, [0] * 4)
                for i, mark in enumerate(marks):
                    if mark is not None:
                        row[2 * i + (not mark)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary())] + [pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(4)],
            names=["word", "low_yes", "low_no", "toxic_yes", "toxic_no"],
        )


def _lexicon(counts: DataFrame, head: str, yes: int, no: int) -> dict[bytes, float]:
    """Words that documents with the label hold far more often, with their log odds ratio."""
    a, b = F.col(f"{head}_yes") + 0.5, F.col(f"{head}_no") + 0.5
    c, d = F.lit(yes + 1.0) - a, F.lit(no + 1.0) - b
    ratio = F.log(a / c) - F.log(b / d)
    ranked = counts.where(F.col("word").isNotNull() & (F.col(f"{head}_yes") >= LEXICON_DOCS)).select("word", ratio.alias("ratio"), (ratio / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)).alias("z"))
    top = ranked.where((F.col("z") > LEXICON_Z) & (F.col("ratio") > LEXICON_RATIO)).orderBy(F.desc("z"), "word").limit(LEXICON_WORDS)
    return {bytes(r["word"]): r["ratio"] for r in top.collect()}


def _featured(lexicons: list[dict[bytes, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), lexicons) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), *(batch.column(h) for h in HEADS)], names=["features", *HEADS]
            )

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        size = np.abs(step).max()
        w += step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, Head]:
    """Heads for low quality and toxicity from up to ``sample_docs`` labelled documents.

    Of several labels of one document the worse counts. A head without examples of
    both kinds has no evidence to give.
    """
    chosen = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
        .agg((F.min("quality") == 0).alias("low"), (F.max("toxic") == 1).alias("toxic"))
        .orderBy(F.xxhash64("label_id")).limit(sample_docs)
    )
    # At most sample_docs rows of three values: small enough to send to every task.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("label_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "label_id").select("text", *HEADS)
    sample = scratch.stored(sample, "labelled")
    counts = sample.mapInArrow(
        _counted, "word binary, low_yes bigint, low_no bigint, toxic_yes bigint, toxic_no bigint"
    )
    counts = scratch.stored(
        counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in counts.columns[1:]]), "words"
    )
    total = counts.where("word is null").first()
    heads = {h: Head() for h in HEADS}
    if total is None:
        return heads
    for name, head in heads.items():
        head.lexicon = _lexicon(counts, name, total[f"{name}_yes"], total[f"{name}_no"])
    lexicons = [heads[h].lexicon for h in HEADS]
    rows = sample.mapInArrow(_featured(lexicons), "features array<double>, low boolean, toxic boolean").collect()
    for name, head in heads.items():
        known = [r for r in rows if r[name] is not None]
        y = np.array([r[name] for r in known], dtype=float)
        if not len(y) or y.min() == y.max():
            head.base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if y.any() else -20.0
            continue
        x = np.array([r["features"] for r in known])
        head.mean, head.scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
        head.weights = _logistic(np.clip((x - head.mean) / head.scale, -8, 8), y)
        head.base = math.log(y.sum() / (len(y) - y.sum()))
    return heads


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _scored(heads: dict[str, Head]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = [heads[h].lexicon for h in HEADS]
        base = np.array([heads[h].base for h in HEADS])
        prior = 1 - np.prod(1 - _sigmoid(base))
        for batch in batches:
            x = np.array([features(t.as_py(), lexicons) for t in batch.column("text")]).reshape(batch.num_rows, -1)
            odds = [np.zeros(0)] * len(HEADS)
            if batch.num_rows:
                odds = [heads[h].evidence(x) + heads[h].base for h in HEADS]
            parts = [_sigmoid(o) for o in odds]
            bad = np.clip(1 - (1 - parts[0]) * (1 - parts[1]), 1e-12, 1 - 1e-12)
            evidence = np.log(bad / (1 - bad)) - math.log(prior / (1 - prior))
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(p) for p in parts), pa.array(bad), pa.array(evidence)],
                names=[*(n for n in batch.schema.names if n != "text"), "p_low", "p_toxic", "p_document", "evidence"],
            )

    return run


def _concentration(groups: DataFrame, rate: Column, around: Column) -> float:
    """How many documents the prior of a group weighs, by the moments of the group rates."""
    seen = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (rate - around) ** 2).alias("spread"),
        F.sum(F.col("n") * around * (1 - around)).alias("single"),
        F.count("*").alias("groups"),
    ).first()
    if not seen["n"] or not seen["single"]:
        return 1e4
    single = seen["single"] / seen["n"]
    between = (seen["spread"] - seen["groups"] * single) / seen["n"]
    return float(min(1e4, max(2.0, single / between - 1))) if between > 0 else 1e4


def scored(docs: DataFrame, heads: dict[str, Head], host: Column, path: Column) -> DataFrame:
    """Every document with the evidence of its text and the rates of its host and path.

    A host's rate of bad documents is shrunk towards the rate of all, a path's towards its
    host's, each by a weight that the spread of the groups themselves gives. Only sums
    per group are shuffled, combined before the shuffle; a host with a third of
    all documents is one row per task.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(
        _scored(heads),
        "doc_id bigint, host string, path string, digest string, p_low double, p_toxic double, p_document double, evidence double",
    )
    rows = scratch.stored(rows, "scored")
    paths = scratch.stored(
        rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_document").alias("s")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = min(1 - 1e-6, max(1e-6, (total["s"] or 0.0) / (total["n"] or 1)))
    own = F.col("s") / F.col("n")
    weight = _concentration(hosts, own, F.lit(mean))
    hosts = hosts.select("host", ((F.col("s") + weight * mean) / (F.col("n") + weight)).alias("host_rate"))
    paths = paths.join(hosts, "host")
    weight = _concentration(paths, own, F.col("host_rate"))
    paths = paths.select(
        "host", "path", "host_rate",
        ((F.col("s") + weight * F.col("host_rate")) / (F.col("n") + weight)).alias("path_rate"),
    )
    odds = F.log(F.col("path_rate") / (1 - F.col("path_rate"))) + F.col("evidence")
    return rows.join(paths, ["host", "path"]).withColumn("p_bad", 1 / (1 + F.exp(-odds)))


def classified(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | str = "source",
    path: Column | str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    reject_from: float = REJECT_FROM,
) -> DataFrame:
    """One row per row of ``docs`` with its probabilities and ``kept``.

    ``docs`` has ``doc_id``, ``text`` and the columns of ``host`` and ``path``; ``labels`` has ``doc_id``,
    ``quality`` and ``toxic``, 0 or 1. A document is bad if its quality is low or it is toxic. A
    null or empty text has the shapes of no text; a null host or path is a site of its
    own; null labels teach nothing, and without any label nothing is rejected.
    Repeated rows are judged each. Labels only fit the classifier: a document's own
    label is never looked up.
    """
    host = F.col(host) if isinstance(host, str) else host
    path = F.col(path) if isinstance(path, str) else path
    return scored(docs, fit(docs, labels, sample_docs), host, path).withColumn("kept", F.col("p_bad") < reject_from)


def kept(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    bad = classified(docs, labels, **settings).where("not kept").select("doc_id", "digest").distinct()
    rows = docs.select(
        F.struct("*").alias("kept_row"),
        F.col("doc_id").cast("bigint").alias("own_id"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own_digest"),
    )
    same = F.col("own_digest").eqNullSafe(F.col("digest")) & F.col("own_id").eqNullSafe(F.col("doc_id"))
    return rows.join(bad, same, "left_anti").select("kept_row.*")
