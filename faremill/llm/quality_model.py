"""Quality classifier: regularised quadratic discriminant over statistics of a document's text.

Each class (label 1, label 0) gets a Gaussian over transformed statistics. Its covariance is shrunk towards the pooled
one and that towards a multiple of the identity, so that a class of few rows, or a statistic that hardly varies, still
has a sound inverse. The score is the logistic of the difference of the two log densities plus the log odds of the
classes; densities come from Mahalanobis distances solved with Cholesky factors that are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from faremill.llm.store import let_go, with_text_batches
from faremill.llm.words import BLANKS, WordHasher

STATISTICS = (
    "log_word_bytes",
    "spread_word_bytes",
    "symbol_rate",
    "exclamation_rate",
    "upper_share",
    "line_rate",
    "sentence_end_share",
    "short_word_share",
    "adjacent_repeat_share",
    "distinct_share",
)
#: Every text counts as so many words longer, of a neutral kind; else shares in a text of a few words say nothing.
NEUTRAL_WORDS = 20
NEUTRAL = {"bytes": 5.5, "square_bytes": 42.0, "upper": 0.025, "line": 0.02, "sentence_end": 0.08, "short": 0.35}
#: Share of the pooled covariance in that of a class, and of the identity in both.
TO_POOLED, TO_IDENTITY = 0.3, 0.05
FOLDS, HELD_OUT_FOLD = 3, 1


def _member(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(characters)] = 1
    return table


_CLASSES = {
    "symbol": _member(b"#*$%&|<>"),
    "exclamation": _member(b"!"),
    "upper": _member(bytes(range(65, 91))),
    "line": _member(b"\n"),
}
_SENTENCE_END = _member(b".!?").astype(bool)


def statistics(texts: list[bytes | None], hasher: WordHasher) -> np.ndarray:
    """One row of STATISTICS per text; those of an empty text are the neutral ones."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for block in hasher.blocks(texts):
        own = texts[block.first : block.first + block.texts]
        edges = np.concatenate([[0], np.cumsum([len(t or b"") + 1 for t in own])])
        padded = np.append(block.buffer, np.uint8(10))  # the joint after the last text

        def per_text(table: np.ndarray) -> np.ndarray:
            return np.add.reduceat(table[padded], edges[:-1])

        count = {name: per_text(table).astype(float) for name, table in _CLASSES.items()}
        count["line"] -= 1  # the joint itself
        words = np.diff(block.bounds).astype(float)
        owner = np.repeat(np.arange(block.texts), np.diff(block.bounds))

        def by_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, values, minlength=block.texts)

        sizes = (block.ends - block.starts).astype(float)
        ends = _SENTENCE_END[block.buffer[block.ends - 1]] if len(block.ends) else np.zeros(0, bool)
        again = np.zeros(len(owner))
        again[1:] = (block.hashes[1:] == block.hashes[:-1]) & (owner[1:] == owner[:-1])
        distinct = np.array([len(np.unique(block.hashes[a:b])) for a, b in zip(block.bounds[:-1], block.bounds[1:])])
        all_words = words + NEUTRAL_WORDS

        def rate(found: np.ndarray, neutral: float = 0.0) -> np.ndarray:
            return (found + NEUTRAL_WORDS * neutral) / all_words

        mean = rate(by_text(sizes), NEUTRAL["bytes"])
        spread = np.sqrt(np.maximum(rate(by_text(sizes * sizes), NEUTRAL["square_bytes"]) - mean * mean, 0))
        out[block.first : block.first + block.texts] = np.column_stack(
            [
                np.log1p(mean),
                np.log1p(spread),
                np.log1p(20 * rate(count["symbol"])),
                np.log1p(20 * rate(count["exclamation"])),
                np.sqrt(rate(count["upper"], NEUTRAL["bytes"] * NEUTRAL["upper"]) / mean),
                np.log1p(20 * rate(count["line"], NEUTRAL["line"])),
                np.sqrt(rate(by_text(ends.astype(float)), NEUTRAL["sentence_end"])),
                rate(by_text((sizes <= 3).astype(float)), NEUTRAL["short"]),
                np.sqrt(rate(by_text(again))),
                np.log((distinct + NEUTRAL_WORDS) / all_words),
            ]
        )
    return out


@dataclass
class Discriminant:
    """Centres, Cholesky factors and prior of the two classes, over statistics scaled by ``centre`` and ``scale``."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_odds: float
    constant: float | None = None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        scaled = (rows - self.centre) / self.scale
        logs = []
        for mean, factor in zip(self.means, self.factors):
            along = np.linalg.solve(factor, (scaled - mean).T)
            logs.append(-0.5 * (along * along).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.log_odds, -500, 500)))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics x0, x1, ... of every row."""
    names = [f"x{i}" for i in range(len(STATISTICS))]

    def work(batches):
        let_go()
        hasher = WordHasher(BLANKS)
        for batch in batches:
            rows = statistics(batch.column(1).cast(pa.binary()).to_pylist(), hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[:, i]) for i in range(rows.shape[1]))], ["doc_id", *names]
            )

    schema = "doc_id long, " + ", ".join(f"{name} double" for name in names)
    return with_text_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(work, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether labels of a row are kept from the fit."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """The model from all labelled rows that are not held out.

    A doc_id with several labels has the lowest of them; labels other than 0 and 1 are none. Only the sums of
    the statistics and of their products per class reach the driver.
    """
    given = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    given = given.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    size = len(STATISTICS)
    products = [(i, j) for i in range(size) for j in range(i, size)]
    rows = (
        text_statistics(docs)
        .join(given, "doc_id")
        .groupBy("quality")
        .agg(
            F.count("*").alias("n"),
            *(F.sum(f"x{i}").alias(f"s{i}") for i in range(size)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in products),
        )
        .collect()
    )
    counts, sums, squares = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
    for row in rows:
        counts[row.quality] = row.n
        sums[row.quality] = [row[f"s{i}"] for i in range(size)]
        for i, j in products:
            squares[row.quality, i, j] = squares[row.quality, j, i] = row[f"p{i}_{j}"]
    return discriminant(counts, sums, squares)


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """The model from counts, sums and sums of products of the two classes."""
    size = sums.shape[1]
    if not counts.all():  # one class alone, or no labels: its share, or an even score
        share = counts[1] / counts.sum() if counts.sum() else 0.5
        return Discriminant(np.zeros(size), np.ones(size), [], [], 0.0, float(share))
    total = counts.sum()
    centre = sums.sum(axis=0) / total
    spread = np.diag(squares.sum(axis=0)) / total - centre * centre
    scale = np.sqrt(np.where(spread > 1e-12, spread, 1.0))
    means, scatter = [], []
    for n, s, p in zip(counts, sums, squares):
        mean = s / n
        means.append((mean - centre) / scale)
        scatter.append((p - n * np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = (scatter[0] + scatter[1]) / total
    factors = []
    for n, own in zip(counts, scatter):
        covariance = (1 - TO_POOLED) * own / n + TO_POOLED * pooled
        even = max(np.trace(covariance) / size, 1e-3)
        factors.append(np.linalg.cholesky((1 - TO_IDENTITY) * covariance + TO_IDENTITY * even * np.eye(size)))
    return Discriminant(centre, scale, means, factors, float(np.log(counts[1] / counts[0])))


def with_scores(docs: DataFrame, model: Discriminant, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score; the text is read once and nothing is shuffled."""
    if column in docs.columns:
        raise ValueError(f"{column} is a column already")
    place = docs.columns.index("text")

    def work(batches):
        let_go()
        hasher = WordHasher(BLANKS)
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            scores = pa.array(model.scores(statistics(texts, hasher)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, column])

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return with_text_batches(docs).mapInArrow(work, schema)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text); other columns are ignored.

    ``labels`` has doc_id and quality. A null text counts as empty; empty texts are scored by the model like any other.
    Repeated rows are scored each, and count as often in the fit. A null doc_id is scored and has no label. Without
    labels of both classes the score is the share of label 1, or 0.5 without any.
    """
    docs = docs.select("doc_id", "text")
    scored = with_scores(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, all columns as they are."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    return with_scores(docs, fit(docs, labels), name).where(F.col(name) >= 0.5).drop(name)
