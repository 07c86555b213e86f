"""Toxicity: every significant passage by maximum-scoring segment search, calibrated as extreme values.

A token's weight is the log odds of its rate in toxic and in other labelled documents, under Dirichlet priors that hold both
rates equal, moved towards 0 by a multiple of its standard error. Every token costs a small drift, so a passage is a
stretch whose toxic tokens outweigh the others. All maximal scoring stretches of a text come from one linear scan (Ruzzo
and Tompa). With lambda the positive root of E[exp(lambda s)] = 1 over the token scores of all documents, the greatest
score of n background tokens is an extreme value, and a passage of score s has the expected number
E = K n exp(-lambda s). A document's evidence is the sum of -ln E over its significant passages, or that of the best one;
a logistic curve over evidence gives the score.

Weights come from a sample of labelled documents of documented size; K and the curve from the same documents, each
scored with weights that its own fold had no part in. The background counts all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import saved, with_text_batches
from faremill.llm.words import NON_WORD, Block, WordHasher

#: Labelled documents that the weights are learnt from at most: those with the smallest hashes of their ids.
LABELLED_DOCS = 200_000
#: Cells of token hashes; a cell has one weight.
CELLS = 1 << 20
#: Documents' worth of prior counts of a token, dealt to the classes by their sizes.
PRIOR = 5.0
#: Standard errors by which a weight is moved towards 0, and what every token costs.
CAUTION, DRIFT = 2.0, 0.2
#: Weights nearer to 0 than this are 0: many such tokens of one line would add up to what none of them says.
LEAST_WEIGHT = 0.5
#: Labels are held out by one fold of this many; the others are also the folds of the calibration.
FOLDS, HELD_OUT_FOLD = 5, 0
#: Passages that fewer background documents than this would show by chance are significant.
SIGNIFICANT = 0.05
#: Score bins of the background, a bin being 1 / SCORE_STEPS; and evidence bins of the calibration.
SCORE_STEPS, SCORE_BINS = 16, 1 << 10
EVIDENCE_STEPS, LEAST_EVIDENCE = 4, -2.0
#: Prior documents of either class in the calibration, and the least slope of its curve.
FEW, LEAST_SLOPE = 1.0, 1.0
#: Expected number of a passage below which smaller ones are told apart no more.
LEAST_EXPECTED = 1e-300


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(begin, end, score) of all maximal scoring segments of a sequence, in order; linear in its length.

    The scan looks at the positive scores only, with running sums for what lies between. Each open segment knows the
    nearest earlier one that begins at a lower sum, so no search passes a segment twice. Of two stretches of equal score the
    shorter counts, as the algorithm has it.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    total = np.cumsum(scores)
    left, right = (total[places] - scores[places]).tolist(), total[places].tolist()
    begins: list[int] = []
    ends: list[int] = []
    lows: list[float] = []
    highs: list[float] = []
    lower: list[int] = []
    for place, low, high in zip(places.tolist(), left, right):
        begin = place
        while True:
            near = len(lows) - 1
            while near >= 0 and lows[near] >= low:
                near = lower[near]
            if near < 0 or highs[near] >= high:
                break
            begin, low = begins[near], lows[near]
            del begins[near:], ends[near:], lows[near:], highs[near:], lower[near:]
        begins.append(begin)
        ends.append(place + 1)
        lows.append(low)
        highs.append(high)
        lower.append(near)
    return [(b, e, h - lo) for b, e, lo, h in zip(begins, ends, lows, highs)]


@dataclass
class Weights:
    """Cells with a weight, ascending, and a weight per table: all training documents, then one table per fold left out."""

    cells: np.ndarray
    tables: np.ndarray

    def lookup(self, table: int) -> np.ndarray:
        """The score of a token of every cell."""
        scores = np.full(CELLS, -DRIFT)
        scores[self.cells] += self.tables[table]
        return scores


@dataclass
class Calibration:
    """``rate`` is lambda, ``factor`` K; the curve is the logistic of slope * compressed(evidence) + offset."""

    rate: float
    factor: float
    slope: float
    offset: float

    def expected(self, score: float, tokens: int) -> float:
        """How many passages of this score or more the background would show in so many tokens."""
        return max(self.factor * tokens * np.exp(-self.rate * score), LEAST_EXPECTED)

    def evidence(self, found: list[float], tokens: int) -> float:
        values = [-np.log(self.expected(score, tokens)) for score in found]
        strong = [v for v in values if v > -np.log(SIGNIFICANT)]
        return sum(strong) if strong else max(values, default=LEAST_EVIDENCE)

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * compressed(evidence) + self.offset, -500, 500))))


def compressed(evidence):
    """Evidence on a scale from 0 on that long texts with many passages do not dominate."""
    return np.log(1 + np.maximum(evidence, LEAST_EVIDENCE) - LEAST_EVIDENCE)


@dataclass
class Model:
    weights: Weights
    calibration: Calibration


def token_scores(lookup: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The scores of a text's tokens; a token that repeats the one before it says nothing new and only costs its drift."""
    scores = lookup[cells]
    if len(cells):
        scores[1:][cells[1:] == cells[:-1]] = -DRIFT
    return scores


def _fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of a row are kept from the fit."""
    return F.coalesce(_fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def cells_of(block: Block) -> np.ndarray:
    """The cell of every token of a block of texts."""
    return (block.hashes % np.uint64(CELLS)).astype(np.int64)


def _labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """toxic, fold and text of the documents in the sample.

    The sample has at most ``limit`` rows of two numbers, which is the bound of the broadcast; it has an order of its own
    that does not depend on the labels.
    """
    given = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    given = given.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    sample = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = sample.select(F.col("doc_id").alias("of_doc"), "toxic", _fold().cast("int").alias("fold"))
    joined = docs.join(F.broadcast(sample), docs["doc_id"] == sample["of_doc"])
    return joined.select("toxic", "fold", "text")


def token_counts(labelled: DataFrame) -> DataFrame:
    """cell, toxic, fold and n, the number of documents with a token of the cell; added up in each task first."""

    def work(batches):
        hasher = WordHasher(NON_WORD)
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            kinds = np.array(batch.column(1)) * 2 + np.array(batch.column(0))
            for block in hasher.blocks(batch.column(2).cast(pa.binary()).to_pylist()):
                cells = cells_of(block)
                for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:]), block.first):
                    table = counts.setdefault(int(kinds[i]), np.zeros(CELLS, np.uint32))
                    table[np.unique(cells[a:b])] += 1
        for kind, table in counts.items():
            used = np.flatnonzero(table)
            for begin in range(0, len(used), 1 << 16):
                own = used[begin : begin + (1 << 16)]
                fixed = [np.full(len(own), value, np.int32) for value in (kind % 2, kind // 2)]
                columns = [own.astype(np.int32), *fixed, table[own].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "toxic", "fold", "n"])

    rows = labelled.select("toxic", "fold", "text")
    return with_text_batches(rows).mapInArrow(work, "cell int, toxic int, fold int, n long")


def weight(toxic: np.ndarray, other: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Cautious log odds of tokens from their counts in the two classes and the classes' totals."""
    share = totals[0] / (totals[0] + totals[1])
    a, b = toxic + PRIOR * share, other + PRIOR * (1 - share)
    odds = np.log(a / b) - np.log(share / (1 - share))
    sure = np.abs(odds) - CAUTION * np.sqrt(1 / a + 1 / b)
    return np.where(sure < LEAST_WEIGHT, 0.0, np.sign(odds) * sure)


def fitted_weights(labelled: DataFrame) -> Weights:
    """All cells whose weight is not 0 in some table. What reaches the driver are at most CELLS rows of the sample's counts."""
    folds = [f for f in range(FOLDS) if f != HELD_OUT_FOLD]
    kinds = [(f, y) for f in folds for y in (0, 1)]
    sums = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"n{f}_{y}") for f, y in kinds]
    counts = saved(token_counts(labelled).groupBy("cell").agg(*sums), "token-counts")
    total = counts.agg(*(F.sum(f"n{f}_{y}").alias(f"n{f}_{y}") for f, y in kinds)).first()
    toxic = sum((F.col(f"n{f}_1") for f in folds), F.lit(0))
    other = sum((F.col(f"n{f}_0") for f in folds), F.lit(0))
    totals = {(f, y): float(total[f"n{f}_{y}"] or 0) for f, y in kinds}
    everywhere = tuple(sum(totals[f, y] for f in folds) for y in (1, 0))
    none = Weights(np.zeros(0, np.int64), np.zeros((1 + len(folds), 0)))
    if not all(everywhere):
        return none
    # A cell below both bounds has weight 0 in every table: one toxic document is within the error, and so is a lack of them.
    fewest = PRIOR * everywhere[1] / everywhere[0]
    rows = counts.where((toxic >= 2) | (other >= F.lit(max(2.0, fewest / 4)))).toPandas().sort_values("cell")
    tables = []
    for left_out in (None, *folds):
        used = [f for f in folds if f != left_out]
        in_class = [tuple(sum(totals[f, y] for f in used) for y in (1, 0))][0]
        if not all(in_class):
            tables.append(np.zeros(len(rows)))
            continue
        t, o = (sum(rows[f"n{f}_{y}"].to_numpy(float) for f in used) for y in (1, 0))
        tables.append(weight(t, o, in_class))
    tables = np.array(tables)
    some = np.flatnonzero(tables.any(axis=0))
    return Weights(rows["cell"].to_numpy(np.int64)[some], tables[:, some])


def background(docs: DataFrame, weights: Weights) -> np.ndarray:
    """How many tokens of all documents fall into each score bin; a task sends one row per bin it has met."""
    shared = docs.sparkSession.sparkContext.broadcast((weights.cells.tobytes(), weights.tables[0].tobytes()))

    def work(batches):
        hasher, lookup = WordHasher(NON_WORD), _lookup(shared.value)
        bins = np.clip(np.round(lookup * SCORE_STEPS) + SCORE_BINS // 2, 0, SCORE_BINS - 1).astype(np.int64)
        counts = np.zeros(SCORE_BINS, np.int64)
        for batch in batches:
            for block in hasher.blocks(batch.column(0).cast(pa.binary()).to_pylist()):
                counts += np.bincount(bins[cells_of(block)], minlength=SCORE_BINS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bin", "n"])

    rows = with_text_batches(docs.select("text")).mapInArrow(work, "bin int, n long")
    counts = np.zeros(SCORE_BINS, np.int64)
    for row in rows.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row.bin] = row.n
    return counts


def _lookup(tables: tuple[bytes, bytes]) -> np.ndarray:
    cells, own = np.frombuffer(tables[0], np.int64), np.frombuffer(tables[1], np.float64)
    return Weights(cells, own[None, :]).lookup(0)


def extreme_rate(counts: np.ndarray) -> float:
    """The positive root of E[exp(rate * score)] = 1; 1 where no token, or none of a positive score, was counted."""
    scores = (np.arange(len(counts)) - len(counts) // 2) / SCORE_STEPS
    shares = counts / max(1, counts.sum())
    if not shares[scores > 0].any() or (shares * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (shares * np.exp(np.minimum(high * scores, 700.0))).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(np.minimum(middle * scores, 700.0))).sum() < 1 else (low, middle)
    return high


def _segment_rows(labelled: DataFrame, weights: Weights) -> DataFrame:
    """toxic, tokens and passage scores of every labelled document, by the weights that its fold had no part in."""
    folds = [f for f in range(FOLDS) if f != HELD_OUT_FOLD]
    shared = labelled.sparkSession.sparkContext.broadcast((weights.cells.tobytes(), weights.tables.tobytes()))

    def work(batches):
        cells = np.frombuffer(shared.value[0], np.int64)
        tables = Weights(cells, np.frombuffer(shared.value[1], np.float64).reshape(FOLDS, len(cells)))
        hasher = WordHasher(NON_WORD)
        lookups = {fold: tables.lookup(i) for i, fold in enumerate(folds, 1)}
        for batch in batches:
            fold, out = batch.column(1).to_pylist(), []
            for block in hasher.blocks(batch.column(2).cast(pa.binary()).to_pylist()):
                own = cells_of(block)
                for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:]), block.first):
                    out.append((int(b - a), [s for _, _, s in maximal_segments(token_scores(lookups[fold[i]], own[a:b]))]))
            if out:
                tokens, scores = zip(*out)
                columns = [batch.column(0), pa.array(tokens, pa.int64()), pa.array(scores, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "tokens", "scores"])

    rows = labelled.select(F.col("toxic").cast("int"), "fold", "text")
    return with_text_batches(rows).mapInArrow(work, "toxic int, tokens long, scores array<double>")


def calibrated(labelled: DataFrame, weights: Weights, counts: np.ndarray) -> Calibration:
    """K by maximum likelihood from the best passages of other documents; the curve from evidence of both classes.

    Sums are of whole numbers, so the order of rows changes nothing; only counts by bin reach the driver.
    """
    rate = extreme_rate(counts)
    found = saved(_segment_rows(labelled, weights), "passages")
    classes = {row.toxic: row.n for row in found.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not classes.get(0) or not classes.get(1):
        share = classes.get(1, 0) / max(1, sum(classes.values())) if classes else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Calibration(rate, 1.0, 0.0, float(np.log(share / (1 - share))))
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    mass = F.round(F.col("tokens") * F.exp(-rate * best) * F.lit(1 << 20)).cast("decimal(38,0)")
    row = found.where("toxic = 0").agg(F.count("*").alias("n"), F.sum(mass).alias("mass")).first()
    factor = row.n * float(1 << 20) / float(row.mass) if row.mass else 1.0
    each = F.transform("scores", lambda s: rate * s - F.log(F.lit(factor) * F.col("tokens")))
    strong = F.filter(each, lambda v: v > F.lit(-float(np.log(SIGNIFICANT))))
    summed = F.aggregate(strong, F.lit(0.0), lambda a, v: a + v)
    evidence = F.when(F.size(strong) > 0, summed).otherwise(F.coalesce(F.array_max(each), F.lit(LEAST_EVIDENCE)))
    bins = F.floor(F.greatest(evidence, F.lit(LEAST_EVIDENCE)) * EVIDENCE_STEPS).cast("int")
    bins = F.least(bins, F.lit(200 * EVIDENCE_STEPS))
    rows = found.groupBy(bins.alias("bin"), "toxic").agg(F.count("*").alias("n")).collect()
    x = compressed(np.array([(r.bin + 0.5) / EVIDENCE_STEPS for r in rows]))
    slope, offset = logistic(x, np.array([r.toxic for r in rows], float), np.array([r.n for r in rows], float))
    return Calibration(rate, factor, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned outcomes; the slope is LEAST_SLOPE at least.

    Prior outcomes of either kind, at both ends, keep the curve finite where the classes do not overlap.
    """
    order = np.lexsort((y, x))
    x, y, n = x[order], y[order], n[order]
    ends = np.array([x.min(), x.max()])
    x, y, n = np.concatenate([x, ends, ends]), np.concatenate([y, [0, 0, 1, 1]]), np.concatenate([n, np.full(4, FEW)])

    def solved(rows: np.ndarray, known: np.ndarray) -> np.ndarray:
        beta = np.zeros(rows.shape[1])
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(rows @ beta + known, -500, 500)))
            curve = (rows * (n * p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(rows.shape[1])
            step = np.linalg.solve(curve, rows.T @ (n * (y - p)))
            beta += np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-10:
                break
        return beta

    slope, offset = solved(np.stack([x, np.ones(len(x))], axis=1), np.zeros(len(x)))
    if slope < LEAST_SLOPE:
        slope, (offset,) = LEAST_SLOPE, solved(np.ones((len(x), 1)), LEAST_SLOPE * x)
    return float(slope), float(offset)


def fit(docs: DataFrame, labels: DataFrame, labelled_docs: int = LABELLED_DOCS) -> Model:
    """The model of labelled documents outside the held-out fold, and of the token scores of all documents."""
    rows = docs.select("doc_id", "text")
    labelled = _labelled(rows, labels, labelled_docs)
    weights = fitted_weights(labelled)
    return Model(weights, calibrated(labelled, weights, background(rows, weights)))


PASSAGES = "doc_id long, score double, passages array<struct<begin: int, end: int, text: string, score: double, expected: double>>"


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the significant passages of every row of ``docs`` (doc_id, text).

    A passage has its begin and end (code points, end exclusive), its text, its segment score and the number of
    such passages expected by chance. Passages are in order and never overlap; of equal scores all are given. A
    null, empty or tokenless text has none and the score of the least evidence. Repeated rows are scored each; a null
    doc_id is passed on; other columns are ignored.
    """
    packed = model.weights.cells.tobytes(), model.weights.tables[0].tobytes()
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    curve = model.calibration
    spans = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("score", pa.float64()), ("expected", pa.float64())])

    def work(batches):
        hasher, lookup = WordHasher(NON_WORD), _lookup(shared.value)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            scores, passages = [], []
            for block in hasher.blocks(texts):
                cells = cells_of(block)
                ends = np.cumsum([0, *(len(texts[block.first + i] or b"") + 1 for i in range(block.texts))])
                for i, (a, b) in enumerate(zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist())):
                    found = maximal_segments(token_scores(lookup, cells[a:b]))
                    scores.append(curve.score(curve.evidence([s for _, _, s in found], b - a)))
                    own = texts[block.first + i] or b""
                    passages.append(list(_spans(own, block, int(ends[i]), a, found, curve, b - a)))
            if scores:
                columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, pa.list_(spans))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_text_batches(rows).mapInArrow(work, PASSAGES)


def _spans(text: bytes, block: Block, offset: int, first: int, found: list, curve: Calibration, tokens: int) -> Iterator[dict]:
    """The significant passages of one text, in code points."""
    at = points = 0
    for begin, end, score in found:
        expected = curve.expected(score, tokens)
        if expected >= SIGNIFICANT:
            continue
        low, high = int(block.starts[first + begin]) - offset, int(block.ends[first + end - 1]) - offset
        points += len(text[at:low].decode("utf-8"))
        own = text[low:high].decode("utf-8")
        yield {"begin": points, "end": points + len(own), "text": own, "score": score, "expected": float(expected)}
        at, points = high, points + len(own)


def classified(docs: DataFrame, labels: DataFrame, labelled_docs: int = LABELLED_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages of every row of ``docs`` (doc_id, text); other columns are ignored.

    ``labels`` has doc_id and toxic; a doc_id with several labels has the lowest, other values than 0 and 1 are none. Without
    labels of both classes the score is the share of label 1, or 0.5 without any.
    """
    found = toxic_passages(docs, fit(docs, labels, labelled_docs))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
