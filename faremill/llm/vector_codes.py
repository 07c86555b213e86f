"""Vector compression by product codes: integer k-means per part, nearest entries found with a GNAT.

Components become integers, vectors are cut into equal consecutive parts, and every part gets a codebook of a few
entries, moved for some rounds. The entries of a codebook are held in a geometric near-neighbour access tree: a node
has a few split points, every other entry belongs to the nearest of them, and for each pair of split point and child
the node knows the range of distances from the one to the entries of the other. A query's distances to the split points
then rule out whole children: those that lie strictly beyond the best distance found so far. Ranges and distances are
rounded apart, so that no rounding rules out an entry that could win or tie; what is left is decided on integers.

Spark reads the vectors, sums the parts of each entry and joins the sums of labels; inside a task numpy searches a batch of
vectors at once. What reaches the driver are the codebooks, of a size that does not depend on the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Split points of a node, and the entries below which a node is a list.
SPLITS, LEAF = 4, 3
#: Relative distance by which bounds are moved apart; rounding errors are some thousand times smaller.
SLACK = 1e-12
#: Integers below this keep all sums of a part within 64 bits; greater ones are Python integers.
SMALL = 1 << 26
LIMB = 31
#: Components that a task works on at a time.
AT_ONCE = 1 << 20

CODES = "vec_id long, label int, code array<int>, error decimal(38,0)"


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one point."""
    apart = rows - point
    return (apart * apart).sum(axis=1)


def _roots(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(values.astype(np.float64))


@dataclass
class Node:
    """``splits`` are entry numbers; child j holds the entries nearest to split j, which lie ``low[i, j]`` to ``high[i, j]`` from split i."""

    splits: list[int]
    children: list[Node | None]
    low: np.ndarray
    high: np.ndarray


def build(points: np.ndarray, members: list[int]) -> Node | None:
    """The tree over the entries ``members`` of ``points``; None without members. Split points are chosen far apart."""
    if not members:
        return None
    count = len(members) if len(members) <= LEAF else SPLITS
    splits = [members[0]]
    nearest = squared(points[members], points[members[0]])
    while len(splits) < count:
        order = [(-d, m) for d, m in zip(nearest.tolist(), members) if m not in splits]
        splits.append(min(order)[1])
        nearest = np.minimum(nearest, squared(points[members], points[splits[-1]]))
    rest = [m for m in members if m not in splits]
    owned: list[list[int]] = [[] for _ in splits]
    for m in rest:
        owned[min(range(count), key=lambda j: (squared(points[[splits[j]]], points[m])[0], j))].append(m)
    low, high = np.zeros((count, count)), np.zeros((count, count))
    for i, split in enumerate(splits):
        for j, own in enumerate(owned):
            if own:
                away = _roots(squared(points[own], points[split]))
                low[i, j], high[i, j] = away.min() * (1 - SLACK), away.max() * (1 + SLACK)
    return Node(splits, [build(points, own) for own in owned], low, high)


class Gnat:
    """Exact nearest entries of a codebook; of equally near ones that of the lowest number."""

    def __init__(self, points: np.ndarray):
        self.points, self.root = points, build(points, list(range(len(points))))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance of every row."""
        found = np.full(len(rows), -1, np.int64)
        best = np.zeros(len(rows), rows.dtype)
        self._search(self.root, rows, np.arange(len(rows)), found, best)
        return found, best

    def _search(self, node: Node | None, rows: np.ndarray, own: np.ndarray, found: np.ndarray, best: np.ndarray) -> None:
        if node is None or not len(own):
            return
        away = np.empty((len(node.splits), len(own)))
        for i, split in enumerate(node.splits):
            exact = squared(rows[own], self.points[split])
            before = found[own]
            wins = (before < 0) | (exact < best[own]) | ((exact == best[own]) & (split < before))
            wins = wins.astype(bool)
            found[own[wins]], best[own[wins]] = split, exact[wins]
            away[i] = _roots(exact)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            reach = _roots(best[own]) * (1 + SLACK)
            # Strictly farther than the best, however the roots were rounded; an infinite distance rules out nothing.
            with np.errstate(invalid="ignore"):
                beyond = (away * (1 - SLACK) - reach > node.high[:, j, None]) | (away * (1 + SLACK) + reach < node.low[:, j, None])
            self._search(child, rows, own[~beyond.any(axis=0)], found, best)


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where all are small, else as Python integers."""
    scaled = np.floor(values * float(scale)) if values.size else values
    if not values.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    # A float beyond 2^53 is an integer, and scaling by a power of two only overflows.
    exact = [int(np.floor(x * scale)) if abs(x) < 2.0**53 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _vectors(column: pa.ListArray, dim: int, scale: int) -> np.ndarray:
    """Integer rows of a list column whose lists all have ``dim`` finite values."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _integers(flat.reshape(len(column), dim), scale)


def _slices(batches, dim: int) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, few enough at a time for vectors of any length."""
    step = max(1, AT_ONCE // dim)
    for batch in batches:
        for begin in range(0, batch.num_rows, step):
            yield batch.slice(begin, step)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding of the rows without null or non-finite components."""
    limit = F.lit(float("inf"))
    sound = F.forall("embedding", lambda x: F.coalesce((~F.isnan(x)) & (F.abs(x) < limit), F.lit(False)))
    return vectors.select("vec_id", "label", "embedding").where(F.coalesce(sound, F.lit(False)))


@dataclass
class Codebooks:
    """``books[p]`` holds the entries of part p as integer rows; ``dim`` is the length of the vectors, 0 without any."""

    dim: int
    books: list[np.ndarray]

    def numbers(self) -> Iterator[int]:
        """All integers by part, entry and position."""
        for book in self.books:
            yield from (int(x) for x in book.ravel().tolist())


def _first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    order = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))
    usable = kept.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    head = usable.orderBy(*order).select(F.size("embedding").alias("dim")).first()
    if head is None:
        return Codebooks(0, [])
    rows = usable.where(F.size("embedding") == head.dim).orderBy(*order).limit(entries).select("embedding").collect()
    start = _integers(np.array([row.embedding for row in rows], np.float64), scale)
    return Codebooks(head.dim, list(np.stack(np.split(start, parts, axis=1))))


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """An integer as digits of LIMB bits, the last one signed, so that any sum of them fits into 64 bits."""
    place = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def _moved(kept: DataFrame, codes: Codebooks, scale: int) -> Codebooks:
    """One round: every entry becomes the floored mean of the parts nearest to it; one without parts stays."""
    dim, books = codes.dim, codes.books
    width = dim // len(books)

    def work(batches):
        trees = [Gnat(book) for book in books]
        counts = [[0] * len(book) for book in books]
        sums = [[[0] * width for _ in book] for book in books]
        for batch in _slices(batches, dim):
            rows = _vectors(batch.column(0), dim, scale)
            for p, tree in enumerate(trees):
                part = rows[:, p * width : (p + 1) * width]
                found, _ = tree.nearest(part)
                for e in np.unique(found).tolist():
                    own = part[found == e]
                    counts[p][e] += len(own)
                    sums[p][e] = [a + int(b) for a, b in zip(sums[p][e], own.sum(axis=0).tolist())]
        out = [
            (p, e, at, place, digit)
            for p in range(len(books))
            for e, n in enumerate(counts[p])
            if n
            for at, value in enumerate([*sums[p][e], n])
            for place, digit in _limbs(value)
        ]
        if out:
            names = ("part", "entry", "at", "place", "digit")
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    rows = (
        kept.select("embedding")
        .mapInArrow(work, "part int, entry int, at int, place int, digit long")
        .groupBy("part", "entry", "at", "place")
        .agg(F.sum("digit").alias("digit"))
        .collect()
    )
    totals: dict[tuple[int, int, int], int] = {}
    for row in rows:
        key = (row.part, row.entry, row["at"])
        totals[key] = totals.get(key, 0) + (row.digit << (LIMB * row.place))
    moved = []
    for p, book in enumerate(books):
        lines = []
        for e, entry in enumerate(book.tolist()):
            n = totals.get((p, e, width), 0)
            lines.append([totals.get((p, e, at), 0) // n for at in range(width)] if n else entry)
        large = any(abs(x) >= SMALL for line in lines for x in line)
        moved.append(np.array(lines, dtype=object if large else np.int64))
    return Codebooks(dim, moved)


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks of all kept vectors.

    They start as the parts of the ``entries`` smallest vec_ids (null last, repeated ids by their vectors). Each round reads
    the vectors once; a task sends one sum per entry and position. All arithmetic is on integers, so the order of rows
    and tasks changes nothing.
    """
    kept = kept_vectors(vectors)
    codes = _first_entries(kept, parts, entries, scale)
    if codes.dim:
        kept = kept.where(F.size("embedding") == codes.dim)
        for _ in range(rounds):
            codes = _moved(kept, codes, scale)
    return codes


def encoded(vectors: DataFrame, codes: Codebooks, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code (an entry number per part) and error (squared distance, over all parts) of every kept vector.

    Dropped are vectors that are null, hold null or non-finite components, or are not of the codebooks' length; repeated rows
    are encoded each. An error beyond 38 digits is null. Other columns are ignored.
    """
    kept = kept_vectors(vectors).where(F.size("embedding") == F.lit(codes.dim)).where(F.lit(codes.dim > 0))
    dim, books = codes.dim, codes.books

    def work(batches):
        trees, width = [Gnat(book) for book in books], dim // len(books)
        for batch in _slices(batches, dim):
            rows = _vectors(batch.column(2), dim, scale)
            found, away = zip(*(tree.nearest(rows[:, p * width : (p + 1) * width]) for p, tree in enumerate(trees)))
            numbers = np.stack(found, axis=1).astype(np.int32)
            offsets = pa.array(np.arange(0, numbers.size + 1, len(trees), dtype=np.int32))
            total = [sum(map(int, each)) for each in zip(*away)]
            errors = pa.array([t if t < 10**38 else None for t in total], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, errors], ["vec_id", "label", "code", "error"])

    typed = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "embedding")
    return typed.mapInArrow(work, CODES)


def decoded(rows: DataFrame, codes: Codebooks, scale: int = SCALE) -> DataFrame:
    """``rows`` (with a ``code``) and the ``vector`` that the code stands for: the entries of its parts, scaled back."""
    books = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in e)) for e in book.tolist())) for book in codes.books))
    pairs = F.arrays_zip(books.alias("book"), F.col("code"))
    return rows.withColumn("vector", F.flatten(F.transform(pairs, lambda p: F.get(p["book"], p["code"]))))


def hex_code(code: Column) -> Column:
    """Two hex digits for each entry number, in the order of parts."""
    return F.array_join(F.transform(code, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
