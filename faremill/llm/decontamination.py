"""Containment search: which benchmark items stand inside which documents.

An item is found in a document when at least ``percent`` of a hundred of its distinct word shingles stand there.
Jaccard MinHash fails for short items in long documents, since the similarity shrinks with the document. So items are
partitioned by size, and only the item side fixes the sketch: the signature of an item with q shingles are its MinHash
values of rank 1 to q - ceil(q * percent / 100) + 1. A document that lacks fewer shingles than that must hold one of
them, so no containment is missed. The greatest signature value of a partition bounds its hash range; of a document only
the shingles inside that range are looked at, whatever its length. Candidates are verified on the shingles' own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import saved, with_text_batches
from faremill.llm.words import NON_WORD, Block, WordHasher

#: Bits of the filter of one size partition. A crowded filter costs time and changes nothing.
FILTER_BITS = 1 << 23

ITEM = "item_row long, item_id long, n_shingles int, size_class int, hash long, shingle string, in_signature boolean"
EVIDENCE = "doc_row long, doc_id long, text_key long, hash long, shingle string"


Windows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _joined(parts: list[Windows]) -> Windows:
    return tuple(np.concatenate(column) for column in zip(*parts))


def _all_windows(block: Block, width: int) -> Windows:
    """Hash, first word, one past the last word, and text of all windows of so many words."""
    hashes = block.shingles(width)
    owner = np.repeat(np.arange(block.texts), np.diff(block.bounds))
    first = np.flatnonzero(owner[: len(hashes)] == owner[width - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], first, first + width, owner[first]


def _item_windows(block: Block, width: int) -> Windows:
    """The shingles of items: all windows of ``width`` words; a shorter text is one as a whole."""
    counts = np.diff(block.bounds)
    parts = [_all_windows(block, width)]
    for size in range(1, width):
        texts = np.flatnonzero(counts == size)
        if len(texts):
            begin = block.bounds[texts]
            parts.append((block.shingles(size)[begin], begin, begin + size, texts))
    return _joined(parts)


def _text(block: Block, begin: int, end: int) -> str:
    words = zip(block.starts[begin:end], block.ends[begin:end])
    return b" ".join(block.buffer[a:b].tobytes() for a, b in words).decode("utf-8", "replace")


def item_shingles(items: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per distinct shingle of every item, marked where it belongs to the item's signature."""

    def work(batches):
        hasher = WordHasher(NON_WORD)
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in hasher.blocks(batch.column(2).cast(pa.binary()).to_pylist()):
                hashes, begin, end, owner = _item_windows(block, width)
                out = []
                for text in range(block.texts):
                    own = np.flatnonzero(owner == text)
                    values, first = np.unique(hashes[own], return_index=True)  # ascending: rank by hash
                    size = len(values)
                    signature = size - (size * percent + 99) // 100 + 1
                    for rank, (value, at) in enumerate(zip(values, own[first])):
                        shingle = _text(block, begin[at], end[at])
                        at_row = block.first + text
                        out.append(
                            (rows[at_row], ids[at_row], size, size.bit_length(), int(value.view(np.int64)), shingle, rank < signature)
                        )
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), _ITEM_TYPES)]
                    yield pa.RecordBatch.from_arrays(columns, _names(ITEM))

    numbered = items.select(F.monotonically_increasing_id().alias("item_row"), "item_id", F.lower("text").alias("text"))
    return numbered.mapInArrow(work, ITEM)


_ITEM_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.bool_())


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _filters(shingles: DataFrame) -> dict[int, np.ndarray]:
    """By size class (-1: all classes, whole items), a bit array of fixed size with the place of every hash set."""
    place = F.pmod(F.col("hash"), F.lit(FILTER_BITS))
    chosen = shingles.where("in_signature").select("size_class", place.alias("place"))
    chosen = chosen.union(shingles.select(F.lit(-1), place))
    rows = (
        chosen.groupBy("size_class", F.expr("place div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits"))
        .toPandas()
    )
    filters = {}
    for size_class, part in rows.groupby("size_class"):
        words = np.zeros(FILTER_BITS // 64, np.uint64)
        words[part["word"].to_numpy(np.int64)] = part["bits"].to_numpy(np.int64).view(np.uint64)
        filters[int(size_class)] = words
    return filters


def _passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
    return (words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def evidence(docs: DataFrame, shingles: DataFrame, width: int, percent: int) -> DataFrame:
    """The item shingles that stand in documents with a signature hit, once per document row."""
    filters = _filters(shingles)
    limits = (
        shingles.where("in_signature")
        .groupBy("size_class")
        .agg(F.min("n_shingles").alias("least"), F.max(F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))).alias("greatest"))
        .collect()
        if filters
        else []
    )  # one row per power of two; unsigned order of the hashes
    partitions = [
        (row.size_class, (row.least * percent + 99) // 100, np.uint64(row.greatest + (1 << 63))) for row in limits
    ]
    words = F.size(F.split("shingle", " "))
    # Of an item of fewer words than a shingle the whole is looked for, in windows of as many words: width - 1 sizes at most.
    short = [row.words for row in shingles.select(words.alias("words")).where(f"words < {width}").distinct().collect()]
    widths = [width, *sorted(short)]
    shared = docs.sparkSession.sparkContext.broadcast({k: v.tobytes() for k, v in filters.items()})

    def work(batches):
        hasher = WordHasher(NON_WORD)
        bits = {k: np.frombuffer(v, np.uint64) for k, v in shared.value.items()}
        for batch in batches if bits else ():
            rows = [batch.column(i).to_pylist() for i in range(3)]
            for block in hasher.blocks(batch.column(3).cast(pa.binary()).to_pylist()):
                yield from _matches(block, rows, bits, partitions, widths)

    numbered = docs.select(F.monotonically_increasing_id(), "doc_id", F.xxhash64("text"), F.lower("text"))
    return with_text_batches(numbered).mapInArrow(work, EVIDENCE)


def _matches(block: Block, rows: list[list], bits: dict, partitions: list, widths: list[int]) -> Iterator[pa.RecordBatch]:
    hashes, begin, end, owner = _joined([_all_windows(block, width) for width in widths])
    sizes = np.bincount(owner, minlength=block.texts)
    candidate = np.zeros(block.texts, bool)
    for size_class, least, greatest in partitions:
        near = np.flatnonzero(hashes <= greatest)
        hit = owner[near[_passes(bits[size_class], hashes[near])]]
        candidate[hit[sizes[hit] >= least]] = True
    if not candidate.any():
        return
    own = np.flatnonzero(candidate[owner])
    own = own[_passes(bits[-1], hashes[own])]
    own = own[np.lexsort((hashes[own], owner[own]))]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (hashes[own[1:]] != hashes[own[:-1]]) | (owner[own[1:]] != owner[own[:-1]])
    own = own[fresh]
    if len(own):
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([column[block.first + owner[i]] for i in own], pa.int64()) for column in rows),
                pa.array(hashes[own].view(np.int64)),
                pa.array([_text(block, begin[i], end[i]) for i in own], pa.string()),
            ],
            _names(EVIDENCE),
        )


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_row, doc_id, text_key, item_id, n_shingles, n_common and containment of every item found in a row of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Words are runs of letters, digits
    and non-ASCII characters of the lower-cased text. An item of fewer than ``width`` words is one shingle as a whole, and is
    found wherever those words follow one another. Null and wordless texts hold nothing and are found
    nowhere. Repeated rows of either table each give their own pairs; null ids are carried along. doc_row tells rows of
    one doc_id apart within one result.
    """
    shingles = saved(item_shingles(items, width, percent), "item-shingles")
    found = saved(evidence(docs, shingles, width, percent), "evidence")
    return (
        found.join(shingles, ["hash", "shingle"])
        .groupBy("doc_row", "item_row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_key").alias("text_key"),
            F.first("item_id").alias("item_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.count("*").cast("int").alias("n_common"),
        )
        .where(f"100 * n_common >= {percent} * n_shingles")
        .select(
            *("doc_row", "doc_id", "text_key", "item_id", "n_shingles", "n_common"),
            (F.col("n_common") / F.col("n_shingles")).alias("containment"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are; null ids and texts included."""
    found = contained_items(docs, items, width, percent)
    found = saved(found.select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text")).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found["of_doc"]) & (F.xxhash64(docs["text"]) == found["of_text"])
    return docs.join(found, same, "left_anti")
