"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered 0 to N - 1 by a fixed order, without one global sort: a hash of the row's key cuts them into ranges,
the ranges are counted, and a row's number is the count before its range plus its rank inside. A balanced Feistel
network permutes the least even power of two that holds N; a value outside of 0 to N - 1 walks on along its cycle until
it is inside, which is a permutation of 0 to N - 1. The permuted number p gives shard p mod S and slot p div S, so shard sizes
differ by one row at most, slots have no gap, and both directions can be computed for any row without a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.store import saved

ROUNDS = 6
#: Ranges of the numbering; a table of their counts is all that is added up in one place.
RANGES = 4096
#: Copies of one row that are numbered as one piece.
PIECE = 4096


def _keys(seed: int) -> np.ndarray:
    return np.array([(seed * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) % (1 << 64) for i in range(ROUNDS)], np.uint64)


def _round(half: np.ndarray, key: np.uint64, mask: np.uint64) -> np.ndarray:
    x = half ^ key
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & mask


def _half_bits(size: int) -> int:
    return max(1, (max(size - 1, 1).bit_length() + 1) // 2)


def _network(values: np.ndarray, bits: int, keys: np.ndarray, inverse: bool) -> np.ndarray:
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = values >> shift, values & mask
    if inverse:
        for key in keys[::-1]:
            left, right = right ^ _round(left, key, mask), left
    else:
        for key in keys:
            left, right = right, left ^ _round(right, key, mask)
    return left << shift | right


def permuted(rows: np.ndarray, size: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The place of every row number among ``size``, or with ``inverse`` the row number of every place."""
    bits, keys = _half_bits(size), _keys(seed)
    out = _network(rows.astype(np.uint64), bits, keys, inverse)
    outside = np.flatnonzero(out >= np.uint64(size))
    while len(outside):  # fewer than 4 * size values in all, so a walk takes 4 steps on average
        out[outside] = _network(out[outside], bits, keys, inverse)
        outside = outside[out[outside] >= np.uint64(size)]
    return out.astype(np.int64)


def shard_and_slot(rows: np.ndarray, size: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Where rows stand."""
    places = permuted(rows, size, seed)
    return places % shards, places // shards


def row_at(shard: np.ndarray, slot: np.ndarray, size: int, shards: int, seed: int) -> np.ndarray:
    """Which rows stand there."""
    return permuted(slot * shards + shard, size, seed, inverse=True)


def numbered(rows: DataFrame, key: list[str], ranges: int = RANGES) -> tuple[DataFrame, int]:
    """``rows`` with the global number of each, and how many there are.

    The order is that of a hash of the ``key`` columns, then the columns themselves, so it depends on the rows alone. Rows
    that agree in all key columns are folded to a count first and unfolded in pieces, so copies are no hot range. The
    result has the key columns and row_number.
    """
    folded = rows.groupBy(*key).agg(F.count("*").alias("copies"))
    order = F.xxhash64(*key)
    folded = folded.withColumn("order", order).withColumn("range", F.shiftrightunsigned("order", 64 - (ranges.bit_length() - 1)))
    folded = saved(folded, "folded")
    counts = folded.groupBy("range").agg(F.sum("copies").alias("in_range"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(counts.select("range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("start"), "in_range"), "ranges")
    size = starts.agg(F.sum("in_range")).first()[0] or 0
    inside = Window.partitionBy("range").orderBy("order", *key).rowsBetween(Window.unboundedPreceding, -1)
    placed = folded.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(starts.select("range", "start")), "range")  # at most ``ranges`` rows
    first = F.col("start") + F.col("before")
    pieces = placed.select(
        *key, "copies", first.alias("first"), F.explode(F.expr(f"sequence(0L, (copies - 1) div {PIECE})")).alias("piece")
    )
    within = F.expr(f"sequence(piece * {PIECE}, least(copies, (piece + 1) * {PIECE}) - 1)")
    return pieces.select(*key, "first", F.explode(within).alias("i")).select(*key, (F.col("first") + F.col("i")).alias("row_number")), size


def sharded(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and row_number of every row of ``docs`` (doc_id, text).

    size: UTF-8 bytes of the text plus 1; text_crc32 of a null text is that of an empty one. law is ``rows``: shard sizes
    differ by one row at most. grown_shard is null, since another number of shards deals all rows anew. Rows are
    numbered by doc_id, size, checksum and a further hash of the text; rows that agree in all of them are copies
    and take neighbouring numbers. Null ids are ids like any other; without rows the result is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    rows, size = numbered(facts, ["doc_id", "size", "text_crc32", "text_key"])

    @F.pandas_udf("shard int, slot long")
    def place(numbers: pd.Series) -> pd.DataFrame:
        shard, slot = shard_and_slot(numbers.to_numpy(), size, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    return rows.withColumn("place", place("row_number")).select(
        *("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "place.shard", "place.slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
