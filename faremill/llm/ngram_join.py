"""Self-join of documents on the Jaccard similarity of their word shingles, by token-combination prefixes.

The tokens of a document are its distinct shingles, ordered from rare to frequent. Two documents whose overlap must
reach a share of their sizes share a token among the first few of each (the prefix). A prefix of rare tokens is indexed
token by token. Where a prefix reaches frequent tokens, single tokens would bring together everything that shares a
common passage; there the prefix is extended by g tokens, the frequent tokens fall into g hash classes, and every pair
of tokens of one class is indexed. A similar pair then shares g + 1 tokens of the extended prefixes: one of them is
rare, or two of them fall into one class. So no pair is lost, whatever the frequency estimates are; they only decide
how many candidates there are. Where a single token turns out to bring too many documents together, the estimate
was wrong: the token is marked frequent, and the index is built again. Candidates are verified on the whole sets.

Sizes are cut into classes of the ratio of the threshold; g belongs to a border between two neighbouring classes, and
every document is indexed under both borders of its class, so that all partners it can have agree on g.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.components import components
from faremill.llm.store import let_go, saved, with_text_batches
from faremill.llm.words import BLANKS, Block, WordHasher, mixed

#: Cells of the table of token frequencies, and the blocks in which it is added up.
CELLS = 1 << 21
BLOCK_CELLS = 1 << 16
#: Tasks whose tables are added up first.
GROUP_TASKS = 256
#: Bits of the filter that keeps the sets of documents without a candidate out of the shuffle.
FILTER_BITS = 1 << 24
#: A token is frequent from this many estimated documents on, or from this multiple of the mean cell.
FREQUENT = 64
FREQUENT_MEANS = 4
#: A single token that brings together more classes than this was taken for rare by mistake.
CROWD = 4096
#: Up to this many members, all pairs of an index group are few, and bounds of overlaps do without counting.
FEW_MEMBERS = 32
#: Bits of one bitmap of Spark's aggregate function for them.
BITMAP_BITS = 1 << 15
#: Bits of the set of such tokens.
CROWDED_BITS = 1 << 27
#: The chance, per pair of sets, that more of their half tokens agree by accident than is allowed for, and the most allowed for.
CHANCE = 1e-15
MOST_SLACK = 15
#: Sizes below which frequent tokens are indexed singly.
SMALL_SET = 20

#: The code of tokens known to be frequent, the last in the order.
ALWAYS_FREQUENT = np.uint8(255)

RECORD = "row long, doc_id long, text_key long, n_shingles long, set_key binary, cell int, singles int, keys array<long>"
TOKENS = "set_key binary, first boolean, second boolean, size int, halves int, upper array<int>, lower array<int>"


def shingle_sets(block: Block, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle as a whole, an empty one none."""
    whole = block.shingles(width)
    sizes = set(np.diff(block.bounds).tolist())
    short = {size: block.shingles(size) for size in range(1, width) if size in sizes}
    for begin, end in zip(block.bounds[:-1], block.bounds[1:]):
        count = end - begin
        if count >= width:
            yield np.unique(whole[begin : end - width + 1])
        elif count:
            yield short[count][begin : begin + 1]
        else:
            yield whole[:0]


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[object, np.ndarray]]:
    """The columns before the text, the last column, as a tuple, and the shingle set of every row."""
    let_go()
    hasher = WordHasher(BLANKS, fold_ascii=True)
    for batch in batches:
        ids = list(zip(*(column.to_pylist() for column in batch.columns[:-1])))
        texts = batch.columns[-1].cast(pa.binary()).to_pylist()
        for block in hasher.blocks(texts):
            for i, tokens in enumerate(shingle_sets(block, width), block.first):
                yield ids[i], tokens


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that name a set of tokens."""
    halves = mixed(tokens), mixed(tokens ^ np.uint64(0xD6E8FEB86659FD93))
    return b"".join(int(half.sum(dtype=np.uint64)).to_bytes(8, "big") for half in halves)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Part, block and summed cells of tables (part, block, cells) that come sorted; one sum is held at a time."""
    at, total = None, None
    for batch in batches:
        for *key, packed in zip(*(column.to_pylist() for column in batch.columns)):
            if key != at:
                if at is not None:
                    yield *at, total
                at, total = key, np.zeros(BLOCK_CELLS, np.uint64)
            total += np.frombuffer(zlib.decompress(packed), np.uint64)
    if at is not None:
        yield *at, total


def frequency_codes(docs: DataFrame, width: int, parts: int = 16) -> tuple[np.ndarray, int]:
    """A monotone one-byte code of the number of documents per cell of token hashes, and where frequent begins.

    All documents are counted, each task's in a table of its own. Tables are added block by block as a stream, those of
    GROUP_TASKS tasks first and their sums after that, so that no task adds up the tables of all; what reaches the driver
    is CELLS bytes.
    """

    def table(part, block, cells):
        packed = zlib.compress(cells.astype(np.uint64).tobytes(), 1)
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "cells": [packed]}
        )

    def count(batches):
        part = TaskContext.get().partitionId() // GROUP_TASKS
        cells = np.zeros(CELLS, np.uint32)
        for _, tokens in _sets(batches, width):
            np.add.at(cells, (tokens % np.uint64(CELLS)).astype(np.int64), 1)
        cells = cells.reshape(-1, BLOCK_CELLS)
        for i in np.flatnonzero(cells.any(axis=1)).tolist():
            yield table(part, i, cells[i])

    def add(batches):
        for _, block, cells in _added(batches):
            yield table(0, block, cells)

    def finish(batches):
        for _, block, cells in _added(batches):
            codes = np.minimum(254, np.round(8 * np.log2(1.0 + cells))).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "codes": [codes.tobytes()], "tokens": [int(cells.sum())]}
            )

    tables = "part int, block int, cells binary"
    found = (
        with_text_batches(docs.select("doc_id", "text"))
        .mapInArrow(count, tables)
        .repartition("part", "block")
        .sortWithinPartitions("part", "block")
        .mapInArrow(add, tables)
        .repartition(parts, "block")
        .sortWithinPartitions("block")
        .mapInArrow(finish, "block int, codes binary, tokens long")
        .collect()
    )
    codes = np.zeros(CELLS, np.uint8)
    for row in found:
        codes[row.block * BLOCK_CELLS : (row.block + 1) * BLOCK_CELLS] = np.frombuffer(row.codes, np.uint8)
    mean = sum(row.tokens for row in found) / CELLS
    return codes, min(254, round(8 * np.log2(1 + max(FREQUENT, FREQUENT_MEANS * mean))))


class Prefixes:
    """The index keys of one token set, for a threshold of ``percent`` in a hundred."""

    def __init__(self, codes: np.ndarray, frequent: int, percent: int, crowded: np.ndarray | None = None, small: int = SMALL_SET):
        self.codes, self.frequent, self.percent, self.crowded = codes, frequent, percent, crowded
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(bounds[-1] * 100 // percent + 1)
        self.bounds = np.array(bounds)
        # Of border c, between the size classes c - 1 and c: tokens to extend by, 0 for single tokens.
        self.extra = [0] * len(bounds)
        for c in range(1, len(bounds) - 1):
            if bounds[c] >= small:
                least = self.share(bounds[c - 1])
                self.extra[c] = max(1, min(bounds[c] * (100 - percent) // 100, least - 1))

    def share(self, size: int) -> int:
        """The least overlap that a set of this size can have with a similar one."""
        return (self.percent * size + 99) // 100

    def keys(self, tokens: np.ndarray) -> tuple[int, np.ndarray]:
        """How many keys at the front are single rare tokens, and all keys."""
        size = len(tokens)
        if not size:
            return 0, np.zeros(0, np.uint64)
        code = self.codes[(tokens % np.uint64(CELLS)).astype(np.int64)]
        if self.crowded is not None:
            place = (mixed(tokens) % np.uint64(CROWDED_BITS)).astype(np.int64)
            code = np.where(self.crowded[place >> 3] >> (place & 7).astype(np.uint8) & 1, ALWAYS_FREQUENT, code)
        ranked = np.argsort(code, kind="stable")
        length = size - self.share(size) + 1
        often = code[ranked[:length]] >= self.frequent
        singles = int(np.argmax(often)) if often.any() else length
        found = [mixed(tokens[ranked[:singles]])]
        if singles < length:
            size_class = int(np.searchsorted(self.bounds, size, side="right")) - 1
            for border in (size_class, size_class + 1):
                extra = self.extra[border]
                seed = mixed(np.array([border + 1], np.uint64) * np.uint64(0xA0761D6478BD642F))[0]
                if not extra:
                    found.append(mixed(tokens[ranked[singles:length]] ^ seed))
                    continue
                chosen = tokens[ranked[singles : length + extra]]
                group = mixed(chosen ^ seed) % np.uint64(extra)
                order = np.lexsort((chosen, group))
                chosen, group = chosen[order], group[order]
                for apart in range(1, len(chosen)):
                    same = np.flatnonzero(group[apart:] == group[:-apart])
                    if not len(same):
                        break
                    found.append(mixed(mixed(chosen[same] ^ seed) + np.uint64(3) * chosen[same + apart]))
        return singles, np.concatenate(found)


def records(
    docs: DataFrame, codes: np.ndarray, frequent: int, width: int, percent: int, crowded: np.ndarray | None = None
) -> DataFrame:
    """row, doc_id, set size, set key and index keys of every document; ``row`` names a row once this is written."""
    shared = docs.sparkSession.sparkContext.broadcast((codes.tobytes(), None if crowded is None else crowded.tobytes()))

    def work(batches):
        tables = [None if table is None else np.frombuffer(table, np.uint8) for table in shared.value]
        prefixes = Prefixes(tables[0], frequent, percent, tables[1])
        held, size = [], 0
        for (row, doc_id, text_key), tokens in _sets(batches, width):
            singles, keys = prefixes.keys(tokens)
            name = set_key(tokens) if len(tokens) else None
            held.append((row, doc_id, text_key, len(tokens), name, filter_cell(doc_id, name), singles, keys))
            size += len(keys) + 16
            if size > 1 << 18:
                yield _batch(held, names)
                held, size = [], 0
        if held:
            yield _batch(held, names)

    names = tuple(field.split()[0] for field in RECORD.split(", "))
    return with_text_batches(
        docs.select(F.monotonically_increasing_id(), "doc_id", F.xxhash64("text"), "text")
    ).mapInArrow(work, RECORD)


_ARROW = {
    **dict.fromkeys(("row", "doc_id", "text_key", "n_shingles"), pa.int64()),
    "set_key": pa.binary(),
    **dict.fromkeys(("cell", "singles", "size", "halves"), pa.int32()),
    **dict.fromkeys(("first", "second"), pa.bool_()),
}


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = dict(zip(names, zip(*rows)))
    return pa.RecordBatch.from_pydict(
        {name: pa.array(column, _ARROW[name]) if name in _ARROW else _lists(column) for name, column in columns.items()}
    )


def _lists(arrays) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values))


def _enough(common: str, one: str, other: str, percent: int) -> str:
    """percent * union <= 100 * common, for sizes ``one`` and ``other``."""
    return f"{100 + percent} * {common} >= {percent} * ({one} + {other})"


def _least(common: str, one: str, other: str) -> str:
    """A lower bound of the overlap of two sets of sizes ``one`` and ``other`` that have ``common`` upper halves in common.

    Of different tokens, about one * other / 2^32 agree in their upper halves, and k or more do with a chance of at most the
    k-th power of that over k!. So small sets are allowed one or two; for sets that need more than MOST_SLACK nothing is said.
    """
    expected = f"(CAST({one} AS DOUBLE) * {other} / {float(1 << 32)!r}D)"
    steps = [(k - 1, (CHANCE * math.factorial(k)) ** (1 / k)) for k in range(2, MOST_SLACK + 2)]
    cases = " ".join(f"WHEN {expected} < {limit!r}D THEN greatest(0, {common} - {slack})" for slack, limit in steps)
    return f"CASE {cases} ELSE 0 END"


def filter_cell(doc_id: int | None, name: bytes | None) -> int:
    """The place of a document in the fixed-size filter."""
    return (int.from_bytes((name or b"")[:8], "big") ^ (doc_id or 0) * 0x9E3779B1) % FILTER_BITS


def bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits as bytes, those at a ``place`` of the input set; bit i of byte j is place 8 * j + i.

    What reaches the driver are bitmaps of BITMAP_BITS bits each, so at most ``bits`` bits, whatever the number of rows.
    """
    block = F.expr(f"place div {BITMAP_BITS}").alias("block")
    bitmap = F.bitmap_construct_agg(F.col("place") % F.lit(BITMAP_BITS)).alias("bitmap")
    table = np.zeros(bits // 8, np.uint8)
    for row in places.select(F.col("place").cast("long")).groupBy(block).agg(bitmap).collect():
        at = row.block * BITMAP_BITS // 8
        table[at : at + BITMAP_BITS // 8] = np.frombuffer(row.bitmap, np.uint8)
    return table


def filter_words(wanted: DataFrame) -> np.ndarray:
    """A filter with the ``cell`` of every wanted row set: FILTER_BITS bits, whatever the number of rows."""
    return bit_table(wanted.select(F.col("cell").alias("place")), FILTER_BITS).view(np.uint64)


def token_sets(docs: DataFrame, firsts: DataFrame, seconds: DataFrame, width: int) -> DataFrame:
    """Written token sets, from the texts, of the rows that filters of fixed size take for one of ``firsts`` or ``seconds``.

    Both have set_key and cell. A set is its ascending tokens, the upper and the lower half of each in lists of
    their own, so that either can be read alone; ``halves`` is the number of different upper halves. Nothing is shuffled. A
    crowded filter, or a row that stands there twice, gives sets that no join asks for or asks for twice.
    """
    filters = tuple(filter_words(side).tobytes() for side in (firsts, seconds))
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    names = tuple(field.split()[0] for field in TOKENS.split(", "))

    def work(batches):
        sides = [np.frombuffer(words, np.uint64) for words in shared.value]
        held, size, sent = [], 0, set()
        for (doc_id,), tokens in _sets(batches, width):
            if not len(tokens):
                continue
            name = set_key(tokens)
            cell = filter_cell(doc_id, name)
            wanted = [bool(int(words[cell // 64]) >> (cell % 64) & 1) for words in sides]
            if any(wanted) and name not in sent:
                sent.add(name)
                upper, lower = (tokens >> np.uint64(32)).astype(np.uint32), tokens.astype(np.uint32)
                halves = 1 + int((upper[1:] != upper[:-1]).sum())
                held.append((name, *wanted, len(tokens), halves, upper.view(np.int32), lower.view(np.int32)))
                size += len(tokens)
            if size > 1 << 17:
                yield _batch(held, names)
                held, size = [], 0
        if held:
            yield _batch(held, names)

    return saved(with_text_batches(docs.select("doc_id", "text")).mapInArrow(work, TOKENS), "token-sets")


def _joined(pairs: DataFrame, one: DataFrame, other: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a_key, b_key) with the columns of their token sets, those of ``one`` for a and of ``other`` for b."""
    one = one.where("first").select(F.col("set_key").alias("a_key"), *(F.col(c).alias(f"a_{c}") for c in columns))
    other = other.where("second").select(F.col("set_key").alias("b_key"), *(F.col(c).alias(f"b_{c}") for c in columns))
    return pairs.join(other, "b_key").join(one, "a_key")


def _counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The written pairs (a, b, a_key, b_key) with their ``overlap``, from whole tokens."""
    hubs = sets.join(pairs.select(F.col("a_key").alias("set_key")).distinct(), "set_key", "left_semi")
    tokens = "transform(arrays_zip({0}_upper, {0}_lower), t -> shiftleft(CAST(t.{0}_upper AS BIGINT), 32) + t.{0}_lower)"
    overlap = F.expr(f"size(array_intersect({tokens.format('a')}, {tokens.format('b')}))").alias("overlap")
    return _joined(pairs, hubs, sets, "upper", "lower").select("a", "b", overlap).dropDuplicates(["a", "b"])


def overlaps(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) of nodes with whether they are ``similar`` and bounds ``least`` and ``most`` of their overlap; token sets.

    Upper halves of tokens decide all but close cases: equal tokens have equal halves, and how many different tokens
    agree in theirs by chance has a bound that follows the sizes. For close cases whole tokens are read. Hubs stand on the
    side of a, so only their sets are sent there. The pairs also keep the keys of their sets, for ``_counted``.
    """
    named = classes.select("node", "set_key", "cell")
    keyed = pairs.join(named.select(F.col("node").alias("a"), F.col("set_key").alias("a_key"), F.col("cell").alias("a_cell")), "a")
    keyed = keyed.join(named.select(F.col("node").alias("b"), F.col("set_key").alias("b_key"), F.col("cell").alias("b_cell")), "b")
    keyed = saved(keyed, "keyed-pairs")
    firsts, seconds = (keyed.select(F.col(f"{x}_key").alias("set_key"), F.col(f"{x}_cell").alias("cell")) for x in "ab")
    sets = token_sets(docs, firsts, seconds, width)
    halves = _joined(keyed.select("a", "b", "a_key", "b_key"), sets, sets, "size", "halves", "upper").select(
        *("a", "b", "a_key", "b_key", F.col("a_size").alias("m"), F.col("b_size").alias("n")),
        F.expr("size(array_intersect(a_upper, b_upper))").alias("common"),
        F.expr("least(a_size - a_halves, b_size - b_halves)").alias("folded"),
    )
    halves = halves.withColumns({"most": F.expr("common + folded"), "least": F.expr(_least("common", "m", "n"))})
    halves = saved(halves.dropDuplicates(["a", "b"]).drop("common", "folded"), "overlaps")
    close = halves.where(_enough("most", "m", "n", percent)).where(f"NOT ({_enough('least', 'm', 'n', percent)})")
    close = saved(close.select("a", "b", "a_key", "b_key"), "close-pairs")
    told = _exactly(halves, _counted(close, sets)).withColumn("similar", F.expr(_enough("least", "m", "n", percent)))
    return told.drop("m", "n"), sets


def _exactly(told: DataFrame, counted: DataFrame) -> DataFrame:
    """``told`` with both bounds equal to the overlap where that is counted."""
    exact = {bound: F.coalesce("overlap", bound) for bound in ("least", "most")}
    return told.join(counted, ["a", "b"], "left").withColumns(exact).drop("overlap")


def _index_groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of equal sets (node, set_key, doc_id, cell), and the index rows of keys that several of them share.

    An index row has key, whether it is a ``single`` token, node, size n, the ``rest`` of tokens that a partner can share at
    most, and the same of the hub, the member of the key's group with the greatest rest.
    """
    some = rows.where("n_shingles > 0")
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col("row").alias("node"), "cell"))
    classes = some.groupBy("set_key").agg(chosen.alias("chosen"))
    classes = saved(classes.select("set_key", "chosen.*").drop("unnamed"), "classes")
    copies = some.select("set_key", "row").join(classes, "set_key").where("row <> node").select(F.col("row").alias("copy"))
    copies = saved(copies, "copies")
    maybe, single = split_by_filter(some, F.xxhash64("row"), copies.select(F.xxhash64("copy").alias("place")))
    own = single.union(maybe.join(copies, F.col("row") == F.col("copy"), "left_anti")).withColumnRenamed("row", "node")
    index = own.select("node", F.col("n_shingles").cast("int").alias("n"), "singles", F.posexplode("keys").alias("pos", "key"))
    index = index.select("key", F.expr("pos < singles AS single"), "node", "n", F.expr("n - least(pos, singles) AS rest"))
    by_key = Window.partitionBy("key").orderBy(F.col("rest").desc(), "node")
    groups = index.select(
        "*",
        F.first("node").over(by_key).alias("hub"),
        F.first("n").over(by_key).alias("hub_n"),
        F.first("rest").over(by_key).alias("hub_rest"),
        F.lead("node").over(by_key).alias("follower"),
    )
    return classes, saved(groups.where("hub <> node OR follower IS NOT NULL").drop("follower"), "groups")


def _crowded_keys(groups: DataFrame, crowd: int) -> np.ndarray | None:
    """A bit set of fixed size with the single-token keys of more than ``crowd`` classes, or None where there are none."""
    keys = groups.where("single").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    # A key is a scrambled token and unsigned; as the divisor is a power of two, its low bits are the place.
    table = bit_table(keys.select(F.col("key").bitwiseAND(F.lit(CROWDED_BITS - 1)).alias("place")), CROWDED_BITS)
    return table if table.any() else None


def _across(groups: DataFrame, found: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of one index group that lie in different components and may still be similar.

    Where two members share frequent tokens only, all that they share is frequent. Of x's frequent tokens the hub holds
    no more than its overlap with x; of y's the hub lacks ``rest - overlap``, but for those of y's rare tokens that it holds, at
    most as many as it has itself. So the overlap of x and y is at most the one plus the other, which the comparisons
    with the hub have told already, and next to no pair is left of a large group of near copies. A bound that is off by
    two lets through ten times as many pairs, so overlaps with hubs of groups of more than FEW_MEMBERS are counted in
    whole tokens first. Smaller groups have next to all such hubs, but few pairs; what the bound lets through is compared.
    """
    labelled = groups.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = labelled.groupBy("key").agg(
        *(F.min("label").alias("low"), F.max("label").alias("high")),
        *(F.first("hub").alias("hub"), (F.count("*") > FEW_MEMBERS).alias("many")),
    )
    apart = saved(spread.where("low < high").select("key", "hub", "many"), "apart")
    vague = known.where("least < most").join(apart.where("many").select(F.col("hub").alias("a")).distinct(), "a", "left_semi")
    vague = saved(vague.select("a", "b", "a_key", "b_key"), "vague-pairs")
    told = _exactly(known.select("a", "b", "least", "most"), _counted(vague, sets))
    # Only rows of groups with two labels are moved again; the others do not pass the filter of fixed size.
    maybe, _ = split_by_filter(groups, F.xxhash64("key"), apart.select(F.xxhash64("key").alias("place")))
    members = maybe.join(apart.select("key"), "key").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    members = members.join(told, (F.col("hub") == F.col("a")) & (F.col("node") == F.col("b")), "left")
    whole = F.col("hub") == F.col("node")
    members = members.select(
        *("key", "single", "node", "n", "rest", "label"),
        F.expr("hub_n - hub_rest").alias("hub_rare"),
        F.when(whole, F.col("n")).otherwise(F.col("least")).alias("least"),
        F.when(whole, F.col("n")).otherwise(F.col("most")).alias("most"),
    )
    # Both sides ask for the same columns, so that one shuffle serves them.
    members = members.repartition("key")
    x, y = members.alias("x"), members.alias("y")
    bound = "least(x.most + y.rest - y.least, y.most + x.rest - x.least) + least(x.hub_rare, y.hub_rare)"
    return (
        x.join(y, F.expr("x.key = y.key"))
        .where("x.label < y.label")
        .where(_enough("least(x.rest, y.rest)", "x.n", "y.n", percent))
        .where(f"(x.single AND y.single) OR x.most IS NULL OR y.most IS NULL OR {_enough(f'({bound})', 'x.n', 'y.n', percent)}")
        .select(F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b"))
        .distinct()
    )


def linked(docs: DataFrame, width: int, percent: int, frequent: int | None = None, crowd: int = CROWD) -> DataFrame:
    """doc_id, text_key, n_shingles, component (null without shingles) and component_id of every row of ``docs``."""
    codes, from_code = frequency_codes(docs, width)
    if frequent is not None:
        from_code = round(8 * np.log2(1 + frequent))
    crowded = None
    while True:
        rows = saved(records(docs, codes, from_code, width, percent, crowded), "records")
        classes, groups = _index_groups(rows)
        misjudged = _crowded_keys(groups, crowd)
        if misjudged is None:
            break
        # Known as frequent now, they go to the end of the order; no key can be found crowded twice.
        crowded = misjudged if crowded is None else crowded | misjudged
    first = saved(
        groups.where("hub <> node")
        .where(_enough("least(rest, hub_rest)", "n", "hub_n", percent))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "pairs",
    )
    known, sets = overlaps(docs, classes, first, width, percent)
    known = saved(known, "known")
    links = known.where("similar").select("a", "b")
    found = saved(components(links), "components")
    done = first.union(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    second = saved(_across(groups, found, known, sets, percent).join(done, ["a", "b"], "left_anti"), "more-pairs")
    if not second.isEmpty():
        more, _ = overlaps(docs, classes, second, width, percent)
        more = more.where("similar").select("a", "b")
        found = saved(components(links.union(more)), "components")
    smallest = classes.join(found, "node").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = F.col("node").alias("component"), F.col("doc_id").alias("component_id")
    alone = classes.join(found, "node", "left_anti").select("set_key", *names)
    joined = classes.join(found, "node").join(smallest, "label")
    joined = joined.select("set_key", F.col("label").alias("component"), "component_id")
    return (
        rows.select("doc_id", "text_key", "n_shingles", "set_key")
        .join(alone.union(joined), "set_key", "left")
        .withColumn("component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .drop("set_key")
    )


def ngram_join(
    docs: DataFrame, width: int = 4, percent: int = 85, frequent: int | None = None, crowd: int = CROWD
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * intersection >= percent * union of their sets of ``width``-word shingles (ASCII
    letters folded). component_id is the smallest doc_id reachable by links. Rows with equal sets are one class before
    anything is joined, so copies meet in one map-side aggregate. In each index group every class is first compared
    with one member, the one with the least that can differ; only where a group still spans several components are its
    other pairs compared, and only across components. So a group of n similar documents costs n comparisons.

    Null and wordless texts have no shingles and are linked with nothing. Repeated rows stay rows. A null doc_id takes
    part like any other and is never the smallest. Other columns are ignored. ``frequent`` sets where
    frequent tokens begin (an estimated number of documents), ``crowd`` how many classes a single token may bring
    together; they never change the result.
    """
    return linked(docs, width, percent, frequent, crowd).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of similar documents: that of the smallest doc_id, all columns as they are.

    Rows of one doc_id are told apart by a hash of the text; of rows that agree in both, one stays. A null doc_id counts as
    the greatest. Rows without a shingle are like nothing and all stay.
    """
    rows = saved(linked(docs, width, percent), "linked")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    ranked = rows.where("component IS NOT NULL").select("component", "doc_id", "text_key", rank.alias("rank"))
    best = ranked.groupBy("component").agg(F.min("rank").alias("best"))
    each = ranked.groupBy("component", "rank").agg(F.count("*").alias("copies")).join(best, "component")
    each = each.select(
        F.col("rank.doc_id").alias("of_doc"),
        F.col("rank.text_key").alias("of_text"),
        (F.col("rank") == F.col("best")).alias("stays"),
        "copies",
    )
    marked = saved(each.where("NOT stays OR copies > 1"), "marked")
    key = F.xxhash64("doc_id", F.xxhash64("text"))
    open_rows, clear = split_by_filter(docs, key, marked.select(F.xxhash64("of_doc", "of_text").alias("place")))
    same = open_rows["doc_id"].eqNullSafe(marked["of_doc"]) & (F.xxhash64(open_rows["text"]) == marked["of_text"])
    kept = clear.union(open_rows.join(marked, same, "left_anti"))
    repeated = marked.where("stays")
    if repeated.isEmpty():
        return kept
    again = open_rows["doc_id"].eqNullSafe(repeated["of_doc"]) & (F.xxhash64(open_rows["text"]) == repeated["of_text"])
    return kept.union(open_rows.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def split_by_filter(rows: DataFrame, key: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash ``key`` may be a ``place`` of ``hashes``, and those whose hash surely is none.

    The filter has a fixed size and goes to the tasks as one value, so the second part, mostly the large one, needs no
    join. A crowded filter makes the first part larger and changes nothing.
    """
    own = "filter"
    while own in rows.columns:
        own = f"_{own}"
    place = F.pmod(key, F.lit(FILTER_BITS)).cast("int")
    words = bit_words(hashes.select(F.pmod("place", F.lit(FILTER_BITS)).cast("int").alias("place")))
    hit = F.getbit(F.get(F.col(own), F.shiftright(place, 6)), place % 64) == 1
    tested = rows.withColumn(own, words.scalar())
    return tested.where(hit).drop(own), tested.where(~hit).drop(own)


def bit_words(places: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row: ``bits`` bits as an array of longs, those at a ``place`` of the input set."""
    word = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, place % 64))").alias("bits")
    )
    every = places.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word")).join(word, "word", "left")
    pair = F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    listed = every.agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    return saved(listed.select(F.transform("pairs", lambda p: p["bits"]).alias("words")), "bit-words")
