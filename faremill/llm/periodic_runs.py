"""Periodic runs of words: maximal stretches that repeat with a smallest period, found with suffix trees.

Suffix trees of a word sequence and of its reversal are built with Ukkonen's algorithm. A walk around each tree gives the
leaves in order and, between neighbouring leaves, the string depth of the shallowest node passed; a sparse table over
those depths tells the lowest common ancestor of two leaves, hence the longest common extension of two places, in
constant time. The leaf order is the order of the suffixes, so the longest Lyndon word that begins at a place ends before
the next smaller suffix. Each run holds such a word of its period for one of two opposite orders of the alphabet; so those
words, at most two a place, are the candidates, and every one is extended in both directions by one query each.

Texts are taken whole. Before trees are built, a text is cut where no run can be: every three words of a run recur
three times or more in it, and not farther than a quarter of the stretch apart. A stretch that is left and is longer than
``TREE_WORDS`` would need trees of hundreds of megabytes; there, equal blocks of words of doubling length are named by
sorting, and two equal blocks one period apart show a run. Both ways find exactly the same runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import with_text_batches

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of the longest stretch that trees are built for.
TREE_WORDS = 1 << 17
#: Bytes of a text that are split into words at a time.
PIECE_BYTES = 1 << 20
#: Words whose rows go out together.
ROWS_WORDS = 1 << 17

RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_BLANKS = b" \t\n\x0b\x0c\r"


def ukkonen(codes: list[int], width: int) -> tuple[list[int], list[int], dict[int, int]]:
    """The suffix tree of ``codes``, which end with a 0 that is nowhere else and are below ``width``.

    The edge into node v is labelled codes[begin[v]:finish[v]]; node 0 is the root. The child of node v along a code
    is edges[v * width + code].
    """
    size = len(codes)
    begin, finish, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge = length = pending = 0
    for at, code in enumerate(codes):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = at
            key = node * width + codes[edge]
            below = edges.get(key)
            if below is None:
                edges[key] = len(begin)
                begin.append(at)
                finish.append(size)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                first = begin[below]
                span = finish[below] - first
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if codes[first + length] == code:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                split = len(begin)
                edges[key] = split
                begin += (first, at)
                finish += (first + length, size)
                link += (0, 0)
                edges[split * width + code] = split + 1
                begin[below] = first + length
                edges[split * width + codes[first + length]] = below
                if unlinked:
                    link[unlinked] = split
                unlinked = split
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = at - pending + 1
    return begin, finish, edges


class SuffixTree:
    """Leaf order and common extensions of the suffixes of a word sequence."""

    def __init__(self, codes: np.ndarray):
        """``codes`` are from 1 on; an end mark below all of them is added."""
        self.size = len(codes)
        self.width = int(codes.max()) + 1
        self.begin, self.finish, edges = ukkonen([*codes.tolist(), 0], self.width)
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.below = np.fromiter(edges.values(), np.int64, len(edges))
        order, depths = self._walk(self.keys)
        self.ranks = self._ranks(order)
        # depths[r] is the depth of the node where the walk turns from leaf r - 1 to leaf r.
        self.levels = [np.array(depths, np.int32)]
        step = 1
        while 2 * step <= self.size + 1:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _walk(self, keys: np.ndarray) -> tuple[list[int], list[int]]:
        """Suffixes in the order of the leaves, children by ``keys``, and the depths at the turns."""
        order = np.argsort(keys)
        parents = self.keys[order] // self.width
        kids = self.below[order].tolist()
        starts = np.searchsorted(parents, np.arange(len(self.begin) + 1)).tolist()
        begin, finish = self.begin, self.finish
        above = [0] * len(begin)
        leaves, turns, stack = [], [], [0]
        while stack:
            node = stack.pop()
            turn = above[node]
            low, high = starts[node], starts[node + 1]
            while low < high:
                depth = above[node] + finish[node] - begin[node]
                own = kids[low:high]
                for child in own:
                    above[child] = depth
                node = own[0]
                if high - low > 1:
                    stack += own[:0:-1]
                low, high = starts[node], starts[node + 1]
            leaves.append(begin[node] - above[node])
            turns.append(turn)
        return leaves, turns

    def _ranks(self, order: list[int]) -> np.ndarray:
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.arange(len(order))
        return ranks

    def opposite_ranks(self) -> np.ndarray:
        """Ranks of the suffixes when greater codes come first; the end mark stays the least."""
        code = self.keys % self.width
        turned = np.where(code == 0, 0, self.width - code)
        return self._ranks(self._walk(self.keys - code + turned)[0])

    def extension(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``one`` and ``other`` have in common; the places differ pairwise."""
        a, b = self.ranks[one], self.ranks[other]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            here = level == k
            table = self.levels[k]
            found[here] = np.minimum(table[low[here]], table[high[here] - (1 << k)])
        return found


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every place: up to the next smaller suffix."""
    rank = ranks.tolist()
    lengths = [0] * (len(rank) - 1)
    waiting: list[int] = []
    for place, own in enumerate(rank):
        while waiting and rank[waiting[-1]] > own:
            begun = waiting.pop()
            lengths[begun] = place - begun
        waiting.append(place)
    return np.array(lengths, np.int64)


def _long_enough(length: np.ndarray, period: np.ndarray) -> np.ndarray:
    return (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period)


def runs_by_trees(codes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of codes from 1 on."""
    size = len(codes)
    if size < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    ahead, back = SuffixTree(codes), SuffixTree(codes[::-1])
    places = np.arange(size)
    found = []
    for ranks in (ahead.ranks, ahead.opposite_ranks()):
        period = lyndon_lengths(ranks)
        right = ahead.extension(places, places + period)
        left = np.zeros(size, np.int64)
        # The word before a place is, read backwards, the suffix of the reversal that begins at size - place.
        left[1:] = back.extension(size - places[1:], size - places[1:] - period[1:])
        length = left + period + right
        good = _long_enough(length, period)
        found.append(np.stack([places[good] - left[good], length[good], period[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def runs_by_naming(codes: np.ndarray) -> np.ndarray:
    """The same rows from names of blocks of 1, 2, 4, ... words, in memory of a few numbers a word.

    A period q is found at the least block length k >= q: a block then recurs after q words and not before exactly where
    two periods and more follow, so the places of one run are neighbours.
    """
    names, k, size = codes.astype(np.int64), 1, len(codes)
    found = []
    while k // 2 < max(1, size // LEAST_PERIODS) and len(names):
        order = np.argsort(names, kind="stable")
        gap = np.zeros(len(names), np.int64)
        again = np.flatnonzero(names[order[1:]] == names[order[:-1]])
        gap[order[again]] = order[again + 1] - order[again]
        places = np.flatnonzero((gap > k // 2) & (gap <= k))
        if len(places):
            period = gap[places]
            first = np.ones(len(places), bool)
            first[1:] = (np.diff(places) > 1) | (np.diff(period) != 0)
            begins = np.flatnonzero(first)
            ends = np.append(begins[1:], len(places)) - 1
            q = period[begins]
            length = places[ends] + q + k - places[begins]
            good = _long_enough(length, q)
            found.append(np.stack([places[begins], length, q], axis=1)[good])
        if len(names) <= k:
            break
        pairs = names[:-k] * (int(names.max()) + 1) + names[k:]
        names, k = np.unique(pairs, return_inverse=True)[1].astype(np.int64), 2 * k
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _renamed(codes: np.ndarray) -> np.ndarray:
    """The codes as 1, 2, ... in the same order."""
    return np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1


def stretches(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of disjoint parts that hold all runs: every three words in them recur as often and as near as in a run."""
    work = [(0, len(codes))]
    while work:
        begin, end = work.pop()
        size = end - begin
        if size < LEAST_WORDS:
            continue
        own = _renamed(codes[begin:end])
        top = int(own.max()) + 1
        pairs = own[:-1] * top + own[1:]
        if top > 1 << 20:  # three codes would not fit into 64 bits
            pairs = _renamed(pairs)
        triples = pairs[:-1] * top + own[2:]
        order = np.argsort(triples, kind="stable")
        ranked = triples[order]
        same = ranked[1:] == ranked[:-1]
        near = same & (np.diff(order) <= size // LEAST_PERIODS)
        # A triple in a run is one of three or more, each near the next.
        linked = np.concatenate([[False], near, [False]])
        before, after = linked[:-1], linked[1:]
        two_before = np.concatenate([[False], before[:-1]]) & before
        two_after = np.concatenate([after[1:], [False]]) & after
        keep = np.zeros(len(triples) + 2, bool)
        keep[order + 1] = (before & after) | two_before | two_after
        edges = np.flatnonzero(np.diff(keep.astype(np.int8)))
        parts = [(begin + a, begin + b + 2) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
        for part in parts:  # two parts may share up to two words; a run lies whole in one of them
            if 8 * (part[1] - part[0]) > 7 * size:  # hardly shorter: another look costs more than it saves
                yield part
            else:
                work.append(part)


def runs(codes: np.ndarray, tree_words: int = TREE_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    found = []
    for begin, end in stretches(codes):
        own = _renamed(codes[begin:end])
        rows = runs_by_trees(own) if end - begin <= tree_words else runs_by_naming(own)
        found.append(rows + np.array([begin, 0, 0]))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(size: int, rows: np.ndarray) -> np.ndarray:
    """Whether each word stays: none does that some run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def word_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``size`` bytes at a time."""
    begin = 0
    while begin < len(text):
        end = min(len(text), begin + size)
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[begin:end].split()  # of bytes, it splits at exactly these blanks
        begin = end


def collapsed(text: bytes, tree_words: int = TREE_WORDS) -> tuple[np.ndarray, bytes]:
    """The runs of the words of a text, and its kept words joined by one space."""
    table: dict[bytes, int] = {}
    number = table.setdefault
    codes = [np.array([number(w, len(table)) for w in words], np.int64) for words in word_pieces(text)]
    rows = runs(np.concatenate(codes), tree_words) if codes else np.zeros((0, 3), np.int64)
    if not len(rows):
        return rows, b" ".join(b" ".join(words) for words in word_pieces(text) if words)
    keep = kept_words(sum(map(len, codes)), rows)
    words, at, out = list(table), 0, []
    for part in codes:
        out.append(b" ".join([words[c] for c in part[keep[at : at + len(part)]].tolist()]))
        at += len(part)
    return rows, b" ".join(filter(None, out))


def periodic_runs(docs: DataFrame, tree_words: int = TREE_WORDS) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text of every row of ``docs`` (doc_id, text).

    Words are runs of characters other than blanks, numbered from 0. A run is a stretch of words with smallest
    period q and at least max(6, 4 q) words that cannot be made longer. The collapsed text holds, joined by one space, the
    words that no run holds after its first q words. A null, empty or wordless text has no runs and collapses to the empty
    text. Runs may overlap; equal starts are ordered by the period. Rows are treated one by one, so repeated rows stay and any
    doc_id, null too, is passed on. Other columns are ignored. ``tree_words`` changes the way, never the result.
    """

    def work(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            held, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                rows, left = collapsed(text.as_py() or b"", tree_words)
                held.append((doc_id, rows, left))
                size += len(left) + 24 * len(rows)
                if size > 8 * ROWS_WORDS:
                    yield _batch(held)
                    held, size = [], 0
            if held:
                yield _batch(held)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_text_batches(rows).mapInArrow(work, RUNS)


def _batch(held: list[tuple]) -> pa.RecordBatch:
    ids, found, texts = zip(*held)
    offsets = np.concatenate([[0], np.cumsum([len(rows) for rows in found])]).astype(np.int32)
    every = np.concatenate(found)
    parts = pa.StructArray.from_arrays([pa.array(every[:, i]) for i in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(offsets), parts)
    strings = pa.array(texts, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists, strings], ["doc_id", "runs", "collapsed"])
