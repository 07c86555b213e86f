"""Passage search, periodic runs and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import periodic_runs, queries, toxicity, vector_codes

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, runs string, passages int, cell int"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "r", 1, 2) for i, t in rows], DOCS)


def _runs(words):
    """All runs by trying every period."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                own = words[i : i + length]
                if not any(all(own[k] == own[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _periodic_words(dice, size):
    letters, words = dice.choice([1, 2, 2, 3, 5]), []
    while len(words) < size:
        root = [dice.randrange(letters) for _ in range(dice.randrange(1, 6))]
        words += (root * dice.randrange(1, 8))[: dice.randrange(1, 40)]
    return words


def test_runs_equal_brute_force_on_both_ways():
    dice = random.Random(3)
    for _ in range(1500):
        words = _periodic_words(dice, dice.randrange(0, 60))
        codes = np.array(words, np.int64)
        expected = _runs(words)
        assert [tuple(r) for r in periodic_runs.runs(codes).tolist()] == expected
        assert [tuple(r) for r in periodic_runs.runs(codes, tree_words=5).tolist()] == expected


def test_common_extensions_and_lyndon_words_equal_brute_force():
    dice = random.Random(4)
    for _ in range(100):
        words = [dice.randrange(1, 4) for _ in range(dice.randrange(1, 40))]
        tree = periodic_runs.SuffixTree(np.array(words, np.int64))
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        got = tree.extension(*(np.array(side) for side in zip(*pairs)))
        for (i, j), common in zip(pairs, got.tolist()):
            most = len(words) - j
            assert common == next((k for k in range(most) if words[i + k] != words[j + k]), most)
        for ranks, sign in ((tree.ranks, 1), (tree.opposite_ranks(), -1)):
            turned = [sign * w for w in words]
            for i, length in enumerate(periodic_runs.lyndon_lengths(ranks).tolist()):
                longest = max(
                    n for n in range(1, len(words) - i + 1)
                    if all(turned[i : i + n] < turned[i + k : i + n] for k in range(1, n))
                )
                assert length == longest


def test_stretches_hold_all_runs_of_a_long_text_and_work_is_split():
    dice = random.Random(5)
    words = [dice.randrange(5000) for _ in range(40_000)]
    words[1000:1400] = ([7, 8, 9, 7] * 100)[:400]
    words[30_000:39_000] = (words[30_000:31_500] * 6)[:9000]
    codes = np.array(words, np.int64)
    expected = [(1000, 400, 4), (30_000, 9000, 1500)]
    assert [tuple(r) for r in periodic_runs.runs(codes).tolist()] == expected
    assert [tuple(r) for r in periodic_runs.runs(codes, tree_words=1000).tolist()] == expected
    assert sum(b - a for a, b in periodic_runs.stretches(codes)) < 10_000


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "a a a a a a"),
    (6, "a  b\ta b a b a\nb a b c"),
    (7, "x " * 9000),
    (None, "no no no no no no no"),
    (None, None),
    (8, "Ünder Ünder " * 8 + "naïve"),
    (8, "Ünder Ünder " * 8 + "naïve"),
    (9, "a a a a a a b b b b b b a a a a a a b b b b b b"),
    *((i, " ".join(map(str, _periodic_words(random.Random(i), i % 90)))) for i in range(10, 260)),
]


def test_digests_equal_plain_python(spark, tmp_path):
    _table(spark, AWKWARD).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    expected, repeated = [], 0
    for doc_id, text in AWKWARD:
        words = WORD.findall(text or "")
        n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            repeated += 1
        runs = [(0, n, 1)] if doc_id == 7 else _runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
        shape = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((doc_id, len(runs), *shape, *digests))
    assert repeated > 10
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_collapsed_text_and_pieces(monkeypatch):
    text = "go go go go go go on \n the the way".encode()
    rows, left = periodic_runs.collapsed(text)
    assert rows.tolist() == [[0, 6, 1]] and left == b"go on the the way"
    long = ("wörd sep\x0b" * 50 + "tail").encode()
    whole = [w for words in periodic_runs.word_pieces(long, 1 << 20) for w in words]
    assert [w for words in periodic_runs.word_pieces(long, 7) for w in words] == whole


def _segments(scores):
    """Maximal segments by their definition: the best one (shortest, first), then the same on both sides of it."""
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[2]):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, total = best
    while any(sum(scores[i:k]) == 0 for k in range(i + 1, j)):
        i += next(k for k in range(1, j - i) if sum(scores[i : i + k]) == 0)
    right = [(a + j, b + j, s) for a, b, s in _segments(scores[j:])]
    return [*_segments(scores[:i]), (i, j, total), *right]


def test_maximal_segments_equal_their_definition():
    dice = random.Random(6)
    for _ in range(1500):
        # Powers of two and odd offsets leave no two equal sums, so the definition is unambiguous.
        scores = [dice.randrange(-40, 30) + dice.random() for _ in range(dice.randrange(0, 25))]
        got = toxicity.maximal_segments(np.array(scores, float))
        expected = _segments(scores)
        assert [g[:2] for g in got] == [e[:2] for e in expected]
        assert np.allclose([g[2] for g in got], [e[2] for e in expected])


def test_segments_of_a_long_text_take_linear_time():
    scores = np.array([1.0, -1.5] * 300_000)
    assert len(toxicity.maximal_segments(scores)) == 300_000
    rising = np.array([1.0, -0.5] * 300_000)
    assert toxicity.maximal_segments(rising) == [(0, 599_999, pytest.approx(150_000.5))]


def test_extreme_rate_is_the_root_and_weights_are_cautious():
    counts = np.zeros(toxicity.SCORE_BINS, np.int64)
    middle = toxicity.SCORE_BINS // 2
    counts[middle - 16], counts[middle + 16] = 9000, 1000
    assert toxicity.extreme_rate(counts) == pytest.approx(math.log(9), abs=1e-6)
    assert toxicity.extreme_rate(np.zeros_like(counts)) == 1.0
    few, many, even = toxicity.weight(np.array([1.0, 100.0, 10.0]), np.array([0.0, 0.0, 90.0]), (1000.0, 9000.0))
    assert few == 0 and even == 0 and many > 3


@pytest.fixture(scope="module")
def labelled_corpus(spark):
    """English-like noise; every fifth text is toxic and mostly shows it, a few labels are wrong."""
    dice = random.Random(7)
    rows, marks = [], []
    for i in range(1500):
        words = [f"w{min(int(dice.paretovariate(0.7)), 4000)}" for _ in range(dice.randrange(1, 300))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(dice.randrange(1, 6)):
                words.insert(dice.randrange(len(words) + 1), dice.choice(["scum", "Vile!", "rotten", "fool"]))
        rows.append((i, " ".join(words)))
        if dice.random() < 0.8:
            marks.append((i, 1, int(toxic) if dice.random() > 0.02 else int(not toxic)))
    return _table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_found_by_held_out_labels(spark, labelled_corpus):
    docs, labels = labelled_corpus
    rows = toxicity.classified(docs, labels).collect()
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    # Labels of the held-out fold change nothing, nor does the number of partitions.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.classified(docs.repartition(7), flipped).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in rows)


def test_passages_name_their_text(spark, labelled_corpus):
    docs, labels = labelled_corpus
    model = toxicity.fit(docs, labels)
    text = "ünder w1 w2 scum, rotten fool w3 " + "w1 w2 w3 " * 60 + "vile fool scum."
    odd = _table(spark, [(1, text), (2, None), (3, ""), (4, " ,.! "), (None, text), (1, text), (5, "scum " * 20_000), (6, "x" * 500_000)])
    rows = toxicity.toxic_passages(odd, model).collect()
    assert len(rows) == 8
    found = {r.doc_id: r for r in rows}
    parts = [text[p.begin : p.end] for p in found[1].passages]
    assert parts == [p.text for p in found[1].passages] == ["scum, rotten fool", "vile fool scum"]
    assert all(0 < p.expected < toxicity.SIGNIFICANT for p in found[1].passages)
    assert found[None].score == found[1].score > 0.5
    assert found[2].score == found[3].score == found[4].score < 0.5 and not found[4].passages


def test_labels_of_one_class_none_or_several(spark, labelled_corpus):
    docs, labels = labelled_corpus
    few = docs.where("doc_id < 30")
    assert {r.score for r in toxicity.classified(few, labels.limit(0)).collect()} == {0.5}
    one = toxicity.classified(few, labels.withColumn("toxic", F.lit(0))).collect()
    assert all(r.score < 1e-6 for r in one)
    both = labels.union(labels.withColumn("toxic", F.lit(7))).union(labels.withColumn("doc_id", F.lit(None).cast("long")))
    assert toxicity.classified(few, both).collect() == toxicity.classified(few, labels).collect()
    assert toxicity.classified(docs.limit(0), labels).collect() == []


def _plain_codes(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(4096 * x) if abs(x) < 2.0**53 else int(x) * 4096 for x in r[1]] for r in kept]
    width = len(vectors[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in vectors]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(book, own):
        return min((sum((a - b) ** 2 for a, b in zip(e, own)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(books[p], c[p])[1], []).append(c[p])
            books[p] = [
                tuple(sum(x) // len(groups[e]) for x in zip(*groups[e])) if e in groups else entry
                for e, entry in enumerate(books[p])
            ]
    out = []
    for row, c in zip(kept, cut):
        best = [nearest(books[p], c[p]) for p in range(parts)]
        out.append((row[0], "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), row[2]))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    sums = {}
    for r in out:
        sums[r[3]] = sums.get(r[3], 0) + r[2]
    fits = lambda x: x if x < 2**63 else None
    return [(r[0], r[1], fits(r[2]), fits(sums[r[3]]), digest) for r in out]


def _vectors(dice, count, dim, levels):
    return [(i, [dice.randrange(-levels, levels) / 64 for _ in range(dim)], dice.choice([0, 1, None])) for i in range(count)]


@pytest.mark.parametrize(
    "case", ["ties", "few", "one", "repeated", "dropped", "huge", "smooth"]
)
def test_codes_equal_plain_python(spark, tmp_path, case):
    dice = random.Random(8)
    rows = _vectors(dice, 90, 16, 2)
    if case == "few":
        rows = _vectors(dice, 5, 8, 9)
    elif case == "one":
        rows = _vectors(dice, 1, 8, 9)
    elif case == "repeated":
        rows += rows[:20] + [(None, rows[3][1], 1), (None, rows[4][1], None)] + [(3, rows[9][1], 1)]
    elif case == "dropped":
        rows += [(-1, None, 1), (-2, [None] * 16, 1), (-3, [float("nan")] * 16, 0), (-4, [float("inf")] + [0.0] * 15, 0), (-5, [], 0)]
    elif case == "huge":
        rows = [(i, [x * 10.0 ** dice.randrange(0, 30) for x in v], y) for i, v, y in rows]
    elif case == "smooth":
        rows = [(i, [float(np.float32(dice.gauss(0, 0.2))) for _ in range(64)], i % 3) for i in range(200)]
    schema = "vec_id long, embedding array<double>, label int, code string, error int"
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], schema)
    table.repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in queries.op13_vector_codes(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(_plain_codes(rows), key=str)


def test_vectors_of_other_lengths_and_none_at_all(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = spark.createDataFrame([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0), (0, [1.0] * 9, 0), (3, [0.5] * 8, 0)], schema)
    codes = vector_codes.fitted(rows)
    assert codes.dim == 8 and sorted(r.vec_id for r in vector_codes.encoded(rows, codes).collect()) == [1, 3]
    none = vector_codes.fitted(rows.limit(0))
    assert none.dim == 0 and vector_codes.encoded(rows, none).collect() == []


def test_codes_decode_to_near_vectors(spark):
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    codes = vector_codes.fitted(vectors)
    rows = vector_codes.decoded(vector_codes.encoded(vectors, codes), codes).join(vectors.select("vec_id", "embedding"), "vec_id")
    for row in rows.limit(50).collect():
        exact = sum((math.floor(4096 * a) - round(4096 * b)) ** 2 for a, b in zip(row.embedding, row.vector))
        assert exact == row.error


def test_whole_subtrees_are_ruled_out():
    dice = np.random.default_rng(9)
    centres = dice.integers(-90_000, 90_000, (4, 8))
    points = np.concatenate([c + dice.integers(-50, 50, (4, 8)) for c in centres])
    tree = vector_codes.Gnat(points)
    rows = points.repeat(200, axis=0) + dice.integers(-60, 60, (3200, 8))
    looked = []
    search = tree._search

    def counted(node, rows, own, found, best):
        looked.append(len(own) if node else 0)
        search(node, rows, own, found, best)

    tree._search = counted
    found, away = tree.nearest(rows)
    every = np.stack([vector_codes.squared(rows, p) for p in points])
    assert (found == every.argmin(axis=0)).all() and (away == every.min(axis=0)).all()
    assert sum(looked[1:]) < 1.5 * len(rows)  # of four children, little more than one is entered
