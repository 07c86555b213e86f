"""Hashed n-gram log-likelihood ratio between a trusted target and the raw corpus, with plain text rules beside it.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two smoothed multinomials over the
buckets are counted: one over trusted texts, one over the whole corpus. A document's score is the mean over its n-grams
of log p_target - log p_corpus, in fixed point, so that the verdict depends neither on summation order nor on the cluster.
``judged`` takes a prior and a threshold as given; ``judged_by_trusted`` takes both from the trusted texts, so that its verdicts
mean the same for any amount of them: their scores, each without its own part of the target, say where to cut.
Everything runs on DataFrame functions. Only the weights cross to the scoring: one value per bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.store import saved

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

BUCKETS = 1 << 16
#: Trusted documents that the target is counted over: those with the smallest hashes of their ids.
TARGET_DOCS = 50_000
#: Pseudo n-grams per bucket by which the target is drawn to the corpus, and that both multinomials get evenly.
PRIOR = 8
EVEN = 0.5
#: Fixed-point units of one nat.
SCALE = 1 << 16
#: Mean nats per n-gram below which a document is rejected.
THRESHOLD = -0.115
#: What ``judged_by_trusted`` takes instead: pseudo n-grams as a share of the target's own, the share of trusted documents
#: that may score below the threshold when not counted themselves, the parts they are left out in, and bins of one nat.
PRIOR_SHARE, LOWEST, FOLDS, FINE = 0.5, 0.02, 4, 1 << 12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though the body reads it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spaced(text: Column) -> Column:
    """A text with all its white space turned into spaces."""
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text; none of a null text."""
    return F.array_remove(F.split(F.coalesce(spaced(text), F.lit("")), " "), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def joined_hashes(hashes: Column, apart: int) -> Column:
    """The hash of every element and the one ``apart`` places on; the last ``apart`` have none and are left out."""

    def joined(h: Column) -> Column:
        whole = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + apart)))
        return F.slice(whole, 1, F.greatest(F.size(h) - apart, F.lit(0)))

    return let(hashes, joined)


def bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets)).cast("int")


def repeated_words(pairs: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that stand in the text twice or more, the first ones included.

    ``pairs`` are the hashes of neighbouring words; windows of 4 and 8 words are joined from those of 2 and 4.
    """
    none = F.lit(0).cast("long")

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            same = lambda i, other: F.coalesce(F.get(rows, i)["h"] == F.get(rows, other)["h"], F.lit(False))
            return F.sort_array(
                F.transform(F.filter(rows, lambda _, i: same(i, i - 1) | same(i, i + 1)), lambda row: row["i"])
            )

        def width(at: Column) -> Column:
            return F.aggregate(
                F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(window)), F.lit(window))),
                none,
                lambda total, step: total + step,
            )

        return let(let(ranked, repeated), width)

    hashes, size = pairs, 2
    while size < window:
        hashes, size = joined_hashes(hashes, size), 2 * size
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(none))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, hashes of words and of neighbouring words, and the plain measures of every row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    hashed = docs.select("doc_id", text.alias("text")).withColumn("hashes", word_hashes(words_of(F.col("text"))))
    paired = hashed.withColumn("pairs", joined_hashes(F.col("hashes"), 1))
    return paired.select(
        "doc_id",
        "hashes",
        "pairs",
        F.size("hashes").cast("long").alias("n_words"),
        F.length(F.replace(spaced(F.col("text")), F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("pairs")).alias("n_repeat_words"),
    )


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FOLDS)).cast("int")


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, target_docs: int = TARGET_DOCS) -> DataFrame:
    """bucket, corpus and, by fold of the trusted documents, target: how many n-grams fall into every bucket.

    The corpus is counted over every row of ``docs``, the target over the rows whose doc_id is among the first
    ``target_docs`` of ``trusted`` by hash of the id. That bound is the size of the one broadcast.
    """
    chosen = trusted.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_docs)
    chosen = chosen.withColumn("fold", fold_of(F.col("doc_id")))
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left")
    grams = let(word_hashes(words_of(F.col("text"))), lambda h: F.concat(h, joined_hashes(h, 1)))
    # One number per bucket and fold; the last fold is that of rows outside the target.
    exploded = marked.select(F.coalesce("fold", F.lit(FOLDS)).alias("fold"), F.explode(grams).alias("gram"))
    slots = exploded.select((bucket(F.col("gram"), buckets) * (FOLDS + 1) + F.col("fold")).alias("slot"))
    counted = slots.groupBy("slot").agg(F.count("*").alias("n"))
    counted = counted.select(F.floor(F.col("slot") / (FOLDS + 1)).cast("int").alias("bucket"), (F.col("slot") % (FOLDS + 1)).alias("fold"), "n")
    of_fold = [F.coalesce(F.sum(F.when(F.col("fold") == k, F.col("n"))), F.lit(0)).alias(f"fold_{k}") for k in range(FOLDS)]
    counts = counted.groupBy("bucket").agg(F.sum("n").alias("corpus"), *of_fold)
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    return saved(every.na.fill(0), "bucket-counts")


def bucket_weights(counts: DataFrame, buckets: int = BUCKETS, prior_share: float | None = None) -> DataFrame:
    """One row: the fixed-point log ratio of every bucket, as an array; of the whole target, then without each fold.

    The target is drawn to the corpus by ``prior_share`` of its own n-grams, or else by PRIOR per bucket.
    """
    folds = [F.col(f"fold_{k}") for k in range(FOLDS)]
    whole = sum(folds[1:], folds[0])
    parts = [whole] + [whole - fold for fold in folds]
    sums = counts.agg(F.sum("corpus").alias("all_corpus"), *(F.sum(part).alias(f"all_{i}") for i, part in enumerate(parts)))

    def corpus_share(weight: Column) -> Column:
        return weight * (F.col("corpus") + EVEN) / (F.col("all_corpus") + EVEN * buckets)

    def weight(i: int, part: Column) -> Column:
        total = F.col(f"all_{i}")
        pseudo = F.lit(float(PRIOR * buckets)) if prior_share is None else prior_share * total
        # Without a target nothing is known; the 1 keeps the unused quotient defined.
        target = (part + corpus_share(pseudo)) / F.greatest(total + pseudo, F.lit(1.0))
        ratio = F.round((F.log(target) - F.log(corpus_share(F.lit(1.0)))) * SCALE).cast("int")
        return F.when(total > 0, ratio).otherwise(F.lit(0))

    named = [weight(i, part).alias(f"w{i}") for i, part in enumerate(parts)]
    pairs = counts.crossJoin(F.broadcast(sums)).select(F.struct("bucket", *named).alias("pair"))
    listed = pairs.agg(F.sort_array(F.collect_list("pair")).alias("pairs"))
    arrays = F.array(*(F.col("pairs").getField(f"w{i}") for i in range(len(parts))))
    return saved(listed.select(arrays.alias("weights")), "bucket-weights")


def _units(weights: Column, buckets: int) -> Column:
    """The sum of the weights of a row's n-grams."""

    def units(column: str, weight: Column) -> Column:
        add = lambda total, h: total + F.get(weight, bucket(h, buckets))
        return F.aggregate(F.col(column), F.lit(0).cast("long"), add)

    return let(weights, lambda weight: units("hashes", weight) + units("pairs", weight))


_MEASURES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _grams() -> Column:
    return F.greatest(2 * F.col("n_words") - 1, F.lit(1))


def _failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and score of every row.

    ``docs`` has doc_id and text, ``trusted`` the doc_id of trusted documents; other columns are ignored. base_failed: fewer
    than 20 words, or more than 30 % of the words in repeated windows. kept: not that, and a score of at least
    ``threshold`` mean nats. A null text counts as empty; a text without words has score 0. Repeated rows are judged
    each, and count in the corpus as often as they stand there. Without trusted documents every score is 0.
    """
    weights = bucket_weights(bucket_counts(docs, trusted, buckets), buckets)
    scored = with_base(docs).withColumn("weights", weights.scalar())
    scored = scored.withColumn("units", _units(F.get("weights", F.lit(0)), buckets))
    return scored.select(
        *_MEASURES,
        _failed().alias("base_failed"),
        (~_failed() & (F.col("units") >= F.floor(F.lit(threshold * SCALE) * _grams()))).alias("kept"),
        (F.col("units") / _grams() / F.lit(float(SCALE))).alias("score"),
    )


def judged_by_trusted(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, lowest: float = LOWEST) -> DataFrame:
    """The columns of ``judged``, with a prior and a threshold that follow the trusted documents.

    The prior is PRIOR_SHARE of the target's n-grams, so the least weight of a bucket is the same for any amount of trusted
    text. The threshold is the greatest bin of 1 / FINE nats below which at most the share ``lowest`` of the trusted rows
    that pass the plain rules score, each against the target without its own fold. Without such rows only the plain rules
    reject.
    """
    weights = bucket_weights(bucket_counts(docs, trusted, buckets), buckets, PRIOR_SHARE)
    scored = with_base(docs).withColumn("weights", weights.scalar())
    held = F.get("weights", F.coalesce(fold_of(F.col("doc_id")), F.lit(0)) + 1)
    scored = scored.select(
        *_MEASURES,
        _failed().alias("base_failed"),
        _units(F.get("weights", F.lit(0)), buckets).alias("units"),
        F.floor(_units(held, buckets) * FINE / (_grams() * SCALE)).alias("bin"),
    )
    scored = saved(scored, "scored")
    own = scored.where("NOT base_failed").join(trusted.select("doc_id").distinct(), "doc_id", "left_semi")
    bins = own.groupBy("bin").agg(F.count("*").alias("n"))
    up_to = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bins.select("bin", F.sum("n").over(up_to).alias("rank"), F.sum("n").over(Window.partitionBy()).alias("all"))
    cut = saved(ranked.where(F.col("rank") > lowest * F.col("all")).agg(F.min("bin").alias("cut")), "cut")
    above = F.coalesce(F.col("units") * FINE >= F.col("cut") * SCALE * _grams(), F.lit(True))
    return scored.withColumn("cut", cut.scalar()).select(
        *_MEASURES,
        "base_failed",
        (~F.col("base_failed") & above).alias("kept"),
        (F.col("units") / _grams() / F.lit(float(SCALE))).alias("score"),
    )
