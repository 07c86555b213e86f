"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import (
    decontamination,
    feistel,
    html_text,
    ngram_join,
    oracle,
    periodic_runs,
    quality_model,
    quality_rules,
    secrets,
    sentencepieces,
    toxicity,
    url_filters,
    vector_codes,
    warc,
)
from faremill.llm.store import saved


#: A SentencePiece model that the driver can read; its content is broadcast.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(_table(spark, sf_dir, "pages")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.judged_by_trusted(_table(spark, sf_dir, "documents"), trusted)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.sharded(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.contained_items(docs, items).drop("doc_row", "text_key")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op8_sentencepieces(spark: SparkSession, sf_dir: str, model_file: str = MODEL_FILE) -> DataFrame:
    return sentencepieces.encoded(_table(spark, sf_dir, "documents"), Path(model_file).read_bytes())


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number ends its path, so that document's label is the page's."""
    labels = _table(spark, sf_dir, "labels").selectExpr("doc_id AS url_key", "quality = 1 AS good")
    return url_filters.judged(_table(spark, sf_dir, "pages"), labels)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of every tenth text (by a checksum of its id) repeat from some word on.

    Such a text is written anew, words joined by one space; the others stay as they are.
    """
    mark = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(words):
        g, n = F.expr("mark div 10"), F.size(words).cast("long")
        whole = F.struct(words.alias("words"), (g % n).alias("a"), (F.lit(3) + g % 8).alias("times"))

        def written(w):
            period = F.expr("1L") + F.floor((F.size(w["words"]) - w["a"]) / w["times"])
            place = lambda i: F.when(i < w["a"], i).otherwise(w["a"] + (i - w["a"]) % period)
            return F.transform(w["words"], lambda _, i: F.get(w["words"], place(i).cast("int")))

        return F.get(F.transform(F.array(whole), written), F.lit(0))

    marked = docs.select("doc_id", "text", mark.alias("mark"))
    chosen = F.when(F.col("mark") % 10 == 0, words)
    marked = marked.withColumn("words", chosen)
    text = F.when(F.size("words") > 0, F.array_join(repeated(F.col("words")), " ")).otherwise(F.col("text"))
    return marked.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs and of the collapsed text; the best run has the greatest exponent, then the smallest start."""
    found = periodic_runs.periodic_runs(with_periodic_tails(_table(spark, sf_dir, "documents")))
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start"),
        F.col("best.length"),
        F.col("best.period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in hex, errors also summed over equal labels, and a digest of the codebooks. A sum beyond a long is null."""
    vectors = _table(spark, sf_dir, "embeddings")
    codes = vector_codes.fitted(vectors)
    rows = saved(vector_codes.encoded(vectors, codes), "codes")
    sums = rows.groupBy("label").agg(F.sum("error").alias("total")).withColumnRenamed("label", "of_label")
    digest = hashlib.sha256(",".join(map(str, codes.numbers())).encode()).hexdigest()
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select(
        "vec_id",
        vector_codes.hex_code(F.col("code")).alias("code"),
        F.expr("try_cast(error AS bigint)").alias("error"),
        F.expr("try_cast(total AS bigint)").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_warc_derivatives,
            op2_quality_rules,
            op3_secret_scans,
            op4_sharding,
            op5_decontamination,
            op6_quality_classifier,
            op7_html_extraction,
            op8_sentencepieces,
            op9_url_filters,
            op10_ngram_join,
            op11_toxicity,
            op12_periodic_runs,
            op13_vector_codes,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
