"""The dedup's map of whole rows is bounded by what a task reads."""

from __future__ import annotations

from faremill.plans import pipeline
from faremill.sources import tables
from faremill.storage import SPLIT_BYTES, scratch_path, small_splits


def test_f7_silver_is_built_from_small_splits(spark, flights, monkeypatch):
    house = tables.Warehouse(scratch_path(spark, "wh"), prefix="folds_")
    tables.create_all(spark, house)
    tables.overwrite(pipeline.bronze_flights(flights({}, {}, {"Airline": "Red"})), house, "bronze.flights")
    before, seen, overwrite = spark.conf.get(SPLIT_BYTES), [], tables.overwrite

    def watched(df, warehouse, table):
        seen.append(int(spark.conf.get(SPLIT_BYTES).rstrip("b")))
        overwrite(df, warehouse, table)

    monkeypatch.setattr(tables, "overwrite", watched)
    pipeline.build_silver(spark, house)
    assert seen == [pipeline.FOLD_BYTES] and spark.conf.get(SPLIT_BYTES) == before
    assert sorted(r.Airline for r in tables.read_table(spark, house, "silver.flights").collect()) == ["Blue", "Red"]
    with small_splits(spark, 1 << 40):
        assert int(spark.conf.get(SPLIT_BYTES)) == 128 << 20
    tables.remove_all(spark, house)
