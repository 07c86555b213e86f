"""Rejects: cheap tests give what the full ones give, and names are put together after the dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions import parsing
from faremill.plans import silver
from faremill.plans.bronze import bronze_flights
from faremill.schemas import MONEY

TEXTS = [
    None, "", " ", "n/a", "abc", "1/2/2020", "01/02/2020", "31/2/2019", "2019-03-24", "1/2", "1/2/+12345", "-1/2/2020", " 1/2/2020",
    "1/2/2020 ", "/2/2020", "//", "1//2020", "٣", "١/٢/٢٠٢٠", "3897", "  3897.555  ", ".5", "5.", "1e3", "NaN", "Infinity", "123456789012",
    "\t7\n", "-0", "0x1A", "7f", "2h", "2h 50m", "50m", "h", "9999999h", "99999999h", "35791394h 8m", "35791394h", "2147483647m", "9999999999m",
    "99999999999h", "٣h", "1 h", "x12hm", "999999h999999999m",
]


def test_f8_guarded_parsers_give_the_same(spark, ansi):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    t = F.col("t")
    old = F.struct(
        F.try_to_date(t, parsing.DATE_PATTERN).cast("string"),
        t.try_cast(MONEY),
        F.coalesce(t.rlike(parsing.HOURS) | t.rlike(parsing.MINUTES), F.lit(False)),
        F.coalesce(t.rlike(parsing.HOURS) | t.rlike(parsing.MINUTES), F.lit(False)) & parsing.duration_minutes(t).isNotNull(),
    )
    short = ~((F.length(t) > parsing.SHORT_DURATION) & parsing.duration_minutes(t).isNull())
    has = parsing.has_duration(t)
    new = F.struct(parsing.journey_date(t).cast("string"), parsing.fare(t), has, has & F.coalesce(short, F.lit(True)))
    for row in rows.select("t", old.alias("old"), new.alias("new")).collect():
        assert tuple(row.old) == tuple(row.new), row.t


def test_f8_flag_and_names_agree(spark, flights, ansi):
    columns = ("Date_of_Journey", "Duration", "Total_Stops", "Price")
    rows = flights({}, *[{column: text} for column in columns for text in TEXTS])
    agree = parsing.is_rejected() == (parsing.rejected_columns() != "")
    assert rows.where(agree).count() == rows.count()


def test_f8_names_come_after_the_dedup(spark, flights):
    found = silver.rejects(bronze_flights(flights({}, {"Price": "n/a"}, {"Price": "n/a"})))
    assert [r.rejected_columns for r in found.collect()] == ["Price"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws") == 1
