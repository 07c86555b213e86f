"""Column expressions that turn landed text into typed values.

Every expression is total: text that does not parse becomes NULL (or the documented
default) under both ANSI settings, and ``rejected_columns`` names the columns concerned.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from faremill.schemas import MONEY

# Accepted spellings of the stop count, the date pattern, the duration units.
STOP_COUNTS = {"non-stop": 0, "1 stop": 1, "2 stops": 2, "3 stops": 3, "4 stops": 4}
DATE_PATTERN = "d/M/yyyy"
HOURS = r"(\d+)h"
MINUTES = r"(\d+)m"
HOURS_OR_MINUTES = r"\d[hm]"
#: Up to this length no duration has the digits to be too long for an int.
SHORT_DURATION = 8


def journey_date(text: Column) -> Column:
    """day/month/year with one or two digits; NULL for anything else.

    Text without two slashes never gets to the parser, where each failure costs an exception.
    """
    return F.when(text.like("%/%/%"), F.try_to_date(text, DATE_PATTERN))


def _quantity(text: Column, pattern: str) -> Column:
    # The leading 0 makes "no match" read as zero with a single regex pass per row,
    # while digits too long for an int still give NULL.
    digits = F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1)
    return F.concat(F.lit("0"), digits).try_cast("int").cast("bigint")


def duration_minutes(text: Column) -> Column:
    """``2h 50m`` as 170; an absent part counts 0; NULL when it overflows."""
    return (_quantity(text, HOURS) * 60 + _quantity(text, MINUTES)).try_cast("int")


def has_duration(text: Column) -> Column:
    """the text holds an hour or a minute part."""
    return F.coalesce(text.rlike(HOURS_OR_MINUTES), F.lit(False))


def stop_count(text: Column) -> Column:
    """Known spellings to their number, everything else (NULL too) to 0."""
    (first, number), *rest = STOP_COUNTS.items()
    chain = reduce(
        lambda case, item: case.when(text == item[0], F.lit(item[1])),
        rest,
        F.when(text == first, F.lit(number)),
    )
    return chain.otherwise(F.lit(0))


def is_direct(stops: Column) -> Column:
    """The flag over the normalised stop count; never NULL."""
    return F.coalesce(stops == 0, F.lit(False))


def fare(text: Column) -> Column:
    """Money with two digits, rounded half up, outer blanks ignored.

    Text without a digit of any script is not cast, since each failure costs an exception.
    """
    return F.when(text.rlike(r"\p{Nd}"), text.try_cast(MONEY))


def _problems() -> dict[str, Column]:
    """Raw columns and whether their silver value is NULL or a default; never NULL."""
    date, duration, stops, price = (
        F.col(name) for name in ("Date_of_Journey", "Duration", "Total_Stops", "Price")
    )
    too_long = (F.length(duration) > SHORT_DURATION) & duration_minutes(duration).isNull()
    return {
        "Date_of_Journey": journey_date(date).isNull(),
        "Duration": ~has_duration(duration) | too_long,
        "Total_Stops": ~F.coalesce(stops.isin(list(STOP_COUNTS)), F.lit(False)),
        "Price": fare(price).isNull(),
    }


def is_rejected() -> Column:
    """Whether ``rejected_columns`` names any, cheapest tests first; later ones run only where the earlier hold nothing."""
    problems = _problems()
    return reduce(or_, [problems[name] for name in ("Total_Stops", "Duration", "Price", "Date_of_Journey")])


def rejected_columns() -> Column:
    """Comma list of raw columns whose silver value is NULL or a default, '' when none."""
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in _problems().items()])
