"""Text to date in the US order month/day/year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the input writes a date.
US_DATE = "MM/dd/yyyy"

_PARTS = r"^[ \t]*(-?[0-9]+)/[ \t]*(-?[0-9]+)/[ \t]*(-?[0-9]+)"


def strict_us_date(text: Column) -> Column:
    """Date of ``MM/dd/yyyy`` text, null for anything else; one-digit parts are fine."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date")


def lenient_us_date(text: Column) -> Column:
    """Date that starts ``text``, with out-of-range months and days carried over.

    Plain dates take the quick way; only other text is taken apart. Null where the year, as
    written or as it comes out, is not between 1 and 9999, the years a date may have; months
    and days beyond ten thousand years could only lead there, and are not counted out.
    """

    def part(group: int) -> Column:
        return F.regexp_extract(text, _PARTS, group).try_cast("int")

    month, day, year = part(1), part(2), part(3)
    sensible = (
        year.between(1, 9999) & month.between(-120_000, 120_000) & day.between(-3_660_000, 3_660_000)
    )
    january = F.make_date(year, F.lit(1), F.lit(1))
    carried = F.when(sensible, F.date_add(F.add_months(january, month - 1), day - 1))
    return F.coalesce(strict_us_date(text), F.when(F.year(carried).between(1, 9999), carried))
