"""Date parsing, labels and date-driven filters. "Today" is always a parameter."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column

# Date formats of the delimited files and the submission list.
PARAMETER_DATE = "%m/%d/%Y"
FILE_DATE = "%Y%m%d"
SUBMITTED_FORMAT = "M/d/yyyy h:m:s a"


def keep_from_date(df: DataFrame, date_text: str, start: str) -> DataFrame:
    """Rows whose ``YYYYMMDD`` text is on or after ``start`` (``MM/DD/YYYY``); null dates drop out.

    The bound becomes a literal, so the comparison reaches the file scan.
    """
    bound = datetime.datetime.strptime(start, PARAMETER_DATE).strftime(FILE_DATE)
    return df.filter(column(date_text) >= bound)


def parse_submitted(text: Column) -> Column:
    """``MM/DD/YYYY hh:mm:ss AM`` as a timestamp without zone."""
    return F.to_timestamp_ntz(text, F.lit(SUBMITTED_FORMAT))


def iso_date(moment: Column) -> Column:
    """ISO date text of a date or timestamp; a timestamp without zone stays clear of zone rules."""
    return moment.cast("date").cast("string")


def clamp_to(day: Column, as_of: datetime.date) -> Column:
    """The day, or ``as_of`` if the day lies after it; null stays null."""
    return F.when(day.isNotNull(), F.least(day, F.lit(as_of)))


def academic_year(end_year: Column) -> Column:
    """Label such as ``2023-2024`` for the year that ends in 2024."""
    return F.concat((end_year - 1).cast("string"), F.lit("-"), end_year.cast("string"))


def skip_code_until(
    df: DataFrame, code_column: str, code: str, as_of: datetime.date, rollover: datetime.date | None = None
) -> DataFrame:
    """Drop the rows of one code until the rollover date has passed; without a date keep all."""
    if rollover is None or as_of > rollover:
        return df
    return df.filter(~column(code_column).eqNullSafe(F.lit(code)))
