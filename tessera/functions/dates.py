"""Date and time expressions.  All assume the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_to_ts(c: Column) -> Column:
    """Epoch seconds (long, or a numeric string) -> timestamp; junk -> null."""
    return F.timestamp_seconds(c.try_cast("bigint"))


def ts_to_epoch(c: Column) -> Column:
    return F.unix_seconds(c)


def iso_ts(c: Column) -> Column:
    """Timestamp -> ISO-8601 text with microseconds, the stored string form."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def parse_iso_date(c: Column) -> Column:
    """ISO date text -> date; anything unparseable -> null."""
    return F.call_function("try_to_date", c, F.lit("yyyy-MM-dd"))


def change_order(processed_at: Column, sequence_number: Column) -> Column:
    """Total order of changes: arrival time, then the numeric sequence number.

    Sequence numbers are digit strings of varying length, so they are compared
    as decimal(38,0), never as text ("10" < "9" as text).
    """
    return F.struct(processed_at.alias("t"), sequence_number.try_cast("decimal(38,0)").alias("s"))


def date_parts(df: DataFrame, ts_col: str) -> DataFrame:
    """year / month / day of a timestamp column's date (PRJ-09)."""
    d = F.col(ts_col).cast("date")
    return df.withColumn("year", F.year(d)).withColumn("month", F.month(d)).withColumn("day", F.dayofmonth(d))


def date_parts_epoch(df: DataFrame, epoch_col: str) -> DataFrame:
    """created_date / year / month / day from epoch seconds (PRJ-10).

    A non-numeric value gives null parts instead of an ANSI cast error.
    """
    d = epoch_to_ts(F.col(epoch_col)).cast("date")
    return (df.withColumn("created_date", d)
            .withColumn("year", F.year("created_date"))
            .withColumn("month", F.month("created_date"))
            .withColumn("day", F.dayofmonth("created_date")))
