"""Item streams: ``(pos bigint, item bigint)``, pos the 0-based stream position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def integer_column(text: Column) -> Column:
    """The text as a long; anything but an optional sign and digits fails the query, whatever
    ``spark.sql.ansi.enabled`` says."""
    good = text.rlike(r"^[+-]?[0-9]+$")
    bad = F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("null"))))
    value = F.when(good, text.try_cast("bigint"))
    return F.when(value.isNull(), bad.cast("bigint")).otherwise(value)


def parse_items(lines: DataFrame, line_col: str = "value", pos_col: str | None = None) -> DataFrame:
    """One integer per line; a malformed line, blanks around the number included, fails the job."""
    pos = F.col(pos_col).cast("bigint") if pos_col else F.monotonically_increasing_id()
    return lines.select(pos.alias("pos"), integer_column(F.col(line_col)).alias("item"))


def items_from_events(events: DataFrame) -> DataFrame:
    """ITEMS: event_id is dense 0..N-1 in time order and serves as the stream position."""
    return events.select(F.col("event_id").alias("pos"), F.col("user_id").alias("item"))
