"""JSON text to event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.schemas import CORRUPT, STREAM_EVENT, with_corrupt_column


def more_than_one_object(line: Column) -> Column:
    """Text after the object, which the JSON parser would pass over in silence.

    Only lines with several closing braces, rare among flat events, are parsed
    a second time to tell nesting from two objects.
    """
    single = F.coalesce(F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))), F.lit(0)) == 1
    return ~line.rlike(r"\}\s*$") | (line.rlike(r"(?s)\}.*\}") & ~single)


def parse_lines(
    lines: DataFrame, line: str = "value", schema: T.StructType = STREAM_EVENT
) -> DataFrame:
    """One JSON object per row of text, for batch or stream.

    Gives the columns of ``schema`` and ``_corrupt_record``. Blank lines are left
    out. A line that is not exactly one JSON object, or has a field of the wrong
    type, keeps its whole text in ``_corrupt_record``. A missing field is NULL.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    event = F.from_json(line, with_corrupt_column(schema), options)
    text = F.col(line)
    # As the output of a generator the parsed event is computed once per line;
    # a plain column would be parsed again in every filter put on top of it.
    return (
        lines.select(text, F.explode(F.array(event)).alias("event"))
        .filter(F.col("event").isNotNull())
        .select(
            *[F.col(f"event.{name}").alias(name) for name in schema.fieldNames()],
            F.coalesce(f"event.{CORRUPT}", F.when(more_than_one_object(text), text)).alias(
                CORRUPT
            ),
        )
    )
