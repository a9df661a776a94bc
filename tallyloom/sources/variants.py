"""JSON lines kept whole: known fields as columns, everything as a VARIANT that can be read again.

A line is parsed once. The columns of today's schema are taken out of the parsed value, and the value itself
is stored beside them, so a field that a later schema names is recovered from the stored records without the
lines. Lines that are bad today are stored with their text and can be parsed again under another schema.

A line is bad if it is not one JSON object, or a known field has a value of another type: a whole column
takes whole numbers, a double any number, a boolean true and false, a text any single value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.lines import more_than_one_object
from tallyloom.sources.schemas import CORRUPT

WHOLE = "whole"


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a field of a parsed line can stand in a column; one that is missing or null can."""
    found = F.schema_of_variant(value)
    if isinstance(kind, T.IntegralType):
        good = found.isin("BIGINT", "VOID")
    elif isinstance(kind, T.FractionalType):
        good = found.rlike("^(BIGINT$|DOUBLE$|DECIMAL|VOID$)")
    elif isinstance(kind, T.BooleanType):
        good = found.isin("BOOLEAN", "VOID")
    else:
        good = ~found.rlike("^(OBJECT|ARRAY)")
    return F.coalesce(good, F.lit(True))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Rows with one more column, computed once per row: filters above don't compute the output of a generator again."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _shredded(values: DataFrame, schema: T.StructType, text: Column) -> DataFrame:
    """From rows with ``WHOLE``: the columns of ``schema``, ``WHOLE``, and the text of lines that are bad."""
    whole = F.col(WHOLE)
    fields = F.struct(*[F.try_variant_get(whole, f"$.{f.name}", "variant").alias(f"f{i}") for i, f in enumerate(schema.fields)])
    values = _once(values, "fields", fields)
    good = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    for i, field in enumerate(schema.fields):
        good = good & _fits(F.col(f"fields.f{i}"), field.dataType)
    values = _once(values, "good", good)
    columns = [
        F.when(F.col("good"), F.try_variant_get(F.col(f"fields.f{i}"), "$", f.dataType.simpleString())).alias(f.name) for i, f in enumerate(schema.fields)
    ]
    return values.select(*columns, F.when(F.col("good"), whole).alias(WHOLE), F.when(~F.col("good"), text).alias(CORRUPT))


def parse_whole_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Per line that isn't blank: the columns of ``schema``, the whole value, and the text if it is bad.

    As of ``parse_lines``, a ``null`` line is bad; a missing field is NULL.
    """
    text = F.col(line)
    one = F.when(~more_than_one_object(text), F.try_parse_json(text))
    # As the output of a generator the value is parsed once per line.
    parsed = lines.where(F.length(F.trim(text)) > 0).select(text, F.explode(F.array(F.struct(one.alias(WHOLE)))).alias("one"))
    return _shredded(parsed.select(line, f"one.{WHOLE}"), schema, text)


def read_again(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored records under another schema: columns anew from the whole value, bad lines from their text."""
    kept = records.where(F.col(CORRUPT).isNull()).select(WHOLE)
    # A kept value that no longer fits is bad under this schema, with the value as its text.
    again = _shredded(kept, schema, F.to_json(WHOLE))
    return again.unionByName(parse_whole_lines(records.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value")), schema))
