"""Field access on one JSON log line held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deliverylens.functions.text import finite


# A number that is none, outside of strings: what follows it up to the end holds whole strings only.
_NO_NUMBER = r'(?<![\w"])(?:-?Infinity|NaN)(?![\w"])(?=(?:[^"\\]++|"(?:[^"\\]++|\\.)*+")*+$)'


def parse_line(line: Column) -> Column:
    """VARIANT of a line, null when the line is no JSON.

    NaN and the infinities are read as null. Lines with a repeated key need
    ``spark.sql.variant.allowDuplicateKeys``; the last value counts.
    """
    return F.coalesce(F.try_parse_json(line), F.try_parse_json(F.regexp_replace(line, _NO_NUMBER, "null")))


def is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def text_field(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def safe_float(record: Column, path: str) -> Column:
    """Finite double; numeric text is read, booleans count as 1 and 0, others are null."""
    return finite(F.try_variant_get(record, path, "double"))


def safe_int(record: Column, path: str) -> Column:
    """Whole number; a fraction is cut towards zero, text must hold an integer."""
    raw = F.try_variant_get(record, path, "variant")
    kind = F.schema_of_variant(raw)
    as_text = F.try_variant_get(record, path, "string")
    from_text = F.when(F.trim(as_text).rlike(r"^[+-]?\d+$"), F.trim(as_text).try_cast("bigint"))
    return F.when(kind == F.lit("STRING"), from_text).otherwise(F.try_variant_get(record, path, "bigint"))


def is_error_status(record: Column, path: str = "$.status_code") -> Column:
    """True for codes of 400 and above and for codes that cannot be read."""
    return F.coalesce(safe_int(record, path) >= 400, F.lit(True))
