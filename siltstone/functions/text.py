"""JSON text to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions.casts import struct_of


def open_json(df: DataFrame, column: str, schema: str | StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of a JSON object as columns, each text being parsed once.

    ``from_json`` in a plain projection is copied into every filter and field
    access above it, and the text parsed again for each.  As the input of a
    generator it is evaluated once per row and nothing can be pushed below it.
    Unreadable text gives a row of NULLs.
    """
    parsed = F.from_json(F.col(column), struct_of(schema))
    return df.select(F.inline(F.array(parsed)), *keep)
