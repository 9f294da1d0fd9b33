"""Names that stored tables use beside the user's own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

RESERVED = "__siltstone_"
VERDICT = f"{RESERVED}verdict"
BATCH = f"{RESERVED}batch"
RUN = f"{RESERVED}run"


def refuse_reserved(df: DataFrame) -> DataFrame:
    """``df`` itself, unless it has a column whose name is kept for the library."""
    taken = [c for c in df.columns if c.lower().startswith(RESERVED)]
    if taken:
        raise ValueError(f"column names starting with {RESERVED} are reserved: {', '.join(taken)}")
    return df
