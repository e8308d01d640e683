"""Join helpers with explicit size checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a dimension is not broadcast; beyond it the join is left
# to the planner (sort-merge / shuffled hash, AQE may still convert it).
DEFAULT_BROADCAST_ROWS = 100_000


def bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def text_bytes(df: DataFrame) -> int:
    """Bytes in the string and binary columns of ``df``, which have no fixed width."""
    wide = [F.octet_length(c) for c, t in df.dtypes if t in ("string", "binary")]
    return (df.agg(F.sum(sum((F.coalesce(x, F.lit(0)).cast("long") for x in wide), F.lit(0)))).first()[0] or 0) if wide else 0


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only for a side whose row count (and, where asked for, whose bytes) were checked."""
    fits = bounded(df, max_rows) and (max_bytes is None or text_bytes(df) <= max_bytes)
    return F.broadcast(df) if fits else df


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table built from literals in code (size fixed by construction)."""
    return F.broadcast(df)
