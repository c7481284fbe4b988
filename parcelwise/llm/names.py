"""Column names that the caller's table does not use."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *wanted: str) -> list[str]:
    """Each wanted name, with underscores added until no column has it (case aside)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
