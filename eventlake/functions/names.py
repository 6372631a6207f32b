"""Column names that an operator may use beside those of a user's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(*wanted: str, beside: list[DataFrame]) -> list[str]:
    """Names like the wanted ones that no column of the tables has; case does not matter, as in Spark."""
    taken = {c.lower() for df in beside for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def refuse_names(df: DataFrame, names: list[str]) -> None:
    """An error if the table has columns that a result would add."""
    clash = sorted({c for c in df.columns if c.lower() in {n.lower() for n in names}})
    if clash:
        raise ValueError(f"the table already has the columns {clash}; rename them first")
