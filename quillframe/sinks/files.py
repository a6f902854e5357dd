"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Replace what is at ``path`` with the chosen columns."""
    (df.select(*columns) if columns else df).write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Replace what is at ``path`` with a one-column frame as text, written in parallel.

    ``partitions=1`` asks for a single file, which is then one task's work.
    """
    (df if partitions is None else df.repartition(partitions)).write.mode("overwrite").text(path)
