"""Nearest vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import cosine


def vector_top_k(df: DataFrame, key: str, vector: str, target: Sequence[float], k: int) -> DataFrame:
    """The ``k`` rows whose vector has the largest cosine to ``target``.

    The target is a constant in the plan; each task keeps its own best ``k``,
    so one scan without a shuffle of the vectors is enough.
    """
    wanted = F.array(*[F.lit(float(x)) for x in target])
    scored = df.select(key, cosine(F.col(vector), wanted).alias("similarity"))
    return scored.where("similarity IS NOT NULL").orderBy(F.desc("similarity"), key).limit(k)
