"""User functions over partitions and rows, and one fit per configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..session import kept


def apply_partitions(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Call ``function`` on the rows of a partition, one Arrow batch at a time,
    with a declared output schema."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(batches, schema)


def apply_iterator(
    df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: StructType | str
) -> DataFrame:
    """Call ``function`` once per partition with an iterator over its rows, a batch at a time.

    State may be carried across the batches; the partition is never in memory as a whole.
    """
    return df.mapInPandas(function, schema)


def apply_rows(function: Callable, returns: DataType | str) -> Callable[..., Column]:
    """Column function from a function on whole columns (pandas series), a batch at a time.

    Use a native column expression where one exists.
    """

    @F.pandas_udf(returns)
    def wrapped(*columns: pd.Series) -> pd.Series:
        return function(*columns)

    return wrapped


def config_sweep(
    df: DataFrame,
    estimator: Estimator,
    configs: Sequence[Mapping[str, object]],
    measure: Callable[[object], float],
    schema: str,
    names: Mapping[str, str] | None = None,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """Fit once per configuration on the same input and tabulate a measure.

    Each fit is a distributed job; the input is stored once for all of them, where ``level`` says.
    ``schema`` declares the configuration columns; ``measure`` is added. Values
    go to the columns of their names, or of what ``names`` calls a parameter.
    """
    columns, names = StructType.fromDDL(schema).names, names or {}
    for config in configs:
        if sorted(names.get(n, n) for n in config) != sorted(columns):
            raise ValueError(f"{sorted(config)} does not fill the columns {columns}")
    rows = []
    with kept(df, level) as data:
        for config in configs:
            model = estimator.copy({estimator.getParam(name): v for name, v in config.items()}).fit(data)
            by_column = {names.get(n, n): v for n, v in config.items()}
            rows.append((*(by_column[c] for c in columns), float(measure(model))))
    return df.sparkSession.createDataFrame(rows, f"{schema}, measure double")
