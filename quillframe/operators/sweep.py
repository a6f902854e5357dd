"""One fit per configuration, several at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..session import stored


def concurrent_sweep(
    df: DataFrame,
    estimator: Estimator,
    configs: Sequence[Mapping[str, object]],
    measure: Callable[[object], float],
    schema: str,
    names: Mapping[str, str] | None = None,
    workers: int = 4,
) -> DataFrame:
    """Fit once per configuration on one stored input, ``workers`` fits at a time, and tabulate a measure.

    Each fit is a distributed job of its own; its thread has its own local properties
    and its own scheduler pool, so that with ``spark.scheduler.mode`` FAIR the fits
    share the cluster evenly instead of waiting for the largest. The rows come in the
    order of the configurations. A fit that fails leaves ``measure`` null and its
    reason in ``error``; the others go on.

    ``schema`` declares the configuration columns; ``measure`` and ``error`` are added.
    Values go to the columns of their names, or of what ``names`` calls a parameter.
    """
    columns, names = StructType.fromDDL(schema).names, names or {}
    for config in configs:
        if sorted(names.get(n, n) for n in config) != sorted(columns):
            raise ValueError(f"{sorted(config)} does not fill the columns {columns}")
    spark = df.sparkSession
    context = spark.sparkContext
    data = stored(df, "sweep-input")

    @inheritable_thread_target(spark)
    def fit(at: int):
        config = configs[at]
        context.setLocalProperty("spark.scheduler.pool", f"sweep-{at % workers}")
        context.setJobDescription(f"fit {at + 1} of {len(configs)}: {dict(config)}")
        try:
            model = estimator.copy({estimator.getParam(name): v for name, v in config.items()}).fit(data)
            return float(measure(model)), None
        except Exception as error:  # noqa: BLE001
            return None, f"{type(error).__name__}: {error}"[:2000]

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        results = list(pool.map(fit, range(len(configs))))
    rows = []
    for config, result in zip(configs, results):
        by_column = {names.get(n, n): v for n, v in config.items()}
        rows.append((*(by_column[c] for c in columns), *result))
    return spark.createDataFrame(rows, f"{schema}, measure double, error string")
