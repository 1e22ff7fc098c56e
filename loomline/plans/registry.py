"""Extension points: named steps, functions over batches of lines, and map-reduce over partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame

_STEPS: dict[str, Callable[..., DataFrame]] = {}


class RowFilter(Protocol):
    """A filter is a name and a condition under which a row is dropped; see operators.filters.Rule."""

    name: str
    drop: Column


def step(name: str):
    """Register a function that returns a DataFrame under a name."""

    def keep(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in _STEPS:
            raise ValueError(f"step {name} is registered already")
        _STEPS[name] = f
        return f

    return keep


def build(name: str, *args, **kwargs) -> DataFrame:
    if name not in _STEPS:
        raise KeyError(f"no step {name}; known: {sorted(_STEPS)}")
    return _STEPS[name](*args, **kwargs)


def map_lines(df: DataFrame, f: Callable[[Iterable[dict]], Iterable[dict]], schema: str, setup: Callable[[], object] | None = None) -> DataFrame:
    """Any number of rows out of the rows of a partition; `setup` runs once per task and its result
    is passed on as the second argument. Rows come in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = setup() if setup else None
        for pdf in batches:
            rows = pdf.to_dict("records")
            out = list(f(rows, state) if setup else f(rows))
            if out:
                yield pd.DataFrame(out)

    return df.mapInPandas(run, schema)


def map_reduce(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], partial: str, keys: list[str], merge: list[Column]) -> DataFrame:
    """Partial results of each Arrow batch, merged by an aggregate per key."""
    return df.mapInPandas(lambda it: (f(x) for x in it), partial).groupBy(*keys).agg(*merge)


def once_per_value(df: DataFrame, col: str, expensive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply an expensive step to the distinct values of a column and join the results back."""
    return df.join(expensive(df.select(col).distinct()), col, "left")


def checked(df: DataFrame, **conditions: Column) -> DataFrame:
    """Fail at run time on a row that breaks a named condition; a null condition passes."""
    from pyspark.sql import functions as F

    for name, c in conditions.items():
        df = df.where(F.when(F.coalesce(c, F.lit(True)), F.lit(True)).otherwise(F.raise_error(F.lit(f"condition {name} is broken")).cast("boolean")))
    return df


def composed(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Several steps as one: pre-processing and encoding, for instance."""

    def run(df: DataFrame) -> DataFrame:
        for f in steps:
            df = f(df)
        return df

    return run


def staged(spark, name: str, version: str, config: dict, build: Callable[[], DataFrame], valid: Callable[[DataFrame], bool] | None = None) -> DataFrame:
    """The result of a step, kept in the shared scratch folder under a key of its name, version and configuration, and read back
    instead of built if it is there, was written to the end and is valid. Makes a pipeline resumable stage by stage."""
    import hashlib
    import json

    from loomline.session import scratch_dir

    key = hashlib.sha256(json.dumps([name, version, config], sort_keys=True, default=str).encode()).hexdigest()
    path = f"{scratch_dir(spark)}/stage-{name}-{key}"
    done = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df = spark.read.parquet(path)
        if valid is None or valid(df):
            return df
    build().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
