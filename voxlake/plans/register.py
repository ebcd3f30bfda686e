"""The table of queries: name, function and oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Spark sends a table to all tasks by the size of its files, and builds it in the driver first: packed columns take some hundred times as much there.
BROADCAST, MOST = "spark.sql.autoBroadcastJoinThreshold", 256 << 10


def own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's with the same settings, but in which Spark by itself sends only small tables to all tasks."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    if own.conf.get(BROADCAST) != "-1":
        own.conf.set(BROADCAST, str(MOST))
    return own


def in_own_session(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(own_session(spark), sf_dir)

    return run


def query(name: str, oracle: str | None = None):
    """Registers f(spark, sf_dir) under a name, with DuckDB SQL for the same rows where SQL can express them."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = in_own_session(f)
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles at fixed places, for comparison: sums depend on order in the last digits."""
    from pyspark.sql import functions as F

    return df.select(*[(F.round(c, places) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
