"""Query registry: ``name -> (spark callable, oracle SQL or None)``.

Spark results round every double column to 6 decimals and the oracle SQL
rounds the same columns, so that floating sums taken in a different order
still hash equal.  Queries whose result is learned or randomised register
no oracle; they are covered by property tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double/float columns for order-insensitive value hashing."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_up(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def round_half_up(c, digits: int = DIGITS):
    """``floor(x * 10^d + 0.5) / 10^d``: the same IEEE operations in Spark and
    DuckDB, so equal inputs give equal outputs (the built-in ``round``
    functions of the two engines differ on ties)."""
    scale = float(10 ** digits)
    return F.when(F.isnan(c), c).otherwise(F.floor(c * scale + 0.5) / scale)


def sql_round(expr: str, digits: int = DIGITS) -> str:
    """DuckDB twin of :func:`round_half_up`."""
    return f"floor(CAST({expr} AS DOUBLE) * {10 ** digits}.0 + 0.5) / {10 ** digits}.0"


def rounded(sql: str, cols: list[str], digits: int = DIGITS) -> str:
    """Wrap oracle SQL so that ``cols`` are rounded like :func:`finish`."""
    if not cols:
        return sql
    rep = ", ".join(f"CAST({sql_round(c, digits)} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"


def query(name: str, oracle: str | None = None):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from propval.session import ensure_checkpoint_dir, workers_import
            ensure_checkpoint_dir(spark)   # iterative operators cut lineage with checkpoint()
            workers_import(spark)
            return finish(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from propval.plans import q_extract, q_features, q_metrics, q_models, q_sources, q_tags, q_text  # noqa: F401
