"""What the operators of this subpackage share: tables, stored intermediate results, joins on hot keys."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import checkpoint_root
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

# A key is hot from this share of the rows on, so there are at most HOT_KEYS of them.
HOT_KEYS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session; set once where none is configured (a local master only)."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_root(spark)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files: a lost executor costs a read."""
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with the one row of ``groups`` for its key; ``groups`` has to be stored.

    ``size`` tells how many of the ``total`` rows have the key.  Keys with over 1/HOT_KEYS of the rows are
    at most HOT_KEYS in number: they are broadcast and their rows stay where they are.  Only the rows of the
    other keys are shuffled, none of which can fill a task.
    """
    least = max(2, total // HOT_KEYS)
    hot = F.broadcast(groups.where(F.col(size) >= least))
    there = rows.join(hot, key)
    rest = rows.join(hot.select(key), key, "left_anti").join(groups.where(F.col(size) < least), key)
    return there.unionByName(rest)


def wrapped(docs: DataFrame, column: str = "_row") -> DataFrame:
    """All columns as one struct, so that no name of an operator's own can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(column))


def unwrapped(columns: list[str], changed: dict | None = None, row: str = "_row") -> list:
    """The columns of :func:`wrapped` again, some of them replaced."""
    changed = changed or {}
    return [(changed[c] if c in changed else F.col(row).getField(c)).alias(c) for c in columns]


def kept_in_worker(key: str, make: Callable):
    """What ``make`` gives, made once in each Python worker: it outlives the task where workers are used again."""
    held = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]
