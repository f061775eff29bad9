"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import configure

SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def salt_of(*cols: Column, salts: int = SALTS) -> Column:
    """A salt from a row's own values, so that a re-run task gives the same one."""
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def salted(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every row once for each salt, as column ``salt``."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def sheltered(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with all but the needed columns renamed by position, so that no name of theirs clashes; and its names."""
    names = [c if c in needed else f"__column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def sent_whole(name: str) -> None:
    """Send a module's code along with its tasks, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def once(name: str, make):
    """``make()``, kept for the life of a Python worker, whose tasks load their code anew."""
    kept = sys.modules.setdefault("_siltstone_once", types.ModuleType("_siltstone_once")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
