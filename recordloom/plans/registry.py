"""Queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder of tables) → DataFrame under its name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(rows: DataFrame, key: str, most: int = 10_000) -> DataFrame:
    """Rows of a table in few files, each long to work on, dealt by its key to tasks of about ``most`` rows, so that the tasks grow in number with the table."""
    return rows.repartition(max(1, -(-rows.count() // most)), key)


def home_of(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; without ``spark.checkpoint.dir`` only a local session gets one."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="records-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
