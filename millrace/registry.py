"""Named queries: a Spark plan, and where SQL can state it, an independent SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the Parquet tables of one folder, e.g. ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


for _name in TABLE_NAMES:
    _prop = cached_property(lambda self, n=_name: self._read(n))
    _prop.__set_name__(Tables, _name)
    setattr(Tables, _name, _prop)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with its SQL twin if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register
