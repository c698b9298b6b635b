"""Collects queries and oracle texts of one module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import views


class Tables:
    """Derived views of one data folder by attribute: ``t.reads``, ``t.alignments``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in views.BASE_TABLES:
            return views.base(self.spark, self.sf_dir, name)
        return views.view(self.spark, self.sf_dir, name)


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None, *needs: str):
        """Register ``fn(tables) -> DataFrame`` under ``name``; ``needs`` are the oracle's views."""

        def wrap(fn):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                ship_package(spark)
                return fn(Tables(spark, sf_dir))

            self.queries[name] = run
            if oracle is not None:
                self.oracles[name] = views.oracle(oracle, *needs) if needs else oracle
            return fn

        return wrap
