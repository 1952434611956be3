"""What can be plugged in: readers, stores, storage clients, identity and images, as protocols, and their choice by address."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession

from shelfmark.functions.values import is_mysql_dsn
from shelfmark.operators.store import Store
from shelfmark.sources import receiver


class Receiver(Protocol):
    def fetch_batch(self, limit: int, parser_name: str | None = None, after: tuple | None = None) -> DataFrame:
        """Raw records after a cursor (instant, product id), in its order."""

    def parser_names(self) -> list[str]:
        """The parsers that have records."""


class Catalog(Protocol):
    def cursor(self, parser: str) -> tuple | None: ...

    def commit(self, tables: dict[str, tuple[DataFrame, list[str]]], base: dict, cursors: dict[str, tuple] | None = None, batch: tuple[str, int] | None = None) -> int: ...


class Storage(Protocol):
    def __call__(self, name: str) -> bool:
        """Deletes an image; whether it is gone."""


class IdentityResolver(Protocol):
    def __call__(self, records: DataFrame, order: list[str], known: DataFrame | None) -> DataFrame:
        """records with canonical_product_id."""


class ImageHasher(Protocol):
    def __call__(self, url: Column) -> Column: ...


class TableReceiver:
    """Receiver over the eight tables of a MySQL address, a SQLite file or a folder of Parquet tables."""

    def __init__(self, spark: SparkSession, where: str):
        self.tables = receiver.tables(spark, where)

    def fetch_batch(self, limit: int, parser_name: str | None = None, after: tuple | None = None) -> DataFrame:
        return receiver.records(self.tables, limit, parser_name, after)

    def parser_names(self) -> list[str]:
        return receiver.parser_names(self.tables)


def open_catalog(spark: SparkSession, where: str) -> Catalog:
    """The store at a path of any file system that Spark reads. Databases are receivers, or get copies (sinks.database)."""
    if is_mysql_dsn(where):
        raise ValueError("the catalog is a folder of Parquet runs; a MySQL address can only be a receiver")
    return Store(spark, where)
