"""Tables into databases in two phases: tasks stage their rows, one transaction publishes them.

SQLite (format "shelfmark_sqlite_sink"): every task writes a file of its own beside the database, in a folder that all
executors share. commit() deletes the rows with the batch's keys and copies the files row by row, in one transaction, which
also notes the batch; abort() drops the files. A batch that is noted already changes nothing, so a job that runs again is harmless. A SQLite file has one
writer, so its size bounds what it is for. JDBC: executors write a staging table; then one transaction in the database
replaces the rows with equal keys, and no row passes through the driver.
As in the store, a key may have several rows: those of the batch all stay, older ones all go. Null keys equal each other in
SQLite; over JDBC rows with null keys replace nothing.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from decimal import Decimal

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from shelfmark.operators.store import Store

#: SQLite's types; everything else is text (decimals keep their digits, arrays and structs are given as JSON by to_flat).
TYPES = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}


def plain(value: object) -> object:
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        return str(value)
    return value if value is None or isinstance(value, int | float | str | bytes) else value.isoformat(" ") if hasattr(value, "isoformat") else str(value)


@dataclass
class Staged(WriterCommitMessage):
    path: str
    rows: int


class SqliteWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.batch = options["path"], options["table"], options.get("batch", "")
        self.keys = [k for k in options.get("keys", "").split(",") if k]
        self.schema, self.folder = schema, f"{options['path']}.stage-{uuid.uuid4().hex}"

    def _create(self, name: str) -> str:
        columns = ", ".join(f'"{f.name}" {TYPES.get(f.dataType.simpleString(), "TEXT")}' for f in self.schema)
        return f'CREATE TABLE IF NOT EXISTS "{name}" ({columns})'

    @staticmethod
    def _parts(paths: list[str]) -> Iterator[sqlite3.Connection]:
        for path in paths:
            with closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as part:
                yield part

    def write(self, iterator: Iterator[Row]) -> Staged:
        os.makedirs(self.folder, exist_ok=True)
        task = TaskContext.get()
        path, rows = f"{self.folder}/{task.partitionId()}-{task.taskAttemptId()}.db", 0
        with closing(sqlite3.connect(path)) as db:
            db.execute(self._create("staged"))
            marks = ", ".join("?" * len(self.schema))

            def values() -> Iterator[list]:
                nonlocal rows
                for row in iterator:
                    rows += 1
                    yield [plain(v) for v in row]

            db.executemany(f"INSERT INTO staged VALUES ({marks})", values())
            db.commit()
        return Staged(path, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        with closing(sqlite3.connect(self.path, isolation_level=None, timeout=60)) as db:
            staged = [m.path for m in messages if m]
            names = ", ".join(f'"{f.name}"' for f in self.schema)
            db.execute("BEGIN IMMEDIATE")
            try:
                db.execute("CREATE TABLE IF NOT EXISTS _batches (target TEXT, batch TEXT, PRIMARY KEY (target, batch))")
                done = self.batch and db.execute("SELECT 1 FROM _batches WHERE target = ? AND batch = ?", (self.table, self.batch)).fetchone()
                if not done:
                    db.execute(self._create(self.table))
                    if self.keys:
                        keys = ", ".join(f'"{k}"' for k in self.keys)
                        db.execute(f'CREATE INDEX IF NOT EXISTS "{self.table}_keys" ON "{self.table}" ({keys})')
                        same = " AND ".join(f'"{k}" IS ?' for k in self.keys)
                        for part in self._parts(staged):
                            db.executemany(f'DELETE FROM "{self.table}" WHERE {same}', part.execute(f"SELECT DISTINCT {keys} FROM staged"))
                    for part in self._parts(staged):
                        db.executemany(f'INSERT INTO "{self.table}" ({names}) VALUES ({", ".join("?" * len(self.schema))})', part.execute(f"SELECT {names} FROM staged"))
                    if self.batch:
                        db.execute("INSERT INTO _batches VALUES (?, ?)", (self.table, self.batch))
                db.execute("COMMIT")
            except BaseException:
                db.execute("ROLLBACK")
                raise
        self._drop()

    def abort(self, messages: list[Staged | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        if os.path.isdir(self.folder):
            for name in os.listdir(self.folder):
                os.remove(f"{self.folder}/{name}")
            os.rmdir(self.folder)


class SqliteSink(DataSource):
    """Options: path of the database, table, keys (comma-separated), batch (a batch of one name is applied once)."""

    @classmethod
    def name(cls) -> str:
        return "shelfmark_sqlite_sink"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SqliteWriter(dict(self.options), schema)


def to_flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, instants and decimals as text: what every database can hold."""
    kinds = {c: t for c, t in df.dtypes}
    cast = lambda c, t: f"to_json(`{c}`) AS `{c}`" if t.startswith(("array", "map", "struct")) else f"cast(`{c}` AS string) AS `{c}`" if t.startswith(("timestamp", "decimal", "date")) else f"`{c}`"
    return df.selectExpr(*[cast(c, t) for c, t in kinds.items()])


def to_sqlite(df: DataFrame, path: str, table: str, keys: list[str], batch: str = "") -> None:
    df.sparkSession.dataSource.register(SqliteSink)
    to_flat(df).write.format(SqliteSink.name()).option("path", path).option("table", table).option("keys", ",".join(keys)).option("batch", batch).mode("append").save()


def to_jdbc(df: DataFrame, url: str, table: str, keys: list[str], properties: dict[str, str] | None = None) -> None:
    """Rows of df replace those with equal keys in an existing table, in one transaction. Column names are taken as they are."""
    spark, stage = df.sparkSession, f"stage_{uuid.uuid4().hex[:12]}"
    given = {k: v for k, v in (properties or {}).items()}
    df.write.format("jdbc").options(url=url, dbtable=stage, **given).mode("error").save()
    jvm = spark._jvm
    if given.get("driver"):
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(given["driver"])
    info = jvm.java.util.Properties()
    for k, v in given.items():
        info.setProperty(k, v)
    db = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        db.setAutoCommit(False)
        q = db.getMetaData().getIdentifierQuoteString().strip()
        names = ", ".join(f"{q}{c}{q}" for c in df.columns)
        same = " AND ".join(f"{table}.{q}{k}{q} = {stage}.{q}{k}{q}" for k in keys)
        run = db.createStatement()
        try:
            if keys:
                run.executeUpdate(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} WHERE {same})")
            run.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}")
            db.commit()
        except Exception:
            db.rollback()
            raise
        finally:
            run.executeUpdate(f"DROP TABLE {stage}")
            db.commit()
    finally:
        db.close()


def mirror(store: Store, path: str, tables: list[str] | None = None) -> dict[str, int]:
    """The store's tables, as of one manifest, in a SQLite file: changed rows replace those with their keys. A version is applied once."""
    base, out = store.manifest(), {}
    for name, held in base["tables"].items():
        if tables is None or name in tables:
            df = store.table(name, base)
            to_sqlite(df, path, name, held["keys"], f"version-{base['version']}")
            out[name] = df.count()
    return out


