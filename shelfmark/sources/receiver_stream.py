"""Product records of a receiver's SQLite file as a stream: spark.readStream.format("shelfmark_receiver").

The offset is the pair (instant in milliseconds, product id) of the last row taken, the order of the cursor. A micro-batch
takes at most `limit` rows after it; its rows are the ids and instants of products, read by `parts` tasks, and the
records are put together from them (receiver.records with only=). Rows that arrive later with an instant before the offset
are not seen, as with the cursor. Artifacts without a readable instant are left out.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Rows after an offset, with the instant in milliseconds.
MOMENT = "CAST(round((julianday(a.ingested_at) - 2440587.5) * 86400000.0) AS INTEGER)"
ROWS = f"""SELECT at, id, artifact_id, parser FROM (SELECT {MOMENT} AS at, p.id AS id, p.artifact_id AS artifact_id, coalesce(nullif(lower(trim(a.parser_name)), ''), 'unknown') AS parser
FROM run_artifact_products p JOIN run_artifacts a ON p.artifact_id = a.id) WHERE at IS NOT NULL AND (at > :at OR at = :at AND id > :id) AND (:parser = '' OR parser = :parser)"""
SCHEMA = "product_id long, artifact_id long, parser_name string, at_ms long"
START = {"at": -(1 << 62), "id": -(1 << 62)}


class Share(InputPartition):
    def __init__(self, start: dict, end: dict, part: int, parts: int):
        self.start, self.end, self.part, self.parts = start, end, part, parts


class ReceiverStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.parser = options["path"], options.get("parser", "").strip().lower()
        self.limit, self.parts = max(1, int(options.get("limit", "2000"))), max(1, int(options.get("parts", "1")))
        #: The end of the last batch planned; a query that starts again has its last batch planned first.
        self.last: dict | None = None

    def _rows(self, start: dict, more: str, **values) -> Iterator[tuple]:
        with closing(sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)) as db:
            yield from db.execute(ROWS + more, {"at": start["at"], "id": start["id"], "parser": self.parser} | values)

    def initialOffset(self) -> dict:  # noqa: N802
        return dict(START)

    def latestOffset(self) -> dict:  # noqa: N802
        start = self.last or self.initialOffset()
        end = None
        for end in self._rows(start, " ORDER BY at, id LIMIT 1 OFFSET :skip", skip=self.limit - 1):
            break
        else:
            for end in self._rows(start, " ORDER BY at DESC, id DESC LIMIT 1"):
                break
        self.last = {"at": end[0], "id": end[1]} if end else start
        return dict(self.last)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.last = self.last or dict(end)
        return [] if start == end else [Share(start, end, k, self.parts) for k in range(self.parts)]

    def read(self, partition: Share) -> Iterator[tuple]:
        upto = " AND (at < :end_at OR at = :end_at AND id <= :end_id) AND id % :parts = :part"
        for at, id_, artifact, parser in self._rows(partition.start, upto, end_at=partition.end["at"], end_id=partition.end["id"], parts=partition.parts, part=partition.part):
            yield id_, artifact, parser, at


class ReceiverStream(DataSource):
    """Options: path, parser (all without it), limit (rows of a micro-batch), parts (tasks that read one)."""

    @classmethod
    def name(cls) -> str:
        return "shelfmark_receiver"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return ReceiverStreamReader(dict(self.options))


def arrivals(spark: SparkSession, path: str, parser: str = "", limit: int = 2000, parts: int = 1) -> DataFrame:
    """The stream of a receiver file's products in the order of the cursor."""
    spark.dataSource.register(ReceiverStream)
    return spark.readStream.format(ReceiverStream.name()).option("path", path).option("parser", parser or "").option("limit", limit).option("parts", parts).load()
