"""Keyed state in Spark's state store: run-length snapshots of sources, without stored tables.

A source's open run (fingerprint, first and latest instant, rows, number) is value state under the source's key, checkpointed
with the query by RocksDB, so a micro-batch touches the state of its own keys and nothing is scanned. Rows of one
micro-batch are taken in their order; a row that arrives in a later micro-batch than its place goes by its arrival. A
task holds one source's rows of one micro-batch, which the source's admission limit bounds. Null keys make a source of
their own; a null fingerprint is a value like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType
from pyspark.sql.window import Window as W

#: What keyed state with several variables needs of the session.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
RUN = "fp string, valid_from timestamp, valid_to timestamp, n_rows long, snapshot_no long"


class Runs(StatefulProcessor):
    """Rows of a key (in columns fp, at and the order) to its runs that are new or went on, each as it is after the micro-batch."""

    def __init__(self, keys: list[str], order: list[str]):
        self.keys, self.order = keys, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("run", RUN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        given = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        run = list(self.open.get()) if self.open.exists() else None
        out: dict[int, list] = {}
        for fp, at in zip(given["fp"].tolist(), given["at"].tolist(), strict=True):
            fp = fp if isinstance(fp, str) else None
            if run is None or run[0] != fp:
                run = [fp, at, at, 0, run[4] + 1 if run else 1]
            run[2], run[3] = max(run[2], at), run[3] + 1
            out[run[4]] = list(run)
        if run:
            self.open.update(tuple(run))
            frame = pd.DataFrame(list(out.values()), columns=["fp", "valid_from", "valid_to", "n_rows", "snapshot_no"])
            for k, value in zip(self.keys, key, strict=True):
                frame[k] = pd.array([None if pd.isna(value) else str(value)] * len(frame), dtype=object)
            yield frame[[*self.keys, *frame.columns[:5]]]

    def close(self) -> None:
        pass


def runs(source: DataFrame, keys: list[str], order: list[str], fingerprint: str, at: str) -> DataFrame:
    """The stream of changed runs (keys as text, fp, valid_from, valid_to, n_rows, snapshot_no) of a stream of rows."""
    inner = [f"o{k}" for k in range(len(order))]
    rows = source.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(fingerprint).cast("string").alias("fp"), F.col(at).cast("timestamp").alias("at"), *[F.col(o).alias(n) for o, n in zip(order, inner, strict=True)])
    schema = StructType.fromDDL(", ".join(f"`{k}` string" for k in keys) + ", " + RUN)
    return rows.groupBy(*keys).transformWithStateInPandas(Runs(keys, inner), schema, "Update", "None")


def run_stream(source: DataFrame, where: str, keys: list[str], order: list[str], fingerprint: str, at: str) -> dict:
    """Takes in what the source has, with the state under where/state, and adds the changed runs to where/runs, each micro-batch once.
    Returns the state's size: its rows and bytes in memory."""
    spark = source.sparkSession
    if spark.conf.get(PROVIDER[0], "") != PROVIDER[1]:
        spark.conf.set(*PROVIDER)
    write = lambda df, k: df.write.mode("overwrite").parquet(f"{where}/runs/batch={k}")
    query = runs(source, keys, order, fingerprint, at).writeStream.outputMode("update").option("checkpointLocation", f"{where}/state").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [op for p in query.recentProgress for op in p["stateOperators"]]
    return {"rows": held[-1]["numRowsTotal"], "bytes": held[-1]["memoryUsedBytes"]} if held else {"rows": 0, "bytes": 0}


def current_runs(spark: SparkSession, where: str, keys: list[str]) -> DataFrame:
    """The runs as they are after the last micro-batch that changed them."""
    found = spark.read.parquet(f"{where}/runs")
    last = W.partitionBy(*keys, "snapshot_no").orderBy(F.col("batch").desc())
    return found.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "batch")
