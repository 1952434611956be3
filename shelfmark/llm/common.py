"""What the text operators share: tables in the shared folder, checked broadcasts, input columns."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Arrow batches: rows and bytes at most, where the session has no settings of its own.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
#: White space that parts words: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A session in one process may go without; it gets a folder of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    where = getattr(spark, "_shelfmark_shared", None)
    if where is None:
        own = tempfile.mkdtemp(prefix="shelfmark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        where = spark._shelfmark_shared = f"file://{own}"
    return where


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends there and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._shelfmark_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table made by stored() that nothing reads any more."""
    path = getattr(df, "_shelfmark_path", None)
    if path:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most max_rows rows (counted, not estimated); otherwise as it is, and joins shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches, as a worker holds one batch of whole texts at a time. A caller's own settings stay."""
    for name, most in BATCH.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, most)


def free(df: DataFrame, name: str) -> str:
    """name, with as many underscores behind it as it takes to differ from df's columns."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def mapped(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """df.mapInPandas in batches of bounded size. Only for columns without nulls: pandas reads whole numbers beside nulls as floats."""
    batches(df.sparkSession)
    return df.mapInPandas(run, schema)


def added(df: DataFrame, given: list[str], new: str, work: Callable[..., Iterable], done: Callable[[], None] | None = None) -> DataFrame:
    """df without the columns `given`, plus the columns of the DDL `new`, which work() makes of the lists of given values of a batch. done() ends each task.

    The other columns go through as the Arrow arrays they came as, found by place, so ids of any size stay exact beside
    nulls and any names are allowed.
    """
    batches(df.sparkSession)
    kept = [c for c in df.columns if c not in given]
    made = StructType.fromDDL(new)
    schema, n = StructType([*(df.schema[c] for c in kept), *made]), len(kept)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.type for f in to_arrow_schema(made)]
        for part in parts:
            columns = work(*[part.column(n + k).to_pylist() for k in range(len(given))])
            arrays = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *arrays], names=schema.names)
        if done:
            done()

    return df.select(*kept, *given).mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(df: DataFrame, name: str = "text"):
    """The text column as string; null counts as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))
