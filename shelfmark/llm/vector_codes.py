"""Compression of vectors to codes: a codebook for each part of the vector, by Lloyd's rounds over heaps of bounds.

Components become floor(256 * x), vectors are cut into PARTS equal parts, and the codebook of each part starts as that
part of the vectors with the smallest ids. The first round compares every part with its whole codebook and files it, in
its block of rows, in the heap of its nearest entry. Its key is the distance to the second nearest entry less the one to
the nearest, i.e. how far entries may move before the order can change. When entries move, what a part of an entry can
lose grows by the entry's own step plus the largest step of any other; these drifts add up over the rounds. A later
round pops only the parts whose key the drift of their entry has reached, compares these exactly with the whole
codebook, and files them anew with a key that starts from the drift so far. All other parts keep their entry unseen.
Sums and counts of entries change by what moved.

A heap holds whole numbers: the key in steps of 2^-20, rounded down so that rounding can only cause a part to be looked
at, and the row of the block. Blocks are rows of a table in the shared folder: vectors, heaps, sums and the other columns
of their documents. A round is one pass over that table that writes the next one, so a lost executor costs the tasks it
ran. The driver gets sums of entries only. Squared distances are whole numbers and exact.

Rows whose vector is null or holds null or not finite components are dropped. Only vectors of one length are coded: that
of the smallest id whose vector can be cut into PARTS. The others stay with null code and error and count for nothing.
Fewer than ENTRIES vectors give fewer entries. Rows that repeat count each; of equal ids the smaller vector starts
first; rows without an id are coded but start nothing (if no row has an id, nothing can be coded). Components count as
at most 2^31 / (2 sqrt(length)) in size, so that errors fit a long. Extra columns stay, in front of the new ones, which replace columns of their
names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.llm.common import batches, bounded, discard, stored
from shelfmark.llm.vectors import EXACT, whole

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows and bytes of vectors in a block; a row's place takes ROW_BITS of a heap's numbers. Steps of a key.
ROWS, BYTES, ROW_BITS, STEPS = 32_768, 16 << 20, 16, 1 << 20
#: Vectors compared with a codebook at a time; labels whose sums are broadcast.
TOGETHER, LABELS = 4_096, 500_000
BLOCK = "rest binary, vectors binary, heaps binary, sizes binary, sums binary"
#: Key of a part without a second nearest entry.
NEVER = 1 << 46


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row (the first of equals) and the slack: the distance to the next one less that to it."""
    first, slack = np.empty(len(x), np.int64), np.full(len(x), float(NEVER))
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most * most < EXACT else np.int64
    e = entries.astype(kind)
    for at in range(0, len(x), TOGETHER):
        y = x[at : at + TOGETHER].astype(kind)
        d = (y * y).sum(axis=1)[:, None] - 2 * (y @ e.T) + (e * e).sum(axis=1)
        best = first[at : at + TOGETHER] = d.argmin(axis=1)
        rows = np.arange(len(y))
        near = np.sqrt(d[rows, best].astype(np.float64))
        if len(e) > 1:
            d[rows, best] = np.inf if kind is np.float64 else np.iinfo(np.int64).max
            slack[at : at + TOGETHER] = np.sqrt(d.min(axis=1).astype(np.float64)) - near
    return first, slack


def keys(slack: np.ndarray, drift: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Heap numbers: slack plus the drift so far, less what rounding may hide, above the row's place."""
    return np.floor(np.minimum(slack + drift - 1e-9 * (1 + np.abs(slack) + drift), NEVER - 1) * STEPS).clip(-(1 << 46), (1 << 46) - 1).astype(np.int64) << ROW_BITS | rows


class Block:
    """A block's vectors as (rows, parts, part length), a heap for each part and entry, and the entries' sums and counts."""

    def __init__(self, vectors: np.ndarray, entries: int):
        self.vectors = vectors
        self.heaps: list[list[int]] = [[] for _ in range(PARTS * entries)]
        self.sums = np.zeros((PARTS, entries, vectors.shape[2] + 1), np.int64)

    def file(self, part: int, rows: np.ndarray, entries: np.ndarray, numbers: np.ndarray) -> None:
        """Puts parts into heaps and adds them to the sums."""
        base = part * self.sums.shape[1]
        for e, number in zip(entries.tolist(), numbers.tolist(), strict=True):
            heappush(self.heaps[base + e], number)
        np.add.at(self.sums[part], entries, np.hstack([self.vectors[rows, part], np.ones((len(rows), 1), np.int64)]))

    def fill(self, books: np.ndarray) -> None:
        rows = np.arange(len(self.vectors))
        for part in range(PARTS):
            entries, slack = nearest(self.vectors[:, part], books[part])
            numbers = keys(slack, np.zeros(1), rows)
            order = np.argsort(numbers)  # numbers that rise go into a heap without moving others
            self.file(part, rows[order], entries[order], numbers[order])

    def adjust(self, books: np.ndarray, drifts: np.ndarray) -> int:
        """Pops the parts whose order the drifts may have changed and files them anew. Returns their number."""
        seen = 0
        for part in range(PARTS):
            rows, was = [], []
            for e, drift in enumerate(drifts[part].tolist()):
                heap, bar = self.heaps[part * len(drifts[part]) + e], (int(drift * STEPS) + 1) << ROW_BITS
                while heap and heap[0] < bar:
                    rows.append(heappop(heap) & ((1 << ROW_BITS) - 1))
                    was.append(e)
            if rows:
                r, w = np.array(rows), np.array(was)
                np.subtract.at(self.sums[part], w, np.hstack([self.vectors[r, part], np.ones((len(r), 1), np.int64)]))
                entries, slack = nearest(self.vectors[r, part], books[part])
                self.file(part, r, entries, keys(slack, drifts[part][entries], r))
                seen += len(r)
        return seen

    def codes(self) -> np.ndarray:
        """The entry of each part of each row."""
        out, entries = np.empty((len(self.vectors), PARTS), np.int64), self.sums.shape[1]
        for k, heap in enumerate(self.heaps):
            out[np.array(heap, np.int64) & ((1 << ROW_BITS) - 1), k // entries] = k % entries
        return out

    def packed(self) -> tuple[bytes, bytes, bytes, bytes]:
        sizes = np.fromiter(map(len, self.heaps), np.int32, len(self.heaps))
        flat = np.fromiter((x for h in self.heaps for x in h), np.int64, int(sizes.sum()))
        return self.vectors.astype(np.int32).tobytes(), flat.tobytes(), sizes.tobytes(), self.sums.tobytes()

    @classmethod
    def unpacked(cls, vectors: bytes, heaps: bytes, sizes: bytes, sums: bytes, entries: int, length: int) -> Block:
        out = cls(np.frombuffer(vectors, np.int32).astype(np.int64).reshape(-1, PARTS, length), entries)
        ends, flat = np.cumsum(np.frombuffer(sizes, np.int32)).tolist(), np.frombuffer(heaps, np.int64).tolist()
        out.heaps = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        out.sums = np.frombuffer(sums, np.int64).reshape(PARTS, entries, length + 1).copy()
        return out


def ipc(batch: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_table(batch)
    return sink.getvalue().to_pybytes()


def row(rest: bytes, block: Block) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (rest, *block.packed())], names=["rest", "vectors", "heaps", "sizes", "sums"])


def cut(df: DataFrame, kept: list[str], books: np.ndarray, most: int) -> DataFrame:
    """df, with its vector last, as blocks that are filed by the starting codebooks. Vectors that can't be cut make blocks without vectors."""
    length = books.shape[2]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rests, held, n = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal n
            if n:
                block = Block(np.concatenate(held).reshape(n, PARTS, length), books.shape[1])
                block.fill(books)
                yield row(ipc(pa.Table.from_batches(rests)), block)
            rests.clear()
            held.clear()
            n = 0

        for part in parts:
            others = pa.RecordBatch.from_arrays(part.columns[:-1], names=kept)
            for size, (rows, vectors) in whole(part.column(part.num_columns - 1), SCALE, most).items():
                if size != PARTS * length:
                    yield row(ipc(pa.Table.from_batches([others.take(pa.array(rows))])), Block(np.empty((0, PARTS, length), np.int64), books.shape[1]))
                    continue
                at = 0
                while at < len(rows):
                    room = max(1, min(ROWS, BYTES // (4 * size)) - n)
                    some = rows[at : at + room]
                    rests.append(others.take(pa.array(some)))
                    held.append(vectors[at : at + room])
                    n, at = n + len(some), at + room
                    if n >= min(ROWS, BYTES // (4 * size)):
                        yield from flush()
        yield from flush()

    return df.mapInArrow(run, BLOCK)


def adjusted(blocks: DataFrame, books: np.ndarray, drifts: np.ndarray) -> DataFrame:
    """The blocks after a round with moved codebooks."""
    entries, length = books.shape[1:]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rest, *packed in zip(*[c.to_pylist() for c in part.columns], strict=True):
                block = Block.unpacked(*packed, entries, length)
                block.adjust(books, drifts)
                yield row(rest, block)

    return blocks.mapInArrow(run, BLOCK)


def moved(blocks: DataFrame, books: np.ndarray, drifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks that are the means of their parts, and the drifts with these steps."""
    shape = (PARTS, books.shape[1], books.shape[2] + 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for part in parts:
            for x in part.column(0).to_pylist():
                total += np.frombuffer(x, np.int64).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "total"])

    found = blocks.select("sums").mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(shape, np.int64)
    total.ravel()[found["place"].to_numpy()] = found["total"].to_numpy()
    sums, counts = total[:, :, :-1], total[:, :, -1:]
    new = np.where(counts > 0, sums // np.maximum(counts, 1), books)
    step = np.sqrt(((new - books).astype(np.float64) ** 2).sum(axis=2))
    order = np.sort(step, axis=1)
    second = order[:, -2:-1] if step.shape[1] > 1 else np.zeros((PARTS, 1))
    # the largest step of any other entry: the second largest for the entry with the largest
    other = np.where(np.arange(step.shape[1]) == step.argmax(axis=1)[:, None], second, order[:, -1:])
    return new, drifts + (step + other) * (1 + 1e-9)


def coded(blocks: DataFrame, books: np.ndarray, drifts: np.ndarray, schema: StructType) -> DataFrame:
    """The last assignment: the rows' other columns, code and error."""
    entries, length = books.shape[1:]
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rest, *packed in zip(*[c.to_pylist() for c in part.columns], strict=True):
                block, others = Block.unpacked(*packed, entries, length), pa.ipc.open_stream(rest).read_all().combine_chunks()
                if len(block.vectors):
                    block.adjust(books, drifts)
                    codes = block.codes()
                    error = ((block.vectors - books[np.arange(PARTS), codes]) ** 2).sum(axis=(1, 2))
                    text = codes.astype(np.uint8).tobytes().hex()
                    new = [pa.array([text[k : k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]), pa.array(error)]
                else:
                    new = [pa.nulls(len(others), pa.string()), pa.nulls(len(others), pa.int64())]
                yield from pa.Table.from_arrays([*others.columns, *new], schema=arrow).to_batches(max_chunksize=ROWS)

    return blocks.mapInArrow(run, schema)


def starts(vectors: DataFrame) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids, as codebooks; None if there is none that can be cut. vectors: id, vector."""
    sound = vectors.where("id IS NOT NULL AND forall(vector, x -> coalesce(NOT isnan(x) AND abs(x) < double('Infinity'), false))")
    sound = sound.where(f"size(vector) > 0 AND size(vector) % {PARTS} = 0").orderBy("id", "vector")
    rows = sound.limit(ENTRIES).toArrow().column("vector")
    if not len(rows):
        return None
    length = len(rows[0])
    if any(len(v) != length for v in rows):
        rows = sound.where(F.size("vector") == length).limit(ENTRIES).toArrow().column("vector")
    order = whole(rows, SCALE)
    least = np.clip(order[length][1], -limit(length), limit(length))
    return np.ascontiguousarray(least.reshape(-1, PARTS, length // PARTS).transpose(1, 0, 2))


def limit(length: int) -> int:
    return int((1 << 30) / length**0.5)


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """df without its vectors, plus code, error, label_error (summed over equal labels) and codebooks_sha256."""
    spark = df.sparkSession
    batches(spark)
    new = ["code", "error", "label_error", "codebooks_sha256"]
    kept = [c for c in df.columns if c not in (vector, *new)]
    books = starts(df.select(df[vec_id].alias("id"), df[vector].alias("vector")))
    # columns go by place: any names are allowed, and so are several of one name
    inner = [f"c{k}" for k in range(len(kept))]
    rows = df.select(*[df[c].alias(n) for c, n in zip(kept, inner, strict=True)], df[vector].alias("vector"))
    if books is None:
        sound = rows.where("vector IS NOT NULL AND forall(vector, x -> coalesce(NOT isnan(x) AND abs(x) < double('Infinity'), false))")
        codes, digest = sound.drop("vector").selectExpr("*", "cast(null AS string) AS code", "cast(null AS long) AS error"), hashlib.sha256(b"").hexdigest()
    else:
        drifts = np.zeros(books.shape[:2])
        blocks = stored(cut(rows, inner, books, limit(PARTS * books.shape[2])), "filed")
        for k in range(rounds):
            if k:
                before, blocks = blocks, stored(adjusted(blocks, books, drifts), "filed")
                discard(before)
            books, drifts = moved(blocks, books, drifts)
        schema = StructType([*(rows.schema[n] for n in inner), *StructType.fromDDL("code string, error long")])
        codes = stored(coded(blocks, books, drifts, schema), "codes")
        discard(blocks)
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    group = inner[kept.index(label)]
    # totals of labels; a null counts as a label
    totals = codes.groupBy(F.col(group).alias("of")).agg(F.sum("error").alias("label_error"))
    out = codes.join(bounded(totals, LABELS), F.col(group).eqNullSafe(F.col("of")), "left").drop("of").withColumn("codebooks_sha256", F.lit(digest))
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, kept, strict=True)], *new)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every vector."""
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def codes_sql() -> str:
    """The same in SQL: every round compares all parts with all entries."""
    dist = "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = "SELECT x.r, x.p, x.v, b.e, {d} AS d FROM x JOIN {b} b ON x.p = b.p QUALIFY row_number() OVER (PARTITION BY x.r, x.p ORDER BY {d}, b.e) = 1"
    text = f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, p, n[p * (len(n) // {PARTS}) + 1 : (p + 1) * (len(n) // {PARTS})] AS v FROM k, range({PARTS}) t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM x WHERE r <= {ENTRIES}),"""
    for k in range(ROUNDS):
        text += f"""
n{k} AS MATERIALIZED ({near.format(d=dist, b=f"b{k}")}),
m{k} AS (SELECT p, e, list(m ORDER BY c) AS v FROM (SELECT p, e, c, CAST(floor(sum(v[c]) / count(*)) AS BIGINT) AS m FROM n{k}, range(1, (SELECT len(v) + 1 FROM b0 LIMIT 1)) t(c) GROUP BY p, e, c) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e),"""
    return (
        text
        + f"""
f AS ({near.format(d=dist, b=f"b{ROUNDS}")}),
g AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT k.vec_id, g.code, g.error, CAST(sum(g.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256 FROM k JOIN g ON k.r = g.r, h
"""
    )
