"""Near-duplicate documents: MinHash signatures, banding, verification and connected components.

Rows with the same shingle set form a class at once; its head is the least of them by (doc_id, hash of the text), rows
without doc_id last. Classes that agree in one of BANDS bands of ROWS hash minima share a bucket. At J = 0.8 a pair
shares none with probability (1 - 0.8 ** 4) ** 32, below 5e-8. Within a bucket not all pairs are made: first every class
is held against the bucket's centre, the class with the most company over all its buckets. Links confirmed on the full
sets give components. The classes of buckets that still hold several components are joined by their rarest shingles: a
partner must share PERCENT of a class's shingles, so the rarest of both, as many as may differ and one more, have one in
common. Where more than HOT classes share such a shingle, they are first held against the one with the most company
again, so a family of copies of a copy isn't paired with itself. Signatures drop pairs whose agreement is far below 0.8
before sets are read.

Null or empty text, and text without words: an empty set, linked with nothing. Rows are told apart by doc_id and text, so
rows that repeat a doc_id with other text are other documents. component_id is the smallest doc_id of the component, null
if none of its rows has one. A row without doc_id counts as kept only then. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import added, bounded, discard, documents, mapped, stored
from shelfmark.llm.components import components
from shelfmark.llm.shingles import mixed, shingle_set

BANDS, ROWS = 32, 4
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Signature rows that must agree before sets are compared. At J = 0.8 fewer of the 128 agree with probability below 2e-6.
MIN_AGREE = 80
#: Classes that may share a rare shingle before they are held against one of them.
HOT = 32
#: Documents up to which their keys are broadcast to find their texts (24 bytes each); beyond, a shuffle join does it.
MAX_BROADCAST_IDS = 1_000_000
#: Shingles hashed at once, to bound memory for very long texts.
CHUNK = 1024

_RNG = np.random.Generator(np.random.PCG64(20240501))
_MULTIPLY = _RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of BANDS * ROWS multiply-add hashes modulo 2 ** 32 of the shingles' upper halves."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    work = np.empty((min(CHUNK, len(x)), BANDS * ROWS), np.uint32)
    for at in range(0, len(x), CHUNK):
        h = np.multiply(x[at : at + CHUNK, None], _MULTIPLY, out=work[: min(CHUNK, len(x) - at)])
        h += _ADD
        np.minimum(least, h.min(axis=0), out=least)
    return least


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, digest of the shingle set (null if it is empty), sig."""

    def run(texts: list[str | None]) -> list[list]:
        sets = (shingle_set(t, size) for t in texts)
        rows = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s).tobytes()) if len(s) else (0, None, None) for s in sets]
        return [list(x) for x in zip(*rows, strict=True)] if rows else [[], [], []]

    return added(docs.select("doc_id", text_hash(docs).alias("mark"), docs["text"].cast("string").alias("_text")), ["_text"], "n_shingles long, digest binary, sig binary", run)


def bucketed(reps: DataFrame) -> DataFrame:
    """bucket, rep: a row for each band of each class."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                sig = np.frombuffer(b"".join(f["sig"]), np.uint32).reshape(len(f), BANDS, ROWS).astype(np.uint64)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(f), BANDS)).copy()
                for k in range(ROWS):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                yield pd.DataFrame({"bucket": key.ravel().view(np.int64), "rep": np.repeat(f["rep"].to_numpy(np.int64), BANDS)})

    return mapped(reps.select("rep", "sig"), run, "bucket long, rep long")


def agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of pairs (u, v) whose signatures agree in MIN_AGREE rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                a, b = (np.frombuffer(b"".join(f[c]), np.uint32).reshape(len(f), -1) for c in ("a", "b"))
                yield f.loc[(a == b).sum(axis=1) >= MIN_AGREE, ["u", "v"]]

    a, b = (reps.select(F.col("rep").alias(f"r{c}"), F.col("sig").alias(c)) for c in "ab")
    joined = pairs.join(a, pairs["u"] == a["ra"]).select("u", "v", "a").join(b, F.col("v") == b["rb"]).select("u", "v", "a", "b")
    return mapped(joined, run, "u long, v long")


def shingle_sets(docs: DataFrame, heads: DataFrame, some: DataFrame, size: int, repeated: bool) -> DataFrame:
    """id and shingle set (bytes of sorted 64-bit hashes) of the classes in some (column i, distinct), read at their heads (rep, doc_id,
    mark), stored. repeated: whether rows occur that are alike in doc_id and text."""
    at = heads.join(some, heads["rep"] == some["i"]).select(F.col("rep").alias("id"), F.col("doc_id").alias("_d"), F.col("mark").alias("_m"))
    here = docs.select("doc_id", text_hash(docs).alias("mark"), docs["text"].cast("string").alias("_text"))
    at = bounded(at, MAX_BROADCAST_IDS)
    met = here.join(at, here["doc_id"].eqNullSafe(at["_d"]) & (here["mark"] == at["_m"])).select("id", "_text")
    if repeated:
        met = met.groupBy("id").agg(F.first("_text").alias("_text"))
    return stored(added(met, ["_text"], "s binary", lambda texts: [[shingle_set(t, size).tobytes() for t in texts]]), "shingle-sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the stored pairs (u, v) that satisfy the threshold on their full shingle sets, stored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for x, y in zip(f["a"], f["b"], strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True)) if 100 * min(len(a), len(b)) >= PERCENT * max(len(a), len(b)) else 0
                keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
            yield f.loc[keep, ["u", "v"]] if len(f) else f[["u", "v"]]

    a, b = (sets.select(F.col("id").alias(f"i{c}"), F.col("s").alias(c)) for c in "ab")
    joined = pairs.join(a, pairs["u"] == a["ia"]).select("u", "v", "a").join(b, F.col("v") == b["ib"]).select("u", "v", "a", "b")
    return stored(mapped(joined, run, "u long, v long").distinct(), "confirmed")


def pair(leader: str, other: str) -> list:
    return [F.greatest(leader, other).alias("u"), F.least(leader, other).alias("v")]


def with_components(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows (rep and others) with comp, the component of rep."""
    of = edges.select(F.col("u").alias("_node"), F.col("v").alias("_comp"))
    return rows.join(of, rows["rep"] == of["_node"], "left").select(*rows.columns, F.coalesce("_comp", "rep").alias("comp"))


def several(rows: DataFrame, key: str) -> DataFrame:
    """rows (key, comp and others) of the keys that hold more than one component."""
    mixed_ = rows.groupBy(F.col(key).alias("_k")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("_k")
    return rows.join(mixed_, rows[key] == mixed_["_k"], "left_semi")


def centres(rows: DataFrame, key: str, company: DataFrame) -> DataFrame:
    """_c and leader: per key the class with the most company."""
    scored = rows.select(key, "rep").join(company, rows["rep"] == company["r"])
    return scored.groupBy(F.col(key).alias("_c")).agg(F.expr("max_by(rep, struct(score, -rep))").alias("leader"))


def rare(sets: DataFrame) -> DataFrame:
    """s, rep, n (shingles) and at (from 1, its place by rarity) for the rarest shingles of each class, as many as a partner may lack
    and one more. Those that no other class has stand first and join nothing, so they are only counted."""

    def run(rows: list[bytes]) -> list[list]:
        return [[np.frombuffer(s, np.int64) for s in rows]]

    each = added(sets.select("id", "s"), ["s"], "x array<bigint>", run).select("id", F.size("x").alias("n"), F.explode("x").alias("s"))
    often = each.groupBy(F.col("s").alias("o")).agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    met = each.join(often, each["s"] == often["o"]).groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "s"))).alias("x"))
    met = met.withColumn("own", F.expr("n - size(x)")).withColumn("most", F.expr(f"n - cast(ceil({PERCENT} * n / 100) AS int) + 1 - own")).where("most > 0")
    return met.select(F.col("id").alias("rep"), "n", "own", F.posexplode(F.expr("transform(slice(x, 1, most), y -> y.s)")).alias("at", "s")).select("s", "rep", "n", F.expr("own + at + 1").alias("at"))


def linked(reps: DataFrame, heads: DataFrame, docs: DataFrame, size: int, repeated: bool) -> DataFrame:
    """Component edges (u, v) between classes; v is the smallest of the component. reps: rep, sig; heads: rep, doc_id, mark."""
    rows = bucketed(reps)
    shared = rows.groupBy(F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = stored(rows.join(shared, rows["bucket"] == shared["b"]).select("bucket", "rep", "n"), "buckets")
    company = stored(rows.groupBy(F.col("rep").alias("r")).agg(F.sum("n").alias("score")), "company")
    centre = centres(rows, "bucket", company)
    tested = rows.join(centre, rows["bucket"] == centre["_c"]).where("rep <> leader").select(*pair("rep", "leader")).distinct()
    near = stored(agreeing(tested, reps), "near-pairs")
    ends = lambda pairs: pairs.select(F.col("u").alias("i")).union(pairs.select("v")).distinct()
    sets = shingle_sets(docs, heads, ends(near), size, repeated)
    links = confirmed(near, sets)
    edges = components(links)
    for done in (near, links, sets):
        discard(done)
    # what the centres left apart
    left = stored(several(with_components(rows.select("bucket", "rep"), edges), "bucket").select("rep").distinct(), "open-classes")
    discard(rows)
    if left.limit(1).count():
        sets = shingle_sets(docs, heads, left.select(F.col("rep").alias("i")), size, repeated)
        shingles = stored(rare(sets), "rare-shingles")
        busy = stored(shingles.groupBy(F.col("s").alias("b")).agg(F.count(F.lit(1)).alias("n")).where(f"n > {HOT}").select("b"), "hot-shingles")
        if busy.limit(1).count():
            hot = several(with_components(shingles.join(bounded(busy, MAX_BROADCAST_IDS), shingles["s"] == F.col("b"), "left_semi").select("s", "rep"), edges), "s")
            middle = centres(hot, "s", company)
            near = stored(agreeing(hot.join(middle, hot["s"] == middle["_c"]).where("rep <> leader").select(*pair("rep", "leader")).distinct(), reps), "near-pairs")
            edges = joined(edges, near, sets)
        x, y = (several(with_components(shingles, edges), "s").select([F.col(c).alias(f"{c}{k}") for c in ("s", "rep", "comp", "n", "at")]) for k in "12")
        # the shingles from a common one on, in the order of rarity, bound what a pair can share
        fits = f"rep1 < rep2 AND comp1 <> comp2 AND {100 + PERCENT} * (least(n1 - at1, n2 - at2) + 1) >= {PERCENT} * (n1 + n2)"
        near = stored(agreeing(x.join(y, F.col("s1") == F.col("s2")).where(fits).select(*pair("rep1", "rep2")).distinct(), reps), "near-pairs")
        edges = joined(edges, near, sets)
        for done in (shingles, busy, sets):
            discard(done)
    for done in (left, company):
        discard(done)
    return edges


def joined(edges: DataFrame, near: DataFrame, sets: DataFrame) -> DataFrame:
    """edges after the links among the stored pairs near, which go."""
    links = confirmed(near, sets)
    out = components(links.union(edges).distinct()) if links.limit(1).count() else edges
    for done in (near, links, *([edges] if out is not edges else [])):
        discard(done)
    return out


def grouped(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, mark, n_shingles and head (doc_id and mark of the component's first row; null for an empty set) of every row, stored."""
    sig = stored(signed(docs, size), "signatures")
    real = sig.where("digest IS NOT NULL")
    repeated = bool(real.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count())
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("head")
    classes = real.groupBy("digest").agg(head, F.first("sig").alias("sig"))
    # numbers are fixed when the table is written
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    heads = classes.select("rep", "head.doc_id", "head.mark")
    edges = linked(classes.select("rep", "sig"), heads, docs, size, repeated)
    top = with_components(classes.select("digest", "head", "rep"), edges)
    least = top.groupBy(F.col("comp").alias("_of")).agg(F.min("head").alias("first"))
    top = top.join(least, top["comp"] == least["_of"]).select(F.col("digest").alias("_digest"), "first")
    out = sig.join(top, sig["digest"] == top["_digest"], "left").select("doc_id", "mark", "n_shingles", F.col("first").alias("head"))
    out = stored(out, "groups")
    for done in (sig, classes, edges):
        discard(done)
    return out


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs; size: words of a shingle."""
    of = F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id"))
    return grouped(docs, size).select("doc_id", "n_shingles", of.alias("component_id"), F.coalesce(F.col("doc_id") == of, of.isNull()).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each group of near copies: the least by doc_id and hash of the text, rows without doc_id last; of rows alike in
    both, any one. Rows with an empty set stay."""
    groups = grouped(docs, size).where("head IS NOT NULL")
    own = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("mark") == F.col("head.mark"))
    key = [F.col("doc_id").alias("_gd"), F.col("mark").alias("_gm")]
    gone = stored(groups.where(~own).select(*key).distinct(), "near-copies")
    twice = stored(groups.where(own).groupBy(*key).count().where("count > 1").drop("count"), "repeated-rows")
    discard(groups)
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_d"), text_hash(docs).alias("_m"))
    on = lambda x: rows["_d"].eqNullSafe(x["_gd"]) & (rows["_m"] == x["_gm"])
    rest = rows.join(bounded(gone, MAX_BROADCAST_IDS), on(gone), "left_anti")
    if twice.limit(1).count():
        some = bounded(twice, MAX_BROADCAST_IDS)
        once = rest.join(some, on(twice), "left_semi").groupBy("_d", "_m").agg(F.first("_row").alias("_row"))
        rest = rest.join(some, on(twice), "left_anti").select("_row").union(once.select("_row"))
    return rest.select([F.col(f"_row.`{c}`") for c in docs.columns])


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document, on two-word shingles."""
    return near_duplicates(documents(spark, sf_dir), 2)
