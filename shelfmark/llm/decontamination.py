"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Texts become tokens: runs of letters, marks and digits in lower case, so punctuation and case don't hide a copy. Every
position of every text is hashed under fixed masks; a 0 in a mask ignores that token. Where a document's hash equals one
of a benchmark item, the two are laid upon each other there and compared within WINDOW tokens around the hit:

* an item of WINDOW tokens or more leaks if some window of WINDOW tokens differs in at most SUBSTITUTIONS places;
* an item of MIN_TOKENS to WINDOW - 1 tokens leaks if all of it occurs with at most one token changed;
* a shorter item says too little for a hit inside a sentence: it leaks if a line of the document has just its tokens.

MASKS hit every window of the first kind, SHORT_MASKS every item of the second, wherever the substitutions stand
(tests/llm checks all placements); SHORT_MASKS are only applied if there are such items.

A benchmark hash carries the item's tokens around it, 25 at most. Up to MAX_HASHES of them, counted beforehand, are
broadcast, so the documents' hashes never leave the task that reads the text. Of a larger benchmark only the hashes are
broadcast, MAX_KEYS at a time, and what meets them is joined by a shuffle. Null and empty texts have no tokens and match
nothing, on either side. Repeated rows each match. A null doc_id or item_id is carried as it is. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import bounded, documents, stored

MASKS = ("10101111", "111100101")
SHORT_MASKS = ("10101111", "11110101", "11011011", "111111")
WINDOW, SUBSTITUTIONS, MIN_TOKENS = 13, 2, 8
#: Benchmark hashes in one broadcast, with their 25 tokens (about 300 bytes each); bare hashes in one (about 24 bytes each).
MAX_HASHES, MAX_KEYS = 200_000, 3_000_000
#: Contaminated documents up to which their keys are broadcast; beyond, a shuffle join removes them.
MAX_BROADCAST_DOCS = 1_000_000


def tokens(text: str) -> Column:
    """Hashes of the tokens of a text column; null counts as empty."""
    words = F.array_remove(F.split(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "), " "), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def by_mask(values: list[int]) -> str:
    """SQL for the value of the mask in column `mask`."""
    return "".join(f"if(mask = {m}, {v}, " for m, v in enumerate(values[:-1])) + str(values[-1]) + ")" * (len(values) - 1)


def seeds(df: DataFrame, at: str, masks: tuple[str, ...]) -> DataFrame:
    """df (with a token array `h`) at every position and mask: adds `at`, mask and key.

    The expressions are kept small: the explosion, the hash and the join that follows are one generated method, which
    the JVM only compiles up to 8,000 bytes.
    """
    n, spans, weight = len(masks), [len(m) for m in masks], masks[0].count("1")
    ones = [[k for k, c in enumerate(m) if c == "1"] for m in masks]
    x = df.withColumn("_x", F.expr(f"explode(CASE WHEN size(h) >= {MIN_TOKENS} THEN sequence(0, {n} * size(h) - 1) END)"))
    x = x.withColumns({at: F.expr(f"cast(_x DIV {n} AS int)"), "mask": F.expr(f"_x % {n}")}).drop("_x")
    x = x.where(f"{at} + {by_mask(spans)} <= size(h)")
    return x.withColumn("key", F.expr(f"xxhash64(mask, {', '.join(f'get(h, {at} + {by_mask([o[k] for o in ones])})' for k in range(weight))})"))


def around(tokens_: str, at: str) -> str:
    """SQL: the tokens from WINDOW - 1 before a position to WINDOW - 1 after it."""
    return f"slice({tokens_}, greatest({at} - {WINDOW - 1}, 0) + 1, least({at}, {WINDOW - 1}) + {WINDOW})"


def marked(items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The benchmark's hashes: key, imask, item_id, the tokens around (near) with the place of the hit in them (iat), the window's
    size, the tokens that must agree (need), and the first and last start of a window relative to the hit. Places of an item with
    equal tokens around count once."""
    x = seeds(items, "ipos", masks).withColumn("window", F.expr(f"least(size(h), {WINDOW})"))
    need = f"window - CASE WHEN window = {WINDOW} THEN {SUBSTITUTIONS} ELSE 1 END"
    return x.select("key", F.col("mask").alias("imask"), "item_id", F.expr(around("h", "ipos")).alias("near"), F.expr(f"least(ipos, {WINDOW - 1})").alias("iat"), "window", F.expr(need).alias("need"), F.expr(f"greatest(-ipos, {by_mask([len(m) for m in masks])} - window)").alias("lo"), F.expr("least(size(h) - window - ipos, 0)").alias("hi")).distinct()


#: Tokens that agree in the best window around a hit. Columns part, at (the document's), near, iat, window, lo, hi.
BEST = "CASE WHEN lo <= hi THEN array_max(transform(sequence(lo, greatest(lo, hi)), s -> aggregate(sequence(s, s + window - 1), 0, (a, k) -> a + CASE WHEN iat + k >= 0 AND at + k >= 0 AND get(near, iat + k) = get(part, at + k) THEN 1 ELSE 0 END))) ELSE 0 END"


def seeded(docs: DataFrame, items: DataFrame, masks: tuple[str, ...], keys: list[str]) -> DataFrame:
    """keys, item_id, pos, n_equal of the verified hits under some masks. docs: keys, h; items: item_id, h."""
    marks = stored(marked(items, masks), "benchmark-hashes")
    grams, total = seeds(docs, "pos", masks), marks.count()
    if total > MAX_HASHES:
        bare = stored(marks.select(F.col("key").alias("bare")).distinct(), "benchmark-keys")
        blocks = -(-total // MAX_KEYS)
        block = lambda b: F.broadcast(bare.where(F.expr(f"pmod(xxhash64(bare), {blocks}) = {b}")) if blocks > 1 else bare)
        cut = grams.select(*keys, "pos", "mask", "key", F.expr(around("h", "pos")).alias("part"))
        met = reduce(DataFrame.unionAll, [cut.join(block(b), F.col("key") == F.col("bare"), "left_semi") for b in range(blocks)]).join(marks, ["key"])
    else:
        met = grams.join(F.broadcast(marks), ["key"]).withColumn("part", F.expr(around("h", "pos")))
    # the id keeps Catalyst from moving the filter into the join, where it would part the explosion from it and copy whole token arrays
    met = met.select(*keys, "item_id", "pos", "mask", "imask", "near", "iat", "window", "need", "lo", "hi", "part", F.expr(f"least(pos, {WINDOW - 1})").alias("at"), F.monotonically_increasing_id().alias("_hit"))
    met = met.where("_hit >= 0 AND mask = imask").withColumn("n_equal", F.expr(BEST))
    return met.where("n_equal >= need").select(*keys, "item_id", "pos", "n_equal")


def whole_lines(docs: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """keys, item_id, pos (null), n_equal where a line has just the tokens of an item. docs: keys, text; items: item_id, h."""
    lines = docs.select(*keys, F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line")).select(*keys, tokens("line").alias("l"))
    lines = lines.where(f"size(l) BETWEEN 1 AND {MIN_TOKENS - 1}").withColumn("key", F.xxhash64("l"))
    some = bounded(stored(items.select("item_id", "h", F.xxhash64("h").alias("key")), "benchmark-lines"), MAX_HASHES)
    return lines.join(some, ["key"]).where("l = h").select(*keys, "item_id", F.lit(None).cast("int").alias("pos"), F.size("h").alias("n_equal"))


def leaks(docs: DataFrame, benchmark: DataFrame, keys: list[str]) -> DataFrame:
    """keys, item_id, n_seeds (verified hits), first_token (null if only a line matched) and n_equal (tokens that agree in the best window) per leaking pair."""
    items = stored(benchmark.select("item_id", tokens("text").alias("h")).where("size(h) > 0"), "benchmark-tokens")
    sizes = items.agg(F.expr(f"count_if(size(h) < {MIN_TOKENS})"), F.expr(f"count_if(size(h) >= {MIN_TOKENS} AND size(h) < {WINDOW})")).first()
    texts = docs.select(*keys, tokens("text").alias("h"))
    found = [seeded(texts, items.where(f"size(h) >= {WINDOW}"), MASKS, keys)]
    if sizes[1]:
        found.append(seeded(texts, items.where(f"size(h) >= {MIN_TOKENS} AND size(h) < {WINDOW}"), SHORT_MASKS, keys))
    if sizes[0]:
        found.append(whole_lines(docs, items.where(f"size(h) < {MIN_TOKENS}"), keys))
    hits = reduce(DataFrame.unionAll, found)
    return hits.groupBy(*keys, "item_id").agg(F.count(F.lit(1)).alias("n_seeds"), F.min("pos").cast("long").alias("first_token"), F.max("n_equal").cast("long").alias("n_equal"))


def text_mark():
    """What tells texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that share a passage with the benchmark."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_mark().alias("same"))
    found = leaks(docs.select(F.col("doc_id").alias("id"), text_mark().alias("same"), "text"), benchmark, ["id", "same"])
    gone = stored(found.select(F.col("id").alias("gone"), F.col("same").alias("gone_same")).distinct(), "contaminated")
    return rows.join(bounded(gone, MAX_BROADCAST_DOCS), rows["id"].eqNullSafe(gone["gone"]) & (rows["same"] == gone["gone_same"]), "left_anti").select("row.*")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that share a passage; texts of one id count apart."""
    docs = documents(spark, sf_dir).select("doc_id", text_mark().alias("same"), "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id", "same"]).drop("same")
