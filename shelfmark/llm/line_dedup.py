"""Line deduplication within an edit distance, by a segment-partition join.

Lines (trimmed of ASCII white space) that have a letter, or MIN_CHARS or more characters, take part. Equal lines are one
class, known by a 128-bit hash; its first occurrence is the least (doc_id, text hash, line number). A line's occurrence
is dropped unless it is the first of its class and no line of another class that is similar has an earlier first
occurrence. That line may itself be dropped, so in a chain of similar lines only the first stays, though the last may be
farther from it than the threshold. Lines of MIN_CHARS or more are similar within EDITS edits: a changed date, comma or
letter case, but no changed word; shorter ones only if they are equal. Short lines without a letter, such as list marks
and rules, always stay. A min_chars that is given is the floor for both instead; with threshold None the edits grow with
the length, one for every EDIT_EACH characters of the shorter line, MAX_EDITS at most.

Similar classes are found as follows. Lengths are parted into bands of one threshold t each; a line also belongs to the
band below its own if it can be similar to a line there. In a band whose least length is lo, a line has t + 1 segments of
lo DIV (t + 1) characters, the first half counted from its start and the others from its end. Up to t edits leave one of
them whole that has exactly as many edits before it as segments, so that segment i is found in the other line shifted by
min(i, t - i) at most: about t * t / 2 keys a line. Keys are hashes made where the line is read, so line texts aren't
shuffled; a line is its class's first 64 bits in them. A segment that more than HOT lines share isn't joined. Its lines
are compared with the earliest of them, which settles those that are similar to it. Then they are joined by grams: lines
within t edits differ in GRAM * t of their substrings of GRAM characters at most, so the GRAM * t + 1 rarest of a line
(its prefix) hold one that the other line's prefix has too, at most t characters away. Any order of all grams will do for
that, so rare is what a table of SKETCH counts says, in which grams of equal last bits share a count: tasks count their
own lines' grams, and each line is ranked where it is read. Lines that differ in whole words
have rare grams there, however many segments they share. A pair whose letter counts differ by more than t edits can
explain doesn't leave that join. Where more than HOT lines share a gram, the earliest settles those similar to it once more. Pairs of
which neither is open aren't made. The texts of candidates alone are read again, and each pair is verified with a banded
bit-parallel edit distance.

Null and empty texts have no such line and stay as they are. A null doc_id sorts first and its rows are treated alike.
Rows that repeat both doc_id and text keep the same lines; rows that repeat doc_id with other text are other documents
that come in the order of their text's hash. Extra columns pass through dedup_lines unchanged.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import added, bounded, discard, documents, mapped, stored

#: Edits within which lines are similar.
EDITS = 2
#: With no fixed threshold: an edit for every EDIT_EACH characters of the shorter line, MAX_EDITS at most.
EDIT_EACH, MAX_EDITS = 10, 6
#: The length from which lines that are similar count as copies; equal ones do from one letter on.
MIN_CHARS = 30
#: Bands are a third wider than their least length up to here; the last is open.
LAST_BAND = 4096
#: Lines that may share a segment before they are joined by grams, the length of these, and classes of characters that are counted.
HOT, GRAM, LETTERS = 32, 4, 32
#: Counts that order the grams (4 bytes each, sent to every task).
SKETCH = 1 << 18
#: Shared segments, and documents with candidate lines up to which they are broadcast (8 and 16 bytes each); beyond, a shuffle join does it.
MAX_BROADCAST_DOCS = 500_000
#: Line numbers to stay that may be broadcast with their documents' keys (4 bytes each); beyond, texts are joined by a shuffle.
MAX_BROADCAST_LINES = 4_000_000
_TRIM = " \t\r\x0b\x0c"
_ONES = (1 << 64) - 1


def edits_of(n: int, threshold: int | None) -> int:
    """Edits within which two lines are similar if the shorter one has n characters."""
    return min(n // EDIT_EACH, MAX_EDITS) if threshold is None else threshold


def bands(threshold: int | None, min_chars: int) -> list[tuple[int, int]]:
    """(least length, edits) of each band of lengths, ascending."""
    out, lo = [], min_chars
    while not out or lo < LAST_BAND:
        t = edits_of(lo, threshold)
        if lo <= t:
            raise ValueError("lines must be longer than the threshold")
        out.append((lo, t))
        wide = lo + max(t + 1, lo // 3)
        lo = min(wide, (t + 1) * EDIT_EACH) if threshold is None and t < MAX_EDITS else wide
    return out


def kinds(t: int) -> list[tuple[int, int]]:
    """(segment, shift) of a line's keys in a band of t edits; the first t + 1 are its own segments."""
    return [(i, 0) for i in range(t + 1)] + [(i, s) for i in range(t + 1) for s in range(-min(i, t - i), min(i, t - i) + 1) if s]


def segment_keys(line: str, length: str, lo: str, t: str, edits: list[int]) -> str:
    """SQL for an array of the line's keys in a band; edits has all values that t may take."""

    def key(i: int, shift: int, most: int) -> str:
        size = f"({lo} DIV {most + 1})"
        start = f"{i} * {size} + {shift}" if 2 * i <= most else f"{length} - {most - i + 1} * {size} + {shift}"
        return f"xxhash64({lo}, {i}, substring({line}, {start} + 1, {size}))"

    return f"CASE {t} " + " ".join(f"WHEN {most} THEN array(" + ", ".join(key(i, shift, most) for i, shift in kinds(most)) + ")" for most in edits) + " END"


def at(values: list[int], place: str) -> str:
    """SQL for the value at a place from 0."""
    return f"element_at(array({', '.join(map(str, values))}), CAST({place} AS INT) + 1)"


def mark(text: Column) -> Column:
    return F.xxhash64(text)


def settled_on_disk(df: DataFrame, name: str, *done: DataFrame) -> DataFrame:
    """stored(df), after which the tables done go, and the shuffle files that the driver's garbage still holds."""
    out = stored(df, name)
    for x in done:
        discard(x)
    jvm = df.sparkSession._jvm
    del df
    for _ in range(2):  # Python's references to plans hold the driver's
        gc.collect()
        jvm.System.gc()
    return out


def takes_part(line: Column, min_chars: int | None) -> Column:
    """Whether copies of a trimmed line are dropped."""
    return (F.length(line) >= MIN_CHARS) | line.rlike(r"\p{L}") if min_chars is None else F.length(line) >= min_chars


def numbers(lines: str, min_chars: int | None) -> Column:
    """The numbers (from 0) of those of an array's lines that take part."""
    return F.filter(F.transform(lines, lambda x, k: F.when(takes_part(F.btrim(x, F.lit(_TRIM)), min_chars), k)), lambda k: k.isNotNull())


def occurrences(docs: DataFrame, min_chars: int | None) -> DataFrame:
    """doc_id, mark, line_no (from 0) and the trimmed line, for every line that takes part."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", text.alias("_t")).select("doc_id", mark(F.col("_t")).alias("mark"), F.posexplode(F.split("_t", "\n")).alias("line_no", "raw"))
    return d.select("doc_id", "mark", "line_no", F.btrim("raw", F.lit(_TRIM)).alias("line")).where(takes_part(F.col("line"), min_chars))


def line_classes(docs: DataFrame, threshold: int | None, min_chars: int | None) -> DataFrame:
    """h1, h2, first (doc_id, mark, line_no, b, keys): a row per class, with its band's number and its keys there and in the band below (null for lines that only equal ones can match)."""
    all_bands = bands(threshold, MIN_CHARS if min_chars is None else min_chars)
    lows, most, edits = [lo for lo, _ in all_bands], [t for _, t in all_bands], sorted({t for _, t in all_bands})
    o = occurrences(docs, min_chars).withColumn("n", F.length("line"))
    o = o.withColumn("b", F.expr("CASE " + " ".join(f"WHEN n >= {lo} THEN {k}" for k, lo in reversed(list(enumerate(lows)))) + " ELSE 0 END"))
    o = o.select("*", F.expr(at(lows, "b")).alias("lo"), F.expr(at(most, "b")).alias("t"), F.expr(at([lows[0], *lows], "b")).alias("lo0"), F.expr(at([most[0], *most], "b")).alias("t0"))
    keys = f"CASE WHEN n >= {lows[0]} THEN concat({segment_keys('line', 'n', 'lo', 't', edits)}, CASE WHEN b > 0 AND n < lo + t0 THEN {segment_keys('line', 'n', 'lo0', 't0', edits)} ELSE CAST(array() AS array<bigint>) END) END"
    keyed = o.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), F.struct("doc_id", "mark", "line_no", "b", F.expr(keys).alias("keys")).alias("first"))
    return keyed.groupBy("h1", "h2").agg(F.min("first").alias("first"))


def pairs_of(index: DataFrame, probe: DataFrame) -> DataFrame:
    """Pairs of classes (a1, b1) that meet in a key k; a1 is less than b1."""
    i, p = index.select(F.col("k").alias("ki"), F.col("h1").alias("i1")), probe.select(F.col("k").alias("kp"), F.col("h1").alias("p1"))
    met = i.join(p, (i["ki"] == p["kp"]) & (i["i1"] != p["p1"]))
    return met.select(F.least("i1", "p1").alias("a1"), F.greatest("i1", "p1").alias("b1")).distinct()


def hot_keys(index: DataFrame) -> DataFrame:
    return settled_on_disk(index.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(f"n > {HOT}").select(F.col("k").alias("hk")), "hot-segments")


def parted(rows: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key isn't hot, and the others."""
    hot = bounded(hot, MAX_BROADCAST_DOCS)
    return rows.join(hot, rows["k"] == hot["hk"], "left_anti"), rows.join(hot, rows["k"] == hot["hk"], "left_semi")


def near_first(rows: DataFrame, lines: DataFrame, threshold: int | None) -> DataFrame:
    """The classes (h1, h2) that are similar to the earliest of those that share a key, where more than HOT do. rows: k, h1, place."""
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "h1")).alias("centre")).where(f"n > {HOT}")
    centres = stored(sizes.select(F.col("k").alias("hk"), F.col("centre.h1").alias("c1")), "hot-centres")
    at = bounded(centres, MAX_BROADCAST_DOCS)
    met = rows.join(at, rows["k"] == at["hk"]).where("h1 != c1").select(F.least("h1", "c1").alias("a1"), F.greatest("h1", "c1").alias("b1")).distinct()
    out = stored(verified(met, lines, threshold), "hot-copies")
    discard(centres)
    return out


def line_grams(line: str) -> list[int]:
    """The line's substrings of GRAM characters as hashes, by their place."""
    return [xxhash.xxh3_64_intdigest(line[k : k + GRAM].encode("utf-8", "surrogatepass")) - (1 << 63) for k in range(len(line) - GRAM + 1)]


def letter_counts(line: str) -> list[int]:
    """Characters by their code modulo LETTERS; an edit changes two counts by one at most."""
    return np.minimum(np.bincount(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS, minlength=LETTERS), 32_767).tolist()


def prefixes(lines: DataFrame, threshold: int | None) -> DataFrame:
    """k, pos, h1, place, n (length) and bag (letter counts) for the rarest grams of each line: as many as its edits can change and one more, and all
    other places of the last of them."""

    def run(texts: list[str]) -> list[list]:
        return [[line_grams(x) for x in texts], [len(x) for x in texts], [GRAM * edits_of(len(x), threshold) + 1 for x in texts], [letter_counts(x) for x in texts]]

    grams = stored(added(lines.select("h1", "place", "line"), ["line"], "grams array<bigint>, n int, most int, bag array<smallint>", run), "hot-grams")
    counts = gram_counts(grams)

    def rarest(grams_: list[list[int]], most: list[int]) -> list[list]:
        return [[rare_grams(g, m, counts) for g, m in zip(grams_, most, strict=True)]]

    ranked = added(grams, ["grams", "most"], "rare array<struct<k:bigint,pos:int>>", rarest)
    return ranked.select(F.explode("rare").alias("x"), "h1", "place", "n", "bag").select("x.k", "x.pos", "h1", "place", "n", "bag")


def gram_counts(grams: DataFrame) -> np.ndarray:
    """How often the grams of each slot of the sketch occur. A task counts its own, and the driver gets SKETCH sums at most."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(SKETCH, np.int64)
        for f in frames:
            for g in f["grams"]:
                np.add.at(own, np.asarray(g, np.int64) & (SKETCH - 1), 1)
        slots = np.flatnonzero(own)
        yield pd.DataFrame({"slot": slots.astype(np.int32), "n": own[slots]})

    sums = mapped(grams.select("grams"), run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SKETCH, np.int32)
    out[sums["slot"].to_numpy(np.int64)] = np.minimum(sums["n"].to_numpy(np.int64), 2**31 - 1)
    return out


def rare_grams(grams: list[int], most: int, counts: np.ndarray) -> list[dict]:
    """k and pos of the `most` grams that come first in the order of (count, gram), and of all other places of the last of them."""
    if not grams:
        return []
    g = np.array(grams, np.int64)
    c = counts[g & (len(counts) - 1)]
    z = np.lexsort((g, c))[min(most, len(g)) - 1]
    at_ = np.flatnonzero((c < c[z]) | ((c == c[z]) & (g <= g[z])))
    return [{"k": int(g[k]), "pos": int(k)} for k in at_]


def candidates(classes: DataFrame, docs: DataFrame, threshold: int | None, min_chars: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Distinct pairs of classes (a1, b1) that can be similar, a1 less than b1; and the classes (h1, h2) that are settled as copies already."""
    most = [t for _, t in bands(threshold, MIN_CHARS if min_chars is None else min_chars)]
    count = at([len(kinds(t)) for t in most], "b")
    rows = classes.select(F.posexplode("first.keys").alias("p", "k"), "h1", F.col("first.b").alias("b"))
    own = f"CASE WHEN p < {count} THEN p <= {at(most, 'b')} ELSE p - {count} <= {at(most, 'b - 1')} END"
    rows = rows.select("k", "h1", F.expr(own).alias("own"))
    hot = hot_keys(rows.where("own"))
    if not hot.limit(1).count():
        return pairs_of(rows.where("own"), rows), None
    cold, rows = parted(rows, hot)
    found = settled_on_disk(pairs_of(cold.where("own"), cold), "line-pairs")
    rows = settled_on_disk(rows.select("k", "h1").distinct(), "hot-rows", hot)
    lines = settled_on_disk(lines_of(classes, rows.select(F.col("h1").alias("x1")).distinct(), docs, min_chars), "hot-lines")
    places = lines.select(F.col("h1").alias("l1"), "place")
    first = near_first(rows.join(places, rows["h1"] == places["l1"]).select("k", "h1", "place"), lines, threshold)
    grams = settled_on_disk(prefixes(lines, threshold), "hot-prefixes", rows)
    settled = stored(first.union(near_first(grams, lines, threshold)).distinct(), "hot-copies")
    done = settled.select(F.col("h1").alias("d1")).distinct()
    x, y = (grams.select([F.col(c).alias(f"{s}_{c}") for c in ("k", "pos", "h1", "n", "bag")]) for s in "xy")
    open_ = x.join(bounded(done, MAX_BROADCAST_DOCS), F.col("x_h1") == F.col("d1"), "left_anti")
    widest = max(most)
    met = open_.join(y, (F.col("x_k") == F.col("y_k")) & (F.col("x_h1") != F.col("y_h1")) & (F.abs(F.col("x_n") - F.col("y_n")) <= widest) & (F.abs(F.col("x_pos") - F.col("y_pos")) <= widest) & F.expr(f"aggregate(zip_with(x_bag, y_bag, (a, b) -> abs(a - b)), 0, (s, v) -> s + v) <= {2 * widest}"))
    met = met.select(F.least("x_h1", "y_h1").alias("a1"), F.greatest("x_h1", "y_h1").alias("b1"))
    pairs = settled_on_disk(met.union(found).distinct(), "line-pairs", found, lines, grams, first)
    return pairs, settled


def lines_of(classes: DataFrame, some: DataFrame, docs: DataFrame, min_chars: int | None) -> DataFrame:
    """h1, h2, place and line of the classes some (x1, distinct), read again at their first occurrence."""
    places = stored(classes.join(some, classes["h1"] == some["x1"], "left_semi").select("h1", "h2", F.struct("first.doc_id", "first.mark", "first.line_no").alias("place")), "line-places")
    where = places.select(F.col("place.doc_id").alias("wd"), F.col("place.mark").alias("wm")).distinct()
    here = docs.select("doc_id", "text").withColumn("wm2", mark(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = here.join(bounded(where, MAX_BROADCAST_DOCS), here["doc_id"].eqNullSafe(where["wd"]) & (here["wm2"] == where["wm"]), "left_semi")
    text = occurrences(found, min_chars).select(F.xxhash64("line").alias("t1"), F.xxhash64(F.lit(7), "line").alias("t2"), F.struct("doc_id", "mark", "line_no").alias("at"), "line")
    met = text.join(places, (text["t1"] == places["h1"]) & (text["t2"] == places["h2"]) & text["at"].eqNullSafe(places["place"]))
    return met.select("h1", "h2", "place", "line").dropDuplicates(["h1", "h2"])


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance of a and b is at most `most` (0 to 31), by a band of bit-vectors (Hyyro 2003) along the diagonal."""
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    # common ends don't count
    lo, hi = 0, len(b)
    while lo < hi:  # bisection: slices compare at memory speed
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(b)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] == b[len(b) - mid :] else (lo, mid - 1)
    a, b = a[: len(a) - lo], b[: len(b) - lo]
    if not b or len(a) <= most:
        return max(len(a), len(b)) <= most
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    up, down, dist = _ONES & ~((1 << (63 - most)) - 1), 0, most
    start, bottom, limit = most - 63, 1 << 62, most + len(b) - (len(a) - most)
    for j, c in enumerate(b):
        m = at.get(c, 0)
        m = (m >> start if start > 0 else m << -start) & _ONES
        zero = ((((m & up) + up) ^ up) | m | down) & _ONES
        right, left = down | (_ONES & ~(zero | up)), zero & up
        if j < len(a) - most:
            dist += not zero >> 63
            if dist > limit:
                return False
        else:
            dist += bool(right & bottom) - bool(left & bottom)
            bottom >>= 1
        up, down = left | (_ONES & ~((zero >> 1) | right)), (zero >> 1) & right
        start += 1
    return dist <= most


def verified(pairs: DataFrame, lines: DataFrame, threshold: int | None) -> DataFrame:
    """The later class (h1, h2) of each pair whose lines are similar."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [within(x, y, edits_of(min(len(x), len(y)), threshold)) for x, y in zip(f["la"], f["lb"], strict=True)]
            yield f.loc[ok, ["h1", "h2"]] if len(f) else f[["h1", "h2"]]

    a, b = (lines.select(F.col("h1").alias(f"{s}h1"), F.col("h2").alias(f"{s}h2"), F.col("place").alias(f"p{s}"), F.col("line").alias(f"l{s}")) for s in "ab")
    x = pairs.join(a, pairs["a1"] == a["ah1"]).select("b1", "ah1", "ah2", "pa", "la")
    x = x.join(b, F.col("b1") == b["bh1"])
    later = lambda k: F.when(F.col("pa") < F.col("pb"), F.col(f"bh{k}")).otherwise(F.col(f"ah{k}")).alias(f"h{k}")
    return mapped(x.select(later(1), later(2), "la", "lb"), run, "h1 long, h2 long").distinct()


def kept_lines(docs: DataFrame, threshold: int | None = EDITS, min_chars: int | None = None) -> DataFrame:
    """doc_id, mark, kept: the numbers of the lines taking part that stay, for documents that keep any."""
    docs = docs.select("doc_id", "text")
    classes = settled_on_disk(line_classes(docs, threshold, min_chars), "line-classes")
    pairs, settled = candidates(classes, docs, threshold, min_chars)
    pairs = pairs if settled is not None else settled_on_disk(pairs, "line-pairs")
    met = pairs.select(F.explode(F.array("a1", "b1")).alias("x1")).distinct()
    lines = stored(lines_of(classes, met, docs, min_chars), "lines")
    copies = verified(pairs, lines, threshold)
    copies = copies if settled is None else copies.union(settled).distinct()
    stay = classes.select("h1", "h2", "first.doc_id", "first.mark", "first.line_no").join(copies.select(F.col("h1").alias("c1"), F.col("h2").alias("c2")), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left_anti")
    kept = stored(stay.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("line_no")).alias("kept")), "kept-lines")
    for done in (classes, pairs, lines):
        discard(done)
    return kept


def dedup_lines(docs: DataFrame, threshold: int | None = EDITS, min_chars: int | None = None) -> DataFrame:
    """docs with the copies of lines removed from text; other columns and null texts as they are."""
    kept = kept_lines(docs, threshold, min_chars).select(F.col("doc_id").alias("_kd"), F.col("mark").alias("_km"), F.col("kept").alias("_kept"))
    size = kept.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("_kept")), F.lit(0)).alias("numbers")).first()
    if size["rows"] <= MAX_BROADCAST_DOCS and size["numbers"] <= MAX_BROADCAST_LINES:
        kept = F.broadcast(kept)
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_t"))
    rows = rows.withColumn("_mark", mark(F.coalesce("_t", F.lit(""))))
    met = rows.join(kept, rows["_id"].eqNullSafe(kept["_kd"]) & (rows["_mark"] == kept["_km"]), "left").select("_row", "_t", F.split("_t", "\n").alias("_l"), "_kept")
    gone = F.array_except(numbers("_l", min_chars), F.coalesce("_kept", F.array().cast("array<int>")))
    met = met.select("_row", "_t", gone.alias("_gone"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for text, drop in zip(f["_t"], f["_gone"], strict=True):
                if text is not None:
                    drop = set(drop)
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
                out.append(text)
            yield f[["_row"]].assign(_t=out)

    done = mapped(met, run, met.select("_row", "_t").schema)
    return done.select(*[F.col("_t").cast(docs.schema[c].dataType).alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, and the numbers of the dropped lines (from 0, comma-joined)."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = kept_lines(docs).select(F.col("doc_id").alias("_kd"), F.col("mark").alias("_km"), "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", mark(text).alias("_m"), F.split(text, "\n").alias("_l"))
    rows = rows.select("doc_id", "_m", F.size("_l").cast("long").alias("n_lines"), numbers("_l", None).alias("_long"))
    met = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_kd"]) & (rows["_m"] == kept["_km"]), "left")
    gone = F.array_except("_long", F.coalesce("kept", F.array().cast("array<int>")))
    return met.select("doc_id", "n_lines", gone.alias("_gone")).select("doc_id", "n_lines", F.size("_gone").cast("long").alias("n_dropped"), F.array_join("_gone", ",").alias("dropped"))
