"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

A rule rejects a document when one statistic lies beyond a cutoff. Labelled texts, each counted once, are parted into two
halves by a hash of the text. The first half proposes, per stratum (language): cutoffs are tried at quantiles of its own
statistics, each rule takes the one that rejects most bad texts less FALSE_COST for each good one, moved halfway towards the
least bad text beyond it, and the rules form a path, the most precise first. The second half, which had no part in that, calibrates: along the path, the number of its
good texts that the base rule or the rules so far reject is tested against alpha with the exact binomial test, up to the
first step that isn't safe (fixed-sequence testing; delta is divided by the number of strata). Of the safe beginnings of
the path, the one of greatest value on the first half is used. So with probability 1 - delta or more, rules are in force
only in strata in which at most alpha of the good texts are rejected, losses by the base rule included; elsewhere the
base rule stands alone. A stratum can have rules from 29 good texts in its second half on if it is the only one, from 42
with four strata, when none of them is rejected.

Null, empty and missing cases: null text counts as empty and has no words, so the base rule rejects it. A null language
is the stratum "". Labels whose quality is null, and strata or tables without labels, lead to no rules: only the base
rule acts. Of a document or text with several labels the smallest quality counts. Repeated documents each keep their
row. Extra columns pass through apply_rules unchanged; those named like a statistic are replaced in the digest only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import bounded, documents, stored
from shelfmark.llm.statistics import rates, statistics

#: rule -> statistic, signed so that large values are bad.
RULES = {
    "symbols": "symbol_rate", "capitals": "upper_rate", "marks": "mark_rate", "repeats": "repeat_rate", "copied_lines": "dup_line_rate",
    "digits": "digit_rate", "long_words": "mean_word", "short_words": "-mean_word", "few_words": "-distinct_rate",
}
#: Cutoffs are tried at these quantiles of the labelled texts that pass the base rule.
QUANTILES = [0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995]
ALPHA, DELTA, FALSE_COST = 0.1, 0.05, 5.0
#: Strata up to which the table of cutoffs is broadcast; with more it is joined by a shuffle.
MAX_BROADCAST_STRATA = 10_000
#: Labelled ids up to which they are broadcast to find their documents (8 bytes each).
MAX_BROADCAST_LABELS = 1_000_000
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def binomial_tail(n: str, k: str, p: float) -> str:
    """SQL for P(Bin(n, p) <= k), exactly summed in logarithms; 1 where k >= n p, where no test could reject."""
    q, up = 1 - p, f"cast({k} AS int)"
    top = f"aggregate(sequence(1, greatest({up}, 1)), 0D, (a, i) -> a + CASE WHEN i <= {k} THEN ln(({n} - i + 1) / i) ELSE 0D END) + {k} * ln({p}D) + ({n} - {k}) * ln({q}D)"
    rest = f"aggregate(sequence(1, greatest({up}, 1)), struct(1D AS t, 1D AS s), (a, i) -> CASE WHEN i <= {k} THEN struct(a.t * ({k} - i + 1) / ({n} - {k} + i) * {q / p}D AS t, a.s + a.t * ({k} - i + 1) / ({n} - {k} + i) * {q / p}D AS s) ELSE a END, a -> a.s)"
    return f"CASE WHEN {n} = 0 OR {k} >= {n} * {p}D THEN 1D ELSE least(1D, exp({top}) * {rest}) END"


def first_step(path: str) -> str:
    """SQL: the first step (from 1) of a path of (rule, cutoff) that rejects a row with `v`; null if none does."""
    return f"array_min(transform({path}, (x, i) -> CASE WHEN v[x.rule] > x.cutoff THEN i + 1 END))"


def proposed(half: DataFrame) -> DataFrame:
    """stratum and path, an array of (rule, cutoff), the most precise rule first. half: stratum, quality, v of texts that pass the base rule."""
    tried = half.groupBy(F.col("stratum").alias("s")).agg(F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*[F.expr(f"percentile_approx(v['{r}'], array({', '.join(map(str, QUANTILES))}), 10000)") for r in RULES])).alias("q"))
    beyond = half.join(bounded(stored(tried, "quality-quantiles"), MAX_BROADCAST_STRATA), F.col("stratum") == F.col("s"))
    level = beyond.select("s", "quality", "q", F.explode("v").alias("rule", "value")).select("s", "quality", "rule", "value", F.expr("q[rule]").alias("q"), F.expr("size(filter(q[rule], c -> value > c))").alias("level"))
    per = level.groupBy("s", "rule", "level").agg(F.expr("count_if(quality = 0)").alias("bad"), F.expr("count_if(quality = 1)").alias("good"), F.expr("min(value) FILTER (WHERE quality = 0)").alias("least"), F.first("q").alias("q"))
    per = per.groupBy("s", "rule").agg(F.collect_list(F.struct("level", "bad", "good", "least")).alias("c"), F.first("q").alias("q"))
    total = lambda what: f"aggregate(filter(c, x -> x.level > j), 0L, (a, x) -> a + x.{what})"
    # the cutoff lies halfway between the quantile and the least bad text beyond it
    halfway = "(cutoff + array_min(transform(filter(c, x -> x.level > j), x -> x.least))) / 2 AS cutoff"
    cell = per.select("s", "rule", F.explode(F.expr(f"transform(q, (cutoff, j) -> struct(j, {halfway}, {total('bad')} AS bad, {total('good')} AS good))")).alias("x")).select("s", "rule", "x.*")
    value = f"bad - {FALSE_COST}D * good"
    best = cell.where(f"bad > 0 AND {value} > 0").groupBy("s", "rule").agg(F.expr(f"max_by(struct(bad, good, cutoff), struct({value}, j))").alias("b"))
    step = F.struct((-F.col("b.bad") / (F.col("b.bad") + F.col("b.good") + 1)).alias("o"), (-F.col("b.bad")).alias("n"), "rule", "b.cutoff")
    path = F.transform(F.sort_array(F.collect_list("step")), lambda x: F.struct(x["rule"].alias("rule"), x["cutoff"].alias("cutoff")))
    return best.select(F.col("s").alias("stratum"), step.alias("step")).groupBy("stratum").agg(path.alias("path"))


def select_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """labelled: stratum, quality, mark, base_failed and v of every labelled text, once. Returns stratum, cuts (map from rule to cutoff)."""
    labelled = stored(labelled.withColumn("half", F.expr("pmod(xxhash64('half', mark), 2)")), "quality-labelled")
    strata = max(1, labelled.where("half = 1").select("stratum").distinct().count())
    paths = stored(proposed(labelled.where("half = 0 AND NOT base_failed")), "quality-paths")
    p = bounded(paths.select(F.col("stratum").alias("s"), "path"), MAX_BROADCAST_STRATA)
    met = labelled.join(p, F.col("stratum") == F.col("s")).select("s", "quality", "half", "path", F.expr(f"CASE WHEN base_failed THEN 0 ELSE {first_step('path')} END").alias("step"))
    per = met.groupBy("s", F.coalesce("step", F.lit(len(RULES) + 1)).alias("step")).agg(F.first("path").alias("path"), F.expr("count_if(half = 1 AND quality = 1)").alias("lost"), F.expr("count_if(half = 0 AND quality = 1)").alias("good"), F.expr("count_if(half = 0 AND quality = 0)").alias("bad"))
    per = per.groupBy("s").agg(F.first("path").alias("path"), F.sum("lost").alias("n"), F.collect_list(F.struct("step", "lost", "good", "bad")).alias("c"))
    until = lambda what, least: f"aggregate(filter(c, x -> x.step BETWEEN {least} AND m), 0L, (a, x) -> a + x.{what})"
    step = per.select("s", "path", "n", F.explode(F.expr(f"transform(sequence(0, size(path)), m -> struct(m, {until('lost', 0)} AS lost, {until('bad', 1)} - {FALSE_COST}D * {until('good', 1)} AS value))")).alias("x")).select("s", "path", "n", "x.*")
    step = step.withColumn("safe", F.expr(f"{binomial_tail('n', 'lost', alpha)} <= {delta / strata!r}D"))
    held = step.groupBy("s").agg(F.first("path").alias("path"), F.coalesce(F.min(F.when(~F.col("safe"), F.col("m"))), F.lit(len(RULES) + 1)).alias("stop"), F.collect_list(F.struct("value", (-F.col("m")).alias("mild"), "m")).alias("c"))
    best = held.select(F.col("s").alias("stratum"), F.expr("slice(path, 1, array_max(filter(c, x -> x.m < stop)).m)").alias("path"))
    return best.where("size(path) > 0").select("stratum", F.map_from_entries("path").alias("cuts"))


def signed(df: DataFrame) -> DataFrame:
    """df (with the RATES columns) plus v, a map from rule to its signed statistic."""
    return df.withColumn("v", F.create_map(*[x for rule, sql in RULES.items() for x in (F.lit(rule), F.expr(sql))]))


def labelled_texts(table: DataFrame, labels: DataFrame) -> DataFrame:
    """table: statistics with doc_id, stratum and mark (the text's hash). What select_cutoffs() takes."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("quality"))
    rows = signed(rates(table.join(known, table["doc_id"] == known["_id"]))).withColumn("base_failed", F.expr(BASE_FAILED))
    return rows.groupBy("stratum", "mark").agg(F.min("quality").alias("quality"), F.first("base_failed").alias("base_failed"), F.first("v").alias("v"))


def verdicts(table: DataFrame, cuts: DataFrame) -> DataFrame:
    """table with base_failed, reasons (the rules that reject) and kept. cuts has a row per stratum; it is broadcast while it is small."""
    carry, cuts = table.columns, stored(cuts, "quality-cutoffs").withColumnRenamed("stratum", "_of")
    out = rates(table).join(bounded(cuts, MAX_BROADCAST_STRATA), table["stratum"] == cuts["_of"], "left")
    reasons = F.array_compact(F.array(*[F.when(F.expr(f"{sql} > cuts['{rule}']"), F.lit(rule)) for rule, sql in RULES.items()]))
    out = out.select(*carry, F.expr(BASE_FAILED).alias("base_failed"), reasons.alias("reasons"))
    return out.withColumn("kept", F.expr("NOT base_failed AND size(reasons) = 0"))


def stratum() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum")


def marked(docs: DataFrame) -> list:
    return ["doc_id", stratum(), "text", F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("mark")]


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, stratum, mark, the counts of statistics(), base_failed, reasons and kept, one row per row of docs. Statistics are taken once and stored."""
    table = stored(statistics(docs.select(*marked(docs)), ["doc_id", "stratum", "mark"]), "quality-statistics")
    return verdicts(table, select_cutoffs(labelled_texts(table, labels), alpha, delta))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns whatever their names. Whole texts are never shuffled:
    statistics are taken of the labelled rows first, then of every row where it stands."""
    ids = labels.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
    some = docs.join(bounded(ids, MAX_BROADCAST_LABELS), docs["doc_id"] == ids["_id"], "left_semi")
    table = stored(statistics(some.select(*marked(some)), ["doc_id", "stratum", "mark"]), "quality-statistics")
    cuts = select_cutoffs(labelled_texts(table, labels), alpha, delta)
    rows = docs.select(F.struct("*").alias("_row"), stratum(), "text")
    judged_rows = verdicts(statistics(rows, ["_row", "stratum"]), cuts).withColumn("_n", F.monotonically_increasing_id())
    # the id holds the filter here; moved below, it would repeat the statistics' expressions inside one another
    return judged_rows.where("kept AND _n >= 0").select("_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document, and the rules that reject it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = judged(documents(spark, sf_dir), labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("reasons", ",").alias("reasons"))
