"""Text statistics as Spark column expressions, shared by the quality operators. No Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import SPACE

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: The long columns that statistics() adds.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words"]
#: Per-document rates derived from the counts: name -> SQL over the counts.
RATES = {
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "mark_rate": "n_marks / greatest(n_words, 1)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "distinct_rate": "n_distinct_words / greatest(n_words, 1)",
}


def _left(text: Column, keep: str) -> Column:
    """How many characters of text the class `keep` holds."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def statistics(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """carry columns plus COUNTS for every row; null text counts as empty. One pass, no shuffle.

    Three-word windows are hashed to 64 bits; windows that occur more than once are found by sorting (hash, position)
    inside the row, so a text of n words takes n log n steps.
    """
    d = docs.select(*carry, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    d = d.select(
        *carry,
        F.array_remove(F.split("_t", f"[{SPACE}]+"), "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_l"),
    )
    d = d.select(*carry, "_w", "_l", F.array_join("_w", "").alias("_j"), F.expr("CASE WHEN size(_w) >= 3 THEN transform(sequence(0, size(_w) - 3), i -> struct(xxhash64(_w[i], _w[i + 1], _w[i + 2]) AS h, i AS i)) END").alias("_g"))
    d = d.select(
        *carry,
        F.size("_w").cast("long").alias("n_words"),
        F.length("_j").cast("long").alias("word_chars"),
        _left(F.col("_j"), SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        _left(F.col("_j"), r"\p{Lu}").alias("n_upper"),
        _left(F.col("_j"), "0-9").alias("n_digits"),
        _left(F.col("_j"), "!?").alias("n_marks"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"),
        F.sort_array("_g").alias("_s"),
    )
    again = "filter(_s, (x, k) -> (k > 0 AND get(_s, k - 1).h = x.h) OR (k < size(_s) - 1 AND get(_s, k + 1).h = x.h))"
    d = d.withColumn("_r", F.expr(again))
    covered = F.expr("CASE WHEN coalesce(size(_r), 0) > 0 THEN size(array_distinct(flatten(transform(_r, x -> array(x.i, x.i + 1, x.i + 2))))) ELSE 0 END")
    return d.select(*carry, *[covered.cast("long").alias(c) if c == "n_repeat_words" else F.col(c) for c in COUNTS])


def rates(counts: DataFrame) -> DataFrame:
    """counts plus one double column per entry of RATES."""
    return counts.withColumns({name: F.expr(sql).cast("double") for name, sql in RATES.items()})
