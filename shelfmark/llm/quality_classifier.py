"""Quality classifier: a sparse ensemble of rules over text statistics, compiled to a Spark column.

Shallow boosted trees are grown on the statistics of a labelled sample; every path from a root to a node is a
conjunctive rule. A logistic regression with an L1 penalty on the rules keeps few of them. Depth and penalty are chosen
from SETTINGS on an inner fold of the training documents, never on the held-out fold. The score is one SQL expression
over the statistics, so documents are scored where they are read, without Python.

Null and empty texts have zero statistics and are scored like any other row. With labels of one class only, or none,
the score is the prior. Repeated rows score alike. A null doc_id is scored; its held_out is false.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import documents, stored
from shelfmark.llm.labelled import fold, sample_labels
from shelfmark.llm.statistics import RATES, rates, statistics

#: Labelled documents used for training: their statistics, some doubles each, go to the driver.
MAX_TRAINING = 20_000
FEATURES = [*RATES, "n_words", "n_lines"]
TREES, BINS, LEAST_LEAF, SHRINK, STEPS = 40, 32, 20, 0.3, 400
#: What is tried on the inner fold (every INNER-th training document by a hash of its id): depth of the trees and penalty.
SETTINGS, INNER = [(2, 1e-3), (3, 1e-3), (3, 3e-4)], 5
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5

Rule = tuple[tuple[int, str, float], ...]


def grow(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, weight: np.ndarray, rows: np.ndarray, path: Rule, depth: int, rules: list[Rule], out: np.ndarray) -> None:
    """One regression tree on the gradient; paths to its nodes are added to rules, leaf steps to out."""
    if path:
        rules.append(path)
    best = (1e-9, None)
    if depth and len(rows) >= 2 * LEAST_LEAF:
        g, h = residual[rows], weight[rows]
        whole = g.sum() ** 2 / (h.sum() + 1)
        for f, c in enumerate(cuts):
            if len(c):
                bin_ = np.searchsorted(c, x[rows, f], side="left")
                gs, hs, ns = (np.cumsum(np.bincount(bin_, v, len(c) + 1))[:-1] for v in (g, h, np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                gain[(ns < LEAST_LEAF) | (len(rows) - ns < LEAST_LEAF)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, float(c[k])))
    if best[1] is None:
        out[rows] += SHRINK * residual[rows].sum() / (weight[rows].sum() + 1)
        return
    f, cut = best[1]
    low = x[rows, f] <= cut
    grow(x, cuts, residual, weight, rows[low], (*path, (f, "<=", cut)), depth - 1, rules, out)
    grow(x, cuts, residual, weight, rows[~low], (*path, (f, ">", cut)), depth - 1, rules, out)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for f, side, cut in rule:
        ok &= x[:, f] <= cut if side == "<=" else x[:, f] > cut
    return ok


class RuleEnsemble:
    def __init__(self, rules: list[Rule], weights: np.ndarray, bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def predict(self, x: np.ndarray) -> np.ndarray:
        s = np.full(len(x), self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            s += w * holds(rule, x)
        return 1 / (1 + np.exp(-s))

    def column(self) -> Column:
        """The score as a Spark expression over FEATURES."""
        terms = [f"CASE WHEN {' AND '.join(f'{FEATURES[f]} {side} {cut!r}D' for f, side, cut in rule)} THEN {float(w)!r}D ELSE 0D END" for rule, w in zip(self.rules, self.weights, strict=True)]
        return F.expr(f"1D / (1D + exp(-({' + '.join([f'{self.bias!r}D', *terms])})))")


def loss(model: RuleEnsemble, x: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(model.predict(x), 1e-9, 1 - 1e-9)
    return float(-np.mean(np.where(y == 1, np.log(p), np.log1p(-p)))) if len(y) else 0.0


def chosen(x: np.ndarray, y: np.ndarray, inner: np.ndarray) -> RuleEnsemble:
    """The ensemble of all rows, under the setting whose fit to the rows outside `inner` has the least loss on those inside."""
    losses = [loss(fit(x[~inner], y[~inner], *setting), x[inner], y[inner]) for setting in SETTINGS]
    return fit(x, y, *SETTINGS[int(np.argmin(losses))])


def fit(x: np.ndarray, y: np.ndarray, depth: int, penalty: float) -> RuleEnsemble:
    prior = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    bias = float(np.log(prior / (1 - prior)))
    if len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return RuleEnsemble([], np.zeros(0), bias)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    cuts = [c[c < col.max()] for c, col in zip(cuts, x.T, strict=True)]
    rules: list[Rule] = []
    step = np.full(len(y), bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-step))
        grow(x, cuts, y - p, p * (1 - p), np.arange(len(y)), (), depth, rules, step)
    distinct: dict[bytes, Rule] = {}
    for rule in rules:
        hit = holds(rule, x)
        if 0 < hit.sum() < len(y):
            distinct.setdefault(np.packbits(hit).tobytes(), rule)
    rules = list(distinct.values())
    if not rules:
        return RuleEnsemble([], np.zeros(0), bias)
    r = np.stack([holds(rule, x) for rule in rules], axis=1).astype(np.float32)
    # FISTA on the logistic loss with an L1 penalty; the bias isn't penalised
    w, b = np.zeros(r.shape[1]), bias
    u, ub, t = w.copy(), b, 1.0
    rate = 1 / (0.25 * (np.linalg.norm(r.T @ r / len(y), 2) + 1))
    for _ in range(STEPS):
        g = (1 / (1 + np.exp(-(r @ u + ub))) - y) / len(y)
        new = u - rate * (r.T @ g)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        nb = ub - rate * g.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, ub = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleEnsemble([rules[k] for k in kept], w[kept], float(b))


def measured(docs: DataFrame) -> DataFrame:
    """Stored statistics and rates of every document."""
    return rates(stored(statistics(docs.select("doc_id", "text"), ["doc_id"]), "classifier-statistics"))


def train(table: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> RuleEnsemble:
    """Fits on the driver from the statistics of at most `most` labelled documents outside the held-out fold."""
    ids = sample_labels(labels, "quality", FOLDS, HELD_OUT, most)
    rows = table.join(F.broadcast(ids), table["doc_id"] == ids["_id"]).select("_id", *[F.col(f).cast("double").alias(f) for f in FEATURES], "y", (F.pmod(F.xxhash64(F.lit("inner"), "_id"), F.lit(INNER)) == 0).alias("inner")).collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    return chosen(x, np.array([r["y"] for r in rows], float), np.array([r["inner"] for r in rows], bool))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document."""
    table = measured(documents(spark, sf_dir))
    model = train(table, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    out = table.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), model.column().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
