"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's score is the logistic of a bias plus the weights of its distinct words and their beginnings; the document's
is the noisy-or 1 - prod(1 - p) over its sentences. Bias and weights are fitted to document labels alone, by proximal
Adam steps with an L1 penalty, on the features most associated with the label. Whether beginnings count and how strong
the penalty is, is chosen from SETTINGS on an inner fold of the training documents, never on the held-out fold. The
features of the sample are counted and encoded where the texts are read; the driver gets numbers only. The fitted
sentence scores then locate the offending sentences: all that score OFFENDING or more and, in a document over THRESHOLD,
as many of the highest as it takes for their noisy-or to reach it.

Null, empty and wordless texts have no sentence; they score the noisy-or over one sentence of no words. Without labels
of both classes, every weight is zero and every sentence scores the prior. Repeated rows score alike. A null doc_id is
scored; its held_out is false.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm.common import added, batches, documents, stored
from shelfmark.llm.labelled import fold, sample_labels

#: Labelled documents used for training at most.
MAX_TRAINING = 6_000
#: Lengths of word beginnings; features kept for a fit, with their least association (z) and least number of documents.
PREFIXES, MAX_FEATURES, LEAST_Z, LEAST_DOCS = (4, 5, 6), 2_000, 4.0, 4
#: What is tried on the inner fold (one document of INNER): whether beginnings count, and the penalty.
SETTINGS, INNER = [(False, 2e-4), (True, 2e-4), (True, 5e-5)], 5
#: Steps of a fit; words a worker remembers; the least weight that is kept.
STEPS, MAX_REMEMBERED, LEAST_WEIGHT = 300, 200_000, 0.05
FOLDS, HELD_OUT, THRESHOLD, OFFENDING = 4, 2, 0.3, 0.5
WORD, SENTENCE = re.compile(r"[^\W\d_]+"), re.compile(r"[^.!?\n]+")


def features(word: str) -> list[str]:
    """A word and its beginnings of PREFIXES letters, so that inflected forms share weight."""
    return [word, *[f"{word[:k]}*" for k in PREFIXES if len(word) > k]]


def sentence_words(text: str | None) -> list[set[str]]:
    """Distinct lower-case words of every sentence that has any."""
    out = [set(WORD.findall(s)) for s in SENTENCE.findall((text or "").lower())]
    return [s for s in out if s]


class NoisyOr(dict):
    """weights of features and a bias; as a dict it remembers each word's weighted features, up to MAX_REMEMBERED words."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.plain = float(np.logaddexp(0, bias))

    def __reduce__(self):
        return NoisyOr, (self.weights, self.bias)

    def __missing__(self, word: str) -> tuple[str, ...]:
        found = tuple(x for x in features(word) if x in self.weights)
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def logit(self, words: set[str]) -> float | None:
        """A sentence's log-odds; None if no feature of it has a weight."""
        hit = {x for found in map(self.__getitem__, words) if found for x in found}
        return self.bias + sum(self.weights[x] for x in sorted(hit)) if hit else None

    def read(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, 1 - prod over sentences of (1 - p), and (start, end, p) of the offending sentences in their order."""
        safe, any_, found = 0.0, False, []
        for m in SENTENCE.finditer(text or ""):
            words = set(WORD.findall(m[0].lower()))
            if words:
                any_, z = True, self.logit(words)
                safe += self.plain if z is None else float(np.logaddexp(0, z))
                if z is not None:
                    found.append((z, m.start(), m.end()))
        score = float(-np.expm1(-(safe if any_ else self.plain)))
        out, have, need = [], 0.0, -float(np.log1p(-THRESHOLD)) if score >= THRESHOLD else 0.0
        for z, start, end in sorted(found, key=lambda x: (-x[0], x[1])):
            p = float(1 / (1 + np.exp(-z)))
            if p < OFFENDING and have >= need:
                break
            out.append((start, end, p))
            have += float(np.logaddexp(0, z))
        return score, sorted(out)


class Bags:
    """Labelled documents as sentences of feature numbers."""

    def __init__(self, names: list[str], y: list[int], inner: list[bool], sentences: list[list[list[int]]]):
        self.names, self.y, self.inner = names, np.asarray(y, float), np.asarray(inner, bool)
        sizes = [max(1, len(s)) for s in sentences]  # no sentence counts as one without words
        self.of = np.repeat(np.arange(len(y)), sizes)
        rows = [s for d in sentences for s in (d or [[]])]
        self.cols = np.fromiter((c for s in rows for c in s), np.int64)
        self.rows = np.repeat(np.arange(len(rows)), [len(s) for s in rows])

    def prior(self) -> float:
        """The bias at which a document of the mean number of sentences has the share of toxic documents."""
        share = float(np.clip(self.y.mean() if len(self.y) else 0.1, 0.01, 0.99))
        return float(np.log(np.expm1(-np.log1p(-share) / max(1.0, len(self.of) / max(1, len(self.y))))))

    def safe(self, w: np.ndarray, b: float, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per sentence its log-odds, per document the log of its chance to be clean."""
        s = b + np.bincount(self.rows, (w * keep)[self.cols], len(self.of))
        return s, -np.bincount(self.of, np.logaddexp(0, s), len(self.y))

    def fit(self, keep: np.ndarray, penalty: float, docs: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights of the features in keep, and the bias, from the documents in docs."""
        w, b, n, y = np.zeros(len(self.names)), self.prior(), max(1, docs.sum()), self.y
        m = v = np.zeros(len(w) + 1)
        for step in range(1, STEPS + 1):
            s, log_clean = self.safe(w, b, keep)
            clean = np.exp(log_clean)
            slope = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * docs / n
            g = slope[self.of] / (1 + np.exp(-s))
            grad = np.append(np.bincount(self.cols, g[self.rows], len(w)) * keep, g.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            rate = 0.1 / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            move = rate * m / (1 - 0.9**step)
            w = w - move[:-1]
            w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * penalty, 0)
            b -= move[-1] * 0.5
        return w * keep, float(b)

    def loss(self, w: np.ndarray, b: float, docs: np.ndarray) -> float:
        _, log_clean = self.safe(w, b, np.ones(len(w)))
        p = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        return float(-np.mean(np.where(self.y == 1, np.log(p), np.log1p(-p))[docs]))


def chosen(counts: list[tuple[str, int, int]], n: int, pos: int, beginnings: bool) -> set[str]:
    """The features most associated with the label. counts: feature, its documents, the toxic ones of them."""
    if not 0 < pos < n:
        return set()
    share = pos / n
    z = {f: abs(t - k * share) / np.sqrt(k * share * (1 - share)) for f, k, t in counts if k >= LEAST_DOCS and (beginnings or not f.endswith("*"))}
    return set(sorted((f for f in z if z[f] > LEAST_Z), key=lambda f: (-z[f], f))[:MAX_FEATURES])


def feature_counts(sample: DataFrame) -> DataFrame:
    """f, and its documents and toxic ones: n0, t0 in the inner training part, n, t in all of sample (text, y, inner). Summed in each
    task first, and those that too few documents have are left out at the end."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[Counter] = [Counter(), Counter(), Counter(), Counter()]
        for part in parts:
            for text, y, inner in zip(*[part.column(k).to_pylist() for k in range(3)], strict=True):
                found = {x for w in set(WORD.findall((text or "").lower())) for x in features(w)}
                for at, counts in enumerate(((not inner), (not inner) and y, True, y)):
                    if counts:
                        sums[at].update(found)
        names = list(sums[2])
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *[pa.array([c[x] for x in some], pa.int64()) for c in sums]], names=["f", "n0", "t0", "n", "t"])

    batches(sample.sparkSession)
    sums = sample.select("text", "y", "inner").mapInArrow(run, "f string, n0 long, t0 long, n long, t long")
    return sums.groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n0", "t0", "n", "t")]).where(f"n >= {LEAST_DOCS}")


def bags_of(sample: DataFrame) -> tuple[Bags, list[tuple[set[str], set[str]]]]:
    """The sample's sentences over all features that any setting chooses; for each setting those of the inner part and of the whole."""
    whole = sample.groupBy("inner", "y").count().collect()
    n0, t0 = (sum(r["count"] for r in whole if not r["inner"] and (r["y"] or k == 0)) for k in (0, 1))
    n, t = (sum(r["count"] for r in whole if r["y"] or k == 0) for k in (0, 1))
    share, share0 = (t / n if n else 0.0), (t0 / n0 if n0 else 0.0)
    z = "abs({t} - {n} * {s}D) / nullif(sqrt({n} * {s}D * {r}D), 0D)"
    strong = [f"{z.format(t=a, n=b, s=repr(s), r=repr(1 - s))} > {LEAST_Z}D" for a, b, s in (("t", "n", share), ("t0", "n0", share0)) if 0 < s < 1]
    counts = [tuple(r) for r in feature_counts(sample).where(" OR ".join(strong)).collect()] if strong else []
    both = [(chosen([(f, a, b) for f, a, b, _, _ in counts], n0, t0, x), chosen([(f, a, b) for f, _, _, a, b in counts], n, t, x)) for x, _ in SETTINGS]
    names = sorted(set().union(*[x for pair in both for x in pair]))
    at = {f: k for k, f in enumerate(names)}

    def run(texts: list[str | None]) -> list[list]:
        return [[[sorted({at[x] for w in s for x in features(w) if x in at}) for s in sentence_words(t)] for t in texts]]

    rows = added(sample.select("_id", "y", "inner", "text"), ["text"], "s array<array<int>>", run).collect()
    rows.sort(key=lambda r: r["_id"])
    return Bags(names, [r["y"] for r in rows], [r["inner"] for r in rows], [r["s"] for r in rows]), both


def fit(sample: DataFrame) -> NoisyOr:
    """sample: _id, y, text of the training documents. The setting is chosen on the inner fold, then fitted to all of them."""
    sample = sample.withColumn("inner", F.pmod(F.xxhash64(F.lit("inner"), "_id"), F.lit(INNER)) == 0)
    bags, both = bags_of(sample)
    mask = lambda some: np.fromiter((f in some for f in bags.names), bool, len(bags.names))
    if not bags.names:
        return NoisyOr({}, bags.prior())
    losses = []
    for (inside, _), (_, penalty) in zip(both, SETTINGS, strict=True):
        w, b = bags.fit(mask(inside), penalty, ~bags.inner)
        losses.append(bags.loss(w, b, bags.inner) if bags.inner.any() else 0.0)
    best = int(np.argmin(losses))
    w, b = bags.fit(mask(both[best][1]), SETTINGS[best][1], np.ones(len(bags.y), bool))
    return NoisyOr({x: float(v) for x, v in zip(bags.names, w, strict=True) if abs(v) > LEAST_WEIGHT}, b)


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> NoisyOr:
    """Fits from at most `most` labelled documents outside the held-out fold; of an id that repeats, its greatest text."""
    ids = sample_labels(labels, "toxic", FOLDS, HELD_OUT, most)
    rows = docs.join(F.broadcast(ids), docs["doc_id"] == ids["_id"]).groupBy("_id", "y").agg(F.max(docs["text"].cast("string")).alias("text"))
    return fit(stored(rows, "toxicity-sample"))


def scored(docs: DataFrame, model: NoisyOr, keys: list[str]) -> DataFrame:
    """keys, score, and offending: the offending sentences (start, end, p), ends exclusive."""

    def run(texts: list[str | None]) -> list[list]:
        read = [model.read(t) for t in texts]
        return [[s for s, _ in read], [[{"start": a, "end": b, "p": p} for a, b, p in found] for _, found in read]]

    return added(docs.select(*keys, docs["text"].cast("string").alias("_text")), ["_text"], "score double, offending array<struct<start: bigint, end: bigint, p: double>>", run)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document, the number of offending sentences and their places (start:end, comma-joined)."""
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    out = scored(docs, model, ["doc_id"])
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    places = F.array_join(F.transform("offending", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("offending").cast("long").alias("n_offending"), places.alias("offending"))
