"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two first-order models over characters are trained: one on random strings of the alphabets keys are made of (drawn from
a seeded generator, so labelled by construction), one on labelled ordinary identifiers: words of a bounded sample of the
corpus and of code in the ways names are built from them, numbers and dates. Runs of [A-Za-z0-9+/_=-] are cut where a
fixed pattern matched; a part of MIN_RUN characters or more is a secret if its log-likelihood ratio exceeds a threshold,
the larger of two: at most MAX_FALSE of held-out identifiers reach it, and at most MAX_MISSED of held-out random strings
stay below it. Shorter parts carry too little evidence for these rates. The method only adds spans; the patterns' stay.

Null text counts as empty and has no spans; empty tables train on the generator and built-in words alone. Repeated rows
each get their spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm.common import added, documents

#: The patterns of the contract, in their order, with the group and length that count.
PATTERNS = [
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    # the leftmost run of 16 or more is a whole run, as runs are maximal
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
]
KINDS = [p[0] for p in PATTERNS] + ["random"]
MIN_RUN, MAX_FALSE, MAX_MISSED = 16, 1e-4, 0.02
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
#: Bounds of the sample: documents read and different words taken from them (both by least hash), strings drawn of either kind.
SAMPLE_DOCS, SAMPLE_WORDS, SAMPLE_RANDOM, SAMPLE_NAMES, SEED = 2_000, 20_000, 12_000, 80_000, 7
#: Alphabets of random strings.
ALPHABETS = [string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_uppercase + "234567", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_"]
#: Words that names in code are built from (fixed sample of ordinary identifiers).
CODE_WORDS = (
    "get set add read write user name account list index value count max min size time date file path url http https www com org net example project service config configuration manager handler client server request response error exception timeout retry "
    "connection pool test integration pipeline build release version data table column row key item object factory builder interface implementation internal external access permission image video audio main default update delete create select where order group "
    "html css js json xml utf ascii src lib bin include node module package import export class function return string integer boolean array map filter reduce the and for with from this that"
).split()
_SYMBOLS = {c: k for k, c in enumerate(string.ascii_letters + string.digits + "+/_=-")}
_OTHER = len(_SYMBOLS)


def codes(text: str) -> np.ndarray:
    return np.fromiter((_SYMBOLS.get(c, _OTHER) for c in text), np.int64, len(text))


class RandomnessModel:
    """Log-likelihood ratio of random against ordinary strings. Of either kind, half the strings train and half set the threshold."""

    def __init__(self, random_strings: list[str], ordinary: list[str]):
        self.ratio = self.table(random_strings[::2]) - self.table(ordinary[::2])
        self.threshold = max(self.quantile(ordinary[1::2], 1 - MAX_FALSE), self.quantile(random_strings[1::2], MAX_MISSED))

    def quantile(self, strings: list[str], share: float) -> float:
        scores = sorted(self.score(s) for s in strings if len(s) >= MIN_RUN)
        return scores[min(len(scores) - 1, int(np.ceil(len(scores) * share)))]

    @staticmethod
    def table(samples: list[str]) -> np.ndarray:
        counts = np.full((_OTHER + 1, _OTHER + 1), 0.1)
        for s in samples:
            c = codes(s)
            np.add.at(counts, (c[:-1], c[1:]), 1.0)
        # transitions share strength with the overall frequencies
        overall = counts.sum(axis=0) / counts.sum()
        counts += 5 * overall
        return np.log(counts / counts.sum(axis=1, keepdims=True))

    def score(self, s: str) -> float:
        c = codes(s)
        return float(self.ratio[c[:-1], c[1:]].sum())

    def is_random(self, s: str) -> bool:
        return self.score(s) > self.threshold


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, each kind leftmost and non-overlapping."""
    return [(m.start(), m.end(), k) for k, (_, pattern, group, least) in enumerate(PATTERNS) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def drawn_strings(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randrange(MIN_RUN, 64))) for _ in range(n)]


def ordinary_names(rng: random.Random, words: list[str], n: int) -> list[str]:
    """Names in the usual ways: joined words in every case, numbered, dated, plain numbers, rules of one character, the alphabet."""
    cases = [str.lower, str.upper, str.capitalize, lambda w: w[:1].lower() + w[1:]]
    out = []
    for _ in range(n):
        kind, case = rng.random(), rng.choice(cases)
        if kind < 0.85:
            name = rng.choice(["", "_", "-", "/", "=", "--", "+"]).join(case(w) for w in rng.choices(words, k=rng.randrange(2, 7)))
            out.append(name + rng.choice(["", "", "", str(rng.randrange(10)), str(rng.randrange(2100)), f"-{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"]))
        elif kind < 0.97:
            out.append(rng.choice(["", "-", "/"]).join(str(rng.randrange(10 ** rng.randrange(1, 7))) for _ in range(rng.randrange(3, 8))))
        elif kind < 0.98:
            out.append(rng.choice("-=_+/x0") * rng.randrange(MIN_RUN, 80))
        else:
            row = rng.choice([string.ascii_lowercase, string.ascii_uppercase, string.digits]) * 3
            out.append(row[(k := rng.randrange(26)) : k + rng.randrange(MIN_RUN, 40)])
    return out


def words_of(docs: DataFrame, most_docs: int, most_words: int) -> list[str]:
    """Different words of a sample of documents in which no fixed pattern matches."""
    some = docs.select("doc_id", F.col("text").cast("string").alias("_text")).where("doc_id IS NOT NULL")
    ids = some.select(F.col("doc_id").alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(most_docs).distinct()
    found = added(some.join(F.broadcast(ids), some["doc_id"] == ids["_id"]).select("_text"), ["_text"], "words array<string>", lambda texts: [[sorted(set(re.findall(r"[A-Za-z]{2,}|[0-9]+", t))) if t and not base_spans(t) else [] for t in texts]])
    rows = found.select(F.explode("words").alias("w")).distinct().orderBy(F.xxhash64("w"), "w").limit(most_words).collect()
    return sorted(r[0] for r in rows)


def train(docs: DataFrame, most_docs: int = SAMPLE_DOCS, most_words: int = SAMPLE_WORDS) -> RandomnessModel:
    """Fits both models on the driver from words of at most most_docs documents, at most most_words of them."""
    rng = random.Random(SEED)
    words = words_of(docs, most_docs, most_words)
    pick = CODE_WORDS + words if len(words) < len(CODE_WORDS) else CODE_WORDS * (len(words) // len(CODE_WORDS)) + words
    return RandomnessModel(drawn_strings(rng, SAMPLE_RANDOM), ordinary_names(rng, pick, SAMPLE_NAMES))


def spans(text: str, model: RandomnessModel) -> list[tuple[int, int, int]]:
    """Base spans and those the model adds beside them, by start, then kind."""
    found = sorted(base_spans(text), key=lambda x: (x[0], x[2]))
    more = []
    for m in RUN.finditer(text):
        at = m.start()
        for start, end, _ in [*found, (m.end(), m.end(), 0)]:
            if end > at and start <= m.end():
                if start - at >= MIN_RUN and model.is_random(text[at:start]):
                    more.append((at, start, len(PATTERNS)))
                at = max(at, end)
    return sorted(found + more, key=lambda x: (x[0], x[2]))


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)


def scan(docs: DataFrame, model: RandomnessModel, keys: list[str]) -> DataFrame:
    """keys and found: an array of (kind, start, end) for every row of docs."""

    def run(texts: list[str | None]) -> list[list]:
        return [[[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans(t or "", model)] for t in texts]]

    return added(docs.select(*keys, docs["text"].cast("string").alias("_text")), ["_text"], "found array<struct<kind: string, start: bigint, end: bigint>>", run)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document."""
    docs = documents(spark, sf_dir)
    model = train(docs)

    def run(texts: list[str | None]) -> list[list]:
        found = [spans(t or "", model) for t in texts]
        base = [[x for x in g if x[2] < len(PATTERNS)] for g in found]
        return [*([sum(x[2] == k for x in g) for g in base] for k in range(len(PATTERNS))), [hashlib.sha256(written(g).encode()).hexdigest() for g in base], [written(g) for g in found]]

    return added(docs.selectExpr("doc_id", "cast(text AS string) AS text"), ["text"], "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", run)
