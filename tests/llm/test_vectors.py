"""Vector codes and exact search against SQL and loops, on edge rows."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import queries, vector_codes, vector_search

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_exact_top_k"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda d: sorted(map(tuple, d[sorted(d.columns)].astype(object).values.tolist()))
    assert rows(got) == rows(want) and len(got) > 40


def whole(v, scale, most):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [max(-most, min(most, math.floor(scale * x))) for x in v]


def vectors(seed: int, n: int, size: int) -> list[tuple]:
    """Ties, equal rows, repeated and null ids, and every kind of vector that takes no part."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        v = [rng.choice([0.0, 0.5, -0.25, 1.0, rng.random()]) for _ in range(size)]
        v = {7: None, 8: [None, *v[1:]], 9: [float("nan"), *v[1:]], 10: v[:-1], 11: [], 13: [float("-inf"), *v[1:]]}.get(k % 50, v)
        rows.append((k if k % 40 else k // 2, v, k % 5 or None, "x"))
    return rows + [(None, [1.0] * size, 1, "y")] * 3 + [(100, [1.0] * size, 2, "y")] * 4 + [(200, [0.0] * size, 2, None)] * 2


SCHEMA = "vec_id long, embedding array<double>, label int, code string"


@pytest.mark.parametrize(("k", "tile", "fan", "queries"), [(1, 1024, 16, 65536), (4, 7, 2, 3), (10, 1024, 2, 65536)])
def test_search_equals_loop(spark, monkeypatch, k, tile, fan, queries):
    monkeypatch.setattr(vector_search, "TILE", tile)
    monkeypatch.setattr(vector_search, "FAN", fan)
    monkeypatch.setattr(vector_search, "QUERIES", queries)
    # sums beyond 2^53 and beyond a long
    rows = vectors(1, 600, 3) + [(700, [1e12, 1e11, -3e12], 1, ""), (701, [4e5, 3e12, -1e9], 1, ""), (702, [1e30, 0.1, -1e15], 1, "")]
    top = (1 << 63) - 1
    known = [(i, w) for i, v, *_ in rows if (w := whole(v, 1024, 2**62)) is not None]
    want = []
    asked = {}
    for q, v in {(i, tuple(v)) for i, v in known if i is not None and i % 100 == 0}:
        asked.setdefault(q, []).extend((-max(-top, min(top, sum(map(int.__mul__, v, w)))), j is None, j or 0) for j, w in known if j != q and len(w) == len(v))
    for q, found in asked.items():
        want += [(q, r + 1, None if unknown else j, -s) for r, (s, unknown, j) in enumerate(sorted(found)[:k])]
    got = vector_search.top_k(spark.createDataFrame(rows, SCHEMA).repartition(5), "vec_id % 100 = 0", k)
    key = lambda r: r[:2]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key) and len(want) >= 4 * k


def test_search_on_edges(spark):
    d = spark.createDataFrame([(0, [1.0], 1, ""), (100, [2.0], 1, "")], SCHEMA)
    assert [tuple(r) for r in vector_search.top_k(d, "vec_id = 0").collect()] == [(0, 1, 100, 2048 * 1024)]
    for none in (vector_search.top_k(d.limit(0), "true"), vector_search.top_k(d, "false"), vector_search.top_k(d.limit(1), "true")):
        assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0


def lloyd(rows: list[tuple], size: int, rounds: int) -> tuple[dict, str]:
    """Codes and errors by place of row, and the digest of the codebooks, by comparing everything in every round."""
    known = [(k, i, v, w) for k, (i, v, *_) in enumerate(rows) if (w := whole(v, 256, int(2**30 / size**0.5))) is not None and len(w) == size]
    first = [w for _, i, v, w in sorted((x for x in known if x[1] is not None), key=lambda x: (x[1], x[2]))[:64]]
    part = lambda w, p: w[p * size // 16 : (p + 1) * size // 16]
    books = [[part(w, p) for w in first] for p in range(16)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda w, p: min((dist(part(w, p), b), e) for e, b in enumerate(books[p]))
    for _ in range(rounds):
        mine = [[[] for _ in b] for b in books]
        for *_, w in known:
            for p in range(16):
                mine[p][near(w, p)[1]].append(part(w, p))
        books = [[[sum(c) // len(m) for c in zip(*m, strict=True)] if m else b for m, b in zip(ms, bs, strict=True)] for ms, bs in zip(mine, books, strict=True)]
    out = {k: [near(w, p) for p in range(16)] for k, _, _, w in known}
    text = ",".join(str(x) for b in books for e in b for x in e)
    return {k: ("".join(f"{e:02x}" for _, e in n), sum(d for d, _ in n)) for k, n in out.items()}, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("n", "rounds", "block"), [(400, 2, 32768), (400, 3, 50), (30, 2, 7)])
def test_codes_equal_loop(spark, monkeypatch, n, rounds, block):
    monkeypatch.setattr(vector_codes, "ROWS", block)
    rows = vectors(2, n, 32) + [(5000, [1e9] * 32, 3, "far"), (5001, [0.3] * 16, None, "short"), (5002, [-2.0] * 32, 3, "z")]
    rows = [(i, v, lab, f"{c}{k}") for k, (i, v, lab, c) in enumerate(rows)]
    codes, digest = lloyd(rows, 32, rounds)
    sound = [k for k, (_, v, *_) in enumerate(rows) if whole(v, 256, 1) is not None]
    totals = {lab: sum(codes[k][1] for k in sound if k in codes and rows[k][2] == lab) for lab in {r[2] for r in rows}}
    want = sorted((rows[k][0] or -1, rows[k][3], *(codes.get(k) or (None, None)), totals[rows[k][2]]) for k in sound)
    # a column named like an internal one stays, one named like a result is replaced
    d = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("code", "c0").withColumn("error", F.lit("old"))
    got = vector_codes.compress(d.repartition(3), rounds=rounds)
    assert got.columns == ["vec_id", "label", "c0", "code", "error", "label_error", "codebooks_sha256"]
    found = got.collect()
    assert {r.codebooks_sha256 for r in found} == {digest}
    assert sorted((r.vec_id or -1, r.c0, r.code, r.error, r.label_error) for r in found) == want


def test_codes_on_edges(spark):
    d = spark.createDataFrame(vectors(3, 60, 16), SCHEMA)
    assert vector_codes.compress(d.limit(0)).count() == 0
    alone = vector_codes.compress(spark.createDataFrame([(None, [1.0] * 16, None, ""), (1, None, 2, "")], SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error) for r in alone] == [(None, None, None)]
    one = vector_codes.compress(spark.createDataFrame([(1, [1.0] * 16, None, "")], SCHEMA)).first()
    assert (one.code, one.error, one.label_error) == ("00" * 16, 0, 0)


def test_later_rounds_look_at_few_parts():
    """When entries hardly move, only parts between two entries are popped."""
    rng = np.random.default_rng(1)
    books = rng.integers(-1000, 1000, (16, 64, 4))
    near = books[:, rng.integers(0, 64, 2000)].transpose(1, 0, 2) + rng.integers(-5, 6, (2000, 16, 4))
    block = vector_codes.Block(near.astype(np.int64), 64)
    block.fill(books)
    before = block.codes()
    seen = block.adjust(books + 1, np.full((16, 64), 4.0))
    assert seen < 0.05 * near[:, :, 0].size and (block.codes() == before).mean() > 0.99
    assert (block.codes() == np.stack([vector_codes.nearest(block.vectors[:, p], (books + 1)[p])[0] for p in range(16)], axis=1)).all()
    assert block.sums[:, :, -1].sum() == 2000 * 16
