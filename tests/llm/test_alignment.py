"""The alignment of two tokenizers against whole texts tokenised by the libraries."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from shelfmark.llm import alignment
from shelfmark.llm.bpe import byte_characters, vocabulary_path

PATHS = tuple(map(vocabulary_path, alignment.VOCABULARIES))
#: Every kind of white space, letters that need bytes, strings of special tokens, the piece vocabulary's own mark.
ALPHABET = [" ", "  ", "\n", "\t", "\r", "\r\n", "\x0b", "\xa0", " ", "\x1c", "\x85", "a", "b", "the", "The", " of", "'s", "'t", "12", "é", "é", "ﬁ", "漢", "🙂", "<s>", "<0x0A>", "<|endoftext|>", "▁", "\x00", ".", "...", "_", "{", "}", ";", "​"]


def by_hand(docs: list[tuple]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    plain = byte_characters()
    of_a = {i: bytes(plain[c] for c in t) for t, i in a.get_vocab().items() if all(c in plain for c in t)}
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out, links = [], Counter()
    for d, t in docs:
        x, y, raw = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t), (" " + t).encode()) if t else ([], [], b"")
        if not t or b"".join(of_a[i] for i in x) != raw or b"".join(map(of_b, y)) != raw:
            out.append((d, [], [], [], []))
            continue
        ends = [{}, {}]
        for k, (ids, size) in enumerate(((x, of_a.get), (y, of_b))):
            at = 0
            for n, i in enumerate(ids):
                at += len(size(i))
                ends[k][at] = n + 1
        groups, pairs, p, q = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][e], ends[1][e]
            groups.append(",".join(map(str, x[p:i])) + "|" + ",".join(map(str, y[q:j])))
            pairs.append((x[i - 1], y[j - 1]))
            p, q = i, j
        links.update(pairs)
        out.append((d, x, y, groups, pairs))
    best = defaultdict(int)
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    return sorted((d, len(x), len(y), len(g), len(p), sum(links[z] == best[z[1]] for z in p), sum(links[z] for z in p), ";".join(g)) for d, x, y, g, p in out)


def digest(row: tuple) -> tuple:
    return (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")


def test_op12_equals_whole_texts(spark):
    got = alignment.op12_token_alignment(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", *alignment.COUNTS, "groups_sha256"]
    want = list(map(digest, by_hand(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())))
    assert sorted(map(tuple, got.collect())) == want and len(want) == 200


@pytest.mark.parametrize(("block", "pairs"), [(1 << 25, 2_000_000), (300, 0)])
def test_odd_texts_equal_whole_texts(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    rng = random.Random(3)
    docs = [(k, "".join(rng.choices(ALPHABET, k=rng.randrange(0, 14)))) for k in range(1500)]
    docs += [(9000, None), (9001, ""), (9002, " "), (9003, "\n"), (9004, "x " * 5000), (9005, "word" * 20_000), (9006, "a b"), (9006, "a b"), (2**60 + 1, "c")]
    got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), *PATHS)
    want = by_hand(docs)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[1] == 0 for r in want) > 100


def test_edges(spark):
    d = spark.createDataFrame([(None, "a b", "x", 1, 2), (2**60 + 1, None, None, None, 3)], "doc_id long, text string, groups string, c0 int, block int")
    got = alignment.align(d, *PATHS)
    assert got.columns == ["doc_id", "c0", "block", *alignment.COUNTS, "groups"]
    assert {(r.doc_id, r.c0, r.block, r.n_a) for r in got.collect()} == {(None, 1, 2, 2), (2**60 + 1, None, 3, 0)}
    assert alignment.align(d.limit(0), *PATHS).count() == 0
    assert alignment.align(d.select("text"), *PATHS).count() == 2


def test_only_verified_places_are_cut():
    known = alignment.vocabularies(*PATHS)
    assert " " in known.cuts and "\n" in known.cuts
    # pieces hold carriage returns behind other characters, so texts aren't cut before these
    split = re.compile(known.pattern).findall
    assert "\r" not in known.cuts and split(" a;\r b") == [" a;\r b"]
    assert split(" a b\n c\xa0d ") == [" a", " b", "\n c\xa0d", " "]
