"""Alignment of two tokenizers' tokens over texts, by distinct segments.

A text with a space in front is cut before white space where neither vocabulary can merge across. The byte-level
vocabulary A cuts before every run of white space that follows something else, by its own pattern. For the piece
vocabulary B it is verified when its file is loaded: no piece has a space after another character, so a space is such a
place; another white-space character is one if no piece has it behind its first place. A run that doesn't begin with a
verified character isn't cut. Both tokenizers give the same tokens for a segment alone and in its text, so tokens, groups
and links of a text are those of its segments in order.

Texts are read by blocks of bounded size. A block keeps each of its distinct segments once, and its texts as numbers of
segments. All blocks' segments are sorted together, so that equal ones follow each other and are tokenised and aligned
once, in bounded memory. Links of id pairs are counted over distinct segments, weighted by how often these occur. Then
every alignment goes back to the blocks that hold its segment, packed by block, and every block composes its documents.
A frequent word is one row for each block. Id pairs with their counts go to the tasks as sorted arrays if they are at
most PAIRS, which is counted; beyond that they are joined by a shuffle.

Groups are what lies between two byte offsets at which tokens of both end; a link is a pair of an A token and a B token
that end together. Texts that are null, empty or hold a character that B doesn't give back (U+2581) have no tokens, and count for
nothing: zeros and an empty text of groups. Every segment's bytes are compared with its tokens'. B must normalise nothing,
else its file is refused. Very long words are long segments. Rows that repeat count each; extra columns stay, in front of the new
ones, which replace columns of their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.llm.bpe import byte_characters, vocabulary_path
from shelfmark.llm.common import batches, discard, documents, stored

VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Characters of texts in a block; segments tokenised together and alignments packed together; id pairs that are broadcast.
BLOCK, TOGETHER, PAIRS = 1 << 25, 20_000, 2_000_000
#: White space that a text may be cut before, if verified; the piece vocabulary's space.
CUTS, MARK = " \t\n\v\f\r", "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
BLOCKS = "block long, rest binary, numbers binary, ends binary, segments array<string>, counts array<long>"
ALIGNED = "id long, n long, n_a int, n_b int, groups string, a array<int>, b array<int>, blocks array<long>, places array<int>"
PACKED = "of long, n int, numbers binary, size int, groups binary"


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and where texts may be cut."""

    def __init__(self, a: str, b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        with open(a, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{a}: a byte-level vocabulary with its pattern and without a normaliser is needed")
        model = sentencepiece_model_pb2.ModelProto()
        with open(b, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{b}: a vocabulary that changes no text, adds a space and falls back to bytes is needed")
        plain = byte_characters()
        self.a_bytes = self.table({i: bytes(plain[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in plain for c in t)})
        self.b_bytes = self.table({i: bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else p.piece.replace(MARK, " ").encode() for i, p in enumerate(model.pieces)})
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(MARK)
        pieces = [p.piece for p in model.pieces if p.type in (p.NORMAL, p.USER_DEFINED)]
        crossed = {w for w in CUTS[1:] if any(w in p[1:] for p in pieces)}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            crossed.add(" ")
        self.cuts = [w for w in CUTS if w not in crossed]
        free = re.escape("".join(self.cuts))
        #: A run of white space and what follows up to the next place to cut.
        self.pattern = (rf"\s+\S*(?:[^\S{free}]\s*\S*)*" if free else r"(?s:.+)")

    @staticmethod
    def table(tokens: dict[int, bytes]) -> list[bytes]:
        return [tokens.get(k, b"") for k in range(max(tokens) + 1)]

    def tokens(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of segments that begin with white space; the space that B adds goes again."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return a, [ids[1:] if s[0] != " " else ids or [self.space] for s, ids in zip(segments, b, strict=True)]

    def align(self, segments: list[str]) -> Iterator[tuple]:
        """Of each segment: numbers of tokens of A and of B, the text of its groups, and the ids of A and B tokens that end together."""
        a, b = self.tokens(segments)
        for s, x, y in zip(segments, a, b, strict=True):
            raw = s.encode()
            if b"".join([self.a_bytes[i] for i in x]) != raw or b"".join([self.b_bytes[i] for i in y]) != raw:
                raise ValueError(f"tokens don't give the bytes of {s[:100]!r}")
        n_a, n_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (a, b))
        flat_a, flat_b = (np.fromiter((i for t in ids for i in t), np.int64, int(n.sum())) for ids, n in ((a, n_a), (b, n_b)))
        # segments lie one after the other, with the same bytes for both
        end_a, end_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        both, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        of = np.searchsorted(end_a[np.cumsum(n_a) - 1], both)
        ends = np.cumsum(np.bincount(of, minlength=len(segments))).tolist()
        text_a, text_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        groups, p, q = [], 0, 0
        for i, j in zip((at_a + 1).tolist(), (at_b + 1).tolist(), strict=True):
            groups.append(",".join(text_a[p:i]) + "|" + ",".join(text_b[q:j]))
            p, q = i, j
        last_a, last_b = flat_a[at_a].astype(np.int32), flat_b[at_b].astype(np.int32)
        for x, y, s, e in zip(n_a.tolist(), n_b.tolist(), [0, *ends], ends, strict=False):
            yield x, y, ";".join(groups[s:e]), last_a[s:e], last_b[s:e]


@lru_cache(maxsize=1)
def vocabularies(a: str, b: str) -> Vocabularies:
    return Vocabularies(a, b)


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length byte by byte, all first bytes first, compressed."""
    return pa.compress(b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays), codec="zstd", asbytes=True)


def restored(raw: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize * n for k in kinds]
    flat = np.frombuffer(pa.decompress(raw, sum(sizes), codec="zstd"), np.uint8)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    return [np.ascontiguousarray(p.reshape(np.dtype(k).itemsize, n).T).view(k).ravel() for p, k in zip(parts, kinds, strict=True)]


class Cutter:
    """Blocks of texts: distinct segments, and texts as numbers of segments."""

    def __init__(self, pattern: str):
        self.split = re.compile(pattern).findall
        self.clear()

    def clear(self) -> None:
        self.rests: list[pa.RecordBatch] = []
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        found = self.split(" " + text) if text and MARK not in text else []
        self.numbers.append(np.fromiter(map(self.known.__getitem__, found), np.int32, len(found)))
        self.size += len(text or "")

    def block(self, number: int) -> pa.RecordBatch:
        table, sink = pa.Table.from_batches(self.rests), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        flat = np.concatenate(self.numbers)
        ends = np.cumsum([len(x) for x in self.numbers], dtype=np.int64)
        columns = [[number], [sink.getvalue().to_pybytes()], [squeezed(flat)], [ends.tobytes()]]
        lists = [pa.array(list(self.known), pa.string()), pa.array(np.bincount(flat, minlength=len(self.known)))]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 3), strict=True)]
        whole = pa.array([0, len(self.known)], pa.int32())
        return pa.RecordBatch.from_arrays([*arrays, *[pa.ListArray.from_arrays(whole, x) for x in lists]], names=["block", "rest", "numbers", "ends", "segments", "counts"])


def cut(docs: DataFrame, pattern: str) -> DataFrame:
    """docs, whose last column is the text, as blocks."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, number = Cutter(pattern), TaskContext.get().partitionId() << 32
        for part in parts:
            texts, begun = part.column(part.num_columns - 1).to_pylist(), 0
            others = part.select(list(range(part.num_columns - 1)))
            for k, text in enumerate(texts):
                cutter.add(text)
                if cutter.size >= BLOCK:
                    cutter.rests.append(others.slice(begun, k + 1 - begun))
                    yield cutter.block(number)
                    cutter.clear()
                    number, begun = number + 1, k + 1
            if begun < len(texts):
                cutter.rests.append(others.slice(begun))
        if cutter.numbers:
            yield cutter.block(number)

    return docs.mapInArrow(run, BLOCKS)


def aligned(segments: DataFrame, a: str, b: str) -> DataFrame:
    """Alignments of segments (segment, n, block, place), of which equal ones follow each other: one for each run of equal ones in a batch."""
    arrow = to_arrow_schema(StructType.fromDDL(ALIGNED))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, last = vocabularies(a, b), TaskContext.get().partitionId() << 33, (None, None)
        for part in (p.slice(at, TOGETHER) for p in parts for at in range(0, len(p), TOGETHER)):
            texts = part.column(0).to_pylist()
            begins = [k for k, s in enumerate(texts) if not k or s != texts[k - 1]]
            distinct = [texts[k] for k in begins]
            again = distinct[0] == last[0]
            found = [*([last[1]] if again else []), *(known.align(distinct[again:]) if len(distinct) > again else [])]
            last = (distinct[-1], found[-1])
            n_a, n_b, groups, of_a, of_b = zip(*found, strict=True)
            ends = np.array([*begins, len(texts)], np.int32)
            n = np.add.reduceat(part.column(1).to_numpy(), ends[:-1])
            sizes = np.cumsum([0, *map(len, of_a)]).astype(np.int32)
            links = [pa.ListArray.from_arrays(sizes, np.concatenate(x)) for x in (of_a, of_b)]
            at = [pa.ListArray.from_arrays(ends, part.column(k)) for k in (2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + len(begins))), pa.array(n), pa.array(n_a, pa.int32()), pa.array(n_b, pa.int32()), pa.array(groups, pa.string()), *links, *at], schema=arrow)
            number += len(begins)

    return segments.mapInArrow(run, ALIGNED)


def scored(found: DataFrame, links: DataFrame) -> tuple[DataFrame, Broadcast | None]:
    """found and the broadcast pairs in order, with their links and whether they are the best of their B id; or found with n_best and
    count_sum, and None, if there are too many pairs."""
    pairs = stored(links.groupBy("a", "b").agg(F.sum("n").alias("links")), "pairs")
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))  # at most one row for each id of B
    ranked = pairs.join(F.broadcast(most), "b").select("a", "b", "links", (F.col("links") == F.col("most")).cast("int").alias("best"))
    if pairs.limit(PAIRS + 1).count() > PAIRS:
        sums = links.join(ranked, ["a", "b"]).groupBy("id").agg(F.sum("best").alias("n_best"), F.sum("links").alias("count_sum"))
        return found.join(sums, "id"), None
    table = ranked.toArrow()
    discard(pairs)
    code = table["a"].to_numpy().astype(np.int64) << 32 | table["b"].to_numpy()
    order = np.argsort(code)
    sent = (code[order], table["links"].to_numpy()[order], table["best"].to_numpy().astype(np.int8)[order])
    return found, found.sparkSession.sparkContext.broadcast(sent)


def packed(found: DataFrame, pairs: Broadcast | None) -> DataFrame:
    """What alignments give to each block, packed: places, counts and groups of its segments."""

    def sums(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        if pairs is None:
            return part.column("n_best").to_numpy(), part.column("count_sum").to_numpy()
        code, links, best = pairs.value
        a, b = part.column("a"), part.column("b")
        at = np.searchsorted(code, a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy())
        begins = a.offsets.to_numpy()[:-1] - a.offsets[0].as_py()
        return np.add.reduceat(best[at], begins, dtype=np.int64), np.add.reduceat(links[at], begins)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not len(part):
                continue
            of, place = part.column("blocks"), part.column("places").flatten().to_numpy()
            row, block = np.repeat(np.arange(len(part)), of.value_lengths().to_numpy()), of.flatten().to_numpy()
            n_links = part.column("a").value_lengths().to_numpy()
            n_best, count_sum = sums(part)
            values = [part.column("n_a").to_numpy(), part.column("n_b").to_numpy(), n_links.astype(np.int32), n_best.astype(np.int32), count_sum]
            groups = part.column("groups").to_pylist()
            order = np.argsort(block, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                r = row[some]
                text = "\n".join([groups[k] for k in r.tolist()]).encode()
                columns = [[block[some[0]]], [len(some)], [squeezed(place[some], *[v[r] for v in values])], [len(text)], [pa.compress(text, codec="zstd", asbytes=True)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()), strict=True)], names=["of", "n", "numbers", "size", "groups"])

    wide = [c for c in ("n_a", "n_b", "groups", "a", "b", "n_best", "count_sum", "blocks", "places") if c in found.columns]
    return found.select(*wide).mapInArrow(run, PACKED)


def composed(blocks: DataFrame, parts: DataFrame, schema: StructType, digest: bool) -> DataFrame:
    """The documents of every block: sums over their segments, and their groups in order."""
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.to_pylist()[0]
        size = sum(right["n"].to_pylist())
        values, texts = [np.zeros(size + 1, np.int64) for _ in range(5)], [""] * size
        for p in right.to_batches():
            for n, raw, length, groups in zip(*[p.column(c).to_pylist() for c in ("n", "numbers", "size", "groups")], strict=True):
                place, *found = restored(raw, n, *[np.int32] * 5, np.int64)
                for v, x in zip(values, found, strict=True):
                    v[place + 1] = x
                for k, g in zip(place.tolist(), pa.decompress(groups, length, codec="zstd", asbytes=True).decode().split("\n"), strict=True):
                    texts[k] = g
        ends = np.frombuffer(left["ends"], np.int64)
        begins = np.concatenate([[0], ends[:-1]])
        (numbers,) = restored(left["numbers"], int(ends[-1]), np.int32)
        sums = []
        for v in values:
            total = np.concatenate([[0], np.cumsum(v[numbers + 1])])
            sums.append(pa.array(total[ends] - total[begins]))
        groups = (";".join(map(texts.__getitem__, numbers[s:e].tolist())) for s, e in zip(begins.tolist(), ends.tolist(), strict=True))
        last = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups] if digest else list(groups), pa.string())
        n_a, n_b, n_links, n_best, count_sum = sums
        rest = pa.ipc.open_stream(left["rest"]).read_all()
        return pa.Table.from_arrays([*rest.columns, n_a, n_b, n_links, n_links, n_best, count_sum, last], schema=arrow)

    return blocks.select("block", "rest", "numbers", "ends").groupBy("block").cogroup(parts.groupBy("of")).applyInArrow(run, schema)


def align(docs: DataFrame, a: str, b: str, text: str = "text", digest: bool = False) -> DataFrame:
    """docs without the text, plus n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2`; with digest, groups_sha256).

    n_best: links whose id pair is linked most often among all pairs of its B id, ties included; count_sum: how often the
    links' pairs are linked in all texts. a, b: files of a byte-level and a piece vocabulary that every executor has.
    """
    spark = docs.sparkSession
    batches(spark)
    last = "groups_sha256" if digest else "groups"
    kept = [c for c in docs.columns if c not in (text, *COUNTS, last)]
    inner = [f"c{k}" for k in range(len(kept))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(kept, inner, strict=True)], docs[text].cast("string").alias("text"))
    blocks = stored(cut(rows, vocabularies(a, b).pattern), "blocks")
    segments = blocks.select("block", F.posexplode(F.arrays_zip("segments", "counts")).alias("place", "s")).select(F.col("s.segments").alias("segment"), F.col("s.counts").alias("n"), "block", "place")
    found = stored(aligned(segments.repartition("segment").sortWithinPartitions("segment"), a, b), "alignments")
    links = found.select("id", "n", F.explode(F.arrays_zip("a", "b")).alias("l")).select("id", "n", "l.a", "l.b")
    schema = StructType([*(rows.schema[n] for n in inner), *StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS) + f", {last} string")])
    out = composed(blocks, packed(*scored(found, links)), schema, digest)
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, kept, strict=True)], *COUNTS, last)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document."""
    a, b = map(vocabulary_path, VOCABULARIES)
    return align(documents(spark, sf_dir).select("doc_id", "text"), a, b, digest=True)
