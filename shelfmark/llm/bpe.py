"""Byte-level BPE encoding and decoding by speculate and verify.

A text is cut into pieces with the tokenizer's pattern. Each piece not met before is tokenised speculatively by greedy
longest match over the vocabulary. Every adjacent pair of proposed tokens is then checked for compatibility, all pairs
of all new pieces at once in arrays: a pair (a, b) is compatible if merging the bytes of a followed by b yields exactly
[a, b]. A token sequence whose adjacent pairs are all compatible is the result of BPE, as the first merge across a
boundary would already occur among that pair alone; so verified pieces need no merging. Only the pieces that fail are
merged exactly.

The check follows the merge trees of a and b downwards along their touching edges. Merges run in the order of their
ranks, as every merge makes a token that only later merges use. So two edge tokens x and y meet from the moment both
exist until the next merge of either side's edge, and the pair is incompatible if some such x and y merge before that.

Null text counts as empty: no tokens, and the decoded text is empty. The strings of special tokens within a text become
these tokens, as in the tokenizers library. Equal rows give equal results; extra columns are left alone.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import added, documents, free

#: The vocabulary of the contract, by its name among the public tokenizers.
VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a worker remembers at most; beyond that its memory starts anew. Results don't depend on it. A piece takes
#: about 230 bytes; the query alone has room for more than a stage among others.
MAX_PIECES, ALONE = 250_000, 700_000
#: Characters of texts whose new pieces are learnt together.
TOGETHER = 1 << 20
#: Longer pieces aren't remembered.
MAX_REMEMBERED = 64
#: Bytes up to which a piece is merged by scanning; the rank of a pair that doesn't merge.
SHORT, NEVER = 40, 1 << 60
NO_MERGE = (NEVER, -1)


def byte_characters() -> dict[str, int]:
    """The vocabulary's printable stand-in for every byte: bytes that print stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class BytePairCodec:
    """Encoder and decoder for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str, most: int = MAX_PIECES):
        import regex

        self.most = most
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = byte_characters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = {t: bytes(plain[c] for c in t) for t in spec["model"]["vocab"] if t not in self.specials}
        self.ids = {as_bytes[t]: i for t, i in spec["model"]["vocab"].items() if t in as_bytes}
        self.tokens = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.specials.items()}
        self.longest = max(map(len, self.ids))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (as_bytes[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.exact_pieces = 0
        self.plan_merges()

    def plan_merges(self) -> None:
        """Arrays over token ids: the two tokens it is merged from, the rank of that merge (-1 for bytes), and whether merging its
        bytes gives the token. Over merges: their pairs in order, with their ranks."""
        n = max(self.tokens) + 1
        self.left, self.right, self.rank = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        for (a, b), (rank, made) in self.merges.items():
            if self.rank[made] >= 0 or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError("merges must make each token once, of tokens made before")
            self.left[made], self.right[made], self.rank[made] = a, b, rank
        pairs = np.array([a << 20 | b for a, b in self.merges] or [-1], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.array([r for r, _ in self.merges.values()] or [NEVER], np.int64)[order]
        made = np.flatnonzero(self.rank >= 0)
        self.reached = np.zeros(n, bool)
        self.reached[[i for i, b in self.tokens.items() if len(b) == 1]] = True
        whole = dict(zip(made.tolist(), self.apart(self.left[made], self.right[made], skip=True).tolist(), strict=True))
        for t in made[np.argsort(self.rank[made])].tolist():
            self.reached[t] = whole[t] and self.reached[self.left[t]] and self.reached[self.right[t]]

    def apart(self, a: np.ndarray, b: np.ndarray, skip: bool = False) -> np.ndarray:
        """For every pair of tokens, whether merging the bytes of both leaves them as they are; with skip, whether it gives just these
        two before they merge with each other."""
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(x), NEVER), np.full(len(x), NEVER)
        fits, at = np.ones(len(x), bool), np.arange(len(x))
        while len(at):
            u, v = x[at], y[at]
            code = u << 20 | v
            k = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            merge = np.where(self.pairs[k] == code, self.pair_ranks[k], NEVER)
            # of equal merges the left one is first
            clash = (merge < until_x[at]) & (merge <= until_y[at]) & (merge < NEVER)
            if skip:
                clash[:], skip = False, False
            fits[at[clash]] = False
            ru, rv = self.rank[u], self.rank[v]
            down_y = rv >= ru
            on = ~clash & (np.maximum(ru, rv) >= 0)
            go_y, go_x = at[on & down_y], at[on & ~down_y]
            until_y[go_y], until_x[go_x] = self.rank[y[go_y]], self.rank[x[go_x]]
            y[go_y], x[go_x] = self.left[y[go_y]], self.right[x[go_x]]
            at = at[on]
        return fits

    def greedy(self, raw: bytes) -> list[int]:
        """Longest match from the left; every single byte is in the vocabulary."""
        whole = self.ids.get(raw)
        if whole is not None:
            return [whole]
        out, at, n = [], 0, len(raw)
        while at < n:
            end = min(n, at + self.longest)
            while (token := self.ids.get(raw[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def merged(self, raw: bytes) -> list[int]:
        """Exact BPE: the pair of lowest rank is merged first, the leftmost among equals. Short pieces are scanned for it;
        long ones use a heap over a linked list, n log n."""
        import heapq

        ids = [self.ids[raw[k : k + 1]] for k in range(len(raw))]
        n = len(ids)
        if n <= SHORT:
            get = self.merges.get
            ranks = [get(p, NO_MERGE) for p in zip(ids, ids[1:])]
            while ranks:
                low = min(ranks)
                if low is NO_MERGE:
                    break
                k = ranks.index(low)
                ids[k : k + 2] = [low[1]]
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = get((low[1], ids[k + 1]), NO_MERGE)
                if k:
                    ranks[k - 1] = get((ids[k - 1], low[1]), NO_MERGE)
            return ids
        after, before, merges = [*range(1, n), -1], [*range(-1, n - 1)], self.merges
        heap = [(m[0], k, ids[k], ids[k + 1], m[1]) for k in range(n - 1) if (m := merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j < 0 or ids[j] != b:
                continue
            ids[k], ids[j] = new, -1
            after[k] = nxt = after[j]
            if nxt >= 0:
                before[nxt] = k
                if m := merges.get((new, ids[nxt])):
                    heapq.heappush(heap, (m[0], k, new, ids[nxt], m[1]))
            if (p := before[k]) >= 0 and (m := merges.get((ids[p], new))):
                heapq.heappush(heap, (m[0], p, ids[p], new, m[1]))
        return [i for i in ids if i >= 0]

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Token ids of new pieces: speculation, one vectorised check of all adjacent pairs, exact merging of what fails."""
        pieces = list(pieces)
        raw = [p.encode() for p in pieces]
        guess = [self.greedy(b) for b in raw]
        sizes = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter((t for g in guess for t in g), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(guess)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.empty(0, np.int64)
        distinct, which = np.unique(flat[inner] << 20 | flat[inner + 1], return_inverse=True)
        ok = self.apart(distinct >> 20, distinct & 0xFFFFF)
        bad = np.zeros(len(guess), bool)
        bad[owner[inner[~ok[which]]]] = True
        # every proposed token must also be what merging its own bytes gives
        bad[owner[~self.reached[flat]]] = True
        self.exact_pieces += int(bad.sum())
        return {p: tuple(self.merged(b) if bad[k] else g) for k, (p, b, g) in enumerate(zip(pieces, raw, guess, strict=True))}

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text. New pieces are learnt for TOGETHER characters of texts at a time, which with the remembered pieces
        bounds the memory; a longer text is learnt alone."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= TOGETHER):
                size, end = size + len(texts[end]), end + 1
            yield from self.encode_together(texts[at:end])
            at = end

    def encode_together(self, texts: list[str]) -> Iterator[np.ndarray]:
        known, cut, pieces = self.known, [], set()
        for text in texts:
            parts = self.special.split(text) if self.special and any(s in text for s in self.specials) else [text]
            cut.append([p if p in self.specials else self.split(p) for p in parts])
            pieces.update(*[p for p in cut[-1] if not isinstance(p, str)])
        new = pieces.difference(known)
        if len(known) + len(new) > self.most:
            known.clear()
            new = pieces
        learnt = self.learn(new) if new else {}
        known.update((p, t) for p, t in learnt.items() if len(p) <= MAX_REMEMBERED)
        long = {p: t for p, t in learnt.items() if len(p) > MAX_REMEMBERED}
        for parts in cut:
            flat: list[int] = []
            for part in parts:
                if isinstance(part, str):
                    flat.append(self.specials[part])
                elif long:
                    for p in part:
                        flat += long[p] if p in long else known[p]
                else:
                    for ids in map(known.__getitem__, part):
                        flat += ids
            yield np.array(flat, np.uint32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        get = self.tokens.get
        return b"".join([get(i, b"") for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, most: int = MAX_PIECES) -> BytePairCodec:
    return BytePairCodec(path, most)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """docs plus an array of token ids, in place of a column of that name. path: a vocabulary file that every executor has."""

    def run(texts: list[str | None]) -> list[list]:
        return [[x.astype(np.int32) for x in codec(path).encode_batch([t or "" for t in texts])]]

    own = free(docs, "_text")
    return added(docs.drop(ids).withColumn(own, docs[text].cast("string")), [own], f"`{ids}` array<int>", run)


def decode(tokens: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """tokens plus the decoded text, in place of a column of that name; null ids give an empty text."""

    def run(rows: list[list[int] | None]) -> list[list]:
        return [[codec(path).decode(x) if x is not None else "" for x in rows]]

    own = free(tokens, "_ids")
    return added(tokens.drop(text).withColumn(own, tokens[ids]), [own], f"`{text}` string", run)


def digests(docs: DataFrame, path: str, most: int = MAX_PIECES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: each text is encoded, decoded and hashed in the task that reads
    it. most: pieces a worker remembers."""

    def run(texts: list[str | None]) -> Iterable[Iterable]:
        c, out = codec(path, most), []
        for ids in c.encode_batch([t or "" for t in texts]):
            out.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()))
        return zip(*out, strict=True) if out else ([], [], [])

    def done() -> None:
        codec.cache_clear()
        gc.collect()

    # a worker of a stage among others goes on to them, so it gives the memory back
    return added(docs.selectExpr("doc_id", "cast(text AS string) AS text"), ["text"], "n_tokens long, ids_sha256 string, decoded_sha256 string", run, done if most <= MAX_PIECES else None)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every document."""
    return digests(documents(spark, sf_dir), vocabulary_path(), ALONE)
