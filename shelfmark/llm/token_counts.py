"""Token counts under a unigram vocabulary by count-only Viterbi.

The pieces of a sentencepiece file, read as a unigram vocabulary with their scores as log-probabilities, are matched by
an Aho-Corasick automaton. White space marks part a text into words, as the Metaspace pre-tokenizer of the tokenizers
library does, and no piece crosses them; for each different word, dynamic programming over the match ends carries the
best score and its number of pieces, nothing else. Ties go as in that library's unigram model: candidates for an end
come by start, the longest piece first, and only a strictly better score replaces one. A character that no piece covers
alone costs the least score less 10, and counts as many pieces as it has bytes (byte fallback).

Null and empty texts have no tokens. Words are remembered up to MAX_WORDS per worker, then memory starts anew; results
don't depend on it. A long word takes time in proportion to its length and matches. Repeated rows count alike.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import added, documents

#: The piece file, by its name among the public tokenizers.
VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
MAX_WORDS, MAX_REMEMBERED = 300_000, 64
#: Fixed value: what an uncovered character costs beside the least score.
UNKNOWN_PENALTY = 10.0


class PieceCounter(dict):
    """word -> (pieces, pieces that are bytes, score)."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores = {model.id_to_piece(k): float(model.get_score(k)) for k in range(model.get_piece_size()) if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k))}
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in self.scores if len(p) == 1}

    def count(self, word: str) -> tuple[int, int, float]:
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        pieces, raw = [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        matches = self.automaton.iter(word)
        found = next(matches, None)
        for end in range(n):
            while found is not None and found[0] == end:
                size, score = found[1]
                start = end + 1 - size
                total = best[start] + score
                if best[end + 1] is None or total > best[end + 1]:
                    best[end + 1], pieces[end + 1], raw[end + 1] = total, pieces[start] + 1, raw[start]
                found = next(matches, None)
            c = word[end]
            if c not in self.single:
                total = best[end] + self.unknown
                if best[end + 1] is None or total > best[end + 1]:
                    size = len(c.encode("utf-8", "surrogatepass"))
                    best[end + 1], pieces[end + 1], raw[end + 1] = total, pieces[end] + size, raw[end] + size
        return pieces[n], raw[n], best[n]

    def __missing__(self, word: str) -> tuple[int, int, float]:
        value = self.count(MARK + word)
        if len(word) <= MAX_REMEMBERED:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = value
        return value

    def text(self, text: str | None) -> tuple[int, int, float]:
        """(pieces, byte pieces, score) of a text."""
        if not text:
            return 0, 0, 0.0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:  # the text begins with a mark of its own
            del words[0]
        found = [self[w] for w in words]
        a, b, c = zip(*found, strict=True)
        return sum(a), sum(b), float(sum(c))


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def counted(docs: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """keys, n_tokens, n_byte_tokens and score of every row."""

    def run(texts: list[str | None]) -> Iterable[Iterable]:
        c = counter(path)
        return zip(*[c.text(t) for t in texts], strict=True) if texts else ([], [], [])

    return added(docs.select(*keys, docs["text"].cast("string").alias("_text")), ["_text"], "n_tokens long, n_byte_tokens long, score double", run)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens and score of every document."""
    return counted(documents(spark, sf_dir), vocabulary_path(), ["doc_id"])
