"""Russian product text as Spark column expressions. Regular expressions carry (?U) so that classes and \\b know Cyrillic."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from shelfmark.functions.lemmas import default_lemmatizer

# They decide what the normalised texts are.
LATIN_LOOKALIKES, CYRILLIC_LOOKALIKES = "abcehkmoptxy", "авсенкмортху"
UNIT_TOKENS = ["см", "мм", "м", "км", "г", "кг", "мг", "л", "мл", "шт", "вт", "квт"]
ASSORTMENT = r"(?iuU)\bв\s+ассортименте\b"
QUOTES = r"[\"“”«»]"
NON_WORD = r"(?U)[^\w\s.,xх×-]+"
#: Stop-words of the default list: the Russian one of the Snowball project, as NLTK spreads it (BSD licence); pass others to remove_stopwords() where a caller has its own.
STOP_WORDS = (
    "и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей "
    "может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под будет ж тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы нее сейчас были куда зачем всех никогда можно при "
    "наконец два об другой хоть после над больше тот через эти нас про всего них какая много разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между"
).split()


#: What (?U)\s matches.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def once(c: Column, work: Callable[[Column], Column]) -> Column:
    """work(c) where c is evaluated once, however often work uses it: within higher-order functions Spark shares no expressions."""
    return F.get(F.transform(F.array(c), work), F.lit(0))


def trim_ws(c: Column) -> Column:
    """Without white space of any kind at both ends; Spark's trim() knows the space alone."""
    return F.btrim(c, F.lit(WHITE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def is_missing(c: Column) -> Column:
    """Null, or a string of white space."""
    return c.isNull() | (trim_ws(c.cast("string")) == "")


def collapse(c: Column) -> Column:
    return trim_ws(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_string(c: Column) -> Column:
    """Lower case, ё as е, single spaces; empty becomes null."""
    return F.nullif(collapse(F.translate(F.lower(c), "ё", "е")), F.lit(""))


def comma_spacing(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s*,\s*", ", ")


def repair_homoglyphs(c: Column) -> Column:
    """Latin look-alikes become Cyrillic within tokens that mix both alphabets. c is lower case."""
    runs = lambda s: F.regexp_extract_all(s, F.lit(r"([a-zа-я0-9-]+|[^a-zа-я0-9-]+)"), F.lit(1))
    fixed = lambda t: F.when(mixed(t), F.translate(t, LATIN_LOOKALIKES, CYRILLIC_LOOKALIKES)).otherwise(t)
    return once(c, lambda s: F.when(mixed(s), F.array_join(F.transform(runs(s), fixed), "")).otherwise(s))


def mixed(c: Column) -> Column:
    """Whether a text in lower case has letters of both alphabets."""
    return c.rlike("[a-z]") & c.rlike("[а-я]")


def clean_text(c: Column) -> Column:
    c = repair_homoglyphs(F.translate(F.lower(trim_ws(c)), "ё×", "еx"))
    return collapse(F.regexp_replace(F.regexp_replace(c, QUOTES, ""), NON_WORD, " "))


#: A letter of neither alphabet; a word of letters; an atom, with a whole or decimal number; a token: atoms joined by single hyphens,
#: or a run of hyphens.
OTHER = r"[^\sa-zа-я\d.,×-]"
LETTERS = rf"(?:[а-я]+|[a-z]+)?(?:{OTHER}+(?:[а-я]+|[a-z]+)?)+|[а-я]+|[a-z]+"
ATOM = rf"(?:\d+(?:[.,]\d+)*|{LETTERS})"
TOKEN = rf"(?U)({ATOM}(?:-{ATOM})*|-+)"


def tokens(c: Column) -> Column:
    """Tokens of cleaned text that consist of Latin and Cyrillic letters, whole numbers and hyphens.

    Alphabets and digits part (30, х, 30, см); hyphens join what they touch on both sides (мясо-молочный); a number with a
    decimal part, and what a hyphen joins to it, is one token and, as it holds another character, dropped; so are words with
    letters of other alphabets. Hyphens that join nothing stand for themselves.
    """
    return clean_tokens(clean_text(c))


def clean_tokens(c: Column) -> Column:
    """The tokens of a text that is cleaned."""
    return F.filter(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(1)), lambda t: t.rlike("^[a-zа-я0-9-]+$"))


def lemmas(words: Column, dictionary: Column | None = None, lemmatizer: Callable[[Column], Column] | None = None) -> Column:
    """Words with their dictionary forms: a map column's, else the lemmatizer's (the suffix trie by default). Unit tokens stay."""
    form = lemmatizer or default_lemmatizer()
    known = lambda w: form(w) if dictionary is None else F.coalesce(F.try_element_at(dictionary, w), form(w))
    return F.transform(words, lambda w: F.when(w.isin(UNIT_TOKENS), w).otherwise(known(w)))


def remove_stopwords(c: Column, words: Iterable[str] = STOP_WORDS) -> Column:
    stop = list(words)
    # a text that is cleaned once more changes only where alphabets mix, or something was taken out
    again = lambda s: F.when(s.rlike(ASSORTMENT) | mixed(s), clean_text(F.regexp_replace(s, ASSORTMENT, " "))).otherwise(s)
    return F.array_join(F.filter(clean_tokens(once(clean_text(c), again)), lambda t: ~t.isin(stop)), " ")


def normalize_category(c: Column, dictionary: Column | None = None, words: Iterable[str] = STOP_WORDS, lemmatizer: Callable[[Column], Column] | None = None) -> Column:
    """Lemmas without stop-words; all lemmas if nothing else is left; null if empty."""
    stop = list(words)
    kept = lambda found: F.array_join(F.filter(found, lambda t: ~t.isin(stop)), " ")
    found = lemmas(tokens(F.regexp_replace(c, "[/,]+", " ")), dictionary, lemmatizer)
    return once(found, lambda w: F.nullif(F.coalesce(F.nullif(kept(w), F.lit("")), F.array_join(w, " ")), F.lit("")))


@dataclass(frozen=True)
class TextNormalizer:
    """The text steps with a caller's own stop-words, dictionary and lemmatizer, as one object. Stop-words are compared in small
    letters with ё as е."""

    extra_stopwords: Iterable[str] = ()
    dictionary: Column | None = None
    lemmatizer: Callable[[Column], Column] | None = None

    @property
    def stopwords(self) -> list[str]:
        return list(dict.fromkeys([*STOP_WORDS, *(w.strip().lower().replace("ё", "е") for w in self.extra_stopwords)]))

    def clean_text(self, c: Column) -> Column:
        return clean_text(c)

    def tokenize(self, c: Column) -> Column:
        return tokens(c)

    def lemmatize(self, c: Column) -> Column:
        return F.array_join(lemmas(tokens(c), self.dictionary, self.lemmatizer), " ")

    def remove_stopwords(self, c: Column) -> Column:
        return remove_stopwords(c, self.stopwords)

    def normalize_category(self, c: Column) -> Column:
        return normalize_category(c, self.dictionary, self.stopwords, self.lemmatizer)


def join_distinct(parts: Column, sep: str) -> Column:
    """Non-blank parts, the first of those equal without regard to case, joined."""
    good = F.filter(F.transform(parts, blank_to_null), lambda p: p.isNotNull())
    seen = F.aggregate(good, F.array().cast("array<string>"), lambda acc, p: F.when(F.exists(acc, lambda q: F.lower(q) == F.lower(p)), acc).otherwise(F.array_append(acc, p)))
    return F.nullif(F.array_join(seen, sep), F.lit(""))
