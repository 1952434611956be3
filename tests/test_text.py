"""Tokens against a state machine over characters, dictionary forms against words that the lexicon doesn't have."""

from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from shelfmark.functions import lemmas, lexicon, text

#: Words of other products, by class; none is in the lexicon.
UNSEEN = {
    "m": "бублик рогалик пельмень вареник кекс пудинг ликер бисквит глинтвейн эклер круассан лаваш сервиз плафон патрон тюбик флакон пинцет спрей тоник скраб тальк лак ремень* шнурок* совок* черенок* зажим крючок* пластырь бинт градусник термометр ингалятор шампур мангал казан гриф козырек*",
    "f": "морковка репа шаурма лазанья горбушка котлета фрикаделька тефтелька шпротина килька мойва плотва рукавичка косынка шаль сорочка майка пилотка лопата тяпка мотыга рейка скрепка линейка кнопка закладка обложка папка точилка кисточка палитра гуашь трость щель модель автокормушка сушилка гладилка посыпка добавка глазунья",
    "n": "плавание лечение облучение волшебство мастерство лукошко окошко донышко горлышко перышко",
    "a": "пресный рассыпчатый ароматизированный витаминный диетический грушевый сливовый абрикосовый банановый ананасовый виноградный гранатовый мраморный бамбуковый эмалированный чугунный алюминиевый стальной медный латунный капроновый нейлоновый полиэтиленовый фланелевый ситцевый джинсовый замшевый велюровый бархатный атласный кружевной трикотажный утепленный гладкий рельефный полосатый клетчатый пушистый лохматый колючий жгучий тягучий рыбацкий охотничий дорожный походный",
}


def test_unseen_words_are_unseen():
    known = {w.rstrip("*") for listed in lexicon.WORDS.values() for w in listed.split()}
    assert not known & {w.rstrip("*") for listed in UNSEEN.values() for w in listed.split()}


def test_accuracy_on_unseen_forms(spark):
    labelled = sorted({(form, lemma) for form, lemma, _, _ in lemmas.forms(UNSEEN)})
    assert len(labelled) >= 1000
    d = spark.createDataFrame(labelled, "form string, lemma string").select("*", lemmas.default_lemmatizer()(F.col("form")).alias("got"))
    rows = d.collect()
    right = sum(r.got == r.lemma for r in rows)
    print(f"{right} of {len(rows)}")
    assert right / len(rows) >= 0.75
    plain = lemmas.default_lemmatizer().plain
    assert all(plain(r.form) == r.got for r in rows)


def test_known_words_and_edges(spark):
    form = lemmas.default_lemmatizer()
    wrong = [(f, w, form.plain(f)) for f, w, _, _ in lemmas.forms() if form.plain(f) != w]
    assert len(wrong) <= 5, wrong
    words = ["", "и", "кг", "abc", "x5", "3-х", "большими", "мясо-молочные", "хлебцы", "салфетки", "напитков", None]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(form(F.col("w"))).collect()]
    assert got == ["", "и", "кг", "abc", "x5", "3-х", "большой", "мясо-молочный", "хлебец", "салфетка", "напиток", None]
    own = lemmas.Lemmatizer({"f": "зюка"})
    assert [own.plain(w) for w in ("зюки", "зюкой", "сыра")] == ["зюка", "зюка", "сыра"]


def test_normaliser_object(spark):
    n = text.TextNormalizer(extra_stopwords=[" Акция ", "новинка"], dictionary=F.create_map(F.lit("печенью"), F.lit("печень")))
    d = spark.createDataFrame([("Акция: соки и напитки, 30х30см",), ("Говядина с печенью/Новинка",), ("и",)], "c string")
    rows = d.select(n.lemmatize(F.col("c")), n.remove_stopwords(F.col("c")), n.normalize_category(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [("акция сок и напиток 30 х 30 см", "соки напитки 30 х 30 см", "сок напиток 30 х 30 см"), ("говядина с печень новинка", "говядина печенью", "говядина печень"), ("и", "", "и")]


def machine(cleaned: str) -> list[str]:
    """Atoms by kind, then joins between neighbours, then whole tokens of allowed characters."""
    kind = lambda c: "ru" if "а" <= c <= "я" else "lat" if "a" <= c <= "z" else "int" if c.isdigit() else "punct" if c in ".,×-" else "other"
    out = []
    for piece in cleaned.split():
        atoms = []
        for c in piece:
            k = kind(c)
            if atoms and atoms[-1][0] == k and (k != "punct" or atoms[-1][1][-1] == c):
                atoms[-1][1] += c
            else:
                atoms.append([k, c])
        joined, at = [], 0
        while at < len(atoms):
            token, k = atoms[at][1], atoms[at][0]
            at += 1
            while at < len(atoms) and k != "punct":
                nk, nt = atoms[at]
                after = atoms[at + 1] if at + 1 < len(atoms) else ("", "")
                if {k, nk} <= {"ru", "lat", "other"} and "other" in (k, nk):
                    token, k, at = token + nt, nk, at + 1
                elif nt == "-" and after[0] not in ("", "punct") or k == "int" and nt in (".", ",") and after[0] == "int":
                    token, k, at = token + nt + after[1], after[0], at + 2
                else:
                    break
            joined.append(token)
        out += [t for t in joined if re.fullmatch("[a-zа-я0-9-]+", t)]
    return out


def test_tokens_equal_state_machine(spark):
    rng = random.Random(4)
    parts = ["сыр", "мясо", "abc", "x", "х", "30", "2", "5", "-", "--", ".", ",", "×", " ", " ", "_", "ґ", "é", "см", "«", "!"]
    made = ["30х30см", "мясо-молочный 2,5-3.2%", "1.5л", "3-х слойная", "a--b", "- 5", "т.е.", "10-12шт.", "foo_bar", "x-5-y", "5,", ",5", "5.-6", "сыр-", "-сыр"]
    made += ["".join(p) for p in itertools.product(["2", "аб", "é"], ["-", ".", ",", "_", ""], ["3", "в", "z"])]
    made += ["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(400)]
    rows = spark.createDataFrame([(m,) for m in made], "t string").select("t", text.clean_text(F.col("t")).alias("c"), text.tokens(F.col("t")).alias("got")).collect()
    wrong = [(r.t, r.c, r.got, machine(r.c)) for r in rows if r.got != machine(r.c)]
    assert not wrong, wrong[:5]
    assert len(rows) > 450


def test_a_text_is_evaluated_once_and_cleaned_again_where_it_changes(spark):
    rows = ['Чай "a"б в Ассортименте', 'Mo"локо 3,2% и сыр', "Item 12  x", "в ассортименте", "  Ёж ×　", "", None, "wа м\u0085и"]
    d = spark.createDataFrame([(r,) for r in rows], "title string")
    twice = text.tokens(F.regexp_replace(text.clean_text(F.col("title")), text.ASSORTMENT, " "))
    want = F.array_join(F.filter(twice, lambda t: ~t.isin(text.STOP_WORDS)), " ")
    out = d.select(text.remove_stopwords(F.col("title")).alias("got"), want.alias("want"), text.trim_ws(F.col("title")).alias("trimmed"), F.regexp_replace("title", r"(?U)^\s+|\s+$", "").alias("by_pattern"))
    assert all(r.got == r.want and r.trimmed == r.by_pattern for r in out.collect())
    plan = d.select(text.remove_stopwords(F.col("title")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.split("\n")[0].count("title#") == 1
