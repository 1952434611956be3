from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.plans import titles

RAW = "title string, brand string, unit string, available_count double, package_quantity double, package_unit string, category string, geo string, composition string, parser_name string"


def parsed(spark, grammar, title):
    return grammar(spark.createDataFrame([(title,)], "title string")).first()


@pytest.mark.parametrize(
    ("title", "brand", "count", "package", "unit"),
    [
        ('Линейка "Геометрия", Silver Birch, 30х2,5 см, в ассортименте', "Silver Birch", None, None, None),
        ("Пастила яблочная, 350 г, 12 шт, в ассортименте", None, 12.0, 0.35, "KGM"),
        ("Скатерть льняная, 140х220, в ассортименте", None, None, None, None),
        ("", None, None, None, None),
    ],
)
def test_grammar_a(spark, title, brand, count, package, unit):
    r = parsed(spark, titles.grammar_a, title)
    assert (r.title_brand, r.title_package, r.title_package_unit, r.title_unit) == (brand, package, unit, "PCE")
    if count:
        assert r.title_count == count


@pytest.mark.parametrize(
    ("title", "brand", "count", "package", "unit"),
    [
        ("Печенье Полдник овсяное 270г", "Полдник", None, 0.27, "KGM"),
        ("Кофе Northwind Dark Valley молотый 18х7г", "Northwind Dark Valley", 18.0, 0.007, "KGM"),
        ("Батарейки Volten Plus 6шт", "Volten Plus", 6.0, None, None),
        ("Кефир Луговой фермерский 2.5-3.2% 450мл", "Луговой", None, 0.45, "LTR"),
        ("Рулет с маковой начинкой, 3х85г", None, 3.0, 0.085, "KGM"),
        ("Коробка картонная 12.5х20х8.5см", None, None, None, None),
    ],
)
def test_grammar_b(spark, title, brand, count, package, unit):
    r = parsed(spark, titles.grammar_b, title)
    assert (r.title_brand, r.title_count, r.title_package, r.title_package_unit) == (brand, count, package, unit)


def test_sale_by_weight_and_volume_drop_count_and_package(spark):
    for title, unit in (("Халва весовая 250г 4шт", "KGM"), ("Лимонад на розлив 700мл", "LTR")):
        r = parsed(spark, titles.grammar_b, title)
        assert (r.title_unit, r.title_count, r.title_package) == (unit, None, None)


def test_homoglyphs_and_clean_text(spark):
    d = spark.createDataFrame([("Tетрадь Paper House 48x96мм",), ("Pучка «Soft»  Line",), (None,), ("",)], "t string")
    got = [r[0] for r in d.select(text.clean_text(F.col("t"))).collect()]
    assert got[0].startswith("тетрадь paper house") and got[1] == "ручка soft line" and got[2] is None and got[3] == ""


def test_category_text(spark):
    forms = F.create_map(*[F.lit(x) for p in {"крупы": "крупа", "соусы": "соус", "овощи": "овощ", "ягоды": "ягода"}.items() for x in p])
    d = spark.createDataFrame([("крупы, соусы",), ("Овощи и ягоды",), ("и",), ("",)], "c string")
    assert [r[0] for r in d.select(text.normalize_category(F.col("c"), forms)).collect()] == ["крупа соус", "овощ ягода", "и", None]


def test_handlers_merge_raw_and_title(spark):
    rows = [("Пастила яблочная, Silver Birch, 350 г", "raw", None, None, 5.0, None, "Пастила", "Россия,  Тверь", "сахар ,яблоки", "fixprice"), ("Кофе Northwind 18х7г", None, "KGM", 7.0, 1.0, "KGM", None, None, None, "chizhik"), ("Пастила Love, Love, 90 г", None, None, None, None, None, None, None, None, " FixPrice")]
    out = {r.title: r for r in titles.default_registry().handle(spark.createDataFrame(rows, RAW)).collect()}
    a, b, c = (out[r[0]] for r in rows)
    assert (a.brand, a.unit, a.package_quantity, a.package_unit, a.composition_normalized, a.geo_normalized) == ("Silver Birch", "PCE", 0.35, "KGM", "сахар, яблоки", "россия, тверь")
    assert (b.brand, b.unit, b.available_count, b.package_quantity, b.title_normalized) == ("Northwind", "KGM", 7.0, 1.0, "кофе northwind")
    # a comma title's brand joins the name even if the name holds it
    assert (c.brand, c.title_normalized) == ("Love", "пастила love love")


def test_registry_names_unknown(spark):
    r = titles.default_registry()
    with pytest.raises(KeyError, match="chizhik"):
        r.get("other")
    with pytest.raises(ValueError, match="already"):
        r.register("FixPrice ", titles.handler_a)
    rows = [("a", None, None, None, None, None, None, None, None, "newshop")]
    with pytest.raises(KeyError, match="newshop"):
        r.handle(spark.createDataFrame(rows, RAW))
