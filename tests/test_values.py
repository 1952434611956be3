from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import values


def column(spark, f, items, kind="string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in items], f"x {kind}").select(f(F.col("x"))).collect()]


def test_casts(spark):
    assert column(spark, values.safe_double, ["1,5", " 2 ", "12d", "1_000", "", None, "-.5"]) == [1.5, 2.0, None, None, None, None, -0.5]
    assert column(spark, values.safe_long, ["3", "3.0", "3.5", "x"]) == [3, 3, None, None]
    assert column(spark, values.safe_bool, ["Yes", "off", "2", "0", "maybe", None]) == [True, False, True, False, None, None]


def test_string_list(spark):
    assert column(spark, values.string_list, ['["a"," ","b"]', "x, ,y", "one", "", None, "[broken"]) == [["a", "b"], ["x", "y"], ["one"], [], [], ["[broken"]]


def test_iso_and_instants(spark):
    d = spark.sql("SELECT timestamp '2026-02-27 12:00:00' AS a, timestamp '2026-02-27 12:00:00.5' AS b").select(values.iso(F.col("a")), values.iso(F.col("b"))).first()
    assert tuple(d) == ("2026-02-27T12:00:00+00:00", "2026-02-27T12:00:00.500000+00:00")
    assert column(spark, lambda c: values.iso(values.parse_instant(c)), ["2026-02-27T12:00:00Z", "2026-02-27T15:00:00+03:00", "soon"]) == ["2026-02-27T12:00:00+00:00"] * 2 + [None]


def test_image_names(spark):
    urls = ["http://h/api/images/a%20b+c.webp", "http://h/images/x.jpg", "http://other/images/x.jpg", "http://h/images/../x", "http://h/images/", None]
    assert column(spark, lambda c: values.image_name(c, "http://h"), urls) == ["a b+c.webp", "x.jpg", None, None, None, None]


def test_addresses():
    assert values.parse_dsn("mysql+pymysql://u:p%40@h:3307/db?charset=latin1") == {"host": "h", "port": 3307, "user": "u", "password": "p@", "database": "db", "charset": "latin1"}
    assert values.parse_dsn("mysql:///db")["host"] == "127.0.0.1"
    with pytest.raises(ValueError, match="database"):
        values.parse_dsn("mysql://h")
    assert "p%40" not in values.safe_reference("mysql://u:p%40@h/db")


def test_keys(spark):
    d = spark.createDataFrame([(None, "Москва"), ("Россия", None), (None, None)], "a string, b string")
    assert [r[0] for r in d.select(values.geo_key(F.col("a"), F.lit(None).cast("string"), F.col("b"))).collect()] == ["москва", "россия", None]
    assert column(spark, lambda c: values.backoff_seconds(c), [1, 2, 5, 40], "int") == [1, 2, 16, 300]
