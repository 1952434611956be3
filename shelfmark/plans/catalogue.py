"""Driver-facing queries over the benchmark tables, one per catalogue operator, with equivalent SQL.

The benchmark tables hold no retail records, so titles, keys and places are made from them the same way on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.functions import text, values
from shelfmark.functions.lemmas import LONGEST, SHORTEST, WHOLE, default_lemmatizer
from shelfmark.operators import dimensions, history, identity, migration, outbox, store
from shelfmark.plans import titles
from shelfmark.schemas import struct
from shelfmark.sources import receiver
from shelfmark.streaming import state, sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def receiver_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The eight receiver tables: customers stand for artifacts, orders for products, two rows for each customer for units, lineitem for
    children. PAGE says the same in SQL."""
    c, o, li = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "lineitem")

    def shaped(name: str, df: DataFrame, made: dict[str, str]) -> DataFrame:
        return df.select(*[F.expr(made.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in struct(name)])

    child = {"id": "l_partkey", "product_id": "l_orderkey", "sort_order": "l_linenumber"}
    place = "(l_linenumber * 1000000L + l_partkey)"  # the SQL's order of images, which isn't that of lines once parts pass a million
    two = c.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2))))
    return {
        "run_artifacts": shaped("run_artifacts", c, {"id": "c_custkey", "run_id": "'run-' || c_custkey", "parser_name": "CASE c_custkey % 3 WHEN 0 THEN ' FixPrice' WHEN 1 THEN 'chizhik' END", "ingested_at": "'2024-01-' || lpad(cast(1 + c_custkey % 28 AS string), 2, '0') || 'T10:00:00Z'", "latitude": "c_acctbal"}),
        "run_artifact_products": shaped("run_artifact_products", o, {
            "id": "o_orderkey", "artifact_id": "o_custkey", "sku": "CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'sku-' || o_orderkey END", "title": "CASE WHEN o_orderkey % 7 = 3 THEN '  ' ELSE 'Item ' || o_orderkey END", "price": "o_totalprice",
            "unit": "CASE o_orderkey % 3 WHEN 0 THEN 'kgm' WHEN 1 THEN 'PCE' ELSE 'box' END", "categories_uid_json": "CASE WHEN o_orderkey % 2 = 0 THEN '[\"c2\",\"c2\",\"c9\"]' ELSE 'c1, c2' END", "main_image": "'http://h/images/' || o_orderkey || '.webp'",
        }),
        "run_artifact_categories": shaped("run_artifact_categories", two, {"id": "c_custkey * 2 + k", "artifact_id": "c_custkey", "uid": "'c' || k", "title": "'Group ' || (c_custkey % 2) || k"}),
        "run_artifact_administrative_units": shaped("run_artifact_administrative_units", two, {"id": "c_custkey * 2 + k", "artifact_id": "c_custkey", "country": "'Land'", "region": "c_mktsegment", "name": "c_name || k"}),
        "run_artifact_product_images": shaped("run_artifact_product_images", li.where("l_linenumber <> 5"), child | {"id": place, "sort_order": f"{place} DIV 1000000", "url": "CASE WHEN l_linenumber = 3 THEN ' ' ELSE 'http://h/images/' || l_partkey || '.webp' END"}),
        "run_artifact_product_meta": shaped("run_artifact_product_meta", li, child | {"name": "'flag'", "value_text": "l_returnflag || l_partkey"}),
        "run_artifact_product_wholesale_prices": shaped("run_artifact_product_wholesale_prices", li.where("l_linenumber < 3"), child | {"from_items": "l_partkey * 1D", "price": "l_extendedprice"}),
        "run_artifact_product_categories": shaped("run_artifact_product_categories", o.where("o_orderkey % 11 = 0"), {"id": "o_orderkey", "product_id": "o_orderkey", "category_uid": "'c1'", "sort_order": "0"}),
    }


#: Products with their artifact and its unit of least id.
PAGE = """SELECT o.*, c.*, make_timestamp(2024, 1, 1 + c_custkey % 28, 10, 0, 0) AS seen, c_name || '1' AS unit_name FROM orders o JOIN customer c ON o_custkey = c_custkey"""


@query(f"""SELECT o_orderkey AS product_id, 'run-' || c_custkey AS run_id, unit_name FROM ({PAGE}) WHERE c_custkey % 3 = 0 AND (seen > TIMESTAMP '2024-01-07 10:00:00' OR (seen = TIMESTAMP '2024-01-07 10:00:00' AND o_orderkey > 100)) ORDER BY seen, o_orderkey LIMIT 500""")
def keyset_page(spark, d):
    """The page after a cursor; its size is the feature."""
    t = receiver_tables(spark, d)
    out = receiver.page(t["run_artifact_products"], t["run_artifacts"], t["run_artifact_administrative_units"], 500, "fixprice", ("2024-01-07 10:00:00", 100))
    return out.select(F.col("product.id").alias("product_id"), F.col("artifact.run_id").alias("run_id"), F.col("unit_row.name").alias("unit_name"))


@query(f"""SELECT o_orderkey AS product_id, c_custkey AS artifact_id, c_mktsegment AS region, unit_name FROM ({PAGE})""")
def fetch_join(spark, d):
    t = receiver_tables(spark, d)
    out = receiver.page(t["run_artifact_products"], t["run_artifacts"], t["run_artifact_administrative_units"], 0)
    return out.select(F.col("product.id").alias("product_id"), F.col("artifact.id").alias("artifact_id"), F.col("unit_row.region").alias("region"), F.col("unit_row.name").alias("unit_name"))


@query("""SELECT o_orderkey AS product_id, string_agg(l_linenumber || ':' || l_returnflag || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS meta FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def child_collect(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_orderkey").alias("_pid"))
    meta = receiver.gathered(receiver_tables(spark, d)["run_artifact_product_meta"], keys, ["value_text", "sort_order"], "m")
    out = keys.join(meta, F.col("_pid") == F.col("product_id"), "left")
    listed = F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["sort_order"].cast("string"), x["value_text"])), ",")
    return out.select(F.col("_pid").alias("product_id"), listed.alias("meta"))


@query(f"""WITH i AS (SELECT l_orderkey AS ik, l_partkey, min(l_linenumber * 1000000 + l_partkey) AS place FROM lineitem WHERE l_linenumber NOT IN (3, 5) GROUP BY ALL),
images AS (SELECT ik, string_agg('http://h/images/' || l_partkey || '.webp', '|' ORDER BY place) AS urls FROM i GROUP BY ik),
w AS (SELECT l_orderkey AS wk, count(*) AS n FROM lineitem WHERE l_linenumber < 3 GROUP BY 1),
p AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'c1' WHEN o_orderkey % 2 = 0 THEN 'c2|c9' ELSE 'c1|c2' END AS uids FROM ({PAGE}) LEFT JOIN images ON ik = o_orderkey LEFT JOIN w ON wk = o_orderkey)
SELECT coalesce(CASE c_custkey % 3 WHEN 0 THEN 'fixprice' WHEN 1 THEN 'chizhik' END, 'unknown') AS parser_name, 'receiver:run-' || c_custkey || ':' || o_orderkey AS source_id,
CASE WHEN o_orderkey % 7 = 3 THEN 'Unnamed product' ELSE 'Item ' || o_orderkey END AS title, CASE WHEN o_orderkey % 5 <> 0 THEN 'sku-' || o_orderkey END AS sku, o_totalprice AS price, CASE o_orderkey % 3 WHEN 0 THEN 'KGM' WHEN 1 THEN 'PCE' END AS unit,
CASE uids WHEN 'c1' THEN 'Group ' || (c_custkey % 2) || '1' WHEN 'c2|c9' THEN 'Group ' || (c_custkey % 2) || '2' ELSE 'Group ' || (c_custkey % 2) || '1 / Group ' || (c_custkey % 2) || '2' END AS category,
'Land, ' || c_mktsegment || ', ' || unit_name AS geo, coalesce(urls, 'http://h/images/' || o_orderkey || '.webp') AS images, uids, CAST(coalesce(n, 0) AS INTEGER) AS n_wholesale FROM p""")
def receiver_records(spark, d):
    """Whole raw records: defaults, first unit, child arrays, categories by uid, images."""
    r = receiver.records(receiver_tables(spark, d), 0)
    listed = F.array_join(F.transform("payload.categories", lambda x: x["uid"]), "|")
    return r.select("parser_name", "source_id", "title", "sku", "price", "unit", "category", "geo", F.array_join("image_urls", "|").alias("images"), listed.alias("uids"), F.when(F.col("payload.wholesale").isNull(), 0).otherwise(F.size("payload.wholesale")).alias("n_wholesale"))


#: The nine queries below are of more operators, each through the library.
@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
SELECT event_id, user_id, coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS value FROM e
WHERE ts NOT IN (SELECT ts FROM events GROUP BY ts HAVING count(*) > 1)""")
def backfill_past(spark, d):
    """Values from earlier records of the same key only; instants that occur twice are left to backfill_nearest and the tests."""
    e = table(spark, d, "events")
    once = e.groupBy("ts").count().where("count = 1").select("ts")
    rows = e.join(once, "ts", "left_semi").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return history.backfill(rows, ["user_id"], "ts", "event_id", ["value"], past_only=True).select("event_id", "user_id", "value")


@query("""SELECT page_id, lower(trim(coalesce(n_name, 'Atlantis'))) AS country, CASE WHEN page_id % 3 <> 0 THEN 'region ' || (page_id % 5) END AS region, CASE WHEN page_id % 2 = 0 THEN page_id * 1.5::DOUBLE ELSE -1.0::DOUBLE END AS latitude
FROM pages LEFT JOIN nation ON n_nationkey = page_id % 30""")
def geo_parts(spark, d):
    """Places from the payload, else from the comma-separated text; the first complete pair of coordinates."""
    p = table(spark, d, "pages").join(table(spark, d, "nation"), F.expr("n_nationkey = page_id % 30"), "left")
    payload = F.struct(F.col("n_name").alias("country"), F.expr("CASE WHEN n_name IS NOT NULL AND page_id % 3 <> 0 THEN ' Region  ' || (page_id % 5) END").alias("region"), F.lit(None).cast("string").alias("name"))
    text_ = F.expr("'Atlantis,' || CASE WHEN page_id % 3 <> 0 THEN 'region ' || (page_id % 5) ELSE ' ' END")
    rows = p.select("page_id", payload.alias("payload"), text_.alias("geo"), F.expr("CASE WHEN page_id % 2 = 0 THEN page_id * 1.5D END").alias("lat"), F.lit(2.0).alias("lon"), F.lit(-1.0).alias("a"))
    out = rows.select("page_id", dimensions.geo_parts("payload", F.col("geo")).alias("g"), dimensions.coordinates([(F.col("lat"), F.lit(None).cast("double")), (F.col("lat"), F.col("lon")), (F.col("a"), F.col("a"))]).alias("xy"))
    return out.select("page_id", "g.country", "g.region", "xy.latitude")


@query("""WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [p_type, p_brand] ELSE ['top', lower(p_type)] END AS titles FROM part), u AS (SELECT p_partkey, unnest(titles) AS title, generate_subscripts(titles, 1) - 1 AS sort_order FROM c)
SELECT p_partkey, title, CAST(sort_order AS INTEGER) AS sort_order FROM u""")
def category_candidates(spark, d):
    """Listed categories, or the parts of a normalised text."""
    entry = lambda t, k: f"struct(cast(NULL AS string) AS uid, cast(NULL AS string) AS parent_uid, {t} AS title, cast(NULL AS int) AS depth, {k} AS sort_order)"
    listed = F.expr(f"CASE WHEN p_partkey % 3 = 0 THEN array({entry('p_type', 0)}, {entry('p_brand', 1)}) ELSE slice(array({entry('p_type', 0)}), 1, 0) END")
    p = table(spark, d, "part").select("p_partkey", F.explode(dimensions.category_candidates(listed, F.expr("'Top/ /' || p_type"))).alias("c"))
    return p.select("p_partkey", "c.title", "c.sort_order")


@query("""WITH s AS (SELECT c_nationkey, arg_min(c_name, c_custkey) FILTER (WHERE c_custkey % 4 = 0) AS x, arg_min(c_name, c_custkey) FILTER (WHERE c_custkey % 4 = 1) AS y, max(c_custkey) AS z FROM customer GROUP BY 1)
SELECT c_nationkey AS geo_key, coalesce(x, y) AS name, z AS last_seen FROM s""")
def dimension_merge(spark, d):
    """A stored dimension completed by a batch: known values stay, missing ones are filled, last_seen moves on."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("geo_key"), F.col("c_custkey").alias("k"), "c_name")
    part = lambda rows, keep: history.first_known(rows.withColumn("name", F.expr(f"CASE WHEN k % 4 = {keep} THEN c_name END")), ["geo_key"], ["k"], ["name"], "k")
    out = history.merge_first(part(c.where("k % 2 = 0"), 0), part(c.where("k % 2 = 1"), 1), ["geo_key"], ["name"])
    return out.select("geo_key", "name", "last_seen")


@query("""SELECT page_id, sha256(url) AS fp, url AS canonical, 0 AS n_dup FROM pages""")
def image_rows(spark, d):
    """Urls of every record made canonical and distinct; a repeated url adds nothing."""
    p = table(spark, d, "pages").select("page_id", F.array("url", F.concat(F.lit(" "), "url")).alias("image_urls"))
    rows = p.withColumn("image_urls", F.transform("image_urls", lambda x: F.trim(x)))
    out = identity.dedup_images(rows, ["page_id"])
    return out.select("page_id", F.array_join("image_fingerprints", "|").alias("fp"), F.array_join("image_urls", "|").alias("canonical"), F.size("duplicate_image_urls").alias("n_dup"))


@query("""SELECT sha256(o_orderkey || '') AS dedupe_key FROM orders WHERE o_orderkey % 3 = 0 AND o_orderdate <= TIMESTAMP '1998-01-01' ORDER BY o_orderdate, sha256(o_orderkey || '') LIMIT 200""")
def outbox_eligible(spark, d):
    """Rows of the queue that are due, the oldest first; the limit is the cycle's bound."""
    o = table(spark, d, "orders").select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("dedupe_key"), F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'done' END").alias("status"), F.col("o_orderdate").cast("timestamp").alias("available_at"))
    return outbox.eligible(o, "1998-01-01 00:00:00", 200).select("dedupe_key")


@query("""SELECT p_partkey, CAST(p_partkey AS BIGINT) AS id, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'unknown' END AS parser_name, 'generated:' || p_partkey AS source_id, CAST(CAST(p_retailprice AS DECIMAL(12, 4)) AS DOUBLE) AS price, TIMESTAMP '2024-01-01' + to_days(CAST(p_size AS INTEGER)) AS valid_to_at FROM part""")
def migration_single(spark, d):
    """An older single table completed with defaults."""
    old = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN p_brand END").alias("parser_name"), F.col("p_retailprice").alias("price"), F.expr("timestamp '2024-01-01' + make_dt_interval(p_size)").alias("observed_at"))
    out = migration.from_single(old)
    return out.select(F.col("id").alias("p_partkey"), "id", "parser_name", "source_id", F.col("price").cast("double").alias("price"), F.col("valid_to_at").cast("timestamp_ntz").alias("valid_to_at"))


@query("""SELECT p_partkey, 'крупа ' || p_partkey AS kept, 'крупа;' || p_partkey || ';и' AS words FROM part""")
def stop_words(spark, d):
    """Tokens, and texts without stop-words."""
    t = F.expr("'Крупа ' || p_partkey || ' и'")
    kept = text.remove_stopwords(F.expr("'Крупа ' || p_partkey || ' и в ассортименте'"))
    return table(spark, d, "part").select("p_partkey", kept.alias("kept"), F.array_join(text.tokens(t), ";").alias("words"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || '+00:00' AS iso, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 3 HOUR END AS parsed FROM events""")
def instants(spark, d):
    """Instants as ISO text, and ISO text with Z, with an offset, or unreadable as instants."""
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    raw = F.expr("CASE event_id % 3 WHEN 0 THEN ' ' || date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+03:00'\") ELSE 'soon' END")
    return e.select("event_id", values.iso(F.col("ts")).alias("iso"), values.parse_instant(raw).cast("timestamp_ntz").alias("parsed"))


@query("""WITH f AS (SELECT p_brand, lower(p_type) AS k, min(p_partkey) AS pk, arg_min(p_type, p_partkey) AS t FROM part GROUP BY ALL)
SELECT p_brand, string_agg(t, ' / ' ORDER BY pk) AS titles FROM f GROUP BY p_brand""")
def category_titles(spark, d):
    first = table(spark, d, "part").groupBy("p_brand", F.lower("p_type").alias("k")).agg(F.min(F.struct("p_partkey", "p_type")).alias("s"))
    g = first.groupBy("p_brand").agg(F.transform(F.sort_array(F.collect_list("s")), lambda x: x["p_type"]).alias("t"))
    return g.select("p_brand", text.join_distinct(F.col("t"), " / ").alias("titles"))


RAW_NUMBER = "CASE event_id % 7 WHEN 0 THEN event_id || ',5' WHEN 1 THEN ' ' || event_id || ' ' WHEN 2 THEN '12d' WHEN 3 THEN 'yes' WHEN 4 THEN '0' WHEN 5 THEN '' ELSE 'Off' END"


@query(f"""WITH r AS (SELECT event_id, {RAW_NUMBER} AS raw FROM events),
n AS (SELECT event_id, raw, lower(trim(raw)) AS s, CASE WHEN regexp_full_match(replace(trim(raw), ',', '.'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(replace(trim(raw), ',', '.') AS DOUBLE) END AS as_double FROM r)
SELECT event_id, as_double, coalesce(CASE WHEN as_double = floor(as_double) THEN CAST(as_double AS BIGINT) END, -1) AS as_long,
CASE WHEN s IN ('1', 'true', 'yes', 'y', 'on') THEN TRUE WHEN s IN ('0', 'false', 'no', 'n', 'off') THEN FALSE WHEN as_double IS NOT NULL THEN as_double <> 0 END AS as_bool FROM n""")
def safe_casts(spark, d):
    r = table(spark, d, "events").select("event_id", F.expr(RAW_NUMBER).alias("raw"))
    return r.select("event_id", values.safe_double(F.col("raw")).alias("as_double"), F.coalesce(values.safe_long(F.col("raw")), F.lit(-1).cast("long")).alias("as_long"), values.safe_bool(F.col("raw")).alias("as_bool"))


RAW_LIST = """CASE o_orderkey % 4 WHEN 0 THEN '["a", " ", "' || o_orderpriority || '"]' WHEN 1 THEN 'x, ' || o_orderstatus || ',,y' WHEN 2 THEN o_orderpriority ELSE '' END"""


@query(f"""WITH r AS (SELECT o_orderkey, {RAW_LIST} AS raw FROM orders),
l AS (SELECT o_orderkey, [trim(x) FOR x IN CASE WHEN raw LIKE '[%' THEN from_json(raw, '["VARCHAR"]') ELSE string_split(raw, ',') END IF trim(x) <> ''] AS items FROM r)
SELECT o_orderkey, array_to_string(items, '|') AS items, len(items) AS n_items FROM l""")
def string_list_decode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", values.string_list(F.expr(RAW_LIST)).alias("l"))
    return o.select("o_orderkey", F.array_join("l", "|").alias("items"), F.size("l").cast("long").alias("n_items"))


@query(r"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(translate(lower(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), 'ё×', 'еx'), '["“”«»]', '', 'g'), '[^\p{L}\p{M}\p{Nd}\p{Pc}\s.,-]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS cleaned FROM c""")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


MIXED = "'тeтрадь ' || p_name || ' 48x96мм бyмага-' || p_size || ' soft'"


@query(f"""SELECT p_partkey, array_to_string([CASE WHEN regexp_matches(w, '[a-z]') AND regexp_matches(w, '[а-я]') THEN translate(w, 'abcehkmoptxy', 'авсенкмортху') ELSE w END FOR w IN string_split({MIXED}, ' ')], ' ') AS fixed FROM part""")
def homoglyph_fix(spark, d):
    return table(spark, d, "part").select("p_partkey", text.repair_homoglyphs(F.expr(MIXED)).alias("fixed"))


TITLE_A = "'Пастила ' || p_name || CASE p_partkey % 3 WHEN 0 THEN ', Silver Birch' WHEN 1 THEN ', 25х40' ELSE '' END || ', ' || p_size || ' г, ' || (p_partkey % 250) || ' шт, в ассортименте'"


@query("""SELECT p_partkey, 'Пастила ' || p_name AS name_original, CASE p_partkey % 3 WHEN 0 THEN 'Silver Birch' END AS brand, 'PCE' AS unit,
CAST(CASE WHEN p_partkey % 250 BETWEEN 1 AND 200 THEN p_partkey % 250 END AS DOUBLE) AS available_count, p_size / 1000.0::DOUBLE AS package_quantity, 'KGM' AS package_unit FROM part""")
def title_grammar_a(spark, d):
    g = titles.grammar_a(table(spark, d, "part").select("p_partkey", F.expr(TITLE_A).alias("title")))
    return g.select("p_partkey", "name_original", F.col("title_brand").alias("brand"), F.col("title_unit").alias("unit"), F.col("title_count").alias("available_count"), F.col("title_package").alias("package_quantity"), F.col("title_package_unit").alias("package_unit"))


TITLE_B = "'Кофе Northwind ' || p_name || ' молотый ' || (p_partkey % 30 + 1) || 'х' || p_size || CASE p_partkey % 2 WHEN 0 THEN 'г' ELSE 'мл' END"


@query("""SELECT p_partkey, 'Кофе Northwind ' || p_name || ' молотый' AS name_original, array_to_string(string_split('Northwind ' || p_name, ' ')[1:3], ' ') AS brand, 'PCE' AS unit,
CAST(p_partkey % 30 + 1 AS DOUBLE) AS available_count, p_size / 1000.0::DOUBLE AS package_quantity, CASE p_partkey % 2 WHEN 0 THEN 'KGM' ELSE 'LTR' END AS package_unit FROM part""")
def title_grammar_b(spark, d):
    g = titles.grammar_b(table(spark, d, "part").select("p_partkey", F.expr(TITLE_B).alias("title")))
    return g.select("p_partkey", "name_original", F.col("title_brand").alias("brand"), F.col("title_unit").alias("unit"), F.col("title_count").alias("available_count"), F.col("title_package").alias("package_quantity"), F.col("title_package_unit").alias("package_unit"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'KGM' WHEN 1 THEN 'LTR' WHEN 2 THEN 'KGM' ELSE 'PCE' END AS unit FROM part""")
def unit_classify(spark, d):
    t = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'Сыр ВЕСОВОЙ ' || p_name WHEN 1 THEN 'Квас на розлив ' || p_name WHEN 2 THEN 'Яблоки на  вес' ELSE 'Весовойка ' || p_name END")
    return table(spark, d, "part").select("p_partkey", titles.sold_by(t).alias("unit"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Silver Birch' WHEN p_partkey % 5 <> 0 THEN p_type END AS brand, CASE WHEN p_partkey % 2 = 0 THEN 'KGM' ELSE 'PCE' END AS unit,
CASE WHEN p_partkey % 7 = 0 THEN 1.5::DOUBLE ELSE p_size / 1000.0::DOUBLE END AS package_quantity, CASE WHEN p_partkey % 7 = 0 THEN 'LTR' ELSE 'KGM' END AS package_unit FROM part""")
def raw_title_merge(spark, d):
    raw = table(spark, d, "part").select(
        "p_partkey", F.expr(TITLE_A).alias("title"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN '25х40' ELSE p_type END").alias("brand"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN 'KGM' END").alias("unit"), F.lit(None).cast("double").alias("available_count"),
        F.expr("CASE WHEN p_partkey % 7 < 2 THEN 1.5D END").alias("package_quantity"), F.expr("CASE WHEN p_partkey % 7 = 0 THEN 'LTR' END").alias("package_unit"),
    )
    return titles.no_dimension_brand(titles.merged(titles.grammar_a(raw))).select("p_partkey", "brand", "unit", "package_quantity", "package_unit")


@query("""WITH RECURSIVE k AS (SELECT p_partkey AS id, 's' || (p_partkey // 4) AS key FROM part UNION ALL SELECT p_partkey, 'p' || (p_partkey // 8) FROM part WHERE p_partkey % 4 = 0),
e AS (SELECT DISTINCT a.id, b.id AS other FROM k a JOIN k b USING (key)),
r(id, reach) AS (SELECT p_partkey, p_partkey FROM part UNION SELECT r.id, e.other FROM r JOIN e ON r.reach = e.id)
SELECT id AS p_partkey, min(reach) AS canonical FROM r GROUP BY id""")
def identity_components(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr("CASE WHEN p_partkey % 4 = 0 THEN 'p' || (p_partkey DIV 8) END").alias("plu"), F.expr("'s' || (p_partkey DIV 4)").alias("sku"), F.lit(" ").alias("source_id"), F.lit(None).cast("string").alias("normalized_name"))
    return identity.components(p, "p_partkey")


@query()
def identity_resolve(spark, d):
    """The exact fold in order of arrival; its ids depend on the order, so tests hold it against a plain loop."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("parser_name"), F.col("p_partkey").alias("seq"), F.expr("CASE WHEN p_partkey % 4 = 0 THEN 'p' || (p_partkey DIV 200) END").alias("plu"), F.expr("'s' || (p_partkey DIV 100)").alias("sku"), F.expr("'r:' || p_partkey").alias("source_id"), F.col("p_name").alias("normalized_name"))
    return identity.resolve(p, ["seq"], by_component=True).select(F.col("seq").alias("p_partkey"), "parser_name", "canonical_product_id")


@query("""WITH u AS (SELECT page_id, 0 AS pos, url FROM pages UNION ALL SELECT page_id, 1, regexp_replace(url, '[?#].*$', '') FROM pages)
SELECT sha256(url) AS fingerprint, arg_min(url, page_id * 2 + pos) AS canonical_url, count(*) AS n_uses FROM u GROUP BY sha256(url)""")
def image_dedup(spark, d):
    p = table(spark, d, "pages").select("page_id", F.array("url", F.regexp_replace("url", "[?#].*$", "")).alias("urls"))
    return identity.first_urls(p, "urls", ["page_id"])


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN page_id || ' a+b.webp' WHEN 1 THEN page_id || '.jpg' END AS image_name FROM pages""")
def image_name(spark, d):
    u = F.expr("CASE page_id % 3 WHEN 0 THEN 'https://img.example.com/api/images/' || page_id || '%20a+b.webp' WHEN 1 THEN 'https://img.example.com/images/' || page_id || '.jpg?size=2' ELSE url END")
    return table(spark, d, "pages").select("page_id", values.image_name(u, "https://img.example.com").alias("image_name"))


@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
SELECT a.event_id, a.user_id, coalesce(a.v, (SELECT b.v FROM e b WHERE b.user_id = a.user_id AND b.v IS NOT NULL ORDER BY abs(epoch_us(b.ts) - epoch_us(a.ts)), b.ts, b.event_id LIMIT 1)) AS value FROM e a""")
def backfill_nearest(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return history.backfill(e, ["user_id"], "ts", "event_id", ["value"]).select("event_id", "user_id", "value")


RUNS = """WITH f AS (SELECT user_id, event_id, ts, sha256(event_type) AS fp FROM events),
g AS (SELECT *, CASE WHEN lag(fp) OVER w IS DISTINCT FROM fp OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS n FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
h AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, CAST(run AS BIGINT) AS snapshot_no, any_value(fp) AS fp, min(ts) AS valid_from, max(ts) AS valid_to, count(*) AS n_rows FROM h GROUP BY user_id, run"""


@query(RUNS)
def snapshot_rle(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.sha2("event_type", 256).alias("fp"))
    return history.snapshots(e, ["user_id"], ["ts", "event_id"], "fp", "ts")


@query(RUNS)
def stream_snapshot(spark, d):
    """The same from a file stream: micro-batches are stored once each, runs formed on reading."""
    at = f"{identity.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).select("user_id", "event_id", "ts", F.sha2("event_type", 256).alias("fp"))
    return sync.stream_runs(source, f"{at}/rows", f"{at}/state", ["user_id"], ["ts", "event_id"], "fp", "ts")


@query("""SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id""")
def source_latest(spark, d):
    return history.source_state(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "event_id", "ts")


@query("""SELECT user_id, arg_max(value, event_id) FILTER (WHERE event_type <> 'error') AS value, arg_max(props, event_id) FILTER (WHERE event_id % 3 <> 0) AS props, arg_max(event_type, event_id) AS event_type,
max(ts) AS observed_at, arg_min(ts, event_id) AS created_at FROM events GROUP BY user_id""")
def projection_last_non_null(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", F.expr("CASE WHEN event_type <> 'error' THEN value END").alias("value"), F.expr("CASE WHEN event_id % 3 <> 0 THEN props ELSE ' ' END").alias("props"))
    return history.projection(e, ["user_id"], ["event_id"], ["value", "props"], ["event_type"], "ts")


PLACES = "SELECT s_suppkey, r_name AS country, n_name AS region, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS name, s_nationkey * 1.5 AS latitude, CASE WHEN s_suppkey % 5 <> 0 THEN (s_nationkey + 1) * -2.25 END AS longitude, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def places(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("r_name").alias("country"), F.col("n_name").alias("region"), F.expr("CASE WHEN s_suppkey % 3 <> 0 THEN s_name END").alias("name"), F.expr("s_nationkey * 1.5D").alias("latitude"), F.expr("CASE WHEN s_suppkey % 5 <> 0 THEN (s_nationkey + 1) * -2.25D END").alias("longitude"), "s_acctbal")


@query(f"""SELECT lower(country) || '|' || lower(region) AS geo_key, arg_min(name, s_suppkey) FILTER (WHERE name IS NOT NULL) AS name, CAST(arg_min(longitude, s_suppkey) FILTER (WHERE longitude IS NOT NULL) AS DOUBLE) AS longitude,
arg_min(s_acctbal, s_suppkey) AS first_seen, max(s_acctbal) AS last_seen FROM ({PLACES}) GROUP BY country, region""")
def settlement_dim(spark, d):
    p = places(spark, d).withColumn("geo_key", values.geo_key(F.col("country"), F.col("region"), F.lit(None).cast("string")))
    return history.first_known(p, ["geo_key"], ["s_suppkey"], ["name", "longitude"], "s_acctbal")


@query(f"""WITH p AS (SELECT lower(country) || '|' || lower(region) AS geo_key, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude FROM ({PLACES}) WHERE longitude IS NOT NULL)
SELECT DISTINCT sha256(printf('%s:%.8f:%.8f', geo_key, latitude, longitude)) AS geo_fingerprint, geo_key, latitude, longitude FROM p""")
def geo_points(spark, d):
    return dimensions.geo_points(places(spark, d).withColumn("name", F.lit(None).cast("string")), ["s_suppkey"])


@query("""WITH c AS (SELECT p_brand || ':title:' || substring(sha256(lower(p_type)), 1, 40) AS category_key, p_partkey, p_type, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS depth, p_retailprice FROM part)
SELECT category_key, arg_min(p_type, p_partkey) AS title, arg_min(depth, p_partkey) FILTER (WHERE depth IS NOT NULL) AS depth, arg_min(p_retailprice, p_partkey) AS first_seen, max(p_retailprice) AS last_seen FROM c GROUP BY category_key""")
def category_dim(spark, d):
    p = table(spark, d, "part").select("p_partkey", values.category_key(F.col("p_brand"), F.lit(None).cast("string"), F.lower("p_type")).alias("category_key"), F.col("p_type").alias("title"), F.expr("CASE WHEN p_partkey % 4 <> 0 THEN p_size END").alias("depth"), "p_retailprice")
    return history.first_known(p, ["category_key"], ["p_partkey"], ["title", "depth"], "p_retailprice")


@query("""WITH l AS (SELECT p_partkey, p_brand || ':uid:' || lower(p_type) AS k, 0 AS pos, p_size AS so FROM part UNION ALL SELECT p_partkey, p_brand || ':title:' || substring(sha256(lower(p_name)), 1, 40), 1, 1 FROM part UNION ALL SELECT p_partkey, p_brand || ':uid:' || lower(p_type), 2, 2 FROM part WHERE p_partkey % 2 = 0)
SELECT p_partkey, k AS category_key, CAST(arg_min(so, pos) AS INTEGER) AS sort_order, min(pos) = 0 AS is_primary FROM l GROUP BY p_partkey, k""")
def category_links(spark, d):
    entry = lambda uid, title, so: f"struct({uid} AS uid, {title} AS title, cast({so} AS int) AS sort_order)"
    both = f"array({entry('p_type', 'CAST(NULL AS STRING)', 'p_size')}, {entry('CAST(NULL AS STRING)', 'p_name', 'NULL')})"
    p = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("parser_name"), F.expr(f"CASE WHEN p_partkey % 2 = 0 THEN array_append({both}, {entry('p_type', 'CAST(NULL AS STRING)', 'NULL')}) ELSE {both} END").alias("listed"))
    return dimensions.category_links(p, "p_partkey", "listed")


@query("""SELECT page_id, 'image_url' AS asset_kind, 0 AS sort_order, url AS value FROM pages UNION ALL SELECT page_id, 'image_url', 1, url || '#2' FROM pages
UNION ALL SELECT page_id, 'image_fingerprint', 0, sha256(url) FROM pages WHERE page_id % 2 = 0""")
def asset_unpivot(spark, d):
    p = table(spark, d, "pages").select("page_id", F.array("url", F.concat("url", F.lit("#2"))).alias("urls"), F.expr("CASE WHEN page_id % 2 = 0 THEN array(sha2(url, 256)) END").alias("fps"))
    return dimensions.unpivot_assets(p, ["page_id"], {"image_url": "urls", "image_fingerprint": "fps"})


@query("""WITH n AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events),
g AS (SELECT user_id, n // 10 AS chunk_no, count(*) AS n_rows, max(ts) AS til, arg_max(event_id, n) AS id, arg_min(event_id, n) FILTER (WHERE event_id % 3 <> 0) AS a, arg_max(event_id, n) FILTER (WHERE event_id % 3 <> 0) AS b FROM n GROUP BY user_id, n // 10),
t AS (SELECT *, strftime(til, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(til) % 1000000 = 0 THEN '' ELSE '.' || strftime(til, '%f') END || '+00:00' AS iso FROM g)
SELECT user_id, chunk_no, n_rows, iso AS cursor_at, id AS cursor_id,
'shop:' || iso || ':' || id || ':' || substring(sha256('shop|' || iso || '|' || id || '|' || n_rows || '|' || coalesce('s' || a, '') || '|' || coalesce('s' || b, '')), 1, 24) AS chunk_id FROM t""")
def chunk_cursor(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", F.expr("CASE WHEN event_id % 3 <> 0 THEN 's' || event_id ELSE ' ' END").alias("source_id"))
    c = history.chunks(e, ["user_id"], ["ts", "event_id"], 10)
    return history.cursors(c, ["user_id", "chunk_no"], ["ts", "event_id"], "source_id", F.lit(" Shop"), values.iso(F.col("ts")), "event_id")


@query("""WITH u AS (SELECT regexp_replace(url, '[?#].*$', '') AS url FROM pages), q AS (SELECT sha256(url) AS dedupe_key, min(url) AS url FROM u GROUP BY 1), old AS (SELECT sha256(url) AS dedupe_key, CASE page_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'failed' ELSE 'pending' END AS status, CAST(page_id % 5 AS INTEGER) AS attempts FROM pages WHERE url NOT LIKE '%?%' AND url NOT LIKE '%#%')
SELECT q.dedupe_key, q.url, CASE WHEN old.status = 'done' THEN 'done' ELSE 'pending' END AS status, CASE WHEN old.status IN ('done', 'pending') THEN old.attempts ELSE 0 END AS attempts FROM q LEFT JOIN old USING (dedupe_key)""")
def outbox_dedupe(spark, d):
    p = table(spark, d, "pages")
    old = p.where("url NOT LIKE '%?%' AND url NOT LIKE '%#%'").select(F.sha2("url", 256).alias("dedupe_key"), "url", F.expr("CASE page_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'failed' ELSE 'pending' END").alias("status"), F.expr("cast(page_id % 5 AS int)").alias("attempts"), F.lit("2024-01-01").cast("timestamp").alias("available_at"))
    return outbox.enqueue(p.select(F.regexp_replace("url", "[?#].*$", "").alias("url")), old, "2024-01-02 00:00:00").select("dedupe_key", "url", "status", "attempts")


@query("""SELECT sha256(CAST(event_id AS VARCHAR)) AS dedupe_key, CASE WHEN event_id % 3 = 0 THEN 'done' WHEN event_id % 3 = 1 AND a.n + 1 >= 10 THEN 'failed' ELSE 'pending' END AS status, CAST(a.n + CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS INTEGER) AS attempts,
TIMESTAMP '2024-01-01' + to_seconds(CAST(CASE WHEN event_id % 3 = 1 THEN 60 + least(300, pow(2, greatest(0, a.n))) ELSE 0 END AS BIGINT)) AS available_at FROM (SELECT event_id, event_id % 12 AS n FROM events) a""")
def outbox_backoff(spark, d):
    e = table(spark, d, "events").select("event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("dedupe_key"))
    queue = e.select("dedupe_key", F.lit("u").alias("url"), F.lit("pending").alias("status"), F.expr("cast(event_id % 12 AS int)").alias("attempts"), F.lit("2024-01-01").cast("timestamp").alias("available_at"))
    results = e.where("event_id % 3 < 2").select("dedupe_key", F.expr("event_id % 3 = 0").alias("ok"))
    out = outbox.settle(queue, results, "2024-01-01 00:01:00")
    return out.select("dedupe_key", "status", F.col("attempts").cast("int").alias("attempts"), F.col("available_at").cast("timestamp_ntz").alias("available_at"))


@query("""WITH c AS (SELECT l_orderkey, sum(l_quantity) AS available, min(l_shipdate) AS counted_at FROM lineitem WHERE l_linenumber > 2 GROUP BY 1)
SELECT o_orderkey AS id, CAST(coalesce(c.available, k.c_acctbal) AS DOUBLE) AS available_count, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END, CAST(c.counted_at AS TIMESTAMP), o_orderdate) AS created_at,
CAST(CAST(k.c_acctbal AS DECIMAL(12, 4)) AS DOUBLE) AS price, 'generated:' || o_orderkey AS source_id, 'unknown' AS parser_name, o_orderdate AS valid_from_at
FROM orders o LEFT JOIN c ON l_orderkey = o_orderkey LEFT JOIN customer k ON o.o_orderkey = k.c_custkey""")
def migration_rebuild(spark, d):
    """Orders stand for events, customers for snapshots, sums of lines for available counts."""
    events = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("observed_at"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END").cast("timestamp").alias("created_at"))
    counts = table(spark, d, "lineitem").where("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("snapshot_id")).agg(F.sum("l_quantity").alias("available_count"), F.min("l_shipdate").cast("timestamp").alias("created_at"))
    snaps = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("price"), F.col("c_acctbal").alias("available_count"))
    out = migration.from_split(events, snaps, counts)
    at = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return out.select("id", "available_count", at("created_at"), F.col("price").cast("double").alias("price"), "source_id", "parser_name", at("valid_from_at"))


@query("""WITH e AS (SELECT event_id, event_type || '|' || user_id || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || '+00:00|' || event_id || '|' AS k FROM events)
SELECT sha256(k) AS source_event_uid, event_id FROM e""")
def event_uid_dedup(spark, d):
    e = table(spark, d, "events")
    twice = e.unionAll(e).withColumn("source_event_uid", values.event_uid(F.col("event_type"), F.col("user_id"), F.col("ts").cast("timestamp"), F.col("event_id"), F.lit(None)))
    return twice.dropDuplicates(["source_event_uid"]).select("source_event_uid", "event_id")


@query("""SELECT p_partkey, sha256('{"available_count":' || CASE WHEN p_partkey % 2 = 0 THEN p_size || '.0' ELSE 'null' END || ',"discount_price":null,"loyal_price":null,"parser_name":"' || p_brand || '","price":' || p_retailprice || ',"price_unit":"RUB","source_id":"' || p_partkey || '"}') AS fingerprint FROM part""")
def content_fingerprint(spark, d):
    null = F.lit(None).cast("double")
    cols = {"available_count": F.expr("CASE WHEN p_partkey % 2 = 0 THEN cast(p_size AS double) END"), "discount_price": null, "loyal_price": null, "parser_name": F.col("p_brand"), "price": F.col("p_retailprice"), "price_unit": F.lit("RUB"), "source_id": F.col("p_partkey").cast("string")}
    return table(spark, d, "part").select("p_partkey", values.content_fingerprint(cols).alias("fingerprint"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'r:' || o_orderkey WHEN 1 THEN 'sku:' || o_custkey WHEN 2 THEN 'plu:' || o_custkey ELSE 'generated:unknown:' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS source_id FROM orders""")
def natural_id(spark, d):
    o = table(spark, d, "orders")
    pick = lambda k, c: F.expr(f"CASE WHEN o_orderkey % 4 = {k} THEN {c} ELSE ' ' END")
    return o.select("o_orderkey", values.natural_id(pick(0, "'r:' || o_orderkey"), pick(1, "cast(o_custkey AS string)"), pick(2, "cast(o_custkey AS string)"), F.lit(None).cast("string"), F.col("o_orderdate").cast("timestamp")).alias("source_id"))


#: Inflected words of a retail title, most of them unknown to the lexicon.
INFLECTED = "пельменей вареники шампиньонов маринованных подгузники гусеницы станками бритвенные колбасками резаную ватных дисков щеткой напитками салфеток хлебцы сметаной ткани мультизлаковые настольную упаковок серии кг и".split()


def lemmas_sql() -> str:
    """The rules of the default lemmatizer as a table, asked for the longest ending of every word."""
    form = default_lemmatizer()
    rules = ", ".join(f"('{e}', {n}, '{add}')" for e, (n, add) in form.rules.items())
    words = "[" + ", ".join(f"'{w}'" for w in INFLECTED) + "]"
    return f"""WITH rules(ending, n, add) AS (VALUES {rules}),
t AS (SELECT p_partkey, {words}[1 + p_partkey % {len(INFLECTED)}] || ' ' || {words}[1 + p_partkey * 7 % {len(INFLECTED)}] || ' ' || p_size || 'г' AS title FROM part),
w AS (SELECT p_partkey, pos, word FROM (SELECT p_partkey, string_split(regexp_replace(title, '(\\d+)', '\\1 '), ' ') AS words FROM t), unnest(words) WITH ORDINALITY u(word, pos)),
e AS (SELECT w.*, k, CASE WHEN k = {LONGEST + 1} THEN '{WHOLE}' || word WHEN length(word) >= k THEN right(word, k) END AS ending FROM w, range(1, {LONGEST + 2}) r(k)),
r AS (SELECT p_partkey, pos, word, arg_max(left(word, length(word) - n) || add, k) AS lemma FROM e JOIN rules USING (ending) WHERE length(word) >= {SHORTEST} AND regexp_full_match(word, '[а-я-]+') GROUP BY ALL)
SELECT p_partkey, string_agg(coalesce(lemma, word), ' ' ORDER BY pos) AS lemmas FROM w LEFT JOIN r USING (p_partkey, pos, word) GROUP BY p_partkey"""


@query(lemmas_sql())
def lemmas(spark, d):
    """Titles of inflected words in their dictionary forms."""
    words = F.array(*[F.lit(w) for w in INFLECTED])
    pick = lambda k: F.element_at(words, (F.expr(k) % len(INFLECTED) + 1).cast("int"))
    title = F.concat_ws(" ", pick("p_partkey"), pick("p_partkey * 7"), F.concat(F.col("p_size").cast("string"), F.lit("г")))
    return table(spark, d, "part").select("p_partkey", text.TextNormalizer().lemmatize(title).alias("lemmas"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'крупа макарон соус' WHEN 1 THEN 'овощ ягода ' || p_name ELSE 'на с' END AS category FROM part""")
def category_text(spark, d):
    forms = F.create_map(*[F.lit(x) for pair in {"крупы": "крупа", "макароны": "макарон", "соусы": "соус", "овощи": "овощ", "ягоды": "ягода"}.items() for x in pair])
    raw = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'Крупы и макароны, соусы' WHEN 1 THEN 'Овощи и ягоды/' || p_name ELSE 'на с' END")
    return table(spark, d, "part").select("p_partkey", text.normalize_category(raw, forms).alias("category"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


@query("""WITH RECURSIVE p AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n,
  list_filter([CASE WHEN p_partkey % 4 = 0 THEN 'plu:p' || (p_partkey // 200) END, 'sku:s' || (p_partkey // 100), 'source_id:r:' || p_partkey, 'normalized_name:' || trim(p_name)], lambda k: k IS NOT NULL) AS keys FROM part),
f AS (SELECT p_brand, 0::BIGINT AS n, 0::BIGINT AS p_partkey, 0::BIGINT AS choice, MAP {'': 0::BIGINT} AS ids FROM p GROUP BY p_brand UNION ALL
  SELECT p.p_brand, p.n, p.p_partkey, c.choice, map_concat(f.ids, map_from_entries(list_transform(p.keys, lambda k: {'k': k, 'v': c.choice}))) FROM f JOIN p ON p.p_brand = f.p_brand AND p.n = f.n + 1,
  LATERAL (SELECT coalesce(list_filter(list_transform(p.keys, lambda k: f.ids[k]), lambda v: v IS NOT NULL)[-1], p.p_partkey) AS choice) c)
SELECT p_partkey, p_brand AS parser_name, choice AS first_partkey FROM f WHERE n > 0""")
def identity_fold(spark, d):
    """The exact fold in order of arrival: for every record the first one that has its canonical id."""
    out = identity.cut(identity_resolve(spark, d))  # the fold runs once for both sides of the join
    first = out.groupBy(F.col("parser_name").alias("n"), F.col("canonical_product_id").alias("c")).agg(F.min("p_partkey").alias("first_partkey"))
    return out.join(first, (F.col("parser_name") == F.col("n")) & (F.col("canonical_product_id") == F.col("c"))).select("p_partkey", "parser_name", "first_partkey")


@query("""SELECT page_id, 'http://h/' || (page_id % 7) || '/' || min(page_id) OVER (PARTITION BY page_id % 7) AS canonical, CASE WHEN page_id = min(page_id) OVER (PARTITION BY page_id % 7) THEN 0 ELSE 1 END AS n_dup FROM pages""")
def image_canonical(spark, d):
    """Equal images of different records: the first url stands for all, and what it replaced is listed."""
    url = F.expr("'http://h/' || (page_id % 7) || '/' || page_id")
    rows = table(spark, d, "pages").select("page_id", F.array(url).alias("image_urls"))
    out = identity.dedup_images(rows, ["page_id"], fingerprint=lambda u: F.sha2(F.split(u, "/")[3], 256))
    return out.select("page_id", F.get("image_urls", F.lit(0)).alias("canonical"), F.size("duplicate_image_urls").alias("n_dup"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS at, event_type AS kind, CAST(json_extract(props, '$.k') AS INTEGER) * 2 AS twice FROM events""")
def payload_paths(spark, d):
    """A nested payload with an instant, as VARIANT, and values at its paths."""
    k = values.payload_value(values.payload(F.col("props")), "$.k", "int")
    whole = F.struct(F.col("ts").cast("timestamp").alias("at"), F.struct(F.array(k, k * 2).alias("list"), F.lit(None).cast("string").alias("none")).alias("inner"), F.create_map(F.lit("kind"), F.col("event_type")).alias("map"))
    p = table(spark, d, "events").select("event_id", values.payload(values.json_safe(whole)).alias("p"))
    at = lambda path, kind: values.payload_value(F.col("p"), path, kind)
    return p.select("event_id", at("$.inner.list[0]", "int").alias("k"), at("$.at", "string").alias("at"), at("$.map.kind", "string").alias("kind"), at("$.inner.list[1]", "int").alias("twice"))


#: Bytes of raw records that a micro-batch of stream_projection takes, in files of so many.
BATCH_BYTES, FILE_RECORDS = 128 << 20, 100_000


#: Raw records of the receiver tables: artifacts of the third parser have no handler.
@query("""SELECT 'receiver:run-' || c_custkey || ':' || o_orderkey AS source_id, 'no handler for its parser' AS reason FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 3 = 2""")
def quarantine_rows(spark, d):
    """Records that can't be applied, with the reason."""
    raw = receiver.records(receiver_tables(spark, d), 0)
    return sync.quarantined(raw, titles.default_registry(), F.lit("2024-01-01").cast("timestamp"))[1].select("source_id", "reason")


@query("""SELECT CASE c_custkey % 3 WHEN 0 THEN 'fixprice' ELSE 'chizhik' END AS parser_name, 'receiver:run-' || c_custkey || ':' || o_orderkey AS source_id, CASE WHEN o_orderkey % 7 = 3 THEN 'Unnamed product' ELSE 'Item ' || o_orderkey END AS title_original,
CASE WHEN o_orderkey % 5 <> 0 THEN 'sku-' || o_orderkey END AS sku, CAST(round(o_totalprice, 4) AS DOUBLE) AS price, lower('land|' || c_mktsegment || '|' || c_name || '1') AS settlement_key FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 3 < 2""")
def stream_projection(spark, d):
    """The current projection after the raw records went through the sync as a stream: handlers, identity, snapshots, dimensions and
    cursors, each micro-batch in one commit. Micro-batches have BATCH_BYTES of files, and what a batch leaves goes before the next,
    so the disk holds the raw records, the catalogue and one batch's tables."""
    at = f"{identity.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    raw = receiver.records(receiver_tables(spark, d), 0)
    raw.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(f"{at}/raw")
    target = store.Store(spark, f"{at}/catalog")
    source = spark.readStream.schema(raw.schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(f"{at}/raw")
    query_ = sync.stream(source, target, "projection", f"{at}/state", sweep=True)
    query_.awaitTermination()
    identity.remove(spark, f"{at}/raw")
    return target.table("projection").select("parser_name", "source_id", "title_original", "sku", F.col("price").cast("double").alias("price"), "settlement_key")


@query("""WITH e AS (SELECT event_id, user_id, date_trunc('day', ts) AS at, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
SELECT event_id, user_id, coalesce(v, (SELECT c.v FROM e c WHERE c.user_id = e.user_id AND c.v IS NOT NULL AND (c.at < e.at OR c.at = e.at AND c.event_id < e.event_id) ORDER BY c.at DESC, c.event_id LIMIT 1)) AS value FROM e""")
def backfill_ties(spark, d):
    """Values from earlier records of the same key where many share an instant: the latest instant first, then the least id."""
    rows = table(spark, d, "events").select("event_id", "user_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("at"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return history.backfill(rows, ["user_id"], "at", "event_id", ["value"], past_only=True).select("event_id", "user_id", "value")


@query(RUNS)
def state_snapshot(spark, d):
    """The same from keyed state: every source's open run is in the state store, and micro-batches give what changed."""
    at = f"{identity.shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).select("user_id", "event_id", "ts", F.sha2("event_type", 256).alias("fp"))
    state.run_stream(source, at, ["user_id"], ["ts", "event_id"], "fp", "ts")
    out = state.current_runs(spark, at, ["user_id"])
    return out.select(F.col("user_id").cast("long").alias("user_id"), "snapshot_no", "fp", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("valid_to").cast("timestamp_ntz").alias("valid_to"), "n_rows")
