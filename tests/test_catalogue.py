from __future__ import annotations

import http.server
import os
import random
import sqlite3
import threading

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark import daemon_cli, ports
from shelfmark.operators import dimensions, history, identity, migration, outbox
from shelfmark.operators.store import Conflict, Store, with_retries
from shelfmark.plans import catalogue, library
from shelfmark.schemas import SOURCE, validate_money
from shelfmark.sources import receiver
from shelfmark.streaming import sync

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, con, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), con.execute(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda d: sorted(str([None if pd.isna(v) else float(v) if isinstance(v, int | float) else str(v) for v in r]) for r in d[sorted(d.columns)].astype(object).values.tolist())
    assert rows(got) == rows(want)


def test_images_of_parts_beyond_a_million_are_in_the_order_of_the_sql(spark, tmp_path):
    c = duckdb.connect()
    for t in ("customer", "orders"):
        c.execute(f"COPY (SELECT * FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    c.execute(f"COPY (SELECT * REPLACE (l_partkey + CASE WHEN l_linenumber < 3 THEN 3500000 ELSE 0 END AS l_partkey) FROM '{SF}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet'")
    for t in ("customer", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = {r.source_id: r.images for r in catalogue.receiver_records(spark, str(tmp_path)).collect()}
    assert got == {r[1]: r[8] for r in c.execute(catalogue.SQL["receiver_records"]).fetchall()}


def test_records_of_repeated_product_ids_keep_their_own_categories(spark, tmp_path):
    c = duckdb.connect()
    for t, made in (("customer", "*"), ("orders", "* REPLACE (o_orderkey // 2 AS o_orderkey)"), ("lineitem", "*")):
        c.execute(f"COPY (SELECT {made} FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = catalogue.receiver_records(spark, str(tmp_path)).select("source_id", "category", "uids").collect()
    assert sorted(map(tuple, got)) == sorted(c.execute(f"SELECT source_id, category, uids FROM ({catalogue.SQL['receiver_records']})").fetchall())


def test_identity_fold_equals_loop(spark):
    rows = [("p", k, a, b, f"r{k}", n) for k, (a, b, n) in enumerate([("1", "a", "x"), ("2", "b", "y"), ("1", "b", "z"), (None, " ", "x"), ("2", None, "z"), (None, None, None)])]
    d = spark.createDataFrame(rows, "parser_name string, seq int, plu string, sku string, source_id string, normalized_name string")
    for early in (False, True):
        got = {r.seq: r.canonical_product_id for r in identity.resolve(d, ["seq"], early_return=early).collect()}
        ids, want = {}, {}
        for _, k, *values in rows:
            keys = [(n, v.strip()) for n, v in zip(identity.KEYS, values, strict=True) if v and v.strip()]
            hit = [x for x in keys if x in ids]
            if early and hit:
                want[k] = ids[hit[0]]
                if hit[0][0] == "normalized_name":
                    ids.update(dict.fromkeys(keys, want[k]))
            else:
                want[k] = ids[hit[-1]] if hit else k
                ids.update(dict.fromkeys(keys, want[k]))
        same = lambda m: {(a, b) for a in m for b in m if m[a] == m[b]}
        assert same(got) == same(want)


def test_identity_fold_by_component_is_the_same(spark):
    rng = random.Random(6)
    rows = [(rng.choice("pq"), k, rng.choice([None, "1", "2", "3"]), rng.choice([None, "a", "b", " "]), f"r{k % 23}", rng.choice([None, "x", "y"]) if k % 5 == 0 else None) for k in range(60)]
    d = spark.createDataFrame(rows, "parser_name string, seq int, plu string, sku string, source_id string, normalized_name string")
    known = spark.createDataFrame([("p", "plu", "2", "old-1"), ("p", "source_id", "r5", "old-2"), ("q", "sku", "a", "old-3"), ("q", "sku", "never", "old-4")], "parser_name string, kind string, value string, canonical string")
    for k in (None, known):
        a, b = ({r.seq: r.canonical_product_id for r in identity.resolve(d, ["seq"], k, by_component=c).collect()} for c in (False, True))
        assert a == b and len(a) == 60


def test_identity_fold_leaves_other_columns_alone(spark):
    rows = [("p", k, "1" if k < 2 else None, None, f"r{k}", None, big, [(k, None)]) for k, big in enumerate([2**60 + 1, None, -(2**60) - 1])]
    d = spark.createDataFrame(rows, "parser_name string, seq long, plu string, sku string, source_id string, normalized_name string, big long, nested array<struct<a:long,b:string>>")
    for c in (False, True):
        got = identity.resolve(d, ["seq"], by_component=c)
        assert got.columns == [*d.columns, "canonical_product_id"]
        assert {(r.seq, r.big, r.nested[0].a) for r in got.collect()} == {(0, 2**60 + 1, 0), (1, None, 1), (2, -(2**60) - 1, 2)}


def test_key_map_spills(monkeypatch):
    monkeypatch.setattr(identity, "MOST_KEYS", 5)
    rng, plain, held = random.Random(8), {}, identity.KeyMap()
    for k in range(300):
        keys = [("a", str(rng.randrange(60))), ("b", str(rng.randrange(60)))]
        assert [held.get(x) for x in keys] == [plain.get(x) for x in keys]
        held.put(keys, f"id{k}")
        plain |= dict.fromkeys(keys, f"id{k}")
        assert len(held.near) <= 7
    held.close()


def test_components_write_less_each_round(spark, monkeypatch):
    rng = random.Random(7)
    edges = [(a, b) for a, b in ((rng.randrange(400), rng.randrange(400)) for _ in range(300))]
    rows = [(k, None, None, f"only-{k}", None) for k in range(400)] + [(x, f"e{k}", None, None, None) for k, e in enumerate(edges) for x in e]
    d = spark.createDataFrame(rows, "row int, plu string, sku string, source_id string, normalized_name string")
    sizes, cut = [], identity.cut

    def counted(df):
        out = cut(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(identity, "cut", counted)
    got = {r.row: r.canonical for r in identity.components(d, "row").collect()}
    want = list(range(400))
    while (now := [min([want[k], *(want[a if b == k else b] for a, b in edges if k in (a, b))]) for k in range(400)]) != want:
        want = now
    assert got == dict(enumerate(want))
    assert sum(s == 400 for s in sizes) == 1  # all rows once, at the end; before, in every round
    assert sizes[-2] < sizes[0] / 10


def test_components_chain(spark):
    rows = [(k, f"p{k // 2}", f"s{(k + 1) // 2}", None, None) for k in range(40)] + [(99, None, " ", None, None)]
    got = {r.i: r.canonical for r in identity.components(spark.createDataFrame(rows, "i int, plu string, sku string, source_id string, normalized_name string"), "i").collect()}
    assert got == {k: 0 for k in range(40)} | {99: 99}


def test_backfill_ties_and_empty(spark):
    rows = [("k", 1, "2026-01-01", "a"), ("k", 2, "2026-01-02", None), ("k", 3, "2026-01-03", "b"), ("k", 4, "2026-01-03", None), ("other", 5, "2026-01-01", " ")]
    d = spark.createDataFrame(rows, "k string, i int, t string, v string").withColumn("t", F.col("t").cast("timestamp"))
    assert {r.i: r.v for r in history.backfill(d, ["k"], "t", "i", ["v"]).collect()} == {1: "a", 2: "a", 3: "b", 4: "b", 5: None}
    assert history.backfill(d.limit(0), ["k"], "t", "i", ["v"]).count() == 0


def test_geo(spark):
    d = spark.sql("SELECT struct('Россия' AS country, cast(NULL AS string) AS region, 'Москва' AS name) AS p, 'a, b' AS g UNION ALL SELECT cast(struct(NULL, NULL, NULL) AS struct<country:string,region:string,name:string>), 'Россия, Москва'")
    assert [tuple(r[0]) for r in d.select(dimensions.geo_parts("p", F.col("g"))).collect()] == [("россия", None, "москва"), ("россия", "москва", None)]


def receiver_file(path, rows=3):
    kinds = {"long": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL", "string": "TEXT"}
    db = sqlite3.connect(path)
    for t, ddl in SOURCE.items():
        db.execute(f"CREATE TABLE {t} ({', '.join(f'{c.split()[0]} {kinds[c.split()[1]]}' for c in ddl.split(', '))})")
    put = lambda t, **v: db.execute(f"INSERT INTO {t} ({', '.join(v)}) VALUES ({', '.join('?' * len(v))})", list(v.values()))
    for k in range(rows):
        put("run_artifacts", id=10 + k, run_id=f"run-{k}", parser_name="fixprice", ingested_at=f"2026-02-27T12:0{k}:00+00:00", latitude=59.93863, longitude=30.31413)
        put("run_artifact_administrative_units", id=k, artifact_id=10 + k, country="Россия", region="Московская", name="Москва")
        put("run_artifact_products", id=100 + k, artifact_id=10 + k, sku=f"sku-{k}", plu="1", title="Пастила яблочная, Silver Birch, 350 г, 12 шт", price=199.9, price_unit="RUB", adult=0, categories_uid_json='["c1","c2"]', main_image="http://h/images/m.webp")
        put("run_artifact_categories", id=k, artifact_id=10 + k, uid="c1", title="Сладости", depth=0, sort_order=0)
        put("run_artifact_product_images", id=2 * k, product_id=100 + k, url="http://h/images/a.webp", is_main=1, sort_order=0)
        put("run_artifact_product_images", id=2 * k + 1, product_id=100 + k, url="http://h/images/a.webp", is_main=0, sort_order=1)
    db.commit()
    db.close()


def test_sync_end_to_end(spark, tmp_path):
    src, cat = str(tmp_path / "r.sqlite"), f"file://{tmp_path}/cat"
    receiver_file(src)
    seen = []
    assert sync.run(spark, sync.SyncJob(src, cat, "FixPrice", batch_size=2), seen.append) == {"batches": 2, "records": 3}
    store = Store(spark, cat)
    assert store.cursor("fixprice") == ("2026-02-27T12:02:00+00:00", 102)
    assert store.table("projection").count() == 3 and store.table("snapshots").count() == 3
    assert store.table("identity_map").select("canonical").distinct().count() == 1
    assert store.table("images").count() == 1 and store.table("assets").count() == 6
    assert store.table("geo_points").count() == 1 and store.table("settlements").count() == 1 and store.table("sources").count() == 3
    assert {r.uid: r.title for r in store.table("categories").collect()} == {"c1": "Сладости", "c2": None}
    r = store.table("projection").first()
    assert (r.brand, r.unit) == ("Silver Birch", "PCE")
    # a second run finds nothing
    assert sync.run(spark, sync.SyncJob(src, cat, "fixprice")) == {"batches": 0, "records": 0}
    # the same records again: snapshots go on instead of growing, a batch id is applied once
    raw = receiver.records(receiver.tables(spark, src), 100)
    assert not sync.apply_chunk(store, raw, batch=("b", 1))["skipped"]
    assert sync.apply_chunk(store, raw, batch=("b", 1))["skipped"]
    assert store.table("snapshots").count() == 3 and store.table("projection").count() == 3


def test_receiver_records(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"))
    t = receiver.tables(spark, str(tmp_path / "r.sqlite"))
    assert receiver.records(t, parser="perekrestok").count() == 0
    a = receiver.records(t, 1).first()
    assert (a.source_id, a.image_urls, a.category, a.geo, a.adult) == ("receiver:run-0:100", ["http://h/images/a.webp"], "Сладости", "Россия, Московская, Москва", False)
    assert [c.uid for c in a.payload.categories] == ["c1", "c2"] and a.payload.categories[1].title is None
    assert receiver.records(t, 1, after=("2026-02-27 12:00:00", 100)).first().sku == "sku-1"
    with pytest.raises(FileNotFoundError):
        receiver.tables(spark, str(tmp_path / "none.db"))
    db = sqlite3.connect(tmp_path / "bad.db")
    db.execute("CREATE TABLE run_artifacts (id INTEGER)")
    db.close()
    with pytest.raises(ValueError, match="run_artifacts.parser_name"):
        receiver.tables(spark, str(tmp_path / "bad.db"))


def test_library_process(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"))
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)
    raw = raw.withColumn("composition", F.when(F.col("sku") == "sku-0", "сахар"))
    out = library.process(raw, ["observed_at", "product_id"]).collect()
    assert len(out) == 3 and len({r.canonical_product_id for r in out}) == 1
    assert all(r.composition == "сахар" and r.image_urls == ["http://h/images/a.webp"] and r.duplicate_image_urls == [] and len(r.image_fingerprints) == 1 for r in out)


def test_store_runs_and_conflicts(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    base, rows = store.manifest(), lambda a, b, v: spark.range(a, b).selectExpr("id", f"'{v}' AS v")
    store.commit({"t": (rows(0, 40_000, "a"), ["id"])}, base, {"p": ("2026", 2)})
    with pytest.raises(Conflict):
        store.commit({"t": (rows(0, 5, "x"), ["id"])}, base)
    assert store.table("t").count() == 40_000
    store.commit({}, store.manifest(), {"p": ("2025", 9)})
    assert store.cursor("P") == ("2026", 2)
    for k in range(6):
        store.commit({"t": (rows(39_998, 40_002, str(k)), ["id"])}, store.manifest())
    held = store.manifest()["tables"]["t"]
    assert len(held["runs"]) == 2 and {r.v: r["count"] for r in store.table("t").groupBy("v").count().collect()} == {"a": 39_998, "5": 4}
    assert store.vacuum() > 0 and store.table("t").count() == 40_002
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise Conflict("busy")
        return "done"

    assert with_retries(flaky, first=0.01) == "done" and len(calls) == 3
    with pytest.raises(ValueError):
        with_retries(lambda: (_ for _ in ()).throw(ValueError("not retried")))


def test_stream_applies_batches_once(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"))
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)
    raw.write.parquet(f"file://{tmp_path}/raw")
    store = Store(spark, f"file://{tmp_path}/cat")
    for _ in range(2):
        q = sync.stream(spark.readStream.schema(raw.schema).parquet(f"file://{tmp_path}/raw"), store, "q", f"file://{tmp_path}/ck")
        q.awaitTermination(120)
    assert store.table("projection").count() == 3 and store.manifest()["version"] == 1


def test_outbox_cycle(spark):
    q = outbox.enqueue(spark.createDataFrame([("http://h/images/a.webp",), ("http://h/images/a.webp",), ("http://x/images/b.webp",), (None,)], "url string"), None, "2026-01-01 00:00:00")
    q, n = outbox.drain(q, "http://h", lambda name: name == "a.webp", "2026-01-01 00:00:01")
    assert n == {"processed": 2, "deleted": 1, "failed": 1}
    left = {r.url: (r.status, r.attempts) for r in q.collect()}

    def broken(name):
        raise OSError(name)

    assert outbox.drain(q.withColumn("status", F.lit("pending")), "http://h", broken, "2026-01-01 00:00:05")[1] == {"processed": 2, "deleted": 0, "failed": 2}
    assert left == {"http://h/images/a.webp": ("done", 0), "http://x/images/b.webp": ("pending", 1)}
    assert outbox.eligible(q, "2026-01-01 00:00:01").count() == 0 and outbox.eligible(q, "2026-01-01 00:00:02").count() == 1


def test_http_delete():
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_DELETE(self):  # noqa: N802
            seen.append((self.path, self.headers["Authorization"]))
            self.send_response(404 if "gone" in self.path else 500 if "bad" in self.path else 204)
            self.end_headers()

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = outbox.StorageClient(f"http://127.0.0.1:{server.server_port}/", "key", 2)
    assert [client(n) for n in ("a b+c.webp", "gone.webp", "bad.webp")] == [True, True, False]
    strict = outbox.StorageClient.from_env({"SHELFMARK_STORAGE_BASE_URL": " ", "STORAGE_BASE_URL": client.base, "STORAGE_API_TOKEN": "key", "SHELFMARK_STORAGE_DELETE_STRICT": "Yes", "SHELFMARK_STORAGE_DELETE_TIMEOUT_SEC": "soon"})
    assert strict.strict and strict.timeout == 10.0 and outbox.StorageClient.from_env({"STORAGE_BASE_URL": "http://h"}) is None
    with pytest.raises(RuntimeError, match="500"):
        strict("bad.webp")
    server.shutdown()
    assert seen[0] == ("/api/images/a%20b%2Bc.webp", "Bearer key")
    assert not outbox.StorageClient("http://127.0.0.1:1", "key", 0.2)("a.webp")


def test_migration_defaults(spark):
    old = spark.sql("SELECT 7L AS id, timestamp '2026-01-01' AS observed_at, 1.23456D AS price")
    r = migration.from_single(old).first()
    assert (r.source_id, r.parser_name, str(r.price), r.valid_from_at) == ("generated:7", "unknown", "1.2346", r.observed_at)
    validate_money(migration.from_single(old), "snapshots")
    with pytest.raises(ValueError):
        validate_money(old, "snapshots")


def test_migration_from_split_tables_and_swap(spark, tmp_path):
    events = spark.sql("SELECT 1L AS id, 'u1' AS source_event_uid, timestamp '2026-01-02' AS observed_at, cast(NULL AS timestamp) AS created_at, 3 AS receiver_sort_order UNION ALL SELECT 2L, 'u2', timestamp '2026-01-03', timestamp '2026-01-04', NULL")
    snaps = spark.sql("SELECT 1L AS id, 5.55555D AS price, 7D AS available_count UNION ALL SELECT 2L, NULL, 8D")
    counts = spark.sql("SELECT 1L AS snapshot_id, 9D AS available_count, timestamp '2026-01-05' AS created_at")
    got = {r.id: r for r in migration.from_split(events, snaps, counts).collect()}
    assert [(got[k].available_count, str(got[k].created_at.date()), got[k].receiver_sort_order) for k in (1, 2)] == [(9.0, "2026-01-05", 3), (8.0, "2026-01-04", None)] and str(got[1].price) == "5.5556"
    assert {r.id: str(r.created_at.date()) for r in migration.from_split(events).collect()} == {1: "2026-01-02", 2: "2026-01-04"}
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit({"snapshots": (spark.range(9), []), "old_counts": (spark.range(3), [])}, store.manifest())
    migration.swap(store, migration.from_split(events, snaps, counts), legacy=("old_counts",))
    assert store.table("snapshots").count() == 2 and store.table("old_counts") is None
    assert {r.source_id: str(r.last_seen.date()) for r in store.table("sources").collect()} == {"generated:1": "2026-01-02", "generated:2": "2026-01-03"}
    with pytest.raises(ValueError, match="u1"):
        migration.swap(store, migration.from_split(events.union(events.where("id = 1"))))


def test_sync_goes_on_after_swap(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"), 2)
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)
    store = Store(spark, f"file://{tmp_path}/cat")
    one = raw.where("sku = 'sku-0'")
    sync.apply_chunk(store, one)
    old = spark.sql("SELECT 7L AS id, 'fixprice' AS parser_name, 'receiver:run-0:100' AS source_id, 'old-event' AS source_event_uid, timestamp '2026-02-26 10:00:00' AS observed_at, 199.9D AS price, 'RUB' AS price_unit, 12D AS available_count")
    migration.swap(store, migration.from_single(old))
    assert store.table("snapshots").count() == 1
    shared = identity.shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(shared))
    got = sync.apply_chunk(store, raw)
    # the migrated snapshot goes on, as its prices are the record's; the other record is new
    assert (got["inserted"], got["reused"]) == (1, 1)
    rows = {r.source_id: r for r in store.table("snapshots").collect()}
    assert len(rows) == 2 and str(rows["receiver:run-0:100"].valid_from.date()) == "2026-02-26" and str(rows["receiver:run-0:100"].valid_to.date()) == "2026-02-27"
    # what a chunk cut is gone
    assert not {f for f in set(os.listdir(shared)) - before if f.startswith("cut-")}


def test_backfill_counts_earlier_rows_and_stored_ones(spark):
    rows = [("k", 1, "2026-01-01", None), ("k", 2, "2026-01-02", "b"), ("k", 3, "2026-01-02", None), ("k", 4, "2026-01-05", None), ("k", 5, "2026-01-06", "c")]
    d = spark.createDataFrame(rows, "k string, i int, t string, v string").withColumn("t", F.col("t").cast("timestamp"))
    fill = lambda **more: {r.i: r.v for r in history.backfill(d, ["k"], "t", "i", ["v"], **more).collect()}
    assert fill() == {1: "b", 2: "b", 3: "b", 4: "c", 5: "c"}
    assert fill(past_only=True) == {1: None, 2: "b", 3: "b", 4: "b", 5: "c"}
    known = spark.createDataFrame([("k", "2026-01-04", "s")], "k string, t string, v string").withColumn("t", F.col("t").cast("timestamp"))
    assert fill(past_only=True, known=known) == {1: "s", 2: "b", 3: "b", 4: "s", 5: "c"}


def test_every_parser_has_its_cursor(spark, tmp_path):
    src = str(tmp_path / "r.sqlite")
    receiver_file(src, 3)
    db = sqlite3.connect(src)
    db.execute("UPDATE run_artifacts SET parser_name = 'chizhik', ingested_at = '2026-01-01T00:00:00+00:00' WHERE id = 11")
    db.commit()
    cat = f"file://{tmp_path}/cat"
    assert sync.run(spark, sync.SyncJob(src, cat, "fixprice")) == {"batches": 1, "records": 2}
    # a parser that lags behind the others' cursors isn't skipped
    assert sync.run(spark, sync.SyncJob(src, cat)) == {"batches": 1, "records": 1}
    db.execute("UPDATE run_artifacts SET parser_name = 'newshop' WHERE id = 12")
    db.commit()
    with pytest.raises(KeyError, match="newshop"):
        sync.run(spark, sync.SyncJob(src, cat))


def test_replay_changes_nothing_and_gaps_are_filled_from_the_store(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"))
    store = Store(spark, f"file://{tmp_path}/cat")
    t = receiver.tables(spark, str(tmp_path / "r.sqlite"))
    raw = receiver.records(t, 100).withColumn("composition", F.when(F.col("sku") == "sku-0", "сахар"))
    one = lambda sku: raw.where(F.col("sku") == sku)
    first = sync.apply_chunk(store, one("sku-0"), now="2026-03-01 00:00:00")
    assert (first["inserted"], first["reused"], first["upserted"]) == (1, 0, 1) and first["chunks"][0].startswith("fixprice:2026-02-27T12:00:00+00:00:100:")
    before = {n: sorted(map(str, store.table(n).collect())) for n in store.manifest()["tables"]}
    again = sync.apply_chunk(store, one("sku-0"), now="2026-03-01 00:00:00")
    assert (again["inserted"], again["reused"]) == (0, 1)
    same = ["snapshots", "sources", "projection", "assets", "links", "categories", "settlements", "geo_points", "identity_map", "outbox"]
    assert all(sorted(map(str, store.table(n).collect())) == before[n] for n in same)
    sync.apply_chunk(store, one("sku-1"), backfill=True)
    sync.apply_chunk(store, one("sku-2"))
    rows = {r.sku: r for r in store.table("projection").collect()}
    assert (rows["sku-0"].composition, rows["sku-1"].composition, rows["sku-2"].composition) == ("сахар", "сахар", None)
    assert str(rows["sku-0"].price) == "199.9000" and rows["sku-0"].primary_category_key == "fixprice:uid:c1" and rows["sku-0"].settlement_key == "россия|московская|москва" and len(store.table("projection").columns) == 37
    assert '"run_id":"run-0"' in store.table("snapshots").orderBy("valid_from").first().payload


def test_outbox_of_the_store_is_drained(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert sync.drain_outbox(store, lambda name: True, "http://h")["processed"] == 0
    urls = spark.createDataFrame([("http://h/images/a%20b.webp",), ("http://h/images/c.webp",)], "url string")
    store.commit({"outbox": (outbox.enqueue(urls, None, "2026-01-01 00:00:00"), ["dedupe_key"])}, store.manifest())
    assert sync.drain_outbox(store, lambda name: name == "a b.webp", "http://h", now="2026-01-01 00:00:01") == {"processed": 2, "deleted": 1, "failed": 1}
    assert {r.url: (r.status, r.attempts) for r in store.table("outbox").collect()} == {"http://h/images/a%20b.webp": ("done", 0), "http://h/images/c.webp": ("pending", 1)}


def test_layout_and_filters(spark, tmp_path):
    src = str(tmp_path / "r.sqlite")
    receiver_file(src)
    t = receiver.tables(spark, src)
    receiver.lay_out(t, f"file://{tmp_path}/p")
    laid = receiver.tables(spark, f"file://{tmp_path}/p")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    pushed = receiver.tables(spark, src)
    assert pushed["run_artifacts"].where("id > 10").count() == 2
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    a, b = (sorted(map(str, receiver.records(x, 0).collect())) for x in (t, laid))
    assert a == b and len(a) == 3 and ports.TableReceiver(spark, src).fetch_batch(1, "fixprice", (" ", 0)).count() == 1
    reader = receiver.FilteringSqliteReader(src, "run_artifacts", t["run_artifacts"].schema, 1)
    assert not list(reader.pushFilters([receiver.GreaterThan(("id",), 10)])) and sum(1 for _ in reader.read(reader.partitions()[0])) == 2
    with pytest.raises(ValueError, match="MySQL"):
        ports.open_catalog(spark, "mysql://h/db")


def test_engine_steps_can_be_replaced(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"))
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)
    engine = library.Engine(resolve=lambda d, order, known: d.withColumn("canonical_product_id", F.col("sku")), fingerprint=lambda url: F.lit("same"), backfilled=[])
    assert {(r.canonical_product_id, r.image_fingerprints[0]) for r in engine.process(raw, ["observed_at", "product_id"]).collect()} == {(f"sku-{k}", "same") for k in range(3)}


def test_daemon_stops():
    d = daemon_cli.Daemon(lambda parser: {"batches": 1, "records": 1}, [None], 0.1, lambda: {"processed": 1, "deleted": 1})
    d.start()
    d.stop()
    m = d.snapshot()
    assert not m["running"] and m["cycles"] == m["outbox_deleted"] >= 1 and len(m) == 17


def test_daemon_recovers():
    calls = []

    def work(parser):
        calls.append(parser)
        if len(calls) == 1:
            raise RuntimeError("down")
        return {"batches": 1, "records": 2}

    drained = []
    m = daemon_cli.poll(work, ["a", "b"], 0.1, 3, lambda: drained.append(1), sleep=lambda _: None)
    assert (m.failed, m.succeeded, m.records, calls, len(drained)) == (1, 2, 4, ["a", "b", "a"], 2) and "down" in m.last_error
