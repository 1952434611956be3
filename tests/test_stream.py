"""The receiver as a stream, bad records, reading by page, and the database sinks."""

from __future__ import annotations

import os
import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import history, identity
from shelfmark.operators.store import Store
from shelfmark.plans import catalogue
from shelfmark.sinks import database
from shelfmark.sources import receiver
from shelfmark.sources.receiver_stream import ReceiverStreamReader, arrivals
from shelfmark.streaming import state, sync
from test_catalogue import receiver_file


def add_product(path, artifact, product, at, parser="fixprice"):
    db = sqlite3.connect(path)
    db.execute("INSERT INTO run_artifacts (id, run_id, parser_name, ingested_at) VALUES (?, ?, ?, ?)", (artifact, f"run-{artifact}", parser, at))
    db.execute("INSERT INTO run_artifact_products (id, artifact_id, sku, title, price) VALUES (?, ?, ?, 'Чай', 10.0)", (product, artifact, f"sku-{product}"))
    db.commit()
    db.close()


def test_offsets_admit_a_limit_and_go_on(tmp_path):
    path = str(tmp_path / "r.sqlite")
    receiver_file(path, 5)
    add_product(path, 90, 900, "2026-02-27T15:01:00+03:00")  # the instant of product 101
    add_product(path, 91, 901, "never")
    options = {"path": path, "limit": "2", "parts": "3"}
    reader, seen, start = ReceiverStreamReader(options), [], None
    start = reader.initialOffset()
    while (end := reader.latestOffset()) != start:
        batch = sorted(r[0] for p in reader.partitions(start, end) for r in reader.read(p))
        seen.append(batch)
        start = end
    assert seen == [[100, 101], [102, 900], [103, 104]]
    assert reader.partitions(end, end) == []
    # a reader that starts again is given its last batch first, and goes on behind it
    again = ReceiverStreamReader(options)
    again.partitions(reader.initialOffset(), {"at": 1772193660000, "id": 101})
    assert again.latestOffset() == {"at": 1772193720000, "id": 102}
    assert ReceiverStreamReader(options | {"parser": "Chizhik"}).latestOffset() == reader.initialOffset()


def test_stream_restarts_without_loss_or_repeats(spark, tmp_path):
    path, out, checkpoint = str(tmp_path / "r.sqlite"), f"file://{tmp_path}/out", f"file://{tmp_path}/ck"
    receiver_file(path, 5)

    def go(n):
        source = arrivals(spark, path, "fixprice", 2, 2)
        query = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, k: df.withColumn("batch", F.lit(k)).write.mode("append").parquet(out)).start()
        for _ in range(240):
            if os.path.isdir(f"{tmp_path}/out") and spark.read.schema("product_id long").parquet(out).count() >= n:
                break
            query.awaitTermination(1)
        query.stop()
        return sorted((r.product_id, r.batch) for r in spark.read.parquet(out).collect())

    assert go(5) == [(100, 0), (101, 0), (102, 1), (103, 1), (104, 2)]
    add_product(path, 90, 900, "2026-03-01T00:00:00Z")
    assert go(6)[-1] == (900, 3)


def test_streamed_receiver_equals_run(spark, tmp_path):
    path = str(tmp_path / "r.sqlite")
    receiver_file(path, 3)
    stores = [Store(spark, f"file://{tmp_path}/{n}") for n in ("a", "b")]
    sync.run(spark, sync.SyncJob(path, stores[0].root, "fixprice", batch_size=2))
    query = sync.stream_receiver(spark, sync.SyncJob(path, stores[1].root, "fixprice", batch_size=2), f"file://{tmp_path}/ck")
    for _ in range(200):
        if query.exception() or (stores[1].cursor("fixprice") or (0, 0))[1] == 102:
            break
        query.awaitTermination(1)
    query.stop()
    assert query.exception() is None
    for name in ("projection", "snapshots", "sources", "identity_map", "assets"):
        a, b = (sorted(map(str, s.table(name).drop("created_at", "updated_at").collect())) for s in stores)
        assert a == b and a
    assert stores[0].cursor("fixprice") == stores[1].cursor("fixprice")


def test_bad_records_are_kept_apart(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"), 3)
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)
    bad = raw.withColumn("price", F.when(F.col("sku") == "sku-1", F.lit(1e12)).otherwise(F.col("price"))).withColumn("parser_name", F.when(F.col("sku") == "sku-2", F.lit("newshop")).otherwise(F.col("parser_name")))
    store = Store(spark, f"file://{tmp_path}/cat")
    got = sync.apply_chunk(store, bad)
    assert (got["quarantined"], got["records"], got["inserted"]) == (2, 1, 1)
    rows = {r.source_id: r for r in store.table("quarantine").collect()}
    assert {k: r.reason for k, r in rows.items()} == {"receiver:run-1:101": "price is no decimal(12,4)", "receiver:run-2:102": "no handler for its parser"}
    assert '"sku":"sku-1"' in rows["receiver:run-1:101"].record
    assert [r.sku for r in store.table("projection").collect()] == ["sku-0"] and store.cursor("fixprice")[1] == 101


def test_pages_prune_what_was_laid_out(spark, tmp_path):
    path = str(tmp_path / "r.sqlite")
    receiver_file(path, 4)
    add_product(path, 90, 900, "2026-02-27T12:01:30Z", "chizhik")
    t = receiver.tables(spark, path)
    receiver.lay_out(t, f"file://{tmp_path}/p")
    laid = receiver.tables(spark, f"file://{tmp_path}/p")
    args = (2, "fixprice", ("2026-02-27 12:01:00", 100))
    names = ("run_artifact_products", "run_artifacts", "run_artifact_administrative_units")
    page = receiver.page(*[laid[n] for n in names], *args)
    plan = page._jdf.queryExecution().toString()
    scan = next(x for x in plan.split("== Physical Plan ==")[1].split("\n") if "ingested_at" in x and "FileScan" in x)
    assert "PartitionFilters: [isnotnull(parser" in scan and "(parser" in scan and "GreaterThanOrEqual(at_micros" in scan
    want = receiver.page(*[t[n] for n in names], *args)
    ids = lambda d: [r.id for r in d.select("product.id").orderBy("id").collect()]
    assert ids(page) == ids(want) == [101, 102]


def test_sqlite_sink_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out.db")
    rows = spark.range(0, 50, 1, 4).select("id", (F.col("id") * 1.5).cast("decimal(12,4)").alias("price"), F.array(F.col("id")).alias("list"), F.lit("2026-01-01").cast("timestamp").alias("at"))
    database.to_sqlite(rows, path, "t", ["id"], "b1")
    db = sqlite3.connect(path)
    count = lambda where="1": db.execute(f"SELECT count(*), max(price) FROM t WHERE {where}").fetchone()
    assert count()[0] == 50 and db.execute("SELECT * FROM t WHERE id = 3").fetchone() == (3, "4.5000", "[3]", "2026-01-01 00:00:00")
    # a task that fails leaves nothing
    broken = rows.withColumn("price", F.when(F.col("id") == 40, F.raise_error(F.lit("broken")).cast("decimal(12,4)")).otherwise(F.lit(0.1).cast("decimal(12,4)")))
    with pytest.raises(Exception, match="broken"):
        database.to_sqlite(broken, path, "t", ["id"], "b2")
    assert count("price = '0.1000'")[0] == 0
    assert os.listdir(tmp_path) == ["out.db"]
    # keys replace, and a batch of one name counts once
    database.to_sqlite(rows.where("id < 2").withColumn("price", F.lit(7).cast("decimal(12,4)")), path, "t", ["id"], "b2")
    database.to_sqlite(rows.withColumn("price", F.lit(9.1).cast("decimal(12,4)")), path, "t", ["id"], "b2")
    assert count()[0] == 50 and count("price = '7.0000'")[0] == 2 and count("price = '9.1000'")[0] == 0
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit({"t": (rows.drop("list"), ["id"]), "other": (spark.range(2), [])}, store.manifest())
    assert database.mirror(store, str(tmp_path / "mirror.db"), ["t"]) == {"t": 50}


def test_jdbc_sink_replaces_in_one_transaction(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/derby;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(5).select("id", F.lit("a").alias("v"))
    rows.write.format("jdbc").options(url=url, dbtable="t", **driver).save()
    database.to_jdbc(spark.range(3, 8).select("id", F.lit("b").alias("v")), url, "t", ["id"], driver)
    read = lambda: {r.id: r.v for r in spark.read.format("jdbc").options(url=url, dbtable="t", **driver).load().collect()}
    assert read() == {0: "a", 1: "a", 2: "a", 3: "b", 4: "b", 5: "b", 6: "b", 7: "b"}
    with pytest.raises(Exception):  # noqa: B017
        database.to_jdbc(spark.range(2).select("id", F.lit("c").alias("missing_column")), url, "t", ["id"], driver)
    assert read()[0] == "a"


def test_state_of_runs_goes_on_after_restarts(spark, tmp_path):
    """Three starts over growing input give what one batch gives, and the state holds one row a source."""
    rows = [(f"s{k % 5}" if k % 11 else None, k, f"2026-01-01 00:{k:02d}:00", ["a", "a", "b", None][(k // 5) % 4]) for k in range(50)]
    d = spark.createDataFrame(rows, "source string, id long, at string, fp string").withColumn("at", F.col("at").cast("timestamp"))
    for part in range(3):
        d.where(f"id BETWEEN {part * 20} AND {part * 20 + 19}").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        source = spark.readStream.schema(d.schema).parquet(f"file://{tmp_path}/in")
        size = state.run_stream(source, f"file://{tmp_path}/s", ["source"], ["at", "id"], "fp", "at")
    assert size["rows"] == 6 and size["bytes"] > 0
    names = ["source", "snapshot_no", "fp", "valid_from", "valid_to", "n_rows"]
    got = sorted(map(str, state.current_runs(spark, f"file://{tmp_path}/s", ["source"]).select(names).collect()))
    want = sorted(map(str, history.snapshots(d, ["source"], ["at", "id"], "fp", "at").select(names).collect()))
    assert got == want and len(got) > 10


def test_catalogs_of_another_layout_are_refused(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/cat")
    store.commit({"images": (spark.range(1).selectExpr("'f' AS fingerprint", "id AS canonical_url"), ["fingerprint"]), "own": (spark.range(1), [])}, store.manifest())
    with pytest.raises(ValueError, match="images.n_uses is missing; images.canonical_url is bigint, not string"):
        sync.check_catalog(store)


def test_run_takes_any_receiver(spark, tmp_path):
    receiver_file(str(tmp_path / "r.sqlite"), 2)
    raw = receiver.records(receiver.tables(spark, str(tmp_path / "r.sqlite")), 100)

    class Own:
        def fetch_batch(self, limit, parser_name=None, after=None):
            return raw if after is None else raw.limit(0)

        def parser_names(self):
            return ["fixprice"]

    assert sync.run(spark, sync.SyncJob("", f"file://{tmp_path}/cat"), source=Own()) == {"batches": 1, "records": 2}
    assert database.mirror(Store(spark, f"file://{tmp_path}/cat"), str(tmp_path / "m.db"), ["projection", "links"]) == {"projection": 2, "links": 4}
    db = sqlite3.connect(tmp_path / "m.db")
    assert db.execute("SELECT count(*), max(price) FROM projection").fetchone() == (2, "199.9000") and db.execute("SELECT count(*) FROM links").fetchone() == (4,)


def test_stream_projection_goes_by_batches_and_leaves_the_catalogue_only(spark, monkeypatch):
    batches, apply = [], sync.apply_chunk
    monkeypatch.setattr(catalogue, "BATCH_BYTES", 1)
    monkeypatch.setattr(catalogue, "FILE_RECORDS", 600)
    monkeypatch.setattr(sync, "apply_chunk", lambda *a, **k: batches.append(k["batch"]) or apply(*a, **k))
    shared = identity.shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(shared))
    d = "/root/testdata/sf0.001"
    out = catalogue.stream_projection(spark, d)
    c = duckdb.connect()
    for t in ("customer", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(c.execute(catalogue.SQL["stream_projection"]).fetchall(), key=str)
    assert len(batches) > 1
    new = set(os.listdir(shared)) - before
    assert [x.split("-")[0] for x in new] == ["stream"]
    at = f"{shared}/{new.pop()}"
    assert not os.path.exists(f"{at}/raw")
    assert len(os.listdir(f"{at}/catalog/_manifest")) <= 2  # the last one and its checksum
