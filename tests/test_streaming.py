import json

import pytest
from pyspark.sql import types as T

from tidelog.functions.pgtypes import PgColumn, oid_of
from tidelog.operators import asof
from tidelog.sources import jdbc, pgoutput
from tidelog.sources.hybrid import FeedError, HybridReader
from tidelog.sources.options import OptionsError
from tidelog.streaming.pipeline import Pipeline, Target, evolve
from tidelog.streaming.store import VersionedTable

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.IntegerType())])
CHANGES = "lsn long, kind string, relation string, key long, payload string"


def _change(lsn, kind, key, **payload):
    return (lsn, kind, "t", key, json.dumps(payload | {"id": key}))


@pytest.mark.parametrize("stretch", [1, 3, 1 << 16])
def test_pgoutput(spark, monkeypatch, stretch):
    monkeypatch.setattr(asof, "STRETCH", stretch)
    columns = [PgColumn("id", oid_of("int8"), -1, True), PgColumn("v", oid_of("text")), PgColumn("w", oid_of("int4"))]
    r = pgoutput.Relation(7, "public", "t", columns)
    wider = pgoutput.Relation(7, "public", "t", [*columns, PgColumn("x", oid_of("bool"))])
    feed = [
        pgoutput.encode_begin(100), pgoutput.encode_relation(r), pgoutput.encode_row("insert", 7, ["1", "a", None]), pgoutput.encode_commit(100),
        pgoutput.encode_begin(200), pgoutput.encode_row("update", 7, ["1", None, "5"], unchanged=(1,)), pgoutput.encode_row("delete", 7, old=["1", None, None]), pgoutput.encode_commit(200),
        b"T\0\0\0\1", b"Y",
        pgoutput.encode_begin(300), pgoutput.encode_relation(wider), pgoutput.encode_row("insert", 7, ["2", "b", "6", "t"]), pgoutput.encode_commit(300),
        pgoutput.encode_row("insert", 9, ["2"]),
    ]
    df = spark.createDataFrame(list(enumerate(map(bytearray, feed))), "seq long, data binary")
    rows = pgoutput.with_context(pgoutput.decoded(df))
    assert [r.relation_id for r in pgoutput.unknown_relations(rows).collect()] == [9]
    got = pgoutput.typed(rows, "t", wider.columns).orderBy("seq").collect()
    assert [(g.lsn, g.kind) for g in got] == [(100, "insert"), (200, "update"), (200, "delete"), (300, "insert")]
    assert tuple(got[0].new) == (1, "a", None, None) and got[1].unchanged == ["v"] and got[1].new.w == 5
    assert got[2].old.id == 1 and got[2].new is None and got[3].new.x is True
    with pytest.raises(pgoutput.FeedError):
        pgoutput.decode(b"I\0")
    assert pgoutput.decode(b"Y") is None


def test_versioned_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None and t.batch == -1
    for i in range(4):
        assert t.write(spark.range(i + 1).toDF("id"), i) == i
        assert t.read().count() == i + 1 and t.batch == i
    t.drop()
    assert t.read() is None


def _pipeline(spark, tmp_path, **options):
    given = {"snapshot.t": str(tmp_path / "t"), "key.t": "id", "changes": str(tmp_path / "log")} | options
    return Pipeline(spark, str(tmp_path / "pipe"), given, {"t": Target(SCHEMA, ["id"])})


def _rows(table):
    return sorted(map(tuple, table.read().collect()))


def test_pipeline_snapshot_then_changes_and_restart(spark, tmp_path):
    spark.createDataFrame([(i, f"v{i}", i) for i in range(0, 6)], SCHEMA).write.parquet(str(tmp_path / "t"))
    log = [_change(1, "insert", 7, v="new", w=1), _change(2, "update", 2, v="changed"), _change(3, "delete", 3), _change(4, "update", 2, w=9)]
    spark.createDataFrame(log, CHANGES).write.parquet(str(tmp_path / "log"))
    p = _pipeline(spark, tmp_path, batchSize="2", startLsn="0/0")
    p.run_available()
    want = [(1, "v1", 1), (2, "changed", 9), (4, "v4", 4), (5, "v5", 5), (7, "new", 1)]
    assert _rows(p.table("t")) == want
    # More changes, another run: it goes on after the last one.
    more = [_change(5, "delete", 7), _change(6, "insert", 3, v="back")]
    spark.createDataFrame(more, CHANGES).write.mode("append").parquet(str(tmp_path / "log"))
    again = _pipeline(spark, tmp_path, batchSize="2", startLsn="0/0")
    again.run_available()
    assert _rows(again.table("t")) == sorted([*want[:-1], (3, "back", None)])
    again.drop()
    assert again.table("t").read() is None


def test_hybrid_offsets(spark, tmp_path):
    spark.createDataFrame([(i, "x", i) for i in range(1, 11)], SCHEMA).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([_change(n, "insert", n) for n in (5, 6)], CHANGES).write.parquet(str(tmp_path / "log"))
    r = HybridReader({"snapshot.t": str(tmp_path / "t"), "key.t": "id", "changes": str(tmp_path / "log"), "fetchSize": "4"})
    start = r.initialOffset()
    assert start["position"] == '{"type":1,"snapshots":{"t":{"last_read":0,"snapshot_end":10}},"last_lsn":"0/6"}'  # the feed's end
    end = r.latestOffset()
    parts = r.partitions(start, end)
    assert [(p.low, p.high) for p in parts] == [(0, 4), (4, 8), (8, 10)]
    assert sum(b.num_rows for p in parts for b in r.read(p)) == 10
    assert r.latestOffset() == end  # nothing new in the feed
    spark.createDataFrame([_change(7, "insert", 7)], CHANGES).write.mode("append").parquet(str(tmp_path / "log"))
    later = r.latestOffset()
    assert later["position"] == '{"type":2,"last_lsn":"0/7"}'
    assert r.latestOffset() == later
    r.commit(end)
    r.commit(later)
    assert r.progress.flushed == 7
    few = HybridReader({"snapshot.t": str(tmp_path / "t"), "key.t": "id", "changes": str(tmp_path / "log"), "batch.size": "4", "startLsn": "0/0"})
    steps = [few.initialOffset()]
    while (x := few.latestOffset()) != steps[-1]:
        steps.append(x)
    assert [len(few.partitions(a, z)) for a, z in zip(steps, steps[1:], strict=False)] == [1, 1, 1, 1, 1]
    assert '"last_read":4,' in steps[1]["position"] and steps[-1]["position"] == '{"type":2,"last_lsn":"0/7"}'
    never = HybridReader({"changes": str(tmp_path / "log"), "snapshotMode": "never", "startLsn": "0/5"})
    assert never.initialOffset()["position"] == '{"type":2,"last_lsn":"0/5"}'
    assert sum(b.num_rows for p in never.partitions(never.initialOffset(), never.latestOffset()) for b in never.read(p)) == 2
    with pytest.raises(OptionsError, match='missing key for table "t"'):
        HybridReader({"snapshot.t": "x"})


def test_tables_of_a_folder_and_wrong_options(spark, tmp_path):
    for name in ("a", "b"):
        spark.createDataFrame([(i, "x", i) for i in (-2, 0, 3)], SCHEMA).write.parquet(str(tmp_path / "db" / name))
    given = {"url": str(tmp_path / "db"), "key.a": "id", "key.b": "id"}
    with pytest.raises(OptionsError):
        HybridReader(given | {"tables": "*", "snapshotMode": "sometimes"})
    given["url"] = f"file:{tmp_path}/db"
    every = HybridReader(given | {"tables": "*", "snapshot.includeNonpositiveKeys": "true"})
    assert sorted(every.tables) == ["a", "b"]
    parts = every.partitions(every.initialOffset(), every.latestOffset())
    assert sum(b.num_rows for p in parts for b in every.read(p)) == 6
    with pytest.raises(OptionsError, match='table "c" does not exist'):
        HybridReader(given | {"tables": "a,c"})


def test_feed_errors(spark, tmp_path):
    rows = [(5, "begin", "t", None, None), (5, "insert", "t", 1, "{}"), (6, "commit", "t", None, None)]
    spark.createDataFrame(rows, CHANGES).write.parquet(str(tmp_path / "log"))
    r = HybridReader({"changes": str(tmp_path / "log"), "startLsn": "0/1", "snapshotMode": "never"})
    with pytest.raises(FeedError, match="commit at 0/6"):
        [list(r.read(p)) for p in r.partitions(r.initialOffset(), r.latestOffset())]
    spark.createDataFrame([(5, "insert", None, 1, "{}")], CHANGES).write.parquet(str(tmp_path / "other"))
    r = HybridReader({"changes": str(tmp_path / "other"), "startLsn": "0/1", "snapshotMode": "never"})
    with pytest.raises(FeedError, match="no relation"):
        [list(r.read(p)) for p in r.partitions(r.initialOffset(), r.latestOffset())]


def test_binary_columns_and_routing_and_atomic_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("raw", T.BinaryType())])
    for name in ("t", "u"):
        spark.createDataFrame([(1, bytearray(b"\x00\xff" + name.encode()))], schema).write.parquet(str(tmp_path / name))
    spark.createDataFrame([_change(1, "insert", 1)], CHANGES).write.parquet(str(tmp_path / "log"))
    given = {f"snapshot.{n}": str(tmp_path / n) for n in "tu"} | {"key.t": "id", "key.u": "id", "changes": str(tmp_path / "log")}
    targets = {"to_t": Target(schema, ["id"]), "to_u": Target(schema, ["id"])}
    p = Pipeline(spark, str(tmp_path / "pipe"), given, targets, route="{{ concat('to_', collection) }}")
    p.run_available()
    assert [bytes(p.table(n).read().first().raw) for n in targets] == [b"\x00\xfft", b"\x00\xffu"]
    assert p.tables.versions() == {"to_t": 0, "to_u": 0}
    # One bad record: nothing of its batch reaches any table.
    log = [(8, "update", "t", 2, "{}"), (9, "update", "u", None, '{"raw": ""}')]
    spark.createDataFrame(log, CHANGES).write.mode("append").parquet(str(tmp_path / "log"))
    with pytest.raises(Exception, match="key must be provided"):
        p.run_available()
    assert p.tables.versions() == {"to_t": 0, "to_u": 0} and p.table("to_t").read().count() == 1
    lost = Pipeline(spark, str(tmp_path / "lost"), given, {"to_t": targets["to_t"]}, route="{{ concat('to_', collection) }}")
    with pytest.raises(Exception, match="no target for table to_u"):
        lost.run_available()


def test_evolve(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, old string"), spark.createDataFrame([(2, True)], "id int, new boolean")
    assert sorted(map(tuple, evolve([a, b]).collect())) == [(1, "x", None), (2, None, True)]


def test_jdbc(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(driver)
    c = jvm.java.sql.DriverManager.getConnection(url)
    s = c.createStatement()
    s.executeUpdate('CREATE TABLE T ("ID" BIGINT NOT NULL PRIMARY KEY, "V" VARCHAR(20), "W" INT)')
    s.executeUpdate("INSERT INTO T VALUES " + ", ".join(f"({i}, 'v{i}', {i})" for i in range(0, 20)))
    c.close()
    assert jdbc.primary_key(spark, url, "T", driver) == "ID"
    assert jdbc.greatest_key(spark, url, "T", "ID", driver=driver) == 19
    rows = jdbc.read_table(spark, url, "T", "ID", 0, 19, 4, driver=driver)
    assert rows.rdd.getNumPartitions() == 4 and rows.count() == 19
    plan = jdbc.read_table(spark, url, "T", "ID", 5, 9, 4, driver=driver)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ID,5)" in plan
    net = spark.createDataFrame([(1, "changed", 1, False), (2, None, None, True), (50, "new", 5, False), (60, None, None, True)], "ID long, V string, W int, deleted boolean")
    jdbc.apply_batch(net, url, "T", ["ID"], ["V", "W"], driver)
    after = {r.ID: r.V for r in jdbc.read_table(spark, url, "T", "ID", None, 100, driver=driver).collect()}
    assert after[1] == "changed" and 2 not in after and after[50] == "new" and 60 not in after and len(after) == 20
    # Columns that no change carries stay; those of a row that was deleted in between don't.
    shape = "ID long, V string, W int, set_V boolean, set_W boolean, deleted boolean, cleared boolean"
    net = spark.createDataFrame([(5, "only", None, True, False, False, False), (6, None, None, True, False, False, False), (7, "again", None, True, False, False, True)], shape)
    jdbc.apply_batch(net, url, "T", ["ID"], ["V", "W"], driver)
    after = {r.ID: (r.V, r.W) for r in jdbc.read_table(spark, url, "T", "ID", None, 100, driver=driver).collect()}
    assert after[5] == ("only", 5) and after[6] == (None, 6) and after[7] == ("again", None) and after[8] == ("v8", 8)
