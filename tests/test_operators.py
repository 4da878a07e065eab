import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.position import Position, PositionType, SnapshotPosition
from tidelog.operators import apply, changelog, routing, snapshot
from tidelog.operators.apply import ApplyError
from tidelog.operators.snapshot import SnapshotError
from tidelog.sources import catalog
from tidelog.sources.catalog import CatalogError
from tidelog.sources.options import OptionsError, SinkOptions, SourceOptions

SHAPE = "id long, a string, b int"


@pytest.fixture(scope="module")
def standard(spark):
    return spark.createDataFrame([(1, "foo", 1), (2, "bar", None), (3, "baz", 3), (4, None, None), (0, "zero", 0), (-3, "neg", 9)], SHAPE)


def test_snapshot_bounds(standard):
    rows = snapshot.snapshot(standard, "t", "id").orderBy("key.id").collect()
    assert [r.key.id for r in rows] == [1, 2, 3, 4]  # keys up to 0 are left out
    assert rows[0].position == '{"type":1,"snapshots":{"t":{"last_read":1,"snapshot_end":4}}}'
    assert rows[0].before is None and rows[0].after.a == "foo" and rows[0].operation == "snapshot"
    everything = snapshot.snapshot(standard, "t", "id", include_nonpositive=True)
    assert everything.count() == 6
    at = Position(PositionType.SNAPSHOT, {"t": SnapshotPosition(2, 3)})
    assert [r.key.id for r in snapshot.snapshot(standard, "t", "id", at).collect()] == [3]
    assert snapshot.snapshot(standard.where("false"), "t", "id").count() == 0


def test_snapshot_end(standard):
    assert snapshot.snapshot_end(standard, "id") == 4
    assert snapshot.snapshot_end(standard.where("false"), "id") == 0
    assert snapshot.cursor_text("t", "id", 10, 15) == 'SELECT * FROM t WHERE "id" > 10 AND "id" <= 15 ORDER BY "id"'


def test_snapshot_filter_reaches_the_scan(spark, standard, tmp_path):
    standard.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = snapshot.scan(df, "id", 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,1)" in plan and "LessThanOrEqual(id,3)" in plan


def test_snapshot_errors(standard):
    with pytest.raises(SnapshotError, match="table name is required\ntable key required"):
        snapshot.validate_request("", "", None)
    with pytest.raises(SnapshotError, match="invalid position type CDC"):
        snapshot.validate_request("t", "id", Position(PositionType.CDC))
    with pytest.raises(CatalogError, match='key "b2" not present on table "t"'):
        snapshot.snapshot(standard, "t", "b2")
    with pytest.raises(SnapshotError, match='(?s)"x".*"y"'):
        snapshot.snapshot_tables({"x": (standard, "a"), "y": (standard, "nope")})


def test_snapshot_tables(standard):
    other = standard.select(F.col("id").alias("k"), F.lit("x").alias("z"))
    rows = snapshot.snapshot_tables({"t": (standard, "id"), "u": (other, "k")}).collect()
    assert sorted({r.collection for r in rows}) == ["t", "u"] and len(rows) == 8
    assert snapshot.end_position({"t": (standard, "id")}).to_json() == '{"type":1,"snapshots":{"t":{"last_read":4,"snapshot_end":4}}}'


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_pages(spark, size):
    keys = random.Random(1).sample(range(1, 500), 60)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.batch: (r.n, r.lo, r.hi) for r in snapshot.pages(df, "k", size).collect()}
    s = sorted(keys)
    assert got == {i // size: (len(s[i : i + size]), s[i], s[i : i + size][-1]) for i in range(0, len(s), size)}


def test_records(spark):
    image = "struct<id:long,v:string>"
    rows = [
        (1, "begin", "t", None, None, None), (2, "insert", "t", None, (1, "a"), None), (3, "update", "t", (1, "a"), (1, "b"), None),
        (4, "update", "t", None, (1, None), ["v"]), (5, "delete", "t", (1, "b"), None, None), (6, "truncate", "t", None, None, None),
    ]
    df = spark.createDataFrame(rows, f"lsn long, kind string, relation string, old {image}, new {image}, unchanged array<string>")
    got = {r.lsn: r for r in changelog.records(df, "id", full_before=False).collect()}
    assert sorted(got) == [2, 3, 4, 5]
    assert got[2].operation == "create" and got[2].before is None and got[2].position == '{"type":2,"last_lsn":"0/2"}'
    assert got[3].before is None and got[3].after.v == "b"
    assert got[4].present == ["id"]
    assert got[5].operation == "delete" and got[5].before.id == 1 and got[5].before.v is None and got[5].after is None
    full = {r.lsn: r for r in changelog.records(df, "id").collect()}
    assert full[4].before is None and full[3].before.v == "a" and full[5].before.v == "b"


def test_key_change_is_delete_and_create(spark):
    image = "struct<id:long,v:string>"
    df = spark.createDataFrame([(3, "update", "t", (1, "a"), (2, "b"))], f"lsn long, kind string, relation string, old {image}, new {image}")
    rows = changelog.split_key_changes(changelog.records(df, "id", full_before=True)).orderBy("step").collect()
    assert [(r.operation, r.key.id) for r in rows] == [("delete", 1), ("create", 2)]


def test_commit_check(spark):
    df = spark.createDataFrame([(1, "begin", 10), (2, "insert", 0), (3, "commit", 10), (4, "begin", 20), (5, "commit", 21), ], "seq long, kind string, lsn long")
    assert [(r.lsn, r.final_lsn) for r in changelog.check_commits(df).collect()] == [(21, 20)]


RECS = "operation string, id long, a string, b int, present array<string>, n long"


def _apply(spark, target, recs):
    df = spark.createDataFrame(recs, RECS)
    out = apply.apply_changes(target, df, ["id"], ["a", "b"], ["n"])
    return {r.id: (r.a, r.b) for r in out.collect()}


def test_apply(spark, standard):
    both = ["id", "a", "b"]
    got = _apply(spark, standard, [
        ("update", 1, "new", None, ["id", "a"], 1), ("update", 1, None, 7, ["id", "b"], 2),  # partial updates add up
        ("update", 2, None, None, ["id", "a"], 3),  # an explicit null is a value
        ("delete", 3, None, None, None, 4), ("create", 3, "again", None, ["id", "a"], 5),  # nothing of the old row stays
        ("delete", 4, None, None, None, 6), ("delete", 99, None, None, None, 7),
        ("snapshot", 5, "five", 5, both, 8), ("update", 6, "six", 6, both, 9),
    ])
    assert got == {1: ("new", 7), 2: (None, None), 3: ("again", None), 5: ("five", 5), 6: ("six", 6), 0: ("zero", 0), -3: ("neg", 9)}


def test_creates_without_key_are_appended(spark, standard):
    df = spark.createDataFrame([("create", None, "x", 1, ["a", "b"], 1), ("create", None, "x", 1, ["a", "b"], 2), ("snapshot", None, "y", None, ["a"], 3), ("update", 1, "new", None, ["id", "a"], 4)], RECS)
    out = apply.apply_changes(standard, df, ["id"], ["a", "b"], ["n"])
    rows = out.where("id is null").collect()
    assert sorted((r.a, r.b or 0) for r in rows) == [("x", 1), ("x", 1), ("y", 0)] and out.count() == standard.count() + 3
    kept = apply.apply_changes(standard, spark.createDataFrame([("delete", 1, None, None, [], 1), ("create", 9, "z", 1, [], 2)], RECS), [], ["id", "a", "b"], [], check=False)
    assert kept.count() == standard.count() + 1  # deletes are never appended


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_order_inside_one_lsn(spark, standard, parts):
    recs = [("update", 1, f"v{i:02d}", i, ["id", "a", "b"], 5, i) for i in range(50)]
    random.Random(parts).shuffle(recs)
    df = spark.createDataFrame(recs, RECS + ", seq long").repartition(parts)
    out = apply.apply_changes(standard, df, ["id"], ["a", "b"], ["n", "seq"])
    assert out.where("id = 1").first().a == "v49"


def test_apply_rejects(spark, standard):
    with pytest.raises(ApplyError, match="key must be provided on update actions"):
        _apply(spark, standard, [("update", None, "x", 1, ["a"], 1)])
    with pytest.raises(ApplyError, match='invalid operation "upsert"'):
        _apply(spark, standard, [("upsert", 1, "x", 1, ["a"], 1)])


def _model(rows, recs):
    state = {r[0]: [r[1], r[2]] for r in rows}
    for op, k, a, b, present, _ in sorted(recs, key=lambda r: r[5]):
        if op == "delete":
            state.pop(k, None)
        else:
            own = state.setdefault(k, [None, None])
            if "a" in present:
                own[0] = a
            if "b" in present:
                own[1] = b
    return {k: tuple(v) for k, v in state.items()}


@pytest.mark.parametrize("seed", range(3))
def test_apply_in_batches_is_apply_at_once(spark, standard, seed):
    r = random.Random(seed)
    recs = []
    for n in range(60):
        op = r.choice(["create", "update", "update", "delete"])
        present = ["id"] + [c for c in "ab" if r.random() < 0.6]
        recs.append((op, r.randint(1, 8), r.choice("xyz") if "a" in present else None, r.randint(0, 9) if "b" in present else None, present if op != "delete" else [], n))
    rows = [tuple(x) for x in standard.collect()]
    want = _model(rows, recs)
    assert _apply(spark, standard, recs) == want
    cut = r.randint(5, 55)
    half = _apply(spark, standard, recs[:cut])
    middle = spark.createDataFrame([(k, *v) for k, v in half.items()], SHAPE)
    assert _apply(spark, middle, recs[cut:]) == want
    # Full rows: a suffix may come again without effect.
    full = [(o, k, a, b, ["id", "a", "b"] if o != "delete" else [], n) for o, k, a, b, _, n in recs]
    done = _apply(spark, standard, full)
    again = spark.createDataFrame([(k, *v) for k, v in done.items()], SHAPE)
    assert _apply(spark, again, full[cut:]) == done


def test_composite_keys_and_append(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    recs = spark.createDataFrame([("update", 1, 2, "c", 1), ("create", 2, 1, "d", 2)], "operation string, x int, y int, v string, n int")
    out = apply.apply_changes(target, recs, ["x", "y"], ["v"], ["n"], present=None)
    assert sorted(map(tuple, out.collect())) == [(1, 1, "a"), (1, 2, "c"), (2, 1, "d")]
    out = apply.apply_changes(target, recs.where("operation = 'create'"), [], ["x", "y", "v"], [])
    assert out.count() == 3
    keys = recs.select("x", "y")
    assert sorted(map(tuple, apply.insert_if_absent(target, keys, ["x", "y"]).collect())) == [(1, 1, "a"), (1, 2, "b"), (2, 1, None)]


def test_routing(spark):
    df = spark.createDataFrame([("click", "t"), ("view", "t")], "kind string, collection string")
    names = lambda o: {r.target_table for r in routing.routed(df, o).collect()}
    assert names("static") == {"static"}
    assert names("{{ concat('x_', kind) }}") == {"x_click", "x_view"}
    assert names("{{ collection }}") == {"t"}
    with pytest.raises(OptionsError, match="neither a valid static table nor a valid template"):
        routing.routed(df, "{{ broken")
    seen = {}
    routing.for_each_table(df, "{{ kind }}", lambda n, part: seen.update({n: part.count()}))
    assert seen == {"click": 1, "view": 1}


def test_structured(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, b'{"a": 9007199254740993, "b": "x"}'), (2, b""), (3, None)], "n int, raw binary")
    got = [r.s for r in df.orderBy("n").select(routing.structured(F.col("raw"), schema).alias("s")).collect()]
    assert got[0].a == 9007199254740993 and got[1].a is None and got[2].b is None
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        spark.createDataFrame([(b"{bad",)], "raw binary").select(routing.structured(F.col("raw"), schema)).collect()
    assert [c._jc.toString() for c in routing.columns_and_values({"id": F.col("id")}, {"id": F.col("id"), "v": F.col("v")})] == ["id AS id", "v AS v"]


def test_has_key(spark):
    df = spark.createDataFrame([({"a": 1},), ({},), (None,)], "m map<string,int>")
    assert [r[0] for r in df.select(routing.has_key(F.col("m"), df.schema["m"].dataType)).collect()] == [True, False, False]


def test_catalog(spark, standard):
    attributes = spark.createDataFrame([("t", 1, "id"), ("t", 2, "v"), ("u", 1, "x")], "table string, number int, name string")
    indexes = spark.createDataFrame([("t", [1], True), ("t", [2], False), ("u", [1], True)], "table string, numbers array<int>, is_primary boolean")
    assert [r.name for r in catalog.primary_keys(attributes, indexes, "t").collect()] == ["id"]
    assert catalog.single_key("t", ["id"]) == "id"
    with pytest.raises(CatalogError, match="composite keys are not supported"):
        catalog.single_key("t", ["a", "b"])
    with pytest.raises(CatalogError, match="no primary keys"):
        catalog.single_key("t", [])
    with pytest.raises(CatalogError, match='missing key for table "t2"'):
        catalog.require_keys(["t1", "t2"], {"t1": "id"})
    with pytest.raises(CatalogError, match='table "missing_table" does not exist'):
        catalog.check_table({"t": standard}, "missing_table", "id")
    with pytest.raises(CatalogError, match='key "column3" of type "boolean" is unsupported'):
        catalog.check_table({"t": standard.withColumn("column3", F.lit(True))}, "t", "column3")
    assert catalog.quote_ident('a"b') == '"a""b"'
    assert catalog.numeric_scale(T.StructType([T.StructField("n", T.DecimalType(16, 3))]), "n") == 3
    with pytest.raises(CatalogError):
        catalog.numeric_scale(T.StructType([T.StructField("n", T.BooleanType())]), "n")
    p = catalog.Publications()
    with pytest.raises(CatalogError, match='publication "testpub" requires at least one table'):
        p.create("testpub", [])
    assert p.create("testpub", ["a"])
    with pytest.warns(UserWarning, match="there already"):
        assert not p.create("testpub", ["b"])
    slots = spark.createDataFrame([("s1", "0/5", "0/1")], "slot string, confirmed_flush_lsn string, restart_lsn string")
    assert catalog.slot_state(slots, "s1")["restart_lsn"] == "0/1"
    with pytest.raises(CatalogError, match='no replication slot "s2"'):
        catalog.slot_state(slots, "s2")

    class Failed(Exception):
        sqlstate = catalog.DUPLICATE_OBJECT

    assert catalog.is_duplicate(Failed()) and not catalog.is_duplicate(ValueError())
    p.drop("testpub")
    p.drop("testpub", if_exists=True)
    with pytest.raises(CatalogError):
        p.drop("testpub")
    assert catalog.Publications.statement("p", ["a b", "c"], {"publish": "insert"}) == 'CREATE PUBLICATION "p" FOR TABLE "a b", "c" WITH (publish=\'insert\')'


def test_options():
    s = SourceOptions.parse({"url": "postgres://h/db", "tables": "a, b"})
    assert s.tables == ["a", "b"] and s.fetch_size == 50_000 and s.auto_cleanup and s.with_avro_schema
    with pytest.raises(OptionsError, match="(?s)url is required.*tables is required.*snapshotMode.*slot name"):
        SourceOptions(snapshot_mode="x", slot="Bad-Slot").validate()
    assert not SinkOptions(url="postgres://h/db", table="t").validate().is_template
