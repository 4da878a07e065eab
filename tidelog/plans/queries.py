"""Driver queries over the synthetic tables; ``oracle.py`` has the same results in SQL.

``events`` is the change log (lsn = event_id + 1, key = user_id), ``customer`` the
table that changes are applied to, the others are snapshot sources.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import avro, position
from ..functions.pgtypes import format_numeric, key_value, oid_of, uuid_text
from ..operators import apply, changelog, routing, snapshot
from ..sources import catalog, pgoutput
from ..sources.catalog import Publications

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kind() -> Column:
    return F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")


def _lsn() -> Column:
    return (F.col("event_id") + 1).cast("bigint")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as change rows with both images."""
    image = F.struct(F.col("user_id"), F.col("value"))
    return _table(spark, sf_dir, "events").select(
        _lsn().alias("lsn"), _kind().alias("kind"), F.lit("events").alias("relation"),
        F.when(F.col("event_type") == "error", image).alias("old"), F.when(F.col("event_type") != "error", image).alias("new"),
    )


def _flat(spark: SparkSession, sf_dir: str, key: str, value: str) -> DataFrame:
    """Change records with the key and value as columns."""
    return _table(spark, sf_dir, "events").select(
        _lsn().alias("lsn"), changelog.operation(_kind()).alias("operation"), F.col("user_id").alias(key), F.col("value").alias(value)
    )


def snapshot_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = snapshot.snapshot(_table(spark, sf_dir, "orders"), "orders", "o_orderkey")
    return recs.select("after.*").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def snapshot_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = position.Position(position.PositionType.SNAPSHOT, {"orders": position.SnapshotPosition(5000, 10000)})
    return snapshot.snapshot(_table(spark, sf_dir, "orders"), "orders", "o_orderkey", at).select("after.o_orderkey", "after.o_totalprice")


def snapshot_end_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    return snapshot.snapshot_ends(
        {"orders": (_table(spark, sf_dir, "orders"), "o_orderkey"), "customer": (_table(spark, sf_dir, "customer"), "c_custkey"), "part": (part, "p_partkey"), "empty": (part.where("p_partkey < 0"), "p_partkey")}
    )


def snapshot_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    out = None
    for name, key in keys.items():  # key columns only: the scans read nothing else
        recs = snapshot.snapshot(_table(spark, sf_dir, name).select(key), name, key)
        one = recs.select("collection", key_value(F.col(f"key.{key}")).alias("k"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("collection").agg(F.count("*").alias("n"), F.min("k").alias("first_key"), F.max("k").alias("last_key"))


def snapshot_fetch_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.pages(_table(spark, sf_dir, "orders"), "o_orderkey", 512)


def snapshot_position_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = snapshot.snapshot(_table(spark, sf_dir, "customer").select("c_custkey"), "customer", "c_custkey")
    return recs.select("key.c_custkey", "position")


def snapshot_key_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = snapshot.snapshot(_table(spark, sf_dir, "nation"), "nation", "n_nationkey")
    return recs.select(key_value(F.col("key.n_nationkey")).alias("last_read"), F.col("key.n_nationkey").alias("key"), "after.n_name")


def table_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.key_uniqueness(
        {"orders": (_table(spark, sf_dir, "orders"), "o_orderkey"), "lineitem": (_table(spark, sf_dir, "lineitem"), "l_orderkey"), "events": (_table(spark, sf_dir, "events"), "event_id")}
    )


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = changelog.records(_changes(spark, sf_dir), "user_id")
    return recs.select("lsn", "operation", "collection", F.col("key.user_id").alias("key"), F.col("after.value").alias("after_value"))


def cdc_resume_after_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = changelog.records(changelog.after_lsn(_changes(spark, sf_dir), 4000), "user_id")
    return recs.select("lsn", "operation", "key.user_id")


def cdc_start_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("event_id")
    return _table(spark, sf_dir, "events").select(start.alias("start_lsn"), position.start_lsn(start, F.lit(3000).cast("bigint")).alias("effective_lsn"))


def cdc_before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select(_lsn().alias("lsn"), "user_id", F.col("value").alias("after_value"), changelog.before_image(events, "user_id", "event_id", "value").alias("before_value"))


def cdc_delete_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = changelog.records(_changes(spark, sf_dir).where("kind = 'delete'"), "user_id", full_before=False)
    return recs.select("lsn", F.col("key.user_id").alias("key"), F.col("before.user_id").alias("before_user_id"), F.col("before.value").alias("before_value"))


def cdc_micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.micro_batches(_table(spark, sf_dir, "events"), "ts", "event_id", 4)


def _spread_lsn() -> Column:
    return F.col("event_id") * F.lit(1000003).cast("bigint")


def lsn_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", position.lsn_text(_spread_lsn()).alias("lsn"))


def lsn_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", position.lsn_value(position.lsn_text(_spread_lsn())).alias("lsn"))


def cdc_standby_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    flushed = e - e % 3 + F.when(e % 97 == 0, 1).otherwise(0)
    return _table(spark, sf_dir, "events").select("event_id", position.standby_status(e, flushed, e + e % 2).alias("status"))


def cdc_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _table(spark, sf_dir, "events").select(changelog.operation(_kind()).alias("operation"))
    return kinds.groupBy("operation").agg(F.count("*").alias("n"))


def apply_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _flat(spark, sf_dir, "user_id", "value").withColumnRenamed("operation", "op")
    return apply.last_per_key(recs, ["user_id"], F.col("lsn"), ["op", "lsn", "value"])


def apply_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    recs = _flat(spark, sf_dir, "c_custkey", "c_acctbal").where("operation <> 'delete'")
    return apply.apply_changes(target, recs, ["c_custkey"], ["c_acctbal"], ["lsn"], present=None, check=False)


def apply_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    deleted = _flat(spark, sf_dir, "c_custkey", "v").where("operation = 'delete'")
    return apply.delete_keys(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), deleted, ["c_custkey"])


def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a snapshot of ``customer`` with all changes of ``events`` applied.

    The change log holds whole rows of (key, value): of each key the last record
    decides, and names come from the target row, whatever came in between.
    """
    target = snapshot.snapshot(_table(spark, sf_dir, "customer"), "customer", "c_custkey").select("after.*")
    recs = _flat(spark, sf_dir, "c_custkey", "c_acctbal")
    last = apply.last_per_key(recs, ["c_custkey"], F.col("lsn"), ["operation", "c_acctbal"])
    deleted = F.col("operation") == "delete"
    net = last.select("c_custkey", "c_acctbal", (~deleted).alias("set_c_acctbal"), deleted.alias("deleted"), F.lit(False).alias("cleared"))
    return apply.merge(target.select("c_custkey", "c_name", "c_acctbal"), net, ["c_custkey"], ["c_acctbal"])


def append_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    recs = target.withColumn("operation", F.when(F.col("s_suppkey") % 2 == 0, "create").otherwise("snapshot"))
    return apply.apply_changes(target, recs, [], ["s_suppkey", "s_acctbal"], [], check=False)


def apply_null_key_creates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates whose key is null are appended, a row each; records with a key are merged."""
    target = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    recs = _flat(spark, sf_dir, "c_custkey", "c_acctbal").where("operation = 'create' or (operation = 'update' and c_custkey % 7 <> 0)")
    recs = recs.withColumn("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")))
    return apply.apply_changes(target, recs, ["c_custkey"], ["c_acctbal"], ["lsn"], present=None)


def apply_within_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty changes to a transaction: equal lsn, told apart by their place in it."""
    target = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    recs = _flat(spark, sf_dir, "c_custkey", "c_acctbal")
    recs = recs.withColumn("seq", F.col("lsn") % 50).withColumn("lsn", F.floor(F.col("lsn") / 50).cast("bigint"))
    return apply.apply_changes(target, recs, ["c_custkey"], ["c_acctbal"], ["lsn", "seq"], present=None)


def apply_partial_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks carry one column of two: the other keeps what it has, unless the row was deleted in between."""
    target = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("a"), (F.col("c_custkey") * 10).alias("b"))
    recs = _table(spark, sf_dir, "events").select(
        _lsn().alias("lsn"), changelog.operation(_kind()).alias("operation"), F.col("user_id").alias("k"), F.col("value").alias("a"), _lsn().alias("b"),
        F.when(F.col("event_type") == "click", F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("present"),
    )
    return apply.apply_changes(target, recs, ["k"], ["a", "b"], ["lsn"])


def apply_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes dealt to a table for each event type, each table keeping the last value of a key: (target_table, k, v)."""
    events = _table(spark, sf_dir, "events").select(_lsn().alias("lsn"), "event_type", F.col("user_id").alias("k"), F.col("value").alias("v"))
    recs = routing.routed(events, "{{ concat('events_', event_type) }}").withColumn("operation", F.lit("update"))
    target = spark.createDataFrame([], "target_table string, k bigint, v double")
    return apply.apply_changes(target, recs, ["target_table", "k"], ["v"], ["lsn"], present=None)


def route_by_table_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = routing.routed(_table(spark, sf_dir, "events").select("event_type"), "{{ concat('events_', event_type) }}")
    return recs.groupBy("target_table").agg(F.count("*").alias("n"))


def _price() -> Column:
    return F.col("o_totalprice").cast("decimal(18,4)")


def numeric_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", format_numeric(_price(), 1).cast("decimal(16,1)").alias("p"))


def numeric_scale_default_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", format_numeric(_price(), None, compat=True).cast("decimal(18,0)").alias("p"))


def numeric_many_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerics of 26 integer digits, rounded to one place."""
    wide = (F.col("o_orderkey") + 1).cast("decimal(12,0)") * F.lit(Decimal(10) ** 20) + (F.col("o_orderkey") % 100).cast("decimal(4,2)") / F.lit(Decimal("100.0"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", format_numeric(wide.cast("decimal(38,2)"), 1).cast("string").alias("p"))


def raw_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = routing.structured(F.col("props"), T.StructType([T.StructField("k", T.LongType())]))
    return _table(spark, sf_dir, "events").select("event_id", payload["k"].alias("k"))


def reject_missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _flat(spark, sf_dir, "k", "v").withColumn("k", F.nullif("k", F.lit(7)))
    return apply.rejected(recs, ["k"])


def snapshot_then_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot.snapshot(_table(spark, sf_dir, "customer"), "customer", "c_custkey")
    first = snap.select(F.lit(1).alias("pos_type"), F.col("key.c_custkey").alias("pos"), "operation", F.col("key.c_custkey").alias("k"), F.col("after.c_acctbal").alias("v"))
    then = _flat(spark, sf_dir, "k", "v").select(F.lit(2).alias("pos_type"), F.col("lsn").alias("pos"), "operation", "k", "v")
    return first.unionByName(then)


def uuid_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 10 != 0, F.unhex(F.md5(F.col("p_name").cast("binary"))))
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), uuid_text(raw, null_as_empty=True).alias("uuid"))


def quote_ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", catalog.quote_column(F.col("p_name")).alias("ident"))


def avro_schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, position, field, type) of the Avro payload schemas of all tables; -1 and no type for a table that has none."""
    rows = []
    for name in TABLES:
        try:
            schema = avro.from_spark(f"{name}_payload", _table(spark, sf_dir, name).schema)
        except avro.SchemaError:
            rows.append((name, -1, None, None))
            continue
        for i, f in enumerate(schema["fields"]):
            rows.append((name, i, f["name"], f["type"] if isinstance(f["type"], str) else f["type"]["logicalType"]))
    return spark.createDataFrame(rows, "tbl string, position int, field string, type string")


def publication_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(publication, tbl, n): the changes that each publication carries of its tables, here one for each event type."""
    p = Publications()
    p.create("browsing", ["events_click", "events_view"])
    p.create("business", ["events_purchase", "events_signup"])
    p.create("spare", ["events_error"])
    p.drop("spare")
    members = spark.createDataFrame([(n, t) for n, own in p.tables.items() for t in own], "publication string, tbl string")
    recs = routing.routed(_table(spark, sf_dir, "events").select("event_type"), "{{ concat('events_', event_type) }}")
    return recs.join(F.broadcast(members), recs["target_table"] == members["tbl"]).groupBy("publication", "tbl").agg(F.count("*").alias("n"))


def catalog_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, name): primary key columns, by the join of catalog rows; attributes are the tables' own."""
    frames = {t: _table(spark, sf_dir, t) for t in TABLES}
    attributes = spark.createDataFrame([(t, i + 1, c) for t, df in frames.items() for i, c in enumerate(df.columns)], "table string, number int, name string")
    numbers = lambda t, names: [frames[t].columns.index(n) + 1 for n in names]
    keys = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "events": ["event_id"], "conversations": ["conv_id", "turn"]}
    rows = [(t, numbers(t, own), True) for t, own in keys.items()] + [("orders", numbers("orders", ["o_custkey"]), False)]
    indexes = spark.createDataFrame(rows, "table string, numbers array<int>, is_primary boolean")
    out = None
    for t in keys:
        one = catalog.primary_keys(attributes, indexes, t).select(F.lit(t).alias("tbl"), "name")
        out = one if out is None else out.unionByName(one)
    return out


def _int_bytes(value: Column, size: int) -> Column:
    return F.unhex(F.lpad(F.hex(value), 2 * size, "0"))


def pgoutput_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as replication messages, a transaction a change, taken apart and typed again."""
    columns = [pgoutput.PgColumn("user_id", oid_of("int8"), -1, True), pgoutput.PgColumn("value", oid_of("float8"))]
    events = _table(spark, sf_dir, "events")
    field_ = lambda c: F.concat(F.lit(b"t"), _int_bytes(F.length(c.cast("string")), 4), c.cast("string").cast("binary"))
    row = F.concat(_int_bytes(F.lit(2), 2), field_(F.col("user_id")), field_(F.col("value")))
    begin = F.concat(F.lit(b"B"), _int_bytes(_lsn(), 8), _int_bytes(F.lit(0), 12))
    part = {"insert": b"N", "update": b"N", "delete": b"O"}
    change = F.lit(None).cast("binary")
    for kind, letter in (("insert", b"I"), ("update", b"U"), ("delete", b"D")):
        change = F.when(_kind() == kind, F.concat(F.lit(letter), _int_bytes(F.lit(7), 4), F.lit(part[kind]), row)).otherwise(change)
    commit = F.concat(F.lit(b"C\0"), _int_bytes(_lsn(), 8), _int_bytes(F.lit(0), 16))
    messages = events.select("event_id", F.posexplode(F.array(begin, change, commit)).alias("i", "data")).select((F.col("event_id") * 3 + F.col("i") + 1).alias("seq"), "data")
    relation = spark.createDataFrame([(0, bytearray(pgoutput.encode_relation(pgoutput.Relation(7, "public", "events", columns))))], "seq bigint, data binary")
    rows = pgoutput.with_context(pgoutput.decoded(relation.unionByName(messages)))
    recs = changelog.records(pgoutput.typed(rows, "events", columns), "user_id")
    return recs.select("lsn", "operation", F.col("key.user_id").alias("key"), F.col("after.value").alias("after_value"), F.col("before.value").alias("before_value"))


def stream_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's changes through Structured Streaming: merged by micro-batch, then compared with one batch."""
    from ..streaming.local import stream_parquet

    recs = f"{sf_dir}/events.parque[t]"  # a pattern: streams take folders or patterns, no single file
    schema = _table(spark, sf_dir, "events").schema
    state = stream_parquet(spark, recs, schema, lambda df: df.select(_lsn().alias("lsn"), changelog.operation(_kind()).alias("operation"), "user_id", "value"), ["user_id"], "lsn")
    target = snapshot.snapshot(_table(spark, sf_dir, "customer"), "customer", "c_custkey").select("after.*").select("c_custkey", "c_name", "c_acctbal")
    deleted = F.col("operation") == "delete"
    net = state.select(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"), (~deleted).alias("set_c_acctbal"), deleted.alias("deleted"), F.lit(False).alias("cleared"))
    return apply.merge(target, net, ["c_custkey"], ["c_acctbal"])


def stream_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot, then feed, as one stream: a third of the changes came before it began, a third while it ran, a third later.

    Those before are in the snapshot and don't come again. The stream stops after each part and goes on where it was.
    """
    from ..streaming.local import shared_path
    from ..streaming.pipeline import Pipeline, Target

    events = _table(spark, sf_dir, "events")
    third = events.count() // 3
    payload = F.when(F.col("event_type") != "error", F.to_json(F.struct(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"))))
    log = events.select("event_id", _lsn().alias("lsn"), _kind().alias("kind"), F.lit("customer").alias("relation"), F.col("user_id").alias("key"), payload.alias("payload"))
    path = shared_path(spark, "handover")
    schema = T.StructType([f for f in _table(spark, sf_dir, "customer").schema.fields if f.name in ("c_custkey", "c_name", "c_acctbal")])
    given = {"snapshot.customer": f"{sf_dir}/customer.parquet", "key.customer": "c_custkey", "changes": f"{path}/log"}
    for low, high in ((0, third), (third, 2 * third), (2 * third, None)):
        part = log.where(F.col("event_id") >= low) if high is None else log.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.drop("event_id").write.mode("append").parquet(f"{path}/log")
        Pipeline(spark, f"{path}/pipe", given, {"customer": Target(schema, ["c_custkey"])}).run_available()
    return Pipeline(spark, f"{path}/pipe", given, {}).table("customer").read()


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batches, rows) that a stream over the change log reports."""
    from ..streaming.local import stream_counts

    return stream_counts(spark, f"{sf_dir}/events.parque[t]", _table(spark, sf_dir, "events").schema)


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_initial, snapshot_resume, snapshot_end_bounds, snapshot_multi_table, snapshot_fetch_batches, snapshot_position_json, snapshot_key_coercion,
        table_key_lookup, cdc_records, cdc_resume_after_lsn, cdc_start_lsn, cdc_before_image, cdc_delete_key_only, cdc_micro_batches, lsn_format, lsn_roundtrip,
        cdc_standby_status, cdc_op_counts, apply_last_write_wins, apply_upsert, apply_delete, apply_changes, append_without_key, route_by_table_template,
        numeric_scale, numeric_scale_default_zero, raw_json_payload, reject_missing_key, snapshot_then_cdc, uuid_format, quote_ident, avro_schema_fields,
        publication_tables, stream_apply_changes, stream_progress, apply_null_key_creates, apply_within_transactions, apply_partial_updates, apply_routed,
        numeric_many_digits, catalog_primary_keys, pgoutput_decode, stream_handover,
    )
}
