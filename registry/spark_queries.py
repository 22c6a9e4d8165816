"""One query per operator, over the whole given tables. Keys match ``duckdb_sql.ORACLES``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import HASH_COLUMN, col, safe_cast, zero_date_to_null
from tidemark.operators import cdc, changelog, export, history, keys, lineage, merge, metrics, partitions, projection
from tidemark.operators.models import build_model
from tidemark.plans import extracts, outbound, refresh
from tidemark.plans.buckets import BucketStore, read_bucket_history, read_buckets, sync_buckets
from tidemark.plans.checksums import checksum_diff as stored_checksum_diff
from tidemark.plans.checksums import write_checksum_tree
from tidemark.plans.store import Buckets, SnapshotStore, read_history, read_snapshot
from tidemark.plans.sync import left_out_rows, sync_table
from tidemark.session import scratch_path
from tidemark.sinks.files import write_csv, write_parquet
from tidemark.sources.files import read_csv, read_json, read_latest, read_source
from tidemark.sources.storage import remove_folder
from tidemark.streaming.arrivals import stream_jobs
from tidemark.streaming.arrivals import stream_sync as stream_files

PRIOR = "2025-01-01 00:00:00"
NOW = "2025-01-02 00:00:00"
JOB = "job-1"
ORDER_KEY = ["o_orderkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Two versions of ``orders``: the prior one lacks the orders of 2001 and has other prices for the urgent ones, the
# current one no longer holds the first half of 1995. That gives inserts, updates, deletes and unchanged rows.


def current_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz '1995-07-01 00:00:00'")


def prior_orders(spark: SparkSession, sf: str) -> DataFrame:
    old_price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return (
        table(spark, sf, "orders")
        .where("o_orderdate < timestamp_ntz '2001-01-01 00:00:00'")
        .withColumn("o_totalprice", old_price)
    )


def prior_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return projection.snapshot(prior_orders(spark, sf), now=PRIOR)


def compared(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.cdc_compare(current_orders(spark, sf), prior_snapshot(spark, sf), ORDER_KEY, NOW)


# --- scans -----------------------------------------------------------------------------------------------------------


@query
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = write_csv(table(spark, sf, "orders"), scratch_path(spark, "scan-csv"), "orders.csv")
    return read_csv(spark, path)


@query
def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scan-json")
    table(spark, sf, "orders").write.json(path)
    return read_json(spark, path)


@query
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return read_source(spark, f"{sf}/lineitem.parquet")


@query
def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    return read_latest(spark, sf, "*e*nts.parquet", "name")


# --- projections -----------------------------------------------------------------------------------------------------

ORDER_MAPPINGS = [
    {"source": "o_orderkey", "target": "id"},
    {"source": "o_custkey", "target": "customer"},
    {"source": "o_totalprice", "target": "amount"},
    {"source": "o_orderdate", "target": "ordered_on"},
    {"source": "o_orderpriority", "target": "priority"},
]
ORDER_SCHEMA = [
    {"name": "ID", "type": "integer"},
    {"name": "Customer", "type": "number"},
    {"name": "amount", "type": "BIGINT"},
    {"name": "ordered_on", "type": "date"},
]
EVENT_SCHEMA = [
    {"name": "event_id", "type": "double"},
    {"name": "ts", "type": "date"},
    {"name": "event_type", "type": "string"},
    {"name": "value", "type": "int"},
    {"name": "props"},
]


@query
def field_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return projection.apply_field_mappings(table(spark, sf, "orders"), ORDER_MAPPINGS, ORDER_SCHEMA)


@query
def schema_projection(spark: SparkSession, sf: str) -> DataFrame:
    return projection.apply_schema(table(spark, sf, "events"), EVENT_SCHEMA)


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with text that suits one type or another, or none."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderpriority
             WHEN '1-URGENT' THEN CAST(o_totalprice AS STRING)
             WHEN '2-HIGH' THEN concat(' ', CAST(o_orderkey AS STRING), ' ')
             WHEN '3-MEDIUM' THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/')
             WHEN '4-NOT SPECIFIED' THEN CAST(o_orderdate AS STRING)
             ELSE o_orderpriority END AS raw""",
        "CASE o_orderstatus WHEN 'F' THEN 'false' WHEN 'O' THEN 'TRUE' ELSE o_orderstatus END AS raw_flag",
    )


@query
def safe_cast_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.col("raw")
    return raw_orders(spark, sf).select(
        "o_orderkey",
        safe_cast(raw, "number").alias("as_double"),
        safe_cast(raw, "Integer").alias("as_bigint"),
        safe_cast(raw, "date").alias("as_date"),
        safe_cast(raw, "datetime").alias("as_timestamp"),
        safe_cast(raw, "text").alias("as_is"),
        safe_cast(F.col("raw_flag"), "bool").alias("as_boolean"),
    )


QUERIES["safe_cast"] = QUERIES.pop("safe_cast_text")


@query
def zero_date(spark: SparkSession, sf: str) -> DataFrame:
    raw = """CASE o_orderpriority
               WHEN '1-URGENT' THEN '0000-00-00'
               WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'NULL' WHEN 'O' THEN '' END
               WHEN '3-MEDIUM' THEN '0000-00-00 00:00:00'
               WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'P' THEN '0001-01-01 00:00:00'
                                                ELSE CAST(o_orderdate AS STRING) END
               ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS raw"""
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", raw)
    value = F.col("raw")
    return rows.select(
        "o_orderkey",
        zero_date_to_null(value, "date").alias("raw_date"),
        zero_date_to_null(safe_cast(value, "date"), "date").alias("as_date"),
        zero_date_to_null(safe_cast(value, "timestamp"), "timestamp").alias("as_timestamp"),
        zero_date_to_null(value, "text").alias("as_text"),
    )


@query
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    return projection.with_row_hash(table(spark, sf, "lineitem"))


@query
def row_hash_doubles(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_totalprice * 1000 AS large",
        "o_totalprice * 1e12 AS huge",
        "o_totalprice / 1e9 AS small",
        "o_totalprice / 1e15 AS tiny",
        "CAST(CASE o_orderstatus WHEN 'F' THEN 'inf' WHEN 'O' THEN '-inf' ELSE 'nan' END AS DOUBLE) AS odd",
    )
    return projection.with_row_hash(rows).select("o_orderkey", HASH_COLUMN)


@query
def snapshot_tags(spark: SparkSession, sf: str) -> DataFrame:
    return projection.tag_snapshot(table(spark, sf, "orders"), NOW)


@query
def snapshot_sync(spark: SparkSession, sf: str) -> DataFrame:
    return projection.snapshot(table(spark, sf, "orders"), ORDER_MAPPINGS, ORDER_SCHEMA, NOW)


# --- export preparation ----------------------------------------------------------------------------------------------


def joined_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a join leaves them: with internal and numbered columns."""
    rows = table(spark, sf, "customer").selectExpr(
        "*", "c_custkey AS _rowid", "c_name AS name_1", "c_nationkey AS nation_key_22", "c_mktsegment AS segment_x1"
    )
    return projection.tag_snapshot(rows, NOW)


@query
def drop_system_cols(spark: SparkSession, sf: str) -> DataFrame:
    return export.drop_system_columns(joined_customers(spark, sf))


@query
def export_columns(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType().add("C_CUSTKEY", "long").add("c_name", "string").add("C_AcctBal", "double").add("extra", "integer")
    return export.export_columns(joined_customers(spark, sf), target)


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with early, empty and missing dates."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderpriority WHEN '1-URGENT' THEN NULL
             WHEN '2-HIGH' THEN timestamp_ntz '0001-01-01 00:00:00'
             WHEN '3-MEDIUM' THEN timestamp_ntz '1899-12-31 23:59:59'
             WHEN '4-NOT SPECIFIED' THEN timestamp_ntz '1900-01-01 00:00:00' ELSE o_orderdate END AS ordered_at""",
        """CASE o_orderstatus WHEN 'F' THEN date '1899-12-31' WHEN 'O' THEN NULL
             ELSE CAST(o_orderdate AS DATE) END AS ordered_on""",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority",
        "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price",
        "CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS customer",
        "CASE WHEN o_orderstatus = 'O' THEN true END AS open",
    )


def target_of(df: DataFrame, nullable: bool) -> T.StructType:
    return T.StructType([T.StructField(f.name.upper(), f.dataType, nullable) for f in df.schema.fields])


@query
def clean_dates_nullable(spark: SparkSession, sf: str) -> DataFrame:
    return export.clean_dates(dated_orders(spark, sf)).select("o_orderkey", "ordered_at", "ordered_on")


@query
def clean_dates_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf)
    return export.clean_dates(rows, target_of(rows, False)).select("o_orderkey", "ordered_at", "ordered_on")


@query
def fill_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf).select("o_orderkey", "priority", "price", "customer", "open")
    return export.fill_not_null(rows, target_of(rows, False))


@query
def prepare_export(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf)
    snapshot = projection.tag_snapshot(rows.withColumn("note_1", F.lit("x")), NOW)
    return export.prepare_export(snapshot, target_of(rows, False))


# --- derived models --------------------------------------------------------------------------------------------------


def model(spark: SparkSession, sf: str, definition: dict, *names: str) -> DataFrame:
    return build_model(spark, definition, {n: table(spark, sf, n) for n in names})


@query
def model_select(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "filter",
        "select": ["o_orderkey", "upper(o_orderpriority) AS priority", "o_totalprice * 2 AS doubled"],
    }
    return model(spark, sf, definition, "orders")


@query
def model_filter(spark: SparkSession, sf: str) -> DataFrame:
    where = "o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW') AND o_orderpriority LIKE '%-%' AND o_totalprice >= 1000 AND o_custkey IS NOT NULL"
    return model(spark, sf, {"type": "filter", "from": "Orders", "where": where}, "orders")


@query
def model_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "join",
        "from": "orders",
        "joins": [{"type": "INNER", "table": "customer", "on": ["o_custkey", "c_custkey"]}],
    }
    return model(spark, sf, definition, "orders", "customer")


@query
def model_join_left(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "join",
        "from": "documents",
        "select": ["documents.doc_id", "lang", "n_chars", "quality", "toxic"],
        "joins": [{"type": "left", "model": "labels", "on": ["doc_id", "doc_id"]}],
    }
    return model(spark, sf, definition, "documents", "labels")


@query
def model_join_right(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "join",
        "from": "labels",
        "select": ["documents.doc_id", "source", "quality"],
        "joins": [{"type": "RIGHT", "table": "documents", "on": ["doc_id", "doc_id"]}],
    }
    return model(spark, sf, definition, "labels", "documents")


@query
def model_join_full(spark: SparkSession, sf: str) -> DataFrame:
    on = "orders.o_orderkey = events.event_id AND orders.o_orderstatus = 'F'"
    definition = {
        "type": "join",
        "from": "orders",
        "select": ["o_orderkey", "o_totalprice", "event_id", "event_type"],
        "joins": [{"type": "FULL", "table": "events", "on": on}],
    }
    return model(spark, sf, definition, "orders", "events")


@query
def model_join_range(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "join",
        "from": "orders",
        "select": ["o_orderkey", "s_suppkey", "o_totalprice"],
        "joins": [{"type": "INNER", "table": "bands", "on": "o_totalprice BETWEEN band_low AND band_high"}],
    }
    bands = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "s_acctbal * 40 AS band_low", "CASE WHEN s_suppkey = 1 THEN 1e9 ELSE s_acctbal * 40 + 500 END AS band_high"
    )
    return build_model(spark, definition, {"orders": table(spark, sf, "orders"), "bands": bands})


@query
def model_join_theta(spark: SparkSession, sf: str) -> DataFrame:
    on = "orders.o_custkey = customer.c_custkey AND orders.o_totalprice > customer.c_acctbal * 50"
    definition = {
        "type": "join",
        "from": "orders",
        "select": ["o_orderkey", "c_custkey", "o_totalprice", "c_acctbal"],
        "joins": [{"type": "INNER", "table": "customer", "on": on}],
    }
    return model(spark, sf, definition, "orders", "customer")


LINE_CUSTOMERS = {
    "type": "join",
    "from": "lineitem",
    "select": ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "o_orderdate", "c_name", "c_mktsegment"],
    "joins": [
        {"type": "INNER", "table": "orders", "on": ["l_orderkey", "o_orderkey"]},
        {"type": "LEFT", "table": "customer", "on": "orders.o_custkey = customer.c_custkey"},
    ],
}


@query
def model_join_multi(spark: SparkSession, sf: str) -> DataFrame:
    return model(spark, sf, LINE_CUSTOMERS, "lineitem", "orders", "customer")


@query
def model_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "aggregation",
        "from": "lineitem",
        "select": [
            "l_returnflag",
            "l_linestatus",
            "count(*) AS line_count",
            "min(l_shipdate) AS first_ship",
            "max(l_extendedprice) AS top_price",
            "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity",
        ],
        "groupBy": ["l_returnflag", "l_linestatus"],
        "orderBy": ["l_returnflag", "l_linestatus"],
    }
    return model(spark, sf, definition, "lineitem")


@query
def model_order_by(spark: SparkSession, sf: str) -> DataFrame:
    definition = {
        "type": "filter",
        "from": "orders",
        "select": ["o_orderkey", "o_totalprice"],
        "orderBy": ["o_totalprice DESC", "o_orderkey"],
    }
    return model(spark, sf, definition, "orders")


@query
def model_custom_sql(spark: SparkSession, sf: str) -> DataFrame:
    sql = """
        WITH spend AS (
            SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders GROUP BY o_custkey
        )
        SELECT c_custkey, c_name, coalesce(n_orders, 0) AS n_orders, top_price
        FROM customer LEFT JOIN spend ON o_custkey = c_custkey
    """
    return model(spark, sf, {"type": "custom", "sql": sql}, "orders", "customer")


ORDER_MODEL = {
    "type": "join",
    "from": "orders",
    "select": ["o_orderkey", "o_orderstatus", "o_totalprice", "c_name"],
    "joins": [{"type": "INNER", "table": "customer", "on": ["o_custkey", "c_custkey"]}],
}


def order_model_first(spark: SparkSession, sf: str) -> DataFrame:
    models = {"orders": prior_snapshot(spark, sf), "customer": table(spark, sf, "customer")}
    return refresh.refresh_model(spark, ORDER_MODEL, models, now=PRIOR)


@query
def model_refresh_first(spark: SparkSession, sf: str) -> DataFrame:
    models = {name: table(spark, sf, name) for name in ("orders", "customer")}
    return refresh.refresh_model(spark, ORDER_MODEL, models, now=PRIOR)


@query
def model_refresh_next(spark: SparkSession, sf: str) -> DataFrame:
    before = order_model_first(spark, sf)
    models = {"orders": compared(spark, sf).where("`$_operation` <> 'DELETE'"), "customer": table(spark, sf, "customer")}
    return refresh.refresh_model(spark, ORDER_MODEL, models, before, NOW)


@query
def model_refresh_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The next refresh of a model over the largest table, whose rows repeat."""
    models = {n: table(spark, sf, n) for n in ("lineitem", "customer")}
    before = refresh.refresh_model(spark, LINE_CUSTOMERS, models | {"orders": prior_orders(spark, sf)}, now=PRIOR)
    return refresh.refresh_model(spark, LINE_CUSTOMERS, models | {"orders": current_orders(spark, sf)}, before, NOW)


# --- filters, keys, change detection ---------------------------------------------------------------------------------


@query
def keys_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf).select("o_orderkey", "priority", "price", "customer")
    return keys.keys_not_null(rows, ["o_orderkey", "price"])


@query
def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return keys.dedup_by_key(projection.with_row_hash(table(spark, sf, "lineitem")), LINE_KEY)


@query
def dedup_by_cursor(spark: SparkSession, sf: str) -> DataFrame:
    return keys.dedup_by_key(table(spark, sf, "events"), ["user_id"], F.col("ts").desc())


@query
def dropped_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr("*", "nullif(l_returnflag, 'R') AS flag_key")
    return left_out_rows(rows, ["flag_key", "l_orderkey", "l_linenumber"])


@query
def cdc_compare(spark: SparkSession, sf: str) -> DataFrame:
    return compared(spark, sf)


@query
def cdc_compare_drift(spark: SparkSession, sf: str) -> DataFrame:
    current = current_orders(spark, sf).withColumn("year", F.year("o_orderdate").cast("bigint")).drop("o_orderpriority")
    return cdc.cdc_compare(current, prior_snapshot(spark, sf).drop("$_last_updated"), ORDER_KEY, NOW)


@query
def cdc_compare_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    before = projection.snapshot(lines.where("l_shipdate < timestamp_ntz '2001-06-01 00:00:00'"), now=PRIOR)
    return cdc.cdc_compare(lines.where("l_returnflag <> 'N' OR l_quantity > 10"), before, LINE_KEY, NOW)


@query
def changes_only(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.changes_only(compared(spark, sf))


@query
def operation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.operation_counts(compared(spark, sf))


@query
def sync_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sync_metrics(compared(spark, sf)).drop("bytes")


@query
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.row_count(table(spark, sf, "lineitem"))


@query
def table_checksum(spark: SparkSession, sf: str) -> DataFrame:
    rows = [
        metrics.table_checksum(df).select(F.lit(name).alias("version"), "checksum", "row_count")
        for name, df in (
            ("lineitem", table(spark, sf, "lineitem")),
            ("prior", prior_snapshot(spark, sf)),
            ("none", prior_snapshot(spark, sf).where("o_orderstatus = 'none'")),
        )
    ]
    return reduce(DataFrame.unionAll, rows)


@query
def hash_cdc(spark: SparkSession, sf: str) -> DataFrame:
    # Two columns that repeat, so that fingerprints repeat as well.
    columns = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    before = cdc.first_refresh(prior_orders(spark, sf).select(*columns), PRIOR)
    return cdc.hash_cdc(current_orders(spark, sf).select(*columns), before, NOW)


@query
def hash_cdc_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without their keys: fewer copies than before of some, more of others."""
    columns = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    lines = table(spark, sf, "lineitem")
    before = cdc.first_refresh(lines.where("l_linenumber <> 2").select(*columns), PRIOR)
    return cdc.hash_cdc(lines.where("l_linenumber <> 1").select(*columns), before, NOW, counted=True)


@query
def checksum_diff(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "checksums")
    write_checksum_tree(prior_orders(spark, sf), f"{base}/prior")
    write_checksum_tree(current_orders(spark, sf), f"{base}/current")
    return stored_checksum_diff(spark, f"{base}/prior", f"{base}/current")


@query
def history_append(spark: SparkSession, sf: str) -> DataFrame:
    first = history.append_history(prior_snapshot(spark, sf), None, PRIOR)
    return history.append_history(compared(spark, sf), first, NOW, distinct_history=True, unique_rows=True)


@query
def history_append_any(spark: SparkSession, sf: str) -> DataFrame:
    """A history of unknown origin, with repeated rows, that lacks a column."""
    lines = projection.snapshot(table(spark, sf, "lineitem").drop("l_linenumber"), now=PRIOR)
    old = history.history_changes(lines.drop("l_tax"), PRIOR, unique_rows=True)
    return history.append_history(lines, old, NOW)


# --- stored syncs ----------------------------------------------------------------------------------------------------


def synced_twice(spark: SparkSession, sf: str, buckets: Buckets | None = None) -> SnapshotStore:
    store = SnapshotStore(scratch_path(spark, "sync"), buckets)
    sync_table(prior_orders(spark, sf), store, ORDER_KEY, PRIOR)
    sync_table(current_orders(spark, sf), store, ORDER_KEY, NOW)
    return store


@query
def sync_stored_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return read_snapshot(spark, synced_twice(spark, sf, Buckets(("o_orderkey",), 8)))


@query
def sync_stored_history(spark: SparkSession, sf: str) -> DataFrame:
    return read_history(spark, synced_twice(spark, sf))


def bucketed_twice(spark: SparkSession, sf: str) -> BucketStore:
    store = BucketStore(scratch_path(spark, "buckets"), ("o_orderkey",), 16)
    sync_buckets(prior_orders(spark, sf), store, PRIOR)
    sync_buckets(current_orders(spark, sf), store, NOW)
    return store


@query
def sync_stored_bucketed_delta(spark: SparkSession, sf: str) -> DataFrame:
    return read_buckets(spark, bucketed_twice(spark, sf))


@query
def sync_stored_bucketed_history(spark: SparkSession, sf: str) -> DataFrame:
    return read_bucket_history(spark, bucketed_twice(spark, sf))


@query
def sync_stored_bucketed_same(spark: SparkSession, sf: str) -> DataFrame:
    """A third sync of the same rows: all buckets are shared with the version before."""
    store = bucketed_twice(spark, sf)
    sync_buckets(current_orders(spark, sf), store, "2025-01-03 00:00:00")
    return read_buckets(spark, store)


def drifted(spark: SparkSession, sf: str) -> SnapshotStore:
    """Two syncs of ``orders``; the second has the customer as text and the price as a wider number."""
    store = SnapshotStore(scratch_path(spark, "drift"))
    before = prior_orders(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    after = current_orders(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("string"))
    sync_table(before, store, ORDER_KEY, PRIOR)
    sync_table(after, store, ORDER_KEY, NOW)
    return store


@query
def sync_type_drift(spark: SparkSession, sf: str) -> DataFrame:
    return read_snapshot(spark, drifted(spark, sf))


@query
def sync_type_drift_history(spark: SparkSession, sf: str) -> DataFrame:
    return read_history(spark, drifted(spark, sf))


@query
def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    store = SnapshotStore(f"{base}/store")
    for number, (rows, at) in enumerate([(prior_orders(spark, sf), PRIOR), (current_orders(spark, sf), NOW)]):
        path = f"{base}/arrived/{number}.parquet"
        write_parquet(rows, path)
        job = spark.range(1).selectExpr(
            f"'{path}' AS path", "'parquet' AS format", f"timestamp_ntz '{at}' AS synced_at"
        )
        job.write.mode("append").json(f"{base}/jobs")
    stream_jobs(spark, f"{base}/jobs", ORDER_KEY, store, f"{base}/checkpoint").awaitTermination()
    return read_snapshot(spark, store)


@query
def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of two jobs whose end got lost runs again."""
    base = scratch_path(spark, "replay")
    store, jobs = SnapshotStore(f"{base}/store"), []
    for number, (rows, at) in enumerate([(prior_orders(spark, sf), PRIOR), (current_orders(spark, sf), NOW)]):
        path = f"{base}/arrived/{number}.parquet"
        write_parquet(rows, path)
        jobs.append(f"struct('{path}' AS path, 'parquet' AS format, timestamp_ntz '{at}' AS synced_at)")
    spark.range(1).selectExpr(f"inline(array({', '.join(jobs)}))").write.json(f"{base}/jobs")
    for _ in range(2):
        stream_jobs(spark, f"{base}/jobs", ORDER_KEY, store, f"{base}/checkpoint").awaitTermination()
        remove_folder(spark, f"{base}/checkpoint/commits")
    return read_history(spark, store)


ARRIVED_GROUP_BYTES = 8 << 20


def write_arrival(rows: DataFrame, folder: str) -> None:
    """One more file in ``folder``. A task reads whole row groups, so they are small: else one task would read all of the file."""
    rows.coalesce(1).write.mode("append").option("parquet.block.size", ARRIVED_GROUP_BYTES).parquet(folder)


@query
def stream_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Each arriving file is a snapshot."""
    base = scratch_path(spark, "files")
    store, schema = SnapshotStore(f"{base}/store"), table(spark, sf, "orders").schema
    for rows in (prior_orders(spark, sf), current_orders(spark, sf)):
        write_arrival(rows, f"{base}/arrived")
        query_ = stream_files(
            spark, f"{base}/arrived", schema, ORDER_KEY, store, f"{base}/checkpoint", clock=lambda batch: (PRIOR, NOW)[batch]
        )
        query_.awaitTermination()
    return read_snapshot(spark, store)


# --- targets ---------------------------------------------------------------------------------------------------------


@query
def missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return merge.missing_rows(current_orders(spark, sf), prior_orders(spark, sf), ORDER_KEY)


@query
def existing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return merge.existing_rows(current_orders(spark, sf), prior_orders(spark, sf), ORDER_KEY)


@query
def upsert_update(spark: SparkSession, sf: str) -> DataFrame:
    target = prior_orders(spark, sf).withColumn("loaded", F.lit("before"))
    return merge.upsert(target, current_orders(spark, sf), ORDER_KEY)


@query
def upsert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    target = keys.distinct_keys(table(spark, sf, "lineitem").where("l_returnflag = 'R'"), LINE_KEY)
    return merge.upsert(target, pairs, LINE_KEY)


def reconciled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    target = prior_orders(spark, sf).withColumn("loaded", F.lit("before"))
    return merge.reconcile(target, current_orders(spark, sf), ORDER_KEY)


@query
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return reconciled(spark, sf)[0]


@query
def reconcile_changes(spark: SparkSession, sf: str) -> DataFrame:
    return reconciled(spark, sf)[1].withColumnRenamed(merge.CHANGE, "change")


@query
def reconcile_changed_only(spark: SparkSession, sf: str) -> DataFrame:
    changes = merge.merge_changes(prior_orders(spark, sf), current_orders(spark, sf), ORDER_KEY, changed_only=True)
    return changes.withColumnRenamed(merge.CHANGE, "change")


@query
def changelog_build(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.build_changelog(reconciled(spark, sf)[1], NOW, JOB)


@query
def changelog_merge(spark: SparkSession, sf: str) -> DataFrame:
    before = changelog.build_changelog(prior_orders(spark, sf), PRIOR, "job-0", "INSERT")
    return changelog.merge_changelog(before, changelog.build_changelog(reconciled(spark, sf)[1], NOW, JOB))


@query
def truncate_reload(spark: SparkSession, sf: str) -> DataFrame:
    return merge.reload(projection.with_row_hash(table(spark, sf, "lineitem")), LINE_KEY)


@query
def append_insert(spark: SparkSession, sf: str) -> DataFrame:
    target = prior_orders(spark, sf).withColumn("loaded", F.lit("before"))
    return merge.append(target, current_orders(spark, sf))


def exported(spark: SparkSession, sf: str, config: dict, kind: str) -> outbound.Export:
    snapshot = compared(spark, sf)
    source = export.prepare_export(snapshot, live_only=True)
    return outbound.run_plan(outbound.write_plan(config, kind), prior_orders(spark, sf), source, NOW, JOB)


@query
def outbound_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return exported(spark, sf, {"primaryKey": ["o_orderkey"]}, "postgres").target


@query
def outbound_reconcile_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return exported(spark, sf, {"upsertKeys": ["o_orderkey"]}, "mysql").changelog


@query
def outbound_reload_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return exported(spark, sf, {"primaryKey": ["o_orderkey"], "truncateFirst": True}, "mysql").changelog


def stored_export(spark: SparkSession, sf: str, kind: str) -> tuple[SnapshotStore, str]:
    """A stored table that was loaded from the prior orders and then written to by plan from the compared ones."""
    base = scratch_path(spark, "export")
    store, log = SnapshotStore(f"{base}/table"), f"{base}/log"
    load = outbound.WritePlan("append")
    outbound.export_to_store(prior_snapshot(spark, sf), store, load, PRIOR, "job-0", changelog_path=log)
    plan = outbound.write_plan({"primaryKey": ["o_orderkey"]}, kind)
    outbound.export_to_store(compared(spark, sf), store, plan, NOW, JOB, changelog_path=log, live_only=True)
    return store, log


@query
def export_stored_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return read_snapshot(spark, stored_export(spark, sf, "postgres")[0])


@query
def export_stored_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return read_snapshot(spark, stored_export(spark, sf, "mysql")[0])


@query
def export_stored_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return outbound.read_changelog(spark, stored_export(spark, sf, "mysql")[1])


@query
def export_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Both jobs of a stored export run again, the earlier one last."""
    store, log = stored_export(spark, sf, "mysql")
    plan = outbound.write_plan({"primaryKey": ["o_orderkey"]}, "mysql")
    for rows, write, now, job in (
        (compared(spark, sf), plan, NOW, JOB),
        (prior_snapshot(spark, sf), outbound.WritePlan("append"), PRIOR, "job-0"),
    ):
        outbound.export_to_store(rows, store, write, now, job, changelog_path=log, live_only=True)
    return outbound.read_changelog(spark, log)


@query
def outbound_csv(spark: SparkSession, sf: str) -> DataFrame:
    config = {"remotePath": scratch_path(spark, "out"), "fileName": "{model_name}_{date}.csv", "archiveAfterUpload": True}
    path, _ = outbound.export_to_csv(compared(spark, sf), config, NOW, "orders", delimiter="|")
    return read_csv(spark, path, delimiter="|")


# --- partitions ------------------------------------------------------------------------------------------------------


def nation_models(spark: SparkSession, sf: str) -> dict[str, DataFrame | None]:
    return {
        "customer": table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nation"),
        "supplier": table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "nation"),
        "nation": table(spark, sf, "nation").withColumnRenamed("n_nationkey", "nation"),
        "unused": None,
    }


@query
def partition_filter(spark: SparkSession, sf: str) -> DataFrame:
    return partitions.partition_filter(table(spark, sf, "orders"), "o_orderpriority", "3-MEDIUM")


@query
def partition_filter_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """A text column that spells the same number in several ways, with its stored key."""
    spelt = F.expr(
        """CASE l_linenumber % 4 WHEN 0 THEN CAST(l_suppkey AS STRING) WHEN 1 THEN concat('00', l_suppkey)
           WHEN 2 THEN concat(l_suppkey, '0e-1') ELSE concat(l_suppkey, '.0') END"""
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", spelt.alias("supplier"))
    path = scratch_path(spark, "value-keys")
    write_parquet(partitions.with_value_key(lines, "supplier"), path)
    found = partitions.partition_filter(read_source(spark, path, "parquet"), "supplier", "+7")
    return found.select("l_orderkey", "l_linenumber", "supplier")


@query
def partition_build(spark: SparkSession, sf: str) -> DataFrame:
    built = partitions.build_partition(nation_models(spark, sf), "nation", "7", {"customer": "clients"})
    parts = [projection.with_row_hash(df).select(F.lit(n).alias("table_name"), col(HASH_COLUMN)) for n, df in built.items()]
    return reduce(DataFrame.unionAll, parts)


@query
def partition_extract(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "extract")
    built = partitions.build_partition(nation_models(spark, sf), "nation", "7")
    extracts.write_partition(built, base, "by-nation", "7")
    names = [n for n in built]
    back = [read_source(spark, extracts.extract_path(base, "by-nation", "7", n), "parquet") for n in names]
    parts = [projection.with_row_hash(df).select(F.lit(n).alias("table_name"), col(HASH_COLUMN)) for n, df in zip(names, back)]
    return reduce(DataFrame.unionAll, parts)


@query
def partition_stats(spark: SparkSession, sf: str) -> DataFrame:
    return partitions.partition_stats(partitions.build_partition(nation_models(spark, sf), "nation", "7"))


@query
def partition_build_all(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "partitions")
    models = nation_models(spark, sf) | {"orders": table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "nation")}
    extracts.build_all_partitions(models, "nation", base, "by-nation", {"customer": "clients"})
    parts = []
    for name in ("clients", "supplier", "nation", "orders"):
        rows = projection.with_row_hash(extracts.read_extracts(spark, base, "by-nation", name))
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col("nation").cast("string"), col(HASH_COLUMN)))
    return reduce(DataFrame.unionAll, parts)


# --- lineage ---------------------------------------------------------------------------------------------------------


def model_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Every row as a model built from the rows it refers to: nation, customer and supplier, order, line."""

    def models(name: str | DataFrame, kind: str, model_id: str, *sources: str) -> DataFrame:
        rows = table(spark, sf, name) if isinstance(name, str) else name
        built_from = f"array({', '.join(sources)})" if sources else "CAST(array() AS array<string>)"
        return rows.selectExpr(
            f"{model_id} AS id", f"'{kind}' AS model_kind", f"{built_from} AS source_models"
        )

    parts = [
        models("nation", "base", "concat('n:', n_nationkey)"),
        models("customer", "derived", "concat('c:', c_custkey)", "concat('n:', c_nationkey)"),
        models("supplier", "derived", "concat('s:', s_suppkey)", "concat('n:', s_nationkey)"),
        models("orders", "derived", "concat('o:', o_orderkey)", "concat('c:', o_custkey)"),
        models(
            table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct(),
            "derived",
            "concat('l:', l_orderkey, '/', l_suppkey)",
            "concat('o:', l_orderkey)",
            "concat('s:', l_suppkey)",
        ),
    ]
    return reduce(DataFrame.unionAll, parts)


@query
def direct_dependents(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.dependents(model_graph(spark, sf), "n:7").select("id")


@query
def cascade_dependents(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.refresh_order(model_graph(spark, sf), "n:7")


# --- sinks -----------------------------------------------------------------------------------------------------------


@query
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sink")
    write_parquet(compared(spark, sf), path, codec="zstd", max_bytes=10 << 20)
    return spark.read.parquet(path)


@query
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "sink")
    for _ in range(2):
        path = write_csv(
            table(spark, sf, "events"), folder, "{model_name}_{date}.csv", delimiter=";", if_exists="archive", now=NOW,
            model_name="events",
        )
    return read_csv(spark, path, delimiter=";")
