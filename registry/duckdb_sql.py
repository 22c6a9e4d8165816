"""The same results in DuckDB SQL."""

from __future__ import annotations

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
COUNTED = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
PRIOR = "TIMESTAMP '2025-01-01 00:00:00'"
NOW = "TIMESTAMP '2025-01-02 00:00:00'"


def ref(columns: list[str], prefix: str = "") -> str:
    parts = ", ".join(f"coalesce(CAST({prefix}{c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def tags(operation: str, at: str) -> str:
    return f"'{operation}' AS \"$_operation\", {at} AS \"$_timestamp\", {at} AS \"$_last_updated\""


CURRENT = "cur AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01')"
BEFORE = """old AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')"""


def compare(data: list[str], keys: list[str], cur: str, old: str, old_only_updated: str = PRIOR,
            old_lacks: tuple[str, ...] = (), old_ref: str | None = None, timed: bool = True) -> str:
    """CTE ``cdc``: full join of ``cur`` and ``old``, which are unique by key."""
    on = " AND ".join(f"c.{k} = p.{k}" for k in keys)
    values = ", ".join(
        f"c.{d} AS {d}" if d in old_lacks else f"CASE WHEN c.r IS NULL THEN p.{d} ELSE c.{d} END AS {d}" for d in data
    )
    updated = (
        f"CASE WHEN p.r IS NULL THEN {NOW} WHEN c.r IS NULL THEN {PRIOR} WHEN c.r <> p.r THEN {NOW} ELSE {PRIOR} END"
        if timed else NOW
    )
    return f"""
cr AS (SELECT *, {ref(data)} AS r FROM {cur}),
pr AS (SELECT *, {old_ref or ref(data)} AS r FROM {old}),
cdc AS (
  SELECT {values}, CASE WHEN c.r IS NULL THEN p.r ELSE c.r END AS "$_ref",
    CASE WHEN p.r IS NULL THEN 'INSERT' WHEN c.r IS NULL THEN 'DELETE' WHEN c.r <> p.r THEN 'UPDATE' ELSE 'NO_CHANGE' END
      AS "$_operation",
    {NOW} AS "$_timestamp", {updated} AS "$_last_updated"
  FROM cr c FULL JOIN pr p ON {on})"""


CDC = f"WITH {CURRENT}, {BEFORE}, {compare(ORDERS, ['o_orderkey'], 'cur', 'old')}"
O = ", ".join(ORDERS)


def first_by(table: str, keys: list[str], order: str) -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"


RAW = """raw_orders AS (
  SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_totalprice AS VARCHAR)
      WHEN '2-HIGH' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
      WHEN '3-MEDIUM' THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '/')
      WHEN '4-NOT SPECIFIED' THEN CAST(o_orderdate AS VARCHAR) ELSE o_orderpriority END AS raw,
    CASE o_orderstatus WHEN 'F' THEN 'false' WHEN 'O' THEN 'TRUE' ELSE o_orderstatus END AS raw_flag
  FROM orders)"""

ZERO = """z AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '0000-00-00'
    WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'NULL' WHEN 'O' THEN '' END
    WHEN '3-MEDIUM' THEN '0000-00-00 00:00:00'
    WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'P' THEN '0001-01-01 00:00:00' ELSE CAST(o_orderdate AS VARCHAR) END
    ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS raw
  FROM orders)"""


ZERO_SPELLINGS = "('', 'NULL')"  # fixed values, with any text that starts with 0000-00-00 and the first day of the year 1


def zero_rule(x: str) -> str:
    text = f"CAST({x} AS VARCHAR)"
    empty = f"({text} IN {ZERO_SPELLINGS} OR {text} LIKE '0000-00-00%' OR {text} SIMILAR TO '000[01]-01-01 00:00:00')"
    return f"CASE WHEN NOT {empty} THEN {x} END"


DATED = """d AS (
  SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN TIMESTAMP '0001-01-01 00:00:00'
      WHEN '3-MEDIUM' THEN TIMESTAMP '1899-12-31 23:59:59' WHEN '4-NOT SPECIFIED' THEN TIMESTAMP '1900-01-01 00:00:00'
      ELSE o_orderdate END AS ordered_at,
    CASE o_orderstatus WHEN 'F' THEN DATE '1899-12-31' WHEN 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ordered_on,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
    CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS customer,
    CASE WHEN o_orderstatus = 'O' THEN true END AS open
  FROM orders)"""


def exported_date(x: str, kind: str, empty: str) -> str:
    return f"CASE WHEN TRY_CAST({x} AS DATE) >= DATE '1900-01-01' THEN CAST({x} AS {kind}) ELSE {empty} END AS {x}"


SENTINEL_DATES = (
    exported_date("ordered_at", "TIMESTAMP", "TIMESTAMP '1900-01-01 00:00:00'")
    + ", "
    + exported_date("ordered_on", "DATE", "DATE '1900-01-01'")
)
FILLED = "coalesce(priority, '') AS priority, coalesce(price, 0) AS price, coalesce(customer, 0) AS customer, open"

ORDER_MODEL = ["o_orderkey", "o_orderstatus", "o_totalprice", "c_name"]


def order_model(orders: str) -> str:
    return f"SELECT {', '.join(ORDER_MODEL)} FROM {orders} JOIN customer ON o_custkey = c_custkey"


LINE_MODEL = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "o_orderdate", "c_name", "c_mktsegment"]


def line_model(orders: str) -> str:
    return f"""SELECT {', '.join(LINE_MODEL)}, {ref(LINE_MODEL)} AS r
      FROM lineitem JOIN {orders} ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""


def by_hash(columns: list[str], new: str, old: str) -> str:
    """Rows of ``new`` and ``old`` tagged by fingerprint; both relations carry ``r``."""
    c = ", ".join(columns)
    return f"""
  SELECT {c}, r AS "$_ref", {tags('INSERT', NOW)} FROM {new} WHERE r NOT IN (SELECT r FROM {old})
  UNION ALL
  SELECT {c}, n.r, 'INSERT', {PRIOR}, {PRIOR} FROM {new} n JOIN (SELECT DISTINCT r FROM {old}) o ON n.r = o.r
  UNION ALL
  SELECT {c}, r, 'DELETE', {PRIOR}, {NOW} FROM {old} WHERE r NOT IN (SELECT r FROM {new})"""


def log_columns(operation: str, at: str, job: str) -> str:
    return (
        f"{operation} AS \"$_changelog_operation\", '{at}' AS \"$_changelog_timestamp\", "
        f"'{job}' AS \"$_changelog_job_id\", 'new' AS \"$_changelog_row_type\""
    )


KNOWN = "o_orderkey IN (SELECT o_orderkey FROM old)"
CHANGE = f"CASE WHEN {KNOWN} THEN 'UPDATE' ELSE 'INSERT' END"
LOG_NOW = log_columns(CHANGE, "2025-01-02T00:00:00.000Z", "job-1")
MERGED = f"""
  SELECT {O}, CASE WHEN {KNOWN} THEN 'before' END AS loaded FROM cur
  UNION ALL SELECT {O}, 'before' FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM cur)"""


def checksum(name: str, refs: str) -> str:
    words = ", ".join(f"CAST(sum(CAST('0x' || substr(r, {start}, 15) AS BIGINT)) AS VARCHAR)" for start in (1, 16))
    return f"""SELECT '{name}' AS version,
      CASE WHEN count(*) = 0 THEN 'empty' ELSE md5(concat_ws('|', CAST(count(*) AS VARCHAR), {words})) END AS checksum,
      count(*) AS row_count FROM ({refs})"""


EDGES = """edges AS (
  SELECT 'n:' || c_nationkey AS source, 'c:' || c_custkey AS id FROM customer
  UNION ALL SELECT 'n:' || s_nationkey, 's:' || s_suppkey FROM supplier
  UNION ALL SELECT 'c:' || o_custkey, 'o:' || o_orderkey FROM orders
  UNION ALL SELECT DISTINCT 'o:' || l_orderkey, 'l:' || l_orderkey || '/' || l_suppkey FROM lineitem
  UNION ALL SELECT DISTINCT 's:' || l_suppkey, 'l:' || l_orderkey || '/' || l_suppkey FROM lineitem)"""

TABLES_OF_7 = {
    "customer": ("customer", "c_nationkey", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    "supplier": ("supplier", "s_nationkey", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
    "nation": ("nation", "n_nationkey", ["n_nationkey", "n_name", "n_regionkey"]),
}

LINE_COMPARE = f"""WITH a AS ({first_by("(SELECT * FROM lineitem WHERE l_returnflag <> 'N' OR l_quantity > 10)", ['l_orderkey', 'l_linenumber'], ref(LINES))}),
b AS ({first_by("(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-01')", ['l_orderkey', 'l_linenumber'], ref(LINES))}),
{compare(LINES, ['l_orderkey', 'l_linenumber'], 'a', 'b')}"""

DRIFT = [c for c in ORDERS if c != "o_orderpriority"] + ["year"]

SYNC_METRICS = ", ".join(
    f"count(*) FILTER (\"$_operation\" = '{o}') AS {o.lower()}_rows"
    for o in ("INSERT", "UPDATE", "DELETE", "NO_CHANGE", "SNAPSHOT")
)

NO_LINE_NUMBER = [c for c in LINES if c != "l_linenumber"]
LATER_COLUMN = [c for c in NO_LINE_NUMBER if c != "l_tax"]
HISTORY = f"""SELECT {O}, {ref(ORDERS)} AS "$_ref", {PRIOR} AS "$_timestamp", {PRIOR} AS "$_last_updated",
    'INSERT' AS "$_operation", {PRIOR} AS "$_sync_detected_at" FROM old
  UNION ALL
  SELECT {O}, "$_ref", "$_timestamp", "$_last_updated", "$_operation", {NOW} FROM cdc WHERE "$_operation" <> 'NO_CHANGE'"""

ORACLES: dict[str, str] = {
    "scan_csv": "SELECT * FROM orders",
    "scan_json": "SELECT * FROM orders",
    "scan_parquet": "SELECT * FROM lineitem",
    "latest_file": "SELECT * FROM events",
    "field_mapping": """SELECT TRY_CAST(o_orderkey AS BIGINT) AS id, TRY_CAST(o_custkey AS DOUBLE) AS customer,
        TRY_CAST(o_totalprice AS BIGINT) AS amount, TRY_CAST(o_orderdate AS DATE) AS ordered_on,
        o_orderpriority AS priority FROM orders""",
    "schema_projection": """SELECT TRY_CAST(event_id AS DOUBLE) AS event_id, TRY_CAST(ts AS DATE) AS ts, event_type,
        TRY_CAST(value AS BIGINT) AS value, props FROM events""",
    "safe_cast": f"""WITH {RAW} SELECT o_orderkey, TRY_CAST(raw AS DOUBLE) AS as_double, TRY_CAST(raw AS BIGINT) AS as_bigint,
        TRY_CAST(raw AS DATE) AS as_date, TRY_CAST(raw AS TIMESTAMP) AS as_timestamp, raw AS as_is,
        TRY_CAST(raw_flag AS BOOLEAN) AS as_boolean FROM raw_orders""",
    "zero_date": f"""WITH {ZERO}, t AS (SELECT *, TRY_CAST(raw AS DATE) AS d, TRY_CAST(raw AS TIMESTAMP) AS ts FROM z)
        SELECT o_orderkey, {zero_rule('raw')} AS raw_date, {zero_rule('d')} AS as_date, {zero_rule('ts')} AS as_timestamp,
        raw AS as_text FROM t""",
    "row_hash": f'SELECT *, {ref(LINES)} AS "$_ref" FROM lineitem',
    "row_hash_doubles": f"""WITH x AS (SELECT o_orderkey, o_totalprice * 1000 AS large, o_totalprice * 1e12 AS huge,
        o_totalprice / 1e9 AS small, o_totalprice / 1e15 AS tiny,
        CAST(CASE o_orderstatus WHEN 'F' THEN 'inf' WHEN 'O' THEN '-inf' ELSE 'nan' END AS DOUBLE) AS odd FROM orders)
        SELECT o_orderkey, {ref(['o_orderkey', 'large', 'huge', 'small', 'tiny', 'odd'])} AS "$_ref" FROM x""",
    "snapshot_tags": f'SELECT *, {ref(ORDERS)} AS "$_ref", {tags("SNAPSHOT", NOW)} FROM orders',
    "snapshot_sync": f"""WITH m AS (SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS customer,
        CAST(o_totalprice AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS ordered_on, o_orderpriority AS priority
        FROM orders)
        SELECT *, {ref(['id', 'customer', 'amount', 'ordered_on', 'priority'])} AS "$_ref", {tags('SNAPSHOT', NOW)} FROM m""",
    "drop_system_cols": f"""WITH j AS (SELECT *, c_custkey AS _rowid, c_name AS name_1, c_nationkey AS nation_key_22,
        c_mktsegment AS segment_x1 FROM customer)
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, segment_x1,
        {ref(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment', '_rowid', 'name_1', 'nation_key_22', 'segment_x1'])}
        AS "$_ref", {tags('SNAPSHOT', NOW)} FROM j""",
    "export_columns": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "clean_dates_nullable": f"""WITH {DATED} SELECT o_orderkey, {exported_date('ordered_at', 'TIMESTAMP', 'NULL')},
        {exported_date('ordered_on', 'DATE', 'NULL')} FROM d""",
    "clean_dates_sentinel": f"WITH {DATED} SELECT o_orderkey, {SENTINEL_DATES} FROM d",
    "fill_not_null": f"WITH {DATED} SELECT o_orderkey, {FILLED} FROM d",
    "prepare_export": f"""WITH {DATED}, e AS (SELECT o_orderkey, {SENTINEL_DATES}, {FILLED} FROM d)
        SELECT *, {ref(['o_orderkey', 'ordered_at', 'ordered_on', 'priority', 'price', 'customer', 'open'])} AS "$_ref" FROM e""",
    "model_select": "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice * 2 AS doubled FROM orders",
    "model_filter": """SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW')
        AND o_orderpriority LIKE '%-%' AND o_totalprice >= 1000 AND o_custkey IS NOT NULL""",
    "model_join_inner": "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey",
    "model_join_left": """SELECT d.doc_id, lang, n_chars, quality, toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "model_join_right": "SELECT d.doc_id, source, quality FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id",
    "model_join_full": """SELECT o_orderkey, o_totalprice, event_id, event_type
        FROM orders FULL JOIN events ON o_orderkey = event_id AND o_orderstatus = 'F'""",
    "model_join_theta": """SELECT o_orderkey, c_custkey, o_totalprice, c_acctbal
        FROM orders JOIN customer ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 50""",
    "model_join_multi": """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_orderdate, c_name, c_mktsegment
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "model_aggregate": """SELECT l_returnflag, l_linestatus, count(*) AS line_count, min(l_shipdate) AS first_ship,
        max(l_extendedprice) AS top_price, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "model_order_by": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "model_custom_sql": """SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, max(o_totalprice) AS top_price
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
    "model_refresh_first": f"""WITH m AS ({order_model('orders')})
        SELECT *, {ref(ORDER_MODEL)} AS "$_ref", {tags('INSERT', PRIOR)} FROM m""",
    "model_refresh_next": f"""WITH {CURRENT}, {BEFORE}, m AS ({order_model('cur')}), p AS ({order_model('old')}),
        mr AS (SELECT *, {ref(ORDER_MODEL)} AS r FROM m), pr AS (SELECT *, {ref(ORDER_MODEL)} AS r FROM p)
        {by_hash(ORDER_MODEL, 'mr', 'pr')}""",
    "model_refresh_lines": f"""WITH {CURRENT}, {BEFORE}, m AS ({line_model('cur')}), p AS ({line_model('old')})
        {by_hash(LINE_MODEL, 'm', 'p')}""",
    "keys_not_null": f"WITH {DATED} SELECT o_orderkey, priority, price, customer FROM d WHERE price IS NOT NULL",
    "dedup_by_key": first_by(f'(SELECT *, {ref(LINES)} AS "$_ref" FROM lineitem)', ["l_orderkey", "l_linenumber"], '"$_ref"'),
    "dedup_by_cursor": first_by("events", ["user_id"], "ts DESC"),
    "dropped_row_counts": """WITH k AS (SELECT nullif(l_returnflag, 'R') AS f, l_orderkey, l_linenumber, count(*) AS n
        FROM lineitem GROUP BY ALL)
        SELECT CAST(coalesce(sum(n) FILTER (f IS NULL), 0) AS BIGINT) AS null_key_rows,
        CAST(coalesce(sum(n - 1) FILTER (f IS NOT NULL), 0) AS BIGINT) AS repeated_key_rows FROM k""",
    "cdc_compare": f"{CDC} SELECT * FROM cdc",
    "cdc_compare_drift": f"""WITH {CURRENT}, {BEFORE},
        c2 AS (SELECT * EXCLUDE (o_orderpriority), year(o_orderdate) AS year FROM cur),
        {compare(DRIFT, ['o_orderkey'], 'c2', 'old', old_lacks=('year',), old_ref=ref(ORDERS), timed=False)}
        SELECT * FROM cdc""",
    "cdc_compare_repeated_keys": f"{LINE_COMPARE} SELECT * FROM cdc",
    "changes_only": f"{CDC} SELECT * FROM cdc WHERE \"$_operation\" IN ('INSERT', 'UPDATE', 'DELETE', 'SNAPSHOT')",
    "operation_counts": f'{CDC} SELECT "$_operation", count(*) AS row_count FROM cdc GROUP BY "$_operation"',
    "sync_metrics": f"{CDC} SELECT count(*) AS rows, {SYNC_METRICS}, 'completed' AS status FROM cdc",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "table_checksum": f"""WITH {BEFORE}
        {checksum('lineitem', f'SELECT {ref(LINES)} AS r FROM lineitem')}
        UNION ALL {checksum('prior', f'SELECT {ref(ORDERS)} AS r FROM old')}
        UNION ALL {checksum('none', f"SELECT {ref(ORDERS)} AS r FROM old WHERE o_orderstatus = 'none'")}""",
    "hash_cdc": f"""WITH {CURRENT}, {BEFORE},
        n AS (SELECT o_orderstatus, o_orderpriority, o_custkey, {ref(['o_orderstatus', 'o_orderpriority', 'o_custkey'])} AS r FROM cur),
        p AS (SELECT o_orderstatus, o_orderpriority, o_custkey, {ref(['o_orderstatus', 'o_orderpriority', 'o_custkey'])} AS r FROM old)
        {by_hash(['o_orderstatus', 'o_orderpriority', 'o_custkey'], 'n', 'p')}""",
    "history_append": f"{CDC} {HISTORY}",
    "history_append_any": f"""
        SELECT DISTINCT {', '.join(LATER_COLUMN)}, CAST(NULL AS DOUBLE) AS l_tax, {ref(NO_LINE_NUMBER)} AS "$_ref",
          {PRIOR} AS "$_timestamp", {PRIOR} AS "$_last_updated", 'INSERT' AS "$_operation", {PRIOR} AS "$_sync_detected_at"
        FROM lineitem
        UNION ALL
        SELECT DISTINCT {', '.join(LATER_COLUMN)}, l_tax, {ref(NO_LINE_NUMBER)}, {PRIOR}, {PRIOR}, 'INSERT', {NOW}
        FROM lineitem""",
    "sync_stored_snapshot": f"{CDC} SELECT * FROM cdc",
    "sync_stored_history": f"{CDC} {HISTORY}",
    "stream_sync": f"{CDC} SELECT * FROM cdc",
    "sync_stored_bucketed_delta": f"{CDC} SELECT * FROM cdc",
    "sync_stored_bucketed_history": f"{CDC} {HISTORY}",
    "sync_stored_bucketed_same": f"""{CDC} SELECT * REPLACE ('NO_CHANGE' AS "$_operation", TIMESTAMP '2025-01-03' AS "$_timestamp")
        FROM cdc WHERE "$_operation" <> 'DELETE'""",
    "stream_replay": f"{CDC} {HISTORY}",
    "stream_snapshots": f"{CDC} SELECT * FROM cdc",
    "hash_cdc_counted": f"""WITH c AS (SELECT {', '.join(COUNTED)}, {ref(COUNTED)} AS r, row_number() OVER (PARTITION BY {ref(COUNTED)}) AS k
          FROM lineitem WHERE l_linenumber <> 1),
        p AS (SELECT {', '.join(COUNTED)}, {ref(COUNTED)} AS r, row_number() OVER (PARTITION BY {ref(COUNTED)}) AS k
          FROM lineitem WHERE l_linenumber <> 2),
        cn AS (SELECT r, count(*) AS n FROM c GROUP BY r), pn AS (SELECT r, count(*) AS n FROM p GROUP BY r)
        SELECT {', '.join(COUNTED)}, c.r AS "$_ref", 'INSERT' AS "$_operation",
          CASE WHEN k <= n THEN {PRIOR} ELSE {NOW} END AS "$_timestamp", CASE WHEN k <= n THEN {PRIOR} ELSE {NOW} END AS "$_last_updated"
        FROM c LEFT JOIN pn ON c.r = pn.r
        UNION ALL
        SELECT {', '.join(COUNTED)}, p.r, 'DELETE', {PRIOR}, {NOW} FROM p LEFT JOIN cn ON p.r = cn.r WHERE k > coalesce(n, 0)""",
    "checksum_diff": f"""WITH {CURRENT}, {BEFORE}, a AS (SELECT {ref(ORDERS)} AS r, count(*) AS n FROM old GROUP BY r),
        b AS (SELECT {ref(ORDERS)} AS r, count(*) AS n FROM cur GROUP BY r)
        SELECT coalesce(a.r, b.r) AS "$_ref", coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
        FROM a FULL JOIN b ON a.r = b.r WHERE a.n IS DISTINCT FROM b.n""",
    "model_join_range": """SELECT o_orderkey, s_suppkey, o_totalprice FROM orders JOIN supplier
        ON o_totalprice >= s_acctbal * 40 AND o_totalprice <= CASE WHEN s_suppkey = 1 THEN 1e9 ELSE s_acctbal * 40 + 500 END""",
    "partition_filter_numbers": """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN CAST(l_suppkey AS VARCHAR)
        WHEN 1 THEN concat('00', l_suppkey) WHEN 2 THEN concat(l_suppkey, '0e-1') ELSE concat(l_suppkey, '.0') END AS supplier
        FROM lineitem WHERE l_suppkey = 7""",
    "export_rerun": f"""WITH {CURRENT}, {BEFORE} SELECT *, {LOG_NOW} FROM cur
        UNION ALL SELECT *, {log_columns("'INSERT'", '2025-01-01T00:00:00.000Z', 'job-0')} FROM old""",
    "missing_rows": f"WITH {CURRENT}, {BEFORE} SELECT * FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)",
    "existing_rows": f"WITH {CURRENT}, {BEFORE} SELECT * FROM cur WHERE {KNOWN}",
    "sync_type_drift": f"{CDC} SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey) FROM cdc",
    "sync_type_drift_history": f"{CDC} SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey) FROM ({HISTORY})",
    "upsert_update": f"WITH {CURRENT}, {BEFORE} {MERGED}",
    "upsert_ignore": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "reconcile": f"WITH {CURRENT}, {BEFORE} {MERGED}",
    "reconcile_changes": f"WITH {CURRENT}, {BEFORE} SELECT *, {CHANGE} AS change FROM cur",
    "reconcile_changed_only": f"""WITH {CURRENT}, {BEFORE} SELECT *, {CHANGE} AS change FROM cur
        WHERE NOT ({KNOWN} AND o_orderpriority <> '1-URGENT')""",
    "changelog_build": f"WITH {CURRENT}, {BEFORE} SELECT *, {LOG_NOW} FROM cur",
    "changelog_merge": f"""WITH {CURRENT}, {BEFORE} SELECT *, {LOG_NOW} FROM cur
        UNION ALL SELECT *, {log_columns("'INSERT'", '2025-01-01T00:00:00.000Z', 'job-0')} FROM old""",
    "truncate_reload": first_by(
        f'(SELECT *, {ref(LINES)} AS "$_ref" FROM lineitem)', ["l_orderkey", "l_linenumber"], '"$_ref"'
    ),
    "append_insert": f"WITH {CURRENT}, {BEFORE} SELECT *, NULL AS loaded FROM cur UNION ALL SELECT *, 'before' FROM old",
    "outbound_upsert": f"WITH {CURRENT}, {BEFORE} SELECT {O} FROM ({MERGED})",
    "outbound_reconcile_changelog": f"WITH {CURRENT}, {BEFORE} SELECT *, {LOG_NOW} FROM cur",
    "outbound_reload_changelog": f"""WITH {CURRENT}
        SELECT *, {log_columns("'TRUNCATE_RELOAD'", '2025-01-02T00:00:00.000Z', 'job-1')} FROM cur""",
    "export_stored_upsert": f"WITH {CURRENT}, {BEFORE} SELECT {O} FROM ({MERGED})",
    "export_stored_reconcile": f"WITH {CURRENT}, {BEFORE} SELECT {O} FROM ({MERGED})",
    "export_stored_changelog": f"""WITH {CURRENT}, {BEFORE} SELECT *, {LOG_NOW} FROM cur
        UNION ALL SELECT *, {log_columns("'INSERT'", '2025-01-01T00:00:00.000Z', 'job-0')} FROM old""",
    "outbound_csv": f"{CDC} SELECT * FROM cdc",
    "partition_filter": "SELECT * FROM orders WHERE o_orderpriority = '3-MEDIUM'",
    "partition_build": " UNION ALL ".join(
        f"SELECT '{'clients' if name == 'customer' else name}' AS table_name, {ref(cols)} AS \"$_ref\" FROM {t} WHERE {key} = 7"
        for name, (t, key, cols) in TABLES_OF_7.items()
    ),
    "partition_extract": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {ref(cols)} AS \"$_ref\" FROM {t} WHERE {key} = 7"
        for name, (t, key, cols) in TABLES_OF_7.items()
    ),
    "partition_stats": "WITH s AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {t} WHERE {key} = 7"
        for name, (t, key, _) in TABLES_OF_7.items()
    )
    + ") SELECT * FROM s UNION ALL SELECT 'total_rows', CAST(sum(row_count) AS BIGINT) FROM s",
    "partition_build_all": " UNION ALL ".join(
        f"SELECT '{'clients' if name == 'customer' else name}' AS table_name, CAST({key} AS VARCHAR) AS nation,"
        f" {ref(cols)} AS \"$_ref\" FROM {t}"
        for name, (t, key, cols) in (TABLES_OF_7 | {"orders": ("orders", "o_orderpriority", ORDERS)}).items()
    ),
    "direct_dependents": f"WITH {EDGES} SELECT id FROM edges WHERE source = 'n:7'",
    "cascade_dependents": f"""WITH RECURSIVE {EDGES}, walk AS (
          SELECT 'n:7' AS id, 0 AS level
          UNION SELECT e.id, w.level + 1 FROM walk w JOIN edges e ON e.source = w.id)
        SELECT id, max(level) AS level FROM walk WHERE level > 0 GROUP BY id""",
    "sink_parquet": f"{CDC} SELECT * FROM cdc",
    "sink_csv": "SELECT * FROM events",
}
