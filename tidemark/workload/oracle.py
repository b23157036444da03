"""The registered queries in SQL, for the tables as DuckDB views."""

from __future__ import annotations

from tidemark.workload.frames import FEED_SINCE, WATERMARK_CUT

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
DAY = "strftime(ts, '%Y-%m-%d')"


def uoid(database: str, schema: str, table: str) -> str:
    """Version-5 UUID of a table name, over SHA-1."""
    name = f"encode({database} || chr(0) || {schema} || chr(0) || {table})"
    x = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || {name})"
    nibble = f"substr('89ab', 1 + (('0x' || substr({x}, 17, 1))::INTEGER % 4), 1)"
    return (
        f"(substr({x},1,8) || '-' || substr({x},9,4) || '-5' || substr({x},14,3) || '-' ||"
        f" {nibble} || substr({x},18,3) || '-' || substr({x},21,12))"
    )


USERS_ID = uoid("'app'", "'web'", "'users'")
USERS_VERSION = "('0x' || substr(sha256('user_id:bigint|event_type:string|value:double|k:int'), 1, 15))::BIGINT"

LOG = f"""
log AS (
  SELECT event_id + 1 AS seq, CASE WHEN event_type = 'signup' THEN event_id + 1 END AS created,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
         user_id, event_type,
         CASE WHEN event_type NOT IN ('view', 'error') THEN value END AS value,
         CASE WHEN event_type NOT IN ('click', 'error') THEN {K} END AS k
  FROM events)"""

# ---- sources

Q: dict[str, str] = {}

Q["full_load"] = """
SELECT 100::BIGINT AS "SYS_CHANGE_VERSION", NULL::BIGINT AS "SYS_CHANGE_CREATION_VERSION", 'L' AS "SYS_CHANGE_OPERATION", *
FROM customer"""

Q["incremental_changes"] = f"""
WITH feed AS (
  SELECT date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 1 AS v, o_orderstatus AS s, o_orderkey FROM orders)
SELECT v AS "SYS_CHANGE_VERSION", CASE WHEN s = 'P' THEN v END AS "SYS_CHANGE_CREATION_VERSION",
       CASE s WHEN 'F' THEN 'D' WHEN 'P' THEN 'I' ELSE 'U' END AS "SYS_CHANGE_OPERATION",
       feed.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM feed LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') t ON t.o_orderkey = feed.o_orderkey
WHERE v > {FEED_SINCE}"""


def net(keys: str, created: str) -> str:
    return f"""
net AS (
  SELECT {keys}, max(seq) AS last_seq, {created}(seq) FILTER (op = 'I') AS created,
         CASE WHEN arg_max(op, seq) = 'D' THEN 'D'
              WHEN max(seq) FILTER (op = 'I') > coalesce(max(seq) FILTER (op = 'D'), -1) THEN 'I' ELSE 'U' END AS op
  FROM log GROUP BY {keys})"""


NET_COLUMNS = 'last_seq AS "SYS_CHANGE_VERSION", created AS "SYS_CHANGE_CREATION_VERSION", op AS "SYS_CHANGE_OPERATION"'

Q["net_changes"] = f"WITH {LOG}, {net('user_id', 'max')} SELECT {NET_COLUMNS}, user_id FROM net"
Q["net_changes_first_insert"] = f"WITH {LOG}, {net('user_id', 'min')} SELECT {NET_COLUMNS}, user_id FROM net"

Q["incremental_changes_composite_key"] = f"""
WITH {LOG}, {net('user_id, event_type', 'max')},
cur AS (
  SELECT user_id, event_type, value, k FROM log WHERE op <> 'D'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq DESC) = 1)
SELECT {NET_COLUMNS}, net.user_id, net.event_type, cur.value, cur.k
FROM net LEFT JOIN cur ON cur.user_id = net.user_id AND cur.event_type = net.event_type"""


def info(later: bool) -> str:
    """Source columns per customer, without the change column."""
    amount = "(c_nationkey + 5)"
    if not later:
        parts = [
            (1, "id", "'int'", "10", "0", "true"),
            (3, "amount", "'decimal'", amount, "2", "true"),
            (4, "note", "'nvarchar'", "NULL", "NULL", "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
        ]
    else:
        parts = [
            (1, "id", "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'bigint' ELSE 'int' END",
             "CASE WHEN c_mktsegment = 'FURNITURE' THEN 19 ELSE 10 END", "0", "true"),
            (2, "amount", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'money' ELSE 'decimal' END",
             f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN {amount} + 1 ELSE {amount} END", "2", "true"),
            (3, "note", "'nvarchar'", "NULL", "NULL", "c_mktsegment = 'MACHINERY'"),
            (4, "flag", "'bit'", "NULL", "NULL", "c_mktsegment = 'AUTOMOBILE'"),
        ]
    return " UNION ALL ".join(
        f"SELECT 'crm.' || c_name AS table_name, {o} AS ordinal, '{n}' AS name, {t} AS type,"
        f" CAST({p} AS INTEGER) AS \"precision\", CAST({s} AS INTEGER) AS scale FROM customer WHERE {w}"
        for o, n, t, p, s, w in parts
    )


def fingerprints(columns: str) -> str:
    return (
        "SELECT table_name, ('0x' || substr(sha256(string_agg(name || ':' || type, '|' ORDER BY ordinal)), 1, 15))::BIGINT"
        f" AS schema_version FROM {columns} GROUP BY table_name"
    )


Q["column_metadata"] = info(False)
Q["schema_fingerprint"] = f"WITH cols AS ({info(False)}) {fingerprints('cols')}"
Q["primary_key_map"] = f"""
WITH cols AS ({info(False)})
SELECT table_name, string_agg(name, ',' ORDER BY ordinal DESC) AS primary_key FROM cols GROUP BY table_name"""

CONFIGURED = """
configured AS (
  SELECT DISTINCT CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN ' dbo.VIEW ' ELSE 'dbo.' || event_type END AS table_name,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'incremental' WHEN event_type <> 'signup' THEN 'full_incremental' END AS mode
  FROM events
  UNION ALL SELECT DISTINCT 'old_' || event_type, 'incremental' FROM events)"""

NAME = "CASE WHEN trim(table_name) LIKE '%.%' THEN lower(trim(table_name)) ELSE 'dbo.' || lower(trim(table_name)) END"

BOUNDS = "bounds AS (SELECT 'dbo.' || event_type AS table_name, min(event_id) + 1 AS min_version FROM events GROUP BY 1)"

Q["resolve_tables"] = f"""
WITH {CONFIGURED}, {BOUNDS}
SELECT c.table_name AS configured_name, b.table_name AS resolved_name,
       CASE WHEN b.table_name IS NULL THEN 'error' ELSE 'ok' END AS status, c.mode
FROM (SELECT *, {NAME} AS n FROM configured) c LEFT JOIN bounds b ON b.table_name = c.n"""

Q["feed_bounds"] = """
SELECT 'dbo.' || event_type AS table_name, min(event_id) + 1 AS min_version, max(event_id) + 1 AS max_version,
       count(*) AS change_count, (SELECT max(event_id) + 1 FROM events) AS db_version
FROM events GROUP BY 1"""

# ---- envelope

Q["envelope_encode"] = f"""
WITH {LOG}
SELECT 'lake' AS catalog, 'web' AS schema_name, 'users' AS table_name, {USERS_ID} AS uoid, NULL::VARCHAR AS lsn,
       seq::VARCHAR AS seq_num, seq::VARCHAR AS sequence, NULL::BIGINT AS cursor_ts,
       1700000000000::BIGINT AS "extractionTimestamp", operation, {USERS_VERSION} AS "schemaVersion",
       user_id, event_type, value, k, 'user_id,event_type,value,k' AS fields
FROM log"""

Q["envelope_decode"] = f"WITH {LOG} SELECT seq AS _seq_num, operation, user_id, event_type, value, k FROM log"
Q["soft_delete_flag"] = (
    f"WITH {LOG} SELECT seq AS _seq_num, operation, operation = 'DELETE' AS _is_deleted, user_id, event_type, value, k FROM log"
)
Q["envelope_timestamps"] = """
WITH s AS (SELECT event_id, strftime(ts::TIMESTAMP + to_microseconds((event_id * 7919) % 1000000), '%Y-%m-%d %H:%M:%S.%f') AS t FROM events)
SELECT event_id, t AS at_text, t AS local_text FROM s"""
Q["envelope_binary"] = """
SELECT doc_id, CASE WHEN lang <> 'fr' THEN md5(to_base64(encode(text))) END AS base64_md5,
       CASE WHEN lang <> 'fr' THEN octet_length(encode(text))::INTEGER END AS n_bytes
FROM documents"""
Q["operation_decode"] = """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE'
  WHEN event_type = 'view' THEN 'LOAD' WHEN event_type = 'purchase' THEN substr(props, 7, 1)
  WHEN value < 50 THEN 'UNKNOWN' WHEN value < 75 THEN 'UPDATE' ELSE 'UNKNOWN' END AS operation
FROM events"""
Q["table_uoid"] = f"SELECT c_custkey, {uoid('lower(c_mktsegment)', chr(39) + 'a.' + chr(39) + ' || c_nationkey', 'c_name')} AS uoid FROM customer"
Q["demux_counts"] = f"""
SELECT {uoid("'app'", "'dbo'", "event_type")} AS _uoid, event_type AS table_name, count(*) AS events,
       count(*) FILTER (event_type = 'error') AS deletes, sum(user_id)::BIGINT AS user_sum
FROM events GROUP BY 1, 2"""

# ---- apply


def scd1(deletes: str = "operation = 'DELETE'", keys: str = "user_id", events: str = "log") -> str:
    """Type 1 with deletes that remove rows and NULLs that keep the earlier value."""
    return f"""
marked AS (SELECT *, coalesce({deletes}, false) AS del FROM {events}),
seen AS (SELECT *, max(CASE WHEN del THEN seq END) OVER (PARTITION BY {keys}) AS dseq FROM marked)
SELECT {keys}, arg_max(value, seq) FILTER (value IS NOT NULL) AS value, arg_max(k, seq) FILTER (k IS NOT NULL) AS k
FROM seen WHERE dseq IS NULL OR seq > dseq GROUP BY {keys}"""


Q["scd1_ignore_nulls"] = f"WITH {LOG}, {scd1()}"
for same in ("scd1_apply", "scd1_out_of_order", "scd1_streaming"):
    Q[same] = Q["scd1_ignore_nulls"]
Q["demux_apply"] = f"""
WITH {LOG}, good AS (SELECT event_type AS table_name, * FROM log WHERE seq % 29 <> 0), {scd1(keys="table_name, user_id", events="good")}"""
Q["rejected_rows"] = f"""
WITH {LOG}
SELECT seq AS seq_num, operation, reason FROM (
  SELECT *, CASE WHEN seq % 13 = 0 THEN 'malformed payload' WHEN seq % 17 = 0 THEN 'no key' WHEN seq % 19 = 0 THEN 'malformed payload'
                 WHEN seq % 23 = 0 THEN 'no payload' END AS reason FROM log)
WHERE reason IS NOT NULL"""
Q["scd1_streaming_reload"] = f"""
WITH {LOG}, cut AS (SELECT max(seq) // 2 AS v FROM log),
upto AS (SELECT * FROM log WHERE seq <= (SELECT v FROM cut)),
state AS (WITH {scd1(events="upto")}),
after AS (
  SELECT (SELECT v FROM cut) AS seq, 'LOAD' AS operation, user_id, value, k FROM state WHERE user_id % 3 = 0
  UNION ALL SELECT seq, operation, user_id, value, k FROM log WHERE seq > (SELECT v FROM cut)),
{scd1(events="after")}"""
Q["recompute_after_type_change"] = f"""
WITH {LOG}, cut AS (SELECT max(seq) // 2 AS v FROM log),
retyped AS (
  SELECT * REPLACE (CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || CASE WHEN seq > (SELECT v FROM cut) THEN ' EUR' ELSE '' END AS value) FROM log),
{scd1(events="retyped")}"""
Q["envelope_decode_generations"] = f"""
SELECT event_id + 1 AS _seq_num, 'UPDATE' AS operation, user_id,
       CASE WHEN (event_id + 1) % 3 = 0 THEN strftime(ts, '%Y-%m-%d 00:00:00') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at,
       CASE WHEN (event_id + 1) % 3 = 0 THEN CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) ELSE value END AS value,
       CASE WHEN (event_id + 1) % 3 <> 0 THEN {K} END AS k
FROM events"""
Q["scd1_delete_predicate"] = f"WITH {LOG}, " + scd1("operation = 'DELETE' OR k > 90")
Q["scd1_composite_key"] = f"WITH {LOG}, " + scd1(keys="user_id, event_type")
Q["scd1_keep_nulls"] = f"""
WITH {LOG}
SELECT user_id, value, k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS n FROM log)
WHERE n = 1 AND op <> 'D'"""
Q["scd1_soft_delete"] = f"""
WITH {LOG}
SELECT user_id, arg_max(value, seq) FILTER (value IS NOT NULL) AS value, arg_max(k, seq) FILTER (k IS NOT NULL) AS k,
       arg_max(op, seq) = 'D' AS _is_deleted
FROM log GROUP BY user_id"""
Q["scd1_after_reload"] = f"""
WITH {LOG},
firsts AS (SELECT user_id, min(seq) AS seq FROM log GROUP BY user_id),
kept AS (
  SELECT log.* REPLACE (CASE WHEN firsts.seq IS NOT NULL THEN 'LOAD' ELSE operation END AS operation)
  FROM log LEFT JOIN firsts ON firsts.user_id = log.user_id AND firsts.seq = log.seq
  WHERE log.seq >= (SELECT max(seq) FROM firsts)),
{scd1(events="kept")}"""


def scd2(soft: bool = False) -> str:
    segment = "0" if soft else (
        "coalesce(sum(CASE WHEN op = 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY seq"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    w = "OVER (PARTITION BY user_id, seg ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
segments AS (SELECT *, {segment} AS seg, lead(seq) OVER (PARTITION BY user_id ORDER BY seq) AS next_seq FROM log),
versions AS (
  SELECT user_id, last_value(value IGNORE NULLS) {w} AS value, last_value(k IGNORE NULLS) {w} AS k,
         op = 'D' AS del, seq AS __start_at, next_seq AS __end_at
  FROM segments)"""


SCD2 = f"WITH {LOG}, {scd2()} SELECT user_id, value, k, __start_at, __end_at FROM versions WHERE NOT del"
for same in ("scd2_apply", "scd2_split_keys", "scd2_streaming"):
    Q[same] = SCD2
Q["scd2_soft_delete"] = f"WITH {LOG}, {scd2(True)} SELECT user_id, value, k, del AS _is_deleted, __start_at, __end_at FROM versions"
Q["scd2_keep_nulls"] = f"""
WITH {LOG}, v AS (SELECT *, lead(seq) OVER (PARTITION BY user_id ORDER BY seq) AS n FROM log)
SELECT user_id, value, k, seq AS __start_at, n AS __end_at FROM v WHERE op <> 'D'"""
Q["scd2_current"] = f"{SCD2} AND __end_at IS NULL"
Q["scd2_as_of"] = f"""
WITH {LOG}, {scd2()}, moment AS (SELECT min(event_id) AS m FROM events WHERE event_type = 'purchase' AND value > 90)
SELECT user_id, value, k, __start_at, __end_at FROM versions, moment
WHERE NOT del AND __start_at <= m AND (__end_at IS NULL OR __end_at > m)"""
Q["bronze_stream"] = f"WITH {LOG} SELECT {USERS_ID} AS _uoid, operation, count(*) AS events, max(seq) AS last_seq FROM log GROUP BY operation"
ROW_CHANGES = f"""
o AS (WITH {scd1(events="early")}),
n AS (WITH {scd1()}),
j AS (SELECT o.user_id AS ou, o.value AS ov, o.k AS ok, n.user_id AS nu, n.value AS nv, n.k AS nk
      FROM o FULL JOIN n ON n.user_id = o.user_id),
u AS (SELECT * FROM j WHERE ou IS NOT NULL AND nu IS NOT NULL AND (ov IS DISTINCT FROM nv OR ok IS DISTINCT FROM nk))
SELECT 'insert' AS _change_type, nu AS user_id, nv AS value, nk AS k FROM j WHERE ou IS NULL
UNION ALL SELECT 'delete', ou, ov, ok FROM j WHERE nu IS NULL
UNION ALL SELECT 'update_preimage', ou, ov, ok FROM u
UNION ALL SELECT 'update_postimage', nu, nv, nk FROM u"""
Q["silver_change_feed"] = f"""
WITH {LOG},
early AS (SELECT * FROM log WHERE seq IN (SELECT event_id + 1 FROM events WHERE ts < TIMESTAMP '{WATERMARK_CUT}')), {ROW_CHANGES}"""
Q["silver_changes_between"] = f"""
WITH {LOG}, early AS (SELECT * FROM log WHERE seq <= (SELECT max(seq) * 9 // 10 FROM log)), {ROW_CHANGES}"""
Q["type_widening"] = """
SELECT p_partkey, p_size::BIGINT AS size, p_retailprice::DECIMAL(14,4) AS price,
       CASE WHEN p_size <= 25 THEN p_type END AS old_type, CASE WHEN p_size > 25 THEN p_brand END AS p_brand
FROM part"""

# ---- scalar functions

Q["partition_date"] = f"""
SELECT event_id, {DAY} AS ts_day,
       CASE WHEN event_type IN ('signup', 'view', 'click') THEN {DAY}
            WHEN event_type = 'error' AND value < 30 THEN {DAY} ELSE '_unknown' END AS text_day,
       '_unknown' AS number_day
FROM events"""
Q["split_table_name"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'dbo' WHEN 'MACHINERY' THEN 'a' ELSE c_mktsegment END AS schema_name,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'b.' || c_name ELSE c_name END AS table_name
FROM customer"""

# ---- ledger and planning

LEDGER = f"""
ledger AS (
  SELECT 'dbo.' || event_type AS table_name, {DAY} AS d, event_type = 'view' AS bare, max(event_id) + 1 AS version, count(*) AS n
  FROM events GROUP BY event_type, {DAY}),
entries AS (
  SELECT table_name, version, CASE WHEN NOT bare THEN version - n END AS since_version, CASE WHEN NOT bare THEN n END AS rows_synced,
         CASE WHEN NOT bare THEN 'incremental' END AS mode, CASE WHEN NOT bare THEN d END AS files,
         CASE WHEN NOT bare THEN n / 4.0 END::DOUBLE AS duration_seconds,
         CASE WHEN bare THEN d ELSE d || 'T23:59:59Z' END AS synced_at
  FROM ledger)"""
Q["latest_watermarks"] = f"""
WITH {LEDGER} SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY synced_at DESC) = 1"""
Q["sync_history"] = f"WITH {LEDGER} SELECT * EXCLUDE (files) FROM entries ORDER BY synced_at, table_name, version"
Q["min_valid_versions"] = f"""
WITH {BOUNDS} SELECT table_name, CASE WHEN table_name = 'dbo.click' THEN 0 ELSE min_version END AS min_version FROM bounds"""

MARKS = f"""
marks AS (
  SELECT 'dbo.' || event_type AS table_name, CASE WHEN event_type = 'view' THEN min(event_id) ELSE max(event_id) + 1 END AS version
  FROM events WHERE ts < TIMESTAMP '{WATERMARK_CUT}' AND event_type <> 'purchase' GROUP BY event_type)"""
FEED = f"""
feed AS (
  SELECT 'dbo.' || event_type AS table_name, seq, op, user_id FROM log
  WHERE event_type <> 'signup' OR seq <= (SELECT version FROM marks WHERE table_name = 'dbo.signup'))"""
CHANGED = "SELECT table_name FROM marks WHERE EXISTS (SELECT 1 FROM feed WHERE feed.table_name = marks.table_name AND seq > marks.version)"
Q["changed_tables"] = f"WITH {LOG}, {MARKS}, {FEED} {CHANGED}"
UNCHANGED = f"SELECT m.table_name FROM marks m JOIN bounds b USING (table_name) WHERE version >= min_version AND m.table_name NOT IN ({CHANGED})"
Q["unchanged_tables"] = f"""
WITH {LOG}, {MARKS}, {FEED}, {BOUNDS}
SELECT table_name, 'skipped' AS status, 'no changes' AS reason FROM ({UNCHANGED})"""


def modes(tables: str, mode: str, key_check: bool) -> str:
    no_key = "since_version >= min_version AND n = 'dbo.error'" if key_check else "false"
    return f"""
asked AS (
  SELECT c.table_name, {mode} AS configured_mode, c.n, m.version AS since_version, coalesce(b.min_version, 0) AS min_version
  FROM (SELECT *, {NAME} AS n FROM {tables}) c LEFT JOIN marks m ON m.table_name = c.n LEFT JOIN bounds b ON b.table_name = c.n),
decided AS (
  SELECT *, CASE WHEN since_version IS NULL AND configured_mode = 'incremental' THEN 'no watermark for an incremental read'
                 WHEN {no_key} THEN 'no primary key for an incremental read' END AS error,
         CASE WHEN since_version IS NULL OR since_version < min_version THEN 'full' ELSE 'incremental' END AS how
  FROM asked)"""


DECISION = """
SELECT table_name, configured_mode, CASE WHEN error IS NULL THEN how END AS actual_mode,
       CASE WHEN error IS NULL AND how = 'incremental' THEN since_version END AS since_version, min_version,
       CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error
FROM decided"""
Q["sync_mode"] = f"WITH {MARKS}, {BOUNDS}, {CONFIGURED}, {modes('configured', chr(99) + 'oalesce(c.mode, ' + chr(39) + 'full_incremental' + chr(39) + ')', True)} {DECISION}"
Q["sync_mode_override"] = f"""WITH {MARKS}, {BOUNDS}, {CONFIGURED}, {modes('configured', "'incremental'", False)} {DECISION}"""
ASKED_MODE = "CASE WHEN c.n = 'dbo.purchase' THEN 'incremental' ELSE 'full_incremental' END"
Q["multi_table_sync"] = f"""
WITH {LOG}, {MARKS}, {FEED}, {BOUNDS}, {modes('bounds', ASKED_MODE, True)},
fate AS (
  SELECT d.*, CASE WHEN error IS NOT NULL THEN 'error' WHEN d.table_name IN ({UNCHANGED}) THEN 'skipped' ELSE 'success' END AS status
  FROM decided d)
SELECT table_name, configured_mode, CASE WHEN status = 'success' THEN how END AS actual_mode,
       CASE WHEN status = 'success' AND how = 'incremental' THEN since_version END AS since_version,
       CASE WHEN status = 'success' THEN (SELECT max(seq) FROM feed) END AS current_version,
       CASE WHEN status = 'success' AND how = 'full' THEN (SELECT count(DISTINCT user_id) FROM feed WHERE feed.table_name = fate.table_name)
            WHEN status = 'success' THEN (SELECT count(*) FROM feed WHERE feed.table_name = fate.table_name AND seq > since_version)
       END AS rows_written,
       status, CASE WHEN status = 'skipped' THEN 'no changes' END AS reason, error
FROM fate"""

Q["sync_from_tables"] = f"""
WITH newest AS (SELECT max(date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 1) AS v FROM orders),
landed AS (
  SELECT 'sales.orders' AS t, CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'P' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 1 AS seq_num, o_orderkey AS key,
         CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice, 2) END AS amount,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS label, 6 AS fields
  FROM orders WHERE date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 1 > {FEED_SINCE}
  UNION ALL
  SELECT 'customer', 'LOAD', (SELECT v FROM newest), c_custkey, round(c_acctbal, 2), c_mktsegment,
         (SELECT count(*) FROM (DESCRIBE customer)) FROM customer),
decided AS (
  SELECT 'sales.orders' AS table_name, 'full_incremental' AS configured_mode, 'incremental' AS actual_mode, {FEED_SINCE}::BIGINT AS since_version,
         'success' AS status, NULL AS reason, NULL AS error, NULL AS error_type
  UNION ALL SELECT 'customer', 'full_incremental', 'full', NULL, 'success', NULL, NULL, NULL
  UNION ALL SELECT 'stock.part', 'incremental', NULL, NULL, 'error', NULL, 'no watermark for an incremental read', 'SyncError'
  UNION ALL SELECT 'stock.supplier', 'full_incremental', NULL, NULL, 'skipped', 'no changes', NULL, NULL)
SELECT d.*, CASE WHEN status = 'success' THEN (SELECT v FROM newest) END AS current_version,
       CASE WHEN status = 'success' THEN (SELECT count(*) FROM landed l WHERE l.t = d.table_name) END AS rows_written,
       l.operation, l.seq_num, l.key, l.amount, l.label, l.fields
FROM decided d LEFT JOIN landed l ON l.t = d.table_name"""

# ---- schema history

SCHEMAS = f"""
old AS ({info(False)}), new AS ({info(True)}),
old_v AS ({fingerprints('old')}), new_v AS ({fingerprints('new')}),
both_sides AS (
  SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.name, o.name) AS name, o.type AS old_type, n.type AS new_type,
         o.ordinal AS old_ordinal, n.ordinal AS new_ordinal, o."precision" AS old_p, n."precision" AS new_p, o.scale AS old_s, n.scale AS new_s
  FROM old o FULL JOIN new n ON n.table_name = o.table_name AND n.name = o.name)"""
DIFF = """
SELECT table_name, name, CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'type_changed' END AS change,
       old_type, new_type
FROM both_sides WHERE old_type IS DISTINCT FROM new_type"""
Q["schema_diff"] = f"WITH {SCHEMAS} {DIFF}"
Q["schema_drift"] = f"""
WITH {SCHEMAS}, changes AS (SELECT table_name, count(*) AS n FROM ({DIFF}) GROUP BY table_name)
SELECT v.table_name, coalesce(n, 0) AS changed_columns, coalesce(n, 0) > 0 AS schema_changed,
       coalesce(n, 0) = 0 AND o.schema_version <> v.schema_version AS drifted
FROM new_v v JOIN old_v o USING (table_name) LEFT JOIN changes c ON c.table_name = v.table_name"""
Q["schema_merge"] = f"""
WITH {SCHEMAS},
moved AS (
  SELECT *, new_type IS NOT NULL AND (old_type IS NULL OR old_type <> new_type
            OR (new_p IS NOT NULL AND new_p IS DISTINCT FROM old_p) OR (new_s IS NOT NULL AND new_s IS DISTINCT FROM old_s)) AS moved,
         old_type <> new_type AS retyped
  FROM both_sides),
touched AS (
  SELECT m.*, v.schema_version AS new_version, o.schema_version AS old_version,
         bool_or(moved) OVER (PARTITION BY m.table_name) OR v.schema_version <> o.schema_version AS touched,
         max(old_ordinal) OVER (PARTITION BY m.table_name) AS last_ordinal
  FROM moved m JOIN new_v v ON v.table_name = m.table_name JOIN old_v o ON o.table_name = m.table_name)
SELECT table_name,
       CASE WHEN old_ordinal IS NOT NULL THEN old_ordinal
            ELSE last_ordinal + row_number() OVER (PARTITION BY table_name, old_ordinal IS NULL ORDER BY new_ordinal) END::INTEGER AS ordinal,
       name, coalesce(new_type, old_type) AS type,
       CASE WHEN retyped THEN new_p ELSE coalesce(new_p, old_p) END AS "precision",
       CASE WHEN retyped THEN new_s ELSE coalesce(new_s, old_s) END AS scale,
       CASE WHEN retyped THEN old_type END AS previous_type,
       CASE WHEN touched AND new_type IS NOT NULL THEN '2024-02-01' WHEN old_type IS NOT NULL THEN '2024-01-01' END AS last_seen,
       CASE WHEN touched THEN new_version ELSE old_version END AS schema_version
FROM touched"""

# ---- manifest

CENTS = "CAST(round(s_acctbal * 100) AS BIGINT)"
RESULTS = f"""
results AS (
  SELECT 'db' || (s_nationkey % 5) AS database, s_nationkey, s_name,
         CASE WHEN {CENTS} % 11 <> 0 THEN 'sales' END AS schema_name,
         s_acctbal < 0 AS failed,
         CASE WHEN {CENTS} % 3 <> 0 THEN CASE WHEN {CENTS} % 5 = 0 THEN 0 ELSE 1 END END AS n_files,
         CASE WHEN {CENTS} % 4 <> 0 THEN {CENTS} % 7 END AS rows_written
  FROM supplier),
added AS (
  SELECT database, schema_name, s_name AS table_name, rows_written,
         CASE WHEN r_regionkey <> 3 THEN lower(r_name) END AS catalog_target, 'sales_lake' AS schema_target, s_name AS table_target,
         '/data/' || database || '/sales/' || s_name AS file_path, 'parquet' AS file_type,
         CAST(1 + s_nationkey % 2 AS INTEGER) AS scd_type, CASE WHEN s_nationkey % 3 = 0 THEN true END AS soft_delete, 'id' AS primary_key
  FROM results JOIN region ON database = 'db' || r_regionkey
  WHERE NOT failed AND schema_name IS NOT NULL
    AND CASE WHEN n_files IS NOT NULL THEN n_files > 0 WHEN rows_written IS NOT NULL THEN rows_written > 0 ELSE true END),
known AS (
  SELECT 'db' || (s_nationkey % 5) AS database, 'sales' AS schema_name, s_name AS table_name,
         CASE WHEN s_nationkey <> 4 THEN 'custom' END AS catalog_target, 'sales_lake' AS schema_target, 't_' || s_suppkey AS table_target,
         '/user/' || s_name AS file_path, 'parquet' AS file_type, NULL::INTEGER AS scd_type, NULL::BOOLEAN AS soft_delete,
         NULL::VARCHAR AS primary_key
  FROM supplier WHERE s_nationkey < 12),
merged AS (
  SELECT * FROM known
  UNION ALL
  SELECT * EXCLUDE (rows_written) FROM added a
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.database = a.database AND k.schema_name = a.schema_name AND k.table_name = a.table_name))"""
Q["manifest_merge_add"] = f"WITH {RESULTS} SELECT * FROM merged"
Q["manifest_incremental"] = f"WITH {RESULTS} SELECT * EXCLUDE (rows_written) FROM added WHERE rows_written > 0"
Q["manifest_fallback"] = f"WITH {RESULTS} SELECT * FROM known"
Q["manifest_flatten"] = """
SELECT 'db' || (s_nationkey % 5) AS database, 'sales' AS schema_name, s_name AS table_name, 'lake' || s_nationkey AS catalog_target,
       'sales_lake' AS schema_target, 't_' || s_suppkey AS table_target, '/data/' || s_name AS file_path, 'parquet' AS file_type,
       CAST(1 + s_nationkey % 2 AS INTEGER) AS scd_type, s_nationkey % 3 = 0 AS soft_delete, 'id,line' AS primary_key
FROM supplier"""
Q["apply_plan"] = f"""
WITH {RESULTS}
SELECT catalog_target || '.' || schema_target || '.' || table_target AS target, database, schema_name, table_name,
       {uoid('database', 'schema_name', 'table_name')} AS uoid, coalesce(primary_key, '') AS primary_key,
       coalesce(scd_type, 1) AS scd_type, coalesce(soft_delete, false) AS soft_delete, file_path,
       CASE WHEN s.s_nationkey <> 7 THEN 'id:int,total:money' ELSE '' END AS columns
FROM merged m JOIN supplier s ON s.s_name = m.table_name
WHERE catalog_target IS NOT NULL"""

# ---- runs and reports

RUNS = f"""
grouped AS (
  SELECT {DAY} AS run_id, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total, max(event_id) AS last_id, max({K}) AS max_k
  FROM events WHERE event_type <> 'error' GROUP BY 1, 2),
res AS (
  SELECT run_id, event_type, CASE n % 7 WHEN 0 THEN 'error' WHEN 1 THEN 'skipped' ELSE 'success' END AS table_status,
         n % 7 NOT IN (0, 1) AS ok, n, last_id, max_k, total
  FROM grouped),
results AS (
  SELECT run_id, event_type, table_status,
         CASE WHEN table_status <> 'skipped' THEN CASE WHEN event_type = 'signup' THEN 'full' ELSE 'incremental' END END AS actual_mode,
         CASE WHEN ok THEN CASE WHEN event_type = 'click' THEN 2 ELSE 1 END END AS scd_type,
         CASE WHEN ok THEN event_type = 'purchase' END AS soft_delete,
         CASE WHEN ok AND event_type <> 'signup' THEN last_id + 1 - n END AS ct_since_version,
         CASE WHEN ok THEN last_id + 1 END AS ct_current_version,
         CASE WHEN ok THEN n END AS rows_written,
         CASE WHEN ok THEN CASE WHEN n % 2 = 0 THEN 1 ELSE 2 END END AS files_written,
         CASE WHEN ok THEN CAST(round(CAST(total AS DECIMAL(20,4)) / 100, 2) AS DOUBLE) END AS table_duration_seconds,
         CASE WHEN ok THEN max_k::BIGINT END AS schema_version,
         CASE WHEN ok THEN max_k < 98 END AS schema_changed,
         CASE WHEN ok THEN 3 END AS column_count,
         CASE WHEN table_status = 'skipped' THEN 'no changes' END AS skip_reason,
         CASE WHEN table_status = 'error' THEN 'connection lost' END AS error_message,
         CASE WHEN table_status = 'error' THEN 'ConnectionError' END AS error_type
  FROM res),
status AS (
  SELECT run_id, CASE WHEN bool_and(table_status = 'error') THEN 'failure' WHEN bool_or(table_status = 'error') THEN 'partial_failure'
                      ELSE 'success' END AS run_status
  FROM results GROUP BY run_id),
runs AS (
  SELECT {DAY} AS run_id, date_trunc('second', min(ts)) AS s, date_trunc('second', max(ts)) AS e FROM events GROUP BY 1),
log_rows AS (
  SELECT r.run_id, 'web_changes' AS pipeline_id, s, e, strftime(s, '%Y-%m-%d %H:%M:%S') AS run_started_at,
         strftime(e, '%Y-%m-%d %H:%M:%S') AS run_completed_at, round(epoch(e) - epoch(s), 2)::DOUBLE AS run_duration_seconds,
         run_status, 'web.yaml' AS pipeline_config, 'db.example' AS server,
         CASE WHEN event_type = 'click' THEN 'asia' ELSE 'app' END AS database,
         CASE WHEN event_type = 'view' THEN 'dbo' ELSE 'web' END AS schema_name, event_type AS table_name,
         CASE WHEN event_type = 'click' THEN 'asia.' ELSE 'app.' END || CASE WHEN event_type = 'view' THEN 'dbo.' ELSE 'web.' END || event_type AS table_fqn,
         CASE WHEN event_type = 'click' THEN 'lake_asia' ELSE 'lake_africa' END AS uc_catalog, '/ingest/web' AS ingest_pipeline,
         CASE WHEN event_type = 'click' THEN 'incremental' ELSE 'full_incremental' END AS configured_mode,
         actual_mode, scd_type, soft_delete, ct_since_version, ct_current_version, rows_written, files_written, table_duration_seconds,
         schema_version, schema_changed, column_count, table_status, skip_reason, error_message, error_type,
         strftime(s, '%Y-%m-%d') AS sync_date
  FROM results r JOIN runs USING (run_id) JOIN status USING (run_id))"""
Q["sync_log_rows"] = f"WITH {RUNS} SELECT * EXCLUDE (s, e) FROM log_rows"
Q["sync_log_scan"] = f"""
WITH {RUNS} SELECT sync_date, table_status, count(*) AS tables, coalesce(sum(rows_written), 0)::BIGINT AS rows_written
FROM log_rows GROUP BY 1, 2"""
Q["run_status"] = f"WITH {RUNS} SELECT * FROM status"
Q["run_totals"] = f"""
WITH {RUNS}
SELECT run_id, coalesce(sum(rows_written) FILTER (table_status <> 'error'), 0)::BIGINT AS total_rows_changed,
       coalesce(bool_or(schema_changed) FILTER (table_status <> 'error'), false) AS schema_changes_detected
FROM results GROUP BY run_id"""
Q["run_summary"] = f"""
WITH {RUNS}
SELECT run_id, count(*) FILTER (table_status <> 'error') AS tables_completed, coalesce(sum(rows_written), 0)::BIGINT AS total_rows,
       coalesce(sum(files_written), 0)::BIGINT AS total_files, count(*) FILTER (table_status = 'error') AS tables_failed
FROM results GROUP BY run_id"""

GATEWAY = f"""
raw AS (SELECT *, {K} AS k FROM events WHERE event_type <> 'signup'),
gateway AS (
  SELECT event_id::VARCHAR AS gateway_event_id, ts, {DAY} AS run_id, user_id, k, event_type = 'error' AS work,
         CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END AS table_identifier
  FROM raw WHERE k <> 99)"""
Q["gateway_parsed"] = f"""
WITH {GATEWAY}
SELECT gateway_event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", run_id, 'web_changes' AS pipeline_id, 'web' AS pipeline_name,
       'cloud-a' AS cloud, 'r' || (k % 5) AS region, 'org' AS org_id, 'c' || user_id AS cluster_id,
       'lake.app_web.' || table_identifier AS flow_name, table_identifier,
       CASE WHEN work THEN 'background_operation' ELSE 'flow_progress' END AS event_type,
       CASE WHEN work THEN 'WARN' ELSE 'INFO' END AS level, 'STABLE' AS maturity_level, 'user ' || user_id AS message,
       CASE WHEN NOT work THEN CASE WHEN k % 10 = 0 THEN 'FAILED' ELSE 'COMPLETED' END END AS flow_status,
       CASE WHEN NOT work THEN (k * 100)::VARCHAR END AS executor_time_ms,
       CASE WHEN NOT work THEN (k * 10)::VARCHAR END AS executor_cpu_time_ms,
       CASE WHEN NOT work THEN k::VARCHAR END AS stream_progress_raw,
       CASE WHEN work THEN CASE WHEN k < 50 THEN 'VACUUM' ELSE 'OPTIMIZE' END END AS bg_op_type,
       CASE WHEN work THEN 'DONE' END AS bg_op_status,
       CASE WHEN work THEN (k * 7)::VARCHAR END AS bg_op_duration_ms,
       CASE WHEN work THEN (k * 3)::VARCHAR END AS bg_rows_deleted,
       CASE WHEN work THEN (k * 1024)::VARCHAR END AS bg_bytes_deleted,
       CASE WHEN work THEN k::VARCHAR END AS bg_files_deleted
FROM gateway"""
Q["pipeline_parsed"] = f"""
WITH {RUNS}
SELECT run_id, pipeline_id AS ct_pipeline_id, pipeline_config, run_started_at, run_completed_at, run_duration_seconds,
       run_status AS overall_run_status, sync_date, server AS source_server, database AS source_database, table_fqn, table_name, schema_name,
       uc_catalog, ingest_pipeline, table_name AS table_identifier, rows_written, files_written, table_duration_seconds, table_status,
       configured_mode, actual_mode, scd_type, soft_delete, ct_since_version, ct_current_version, schema_version, schema_changed,
       column_count, error_message, error_type, skip_reason
FROM log_rows"""

UNIFIED = f"""
{RUNS}, {GATEWAY},
unified AS (
  SELECT coalesce(g.run_id, p.run_id) AS run_id, coalesce(g.table_identifier, p.table_name) AS table_identifier, p.table_fqn, p.table_name,
         g.ts, p.s, p.e, p.run_status AS overall_run_status, p.table_status,
         CASE WHEN NOT work THEN CASE WHEN k % 10 = 0 THEN 'FAILED' ELSE 'COMPLETED' END END AS flow_status,
         CASE WHEN work THEN 'background_operation' WHEN NOT work THEN 'flow_progress' END AS gateway_event_type,
         CASE WHEN work THEN 'WARN' WHEN NOT work THEN 'INFO' END AS gateway_log_level,
         CASE WHEN NOT work THEN k * 100 END::DOUBLE AS executor_time_ms,
         CASE WHEN NOT work THEN k * 10 END::DOUBLE AS executor_cpu_time_ms,
         CASE WHEN NOT work THEN k * 100 END::DOUBLE / 1000.0::DOUBLE AS executor_time_seconds,
         p.table_duration_seconds AS sync_duration_seconds, p.rows_written, p.files_written,
         CASE WHEN p.table_duration_seconds > 0 AND p.rows_written > 0 THEN p.rows_written / p.table_duration_seconds END AS rows_per_second,
         p.configured_mode, p.actual_mode, p.scd_type, p.ct_current_version AS change_tracking_version,
         CASE WHEN work THEN CASE WHEN k < 50 THEN 'VACUUM' ELSE 'OPTIMIZE' END END AS bg_op_type,
         CASE WHEN work THEN k * 7 END::DOUBLE AS bg_op_duration_ms,
         p.error_message, 'user ' || user_id AS gateway_message, p.database AS database_name, p.schema_name, p.uc_catalog,
         'c' || user_id AS cluster_id, g.run_id IS NULL AS missing_gateway_data, p.run_id IS NULL AS missing_pipeline_data,
         abs(CASE WHEN NOT work THEN k * 100 END::DOUBLE / 1000.0::DOUBLE - p.table_duration_seconds) AS timing_variance_seconds
  FROM gateway g FULL OUTER JOIN log_rows p ON g.run_id = p.run_id AND g.table_identifier = p.table_name)"""
SHOWN = """
SELECT * EXCLUDE (ts, s, e) REPLACE (round(rows_per_second + 1e-9, 4) AS rows_per_second, round(timing_variance_seconds + 1e-9, 4) AS timing_variance_seconds),
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS gateway_timestamp, strftime(s, '%Y-%m-%d %H:%M:%S') AS run_started_at,
       strftime(e, '%Y-%m-%d %H:%M:%S') AS run_completed_at
FROM unified"""
Q["unified_metrics"] = f"WITH {UNIFIED} {SHOWN}"
Q["recent_window"] = f"""
WITH {UNIFIED}, newest AS (SELECT max(ts) AS t FROM events) {SHOWN}, newest
WHERE ts > t - INTERVAL 7 DAYS OR s > t - INTERVAL 7 DAYS""".replace("SELECT * EXCLUDE (ts, s, e)", "SELECT * EXCLUDE (ts, s, e, t)")
Q["q1_timing_variance"] = f"""
WITH {UNIFIED}
SELECT table_fqn, run_id, sync_duration_seconds AS pipeline_reported_seconds, executor_time_seconds AS gateway_reported_seconds,
       round(timing_variance_seconds + 1e-9, 4) AS timing_variance_seconds, rows_written
FROM unified WHERE table_status = 'success' AND timing_variance_seconds IS NOT NULL
ORDER BY unified.timing_variance_seconds DESC, table_fqn, run_id, executor_time_seconds, sync_duration_seconds, rows_written LIMIT 20"""
Q["q2_cpu_outliers"] = f"""
WITH {UNIFIED}
SELECT table_fqn, round(avg(executor_cpu_time_ms) + 1e-9, 4) AS avg_cpu_ms, round(avg(rows_written) + 1e-9, 4) AS avg_rows,
       round(avg(executor_cpu_time_ms) / nullif(avg(rows_written), 0) + 1e-9, 4) AS cpu_ms_per_row, count(*) AS sync_count
FROM unified WHERE gateway_event_type = 'flow_progress' GROUP BY table_fqn HAVING count(*) > 1 ORDER BY cpu_ms_per_row DESC"""
Q["q3_incomplete_runs"] = f"""
WITH {UNIFIED}
SELECT run_id, count(*) AS pipeline_table_count, count(*) FILTER (NOT missing_gateway_data) AS gateway_event_count,
       count(*) FILTER (missing_gateway_data) AS missing_gateway_count
FROM unified GROUP BY run_id HAVING count(*) FILTER (missing_gateway_data) > 0"""
Q["q4_throughput"] = f"""
WITH {UNIFIED}
SELECT table_fqn, configured_mode, actual_mode, round(avg(rows_written) + 1e-9, 4) AS avg_rows, round(avg(sync_duration_seconds) + 1e-9, 4) AS avg_duration,
       round(avg(rows_per_second) + 1e-9, 4) AS avg_throughput_rps, round(max(rows_per_second) + 1e-9, 4) AS peak_throughput_rps
FROM unified WHERE table_status = 'success' AND rows_written > 0 GROUP BY 1, 2, 3"""
Q["q5_background_ops"] = f"""
WITH {UNIFIED}
SELECT table_fqn, bg_op_type, count(*) AS op_count, round(avg(bg_op_duration_ms) + 1e-9, 4) AS avg_duration_ms, max(bg_op_duration_ms) AS max_duration_ms
FROM unified WHERE bg_op_type IS NOT NULL GROUP BY 1, 2"""
Q["metrics_summary"] = f"""
WITH {UNIFIED}
SELECT strftime(coalesce(s, ts), '%Y-%m-%d') AS sync_date, table_fqn, uc_catalog, database_name, schema_name, configured_mode, scd_type,
       count(*) AS total_sync_attempts, count(*) FILTER (table_status = 'success') AS successful_syncs,
       count(*) FILTER (table_status <> 'success' OR table_status IS NULL) AS failed_syncs,
       sum(rows_written)::BIGINT AS total_rows_written, sum(files_written)::BIGINT AS total_files_written,
       round(avg(rows_written) + 1e-9, 4) AS avg_rows_per_sync, round(avg(sync_duration_seconds) + 1e-9, 4) AS avg_sync_duration,
       round(max(sync_duration_seconds) + 1e-9, 4) AS max_sync_duration,
       round(quantile_cont(sync_duration_seconds, 0.5) + 1e-9, 4) AS median_sync_duration,
       round(avg(executor_time_seconds) + 1e-9, 4) AS avg_executor_time, round(avg(executor_cpu_time_ms / 1000.0) + 1e-9, 4) AS avg_cpu_time_seconds,
       round(avg(rows_per_second) + 1e-9, 4) AS avg_throughput_rps, round(max(rows_per_second) + 1e-9, 4) AS peak_throughput_rps,
       count(*) FILTER (bg_op_type IS NOT NULL) AS bg_op_count, round(avg(bg_op_duration_ms) + 1e-9, 4) AS avg_bg_op_duration_ms
FROM unified GROUP BY ALL"""

Q["metrics_summary_refreshed"] = Q["metrics_summary"]

ORACLE_SQL = Q
