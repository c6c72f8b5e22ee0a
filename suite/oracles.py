"""The same results in SQL over the given tables."""

from __future__ import annotations

from quotelake.schemas import BRONZE_SCHEMA, REQUIRED_COLUMNS

# Texts of the timestamps: ISO-8601 in UTC with microseconds.
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_HOUR = "date_trunc('hour', ts)"

_EVENTS = f"""
events_view AS (
    SELECT event_id,
           CAST(ts AS DATE) AS dt,
           {_HOUR} AS event_time_ts,
           ts AS last_updated_ts,
           'poll-' || {_ISO.format(_HOUR)} AS ingestion_run_id,
           'events' AS source,
           'usd' AS vs_currency,
           event_type AS coin_id,
           substr(event_type, 1, 3) AS symbol,
           upper(event_type) AS name,
           CAST(event_id % 50 + 1 AS INTEGER) AS market_cap_rank,
           greatest(value, 0.01::DOUBLE) AS price_usd,
           CAST(event_id % 21 - 10 AS DOUBLE) AS price_change_percentage_24h,
           CAST(event_id % 1000 AS DOUBLE) AS market_cap_usd,
           CAST(event_id % 777 AS DOUBLE) AS total_volume_usd
    FROM events
)"""

_LINES = """
lines_view AS (
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
           CAST(l_shipdate AS TIMESTAMP) AS event_time_ts,
           CAST(NULL AS TIMESTAMP) AS last_updated_ts,
           concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)
               AS ingestion_run_id,
           'lineitem' AS source,
           'usd' AS vs_currency,
           CAST(l_partkey AS VARCHAR) AS coin_id,
           'p' || l_partkey AS symbol,
           'part ' || l_partkey AS name,
           l_linenumber AS market_cap_rank,
           l_extendedprice AS price_usd,
           l_discount AS price_change_percentage_24h,
           l_quantity AS market_cap_usd,
           l_tax AS total_volume_usd
    FROM lineitem
)"""

# What is left of the events after the injected faults.
_READABLE = "event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0"

_SILVER = """dt, event_time_ts, last_updated_ts, ingestion_run_id, source,
    vs_currency, coin_id, symbol, name, market_cap_rank, price_usd,
    price_change_percentage_24h, market_cap_usd, total_volume_usd"""
_QUOTES = """dt, event_time_ts, last_updated_ts, coin_id, symbol, name, vs_currency,
    market_cap_rank, price_usd, price_change_percentage_24h, market_cap_usd,
    total_volume_usd, source"""
_SNAPSHOT = _SILVER.replace("dt, ", "", 1)

_DAILY = """
SELECT dt, coin_id, symbol, name, vs_currency,
       round(avg(price_usd), 6) AS avg_price_usd,
       min(price_usd) AS min_price_usd,
       max(price_usd) AS max_price_usd,
       max(market_cap_usd) AS max_market_cap_usd,
       max(total_volume_usd) AS max_total_volume_usd,
       arg_max(price_usd, event_time_ts) AS last_price_usd
FROM {}
GROUP BY dt, coin_id, symbol, name, vs_currency"""


def _first(columns: str, source: str, keys: str, order: str, where: str = "TRUE") -> str:
    return f"""
SELECT {columns} FROM {source} WHERE {where}
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


_DEDUP_KEYS = "dt, coin_id, event_time_ts"
_UPDATED = "last_updated_ts DESC NULLS LAST"
_BY_TIME = f"event_time_ts DESC, {_UPDATED}"
_LINE_TIES = "event_time_ts DESC, ingestion_run_id DESC"
_LINE_TOTAL = "coin_id, dt, event_time_ts, ingestion_run_id"


def _dedup(where: str = "TRUE") -> str:
    return _first("*", "events_view", _DEDUP_KEYS, _UPDATED, where)


def _latest(where: str = "TRUE") -> str:
    return _first(_SILVER, "events_view", "dt, coin_id", _BY_TIME, where)


def _daily(where: str = "TRUE") -> str:
    return f"WITH {_EVENTS}, deduped AS ({_dedup(where)}) {_DAILY.format('deduped')}"


def _daily_lines() -> str:
    deduped = _first("*", "lines_view", _DEDUP_KEYS, "ingestion_run_id DESC")
    return f"WITH {_LINES}, deduped AS ({deduped}) {_DAILY.format('deduped')}"


def _events(select: str) -> str:
    return f"WITH {_EVENTS} {select}"


def _raw(faulty: bool, partial: bool = False, unreadable: str = "rows") -> str:
    """Raw events; an unreadable one is a row of nulls, or none at all."""
    event_time = _ISO.format("event_time_ts")
    coin = "coin_id"
    price = "price_usd"
    if faulty:
        event_time = f"CASE WHEN event_id % 83 = 0 THEN 'no time' ELSE {event_time} END"
        coin = "CASE WHEN event_id % 89 <> 0 THEN coin_id END"
    if partial:
        price = "CASE WHEN event_id % 71 <> 0 THEN price_usd END"
    columns = {
        "event_time": event_time,
        "coin_id": coin,
        "price_usd": price,
        "last_updated": _ISO.format("last_updated_ts"),
    }
    readable = "TRUE"
    if faulty and unreadable == "rows":
        readable = "event_id % 97 <> 0"
    listed = ",\n       ".join(
        f"CASE WHEN {readable} THEN {columns.get(c, c)} END AS {c}"
        for c in BRONZE_SCHEMA.fieldNames()
    )
    where = "event_id % 97 <> 0" if faulty and unreadable == "dropped" else "TRUE"
    return f"""raw AS (SELECT event_id, {listed} FROM events_view WHERE {where})"""


_BRONZE = ", ".join(BRONZE_SCHEMA.fieldNames())
_VALUE = "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in BRONZE_SCHEMA.fieldNames()) + "}) AS VARCHAR)"
_KEY = "coalesce(nullif(coin_id, ''), nullif(symbol, ''), 'unknown')"

_FAULTY = f"""
faulty AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 11 <> 0 THEN symbol END AS symbol,
        CASE WHEN event_id % 13 <> 0 THEN market_cap_usd END AS market_cap_usd,
        CASE WHEN event_id % 17 = 0 THEN -price_usd
             WHEN event_id % 19 <> 0 THEN price_usd END AS price_usd)
    FROM events_view
),
checked AS ({_first("*", "faulty", _DEDUP_KEYS, _UPDATED)})"""

# The records with changing fields, read by the kinds that JSON functions tell.
_DRIFTING = """drifting AS (
    SELECT dt AS day, CAST('{"id":"' || coin_id || '"'
        || CASE WHEN day(dt) < 20 THEN ',"symbol":"' || symbol || '"' ELSE '' END
        || ',"price":' || CASE WHEN day(dt) < 16 THEN CAST(CAST(market_cap_usd AS BIGINT) AS VARCHAR)
                               ELSE '"about ' || CAST(market_cap_usd AS BIGINT) || '"' END
        || ',"rank":' || CASE WHEN day(dt) <> 12 OR event_id % 7 <> 0
                              THEN CAST(market_cap_rank AS VARCHAR) ELSE '"none"' END
        || ',"volume":' || CASE WHEN day(dt) <> 5 THEN CAST(event_id % 777 AS VARCHAR) ELSE 'null' END
        || CASE WHEN day(dt) >= 10 THEN ',"note":{"seen":true}' ELSE '' END || '}' AS JSON) AS record
    FROM events_view WHERE event_id % 97 <> 0),
named AS (SELECT day, record, unnest(json_keys(record)) AS field FROM drifting),
kinds AS (
    SELECT day, field, CASE json_type(record, '$.' || field)
        WHEN 'VARCHAR' THEN 'text' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object'
        WHEN 'BOOLEAN' THEN 'flag' WHEN 'ARRAY' THEN 'list' ELSE 'number' END AS kind
    FROM named),
fields AS (
    SELECT day, field,
           CASE count(DISTINCT kind) FILTER (kind <> 'null') WHEN 0 THEN 'null'
                WHEN 1 THEN max(kind) FILTER (kind <> 'null') ELSE 'mixed' END AS kind,
           count(*) AS records, count(*) FILTER (kind = 'null') AS nulls
    FROM kinds GROUP BY day, field)"""

_BAD_PRICE = "price_usd IS NULL OR price_usd <= 0"
_NEWEST = "(epoch_us(TIMESTAMP '2024-02-15 00:00:00') - epoch_us(max(event_time_ts))) / 60e6"


def _null_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT 'null_{c}' AS check_name, count(*) FILTER ({c} IS NULL) AS bad_rows FROM checked"
        for c in REQUIRED_COLUMNS
    )


def _required() -> str:
    missing = ("symbol", "total_volume_usd")
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {str(c in missing).upper()} AS is_missing, "
        "count(*) AS checked_rows FROM events"
        for c in REQUIRED_COLUMNS
    )


def _gate() -> str:
    checks = [f"SELECT {n} AS pos, 'null_{c}' AS reason, count(*) AS bad FROM checked WHERE {c} IS NULL"
              for n, c in enumerate(REQUIRED_COLUMNS)]
    checks.append(
        "SELECT 90 AS pos, 'price_usd_null_or_non_positive' AS reason, count(*) AS bad "
        f"FROM checked WHERE {_BAD_PRICE}"
    )
    checks.append(
        f"SELECT 91 AS pos, printf('freshness_lag_minutes=%.1f', {_NEWEST}) AS reason, "
        f"CASE WHEN {_NEWEST} > 20000 THEN 1 ELSE 0 END AS bad FROM checked"
    )
    return f"""
SELECT CAST(row_number() OVER (ORDER BY pos) AS INTEGER) AS position, reason
FROM ({' UNION ALL '.join(checks)}) WHERE bad > 0"""


def _page_event(event_time: str, run_id: str) -> str:
    return f"""raw AS (
    SELECT {event_time} AS event_time, {run_id} AS ingestion_run_id, source, vs_currency,
           coin_id, symbol, name, price_usd, market_cap_usd, total_volume_usd,
           price_change_percentage_24h, market_cap_rank,
           {_ISO.format("last_updated_ts")} AS last_updated
    FROM events_view)"""


_CLEAN = f"SELECT {_SILVER} FROM events_view WHERE {_READABLE}"
_STATUS = """CASE WHEN event_id % 97 = 0 THEN 'unreadable'
     WHEN event_id % 89 = 0 THEN 'no_coin_id'
     WHEN event_id % 83 = 0 THEN 'no_event_time'
     WHEN event_id % 71 = 0 THEN 'partial' ELSE 'clean' END"""

ORACLES: dict[str, str] = {
    "src_api_page_explode": _events(
        f"""SELECT coin_id AS id, symbol, name, price_usd AS current_price,
       market_cap_usd AS market_cap, total_volume_usd AS total_volume,
       price_change_percentage_24h, market_cap_rank,
       {_ISO.format("last_updated_ts")} AS last_updated
FROM events_view"""
    ),
    "src_json_lines": f"""WITH {_EVENTS}, {_raw(True, partial=True)}
SELECT {_BRONZE}, event_id % 97 = 0 OR event_id % 71 = 0 AS is_corrupt,
       TRUE AS has_source_file, TIMESTAMP '2024-02-15 00:00:00' AS ingestion_time
FROM raw""",
    "src_parquet_partitioned": _events(f"SELECT {_SILVER} FROM events_view"),
    "src_parquet_long_amounts": _events(f"SELECT {_SILVER} FROM events_view"),
    "src_topic_decode": f"""WITH {_EVENTS}, {_raw(True)}
SELECT {_BRONZE}, 'quotes/' || event_id % 4 || '/' || event_id AS source_file FROM raw""",
    "norm_event": f"""WITH {_EVENTS},
{_page_event(_ISO.format("event_time_ts"), "ingestion_run_id")}
SELECT {_BRONZE} FROM raw""",
    "norm_record_key": f"""WITH {_EVENTS}, gaps AS (
    SELECT event_id,
           CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 <> 0 THEN coin_id END AS coin_id,
           CASE WHEN event_id % 2 = 0 THEN '' WHEN event_id % 3 <> 0 THEN symbol END AS symbol
    FROM events_view)
SELECT event_id, {_KEY} AS key FROM gaps""",
    "filter_id_list": _events(
        f"SELECT {_SILVER} FROM events_view WHERE coin_id IN ('click', 'purchase')"
    ),
    "filter_id_table": f"""WITH {_LINES}
SELECT {_SILVER} FROM lines_view
WHERE coin_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 10)""",
    "topn_page": _events(
        f"""SELECT {_SILVER} FROM events_view
QUALIFY row_number() OVER (PARTITION BY dt
    ORDER BY market_cap_usd DESC, last_updated_ts DESC) BETWEEN 6 AND 10"""
    ),
    "topn_page_global": _events(
        f"""SELECT {_SILVER} FROM events_view
QUALIFY row_number() OVER (
    ORDER BY market_cap_usd DESC, last_updated_ts DESC) BETWEEN 101 AND 150"""
    ),
    "topn_page_deep": _events(
        f"""SELECT {_SILVER} FROM events_view
QUALIFY row_number() OVER (PARTITION BY coin_id
    ORDER BY price_usd DESC, last_updated_ts DESC) BETWEEN 1151 AND 1200"""
    ),
    "topn_page_global_deep": f"""WITH {_LINES}
SELECT {_SILVER} FROM lines_view
QUALIFY row_number() OVER (ORDER BY price_usd DESC, {_LINE_TOTAL}) BETWEEN 24951 AND 25000""",
    "topn_page_indexed": f"""WITH {_LINES}, ranked AS (
    SELECT {_SILVER}, row_number() OVER (ORDER BY price_usd DESC, {_LINE_TOTAL}) AS place FROM lines_view)
SELECT {_SILVER}, (place - 1) // 50 + 1 AS page FROM ranked WHERE (place - 1) // 50 + 1 IN (2, 500)""",
    "topn_page_indexed_keys": _events(
        f"""SELECT {_SILVER} FROM events_view
QUALIFY row_number() OVER (PARTITION BY coin_id
    ORDER BY price_usd DESC, last_updated_ts DESC) BETWEEN 1151 AND 1200"""
    ),
    "topn_page_ties": f"""WITH {_LINES}
SELECT {_SILVER}, CAST((row_number() OVER (ORDER BY market_cap_usd DESC, {_LINE_TOTAL}) - 1)
    // CAST(ceil(count(*) OVER () / 4.0) AS BIGINT) + 1 AS BIGINT) AS page
FROM lines_view""",
    "silver_clean": _events(_CLEAN),
    "quarantine_bad_records": _events(
        f"""SELECT {_STATUS} AS reason,
       CASE WHEN event_id % 97 = 0 THEN 'not json ' || event_id
            ELSE {_ISO.format("last_updated_ts")} END AS detail
FROM events_view WHERE NOT ({_READABLE})"""
    ),
    "tag_bad_records": _events(
        f"SELECT {_STATUS} AS status, count(*) AS records FROM events_view GROUP BY 1"
    ),
    "contract_enforce": _events(
        """SELECT dt, event_time_ts, last_updated_ts, ingestion_run_id, source, vs_currency,
       coin_id, symbol, name,
       CASE WHEN event_id % 89 <> 0 THEN market_cap_rank END AS market_cap_rank,
       CASE WHEN event_id % 83 <> 0 THEN price_usd END AS price_usd,
       price_change_percentage_24h, market_cap_usd, total_volume_usd,
       'events' AS source_file
FROM events_view"""
    ),
    "silver_latest": _events(_latest()),
    "silver_latest_lines": f"WITH {_LINES} "
    + _first(_SILVER, "lines_view", "dt, coin_id", _LINE_TIES),
    "dedup_quotes": _events(_first(_SILVER, "events_view", _DEDUP_KEYS, _UPDATED)),
    "dedup_quotes_lines": f"WITH {_LINES} "
    + _first(_SILVER, "lines_view", _DEDUP_KEYS, "ingestion_run_id DESC"),
    "gold_snapshot": _events(_first(_SILVER, "events_view", "coin_id", _BY_TIME)),
    "gold_snapshot_lines": f"WITH {_LINES} "
    + _first(_SILVER, "lines_view", "coin_id", _LINE_TIES),
    "daily_metrics": _daily(),
    "daily_metrics_lines": _daily_lines(),
    "daily_metrics_repeated": _events(
        _DAILY.format("events_view").replace(
            "arg_max(price_usd, event_time_ts)",
            "max({'at': event_time_ts, 'price': price_usd}).price",
        )
    ),
    "run_event_counts": _events(
        "SELECT ingestion_run_id, count(*) AS sent FROM events_view GROUP BY 1"
    ),
    "dq_required_columns": _required(),
    "dq_null_counts": f"WITH {_EVENTS}, {_FAULTY} {_null_counts()}",
    "dq_price_positive": f"""WITH {_EVENTS}, {_FAULTY}
SELECT 'price_usd_null_or_non_positive' AS check_name, count(*) AS bad_rows
FROM checked WHERE {_BAD_PRICE}""",
    "dq_freshness": f"""WITH {_EVENTS}, deduped AS ({_dedup()})
SELECT max(event_time_ts) AS newest_event_time, {_NEWEST} AS lag_minutes,
       {_NEWEST} > 20000 AS is_stale
FROM deduped""",
    "dq_gate_report": f"WITH {_EVENTS}, {_FAULTY} {_gate()}",
    "dq_state_merge": f"""WITH {_EVENTS}, {_FAULTY}
SELECT coalesce(strftime(dt, '%Y-%m-%d'), 'all') AS day, count(*) AS checked_rows,
       count(*) FILTER (symbol IS NULL) AS null_symbol,
       count(*) FILTER (market_cap_usd IS NULL) AS null_market_cap_usd,
       count(*) FILTER ({_BAD_PRICE}) AS price_usd_null_or_non_positive,
       max(event_time_ts) AS newest_event_time
FROM faulty GROUP BY GROUPING SETS ((dt), ())""",
    "record_fields": f"WITH {_EVENTS}, {_DRIFTING} SELECT * FROM fields",
    "schema_drift": f"""WITH {_EVENTS}, {_DRIFTING},
days AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM fields)),
old AS (SELECT d.day, f.field, f.kind FROM fields f JOIN days d ON f.day = d.before),
new AS (SELECT day, field, kind FROM fields JOIN days USING (day) WHERE before IS NOT NULL)
SELECT day, field,
       CASE WHEN old.kind IS NULL THEN 'new' WHEN new.kind IS NULL THEN 'lost' ELSE 'retyped' END AS change,
       old.kind AS old_kind, new.kind AS new_kind
FROM old FULL JOIN new USING (day, field)
WHERE old.kind IS NULL OR new.kind IS NULL
   OR (old.kind <> new.kind AND old.kind <> 'null' AND new.kind <> 'null')""",
    "sink_keyed_json": f"""WITH {_EVENTS}, {_raw(True, unreadable="kept")}
SELECT {_KEY} AS key, {_VALUE} AS value FROM raw""",
    "sink_history_append": _events(f"SELECT {_SILVER} FROM events_view"),
    "sink_dynamic_overwrite": _events(
        f"""SELECT * REPLACE (
    CASE WHEN dt < DATE '2024-01-16' THEN -price_usd ELSE price_usd END AS price_usd)
FROM ({_latest()})"""
    ),
    "sink_gold_quotes": _events(_first(_QUOTES, "events_view", _DEDUP_KEYS, _UPDATED)),
    "sink_gold_quotes_lines": f"WITH {_LINES} "
    + _first(_QUOTES, "lines_view", _DEDUP_KEYS, "ingestion_run_id DESC"),
    "sink_gold_daily": _daily(),
    "sink_snapshot_overwrite": _events(_first(_SNAPSHOT, "events_view", "coin_id", _BY_TIME)),
    "stream_poll_events": _events(
        f"""SELECT coin_id AS key, {_ISO.format("date_trunc('day', event_time_ts)")} AS event_time,
       strftime(event_time_ts, 'run of %Y-%m-%d 00:00+0') AS ingestion_run_id,
       'market_api' AS source, vs_currency, coin_id, symbol, name,
       price_usd, market_cap_usd, total_volume_usd, price_change_percentage_24h,
       market_cap_rank, {_ISO.format("last_updated_ts")} AS last_updated
FROM events_view"""
    ),
    "stream_bronze_files": f"""WITH {_EVENTS}, {_raw(True, unreadable="dropped")}
SELECT {_BRONZE} FROM raw""",
    "stream_silver_history": _events(_CLEAN),
    "stream_silver_latest": _events(_latest(_READABLE)),
    "stream_gold_daily": _daily(_READABLE),
    "stream_gold_delta": _daily(_READABLE),
    "stream_snapshot_state": _events(_first(_SNAPSHOT, "events_view", "coin_id", _BY_TIME, _READABLE)),
    "src_parquet_lookup": f"""WITH {_LINES}
SELECT {_SILVER} FROM lines_view WHERE coin_id IN ('7', '21', '133', 'no such part')""",
    "dedup_quotes_bucketed": f"WITH {_LINES} "
    + _first(_SILVER, "lines_view", _DEDUP_KEYS, "ingestion_run_id DESC"),
    "compact_history": _events(f"SELECT {_SILVER}, CAST(1 AS BIGINT) AS files_per_day FROM events_view"),
    "run_log": f"""WITH {_EVENTS}, logged AS (
    SELECT unnest([
        {{'stream': 'landing', 'count_name': 'landed', 'records': count(*) FILTER (event_id % 97 <> 0)}},
        {{'stream': 'rejects', 'count_name': 'rejected', 'records': count(*) FILTER (event_id % 97 = 0)}},
        {{'stream': 'history', 'count_name': 'kept', 'records': count(*) FILTER ({_READABLE})}},
        {{'stream': 'quarantine', 'count_name': 'quarantined',
          'records': count(*) FILTER (event_id % 97 <> 0 AND NOT ({_READABLE}))}},
        {{'stream': 'landing', 'count_name': 'failures', 'records': 0}},
        {{'stream': 'rejects', 'count_name': 'failures', 'records': 0}},
        {{'stream': 'history', 'count_name': 'failures', 'records': 0}},
        {{'stream': 'quarantine', 'count_name': 'failures', 'records': 0}}]) AS line
    FROM events_view)
SELECT line.stream AS stream, line.count_name AS count_name, line.records AS records FROM logged""",
    "flow_events": f"""WITH {_EVENTS}, {_page_event("'2024-02-15T00:00:00.000000+00:00'", "'run'")}
SELECT {_KEY} AS key, {_VALUE} AS value FROM raw""",
    "flow_silver": _events(_latest(_READABLE)),
    "flow_gold": _daily(),
    "flow_gold_snapshot": _events(_first(_SNAPSHOT, "events_view", "coin_id", _BY_TIME)),
    "flow_gold_lines": _daily_lines(),
    "flow_incremental": _daily(_READABLE),
    "flow_quarantine": """SELECT 'all' AS place, count(*) AS records FROM events
UNION ALL SELECT CASE WHEN event_id % 97 = 0 THEN 'rejected'
    WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'quarantined'
    ELSE 'history' END, count(*) FROM events GROUP BY 1""",
    "flow_end_to_end": _daily(_READABLE),
}
