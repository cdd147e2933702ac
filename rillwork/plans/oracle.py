"""DuckDB SQL that gives the result of each registered query from the same tables."""

from __future__ import annotations

_ISO = "%Y-%m-%dT%H:%M:%S.%f"


def _username(key: str) -> str:
    return f"'Customer#' || lpad(CAST({key} AS VARCHAR), 9, '0')"


_CTE = {
    "ev": """
      SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
             CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS product_id,
             ts AS event_time
      FROM events""",
    "msg": f"""
      SELECT CAST(user_id AS VARCHAR) AS "key",
             '{{"event_id":"' || event_id || '","user_id":"' || user_id || '","event_type":"'
             || event_type || '"'
             || CASE WHEN event_type <> 'error'
                     THEN ',"product_id":"' || json_extract_string(props, '$.k') || '"'
                     ELSE '' END
             || ',"timestamp":"' || strftime(ts, '{_ISO}') || '"}}' AS value,
             'user-events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
             event_id AS "offset", ts AS "timestamp", event_type
      FROM events""",
    "pu": """
      SELECT json_extract_string(props, '$.k') AS product_id, p_name AS product_name,
             value AS price, p_type AS category, ts AS "timestamp"
      FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)
      WHERE event_type = 'purchase'""",
    "up": f"""
      SELECT CAST(user_id AS VARCHAR) AS user_id, {_username('user_id')} AS username,
             CASE WHEN value >= 100 THEN 'premium' WHEN value >= 20 THEN 'regular' ELSE 'new' END
               AS user_segment,
             strftime(ts, '%Y-%m-%d') AS registration_date, ts AS "timestamp"
      FROM events WHERE event_type = 'signup'""",
    "st": f"""
      SELECT CAST(o_custkey AS VARCHAR) AS user_id, {_username('o_custkey')} AS username,
             o_orderpriority AS user_segment,
             strftime(o_orderdate, '%Y-%m-%d') AS registration_date, o_orderdate AS "timestamp"
      FROM orders""",
}

_VERSION = "user_id, username, user_segment, registration_date, \"timestamp\""


def _with(*names: str, **more: str) -> str:
    parts = [f"{n} AS ({_CTE[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def _latest(source: str, where: str = "TRUE") -> str:
    return f"""
      SELECT {_VERSION} FROM {source} WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, username DESC,
                                 user_segment DESC, registration_date DESC) = 1"""


def _one_per_time(source: str) -> str:
    return f"""
      SELECT {_VERSION} FROM {source}
      QUALIFY row_number() OVER (PARTITION BY user_id, "timestamp" ORDER BY username DESC,
                                 user_segment DESC, registration_date DESC) = 1"""


_BOTH = f"SELECT {_VERSION} FROM st UNION ALL SELECT {_VERSION} FROM up"


def _bucket(width: str, col: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {col}, TIMESTAMP '1970-01-01')"


def _counts(width: str) -> str:
    b = _bucket(width, "event_time")
    return (_with("ev") + f"SELECT event_type, count(*) AS event_count, {b} AS window_start, "
            f"{b} + INTERVAL '{width}' AS window_end FROM ev GROUP BY event_type, {b}")


def _join(width: str) -> str:
    return f"""
      SELECT e.event_id, e.user_id, e.event_type, e.event_time AS event_timestamp,
             p.product_id, p.product_name, p.price, p.category
      FROM ev e LEFT JOIN pu p ON e.product_id = p.product_id
       AND {_bucket(width, 'e.event_time')} = {_bucket(width, 'p."timestamp"')}"""


def _enriched(width: str) -> str:
    return (_with("ev", "pu", "st", j=_join(width), u=_latest("st")) + """
      SELECT j.*, u.username, u.user_segment, u.registration_date
      FROM j LEFT JOIN u ON j.user_id = u.user_id""")


def _three_way(profiles: str, *bases: str, **more: str) -> str:
    return (_with("ev", "pu", *bases, **more, u=profiles) + f"""
      SELECT e.*, p.product_name, p.category, u.username, u.user_segment
      FROM ev e
      LEFT JOIN pu p ON e.product_id = p.product_id
       AND {_bucket('1 hour', 'e.event_time')} = {_bucket('1 hour', 'p."timestamp"')}
      LEFT JOIN u ON e.user_id = u.user_id""")


_COLWISE = """
      SELECT user_id, max(username) AS username, max(user_segment) AS user_segment,
             max(registration_date) AS registration_date, max("timestamp") AS "timestamp"
      FROM versions GROUP BY user_id"""

_HYBRID = _with("ev", "up", "st", base=_latest("st"), live=_one_per_time("up")) + """
      SELECT e.*, coalesce(l.username, b.username) AS username,
             coalesce(l.user_segment, b.user_segment) AS user_segment,
             coalesce(l.registration_date, b.registration_date) AS registration_date
      FROM ev e
      ASOF LEFT JOIN live l ON e.user_id = l.user_id AND e.event_time >= l."timestamp"
      LEFT JOIN base b ON e.user_id = b.user_id"""


def _refreshing(every: str) -> str:
    return (_with("ev", "up", live=_one_per_time("up"),
                  placed=f"SELECT *, {_bucket(every, 'event_time')} AS renewed FROM ev") + """
      SELECT p.event_id, p.user_id, p.event_type, p.product_id, p.event_time,
             l.username, l.user_segment, l.registration_date
      FROM placed p ASOF LEFT JOIN live l
        ON p.user_id = l.user_id AND p.renewed >= l."timestamp\"""")


# Column maxima over the stored profiles and the updates up to each event.
_LIVE = _with("ev", "pu", "st", "up", seen="""
      SELECT e.event_id, max(v.username) AS username, max(v.user_segment) AS user_segment
      FROM ev e JOIN (SELECT user_id, username, user_segment, TIMESTAMP '0001-01-01' AS since FROM st
                      UNION ALL SELECT user_id, username, user_segment, "timestamp" FROM up) v
        ON e.user_id = v.user_id AND v.since <= e.event_time
      GROUP BY e.event_id""") + f"""
      SELECT e.*, p.product_name, p.category, s.username, s.user_segment
      FROM ev e
      LEFT JOIN pu p ON e.product_id = p.product_id
       AND {_bucket('1 hour', 'e.event_time')} = {_bucket('1 hour', 'p."timestamp"')}
      LEFT JOIN seen s ON e.event_id = s.event_id"""

# A cache walked event by event: (fetched, a_*) is the entry after event n of a user.
_GOOD = "coalesce(a.event_time < w.fetched + INTERVAL '5 days', FALSE)"
_CACHE = _with("ev", "up", live=_one_per_time("up"), asked="""
      SELECT e.*, l.username AS u, l.user_segment AS s, l.registration_date AS d,
             l.user_id IS NOT NULL AS found,
             row_number() OVER (PARTITION BY e.user_id ORDER BY e.event_time, e.event_id) AS n
      FROM ev e ASOF LEFT JOIN live l ON e.user_id = l.user_id AND e.event_time >= l."timestamp\"""",
               walk=f"""
      SELECT *, CASE WHEN found THEN event_time END AS fetched, u AS a_u, s AS a_s, d AS a_d,
             CASE WHEN found THEN 'fetch' ELSE 'miss' END AS cache
      FROM asked WHERE n = 1
      UNION ALL
      SELECT a.*, CASE WHEN {_GOOD} THEN w.fetched WHEN a.found THEN a.event_time END,
             CASE WHEN {_GOOD} THEN w.a_u ELSE a.u END, CASE WHEN {_GOOD} THEN w.a_s ELSE a.s END,
             CASE WHEN {_GOOD} THEN w.a_d ELSE a.d END,
             CASE WHEN {_GOOD} THEN 'hit' WHEN a.found THEN 'fetch' ELSE 'miss' END
      FROM asked a JOIN walk w ON a.user_id = w.user_id AND a.n = w.n + 1""").replace(
          "WITH ", "WITH RECURSIVE ", 1)

_DAMAGED = _with("msg", damaged="""
      SELECT "offset", event_type,
             CASE event_type WHEN 'signup' THEN substr(value, 1, length(value) - 1)
                             WHEN 'view' THEN '[' || value || ']'
                             WHEN 'click' THEN replace(value, '"user_id"', '"user"')
                             WHEN 'error' THEN NULL ELSE value END AS value
      FROM msg""", rejects="""
      SELECT "offset", value,
             CASE WHEN value IS NULL THEN 'null value'
                  WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT'
                    THEN 'not a JSON object'
                  ELSE 'missing or invalid: user_id' END AS error
      FROM damaged
      WHERE value IS NULL OR NOT json_valid(value) OR json_type(value) <> 'OBJECT'
         OR json_extract_string(value, '$.user_id') IS NULL""")

_PLACED = f"""
      SELECT "key", value, topic, "partition", "offset", "timestamp" FROM msg"""

ORACLE: dict[str, str] = {
    "event_messages": _with("msg") + _PLACED,
    "keyed_messages": """
      SELECT CAST(user_id AS VARCHAR) AS "key",
             '{"user_id":"' || user_id || '","event_type":"' || event_type || '","event_id":'
             || event_id || '}' AS value
      FROM events""",
    "topic_offsets": """
      SELECT topic, CAST("partition" AS INTEGER) AS "partition", min(event_id) AS first_offset,
             max(event_id) AS last_offset, count(*) AS messages
      FROM (SELECT 'user-events' AS topic, user_id % 4 AS "partition", event_id FROM events
            UNION ALL
            SELECT 'user-profiles', user_id % 4, event_id FROM events WHERE event_type = 'signup')
      GROUP BY ALL""",
    "peek_messages": _with("msg") + _PLACED + """
      ORDER BY "timestamp", topic, "partition", "offset" LIMIT 20""",
    "envelope_times": """
      SELECT event_id AS "offset", date_trunc('millisecond', ts) AS "timestamp" FROM events""",
    "flatten_events": _with("ev") + """
      SELECT event_id, user_id, event_type, coalesce(product_id, '') AS product_id,
             event_time AS "timestamp" FROM ev""",
    "event_rows": _with("ev") + "SELECT * FROM ev",
    "generic_events": _with("msg") + 'SELECT "timestamp" AS event_time, value AS payload FROM msg',
    "payload_records": _with("msg") + 'SELECT "timestamp" AS event_time, value AS payload FROM msg',
    "product_rows": _with("pu") + "SELECT * FROM pu",
    "product_records": _with("pu") + "SELECT * FROM pu",
    "profile_rows": _with("up") + "SELECT * FROM up",
    "profile_records": _with("up") + "SELECT * FROM up",
    "table_profile_rows": _with("st") + "SELECT * FROM st",
    "quarantine_rows": _DAMAGED + 'SELECT "offset", value, error FROM rejects',
    "quarantine_counts": _DAMAGED + "SELECT error, count(*) AS messages FROM rejects GROUP BY error",
    "undamaged_events": _with("ev") + "SELECT * FROM ev WHERE event_type = 'purchase'",
    "events_per_minute": _counts("1 minute"),
    "events_per_hour": _counts("1 hour"),
    "aggregation_records": _counts("1 minute"),
    "day_partitions": """
      SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events FROM events GROUP BY 1""",
    "profiles_union": _with("st", "up") + _BOTH,
    "profiles_latest": _with("st") + _latest("st"),
    "profiles_latest_with_updates": _with("st", "up", versions=_BOTH) + _latest("versions"),
    "profiles_colwise_max": _with("st", "up", versions=_BOTH) + _COLWISE,
    "products_latest": _with("pu") + """
      SELECT product_id, product_name, price, category, "timestamp" FROM pu
      QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY "timestamp" DESC,
                                 product_name DESC, price DESC, category DESC) = 1""",
    "join_events_products_1m": _with("ev", "pu") + _join("1 minute"),
    "join_events_products_1h": _with("ev", "pu") + _join("1 hour"),
    "join_events_products_1d": _with("ev", "pu") + _join("1 day"),
    "join_events_products_split": _with("ev", "pu") + _join("1 day"),
    "enriched_events": _enriched("1 hour"),
    "enriched_events_1m": _enriched("1 minute"),
    "enriched_three_way": _three_way(_COLWISE, "st", "up", versions=_BOTH),
    "enriched_three_way_latest": _three_way(_latest("versions"), "st", "up", versions=_BOTH),
    "static_lookup": _with("ev", "up", u=_latest("up")) + """
      SELECT ev.*, u.username, u.user_segment, u.registration_date
      FROM ev LEFT JOIN u ON ev.user_id = u.user_id""",
    "hybrid_asof": _HYBRID,
    "hybrid_asof_split": _HYBRID,
    "refreshing_lookup": _refreshing("30 minutes"),
    "refreshing_lookup_1d": _refreshing("1 day"),
    "lookup_external": _with("ev", "st", u=_latest("st")) + """
      SELECT ev.*, coalesce(u.username, 'unknown') AS username,
             coalesce(u.user_segment, 'unknown') AS user_segment, u.registration_date
      FROM ev LEFT JOIN u ON ev.user_id = u.user_id""",
    "point_lookup": _with("st") + f"""
      SELECT {_VERSION} FROM ({_latest('st')})
      WHERE user_id = (SELECT CAST(user_id AS VARCHAR) FROM events GROUP BY events.user_id
                       ORDER BY count(*) DESC, events.user_id LIMIT 1)""",
    "fallback_chain": _with("ev", "up", "st", live=_latest("up"), base=_latest("st"), shifted="""
      SELECT * REPLACE (CAST(CAST(user_id AS BIGINT) * 20 AS VARCHAR) AS user_id) FROM ev""") + """
      SELECT e.*, CASE WHEN l.user_id IS NOT NULL THEN 'updates'
                       WHEN b.user_id IS NOT NULL THEN 'snapshot' ELSE 'default' END
               AS profile_source,
             coalesce(l.username, b.username, 'unknown') AS username,
             CASE WHEN l.user_id IS NOT NULL THEN l.user_segment ELSE b.user_segment END
               AS user_segment,
             CASE WHEN l.user_id IS NOT NULL THEN l.registration_date ELSE b.registration_date END
               AS registration_date
      FROM shifted e LEFT JOIN live l ON e.user_id = l.user_id
      LEFT JOIN base b ON e.user_id = b.user_id""",
    "lookup_hit_rate": f"""
      SELECT count(*) AS lookups, count(username) AS hits, count(*) - count(username) AS misses
      FROM ({_refreshing('1 day')})""",
    "latest_windows_top10": _counts("1 minute") + " ORDER BY window_start DESC, event_type LIMIT 10",
    "latest_enriched_top10": _enriched("1 hour") + """
      ORDER BY event_timestamp DESC, event_id, product_id NULLS FIRST, price NULLS FIRST LIMIT 10""",
    "sql_file_aggregation": _counts("1 minute"),
    "sql_file_join": _with("ev", "pu") + _join("1 hour"),
    "sql_file_three_way": _three_way(_latest("st"), "st"),
}

_STORED = _with("ev", "st", u=_latest("st")) + """
      SELECT ev.*, u.username, u.user_segment, u.registration_date
      FROM ev LEFT JOIN u ON ev.user_id = u.user_id"""

# The streams give the results of their batch counterparts.
ORACLE |= {
    "stream_events_per_minute": ORACLE["events_per_minute"],
    "stream_enriched_events": ORACLE["enriched_events"],
    "stream_hybrid": ORACLE["hybrid_asof"],
    "stream_external_lookup": ORACLE["lookup_external"],
    "stream_refreshing_lookup": _STORED,
    "stream_cached_lookup": _STORED,
    "stream_three_way": ORACLE["enriched_three_way_latest"],
    "stream_sql_live": _LIVE,
    "stream_cached_profiles": _CACHE + """
      SELECT event_id, user_id, event_type, product_id, event_time, a_u AS username, a_s AS user_segment,
             a_d AS registration_date, cache FROM walk""",
    "stream_cache_counts": _CACHE + """
      SELECT strftime(t, '%Y-%m-%d') AS day, cache, count(*) AS n
      FROM (SELECT event_time AS t, cache FROM walk
            UNION ALL
            SELECT fetched + INTERVAL '5 days', 'expired' FROM walk
            WHERE cache = 'fetch' AND fetched + INTERVAL '5 days' <= (SELECT max(ts) FROM events))
      GROUP BY ALL""",
    "stream_flat_events": ORACLE["flatten_events"],
    "stream_generic_by_day": _with("msg") + """
      SELECT "timestamp" AS event_time, value AS payload FROM msg
      WHERE CAST("timestamp" AS DATE) > (SELECT CAST(min(ts) AS DATE) FROM events)""",
    "stream_profiles": ORACLE["profile_records"],
    "stream_profiles_latest": ORACLE["profiles_latest_with_updates"],
    "bucketed_point_lookup": ORACLE["point_lookup"],
    "stored_profiles_scan": ORACLE["table_profile_rows"],
    "stream_fan_out": _DAMAGED + """
      SELECT 'flat' AS kind, event_type, count(*) AS messages FROM events
      WHERE event_type = 'purchase' GROUP BY event_type
      UNION ALL
      SELECT 'generic', event_type, count(*) FROM events
      WHERE event_type IN ('purchase', 'click') GROUP BY event_type
      UNION ALL
      SELECT 'reject', error, count(*) FROM rejects GROUP BY error""",
}
ORACLE["stream_fan_out_committed"] = ORACLE["stream_fan_out"]
ORACLE["latest_windows_by_day"] = ORACLE["latest_windows_top10"]
ORACLE["stream_sql_file_aggregation"] = ORACLE["sql_file_aggregation"]
ORACLE["stream_sql_file_join"] = ORACLE["sql_file_join"]
ORACLE["payload_variant"] = _with("ev") + "SELECT event_time, event_id, user_id, product_id FROM ev"
ORACLE["payload_python"] = _with("ev") + """
      SELECT event_time, product_id,
             CASE WHEN product_id IS NULL THEN 'function failed: KeyError: ''product_id''' END AS error
      FROM ev"""
ORACLE["strict_rejects"] = """
      SELECT event_id AS "offset", 'not a string: user_id' AS error FROM events WHERE event_type = 'click'"""
ORACLE["stream_lookup_metrics"] = _CACHE + """
      SELECT count(*) AS lookups, count(*) FILTER (WHERE cache = 'hit') AS hits,
             count(*) FILTER (WHERE cache = 'fetch') AS fetches,
             count(*) FILTER (WHERE cache = 'miss') AS misses,
             count(*) FILTER (WHERE cache = 'fetch') AS expired, CAST(0 AS BIGINT) AS late
      FROM walk"""
ORACLE["stream_refreshed_profiles"] = _with("ev", "up", live=_one_per_time("up"), placed="""
      SELECT e.*, make_timestamp((f + (epoch_us(e.event_time) - f) // 432000000000 * 432000000000)) AS tick
      FROM ev e, (SELECT epoch_ms(min(ts)) * 1000 AS f FROM events)""", seen="""
      SELECT p.*, l.username, l.user_segment, l.registration_date,
             l."timestamp" > p.tick - INTERVAL '15 days' AS there
      FROM placed p ASOF LEFT JOIN live l ON p.user_id = l.user_id AND p.tick >= l."timestamp\"""") + """
      SELECT event_id, user_id, event_type, product_id, event_time,
             CASE WHEN there THEN username END AS username,
             CASE WHEN there THEN user_segment END AS user_segment,
             CASE WHEN there THEN registration_date END AS registration_date
      FROM seen"""
ORACLE["stream_late_rows"] = _with("ev", sliced="""
      SELECT *, (epoch_us(event_time + CASE WHEN event_type = 'error' THEN INTERVAL '15 days'
                                           ELSE INTERVAL '0 days' END)
              - (SELECT epoch_us(min(event_time)) FROM ev)) // 864000000000 AS slice
      FROM ev""", highs="SELECT slice, max(event_time) AS high FROM sliced GROUP BY slice") + """
      SELECT event_id, event_time,
             CASE WHEN event_time <= (SELECT max(high) FROM highs h WHERE h.slice < s.slice) - INTERVAL '5 days'
                  THEN 'late' ELSE 'on_time' END AS side
      FROM sliced s"""
