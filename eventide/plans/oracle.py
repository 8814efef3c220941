"""DuckDB SQL equal to each contract query (driver tables are pre-registered views).

Written independently of the Spark plans: plain window functions, joins and
``generate_series`` expansions over whole tables.
"""

from __future__ import annotations

HOUR = 3_600_000_000
DAY = 86_400_000_000

# Fixed values shared with the contract queries.
CHANNELS = ["AppStore", "XiaomiStore", "HuaweiStore", "weibo", "wechat", "tieba"]
ALL_CHANNELS_LABEL = "全部渠道"

EV = ("(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) AS us FROM events)")


def _text(us_expr: str) -> str:
    return f"strftime(make_timestamp({us_expr}), '%Y-%m-%d %H:%M:%S')"


def _sliding(src: str, keys: str, us: str, size_us: int, slide_us: int) -> str:
    """Rows of ``src`` expanded to every sliding window (first slot ``w``) that holds them."""
    n = size_us // slide_us
    return (f"SELECT {keys}, unnest(generate_series({us} // {slide_us} - {n - 1}, {us} // {slide_us})) AS w "
            f"FROM {src}")


def _poly(s: str, seed: int = 61, bits: int = 29) -> str:
    mask = (1 << bits) - 1
    return (f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)),"
            f" lambda acc, x: (acc * {seed} + x) & {mask})")


def _java_hash(s: str) -> str:
    u = (f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)),"
         f" lambda acc, x: (acc * 31 + x) % 4294967296)")
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def _jvm_split(s: str, sep: str) -> str:
    return (f"(CASE WHEN {s} <> '' AND rtrim({s}, '{sep}') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({s}, '{sep}'), '{sep}') END)")


def hot_items_sql(size_us: int = 60_000_000, slide_us: int = 10_000_000, n: int = 3) -> str:
    return f"""
WITH v AS (SELECT k AS item_id, us FROM {EV} e WHERE event_type = 'view'),
x AS ({_sliding('v', 'item_id', 'us', size_us, slide_us)}),
c AS (SELECT item_id, (w * {slide_us} + {size_us}) // 1000 AS window_end, count(*) AS view_count
      FROM x GROUP BY item_id, w),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS INTEGER) AS rank
      FROM c)
SELECT window_end, item_id, view_count, rank FROM r WHERE rank <= {n}
"""


def report_sql() -> str:
    size, slide = HOUR, 300_000_000
    return f"""
WITH v AS (SELECT k AS item_id, us FROM {EV} e WHERE event_type = 'view'),
x AS ({_sliding('v', 'item_id', 'us', size, slide)}),
c AS (SELECT item_id, w * {slide} + {size} AS end_us, count(*) AS view_count FROM x GROUP BY item_id, w),
r AS (SELECT *, row_number() OVER (PARTITION BY end_us ORDER BY view_count DESC, item_id) AS rank FROM c)
SELECT end_us // 1000 AS window_end,
       'time: ' || {_text('end_us')} || chr(10) ||
       string_agg(printf('NO%d: %s=%s %s=%d', rank, 'item_id', CAST(item_id AS VARCHAR), 'views', view_count),
                  chr(10) ORDER BY rank) AS report
FROM r WHERE rank <= 3 GROUP BY end_us
"""


def hot_urls_sql(slide: int = 60_000_000) -> str:
    size = 600_000_000
    return f"""
WITH l AS (
  SELECT concat_ws(' ', '10.0.0.' || CAST(user_id % 250 AS VARCHAR), '-', CAST(user_id AS VARCHAR),
                   strftime(ts, '%d/%m/%Y:%H:%M:%S'), '+0000',
                   CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END,
                   '/' || event_type || '/' || CAST(k AS VARCHAR) ||
                   CASE WHEN k % 10 = 3 THEN '.css' WHEN k % 10 = 7 THEN '.js' ELSE '' END) AS line
  FROM {EV} e),
p AS (SELECT string_split(line, ' ') AS a FROM l),
q AS (SELECT a[7] AS url, epoch_us(strptime(a[4], '%d/%m/%Y:%H:%M:%S')) AS us FROM p),
f AS (SELECT * FROM q WHERE NOT regexp_matches(url, '\\.(css|js)$')),
x AS ({_sliding('f', 'url', 'us', size, slide)}),
c AS (SELECT url, (w * {slide} + {size}) // 1000 AS window_end, count(*) AS hits FROM x GROUP BY url, w),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY hits DESC, url) AS INTEGER) AS rank FROM c)
SELECT window_end, url, hits, rank FROM r WHERE rank <= 5
"""


def uv_exact_sql() -> str:
    return f"""
SELECT (us // {HOUR} * {HOUR} + {HOUR}) // 1000 AS window_end, count(DISTINCT user_id) AS uv
FROM {EV} e WHERE event_type = 'view' GROUP BY 1
"""


def uv_hashed_sql() -> str:
    return f"""
SELECT (us // {HOUR} * {HOUR} + {HOUR}) // 1000 AS window_end,
       count(DISTINCT {_poly('CAST(user_id AS VARCHAR)')}) AS uv
FROM {EV} e WHERE event_type = 'view' GROUP BY 1
"""


def uv_running_sql() -> str:
    return f"""
WITH v AS (SELECT event_id, us, us // {HOUR} AS slot, {_poly('CAST(user_id AS VARCHAR)')} AS off
           FROM {EV} e WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY slot, off ORDER BY us, event_id) = 1 THEN 1 ELSE 0 END AS fst
      FROM v)
SELECT (slot * {HOUR} + {HOUR}) // 1000 AS window_end, event_id,
       CAST(sum(fst) OVER (PARTITION BY slot ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS uv
FROM f
"""


def _marketing_src() -> str:
    arr = "[" + ", ".join(f"'{c}'" for c in CHANNELS) + "]"
    return (f"(SELECT us, {arr}[(k % {len(CHANNELS)}) + 1] AS channel, event_type AS behavior "
            f"FROM {EV} e WHERE event_type <> 'error')")


def _sliding_text(src: str, keys: str, select_keys: str, size: int, slide: int) -> str:
    return f"""
WITH x AS ({_sliding(src + ' s', keys, 'us', size, slide)}),
c AS (SELECT {keys}, w, count(*) AS cnt FROM x GROUP BY {keys}, w)
SELECT {_text(f'w * {slide}')} AS window_start, {_text(f'w * {slide} + {size}')} AS window_end, {select_keys}, cnt
FROM c
"""


def marketing_channel_sql() -> str:
    return _sliding_text(_marketing_src(), "channel, behavior", "channel, behavior", HOUR, 300_000_000)


def marketing_total_sql() -> str:
    return _sliding_text(_marketing_src(), "behavior", f"'{ALL_CHANNELS_LABEL}' AS channel, behavior",
                         HOUR, 300_000_000)


def ad_geo_sql() -> str:
    return _sliding_text(f"(SELECT us, event_type AS province FROM {EV} e)", "province", "province",
                         HOUR, 300_000_000)


def _sliding_daily(src: str, keys: str, select_keys: str, size: int, slide: int) -> str:
    """Every window of a fine slide, summed up per key and day of the window's start."""
    return f"""
WITH x AS ({_sliding(src + ' s', keys, 'us', size, slide)}),
c AS (SELECT {keys}, w, count(*) AS cnt FROM x GROUP BY {keys}, w)
SELECT {_text(f'w * {slide}')}[1:10] AS day, {select_keys}, count(*) AS n_windows,
       CAST(sum(cnt) AS BIGINT) AS sum_cnt, max(cnt) AS max_cnt, min({_text(f'w * {slide}')}) AS first_start,
       max({_text(f'w * {slide} + {size}')}) AS last_end
FROM c GROUP BY {_text(f'w * {slide}')}[1:10], {keys}
"""


def _quota_ranked(max_count: int = 2) -> str:
    return (f"(SELECT event_id, user_id, event_type, us, us // {DAY} AS day, "
            f"row_number() OVER (PARTITION BY user_id, event_type, us // {DAY} ORDER BY us, event_id) AS n "
            f"FROM {EV} e)")


def quota_pass_sql() -> str:
    return f"SELECT event_id, user_id, event_type FROM {_quota_ranked()} r WHERE n <= 3"


def quota_alert_sql() -> str:
    return (f"SELECT user_id, event_type, day, event_id, us AS blocked_us, 'Click over 2 times today.' AS msg "
            f"FROM {_quota_ranked()} r WHERE n = 4")


def ad_geo_filtered_sql() -> str:
    src = f"(SELECT us, event_type AS province FROM {_quota_ranked()} r WHERE n <= 3)"
    return _sliding_text(src, "province", "province", HOUR, 300_000_000)


def fail_burst_sql() -> str:
    w = 2 * HOUR
    return f"""
WITH g AS (SELECT event_id, user_id, event_type, us,
                  min(us) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS drain
           FROM {EV} e),
f AS (SELECT *, count(*) OVER (PARTITION BY user_id, drain) AS n,
             row_number() OVER (PARTITION BY user_id, drain ORDER BY us, event_id) AS rn
      FROM g WHERE event_type = 'error')
SELECT event_id, user_id, us AS ts_us, n AS fails_in_burst FROM f WHERE n > 1 AND rn = 1
"""


def _lagged() -> str:
    return f"""(SELECT *, lag(fail) OVER w AS pfail, lag(us) OVER w AS pus, lag(event_id) OVER w AS pid
   FROM (SELECT event_id, user_id, event_type = 'error' AS fail, us FROM {EV} e)
   WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))"""


def fail_consecutive_sql() -> str:
    return (f"SELECT user_id, pid AS first_event_id, event_id AS second_event_id, pus AS first_us, us AS second_us, "
            f"'login fail in 7200 seconds.' AS msg FROM {_lagged()} l "
            f"WHERE fail AND pfail AND us < pus + {2 * HOUR}")


def fail_pattern_sql() -> str:
    return (f"SELECT user_id, pid AS begin_event_id, event_id AS next_event_id, pus AS begin_us, us AS next_us "
            f"FROM {_lagged()} l WHERE fail AND pfail AND us - pus < {2 * HOUR}")


def order_pattern_sql() -> str:
    return f"""
WITH e AS (SELECT event_id, user_id, event_type, us FROM {EV} e WHERE event_type IN ('signup', 'purchase')),
n AS (SELECT *,
        first_value(CASE WHEN event_type = 'purchase' THEN us END IGNORE NULLS) OVER w AS nus,
        first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS nid
      FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
o AS (SELECT *, (nus IS NOT NULL AND nus - us < {DAY}) AS ok FROM n WHERE event_type = 'signup')
SELECT event_id, user_id, us AS start_us, CASE WHEN ok THEN nid END AS end_event_id,
       CASE WHEN ok THEN nus END AS end_us, CASE WHEN ok THEN 'success' ELSE 'timeout' END AS outcome
FROM o
"""


def order_deadline_sql() -> str:
    return f"""
WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY us, event_id) AS rn
                          FROM {EV} e WHERE event_type = 'signup') WHERE rn = 1),
p AS (SELECT user_id, k, min(us) AS fp FROM {EV} e WHERE event_type = 'purchase' GROUP BY user_id, k)
SELECT c.user_id, c.k, c.event_id, c.us AS start_us, 'order timeout' AS msg
FROM c LEFT JOIN p ON c.user_id = p.user_id AND c.k = p.k
WHERE p.fp IS NULL OR p.fp > c.us + {DAY}
"""


def order_deadline_all_sql() -> str:
    """Replay of a key's rows, one per step: paid flag, pending timers, and the timers that alert at this row.

    The last step of a key is a row beyond all times, at which every timer left fires.
    """
    timers = "STRUCT(due BIGINT, id BIGINT, us BIGINT)[]"
    return f"""
WITH RECURSIVE e AS (
  SELECT user_id, k, event_id, us, event_type = 'signup' AS s,
         row_number() OVER (PARTITION BY user_id, k ORDER BY us, event_id) AS n
  FROM {EV} v WHERE event_type IN ('signup', 'purchase')),
r AS (SELECT * FROM e
      UNION ALL
      SELECT user_id, k, NULL, 9000000000000000000, false, max(n) + 1 FROM e GROUP BY user_id, k),
m AS (
  SELECT user_id, k, CAST(0 AS BIGINT) AS n, false AS paid, CAST([] AS {timers}) AS timers, CAST([] AS {timers}) AS alerts
  FROM e GROUP BY user_id, k
  UNION ALL
  SELECT user_id, k, n, NOT s OR still_paid,
         CASE WHEN s AND NOT still_paid AND len(list_filter(pending, lambda x: x.due = us + {DAY})) = 0
              THEN list_append(pending, {{'due': us + {DAY}, 'id': event_id, 'us': us}}) ELSE pending END,
         CASE WHEN paid THEN fired[2:] ELSE fired END
  FROM (SELECT *, paid AND len(fired) = 0 AS still_paid
        FROM (SELECT r.*, m.paid, list_filter(m.timers, lambda x: x.due < r.us) AS fired,
                     list_filter(m.timers, lambda x: x.due >= r.us) AS pending
              FROM m JOIN r ON r.user_id = m.user_id AND r.k = m.k AND r.n = m.n + 1))),
a AS (SELECT user_id, k, unnest(alerts) AS t FROM m)
SELECT user_id, k, t.id AS event_id, t.us AS start_us, 'order timeout' AS msg FROM a
"""


def _numbered(kind: str) -> str:
    return (f"(SELECT user_id, k, event_id, row_number() OVER (PARTITION BY user_id, k "
            f"ORDER BY us, event_id) AS rn FROM {EV} e WHERE event_type = '{kind}')")


_SAME = "re.user_id = pa.user_id AND re.k = pa.k AND re.rn = pa.rn"


def tx_pairs_sql() -> str:
    return (f"SELECT pa.user_id, pa.k, pa.event_id AS pay_event_id, re.event_id AS receipt_event_id "
            f"FROM {_numbered('purchase')} pa JOIN {_numbered('view')} re ON {_SAME}")


def tx_left_sql() -> str:
    return (f"SELECT user_id, k, event_id AS pay_event_id FROM {_numbered('purchase')} pa "
            f"WHERE NOT EXISTS (SELECT 1 FROM {_numbered('view')} re WHERE {_SAME})")


def tx_right_sql() -> str:
    return (f"SELECT user_id, k, event_id AS receipt_event_id FROM {_numbered('view')} re "
            f"WHERE NOT EXISTS (SELECT 1 FROM {_numbered('purchase')} pa WHERE {_SAME})")


def tx_tolerance_sql(wait: int = 2 * HOUR) -> str:
    """Replay of a user's purchases and views, one per step: the rows that wait (all of one side), and what this row settles.

    The last step of a user is a row beyond all times, which settles what still waits.
    """
    rows = "STRUCT(id BIGINT, side INTEGER, us BIGINT)[]"
    return f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, us, CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END AS side FROM {EV} v WHERE event_type IN ('purchase', 'view')),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id, side) AS n FROM e),
r AS (SELECT * FROM o
      UNION ALL SELECT user_id, NULL, 9000000000000000000, 2, max(n) + 1 FROM o GROUP BY user_id),
m AS (
  SELECT user_id, CAST(0 AS BIGINT) AS n, CAST([] AS {rows}) AS waiting, CAST([] AS {rows}) AS gone, CAST(NULL AS BIGINT) AS pay, CAST(NULL AS BIGINT) AS receipt
  FROM o GROUP BY user_id
  UNION ALL
  SELECT user_id, n, CASE WHEN side = 2 THEN [] WHEN meets THEN fresh[2:] ELSE list_append(fresh, {{'id': event_id, 'side': side, 'us': us}}) END, late,
         CASE WHEN meets THEN CASE WHEN side = 0 THEN event_id ELSE fresh[1].id END END, CASE WHEN meets THEN CASE WHEN side = 1 THEN event_id ELSE fresh[1].id END END
  FROM (SELECT *, side < 2 AND len(fresh) > 0 AND fresh[1].side <> side AS meets
        FROM (SELECT r.*, list_filter(m.waiting, lambda x: r.us - x.us <= {wait}) AS fresh, list_filter(m.waiting, lambda x: r.us - x.us > {wait}) AS late
              FROM m JOIN r ON r.user_id = m.user_id AND r.n = m.n + 1))),
a AS (SELECT user_id, unnest(gone) AS g FROM m)
SELECT user_id, pay AS pay_event_id, receipt AS receipt_event_id, 'matched' AS outcome FROM m WHERE pay IS NOT NULL
UNION ALL
SELECT user_id, CASE WHEN g.side = 0 THEN g.id END, CASE WHEN g.side = 1 THEN g.id END, CASE WHEN g.side = 0 THEN 'left_only' ELSE 'right_only' END FROM a
"""


def word_count_sql() -> str:
    return (f"SELECT word, count(*) AS cnt FROM (SELECT unnest({_jvm_split('text', ' ')}) AS word FROM documents) t "
            f"GROUP BY word")


def word_running_sql() -> str:
    return f"""
WITH t AS (SELECT doc_id, {_jvm_split('text', ' ')} AS a FROM documents),
u AS (SELECT doc_id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS word FROM t)
SELECT doc_id, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM u
"""


def _over(frame: str, order: str, cnt: str, total: str) -> str:
    return (f"SELECT event_id, user_id, count(*) OVER w AS {cnt}, round(sum(value) OVER w, 6) AS {total} "
            f"FROM {EV} e WINDOW w AS (PARTITION BY user_id ORDER BY {order} {frame})")


def _split_rows(outer: bool, text: str = "p_brand") -> str:
    arr = _jvm_split(text, "#")
    if outer:
        arr = f"(CASE WHEN {arr} IS NULL OR len({arr}) = 0 THEN [NULL]::VARCHAR[] ELSE {arr} END)"
    return (f"SELECT p_partkey, word, CAST(length(word) AS INTEGER) AS length "
            f"FROM (SELECT p_partkey, unnest({arr}) AS word FROM part) t")


def _rows_numbered() -> str:
    return (f"(SELECT user_id, us, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS rn "
            f"FROM {EV} e)")


def _top_rows(k: int) -> str:
    """The k highest values per (user, type), ranks without a value as the smallest double."""
    return f"""
WITH r AS (SELECT user_id, event_type, value,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC) AS rn
           FROM events WHERE value IS NOT NULL),
g AS (SELECT DISTINCT user_id, event_type FROM events),
k AS (SELECT CAST(range AS INTEGER) AS rank FROM range(1, {k + 1}))
SELECT g.user_id, g.event_type, coalesce(r.value, -1.7976931348623157e308) AS temp, k.rank
FROM g CROSS JOIN k
LEFT JOIN r ON r.user_id IS NOT DISTINCT FROM g.user_id AND r.event_type IS NOT DISTINCT FROM g.event_type AND r.rn = k.rank
"""


def oracle_sql() -> dict[str, str]:
    sql = _operator_sql()
    # called from SQL text: the answers of the native forms
    return sql | {"hash_code_sql": sql["hash_code"], "avg_sql": sql["avg_long"], "top2_sql": sql["top2"]}


def _operator_sql() -> dict[str, str]:
    hour, day = HOUR, DAY
    return {
        "hot_items": hot_items_sql(),
        "hot_items_hourly": hot_items_sql(HOUR, 300_000_000, 3),
        "report": report_sql(),
        "hot_urls": hot_urls_sql(),
        "hot_urls_5s": hot_urls_sql(5_000_000),
        "uv_exact": uv_exact_sql(),
        "uv_hashed": uv_hashed_sql(),
        "uv_running": uv_running_sql(),
        "marketing_channel": marketing_channel_sql(),
        "marketing_total": marketing_total_sql(),
        "ad_geo": ad_geo_sql(),
        "ad_geo_filtered": ad_geo_filtered_sql(),
        "quota_pass": quota_pass_sql(),
        "quota_alert": quota_alert_sql(),
        "fail_burst": fail_burst_sql(),
        "fail_consecutive": fail_consecutive_sql(),
        "fail_pattern": fail_pattern_sql(),
        "order_pattern": order_pattern_sql(),
        "order_deadline": order_deadline_sql(),
        "order_deadline_all": order_deadline_all_sql(),
        "marketing_channel_1s": _sliding_daily(_marketing_src(), "channel, behavior", "channel, behavior", HOUR, 1_000_000),
        "marketing_total_5s": _sliding_daily(_marketing_src(), "behavior", f"'{ALL_CHANNELS_LABEL}' AS channel, behavior",
                                             HOUR, 5_000_000),
        "ad_geo_15s": _sliding_daily(f"(SELECT us, event_type AS province FROM {EV} e)", "province", "province",
                                     HOUR, 15_000_000),
        "ad_geo_filtered_15s": _sliding_daily(
            f"(SELECT us, event_type AS province FROM {_quota_ranked()} r WHERE n <= 3)", "province", "province",
            HOUR, 15_000_000),
        "slide_10h_5m": f"""
WITH x AS ({_sliding(f'{EV} e', 'event_type', 'us', 10 * HOUR, 300_000_000)})
SELECT w * 300000 AS window_start, event_type, count(*) AS cnt FROM x GROUP BY w, event_type
""",
        "tx_pairs": tx_pairs_sql(),
        "tx_left": tx_left_sql(),
        "tx_right": tx_right_sql(),
        "tx_tolerance": tx_tolerance_sql(),
        "word_count": word_count_sql(),
        "word_running": word_running_sql(),
        "filter_project": "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'",
        "not_null": ("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer "
                     "WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL"),
        "group_count": "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id",
        "json_props": ("SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS cnt "
                       "FROM events GROUP BY 1"),
        "computed_ts": (f"SELECT event_id, epoch_us(ts) // 1000000 AS ts_s, "
                        f"{_text('(epoch_us(ts) // 1000000) * 1000000')} AS rt FROM events"),
        "hourly_avg": (f"SELECT (us // {hour} * {hour} + {hour}) // 1000 AS window_end, lower(event_type) AS etype, "
                       f"round(avg(value), 6) AS avg_value FROM {EV} e GROUP BY 1, 2"),
        "tumble_count": (f"SELECT us // {hour} * {hour} // 1000 AS window_start, event_type, count(*) AS cnt "
                         f"FROM {EV} e GROUP BY 1, 2"),
        "sql_tumble": (f"SELECT us // {hour} * {hour} // 1000 AS window_start, event_type, count(*) AS cnt "
                       f"FROM {EV} e GROUP BY 1, 2"),
        "sliding_1h_15s": f"""
WITH x AS ({_sliding(f'{EV} e', 'event_type', 'us', hour, 15_000_000)})
SELECT w * 15000000 AS window_start, event_type, count(*) AS cnt FROM x GROUP BY w, event_type
""",
        "slide_10h": f"""
WITH x AS ({_sliding(f'{EV} e', 'event_type', 'us', 10 * hour, hour)})
SELECT w * {hour} // 1000 AS window_start, event_type, count(*) AS cnt FROM x GROUP BY w, event_type
""",
        "session_10m": f"""
WITH s AS (SELECT user_id, us,
                  CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) <= 600000000 THEN 0 ELSE 1 END AS new
           FROM {EV} e),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, min(us) AS window_start, max(us) + 600000000 AS window_end, count(*) AS cnt
FROM g GROUP BY user_id, sid
""",
        "rows_tumble": (f"SELECT user_id, (rn - 1) // 10 AS row_group, min(us) AS first_us, max(us) AS last_us, "
                        f"count(*) AS cnt FROM {_rows_numbered()} r GROUP BY user_id, (rn - 1) // 10 "
                        f"HAVING count(*) = 10"),
        "rows_slide": (f"SELECT e.user_id, e.rn AS end_row, min(r.us) AS first_us, max(r.us) AS last_us, "
                       f"count(*) AS cnt FROM {_rows_numbered()} e JOIN {_rows_numbered()} r "
                       f"ON r.user_id = e.user_id AND r.rn > e.rn - 10 AND r.rn <= e.rn "
                       f"WHERE e.rn % 5 = 0 GROUP BY e.user_id, e.rn"),
        "over_range_all": _over("RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "us", "run_cnt", "run_sum"),
        "over_rows_all": _over("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "us, event_id",
                               "run_cnt", "run_sum"),
        "over_range_1h": _over(f"RANGE BETWEEN {hour} PRECEDING AND CURRENT ROW", "us", "rng_cnt", "rng_sum"),
        "over_rows_10": _over("ROWS BETWEEN 10 PRECEDING AND CURRENT ROW", "us, event_id", "rows_cnt", "rows_sum"),
        "split_inner": _split_rows(False),
        "split_outer": _split_rows(True),
        "split_sql": _split_rows(False, "nullif(p_brand, 'Brand#13')"),
        "split_outer_sql": _split_rows(True, "nullif(p_brand, 'Brand#13')"),
        "top40_sql": _top_rows(40),
        "hash_code": f"""
WITH h AS (SELECT p_partkey, p_brand, {_java_hash('p_brand')} * 10 AS x FROM part),
u AS (SELECT p_partkey, p_brand, ((x % 4294967296) + 4294967296) % 4294967296 AS u FROM h)
SELECT p_partkey, p_brand, CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INTEGER) AS hash_code
FROM u
""",
        "avg_long": ("SELECT event_type, CAST(sum(v) // count(v) AS BIGINT) AS avg_temp "
                     "FROM (SELECT event_type, CAST(trunc(value * 100) AS BIGINT) AS v FROM events) t "
                     "GROUP BY event_type"),
        "top2": """
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rn
           FROM events WHERE value IS NOT NULL),
g AS (SELECT user_id, max(value) FILTER (WHERE rn = 1) AS v1, max(value) FILTER (WHERE rn = 2) AS v2
      FROM r GROUP BY user_id)
SELECT user_id, v1 AS temp, CAST(1 AS INTEGER) AS rank FROM g
UNION ALL
SELECT user_id, coalesce(v2, -1.7976931348623157e308) AS temp, CAST(2 AS INTEGER) AS rank FROM g
""",
        "first_daily": (f"SELECT user_id, day, event_id FROM (SELECT user_id, event_id, us // {day} AS day, "
                        f"row_number() OVER (PARTITION BY user_id, us // {day} ORDER BY us, event_id) AS rn "
                        f"FROM {EV} e) t WHERE rn = 1"),
        "changelog": """
WITH r AS (SELECT event_type, event_id,
                  count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts), event_id ROWS UNBOUNDED PRECEDING) AS c
           FROM events)
SELECT event_type, event_id, true AS is_add, c AS cnt FROM r
UNION ALL
SELECT event_type, event_id, false AS is_add, c - 1 AS cnt FROM r WHERE c > 1
""",
    }
