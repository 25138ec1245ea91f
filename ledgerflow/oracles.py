"""DuckDB statements that independently compute each named query (the correctness oracle).

Tables ``events``, ``customer``, ``lineitem`` ... are views over the same parquet files. Output
columns carry the same names and types as the Spark queries in :mod:`ledgerflow.workloads`.
"""

# The tx view: events as classified DC records.
TX = """
WITH tx0 AS (
  SELECT event_id AS seq, ts,
         CAST(user_id AS VARCHAR) AS act_nbr,
         CAST(user_id % 5 AS VARCHAR) AS ccy_cod,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS brn,
         strftime(ts, '%Y-%m-%d') AS date,
         strftime(ts, '%H:%M') AS time,
         CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS amt,
         CASE event_type WHEN 'click' THEN 'N7CP' WHEN 'error' THEN 'ONN3'
              WHEN 'purchase' THEN 'N7PR' WHEN 'signup' THEN 'VF32' WHEN 'view' THEN 'RJ53' END AS code
  FROM events),
tx AS (
  SELECT *,
         CASE WHEN code IN ('N7CP', 'ONN3') THEN 'OUT' WHEN code = 'N7PR' THEN 'IN' END AS direction,
         CAST(CASE WHEN code IN ('N7CP', 'ONN3') THEN -abs(amt) WHEN code = 'N7PR' THEN abs(amt)
                   ELSE 0 END AS DECIMAL(38,2)) AS signed_amt
  FROM tx0)
"""

FC = """
WITH fc AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS act_nbr, CAST(user_id % 5 AS VARCHAR) AS ccy_cod,
         CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS amt,
         CASE WHEN event_type IN ('purchase', 'signup') THEN '+' ELSE '-' END AS dir
  FROM events),
excl AS (
  SELECT CAST(c_custkey AS VARCHAR) AS act_nbr, CAST(c_nationkey % 5 AS VARCHAR) AS ccy_cod
  FROM customer WHERE c_acctbal < 0),
fc_kept AS (
  SELECT * FROM fc
  WHERE NOT EXISTS (SELECT 1 FROM excl
                    WHERE coalesce(excl.act_nbr, 'null') = coalesce(fc.act_nbr, 'null')
                      AND coalesce(excl.ccy_cod, 'null') = coalesce(fc.ccy_cod, 'null')))
"""

WINDOW_INOUT = TX + """,
win AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         act_nbr, ccy_cod, brn,
         CAST(coalesce(sum(CASE WHEN direction = 'IN' THEN signed_amt END), 0) AS DECIMAL(38,2)) AS in_amt,
         CAST(coalesce(sum(CASE WHEN direction = 'OUT' THEN signed_amt END), 0) AS DECIMAL(38,2)) AS out_amt
  FROM tx WHERE direction IS NOT NULL
  GROUP BY ALL)
"""

ORACLES: dict[str, str] = {}

ORACLES["parse_props"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""

ORACLES["src_json_lines"] = TX + """
SELECT seq, 'DigitCurrency' AS msg_type, strftime(ts, '%Y-%m-%d %H.%M.%S') AS send_time,
       act_nbr, ccy_cod, brn, strftime(ts, '%Y-%m-%d %H.%M.%S') AS reg_tim,
       CAST(CAST(amt AS DECIMAL(18,2)) AS VARCHAR) AS trs_amt,
       CAST(CAST(amt AS DECIMAL(18,2)) AS VARCHAR) AS onl_bal, code, code[1] AS trs_dir,
       CAST(seq % 3 AS VARCHAR) AS rcd_ver
FROM tx
"""

ORACLES["src_fc_lines"] = FC + "SELECT seq, act_nbr, ccy_cod, amt, dir FROM fc"

ORACLES["src_order_lines"] = """
SELECT user_id AS order_id, CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS event_type,
       't' || event_id AS tx_id, epoch(date_trunc('second', ts))::BIGINT AS event_time,
       date_trunc('second', ts) AS ts
FROM events WHERE event_type IN ('signup', 'purchase')
"""

ORACLES["src_device_lines"] = """
SELECT CAST(user_id AS VARCHAR) AS id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
       CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS ts
FROM events
"""

ORACLES["text_scalars"] = """
SELECT event_id, date_trunc('second', ts) AS ts, true AS is_uuid FROM events
"""

ORACLES["src_csv_lines"] = """
SELECT user_id, event_id AS item_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS category_id,
       event_type AS behavior, epoch(date_trunc('second', ts))::BIGINT AS "timestamp",
       date_trunc('second', ts) AS ts
FROM events
"""

ORACLES["tx_signed"] = TX + """
SELECT seq, act_nbr, ccy_cod, brn, date, time, code, direction, amt, signed_amt FROM tx
"""

ORACLES["dc_direction_sum"] = TX + """
SELECT date, time, ccy_cod, brn, direction, CAST(sum(signed_amt) AS DECIMAL(38,2)) AS amt
FROM tx WHERE direction IS NOT NULL GROUP BY ALL
"""

NET_FLOW = TX + """,
net AS (
  SELECT date, time, ccy_cod, brn,
         CAST(coalesce(sum(CASE WHEN direction = 'OUT' THEN signed_amt END), 0) AS DECIMAL(38,2)) AS out_amt,
         CAST(coalesce(sum(CASE WHEN direction = 'IN' THEN signed_amt END), 0) AS DECIMAL(38,2)) AS in_amt,
         CAST(sum(signed_amt) AS DECIMAL(38,2)) AS sum_amt
  FROM tx WHERE direction IS NOT NULL GROUP BY ALL)
"""

ORACLES["dc_net_flow"] = NET_FLOW + "SELECT * FROM net"

ORACLES["dc_cells"] = NET_FLOW + """,
keyed AS (SELECT md5(to_json(['0', date, time, ccy_cod, brn])::VARCHAR) AS rowkey, * FROM net)
SELECT 'dc_sum_mon' AS "table", rowkey, 'digitCur' AS family, qualifier, value FROM (
  SELECT rowkey, 'date' AS qualifier, date AS value FROM keyed
  UNION ALL SELECT rowkey, 'time', time FROM keyed
  UNION ALL SELECT rowkey, 'ccyCod', ccy_cod FROM keyed
  UNION ALL SELECT rowkey, 'brn', brn FROM keyed
  UNION ALL SELECT rowkey, 'outAmt', CAST(out_amt AS VARCHAR) FROM keyed
  UNION ALL SELECT rowkey, 'inAmt', CAST(in_amt AS VARCHAR) FROM keyed
  UNION ALL SELECT rowkey, 'sumAmt', CAST(sum_amt AS VARCHAR) FROM keyed)
"""

ORACLES["dc_tumbling_sum"] = TX + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       date, time, ccy_cod, brn, direction, CAST(sum(signed_amt) AS DECIMAL(38,2)) AS amt
FROM tx WHERE direction IS NOT NULL GROUP BY ALL
"""

ORACLES["dc_tumbling_unmatched"] = TX + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       CASE WHEN direction IS NOT NULL THEN date END AS date,
       CASE WHEN direction IS NOT NULL THEN time END AS time,
       CASE WHEN direction IS NOT NULL THEN ccy_cod END AS ccy_cod,
       CASE WHEN direction IS NOT NULL THEN brn END AS brn,
       direction, CAST(sum(signed_amt) AS DECIMAL(38,2)) AS amt
FROM tx GROUP BY ALL
"""

ORACLES["dc_window_inout"] = WINDOW_INOUT + "SELECT * FROM win"

ORACLES["dc_running_total"] = WINDOW_INOUT + """
SELECT act_nbr, ccy_cod, brn, window_start, window_end,
       CAST(sum(in_amt) OVER w AS DECIMAL(38,2)) AS cum_in,
       CAST(sum(out_amt) OVER w AS DECIMAL(38,2)) AS cum_out,
       CAST(sum(in_amt + out_amt) OVER w AS DECIMAL(38,2)) AS cum_net
FROM win
WINDOW w AS (PARTITION BY act_nbr, ccy_cod, brn ORDER BY window_end ROWS UNBOUNDED PRECEDING)
"""

ORACLES["fc_anti"] = FC + "SELECT seq, act_nbr, ccy_cod, amt, dir FROM fc_kept"

ORACLES["fc_sum"] = FC + """
SELECT act_nbr, ccy_cod, dir, CAST(sum(amt) AS DECIMAL(38,2)) AS amt FROM fc_kept GROUP BY ALL
"""

# ---------------------------------------------------------------- behaviour
MARKS = """
WITH m AS (
  SELECT CAST(user_id AS VARCHAR) AS name, event_id AS seq,
         CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS mark FROM events),
r0 AS (
  SELECT name, seq, sum(mark) OVER w AS run_sum, count(mark) OVER w AS cnt FROM m
  WINDOW w AS (PARTITION BY name ORDER BY seq ROWS UNBOUNDED PRECEDING)),
r AS (
  SELECT name, seq, CAST(run_sum AS DECIMAL(38,2)) AS run_sum, cnt AS count,
         -- average rounded half up to 6 places, in exact integer arithmetic
         CAST((2 * CAST(run_sum * 100 AS BIGINT) * 10000 + cnt) // (2 * cnt) AS DECIMAL(38,0))
           * CAST(0.000001 AS DECIMAL(7,6)) AS avg_mark
  FROM r0)
"""

ORACLES["running_avg"] = MARKS + "SELECT * FROM r"

ORACLES["purge_segments"] = MARKS + """,
f AS (SELECT *, CASE WHEN run_sum > 80 * count THEN 1 ELSE 0 END AS fire FROM r),
s AS (SELECT *, coalesce(sum(fire) OVER (PARTITION BY name ORDER BY seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment FROM f),
g AS (SELECT *, max(fire) OVER (PARTITION BY name, segment) AS closed,
             row_number() OVER (PARTITION BY name, segment ORDER BY avg_mark DESC, seq) AS rn
      FROM s)
SELECT name, CAST(segment AS BIGINT) AS segment, seq, avg_mark, count FROM g
WHERE closed = 1 AND rn = 1
"""

VIEWS = """
WITH v AS (SELECT ts, user_id, event_id AS seq,
                  time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
           FROM events WHERE event_type = 'view')
"""

POLY_HASH = ("list_reduce(list_transform(str_split(CAST(user_id AS VARCHAR), ''), "
             "lambda c: CAST(ascii(c) AS BIGINT)), lambda h, c: (h * 61 + c) & 536870911, "
             "CAST(0 AS BIGINT))")

ORACLES["uv_hourly"] = VIEWS + """
SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM v GROUP BY ALL
"""

ORACLES["uv_approx"] = VIEWS + """
SELECT DISTINCT window_start, window_end, true AS near FROM v
"""

ORACLES["uv_last"] = VIEWS + """
SELECT window_start, window_end, max(seq) AS seq, arg_max(user_id, seq) AS user_id FROM v GROUP BY ALL
"""

ORACLES["poly_hash"] = f"SELECT event_id, user_id, {POLY_HASH} AS h FROM events"

ORACLES["uv_bitmap"] = VIEWS + f"""
SELECT window_start, window_end, CAST(count(DISTINCT {POLY_HASH}) AS BIGINT) AS uv FROM v GROUP BY ALL
"""

ORACLES["uv_running"] = VIEWS + """,
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_start, user_id ORDER BY seq) = 1
                     THEN 1 ELSE 0 END AS new FROM v)
SELECT window_start, window_end, seq, user_id,
       CAST(sum(new) OVER (PARTITION BY window_start ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
FROM f
"""

ORACLES["marketing_sliding"] = """
WITH m AS (
  SELECT event_type AS behavior,
         ['wechat', 'weibo', 'appstore', 'huaweistore'][user_id % 4 + 1] AS channel,
         time_bucket(INTERVAL 10 MINUTE, ts) AS pane
  FROM events WHERE event_type <> 'error')
SELECT pane - k * INTERVAL 10 MINUTE AS window_start,
       pane - k * INTERVAL 10 MINUTE + INTERVAL 1 HOUR AS window_end,
       channel, behavior, count(*) AS count
FROM m, range(0, 6) AS r(k)
GROUP BY ALL
"""

DEVICES = """
WITH d AS (SELECT CAST(user_id AS VARCHAR) AS id, CAST(value AS DECIMAL(18,2)) AS value, ts,
                  event_id AS seq,
                  time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end
           FROM events)
"""

ORACLES["device_max_by"] = DEVICES + """
SELECT id, window_start, window_end, seq, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY id, window_start ORDER BY value DESC, seq) AS rn FROM d)
WHERE rn = 1
"""

ORACLES["device_collect"] = DEVICES + """
SELECT id, window_start, window_end,
       row_number() OVER (PARTITION BY id, window_start ORDER BY ts, seq) AS pos, seq, ts, value
FROM d
"""

ORACLES["count_trigger"] = DEVICES + """,
p AS (SELECT *, (row_number() OVER (PARTITION BY id, window_start ORDER BY ts, seq) - 1) // 2 + 1
                  AS fire_no FROM d),
g AS (SELECT id, window_start, window_end, fire_no, count(*) AS k, sum(value) AS s, max(value) AS m
      FROM p GROUP BY ALL)
SELECT id, window_start, window_end, CAST(fire_no AS BIGINT) AS fire_no,
       CAST(fire_no * 2 AS BIGINT) AS cum_count,
       CAST(sum(s) OVER w AS DECIMAL(38,2)) AS cum_sum, max(m) OVER w AS cum_max
FROM g WHERE k = 2
WINDOW w AS (PARTITION BY id, window_start ORDER BY fire_no ROWS UNBOUNDED PRECEDING)
"""

ORACLES["early_fire"] = DEVICES + """,
t AS (SELECT id, window_start, window_end,
             least(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, window_end) AS fire_time,
             count(*) AS n, sum(value) AS s, max(value) AS m
      FROM d GROUP BY ALL),
c AS (SELECT id, window_start, window_end, fire_time, sum(n) OVER w AS cum_count,
             sum(s) OVER w AS cum_sum, max(m) OVER w AS cum_max FROM t
      WINDOW w AS (PARTITION BY id, window_start ORDER BY fire_time ROWS UNBOUNDED PRECEDING))
SELECT id, window_start, window_end, fire_time, 'early' AS fire_kind,
       CAST(cum_count AS BIGINT) AS cum_count, CAST(cum_sum AS DECIMAL(38,2)) AS cum_sum, cum_max
FROM c WHERE fire_time < window_end
UNION ALL
SELECT id, window_start, window_end, window_end, 'final', CAST(sum(n) AS BIGINT),
       CAST(sum(s) AS DECIMAL(38,2)), max(m)
FROM t GROUP BY id, window_start, window_end
"""

# ---------------------------------------------------------------- joins
ORACLES["interval_join"] = """
SELECT l.user_id, l.ts AS l_ts, l.event_id AS l_event_id, r.ts AS r_ts, r.event_id AS r_event_id
FROM events l JOIN events r
  ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 90 MINUTE AND l.ts
WHERE l.event_type = 'click' AND r.event_type = 'view'
"""

ORACLES["window_join"] = """
SELECT l.user_id, time_bucket(INTERVAL 1 DAY, l.ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, l.ts) + INTERVAL 1 DAY AS window_end,
       l.ts AS l_ts, l.event_id AS l_event_id, r.ts AS r_ts, r.event_id AS r_event_id
FROM events l JOIN events r
  ON l.user_id = r.user_id AND time_bucket(INTERVAL 1 DAY, l.ts) = time_bucket(INTERVAL 1 DAY, r.ts)
WHERE l.event_type = 'click' AND r.event_type = 'view'
"""

# ---------------------------------------------------------------- patterns
ORDERS = """
WITH o AS (SELECT user_id AS order_id,
                  CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS et,
                  ts, event_id AS seq
           FROM events WHERE event_type IN ('signup', 'purchase')),
n AS (SELECT *,
        first_value(CASE WHEN et = 'pay' THEN ts END IGNORE NULLS) OVER w AS next_ts,
        first_value(CASE WHEN et = 'pay' THEN seq END IGNORE NULLS) OVER w AS next_seq
      FROM o
      WINDOW w AS (PARTITION BY order_id ORDER BY ts, seq
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, coalesce(next_ts < ts + INTERVAL 12 HOUR, false) AS matched FROM n WHERE et = 'create')
"""

ORACLES["order_pay_match"] = ORDERS + """
SELECT order_id, seq AS first_seq, ts AS first_ts, next_seq, next_ts,
       'payed successfully' AS result FROM c WHERE matched
"""

ORACLES["order_pay_timeout"] = ORDERS + """
SELECT order_id, seq AS first_seq, ts AS first_ts, 'timeout' AS result FROM c WHERE NOT matched
"""

# ---------------------------------------------------------------- late data
LATE = """
WITH d AS (SELECT event_id, user_id, event_type,
                  CASE WHEN event_id % 4 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ets
           FROM events),
f AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ets) + INTERVAL 1 HOUR AS window_end,
             max(ets) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm
      FROM d),
g AS (SELECT *, coalesce(window_end <= wm, false) AS is_late FROM f)
"""

ORACLES["late_split"] = LATE + """
SELECT event_id, user_id, event_type, ets, window_end FROM g WHERE is_late
"""

ORACLES["late_split_delay"] = LATE + """
SELECT event_id, user_id, event_type, ets, window_end FROM g
WHERE window_end - INTERVAL 1 MILLISECOND <= wm - INTERVAL 30 MINUTE
"""

ORACLES["on_time_counts"] = LATE + """
SELECT time_bucket(INTERVAL 1 HOUR, ets) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ets) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS count
FROM g WHERE NOT is_late GROUP BY ALL
"""

# ---------------------------------------------------------------- routing
ACT = """
WITH a AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_returnflag WHEN 'A' THEN 'kpp' WHEN 'N' THEN 'kqp' WHEN 'R' THEN 'kxp' END AS typ,
         CAST(l_orderkey AS VARCHAR) AS act_nbr, CAST(l_partkey % 5 AS VARCHAR) AS ccy_nbr,
         epoch_ms(l_shipdate) AS reg_tim,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS amt,
         CASE l_linestatus WHEN 'O' THEN 'C' WHEN 'F' THEN 'D' END AS dir,
         ['95100', '95500', '99800'][l_suppkey % 3 + 1] AS cod,
         ['20', '22', '33', '44'][l_linenumber % 4 + 1] AS sts,
         ['95100033', '95101233', '95101033'][l_partkey % 3 + 1] AS rcv
  FROM lineitem),
r AS (
  SELECT *, CASE WHEN (typ = 'kpp' AND dir = 'D' AND sts = '22' AND cod = '95100')
                   OR (typ = 'kqp' AND dir = 'C' AND cod = '95100' AND sts = '20')
                 THEN 'keep' ELSE 'del' END AS decision
  FROM a WHERE typ IN ('kpp', 'kqp'))
"""

ORACLES["src_act_lines"] = ACT + """
SELECT l_orderkey, l_linenumber, typ, act_nbr, ccy_nbr, ccy_nbr AS brn, reg_tim, amt, dir, cod, sts, rcv
FROM a
"""

ORACLES["act_split"] = ACT + """
SELECT l_orderkey, l_linenumber, typ,
       CASE WHEN typ = 'kpp' THEN 'kpp' WHEN typ = 'kqp' THEN 'kqp' ELSE 'other' END AS branch
FROM a
"""

ORACLES["act_rules"] = ACT + """
SELECT l_orderkey, l_linenumber, typ, dir, sts, cod, decision,
       CASE WHEN decision = 'keep' THEN typ ELSE 'del' END AS out_typ
FROM r
"""

ORACLES["act_accepted_union"] = ACT + """
SELECT l_orderkey, l_linenumber, typ, act_nbr, ccy_nbr, reg_tim, amt, dir, cod, sts, rcv
FROM r WHERE decision = 'keep'
"""

ORACLES["act_rejected_union"] = ACT + """
SELECT l_orderkey, l_linenumber, 'del' AS typ, act_nbr, ccy_nbr, reg_tim, amt, dir, cod, sts, rcv
FROM r WHERE decision = 'del'
"""

# ---------------------------------------------------------------- offset ledger
ORACLES["offset_ledger"] = """
SELECT 'events' AS topic, CAST(user_id % 8 AS INTEGER) AS partition, max(event_id) + 1 AS next_offset
FROM events GROUP BY ALL
"""

# ---------------------------------------------------------------- streams
ORACLES["src_mark_lines"] = """
SELECT CAST(user_id AS VARCHAR) AS name, CAST(value AS DECIMAL(18,2)) AS mark FROM events
"""

# A stream without further rows stops at the latest event time: what lies beyond has not closed.
ORACLES["stream_early_fire"] = "SELECT * FROM (" + ORACLES["early_fire"].replace(
    "CAST(user_id AS VARCHAR) AS id", "CAST(user_id % 8 AS VARCHAR) AS id") + \
    ") WHERE fire_time < (SELECT date_trunc('millisecond', max(ts)) FROM events)"

ORACLES["stream_sliding"] = "SELECT * FROM (" + ORACLES["marketing_sliding"] + \
    ") WHERE window_end < (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type <> 'error')"

ORACLES["stream_segments"] = ORACLES["purge_segments"]

ORACLES["stream_uv_running"] = f"""
WITH v AS (SELECT user_id, event_id AS seq, time_bucket(INTERVAL 1 DAY, ts) AS window_start, {POLY_HASH} AS h
           FROM events WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_start, h ORDER BY seq) = 1
                     THEN 1 ELSE 0 END AS new FROM v)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, seq, user_id,
       CAST(sum(new) OVER (PARTITION BY window_start ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
FROM f
"""
