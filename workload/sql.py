"""The same stand-ins as DuckDB SQL, from base columns only."""

from __future__ import annotations


def loc(t: str, fmt: str = "%Y-%m-%d %H:%M:%S") -> str:
    """Text of epoch seconds in +08:00."""
    return f"strftime(make_timestamp((({t}) + 28800) * 1000000), '{fmt}')"


def day(t: str) -> str:
    return loc(t, "%Y-%m-%d")


def daykey(t: str) -> str:
    return f"CAST({loc(t, '%Y%m%d')} AS INTEGER)"


EV = """ev0 AS (SELECT event_id AS eid, user_id AS uid, event_type AS et, value AS val,
  CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, epoch_us(ts) // 1000000 AS t FROM events),
ev1 AS (SELECT *, t - (eid * 7919) % 864000 AS sts, uid % 97 + 97 * (eid % 2) AS s,
  (1 + uid % 223) || '.' || (eid % 256) || '.' || (uid * 7 % 256) || '.1' AS ip,
  (1 + uid % 223) * 16777216 + (eid % 256) * 65536 + (uid * 7 % 256) * 256 + 1 AS ipn,
  CAST(1 + uid % 97 AS VARCHAR) AS game, 'dev-' || (uid % 40) AS device,
  CASE et WHEN 'view' THEN 'login' WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'register'
   WHEN 'click' THEN 'click' ELSE 'active' END AS kind FROM ev0),
ev AS (SELECT *, CAST(5000 + s AS VARCHAR) AS gc, CAST(1000 + s AS VARCHAR) AS sub, CAST(eid % 25 AS VARCHAR) AS ch
  FROM ev1)"""

OD = """od0 AS (SELECT o_orderkey AS oid, o_custkey AS uid, o_orderstatus AS st, o_totalprice AS money,
  o_orderpriority AS pr, o_custkey % 120 AS s, epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS t FROM orders),
od1 AS (SELECT *, 1 + s % 97 AS game, CASE WHEN st = 'F' THEN 1 ELSE 0 END AS pay,
  CASE st WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 4 END AS step, 'C' || (uid % 25) AS cur,
  CASE WHEN pr = '5-LOW' THEN 'x' || (oid % 400) ELSE CAST(oid % 400 AS VARCHAR) END AS server,
  CASE WHEN pr = '1-URGENT' THEN '' ELSE (1 + uid % 223) || '.' || (oid % 256) || '.7.1' END AS ip,
  CASE WHEN pr = '1-URGENT' THEN NULL ELSE (1 + uid % 223) * 16777216 + (oid % 256) * 65536 + 7 * 256 + 1 END AS ipn
  FROM od0),
od AS (SELECT *, CASE WHEN game >= 63 THEN 5000 + s WHEN st = 'F' THEN 1000 + s ELSE oid % 25 END AS col,
  CASE pr WHEN '1-URGENT' THEN 'user' WHEN '2-HIGH' THEN 'order_side' WHEN '4-NOT SPECIFIED' THEN 'misc' ELSE 'order' END AS tab
  FROM od1)"""

DIMS = """game_channel AS (SELECT CAST(1 + s_suppkey % 97 AS VARCHAR) AS game_id, CAST(s_nationkey AS VARCHAR) AS channel_id,
  CAST(5000 + s_suppkey AS VARCHAR) AS game_channel_id, s_suppkey AS pos FROM supplier),
channel_of AS (SELECT game_id, game_channel_id, channel_id FROM game_channel),
game_channel_of AS (SELECT game_id, channel_id, arg_max(game_channel_id, pos) AS game_channel_id FROM game_channel GROUP BY 1, 2),
by_game_channel AS (SELECT game_channel_id, channel_id, game_id FROM game_channel),
company AS (SELECT CAST(p_partkey AS VARCHAR) AS game_id, p_brand AS company_id FROM part),
os AS (SELECT CAST(n_nationkey AS VARCHAR) AS channel_id, CAST(n_regionkey AS VARCHAR) AS pf FROM nation),
sub_channel AS (SELECT CAST(1000 + s_suppkey AS VARCHAR) AS sub_channel_id, CAST(s_nationkey AS VARCHAR) AS channel_id FROM supplier),
old_channel AS (SELECT CAST(1000 + s_suppkey AS VARCHAR) AS channel_id, CAST(5000 + s_suppkey AS VARCHAR) AS game_channel_id
  FROM supplier WHERE s_acctbal >= 0),
belong_all AS (SELECT CAST(100000000 + p_partkey % 60 AS VARCHAR) AS belong_game_id, CAST(7000 + p_partkey AS VARCHAR) AS game_channel_id,
  CAST(p_size AS VARCHAR) AS channel_id, CAST(1 + p_partkey % 97 AS VARCHAR) AS game_id, p_partkey % 7 AS sub_pf, p_partkey AS pos FROM part),
belong AS (SELECT belong_game_id, arg_max(game_channel_id, pos) AS game_channel_id, arg_max(channel_id, pos) AS channel_id,
  arg_max(game_id, pos) AS game_id FROM belong_all GROUP BY 1),
belong_overseas AS (SELECT belong_game_id, arg_max(game_channel_id, pos) AS game_channel_id, arg_max(channel_id, pos) AS channel_id,
  arg_max(game_id, pos) AS game_id FROM belong_all WHERE sub_pf IN (4, 5) GROUP BY 1),
special AS (SELECT CAST(5000 + s_suppkey AS VARCHAR) AS game_channel_id FROM supplier WHERE s_acctbal > 3000
  UNION SELECT CAST(7000 + p_partkey AS VARCHAR) FROM part WHERE p_size > 25),
rate AS (SELECT 'C' || n_nationkey AS currency, 1 + n_nationkey / 10.0::DOUBLE AS cny,
  CASE WHEN n_regionkey > 0 THEN 0.1::DOUBLE + n_nationkey / 100.0::DOUBLE END AS usd FROM nation),
test_rule AS (SELECT CAST(n_nationkey + 1 AS VARCHAR) AS game_id, n_nationkey AS n FROM nation)"""

REGIONS = """bounds AS (SELECT (c_custkey * 2654435761) % 4294967296 AS ip_hi, 'N' || c_nationkey AS country,
  c_mktsegment AS province, c_name AS city FROM customer)"""

STATE = """stored AS (SELECT c_custkey || '_' || (5000 + c_custkey % 97 + 97 * i) AS key,
  CASE WHEN c_acctbal > 2000 THEN 1703500000 + c_custkey * 1000 END AS login_ts,
  CASE WHEN c_acctbal > 5000 THEN 1704000000 + c_custkey * 1000 END AS order_ts
  FROM customer, (VALUES (0), (1)) AS b(i))"""


def w(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
