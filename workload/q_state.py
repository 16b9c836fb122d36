"""First events, new devices, time-window duplicates and stored state."""

from pyspark.sql import functions as F

from playtrail.operators import clicks as ck, dedupe, lines, state as st
from playtrail.session import fresh_path
from playtrail.sinks.state_table import StateTable

from . import inputs as i
from .q_decode import CLICK_SQL
from .registry import query
from .sql import EV, OD, STATE, day, loc, w

# small blocks, so that the running minimum is carried across many of them
BLOCK = 500


def state_rows(spark, sf):
    """Events with a key; some keys are unusable, some rows are tests or unpaid."""
    e = i.ev(spark, sf)
    gc = F.when(F.col("k") == 5, F.lit("error")).when(F.col("k") == 6, F.lit("")).otherwise(F.col("gc"))
    return e.select("eid", "uid", "sts", "kind", "device", "game", gc.alias("gc"),
                    F.when(F.col("k") != 77, F.lit("regular")).otherwise(F.lit("test")).alias("is_test"),
                    F.when(F.col("k") < 70, F.lit("1")).otherwise(F.lit("0")).alias("pay"),
                    F.when(F.col("k") >= 20, F.lit("2")).otherwise(F.lit("1")).alias("step"))


def columns():
    return dict(key=st.state_key(F.col("uid").cast("string"), F.col("gc")), event=F.col("kind"), ts=F.col("sts"), is_test=F.col("is_test"),
                pay_status=F.col("pay"), status=F.col("step"))


OUT = ["eid", "first_order_date", "server_date_day", "server_date_hour", "server_date_minute", "reg_date"]


def stamped_sql(ts, event, login, order, extra=""):
    """The five columns from the prior state; the window is written the plain way."""
    return f"""CASE WHEN {order} IS NULL OR ({event} = 'order' AND {order} > {ts}) THEN CASE WHEN {event} = 'order' THEN {day(ts)} ELSE '' END ELSE {day(order)} END AS first_order_date,
  {day(ts)} AS server_date_day, {loc(ts, '%H')} AS server_date_hour, {loc(ts, '%M')} AS server_date_minute,
  CASE WHEN {login} IS NULL OR ({event} = 'login' AND {login} > {ts}) THEN {day(ts)} ELSE {day(login)} END AS reg_date{extra}"""


def running(paid, key="CASE WHEN k IN (5, 6) THEN NULL ELSE uid || '_' || gc END", state=None, name="se"):
    """prior_login and prior_order of every event."""
    join = f"LEFT JOIN {state} q ON q.key = {name}0.key" if state else ""
    low = (lambda c: f"least({c}, q.{c})") if state else (lambda c: c)
    return f"""{name}0 AS (SELECT *, {key} AS key, CASE WHEN k <> 77 AND kind = 'login' THEN sts END AS lm, CASE WHEN k <> 77 AND kind = 'order' AND {paid} THEN sts END AS om FROM ev),
{name}1 AS (SELECT {name}0.*, CASE WHEN {name}0.key IS NOT NULL THEN min(lm) OVER win END AS login_ts, CASE WHEN {name}0.key IS NOT NULL THEN min(om) OVER win END AS order_ts FROM {name}0
  WINDOW win AS (PARTITION BY {name}0.key ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name} AS (SELECT {name}1.* EXCLUDE (login_ts, order_ts), {low(f'login_ts').replace('login_ts, ', f'{name}1.login_ts, ') if state else f'{name}1.login_ts'} AS login_ts,
  {low('order_ts').replace('order_ts, ', f'{name}1.order_ts, ') if state else f'{name}1.order_ts'} AS order_ts FROM {name}1 {join.replace(name + '0.key', name + '1.key')})"""


PAID = "(k < 70 AND k >= 20)"


@query("first_event_running", w(EV, running(PAID)) + f"SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se")
def first_event_running(spark, sf):
    return st.first_events(state_rows(spark, sf), "eid", **columns(), block_rows=BLOCK).select(*OUT)


@query("first_event_with_state", w(EV, STATE, running(PAID, state="stored")) + f"SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se")
def first_event_with_state(spark, sf):
    """History from earlier runs enters the first block of each key."""
    return st.first_events(state_rows(spark, sf), "eid", **columns(), state=i.stored_state(spark, sf), block_rows=BLOCK).select(*OUT)


@query("first_event_state", w(EV, STATE, running(PAID)) + """SELECT key, min(login_ts) AS login_ts, min(order_ts) AS order_ts FROM
  (SELECT key, min(lm) AS login_ts, min(om) AS order_ts FROM se WHERE key IS NOT NULL GROUP BY 1 UNION ALL SELECT * FROM stored)
  GROUP BY 1 HAVING min(login_ts) IS NOT NULL OR min(order_ts) IS NOT NULL""")
def first_event_state(spark, sf):
    return st.first_event_state(state_rows(spark, sf), **columns(), state=i.stored_state(spark, sf))


@query("first_event_batch", w(EV, running("k < 70")) + f"SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se")
def first_event_batch(spark, sf):
    """History exports: the pay flag alone makes an order paid."""
    return st.first_events(state_rows(spark, sf), "eid", **columns(), flag_only=True, block_rows=BLOCK).select(*OUT)


@query("first_event_nested", w(EV, running("k < 70 AND k >= 20", key="uid || '_' || gc")) + f"SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se")
def first_event_nested(spark, sf):
    """The same function over nested fields with worded states."""
    e = state_rows(spark, sf).join(i.ev(spark, sf).select("eid", F.col("gc").alias("_gc")), "eid").select(
        "eid", "sts", "kind", "is_test", F.struct(F.col("uid").cast("string").alias("user_id")).alias("user"),
        F.struct(F.col("_gc").alias("game_channel_id")).alias("agent"),
        F.struct(F.when(F.col("pay") == "1", F.lit("success")).otherwise(F.lit("failure")).alias("order_status"),
                 F.when(F.col("step") == "2", F.lit("paid_success")).otherwise(F.lit("create_order")).alias("order_step")).alias("order"))
    return st.first_events(e, "eid", st.state_key(F.col("user.user_id"), F.col("agent.game_channel_id")), F.col("kind"), F.col("sts"),
                           F.col("is_test"), F.col("order.order_status"), F.col("order.order_step"), block_rows=BLOCK).select(*OUT)


@query("first_event_by_service", w(EV, running(PAID, key="CASE WHEN kind = 'register' THEN 'r' ELSE '' END || '_' || game || '_' || uid"))
       + f"SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se")
def first_event_by_service(spark, sf):
    """Service-scoped key without the channel; registers keep a state of their own."""
    cols = columns()
    cols["key"] = F.concat_ws("_", F.when(F.col("kind") == "register", F.lit("r")).otherwise(F.lit("")), "game", F.col("uid").cast("string"))
    return st.first_events(state_rows(spark, sf), "eid", **cols, block_rows=BLOCK, shortest=10 ** 9).select(*OUT)


@query("first_order_db", w(OD, """db1 AS (SELECT *, min(CASE WHEN pay = 1 AND step = 2 THEN t END) OVER (PARTITION BY uid ORDER BY oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist FROM od),
db AS (SELECT db1.*, CASE WHEN c_acctbal > 0 THEN 800000000 + c_custkey END AS login FROM db1 LEFT JOIN customer ON c_custkey = uid)""")
       + f"""SELECT oid, CASE WHEN hist IS NULL OR hist > t THEN {day('t')} ELSE {day('hist')} END AS first_order_date, {day('t')} AS server_date_day,
  {loc('t', '%H')} AS server_date_hour, {loc('t', '%M')} AS server_date_minute, CASE WHEN login IS NULL THEN {day('t')} ELSE {day('login')} END AS reg_date FROM db""")
def first_order_db(spark, sf):
    o = i.od(spark, sf).select("oid", "uid", "t", "pay", "step")
    state = i.table(spark, sf, "customer").where("c_acctbal > 0").selectExpr("cast(c_custkey AS string) AS key", "800000000 + c_custkey AS login_ts",
                                                                            "cast(NULL AS bigint) AS order_ts")
    out = st.first_order_dates(o, "oid", F.col("uid").cast("string"), F.col("t"), (F.col("pay") == 1) & (F.col("step") == 2), state=state, block_rows=BLOCK)
    return out.drop("uid", "t", "pay", "step")


@query("new_device_running", w(EV) + """SELECT eid, CASE WHEN coalesce(prior, sts) >= sts THEN 1 ELSE 0 END AS new_device FROM (
  SELECT eid, sts, min(sts) OVER (PARTITION BY game, device ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM ev)""")
def new_device_running(spark, sf):
    e = i.ev(spark, sf).select("eid", "game", "device", "sts")
    return st.new_device(e, ["game", "device"], "eid", "sts", block_rows=BLOCK).select("eid", "new_device")


@query("first_seen_flag", w(EV) + """SELECT eid, CASE WHEN row_number() OVER (PARTITION BY game, device ORDER BY eid) = 1 AND uid >= 20 THEN 1 ELSE 0 END AS new_device FROM
  (SELECT *, min(uid) OVER (PARTITION BY game, device) AS low FROM ev) WHERE TRUE""".replace("uid >= 20", "low >= 20"))
def first_seen_flag(spark, sf):
    e = i.ev(spark, sf).select("eid", "game", "device")
    known = i.ev(spark, sf).where("uid < 20").select("game", "device").distinct()
    return st.first_seen(e, ["game", "device"], "eid", state=known, block_rows=BLOCK).select("eid", "new_device")


DEDUPE_TTL_SQL = w(EV, """pts AS (SELECT uid % 10 AS key, t, min(eid) AS eid FROM ev GROUP BY ALL),
nxt AS (SELECT p.key, p.t, p.eid, q.t AS nt FROM pts p ASOF LEFT JOIN pts q ON q.key = p.key AND p.t + 900 <= q.t),
chain AS (SELECT n.* FROM nxt n JOIN (SELECT key, min(t) AS t FROM pts GROUP BY 1) f USING (key, t)
  UNION ALL SELECT n.* FROM chain c JOIN nxt n ON n.key = c.key AND n.t = c.nt)""") + "SELECT key, t, eid FROM chain"


@query("dedupe_ttl", DEDUPE_TTL_SQL)
def dedupe_ttl(spark, sf):
    """Kept rows of ten busy keys, 15 minutes apart at least."""
    e = i.ev(spark, sf).selectExpr("uid % 10 AS key", "t", "eid")
    return dedupe.dedupe_ttl(e, "key", "t", "eid", ttl=900)


@query("insert_if_absent", w(OD) + """SELECT upper(md5(CAST(uid AS VARCHAR))) AS id, min(oid) AS oid, arg_min(money, oid) AS money FROM od
  WHERE uid NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 3000) GROUP BY uid""")
def insert_if_absent(spark, sf):
    rows = i.od(spark, sf).select(F.upper(F.md5(F.col("uid").cast("string"))).alias("id"), "oid", "money")
    target = i.table(spark, sf, "customer").where("c_acctbal < 3000").select(F.upper(F.md5(F.col("c_custkey").cast("string"))).alias("id"))
    return st.insert_if_absent(rows, target, "id", "oid")


@query("kv_latest_with_ttl", w(EV, CLICK_SQL, """kv AS (SELECT 'company_id_' || company_id || '_api_click_detail_' || cgame || '_' || x AS key, eid, t FROM clicks, (VALUES (0), (1)) AS r(n),
  LATERAL (SELECT CASE WHEN n = 0 THEN ip ELSE cdev END AS x) WHERE reason IS NULL AND (n = 0 OR cdev <> ''))""")
       + """SELECT key, arg_max(eid, eid) AS value, arg_max(t, eid) + 259200 AS expires_at FROM kv GROUP BY 1 HAVING arg_max(t, eid) + 259200 > 1706140800""")
def kv_latest_with_ttl(spark, sf):
    """Click details kept for three days, as of a fixed moment."""
    good = lines.ad_click_lines(i.click_lines(spark, sf)).where("ok")
    keyed = ck.lookup_keys(good).select("key", F.col("eid").alias("value"), "t", "eid")
    return st.latest_with_ttl(keyed, "key", "value", "t", "eid", 259200, F.lit(1706140800))


@query("state_upsert", w(EV, running(PAID)) + """SELECT key, min(lm) AS login_ts, min(om) AS order_ts FROM se WHERE key IS NOT NULL GROUP BY 1
  HAVING min(lm) IS NOT NULL OR min(om) IS NOT NULL""")
def state_upsert(spark, sf):
    """Four batches, one of them written twice; buckets are merged in between."""
    rows = state_rows(spark, sf)
    table = StateTable(fresh_path(spark, "state_upsert"), ["key"], ["login_ts", "order_ts"], buckets=8, deltas=2)
    for number, part in enumerate(("login", "order", "register", "order")):
        delta = st.first_event_state(rows.where(F.col("kind") == part), **columns())
        table.append(delta, number)
        if number == 1:
            table.append(delta, number)
    return table.read(spark)
