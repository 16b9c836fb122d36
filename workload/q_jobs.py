"""Whole jobs, from raw lines to routed rows."""

from pyspark.sql import Window, functions as F

from playtrail.functions import times
from playtrail.operators import resolve, rules as rl
from playtrail.operators.guards import packed_test_rules
from playtrail.plans import feeds, loads, logins, orders
from playtrail.sources import messages, tables
from playtrail.session import fresh_path
from playtrail.sinks import files
from playtrail.sinks.outputs import Outputs

from . import inputs as i
from .q_decode import CLICKED, CLICK_SQL, COIN_SQL, SDK_KEYS, SDK_SQL, MSG_SQL, access_input, active_input, coin_json_input, coin_tsv_input, sdk_input
from .q_filters import FIRST
from .q_joins import COIN_RESOLVED, LOGIN_SQL, ORDER_SQL
from .q_routes import flat_logins
from .q_rows import AD, GID, ORDER_IDS, OWNCH, PF, UNAME
from .q_state import running, stamped_sql
from .registry import query
from .sql import DIMS, EV, OD, REGIONS, STATE, day, daykey, loc, w

LOGIN_RULES = [("login", "user", "user_id", "1"), ("login", "game", "game_id", "1")]
STAMPS = ["first_order_date", "server_date_day", "server_date_hour", "server_date_minute", "reg_date"]
FLAT = {"channel_id": "agent-channel_id", "game_channel_id": "agent-game_channel_id", "os_type": "device-os_type", "company_id": "game-company_id"}
SPECIAL = "(SELECT game_channel_id FROM special)"

LOGIN_CLEAN = """lf AS (SELECT lr.*, et <> 'error' AND NOT (uid % 97 + 1 >= 63 AND g0 = '') AS ok FROM lr),
lg1 AS (SELECT *, CASE WHEN ok AND game_channel_id NOT IN ('', 'error') THEN uid || '_' || game_channel_id END AS key FROM lf),
lg2 AS (SELECT lg1.*, CASE WHEN lg1.key IS NOT NULL THEN least(min(t) OVER (PARTITION BY lg1.key ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), q.login_ts) END AS login_ts,
  CASE WHEN lg1.key IS NOT NULL THEN q.order_ts END AS order_ts FROM lg1 LEFT JOIN stored q ON q.key = lg1.key),
lg3 AS (SELECT lg2.*, coalesce(b.country, '') AS country, coalesce(b.province, '') AS province, coalesce(b.city, '') AS city FROM lg2 ASOF LEFT JOIN bounds b ON lg2.ipn <= b.ip_hi)"""
# every field of the outgoing record: those with a value, then those that this log never has
LOGIN_RECORD = {
    "user-user_id": "uid", "game-game_id": "game", "game-company_id": "company", "agent-channel_id": "channel_id", "agent-game_channel_id": "game_channel_id", "device-os_type": "os_type",
    "event": "'login'", "is_test": "'regular'", "data_ver": "'1.0'", "client_ts": "'0'", "server_time_zone": "'+08:00'", "server_ts": "t", "client_ip": "ip", "country": "country",
    "province": "province", "city": "city", "first_order_date": "first_order_date", "server_date_day": "server_date_day", "server_date_hour": "server_date_hour",
    "server_date_minute": "server_date_minute", "reg_date": "reg_date",
    **dict.fromkeys("""user-user_name user-gender user-birth user-age game-game_name game-game_ver agent-access_token device-screen_height device-screen_width device-device_id device-ios_idfa
    device-android_imei device-android_adv_id device-android_id device-device_name device-os_ver device-sdk_ver device-package_name device-net_type device-user_agent client_time_zone""".split(), "''")}
LOGIN_LINE = """'NORMAL: [' || {at} || CASE WHEN et = 'error' THEN ' ' ELSE '] CIP[' END || ip || '] CONTENT[{{"user_id":"' || uid || '","channel_id":"' || c0 || '","game_id":"' || game || '","channel_name":"x","game_channel_id":"' || g0 || '"}}]'""".format(at=loc("t"))


def ok_only(*names):
    return ", ".join(f"CASE WHEN ok THEN {n} END AS {n}" for n in names)


LOGIN_CLEAN_SQL = w(EV, DIMS, REGIONS, STATE, LOGIN_SQL, LOGIN_CLEAN) + f"""SELECT eid, ok, CASE WHEN NOT ok THEN 'agentLoginFilter' WHEN game_channel_id IN {SPECIAL} THEN 'agentLoginOther' ELSE 'agentLogin' END AS route,
  {ok_only('channel_id', 'game_channel_id', 'os_type', 'country', 'first_order_date', 'server_date_day', 'server_date_hour', 'server_date_minute', 'reg_date')}, CASE WHEN ok THEN company END AS company_id,
  CASE WHEN et = 'error' THEN 'bad frame' WHEN NOT ok THEN 'game channel missing' END AS reject_reason,
  CASE WHEN ok THEN {" || '|' || ".join(f"'{n}=' || {LOGIN_RECORD[n]}" for n in sorted(LOGIN_RECORD, key=lambda n: n + "="))} ELSE {LOGIN_LINE} END AS record
  FROM (SELECT *, {stamped_sql('t', "'login'", 'login_ts', 'order_ts')} FROM lg3)"""


def login_columns(out):
    """The record goes out as text: all its fields in order, or the line that was rejected."""
    fields = F.array_sort(F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    record = F.when(F.col("ok"), F.array_join(fields, "|")).otherwise(F.coalesce(F.get_json_object("value", "$.message"), "value"))
    named = out.select("eid", "ok", "route", "reject_reason", record.alias("record"), "country", *STAMPS, *[F.col(f"`{s}`").alias(n) for n, s in FLAT.items()])
    return named.select("eid", "ok", "route", "reject_reason", "record", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ["country", *STAMPS, *FLAT]])


@query("login_clean", LOGIN_CLEAN_SQL)
def login_clean(spark, sf):
    d = i.dims(spark, sf)
    out = logins.agency_logins(i.old_login_lines(spark, sf, wrapped=True), d, i.regions(spark, sf), d.special, "eid", rules=LOGIN_RULES,
                               state=i.stored_state(spark, sf))
    return login_columns(out)


def names_of(*groups):
    """Names of a record's fields in order, as one text."""
    return ",".join(sorted(n for g in groups for n in g.split()))


def opened(out):
    """Fields of the outgoing record as texts; the record is read once, whatever is taken from it."""
    return out.withColumn("_fields", F.from_json("value", "map<string,string>"))


def record_fields(**paths):
    """Names of all fields of an opened record, and the text of some."""
    keys = F.when(F.col("reject_reason").isNull(), F.map_keys("_fields"))
    return [F.array_join(F.sort_array(keys), ",").alias("names"),
            *[F.col("_fields")[p].alias(n) for n, p in paths.items()]]


OWN_LOGIN = f"""ol AS (SELECT ev.*, coalesce(b.game_id, 'error') AS jg, coalesce(b.channel_id, 'error') AS channel_id, coalesce(b.game_channel_id, 'error') AS game_channel_id,
  coalesce(c.company_id, 'error') AS company_id FROM ev LEFT JOIN belong b ON b.belong_game_id = {GID} LEFT JOIN company c ON c.game_id = b.game_id),
om AS (SELECT *, et = 'view' AND k <> 33 AND k >= 10 AND k <> 50 AND uid % 80 <> 11 AND game_channel_id IN {SPECIAL} AS ok FROM ol),
on1 AS (SELECT *, CASE WHEN ok AND game_channel_id NOT IN ('', 'error') THEN uid || '_' || game_channel_id END AS key FROM om),
on2 AS (SELECT *, CASE WHEN key IS NOT NULL THEN min(CASE WHEN k <> 77 THEN sts END) OVER (PARTITION BY key ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS login_ts,
  CAST(NULL AS BIGINT) AS order_ts FROM on1)"""


SERVICE_FIELDS = """agent-access_token agent-channel_id agent-game_channel_id channel_platform-ad_id city client_ip client_time_zone client_ts country data_ver device-android_imei
  device-device_id device-device_name device-os_ver device-package_name device-screen_height device-screen_width device-sdk_ver event ext-a ext-list first_order_date game-game_id game-game_ver
  is_test province reg_date role-role_id role-role_name role-role_server sdk_platform-app_id server_date_day server_date_hour server_date_minute server_time_zone server_ts tags user-user_id user-user_name"""


OWN_NAMES = f"""'{names_of(SERVICE_FIELDS, "game-app_id game-company_id game-game_name")}'"""


@query("own_login_clean", w(EV, DIMS, OWN_LOGIN) + f"""SELECT eid, ok, CASE WHEN ok THEN 'agentLogin' ELSE 'ownLoginFilter' END AS route, {ok_only('channel_id', 'game_channel_id', 'company_id', 'game_id', 'app_id', 'reg_date')},
  CASE WHEN ok THEN {OWN_NAMES} END AS names, CASE WHEN ok THEN CAST(k % 7 AS VARCHAR) END AS ext_a, CASE WHEN ok THEN channel_id END AS rec_channel, CASE WHEN ok THEN reg_date END AS rec_reg,
  CASE WHEN et = 'error' THEN 'json parse error' WHEN k = 33 THEN '1.Error value in common column may be null.' WHEN et <> 'error' AND ({FIRST}) IS NOT NULL AND et = 'view' THEN 'Error value in ' || ({FIRST}) || ' column may be null.'
   WHEN et <> 'view' THEN 'not a login' WHEN uid % 80 = 11 THEN 'web pay game' WHEN NOT ok THEN 'outside the special set' END AS reject_reason
  FROM (SELECT *, jg AS game_id, {GID} AS app_id, {stamped_sql('sts', "'login'", 'login_ts', 'order_ts')} FROM on2)""")
def own_login_clean(spark, sf):
    """New-format logins of an own channel, folded into the agency destination."""
    d = i.dims(spark, sf)
    out = logins.own_logins(i.event_lines(spark, sf), d, i.regions(spark, sf), d.special, "eid", rules=rl.DEFAULT_RULES, source="ownLoginSrc",
                            folded_into="agentLogin", wrapped=False, aliases={})
    named = opened(out).select("eid", "ok", "route", "reg_date", F.col("agent-channel_id").alias("channel_id"), F.col("agent-game_channel_id").alias("game_channel_id"),
                       F.col("game-company_id").alias("company_id"), F.col("game-game_id").alias("game_id"), F.col("game-app_id").alias("app_id"),
                       "reject_reason", *record_fields(ext_a="ext-a", rec_channel="agent-channel_id", rec_reg="reg_date"))
    shown = [c for c in named.columns if c not in ("eid", "ok", "route", "reject_reason")]
    return named.select("eid", "ok", "route", "reject_reason", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in shown])


CLEAN = f"(et <> 'error' AND k <> 33 AND ({FIRST}) IS NULL"
# no state is written by these services: stored history only
NO_STATE = "CAST(NULL AS BIGINT) AS login_ts, CAST(NULL AS BIGINT) AS order_ts"
def service_names(extra="", order_extra=""):
    """Names of the flattened record by event; a missing game name or order leaves its fields out."""
    order = "order-currency_amount order-order_sn order-order_status order-order_step order-order_type " + order_extra
    named = lambda *g: f"'{names_of(SERVICE_FIELDS, extra, *g)}'"
    return (f"CASE WHEN kind = 'order' THEN {named(order, 'game-game_name')} WHEN kind = 'click' THEN {named('click-click_time click-event_tag', 'game-game_name')} "
            f"WHEN k = 50 THEN {named()} ELSE {named('game-game_name')} END")


@query("service_clean_agent", w(EV, DIMS, REGIONS, LOGIN_SQL, f"""sa AS (SELECT lr.*, et = 'purchase' AS active, et NOT IN ('error', 'purchase') AND NOT (uid % 97 + 1 >= 63 AND g0 = '') AND channel_id NOT IN ('6001', '10081') AS ok FROM lr),
sb AS (SELECT *, CASE WHEN ok THEN channel_id || '_' || game || '_' || uid END AS key FROM sa),
sc AS (SELECT *, CASE WHEN key IS NOT NULL THEN min(CASE WHEN t >= 1000000000 THEN t END) OVER (PARTITION BY key ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS login_ts, CAST(NULL AS BIGINT) AS order_ts FROM sb),
sd AS (SELECT sc.*, coalesce(b.country, '') AS country FROM sc ASOF LEFT JOIN bounds b ON sc.ipn <= b.ip_hi)""")
       + f"""SELECT eid, ok, CASE WHEN active THEN 'agentActive' WHEN NOT ok THEN 'agentError' WHEN game_channel_id IN {SPECIAL} THEN 'agentStdOther' ELSE 'agentStd' END AS route,
  CASE WHEN active OR ok THEN NULL WHEN et = 'error' THEN 'bad frame' WHEN uid % 97 + 1 >= 63 AND g0 = '' THEN 'game channel missing' ELSE 'service check' END AS reject_reason,
  {ok_only('first_order_date', 'reg_date', 'channel_id', 'country')}, active AS as_it_came FROM (SELECT *, {stamped_sql('t', "'login'", 'login_ts', 'order_ts')} FROM sd)""")
def service_clean_agent(spark, sf):
    """Old-format agency logins; activation lines go on as they came."""
    d = i.dims(spark, sf)
    out = logins.service_events(i.mixed_agency_lines(spark, sf), d, i.regions(spark, sf), d.special, "eid", service="agent", rules=LOGIN_RULES)
    field = lambda n: F.get_json_object("value", f"$['{n}']")
    named = out.select("eid", "ok", "route", "reject_reason", "first_order_date", "reg_date", field("agent-channel_id").alias("channel_id"), field("country").alias("country"),
                       (F.col("value").endswith("ACTIVE_LOG[{}]")).alias("as_it_came"))
    return named.select("eid", "ok", "route", "reject_reason", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("first_order_date", "reg_date", "channel_id", "country")], "as_it_came")


@query("service_clean_sdk", w(EV, DIMS, f"se AS (SELECT *, {CLEAN} AND k % 9 <> 0 AND k <> 44) AS ok, {NO_STATE} FROM ev)") + f"""SELECT eid, ok, CASE WHEN ok THEN 'sdkStd' ELSE 'sdkError' END AS route,
  {ok_only('first_order_date', 'reg_date')}, CASE WHEN ok THEN {service_names()} END AS names, CASE WHEN ok THEN CAST(k % 7 AS VARCHAR) END AS ext_a, CASE WHEN ok THEN '["x","y"]' END AS tags,
  CASE WHEN ok THEN reg_date END AS rec_reg FROM (SELECT *, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se)""")
def service_clean_sdk(spark, sf):
    """Lines without a frame; the service writes no state, so only stored history would show."""
    d = i.dims(spark, sf)
    out = logins.service_events(i.bare_event_lines(spark, sf), d, i.regions(spark, sf), d.special, "eid", service="sdk")
    return opened(out).select("eid", "ok", "route", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("first_order_date", "reg_date")],
                      *record_fields(ext_a="ext-a", tags="tags", rec_reg="reg_date"))


def own_service_sql(service, belong, ok, target, key, amounts=True):
    base = running("k < 55", key=f"CASE WHEN {ok} THEN {key} END").replace("FROM ev)", f"FROM evb)")
    joined = f"""evb AS (SELECT ev.*, coalesce(b.game_id, 'error') AS jg, coalesce(b.channel_id, 'error') AS jch, coalesce(b.game_channel_id, 'error') AS jgc FROM ev LEFT JOIN {belong} b ON b.belong_game_id = {GID})"""
    cny = "CASE WHEN ok AND kind = 'order' THEN val::DOUBLE END" if amounts else "CAST(NULL AS DOUBLE)"
    names = service_names("game-app_id game-company_id", "order-cny_amount order-usd_amount" if amounts else "")
    return w(EV, DIMS, joined, base) + f"""SELECT eid, ok, {target} AS route, {ok_only('first_order_date', 'reg_date')}, CASE WHEN ok THEN jg END AS game_id,
  CASE WHEN ok THEN {GID} END AS app_id, {cny} AS cny, CASE WHEN ok THEN {names} END AS names, CASE WHEN ok THEN CAST(k % 7 AS VARCHAR) END AS ext_a, CASE WHEN ok THEN jch END AS channel_id
  FROM (SELECT *, {ok} AS ok, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se) x"""


OWN_OK = f"{CLEAN} AND k <> 30 AND uid % 80 <> 11)"


def own_service(spark, sf, d, **options):
    out = logins.service_events(i.event_lines(spark, sf), d, i.regions(spark, sf), d.special, "eid", aliases={}, **options)
    field = lambda n: F.col("_fields")[n]
    named = opened(out).select("eid", "ok", "route", "first_order_date", "reg_date", field("game-game_id").alias("game_id"), field("game-app_id").alias("app_id"),
                       F.when(F.col("event") == "order", field("order-cny_amount").cast("double")).alias("cny"), *record_fields(ext_a="ext-a", channel_id="agent-channel_id"))
    return named.select("eid", "ok", "route", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in named.columns[3:]])


@query("service_clean_own", own_service_sql("overseas", "belong_overseas", OWN_OK, "CASE WHEN ok THEN 'overseasStd' ELSE 'overseasError' END", "jg || '_' || uid_or_device".replace("uid_or_device", "CASE WHEN kind = 'active' THEN device ELSE CAST(uid AS VARCHAR) END")))
def service_clean_own(spark, sf):
    """Overseas own channel: game and app change places, orders without a known currency count one to one."""
    return own_service(spark, sf, i.dims(spark, sf, platforms=("4", "5")), service="overseas", overseas=True)


@query("service_clean_domestic", own_service_sql("domestic", "belong", OWN_OK, "CASE WHEN ok THEN 'agentStd' ELSE 'domesticError' END", "jch || '_' || jg || '_' || CAST(uid AS VARCHAR)", amounts=False))
def service_clean_domestic(spark, sf):
    """Domestic own channel: folded into the agency, whose key it shares."""
    return own_service(spark, sf, i.dims(spark, sf), service="domestic", folded={"domestic": "agent"})


RAW_ORDER = "order_sn game_id channel_id user_id server money pay_status status create_ip update_time create_time ext note"
REGION, DATES = "country province city", " ".join(STAMPS)
JOINED = "game_channel_id os_type company_id server_ts event is_test"
TEST_SERVER = """EXISTS (SELECT 1 FROM test_rule r WHERE r.game_id = g AND (server IN (CAST(n AS VARCHAR), CAST(n + 100 AS VARCHAR)) OR TRY_CAST(server AS INTEGER) BETWEEN 200 + n AND 260 + n))"""
EXT = """'{"a":' || (oid % 7) || ',"list":[1,2]}'"""
ORDER_CLEAN = f"""op AS (SELECT oc.*, 0 AS row_no, CASE WHEN oid % 37 = 5 THEN 'broken' ELSE 'order' END AS kind FROM oc UNION ALL SELECT oc.*, 1, 'copy' FROM oc WHERE pr = '4-NOT SPECIFIED' AND oid % 37 <> 5),
oq AS (SELECT op.*, CASE WHEN kind = 'broken' THEN 'agentDBError' WHEN kind = 'copy' THEN 'agentDBCopy' WHEN {TEST_SERVER} THEN 'agentDBTest' WHEN game_channel_id IN {SPECIAL} THEN 'agentDBOther' ELSE 'agentDB' END AS route FROM op),
orr AS (SELECT *, CASE WHEN route = 'agentDB' AND game_channel_id <> 'error' THEN uid || '_' || game_channel_id END AS key, CASE WHEN kind <> 'broken' THEN ipn END AS ipk FROM oq),
os1 AS (SELECT *, CASE WHEN key IS NOT NULL THEN min(CASE WHEN pay = 1 AND step = 2 THEN t END) OVER (PARTITION BY key ORDER BY oid, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS order_ts,
  CAST(NULL AS BIGINT) AS login_ts FROM orr),
os2 AS (SELECT os1.*, coalesce(b.country, '') AS country FROM os1 ASOF LEFT JOIN bounds b ON os1.ipk <= b.ip_hi),
os3 AS (SELECT *, {stamped_sql('t', "'order'", 'login_ts', 'order_ts')} FROM os2)"""


def only(flag, *names):
    return ", ".join(f"CASE WHEN {flag} THEN {n} END AS {n}" for n in names)


ORDER_KEYS = f"""CASE WHEN kind = 'copy' THEN '{names_of(RAW_ORDER, REGION)}' WHEN route = 'agentDB' THEN '{names_of(RAW_ORDER, REGION, JOINED, DATES)}' WHEN kind = 'order' THEN '{names_of(RAW_ORDER, REGION, JOINED)}' END"""


@query("order_clean", w(OD, DIMS, REGIONS, ORDER_SQL, ORDER_CLEAN) + f"""SELECT oid, row_no, route, CASE kind WHEN 'broken' THEN 'json parse error' END AS reject_reason,
  CASE kind WHEN 'copy' THEN c WHEN 'order' THEN channel_id END AS channel_id, {only("kind = 'order'", 'game_channel_id', 'os_type', 'company_id')}, country, {only("route = 'agentDB'", *STAMPS)},
  {ORDER_KEYS} AS names, CASE WHEN kind <> 'broken' THEN {EXT} END AS ext, CASE kind WHEN 'copy' THEN c WHEN 'order' THEN channel_id END AS rec_channel,
  CASE kind WHEN 'copy' THEN CAST(t * 1000 AS VARCHAR) WHEN 'order' THEN CAST(t AS VARCHAR) END AS rec_update, CASE WHEN route = 'agentDB' THEN first_order_date END AS rec_first FROM os3""")
def order_clean(spark, sf):
    d = i.dims(spark, sf)
    out = orders.agency_orders(i.agency_order_lines(spark, sf, wrapped=True), d, i.regions(spark, sf), d.special, packed_test_rules(i.test_rules(spark, sf)), "oid")
    return opened(out).select("oid", "row_no", "route", "reject_reason", "channel_id", "game_channel_id", "os_type", "company_id", "country", *STAMPS,
                      *record_fields(ext="ext", rec_channel="channel_id", rec_update="update_time", rec_first="first_order_date"))


ORDER_ROUTES = tuple("agentDB" + end for end in ("", "Copy", "Test", "Other", "Filter", "Error"))


@query("order_clean_totals", w(OD, DIMS, REGIONS, ORDER_SQL, ORDER_CLEAN) + """SELECT 'agentDBSrc' AS source, coalesce(route, '') AS destination, count(*) AS value FROM os3 GROUP BY ROLLUP (route)""")
def order_clean_totals(spark, sf):
    """Rows per destination of the order clean, counted by the pass that writes them."""
    d = i.dims(spark, sf)
    out = orders.agency_orders(i.agency_order_lines(spark, sf, wrapped=True), d, i.regions(spark, sf), d.special, packed_test_rules(i.test_rules(spark, sf)), "oid")
    run = Outputs(fresh_path(spark, "order-run"))
    run.write({"orders": out.select("oid", "row_no", "route", "value")}, 1, {"orders": ORDER_ROUTES})
    return run.counts(spark, "agentDBSrc")


FAR, APART = 2 ** 47, 44  # the first number; bits between the numbers of the three groups of lines
LINE_KEYS = 2 ** 12  # order keys of one line


def wide_items(spark, sf, keys=LINE_KEYS):
    """Line items with the number of their line: one line per group and `keys` order keys, numbered by the first of them."""
    li = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    group = F.when(F.col("l_linenumber") == 1, 0).otherwise(F.col("l_orderkey") % 2 + 1).cast("long")
    return li.withColumn("line_no", F.lit(FAR) + F.shiftleft(group, APART) + F.col("l_orderkey") - F.col("l_orderkey") % keys)


def wide_lines(spark, sf, keys=LINE_KEYS):
    """Envelopes with an order row per line item, three groups of lines of the same users, numbered from 2 ** 47 on."""
    data = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_sn"), F.lit(70).alias("game_id"), F.lit(5000).alias("channel_id"),
                    (F.col("l_suppkey") % 50).alias("user_id"), F.lit("x").alias("server"), F.lit(1).alias("pay_status"), F.lit(2).alias("status"), F.lit("").alias("create_ip"),
                    ((800000000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000).alias("update_time"))
    row = F.struct(F.lit("agent_order").alias("table"), data.alias("data"))
    return wide_items(spark, sf, keys).groupBy("line_no").agg(F.to_json(F.struct(F.sort_array(F.collect_list(row)).alias("rows"))).alias("value"))


def rows_before(spark, sf, keys=LINE_KEYS):
    """Per line the rows of its group in the lines before it: a sum over blocks of lines, then one inside each block."""
    lines = wide_items(spark, sf, keys).groupBy("line_no").agg(F.count("*").alias("n")).withColumns(
        {"group": F.shiftright(F.col("line_no") - FAR, APART), "block": F.shiftright("line_no", 30)})
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("group", "block").agg(F.sum("n").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(earlier("group", "block")), F.lit(0)).alias("blocks_before"))
    within = F.coalesce(F.sum("n").over(earlier("block", "line_no")), F.lit(0))
    return lines.withColumn("within", within).join(blocks, "block").select("line_no", "group", (F.col("within") + F.col("blocks_before")).alias("before"))


@query("order_clean_wide_line", w(DIMS, f"""rw AS (SELECT {FAR}::BIGINT + CASE WHEN l_linenumber = 1 THEN 0 ELSE l_orderkey % 2 + 1 END AS line_no, l_orderkey * 10 + l_linenumber AS sn, l_suppkey % 50 AS uid FROM lineitem),
rn AS (SELECT *, row_number() OVER (PARTITION BY line_no ORDER BY sn, uid) - 1 AS row_no, 800000000 + sn AS t FROM rw),
rs AS (SELECT *, min(t) OVER (PARTITION BY uid ORDER BY line_no, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist FROM rn)""")
       + f"""SELECT line_no, CAST(row_no AS INTEGER) AS row_no, CAST(sn AS VARCHAR) AS order_sn, CASE WHEN '5000' IN {SPECIAL} THEN NULL WHEN hist IS NULL OR hist > t THEN {day('t')} ELSE {day('hist')} END AS first_order_date FROM rs""")
def order_clean_wide_line(spark, sf, keys=LINE_KEYS):
    """Lines with many rows and very large arrival numbers keep their order; rows are numbered through the lines of a group."""
    d = i.dims(spark, sf)
    out = orders.agency_orders(wide_lines(spark, sf, keys), d, i.regions(spark, sf), d.special, packed_test_rules(i.test_rules(spark, sf)), "line_no", wrapped=False)
    return out.join(rows_before(spark, sf, keys), "line_no").select(
        (F.lit(FAR) + F.col("group")).alias("line_no"), (F.col("row_no") + F.col("before")).cast("int").alias("row_no"), "order_sn", "first_order_date")


OWN_ORDER = f"""oo AS (SELECT ok.*, coalesce(cny, 1.0) * money AS cny_amount, coalesce(usd, 1.0) * money AS usd_amount, CASE WHEN jgc <> 'error' THEN uid || '_' || jgc END AS key
  FROM ok LEFT JOIN rate ON cur = currency WHERE tab = 'order' AND oid % 41 <> 5),
op1 AS (SELECT *, CASE WHEN key IS NOT NULL THEN min(CASE WHEN pay = 1 AND step = 2 THEN t END) OVER (PARTITION BY key ORDER BY oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS order_ts,
  CAST(NULL AS BIGINT) AS login_ts FROM oo)"""


@query("own_order_clean", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong_overseas"), OWN_ORDER) + f"""SELECT oid, 'ownDB' AS route, NULL AS reject_reason, jg AS game_id, cny_amount, usd_amount, first_order_date, reg_date,
  first_order_date AS rec_first, CAST(oid AS VARCHAR) AS rec_sn, NULL AS nested, NULL AS line_len FROM (SELECT *, {stamped_sql('t', "'order'", 'login_ts', 'order_ts')} FROM op1)
  UNION ALL SELECT oid, 'ownDBFilter', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, tab || {EXT}, NULL FROM od WHERE tab <> 'order' AND oid % 41 <> 5
  UNION ALL SELECT oid, 'ownDBError', 'json parse error', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE FROM od WHERE oid % 41 = 5""")
def own_order_clean(spark, sf):
    """Overseas orders with both converted amounts; all other tables go to the filter, whole, under their name."""
    d = i.dims(spark, sf, platforms=("4", "5"))
    given = i.own_order_lines(spark, sf, broken=True)
    out = orders.own_orders(given, d, None, "oid", source="ownDBSrc", overseas=True, wrapped=False)
    inside = F.coalesce(*[F.concat(F.lit(t), F.get_json_object("value", f"$.{t}.ext")) for t in ("user", "order_side", "misc")])
    kept = F.when(F.col("route") == "ownDBError", F.col("value").startswith('{"rows":[{"database":"d"'))
    return out.select("oid", "route", "reject_reason", "game_id", "cny_amount", "usd_amount", "first_order_date", "reg_date",
                      F.get_json_object("value", "$.first_order_date").alias("rec_first"), F.get_json_object("value", "$.order_sn").alias("rec_sn"),
                      inside.alias("nested"), kept.alias("line_len"))


LATER = 600_000_000
DB_EVENTS = f"""side AS (SELECT od.*, coalesce(b.channel_id, 'error') AS jch, coalesce(b.game_id, 'error') AS jg, {OWNCH} AS jgc FROM od LEFT JOIN by_game_channel b ON b.game_channel_id = {OWNCH} WHERE tab = 'order_side'),
de AS (SELECT oid, uid, t + {LATER} AS t, pay, step, tab, jch, jg, jgc FROM ok WHERE tab IN ('order', 'user') UNION ALL SELECT oid, uid, t + {LATER}, pay, step, tab, jch, jg, jgc FROM side),
dg AS (SELECT *, CASE WHEN tab = 'user' THEN 'register' ELSE 'order' END AS event, CASE WHEN tab <> 'user' AND pay = 1 AND step = 2 THEN t END AS om FROM de WHERE oid % 41 <> 5)"""
DB_REST = f"""UNION ALL SELECT oid, 'others', NULL, NULL, {GID}, NULL, NULL, {EXT} FROM od WHERE tab = 'misc' AND oid % 41 <> 5 UNION ALL SELECT oid, 'rejects', 'json parse error', NULL, NULL, NULL, NULL, NULL FROM od WHERE oid % 41 = 5"""


def database_rows(out):
    """Whole fields of an event are under its group, those of another table as they came."""
    field = lambda n: F.get_json_object("value", f"$['{n}']")
    inside = lambda g, n: F.get_json_object("value", f"$.{g}.{n}")
    return out.select("oid", "route", "reject_reason", field("event").alias("event"), F.coalesce(field("game-game_id"), inside("game", "game_id"), field("game_id")).alias("game_id"),
                      field("first_order_date").alias("first_order_date"), field("reg_date").alias("reg_date"), field("ext").alias("ext"))


@query("channel_database", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong"), DB_EVENTS, """dh AS (SELECT *, CAST(NULL AS BIGINT) AS login_ts,
  min(om) OVER (PARTITION BY jg, uid ORDER BY oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS order_ts FROM dg)""")
       + f"""SELECT oid, CASE WHEN tab = 'order_side' THEN 'side_orders' ELSE 'orders' END AS route, NULL AS reject_reason, event, jg AS game_id,
  first_order_date, reg_date, NULL AS ext FROM (SELECT *, {stamped_sql('t', 'event', 'login_ts', 'order_ts')} FROM dh) {DB_REST}""")
def channel_database(spark, sf):
    """Overseas form: orders, side orders and registers of a user share one state; other tables as they are."""
    return database_rows(orders.channel_database(i.own_order_lines(spark, sf, broken=True, later=LATER), i.dims(spark, sf), None, "oid", service="overseas"))


def login_history(spark, sf):
    """Login state of agency users, under the keys that the login back-fill writes."""
    b, users = i.belong_rows(spark, sf), i.table(spark, sf, "customer").select("c_custkey")
    last = b.groupBy("belong_game_id").agg(F.max_by(F.struct("channel_id", "game_id"), "pos").alias("v"))
    pairs = users.join(last, F.col("belong_game_id") == (100000000 + F.col("c_custkey") % 80).cast("string"))
    return pairs.select(F.concat_ws("_", F.lit("agent"), "v.channel_id", "v.game_id", F.col("c_custkey").cast("string")).alias("key"),
                        (F.lit(1000000000) + F.col("c_custkey")).cast("bigint").alias("login_ts"), F.lit(None).cast("bigint").alias("order_ts"))


@query("channel_database_domestic", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong"), DB_EVENTS, f"""dh AS (SELECT *, tab = 'user' OR (tab = 'order' AND jgc NOT IN {SPECIAL}) AS apart FROM dg),
hist AS (SELECT DISTINCT b.channel_id AS hch, b.game_id AS hg, c_custkey AS huid FROM customer JOIN belong b ON b.belong_game_id = CAST(100000000 + c_custkey % 80 AS VARCHAR)),
di AS (SELECT dh.*, 1000000000 + huid AS login_ts, min(CASE WHEN NOT apart THEN om END) OVER (PARTITION BY jch, jg, uid ORDER BY oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS order_ts
  FROM dh LEFT JOIN hist ON hch = jch AND hg = jg AND huid = uid)""")
       + f"""SELECT oid, CASE WHEN apart THEN 'others' WHEN tab = 'order_side' THEN 'side_orders' ELSE 'orders' END AS route, NULL AS reject_reason, event, jg AS game_id,
  CASE WHEN NOT apart THEN first_order_date END AS first_order_date, CASE WHEN NOT apart THEN reg_date END AS reg_date, NULL AS ext FROM (SELECT *, {stamped_sql('t', 'event', 'login_ts', 'order_ts')} FROM di) {DB_REST}""")
def channel_database_domestic(spark, sf):
    """Domestic form: the key is the agency's, so the login history of agency logins is found; registers go to the others."""
    d = i.dims(spark, sf)
    out = orders.channel_database(i.own_order_lines(spark, sf, broken=True, later=LATER), d, d.special, "oid", service="domestic", state=login_history(spark, sf))
    return database_rows(out)


JOIN_SQL = f"""aj AS (SELECT oc.*, min(CASE WHEN pay = 1 AND step = 2 THEN t END) OVER (PARTITION BY channel_id, game, uid ORDER BY oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist FROM oc WHERE oid % 37 <> 5),
ak AS (SELECT *, CASE WHEN uid % 3 = 0 THEN 600000000 + uid END AS login, CASE WHEN {TEST_SERVER} THEN 'jobTest' WHEN game_channel_id IN {SPECIAL} THEN 'jobOther' ELSE 'job' END AS route FROM aj),
cp AS (SELECT oid, t, ipn FROM od WHERE pr = '4-NOT SPECIFIED' AND oid % 37 <> 5)"""
FLAT_ORDER = RAW_ORDER.replace(" ext", " ext-a ext-list")


@query("agency_order_join", w(OD, DIMS, REGIONS, ORDER_SQL, JOIN_SQL) + f"""SELECT oid, route, NULL AS reject_reason, channel_id, CASE WHEN hist IS NULL OR hist > t THEN {day('t')} ELSE {day('hist')} END AS first_order_date, {day('t')} AS server_date_day, CAST(NULL AS VARCHAR) AS country,
  CASE WHEN login IS NULL THEN {day('t')} ELSE {day('login')} END AS reg_date, '{names_of(FLAT_ORDER, "game_channel_id sub_pf company_id", DATES)}' AS names, CAST(oid % 7 AS VARCHAR) AS ext_a, '[1,2]' AS ext_list, CAST(t AS VARCHAR) AS rec_update, os_type AS sub_pf FROM ak
  UNION ALL SELECT oid, 'jobCopy', NULL, NULL, NULL, {day('t')}, coalesce(b.country, ''), NULL, '{names_of(RAW_ORDER, REGION, "server_date_day")}', NULL, NULL, CAST(t * 1000 AS VARCHAR), NULL FROM cp ASOF LEFT JOIN bounds b ON cp.ipn <= b.ip_hi
  UNION ALL SELECT oid, 'jobError', 'json parse error', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM od WHERE oid % 37 = 5""")
def agency_order_join(spark, sf):
    """Stored logins are found under agent_channel_game_user; every user and channel has a state, 'error' ones too."""
    d = i.dims(spark, sf)
    keys = resolved_orders(spark, sf, d).where("uid % 3 = 0").select(F.concat_ws("_", F.lit("agent"), "channel_id", "g", F.col("uid").cast("string")).alias("key"),
                                                                     (600000000 + F.col("uid")).cast("bigint").alias("login_ts"), F.lit(None).cast("bigint").alias("order_ts")).distinct()
    out = orders.agency_order_join(i.agency_order_lines(spark, sf), d, i.regions(spark, sf), d.special, packed_test_rules(i.test_rules(spark, sf)), "oid", topic="job", state=keys)
    copied = F.col("route") == "jobCopy"
    return opened(out).select("oid", "route", "reject_reason", F.when(~copied, F.col("channel_id")).alias("channel_id"), F.when(~copied, F.col("first_order_date")).alias("first_order_date"), "server_date_day", "country",
                      "reg_date", *record_fields(ext_a="ext-a", ext_list="ext-list", rec_update="update_time", sub_pf="sub_pf"))


def resolved_orders(spark, sf, d):
    o = i.od(spark, sf).select("uid", F.col("game").cast("string").alias("g"), F.col("col").cast("string").alias("c"))
    return resolve.resolve_order(o, d, game_id=F.col("g"), column=F.col("c"))


ACTIVE_SQL = f"""ac AS (SELECT *, CASE et WHEN 'view' THEN ch WHEN 'signup' THEN sub ELSE CASE WHEN k = 5 THEN '0' ELSE gc END END AS given, uid % 97 + 1 < 63 AS small FROM ev),
ad AS (SELECT ac.*, et <> 'error' AND given <> '0' AS ok, coalesce(s.channel_id, given) AS eff, coalesce(b.channel_id, 'error') AS bch, coalesce(b.game_id, 'error') AS bg FROM ac
  LEFT JOIN sub_channel s ON s.sub_channel_id = given LEFT JOIN by_game_channel b ON b.game_channel_id = given),
ae AS (SELECT *, CASE WHEN small THEN eff ELSE bch END AS channel_id, CASE WHEN small THEN game ELSE bg END AS game_id FROM ad),
af AS (SELECT *, CASE WHEN ok THEN channel_id || '_' || game_id || '_' || device END AS key FROM ae)"""


@query("activations", w(EV, DIMS, ACTIVE_SQL) + """SELECT eid, ok, CASE WHEN ok THEN channel_id END AS channel_id, CASE WHEN ok THEN game_id END AS game_id, CASE WHEN ok THEN device END AS device_id,
  CASE WHEN ok THEN CASE WHEN coalesce(min(sts) OVER (PARTITION BY key ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), sts) >= sts THEN 1 ELSE 0 END END AS new_device FROM af""")
def activations(spark, sf):
    out = feeds.activations(active_input(spark, sf), i.dims(spark, sf), "eid")
    return out.select("eid", "ok", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("channel_id", "game_id", "device_id", "new_device")])


@query("forward", w(EV, MSG_SQL) + """SELECT data_system AS topic, eid, n - 1 AS line_no, CASE WHEN n = 1 THEN 'line ' || eid ELSE 'value ' || k END AS value FROM msg, (VALUES (1), (2)) AS r(n) WHERE data_system <> ''""")
def forward(spark, sf):
    coded = messages.envelope_encode(i.messages(spark, sf)).select("eid", "body")
    return feeds.forward(coded, lz4=False).select("topic", "eid", "line_no", "value")


AD_JOB = """counted AS (SELECT *, CASE company_id WHEN '1' THEN 'a' WHEN '5' THEN 'b' END AS target FROM clicks WHERE reason IS NULL AND cgame LIKE 'U%'),
stored AS (SELECT 'company_id_' || company_id || '_api_click_detail_' || cgame || '_' || x AS key, eid, CASE WHEN et = 'purchase' THEN sts ELSE t END AS moment FROM clicks, (VALUES (0), (1)) AS r(n),
  LATERAL (SELECT CASE WHEN n = 0 THEN ip ELSE cdev END AS x) WHERE reason IS NULL AND (n = 0 OR cdev <> ''))"""


AD_CLICK_JOB_SQL = w(EV, CLICK_SQL, AD_JOB) + """SELECT 'topic' AS part, eid, target AS a, click_time AS b, NULL AS n FROM counted WHERE target IS NOT NULL
  UNION ALL SELECT 'detail', eid, company_id, click_time, CASE WHEN channel <> '' THEN 1 ELSE 0 END FROM clicks WHERE reason IS NULL
  UNION ALL SELECT 'keys', max(eid), key, NULL, arg_max(moment, eid) + 259200 FROM stored GROUP BY key HAVING arg_max(moment, eid) + 259200 > 1706140800
  UNION ALL SELECT 'counts', NULL, target || CASE WHEN ad0 = '' THEN '0' ELSE ad0 END || cgame || channel, substr(click_time, 1, 16), count(*) FROM counted WHERE target IS NOT NULL GROUP BY target, ad0, cgame, channel, pf, substr(click_time, 1, 16)
  UNION ALL SELECT 'rejects', eid, reason, NULL, NULL FROM clicks WHERE reason IS NOT NULL"""


def click_rows(out):
    eid, none, number = F.col("eid"), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    minute = F.concat(F.regexp_replace(F.col("click_date").cast("string"), "(....)(..)(..)", "$1-$2-$3"), F.format_string(" %02d:%02d", "click_hour", "click_minute"))
    parts = {"topic": (eid, F.col("target"), F.col("click_time"), number), "detail": (eid, F.col("company_id"), F.col("click_time"), F.col("ok").cast("bigint")),
             "keys": (F.col("value"), F.col("key"), none, F.col("expires_at")), "rejects": (eid, F.col("info"), none, number)}
    rows = [out[p].select(F.lit(p).alias("part"), *[c.alias(n) for n, c in zip(("eid", "a", "b", "n"), cols)]) for p, cols in parts.items()]
    counts = out["counts"].select(F.lit("counts").alias("part"), number.alias("eid"), F.concat("target", F.col("ad_id").cast("string"), "game", "channel").alias("a"), minute.alias("b"), F.col("click_cnt").cast("bigint").alias("n"))
    done = counts
    for r in rows:
        done = done.unionByName(r)
    return done


@query("ad_click_job", AD_CLICK_JOB_SQL)
def ad_click_job(spark, sf):
    """Every output of the click job, row by row."""
    return click_rows(feeds.ad_click_job(i.click_lines(spark, sf).drop("t"), "eid", {"1": "a", "5": "b"}, now=F.lit(1706140800)))


@query("ad_click_run", AD_CLICK_JOB_SQL)
def ad_click_run(spark, sf):
    """The five outputs as readers find them: of whole runs only, the later attempt of a repeated one."""
    out = feeds.ad_click_job(i.click_lines(spark, sf).drop("t"), "eid", {"1": "a", "5": "b"}, now=F.lit(1706140800))
    run = Outputs(fresh_path(spark, "click-run"))
    run.write({name: rows.limit(5) for name, rows in out.items()}, 1)  # an earlier attempt of the run, replaced by the next
    run.write(out, 1)
    out["topic"].write.parquet(f"{run.path}/topic/run-2-broken")  # broke off before its other tables
    return click_rows({name: run.read(spark, name, rows.schema) for name, rows in out.items()})


@query("page_click_load", w(EV) + f"""SELECT event_tag, 'pkg_' || apk AS apk_name, CAST(replace(substr(m, 1, 10), '-', '') AS INTEGER) AS click_date, CAST(substr(m, 12, 2) AS INTEGER) AS click_hour, CAST(substr(m, 15, 2) AS INTEGER) AS click_minute, n::INTEGER AS click_cnt FROM
  (SELECT et AS event_tag, strftime(make_timestamp(({CLICKED} + 28800) * 1000000), '%Y-%m-%d %H:%M') AS m, uid % 6 AS apk, count(*) AS n FROM ev WHERE et <> 'error' GROUP BY ALL)""")
def page_click_load(spark, sf):
    return feeds.page_clicks(access_input(spark, sf)).select("event_tag", "apk_name", "click_date", "click_hour", "click_minute", "click_cnt")


@query("log_load", w(EV) + f"""SELECT 'login_log' AS "table", min(eid) AS eid, upper(md5(sts || {day('sts')} || {daykey('sts')} || uid || {UNAME} || {GID} || {AD} || device || ip || {PF})) AS id, NULL AS new_device FROM ev
  WHERE et = 'view' AND eid >= 500 GROUP BY ALL
  UNION ALL SELECT 'active_log', a.eid, a.id, CASE WHEN coalesce(prior, sts) >= sts THEN 1 ELSE 0 END FROM (SELECT *, upper(md5({GID} || device)) AS id, row_number() OVER (PARTITION BY {GID}, device ORDER BY eid) AS nth,
    min(sts) OVER (PARTITION BY {GID}, device ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM ev WHERE et = 'signup') a WHERE nth = 1 AND uid % 80 >= 5
  UNION ALL SELECT 'rejects', eid, 'json parse error', NULL FROM ev WHERE et = 'error'""")
def log_load(spark, sf):
    """Logins and activations of one log; ids that the tables already hold are not added again."""
    lines_in = i.event_lines(spark, sf, activations=True)
    known = loads.log_load(lines_in, "eid", stage=fresh_path(spark, "log_load"))
    game = F.concat(100000000 + F.col("uid") % 80)
    held = fresh_path(spark, "login_log")
    files.write_dated(known["login_log"].where("eid < 500").select("id", "login_date"), held, "login_date")
    stored = {"login_log": spark.read.schema("id string, login_date int").parquet(held),
              "active_log": i.ev(spark, sf).where("uid % 80 < 5").select(F.upper(F.md5(F.concat(game.cast("string"), "device"))).alias("id")).distinct()}
    out = loads.log_load(lines_in, "eid", stage=fresh_path(spark, "log_load"), stored=stored)
    none = F.lit(None).cast("int").alias("new_device")
    return (out["login_log"].select(F.lit("login_log").alias("table"), "eid", "id", none)
            .unionByName(out["active_log"].select(F.lit("active_log").alias("table"), "eid", "id", "new_device"))
            .unionByName(lines_rejects(out["rejects"])))


def lines_rejects(rejected):
    return rejected.select(F.lit("rejects").alias("table"), F.col("eid"), F.col("info").alias("id"), F.lit(None).cast("int").alias("new_device"))


@query("database_load", w(OD, f"""us AS (SELECT oid, {GID} AS game, 'dev-' || (uid % 40) AS device, t FROM od WHERE tab = 'user' AND oid % 2 = 0 AND oid % 41 <> 5)""")
       + """SELECT 'order_log' AS kind, oid, upper(md5(oid || '' || step || pay)) AS id, CAST(NULL AS INTEGER) AS new_device FROM od WHERE oid % 41 <> 5 AND tab = 'order' AND ((pay = 0 AND step = 1) OR (pay = 1 AND step = 2))
  UNION ALL SELECT 'user', us.oid, upper(md5(CAST(uid AS VARCHAR))), CASE WHEN coalesce(min(us.t) OVER (PARTITION BY us.game, us.device ORDER BY us.oid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), us.t) >= us.t THEN 1 ELSE 0 END
  FROM us JOIN od USING (oid) UNION ALL SELECT 'reject', oid, 'json parse error', NULL FROM od WHERE oid % 41 = 5""")
def database_load(spark, sf):
    out = loads.database_load(i.own_order_lines(spark, sf, broken=True), "oid", stage=fresh_path(spark, "database_load"))
    none = F.lit(None).cast("int").alias("new_device")
    return (out["order_log"].select(F.lit("order_log").alias("kind"), "oid", "id", none)
            .unionByName(out["user"].select(F.lit("user").alias("kind"), "oid", "id", "new_device"))
            .unionByName(out["rejects"].select(F.lit("reject").alias("kind"), "oid", F.col("info").alias("id"), none)))


COIN_OK = "game_id <> '' AND (own OR gch = '2050' OR num IS NOT NULL) AND 'error' NOT IN (game_id, channel_id, game_channel_id)"


@query("overseas_log_load", w(EV, DIMS) + f"""SELECT 'login_log' AS "table", eid, CAST(uid % 97 AS VARCHAR) AS what, NULL AS hours FROM ev WHERE et = 'view'
  UNION ALL SELECT 'af_active', eid, CAST(1 + p_partkey % 97 AS VARCHAR), NULL FROM ev LEFT JOIN part ON p_partkey = k * 30 WHERE et = 'signup'
  UNION ALL SELECT 'voided_order', eid, CAST(eid AS VARCHAR), NULL FROM ev WHERE et = 'purchase'
  UNION ALL SELECT 'refunds', eid, 'tok-' || eid, 3::BIGINT FROM ev, (VALUES (0), (1)) AS r(n) WHERE et = 'click'""")
def overseas_log_load(spark, sf):
    """One log with logins, installs, purchases and refund lists, each to its own table."""
    e = F.col
    kind = lambda name: e("et") == name
    entry = F.struct(F.concat(F.lit("tok-"), e("eid")).alias("purchaseToken"), (e("t") * 1000).alias("purchaseTimeMillis"),
                     (e("t") * 1000 + 3 * 3600000).alias("voidedTimeMillis"))
    doc = i.obj(event=F.when(kind("view"), F.lit("login")), user=F.struct((e("uid") % 97).cast("string").alias("user_id")), server_ts=e("sts"),
                event_type=F.when(kind("signup"), F.lit("install")), bundle_id=F.concat(F.lit("com.game.p"), e("k") * 30), install_time=i.stamp(),
                event_order=F.when(kind("purchase"), F.lit("event_order")), mToken=F.concat(F.lit("tok-"), e("eid")), mPurchaseTime=e("t") * 1000,
                order_id=e("eid").cast("string"), google_lf=F.when(kind("click"), F.lit("google_lf")), package_name="p",
                google_data=F.when(kind("click"), F.struct(F.array(entry, entry).alias("voidedPurchases"))))
    text = F.when(kind("error"), F.lit("DATA[{]")).otherwise(F.concat(F.lit("DATA["), doc, F.lit("]")))
    lines_in = i.once(i.ev(spark, sf), {"value": text}, ["eid"])
    out = loads.overseas_log_load(lines_in, i.dims(spark, sf), "eid", stage=fresh_path(spark, "overseas_log_load"))
    row = lambda name, what, hours=F.lit(None): out[name].select(F.lit(name).alias("table"), "eid", what.alias("what"), hours.cast("bigint").alias("hours"))
    installed = F.when(e("game_id").isNotNull() & (e("game_id") != ""), e("game_id").cast("string")) if "game_id" in out["af_active"].columns else e("game").cast("string")
    return (row("login_log", e("user_id")).unionByName(row("af_active", installed)).unionByName(row("voided_order", e("order_sn").cast("string")))
            .unionByName(row("refunds", e("purchase_token"), e("time_interval"))))


@query("coin_trades", w(EV, COIN_SQL, DIMS, COIN_RESOLVED) + f"""SELECT eid, 0 AS object_no, {COIN_OK} AS ok, game_id, channel_id, game_channel_id, strftime(make_timestamp((t + 28800) * 1000000), '%Y%m%d') AS trade_date FROM cr
  WHERE k <> 8 UNION ALL SELECT eid, 1, {COIN_OK}, game_id, channel_id, game_channel_id, strftime(make_timestamp((t + 28800) * 1000000), '%Y%m%d') FROM cr WHERE et = 'click' AND k NOT IN (8, 20)
  UNION ALL SELECT eid, 1, FALSE, NULL, NULL, NULL, NULL FROM cr WHERE et = 'click' AND k = 20 UNION ALL SELECT eid, NULL, FALSE, NULL, NULL, NULL, NULL FROM cr WHERE k = 8""")
def coin_trades(spark, sf):
    out = feeds.coin_trades(coin_json_input(spark, sf), i.dims(spark, sf))
    read = F.col("object").isNotNull() & F.coalesce(~F.col("reject_reason").isin("json parse error", "no tag"), F.lit(True))
    out = out.withColumns({c: F.when(read, F.col(c)) for c in ("game_id", "channel_id", "game_channel_id", "trade_date")})
    return out.select("eid", "object_no", "ok", "game_id", "channel_id", "game_channel_id", "trade_date")


@query("coin_export", w(EV, COIN_SQL, DIMS, COIN_RESOLVED) + f"""SELECT eid, k NOT IN (20, 21) AND {COIN_OK} AS ok, CASE WHEN k IN (20, 21) THEN 'not 14 fields' WHEN NOT ({COIN_OK}) THEN 'unresolved field' END AS reason,
  CASE WHEN k NOT IN (20, 21) THEN game_id END AS game_id, CASE WHEN k NOT IN (20, 21) THEN channel_id END AS channel_id FROM cr""")
def coin_export(spark, sf):
    out = feeds.coin_trades(coin_tsv_input(spark, sf), i.dims(spark, sf), tsv=True)
    read = F.coalesce(F.col("reject_reason") != "not 14 fields", F.lit(True))
    return out.select("eid", "ok", F.col("reject_reason").alias("reason"), F.when(read, F.col("game_id")).alias("game_id"), F.when(read, F.col("channel_id")).alias("channel_id"))


@query("sdk_events", SDK_SQL)
def sdk_events(spark, sf):
    out = feeds.sdk_events(sdk_input(spark, sf))
    return out.select("eid", "record_no", *[F.when(F.col("ok"), F.get_json_object("value", f"$.{k}")).alias(k) for k in SDK_KEYS], "reject_reason")


@query("sdk_flat", w(EV) + f"""SELECT eid, CAST(uid AS VARCHAR) AS "user-user_id", device AS "device-device_id", kind AS event, ip, t AS server_ts, {day('t')} AS server_date_day, CAST(NULL AS VARCHAR) AS reject_reason FROM ev WHERE et <> 'error'
  UNION ALL SELECT eid, NULL, NULL, NULL, ip, t, {day('t')}, 'json parse error' FROM ev WHERE et = 'error'""")
def sdk_flat(spark, sf):
    return feeds.sdk_flat(i.event_lines(spark, sf), ["user", "device"]).select("eid", "user-user_id", "device-device_id", "event", "ip", "server_ts", "server_date_day", "reject_reason")


@query("olap_feed", w(EV, OD) + f"""SELECT 'login' AS event, {day('t')} AS server_date_day, CAST(uid AS VARCHAR) AS user_id, game AS game_id, NULL AS cents FROM ev WHERE kind = 'login' AND k <> 77
  UNION ALL SELECT 'order', {day('t')}, CAST(uid AS VARCHAR), CAST(game AS VARCHAR), CAST(round(money * 100) AS BIGINT) FROM od WHERE pay = 1 AND step = 2""")
def olap_feed(spark, sf):
    o = i.od(spark, sf)
    t = F.col("t")
    paid = o.select(F.lit("order").alias("event"), F.lit("regular").alias("is_test"), F.col("pay").cast("string").alias("pay_status"), F.col("step").cast("string").alias("status"),
                    F.col("money").cast("string").alias("money"), times.day(t).alias("server_date_day"), times.hour(t).alias("server_date_hour"), F.lit("").alias("reg_date"),
                    F.lit("").alias("first_order_date"), F.col("game").alias("game_id"), F.lit("c").alias("channel_id"), F.lit("g").alias("game_channel_id"), F.lit("o").alias("os_type"), F.col("uid").alias("user_id"))
    feed = feeds.olap_feed(flat_logins(spark, sf), paid)
    return feed.select("event", "server_date_day", "user_id", "game_id", F.round(F.col("money") * 100).cast("bigint").alias("cents"))


OLD_SQL = f"""ba AS (SELECT *, uid % 97 >= 62 AS big, et IN ('signup', 'click') AS open, CASE WHEN uid % 97 >= 62 THEN gc WHEN et = 'signup' THEN sub ELSE ch END AS c0 FROM ev WHERE et <> 'error'),
bb AS (SELECT ba.*, coalesce(a.channel_id, 'error') AS by_gc, s.channel_id AS sub_ch, coalesce(s.channel_id, c0) AS eff, coalesce(o.game_channel_id, 'error') AS old_gc FROM ba
  LEFT JOIN channel_of a ON a.game_id = game AND a.game_channel_id = c0 LEFT JOIN sub_channel s ON s.sub_channel_id = c0 LEFT JOIN old_channel o ON o.channel_id = c0),
bc AS (SELECT bb.*, coalesce(r.game_channel_id, 'error') AS rev, CASE WHEN open THEN CASE WHEN big THEN by_gc ELSE eff END ELSE c0 END AS channel_id FROM bb LEFT JOIN game_channel_of r ON r.game_id = game AND r.channel_id = eff),
bd AS (SELECT bc.*, CASE WHEN open THEN CASE WHEN big THEN c0 WHEN sub_ch IS NULL THEN rev ELSE old_gc END ELSE gc END AS game_channel_id, CASE WHEN NOT open THEN 'h5'
  WHEN os.pf IN ('0', '4') THEN 'android' WHEN os.pf IS NULL THEN 'error' ELSE 'ios' END AS os_type FROM bc LEFT JOIN os ON os.channel_id = bc.channel_id),
be AS (SELECT *, min(sts) OVER (PARTITION BY channel_id, game, uid ORDER BY eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS login_ts, CAST(NULL AS BIGINT) AS order_ts FROM bd)"""


@query("old_logins", w(EV, DIMS, OLD_SQL) + f"""SELECT eid, channel_id, game_channel_id, os_type, reg_date FROM (SELECT *, {stamped_sql('sts', "'login'", 'login_ts', 'order_ts')} FROM be)""")
def old_logins(spark, sf):
    out = logins.old_logins(i.stored_login_lines(spark, sf), i.dims(spark, sf), i.regions(spark, sf), "eid")
    return out.select("eid", "channel_id", "game_channel_id", "os_type", "reg_date")


@query("replay", w(EV) + "SELECT 'again' AS topic, device || ' ' || eid AS value FROM ev")
def replay(spark, sf):
    path = fresh_path(spark, "replay")
    files.write_text(i.ev(spark, sf).select(F.concat_ws(" ", "device", "eid").alias("l")), "l", path)
    return feeds.replay(tables.text_scan(spark, path), "again")


@query("login_replay", LOGIN_CLEAN_SQL)
def login_replay(spark, sf):
    """Batch replay of logins from plain text with an arrival number: the rows of the stream job."""
    d = i.dims(spark, sf)
    out = logins.agency_logins(i.old_login_lines(spark, sf), d, i.regions(spark, sf), d.special, "eid", rules=LOGIN_RULES, state=i.stored_state(spark, sf),
                               wrapped=False, flag_only=True)
    return login_columns(out)


@query("order_replay", w(OD, DIMS, REGIONS, ORDER_SQL, ORDER_CLEAN.replace("pay = 1 AND step = 2", "pay = 1")) + f"""SELECT oid, row_no, route, {only("route = 'agentDB'", 'first_order_date', 'reg_date')} FROM os3""")
def order_replay(spark, sf):
    """Batch replay of orders: the pay flag alone makes a payment."""
    d = i.dims(spark, sf)
    out = orders.agency_orders(i.agency_order_lines(spark, sf), d, i.regions(spark, sf), d.special, packed_test_rules(i.test_rules(spark, sf)), "oid", wrapped=False, flag_only=True)
    return out.select("oid", "row_no", "route", "first_order_date", "reg_date")


@query("cohort_export", w(EV) + f"""SELECT {day('t')} AS reg_date, 'im' || uid AS android_imei FROM ev WHERE {day('t')} = {day('sts')} AND gc = '5007'""")
def cohort_export(spark, sf):
    """One folder per date."""
    path = fresh_path(spark, "cohort")
    users = i.ev(spark, sf).select(times.day(F.col("t")).alias("reg_date"), times.day(F.col("sts")).alias("server_date_day"), F.col("gc").alias("game_channel_id"),
                                   F.concat(F.lit("im"), "uid").alias("android_imei"))
    feeds.cohort_export(users, "5007", [f"2024-{m:02d}-{d:02d}" for m in (1, 2) for d in range(1, 32)], path)
    return spark.read.schema("android_imei string, reg_date string").parquet(path)


@query("database_load_batch", w(OD) + f"""SELECT oid, upper(md5(oid || '' || (CASE WHEN pay = 1 THEN 2 ELSE step END) || pay)) AS id, CASE WHEN pay = 1 THEN 2 ELSE step END AS status, money FROM od
  WHERE tab = 'order' AND ((pay = 0 AND step = 1) OR (pay = 1 AND step = 2))""")
def database_load_batch(spark, sf):
    """Export form: a paid order has status 2."""
    out = loads.database_load(i.own_order_lines(spark, sf), "oid", batch=True, stage=fresh_path(spark, "database_load"))
    return out["order_log"].select("oid", "id", "status", "money")


@query("database_load_overseas", w(OD, DIMS) + f"""SELECT 'order_log' AS kind, oid, upper(md5(oid || '' || step || pay || (t * 1000) || (t * 1000))) AS id, coalesce(cny, 1.0) * money AS money, coalesce(usd, 1.0) * money AS imf_money
  FROM od LEFT JOIN rate ON cur = currency WHERE tab = 'order' AND ((pay = 0 AND step = 1) OR (pay = 1 AND step = 2))
  UNION ALL SELECT 'user', oid, CAST(uid AS VARCHAR), NULL, NULL FROM od WHERE tab = 'user' AND oid % 2 = 0""")
def database_load_overseas(spark, sf):
    """Overseas form: both converted amounts; users as they register."""
    out = loads.database_load(i.own_order_lines(spark, sf), "oid", dims=i.dims(spark, sf), overseas=True, stage=fresh_path(spark, "database_load"))
    none = F.lit(None).cast("double")
    return (out["order_log"].select(F.lit("order_log").alias("kind"), "oid", "id", "money", "imf_money")
            .unionByName(out["user"].select(F.lit("user").alias("kind"), "oid", F.col("user_id").alias("id"), none.alias("money"), none.alias("imf_money"))))
