"""Game-log shaped inputs, made by Spark from the given tables row by row.

Every row of the source table takes part. ``workload.sql`` holds the same
definitions as SQL for the checks.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.functions import times
from playtrail.operators import geo, guards
from playtrail.operators.dims import Dims
from playtrail.operators.lookup import Dimension
from playtrail.operators.once import once

TASK_ROWS = 250_000


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; the frame is kept so that its footer is read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


@lru_cache(maxsize=64)
def spread(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table whose rows feed line parsing, dealt over all cores as a log of many files is: of TASK_ROWS at most."""
    rows = table(spark, sf, name)
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS)))


def ev(spark: SparkSession, sf: str) -> DataFrame:
    """events with the derived keys of a game log."""
    return ev_of(spread(spark, sf, "events"))


def ev_of(events: DataFrame) -> DataFrame:
    """The same for any frame of events, a stream included."""
    base = events.selectExpr(
        "event_id AS eid", "user_id AS uid", "event_type AS et", "value AS val",
        "cast(get_json_object(props, '$.k') AS int) AS k", "unix_timestamp(ts) AS t")
    return base.selectExpr(
        "*", "t - (eid * 7919) % 864000 AS sts", "uid % 97 + 97 * (eid % 2) AS s",
        "concat(1 + uid % 223, '.', eid % 256, '.', uid * 7 % 256, '.1') AS ip",
        "cast(1 + uid % 97 AS string) AS game", "concat('dev-', uid % 40) AS device",
        "CASE et WHEN 'view' THEN 'login' WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'register'"
        " WHEN 'click' THEN 'click' ELSE 'active' END AS kind").selectExpr(
        "*", "cast(5000 + s AS string) AS gc", "cast(1000 + s AS string) AS sub", "cast(eid % 25 AS string) AS ch")


def stamp(col: str = "t") -> F.Column:
    return times.render(F.col(col), times.FULL)


def frame(tag: str, payload, t: str = "t", ip: str = "ip"):
    return F.concat(F.lit("NORMAL: ["), stamp(t), F.lit("] CIP["), F.col(ip), F.lit(f"] {tag}["), payload, F.lit("]"))


def obj(**cols) -> F.Column:
    return F.to_json(F.struct(*[(c if isinstance(c, F.Column) else F.lit(c)).alias(n) for n, c in cols.items()]))


def wrap(line) -> F.Column:
    return F.to_json(F.struct(line.alias("message")))


def event_doc() -> F.Column:
    """New-format event: groups depend on the event, some required fields are empty or missing."""
    text = lambda c: F.col(c).cast("string")
    user = F.struct(text("uid").alias("user_id"),
                    F.when(F.col("k") >= 10, F.concat(F.lit("u"), text("uid"))).otherwise(F.lit("")).alias("user_name"))
    game = F.struct((100000000 + F.col("uid") % 80).cast("string").alias("game_id"),
                    F.when(F.col("k") != 50, F.lit("g")).alias("game_name"), F.lit("1.2").alias("game_ver"))
    agent = F.struct(F.lit("").alias("channel_id"), F.col("gc").alias("game_channel_id"), F.lit("tok").alias("access_token"))
    device = F.struct(F.lit("1920").alias("screen_height"), F.lit("1080").alias("screen_width"),
                      F.col("device").alias("device_id"), F.concat(F.lit("im"), text("uid")).alias("android_imei"),
                      F.lit("9").alias("os_ver"), F.lit("2.1").alias("sdk_ver"), F.lit("phone").alias("device_name"),
                      F.lit("pkg").alias("package_name"))
    role = F.struct(F.lit("r").alias("role_name"), text("k").alias("role_server"), text("uid").alias("role_id"))
    order = F.when(F.col("et") == "purchase", F.struct(
        text("eid").alias("order_sn"), F.col("val").alias("currency_amount"), F.lit("alipay").alias("order_type"),
        F.when(F.col("k") < 60, F.lit("success")).otherwise(F.lit("failure")).alias("order_status"),
        F.when(F.col("k") < 55, F.lit("paid_success")).otherwise(F.lit("create_order")).alias("order_step")))
    click = F.when(F.col("et") == "click", F.struct(F.lit("t").alias("event_tag"), (F.col("k") - 20).alias("click_time")))
    return F.to_json(F.struct(
        user.alias("user"), game.alias("game"), agent.alias("agent"), device.alias("device"), role.alias("role"),
        order.alias("order"), click.alias("click"),
        F.struct(F.when(F.col("k") == 30, F.lit("")).when(F.col("k") < 40, F.lit("appstore"))
                 .otherwise(F.lit("web")).alias("ad_id")).alias("channel_platform"),
        F.struct(F.when(F.col("k") % 9 != 0, text("k")).otherwise(F.lit("")).alias("app_id")).alias("sdk_platform"),
        F.col("kind").alias("event"), F.when(F.col("k") != 77, F.lit("regular")).otherwise(F.lit("test")).alias("is_test"),
        F.lit("1.0").alias("data_ver"), F.lit("+08:00").alias("client_time_zone"), F.lit(0).alias("client_ts"),
        F.when(F.col("k") != 33, F.lit("+08:00")).alias("server_time_zone"), F.col("sts").alias("server_ts"),
        F.col("ip").alias("client_ip"), ext("k").alias("ext"), F.array(F.lit("x"), F.lit("y")).alias("tags")))


def event_lines(spark: SparkSession, sf: str, activations: bool = False) -> DataFrame:
    """Framed event lines; error events are truncated JSON. ``activations``: registers are activations instead."""
    e = ev(spark, sf)
    if activations:
        e = e.withColumn("kind", F.when(F.col("et") == "signup", F.lit("active")).otherwise(F.col("kind")))
    doc = event_doc()
    body = F.when(F.col("et") == "error", F.substring(doc, F.lit(1), F.length(doc) - 5)).otherwise(doc)
    return once(e, {"value": frame("DATA", body)}, ["eid"])


def mixed_agency_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Agency lines: old-format logins, one kind of event as activation lines instead."""
    e = ev(spark, sf)
    good = frame("CONTENT", old_login_doc())
    line = (F.when(F.col("et") == "error", F.regexp_replace(good, r"\] CIP\[", " "))
            .when(F.col("et") == "purchase", frame("ACTIVE_LOG", F.lit("{}"))).otherwise(good))
    return once(e, {"value": line}, ["eid"])


def bare_event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Event lines without time and address, some without the tag."""
    doc = event_doc()
    body = F.when(F.col("et") == "error", F.substring(doc, F.lit(1), F.length(doc) - 5)).otherwise(doc)
    line = F.concat(F.when(F.col("k") == 44, F.lit("NOTE[")).otherwise(F.lit("DATA[")), body, F.lit("]"))
    return once(ev(spark, sf), {"value": line}, ["eid"])


def old_login_doc() -> F.Column:
    channel = (F.when(F.col("et") == "view", F.lit("")).when(F.col("et") == "signup", F.col("sub")).otherwise(F.col("ch")))
    game_channel = (F.when(F.col("et") == "signup", F.lit("")).when(F.col("et") == "click", F.lit("0"))
                    .otherwise(F.col("gc")))
    return obj(user_id=F.col("uid").cast("string"), channel_id=channel, game_id=F.col("game"), channel_name="x",
               game_channel_id=game_channel)


def old_login_lines(spark: SparkSession, sf: str, wrapped: bool = False) -> DataFrame:
    """Old-format logins in all channel forms; error events lose their address part."""
    return old_login_lines_of(ev(spark, sf), wrapped)


def old_login_lines_of(e: DataFrame, wrapped: bool = False) -> DataFrame:
    good = frame("CONTENT", old_login_doc())
    line = F.when(F.col("et") == "error", F.regexp_replace(good, r"\] CIP\[", " ")).otherwise(good)
    return once(e, {"value": wrap(line) if wrapped else line}, ["eid"])


def od(spark: SparkSession, sf: str) -> DataFrame:
    """orders with the derived keys of an order log."""
    return spread(spark, sf, "orders").selectExpr(
        "o_orderkey AS oid", "o_custkey AS uid", "o_orderstatus AS st", "o_totalprice AS money",
        "o_orderpriority AS pr", "o_custkey % 120 AS s",
        "unix_timestamp(o_orderdate) + o_orderkey % 86400 AS t").selectExpr(
        "*", "1 + s % 97 AS game", "CASE WHEN st = 'F' THEN 1 ELSE 0 END AS pay",
        "CASE st WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 4 END AS step", "concat('C', uid % 25) AS cur",
        "CASE WHEN pr = '5-LOW' THEN concat('x', oid % 400) ELSE cast(oid % 400 AS string) END AS server",
        "CASE WHEN pr = '1-URGENT' THEN '' ELSE concat(1 + uid % 223, '.', oid % 256, '.7.1') END AS ip").selectExpr(
        "*", "CASE WHEN game >= 63 THEN 5000 + s WHEN st = 'F' THEN 1000 + s ELSE oid % 25 END AS col")


def stored_login_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Login events as JSON lines of an old file; some without a game channel, some cut off."""
    e = ev(spark, sf)
    channel = (F.when(F.col("uid") % 97 >= 62, F.col("gc")).when(F.col("et") == "signup", F.col("sub")).otherwise(F.col("ch")))
    gc = F.when(F.col("et").isin("signup", "click"), F.lit("")).otherwise(F.col("gc"))
    doc = F.to_json(F.struct(
        F.struct(F.col("uid").cast("string").alias("user_id")).alias("user"), F.struct(F.col("game").alias("game_id")).alias("game"),
        F.struct(channel.alias("channel_id"), gc.alias("game_channel_id")).alias("agent"),
        F.struct(F.col("device").alias("device_id"), F.lit("h5").alias("os_type")).alias("device"),
        F.lit("login").alias("event"), F.lit("regular").alias("is_test"), F.col("sts").alias("server_ts"), F.col("ip").alias("client_ip")))
    return once(e, {"value": F.when(F.col("et") == "error", F.substring(doc, 1, 25)).otherwise(doc)}, ["eid"])


def ext(number: str) -> F.Column:
    """An object with an array that no job knows."""
    return F.struct((F.col(number) % 7).alias("a"), F.array(F.lit(1), F.lit(2)).alias("list"))


def wrap_some(line: F.Column, number: str, every: int, **kinds: str) -> F.Column:
    """Number fields of one line of ``every`` as some exports write them: an object that names the kind, and a text."""
    wrapped = line
    for name, kind in kinds.items():
        inner = '{"$numberLong":"$2"}' if kind == "$date" else '"$2"'
        wrapped = F.regexp_replace(wrapped, f'("{name}":)"?([0-9]+)"?', f'$1{{"\\{kind}":{inner}}}'.replace('{"$n', '{"\\$n'))
    return F.when(F.col(number) % every == 3, wrapped).otherwise(line)


def cut_some(line: F.Column, number: str, every: int) -> F.Column:
    """One line of ``every`` breaks off."""
    return F.when(F.col(number) % every == 5, F.substring(line, F.lit(1), F.length(line) - 7)).otherwise(line)


def agency_order_lines(spark: SparkSession, sf: str, wrapped: bool = False) -> DataFrame:
    """One change-data envelope per order: the order row and, for one priority, its copy. Some lines break off."""
    o = od(spark, sf)
    data = F.struct(F.col("oid").alias("order_sn"), F.col("game").alias("game_id"), F.col("col").alias("channel_id"),
                    F.col("uid").alias("user_id"), "server", "money", F.col("pay").alias("pay_status"),
                    F.col("step").alias("status"), F.col("ip").alias("create_ip"),
                    (F.col("t") * 1000).alias("update_time"), stamp().alias("create_time"), ext("oid").alias("ext"), F.lit("n").alias("note"))
    row = lambda name: F.struct(F.lit("d").alias("database"), F.lit(name).alias("table"), F.lit("INSERT").alias("type"),
                                data.alias("data"))
    rows = F.when(F.col("pr") == "4-NOT SPECIFIED", F.array(row("agent_order"), row("agent_order_copy"))) \
        .otherwise(F.array(row("agent_order")))
    plain = F.to_json(F.struct(F.lit("f").alias("binlogFilename"), F.col("oid").alias("xid"), rows.alias("rows")))
    line = cut_some(wrap_some(plain, "oid", 11, order_sn="$numberLong", a="$numberInt", update_time="$date"), "oid", 37)
    return once(o, {"value": wrap(line) if wrapped else line}, ["oid"])


def own_tables() -> F.Column:
    return (F.when(F.col("pr") == "1-URGENT", F.lit("user")).when(F.col("pr") == "2-HIGH", F.lit("order_side"))
            .when(F.col("pr") == "4-NOT SPECIFIED", F.lit("misc")).otherwise(F.lit("order")))


def own_order_lines(spark: SparkSession, sf: str, wrapped: bool = False, broken: bool = False, later: int = 0) -> DataFrame:
    """Own-channel change data: order, side order, user and other tables, texts as the exports give them.

    ``broken``: some lines break off; ``later`` moves the times of the rows.
    """
    text = lambda c: F.col(c).cast("string")
    o = od(spark, sf).withColumn("t", F.col("t") + later)
    data = F.struct(
        text("oid").alias("order_sn"), text("uid").alias("user_id"), "money", F.col("cur").alias("money_type"),
        F.lit("1").alias("type"), F.col("step").alias("status"), F.col("pay").alias("pay_status"),
        (100000000 + F.col("uid") % 80).cast("string").alias("game_id"),
        F.when(F.col("oid") % 5 == 0, F.lit("appstore")).otherwise((5000 + F.col("s")).cast("string")).alias("own_channel"),
        F.concat(F.lit("dev-"), F.col("uid") % 40).alias("device_id"), "server",
        (F.col("oid") % 24).cast("string").alias("pay_type"), F.concat(F.lit("cp"), text("oid")).alias("cp_trade_sn"),
        F.concat(F.lit("pt"), text("oid")).alias("payment_trade_sn"), F.lit("2").alias("goods_id"),
        F.lit("gem").alias("goods_name"), text("uid").alias("game_role_id"), F.lit("role").alias("game_role_name"),
        F.lit("http://h.example/p").alias("game_url"), stamp().alias("create_time"),
        (F.col("t") * 1000).alias("update_time"), F.col("ip").alias("create_ip"), F.lit("im").alias("imei"),
        F.concat(F.lit("u"), text("uid")).alias("user_name"), F.lit("1").alias("tel_num"), F.lit(0).alias("tel_status"),
        F.lit("e").alias("email"), F.lit(3).alias("reg_type"),
        (100000000 + F.col("uid") % 80).cast("string").alias("own_app_id"), F.col("ip").alias("register_ip"),
        F.col("t").alias("register_time"), (F.col("oid") % 3).cast("string").alias("sex"), F.lit("1990").alias("birth"),
        ext("oid").alias("ext"))
    row = F.struct(F.lit("d").alias("database"), own_tables().alias("table"),
                   F.when(F.col("oid") % 2 == 0, F.lit("INSERT")).otherwise(F.lit("UPDATE")).alias("type"),
                   data.alias("data"))
    line = F.to_json(F.struct(F.array(row).alias("rows")))
    line = cut_some(line, "oid", 41) if broken else line
    return once(o, {"value": wrap(line) if wrapped else line}, ["oid"])


def click_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ad click lines: games with and without counted prefix, some without company or numeric ad."""
    return click_lines_of(ev(spark, sf))


def click_lines_of(e: DataFrame) -> DataFrame:
    ad = F.when(F.col("k") == 11, F.lit("ad-x")).when(F.col("k") == 12, F.lit("")).otherwise((F.col("uid") % 9).cast("string"))
    doc = F.struct(ad.alias("adid"), F.concat(F.when(F.col("et") == "signup", F.lit("V")).otherwise(F.lit("U")),
                                              F.col("uid") % 5).alias("game"),
                   F.when(F.col("k") >= 20, F.concat(F.lit("c"), F.col("uid") % 3)).alias("channel"),
                   F.when(F.col("et") != "view", F.col("device")).alias("device_id"),
                   F.when(F.col("et") == "purchase", stamp("sts")).alias("click_time"),
                   F.when(F.col("k") != 13, F.when(F.col("uid") % 2 == 0, F.lit("1")).otherwise(F.lit("5")))
                   .alias("company_id"),
                   F.when(F.col("k") > 90, F.lit("1")).alias("pf"))
    body = F.when(F.col("et") == "error", F.regexp_replace(F.to_json(doc), "adid", '"bad')).otherwise(F.to_json(doc))
    return once(e, {"value": frame("AD_CLICK", body)}, ["eid", "t"])


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Two lines per message with the names of its envelope; offsets count per queue."""
    e = ev(spark, sf)
    return e.select(
        F.concat(F.lit("top-"), F.col("et")).alias("topic"), F.lit("b1").alias("broker"),
        (F.col("eid") % 4).cast("int").alias("queue_id"), F.floor(F.col("eid") / 4).cast("bigint").alias("queue_offset"),
        "eid", "t", "k",
        F.concat(F.lit("line "), F.col("eid"), F.lit("\nvalue "), F.col("k"),
                 F.when(F.col("et") == "click", F.lit("\n")).otherwise(F.lit(""))).cast("binary").alias("message_body"),
        F.when(F.col("et") == "error", F.lit("")).otherwise(F.concat(F.lit("sys-"), F.col("et"))).alias("data_system"),
        F.when(F.col("et") == "error", F.lit("")).otherwise(F.concat(F.lit("10.0.0."), F.col("uid") % 7)).alias("ip"),
        F.when(F.col("et") == "error", F.lit("")).otherwise(F.concat(F.lit("/log/"), F.col("k") % 3)).alias("file_path"),
        (2 + F.col("eid") % 3).cast("bigint").alias("line_count"))


# ---------------------------------------------------------------- dimensions

def game_channel_rows(spark, sf):
    return table(spark, sf, "supplier").selectExpr(
        "cast(1 + s_suppkey % 97 AS string) AS game_id", "cast(s_nationkey AS string) AS channel_id",
        "cast(5000 + s_suppkey AS string) AS game_channel_id", "s_suppkey AS pos")


def belong_rows(spark, sf):
    return table(spark, sf, "part").selectExpr(
        "cast(100000000 + p_partkey % 60 AS string) AS belong_game_id", "cast(7000 + p_partkey AS string) AS game_channel_id",
        "cast(p_size AS string) AS channel_id", "cast(1 + p_partkey % 97 AS string) AS game_id",
        "cast(p_partkey % 7 AS string) AS sub_pf", "p_partkey AS pos")


def special_rows(spark, sf):
    own = table(spark, sf, "supplier").where("s_acctbal > 3000").selectExpr("cast(5000 + s_suppkey AS string) AS game_channel_id")
    parts = table(spark, sf, "part").where("p_size > 25").selectExpr("cast(7000 + p_partkey AS string) AS game_channel_id")
    return own.unionByName(parts)


def rate_rows(spark, sf):
    n = table(spark, sf, "nation")
    cny = n.selectExpr("concat('C', n_nationkey) AS from_currency", "'CNY' AS to_currency",
                       "1 + n_nationkey / 10.0D AS exchange_rate", "n_nationkey AS pos")
    usd = n.where("n_regionkey > 0").selectExpr("concat('C', n_nationkey) AS from_currency", "'USD' AS to_currency",
                                                "0.1D + n_nationkey / 100.0D AS exchange_rate", "n_nationkey AS pos")
    return cny.unionByName(usd)


def dims(spark: SparkSession, sf: str, platforms: tuple[str, ...] | None = None, **bounds: int) -> Dims:
    t = lambda n: table(spark, sf, n)
    return Dims(
        game_channel_rows=lambda: game_channel_rows(spark, sf),
        agent_game=lambda: t("part").selectExpr("cast(p_partkey AS string) AS game_id", "p_brand AS company_id", "p_partkey AS pos"),
        agent_channel=lambda: t("nation").selectExpr("cast(n_nationkey AS string) AS channel_id",
                                                     "cast(n_regionkey AS string) AS pf", "n_nationkey AS pos"),
        sub_channel_rows=lambda: t("supplier").selectExpr("cast(1000 + s_suppkey AS string) AS sub_channel_id",
                                                          "cast(s_nationkey AS string) AS channel_id", "s_suppkey AS pos"),
        old_game_channel=lambda: t("supplier").where("s_acctbal >= 0").selectExpr(
            "cast(1000 + s_suppkey AS string) AS channel_id", "cast(5000 + s_suppkey AS string) AS game_channel_id",
            "s_suppkey AS pos"),
        belong_game=lambda: belong_rows(spark, sf), special_set=lambda: special_rows(spark, sf),
        rates=lambda: rate_rows(spark, sf),
        packages=lambda: t("part").selectExpr("concat('com.game.p', p_partkey) AS package_name",
                                              "cast(1 + p_partkey % 97 AS string) AS game_id", "p_partkey AS pos"),
        platforms=platforms, bounds=bounds)


def test_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rule records: a list of exact servers and one range per game."""
    raw = table(spark, sf, "nation").selectExpr(
        "cast(n_nationkey + 1 AS string) AS game_id",
        "concat('[\"', n_nationkey, '\",\"', n_nationkey + 100, '\",{\"start\":', 200 + n_nationkey,"
        " ',\"end\":', 260 + n_nationkey, '}]') AS test_server")
    return guards.test_server_rules(raw)


def ip_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Upper bounds scattered over the address space, one per customer."""
    return table(spark, sf, "customer").selectExpr(
        "(c_custkey * 2654435761) % 4294967296 AS ip_hi", "concat('N\"', c_nationkey) AS country",
        "c_mktsegment AS province", "c_name AS city")


def regions(spark: SparkSession, sf: str, **bounds: int) -> Dimension:
    return geo.region_dimension(geo.ranges_from_upper_bounds(ip_bounds(spark, sf)), **bounds)


def stored_state(spark: SparkSession, sf: str) -> DataFrame:
    """State left by earlier runs, for part of the users and both game channels of each."""
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("i")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", both)
    return c.selectExpr(
        "concat(c_custkey, '_', 5000 + c_custkey % 97 + 97 * i) AS key",
        "CASE WHEN c_acctbal > 2000 THEN 1703500000 + c_custkey * 1000 END AS login_ts",
        "CASE WHEN c_acctbal > 5000 THEN 1704000000 + c_custkey * 1000 END AS order_ts")
