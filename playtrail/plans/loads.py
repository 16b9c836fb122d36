"""Warehouse loads from logs and from change data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import times
from ..functions.coerce import double_of, int_of, text_of
from ..operators import guards, lines, resolve, route, state as st, warehouse as wh
from ..operators.dims import Dims

OPEN_WRITERS = 16  # tables that a task writes at once
ROW_GROUP = 1 << 25  # bytes that a writer holds, about

LOAD_SHAPE = T.StructType(
    list(schemas.event_schema(["user", "game", "device", "channel_platform"]).fields)
    + [f for f in wh.INSTALL_SHAPE.fields if f.name not in schemas.TOP]
    + [f for f in wh.PURCHASE_SHAPE.fields]
    + [f for f in wh.REFUND_SHAPE.fields]
    + [T.StructField("event_order", T.StringType()), T.StructField("google_lf", T.StringType())])


def parsed_load(df: DataFrame, shape: T.StructType = LOAD_SHAPE) -> DataFrame:
    """Tagged lines with a ``route`` naming the table they belong to; rejects are routed too."""
    parsed = lines.framed_lines(df, shape, "DATA[", "value", frame=False)
    d = F.col("doc")
    kind = route.route_event(text_of(d["event"]), text_of(d["event_type"]), text_of(d["event_order"]),
                             text_of(d["google_lf"]))
    return parsed.withColumn("route", F.when(F.col("ok"), kind).otherwise(F.lit("reject")))


def staged(rows: DataFrame, path: str | None, part: str) -> DataFrame:
    """Write parsed rows once, a folder per table, so that each table reads only its own part.

    Without a path every table parses the input again. A task keeps a writer for each table open, so that its rows, however
    many, need not be sorted by table; only beyond OPEN_WRITERS tables are the rest of them.
    """
    if path is None:
        return rows
    conf, writers = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(writers)
    conf.set(writers, str(OPEN_WRITERS))
    try:
        rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).partitionBy(part).parquet(path)
    finally:
        conf.set(writers, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def log_load(df: DataFrame, arrival: str, *, device_state: DataFrame | None = None, stage: str | None = None,
             stored: dict[str, DataFrame] | None = None, tz: str = times.DEFAULT_TZ) -> dict[str, DataFrame]:
    """What a load adds to login_log and active_log: the first row of each id that the tables in ``stored`` lack.

    The id of a login is made of its time, so a ``login_log`` with its ``login_date`` is only read for the days loaded. Activations carry the new-device flag as an extra column.
    """
    parsed = staged(parsed_load(df), stage, "route")
    logins = wh.login_rows(parsed.where("route = 'login'"), "doc", [arrival], tz)
    active = wh.active_rows(parsed.where("route = 'active'"), "doc", [arrival], tz)
    stamped = active.withColumn("_ts", F.unix_timestamp("create_time"))
    flagged = st.new_device(stamped.withColumn("_key", F.concat_ws("_", "union_app_id", "device_id")),
                            ["_key"], arrival, "_ts",
                            state=None if device_state is None else device_state.withColumnRenamed("key", "_key"))
    known = stored or {}
    return {"login_log": insert_rows(logins, known.get("login_log"), arrival, "login_date"),
            "active_log": insert_rows(flagged.drop("_ts", "_key"), known.get("active_log"), arrival),
            "rejects": lines.rejects(parsed, "log_load", kept=[arrival])}


def overseas_log_load(df: DataFrame, dims: Dims, arrival: str, *, stage: str | None = None,
                      tz: str = times.DEFAULT_TZ) -> dict[str, DataFrame]:
    """login, install, purchase rows and refunds of the overseas warehouse."""
    parsed = staged(parsed_load(df), stage, "route")
    purchases = wh.purchase_rows(parsed.where("route = 'purchase'"), "doc", [arrival], tz)
    return {"login_log": wh.login_rows(parsed.where("route = 'login'"), "doc", [arrival], tz, overseas=True),
            "af_active": wh.install_rows(parsed.where("route = 'install'"), dims.package_game, "doc", [arrival]),
            "voided_order": purchases,
            "refunds": wh.refund_rows(parsed.where("route = 'refund'"), "doc", [arrival], tz)}


def _load_rows(df: DataFrame, arrival: str, names: dict[str, str] | None, tables: dict[str, str] | None) -> DataFrame:
    fields = list(dict.fromkeys(schemas.OWN_ORDER + schemas.USER_ROW))
    rows = lines.binlog_rows(df, fields, "value", names, tables).withColumn("ok", F.col("reject_reason").isNull())
    return rows.select(arrival, F.coalesce("row_no", F.lit(0)).alias("row_no"), "table", "type", "data", "ok", "reject_reason",
                       F.when(~F.col("ok"), F.col("value")).alias("value"))


def database_load(df: DataFrame, arrival: str, *, dims: Dims | None = None, overseas: bool = False,
                  batch: bool = False, device_state: DataFrame | None = None, stage: str | None = None,
                  names: dict[str, str] | None = None, tables: dict[str, str] | None = None,
                  tz: str = times.DEFAULT_TZ) -> dict[str, DataFrame]:
    """order_log (placed and paid rows) and user (inserted rows) from change data, and the lines that are none."""
    rows = staged(_load_rows(df, arrival, names, tables), stage, "table")
    d = F.col("data")
    orders = rows.where(guards.order_states(F.col("table"), int_of(d["pay_status"]), int_of(d["status"])))
    users = rows.where(guards.user_inserts(F.col("table"), F.col("type")))
    if overseas:
        orders = resolve.fx_convert(orders, dims, text_of(d["money_type"]), double_of(d["money"]))
        order_rows = wh.order_rows_fx(orders, "data", [arrival, "row_no"], tz)
    else:
        order_rows = wh.order_rows(orders, "data", [arrival, "row_no"], tz, batch)
    user_rows = wh.user_rows(users, "data", [arrival, "row_no"], tz, overseas)
    flagged = _new_devices(user_rows, arrival, device_state)
    return {"order_log": order_rows, "user": flagged, "rejects": lines.rejects(rows, "database_load", kept=[arrival])}


def _new_devices(users: DataFrame, arrival: str, state: DataFrame | None) -> DataFrame:
    work = (users.drop("new_device").withColumn("_ts", F.unix_timestamp("register_time"))
            .withColumn("_key", F.concat_ws("_", "game", "device_id")))
    before = None if state is None else state.select(F.col("key").alias("_key"), "first_ts")
    flagged = st.new_device(work, ["_key"], [arrival, "row_no"], "_ts", state=before)
    return flagged.drop("_ts", "_key")


def insert_rows(rows: DataFrame, target: DataFrame | None, arrival: Column | str, day: str | None = None) -> DataFrame:
    """What a load adds: the first row of each id the table lacks. A target that has the column ``day`` is read by the days loaded."""
    dated = day if target is not None and day in target.columns else None
    return st.insert_if_absent(rows, target, "id", arrival, dated)
