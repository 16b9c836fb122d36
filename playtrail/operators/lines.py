"""Text line -> typed columns.

A record is never dropped here: ``ok`` says whether it can be used and
``reject_reason`` why not, and the raw line stays in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import times
from ..functions.extended_json import plain_values
from . import records
from .once import once

# The frame around a payload.
TIME_OPEN, IP_OPEN = "NORMAL: [", "] CIP["
TAGS = ("DATA[", "CONTENT[", "ACTIVE_LOG[", "ANALYSIS[", "AD_CLICK[", "GAME_COIN_LOG[")


def _after(line: Column, mark: str) -> Column:
    """Position right behind the first ``mark``; NULL when it is absent."""
    at = F.instr(line, mark)
    return F.when(at > 0, at + len(mark))


def payload_of(line: Column, tag: str) -> Column:
    """Text behind the tag without the closing bracket."""
    start = _after(line, tag)
    return F.substring(line, start, F.length(line) - start)


def frame_parts(line: Column, tag: str) -> dict[str, Column]:
    """time text, ip text and payload of a framed line."""
    time_at, ip_at, tag_at = _after(line, TIME_OPEN), _after(line, IP_OPEN), F.instr(line, tag)
    time_text = F.when(ip_at > time_at, F.substring(line, time_at, ip_at - len(IP_OPEN) - time_at))
    ip_text = F.when((tag_at > 0) & (tag_at - 2 >= ip_at), F.substring(line, ip_at, tag_at - 2 - ip_at))
    return {"time_text": time_text, "line_ip": ip_text, "payload": payload_of(line, tag)}


def framed_lines(df: DataFrame, schema: T.StructType, tag: str = "DATA[", line: str = "value",
                 tz: str = times.DEFAULT_TZ, frame: bool = True) -> DataFrame:
    """Add ``doc`` (payload by ``schema``), ``line_ts``, ``line_ip``, ``ok``, ``reject_reason``.

    ``frame=False`` asks only for the tag, as the plain load does.
    """
    src = F.col(line)
    parts = frame_parts(src, tag)
    cut = df.select("*", *[c.alias("_" + n) for n, c in parts.items()])
    parsed = with_document(cut, F.col("_payload"), schema, "doc", df.columns, {
        "line_ip": F.col("_line_ip"), "line_ts": times.parse(F.col("_time_text"), times.FULL, tz),
        "_tagged": F.col("_payload").isNotNull()})
    framed = F.col("line_ip").isNotNull() & F.col("line_ts").isNotNull()
    reason = F.when(~F.col("_tagged"), F.lit("no tag"))
    if frame:
        reason = reason.when(~framed, F.lit("bad frame"))
    reason = reason.when(F.col("doc").isNull(), F.lit("json parse error"))
    return (parsed.withColumn("reject_reason", reason).drop("_tagged")
            .withColumn("ok", F.col("reject_reason").isNull()))


def with_document(df: DataFrame, text: Column, schema: T.StructType, out: str = "doc",
                  kept: list[str] | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """Add the JSON object ``text`` parsed by ``schema``, NULL when it is not one. Wrapped numbers and times are plain.

    The text is parsed once, whatever is read from it later. The permissive parser
    returns an all-NULL row for broken text, so a corrupt-record field is checked.
    """
    names = df.columns if kept is None else kept
    wide = T.StructType(list(schema.fields) + [T.StructField("_bad", T.StringType())])
    given = df.select(*[F.col(f"`{n}`") for n in names], plain_values(text).alias("_text"),
                      *[c.alias(n) for n, c in (more or {}).items()])
    raw = F.from_json(F.when(F.ltrim("_text").startswith("{"), F.col("_text")), wide,
                      {"columnNameOfCorruptRecord": "_bad"})
    parsed = once(given, {"_raw": raw}, [*names, *(more or {})])
    return parsed.withColumn(out, F.when(F.col("_raw._bad").isNull(), F.col("_raw"))).drop("_raw")


def renamed_line(line: Column, tag: str, names: dict[str, str]) -> Column:
    """The line with members of its object called as here: ``names`` maps their names to those used here.

    A line without tag or object stays as it is.
    """
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    items = F.transform(records.entries(payload_of(line, tag)), lambda e: F.struct(
        F.coalesce(F.element_at(known, e["key"]), e["key"]).alias("key"), e["value"].alias("value")))
    head = F.substring(line, F.lit(1), _after(line, tag) - 1)
    return F.coalesce(F.concat(head, F.to_json(F.map_from_entries(items)), F.lit("]")), line)


def wrapped_lines(df: DataFrame, line: str = "value", out: str = "value") -> DataFrame:
    """Collector wrapper ``{"message": "..."}`` -> the inner text (NULL when broken)."""
    return df.withColumn(out, F.get_json_object(line, "$.message"))


def old_login_lines(df: DataFrame, line: str = "value", tz: str = times.DEFAULT_TZ) -> DataFrame:
    return framed_lines(df, schemas.OLD_LOGIN, "CONTENT[", line, tz)


def line_day_wrap(df: DataFrame, line: str = "value") -> DataFrame:
    """Day of the frame and the whole line as a new record."""
    time_text = frame_parts(F.col(line), "[")["time_text"]
    day = F.split_part(time_text, F.lit(" "), F.lit(1))
    return (df.withColumn("server_date_day", day)
            .withColumn("record", F.to_json(F.struct(F.col("server_date_day"), F.col(line).alias("msg")))))


# ---------------------------------------------------------------- clicks

def ad_click_lines(df: DataFrame, line: str = "value", ad_field: str = "adid") -> DataFrame:
    """Ad click: time and ip from the first two brackets, JSON between ``[{"`` and ``"}]``.

    The line's ip replaces ``client_ip``; ``click_time`` falls back to the line's time.
    A row counts only when company, ad id and a numeric ad value are present.
    """
    src = F.col(line)
    first = F.regexp_extract(src, r"^[^\[]*\[([^\]]*)\][^\[]*\[([^\]]*)\]", 1)
    second = F.regexp_extract(src, r"^[^\[]*\[([^\]]*)\][^\[]*\[([^\]]*)\]", 2)
    opened, closed = F.instr(src, '[{"'), F.instr(src, '"}]')
    text = F.when((opened > 0) & (closed > opened), F.substring(src, opened + 1, closed + 1 - opened))
    shape = schemas.texts([ad_field if c == "adid" else c for c in schemas.AD_CLICK])
    staged = df.select("*", text.alias("_json"), first.alias("_time"), second.alias("_ip"))
    parsed = with_document(staged, F.col("_json"), shape, "_d")
    d = F.col("_d")
    named = F.col("_json").contains("company_id") & F.col("_json").contains(ad_field)
    fields = [F.coalesce(d[c], F.lit("")).alias(c) for c in ("game", "channel", "device_id", "company_id", "pf")]
    out = parsed.select(*[F.col(f"`{c}`") for c in df.columns],
                        F.coalesce(d[ad_field], F.lit("")).alias("ad_id"), *fields,
                        F.col("_ip").alias("client_ip"),
                        F.coalesce(d["click_time"], F.col("_time")).alias("click_time"),
                        F.when(d.isNull(), F.lit("json parse error"))
                        .when(~named, F.lit("company or ad missing"))
                        .when(~F.coalesce(d[ad_field], F.lit("")).rlike("^[0-9]*$"), F.lit("ad not numeric"))
                        .alias("reject_reason"))
    return out.withColumn("ok", F.col("reject_reason").isNull())


def access_lines(df: DataFrame, line: str = "value", tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Web access line -> click_time (text in ``tz``), event_tag, apk_name."""
    src = F.col(line)
    stamp = F.regexp_extract(src, r"\[([^\]]*)\]", 1)
    tag = F.regexp_extract(src, r"act=(.*?)&url", 1)
    apk = F.regexp_extract(src, r"apk_sem/(.*?)\.apk", 1)
    epoch = times.parse_zoned(stamp, "dd/MMM/yyyy:HH:mm:ss Z")
    whole = F.instr(src, "act=").between(1, F.instr(src, "&url")) & (F.instr(src, "apk_sem/") > 0) & \
        (F.instr(src, ".apk") > F.instr(src, "apk_sem/"))
    staged = once(df, {"_e": epoch, "event_tag": tag, "apk_name": apk, "_whole": whole})
    out = staged.withColumn("ok", F.col("_whole") & F.col("_e").isNotNull())
    return (out.withColumn("click_time", times.render(F.col("_e"), times.FULL, tz))
            .withColumn("reject_reason", F.when(~F.col("ok"), F.lit("access line error")))
            .drop("_e", "_whole"))


# ---------------------------------------------------------------- coin trades

def coin_json_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Coin log with one object or an array; each object is parsed, and rejected, alone.

    A line without the tag is one reject without an object number.
    """
    src = F.col(line)
    tag = "GAME_COIN_LOG["
    many = F.instr(src, tag + "[") > 0
    start = F.instr(src, tag) + len(tag)
    body = F.when(many, F.substring(src, start + 1, F.length(src) - start - 2)) \
        .when(F.instr(src, tag) > 0, F.substring(src, start, F.length(src) - start))
    # the outer brackets are gone, so objects part where "}" meets ",{"
    objects = F.split(F.regexp_replace(body, r"\},\{", "}\x02{"), "\x02")
    kept = [F.col(f"`{c}`") for c in df.columns]
    each = df.select(*kept, F.posexplode_outer(objects).alias("object_no", "object"))
    parsed = with_document(each, F.translate("object", "\t", " "), schemas.texts(schemas.COIN), "_d")
    reason = F.when(F.col("object_no").isNull(), F.lit("no tag")).otherwise(F.lit("json parse error"))
    return _coin_out(parsed, [*kept, F.col("object_no"), F.col("object")], reason)


def coin_tsv_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Coin export: exactly 14 tab-separated fields (trailing empty ones do not count)."""
    cells = F.split(F.regexp_replace(F.col(line), "\t+$", ""), "\t")
    kept = [F.col(f"`{c}`") for c in df.columns]
    whole = F.size("_cells") == len(schemas.COIN)
    record = F.struct(*[F.try_element_at("_cells", F.lit(i + 1)).alias(c) for i, c in enumerate(schemas.COIN)])
    return _coin_out(df.withColumn("_cells", cells).select(*kept, F.when(whole, record).alias("_d")),
                     kept, F.lit("not 14 fields"))


def _coin_out(df: DataFrame, kept: list[Column], reason: Column) -> DataFrame:
    fields = [F.coalesce(F.col("_d")[c], F.lit("")).alias(c) for c in schemas.COIN]
    ok = F.col("_d").isNotNull()
    return df.select(*kept, *fields, ok.alias("ok"), F.when(~ok, reason).alias("reject_reason"))


# ---------------------------------------------------------------- envelopes and records

def binlog_rows(df: DataFrame, data: list[str], line: str = "value", names: dict[str, str] | None = None,
                tables: dict[str, str] | None = None, aside: tuple[str, ...] = ()) -> DataFrame:
    """Change-data envelope -> one row per changed row: row_no, database, table, type, raw, data, reject_reason.

    ``raw`` is the row's whole object as text, ``data`` its fields named in ``data``. A line that is no envelope, or
    has no rows, is one row with a reason; so is a changed row without an object. Where a database calls fields or
    tables otherwise, ``names`` maps the name used here to its field, ``tables`` its table to the name used here.
    The line, and the columns ``aside``, stay with lines that are rejected only: an envelope may hold very many rows.
    """
    kept = df.columns
    parsed = with_document(df, F.col(line), schemas.BINLOG, "_d")
    rows = F.when(F.size("_d.rows") > 0, F.col("_d.rows"))
    parsed = parsed.withColumn("_why", F.when(F.col("_d").isNull(), F.lit("json parse error"))
                               .when(F.coalesce(F.size("_d.rows"), F.lit(0)) <= 0, F.lit("no rows")))
    each = (parsed.withColumns({c: F.when(F.col("_why").isNotNull(), F.col(c)) for c in (line, *aside)})
            .select(*[F.col(f"`{c}`") for c in kept], "_why", F.posexplode_outer(rows).alias("row_no", "_r"))
            .select(*[F.col(f"`{c}`") for c in kept], "_why", "row_no", "_r.database", "_r.table", "_r.type",
                    F.col("_r.data").alias("raw")))
    given = {n: (names or {}).get(n, n) for n in data}
    out = with_document(each, F.col("raw"), schemas.texts(list(dict.fromkeys(given.values()))), "data")
    reason = F.coalesce("_why", F.when(F.col("data").isNull(), F.lit("row without data")))
    out = out.withColumn("reject_reason", reason).drop("_why")
    if names:
        out = out.withColumn("data", F.when(F.col("data").isNotNull(), F.struct(*[F.col("data")[c].alias(n) for n, c in given.items()])))
    if tables:
        known = F.create_map(*[F.lit(x) for pair in tables.items() for x in pair])
        out = out.withColumn("table", F.coalesce(F.element_at(known, F.col("table")), F.col("table")))
    return out


def sdk_fanout(df: DataFrame, line: str = "value", tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Analytics line: the header is copied onto each event record; the header wins.

    ``event_record`` may be one object or an array. Records come out as a map. A line that cannot be read, or holds no
    record, is one row without a record number, with a reason.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    shape = T.StructType([T.StructField("device", T.MapType(T.StringType(), T.StringType())),
                          T.StructField("analysis_id", T.StringType()),
                          T.StructField("event_record", T.StringType())])
    framed = framed_lines(df, shape, "ANALYSIS[", line, tz)
    text = F.ltrim("doc.event_record")
    records = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))),
                          T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    head = F.map_concat(F.coalesce(F.col("doc.device"), F.map_from_arrays(F.array(), F.array())
                                   .cast("map<string,string>")),
                        F.create_map(F.lit("analysis_id"), F.coalesce("doc.analysis_id", F.lit("")),
                                     F.lit("server_ts"), F.col("line_ts").cast("string"),
                                     F.lit("server_date_day"), times.day(F.col("line_ts"), tz),
                                     F.lit("ip"), F.col("line_ip")))
    each = framed.select(*kept, "reject_reason", F.when(F.col("ok"), head).alias("_head"),
                         F.posexplode_outer(F.filter(records, lambda r: r.isNotNull())).alias("record_no", "_rec"))
    reason = F.coalesce("reject_reason", F.when(F.col("_rec").isNull(), F.lit("no event record")))
    return each.select(*kept, "record_no", F.when(F.col("_rec").isNotNull(), merged(F.col("_rec"), F.col("_head"))).alias("record"),
                       reason.alias("reject_reason")).withColumn("ok", F.col("reject_reason").isNull())


def merged(left: Column, right: Column) -> Column:
    """Union of two text maps; the right side wins on a shared key."""
    extra = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(extra, right)


def subdoc_merge(df: DataFrame, left: str, right: str, out: str = "record") -> DataFrame:
    """Two text maps become one record; the right side wins."""
    return df.withColumn(out, merged(F.col(left), F.col(right)))


ACTIVE_SHAPE = T.StructType([
    T.StructField("app_data", T.MapType(T.StringType(), T.StringType())),
    T.StructField("extra_data", T.MapType(T.StringType(), T.StringType()))])


def active_lines(df: DataFrame, line: str = "value", tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Activation line: ``app_data`` completed by ``extra_data`` as one text map ``record``."""
    framed = framed_lines(df, ACTIVE_SHAPE, "ACTIVE_LOG[", line, tz)
    return (framed.withColumn("record", merged(F.col("doc.app_data"), F.col("doc.extra_data")))
            .drop("doc"))


def rejects(df: DataFrame, source: str, raw: str = "value", time: Column | None = None,
            kept: list[str] = ()) -> DataFrame:
    """Error rows: source, info, data, time."""
    at = F.current_timestamp() if time is None else time
    return df.where(~F.col("ok")).select(*kept, F.lit(source).alias("source"),
                                         F.col("reject_reason").alias("info"),
                                         F.col(raw).alias("data"), at.alias("time"))
