"""Dirty input: every line comes out once, with a reason when it cannot be used."""

import struct

import pyarrow as pa
from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.operators import events, lines, rules
from playtrail.sources import messages, tables

GOOD = 'NORMAL: [2024-01-02 03:04:05] CIP[203.0.113.9] DATA[{"user":{"user_id":7},"event":"login","server_ts":1704135845}]'
DIRTY = ["", "junk", GOOD[:-30], GOOD.replace("CIP[", "XIP["), GOOD.replace("2024-01-02", "2024-99-02"), "DATA[]", "DATA[{}]",
         GOOD.replace("DATA[", "NODATA"), GOOD.replace('{"user"', '[{"user"'), GOOD]


def test_framed_lines_keep_every_line(spark):
    df = spark.createDataFrame(list(enumerate(DIRTY)), "id int, value string")
    out = {r["id"]: r for r in lines.framed_lines(df, schemas.event_schema(["user"])).collect()}
    assert len(out) == len(DIRTY)
    assert [i for i, r in out.items() if r["ok"]] == [9]
    good = out[9]
    assert (good["line_ts"], good["line_ip"], good["doc"]["user"]["user_id"]) == (1704135845, "203.0.113.9", "7")
    assert out[1]["reject_reason"] == "no tag" and out[2]["reject_reason"] == "json parse error"
    assert out[3]["reject_reason"] == "bad frame" and out[4]["reject_reason"] == "bad frame"
    loose = lines.framed_lines(df, schemas.event_schema(["user"]), frame=False)
    assert {r["id"] for r in loose.where("ok").collect()} == {3, 4, 6, 9}


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    seen = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        seen.add(lines.framed_lines(df, schemas.event_schema(["user"])).first()["line_ts"])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == {1704135845}


def test_text_is_parsed_once_under_a_filter(spark, tmp_path):
    spark.createDataFrame([(GOOD,)], "value string").write.text(str(tmp_path / "t"))
    df = tables.text_scan(spark, str(tmp_path / "t"))
    out = lines.framed_lines(df, schemas.event_schema(["user"])).where("ok AND doc.event = 'login'").select("doc.user.user_id", "doc.event")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def sign_flipped(n):
    return struct.pack(">I", (n + 2 ** 31) % 2 ** 32)


def envelope(text, kind=0, system="sys", ip="1.1.1.1", path="/p", count=2):
    raw = text.encode()
    data = pa.Codec("lz4_raw").compress(raw, asbytes=True) if kind else raw
    names = "\x01".join((system, ip, path)).encode()
    return data + sign_flipped(kind) + sign_flipped(count) + sign_flipped(len(raw)) + names + sign_flipped(len(data)) + b"\xff"


def test_envelope_bytes(spark):
    bodies = [envelope("a\nb"), envelope("long " * 300, 1), envelope("x", path=""), b"plain\ntext", b"\x00\xff", envelope("q" * 50, 1)[:10] + b"\xff", None, b""]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in enumerate(bodies)], "id int, body binary")
    out = {r["id"]: r for r in messages.envelope_decode(df).collect()}
    text = lambda i: bytes(out[i]["message_body"]).decode()
    assert (text(0), out[0]["data_system"], out[0]["ip"], out[0]["file_path"], out[0]["line_count"]) == ("a\nb", "sys", "1.1.1.1", "/p", 2)
    assert text(1) == "long " * 300 and text(2) == "x" and out[2]["file_path"] == ""
    assert text(3) == "plain\ntext" and out[3]["line_count"] == 1 and out[3]["data_system"] == ""
    assert not out[4]["ok"] and not out[5]["ok"]


def test_encode_gives_the_same_bytes(spark):
    row = spark.createDataFrame([(bytearray(b"a\nb"), "sys", "1.1.1.1", "/p", 2)], "message_body binary, data_system string, ip string, file_path string, line_count bigint")
    assert bytes(messages.envelope_encode(row).first()["body"]) == envelope("a\nb")
    big = row.withColumn("message_body", F.repeat(F.lit("z"), 5000).cast("binary"))
    back = messages.envelope_decode(messages.envelope_encode(big, compress_from=1000).select("body")).first()
    assert bytes(back["message_body"]) == b"z" * 5000 and back["line_count"] == 2


def test_message_lines_drop_trailing_blanks_and_tag_damage(spark):
    bodies = [envelope("a\n\nb\n\n"), b"\x00\xff", envelope("m", system="")]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(bodies)], "id int, body binary")
    out = messages.message_lines(df, F.lit("now")).collect()
    assert [(r["id"], r["line_no"], r["line"]) for r in out if r["id"] == 0] == [(0, 0, "a"), (0, 1, ""), (0, 2, "b")]
    assert [r["data_system"] for r in out if r["id"] == 1] == [messages.PULL_ERROR]
    assert {r["id"] for r in messages.drop_unnamed(messages.message_lines(df)).collect()} == {0, 1}


def test_rule_file_round_trip(spark, tmp_path):
    xml = "<config>" + "".join(f"<{e}><{g}><{f}>{r}</{f}></{g}></{e}>" for e, g, f, r in rules.DEFAULT_RULES) + "</config>"
    path = tmp_path / "rules.xml"
    path.write_text(xml, encoding="utf-8")
    assert tables.read_rules(spark, str(path)) == rules.DEFAULT_RULES
    assert tables.rule_frame(spark, rules.DEFAULT_RULES).count() == len(rules.DEFAULT_RULES)


def test_rules_in_conflicting_order_still_name_the_first(spark):
    two = [("a", "g", "x", "1"), ("a", "g", "y", "1"), ("b", "g", "y", "1"), ("b", "g", "x", "1"), ("c", "g", "x", "[0-9]+")]
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "event string").select(F.struct(
        "event", F.struct(F.lit("").alias("x"), F.lit("").alias("y")).alias("g")).alias("doc"))
    got = {r["e"]: r["f"] for r in df.select(F.col("doc.event").alias("e"), rules.first_failure(F.col("doc"), two).alias("f")).collect()}
    assert got == {"a": "x", "b": "y", "c": "x", "d": None}


def test_rule_kinds(spark):
    values = [None, "", "0", "-1", "0.5", "2", "z"]
    df = spark.createDataFrame([(v,) for v in values], "x string").select(
        F.col("x"), F.struct(F.lit("e").alias("event"), F.struct("x").alias("g")).alias("doc"))
    passes = lambda rule, strict=False: {r["x"] for r in df.where(rules.first_failure(F.col("doc"), [("e", "g", "x", rule)], strict).isNull()).collect()}
    assert passes("0") == set(values[1:])
    assert passes("1") == {"0", "-1", "0.5", "2", "z"}
    assert passes("2") == {"0", "0.5", "2"} and passes("2", True) == {"2"}
    assert passes("3") == {"0.5", "2"}
    assert passes("[0-9]") == {"0", "2"}


def test_ip_database_layouts(spark, tmp_path):
    ranges = [(2 ** 24 - 1, "A\tp\tc"), (2 ** 31, "B\t\t"), (2 ** 32 - 1, "C\tq\tr")]
    for wide in (False, True):
        table = 262144 if wide else 1024
        texts, entries = b"", b""
        for upper, label in ranges:
            raw = label.encode()
            entries += struct.pack(">I", upper) + struct.pack("<I", table + len(texts) - table)[:3]
            entries += struct.pack(">H", len(raw)) if wide else bytes([len(raw)])
            texts += raw
        size = 4 + table + len(entries) + table
        shifted = b"".join(entries[i:i + 4] + struct.pack("<I", int.from_bytes(entries[i + 4:i + 7], "little") + table)[:3] + entries[i + 7:i + (9 if wide else 8)]
                           for i in range(0, len(entries), 9 if wide else 8))
        # texts start right after the index; stored offsets count from the jump table on
        blob = struct.pack(">I", size) + b"\0" * table + shifted + b"\0" * table + texts
        path = tmp_path / f"ip{int(wide)}.dat"
        path.write_bytes(blob)
        got = sorted(tuple(r) for r in tables.read_ip_database(spark, str(path), wide).collect())
        assert got == sorted((u, *label.split("\t")) for u, label in ranges)


def test_newest_good_snapshot(spark, tmp_path):
    import os
    for n, (name, text) in enumerate([("rate.1.json", '{"content":[{"a":"1"}]}'), ("rate.2.json", '{"content":[{"a":"2"}]}'), ("rate.3.json", '{"content":[{"a"')]):
        path = tmp_path / name
        path.write_text(text)
        os.utime(path, (1000 + n, 1000 + n))
    from playtrail.operators.dims import snapshot_rows
    found = snapshot_rows(tables.snapshot_scan(spark, str(tmp_path / "rate.*.json")), "struct<a:string>").collect()
    assert [(r["name"], r["a"]) for r in found] == [("rate", "2")]


def test_flatten_names(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', named_struct('z', 3)) AS a, named_struct('x', 4) AS b")
    assert events.flatten_dashed(df).first().asDict() == {"id": 1, "a-x": 2, "a-y-z": 3, "b-x": 4}
    assert events.flatten_leaf(df).first().asDict() == {"id": 1, "z": 3, "x": 4}
