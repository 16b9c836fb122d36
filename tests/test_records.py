"""Whole records: nothing that came is lost, changed fields win, other names are understood."""

import json
import time

from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.functions.extended_json import plain_values
from playtrail.operators import lines, records

RAW = '{"id":7,"g":{"a":1.50,"b":{"c":[1,{"d":2}],"e":{}}},"list":["x",null],"none":null,"big":12345678901234567890,"a-b":1}'


def record_of(spark, text, items, changed):
    df = spark.createDataFrame([(text,)], "raw string")
    row = records.with_record(df, "out", items(records.entries(F.col("raw"))), changed, F.lit("as it came")).first()
    return row["out"] if row["out"] == "as it came" else json.loads(row["out"])


def test_overlay_keeps_the_rest(spark):
    got = record_of(spark, RAW, lambda i: i, {"id": F.lit("new"), "added": F.lit(2.5), "list": F.lit(None).cast("string")})
    assert got == {**json.loads(RAW), "id": "new", "added": 2.5}


def test_flattened_by_group_and_by_leaf(spark):
    got = record_of(spark, RAW, records.flat, {"g-a": F.lit("z")})
    assert got == {"id": 7, "g-a": "z", "g-b-c": [1, {"d": 2}], "list": ["x", None], "none": None, "big": 12345678901234567890, "a-b": 1}
    leaf = record_of(spark, '{"a":1,"g":{"a":2,"h":{"b":3}}}', lambda i: records.flat(i, joined=False), {"q": F.lit(1)})
    assert leaf == {"a": 2, "b": 3, "q": 1}


def test_flattened_at_any_depth(spark):
    deep = json.dumps({"k": {"a": {"b": {"c": {"d": {"e": {"f": {"g": 1, "list": [{"x": {"y": 2}}]}}}}}}}, "s": "{{{", "n": None})
    assert record_of(spark, deep, records.flat, {"q": F.lit(1)}) == {
        "k-a-b-c-d-e-f-g": 1, "k-a-b-c-d-e-f-list": [{"x": {"y": 2}}], "s": "{{{", "n": None, "q": 1}


def test_braces_of_a_text_cost_nothing(spark):
    """A record is opened as deep as its objects go, not once for every brace in it."""
    wide = {f"g{i}": {"a": i} for i in range(300)} | {"s": "{" * 20000}
    df = spark.createDataFrame([(json.dumps(wide),)] * 8, "raw string").coalesce(1)
    begin = time.monotonic()
    got = records.with_record(df, "out", records.flat(records.entries(F.col("raw"))), {"q": F.lit(1)}).collect()
    assert time.monotonic() - begin < 8
    assert all(json.loads(r["out"]) == {f"g{i}-a": i for i in range(300)} | {"s": wide["s"], "q": 1} for r in got)


def test_what_is_no_object_stays(spark):
    for text in (None, "", "[1]", '{"a":', "word"):
        assert record_of(spark, text, lambda i: i, {"q": F.lit(1)}) == "as it came"


def test_change_data_under_other_names(spark):
    row = '{"rows":[{"database":"d","table":"pay_orders","type":"INSERT","data":{"oid":"5","who":"u","more":[1]}}]}'
    df = spark.createDataFrame([(row,), ("{",), ('{"rows":[]}',), ('{"rows":[{"table":"t","data":3}]}',)], "value string")
    out = lines.binlog_rows(df, ["order_sn", "user_id", "money"], names={"order_sn": "oid", "user_id": "who"}, tables={"pay_orders": "order"}).collect()
    good = next(r for r in out if r["reject_reason"] is None)
    assert good["table"] == "order" and good["data"].asDict() == {"order_sn": "5", "user_id": "u", "money": None}
    assert json.loads(good["raw"])["more"] == [1]
    assert sorted(r["reject_reason"] for r in out if r["reject_reason"]) == ["json parse error", "no rows", "row without data"]


def test_lines_under_other_names(spark):
    df = spark.createDataFrame([('DATA[{"sdk":{"app_id":"1"},"event":"login"}]',), ("DATA[{]",), ("none",), (None,)], "value string")
    renamed = df.select(lines.renamed_line(F.col("value"), "DATA[", {"sdk": "sdk_platform"}).alias("value"))
    parsed = lines.framed_lines(renamed, schemas.event_schema(["sdk_platform"]), frame=False).collect()
    assert [r["doc"]["sdk_platform"]["app_id"] for r in parsed if r["ok"]] == ["1"] and len(parsed) == 4


def test_wrapped_numbers_are_plain(spark):
    text = ('{"a":{"$numberLong":"9007199254740993"},"b":[{"$numberInt":"-07"},{ "$numberDouble" : "1.50" }],"c":{"$date":{"$numberLong":"1700000000000"}},'
            '"d":{"$date":"2024-01-01T00:00:00Z"},"e":{"$numberDouble":"NaN"},"f":{"$numberDecimal":"0.5E+3"},"g":{"$numberLong":"+0"},"h":{"$oid":"0a"},"s":"{\\"$numberLong\\":\\"5\\"}"}')
    want = {"a": 9007199254740993, "b": [-7, 1.5], "c": 1700000000000, "d": "2024-01-01T00:00:00Z", "e": "NaN", "f": 500.0, "g": 0,
            "h": {"$oid": "0a"}, "s": '{"$numberLong":"5"}'}
    assert record_of(spark, text, lambda i: i, {"q": F.lit(1)}) == {**want, "q": 1}
    df = spark.createDataFrame([('{"rows":[{"table":"t","data":' + text + "}]}",)], "value string")
    row = lines.binlog_rows(df, ["a", "c", "s"]).first()
    data = row["data"].asDict()
    assert {c: data[c] for c in ("a", "c", "s")} == {"a": "9007199254740993", "c": "1700000000000", "s": '{"$numberLong":"5"}'}
    assert json.loads(row["raw"]) == want
    nothing = spark.createDataFrame([(None,), ("",), ('{"$numberLong":"x"}',), ('{"$number":1}',)], "t string")
    assert [r[0] for r in nothing.select(plain_values(F.col("t"))).collect()] == [None, "", '{"$numberLong":"x"}', '{"$number":1}']


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_names_and_unset_fields(spark):
    """The last of equal names counts; a field that is not set stays as it came, also where its name is repeated."""
    text = '{"a":1,"b":{"c":1},"a":[2],"d":3}'
    unset, none = F.lit(None).cast("string"), {"q": F.lit(None).cast("string")}
    assert record_of(spark, text, lambda i: i, {"a": unset, "d": F.lit("new")}) == {"a": [2], "b": {"c": 1}, "d": "new"}
    assert record_of(spark, text, lambda i: i, {"a": F.lit(5), "d": unset}) == {"a": 5, "b": {"c": 1}, "d": 3}
    assert record_of(spark, "{}", lambda i: i, none) == {} and record_of(spark, "{}", lambda i: i, {"q": F.lit(1)}) == {"q": 1}
    assert record_of(spark, '{"q":"\\u007f,}"}', lambda i: i, {"q": F.lit('x"}\n')}) == {"q": 'x"}\n'}
    assert record_of(spark, '{"q":1}', lambda i: i, {"q": F.lit("z")}) == {"q": "z"} and record_of(spark, '{"q":1}', lambda i: i, none) == {"q": 1}


def test_generator_and_lambdas_read_finished_columns(spark):
    """No parse stands inside a generator, and the changed fields are not evaluated again for each entry of a record."""
    df = spark.createDataFrame([('{"a":1,"b":2}', 5)], "raw string, n long")
    once = records.once(df, {"_m": F.from_json("raw", "map<string,string>")})
    generated = [line for line in plan_of(once).splitlines() if "Generate " in line]
    assert generated and not any("from_json" in line for line in generated)
    laid = records.with_record(df, "out", records.entries(F.col("raw")), {"a": F.repeat(F.lit("x"), F.col("n").cast("int"))})
    assert laid.first()["out"] == '{"b":2,"a":"xxxxx"}'
    filtered = [line for line in plan_of(laid).splitlines() if "lambdafunction" in line]
    assert filtered and not any("repeat(" in line for line in filtered)


def test_outgoing_record_is_read_once(spark):
    from workload.q_jobs import opened, record_fields
    df = spark.createDataFrame([('{"b":{"c":[1]},"a":1.5,"t":"x"}', None), ("NORMAL: [", "bad frame")], "value string, reject_reason string")
    out = opened(df).select(*record_fields(b="b", a="a", t="t", none="none"))
    assert [tuple(r) for r in out.collect()] == [("a,b,t", '{"c":[1]}', "1.5", "x", None), (None,) * 5]
    assert plan_of(out).count("from_json(") == 1 and "get_json_object" not in plan_of(out)
