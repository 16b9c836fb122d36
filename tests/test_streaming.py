"""Streams over several files and batches give the rows of one batch run."""

from pyspark.sql import functions as F

from playtrail.operators import clicks as ck, metrics as mt, route, state as st
from playtrail.session import fresh_path
from playtrail.sinks import files
from playtrail.sinks.outputs import Outputs
from playtrail.sinks.state_table import StateTable
from playtrail.streaming import jobs

from test_state import SCHEMA, args, replay, rows_with_hot_key


def folder(spark, tmp_path, rows, schema, parts=4):
    path = tmp_path / "in"
    size = -(-len(rows) // parts)
    for n in range(parts):
        one = tmp_path / f"w{n}"
        spark.createDataFrame(rows[n * size:(n + 1) * size], schema).coalesce(1).write.parquet(str(one))
        path.mkdir(exist_ok=True)
        for f in one.glob("part-*.parquet"):
            target = path / f"{n}.parquet"
            target.write_bytes(f.read_bytes())
            import os
            os.utime(target, (1000 + n, 1000 + n))
    return str(path)


def done(handle):
    handle.awaitTermination()
    assert handle.exception() is None


def test_first_events_over_batches(spark, tmp_path):
    rows = rows_with_hot_key(seed=21)
    want, store = replay(rows)
    src = folder(spark, tmp_path, rows, SCHEMA)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    table = StateTable(str(tmp_path / "state"), ["key"], ["login_ts", "order_ts"], buckets=4, deltas=2)
    stream = jobs.read_folder(spark, src, SCHEMA, options={"maxFilesPerTrigger": "1"})
    done(jobs.first_events_stream(stream, out, table, check, args(), "no"))
    assert list((tmp_path / "state" / "data").glob("base-*"))
    got = {r["no"]: (r["first_order_date"], r["reg_date"]) for r in spark.read.parquet(out).collect()}
    assert got == want
    assert spark.read.parquet(out).select("batch").distinct().count() == 4
    final = {r["key"]: [r["login_ts"], r["order_ts"]] for r in table.read(spark).collect()}
    assert final == {k: v for k, v in store.items() if v != [None, None]}


def test_restart_reads_nothing_twice(spark, tmp_path):
    rows = rows_with_hot_key(40, seed=2)
    src = folder(spark, tmp_path, rows, SCHEMA, 2)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        stream = jobs.read_folder(spark, src, SCHEMA, options={"maxFilesPerTrigger": "1"})
        done(jobs.run_batches(stream, jobs.append_once(out, lambda b: b.select("no")), check))
    assert sorted(r["no"] for r in spark.read.parquet(out).collect()) == list(range(40))


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    src = folder(spark, tmp_path, [(i,) for i in range(40)], "id bigint")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    write = jobs.append_once(out, lambda b: b)

    def twice(batch, number):
        write(batch, number)
        write(batch, number)

    done(jobs.run_batches(jobs.read_folder(spark, src, "id bigint", options={"maxFilesPerTrigger": "1"}), twice, check))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(40))


def test_windowed_minutes_and_duplicates(spark, tmp_path):
    rows = [(i, i % 3, 1_704_000_000 + i * 7) for i in range(300)]
    src = folder(spark, tmp_path, rows, "id bigint, k int, t bigint")
    stream = jobs.read_folder(spark, src, "id bigint, k int, t bigint", options={"maxFilesPerTrigger": "1"})
    timed = stream.withColumn("at", F.timestamp_seconds("t"))
    out, check = str(tmp_path / "m"), str(tmp_path / "mc")
    done(jobs.run_batches(jobs.clicks_per_minute(timed, "at", ["k"], "1 minute"), jobs.append_once(out, lambda b: b), check))
    got = {(int(r["minute"].timestamp()), r["k"]): r["click_cnt"] for r in spark.read.parquet(out).collect()}
    want = {}
    for _, k, t in rows:
        want[(t // 60 * 60, k)] = want.get((t // 60 * 60, k), 0) + 1
    last = max(t for *_, t in rows)
    closed = {m: n for m, n in want.items() if m[0] + 60 <= last - 60}
    # one final row per closed minute; the newest minutes wait for the watermark
    assert closed.items() <= want.items() and closed.items() <= got.items() and got.items() <= want.items()
    out2, check2 = str(tmp_path / "d"), str(tmp_path / "dc")
    done(jobs.run_batches(jobs.deduplicated(timed, ["k"], "at", "1 hour"), jobs.append_once(out2, lambda b: b.select("id", "k")), check2))
    assert sorted(r["k"] for r in spark.read.parquet(out2).collect()) == [0, 1, 2]


def test_topics_and_dated_folders(spark, tmp_path):
    df = spark.range(20).select(F.concat(F.lit("t"), F.col("id") % 3).alias("topic"), F.col("id").cast("string").alias("value"))
    files.write_topics(df, str(tmp_path / "topics"))
    assert sorted(p.name for p in (tmp_path / "topics").glob("topic=*")) == ["topic=t0", "topic=t1", "topic=t2"]
    table = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")], "id int, v string, dt string")
    path = str(tmp_path / "dated")
    files.write_dated(table, path)
    files.write_dated(table.where("dt = 'd1'").withColumn("v", F.lit("new")), path)
    assert {(r["id"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "new"), (2, "new"), (3, "c")}
    changed = table.where("id = 3")
    files.rewrite_days(table.withColumn("v", F.lit("z")), changed, path, "dt")
    assert {(r["id"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "new"), (2, "new"), (3, "z")}


def test_each_row_has_exactly_one_route(spark):
    flags = spark.sql("SELECT a, b, c, d, e FROM VALUES (true), (false) x(a), VALUES (true), (false), (NULL) y(b), VALUES (true), (false) z(c),"
                      " VALUES (true), (false) u(d), VALUES (true), (false) v(e)")
    routed = flags.select("*", route.route_order("agentDBSrc", F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("e")).alias("r"))
    for r in routed.collect():
        want = ("Copy" if r["a"] else "Filter" if not r["b"] or r["c"] else "Test" if r["d"] else "Other" if r["e"] else "")
        assert r["r"] == "agentDB" + want


def test_observed_count_costs_no_job(spark, tmp_path):
    df, seen = mt.observed(spark.range(77).toDF("id"))
    df.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 77}


def test_click_keys_and_insert_if_absent(spark):
    clicks = spark.createDataFrame([("1", "U1", "c", "", "9.9.9.9", "1", "t", ""), ("1", "U1", "c", "d", "9.9.9.9", "1", "t", "")],
                                   "ad_id string, game string, channel string, device_id string, client_ip string, company_id string, click_time string, pf string")
    assert ck.lookup_keys(clicks).count() == 3
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "id string, no int, v string")
    target = spark.createDataFrame([("b",)], "id string")
    assert [tuple(r) for r in st.insert_if_absent(rows, target, "id", "no").collect()] == [("a", 1, "y")]


def test_insert_reads_the_days_of_the_load_only(spark, tmp_path):
    path = str(tmp_path / "log")
    table = spark.createDataFrame([(f"id{n}", n % 10) for n in range(100)], "id string, dt int")
    files.write_dated(table, path, "dt")
    target = spark.read.schema("id string, dt int").parquet(path)
    load = spark.createDataFrame([("id3", 3, 1, "old"), ("new", 3, 2, "first"), ("new", 3, 3, "second"), ("id4", 4, 4, "old"), ("other", 5, 5, "x")], "id string, dt int, no int, v string")
    out = st.insert_if_absent(load, target, "id", "no", "dt")
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [("new", "first"), ("other", "x")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters: ["):]
    assert "dt#" in scan.split("]")[0] and all(day in scan.split("PushedFilters")[0] for day in "345")
    assert sorted((r["id"], r["v"]) for r in st.insert_if_absent(load, target, "id", "no").collect()) == [("new", "first"), ("other", "x")]


def test_outputs_appear_together(spark, tmp_path):
    run = Outputs(f"file:{tmp_path}/out")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id int, route string")
    assert run.read(spark, "rows", rows.schema).count() == 0 and run.counts(spark, "src").count() == 0
    run.write({"rows": rows, "ids": rows.select("id")}, 1, {"rows": ("a", "b", "z")})
    rows.where("id < 3").write.parquet(f"file:{tmp_path}/out/rows/run-2-broken")  # broke off before its manifest
    assert {r["id"] for r in run.read(spark, "rows", "id int, route string").collect()} == {1, 2, 3, 4}
    counts = {(r["destination"], r["value"]) for r in run.counts(spark, "src").collect()}
    assert ("a", 2) in counts and ("b", 1) in counts and not any(d == "z" for d, _ in counts)
    run.write({"rows": rows.where("id = 1"), "ids": rows.where("id = 1").select("id")}, 1, {"rows": ("a",)})  # repeated
    run.write({"rows": rows.where("id = 2"), "ids": rows.where("id = 2").select("id")}, 2, {"rows": ("b",)})
    assert sorted(r["id"] for r in run.read(spark, "ids", "id int").collect()) == [1, 2]
    assert len(list((tmp_path / "out" / "ids").iterdir())) == 2  # the replaced attempt is gone


def test_batches_write_several_tables_at_once(spark, tmp_path):
    src = folder(spark, tmp_path, [(i,) for i in range(40)], "id bigint")
    run = Outputs(str(tmp_path / "out"))
    handle = lambda batch, number: run.write({"odd": batch.where("id % 2 = 1"), "all": batch}, number)
    done(jobs.run_batches(jobs.read_folder(spark, src, "id bigint", options={"maxFilesPerTrigger": "1"}), handle, str(tmp_path / "check")))
    assert len(run.runs(spark, "odd")) == 4 and run.read(spark, "odd", "id bigint").count() == 20 and run.read(spark, "all", "id bigint").count() == 40
    assert {r["value"] for r in run.counts(spark, "s").collect()} == {60}


def test_a_batch_is_dealt_over_all_cores(spark):
    """The rows of the events in order of arrival, whatever their number in as many files a batch as there are cores."""
    from workload import inputs, q_streams
    sf = "/root/testdata/sf0.001"
    found, sizes = [], []

    def handle(batch, number):
        sizes.append(batch.rdd.getNumPartitions())
        found.append(sorted(r["event_id"] for r in batch.select("event_id").collect()))
    done(jobs.run_batches(q_streams.event_stream(spark, sf, 3), handle, fresh_path(spark, "cores-offsets")))
    top = max(found[-1]) + 1
    assert len(found) == 3 and min(sizes) == spark.sparkContext.defaultParallelism
    assert all(e * 3 // top == n for n, part in enumerate(found) for e in part)
    assert sum(found, []) == sorted(r["event_id"] for r in inputs.table(spark, sf, "events").select("event_id").collect())
