"""Windowed state against a plain row-by-row replay."""

import random

import pytest
from pyspark.sql import functions as F

from playtrail.operators import dedupe, state as st
from playtrail.sinks.state_table import StateTable


def rows_with_hot_key(n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(12)}"
        gc = rnd.choice(["1", "1", "2", "", "error"])
        rows.append((i, user, gc, rnd.choice(["login", "order", "register"]), 1_700_000_000 + rnd.randrange(2_000_000),
                     rnd.choice(["regular", "regular", "test"]), rnd.choice(["0", "1"]), rnd.choice(["1", "2"])))
    return rows


SCHEMA = "no bigint, user string, gc string, event string, ts bigint, is_test string, pay string, step string"


def day(ts):
    import datetime
    return datetime.datetime.fromtimestamp(ts + 8 * 3600, datetime.UTC).strftime("%Y-%m-%d")


def replay(rows, state=None, flag_only=False):
    """The store as it is: read, decide, write, one row after the other."""
    store = {k: list(v) for k, v in (state or {}).items()}
    out = {}
    for no, user, gc, event, ts, test, pay, step in rows:
        usable = user not in ("", "error") and gc not in ("", "error")
        login, order = store.get(f"{user}_{gc}", [None, None]) if usable else (None, None)
        paid = pay == "1" and (flag_only or step == "2")
        first_order = (day(ts) if event == "order" else "") if order is None or (event == "order" and order > ts) else day(order)
        reg = day(ts) if login is None or (event == "login" and login > ts) else day(login)
        out[no] = (first_order, reg)
        if usable and test == "regular":
            slot = store.setdefault(f"{user}_{gc}", [None, None])
            if event == "login" and (slot[0] is None or slot[0] > ts):
                slot[0] = ts
            if event == "order" and paid and (slot[1] is None or slot[1] > ts):
                slot[1] = ts
    return out, store


def args():
    return dict(key=st.state_key(F.col("user"), F.col("gc")), event=F.col("event"), ts=F.col("ts"), is_test=F.col("is_test"),
                pay_status=F.col("pay"), status=F.col("step"))


@pytest.mark.parametrize("block_rows", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("flag_only", [False, True])
def test_first_events_equal_replay(spark, block_rows, flag_only):
    rows = rows_with_hot_key()
    want, _ = replay(rows, flag_only=flag_only)
    out = st.first_events(spark.createDataFrame(rows, SCHEMA), "no", **args(), flag_only=flag_only, block_rows=block_rows)
    got = {r["no"]: (r["first_order_date"], r["reg_date"]) for r in out.collect()}
    assert got == want


def test_stored_state_enters_every_block(spark):
    rows = rows_with_hot_key(seed=5)
    state = {"hot_1": (1_699_000_000, None), "hot_2": (None, 1_700_100_000), "gone_1": (1, 1)}
    want, store = replay(rows, state)
    before = spark.createDataFrame([(k, *v) for k, v in state.items()], "key string, login_ts bigint, order_ts bigint")
    df = spark.createDataFrame(rows, SCHEMA)
    out = st.first_events(df, "no", **args(), state=before, block_rows=16)
    assert {r["no"]: (r["first_order_date"], r["reg_date"]) for r in out.collect()} == want
    final = st.first_event_state(df, **args(), state=before)
    got = {r["key"]: [r["login_ts"], r["order_ts"]] for r in final.collect()}
    assert got == {k: v for k, v in store.items() if v != [None, None]}


def test_batches_through_the_state_table_equal_one_run(spark, tmp_path):
    rows = rows_with_hot_key(seed=9)
    want, store = replay(rows)
    table = StateTable(f"file:{tmp_path}/state", ["key"], ["login_ts", "order_ts"], buckets=3, deltas=2)
    got = {}
    for number, start in enumerate(range(0, 600, 150)):
        part = spark.createDataFrame(rows[start:start + 150], SCHEMA)
        out = st.first_events(part, "no", **args(), state=table.read(spark, number), block_rows=32)
        got.update({r["no"]: (r["first_order_date"], r["reg_date"]) for r in out.collect()})
        for _ in range(2):  # a repeated batch replaces its own rows
            table.append(st.first_event_state(part, **args()), number)
    assert got == want
    final = {r["key"]: [r["login_ts"], r["order_ts"]] for r in table.read(spark).collect()}
    assert final == {k: v for k, v in store.items() if v != [None, None]}


def test_running_minimum_never_rises(spark):
    df = spark.createDataFrame(rows_with_hot_key(seed=3), SCHEMA)
    out = st.prior_minimum(df.select("no", "user", "ts"), ["user"], "no", {"low": F.col("ts")}, block_rows=10)
    last = {}
    for r in sorted(out.collect(), key=lambda r: r["no"]):
        assert r["low"] == last.get(r["user"])
        last[r["user"]] = min(r["ts"], last.get(r["user"], r["ts"]))


def test_new_device_and_first_seen(spark):
    rows = [(i, k, ts) for i, (k, ts) in enumerate([("a", 5), ("a", 7), ("a", 5), ("b", 9), ("a", 3), ("a", 4), ("b", 9)])]
    df = spark.createDataFrame(rows, "no bigint, k string, ts bigint")
    flags = {r["no"]: r["new_device"] for r in st.new_device(df, ["k"], "no", "ts", block_rows=2).collect()}
    assert flags == {0: 1, 1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 1}
    known = spark.createDataFrame([("b",)], "k string")
    seen = {r["no"]: r["new_device"] for r in st.first_seen(df, ["k"], "no", state=known, block_rows=2).collect()}
    assert seen == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0}


def greedy(rows, ttl):
    last, kept = {}, set()
    for key, ts, no in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or ts - last[key] >= ttl:
            last[key] = ts
            kept.add((key, ts, no))
    return kept


@pytest.mark.parametrize("seed,span,ttl", [(1, 600, 300), (2, 1000, 300), (3, 86400, 300), (4, 1300, 650), (5, 400, 1)])
def test_time_window_duplicates_equal_greedy(spark, seed, span, ttl):
    """A key without gaps must be followed across spans exactly."""
    rnd = random.Random(seed)
    rows = [("hot", rnd.randrange(6000), i) for i in range(900)]
    rows += [(f"k{rnd.randrange(5)}", rnd.randrange(20000), 1000 + i) for i in range(300)]
    free = [(None, 5, 5000), (None, 5, 5001), ("hot", None, 5002)]
    df = spark.createDataFrame(rows + free, "key string, ts bigint, no bigint")
    got = [tuple(r) for r in dedupe.dedupe_ttl(df, "key", "ts", "no", ttl=ttl, span=span).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows, ttl) | set(free)


def test_without_a_window_every_row_stays(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("b", 6, 3)], "key string, ts bigint, no bigint")
    for ttl in (0, -1):
        assert dedupe.dedupe_ttl(df, "key", "ts", "no", ttl=ttl).count() == 3


def test_rows_of_one_line_keep_their_order(spark):
    rows = [(2 ** 50 + i // 4, i % 4, "a", 100 - i) for i in range(40)]
    df = spark.createDataFrame(rows, "line bigint, row_no int, k string, ts bigint")
    got = {(r["line"], r["row_no"]): r["low"] for r in st.prior_minimum(df, ["k"], ["line", "row_no"], {"low": F.col("ts")}, block_rows=3).collect()}
    assert got == {(line, n): (None if i == 0 else 101 - i) for i, (line, n, _, _) in enumerate(rows)}


def test_keys_are_shared_where_services_share_them(spark):
    parts = dict(channel_id=F.lit("c"), game_id=F.lit("g"), user_id=F.lit("u"), device_id=F.lit("d"), game_name=F.lit("n"), app_id=F.lit("p"))
    key = lambda service, event: spark.range(1).select(st.service_key(service, F.lit(event), **parts)).first()[0]
    assert key("agent", "login") == key("domestic", "order") == "agent_c_g_u" and key("agent", "active") == "agent_c_d"
    assert key("overseas", "order") == "channel_overseas_g_u" and key("overseas", "crash") == "channel_overseas_g_d"
    assert key("sdk", "login") == "agent_n_p_u" and key("channel", "login") == "agent_channel_gu"


def test_groups_of_the_window_plan_are_bounded(spark):
    """Both sides of the plan are partitioned by key and block, never by the key alone."""
    df = spark.createDataFrame(rows_with_hot_key(50), SCHEMA)
    plan = st.prior_minimum(df.select("no", "user", "ts"), ["user"], "no", {"low": F.col("ts")})._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user" in plan and "_block" in plan
    assert "Join" not in plan


def state_rows(spark, rows):
    return spark.createDataFrame(rows, "key string, login_ts bigint, order_ts bigint")


def test_a_batch_without_manifest_is_no_part_of_the_state(spark, tmp_path):
    table = StateTable(f"file:{tmp_path}/state", ["key"], ["login_ts", "order_ts"])
    table.append(state_rows(spark, [("a", 5, None)]), 0)
    table._write(state_rows(spark, [("a", 1, None)]), "delta-1")  # broke off before its manifest
    assert [tuple(r) for r in table.read(spark).collect()] == [("a", 5, None)]
    table.append(state_rows(spark, []), 1)  # repeated, without rows this time
    assert [tuple(r) for r in table.read(spark).collect()] == [("a", 5, None)]


def test_a_batch_opens_the_buckets_of_its_keys_and_old_files_go(spark, tmp_path):
    table = StateTable(f"file:{tmp_path}/state", ["key"], ["login_ts", "order_ts"], buckets=16, deltas=3)
    keys = [f"k{n}" for n in range(200)]
    for batch in range(7):
        table.append(state_rows(spark, [(k, 100 - batch, None) for k in keys[batch % 2::2]]), batch)
    found = table.read(spark, only=spark.createDataFrame([("k4",)], "key string"))
    assert [tuple(r) for r in found.collect()] == [("k4", 94, None)]
    opened = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(opened) == 1 and len(table.read(spark).inputFiles()) > 8 * len(found.inputFiles())
    folders = {p.parent.name for p in (tmp_path / "state" / "data").glob("*/bucket=*")}
    assert any(f.startswith("base-") for f in folders) and "delta-0" not in folders  # merged, then removed
    assert len(list((tmp_path / "state" / "manifest").glob("version=*"))) <= 2
    before = {tuple(r) for r in table.read(spark, 6).collect()}
    assert before == {(k, 95 if n % 2 else 96, None) for n, k in enumerate(keys)}  # what a repeated batch 6 would read
    assert table.read(spark, only=spark.createDataFrame([], "key string")).count() == 0


def test_expired_rows_are_left_out_and_merged_away(spark, tmp_path):
    table = StateTable(f"file:{tmp_path}/state", ["key"], ["sec"], buckets=1, merge="max", ends=True, deltas=2)
    make = lambda rows: spark.createDataFrame(rows, "key string, sec bigint, expires_at bigint")
    table.append(make([("a", 1, 11), ("b", 2, 12)]), 0)
    table.append(make([("a", 5, 15)]), 1)
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", 5, 15), ("b", 2, 12)}
    assert {tuple(r) for r in table.read(spark, now=12).collect()} == {("a", 5, 15)}
    table.append(make([("c", 20, 30)]), 2, now=12)
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", 5, 15), ("c", 20, 30)}


def test_number_of_buckets_is_part_of_the_state(spark, tmp_path):
    StateTable(f"file:{tmp_path}/state", ["key"], ["login_ts", "order_ts"], buckets=4).append(state_rows(spark, [("a", 5, None)]), 0)
    with pytest.raises(ValueError):
        StateTable(f"file:{tmp_path}/state", ["key"], ["login_ts", "order_ts"], buckets=5).read(spark)


@pytest.mark.parametrize("seed", [1, 2])
def test_window_over_batches_equals_one_run(spark, seed):
    rnd = random.Random(seed)
    rows = sorted({(f"k{rnd.randrange(3)}", rnd.randrange(9000)) for _ in range(500)}, key=lambda r: r[1])
    rows = [(k, t, n) for n, (k, t) in enumerate(rows)]
    got, state = set(), {}
    for start in range(0, len(rows), 120):
        before = spark.createDataFrame(list(state.items()), "key string, sec bigint")
        part = spark.createDataFrame(rows[start:start + 120], "key string, ts bigint, no bigint")
        kept = [tuple(r) for r in dedupe.dedupe_ttl(part, "key", "ts", "no", ttl=300, span=600, state=before).collect()]
        got |= set(kept)
        state.update({k: max(t for j, t, _ in kept if j == k) for k in {k for k, _, _ in kept}})
    assert got == greedy(rows, 300)


def test_window_runs_without_python(spark):
    df = spark.createDataFrame([("hot", t, t) for t in range(0, 5000, 7)], "key string, ts bigint, no bigint")
    out = dedupe.dedupe_ttl(df, "key", "ts", "no", ttl=300, span=600)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "InPandas" not in out._jdf.queryExecution().toString()
    assert [r["ts"] for r in out.orderBy("ts").collect()] == [t for t, in sorted({(x[1],) for x in greedy([("hot", t, t) for t in range(0, 5000, 7)], 300)})]


def test_rows_without_key_spread(spark):
    rows = spark.range(4000).select(F.col("id").alias("no"), F.when(F.col("id") % 4 == 0, F.lit("a")).alias("user"), F.col("id").alias("ts"))
    out = st.prior_minimum(rows, ["user"], "no", {"low": F.col("ts")})
    assert out.where("user IS NULL AND low IS NOT NULL").count() == 0 and out.where("user = 'a' AND low = 0").count() == 999
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [r["count"] for r in st.prior_minimum(rows, ["user"], "no", {"low": F.col("ts")}).where("user IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(parts) < 1000
