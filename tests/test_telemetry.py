import os

from pyspark.sql import functions as F

from strata.operators.telemetry import (active, breaches, delayed_longer_than, latest_state,
                                        parse_telemetry, sla_kpis)
from strata.streaming.telemetry import current_store, run_to_store, telemetry_stream

CANNED = [
    '{"package_id": "BX-7", "timestamp": "2025-02-03T04:05:06Z", "status": "AT_DOCK"}',
    '{"package_id": "BX-8", "timestamp": "2025-02-03T23:59:59Z", "status": "DELAYED", '
    '"delay_reason": "SNOW"}',
]
EDGE = [
    '{bad json',
    '{"timestamp": "t"}',                                    # missing id
    '{"package_id": "P3", "timestamp": ""}',                 # empty time
    '{"package_id": "P4", "timestamp": "t4", "status": "DELAYED", "delay_reason": null}',
    '{"package_id": 77, "timestamp": "t5"}',                 # numeric id fails hashing
    '{"package_id": "P6", "timestamp": "t6"}',               # no status -> FALSE
    '{"package_id": "P7", "timestamp": 0}',                  # falsy time
    '{"package_id": "P8", "timestamp": 1698400000}',         # truthy numeric time
]


def _parse(spark, msgs):
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    return {r.package_id: r for r in parse_telemetry(df).collect()}


def test_canned_events(spark):
    got = _parse(spark, CANNED)
    a, b = got["BX-7"], got["BX-8"]
    assert a.sla_breach == "FALSE" and a.delay_reason == ""
    assert b.sla_breach == "TRUE" and b.delay_reason == "SNOW"
    import hashlib
    salt = hashlib.md5(b"BX-8").hexdigest()[:4]
    assert b.row_key == f"{salt}#BX-8#2025-02-03T23:59:59Z"


def test_edge_cases(spark):
    got = _parse(spark, EDGE)
    assert set(got) == {"P4", "P6", "P8"}
    assert got["P4"].delay_reason is None        # explicit null stays null
    assert got["P6"].status is None and got["P6"].sla_breach == "FALSE"
    assert got["P6"].delay_reason == ""          # absent -> ''
    assert got["P8"].timestamp == "1698400000"


def test_repeated_key_and_numeric_status(spark):
    # a repeated key keeps its last value, as Python's json.loads does
    got = _parse(spark, ['{"package_id": "A", "package_id": "B", "timestamp": "t1", '
                         '"status": "DELAYED"}',
                         '{"package_id": "C", "timestamp": "t2", "status": 7}'])
    assert set(got) == {"B", "C"}
    assert got["B"].sla_breach == "TRUE" and got["B"].row_key.endswith("#B#t1")
    assert got["C"].status == "7" and got["C"].sla_breach == "FALSE"


def test_bytes_payload(spark):
    df = spark.createDataFrame([(bytearray(CANNED[0].encode()),)], "value binary")
    assert parse_telemetry(df).count() == 1


def test_latest_state_and_kpis(spark):
    ev = spark.createDataFrame(
        [("p1", 1, "IN_TRANSIT"), ("p1", 3, "DELIVERED"), ("p1", 2, "DELAYED"),
         ("p2", 1, "DELAYED"), ("p2", 1, "AT_HUB")],
        "package_id string, ts int, status string").withColumn(
        "sla_breach", F.when(F.col("status") == "DELAYED", "TRUE").otherwise("FALSE"))
    latest = {r.package_id: r.status for r in
              latest_state(ev, "package_id", ["ts", "status"], ["status"]).collect()}
    assert latest == {"p1": "DELIVERED", "p2": "DELAYED"}  # tie broken by next order column
    k = sla_kpis(ev).first()
    assert (k.active, k.breaches) == (4, 2)
    assert breaches(ev).count() == 2 and active(ev).count() == 4


def test_delayed_longer_than(spark):
    rows = [("a", "2024-01-01 00:00:00", "IN_TRANSIT"), ("a", "2024-01-01 01:00:00", "DELAYED"),
            ("a", "2024-01-01 02:00:00", "DELAYED"),
            ("b", "2024-01-01 00:00:00", "DELAYED"), ("b", "2024-01-01 04:00:00", "AT_HUB"),
            ("c", "2024-01-01 03:30:00", "DELAYED"), ("d", "2024-01-01 05:00:00", "IN_TRANSIT")]
    ev = spark.createDataFrame(rows, "pkg string, ts string, status string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    got = {r.pkg: r.hours_delayed for r in
           delayed_longer_than(ev, "pkg", "ts", "status", 2.0).collect()}
    # as of 05:00: a delayed since 01:00 (4h), c since 03:30 (1.5h), b recovered
    assert got == {"a": 4.0}


def test_stream_equals_batch_and_store_is_idempotent(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.json"), "w") as f:
        f.write("\n".join(CANNED + EDGE) + "\n")
    store = os.path.join(tmp_dir, "store")
    ckpt = os.path.join(tmp_dir, "ckpt")
    q = run_to_store(telemetry_stream(spark, src), store, ckpt)
    q.awaitTermination(120)
    batch = parse_telemetry(spark.read.text(src))
    cur = current_store(spark, store)
    cols = ["row_key", "package_id", "status", "sla_breach", "timestamp", "delay_reason"]
    assert sorted(map(tuple, cur.select(cols).collect())) == sorted(
        map(tuple, batch.select(cols).collect()))
    # a second file with a repeated message: the key maps to one row
    with open(os.path.join(src, "part-1.json"), "w") as f:
        f.write(CANNED[1] + "\n")
    q = run_to_store(telemetry_stream(spark, src), store, ckpt)
    q.awaitTermination(120)
    assert current_store(spark, store).count() == cur.count()


def test_stream_latest_per_package_update_mode(spark, tmp_dir):
    from strata.streaming.telemetry import latest_per_package
    src = os.path.join(tmp_dir, "in2")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([
            '{"package_id": "P1", "timestamp": "2024-01-01T01:00:00Z", "status": "IN_TRANSIT"}',
            '{"package_id": "P1", "timestamp": "2024-01-01T03:00:00Z", "status": "DELAYED"}',
            '{"package_id": "P2", "timestamp": "2024-01-01T02:00:00Z", "status": "AT_HUB"}']) + "\n")
    q = (latest_per_package(telemetry_stream(spark, src)).writeStream.outputMode("update")
         .format("memory").queryName("latest_pkg")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck2"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.package_id: (r.status, r.sla_breach) for r in spark.table("latest_pkg").collect()}
    assert got == {"P1": ("DELAYED", "TRUE"), "P2": ("AT_HUB", "FALSE")}


def test_stream_delay_state_matches_batch(spark, tmp_dir):
    from strata.streaming.delays import current_delay_state, delayed_packages, run_delay_state
    src = os.path.join(tmp_dir, "in3")
    os.makedirs(src)

    def msg(p, t, s):
        return '{"package_id": "%s", "timestamp": "2024-01-01T%s:00Z", "status": "%s"}' % (p, t, s)
    first = [msg("A", "01:00", "IN_TRANSIT"), msg("A", "02:00", "DELAYED"),
             msg("B", "01:00", "DELAYED"), msg("C", "00:30", "DELAYED")]
    second = [msg("A", "05:00", "DELAYED"), msg("B", "02:00", "AT_HUB"),
              msg("C", "01:00", "IN_TRANSIT"), msg("C", "03:00", "DELAYED"),
              msg("D", "04:00", "DELAYED")]
    store, ckpt = os.path.join(tmp_dir, "dstore"), os.path.join(tmp_dir, "dck")
    for i, lines in enumerate((first, second)):
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        run_delay_state(telemetry_stream(spark, src), store, ckpt).awaitTermination(120)
    state = current_delay_state(spark, store)
    as_of = F.lit("2024-01-01 06:00:00").cast("timestamp")
    got = {r.package_id: r.hours_delayed for r in delayed_packages(state, 2.0, as_of).collect()}
    # batch operator over all events agrees
    ev = parse_telemetry(spark.read.text(src)).withColumn("ts", F.to_timestamp("timestamp"))
    want = {r.package_id: r.hours_delayed for r in
            delayed_longer_than(ev, "package_id", "ts", "status", 2.0, as_of=as_of).collect()}
    # A delayed since 02:00, C since 03:00; D (04:00) is at exactly 2 hours
    assert got == want == {"A": 4.0, "C": 3.0}


def test_stream_delay_state_over_batches(spark, tmp_dir):
    """One batch after another, the state equals the batch operator."""
    from strata.streaming.delays import current_delay_state, delayed_packages, run_delay_state
    src = os.path.join(tmp_dir, "in4")
    os.makedirs(src)

    def msg(p, t, s):
        return '{"package_id": "%s", "timestamp": "2024-01-01T%s:00Z", "status": "%s"}' % (p, t, s)
    rounds = [
        [msg("A", "01:00", "IN_TRANSIT"), msg("B", "01:00", "DELAYED")],
        [msg("A", "02:00", "DELAYED"), msg("C", "00:30", "DELAYED")],
        [msg("B", "02:00", "AT_HUB"), msg("C", "01:00", "IN_TRANSIT")],
        [msg("C", "03:00", "DELAYED"), msg("A", "05:00", "DELAYED"), msg("B", "03:30", "DELAYED")],
        [msg("D", "04:00", "DELAYED")],
    ]
    store, ckpt = os.path.join(tmp_dir, "sstore"), os.path.join(tmp_dir, "sck")
    for i, lines in enumerate(rounds):
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        run_delay_state(telemetry_stream(spark, src), store, ckpt).awaitTermination(120)
    as_of = F.lit("2024-01-01 06:00:00").cast("timestamp")
    state = current_delay_state(spark, store)
    got = {r.package_id: r.hours_delayed for r in delayed_packages(state, 2.0, as_of).collect()}
    ev = parse_telemetry(spark.read.text(src)).withColumn("ts", F.to_timestamp("timestamp"))
    want = {r.package_id: r.hours_delayed for r in
            delayed_longer_than(ev, "package_id", "ts", "status", 2.0, as_of=as_of).collect()}
    assert got == want == {"A": 4.0, "C": 3.0, "B": 2.5}


def test_changes_are_replaced_by_a_replayed_batch(spark, tmp_dir):
    from strata.streaming.changes import merge_changes, newest, read_changes, write_changes
    root = os.path.join(tmp_dir, "kv")
    rounds = [[("a", 1), ("b", 1)], [("a", 2)], [("c", 1), ("b", 3)], [("a", 4)], [("d", None)]]
    assert read_changes(spark, root) is None
    write = write_changes(root)
    for e, rows in enumerate(rounds):
        write(spark.createDataFrame(rows, "k string, v long"), e)
    want = {"a": 4, "b": 3, "c": 1, "d": None}
    assert {r.k: r.v for r in newest(read_changes(spark, root), "k").collect()} == want
    write(spark.createDataFrame(rounds[2], "k string, v long"), 2)  # replayed: its own partition alone
    assert read_changes(spark, root).count() == 7
    assert {r.k: r.v for r in newest(read_changes(spark, root), "k").collect()} == want
    target = spark.createDataFrame([("a", 0), ("d", 9), ("z", 7)], "k string, v long")
    assert {r.k: r.v for r in merge_changes(target, read_changes(spark, root), "k").collect()} == {**want, "z": 7}


def test_stream_store_replay_and_disorder(spark, tmp_dir):
    """The store equals the batch result whatever the batches, their order and their repeats."""
    rows = ['{"package_id": "P%d", "timestamp": "2024-01-01T0%d:00:00Z", "status": "%s"}' % (p, t, s)
            for p in range(3) for t in range(4) for s in ("DELAYED", "AT_HUB")]
    seen = []
    for k, order in enumerate((rows, rows[::-1] + rows[3:9])):
        src, store = os.path.join(tmp_dir, f"src{k}"), os.path.join(tmp_dir, f"store{k}")
        os.makedirs(src)
        for i in range(0, len(order), 5):
            with open(os.path.join(src, f"p{i:02d}.json"), "w") as f:
                f.write("\n".join(order[i:i + 5]) + "\n")
        from strata.streaming.telemetry import read_messages
        run_to_store(parse_telemetry(read_messages(spark, src, max_files_per_trigger=1)), store,
                     os.path.join(tmp_dir, f"ck{k}")).awaitTermination(120)
        assert len(os.listdir(store)) > 3  # a partition a batch
        seen.append(sorted(map(tuple, current_store(spark, store).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 12
    assert current_store(spark, os.path.join(tmp_dir, "none")) is None


def test_stream_latest_and_deduplicated(spark, tmp_dir):
    from strata.streaming.telemetry import current_latest, deduplicated, run_latest
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)

    def msg(p, t, s):
        return '{"package_id": "%s", "timestamp": "2024-01-01T%s:00Z", "status": "%s"}' % (p, t, s)
    path, ckpt = os.path.join(tmp_dir, "latest"), os.path.join(tmp_dir, "lk")
    for i, lines in enumerate(([msg("A", "05:00", "DELAYED"), msg("B", "01:00", "AT_HUB")],
                               [msg("A", "04:00", "AT_HUB"), msg("A", "05:00", "DELAYED"), msg("B", "02:00", "DELIVERED")])):
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        run_latest(telemetry_stream(spark, src), path, ckpt).awaitTermination(120)
    assert {r.package_id: r.status for r in current_latest(spark, path).collect()} == {"A": "DELAYED", "B": "DELIVERED"}
    out = os.path.join(tmp_dir, "once")
    (deduplicated(telemetry_stream(spark, src)).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", os.path.join(tmp_dir, "dk")).trigger(availableNow=True).start().awaitTermination(120))
    assert spark.read.parquet(out).count() == 4


def test_advance_equals_batch_in_any_order(spark):
    """Events in any order within the watermark's delay leave the state that all of them at once leave."""
    import numpy as np
    from strata.streaming.delays import advance
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, delay = int(rng.integers(1, 40)), int(rng.integers(0, 12))
        times = np.sort(rng.integers(0, 60, n))
        statuses = np.where(rng.random(n) < 0.7, "DELAYED", "AT_HUB").astype(object)
        order = np.argsort(times + rng.integers(0, delay + 1, n), kind="stable")  # at most ``delay`` late
        state, top = None, -10**9
        for part in np.array_split(order, int(rng.integers(1, n + 1))):
            if len(part):
                state = advance(state, times[part], statuses[part], top - delay)
                top = max(top, int(times[part].max()))
        whole = advance(None, times, statuses, -10**9)
        assert (state[0], state[1][:1], state[2], state[3]) == (whole[0], whole[1][:1], whole[2], whole[3])
        assert len(state[1]) <= 1 + sum(t >= top - 2 * delay - 60 for t in times)
        ok = times[statuses != "DELAYED"]
        later = times[(statuses == "DELAYED") & (times > (ok.max() if len(ok) else -1))]
        assert whole[1][:1] == later[:1].tolist()


def test_one_call_takes_all_packages_of_a_bucket():
    """Packages that share a bucket, over several calls and chunks: each has the state that it has alone, and only changed ones are returned."""
    import numpy as np
    import pandas as pd
    from strata.streaming.delays import _NO_TIME, _update, advance

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

        def getCurrentWatermarkMs(self):
            return 0

    rng, state, alone, last = np.random.default_rng(3), State(), {}, {}
    names = np.array(["A", "B", "C", None, "D"], object)
    for call in range(6):
        frames = []
        for _ in range(3):
            n = int(rng.integers(0, 9))
            f = pd.DataFrame({"package_id": names[rng.integers(0, 4 if call % 2 else 5, n)], "ts": rng.integers(1, 40, n) * 1_000_000,
                              "status": rng.choice(np.array(["DELAYED", "AT_HUB"], object), n)})
            frames.append(f)
        seen = set()
        for f in frames:
            for p in dict.fromkeys(f["package_id"]):
                mine = f[f["package_id"].isna() if p is None else f["package_id"] == p]
                alone[p] = advance(alone.get(p), mine["ts"].to_numpy(np.int64), mine["status"].to_numpy(object), 0)
                seen.add(p)
        out = pd.concat([pd.DataFrame(), *_update((7,), frames, state)])
        got = {r.package_id: (r.current_status, r.last_ok, r.delayed_since, r.latest) for r in out.itertuples()}
        assert got == {p: (s, _NO_TIME if ok is None else ok, held[0] if s == "DELAYED" and held else _NO_TIME, top)
                       for p in seen for ok, held, top, s in [alone[p]]}
        if alone:
            last = {p: tuple(now) for p, *now in zip(*state.get)}
        assert last == alone


def test_stream_delays_out_of_order(spark, tmp_dir):
    """A late event that ends a delay in its middle moves the start of the delay."""
    from strata.streaming.delays import current_delay_state, delayed_packages, run_delay_state
    src, store, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "store", "ck"))
    os.makedirs(src)

    def msg(p, t, s):
        return '{"package_id": "%s", "timestamp": "2024-01-01T%s:00Z", "status": "%s"}' % (p, t, s)
    rounds = [[msg("A", "01:00", "DELAYED"), msg("A", "03:00", "DELAYED"), msg("B", "05:00", "AT_HUB")],
              [msg("A", "02:00", "AT_HUB"), msg("B", "01:00", "DELAYED"), msg("C", "09:00", "DELAYED")],
              [msg("A", "03:00", "DELAYED"), msg("C", "08:00", "DELAYED"), "not json"]]
    for i, lines in enumerate(rounds):
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        run_delay_state(telemetry_stream(spark, src), store, ckpt).awaitTermination(120)
    as_of = F.lit("2024-01-01 12:00:00").cast("timestamp")
    got = {r.package_id: r.hours_delayed for r in delayed_packages(current_delay_state(spark, store), 2.0, as_of).collect()}
    assert got == {"A": 9.0, "C": 4.0}
    assert current_delay_state(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_delay_hours_on_local_times_ignore_the_session_zone(spark):
    """Local (NTZ) event times: hours delayed are wall-clock hours in any
    session time zone, also across a daylight-saving change."""
    from strata.functions.clock import epoch_micros
    ev = spark.sql("""
        SELECT * FROM VALUES
          ('p', TIMESTAMP_NTZ'2024-03-10 00:30:00', 'IN_TRANSIT'),
          ('p', TIMESTAMP_NTZ'2024-03-10 01:00:00', 'DELAYED'),
          ('q', TIMESTAMP_NTZ'2024-03-10 04:00:00', 'AT_HUB') AS t(pkg, ts, status)""")
    fine = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 04:00:00.250001' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = {}
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got[zone] = [(r.pkg, r.hours_delayed) for r in
                         delayed_longer_than(ev, "pkg", "ts", "status", 2.0).collect()]
            micros = fine.select(epoch_micros(F.col("ts"), fine.schema["ts"].dataType)
                                 .alias("m")).first().m
            assert micros == 1710043200250001, zone  # 2024-03-10 04:00:00.250001 wall clock
        assert got["UTC"] == got["America/New_York"] == [("p", 3.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
