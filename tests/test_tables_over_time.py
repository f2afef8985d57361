"""K3 joint refresh, D2 dated snapshots, D6 periods of validity."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators.history import current_state
from strata.operators.periods import dyadic_nodes, events_in_periods
from strata.operators.snapshots import AS_OF, nearest_snapshot, state_at, write_snapshot
from strata.sinks.refresh import ForeignKey, MissingParents, current_paths, read_refreshed, refresh_order, refresh_tables

KEYS = [ForeignKey("line", ("order_id",), "orders", ("id",)), ForeignKey("orders", ("cust",), "customer", ("id",)),
        ForeignKey("customer", ("boss",), "customer", ("id",))]


def rows(spark, table):
    return sorted(map(tuple, table.collect()), key=repr)


def tables(spark, n):
    return {"line": spark.createDataFrame([(i, i % n) for i in range(3 * n)], "id long, order_id long"),
            "orders": spark.createDataFrame([(i, i % 2 if i else None) for i in range(n)], "id long, cust long"),
            "customer": spark.createDataFrame([(0, None), (1, 0)], "id long, boss long")}


def test_order_of_foreign_keys():
    assert refresh_order(["line", "orders", "customer", "alone"], KEYS) == ["alone", "customer", "orders", "line"]
    assert refresh_order([], KEYS) == []
    with pytest.raises(ValueError, match="cycle: .*a.*b"):
        refresh_order(["a", "b"], [ForeignKey("a", ("x",), "b", ("y",)), ForeignKey("b", ("y",), "a", ("x",))])


def test_refresh_is_all_or_none(spark, tmp_dir):
    assert current_paths(spark, tmp_dir) == (0, {})
    with pytest.raises(KeyError):
        read_refreshed(spark, tmp_dir, "orders")
    assert refresh_tables(spark, tmp_dir, tables(spark, 5), KEYS) == 1
    before = {t: rows(spark, read_refreshed(spark, tmp_dir, t)) for t in ("line", "orders", "customer")}
    reader = read_refreshed(spark, tmp_dir, "orders")
    # orphans: refused, with their number
    bad = tables(spark, 3) | {"line": spark.createDataFrame([(1, 0), (2, 77), (3, 78), (4, None)], "id long, order_id long")}
    with pytest.raises(MissingParents, match="2 rows of line") as e:
        refresh_tables(spark, tmp_dir, bad, KEYS)
    assert list(e.value.orphans.values()) == [2]
    # a write that fails in the middle: parents were staged already
    broken = tables(spark, 4)
    broken["line"] = broken["line"].withColumn("order_id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        refresh_tables(spark, tmp_dir, broken, KEYS)
    assert len([f for f in os.listdir(tmp_dir) if f.startswith("refresh=")]) == 3
    assert {t: rows(spark, read_refreshed(spark, tmp_dir, t)) for t in before} == before
    assert current_paths(spark, tmp_dir)[0] == 1
    # parents alone, against the children that stay
    with pytest.raises(MissingParents, match="of orders"):
        refresh_tables(spark, tmp_dir, {"customer": spark.createDataFrame([(0, None)], "id long, boss long")}, KEYS)
    with pytest.raises(MissingParents, match="of line"):
        refresh_tables(spark, tmp_dir, {"orders": tables(spark, 4)["orders"]}, KEYS)
    assert refresh_tables(spark, tmp_dir, tables(spark, 9), KEYS) == 2
    assert read_refreshed(spark, tmp_dir, "line").count() == 27
    assert rows(spark, reader) == before["orders"]  # an old reader still reads
    new = spark.createDataFrame([(0, None), (1, None), (2, 1)], "id long, boss long")
    assert refresh_tables(spark, tmp_dir, {"customer": new}, KEYS) == 3
    assert read_refreshed(spark, tmp_dir, "line").count() == 27 and read_refreshed(spark, tmp_dir, "customer").count() == 3


def ledger(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    data = [(int(rng.integers(30)), int(i), ["INSERT", "UPDATE", "DELETE"][int(rng.integers(3))], f"v{i}" if i % 7 else None, int(rng.integers(0, 20 * 24))) for i in range(n)]
    df = spark.createDataFrame(data, "k long, seq long, op string, v string, h long")
    return df.withColumn("ts", F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, cast(h as int))")).drop("h")


def test_state_from_snapshots_equals_point_in_time(spark, tmp_dir):
    path, led = f"{tmp_dir}/snaps", ledger(spark)
    args = ("k", ["ts", "seq"], "op", ["seq", "v"], "ts")

    def direct(at):
        return rows(spark, current_state(led, "k", ["ts", "seq"], "op", ["seq", "v"], as_of=F.lit(at).cast("timestamp_ntz"), ts="ts"))

    times = ["2024-02-01 00:00:00", "2024-03-04 12:00:00", "2024-03-08 00:00:00", "2024-03-08 00:00:01", "2024-03-30 00:00:00"]
    assert nearest_snapshot(spark, path, times[0]) is None
    for at in times:
        assert rows(spark, state_at(spark, led, path, at, *args)) == direct(at)
    for at in ("2024-03-08 00:00:00", "2024-03-03 00:00:00", "2024-03-15 06:30:00", "2024-03-08 00:00:00"):
        write_snapshot(spark, led, path, at, *args)
    assert sorted(os.listdir(path))[0:0] == [] and sum(f.startswith(AS_OF) for f in os.listdir(path)) == 3
    for at in times:
        assert rows(spark, state_at(spark, led, path, at, *args)) == direct(at)
    assert nearest_snapshot(spark, path, "2024-03-08 00:00:00") == "2024-03-08 00:00:00"
    assert nearest_snapshot(spark, path, "2024-03-08 00:00:00", strictly=True) == "2024-03-03 00:00:00"


def test_only_changes_after_the_snapshot_are_read(spark, tmp_dir):
    led_path, path = f"{tmp_dir}/ledger", f"{tmp_dir}/snaps"
    ledger(spark).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(led_path)
    led = spark.read.parquet(led_path)
    args = ("k", ["ts", "seq"], "op", ["seq", "v"], "ts")
    write_snapshot(spark, led, path, "2024-03-15 00:00:00", *args)
    plan = state_at(spark, led, path, "2024-03-16 00:00:00", *args)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-03-15T00:00)" in plan and "LessThanOrEqual(ts,2024-03-16T00:00)" in plan
    assert f"{AS_OF}" in plan.split("PartitionFilters: [")[2].split("]")[0]


def test_dyadic_nodes_make_up_the_period(spark):
    pairs = [(a, b) for a in range(0, 40, 3) for b in range(0, 66, 5)] + [(0, 1 << 40), (1, (1 << 40) - 1), (12345, 987654321)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", dyadic_nodes(F.col("a"), F.col("b"), 41).alias("n")).collect():
        spans = sorted((x.node << x.level, (x.node + 1) << x.level) for x in r.n)
        if r.a >= r.b:
            assert spans == []
            continue
        assert spans[0][0] == r.a and spans[-1][1] == r.b and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 2 * max(1, (r.b - r.a).bit_length())


@pytest.mark.parametrize("kind", ["long", "timestamp", "timestamp_ntz", "date"])
def test_events_in_periods_equal_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    ev = [(i, "hot" if i % 3 else f"k{i % 5}", int(rng.integers(0, 500))) for i in range(300)] + [(300, "hot", None), (301, None, 5), (5, "hot", 100), (5, "hot", 100)]
    pe = [(i, "hot" if i % 3 else f"k{i % 5}", int(a), int(a + rng.integers(-3, 200))) for i, a in enumerate(rng.integers(0, 500, 120))]
    pe += [(200, "hot", 250, None), (201, "hot", None, 250), (202, "hot", None, None), (203, None, 0, 500), (204, "hot", 10**6, None), (203, "hot", 7, 9), (203, "hot", 7, 9)]

    def typed(df, cols):
        for c in cols:
            x = F.col(c)
            df = df.withColumn(c, x if kind == "long" else F.date_add(F.lit("2024-01-01").cast("date"), x.cast("int")) if kind == "date"
                               else (F.lit("2024-01-01").cast(kind) + F.make_dt_interval(secs=x * F.lit(1.5).cast("decimal(18,6)"))))
        return df

    events = typed(spark.createDataFrame(ev, "e long, g string, at long"), ["at"])
    periods = typed(spark.createDataFrame(pe, "p long, pg string, a long, b long"), ["a", "b"])
    got = events_in_periods(events, periods, "g", "pg", "at", "a", "b")
    want = sorted((e, p) for e, g, t in ev for p, pg, a, b in pe if g is not None and g == pg and t is not None and (a is None or a <= t) and (b is None or t < b))
    assert sorted((r.e, r.p) for r in got.collect()) == want
    assert got.columns == ["e", "g", "at", "p", "pg", "a", "b"]
    assert events_in_periods(events.limit(0), periods, "g", "pg", "at", "a", "b").count() == 0
    assert events_in_periods(events, periods.limit(0), "g", "pg", "at", "a", "b").count() == 0


def test_no_pair_outside_the_overlap_is_formed(spark):
    events = spark.range(2000).select(F.lit("hot").alias("g"), F.col("id").alias("at"))
    periods = spark.range(2000).select(F.lit("hot").alias("pg"), F.col("id").alias("a"), (F.col("id") + 3).alias("b"))
    got = events_in_periods(events, periods, "g", "pg", "at", "a", "b")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.split("\n") if "Join Inner" in line)
    assert ">" not in join and "<" not in join  # equalities alone: each pair that is formed is a match
    assert got.count() == 3 * 2000 - 3


def test_sums_over_periods_form_no_pairs(spark):
    rng = np.random.default_rng(5)
    ev = [("hot" if i % 4 else None, int(t), None if i % 7 == 0 else i) for i, t in enumerate(rng.integers(0, 5000, 1500))]
    pe = [(i % 900, "hot" if i % 5 else None, int(a), None if i % 3 == 0 else int(a + rng.integers(-5, 4000))) for i, a in enumerate(rng.integers(0, 5000, 1000))]
    events, periods = spark.createDataFrame(ev, "g string, at long, x long"), spark.createDataFrame(pe, "p long, pg string, a long, b long")
    held = events_in_periods(events, periods, "g", "pg", "at", "a", "b", {"n": F.lit(1).cast("long"), "total": F.col("x")})
    want = {}
    for p, pg, a, b in pe:
        inside = [x for g, t, x in ev if pg is not None and g == pg and a <= t and (b is None or t < b)]
        if inside:
            n, total = want.get(p, (0, 0))
            want[p] = n + len(inside), total + sum(x or 0 for x in inside)
    assert {r.p: (r.n, r.total or 0) for r in held.groupBy("p").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()} == want
    assert held.columns == ["g", "n", "total", "p", "pg", "a", "b"]
    assert held.count() <= 2 * 13 * len(pe) < sum(n for n, _ in want.values()) / 10  # two nodes a level at most, not a row an event
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert events_in_periods(events.limit(0), periods, "g", "pg", "at", "a", "b", {"n": F.lit(1)}).columns == ["g", "n", "p", "pg", "a", "b"]


def test_no_periods_of_the_events_own_key(spark):
    events, periods = spark.createDataFrame([("a", 1)], "k string, at long"), spark.createDataFrame([("a", 5, 3)], "k string, a long, b long")
    got = events_in_periods(events, periods, "k", "k", "at", "a", "b")
    assert (got.columns, got.count()) == (["k", "at", "a", "b"], 0)
