from pyspark.sql import functions as F

from strata.operators.steps import run_steps, step_aggregate, step_filter, step_join


def _df(spark):
    return spark.createDataFrame(
        [(1, "DELAYED", "A", 5.0), (2, "OK", "B", 7.0), (3, "DELAYED", "a_b", None),
         (4, "LATE", "axb", 1.0)], "id long, status string, loc string, w double")


def test_filter_operators(spark):
    df = _df(spark)
    assert step_filter(df, "status", "EQUALS", "DELAYED").count() == 2
    assert step_filter(df, "w", "GREATER_THAN", 4).count() == 2
    assert step_filter(df, "w", "LESS_THAN", 4).count() == 1
    assert step_filter(df, "w", "IS_NOT_NULL").count() == 3
    # unknown operator falls back to equality
    assert step_filter(df, "status", "STARTS_WITH", "OK").count() == 1


def test_contains_keeps_wildcards(spark):
    df = _df(spark)
    # '_' in the value is a one-character wildcard, as in LIKE '%a_b%'
    got = {r.loc for r in step_filter(df, "loc", "CONTAINS", "a_b").collect()}
    assert got == {"a_b", "axb"}


def test_join_prefixes_clashing_columns(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    right = spark.createDataFrame([(1, "n1", 10)], "id long, name string, v int")
    out = step_join(left, right, "LEFT", "id", "id")
    assert out.columns == ["id", "name", "r_id", "r_name", "v"]
    rows = {r.id: (r.r_name, r.v) for r in out.collect()}
    assert rows == {1: ("n1", 10), 2: (None, None)}


def test_join_types(spark):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(2,), (3,)], "j long")
    assert step_join(left, right, "INNER", "k", "j").count() == 1
    assert step_join(left, right, "RIGHT", "k", "j").count() == 2
    assert step_join(left, right, "FULL", "k", "j").count() == 3


def test_aggregate_alias_and_distinct(spark):
    df = _df(spark)
    out = step_aggregate(df, ["status"], [
        {"column": "id", "function": "COUNT"},
        {"column": "DISTINCT loc", "function": "COUNT", "alias": "n_loc"}])
    assert set(out.columns) == {"status", "count_id", "n_loc"}
    got = {r.status: r.count_id for r in out.collect()}
    assert got == {"DELAYED": 2, "OK": 1, "LATE": 1}


def test_aggregate_without_groups_is_global(spark):
    out = step_aggregate(_df(spark), [], [{"column": "w", "function": "SUM", "alias": "s"}])
    assert out.collect()[0].s == 13.0


def test_pipeline_empty_and_passthrough(spark):
    df = _df(spark)
    tables = {"t": df}
    assert run_steps({"source_dataset": "t", "steps": []}, tables.get).count() == 4
    out = run_steps({"source_dataset": "t", "steps": [{"type": "PIVOT", "config": {}}]},
                    tables.get)
    assert out.count() == 4


def test_filter_then_join_then_count(spark):
    crates = spark.createDataFrame(
        [(11, "HELD", "d3", "customs"), (12, "HELD", "d3", "customs"), (13, "HELD", "d5", "damage"),
         (14, "MOVING", "d3", None), (15, "HELD", "d8", None), (16, None, "d5", "damage")],
        "crate int, stage string, depot string, cause string")
    depots = spark.createDataFrame([("d3", "north"), ("d5", "south")], "depot_id string, zone string")
    # the payload's keys are the fixed input format, the values are ours
    payload = {"source_dataset": "crates", "steps": [
        {"type": "FILTER", "config": {"column": "stage", "operator": "EQUALS", "value": "HELD"}},
        {"type": "JOIN", "config": {"right_dataset": "depots", "type": "LEFT",
                                    "left_key": "depot", "right_key": "depot_id"}},
        {"type": "AGGREGATE", "config": {"group_by": ["zone", "cause"], "aggregations": [
            {"column": "crate", "function": "COUNT", "alias": "held"}]}}]}
    out = run_steps(payload, {"crates": crates, "depots": depots}.get)
    got = {(r.zone, r.cause): r.held for r in out.collect()}
    assert got == {("north", "customs"): 2, ("south", "damage"): 1, (None, None): 1}


def test_outer_join_in_parts_equals_plain_join(spark):
    """The skew-safe outer join (inner + anti joins against distinct keys)
    gives exactly the plain join's rows, NULL keys and repeats included."""
    import random

    from strata.operators.steps import step_join

    rnd = random.Random(3)

    def key():
        r = rnd.random()
        return None if r < 0.1 else (0 if r < 0.5 else rnd.randint(1, 12))  # 0 is hot
    left = spark.createDataFrame([(i, key(), f"l{i}") for i in range(300)],
                                 "id int, k int, v string")
    right = spark.createDataFrame([(j, key(), f"r{j}") for j in range(40)],
                                  "id int, k int, w string")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)
    for how in ("FULL", "LEFT", "RIGHT", "INNER"):
        plain = step_join(left, right, how, "k", "k", skew_safe=False)
        parts = step_join(left, right, how, "k", "k", skew_safe=True)
        assert parts.columns == plain.columns == ["id", "k", "v", "r_id", "r_k", "w"]
        assert rows(parts) == rows(plain), how
    # FULL defaults to the parts form: no full outer join in the plan
    plan = step_join(left, right, "FULL", "k", "k")._jdf.queryExecution().executedPlan()
    assert "FullOuter" not in plan.toString()
