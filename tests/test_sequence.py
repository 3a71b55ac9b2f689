import random
import time

import pytest

from tidemark.operators.sequence import SkewPolicy, has_heavy_key, in_cells, with_neighbor

CUT_ALL = SkewPolicy(heavy_rows=10, sample_every=1, cell_rows=20)


def data(seed=3, n=900):
    """A third of all rows belong to key 1; some share a time; some have no key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, 5, None, 100 + i])
        out.append((key, rng.randrange(0, 400), i, f"v{i}"))
    return out


def brute(rows, forward):
    out, groups = {}, {}
    for k, t, i, v in rows:
        groups.setdefault(k, []).append((t, i, v))
    for group in groups.values():
        group.sort()
        for pos, (t, i, v) in enumerate(group):
            other = pos + 1 if forward else pos - 1
            out[i] = (group[other][1], group[other][2]) if 0 <= other < len(group) else None
    return out


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("policy", [SkewPolicy(), CUT_ALL, SkewPolicy(10, 2, 5), SkewPolicy(10, 4, 100)])
def test_neighbours_do_not_depend_on_cuts(spark, forward, policy):
    rows = data()
    df = spark.createDataFrame(rows, "k int, t int, i int, v string").repartition(5)
    got = with_neighbor(df, "k", ["t", "i"], ["i", "v"], "n", forward, policy).select("i", "n").collect()
    assert len(got) == len(rows)
    want = brute(rows, forward)
    for r in got:
        assert (tuple(r.n) if r.n else None) == want[r.i]


def test_string_keys_and_empty_string_is_not_null(spark):
    rows = [("", 1, 1), ("", 2, 2), (None, 1, 3), (None, 5, 4), ("a", 1, 5)] * 1
    df = spark.createDataFrame(rows, "k string, t int, i int")
    got = {r.i: r.n.i if r.n else None
           for r in with_neighbor(df, "k", ["t", "i"], ["i"], "n", policy=SkewPolicy(0, 1, 1)).collect()}
    assert got == {1: None, 2: 1, 3: None, 4: 3, 5: None}


@pytest.mark.parametrize(("heavy_rows", "heavy"), [(250, True), (299, True), (300, False), (1000, False)])
def test_heavy_keys_are_found_by_their_rows(spark, heavy_rows, heavy):
    df = spark.createDataFrame(data(), "k int, t int, i int, v string")
    assert has_heavy_key(df, "k", ["t", "i"], SkewPolicy(heavy_rows, 1, 10)) == heavy


def cells(df, policy, order=("t", "i")):
    """Rows per cell as the window sees them, the carried one not counted."""
    return [r["count"] for r in in_cells(df, "k", list(order), policy).groupBy("_cell").count().collect()]


def test_many_heavy_keys_make_even_cells(spark):
    df = spark.range(60_000).selectExpr("CAST(id % 1500 AS INT) AS k", "CAST(id AS INT) AS t", "CAST(id AS INT) AS i")
    sizes = cells(df, SkewPolicy(20, 1, 5))
    assert max(sizes) == 5 and len(sizes) < 60_000 / 5 + 2 * df.rdd.getNumPartitions() + 10


@pytest.mark.parametrize("at", ["0", "NULL", "IF(id % 1000 = 0, 2000000000, id)", "IF(id % 3 = 0, NULL, id % 7)"])
def test_cells_are_even_whatever_the_times(spark, at):
    """All rows at one time or at none, far outliers, few distinct values."""
    df = spark.range(40_000).selectExpr("1 AS k", f"CAST({at} AS INT) AS t", "CAST(id AS INT) AS i")
    policy = SkewPolicy(1000, 1, 1000)
    assert max(cells(df, policy)) <= 1000
    got = with_neighbor(df, "k", ["t", "i"], ["i"], "n", policy=policy)
    plain = with_neighbor(df, "k", ["t", "i"], ["i"], "n")
    assert got.select("i", "n.i").exceptAll(plain.select("i", "n.i")).isEmpty() and got.count() == 40_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_key_is_spread_over_window_groups(spark):
    """The plan partitions by cell: no window group holds the whole heavy key, and no row carries cut points."""
    df = spark.createDataFrame(data(), "k int, t int, i int, v string")
    out = with_neighbor(df, "k", ["t", "i"], ["i"], "n", policy=CUT_ALL)
    window = [line for line in plan_of(out).splitlines() if "Window [lag" in line]
    assert window and all("_cell" in line for line in window)
    assert "array" not in out._jdf.queryExecution().optimizedPlan().toString() and "Join" not in plan_of(out)


def test_number_of_cells_costs_nothing(spark):
    """One key of 200,000 rows in 100 and in 20,000 cells: hardly more time."""
    df = spark.range(200_000).selectExpr("1 AS k", "CAST(id * 7919 % 200000 AS INT) AS t", "id AS i")

    def seconds(cell_rows):
        start = time.perf_counter()
        out = with_neighbor(df, "k", ["t", "i"], ["i"], "n", policy=SkewPolicy(1000, 16, cell_rows))
        assert out.where("n IS NULL").count() == 1
        return time.perf_counter() - start
    seconds(2000)
    few, many = (min(seconds(n) for _ in range(3)) for n in (2000, 10))
    assert many < 1.5 * few


def test_columns_of_input_survive_unchanged(spark):
    df = spark.createDataFrame(data(n=30), "k int, t int, i int, v string")
    assert with_neighbor(df, "k", ["t", "i"], ["v"], "n").columns == ["k", "t", "i", "v", "n"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double"])
def test_cells_follow_the_order_for_every_type(spark, kind):
    """Neighbours of a cut key by dates, times in a zone with clock changes, and fractions."""
    rows = [(1, x, i) for i, x in enumerate(random.Random(4).choices(range(0, 90 * 48), k=400))]
    df = spark.createDataFrame(rows, "k int, x int, i int")
    start = "timestamp'2024-02-15 00:00:00'" if kind == "timestamp" else "timestamp_ntz'2024-02-15 00:00:00'"
    at = {"double": "x / 7.0", "date": "date_add(date'2024-02-15', CAST(x / 48 AS INT))"}.get(
        kind, f"{start} + make_dt_interval(0, 0, x * 30)")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        timed = df.selectExpr("k", f"{at} AS t", "i")
        plain = with_neighbor(timed, "k", ["t", "i"], ["i"], "n").select("i", "n.i").collect()
        cut = with_neighbor(timed, "k", ["t", "i"], ["i"], "n", policy=CUT_ALL).select("i", "n.i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, cut), key=repr)
    assert sum(r[1] is None for r in cut) == 1


def test_heavy_key_without_order_values(spark):
    df = spark.createDataFrame([(1, None, i) for i in range(30)], "k int, t int, i int")
    got = with_neighbor(df, "k", ["t", "i"], ["i"], "n", policy=CUT_ALL).collect()
    assert sorted((r.i, r.n.i if r.n else -1) for r in got) == [(i, i - 1) for i in range(30)]


def test_without_heavy_keys_only_the_window_remains(spark):
    df = spark.createDataFrame(data(), "k int, t int, i int, v string")
    out = with_neighbor(df, "k", ["t", "i"], ["i"], "n")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Window [lag" in final and "Join" not in final


def test_only_sampled_rows_are_asked_whether_they_count(spark):
    """The sample comes first: a costly condition is evaluated for one row in so many."""
    from pyspark.sql import functions as F
    asked = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counts(x):
        asked.add(1)
        return x % 2 == 0
    df = spark.range(0, 20_000, 1, 4).selectExpr("1 AS k", "id")
    assert has_heavy_key(df, "k", ["id"], SkewPolicy(heavy_rows=5_000, sample_every=16), counts("id"))
    assert 0 < asked.value < 2_500
    assert not has_heavy_key(df, "k", ["id"], SkewPolicy(heavy_rows=5_000, sample_every=16), F.col("id") % 16 == 0)
