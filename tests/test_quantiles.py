import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles
from tidemark.operators.quantiles import as_row, exact_quantiles, quantile, quantiles_from_counts, with_image

PROBS = ["0", "0.001", "0.25", "0.5", "0.95", "0.999", "1"]


def brute(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(1, math.ceil(float(p) * len(ordered) - 1e-12)) - 1]


def cases():
    rng = random.Random(7)
    return {
        "cents": [round(rng.lognormvariate(3, 1), 2) for _ in range(3000)],
        "signed": [rng.uniform(-5, 5) for _ in range(2000)],
        "one value": [4.25] * 500,
        "a third equal": [1.0] * 700 + [rng.random() * 1e6 for _ in range(1400)],
        "tiny spread": [100 + rng.random() * 1e-6 for _ in range(2000)],
        "outlier": [rng.random() for _ in range(999)] + [1e300, -1e300],
        "nulls": [None, 1.0, None, 2.0, 3.0],
        "single": [-0.5],
    }


@pytest.mark.parametrize("name", list(cases()))
def test_matches_sorted_ranks(spark, name):
    values = cases()[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = {str(r.p.normalize()): r.value for r in exact_quantiles(df, "x", PROBS).collect()}
    assert len(got) == len(PROBS)
    for p in PROBS:
        from decimal import Decimal
        assert got[str(Decimal(p).normalize())] == brute(values, p), p


def test_infinity_and_nan_are_ordered_last(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("nan"),)], "x double")
    got = [r.value for r in exact_quantiles(df, "x", ["0.25", "0.5", "0.75", "1"]).orderBy("p").collect()]
    assert got[:3] == [1.0, 2.0, float("inf")] and math.isnan(got[3])


def test_empty_input_gives_null(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, "x", [0.5]).count() == 0
    assert as_row(exact_quantiles(df, "x", [0.5]), {"q": 0.5}).first().q is None


def test_quantile_as_scalar_needs_no_collect(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    assert df.where(F.col("x") > quantile(df, "x", 0.999)).count() == 1


def test_from_counts(spark):
    counts = spark.createDataFrame([(1, 5), (2, 1), (9, 4)], "v int, n bigint")
    got = {float(r.p): r.value for r in quantiles_from_counts(counts, "v", "n", ["0.5", "0.6", "0.61"]).collect()}
    assert got == {0.5: 1, 0.6: 2, 0.61: 9}


def test_images_are_the_bits_of_doubles(spark):
    """Powers of two and their neighbours, numbers of all sizes, subnormals, both zeros, infinities."""
    rng = random.Random(2)
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]
    values += [y for e in range(-1074, 1024) for x in (math.ldexp(1.0, e),) for y in (x, math.nextafter(x, math.inf), math.nextafter(x, 0))]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64) & ~(1 << 62) if i % 2 else rng.getrandbits(63)))[0] for i in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    values += [-v for v in values]

    def bits(x):
        m = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        return -m if x < 0 else m
    got = with_image(spark.createDataFrame([(v,) for v in values], "x double")).collect()
    assert len(got) == len(values) and all(r.image == bits(r.x) for r in got)


def test_windows_are_bounded_whatever_the_values(spark, monkeypatch):
    """Ten million distinct values within a fraction of a thousandth: no histogram has more than 65,536 rows."""
    df = spark.range(10_000_000).selectExpr("1 + id * 1e-12 AS x")
    widths, plain = [], quantiles.histogram

    def counted(rows, targets, shift):
        out = plain(rows, targets, shift)
        widths.append(out.groupBy("p").count().agg(F.max("count")).first()[0])
        return out
    monkeypatch.setattr(quantiles, "histogram", counted)
    got = [r.value for r in exact_quantiles(df, "x", ["0.5"]).collect()]
    assert got == [1 + 4_999_999 * 1e-12]
    assert len(widths) == 3 and max(widths) <= 65_536


def test_later_passes_look_at_one_part_only(spark):
    """Images are worked out for all rows once; a later pass picks its rows by comparing plain values."""
    rows = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x")
    targets = spark.createDataFrame([(0.5, 1, 512.0, 543.0, 0, 1000)], "p double, rank bigint, lo double, hi double, below bigint, total bigint")
    out = quantiles.histogram(rows, targets, 32)
    assert out.agg(F.sum("n"), F.min("lo"), F.max("hi")).first() == (32, 512.0, 543.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    below = plan[plan.index("join "):]
    assert "log2" in plan and "log2" not in below and "pow" not in below
