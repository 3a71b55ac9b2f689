"""Exact quantiles of a whole column without gathering the column anywhere.

``percentile_approx`` sends one sketch per input split to a single task, which is what limits it
on a very large scan. Here the rank is located by radix selection: every double has a 64-bit image
that sorts as the doubles do, and four narrow scans count its leading 16, 32, 48 and 64 bits. Counts
are added up before they move, and a window never has more than 65,536 rows per quantile, however
many distinct values there are and wherever they lie. Only the first scan works out the image of every
row; the others compare a value with the ends of the part they look into and do so for what lies there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that one histogram tells apart.
DIGIT = 16
_SMALLEST_NORMAL = "pow(2D, -1022)"
_INFINITY = "CAST('Infinity' AS DOUBLE)"


def _power(e: str) -> str:
    """Two to the power e, by a shift where that is exact: pow takes many times as long."""
    return f"CASE WHEN {e} BETWEEN 0 AND 62 THEN CAST(shiftleft(1L, {e}) AS DOUBLE) ELSE pow(2D, {e}) END"


#: The exponent of x: the logarithm may be one off next to a power of two, powers of two are exact.
_GUESS = f"CASE WHEN a >= {_SMALLEST_NORMAL} AND a < {_INFINITY} THEN CAST(floor(log2(a)) AS INT) END"
_EXPONENT = f"CASE WHEN {_power('g')} > a THEN g - 1 WHEN {_power('g + 1')} <= a THEN g + 1 ELSE g END"
#: The bits of x without its sign: exponent, then fraction. Infinity follows the largest number, NaN infinity.
_MAGNITUDE = f"""CASE WHEN isnan(a) THEN shiftleft(2047L, 52) + 1 WHEN a = {_INFINITY} THEN shiftleft(2047L, 52)
    WHEN e IS NULL THEN CAST(a / pow(2D, -1074) AS BIGINT)
    ELSE shiftleft(CAST(e + 1023 AS BIGINT), 52) + CAST((a / {_power('e')} - 1D) * pow(2D, 52) AS BIGINT) END"""

#: The smallest and the largest value of a part.
_ENDS = ("min(x) AS lo", "max(x) AS hi")


def _p(value: float | str) -> str:
    return f"CAST('{value}' AS DECIMAL(12,9))"


def _targets(probs: Sequence[float | str]) -> str:
    """(p, rank) of the requested quantiles whose rank falls to the current histogram row.

    The rank is that of the smallest value whose cumulative share reaches p, in exact arithmetic.
    """
    ps = ", ".join(_p(p) for p in probs)
    rank = "CAST(greatest(1, ceil(p * CAST(total AS DECIMAL(20,0)))) AS BIGINT)"
    return (f"explode(filter(transform(array({ps}), p -> struct(p AS p, {rank} AS rank)),"
            " t -> t.rank > upto - n AND t.rank <= upto))")


def quantiles_from_counts(counts: DataFrame, value: str, n: str, probs: Sequence[float | str]) -> DataFrame:
    """(p, value, above) from a histogram of distinct values with bounded width."""
    cumulated = counts.where(F.col(value).isNotNull()).selectExpr(
        f"{value} AS value", f"{n} AS n", f"sum({n}) OVER (ORDER BY {value}) AS upto", f"sum({n}) OVER () AS total")
    return cumulated.selectExpr("value", "total - upto AS above", f"{_targets(probs)} AS t").selectExpr(
        "t.p AS p", "value", "above")


def exact_quantiles(df: DataFrame, col: Column | str, probs: Sequence[float | str]) -> DataFrame:
    """(p, value, above): for every p the smallest value with at least a share p of the rows at or
    below it, and the number of rows strictly above that value.

    Nulls are ignored. Values are compared as doubles; NaN is above all others.
    """
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    rows = df.select(x.alias("x")).where("x IS NOT NULL")
    counts = with_image(rows).groupBy(F.expr(f"shiftright(image, {64 - DIGIT})").alias("prefix")).agg(
        *map(F.expr, ("count(1) AS n", *_ENDS)))
    targets = counts.selectExpr(
        "lo", "hi", "n", "sum(n) OVER (ORDER BY prefix) AS upto", "sum(n) OVER () AS total",
    ).selectExpr("lo", "hi", "upto - n AS below", "total", f"{_targets(probs)} AS t").selectExpr(
        "t.p AS p", "t.rank AS rank", "lo", "hi", "below", "total")
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        targets = histogram(rows, targets, shift).selectExpr(
            "*", "below + sum(n) OVER (PARTITION BY p ORDER BY prefix) AS upto",
        ).where("rank > upto - n AND rank <= upto").selectExpr("p", "rank", "lo", "hi", "upto - n AS below", "total", "upto")
    return targets.selectExpr("p", "lo AS value", "total - upto AS above")


def with_image(values: DataFrame) -> DataFrame:
    """(x, image): a bigint for every double x that sorts as x does; both zeros have the image 0."""
    rest = values.columns
    guessed = values.selectExpr(*rest, "abs(x) AS a").selectExpr(*rest, "a", f"{_GUESS} AS g")
    return guessed.selectExpr(*rest, "a", f"{_EXPONENT} AS e").selectExpr(*rest, f"{_MAGNITUDE} AS m").selectExpr(
        *rest, "CASE WHEN x < 0 THEN -m ELSE m END AS image")


def histogram(rows: DataFrame, targets: DataFrame, shift: int) -> DataFrame:
    """The next DIGIT bits of the images between each target's ends, counted; at most 65,536 rows per target.

    Images sort as values do, so the values from ``lo`` to ``hi`` are those with the target's leading
    bits. There is one target per requested quantile: always few enough to broadcast.
    """
    place = ["p", "rank", "below", "total"]
    near = rows.join(F.broadcast(targets.select("lo", "hi", *place)), F.expr("x >= lo AND x <= hi")).select("x", *place)
    return with_image(near).groupBy(*place, F.expr(f"shiftright(image, {shift})").alias("prefix")).agg(
        *map(F.expr, ("count(1) AS n", *_ENDS)))


def as_row(quantiles: DataFrame, names: Mapping[str, float | str], field: str = "value") -> DataFrame:
    """One row with one named column per quantile."""
    return quantiles.agg(*[F.expr(f"max(CASE WHEN p = {_p(p)} THEN {field} END) AS {n}") for n, p in names.items()])


def quantile(df: DataFrame, col: Column | str, p: float | str) -> Column:
    """One exact quantile as a scalar subquery, usable inside any expression."""
    return exact_quantiles(df, col, [p]).agg(F.expr("max(value)")).scalar()
