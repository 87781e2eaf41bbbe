"""Relations between pairs of metrics."""

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.schema import CORRELATED

# x, y, and whether y is on a log axis too
RELATIONS = (
    ("view_count_num", "likes_num", True),
    ("view_count_num", "comment_count_num", True),
    ("view_count_num", "engagement_rate", False),
    ("likes_num", "comment_count_num", True),
)


def _moments(df: DataFrame, cols: Sequence[str], pairs) -> DataFrame:
    """Count, means, variances and covariances per pattern of NULLs.

    Within a pattern a column is known in all rows or in none, so 8 variances and 28
    covariances serve every pair; deleting NULLs pair by pair would need both
    variances again for each. There are at most 2^8 patterns, usually two.
    """
    pattern = " + ".join(f"int(isnull({c})) * {2**i}" for i, c in enumerate(cols))
    numbers = [f"CAST({c} AS DOUBLE) AS {c}" for c in cols]
    return (
        df.selectExpr(*numbers, f"{pattern} AS pattern")
        .groupBy("pattern")
        .agg(
            F.count("*").alias("n"),
            *[F.expr(f"avg({c}) AS m_{c}") for c in cols],
            *[F.expr(f"struct(min({c}) AS lo, max({c}) AS hi) AS range_{c}") for c in cols],
            *[F.expr(f"var_pop({c}) AS {c}__{c}") for c in cols],
            *[F.expr(f"covar_pop({a}, {b}) AS {a}__{b}") for a, b in pairs if a != b],
        )
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson's r of all pairs in long form (a, b, r), both ways round.

    Each pair uses the rows where both are known; r is NULL if either is constant
    there. ``corr`` itself raises on a constant column, which dislikes are in crawled
    data. The rows are aggregated once; the rest combines a few pattern rows, by the
    rule for merging moments of disjoint sets.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    cells = ", ".join(
        f"struct('{a}' AS a, '{b}' AS b, IF({a}__{b} IS NULL, NULL, struct(n, "
        f"m_{a} AS x, m_{b} AS y, range_{a} AS rx, range_{b} AS ry, "
        f"{a}__{a} AS vx, {b}__{b} AS vy, {a}__{b} AS c)) AS s)"
        for a, b in pairs
    )
    per_pattern = (
        _moments(df, cols, pairs)
        .selectExpr(f"inline(array({cells}))")
        .selectExpr("a", "b", "s.*")
    )
    known = per_pattern.selectExpr(
        "*",
        "try_divide(sum(n * x) OVER (PARTITION BY a, b), sum(n) OVER (PARTITION BY a, b)) AS mx",
        "try_divide(sum(n * y) OVER (PARTITION BY a, b), sum(n) OVER (PARTITION BY a, b)) AS my",
    )
    r = """CASE WHEN min(rx.lo) < max(rx.hi) AND min(ry.lo) < max(ry.hi)
      THEN try_divide(
        sum(n * (c + (x - mx) * (y - my))),
        sqrt(sum(n * (vx + (x - mx) * (x - mx)))) * sqrt(sum(n * (vy + (y - my) * (y - my)))))
      END"""
    half = known.groupBy("a", "b").agg(F.expr(r).alias("r"))
    return half.selectExpr(
        "inline(IF(a = b, array(struct(a, b, r)), array(struct(a, b, r), struct(b AS a, a AS b, r))))"
    )


def pair_value(matrix: DataFrame, a: str, b: str) -> DataFrame:
    return matrix.filter((F.col("a") == a) & (F.col("b") == b))


def log_density(
    df: DataFrame, relations=RELATIONS, per_decade: int = 4, step: float = 1.0
) -> DataFrame:
    """Scatter plots as counts on a grid: positive values only on a log axis.

    Log axes have ``per_decade`` cells per power of ten, linear ones cells of width
    ``step``. On log axes the result is a few thousand cells at any
    input size; on a linear one as many as its values span steps.
    """

    def log_cell(c: str) -> Column:
        return F.floor(F.log10(F.col(c)) * per_decade)

    points = []
    for x, y, y_log in relations:
        cell = log_cell(y) if y_log else F.floor(F.col(y) / step)
        both = (F.col(x) > 0) & ((F.col(y) > 0) if y_log else F.col(y).isNotNull())
        points.append(
            F.struct(
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                F.when(both, log_cell(x)).alias("x_cell"),
                F.when(both, cell).alias("y_cell"),
            )
        )
    return (
        df.select(F.inline(F.array(*points)))
        .filter(F.col("x_cell").isNotNull())
        .groupBy("x", "y", "x_cell", "y_cell")
        .agg(F.count("*").alias("count"))
    )
