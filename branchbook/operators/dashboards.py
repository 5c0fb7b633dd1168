"""Dashboard datasets (D1-D15) and slicer / security filters.

Every dataset aggregates first (branch x product x month sized results), so
the ordering windows and top-k steps run on small frames; the one frame that
grows with the data (accounts, D13) uses the partitioned running total.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.functions.numeric import dbl, div0
from branchbook.functions.periods import month_number
from branchbook.operators.joins import checked_broadcast, dealt
from branchbook.operators.windows import running_total


def with_product(fact: DataFrame, dim_products: DataFrame, cols: tuple[str, ...] = ("product", "direction")) -> DataFrame:
    """Inner join of facts to product attributes (checked broadcast of the dim)."""
    return fact.join(checked_broadcast(dim_products.select("inc_gk", *cols)), "inc_gk")


def waterfall(by_product: DataFrame, value: str = "revenue", key: str = "product") -> DataFrame:
    """Steps in descending order with their running start and end (few products)."""
    w = Window.orderBy(F.desc(value), key)
    before = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return by_product.withColumn("step_start", F.coalesce(before, F.lit(0))).withColumn(
        "step_end", F.col("step_start") + F.col(value)
    )


def sums_of_many(df: DataFrame, keys: list[str], value: str, rows: int | None = None) -> DataFrame:
    """Sums by keys that are almost as many as the rows: dealt in counted slices first, as a map-side combine would hold each task's rows and save little."""
    return dealt(df.select(*keys, value), keys, rows).groupBy(*keys).agg(F.sum(value).alias(value))


def pivot_sum(df: DataFrame, row: str, col: str, value: str, values: list, many_rows: bool = False) -> DataFrame:
    """Matrix with one column per value of ``col`` (explicit list: no extra job), missing = 0.

    With ``many_rows`` (rows that grow with the data) the sums are dealt by row into counted
    slices before they are spread over the columns, so that the wide rows are made once, where
    they stay. A row of very many facts meets there as its sums, one for each column.
    """
    if not many_rows:
        return df.groupBy(row).pivot(col, values).agg(F.sum(value)).fillna(0)
    n = df.count()
    sums = sums_of_many(df, [row, col], value, n)
    return dealt(sums, [row], n).groupBy(row).pivot(col, values).agg(F.max(value)).fillna(0)


def top_n(df: DataFrame, value: str, n: int, key: str) -> DataFrame:
    """K4: the n largest rows (TakeOrderedAndProject: each task keeps n, then one merge)."""
    return df.orderBy(F.desc(value), key).limit(n)


def top_n_per_group(df: DataFrame, group: str, value: str, n: int, key: str) -> DataFrame:
    """K5: n largest per group; Spark plans ``row_number() <= n`` as a group limit before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.desc(value), key)
    return df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= n)


def cents_squared(value: str = "summa") -> Column:
    """The square of a money value in cents, exact."""
    c = (F.col(value) * F.lit(100)).cast("bigint").cast("decimal(19,0)")
    return c * c


def influencers(fact_p: DataFrame, factors: list[str], branch: str = "filial_id", rows: str | None = None, squares: str | None = None) -> DataFrame:
    """For each factor value, average check in the branch vs the branch's average check, and how sure that is.

    ``t_stat`` and ``welch_df`` are Welch's test of the rows with the factor value against
    the branch's other rows, from counts, sums and sums of squares (null with fewer than
    two rows on a side or no variance). Facts are first reduced to (branch, factor values)
    sums, then unpivoted, so the stack multiplies a small frame, not the facts. ``rows``
    and ``squares`` name columns that say how many facts a row stands for and their
    ``cents_squared``, when the facts come summed up already.
    """
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    sq = F.sum(cents_squared()) if squares is None else F.sum(squares)
    g = fact_p.groupBy(branch, *factors).agg(F.sum("summa").alias("rev"), n.alias("n"), sq.alias("sq"))
    stack = ", ".join(f"'{f}', cast(`{f}` as string)" for f in factors)
    long = g.selectExpr(branch, "rev", "n", "sq", f"stack({len(factors)}, {stack}) as (factor, factor_value)")
    per = long.groupBy(branch, "factor", "factor_value").agg(F.sum("rev").alias("rev"), F.sum("n").alias("n"), F.sum("sq").alias("sq"))
    overall = g.groupBy(branch).agg(F.sum("rev").alias("b_rev"), F.sum("n").alias("b_n"), F.sum("sq").alias("b_sq"))
    j = per.join(F.broadcast(overall), branch)
    avg = div0(dbl("rev"), dbl("n"))

    def side(total: Column, count: Column, squared: Column) -> tuple[Column, Column]:
        """(mean, variance of the mean) in cents."""
        c = dbl(total * F.lit(100))
        return div0(c, count), div0(div0(squared - div0(c * c, count), count - 1), count)

    n1, n2 = dbl("n"), dbl(F.col("b_n") - F.col("n"))
    m1, e1 = side(F.col("rev"), n1, dbl("sq"))
    m2, e2 = side(F.col("b_rev") - F.col("rev"), n2, dbl(F.col("b_sq") - F.col("sq")))
    both = e1 + e2
    return j.select(
        branch, "factor", "factor_value", F.col("n").cast("bigint").alias("rows_cnt"),
        avg.alias("avg_check"),
        div0(avg, div0(dbl("b_rev"), dbl("b_n"))).alias("lift"),
        div0(m1 - m2, F.sqrt(both)).alias("t_stat"),
        div0(both * both, e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)).alias("welch_df"),
    )


def account_pareto(by_account: DataFrame, value: str = "revenue", key: str = "inc_gk") -> DataFrame:
    """Accounts by revenue with the cumulative share; the running sum is partitioned."""
    r = running_total(by_account, value, [F.desc(value), F.asc(key)], out="running")
    grand = by_account.agg(F.sum(value)).scalar()
    return r.withColumn("cumulative_pct", dbl("running") / dbl(grand) * F.lit(100.0))


@dataclass
class Slicers:
    """Optional slicer / bookmark selections; empty fields do not filter.

    Periods also become a filter on ``period_idx``, which partitions the fact, so
    that only their months are read.
    """

    periods: list[str] = field(default_factory=list)
    direction: str | None = None
    sender_category: str | None = None
    filial_ids: list[int] = field(default_factory=list)
    product: str | None = None

    def apply(self, fact: DataFrame, dim_products: DataFrame) -> DataFrame:
        f = fact
        if self.periods:
            f = f.filter(F.col("period").isin(self.periods))
            if "period_idx" in f.columns:
                f = f.filter(F.col("period_idx").isin([month_number(p) for p in self.periods]))
        if self.sender_category is not None:
            f = f.filter(F.col("sender_category") == self.sender_category)
        if self.filial_ids:
            f = f.filter(F.col("filial_id").isin(self.filial_ids))
        p = dim_products.select("inc_gk", "product", "direction")
        if self.direction is not None:
            p = p.filter(F.col("direction") == self.direction)
        if self.product is not None:
            p = p.filter(F.col("product") == self.product)
        return f.join(checked_broadcast(p), "inc_gk")


def row_security(fact: DataFrame, grants: DataFrame, user: str | None = None) -> DataFrame:
    """Facts a user may see: semi-join with the user -> branch grant table.

    With ``user=None`` every user's view is returned (the fact joined to the
    grants; each branch belongs to one region, so each fact appears once per
    user that may see it).
    """
    g = grants if user is None else grants.filter(F.col("user_name") == user)
    if user is not None:
        return fact.join(checked_broadcast(g.select("filial_id")), "filial_id", "left_semi")
    return fact.join(checked_broadcast(g), "filial_id")
