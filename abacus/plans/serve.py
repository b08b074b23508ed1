"""Serving: ordered reads, chart series, overview labels, per-year report blocks.

Every report is written by one job over all years (``budget_year`` stays a column
and partitions the output), never a driver loop of one query per year and block.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacus.functions import month_label, strip_emoji, to_units
from abacus.operators import nonfinite_to_null, to_series

# Stored order of each model, applied when it is served. Ascending keys
# put NULLs last (the reference's engine does; Spark's default is first).
MODEL_ORDER = {
    "cleaned.transactions": [("transaction_date", "desc"), ("amount", "desc")],
    "cleaned.category_orders": [("order_id", "asc")],
    "combined.budgeted": [("budget_month", "desc"), ("category_id", "desc")],
    "combined.paystubs": [("pay_date", "desc")],
    "combined.transactions": [("transaction_date", "desc")],
    "combined.yearly_budgeted": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.monthly_level": [("budget_month", "desc")],
    "dashboards.yearly_level": [("budget_year", "desc")],
    "dashboards.yearly_category_group": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.yearly_subcategory_group": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.yearly_needs": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.yearly_wants": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.yearly_other": [("budget_year", "asc"), ("order_id", "asc")],
    "dashboards.yearly_paychecks": [("budget_year", "asc"), ("order_id", "asc")],
}


def sort_columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if d == "asc" else F.col(c).desc_nulls_last() for c, d in order]


def ordered(df: DataFrame, model: str) -> DataFrame:
    """A model in its stored order (a range-partitioned sort; use on served, aggregated data)."""
    return df.orderBy(*sort_columns(MODEL_ORDER[model]))


def with_position(df: DataFrame, model: str, col: str = "position", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Make the served order explicit as a 1-based column (``tiebreak`` makes it total)."""
    from abacus.operators import positions
    order = sort_columns(list(MODEL_ORDER[model]) + [(c, "asc") for c in tiebreak])
    return positions(df, order, col)


def in_units(df: DataFrame) -> DataFrame:
    """Money columns (integer thousandths) -> DOUBLE units; everything else unchanged."""
    from pyspark.sql.types import IntegralType
    from abacus.plans.models import money_columns
    money = money_columns()
    fixes = {f.name: to_units(F.col(f"`{f.name}`")) for f in df.schema.fields
             if f.name in money and isinstance(f.dataType, IntegralType)}
    return df.withColumns(fixes) if fixes else df


def served(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """What a report reads: optional predicate, money in units, non-finite numbers as NULL."""
    if where is not None and not (isinstance(where, str) and where == ""):
        df = df.where(where)
    return nonfinite_to_null(in_units(df))


def clean_category_names(df: DataFrame, col: str = "category_name") -> DataFrame:
    return df.withColumn(col, strip_emoji(col))


# Report column titles of the overview sheets, after the grain label.
OVERVIEW_TITLES = [
    "Pre-Tax Earnings", "Salary", "Bonus", "Pre-Tax Deductions", "Taxes",
    "Retirement Fund Contribution", "HSA Contribution", "Post-Tax Deductions", "Total Deductions",
    "Net Pay", "Reimbursed Income", "Miscellaneous Income", "Total Income (Net to Account)",
    "Needs Spend", "Wants Spend", "Savings Spend", "Emergency Fund Spend", "Savings Saved",
    "Emergency Fund Saved", "Investments Saved", "Emergency Fund in HSA", "Total Spend", "Net Income",
]


def overview_labels(level: DataFrame, grain: str) -> DataFrame:
    """Monthly or yearly level with report titles; months shown as ``M/yyyy``."""
    from abacus.plans.models import LEVEL_MEASURES
    key = "budget_month" if grain == "monthly" else "budget_year"
    label = "Month" if grain == "monthly" else "Year"
    first = month_label(key) if grain == "monthly" else F.col(key)
    return level.select(first.alias(label),
                        *[to_units(m).alias(t) for m, t in zip(LEVEL_MEASURES, OVERVIEW_TITLES)])


def dashboard_extract(level: DataFrame, key: str) -> DataFrame:
    """Every measure of the chart pages (salary and bonus included: the monthly income chart uses them)."""
    from abacus.plans.models import LEVEL_MEASURES
    return level.select(key, *[to_units(m).alias(m) for m in LEVEL_MEASURES])


def _c(name: str) -> Column:
    return F.col(name)


# The chart series of the monthly and yearly pages
# (series name -> (label column, value column, [(label, expression)])).
CHART_SERIES = {
    "overview": ("value_type", "value", [
        ("Pre-Tax Earnings", lambda: _c("earnings_actual")),
        ("Net Pay", lambda: _c("net_pay") + (_c("retirement_fund") + _c("hsa")) * -1),
        ("Spend", lambda: _c("spent") * -1),
    ]),
    "monthly_income": ("income_type", "income_amount", [
        ("Salary", lambda: _c("salary")),
        ("Bonus", lambda: _c("bonus")),
        ("Miscellaneous Income", lambda: _c("misc_income")),
    ]),
    "yearly_income": ("income_type", "income_amount", [
        ("Pre Tax Earnings", lambda: _c("earnings_actual")),
        ("Miscellaneous Income", lambda: _c("misc_income")),
    ]),
    "paycheck_breakdown": ("breakdown_category", "amount", [
        ("Net Pay", lambda: _c("net_pay")),
        ("Pre-Tax Deductions", lambda: _c("pre_tax_deductions") * -1),
        ("Taxes", lambda: _c("taxes") * -1),
        ("Retirement Fund Contribution", lambda: _c("retirement_fund") * -1),
        ("HSA Contribution", lambda: _c("hsa") * -1),
        ("Post-Tax Deductions", lambda: _c("post_tax_deductions") * -1),
    ]),
    "spending_breakdown": ("spending_category", "amount", [
        ("Needs", lambda: _c("needs_spend")),
        ("Wants", lambda: _c("wants_spend")),
        ("Savings", lambda: _c("savings_spend")),
        ("Emergency Fund", lambda: _c("emergency_fund_spend")),
    ]),
}
# Page -> the series it draws.
PAGE_SERIES = {
    "monthly": ["overview", "monthly_income", "paycheck_breakdown", "spending_breakdown"],
    "yearly": ["overview", "yearly_income", "paycheck_breakdown", "spending_breakdown"],
}


def chart_series(level: DataFrame, key: str, series: str) -> DataFrame:
    """One chart's long-form data: a single unpivot scan instead of a UNION ALL per label."""
    label_col, value_col, spec = CHART_SERIES[series]
    return to_series(level, [key], [(label, to_units(make())) for label, make in spec], label_col, value_col)


# The per-year category report, block -> (source model, [(column, title)]).
YEAR_BLOCKS = {
    "needs": ("dashboards.yearly_needs",
              [("subcategory_group", "Subcategory Group"), ("category_name", "Needs"), ("spend", "Spend")]),
    "wants": ("dashboards.yearly_wants",
              [("subcategory_group", "Subcategory Group"), ("category_name", "Wants"), ("spend", "Spend")]),
    "other": ("dashboards.yearly_other",
              [("category_name", "Other"), ("assigned", "Assigned"), ("spend", "Spend")]),
    "category_group": ("dashboards.yearly_category_group",
                       [("category_group_name_mapping", "Category Group"), ("assigned", "Assigned"),
                        ("spend", "Spend")]),
    "subcategory_group": ("dashboards.yearly_subcategory_group",
                          [("subcategory_group", "Subcategory Group"), ("assigned", "Assigned"),
                           ("spend", "Spend")]),
    "paychecks": ("dashboards.yearly_paychecks",
                  [("paycheck_column", "Paycheck Value"), ("paycheck_value", "Amount")]),
}


def year_block(model_df: DataFrame, block: str, year: int | None = None) -> DataFrame:
    """One block of the per-year report for all years (or one ``year``), titles as column names."""
    _, cols = YEAR_BLOCKS[block]
    df = served(model_df, None if year is None else F.col("budget_year") == F.lit(year))
    return df.select("budget_year", *[F.col(c).alias(t) for c, t in cols])


def placed_year_block(model_df: DataFrame, block: str) -> DataFrame:
    """``year_block`` of every year with each row's ``position`` in its year.

    The order is the model's stored one, ties by the block's columns. Positions come from one
    distributed sort of all years; a year's first position, one row a year, is taken off.
    """
    model, cols = YEAR_BLOCKS[block]
    whole = with_position(served(model_df), model, "__at", [c for c, _ in cols])
    first = whole.groupBy(F.col("budget_year").alias("__year")).agg(F.min("__at").alias("__first"))
    placed = whole.join(first, F.col("budget_year").eqNullSafe(F.col("__year")))
    return placed.select("budget_year", (F.col("__at") - F.col("__first") + 1).alias("position"),
                         *[F.col(c).alias(t) for c, t in cols])


def write_year_blocks(models: Mapping[str, DataFrame], out_root: str, fmt: str = "parquet",
                      blocks: Sequence[str] | None = None) -> dict[str, str]:
    """Write every block (or the named ones) for every year: one job per block, partitioned by ``budget_year``.

    Rows carry their ``position`` in the year and are range-partitioned by it, so the files of a
    year are sorted and follow each other.
    """
    paths = {}
    for block in YEAR_BLOCKS if blocks is None else blocks:
        model, _ = YEAR_BLOCKS[block]
        path = os.path.join(out_root, block)
        placed = placed_year_block(models[model], block)
        in_order = placed.repartitionByRange("budget_year", "position").sortWithinPartitions("budget_year", "position")
        writer = in_order.write.mode("overwrite").partitionBy("budget_year")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.parquet(path)
        paths[block] = path
    return paths


def read_year_block(spark, out_root: str, block: str, year: int | None = None, fmt: str = "parquet",
                    in_order: bool = False) -> DataFrame:
    """One written report block, optionally for one year and in its stored order.

    The year predicate is on the partition column, so the scan reads only that
    year's folder (partition pruning) instead of filtering every row.
    """
    path = os.path.join(out_root, block)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path).withColumn("position", F.col("position").cast("bigint"))
    df = df if year is None else df.where(F.col("budget_year") == F.lit(year))
    return df.orderBy(F.col("budget_year").asc_nulls_last(), "position") if in_order else df
