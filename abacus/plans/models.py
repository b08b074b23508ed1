"""The warehouse models, each a function of its upstream DataFrames.

Layers: raw (explicit column lists over landing), cleaned (typed, renamed, label
cleanup), combined (joins, spines, yearly budget), dashboards (monthly/yearly
reports). Sorts of stored models are not applied here: a table has no order, so
ordering happens when a report is served (``plans.serve.ordered``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacus import schemas
from abacus.functions import (amount_from_text, clean_label, group_mapping, iso_date, make_month, milli,
                              month_start, round_milli, subgroup, us_date, year_of)
from abacus.operators import (CoBuckets, bounded_by_max, conditional_columns, conditional_sums, expand_cobucketed,
                              expand_months, latest_per_key, lookup, month_sequence, scalar_min, split_expand,
                              sum_measures, to_series)

# ---------------------------------------------------------------- money columns

def money_columns() -> frozenset[str]:
    """Names of the columns that hold money (integer thousandths) in any model."""
    return frozenset(
        ["amount", "balance", "cleared_balance", "uncleared_balance", "budgeted", "activity", "spend",
         "assigned", "paycheck_value", "net_pay_total", "earnings_total", "pre_tax_deductions_total",
         "taxes_total", "post_tax_deductions_total", "earnings_custom_calc", "bonus_custom_calc",
         "pre_tax_deductions_custom_calc", "retirement_fund_custom_calc", "taxes_custom_calc",
         "post_tax_deductions_custom_calc", "deductions_custom_calc", "net_pay_custom_calc"]
        + PAYSTUB_COMPONENTS + [n for n, _, _ in BUDGET_GROUP_COLUMNS] + TRANSACTION_MEASURES
        + PAY_MEASURES + LEVEL_MEASURES)


# ---------------------------------------------------------------- raw layer

RAW_COLUMNS = {
    "accounts": ["id", "name", "type", "on_budget", "closed", "note", "balance", "cleared_balance",
                 "uncleared_balance", "transfer_payee_id", "last_reconciled_at"],
    "category_groups": ["id", "name", "hidden", "deleted"],
    "subtransactions": ["id", "transaction_id", "amount", "memo", "payee_id", "category_id",
                        "transfer_account_id", "deleted"],
    "transactions": ["id", "date", "amount", "memo", "cleared", "approved", "flag_color",
                     "account_id", "payee_id", "category_id", "transfer_account_id",
                     "transfer_transaction_id", "matched_transaction_id", "import_id",
                     "import_payee_name", "import_payee_name_original", "debt_transaction_type",
                     "deleted"],
    "paystubs": list(schemas.PAYSTUB_COLUMNS),
    "monthly_categories": [f.name for f in schemas.MONTH_CATEGORY.fields] + ["month", "year"],
}

# Landing dataset read by each raw model.
RAW_LANDING = {
    "accounts": "accounts",
    "category_groups": "category-groups",
    "subtransactions": "subtransactions",
    "transactions": "transactions",
    "paystubs": "raw-paystubs",
    "monthly_categories": "monthly-categories",
}


# Declared types of the flat landing tables; sheet columns are all text.
RAW_TYPES = {"accounts": schemas.ACCOUNT, "category_groups": schemas.CATEGORY_GROUP, "subtransactions": schemas.SUBTRANSACTION,
             "transactions": schemas.TRANSACTION, "monthly_categories": schemas.MONTH_CATEGORY}


def raw_model(landing: DataFrame, model: str) -> DataFrame:
    """Explicit projection of a landing table; absent columns read as NULLs of their declared
    type. A table of rows with ids that has no ``id`` column is not that table, and raises."""
    present = set(landing.columns)
    types = {f.name: f.dataType for f in RAW_TYPES[model].fields} if model in RAW_TYPES else {}
    if "id" in types and "id" not in present:
        raise ValueError(f"the landing table of {model} has no id column")
    types |= {"month": "int", "year": "int"}
    return landing.select(*[F.col(c) if c in present else F.lit(None).cast(types.get(c, "string")).alias(c)
                            for c in RAW_COLUMNS[model]])


# Column descriptions of the category-order table.
CATEGORY_ORDER_COMMENTS = {
    "id": "Row Id",
    "category_group": "Category Group",
    "subcategory_group": "Subcategory Group",
    "category_name": "Category Name",
}


def raw_category_orders(sheet_with_ids: DataFrame) -> DataFrame:
    """Category-order sheet with its 1..N row ids (``sources.read_with_row_ids``).

    Column descriptions travel as ``comment`` metadata and are stored with the table.
    """
    cols = [F.col("id").cast("int")] + [F.col(c) for c in schemas.CATEGORY_ORDER_COLUMNS]
    names = ["id"] + schemas.CATEGORY_ORDER_COLUMNS
    return sheet_with_ids.select(*[c.alias(n, metadata={"comment": CATEGORY_ORDER_COMMENTS[n]})
                                   for c, n in zip(cols, names)])


# ---------------------------------------------------------------- cleaned layer

def cleaned_accounts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "name", "type",
        F.col("on_budget").alias("is_on_budget"), F.col("closed").alias("is_closed"), "note",
        milli("balance").alias("balance"),
        milli("cleared_balance").alias("cleared_balance"),
        milli("uncleared_balance").alias("uncleared_balance"),
        "transfer_payee_id", "last_reconciled_at",
    )


def cleaned_category_groups(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "name",
        group_mapping("name").alias("category_group_name_mapping"),
        subgroup("name").alias("subcategory_group_name"),
    )


def cleaned_sub_transactions(raw: DataFrame) -> DataFrame:
    return raw.select("id", "transaction_id", "category_id", milli("amount").alias("amount"), "memo")


def cleaned_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions; those without a category are dropped here, before split expansion."""
    return raw.where(F.col("category_id").isNotNull()).select(
        "id", "account_id", "category_id",
        iso_date("date").alias("transaction_date"),
        milli("amount").alias("amount"),
        "memo",
        F.col("import_payee_name").alias("payee_name"),
        "flag_color",
    )


def cleaned_monthly_categories(raw: DataFrame) -> DataFrame:
    """One row per category and month; the label cleanup here drops ``+``."""
    return raw.select(
        "id", "category_group_id",
        clean_label("name", keep_plus=False).alias("category_name"),
        make_month("year", "month").alias("budget_month"),
        milli("budgeted").alias("budgeted"),
        milli("balance").alias("balance"),
        milli("activity").alias("activity"),
    )


def cleaned_categories(raw: DataFrame, method: str = "aggregate") -> DataFrame:
    """Latest row per category id, ordered by month, then year (both descending).

    Month before year is the reference's ordering (December 2022 beats March 2024);
    kept for parity. The label cleanup here keeps ``+``.
    """
    latest = latest_per_key(raw.select("id", "category_group_id", "name", "hidden", "month", "year"),
                            ["id"], ["month", "year"], method=method)
    return latest.select(
        "id", "category_group_id",
        clean_label("name", keep_plus=True).alias("category_name"),
        F.col("hidden").alias("is_hidden"),
    )


def cleaned_category_orders(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("order_id"), "category_group", "subcategory_group", "category_name")


# Paystub sheet columns: totals get a ``_total`` suffix once typed.
PAYSTUB_TOTALS = {"net_pay": "net_pay_total", "earnings_total": "earnings_total",
                  "pre_tax_deductions": "pre_tax_deductions_total", "taxes": "taxes_total",
                  "post_tax_deductions": "post_tax_deductions_total"}
PAYSTUB_DATES = ["pay_period_start_date", "pay_period_end_date", "pay_date"]
PAYSTUB_COMPONENTS = [c for c in schemas.PAYSTUB_COLUMNS[10:]]
EARNINGS = PAYSTUB_COMPONENTS[0:8]
PRE_TAX = PAYSTUB_COMPONENTS[8:12]
TAXES = PAYSTUB_COMPONENTS[12:19]
POST_TAX = PAYSTUB_COMPONENTS[19:25]


def _add(cols: list[str]) -> Column:
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total


def paystub_audits() -> list[tuple[str, Column]]:
    """The five row rules of the cleaned paystubs (each must hold for every row)."""
    return [
        ("earnings_components_sum_to_total", _add(EARNINGS) == F.col("earnings_total")),
        ("pre_tax_components_sum_to_total", _add(PRE_TAX) == F.col("pre_tax_deductions_total")),
        ("tax_components_sum_to_total", _add(TAXES) == F.col("taxes_total")),
        ("post_tax_components_sum_to_total", _add(POST_TAX) == F.col("post_tax_deductions_total")),
        ("net_plus_deductions_equal_earnings",
         _add(["net_pay_total", "pre_tax_deductions_total", "taxes_total", "post_tax_deductions_total"])
         == F.col("earnings_total")),
    ]


def _small_methods(c: str, parse: Callable[[Column], Column]) -> Column:
    """``parse`` of one column inside a higher-order function, which whole-stage code leaves out.

    A projection of thirty parsers inlined in one stage makes a generated method too large for
    the JVM to compile, so it is interpreted. With one such expression the projection is generated
    on its own, cut into small methods that are compiled.
    """
    return F.get(F.transform(F.array(F.col(c)), parse), 0)


def cleaned_paystubs(raw: DataFrame) -> DataFrame:
    """Text paystubs -> typed amounts (unparsable -> 0) and dates, plus derived pay measures."""
    typed = raw.select(
        "file_name", "employer",
        *[_small_methods(c, us_date).alias(c) for c in PAYSTUB_DATES],
        *[amount_from_text(src).alias(dst) for src, dst in PAYSTUB_TOTALS.items()],
        *[amount_from_text(c).alias(c) for c in PAYSTUB_COMPONENTS],
    )
    c = F.col
    # Order matters: deductions reuse the retirement figure computed just before.
    return (typed
            .withColumn("earnings_custom_calc", round_milli(_add(["earnings_salary", "earnings_bonus",
                                                                  "earnings_pto_payout", "earnings_severance"]), 2))
            .withColumn("bonus_custom_calc", round_milli(_add(["earnings_bonus", "earnings_pto_payout",
                                                               "earnings_severance"]), 2))
            .withColumn("pre_tax_deductions_custom_calc", -round_milli(_add(["pre_tax_fsa", "pre_tax_medical"]), 2))
            .withColumn("retirement_fund_custom_calc", -round_milli(_add(["post_tax_roth", "pre_tax_401k"]), 2))
            .withColumn("taxes_custom_calc", -round_milli(_add(TAXES), 2))
            .withColumn("post_tax_deductions_custom_calc",
                        -round_milli(_add(["post_tax_critical_illness", "post_tax_ad_d",
                                           "post_tax_long_term_disability"]), 2))
            .withColumn("deductions_custom_calc",
                        round_milli(c("pre_tax_deductions_total") + c("retirement_fund_custom_calc")
                                    + c("pre_tax_hsa") + c("taxes_total") + c("post_tax_deductions_total"), 2))
            .withColumn("net_pay_custom_calc",
                        round_milli(c("net_pay_total") - c("earnings_expense_reimbursement"), 0)))


# ---------------------------------------------------------------- combined layer

# Tracked budget groups -> (column, group name, source measure).
BUDGET_GROUP_COLUMNS = [
    ("emergency_fund_assigned", "Emergency Fund", "budgeted"),
    ("savings_assigned", "Savings", "budgeted"),
    ("investments_assigned", "Investments", "budgeted"),
    ("emergency_fund_balance", "Emergency Fund", "balance"),
    ("savings_balance", "Savings", "balance"),
    ("investments_balance", "Investments", "balance"),
    ("net_zero_balance", "Net Zero Expenses", "balance"),
]


def _groups_for_join(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("id").alias("__group_id"), F.col("name").alias("category_group_name"),
                         "subcategory_group_name", "category_group_name_mapping")


def combined_budgeted(monthly_categories: DataFrame, category_groups: DataFrame) -> DataFrame:
    """Monthly budget rows with their group and one column per tracked group (else 0)."""
    joined = lookup(monthly_categories.withColumnRenamed("category_group_id", "__group_ref"),
                    _groups_for_join(category_groups), "__group_ref", "__group_id",
                    dim_key_as="category_group_id")
    mapping = F.col("category_group_name_mapping")
    base = joined.select(
        F.col("id").alias("category_id"),
        "category_group_id",  # the group table's id: NULL when the group is unknown
        "budget_month", "category_name", "category_group_name", "subcategory_group_name",
        "category_group_name_mapping", "budgeted", "activity", "balance",
    )
    return conditional_columns(base, [(name, mapping == F.lit(group), F.col(value))
                                      for name, group, value in BUDGET_GROUP_COLUMNS])


def combined_paystubs(paystubs: DataFrame) -> DataFrame:
    r = lambda c: round_milli(c, 2)
    return paystubs.select(
        "pay_date",
        r("earnings_custom_calc").alias("earnings_actual"),
        r("pre_tax_deductions_custom_calc").alias("pre_tax_deductions"),
        r("retirement_fund_custom_calc").alias("retirement_fund"),
        r("pre_tax_hsa").alias("hsa"),
        r("taxes_custom_calc").alias("taxes"),
        r("post_tax_deductions_custom_calc").alias("post_tax_deductions"),
        r("deductions_custom_calc").alias("deductions"),
        r("net_pay_custom_calc").alias("net_pay"),
        r("earnings_expense_reimbursement").alias("income_for_reimbursements"),
        r("earnings_salary").alias("salary"),
        r("bonus_custom_calc").alias("bonus"),
    )


@dataclass(frozen=True)
class Spine:
    """Every category for every month from ``first`` to ``last``, without the grid itself."""

    first: Column
    last: Column
    categories: DataFrame  # category_id, unique

    def months(self, month_col: str = "budget_month") -> DataFrame:
        """One row per month; its size is the number of months between two dates."""
        one = self.categories.sparkSession.range(1, numPartitions=1)
        return one.select(F.explode(month_sequence(self.first, self.last)).alias(month_col))

    def holds(self, df: DataFrame, month: str) -> DataFrame:
        """``df`` with a column ``__on_spine``: the row's month and category_id are on the spine.

        The range is two scalars; the categories are an outer join whose fact side adaptive execution
        can split, as it is the preserved one.
        """
        known = self.categories.select("category_id", F.lit(True).alias("__known"))
        inside = F.coalesce(F.col("__known") & F.col(month).between(self.first, self.last), F.lit(False))
        return df.join(known, "category_id", "left").withColumn("__on_spine", inside).drop("__known")


def month_spine(transactions: DataFrame, categories: DataFrame, as_of: dt.date | str | Column | None = None) -> Spine:
    """The spine's bounds and categories: months from the first transaction's to ``as_of``'s (default: today's)."""
    if as_of is None:
        end = F.current_date()
    elif isinstance(as_of, Column):
        end = as_of
    else:
        end = F.lit(str(as_of)).cast("date")
    first = scalar_min(transactions, month_start("transaction_date"))
    return Spine(first, month_start(end), categories.select(F.col("id").alias("category_id")))


def combined_record_spine(transactions: DataFrame, categories: DataFrame, category_groups: DataFrame,
                          as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Every category for every month from the first transaction's month to ``as_of``.

    A generator, not a join: each category row expands into the month list, whose
    start is a scalar aggregate over the transactions. ``as_of`` defaults to today.
    """
    spine = month_spine(transactions, categories, as_of)
    cats = lookup(categories.select("id", "category_name", "category_group_id"),
                  _groups_for_join(category_groups), "category_group_id", "__group_id")
    return expand_months(
        cats.select(F.col("id").alias("category_id"), "category_name",
                    "category_group_name_mapping", "subcategory_group_name"),
        spine.first, spine.last)


def combined_transactions(transactions: DataFrame, sub_transactions: DataFrame, categories: DataFrame,
                          category_groups: DataFrame, accounts: DataFrame, split: CoBuckets | None = None) -> DataFrame:
    """Split transactions expanded into their parts, enriched with category, group and account.

    A part overrides its parent's category, amount and memo. The output category id
    is the *categories* table's: NULL when the category is unknown there. ``split`` holds the first two
    tables in co-buckets, which expand without a shuffle. Without it the accounts are looked up before
    the expansion, as a parent's account is that of its parts: fewer and narrower rows to shuffle.
    """
    accts = accounts.select(F.col("id").alias("__account_id"), F.col("name").alias("account_name"),
                            F.col("type").alias("account_type"))
    columns = dict(parent_key="id", child_key="transaction_id",
                   overrides={"category_id": "category_id", "amount": "amount", "memo": "memo"})
    if split:
        expanded = lookup(expand_cobucketed(split, carry=["account_id", "transaction_date"], **columns),
                          accts, "account_id", "__account_id")
    else:
        expanded = split_expand(lookup(transactions, accts, "account_id", "__account_id"), sub_transactions,
                                carry=["account_name", "account_type", "transaction_date"], **columns)
    cats = categories.select(F.col("id").alias("__cat_key"), F.col("category_group_id"), "category_name")
    with_cat = lookup(expanded.withColumnRenamed("category_id", "__cat_ref"), cats, "__cat_ref", "__cat_key",
                      dim_key_as="category_id")
    with_group = lookup(with_cat, _groups_for_join(category_groups).drop("category_group_name"),
                        "category_group_id", "__group_id")
    return with_group.select(
        "id", "transaction_date", "category_id", "category_group_id", "category_name",
        "category_group_name_mapping", "subcategory_group_name", "amount", "memo",
        "account_name", "account_type",
    )


def combined_yearly_budgeted(budgeted: DataFrame, category_orders: DataFrame,
                             yearly_level: DataFrame) -> DataFrame:
    """Yearly spend/assigned per category label, with its position in the order sheet.

    Years after the last reported year are cut; credit-card and income groups are
    excluded (and so are rows without a group, as ``NOT IN`` is NULL for them).
    The label join fans out if the sheet repeats a label, as in the reference.
    """
    with_year = budgeted.withColumn("budget_year", year_of("budget_month"))
    kept = bounded_by_max(with_year, "budget_year", yearly_level, "budget_year").where(
        ~F.col("category_group_name_mapping").isin("Credit Card Payments", "Income"))
    aggs = kept.groupBy(
        "budget_year", "category_group_name_mapping",
        F.col("subcategory_group_name").alias("subcategory_group"), "category_name",
    ).agg(F.sum("activity").alias("spend"), F.sum("budgeted").alias("assigned"))
    orders = category_orders.select(F.col("category_name").alias("__order_name"), "order_id", "category_group")
    joined = lookup(aggs, orders, "category_name", "__order_name")
    return joined.select("order_id", "budget_year", "category_group", "category_group_name_mapping",
                         "subcategory_group", "category_name", "spend", "assigned")


def dropped_facts_report(raw_transactions: DataFrame, raw_subtransactions: DataFrame,
                         transactions: DataFrame) -> DataFrame:
    """Rows the reference's rules drop silently, counted (one row per metric).

    * transactions without a category (dropped before split expansion), and
    * their parts, which vanish with them (a semi join against the dropped ids;
      AQE can split a hot parent on the probe side), and
    * combined transactions whose category is unknown to the categories table
      (they drop out of the dense monthly roll-up).
    """
    dropped = raw_transactions.where(F.col("category_id").isNull()).select(F.col("id").alias("__dropped"))
    parts = raw_subtransactions.join(dropped, raw_subtransactions["transaction_id"] == dropped["__dropped"],
                                     "left_semi")
    counts = [
        ("transactions_without_category", dropped),
        ("parts_of_transactions_without_category", parts),
        ("facts_with_unknown_category", transactions.where(F.col("category_id").isNull())),
    ]
    out = None
    for metric, df in counts:
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(metric).alias("metric"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- dashboards layer

TRANSACTION_MEASURES = ["income", "emergency_fund_in_hsa", "needs_spend", "wants_spend",
                        "savings_spend", "emergency_fund_spend"]
BUDGET_MEASURES = ["budgeted", "activity"] + [name for name, _, _ in BUDGET_GROUP_COLUMNS]
PAY_MEASURES = ["earnings_actual", "salary", "bonus", "pre_tax_deductions", "retirement_fund", "hsa",
                "taxes", "post_tax_deductions", "deductions", "net_pay", "income_for_reimbursements"]
# Report columns of the monthly and yearly levels, in report order.
LEVEL_MEASURES = [
    "earnings_actual", "salary", "bonus", "pre_tax_deductions", "taxes", "retirement_fund", "hsa",
    "post_tax_deductions", "total_deductions", "net_pay", "income_for_reimbursements", "misc_income",
    "total_income", "needs_spend", "wants_spend", "savings_spend", "emergency_fund_spend",
    "savings_saved", "emergency_fund_saved", "investments_saved", "emergency_fund_in_hsa", "spent",
    "difference",
]


def monthly_transactions(transactions: DataFrame) -> DataFrame:
    """Conditional sums of combined transactions per (month, category)."""
    mapping, amount = F.col("category_group_name_mapping"), F.col("amount")
    return conditional_sums(
        transactions,
        [month_start("transaction_date").alias("transaction_month"), "category_id"],
        [("income", mapping == "Income", amount),
         ("emergency_fund_in_hsa", F.col("category_name").like("%HSA%"), -amount),
         ("needs_spend", mapping == "Needs", amount),
         ("wants_spend", mapping == "Wants", amount),
         ("savings_spend", mapping == "Savings", amount),
         ("emergency_fund_spend", mapping == "Emergency Fund", amount)],
    )


def monthly_budgeted(budgeted: DataFrame) -> DataFrame:
    return sum_measures(budgeted, ["budget_month", "category_id"], BUDGET_MEASURES)


def monthly_paystubs(paystubs: DataFrame) -> DataFrame:
    return sum_measures(paystubs, [month_start("pay_date").alias("pay_month")], PAY_MEASURES)


def dense_monthly_grid(record_spine: DataFrame, month_tx: DataFrame, month_budget: DataFrame) -> DataFrame:
    """Spine of (month, category) left-joined to both pre-aggregated facts, summed per month.

    The literal form: both facts are aggregated to the spine's grain first, so joining
    two fact tables cannot multiply rows, and both joins use the same key order so the
    spine's partitioning serves both. It joins the whole months x categories grid;
    ``dense_monthly`` gives the same result without the grid.
    """
    spine = record_spine.select("budget_month", "category_id")
    t = month_tx.select(F.col("transaction_month").alias("budget_month"), "category_id",
                        *TRANSACTION_MEASURES)
    b = month_budget.select("budget_month", "category_id", "savings_assigned", "emergency_fund_assigned",
                            "investments_assigned")
    keys = ["budget_month", "category_id"]
    joined = spine.join(t, keys, "left").join(b, keys, "left")
    return _per_month(joined)


def _per_month(rows: DataFrame) -> DataFrame:
    s = lambda c: F.sum(c).alias(c)
    spent = F.col("needs_spend") + F.col("wants_spend") + F.col("savings_spend") + F.col("emergency_fund_spend")
    return rows.groupBy("budget_month").agg(
        s("income"), s("needs_spend"), s("wants_spend"), s("savings_spend"), s("emergency_fund_spend"),
        s("savings_assigned"), s("emergency_fund_assigned"), s("investments_assigned"),
        s("emergency_fund_in_hsa"), F.sum(spent).alias("spent"),
    )


_ASSIGNED = ["savings_assigned", "emergency_fund_assigned", "investments_assigned"]


def _missing(columns: Sequence[str]) -> list[Column]:
    return [F.lit(None).cast("bigint").alias(c) for c in columns]


def dense_monthly(spine: Spine, month_tx: DataFrame, month_budget: DataFrame) -> DataFrame:
    """Per-month sums of the facts that fall on the (month, category) spine, without its grid.

    The spine is every category for every month of one range, so a fact row lies on it
    exactly when its month is inside the range and its category is one of the
    spine's. The facts that are on it are summed per month and attached to the list of months.
    Same rows as ``dense_monthly_grid``, but the work is proportional to the facts, not to
    months x categories; each fact is scanned once and the grid is never read.
    """
    t = spine.holds(month_tx, "transaction_month").where("__on_spine").select(
        F.col("transaction_month").alias("budget_month"), *TRANSACTION_MEASURES, *_missing(_ASSIGNED))
    b = spine.holds(month_budget, "budget_month").where("__on_spine").select(
        "budget_month", *_missing(TRANSACTION_MEASURES), *_ASSIGNED)
    # every spine month appears once, as in the grid form (months without facts get NULL sums)
    return spine.months().join(_per_month(t.unionByName(b)), "budget_month", "left")


def report_date_bounds(transactions: DataFrame, budgeted: DataFrame, paystubs: DataFrame) -> DataFrame:
    """One row: first month of any fact, last month of transactions or pay (budgets can run ahead).

    A month's start keeps the order of dates, so the bounds are those of the dates themselves:
    one global aggregate of partial minima and maxima, no shuffle by key.
    """
    days = (transactions.select(F.col("transaction_date").alias("d"), F.lit(True).alias("ends"))
            .unionByName(budgeted.select(F.col("budget_month").alias("d"), F.lit(False).alias("ends")))
            .unionByName(paystubs.select(F.col("pay_date").alias("d"), F.lit(True).alias("ends"))))
    return days.agg(month_start(F.min("d")).alias("min_date"),
                    month_start(F.max(F.when(F.col("ends"), F.col("d")))).alias("max_date"))


def dashboards_monthly_level(transactions: DataFrame, budgeted: DataFrame, paystubs: DataFrame,
                             spine: Spine) -> DataFrame:
    """One row per month between the report bounds, zero-filled.

    Each fact is scanned once: its monthly rows carry their measures where they are on the spine (pay
    always does) and, on the spine or not, the month that the bounds need. Summed per month they
    are a table of one row a month, gathered into a single row from which bounds and months are read.
    """
    facts = ["income", "emergency_fund_in_hsa", "needs_spend", "wants_spend", "savings_spend", "emergency_fund_spend", *_ASSIGNED]
    on = lambda columns: [F.when(F.col("__on_spine"), F.col(c)).alias(c) for c in columns]
    mt, mb = monthly_transactions(transactions), monthly_budgeted(budgeted)
    rows = (spine.holds(mt, "transaction_month").select(
                F.col("transaction_month").alias("budget_month"), F.lit(True).alias("ends"), *on(TRANSACTION_MEASURES),
                *_missing(_ASSIGNED), *_missing(PAY_MEASURES))
            .unionByName(spine.holds(mb, "budget_month").select(
                "budget_month", F.lit(False).alias("ends"), *_missing(TRANSACTION_MEASURES), *on(_ASSIGNED), *_missing(PAY_MEASURES)))
            .unionByName(monthly_paystubs(paystubs).select(
                F.col("pay_month").alias("budget_month"), F.lit(True).alias("ends"), *_missing(facts), *PAY_MEASURES)))
    measures = [*facts, *PAY_MEASURES]
    per_month = rows.where(F.col("budget_month").isNotNull()).groupBy("budget_month").agg(
        F.max("ends").alias("ends"), *[F.sum(c).alias(c) for c in measures])
    one = per_month.agg(F.min("budget_month").alias("first"), F.max(F.when(F.col("ends"), F.col("budget_month"))).alias("last"),
                        F.map_from_entries(F.collect_list(F.struct("budget_month", F.struct(*measures)))).alias("by_month"))
    months = F.transform(month_sequence(F.col("first"), F.col("last")), lambda d: F.struct(
        d.alias("budget_month"), F.try_element_at("by_month", d).alias("m")))
    joined = one.select(F.inline(months)).select("budget_month", "m.*")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    total_income = z("income")
    spent = z("needs_spend") + z("wants_spend") + z("savings_spend") + z("emergency_fund_spend")
    return joined.select(
        "budget_month",
        z("earnings_actual").alias("earnings_actual"), z("salary").alias("salary"), z("bonus").alias("bonus"),
        z("pre_tax_deductions").alias("pre_tax_deductions"), z("taxes").alias("taxes"),
        z("retirement_fund").alias("retirement_fund"), z("hsa").alias("hsa"),
        z("post_tax_deductions").alias("post_tax_deductions"), z("deductions").alias("total_deductions"),
        z("net_pay").alias("net_pay"), z("income_for_reimbursements").alias("income_for_reimbursements"),
        (total_income - z("net_pay")).alias("misc_income"),
        total_income.alias("total_income"),
        z("needs_spend").alias("needs_spend"), z("wants_spend").alias("wants_spend"),
        z("savings_spend").alias("savings_spend"), z("emergency_fund_spend").alias("emergency_fund_spend"),
        z("savings_assigned").alias("savings_saved"), z("emergency_fund_assigned").alias("emergency_fund_saved"),
        z("investments_assigned").alias("investments_saved"),
        z("emergency_fund_in_hsa").alias("emergency_fund_in_hsa"),
        spent.alias("spent"),
        round_milli(total_income + spent, 2).alias("difference"),
    )


def dashboards_yearly_level(monthly_level: DataFrame) -> DataFrame:
    return sum_measures(monthly_level, [year_of("budget_month").alias("budget_year")], LEVEL_MEASURES)


def _yearly_rollup(yearly_budgeted: DataFrame, key: str) -> DataFrame:
    return yearly_budgeted.groupBy(key, "budget_year").agg(
        F.min("order_id").alias("order_id"), F.sum("spend").alias("spend"), F.sum("assigned").alias("assigned"))


def dashboards_yearly_category_group(yearly_budgeted: DataFrame) -> DataFrame:
    return _yearly_rollup(yearly_budgeted, "category_group_name_mapping")


def dashboards_yearly_subcategory_group(yearly_budgeted: DataFrame) -> DataFrame:
    return _yearly_rollup(yearly_budgeted.where(F.col("subcategory_group").isNotNull()), "subcategory_group")


def dashboards_group_slice(yearly_budgeted: DataFrame, group: str) -> DataFrame:
    """``yearly_needs`` / ``yearly_wants`` / ``yearly_other``: one sheet group's rows."""
    return yearly_budgeted.where(F.col("category_group") == F.lit(group)).select(
        "order_id", "category_name", "budget_year", "category_group", "category_group_name_mapping",
        "subcategory_group", "assigned", "spend")


# The paycheck lines of the yearly report, label and source column, in report order.
PAYCHECK_LINES = [
    ("Pre-Tax Earnings", "earnings_actual"),
    ("Salary", "salary"),
    ("Bonus", "bonus"),
    ("Pre-Tax Deductions", "pre_tax_deductions"),
    ("Taxes", "taxes"),
    ("Retirement Fund Contribution", "retirement_fund"),
    ("HSA Contribution", "hsa"),
    ("Post-Tax Deductions", "post_tax_deductions"),
    ("Total Deductions", "total_deductions"),
    ("Net Pay", "net_pay"),
    ("Reimbursed Income", "income_for_reimbursements"),
    ("Miscellaneous Income", "misc_income"),
    ("Total Income (Net to Account)", "total_income"),
    ("Total Spend", "spent"),
    ("Net Income", "difference"),
]


def dashboards_yearly_paychecks(yearly_level: DataFrame, category_orders: DataFrame,
                                value_type: str = "bigint") -> DataFrame:
    """Fifteen labelled paycheck lines per year, with the order id of the sheet's matching label."""
    lines = to_series(yearly_level, ["budget_year"], [(label, F.col(c)) for label, c in PAYCHECK_LINES],
                      "paycheck_column", "paycheck_value", value_type)
    orders = category_orders.where(F.col("category_group") == "Paycheck").select(
        F.col("category_name").alias("__order_name"), "order_id")
    joined = lookup(lines, orders, "paycheck_column", "__order_name")
    return joined.select("budget_year", "paycheck_column", "paycheck_value", "order_id")
