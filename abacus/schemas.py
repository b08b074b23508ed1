"""Explicit schemas of the landing data (no inference: a missing field reads as NULL)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, L, B, I = StringType(), LongType(), BooleanType(), IntegerType()

ACCOUNT = _struct(
    ("id", S), ("name", S), ("type", S), ("on_budget", B), ("closed", B), ("note", S),
    ("balance", L), ("cleared_balance", L), ("uncleared_balance", L),
    ("transfer_payee_id", S), ("last_reconciled_at", S), ("deleted", B),
)

CATEGORY_GROUP = _struct(("id", S), ("name", S), ("hidden", B), ("deleted", B))

TRANSACTION = _struct(
    ("id", S), ("date", S), ("amount", L), ("memo", S), ("cleared", S), ("approved", B),
    ("flag_color", S), ("account_id", S), ("payee_id", S), ("category_id", S),
    ("transfer_account_id", S), ("transfer_transaction_id", S), ("matched_transaction_id", S),
    ("import_id", S), ("import_payee_name", S), ("import_payee_name_original", S),
    ("debt_transaction_type", S), ("deleted", B),
)

SUBTRANSACTION = _struct(
    ("id", S), ("transaction_id", S), ("amount", L), ("memo", S), ("payee_id", S),
    ("category_id", S), ("transfer_account_id", S), ("deleted", B),
)

MONTH_CATEGORY = _struct(
    ("id", S), ("category_group_id", S), ("name", S), ("hidden", B),
    ("original_category_group_id", S), ("note", S), ("budgeted", L), ("activity", L),
    ("balance", L), ("goal_type", S), ("goal_needs_whole_amount", B), ("goal_day", I),
    ("goal_cadence", I), ("goal_cadence_frequency", I), ("goal_creation_month", S),
    ("goal_target", L), ("goal_target_month", S), ("goal_percentage_complete", I),
    ("goal_months_to_budget", I), ("goal_under_funded", L), ("goal_overall_funded", L),
    ("goal_overall_left", L), ("deleted", B),
)

MONTH = _struct(("month", S), ("categories", ArrayType(MONTH_CATEGORY)))

BUDGET = _struct(
    ("id", S), ("name", S),
    ("accounts", ArrayType(ACCOUNT)),
    ("category_groups", ArrayType(CATEGORY_GROUP)),
    ("months", ArrayType(MONTH)),
    ("transactions", ArrayType(TRANSACTION)),
    ("subtransactions", ArrayType(SUBTRANSACTION)),
)

# A saved API response: {"data": {"budget": {...}}}
DOCUMENT = _struct(("data", _struct(("budget", BUDGET))))

# Paystub sheet: every cell is text; empty cells are ''.
PAYSTUB_COLUMNS = [
    "file_name", "employer", "pay_period_start_date", "pay_period_end_date", "pay_date",
    "net_pay", "earnings_total", "pre_tax_deductions", "taxes", "post_tax_deductions",
    "earnings_salary", "earnings_bonus", "earnings_meal_allowance", "earnings_pto_payout",
    "earnings_severance", "earnings_misc", "earnings_expense_reimbursement",
    "earnings_nyc_citi_bike", "pre_tax_401k", "pre_tax_hsa", "pre_tax_fsa", "pre_tax_medical",
    "taxes_medicare", "taxes_federal", "taxes_state", "taxes_city", "taxes_nypfl",
    "taxes_disability", "taxes_social_security", "post_tax_meal_allowance_offset",
    "post_tax_roth", "post_tax_critical_illness", "post_tax_ad_d",
    "post_tax_long_term_disability", "post_tax_citi_bike",
]
PAYSTUB = _struct(*[(c, S) for c in PAYSTUB_COLUMNS])

# Category order sheet (text), before row ids are assigned.
CATEGORY_ORDER_COLUMNS = ["category_group", "subcategory_group", "category_name"]
CATEGORY_ORDER = _struct(*[(c, S) for c in CATEGORY_ORDER_COLUMNS])
