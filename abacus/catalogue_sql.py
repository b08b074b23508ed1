"""DuckDB oracle SQL for every key of the query catalogue (``abacus.catalogue``).

Plain SQL over the generated tables that shares no list with the Spark code. Every fact
becomes rows of (month, measure, v), and a report line is a signed sum of measures.
Amounts stay exact decimals until the final SELECT casts them to DOUBLE.
"""

from __future__ import annotations

# The report lines with their titles, and the measures each adds or takes away.
REPORT = [
    ("earnings_actual", "Pre-Tax Earnings", "+earnings_actual"),
    ("salary", "Salary", "+salary"),
    ("bonus", "Bonus", "+bonus"),
    ("pre_tax_deductions", "Pre-Tax Deductions", "+pre_tax_deductions"),
    ("taxes", "Taxes", "+taxes"),
    ("retirement_fund", "Retirement Fund Contribution", "+retirement_fund"),
    ("hsa", "HSA Contribution", "+hsa"),
    ("post_tax_deductions", "Post-Tax Deductions", "+post_tax_deductions"),
    ("total_deductions", "Total Deductions", "+deductions"),
    ("net_pay", "Net Pay", "+net_pay"),
    ("income_for_reimbursements", "Reimbursed Income", "+income_for_reimbursements"),
    ("misc_income", "Miscellaneous Income", "+income -net_pay"),
    ("total_income", "Total Income (Net to Account)", "+income"),
    ("needs_spend", "Needs Spend", "+needs_spend"),
    ("wants_spend", "Wants Spend", "+wants_spend"),
    ("savings_spend", "Savings Spend", "+savings_spend"),
    ("emergency_fund_spend", "Emergency Fund Spend", "+emergency_fund_spend"),
    ("savings_saved", "Savings Saved", "+savings_assigned"),
    ("emergency_fund_saved", "Emergency Fund Saved", "+emergency_fund_assigned"),
    ("investments_saved", "Investments Saved", "+investments_assigned"),
    ("emergency_fund_in_hsa", "Emergency Fund in HSA", "+emergency_fund_in_hsa"),
    ("spent", "Total Spend", "+needs_spend +wants_spend +savings_spend +emergency_fund_spend"),
    ("difference", "Net Income", "+income +needs_spend +wants_spend +savings_spend +emergency_fund_spend"),
]
LINES = [name for name, _, _ in REPORT]
# Lines of the report that are no line of the yearly paycheck.
NOT_PAYCHECK = {"needs_spend", "wants_spend", "savings_spend", "emergency_fund_spend", "savings_saved",
                "emergency_fund_saved", "investments_saved", "emergency_fund_in_hsa"}
PAYCHECK = [(title, name) for name, title, _ in REPORT if name not in NOT_PAYCHECK]
REPORT_YEAR = 1998


def U(x: str) -> str:
    """Exact thousandths -> units, as DECIMAL(18,3)."""
    return f"(CAST({x} AS DECIMAL(18,0)) * CAST(0.001 AS DECIMAL(4,3)))"


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def CLEAN(x: str, keep_plus: bool) -> str:
    cls = r"[^\pL\pN\s.&/+]+" if keep_plus else r"[^\pL\pN\s.&/]+"
    return rf"trim(regexp_replace(regexp_replace({x}, '{cls}', ' ', 'g'), '\s+', ' ', 'g'))"


def DECORATED(key: str, name: str, typ: str) -> str:
    return f"('#' || {name} || ' ' || CAST({key} AS VARCHAR) || ' + ' || (CASE WHEN {typ} = 'SMALL' THEN 'HSA' ELSE {typ} END) || '!')"


def US_DATE(x: str) -> str:
    return f"CAST(strptime(NULLIF({x}, ''), '%m/%d/%Y') AS DATE)"


def AMT(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS DECIMAL(18,3)), CAST(0 AS DECIMAL(18,3)))"


LABEL_LIST = "[" + ", ".join(f"'{title}'" for title, _ in PAYCHECK) + "]"
STUB_TEXT_COLS = ["net_pay", "earnings_total", "pre_tax_deductions", "taxes", "post_tax_deductions",
                  "earnings_salary", "earnings_bonus", "earnings_meal_allowance", "earnings_pto_payout",
                  "earnings_severance", "earnings_misc", "earnings_expense_reimbursement", "earnings_nyc_citi_bike",
                  "pre_tax_401k", "pre_tax_hsa", "pre_tax_fsa", "pre_tax_medical", "taxes_medicare",
                  "taxes_federal", "taxes_state", "taxes_city", "taxes_nypfl", "taxes_disability",
                  "taxes_social_security", "post_tax_meal_allowance_offset", "post_tax_roth",
                  "post_tax_critical_illness", "post_tax_ad_d", "post_tax_long_term_disability",
                  "post_tax_citi_bike"]
STUB_TOTALS = {"net_pay": "net_pay_total", "earnings_total": "earnings_total",
               "pre_tax_deductions": "pre_tax_deductions_total", "taxes": "taxes_total",
               "post_tax_deductions": "post_tax_deductions_total"}
STUB_SET = {
    "net_pay": "CAST(s + b + e - (k + h) - (f + st) - e AS VARCHAR)",
    "earnings_total": "CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(s + b + e AS VARCHAR) END",
    "pre_tax_deductions": "CAST(k + h AS VARCHAR)",
    "taxes": "CAST(f + st AS VARCHAR)",
    "post_tax_deductions": "CAST(e AS VARCHAR)",
    "earnings_salary": "CAST(s AS VARCHAR)",
    "earnings_bonus": "CASE WHEN l_returnflag = 'A' THEN '$' || CAST(b AS VARCHAR) ELSE CAST(b AS VARCHAR) END",
    "earnings_expense_reimbursement": "CAST(e AS VARCHAR)",
    "pre_tax_401k": "CAST(k AS VARCHAR)",
    "pre_tax_hsa": "CAST(h AS VARCHAR)",
    "taxes_federal": "CAST(f AS VARCHAR)",
    "taxes_state": "CAST(st AS VARCHAR)",
    "post_tax_roth": "CAST(e AS VARCHAR)",
}


def _plus(cols):
    return " + ".join(cols)


def _signed(terms: str) -> str:
    """'+a -b' over rows of (measure, v) -> what a adds less what b takes away; 0 without rows."""
    arms = " ".join(f"WHEN '{t[1:]}' THEN {t[0]}v" for t in terms.split())
    return f"coalesce(sum(CASE measure {arms} END), 0)"


def _only(measure: str, terms: str | None = None) -> str:
    """Sum of the rows of some measures; NULL without rows."""
    names = ", ".join(f"'{t}'" for t in (terms or measure).split())
    return f"sum(v) FILTER (measure IN ({names})) AS {measure}"


EARN = ["earnings_salary", "earnings_bonus", "earnings_meal_allowance", "earnings_pto_payout",
        "earnings_severance", "earnings_misc", "earnings_expense_reimbursement", "earnings_nyc_citi_bike"]
PRE = ["pre_tax_401k", "pre_tax_hsa", "pre_tax_fsa", "pre_tax_medical"]
TAX = ["taxes_medicare", "taxes_federal", "taxes_state", "taxes_city", "taxes_nypfl", "taxes_disability",
       "taxes_social_security"]
POST = ["post_tax_meal_allowance_offset", "post_tax_roth", "post_tax_critical_illness", "post_tax_ad_d",
        "post_tax_long_term_disability", "post_tax_citi_bike"]
AUDITS = [
    ("earnings_components_sum_to_total", f"{_plus(EARN)} = earnings_total"),
    ("pre_tax_components_sum_to_total", f"{_plus(PRE)} = pre_tax_deductions_total"),
    ("tax_components_sum_to_total", f"{_plus(TAX)} = taxes_total"),
    ("post_tax_components_sum_to_total", f"{_plus(POST)} = post_tax_deductions_total"),
    ("net_plus_deductions_equal_earnings",
     "net_pay_total + pre_tax_deductions_total + taxes_total + post_tax_deductions_total = earnings_total"),
]
# One stub's pay measures, from its typed cells.
RETIREMENT = "round(post_tax_roth + pre_tax_401k, 2)"
PAY = {
    "earnings_actual": "round(earnings_salary + earnings_bonus + earnings_pto_payout + earnings_severance, 2)",
    "salary": "round(earnings_salary, 2)",
    "bonus": "round(earnings_bonus + earnings_pto_payout + earnings_severance, 2)",
    "pre_tax_deductions": "round(-pre_tax_fsa - pre_tax_medical, 2)",
    "retirement_fund": f"-{RETIREMENT}",
    "hsa": "round(pre_tax_hsa, 2)",
    "taxes": f"round(-({_plus(TAX)}), 2)",
    "post_tax_deductions": "round(-post_tax_critical_illness - post_tax_ad_d - post_tax_long_term_disability, 2)",
    "deductions": "round(pre_tax_deductions_total + pre_tax_hsa + taxes_total + post_tax_deductions_total "
                  f"- {RETIREMENT}, 2)",
    "net_pay": "round(net_pay_total - earnings_expense_reimbursement, 0)",
    "income_for_reimbursements": "round(earnings_expense_reimbursement, 2)",
}
PAY_COLS = list(PAY)
# Measures of a budget row: the column that counts, and the group that it counts for (None: all).
BUDGET = {
    "budgeted": ("budgeted", None), "activity": ("activity", None),
    "emergency_fund_assigned": ("budgeted", "Emergency Fund"), "savings_assigned": ("budgeted", "Savings"),
    "investments_assigned": ("budgeted", "Investments"), "emergency_fund_balance": ("balance", "Emergency Fund"),
    "savings_balance": ("balance", "Savings"), "investments_balance": ("balance", "Investments"),
    "net_zero_balance": ("balance", "Net Zero Expenses"),
}
# Measures of a transaction: the group whose amounts count.
SPENT = {"income": "Income", "needs_spend": "Needs", "wants_spend": "Wants", "savings_spend": "Savings",
         "emergency_fund_spend": "Emergency Fund"}
MB_COLS = list(BUDGET)
MT_COLS = [*SPENT, "emergency_fund_in_hsa"]
TB_COLS = ["income", "needs_spend", "wants_spend", "savings_spend", "emergency_fund_spend", "savings_assigned",
           "emergency_fund_assigned", "investments_assigned", "emergency_fund_in_hsa"]

CTES = f"""
l_tx AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date,
         CAST(round(o_totalprice * 1000) AS BIGINT) AS amount, o_orderpriority AS memo, o_custkey AS account_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS category_id, o_orderstatus AS payee_name
  FROM orders),
l_sub AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, l_orderkey AS transaction_id,
         CAST(round(l_extendedprice * 1000) AS BIGINT) AS amount,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS memo,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey END AS category_id
  FROM lineitem),
l_acct AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS type, c_acctbal >= 0 AS on_budget, false AS closed,
         CAST(round(c_acctbal * 1000) AS BIGINT) AS balance
  FROM customer),
region_group (r_name, title) AS (
  VALUES ('AFRICA', 'Needs'), ('AMERICA', 'Wants'), ('ASIA', 'Savings'), ('EUROPE', 'Emergency Fund'), ('MIDDLE EAST', 'Investments')),
special_nation (n_nationkey, title, top) AS (
  VALUES (0, 'Internal Master Category', 'Income'), (5, 'Credit Card Payments', 'Credit Card Payments'),
         (10, 'Net Zero Expenses', 'Net Zero Expenses')),
l_grp AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id, coalesce(s.title, g.title || ' - ' || n.n_name) AS name,
         coalesce(s.top, g.title) AS top, CASE WHEN s.title IS NULL THEN n.n_name END AS sub
  FROM nation n
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN region_group g ON r.r_name = g.r_name
  LEFT JOIN special_nation s ON n.n_nationkey = s.n_nationkey),
l_month AS (
  SELECT g.l_partkey AS id, CAST(p.p_size AS BIGINT) AS category_group_id,
         {DECORATED('g.l_partkey', 'p.p_name', 'p.p_type')} AS name, false AS hidden,
         g.budgeted, g.activity, g.budgeted + g.activity AS balance, g.mon AS month, g.yr AS year
  FROM (SELECT l_partkey, year(l_shipdate) AS yr, month(l_shipdate) AS mon,
               CAST(sum(CAST(round(l_extendedprice * 1000) AS BIGINT)) AS BIGINT) AS budgeted,
               CAST(-sum(CAST(l_quantity AS BIGINT) * 1000) AS BIGINT) AS activity
        FROM lineitem GROUP BY l_partkey, yr, mon) g
  LEFT JOIN part p ON g.l_partkey = p.p_partkey),
l_stub_base AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS s, CAST(l_quantity AS DECIMAL(18,2)) AS b,
         CAST(l_tax * 100 AS DECIMAL(18,2)) AS e, CAST(l_discount * 100 AS DECIMAL(18,2)) AS k,
         CAST(l_linenumber AS DECIMAL(18,2)) AS h, CAST(l_quantity * 2 AS DECIMAL(18,2)) AS f,
         CAST(l_linenumber AS DECIMAL(18,2)) AS st
  FROM lineitem),
l_stub AS (
  SELECT 'stub-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS file_name,
         l_returnflag AS employer,
         strftime(l_shipdate - INTERVAL 13 DAY, '%-m/%-d/%Y') AS pay_period_start_date,
         CASE WHEN l_linestatus = 'O' THEN '' ELSE strftime(l_shipdate, '%-m/%-d/%Y') END AS pay_period_end_date,
         strftime(l_shipdate, '%-m/%-d/%Y') AS pay_date,
         {", ".join(f"{STUB_SET.get(c, "''")} AS {c}" for c in STUB_TEXT_COLS)}
  FROM l_stub_base),
c_tx AS (
  SELECT id, account_id, category_id, CAST(strptime(date, '%Y-%m-%d') AS DATE) AS transaction_date,
         {U('amount')} AS amount, memo, payee_name
  FROM l_tx WHERE category_id IS NOT NULL),
c_sub AS (SELECT id, transaction_id, category_id, {U('amount')} AS amount, memo FROM l_sub),
c_acct AS (
  SELECT id, name, type, on_budget AS is_on_budget, closed AS is_closed, {U('balance')} AS balance,
         {U('balance')} AS cleared_balance, {U('0')} AS uncleared_balance
  FROM l_acct),
c_grp AS (SELECT id, name, top AS category_group_name_mapping, sub AS subcategory_group_name FROM l_grp),
c_month AS (
  SELECT id, category_group_id, {CLEAN('name', False)} AS category_name, make_date(year, month, 1) AS budget_month,
         {U('budgeted')} AS budgeted, {U('balance')} AS balance, {U('activity')} AS activity
  FROM l_month),
c_cat AS (
  SELECT id, category_group_id, {CLEAN('name', True)} AS category_name, hidden AS is_hidden
  FROM l_month
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY month DESC, year DESC) = 1),
grouped_cat AS (
  SELECT c.id, c.category_group_id, c.category_name, g.category_group_name_mapping, g.subcategory_group_name
  FROM c_cat c LEFT JOIN c_grp g ON c.category_group_id = g.id),
c_ord AS (
  SELECT row_number() OVER () AS order_id,
         CASE p_type WHEN 'STANDARD' THEN 'Needs' WHEN 'ECONOMY' THEN 'Wants' WHEN 'PROMO' THEN 'Paycheck'
              ELSE 'Other' END AS category_group,
         CASE WHEN p_type = 'PROMO' THEN '' ELSE p_brand END AS subcategory_group,
         CASE WHEN p_type = 'PROMO' THEN coalesce({LABEL_LIST}[p_size], '')
              ELSE {CLEAN(DECORATED('p_partkey', 'p_name', 'p_type'), False)} END AS category_name
  FROM part),
c_stub_typed AS (
  SELECT file_name, employer, {US_DATE('pay_period_start_date')} AS pay_period_start_date,
         {US_DATE('pay_period_end_date')} AS pay_period_end_date, {US_DATE('pay_date')} AS pay_date,
         {", ".join(f"{AMT(c)} AS {STUB_TOTALS.get(c, c)}" for c in STUB_TEXT_COLS)}
  FROM l_stub),
cb_stub AS (SELECT pay_date, {", ".join(f"{e} AS {c}" for c, e in PAY.items())} FROM c_stub_typed),
cb_budg AS (
  SELECT m.id AS category_id, m.budget_month, m.category_name, g.category_group_name_mapping,
         g.subcategory_group_name, m.budgeted, m.activity, m.balance
  FROM c_month m LEFT JOIN c_grp g ON m.category_group_id = g.id),
last_day AS (SELECT CAST(max(t) AS DATE) AS d
             FROM (SELECT max(o_orderdate) AS t FROM orders UNION ALL SELECT max(l_shipdate) FROM lineitem)),
months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(transaction_date) FROM c_tx)),
                                     (SELECT d FROM last_day), INTERVAL 1 MONTH)) AS DATE) AS budget_month),
cb_spine AS (
  SELECT budget_month, id AS category_id, category_name, category_group_name_mapping, subcategory_group_name
  FROM months CROSS JOIN grouped_cat),
facts AS (
  SELECT t.id, t.account_id, t.transaction_date, coalesce(s.category_id, t.category_id) AS category_id,
         coalesce(s.amount, t.amount) AS amount, coalesce(s.memo, t.memo) AS memo
  FROM c_sub s JOIN c_tx t ON s.transaction_id = t.id
  UNION ALL
  SELECT id, account_id, transaction_date, category_id, amount, memo
  FROM c_tx t WHERE NOT EXISTS (SELECT 1 FROM c_sub s WHERE s.transaction_id = t.id)),
cb_tx AS (
  SELECT f.id, f.transaction_date, c.id AS category_id, c.category_group_id, c.category_name,
         c.category_group_name_mapping, c.subcategory_group_name, f.amount, f.memo,
         a.name AS account_name, a.type AS account_type
  FROM facts f
  LEFT JOIN grouped_cat c ON f.category_id = c.id
  LEFT JOIN c_acct a ON f.account_id = a.id),
d_mt AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month, category_id,
         {", ".join(f"coalesce(sum(amount) FILTER (category_group_name_mapping = '{g}'), 0) AS {m}" for m, g in SPENT.items())},
         coalesce(-sum(amount) FILTER (contains(category_name, 'HSA')), 0) AS emergency_fund_in_hsa
  FROM cb_tx GROUP BY ALL),
d_mb AS (
  SELECT budget_month, category_id, {", ".join(f"sum({v}) AS {m}" if g is None else
         f"coalesce(sum({v}) FILTER (category_group_name_mapping = '{g}'), 0) AS {m}" for m, (v, g) in BUDGET.items())}
  FROM cb_budg GROUP BY ALL),
d_mp AS (
  SELECT CAST(date_trunc('month', pay_date) AS DATE) AS pay_month, {", ".join(f"sum({c}) AS {c}" for c in PAY_COLS)}
  FROM cb_stub GROUP BY ALL),
on_spine AS (
  SELECT month, measure, v FROM (
    SELECT transaction_month AS month, category_id, unnest({MT_COLS}) AS measure,
           unnest([{", ".join(f"{c}::DECIMAL(38,3)" for c in MT_COLS)}]) AS v FROM d_mt
    UNION ALL
    SELECT budget_month, category_id, unnest({MB_COLS}), unnest([{", ".join(f"{c}::DECIMAL(38,3)" for c in MB_COLS)}]) FROM d_mb)
  WHERE category_id IN (SELECT id FROM c_cat) AND month IN (SELECT budget_month FROM months)),
paid AS (
  SELECT pay_month AS month, unnest({PAY_COLS}) AS measure,
         unnest([{", ".join(f"{c}::DECIMAL(38,3)" for c in PAY_COLS)}]) AS v FROM d_mp),
d_tb AS (
  SELECT budget_month, {", ".join(_only(c) for c in TB_COLS)},
         {_only("spent", "needs_spend wants_spend savings_spend emergency_fund_spend")}
  FROM months LEFT JOIN on_spine ON month = budget_month GROUP BY ALL),
fact_days AS (
  SELECT transaction_date AS day, false AS planned FROM cb_tx
  UNION ALL SELECT pay_date, false FROM c_stub_typed
  UNION ALL SELECT budget_month, true FROM c_month),
d_dates AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', min(day)), date_trunc('month', max(day) FILTER (NOT planned)),
                                     INTERVAL 1 MONTH)) AS DATE) AS budget_month
  FROM fact_days),
d_monthly AS (
  SELECT budget_month, {", ".join(f"{'round(' * (c == 'difference')}{_signed(t)}{', 2)' * (c == 'difference')} AS {c}" for c, _, t in REPORT)}
  FROM d_dates LEFT JOIN (FROM on_spine UNION ALL FROM paid) ON month = budget_month GROUP BY ALL),
d_yearly AS (
  SELECT CAST(year(budget_month) AS BIGINT) AS budget_year, {", ".join(f"sum({c}) AS {c}" for c in LINES)}
  FROM d_monthly GROUP BY 1),
planned AS (
  SELECT CAST(year(budget_month) AS BIGINT) AS budget_year, category_group_name_mapping,
         subcategory_group_name AS subcategory_group, category_name, sum(activity) AS spend, sum(budgeted) AS assigned
  FROM cb_budg GROUP BY ALL),
cb_yb AS (
  SELECT o.order_id, p.budget_year, o.category_group, p.category_group_name_mapping, p.subcategory_group,
         p.category_name, p.spend, p.assigned
  FROM planned p
  LEFT JOIN c_ord o ON p.category_name = o.category_name
  WHERE p.category_group_name_mapping NOT IN ('Income', 'Credit Card Payments')
    AND p.budget_year <= (SELECT max(year(budget_month)) FROM d_dates)),
d_ycg AS (
  SELECT category_group_name_mapping, budget_year, min(order_id) AS order_id, sum(spend) AS spend,
         sum(assigned) AS assigned
  FROM cb_yb GROUP BY 1, 2),
d_ysg AS (
  SELECT subcategory_group, budget_year, min(order_id) AS order_id, sum(spend) AS spend, sum(assigned) AS assigned
  FROM cb_yb WHERE subcategory_group IS NOT NULL GROUP BY 1, 2),
d_lines AS (
  {" UNION ALL ".join(f"SELECT budget_year, '{label}' AS paycheck_column, "
                      f"CAST({col} AS DECIMAL(38,3)) AS paycheck_value FROM d_yearly"
                      for label, col in PAYCHECK)}),
d_pay AS (
  SELECT l.budget_year, l.paycheck_column, l.paycheck_value, o.order_id
  FROM d_lines l
  LEFT JOIN (SELECT category_name, order_id FROM c_ord WHERE category_group = 'Paycheck') o
    ON l.paycheck_column = o.category_name)
"""


def _with(select: str) -> str:
    return f"WITH {CTES.strip()}\n{select}"


def _money(cols, alias=None):
    return ", ".join(f"{D(c)} AS {c}" for c in cols)


STUB_OUT = ["earnings_actual", "pre_tax_deductions", "retirement_fund", "hsa", "taxes", "post_tax_deductions",
            "deductions", "net_pay", "income_for_reimbursements", "salary", "bonus"]
SLICE_COLS = "order_id, category_name, budget_year, category_group, category_group_name_mapping, subcategory_group"

CHARTS = {
    "overview": ("value_type", "value", [("Pre-Tax Earnings", "earnings_actual"),
                                         ("Net Pay", "net_pay + ((retirement_fund + hsa) * -1)"),
                                         ("Spend", "spent * -1")]),
    "monthly_income": ("income_type", "income_amount", [("Salary", "salary"), ("Bonus", "bonus"),
                                                        ("Miscellaneous Income", "misc_income")]),
    "yearly_income": ("income_type", "income_amount", [("Pre Tax Earnings", "earnings_actual"),
                                                       ("Miscellaneous Income", "misc_income")]),
    "paycheck_breakdown": ("breakdown_category", "amount", [
        ("Net Pay", "net_pay"), ("Pre-Tax Deductions", "pre_tax_deductions * -1"), ("Taxes", "taxes * -1"),
        ("Retirement Fund Contribution", "retirement_fund * -1"), ("HSA Contribution", "hsa * -1"),
        ("Post-Tax Deductions", "post_tax_deductions * -1")]),
    "spending_breakdown": ("spending_category", "amount", [
        ("Needs", "needs_spend"), ("Wants", "wants_spend"), ("Savings", "savings_spend"),
        ("Emergency Fund", "emergency_fund_spend")]),
}


def _chart(level: str, series: str) -> str:
    key = "budget_month" if level == "monthly" else "budget_year"
    src = "d_monthly" if level == "monthly" else "d_yearly"
    label_col, value_col, arms = CHARTS[series]
    return _with("\nUNION ALL\n".join(
        f"SELECT {key}, '{label}' AS {label_col}, {D(expr)} AS {value_col} FROM {src}" for label, expr in arms))


def _overview(level: str) -> str:
    if level == "monthly":
        first, src = "strftime(budget_month, '%-m/%Y') AS \"Month\"", "d_monthly"
    else:
        first, src = "budget_year AS \"Year\"", "d_yearly"
    cols = ", ".join(f"{D(c)} AS \"{t}\"" for c, t, _ in REPORT)
    return _with(f"SELECT {first}, {cols} FROM {src}")


SQL = {
    "scan_project": _with(
        "SELECT id, name, type, is_on_budget, is_closed, "
        + _money(["balance", "cleared_balance", "uncleared_balance"]) + " FROM c_acct"),
    "unit_scale": "SELECT event_id, CAST(round(value * 1000) AS BIGINT) AS value_milli, "
                  "CAST(CAST(round(value * 1000) AS BIGINT) AS DOUBLE) / 1000 AS value_units FROM events",
    "json_flatten": "SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d') AS date, "
                    "CAST(round(value * 1000) AS BIGINT) AS amount, event_type AS memo, "
                    "CAST(user_id AS VARCHAR) AS category_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k "
                    "FROM events",
    "json_two_level": """
        SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderpriority AS category_group_id, 'customer' AS name,
               CAST(round(o_totalprice * 1000) AS BIGINT) AS budgeted,
               CAST(month(o_orderdate) AS BIGINT) AS month, CAST(year(o_orderdate) AS BIGINT) AS year
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 'order', -CAST(round(o_totalprice * 1000) AS BIGINT),
               CAST(month(o_orderdate) AS BIGINT), CAST(year(o_orderdate) AS BIGINT)
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 'next', CAST(0 AS BIGINT),
               CAST(month(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS BIGINT),
               CAST(year(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS BIGINT)
        FROM orders""",
    "row_ids": "SELECT row_number() OVER () AS row_id, o_orderkey FROM orders",
    "typed_from_text": _with(
        "SELECT file_name, pay_period_start_date, pay_period_end_date, pay_date, "
        + _money(["net_pay_total", "earnings_total", "earnings_salary", "earnings_bonus", "pre_tax_401k",
                  "taxes_federal"]) + " FROM c_stub_typed"),
    "clean_label": "SELECT p_partkey, "
                   + CLEAN("('#' || p_name || ' + ' || p_type || '! \U0001F3E0')", True) + " AS label_with_plus, "
                   + CLEAN("('#' || p_name || ' + ' || p_type || '! \U0001F3E0')", False) + " AS label_without_plus "
                   "FROM part",
    # Whatever is put around the labels is emoji and goes.
    "strip_emoji": "SELECT p_partkey, p_name || ' \u2605 7#' AS category_name FROM part",
    "group_mapping": """
        SELECT p_partkey, name,
               CASE WHEN name = 'Internal Master Category' THEN 'Income' ELSE split(name, ' - ')[1] END
                 AS category_group_name_mapping,
               split(name, ' - ')[2] AS subcategory_group_name
        FROM (SELECT p_partkey,
                     CASE WHEN p_brand = 'Brand#1' THEN 'Internal Master Category'
                          WHEN p_size < 10 THEN p_brand ELSE p_brand || ' - ' || p_type END AS name
              FROM part)""",
    "month_key": """
        SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_from_parts,
               CAST(date_trunc('month', strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d')) AS DATE)
                 AS month_from_text,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month_trunc
        FROM orders""",
    "conditional_columns": _with(f"SELECT budget_month, category_id, {_money(MB_COLS)} FROM d_mb"),
    "split_expand": _with("""
        SELECT t.id, t.account_id, t.transaction_date, coalesce(s.category_id, t.category_id) AS category_id,
               CAST(coalesce(s.amount, t.amount) AS DOUBLE) AS amount, coalesce(s.memo, t.memo) AS memo
        FROM c_tx t LEFT JOIN c_sub s ON t.id = s.transaction_id"""),
    "enrich_chain": _with("""
        SELECT category_group_name_mapping, account_type, count(*) AS n_rows,
               count(*) FILTER (WHERE category_id IS NULL) AS n_unknown_category,
               count(*) FILTER (WHERE account_name IS NULL) AS n_unknown_account,
               CAST(sum(amount) AS DOUBLE) AS amount
        FROM cb_tx GROUP BY 1, 2"""),
    "enriched_transactions": _with("""
        SELECT id, transaction_date, category_id, category_group_id, category_name, category_group_name_mapping,
               subcategory_group_name, CAST(amount AS DOUBLE) AS amount, memo, account_name, account_type
        FROM cb_tx"""),
    "latest_per_key": """
        SELECT user_id, event_id, event_type, value, CAST(month(ts) AS BIGINT) AS month,
               CAST(year(ts) AS BIGINT) AS year
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY month(ts) DESC, year(ts) DESC, event_id DESC) = 1""",
    "categories_latest": _with("SELECT id, category_group_id, category_name, is_hidden FROM c_cat"),
    "conditional_sums": _with(f"SELECT transaction_month, category_id, {_money(MT_COLS)} FROM d_mt"),
    "date_range": _with("SELECT budget_month FROM d_dates"),
    "record_spine": _with("SELECT budget_month, category_id, category_name, category_group_name_mapping, "
                          "subcategory_group_name FROM cb_spine"),
    "dense_rollup": _with(f"SELECT budget_month, {_money([*TB_COLS, 'spent'])} FROM d_tb"),
    "pay_measures": _with(f"SELECT pay_date, {_money(STUB_OUT)} FROM cb_stub"),
    "pay_monthly": _with(f"SELECT pay_month, {_money(PAY_COLS)} FROM d_mp"),
    "monthly_level": _with(f"SELECT budget_month, {_money(LINES)} FROM d_monthly"),
    "yearly_level": _with(f"SELECT budget_year, {_money(LINES)} FROM d_yearly"),
    "yearly_budgeted": _with("SELECT order_id, budget_year, category_group, category_group_name_mapping, "
                             "subcategory_group, category_name, " + _money(["spend", "assigned"]) + " FROM cb_yb"),
    "yearly_group": _with("SELECT category_group_name_mapping, budget_year, order_id, "
                          + _money(["spend", "assigned"]) + " FROM d_ycg"),
    "yearly_subgroup": _with("SELECT subcategory_group, budget_year, order_id, "
                             + _money(["spend", "assigned"]) + " FROM d_ysg"),
    "group_slice_needs": _with(f"SELECT {SLICE_COLS}, {_money(['assigned', 'spend'])} FROM cb_yb "
                               "WHERE category_group = 'Needs'"),
    "group_slice_wants": _with(f"SELECT {SLICE_COLS}, {_money(['assigned', 'spend'])} FROM cb_yb "
                               "WHERE category_group = 'Wants'"),
    "group_slice_other": _with(f"SELECT {SLICE_COLS}, {_money(['assigned', 'spend'])} FROM cb_yb "
                               "WHERE category_group = 'Other'"),
    "unpivot_ordered": _with("SELECT budget_year, paycheck_column, CAST(paycheck_value AS DOUBLE) AS paycheck_value, "
                             "order_id FROM d_pay"),
    "chart_monthly_overview": _chart("monthly", "overview"),
    "chart_monthly_income": _chart("monthly", "monthly_income"),
    "chart_monthly_paycheck": _chart("monthly", "paycheck_breakdown"),
    "chart_monthly_spending": _chart("monthly", "spending_breakdown"),
    "chart_yearly_overview": _chart("yearly", "overview"),
    "chart_yearly_income": _chart("yearly", "yearly_income"),
    "chart_yearly_paycheck": _chart("yearly", "paycheck_breakdown"),
    "chart_yearly_spending": _chart("yearly", "spending_breakdown"),
    "dash_extract_monthly": _with(f"SELECT budget_month, {_money(LINES)} FROM d_monthly"),
    "dash_extract_yearly": _with(f"SELECT budget_year, {_money(LINES)} FROM d_yearly"),
    "overview_labels_monthly": _overview("monthly"),
    "overview_labels_yearly": _overview("yearly"),
    "serve_year_slice": _with("SELECT budget_year, paycheck_column AS \"Paycheck Value\", "
                              "CAST(paycheck_value AS DOUBLE) AS \"Amount\" FROM d_pay"),
    "serve_category_block": _with("SELECT budget_year, category_group_name_mapping AS \"Category Group\", "
                                  "CAST(assigned AS DOUBLE) AS \"Assigned\", CAST(spend AS DOUBLE) AS \"Spend\" "
                                  "FROM d_ycg"),
    "ordered_serving": _with("""
        SELECT order_id, budget_year, category_group, category_group_name_mapping, subcategory_group, category_name,
               CAST(spend AS DOUBLE) AS spend, CAST(assigned AS DOUBLE) AS assigned,
               row_number() OVER (ORDER BY budget_year ASC NULLS LAST, order_id ASC NULLS LAST,
                                  category_group_name_mapping ASC NULLS LAST, subcategory_group ASC NULLS LAST,
                                  category_name ASC NULLS LAST) AS position
        FROM cb_yb"""),
    "audit_forall": _with("\nUNION ALL\n".join(
        f"SELECT '{name}' AS audit, count(*) FILTER (WHERE NOT ({rule})) AS violations FROM c_stub_typed"
        for name, rule in AUDITS)),
    "grain_check": _with("""
        SELECT 'raw.paystubs' AS model, count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT count(*) AS n FROM l_stub GROUP BY file_name, pay_period_start_date HAVING count(*) > 1)
        UNION ALL
        SELECT 'raw.transactions', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM l_tx GROUP BY id HAVING count(*) > 1)
        UNION ALL
        SELECT 'raw.monthly_categories', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM l_month GROUP BY id HAVING count(*) > 1)"""),
    "dropped_facts": _with("""
        SELECT 'transactions_without_category' AS metric, count(*) AS rows FROM l_tx WHERE category_id IS NULL
        UNION ALL
        SELECT 'parts_of_transactions_without_category', count(*) FROM l_sub
        WHERE transaction_id IN (SELECT id FROM l_tx WHERE category_id IS NULL)
        UNION ALL
        SELECT 'facts_with_unknown_category', count(*) FROM cb_tx WHERE category_id IS NULL"""),
    "sanitize_nonfinite": "SELECT event_id, event_type, CASE WHEN event_type IN ('error', 'click', 'view') "
                          "THEN NULL ELSE value END AS value FROM events",
    "sink_count": f"SELECT count(*) AS written_rows, "
                  f"CAST(sum({U('CAST(round(o_totalprice * 1000) AS BIGINT)')}) AS DOUBLE) AS written_amount "
                  f"FROM orders",
}

# The declared grains, as model -> (table of the chain above, key).
GRAIN_KEYS = {
    "raw.accounts": ("l_acct", "id"), "raw.category_groups": ("l_grp", "id"), "raw.subtransactions": ("l_sub", "id"),
    "raw.transactions": ("l_tx", "id"), "raw.paystubs": ("l_stub", "file_name, pay_period_start_date"),
    "raw.monthly_categories": ("l_month", "id"), "cleaned.accounts": ("c_acct", "id"),
    "cleaned.category_groups": ("c_grp", "id"), "cleaned.sub_transactions": ("c_sub", "id"),
    "cleaned.transactions": ("c_tx", "id"), "cleaned.paystubs": ("c_stub_typed", "file_name, pay_period_start_date"),
    "cleaned.monthly_categories": ("c_month", "id"), "cleaned.categories": ("c_cat", "id"),
    "cleaned.category_orders": ("c_ord", "order_id"), "combined.budgeted": ("cb_budg", "budget_month, category_id"),
    "combined.paystubs": ("cb_stub", "pay_date"), "combined.record_spine": ("cb_spine", "budget_month, category_id"),
    "combined.transactions": ("cb_tx", "id"), "combined.yearly_budgeted": ("cb_yb", "order_id, budget_year"),
    "dashboards.monthly_level": ("d_monthly", "budget_month"), "dashboards.yearly_level": ("d_yearly", "budget_year"),
    "dashboards.yearly_category_group": ("d_ycg", "category_group_name_mapping, budget_year"),
    "dashboards.yearly_subcategory_group": ("d_ysg", "subcategory_group, budget_year"),
    "dashboards.yearly_needs": ("(FROM cb_yb WHERE category_group = 'Needs')", "category_name, budget_year"),
    "dashboards.yearly_wants": ("(FROM cb_yb WHERE category_group = 'Wants')", "category_name, budget_year"),
    "dashboards.yearly_other": ("(FROM cb_yb WHERE category_group = 'Other')", "category_name, budget_year"),
    "dashboards.yearly_paychecks": ("d_pay", "budget_year, paycheck_column"),
}

# The columns of each raw model; '=' gives the analog's value where the table above has no such column,
# a leading '-' marks a column that the analog does not fill.
RAW_LISTS = {
    "accounts": ("l_acct", "id name type on_budget closed -note balance cleared_balance=balance uncleared_balance=0 "
                           "-transfer_payee_id -last_reconciled_at"),
    "category_groups": ("l_grp", "id name hidden=false deleted=false"),
    "subtransactions": ("l_sub", "id transaction_id amount memo -payee_id category_id -transfer_account_id -deleted"),
    "transactions": ("l_tx", "id date amount memo -cleared -approved -flag_color account_id -payee_id category_id "
                             "-transfer_account_id -transfer_transaction_id -matched_transaction_id -import_id "
                             "import_payee_name=payee_name -import_payee_name_original -debt_transaction_type -deleted"),
    "paystubs": ("l_stub", "file_name employer pay_period_start_date pay_period_end_date pay_date "
                           + " ".join(STUB_TEXT_COLS)),
    "monthly_categories": ("l_month", "id category_group_id name hidden -original_category_group_id -note budgeted "
                                      "activity balance -goal_type -goal_needs_whole_amount -goal_day -goal_cadence "
                                      "-goal_cadence_frequency -goal_creation_month -goal_target -goal_target_month "
                                      "-goal_percentage_complete -goal_months_to_budget -goal_under_funded "
                                      "-goal_overall_funded -goal_overall_left -deleted month year"),
}


def _raw_columns() -> str:
    rows = []
    for model, (source, columns) in RAW_LISTS.items():
        for place, c in enumerate(columns.split(), 1):
            name, _, value = c.lstrip("-").partition("=")
            value = "NULL" if c.startswith("-") else value or name
            rows.append(f"SELECT '{model}' AS model, {place} AS place, '{name}' AS column_name, count(*) AS n_rows, "
                        f"count({value}) AS n_values FROM {source}")
    return _with("\nUNION ALL\n".join(rows))


# Served orders: key -> (table, columns shown, total order).
ORDERS = {
    "ordered_transactions": ("c_tx", "id, transaction_date", "transaction_date DESC, amount DESC, id"),
    "ordered_category_orders": ("c_ord", "order_id, category_name", "order_id"),
    "ordered_budgeted": ("cb_budg", "budget_month, category_id", "budget_month DESC, category_id DESC"),
    "ordered_paystubs": ("cb_stub", "pay_date, net_pay::DOUBLE AS net_pay", "pay_date DESC, net_pay"),
    "ordered_combined_transactions": ("cb_tx", "id, transaction_date, amount::DOUBLE AS amount",
                                      "transaction_date DESC, id, amount"),
    "ordered_monthly_level": ("d_monthly", "budget_month, spent::DOUBLE AS spent", "budget_month DESC"),
    "ordered_yearly_level": ("d_yearly", "budget_year, spent::DOUBLE AS spent", "budget_year DESC"),
    "ordered_yearly_paychecks": ("d_pay", "budget_year, order_id, paycheck_column", "budget_year, order_id, paycheck_column"),
}


def _ordered(table: str, shown: str, order: str) -> str:
    keys = ", ".join(f"{k} NULLS LAST" for k in order.split(", "))
    return _with(f"SELECT {shown}, row_number() OVER (ORDER BY {keys}) AS position FROM {table}")


# Report blocks: block -> (table, condition, columns with their titles).
BLOCKS = {
    "needs": ("cb_yb", "category_group = 'Needs'", 'subcategory_group AS "Subcategory Group", category_name AS "Needs", spend::DOUBLE AS "Spend"'),
    "wants": ("cb_yb", "category_group = 'Wants'", 'subcategory_group AS "Subcategory Group", category_name AS "Wants", spend::DOUBLE AS "Spend"'),
    "other": ("cb_yb", "category_group = 'Other'", 'category_name AS "Other", assigned::DOUBLE AS "Assigned", spend::DOUBLE AS "Spend"'),
    "category_group": ("d_ycg", "true", 'category_group_name_mapping AS "Category Group", assigned::DOUBLE AS "Assigned", spend::DOUBLE AS "Spend"'),
    "subcategory_group": ("d_ysg", "true", 'subcategory_group AS "Subcategory Group", assigned::DOUBLE AS "Assigned", spend::DOUBLE AS "Spend"'),
    "paychecks": ("d_pay", "true", 'paycheck_column AS "Paycheck Value", paycheck_value::DOUBLE AS "Amount"'),
}

# A block's order: its table's order number (nulls last), then its columns as they stand.
BLOCK_TIES = {
    "needs": "subcategory_group, category_name, spend", "wants": "subcategory_group, category_name, spend",
    "other": "category_name, assigned, spend", "category_group": "category_group_name_mapping, assigned, spend",
    "subcategory_group": "subcategory_group, assigned, spend", "paychecks": "paycheck_column, paycheck_value",
}


def _placed(block: str, table: str, where: str, cols: str) -> str:
    keys = ", ".join(f"{k} NULLS LAST" for k in ("order_id, " + BLOCK_TIES[block]).split(", "))
    return _with(f"SELECT budget_year, row_number() OVER (ORDER BY {keys}) AS position, {cols} "
                 f"FROM {table} WHERE {where} AND budget_year = {REPORT_YEAR}")


SQL |= {f"serve_year_{block}": _placed(block, *spec) for block, spec in BLOCKS.items()}
SQL |= {key: _ordered(*spec) for key, spec in ORDERS.items()}
SQL |= {
    "serve_where": _with("SELECT order_id, budget_year, category_name, " + _money(["spend", "assigned"])
                         + " FROM cb_yb WHERE category_group = 'Needs' AND spend < -100"),
    "raw_columns": _raw_columns(),
    "grain_report": _with("\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING n > 1)"
        for model, (table, key) in GRAIN_KEYS.items())),
    "pipeline_monthly": _with(f"SELECT budget_month, {_money(LINES)} FROM d_monthly"),
    "flatten_groups": _with("SELECT CAST(id AS VARCHAR) AS id, name FROM l_grp"),
    "flatten_accounts": _with("SELECT CAST(id AS VARCHAR) AS id, name, type, on_budget, closed, balance FROM l_acct"),
    "flatten_subtransactions": _with("SELECT id, CAST(transaction_id AS VARCHAR) AS transaction_id, amount, memo, "
                                     "CAST(category_id AS VARCHAR) AS category_id FROM l_sub"),
    "ingest_latest": "SELECT concat(o_custkey, '-', o_orderkey // 1000) AS budget_id, CAST(o_orderkey AS VARCHAR) AS id, "
                     "strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(round(o_totalprice * 1000) AS BIGINT) AS amount FROM orders",
    "sheet_csv_roundtrip": "SELECT row_number() OVER (ORDER BY p_partkey) AS row_id, p_type AS category_group, "
                           "CASE WHEN p_type = 'PROMO' THEN '' ELSE p_brand END AS subcategory_group, "
                           "'say \"' || p_name || '\", ' || p_brand || chr(10) || '#' || CAST(p_partkey AS VARCHAR) AS category_name "
                           "FROM part",
}

# Date columns leave every query as ISO text, as on the Spark side (``catalogue._dates_as_text``).
DATE_OUTPUTS = {
    "typed_from_text": ["pay_period_start_date", "pay_period_end_date", "pay_date"],
    "month_key": ["month_from_parts", "month_from_text", "month_trunc"],
    "conditional_columns": ["budget_month"], "split_expand": ["transaction_date"],
    "enriched_transactions": ["transaction_date"], "conditional_sums": ["transaction_month"],
    "date_range": ["budget_month"], "record_spine": ["budget_month"], "dense_rollup": ["budget_month"],
    "pay_measures": ["pay_date"], "pay_monthly": ["pay_month"], "monthly_level": ["budget_month"],
    "chart_monthly_overview": ["budget_month"], "chart_monthly_income": ["budget_month"],
    "chart_monthly_paycheck": ["budget_month"], "chart_monthly_spending": ["budget_month"],
    "dash_extract_monthly": ["budget_month"], "pipeline_monthly": ["budget_month"],
    "ordered_transactions": ["transaction_date"], "ordered_budgeted": ["budget_month"], "ordered_paystubs": ["pay_date"],
    "ordered_combined_transactions": ["transaction_date"], "ordered_monthly_level": ["budget_month"],
}


# Integer columns leave every query as DOUBLE, as on the Spark side (``catalogue._dates_as_text``).
INT_OUTPUTS = {
    'scan_project': ['id'],
    'unit_scale': ['event_id', 'value_milli'],
    'json_flatten': ['amount', 'k'],
    'json_two_level': ['budgeted', 'month', 'year'],
    'row_ids': ['row_id', 'o_orderkey'],
    'clean_label': ['p_partkey'],
    'strip_emoji': ['p_partkey'],
    'group_mapping': ['p_partkey'],
    'month_key': ['o_orderkey'],
    'conditional_columns': ['category_id'],
    'split_expand': ['id', 'account_id', 'category_id'],
    'enrich_chain': ['n_rows', 'n_unknown_category', 'n_unknown_account'],
    'enriched_transactions': ['id', 'category_id', 'category_group_id'],
    'latest_per_key': ['user_id', 'event_id', 'month', 'year'],
    'categories_latest': ['id', 'category_group_id'],
    'conditional_sums': ['category_id'],
    'record_spine': ['category_id'],
    'yearly_level': ['budget_year'],
    'yearly_budgeted': ['order_id', 'budget_year'],
    'yearly_group': ['budget_year', 'order_id'],
    'yearly_subgroup': ['budget_year', 'order_id'],
    'group_slice_needs': ['order_id', 'budget_year'],
    'group_slice_wants': ['order_id', 'budget_year'],
    'group_slice_other': ['order_id', 'budget_year'],
    'unpivot_ordered': ['budget_year', 'order_id'],
    'chart_yearly_overview': ['budget_year'],
    'chart_yearly_income': ['budget_year'],
    'chart_yearly_paycheck': ['budget_year'],
    'chart_yearly_spending': ['budget_year'],
    'dash_extract_yearly': ['budget_year'],
    'overview_labels_yearly': ['Year'],
    'serve_year_slice': ['budget_year'],
    'serve_category_block': ['budget_year'],
    'ordered_serving': ['order_id', 'budget_year', 'position'],
    'audit_forall': ['violations'],
    'grain_check': ['duplicate_keys', 'duplicate_rows'],
    'dropped_facts': ['rows'],
    'sanitize_nonfinite': ['event_id'],
    'sink_count': ['written_rows'],
    **{f'serve_year_{block}': ['position', 'budget_year'] for block in BLOCKS},
    'serve_where': ['order_id', 'budget_year'],
    'raw_columns': ['place', 'n_rows', 'n_values'],
    'grain_report': ['duplicate_keys', 'duplicate_rows'],
    'flatten_accounts': ['balance'],
    'flatten_subtransactions': ['amount'],
    'ingest_latest': ['amount'],
    'sheet_csv_roundtrip': ['row_id'],
    'ordered_transactions': ['id', 'position'],
    'ordered_category_orders': ['order_id', 'position'],
    'ordered_budgeted': ['category_id', 'position'],
    'ordered_paystubs': ['position'],
    'ordered_combined_transactions': ['id', 'position'],
    'ordered_monthly_level': ['position'],
    'ordered_yearly_level': ['budget_year', 'position'],
    'ordered_yearly_paychecks': ['budget_year', 'order_id', 'position'],
}


def _comparable(sql: str, key: str) -> str:
    swaps = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in DATE_OUTPUTS.get(key, [])]
    swaps += [f"CAST({c} AS DOUBLE) AS {c}" for c in INT_OUTPUTS.get(key, [])]
    if not swaps:
        return sql
    return f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({sql}) AS q"


SQL = {k: _comparable(v, k) for k, v in SQL.items()}
