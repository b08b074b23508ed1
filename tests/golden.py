"""The hand-worked golden ledger (amounts in thousandths), written as real input files."""

import csv
import json
import os

from abacus import schemas

GROUPS = [("G1", "Needs - Home"), ("G2", "Wants - Fun"), ("G3", "Savings"),
          ("G4", "Internal Master Category"), ("G5", "Emergency Fund - Health")]
# id, group, name, {month: (budgeted, activity, balance)}
CATEGORIES = [
    ("C1", "G1", "\U0001F3E0 Rent", {"2024-01-01": (1000000, -1000000, 0), "2024-02-01": (1000000, -1000000, 0)}),
    ("C2", "G2", "Games + Toys", {"2024-01-01": (200000, -150000, 50000), "2024-02-01": (200000, -250000, 0)}),
    ("C3", "G3", "Car Savings", {"2024-01-01": (300000, 0, 300000), "2024-02-01": (300000, 0, 600000)}),
    ("C4", "G4", "Inflow", {"2024-01-01": (0, 0, 0), "2024-02-01": (0, 0, 0)}),
    ("C5", "G5", "HSA Medical", {"2024-01-01": (100000, -40000, 60000), "2024-02-01": (0, 0, 60000)}),
]
TRANSACTIONS = [
    ("T1", "2024-01-05", -1000000, "C1", None), ("T2", "2024-01-20", -190000, "C2", "mall"),
    ("T3", "2024-01-31", 3000000, "C4", None), ("T4", "2024-02-05", -1000000, "C1", None),
    ("T5", "2024-02-10", -250000, "C2", None), ("T6", "2024-02-11", -5000, None, None),
    ("T7", "2024-02-29", 3100000, "C4", None),
]
SUBTRANSACTIONS = [("S1", "T2", -150000, "C2", None), ("S2", "T2", -40000, "C5", "clinic"),
                   ("S3", "T6", -5000, "C1", None)]
PAYSTUB = {"file_name": "stub-1.pdf", "employer": "Acme", "pay_date": "1/31/2024",
           "pay_period_start_date": "1/1/2024", "pay_period_end_date": "", "net_pay": "2800",
           "earnings_total": "4000", "pre_tax_deductions": "500", "taxes": "600", "post_tax_deductions": "100",
           "earnings_salary": "3500", "earnings_bonus": "400", "earnings_expense_reimbursement": "100",
           "pre_tax_401k": "300", "pre_tax_hsa": "100", "pre_tax_fsa": "50", "pre_tax_medical": "50",
           "taxes_federal": "400", "taxes_state": "200", "post_tax_roth": "100"}
ORDERS = [("Paycheck", "", "Net Pay"), ("Needs", "Home", "Rent"), ("Wants", "Fun", "Games Toys"),
          ("Other", "", "Car Savings")]
AS_OF = "2024-02-29"


def document():
    months = []
    for month in ("2024-01-01", "2024-02-01"):
        cats = [{"id": cid, "category_group_id": gid, "name": name, "hidden": False,
                 "budgeted": v[month][0], "activity": v[month][1], "balance": v[month][2]}
                for cid, gid, name, v in CATEGORIES]
        months.append({"month": month, "categories": cats})
    months.append({"month": "2024-03-01", "categories": []})  # an empty month is skipped
    return {"data": {"budget": {
        "id": "B1", "name": "Home",
        "category_groups": [{"id": i, "name": n, "hidden": False, "deleted": False} for i, n in GROUPS],
        "months": months,
        "transactions": [{"id": i, "date": d, "amount": a, "category_id": c, "memo": memo,
                          "account_id": "A1", "import_payee_name": None, "deleted": False}
                         for i, d, a, c, memo in TRANSACTIONS],
        "subtransactions": [{"id": i, "transaction_id": t, "amount": a, "category_id": c, "memo": memo,
                             "deleted": False} for i, t, a, c, memo in SUBTRANSACTIONS],
        "accounts": [{"id": "A1", "name": "Checking", "type": "checking", "on_budget": True,
                      "closed": False, "balance": 1500000, "cleared_balance": 1500000,
                      "uncleared_balance": 0}],
    }}}


def write_inputs(root):
    """Write the document, paystub sheet and category-order sheet; return their paths."""
    os.makedirs(root, exist_ok=True)
    doc = os.path.join(root, "budget.json")
    with open(doc, "w") as f:
        json.dump(document(), f, indent=2)
    stubs = os.path.join(root, "paystubs.csv")
    with open(stubs, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(schemas.PAYSTUB_COLUMNS)
        w.writerow([PAYSTUB.get(c, "") for c in schemas.PAYSTUB_COLUMNS])
    orders = os.path.join(root, "category_orders.csv")
    with open(orders, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(schemas.CATEGORY_ORDER_COLUMNS)
        w.writerows(ORDERS)
    return doc, stubs, orders
