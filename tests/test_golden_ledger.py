"""End-to-end run of the hand-worked ledger: documents and sheets -> every model."""

import datetime as dt
import os

import pytest

from abacus.plans import serve
from abacus.plans.build import dropped_report, grain_report
from abacus.plans.ingest import ingest, run
from tests import golden


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden"))
    doc, stubs, orders = golden.write_inputs(os.path.join(root, "in"))
    return run(spark, doc, stubs, orders, os.path.join(root, "landing"), os.path.join(root, "wh"),
               as_of=golden.AS_OF)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_ingest_counts(spark, tmp_path):
    doc, stubs, _ = golden.write_inputs(str(tmp_path / "in"))
    counts = ingest(spark, doc, stubs, str(tmp_path / "landing"))
    assert counts == {"category-groups": 5, "transactions": 7, "subtransactions": 3, "accounts": 1,
                      "monthly-categories": 10, "raw-paystubs": 1}


def test_label_cleanup_two_ways(models):
    cats = dict(rows(models["cleaned.categories"], "id", "category_name"))
    assert cats["C1"] == "Rent" and cats["C2"] == "Games + Toys"
    monthly = set(rows(models["cleaned.monthly_categories"], "id", "category_name"))
    assert ("C2", "Games Toys") in monthly


def test_group_mapping(models):
    got = {r[0]: (r[1], r[2]) for r in rows(models["cleaned.category_groups"], "id",
                                                "category_group_name_mapping", "subcategory_group_name")}
    assert got == {"G1": ("Needs", "Home"), "G2": ("Wants", "Fun"), "G3": ("Savings", None),
                   "G4": ("Income", None), "G5": ("Emergency Fund", "Health")}


def test_paystub_measures(models):
    (r,) = serve.in_units(models["cleaned.paystubs"]).collect()
    assert r["pay_period_end_date"] is None
    got = {k: float(r[k]) for k in ["earnings_custom_calc", "bonus_custom_calc", "pre_tax_deductions_custom_calc",
                                     "retirement_fund_custom_calc", "taxes_custom_calc",
                                     "post_tax_deductions_custom_calc", "deductions_custom_calc",
                                     "net_pay_custom_calc"]}
    assert got == {"earnings_custom_calc": 3900, "bonus_custom_calc": 400, "pre_tax_deductions_custom_calc": -100,
                   "retirement_fund_custom_calc": -400, "taxes_custom_calc": -600,
                   "post_tax_deductions_custom_calc": 0, "deductions_custom_calc": 900,
                   "net_pay_custom_calc": 2700}


def test_split_expansion(models):
    tx = models["combined.transactions"]
    assert tx.count() == 7
    t2 = sorted(rows(serve.in_units(tx).where("id = 'T2'"), "category_id", "amount", "memo"))
    assert [(c, float(a), m) for c, a, m in t2] == [("C2", -150.0, "mall"), ("C5", -40.0, "clinic")]
    assert tx.where("id = 'T6'").count() == 0


def test_record_spine(models):
    assert models["combined.record_spine"].count() == 10


EXPECTED_MONTHLY = {
    dt.date(2024, 2, 1): dict(earnings_actual=0, salary=0, bonus=0, pre_tax_deductions=0, taxes=0,
                              retirement_fund=0, hsa=0, post_tax_deductions=0, total_deductions=0, net_pay=0,
                              income_for_reimbursements=0, misc_income=3100, total_income=3100,
                              needs_spend=-1000, wants_spend=-250, savings_spend=0, emergency_fund_spend=0,
                              savings_saved=300, emergency_fund_saved=0, investments_saved=0,
                              emergency_fund_in_hsa=0, spent=-1250, difference=1850),
    dt.date(2024, 1, 1): dict(earnings_actual=3900, salary=3500, bonus=400, pre_tax_deductions=-100, taxes=-600,
                              retirement_fund=-400, hsa=100, post_tax_deductions=0, total_deductions=900,
                              net_pay=2700, income_for_reimbursements=100, misc_income=300, total_income=3000,
                              needs_spend=-1000, wants_spend=-150, savings_spend=0, emergency_fund_spend=-40,
                              savings_saved=300, emergency_fund_saved=100, investments_saved=0,
                              emergency_fund_in_hsa=40, spent=-1190, difference=1810),
}


def test_monthly_level(models):
    got = {r["budget_month"]: {k: float(r[k]) for k in EXPECTED_MONTHLY[r["budget_month"]]}
           for r in serve.in_units(models["dashboards.monthly_level"]).collect()}
    assert got == EXPECTED_MONTHLY
    first = serve.ordered(models["dashboards.monthly_level"], "dashboards.monthly_level").first()
    assert first["budget_month"] == dt.date(2024, 2, 1)


def test_yearly_level(models):
    (r,) = serve.in_units(models["dashboards.yearly_level"]).collect()
    assert r["budget_year"] == 2024
    assert (float(r["total_income"]), float(r["misc_income"]), float(r["spent"]), float(r["difference"])) == \
        (6100, 3400, -2440, 3660)


def test_yearly_budgeted_order_nulls_last(models):
    df = serve.ordered(serve.in_units(models["combined.yearly_budgeted"]), "combined.yearly_budgeted")
    got = [(r["order_id"], r["category_group"], r["category_group_name_mapping"], r["subcategory_group"],
            r["category_name"], float(r["spend"]), float(r["assigned"])) for r in df.collect()]
    assert got == [(2, "Needs", "Needs", "Home", "Rent", -2000, 2000),
                   (3, "Wants", "Wants", "Fun", "Games Toys", -400, 400),
                   (4, "Other", "Savings", None, "Car Savings", 0, 600),
                   (None, None, "Emergency Fund", "Health", "HSA Medical", -40, 100)]


def test_yearly_slices(models):
    for name in ("dashboards.yearly_needs", "dashboards.yearly_wants", "dashboards.yearly_other"):
        assert models[name].count() == 1
    assert models["dashboards.yearly_category_group"].count() == 4
    assert models["dashboards.yearly_subcategory_group"].count() == 3


def test_yearly_paychecks(models):
    df = serve.in_units(models["dashboards.yearly_paychecks"])
    assert df.count() == 15
    with_order = rows(df.where("order_id is not null"), "paycheck_column", "paycheck_value", "order_id")
    assert [(c, float(v), o) for c, v, o in with_order] == [("Net Pay", 2700.0, 1)]


def test_overview_series(models):
    df = serve.chart_series(models["dashboards.monthly_level"], "budget_month", "overview")
    jan = {r["value_type"]: r["value"] for r in df.where("budget_month = date'2024-01-01'").collect()}
    assert jan == {"Pre-Tax Earnings": 3900.0, "Net Pay": 3000.0, "Spend": 1190.0}


def test_overview_labels(models):
    df = serve.overview_labels(models["dashboards.monthly_level"], "monthly")
    assert df.columns[:3] == ["Month", "Pre-Tax Earnings", "Salary"] and len(df.columns) == 24
    assert sorted(r["Month"] for r in df.collect()) == ["1/2024", "2/2024"]


def test_year_blocks_one_job_per_block(models, tmp_path):
    paths = serve.write_year_blocks(models, str(tmp_path / "blocks"))
    assert set(paths) == set(serve.YEAR_BLOCKS)
    needs = models["dashboards.yearly_needs"].sparkSession.read.parquet(paths["needs"])
    assert rows(needs, "budget_year", "Needs") == [(2024, "Rent")]


def test_grain_report(models):
    rep = {r["model"]: r["duplicate_keys"] for r in grain_report(models).collect()}
    assert rep["combined.transactions"] == 1      # T2 repeats once per part, as in the reference
    assert rep["raw.monthly_categories"] == 5     # one row per id and month
    assert rep["dashboards.monthly_level"] == 0


def test_category_order_column_descriptions(models):
    fields = {f.name: f.metadata.get("comment") for f in models["raw.category_orders"].schema.fields}
    assert fields == {"id": "Row Id", "category_group": "Category Group", "subcategory_group": "Subcategory Group",
                      "category_name": "Category Name"}


def test_last_updated_stamp_format(spark):
    import re
    from abacus.functions import last_updated_stamp
    stamp = spark.range(1).select(last_updated_stamp()).first()[0]
    assert re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2} UTC", stamp)


def test_dropped_facts_are_counted(models):
    got = {r["metric"]: r["rows"] for r in dropped_report(models).collect()}
    assert got == {"transactions_without_category": 1, "parts_of_transactions_without_category": 1,
                   "facts_with_unknown_category": 0}


def test_year_blocks_as_csv_with_headers(models, tmp_path):
    paths = serve.write_year_blocks(models, str(tmp_path / "csv"), fmt="csv")
    spark = models["dashboards.yearly_paychecks"].sparkSession
    pay = spark.read.option("header", True).csv(paths["paychecks"])
    assert set(pay.columns) == {"Paycheck Value", "Amount", "budget_year", "position"}
    assert pay.count() == 15
    net = pay.where("`Paycheck Value` = 'Net Pay'").first()
    assert float(net["Amount"]) == 2700.0 and int(net["budget_year"]) == 2024


def test_year_block_read_is_partition_pruned(models, tmp_path):
    root = str(tmp_path / "blocks")
    serve.write_year_blocks(models, root)
    spark = models["dashboards.yearly_needs"].sparkSession
    df = serve.read_year_block(spark, root, "needs", 2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(budget_year" in plan and "= 2024)" in plan
    assert rows(df, "Needs") == [("Rent",)]
    assert serve.read_year_block(spark, root, "needs", 2023).count() == 0


def test_ingest_documents_one_per_line(spark, tmp_path):
    import json
    path = tmp_path / "history.jsonl"
    doc = golden.document()
    with open(path, "w") as f:
        for budget_id in ("B1", "B2", "B3"):
            doc["data"]["budget"]["id"] = budget_id
            f.write(json.dumps(doc) + "\n")
    _, stubs, _ = golden.write_inputs(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="several budgets"):
        ingest(spark, str(path), stubs, str(tmp_path / "landing"), multi_line=False)
    counts = ingest(spark, str(path), stubs, str(tmp_path / "landing"), multi_line=False, budget_id="B2")
    assert counts["transactions"] == 7 and counts["monthly-categories"] == 10


def test_snapshots_of_one_budget_count_once(spark, tmp_path):
    import json
    import os
    doc = golden.document()
    (tmp_path / "docs").mkdir()
    for day in (1, 2):
        path = tmp_path / "docs" / f"{day}.json"
        path.write_text(json.dumps(doc))
        os.utime(path, (day * 86400, day * 86400))
        doc["data"]["budget"]["subtransactions"] = []
    _, stubs, _ = golden.write_inputs(str(tmp_path / "in"))
    counts = ingest(spark, str(tmp_path / "docs"), stubs, str(tmp_path / "landing"))
    assert counts["transactions"] == 7 and counts["subtransactions"] == 0


def test_every_stored_order_applies_to_its_model(models):
    for model in serve.MODEL_ORDER:
        df = serve.ordered(serve.served(models[model]), model)
        assert df.count() == models[model].count(), model


def test_served_names_drop_emoji(models):
    df = serve.clean_category_names(models["raw.monthly_categories"].select(F_name()))
    assert "Rent" in [r[0] for r in df.collect()]


def F_name():
    from pyspark.sql import functions as F
    return F.col("name").alias("category_name")


def test_heavy_only_materialization_gives_the_same_reports(spark, models, tmp_path):
    import os
    from abacus.plans.build import HEAVY_MODELS
    doc, stubs, orders = golden.write_inputs(str(tmp_path / "in"))
    wh = str(tmp_path / "wh")
    light = run(spark, doc, stubs, orders, str(tmp_path / "landing"), wh, as_of=golden.AS_OF,
                materialize=HEAVY_MODELS)
    (version,) = os.listdir(os.path.join(wh, "versions"))
    assert sorted(os.listdir(os.path.join(wh, "versions", version, "cleaned"))) == ["categories", "paystubs"]
    for name in ("dashboards.monthly_level", "combined.yearly_budgeted", "dashboards.yearly_needs"):
        got = sorted(map(tuple, light[name].collect()), key=repr)
        want = sorted(map(tuple, models[name].collect()), key=repr)
        assert got == want, name
