"""Invariants of SURVEY §5 (d) on the analog ledger and the golden ledger."""

import os

import pytest
from pyspark.sql import functions as F

from abacus.catalogue import Ledger
from abacus.plans import models as m
from abacus.plans.ingest import run
from tests import golden

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ledger(spark):
    return Ledger.of(spark, SF)


def test_months_roll_up_to_years(ledger):
    monthly = ledger["dashboards.monthly_level"].withColumn("budget_year", F.year("budget_month"))
    by_year = monthly.groupBy("budget_year").agg(*[F.sum(c).alias(c) for c in m.LEVEL_MEASURES])
    yearly = ledger["dashboards.yearly_level"]
    assert sorted(map(tuple, by_year.collect())) == sorted(map(tuple, yearly.select(by_year.columns).collect()))


def test_spine_is_months_times_categories(ledger):
    spine = ledger["combined.record_spine"]
    n_months = spine.select("budget_month").distinct().count()
    n_cats = ledger["cleaned.categories"].count()
    assert spine.count() == n_months * n_cats
    assert spine.groupBy("budget_month", "category_id").count().where("count > 1").count() == 0


def test_report_months_are_contiguous(ledger):
    months = [r[0] for r in ledger["dashboards.monthly_level"].select("budget_month").orderBy("budget_month").collect()]
    for a, b in zip(months, months[1:]):
        assert (b.year * 12 + b.month) - (a.year * 12 + a.month) == 1


def test_split_expansion_preserves_totals_when_parts_sum(spark, tmp_path):
    doc, stubs, orders = golden.write_inputs(str(tmp_path / "in"))
    models = run(spark, doc, stubs, orders, str(tmp_path / "landing"), None, as_of=golden.AS_OF)
    before = models["cleaned.transactions"].agg(F.sum("amount")).first()[0]
    after = models["combined.transactions"].agg(F.sum("amount")).first()[0]
    assert before == after == -1000000 - 190000 + 3000000 - 1000000 - 250000 + 3100000


def test_yearly_budgeted_keeps_every_group_row(ledger):
    # the label join may add order ids but never loses an aggregated row
    yb = ledger["combined.yearly_budgeted"]
    keys = ["budget_year", "category_group_name_mapping", "subcategory_group", "category_name"]
    assert yb.select(keys).distinct().count() <= yb.count()
    assert yb.where(F.col("category_group_name_mapping").isin("Income", "Credit Card Payments")).count() == 0
