"""Run the warehouse: landing -> raw -> cleaned -> combined -> dashboards.

The build order is a plain list. Each model is written once, to a new version of the
warehouse, and read back by its consumers, so lineage is cut at every model: a lost executor
recomputes at most one model's stages, and models with several consumers are not
recomputed per consumer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from abacus.operators import (CoBuckets, assert_audits, audit_forall, grain_check, raise_on, write_cobucketed,
                              write_observed)
from abacus.plans import models as m
from abacus.plans import publish
from abacus.sources import landing

# Declared grain of each model (report-only: several are not unique by design).
GRAINS = {
    "raw.accounts": ["id"], "raw.category_groups": ["id"], "raw.subtransactions": ["id"],
    "raw.transactions": ["id"], "raw.paystubs": ["file_name", "pay_period_start_date"],
    "raw.monthly_categories": ["id"],
    "cleaned.accounts": ["id"], "cleaned.category_groups": ["id"], "cleaned.sub_transactions": ["id"],
    "cleaned.transactions": ["id"], "cleaned.paystubs": ["file_name", "pay_period_start_date"],
    "cleaned.monthly_categories": ["id"], "cleaned.categories": ["id"],
    "cleaned.category_orders": ["order_id"],
    "combined.budgeted": ["budget_month", "category_id"], "combined.paystubs": ["pay_date"],
    "combined.record_spine": ["budget_month", "category_id"], "combined.transactions": ["id"],
    "combined.yearly_budgeted": ["order_id", "budget_year"],
    "dashboards.monthly_level": ["budget_month"], "dashboards.yearly_level": ["budget_year"],
    "dashboards.yearly_category_group": ["category_group_name_mapping", "budget_year"],
    "dashboards.yearly_subcategory_group": ["subcategory_group", "budget_year"],
    "dashboards.yearly_needs": ["category_name", "budget_year"],
    "dashboards.yearly_wants": ["category_name", "budget_year"],
    "dashboards.yearly_other": ["category_name", "budget_year"],
    "dashboards.yearly_paychecks": ["budget_year", "paycheck_column"],
}


def model_steps(as_of: dt.date | str | None, split: Callable[[], CoBuckets | None] = lambda: None,
                ) -> list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]]:
    """(model name, function of the already-built models) in build order.

    ``combined.yearly_budgeted`` reads ``dashboards.yearly_level``, so it comes after it.
    ``split`` gives the co-bucketed inputs of the split expansion, if they were written.
    """
    return [
        ("cleaned.accounts", lambda t: m.cleaned_accounts(t["raw.accounts"])),
        ("cleaned.category_groups", lambda t: m.cleaned_category_groups(t["raw.category_groups"])),
        ("cleaned.sub_transactions", lambda t: m.cleaned_sub_transactions(t["raw.subtransactions"])),
        ("cleaned.transactions", lambda t: m.cleaned_transactions(t["raw.transactions"])),
        ("cleaned.paystubs", lambda t: m.cleaned_paystubs(t["raw.paystubs"])),
        ("cleaned.monthly_categories", lambda t: m.cleaned_monthly_categories(t["raw.monthly_categories"])),
        ("cleaned.categories", lambda t: m.cleaned_categories(t["raw.monthly_categories"])),
        ("cleaned.category_orders", lambda t: m.cleaned_category_orders(t["raw.category_orders"])),
        ("combined.budgeted", lambda t: m.combined_budgeted(t["cleaned.monthly_categories"],
                                                            t["cleaned.category_groups"])),
        ("combined.paystubs", lambda t: m.combined_paystubs(t["cleaned.paystubs"])),
        ("combined.record_spine", lambda t: m.combined_record_spine(
            t["cleaned.transactions"], t["cleaned.categories"], t["cleaned.category_groups"], as_of)),
        ("combined.transactions", lambda t: m.combined_transactions(
            t["cleaned.transactions"], t["cleaned.sub_transactions"], t["cleaned.categories"],
            t["cleaned.category_groups"], t["cleaned.accounts"], split())),
        ("dashboards.monthly_level", lambda t: m.dashboards_monthly_level(
            t["combined.transactions"], t["combined.budgeted"], t["combined.paystubs"],
            m.month_spine(t["cleaned.transactions"], t["cleaned.categories"], as_of))),
        ("dashboards.yearly_level", lambda t: m.dashboards_yearly_level(t["dashboards.monthly_level"])),
        ("combined.yearly_budgeted", lambda t: m.combined_yearly_budgeted(
            t["combined.budgeted"], t["cleaned.category_orders"], t["dashboards.yearly_level"])),
        ("dashboards.yearly_category_group",
         lambda t: m.dashboards_yearly_category_group(t["combined.yearly_budgeted"])),
        ("dashboards.yearly_subcategory_group",
         lambda t: m.dashboards_yearly_subcategory_group(t["combined.yearly_budgeted"])),
        ("dashboards.yearly_needs", lambda t: m.dashboards_group_slice(t["combined.yearly_budgeted"], "Needs")),
        ("dashboards.yearly_wants", lambda t: m.dashboards_group_slice(t["combined.yearly_budgeted"], "Wants")),
        ("dashboards.yearly_other", lambda t: m.dashboards_group_slice(t["combined.yearly_budgeted"], "Other")),
        ("dashboards.yearly_paychecks", lambda t: m.dashboards_yearly_paychecks(
            t["dashboards.yearly_level"], t["cleaned.category_orders"])),
    ]


def raw_tables(spark: SparkSession, landing_root: str, category_orders: DataFrame) -> dict[str, DataFrame]:
    """The raw layer over the landing area (plus the category-order sheet with row ids)."""
    tables = {f"raw.{model}": m.raw_model(landing.scan(spark, landing_root, name), model)
              for model, name in m.RAW_LANDING.items()}
    tables["raw.category_orders"] = m.raw_category_orders(category_orders)
    return tables


# The one fact-to-fact join (split expansion) joins these models.
SPLIT_PARENTS, SPLIT_PARTS = "cleaned.transactions", "cleaned.sub_transactions"


# Models worth writing when not every model must be stored: aggregates, joins, the text
# parse, and reports with several consumers (plain projections are folded into readers).
HEAVY_MODELS = frozenset({
    "cleaned.categories", "cleaned.paystubs", "combined.transactions", "combined.budgeted",
    "combined.record_spine", "dashboards.monthly_level", "dashboards.yearly_level",
    "combined.yearly_budgeted", "dashboards.yearly_paychecks",
})


def build(spark: SparkSession, raw: dict[str, DataFrame], warehouse_root: str | None = None,
          as_of: dt.date | str | None = None, audit: bool = True,
          buckets: int | None = None, materialize: frozenset[str] | set[str] | None = None) -> dict[str, DataFrame]:
    """Build every model in order.

    With ``warehouse_root`` each model is written to a new version of the warehouse and
    re-read, cutting lineage, and the version is published when all of it is written
    (``plans.publish``: readers see whole builds only). Without it the models stay lazy (one plan per
    consumer, for tests and small inputs). ``materialize`` limits the written models to a
    subset (e.g. ``HEAVY_MODELS``); the others stay lazy. ``buckets`` co-buckets the two inputs of
    the split expansion, hot transactions dealt over several buckets (needs a session catalog). The
    paystub audits are counted while ``cleaned.paystubs`` is written, and stop the build on a violation.
    """
    tables, rows = dict(raw), {}
    version = publish.new_version() if warehouse_root else None
    split: CoBuckets | None = None
    for name, make in model_steps(as_of, lambda: split):
        df = make(tables)
        audits = m.paystub_audits() if audit and name == "cleaned.paystubs" else []
        if warehouse_root and (materialize is None or name in materialize):
            path = publish.version_path(warehouse_root, version, name)
            rows[name], broken = write_observed(df, lambda d: d.write.parquet(path), audits)
            raise_on(broken)
            df = spark.read.schema(df.schema).parquet(path)
        elif audits:
            assert_audits(audit_forall(df, audits))
        tables[name] = df
        if warehouse_root and buckets and {SPLIT_PARENTS, SPLIT_PARTS} <= tables.keys() and split is None:
            split = write_cobucketed(tables[SPLIT_PARENTS], tables[SPLIT_PARTS], "id", "transaction_id", buckets,
                                     publish.version_path(warehouse_root, version, "split.buckets"))
    if warehouse_root:
        publish.publish(spark, warehouse_root, version, rows)
    return tables


def dropped_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Counts of the rows the model rules drop on purpose (see ``models.dropped_facts_report``)."""
    return m.dropped_facts_report(tables["raw.transactions"], tables["raw.subtransactions"],
                                  tables["combined.transactions"])


def grain_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate-key counts of every model against its declared grain (one row per model)."""
    reports = [grain_check(df, GRAINS[name], name) for name, df in tables.items() if name in GRAINS]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out
