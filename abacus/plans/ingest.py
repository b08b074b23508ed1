"""Ingest saved budget documents and sheet exports into the landing area, then build."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from abacus import schemas
from abacus.operators import write_counted
from abacus.plans.build import build, raw_tables
from abacus.sources import (current_budget, landing, landing_frames, read_sheet_csv, read_with_row_ids, saved_documents,
                            stored)

PAYSTUBS_LANDING = "raw-paystubs"


def ingest(spark: SparkSession, documents: str, paystubs_csv: str, landing_root: str,
           multi_line: bool = True, budget_id: str | None = None) -> dict[str, int]:
    """Flatten the newest document of one budget and the paystub sheet into landing Parquet;
    rows written to each. A folder of daily snapshots gives the same tables as its newest one.

    The newest document is found by its id, time and place, parsed once and stored; the
    five tables read their own part of it.
    """
    counts = {}
    budgets = stored(current_budget(saved_documents(spark, documents, multi_line), budget_id))
    for name, df in landing_frames(budgets).items():
        counts[name] = write_counted(df, landing.landing_path(landing_root, name))
    stubs = read_sheet_csv(spark, paystubs_csv, schemas.PAYSTUB_COLUMNS)
    counts[PAYSTUBS_LANDING] = write_counted(stubs, landing.landing_path(landing_root, PAYSTUBS_LANDING))
    return counts


def run(spark: SparkSession, documents: str, paystubs_csv: str, category_orders_csv: str,
        landing_root: str, warehouse_root: str | None, as_of: dt.date | str | None = None,
        multi_line: bool = True, buckets: int | None = None,
        materialize: frozenset[str] | set[str] | None = None, budget_id: str | None = None) -> dict[str, DataFrame]:
    """The daily run: ingest, then build every model."""
    ingest(spark, documents, paystubs_csv, landing_root, multi_line=multi_line, budget_id=budget_id)
    orders = read_with_row_ids(spark, category_orders_csv, "csv", "id", schemas.CATEGORY_ORDER_COLUMNS)
    return build(spark, raw_tables(spark, landing_root, orders), warehouse_root, as_of, buckets=buckets,
                 materialize=materialize)
