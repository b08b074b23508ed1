"""Co-bucketed split-expansion inputs: same results, no shuffle on the fact-to-fact join."""

import os
import re

import pytest
from pyspark.sql import functions as F

from abacus.operators import expand_cobucketed, split_expand, write_cobucketed
from abacus.plans import serve
from abacus.plans.ingest import run
from tests import golden

COLUMNS = dict(parent_key="id", child_key="transaction_id", overrides={"category_id": "category_id", "amount": "amount", "memo": "memo"},
               carry=["account_id", "transaction_date"], child_id=("id", "part_id"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join path
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark):
    """3,000 parts, a third of them of one transaction; lone transactions, unknown and missing parents."""
    parents = spark.range(400).select(
        F.when(F.col("id") < 399, F.col("id")).alias("id"), (F.col("id") % 7).alias("account_id"), (F.col("id") % 5).alias("category_id"),
        F.lit("2024-01-05").cast("date").alias("transaction_date"), F.col("id").alias("amount"), F.lit("parent").alias("memo"))
    key = (F.when(F.col("id") < 1000, 17).when(F.col("id") < 1040, 23).when(F.col("id") < 1050, None).when(F.col("id") < 1060, 9999)
           .otherwise(F.col("id") % 300))
    parts = spark.range(3000).select(
        F.col("id").cast("string").alias("id"), key.cast("long").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 4).alias("category_id"), (F.col("id") * 10).alias("amount"),
        F.when(F.col("id") % 2 == 0, F.lit("part")).alias("memo"))
    return parents, parts


def test_hot_parent_is_spread_without_a_shuffle(spark, tmp_path, no_broadcast):
    parents, parts = facts(spark)
    stored = write_cobucketed(parents, parts, "id", "transaction_id", 8, str(tmp_path))
    expanded = expand_cobucketed(stored, **COLUMNS)
    text = plan(expanded)
    assert "SortMergeJoin" in text and "Exchange" not in text, text
    assert sorted(map(repr, expanded.collect())) == sorted(map(repr, split_expand(parents, parts, **COLUMNS).collect()))
    # One file a bucket, and the hot parent's parts are in several of them.
    for side in ("parents", "children"):
        files = [f for f in os.listdir(tmp_path / side) if f.startswith("part-")]
        buckets = {re.search(r"_(\d{5})\.", f).group(1) for f in files}
        assert len(files) == len(buckets) <= 8
    hot = stored.children.where("transaction_id = 17").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 600
    copies = stored.parents.groupBy("id").count().where("count > 1").collect()
    assert {r["id"] for r in copies} == {17}


def test_tables_without_hot_parents_or_rows(spark, tmp_path, no_broadcast):
    parents, parts = facts(spark)
    for name, p, c in (("few", parents, parts.where("transaction_id between 30 and 40")), ("lone", parents, parts.limit(0)),
                       ("none", parents.limit(0), parts)):
        stored = write_cobucketed(p, c, "id", "transaction_id", 4, str(tmp_path / name))
        got = sorted(map(repr, expand_cobucketed(stored, **COLUMNS).collect()))
        assert got == sorted(map(repr, split_expand(p, c, **COLUMNS).collect())), name


def test_bucketed_build_gives_the_same_reports(spark, tmp_path, no_broadcast):
    doc, stubs, orders = golden.write_inputs(str(tmp_path / "in"))
    models = run(spark, doc, stubs, orders, str(tmp_path / "landing"), str(tmp_path / "wh"), as_of=golden.AS_OF, buckets=4)
    assert models["combined.transactions"].count() == 7
    got = {r["budget_month"].isoformat(): r["spent"] for r in
           serve.in_units(models["dashboards.monthly_level"]).collect()}
    assert got == {"2024-01-01": -1190.0, "2024-02-01": -1250.0}
