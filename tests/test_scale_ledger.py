"""What the ledger's heavy steps do once per row, and which rows they shuffle."""

import pytest
from pyspark.sql import functions as F

from abacus.catalogue import Ledger, landing_category_groups
from abacus.functions import amount_from_text, clean_label, us_date, whole
from abacus.plans import models as m


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_date_is_parsed_once(spark):
    df = spark.createDataFrame([("1/5/2024",), ("",), (None,)], "t string")
    days = df.select(us_date("t").alias("d"))
    assert _plan(days).count("gettimestamp") == 1
    assert [str(r["d"]) for r in days.collect()] == ["2024-01-05", "None", "None"]
    with pytest.raises(Exception, match="not a date: 13/40/2024"):
        spark.createDataFrame([("13/40/2024",)], "t string").select(us_date("t")).collect()


def test_plain_amounts_equal_decimals(spark):
    texts = ["0", "-0", "-0.00", "1.005", "-1.005", "99999999999.999", "-99999999999.999", "00012.5", "123456789012.345",
             "0.0005", "-1.0005", "5.", ".5", "+5", "1e3", " 7 ", "7\n", "NaN", "Infinity", "1d", "", "$5", "1,234.50", "-", None,
             *[f"{i}.{i * 37 % 1000:03d}" for i in range(0, 4_000_000, 1999)]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    exact = F.coalesce((F.col("t").try_cast("decimal(18,3)") * F.lit(1000).cast("decimal(4,0)")).cast("bigint"), F.lit(0))
    wrong = df.where(~amount_from_text("t").eqNullSafe(exact)).collect()
    assert wrong == []


def test_groups_of_the_ledger_have_a_known_size(spark, tmp_path):
    """Their lazy join has no known size, for which the planner shuffled all facts by group."""
    spark.createDataFrame([(0, "ALGERIA", 0), (1, "BRAZIL", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(
        str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(0, "AFRICA"), (1, "AMERICA")], "r_regionkey int, r_name string").write.parquet(
        str(tmp_path / "region.parquet"))
    spark.sql("select timestamp'1998-01-02' o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select timestamp'1998-01-03' l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    groups = Ledger(spark, str(tmp_path))["cleaned.category_groups"]
    assert "Join" not in _plan(groups)
    lazy = m.cleaned_category_groups(m.raw_model(landing_category_groups(spark, str(tmp_path)), "category_groups"))
    assert sorted(map(str, groups.collect())) == sorted(map(str, lazy.collect()))


def test_accounts_join_parents_not_parts(spark):
    tx = spark.createDataFrame([(1, 10, 100, "2024-01-05", 5, "a"), (2, 11, 100, "2024-01-06", 6, "b"), (3, None, 101, "2024-01-07", 7, None),
                                (3, 12, 101, "2024-01-07", 8, None), (None, 10, 100, "2024-01-08", 9, None)],
                               "id long, account_id long, category_id long, transaction_date string, amount long, memo string")
    parts = spark.createDataFrame([("x", 1, 101, 2, None), ("y", 1, None, 3, "p"), ("z", 3, 100, 4, None), ("w", 9, 100, 1, None)],
                                  "id string, transaction_id long, category_id long, amount long, memo string")
    cats = spark.createDataFrame([(100, 1, "c")], "id long, category_group_id long, category_name string")
    groups = spark.createDataFrame([(1, "Needs - x", "Needs", "x")],
                                   "id long, name string, category_group_name_mapping string, subcategory_group_name string")
    accounts = spark.createDataFrame([(10, "A", "t"), (10, "A2", "u"), (11, "B", "t")], "id long, name string, type string")
    out = m.combined_transactions(tx, parts, cats, groups, accounts)
    got = sorted(((r["id"], r["amount"], r["memo"], r["category_id"], r["account_name"]) for r in out.collect()), key=str)
    assert got == sorted([
        (1, 2, "a", None, "A"), (1, 2, "a", None, "A2"), (1, 3, "p", 100, "A"), (1, 3, "p", 100, "A2"), (2, 6, "b", 100, "B"),
        (3, 4, None, 100, None), (3, 4, None, 100, None), (None, 9, None, 100, "A"), (None, 9, None, 100, "A2")], key=str)
    plan = _plan(out)  # the accounts are below the expansion, a union
    assert plan.index("Union") < plan.index("__account_id")


def test_blank_cells_and_plain_amounts_use_no_decimals_or_doubles(spark):
    """Both were read by a pattern and a double each; blank cells need neither."""
    df = spark.createDataFrame([("",), ("-0.05",), ("7.125",), ("12.5",), ("3",)], "t string")
    plan = _plan(df.select(amount_from_text("t").alias("a")))
    assert "as double" not in plan and plan.index("= )") < plan.index("RLIKE")
    assert [r["a"] for r in df.select(amount_from_text("t").alias("a")).collect()] == [0, -50, 7125, 12500, 3000]


def test_labels_are_cleaned_in_one_pass(spark):
    texts = ["#a  b + c!", "\t x  y \n", "!! ", "a.b&c/d+e", "été \U0001F3E0 1", "", None, "a!\t!b", "+ +", "x   y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for keep_plus, kept in ((True, r"[^\pL\pN\s.&/+]+"), (False, r"[^\pL\pN\s.&/]+")):
        two_passes = F.trim(F.regexp_replace(F.regexp_replace("t", kept, " "), r"\s+", " "))
        one = clean_label("t", keep_plus)
        assert df.where(~one.eqNullSafe(two_passes)).collect() == []
        assert _plan(df.select(one.alias("a"))).count("regexp_replace") == 1


def test_whole_equals_round(spark):
    values = [0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, 0.0, -0.0, 1e15 + 0.5, 4503599627370495.5, -4503599627370495.5,
              123456.4999999999, 9007199254740993.0, 1e18, None, *[i * 0.005 * 100 for i in range(-3000, 3000)],
              *[round(i * 0.0005, 4) * 1000 for i in range(-3000, 3000)]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.where(~whole("x").eqNullSafe(F.round("x").cast("bigint"))).collect() == []
    assert "round(" not in _plan(df.select(whole("x").alias("a")))


def test_ledger_stores_no_table_twice(spark):
    """The parsed sheet was written whole beside its measures, and the monthly categories raw and looked up."""
    stored = Ledger.MATERIALIZED
    assert "combined.paystubs" in stored and "cleaned.paystubs" not in stored
    assert "raw.monthly_categories" in stored and "combined.budgeted" not in stored
