"""Operator edge cases (the traps of SURVEY §5 c) and invariants (§5 d)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from abacus.functions import (amount_from_text, clean_label, group_mapping, iso_date, month_label, round_milli,
                              split_part, strip_emoji, subgroup, to_units, us_date)
from abacus.operators import (AuditFailure, audit_forall, conditional_sums, grain_check, latest_per_key,
                              month_sequence, nonfinite_to_null, positions, raise_on, split_expand, to_series,
                              write_counted, write_observed)
from abacus.sources import read_sheet_csv, read_with_row_ids


def test_month_sequence_guards(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.date(2024, 3, 15)), (dt.date(2024, 3, 1), dt.date(2024, 1, 1)),
         (None, dt.date(2024, 1, 1))], "s date, e date")
    got = [r[0] for r in df.select(month_sequence(F.col("s"), F.col("e"))).collect()]
    assert got[0] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    assert got[1] == [] and got[2] == []  # descending bounds and NULL bound give no months


def test_split_part_out_of_range_is_null(spark):
    df = spark.createDataFrame([("Needs - Home",), ("Savings",), (None,), ("A - B - C",)], "n string")
    got = df.select(group_mapping("n"), subgroup("n"), split_part("n", " - ", 2)).collect()
    assert [tuple(r) for r in got] == [("Needs", "Home", None), ("Savings", None, None), (None, None, None),
                                       ("A", "B", "C")]
    assert df.sparkSession.createDataFrame([("Internal Master Category",)], "n string") \
        .select(group_mapping("n")).first()[0] == "Income"


def test_split_separator_is_literal(spark):
    df = spark.createDataFrame([("a.b",)], "n string")
    assert df.select(split_part("n", ".", 1)).first()[0] == "b"


def test_label_cleanup_keeps_or_drops_plus(spark):
    df = spark.createDataFrame([("  #Café + Toys!! 🏠 & more/less. ",)], "n string")
    r = df.select(clean_label("n", True).alias("a"), clean_label("n", False).alias("b"),
                  strip_emoji(F.lit("🛠️ Tools ☀")).alias("c")).first()
    assert r["a"] == "Café + Toys & more/less."
    assert r["b"] == "Café Toys & more/less."
    assert r["c"] == "Tools"


def test_text_amounts_and_dates(spark):
    df = spark.createDataFrame([("12.5", "1/5/2024"), ("", ""), ("$5", "12/31/2023"), ("1,234.50", "01/02/2024"),
                                ("-0.0005", "2/29/2024"), (" 7 ", ""), ("+.5", ""), ("1e3", ""), ("NaN", ""),
                                (None, "")], "a string, d string")
    got = [tuple(r) for r in df.select(amount_from_text("a"), us_date("d")).collect()]
    assert got == [(12500, dt.date(2024, 1, 5)), (0, None), (0, dt.date(2023, 12, 31)), (0, dt.date(2024, 1, 2)),
                   (-1, dt.date(2024, 2, 29)), (7000, None), (500, None), (1000000, None), (0, None), (0, None)]
    # the guard only skips text the plain cast rejects anyway
    plain = F.coalesce((F.col("a").try_cast("decimal(18,3)") * 1000).cast("bigint"), F.lit(0).cast("bigint"))
    assert [r[0] for r in df.select(plain).collect()] == [g[0] for g in got]


def test_bad_date_text_raises(spark):
    df = spark.createDataFrame([("2024-13-45",)], "d string")
    with pytest.raises(Exception):
        df.select(iso_date("d")).collect()


@pytest.mark.parametrize("value,digits,expected", [
    (1005, 2, 1010), (-1005, 2, -1010), (1004, 2, 1000), (2500, 0, 3000), (-2500, 0, -3000), (2499, 0, 2000),
    (123, 3, 123), (0, 2, 0)])
def test_round_milli_half_away_from_zero(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "v bigint")
    assert df.select(round_milli("v", digits)).first()[0] == expected


def test_to_units_and_month_label(spark):
    r = spark.range(1).select(to_units(F.lit(1005).cast("bigint")).alias("u"),
                              month_label(F.lit("2024-03-01").cast("date")).alias("m")).first()
    assert r["u"] == 1.005 and r["m"] == "3/2024"


def test_split_expand_equals_left_join_with_hot_parent(spark):
    parents = spark.createDataFrame([(1, "a", 100, "p1"), (2, "b", 200, "p2"), (3, "c", 300, "p3")],
                                    "id long, cat string, amount long, memo string")
    # parent 1 is a hot key: most children belong to it; one child has NULL overrides
    kids = [(i, 1, f"k{i % 3}", i, None if i % 4 else f"m{i}") for i in range(1, 400)]
    kids += [(1000, 2, None, 50, "x")]
    children = spark.createDataFrame(kids, "cid long, tid long, cat string, amount long, memo string")
    got = split_expand(parents, children, "id", "tid", {"cat": "cat", "amount": "amount", "memo": "memo"},
                       child_id=("cid", "child"))
    p, c = parents.alias("p"), children.alias("c")
    want = p.join(c, F.col("p.id") == F.col("c.tid"), "left").select(
        "p.id", F.coalesce("c.cat", "p.cat").alias("cat"), F.coalesce("c.amount", "p.amount").alias("amount"),
        F.coalesce("c.memo", "p.memo").alias("memo"), F.col("c.cid").alias("child"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("id = 3").count() == 1 and got.where("id = 1").count() == 399


def test_latest_per_key_aggregate_equals_window(spark):
    rows = [(k, m, y, f"v{k}{m}{y}") for k in range(5) for m in (1, 12, 3) for y in (2022, 2024)]
    rows += [(9, None, 2024, "nullmonth"), (9, 1, 2020, "jan2020")]
    df = spark.createDataFrame(rows, "id int, month int, year int, v string")
    agg = latest_per_key(df, ["id"], ["month", "year"])
    win = latest_per_key(df, ["id"], ["month", "year"], method="window")
    assert sorted(map(tuple, agg.collect())) == sorted(map(tuple, win.collect()))
    # month is compared before year (December 2022 beats March 2024); NULL month sorts last
    assert agg.where("id = 0").first()["v"] == "v0122024"
    assert agg.where("id = 9").first()["v"] == "jan2020"


def test_conditional_sums_null_predicate_is_zero(spark):
    df = spark.createDataFrame([("a", "Needs", 5), ("a", None, 7), ("b", "Wants", 3)], "k string, g string, x long")
    got = {r["k"]: (r["needs"], r["wants"]) for r in conditional_sums(
        df, ["k"], [("needs", F.col("g") == "Needs", F.col("x")), ("wants", F.col("g") == "Wants", F.col("x"))]
    ).collect()}
    assert got == {"a": (5, 0), "b": (0, 3)}


def test_to_series_keeps_nulls_and_labels(spark):
    df = spark.createDataFrame([(2024, 1, None)], "y int, a long, b long")
    got = [tuple(r) for r in to_series(df, ["y"], [("A", F.col("a")), ("B", F.col("b"))], "k", "v").collect()]
    assert got == [(2024, "A", 1.0), (2024, "B", None)]


def test_audit_forall_one_row_per_rule_null_passes(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (None, 1)], "a int, b int")
    got = {r["audit"]: r["violations"] for r in audit_forall(
        df, [("eq", F.col("a") == F.col("b")), ("pos", F.col("b") > 0)]).collect()}
    assert got == {"eq": 1, "pos": 0}


def test_grain_check(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    r = grain_check(df, ["a", "b"], "m").first()
    assert (r["model"], r["duplicate_keys"], r["duplicate_rows"]) == ("m", 2, 5)
    assert grain_check(df.limit(0), ["a"], "e").first()["duplicate_keys"] == 0


def test_nonfinite_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (1.5, 4)], "x double, n int")
    assert [r["x"] for r in nonfinite_to_null(df).orderBy("n").collect()] == [None, None, None, 1.5]


def test_sheet_csv_empty_cells_are_empty_strings(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,\n,x\n")
    got = sorted(tuple(r) for r in read_sheet_csv(spark, path, ["a", "b"]).collect())
    assert got == [("", "x"), ("1", "")]


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    got = positions(df.repartition(7), [F.col("k").desc()]).collect()
    assert sorted((r["position"], r["k"]) for r in got) == [(i + 1, 4999 - i) for i in range(5000)]


def test_write_counted(spark, tmp_path):
    assert write_counted(spark.range(123), str(tmp_path / "out")) == 123
    assert write_counted(spark.range(0), str(tmp_path / "none")) == 0
    parts = spark.range(40).withColumn("part", F.col("id") % 3)
    assert write_counted(parts, str(tmp_path / "parts"), partition_by=["part"]) == 40
    assert write_counted(spark.range(7), str(tmp_path / "out"), mode="append") == 7


def test_audits_are_counted_while_writing(spark, tmp_path):
    """One scan: the rows pass a counter on their way, which a second pass would raise."""
    seen = spark.sparkContext.accumulator(0)
    source = str(tmp_path / "source")
    spark.range(100).repartition(4).write.parquet(source)
    rows = spark.read.parquet(source).withColumn("maybe", F.when(F.col("id") > 97, None).otherwise(F.col("id")))
    counted = rows.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(rows.schema)
    n, broken = write_observed(counted, lambda d: d.write.parquet(str(tmp_path / "out")),
                               [("small", F.col("id") < 90), ("all", F.col("id") >= 0), ("null holds", F.col("maybe") < 96)])
    assert (n, broken) == (100, {"small": 10, "all": 0, "null holds": 2}) and seen.value == 100
    with pytest.raises(AuditFailure, match="small: 10 rows; null holds: 2 rows"):
        raise_on(broken)
    assert write_observed(rows.limit(0), lambda d: d.write.parquet(str(tmp_path / "no")), [("a", F.col("id") > 5)]) == (0, {"a": 0})


def test_counted_write_compares_with_the_files(spark, tmp_path, monkeypatch):
    from abacus.operators import quality
    monkeypatch.setattr(quality, "write_observed", lambda df, write, audits=(): (write(df), (9, {}))[1])
    with pytest.raises(quality.CountMismatch, match="9 rows were written, its files hold 10"):
        write_counted(spark.range(10), str(tmp_path / "out"))


def test_dense_monthly_equals_grid_join(spark):
    import datetime as dt
    from abacus.plans import models as m
    months = [dt.date(2024, i, 1) for i in range(1, 5)]
    spine = spark.createDataFrame([(mo, c) for mo in months[1:4] for c in (1, 2)], "budget_month date, category_id long")
    tx = spark.createDataFrame(
        [(mo, c, 10, 1, 2, 3, 4, 5) for mo in months[:3] for c in (1, 2, 3, None)],
        "transaction_month date, category_id long, income long, emergency_fund_in_hsa long, needs_spend long, "
        "wants_spend long, savings_spend long, emergency_fund_spend long")
    bud = spark.createDataFrame(
        [(mo, c, 7, 8, 9) for mo in months[:3] for c in (2, 3)],
        "budget_month date, category_id long, savings_assigned long, emergency_fund_assigned long, "
        "investments_assigned long")
    cats = spark.createDataFrame([(1,), (2,)], "category_id long")
    pair = m.Spine(F.lit(months[1]), F.lit(months[3]), cats)
    fast = sorted(map(tuple, m.dense_monthly(pair, tx, bud).collect()))
    grid = sorted(map(tuple, m.dense_monthly_grid(spine, tx, bud).select(*m.dense_monthly(pair, tx, bud).columns)
                      .collect()))
    assert fast == grid and len(fast) == 3  # the last spine month has no facts: a NULL row
    for first, last in ((months[3], months[1]), (None, months[1])):
        nothing = m.Spine(F.lit(first).cast("date"), F.lit(last), cats)
        assert m.dense_monthly(nothing, tx, bud).count() == 0


def test_strip_emoji_knows_sequences(spark):
    from abacus.catalogue import EMOJI_SAMPLES
    rows = [(f"{e} Rent {e}{e}",) for e in EMOJI_SAMPLES]
    assert {r[0] for r in spark.createDataFrame(rows, "c string").select(strip_emoji("c")).collect()} == {"Rent"}
    kept = ["7 up", "#1", "* a", "a\u2605b", "caf\u00e9", "\u5bb6", "\u2192", "x\u20e3", "1\u20e2", "", None]
    assert [r[0] for r in spark.createDataFrame([(k,) for k in kept], "c string").coalesce(1).select(strip_emoji("c")).collect()] == kept


def test_scale_settings():
    from abacus.session import scale_settings
    big = scale_settings(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-(25 * 10**12) // (256 << 20))
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == big["spark.sql.shuffle.partitions"]
    small = scale_settings(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_row_ids_match_parquet_file_order_across_row_groups(spark):
    import duckdb
    path = "/root/testdata/sf0.1/lineitem.parquet"
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = read_with_row_ids(spark, path, "parquet", "rid", cols)
        got = set(map(tuple, df.select("rid", *cols).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = set(duckdb.connect().execute(
        f"SELECT file_row_number + 1, {', '.join(cols)} FROM read_parquet('{path}', file_row_number=true)").fetchall())
    assert got == want


def test_row_ids_follow_file_order_across_files(spark, tmp_path):
    for part in range(6):
        with open(tmp_path / f"sheet-{part}.csv", "w") as f:
            f.write("category_name,category_group\n")
            f.writelines(f"name {part}{i:04d},g\n" for i in range(500))
    got = read_with_row_ids(spark, str(tmp_path), "csv", "id", ["category_name"]).collect()
    names = sorted(f"name {part}{i:04d}" for part in range(6) for i in range(500))
    assert sorted((r["id"], r["category_name"]) for r in got) == list(enumerate(names, 1))


def test_sheet_cells_keep_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "q.csv")
    with open(path, "w") as f:
        f.write('extra,b,a\n1,"say ""hi""","two\nlines"\n2,x,\n')
    df = read_with_row_ids(spark, path, "csv", "id", ["a", "b"])
    assert sorted(map(tuple, df.collect())) == [(1, "two\nlines", 'say "hi"'), (2, "", "x")]


def test_bad_dates_raise_without_ansi(spark):
    import pytest
    from abacus.functions import iso_date, us_date
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for column in (us_date(F.lit("13/45/2024")), iso_date(F.lit("2024-13-01"))):
            with pytest.raises(Exception, match="not a date"):
                spark.range(1).select(column).collect()
        assert spark.range(1).select(us_date(F.lit(""))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_raw_model_types_absent_columns(spark):
    import pytest
    from abacus.plans.models import raw_model
    df = raw_model(spark.createDataFrame([("a", "n")], "id string, name string"), "accounts")
    assert dict(df.dtypes)["on_budget"] == "boolean" and dict(df.dtypes)["balance"] == "bigint"
    with pytest.raises(ValueError):
        raw_model(spark.createDataFrame([("n",)], "name string"), "accounts")
