"""The query catalogue on the generated test tables.

The test tables hold no budget data, so the ledger is *derived* from them by Spark
(an analog ledger), and every query runs the real model or operator functions over
it, reading whole tables:

* ``orders``   -> transactions (date, amount, priority as memo, customer as account;
  orders with status ``'P'`` have no category and are dropped with their parts)
* ``lineitem`` -> split parts of those transactions; monthly category budgets
  (aggregated by part and ship month); the paystub sheet (one stub per line, as text)
* ``part``     -> category labels and the category-order sheet (ids in file order)
* ``nation`` / ``region`` -> category groups; ``customer`` -> accounts
* ``events``   -> JSON documents, unit scaling, latest row per user

``oracle_sql()`` holds an independent DuckDB translation of each query over the same
tables. Money leaves both sides as DOUBLE units converted from exact values (integer
thousandths in Spark, decimals in DuckDB), so the results compare exactly.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacus.functions import (clean_label, group_mapping, iso_date, make_month, month_start, strip_emoji,
                              subgroup, to_units, whole)
from abacus.operators import (audit_forall, bounded_month_spine, grain_check, latest_per_key,
                              nonfinite_to_null, split_expand, write_counted)
from abacus.plans import models as m
from abacus.plans import serve
from abacus.plans.build import GRAINS, build, grain_report, model_steps, raw_tables
from abacus.session import scratch_path
from abacus.sources import (current_budgets, flatten_entity, flatten_monthly_categories, landing, parse_budget_documents,
                            read_budget_documents, read_with_row_ids, saved_documents)

# The year whose report blocks are served.
REPORT_YEAR = 1998

# Fixed values of the analog: budget group of each region, and the three nations that
# stand for the income group and two groups without a subgroup.
REGION_GROUP = [("AFRICA", "Needs"), ("AMERICA", "Wants"), ("ASIA", "Savings"),
                ("EUROPE", "Emergency Fund"), ("MIDDLE EAST", "Investments")]
SPECIAL_NATIONS = [(0, "Internal Master Category"), (5, "Credit Card Payments"), (10, "Net Zero Expenses")]
# Sheet group of each part type in the category-order sheet.
TYPE_SHEET_GROUP = [("STANDARD", "Needs"), ("ECONOMY", "Wants"), ("PROMO", "Paycheck")]
PAYCHECK_LABELS = [label for label, _ in m.PAYCHECK_LINES]


# ------------------------------------------------------------------ helpers

def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _as_of(spark: SparkSession, sf: str) -> Column:
    """The last day of the facts, at which the spine ends (a scalar, computed by the executors)."""
    last = [_t(spark, sf, name).agg(F.max(F.to_date(c))).scalar()
            for name, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return F.greatest(*last)


def _milli(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return whole(c * 1000)


def _case(col: Column, pairs, default) -> Column:
    out = None
    for k, v in pairs:
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(default)


def _out(df: DataFrame, money: bool = True) -> DataFrame:
    """Result types shared with the oracle: money in DOUBLE units, small ints -> bigint."""
    if money:
        df = serve.in_units(df)
    fixes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) or isinstance(f.dataType, T.FloatType):
            fixes[f.name] = F.col(f"`{f.name}`").cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            fixes[f.name] = F.col(f"`{f.name}`").cast("bigint")
    return df.withColumns(fixes) if fixes else df


def _decorated_name(partkey: Column, p_name: Column, p_type: Column) -> Column:
    kind = F.when(p_type == "SMALL", F.lit("HSA")).otherwise(p_type)
    return F.concat(F.lit("#"), p_name, F.lit(" "), partkey.cast("string"), F.lit(" + "), kind, F.lit("!"))


# ------------------------------------------------------------------ analog landing tables

def landing_transactions(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        _milli("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("memo"),
        F.col("o_custkey").alias("account_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey")).alias("category_id"),
        F.col("o_orderstatus").alias("import_payee_name"),
    )


def landing_subtransactions(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_orderkey").alias("transaction_id"),
        _milli("l_extendedprice").alias("amount"),
        F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_returnflag")).alias("memo"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_partkey")).alias("category_id"),
    )


def landing_accounts(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type"),
        (F.col("c_acctbal") >= 0).alias("on_budget"), F.lit(False).alias("closed"),
        _milli("c_acctbal").alias("balance"), _milli("c_acctbal").alias("cleared_balance"),
        F.lit(0).cast("bigint").alias("uncleared_balance"),
    )


def landing_category_groups(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    joined = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    group = _case(F.col("r_name"), REGION_GROUP, F.lit(None).cast("string"))
    name = _case(F.col("n_nationkey"), SPECIAL_NATIONS,
                 F.concat(group, F.lit(" - "), F.col("n_name")))
    return joined.select(F.col("n_nationkey").cast("bigint").alias("id"), name.alias("name"),
                         F.lit(False).alias("hidden"), F.lit(False).alias("deleted"))


def landing_monthly_categories(spark, sf):
    li, p = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    per_month = li.groupBy(
        "l_partkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
    ).agg(F.sum(_milli("l_extendedprice")).alias("budgeted"),
          (-F.sum(F.col("l_quantity").cast("bigint") * 1000)).alias("activity"))
    joined = per_month.join(p, per_month["l_partkey"] == p["p_partkey"], "left")
    return joined.select(
        F.col("l_partkey").alias("id"), F.col("p_size").cast("bigint").alias("category_group_id"),
        _decorated_name(F.col("l_partkey"), F.col("p_name"), F.col("p_type")).alias("name"),
        F.lit(False).alias("hidden"), "budgeted", "activity",
        (F.col("budgeted") + F.col("activity")).alias("balance"), "month", "year",
    )


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def _cents_text(c: Column) -> Column:
    """Integer cents -> ``'1234.50'``."""
    a = F.abs(c)
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")),
                    ((a - F.pmod(a, F.lit(100))) / F.lit(100)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad(F.pmod(a, F.lit(100)).cast("string"), 2, "0"))


def landing_paystubs(spark, sf):
    """The paystub sheet as text: one stub per line item; components add up to the totals
    except where a total is blank or a bonus has a currency sign (the audits catch those)."""
    li = _t(spark, sf, "lineitem")
    salary = _cents(F.col("l_extendedprice"))
    bonus = _cents(F.col("l_quantity"))
    reimbursed = _cents(F.col("l_tax") * 100)
    k401 = _cents(F.col("l_discount") * 100)
    hsa = _cents(F.col("l_linenumber"))
    federal = _cents(F.col("l_quantity") * 2)
    state = _cents(F.col("l_linenumber"))
    roth = reimbursed
    earnings = salary + bonus + reimbursed
    pre_tax, taxes, post_tax = k401 + hsa, federal + state, roth
    net = earnings - pre_tax - taxes - post_tax
    txt = _cents_text
    day = F.to_date("l_shipdate")
    cells = {
        "file_name": F.concat(F.lit("stub-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                              F.col("l_linenumber").cast("string")),
        "employer": F.col("l_returnflag"),
        "pay_period_start_date": F.date_format(F.date_sub(day, 13), "M/d/yyyy"),
        "pay_period_end_date": F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.date_format(day, "M/d/yyyy")),
        "pay_date": F.date_format(day, "M/d/yyyy"),
        "net_pay": txt(net),
        "earnings_total": F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(txt(earnings)),
        "pre_tax_deductions": txt(pre_tax), "taxes": txt(taxes), "post_tax_deductions": txt(post_tax),
        "earnings_salary": txt(salary),
        "earnings_bonus": F.when(F.col("l_returnflag") == "A", F.concat(F.lit("$"), txt(bonus))).otherwise(txt(bonus)),
        "earnings_expense_reimbursement": txt(reimbursed),
        "pre_tax_401k": txt(k401), "pre_tax_hsa": txt(hsa),
        "taxes_federal": txt(federal), "taxes_state": txt(state), "post_tax_roth": txt(roth),
    }
    return li.select(*[cells.get(c, F.lit("")).alias(c) for c in m.RAW_COLUMNS["paystubs"]])


def sheet_category_orders(spark, sf):
    """The category-order sheet: one row per part, ids 1..N in the part file's order."""
    p = read_with_row_ids(spark, os.path.join(sf, "part.parquet"), "parquet", "id",
                          ["p_partkey", "p_name", "p_type", "p_brand", "p_size"])
    promo = F.col("p_type") == "PROMO"
    labels = F.array(*[F.lit(x) for x in PAYCHECK_LABELS])
    name = F.when(promo, F.coalesce(F.get(labels, F.col("p_size") - 1), F.lit(""))).otherwise(
        clean_label(_decorated_name(F.col("p_partkey"), F.col("p_name"), F.col("p_type")), keep_plus=False))
    return p.select(
        F.col("id"),
        _case(F.col("p_type"), TYPE_SHEET_GROUP, F.lit("Other")).alias("category_group"),
        F.when(promo, F.lit("")).otherwise(F.col("p_brand")).alias("subcategory_group"),
        name.alias("category_name"),
    )


# ------------------------------------------------------------------ the analog warehouse (lazy)

class Ledger:
    """The analog warehouse: each model is built on first use, written once to the shared
    checkpoint folder and read back (lineage is cut there, as in ``plans.build``).

    Ledgers are kept per Spark application and state of the input files, so queries of one
    session share the models built so far, like reports reading a built warehouse, and
    changed input files give a new ledger.
    """

    _open: dict[tuple, "Ledger"] = {}
    INPUTS = ["region", "nation", "customer", "part", "orders", "lineitem"]
    # Models worth writing: aggregates, joins, row ids, the text parse, and reports with
    # several consumers. Plain projections stay lazy and are folded into their readers' plans.
    # The groups are written so that their size is known: of a lazy join the planner knows only a
    # bound, for which it shuffles the facts by group. Of the paystubs the dozen pay measures are
    # written, not the parsed sheet's forty-five columns; of the monthly categories the raw rows, which
    # ``combined.budgeted`` only projects and looks up. Their readers parse and clean what they read.
    MATERIALIZED = {
        "raw.monthly_categories", "cleaned.category_groups", "raw.category_orders", "cleaned.categories", "combined.paystubs",
        "combined.transactions", "combined.record_spine", "dashboards.monthly_level",
        "dashboards.yearly_level", "combined.yearly_budgeted", "dashboards.yearly_paychecks",
    }
    # Build order of every model (``plans.build`` order plus the raw layer first).
    ORDER = ["raw.transactions", "raw.subtransactions", "raw.accounts", "raw.category_groups",
             "raw.monthly_categories", "raw.paystubs", "raw.category_orders"]

    def __init__(self, spark: SparkSession, sf: str, materialize: bool = True):
        self.spark, self.sf, self.materialize, self._t, self._steps = spark, sf, materialize, {}, None

    @classmethod
    def of(cls, spark: SparkSession, sf: str) -> "Ledger":
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load([os.path.join(sf, f"{name}.parquet") for name in cls.INPUTS]))
        state = files.agg(F.count("path"), F.max("modificationTime"), F.sum("length")).first()
        key = (spark.conf.get("spark.app.id", None) or str(id(spark)), sf, *state)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf)
        return cls._open[key]

    def __getitem__(self, name):
        if name not in self._t:
            df = self._make(name)
            if self.materialize and name in self.MATERIALIZED:
                path = scratch_path(self.spark, "ledger/" + name.replace(".", "_"))
                df.write.mode("overwrite").parquet(path)
                df = self.spark.read.parquet(path)
            self._t[name] = df
        return self._t[name]

    @classmethod
    def build_order(cls) -> list[str]:
        return cls.ORDER + [name for name, _ in model_steps(None)]

    def _make(self, name):
        s, sf, t = self.spark, self.sf, self
        raw = {
            "raw.transactions": lambda: m.raw_model(landing_transactions(s, sf), "transactions"),
            "raw.subtransactions": lambda: m.raw_model(landing_subtransactions(s, sf), "subtransactions"),
            "raw.accounts": lambda: m.raw_model(landing_accounts(s, sf), "accounts"),
            "raw.category_groups": lambda: m.raw_model(landing_category_groups(s, sf), "category_groups"),
            "raw.monthly_categories": lambda: m.raw_model(landing_monthly_categories(s, sf), "monthly_categories"),
            "raw.paystubs": lambda: m.raw_model(landing_paystubs(s, sf), "paystubs"),
            "raw.category_orders": lambda: m.raw_category_orders(sheet_category_orders(s, sf)),
        }
        if name in raw:
            return raw[name]()
        if self._steps is None:
            self._steps = dict(model_steps(_as_of(s, sf)))
        return self._steps[name](t)


# ------------------------------------------------------------------ queries

def q_scan_project(spark, sf):
    return _out(m.cleaned_accounts(Ledger.of(spark, sf)["raw.accounts"]).drop(
        "note", "transfer_payee_id", "last_reconciled_at"))


def q_unit_scale(spark, sf):
    e = _t(spark, sf, "events")
    milli = _milli("value")
    return e.select("event_id", milli.alias("value_milli"), to_units(milli).alias("value_units"))


def q_json_flatten(spark, sf):
    e = _t(spark, sf, "events")
    tx = F.struct(
        F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
        _milli("value").alias("amount"), F.col("event_type").alias("memo"),
        F.col("user_id").cast("string").alias("category_id"), F.col("props").alias("import_id"))
    doc = F.to_json(F.struct(F.struct(F.struct(
        F.col("event_id").cast("string").alias("id"), F.array(tx).alias("transactions"),
    ).alias("budget")).alias("data")))
    flat = flatten_entity(parse_budget_documents(e.select(doc.alias("doc")), "doc"), "transactions")
    k = F.from_json("import_id", "k int").getField("k")
    return _out(flat.select("id", "date", "amount", "memo", "category_id", k.alias("k")), money=False)


def q_json_two_level(spark, sf):
    o = _t(spark, sf, "orders")
    cat = lambda i, g, n, b: F.struct(i.alias("id"), g.alias("category_group_id"), n.alias("name"),
                                      b.alias("budgeted"))
    first = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("month"),
        F.when(F.col("o_orderstatus") == "P", F.array()).otherwise(F.array(
            cat(F.col("o_custkey").cast("string"), F.col("o_orderpriority"), F.lit("customer"), _milli("o_totalprice")),
            cat(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), F.lit("order"), -_milli("o_totalprice")),
        )).alias("categories"))
    second = F.struct(
        F.date_format(F.add_months(month_start("o_orderdate"), 1), "yyyy-MM-dd").alias("month"),
        F.array(cat(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.lit("next"),
                    F.lit(0).cast("bigint"))).alias("categories"))
    doc = F.to_json(F.struct(F.struct(F.struct(F.array(first, second).alias("months")).alias("budget")).alias("data")))
    flat = flatten_monthly_categories(parse_budget_documents(o.select(doc.alias("doc")), "doc"))
    return _out(flat.select("id", "category_group_id", "name", "budgeted", "month", "year"), money=False)


def q_row_ids(spark, sf):
    df = read_with_row_ids(spark, os.path.join(sf, "orders.parquet"), "parquet", "row_id", ["o_orderkey"])
    return df.select("row_id", "o_orderkey")


def q_typed_from_text(spark, sf):
    p = Ledger.of(spark, sf)["cleaned.paystubs"]
    return _out(p.select("file_name", "pay_period_start_date", "pay_period_end_date", "pay_date", "net_pay_total",
                         "earnings_total", "earnings_salary", "earnings_bonus", "pre_tax_401k", "taxes_federal"))


def _label(p: DataFrame) -> Column:
    return F.concat(F.lit("#"), p["p_name"], F.lit(" + "), p["p_type"], F.lit("! \U0001F3E0"))


def q_clean_label(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", clean_label(_label(p), keep_plus=True).alias("label_with_plus"),
                    clean_label(_label(p), keep_plus=False).alias("label_without_plus"))


# Emoji put into labels, each of another kind: plain, styled, keycaps, flags, skin tones, joined, tagged, and old symbols.
EMOJI_SAMPLES = ["\U0001F6E0\uFE0F", "\u2600", "1\uFE0F\u20E3", "#\u20E3", "\U0001F1E9\U0001F1EA", "\U0001F44D\U0001F3FD",
                 "\U0001F468\u200D\U0001F469\u200D\U0001F467", "\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F",
                 "\u2B50", "\u231A", "\u2139\uFE0F", "\u00A9", "\u2B06", "\u2764\uFE0F\u200D\U0001F525", "\U0001FAE9", "\u3299"]


def q_strip_emoji(spark, sf):
    """Every kind of emoji before and after labels that hold digits and symbols which are none."""
    p = _t(spark, sf, "part")
    kinds = F.array(*[F.lit(e) for e in EMOJI_SAMPLES])
    before = F.get(kinds, F.pmod(F.col("p_partkey"), F.lit(len(EMOJI_SAMPLES))).cast("int"))
    after = F.get(kinds, F.pmod(F.col("p_partkey") * 7 + 3, F.lit(len(EMOJI_SAMPLES))).cast("int"))
    label = F.concat(before, F.lit(" "), p["p_name"], after, F.lit(" \u2605 7#"), after, before)
    return p.select("p_partkey", strip_emoji(label).alias("category_name"))


def q_group_mapping(spark, sf):
    p = _t(spark, sf, "part")
    name = (F.when(F.col("p_brand") == "Brand#1", F.lit("Internal Master Category"))
            .when(F.col("p_size") < 10, F.col("p_brand"))
            .otherwise(F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_type"))))
    g = p.select("p_partkey", name.alias("name"))
    return g.select("p_partkey", "name", group_mapping("name").alias("category_group_name_mapping"),
                    subgroup("name").alias("subcategory_group_name"))


def q_month_key(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        make_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_from_parts"),
        month_start(iso_date(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("month_from_text"),
        month_start("o_orderdate").alias("month_trunc"),
    )


def q_conditional_columns(spark, sf):
    return _out(m.monthly_budgeted(Ledger.of(spark, sf)["combined.budgeted"]))


def q_split_expand(spark, sf):
    led = Ledger.of(spark, sf)
    out = split_expand(led["cleaned.transactions"], led["cleaned.sub_transactions"], "id", "transaction_id",
                       {"category_id": "category_id", "amount": "amount", "memo": "memo"},
                       carry=["account_id", "transaction_date"])
    return _out(out)


def q_enrich_chain(spark, sf):
    tx = Ledger.of(spark, sf)["combined.transactions"]
    return _out(tx.groupBy("category_group_name_mapping", "account_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("category_id").isNull(), 1)).alias("n_unknown_category"),
        F.count(F.when(F.col("account_name").isNull(), 1)).alias("n_unknown_account"),
        F.sum("amount").alias("amount")))


def q_enriched_transactions(spark, sf):
    return _out(Ledger.of(spark, sf)["combined.transactions"])


def q_latest_per_key(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_id", "event_type", "value",
                                       F.month("ts").alias("month"), F.year("ts").alias("year"))
    return _out(latest_per_key(e, ["user_id"], ["month", "year", "event_id"]))


def q_categories_latest(spark, sf):
    return _out(Ledger.of(spark, sf)["cleaned.categories"])


def q_conditional_sums(spark, sf):
    return _out(m.monthly_transactions(Ledger.of(spark, sf)["combined.transactions"]))


def _monthly_parts(led):
    return (m.monthly_transactions(led["combined.transactions"]), m.monthly_budgeted(led["combined.budgeted"]),
            m.monthly_paystubs(led["combined.paystubs"]))


def q_date_range(spark, sf):
    led = Ledger.of(spark, sf)
    bounds = m.report_date_bounds(led["combined.transactions"], led["combined.budgeted"], led["combined.paystubs"])
    return bounded_month_spine(bounds, "min_date", "max_date")


def q_record_spine(spark, sf):
    return _out(Ledger.of(spark, sf)["combined.record_spine"])


def q_dense_rollup(spark, sf):
    led = Ledger.of(spark, sf)
    mt, mb, _ = _monthly_parts(led)
    spine = m.month_spine(led["cleaned.transactions"], led["cleaned.categories"], _as_of(spark, sf))
    return _out(m.dense_monthly(spine, mt, mb))


def q_pay_measures(spark, sf):
    return _out(Ledger.of(spark, sf)["combined.paystubs"])


def q_pay_monthly(spark, sf):
    return _out(m.monthly_paystubs(Ledger.of(spark, sf)["combined.paystubs"]))


def q_monthly_level(spark, sf):
    return _out(Ledger.of(spark, sf)["dashboards.monthly_level"])


def q_yearly_level(spark, sf):
    return _out(Ledger.of(spark, sf)["dashboards.yearly_level"])


def q_yearly_budgeted(spark, sf):
    return _out(Ledger.of(spark, sf)["combined.yearly_budgeted"])


def q_yearly_group(spark, sf):
    return _out(Ledger.of(spark, sf)["dashboards.yearly_category_group"])


def q_yearly_subgroup(spark, sf):
    return _out(Ledger.of(spark, sf)["dashboards.yearly_subcategory_group"])


def _slice(group):
    return lambda spark, sf: _out(Ledger.of(spark, sf)[f"dashboards.yearly_{group}"])


def q_unpivot_ordered(spark, sf):
    return _out(Ledger.of(spark, sf)["dashboards.yearly_paychecks"])


def _chart(level, series):
    key = "budget_month" if level == "monthly" else "budget_year"
    return lambda spark, sf: _out(serve.chart_series(Ledger.of(spark, sf)[f"dashboards.{level}_level"], key, series))


def _extract(level):
    key = "budget_month" if level == "monthly" else "budget_year"
    return lambda spark, sf: _out(serve.dashboard_extract(Ledger.of(spark, sf)[f"dashboards.{level}_level"], key))


def _overview(level):
    return lambda spark, sf: _out(serve.overview_labels(Ledger.of(spark, sf)[f"dashboards.{level}_level"], level))


def q_serve_year_slice(spark, sf):
    return _out(serve.year_block(Ledger.of(spark, sf)["dashboards.yearly_paychecks"], "paychecks"))


def q_serve_category_block(spark, sf):
    return _out(serve.year_block(Ledger.of(spark, sf)["dashboards.yearly_category_group"], "category_group"))


def q_ordered_serving(spark, sf):
    yb = Ledger.of(spark, sf)["combined.yearly_budgeted"]
    return _out(serve.with_position(yb, "combined.yearly_budgeted",
                                    tiebreak=["category_group_name_mapping", "subcategory_group", "category_name"]))


def q_audit_forall(spark, sf):
    return audit_forall(Ledger.of(spark, sf)["cleaned.paystubs"], m.paystub_audits())


def q_grain_check(spark, sf):
    led = Ledger.of(spark, sf)
    return (grain_check(led["raw.paystubs"], ["file_name", "pay_period_start_date"], "raw.paystubs")
            .unionByName(grain_check(led["raw.transactions"], ["id"], "raw.transactions"))
            .unionByName(grain_check(led["raw.monthly_categories"], ["id"], "raw.monthly_categories")))


def q_dropped_facts(spark, sf):
    led = Ledger.of(spark, sf)
    return m.dropped_facts_report(led["raw.transactions"], led["raw.subtransactions"], led["combined.transactions"])


def q_sanitize_nonfinite(spark, sf):
    e = _t(spark, sf, "events")
    v = (F.when(F.col("event_type") == "error", F.lit(float("nan")))
         .when(F.col("event_type") == "click", F.lit(float("inf")))
         .when(F.col("event_type") == "view", F.lit(float("-inf"))).otherwise(F.col("value")))
    return nonfinite_to_null(e.select("event_id", "event_type", v.alias("value")))


def q_sink_count(spark, sf):
    path = scratch_path(spark, "sink-count")
    rows = write_counted(landing_transactions(spark, sf), path)
    back = spark.read.parquet(path)
    return _out(back.agg(F.lit(rows).alias("written_rows"), to_units(F.sum("amount")).alias("written_amount")))


# ------------------------------------------------------------------ documents and sheets in files

def _document(budget_id: Column, **entities: Column) -> Column:
    budget = F.struct(budget_id.cast("string").alias("id"), *[c.alias(name) for name, c in entities.items()])
    return F.to_json(F.struct(F.struct(budget.alias("budget")).alias("data"))).alias("value")


def _flattened(spark: SparkSession, docs: DataFrame, entity: str) -> DataFrame:
    """Documents written one a line, read back from their files and flattened."""
    path = scratch_path(spark, f"documents-{entity}")
    docs.write.text(path)
    return flatten_entity(read_budget_documents(spark, path, multi_line=False), entity)


def q_flatten_groups(spark, sf):
    g = landing_category_groups(spark, sf)
    one = F.struct(F.col("id").cast("string").alias("id"), "name")
    docs = g.groupBy((F.col("id") % 5).alias("budget")).agg(F.collect_list(one).alias("groups"))
    return _flattened(spark, docs.select(_document(F.col("budget"), category_groups=F.col("groups"))),
                      "category_groups").select("id", "name")


def q_flatten_accounts(spark, sf):
    a = landing_accounts(spark, sf)
    one = F.struct(F.col("id").cast("string").alias("id"), "name", "type", "on_budget", "closed", "balance")
    flat = _flattened(spark, a.select(_document(F.col("id"), accounts=F.array(one))), "accounts")
    return flat.select("id", "name", "type", "on_budget", "closed", "balance")


def q_flatten_subtransactions(spark, sf):
    """Documents of an order's parts; an order of many parts has one for every thousand or so."""
    s = landing_subtransactions(spark, sf)
    one = F.struct("id", F.col("transaction_id").cast("string").alias("transaction_id"), "amount", "memo",
                   F.col("category_id").cast("string").alias("category_id"))
    sizes = s.groupBy("transaction_id").agg(F.ceil(F.count(F.lit(1)) / 1000).alias("documents"))
    deal = F.pmod(F.xxhash64("id", "amount", "memo", "category_id"), F.col("documents"))
    docs = (s.join(sizes, "transaction_id").withColumn("document", deal)
            .groupBy("transaction_id", "document").agg(F.collect_list(one).alias("parts")))
    flat = _flattened(spark, docs.select(_document(F.col("transaction_id"), subtransactions=F.col("parts"))),
                      "subtransactions")
    return flat.select("id", "transaction_id", "amount", "memo", "category_id")


def q_ingest_latest(spark, sf):
    """Two snapshots of every customer's budgets in files (one budget for each thousand order
    numbers, so that none is large); only the newer one counts, though it is written in a
    folder that sorts first and the older one holds rows of other amounts."""
    tx = landing_transactions(spark, sf).withColumn("budget", F.concat_ws("-", "account_id", F.floor(F.col("id") / 1000)))
    path = scratch_path(spark, "snapshots")
    for folder, amount in (("b", F.lit(-1).cast("bigint")), ("a", F.col("amount"))):
        one = F.struct(F.col("id").cast("string").alias("id"), "date", amount.alias("amount"))
        docs = tx.groupBy("budget").agg(F.collect_list(one).alias("rows"))
        docs.select(_document(F.col("budget"), transactions=F.col("rows"))).write.text(os.path.join(path, folder))
    saved = saved_documents(spark, os.path.join(path, "*"), multi_line=False)
    return flatten_entity(current_budgets(saved), "transactions").select("budget_id", "id", "date", "amount")


def q_sheet_csv_roundtrip(spark, sf):
    """The part table as a sheet export of two folders whose files have other headers, with
    quotes, line breaks, moved and added columns."""
    p = _t(spark, sf, "part")
    name = F.concat(F.lit('say "'), F.col("p_name"), F.lit('", '), F.col("p_brand"), F.lit("\n#"),
                    F.col("p_partkey").cast("string"))
    sheet = p.select(
        "p_partkey", name.alias("category_name"), F.col("p_size").cast("string").alias("added"), F.col("p_type").alias("category_group"),
        F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.col("p_brand")).alias("subcategory_group"))
    path = scratch_path(spark, "sheet")
    middle = p.agg(F.avg("p_partkey")).scalar()
    halves = {"a": (F.col("p_partkey") <= middle, ["category_name", "added", "category_group", "subcategory_group"]),
              "b": (F.col("p_partkey") > middle, ["subcategory_group", "category_name", "category_group"])}
    for folder, (part, header) in halves.items():
        sheet.where(part).orderBy("p_partkey").select(*header).write.options(header=True, quote='"', escape='"', quoteAll=True).csv(
            os.path.join(path, folder))
    return read_with_row_ids(spark, os.path.join(path, "*"), "csv", "row_id", ["category_group", "subcategory_group", "category_name"])


# ------------------------------------------------------------------ whole layers

def q_raw_columns(spark, sf):
    """Rows and values of every column of the six raw models, in column order."""
    led, out = Ledger.of(spark, sf), None
    for model, columns in m.RAW_COLUMNS.items():
        df = led[f"raw.{model}"]
        counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(columns)])
        one = counted.select(F.lit(model).alias("model"), "n", F.posexplode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("n_values")) for i, c in enumerate(columns)])))
        one = one.select("model", (F.col("pos") + 1).cast("bigint").alias("place"), "col.column_name",
                         F.col("n").alias("n_rows"), "col.n_values")
        out = one if out is None else out.unionByName(one)
    return out


def q_grain_report(spark, sf):
    led = Ledger.of(spark, sf)
    return grain_report({name: led[name] for name in GRAINS})


def q_pipeline_monthly(spark, sf):
    """Landing tables written, read by name and built through every layer, each model stored."""
    root = scratch_path(spark, "pipeline-landing")
    made = {"accounts": landing_accounts, "category_groups": landing_category_groups,
            "subtransactions": landing_subtransactions, "transactions": landing_transactions,
            "paystubs": landing_paystubs, "monthly_categories": landing_monthly_categories}
    for model, make in made.items():
        write_counted(make(spark, sf), landing.landing_path(root, m.RAW_LANDING[model]))
    # The analog's stubs break some audit rules on purpose (audit_forall counts them).
    tables = build(spark, raw_tables(spark, root, sheet_category_orders(spark, sf)),
                   scratch_path(spark, "pipeline-warehouse"), _as_of(spark, sf), audit=False)
    return _out(tables["dashboards.monthly_level"])


def _served_year(block):
    """One block written for all years, then one year read back with the stored positions."""
    def run(spark, sf):
        root = scratch_path(spark, "year-blocks")
        serve.write_year_blocks(Ledger.of(spark, sf), root, blocks=[block])
        return _out(serve.read_year_block(spark, root, block, REPORT_YEAR))
    return run


def q_serve_where(spark, sf):
    """A report's predicate; stored amounts are thousandths."""
    rows = serve.served(Ledger.of(spark, sf)["combined.yearly_budgeted"], "category_group = 'Needs' AND spend < -100000")
    return rows.select("order_id", "budget_year", "category_name", "spend", "assigned")


def _served_order(model, shown, tiebreak=()):
    return lambda spark, sf: _out(serve.with_position(
        Ledger.of(spark, sf)[model].select(*{*shown, *tiebreak, *[c for c, _ in serve.MODEL_ORDER[model]]}), model,
        tiebreak=tiebreak).select(*shown, "position"))


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Output types that compare the same however the oracle comparison is made.

    The comparison may go through Arrow, pandas or Python values. Through pandas a
    DATE becomes ``datetime.date`` from Spark but a timestamp from DuckDB, and an
    integer column holding NULLs becomes float from Spark but nullable-int from DuckDB.
    So dates leave as ISO ``yyyy-MM-dd`` text and integers as DOUBLE (exact at these
    magnitudes) on both sides. The models themselves keep DATE and BIGINT.
    """
    fixes = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            fixes[f.name] = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.IntegralType):
            fixes[f.name] = c.cast("double")
    return df.withColumns(fixes) if fixes else df


def _harness(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _dates_as_text(fn(spark, sf))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_project": q_scan_project,
    "unit_scale": q_unit_scale,
    "json_flatten": q_json_flatten,
    "json_two_level": q_json_two_level,
    "row_ids": q_row_ids,
    "typed_from_text": q_typed_from_text,
    "clean_label": q_clean_label,
    "strip_emoji": q_strip_emoji,
    "group_mapping": q_group_mapping,
    "month_key": q_month_key,
    "conditional_columns": q_conditional_columns,
    "split_expand": q_split_expand,
    "enrich_chain": q_enrich_chain,
    "enriched_transactions": q_enriched_transactions,
    "latest_per_key": q_latest_per_key,
    "categories_latest": q_categories_latest,
    "conditional_sums": q_conditional_sums,
    "date_range": q_date_range,
    "record_spine": q_record_spine,
    "dense_rollup": q_dense_rollup,
    "pay_measures": q_pay_measures,
    "pay_monthly": q_pay_monthly,
    "monthly_level": q_monthly_level,
    "yearly_level": q_yearly_level,
    "yearly_budgeted": q_yearly_budgeted,
    "yearly_group": q_yearly_group,
    "yearly_subgroup": q_yearly_subgroup,
    "group_slice_needs": _slice("needs"),
    "group_slice_wants": _slice("wants"),
    "group_slice_other": _slice("other"),
    "unpivot_ordered": q_unpivot_ordered,
    "chart_monthly_overview": _chart("monthly", "overview"),
    "chart_monthly_income": _chart("monthly", "monthly_income"),
    "chart_monthly_paycheck": _chart("monthly", "paycheck_breakdown"),
    "chart_monthly_spending": _chart("monthly", "spending_breakdown"),
    "chart_yearly_overview": _chart("yearly", "overview"),
    "chart_yearly_income": _chart("yearly", "yearly_income"),
    "chart_yearly_paycheck": _chart("yearly", "paycheck_breakdown"),
    "chart_yearly_spending": _chart("yearly", "spending_breakdown"),
    "dash_extract_monthly": _extract("monthly"),
    "dash_extract_yearly": _extract("yearly"),
    "overview_labels_monthly": _overview("monthly"),
    "overview_labels_yearly": _overview("yearly"),
    "serve_year_slice": q_serve_year_slice,
    "serve_category_block": q_serve_category_block,
    "ordered_serving": q_ordered_serving,
    "audit_forall": q_audit_forall,
    "grain_check": q_grain_check,
    "dropped_facts": q_dropped_facts,
    "sanitize_nonfinite": q_sanitize_nonfinite,
    "sink_count": q_sink_count,
    "raw_columns": q_raw_columns,
    "grain_report": q_grain_report,
    "pipeline_monthly": q_pipeline_monthly,
    "flatten_groups": q_flatten_groups,
    "flatten_accounts": q_flatten_accounts,
    "flatten_subtransactions": q_flatten_subtransactions,
    "ingest_latest": q_ingest_latest,
    "sheet_csv_roundtrip": q_sheet_csv_roundtrip,
    "serve_where": q_serve_where,
    **{f"serve_year_{block}": _served_year(block) for block in serve.YEAR_BLOCKS},
    "ordered_transactions": _served_order("cleaned.transactions", ["id", "transaction_date"], ["id"]),
    "ordered_category_orders": _served_order("cleaned.category_orders", ["order_id", "category_name"]),
    "ordered_budgeted": _served_order("combined.budgeted", ["budget_month", "category_id"]),
    "ordered_paystubs": _served_order("combined.paystubs", ["pay_date", "net_pay"], ["net_pay"]),
    "ordered_combined_transactions": _served_order("combined.transactions", ["id", "transaction_date", "amount"],
                                                   ["id", "amount"]),
    "ordered_monthly_level": _served_order("dashboards.monthly_level", ["budget_month", "spent"]),
    "ordered_yearly_level": _served_order("dashboards.yearly_level", ["budget_year", "spent"]),
    "ordered_yearly_paychecks": _served_order("dashboards.yearly_paychecks", ["budget_year", "order_id", "paycheck_column"],
                                              ["paycheck_column"]),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _harness(f) for k, f in _QUERIES.items()}
