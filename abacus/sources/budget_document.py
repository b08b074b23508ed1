"""Budget documents (nested JSON) -> one flat landing table per entity.

A saved document is one JSON object ``{"data": {"budget": {...}}}``. One pretty-printed
document per file is read with ``multiLine`` (one task per file); bulk history should
be stored one document per line so that files split across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacus import schemas
from abacus.functions.dates import iso_date
from abacus.operators.latest import latest_per_key
from abacus.session import scratch_path

# Landing name of each flat entity.
ENTITY_LANDING = {
    "category_groups": "category-groups",
    "transactions": "transactions",
    "subtransactions": "subtransactions",
    "accounts": "accounts",
}
MONTHLY_CATEGORIES_LANDING = "monthly-categories"


def read_budget_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Saved documents -> one row per document with a ``budget`` struct column."""
    docs = (spark.read.schema(schemas.DOCUMENT).option("multiLine", multi_line)
            .option("mode", "FAILFAST").json(path))
    return docs.select(F.col("data.budget").alias("budget"))


def saved_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Saved documents as text, with the budget's id and where and when each was saved.

    ``place`` is the document's place among those of one file (one per line, oldest first). The
    same DataFrame gives the same places however often it is scanned, as its list of files
    and their cutting into splits are fixed.
    """
    lines = spark.read.text(path, wholetext=multi_line)
    if not multi_line:
        lines = lines.where(F.trim("value") != "")
    # One document a file needs no row, and a choice by file then prunes the files that are read.
    row = F.lit(0) if multi_line else F.monotonically_increasing_id()
    return lines.select(
        F.get_json_object("value", "$.data.budget.id").alias("budget_id"),
        F.col("_metadata.file_modification_time").alias("saved_at"), F.col("_metadata.file_path").alias("source"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), row.cast("bigint").alias("row")).alias("place"),
        F.col("value").alias("document"))


def current_budget(saved: DataFrame, budget_id: str | None = None) -> DataFrame:
    """The newest document of one budget, by file time and then path; older snapshots are left out.

    ``budget_id`` names the budget; without it the documents must all be of one. One aggregate
    over ids, times and places finds the document; only that document is then parsed, once, and
    nothing but its columns of place is ever aggregated. Expects ``saved_documents``.
    """
    if budget_id is not None:
        saved = saved.where(F.col("budget_id") == budget_id)
    found = saved.agg(F.min("budget_id").alias("low"), F.max("budget_id").alias("high"), F.count("budget_id").alias("named"),
                      F.count(F.lit(1)).alias("n"), F.max(F.struct("saved_at", "source", "place")).alias("newest")).first()
    if found["n"] and (found["low"] != found["high"] or found["named"] not in (0, found["n"])):
        raise ValueError("the documents are of several budgets: name one with budget_id")
    source, place = (found["newest"]["source"], found["newest"]["place"]) if found["n"] else ("", (0, 0))
    chosen = saved.where((F.col("source") == source) & (F.col("place.block") == place[0]) & (F.col("place.row") == place[1]))
    return _parsed(chosen, []).select("budget")


# Documents chosen at once up to this many are broadcast (some 200 bytes each).
BROADCAST_CHOICES = 100_000


def current_budgets(saved: DataFrame, broadcast_choices: int = BROADCAST_CHOICES) -> DataFrame:
    """The newest document of every budget, with its ``budget_id`` next to it (documents without
    an id count as one budget). Flattened rows carry the id, as one budget's ids may recur in another.

    The choice is made on ids, times and places: a partial aggregate whose result, one row a
    budget, is written. Up to ``broadcast_choices`` of them are broadcast to a second scan, which parses the
    chosen documents where they are read; beyond that the documents are joined by a shuffle. Expects ``saved_documents``.
    """
    spark = saved.sparkSession
    path = scratch_path(spark, "newest-documents")
    latest_per_key(saved.select("budget_id", "saved_at", "source", "place"), ["budget_id"], ["saved_at", "source", "place"]).select(
        "source", "place").write.parquet(path)
    chosen = spark.read.parquet(path)
    if chosen.count() <= broadcast_choices:
        chosen = F.broadcast(chosen)
    return _parsed(saved.join(chosen, ["source", "place"], "left_semi"), ["budget_id"])


def _parsed(saved: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Saved documents parsed by the declared schema; one that is no such document raises."""
    parsed = F.from_json("document", schemas.DOCUMENT, {"mode": "FAILFAST"})
    return saved.select(*keep, parsed.getField("data").getField("budget").alias("budget"))


def parse_budget_documents(df: DataFrame, text_col: str) -> DataFrame:
    """Documents held as JSON text in a column -> the same ``budget`` struct column."""
    doc = F.from_json(F.col(text_col), schemas.DOCUMENT)
    return df.select(doc.getField("data").getField("budget").alias("budget"))


def _keys(budgets: DataFrame) -> list[str]:
    """Columns carried next to the flattened rows (e.g. ``budget_id`` of a multi-budget batch)."""
    return [c for c in budgets.columns if c != "budget"]


def flatten_entity(budgets: DataFrame, entity: str) -> DataFrame:
    """``budget.<entity>`` array of objects -> one row per object (NULL/empty arrays give none)."""
    return budgets.select(*_keys(budgets), F.inline(F.col("budget").getField(entity)))


def flatten_monthly_categories(budgets: DataFrame) -> DataFrame:
    """Two-level flatten ``months[].categories[]`` with the month's ``year`` and ``month``.

    ``explode`` drops months whose category list is empty or NULL, as the reference
    skips empty months.
    """
    keys = _keys(budgets)
    months = budgets.select(*keys, F.explode(F.col("budget").getField("months")).alias("m"))
    cats = months.select(
        *keys,
        F.col("m").getField("month").alias("__month"),
        F.explode(F.col("m").getField("categories")).alias("c"),
    )
    day = iso_date(F.col("__month"))
    return cats.select(*keys, "c.*", F.month(day).alias("month"), F.year(day).alias("year"))


def stored(budgets: DataFrame) -> DataFrame:
    """Parsed documents written once to the shared scratch folder and read back.

    The five landing tables then come from one parse: each reads its own array from the
    stored columns and nothing else.
    """
    path = scratch_path(budgets.sparkSession, "budgets")
    budgets.write.parquet(path)
    return budgets.sparkSession.read.schema(budgets.schema).parquet(path)


def landing_frames(budgets: DataFrame) -> dict[str, DataFrame]:
    """Every landing table of a set of budget documents, by landing name."""
    frames = {name: flatten_entity(budgets, entity) for entity, name in ENTITY_LANDING.items()}
    frames[MONTHLY_CATEGORIES_LANDING] = flatten_monthly_categories(budgets)
    return frames
