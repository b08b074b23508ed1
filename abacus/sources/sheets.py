"""Spreadsheet exports: all-text CSV, and row ids in sheet order.

A sheet's cells may hold line breaks, so a line's start is a row's start only outside quotes.
Files are cut by bytes into splits like any text; each split counts its quote characters, a
running parity over the splits (one row a split) tells whether a split begins inside
a quoted cell, and every split then finds its own rows. Rows that run over several lines
or splits are put together from their lines. Each file's own header maps its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# One cell of a row that has a comma put in front: quoted, with quotes doubled inside, or plain.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _without_return(c: str | Column) -> Column:
    return F.regexp_replace(c, r"\r\z", "")


def _cells(row: str | Column) -> Column:
    """The cells of one CSV row as an array; quotes taken off, empty cells ``''``."""
    found = F.regexp_extract_all(F.concat(F.lit(","), _without_return(row)), F.lit(_CELL), F.lit(1))
    quoted = lambda c: F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), quoted(c)).otherwise(c))


def _lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The files' lines with the row each belongs to, and one row per split.

    Lines: ``file``, ``block``, ``pos``, ``value``, ``row`` (numbered in the file from 0, the header) and ``whole``, true
    where the line is a row by itself. Blank lines outside quotes are left out. The lines are
    shuffled once, to the split they come from. A file whose quotes do not pair up raises.
    """
    split = ["file", "block"]
    inside_split = Window.partitionBy(*split).orderBy("pos")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"), "value")
             .withColumns({"odd": F.pmod(quotes, F.lit(2)), "blank": _without_return("value") == ""})
             .withColumn("rel", F.pmod(F.sum("odd").over(inside_split) - F.col("odd"), F.lit(2))))
    # Row starts so far if the split begins outside quotes, and if it begins inside.
    starts = {f"starts_{p}": F.sum(F.when((F.col("rel") == p) & ~F.col("blank"), 1).otherwise(0)).over(inside_split) for p in (0, 1)}
    lines = lines.withColumns(starts)

    splits = lines.groupBy(*split).agg(F.sum("odd").alias("odds"), F.max("starts_0").alias("n_0"), F.max("starts_1").alias("n_1"))
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("file")
    splits = (splits.withColumn("begins", F.pmod(F.coalesce(F.sum("odds").over(before), F.lit(0)), F.lit(2)))
              .withColumn("n", F.when(F.col("begins") == 0, F.col("n_0")).otherwise(F.col("n_1")))
              .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("file_rows", F.sum("n").over(whole_file))
              .withColumn("first", F.when(F.pmod(F.sum("odds").over(whole_file), F.lit(2)) == 0, F.col("first")).otherwise(
                  F.raise_error(F.concat(F.lit("a quoted cell does not end in sheet "), F.col("file"))).cast("bigint")))
              .select(*split, "begins", "first", "file_rows"))

    outside = F.pmod(F.col("rel") + F.col("begins"), F.lit(2)) == 0
    count = F.when(F.col("begins") == 0, F.col("starts_0")).otherwise(F.col("starts_1"))
    numbered = (lines.join(splits.select(*split, "begins", "first"), split)
                .where(~(outside & F.col("blank")))
                .select(*split, "pos", "value", (F.col("first") + count - 1).alias("row"), (outside & (F.col("odd") == 0)).alias("whole")))
    return numbered, splits


def _rows(lines: DataFrame, *keep: str) -> DataFrame:
    """(file, row, text, *keep): the text of each row, several lines joined again."""
    alone = lines.where("whole").select("file", "row", F.col("value").alias("text"), *keep)
    joined = (lines.where("not whole").groupBy("file", "row")
              .agg(F.sort_array(F.collect_list(F.struct("block", "pos", "value"))).alias("ls"), *[F.first(k).alias(k) for k in keep])
              .select("file", "row", F.array_join(F.transform("ls", lambda x: x["value"]), "\n").alias("text"), *keep))
    return alone.unionByName(joined)


def _header(lines: DataFrame) -> DataFrame:
    """(file, names): the column titles of each file."""
    return _rows(lines.where("row = 0")).select("file", _cells(F.regexp_replace("text", "^﻿", "")).alias("names"))


def _sheet(spark: SparkSession, path: str, columns: Sequence[str] | None, id_col: str | None) -> DataFrame:
    lines, splits = _lines(spark, path)
    header = _header(lines)
    if columns is None:
        first = header.orderBy("file").limit(1).collect()
        columns = list(first[0]["names"]) if first else []

    def place(name: str) -> Column:
        """The 0-based place of a column in its file; raises where it is missing or not the only one."""
        wrong = F.raise_error(F.concat(F.lit("sheet "), F.col("file"), F.lit(f" must have one column {name!r}"))).cast("int")
        times = F.size(F.filter("names", lambda n: n == F.lit(name)))
        return F.when(times == 1, (F.array_position("names", name) - 1).cast("int")).otherwise(wrong)

    maps = header.select("file", F.array(*[place(c) for c in columns]).alias("places"))
    # The map goes to every split of its file, so that lines stay with their split.
    per_file = splits.select("file", (F.col("file_rows") - 1).alias("n")).distinct()
    ahead = per_file.withColumn("ahead", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    known = splits.select("file", "block").join(maps, "file").join(ahead.select("file", "ahead"), "file")
    rows = _rows(lines.where("row > 0").join(known, ["file", "block"]), "places", "ahead")
    cells = rows.select((F.col("ahead") + F.col("row")).cast("bigint").alias("at"), _cells("text").alias("cells"), "places")
    out = [F.coalesce(F.get("cells", F.get("places", F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(columns)]
    return cells.select(*([F.col("at").alias(id_col)] if id_col else []), *out)


def read_sheet_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header row + rows, every cell a string, empty cells ``''`` (never NULL).

    ``path`` may hold several files, each with its own header: the wanted ``columns`` are found
    by name in every file, in any order and beside any others, and a file without one of them
    (or with two) raises and is named. Without ``columns`` they are those of the first file.
    Cells are quoted as spreadsheets do it: quotes only around a whole cell, doubled inside. A
    row shorter than its header ends in empty cells.
    """
    return _sheet(spark, path, columns, None)


def with_row_ids(scan: DataFrame, id_col: str = "id") -> DataFrame:
    """Number the rows of a file scan 1..N in file order, without one-task steps.

    ``scan`` must come straight from ``spark.read`` (it uses the hidden ``_metadata``
    column). A chunk is one input split, identified by (file, byte offset); inside a
    task, rows of a split are read in order and ``monotonically_increasing_id`` is
    contiguous. Each chunk's first row number is the running sum of the sizes of the
    chunks before it: a table with one row per input split, joined without a hint. Input splits are not handed to tasks in file order, which is why the
    byte offset, not the task number, orders the chunks. A retried or recomputed task
    re-reads the same split in the same order, so the ids do not change after an
    executor loss.
    """
    cols = scan.columns
    base = scan.select(
        *cols,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__pos"),
    )
    chunks = base.groupBy("__file", "__block").agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    numbered = base.join(offsets, ["__file", "__block"])
    row_id = (F.col("__offset") + F.col("__pos") - F.col("__first") + F.lit(1)).cast("bigint")
    return numbered.select(row_id.alias(id_col), *cols)


def read_with_row_ids(spark: SparkSession, path: str, fmt: str = "csv", id_col: str = "id",
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Read a sheet export (CSV text) or a Parquet file and add 1..N row ids in file order."""
    if fmt == "csv":
        return _sheet(spark, path, columns, id_col)
    scan = spark.read.format(fmt).load(path)
    if columns is not None:
        scan = scan.select(*columns)
    return with_row_ids(scan, id_col)
