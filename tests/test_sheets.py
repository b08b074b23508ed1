"""Sheet files: each file's own header, quoted line breaks over split ends, row ids."""

import csv
import random

import pytest

from abacus.sources import read_sheet_csv, read_with_row_ids

COLUMNS = ["x", "y", "z"]


def cell(rng):
    return "".join(rng.choice(["a", "b", ",", '"', "\n", "é", " ", 'x"y', "\r\n", "", "z"]) for _ in range(rng.randint(0, 6)))


def put(path, header, rows, quoting=csv.QUOTE_MINIMAL, end="\r\n", mark=""):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(mark)
        out = csv.writer(f, quoting=quoting, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    for k in keys:
        keys[k] = spark.conf.get(k)
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(keys, (size, "0"))]
    for k, v in keys.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", ["128m", "500", "31"])
def test_files_with_other_headers_and_line_breaks_in_cells(spark, tmp_path, small_splits, split):
    rng = random.Random(3)
    rows = [[cell(rng) or "q", cell(rng), cell(rng)] for _ in range(150)]
    put(tmp_path / "a.csv", COLUMNS, rows[:90])
    put(tmp_path / "b.csv", ["z", 'ex,"tra\nn', "x", "y"], [[r[2], "E", r[0], r[1]] for r in rows[90:]], csv.QUOTE_ALL, "\n")
    put(tmp_path / "c.csv", ["y", "z", "x"], [], mark="﻿")
    (tmp_path / "d.csv").write_text("")
    small_splits(split)
    got = sorted(map(tuple, read_with_row_ids(spark, str(tmp_path), "csv", "id", COLUMNS).collect()))
    assert got == [(i + 1, *r) for i, r in enumerate(rows)]


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    """A cell of many lines runs over many splits; the row ids are those of a one-task read."""
    long = "\n".join(f'line {i} "quoted", and more' for i in range(400))
    rows = [["1", "plain", ""], ["2", long, "x"], ["3", "", long], ["4", "a\nb", "end"]] * 5
    put(tmp_path / "sheet.csv", COLUMNS, rows)
    whole = sorted(map(tuple, read_with_row_ids(spark, str(tmp_path), "csv", "id", COLUMNS).collect()))
    small_splits("4000")
    text = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 8
    assert sorted(map(tuple, read_with_row_ids(spark, str(tmp_path), "csv", "id", COLUMNS).collect())) == whole
    assert whole == [(i + 1, *r) for i, r in enumerate(rows)]


def test_text_is_shuffled_once(spark, tmp_path):
    """Lines go to their split and stay there; other exchanges carry counts and column places."""
    put(tmp_path / "a.csv", COLUMNS, [["1", "2", "3"]])
    plan = read_sheet_csv(spark, str(tmp_path), COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_missing_or_repeated_column_names_the_file(spark, tmp_path):
    put(tmp_path / "good.csv", COLUMNS, [["1", "2", "3"]])
    put(tmp_path / "short.csv", ["x", "y"], [["1", "2"]])
    with pytest.raises(Exception, match="short.csv must have one column 'z'"):
        read_sheet_csv(spark, str(tmp_path), COLUMNS).collect()
    assert read_sheet_csv(spark, str(tmp_path), ["y", "x"]).count() == 2
    put(tmp_path / "twice.csv", ["x", "y", "z", "z"], [["1", "2", "3", "4"]])
    with pytest.raises(Exception, match="must have one column 'z'"):
        read_sheet_csv(spark, str(tmp_path / "twice.csv"), COLUMNS).collect()


def test_quotes_that_do_not_pair_up_raise(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('x,y,z\n1,"open,3\n4,5,6\n')
    with pytest.raises(Exception, match="does not end in sheet"):
        read_sheet_csv(spark, str(tmp_path), COLUMNS).collect()


def test_short_rows_blank_lines_and_no_column_list(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n\n1\r\n\r\n4,"5"\n"","",""\n7,8,9,10\n')
    df = read_sheet_csv(spark, str(tmp_path))
    assert df.columns == COLUMNS
    assert sorted(map(tuple, df.collect())) == [("", "", ""), ("1", "", ""), ("4", "5", ""), ("7", "8", "9")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    assert read_with_row_ids(spark, str(tmp_path / "empty"), "csv", "id", COLUMNS).count() == 0
