"""The newest document is found without moving documents, and each is parsed once."""

import json
import os

import pytest

from abacus.sources import current_budget, current_budgets, flatten_entity, landing_frames, saved_documents, stored


def document(budget_id, amount, n=2):
    budget = {"id": budget_id, "transactions": [{"id": f"{budget_id}-{i}", "amount": amount} for i in range(n)]}
    return json.dumps({"data": {"budget": budget}})


def save(path, day, *documents):
    path.write_text("\n".join(documents) + "\n")
    os.utime(path, (day * 86400, day * 86400))


def amounts(budgets):
    return sorted(tuple(r) for r in flatten_entity(budgets, "transactions").groupBy("budget_id").max("amount").collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def history(tmp_path):
    save(tmp_path / "b.jsonl", 3, document("X", 1), document("Y", 2), "  ", document("X", 3))
    save(tmp_path / "a.jsonl", 5, document("Y", 4), document("Z", 5), document("Y", 6))
    save(tmp_path / "c.jsonl", 4, document("Z", 7))
    return str(tmp_path)


@pytest.mark.parametrize("broadcast", [0, 100])
@pytest.mark.parametrize("split", ["128m", "90"])
def test_newest_of_every_budget(spark, history, broadcast, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        saved = saved_documents(spark, history, multi_line=False)
        assert amounts(current_budgets(saved, broadcast)) == [("X", 3), ("Y", 6), ("Z", 5)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_are_not_moved(spark, history):
    """No exchange and no aggregate buffer holds a document: only ids, times and places are."""
    newest = plan(current_budgets(saved_documents(spark, history, multi_line=False)))
    assert "BroadcastHashJoin" in newest and "Aggregate" not in newest
    assert all("BroadcastExchange" in line for line in newest.split("\n") if "Exchange" in line)
    one = plan(current_budget(saved_documents(spark, history, multi_line=False), "X"))
    assert "Exchange" not in one and "Aggregate" not in one


def test_one_document_a_file_reads_only_that_file(spark, tmp_path):
    for day in (1, 2, 3):
        save(tmp_path / f"{day}.json", day, json.dumps(json.loads(document("X", day)), indent=1))
    budgets = current_budget(saved_documents(spark, str(tmp_path)))
    assert [r["amount"] for r in flatten_entity(budgets, "transactions").collect()] == [3, 3]
    execution = budgets._jdf.queryExecution()
    execution.toRdd().count()
    assert execution.executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == 1


def test_five_outputs_read_their_part_of_one_stored_parse(spark, history):
    frames = landing_frames(stored(current_budget(saved_documents(spark, history, multi_line=False), "Y")))
    for name, df in frames.items():
        text = plan(df)
        assert text.count("FileScan") == 1 and "FileScan parquet" in text and "from_json" not in text, name
    assert "transactions" in plan(frames["transactions"]).split("ReadSchema")[1]
    assert "accounts" not in plan(frames["transactions"]).split("ReadSchema")[1]
    assert frames["transactions"].count() == 2


def test_no_documents_and_documents_without_ids(spark, tmp_path):
    save(tmp_path / "x.jsonl", 1, "", "  ")
    saved = saved_documents(spark, str(tmp_path), multi_line=False)
    assert current_budget(saved).count() == 0 and current_budgets(saved).count() == 0
    nameless = json.dumps({"data": {"budget": {"transactions": [{"id": "t", "amount": 9}]}}})
    save(tmp_path / "y.jsonl", 2, nameless, nameless)
    saved = saved_documents(spark, str(tmp_path), multi_line=False)
    assert flatten_entity(current_budget(saved), "transactions").count() == 1
    assert amounts(current_budgets(saved)) == [(None, 9)]
    save(tmp_path / "z.jsonl", 3, document("X", 1))
    with pytest.raises(ValueError, match="several budgets"):
        current_budget(saved_documents(spark, str(tmp_path), multi_line=False))


def test_broken_document_raises(spark, tmp_path):
    save(tmp_path / "x.jsonl", 1, '{"data": {"budget": {"id": "X", "transactions": "none"}}}')
    with pytest.raises(Exception):
        current_budget(saved_documents(spark, str(tmp_path), multi_line=False), "X").collect()
