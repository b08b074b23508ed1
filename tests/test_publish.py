"""A build is published whole: one that fails half-way leaves readers on the version before."""

import datetime as dt

import pytest

from abacus.operators import AuditFailure
from abacus.plans import build as building
from abacus.plans import publish
from abacus.plans.ingest import run
from tests import golden


@pytest.fixture
def inputs(spark, tmp_path):
    doc, stubs, orders = golden.write_inputs(str(tmp_path / "in"))
    root = str(tmp_path / "wh")
    return root, lambda as_of=golden.AS_OF: run(spark, doc, stubs, orders, str(tmp_path / "landing"), root, as_of=as_of)


def months(spark, root):
    return publish.read_published(spark, root, "combined.record_spine").count()


def test_failed_build_changes_nothing_for_readers(spark, inputs, monkeypatch):
    root, build = inputs
    assert publish.published(spark, root) is None
    with pytest.raises(LookupError, match="nothing is published"):
        months(spark, root)
    build()
    first = publish.published(spark, root)
    assert months(spark, root) == 10 and first["number"] == 1
    assert first["models"]["dashboards.monthly_level"] == 2 and len(first["models"]) == len(building.model_steps(None))

    steps = building.model_steps

    def dies_late(as_of, split):
        def fail(tables):
            raise RuntimeError("killed")
        return [(name, fail if name == "combined.yearly_budgeted" else make) for name, make in steps(as_of, split)]

    monkeypatch.setattr(building, "model_steps", dies_late)
    with pytest.raises(RuntimeError, match="killed"):
        build(dt.date(2024, 5, 1))
    assert publish.published(spark, root) == first and months(spark, root) == 10

    monkeypatch.setattr(building, "model_steps", steps)
    held = publish.read_published(spark, root, "combined.record_spine")
    build(dt.date(2024, 5, 1))
    assert publish.published(spark, root)["number"] == 2 and months(spark, root) == 25
    assert held.count() == 10  # a reader that opened the older version goes on
    assert publish.superseded(spark, root) == [publish.version_path(root, first["version"])]
    assert publish.read_published(spark, root, "combined.record_spine", first["version"]).count() == 10


def test_audit_failure_is_not_published(spark, inputs, monkeypatch):
    root, build = inputs
    from pyspark.sql import functions as F
    from abacus.plans import models as m
    monkeypatch.setattr(m, "paystub_audits", lambda: [("never", F.lit(False))])
    with pytest.raises(AuditFailure, match="never: 1 rows"):
        build()
    assert publish.published(spark, root) is None


def test_unstored_model_is_named(spark, tmp_path):
    publish.publish(spark, str(tmp_path), publish.new_version(), {"cleaned.accounts": 1})
    with pytest.raises(LookupError, match="holds no stored dashboards.monthly_level"):
        publish.read_published(spark, str(tmp_path), "dashboards.monthly_level")
