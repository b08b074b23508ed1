"""A warehouse that is published whole: readers see one finished build, never parts of two.

Every build writes its models under a version folder of its own, ``{root}/versions/{version}``.
When all of them are written and audited, one line is added to the manifest
``{root}/published``: the version, its number and the rows of each model. The line is a file of its own that
appears when its write commits, and readers follow the line with the highest number, so a build that
fails or is killed changes nothing for them. Earlier versions stay until they are removed;
``superseded`` names them.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "number long, version string, published_at string, models map<string, long>"


def new_version() -> str:
    """A new version name; later builds sort later."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, version: str, model: str | None = None) -> str:
    """The folder of a version, or of one ``layer.model`` in it."""
    return os.path.join(root, "versions", version, *(model.split(".") if model else []))


def _entries(spark: SparkSession, root: str) -> DataFrame:
    try:
        lines = spark.read.text(os.path.join(root, "published"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.select(F.from_json("value", ENTRY, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def published(spark: SparkSession, root: str) -> dict | None:
    """The manifest's newest entry (number, version, published_at, models), or None before the first build."""
    newest = _entries(spark, root).orderBy(F.desc("number"), F.desc("version")).limit(1).collect()
    return newest[0].asDict() if newest else None


def publish(spark: SparkSession, root: str, version: str, models: Mapping[str, int]) -> None:
    """Make ``version`` the one that readers see. Of two builds published at once the later one counts."""
    before = published(spark, root)
    entry = {"number": (before["number"] if before else 0) + 1, "version": version,
             "published_at": dt.datetime.now(dt.timezone.utc).isoformat(), "models": dict(models)}
    line = spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1)
    line.write.mode("append").text(os.path.join(root, "published"))


def read_published(spark: SparkSession, root: str, model: str, version: str | None = None) -> DataFrame:
    """A model of the published version (or of a given one, to read several models of one build)."""
    if version is None:
        entry = published(spark, root)
        if entry is None:
            raise LookupError(f"nothing is published in {root}")
        if model not in entry["models"]:
            raise LookupError(f"version {entry['version']} holds no stored {model}")
        version = entry["version"]
    return spark.read.parquet(version_path(root, version, model))


def superseded(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Folders of published versions older than the newest ``keep``: no new reader opens them."""
    order = [F.desc("number"), F.desc("version")]
    return [version_path(root, r["version"]) for r in _entries(spark, root).orderBy(*order).select("version").collect()[keep:]]
