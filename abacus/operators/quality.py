"""Data quality: row audits, grain reports, and the counted Parquet sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class AuditFailure(AssertionError):
    """Raised when an audit finds rows that break its rule."""


def audit_forall(df: DataFrame, audits: Sequence[tuple[str, Column]]) -> DataFrame:
    """Count the rows breaking each ``(name, rule)``; one output row per audit.

    All rules are evaluated in one pass over ``df`` (one aggregate, partial on
    every task). A row whose rule is NULL does not fail it, as with ``forall``.
    """
    counts = df.agg(*[
        F.sum(F.when(~rule, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"__a{i}")
        for i, (_, rule) in enumerate(audits)
    ])
    arms = F.array(*[
        F.struct(F.lit(name).alias("audit"), F.coalesce(F.col(f"__a{i}"), F.lit(0).cast("bigint")).alias("violations"))
        for i, (name, _) in enumerate(audits)
    ])
    return counts.select(F.inline(arms))


def assert_audits(result: DataFrame) -> None:
    """Raise ``AuditFailure`` naming every audit with violations (collects one row per audit)."""
    raise_on({r["audit"]: r["violations"] for r in result.where("violations > 0").collect()})


def grain_check(df: DataFrame, grain: Sequence[str], model: str) -> DataFrame:
    """Report how many grain keys repeat, and how many rows they cover (one row).

    Report-only: several declared grains of the reference are not unique by design.
    """
    dupes = df.groupBy(*grain).count().where("count > 1")
    return dupes.agg(
        F.lit(model).alias("model"),
        F.count(F.lit(1)).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


class CountMismatch(AssertionError):
    """Raised when the files of a table hold another number of rows than were written."""


def _breaks(rule: Column) -> Column:
    return F.coalesce(F.sum(F.when(~rule, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def write_observed(df: DataFrame, write: Callable[[DataFrame], None],
                   audits: Sequence[tuple[str, Column]] = ()) -> tuple[int, dict[str, int]]:
    """Run ``write`` on ``df``; the rows it wrote and the rows breaking each audit's rule.

    Both are counted while the rows are written (an observation on the rows that reach the
    writer), so there is no second scan. A row whose rule is NULL does not break it.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[_breaks(rule).alias(f"a{i}") for i, (_, rule) in enumerate(audits)]))
    counts = seen.get
    return counts["rows"], {name: counts[f"a{i}"] for i, (name, _) in enumerate(audits)}


def raise_on(violations: Mapping[str, int]) -> None:
    """Raise ``AuditFailure`` naming every audit with violations."""
    if any(violations.values()):
        raise AuditFailure("; ".join(f"{name}: {n} rows" for name, n in violations.items() if n))


def write_counted(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> int:
    """Write Parquet and return the number of rows written, counted by the write itself.

    A table written whole is then counted from its files' footers, which must agree.
    """
    writer = lambda d: d.write.mode(mode).partitionBy(*partition_by).parquet(path)
    rows, _ = write_observed(df, writer)
    if mode == "overwrite":
        stored = df.sparkSession.read.schema(df.schema).parquet(path).count()
        if stored != rows:
            raise CountMismatch(f"{path}: {rows} rows were written, its files hold {stored}")
    return rows
