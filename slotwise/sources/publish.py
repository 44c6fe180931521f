"""Write, check, publish: a new version of a table is readable only if its suite has no critical failure.

A version is written completely, checked as it was stored, and its report written; then a pointer may move. Readers follow
pointers, so a bad batch leaves its report and its staged rows, and the earlier version stays what readers get.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators import quality
from slotwise.sources.store import write_table

REPORT = (
    "suite string, expectation string, column string, severity string, success boolean, observed string, details string,"
    " n_rows bigint, published boolean, generated_at timestamp"
)


class CheckedTable:
    """One table below ``root``: ``staged``, ``reports`` and ``pointers``, a folder per version."""

    def __init__(
        self, spark: SparkSession, root: str, suite: str, checks: Sequence | None = None,
        time: str | None = "timestamp", entity: str | None = "household_id",
    ):
        self.spark, self.root, self.suite, self.checks = spark, root.rstrip("/"), suite, checks
        self.time, self.entity = time, entity

    def _last(self, name: str) -> int:
        """The highest version with a report or pointer, 0 if there is none."""
        try:
            seen = self.spark.read.schema("version int").parquet(f"{self.root}/{name}")
            return seen.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def publish(self, df: DataFrame) -> DataFrame:
        """Store ``df`` as the next version and return its report; readers see it only if no critical expectation failed.

        An attempt that died before its report is overwritten by the next one.
        """
        version = self._last("reports") + 1
        path = f"{self.root}/staged/v{version}"
        write_table(df, path, self.time, self.entity)
        stored = self.spark.read.parquet(path)
        results = quality.run_suite(stored, self.suite, self.checks)
        report = results.withColumns({
            "n_rows": stored.agg(F.count(F.lit(1))).scalar(), "published": ~quality.has_critical_failure(results),
            "generated_at": F.current_timestamp(),
        })
        report.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/reports/version={version}")
        report = self.report(version)
        if report.first()["published"]:
            self.spark.range(1).select("id").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointers/version={version}")
        return report

    def report(self, version: int | None = None) -> DataFrame:
        """The rows of one report, of the latest version if none is named."""
        return self.spark.read.schema(REPORT).parquet(f"{self.root}/reports/version={version or self._last('reports')}")

    def reports(self) -> DataFrame:
        """Per version: rows, expectations, failures by severity, and whether it was published."""
        rows = self.spark.read.schema(f"{REPORT}, version int").parquet(f"{self.root}/reports")
        failed = ~F.col("success")
        return rows.groupBy("version", "suite", "n_rows", "published").agg(
            F.count(F.lit(1)).alias("n_expectations"),
            F.count_if(failed & (F.col("severity") == "CRITICAL")).alias("n_critical_failures"),
            F.count_if(failed & (F.col("severity") == "WARN")).alias("n_warn_failures"),
        )

    def read(self) -> DataFrame:
        """The published version, an error if there is none."""
        version = self._last("pointers")
        if not version:
            raise LookupError(f"no version of {self.root} has passed its checks")
        table = self.spark.read.parquet(f"{self.root}/staged/v{version}")
        return table if self.time is None else table.drop("dt")
