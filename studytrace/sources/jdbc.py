"""JDBC tables: partitioned slice scan and batched append."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from studytrace.plans.tables import Tables, time_slice

# Fixed value: rows per insert batch.
BATCH_ROWS = 100_000


@dataclass(frozen=True)
class Warehouse:
    """A JDBC database holding the three tables."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partitions: int = 16

    def scan_options(self, table: str) -> dict[str, str]:
        """Options of a whole-table scan."""
        return {
            "url": self.url,
            "dbtable": table,
            "preferTimestampNTZ": "true",
            **self.properties,
        }

    def slice_options(self, table: str, column: str, start, end) -> dict[str, str]:
        """Options of a scan cut by ``column`` into parallel range queries.

        The bounds only place the cuts; the range itself is a pushed filter.
        """
        return {
            **self.scan_options(table),
            "partitionColumn": column,
            "lowerBound": str(start),
            "upperBound": str(end),
            "numPartitions": str(self.partitions),
        }

    def write_options(self, table: str) -> dict[str, str]:
        """Options of a batched append over at most ``partitions`` connections."""
        return {
            **self.scan_options(table),
            "batchsize": str(BATCH_ROWS),
            "numPartitions": str(self.partitions),
        }

    def read_slice(self, spark: SparkSession, start: datetime, end: datetime) -> Tables:
        """Log rows in ``[start, end)``, the users occurring there, all content."""
        sliced = self.slice_options("log_problem", "timestamp_TW", start, end)
        tables = Tables(
            _load(spark, sliced),
            _load(spark, self.scan_options("user_profile")),
            _load(spark, self.scan_options("info_content")),
        )
        return time_slice(tables, start, end)

    def append(self, df: DataFrame, table: str) -> None:
        """Append rows; the table is created when missing.

        Each partition commits on its own. Write to a staging table first where
        all rows must appear at once.
        """
        df.write.format("jdbc").mode("append").options(**self.write_options(table)).save()


def _load(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
