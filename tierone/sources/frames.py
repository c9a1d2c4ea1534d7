"""Where bronze takes its rows from: the fixture tables, or frames a user brings."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone import schemas as S
from tierone.config import FIXED_RUN, RunContext
from tierone.functions.period import in_periods
from tierone.operators.fingerprint import fingerprint
from tierone.sources import fixtures


class Source(Protocol):
    #: True if a quarter that the source does not have is to be removed where it was landed.
    complete: bool

    def periods(self) -> DataFrame:
        """``year``, ``quarter`` and fingerprint of every quarter there is, in one aggregate."""

    def master(self) -> DataFrame:
        """The fingerprint of the institution master."""

    def institutions(self, run: RunContext) -> DataFrame:
        """The master in the bronze schema."""

    def financials(self, run: RunContext, periods: list[tuple[int, int]]) -> DataFrame:
        """At least the rows of ``periods``, in the bronze schema."""


@dataclass(frozen=True)
class FixtureSource:
    spark: SparkSession
    sf_dir: str
    complete: bool = True

    def periods(self) -> DataFrame:
        return fixtures.period_fingerprints(self.spark, self.sf_dir)

    def master(self) -> DataFrame:
        return fingerprint(fixtures.institutions(self.spark, self.sf_dir, FIXED_RUN),
                           [f.name for f in S.INSTITUTIONS_BUSINESS])

    def institutions(self, run: RunContext) -> DataFrame:
        return fixtures.institutions(self.spark, self.sf_dir, run)

    def financials(self, run: RunContext, periods: list[tuple[int, int]]) -> DataFrame:
        # Date ranges skip other quarters' row groups at the scan.
        return fixtures.financials(self.spark, self.sf_dir, run, periods)


@dataclass(frozen=True)
class FrameSource:
    """Frames with the business columns of the bronze schemas, ``year`` and ``quarter`` included.

    Other columns are left out, and the lineage columns are set from the run
    and ``name``. A value that does not fit its column's type fails the run
    (ANSI casts). Rows without a year or quarter belong to no unit; they raise.
    """

    institutions_df: DataFrame
    financials_df: DataFrame
    name: str
    #: The frames hold every quarter there is, not only new ones.
    complete: bool = False

    def periods(self) -> DataFrame:
        year, quarter = F.col("year").cast("int"), F.col("quarter").cast("int")
        missing = F.raise_error(F.lit("financials without a year or quarter")).cast("int")
        business = S.FINANCIALS_BUSINESS
        rows = self.financials_df.select(
            F.when(year.isNull() | quarter.isNull(), missing).otherwise(year).alias("year"),
            quarter.alias("quarter"), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in business])
        return fingerprint(rows, [f.name for f in business], ["year", "quarter"])

    def master(self) -> DataFrame:
        business = S.INSTITUTIONS_BUSINESS
        return fingerprint(self.institutions_df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in business]), [f.name for f in business])

    def institutions(self, run: RunContext) -> DataFrame:
        return self._shaped(self.institutions_df, S.BRONZE_INSTITUTIONS, run)

    def financials(self, run: RunContext, periods: list[tuple[int, int]]) -> DataFrame:
        return self._shaped(self.financials_df.filter(in_periods(periods)), S.BRONZE_FINANCIALS, run)

    def _shaped(self, df: DataFrame, schema: T.StructType, run: RunContext) -> DataFrame:
        lineage = {"_ingested_at": F.lit(run.ingested_at), "_source": F.lit(self.name)}
        return df.select(*[lineage.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])
