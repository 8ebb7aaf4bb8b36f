"""Validation of a DataFrame with the approved rules of its source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import validate as V
from mendflow.sources import rules, tables


class Validator:
    """Runs approved rules on DataFrames and appends failing rows to quarantine tables.

    ``rules_table`` and ``universal_rules_table`` are table names or DataFrames. ``refs`` maps
    the table names used by foreign-key and cross-table checks to DataFrames; names that are
    absent are read as tables.
    """

    def __init__(
        self,
        spark: SparkSession,
        rules_table: str | DataFrame,
        universal_rules_table: str | DataFrame | None = None,
        quarantine_table: str | None = None,
        quarantine_schema: str = "quarantine",
        refs: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.rules_table = rules_table
        self.universal_rules_table = universal_rules_table
        self.quarantine_table = quarantine_table
        self.quarantine_schema = quarantine_schema
        self.refs = dict(refs or {})
        self.last_counts: dict[str, int] = {}

    def _frame(self, table: str | DataFrame | None) -> DataFrame:
        if table is None:
            raise ValueError("universal_rules_table is not set")
        return tables.read(self.spark, table) if isinstance(table, str) else table

    def refs_for(self, checks: Sequence[Mapping]) -> dict[str, DataFrame]:
        """Frames of the tables that the checks compare with."""
        return tables.refs_for(self.spark, checks, self.refs)

    def approved_checks_for(self, table_fqns: str | Sequence[str]) -> list[dict]:
        """The checks that quarantine rows of these tables, for re-validating a fix."""
        return rules.approved_checks_for(self._frame(self.rules_table), table_fqns)

    def quarantine_name(self, sources: str | Sequence[str]) -> str:
        return V.quarantine_name(sources, self.quarantine_table, self.quarantine_schema)

    def run_validation(
        self,
        input_df: DataFrame,
        rules: str | Sequence[str],
        row_id_columns: str | Sequence[str] | None = None,
    ) -> DataFrame:
        """Quarantine failing rows and return the rows without a failed error check."""
        V.check_is_dataframe(input_df)
        sources = V.source_list(rules)
        target = self.quarantine_name(sources)
        checks = self.approved_checks_for(sources)
        seen = Observation()
        valid, quarantine = V.validate(
            input_df, checks, sources, row_id_columns, self.refs_for(checks), observation=seen
        )
        self._append(quarantine, target, seen)
        return valid

    def run_universal_rule_validation(
        self,
        input_df: DataFrame,
        rule_name: str,
        column_names: str | Sequence[str],
        source_table: str,
        row_id_columns: str | Sequence[str] | None = None,
    ) -> DataFrame:
        """Run the newest approved universal rule of that name against the columns."""
        V.check_is_dataframe(input_df)
        found = rules.latest_universal_rules(self._frame(self.universal_rules_table), rule_name)
        row = found.head()
        if row is None:
            raise ValueError(f"No approved universal rule found for {rule_name!r}")
        templates = rules.checks_from_rows(found.withColumn("table_fqn", F.lit(source_table)))
        valid, quarantine = V.validate_universal(
            input_df, templates, column_names, source_table, rule_name, row_id_columns,
            self.refs_for(templates),
        )
        seen = Observation()
        self._append(V.observe_quarantine(quarantine, seen), self.quarantine_name(source_table), seen)
        return valid

    def _append(self, quarantine: DataFrame, target: str, seen: Observation) -> None:
        """Append the bad rows, if there are any.

        The checks run once: the bad rows are written to the scratch folder and counted by that
        write, and only these few rows are read again for the append.
        """
        with tables.scratch(self.spark):
            found = tables.cut_lineage(quarantine)
            self.last_counts = dict(seen.get)
            if self.last_counts["invalid_rows"]:
                self._same_sources(found, target)
                tables.append(found, target)

    def _same_sources(self, rows: DataFrame, target: str) -> None:
        """Refuse to mix the rows of two sets of sources whose shortened names are equal."""
        if not V.is_shortened(target) or not tables.exists(self.spark, target):
            return
        both = rows.select(S.DATA_SOURCE).unionAll(tables.read(self.spark, target).select(S.DATA_SOURCE))
        ends = both.agg(F.min(S.DATA_SOURCE).alias("a"), F.max(S.DATA_SOURCE).alias("b")).head()
        if ends["a"] != ends["b"]:
            raise ValueError(f"{target} already holds rows of other sources: {ends['a']} and {ends['b']}")
