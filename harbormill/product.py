"""A data product: what it makes, where, and what must hold before it is published."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from harbormill.models import Model
from harbormill.operators.columns import conform
from harbormill.quality.checks import Contract, Rule, all_checks, check_rows, check_schema, has_rows
from harbormill.sinks.publish import Published, publish_if_pass
from harbormill.sinks.tables import provision_table


@dataclass(frozen=True)
class DataProduct:
    """The three hooks of a product: provision its table, run its transform, verify what is published."""

    model: Model
    table: str
    transform: Callable[..., DataFrame]
    rules: Sequence[Rule] = ()
    required: tuple[str, ...] = ("schema", "non_empty")
    location: str | None = None

    def provision(self, spark: SparkSession) -> None:
        provision_table(spark, self.model, self.table, self.location)

    def checks(self, df: DataFrame) -> DataFrame:
        return all_checks([check_schema(df, self.model), check_rows(df, self.model.name, self.rules, nonempty=True)])

    def run(self, *inputs: DataFrame) -> Published:
        """Transform, conform to the model, check, and publish if every check allows it."""
        made = conform(self.transform(*inputs), self.model)
        contract = Contract(self.model.name, [*self.rules, has_rows()])
        return publish_if_pass(made, contract, self.table, self.required, self.location, also=check_schema(made, self.model))

    def verify(self, spark: SparkSession) -> DataFrame:
        return self.checks(spark.table(self.table))
