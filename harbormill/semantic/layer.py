"""Metric queries: named metrics, sliced by named dimensions.

A query aggregates the base table by its own dimensions and the join keys first,
joins the dimension tables to those partial results, and aggregates again. The
dimension is reduced to one row per key, so a join can never multiply a metric; a key with
differing attributes is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.models import Field, Model, Registry
from harbormill.operators import exact
from harbormill.operators.joins import one_row_per_key

ALL_ROWS = "*"
AGGREGATES = ("sum", "count", "avg")
MASK = "*****"


@dataclass(frozen=True)
class Metric:
    name: str
    agg: str
    of: str
    description: str = ""


@dataclass(frozen=True)
class MetricView:
    name: str
    base: Model
    metrics: tuple[Metric, ...]
    description: str = ""

    def __post_init__(self) -> None:
        for m in self.metrics:
            if m.agg not in AGGREGATES:
                raise ValueError(f"{m.name}: unknown aggregate {m.agg!r}")
            if m.of == ALL_ROWS:
                if m.agg != "count":
                    raise ValueError(f"{m.name}: only COUNT applies to all rows")
            elif m.of not in self.base.columns:
                raise ValueError(f"{m.name}: {self.base.name} has no field {m.of!r}")
            if m.name in self.base.columns:
                raise ValueError(f"{m.name}: a base field cannot be a metric")


@dataclass(frozen=True)
class Filter:
    dimension: str
    op: str  # =, !=, <, <=, >, >=, in, like
    value: object

    def applied_to(self, c: Column) -> Column:
        match self.op:
            case "=":
                return c == self.value
            case "!=":
                return c != self.value
            case "<":
                return c < self.value
            case "<=":
                return c <= self.value
            case ">":
                return c > self.value
            case ">=":
                return c >= self.value
            case "in":
                return c.isin(*self.value)
            case "like":
                return c.like(self.value)
        raise ValueError(f"unknown operator {self.op!r}")


@dataclass
class SemanticLayer:
    registry: Registry
    views: Sequence[MetricView]
    tables: Mapping[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = [m.name for v in self.views for m in v.metrics]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"metric names used twice: {repeated}")

    def list_metrics(self, spark: SparkSession) -> DataFrame:
        rows = [(v.name, v.base.name, m.name, m.agg, m.of, m.description) for v in self.views for m in v.metrics]
        return spark.createDataFrame(
            rows, "view string, model string, metric string, agg string, field string, description string"
        )

    def _view_of(self, metrics: Sequence[str]) -> MetricView:
        for view in self.views:
            if set(metrics) <= {m.name for m in view.metrics}:
                return view
        raise KeyError(f"no view has all of the metrics {list(metrics)}")

    def _locate(self, base: Model, dimension: str) -> tuple[Model, Field]:
        """The base model's own dimension, or one that a declared join reaches."""
        if dimension in base.dimensions:
            return base, base.dimensions[dimension]
        for name in base.joins:
            reached = self.registry[name]
            if dimension in reached.dimensions:
                return reached, reached.dimensions[dimension]
        raise KeyError(f"{base.name} cannot be sliced by {dimension!r}")

    def query(
        self,
        metrics: Sequence[str],
        dimensions: Sequence[str] = (),
        filters: Sequence[Filter] = (),
        allow_pii: bool = False,
    ) -> DataFrame:
        view = self._view_of(metrics)
        base = view.base
        wanted = [m for name in metrics for m in view.metrics if m.name == name]
        placed = {d: self._locate(base, d) for d in dict.fromkeys([*dimensions, *(f.dimension for f in filters)])}

        rows = self.tables[base.name]
        for f in filters:
            model, column = placed[f.dimension]
            if model is base:
                rows = rows.where(f.applied_to(F.col(column.name)))

        own = [d for d in dimensions if placed[d][0] is base]
        reached = [m for m in dict.fromkeys(model.name for model, _ in placed.values()) if m != base.name]
        keys = {name: base.joins[name] for name in reached}
        summed = _summed_doubles(base, wanted)
        partial = exact.with_units(rows, {c: F.col(c) for c in summed}).groupBy(
            *[self._shown(placed[d][1], allow_pii).alias(d) for d in own],
            *[F.col(k.name).alias(f"_key_{name}") for name, k in keys.items()],
            *[f"_b_{c}" for c in summed],
        ).agg(*_partials(base, wanted))

        for name, key in keys.items():
            partial = self._join_dimension(partial, name, key, dimensions, filters, placed, allow_pii)
        if keys and summed:  # one row per band before the bands of a group are put together
            partial = partial.groupBy(*dimensions, *[f"_b_{c}" for c in summed]).agg(*_merged(base, wanted))
        return partial.groupBy(*dimensions).agg(*_finals(base, wanted))

    def _shown(self, column: Field, allow_pii: bool) -> Column:
        c = F.col(column.name)
        if column.role is not None and column.role.pii and not allow_pii:
            return F.when(c.isNotNull(), F.lit(MASK))
        return c

    def _join_dimension(self, partial, name, key, dimensions, filters, placed, allow_pii) -> DataFrame:
        columns = {d: column for d, (model, column) in placed.items() if model.name == name}
        parent_key = key.role.to_column
        kept = [f for f in filters if f.dimension in columns]
        conditions = [f.applied_to(F.col(columns[f.dimension].name)) for f in kept]
        # the columns that slice or filter; the filters go to the scan
        wanted = list(dict.fromkeys(c.name for c in columns.values()))
        parents = one_row_per_key(self.tables[name], parent_key, wanted, reduce(and_, conditions) if conditions else None)
        parents = parents.select(
            F.col(parent_key).alias(f"_key_{name}"),
            *[self._shown(columns[d], allow_pii).alias(d) for d in dimensions if d in columns],
        )
        # a filtered dimension must be present; otherwise facts without a parent stay
        return partial.join(parents, f"_key_{name}", "inner" if kept else "left")


def _adds_exactly(base: Model, column: str) -> bool:
    """Whole numbers and decimals; their own sums are exact."""
    return isinstance(base.schema[column].dataType, (T.LongType, T.IntegerType, T.DecimalType))


def _summed_doubles(base: Model, metrics: Sequence[Metric]) -> list[str]:
    return list(dict.fromkeys(m.of for m in metrics if m.agg in ("sum", "avg") and not _adds_exactly(base, m.of)))


def _partials(base: Model, metrics: Sequence[Metric]) -> list[Column]:
    out = [a for c in _summed_doubles(base, metrics) for a in exact.partial_sums(c)]
    for m in metrics:
        if m.of == ALL_ROWS:
            out.append(F.count(F.lit(1)).alias(f"_rows_{m.name}"))
        elif m.agg == "count" or _adds_exactly(base, m.of):
            out.append(F.count(m.of).alias(f"_rows_{m.name}"))
        if m.agg in ("sum", "avg") and _adds_exactly(base, m.of):
            out.append(F.sum(m.of).alias(f"_sum_{m.name}"))
    return out


def _merged(base: Model, metrics: Sequence[Metric]) -> list[Column]:
    out = [a for c in _summed_doubles(base, metrics) for a in exact.merged_sums(c)]
    for m in metrics:
        if m.agg == "count" or _adds_exactly(base, m.of):
            out.append(F.sum(f"_rows_{m.name}").alias(f"_rows_{m.name}"))
        if m.agg in ("sum", "avg") and _adds_exactly(base, m.of):
            out.append(F.sum(f"_sum_{m.name}").alias(f"_sum_{m.name}"))
    return out


def _finals(base: Model, metrics: Sequence[Metric]) -> list[Column]:
    out: list[Column] = []
    for m in metrics:
        if m.agg == "count":
            out.append(F.coalesce(F.sum(f"_rows_{m.name}"), F.lit(0)).cast("bigint").alias(m.name))
            continue
        own = _adds_exactly(base, m.of)
        total = F.sum(f"_sum_{m.name}") if own else exact.total_of(m.of)
        if m.agg == "avg":
            n = F.sum(f"_rows_{m.name}" if own else f"_n_{m.of}")
            total = F.try_divide(total.cast("double"), n.cast("double"))
        elif isinstance(base.schema[m.of].dataType, T.DecimalType):
            total = total.cast("double")
        out.append(total.alias(m.name))
    return out
