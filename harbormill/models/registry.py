"""Model declarations and the registry that answers questions about them."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.session import checkpointed


@cache
def parsed_type(ddl: str) -> T.DataType:
    """Spark type of a DDL text; each text is sent to the parser once."""
    return T.DataType.fromDDL(ddl)


@dataclass(frozen=True)
class Role:
    kind: str  # primary_key, dimension or join
    name: str | None = None
    pii: bool = False
    to_model: str | None = None
    to_column: str | None = None


def primary_key() -> Role:
    return Role("primary_key")


def dimension(name: str | None = None, pii: bool = False) -> Role:
    return Role("dimension", name=name, pii=pii)


def join_to(model: str, column: str) -> Role:
    """Many-to-one reference to the key of another model."""
    return Role("join", to_model=model, to_column=column)


@dataclass(frozen=True)
class Link:
    """Edge from a column to what it equals, is derived from, or means."""

    predicate: str  # SameAs, Derived or GlossaryTerm
    target: str


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str  # Spark DDL type
    description: str = ""
    role: Role | None = None
    links: tuple[Link, ...] = ()
    nullable: bool = True

    @property
    def dimension_name(self) -> str | None:
        if self.role is None or self.role.kind != "dimension":
            return None
        return self.role.name or self.name

    def struct_field(self) -> T.StructField:
        meta: dict[str, object] = {"comment": self.description}
        if self.role is not None:
            meta["role"] = self.role.kind
            meta["pii"] = self.role.pii
            if self.role.kind == "dimension":
                meta["dimension"] = self.dimension_name
            if self.role.kind == "join":
                meta["references"] = f"{self.role.to_model}.{self.role.to_column}"
        return T.StructField(self.name, parsed_type(self.dtype), self.nullable, meta)


@dataclass(frozen=True)
class Model:
    name: str
    description: str
    fields: tuple[Field, ...]
    sampling: str = "random"  # or "head"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def key(self) -> str | None:
        return next((f.name for f in self.fields if f.role and f.role.kind == "primary_key"), None)

    @property
    def dimensions(self) -> dict[str, Field]:
        return {f.dimension_name: f for f in self.fields if f.dimension_name}

    @property
    def joins(self) -> dict[str, Field]:
        return {f.role.to_model: f for f in self.fields if f.role and f.role.kind == "join"}

    def text_schema(self) -> T.StructType:
        """The same columns, all strings: the landing shape before casts."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


@dataclass
class Registry:
    """Named models; dimension names are unique across all of them."""

    models: dict[str, Model] = field(default_factory=dict)

    def add(self, *models: Model) -> Registry:
        for model in models:
            if model.name in self.models:
                raise ValueError(f"model {model.name!r} is already registered")
            repeated = [n for n, k in Counter(model.columns).items() if k > 1]
            if repeated:
                raise ValueError(f"{model.name}: repeated columns {repeated}")
            taken = {d: m.name for m in self.models.values() for d in m.dimensions}
            clash = sorted(set(model.dimensions) & set(taken))
            if clash:
                raise ValueError(f"{model.name}: dimension names already used: {clash}")
            self.models[model.name] = model
        return self

    def __getitem__(self, name: str) -> Model:
        if name not in self.models:
            raise KeyError(f"unknown model {name!r}; known: {sorted(self.models)}")
        return self.models[name]

    def list_models(self, spark: SparkSession) -> DataFrame:
        rows = [(m.name, m.description, len(m.fields), m.key) for m in self.models.values()]
        return spark.createDataFrame(rows, "model string, description string, field_count int, primary_key string")

    def describe_model(self, spark: SparkSession, name: str) -> DataFrame:
        rows = [
            (
                f.name,
                parsed_type(f.dtype).simpleString(),
                f.role.kind if f.role else "base",
                f.dimension_name,
                bool(f.role and f.role.pii),
                f.description,
            )
            for f in self[name].fields
        ]
        ddl = "field string, type string, role string, dimension string, pii boolean, description string"
        return spark.createDataFrame(rows, ddl)

    def links(self, spark: SparkSession) -> DataFrame:
        """Column edges as data: (model, column, predicate, target)."""
        rows = [
            (m.name, f.name, link.predicate, link.target)
            for m in self.models.values()
            for f in m.fields
            for link in f.links
        ]
        return spark.createDataFrame(rows, "model string, column string, predicate string, target string")


def upstream(edges: DataFrame, model: str, column: str) -> DataFrame:
    """Everything a column points at, directly or through any number of edges, with the least number.

    Each round follows the edges of the columns reached by the round before; what was reached earlier is
    left out, so cycles end. Rounds run until no new column appears.
    """
    source = F.concat_ws(".", "model", "column")
    steps = edges.select(source.alias("source"), "predicate", "target").distinct()
    fresh = edges.sparkSession.range(1).select(F.lit(f"{model}.{column}").alias("at"))
    seen, found, hop = fresh, None, 0
    while found is None or not fresh.isEmpty():
        hop += 1
        taken = steps.join(fresh, F.col("source") == F.col("at")).select("source", "predicate", "target", F.lit(hop).alias("hops"))
        taken = checkpointed(taken)
        found = taken if found is None else found.unionByName(taken)
        fresh = checkpointed(taken.select(F.col("target").alias("at")).distinct().join(seen, "at", "left_anti"))
        seen = seen.unionByName(fresh)
    return found
