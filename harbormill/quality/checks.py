"""Checks over one table are fused into a single pass.

Each rule is a boolean column that marks a bad row. All rules of a table become
conditional counts of one aggregate, whose single row is then turned into one
row per rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.functions.numeric import percent
from harbormill.functions.text import digit_count, market_key, strip, title_case
from harbormill.models import Model
from harbormill.models.glossary import allowed_values
from harbormill.operators.joins import children_of, orphan_count
from harbormill.operators.sets import missing_columns
from harbormill.sources.files import file_listing

PASS, WARNING, FAILED = "PASS", "WARNING", "FAILED"
RESULT_DDL = "check string, model string, status string, total bigint, bad bigint, bad_pct double"

# Identifier width, age limits, and patterns of personal data.
ID_DIGITS = 10
ROW_AGE = dt.timedelta(days=365)
FILE_AGE = dt.timedelta(hours=24)
TIMESTAMP_AGE = dt.timedelta(hours=10)
ACTIVITY_WINDOW = dt.timedelta(days=180)
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE = r"\+?\d{1,3}[ -]\(?\d{1,4}\)?[ -]\d{3,4}[ -]?\d{3,4}"
NATIONAL_ID = r"\b\d{3}-\d{2}-\d{4}\b"
# each pattern beside a character without which it cannot match
PERSONAL_DATA = ((EMAIL, "@"), (PHONE, None), (NATIONAL_ID, "-"))
FLAG_TEXTS = ("true", "false", "1", "0")


@dataclass(frozen=True)
class Rule:
    """``bad`` marks offending rows; null counts as not offending."""

    name: str
    bad: Column
    severity: str = WARNING


@dataclass(frozen=True)
class TableRule:
    """A rule on the table as a whole: ``bad`` and ``total`` are aggregates."""

    name: str
    bad: Column
    severity: str = FAILED
    total: Column | None = None


def _status(bad: Column, severity: str) -> Column:
    return F.when(bad > 0, severity).otherwise(PASS)


def _result(name: str, model: str, status: Column, total: Column, bad: Column) -> Column:
    total, bad = total.cast("bigint"), bad.cast("bigint")
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(model).alias("model"),
        status.alias("status"),
        total.alias("total"),
        bad.alias("bad"),
        percent(bad, total).alias("bad_pct"),
    )


def _bad_rows(rule: Rule) -> Column:
    return F.coalesce(F.sum(F.when(rule.bad, 1).otherwise(0)), F.lit(0))


@dataclass(frozen=True)
class Contract:
    """Rules on the rows of a model; their counts are aggregates of one pass, or observed while the rows are written."""

    model: str
    rules: Sequence[Rule | TableRule]

    def counts(self) -> list[Column]:
        counts = [F.count(F.lit(1)).alias("total")]
        for i, rule in enumerate(self.rules):
            counts.append((_bad_rows(rule) if isinstance(rule, Rule) else rule.bad).alias(f"bad_{i}"))
            if isinstance(rule, TableRule) and rule.total is not None:
                counts.append(rule.total.alias(f"total_{i}"))
        return counts

    def results(self, counted: DataFrame) -> DataFrame:
        """One row a rule, from the single row of ``counts``."""
        results = []
        for i, rule in enumerate(self.rules):
            own_total = isinstance(rule, TableRule) and rule.total is not None
            total, bad = F.col(f"total_{i}" if own_total else "total"), F.col(f"bad_{i}")
            results.append(_result(rule.name, self.model, _status(bad, rule.severity), total, bad))
        return counted.select(F.inline(F.array(*results)))

    def results_of(self, spark: SparkSession, seen: Mapping[str, object]) -> DataFrame:
        """The same from observed counts."""
        columns = ", ".join(f"{name} bigint" for name in seen)
        return self.results(spark.createDataFrame([tuple(int(v or 0) for v in seen.values())], columns))


def check_rows(df: DataFrame, model: str, rules: Sequence[Rule | TableRule], nonempty: bool = False) -> DataFrame:
    """One pass for any number of rules; ``nonempty`` adds the check that rows exist."""
    contract = Contract(model, [*rules, has_rows()] if nonempty else list(rules))
    return contract.results(df.agg(*contract.counts()))


def check_first_failure(df: DataFrame, model: str, name: str, rules: Sequence[Rule]) -> DataFrame:
    """One row: the first rule in order that is broken decides, later ones are not reported."""
    counts = [F.count(F.lit(1)).alias("total")]
    for i, rule in enumerate(rules):
        counts.append(_bad_rows(rule).alias(f"bad_{i}"))
    first, bad = F.lit(name), F.lit(0).cast("bigint")
    for i, rule in reversed(list(enumerate(rules))):
        broken = F.col(f"bad_{i}") > 0
        first = F.when(broken, F.lit(f"{name}:{rule.name}")).otherwise(first)
        bad = F.when(broken, F.col(f"bad_{i}")).otherwise(bad)
    totals = df.agg(*counts).select(first.alias("check"), F.col("total"), bad.alias("bad"))
    return totals.select(
        "check",
        F.lit(model).alias("model"),
        _status(F.col("bad"), FAILED).alias("status"),
        F.col("total").cast("bigint").alias("total"),
        F.col("bad").cast("bigint").alias("bad"),
        percent(F.col("bad"), F.col("total")).alias("bad_pct"),
    )


def fixed_result(
    spark: SparkSession, name: str, model: str, failed: bool, total: int, bad: int, severity: str = FAILED
) -> DataFrame:
    """Result of a check on metadata, known without reading rows."""
    row = (name, model, severity if failed else PASS, total, bad, round(100.0 * bad / total, 2) if total else 0.0)
    return spark.createDataFrame([row], RESULT_DDL)


# --- row rules ---------------------------------------------------------------


def is_null(column: str, severity: str = WARNING) -> Rule:
    return Rule(f"null:{column}", F.col(column).isNull(), severity)


def is_blank(column: str, severity: str = FAILED) -> Rule:
    return Rule(f"blank:{column}", F.coalesce(strip(F.col(column).cast("string")), F.lit("")) == "", severity)


def wrong_length(column: str, digits: int = ID_DIGITS) -> Rule:
    c = F.col(column)
    return Rule(f"length:{column}", c.isNull() | (digit_count(c) != digits))


def wrong_casing(columns: Sequence[str]) -> Rule:
    """Any of the columns differs from its title-cased form."""
    bad = F.lit(False)
    for name in columns:
        bad = bad | F.coalesce(F.col(name) != title_case(F.col(name)), F.lit(False))
    return Rule(f"casing:{','.join(columns)}", bad)


def wrong_extension(column: str, suffix: str = ".pdf") -> Rule:
    return Rule(f"extension:{column}", ~F.lower(F.col(column)).endswith(suffix))


def stale_row(column: str, as_of: dt.datetime, age: dt.timedelta = ROW_AGE) -> Rule:
    """Older than the limit; null dates are not stale."""
    return Rule(f"stale:{column}", F.col(column) < F.lit(as_of - age))


def holds_pii(column: str, patterns: Iterable[tuple[str, str | None]] = PERSONAL_DATA) -> Rule:
    """The plain search for a pattern's fixed character spares most texts the pattern itself."""
    text = F.col(column).cast("string")
    bad = F.lit(False)
    for pattern, needle in patterns:
        found = text.rlike(pattern)
        bad = bad | (found if needle is None else text.contains(needle) & found)
    return Rule(f"pii:{column}", bad)


def unredacted_email(column: str) -> Rule:
    """Only the domain may be kept, so no '@' may remain."""
    return Rule(f"unredacted:{column}", F.col(column).contains("@"), FAILED)


def negative(column: str) -> Rule:
    return Rule(f"negative:{column}", F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)) < 0, FAILED)


def not_numeric(column: str) -> Rule:
    text = F.nullif(strip(F.col(column).cast("string")), F.lit(""))
    return Rule(f"non_numeric:{column}", text.isNotNull() & text.try_cast("double").isNull(), FAILED)


def unknown_flag(column: str, allowed: Sequence[str] = FLAG_TEXTS) -> Rule:
    text = F.lower(strip(F.coalesce(F.col(column).cast("string"), F.lit(""))))
    return Rule(f"flag:{column}", ~text.isin(*allowed), FAILED)


def outside(column: str, low: float, high: float) -> Rule:
    """Out of the closed range; null and text that is no number are not judged."""
    c = F.col(column).try_cast("double")
    return Rule(f"range:{column}", (c < low) | (c > high), FAILED)


def not_positive(column: str) -> Rule:
    return Rule(f"not_positive:{column}", F.coalesce(F.col(column).try_cast("bigint"), F.lit(0)) <= 0, FAILED)


def breaks_pattern(column: str, pattern: str, severity: str = WARNING) -> Rule:
    return Rule(f"pattern:{column}", ~F.col(column).rlike(f"^(?:{pattern})$"), severity)


def outside_domain(column: str, allowed: Iterable[str], severity: str = FAILED) -> Rule:
    """Value, or null, that is not in the allowed list."""
    c = F.col(column)
    return Rule(f"domain:{column}", c.isNull() | ~c.isin(*allowed), severity)


def outside_term(column: str, term: str) -> Rule:
    """Value outside the glossary term's list; null is left to the null check."""
    values = allowed_values(term)
    if values is None:
        raise ValueError(f"glossary term {term!r} allows any value")
    return Rule(f"term:{column}", ~F.col(column).isin(*values))


# --- rules on the table as a whole --------------------------------------------


def has_rows() -> TableRule:
    return TableRule("non_empty", (F.count(F.lit(1)) == 0).cast("int"))


def newest_within(column: str, as_of: dt.datetime, age: dt.timedelta = TIMESTAMP_AGE) -> TableRule:
    """The newest timestamp is within the limit; a table without one fails."""
    late = F.coalesce(F.max(column) < F.lit(as_of - age), F.lit(True))
    return TableRule(f"latest:{column}", late.cast("int"))


def recent_rows(column: str, as_of: dt.datetime, window: dt.timedelta = ACTIVITY_WINDOW) -> TableRule:
    """At least one row in the trailing window; ``total`` counts them."""
    found = F.count_if(F.col(column) >= F.lit(as_of - window))
    return TableRule(f"recent:{column}", (found == 0).cast("int"), FAILED, found)


# --- checks with their own plan -----------------------------------------------


def check_nonempty(df: DataFrame, model: str, severity: str = FAILED) -> DataFrame:
    """Stops at the first row it finds."""
    found = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    bad = 1 - F.col("n")
    return found.select(F.inline(F.array(_result("non_empty", model, _status(bad, severity), F.col("n"), bad))))


def check_readable(spark: SparkSession, path: str, model: str, file_format: str = "parquet") -> DataFrame:
    """Input has rows; an unreadable input fails as well. ``total`` is the row count in any format.

    Counting a columnar file reads its footers only.
    """
    try:
        rows = spark.read.format(file_format).load(path)
        found = rows.count()
    except Exception:  # noqa: BLE001 - whatever stops the read is the finding
        return fixed_result(spark, "readable", model, True, 0, 0)
    return fixed_result(spark, "readable", model, found == 0, found, 0)


def check_json_nonempty(spark: SparkSession, path: str, model: str) -> DataFrame:
    """JSON array or one object per line: empty is a warning, unreadable is a failure."""
    try:
        lines = spark.read.text(path).where(F.trim("value") != "")
        # per line: an array counts its elements, an object counts as one
        elements = F.coalesce(F.json_array_length("value"), F.lit(0))
        is_object = F.json_object_keys("value").isNotNull().cast("int")
        found = lines.where((elements > 0) | (is_object == 1)).limit(1).count()
        some_text = not lines.isEmpty()
        if not found and some_text:
            whole = spark.read.text(path, wholetext=True)
            found = whole.where(F.json_array_length("value") > 0).limit(1).count()
            if not found and whole.where(F.json_array_length("value").isNull()).limit(1).count():
                return fixed_result(spark, "json_non_empty", model, True, 0, 0)
    except Exception:  # noqa: BLE001
        return fixed_result(spark, "json_non_empty", model, True, 0, 0)
    return fixed_result(spark, "json_non_empty", model, not found, int(bool(found)), 0, WARNING)


def check_orphans(facts: DataFrame, dimension: DataFrame, key: str, model: str) -> DataFrame:
    found = orphan_count(facts, dimension, key)
    bad = F.col("orphans")
    return found.select(F.inline(F.array(_result(f"orphan:{key}", model, _status(bad, WARNING), F.col("total"), bad))))


def check_inactive_with_children(
    parents: DataFrame, facts: DataFrame, key: str, status: str, model: str, inactive: str = "INACTIVE"
) -> DataFrame:
    """``bad`` counts inactive parents that have facts, ``total`` those facts."""
    idle = parents.where(F.upper(F.col(status)) == inactive)
    found = children_of(idle, facts, key)
    bad = F.col("parents")
    return found.select(
        F.lit(f"inactive_with_children:{key}").alias("check"),
        F.lit(model).alias("model"),
        _status(bad, WARNING).alias("status"),
        F.col("children").cast("bigint").alias("total"),
        bad.cast("bigint").alias("bad"),
        F.lit(0.0).alias("bad_pct"),
    )


def check_expected_values(df: DataFrame, column: str, expected: Iterable[str], model: str) -> DataFrame:
    """Received distinct values within the expected list; expected ones may be missing."""
    values = df.select(column).distinct()
    return check_rows(values, model, [outside_domain(column, list(expected))])


def _compared(column: str) -> Column:
    return F.lower(strip(F.coalesce(F.col(column).cast("string"), F.lit(""))))


def check_unique(df: DataFrame, column: str, model: str) -> DataFrame:
    """Keys equal after trimming and lower-casing count as repeated."""
    per_key = df.groupBy(_compared(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return check_rows(per_key, model, [Rule(f"unique:{column}", F.col("_n") > 1, FAILED)])


def check_columns(df: DataFrame, required: Iterable[str], model: str) -> DataFrame:
    required = list(required)
    absent = missing_columns(df, required)
    return fixed_result(df.sparkSession, "required_columns", model, bool(absent), len(required), len(absent))


def check_schema(df: DataFrame, model: Model) -> DataFrame:
    """Every model column present with its type; extra columns are allowed."""
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    wanted = model.schema.fields
    bad = sum(1 for f in wanted if not _same_type(actual.get(f.name.lower()), f.dataType))
    return fixed_result(df.sparkSession, "schema", model.name, bad > 0, len(wanted), bad)


def _same_type(actual: T.DataType | None, wanted: T.DataType) -> bool:
    return actual is not None and actual.simpleString().lower() == wanted.simpleString().lower()


def check_files_fresh(
    files: DataFrame, model: str, as_of: dt.datetime, age: dt.timedelta = FILE_AGE, severity: str = FAILED
) -> DataFrame:
    """The newest file (column modificationTime) was written within the limit; no file at all fails."""
    stale = F.coalesce(F.max("modificationTime") < F.lit(as_of - age), F.lit(True)).cast("int")
    result = check_rows(files, model, [TableRule("file_fresh", stale, severity)])
    return result.withColumn("status", F.when(F.col("total") == 0, FAILED).otherwise(F.col("status")))


def check_path_fresh(
    spark: SparkSession,
    path: str,
    model: str,
    as_of: dt.datetime,
    age: dt.timedelta = FILE_AGE,
    severity: str = FAILED,
) -> DataFrame:
    """The same for a path; one that cannot be listed fails whatever the severity."""
    try:
        files = file_listing(spark, path)
    except Exception:  # noqa: BLE001 - whatever stops the listing is the finding
        return fixed_result(spark, "file_fresh", model, True, 0, 0)
    return check_files_fresh(files, model, as_of, age, severity)


def check_latest(
    df: DataFrame, column: str, model: str, as_of: dt.datetime, age: dt.timedelta = TIMESTAMP_AGE
) -> DataFrame:
    return check_rows(df, model, [newest_within(column, as_of, age)])


def check_recent_rows(
    df: DataFrame, column: str, model: str, as_of: dt.datetime, window: dt.timedelta = ACTIVITY_WINDOW
) -> DataFrame:
    """The same with the window as a filter, which reaches the scan."""
    recent = df.where(F.col(column) >= F.lit(as_of - window))
    none = (F.count(F.lit(1)) == 0).cast("int")
    return check_rows(recent, model, [TableRule(f"recent:{column}", none)])


def all_checks(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def as_details(results: DataFrame) -> DataFrame:
    """Status with a map of details, the shape in which results are reported."""
    return results.select(
        "status",
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in ("check", "model", "total", "bad", "bad_pct")]),
            F.array(*[F.col(c).cast("string") for c in ("check", "model", "total", "bad", "bad_pct")]),
        ).alias("details"),
    )


# --- contracts of the payment products ---------------------------------------

PAYMENT_COLUMNS = ("step", "customer", "age", "gender", "zipcodeOri", "merchant", "zipMerchant", "category", "amount", "fraud")
DENSITY_COLUMNS = ("market_type", "transaction_count", "fraud_event_count", "fraud_rate_pct")


def raw_payment_expectations(df: DataFrame, known: Sequence[str], required: Sequence[str] = PAYMENT_COLUMNS) -> DataFrame:
    """Expectations on raw payments, reported up to the first one that is broken."""
    name, model = "raw_payments", "banksim_raw"
    absent = missing_columns(df, required)
    if absent:
        return fixed_result(df.sparkSession, f"{name}:required_columns", model, True, len(required), len(absent))
    return check_first_failure(
        df,
        model,
        name,
        [
            is_blank("category"),
            is_null("fraud", FAILED),
            negative("amount"),
            Rule("domain:category", ~market_key(F.col("category")).isin(*known), FAILED),
        ],
    )


def payment_quality(df: DataFrame) -> DataFrame:
    """Quality of cleaned payments; all findings are reported."""
    rules = [is_blank("category"), unknown_flag("fraud"), negative("amount"), not_numeric("amount")]
    return check_rows(df, "banksim_transactions", rules, nonempty=True)


def density_quality(df: DataFrame) -> DataFrame:
    """Quality of the fraud density table; all findings are reported."""
    model = "fraud_density"
    columns = check_columns(df, DENSITY_COLUMNS, model)
    if missing_columns(df, DENSITY_COLUMNS):
        return columns
    rules = [is_blank("market_type"), not_positive("transaction_count"), outside("fraud_rate_pct", 0.0, 100.0)]
    # by market first, so that repeats and all rules come from one pass over the table
    per_key = df.groupBy(_compared("market_type").alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[_bad_rows(rule).alias(f"_bad_{i}") for i, rule in enumerate(rules)]
    )
    none = F.lit(0)
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), none).alias("total"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_n") > 1).alias("repeated"),
        *[F.coalesce(F.sum(f"_bad_{i}"), none).alias(f"bad_{i}") for i in range(len(rules))],
    )
    total, missing = F.col("total"), (F.col("total") == 0).cast("int")
    results = [_result(rule.name, model, _status(F.col(f"bad_{i}"), rule.severity), total, F.col(f"bad_{i}")) for i, rule in enumerate(rules)]
    results.append(_result("non_empty", model, _status(missing, FAILED), total, missing))
    results.append(_result("unique:market_type", model, _status(F.col("repeated"), FAILED), F.col("keys"), F.col("repeated")))
    return columns.unionByName(totals.select(F.inline(F.array(*results))))
