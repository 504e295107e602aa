"""File sources. Schemas are declared, so no pass over the data infers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.sources.json_arrays import variant_field

NULL_TOKEN = "NULL"  # fixed value: written for null besides the empty text


# One way of quoting for all CSV readers and the writer: quotes inside a field are doubled and
# white space belongs to the field.
CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _named_texts(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool, missing: str = "error", mode: str = "PERMISSIVE"
) -> DataFrame:
    """The named columns of CSV files as text, wherever they stand in the header.

    The header of one file is read first; files whose header differs from it are an
    error rather than read by position. ``missing`` says what a column that is not
    there becomes: an error or nulls.
    """
    reader = spark.read.options(**CSV_DIALECT).option("multiLine", multi_line).option("mode", mode).option("nullValue", "")
    header = reader.csv(path).columns
    known = {c.lower(): c for c in header}
    lost = [c for c in columns if c.lower() not in known]
    if lost and missing == "error":
        raise ValueError(f"{path}: no columns {lost} among {header}")
    all_text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = reader.schema(all_text).option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f"`{known[c.lower()]}`").alias(c) if c.lower() in known else F.lit(None).cast("string").alias(c) for c in columns])


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header; '' and 'NULL' are null; the first bad row or value fails the job.

    ``multi_line`` allows line breaks inside quotes but makes files unsplittable.
    """
    raw = _named_texts(spark, path, schema.names, multi_line, mode="FAILFAST")
    return raw.select(
        *[F.nullif(F.col(f"`{f.name}`"), F.lit(NULL_TOKEN)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_csv_loose(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False, missing: str = "error"
) -> DataFrame:
    """CSV with a header, the named columns as strings; coercion is left to the caller."""
    return _named_texts(spark, path, columns, multi_line, missing)


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False, missing: str = "error"
) -> DataFrame:
    """CSV with a header, columns by name; a value that does not fit its type is null."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = _named_texts(spark, path, wanted.names, multi_line, missing)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files holding one JSON array of objects; keys match in any case, record by record.

    Columns come out lower case. Of several spellings of a key in one record the first in the
    order of the keys counts; a value that does not fit its type is null. A file is parsed once, by
    one task, and must fit a variant (128 MB), which suits many files of moderate size; ``json_arrays.read_json_arrays``
    splits a file of any size.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    each = whole.select(F.explode(F.expr("cast(v as array<map<string, variant>>)")).alias("m"))

    return each.select(*[variant_field(F.col("m"), f.name, f.dataType) for f in wanted.fields])


def read_nested_json(
    spark: SparkSession, path: str, schema: T.StructType | str, array: str, per_line: bool = False
) -> DataFrame:
    """JSON documents with an array of objects, one row per object.

    A file is one document; with ``per_line`` every line is one, and files can be split.
    """
    return spark.read.schema(schema).option("multiLine", not per_line).json(path).select(F.inline(array))


def read_by_extension(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet or CSV by file suffix; anything else is an error."""
    lowered = path.lower().rstrip("/")
    if lowered.endswith(".parquet"):
        return spark.read.parquet(path)
    if lowered.endswith(".csv"):
        return read_csv_typed(spark, path, schema) if schema is not None else spark.read.options(**CSV_DIALECT).csv(path)
    raise ValueError(f"neither a parquet nor a csv file: {path}")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of every file, without reading the bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).drop("content")
