"""JSON arrays of any size: files are split, and records are found across the splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Texts between closing braces with the file, the split they were read in and their order there."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    ).repartition("file", "split")  # all windows and both summaries below read this one exchange


def _change(marks: Column, ends_outside: Column) -> Column:
    """Change of the nesting depth by a fragment that starts outside a string, with the brace that ends it."""
    outside = F.regexp_replace(marks, '"[^"]*("|\\z)', "")
    opened = F.length(outside) - F.length(F.translate(outside, "[{", ""))
    closed = F.length(outside) - F.length(F.translate(outside, "]", ""))
    return (opened - closed - F.when(ends_outside, 1).otherwise(0)).cast("long")


def _scanned(fragments: DataFrame) -> DataFrame:
    """What a fragment does to the depth, up to its end, if its split starts outside (0) or inside a string (1)."""
    order = Window.partitionBy("file", "split").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # quotes and opening or closing marks, without escaped characters: two passes over a text, the rest reads little
    bare = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    marked = fragments.withColumn("marks", F.regexp_replace(bare, r'[^"\[\]{]+', ""))
    counted = marked.withColumn("quotes", F.length("marks") - F.length(F.translate("marks", '"', "")))
    even = F.col("quotes") % 2 == 0
    told = counted.withColumns(
        {
            "from_outside": _change(F.col("marks"), even),
            "from_inside": F.when(F.col("quotes") == 0, F.lit(0)).otherwise(
                _change(F.regexp_replace("marks", '^[^"]*"', ""), ~even)
            ),
        }
    ).drop("marks")
    # strings that are open where the fragment starts, counted from the start of its split
    turned = told.withColumn("turned", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    same, other = F.col("from_outside"), F.col("from_inside")
    steps = turned.withColumns(
        {"step0": F.when(F.col("turned"), other).otherwise(same), "step1": F.when(F.col("turned"), same).otherwise(other)}
    )
    return steps.withColumns(
        {
            "depth0": F.sum("step0").over(upto),
            "depth1": F.sum("step1").over(upto),
            "odd": (F.sum("quotes").over(upto) % 2) == 1,
        }
    ).select("file", "split", "at", "value", "quotes", "step0", "step1", "depth0", "depth1", "odd")


def _split_starts(scanned: DataFrame) -> DataFrame:
    """One row per split: whether it starts inside a string, its depth there, and the depth at the end of its file."""
    totals = scanned.groupBy("file", "split").agg(F.sum("quotes").alias("q"), F.sum("step0").alias("s0"), F.sum("step1").alias("s1"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opened = totals.withColumn("inside", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2 == 1)
    stepped = opened.withColumn("step", F.when(F.col("inside"), F.col("s1")).otherwise(F.col("s0")))
    return stepped.select(
        "file",
        "split",
        "inside",
        F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"),
        F.sum("step").over(Window.partitionBy("file")).alias("last_depth"),
    )


def json_array_records(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``record``, the text of an object, for every object of the arrays that the files hold.

    A file is one array of objects in UTF-8; it is split like any text, so that its size does not matter, and only a
    record must fit a task. Brackets and braces inside strings do not count. The depth and the open strings at the start of a split
    follow from one row per split. An empty file or array has no records; a file that ends early or holds
    something else after its array fails the job.
    """
    scanned = _scanned(_fragments(spark, path))
    placed = scanned.join(_split_starts(scanned), ["file", "split"])
    depth = F.col("depth") + F.when(F.col("inside"), F.col("depth1")).otherwise(F.col("depth0"))
    known = placed.select("file", "split", "at", "value", "last_depth", ((depth == 1) & (F.col("inside") == F.col("odd"))).alias("ends"))

    # records that end before a fragment: in its split, and in the splits before
    before = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = known.withColumn("n", F.coalesce(F.sum(F.col("ends").cast("long")).over(before), F.lit(0)))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ended = known.groupBy("file", "split").agg(F.sum(F.col("ends").cast("long")).alias("ended"))
    first = ended.select("file", "split", F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("first"))
    gathered = (
        numbered.join(first, ["file", "split"])
        .groupBy("file", (F.col("first") + F.col("n")).alias("number"))
        .agg(
            F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("parts"),
            F.max("ends").alias("whole"),
            F.max("last_depth").alias("last_depth"),
        )
    )
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    # the text after the last brace lacks one, so a complete file ends one below the depth it began at
    broken = (F.col("last_depth") != -1) | (~F.col("whole") & ~text.rlike(r"\A[\s\x{FEFF}]*(\[\s*)?\]\s*\z"))
    sound = F.when(broken, F.raise_error(F.concat(F.lit("not one array of objects: "), "file")).cast("boolean")).otherwise(F.col("whole"))
    record = F.concat(F.regexp_replace(text, r"\A[\s\x{FEFF}]*[\[,]\s*", ""), F.lit("}"))
    return gathered.where(sound).select("file", record.alias("record"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of ``json_array_records``; keys match in any case, record by record.

    Columns come out lower case. Of several spellings of a key in one record the first in the order of the keys counts;
    a value that does not fit its type is null. A record that is no object fails the job.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    records = json_array_records(spark, path).select(F.parse_json("record").cast("map<string, variant>").alias("m"))
    return records.select(*[variant_field(F.col("m"), f.name, f.dataType) for f in wanted.fields])


def variant_field(m: Column, name: str, dtype: T.DataType) -> Column:
    """The value of a key, in any case, from a map of variants, under the lower-case name."""
    lowered = name.lower()
    value = F.get(F.filter(F.map_entries(m), lambda e: F.lower(e["key"]) == lowered), F.lit(0))["value"]
    return F.try_variant_get(value, "$", dtype.simpleString()).alias(lowered)
