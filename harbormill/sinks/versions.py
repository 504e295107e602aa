"""Tables whose rows live in versioned folders, so that publishing is one step of the catalog.

New rows are first written to a folder that nothing reads. Then the table is pointed there, and what it pointed to before
is removed last. A job that dies at any moment leaves a table that reads either all
old or all new rows; at worst a folder that nothing points to stays behind, see ``remove_orphans``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from harbormill.session import remove_path

FORMAT = "parquet"
PREFIX = "v-"  # of the folders that hold a version


def observed(seen: Observation) -> dict[str, object]:
    """Observed values; none if the plan was found to be empty before it ran, as nothing is observed then."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    # the last of that name: a column may be called so too
    return [r["data_type"] for r in rows if r["col_name"] == "Location"][-1]


def home_of(spark: SparkSession, table: str, location: str | None) -> str:
    """The folder below which a table's versions lie."""
    if location:
        return location.rstrip("/")
    if spark.catalog.tableExists(table):
        place = table_location(spark, table).rstrip("/")
        parent, _, last = place.rpartition("/")
        return parent if last.startswith(PREFIX) else place
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/{table.replace('.', '/').replace('`', '')}-versions"


def new_version(home: str) -> str:
    return f"{home}/{PREFIX}{uuid.uuid4().hex}"


def write_version(df: DataFrame, home: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write the rows to a fresh folder and return it. No table points there yet."""
    place = new_version(home)
    writer = df.write.format(FORMAT)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(place)
    return place


def create_at(spark: SparkSession, df: DataFrame, table: str, place: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {FORMAT} LOCATION {_quoted(place)}")


def same_columns(df: DataFrame, spark: SparkSession, table: str) -> bool:
    mine = [(f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields]
    return mine == [(f.name.lower(), f.dataType.simpleString()) for f in spark.table(table).schema.fields]


def recover(spark: SparkSession, table: str) -> None:
    """Finish a replacement that died between its two renames: the old table gets its name back."""
    old = f"{table}__old"
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def publish_version(
    df: DataFrame, table: str, location: str | None = None, step: Callable[[str], None] = lambda _: None
) -> None:
    """Replace a table's rows, and its columns if they differ, by those of ``df``, which may read the table itself.

    ``step`` is told what comes next, for tests that stop there.
    """
    spark = df.sparkSession
    step("write")
    home = home_of(spark, table, location)
    publish_place(df, table, write_version(df, home), home, step)


def publish_place(df: DataFrame, table: str, place: str, home: str, step: Callable[[str], None] = lambda _: None) -> None:
    """Make a table read the folder ``place``, which holds the rows of ``df``.

    With equal columns the table is moved in one step of the catalog. With others a second table is made beside
    it and the two change names; a job that dies between the two renames leaves the rows in ``<table>__old``, which ``recover``
    brings back at the next publication.
    """
    spark = df.sparkSession
    recover(spark, table)
    if not spark.catalog.tableExists(table):
        step("create")
        create_at(spark, df, table, place)
        return
    before = table_location(spark, table)
    if same_columns(df, spark, table):
        step("point")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(place)}")
        spark.catalog.refreshTable(table)
    else:
        fresh, old = f"{table}__new", f"{table}__old"
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        step("create")
        create_at(spark, df, fresh, place)
        step("rename old")
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        step("rename new")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        step("drop old")
        spark.sql(f"DROP TABLE {old}")
    step("remove")
    remove_version(spark, before)


def remove_version(spark: SparkSession, place: str) -> None:
    """Remove a folder that a table read before, if it is a version of its own; the home folder itself stays."""
    if place.rstrip("/").rpartition("/")[2].startswith(PREFIX):
        remove_path(spark, place)
    else:
        _remove_files(spark, place)


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().toString(), s.isDirectory()) for s in fs.listStatus(path)] if fs.exists(path) else []


def _remove_files(spark: SparkSession, folder: str) -> None:
    """Files that lie in a home folder from before it had versions."""
    for name, is_folder in _listed(spark, folder):
        if not is_folder:
            remove_path(spark, name)


def remove_orphans(spark: SparkSession, home: str, used: set[str]) -> list[str]:
    """Remove version folders below ``home`` that hold none of the ``used`` places; only while no job writes there."""
    plain = {u.rstrip("/").split(":", 1)[-1].lstrip("/") for u in used}
    gone = []
    for name, is_folder in _listed(spark, home):
        own = name.rstrip("/").split(":", 1)[-1].lstrip("/")
        if is_folder and own.rpartition("/")[2].startswith(PREFIX) and not any(u == own or u.startswith(f"{own}/") for u in plain):
            remove_path(spark, name)
            gone.append(name)
    return gone
