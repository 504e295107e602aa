"""Sources and sinks as round trips through shared storage.

Every workload writes rows of the supplied tables in one form and returns what
reading them back gives, so the expected result is a query on those tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.models import catalog
from harbormill.operators.columns import cast_columns, mask_column
from harbormill.operators.documents import stride_chunks
from harbormill.plans import crm, rates
from harbormill.plans import documents as products
from harbormill.product import DataProduct
from harbormill.quality import checks
from harbormill.session import shared_dir
from harbormill.sinks import files as out
from harbormill.sinks import tables as sink
from harbormill.sinks.publish import PublicationBlocked, publish_if_pass
from harbormill.sources import files, json_arrays, tables
from workloads.documents import issues
from workloads.inputs import ACCOUNT, ACTIVITY, FLAT_DEPOSITS, PAYMENTS
from workloads.rates import C_DEPOSITS_SQL
from workloads.registry import half_up, stamp, table, workload


def _place(spark, purpose: str) -> tuple[str, str]:
    """A table name and a folder for it that no other run uses."""
    return f"t_{uuid.uuid4().hex}", shared_dir(spark, purpose)


ACCOUNT_SQL = f"SELECT * FROM {ACCOUNT.sql}"


# A text with everything that CSV quotes.
HARD = ', "x" \\ a\\"b\n  second line '
HARD_SQL = "', \"x\" \\ a\\\"b' || chr(10) || '  second line '"


@workload("csv_strict", "S01 E21", f"SELECT * REPLACE (city || {HARD_SQL} AS city) FROM {ACCOUNT.sql}")
def csv_strict(spark, d):
    path = shared_dir(spark, "csv")
    # null tokens, quotes, separators, backslashes and line breaks inside the texts, columns in another order
    written = ACCOUNT.df(spark, d).withColumns(
        {"npi": F.coalesce(F.col("npi").cast("string"), F.lit("NULL")), "city": F.concat(F.col("city"), F.lit(HARD))}
    )
    out.write_csv(written.select(*sorted(written.columns)), path)
    return files.read_csv_strict(spark, path, catalog.ACCOUNT.schema, multi_line=True)


@workload(
    "csv_loose",
    "S02 K08 S09 P02",
    f"SELECT step, category || {HARD_SQL} AS category, amount, CASE WHEN fraud = 'x' THEN NULL ELSE CAST(fraud AS BIGINT) END AS fraud FROM {PAYMENTS.sql}",
)
def csv_loose(spark, d):
    path = shared_dir(spark, "csv")
    rows = PAYMENTS.df(spark, d).select("fraud", "amount", F.concat("category", F.lit(HARD)).alias("category"), "step")
    out.write_csv(rows, path)
    read = files.read_csv_loose(spark, path, ["step", "category", "amount", "fraud"], multi_line=True)
    return read.withColumn("fraud", F.col("fraud").try_cast("bigint"))


@workload(
    "csv_typed",
    "S03 K08",
    "SELECT doc_id AS id, source AS filename, lang AS document_type, CAST(NULL AS VARCHAR) AS url, nullif(text, '') AS body FROM documents",
)
def csv_typed(spark, d):
    path = shared_dir(spark, "csv")
    rows = table(spark, d, "documents").selectExpr("text AS body", "source AS filename", "lang AS document_type", "'' AS url", "doc_id AS id")
    out.write_csv(rows, path)
    wanted = "id bigint, filename string, document_type string, url string, body string"
    return files.read_csv_typed(spark, path, wanted, multi_line=True)


@workload("parquet_columns", "S04 K06", "SELECT l_orderkey, l_tax FROM lineitem")
def parquet_columns(spark, d):
    path = shared_dir(spark, "parquet")
    out.write_parquet(table(spark, d, "lineitem"), path)
    return files.read_parquet(spark, path, ["l_orderkey", "l_tax"])


@workload(
    "ndjson",
    "S05 K07",
    "SELECT o_custkey AS bank, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS payment_date, o_totalprice AS dividend_per_share FROM orders",
)
def ndjson(spark, d):
    path = shared_dir(spark, "json")
    rows = table(spark, d, "orders").selectExpr("o_custkey AS bank", "DATE(o_orderdate) AS payment_date", "o_totalprice AS dividend_per_share")
    out.write_json(rows, path)
    return files.read_ndjson(spark, path, "bank bigint, payment_date date, dividend_per_share double")


@workload(
    "json_array",
    "S06 S05",
    "SELECT p_partkey AS portfolioid, p_name AS title, CAST(p_size AS BIGINT) AS size FROM part",
)
def json_array(spark, d):
    path = shared_dir(spark, "json-array")
    # arrays of objects spelled in mixed case, one per line
    landed = table(spark, d, "part").selectExpr(
        "to_json(array(named_struct('PortfolioId', p_partkey, 'Title', p_name, 'SIZE', p_size))) AS value"
    )
    landed.write.text(path)
    # a line that holds an array gives one row per element
    return files.read_ndjson(spark, path, "PortfolioId bigint, Title string, SIZE bigint").toDF("portfolioid", "title", "size")


@workload(
    "json_array_files",
    "S06 U03",
    "SELECT p_partkey AS portfolioid, p_name || ' \"q\" \\' AS title, CAST(p_size AS BIGINT) AS size FROM part",
)
def json_array_files(spark, d):
    path = shared_dir(spark, "json-array")
    # each file holds parts of one size as an array, whose objects spell the keys in three ways
    named = table(spark, d, "part").withColumn("title", F.concat("p_name", F.lit(' "q" \\')))
    spelled = [("PortfolioId", "Title", "size"), ("PORTFOLIOID", "title", "SIZE"), ("portfolioid", "TITLE", "Size")]
    objects = [F.to_json(F.struct(F.col("p_partkey").alias(k), F.col("title").alias(t), F.col("p_size").alias(z))) for k, t, z in spelled]
    one = F.element_at(F.array(*objects), (F.col("p_partkey") % 3 + 1).cast("int"))
    # arrays of some hundred objects, however many parts there are: a file for each size and bucket
    buckets = named.count() // 10_000 + 1
    arrays = named.groupBy("p_size", F.pmod(F.xxhash64("p_partkey"), F.lit(buckets)).alias("bucket"))
    landed = arrays.agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ",\n"), F.lit("]")).alias("value"))
    landed.write.partitionBy("p_size", "bucket").text(path)
    return files.read_json_array(spark, path, "PortfolioId bigint, title string, size bigint")


# Braces, brackets, quotes and backslashes that do not end a record.
BRACED = ' }, {"[ \\" ]} '
BRACED_SQL = "' }, {\"[ \\\" ]} '"


@workload(
    "json_array_splits",
    "S06 U03",
    f"SELECT doc_id, text || {BRACED_SQL} AS text, lang, coalesce(n_chars, 0) % 7 AS size FROM documents",
)
def json_array_splits(spark, d):
    path = shared_dir(spark, "json-array")
    docs = table(spark, d, "documents").select("doc_id", F.concat("text", F.lit(BRACED)).alias("Text"), F.col("lang").alias("LANG"), "n_chars")
    nested = docs.withColumn("extra", F.struct(F.array(F.struct(F.col("doc_id").alias("a"))).alias("b")))
    # one array per file of some 100,000 documents, written object by object and read in as many splits as it has
    bucketed = nested.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(docs.count() // 100_000 + 1)))
    order = Window.partitionBy("bucket").orderBy("doc_id")
    value = F.to_json(F.struct("doc_id", "Text", "extra", "LANG", (F.coalesce("n_chars", F.lit(0)) % 7).alias("size")))
    start = F.when(F.row_number().over(order) == 1, "[").otherwise(",")
    end = F.when(F.lead(F.lit(1)).over(order).isNull(), "]").otherwise("")
    bucketed.select("bucket", F.concat(start, value, end).alias("value")).write.partitionBy("bucket").text(path)
    return json_arrays.read_json_arrays(spark, path, "doc_id bigint, text string, lang string, size bigint")


@workload(
    "nested_json",
    "S07 F22",
    "SELECT user_id AS point, value AS rate FROM events",
)
def nested_json(spark, d):
    path = shared_dir(spark, "nested")
    rows = table(spark, d, "events").selectExpr("array(named_struct('point', user_id, 'rate', value)) AS historicalPoints")
    out.write_json(rows, path)
    ddl = "historicalPoints array<struct<point:bigint,rate:double>>"
    return files.read_nested_json(spark, path, ddl, "historicalPoints", per_line=True)


@workload("by_extension", "S09 S04", "SELECT s_suppkey, s_name, s_name || ', \"y\" \\' AS named FROM supplier")
def by_extension(spark, d):
    path = shared_dir(spark, "ext") + ".csv"
    out.write_csv(table(spark, d, "supplier").select(F.concat("s_name", F.lit(', "y" \\')).alias("named"), "s_suppkey"), path)
    left = files.read_by_extension(spark, path, "s_suppkey bigint, named string")
    right = files.read_by_extension(spark, f"{d}/supplier.parquet").select("s_suppkey", "s_name")
    return left.join(right, "s_suppkey")


@workload(
    "table_read",
    "S08 S13 K03",
    f"SELECT account_id, status FROM {ACCOUNT.sql} WHERE segment = 'MACHINERY'",
)
def table_read(spark, d):
    name, path = _place(spark, "table")
    sink.overwrite_table(ACCOUNT.df(spark, d).limit(0), name, path)
    sink.overwrite_table(ACCOUNT.df(spark, d), name, path)
    return tables.read_filtered(spark, name, ["account_id", "status"], F.col("segment") == "MACHINERY")


@workload(
    "table_refresh",
    "K01 K11 E21 S08",
    "SELECT 'Z' || o_custkey AS pickup_zip, count(*) AS trip_count, 2.0::DOUBLE AS avg_fare FROM orders GROUP BY 1",
)
def table_refresh(spark, d):
    name, path = _place(spark, "table")
    sink.provision_table(spark, catalog.TRIP_METRICS, name, path)
    rows = table(spark, d, "orders").groupBy(F.concat(F.lit("Z"), "o_custkey").alias("pickup_zip")).agg(
        F.count(F.lit(1)).cast("int").alias("trip_count"), F.lit(2.0).alias("avg_fare")
    )
    sink.refresh_table(rows.withColumn("pickup_zip", F.lit("old")), name)
    written = sink.refresh_table(rows, name)
    read = tables.read_table(spark, name)
    return read.where(F.lit(written > 0))


@workload("table_replace", "K02", "SELECT p_partkey AS k, p_name AS n FROM part")
def table_replace(spark, d):
    name, path = _place(spark, "table")
    sink.overwrite_table(table(spark, d, "supplier").select("s_suppkey"), name, path + "-a")
    sink.replace_table(table(spark, d, "part").selectExpr("p_partkey AS k", "p_name AS n"), name, path + "-b")
    return spark.table(name)


@workload(
    "table_replace_itself",
    "K01 K02 K03",
    "SELECT o_orderkey, CAST(o_totalprice * 2 AS DOUBLE) AS price, 'x' AS added FROM orders WHERE o_orderstatus = 'O'",
)
def table_replace_itself(spark, d):
    """A table is refreshed and then given new columns from its own rows; both are read only before it moves."""
    name, path = _place(spark, "table")
    sink.overwrite_table(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price")), name, path)
    own = spark.table(name)
    sink.refresh_table(own.where("o_orderstatus = 'O'").withColumn("price", F.col("price") * 2), name)
    sink.replace_table(spark.table(name).select("o_orderkey", "price", F.lit("x").alias("added")), name)
    return spark.table(name)


@workload(
    "table_append",
    "K04",
    "SELECT s_suppkey AS k, 2 * (SELECT count(*) FROM supplier) AS written FROM supplier UNION ALL SELECT s_suppkey, 2 * (SELECT count(*) FROM supplier) FROM supplier",
)
def table_append(spark, d):
    name, path = _place(spark, "table")
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    written = sink.append_table(rows, name, path) + sink.append_table(rows, name)
    return spark.table(name).withColumn("written", F.lit(written))


@workload(
    "scorecard_procedure",
    "D04 K04 E04",
    f"""SELECT rep_id, territory_id, count(*) AS activity_count, {half_up('sum(estimated_cost_usd)', 'count(*)', 2)} AS avg_cost
        FROM {ACTIVITY.sql} GROUP BY 1, 2""",
)
def scorecard_procedure(spark, d):
    source, source_path = _place(spark, "activity")
    target, target_path = _place(spark, "scorecard")
    sink.overwrite_table(ACTIVITY.df(spark, d), source, source_path)
    sink.provision_table(spark, catalog.REP_TERRITORY_SCORECARD, target, target_path)
    crm.build_scorecard(spark, source, target)
    return spark.table(target).selectExpr("rep_id", "territory_id", "activity_count", "avg_cost_per_activity_usd AS avg_cost")


@workload(
    "crm_load",
    "E21 S01 K01",
    f"""SELECT 'account' AS model, account_id AS id, account_id, status AS text, npi AS number FROM {ACCOUNT.sql}
        UNION ALL SELECT 'activity', activity_id, account_id, channel, engagement_score FROM {ACTIVITY.sql}""",
)
def crm_load(spark, d):
    base = shared_dir(spark, "crm")
    out.write_csv(ACCOUNT.df(spark, d), f"{base}/account")
    out.write_csv(ACTIVITY.df(spark, d), f"{base}/activity")
    accounts, account_path = _place(spark, "account")
    activities, activity_path = _place(spark, "activity")
    sink.provision_table(spark, catalog.ACCOUNT, accounts, account_path)
    sink.provision_table(spark, catalog.ACTIVITY, activities, activity_path)
    crm.load_crm(spark, f"{base}/account", f"{base}/activity", accounts, activities)
    number = F.col("npi").cast("bigint").alias("number")
    loaded = spark.table(accounts).select(F.lit("account").alias("model"), F.col("account_id").alias("id"), "account_id", F.col("status").alias("text"), number)
    score = F.col("engagement_score").cast("bigint").alias("number")
    done = spark.table(activities).select(F.lit("activity").alias("model"), F.col("activity_id").alias("id"), "account_id", F.col("channel").alias("text"), score)
    return loaded.unionByName(done)


@workload(
    "history_append",
    "K05 S04",
    "SELECT event_id, user_id FROM events",
)
def history_append(spark, d):
    path = shared_dir(spark, "history")
    rows = table(spark, d, "events")
    for kind in (F.col("event_type") == "click", F.col("event_type") != "click"):
        out.append_history(rows.where(kind).select("event_id", "user_id"), path)
    return files.read_parquet(spark, path)


DOCUMENTS_JSON_SQL = """SELECT doc_id, len(regexp_extract_all(text, '(?s).{{1,512}}')) AS chunks, left(text, 512) AS first_chunk, md5(text) AS all_chunks
        FROM {}"""


def _chunk_structs():
    return F.transform(stride_chunks(F.col("text")), lambda c: F.struct(c.alias("page_content")))


def _chunk_contents(chunks):
    """Their number, the first, and a digest of all of them in order, which together are the text."""
    contents = F.transform(chunks, lambda c: c["page_content"])
    return [F.size(chunks).alias("chunks"), F.get(contents, F.lit(0)).alias("first_chunk"), F.md5(F.array_join(contents, "")).alias("all_chunks")]


@workload("documents_json", "K09 T05", DOCUMENTS_JSON_SQL.format("documents"))
def documents_json(spark, d):
    path = shared_dir(spark, "documents")
    out.write_documents_json(table(spark, d, "documents"), "doc_id", _chunk_structs(), path)
    read = files.read_ndjson(spark, path, "doc_id bigint, chunks array<struct<page_content:string>>")
    return read.select("doc_id", *_chunk_contents(F.col("chunks")))


@workload(
    "documents_json_folders",
    "K09",
    DOCUMENTS_JSON_SQL.format("(SELECT item_id AS doc_id, text FROM benchmark)"),
)
def documents_json_folders(spark, d):
    path = shared_dir(spark, "documents")
    rows = table(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id")
    out.write_documents_json(rows, "doc_id", _chunk_structs(), path, folders=True)
    read = spark.read.text(path).withColumn("items", F.from_json("value", "array<struct<page_content:string>>"))
    return read.select("doc_id", *_chunk_contents(F.col("items")))


@workload(
    "upsert_by_id",
    "K12 E17",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE o_orderstatus END AS status FROM orders
        UNION ALL SELECT -1 - o_orderkey, 'added' FROM orders WHERE o_orderstatus = 'F'""",
)
def upsert_by_id(spark, d):
    name, path = _place(spark, "upsert")
    rows = table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status", "1 AS version")
    sink.upsert_by_id(rows, name, ["id"], ["version"], path)
    filled = rows.where("status = 'F'")
    updates = (
        filled.withColumns({"status": F.lit("new"), "version": F.lit(3)})
        .unionByName(filled.withColumns({"status": F.lit("late"), "version": F.lit(2)}))
        .unionByName(filled.withColumns({"id": -1 - F.col("id"), "status": F.lit("added"), "version": F.lit(1)}))
    )
    sink.upsert_by_id(updates, name, ["id"], ["version"], path)
    sink.upsert_by_id(updates, name, ["id"], ["version"], path)
    return spark.table(name).drop("version")


@workload(
    "upsert_few_ids",
    "K12",
    """SELECT o_orderkey AS id, CASE WHEN o_custkey = (SELECT min(o_custkey) FROM orders) THEN 'moved' ELSE o_orderstatus END AS status,
        true AS few_rewritten FROM orders""",
)
def upsert_few_ids(spark, d):
    """The orders of one customer: only the files of the buckets that hold them are replaced."""
    name, path = _place(spark, "upsert")
    rows = table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status", "o_custkey")
    total = sink.upsert_by_id(rows, name, ["id"], (), path, buckets=128)
    before = {r["path"] for r in files.file_listing(spark, path).select("path").collect()}
    first = rows.agg(F.min("o_custkey")).scalar()
    written = sink.upsert_by_id(rows.where(F.col("o_custkey") == first).withColumn("status", F.lit("moved")), name, ["id"])
    listed = {r["path"] for r in files.file_listing(spark, path).select("path").collect()}
    few = 2 * written < total and 2 * len(before & listed) > len(listed)
    return spark.table(name).select("id", "status", F.lit(few).alias("few_rewritten"))


@workload(
    "issue_index",
    "E17 K12 T03",
    "SELECT count(*) AS issues, count(*) AS stable FROM conversations",
)
def issue_index(spark, d):
    """Indexing the same issues twice leaves one row per chunk."""
    name, path = _place(spark, "index")
    chunks = products.issue_chunks(issues(spark, d), F.array("blob"))
    sink.upsert_by_id(chunks, name, ["langchain_id"], (), path)
    sink.upsert_by_id(chunks, name, ["langchain_id"], (), path)
    return spark.table(name).agg(F.count(F.lit(1)).alias("issues"), F.count_distinct("langchain_id").alias("stable"))


@workload(
    "conform_then_write",
    "K13",
    f"SELECT event_id, {stamp('ts')} AS ts, CAST(floor(value) AS BIGINT) AS value FROM events",
)
def conform_then_write(spark, d):
    path = shared_dir(spark, "conformed")
    zoned = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.floor("value").alias("value"))
    plain = cast_columns(zoned)
    assert isinstance(plain.schema["ts"].dataType, T.TimestampNTZType)
    out.write_parquet(cast_columns(plain, {"event_id": "bigint", "ts": "timestamp_ntz", "value": "int"}), path)
    return files.read_parquet(spark, path)


@workload(
    "publish_after_checks",
    "K14 Q26 Q01",
    "SELECT s_suppkey, true AS blocked FROM supplier",
)
def publish_after_checks(spark, d):
    """Good rows are published; a later batch without rows is blocked and changes nothing."""
    name, path = _place(spark, "published")
    rows = table(spark, d, "supplier").select("s_suppkey")

    contract = checks.Contract("supplier", [checks.is_null("s_suppkey", checks.FAILED), checks.has_rows()])
    publish_if_pass(rows, contract, name, ("non_empty",), path)
    try:
        publish_if_pass(rows.where("s_suppkey < 0"), contract, name, ("non_empty",))
        blocked = False
    except PublicationBlocked:
        blocked = True
    return spark.table(name).withColumn("blocked", F.lit(blocked))


@workload(
    "masked_view",
    "K15",
    "SELECT CASE WHEN c_custkey % 4 = 0 THEN '*****' ELSE c_name END AS c_name, c_custkey FROM customer",
)
def masked_view(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return mask_column(rows, "c_name", F.col("c_custkey") % 4 == 0)


@workload(
    "inline_rows",
    "S10",
    """SELECT l_returnflag, meaning, count(*) AS n FROM lineitem JOIN (VALUES ('A', 'accepted'), ('R', 'returned')) v(f, meaning)
        ON l_returnflag = f GROUP BY 1, 2""",
)
def inline_rows(spark, d):
    labels = tables.inline_rows(
        spark, [("A", "accepted"), ("R", "returned")], "l_returnflag string not null, meaning string not null"
    )
    per_flag = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return per_flag.join(labels, "l_returnflag")


@workload("slice_copy", "E10 N09 K03", C_DEPOSITS_SQL)
def slice_copy(spark, d):
    """A bank with rows is copied; a bank without rows leaves the target as it is."""
    name, path = _place(spark, "slice")
    deposits = rates.conform(rates.bank_c_term_deposits(FLAT_DEPOSITS.df(spark, d)), catalog.TERM_DEPOSITS)
    sink.copy_if_any(rates.bank_slice(deposits, "Westpac", catalog.TERM_DEPOSITS), name, path)
    sink.copy_if_any(rates.bank_slice(deposits, "Nobody", catalog.TERM_DEPOSITS), name, path)
    return spark.table(name)


@workload(
    "json_contract",
    "Q04 S05",
    """SELECT 'json_non_empty' AS check, 'events' AS model, 'PASS' AS status, 1 AS total, 0 AS bad, 0.0::DOUBLE AS bad_pct FROM (SELECT 1 FROM events LIMIT 1)
        UNION ALL SELECT 'json_non_empty', 'none', 'WARNING', 0, 0, 0.0 UNION ALL SELECT 'json_non_empty', 'absent', 'FAILED', 0, 0, 0.0""",
)
def json_contract(spark, d):
    path = shared_dir(spark, "json")
    rows = table(spark, d, "events").select("event_id", "event_type")
    out.write_json(rows, f"{path}/full")
    out.write_json(rows.where("event_id < 0"), f"{path}/none")
    return checks.all_checks(
        [
            checks.check_json_nonempty(spark, f"{path}/full", "events"),
            checks.check_json_nonempty(spark, f"{path}/none", "none"),
            checks.check_json_nonempty(spark, f"{path}/absent", "absent"),
        ]
    )


@workload(
    "data_product_run",
    "D05 K11 K14 Q25 Q26",
    f"""SELECT channel, count(*) AS activity_count, 'PASS' AS verified FROM {ACTIVITY.sql} GROUP BY channel""",
)
def data_product_run(spark, d):
    name, path = _place(spark, "product")
    product = DataProduct(
        model=catalog.CHANNEL_EFFECTIVENESS,
        table=name,
        transform=crm.channel_effectiveness,
        rules=(checks.is_null("channel", checks.FAILED),),
        location=path,
    )
    product.provision(spark)
    product.run(ACTIVITY.df(spark, d))
    verdict = product.verify(spark).agg(F.max("status")).scalar()
    return spark.table(name).select("channel", "activity_count").withColumn("verified", verdict)
