"""Text, HTML, vector and document products."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from harbormill.functions.ids import uuid5
from harbormill.functions.nested import pluck
from harbormill.functions.text import last_segment
from harbormill.lookups import queries as lookups
from harbormill.operators import documents as docs
from harbormill.operators import html, vectorsearch
from harbormill.plans import documents as products
from harbormill.plans import weather
from workloads.inputs import StandIn, text
from workloads.registry import stamp, table, workload

LOADED_AT = dt.datetime(2024, 2, 1, 12, 0, 0)
LOADED_TEXT = "2024-02-01 12:00:00.000000"


def _sql_uuid5(name: str, namespace: uuid.UUID) -> str:
    blob = "".join(f"\\x{b:02X}" for b in namespace.bytes)
    h = f"sha1('{blob}'::BLOB || encode({name}))"
    nibble = f"substr('89ab', 1 + (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4, 1)"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {nibble} || "
        f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )


# --- chunks -------------------------------------------------------------------


@workload(
    "chunks_fixed",
    "T03 T05 W06 F23",
    """SELECT doc_id, CAST(i - 1 AS BIGINT) AS chunk, parts[i] AS content FROM (
        SELECT doc_id, regexp_extract_all(text, '(?s).{1,512}') AS parts FROM documents),
        LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)""",
)
def chunks_fixed(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    return docs.explode_chunks(rows, docs.stride_chunks(F.col("text"))).drop("text")


@workload(
    "chunks_tokens",
    "T04 W06",
    r"""SELECT doc_id, CAST(i AS BIGINT) AS chunk, array_to_string(list_slice(words, i * 256 + 1, (i + 1) * 256), ' ') AS content
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words FROM documents),
        LATERAL (SELECT unnest(range(0, (len(words) + 255) // 256)) AS i)""",
)
def chunks_tokens(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    return docs.explode_chunks(rows, docs.token_chunks(F.col("text"), 256)).drop("text")


@workload(
    "chunks_bounded",
    "T04 W06 T05",
    """SELECT doc_id, length(text) AS chars, md5(text) AS text_md5, true AS in_budget, true AS contiguous, length(text) <= 300 AS single
        FROM documents WHERE length(text) > 0""",
)
def chunks_bounded(spark, d):
    """Chunks of at most 300 ids of a byte-level tokenizer, put together again; SQL sees the texts only."""
    import public_tokenizers

    rows = table(spark, d, "documents").select("doc_id", "text")
    chunks = docs.bounded_chunks(rows, "text", public_tokenizers.path("byte_bpe_50k.json"), 300)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "content"))), lambda c: c["content"]), "")
    return chunks.groupBy("doc_id").agg(
        F.max("end").alias("chars"),
        F.md5(joined).alias("text_md5"),
        F.every(F.col("tokens").between(1, 300)).alias("in_budget"),
        (F.sum(F.col("end") - F.col("start")) == F.max("end")).alias("contiguous"),
        # a text of up to 300 characters may have fewer ids, but never needs two chunks here
        ((F.max("end") <= 300) & (F.max("chunk") == 0)).alias("single"),
    )


@workload(
    "chunks_recursive",
    "T03 E17",
    r"""SELECT doc_id, regexp_replace(text, '\s', '', 'g') AS letters, true AS small, true AS in_order FROM documents WHERE trim(text, E' \n\t\r') <> ''""",
)
def chunks_recursive(spark, d):
    """The default splitter: what it must hold whatever the text. Without overlap the chunks give back all but blanks."""
    rows = table(spark, d, "documents").select("doc_id", "text").where(F.col("text") != "")
    split = rows.select(
        "doc_id", "text", docs.recursive_chunks()(F.col("text")).alias("chunks"), docs.recursive_chunks(overlap=0)(F.col("text")).alias("apart")
    ).where(F.size("chunks") > 0)
    # every chunk is a part of the text and starts behind the start of the one before
    start = F.struct(F.lit(0).alias("at"), F.lit(True).alias("ok"))

    def follow(acc, chunk):
        at = F.call_function("locate", chunk, F.col("text"), acc["at"] + 1)
        return F.struct(at.alias("at"), (acc["ok"] & (at > acc["at"])).alias("ok"))

    return split.select(
        "doc_id",
        F.regexp_replace(F.array_join("apart", ""), r"\s", "").alias("letters"),
        F.forall("chunks", lambda c: (F.length(c) <= 512) & (F.length(c) > 0)).alias("small"),
        F.aggregate("chunks", start, follow, lambda acc: acc["ok"]).alias("in_order"),
    )


# issues: one per conversation turn, the text inside a rich-text tree
SUMMARY = "CASE WHEN turn % 5 = 4 THEN '' ELSE role || ' turn ' || CAST(turn AS STRING) END"
ISSUE = StandIn(
    "conversations",
    {
        "id": text("conv_id * 1000 + turn"),
        "key": f"CASE WHEN turn = 7 THEN NULL ELSE 'CONV-' || {text('conv_id')} || '-' || {text('turn')} END",
        "project": "'CONV'",
        "status": "role",
        "summary": SUMMARY,
        "text": "text",
        "created": "'2024-01-01'",
        "updated": f"'2024-01-' || {text('10 + turn')}",
    },
)


def issues(spark, d):
    rows = ISSUE.df(spark, d)
    leaf = F.struct(F.lit("text").alias("type"), F.col("text"))
    paragraph = F.struct(F.lit("paragraph").alias("type"), F.array(leaf).alias("content"))
    tree = F.to_json(F.struct(F.lit("doc").alias("type"), F.array(paragraph, paragraph).alias("content")))
    return rows.withColumns({"description": tree, "comments": F.array(F.lit(""), F.col("status"))}).drop("text")


BLOB = "array_to_string(list_filter([summary, text || chr(10) || text, status], lambda p: p <> ''), chr(10) || chr(10))"


@workload("issue_blobs", "T01 T02 E17", f"SELECT id, key, {BLOB} AS blob FROM {ISSUE.sql}")
def issue_blobs(spark, d):
    return products.issue_text(issues(spark, d)).select("id", "key", "blob")


# the recursive splitter has no SQL form; tests compare it with brute force
@workload("issue_chunks", "E17 T01 T02 T03 T05 F29 F30 W06")
def issue_chunks(spark, d):
    return products.issue_chunks(issues(spark, d))


@workload(
    "issue_stride_chunks",
    "E17 T02 T03 T05 F29 F30 W06",
    f"""SELECT {_sql_uuid5("'jira:' || coalesce(key, id) || ':' || (i - 1)", uuid.NAMESPACE_URL)} AS langchain_id, parts[i] AS content,
        '{{"issue_id":"' || id || '","key":' || coalesce('"' || key || '"', 'null') || ',"project":"CONV","status":"' || status ||
        '","created":"2024-01-01","updated":"' || updated || '"}}' AS langchain_metadata
        FROM (SELECT *, regexp_extract_all({BLOB}, '(?s).{{1,512}}') AS parts FROM {ISSUE.sql}),
        LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)""",
)
def issue_stride_chunks(spark, d):
    return products.issue_chunks(issues(spark, d), docs.stride_chunks(F.col("blob")))


# --- vectors ------------------------------------------------------------------


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.col("vec_id").cast("string").alias("langchain_id"),
        F.concat(F.lit("chunk "), "vec_id").alias("content"),
        "embedding",
        F.concat(F.lit("n"), "label").alias("namespace"),
        F.to_json(
            F.struct(
                F.concat(F.lit("K-"), "vec_id").alias("key"),
                F.concat(F.lit("s"), "label").alias("status"),
                F.lit("2024-01-01").alias("updated"),
            )
        ).alias("langchain_metadata"),
    )


def _query(spark, d):
    """The query vector stays a plan; it becomes a subquery of the search."""
    return table(spark, d, "embeddings").where("vec_id = 0").select("embedding")


SCORE = (
    "list_cosine_similarity(CAST(embedding AS DOUBLE[]), "
    "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0))"
)


@workload(
    "cosine_topk",
    "T07 R11 O05 F29",
    f"""SELECT 'chunk ' || vec_id AS content, 'K-' || vec_id AS issue_key, 's' || label AS status, '2024-01-01' AS updated,
        round(s, 4) AS score FROM (SELECT *, {SCORE} AS s FROM embeddings) ORDER BY s DESC, CAST(vec_id AS VARCHAR) LIMIT 100""",
)
def cosine_topk(spark, d):
    return lookups.search_issues(_vectors(spark, d), _query(spark, d), 100)


@workload(
    "cosine_topk_many",
    "T07 T08 R11 O05",
    """SELECT query_id, vec_id, rank, round(s, 4) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (
            SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS s
            FROM embeddings v, embeddings q WHERE q.label = 3)) WHERE rank <= 10""",
)
def cosine_topk_many(spark, d):
    """All vectors of a label ask at once, in blocks."""
    rows = table(spark, d, "embeddings")
    queries = rows.where("label = 3").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectorsearch.top_k_many(rows, queries, 10, "vec_id", "query_id", block_rows=200, query_rows=7)


@workload(
    "namespace_retrieval",
    "T08 O05",
    f"""SELECT vec_id, round(s, 4) AS score FROM (SELECT *, {SCORE} AS s FROM embeddings WHERE label = 3)
        ORDER BY s DESC, vec_id LIMIT 40""",
)
def namespace_retrieval(spark, d):
    hits = vectorsearch.top_k_in_namespace(
        _vectors(spark, d), _query(spark, d), "n3", 40, ties=["vec_id"]
    )
    return hits.select("vec_id", "score")


@workload(
    "vector_widths",
    "T06 T07",
    "SELECT vec_id FROM embeddings WHERE len(embedding) <> CASE WHEN vec_id % 2 = 0 THEN 64 ELSE 384 END",
)
def vector_widths(spark, d):
    rows = table(spark, d, "embeddings")
    even = vectorsearch.wrong_width(rows.where("vec_id % 2 = 0"), 64)
    odd = vectorsearch.wrong_width(rows.where("vec_id % 2 = 1"), 384)
    return even.unionByName(odd).select("vec_id")


def _letter_model():
    """A stand-in model: counts of five letters."""
    return lambda texts: [[float(t.count(c)) for c in "aeiou"] for t in texts]


@workload(
    "attached_embeddings",
    "T06",
    """SELECT conv_id, turn, CAST(len(text) - len(replace(text, 'a', '')) AS BIGINT) AS a_count,
        CAST(len(text) - len(replace(text, 'u', '')) AS BIGINT) AS u_count FROM conversations""",
)
def attached_embeddings(spark, d):
    chunks = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("content"))
    vectors = vectorsearch.attach_embeddings(chunks, _letter_model)
    return vectors.select(
        "conv_id",
        "turn",
        F.col("embedding")[0].cast("bigint").alias("a_count"),
        F.col("embedding")[4].cast("bigint").alias("u_count"),
    )


# --- HTML ---------------------------------------------------------------------


@workload(
    "html_links",
    "T09 F31",
    r"""SELECT page_id, CAST(i - 1 AS BIGINT) AS position, regexp_extract(a[i], 'href="([^"]*)"', 1) AS href,
        trim(replace(replace(replace(replace(replace(replace(regexp_replace(a[i], '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'),
        '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS text
        FROM (SELECT page_id, regexp_extract_all(html, '(?s)<a href="[^"]*">.*?</a>') AS a FROM pages),
        LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)""",
)
def html_links(spark, d):
    # a third of the pages as they are, the others with their anchors spelled otherwise
    spelled = (
        F.when(F.col("page_id") % 3 == 0, F.col("html"))
        .when(F.col("page_id") % 3 == 1, F.replace("html", F.lit('<a href="'), F.lit('<A class="k"\n HREF = "')))
        .otherwise(F.replace("html", F.lit('<a href="'), F.lit('<a data-x=1 href="')))
    )
    return html.links(table(spark, d, "pages").select("page_id", spelled.alias("html")))


SHOP = "https://shop.example/product/"
CATEGORY = "CASE p_partkey % 3 WHEN 0 THEN 'apparel' WHEN 1 THEN 'consumables' ELSE 'household' END"
NAME = f"p_name || CASE p_partkey % 3 WHEN 0 THEN ' &amp; co ' WHEN 1 THEN ' &#38; co ' ELSE ' &#x26; co ' END || {text('p_partkey')}"
PRICE = f"CASE WHEN p_partkey % 13 = 0 THEN 'call us' ELSE {text('p_size')} || '.' || {text('10 + p_partkey % 90')} END"


# One thing spelled in several ways, as real pages do; the twin starts from the values and knows no markup.
CARD_TAG = (
    "CASE p_partkey % 3 WHEN 0 THEN 'div class=\"row product\"' WHEN 1 THEN 'DIV id=\"c\" class=\"featured  product row-x row\"' "
    "ELSE 'div data-n=\"1\" CLASS = \"product new row\"' END"
)
ANCHOR_TAG = "CASE p_partkey % 2 WHEN 0 THEN 'a href=' ELSE 'a class=\"t\" HREF = ' END"


def _card(key: str, name: str, price: str) -> str:
    return (
        f"'<' || {CARD_TAG} || '><div class=\"col-8 description\"><h3 class=\"mb-0\"><' || {ANCHOR_TAG} || '\"" + SHOP + "' || "
        f"{text(key)} || '\">' || {name} || '</a></h3></div><div class=\"col-2 price-wrap\"><div class=\"price\">' || "
        f"{price} || '</div></div></div>'"
    )


NEXT_CARD = _card("p_partkey + 1", "'seen early'", "'1.00'")
LISTINGS = StandIn(
    "part",
    {
        "category": CATEGORY,
        "page": "p_partkey",
        "html": f"'<html><body>' || {_card('p_partkey', NAME, PRICE)} || {NEXT_CARD} || "
        "'<div class=\"row product\"><b>no link</b></div></body></html>'",
    },
)
DETAILS = StandIn(
    "part",
    {
        "url": f"'{SHOP}' || {text('p_partkey')}",
        "html": "CASE WHEN p_partkey % 2 = 0 THEN '<h3>Product Description</h3>' ELSE '<H3 class=\"h\"><span>The <b>description</b></span></H3>' END || '<div><p class=\"x\">Made by ' || p_brand || '</p></div><table><tr><th>Size</th>"
        "<td>' || CAST(p_size AS STRING) || '</td></tr><tr>' || CASE WHEN p_partkey % 2 = 0 THEN '<td>Brand</td>' ELSE '<th><b>BRAND</b>:</th>' END || '<td> ' || p_brand || ' </td></tr></table><span>from $' || "
        f"{text('p_size')} || '.50</span>'",
    },
    "p_type <> 'STANDARD'",
)
CARDS_SQL = f"""SELECT page, 0 AS position, CAST(page AS VARCHAR) AS product_id, name, price_text, category FROM (
            SELECT p_partkey AS page, {CATEGORY} AS category, p_name || ' & co ' || p_partkey AS name, {PRICE} AS price_text FROM part)
        UNION ALL SELECT p_partkey, 1, CAST(p_partkey + 1 AS VARCHAR), 'seen early', '1.00', {CATEGORY} FROM part"""


@workload(
    "html_cards",
    "T09 F31",
    f"""SELECT category, page, position, product_id, name, '{SHOP}' || product_id AS product_url, price_text
        FROM ({CARDS_SQL})""",
)
def html_cards(spark, d):
    return html.listing_cards(LISTINGS.df(spark, d))


@workload(
    "html_details",
    "T10",
    f"""SELECT '{SHOP}' || p_partkey AS product_url, 'Made by ' || p_brand AS description, p_brand AS brand,
        p_size + 0.5::DOUBLE AS original_price FROM part WHERE p_type <> 'STANDARD'""",
)
def html_details(spark, d):
    return html.product_details(DETAILS.df(spark, d))


@workload(
    "shop_catalog",
    "E18 T09 T10 T12 W04 F18 F31 F32",
    f"""SELECT product_id, name, upper(category[1]) || category[2:] AS category, TRY_CAST(price_text AS DOUBLE) AS price,
        p_size + 0.5::DOUBLE AS original_price, coalesce('Made by ' || p_brand, '') AS description, coalesce(p_brand, '') AS brand,
        '{SHOP}' || product_id AS product_url, '{LOADED_TEXT}' AS scraped_at FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY category, page, position) AS rn FROM ({CARDS_SQL})) c
        LEFT JOIN (SELECT * FROM part WHERE p_type <> 'STANDARD') p ON c.product_id = CAST(p.p_partkey AS VARCHAR) WHERE rn = 1""",
)
def shop_catalog(spark, d):
    categories = ["apparel", "consumables", "household"]
    details = DETAILS.df(spark, d)
    landed_twice = details.unionByName(details.where("length(url) % 2 = 0"))
    return products.shop_catalog(LISTINGS.df(spark, d), landed_twice, categories, F.lit(LOADED_AT))


RATE_PAGES = StandIn(
    "customer",
    {
        "page": "c_custkey",
        "html": "'<table><tr><td>other</td></tr></table><table class=\"t\"><tr><th>Pay date</th><th>Rate (cents)</th></tr><tr><td>' || "
        f"{text('1 + c_custkey % 28')} || '/02/2024</td><td><b>' || {text('c_custkey % 90')} || '</b></td></tr><tr><td>final</td></tr></table>'",
    },
)


@workload(
    "html_tables",
    "T11",
    """SELECT c_custkey AS page, 1 AS position, (1 + c_custkey % 28) || '/02/2024' AS pay_date, CAST(c_custkey % 90 AS VARCHAR) AS rate,
        CAST(NULL AS VARCHAR) AS note FROM customer UNION ALL SELECT c_custkey, 2, 'final', NULL, NULL FROM customer""",
)
def html_tables(spark, d):
    columns = {"pay_date": "Pay date", "rate": "Rate (cents)", "note": "Remarks"}
    return html.table_records(RATE_PAGES.df(spark, d), columns, nth=1, skip_rows=1)


# --- document tables ----------------------------------------------------------

URL = "'https://files.example/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt/'"


@workload(
    "disclosures",
    "E19 T13 A17 F30 F31",
    f"""SELECT {_sql_uuid5(URL, uuid.UUID(int=0))} AS document_id, source AS company, doc_id || '.txt' AS filename, {URL} AS url,
        len(text) - len(replace(text, chr(12), '')) + 1 AS pages, 0 AS tables,
        len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) AS doc_elements, sha256(text) AS document_hash,
        length(text) AS size, text AS contents, '{LOADED_TEXT}' AS processed_at FROM documents""",
)
def disclosures(spark, d):
    landed = table(spark, d, "documents").select(
        F.col("source").alias("company"),
        F.concat(F.lit("https://files.example/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt/")).alias("url"),
        F.col("text").alias("contents"),
    )
    return products.disclosures(landed, F.lit(LOADED_AT))


# pages with form feeds and tables in them, told by the number of the document
PAGED = "text || repeat(chr(12) || 'page', CAST(doc_id % 4 AS INT)) || repeat(chr(10) || '| a | b |' || chr(10) || '| --- | :-: |' || chr(10) || '| 1 | 2 |', CAST(doc_id % 3 AS INT))"


@workload(
    "disclosures_paged",
    "E19 T13 A17",
    f"""SELECT doc_id || '.txt' AS filename, CAST(len(text) - len(replace(text, chr(12), '')) + doc_id % 4 + 1 AS BIGINT) AS pages, CAST(doc_id % 3 AS BIGINT) AS tables,
        CAST(len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) + 3 * (doc_id % 3)
            + CASE WHEN doc_id % 4 > 0 AND trim(string_split(text, chr(10))[-1]) = '' THEN 1 ELSE 0 END AS BIGINT) AS doc_elements,
        sha256({PAGED}) AS document_hash FROM documents""",
)
def disclosures_paged(spark, d):
    landed = table(spark, d, "documents").select(
        F.col("source").alias("company"),
        F.concat(F.lit("https://files.example/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt/")).alias("url"),
        F.expr(PAGED).alias("contents"),
    )
    return products.disclosures(landed, F.lit(LOADED_AT)).select("filename", "pages", "tables", "doc_elements", "document_hash")


@workload(
    "stable_ids",
    "F30",
    f"SELECT doc_id, {_sql_uuid5('text', uuid.NAMESPACE_URL)} AS id FROM documents",
)
def stable_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", uuid5(F.col("text"), uuid.NAMESPACE_URL).alias("id"))


@workload(
    "file_names",
    "F31 P18",
    """SELECT page_id, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS name, 'file/' || page_id || '/' || url AS path
        FROM pages""",
)
def file_names(spark, d):
    from harbormill.functions.text import path_join

    return table(spark, d, "pages").select(
        "page_id",
        last_segment(F.col("url")).alias("name"),
        path_join("file", F.col("page_id").cast("string"), F.col("url")).alias("path"),
    )


def landed_announcements(spark, d):
    """One landed JSON text per event, keys as the provider spells them."""
    return table(spark, d, "events").selectExpr(
        "to_json(named_struct('announcementTypes', array(event_type, 'x'), 'companies', array(named_struct('symbolDisplay', "
        "'U' || CAST(user_id AS STRING))), 'companyInfo', array(named_struct('symbol', 'U' || CAST(user_id AS STRING), 'xid', "
        "CAST(user_id AS STRING), 'ASXSecurityType', 1, 'displayName', event_type, 'issueTypeCode', 2)), 'date', CAST(ts AS STRING), 'documentKey', "
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'doc-' || CAST(event_id AS STRING) END, 'fileSize', '10KB', 'headline', "
        "'About ' || event_type, 'isPriceSensitive', event_id % 2 = 0, 'symbol', 'U' || CAST(user_id AS STRING), "
        "'symbolsSecondary', array('S'), 'url', 'https://a.example/' || CAST(event_id AS STRING))) AS value"
    )


ROOT = "https://store.example/docs"
DOC_KEY = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'doc-' || event_id END"


@workload(
    "announcements",
    "E16 N11 P18 P19 F28 S05",
    f"""SELECT 'file/U' || user_id || '/' || {DOC_KEY} AS path, '{ROOT}/file/U' || user_id || '/' || {DOC_KEY} AS full_path,
        '["' || event_type || '","x"]' AS annoucement_types, '["U' || user_id || '"]' AS companies, {stamp('ts')} AS date,
        {DOC_KEY} AS document_key, '10KB' AS file_size, 'About ' || event_type AS headline, event_id % 2 = 0 AS is_price_sensitive,
        'U' || user_id AS symbol, '["S"]' AS symbols_secondary, 'https://a.example/' || event_id AS url, event_type AS display_name
        FROM events""",
)
def announcements(spark, d):
    parsed = products.parse_announcements(landed_announcements(spark, d))
    out = products.announcements(parsed, ROOT)
    return out.withColumn("display_name", pluck(F.col("company_info"), "displayName")[0]).drop("company_info")


@workload(
    "files_to_fetch",
    "E16 J10",
    f"""SELECT 'file/U' || user_id || '/' || {DOC_KEY} AS path, {DOC_KEY} AS document_key FROM events
        WHERE event_id % 11 <> 0 AND event_type <> 'click'""",
)
def files_to_fetch(spark, d):
    listed = products.announcements(products.parse_announcements(landed_announcements(spark, d)), ROOT)
    present = table(spark, d, "events").where("event_type = 'click'").selectExpr(
        "'file/U' || CAST(user_id AS STRING) || '/doc-' || CAST(event_id AS STRING) AS path"
    )
    return products.files_to_fetch(listed, present)


@workload(
    "announcement_chunks",
    "T04 T05 F29",
    r"""SELECT 'Document' AS type, array_to_string(list_slice(words, i * 2048 + 1, (i + 1) * 2048), ' ') AS page_content,
        '{"path":"p/' || doc_id || '","symbol":"' || lang || '","headline":"' || source || '","source":"' || doc_id || '"}' AS metadata
        FROM (SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words FROM documents),
        LATERAL (SELECT unnest(range(0, (len(words) + 2047) // 2048)) AS i)""",
)
def announcement_chunks(spark, d):
    texts = table(spark, d, "documents").selectExpr(
        "'p/' || CAST(doc_id AS STRING) AS path",
        "lang AS symbol",
        "source AS headline",
        "CAST(doc_id AS STRING) AS document_key",
        "text AS contents",
    )
    return products.announcement_chunks(texts)


DIRECTORY = StandIn(
    "customer",
    {
        "ASX code": f"'C' || {text('c_custkey')}",
        "Company name": "c_name",
        "GICs industry group": "c_mktsegment",
        "Listing date": f"CASE WHEN c_custkey % 8 = 0 THEN 'unknown' ELSE {text('1 + c_custkey % 28')} || '/03/2001' END",
        "Market Cap": text("c_nationkey"),
    },
)


@workload(
    "companies",
    "E16 P19 F12",
    """SELECT 'C' || c_custkey AS asx_code, c_name AS company_name, c_mktsegment AS gics_industry_group,
        CASE WHEN c_custkey % 8 <> 0 THEN '2001-03-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS listing_date,
        CAST(c_nationkey AS VARCHAR) AS market_cap FROM customer""",
)
def companies(spark, d):
    return products.companies(DIRECTORY.df(spark, d))


# --- weather ------------------------------------------------------------------

FIRST = StandIn(
    "events",
    {
        "city": "event_type",
        "value": "'{\"latitude\": 1.0, \"current\": {\"time\": \"' || substr(CAST(ts AS STRING), 1, 19) || "
        "CASE WHEN event_id % 2 = 0 THEN '' ELSE '+02:00' END || '\", \"temperature_2m\": ' || CAST(user_id AS STRING) || "
        "'.5, \"relative_humidity_2m\": ' || CAST(event_id % 100 AS STRING) || ', \"wind_speed_10m\": 3.25}}'",
    },
)
SECOND = StandIn(
    "events",
    {
        "city": "event_type",
        "value": "'{\"current_condition\": [{\"temp_C\": \"' || CAST(user_id AS STRING) || '\", \"humidity\": \"' || "
        "CAST(event_id % 100 AS STRING) || '\", \"windspeedKmph\": \"7\"}]}'",
    },
)


@workload(
    "unified_weather",
    "E15 N10 U02 P03 P04 F15",
    f"""SELECT event_type AS city, {stamp("date_trunc('second', ts) - CASE WHEN event_id % 2 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 2 HOUR END")}
        AS timestamp, user_id + 0.5::DOUBLE AS temperature_c, event_id % 100 AS humidity_pct, 3.25::DOUBLE AS wind_speed_kmh,
        'open-meteo' AS provider, '{LOADED_TEXT}' AS process_timestamp FROM events
        UNION ALL SELECT event_type, '{LOADED_TEXT}', CAST(user_id AS DOUBLE), event_id % 100, 7.0::DOUBLE, 'wttr.in', '{LOADED_TEXT}'
        FROM events""",
)
def unified_weather(spark, d):
    at = F.lit(LOADED_AT).cast("timestamp")
    first = weather.first_provider(FIRST.df(spark, d))
    second = weather.second_provider(SECOND.df(spark, d), at)
    return weather.unified_weather(first, second, at)
