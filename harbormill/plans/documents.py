"""Document products: announcements, disclosures, issue chunks and the shop catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.functions.nested import pluck
from harbormill.functions.temporal import day_first_date
from harbormill.functions.text import path_join, strip
from harbormill.models import catalog
from harbormill.operators.columns import conform
from harbormill.operators.documents import (
    CHUNK_TOKENS,
    bounded_chunks,
    chunk_id,
    document_table,
    explode_chunks,
    recursive_chunks,
    rich_blob,
    token_chunks,
)
from harbormill.operators.html import listing_cards, product_details, with_details
from harbormill.operators.joins import not_yet_done
from harbormill.operators.windows import first_seen

# Fixed value: the shape of one landed announcement.
ANNOUNCEMENT_JSON = (
    "announcementTypes array<string>, companies array<struct<symbolDisplay:string>>, "
    "companyInfo array<struct<symbol:string,xid:string,ASXSecurityType:int,displayName:string,issueType:string,"
    "issueTypeName:string,issueTypeCode:int,isin:string,xidEntity:int,sector:string,industryGroup:string,"
    "industry:string,subIndustry:string>>, date timestamp, documentKey string, fileSize string, headline string, "
    "isPriceSensitive boolean, symbol string, symbolsSecondary array<string>, url string"
)


def companies(directory: DataFrame) -> DataFrame:
    """Company directory with its original headers to the model's names."""
    return directory.select(
        F.col("`ASX code`").alias("asx_code"),
        F.col("`Company name`").alias("company_name"),
        F.col("`GICs industry group`").alias("gics_industry_group"),
        day_first_date(F.col("`Listing date`")).alias("listing_date"),
        F.col("`Market Cap`").alias("market_cap"),
    )


def parse_announcements(landed: DataFrame, body: str = "value") -> DataFrame:
    """Landed JSON texts, one announcement each, to snake_case columns."""
    # an array of one, exploded: merged projections would parse a text again for each column that is read
    parsed = landed.select(F.explode(F.array(F.from_json(body, ANNOUNCEMENT_JSON))).alias("a"))
    return parsed.select(
        F.col("a.announcementTypes").alias("annoucement_types"),
        pluck(F.col("a.companies"), "symbolDisplay").alias("companies"),
        F.col("a.companyInfo").alias("company_info"),
        F.col("a.date").alias("date"),
        F.col("a.documentKey").alias("document_key"),
        F.col("a.fileSize").alias("file_size"),
        F.col("a.headline").alias("headline"),
        F.col("a.isPriceSensitive").alias("is_price_sensitive"),
        F.col("a.symbol").alias("symbol"),
        F.col("a.symbolsSecondary").alias("symbols_secondary"),
        F.col("a.url").alias("url"),
    )


def announcements(parsed: DataFrame, root: str) -> DataFrame:
    """Announcement rows with the relative and full path of their file."""
    path = path_join("file", F.col("symbol"), F.col("document_key"))
    located = parsed.withColumn("path", path).withColumn("full_path", path_join(root, F.col("path")))
    return located.select("path", "full_path", *parsed.columns)


def files_to_fetch(listed: DataFrame, present: DataFrame) -> DataFrame:
    """Paths that are named but not yet stored."""
    named = listed.where(F.col("path").isNotNull() & F.col("document_key").isNotNull())
    return not_yet_done(named.select("path", "document_key"), present, ["path"])


def announcement_chunks(texts: DataFrame, budget: int = CHUNK_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """Announcement texts (path, contents and metadata) to chunks of at most ``budget`` ids of a tokenizer file, or of words without one."""
    meta = F.to_json(F.struct("path", "symbol", "headline", F.col("document_key").alias("source")))
    described = texts.withColumn("metadata", meta)
    if tokenizer:
        chunks = bounded_chunks(described, "contents", tokenizer, budget, "page_content")
    else:
        chunks = explode_chunks(described, token_chunks(F.col("contents"), budget), "page_content")
    return conform(chunks.withColumn("type", F.lit("Document")), catalog.DOCUMENTS)


def disclosures(landed: DataFrame, processed_at: Column) -> DataFrame:
    return document_table(landed, processed_at)


def issue_text(issues: DataFrame) -> DataFrame:
    """Issues with one ``blob`` of all their text; ``comments`` is an array of bodies."""
    return issues.withColumn("blob", rich_blob(F.struct("summary", "description", "comments")))


def issue_chunks(issues: DataFrame, chunks: Column | None = None) -> DataFrame:
    """Vector-table rows without their embedding; issues without text give none."""
    meta = F.to_json(
        F.struct(F.col("id").alias("issue_id"), "key", "project", "status", "created", "updated"),
        {"ignoreNullFields": "false"},
    )
    # blank texts go with their empty array: a filter on the text would be pushed below it and read it twice
    with_text = issue_text(issues).withColumn("langchain_metadata", meta)
    split = chunks if chunks is not None else recursive_chunks()(F.col("blob"))
    split = F.when(strip(F.col("blob")) != "", split)
    reference = F.coalesce("key", "id", F.lit("unknown"))
    return explode_chunks(with_text, split).select(
        chunk_id(reference, F.col("chunk")).alias("langchain_id"), "content", "langchain_metadata"
    )


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def shop_catalog(
    listing_pages: DataFrame, detail_pages: DataFrame, categories: Sequence[str], scraped_at: Column
) -> DataFrame:
    """Products of all listing pages (category, page, html), first sighting kept, with details."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    order = F.when(place > 0, place).otherwise(len(categories) + 1)  # a category that is not listed comes last
    stubs = first_seen(listing_cards(listing_pages), "product_id", [order, F.col("page"), F.col("position")])
    full = with_details(stubs, product_details(detail_pages))
    return conform(
        full.withColumn("category", capitalized(F.col("category"))).withColumn("scraped_at", scraped_at),
        catalog.CATALOG_PRODUCTS,
    )
