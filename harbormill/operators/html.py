"""Extraction from landed HTML.

Each operator scans a page once (``functions.markup``) in Arrow batches and reads what it needs off the page's elements.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.functions.markup import Page
from harbormill.functions.numeric import price_or_null
from harbormill.functions.text import last_segment
from harbormill.operators.columns import spread
from harbormill.operators.windows import latest_by

# Where the parts of a product card and of a product page are found.
CARD = "div.row.product"
CARD_ANCHOR = "h3 a"
CARD_PRICE = "div.price"
FROM_PRICE = re.compile(r"from\s+\$(\d+(?:\.\d{2})?)")


def from_pages(pages: DataFrame, html: str, fields: Mapping[str, str], read: Callable[[Page], Iterable[tuple]]) -> DataFrame:
    """The rows that ``read`` finds on each page, beside the page's other columns."""
    others = [f for f in pages.schema.fields if f.name != html and f.name not in fields]
    added = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    types = {"string": pa.string(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, found = [], []
            for n, text in enumerate(batch.column(html).to_pylist()):
                rows = list(read(Page(text)))
                found += rows
                place += [n] * len(rows)
            at = pa.array(place, pa.int32())
            columns = zip(*found, strict=True) if found else [()] * len(fields)
            arrays = [pa.array(list(c), types[kind]) for c, kind in zip(columns, fields.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name).take(at) for f in others], *arrays], [*[f.name for f in others], *fields])

    # a page takes longer to scan than to send, and small files hold many pages
    return spread(pages.select(html, *[f.name for f in others])).mapInArrow(run, T.StructType([*others, *added.fields]))


def _cards(page: Page) -> Iterator[tuple]:
    for n, card in enumerate(page.select(CARD)):
        anchor = next(page.select(CARD_ANCHOR, card), None)
        href = None if anchor is None else page.attribute(anchor, "href")
        if href is not None:
            price = next(page.select(CARD_PRICE, card), None)
            yield n, page.text(anchor), href, "" if price is None else page.text(price)


def listing_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per product card: id, name, url and price text; cards without a link are skipped."""
    found = from_pages(pages, html, {"position": "int", "name": "string", "product_url": "string", "price_text": "string"}, _cards)
    others = [c for c in pages.columns if c != html]
    return found.select(*others, "position", last_segment(F.col("product_url")).alias("product_id"), "name", "product_url", "price_text")


def _detail(page: Page) -> Iterator[tuple]:
    description, brand, price = "", "", None
    for i, name in enumerate(page.names):
        if name in ("h2", "h3", "h4") and "description" in page.text(i).lower():
            paragraph = next((j for j in range(i + 1, len(page.names)) if page.names[j] == "p"), None)
            description = "" if paragraph is None else page.text(paragraph)
            break
    for row in page.select("table tr"):
        cells = page.own(row, {"td", "th"})
        if len(cells) > 1 and page.text(cells[0]).lower().rstrip(": \t\n") == "brand":
            brand = page.text(cells[1])
            break
    for text in page.strings():
        found = FROM_PRICE.search(text)
        if found:
            price = found[1]
            break
    yield description, brand, price


def product_details(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Description, brand and original price of product pages; a page without them, or null, gives blanks and a null price."""
    landed = pages.select(F.col(url).alias("product_url"), F.col(html).alias("_page"))
    found = from_pages(landed, "_page", {"description": "string", "brand": "string", "original_price": "string"}, _detail)
    return found.withColumn("original_price", F.col("original_price").try_cast("decimal(8,2)"))


def with_details(stubs: DataFrame, details: DataFrame) -> DataFrame:
    """Listing rows with their details; a page that failed leaves blanks, not a gap.

    Of several detail rows of one address the greatest counts, so a page that landed twice multiplies nothing.
    """
    joined = stubs.join(latest_by(details, ["product_url"], []), "product_url", "left")
    return joined.withColumns(
        {
            "price": price_or_null(F.col("price_text")),
            "description": F.coalesce("description", F.lit("")),
            "brand": F.coalesce("brand", F.lit("")),
        }
    )


def _links(page: Page) -> Iterator[tuple]:
    for n, i in enumerate(page.select("a")):
        href = page.attribute(i, "href")
        if href is not None:
            yield n, href, page.text(i)


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link with its address and text; anchors without an address are left out."""
    return from_pages(pages, html, {"position": "int", "href": "string", "text": "string"}, _links)


def table_records(
    pages: DataFrame, columns: Mapping[str, str], nth: int = 0, skip_rows: int = 1, html: str = "html"
) -> DataFrame:
    """Rows of the nth table of a page, tables inside tables counted; ``columns`` maps output names to header texts.

    Cells are paired with headers by position; ``skip_rows`` leading rows are
    dropped. Headers that the table lacks give null. What stands in a table inside a cell is text of that cell only.
    """
    wanted = dict(columns)

    def records(page: Page) -> Iterator[tuple]:
        tables = list(page.select("table"))
        if nth >= len(tables):
            return
        table = tables[nth]
        heads = [page.text(i) for i in page.own(table, {"th"})]
        place = {name: heads.index(head) if head in heads else -1 for name, head in wanted.items()}
        for n, row in enumerate(page.own(table, {"tr"})):
            if n >= skip_rows:
                cells = [page.text(i) for i in page.own(row, {"td"})]
                yield n, *[cells[k] if 0 <= k < len(cells) else None for k in place.values()]

    return from_pages(pages, html, {"position": "int"} | dict.fromkeys(wanted, "string"), records)
