"""Business terms and the values they allow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The terms of the two glossaries; None means any value.
TERMS: dict[str, tuple[str, ...] | None] = {
    "fraud_rate_pct": None,
    "market_type": (
        "barsandrestaurants",
        "contents",
        "fashion",
        "food",
        "health",
        "home",
        "hotelservices",
        "hyper",
        "leisure",
        "otherservices",
        "sportsandtoys",
        "tech",
        "transportation",
        "travel",
        "wellnessandbeauty",
    ),
    "category": ("Apparel", "Consumables", "Household"),
    "price": None,
    "original_price": None,
    "brand": None,
    "scraped_at": None,
}


def allowed_values(term: str) -> tuple[str, ...] | None:
    if term not in TERMS:
        raise KeyError(f"unknown glossary term {term!r}")
    return TERMS[term]


def term_values(spark: SparkSession) -> DataFrame:
    rows = [(t, v) for t, values in TERMS.items() for v in values or ()]
    return spark.createDataFrame(rows, "term string, value string")
