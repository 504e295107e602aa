"""Secrets in texts: strong patterns alone, weak ones where complementary parts stand together."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# In the order in which spans of one start are listed. The first three stand alone.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = 3
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)

# The patterns of the base kinds and their least lengths.
ASSIGN_PATTERN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS_PATTERN = r"AKIA[A-Z0-9]+"
HEX_PATTERN = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

IDENTIFIER_PATTERN = r"""(?:user(?:name|id)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
SECRET_PATTERN = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT_PATTERN = r"""(?:https?|ftps?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]{4,}"""

# A weak part is reported beside a part of these kinds.
COMPLEMENTS = {
    IDENTIFIER: (ASSIGN, HEX, SECRET),
    SECRET: (ACCESS, IDENTIFIER, ENDPOINT),
    ENDPOINT: (ASSIGN, HEX, SECRET),
}
SCOPE = 200

PARTS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every part, strong or weak; code points, end exclusive."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        for m in re.finditer(ASSIGN_PATTERN, text, re.ASCII | re.IGNORECASE):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append((m.start(), ASSIGN, m.end()))
    if "AKIA" in text:
        found += [(m.start(), ACCESS, m.end()) for m in re.finditer(ACCESS_PATTERN, text) if m.end() - m.start() >= ACCESS_LEAST]
    # a run is taken whole, so asking for its least length in the pattern drops the same runs
    found += [(m.start(), HEX, m.end()) for m in re.finditer(rf"{HEX_PATTERN[:-1]}{{{HEX_LEAST},}}", text)]
    if any(word in low for word in ("user", "login", "account", "client")):
        found += [(m.start(), IDENTIFIER, m.end()) for m in re.finditer(IDENTIFIER_PATTERN, text, re.ASCII | re.IGNORECASE)]
    if "://" in text:
        found += [(m.start(), ENDPOINT, m.end()) for m in re.finditer(ENDPOINT_PATTERN, text, re.ASCII | re.IGNORECASE)]
    if any(kind in COMPLEMENTS[SECRET] for _, kind, _ in found):  # else no weak secret can be reported
        found += [(m.start(), SECRET, m.end()) for m in re.finditer(SECRET_PATTERN, text)]
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [[dict(zip(("start", "kind", "end"), p, strict=True)) for p in parts_of(x or "")] for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(parts, PARTS)], ["doc_id", "text_key", "parts"])


def _complements() -> Column:
    pairs = [(F.col("kind") == weak) & F.col("other").isin(*strong) for weak, strong in COMPLEMENTS.items()]
    return pairs[0] | pairs[1] | pairs[2]


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, text_key (hash of the text), spans (start, kind, end).

    Strong parts are always listed, weak ones where a complementary part starts
    within ``scope`` code points in the same text. That is an interval join on
    (document, block of ``scope`` code points): per block and kind only the least and
    greatest start matter, so the joined side is a grouped minimum and maximum and
    no pair of parts is ever made.

    Spans are ordered by start, then kind. Null text is empty. Repeated rows give
    repeated, equal results; rows that share a doc_id but not the text are told apart
    by the text's hash. Other columns are ignored; an empty table gives no rows.
    """
    from harbormill.llm.common import checkpoint

    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", text_key long, parts array<struct<start:bigint,kind:int,end:bigint>>"
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    parts = checkpoint(rows.mapInArrow(_scan, schema))

    each = parts.where(F.size("parts") > 0).distinct().select("doc_id", "text_key", F.inline("parts"))
    each = each.withColumn("block", F.floor(F.col("start") / scope))
    blocks = each.groupBy("doc_id", "text_key", "block", F.col("kind").alias("other")).agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    weak = each.where(F.col("kind") >= BASE).withColumn("at", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    w, b = weak.alias("w"), blocks.alias("b")
    near = (
        F.col("w.doc_id").eqNullSafe(F.col("b.doc_id"))
        & (F.col("w.text_key") == F.col("b.text_key"))
        & (F.col("w.at") == F.col("b.block"))
        & (F.col("b.lo") <= F.col("w.start") + scope)
        & (F.col("b.hi") >= F.col("w.start") - scope)
        & _complements()
    )
    linked = (
        w.join(b, near, "left_semi")
        .select("doc_id", "text_key", F.struct("start", "kind", "end").alias("part"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("part").alias("linked"))
    )
    p, k = parts.alias("p"), linked.alias("k")
    same = F.col("p.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("p.text_key") == F.col("k.text_key"))
    strong = F.filter("p.parts", lambda x: x["kind"] < BASE)
    spans = F.sort_array(F.concat(strong, F.coalesce("k.linked", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"))))
    return p.join(k, same, "left").select("p.doc_id", "p.text_key", spans.alias("spans"))


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mask``; spans that overlap or touch share one."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def take(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = (s["start"] > acc["at"]) | (s["start"] == 0) & (acc["out"] == "")
        return F.struct(
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans,
        state,
        take,
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )


def redact_secrets(docs: DataFrame, scope: int = SCOPE, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span that the scan lists replaced in the text; rows and other columns stay as they are, whatever their names.

    Null texts stay null, repeated rows are redacted alike; an empty table gives no rows.
    """
    found = scan_secrets(docs, scope).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    # the row in a struct, so that no column of it can clash
    d, f = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.xxhash64("text").alias("key")).alias("d"), found.alias("f")
    same = F.col("d.row.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.key") == F.col("f.text_key"))
    text = F.when(F.col("f.spans").isNull(), F.col("d.row.text")).otherwise(redacted(F.col("d.row.text"), F.col("f.spans"), mask))
    return d.join(f, same, "left").select(*[text.alias("text") if c == "text" else F.col(f"d.row.`{c}`").alias(c) for c in docs.columns])
