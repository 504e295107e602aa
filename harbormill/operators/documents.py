"""Free text: flattening, joining, chunking and document tables."""

from __future__ import annotations

import bisect
import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.functions.ids import uuid5
from harbormill.functions.text import join_nonblank, last_segment, strip
from harbormill.functions.workers import kept_in_worker
from harbormill.operators.columns import spread

# Chunk width and overlap in characters, chunk width in tokens,
# and the separators tried from coarse to fine.
CHUNK_CHARS = 512
CHUNK_OVERLAP = 200
CHUNK_TOKENS = 2048
SEPARATORS = ("\n\n", "\n", " ", "")

ISSUE_NAMESPACE = uuid.NAMESPACE_URL
DOCUMENT_NAMESPACE = uuid.UUID(int=0)


# --- rich text ---------------------------------------------------------------


def _leaf_texts(node: object) -> Iterator[str]:
    """Texts of a node tree in reading order, with an explicit stack: depth is unbounded."""
    stack = [node]
    while stack:
        item = stack.pop()
        if item is None:
            continue
        if isinstance(item, list):
            stack.extend(reversed(item))
        elif isinstance(item, dict):
            text = item.get("text")
            stack.append(text if isinstance(text, str) else item.get("content"))
        else:
            yield str(item)


def _tree_text(raw: str | None) -> str:
    if not raw:
        return ""
    try:
        tree = json.loads(raw)
    except ValueError:
        return raw  # plain text passes through
    if not isinstance(tree, (dict, list)):
        return tree if isinstance(tree, str) else raw
    return "\n".join(t for t in _leaf_texts(tree) if t)


@F.pandas_udf(T.StringType())
def rich_text(raw: pd.Series) -> pd.Series:
    """Rich-text JSON tree to plain text, one line per text leaf; null gives ''."""
    return raw.map(_tree_text, na_action=None)


@F.pandas_udf(T.ArrayType(T.StringType()))
def rich_texts(raw: pd.Series) -> pd.Series:
    """The same for an array of trees."""
    return raw.map(lambda items: [] if items is None else [_tree_text(r) for r in items], na_action=None)


@F.pandas_udf(T.StringType())
def rich_blob(parts: pd.DataFrame) -> pd.Series:
    """Text of (summary, description, comments) in one pass: empty parts dropped, parted by a blank line."""
    summaries, descriptions, comments = (parts.iloc[:, i] for i in range(3))

    def blob(summary, description, bodies) -> str:
        texts = [_tree_text(t) for t in (summary, description, *([] if bodies is None else bodies))]
        return "\n\n".join(t for t in texts if t)

    return pd.Series([blob(*row) for row in zip(summaries, descriptions, comments, strict=True)], dtype=object)


def text_blob(summary: Column, description: Column, comments: Column) -> Column:
    """Summary, description and every comment (an array), blank parts dropped."""
    parts = F.concat(F.array(summary, description), F.coalesce(comments, F.array().cast("array<string>")))
    return join_nonblank(parts)


# --- chunking ----------------------------------------------------------------


def _pieces(text: str, separator: str) -> list[str]:
    """Split so that every piece but the first starts with the separator."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in (head, *(separator + r for r in rest)) if p]


def _pack(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join consecutive pieces up to ``size``; the next chunk repeats up to ``overlap``."""
    window: list[str] = []
    width = 0
    for piece in pieces:
        if window and width + len(piece) > size:
            yield "".join(window).strip()
            drop = 0
            while drop < len(window) and (width > overlap or width + len(piece) > size):
                width -= len(window[drop])
                drop += 1
            window = window[drop:]
        window.append(piece)
        width += len(piece)
    yield "".join(window).strip()


def split_recursive(
    text: str, size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP, separators: tuple[str, ...] = SEPARATORS
) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that fits."""
    level = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    finer = separators[level + 1 :]
    chunks: list[str] = []
    small: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            small.append(piece)
            continue
        if small:
            chunks.extend(_pack(small, size, overlap))
            small = []
        chunks.extend(split_recursive(piece, size, overlap, finer) if finer else [piece])
    if small:
        chunks.extend(_pack(small, size, overlap))
    return [c for c in chunks if c]


def recursive_chunks(size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP):
    """Column function: text to its array of chunks, batch by batch."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def chunk(text: pd.Series) -> pd.Series:
        return text.map(lambda t: split_recursive(t, size, overlap) if t and t.strip() else [])

    return chunk


def stride_chunks(text: Column, size: int = CHUNK_CHARS) -> Column:
    """Consecutive pieces of ``size`` characters; concatenated they give the text back."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), 0)


def token_chunks(text: Column, budget: int = CHUNK_TOKENS) -> Column:
    """Chunks of at most ``budget`` blank-separated tokens."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words), F.lit(budget)))
    pieces = F.transform(starts, lambda s: F.array_join(F.slice(words, s, budget), " "))
    return F.coalesce(pieces, F.array().cast("array<string>"))


# where a chunk should end, the coarsest first: after a blank line, a line, a sentence, a word
BORDERS = tuple(re.compile(p) for p in (r"\n[^\S\n]*\n\s*", r"\n\s*", r"[.!?\u2026][\"')\]]*\s+", r"\s+"))


def _last_border(text: str, start: int, end: int) -> int:
    """The last border of the coarsest kind in the second half of text[start:end]; without one the end."""
    half = (start + end + 1) // 2
    for border in BORDERS:
        found = [m.end() for m in border.finditer(text, half, end)]
        if found:
            return found[-1]
    return end


def _bounded_spans(text: str, tokenizer, budget: int) -> list[tuple[int, int, int]]:
    """(start, end, ids) of consecutive chunks that cover the text, none of more than ``budget`` ids when encoded by itself."""
    if not text:
        return []
    starts = [s for s, _ in tokenizer.encode(text, add_special_tokens=False).offsets]
    spans, at, first = [], 0, 0
    while at < len(text):
        ahead = first + budget
        end = len(text) if ahead >= len(starts) else max(starts[ahead], at + 1)
        if end < len(text):
            end = _last_border(text, at, end)
        while True:
            ids = len(tokenizer.encode(text[at:end], add_special_tokens=False).ids)
            if ids <= budget or end - at == 1:
                break
            # a cut can make ids of its own: take off as much as is too much, a character at least
            end = _last_border(text, at, max(at + 1, end - max(1, (end - at) * (ids - budget) // ids)))
        spans.append((at, end, ids))
        at, first = end, bisect.bisect_left(starts, end, first)
    return spans


def bounded_chunks(df: DataFrame, text: str, tokenizer: str, budget: int = CHUNK_TOKENS, content: str = "content", ordinal: str = "chunk") -> DataFrame:
    """One row per chunk of at most ``budget`` ids of a tokenizer, with its place in the text (``start``, ``end``) and its ``tokens``.

    ``tokenizer`` is a file that the workers load once. Chunks end after a blank line, line, sentence or word if
    there is one in the second half of what fits. They follow each other without gap or overlap and give the text back. A single
    character of more ids than the budget is a chunk of its own; null and empty texts have none. Only offsets leave the worker.
    """

    @F.pandas_udf("array<struct<start:int,end:int,tokens:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        kept = kept_in_worker("tokenizers")
        if tokenizer not in kept:
            from tokenizers import Tokenizer

            kept[tokenizer] = Tokenizer.from_file(tokenizer)
            kept[tokenizer].encode_special_tokens = True  # their names in a text are text
        coder = kept[tokenizer]
        return texts.map(lambda t: [{"start": s, "end": e, "tokens": n} for s, e, n in _bounded_spans(t or "", coder, budget)])

    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    # a text takes longer to encode than to send, and one file may hold very many
    found = spread(df).select(text, *others, F.posexplode(spans(F.col(text))).alias(ordinal, "_span"))
    piece = F.substring(F.col(text), F.col("_span.start") + 1, F.col("_span.end") - F.col("_span.start"))
    return found.select(*others, ordinal, piece.alias(content), "_span.start", "_span.end", "_span.tokens")


def explode_chunks(df: DataFrame, chunks: Column, content: str = "content", ordinal: str = "chunk") -> DataFrame:
    """One row per chunk with its position in the document; empty documents vanish."""
    return df.select(*df.columns, F.posexplode(chunks).alias(ordinal, content))


def chunk_id(reference: Column, ordinal: Column, prefix: str = "jira") -> Column:
    """The same id on every run, so that a rerun refreshes rows in place."""
    name = F.concat(F.lit(f"{prefix}:"), reference, F.lit(":"), ordinal.cast("string"))
    return uuid5(name, ISSUE_NAMESPACE)


# --- document table ----------------------------------------------------------


def document_table(landed: DataFrame, processed_at: Column) -> DataFrame:
    """Disclosure rows from landed text (columns company, url, contents)."""
    contents = F.col("contents")
    lines = F.split(contents, "\n")
    return landed.select(
        uuid5(F.col("url"), DOCUMENT_NAMESPACE).alias("document_id"),
        "company",
        last_segment(F.col("url")).alias("filename"),
        "url",
        # form feeds separate the pages of converted text
        (F.regexp_count(contents, F.lit("\f")) + 1).cast("bigint").alias("pages"),
        # the rule under the header row marks one markdown table
        F.regexp_count(contents, F.lit(r"(?m)^\|(?:\s*:?-+:?\s*\|)+\s*$")).cast("bigint").alias("tables"),
        F.size(F.filter(lines, lambda line: strip(line) != "")).cast("bigint").alias("doc_elements"),
        F.sha2(contents, 256).alias("document_hash"),
        F.length(contents).cast("bigint").alias("size"),
        "contents",
        processed_at.cast("timestamp_ntz").alias("processed_at"),
    )
