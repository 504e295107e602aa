"""Exact similarity search and the plug point for an embedding model."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.functions.vectors import dot, has_width


def _unit(values: Sequence[float]) -> list[float] | None:
    length = math.sqrt(math.fsum(float(v) ** 2 for v in values))
    return [float(v) / length for v in values] if length else None


def _unit_column(query: DataFrame) -> Column:
    """The vector of a one-row query at length 1, as a subquery that runs once."""
    vector = F.col(query.columns[0])
    length = F.sqrt(dot(vector, vector))
    return query.select(F.transform(vector, lambda x: F.try_divide(x.cast("double"), length)).alias("unit")).scalar()


def _similarity(embedding: Column, unit: Column) -> Column:
    """Cosine with a query of length 1, which leaves two sums per row."""
    norm = F.sqrt(dot(embedding, embedding))
    return F.when(F.size(embedding) == F.size(unit), F.try_divide(dot(embedding, unit), norm))


def top_k(
    vectors: DataFrame,
    query: Sequence[float] | DataFrame | None,
    k: int,
    embedding: str = "embedding",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` most similar rows, best first, score rounded to 4 places; an empty query finds nothing.

    ``query`` is a list of numbers, or a DataFrame of one row and one vector.
    Each task keeps its own best k rows, so only k rows per task travel.
    """
    if isinstance(query, DataFrame):
        unit = _unit_column(query)
    else:
        numbers = _unit(query) if query is not None and len(query) else None
        if numbers is None:
            return vectors.drop(embedding).withColumn("score", F.lit(None).cast("double")).limit(0)
        unit = F.array(*[F.lit(v) for v in numbers])
    scored = vectors.withColumn("_query", unit)
    scored = scored.withColumn("_score", _similarity(F.col(embedding), F.col("_query"))).drop(embedding, "_query")
    best = scored.where(F.col("_score").isNotNull()).orderBy(F.col("_score").desc(), *ties).limit(k)
    return best.withColumn("score", F.round("_score", 4)).drop("_score")


def top_k_in_namespace(
    vectors: DataFrame,
    query: Sequence[float] | DataFrame,
    namespace: str,
    k: int = 10,
    column: str = "namespace",
    embedding: str = "embedding",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` nearest rows inside one namespace; the search is exact, so no more than these are fetched."""
    inside = vectors.where(F.col(column) == namespace)
    return top_k(inside, query, k, embedding, ties)


def _scores(rows: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Cosine of each row with the unit vector beside it, added up in the order in which the search for one query does."""
    total, square = np.zeros(len(rows)), np.zeros(len(rows))
    for d in range(rows.shape[1]):
        total += rows[:, d] * units[:, d]
        square += rows[:, d] * rows[:, d]
    return total / np.sqrt(square)


# Of the blocks that a task multiplies: numbers in the largest ones, and scores held at once; and so many blocks of either side are
# made before blocks get larger.
BLOCK_NUMBERS, QUERY_NUMBERS, SCORES = 1 << 20, 1 << 18, 1 << 22
BLOCKS = 8


def blocks_of(rows: int, width: int, least: int, numbers: int) -> int:
    """How many blocks the rows are dealt into: of ``least`` rows while there are few, of more in larger tables, up to ``numbers`` in a block."""
    size = min(max(least, math.ceil(rows / BLOCKS)), max(least, numbers // max(1, width)))
    return max(1, math.ceil(rows / size))


def _nearest_in_cell(k: int) -> Callable:
    """The best ``k`` rows of a block of vectors for each query of a block of queries, ties by the row's key."""

    def run(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if block.empty or asked.empty:
            return pd.DataFrame({"_query": [], "_row": [], "_score": []})
        block = block.sort_values("_id", kind="stable")
        given = np.stack(block["_vector"].to_numpy()).astype(np.float64)
        # copies have equal scores, so the k of least key are enough
        copy_of, _ = pd.factorize(np.array([v.tobytes() for v in given], dtype=object))
        by_copy = np.argsort(copy_of, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(copy_of))])
        copies = np.minimum(np.diff(first), k)
        rows = given[by_copy[first[:-1]]]
        wanted = np.stack(asked["_vector"].to_numpy()).astype(np.float64)
        lengths = np.sqrt(np.cumsum(wanted * wanted, axis=1)[:, -1])
        units = wanted / lengths[:, None]
        across = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).T
        queries, places, scores = [], [], []
        step, at_once = max(1, SCORES // len(rows)), max(1, SCORES // rows.shape[1])
        for at in range(0, len(units), step):
            near = units[at : at + step] @ across
            if k < near.shape[1]:
                least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            else:
                least = np.full(len(near), -2.0)
            q, r = np.nonzero(near >= least[:, None] - 1e-9)  # the product rounds otherwise than the sums below
            q += at
            score = np.concatenate([_scores(rows[r[i : i + at_once]], units[q[i : i + at_once]]) for i in range(0, max(1, len(r)), at_once)])
            # the k best with their copies hold the k best rows
            order = np.lexsort((-score, q))
            q, r, score = q[order], r[order], score[order]
            kth = score[np.minimum(np.searchsorted(q, q) + k, np.searchsorted(q, q, "right")) - 1]
            q, r, score = (x[score >= kth] for x in (q, r, score))
            n = copies[r]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            q, score, place = np.repeat(q, n), np.repeat(score, n), by_copy[np.repeat(first[r], n) + nth]
            order = np.lexsort((place, -score, q))
            best = order[np.arange(len(order)) - np.searchsorted(q, q) < k]
            queries.append(q[best])
            places.append(place[best])
            scores.append(score[best])
        ids = block["_id"].to_numpy()[np.concatenate(places)]
        return pd.DataFrame({"_query": asked["_id"].to_numpy()[np.concatenate(queries)], "_row": ids, "_score": np.concatenate(scores)})

    return run


def top_k_many(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    key: str,
    query_key: str,
    embedding: str = "embedding",
    block_rows: int = 4096,
    query_rows: int = 1024,
) -> DataFrame:
    """``query_key``, ``key``, rank and score of the ``k`` most similar rows of every query, in one job; the same scores as ``top_k``.

    Vectors and queries are dealt into blocks, and a task multiplies one block of each, so it holds some megabytes however many
    there are. ``block_rows`` and ``query_rows`` are the least sizes: every block travels once for each of the other side, so those of
    larger tables are larger, up to a fixed number of numbers. A task sends the best ``k`` of its block for each query; ranks are
    then taken over these. Ties go by ``key``. Null, empty and zero
    vectors, and rows of another width than the query, are not found. The keys tell rows and queries apart; both are not null.
    """

    def usable(df: DataFrame, name: str) -> DataFrame:
        vector = F.col(embedding).cast("array<double>")
        given = df.select(F.col(name).alias("_id"), vector.alias("_vector"))
        finite = F.forall("_vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("_vector", lambda x: x != 0)
        return given.where(F.col("_id").isNotNull() & F.col("_vector").isNotNull() & finite).withColumn("_width", F.size("_vector"))

    def number_of_blocks(df: DataFrame, least: int, numbers: int) -> int:
        seen = df.agg(F.count(F.lit(1)).alias("n"), F.max("_width").alias("width")).first()
        return blocks_of(seen["n"], seen["width"] or 1, least, numbers)

    rows, asked = usable(vectors, key), usable(queries, query_key)
    blocks = number_of_blocks(rows, block_rows, BLOCK_NUMBERS)
    query_blocks = number_of_blocks(asked, query_rows, QUERY_NUMBERS)
    block = F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int").alias("_block")
    query_block = F.pmod(F.xxhash64("_id"), F.lit(query_blocks)).cast("int").alias("_query_block")
    left = rows.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("_query_block"))
    right = asked.select("*", query_block, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    kinds = f"_query {queries.schema[query_key].dataType.simpleString()}, _row {vectors.schema[key].dataType.simpleString()}, _score double"
    cell = ["_width", "_block", "_query_block"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_nearest_in_cell(k), kinds)
    order = Window.partitionBy("_query").orderBy(F.col("_score").desc(), "_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("_query").alias(query_key), F.col("_row").alias(key), "rank", F.round("_score", 4).alias("score"))


def attach_embeddings(
    chunks: DataFrame,
    load_model: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
    content: str = "content",
    batch: int = 64,
) -> DataFrame:
    """Add an embedding column; the model is loaded once per task and fed in batches."""
    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def embed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for frame in frames:
            texts = frame[content].tolist()
            vectors: list[Sequence[float]] = []
            for start in range(0, len(texts), batch):
                vectors.extend(model(texts[start : start + batch]))
            yield frame.assign(embedding=[list(map(float, v)) for v in vectors])

    return chunks.mapInPandas(embed, schema)


def wrong_width(vectors: DataFrame, width: int, embedding: str = "embedding") -> DataFrame:
    """Rows whose vector does not have the declared width."""
    return vectors.where(~F.coalesce(has_width(F.col(embedding), width), F.lit(False)))
