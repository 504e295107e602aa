"""Approximate nearest neighbours by an inverted multi-index over two vector halves."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harbormill.llm.common import checkpoint
from harbormill.llm.vectors import stacked, usable

NEAREST = 20
CENTROIDS = 32  # of each half
SAMPLE_ROWS = 20_000  # rows the centroids are fitted on
ROUNDS = 12
AUDITED = 256  # queries searched exhaustively to set the reach
RECALL = 0.96  # share of the audited neighbours that the reach must hold
PART_ROWS = 4_096  # rows of a part of the index, and queries asked at once


def fitted(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; empty centroids stay where they were."""
    k = min(k, len(points))
    centroids = points[np.random.default_rng(seed).permutation(len(points))[:k]].copy()
    for _ in range(ROUNDS):
        own = assigned(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=k)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


def assigned(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (np.square(centroids).sum(axis=1) - 2 * points @ centroids.T).argmin(axis=1)


def traversal(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by falling first[i] + second[j], from a heap that holds one border of the pairs taken so far."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a], second[b]
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def probed(query: np.ndarray, halves: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, reach: int) -> list[int]:
    """Cells in order of nearness until they hold ``reach`` entries; cells without entries are left out."""
    d, k = halves[0].shape[1], len(halves[1])
    cells, held = [], 0
    for i, j in traversal(halves[0] @ query[:d], halves[1] @ query[d:]):
        n = sizes[i * k + j]
        if n:
            cells.append(i * k + j)
            held += n
            if held >= reach:
                break
    return cells


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.nonzero(scores >= least)[0]
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_nearest(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """The true neighbours of a bounded set of queries (vec_id, v): every task scores its rows in blocks."""
    own, matrix = queries["vec_id"].to_numpy(), stacked(queries["v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            if not len(ids):
                continue
            scores = matrix @ stacked(batch.column("v").to_pylist()).T
            out: list = []
            for q in range(len(own)):
                s = np.where(ids == own[q], -np.inf, scores[q])
                out += [(own[q], ids[p], s[p]) for p in best_of(s, ids, k) if s[p] > -np.inf]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            types = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["query_id", "vec_id", "score"]
            )

    return _ranked(rows.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def nearest_vectors(
    rows: DataFrame,
    queries: DataFrame,
    k: int = NEAREST,
    recall: float = RECALL,
    centroids: int = CENTROIDS,
    sample_rows: int = SAMPLE_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query the ``k`` rows of greatest inner product that were found.

    Both inputs have vec_id and embedding. The first and second halves of the vectors are quantised separately, by
    centroids fitted on a sample of ``sample_rows``; every row is indexed, under its pair of centroids. A query takes pairs in
    falling order of its summed inner products with the two centroids, from a heap, until their entries number the reach, and
    ranks these by the exact inner product in double precision. The reach is set by measurement: so many entries that
    ``recall`` of the true neighbours of ``AUDITED`` queries lie within it.

    A pair of centroids with very many rows is split, and a part of the index that very many queries probe answers
    them in several tasks, so neither grows with the hottest pair. All that reaches the driver is the sample, the
    audit and a count per pair of centroids (``centroids`` squared at most).

    Ties go to the smaller vec_id. A query is not its own neighbour; fewer rows than ``k`` give fewer results. Rows whose
    vector is null, empty, zero or holds null or non-finite components, or whose vec_id is null, take no part; neither do
    vectors whose length is not the commonest one. Repeated vec_ids are candidates of their own. Other columns are ignored; empty
    tables give no rows.
    """

    def taken(df: DataFrame) -> DataFrame:
        return df.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
        )

    base, asked = taken(rows), taken(queries)
    spark = rows.sparkSession
    sizes_of = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head()
    if sizes_of is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, total = sizes_of["d"], sizes_of["count"]
    base, asked = base.where(F.size("v") == d), asked.where(F.size("v") == d)

    def sampled(df: DataFrame, n: int, of: int, salt: str) -> pd.DataFrame:
        share = min(1.0, 1.1 * n / max(of, 1))
        chosen = df.where(F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        return chosen.limit(n).toPandas()

    points = stacked(sampled(base, sample_rows, total, "fit")["v"])
    half = max(1, d // 2)
    halves = (fitted(points[:, :half], centroids, 1), fitted(points[:, half:], centroids, 2))
    wide = len(halves[1])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = stacked(batch.column("v").to_pylist())
                cell = assigned(m[:, :half], halves[0]) * wide + assigned(m[:, half:], halves[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "v", "cell"])

    entries = checkpoint(base.mapInArrow(index, "vec_id long, v array<double>, cell int"))
    sizes = np.zeros(len(halves[0]) * wide, dtype=np.int64)
    for cell, n in entries.groupBy("cell").count().collect():  # as many rows as pairs of centroids at most
        sizes[cell] = n

    # reach: how many entries the audited queries pass until they have met their neighbours
    n_asked = asked.count()
    audit = sampled(asked, AUDITED, n_asked, "audit")
    if audit.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    audited = dict(zip(audit["vec_id"], stacked(audit["v"]), strict=True))
    truth = exact_nearest(base, audit, k).withColumnRenamed("vec_id", "near")
    met = truth.join(entries.select(F.col("vec_id").alias("near"), "cell"), "near").select("query_id", "cell").toPandas()
    passed = []
    for query_id, cells in met.groupby("query_id")["cell"]:
        order = probed(audited[query_id], halves, sizes, total + 1)
        held = dict(zip(order, np.cumsum(sizes[order]), strict=True))
        passed += [held[c] for c in cells]
    reach = max(k + 1, int(np.quantile(passed, recall, method="higher"))) if passed else k + 1

    # parts of at most about part_rows rows: small cells share one, large ones are split by a hash
    first_part, splits, part, room = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64), 0, part_rows
    for cell in np.nonzero(sizes)[0]:
        n = int(sizes[cell])
        if n > room:
            part, room = part + 1, part_rows
        first_part[cell] = part
        if n > part_rows:
            splits[cell] = math.ceil(n / part_rows)
            part, room = part + int(splits[cell]), part_rows
        else:
            room -= n

    lookup = spark.createDataFrame(
        pd.DataFrame({"cell": np.arange(len(sizes)), "first_part": first_part, "splits": splits}), "cell int, first_part long, splits long"
    )
    placed = entries.join(lookup, "cell").select(
        (F.col("first_part") + F.pmod(F.xxhash64("vec_id"), F.col("splits"))).alias("part"), "vec_id", "v", "cell"
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, at, parts, cells = batch.column("vec_id").to_numpy(), [], [], []
            for n, q in enumerate(stacked(batch.column("v").to_pylist())):
                by_part: dict[int, list[int]] = {}
                for cell in probed(q, halves, sizes, reach):
                    for s in range(splits[cell]):
                        by_part.setdefault(int(first_part[cell] + s), []).append(cell)
                at += [n] * len(by_part)
                parts += by_part
                cells += by_part.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), batch.column("v").take(pa.array(at)), pa.array(parts, pa.int64()), pa.array(cells, pa.list_(pa.int32()))],
                ["query_id", "q", "part", "cells"],
            )

    probes = checkpoint(asked.repartition(max(1, math.ceil(n_asked / 1024))).mapInArrow(probe, "query_id long, q array<double>, part long, cells array<int>"))
    turns = probes.groupBy("part").count().select("part", F.ceil(F.col("count") / part_rows).alias("turns"))
    dealt = probes.join(turns, "part").withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns"))).drop("turns")
    repeats = turns.select("part", (F.col("turns") - 1).alias("last"))
    served = placed.join(repeats, "part").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).drop("last")

    def score(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(held) and len(asking):
            held = held.sort_values("cell", kind="stable")
            ids, cell, matrix = held["vec_id"].to_numpy(), held["cell"].to_numpy(), stacked(held["v"])
            for query_id, q, cells in zip(asking["query_id"], asking["q"], asking["cells"], strict=True):
                lo, hi = np.searchsorted(cell, cells, "left"), np.searchsorted(cell, cells, "right")
                rows_of = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])
                rows_of = rows_of[ids[rows_of] != query_id]
                scores = np.einsum("rd,d->r", matrix[rows_of], np.asarray(q))
                out += [(query_id, ids[rows_of[p]], scores[p]) for p in best_of(scores, ids[rows_of], k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (
        served.groupBy("part", "turn").cogroup(dealt.groupBy("part", "turn")).applyInPandas(score, "query_id long, vec_id long, score double")
    )
    return _ranked(found, k)
