"""Near-duplicate vectors by cosine: a navigable small-world graph per shard, every shard queried by all vectors."""

from __future__ import annotations

import io
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from harbormill.llm.common import checkpoint, connected_components, shuffle_partitions
from harbormill.llm.hnsw import CHUNK, DEGREE, Level, build, search
from harbormill.llm.vectors import stacked, unit, usable

THRESHOLD = 0.95
MIN_SHARDS = 4
SHARD_ROWS = 32_768
BLOCK_ROWS = 4_096
PART_BLOCKS = 16  # blocks that one task asks a shard, so often fewer is its graph sent
BEAM = 32
WIDEN = 4
# A widened beam becomes a scan, one matrix product, where it would visit an eighth of the shard link by link.
SCANNED = 8 * DEGREE
AUDITED = 256  # queries of a block compared with a scan of the shard
AUDIT_NEAREST, AUDIT_RECALL = 10, 0.9
AUDIT_CLOSEST, CLOSEST_RECALL = 2, 0.99  # stand for links, which a sample seldom holds where they are rare
MARGIN = 1e-4  # single precision finds, double precision decides
HELD = 1 << 20  # components gathered at once to verify pairs


def packed(ids: np.ndarray, given: np.ndarray, levels: list[Level]) -> bytes:
    """A shard: nodes with their weights, vectors as they are given, and the graph."""
    out = io.BytesIO()
    arrays = {f"nodes{i}": level.nodes.astype(np.int32) for i, level in enumerate(levels)} | {f"links{i}": level.links.astype(np.int32) for i, level in enumerate(levels)}
    np.savez(out, ids=ids, given=given, **arrays)
    return out.getvalue()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[Level]]:
    """Nodes with their weights, unit vectors and the graph."""
    with np.load(io.BytesIO(blob)) as f:
        levels = [Level(f[f"nodes{i}"].astype(np.int64), f[f"links{i}"].astype(np.int64)) for i in range((len(f.files) - 2) // 2)]
        return f["ids"], unit(f["given"].astype(np.float64)), levels


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component of each of ``n`` nodes under the links a-b, named by its least node."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if np.array_equal(label, before):
            return label


def link_pieces(
    matrix: np.ndarray, single: np.ndarray, levels: list[Level], queries: np.ndarray, threshold: float, seed: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, rows) of the pairs with a cosine of ``threshold`` or more, verified in double precision; all pairs of a query in one
    piece, which holds those of CHUNK queries at most. ``single`` is the matrix in single precision.

    A query whose beam could hold more links than it found room for is asked again with a wider beam, in the end
    one as wide as the shard. A sample of the queries is audited against a scan: all their links, ``AUDIT_RECALL``
    of their nearest rows and ``CLOSEST_RECALL`` of the closest of these must be found, else the first beam of all queries is widened.
    """
    n = len(matrix)
    asked = queries.astype(np.float32)
    least = threshold - MARGIN

    def ask(rows: np.ndarray, beam: int, widened: bool = False):
        if beam * (SCANNED if widened else 16) >= n:
            beam = n
        again = []
        for lo in range(0, len(rows), CHUNK):
            some = rows[lo : lo + CHUNK]
            if beam == n:
                i, j = np.nonzero(asked[some] @ single.T >= least)
                yield some[i], j
                continue
            found, sims = search(single, levels, asked[some], beam)
            hit = (sims >= least) & (found >= 0)
            full = hit.sum(axis=1) * 2 > beam
            again.append(some[full])
            hit[full] = False
            i, j = np.nonzero(hit)
            yield some[i], found[i, j]
        wider = np.concatenate(again) if again else np.array([], dtype=np.int64)
        if len(wider):
            yield from ask(wider, beam * WIDEN, widened=True)

    audited = np.random.default_rng(seed).permutation(len(queries))[:AUDITED]
    beam = BEAM
    if beam * 16 < n:
        truth = asked[audited] @ single.T
        k = min(AUDIT_NEAREST, n)
        nearest = np.concatenate([np.argpartition(-truth[lo : lo + 16], k - 1, axis=1)[:, :k].copy() for lo in range(0, len(truth), 16)])
        closest = np.take_along_axis(nearest, np.argsort(-np.take_along_axis(truth, nearest, axis=1), axis=1), axis=1)[:, :AUDIT_CLOSEST]
        place = np.full(len(queries), -1)
        place[audited] = np.arange(len(audited))
        while beam * (16 if beam == BEAM else SCANNED) < n:
            found, _ = search(single, levels, asked[audited], beam)
            near = np.mean([len(np.intersect1d(x, y)) / k for x, y in zip(found, nearest, strict=True)])
            close = np.mean([np.isin(y, x).mean() for x, y in zip(found, closest, strict=True)])
            got = truth < threshold
            for q, r in ask(audited, beam, widened=beam > BEAM):
                got[place[q], r] = True
            if near >= AUDIT_RECALL and close >= CLOSEST_RECALL and got.all():
                break
            beam *= 2
        del truth
    step = max(1, HELD // matrix.shape[1])
    for q, r in ask(np.arange(len(queries)), beam, widened=beam > BEAM):
        keep = np.zeros(len(q), dtype=bool)
        for lo in range(0, len(q), step):
            a, b = q[lo : lo + step], r[lo : lo + step]
            keep[lo : lo + step] = np.einsum("id,id->i", queries[a], matrix[b]) >= threshold
        yield q[keep], r[keep]


def linked(matrix: np.ndarray, levels: list[Level], queries: np.ndarray, threshold: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, rows) of all ``link_pieces``."""
    q, r = zip(*link_pieces(matrix, matrix.astype(np.float32), levels, queries, threshold, seed), strict=True)
    return np.concatenate(q), np.concatenate(r)


def shard_links(blob: bytes, blocks: Iterator[tuple[np.ndarray, np.ndarray]], threshold: float, seed: int) -> Iterator[pd.DataFrame]:
    """node, links, to: of the nodes of each block (nodes, vectors) that link into the shard how many vectors they link to and one of
    these, and at the end a spanning set of the links that these make between the shard's nodes."""
    (ids, weights), matrix, levels = unpacked(blob)
    single, label = matrix.astype(np.float32), np.arange(len(ids))
    for own, given in blocks:
        for q, r in link_pieces(matrix, single, levels, unit(given), threshold, seed):
            some, first, at = np.unique(q, return_index=True, return_inverse=True)
            links = np.bincount(at, weights=weights[r] * (ids[r] != own[q]), minlength=len(some)).astype(np.int64)
            moved = np.nonzero(label != np.arange(len(ids)))[0]
            label = smallest_labels(len(ids), np.concatenate([r[first][at], moved]), np.concatenate([r, label[moved]]))
            yield pd.DataFrame({"node": own[some], "links": links, "to": ids[r[first]]})
    moved = label != np.arange(len(ids))
    yield pd.DataFrame({"node": ids[moved], "links": 0, "to": ids[label[moved]]})


def near_duplicate_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors at ``threshold`` or more), component_id (least vec_id reachable
    by links), kept (vec_id is component_id).

    Equal vectors are folded first and counted with their number. The folded vectors are dealt into shards of about
    ``shard_rows``; each shard gets a graph. Every vector queries every shard: a task reads one shard, then up to about PART_BLOCKS
    blocks of ``block_rows`` vectors as they arrive, and holds the shard, one block and the pairs of CHUNK queries whatever the
    table's size. It reports how many vectors each query links to and, instead of the pairs, one link of each query and a spanning
    set of those that follow between the shard's vectors.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of different
    lengths do not link. Rows that repeat a vec_id are vectors of their own. A null vec_id counts as a vector but names no
    component unless all of the component are null. Other columns are ignored; an empty table gives no rows.
    """
    given = rows.select("vec_id", "embedding", usable(F.col("embedding")).alias("usable"))
    folded = (
        given.where("usable")
        .groupBy("embedding")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    folded = checkpoint(folded)
    total = folded.count()
    shards, blocks = max(MIN_SHARDS, math.ceil(total / shard_rows)), max(1, math.ceil(total / block_rows))
    # queries of a shard are dealt over as many tasks as keep the cores busy, and no more blocks than PART_BLOCKS to a task
    parts = max(math.ceil(blocks / PART_BLOCKS), min(blocks, math.ceil(shuffle_partitions(rows.sparkSession) / shards)))
    given_type = rows.schema["embedding"].dataType
    single = isinstance(given_type, ArrayType) and isinstance(given_type.elementType, FloatType)
    element = "float" if single else "double"
    dealt = folded.select(
        "node",
        "weight",
        F.col("embedding").cast(f"array<{element}>").alias("v"),
        F.size("embedding").alias("d"),
        F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit("part"), "node"), F.lit(parts)).cast("int").alias("part"),
    )

    def build_shard(part: pd.DataFrame) -> pd.DataFrame:
        matrix = stacked(part["v"])
        levels = build(unit(matrix).astype(np.float32))
        ids = np.stack([part["node"].to_numpy(), part["weight"].to_numpy()])
        graph = packed(ids, matrix.astype(np.float32) if single else matrix, levels)
        return pd.DataFrame({"d": part["d"].iloc[:1], "shard": part["shard"].iloc[:1], "graph": [graph]})

    by_shard = dealt.repartitionById(shards, F.col("shard"))
    graphs = checkpoint(by_shard.groupBy("d", "shard").applyInPandas(build_shard, "d int, shard int, graph binary"))

    def for_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each graph once for every part, one at a time: explode would hold all copies of a graph in the heap."""
        for batch in batches:
            for n, part in itertools.product(range(batch.num_rows), range(parts)):
                one = batch.slice(n, 1)
                slot = pa.array([one.column("shard")[0].as_py() * parts + part], pa.int32())
                yield pa.RecordBatch.from_arrays([slot, one.column("d"), one.column("graph")], ["slot", "d", "graph"])

    def runs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            slot, d = (batch.column(c).to_numpy() for c in ("slot", "d"))
            cuts = np.nonzero((slot[1:] != slot[:-1]) | (d[1:] != d[:-1]))[0] + 1
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(d)]):
                if hi > lo:
                    yield (int(slot[lo]), int(d[lo])), batch.slice(lo, hi - lo)

    def in_blocks(first: pa.RecordBatch, rest: Iterator, d: int):
        nodes, vectors, held = [], [], 0
        for batch in itertools.chain([first], (batch for _, batch in rest)):
            nodes.append(batch.column("node").to_numpy())
            vectors.append(batch.column("v").flatten().to_numpy().reshape(-1, d).astype(np.float64))
            held += len(nodes[-1])
            if held >= block_rows:
                yield np.concatenate(nodes), np.concatenate(vectors)
                nodes, vectors, held = [], [], 0
        if held:
            yield np.concatenate(nodes), np.concatenate(vectors)

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (slot, d), batches_of_slot in itertools.groupby(runs(batches), key=lambda x: x[0]):
            _, first = next(batches_of_slot)
            graph = first.column("graph")[0].as_py()
            if graph is not None:  # a shard may hold no vectors of this length
                for out in shard_links(graph, in_blocks(first.slice(1), batches_of_slot, d), threshold, seed=slot // parts):
                    yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    left = graphs.mapInArrow(for_parts, "slot int, d int, graph binary")
    asking = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    right = dealt.withColumn("shard", asking).select((F.col("shard") * parts + F.col("part")).alias("slot"), "d", "node", "v")
    both = left.unionByName(right, allowMissingColumns=True).repartitionById(shards * parts, F.col("slot"))
    found = checkpoint(
        both.sortWithinPartitions("slot", "d", F.col("graph").isNull(), "node").mapInArrow(query, "node long, links long, to long")
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    roots = connected_components(found.select(F.col("node").alias("src"), F.col("to").alias("dst")))
    named = (
        folded.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("embedding", "least", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", F.xxhash64("node")).alias("root"))
    )
    named = checkpoint(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("embedding", "n_links", "component_id")
    good = given.where("usable").join(classes, "embedding").select("vec_id", "n_links", "component_id")
    alone = given.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
