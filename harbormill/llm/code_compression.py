"""Vectors compressed to codes, part by part; nearest entries found again under norm-of-sum bounds.

A codebook belongs to a position of equal consecutive parts. Each round assigns every part to its codebook's nearest entry and
moves the entries. After the first round most entries need not be looked at again: a lower bound on a part's distance to a
block of entries, made in round s, still holds in round t less the net way that the block's entries went between the two
codebooks. All codebooks are kept for that, and every bound bears the round it was made in. The norm of the summed steps is never
more than the sum of their norms, which bounds without a history have to take off.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.llm.common import discard, staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
BLOCK = 16  # entries that share a lower bound
CHUNK = 4_096  # parts that are compared with entries at once
MARGIN = 1e-6  # bounds are floating point: by so much, relatively, they must clear a distance


@dataclass
class State:
    """Per row and part position: entry, squared distance to it, and per block a lower bound with its round.

    A block's bound covers its entries but the part's own.
    """

    code: np.ndarray  # rows x parts, uint8
    distance: np.ndarray  # rows x parts, int64
    bound: np.ndarray  # rows x parts x blocks, float32
    stamp: np.ndarray  # the same, uint8
    scanned: int = 0  # entries compared


def _squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Rows x entries of one position; exact."""
    total = np.zeros((len(parts), len(entries)), dtype=np.int64)
    for d in range(parts.shape[1]):
        total += (parts[:, d, None] - entries[None, :, d]) ** 2
    return total


def net_ways(history: Sequence[np.ndarray], block: int) -> np.ndarray:
    """rounds x positions x blocks: the longest net way of a block's entries from a round's codebook to the last one."""
    last = history[-1]
    ways = np.stack([np.sqrt(((last - h).astype(np.float64) ** 2).sum(axis=2)) for h in history])
    return np.stack([ways[:, :, b : b + block].max(axis=2) for b in range(0, last.shape[1], block)], axis=2) * (1 + MARGIN)


def assign(cut: np.ndarray, history: Sequence[np.ndarray], state: State | None, block: int = BLOCK) -> State:
    """Nearest entry of the last codebook for every part of ``cut`` (rows x positions x components), ties to the lower index.

    ``history`` holds the codebooks (positions x entries x components) of all rounds so far. Without a ``state`` everything is scanned.
    """
    rows, positions, _ = cut.shape
    now, books = len(history) - 1, history[-1]
    entries = books.shape[1]
    starts = range(0, entries, block)
    if state is None:
        blank = np.zeros((rows, positions, len(starts)))
        state = State(np.zeros((rows, positions), np.uint8), np.zeros((rows, positions), np.int64), blank.astype(np.float32) - 1, blank.astype(np.uint8))
    else:
        state = State(state.code.copy(), state.distance.copy(), state.bound.copy(), state.stamp.copy())
    ways = net_ways(history, block)
    for m in range(positions):
        parts, book = cut[:, m], books[m]
        old = state.code[:, m].astype(np.int64)
        own = ((parts - book[old]) ** 2).sum(axis=1)  # exact distance to the entry held so far
        state.scanned += rows
        # every bound, carried from its own round to this one
        carried = state.bound[:, m].astype(np.float64) * (1 - MARGIN) - ways[state.stamp[:, m], m, np.arange(len(starts))]
        open_ = carried <= (np.sqrt(own.astype(np.float64)) * (1 + MARGIN))[:, None]
        best, code = own.copy(), old.copy()
        found: list = []
        for b, lo in enumerate(starts):
            at = np.nonzero(open_[:, b])[0]
            d = _squared(parts[at], book[lo : lo + block])
            state.scanned += d.size
            found.append((at, d))
            if len(at):
                near = d.argmin(axis=1)  # the lowest index of equals
                value = d[np.arange(len(at)), near]
                better = (value < best[at]) | ((value == best[at]) & (lo + near < code[at]))
                best[at[better]], code[at[better]] = value[better], lo + near[better]
        for b, (lo, (at, d)) in enumerate(zip(starts, found, strict=True)):
            inside = (code[at] >= lo) & (code[at] < lo + block)
            others = d.astype(np.float64)
            others[np.nonzero(inside)[0], code[at[inside]] - lo] = np.inf
            state.bound[at, m, b] = np.sqrt(others.min(axis=1))
            state.stamp[at, m, b] = now
            # a block that was not scanned gains the entry that the part leaves
            left = np.nonzero(~open_[:, b] & (old >= lo) & (old < lo + block) & (code != old))[0]
            state.bound[left, m, b] = np.minimum(carried[left, b], np.sqrt(own[left].astype(np.float64)))
            state.stamp[left, m, b] = now
        state.code[:, m], state.distance[:, m] = code, best
    return state


def entry_sums(cut: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums (positions x entries x components) and counts (positions x entries) of the parts of each entry; exact."""
    rows, positions, width = cut.shape
    place = code.astype(np.int64) + entries * np.arange(positions)
    sums = np.zeros((positions * entries, width), dtype=np.int64)
    np.add.at(sums, place.ravel(), cut.reshape(rows * positions, width))
    return sums, np.bincount(place.ravel(), minlength=positions * entries)


def next_codebook(books: np.ndarray, sums: Sequence[int], counts: Sequence[int]) -> np.ndarray:
    """Every entry becomes the mean of its parts, rounded down; without parts it stays. Whole numbers of any size."""
    positions, entries, width = books.shape
    flat = books.reshape(-1, width).copy()
    for at, n in enumerate(counts):
        if n:
            flat[at] = [int(sums[at * width + d]) // int(n) for d in range(width)]
    return flat.reshape(books.shape)


def usable_vector(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def compress_vectors(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """vec_id, label, code (binary, an entry's index for each part), error (squared distance summed over parts),
    codebooks_sha256; one row for each vector that takes part.

    Components become floor(256 * x). Codebooks start as the parts of the ``entries`` rows of smallest vec_id (fewer rows:
    fewer entries); each of ``rounds`` rounds assigns all parts and moves every entry to its parts' mean, rounded down; then parts are
    assigned a last time. Everything is exact in whole numbers, ties go to the lower index, so the order of rows has no effect.

    A row's state between rounds (its code, bounds and their rounds) is staged beside its vector in the session's shared folder; what a
    round replaces is removed. The tasks of a round send one row of sums each, and only codebooks and their sums reach the driver: a few
    thousand numbers whatever the table's size.

    Null vectors and those with null or non-finite components are left out, as are empty ones and those of another length than
    most have (the greater of equally frequent lengths counts). Null vec_ids come last; rows of equal vec_id go by their
    components. Repeated rows are rows of their own. A label column is carried on, other columns are ignored. An empty table gives no
    rows. Components so large that an error could exceed 64 bits (beyond 2**19 in vectors of 64) fail the job.
    """
    given = rows.where(usable_vector(F.col("embedding"))).select("vec_id", "label", "embedding")
    spark = rows.sparkSession
    lengths = given.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    types = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    if not lengths:
        empty = "vec_id {vec_id}, label {label}, code binary, error long, codebooks_sha256 string".format(**types)
        return spark.createDataFrame([], empty)
    dims = lengths[0]["d"]
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    if entries > 256 or rounds > 255:
        raise ValueError("codes and rounds are single bytes")
    width = dims // parts
    largest = math.isqrt((1 << 62) // dims) // 2  # a vector's error fits 64 bits
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    checked = F.transform(whole, lambda x: F.when(F.abs(x) <= largest, x).otherwise(F.raise_error(F.lit("a component is too large for exact codes"))))
    data = given.where(F.size("embedding") == dims).select("vec_id", "label", checked.cast("array<int>").alias("whole"))
    first = data.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).collect()
    history = [np.array([r["whole"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)]
    entries = len(first)
    blocks = -(-entries // block)
    kept = ["vec_id", "label", "whole"]
    shapes = {"code": (np.uint8, (parts,)), "bound": (np.float32, (parts, blocks)), "stamp": (np.uint8, (parts, blocks))}

    def step(history: list[np.ndarray], last: bool):
        def binary(a: np.ndarray) -> pa.Array:
            return pa.array([x.tobytes() for x in a], pa.binary())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts, none = 0, 0, None
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                cut = batch.column("whole").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)
                state = None
                if "code" in batch.schema.names:
                    held = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, *s) for c, (t, s) in shapes.items()}
                    state = State(distance=np.zeros((n, parts), np.int64), **held)
                state = assign(cut, history, state, block)
                own = [batch.column(c) for c in kept]
                if last:
                    yield pa.RecordBatch.from_arrays([*own[:2], binary(state.code), pa.array(state.distance.sum(axis=1))], ["vec_id", "label", "code", "error"])
                    continue
                more = entry_sums(cut, state.code, entries)
                sums, counts = sums + more[0], counts + more[1]
                arrays = [*own, *[binary(getattr(state, c)) for c in shapes], pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
                none = [pa.nulls(1, a.type) for a in arrays[:-2]]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *shapes, "sums", "counts"])
            if none is not None:
                tail = [pa.array([list(x)], pa.list_(pa.int64())) for x in (sums.ravel(), counts.ravel())]
                yield pa.RecordBatch.from_arrays([*none, *tail], [*kept, *shapes, "sums", "counts"])

        return run

    def added(states: DataFrame, column: str) -> list[int]:
        each = states.where("counts is not null").select(F.posexplode(column).alias("at", "x"))
        return [int(r["x"]) for r in each.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).orderBy("at").collect()]

    own_types = "vec_id {vec_id}, label {label}".format(**types)
    state_schema = f"{own_types}, whole array<int>, code binary, bound binary, stamp binary, sums array<long>, counts array<long>"
    states, places = data, []
    for _ in range(rounds):
        states, place = staged(states.mapInArrow(step(list(history), last=False), state_schema))
        history.append(next_codebook(history[-1], added(states, "sums"), added(states, "counts")))
        for done in places:  # the state before is not read again
            discard(spark, done)
        places = [place]
        states = states.where("counts is null").drop("sums", "counts")
    coded = states.mapInArrow(step(list(history), last=True), f"{own_types}, code binary, error long")
    digest = hashlib.sha256(",".join(map(str, history[-1].ravel().tolist())).encode()).hexdigest()
    return coded.withColumn("codebooks_sha256", F.lit(digest))
