"""Near-duplicates by SimHash; candidates from Golay-decoded segments of the fingerprint."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.llm.common import checkpoint, connected_components, discard, staged

SHINGLE = 4
SEED = 42
MAX_BITS = 4

# Three segments (first bit, bits) of a fingerprint, each read as a word of the
# binary Golay code of length 23, whose 4096 codewords differ in 7 bits at least
# and lie within 3 bits of every word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Fixed value: the code's generator polynomial, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome: the words modulo the generator."""
    words = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        words = np.where((words >> bit) & 1, words ^ (GENERATOR << (bit - CHECKS)), words)
    return words


def _errors() -> np.ndarray:
    """Per syndrome the error patterns that lead to a codeword: the lightest first, then those of weight 4.

    The code is perfect: a syndrome has one pattern of weight 3 or less. If that
    weighs 3, five patterns of weight 4 share the syndrome, else none does; missing
    places repeat the first.
    """
    from itertools import combinations

    by_syndrome: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        patterns = np.array([sum(1 << i for i in c) for c in combinations(range(LENGTH), weight)], dtype=np.int64)
        for p, s in zip(patterns.tolist(), _remainder(patterns).tolist(), strict=True):
            by_syndrome[s].append(p)
    width = max(map(len, by_syndrome))
    return np.array([row + row[:1] * (width - len(row)) for row in by_syndrome], dtype=np.int64)


ERRORS = _errors()


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords near each word, the nearest in the first column.

    Two words that differ in one bit share a codeword that is the nearest of one
    and stands in the row of the other: the nearest of the one lies within 3 bits of it,
    so within 4 of the other, and rows list all codewords within 4 bits unless one
    within 2 bits is found, which is then nearest to both.
    """
    words = words.astype(np.int64)
    return (words[:, None] ^ ERRORS[_remainder(words)]) >> CHECKS


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each set if it is set in over half the shingles' hashes."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(words[i : i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bounded memory for very long texts
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (hash of the text) and fp (64 bits as a signed long) of every whole text."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["text_key"], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    return rows.mapInArrow(run, schema)


# Sides of a key: rows of LEFT meet rows of RIGHT, rows of BOTH meet each other.
LEFT, RIGHT, BOTH = 0, 1, 2


def candidate_keys(fps: DataFrame) -> DataFrame:
    """fp -> (fp, key, side), such that fingerprints with up to 4 differing bits share a key.

    Four errors over three segments leave either a segment without error, whose
    plain bits are then a key, or two segments with one error each and two errors at most in the
    third. In that case both segments share a codeword and both change their parity, and one of
    three blocks of the third segment has no error. The key is the pair of codewords with the
    parity of the second segment and such a block; the parity of the first decides the side.
    The even side lists the nearest codeword of the first segment with all near ones of the
    second, the odd side the reverse, so 6 rows a pair of segments and block do for 36, and
    fingerprints of one side are no candidates for each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy()
            bits = signed.view(np.uint64)
            words = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            near = [golay_keys(w) for w in words]
            odd = [np.bitwise_count(w) % 2 == 1 for w in words]
            out = [(signed, (i << 40) | w, BOTH) for i, w in enumerate(words)]
            for n, (i, j, rest) in enumerate(((0, 1, 2), (0, 2, 1), (1, 2, 0)), start=3):
                blocks = [(words[rest] >> (7 * b)) & (0xFF if b == 2 else 0x7F) for b in range(3)]
                for side in (LEFT, RIGHT):
                    some = np.nonzero(odd[i] == (side == RIGHT))[0]
                    one, all_of = (near[i], near[j]) if side == LEFT else (near[j], near[i])
                    # rows of near codewords that are shorter than the widest repeat the nearest
                    row, column = np.nonzero((all_of[some] != all_of[some, :1]) | (np.arange(all_of.shape[1]) == 0))
                    row = some[row]
                    c, d = (one[row, 0], all_of[row, column]) if side == LEFT else (all_of[row, column], one[row, 0])
                    parity = (odd[j][row] ^ (side == RIGHT)).astype(np.int64)
                    pair = (n << 40) | (parity << 24) | (c << 12) | d
                    out += [(signed[row], pair | (b << 36) | (block[row] << 26), side) for b, block in enumerate(blocks)]
            fp, key = (np.concatenate([o[k] for o in out]) for k in (0, 1))
            sides = np.repeat(np.array([o[2] for o in out], dtype=np.int32), [len(o[0]) for o in out])
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(key), pa.array(sides)], ["fp", "key", "side"])

    return fps.mapInArrow(run, "fp long, key long, side int")


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> (fp, root): components of the links at ``max_bits`` bits or less.

    Two passes keep a dense group, as a text with thousands of near copies makes, from
    being paired with itself. First each fingerprint is linked to the next one under the
    same plain segment, in order of value, where that is near enough: as many rows as
    there are keys. Then pairs are made under all keys, but only where at least one side lies
    outside the key's most frequent component so far, and only between components. The
    rest of the pairs could add nothing. Both passes verify the distance in bits.
    """
    from pyspark.sql import Window

    if max_bits > MAX_BITS:
        raise ValueError(f"the segments find up to {MAX_BITS} differing bits")
    keys, place_of_keys = staged(candidate_keys(fps))  # fingerprints repeat, so columns take a fraction of rows' space
    order = Window.partitionBy("key").orderBy("fp")
    chain = (
        keys.where(F.col("side") == BOTH)
        .select("fp", F.lead("fp").over(order).alias("next"))
        .where(F.col("next").isNotNull() & (_bits_apart("fp", "next") <= max_bits))
        .select(F.col("fp").alias("src"), F.col("next").alias("dst"))
    )
    chain = checkpoint(chain)
    first = connected_components(chain).withColumnRenamed("node", "fp")
    known = keys.join(first, "fp", "left").select("fp", "key", "side", F.coalesce("root", F.xxhash64("fp")).alias("root"))
    known, place_of_known = staged(known)
    discard(fps.sparkSession, place_of_keys)
    two_sided = (F.min("side") != F.max("side")) | (F.min("side") == BOTH)
    mixed = known.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), two_sided.alias("both")).where("lo <> hi and both").select("key")
    live = known.join(mixed, "key")
    frequent = (
        live.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("root", "n").alias("frequent"))
    )
    outside = live.join(frequent, "key").where("root <> frequent").select("key", "side", "root", "fp")
    a, b = outside.alias("a"), live.select("key", "side", "root", "fp").alias("b")
    found = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.root") != F.col("b.root"))
        & ((F.col("a.side") != F.col("b.side")) | (F.col("a.side") == BOTH))
        & (_bits_apart("a.fp", "b.fp") <= max_bits),
    ).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    found = checkpoint(found)
    discard(fps.sparkSession, place_of_known)
    return connected_components(chain.unionByName(found)).withColumnRenamed("node", "fp")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, text_key, fp, component_id (least doc_id reachable by links), group.

    Documents link where their fingerprints differ in ``max_bits`` bits or less. Words are
    parted by ASCII white space with A-Z lower-cased; a text with fewer words than a shingle
    is one shingle; a null text, or one without words, has fingerprint zero and links like
    any other. Equal fingerprints are folded before any candidate is made. ``group`` names
    the component by one of its fingerprints, for groups in which every doc_id is null, whose
    component_id is null. Repeated rows give repeated rows. Other columns are ignored; an
    empty table gives no rows.
    """
    prints = checkpoint(with_fingerprints(docs, shingle))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = fingerprint_components(distinct.select("fp"), max_bits)
    named = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", F.xxhash64("fp")).alias("group"))
    named = checkpoint(named)
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = checkpoint(named.select("fp", "group").join(least, "group"))
    return prints.join(classes, "fp").select("doc_id", "text_key", "fp", "component_id", "group")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of every group: that of least doc_id, then of least text hash.

    Of repeated rows one stays. The columns stay as they are, whatever their names; an empty table gives no rows.
    """
    groups = simhash_groups(docs, shingle, max_bits)
    keep = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("group")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
        .select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"))
    )
    # the row in a struct, so that no column of it can clash
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.xxhash64("text").alias("key"))
    same = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    return rows.join(keep, same).dropDuplicates(["kept_id", "kept_key"]).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
