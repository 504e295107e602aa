"""How far the sources of a language lie apart in their terms: partial divergences in cells of a three-dimensional cube."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harbormill.llm.common import checkpoint

LEAST_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000  # probabilities are whole multiples of one part in so many
GROUP_BLOCK = 32  # groups in a block; a cell holds two blocks of them
TERM_BLOCK = 2_048  # about so many terms in a block
HELD_TERMS = 200_000  # a task folds counts of about so many (group, term) before it sends them

# bytes of a term: ASCII letters, lower-cased, and all of characters beyond ASCII; others part terms
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TERM_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term, per group of documents.

    Each task folds its documents before anything is shuffled, so a group with a third of all rows is no hot spot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}  # (lang, source) -> (occurrences, documents)
        size = 0

        def folded() -> pa.RecordBatch:
            langs, sources, terms, n, docs = [], [], [], [], []
            for (lang, source), (times, held_by) in held.items():
                terms += times.keys()
                n += times.values()
                docs += [held_by[t] for t in times]
                langs += [lang] * len(times)
                sources += [source] * len(times)
            arrays = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string())]
            arrays += [pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                own = Counter(terms_of(text))
                times, held_by = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(times)
                times.update(own)
                held_by.update(own.keys())
                size += len(times)
                if size > HELD_TERMS:
                    yield folded()
                    held.clear()
                    size = 0
        if held:
            yield folded()

    counts = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * terms)), exact: the product can exceed 64 bits."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(11,0)")
    return F.call_function("div", above, (total + 2 * terms).cast("decimal(20,0)")).cast("long") + 1


def contribution(p, q):
    """floor((p - q)^2 / (p + q)); both lie between 1 and UNIT + 1, so the square fits 64 bits. Columns or arrays of long."""
    if isinstance(p, Column):
        return F.call_function("div", (p - q) * (p - q), p + q)
    return (p - q) ** 2 // (p + q)


def cell_sums(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
    """The work of a task: partial sums between two blocks of groups over one block of terms."""
    lang, a, b, _ = key
    slices = slices.sort_values("source", ignore_index=True)  # the smaller source first, in every cell
    # only terms that some group of the cell has; the others count the same for a pair, see pair_divergences
    held = [np.asarray(x, dtype=np.int64) for x in slices["terms"]]
    seen = np.unique(np.concatenate(held))
    p = np.repeat(slices["absent"].to_numpy(np.int64)[:, None], len(seen), axis=1)
    for n, (at, values) in enumerate(zip(held, slices["ps"], strict=True)):
        p[n, np.searchsorted(seen, at)] = np.asarray(values, dtype=np.int64)
    block, names = slices["block"].to_numpy(), slices["source"].to_numpy()
    left, right = np.nonzero(block == a)[0], np.nonzero(block == b)[0]
    x = np.concatenate([np.full(len(right) if a != b else np.sum(right > i), i) for i in left])
    y = np.concatenate([right if a != b else right[right > i] for i in left])
    sums = [contribution(p[i], p[j]).sum() for i, j in zip(x, y, strict=True)]
    columns = {"lang": np.full(len(x), lang, dtype=object), "x": names[x], "y": names[y]}
    return pd.DataFrame(columns | {"part": np.array(sums, dtype=np.int64), "seen": np.full(len(x), len(seen))})


def pair_divergences(groups: DataFrame, present: DataFrame, kept: DataFrame, group_block: int = GROUP_BLOCK) -> DataFrame:
    """(lang, x, y, value): the sum of contributions over all kept terms of the language, each pair of sources once.

    ``groups``: lang, source, absent (p of a term it lacks), terms (the language's kept terms), at (its number in the language),
    blocks (blocks of terms); ``present``: lang, source, term, p; ``kept``: lang, term, block, place (in the block).

    A cell owns (block of groups, block of groups, block of terms). The slices (group, block of terms) are replicated to
    the cells that need them, that is, once for each block of groups; partial sums are then added up along the axis of terms.
    Terms that no group of a cell has add the same amount to a pair each, which is their number times one contribution.
    """
    placed = present.join(kept, ["lang", "term"]).groupBy("lang", "source", "block")
    held = placed.agg(F.sort_array(F.collect_list(F.struct("place", "p"))).alias("held"))
    # a slice for every group and block, also without a term
    axis = groups.withColumn("term_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    slices = axis.join(held.withColumnRenamed("block", "term_block"), ["lang", "source", "term_block"], "left").select(
        "lang", "source", "absent", "term_block", "group_blocks", F.floor(F.col("at") / group_block).cast("int").alias("block"),
        F.coalesce(F.col("held.place"), F.expr("cast(array() as array<int>)")).alias("terms"),
        F.coalesce(F.col("held.p"), F.expr("cast(array() as array<bigint>)")).alias("ps"),
    )
    copies = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    cells = copies.select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "term_block", "block", "source", "absent", "terms", "ps"
    )
    parts = cells.groupBy("lang", "a", "b", "term_block").applyInPandas(cell_sums, "lang string, x string, y string, part long, seen long")
    sums = parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    p = groups.select("lang", "terms", F.col("source").alias("x"), F.col("absent").alias("px"))
    q = groups.select("lang", F.col("source").alias("y"), F.col("absent").alias("py"))
    unseen = contribution(F.col("px"), F.col("py")) * (F.col("terms") - F.col("seen"))
    return sums.join(p, ["lang", "x"]).join(q, ["lang", "y"]).select("lang", "x", "y", (F.col("part") + unseen).alias("value"))


def source_divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK
) -> DataFrame:
    """lang, source, part, item, value, rank: for each (lang, source) how far it lies from the other sources of its language
    (part ``pair``), and the terms that set it apart most from the language as a whole (part ``term``, ``top_terms`` of them).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the terms that
    ``least_docs`` of its documents hold. Probabilities are smoothed and scaled to whole numbers, and a term contributes
    floor((p - q)^2 / (p + q)), so sums are exact and do not depend on order. Ranks go by value, then by the item's UTF-8 bytes.

    Null text, lang and source read as ''. Groups without a term take part. A language without kept terms has pairs of
    value 0 and no term rows. Repeated rows are documents of their own. Other columns are ignored; an empty table gives no rows.
    """
    given = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # a window holds a term's row for each source of a language; most terms are rare and go here
    across = Window.partitionBy("lang", "term")
    counted = term_counts(given).withColumns({"all": F.sum("n").over(across), "held_by": F.sum("docs").over(across)})
    inside = checkpoint(counted.where(F.col("held_by") >= least_docs).select("lang", "source", "term", "n", "all"))
    kept = checkpoint(inside.groupBy("lang", "term").agg(F.max("all").alias("n")))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("total"))
    totals = inside.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    zero = F.lit(0).cast("long")
    groups = (
        given.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("own", "terms", "total")])
    )
    everyone = Window.partitionBy("lang")  # a row for each source of a language
    groups = checkpoint(
        groups.withColumns(
            {
                "absent": F.when(F.col("terms") > 0, probability(zero, F.col("own"), F.col("terms"))),
                "at": F.row_number().over(everyone.orderBy("source")) - 1,
                "group_blocks": F.ceil(F.count("*").over(everyone) / group_block).cast("int"),
                "blocks": F.ceil(F.col("terms") / term_block).cast("int"),
            }
        )
    )
    sized = kept.join(groups.select("lang", "blocks").distinct(), "lang")
    dealt = sized.select("lang", "term", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
    # about term_block rows in a window
    places = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")).cast("int"))
    present = inside.join(groups.select("lang", "source", "own", "terms", "total"), ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        probability(F.col("n"), F.col("own"), F.col("terms")).alias("p"),
        probability(F.col("all"), F.col("total"), F.col("terms")).alias("q"),
    )
    present = checkpoint(present)

    known = groups.where("terms > 0")
    once = pair_divergences(known, present.select("lang", "source", "term", "p"), places, group_block)
    both = once.unionAll(once.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), "value"))
    none = groups.where("terms = 0").select("lang", "source")
    empty = none.join(none.withColumnRenamed("source", "y"), "lang").where("source <> y").withColumn("value", zero)
    pairs = both.unionAll(empty.select("lang", F.col("source").alias("x"), "y", "value"))
    pairs = pairs.select("lang", F.col("x").alias("source"), F.lit("pair").alias("part"), F.col("y").alias("item"), "value")
    apart = present.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), contribution(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = apart.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionAll(ranked)
