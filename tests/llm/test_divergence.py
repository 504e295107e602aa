"""The source divergence audit against SQL and plain Python, across cell boundaries, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from harbormill.llm import divergence, queries


def plain_audit(docs, least, top):
    """Rows as the operator returns them, from (lang, source, text), by the definition."""
    held, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        v = len(kept)
        whole = Counter()
        for s in names:
            whole.update({t: counts[lang, s][t] for t in kept})

        def share(c, terms=kept, v=v):
            total = sum(c[t] for t in terms)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * v) for t in terms}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        ps, q = {s: share(counts[lang, s]) for s in names}, share(whole)
        for s in names:
            pairs = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in names if o != s]
            terms = [(f(ps[s][t], q[t]), t) for t in kept if counts[lang, s][t] and ps[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def made_up(seed, n, sources=7, words=60):
    r = random.Random(seed)
    vocabulary = ["w" + "".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(words)] + ["Äh", "ß", "中文", "naïve"]
    docs = []
    for _ in range(n):
        source = f"s{min(r.randrange(sources * 2), sources - 1)}"
        own = vocabulary[int(source[1:]) :]
        docs.append((r.choice(["en", "de", None]), source, " ".join(r.choice(own).upper() if r.random() < 0.2 else r.choice(own) for _ in range(r.randrange(40)))))
    return docs


def test_query_matches_sql(spark, sf_dir):
    from tools.verify import compare, oracle_connection

    assert compare(spark, oracle_connection(sf_dir), sf_dir, queries.op12_source_divergence, queries.OP12_SQL)[0] == "ok"


@pytest.mark.parametrize(("group_block", "term_block"), [(32, 2048), (2, 7), (1, 1), (3, 1000)])
def test_every_cut_of_the_cube_gives_the_same_rows(spark, group_block, term_block):
    docs = made_up(1, 300)
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    got = divergence.source_divergence(df, least_docs=3, top_terms=4, group_block=group_block, term_block=term_block).collect()
    assert sorted(map(tuple, got)) == plain_audit(docs, 3, 4)


def test_terms_are_what_the_definition_says():
    r = random.Random(2)
    for _ in range(200):
        text = "".join(chr(r.choice([r.randrange(128), r.randrange(0x80, 0x3000), r.randrange(65, 91)])) for _ in range(80))
        lower = text.translate({c: c + 32 for c in range(65, 91)})
        assert [t.decode() for t in divergence.terms_of(text)] == re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)


def test_probabilities_beyond_64_bits(spark):
    count, total, terms = 40_000_000_000_000, 90_000_000_000_001, 123_456_789
    row = spark.range(1).select(divergence.probability(F.lit(count), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (count + 2) // (total + 2 * terms)


def test_odd_rows(spark, odd_documents):
    rows = [tuple(r) for r in odd_documents.select("lang", "source", "text").collect()]
    clash = odd_documents.withColumn("term", F.lit("x")).withColumn("value", F.lit(1)).withColumn("n", F.lit(2))
    assert sorted(map(tuple, divergence.source_divergence(clash, least_docs=2).collect())) == plain_audit(rows, 2, 10)
    # no language keeps a term: pairs of value zero, no term rows
    none = [tuple(r) for r in divergence.source_divergence(clash, least_docs=1000).collect()]
    assert sorted(none) == plain_audit(rows, 1000, 10)
    assert {r[2] for r in none} == {"pair"} and {r[4] for r in none} == {0}
    assert divergence.source_divergence(clash.limit(0)).count() == 0


def test_a_group_of_one_task_is_folded_before_it_is_sent(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    docs = made_up(3, 80)
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.source_divergence(df, least_docs=2).collect())) == plain_audit(docs, 2, 10)
