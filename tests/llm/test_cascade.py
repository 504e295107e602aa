"""The quality cascade against SQL, and its order, laziness and odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harbormill.llm import cascade, queries
from tests.llm.conftest import sentence

COUNTS = list(queries.OP11_REPORT)


def plain_counts(text):
    """By the contract's words, without the operator's helpers."""
    import re

    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_query_matches_sql(spark, sf_dir):
    from tools.verify import compare, oracle_connection

    assert compare(spark, oracle_connection(sf_dir), sf_dir, queries.op11_quality_cascade, queries.OP11_SQL)[0] == "ok"


def test_counts_of_odd_texts(spark):
    r = random.Random(4)
    texts = [None, "", " \n\t\x0b\f\r ", "a b c a b c a", "x x x x", "a\na\n a\n\n\na", "  é \x1c\x85", "# * $$ %&|<>", "ab" * 30_000]
    texts += [" ".join(r.choice(["a", "b", "é", "\n", "c#"]) for _ in range(r.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in cascade.quality_cascade(df, report=COUNTS).collect()}
    assert got == {n: plain_counts(t) for n, t in enumerate(texts)}


def test_odd_rows(spark, odd_documents):
    odd = odd_documents.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    good = odd.where("doc_id = 3").withColumn("text", F.lit(sentence(8, 80))).withColumn("doc_id", F.lit(9).cast("long"))
    odd = odd.unionByName(good)
    out = cascade.quality_cascade(odd, report=["n_words"])
    assert sorted(out.columns) == sorted(odd.columns) and out.schema["kept"].dataType.simpleString() == "boolean"
    rows = out.collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"] for r in rows if r["kept"]} == {9}
    assert all(r["n_words"] == 0 for r in rows if not (r["text"] or "").strip())
    assert cascade.quality_cascade(odd.limit(0)).count() == 0


def test_every_order_gives_the_same_verdict(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = sorted(cascade.quality_cascade(docs).select("doc_id", "kept").collect())
    shuffled = list(cascade.RULES)
    random.Random(3).shuffle(shuffled)
    assert sorted(cascade.quality_cascade(docs, shuffled, sample_rows=10).select("doc_id", "kept").collect()) == want
    good = {r["doc_id"] for r in want if r["kept"]}
    assert 0.5 * len(want) < len(good) < len(want)


def test_rejection_per_cost_decides():
    few, long, rare = cascade.RULES[0], cascade.RULES[1], cascade.RULES[2]
    rules = [rare, long, few]  # bits 0, 1, 2
    cost = {"coded": 1_000, "words": 10_000, "n_words": 100, "n_repeat_words": 1_000_000, "word_chars": 500}
    sample = [cascade.Estimate(0b000, 60, {k: 60 * v for k, v in cost.items()}), cascade.Estimate(0b110, 30, {k: 30 * v for k, v in cost.items()})]
    sample.append(cascade.Estimate(0b010, 10, {k: 10 * v for k, v in cost.items()}))
    assert cascade.ordered(rules, sample) == [few, long, rare]
    # once repeats are there anyway, the rule on them rejects more for nothing
    assert cascade.ordered(rules, sample, made=["n_repeat_words"])[0] == long
    assert cascade.ordered(rules, []) == rules


def test_later_rules_are_not_measured_for_rejected_texts(monkeypatch):
    text = cascade.Text("too short")
    assert any(map(text.breaks, cascade.RULES))
    assert "n_repeat_words" not in text.made and "n_words" in text.made


@pytest.mark.parametrize(
    ("rule", "bad"),
    [
        ("few words", sentence(1, 49)),
        ("repeats", "one two three " * 40),
        ("word length", sentence(1, 60).replace(" ", "x" * 12 + " ")),
        ("symbols", sentence(1, 60) + " ###" * 3),
        ("words without letters", sentence(1, 60) + " " + " ".join(map(str, range(20)))),
        ("repeated lines", sentence(1, 60) + "\nsame line" * 5),
        ("cut lines", sentence(1, 60) + "...\n" + sentence(2, 5)),
        ("bullets", "\n".join("- " + sentence(n, 6) for n in range(12))),
    ],
)
def test_each_rule_rejects(spark, rule, bad):
    assert [r.name for r in cascade.RULES if cascade.Text(bad).breaks(r)].count(rule) == 1
    assert not any(map(cascade.Text(sentence(1, 60) + "\n" + sentence(2, 30)).breaks, cascade.RULES))
