"""Every stage of the pipeline against brute force on its own input, and odd rows through all of them."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from harbormill.llm import secrets, simhash
from tests.llm.test_groups_and_vectors import brute_components, brute_lines
from tests.llm.test_text_operators import brute_spans


def staged(spark, docs, sf_dir, folder):
    """The stages as they are meant to run: each written as Parquet and read again."""
    seen = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/{n}"
        stage(spark, seen[-1], sf_dir).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def masked(text):
    out, at = [], 0
    for start, _, end in brute_spans(text, secrets.SCOPE):
        if start > at or not out and start == 0:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_each_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw, spoken, lined, single, safe, packed = staged(spark, docs, sf_dir, tmp_path)
    for df in (spoken, lined, single, safe):
        assert df.columns == docs.columns

    text = {df: {r["doc_id"]: r["text"] for r in df.collect()} for df in (raw, spoken, lined, single, safe)}
    assert text[spoken] == {d: t for d, t in text[raw].items() if any(c.isalpha() for c in t)}

    gone = {}
    for members in brute_lines(list(text[spoken].items()), 24, 0.8).values():
        for m in sorted(members, key=lambda m: (m[1], m[3]))[1:]:
            gone.setdefault(m[1], set()).add(m[3])
    assert text[lined] == {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ())) for d, t in text[spoken].items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())

    ids = sorted(text[lined])
    roots = brute_components([simhash.fingerprint(text[lined][d]) for d in ids])
    assert set(text[single]) == {ids[r] for r in roots}
    assert all(text[single][d] == text[lined][d] for d in text[single])

    assert text[safe] == {d: masked(t) for d, t in text[single].items()}

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    parts = {}
    for r in packed.collect():
        parts.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    assert set(parts) == set(text[safe])
    for d, t in text[safe].items():
        found = np.frombuffer(b"".join(p for _, p in sorted(parts[d])), dtype="<u4").tolist()
        assert found == [*tokenizer.encode(t, add_special_tokens=False).ids, 1]


def test_run_equals_the_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = staged(spark, docs, sf_dir, tmp_path)[-1]
    columns = ["doc_id", "doc_tokens"]
    rows = lambda df: sorted({tuple(r) for r in df.select(*columns).collect()})
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(packed)


def test_odd_rows_and_no_rows(spark, odd_documents, sf_dir, tmp_path):
    seen = staged(spark, odd_documents, sf_dir, tmp_path)
    assert all(df.columns == odd_documents.columns for df in seen[1:5])
    assert sorted({r["doc_id"] for r in seen[-1].collect()}, key=str) == sorted([1, None, 6, 7, 8], key=str)
    assert [df.count() for df in staged(spark, odd_documents.limit(0), sf_dir, tmp_path / "none")[1:]] == [0] * 5


def test_stages_keep_clashing_columns(spark, odd_documents, sf_dir, tmp_path):
    names = ["_own_score", "_own", "_ownlang_pred", "_key", "row", "kept_id", "kept_key", "key"]
    odd = odd_documents.withColumns({n: F.lit(n) for n in names})
    for df in staged(spark, odd, sf_dir, tmp_path)[1:5]:
        assert df.columns == odd.columns and df.count() > 0
        assert all(r[n] == n for r in df.select(*names).collect() for n in names)
