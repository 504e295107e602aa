"""Vector codes against SQL and a plain scan; bounds that hold and save work; odd rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harbormill.llm import code_compression as cc
from harbormill.llm import queries


def plain_codes(rows, parts, entries, rounds):
    """{row: (code, error)}, digest: full scans in whole numbers; rows are (vec_id, label, vector) in order."""
    whole = [[math.floor(256 * float(x)) for x in v] for _, _, v in rows]
    width = len(whole[0]) // parts
    cut = [[w[m * width : (m + 1) * width] for m in range(parts)] for w in whole]
    books = [[list(cut[i][m]) for i in range(min(entries, len(rows)))] for m in range(parts)]

    def nearest(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e, strict=True)), n) for n, e in enumerate(book))

    for n in range(rounds + 1):
        found = [[nearest(c[m], books[m]) for m in range(parts)] for c in cut]
        if n == rounds:
            break
        for m in range(parts):
            for e in range(len(books[m])):
                own = [cut[i][m] for i, f in enumerate(found) if f[m][1] == e]
                if own:
                    books[m][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(bytes(c for _, c in f), sum(d for d, _ in f)) for f in found], digest


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def test_query_matches_sql(spark, sf_dir):
    from tools.verify import compare, oracle_connection

    assert compare(spark, oracle_connection(sf_dir), sf_dir, queries.op13_vector_codes, queries.OP13_SQL)[0] == "ok"


@pytest.mark.parametrize(("rounds", "block", "entries"), [(0, 4, 10), (1, 16, 10), (6, 3, 10), (4, 1, 200)])
def test_codes_match_a_plain_scan(spark, rounds, block, entries):
    rng = np.random.default_rng(rounds)
    centres = rng.normal(size=(9, 12))
    data = [(n, n % 3, (centres[n % 9] + 0.2 * rng.normal(size=12)).astype(np.float32).tolist()) for n in range(150)]
    data += [(200 + n, None, data[n][2]) for n in range(20)]  # copies: ties everywhere
    got = cc.compress_vectors(frame(spark, data).repartition(4), parts=4, entries=entries, rounds=rounds, block=block).collect()
    want, digest = plain_codes(data, 4, entries, rounds)
    assert {r["vec_id"]: (bytes(r["code"]), r["error"]) for r in got} == {d[0]: w for d, w in zip(data, want, strict=True)}
    assert {r["codebooks_sha256"] for r in got} == {digest} and {r["vec_id"]: r["label"] for r in got} == {d[0]: d[1] for d in data}


def test_bounds_hold_and_save_scans():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, size=(64, 4))
    cut = (centres[rng.integers(0, 64, 6000)] + rng.integers(-60, 60, size=(6000, 4)))[:, None, :].astype(np.int64)
    history, state, scans = [cut[:64].transpose(1, 0, 2).copy()], None, []
    for _ in range(6):
        state = cc.assign(cut, history, state, block=8)
        scans.append(state.scanned)
        full = cc._squared(cut[:, 0], history[-1][0])
        assert (state.code[:, 0] == full.argmin(axis=1)).all() and (state.distance[:, 0] == full.min(axis=1)).all()
        others = np.sqrt(full.astype(float))
        others[np.arange(len(cut)), state.code[:, 0]] = np.inf
        ways = cc.net_ways(history, 8)
        for b in range(8):
            bound = state.bound[:, 0, b] * (1 - cc.MARGIN) - ways[state.stamp[:, 0, b], 0, b]
            assert (bound <= others[:, 8 * b : 8 * b + 8].min(axis=1)).all()
        sums, counts = cc.entry_sums(cut, state.code, 64)
        history.append(cc.next_codebook(history[-1], sums.ravel().tolist(), counts.tolist()))
    assert scans[0] == 6000 * 65 and scans[-1] < 0.35 * scans[0]


def test_net_ways_are_shorter_than_summed_steps():
    there, back = np.array([[[0, 0]]]), np.array([[[30, 40]]])
    ways = cc.net_ways([there, back, there], 1)
    assert ways[:, 0, 0].tolist() == pytest.approx([0, 50, 0], rel=1e-5)  # summed steps: 100, 50, 0


def test_odd_rows(spark):
    good = [(n, n % 2, [float(n), -float(n), 0.1 * n, 1.0]) for n in range(12)] + [(3, None, [9.0, 9.0, 9.0, 9.0]), (None, 1, [5.0, 5.0, 5.0, 5.0])]
    bad = [(20, 1, None), (21, 1, []), (22, 1, [1.0, None, 1.0, 1.0]), (23, 1, [1.0, float("nan"), 1.0, 1.0]), (24, 1, [float("inf")] * 4), (25, 1, [1.0, 2.0])]
    df = frame(spark, good + bad).withColumn("code", F.lit("clash")).withColumn("whole", F.lit(1)).withColumn("sums", F.lit(2))
    got = cc.compress_vectors(df, parts=2, entries=6).collect()
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    want, digest = plain_codes(order, 2, 6, 2)
    assert sorted((str(r["vec_id"]), bytes(r["code"]), r["error"]) for r in got) == sorted((str(o[0]), *w) for o, w in zip(order, want, strict=True))
    assert got[0]["codebooks_sha256"] == digest
    assert cc.compress_vectors(df.limit(0)).collect() == []
    assert cc.compress_vectors(df.where("vec_id between 20 and 24")).collect() == []
    twice = cc.compress_vectors(frame(spark, good[:3] * 2), parts=2, entries=4).collect()
    assert len(twice) == 6 and len({(r["vec_id"], bytes(r["code"])) for r in twice}) == 3
    with pytest.raises(ValueError, match="equal parts"):
        cc.compress_vectors(frame(spark, good), parts=3)
    with pytest.raises(Exception, match="too large"):
        cc.compress_vectors(frame(spark, [*good, (50, 1, [1e30, 0.0, 0.0, 0.0])]), parts=2, entries=4).collect()


def test_label_error_puts_nulls_together(spark, sf_dir, tmp_path):
    rows = [(n, None if n % 3 == 0 else n % 3, [float(n % 7)] * 16) for n in range(30)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_vector_codes(spark, str(tmp_path)).collect()
    label = {r[0]: r[1] for r in rows}
    sums = {}
    for r in got:
        sums[label[r["vec_id"]]] = sums.get(label[r["vec_id"]], 0) + r["error"]
    assert len(got) == 30 and all(r["label_error"] == sums[label[r["vec_id"]]] for r in got)
