"""Near-duplicates of texts, lines and vectors, nearest vectors, components, against brute force."""

from __future__ import annotations

import itertools
import pathlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harbormill.llm import common, embedding_dedup, hnsw, lines, multi_index, queries, simhash
from tests.llm.conftest import sentence


def union(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def classes(names, roots):
    out = {}
    for name, root in zip(names, roots, strict=True):
        out.setdefault(root, set()).add(name)
    return sorted(map(sorted, out.values()))


# --- components ---


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(100)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    edges += [(5, 5), (7, 7), (9000, 9000)]
    r = random.Random(1)
    edges += [(r.randrange(3000, 3300), r.randrange(3000, 3300)) for _ in range(150)]
    got = common.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    at = {x: n for n, x in enumerate(nodes)}
    want = union(len(nodes), [(at[a], at[b]) for a, b in edges if a != b])
    assert classes([r["node"] for r in got], [r["root"] for r in got]) == classes(nodes, want)
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# --- SimHash ---


def brute_components(fps: list[int], bits: int = 4) -> list[int]:
    f = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= bits
    return union(len(f), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)])


def test_golay_neighbours_share_a_key():
    rng = np.random.default_rng(0)
    words = np.concatenate([rng.integers(0, 1 << 23, 5_000), [0, (1 << 23) - 1]])
    keys = simhash.golay_keys(words)
    for bit in range(23):
        other = simhash.golay_keys(words ^ (1 << bit))
        assert (keys[:, :1] == other).any(axis=1).all() and (other[:, :1] == keys).any(axis=1).all()


def test_every_pair_within_four_bits_is_linked(spark):
    """All splits of up to four errors over the segments, and a dense group whose members mostly link to each other."""
    rng = np.random.default_rng(1)
    fps = []
    for _ in range(150):
        base = int(rng.integers(0, 1 << 63))
        flips = rng.permutation(64)[: rng.integers(1, 7)]
        fps += [base, base ^ sum(1 << int(b) for b in flips)]
    dense = int(rng.integers(0, 1 << 63))
    fps += [dense ^ sum(1 << int(b) for b in rng.permutation(64)[: rng.integers(0, 6)]) for _ in range(300)]
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got = {r["fp"]: r["root"] for r in simhash.fingerprint_components(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    want = [c for c in classes(signed, brute_components(fps)) if len(c) > 1]
    assert [c for c in classes(list(got), list(got.values())) if len(c) > 1] == want


def test_fingerprint_is_what_the_contract_says():
    import xxhash

    text = "The QUICK\tbrown  fox\njumps ÄÖ over"
    words = "the quick brown fox jumps ÄÖ over".split(" ")
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 4)
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("one two") == xxhash.xxh64_intdigest(b"one two", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_simhash_query(spark, sf_dir):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    fps = [simhash.fingerprint(t) for _, t in docs]
    roots = brute_components(fps)
    want = {(d, f"{f:016x}", docs[r][0]) for (d, _), f, r in zip(docs, fps, roots, strict=True)}
    assert {tuple(r) for r in queries.op6_simhash(spark, sf_dir).collect()} == want


def test_simhash_of_odd_rows(spark, odd_documents):
    rows = simhash.simhash_groups(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    zero = [r for r in rows if r["fp"] == 0]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    kept = simhash.keep_one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 1, 2, 5, 6, 7, 8]
    assert simhash.simhash_groups(odd_documents.limit(0)).count() == 0
    assert simhash.keep_one_of_each(odd_documents.limit(0)).count() == 0


def test_candidate_keys_take_little_space(spark, monkeypatch):
    """Keys and known components are compressed columns, and gone once the links are found."""
    places, held = [], []
    stage, drop = simhash.staged, simhash.discard

    def staging(df):
        out, place = stage(df)
        files = [f for f in pathlib.Path(place.removeprefix("file:")).rglob("*.parquet")]
        places.append(place)
        held.append((out.count(), sum(f.stat().st_size for f in files)))
        return out, place

    monkeypatch.setattr(simhash, "staged", staging)
    monkeypatch.setattr(simhash, "discard", lambda s, place: (drop(s, place), places.remove(place)))
    fps = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 20_000).tolist()
    simhash.fingerprint_components(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert len(held) == 2 and not places
    assert all(rows > 40 * len(fps) and size < 16 * rows for rows, size in held), held


# --- lines ---


def brute_shingles(line, chars):
    """At every offset of the whole line; a shorter line is one shingle."""
    return {line[i : i + chars] for i in range(max(1, len(line) - chars + 1))}


def brute_lines(docs, chars, similarity):
    """Components of lines: root -> (doc_id is known, doc_id, text, line number) of each."""
    place = {}
    for doc, text in set(docs):
        for n, raw in enumerate([] if text is None else text.split("\n")):
            line = " ".join(raw.lower().split())
            if line:
                place.setdefault(line, []).append((doc is not None, doc or 0, text, n))
    names = list(place)
    sets = [brute_shingles(x, chars) for x in names]
    holders = {}
    for n, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(n)
    meet = {pair for found in holders.values() for pair in itertools.combinations(found, 2)}
    pairs = [(a, b) for a, b in meet if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    groups = {}
    for name, root in zip(names, union(len(names), pairs), strict=True):
        groups.setdefault(root, []).extend(place[name])
    return groups


def check_lines(docs, rows, chars=lines.SHINGLE_CHARS, similarity=lines.SIMILARITY):
    groups = brute_lines(docs, chars, similarity)
    want = {}
    for members in groups.values():
        ids = {m[1] for m in members}
        first = min(m[1] for m in members)
        # between texts of one doc_id the hash of the text decides, which the callers avoid
        keep = min((m for m in members if m[1] == first), key=lambda m: m[3])
        for m in members:
            if m != keep:
                want.setdefault(m[1], set()).add(m[3])
        assert len(ids) >= 1
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).update(r["removed"])
    assert got == want


def edited(line: str, seed: int, times: int) -> str:
    r = random.Random(seed)
    words = line.split(" ")
    for _ in range(times):
        words[r.randrange(len(words))] = "changed"
    return " ".join(words)


def test_lines_match_brute_force(spark):
    base = [sentence(s, 60) for s in range(12)]
    docs = [(n, "\n".join([base[n % 12], sentence(100 + n, 30), "short one", ""])) for n in range(30)]
    docs += [(100 + n, "\n".join([edited(base[n % 12], n, 1), sentence(200 + n, 20).upper()])) for n in range(40)]
    docs += [(200, base[0].upper().replace(" ", "   ") + "\n" + base[0] + "\n" + base[0])]
    shared = sentence(999, 55)  # a passage inside lines that are otherwise different
    docs += [(300 + n, sentence(300 + n, 60) + " " + shared + " " + sentence(400 + n, 60)) for n in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("band", F.lit("clash"))
    check_lines(docs, lines.repeated_lines(df).collect())


def test_line_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op5_line_dedup(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    parsed = [{"doc_id": r["doc_id"], "removed": [int(x) for x in r["removed"].split(",")]} for r in rows if r["removed"]]
    check_lines(docs, parsed)
    by_id = dict(docs)
    assert all(r["n_lines"] == by_id[r["doc_id"]].count("\n") + 1 for r in rows)


def test_lines_of_odd_rows(spark, odd_documents):
    out = lines.without_repeated_lines(odd_documents)
    assert out.columns == odd_documents.columns
    before = sorted(odd_documents.select("doc_id", "text").collect(), key=repr)
    assert sorted(out.select("doc_id", "text").collect(), key=repr) == before
    assert lines.without_repeated_lines(odd_documents.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, sentence(1, 20) + "\nkeep\n" + sentence(1, 20) + "\n"), (2, sentence(1, 20)), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.without_repeated_lines(twice).collect()}
    assert got == {1: sentence(1, 20) + "\nkeep\n", 2: "", 3: None}


def test_lines_are_compared_as_a_whole(spark):
    """Lines without spaces, lines that differ at their ends only, and copies of short lines."""
    r = random.Random(11)

    def signs(alphabet, n):
        return "".join(r.choice(alphabet) for _ in range(n))

    head = "https://host.example/a/b/c/"
    cjk = [chr(0x4E00 + n) for n in range(500)]
    texts = [head + signs("0123456789abcdef", 60) for _ in range(10)]
    texts += [signs(cjk, 24) + signs(cjk, 60) for _ in range(3)] + ["漢字" * 15 + signs(cjk, 60) for _ in range(5)]
    long = head + signs("0123456789abcdef", 400)
    texts += [long, long[:-1] + "!", "!" + long, long[:200] + "!" + long[201:]]
    texts += ["responsibilities of the manager", "responsibilities of the members", "-" * 40, "-" * 400, "=" * 40 + "-"]
    shared = sentence(6, 14)
    texts += [f"{shared} 00123456 5511992", f"{shared} 99887766 8844003"]
    texts += ["Read more", "  read   MORE ", "Read most", "x", "X", " ", ""]
    want = set()
    for members in brute_lines(list(enumerate(texts)), 24, 0.8).values():
        want |= {m[1] for m in members} - {min(m[1] for m in members)}
    got = lines.repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == want
    assert texts.index("x") + 1 in want and not {len(texts) - 1, len(texts) - 2} & want
    assert texts.index(f"{shared} 99887766 8844003") not in want


def test_short_lines_are_compared(spark):
    """Lines around and below the length of a shingle: similar ones are linked, by short shingles, also with longer lines."""
    r, texts = random.Random(8), []
    for n in range(60):
        line = "".join(r.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(r.choice([12, 18, 21, 22, 23, 24, 26])))
        line = " ".join(line.split())
        texts += [line, line[1:], line + "!", line[: len(line) // 2] + "_" + line[len(line) // 2 + 1 :]]
    texts += ["Subscribe to the news", "subscribe to the  news.", "-" * 12, "-" * 40, "=" * 23, "=" * 24 + "-", "İ" * 4, "İ" * 3, "ab", "abc", "abcd", "abcde"]
    names = [" ".join(t.lower().split()) for t in texts]
    sets = {chars: [brute_shingles(x, chars) for x in names] for chars in (5, 24)}
    pairs = []
    for a, b in itertools.combinations(range(len(names)), 2):
        x, y = (sets[24 if min(len(names[a]), len(names[b])) >= 24 else 5][n] for n in (a, b))
        if names[a] == names[b] or min(len(names[a]), len(names[b])) >= 5 and len(x & y) >= 0.8 * len(x | y):
            pairs.append((a, b))
    lengths = [sorted((len(names[a]), len(names[b]))) for a, b in pairs if names[a] != names[b]]
    assert sum(b < 24 for _, b in lengths) > 60 and sum(a < 24 <= b for a, b in lengths) > 10
    want = {n for n, root in enumerate(union(len(names), pairs)) if n != root}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x["doc_id"] for x in lines.repeated_lines(df).collect()} == want
    at = texts.index("-" * 40)
    assert {texts.index("subscribe to the  news."), at} <= want and texts.index("abcde") not in want


def test_families_that_touch_through_done_lines(spark, monkeypatch):
    """Chains L~a~b~M with copies of L and M in a single band: no link between lines of a band may be lost."""
    monkeypatch.setattr(lines, "BANDS", 1)
    monkeypatch.setattr(lines, "ROWS", 1)
    monkeypatch.setattr(lines, "MOST_APART", lines.FUNCTIONS)
    docs = []
    for n in range(150):
        words = sentence(5_000 + n, 70).split(" ")
        # a changed word takes some 29 of 400 shingles, so only neighbours in the chain are similar
        for step in range(4):
            line = " ".join([f"other{n}" if at in (10, 30, 50)[:step] else w for at, w in enumerate(words)])
            docs += [(len(docs) + k, line) for k in range(3 if step in (0, 3) else 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    signed = lines.signed_lines(df, 24)
    rows = {r["h"]: r["bands"][0] for r in signed.where(F.size("bands") > 0).collect()}
    text = {lines.line_hash(lines.normalised(t)): lines.normalised(t) for _, t in docs}
    names = sorted(rows)
    sets = {h: brute_shingles(text[h], 24) for h in names}
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(names)), 2)
        if rows[names[a]] == rows[names[b]] and len(sets[names[a]] & sets[names[b]]) >= 0.8 * len(sets[names[a]] | sets[names[b]])
    ]
    assert len(pairs) > 100
    want = [c for c in classes(names, union(len(names), pairs)) if len(c) > 1]
    found = lines.similar_lines(df, signed, 24, 0.8).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    got = common.connected_components(found).collect()
    assert classes([r["node"] for r in got], [r["root"] for r in got]) == want


def test_recall_of_lines_at_the_threshold(spark):
    """Pairs of lines edited in place, near 0.8: found ones are exact, and nine in ten are found."""
    docs, r = [], random.Random(21)
    for n in range(400):
        base = sentence(9_000 + n, 60)
        cut = r.randrange(len(base) - 80)
        width = r.randrange(1, 45)
        docs += [(2 * n, base), (2 * n + 1, base[:cut] + "#" * width + base[cut + width :])]
    sets = {d: brute_shingles(" ".join(t.lower().split()), 24) for d, t in docs}
    alike = {n for n in range(400) if len(sets[2 * n] & sets[2 * n + 1]) >= 0.8 * len(sets[2 * n] | sets[2 * n + 1])}
    gone = {x["doc_id"] // 2 for x in lines.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert gone <= alike and len(gone) >= 0.95 * len(alike) and 100 < len(alike) < 390


def test_no_pair_is_lost_at_the_threshold(spark):
    """A thousand pairs of lines just above 0.8: none is missed."""
    docs, near, r = [], 0, random.Random(77)
    for n in range(1_000):
        base = sentence(50_000 + n, 60)
        cut, width = r.randrange(30, len(base) - 80), len(base) // 9 - 27
        docs += [(2 * n, base), (2 * n + 1, base[:cut] + "#" * width + base[cut + width :])]
        x, y = (brute_shingles(t.lower(), 24) for _, t in docs[-2:])
        assert len(x & y) >= 0.8 * len(x | y)
        near += len(x & y) < 0.82 * len(x | y)
    gone = {x["doc_id"] for x in lines.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert near > 500 and gone == set(range(1, 2_000, 2))


def test_family_of_lines_below_the_threshold(spark, monkeypatch):
    """Lines edited in several places, most pairs of them at 0.6 to 0.75: few pairs are compared, no link of the family is lost."""
    base = sentence(31, 90)
    family = []
    for n in range(150):
        r = random.Random(n)
        line = base
        for _ in range(2):
            at = r.randrange(len(line) - 10)
            line = line[:at] + "".join(r.choice("abcdefgh") for _ in range(3)) + line[at + 3 :]
        family.append(line)
    compared = []
    similar = lines.similar_pairs

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(lines, "similar_pairs", counted)
    docs = list(enumerate(family))
    rows = lines.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    sets = [brute_shingles(x, 24) for x in family]
    near = [len(a & b) / len(a | b) for a, b in itertools.combinations(sets, 2)]
    check_lines(docs, rows)
    assert sum(0.6 <= x < 0.75 for x in near) > 10_000 and sum(compared) < 4_000


def test_outlines_reject_no_similar_pair(spark):
    """Pairs of lines of very different lengths and likeness, also with shingles that stand in a line often."""
    r, pairs = random.Random(5), []
    for n in range(200):
        line = sentence(20_000 + n, r.choice([8, 30, 60, 120]))
        pairs += [(line, edited(line, n, 1)), (line, edited(line, n, 3)), (line, f"{line} {sentence(n, 3)}"), (line, sentence(n, 40))]
    pairs += [("-" * a, "-" * b) for a, b in itertools.product([24, 40, 400, 4000], repeat=2)]
    pairs += [("ab" * a, "ab" * b + c) for a, b, c in itertools.product([12, 40, 900], [12, 40, 900], ["", "a", "c" * 40])]
    sides = []
    for n, line in enumerate(x for pair in pairs for x in pair):
        w, counts = lines.shingle_hashes([line], 24)
        marks, size = lines.outlines(w, counts)
        assert len(marks) == size[0] and int(counts[0]) == len(line) - 23
        sides.append((n // 2, n % 2, int(counts[0]), marks.tolist()))
    df = spark.createDataFrame(sides, "pair int, side int, offsets long, outline array<long>")
    x, y = df.where("side = 0").alias("x"), df.where("side = 1").alias("y")
    passed = {row["pair"] for row in x.join(y, (F.col("x.pair") == F.col("y.pair")) & lines._within("x", "y", 0.8)).select("x.pair").collect()}
    sets = [(brute_shingles(a, 24), brute_shingles(b, 24)) for a, b in pairs]
    alike = {n for n, (a, b) in enumerate(sets) if len(a & b) >= 0.8 * len(a | b)}
    assert len(alike) > 150 and alike <= passed
    far = {n for n, (a, b) in enumerate(sets) if len(a & b) < 0.5 * len(a | b) and max(len(a), len(b)) < 2 * min(len(a), len(b))}
    assert len(far) > 100 and not far & passed


def test_lines_around_a_common_passage(spark, monkeypatch):
    """Lines that share most of their text, all pairs at 0.7 to 0.78: few are compared."""
    passage, docs = sentence(41, 75), []
    for n in range(200):
        line = f"{sentence(30_000 + n, 30)[: round(len(passage) * 0.16)]} {passage}"
        docs += [(2 * n, line)] if n else [(2 * n, line), (2 * n + 1, line + "!")]
    compared = []
    similar = lines.similar_pairs

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(lines, "similar_pairs", counted)
    rows = lines.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    sets = [brute_shingles(" ".join(t.lower().split()), 24) for _, t in docs]
    near = [len(a & b) / len(a | b) for a, b in itertools.combinations(sets, 2)]
    check_lines(docs, rows)
    assert sum(0.7 <= x < 0.78 for x in near) > 0.99 * len(near) and sum(compared) < 4_000


# --- vectors ---


def brute_vectors(rows, threshold):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(good)), 2)
        if len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] / np.linalg.norm(good[a][1]) / np.linalg.norm(good[b][1]) >= threshold
    ]
    degree = np.bincount(np.array(pairs, dtype=int).ravel(), minlength=len(good))
    roots = union(len(good), pairs)
    least = {}
    for (i, _), r in zip(good, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    out = [(i, int(d), least[r], i == least[r]) for (i, _), d, r in zip(good, degree, roots, strict=True)]
    known = {i for i, _ in good}
    return sorted(out + [(i, 0, i, True) for i, _ in rows if i not in known])


def vectors(n, seed=0, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = [rng.normal(size=d) for _ in range(n)]
    rows += [c + rng.normal(size=d) * s for c, s in zip(centres, np.linspace(0.02, 0.3, 12), strict=True) for _ in range(25)]
    rows += [rows[0]] * 5 + [rows[1] * 7.5]
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def test_vector_groups_match_brute_force(spark):
    rows = vectors(300)
    n = len(rows)
    nan, inf = float("nan"), float("inf")
    rows += [(n, None), (n + 1, [0.0] * 16), (n + 2, [nan] * 16), (n + 3, [1.0, None] * 8), (n + 4, [inf] * 16), (n + 5, []), (n + 6, [1.0, 2.0]), (n + 7, [1.0, 2.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("weight", F.lit("clash"))
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicate_vectors(df, shard_rows=200, block_rows=128).collect())
    assert got == brute_vectors(rows, 0.95)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_rare_links_are_not_lost_where_no_audited_query_has_one(monkeypatch):
    """A search that misses the closest row of half the queries at the first beam, and finds nine tenths of the nearest rows."""

    def search(matrix, levels, asked, beam):
        sims = asked @ matrix.T
        order = np.argsort(-sims, axis=1)[:, : beam + 1]
        missed = (asked[:, 0] > 0) & (beam == embedding_dedup.BEAM)
        found = np.where(missed[:, None], order[:, 1:], order[:, :-1])
        return found, np.take_along_axis(sims, found, axis=1)

    monkeypatch.setattr(embedding_dedup, "search", search)
    r = np.random.default_rng(2)
    matrix, queries = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (r.normal(size=(2_000, 24)), r.normal(size=(1_000, 24))))
    planted = np.random.default_rng(5).permutation(1_000)[embedding_dedup.AUDITED :][:20]
    queries[planted] = matrix[:20]
    q, r = embedding_dedup.linked(matrix, [], queries, 0.95, seed=5)
    assert sorted(zip(q.tolist(), r.tolist(), strict=True)) == sorted(zip(planted.tolist(), range(20), strict=True))


def test_vector_links_through_the_graph():
    """A shard large enough that beams, not scans, find the links; one group is larger than the first beams."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(4_000, 24))
    m[:300] = m[0] + rng.normal(size=(300, 24)) * 0.1
    m[300:500] = np.repeat(m[300:400], 2, axis=0) + rng.normal(size=(200, 24)) * 0.05
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    levels = hnsw.build(m.astype(np.float32))
    q, r = embedding_dedup.linked(m, levels, m[:1_000], 0.95, seed=0)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(m[:1_000] @ m.T >= 0.95), strict=True)}
    got = set(zip(q.tolist(), r.tolist(), strict=True))
    assert got <= want and len(got) == len(q) and len(got) >= 0.999 * len(want)


def test_a_shard_is_sent_once_for_many_blocks(spark, monkeypatch):
    """One copy of a graph for up to PART_BLOCKS blocks, none of them by explode, which holds all copies of a row in the heap; rows of
    another length in the same shards; a task's pairs come a few queries at a time."""
    rows = vectors(700, seed=4)
    n = len(rows)
    rows += [(n + i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(6).normal(size=(90, 3)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cut, plans = embedding_dedup.checkpoint, []
    monkeypatch.setattr(embedding_dedup, "PART_BLOCKS", 4, raising=False)
    monkeypatch.setattr(embedding_dedup, "checkpoint", lambda x: plans.append(x) or cut(x))

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = sorted(tuple(r) for r in embedding_dedup.near_duplicate_vectors(df, shard_rows=300, block_rows=64).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_vectors(rows, 0.95)
    made = [node for x in plans for node in nodes(x._jdf.queryExecution().optimizedPlan()) if node.nodeName() == "Generate"]
    assert made and not [node for node in made if "graph" in node.output().mkString(",")]
    same, asked = np.ones((500, 4)) / 2, np.ones((700, 4)) / 2
    pieces = list(embedding_dedup.link_pieces(same, same.astype(np.float32), [], asked, 0.95, 0))
    assert sum(len(q) for q, _ in pieces) == 700 * 500 and max(len(q) for q, _ in pieces) <= hnsw.CHUNK * 500


def test_repeated_vec_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [1.0, 0.0]), (3, [0.0, 1.0])]
    got = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (0, 3, 1, False),
        (1, 3, 1, True),
        (1, 3, 1, True),
        (2, 3, 1, False),
        (3, 0, 3, True),
    ]


def exact(rows, asked, k):
    out = {}
    for i in asked:
        q = dict(rows)[i]
        scored = sorted((-float(np.dot(q, v)), j) for j, v in rows if j != i)
        out[i] = [j for _, j in scored[:k]]
    return out


def test_nearest_reaches_the_recall(spark):
    rows = vectors(1_500, seed=2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("clash"))
    got = multi_index.nearest_vectors(df, df.where("vec_id % 20 = 0"), part_rows=100).collect()
    asked = [i for i, _ in rows if i % 20 == 0]
    want = exact(rows, asked, 20)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert set(found) == set(asked)
    by_id = dict(rows)
    for i, near in found.items():
        assert len(near) == 20 and i not in [j for j, _ in near]
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.dot(by_id[i], by_id[j])) < 1e-9 for j, s in near)
    assert np.mean([len({j for j, _ in found[i]} & set(want[i])) / 20 for i in asked]) >= 0.9


def test_nearest_of_few_and_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0, 3.0]), (1, [3.0, 2.0, 1.0]), (2, [1.0, 2.0, 3.0]), (20, None), (40, [0.0] * 3), (60, [nan] * 3), (None, [1.0, 1.0, 1.0]), (80, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.nearest_vectors(df, df.where("vec_id % 20 = 0")).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 2, 14.0), (0, 2, 1, 10.0)]
    assert multi_index.nearest_vectors(df.limit(0), df).count() == 0
    assert multi_index.nearest_vectors(df, df.limit(0)).count() == 0


def test_traversal_goes_by_falling_sum():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=7), rng.normal(size=5)
    sums = [a[i] + b[j] for i, j in multi_index.traversal(a, b)]
    assert len(sums) == 35 and sums == sorted(sums, reverse=True)


@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op4_chat_format"])
def test_same_rows_as_sql(spark, name):
    from tools.verify import compare, oracle_connection

    sf = "/root/testdata/sf0.01"
    assert compare(spark, oracle_connection(sf), sf, queries.QUERIES[name], queries.SQL[name])[0] == "ok"
