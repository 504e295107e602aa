"""Chat formatting, secrets, pieces, packing, scores and languages against brute force and round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from harbormill.llm import chat, language, lm, packing, pieces, queries, secrets
from tests.llm.conftest import sentence


def plain_viterbi(text: str, table) -> list[int]:
    """The whole lattice at once, for comparison."""
    best: list = [(0.0, 0, ())] + [(-math.inf, 0, ())] * len(text)
    for at in range(len(text)):
        for end in range(at + 1, min(len(text), at + table.longest) + 1):
            entry = table.ids.get(text[at:end])
            if entry is not None and best[at][0] + entry[1] > best[end][0]:
                best[end] = (best[at][0] + entry[1], at, (entry[0],))
        if table.ids.get(text[at]) is None and best[at][0] + table.unknown > best[at + 1][0]:
            best[at + 1] = (best[at][0] + table.unknown, at, tuple(table.byte_ids[b] for b in text[at].encode()))
    path, e = [], len(text)
    while e:
        path.append(best[e][2])
        e = best[e][1]
    return [i for step in reversed(path) for i in step]

TOKENIZER = public_tokenizers.path(queries.WORD_TOKENIZER)
MODEL = public_tokenizers.path(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def documents(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


# --- chat formatting ---


def test_chat_reads_back_what_it_was_given(spark):
    nasty = ["", None, "\\", "|", "\\|", "<|end|>\n", "<|turn user|>\n", "a\\\\|b", "line\nline", "|>\n", "☃" * 3, "x" * 20_000]
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", t) for n, t in enumerate(nasty)]
    rows += [(2, 0, "end|>\n", "role with marks"), (2, 0, None, None), (2, None, "assistant", "first"), (2, 0, None, None)]
    rows += [(None, 1, "user", "nobody's"), (3, 1, "user", "q"), (3, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    wanted = defaultdict(list)
    for conv, turn, role, text in rows:
        wanted[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in wanted.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [t[2:] for t in turns]
        assert got[conv]["loss"] == "".join(t[3] for t in turns if t[2] == "assistant")
        assert got[conv]["formatted"] == "".join(s["text"] for s in got[conv]["segments"])
    assert got[1]["valid"] and got[3]["valid"] and not got[2]["valid"]
    assert got[2]["state"] == chat.REJECTED


@pytest.mark.parametrize(
    ("roles", "valid"),
    [("su", True), ("sua", True), ("uaua", True), ("a", False), ("ss", False), ("uu", False), ("uas", False), ("s", False), ("sa", False)],
)
def test_chat_machine(spark, roles, valid):
    names = {"s": "system", "u": "user", "a": "assistant"}
    df = spark.createDataFrame([(1, n, names[r], r) for n, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).head()["valid"] is valid


def test_chat_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).count() == 0


def test_chat_is_native(spark, sf_dir):
    plan = queries.op4_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- secrets ---


def brute_base(text):
    found = []
    kinds = (
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.I, lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
        (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
    )
    for kind, (pattern, flags, fits) in enumerate(kinds):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, flags) if fits(m)]
    return sorted(found)


def brute_spans(text, scope):
    parts = secrets.parts_of(text)
    weak = [p for p in parts if p[1] >= secrets.BASE]
    return sorted([p for p in parts if p[1] < secrets.BASE] + [w for w in weak if any(o[1] in secrets.COMPLEMENTS[w[1]] and abs(o[0] - w[0]) <= scope for o in parts)])


KEY = "aB3" + "dE5fG7hI9" * 4


def secret_texts():
    return [
        "Password: 'hunter22' secret: token: abcdef123 API_KEY=\"a.b-c_d=\" toKen=short paſsword=abcdefg",
        "AKIA" + "A1" * 8 + " AKIAshort AKIAAKIA" + "B2" * 9,
        "deadbeef" * 3 + " " + "0a" * 11 + " é" + "f" * 24,
        f"user=alice then {KEY} at https://host.example/x",
        f"{KEY} alone, with nothing beside it",
        f"AKIA{'Z9' * 8} {'.' * 170} {KEY} {'.' * 400} {KEY}",
        "https://host.example/a " + "." * 150 + " password=abcdefgh " + "." * 300 + " https://far.example/b",
        "☃ user: bob ☃ token:'" + "x" * 5_000 + "'",
        "",
        "user=carol without anything",
    ]


def test_secrets_match_brute_force(spark):
    texts = secret_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan_secrets(df).collect()}
    for n, text in enumerate(texts):
        assert got[n] == brute_spans(text, secrets.SCOPE), text[:60]
        assert [p for p in got[n] if p[1] < secrets.BASE] == brute_base(text)
    assert {p[1] for p in got[3]} == {secrets.IDENTIFIER, secrets.SECRET, secrets.ENDPOINT}
    assert got[4] == [] and got[9] == []
    assert [p[1] for p in got[5]] == [secrets.ACCESS, secrets.SECRET]
    assert [p[1] for p in got[6]] == [secrets.ENDPOINT, secrets.ASSIGN]


def test_secret_query_on_the_table(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for r in queries.op9_secret_scan(spark, sf_dir).collect():
        base = brute_base(docs[r["doc_id"]])
        listing = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]


def test_secrets_of_odd_rows(spark, odd_documents):
    rows = secrets.scan_secrets(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert sum(len(r["spans"]) for r in rows if r["doc_id"] == 1) == 2
    assert secrets.scan_secrets(odd_documents.limit(0)).count() == 0


def test_redaction(spark, odd_documents):
    out = secrets.redact_secrets(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    assert [r["text"] for r in out.where("doc_id = 1").collect()] == ["The quick brown fox. [secret] and more words of it"] * 2
    df = spark.createDataFrame([(1, "token=abcdef" + "0" * 30 + " end " + "f" * 24)], "doc_id long, text string")
    assert secrets.redact_secrets(df).head()["text"] == "[secret] end [secret]"


# --- pieces ---


@pytest.fixture(scope="module")
def piece_table():
    return pieces.load_pieces(MODEL)


ODD_TEXTS = ["", " ", "  ", "a", " a  b ", "a\nb\n\nc", "tab\there", "ünïcödé ☃ 漢字", "x" * 3_000, "ab" * 2_000, " " * 200, "word, word. (word)"]


def test_streaming_viterbi_equals_the_whole_lattice(piece_table, spark, sf_dir):
    encoder = pieces.Encoder(piece_table, bound=50)
    for text in ODD_TEXTS + list(documents(spark, sf_dir).values())[:40]:
        marked = pieces.SPACE + text.replace(" ", pieces.SPACE)
        whole = plain_viterbi(marked, piece_table) if text else []
        if text:
            assert pieces.viterbi(marked, piece_table) == whole
        assert np.frombuffer(encoder.encode(text), dtype=np.int32).tolist() == whole
        assert pieces.decode(whole, piece_table) == text


LONG_TAILS = ["7" * 5_000, "\n" * 5_000, "".join(chr(0x4E00 + n % 2_000) for n in range(5_000)), "word" + "1\n" * 2_500, "a " + "9" * 5_000 + " b"]


def test_units_with_long_tails_of_sure_cuts(piece_table):
    encoder = pieces.Encoder(piece_table)
    for text in LONG_TAILS + LONG_TAILS:  # the second time from the memo
        whole = plain_viterbi(pieces.SPACE + text.replace(" ", pieces.SPACE), piece_table)
        assert np.frombuffer(encoder.encode(text), dtype=np.int32).tolist() == whole
        assert pieces.decode(whole, piece_table) == text


def test_piece_columns_round_trip(spark, odd_documents):
    coded = pieces.encode_pieces(odd_documents, MODEL)
    both = pieces.decode_pieces(coded, MODEL).select("text", "ids", "decoded").collect()
    assert len(both) == odd_documents.count()
    for r in both:
        assert r["decoded"] == (r["text"] or "").replace(pieces.SPACE, " ")
        assert bool(r["ids"]) == bool(r["text"])
    assert pieces.encode_pieces(odd_documents.limit(0), MODEL).count() == 0


def test_piece_query(spark, sf_dir):
    rows = queries.op10_pieces(spark, sf_dir).collect()
    assert len(rows) == 200 and all(r["lossless"] for r in rows)


# --- packing ---


def test_differencing_is_nearly_equal_and_complete():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 512, 400).tolist()
    windows = packing.difference(sizes, 50)
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert sorted(i for w in windows for i in w) == list(range(400))
    assert max(sums) - min(sums) <= 8
    assert packing.difference([], 3) == [] and packing.difference([5], 3) == [[0]]
    assert all(sum(sizes[i] for i in w) <= 600 for w in packing.windows_of(sizes, 600))
    three = packing.windows_of([6, 6, 6], 10)  # two windows can't hold them
    assert len(three) == 3


def check_packing(rows, tokens, capacity):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["length"], r["doc_tokens"]))
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, parts in by_doc.items():
        whole = np.frombuffer(b"".join(p[1] for p in sorted(parts)), dtype="<u4").tolist()
        assert sorted(tokens[doc]) == sorted(whole) if doc is None else tokens[doc] == whole
        assert all(len(p[1]) == 4 * p[2] for p in parts)
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_query(spark, sf_dir, tokenizer):
    docs = documents(spark, sf_dir)
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for d, t in docs.items()}
    packed = packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), TOKENIZER).collect()
    check_packing(packed, ids, packing.CAPACITY)
    assert set(r["doc_id"] for r in packed) == set(docs)
    total, windows = sum(map(len, ids.values())), len({r["sequence_id"] for r in packed})
    assert windows * packing.CAPACITY <= total * 1.05 + 9 * packing.CAPACITY
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.op2_packing(spark, sf_dir).collect()}
    assert crc == {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in packed}


def test_packing_odd_rows(spark, odd_documents, tokenizer):
    rows = packing.pack_documents(odd_documents.where("doc_id is not null").dropDuplicates(["doc_id"]), TOKENIZER, capacity=64, piece=16, group_windows=4)
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    check_packing(rows.collect(), {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}, 64)
    assert packing.pack_documents(odd_documents.limit(0), TOKENIZER).count() == 0
    repeated = packing.pack_documents(odd_documents.where("doc_id = 1"), TOKENIZER).collect()
    assert sum(r["start"] == 0 for r in repeated) == 2


def test_chunks_seen_are_kept():
    """Words with a mark at their end are coded once, and words of Latin letters as the tokenizer codes them."""
    import array

    coder = packing.WordCoder(TOKENIZER)
    coder.encode("Wordy, élan.")
    assert {"Wordy,", "élan."} <= coder.memo.keys()
    r = random.Random(3)
    letters = [chr(n) for n in range(0x250)] + ["\u0301", "Σ", "字", "<|"]
    small = packing.WordCoder(TOKENIZER, bound=50)
    for _ in range(3_000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(1, 6)))
        want = array.array("I", coder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert coder.encode(text) == small.encode(text) == want


def test_words_in_memo_equal_whole_encoding(tokenizer):
    coder = packing.WordCoder(TOKENIZER, bound=20)
    for text in [*ODD_TEXTS, "don't, stop... 's, x's, y.", "é, é, Á.  z", "3.14, 2.", "ẞΣ. ΑΣ, <|startoftext|>a<|endoftext|>", "áb ́ c", "a b c\rd"]:
        assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# --- scores ---


def brute_scores(texts, tokenizer):
    v = tokenizer.get_vocab_size()
    words = defaultdict(list)
    for d, t in texts:
        words[d].append([v, *tokenizer.encode(t or "", add_special_tokens=False).ids, v])
    pairs = Counter(z for docs in words.values() for s in docs for z in zip(s, s[1:], strict=False))
    single = Counter(x for docs in words.values() for s in docs for x in s[1:])
    total = sum(single.values())

    def score(z):
        return math.log(pairs[z] / single[z[0]]) if pairs[z] >= 2 else math.log(0.4 * single[z[1]] / total)

    return {
        d: (sum(len(s) - 1 for s in docs), sum(pairs[z] < 2 for s in docs for z in zip(s, s[1:], strict=False)), sum(score(z) for s in docs for z in zip(s, s[1:], strict=False)))
        for d, docs in words.items()
    }


def test_backoff_scores(spark, sf_dir, odd_documents, tokenizer):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for df in (table, odd_documents):
        wanted = brute_scores([(r["doc_id"], r["text"]) for r in df.collect()], tokenizer)
        got = lm.backoff_scores(df, TOKENIZER).collect()
        assert {r["doc_id"]: (r["n_tokens"], r["n_backoff"]) for r in got} == {d: w[:2] for d, w in wanted.items()}
        assert all(math.isclose(r["log_score"], wanted[r["doc_id"]][2], rel_tol=1e-9, abs_tol=1e-9) for r in got)
    assert lm.backoff_scores(odd_documents.limit(0), TOKENIZER).count() == 0


# --- languages ---


def test_language_held_out_accuracy(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op7_language(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    out = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(out) >= 0.97


def test_kernel_is_what_it_says():
    texts = ["abc abd", "xyz", "abc", "ab"]
    spectra = [language.spectrum(t) for t in texts]
    grams = np.unique(np.concatenate(spectra))
    present = np.stack([np.isin(grams, s) for s in spectra], axis=1).astype(np.float32)
    got = language.kernel(spectra, grams, present, np.array([len(s) for s in spectra], float))

    def brute(t):
        t = f" {t} "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for i, a in enumerate(texts):
        assert len(spectra[i]) == len(brute(a))
        for j, b in enumerate(texts):
            assert math.isclose(got[i, j], len(brute(a) & brute(b)) / math.sqrt(len(brute(a)) * len(brute(b))), rel_tol=1e-6)


def test_language_of_odd_rows(spark, odd_documents):
    model = language.learn(odd_documents)
    out = language.with_language(odd_documents.withColumn("score", F.lit("clash")), model).collect()
    assert len(out) == odd_documents.count()
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    nothing = language.learn(odd_documents.limit(0))
    assert {r["lang_pred"] for r in language.with_language(odd_documents, nothing).collect()} == {"und"}
    assert language.with_language(odd_documents.limit(0), model).count() == 0


def test_word_ids_equal_the_tokenizer_for_all_letters_and_random_strings():
    import random
    import sys

    from harbormill.llm.packing import WordCoder

    path = public_tokenizers.path("word_bpe_49k.json")
    coder = WordCoder(path)

    def same(texts):
        want = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
        wrong = [t for t, w in zip(texts, want, strict=True) if np.frombuffer(coder.encode(t), dtype="<u4").tolist() != w.ids]
        assert wrong == []

    letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    for mark in ",.":
        same([f"a{c}{mark} {c}{mark}x" for c in letters])
    r = random.Random(7)
    some = [*",.'-!?<|>", " ", "  ", "\n", "\t", "A", "b", "It's", "DİY", "ΑΣ", "é", "e\u0301", "क़", "1", "<|endoftext|>", "\u00a0", "\u200b"] + r.sample(letters, 300)
    same(["".join(r.choice(some) for _ in range(r.randrange(12))) for _ in range(100_000)])


def test_clashing_names_and_settings(spark, odd_documents):
    from harbormill.llm import lines, lm, secrets, simhash

    names = ["_key", "key", "row", "_kept_id", "kept_id", "kept_key", "_text_key", "text_key", "removed", "spans", "_own_score", "_ownlang_pred", "total", "part"]
    odd = odd_documents
    for n in names:
        odd = odd.withColumn(n, F.lit(n))
    for change in (lines.without_repeated_lines, secrets.redact_secrets, simhash.keep_one_of_each):
        out = change(odd)
        assert out.columns == odd.columns
        assert all(r[n] == n for r in out.select(*names).collect() for n in names)
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    lm.backoff_scores(odd, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert spark.conf.get(setting) == before


def test_decoding_by_arrays_equals_decoding_one_by_one(spark):
    import random

    model = public_tokenizers.path("piece_bpe_32k.model")
    table = pieces.load_pieces(model)
    decoder = pieces.Decoder(table)
    r = random.Random(3)
    encoder = pieces.Encoder(table)
    texts = ["", " ", "  a", "a ", "é漢🙂", "\n\n", *[sentence(n, r.randrange(30)) for n in range(50)]]
    good = [np.frombuffer(encoder.encode(t), dtype=np.int32).tolist() for t in texts]
    assert decoder.texts(np.array(sum(good, []), dtype=np.int32), np.array(list(map(len, good)))).to_pylist() == texts
    odd = [[], *[[r.randrange(len(table.bytes_of)) for _ in range(r.randrange(6))] for _ in range(300)]]  # mostly no UTF-8
    assert decoder.texts(np.array(sum(odd, []), dtype=np.int32), np.array(list(map(len, odd)))).to_pylist() == [pieces.decode(x, table) for x in odd]
    df = spark.createDataFrame([(1, None, "x"), (2, [], "x"), (3, good[7], "x")], "id int, ids array<int>, decoded string")
    got = {r["id"]: r["decoded"] for r in pieces.decode_pieces(df, model).collect()}
    assert got == {1: "", 2: "", 3: texts[7]}
