"""Operators on single texts: BPE, fingerprints, language id, toxicity, language model."""

import hashlib
import math
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import bpe_trie, elias_fano, ftrl_toxicity, langid_pieces, lm_trie, winnowing
from pricepanel.llm.common import Words, arrow_batches, scratch
from pricepanel.llm.elias_fano import Arrays, EliasFano, save_arrays

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000
ODD = [None, "", "   \n\t ", "x", "the cat", LONG, "x" * 5000, "the cat", "a\x00b", "日本語テキスト 🙂", "é" * 50]


def frame(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


# --- tokeniser -------------------------------------------------------------------------------


def test_words_split_on_the_six_separators_only():
    texts = [b"a b\tc\nd\x0be\x0cf\rg", b"", "a b  c".encode(), b"  x  "]
    w = Words(texts)
    got = [[w.bytes_of(i) for i in np.flatnonzero(w.doc == d)] for d in range(4)]
    assert got == [t.split() for t in texts]
    assert len(set(w.hash.tolist())) == len({x for t in texts for x in t.split()})


def test_word_hashes_equal_sums_byte_by_byte():
    from pricepanel.llm import common
    words = [b"a", b"bc", b"x" * (common._SEGMENT + 3), b"end", b"y" * common._SEGMENT, "\u65e5\u672c".encode(), b"a"]
    texts = [b" ".join(words), b"   ", b"\n" * (common._SEGMENT + 1) + b"bc  a" + b" tail" * common._SEGMENT]
    w = Words(texts)

    def plain(word):
        total, power = 0, 1
        for byte in word:
            total, power = total + int(common._SYMBOL[byte]) * power, power * int(common._BASE) % 2**64
        return common.mixed(np.array([total % 2**64], dtype=np.uint64))[0]

    flat = [x for t in texts for x in t.split()]
    kinds = {x: plain(x) for x in set(flat)}
    assert w.hash.tolist() == [kinds[x] for x in flat]
    long, head = w.prefixes(2)
    assert head.tolist() == [plain(flat[i][:2]) for i in long] and len(long) == sum(len(x) > 2 for x in flat)


def test_grams_stay_inside_a_text():
    w = Words([b"a b c", b"d e", b"a b c"])
    gram, at = w.grams(3)
    assert at.tolist() == [0, 5] and gram[0] == gram[1]


# --- BPE -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe_trie.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


SPECIAL = ["a <|endoftext|> b<|endoftext|>", " \x1c\x1d \x85 x", "'ll 'S we're 123abc ²½", "-" * 300 + " " * 400 + "\t\n\n x"]


def test_bpe_equals_the_library(spark, library):
    texts = ODD + SPECIAL
    got = {r.doc_id: r for r in bpe_trie.encode_documents(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert back == (t or "") and got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_bpe_query_equals_the_library_on_the_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe_trie.op8_bpe_trie(spark, SF).collect()}
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_bpe_trie_with_tiny_bounds_is_the_same():
    big, small = bpe_trie.BpeTrie(bpe_trie.vocabulary_path()), bpe_trie.BpeTrie(bpe_trie.vocabulary_path(), 50, 5)
    texts = [t or "" for t in ODD + SPECIAL]
    assert list(big.encode_decode(texts)) == [x for t in texts for x in small.encode_decode([t])]


def test_pair_compatibility_equals_merging_the_joined_bytes():
    trie = bpe_trie.BpeTrie(bpe_trie.vocabulary_path())
    rng = np.random.default_rng(3)
    for a, b in rng.integers(0, 50256, size=(3000, 2)).tolist() + [[64, 64], [284, 262]]:
        assert trie.compatible(a, b) == (trie.merged(trie.bytes_of[a] + trie.bytes_of[b]) == [a, b])


@pytest.mark.parametrize("text", ["x" * 5000, "é" * 3000, "-" * 4000 + " " * 5000, "日本語" * 1500, "the" * 3000,
                                  "a<|endoftext|>" + "b" * 2000, "qzj" * 4000 + " and the rest"])
def test_long_words_are_walked_like_the_library(library, text):
    trie = bpe_trie.BpeTrie(bpe_trie.vocabulary_path(), 50, 5)
    (code, plain), = trie.encode_decode([text])
    ids = library.encode(text, add_special_tokens=False).ids
    assert code == struct.pack(f"<{len(ids)}I", *ids) and plain.decode() == text
    assert all(len(w) <= bpe_trie.LONG_WORD for w in trie.words) and len(trie.last) < 50 + bpe_trie.LONG_WORD


def test_long_words_and_texts_take_bounded_memory(library, monkeypatch):
    import tracemalloc
    rng = np.random.default_rng(4)
    word = bytes(rng.integers(97, 123, 2_000_000, dtype=np.uint8)).decode()
    trie = bpe_trie.BpeTrie(bpe_trie.vocabulary_path())
    trie.encode_decode(["warm up"])
    tracemalloc.start()
    (code, plain), = trie.encode_decode([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(trie.last) == 1 and plain.decode() == word and peak < (64 << 20) + 10 * len(word)  # the pairs known, and a word of 20 MB: 264 MB
    monkeypatch.setattr(bpe_trie, "TEXT_PART", 1000)
    monkeypatch.setattr(bpe_trie, "_PART_WORDS", 7)
    text = " ".join(["some words é 日本", "a<|endoftext|>b", "x" * 3000, "the cat\n\n"] * 30)
    (code, plain), = trie.encode_decode([text])
    ids = library.encode(text, add_special_tokens=False).ids
    assert code == struct.pack(f"<{len(ids)}I", *ids) and plain.decode() == text


# --- winnowing -------------------------------------------------------------------------------


def brute_units(text):
    """Words, one after another; a word over LONG_WORD code points as its single code points."""
    out, word = [], ""
    for c in text + " ":
        if c not in " \t\n\x0b\x0c\r":
            word += c
        elif word:
            out += [word] if len(word) <= winnowing.LONG_WORD else list(word)
            word = ""
    return out


def test_winnowing_chooses_the_least_of_each_window_rightmost(spark):
    texts = [t or "" for t in ODD] + ["a b a b a b a b a b a b a b a b", " ".join(f"w{i % 7}" for i in range(60))]
    df = frame(spark, texts)
    rows = df.select("doc_id", winnowing.units(F.col("text")).alias("u"), winnowing.entries(F.col("text")).alias("e"),
                     winnowing.shown(winnowing.entries(F.col("text"))).alias("s")).collect()
    hashed = {}
    for r in rows:
        u = brute_units(texts[r.doc_id])
        assert r.u == u
        grams = [tuple(u[i:i + winnowing.K]) for i in range(max(1, len(u) - winnowing.K + 1))] if u else []
        for g in grams:
            hashed.setdefault(g, None)
    grams = list(hashed)
    codes = spark.createDataFrame([(i, list(g)) for i, g in enumerate(grams)], "i int, g array<string>").select(
        "i", F.pmod(F.xxhash64("g"), F.lit(1 << 40)).alias("h")).collect()
    for i, h in codes:
        hashed[grams[i]] = h
    for r in rows:
        u = brute_units(texts[r.doc_id])
        h = [hashed[tuple(u[i:i + winnowing.K])] for i in range(max(1, len(u) - winnowing.K + 1))] if u else []
        chosen = []
        for i in range(max(1, len(h) - winnowing.W + 1) if h else 0):
            window = list(enumerate(h[i:i + winnowing.W], i))
            best = min(x for _, x in window)
            chosen.append(max(p for p, x in window if x == best))
        want = list(dict.fromkeys((h[p], p) for p in chosen))
        assert r.s == " ".join(f"{x:X}:{p:X}" for x, p in want)


def test_shared_run_guarantees_a_shared_entry(spark):
    run = " ".join(f"shared{i}" for i in range(winnowing.K + winnowing.W - 1))
    a, b = "aa bb cc " + run + " dd ee", "zz " + run + " " + " ".join(f"y{i}" for i in range(40))
    got = [set(r[0]) for r in frame(spark, [a, b]).select(winnowing.hashes(winnowing.entries(F.col("text")))).collect()]
    assert got[0] & got[1]


@pytest.mark.parametrize("n", [40, 41, 60, 100, 101])
def test_long_words_count_code_point_by_code_point(spark, n):
    line = "".join(chr(0x4E00 + (i * 37) % 900) for i in range(n - 1)) + "🙂"
    got = frame(spark, [f"ab {line}\ncd", f"{line} {line}x"]).select(winnowing.units(F.col("text"))).collect()
    cut = lambda w: list(w) if len(w) > 40 else [w]
    assert got[0][0] == ["ab", *cut(line), "cd"] and got[1][0] == [*cut(line), *cut(line + "x")]


def test_shared_run_at_the_end_of_unspaced_lines(spark):
    run = "共有される文章です"[:winnowing.K + winnowing.W - 1]
    a, b = ("".join(chr(at + i) for i in range(70)) + run for at in (0x4E00, 0x5E00))
    got = [set(r[0]) for r in frame(spark, [a, b]).select(winnowing.hashes(winnowing.entries(F.col("text")))).collect()]
    assert got[0] & got[1]


@pytest.mark.parametrize("ids", [[5, 1, 9, 3], [1, 1, 2, 2], [None, 7, -100, 10**15], [4]])
def test_edited_text_takes_from_the_next_row(spark, ids):
    texts = ["one two three four five", None, "", "ünï cödé " * 30][:len(ids)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = winnowing.fingerprints(df).collect()
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - m] + following[:m]).encode()).hexdigest()))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)


def test_fingerprints_of_the_table(spark):
    rows = winnowing.op9_winnowing(spark, SF).collect()
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    by_text, near = {}, []
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)]
        m = len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - m] + following[1][:m]).encode()).hexdigest()
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        a = {x.split(":")[0] for x in got[i].fingerprint.split()}
        b = {x.split(":")[0] for x in got[following[0]].fingerprint.split()}
        assert got[i].near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        if len(set(t.split())) > 150 and len(following[1]) >= m:
            near.append(got[i].near_edited)
    assert np.mean(near) == pytest.approx(1 / 3, abs=0.07)  # half of the units are shared


@pytest.mark.parametrize("ids", ["outlier", "offset", "null", "same", "copies"])
def test_blocks_are_bounded_for_any_ids(spark, ids):
    n = 600
    number = {"outlier": lambda i: 10**15 if i == 7 else i, "offset": lambda i: i + 10**15 * (i % 2), "null": lambda i: None}
    rows = [(number.get(ids, lambda i: 3)(i), "copy of a text" if ids == "copies" else f"t{i:04} some words of text {i}")
            for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name, value in (("coalescePartitions.enabled", "false"), ("coalescePartitions.enabled", "true")):
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
        got = winnowing.neighbours(df, scratch(spark, "t")).where("not guest").select(
            "block", "place", "doc_id", "text", F.col("next_text").alias("next")).collect()
        assert max(Counter(r.block for r in got).values()) <= winnowing.BLOCK_ROWS
        want = sorted(rows, key=lambda r: (r[0] or 0, r[1]))
        assert [(r.doc_id, r.text) for r in sorted(got, key=lambda r: (r.block, r.place))] == want
        following = Counter((*a, b[1]) for a, b in zip(want, want[1:] + want[:1]))
        assert Counter((r.doc_id, r.text, r.next) for r in got) == following


def test_fingerprints_of_an_empty_table(spark):
    assert winnowing.fingerprints(frame(spark, []).limit(0)).count() == 0


# --- language id -----------------------------------------------------------------------------


def all_segmentations(word, pieces, unknown):
    if not word:
        return 1.0
    total = 0.0
    for j in range(1, len(word) + 1):
        p = pieces.get(word[:j], unknown if j == 1 else None)
        if p is not None:
            total += p * all_segmentations(word[j:], pieces, unknown)
    return total


def test_forward_sums_all_segmentations_and_backward_agrees():
    pieces = {"a": .1, "b": .2, "ab": .3, "abc": .05, "bc": .15, "c": .01}
    words = ["abc", "abcab", "x", "cab", "aXb", "a"]
    index = {x: i for i, x in enumerate(pieces)}
    p = np.array([*pieces.values(), 1e-7])[:, None]
    lattice = langid_pieces.Lattice(words, index, 3)
    a, b = lattice.forward(p), lattice.backward(p)
    for k, w in enumerate(words):
        want = all_segmentations(w, pieces, 1e-7)
        assert a[k, len(w), 0] == pytest.approx(want) and b[k, 0, 0] == pytest.approx(want)


def test_language_id_on_held_out_rows(spark):
    rows = langid_pieces.op4_langid_pieces(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    got = rows.join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None and r.lang_pred != "und"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and len(held) > 100
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edge_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid_pieces.train(docs, per_language=50, rounds=1)
    got = {r.doc_id: r._lid for r in langid_pieces.predicted(
        frame(spark, ODD + ["12 34 !!"], lang_pred="clash", score=5), model).collect()}
    for i, t in enumerate(ODD + ["12 34 !!"]):
        letter = any(c.isalpha() for c in t or "")
        assert (got[i].lang_pred == "und") == (not letter)
    assert got[4] == got[7]
    none = langid_pieces.train(docs.where("lang is null"))
    assert none is None and langid_pieces.predicted(frame(spark, ["a"]), none).first()._lid.lang_pred == "und"


# --- toxicity --------------------------------------------------------------------------------


def test_ftrl_learns_marker_words_and_stays_sparse():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(200)]
    texts, y = [], []
    for i in range(600):
        w = list(rng.choice(words, 40))
        if i % 5 == 0:
            w.insert(int(rng.integers(0, 40)), "nasty")
        texts.append(" ".join(w).encode())
        y.append(float(i % 5 == 0))
    names, weights, bias = ftrl_toxicity.fit(texts[:400], np.array(y[:400]))
    p = ftrl_toxicity.Scorer(names, weights, bias)(texts[400:])
    assert ((p >= .5) == (np.array(y[400:]) == 1)).mean() > 0.98
    assert len(names) < 500 and names[np.argmax(weights)] == Words([b"nasty"]).hash[0]


def test_toxicity_on_held_out_rows(spark):
    rows = ftrl_toxicity.op6_ftrl_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    assert rows.count() == 1000
    held = [r for r in rows.join(labels, "doc_id").collect() if r.held_out]
    one, zero = [r.score for r in held if r.toxic == 1], [r.score for r in held if r.toxic == 0]
    assert np.mean([a > b for a in one for b in zero]) > 0.85
    assert sum(r.predicted for r in held if r.toxic == 0) <= 2


def test_toxicity_edge_rows_and_own_columns(spark):
    arrow_batches(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = frame(spark, ODD, _score="clash", toxic=3)
    model = ftrl_toxicity.train(docs, labels)
    got = [r.p for r in ftrl_toxicity.scored(odd.select("doc_id", "text"), model, "p").orderBy("doc_id").collect()]
    assert len(got) == len(ODD) and all(0 <= p <= 1 for p in got)
    assert got[0] == got[1] == got[2] and got[4] == got[7]
    kept = ftrl_toxicity.clean_documents(odd, labels)
    assert kept.columns == odd.columns
    assert ftrl_toxicity.train(docs, labels.limit(0)) is None
    assert ftrl_toxicity.clean_documents(odd.limit(0), labels).count() == 0


# --- language model --------------------------------------------------------------------------


@pytest.mark.parametrize("size,universe", [(0, 10), (1, 1), (1000, 1000), (5000, 10**12), (300, 1 << 63), (2000, 50)])
def test_elias_fano_get_and_find(size, universe):
    rng = np.random.default_rng(1)
    v = np.sort(rng.integers(0, universe, size, dtype=np.uint64))
    e = EliasFano.of(v, universe)
    assert (e.get(np.arange(size)) == v).all() if size else True
    q = np.concatenate([v, rng.integers(0, universe, 500, dtype=np.uint64)])
    at = np.searchsorted(v, q)
    want = np.where((at < size) & (v[np.minimum(at, max(0, size - 1))] == q) if size else False, at, -1)
    assert (e.find(q) == want).all()


def dictionary_scores(texts, train):
    """The same model from plain dictionaries: score and base score of each text."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    tokens = [[*(t or "").encode().translate(low).split(), None] for t in texts]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for x, use in zip(tokens, train):
        if use:
            y = [0, *x]
            c1.update(x)
            c2.update(zip(y, y[1:]))
            c3.update(zip(y, y[1:], y[2:]))
    n, v, d = sum(c1.values()), len(c1), lm_trie.DISCOUNT
    c2 = {k: c for k, c in c2.items() if c >= lm_trie.MIN_COUNTS[1]}
    c3 = {k: c for k, c in c3.items() if c >= lm_trie.MIN_COUNTS[2]}
    total = lambda w: sum(train) if w == 0 else c1[w]
    left2, left3 = {}, {}
    for (a, b), c in c2.items():
        left2[a] = left2.get(a, 1.0) - (c - d) / total(a)
    for (a, b, w), c in c3.items():
        left3[a, b] = left3.get((a, b), 1.0) - (c - d) / c2[a, b]
    p1 = lambda w: (c1[w] - d) / n if w in c1 else d * v / n
    p2 = lambda a, w: max(0, c2.get((a, w), d) - d) / max(1, total(a)) + left2.get(a, 1.0) * p1(w)

    def p3(a, b, w):
        return (c3[a, b, w] - d) / c2[a, b] + left3[a, b] * p2(b, w) if (a, b, w) in c3 \
            else left3.get((a, b), 1.0) * p2(b, w)

    for x in tokens:
        y = [0, *x]
        score = math.log10(p2(0, x[0])) + sum(math.log10(p3(*g)) for g in zip(y, y[1:], y[2:]))
        yield len(x), sum(w in c1 for w in x), score, sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in x), n


@pytest.mark.parametrize("part_tokens", [8_000_000, 5_000])
def test_lm_equals_a_dictionary_model(spark, monkeypatch, part_tokens):
    monkeypatch.setattr(lm_trie, "PART_TOKENS", part_tokens)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(100_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    model, tokens = lm_trie.train(df, scratch(spark, "lm-test"))
    got = {r.doc_id: r for r in lm_trie.scored(tokens, model).collect()}
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    for (i, _), (n, known, score, base, total) in zip(rows, dictionary_scores([t for _, t in rows], train)):
        r = got[i]
        assert (r.n_tokens, r.n_known, model.tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) <= 2e-4 * n + 1e-3


class _Local:
    """A table whose mapInArrow gives the function, to be run in this process."""

    def select(self, *_):
        return self

    where = select

    def mapInArrow(self, run, _):
        return run


def test_lm_looks_each_pair_and_triple_of_a_batch_up_once(spark, monkeypatch):
    monkeypatch.setattr(lm_trie, "PART_TOKENS", 50)
    docs = frame(spark, [f"a{i % 3} b{i % 4} c d{i % 2} e" for i in range(60)] + ["new a0 b0 c", "c"] * 20)
    model, tokens = lm_trie.train(docs, scratch(spark, "lm-once"))
    want = {r.doc_id: r.score for r in lm_trie.scored(tokens, model).collect()}
    names = ["doc_id", "train", "n_tokens", "n_known", "base_score", "ids"]
    rows = tokens.select(*names).toArrow().combine_chunks()
    pairs, triples, trained = set(), set(), set()
    for ids, train in zip(rows["ids"].to_pylist(), rows["train"].to_pylist()):
        y = [model.start, *np.frombuffer(ids, dtype=np.uint32).tolist()]
        pairs.update(zip(y, y[1:]))
        triples.update(zip(y, y[1:], y[2:]))
        trained.update(zip(y, y[1:]) if train else ())
    asked = []
    find = EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda self, values: asked.append(len(values)) or find(self, values))
    got = list(lm_trie.scored(_Local(), model)(iter(rows.to_batches())))
    assert {i: x for b in got for i, x in zip(b["doc_id"].to_pylist(), b["score"].to_pylist())} == want
    assert 0 < sum(asked) <= len(pairs) + len(triples)
    asked.clear()
    kept = rows.filter(rows["train"]).select(["ids"])
    list(lm_trie._count_grams(_Local(), model, 3, model.spans[2])(iter(kept.combine_chunks().to_batches())))
    assert 0 < sum(asked) <= len(trained)


def test_lm_meets_a_shard_once_for_the_batches_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(lm_trie, "PART_TOKENS", 50)
    docs = frame(spark, [f"a{i % 3} b{i % 4} c d{i % 2} e" for i in range(60)] + ["new a0 b0 c", "c"] * 20)
    model, tokens = lm_trie.train(docs, scratch(spark, "lm-shards"))
    assert model.sizes[0] == [model.kinds, 0] and min(model.parts[1:]) > 3  # shards of words by the words, not the tokens
    rows = tokens.select("doc_id", "train", "n_tokens", "n_known", "base_score", "ids").toArrow().combine_chunks()
    met, opened = [], []
    follow, arrays = lm_trie.Trie._follow, lm_trie.Arrays
    monkeypatch.setattr(lm_trie.Trie, "_follow", lambda self, level, shard, *x: met.append((level, shard)) or follow(self, level, shard, *x))
    monkeypatch.setattr(lm_trie, "Arrays", lambda *x: opened.append(x) or arrays(*x))
    got = list(lm_trie.scored(_Local(), model)(iter(rows.to_batches(max_chunksize=7))))
    assert sum(b.num_rows for b in got) == rows.num_rows > 70
    assert len(met) == len(set(met)) > 6 and len(opened) == len(set(opened))
    met.clear()
    kept = rows.filter(rows["train"]).select(["ids"]).combine_chunks()
    list(lm_trie._count_grams(_Local(), model, 3, model.spans[2])(iter(kept.to_batches(max_chunksize=7))))
    assert len(met) == len(set(met)) > 3


def test_lm_building_a_shard_of_triples_looks_no_pairs_up(spark, monkeypatch):
    monkeypatch.setattr(lm_trie, "PART_TOKENS", 50)
    model, tokens = lm_trie.train(frame(spark, [f"a{i % 5} b{i % 7} c a{i % 3}" for i in range(40)]), scratch(spark, "lm-build"))
    ids = tokens.where("train").select("ids").toArrow().combine_chunks()
    trie = lm_trie.Trie(model)
    code = [trie.value(3, np.arange(n) + sum(model.sizes[2][:i]), "code") for i, n in enumerate(model.sizes[2])]
    build = lm_trie._build_grams(model, 3, model.spans[2])
    keys, entries = {}, {}
    for b in lm_trie._count_grams(_Local(), model, 3, model.spans[2])(iter(ids.to_batches())):
        for part, n, block in zip(*(c.to_pylist() for c in b.columns)):
            keys[part], entries[part] = lm_trie._unpack(block, n)
    monkeypatch.setattr(lm_trie.Trie, "_follow", None)  # a look-up would fail
    for part in keys:
        assert build(part, keys[part], entries[part] >> 16, entries[part] & 65535) == model.sizes[2][part]
    trie = lm_trie.Trie(model)
    assert all((trie.value(3, np.arange(n) + sum(model.sizes[2][:i]), "code") == code[i]).all() for i, n in enumerate(model.sizes[2]))


def test_lm_scores_do_not_depend_on_the_number_of_shards(spark, monkeypatch):
    # a pair seen over 255 times lies in another shard than the first one, whose counts take a byte each
    docs = frame(spark, [f"a{i % 40} b{i % 50} c{i % 30}" for i in range(600)] + ["x y z", "x y w"] * 300)
    scores = []
    for part_tokens in (10**6, 400, 60):
        monkeypatch.setattr(lm_trie, "PART_TOKENS", part_tokens)
        model, tokens = lm_trie.train(docs, scratch(spark, "lm-parts"))
        scores.append(sorted((r.doc_id, r.score) for r in lm_trie.scored(tokens, model).collect()))
    assert scores[0] == scores[1] == scores[2]
    monkeypatch.setattr(lm_trie.Trie, "_array", lambda self, level, shard, name: np.array([7], dtype=np.uint8 if shard == 0 else np.uint16) * (1 if shard == 0 else 99))
    trie = lm_trie.Trie(lm_trie.Model("", sizes=[[1, 1]]))
    assert trie.value(1, np.array([0, 1]), "counts").tolist() == [7, 693]


@pytest.mark.parametrize("mounted", [True, False])
def test_arrays_of_a_file_come_back_from_any_store(tmpdir_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(elias_fano, "_local", lambda uri: None)
    some = {"a": np.arange(7, dtype=np.uint16), "none": np.empty(0, dtype=np.int64), "b": np.arange(90, dtype=np.uint64) << np.uint64(40)}
    e = EliasFano.of(np.arange(0, 900, 9), 900)
    for folder in (*[tmpdir_path] * mounted, f"file://{tmpdir_path}"):
        save_arrays(f"{folder}/x", "0", some | e.arrays("e"))
        got = Arrays(f"{folder}/x", "0")
        assert all((got[k] == v).all() and got[k].dtype == v.dtype and len(got[k]) == len(v) for k, v in some.items())
        assert (EliasFano.kept(got.__getitem__, "e").get(np.arange(100)) == np.arange(0, 900, 9)).all()


def test_lm_answers_in_any_order_and_across_shards(spark, monkeypatch):
    monkeypatch.setattr(lm_trie, "PART_TOKENS", 20)
    model, _ = lm_trie.train(frame(spark, [f"a{i % 5} b{i % 7} c a{i % 3}" for i in range(40)]), scratch(spark, "lm-order"))
    trie = lm_trie.Trie(model)
    before, word = (x.ravel() for x in np.meshgrid(np.arange(model.kinds + 2), np.arange(model.kinds + 2), indexing="ij"))
    score, place = trie.bigram(before, word)
    assert (place >= 0).sum() == sum(model.sizes[1]) and np.isfinite(score).all()
    pair = np.repeat(np.arange(-1, sum(model.sizes[1])), model.kinds)
    last = np.tile(np.arange(model.kinds), len(pair) // model.kinds)
    third = trie.trigram(pair, last, np.full(len(pair), -9.0))
    assert (third[pair < 0] == -9.0).all()
    found = lm_trie.Trie(model).follow(3, pair[pair >= 0], last[pair >= 0])
    assert (found[found >= 0] == np.arange(sum(model.sizes[2]))).all()
    mixed = np.random.default_rng(3).permutation(len(before))
    again = trie.bigram(before[mixed], word[mixed])
    assert (again[0] == score[mixed]).all() and (again[1] == place[mixed]).all()
    mixed = np.random.default_rng(4).permutation(len(pair))
    assert (trie.trigram(pair[mixed], last[mixed], np.full(len(pair), -9.0)) == third[mixed]).all()


def test_elias_fano_keeps_only_the_hints_it_needs(tmpdir_path):
    import os
    v = np.cumsum(np.random.default_rng(2).integers(0, 90, 4000))
    e = EliasFano.of(v, int(v[-1]) + 1)
    assert e.ones.dtype == e.one_at.dtype == e.zero_at.dtype == np.uint32
    e.save(tmpdir_path, "both")
    e.save(tmpdir_path, "get", find=False)
    e.save(tmpdir_path, "find", get=False)
    assert not {"get_zero_at.npy", "find_one_at.npy"} & set(os.listdir(tmpdir_path))
    both, get, find = (EliasFano.load(tmpdir_path, x) for x in ("both", "get", "find"))
    i, q = np.arange(3999), np.arange(int(v[-1]) + 5)
    for x in (both, get):
        assert (x.get(i) == v[:-1]).all() and (x.neighbours(i)[1] == v[1:]).all()
    assert (find.find(q) == both.find(q)).all() and ((find.find(q) >= 0) == np.isin(q, v)).all()


def test_lm_knows_texts_seen_once(spark):
    once = " ".join(f"rare{i}" for i in range(40))
    ids = {use: next(i for i in range(500, 600) if (zlib.crc32(str(i).encode()) % 7 != 2) == use) for use in (True, False)}
    rows = [(i, f"common words of text {i}") for i in range(60)] + [(ids[True], once), (ids[False], once)]
    model, tokens = lm_trie.train(spark.createDataFrame(rows, "doc_id long, text string"), scratch(spark, "lm-once"))
    assert sum(model.sizes[1]) >= 41 and sum(model.sizes[2]) >= 40
    got = {r.doc_id: r for r in lm_trie.scored(tokens, model).collect()}
    held = got[ids[False]]
    assert not held.train and held.score == got[ids[True]].score and held.score / held.n_tokens > -0.5


def test_lm_beats_the_base_on_held_out_rows(spark):
    r = lm_trie.op10_lm_trie(spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > 0.85 * r.b


def test_lm_without_training_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    model, tokens = lm_trie.train(df, scratch(spark, "lm-none"))
    assert [(r.n_tokens, r.score) for r in lm_trie.scored(tokens, model).orderBy("n_tokens").collect()] == [(1, 0.0), (3, 0.0)]
    model, tokens = lm_trie.train(df.limit(0), scratch(spark, "lm-empty"))
    assert lm_trie.scored(tokens, model).count() == 0


def test_elias_fano_select_far_from_its_hints():
    rng = np.random.default_rng(9)
    gaps = np.where(rng.random(3000) < 0.01, rng.integers(0, 200_000, 3000), rng.integers(0, 3, 3000))
    v = np.cumsum(gaps)
    e = EliasFano.of(v, int(v[-1]) + 1)
    i = rng.integers(0, 2999, 5000)
    here, after = e.neighbours(i)
    assert (e.get(i) == v[i]).all() and (here == v[i]).all() and (after == v[i + 1]).all()
    q = np.concatenate([v, v + 1, rng.integers(0, v[-1], 3000)])
    found = e.find(q)
    assert ((found >= 0) == np.isin(q, v)).all() and (v[found[found >= 0]] == q[found >= 0]).all()


def test_trie_keeps_a_bounded_number_of_arrays_open(spark, monkeypatch):
    docs = frame(spark, [f"a{i % 5} b{i % 7} c a{i % 3}" for i in range(40)])
    monkeypatch.setattr(lm_trie, "PART_TOKENS", 20)
    model, _ = lm_trie.train(docs, scratch(spark, "lm"))
    words = np.arange(model.kinds)
    full = lm_trie.Trie(model).bigram(words, words[::-1])[0]
    monkeypatch.setattr(lm_trie, "OPEN_ARRAYS", 3)
    trie = lm_trie.Trie(model)
    assert (trie.bigram(words, words[::-1])[0] == full).all() and len(trie.open) <= 3 < sum(model.parts)


def test_only_unicode_letters_give_a_text_a_language():
    texts = ["²", "½①", "₂ 3 Ⅳ", "१२३", "_", "🙂", "ª", "a²", "日", "\u0301", None, ""]
    assert [bool(langid_pieces._LETTER.search(t)) if t else False for t in texts] == [
        False, False, False, False, False, False, True, True, True, False, False, False]


def test_toxicity_sample_takes_the_rarer_label_first_and_is_bounded_in_bytes(spark):
    n = 3000
    rows = [(i, f"vile word{i % 7} trash" if i % 25 == 0 else f"kind word{i % 9} here") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 25 == 0).cast("int").alias("toxic"))
    train = {i for i in range(n) if zlib.crc32(str(i).encode()) % 5}
    rare = sum(i % 25 == 0 for i in train)
    model = ftrl_toxicity.train(docs, labels, sample_docs=400)
    got = ftrl_toxicity.scored(docs, model).select("doc_id", (F.col("score") >= 0.5).alias("bad")).collect()
    assert rare < 200 and {r.doc_id for r in got if r.bad} == {i for i in range(n) if i % 25 == 0}
    # no byte to spare: the model sees nothing, which is no error
    assert ftrl_toxicity.train(docs, labels, sample_bytes=0) is None
    small = ftrl_toxicity.train(docs, labels, sample_docs=400, sample_bytes=2000)
    assert small is not None and len(small[0]) <= len(model[0])
