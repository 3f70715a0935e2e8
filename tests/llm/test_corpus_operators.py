"""Collocations, decontamination and whitening against brute force and SQL."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import fm_decontam, fm_index, spectrum, stripes, whitening
from pricepanel.llm.common import arrow_batches, scratch
from pricepanel.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
LONG = "word " * 30_000
DOCS = "doc_id long, text string, lang string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", ["op11_stripes_collocations", "op12_fm_decontam"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    by = ["lang", "rank"] if "lang" in got else ["doc_id"]
    want = want[got.columns].sort_values(by).reset_index(drop=True)
    assert got.sort_values(by).reset_index(drop=True).equals(want)


# --- collocations --------------------------------------------------------------------------------


def brute_phrases(rows, least, longest=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return {k: c for k, c in f.items() if c >= least}, n


def brute_collocations(f):
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2:
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        inside = any(lang == other and len(x) > len(w) and any(x[i:i + len(w)] == w for i in range(len(x)))
                     and 100 * b >= 80 * a for (other, x), b in f.items())
        if not inside:
            out[lang, " ".join(w)] = (a, l, r, score)
    return out


def odd_rows():
    rng = np.random.default_rng(5)
    words = ["the", "The", "cat", "sat", "on", "a", "mat", "é", "日本", "x\x00y", "'s", "-"]
    joins = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "! "]
    rows = [(i, "".join(x + j for x, j in zip(rng.choice(words, 200), rng.choice(joins, 200))), ["en", "de", None, ""][i % 4])
            for i in range(40)]
    rows += [(1, None, "en"), (2, "", None), (None, " \n ", "fr"), (4, LONG, "en"), (4, LONG, "en"), (5, "one", "fr")]
    return rows + [(6, "new york city is not new york state. in New York", "nl")] * 30


def test_collocations_equal_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns({"phrase": F.lit("x"), "key": F.lit(1), "f": F.lit(2)})
    arrow_batches(spark, 7)
    phrases, totals = stripes.frequent_phrases(docs, scratch(spark, "t"))
    f, n = brute_phrases(rows, stripes.MIN_COUNT)
    got = phrases.collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in got} == f and len(got) == len(f)
    assert all(r.words == len(r.phrase.split(" ")) for r in got)
    assert {r.lang: r.n for r in totals.collect()} == {k: c for k, c in n.items() if c}
    result = stripes.collocations(phrases).collect()
    want = brute_collocations(f)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.score) for r in result} == want and len(result) == len(want)
    assert ("nl", "new york city is") not in want or ("nl", "new york") in want


def test_small_filter_and_many_flushes_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {tuple(r) for r in stripes.frequent_phrases(docs, scratch(spark, "t"))[0].collect()}
    monkeypatch.setattr(stripes, "PART_TOKENS", 20_000)
    monkeypatch.setattr(stripes, "RUN_BYTES", 1 << 16)
    got = stripes.frequent_phrases(docs, scratch(spark, "t"), filter_bits=1 << 15)[0].collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_stripes_flush_when_they_hold_too_much():
    class Seen:
        value = staticmethod(lambda keys: np.ones(len(keys), dtype=bool))

    s = stripes._Stripes()
    a = np.arange(10, dtype=np.uint64)
    s.add(a, a + np.uint64(1), np.ones(10, np.int64))
    s.add(a[:5], a[:5] + np.uint64(1), np.full(5, 3))
    prefix, word, count = s.merged()
    assert dict(zip(prefix.tolist(), count.tolist())) == {i: 4 if i < 5 else 1 for i in range(10)}
    assert (word - prefix == 1).all()
    block = list(stripes._blocks(s, 3))[0].to_pylist()
    assert sum(b["entries"] for b in block) == 10 and not s.held
    for b in block:
        gap, size, w, c = stripes._unpacked(b["block"], [b["stripes"], b["stripes"], b["entries"], b["entries"]])
        assert (np.repeat(np.cumsum(gap, dtype=np.uint64), size.astype(int)) + np.uint64(1) == w).all()


def test_scores_pass_64_bits(spark):
    big = 5 * 10**18
    rows = [("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big // 3), ("en", "c", 1, big),
            ("en", "a b c", 3, big // 4), ("en", "b c", 2, big // 4)]
    got = stripes.collocations(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).collect()
    f = {(x, tuple(p.split(" "))): c for x, p, _, c in rows}
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.score) for r in got} == brute_collocations(f)


def test_collocations_of_an_empty_table(spark, tmpdir_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmpdir_path}/documents.parquet")
    df = stripes.op11_stripes_collocations(spark, tmpdir_path)
    assert df.collect() == [] and df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# --- FM-index and decontamination -----------------------------------------------------------------


def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(1)
    for n, kinds in ((1, 1), (2, 1), (50, 1), (300, 2), (500, 40), (2000, 5)):
        s = np.append(rng.integers(1, kinds + 1, n - 1), 0)
        assert fm_index.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_wavelet_tree_ranks_and_access():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 7, 300):
        s = rng.integers(0, kinds, 700)
        tree = fm_index.WaveletTree(s, kinds)
        c, at = rng.integers(0, kinds, 400), rng.integers(0, 701, 400)
        assert tree.rank(c, at).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, at)]
        symbol, nth = tree.access(np.arange(700))
        assert symbol.tolist() == s.tolist() and nth.tolist() == [int((s[:i] == x).sum()) for i, x in enumerate(s)]


def test_backward_search_finds_and_locates_every_occurrence():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 4, n).astype(np.uint64) for n in (200, 0, 1, 90, 90, 33)]
    texts[4] = texts[3]
    index = fm_index.FMIndex(np.concatenate(texts), np.array([len(t) for t in texts]))
    for _ in range(60):
        phrase = rng.integers(0, 5, rng.integers(1, 6)).astype(np.uint64)
        low = high = None
        for k, w in enumerate(phrase[::-1]):
            symbol = index.symbol(np.array([w]))
            if not symbol[0]:
                low = high = np.zeros(1, np.int64)
                break
            low, high = index.extend(symbol, low, high) if k else index.whole(symbol)
        got = sorted(zip(*(x.tolist() for x in index.locate(np.arange(low[0], high[0])))))
        assert got == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - len(phrase) + 1)
                       if (x[i:i + len(phrase)] == phrase).all()]


def words_of(text):
    return re.findall("[^\x00-/:-`{-\x7f]+", lower(text))


def brute_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        m = min(len(w), 10)
        for i in range(len(w) - m + 1) if w else ():
            windows[tuple(w[i:i + m])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if items_ := windows.get(tuple(w[i:i + m])):
                    hit.update(range(i, i + m))
                    found |= items_
        found = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), sorted(hit), found))
    return out


PASSAGE = "It was the best of times, it was the worst of times -- it was the age of wisdom"
BENCH = [(1, PASSAGE), (1, PASSAGE), (2, "best of TIMES"), (3, None), (4, "  ...  "), (None, "no id here at all"), (5, "ü"),
         (6, "a a a a a a a a a a a a"), (10, "times it was the age of wisdom it was the age")]
TEXTS = [None, "", " .,;\n", PASSAGE, PASSAGE + " " + PASSAGE, "x" + PASSAGE, "the best of times", LONG + PASSAGE + LONG,
         "a " * 5000, "a " * 9, "Ü ü", "no id, here: at all!", "IT_WAS_THE_WORST_OF_TIMES_IT_WAS_THE_AGE", PASSAGE, "日本 ü 語"]


@pytest.mark.parametrize("words", [None, 40])
def test_hits_and_spans_equal_brute_force(spark, monkeypatch, words):
    docs = [(i % 12 or None, t) for i, t in enumerate(TEXTS)]
    if words:  # parts of long texts, and blocks of few items, run in this process
        monkeypatch.setattr(fm_decontam, "SHARD_WORDS", words)
        texts = [(t or "").encode() for t in TEXTS]
        folder = scratch(spark, "t")
        items = [((str(i).encode() if i is not None else None), (t or "").encode()) for i, t in BENCH]
        names = []
        for n in range(0, len(items), 2):
            part = items[n:n + 2]
            trie = fm_decontam._trie(fm_decontam.Words([t.translate(fm_decontam._FOLD) for _, t in part]), len(part))
            for k, v in trie.items():
                fm_decontam.save_array(f"{folder}/{n}", k, v)
            fm_decontam.save_array(f"{folder}/{n}", "ids", np.frombuffer(b"".join(i or b"" for i, _ in part), np.uint8))
            fm_decontam.save_array(f"{folder}/{n}", "id_size", np.array([-1 if i is None else len(i) for i, _ in part]))
            names.append(f"{folder}/{n}")
        w, hit, found = fm_decontam._scan(texts, lambda: (fm_decontam._Block(x) for x in names))
        size = np.bincount(w.doc, minlength=len(texts))
        first = np.cumsum(size) - size
        got = [(d[0], int(n), np.flatnonzero(hit[a:a + n]).tolist(), sorted(x.decode() for x in own))
               for d, n, a, own in zip(docs, size, first, found)]
        assert got == brute_hits(docs, BENCH)
        return
    arrow_batches(spark, 4)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"items": F.lit(1), "spans": F.lit(2)})
    bench = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("block", F.lit("x"))
    got = fm_decontam.removal_spans(df, bench).collect()
    want = brute_hits(docs, BENCH)
    key = lambda x: (x[0] or 0, x[1], x[2], x[3])
    mine = [(r.doc_id, r.n_words, [k for s in r.spans for k in range(s.first, s.last + 1)], list(r.items)) for r in got]
    assert sorted(mine, key=key) == sorted(want, key=key) and all(r.n_hit == sum(s.last + 1 - s.first for s in r.spans) for r in got)


def test_texts_without_their_spans(spark):
    texts = [f"Keep this. {PASSAGE}! And é this.", "clean text", PASSAGE, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    got = {r.doc_id: fm_decontam.without_spans(texts[r.doc_id], r.spans) for r in fm_decontam.removal_spans(df, bench).collect()}
    assert got == {0: "Keep this. ! And é this.", 1: "clean text", 2: "", 3: None}


def test_decontamination_of_empty_tables(spark, tmpdir_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    assert fm_decontam.op12_fm_decontam(spark, tmpdir_path).collect() == []
    df = spark.createDataFrame([(1, PASSAGE)], "doc_id long, text string")
    r = fm_decontam.removal_spans(df, spark.read.parquet(f"{tmpdir_path}/benchmark.parquet")).first()
    assert (r.n_words, r.n_hit, r["items"], r.spans) == (18, 0, [], [])
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256)).first()[0]


# --- whitening -------------------------------------------------------------------------------------


@pytest.mark.parametrize("d", [1, 2, 5, 30])
def test_counts_and_pairs_equal_eigh(d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    spectra = [rng.random(d) * 10, np.ones(d), np.append([5.0] * min(3, d), np.zeros(max(0, d - 3))), 10.0 ** -np.arange(d),
               np.append([3, 3 - 1e-9], rng.random(max(0, d - 2)))[:d], -rng.random(d)]
    for values in spectra:
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        w = np.linalg.eigvalsh(a)
        for s in (0.11, 1.0001, -1.0, 4.0):
            assert spectrum.inertia(a, s) == ((w < s).sum(), 0, (w > s).sum())
        got = spectrum.leading(a, 8)
        above = w[w > 1e-12 * np.abs(w).max()][::-1][:8]
        assert len(got) >= len(above) and np.allclose([e for e, _ in got][:len(above)], above, rtol=0, atol=1e-13 * np.abs(w).max())
        if got:
            u = np.stack([v for _, v in got], axis=1)
            assert np.abs(u.T @ u - np.eye(len(got))).max() < 1e-13
            assert np.abs(a @ u - u * [e for e, _ in got]).max() < 1e-12 * np.abs(w).max()


def test_inertia_of_matrices_that_need_pivots_of_two():
    assert spectrum.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 0, 1)
    assert spectrum.inertia(np.zeros((3, 3)), 0.0) == (0, 3, 0)
    assert spectrum.inertia(np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]]), 0.0) == (1, 1, 1)


def brute_whitened(x):
    n, total = len(x), x.sum(axis=0)
    z = np.array([[float(Fraction(int(n * v - s), n)) for v, s in zip(row, total)] for row in x])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return z @ u / np.sqrt(e), e / np.trace(z.T @ z / n), [int(sum((int(n * v - s)) ** 2 for v, s in zip(row, total))) for row in x]


def test_whitening_query_equals_eigh(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    table = table[[v is not None and all(c is not None and np.isfinite(c) for c in v) for v in table.embedding]]
    x = np.floor(1024 * np.stack(table.embedding).astype(float)).astype(np.int64) + 100_000
    w, explained, deviation = brute_whitened(x)
    got = whitening.op13_spectrum_whitening(spark, SF).toPandas()
    assert len(got) == 8 * len(table) and set(got.n) == {len(table)} and got.identity_error.nunique() == 1
    assert 0 <= got.identity_error[0] < 1e-9
    own = got.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    own = own * np.sign((own * w).sum(axis=0))  # the same sign for all rows
    assert np.abs(own - w).max() < 1e-9
    assert got[got.component == 3].set_index("vec_id").deviation.loc[table.vec_id].tolist() == deviation
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-12)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]), (5, [1.0, -inf, 1.0]),
            (6, [-1.0, 0.25, 3.0]), (6, [-1.0, 0.25, 3.0]), (None, [0.0, 1.0, -2.0]), (8, [4.0]), (9, []), (10, [0.5, 0.5, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {"v": F.lit(1), "w": F.lit(1), "component": F.lit(1), "n": F.lit(3)})
    arrow_batches(spark, 2)
    got = whitening.whitened(df).toPandas()
    fit = np.array([[1, 2, .5], [-1, .25, 3], [-1, .25, 3], [0, 1, -2], [4, 0, 0], [0, 0, 0], [.5, .5, 9]])
    x = np.floor(1024 * fit).astype(np.int64) + 100_000
    w, explained, deviation = brute_whitened(x)
    assert len(got) == 21 and set(got.n) == {7} and got.vec_id.isna().sum() == 3
    assert sorted(got[got.component == 1].deviation) == sorted(deviation)
    for k in (1, 2, 3):
        own = np.sort(np.abs(got[got.component == k].whitened))
        assert np.allclose(own, np.sort(np.abs(w[:, k - 1])), atol=1e-9)


def test_whitening_without_spread_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        df = whitening.whitened(spark.createDataFrame(rows, schema))
        assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]
    line = whitening.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], schema)).collect()
    assert len(line) == 5 and {r.component for r in line} == {1}  # a line has one component


def test_huge_entries_keep_exact_sums(spark):
    rows = [(i, [1e30 * (i - 1), 1e12 * i, 1.0]) for i in range(4)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in got} == {None}
    z = whitening._products(np.array([[1 << 40, -3], [5, 1 << 41]], dtype=np.int64))
    assert z.tolist() == [[(1 << 80) + 25, -3 * (1 << 40) + 5 * (1 << 41)], [-3 * (1 << 40) + 5 * (1 << 41), (1 << 82) + 9]]
