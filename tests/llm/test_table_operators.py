"""Operators on whole tables: mixing, quality rules, sharding, near duplicates, tool calls, the pipeline."""

import json
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import chosen_path, ipf_mixing, kd_sharding, mcd_rules, tool_calls
from pricepanel.llm.common import arrow_batches, scratch

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000


def odd_documents(spark, **more):
    rows = [(1, None, "en", "a"), (2, "", None, "a"), (3, "x", "en", None), (4, LONG, "de", "b"), (5, " \n ", "en", "a"),
            (6, "one two three", "en", "a"), (6, "one two three", "en", "a"), (None, "no id at all", None, None),
            (7, "one two three", "fr", "b"), (8, "日本語 🙂", "ja", "c")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- mixing ----------------------------------------------------------------------------------


def test_raking_equals_numpy_and_meets_all_marginals(spark):
    rng = np.random.default_rng(2)
    table = rng.integers(1, 1000, size=(5, 3, 4))
    rows = [(f"s{i}", f"l{j}", f"t{k}", int(table[i, j, k])) for i in range(5) for j in range(3) for k in range(4)]
    cells = spark.createDataFrame(rows, "_source string, _lang string, _topic string, tokens long")
    goals = [rng.dirichlet(np.ones(n)) for n in table.shape]
    targets = {d: spark.createDataFrame([(f"{d[0]}{i}", float(x)) for i, x in enumerate(g)], "level string, share double")
               for d, g in zip(ipf_mixing.DIMS, goals)}
    got = ipf_mixing.rake(cells, targets, scratch(spark, "t"), tolerance=1e-9).collect()
    w, total = table.astype(float), table.sum()
    for _ in range(200):
        for axis, g in enumerate(goals):
            other = tuple(a for a in range(3) if a != axis)
            w = w * (g * total / w.sum(axis=other)).reshape([-1 if a == axis else 1 for a in range(3)])
    for r in got:
        i, j, k = (int(r[c][1:]) for c in ("_source", "_lang", "_topic"))
        assert r.w == pytest.approx(w[i, j, k], rel=1e-5)


def test_mixing_query_is_calibrated(spark):
    rows = ipf_mixing.op1_ipf_mixing(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(ipf_mixing.SAMPLE_SHARE * total, rel=1e-6)
    for d, power in ipf_mixing.POWERS.items():
        have, weight = Counter(), Counter()
        for r in rows:
            have[r[d]] += r.n_tokens
            weight[r[d]] += r.n_tokens * r.token_weight
        whole = sum(t ** power for t in have.values())
        for level, t in have.items():
            assert weight[level] == pytest.approx(total * t ** power / whole, rel=1e-4)
    drawn = sum(r.n_tokens for r in rows if r.sampled)
    assert 0.5 * total < drawn < 0.7 * total


def test_targets_that_no_weights_meet_are_reported(spark):
    """Source a has only language x, b only y: their shares cannot differ."""
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 30)], "_source string, _lang string, _topic string, tokens long")
    targets = {d: spark.createDataFrame(rows, "level string, share double") for d, rows in
               {"source": [("a", 0.5), ("b", 0.5)], "lang": [("x", 0.2), ("y", 0.8)], "topic": [("t", 1.0)]}.items()}
    with pytest.warns(ipf_mixing.RakingWarning, match="source b is off its target by 0.6"):
        ipf_mixing.rake(cells, targets, scratch(spark, "t"), max_sweeps=3)


def test_mixing_edge_rows(spark):
    odd = odd_documents(spark, _u="clash", probability=-1.0, topic="clash")
    kept = ipf_mixing.sample_documents(odd, share=1.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()  # everything at share 1
    again = [sorted(map(str, ipf_mixing.sample_documents(x, share=0.5).collect())) for x in (odd, odd.repartition(5))]
    assert again[0] == again[1]
    assert ipf_mixing.sample_documents(odd.limit(0)).count() == 0


# --- quality rules ---------------------------------------------------------------------------


def brute_counts(text):
    t = (text or "").encode()
    words = t.split()
    lines = [x for x in t.split(b"\n") if x.split()]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    return (len(words), sum(len(w.decode()) for w in words), sum(t.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")),
            len(lines) - len(set(lines)), len(inside))


def test_base_counts_equal_brute_force(spark):
    rows = mcd_rules.op2_mcd_rules(spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_counts_of_odd_texts():
    texts = ["", LONG, "a b c d e a b c d e", "é#ü\n\né#ü\n \n", "x" * 9000, "a\x0bb\x0cc"]
    counts, x = mcd_rules.statistics([t.encode() for t in texts])
    assert [tuple(c) for c in counts] == [brute_counts(t) for t in texts] and np.isfinite(x).all()


def brute_mcd(x, steps=mcd_rules.STEPS):
    """Concentration steps from the median and MADs, then reweighting; numpy on one group."""
    floor = np.diag(np.square(mcd_rules.FLOOR))
    centre = np.median(x, axis=0)
    mad = np.maximum(1.4826 * np.median(abs(x - centre), axis=0), mcd_rules.FLOOR)
    z = np.tanh((x - centre) / mad)
    best = None
    for cov in (np.diag(mad ** 2) + floor, (z.T @ z / len(x)) * np.outer(mad, mad) + floor):
        c = centre
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(cov), x - c)
            inside = x[d <= np.quantile(d, mcd_rules.COVERAGE)]
            c, cov = inside.mean(axis=0), np.cov(inside.T, bias=True) + floor
        if best is None or np.linalg.slogdet(cov)[1] < best[0]:
            best = (np.linalg.slogdet(cov)[1], c, cov)
    return best[1], best[2]


def test_robust_estimate_resists_outliers_and_follows_numpy(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(0, 1, (900, mcd_rules.DIM)) @ np.diag([.3, .4, .5, .6, .7, .8]) + 2
    bad = rng.normal(9, .1, (200, mcd_rules.DIM))
    x = np.concatenate([good, bad])
    rows = spark.createDataFrame([("g", i % mcd_rules.SALTS, r.tolist()) for i, r in enumerate(x)],
                                 "g string, salt int, x array<double>")
    est = mcd_rules.estimates(rows, scratch(spark, "t")).first()
    centre, _ = brute_mcd(x)
    assert np.abs(np.array(est.centre) - centre).max() < 0.1 and np.abs(np.array(est.centre) - 2).max() < 0.15
    w = np.zeros((mcd_rules.DIM, mcd_rules.DIM))
    w[np.tril_indices(mcd_rules.DIM)] = est.whiten
    d2 = (((x - est.centre) @ w.T) ** 2).sum(axis=1)
    assert d2[900:].min() > mcd_rules.CHI2_REJECT > np.quantile(d2[:900], 0.999)
    assert np.mean(d2[:900]) == pytest.approx(mcd_rules.DIM, rel=0.35)


@pytest.mark.parametrize("share", [0.30, 0.38, 0.45])
def test_estimate_resists_junk_up_to_nearly_half(spark, share):
    rng = np.random.default_rng(5)
    good = rng.normal(0, 1, (900, mcd_rules.DIM)) @ np.diag([.3, .4, .5, .6, .7, .8]) + 2
    bad = rng.normal(9, .1, (int(900 * share / (1 - share)), mcd_rules.DIM))
    x = np.concatenate([good, bad])
    rows = spark.createDataFrame([("g", i % mcd_rules.SALTS, r.tolist()) for i, r in enumerate(x)],
                                 "g string, salt int, x array<double>")
    est = mcd_rules.estimates(rows, scratch(spark, "t")).first()
    w = np.zeros((mcd_rules.DIM, mcd_rules.DIM))
    w[np.tril_indices(mcd_rules.DIM)] = est.whiten
    d2 = (((x - est.centre) @ w.T) ** 2).sum(axis=1)
    assert d2[900:].min() > mcd_rules.CHI2_REJECT > d2[:900].max()


def test_small_leftover_groups_are_judged_by_all_rows(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(2, .5, (300, mcd_rules.DIM)), rng.normal(2, .5, (5, mcd_rules.DIM)),
                        rng.normal(9, .1, (5, mcd_rules.DIM))])
    rows = [("en" if i < 300 else "xx", "s", (i, 100, 500, 0, 0, 0, r.tolist())) for i, r in enumerate(x)]
    stats = f"struct<doc_id: long, {mcd_rules.STATS_SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>"
    df = spark.createDataFrame(rows, f"lang string, source string, _stats {stats}")
    got = mcd_rules.verdicts(df, mcd_rules.fit(df, scratch(spark, "t"))).collect()
    assert len(got) == 310 and {r._stats.doc_id for r in got if not r.kept} == set(range(305, 310))


def test_quality_rules_reject_junk_and_keep_the_rest(spark):
    rows = mcd_rules.op2_mcd_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = [r for r in rows.join(labels, "doc_id").collect() if not r.base_failed]
    assert all(r.kept for r in got if r.quality == 1)
    assert np.mean([not r.kept for r in got if r.quality == 0]) > 0.9


def test_quality_filter_edge_rows(spark):
    arrow_batches(spark)
    odd = odd_documents(spark, g="clash", x=1, kept="clash", _l=2, n_words="clash")
    both = odd.unionByName(documents(spark).withColumns({"g": F.lit("z"), "x": F.lit(1), "kept": F.lit("k"), "_l": F.lit(2),
                                                         "n_words": F.lit("n")}))
    kept = mcd_rules.filter_documents(both)
    assert kept.columns == both.columns
    assert kept.where("doc_id between 1 and 3 and g = 'clash'").count() == 0  # under ten words
    assert mcd_rules.filter_documents(odd.limit(0)).count() == 0
    only = mcd_rules.filter_documents(odd)  # too few rows for an estimate: base rules only
    assert only.count() == 0


# --- sharding --------------------------------------------------------------------------------


def check_shards(rows, shards):
    sizes = Counter()
    slots = {}
    for r in rows:
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return sizes


def test_shards_hold_equal_bytes_in_gapless_slots(spark):
    rows = kd_sharding.op3_kd_sharding(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r["size"] == len(docs[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id]) for r in rows)
    sizes = check_shards(rows, 16)
    assert len(sizes) == 16
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_any_number_of_shards(spark, shards):
    df = spark.createDataFrame([(i, "x" * (i % 50), None, f"s{i % 3}", 0) for i in range(700)], DOCS)
    sizes = check_shards(kd_sharding.shard_documents(df, shards).collect(), shards)
    assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= 200


def test_many_shards(spark):
    df = spark.createDataFrame([(i, f"t{i}" + "x" * (i % 90), f"l{i % 4}", f"s{i % 9}", 0) for i in range(6400)], DOCS)
    sizes = check_shards(kd_sharding.shard_documents(df, 64).collect(), 64)
    mean = sum(sizes.values()) / 64
    assert len(sizes) == 64 and max(sizes.values()) <= 1.05 * mean and min(sizes.values()) >= 0.95 * mean


def test_groups_stay_whole_as_far_as_the_law_allows(spark):
    """A group of a fifth of a shard stays whole at the early cuts; one of half the rows is divided."""
    rows = [(i, f"text {i} " * 8, "en", f"s{i % 5}", 0) for i in range(3200)]
    rows += [(10_000 + i, f"copy {i // 20} " * 8, "en", "s", 0) for i in range(1600)] + [(20_000 + i, "hot " * 15, "en", "s", 0) for i in range(4800)]
    got = kd_sharding.shard_documents(spark.createDataFrame(rows, DOCS), 8).collect()
    sizes = check_shards(got, 8)
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) <= 1.08 * mean and min(sizes.values()) >= 0.92 * mean
    of = {}
    for r in got:
        of.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    assert Counter(len(s) for k, s in of.items())[1] >= len(of) - 1 - 7 and max(map(len, of.values())) >= 4


def test_the_groups_of_equal_texts_are_merged_not_broadcast(spark):
    rows = [(i, f"text {i % 50}", "en", "s", 0) for i in range(200)]
    meta = kd_sharding.metadata(spark.createDataFrame(rows, DOCS))
    plan = kd_sharding.grouped(meta, scratch(spark, "t"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_shards_of_odd_and_of_equal_rows(spark):
    odd = odd_documents(spark, shard="clash", size=-5, node="clash")
    rows = kd_sharding.shard_documents(odd).collect()
    check_shards(rows, 16)
    assert len(rows) == odd.count()
    same = spark.createDataFrame([(i, "copy", "en", "s", 4) for i in range(600)], DOCS)
    sizes = check_shards(kd_sharding.shard_documents(same, 4).collect(), 4)
    assert max(sizes.values()) - min(sizes.values()) <= 10
    assert kd_sharding.shard_documents(odd.limit(0)).count() == 0


def test_slots_follow_the_ids_in_bounded_ranges(spark, monkeypatch):
    rows = [(i + 10**15 * (i % 2) if i % 5 else None, "x" * (i % 50), "en", "s", 0) for i in range(800)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    made = []
    in_ranges = kd_sharding.in_ranges
    monkeypatch.setattr(kd_sharding, "in_ranges", lambda *a: made.append(in_ranges(*a)) or made[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = kd_sharding.shard_documents(df, 4).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    check_shards(got, 4)
    assert max(Counter(r.part for r in made[0].collect()).values()) <= 250  # of 800 rows in 8 ranges
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"])
    for s in range(4):
        mine = [r for r in got if r.shard == s]
        assert [key(r) for r in sorted(mine, key=lambda r: r.slot)] == sorted(map(key, mine))


def test_equal_texts_stay_in_one_shard(spark):
    rows = [(i, f"text {i % 1500} " * (1 + i % 1500 % 9), f"l{i % 7}", f"s{i % 5}", 0) for i in range(4500)]
    got = kd_sharding.shard_documents(spark.createDataFrame(rows, DOCS)).collect()
    sizes = check_shards(got, 16)
    assert len(got) == 4500 and max(sizes.values()) - min(sizes.values()) <= 0.1 * sum(sizes.values()) / 16
    shards = {}
    for r in got:
        shards.setdefault(rows[r.doc_id][1], set()).add(r.shard)
    assert all(len(x) == 1 for x in shards.values())


# --- near duplicates -------------------------------------------------------------------------


def brute_classes(texts):
    """Links and class of every distinct text, by comparing all sets."""
    def shingles(t):
        w = t.lower().encode().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    keys = sorted(set(texts))
    sets = [shingles(t) for t in keys]
    links, root = [0] * len(keys), list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    return {t: (links[i], find(i)) for i, t in enumerate(keys)}


def check_classes(rows, texts):
    want = brute_classes([texts[r.did] for r in rows])
    by_class, by_root = {}, {}
    for r in rows:
        links, root = want[texts[r.did]]
        assert r.links == links, texts[r.did][:80]
        assert by_class.setdefault(r.class_id, root) == root and by_root.setdefault(root, r.class_id) == r.class_id
    for c, members in ((c, [r.did for r in rows if r.class_id == c]) for c in by_class):
        assert c == min(members)


def test_join_equals_brute_force_on_the_table(spark):
    arrow_batches(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check_classes(chosen_path.near_classes(docs).collect(), {r.doc_id: r.text or "" for r in docs.collect()})


@pytest.mark.parametrize("small,block", [(200, 512), (4, 16)])
def test_large_groups_are_whole(spark, monkeypatch, small, block):
    """A group of near copies, one of texts that share a passage, and copies; leaves and blocks far too small for them."""
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    leaves = chosen_path.leaves
    monkeypatch.setattr(chosen_path, "leaves", lambda t, f: leaves(t, f, small))
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(words, 120))
    passage = list(rng.choice(words, 60))
    texts = []
    for i in range(70):
        t = list(base)
        t[int(rng.integers(0, 120))] = f"changed{i}"
        texts.append(" ".join(t))
    texts += [" ".join([*rng.choice(words, 40), *passage]) for _ in range(60)]
    texts += [" ".join(base)] * 30 + ["", " ", "short text", "short text", "Short Text"]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    check_classes(chosen_path.near_classes(df).collect(), dict(enumerate(texts)))


def test_long_near_copies_are_compared_in_pieces(spark):
    """No row that is shuffled to a comparison grows with the length of its text."""
    rng = np.random.default_rng(9)
    texts = []
    for g in range(3):
        base = rng.choice([f"w{i}" for i in range(20_000)], 9000)
        for changed in (0, 1, 150, 260, 400, 600):  # similar by 1 to 0.5
            t = list(base)
            for k, i in enumerate(rng.choice(9000, changed, replace=False)):
                t[i] = f"changed{k}"
            texts.append(" ".join(t))
    texts += [" ".join(rng.choice(["a", "b"], 9000))] * 2 + ["short text"]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    folder = scratch(spark, "t")
    check_classes(chosen_path.near_classes(df, folder).collect(), dict(enumerate(texts)))
    sets = spark.read.parquet(f"{folder}/sets").agg(F.max(F.length("shingles")), F.sum(F.length("shingles"))).first()
    assert sets[0] <= 8 * 1024 < sets[1] / len(texts)


@pytest.mark.parametrize("held", [1, 500, 1 << 21])
def test_common_shingles_are_counted_by_ranges(monkeypatch, held):
    import pyarrow as pa
    monkeypatch.setattr(chosen_path, "HELD", held)
    rng = np.random.default_rng(10)
    pool = np.concatenate([rng.integers(0, 2**64, 3000, dtype=np.uint64), np.array([0, 1, 2**64 - 2, 2**64 - 1], dtype=np.uint64)])
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 5, 40, 700, 2500, 2500, 5000, 9000)] + [pool[-4:]]
    rows = [{"leaf": 7, "a": 0, "b": 0, "run": 2, "tid": 100 + i, "own": 0, "at": bytes(4 * chosen_path.RUNS), "place": i,
             "members": len(sets), "first": int(s[lo]) >> 1, "shingles": s[lo:lo + 50].tobytes()}
            for i, s in enumerate(sets) for lo in range(0, len(s), 50)]
    table = pa.Table.from_pylist(sorted(rows, key=lambda r: r["first"]))
    c = chosen_path._Comparison(table)
    for lo in range(0, table.num_rows, 3):
        c.add(table.slice(lo, 3))
        assert c.held <= max(held, 50 * len(sets))
    tid, links, edge = c.links()
    np.fill_diagonal(c.common, 0)  # of a set with itself only what others have too is counted
    assert c.common.tolist() == [[0 if x is y else len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert c.size.tolist() == [len(s) for s in sets]
    like = [[i != j and 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y)) for j, y in enumerate(sets)]
            for i, x in enumerate(sets)]
    assert dict(zip(tid.tolist(), links.tolist())) == {100 + i: sum(x) for i, x in enumerate(like) if any(x)}


def test_one_of_each_class_stays(spark):
    odd = odd_documents(spark, root="clash", tid=1, rows="clash")
    kept = chosen_path.one_of_each(odd)
    assert kept.columns == odd.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # 1: null and empty (2) are one text; 5: blank; 6: its repeated row and its copy 7 go
    assert [x[1] for x in got if not x[0]] == [1, 3, 4, 5, 6, 8] and sum(x[0] for x in got) == 1
    assert chosen_path.one_of_each(odd.limit(0)).count() == 0


def test_runs_reach_the_target_recall():
    s = chosen_path.NUMERATOR / chosen_path.DENOMINATOR
    assert 1 - (1 - s ** chosen_path.DEPTH) ** chosen_path.RUNS >= chosen_path.RECALL


# --- tool calls ------------------------------------------------------------------------------


def call(conv, turn, id_, name="search", arguments=None, depends_on=None):
    body = {"name": name, "id": id_, "arguments": {"limit": 3, "query": "ü"} if arguments is None else arguments}
    if depends_on:
        body["depends_on"] = depends_on
    return conv, turn, "tool_call", json.dumps(body)


def result(conv, turn, id_, content="ok"):
    return conv, turn, "tool_result", json.dumps({"content": content, "tool_call_id": id_})


def linked(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("status", F.lit("clash"))
    return tool_calls.link(df, tool_calls.SCHEMAS).collect()


def test_calls_are_linked_ordered_validated_and_canonical(spark):
    rows = [call(1, 4, "c", depends_on="b"), call(1, 2, "b", depends_on="a"), call(1, 0, "a"), result(1, 1, "a", {"z": 1, "a": [1.5]}),
            result(1, 3, "b"), call(1, 6, "d", "translate", {"query": "x", "target": "xx"}), call(1, 7, "e", "nothing"),
            call(1, 8, "f", depends_on="gone"), call(2, 0, "a", arguments='{"query":"q","limit":1}'), result(2, 1, "a"),
            result(2, 2, "q"), (3, 0, "user", "not a tool message")]
    got = {(r.conv_id, r.call_id): r for r in linked(spark, rows)}
    assert {k: (r.status, r.level) for k, r in got.items()} == {
        (1, "a"): ("linked", 0), (1, "b"): ("linked", 1), (1, "c"): ("unanswered", 2), (1, "d"): ("invalid_arguments", 0),
        (1, "e"): ("unknown_tool", 0), (1, "f"): ("unknown_dependency", 0), (2, "a"): ("linked", 0), (2, "q"): ("orphan", None)}
    assert got[1, "a"].record == ('{"call":{"arguments":{"limit":3,"query":"ü"},"id":"a","name":"search"},'
                                  '"result":{"a":[1.5],"z":1}}')
    assert got[1, "d"].errors == ["$.target: not one of the allowed values"]
    for r in got.values():
        assert json.dumps(json.loads(r.record), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.record


def test_cycles_duplicates_nulls_and_long_chains(spark):
    chain = [call(9, i, f"k{i}", depends_on=f"k{i - 1}" if i else None) for i in range(300)]
    rows = chain + [call(4, 0, "x", depends_on="y"), call(4, 1, "y", depends_on="x"), call(4, 2, "z", depends_on="x"),
                    call(4, 3, "s", depends_on="s"), call(5, 0, "a"), call(5, 0, "a"), call(5, 1, "a"), result(5, 2, "a"),
                    result(5, 3, "a"), (6, 0, "tool_call", None), (6, 1, "tool_call", ""), (6, 2, "tool_result", "[1]"),
                    (6, 3, "tool_call", '{"id":"p"}'), call(None, None, "n"), (None, 1, None, None)]
    got = linked(spark, rows)
    assert {r.call_id: r.level for r in got if r.conv_id == 9} == {f"k{i}": i for i in range(300)}
    assert Counter(r.status for r in got if r.conv_id == 4) == {"cycle": 4}
    assert Counter((r.kind, r.status) for r in got if r.conv_id == 5) == {
        ("call", "linked"): 1, ("call", "duplicate"): 2, ("result", "duplicate"): 1}
    assert Counter(r.status for r in got if r.conv_id == 6) == {"malformed": 4}
    assert [r.status for r in got if r.conv_id is None] == ["unanswered"]


def test_tool_calls_of_the_conversations(spark):
    rows = tool_calls.op7_tool_calls(spark, SF).collect()
    talk = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    calls = {f"call_{r.conv_id}_{r.turn}" for r in talk if r.role == "user"}
    answers = {f"call_{r.conv_id}_{r.turn - 1}" for r in talk if r.role == "assistant"}
    assert {r.call_id for r in rows if r.kind == "call"} == calls
    assert {r.call_id for r in rows if r.status == "orphan"} >= {f"call_{r.conv_id}_-1" for r in talk if r.role == "system" and r.turn == 0}
    for r in rows:
        if r.status in ("linked", "unanswered"):
            assert (r.call_id in answers) == (r.status == "linked")
    assert sum(r.status == "linked" for r in rows) > 10


def test_no_messages(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tool_calls.link(empty, tool_calls.SCHEMAS).count() == 0


@pytest.mark.parametrize("value,schema,errors", [
    (3, {"type": "integer"}, 0), (3.0, {"type": "integer"}, 0), (3.5, {"type": "integer"}, 1), (True, {"type": "integer"}, 1),
    ([1, "a"], {"type": "array", "items": {"type": "number"}}, 1), ({"a": 1}, {"type": "object", "additionalProperties": False}, 1),
    ({}, {"type": "object", "required": ["a"]}, 1), (None, {"type": "null"}, 0), ("", {"type": "string", "minLength": 1}, 1)])
def test_schema_validation(value, schema, errors):
    assert len(tool_calls.validate(value, schema)) == errors


@pytest.mark.parametrize("value,schema,errors", [
    (None, {"type": ["string", "null"]}, 0), (3, {"type": ["string", "null"]}, 1), (3, {"type": ["string", "integer"]}, 0),
    (10**400, {"type": "integer"}, 0), (10**400, {"type": "integer", "maximum": 5.5}, 1), (1, {"type": "no such type"}, 1),
    (True, {"enum": [1]}, 1), (1.0, {"enum": [1]}, 0), ({"a": [1, 2]}, {"enum": [{"a": [1, 2.0]}]}, 0)])
def test_schema_types_and_values(value, schema, errors):
    assert len(tool_calls.validate(value, schema)) == errors


def test_messages_that_json_or_utf8_cannot_hold_are_malformed_with_a_reason(spark):
    body = '{"id":"%s","name":"search","arguments":%s}'
    rows = {"a": ('{"query":"q","limit":1%s}' % ("0" * 400), None), "b": ('{"query":"q","limit":1e400}', "number beyond a double: 1e400"),
            "c": ('{"query":"q","limit":NaN}', "not a JSON number: NaN"), "d": ('{"query":"\\ud800","limit":1}', "half of a surrogate pair"),
            "e": ("[" * 100_000 + "]" * 100_000, "nested too deeply"), "f": ('{"query":"q","limit":-Infinity}', "not a JSON number: -Infinity"),
            "g": ('{"query":"\\ud83d\\ude42","limit":2.0}', None), "h": ('{"limit":1e2,"query":-0.0}', None),
            "i": ('{"query":"q","limit":1%s}' % ("0" * 5000), "no JSON"), "j": ("{", "no JSON")}
    texts = [(1, i, "tool_call", body % (k, a)) for i, (k, (a, _)) in enumerate(rows.items())]
    texts += [(2, 0, "tool_call", '{"id":"x","arguments":{}}'), (2, 1, "tool_call", '{"id":"x","name":"n"}'), (2, 2, "tool_call", "3"),
              (2, 3, "tool_call", '{"id":"x","name":"n","arguments":{},"depends_on":[1]}'), (2, 4, "tool_result", '{"tool_call_id":"x"}'),
              (2, 5, "tool_result", '{"content":1}'), (2, 6, "tool_result", " ")]
    got = {(r.conv_id, r.turn): r for r in linked(spark, texts)}
    for i, (k, (_, reason)) in enumerate(rows.items()):
        r = got[1, i]
        assert (r.status == "malformed") == (reason is not None) and (reason is None or r.errors == [reason]), k
    assert got[1, 0].record.count("0") >= 400 and got[1, 0].errors == ["$.limit: above the maximum"]
    assert '"limit":2,"query":"🙂"' in got[1, 6].record and '"limit":100,"query":0' in got[1, 7].record
    assert [got[2, t].errors for t in range(7)] == [["no name"], ["no arguments"], ["no JSON object"], ["depends_on names no calls"],
                                                    ["no content"], ["no tool_call_id"], ["no text"]]


def brute_levels(needs):
    """Longest way from a call without dependency; None on or behind a cycle; what is missing counts for nothing."""
    needs = {k: {x for x in v if x in needs} for k, v in needs.items()}
    level = {}
    while True:
        ready = [k for k, v in needs.items() if k not in level and all(x in level for x in v)]
        if not ready:
            return {k: level.get(k) for k in needs}
        level |= {k: max((level[x] + 1 for x in needs[k]), default=0) for k in ready}


def test_levels_of_random_graphs_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for conv in range(30):
        n = int(rng.integers(1, 40))
        style = conv % 5
        needs = {}
        for i in range(n):
            if style == 0:  # ladder
                needs[f"k{i}"] = [f"k{j}" for j in (i - 1, i - 2) if j >= 0]
            elif style == 1:  # any earlier calls
                needs[f"k{i}"] = [f"k{j}" for j in rng.choice(i, min(i, int(rng.integers(0, 4))), replace=False)] if i else []
            elif style == 2:  # any calls: cycles too
                needs[f"k{i}"] = [f"k{j}" for j in rng.integers(0, n, int(rng.integers(0, 2)))] + (["gone"] if i % 7 == 3 else [])
            elif style == 3:  # chains that meet
                needs[f"k{i}"] = [f"k{j}" for j in (i - 3, i - 1 if i % 11 == 10 else -1) if j >= 0]
            else:  # all earlier calls
                needs[f"k{i}"] = [f"k{j}" for j in range(i)]
        rows += [call(conv, int(t), k, depends_on=needs[k] if len(needs[k]) != 1 else needs[k][0])
                 for t, k in zip(rng.permutation(n) if style == 2 else range(n), needs)]
        want |= {(conv, k): (v, "gone" in needs[k]) for k, v in brute_levels(needs).items()}
    got = {(r.conv_id, r.call_id): r for r in linked(spark, rows)}
    assert got.keys() == want.keys()
    for k, (level, gone) in want.items():
        assert got[k].level == level, k
        assert got[k].status == ("cycle" if level is None else "unknown_dependency" if gone else "unanswered"), k


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages_take_effect_and_keep_columns(spark):
    import corpus_pipeline
    docs = documents(spark)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    folder = scratch(spark, "t")
    kept = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert kept[-1] <= kept[-2]
    assert kept[1] < kept[0] and kept[2] < kept[1] and kept[3] < kept[2] and kept[4] < kept[3] and kept[5] == kept[4]
    junk = {i for i, q in labels.items() if q == 0}
    assert len(junk & kept[2]) <= 0.25 * len(junk & kept[1])
    # the third stage against brute force on its own input
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/1").collect()}
    classes = brute_classes(list(texts.values()))
    first = {}
    for i in sorted(texts):
        first.setdefault(classes[texts[i]][1], i)
    assert kept[3] == set(first.values())


def test_pipeline_run_equals_its_stages(spark):
    import corpus_pipeline
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "ids", "n_tokens"} <= set(got.columns) and got.count() > 50
