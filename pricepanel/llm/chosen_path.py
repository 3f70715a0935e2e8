"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles (lower-cased words). Every distinct text is
embedded as ``TOKENS`` min-hash tokens, of which two texts share a fraction equal
to their Jaccard similarity in expectation. A run follows, for each text, the
path of its tokens at coordinates drawn for that run: texts with the same token
stay together. A set of texts of at most ``SMALL`` is a leaf; a larger one is
split again by the next coordinate of the run, unless a sampled token holds
half of it together (then its texts are alike, and more splitting only loses
pairs) or ``DEPTH`` is reached. So a pair of similarity s meets in a run with
probability s**depth, and runs are repeated until the expected recall at the
threshold and full depth reaches ``RECALL``.

Leaves are compared by brute force: first by their sketches (a byte of each
token), which rules out almost all unlike pairs, then, for texts with a likely
partner, by their whole shingle sets, exactly. A large leaf is cut into blocks
of ``BLOCK`` texts, and every pair of blocks is a task of its own, so no pair is
lost to a bound and no group is gathered whole. Shingle sets travel in pieces of
``PIECE`` shingles in the order of their hashes; a comparison counts common
shingles range by range, so that what it holds is bounded by the number of its
texts and not by their lengths. A pair that meets in several
runs counts in the first one: every text carries its leaf of each run, and a
pair with a common leaf in an earlier run is passed over. Links are counted
inside the tasks and classes are carried by one edge a text and block, so no
task emits all pairs of a group. Classes are the connected components of the
links, found by minimum labels and pointer jumping on tables.

Defined results: texts of fewer than five words are the one shingle of all their
words; null, empty and blank texts have no shingles and form classes of equal
texts only; equal texts share a class and its links count distinct other texts
at or above the threshold; repeated rows give a row each; rows without id get a
class by their text (``class_id`` null if no member has an id); an empty table
gives no rows. Distinct texts are told apart by 64 bits of a hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, arrow_batches, byte_texts, chunks, documents, kept_table, mixed, scratch

SHINGLE = 5
# similarity >= NUMERATOR / DENOMINATOR
NUMERATOR, DENOMINATOR = 4, 5
TOKENS = 64
DEPTH = 4
RECALL = 0.9995
SMALL = 200
BLOCK = 512
PIECE = 1024
# shingles held before a range is counted; those kept for the next are at most PIECE for each text of a comparison
HELD = 1 << 21
# Of 64 sketch bytes a pair at 0.8 shares 51 on average (standard deviation 3.2); 32 is six deviations below.
LIKELY = 32
RUNS = math.ceil(math.log(1 - RECALL) / math.log(1 - (NUMERATOR / DENOMINATOR) ** DEPTH))

_RNG = np.random.default_rng(4242)
_MULTIPLIERS = _RNG.integers(0, 2**64, size=TOKENS, dtype=np.uint64) | np.uint64(1)
# coordinates of each run and depth; the first ones of all runs differ from one another
_COORDINATES = np.stack([_RNG.permutation(TOKENS)[:RUNS] for _ in range(DEPTH)], axis=1)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    low = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    for lo, hi in chunks(low):
        w = Words(low[lo:hi])
        gram, at = w.grams(SHINGLE)
        doc = w.doc[at]
        bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
        edges = np.searchsorted(w.doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            if bounds[i] < bounds[i + 1]:
                yield np.unique(gram[bounds[i]:bounds[i + 1]])
            elif edges[i] < edges[i + 1]:  # shorter than a shingle: all its words
                h = np.uint64(17)
                for x in w.hash[edges[i]:edges[i + 1]]:
                    h = mixed(np.array([h ^ x], dtype=np.uint64))[0]
                yield np.array([h], dtype=np.uint64)
            else:
                yield np.empty(0, dtype=np.uint64)


def min_hash(shingles: np.ndarray) -> np.ndarray:
    """TOKENS tokens of a non-empty set."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[lo:lo + 4096, None] * _MULTIPLIERS).min(axis=0))
    return mixed(least)


def paths(tokens: np.ndarray) -> np.ndarray:
    """Node ids (runs x depths) on the paths of a text: a hash of the run and the tokens so far."""
    out = np.empty((RUNS, DEPTH), dtype=np.uint64)
    node = mixed(np.arange(1, RUNS + 1, dtype=np.uint64))
    for d in range(DEPTH):
        node = mixed(node * np.uint64(0x9E3779B97F4A7C15) + tokens[_COORDINATES[:, d]])
        out[:, d] = node
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """did, tid (64-bit hash of the text), sketch (a byte a token), path of every row; the last two null without words."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            sketch, path = [], []
            for s in shingle_sets(byte_texts(b.column(2))):
                t = min_hash(s) if len(s) else None
                sketch.append(None if t is None else (t & np.uint64(255)).astype(np.uint8).tobytes())
                path.append(None if t is None else paths(t).tobytes())
            yield pa.RecordBatch.from_pydict({"did": b.column(0), "tid": b.column(1),
                                              "sketch": pa.array(sketch, pa.binary()),
                                              "path": pa.array(path, pa.binary())})

    return _identified(docs).mapInArrow(run, "did long, tid long, sketch binary, path binary")


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("did"), F.xxhash64(F.md5(text)).alias("tid"), text.alias("text"))


def _exploded(texts: DataFrame) -> DataFrame:
    """tid, run, n1..n4: a row a text and run."""
    columns = ["tid", "run", *[f"n{d}" for d in range(1, DEPTH + 1)]]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            tid = b.column(0).to_numpy(zero_copy_only=False)
            node = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.int64).reshape(len(tid), RUNS, DEPTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(tid, RUNS)), pa.array(np.tile(np.arange(RUNS, dtype=np.int32), len(tid))),
                 *[pa.array(np.ascontiguousarray(node[:, :, d]).ravel()) for d in range(DEPTH)]], names=columns)

    return texts.select("tid", "path").mapInArrow(run, "tid long, run int, " + ", ".join(
        f"{c} long" for c in columns[2:]))


def leaves(texts: DataFrame, folder: str, small: int = SMALL) -> DataFrame:
    """tid, run, leaf, n (texts in the leaf) of every text that shares a leaf in a run."""
    open_ = _exploded(texts)
    done = []
    for d in range(1, DEPTH + 1):
        node = f"n{d}"
        # sizes and rows are written apart, so that a hot node may be split over tasks in this join
        size = kept_table(open_.groupBy(node).agg(F.count("*").alias("n")).where("n > 1"), folder, f"sizes{d}")
        here = kept_table(open_.join(size, node), folder, f"paths{d}")
        ready = here.where(F.col("n") <= small)
        large = here.where(F.col("n") > small)
        if d < DEPTH:
            # a set that the next token holds together is a leaf already
            child = large.groupBy(node, f"n{d + 1}").agg(F.count("*").alias("_c"), F.first("n").alias("_n"))
            dense = child.groupBy(node).agg((F.max("_c") * 2 >= F.first("_n")).alias("_dense"))
            large = kept_table(large.join(dense, node), folder, f"large{d}")
            done.append(large.where("_dense").select("tid", "run", F.col(node).alias("leaf"), "n"))
            open_ = large.where("not _dense").drop("n", "_dense")
        else:
            done.append(large.select("tid", "run", F.col(node).alias("leaf"), "n"))
        done.append(ready.select("tid", "run", F.col(node).alias("leaf"), "n"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return kept_table(out, folder, "leaves")


def _blocks(members: DataFrame) -> DataFrame:
    """A row for every pair of blocks a member takes part in: a <= b, ``own`` its block."""
    n = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("tid", "leaf"), n).cast("int")
    return (members.withColumn("_blocks", n).withColumn("own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumns({"a": F.least("own", "_other"), "b": F.greatest("own", "_other")}).drop("_blocks", "_other"))


def _groups(batches, keys: int):
    """Consecutive rows of equal keys (the first ``keys`` columns) of sorted record batches."""
    import pyarrow as pa
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        k = np.stack([table.column(i).to_numpy() for i in range(keys)])
        cut = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
        for lo, hi in zip(cut[:-2], cut[1:-1]):
            yield table.slice(lo, hi - lo)
        rest = table.slice(cut[-2])
    if rest is not None and rest.num_rows:
        yield rest


def _met_before(run: int, at: np.ndarray) -> np.ndarray:
    """Pairs (members x members) with a common leaf in an earlier run; ``at``: leaves of each run, 0 for none."""
    met = np.zeros((len(at), len(at)), dtype=bool)
    for r in range(run):
        c = at[:, r]
        met |= (c[:, None] == c[None, :]) & (c != 0)[:, None]
    return met


def _pair_mask(own: np.ndarray, a: int, b: int) -> np.ndarray:
    """Pairs of one comparison: inside a block (a == b) or across two."""
    n = len(own)
    return np.triu(np.ones((n, n), dtype=bool), 1) if a == b else np.outer(own == a, own == b)


def _dense(group, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(name).to_pylist()), dtype=dtype).reshape(group.num_rows, -1)


def likely(rows: DataFrame) -> DataFrame:
    """Of (leaf, a, b, run, tid, own, sketch, at), the members with a likely new partner in their comparison.

    ``place`` numbers them there from 0 to ``members`` - 1."""

    def run(batches):
        import pyarrow as pa
        out, held = [], 0
        for g in _groups(batches, 3):
            if g.num_rows < 2:
                continue
            a, b, r = g.column("a")[0].as_py(), g.column("b")[0].as_py(), g.column("run")[0].as_py()
            want = _pair_mask(g.column("own").to_numpy(), a, b)
            sketch = _dense(g, "sketch", np.uint8)
            alike = np.zeros(want.shape, dtype=np.uint8)
            for t in range(TOKENS):
                alike += sketch[:, t][:, None] == sketch[:, t][None, :]
            want &= alike >= LIKELY
            if want.any():
                want &= ~_met_before(r, _dense(g, "at", np.uint32))
            member = want.any(axis=0) | want.any(axis=1)
            n = int(member.sum())
            if n:
                out.append(g.filter(pa.array(member)).drop_columns(["sketch"])
                           .append_column("place", pa.array(np.arange(n, dtype=np.int32)))
                           .append_column("members", pa.array(np.full(n, n, dtype=np.int32))))
                held += n
            if held > 5000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, held = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return rows.mapInArrow(run, "leaf long, a int, b int, run int, tid long, own int, at binary, place int, members int")


def _count_common(shingle: np.ndarray, member: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` (members x members) the shingles that each two members share."""
    order = np.argsort(shingle, kind="stable")
    shingle, member = shingle[order], member[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = shingle[1:] != shingle[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1 if len(column) else new  # a shingle that occurs once is in no intersection
    member, column = member[often], column[often]
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1 if len(column) else column
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):  # dense, a bounded number of columns at a time
        i, j = np.searchsorted(column, [lo, lo + 8192])
        m = np.zeros((len(total), int(column[j - 1]) - lo + 1), dtype=np.float32)
        m[member[i:j], column[i:j] - lo] = 1
        total += (m @ m.T).astype(np.int64)


class _Comparison:
    """One comparison, of whose members the pieces of the sets come by ascending ``first``."""

    def __init__(self, rows):
        self.key, self.run = _key(rows), rows.column("run")[0].as_py()
        n = rows.column("members")[0].as_py()
        self.tid, self.own, self.size = (np.zeros(n, dtype=np.int64) for _ in range(3))
        self.at = np.zeros((n, RUNS), dtype=np.uint32)
        self.common = np.zeros((n, n), dtype=np.int64)
        self.shingle, self.member, self.held = [], [], 0

    def add(self, rows) -> None:
        place = rows.column("place").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("shingles").to_pylist()]
        sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
        self.tid[place], self.own[place] = rows.column("tid").to_numpy(), rows.column("own").to_numpy()
        self.at[place] = _dense(rows, "at", np.uint32)
        np.add.at(self.size, place, sizes)
        self.shingle.append(np.concatenate(sets))
        self.member.append(np.repeat(place, sizes))
        self.held += int(sizes.sum())
        if self.held > HELD:
            self.count(rows.column("first")[-1].as_py())

    def count(self, upto: int | None = None) -> None:
        """Count the shingles held; those from ``upto``, the half of a hash, may still come in later pieces and stay."""
        shingle, member = np.concatenate(self.shingle), np.concatenate(self.member)
        self.shingle, self.member, self.held = [], [], 0
        if upto is not None:
            later = shingle >> np.uint64(1) >= np.uint64(upto)
            self.shingle, self.member, self.held = [shingle[later]], [member[later]], int(later.sum())
            shingle, member = shingle[~later], member[~later]
        _count_common(shingle, member, self.common)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """tid, number of links and the least linked text, of the members that have a link."""
        self.count()
        want = _pair_mask(self.own, *self.key[1:]) & ~_met_before(self.run, self.at)
        linked = DENOMINATOR * self.common >= NUMERATOR * (self.size[:, None] + self.size[None, :] - self.common)
        linked &= want | want.T
        n = linked.sum(axis=1)
        at = np.flatnonzero(n)
        label = np.arange(len(n))  # components inside the comparison
        while len(at):
            low = np.minimum(label, np.where(linked, label[None, :], len(n)).min(axis=1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        return self.tid[at], n[at].astype(np.int64), self.tid[label[at]]


def _key(rows) -> tuple[int, int, int]:
    return tuple(rows.column(c)[0].as_py() for c in ("leaf", "a", "b"))


def verified(rows: DataFrame) -> DataFrame:
    """tid, links, edge of every member of a comparison: links counted, and the least text it is linked to there."""

    def run(batches):
        import pyarrow as pa
        out, open_ = [], None

        def flush():
            tid, links, edge = (np.concatenate(x) for x in zip(*out))
            out.clear()
            return pa.RecordBatch.from_pydict({"tid": pa.array(tid), "links": pa.array(links), "edge": pa.array(edge)})

        for batch in batches:
            for g in _groups([batch], 3):  # of a batch: a comparison may go on in the next one
                if open_ is not None and open_.key != _key(g):
                    out.append(open_.links())
                    open_ = None
                if open_ is None:
                    open_ = _Comparison(g)
                open_.add(g)
            if len(out) > 2000:
                yield flush()
        if open_ is not None:
            out.append(open_.links())
        if out:
            yield flush()

    return rows.mapInArrow(run, "tid long, links long, edge long")


def shingle_pieces(texts: DataFrame) -> DataFrame:
    """tid, first (half of the least hash), shingles (sorted hashes) of (tid, text): the set in pieces of PIECE."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            tids, firsts, pieces = [], [], []
            for tid, s in zip(b.column(0).to_pylist(), shingle_sets(byte_texts(b.column(1)))):
                for lo in range(0, len(s), PIECE):
                    tids.append(tid)
                    firsts.append(int(s[lo] >> np.uint64(1)))
                    pieces.append(s[lo:lo + PIECE].tobytes())
            yield pa.RecordBatch.from_pydict({"tid": pa.array(tids, pa.int64()), "first": pa.array(firsts, pa.int64()),
                                              "shingles": pa.array(pieces, pa.binary())})

    return texts.mapInArrow(run, "tid long, first long, shingles binary")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """tid, root (least tid of its component) of every end of the edges (tid, edge)."""
    both = kept_table(edges.where("tid <> edge").select("tid", "edge")
                      .union(edges.where("tid <> edge").select(F.col("edge").alias("tid"), F.col("tid").alias("edge")))
                      .distinct(), folder, "edges")
    label = kept_table(both.groupBy("tid").agg(F.least("tid", F.min("edge")).alias("root")), folder, "label0")
    k = 0
    while True:
        k += 1
        near = both.join(label.withColumnRenamed("tid", "edge"), "edge").groupBy("tid").agg(F.min("root").alias("_near"))
        low = label.join(near, "tid").select("tid", "root", F.least("root", "_near").alias("_low"))
        up = label.select(F.col("tid").alias("_low"), F.col("root").alias("_up"))
        step = low.join(up, "_low").select("tid", F.least("_low", "_up").alias("root"),
                                           (F.least("_low", "_up") != F.col("root")).alias("_moved"))
        step = kept_table(step, folder, f"label{k}")
        label = step.drop("_moved")
        if not step.where("_moved").count():
            return label


def near_classes(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """did, tid, root (class), links and least ids of text and class (text_id, class_id) of every row."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "paths")
    rows = kept_table(sketched(docs), folder, "rows")
    # one row a distinct text: rows of equal text have equal sketches
    texts = kept_table(rows.groupBy("tid").agg(F.min("did").alias("text_id"), F.first("sketch").alias("sketch"),
                                               F.first("path").alias("path")), folder, "texts")
    found = leaves(texts.where("path is not null"), folder)
    short = F.coalesce(F.nullif(F.pmod("leaf", F.lit(1 << 32)), F.lit(0)), F.lit(1))  # 32 bits, not 0
    at = found.groupBy("tid").agg(F.map_from_entries(F.collect_list(F.struct("run", short.alias("leaf")))).alias("m"))
    spelled = F.unhex(F.concat(*[F.lpad(F.hex(F.coalesce(F.element_at("m", F.lit(r)), F.lit(0))), 8, "0")
                                 for r in range(RUNS)]))
    known = at.select("tid", spelled.alias("at")).join(texts.select("tid", "sketch"), "tid").hint("merge")
    compared = (_blocks(found.join(known, "tid")).select("leaf", "a", "b", "run", "tid", "own", "sketch", "at")
                .repartition("leaf", "a", "b").sortWithinPartitions("leaf", "a", "b", "tid"))
    candidates = kept_table(likely(compared), folder, "candidates")

    wanted = candidates.select("tid").distinct().join(texts.select("tid", "text_id"), "tid")
    wanted = kept_table(wanted, folder, "wanted")
    source = _identified(docs).withColumnRenamed("did", "text_id")
    # ``wanted`` grows with the input, so it is never sent to all tasks, at any size
    wanted = wanted.hint("merge")
    chosen = (source.join(wanted, (source.tid == wanted.tid) & source.text_id.eqNullSafe(wanted.text_id), "left_semi")
              .select("tid", "text"))

    # repeated rows have the same pieces
    shingles = kept_table(shingle_pieces(chosen).dropDuplicates(["tid", "first"]), folder, "sets")
    exact = kept_table(verified(candidates.join(shingles.hint("merge"), "tid").select(
        "leaf", "a", "b", "run", "tid", "own", "at", "place", "members", "first", "shingles")
        .repartition("leaf", "a", "b").sortWithinPartitions("leaf", "a", "b", "first", "tid")), folder, "links")
    counted = exact.groupBy("tid").agg(F.sum("links").alias("links"))
    root = components(exact, folder)
    classed = texts.select("tid", "text_id").join(root, "tid", "left").join(counted, "tid", "left").select(
        "tid", "text_id", F.coalesce("root", "tid").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    classed = kept_table(classed, folder, "classed")
    heads = classed.groupBy("root").agg(F.min("text_id").alias("class_id"))
    return rows.select("did", "tid").join(classed.join(heads, "root"), "tid")


def one_of_each(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` with one row of each class: the least id of the class; rows without id stay only if no member has one."""
    folder = folder or scratch(docs.sparkSession, "paths")
    packed = docs.select(F.col("doc_id").cast("long").alias("did"), F.coalesce(F.col("text").cast("string"), F.lit(""))
                         .alias("_text"), F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    classes = near_classes(docs, folder)
    heads = classes.where(F.col("did").eqNullSafe(F.col("class_id")))
    # several rows may be the head: equal ids, or no ids at all
    heads = heads.groupBy("root").agg(F.min("tid").alias("tid"), F.first("did").alias("did"), F.count("*").alias("rows"))
    heads = kept_table(heads, folder, "heads")
    rows = packed.withColumn("tid", F.xxhash64(F.md5("_text")))
    kept = rows.join(heads.withColumnRenamed("did", "_did").withColumnRenamed("tid", "_tid"),
                     (rows.tid == F.col("_tid")) & rows.did.eqNullSafe(F.col("_did")))
    single = kept.where("rows = 1").select("_row")
    repeated = kept.where("rows > 1").groupBy("tid").agg(F.first("_row").alias("_row")).select("_row")
    return single.union(repeated).select("_row.*")


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    arrow_batches(spark)
    return near_classes(documents(spark, sf_dir)).select(
        F.col("did").alias("doc_id"), "class_id", F.col("text_id"), F.col("links").alias("n_links"))
