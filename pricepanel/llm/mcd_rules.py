"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

1. One pass over the texts counts words, symbols, repeated lines and repeated
   five-word windows, and maps them to a vector of transformed statistics
   (shrunken to a common prior, so that short texts do not scatter).
2. For each language and source, location and scatter are those of the half of
   the rows whose covariance has the least determinant. Deterministic starts
   (median/MAD, and a tanh-scored scatter) are improved by concentration steps
   over all rows: distances under the estimate, their quantile per group, mean
   and covariance of the rows below it. A step is one aggregation whose partial
   sums are made before the shuffle, so a group may hold any share of the rows.
   The start with the least determinant wins; its scatter is made consistent at
   the chi-square median and reweighted once.
3. A row is kept if it passes the base rules and its squared Mahalanobis
   distance stays under a chi-square limit.

Groups under ``MIN_GROUP`` rows are estimated together with the other small
groups of their language; if these are too few, they are judged by an estimate
over all rows of the table. Fewer rows than that in the table are not judged by
distance. A floor on the variance of each statistic keeps constant columns from
making a scatter singular.

Defined results: null and empty texts have no words and fail the base rule; a
null language or source is a value of its own; copies get equal verdicts;
other columns of the input are carried along by ``filter_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IS_LEAD, IS_SEPARATOR, Words, arrow_batches, byte_texts, chunks, documents, kept_table, scratch

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "capitals", "echoes")
DIM = len(FEATURES)
MIN_GROUP = 100
COVERAGE = 0.5  # nearly half of a group may be junk
STEPS = 6
SALTS = 32  # parts of a group in joins with its estimate
# Least standard deviation of a transformed statistic, and the chi-square values used (6 degrees of freedom):
# the median scales the scatter, the 0.975 quantile reweights; the limit for rejection is far out, since
# the tails of text statistics are longer than normal ones.
FLOOR = (0.02, 0.02, 0.08, 0.03, 0.02, 0.03)
CHI2_COVERAGE = 5.3481
CHI2_WEIGHT = 14.4494
CHI2_TRIMMED = 1.0493  # makes the scatter of the rows below CHI2_WEIGHT consistent
CHI2_REJECT = 45.0

STATS_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, x array<double>"


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a five-word window found twice or more in the text."""
    out = np.zeros(words.n_docs, dtype=np.int64)
    gram, at = words.grams(WINDOW)
    if not len(gram):
        return out
    key = gram + words.doc[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(key)
    equal = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    first = at[twice]
    inside = np.zeros(len(words.hash), dtype=bool)
    for j in range(WINDOW):
        inside[first + j] = True
    return np.bincount(words.doc[inside], minlength=words.n_docs)


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x 5, as in STATS_SCHEMA) and transformed vectors (texts x DIM)."""
    counts = np.zeros((len(texts), 5), dtype=np.int64)
    capitals = np.zeros(len(texts))
    echoes = np.zeros(len(texts))
    lines = np.zeros(len(texts))
    for lo, hi in chunks(texts):
        part = texts[lo:hi]
        w = Words(part)
        counts[lo:hi, 0] = np.bincount(w.doc, minlength=hi - lo)
        if len(w.buffer):
            lead = np.concatenate([[0], np.cumsum(IS_LEAD[w.buffer] & ~IS_SEPARATOR[w.buffer])])
            edges = np.append(w.doc_start, len(w.buffer))
            counts[lo:hi, 1] = np.diff(lead[edges])
            upper = np.concatenate([[0], np.cumsum((w.buffer >= 65) & (w.buffer <= 90))])
            capitals[lo:hi] = np.diff(upper[edges])
        same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        echoes[lo:hi] = np.bincount(w.doc[1:][same], minlength=hi - lo)
        counts[lo:hi, 2] = [len(t) - len(t.translate(None, SYMBOLS)) for t in part]
        counts[lo:hi, 3] = [_dup_lines(t) for t in part]
        lines[lo:hi] = [t.count(b"\n") + 1 for t in part]
        counts[lo:hi, 4] = repeated_words(w)
    n, chars, symbols, dup, repeat = counts.T.astype(float)
    x = np.stack([
        np.log((chars + 5.5 * 50) / (n + 50)),       # mean word length
        np.log1p(20 * symbols / (chars + 200)),      # symbols to characters
        dup / (lines + 5),                           # repeated lines
        repeat / (n + 50),                           # words in repeated windows
        np.log1p(5 * capitals / (chars + 200)),      # capitals
        echoes / (n + 10),                           # words equal to the one before
    ], axis=1)
    return counts, x


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``_stats`` of the counts and the vector; all columns kept."""

    @F.pandas_udf(STATS_SCHEMA)
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            counts, x = statistics([t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in s])
            out = pd.DataFrame(counts, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                "n_repeat_words"])
            out["x"] = list(x)
            yield out

    return docs.withColumn("_stats", stats(F.col("text").cast("string")))


def base_failed(stats: str = "_stats") -> Column:
    n, repeat = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def _name(column: str) -> Column:
    c = F.col(column).cast("string")
    return F.when(c.isNull(), F.lit("?")).otherwise(F.concat(F.lit("="), c))


def group_plan(rows: DataFrame) -> DataFrame:
    """(_l, _s) -> estimation group ``g`` of each language and source, by the sizes of all groups."""
    sizes = rows.groupBy(_name("lang").alias("_l"), _name("source").alias("_s")).agg(F.count("*").alias("_n"))
    small = sizes.where(F.col("_n") < MIN_GROUP).groupBy("_l").agg(F.sum("_n").alias("_pool"))
    return (sizes.join(small, "_l", "left")
            .withColumn("g", F.when(F.col("_n") >= MIN_GROUP, F.concat_ws("\u0001", "_l", "_s"))
                        .when(F.col("_pool") >= MIN_GROUP, F.col("_l")).otherwise(F.lit("")))
            .select("_l", "_s", "g"))


def _moments(prefix: str = "x") -> list[Column]:
    """Sums that give mean and covariance; the vector is shifted by the group's centre for precision."""
    v = [F.col(prefix)[i] - F.col("centre")[i] for i in range(DIM)]
    return ([F.count("*").alias("n"), F.array(*[F.sum(c) for c in v]).alias("s1"),
             F.array(*[F.sum(v[i] * v[j]) for i in range(DIM) for j in range(i, DIM)]).alias("s2")])


def _upper(values: np.ndarray) -> np.ndarray:
    m = np.zeros((DIM, DIM))
    m[np.triu_indices(DIM)] = values
    return m + np.triu(m, 1).T


def _estimate(n: float, s1, s2, centre, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the rows summed up, floored on the diagonal."""
    s1, centre = np.asarray(s1, float), np.asarray(centre, float)
    mean = s1 / max(n, 1)
    cov = (_upper(np.asarray(s2, float)) / max(n, 1) - np.outer(mean, mean)) * scale
    return centre + mean, cov + np.diag(np.square(FLOOR))


_EST = "centre array<double>, whiten array<double>, logdet double"


def _solve(n, s1, s2, centre, scale) -> Column:
    """Centre, inverse Cholesky factor and log determinant from the sums of a group, one small row each."""

    def solve(n: pd.Series, s1: pd.Series, s2: pd.Series, centre: pd.Series, scale: pd.Series) -> pd.DataFrame:
        rows = []
        for a in zip(n, s1, s2, centre, scale):
            mean, cov = _estimate(*a)
            low = np.linalg.cholesky(cov)
            rows.append((mean, np.linalg.inv(low)[np.tril_indices(DIM)], 2 * np.log(np.diag(low)).sum()))
        return pd.DataFrame(rows, columns=["centre", "whiten", "logdet"])

    return F.pandas_udf(solve, _EST)(n, s1, s2, centre, scale)


def distance() -> Column:
    """Squared Mahalanobis distance of ``x`` under ``centre`` and the whitening matrix (lower triangle)."""
    total, at = F.lit(0.0), 0
    for i in range(DIM):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + F.col("whiten")[at] * (F.col("x")[j] - F.col("centre")[j])
            at += 1
        total = total + row * row
    return total


def _per_group(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with what ``table`` has of their group; a hot group is joined in SALTS parts."""
    parts = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(parts, ["g", "salt"]).drop("salt")


def estimates(rows: DataFrame, folder: str, steps: int = STEPS) -> DataFrame:
    """g -> centre, whiten of the reweighted minimum-covariance-determinant estimate; ``rows``: (g, salt, x).

    Every step reads all rows once and writes one row per group and start."""
    medians = [F.percentile_approx(F.col("x")[i], 0.5, 2000).alias(f"m{i}") for i in range(DIM)]
    middle = rows.groupBy("g").agg(F.count("*").alias("size"), *medians).select(
        "g", "size", F.array(*[F.col(f"m{i}") for i in range(DIM)]).alias("centre"))
    middle = kept_table(middle.where(F.col("size") >= MIN_GROUP), folder, "middle")
    spread = [F.percentile_approx(F.abs(F.col("x")[i] - F.col("centre")[i]), 0.5, 2000).alias(f"d{i}")
              for i in range(DIM)]
    spread = _per_group(rows, middle).groupBy("g").agg(*spread).select(
        "g", F.array(*[F.greatest(F.col(f"d{i}") * 1.4826, F.lit(FLOOR[i])) for i in range(DIM)]).alias("mad"))
    start = kept_table(middle.join(spread, "g"), folder, "start")

    # first start: the MADs alone; second start: scatter of tanh scores, scaled back by the MADs
    tri = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    diagonal = F.array(*[F.col("mad")[i] * F.col("mad")[i] if i == j else F.lit(0.0) for i, j in tri])
    zero = F.array(*[F.lit(0.0)] * DIM)
    z = [F.tanh((F.col("x")[i] - F.col("centre")[i]) / F.col("mad")[i]) for i in range(DIM)]
    scored = _per_group(rows, start).groupBy("g").agg(
        F.first("centre").alias("centre"), F.first("mad").alias("mad"),
        F.array(*[F.avg(z[i] * z[j]) for i, j in tri]).alias("t"))
    second = F.array(*[F.col("t")[k] * F.col("mad")[i] * F.col("mad")[j] for k, (i, j) in enumerate(tri)])
    one, unit = F.lit(1).cast("long"), F.lit(1.0)
    current = start.select("g", F.lit(0).alias("run"), _solve(one, zero, diagonal, "centre", unit).alias("e")).union(
        scored.select("g", F.lit(1).alias("run"), _solve(one, zero, second, "centre", unit).alias("e")))
    current = kept_table(current.select("g", "run", "e.*"), folder, "step0")

    for k in range(1, steps + 1):
        near = _per_group(rows, current).withColumn("d2", distance())
        cut = kept_table(near.groupBy("g", "run").agg(F.percentile_approx("d2", COVERAGE, 2000).alias("cut")),
                         folder, f"cut{k}")
        inside = _per_group(rows, current.join(cut, ["g", "run"])).where(distance() <= F.col("cut"))
        sums = inside.groupBy("g", "run").agg(F.first("centre").alias("centre"), *_moments())
        current = kept_table(sums.select("g", "run", _solve("n", "s1", "s2", "centre", unit).alias("e"))
                             .select("g", "run", "e.*"), folder, f"step{k}")

    best = kept_table(current.groupBy("g").agg(F.min_by(F.struct("centre", "whiten"), F.struct("logdet", "run"))
                                               .alias("e")).select("g", "e.*"), folder, "best")
    # consistent at the covered share, then the usual reweighting over the rows inside the 0.975 quantile
    cut = _per_group(rows, best).groupBy("g").agg(F.percentile_approx(distance(), COVERAGE, 2000).alias("cut"))
    scaled = best.join(cut, "g").select("g", "centre", "whiten", F.greatest(
        F.col("cut") / CHI2_COVERAGE, F.lit(1e-6)).alias("ratio"))
    sums = (_per_group(rows, scaled).where(distance() <= CHI2_WEIGHT * F.col("ratio"))
            .groupBy("g").agg(F.first("centre").alias("centre"), *_moments()))
    return kept_table(sums.select("g", _solve("n", "s1", "s2", "centre", F.lit(CHI2_TRIMMED)).alias("e"))
                      .select("g", "e.centre", "e.whiten"), folder, "final")


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_l": _name("lang"), "_s": _name("source")})


def fit(rows: DataFrame, folder: str) -> DataFrame:
    """(_l, _s) -> centre, whiten, from all rows (lang, source, _stats) that pass the base rules."""
    good = rows.where(~base_failed()).select("lang", "source", F.col("_stats.x").alias("x"))
    plan = kept_table(group_plan(good), folder, "plan")
    groups = F.array("g")
    if plan.where(F.col("g") == "").limit(1).count():  # groups left over are judged by all rows
        groups = F.array_distinct(F.array(F.col("g"), F.lit("")))
    table = kept_table(_named(good).join(plan, ["_l", "_s"]).withColumn("g", F.explode(groups))
                       .select("g", "x", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")),
                       folder, "vectors")
    # a written table, so that the planner knows its size when rows with whole texts are joined with it
    return kept_table(plan.join(estimates(table, folder), "g").drop("g"), folder, "fit")


def verdicts(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` (lang, source, _stats and more) with base_failed, distance2 and kept."""
    judged = (_named(rows).withColumn("x", F.col("_stats.x")).join(estimate, ["_l", "_s"], "left")
              .withColumn("base_failed", base_failed())
              .withColumn("distance2", F.when(F.col("centre").isNotNull(), distance())))
    return (judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= CHI2_REJECT,
                                                                        F.lit(True)))
            .drop("_l", "_s", "x", "centre", "whiten"))


def filter_documents(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with just their own columns."""
    folder = folder or scratch(docs.sparkSession, "mcd")
    packed = docs.select("text", "lang", "source", F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    # rows are written with their statistics, so that every text is counted once; the estimate reads only its columns
    rows = kept_table(with_statistics(packed).drop("text"), folder, "stats")
    return verdicts(rows, fit(rows.select("lang", "source", "_stats"), folder)).where("kept").select("_row.*")


def op2_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text, and the verdict of base rules and robust distances."""
    arrow_batches(spark)
    folder = scratch(spark, "mcd")
    docs = with_statistics(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    rows = kept_table(docs.drop("text"), folder, "stats")
    return (verdicts(rows, fit(rows, folder))
            .select("doc_id", "_stats.n_words", "_stats.word_chars", "_stats.n_symbols", "_stats.n_dup_lines",
                    "_stats.n_repeat_words", "base_failed", "kept", "distance2"))
