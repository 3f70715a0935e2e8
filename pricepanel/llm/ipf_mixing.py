"""Mixing sources to target weights by iterative proportional fitting (raking).

Token counts are summed over all documents into cells of source, language and
topic. Raking scales the cells' weights to the target share of each source, then
of each language, then of each topic, and over again until a whole sweep changes
no factor by more than ``tolerance``. Marginals that no weights of these cells can
meet together never settle: after ``max_sweeps`` the marginal that is furthest off
is reported as a warning, with its distance. A document then has the calibrated weight
of its cell per token, and is sampled with probability min(1, c * weight), where
c makes the expected number of tokens the asked share of all. The uniform number
compared with the probability is a hash of id and text, so a rerun after a lost
executor, or any other partitioning, draws the same sample.

The cells are a Spark table throughout: a sweep is three aggregations and joins
on marginal levels, each written to the scratch folder, so that a plan is one
dimension deep; the driver sees one number a sweep. Rows are summed before they are
shuffled, so a hot source is one row a task.

Topics come from the shape of a text (``topic_of``), unless ``topic`` names a column.

Defined results: a null source, language or topic is a level of its own; null and
empty texts count one token (the end), so every row has a weight; target levels
without rows are left out and the others scaled up; levels without a target keep
their share; copies with equal id are drawn together; an empty table gives no rows.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import documents, kept_table, scratch

DIMS = ("source", "lang", "topic")
# Production targets: the present shares, flattened by these powers (1 keeps a marginal, 0 makes it uniform).
POWERS = {"source": 0.5, "lang": 0.6, "topic": 0.8}
SAMPLE_SHARE = 0.6
TOLERANCE = 1e-7
MAX_SWEEPS = 40
SEED = 20240229
_CELL = [f"_{d}" for d in DIMS]


def topic_of(text: Column, n_words: Column) -> Column:
    """A topic from the shape of the text: table, contact, numeric, list, long, note or article."""
    size = F.length(text)
    count = lambda chars: size - F.length(F.translate(text, chars, ""))
    return (F.when(n_words == 0, "empty")
            .when(count("|") * 20 > n_words, "table")
            .when(text.contains("@") | text.contains("://"), "contact")
            .when(count("0123456789") * 50 > size, "numeric")
            .when(count("\n") * 8 > n_words, "list")
            .when(n_words >= 1000, "long").when(n_words < 120, "note").otherwise("article"))


def _level(column: Column) -> Column:
    c = column.cast("string")
    return F.when(c.isNull(), F.lit("?")).otherwise(F.concat(F.lit("="), c))


def described(docs: DataFrame, topic: str | None = None) -> DataFrame:
    """Adds _tokens, _topic_name, _u (uniform in [0, 1)) and the cell levels to ``docs`` (doc_id, text, ...)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+"))
    rows = docs.withColumn("_words", words)
    rows = rows.withColumn("_topic_name", F.col(topic) if topic else topic_of(text, F.col("_words")))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.crc32(text.cast("binary")), F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)
    return rows.withColumns({"_tokens": F.col("_words").cast("long") + 1, "_u": draw, "_source": _level(F.col("source")),
                             "_lang": _level(F.col("lang")), "_topic": _level(F.col("_topic_name"))}).drop("_words")


def tempered_targets(cells: DataFrame, powers: dict[str, float] = POWERS) -> dict[str, DataFrame]:
    """(level, share) of each dimension: present token shares to a power (normalised by ``rake``)."""
    return {d: cells.groupBy(F.col(f"_{d}").alias("level")).agg(F.sum("tokens").alias("t"))
            .select("level", F.pow(F.col("t").cast("double"), F.lit(powers[d])).alias("share")) for d in DIMS}


def rake(cells: DataFrame, targets: dict[str, DataFrame], folder: str, tolerance: float = TOLERANCE,
         max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """``cells`` (_source, _lang, _topic, tokens) with the raked weight ``w``; weights add up to all tokens."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = {d: kept_table(_goal(cells, targets[d], d, total), folder, f"goal_{d}") for d in DIMS}
    cells = kept_table(cells.withColumn("w", F.col("tokens").cast("double")), folder, "sweep0")
    moved_most = 0.0
    for sweep in range(1, max_sweeps + 1):
        cells = cells.withColumn("_moved", F.lit(0.0))
        for d in DIMS:
            seen = Observation()
            cells = kept_table(_fitted(cells, goals[d], d).observe(seen, F.max("_moved").alias("most")), folder, f"sweep{sweep}{d}")
        cells, moved_most = cells.drop("_moved"), seen.get["most"] or 0.0
        if moved_most <= tolerance:
            break
    else:
        off = marginal_errors(cells, goals).orderBy(F.col("error").desc(), "dim", "level").first()
        if off is not None:
            warnings.warn(f"raking stopped after {max_sweeps} sweeps that still move a weight by {moved_most:.2g}: {off['dim']} "
                          f"{off['level']} is off its target by {off['error']:.2g} of it", RakingWarning, stacklevel=2)
    return cells


def _goal(cells: DataFrame, target: DataFrame, d: str, total: int) -> DataFrame:
    """(_level, goal): the tokens that each present level of a dimension should weigh; goals add up to ``total``."""
    present = cells.groupBy(F.col(f"_{d}").alias("level")).agg(F.sum("tokens").alias("t"))
    aim = present.join(target, "level", "left").withColumn(
        "share", F.coalesce("share", F.col("t") / F.lit(float(max(total, 1)))))
    whole = aim.agg(F.sum("share").alias("whole")).first()[0] or 1.0
    return aim.select(F.col("level").alias(f"_{d}"), (F.col("share") * total / F.lit(whole)).alias("goal"))


def _fitted(cells: DataFrame, goal: DataFrame, d: str) -> DataFrame:
    """``cells`` scaled to the goals of one dimension; a level that weighs nothing stays as it is."""
    factor = (cells.groupBy(f"_{d}").agg(F.sum("w").alias("_have")).join(goal, f"_{d}")
              .select(f"_{d}", F.coalesce(F.try_divide("goal", "_have"), F.lit(1.0)).alias("_factor")))
    return (cells.join(factor, f"_{d}").withColumn("w", F.col("w") * F.col("_factor"))
            .withColumn("_moved", F.greatest("_moved", F.abs(F.col("_factor") - 1))).drop("_factor"))


class RakingWarning(UserWarning):
    """Targets that the cells cannot meet together, or not within the sweeps."""


def marginal_errors(cells: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    """(dim, level, error): how far the weights of every level are from its goal, as a share of the goal."""
    out = None
    for d in DIMS:
        have = cells.groupBy(f"_{d}").agg(F.sum("w").alias("_have")).join(goals[d], f"_{d}").select(
            F.lit(d).alias("dim"), F.col(f"_{d}").alias("level"),
            F.abs(F.try_divide(F.col("_have"), F.col("goal")) - 1).alias("error"))
        out = have if out is None else out.unionByName(have)
    return out


def with_probability(cells: DataFrame, share: float = SAMPLE_SHARE) -> DataFrame:
    """Adds ``per_token`` (weight of a token) and ``probability``; expected tokens are ``share`` of all."""
    cells = cells.withColumn("per_token", F.col("w") / F.col("tokens"))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    c, sure = 0.0, -1
    while total:  # cells that reach probability 1 are taken whole; the rest shares what is left
        if sure >= 0:
            full = F.col("per_token") * F.lit(c) >= 1
        else:
            full = F.lit(False)
        row = cells.agg(F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("sure"),
                        F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("w")).first()
        if row["sure"] == sure:
            break
        sure = row["sure"]
        if row["w"] <= 0:
            break
        c = max(c, (share * total - sure) / row["w"])
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("per_token") * F.lit(c)))


def calibrated(rows: DataFrame, folder: str, share: float = SAMPLE_SHARE,
               targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """_source, _lang, _topic, per_token, probability of every cell of ``described`` rows."""
    cells = kept_table(rows.groupBy(*_CELL).agg(F.sum("_tokens").alias("tokens")), folder, "cells")
    raked = rake(cells, targets or tempered_targets(cells), folder)
    return kept_table(with_probability(raked, share).select(*_CELL, "per_token", "probability"), folder, "calibrated")


def sample_documents(docs: DataFrame, share: float = SAMPLE_SHARE, folder: str | None = None) -> DataFrame:
    """The sampled rows of ``docs``, with just their own columns."""
    folder = folder or scratch(docs.sparkSession, "ipf")
    packed = docs.select("doc_id", "text", "source", "lang", F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    cells = calibrated(described(packed.drop("_row")), folder, share)
    return (described(packed).join(cells, _CELL).where(F.col("_u") < F.col("probability")).select("_row.*"))


def op1_ipf_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated weight, probability and draw of every document."""
    folder = scratch(spark, "ipf")
    rows = kept_table(described(documents(spark, sf_dir).select("doc_id", "text", "source", "lang")).drop("text"),
                      folder, "described")
    return (rows.join(calibrated(rows, folder), _CELL)
            .select("doc_id", "source", "lang", F.col("_topic_name").alias("topic"), F.col("_tokens").alias("n_tokens"),
                    F.col("per_token").alias("token_weight"), "probability",
                    (F.col("_u") < F.col("probability")).alias("sampled")))
