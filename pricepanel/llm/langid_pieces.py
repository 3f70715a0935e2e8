"""Language identification by segmentation-marginalised unigrams.

For each language the model has a probability for every piece of a fixed public
vocabulary. The probability of a word is the sum over all ways to cut it into
pieces of the product of their probabilities, by the forward algorithm; a
text's is the product over its words (lower-cased, with the word-start mark).
The predicted language has the greatest; the score is its share among the
learned languages (equal priors).

Piece probabilities are learned by expectation-maximisation: expected piece
counts from the forward-backward algorithm over the distinct words of a bounded
sample of the training rows (``SAMPLE_DOCS`` a language, drawn by a hash of the
id among all rows), summed by Spark over all tasks. Pieces that are hardly used in
any language in the end have probability 0; single characters keep a little. All
rows are scored, whole; a Python worker remembers words from task to task.

Defined results: null texts and texts without a letter are ``und`` with score 0;
without any training row all are; a word of more than ``MAX_WORD`` characters is
scored in parts of that length; characters outside the vocabulary have one
common small probability; ties go to the first language by name; copies get
equal results; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, arrow_batches, byte_texts, documents, fold, kept_table, scratch

FOLDS = 5
SAMPLE_DOCS = 1500
ROUNDS = 3
MAX_WORD = 40
SMOOTHING = 0.05
UNKNOWN = 1e-7
MAX_CACHED = 700_000
LEAST_USE = 0.5
MARK = "▁"
_LETTER = regex.compile(r"\p{L}")  # the Unicode letters: no digits, numerals or marks


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[str]:
    """The lower-cased pieces of a vocabulary file, each once, without control and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())
           if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return [p for p in dict.fromkeys(own) if len(p) <= MAX_WORD and MARK not in p[1:]]


class Lattice:
    """All segmentations of some words, as edges between positions."""

    def __init__(self, words: list[str], index: dict[str, int], longest: int):
        self.sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        which, start, end, piece = [], [], [], []
        unknown = len(index)
        get = index.get
        for k, w in enumerate(words):
            for i in range(len(w)):
                one = get(w[i])
                which.append(k)
                start.append(i)
                end.append(i + 1)
                piece.append(unknown if one is None else one)
                for j in range(i + 2, min(len(w), i + longest) + 1):
                    p = get(w[i:j])
                    if p is not None:
                        which.append(k)
                        start.append(i)
                        end.append(j)
                        piece.append(p)
        self.which, self.start, self.end, self.piece = (np.array(a, dtype=np.int64) for a in (which, start, end, piece))
        self.width = int(self.sizes.max(initial=0)) + 1

    def _by(self, place: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(place, kind="stable")
        return np.split(order, np.searchsorted(place[order], np.arange(1, self.width)))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Probability of every prefix (words x positions x languages); ``p``: pieces x languages."""
        a = np.zeros((len(self.sizes), self.width, p.shape[1]))
        a[:, 0] = 1.0
        for e, at in enumerate(self._by(self.end)):
            if e and len(at):
                self._add(a, e, at, a[self.which[at], self.start[at]] * p[self.piece[at]])
        return a

    def backward(self, p: np.ndarray) -> np.ndarray:
        b = np.zeros((len(self.sizes), self.width, p.shape[1]))
        b[np.arange(len(self.sizes)), self.sizes] = 1.0
        for s, at in reversed(list(enumerate(self._by(self.start)))):
            if len(at):
                self._add(b, s, at, b[self.which[at], self.end[at]] * p[self.piece[at]])
        return b

    def _add(self, to: np.ndarray, column: int, at: np.ndarray, values: np.ndarray) -> None:
        which = self.which[at]
        for lang in range(values.shape[1]):
            to[:, column, lang] += np.bincount(which, weights=values[:, lang], minlength=len(to))


def parts(word: bytes) -> list[str]:
    w = MARK + word.decode("utf-8", "replace")
    return [w[i:i + MAX_WORD] for i in range(0, len(w), MAX_WORD)]


class Scorer:
    """Log probability of texts by language; remembers the words met lately."""

    def __init__(self, languages: list[str], pieces: list[str], probability: np.ndarray):
        self.languages, self.p = languages, probability
        self.index = {x: i for i, x in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.row: dict[int, int] = {}
        self.table = np.zeros((0, len(languages)))

    def _learn(self, words: list[bytes], names: list[int]) -> None:
        split = [parts(w) for w in words]
        flat = [x for s in split for x in s]
        owner = np.repeat(np.arange(len(split)), [len(s) for s in split])
        value = np.zeros((len(words), len(self.languages)))
        for lo in range(0, len(flat), 20_000):
            lattice = Lattice(flat[lo:lo + 20_000], self.index, self.longest)
            a = lattice.forward(self.p)
            whole = np.log(np.maximum(a[np.arange(len(lattice.sizes)), lattice.sizes], 1e-290))
            np.add.at(value, owner[lo:lo + 20_000], whole)
        if len(self.row) + len(names) > MAX_CACHED:
            self.row, self.table = {}, self.table[:0]
        self.row.update(zip(names, range(len(self.table), len(self.table) + len(names))))
        self.table = np.concatenate([self.table, value])

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        w = Words(texts)
        names, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        names = names.tolist()
        new = [i for i, h in enumerate(names) if h not in self.row]
        if len(self.row) + len(new) > MAX_CACHED:
            self.row, self.table = {}, self.table[:0]
            new = range(len(names))
        if len(new):
            self._learn([w.bytes_of(first[i]) for i in new], [names[i] for i in new])
        rows = np.fromiter((self.row[h] for h in names), dtype=np.int64, count=len(names))
        value = self.table[rows][which]
        return np.stack([np.bincount(w.doc, weights=value[:, k], minlength=len(texts))
                         for k in range(len(self.languages))], axis=1)


def _lowered(texts: list[str]) -> list[bytes]:
    return [t.lower().encode("utf-8", "replace") for t in texts]


def _sample(docs: DataFrame, per_language: int, folds: int) -> DataFrame:
    """_lang, _text of the training rows drawn: about ``per_language`` a language."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"),
                       F.col("lang").cast("string").alias("_lang")).where(
        (fold("_id", folds) != 0) & F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    sizes = rows.groupBy("_lang").count().collect()  # one row a learned language
    if not sizes:
        return rows.select("_lang", "_text")
    size = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in r]), F.col("_lang"))
    u = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(u * size < per_language).select("_lang", "_text")


def train(docs: DataFrame, path: str | None = None, per_language: int = SAMPLE_DOCS, rounds: int = ROUNDS,
          folds: int = FOLDS, folder: str | None = None):
    """(languages, pieces, probabilities) or None without training rows."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "langid")
    pieces = read_pieces(path or vocabulary_path())

    def words(batches):
        import pyarrow as pa
        for b in batches:
            texts = byte_texts(b.column(1))
            w = Words(_lowered([t.decode("utf-8", "replace") for t in texts]))
            langs = pa.array(b.column(0)).dictionary_encode()
            names = langs.dictionary.to_pylist()
            code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.doc]
            _, first, n = np.unique(np.stack([code.astype(np.uint64), w.hash]), axis=1, return_index=True,
                                    return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([names[code[i]] for i in first], pa.string()),
                "word": pa.array([w.bytes_of(i) for i in first], pa.binary()), "n": pa.array(n, pa.int64())})

    table = kept_table(_sample(docs, per_language, folds).mapInArrow(words, "lang string, word binary, n long")
                       .groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition("word"), folder, "words")
    languages = sorted(r[0] for r in table.select("lang").distinct().collect())  # the learned values
    if not languages:
        return None
    p = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    p[-1] = UNKNOWN
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((languages, pieces, p))  # vocabulary x languages

        def expect(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            langs, names, prob = shared.value
            index = {x: i for i, x in enumerate(names)}
            longest = max(map(len, names))
            total = np.zeros_like(prob)
            for f in frames:
                code = f["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
                split = [parts(w) for w in f["word"]]
                sizes = [len(s) for s in split]
                flat = [x for s in split for x in s]
                lang, n = np.repeat(code, sizes), np.repeat(f["n"].to_numpy(float), sizes)
                for lo in range(0, len(flat), 10_000):
                    lat = Lattice(flat[lo:lo + 10_000], index, longest)
                    a, b = lat.forward(prob), lat.backward(prob)
                    own = lang[lo:lo + 10_000][lat.which]
                    z = np.maximum(a[np.arange(len(lat.sizes)), lat.sizes, lang[lo:lo + 10_000]], 1e-290)
                    e = (a[lat.which, lat.start, own] * prob[lat.piece, own] * b[lat.which, lat.end, own]
                         / z[lat.which] * n[lo:lo + 10_000][lat.which])
                    np.add.at(total, (lat.piece, own), e)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "e": total[piece, lang]})

        counts = (table.mapInPandas(expect, "piece long, lang long, e double").groupBy("piece", "lang")
                  .agg(F.sum("e").alias("e")).toPandas())  # at most vocabulary x languages rows
        total = np.full_like(p, SMOOTHING)
        total[counts["piece"], counts["lang"]] += counts["e"]
        total[-1] = 0
        p = total / total.sum(axis=0)
        p[-1] = UNKNOWN
    used = (total.max(axis=1) >= LEAST_USE + SMOOTHING) | np.array([len(x) == 1 for x in pieces] + [False])
    p = total[used] / total[used].sum(axis=0)
    return languages, [x for x, u in zip(pieces, used) if u], np.concatenate([p, np.full((1, len(languages)), UNKNOWN)])


_SCORER: dict[str, Scorer] = {}


def _scorer(name: str, shared) -> Scorer:
    """This process's scorer of a model; one model at a time."""
    if name not in _SCORER:
        _SCORER.clear()
        _SCORER[name] = Scorer(*shared.value)
    return _SCORER[name]


def predicted(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``_lid``: struct of lang_pred and score."""
    schema = "lang_pred string, score double"
    if model is None:
        return docs.withColumn("_lid", F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    @F.pandas_udf(schema)
    def lid(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(name, shared)
        for s in batches:
            texts = [t if isinstance(t, str) and _LETTER.search(t) else "" for t in s]
            value = np.empty((len(texts), len(scorer.languages)))
            lo = 0
            while lo < len(texts):  # a bounded amount of text at a time
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= 1 << 20):
                    size += len(texts[hi])
                    hi += 1
                value[lo:hi] = scorer(_lowered(texts[lo:hi]))
                lo = hi
            best = value.argmax(axis=1)
            share = 1.0 / np.exp(np.clip(value - value.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
            seen = np.array([bool(t) for t in texts], dtype=bool)
            yield pd.DataFrame({"lang_pred": np.where(seen, np.array(scorer.languages, dtype=object)[best], "und"),
                                "score": np.where(seen, share, 0.0)})

    return docs.withColumn("_lid", lid(F.col("text").cast("string")))


def op4_langid_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every whole text of ``documents``."""
    arrow_batches(spark)
    docs = documents(spark, sf_dir)
    model = train(docs)
    return (predicted(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"), "_lid.*"))
