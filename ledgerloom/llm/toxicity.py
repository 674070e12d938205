"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary text. Expressions whose
rates the classes clearly tell apart have counts of their own in each class;
all others, the rare ones above all, back off to counts that both share:

    P_c(w | v) = f_c(v, w) + (1 - sum of f_c(v, .)) * P_c(w)
    P_c(w)     = g_c(w) + B * P(w)

f_c are discounted relative frequencies of the pairs that are told apart,
g_c those of words (their own where told apart, else the pooled ones, scaled so
that P_c sums to one), B the mass that discounting leaves, and P the
continuation counts of both classes: the share of different words that a word
follows. Each P_c(. | v) sums to one over all words known and one unknown. A
text's feature is the difference of the two log-likelihoods, normalised by its
length; a logistic curve, fitted on labelled texts that the counts leave out,
turns it into a probability.

Learning uses at most SAMPLE labelled rows of each class (those with the
smallest hash of their id), so what is broadcast is bounded: the sample's ids,
its words seen twice and its pairs told apart, all by their whole 64-bit
codes. All texts are scored whole, in one pass without a shuffle.

Defined cases: a null or empty text, or one without letters, gets the score
of a text without evidence. Conflicting labels of a document count as toxic;
null labels are ignored. Rows that repeat an id are each scored. Without
labels of both classes every score is 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved
from .wordcode import LETTERS, CodeIndex, chunks, paired, word_codes

#: Labelled rows of each class that a model learns from at most.
SAMPLE = 20_000
#: One labelled row in so many fits the curve instead of the counts.
CURVE_FOLD = 4
#: Counts taken off an expression, counts added before classes are compared, and how far apart they have to be.
DISCOUNT, PRIOR, WORD_FACTOR, PAIR_FACTOR = 0.75, 3.0, 4.0, 20.0
#: Pairs that a task gathers before it hands them on, and how often a pair has to be seen to be told apart.
PAIRS_HELD, LEAST_PAIR = 1_000_000, 8
#: What stands before a text's first word.
BEGIN = np.uint64(0)


@dataclass
class Model:
    """For both classes: probabilities of words by number, the unknown word last; of pairs told apart; and what contexts leave to words, by number, the begin last."""

    words: CodeIndex
    pairs: CodeIndex
    unigram: np.ndarray
    follow: np.ndarray
    left: np.ndarray

    def probabilities(self, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """P_c(word | before) for both classes."""
        word, context, pair = self.words.find(codes), self.words.find(before), self.pairs.find(paired(before, codes))
        context = np.where(before == BEGIN, self.left.shape[1] - 1, np.where(context < 0, self.left.shape[1] - 2, context))
        return self.follow[:, pair] + self.left[:, context] * self.unigram[:, word]

    def evidence(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text: toxic minus ordinary log-likelihood, and the number of words."""
        gain, count = np.zeros(len(texts)), np.zeros(len(texts))
        for first, some in chunks(texts):
            codes, of = word_codes(some, LETTERS)
            if not len(codes):
                continue
            p = self.probabilities(codes, _before(codes, of))
            gain[first : first + len(some)] = np.bincount(of, np.log(p[1]) - np.log(p[0]), len(some))
            count[first : first + len(some)] = np.bincount(of, minlength=len(some))
        return gain, count


@dataclass
class Classifier:
    """A broadcast model and the curve over its evidence; without a model every score is 0."""

    model: Broadcast | None
    curve: np.ndarray

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(_features(*self.model.value.evidence(texts)) @ self.curve, -40, 40)))


def _before(codes: np.ndarray, of: np.ndarray) -> np.ndarray:
    before = np.roll(codes, 1)
    before[np.diff(of, prepend=-1) != 0] = BEGIN
    return before


def _features(gain: np.ndarray, count: np.ndarray) -> np.ndarray:
    n = np.maximum(count, 1)
    return np.stack([np.ones(len(n)), gain / n * 10, gain / np.sqrt(n), np.clip(gain, -30, 30) / 10, np.log(n) / 5], 1)


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough that their texts are held once at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one task, the begin of a text with its first word included, with their counts by class."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def merged() -> pa.RecordBatch:
        before, word, kind = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((word, before))
        before, word, kind = before[order], word[order], kind[order]
        new = np.append(True, (before[1:] != before[:-1]) | (word[1:] != word[:-1]))
        at = np.cumsum(new) - 1
        counts = [np.bincount(at, kind == c).astype(np.int64) for c in (0, 1)]
        return pa.RecordBatch.from_arrays([*(pa.array(x[new].view(np.int64)) for x in (before, word)), *map(pa.array, counts)], names=["before", "word", "ordinary", "toxic"])

    for batch in _sliced(batches):
        label = np.asarray(batch.column(1).to_pylist(), np.int8)
        for first, some in chunks(_bytes(batch.column(0))):
            codes, of = word_codes(some, LETTERS)
            held.append((_before(codes, of), codes, label[first + of]))
            size += len(codes)
            if size > PAIRS_HELD:
                yield merged()
                held, size = [], 0
    if size:
        yield merged()


def _apart(counts: np.ndarray, totals: np.ndarray, factor: float) -> np.ndarray:
    """Whether classes differ by the factor: counts against what pooling would give them, both raised by PRIOR."""
    totals = np.maximum(totals, 1)
    ratio = (counts + PRIOR) / (counts.sum(0) / totals.sum(0) * totals + PRIOR)
    return np.maximum(ratio[1] / ratio[0], ratio[0] / ratio[1]) > factor


def _by_code(df: DataFrame, codes: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The codes and both classes' counts of a bounded table."""
    table = df.toArrow()
    return [table[c].to_numpy().view(np.uint64) for c in codes], np.stack([table["ordinary"].to_numpy(), table["toxic"].to_numpy()]).astype(float)


def learn(sample: DataFrame) -> Model:
    """The model of `sample` (text, toxic)."""
    sums = [F.sum(c).alias(c) for c in ("ordinary", "toxic")]
    pairs = saved(sample.transform(mapped, _counted, "before bigint, word bigint, ordinary bigint, toxic bigint").groupBy("before", "word").agg(*sums), "toxicity-pairs")
    words = saved(pairs.groupBy("word").agg(*sums, F.count("*").alias("after")), "toxicity-words")
    total = words.agg(*sums, F.sum("after").alias("after"), F.count("*").alias("types"), F.sum(F.least(F.col("ordinary") + F.col("toxic"), F.lit(DISCOUNT))).alias("taken")).first()
    seen = words.where("ordinary + toxic > 1").toArrow()  # a word seen once tells the classes nothing: it is as the unknown one
    codes, n, after = seen["word"].to_numpy().view(np.uint64), np.stack([seen["ordinary"].to_numpy(), seen["toxic"].to_numpy()]).astype(float), seen["after"].to_numpy().astype(float)
    totals = np.array([[total["ordinary"] or 0], [total["toxic"] or 0]], float)
    once = (total["types"] or 0) - len(codes)

    # Words. Those seen once share what is left of them with the unknown word.
    mass = float(np.maximum(totals.sum(), 1))
    shared = np.append(after + 0.5, (total["after"] or 0) - after.sum() + 0.5 * (once + 1))
    shared /= shared.sum()
    apart = _apart(n, totals, WORD_FACTOR)
    pooled = np.maximum(n.sum(0) - DISCOUNT, 0) / mass
    own = np.maximum(n - DISCOUNT, 0) / np.maximum(totals, 1)
    backoff = max((total["taken"] or 0) + once * (1 - DISCOUNT), 1e-3) / mass  # words seen once give all they have
    told, rest = (own * apart).sum(1, keepdims=True), (pooled * ~apart).sum()
    scale = np.maximum(1 - backoff - told, 0) / max(rest, 1e-12)
    kept = np.where(apart, own, scale * pooled)
    unigram = np.concatenate([kept, np.zeros((2, 1))], 1)
    unigram += (1 - unigram.sum(1, keepdims=True)) * shared

    # Pairs, by what follows each of their first words.
    (before, word), count = _by_code(pairs.where(f"ordinary + toxic >= {LEAST_PAIR}"), ["before", "word"])
    firsts = pairs.join(F.broadcast(pairs.where(f"ordinary + toxic >= {LEAST_PAIR}").select("before").distinct()), "before", "left_semi")
    (context,), around = _by_code(firsts.groupBy("before").agg(*sums), ["before"])
    order = np.argsort(context)
    context, around = context[order], around[:, order]
    at = np.searchsorted(context, before)
    mine = _apart(count, around[:, at], PAIR_FACTOR) if len(at) else np.zeros(0, bool)
    before, word, at = before[mine], word[mine], at[mine]
    follow = np.maximum(count[:, mine] - DISCOUNT, 0) / np.maximum(around[:, at], 1)
    known = CodeIndex(codes)
    place = np.where(before == BEGIN, len(codes) + 1, known.find(before))
    left = np.ones((2, len(codes) + 2))  # by number, for unknown words, and for the begin
    for c in (0, 1):
        left[c] -= np.bincount(place, follow[c], len(codes) + 2)
    return Model(known, CodeIndex(paired(before, word)), unigram.astype(np.float32), np.concatenate([follow, np.zeros((2, 1))], 1).astype(np.float32), left.astype(np.float32))


def _fit_curve(x: np.ndarray, y: np.ndarray, odds: float) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge, halved until they help; `odds` corrects for how the classes were sampled."""
    curve = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 5e-3 * (w @ w))

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (y - p) - 1e-2 * curve)
        size, here = 1.0, loss(curve)
        while size > 1e-6 and loss(curve + size * step) > here:
            size /= 2
        curve = curve + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    curve[0] += np.log(odds)
    return curve


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Learn from `labels` (doc_id, toxic), already restricted to the rows that may be learned from."""
    spark = docs.sparkSession
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Classifier(None, np.zeros(0))
    drawn = [marked.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # 2 * sample rows at most
    texts = docs.select(F.col("doc_id").alias("key"), "text").join(chosen, F.col("key") == F.col("doc_id")).select("text", "toxic", (F.pmod(F.xxhash64("key", F.lit(1)), F.lit(CURVE_FOLD)) == 0).alias("curve"))
    shared = spark.sparkContext.broadcast(learn(texts.where("NOT curve").select("text", "toxic")))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gain, count = shared.value.evidence(_bytes(batch.column(0)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(gain), pa.array(count)], names=["toxic", "gain", "count"])

    seen = texts.where("curve").select("text", "toxic").transform(mapped, evidence, "toxic int, gain double, count double").toArrow()
    y = seen["toxic"].to_numpy().astype(np.float64)
    odds = (sizes[1] / min(sizes[1], sample)) / (sizes[0] / min(sizes[0], sample))
    return Classifier(shared, _fit_curve(_features(seen["gain"].to_numpy(), seen["count"].to_numpy()), y, odds))


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id and the score."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_bytes(batch.column(1))))], names=["doc_id", "score"])

    return slim.transform(mapped, scored, "doc_id bigint, score double")


def drop_toxic(docs: DataFrame, model: Classifier, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose score reaches the threshold; all columns as they were."""
    at, names = docs.columns.index(text_col), docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            yield batch.filter(pa.array(model.scores(_bytes(batch.column(at))) < threshold))

    renamed = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return renamed.transform(mapped, kept, renamed.schema).toDF(*names)
