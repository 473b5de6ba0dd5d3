"""Toxicity scores of a counterfactually regularised linear classifier.

A logistic model over the presence of words is fitted on a bounded, deduplicated sample of labelled rows.
Beside the log-loss it is charged for score changes between a labelled sentence and the same sentence
with its identity terms swapped, so that naming a group doesn't move a score. Every sentence of the sample
that names a group counts: swaps change identity terms only, so what tasks pass on is a square of a fixed
number of terms, however many sentences there are. All words that tell the labels apart are in the model.

Defined results: a null or empty text scores as a text without known words. With no labelled rows every
score is the prior, 0. Rows labelled more than once count as toxic if any label says so. A null id is the
empty text where rows are dealt to folds. Words equally telling are all taken. Texts are read whole, whatever
their length. Repeated rows are scored each for themselves; other columns are ignored, whatever their names.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, hash_sample, id_remainder, ship, tune, utf8

ship(__name__)

SAMPLE = 8_000  # most labelled rows that the model is fitted on
LEAST_DOCS = 5
LEAST_FAR = 3.0  # standard errors from the corpus's toxic share
STEPS, RIDGE, FAIRNESS = 25, 0.1, 5.0
WORD = re.compile(r"[^\W\d_]+")
#: Identity terms; a term is swapped for the next one of its own group.
IDENTITY = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["girl", "boy"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"], ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"], ["gay", "straight", "lesbian", "transgender", "bisexual"],
    ["immigrants", "natives", "refugees", "citizens"], ["disabled", "deaf", "blind"], ["old", "young"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"], ["frauen", "männer"], ["muslime", "christen", "juden"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]
SWAP = {w: g[(i + 1) % len(g)] for g in IDENTITY for i, w in enumerate(g)}


def words_of(text: str) -> set:
    return set(WORD.findall(text.lower()))


def swapped(sentence: str) -> str:
    """The sentence, in lower case, with every identity term replaced by the next of its group."""
    return WORD.sub(lambda m: SWAP.get(m[0], m[0]), sentence.lower())


def sentences(text: str) -> list:
    return [s for s in re.split(r"[.!?\n]+", text) if s.strip()]


@arrow_column("array<string>")
def distinct_words(texts: pa.Array) -> pa.Array:
    return pa.array([sorted(words_of(t.decode("utf-8", "replace"))) for t in texts.to_pylist()], pa.list_(pa.string()))


class Words:
    """Presence of words in texts as a sparse matrix: the word numbers of each text; the last column is the bias."""

    def __init__(self, rows, size):
        self.n, self.size = len(rows), size
        self.at = np.concatenate([np.zeros(0, np.int64), *[np.append(np.asarray(r, np.int64), size) for r in rows]])
        self.row = np.repeat(np.arange(self.n), [len(r) + 1 for r in rows]) if self.n else np.zeros(0, np.int64)

    def dot(self, w):
        return np.bincount(self.row, weights=w[self.at], minlength=self.n)

    def back(self, v):
        return np.bincount(self.at, weights=v[self.row], minlength=self.size + 1)


class Loss:
    """Log-loss, a ridge, and the squared score changes over counterfactual pairs, which together weigh as much as all
    labelled rows times `fairness`. swaps: sum of d d' over the pairs' differences d of word presence; its rows and
    columns are the first words."""

    def __init__(self, x: Words, y, swaps, n_pairs, ridge=RIDGE, fairness=FAIRNESS):
        self.x, self.y, self.k = x, y, len(swaps)
        self.swaps = fairness * x.n / max(n_pairs, 1) * swaps
        self.ridge = np.append(np.full(x.size, ridge), ridge * 1e-6)

    def charge(self, w):
        out = self.ridge * w
        out[: self.k] += self.swaps @ w[: self.k]
        return out

    def value(self, w):
        z = self.x.dot(w)
        return np.logaddexp(0, z).sum() - self.y @ z + 0.5 * w @ self.charge(w)

    def slope(self, w):
        p = 1 / (1 + np.exp(-np.clip(self.x.dot(w), -30, 30)))
        return self.x.back(p - self.y) + self.charge(w), p * (1 - p)

    def step(self, w):
        """Newton's step by conjugate gradients, so that no matrix of words by words is made."""
        slope, curve = self.slope(w)
        # the diagonal that scales the search
        scale = self.x.back(curve) + self.ridge + 1e-9
        scale[: self.k] += np.diag(self.swaps)
        step, rest = np.zeros_like(w), -slope
        way = ready = rest / scale
        size = first = rest @ ready
        for _ in range(200):
            if size <= 1e-12 * first or size <= 0:
                break
            turned = self.x.back(curve * self.x.dot(way)) + self.charge(way) + 1e-9 * way
            far = size / (way @ turned)
            step, rest = step + far * way, rest - far * turned
            ready = rest / scale
            size, before = rest @ ready, size
            way = ready + size / before * way
        return step, slope


def train(loss: Loss, steps=STEPS):
    """Weights of the words, and the bias, at the least loss."""
    y = loss.y
    w = np.zeros(loss.x.size + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    now = loss.value(w)
    for _ in range(steps):
        step, slope = loss.step(w)
        size = 1.0
        while loss.value(w + size * step) > now and size > 1e-4:
            size /= 2
        w, before = w + size * step, now
        now = loss.value(w)
        if before - now < 1e-9 * (1 + abs(now)):
            break
    return w[:-1], float(w[-1])


def swaps_of(text: str, at: dict):
    """(differences, pairs): for each sentence that names a group, the terms that a swap takes out and puts in."""
    for s in sentences(text):
        a, b = words_of(s), words_of(swapped(s))
        if a != b:
            yield np.array([at[w] for w in a - b], np.int64), np.array([at[w] for w in b - a], np.int64)


def add_swap(sums, gone, come, k):
    """Adds d d' of one pair, and the pair itself, to sums."""
    both, sign = np.concatenate([gone, come]), np.repeat([1, -1], [len(gone), len(come)])
    np.add.at(sums, (both[:, None] * k + both[None, :]).ravel(), np.outer(sign, sign).ravel())
    sums[-1] += 1


class ToxicityModel:
    def __init__(self, sample=SAMPLE, folds=5, held_fold=0, fairness=FAIRNESS):
        self.sample, self.folds, self.held_fold, self.fairness = sample, folds, held_fold, fairness

    def fit(self, docs: DataFrame, labels: DataFrame) -> "ToxicityModel":
        tune(docs.sparkSession)
        marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(self.folds) != self.held_fold))
        marks = marks.groupBy(F.col("doc_id").alias("marked_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        if marks.count() > self.sample:  # the same rows in every run, so that scores repeat
            marks = hash_sample(marks, "marked_id", self.sample)
        texts = docs.select(F.col("doc_id").alias("own_id"), utf8("text").alias("text"))
        rows = texts.join(F.broadcast(marks), texts.own_id == marks.marked_id)
        # copies of one text would make its chance words look meaningful
        rows = rows.groupBy(F.sha2("text", 256).alias("same")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
        rows = rows.select("toxic", "text", distinct_words("text").alias("words")).persist()
        try:
            tally = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_DOCS)
            whole = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
            t, n = int(whole["t"]), int(whole["n"])
            # words by how far their toxic share is from the corpus's, in standard errors
            share = t / max(n, 1)
            far = F.abs(F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9))
            terms = sorted(SWAP)
            words = [*terms, *sorted(r["word"] for r in tally.where(far >= LEAST_FAR).collect() if r["word"] not in SWAP)]
            at, k = {w: i for i, w in enumerate(words)}, len(terms)

            @F.arrow_udf("array<int>")
            def places(found: pa.Array) -> pa.Array:
                return pa.array([[at[w] for w in own if w in at] for own in found.to_pylist()], pa.list_(pa.int32()))

            def pairs(batches):
                """Sums of d d' over the sentences of a task's texts; their number stands behind the last cell."""
                sums = np.zeros(k * k + 1, np.int64)
                for batch in batches:
                    for raw in batch.column(0).to_pylist():
                        for gone, come in swaps_of(raw.decode("utf-8", "replace"), at):
                            add_swap(sums, gone, come, k)
                cells = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(sums[cells])], ["cell", "n"])

            got = sorted((r["toxic"], sorted(r["at"])) for r in rows.select("toxic", places("words").alias("at")).collect())
            named = rows.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in terms]))).select("text")
            sums = np.zeros(k * k + 1, np.int64)
            for r in named.mapInArrow(pairs, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
                sums[r["cell"]] = r["n"]
        finally:
            rows.unpersist()
        for w, v in SWAP.items():  # a bare mention of each group, whether or not the sample has one
            add_swap(sums, np.array([at[w]]), np.array([at[v]]), k)
        y = np.array([toxic for toxic, _ in got], np.float64)
        if len(y) and 0 < y.sum():
            loss = Loss(Words([found for _, found in got], len(words)), y, sums[:-1].reshape(k, k).astype(np.float64), int(sums[-1]), fairness=self.fairness)
            weights, self.bias = train(loss)
        else:
            weights, self.bias = np.zeros(len(words)), -20.0
        self.weights = {w: float(v) for w, v in zip(words, weights) if abs(v) > 1e-3}
        return self

    def score(self, text_col="text"):
        weights, bias = self.weights, self.bias

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            out = []
            for raw in texts.to_pylist():
                found = words_of(raw.decode("utf-8", "replace")) & weights.keys()
                out.append(bias + sum(weights[w] for w in sorted(found)))
            return pa.array(1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -500, 500))))

        return score(utf8(text_col))


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    model = ToxicityModel(**options).fit(docs, labels)
    rows = docs.select("doc_id", (id_remainder(model.folds) == model.held_fold).alias("held_out"), model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
