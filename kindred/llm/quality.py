"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text.

Word and punctuation runs and their pairs are hashed to BUCKETS; two multinomials are counted, one over
all documents and one over trusted ones. A document's score is the mean log ratio of its n-grams and it
is kept when the score reaches the threshold.

Defined results: a null or empty text has no words, score 0, and fails the base rules. With no trusted
rows all ratios are 0, so only the base rules reject. A score equal to the threshold keeps. Repeated rows
are judged each for themselves, and each counts where its id is trusted. A text of any length is judged
whole. Other columns of the input are ignored; `keep_documents` passes them on, whatever their names.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, tune, utf8

ship(__name__)

BUCKETS = 1 << 16
THRESHOLD = -0.25  # mean natural-log ratio per n-gram
BROADCAST_IDS = 200_000  # trusted ids up to which they are broadcast; more meet the documents in a shuffled join
SMOOTH = 1.0
CACHED = 300_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
VERDICT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,llr:double,kept:boolean>"


class Hashes(dict):
    """Token to hash, with a bounded memory."""

    def __missing__(self, token):
        if len(self) >= CACHED:
            self.clear()
        self[token] = h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return h


def grams(text: str, hashes) -> np.ndarray:
    """Buckets of the single tokens and pairs of a text."""
    found = TOKEN.findall(text.lower())
    one = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([one, two >> np.uint64(32)]) & np.uint64(BUCKETS - 1)


def base_rules(text: bytes):
    """Word statistics of one text, as the contract of op2 names them."""
    words = text.split()
    plain = text.decode("utf-8", "replace")
    blank = sum(map(plain.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(plain.count, "#*$%&|<>"))
    lines = [x for x in plain.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        reach = 0  # words before this one are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(reach, i)
                reach = i + 3
    n = len(words)
    return n, len(plain) - blank, symbols, len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n, plain


class RatioRule:
    """Fits the two multinomials, then judges texts one by one."""

    def __init__(self, threshold=THRESHOLD, broadcast_ids=BROADCAST_IDS):
        self.threshold, self.broadcast_ids = threshold, broadcast_ids

    def fit(self, docs: DataFrame, labels: DataFrame) -> "RatioRule":
        tune(docs.sparkSession)
        good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("good_id")).distinct()
        if good.count() <= self.broadcast_ids:
            good = F.broadcast(good)
        rows = docs.select(utf8("text").alias("text"), F.col("doc_id").alias("own_id"))
        rows = rows.join(good, F.col("own_id") == F.col("good_id"), "left").select("text", F.col("good_id").isNotNull())

        def count(batches):
            hashes, sums = Hashes(), np.zeros((2, BUCKETS), np.int64)
            for batch in batches:
                for text, trusted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    got = np.bincount(grams(text.decode("utf-8", "replace"), hashes).astype(np.int64), minlength=BUCKETS) if text else 0
                    sums[0] += got
                    if trusted:
                        sums[1] += got
            at = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[0][at]), pa.array(sums[1][at])], ["at", "raw", "trusted"])

        sums = np.zeros((2, BUCKETS))
        for r in rows.mapInArrow(count, "at int, raw long, trusted long").groupBy("at").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).collect():
            sums[:, r["at"]] = r["raw"], r["trusted"]
        raw, target = (sums + SMOOTH) / (sums + SMOOTH).sum(1, keepdims=True)
        self.ratios = np.log(target / raw) if sums[1].any() else np.zeros(BUCKETS)
        return self

    def verdict(self, text="text"):
        """Column of VERDICT for a text column."""
        ratios, threshold = self.ratios.astype(np.float64), self.threshold
        state = {}

        @F.arrow_udf(VERDICT)
        def judge(texts: pa.Array) -> pa.Array:
            hashes = state.setdefault("hashes", Hashes())
            rows = []
            for raw in texts.to_pylist():
                *base, plain = base_rules(raw)
                at = grams(plain, hashes)
                llr = float(ratios[at.astype(np.int64)].mean()) if len(at) else 0.0
                rows.append((*base, llr, not base[-1] and llr >= threshold))
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, kinds)], names)

        return judge.asNondeterministic()(utf8(text))


def judge_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id with the base statistics, the ratio and the decision, for each row of docs."""
    rule = RatioRule(**options).fit(docs, labels)
    return docs.select("doc_id", rule.verdict().alias("v")).select("doc_id", "v.*")


def keep_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    rule = RatioRule(**options).fit(docs, labels)
    return docs.withColumn("__kindred_v", rule.verdict()).where("__kindred_v.kept").drop("__kindred_v")
