"""Language-model scoring with a hidden Markov model over words.

Words outside the most frequent ones are tied: a rare word's class is a hash of its last bytes, and the
state emits the class while the class emits the word by its corpus count. The tables that every task
needs (states x classes, and a dictionary of frequent words) have fixed sizes; the open vocabulary
stays a distributed table that meets the documents in one join.

Baum-Welch starts from values that a small sample of different rows gives, and then runs over all training
rows; the sample's size hardly moves the held-out likelihood (README).

Defined results: a null or empty text is one end token. A text of any length is scored whole, in blocks.
Words of equal counts stand in the order of their bytes. With no training rows every count is 0, so the
base score is 0 and the model is uniform. Repeated rows are scored each for themselves; a null id
counts as the empty text when rows are dealt to folds. Other columns of the input are ignored.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, hash_sample, id_remainder, ship, utf8

ship(__name__)

END = b"\n"  # no word holds white space, so this token is free for the end
STATES = 8
OWN_CLASSES = 4096  # most frequent words that are a class of their own, the end included
SUFFIX_CLASSES = 512
DICTIONARY = 131072  # most frequent words whose counts every task holds; words over WORD_BYTES never
WORD_BYTES = 64
ROUNDS = 3  # Baum-Welch rounds over all training rows
WARM_DOCS, WARM_TOKENS, WARM_ROUNDS = 400, 4096, 20  # bounded sample that only sets the starting values
SMOOTH = 0.1
BUFFER = 400_000  # tokens in a block of the recursions
FLUSH = 400_000  # distinct words that a counting task holds


def words(text: bytes) -> list:
    """bytes.lower folds A-Z only, and bytes.split cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.lower().split()


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX_CLASSES


def count_words(batches):
    counts = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words(text))
        counts[END] += batch.num_rows
        if len(counts) > FLUSH:
            yield out()
            counts.clear()
    yield out()


# ---------------------------------------------------------------- the recursions, in blocks


class Block:
    """Class sequences laid out by time, longest first: at time t the first `active[t]` rows are alive."""

    def __init__(self, sequences):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        top = int(lengths[0])
        self.active = np.bincount(lengths, minlength=top + 1)[::-1].cumsum()[::-1][1:]
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        row = np.repeat(np.arange(len(sequences)), lengths)
        time = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        where = self.start[time] + row
        self.obs = np.empty(len(row), np.int64)
        self.obs[where] = np.concatenate([sequences[i] for i in self.order])
        self.row = np.empty(len(row), np.int64)
        self.row[where] = row
        self.top = top


def forward(block, first, trans, emit, keep):
    """Scaled forward recursion: log10 likelihood of each row (in block order); with keep also the scaled alphas."""
    e = emit.T[block.obs]
    scale = np.empty(len(block.obs))
    alpha = np.empty_like(e) if keep else None
    ones = np.ones(trans.shape[0])
    a = first * e[: block.active[0]]
    for t in range(block.top):
        lo, n = block.start[t], block.active[t]
        if t:
            a = a[:n] @ trans
            a *= e[lo : lo + n]
        c = a @ ones
        a /= c[:, None]
        scale[lo : lo + n] = c
        if keep:
            alpha[lo : lo + n] = a
    total = np.bincount(block.row, weights=np.log10(scale), minlength=len(block.order))
    return total, alpha, scale, e, a


def expect(block, first, trans, emit):
    """Expected counts of first states, transitions and emissions (Baum-Welch)."""
    states, classes = emit.shape
    _, alpha, scale, e, _ = forward(block, first, trans, emit, True)
    moves = np.zeros((states, states))
    beta = np.ones((0, states))
    for t in range(block.top - 1, -1, -1):
        lo, n = block.start[t], block.active[t]
        now = np.ones((n, states))
        if len(beta):
            m, after = len(beta), block.start[t + 1]
            ahead = e[after : after + m] * beta / scale[after : after + m, None]
            moves += alpha[lo : lo + m].T @ ahead
            now[:m] = ahead @ trans.T
        alpha[lo : lo + n] *= now
        beta = now
    begin = alpha[: block.active[0]].sum(0)
    emitted = np.stack([np.bincount(block.obs, weights=alpha[:, k], minlength=classes) for k in range(states)])
    return begin, moves * trans, emitted


def pieces_of(sequence):
    """A very long sequence in blocks of BUFFER tokens; the recursion runs on over them when it scores."""
    return [sequence[i : i + BUFFER] for i in range(0, len(sequence), BUFFER)]


def log10_likelihood(sequence, first, trans, emit):
    """Exact likelihood of one long sequence, block by block."""
    total, start = 0.0, first
    for part in pieces_of(sequence):
        got, _, _, _, last = forward(Block([part]), start, trans, emit, False)
        total, start = total + got[0], last[0] @ trans
    return total


def normalise(begin, moves, emitted, shared):
    first = (begin + SMOOTH) / (begin + SMOOTH).sum()
    trans = (moves + SMOOTH) / (moves + SMOOTH).sum(1, keepdims=True)
    emit = emitted + 100 * SMOOTH * shared
    return first, trans, emit / emit.sum(1, keepdims=True)


def blocks_of(items, size):
    """Lists of (key, sequence) of at most BUFFER tokens or one longer sequence."""
    held, n = [], 0
    for key, sequence in items:
        if held and n + len(sequence) > size:
            yield held
            held, n = [], 0
        held.append((key, sequence))
        n += len(sequence)
    if held:
        yield held


class WordHMM:
    """Fits on a table of (doc_id, text) and scores it."""

    def __init__(self, states=STATES, rounds=ROUNDS, folds=7, held_fold=2):
        self.states, self.rounds, self.folds, self.held_fold = states, rounds, folds, held_fold

    # ---- corpus counts
    def _vocabulary(self, docs, scratch):
        train = docs.where(~F.col("held_out")).select("text")
        return scratch.save(train.mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "vocabulary")

    def _tables(self, vocabulary):
        tokens, types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        short = F.octet_length("word") <= WORD_BYTES
        level = F.floor(F.log2("n") * 16).cast("int")
        least = 0
        seen = 0
        for row in sorted(vocabulary.where(short).groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
            if seen + row["count"] > DICTIONARY:
                least = row["level"] + 1
                break
            seen += row["count"]
        frequent = sorted(((r["n"], bytes(r["word"])) for r in vocabulary.where(short & (level >= least)).collect()), key=lambda x: (-x[0], x[1]))
        own = [END, *[w for _, w in frequent if w != END][: OWN_CLASSES - 1]]
        counts = {w: n for n, w in frequent}
        if END not in counts:
            counts[END] = next((r["n"] for r in vocabulary.where(F.col("word") == F.lit(END)).collect()), 0)
        alone = set(own)
        listed = [*own, *[w for _, w in frequent if w not in alone]]
        size = len(own) + SUFFIX_CLASSES
        of_class = np.zeros((2, size))
        suffix = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(SUFFIX_CLASSES)).cast("int")
        for r in vocabulary.groupBy(suffix.alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            of_class[:, len(own) + r["c"]] = r["n"], r["v"]
        for i, w in enumerate(own):
            if counts[w]:
                of_class[:, len(own) + suffix_class(w)] -= counts[w], 1
            of_class[0, i] = counts[w]
        self.tokens, self.types, self.least, self.own = int(tokens), int(types), least, len(own)
        self.model = {
            "codes": {w: i for i, w in enumerate(listed)},
            "counts": np.array([counts[w] for w in listed], np.int64),
            "classes": np.array([i if i < len(own) else len(own) + suffix_class(w) for i, w in enumerate(listed)], np.int64),
            "norm": np.where(np.arange(size) < len(own), 0.0, np.log10(of_class.sum(0) + 1)),
            "own": len(own),
        }
        self.shared = (of_class[0] + 1) / (of_class[0] + 1).sum()

    # ---- documents as class sequences
    def _encode(self, docs, scratch):
        shared = docs.sparkSession.sparkContext.broadcast(self.model)

        def encode(batches):
            m = shared.value
            own, counts, classes, norm = m["own"], m["counts"], m["classes"], m["norm"]
            logs = np.log10(counts + 1.0)

            class Codes(dict):
                def __missing__(self, word):  # a rare word: its class, as a negative code
                    return -1 - suffix_class(word)

            codes = Codes(m["codes"])
            for batch in batches:
                cols = [[] for _ in range(9)]
                for doc_id, held_out, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    found = words(text)
                    found.append(END)
                    code = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
                    rare = code < 0
                    sequence = np.where(rare, own - 1 - code, classes[np.maximum(code, 0)])
                    known = code[~rare]
                    tallies = Counter(found[i] for i in np.flatnonzero(rare).tolist())
                    tied = known[known >= own]
                    for col, x in zip(cols, (doc_id, held_out, len(found), int((counts[known] > 0).sum()), float(logs[known].sum()), float(logs[tied].sum() - norm[sequence].sum()), sequence.astype("<u2").tobytes(), list(tallies), list(tallies.values()))):
                        col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (batch.schema.field(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())))], ["doc_id", "held_out", "n_tokens", "n_known", "base_log", "within", "classes", "rare", "rare_n"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        rows = docs.select("doc_id", "held_out", "text").mapInArrow(encode, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_log double, within double, classes binary, rare array<binary>, rare_n array<long>")
        saved = scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), "sequences")
        shared.destroy()
        return saved

    # ---- Baum-Welch
    def _train(self, encoded):
        train = encoded.where(~F.col("held_out")).select("classes")
        size = self.own + SUFFIX_CLASSES
        sample = hash_sample(train.where(F.octet_length("classes") <= 2 * WARM_TOKENS), "classes", WARM_DOCS).collect()
        draw = np.random.default_rng(7)
        spread = self.shared * np.exp(draw.normal(0, 0.7, (self.states, size)))
        stay = np.full((self.states, self.states), 0.1 / self.states) + 0.9 * np.eye(self.states)
        params = np.full(self.states, 1 / self.states), stay, spread / spread.sum(1, keepdims=True)
        warm = [Block([s for _, s in held]) for held in blocks_of(((None, np.frombuffer(r["classes"], "<u2").astype(np.int64)) for r in sample), BUFFER)]
        for _ in range(WARM_ROUNDS if warm else 0):
            got = [expect(b, *params) for b in warm]
            params = normalise(*(sum(x) for x in zip(*got)), self.shared)
        states, shared = self.states, self.shared
        for _ in range(self.rounds):

            def gather(batches, params=params):
                first, trans, emit = params
                sums = [np.zeros(states), np.zeros((states, states)), np.zeros((states, size))]

                def sequences():
                    for batch in batches:
                        for raw in batch.column(0).to_pylist():
                            for part in pieces_of(np.frombuffer(raw, "<u2").astype(np.int64)):
                                yield None, part

                for held in blocks_of(sequences(), BUFFER):
                    for total, got in zip(sums, expect(Block([s for _, s in held]), first, trans, emit)):
                        total += got
                flat = np.concatenate([s.ravel() for s in sums])
                at = np.flatnonzero(flat)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.rint(flat[at] * 2**20).astype(np.int64))], ["at", "units"])

            # fixed-point units: the sum doesn't depend on the order of tasks
            flat = np.zeros(states + states**2 + states * size)
            for r in train.mapInArrow(gather, "at int, units long").groupBy("at").agg(F.sum("units").alias("units")).collect():
                flat[r["at"]] = r["units"] / 2**20
            begin, moves, emitted = np.split(flat, [states, states + states**2])
            params = normalise(begin, moves.reshape(states, states), emitted.reshape(states, size), shared)
        self.params = tuple(np.round(p, 12) for p in params)

    def fit_score(self, docs: DataFrame) -> DataFrame:
        scratch = Scratch(docs.sparkSession, "hmm")
        docs = docs.select("doc_id", utf8("text").alias("text"), (id_remainder(self.folds) == self.held_fold).alias("held_out"))
        vocabulary = self._vocabulary(docs, scratch)
        self._tables(vocabulary)
        encoded = self._encode(docs, scratch)
        self._train(encoded)
        params = self.params

        def score(batches):
            def sequences():
                for batch in batches:
                    for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        yield row, np.frombuffer(raw, "<u2").astype(np.int64)

            for held in blocks_of(sequences(), BUFFER):
                if len(held) == 1:
                    rows, logs = [held[0][0]], [log10_likelihood(held[0][1], *params)]
                else:
                    block = Block([s for _, s in held])
                    total = forward(block, *params, False)[0]
                    rows, logs = [held[i][0] for i in block.order], total
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(logs, pa.float64())], ["row", "path_log"])

        kind = encoded.schema["doc_id"].dataType
        nothing = {"doc_id": kind, "held_out": "boolean", "n_tokens": "long", "n_known": "long", "base_log": "double", "within": "double", "path_log": "double"}
        fill = lambda df, **have: df.select("row", *[have.get(c, F.lit(None).cast(t)).alias(c) for c, t in nothing.items()])
        paths = fill(encoded.select("row", "classes").mapInArrow(score, "row long, path_log double"), path_log=F.col("path_log"))
        plain = fill(encoded, **{c: F.col(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_log", "within")})
        rare = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times"))
        rare = rare.join(vocabulary, "word").groupBy("row").agg(F.sum("times").alias("n_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log"))
        rare = fill(rare, n_known=F.col("n_known"), base_log=F.col("log"), within=F.col("log"))
        whole = plain.unionByName(paths).unionByName(rare).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_log", "within", "path_log")])
        unit = float(np.log10(self.tokens + self.types + 1))
        return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(self.tokens).cast("long").alias("train_tokens"), (F.col("base_log") - F.col("n_tokens") * F.lit(unit)).alias("base_score"), (F.col("within") + F.col("path_log")).alias("score"))
