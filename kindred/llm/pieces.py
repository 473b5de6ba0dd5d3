"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut where no piece can reach across, into chunks, and the corpus's chunks are counted. The
DICTIONARY most frequent ones are looked at as relations: their substrings of bounded length are exploded
and equi-joined to the piece table, the edges found are grouped by chunk, and Spark's higher-order
aggregate folds them. A unigram model's fold is Viterbi's. A BPE model's pieces carry merge ranks, not
probabilities, and the best path by their sum is another segmentation than the model's; for those the
same fold over the same lattice merges, step by step, the adjacent pair of the best rank, which gives the
library's ids. The dictionary has a fixed bound and goes to every task; rarer chunks, chunks over
LATTICE_CHARS and characters outside the vocabulary are folded by the same rule where they stand, since a
join would move several times the input to bring their ids back; a BPE model's rarer chunks are merged many
at a time, in arrays.

Defined results: null and empty texts have no ids and decode to the empty text. A text that holds U+2581
itself decodes with a space there, as the library does. Repeated rows are encoded each for themselves;
other columns are ignored.
"""

import heapq
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, ship, utf8

ship(__name__)

SPACE = "▁"
LATTICE_CHARS = 62  # boundaries of a chunk fit the bits of a long
MOST_PIECES = 1_000_000  # pieces up to which the table is broadcast
DICTIONARY = 1 << 17  # most frequent chunks that every task holds with their ids
DICTIONARY_CHARS = 48
FLUSH = 50_000  # distinct chunks that a counting task holds
CACHED, CACHED_CHARS = 30_000, 128  # chunks that a task encodes one by one and remembers
CELLS = 1 << 16  # characters of rarer chunks that are merged side by side
BITS, TRIES = 21, 50  # of a part's number in the table of pairs; places tried for a row of it
NEVER = (1 << BITS) - 1  # the rank of pairs that don't merge
ENCODED = 128  # texts whose ids a task holds at once


class PieceModel:
    """The vocabulary of a model file: ordinary pieces with scores, and ids of single bytes."""

    def __init__(self, pieces, kind="bpe", byte_ids=None, unk_id=0, dummy_prefix=True, texts=None):
        """pieces: [(piece, id, score)]; byte_ids: 256 ids or None."""
        self.kind, self.byte_ids, self.unk_id, self.dummy_prefix = kind, byte_ids, unk_id, dummy_prefix
        ranks = {s: r for r, s in enumerate(sorted({s for _, _, s in pieces}, reverse=True))}
        self.rows = [(p, i, float(s), ranks[s]) for p, i, s in pieces]
        self.table = {p: (r, i) for p, i, _, r in self.rows}
        self.ranks, self.ids = {p: r for p, _, _, r in self.rows}, {p: i for p, i, *_ in self.rows}
        self.longest = max((len(p) for p, *_ in self.rows), default=1)
        crossing = [p for p in self.table if SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces that hold a word's end and the next one's start aren't supported: {crossing[:3]}")
        alone = "".join(c for c in map(chr, range(32)) if not any(c in p for p in self.table))
        shut = re.escape(alone)
        self.cut = (f"[{shut}]|" if alone else "") + f"{SPACE}*[^{SPACE}{shut}]+|{SPACE}+"
        self.surface = {unk_id: b" \xe2\x81\x87 ", **{i: p.encode() for p, i, *_ in self.rows}}
        if byte_ids:
            self.surface.update((i, bytes([b])) for b, i in enumerate(byte_ids))

    def __getstate__(self):
        """What tasks need: a unigram model's scores travel with its rows, a BPE model's ranks are enough."""
        kept = dict(self.__dict__)
        if self.kind == "bpe":
            kept |= {"rows": None, "table": None}
        return kept

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        by_byte = [i for i in ids if model.is_byte(i)]
        scores = [model.get_score(i) for i in plain]
        kind = "bpe" if all(s == int(s) and s <= 0 for s in scores) else "unigram"
        first = model.encode("a", out_type=str)[0]
        return cls([(model.id_to_piece(i), i, s) for i, s in zip(plain, scores)], kind, by_byte if len(by_byte) == 256 else None, model.unk_id(), first.startswith(SPACE))

    def chunks(self, text: str) -> list:
        if not text:
            return []
        return re.findall(self.cut, (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def unknown(self, char: str) -> list:
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")] if self.byte_ids else [self.unk_id]

    def encode_chunk(self, chunk: str) -> list:
        """Ids of one chunk, by the model's own rule."""
        if self.kind == "unigram":
            return self.best_path(chunk)
        if len(chunk) > LATTICE_CHARS:
            return self.encode_long(chunk)
        rank, never = self.ranks.get, len(self.ids)
        parts = list(chunk)
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
        ids = self.ids
        try:
            return [ids[p] for p in parts]
        except KeyError:
            return [x for p in parts for x in ([ids[p]] if p in ids else self.unknown(p))]

    def encode_long(self, chunk: str) -> list:
        """The same merges in n log n steps, for chunks of any length."""
        ranks, n = self.ranks, len(chunk)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i):
            j = after[i]
            if j < n:
                found = ranks.get(chunk[i : ends[j]]) if ends[j] - i <= self.longest else None
                if found is not None:
                    heapq.heappush(heap, (found, i, ends[j]))

        for i in range(n - 1):
            offer(i)
        alive = [True] * n
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if not alive[i] or j >= n or ends[j] != end:
                continue  # one of its parts has changed since
            alive[j] = False
            ends[i], after[i] = end, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            found = self.ids.get(chunk[i : ends[i]])
            out += [found] if found is not None else self.unknown(chunk[i])
            i = after[i]
        return out

    def best_path(self, chunk: str) -> list:
        """Viterbi over the lattice; ties go to the piece that starts first."""
        score = {p: s for p, _, s, _ in self.rows}
        low = min(score.values(), default=0.0) - 10.0
        best = [(0.0, 0, [])]
        for t in range(1, len(chunk) + 1):
            options = []
            for s in range(max(0, t - self.longest), t):
                p = chunk[s:t]
                if p in score:
                    options.append((best[s][0] + score[p], -s, [self.table[p][1]]))
                elif t - s == 1:
                    options.append((best[s][0] + low, -s, self.unknown(p)))
            best.append(max(options, key=lambda x: (x[0], x[1])))
        out, t = [], len(chunk)
        while t:
            _, s, ids = best[t]
            out[:0] = ids
            t = -s
        return out

    def encode(self, text: str) -> list:
        return [i for c in self.chunks(text) for i in self.encode_chunk(c)]

    def decode(self, ids) -> str:
        try:
            raw = b"".join(map(self.surface.__getitem__, ids))
        except KeyError:  # control ids have no surface
            raw = b"".join(self.surface.get(i, b"") for i in ids)
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


# ---------------------------------------------------------------- the lattice, as relations


def lattice(chunks: DataFrame, model: PieceModel) -> DataFrame:
    """Chunks of at most LATTICE_CHARS characters with `edges`: every place where a piece fits."""
    spark = chunks.sparkSession
    pieces = spark.createDataFrame([(p, r, i, s) for p, i, s, r in model.rows], "piece string, rank long, id int, score double")
    if len(model.rows) <= MOST_PIECES:
        pieces = F.broadcast(pieces)
    rows = chunks.withColumn("n", F.char_length("chunk")).withColumn("s", F.explode(F.expr("sequence(0, n - 1)")))
    rows = rows.withColumn("k", F.explode(F.expr(f"sequence(1, least({model.longest}, n - s))")))
    head = (F.col("s") == 0) & (F.col("k") == 1)
    rows = rows.select("chunk", "n", "s", "k", F.expr("substring(chunk, s + 1, k)").alias("piece"))
    rows = rows.join(pieces, "piece", "left").where(F.col("id").isNotNull() | head)
    bit = lambda at: f"shiftleft(1L, {at})"
    edge = F.expr(f"CASE WHEN id IS NOT NULL THEN struct(rank * 64 + s AS key, {bit('s')} | {bit('s + k')} AS ends, ({bit('s + k')} - 1) & ~({bit('s + 1')} - 1) AS inner, s, k, id, score) END")
    return rows.groupBy("chunk", "n").agg(F.collect_list(edge).alias("edges"), F.count_if((F.col("k") == 1) & F.col("id").isNotNull()).alias("known"))


#: bits of the boundaries that are left: each step takes out the inner boundary of the best pair.
MERGES = "aggregate(IF(n > 1, sequence(2, n), array()), shiftleft(1L, n + 1) - 1, (m, i) -> m & ~coalesce(array_min(filter(edges, e -> (m & e.ends) = e.ends AND bit_count(m & e.inner) = 1)).inner, 0L))"
PICKED = "transform(array_sort(transform(filter(edges, e -> (mask & e.ends) = e.ends AND (mask & e.inner) = 0), e -> struct(e.s, e.id))), e -> e.id)"
#: (score, -start, id) of the best way to each position, then the way back from the last one.
VITERBI = "aggregate(sequence(1, n), array(struct(0D AS score, 0 AS back, -1 AS id)), (best, t) -> array_append(best, array_max(transform(filter(edges, e -> e.s + e.k = t), e -> struct(get(best, e.s).score + e.score AS score, -e.s AS back, e.id AS id)))))"
BACKWARD = "aggregate(sequence(1, n), struct(n AS t, CAST(array() AS array<int>) AS ids), (w, i) -> IF(w.t = 0, w, struct(-get(best, w.t).back AS t, array_prepend(w.ids, get(best, w.t).id) AS ids)), w -> w.ids)"


def fold(edges: DataFrame, model: PieceModel) -> DataFrame:
    """edges with `ids`; null where a character has no piece, which is left to the caller."""
    whole = F.col("known") == F.col("n")
    if model.kind == "bpe":
        return edges.withColumn("mask", F.when(whole, F.expr(MERGES))).withColumn("ids", F.when(whole, F.expr(PICKED))).drop("mask")
    return edges.withColumn("best", F.when(whole, F.expr(VITERBI))).withColumn("ids", F.when(whole, F.expr(BACKWARD))).drop("best")


def encode_chunks(chunks: DataFrame, model: PieceModel) -> DataFrame:
    """chunks with `ids`."""
    short = F.char_length("chunk") <= LATTICE_CHARS
    near = fold(lattice(chunks.where(short), model), model).select("chunk", "ids")
    far = chunks.where(~short).select("chunk", F.lit(None).cast("array<int>").alias("ids"))

    @F.arrow_udf("array<int>")
    def by_hand(missing: pa.Array) -> pa.Array:
        return pa.array([None if c is None else model.encode_chunk(c) for c in missing.to_pylist()], pa.list_(pa.int32()))

    rows = near.unionByName(far).withColumn("own", by_hand(F.when(F.col("ids").isNull(), F.col("chunk"))))
    return rows.withColumn("ids", F.coalesce("ids", "own")).drop("own")


# ---------------------------------------------------------------- documents


def count_chunks(cut, dummy):
    find = re.compile(cut).findall

    def run(batches):
        counts = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["chunk", "n"])

        for batch in batches:
            for raw in batch.column(0):
                if raw.as_buffer():
                    counts.update(find((SPACE if dummy else "") + raw.as_py().decode("utf-8", "replace").replace(" ", SPACE)))
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return run


def frequent_chunks(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent chunks of at most DICTIONARY_CHARS characters, at most `most` of them: the threshold comes
    from a small table of chunks by the logarithm of their count."""
    short = counts.where(F.char_length("chunk") <= DICTIONARY_CHARS)
    level = F.floor(F.log2("n") * 16).cast("int")
    least, seen = 0, 0
    for row in sorted(short.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        if seen + row["count"] > most:
            least = row["level"] + 1
            break
        seen += row["count"]
    return short.where(level >= least).select("chunk")


def merge_tables(model: PieceModel) -> dict | None:
    """A BPE model's pairs as arrays, so that many chunks can be merged side by side; None where there are none.
    Parts are numbered by rank. The pair of x and y is looked up at shift[x] + y of `slots`, which holds x, the merge's
    rank and its number in BITS bits each; rows of x are laid over each other where they leave one another's slots free."""
    order = sorted(model.ranks, key=model.ranks.get)
    names = order + sorted({c for p in order for c in p} - model.ranks.keys())
    number, none = {p: n for n, p in enumerate(names)}, len(names)
    pairs = [(number[p[:k]], number[p[k:]], model.ranks[p], n) for n, p in enumerate(order) for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
    if model.kind != "bpe" or not pairs or none >= 1 << BITS:
        return None
    pairs = np.array(sorted(pairs), np.int64)
    left, first, sizes = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    shift, slots, draw = np.zeros(none + 1, np.int64), np.full(2 * none + 2, -1, np.int64), np.random.default_rng(0)
    for k in np.argsort(-sizes, kind="stable"):
        x, y, rank, n = pairs[first[k] : first[k] + sizes[k]].T
        for at in draw.integers(len(slots) - none, size=TRIES):
            if (slots[y + at] < 0).all():
                break
        else:
            at = len(slots)
            slots = np.concatenate([slots, np.full(none + 1, -1, np.int64)])
        shift[left[k]] = at
        slots[y + at] = (x << 2 * BITS) | (rank << BITS) | n
    ids = np.array([model.ids.get(p, -1) for p in names] + [-1], np.int32)
    single = {ord(p): n for p, n in number.items() if len(p) == 1}
    chars = np.full(max(single) + 2, none, np.int32)
    chars[list(single)] = list(single.values())
    return {"shift": shift, "slots": slots, "ids": ids, "chars": chars}


def numbers_of(chunks: list, t: dict) -> np.ndarray:
    """Numbers of all characters, one chunk after the other; the last number for those that no piece holds."""
    return t["chars"][np.minimum(np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32), len(t["chars"]) - 1)]


def merge_rows(chunks: list, t: dict):
    """Ids of all chunks, one after the other, and how many each has: every round merges in each chunk the leftmost pair
    of the best rank. Characters must have ids."""
    shift, slots, none = t["shift"], t["slots"], len(t["ids"]) - 1

    def pair(x, y):
        """Rank and number of the merge; the rank is NEVER where there is none."""
        found = slots[shift[x] + y]
        return np.where(found >> 2 * BITS == x, (found >> BITS) & NEVER, NEVER).astype(np.int32), found & NEVER

    n = np.fromiter(map(len, chunks), np.int64, len(chunks))
    width = int(n.max()) + 2  # a part that pairs with nothing stands before each chunk and after it
    at = np.arange(width)
    live = (at > 0) & (at <= n[:, None])
    parts = np.full(live.shape, none, np.int32)
    parts[live] = numbers_of(chunks, t)
    ranks = np.full(live.shape, NEVER, np.int32)
    ranks[:, :-1] = pair(parts[:, :-1], parts[:, 1:])[0]
    after, before = (np.broadcast_to(at + d, live.shape).ravel() for d in (1, -1))
    after, before, part, rank, alive = after.copy(), before.copy(), parts.reshape(-1), ranks.reshape(-1), live.reshape(-1)
    rows = np.arange(len(chunks))
    while True:
        best = ranks[rows].argmin(axis=1)
        going = ranks[rows, best] < NEVER
        rows, best = rows[going], best[going]
        if not len(rows):
            break
        start = rows * width
        i = start + best
        j, h = start + after[i], start + before[i]
        end = start + after[j]
        part[i] = new = pair(part[i], part[j])[1]
        alive[j], rank[j] = False, NEVER
        after[i], before[end] = after[j], best
        rank[i], rank[h] = pair(new, part[end])[0], pair(part[h], new)[0]
    return t["ids"][parts[live]], live.sum(axis=1)


def encode_new(chunks, t: dict | None, one):
    """The different chunks in some order, their ids one after the other, and how many each has. `one` encodes those that
    can't be merged side by side: long ones, and those with characters that have no piece."""
    fresh = sorted(set(chunks), key=len)
    near = [c for c in fresh if len(c) <= LATTICE_CHARS] if t else []
    if near:
        n = np.fromiter(map(len, near), np.int64, len(near))
        odd = np.logical_or.reduceat(t["ids"][numbers_of(near, t)] < 0, np.cumsum(n) - n)
        if odd.any():
            near = [c for c, o in zip(near, odd.tolist()) if not o]
    values, lengths, at = [], [], 0
    while at < len(near):  # of about the same length, so that little of a rectangle is empty
        to = min(len(near), at + CELLS // (len(near[at]) + 2))
        to = min(to, at + CELLS // (len(near[to - 1]) + 2))
        ids, n = merge_rows(near[at:to], t)
        values.append(ids)
        lengths.append(n)
        at = to
    if len(near) < len(fresh):
        done = set(near)
        far = [c for c in fresh if c not in done]
        got = [one(c) for c in far]
        values.append(np.array([i for ids in got for i in ids], np.int32))
        lengths.append(np.fromiter(map(len, got), np.int64, len(got)))
        near = near + far
    return near, values, lengths


def encode_batches(shared, model, id_type):
    find = re.compile(model.cut).findall

    def run(batches):
        v, kept = shared.value, lru_cache(CACHED)(model.encode_chunk)
        one = lambda chunk: kept(chunk) if len(chunk) <= CACHED_CHARS else model.encode_chunk(chunk)
        if "codes" not in v:  # one dictionary for all tasks of a worker
            table = v.pop("table")
            ids = table.column("ids").combine_chunks()
            v["codes"] = {c: k for k, c in enumerate(table.column("chunk").to_pylist())}
            v["values"], v["lengths"] = ids.flatten().to_numpy().astype(np.int32), np.diff(ids.offsets.to_numpy()).astype(np.int64)
            del table, ids
        code, base = v["codes"].get, len(v["codes"])
        for batch in (whole.slice(at, ENCODED) for whole in batches for at in range(0, whole.num_rows, ENCODED)):
            parts, sizes, sums, new = [], [], [], []
            for raw in batch.column(1).to_pylist():
                text = raw.decode("utf-8", "replace")
                chunks = find((SPACE if model.dummy_prefix else "") + text.replace(" ", SPACE)) if text else []
                parts.append(np.fromiter(map(code, chunks, repeat(-1)), np.int64, len(chunks)))
                new += [chunks[k] for k in np.flatnonzero(parts[-1] < 0).tolist()]
                sizes.append(len(chunks))
                sums.append(zlib.crc32(text.encode()))
            own = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            fresh, values, lengths = encode_new(new, v["merges"], one)
            rarer = dict(zip(fresh, range(base, base + len(fresh))))
            own[own < 0] = np.fromiter(map(rarer.__getitem__, new), np.int64, len(new))
            values, lengths = np.concatenate([v["values"], *values]), np.concatenate([v["lengths"], *lengths])
            starts = np.cumsum(lengths) - lengths
            n = lengths[own]
            bounds = np.concatenate([[0], np.cumsum(n)])
            got = values[np.repeat(starts[own] - bounds[:-1], n) + np.arange(bounds[-1])]
            bounds = bounds[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
            good = [zlib.crc32(model.decode(got[a:b].tolist()).encode()) == c for a, b, c in zip(bounds[:-1], bounds[1:], sums)]
            ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(got, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(np.diff(bounds)), ids, pa.array(good, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    return run


class PieceCodec:
    def __init__(self, spark: SparkSession, path: str | None = None, model: PieceModel | None = None, dictionary: int = DICTIONARY):
        if model is None:
            if path is None:
                import public_tokenizers

                path = public_tokenizers.path("piece_bpe_32k.model")
            model = PieceModel.load(path)
        self.spark, self.model, self.dictionary = spark, model, dictionary

    def encode(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        """doc_id, n_tokens, ids, round_trip (the ids decode to the text) for each row of docs."""
        scratch, model = Scratch(self.spark, "pieces"), self.model
        source = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text"))
        kind = source.schema["doc_id"].dataType
        counts = source.select("text").mapInArrow(count_chunks(model.cut, model.dummy_prefix), "chunk string, n long")
        counts = scratch.save(counts.groupBy("chunk").agg(F.sum("n").alias("n")), "counts")
        chunks = scratch.save(frequent_chunks(counts, self.dictionary), "frequent")
        table = scratch.save(encode_chunks(chunks, model), "dictionary").toArrow()
        shared = self.spark.sparkContext.broadcast({"table": table.select(["chunk", "ids"]), "merges": merge_tables(model)})
        id_type = to_arrow_type(kind)
        return source.mapInArrow(encode_batches(shared, model, id_type), f"doc_id {kind.simpleString()}, n_tokens long, ids array<int>, round_trip boolean")

    def decode(self, encoded: DataFrame, ids_col="ids"):
        """Text column for a column of ids."""
        model = self.model

        @F.arrow_udf("string")
        def decode(ids: pa.Array) -> pa.Array:
            return pa.array([model.decode(x or []) for x in ids.to_pylist()], pa.string())

        return encoded.withColumn("text", decode(F.col(ids_col)))
