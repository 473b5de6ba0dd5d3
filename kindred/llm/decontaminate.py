"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet in a join on hashed seeds, windows of MIN_TILE tokens. For every pair
that shares enough of them, the longest matches of tokens not yet marked are marked again and again, found
by running Karp-Rabin hashes, down to tiles of MIN_TILE tokens; an item whose marked share reaches the
threshold is contained, in whatever order its passages stand.

The join keeps what moves small. A bit field of bounded size, two bits a seed, is the only thing that every
task holds of the benchmark; documents none of whose windows are in it travel no further. Tiles of at least
MIN_TILE tokens that cover the share of an item hold a known number of its windows, so a pair with fewer is
left out unread; as many of an item's most frequent windows as that number allows stay out of the join, so
a passage that very many documents share joins only where nothing rarer tells the item.

Tokens are runs of characters other than ASCII punctuation and white space, with A-Z in lower case.

Defined results: null and empty texts contain nothing. An item of fewer than MIN_TILE tokens can't be told
from chance inside a text: it is contained in the texts that are exactly its tokens; an item without tokens
is in none. With no items nothing is contaminated. Items that repeat are reported each. Among items of equal
coverage the smallest id is named, and a null id only where there is no other. Repeated rows are searched each for themselves;
other columns are ignored, `keep_clean` passes them on, whatever their names. Texts are searched whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, ship, utf8

ship(__name__)

MIN_TILE = 5
COVERAGE = 0.5  # marked share of an item's tokens from which a document contains it
FIELD_BITS = (20, 27)  # logarithms of the least and most bits of the field
BITS_A_SEED = 512  # bits of the field for each seed, within those bounds
BLOCK = 1 << 18  # bytes of text whose windows are hashed at once
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: bytes) -> list:
    return text.translate(KEEP).split()


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the differences of hashes over all their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Token hashes of many texts at once, from running sums over their bytes."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def tokens(self, plain: bytes):
        """(hash, start) of every token of bytes that KEEP has translated."""
        line = np.frombuffer(b" " + plain + b" ", np.uint8)
        if len(line) > len(self.up):
            self.up, self.down = powers(BASE, 2 * len(line)), powers(BACK, 2 * len(line))
        inside = line != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2] + 1, edges[1::2] + 1
        sums = np.cumsum(line * self.up[: len(line)], dtype=np.uint64)
        h = (sums[end - 1] - sums[start - 1]) * self.down[start]
        return mixed(h + (end - start).astype(np.uint64)), start - 1

    def blocks(self, texts):
        """Token hashes of the texts, in lists of arrays: short texts many at once, long ones in pieces that end between tokens."""
        held, n = [], 0
        for text in texts:
            plain = text.translate(KEEP)
            if len(plain) > BLOCK or n > BLOCK:
                yield from self.block(held)
                held, n = [], 0
            if len(plain) > BLOCK:
                parts, at = [], 0
                while at < len(plain):
                    cut = plain.rfind(b" ", at, at + BLOCK)
                    cut = cut if cut >= at else plain.find(b" ", at + BLOCK)
                    cut = cut if cut >= 0 else len(plain)
                    parts.append(self.tokens(plain[at:cut])[0])
                    at = cut + 1
                yield np.concatenate(parts)
            else:
                held.append(plain)
                n += len(plain) + 1
        yield from self.block(held)

    def block(self, held):
        if held:
            h, at = self.tokens(b" ".join(held))
            first = np.searchsorted(at, np.cumsum([0, *[len(t) + 1 for t in held]])).tolist()
            yield from (h[a:b] for a, b in zip(first, first[1:]))

    def seeds(self, texts, least=MIN_TILE):
        """The hashes of all windows of `least` tokens, an array for each text; a text of fewer tokens has one hash of its
        own, one without tokens none."""
        weights = powers(BASE, least)
        for h in self.blocks(texts):
            n = len(h) - least + 1
            if n > 0:
                windows = np.zeros(n, np.uint64)
                for d in range(least):
                    windows += h[d : d + n] * weights[d]
                yield mixed(windows)
            else:
                yield whole(h) if len(h) else h


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a text of few tokens, apart from all windows."""
    return mixed((h * powers(BASE ^ 0xFF, len(h))).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))


# ---------------------------------------------------------------- tiles of one pair


class Running:
    """Karp-Rabin hashes of all windows of any length, modulo 2^64, from running sums."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.up, self.down = powers(BASE, self.n + 1), powers(BACK, self.n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(ids) * self.up[:-1], dtype=np.uint64)])

    def windows(self, length: int, free: np.ndarray):
        """(hashes, starts) of the windows without a marked token."""
        if length > self.n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        blocked = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(blocked[length:] == blocked[:-length])
        return (self.sums[at + length] - self.sums[at]) * self.down[at], at


def greedy_tiles(doc: np.ndarray, item: np.ndarray, least=MIN_TILE) -> list:
    """Tiles (start in item, start in doc, length), longest first; ties go to the earlier place in the item, then in the
    document. doc and item are token numbers, 0 in doc for a token that the item lacks. Each round finds the longest
    length that the free tokens share by bisection and marks its matches in one walk, so that equal tokens in long runs
    cost no more than others."""
    free_doc, free_item = doc > 0, np.ones(len(item), bool)
    d, i = Running(doc), Running(item)
    tiles, most = [], min(len(doc), len(item))

    def shared(length):
        h, at = i.windows(length, free_item)
        other, places = d.windows(length, free_doc)
        mine, theirs = np.isin(h, other), np.isin(other, h)
        return h[mine], at[mine], other[theirs], places[theirs]

    while most >= least and len(shared(least)[0]):
        low, high = least, most
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if len(shared(mid)[0]) else (low, mid - 1)
        length = low
        h, at, other, places = shared(length)
        order = np.argsort(other, kind="stable")
        other, places = other[order], places[order]
        begin, end = np.searchsorted(other, h).tolist(), np.searchsorted(other, h, "right").tolist()
        next_of = {}  # of equal windows of the document, the first that may still be free
        for a, lo, hi in zip(at.tolist(), begin, end):
            if not (free_item[a] and free_item[a + length - 1]):
                continue  # of windows of one length, an overlapping tile covers an end
            k = next_of.get(lo, lo)
            while k < hi:
                j = int(places[k])
                if free_doc[j] and free_doc[j + length - 1]:
                    if (doc[j : j + length] == item[a : a + length]).all():
                        free_item[a : a + length] = free_doc[j : j + length] = False
                        tiles.append((a, j, length))
                        k += 1
                    break  # else equal hashes of other tokens: no match here
                k += 1
            next_of[lo] = k
        most = length - 1
    return tiles


def numbered(doc: list, item: list):
    """Both token lists as numbers of the item's tokens."""
    ids = {}
    own = np.array([ids.setdefault(t, len(ids) + 1) for t in item], np.uint64)
    return np.array([ids.get(t, 0) for t in doc], np.uint64), own


def verdict(doc: list, item: list, least=MIN_TILE):
    """(coverage, tiles, matched tokens) of an item in a document."""
    if len(item) < least:
        same = bool(item) and doc == item
        return float(same), int(same), len(item) if same else 0
    found = greedy_tiles(*numbered(doc, item), least)
    matched = sum(k for _, _, k in found)
    return matched / len(item), len(found), matched


# ---------------------------------------------------------------- the join


def seed_columns(text, least, field=None):
    """Column: array of the hashed seeds of a text; with a bit field only those in it, each once."""

    @F.arrow_udf("array<long>")
    def seeds(texts: pa.Array) -> pa.Array:
        found = Hasher().seeds(texts.to_pylist(), least)
        if field is not None:
            bits, size = field.value
            found = (np.unique(h[probe(bits, size, h)]) for h in found)
        found = list(found)
        bounds = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)))

    return seeds.asNondeterministic()(text)  # so that a filter on the seeds doesn't compute them a second time


def places_of(h: np.ndarray, size: int) -> list:
    """The two bits of each hash in a field of 2^size bits."""
    return [h >> np.uint64(64 - size), (h * np.uint64(BASE)) >> np.uint64(64 - size)]


def probe(bits: np.ndarray, size: int, h: np.ndarray) -> np.ndarray:
    may = np.ones(len(h), bool)
    for at in places_of(h, size):
        may &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return may


def bit_field(seeds: DataFrame):
    """(bytes, size) of a Bloom filter of the column `seed`: as large as the number of seeds needs, within FIELD_BITS.
    Tasks set bits in pieces of 64, which are joined before anything reaches the driver."""
    n = seeds.count()
    size = int(np.clip(np.ceil(np.log2(max(n, 1) * BITS_A_SEED)), *FIELD_BITS))

    def words(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            at = np.concatenate(places_of(h, size))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "bits"])

    got = seeds.select("seed").mapInArrow(words, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    field = np.zeros(1 << (size - 6), np.uint64)
    field[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return field.view(np.uint8), size


def needed_seeds(n_tokens, least, coverage):
    """Windows of an item that tiles of at least `least` tokens over the share of its tokens hold: one for each `least`
    tokens at least. 1 for an item of few tokens."""
    return F.greatest(F.lit(1), F.ceil(F.col(n_tokens) * coverage / least - 1e-9)).cast("long")


class Tiling:
    """A benchmark, ready for documents."""

    def __init__(self, benchmark: DataFrame, least=MIN_TILE, coverage=COVERAGE, id_col="item_id", text_col="text"):
        spark = benchmark.sparkSession
        self.scratch, self.least, self.coverage = Scratch(spark, "tiles"), least, coverage
        own = benchmark.select(F.col(id_col).cast("long").alias("item_id"), utf8(text_col).alias("item_text"))
        own = own.withColumns({"seeds": seed_columns(F.col("item_text"), least), "item": F.monotonically_increasing_id()})
        self.items = self.scratch.save(own.where(F.size("seeds") > 0), "items")
        # an item of few tokens has one seed, and so has one of `least` tokens: both need that one
        tokens_of = F.when(F.size("seeds") > 1, F.size("seeds") + least - 1).otherwise(F.lit(least))
        each = self.items.select("item", tokens_of.alias("n"), F.explode("seeds").alias("seed"))
        each = each.groupBy("item", "n", "seed").agg(F.count(F.lit(1)).alias("times"))
        self.seeds = self.scratch.save(each.withColumn("need", needed_seeds("n", least, coverage)).drop("n"), "seeds")
        self.field = spark.sparkContext.broadcast(bit_field(self.seeds))

    def near(self, docs: DataFrame) -> DataFrame:
        """docs with `__kindred_seeds`: the seeds of each text that the benchmark may have."""
        return docs.withColumn("__kindred_seeds", seed_columns(utf8("text"), self.least, self.field))

    def hits(self, docs: DataFrame):
        """(rows, hits): the rows of docs that share a seed, with `__kindred_row`, and (row, item_id, coverage, tiles,
        matched) of the items that they contain."""
        rows = self.near(docs).where(F.size("__kindred_seeds") > 0).withColumn("__kindred_row", F.monotonically_increasing_id())
        rows = self.scratch.save(rows, "rows")
        found = rows.select(F.col("__kindred_row").alias("row"), F.explode("__kindred_seeds").alias("seed"))
        seen = found.groupBy("seed").agg(F.count(F.lit(1)).alias("df"))
        # an item's most frequent windows, half as many as a pair may lack, are not joined: the others tell it
        spare = F.floor((F.col("need") - 1) / 2)
        taken = F.sum("times").over(W.partitionBy("item").orderBy(F.desc("df"), "seed"))
        used = self.seeds.join(seen, "seed").withColumn("taken", taken)
        kept = self.scratch.save(used.where(F.col("taken") > spare).select("seed", "item", "times", (F.col("need") - spare).alias("need")), "used")
        pairs = found.join(kept, "seed").groupBy("row", "item").agg(F.sum("times").alias("n"), F.max("need").alias("need")).where("n >= need").select("row", "item")
        pairs = self.scratch.save(pairs, "pairs")
        texts = rows.select(F.col("__kindred_row").alias("row"), utf8("text").alias("doc_text"))
        least, coverage = self.least, self.coverage

        @F.arrow_udf("struct<coverage:double,tiles:int,matched:int>")
        def compare(docs: pa.Array, items: pa.Array) -> pa.Array:
            got = [verdict(tokens(d), tokens(i), least) for d, i in zip(docs.to_pylist(), items.to_pylist())]
            parts = zip(*got) if got else ([], [], [])
            return pa.StructArray.from_arrays([pa.array(list(x), t) for x, t in zip(parts, (pa.float64(), pa.int32(), pa.int32()))], ["coverage", "tiles", "matched"])

        met = pairs.join(self.items.select("item", "item_id", "item_text"), "item").join(texts, "row")
        told = met.select("row", "item_id", compare("doc_text", "item_text").alias("v")).select("row", "item_id", "v.*")
        return rows, self.scratch.save(told.where((F.col("coverage") >= coverage) & (F.col("matched") > 0)), "hits")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document: doc_id, contaminated, n_items, the item of the largest coverage
    (ties: the smallest id), its coverage and tiles, and the ids of all contained items."""
    rows, hits = Tiling(benchmark, **options).hits(docs.select("doc_id", "text"))
    order = F.struct((-F.col("coverage")).alias("c"), F.col("item_id").isNull().alias("unknown"), "item_id", "tiles")
    best = hits.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.min(order).alias("best"), F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    rows = rows.select(F.col("__kindred_row").alias("row"), "doc_id").join(best, "row")
    return rows.select("doc_id", F.lit(True).alias("contaminated"), "n_items", F.col("best.item_id").alias("item_id"), (-F.col("best.c")).alias("coverage"), F.col("best.tiles").cast("long").alias("n_tiles"), "item_ids")


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that contain no item, with all their columns. Rows without a shared seed stay where they are."""
    tiling = Tiling(benchmark, **options)
    rows, hits = tiling.hits(docs)
    clean = rows.join(hits.select(F.col("row").alias("__kindred_row")).distinct(), "__kindred_row", "left_anti")
    rest = tiling.near(docs).where(F.size("__kindred_seeds") == 0)
    return clean.select(docs.columns).unionByName(rest.select(docs.columns))
