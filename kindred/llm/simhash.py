"""SimHash near-duplicates: a byte-position inverted index with count filtering.

Two 64-bit fingerprints at a distance of 4 or less share at least 4 of their 8 positional bytes. So each
distinct fingerprint is posted under every combination of 4 (position, byte) entries, 70 postings of 32
bits; any pair that the count filter can retain meets in one of them. Within a posting list the shared
positional bytes are tallied, pairs under the guaranteed minimum are left out, and the rest are verified
by their distance. Only a spanning forest of each list is passed on, never all of its pairs.

Posting lists are dealt by range, so one of any length spreads over as many tasks as it fills. A list
that crosses a border is put together again in a second, small pass, and the fingerprints of lists over
LIST_ROWS take an exact way that needs no list: each posts itself under all values within distance 2, and
fingerprints that meet there are at most 4 apart.

Defined results: a null or empty text has fingerprint 0, linked like any other. A null id never becomes a
component's id unless all its ids are null. Repeated rows keep their number; other columns are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_column, ship, utf8

ship(__name__)

SHINGLE = 4
DISTANCE = 4
BYTES = 8
LIST_ROWS = 8192  # fingerprints of a posting list that one task compares
COMBINATIONS = list(combinations(range(BYTES), BYTES - DISTANCE))


def fingerprint(text: bytes, shingle=SHINGLE) -> int:
    """SimHash of one text over XXH64 of its space-joined word shingles, each occurrence counted."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    one = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter((one(line[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(h[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


@arrow_column("long")
def simhash(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64))


def forest(values: np.ndarray, distance=DISTANCE):
    """Spanning edges of the graph of values at most `distance` apart, by search from each unvisited value.
    A pair counts only if it shares the guaranteed number of positional bytes and its distance holds."""
    rest, edges = values, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            x = rest ^ at
            tally = (x.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
            near = (tally >= BYTES - distance) & (np.bitwise_count(x) <= distance)
            if near.any():
                found = rest[near]
                edges += [(at, v) for v in found]
                queue += list(found)
                rest = rest[~near]
    return edges


EDGE = "kind int, slot int, part long, a long, b long"  # kind 0: a link of a and b; 1: a of a list to be put together; 2: a of a list that is too long; 3: that list's name


def _edges(kind, slot, part, a, b):
    as64 = lambda x: pa.array(np.asarray(x, np.uint64).view(np.int64))
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, slot, np.int32)), pa.array(np.full(n, part, np.int64)), as64(a), as64(b)], ["kind", "slot", "part", "a", "b"])


def compare_lists(most, borders):
    """Function over sorted (slot, part, a): compares every posting list it holds whole. With borders, the
    first and last list of a task are passed on, since a neighbour may hold the rest of them."""

    def run(batches):
        slot = part = None
        held, size, over, first = [], 0, False, True

        def close(last):
            """Ends the list that is held."""
            nonlocal held, size, over, first
            if slot is None:  # no list is held yet: the first one is still to come
                return
            values = np.concatenate(held) if held else np.zeros(0, np.uint64)
            done, was_first = over, first
            held, size, over, first = [], 0, False, False
            if done or not len(values):
                return
            if borders and (was_first or last):
                yield _edges(1, slot, part, values, values)
            elif len(values) > 1:
                found = forest(np.unique(values))
                if found:
                    yield _edges(0, 0, 0, [x for x, _ in found], [x for _, x in found])

        for batch in batches:
            if not batch.num_rows:
                continue
            slots, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a = batch.column(2).to_numpy().view(np.uint64)
            starts = np.concatenate([[0], np.flatnonzero((np.diff(slots) != 0) | (np.diff(parts) != 0)) + 1])
            ends = np.concatenate([starts[1:], [len(a)]])
            busy = ends - starts > 1  # a list of one fingerprint inside the batch needs no work
            busy[[0, -1]] = True
            for i in np.flatnonzero(busy).tolist():
                if (slots[starts[i]], parts[starts[i]]) != (slot, part):
                    yield from close(False)
                    slot, part = slots[starts[i]], parts[starts[i]]
                held.append(a[starts[i] : ends[i]])
                size += int(ends[i] - starts[i])
                if size > most:  # too long to hold: what there is goes on at once
                    values = np.concatenate(held)
                    held = []
                    if not over:
                        yield _edges(3, slot, part, [0], [0])
                    over = True
                    yield _edges(2, slot, part, values, values)
        yield from close(True)

    return run


def neighbours(values: np.ndarray):
    """All values within distance 2 of each value: (value, neighbour) arrays of 2081 a value."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    masks = np.concatenate([[np.uint64(0)], bits, bits[i] | bits[j]])
    return np.repeat(values, len(masks)), (values[:, None] ^ masks[None, :]).ravel()


def _post_around(batches):
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(values), 64):
            a, v = neighbours(values[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(v.view(np.int64))], ["a", "v"])


def link_fingerprints(prints: DataFrame, scratch: Scratch, most=LIST_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that span every component of the link graph."""
    bytes_ = [F.shiftright("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(BYTES)]

    def posted(chosen):
        part = F.lit(0).cast("long")
        for p in chosen:
            part = F.shiftleft(part, 8).bitwiseOR(bytes_[p])
        return part

    lists = prints.select("fp", F.posexplode(F.array(*[posted(c) for c in COMBINATIONS])).alias("slot", "part"))
    lists = lists.select("slot", "part", F.col("fp").alias("a"))
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lists.repartitionByRange(n, "slot", "part", "a").sortWithinPartitions("slot", "part", "a")
    first = scratch.save(dealt.mapInArrow(compare_lists(most, True), EDGE), "lists")
    # lists that touch a border: few, and whole again after one shuffle
    too_long = first.where("kind = 3").select("slot", "part").distinct().withColumn("long", F.lit(True))
    pieces = first.where("kind = 1").join(too_long, ["slot", "part"], "left")
    joined = pieces.where("long is null").select("slot", "part", "a").repartition(n, "slot", "part").sortWithinPartitions("slot", "part", "a")
    second = joined.mapInArrow(compare_lists(most, False), EDGE)
    second = scratch.save(second, "borders")
    exact = first.where("kind = 2").select("a").unionByName(pieces.where("long").select("a")).unionByName(second.where("kind = 2").select("a")).distinct()
    around = scratch.save(exact.mapInArrow(_post_around, "a long, v long"), "around")  # read twice below
    least = around.groupBy("v").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("v", "b")
    stars = around.join(least, "v").where("a <> b").select("a", "b").distinct()
    edges = first.where("kind = 0").select("a", "b").unionByName(second.where("kind = 0").select("a", "b")).unionByName(stars)
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node on an edge, root its component's least node: alternating large-star and
    small-star rounds, each written before the next; rounds grow with the logarithm of a component's size."""

    def star(edges, large, name):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        # written, so that both sides of the join are plain scans and Spark can split a node of very many edges
        low = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-low")
        near = both.join(low, "a")
        if large:
            near = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            near = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return scratch.save(near.where("a <> b").distinct(), name)

    edges = scratch.save(edges, "edges0")
    mark, turn = None, 0
    while True:
        turn += 1
        edges = star(star(edges, True, f"large{turn}"), False, f"small{turn}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        for old in [f"{size}{turn - 1}{end}" for size in ("large", "small") for end in ("", "-low")] if turn > 1 else []:
            scratch.drop(old)
        if now == mark:
            break
        mark = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", most=LIST_ROWS) -> DataFrame:
    """row, doc_id, fp (signed 64 bits), component_id for each row of docs; least_row is the component's
    first row in order of (id, row), nulls last."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = docs.select(F.col(id_col).alias("doc_id"), simhash(utf8(text_col)).alias("fp"))
    rows = scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    classes = scratch.save(rows.groupBy("fp").agg(F.min(place).alias("first")), "classes")
    roots = scratch.save(components(link_fingerprints(classes.select("fp"), scratch, most), scratch), "roots")
    # written, so that a component or fingerprint of very many rows meets a plain scan and Spark can split it
    named = scratch.save(classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "named")
    least = scratch.save(named.groupBy("root").agg(F.min("first").alias("least")), "least")
    told = scratch.save(named.join(least, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("least_row")), "told")
    return rows.join(told, "fp").select("row", "doc_id", "fp", "component_id", "least_row")


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the smallest id, the first of them where it repeats, and one of a
    null id only where all ids are null. All columns are passed on, whatever their names."""
    scratch = Scratch(docs.sparkSession, "dedup")
    numbered = scratch.save(docs.withColumn("__kindred_row", F.monotonically_increasing_id()), "docs")
    found = near_duplicates(numbered.withColumn("__kindred_id", F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "__kindred_row")), id_col="__kindred_id")
    dropped = scratch.save(found.where("row <> least_row").select(F.col("doc_id.__kindred_row").alias("__kindred_row")), "dropped")
    return numbered.join(dropped, "__kindred_row", "left_anti").select(docs.columns)
