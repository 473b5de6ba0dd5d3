"""Secret scans with corpus-wide ownership frequency.

Candidates are values that look like credentials. The corpus is asked how many distinct repositories and
owners each value has. Most values have one owner, some have a few by chance; the share with one owner gives
the Poisson rate of chance owners, and a value with so many owners that chance gives less than CHANCE such
values in the whole corpus is a widely copied example. All others are taken for live. Beyond the base
patterns, provider tokens are reported only when they look live.

Defined results: a null or empty text has no spans. A null repository or owner counts as one value of its
own. Repeated rows count once per repository; a value as often owned as the limit is an example. Texts are
searched whole, whatever their length. Without candidates there is nothing to judge. Other columns pass
through untouched, whatever their names.
"""

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_column, ship, utf8

ship(__name__)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Public forms of provider tokens; the literal at the front is looked for first.
PROVIDERS = [
    ("provider", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("provider", ("xox",), re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("provider", ("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}")),
    ("provider", ("AIza",), re.compile(r"AIza[0-9A-Za-z_-]{35}")),
    ("jwt", ("eyJ",), re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")),
    ("pem", ("-----BEGIN ",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")),
]
KINDS = ["assign", "access", "hex", "provider", "jwt", "pem"]
BASE = 3
LEAST_OWNERS = 3  # no value of fewer distinct owners is a widely copied example
CHANCE = 0.01  # expected number of values that reach the limit by chance
SPAN = "struct<kind:int,first:int,last:int,digest:string>"
MASK = "[SECRET]"


def base_spans(text: str) -> list:
    """(kind, start, end, value) of the base patterns, in code points."""
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return found


def more_spans(text: str) -> list:
    found = []
    for kind, fronts, pattern in PROVIDERS:
        if any(x in text for x in fronts):
            found += [(KINDS.index(kind), m.start(), m.end(), m[0]) for m in pattern.finditer(text)]
    return found


@arrow_column(f"array<{SPAN}>")
def find_spans(texts: pa.Array) -> pa.Array:
    rows = []
    for raw in texts.to_pylist():
        text = raw.decode("utf-8", "replace")
        found = sorted(base_spans(text) + more_spans(text), key=lambda x: (x[1], x[0]))
        rows.append([{"kind": k, "first": a, "last": b, "digest": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()} for k, a, b, v in found])
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("digest", pa.string())]))
    return pa.array(rows, kind)


@arrow_column("string")
def mask_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for raw, found in zip(texts.to_pylist(), spans.to_pylist()):
        text, parts, at = raw.decode("utf-8", "replace"), [], 0
        for x in found or []:
            if x["last"] > at:
                parts += [text[at : max(at, x["first"])], MASK if x["first"] >= at else ""]
                at = x["last"]
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def ownership(candidates: DataFrame) -> DataFrame:
    """digest, repositories, owners, rows: aggregated in two steps, so that a value of very many rows is
    a handful of rows per task before anything is shuffled."""
    step = candidates.groupBy("digest", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    return step.groupBy("digest").agg(F.count_distinct("repo").alias("repositories"), F.count_distinct("owner").alias("owners"), F.sum("n").alias("occurrences"))


def owner_limit(values: int, single: int, chance=CHANCE) -> int:
    """Owners from which a value is a widely copied example, where `single` of `values` values have one owner: the
    number of owners beside the first is Poisson by chance, and fewer than `chance` values are to reach the limit."""
    rate = -math.log(max(single, 0.5) / max(values, 1)) if values else 0.0
    k, term, below = 0, math.exp(-rate), 0.0  # below: P(fewer than k further owners)
    while values * (1 - below) > chance and k < 1000:
        below += term
        k += 1
        term *= rate / k
    return max(LEAST_OWNERS, k + 1)


class SecretScan:
    """Finds spans, aggregates ownership over the whole input and judges every span. `example_owners` fixes the limit
    that is otherwise taken from the distribution."""

    def __init__(self, repo_col="source", owner_col="source", example_owners=None):
        self.repo_col, self.owner_col, self.example_owners = repo_col, owner_col, example_owners

    def limit(self, counts: DataFrame) -> int:
        if self.example_owners:
            return self.example_owners
        return owner_limit(*counts.agg(F.count(F.lit(1)), F.count_if(F.col("owners") == 1)).first())

    def owned(self, df: DataFrame) -> list:
        """Columns repo and owner; null is a value of its own."""
        return [F.coalesce(F.col(c).cast("string"), F.lit("\0null")).alias(n) for c, n in ((self.repo_col, "repo"), (self.owner_col, "owner"))]

    def scan(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        """row, doc_id, spans: array of kind, first, last, digest, repositories, owners, live."""
        scratch = Scratch(docs.sparkSession, "secrets")
        rows = docs.select(F.col(id_col).alias("doc_id"), *self.owned(docs), find_spans(utf8(text_col)).alias("spans"))
        rows = scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), "spans")
        each = rows.where(F.size("spans") > 0).select("row", "repo", "owner", F.explode("spans").alias("s")).select("row", "repo", "owner", "s.*")
        # a table of its own: then both sides of the join are plain scans, and Spark can split a hot value
        counts = scratch.save(ownership(each.select("digest", "repo", "owner")), "ownership")
        live = (F.col("owners") < self.limit(counts)).alias("live")
        judged = each.select("row", "kind", "first", "last", "digest").join(counts, "digest")
        spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "kind", "last", "digest", "repositories", "owners", live))).alias("spans"))
        kind = spans.schema["spans"].dataType.simpleString()
        without = rows.where(F.size("spans") == 0).select("row", "doc_id", F.array().cast(kind).alias("spans"))
        ids = rows.where(F.size("spans") > 0).select("row", "doc_id")
        return ids.join(spans, "row").select("row", "doc_id", "spans").unionByName(without)


def told(spans, keep=None):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    chosen = F.filter(spans, keep) if keep else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")


def reported(spans):
    """The base spans, and of the others those that look live."""
    return F.filter(spans, lambda s: (s["kind"] < BASE) | s["live"])


def mask_live(docs: DataFrame, **options) -> DataFrame:
    """docs with the live-looking values masked; widely copied examples stay. n_chars, where there is one, follows."""
    scan = SecretScan(**options)
    scratch = Scratch(docs.sparkSession, "mask")
    base = docs.withColumn("__kindred_s", find_spans(utf8("text")))
    # only rows with candidates travel; the texts of all others stay where they are
    hit = scratch.save(base.where(F.size("__kindred_s") > 0).withColumn("__kindred_row", F.monotonically_increasing_id()), "hit")
    each = hit.select(*scan.owned(hit), F.explode("__kindred_s").alias("s"))
    counts = scratch.save(ownership(each.select("s.digest", "repo", "owner")), "ownership")
    examples = counts.where(F.col("owners") >= scan.limit(counts)).select("digest")
    spans = hit.select("__kindred_row", F.explode("__kindred_s").alias("s")).select("__kindred_row", "s.*")
    spans = spans.join(examples.withColumn("known", F.lit(True)), "digest", "left").where(F.col("known").isNull())
    spans = spans.groupBy("__kindred_row").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("__kindred_live"))
    masked = hit.join(spans, "__kindred_row", "left").withColumn("text", F.when(F.col("__kindred_live").isNull(), F.col("text")).otherwise(mask_spans(utf8("text"), F.col("__kindred_live"))))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("__kindred_live").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    rest = base.where(F.size("__kindred_s") == 0)
    return masked.select(docs.columns).unionByName(rest.select(docs.columns))
