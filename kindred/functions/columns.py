"""Column helpers: null-safe arithmetic, stable hashes, token lists."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or the default where b is 0 or null (Spark's ANSI mode would raise)."""
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def logit(p: Column, edge: float = 1e-6) -> Column:
    q = clip(p, edge, 1 - edge)
    return F.log(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def stable_hash(c: Column) -> Column:
    """32 bits of an MD5: the same number in any engine, for splits that must be reproducible."""
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def in_share(c: Column, parts: int, below: int = 1, salt: str = "") -> Column:
    """True for below/parts of all values, by hash."""
    key = F.concat(F.lit(salt), c.cast("string")) if salt else c
    return F.pmod(stable_hash(key), F.lit(parts)) < below


def tristate(a: Column, b: Column) -> Column:
    """1 equal, 0 different, -1 where either side is unknown (null or empty)."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((a == "") | (b == ""), -1).when(a == b, 1).otherwise(0)


def mapped(c: Column, table: dict, default=None) -> Column:
    """Small literal dictionary; values that it lacks stay, or become the default."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), c if default is None else F.lit(default))


def squash(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def words(c: Column) -> Column:
    """Distinct non-empty tokens between single spaces."""
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    return ratio(F.size(F.array_intersect(a, b)), F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def bare_consonants(c: Column) -> Column:
    """Similar sounds as one letter, without vowels and signs."""
    c = F.translate(F.replace(c, F.lit("ph"), F.lit("f")), "cqz", "kks")
    return F.regexp_replace(F.regexp_replace(c, "[aeiouyhw]", ""), "[^a-z0-9 ]", "")


def skeleton(c: Column) -> Column:
    """Consonant skeleton: similar sounds are one letter, vowels and doubled letters go."""
    return F.regexp_replace(bare_consonants(c), r"([bdfgjklmnprstvx])\1+", "$1")


def numeric_columns(df, besides=()) -> list:
    """The columns of a table that a model can read, in their order, without `besides`."""
    return [c for c, kind in df.dtypes if c not in besides and kind.split("(")[0] in ("int", "bigint", "smallint", "tinyint", "float", "double", "decimal", "boolean")]


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return ratio(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
