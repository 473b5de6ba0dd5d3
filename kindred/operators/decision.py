"""From scored pairs to one owner per record, and to the output lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocking import top


#: Fixed value: p over which a pair is plausible.
PLAUSIBLE = 0.05


def record_table(scored: DataFrame) -> DataFrame:
    """One row per record: best pair, best and second p (0 where there is none), third p, n_plaus: pairs over PLAUSIBLE, label
    and has_addr of the best."""
    ranked = F.row_number().over(W.partitionBy("rec").orderBy(F.desc("p"), "s1"))
    at = lambda c, n: F.max(F.when(F.col("_r") == n, F.col(c)))
    plausible = F.count_if(F.col("p") > PLAUSIBLE).over(W.partitionBy("rec"))
    rows = scored.withColumns({"_r": ranked, "_n": plausible}).where("_r <= 3").groupBy("rec")
    extra = [at(c, 1).alias(a) for c, a in (("label", "label1"), ("has_addr", "has_addr")) if c in scored.columns]
    return rows.agg(at("s1", 1).alias("s1"), at("p", 1).alias("p1"), F.coalesce(at("p", 2), F.lit(0.0)).alias("p2"), F.coalesce(at("p", 3), F.lit(0.0)).alias("p3"), F.max("_n").alias("n_plaus"), *extra)


def accepted(rule: dict, has_addr: Column | None = None, p1: Column | None = None, p2: Column | None = None) -> Column:
    """thr_addr, thr_noaddr, margin and, for records without an address, margin_noaddr."""
    adr = F.col("has_addr") if has_addr is None else has_addr
    p1, p2 = F.col("p1") if p1 is None else p1, F.col("p2") if p2 is None else p2
    threshold = F.when(adr, F.lit(rule["thr_addr"])).otherwise(F.lit(rule["thr_noaddr"]))
    margin = F.when(adr, F.lit(rule["margin"])).otherwise(F.lit(rule.get("margin_noaddr", rule["margin"])))
    return (p1 >= threshold) & (p1 - p2 >= margin)


def decide(rt: DataFrame, rule: dict, rule_unseen: dict | None = None, seen: list | None = None, fallback: float = 0.8) -> DataFrame:
    """The record table with `accept`. Records of a country outside `seen` go by rule_unseen; records whose score came
    from an older model (is_fallback) go by its plain threshold."""
    ok = accepted(rule)
    if rule_unseen:
        ok = F.when(F.col("country").isin(seen or []), ok).otherwise(accepted(rule_unseen))
    if "is_fallback" in rt.columns:
        ok = F.when(F.col("is_fallback"), F.col("p1") >= fallback).otherwise(ok)
    return rt.withColumn("accept", ok)


def assign(scored: DataFrame, threshold: float) -> DataFrame:
    """Best pair of each record, if its p reaches the threshold."""
    return top(scored, "rec", "p", "s1", 1, "_r").where(F.col("p") >= threshold).drop("_r")


def band_pairs(scored: DataFrame, low: float = 0.05, high: float = 0.99, k: int = 2) -> DataFrame:
    """Best k pairs of the records that are uncertain (best p in [low, high)) or have no address."""
    best = F.max("p").over(W.partitionBy("rec"))
    rows = scored.withColumn("_best", best).where(((F.col("_best") >= low) & (F.col("_best") < high)) | ~F.col("has_addr"))
    return top(rows, "rec", "p", "s1", k, "band_rank").drop("_best")


def overlay_scores(new: DataFrame, old: DataFrame) -> DataFrame:
    """Scores of the current model, and where it has none those of an older one, marked is_fallback."""
    both = new.select("rec", "s1", F.col("p").alias("np")).join(old.select("rec", "s1", F.col("p").alias("op")), ["rec", "s1"], "full")
    return both.select("rec", "s1", F.coalesce("np", "op").alias("p"), F.col("np").isNull().alias("is_fallback"))


def replace_rows(old: DataFrame, new: DataFrame, key: str = "rec") -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def owner_lists(pairs: DataFrame, s1: DataFrame, column: str) -> DataFrame:
    """One row per entity of s1: the sorted, comma-joined records; empty where it has none. pairs hold a record once per entity."""
    lists = pairs.groupBy("s1").agg(F.array_join(F.sort_array(F.collect_set(F.col("rec").cast("string"))), ",").alias(column))
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(lists, ids.source1_entity_id == lists.s1, "left").select("source1_entity_id", F.coalesce(column, F.lit("")).alias(column))
