"""Checks of output lists, as a table of violations."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MATCHES, CANDIDATES = ["source1_entity_id", "matched_entity_ids"], ["source1_entity_id", "candidate_entity_ids"]


def header_faults(spark: SparkSession, files: dict) -> DataFrame:
    """(check, s1, rec) for each file whose first line doesn't name the columns. files: path to its columns."""
    found = []
    for path, columns in sorted(files.items()):
        first = spark.read.text(path).limit(1).collect()
        if not first or first[0]["value"].split("\t") != columns:
            found.append(("header", path, first[0]["value"] if first else None))
    return spark.createDataFrame(found, "check string, s1 string, rec string")


def explode_lists(out: DataFrame, column: str) -> DataFrame:
    return out.select(F.col("source1_entity_id").alias("s1"), F.explode(F.split(F.coalesce(column, F.lit("")), ",")).alias("rec")).where("rec <> ''")


def validate(matches: DataFrame, candidates: DataFrame, s1: DataFrame, records: DataFrame | None = None, prefixes=("S2-", "S3-"), s1_prefix="S1-") -> DataFrame:
    """(check, s1, rec): duplicate or unknown entities, entities without a row, wrong prefixes, records named twice or
    under two entities, records that don't exist, and matches that aren't candidates. No rows: the output is valid."""
    none = F.lit(None).cast("string")
    rows = lambda df, name, s, r: df.select(F.lit(name).alias("check"), s.cast("string").alias("s1"), r.cast("string").alias("rec"))
    ids = s1.select(F.col("entity_id").alias("id"))
    own = matches.select(F.col("source1_entity_id").alias("id"))
    pairs, cand = explode_lists(matches, "matched_entity_ids"), explode_lists(candidates, "candidate_entity_ids")
    starts = lambda c, ps: F.lit(False) if not ps else sum((F.startswith(c, F.lit(p)).cast("int") for p in ps), F.lit(0)) > 0
    found = rows(own.groupBy("id").count().where("count > 1"), "duplicate_entity", F.col("id"), none)
    for part in (
        rows(own.join(ids, "id", "left_anti"), "unknown_entity", F.col("id"), none),
        rows(ids.join(own, "id", "left_anti"), "missing_entity", F.col("id"), none),
        rows(own.where(~F.startswith(F.col("id"), F.lit(s1_prefix))), "entity_prefix", F.col("id"), none),
        rows(pairs.where(~starts(F.col("rec"), prefixes)), "record_prefix", F.col("s1"), F.col("rec")),
        rows(pairs.groupBy("s1", "rec").count().where("count > 1"), "repeated_record", F.col("s1"), F.col("rec")),
        rows(pairs.groupBy("rec").agg(F.count_distinct("s1").alias("n"), F.min("s1").alias("s1")).where("n > 1"), "two_owners", F.col("s1"), F.col("rec")),
        rows(pairs.join(cand, ["s1", "rec"], "left_anti"), "not_a_candidate", F.col("s1"), F.col("rec")),
    ):
        found = found.unionByName(part)
    if records is not None:
        known = records.select(F.col("entity_id").alias("rec"))
        found = found.unionByName(rows(pairs.join(known, "rec", "left_anti"), "unknown_record", F.col("s1"), F.col("rec")))
    return found


#: The shares and means between which an output looks as usual.
RANGES = {"empty_share": (0.045, 0.07), "mean_links": (3.2, 3.7), "shared_records": (0, 0)}


def sanity(matches: DataFrame, ranges: dict = RANGES) -> DataFrame:
    """One row: share of empty entities, mean links, records under two entities, and whether each is in its range."""
    sizes = matches.select(F.when(F.coalesce("matched_entity_ids", F.lit("")) == "", 0).otherwise(F.size(F.split("matched_entity_ids", ","))).alias("n"))
    shared = explode_lists(matches, "matched_entity_ids").groupBy("rec").agg(F.count_distinct("s1").alias("k")).where("k > 1").agg(F.count(F.lit(1)))
    row = sizes.agg(F.round(F.avg((F.col("n") == 0).cast("double")), 6).alias("empty_share"), F.round(F.avg("n"), 6).alias("mean_links")).withColumn("shared_records", shared.scalar())
    return row.withColumns({f"{k}_ok": F.col(k).between(*v) for k, v in ranges.items()})
