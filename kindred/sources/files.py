"""Unquoted tab-separated files, ground truth, output files."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str = ENTITY, limit: int | None = None) -> DataFrame:
    """All columns are strings, quotes are ordinary characters, a missing field is the empty string."""
    rows = spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", True).csv(path).fillna("")
    return rows.limit(limit) if limit else rows


def write_tsv(df: DataFrame, path: str, sort_by: str | None = None) -> None:
    """Unquoted text with a header in each part; sorted parts follow one another."""
    rows = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by) if sort_by else df
    rows.write.mode("overwrite").option("sep", "\t").option("quote", "").option("header", True).option("emptyValue", "").csv(path)


def write_one_tsv(df: DataFrame, path: str, sort_by: str) -> None:
    """One ordered file with one header. Its parts are sorted and written by all tasks; the driver only joins their bytes."""
    spark = df.sparkSession
    parts = f"{path}.parts"
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value")
    df.repartitionByRange(sort_by).sortWithinPartitions(sort_by).select(line).write.mode("overwrite").text(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(parts)
    fs = folder.getFileSystem(conf)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(path), True)
    try:
        out.write(bytearray(("\t".join(df.columns) + "\n").encode()))
        for name in sorted(x.getPath().getName() for x in fs.listStatus(folder)):
            if name.startswith("part-"):
                part = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                part.close()
    finally:
        out.close()
    fs.delete(folder, True)


def write_report(df: DataFrame, path: str) -> None:
    """A small table, such as scores of a few settings, as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_parts(spark: SparkSession, pattern: str, schema: str | None = None) -> DataFrame:
    """Part tables of one schema by a path pattern, as one table."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(pattern)


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1, rec) of comma lists."""
    return truth.select(F.col("source1_entity_id").alias("s1"), F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")).alias("rec")).where("rec <> ''")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def table_or(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path; made and written there first unless it is complete."""
    if not is_complete(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_rule(spark: SparkSession, rule: dict, path: str) -> None:
    """A rule as JSON, on any file system that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(rule, indent=1, sort_keys=True).encode()))
    out.close()


def read_rule(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
