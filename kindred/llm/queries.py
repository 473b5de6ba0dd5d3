"""The ten registered queries: each applies its operator to its whole table and derives the result columns."""

from pyspark.sql import functions as F

from . import decontaminate, hmm, licenses, pieces, pii, quality, secrets, simhash, toxicity, warc
from .common import Scratch, table
from .sql import LICENSE_SQL, WARC_SQL


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_hmm_scoring(spark, sf_dir):
    return hmm.WordHMM().fit_score(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc_archive(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    path = Scratch(spark, "warc").base
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    found = warc.read_archive(spark, path)
    return found.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("record_type") == "revisit", F.col("refers_to").cast(kind)).alias("refers_to"))


def op4_pii(spark, sf_dir):
    found = pii.scan_pii(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    counts = [count_kind(base, i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op5_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    found = secrets.SecretScan().scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE)
    counts = [count_kind(base, i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[: secrets.BASE])]
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return found.select("doc_id", *counts, F.sha2(secrets.told(base), 256).alias("base_sha256"), secrets.told(secrets.reported(F.col("spans"))).alias("spans"), live.alias("n_live"), (F.size("spans") - live).cast("long").alias("n_example"))


def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sentencepiece(spark, sf_dir):
    return pieces.PieceCodec(spark).encode(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_hmm_scoring, op2_quality_rules, op3_warc_archive, op4_pii, op5_license_scan, op6_secret_scan, op7_simhash, op8_toxicity, op9_decontamination, op10_sentencepiece)}
ORACLES = {"op3_warc_archive": WARC_SQL, "op5_license_scan": LICENSE_SQL}
