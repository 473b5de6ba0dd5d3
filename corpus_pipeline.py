"""From raw documents to encoded training text: each stage works on all that the one before it kept."""

from kindred.llm import decontaminate, pieces, quality, secrets, simhash
from kindred.llm.common import Scratch, table


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go."""
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near-duplicates the document of the smallest id stays."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that contain a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs, sf_dir):
    """Live-looking credentials are masked; widely copied examples and all documents stay."""
    return secrets.mask_live(docs)


def sentencepiece(spark, docs, sf_dir):
    """doc_id, n_tokens, ids and whether they decode to the text."""
    return pieces.PieceCodec(spark).encode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding", sentencepiece),
]

#: No stage but the fourth can be told in SQL: the first sums hashed n-grams of a fitted model, the second is
#: a graph's components, the third a greedy search, the last a fold over a lattice. Tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
