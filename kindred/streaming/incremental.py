"""Records that arrive over time, linked to a fixed index batch by batch. (The batch operators are the whole of the
model; this only feeds them from a stream.)"""

from pyspark.sql import DataFrame

from ..operators import blocking


def link_stream(records: DataFrame, postings: DataFrame, norms: DataFrame, path: str, checkpoint: str, k: int = 10):
    """Writes (batch, rec, s1, sparse_score, sparse_rank) of each micro-batch under path; a repeated batch overwrites itself."""

    def link(batch: DataFrame, number: int) -> None:
        found = blocking.sparse_search(blocking.blocking_keys(batch), postings, norms, k)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
