"""Token counts of whole texts by byte-pair merging; no identifiers are made."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.core import small_batches, worker_cache
from vitrine.llm.piece_model import BPE, WordCounts, parse_model


def count_tokens(docs: DataFrame, model_bytes: bytes, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``model_bytes``: content of a SentencePiece BPE model file, sent to the workers. Null counts as empty; an empty
    text has no tokens; texts may have any length. Only doc_id and text are read. Pieces never reach over a space into
    the next word (checked when the model is read, else texts are merged whole), so counts of words are reused.
    """
    if parse_model(model_bytes).kind != BPE:
        raise ValueError("byte-pair merging needs a BPE model")
    small_batches(docs.sparkSession)

    def counted(batches):
        import pyarrow as pa

        cache = worker_cache()
        if cache.get("counts_of") != model_bytes:
            cache["counts"], cache["counts_of"] = WordCounts(parse_model(model_bytes)), model_bytes
        total = cache["counts"].total
        for batch in batches:
            n = [total(x) if x else 0 for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return own.mapInArrow(counted, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)
