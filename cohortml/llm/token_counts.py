"""Token counts: batch encoding inside Arrow functions that return lengths only.

The rows of a task are regrouped into batches of about equal bytes, so that very long texts do not
swell a batch; long texts are split at safe boundaries (see :mod:`cohortml.llm.bpe`). Only counts
leave the worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortml.llm.bpe import by_bytes, encoder
from cohortml.llm.common import vocabulary_path, worker_state


def _sentencepiece(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _counter(tokenizer: str):
    """A function from texts to their numbers of tokens."""
    if tokenizer.endswith(".model"):
        sp = worker_state(("sp", tokenizer), lambda: _sentencepiece(vocabulary_path(tokenizer)))
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    enc = encoder(tokenizer)
    return lambda texts: [len(x) >> 2 for x in enc.encode(texts)]


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer``: a ``.json`` file of the tokenizers library or a ``.model`` file of sentencepiece
    (a bare name is one of the public vocabularies). No special tokens are added and nothing is cut
    or padded. A null or empty text has 0 bytes and 0 tokens; repeated rows are counted each; an
    empty table gives an empty one.
    """
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType),
                         StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def count(batches):
        import pyarrow as pa
        counts = _counter(tokenizer)
        for rows in by_bytes(batches, ("doc_id", "n_bytes", "text")):
            ids, sizes, texts = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch_type), pa.array(sizes, pa.int64()), pa.array(counts(list(texts)), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    from pyspark.sql.pandas.types import to_arrow_type
    batch_type = to_arrow_type(docs.schema["doc_id"].dataType)
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                      F.col("text")).mapInArrow(count, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
