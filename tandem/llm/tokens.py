"""Token counts through a cache keyed by content and tokenizer."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tandem.llm.words import small

CACHE = "digest binary, tokenizer string, n_tokens bigint"
ENCODE_BYTES = 4_000_000


def counter(name: str, model: bytes):
    """Texts to token counts, by the library that the file's ending names; special strings as its default has them."""
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_str(model.decode())
    encoder.no_truncation()
    encoder.no_padding()
    return lambda texts: [len(x.ids) for x in encoder.encode_batch(texts, add_special_tokens=False)]


def read_cache(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_bytes and n_tokens of every whole text; distinct texts unknown to the cache are encoded and added to it.

    Content is normalised only so far as counts allow: null becomes the empty text (0 tokens). The key is the SHA-256 of
    the content and that of the tokenizer's file, so that another version never meets old counts. Equal texts, however
    many, are encoded once; ids may repeat or be null. If two runs add the same text, equal rows result and one is read.
    """
    spark = docs.sparkSession
    model = Path(tokenizer).read_bytes()
    version = hashlib.sha256(model).hexdigest()
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(id).alias("_id"), content.alias("_text"), F.unhex(F.sha2(content, 256)).alias("digest"))
    narrow = keyed.select("_id", "digest", F.octet_length("_text").cast("bigint").alias("n_bytes"))
    known = lambda: read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    first = narrow.groupBy("digest").agg(F.min("_id").alias("_id"))
    missing = first.join(known(), "digest", "left_anti").withColumnsRenamed({"digest": "_digest", "_id": "_first"})
    # The narrow side is built, so the texts stream through the join unsorted.
    wanted = keyed.join(missing.hint("shuffle_hash"), (F.col("digest") == F.col("_digest")) & F.col("_id").eqNullSafe(F.col("_first")))

    def encode(batches):
        # Rows that repeat an id and text meet in one task.
        count, seen = counter(tokenizer, model), set()
        for batch in small(batches):
            digests = batch.column("digest").to_pylist()
            fresh = [k for k, d in enumerate(digests) if not (d in seen or seen.add(d))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            texts, counts, held, size = batch.column("_text").to_pylist(), [], [], 0
            for x in texts:
                held.append(x)
                size += len(x)
                if size >= ENCODE_BYTES:
                    counts += count(held)
                    held, size = [], 0
            counts += count(held) if held else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(texts), pa.string()), pa.array(counts, pa.int64())], ["digest", "tokenizer", "n_tokens"]
            )

    wanted.select("_text", "digest").mapInArrow(encode, CACHE).write.mode("append").parquet(cache)
    counted = known().withColumnRenamed("digest", "_digest")
    joined = narrow.join(counted, F.col("digest") == F.col("_digest"), "left")
    return joined.select(F.col("_id").alias(id), "n_bytes", "n_tokens")
