"""Token counts through a cache of digests.

The cache is a Parquet folder with a subfolder for each tokenizer, named by the digest of the
tokenizer's file and library version, of (key, n_tokens): the digest of a normalised text and its
count. The normal form is that of the tokenizer's own normaliser, so texts that it makes equal share
a count; a text with one of its special strings is its own normal form, as such strings are looked
for before. Texts whose digest is not in the cache are encoded, one of each normal form, and their
counts are appended; an append that was repeated does no harm.

Nulls: a null text counts as the empty text, which has 0 tokens. Equal texts are encoded once.
An empty table gives an empty result and leaves the cache as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mapped, row_of, written
from .words import slices

CACHE = "key binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer's file and its library's version."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + version.encode()).hexdigest()


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """A function from a list of texts to their token ids, without added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]


def normaliser(path: str) -> Callable[[str], str]:
    """A function from a text to its normal form: texts with one form have one count of tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return model.normalize
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    if model.normalizer is None:
        return lambda text: text
    special = [x.content.lower() for x in model.get_added_tokens_decoder().values()]
    return lambda text: "\0" + text if any(s in text.lower() for s in special) else model.normalizer.normalize_str(text)


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """key and n_tokens of what is stored for a tokenizer's digest, one row per key."""
    try:
        stored = spark.read.schema(CACHE).parquet(f"{cache}/{tokenizer}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.groupBy("key").agg(F.min("n_tokens").alias("n_tokens"))


def _forms(texts: DataFrame, tokenizer: str) -> DataFrame:
    """raw (md5 of the text) and key (digest of its normal form) of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal, seen = normaliser(tokenizer), set()
        for batch in slices(batches, "content"):
            raws, keys = [], []
            for raw, text in zip(batch.column("raw").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if raw not in seen:
                    seen.add(raw)
                    raws.append(raw)
                    keys.append(hashlib.md5(normal(text).encode()).digest())
            yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), pa.array(keys, pa.binary())], ["raw", "key"])

    return mapped(texts, run, "raw binary, key binary").distinct()


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, *, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` (in place of a column of that name); ``tokenizer`` is the path of its file."""
    spark = docs.sparkSession
    digest = tokenizer_digest(tokenizer)
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(row_of(docs, text, "n_tokens"), F.unhex(F.md5(content)).alias("raw"), content.alias("content"))
    forms = written(_forms(keyed.select("raw", "content"), tokenizer), "normal-forms")
    misses = forms.join(read_cache(spark, cache, digest), "key", "left_anti").groupBy("key").agg(F.min("raw").alias("raw"))
    texts = keyed.select("raw", "content").join(misses, "raw").groupBy("raw").agg(F.first("key").alias("key"), F.first("content").alias("content"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer)
        for batch in slices(batches, "content"):
            counts = [len(x) for x in ids(batch.column("content").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64())], ["key", "n_tokens"])

    mapped(texts.select("key", "content"), encode, CACHE).write.mode("append").parquet(f"{cache}/{digest}")
    # a table of its own, so that the join reads both sides straight from a shuffle and can split a hot text's rows
    counts = written(forms.join(read_cache(spark, cache, digest), "key").select("raw", "n_tokens"), "token-counts")
    return keyed.drop("content").join(counts, "raw", "left").select("row.*", "n_tokens")
