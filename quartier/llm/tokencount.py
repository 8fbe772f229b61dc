"""Token counts through a digest cache.

The key of a count is (digest of the normalised text, digest of the tokenizer
file). Documents are joined to the stored counts, only distinct misses are
encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import texts, without_ids, written

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"

# White space as the tokenizer's pattern sees it.
_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space belongs to the word after it: the pattern of the tokenizer never
#: matches across a step from another character to white space.
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: A plain word and the punctuation after it are matched separately.
_PLAIN = re.compile(r"( ?[A-Za-z]+)([.,:;!?]+)")
#: Remembered pieces per worker; beyond it the memory starts afresh.
MEMORY = 600_000


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Counter:
    """Token counts of texts, remembering the counts of their pieces.

    Texts that hold the string of an added token, and tokenizers other than
    byte-level BPE without a normaliser, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.sentence = None
        if path.endswith(".model"):
            import sentencepiece
            self.sentence = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        pre = self.tok.pre_tokenizer
        self.pieces = (self.tok.normalizer is None and isinstance(pre, ByteLevel)
                       and not pre.add_prefix_space)
        self.known: dict[str, int] = {}

    def _lengths(self, items: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(items, add_special_tokens=False)]

    def count(self, batch: list[str]) -> list[int]:
        if self.sentence is not None:
            return [len(x) for x in self.sentence.encode(batch, num_threads=1)]
        if not self.pieces:
            return self._lengths(batch)
        out = [0] * len(batch)
        whole = [i for i, t in enumerate(batch) if self.added and self.added.search(t)]
        for i, n in zip(whole, self._lengths([batch[i] for i in whole])):
            out[i] = n
        skip = set(whole)
        found = [[] if i in skip else _PIECE.findall(t) for i, t in enumerate(batch)]
        if len(self.known) > MEMORY:
            self.known.clear()
        known = self.known
        new = set().union(*found).difference(known)
        split = {u: m.groups() for u in new if (m := _PLAIN.fullmatch(u))}
        ask = {u for u in new if u not in split}
        for pair in split.values():
            ask.update(u for u in pair if u not in known)
        ask = list(ask)
        known.update(zip(ask, self._lengths(ask)))
        for u, (a, b) in split.items():
            known[u] = known[a] + known[b]
        for i, ps in enumerate(found):
            if i not in skip:
                out[i] = sum(map(known.__getitem__, ps))
        return out


def encode_misses(misses: DataFrame, path: str) -> DataFrame:
    """(digest, text) -> CACHE_SCHEMA rows, encoded in Arrow batches."""
    version = tokenizer_version(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(path)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at:at + 500]
                yield pd.DataFrame({"digest": part["digest"], "tokenizer": version,
                                    "n_tokens": counter.count(part["text"].tolist())})

    return misses.mapInPandas(run, CACHE_SCHEMA)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of a tokenizer version; an absent cache is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    # A repeated append (after a lost driver) may store a count twice.
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache)
            .filter(F.col("tokenizer") == version).dropDuplicates(["digest"]))


def count_tokens(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row.

    The normalised text is the text itself, null as empty (byte-level counts
    depend on every byte). Equal texts share one cache entry, so repeated rows
    and copies are encoded once; empty texts count 0 tokens. A null doc_id
    stays null; an empty table gives an empty result; columns other than doc_id
    and text are ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)
    d = texts(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = written(d.select("doc_id", "digest",
                            F.octet_length("text").cast("long").alias("n_bytes")),
                   scratch_path(spark, "digests"))
    # The smallest id of a digest stands for all of its rows.
    asked = (rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .join(read_cache(spark, cache, version).select("digest"), "digest", "left_anti"))
    repeated = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if repeated.limit(1).count() == 0:
        copies = rows.join(asked, ["digest", "doc_id"], "left_anti").select("doc_id")
        misses = without_ids(d, copies)
    else:  # ids do not tell the rows apart
        misses = (d.join(asked.select("digest"), "digest", "left_semi")
                  .groupBy("digest").agg(F.min("text").alias("text")))
    encode_misses(misses.select("digest", "text"), path).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, version).select("digest", "n_tokens")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
