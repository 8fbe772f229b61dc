"""A training corpus in five stages over ``documents``.

Each stage reads all that its predecessor kept, as written Parquet, and every
decision takes effect: low-quality documents go, one document of each group of
near copies stays, repeated passages are cut out, contaminated documents go, and
the rest is packed into training windows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartier.llm import decontaminate, jaccard, packing, quality, substrings
from quartier.llm.common import NO_ID, fold, table, with_ids, without_ids, written
from quartier.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies share this many percent of their shingles of so many words
#: (op5's own contract, three words and 90, is the query's).
SHINGLE, PERCENT = 5, 80


def _keyed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """COLUMNS and ``row``, a key that no two rows share, in the order of doc_id
    (null last). Distinct ids are their own keys; if any is null or repeats, the
    rows are sorted, numbered and written, so a rerun finds the same numbers."""
    docs = docs.select(*COLUMNS)
    row = F.col("doc_id").cast("long")
    shared = (docs.groupBy(row.alias("id")).count()
              .filter(F.col("id").isNull() | (F.col("id") == NO_ID) | (F.col("count") > 1)))
    if shared.limit(1).count() == 0:
        return docs.withColumn("row", row)
    # the hash spreads rows of one id over the tasks of the sort
    ordered = docs.orderBy(row.asc_nulls_last(), F.xxhash64(*COLUMNS))
    return written(ordered.withColumn("row", F.monotonically_increasing_id()),
                   scratch_path(spark, "keyed"))


def _by_row(keyed: DataFrame) -> DataFrame:
    """What an operator judges: the row key in the place of the id."""
    return keyed.select(F.col("row").alias("doc_id"), "text")


def _kept(keyed: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows whose keys an operator has returned as doc_id."""
    return with_ids(keyed, judged.select(F.col("doc_id").alias("row")), "row").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Labels are learnt from two
    thirds of the ids, as in the operator's query."""
    keyed = _keyed(spark, docs)
    word_table, net = quality.train(keyed.select(*COLUMNS), table(spark, sf_dir, "labels"),
                                    fold(3) != 1)
    return _kept(keyed, quality.score(_by_row(keyed), word_table, net).filter("score >= 0.5"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the smallest id stays (of rows
    that share it, one); rows that share an id but not the text are no copies."""
    keyed = _keyed(spark, docs)
    copies = (jaccard.join(_by_row(keyed), n=SHINGLE, percent=PERCENT)
              .filter("doc_id <> component_id").select(F.col("doc_id").alias("row")))
    # the fewer rows are what the filter holds: those that go
    return without_ids(keyed, written(copies, scratch_path(spark, "copies")), "row").select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that an earlier row also has (of smaller id, or one of
    several rows of an id) are cut out; a character cut in two becomes U+FFFD.
    Documents left without a word go."""
    keyed = _keyed(spark, docs)
    cut = substrings.remove_repeats(_by_row(keyed)).select(
        F.col("doc_id").alias("row"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
    return (keyed.drop("text", "n_chars").join(cut, "row")
            .filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    keyed = _keyed(spark, docs)
    found = decontaminate.contamination(_by_row(keyed), table(spark, sf_dir, "benchmark"))
    return _kept(keyed, found.filter("not contaminated"))


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows, every token of every document in one."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("lexical_packing", lexical_packing),
]

#: The classifier's network and the packing order are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, scratch_path(spark, name))
    return docs
