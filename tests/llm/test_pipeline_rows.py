import random

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
                    for _ in range(n))


def _stage(spark, name, rows):
    """The sources of the rows that a stage keeps, and their texts."""
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs.repartition(3), SF).collect()
    assert len({r["source"] for r in out}) == len(out)
    return {r["source"]: r["text"] for r in out}


def test_near_copies_of_rows_without_an_id(spark):
    """Clean rows of a null or repeated id stay, near copies among them go."""
    a, b, c = (_prose(s) for s in (1, 2, 3))
    rows = [(None, a, "a"), (None, b, "b"), (None, None, "null text"), (None, a + " more", "near a"),
            (7, c, "c"), (7, _prose(4), "other text of 7"), (7, c, "copy of c"),
            (None, c + " tail", "near c"), (9, _prose(5), "single")]
    got = set(_stage(spark, "ngram_jaccard_join", rows))
    assert len(got & {"c", "copy of c"}) == 1 and len(got & {"a", "near a"}) == 1
    assert got - {"c", "copy of c", "a", "near a"} == {"b", "null text", "other text of 7", "single"}


def test_contaminated_rows_without_an_id(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
                if len((r["text"] or "").split()) >= 10)
    bad = _prose(6) + " " + item + " " + _prose(7)
    rows = [(None, bad, "bad"), (None, _prose(8), "good"), (None, _prose(9), "good 2"),
            (5, bad, "bad 5"), (5, _prose(10), "good 5")]
    assert set(_stage(spark, "benchmark_decontamination", rows)) == {"good", "good 2", "good 5"}


def test_repeats_in_rows_that_share_an_id(spark):
    """Every row comes back once, under its own text; a passage stays in one."""
    p = _prose(11, 30)
    rows = [(3, _prose(12) + p, "x"), (3, _prose(13) + p, "y"), (None, _prose(14) + p, "z"),
            (None, _prose(15), "w")]
    got = _stage(spark, "suffix_array_dedup", rows)
    assert set(got) == {"x", "y", "z", "w"}
    assert sum(p[5:] in t for t in got.values()) == 1 and got["w"] == rows[3][1]
    assert p[5:] in got["x"] + got["y"]


def test_low_quality_rows_without_an_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    stage = dict(corpus_pipeline.STAGES)["quality_classifier"]
    twins = (docs.join(labels, "doc_id").withColumn("source", F.concat(F.lit("twin "), "quality"))
             .withColumn("doc_id", F.lit(None).cast("long")).select(*corpus_pipeline.COLUMNS))
    out = stage(spark, docs.unionByName(twins), SF).filter("doc_id is null")
    kept = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    seen = {r["source"]: r["count"] for r in twins.groupBy("source").count().collect()}
    assert kept.get("twin 0", 0) < 0.3 * seen["twin 0"] and kept["twin 1"] > 0.9 * seen["twin 1"]
