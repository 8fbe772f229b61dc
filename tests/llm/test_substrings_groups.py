import random

from pyspark.sql import functions as F
from test_substrings import _brute, _run

from quartier.llm import substrings
from quartier.llm.common import NO_ID


def test_rows_without_an_id_spread(spark, monkeypatch):
    """Rows of a null or repeated id do not share one group; results are the same."""
    monkeypatch.setattr(substrings, "GROUP_BYTES", 3000)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefg ") for _ in range(90))
    rows = [(None if i % 3 else 5, "".join(rng.choice("hijklmn ") for _ in range(100))
             + passage * (i % 2)) for i in range(60)] + [(1, "x" + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = (docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
              .select("doc_id", substrings.group_of(4).alias("g")).distinct())
    assert {r["count"] for r in groups.filter("doc_id <> 1").groupBy("doc_id").count().collect()} == {4}
    assert _run(docs) == _brute(rows)
