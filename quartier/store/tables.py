"""The store: batches that a stream has committed, and published tables.

A micro-batch writes its outputs under ``batches/run=R/batch_id=N`` and then one
file under ``commits``, numbered in order; without that file nothing of it
counts. (Landed lines, late readings and closed minutes lie
apart and stay for good.) Published tables are partitioned by metric and day. A publication writes
new folders only and then one manifest that names the folders of every
partition and the last commit it has merged; readers take the newest manifest, so
they see all of a publication or none, and a reader of an older one keeps its
files until ``vacuum``. One publisher runs at a time; a second one fails when it
finds its manifest's number taken.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rollup
from ..operators.points import POINT_COLUMNS
from ..schema import DATAPOINT, READING
from ..session import setting
from .files import Files

_POINT = list(DATAPOINT.fields[1:])       # metric is a partition column
_ROW = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("t", T.TimestampType()),
                     T.StructField("m", T.IntegerType()), T.StructField("r", T.IntegerType())])
_PARTIAL = [T.StructField("bucket", T.TimestampType()), T.StructField("data_id", T.IntegerType()),
            T.StructField("mun", T.IntegerType()), T.StructField("room_id", T.IntegerType()),
            *[T.StructField(c, _ROW) for c in ("first", "mx", "mn")],
            *[T.StructField(c, T.DoubleType()) for c in ("s1", "s2", "s3")],
            T.StructField("c", T.LongType())]
_KEYS = [T.StructField("metric", T.StringType()), T.StructField("day", T.DateType())]
_VERSION = T.StructField("version", T.LongType())

#: Columns of the published tables, metric and day last. ``version``: the commit
#: up to which a row was last computed.
TABLES = {
    "raw": T.StructType(_POINT + _KEYS),
    "partials_1m": T.StructType([*_PARTIAL, _VERSION, *_KEYS]),
    "partials_1h": T.StructType([*_PARTIAL, _VERSION, *_KEYS]),
    "partials_1d": T.StructType([*_PARTIAL, _VERSION, *_KEYS]),
    "rollup": T.StructType([T.StructField("bucket", T.TimestampNTZType()),
                            T.StructField("level", T.StringType()), *_POINT, *_KEYS]),
    "frequent": T.StructType([T.StructField("window_start", T.TimestampNTZType()),
                              T.StructField("timestamp", T.LongType()),
                              T.StructField("value", T.DoubleType()),
                              T.StructField("city", T.StringType()), *_KEYS]),
    "panes": T.StructType([T.StructField("pane", T.LongType()),
                           T.StructField("temperature", T.DoubleType()),
                           T.StructField("n", T.LongType()), *_KEYS]),
}
#: Outputs of a batch that are read again: plain files (a batch is small) of
#: these columns and the batch's ``seq``.
BATCH_TABLES = {
    "raw": TABLES["raw"],
    "partials": T.StructType(_PARTIAL + _KEYS),
    "panes": TABLES["panes"],
    "frequent": TABLES["frequent"],
    "ontime": T.StructType(_PARTIAL + _KEYS),
}
#: Outputs of batches that are kept for good, under a folder of their own.
LASTING = {
    "landing": T.StructType([T.StructField("value", T.StringType()),
                             T.StructField("dt", T.StringType())]),
    "late": READING,
    "closed": T.StructType(_PARTIAL + _KEYS),
}

#: A publication writes a small file per metric and day: what AQE joins into one
#: writing task is bounded so that few bytes in many files still have many tasks.
_WRITER = ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
#: Task commits move the files, not the driver one after the other: nothing refers
#: to a folder before its manifest, so half a folder is never seen.
_COMMITTER = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
#: Folders are listed by some tasks per core, not by one task per folder.
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

Part = tuple[str, str]        # metric, ISO day


@dataclass
class Commit:
    """One committed batch. ``parts``: its (metric, day)s; ``outputs``: the
    outputs that hold files; ``last``: its largest reading time (epoch s)."""
    seq: int
    run: str
    batch_id: int
    outputs: list[str]
    parts: list[list[str]]
    last: int | None = None
    watermark: int | None = None

    @property
    def folder(self) -> str:
        return f"batches/run={self.run}/batch_id={self.batch_id}"

    def path(self, output: str) -> str:
        if output in LASTING:
            return f"{output}/run={self.run}/batch_id={self.batch_id}"
        return f"{self.folder}/{output}"


@dataclass
class Manifest:
    """``tables``: table -> {"metric/day": folders}; ``merged``: last commit in it;
    ``done``: last merged batch of each run; ``last``: largest reading time."""
    version: int = 0
    merged: int = 0
    done: dict[str, int] = field(default_factory=dict)
    last: int | None = None
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.files = Files(spark, self.base)

    # -- commits of batches -------------------------------------------------------

    def commits(self, after: int = 0) -> list[Commit]:
        """Committed batches later than commit ``after``, in order."""
        out = []
        for n in self.files.names("commits"):
            if int(n.split("-")[0]) > after:
                out.append(Commit(**json.loads(self.files.read(f"commits/{n}"))))
        return out

    def committed(self, run: str, batch_id: int) -> bool:
        end = f"-{run}-{batch_id}.json"
        return (any(n.endswith(end) for n in self.files.names("commits"))
                or batch_id <= self.manifest().done.get(run, -1))

    def commit(self, c: Commit) -> None:
        self.files.create(f"commits/{c.seq:012d}-{c.run}-{c.batch_id}.json", json.dumps(c.__dict__))

    def next_seq(self) -> int:
        names = self.files.names("commits")
        return 1 + max([self.manifest().merged] + [int(n.split("-")[0]) for n in names[-1:]])

    def batch_rows(self, commits: Iterable[Commit], output: str,
                   parts: set[Part] | None = None) -> DataFrame:
        """Rows of one output of several batches, with their ``seq``; with
        ``parts`` only of these (metric, day)s, and only batches that hold some."""
        schema = T.StructType([*BATCH_TABLES[output], T.StructField("seq", T.LongType())])
        paths = [f"{self.base}/{c.path(output)}" for c in commits if output in c.outputs
                 and (parts is None or any((m, d) in parts for m, d in c.parts))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(*paths)
        if parts is not None:
            df = df.filter(F.col("metric").isin(sorted({m for m, _ in parts}))
                           & F.col("day").isin([date.fromisoformat(d) for d in
                                                sorted({d for _, d in parts})]))
        return df

    def lasting(self, output: str) -> DataFrame:
        """All rows of an output that is kept for good, with ``run`` and
        ``batch_id``. Batches commit in order, so of each run only the one after
        its last commit may be in work; its rows are left out."""
        done = dict(self.manifest().done)
        for c in self.commits():
            done[c.run] = max(done.get(c.run, -1), c.batch_id)
        schema = T.StructType([*LASTING[output], T.StructField("run", T.StringType()),
                               T.StructField("batch_id", T.LongType())])
        if not self.files.names(output):
            return self.spark.createDataFrame([], schema)
        fmt = "text" if output == "landing" else "parquet"
        rows = self.spark.read.schema(schema).format(fmt).load(f"{self.base}/{output}")
        counts = F.lit(False)
        for run, last in done.items():
            counts = counts | ((F.col("run") == run) & (F.col("batch_id") <= last))
        return rows.filter(counts)

    # -- published tables --------------------------------------------------------------

    def manifest(self) -> Manifest:
        names = self.files.names("manifests")
        return Manifest(**json.loads(self.files.read(f"manifests/{names[-1]}"))) if names \
            else Manifest()

    def put(self, m: Manifest) -> None:
        """Make ``m`` the newest manifest (its number must be free)."""
        self.files.create(f"manifests/{m.version:012d}.json", json.dumps(m.__dict__))

    def partitions(self, folder: str) -> set[Part]:
        """The (metric, day)s that a written folder holds."""
        return {(m.split("=")[1], d.split("=")[1]) for m in self.files.names(folder) if "=" in m
                for d in self.files.names(f"{folder}/{m}") if "=" in d}

    def write(self, df: DataFrame, table: str, order: list[str]) -> str:
        """Rows as a new folder of ``table``, clustered by partition (AQE splits
        a hot one over tasks), each file sorted by ``order`` so that a range of
        it reads few row groups. Nothing refers to the folder yet."""
        folder = f"tables/{table}/v={uuid.uuid4().hex[:16]}"
        cols = [f.name for f in TABLES[table]]
        with setting(self.spark, *_WRITER):
            (df.select(*cols).hint("rebalance", "metric", "day")
             .sortWithinPartitions("metric", "day", *order)
             .write.option(*_COMMITTER).partitionBy("metric", "day")
             .parquet(f"{self.base}/{folder}"))
        return folder

    def read(self, table: str, metric: str | None = None, first: date | None = None,
             last: date | None = None, parts: set[Part] | None = None,
             manifest: Manifest | None = None) -> DataFrame:
        """Rows of a published table. Bounds pick partitions from the manifest,
        so other folders are not even listed, and stand in the plan as filters
        of the partition columns."""
        m = manifest or self.manifest()
        paths = []
        for key, folders in m.tables.get(table, {}).items():
            name, day = key.split("/")
            if (parts is not None and (name, day) not in parts) \
                    or (metric is not None and name != metric) \
                    or (first is not None and day < first.isoformat()) \
                    or (last is not None and day > last.isoformat()):
                continue
            paths += [f"{self.base}/{f}/metric={name}/day={day}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], TABLES[table])
        with setting(self.spark, _LISTING, str(4 * self.spark.sparkContext.defaultParallelism)):
            df = (self.spark.read.schema(TABLES[table])
                  .option("basePath", f"{self.base}/tables/{table}").parquet(*paths).drop("v"))
        if metric is not None:
            df = df.filter(F.col("metric") == metric)
        if first is not None:
            df = df.filter(F.col("day") >= F.lit(first))
        if last is not None:
            df = df.filter(F.col("day") <= F.lit(last))
        return df

    def points(self, kinds: Iterable[str] = ("raw", "rollup")) -> DataFrame:
        """The serving view: raw and roll-up points of the newest manifest."""
        m = self.manifest()
        out = None
        for k in kinds:
            df = self.read(k, manifest=m).select(*POINT_COLUMNS)
            out = df if out is None else out.unionByName(df)
        return out


def with_day(df: DataFrame, seconds: str) -> DataFrame:
    return df.withColumn("day", F.to_date(F.timestamp_seconds(seconds)))


def keyed_partials(part: DataFrame) -> DataFrame:
    """Partials with the metric and day that they are filed under."""
    return (part.withColumn("metric", rollup.metric_name("data_id"))
            .withColumn("day", F.to_date("bucket")))


def keyed_panes(panes: DataFrame) -> DataFrame:
    return with_day(panes, "pane").withColumn("metric", F.lit("temperature"))
