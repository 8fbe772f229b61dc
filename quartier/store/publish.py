"""Publication of committed batches, retention, and removal of old files.

``publish`` merges the commits since the last manifest. It reads the partitions
that they touch and no others, and within the hour and day levels it recomputes
only the buckets with new readings: minutes make hours, hours make days.
"""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import bucket_start, epoch_seconds, to_ntz
from ..operators import rollup as ro
from ..schema import FREQ_COUNT_METRIC, FREQ_VALUE_METRIC
from .tables import Commit, Manifest, Part, Store, keyed_panes

#: A raw partition of more folders is rewritten as one.
MAX_FOLDERS = 8
_KEYS = ["bucket", "data_id", "mun", "room_id"]


def publish(store: Store) -> Manifest:
    """Merge all commits that the newest manifest lacks; a no-op if there are
    none. Nothing counts before the manifest is put, so a publication that dies
    half-way is simply done again."""
    m = store.manifest()
    commits = store.commits(m.merged)
    if not commits:
        return m
    seq = commits[-1].seq
    new = Manifest(m.version + 1, seq, dict(m.done), m.last,
                   {t: {k: list(v) for k, v in p.items()} for t, p in m.tables.items()})
    for c in commits:
        new.done[c.run] = max(new.done.get(c.run, -1), c.batch_id)
        if c.last is not None:
            new.last = c.last if new.last is None else max(new.last, c.last)
    parts = {(p[0], p[1]) for c in commits for p in c.parts}
    if parts:
        _raw(store, m, new, commits, parts)
        minutes = _minutes(store, m, new, commits, parts, seq)
        _levels(store, m, new, commits, parts, minutes, seq)
        _panes(store, m, new, commits, parts)
        _frequent(store, m, new, commits)
    store.put(new)
    return new


def _set(store: Store, new: Manifest, table: str, folder: str, parts: set[Part],
         append: bool = False) -> None:
    """File ``folder`` under the partitions it holds rows of; others of
    ``parts`` have none left."""
    entries = new.tables.setdefault(table, {})
    written = store.partitions(folder)
    for name, day in parts:
        key = f"{name}/{day}"
        if (name, day) in written:
            entries[key] = [*entries.get(key, []), folder] if append else [folder]
        elif not append:
            entries.pop(key, None)


def _raw(store: Store, m: Manifest, new: Manifest, commits: list[Commit], parts: set[Part]) -> None:
    """New points are added as one more folder; partitions of many folders are
    rewritten as one."""
    rows = store.batch_rows(commits, "raw")
    _set(store, new, "raw", store.write(rows, "raw", ["timestamp"]), parts, append=True)
    full = {tuple(k.split("/")) for k, v in new.tables["raw"].items() if len(v) > MAX_FOLDERS}
    if full:
        whole = store.read("raw", parts=full, manifest=new)
        _set(store, new, "raw", store.write(whole, "raw", ["timestamp"]), full)


def _minutes(store: Store, m: Manifest, new: Manifest, commits: list[Commit], parts: set[Part],
             seq: int) -> DataFrame:
    """Minute partials and roll-up points of the touched partitions; returns the
    partials as written."""
    fresh = store.batch_rows(commits, "partials").withColumn("version", F.lit(seq).cast("long"))
    old = store.read("partials_1m", parts=parts, manifest=m)
    both = old.select(*fresh.drop("seq").columns).unionByName(fresh.drop("seq"))
    merged = both.groupBy(*_KEYS, "metric", "day").agg(*ro._merge_aggs(ro.OPS),
                                                       F.max("version").alias("version"))
    _set(store, new, "partials_1m", store.write(merged, "partials_1m", ["bucket", "room_id"]), parts)
    minutes = store.read("partials_1m", parts=parts, manifest=new)
    points = ro.rollup_partials(minutes).withColumn("day", F.to_date("bucket"))
    _set(store, new, "rollup", store.write(points, "rollup", ["level", "bucket"]), parts)
    return minutes


def _coarser(finer: DataFrame, unit: str, seq: int) -> DataFrame:
    """Partials of a coarser bucket from finer ones."""
    return (finer.withColumn("bucket", bucket_start("bucket", unit))
            .groupBy(*_KEYS, "metric").agg(*ro._merge_aggs(ro.OPS))
            .withColumn("version", F.lit(seq).cast("long")))


def _levels(store: Store, m: Manifest, new: Manifest, commits: list[Commit], parts: set[Part],
            minutes: DataFrame, seq: int) -> None:
    """Hours from minutes and days from hours, for buckets with new readings
    only; the other rows of a touched partition are carried over as they are."""
    for table, finer, unit, place in (("partials_1h", minutes, "hour", _day),
                                      ("partials_1d", None, "day", _month)):
        if finer is None:
            finer = store.read("partials_1h", parts=parts, manifest=new)
        bucket = bucket_start("bucket", unit)
        dirty = (store.batch_rows(commits, "partials")
                 .select("metric", bucket.alias("b")).distinct())
        touched = {(name, place(day)) for name, day in parts}
        redone = finer.join(dirty, (finer["metric"] == dirty["metric"])
                            & (bucket_start(finer["bucket"], unit) == dirty["b"]), "left_semi")
        redone = _coarser(redone, unit, seq).withColumn("day", _filed(unit))
        old = store.read(table, parts=touched, manifest=m)
        kept = old.join(dirty, (old["metric"] == dirty["metric"]) & (old["bucket"] == dirty["b"]),
                        "left_anti")
        rows = kept.unionByName(redone.select(*kept.columns))
        _set(store, new, table, store.write(rows, table, ["bucket", "room_id"]), touched)


def _day(day: str) -> str:
    return day


def _month(day: str) -> str:
    """Days are few rows each, so they are filed by month."""
    return day[:8] + "01"


def _filed(unit: str) -> Column:
    return F.to_date(F.date_trunc("month", "bucket")) if unit == "day" else F.to_date("bucket")


def _panes(store: Store, m: Manifest, new: Manifest, commits: list[Commit],
           parts: set[Part]) -> None:
    parts = {p for p in parts if p[0] == "temperature"}
    if not parts:
        return
    rows = store.read("panes", parts=parts, manifest=m).unionByName(
        store.batch_rows(commits, "panes").drop("seq"))
    sums = rows.groupBy("pane", "temperature").agg(F.sum("n").alias("n"))
    _set(store, new, "panes", store.write(keyed_panes(sums), "panes", ["pane"]), parts)


def _frequent(store: Store, m: Manifest, new: Manifest, commits: list[Commit]) -> None:
    """Of every window touched since, the points of its last computation replace
    the older ones; other windows of the touched days are carried over."""
    fresh = store.batch_rows(commits, "frequent")
    newest = fresh.groupBy("window_start").agg(F.max("seq").alias("seq"))
    rows = fresh.join(newest, ["window_start", "seq"]).drop("seq")
    days = {r["day"].isoformat() for r in fresh.select("day").distinct().collect()}
    old_days = {k.split("/")[1] for k in m.tables.get("frequent", {})}
    names = (FREQ_VALUE_METRIC, FREQ_COUNT_METRIC)
    # a window's older points may lie in a day in which it has none any more
    edge = {(date.fromisoformat(d) + timedelta(k)).isoformat() for d in days for k in (-1, 0, 1)}
    touched = {(n, d) for n in names for d in (edge & old_days) | days}
    old = store.read("frequent", parts=touched, manifest=m)
    kept = old.join(newest, "window_start", "left_anti")
    out = kept.unionByName(rows.select(*kept.columns))
    _set(store, new, "frequent", store.write(out, "frequent", ["window_start", "timestamp"]), touched)


# -- retention ----------------------------------------------------------------------------

def retire(store: Store, days: int, as_of: datetime | None = None) -> Manifest:
    """Drop points older than ``days`` before ``as_of`` (UTC; the largest reading
    time of the store by default, taken from the manifest, not from a scan).

    Partitions before the cut leave the manifest without being read; only the
    day of the cut is rewritten. Roll-up buckets and windows go when they start
    before the cut. Readers of older manifests are not disturbed; the files go
    with ``vacuum``."""
    m = store.manifest()
    now = int(as_of.replace(tzinfo=timezone.utc).timestamp()) if as_of else m.last
    if now is None:
        return m
    cut = now - days * 86400
    when = datetime.fromtimestamp(cut, timezone.utc).replace(tzinfo=None)
    start = {"raw": F.col("timestamp"), "panes": F.col("pane"),
             "rollup": epoch_seconds("bucket"), "frequent": epoch_seconds("window_start"),
             **{t: epoch_seconds("bucket") for t in ("partials_1m", "partials_1h", "partials_1d")}}
    order = {"raw": ["timestamp"], "panes": ["pane"], "rollup": ["level", "bucket"],
             "frequent": ["window_start", "timestamp"]}
    new = Manifest(m.version + 1, m.merged, dict(m.done), m.last, {})
    for table, entries in m.tables.items():
        edge = _month(when.date().isoformat()) if table == "partials_1d" \
            else when.date().isoformat()
        new.tables[table] = {k: v for k, v in entries.items() if k.split("/")[1] > edge}
        # a window that starts before midnight may have points after it
        last = (when.date() + timedelta(1)).isoformat() if table == "frequent" else edge
        parts = {tuple(k.split("/")) for k in entries if edge <= k.split("/")[1] <= last}
        if parts:
            rows = store.read(table, parts=parts, manifest=m).filter(start[table] >= cut)
            folder = store.write(rows, table, order.get(table, ["bucket", "room_id"]))
            _set(store, new, table, folder, parts)
    store.put(new)
    return new


def vacuum(store: Store, keep: int = 2) -> list[str]:
    """Remove what the newest ``keep`` manifests do not need: older manifests,
    partition folders that none of them names, merged batches and their commits.
    A batch that still holds minutes open under the watermark stays. Returns the
    removed names. Readers of the kept manifests are safe."""
    names = store.files.names("manifests")
    kept = names[-max(keep, 1):]
    if not kept:
        return []
    manifests = [Manifest(**json.loads(store.files.read(f"manifests/{n}"))) for n in kept]
    gone = [f"manifests/{n}" for n in names if n not in kept]
    used = defaultdict(set)
    for m in manifests:
        for table, entries in m.tables.items():
            for key, folders in entries.items():
                for f in folders:
                    used[f].add(key)
    for table in store.files.names("tables"):
        for v in store.files.names(f"tables/{table}"):
            folder = f"tables/{table}/{v}"
            if folder not in used:
                gone.append(folder)
                continue
            gone += [f"{folder}/metric={name}/day={day}" for name, day in store.partitions(folder)
                     if f"{name}/{day}" not in used[folder]]
    commits = store.commits()
    mark = max((c.watermark for c in commits if c.watermark is not None), default=None)
    for c in commits[:-1]:       # the newest one holds the count and the watermark
        still_open = mark is not None and "ontime" in c.outputs and c.last + 60 > mark
        if c.seq <= manifests[0].merged and not still_open:
            gone += [f"commits/{c.seq:012d}-{c.run}-{c.batch_id}.json", c.folder]
    for name in gone:
        store.files.delete(name)
    return gone
