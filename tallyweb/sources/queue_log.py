"""The work queue as a log that several workers claim from and write to at once.

The queue's rows lie in parts by ranges of ids. Entries of a commit log tell of claims and of updates: tables of whole rows,
by part, the latest of an id counts. How many rows of each part are open, by status, follows from the entries alone; so a
claim reads no more parts than it takes rows from, and a part no more than once for each claim from it and once for each
compaction, which writes the parts anew that changed.

A claim picks rows as of an entry and is good if it becomes the next entry. If another worker was quicker it picks anew,
so no row is ever claimed twice. Updates are of rows that their worker has claimed, so they only take the next number that
is free.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.jobs import claim_batch
from ..schemas import QUEUE
from .commit_log import CommitLog

_FIELDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUEUE.fields)
_WITH_PART = f"{_FIELDS}, part int"



class QueueLog:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/log")

    @classmethod
    def create(cls, queue: DataFrame, folder: str, rows_per_part: int = 1_000_000) -> QueueLog:
        """A new log of `queue`. A part should hold a few claims' rows at least."""
        self = cls(queue.sparkSession, folder)
        parts = max(1, -(-queue.count() // rows_per_part))
        rows = queue.select(*[F.col(f.name).cast(f.dataType) for f in QUEUE.fields])
        ranged = rows.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id())
        path, counts = self._write(ranged)
        if not self.log.put(0, {"kind": "base", "rows": {part: path for part in counts}, "parts": counts}):
            raise ValueError(f"there is a log already: {folder}")
        return self

    def _write(self, rows: DataFrame, claimed: bool = False) -> tuple[str, dict[str, dict[str, list]]]:
        """Where the rows are now; of each part, numbers of open rows by status, and their ids' range. `claimed`: rows that
        were open before. A figure a part and status comes to the driver."""
        path = f"{self.folder}/rows/{uuid.uuid4().hex}"
        rows.write.partitionBy("part").parquet(path)
        found = self._read([(path, None, {})]).groupBy("part", "processing_status").agg(
            F.count_if(F.lit(claimed) | F.col("claimed_by").isNull()).alias("n"), F.min("id").alias("least"), F.max("id").alias("most")
        )
        out: dict[str, dict[str, list]] = {}
        for r in found.collect():
            out.setdefault(str(r["part"]), {})[r["processing_status"] or ""] = [r["n"], r["least"], r["most"]]
        return path, out

    def _read(self, tables: list[tuple[str, list[str] | None, dict[str, Any]]]) -> DataFrame:
        """Rows of tables, each with the parts to read (None: all) and columns of its own; other parts' files aren't read."""
        out = None
        for path, parts, more in tables:
            rows = self.spark.read.schema(_WITH_PART).option("basePath", path).parquet(path)
            if parts is not None:
                rows = rows.where(F.col("part").isin([int(p) for p in parts]))
            rows = rows.withColumns({k: F.lit(v) for k, v in more.items()}) if more else rows
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], _WITH_PART) if out is None else out

    @staticmethod
    def _since_base(entries: list[dict[str, Any]]) -> tuple[dict[str, Any], list[tuple[int, dict[str, Any]]]]:
        at = max(i for i, e in enumerate(entries) if e["kind"] == "base")
        return entries[at], [(i, e) for i, e in enumerate(entries) if i > at or i in entries[at].get("after", ())]

    @staticmethod
    def _open(base: dict[str, Any], later: list[tuple[int, dict[str, Any]]]) -> dict[str, Counter]:
        """Of each part, rows that may be claimed, by status."""
        out = {part: Counter({status: n for status, (n, *_) in by.items()}) for part, by in base["parts"].items()}
        for _, e in later:
            for part, by in e["parts"].items():
                for status, (n, *_) in by.items():
                    out[part][status] += -n if e["kind"] == "claim" else n
        return out

    def _state(self, entries: list[dict[str, Any]], parts: list[str] | None = None) -> DataFrame:
        """Rows as of these entries, with `part`."""
        base, later = self._since_base(entries)
        wanted = sorted(base["rows"] if parts is None else parts, key=int)
        tables: dict[str, list[str]] = {}
        for p in wanted:
            tables.setdefault(base["rows"][p], []).append(p)
        found = [(path, own, {"number": -1}) for path, own in tables.items()]
        found += [(e["path"], own, {"number": i}) for i, e in later if (own := [p for p in wanted if p in e["parts"]])]
        rows = self._read(found)
        if len(found) == len(tables):
            return rows.drop("number")
        return rows.groupBy("id").agg(F.max_by(F.struct(*QUEUE.names, "part"), "number").alias("row")).select("row.*")

    def state(self) -> DataFrame:
        """The whole queue as of now."""
        return self._state(self.log.entries()).select(*QUEUE.names)

    def _commit(self, entry: Callable[[list[dict[str, Any]]], dict[str, Any] | None]) -> dict[str, Any] | None:
        """Puts what entry() makes of the entries so far, anew for as long as others are quicker."""
        while True:
            entries = self.log.entries()
            new = entry(entries)
            if new is None or self.log.put(len(entries), new):
                return new

    def claim(self, n: int, statuses: list[str], worker: str, at: datetime, min_id: int | None = None) -> DataFrame:
        """Up to `n` rows, the least ids first, that are this worker's from now on (see claim_batch)."""

        def entry(entries: list[dict[str, Any]]) -> dict[str, Any] | None:
            base, later = self._since_base(entries)
            counts, picked, found = self._open(base, later), [], 0
            for part in sorted(counts, key=int):
                most = max((m for _, _, m in base["parts"][part].values()), default=None)
                here = sum(counts[part][s] for s in statuses)
                if here and (min_id is None or most is None or most >= min_id):
                    picked.append(part)
                    least = min(x for _, x, _ in base["parts"][part].values())
                    found += here if min_id is None or least >= min_id else 0  # of a part that min_id cuts none is sure
                    if found >= n:
                        break
            if not picked or n <= 0:
                return None
            rows = claim_batch(self._state(entries, picked), n, statuses, worker, at, min_id)
            path, parts = self._write(rows, claimed=True)
            return {"kind": "claim", "worker": worker, "path": path, "parts": parts} if parts else None

        done = self._commit(entry)
        return self._read([(done["path"], None, {})] if done else [])

    def update(self, rows: DataFrame, worker: str) -> None:
        """Whole rows, with `part`, as they are after the worker's batch."""
        path, counts = self._write(rows.select(*QUEUE.names, "part"))
        self._commit(lambda _: {"kind": "update", "worker": worker, "path": path, "parts": counts})

    def compact(self) -> None:
        """Writes the parts anew that entries since the last compaction touch. Workers may go on meanwhile: entries that
        come before its own are kept in force."""
        entries = self.log.entries()
        base, later = self._since_base(entries)
        changed = sorted({p for _, e in later for p in e["parts"]})
        if not changed:
            return
        path, counts = self._write(self._state(entries, changed))
        upto = len(entries)
        rows, parts = base["rows"] | {p: path for p in changed}, base["parts"] | counts

        def entry(now: list[dict[str, Any]]) -> dict[str, Any] | None:
            if any(e["kind"] == "base" for e in now[upto:]):
                return None  # another compaction was quicker
            return {"kind": "base", "rows": rows, "parts": parts, "after": list(range(upto, len(now)))}

        self._commit(entry)

    def history(self) -> DataFrame:
        """(number, kind, worker, id, processing_status, retry_count) of all that was claimed and updated."""
        told = [(e["path"], None, {"number": i, "kind": e["kind"], "worker": e["worker"]}) for i, e in enumerate(self.log.entries()) if e["kind"] != "base"]
        if not told:
            return self.spark.createDataFrame([], "number int, kind string, worker string, id long, processing_status string, retry_count int")
        return self._read(told).select("number", "kind", "worker", "id", "processing_status", "retry_count")
