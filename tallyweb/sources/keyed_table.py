"""A table with a key that is there once, for loads into a target much larger than what is loaded.

Rows lie in parts by a hash of their key. Each append also writes Bloom filters of its keys, a small table of (part, word,
mask). New keys are looked up in these first; only parts that some new key may be in are read, and of them the key alone.
Appends are entries of a commit log, so writers don't undo each other's check, and an append with a name (of a stream's
batch, say) is done once, however often it is tried.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .commit_log import CommitLog
from .staged import staged

HASHES = 4  # bits that a key sets
_BLOOM = "word int, mask long, part int"


class KeyedTable:
    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: str, parts: int = 64, bits: int = 1 << 20) -> None:
        """Opens the table, or makes it. `parts` and `bits` (of a part's filter) are those that it was made with: ten bits a
        key find about one part in fifty too many."""
        self.spark, self.folder, self.schema, self.key = spark, folder.rstrip("/"), schema, key
        self.log = CommitLog(spark, f"{self.folder}/log")
        if not self.log.entries():
            self.log.put(0, {"kind": "table", "parts": parts, "bits": bits})
        made = self.log.entries()[0]
        self.parts, self.bits = made["parts"], made["bits"]

    def _appends(self, entries: list[dict[str, Any]]) -> list[dict[str, Any]]:
        """Those in force: from the last compaction on."""
        first = max((i for i, e in enumerate(entries) if e["kind"] == "compact"), default=0)
        return [e for i, e in enumerate(entries) if i >= first and "path" in e]

    def _rows(self, appends: list[dict[str, Any]], parts: list[int] | None = None) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        out = self.spark.createDataFrame([], f"{fields}, part int")
        for e in appends:
            if parts is None or set(parts) & set(e["parts"]):
                rows = self.spark.read.schema(out.schema).option("basePath", e["path"]).parquet(e["path"])
                out = out.unionByName(rows if parts is None else rows.where(F.col("part").isin(parts)))
        return out

    def rows(self) -> DataFrame:
        return self._rows(self._appends(self.log.entries())).select(*self.schema.names)

    def _bits_of(self, key: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bits)) for i in range(HASHES)])

    def _maybe(self, new: DataFrame, appends: list[dict[str, Any]], parts: list[int]) -> DataFrame:
        """(key, part) of new rows whose key some append's filter has; a key has all of its bits in one append's."""
        probes = new.select(self.key, "part", F.posexplode(self._bits_of(F.col(self.key))).alias("i", "bit"))
        probes = probes.withColumn("word", F.floor(F.col("bit") / 64).cast("int"))
        found = None
        for n, e in enumerate(appends):
            if set(parts) & set(e["parts"]):
                words = self.spark.read.schema(_BLOOM).option("basePath", e["bloom"]).parquet(e["bloom"]).where(F.col("part").isin(parts)).withColumn("n", F.lit(n))
                found = words if found is None else found.unionByName(words)
        if found is None:
            return new.select(self.key, "part").limit(0)
        bit = F.expr("shiftleft(1L, cast(bit % 64 as int))")
        hits = probes.join(found, ["part", "word"]).where(F.col("mask").bitwiseAND(bit) != 0)
        full = hits.groupBy(self.key, "part", "n").agg(F.count("*").alias("bits")).where(F.col("bits") == HASHES)
        return full.select(self.key, "part").distinct()

    def insert(self, new: DataFrame, order: tuple[str, ...] = (), name: str | None = None) -> DataFrame:
        """Appends of `new` the first row of each key by `order`, of keys that aren't there yet, and gives what it appended.

        Null keys are one key. An append of a `name` that was made before gives that one's rows and does nothing.
        """
        values = F.struct(*[F.col(c) for c in self.schema.names if c != self.key])
        first = new.groupBy(self.key).agg(F.min_by(values, F.struct(*order)).alias("row") if order else F.first(values).alias("row"))
        first = first.select(self.key, "row.*").withColumn("part", F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int"))
        staged_keys = None
        while True:
            if (made := self._named(name)) is not None:
                return self._rows([made]).select(*self.schema.names)
            first = staged_keys = staged_keys or staged(first, "new_keys")
            entries = self.log.entries()
            appends = self._appends(entries)
            parts = sorted(r["part"] for r in first.select("part").distinct().collect())
            maybe = staged(self._maybe(first, appends, parts), "maybe_there")
            read = sorted(r["part"] for r in maybe.select("part").distinct().collect())
            there = self._rows(appends, read).select(F.col(self.key).alias("there"))
            known = maybe.join(there, F.col("there").eqNullSafe(F.col(self.key)), "left_semi").select(F.col(self.key).alias("there"))
            fresh = first.join(known, F.col("there").eqNullSafe(F.col(self.key)), "left_anti") if read else first
            entry = self._write(fresh.select(*self.schema.names, "part")) | {"kind": "append", "name": name, "read": read}
            if self.log.put(len(entries), entry):
                return self._rows([entry]).select(*self.schema.names)

    def _named(self, name: str | None) -> dict[str, Any] | None:
        return next((e for e in self.log.entries() if name is not None and e.get("name") == name), None)

    def _write(self, rows: DataFrame) -> dict[str, Any]:
        """Rows and their filters; a figure a part comes to the driver."""
        path, bloom = (f"{self.folder}/{kind}/{uuid.uuid4().hex}" for kind in ("rows", "bloom"))
        rows.write.partitionBy("part").parquet(path)
        entry = {"path": path, "bloom": bloom}
        written = self.spark.read.schema(rows.schema).option("basePath", path).parquet(path)
        bits = written.select("part", F.explode(self._bits_of(F.col(self.key))).alias("bit"))
        mask = F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))"))
        words = bits.groupBy("part", F.floor(F.col("bit") / 64).cast("int").alias("word")).agg(mask.alias("mask"))
        words.select("word", "mask", "part").write.partitionBy("part").parquet(bloom)
        return entry | {"parts": sorted(r["part"] for r in written.select("part").distinct().collect())}

    def compact(self) -> None:
        """One append in place of all so far, if nobody appends meanwhile."""
        entries = self.log.entries()
        made = self._write(self._rows(self._appends(entries)))
        self.log.put(len(entries), made | {"kind": "compact"})
