"""Consolidation that outlives its application: one shard after the other against a stored index.

A run's folder holds, for every shard, its rows, the part of the index that it added, and last a
marker with the digest of what it was made from. A shard whose marker is there is not computed
again; one whose source has changed since is refused. What a broken run left without a marker is
written anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaver.operators import dedupe, inventory
from quaver.session import remove_path
from quaver.sources import sinks
from quaver.streaming.incremental import INDEX, consolidate

ROWS = "stream_id string, shard_id int, canonical_hash string, status string, kept_stream_id string, kept_shard_id int"
#: A part of the index: the hashes a shard has, who stands for them, and how often the shard has them.
PART = INDEX + ", step int"


class Run:
    """A consolidation in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, shard: int, what: str) -> str:
        return f"{self.folder}/shard-{shard:06d}/{what}"

    def marker(self, shard: int) -> dict | None:
        path = self._path(shard, "done.json")
        fs, where = sinks._fs(self.spark, path)
        return sinks.read_json(self.spark, path) if fs.exists(where) else None

    def done(self) -> list[int]:
        """Finished shards, in order of their steps."""
        fs, where = sinks._fs(self.spark, self.folder)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        shards = [int(n.removeprefix("shard-")) for n in names if n.startswith("shard-")]
        return sorted((s for s in shards if self.marker(s)), key=lambda s: self.marker(s)["step"])

    def index(self, shards: list[int]) -> DataFrame:
        """The index after the shards: one scan of their parts, whatever their number."""
        if not shards:
            return self.spark.createDataFrame([], INDEX)
        parts = self.spark.read.schema(PART).parquet(*[self._path(s, "index") for s in shards])
        sums = parts.groupBy("canonical_hash").agg(F.min_by(F.struct("kept_stream_id", "kept_shard_id"), "step").alias("k"), F.sum("occurrence_count").alias("occurrence_count"))
        return sums.select("canonical_hash", "k.kept_stream_id", "k.kept_shard_id", "occurrence_count")

    def rows(self) -> DataFrame:
        shards = self.done()
        return self.spark.read.schema(ROWS).parquet(*[self._path(s, "rows") for s in shards]) if shards else self.spark.createDataFrame([], ROWS)

    def step(self, shard: int, items: DataFrame, ledger: DataFrame | None = None) -> str:
        """Take in one shard: SKIPPED_COMPLETE if it was already, else COMPLETE.

        `ledger` (stream_id) lists what the shard must hold, each id as often as it must. Items with a receipt status are reconciled
        first: what cannot be proven stops the run, and only accepted ones go on.
        """
        items = items.where(F.col("shard_id") == shard)
        source = sinks.table_digest(items, items.columns)
        known = self.marker(shard)
        if known:
            if known["source"] != source:
                raise ValueError(f"shard {shard} has changed since it was completed")
            return "SKIPPED_COMPLETE"
        if ledger is not None:
            wrong = inventory.ledger_difference(ledger.select("stream_id"), items.select("stream_id")).limit(5).collect()
            if wrong:
                raise ValueError(f"shard {shard} is not what its ledger lists: {[(r.stream_id, r.side) for r in wrong]}")
        if "receipt_status" in items.columns:
            items = dedupe.fail_closed(items).where("outcome = 'accepted'")
        remove_path(self.spark, f"{self.folder}/shard-{shard:06d}")
        before = self.done()
        rows, _ = consolidate(self.index(before), items.select("stream_id", "shard_id", "canonical_hash"))
        rows.write.parquet(self._path(shard, "rows"))
        back = self.spark.read.schema(ROWS).parquet(self._path(shard, "rows"))
        part = back.groupBy("canonical_hash").agg(F.min("kept_stream_id").alias("kept_stream_id"), F.min("kept_shard_id").alias("kept_shard_id"), F.count("*").alias("occurrence_count"))
        part.withColumn("step", F.lit(len(before))).write.parquet(self._path(shard, "index"))
        sinks.write_json(self.spark, self._path(shard, "done.json"), {"state": "COMPLETE", "step": len(before), "source": source, "rows": back.count()})
        return "COMPLETE"

    def run(self, shards: Iterable[int], load: Callable[[int], DataFrame], ledgers: Callable[[int], DataFrame] | None = None) -> dict[int, str]:
        return {s: self.step(s, load(s), ledgers(s) if ledgers else None) for s in shards}
