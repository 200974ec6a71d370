"""Sources: registries, receipts, inventories and allow lists with declared schemas."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaver.functions.ids import object_id
from quaver.operators.inventory import allow_list_paths

REGISTRY = "id string, method string, license string, training string, lane string, role string, estimate long, urls array<string>"
INVENTORY = "schema string, bucket string, key string, object_id string, size long, etag string, last_modified string"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The sources of a registry file: {"sources": [...]}."""
    raw = spark.read.schema(f"sources array<struct<{', '.join(x.replace(' ', ': ', 1) for x in REGISTRY.split(', '))}>>").json(path, multiLine=True)
    return raw.select(F.inline("sources"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, blank lines skipped; a line that is no JSON fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_files(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One JSON record per file."""
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(folder)


def read_inventory(spark: SparkSession, path: str, schema_name: str) -> DataFrame:
    """Inventory records (plain or gzip); a wrong schema, identity or size fails."""
    rows = read_json_lines(spark, path, INVENTORY)
    good = (F.col("schema") == schema_name) & (F.col("object_id") == object_id(F.col("bucket"), F.col("key"))) & (F.col("size") >= 0)
    bad = F.raise_error(F.concat(F.lit("bad inventory record: "), F.coalesce("key", F.lit("")))).cast("boolean")
    return rows.where(F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(bad))


def read_partial_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The whole records of an inventory that a crash cut off: text up to the last newline, gzip up to the last whole member."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                raw = bytes(content)
                text = whole_members(raw) if path.endswith(".gz") else raw
                lines = text[: text.rfind(b"\n") + 1].decode().splitlines()
                yield pd.DataFrame({"line": [x for x in lines if x.strip()]})

    parsed = files.mapInPandas(run, "line string").select(F.from_json("line", INVENTORY).alias("r"))
    return parsed.where("r.key is not null").select("r.*")


def whole_members(raw: bytes) -> bytes:
    out, rest = [], raw
    while rest:
        member = zlib.decompressobj(31)
        try:
            part = member.decompress(rest)
        except zlib.error:
            break
        if not member.eof:
            break
        out.append(part)
        rest = member.unused_data
    return b"".join(out)


def completed_shards(receipts: DataFrame) -> DataFrame:
    """Shards with a COMPLETE receipt, each once, in order."""
    return receipts.where("state = 'COMPLETE'").select("shard_id").distinct().orderBy("shard_id")


def checked_receipts(receipts: DataFrame, shards: int) -> DataFrame:
    """COMPLETE receipts; a shard outside 0 .. shards - 1 fails."""
    bad = F.raise_error(F.concat(F.lit("receipt out of range: "), F.col("shard_id").cast("string"))).cast("boolean")
    return receipts.where("state = 'COMPLETE'").where(F.when(F.col("shard_id").between(0, shards - 1), F.lit(True)).otherwise(bad))


def accepted_rows(items: DataFrame) -> DataFrame:
    """Complete items whose receipt accepts the hash they carry; the filter is pushed to the scan."""
    return items.where("state = 'COMPLETE' and canonical_hash is not null and receipt_status = 'ACCEPT' and event_hash = canonical_hash")


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    from quaver.operators.inventory import allow_list_paths

    return allow_list_paths(spark.read.text(path))
