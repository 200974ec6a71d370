"""Views of the test tables as the engine's inputs, in Spark and (as CTEs) in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.functions.ids import hash_partition
from quaver.session import table

SHARDS = 7

NOTES_SQL = """
v_notes as (
  select 'u' || user_id as stream_id,
         row_number() over (partition by user_id order by (epoch_us(ts) - 1704067200000000) // 60000000, event_id) - 1 as note_index,
         (epoch_us(ts) - 1704067200000000) // 60000000 as onset_tick,
         1 + cast(floor(value * 10) as bigint) as duration_ticks,
         36 + event_id % 48 as pitch,
         1 + (event_id * 7) % 127 as velocity
  from events),
c_notes as (
  select *, onset_tick + duration_ticks as end_tick, onset_tick // 1920 as onset_bar,
         greatest(onset_tick // 1920, (onset_tick + duration_ticks - 1) // 1920) as end_bar
  from v_notes),
grid as (
  select stream_id, unnest(range(greatest(1, cast(ceil(max(end_tick) / 1920.0) as bigint)))) as bar_index
  from c_notes group by stream_id)"""

ITEMS_SQL = f"""
v_items as (
  select 'd' || d.doc_id as stream_id, d.doc_id, source as dataset_id, sha256(text) as canonical_hash, d.doc_id // 3 as piece_id,
         cast(cast('0x' || substr(sha256(source || chr(0) || d.doc_id), 1, 16) as ubigint) % {SHARDS} as integer) as shard_id,
         case quality when 1 then 'ACCEPT' when 0 then 'REJECT' end as receipt_status,
         case d.doc_id % 4 when 0 then 'ACCEPT' when 1 then 'REJECT' end as cached_status
  from documents d left join labels l on l.doc_id = d.doc_id)"""

SPANS_SQL = """
v_spans as (
  select 'c' || conv_id as stream_id, turn as bar_index, role as label,
         cast(len(string_split(trim(text), ' ')) as bigint) as length, turn % 5 = 4 as is_empty
  from conversations)"""

INVENTORY_SQL = """
v_inventory as (
  select o_orderstatus as bucket, o_orderkey as key, cast(floor(o_totalprice) as bigint) as size, sha256(strftime(o_orderdate, '%Y-%m-%d')) as etag
  from orders),
v_old as (select * from v_inventory where key % 10 <> 0),
v_new as (select bucket, key, size + case when key % 7 = 0 then 1 else 0 end as size, etag from v_inventory where key % 10 <> 1)"""

REGISTRY_SQL = """
v_registry as (
  select 'p' || p_partkey as dataset_id, case p_partkey % 5 when 0 then 'overlay' else 'raw' end as role,
         case p_partkey % 3 when 0 then 'DENIED' else 'ALLOWED' end as training,
         case p_partkey % 4 when 0 then 'manual_gated' when 1 then 'none' else 'http' end as method,
         cast(floor(p_retailprice) as bigint) as estimate, p_partkey
  from part)"""


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as note events of one 4/4 meter at 480 ticks per quarter."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    onset = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 60000000")
    rows = events.select(
        "user_id",
        "event_id",
        onset.alias("onset_tick"),
        (1 + F.floor(F.col("value") * 10).cast("bigint")).alias("duration_ticks"),
        (36 + F.col("event_id") % 48).alias("pitch"),
        (1 + (F.col("event_id") * 7) % 127).alias("velocity"),
    )
    index = F.row_number().over(W.partitionBy("stream_id").orderBy("onset_tick", "event_id")) - 1
    named = rows.withColumn("stream_id", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return named.select("stream_id", index.cast("bigint").alias("note_index"), "onset_tick", "duration_ticks", "pitch", "velocity", F.lit(1920).cast("bigint").alias("bar_ticks"), F.lit(4.0).alias("beats"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as derived streams with receipts."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    number = F.col("doc_id").cast("string")
    digest = F.sha2("text", 256)
    return docs.join(labels, "doc_id", "left").select(
        F.concat(F.lit("d"), number).alias("stream_id"),
        "doc_id",
        F.col("source").alias("dataset_id"),
        digest.alias("canonical_hash"),
        digest.alias("event_hash"),
        F.expr("doc_id div 3").alias("piece_id"),
        hash_partition(F.col("source"), number, SHARDS).alias("shard_id"),
        F.when(F.col("quality") == 1, "ACCEPT").when(F.col("quality") == 0, "REJECT").alias("receipt_status"),
        F.when(F.col("doc_id") % 4 == 0, "ACCEPT").when(F.col("doc_id") % 4 == 1, "REJECT").alias("cached_status"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as represented bars."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("stream_id"),
        F.col("turn").alias("bar_index"),
        F.col("role").alias("label"),
        F.size(F.split(F.trim("text"), " ")).cast("bigint").alias("length"),
        (F.col("turn") % 5 == 4).alias("is_empty"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate")
    return orders.select(F.col("o_orderstatus").alias("bucket"), F.col("o_orderkey").alias("key"), F.floor("o_totalprice").cast("bigint").alias("size"), F.sha2(F.date_format("o_orderdate", "yyyy-MM-dd"), 256).alias("etag"))


def old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = inventory(spark, sf_dir)
    changed = F.col("size") + F.when(F.col("key") % 7 == 0, 1).otherwise(0)
    return rows.where("key % 10 != 0"), rows.where("key % 10 != 1").withColumn("size", changed)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), k.cast("string")).alias("dataset_id"),
        F.when(k % 5 == 0, "overlay").otherwise("raw").alias("role"),
        F.when(k % 3 == 0, "DENIED").otherwise("ALLOWED").alias("training"),
        F.when(k % 4 == 0, "manual_gated").when(k % 4 == 1, "none").otherwise("http").alias("method"),
        F.floor("p_retailprice").cast("bigint").alias("estimate"),
        "p_partkey",
    )
