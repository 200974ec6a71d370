"""Queries over inventories, runs, sources and progress; and the operators without a SQL form."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.functions import ids
from quaver.operators import inventory as inv
from quaver.operators import registry as reg
from quaver.operators import dedupe, tracks, validation
from quaver.operators.canonical import canonical_bars, canonical_notes
from quaver.plans.adapters import INVENTORY_SQL, ITEMS_SQL, NOTES_SQL, REGISTRY_SQL, inventory, items, notes, old_and_new, registry
from quaver.plans.corpus import split_sql
from quaver.sources import midi

SPLIT = split_sql("p")

CLASSES = """
classes as (
  select coalesce(o.bucket, n.bucket) as bucket, coalesce(o.key, n.key) as key, o.size as old_size, n.size as new_size,
         case when n.key is null then 'missing' when o.key is null then 'extra' when o.size = n.size and o.etag = n.etag then 'matched' else 'mismatched' end as class
  from v_old o full join v_new n on o.bucket = n.bucket and o.key = n.key)"""
PACKAGES = """
packages as (select doc_id as item_id, shard_id from v_items union all select doc_id, (shard_id + 1) % 7 from v_items where doc_id % 50 = 0),
shared_items as (select p.item_id, p.shard_id, o.owner from packages p join (select item_id, min(shard_id) as owner from packages group by item_id having min(shard_id) <> max(shard_id)) o using (item_id) where p.shard_id <> o.owner)"""
CHUNK = 65536
PLAN = f"plan as (select bucket, key, unnest(range(cast(ceil(size / {CHUNK}.0) as bigint))) as chunk_index, size from v_inventory where size > 0)"

# The state at an event is looked up by time (asof joins), where the engine runs windows over all events.
EVENTS = f"""
with {NOTES_SQL},
raw as (
  select stream_id as file, note_index, onset_tick as tick, 'note_on' as kind, cast(pitch % 12 + 60 as integer) as data1, cast(velocity as integer) as data2 from v_notes
  union all select stream_id, note_index, onset_tick + duration_ticks, 'note_off', cast(pitch % 12 + 60 as integer), 0 from v_notes
  union all select stream_id, note_index, onset_tick + 1, 'control_change', cast([64, 66, 67, 121][note_index % 4 + 1] as integer), cast(note_index % 3 * 63 as integer) from v_notes),
ev as (select *, row_number() over (partition by file order by tick, note_index, kind, data1) as seq, max(tick) over (partition by file) as last_tick from raw)"""
PEDALS = f"""{EVENTS},
ctl as (select file, seq, tick, data1 as n, data2 >= 64 as down from ev where kind = 'control_change' and data1 <> 67),
sustain as (select file, seq, tick, n = 64 and down as down from ctl where n <> 66),
sostenuto as (select *, coalesce(lag(down) over (partition by file order by seq), false) as prior from (select file, seq, tick, n, n = 66 and down as down from ctl where n <> 64)),
lifts as (select * from sostenuto where n = 121 or (not down and prior)),
keys as (select *, sum(case kind when 'note_on' then 1 else -1 end) over (partition by file, data1 order by seq) as s from ev where kind <> 'control_change'),
floors as (select *, least(0, min(s) over w) as low, least(0, coalesce(min(s) over (w rows between unbounded preceding and 1 preceding), 0)) as low_before from keys window w as (partition by file, data1 order by seq)),
heights as (select *, kind = 'note_off' and s < low_before as stray, s - low + case kind when 'note_off' then 1 else 0 end as height from floors),
taken as (
  select *, lag(seq) over w as on_seq, lag(tick) over w as on_tick, lead(tick) over w as off_tick
  from heights window w as (partition by file, data1, case when not stray then height end order by seq)),
offs as (select * from taken where kind = 'note_off' and not stray and on_tick <> tick),
at_off as (
  select o.*, coalesce(su.down, false) as su_down, coalesce(so.down, false) as so_down, coalesce(p.seq > o.on_seq and p.seq > coalesce(r.seq, 0), false) as caught, u.seq as up_seq, u.tick as up_tick, l.seq as lift_seq
  from offs o
  asof left join sustain su on su.file = o.file and su.seq < o.seq
  asof left join sostenuto so on so.file = o.file and so.seq < o.seq
  asof left join (select * from sostenuto where down and not prior) p on p.file = o.file and p.seq < o.seq
  asof left join (select * from ctl where n = 121) r on r.file = o.file and r.seq < o.seq
  asof left join (select * from sustain where not down) u on u.file = o.file and u.seq > o.seq
  asof left join lifts l on l.file = o.file and l.seq > o.seq),
first_up as (
  select a.*, case when su_down then up_seq else seq end as t1, case when su_down then up_tick else tick end as t1_tick from at_off a),
caught as (
  select f.*, f.caught and coalesce(so.down, false) and (f.lift_seq is null or f.lift_seq > f.t1) as blocked, l.seq as r1, l.tick as r1_tick
  from first_up f
  asof left join sostenuto so on so.file = f.file and so.seq <= f.t1
  asof left join lifts l on l.file = f.file and l.seq > f.t1),
lifted as (
  select c.*, coalesce(su.down, false) as r1_down, u.seq as r1_up, u.tick as r1_up_tick
  from caught c
  asof left join sustain su on su.file = c.file and su.seq <= c.r1
  asof left join (select * from sustain where not down) u on u.file = c.file and u.seq > c.r1),
released as (
  select file, seq, last_tick, data1, data2,
         case when not su_down and not (so_down and caught) then seq when blocked then case when r1_down then r1_up else r1 end else t1 end as end_seq,
         case when not su_down and not (so_down and caught) then tick when blocked then case when r1_down then r1_up_tick else r1_tick end else t1_tick end as end_tick
  from lifted),
placed as (
  select file, seq, coalesce(end_seq, 9223372036854775806) as place, coalesce(end_tick, last_tick) as tick, 'note_off' as kind, data1, data2, end_seq is null as late from released
  union all select file, seq, seq, tick, kind, data1, data2, false from taken where stray or (kind = 'note_on' and off_tick is distinct from tick))
select p.file, row_number() over (partition by p.file order by p.tick, place, p.seq) - 1 as seq, p.tick, p.kind, p.data1, p.data2,
       (select count(*) from taken t where t.file = p.file and t.kind = 'note_off' and not stray and t.on_tick = t.tick) as zero_duration_dropped,
       count(*) filter (where late) over (partition by p.file) as end_of_track_noteoffs
from placed p"""
LINE = "concat_ws('|', tick, kind, 0, data1, data2)"
RECEIPTS = f"""{EVENTS}, flat as ({PEDALS}),
source as (select file, sha256(string_agg({LINE}, chr(10) order by seq)) as source_sha256, {', '.join(f"count(*) filter (where kind = 'control_change' and data1 = {n}) as n{n}" for n in (64, 66, 67, 121))} from ev group by file),
output as (select file, sha256(string_agg({LINE}, chr(10) order by seq)) as output_sha256, max(zero_duration_dropped) as zero_duration_dropped, max(end_of_track_noteoffs) as end_of_track_noteoffs from flat group by file)
select file, source_sha256, output_sha256, n64 as cc64_rendered, n66 as cc66_rendered, n67 as cc67_discarded, n121 as cc121_resets_consumed, zero_duration_dropped, end_of_track_noteoffs from source join output using (file)"""
PACKS = f"""
with recursive {INVENTORY_SQL},
named as (select sha256(bucket || chr(0) || key) as object_id, size from v_inventory),
framed as (select *, cast(cast('0x' || substr(object_id, 1, 16) as ubigint) % 8 as integer) as worker, 4 + strlen('{{"object_id":"' || object_id || '","size":' || size || '}}') + size as frame from named),
small as (select *, row_number() over (partition by worker order by object_id) as i from framed where size <= 300000 and frame + 8 <= 2000000),
fold as (
  select worker, i, object_id, size, 0 as pack_index, 0 as position, 8 + frame as used from small where i = 1
  union all
  select s.worker, s.i, s.object_id, s.size, case when full_ then pack_index + 1 else pack_index end, case when full_ then 0 else position + 1 end, case when full_ then 8 else used end + frame
  from (select f.worker, f.i, f.pack_index, f.position, f.used, used + n.frame > 2000000 or position + 1 >= 10000 as full_ from fold f join small n on n.worker = f.worker and n.i = f.i + 1) f
  join small s on s.worker = f.worker and s.i = f.i + 1)
select worker, object_id, size, cast(pack_index as bigint) as pack_index, cast(position as bigint) as position from fold"""


def _v(body: str) -> str:
    return f"with {INVENTORY_SQL}{body}"


def _packages(s, d):
    rows = items(s, d).select(F.col("doc_id").alias("item_id"), "shard_id")
    return rows.unionAll(rows.where("item_id % 50 = 0").withColumn("shard_id", (F.col("shard_id") + 1) % 7))


def _markers(s):
    return s.createDataFrame([(k, "COMPLETE" if k != 3 else "FAILED") for k in range(7)] + [(9, "COMPLETE")], "shard_id int, state string")


def _repeated(s, d):
    rows = inventory(s, d)
    again = rows.where("key % 4 = 0")
    return rows.unionAll(again)


def _positions(s, d):
    rows = inventory(s, d).withColumn("position", F.col("key"))
    same = rows.where("key % 4 = 0").withColumn("position", F.col("key") + 1_000_000_000)
    other = rows.where("key % 6 = 0").withColumn("size", F.col("size") + 1).withColumn("position", F.col("key") + 2_000_000_000)
    return rows.unionAll(same).unionAll(other)


def _progress_items(s, d):
    rows = items(s, d)
    accepted = F.when(F.col("receipt_status") == "ACCEPT", F.col("canonical_hash"))
    return rows.select(F.when(F.col("doc_id") % 9 == 0, "PENDING").otherwise("COMPLETE").alias("state"), F.when(F.col("doc_id") % 9 != 0, accepted).alias("canonical_hash"))


def _audit_items(s, d):
    status = F.when(F.col("doc_id") % 11 == 0, None).otherwise(F.coalesce("receipt_status", F.lit("REJECT")))
    codes = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("A"), F.lit("A"))).otherwise(F.array(F.lit("B"), F.lit("A")))
    return items(s, d).select("dataset_id", "stream_id", status.alias("status"), codes.alias("reason_codes"))


def _track_events(s, d):
    """Note events with pedals: every note an on and an off, every fifth stream event a controller."""
    n = notes(s, d).select(F.col("stream_id").alias("file"), F.lit(0).alias("track_index"), "note_index", "onset_tick", "duration_ticks", (F.col("pitch") % 12 + 60).alias("pitch"), "velocity")
    number = F.element_at(F.array(F.lit(64), F.lit(66), F.lit(67), F.lit(121)), (F.col("note_index") % 4 + 1).cast("int"))
    event = lambda tick, kind, a, b: F.struct(tick.alias("tick"), F.lit(kind).alias("kind"), F.lit(0).alias("channel"), a.cast("int").alias("data1"), b.cast("int").alias("data2"))
    on = event(F.col("onset_tick"), "note_on", F.col("pitch"), F.col("velocity"))
    off = event(F.col("onset_tick") + F.col("duration_ticks"), "note_off", F.col("pitch"), F.lit(0))
    pedal = event(F.col("onset_tick") + 1, "control_change", number, F.col("note_index") % 3 * 63)
    rows = n.select("file", "track_index", "note_index", F.inline(F.array(on, off, pedal)))
    order = W.partitionBy("file").orderBy("tick", "note_index", "kind", "data1")
    return rows.withColumn("seq", F.row_number().over(order).cast("bigint")).drop("note_index")


def _flattened(s, d):
    return tracks.flatten_pedals(_track_events(s, d)).select("file", "seq", "tick", "kind", "data1", "data2", "zero_duration_dropped", "end_of_track_noteoffs")


def _midi_events(s, d):
    """Notes written as one-track MIDI files and read back."""
    rows = _track_events(s, d).where("kind != 'control_change'").withColumns({"payload": F.lit(None).cast("binary"), "tpq": F.lit(480), "format": F.lit(1)})
    files = midi.write_candidates(rows).select(F.col("file").alias("path"), F.col("midi").alias("content"))
    return midi.read_events(files)


def _violations(s, d):
    n = notes(s, d)
    broken = canonical_notes(n).withColumn("velocity", F.when(F.col("note_index") % 40 == 0, 0).otherwise(F.col("velocity")))
    return validation.note_violations(broken, canonical_bars(n))


def _record_violations(s, d):
    n = F.col("doc_id")
    rows = items(s, d).select(
        "stream_id",
        F.concat(F.lit("L"), (n % 5).cast("string")).alias("label"),
        F.when(n % 7 == 0, "other").otherwise(ids.hash_split(F.col("stream_id"))).alias("split"),
        F.col("receipt_status").alias("status"),
        F.when(n % 3 != 0, F.col("canonical_hash")).alias("canonical_hash"),
        F.when(n % 2 == 0, F.array(F.lit("A"))).otherwise(F.array().cast("array<string>")).alias("reason_codes"),
        F.array_repeat(F.lit("x"), (n % 4).cast("int")).alias("sibling_track_ids"),
        F.col("canonical_hash").alias("receipt_sha256"),
        F.when(n % 11 != 0, F.col("canonical_hash")).alias("declared_receipt_sha256"),
    )
    return validation.record_violations(rows, ("L0", "L1", "L2", "L3"), siblings=3)


def _split_violations(s, d):
    rows = items(s, d)
    by_piece = rows.select(F.col("piece_id").cast("string").alias("piece_id")).distinct().withColumn("split", ids.hash_split(F.col("piece_id")))
    return validation.split_violations(rows, by_piece)


def _object_ids(s, d):
    return inventory(s, d).select("bucket", "key", ids.object_id(F.col("bucket"), F.col("key").cast("string")).alias("object_id"))


def _packs(s, d):
    rows = inventory(s, d).withColumn("object_id", ids.object_id(F.col("bucket"), F.col("key").cast("string")))
    rows = rows.withColumn("worker", ids.digest_partition(F.col("object_id"), 8))
    return inv.next_fit_packs(rows, 2_000_000, 300_000)


def _semantic(s, d):
    payload = F.to_json(F.struct("dataset_id", "shard_id", "piece_id"))
    return items(s, d).select("stream_id", ids.semantic_hash(payload).alias("semantic_sha256"))


TABLE = {
    "object_ids": (_object_ids, _v(" select bucket, key, sha256(bucket || chr(0) || key) as object_id from v_inventory")),
    "inventory_partition": (
        lambda s, d: _object_ids(s, d).select("bucket", "key", ids.digest_partition(F.col("object_id"), 5).alias("worker")),
        _v(" select bucket, key, cast(cast('0x' || substr(sha256(bucket || chr(0) || key), 1, 16) as ubigint) % 5 as integer) as worker from v_inventory"),
    ),
    "inventory_canonicalize": (lambda s, d: inv.canonicalize(_repeated(s, d)), _v(" select bucket, key, size, etag, case when key % 4 = 0 then 2 else 1 end::bigint as copies from v_inventory")),
    "inventory_ingest_stats": (
        lambda s, d: inv.ingest_stats(_positions(s, d)),
        _v(" select count(*) + count(*) filter (where key % 4 = 0) + count(*) filter (where key % 6 = 0) as source_rows, count(*) as unique_keys, count(*) filter (where key % 4 = 0) as identical, count(*) filter (where key % 6 = 0) as conflicting from v_inventory"),
    ),
    "inventory_totals": (lambda s, d: inv.bucket_totals(inventory(s, d)), _v(" select bucket, count(*) as objects, cast(sum(size) as bigint) as bytes from v_inventory group by bucket")),
    "inventory_classes": (lambda s, d: inv.classify(*old_and_new(s, d)).select("bucket", "key", "class"), _v(f",{CLASSES} select bucket, key, class from classes")),
    "inventory_coverage": (
        lambda s, d: inv.coverage_report(*old_and_new(s, d)),
        _v(f",{CLASSES} select count(*) filter (where class <> 'extra') as expected, " + ", ".join(f"count(*) filter (where class = '{c}') as {c}" for c in ("matched", "missing", "mismatched", "extra")) + ", 'INCOMPLETE' as state from classes"),
    ),
    "inventory_compare": (
        lambda s, d: inv.compare_report(*old_and_new(s, d)),
        _v(
            f""",{CLASSES} select case class when 'matched' then 'identical' when 'mismatched' then 'changed' when 'missing' then 'old_only' else 'new_only' end as class,
 count(*) as objects, cast(coalesce(sum(old_size), 0) as bigint) as old_bytes, cast(coalesce(sum(new_size), 0) as bigint) as new_bytes from classes group by all"""
        ),
    ),
    "inventory_samples": (
        lambda s, d: inv.compare_samples(*old_and_new(s, d)),
        _v(f",{CLASSES} select class, bucket, key from (select *, row_number() over (partition by class order by bucket, key) as place from classes where class <> 'matched') where place <= 20"),
    ),
    "ledger_difference": (
        lambda s, d: inv.ledger_difference(*[x.select("key") for x in old_and_new(s, d)]),
        _v(" (select key, 'declared' as side from v_old where key not in (select key from v_new)) union all (select key, 'actual' from v_new where key not in (select key from v_old))"),
    ),
    "ledger_intersection": (lambda s, d: inv.ledger_intersection(*(x.select("key") for x in old_and_new(s, d))), _v(" select key from v_old intersect select key from v_new")),
    "allow_list_semijoin": (
        lambda s, d: inventory(s, d).join(old_and_new(s, d)[1].select("bucket", "key"), ["bucket", "key"], "left_semi").select("bucket", "key", "size"),
        _v(" select bucket, key, size from v_inventory where key % 10 <> 1"),
    ),
    "delete_batches": (lambda s, d: inv.deletion_batches(inventory(s, d)).select("bucket", "key", "batch"), _v(" select bucket, key, (row_number() over (partition by bucket order by key) - 1) // 1000 as batch from v_inventory")),
    "chunk_plan": (
        lambda s, d: inv.chunk_plan(inventory(s, d), CHUNK),
        _v(f", {PLAN} select bucket, key, chunk_index, chunk_index * {CHUNK} as start, least((chunk_index + 1) * {CHUNK}, size) as \"end\" from plan"),
    ),
    "first_missing_chunk": (
        lambda s, d: inv.first_missing_chunk(p := inv.chunk_plan(inventory(s, d), CHUNK), p.where("(key + chunk_index) % 3 != 0")),
        _v(f", {PLAN} select bucket, key, min(chunk_index) as resume_at from plan where (key + chunk_index) % 3 = 0 group by all"),
    ),
    "package_overlap": (lambda s, d: inv.package_overlap(_packages(s, d)), f"with {ITEMS_SQL},{PACKAGES} select distinct * from shared_items"),
    "run_verification": (
        lambda s, d: inv.run_verification(_packages(s, d), _markers(s), 7),
        f"with {ITEMS_SQL},{PACKAGES} select 7::bigint as expected, 6::bigint as completed, 1::bigint as missing, 1::bigint as unexpected, (select count(distinct shard_id) from shared_items) as overlapping_shards, (select count(distinct item_id) from packages) as unique_items, 'INCOMPLETE' as state",
    ),
    "source_classification": (
        lambda s, d: reg.classify_sources(registry(s, d), registry(s, d).where("p_partkey % 11 = 0")),
        f"""with {REGISTRY_SQL} select dataset_id,
 case when p_partkey % 11 = 0 then 'COMPLETED_SKIP' when role <> 'raw' or training <> 'ALLOWED' or method in ('manual_gated', 'none') then 'GATED' else 'QUEUED' end as disposition,
 case when p_partkey % 11 = 0 then 'durably completed before this controller' when role <> 'raw' then 'role=' || role || ' is not a raw training source' when training <> 'ALLOWED' then 'training=' || training
      when method in ('manual_gated', 'none') then 'acquisition method=' || method || ' requires explicit external authority' else 'automated raw source with training ALLOWED' end as reason,
 estimate as estimate_bytes from v_registry""",
    ),
    "run_gate": (
        lambda s, d: registry(s, d).select("dataset_id", reg.run_gate(F.col("role"), F.col("training"), F.col("method")).alias("action")),
        f"with {REGISTRY_SQL} select dataset_id, case when role <> 'raw' then 'SKIP' when training <> 'ALLOWED' or method = 'manual_gated' then 'GATED_USER_ACTION_REQUIRED' else 'RUN' end as action from v_registry",
    ),
    "storage_guard": (
        lambda s, d: registry(s, d).select("dataset_id", reg.storage_guard(F.lit(5000), F.col("estimate"), 600, 3.0).alias("safe")),
        f"with {REGISTRY_SQL} select dataset_id, 5000 >= cast(floor(estimate * 3.0) as bigint) + 600 as safe from v_registry",
    ),
    "preflight_totals": (lambda s, d: reg.preflight(registry(s, d)), f"with {REGISTRY_SQL}, t as (select count(*) as sources, cast(sum(estimate) as bigint) as bytes from v_registry) select sources, bytes, bytes * 2 as bytes_x2, bytes * 3 as bytes_x3 from t"),
    "progress_summary": (
        lambda s, d: reg.progress(_progress_items(s, d)),
        f"""with {ITEMS_SQL}, p as (select doc_id % 9 <> 0 as done, case when doc_id % 9 <> 0 and receipt_status = 'ACCEPT' then canonical_hash end as h from v_items)
select count(*) as items, count(*) filter (where done) as complete, count(h) as accepted, count(*) filter (where done) - count(h) as rejected, count(distinct h) as distinct_hashes, greatest(0, count(h) - count(distinct h)) as duplicates from p""",
    ),
    "sample_audit": (
        lambda s, d: reg.sample_audit(_audit_items(s, d), 20),
        f"""with {ITEMS_SQL}, a as (select dataset_id, case when doc_id % 11 = 0 then null else coalesce(receipt_status, 'REJECT') end as status, row_number() over (partition by dataset_id order by stream_id) as place from v_items)
select dataset_id, count(*) as sample_size, count(*) filter (where status = 'ACCEPT') as accepted, count(*) filter (where status <> 'ACCEPT') as rejected, count(*) filter (where status is null) as execution_failures,
 count(*) filter (where status = 'ACCEPT') / count(*) as accept_rate, count(*) filter (where status <> 'ACCEPT') / count(*) as reject_rate from a where place <= 20 group by dataset_id""",
    ),
    "reason_counts": (
        lambda s, d: reg.reason_counts(_audit_items(s, d), 20),
        f"""with {ITEMS_SQL}, a as (select dataset_id, doc_id, row_number() over (partition by dataset_id order by stream_id) as place from v_items),
codes as (select dataset_id, 'A' as code from a where place <= 20 union all select dataset_id, 'B' from a where place <= 20 and doc_id % 2 = 1) select dataset_id, code, count(*) as streams from codes group by all""",
    ),
    "pedal_flattening": (_flattened, PEDALS),
    "conversion_receipts": (lambda s, d: tracks.conversion_receipts(_track_events(s, d), tracks.flatten_pedals(_track_events(s, d))).drop("track_index", "realtime_discarded"), RECEIPTS),
    "midi_round_trip": (
        lambda s, d: _midi_events(s, d).where("kind in ('note_on', 'note_off')").select("file", "tick", "kind", "data1", "data2"),
        f"""with {NOTES_SQL}
select stream_id as file, onset_tick as tick, 'note_on' as kind, cast(pitch % 12 + 60 as integer) as data1, cast(velocity as integer) as data2 from v_notes
union all select stream_id, onset_tick + duration_ticks, 'note_off', cast(pitch % 12 + 60 as integer), 0 from v_notes""",
    ),
    "track_inventory": (
        lambda s, d: tracks.track_inventory(_midi_events(s, d)).select("file", "track_index", "channels", "is_drum", "has_notes", "end_tick"),
        f"""with {NOTES_SQL}
select stream_id as file, cast(0 as integer) as track_index, [cast(0 as integer)] as channels, false as is_drum, true as has_notes, max(onset_tick + duration_ticks) as end_tick from v_notes group by stream_id""",
    ),
    "note_violations": (
        _violations,
        f"""with {NOTES_SQL} select 'velocity out of range' as rule, stream_id || ':' || note_index as key from v_notes where note_index % 40 = 0""",
    ),
    "record_violations": (
        _record_violations,
        f"""with {ITEMS_SQL}, r as (select stream_id as key, doc_id as n, receipt_status as s from v_items)
select 'unknown label' as rule, key from r where n % 5 = 4 union all select 'unknown split', key from r where n % 7 = 0 union all select 'unknown status', key from r where s is null
union all select 'receipt is not the declared one', key from r where n % 11 = 0 union all select 'accepted without a hash', key from r where s = 'ACCEPT' and n % 3 = 0
union all select 'rejected without a reason', key from r where s = 'REJECT' and n % 2 = 1 union all select 'wrong number of siblings', key from r where n % 4 <> 3
union all select 'record repeats', key from r group by key having count(*) > 1""",
    ),
    "split_violations": (
        _split_violations,
        f"""with {ITEMS_SQL}, s as (select canonical_hash, {SPLIT} as split from (select canonical_hash, cast(piece_id as varchar) as p from v_items))
select 'hash in two splits' as rule, canonical_hash as key from s group by canonical_hash having min(split) <> max(split)""",
    ),
    "dedupe_violations": (
        lambda s, d: validation.dedupe_violations(dedupe.first_owner(items(s, d)).withColumn("status", F.when(F.col("shard_id") == 3, "DUPLICATE").otherwise(F.col("status")))),
        f"""with {ITEMS_SQL}, owners as (select canonical_hash, first(shard_id order by shard_id, stream_id) as k from v_items group by canonical_hash)
select 'hash without one owner' as rule, canonical_hash as key from owners where k = 3""",
    ),
    "first_streams": (
        lambda s, d: validation.first_streams(validation.confidence(notes(s, d)), 25),
        f"with {NOTES_SQL} select stream_id, least(1.0, count(*) / 8) as tonal_confidence from v_notes group by stream_id order by stream_id limit 25",
    ),
    "pending_items": (
        lambda s, d: validation.pending(items(s, d).select("stream_id"), items(s, d).select("stream_id", F.when(F.col("doc_id") % 3 == 0, "COMPLETE").otherwise("FAILED").alias("state")), ["stream_id"]),
        f"with {ITEMS_SQL} select stream_id from v_items where doc_id % 3 <> 0",
    ),
    "next_fit_packs": (_packs, PACKS),
    "semantic_hash": (_semantic, f"""with {ITEMS_SQL} select stream_id, sha256('{{"dataset_id":"' || dataset_id || '","piece_id":' || piece_id || ',"shard_id":' || shard_id || '}}') as semantic_sha256 from v_items"""),
    "realtime_stripping": (
        lambda s, d: tracks.strip_realtime(_deltas(s, d)).select("file", "seq", "delta", "kind"),
        f"""with {NOTES_SQL},
timed as (select stream_id as file, note_index + 1 as seq, onset_tick as tick, case when note_index % 3 = 1 then 'realtime' else 'note_on' end as kind, max(onset_tick) over (partition by stream_id) as last_tick, row_number() over (partition by stream_id order by note_index desc) as back from v_notes),
kept as (select *, row_number() over (partition by file order by seq desc) as final from timed where kind <> 'realtime')
select file, seq, tick - coalesce(lag(tick) over (partition by file order by seq), 0) as delta, kind from kept
union all select file, seq + 1, last_tick - tick, 'end_of_track' from kept where final = 1 and last_tick > tick""",
    ),
}


def _deltas(s, d):
    w = W.partitionBy("file").orderBy("seq")
    rows = notes(s, d).select(F.col("stream_id").alias("file"), F.lit(0).alias("track_index"), (F.col("note_index") + 1).alias("seq"), "onset_tick", F.when(F.col("note_index") % 3 == 1, "realtime").otherwise("note_on").alias("kind"))
    return rows.withColumn("delta", F.col("onset_tick") - F.coalesce(F.lag("onset_tick").over(w), F.lit(0))).drop("onset_tick")
