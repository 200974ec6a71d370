"""Queries over derived streams: identities, dedupe, receipts, families, caps, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaver.functions import ids
from quaver.operators import dedupe, profile
from quaver.plans import snapshot
from quaver.plans.adapters import ITEMS_SQL, SHARDS, SPANS_SQL, items, spans
from quaver.session import materialize, scratch_path, table
from quaver.streaming import durable

CAPS_SQL = "(select unnest([64, 96, 128, 160, 192, 224, 256]) as cap)"


def _i(body: str) -> str:
    return f"with recursive {ITEMS_SQL}{body}"


def _s(body: str) -> str:
    return f"with {SPANS_SQL}{body}"


OUTCOME = """
outcomes as (
  select *, case when receipt_status = 'REJECT' and cached_status = 'ACCEPT' then 'reclassified_reject'
                 when receipt_status = 'REJECT' then 'explicit_reject'
                 when receipt_status is null and cached_status = 'REJECT' then 'legacy_reject'
                 when receipt_status is null and cached_status = 'ACCEPT' then 'error_unproven_accept'
                 when receipt_status is null then 'skipped'
                 else 'accepted' end as outcome
  from v_items)"""
OWNERS = """
owners as (
  select canonical_hash, first(stream_id order by shard_id, stream_id) as kept_stream_id, first(shard_id order by shard_id, stream_id) as kept_shard_id, count(*) as occurrence_count
  from v_items group by canonical_hash)"""
WINNERS = "winners as (select canonical_hash, first(dataset_id order by dataset_id, stream_id) as dataset_id, first(stream_id order by dataset_id, stream_id) as stream_id from v_items group by canonical_hash)"
FAMILY = """
members as (select distinct cast(piece_id as varchar) as p, canonical_hash as h from v_items),
links as (select distinct a.p as p, b.p as q from members a join members b using (h)),
reach(p, q) as (select p, q from links union select reach.p, links.q from reach join links on reach.q = links.p),
roots as (select p as piece_id, min(q) as root from reach group by p),
families as (
  select piece_id, root, 'family_' || substr(sha256(string_agg(piece_id, ',') over (partition by root order by piece_id rows between unbounded preceding and unbounded following)), 1, 24) as family_id
  from roots)"""


def split_sql(key: str) -> str:
    bucket = f"cast('0x' || substr(sha256({key}), 1, 8) as ubigint) % 1000"
    return f"case when {bucket} < 800 then 'train' when {bucket} < 900 then 'validation' else 'test' end"


def profile_sql(length: str = "length") -> str:
    return _PROFILE.replace("@length", length)


_PROFILE = f"""
measured as (select stream_id, @length as length from v_spans),
streams as (select stream_id, count(*) as bars, max(length) as longest from measured group by all),
profile as (
  select cap, count(*) filter (where length <= cap) as bars_fit, count(*) as bars_total,
         (select count(*) from streams where longest <= cap) as whole_streams_fit, (select count(*) from streams) as whole_streams_total,
         sum(cap - length) / (cap * count(*)) as pad_ratio
  from measured, {CAPS_SQL} group by cap)"""


SELECTED = """, covered as (select *, bars_fit >= 0.99 * bars_total and whole_streams_fit >= 0.99 * whole_streams_total as ok from profile),
selected as (select coalesce(min(cap) filter (where ok), first(cap order by whole_streams_fit desc, bars_fit desc, cap)) as cap from covered)"""
SNAPSHOT = f"""with recursive {ITEMS_SQL},{OUTCOME},
accepted as (select * from outcomes where outcome = 'accepted'),{FAMILY.replace('from v_items', 'from accepted')},
winners as (select canonical_hash, first(stream_id order by dataset_id, stream_id) as stream_id, first(cast(piece_id as varchar) order by dataset_id, stream_id) as piece_id from accepted group by canonical_hash),
chosen as (select stream_id, family_id, {split_sql('family_id')} as split from winners join families using (piece_id)),
lines as (select 'd' || doc_id as stream_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as bar_index from documents),
v_spans as (select stream_id, bar_index, family_id, split, list_transform(list_filter(string_split(line, ' '), lambda w: w <> ''), lambda w: length(w)) as ids, len(ids) as length from lines join chosen using (stream_id)),{profile_sql()}{SELECTED},
kept as (select *, list_resize(ids, cap, 0) as padded from v_spans, selected where stream_id not in (select stream_id from v_spans, selected where length > cap)),
ahead as (
  select *, list(length) over w as lengths, list(padded) over w as blocks, count(*) over w as n, min(length) over w as least
  from kept window w as (partition by stream_id order by bar_index rows between current row and 3 following))
select row_number() over (order by stream_id, bar_index) - 1 as window_index, stream_id, family_id, split, bar_index as start_bar, cap, lengths, sha256(array_to_string(flatten(blocks), ',')) as ids_sha256
from ahead where n = 4 and least > 0"""


CHOICE = """, covered as (select *, bars_fit >= 0.99 * bars_total and whole_streams_fit >= 0.99 * whole_streams_total as ok from profile)
select coalesce(min(cap) filter (where ok), first(cap order by whole_streams_fit desc, bars_fit desc, cap)) as selected_cap, bool_or(ok) as covered from covered"""


def _split_spans(s, d):
    return spans(s, d).withColumn("split", ids.hash_split(F.col("stream_id")))


def _split_counters(s, d):
    bars = _split_spans(s, d)
    windows = profile.block_windows(bars).withColumn("split", ids.hash_split(F.col("stream_id")))
    return profile.split_counters(bars, windows)


def _padded(s, d):
    """Bars of the streams that fit whole, filled up to the selected cap."""
    bars = spans(s, d)
    cap = profile.cap_choice(bars).first().selected_cap
    rows = bars.join(bars.where(F.col("length") > cap).select("stream_id").distinct(), "stream_id", "left_anti")
    rows = rows.withColumn("ids", F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("length")), lambda i: i + F.col("bar_index")))
    return profile.padded(rows, "ids", cap).select("stream_id", "bar_index", "ids", "mask")


def bars(s, d):
    """Lines of documents as bars of words; a word's id is its length."""
    lines = table(s, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stream_id"), F.posexplode(F.split("text", "\n")).alias("bar_index", "line"))
    words = F.filter(F.split("line", " "), lambda w: w != "")
    return lines.select("stream_id", F.col("bar_index").cast("bigint").alias("bar_index"), F.transform(words, lambda w: F.length(w).cast("bigint")).alias("ids"), (F.size(words) == 0).alias("is_empty"))


def _snapshot(s, d):
    windows = snapshot.build(items(s, d), bars(s, d))["windows"]
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return windows.select("window_index", "stream_id", "family_id", "split", "start_bar", "cap", "lengths", F.sha2(joined, 256).alias("ids_sha256"))


def _consolidated(s, d):
    rows = materialize(items(s, d).select("stream_id", "shard_id", "canonical_hash"), "packages")
    run = durable.Run(s, scratch_path(s, "consolidation"))
    run.run(range(SHARDS), lambda shard: rows, lambda shard: rows.where(F.col("shard_id") == shard))
    return run.rows()


def _replaced(s, d):
    """Every fifth stream rebuilt with its even bars only."""
    rows = spans(s, d).select("stream_id", "bar_index", "length")
    again = rows.where((F.substring("stream_id", 2, 20).cast("bigint") % 5 == 0) & (F.col("bar_index") % 2 == 0))
    return dedupe.replace_streams(rows, again.withColumn("length", F.col("length") + 1000))


def _tracks(s, d):
    return items(s, d).select("piece_id", F.col("stream_id").alias("track_id"), F.col("doc_id").alias("track_index"), (F.col("doc_id") % 5 == 0).alias("is_drum"), (F.col("doc_id") % 7 != 0).alias("has_notes"))


def _upsert(last):
    def run(s, d):
        rows = items(s, d).select("canonical_hash", "stream_id", F.col("doc_id").alias("seq"))
        return dedupe.upsert(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"), ["canonical_hash"], "seq", last)

    return run


def _partial_upsert(s, d):
    rows = items(s, d).select("stream_id", "dataset_id", "piece_id", "shard_id", "doc_id")
    old = rows.where("doc_id % 3 != 0").drop("doc_id")
    new = rows.where("doc_id % 3 != 1").withColumn("dataset_id", F.lit("moved")).withColumn("piece_id", -F.col("piece_id")).drop("doc_id")
    return dedupe.partial_upsert(old, new, ["stream_id"], ["dataset_id"])


TABLE = {
    "hash_partition": (lambda s, d: items(s, d).select("stream_id", "shard_id"), _i(" select stream_id, shard_id from v_items")),
    "hash_split": (lambda s, d: items(s, d).select("stream_id", ids.hash_split(F.col("stream_id")).alias("split")), _i(f" select stream_id, {split_sql('stream_id')} as split from v_items")),
    "stable_ids": (
        lambda s, d: items(s, d).select("stream_id", ids.stable_id("stream", F.col("dataset_id"), F.col("stream_id")).alias("id")),
        _i(""" select stream_id, 'stream_' || substr(sha256('["' || dataset_id || '","' || stream_id || '"]'), 1, 24) as id from v_items"""),
    ),
    "dedupe_first_owner": (
        lambda s, d: dedupe.first_owner(items(s, d)),
        _i(f",{OWNERS} select stream_id, shard_id, v.canonical_hash, case when stream_id = kept_stream_id then 'UNIQUE' else 'DUPLICATE' end as status, kept_stream_id, kept_shard_id, occurrence_count from v_items v join owners using (canonical_hash)"),
    ),
    "dedupe_winner": (lambda s, d: dedupe.winners(items(s, d)), _i(f", {WINNERS} select * from winners")),
    "dedupe_in_order": (
        lambda s, d: dedupe.winners(items(s, d), ("piece_id", "doc_id")),
        _i(" select canonical_hash, first(piece_id order by piece_id, doc_id) as piece_id, first(doc_id order by piece_id, doc_id) as doc_id from v_items group by canonical_hash"),
    ),
    "provenance_edges": (
        lambda s, d: dedupe.provenance_edges(items(s, d)),
        _i(f", {WINNERS} select v.stream_id, v.dataset_id, canonical_hash, w.stream_id as kept_stream_id from v_items v join winners w using (canonical_hash)"),
    ),
    "occurrence_counts": (lambda s, d: dedupe.occurrence_counts(items(s, d)), _i(f",{OWNERS} select * from owners")),
    "raw_duplicates": (
        lambda s, d: items(s, d).groupBy("canonical_hash").agg(F.count("*").alias("n")).where("n > 1"),
        _i(" select canonical_hash, count(*) as n from v_items group by all having count(*) > 1"),
    ),
    "receipt_outcomes": (lambda s, d: dedupe.reconcile(items(s, d)).select("stream_id", "outcome"), _i(f",{OUTCOME} select stream_id, outcome from outcomes")),
    "receipt_reconcile": (
        lambda s, d: dedupe.reconciliation_counts(items(s, d)),
        _i(
            f""",{OUTCOME} select shard_id, count(*) filter (where outcome = 'accepted') as accepted, count(*) filter (where outcome in ('explicit_reject', 'reclassified_reject')) as explicit_rejects,
 count(*) filter (where outcome = 'reclassified_reject') as reclassified_rejects, count(*) filter (where outcome = 'legacy_reject') as legacy_rejects,
 count(*) filter (where outcome = 'skipped') as skipped, count(*) filter (where outcome like 'error%') as errors from outcomes group by shard_id"""
        ),
    ),
    "family_components": (lambda s, d: dedupe.families(items(s, d)), _i(f",{FAMILY} select * from families")),
    "family_split": (lambda s, d: dedupe.family_split(items(s, d)), _i(f",{FAMILY} select piece_id, family_id, {split_sql('family_id')} as split from families")),
    "sibling_tracks": (
        lambda s, d: dedupe.sibling_tracks(_tracks(s, d)),
        _i(
            """, tracks as (select piece_id, stream_id as track_id, doc_id from v_items)
select t.piece_id, t.track_id, list_filter((select list(o.track_id order by o.doc_id) from tracks o where o.piece_id = t.piece_id), lambda x: x <> t.track_id) as siblings
from tracks t where t.doc_id % 5 <> 0 and t.doc_id % 7 <> 0"""
        ),
    ),
    "upsert_last_wins": (_upsert(True), _i(" select canonical_hash, last(stream_id order by doc_id) as stream_id, max(doc_id) as seq from v_items group by all")),
    "upsert_first_wins": (_upsert(False), _i(" select canonical_hash, first(stream_id order by doc_id) as stream_id, min(doc_id) as seq from v_items group by all")),
    "upsert_partial": (
        _partial_upsert,
        _i(" select stream_id, case when doc_id % 3 <> 1 then 'moved' else dataset_id end as dataset_id, case when doc_id % 3 = 0 then -piece_id else piece_id end as piece_id, shard_id from v_items"),
    ),
    "replace_streams": (
        _replaced,
        _s(" select stream_id, bar_index, length from v_spans where cast(substr(stream_id, 2) as bigint) % 5 <> 0 union all select stream_id, bar_index, length + 1000 from v_spans where cast(substr(stream_id, 2) as bigint) % 5 = 0 and bar_index % 2 = 0"),
    ),
    "length_percentiles": (
        lambda s, d: profile.length_percentiles(spans(s, d)),
        _s(" select " + ", ".join(f"quantile_disc(length, {p / 100}) as p{p}" for p in profile.PERCENTS) + ", max(length) as max from v_spans"),
    ),
    "cap_profile": (
        lambda s, d: profile.cap_profile(spans(s, d)),
        _s(f",{profile_sql()} select *, bars_total - bars_fit as overflow_bars, whole_streams_total - whole_streams_fit as overflow_streams, bars_fit / bars_total as bar_coverage, whole_streams_fit / whole_streams_total as stream_coverage from profile"),
    ),
    "cap_choice": (
        lambda s, d: profile.cap_choice(spans(s, d)),
        _s(
            f",{profile_sql()}{CHOICE}"
        ),
    ),
    "cap_choice_covered": (
        lambda s, d: profile.cap_choice(spans(s, d).withColumn("length", F.least("length", F.lit(200).cast("bigint")))),
        _s(f",{profile_sql('least(length, 200)')}{CHOICE}"),
    ),
    "label_breakdown": (
        lambda s, d: profile.label_breakdown(spans(s, d), ("user", "assistant", "system", "tool")),
        _s(
            f""", per as (select label, stream_id, count(*) as bars, max(length) as longest from v_spans group by all),
bars as (select cap, label, count(*) as bars, count(*) filter (where length <= cap) as bars_fit from v_spans, {CAPS_SQL} group by all),
streams as (select cap, label, count(*) as streams, count(*) filter (where longest <= cap) as whole_streams_fit from per, {CAPS_SQL} group by all)
select c.cap, l.label, coalesce(streams, 0) as streams, coalesce(bars, 0) as bars, coalesce(bars_fit, 0) as bars_fit, coalesce(whole_streams_fit, 0) as whole_streams_fit,
       coalesce(bars_fit / bars, 0.0::double) as bar_coverage, coalesce(whole_streams_fit / streams, 0.0::double) as stream_coverage
from {CAPS_SQL} c cross join (select unnest(['user', 'assistant', 'system', 'tool']) as label) l left join bars on bars.cap = c.cap and bars.label = l.label left join streams on streams.cap = c.cap and streams.label = l.label"""
        ),
    ),
    "length_histogram": (lambda s, d: profile.length_histogram(spans(s, d)), _s(" select length, count(*) as n from v_spans v where bar_index > (select min(bar_index) from v_spans w where w.stream_id = v.stream_id) group by all")),
    "split_counters": (
        _split_counters,
        _s(
            f""", named as (select *, {split_sql('stream_id')} as split, count(*) over w as n, max(is_empty::int) over w as hole from v_spans window w as (partition by stream_id order by bar_index rows between current row and 3 following))
select split, count(distinct stream_id) as streams, count(*) as bars, cast(sum(length) as bigint) as tokens, count(*) filter (where n = 4 and hole = 0) as windows from named group by split"""
        ),
    ),
    "snapshot_windows": (
        lambda s, d: profile.number_windows(profile.block_windows(spans(s, d)), ["stream_id", "start_bar"]),
        _s(
            """, ahead as (select stream_id, bar_index, list(length) over w as lengths, count(*) over w as n, max(is_empty::int) over w as hole from v_spans window w as (partition by stream_id order by bar_index rows between current row and 3 following))
select stream_id, bar_index as start_bar, lengths, row_number() over (order by stream_id, bar_index) - 1 as window_index from ahead where n = 4 and hole = 0"""
        ),
    ),
    "poc_windows": (
        lambda s, d: profile.block_windows(spans(s, d), empty_allowed=True),
        _s(
            """, ahead as (select stream_id, bar_index, list(length) over w as lengths, count(*) over w as n from v_spans window w as (partition by stream_id order by bar_index rows between current row and 3 following))
select stream_id, bar_index as start_bar, lengths from ahead where n = 4"""
        ),
    ),
    "padded_blocks": (
        _padded,
        _s(
            f""",{profile_sql()}{SELECTED}
select stream_id, bar_index, list_transform(range(1, cap + 1), lambda i: case when i <= length then i + bar_index else 0 end) as ids, list_transform(range(1, cap + 1), lambda i: i <= length) as mask
from v_spans, selected where stream_id not in (select stream_id from v_spans, selected where length > cap)"""
        ),
    ),
    "snapshot_build": (_snapshot, SNAPSHOT),
    "consolidate_run": (
        _consolidated,
        _i(f",{OWNERS} select stream_id, shard_id, v.canonical_hash, case when stream_id = kept_stream_id then 'UNIQUE' else 'DUPLICATE' end as status, kept_stream_id, kept_shard_id from v_items v join owners using (canonical_hash)"),
    ),
}
