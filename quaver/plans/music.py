"""Queries over note events: canonical tables, sweeps, projection and bar controls."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaver.operators import canonical, controls, projection, summary, sweep
from quaver.plans.adapters import NOTES_SQL, notes

BAR = ["stream_id", "bar_index"]

CLIPPED = """
clipped as (
  select stream_id, bar_index, note_index, onset_tick, duration_ticks, pitch, velocity,
         greatest(onset_tick, bar_index * 1920) as l, least(end_tick, (bar_index + 1) * 1920) as r
  from (select *, unnest(range(onset_bar, end_bar + 1)) as bar_index from c_notes))"""
SWEEP = """
edges as (select stream_id, bar_index, l as t, 1 as d from clipped union all select stream_id, bar_index, r, -1 from clipped),
net as (select stream_id, bar_index, t, sum(d) as d from edges group by all),
steps as (
  select stream_id, bar_index, sum(d) over w as active, coalesce(lead(t) over w - t, 0) as held
  from net window w as (partition by stream_id, bar_index order by t)),
poly as (
  select stream_id, bar_index, cast(max(active) as bigint) as max_voices,
         sum(case when active >= 1 then held else 0 end) / 1920.0 as occupied,
         sum(case when active >= 2 then held else 0 end) / 1920.0 as polyphonic_fraction
  from steps group by all),
voices as (select stream_id, bar_index, sum(r - l) / 1920.0 as time_weighted_voices from clipped group by all)"""
LOCAL = """
own as (
  select *, onset_bar as bar_index, row_number() over (partition by stream_id, onset_bar order by onset_tick, pitch, velocity, note_index) as rank from c_notes),
groups as (select stream_id, bar_index, onset_tick, median(pitch) as reduced from own group by all),
onsets as (
  select *, row_number() over w as rank, lead(onset_tick) over w - onset_tick as ioi, lead(reduced) over w - reduced as step
  from groups window w as (partition by stream_id, bar_index order by onset_tick))"""
PROJECTED = """
sounding as (select distinct stream_id, unnest(range(onset_bar, end_bar + 1)) as bar_index from c_notes),
occupied as (select g.stream_id, g.bar_index, s.bar_index is not null as occupied from grid g left join sounding s on g.stream_id = s.stream_id and g.bar_index = s.bar_index),
runs as (
  select *, case when occupied then bar_index - row_number() over (partition by stream_id, occupied order by bar_index) end as run,
         count(*) over (partition by stream_id) as source_bar_count
  from occupied),
bounds as (
  select *, case when occupied then min(bar_index) over (partition by stream_id, run) end as first_bar,
         case when occupied then max(bar_index) over (partition by stream_id, run) end as last_bar
  from runs),
live as (
  select *, case when occupied then stream_id || ':' || substr(sha256('{"end_bar_index":' || last_bar || ',"schema":"quaver.live-projection/v1","start_bar_index":' || first_bar || ',"stream_id":"' || stream_id || '"}'), 1, 24) end as segment_id,
         bar_index - first_bar as segment_position, (bar_index + 0.5) / source_bar_count as source_position
  from bounds)"""
#: The three scalar controls of every bar, with its lifecycle fields, data set and split.
ROWS = """
turns as (
  select stream_id, bar_index, case when lead(d) over (partition by stream_id, bar_index order by rank) <> d then 1 else 0 end as turn
  from (select stream_id, bar_index, rank, sign(step) as d from onsets) where d <> 0),
reversal as (select stream_id, bar_index, sum(turn) / greatest(1, count(*) - 1) as r from turns group by all),
density as (select stream_id, bar_index, count(*) / 4.0 as n from onsets group by all),
feature_rows as (
  select live.*, coalesce(density.n, 0) as rhythmic_density, coalesce(poly.occupied, 0) as occupancy, coalesce(reversal.r, 0) as contour_reversal,
         'set' || cast(substr(live.stream_id, 2) as bigint) % 3 as dataset_id,
         case cast(substr(live.stream_id, 2) as bigint) % 4 when 0 then 'train' when 1 then 'test' end as split
  from live left join density using (stream_id, bar_index) left join poly using (stream_id, bar_index) left join reversal using (stream_id, bar_index)),
labelled as (
  select feature_rows.*, policy,
         case policy
           when 'fixed-bar' then case when bar_index = 0 then 'START' when bar_index = source_bar_count - 1 then 'END' else 'CRUISE' end
           when 'fractional-position' then case when source_position < 0.25 then 'START' when source_position >= 0.75 then 'END' else 'CRUISE' end
           when 'asymmetric' then case when source_position < 0.20 then 'START' when source_position >= 0.80 then 'END' else 'CRUISE' end
           else case when bar_index = 0 or source_position < 0.20 then 'START' when bar_index = source_bar_count - 1 or source_position >= 0.80 then 'END' else 'CRUISE' end
         end as label
  from feature_rows, (select unnest(['fixed-bar', 'fractional-position', 'asymmetric', 'hybrid']) as policy))"""


def feature_rows(spark, sf_dir):
    """The scalar controls of every bar, with lifecycle fields, data set and split."""
    n = notes(spark, sf_dir)
    live = projection.live_bars(n)
    poly = sweep.polyphony(n).select(*BAR, F.col("occupied").alias("occupancy"))
    number = F.substring("stream_id", 2, 20).cast("bigint")
    return (
        live
        .join(controls.rhythmic_density(n), BAR)
        .join(controls.contour_reversals(n), BAR)
        .join(poly, BAR, "left")
        .withColumn("occupancy", F.coalesce("occupancy", F.lit(0.0)))
        .withColumn("dataset_id", F.concat(F.lit("set"), (number % 3).cast("string")))
        .withColumn("split", F.when(number % 4 == 0, "train").when(number % 4 == 1, "test"))
    )


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _sql(ctes: str, body: str) -> str:
    return f"with {NOTES_SQL}{',' if ctes else ''}{ctes}\n{body}"


def _spans(spark, sf_dir):
    n = notes(spark, sf_dir)
    bars = projection.live_bars(n)
    return projection.eligible_windows(projection.number_spans(bars.select(*BAR)), bars)


def _characterization(spark, sf_dir):
    return rounded(summary.characterize(feature_rows(spark, sf_dir)), "mean", "std", "p10", "p50", "p90")


_CHARACTERIZED = """
longform as (
  select unnest([{'control': 'rhythmic_density', 'v': rhythmic_density}, {'control': 'occupancy', 'v': occupancy}, {'control': 'contour_reversal', 'v': contour_reversal}], recursive := true) from feature_rows),
stats as (
  select control, count(v) as present, count(*) - count(v) as missing, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std,
         round(quantile_disc(v, 0.1), 6) as p10, round(quantile_disc(v, 0.5), 6) as p50, round(quantile_disc(v, 0.9), 6) as p90
  from longform group by control),
every as (
  select * from stats union all by name
  select unnest(['polyphony', 'articulation', 'time_signature', 'key_tonal_center', 'pitch_trend', 'interval_magnitude', 'register', 'pitch_span',
                 'note_duration_tendency', 'microtiming_grid_rigidity', 'pitch_class_diversity', 'lifecycle']) as control, count(*) as present, 0 as missing from feature_rows),
characterized as (select *, case when present > 0 then 'ACCEPTED_FOR_MODELING' else 'DEFERRED' end as status from every)"""

TABLE = {
    "bar_polyphony": (lambda s, d: sweep.polyphony(notes(s, d)), _sql(f"{CLIPPED},{SWEEP}", "select * from poly")),
    "bar_voices": (lambda s, d: sweep.voices(notes(s, d)), _sql(f"{CLIPPED},{SWEEP}", "select * from voices")),
    "bar_occupancy_diff": (
        lambda s, d: canonical.canonical_bars(notes(s, d)).select(*BAR, "is_empty"),
        _sql("", "select g.stream_id, g.bar_index, not exists (select 1 from c_notes n where n.stream_id = g.stream_id and n.onset_bar <= g.bar_index and n.end_bar >= g.bar_index) as is_empty from grid g"),
    ),
    "canonical_bars": (
        lambda s, d: canonical.canonical_bars(notes(s, d)),
        _sql(f"{PROJECTED}", "select stream_id, bar_index, bar_index * 1920 as start_tick, (bar_index + 1) * 1920 as end_tick, 4.0::double as beats, not occupied as is_empty from occupied"),
    ),
    "canonical_notes": (
        lambda s, d: canonical.canonical_notes(notes(s, d)),
        _sql("", "select stream_id, note_index, onset_tick, duration_ticks, end_tick, pitch, velocity, onset_bar as onset_bar_index, end_bar as end_bar_index, onset_tick % 1920 as onset_in_bar_tick from c_notes"),
    ),
    "bar_primitive_features": (
        lambda s, d: rounded(sweep.primitive_features(notes(s, d)), "mean_velocity"),
        _sql(
            f"{CLIPPED},{SWEEP},{LOCAL}",
            """, own_bars as (
  select stream_id, bar_index, count(*) as note_count, median(duration_ticks) as median_duration, median(pitch) as median_pitch,
         max(pitch) - min(pitch) as pitch_range, round(avg(velocity), 6) as mean_velocity
  from own group by all)
select g.stream_id, g.bar_index, coalesce(note_count, 0) as note_count, coalesce(note_count, 0) as onset_count,
       coalesce(note_count, 0) / 4.0::double as notes_per_beat, coalesce(note_count, 0) / 4.0::double as onsets_per_beat,
       coalesce(time_weighted_voices, 0)::double as mean_polyphony, coalesce(max_voices, 0) as max_polyphony,
       coalesce(occupied, 0)::double as occupied_fraction, 1 - coalesce(occupied, 0)::double as rest_fraction,
       median_duration, median_pitch, pitch_range, mean_velocity
from grid g left join own_bars using (stream_id, bar_index) left join poly using (stream_id, bar_index) left join voices using (stream_id, bar_index)""",
        ).replace("\n, own_bars", ", own_bars"),
    ),
    "live_bars": (
        lambda s, d: projection.live_bars(notes(s, d)),
        _sql(PROJECTED, "select stream_id, bar_index, bar_index * 1920 as start_tick, (bar_index + 1) * 1920 as end_tick, occupied, source_bar_count, source_position::double as source_position, segment_id, segment_position, last_bar - first_bar + 1 as segment_bars from live"),
    ),
    "live_segments": (
        lambda s, d: projection.live_segments(notes(s, d)),
        _sql(PROJECTED, "select stream_id, segment_id, min(bar_index) as first_bar, max(bar_index) as last_bar, count(*) as n_bars from live where occupied group by all"),
    ),
    "eligible_windows": (
        _spans,
        _sql(
            f"""{PROJECTED},
numbered as (select *, row_number() over (partition by stream_id order by bar_index) - 1 as span_index from live),
ahead as (
  select stream_id, span_index as start_span_index, segment_id, list(bar_index) over w as bar_indices, count(segment_id) over w as n, min(segment_id) over w as a, max(segment_id) over w as b
  from numbered window w as (partition by stream_id order by span_index rows between current row and 3 following))""",
            "select stream_id, cast(start_span_index as integer) as start_span_index, a as segment_id, bar_indices from ahead where n = 4 and a = b",
        ),
    ),
    "rhythmic_density": (
        lambda s, d: controls.rhythmic_density(notes(s, d)),
        _sql(LOCAL, "select g.stream_id, g.bar_index, coalesce(n, 0) / 4.0::double as rhythmic_density from grid g left join (select stream_id, bar_index, count(*) as n from onsets group by all) using (stream_id, bar_index)"),
    ),
    "pitch_entropy": (
        lambda s, d: rounded(controls.pitch_entropy(notes(s, d)), "entropy"),
        _sql(
            f"{LOCAL}, counts as (select stream_id, bar_index, pitch % 12 as pc, count(*) as n from own group by all), shares as (select *, n / sum(n) over (partition by stream_id, bar_index) as p from counts)",
            "select stream_id, bar_index, count(*) as unique_count, round(-sum(p * log2(p)), 6) + 0.0 as entropy from shares group by all",
        ),
    ),
    "tonal_center": (
        lambda s, d: controls.tonal_center(notes(s, d)),
        _sql(
            f"{LOCAL}, counts as (select stream_id, bar_index, pitch % 12 as pc, count(*) as n from own group by all), placed as (select *, row_number() over (partition by stream_id, bar_index order by n desc, pc desc) as place, row_number() over (partition by stream_id, bar_index order by n, pc desc) as low from counts)",
            """select stream_id, bar_index, max(case when low = 1 then pc end) as tonic_pc, max(case when place = 1 then pc end) as modal_pc,
       (max(case when place = 1 then n end) - max(case when place = 2 then n end)) / sum(n) as score_margin, cast(sum(n) as bigint) as evidence_count from placed group by all""",
        ),
    ),
    "theil_sen_trend": (
        lambda s, d: rounded(controls.pitch_trend(notes(s, d)), "theil_sen"),
        _sql(
            f"{LOCAL}, slopes as (select a.stream_id, a.bar_index, (b.reduced - a.reduced) / (b.onset_tick - a.onset_tick) as slope from onsets a join onsets b on a.stream_id = b.stream_id and a.bar_index = b.bar_index and a.rank < b.rank), ends as (select stream_id, bar_index, max_by(reduced, rank) - min_by(reduced, rank) as first_last from onsets group by all)",
            "select stream_id, bar_index, round(median(slope), 6) as theil_sen, any_value(first_last) as first_last from slopes join ends using (stream_id, bar_index) group by all",
        ),
    ),
    "contour_reversals": (
        lambda s, d: controls.contour_reversals(notes(s, d)),
        _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS}", "select stream_id, bar_index, contour_reversal::double as contour_reversal from feature_rows"),
    ),
    "interval_magnitude": (
        lambda s, d: controls.interval_magnitude(notes(s, d)),
        _sql(LOCAL, "select stream_id, bar_index, median(abs(step)) as median_abs_interval, quantile_disc(abs(step), 0.9) as p90_abs_interval from onsets where step is not null group by all"),
    ),
    "pitch_span": (
        lambda s, d: controls.pitch_span(notes(s, d)),
        _sql(LOCAL, "select stream_id, bar_index, median(pitch) as median_pitch, (quantile_disc(pitch, 0.9) - quantile_disc(pitch, 0.1))::double as p90_p10, max(pitch) - min(pitch) as absolute from own group by all"),
    ),
    "duration_tendency": (
        lambda s, d: controls.duration_tendency(notes(s, d)),
        _sql(LOCAL, "select stream_id, bar_index, quantile_disc(duration_ticks, 0.25)::double as p25, median(duration_ticks) as median, quantile_disc(duration_ticks, 0.75)::double as p75 from own group by all"),
    ),
    "grid_rigidity": (
        lambda s, d: controls.grid_rigidity(notes(s, d)),
        _sql(LOCAL, "select stream_id, bar_index, avg(case when onset_tick % 1920 % 480 = 0 then 1.0 else 0.0 end) as exact_grid_fraction, cast(sum(onset_tick % 1920 % 480) as bigint) as residual_sum, 480::bigint as declared_resolution_ticks from onsets group by all"),
    ),
    "articulation": (
        lambda s, d: rounded(controls.articulation(notes(s, d)), "median_duration_to_next_onset"),
        _sql(LOCAL, "select stream_id, bar_index, round(median(own.duration_ticks / ioi), 6) as median_duration_to_next_onset from own join onsets using (stream_id, bar_index, rank) where ioi > 0 group by all"),
    ),
    "overlap_pairs": (
        lambda s, d: controls.overlap_pairs(notes(s, d)),
        _sql(LOCAL, "select a.stream_id, a.bar_index, count(b.note_index) as overlap_count from own a left join own b on a.stream_id = b.stream_id and a.bar_index = b.bar_index and a.rank < b.rank and a.onset_tick < b.end_tick and b.onset_tick < a.end_tick group by all"),
    ),
    "characterization": (_characterization, _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS},{_CHARACTERIZED}", "select control, present, missing, mean, std, p10, p50, p90, status from characterized")),
    "control_status": (
        lambda s, d: summary.control_status(feature_rows(s, d)),
        _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS},{_CHARACTERIZED}", "select control, status, case when present > 0 then 'observed in synthetic or canonical-derived rows' else 'no non-missing observations' end as reason, present, missing from characterized"),
    ),
    "lifecycle_labels": (
        lambda s, d: summary.labelled(feature_rows(s, d)).select("policy", *BAR, "label"),
        _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS}", "select policy, stream_id, bar_index, label from labelled"),
    ),
    "lifecycle_crosstab": (
        lambda s, d: summary.lifecycle_crosstab(feature_rows(s, d)),
        _sql(
            f"""{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS},
scoped as (
  select policy, 'all' as scope, '' as value, label from labelled union all select policy, 'dataset', dataset_id, label from labelled
  union all select policy, 'split', coalesce(split, 'UNASSIGNED'), label from labelled),
cells as (select policy, scope, value, unnest(['START', 'CRUISE', 'END']) as label from (select distinct policy, scope, value from scoped))""",
            "select policy, scope, value, label, count(s.label) as n from cells left join scoped s using (policy, scope, value, label) group by all",
        ),
    ),
    "lifecycle_means": (
        lambda s, d: rounded(summary.lifecycle_means(feature_rows(s, d)), *summary.NUMERIC),
        _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS}", "select policy, label, round(avg(rhythmic_density), 6) as rhythmic_density, round(avg(occupancy), 6) as occupancy, round(avg(contour_reversal), 6) as contour_reversal from labelled group by all"),
    ),
    "lifecycle_boundaries": (
        lambda s, d: summary.boundary_rows(feature_rows(s, d)),
        _sql(f"{CLIPPED},{SWEEP},{LOCAL},{PROJECTED},{ROWS}", "select policy, stream_id, bar_index, label, source_position::double as source_position, segment_position from labelled where segment_position = 0 or bar_index = 0 or bar_index = source_bar_count - 1"),
    ),
}

_PARTS = "bar_polyphony bar_voices rhythmic_density contour_reversals pitch_entropy tonal_center theil_sen_trend interval_magnitude pitch_span duration_tendency grid_rigidity articulation overlap_pairs".split()
TABLE["bar_controls"] = (
    lambda s, d: rounded(controls.bar_controls(notes(s, d)), "entropy", "theil_sen", "median_duration_to_next_onset"),
    "with "
    + ",\n".join(f"part_{name} as ({TABLE[name][1]})" for name in ("live_bars", *_PARTS))
    + """
select stream_id, bar_index, source_position, source_bar_count, segment_id, segment_position,
       coalesce(max_voices, 0) as max_voices, coalesce(b.occupied, 0)::double as occupancy, coalesce(polyphonic_fraction, 0)::double as polyphonic_fraction,
       coalesce(time_weighted_voices, 0)::double as time_weighted_voices, rhythmic_density, contour_reversal, unique_count, entropy, tonic_pc, modal_pc, score_margin, evidence_count,
       theil_sen, first_last, median_abs_interval, p90_abs_interval, median_pitch, p90_p10, absolute, p25, median, p75, exact_grid_fraction, residual_sum, declared_resolution_ticks,
       median_duration_to_next_onset, coalesce(overlap_count, 0) as overlap_count, 4 as numerator, 4 as denominator, median_pitch as duration_weighted_median_candidate, 'UNKNOWN' as mode
from part_live_bars l left join part_bar_polyphony b using (stream_id, bar_index)"""
    + "".join(f" left join part_{name} using (stream_id, bar_index)" for name in _PARTS[1:]),
)
