"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quaver.llm import bpe, chat, decontam, htmltext, langid, linededup, quality, simhash, substring, toxicity
from quaver.session import table


def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.query(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_formatting(spark, sf_dir):
    return chat.query(table(spark, sf_dir, "conversations"))


def op4_substring_dedup(spark, sf_dir):
    return substring.query(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return linededup.query(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark, sf_dir):
    return langid.query(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark, sf_dir):
    return htmltext.query(table(spark, sf_dir, "pages"))


def op9_byte_level_bpe(spark, sf_dir):
    return bpe.query(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark, sf_dir):
    return decontam.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_simhash_near_dedup,
    op2_quality_rules,
    op3_chat_formatting,
    op4_substring_dedup,
    op5_line_dedup,
    op6_toxicity,
    op7_language_id,
    op8_html_extraction,
    op9_byte_level_bpe,
    op10_benchmark_decontamination,
)


def queries():
    return {f.__name__: f for f in QUERIES}


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

_ROLE = "regexp_replace(coalesce(role, ''), '(\\\\|###|</turn>|:)', '\\\\\\1', 'g')"
_TEXT = "regexp_replace(coalesce(text, ''), '(\\\\|###|</turn>)', '\\\\\\1', 'g')"

OP3 = f"""
with rows as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
said as (select *, '### ' || {_ROLE} || ': ' || {_TEXT} || ' </turn>' || chr(10) as formatted from rows)
select conv_id, count(*) as n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' order by turn nulls first, role nulls first, formatted)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(coalesce(text, ''), '' order by turn nulls first, role nulls first, formatted) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(formatted))::bigint as formatted_chars
from said group by conv_id
"""

OP4 = f"""
with docs as (select row_number() over () as r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents),
spots as (select r, doc_id, unnest(range(1, len(words) - 11)) as i, words from docs where len(words) >= 13),
windows as (select r, doc_id, i, array_to_string(words[i : i + 12], ' ') as w from spots),
firsts as (select w, min(doc_id) as owner from windows group by w),
hits as (select r, i from windows join firsts using (w) where doc_id > owner),
gone as (select distinct r, unnest(range(i, i + 13)) as i from hits),
placed as (select r, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from docs),
kept as (select r, string_agg(word, ' ' order by i) as text, count(*) as n from placed anti join gone using (r, i) group by r)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (r)
"""

OP5 = f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (
  select r, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from docs),
keyed as (select r, i, line, translate(trim(line, {_BLANKS}), {_AZ}) as k from lines),
common as (select k from keyed where k <> '' group by k having count(distinct r) >= 10),
kept as (select r, i, line, k in (select k from common) as gone from keyed),
sums as (
  select r, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
         coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as text
  from kept group by r)
select doc_id, n_lines, n_dropped, sha256(sums.text) as kept_sha256 from sums join docs using (r)
"""

OP10 = f"""
with docs as (select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_AZ}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from documents),
items as (select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_AZ}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from benchmark),
wide as (select item_id, words, least(10, len(words)) as w from items where len(words) > 0),
grams as (select distinct item_id, w, unnest(list_transform(range(len(words) - w + 1), lambda i: array_to_string(words[i + 1 : i + w], ' '))) as gram from wide),
widths as (select distinct w from grams),
spots as (select r, w, unnest(range(1, len(words) - w + 2)) as i, words from docs join widths on len(words) >= w),
hits as (select r, spots.w, i, item_id from spots join grams on spots.w = grams.w and array_to_string(words[i : i + spots.w - 1], ' ') = gram),
covered as (select r, count(distinct p) as n_hit from (select distinct r, unnest(range(i, i + w)) as p from hits) group by r),
named as (select r, count(distinct item_id) as n_items, array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as names from hits group by r)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join named using (r)
"""


def oracle_sql():
    return {"op3_chat_formatting": OP3, "op4_substring_dedup": OP4, "op5_line_dedup": OP5, "op10_benchmark_decontamination": OP10}
