"""Field discovery, name matching and log templates over the event and document views."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions.mask import mask_line
from logloom.operators import columns as co
from logloom.operators import names as nm
from logloom.operators import profile as pr
from logloom.operators import templates as tm
from logloom.plans.views import (
    DOCUMENT_LINES_SQL,
    LOG_EVENTS_SQL,
    document_lines,
    log_events,
    parsed_events,
    table,
)


def _joined(values: str):
    return F.array_join(values, "|").alias(values)


def _field_profile(spark, sf_dir):
    rows = pr.field_profile(parsed_events(spark, sf_dir), cap=5)
    return rows.select("key", "count", "type", "source", _joined("values"))


def _named_profile(spark, sf_dir):
    rows = pr.field_profile(parsed_events(spark, sf_dir), name="T", n=2, cap=3)
    return rows.select("key", "count", "type", "source", _joined("values"))


def _value_sample(spark, sf_dir):
    return pr.value_sample(parsed_events(spark, sf_dir), 4).select("key", _joined("values"))


def _merge_profiles(spark, sf_dir):
    """One profile per status, merged again."""
    parsed = parsed_events(spark, sf_dir).filter("size(attrs) > 0")
    per_log = (
        co.field_entries(parsed, ["status"])
        .filter("value is not null")
        .groupBy("status", "key", F.col("value").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("status", "key")
        .agg(F.sum("n").alias("rank"), F.collect_set("v").alias("values"))
        .select(
            "key", "rank",
            F.when(F.col("status") == "warn", "NUMBER").otherwise("").alias("type"),
            F.lit("MESSAGE_KVP").alias("source"), "values",
        )
    )
    return pr.merge_profiles(per_log).select("key", "count", "type", "source", _joined("values"))


def _event_words(spark, sf_dir):
    """Distinct words of the plain log lines, and names and values of the fields of all others."""
    parsed = parsed_events(spark, sf_dir)
    words = F.when(F.size("attrs") == 0, F.split("raw", " ")).otherwise(F.concat(F.map_keys("attrs"), F.map_values("attrs")))
    return parsed.select(F.explode(words).alias("name")).filter("name is not null").distinct()


def _known_words(spark, sf_dir):
    """Frequency of every first three letters + rest of the document languages and event types."""
    events = table(spark, sf_dir, "events")
    types = events.select(F.col("event_type").alias("key"))
    users = events.select(F.concat(F.lit("$User"), F.col("user_id").cast("string")).alias("key"))
    took = events.select(F.concat(F.get_json_object("props", "$.k"), F.lit("mss")).alias("key"))
    every = types.unionByName(users).unionByName(took)
    return every.groupBy("key").agg(F.count(F.lit(1)).alias("count"))


_KNOWN_SQL = """known as (select key, count(*) as count from (
  select event_type as key from events union all select concat('$User', cast(user_id as varchar)) from events
  union all select concat(json_extract_string(props, '$.k'), 'mss') from events) group by 1)"""
_WORDS_SQL = """words as (select distinct name from (
  select unnest(case when raw like '{%' then [f_type, f_k, f_amount, f_status, 'type', 'k', 'http.status',
    case when f_amount is not null then 'amount' end] else string_split(raw, ' ') end) as name from parsed) where name is not null)"""


def _suggest(spark, sf_dir):
    return nm.nearest(_event_words(spark, sf_dir), _known_words(spark, sf_dir))


def _word_corrections(spark, sf_dir):
    """Words of the benchmark texts next to the words of the documents, which grow with the data."""
    def words(name):
        texts = table(spark, sf_dir, name).select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
        return texts.filter("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("count"))

    known = words("documents").withColumnRenamed("w", "key")
    names = words("benchmark").select(F.concat(F.lit("x"), F.expr("substring(w, 2)")).alias("name"))
    return nm.nearest(names, known, 1)


def _candidates(spark, sf_dir):
    names = _event_words(spark, sf_dir)
    more = names.unionByName(names.select(F.substring("name", 1, 3).alias("name"))).distinct()
    return pr.field_candidates(more, _known_words(spark, sf_dir))


def _resolve(spark, sf_dir):
    names = _event_words(spark, sf_dir)
    asked = names.unionByName(
        table(spark, sf_dir, "events").select(F.concat(F.lit("uSER"), F.col("user_id").cast("string")).alias("name"))
    )
    known = _known_words(spark, sf_dir)
    twice = known.unionByName(known.filter(F.startswith("key", F.lit("$User1"))).select(F.lower("key").alias("key"), "count"))
    return pr.resolve_field(twice, asked)


def _refs(spark, sf_dir):
    return _event_words(spark, sf_dir).select(
        F.when(F.length("name") > 4, F.concat(F.lit("@"), "name")).otherwise(F.col("name")).alias("field")
    )


def _unknown(spark, sf_dir):
    return pr.unknown_fields(_refs(spark, sf_dir), _known_words(spark, sf_dir))


def _check(spark, sf_dir):
    refs = _event_words(spark, sf_dir).withColumnRenamed("name", "field")
    return pr.check_fields(refs, _known_words(spark, sf_dir), strict=True)


def _mask_lines(spark, sf_dir):
    return document_lines(spark, sf_dir).select("doc_id", "line_no", mask_line("line").alias("template"))


def _template_counts(spark, sf_dir):
    return tm.template_counts(document_lines(spark, sf_dir), "line", ["doc_id", "line_no"])


def _template_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("line", F.replace("url", F.lit("?"), F.lit(" ")))
    return tm.template_counts(pages, "line", ["page_id"])


def _template_clusters(spark, sf_dir):
    logs = log_events(spark, sf_dir)
    return tm.template_clusters(logs, "raw", ["event_time", "sequence"])


def _expanded(spark, sf_dir):
    parsed = parsed_events(spark, sf_dir)
    return co.expand_rows(parsed, ["type", "k"], ["sequence"])


def _kept(spark, sf_dir):
    parsed = co.keep_fields(parsed_events(spark, sf_dir), ["amount", "http.status", "absent"])
    entries = F.array_sort(F.map_entries("attrs"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return parsed.select("sequence", text.alias("fields"))


QUERIES = {
    "field_union": lambda s, d: co.field_union(parsed_events(s, d)),
    "field_profile": _field_profile,
    "field_profile_named": _named_profile,
    "field_values": lambda s, d: pr.field_values(parsed_events(s, d), "$TYPE", 4),
    "value_sample": _value_sample,
    "merge_profiles": _merge_profiles,
    "column_ranking": lambda s, d: co.rank_columns(parsed_events(s, d)),
    "column_ranking_narrow": lambda s, d: co.rank_columns(parsed_events(s, d), 4),
    "listed_columns": lambda s, d: co.listed_columns(parsed_events(s, d), ["event_time", "sequence"]),
    "expanded_rows": _expanded,
    "kept_fields": _kept,
    "selected_fields": lambda s, d: co.select(parsed_events(s, d, ["type", "http.status"]), ["sequence", "type", "http.status"]),
    "resolve_fields": _resolve,
    "unknown_fields": _unknown,
    "suggest_fields": _suggest,
    "word_corrections": _word_corrections,
    "field_candidates": _candidates,
    "check_fields": _check,
    "mask_lines": _mask_lines,
    "template_counts": _template_counts,
    "template_counts_urls": _template_urls,
    "template_clusters": _template_clusters,
}

_PUNCT = "[\"'',;:()\\[\\]{}]"
_CORES = (
    ("-?\\d+(?:\\.\\d+)?(?:ms|us|ns|s|m|h|d|%|b|kb|mb|gb|KB|MB|GB)?", "<num>"),
    ("[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<uuid>"),
    ("[0-9a-fA-F]{12,}", "<hex>"),
)


def _core_sql(part: str) -> str:
    for core, tag in _CORES:
        part = f"regexp_replace({part}, '^({_PUNCT}*)(?:{core})({_PUNCT}*)$', '\\1{tag}\\2')"
    return part


_SPACE = "[ \\t\\n\\x0b\\f\\r\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _mask_sql(line: str) -> str:
    """Masked line: per token, keep the key= prefix and mask the path segments of the rest."""
    rest = "regexp_extract(w, '^((?:[^=]+=)*)((?s).*)$', 2)"
    return (
        f"array_to_string(list_transform(list_filter(regexp_split_to_array({line}, '{_SPACE}'), lambda w: w <> ''),"
        f" lambda w: concat(regexp_extract(w, '^((?:[^=]+=)*)((?s).*)$', 1),"
        f" array_to_string(list_transform(string_split({rest}, '/'), lambda s: {_core_sql('s')}), '/'))), ' ')"
    )


_ENTRIES = """entries as (
  select sequence, 'type' as key, f_type as value from parsed where f_type is not null
  union all select sequence, 'k', f_k from parsed where f_k is not null
  union all select sequence, 'amount', f_amount from parsed where f_amount is not null
  union all select sequence, 'http.status', f_status from parsed where f_status is not null)"""
_CORE = "core as (" + " union all ".join(
    f"select '@{key}' as key, count({column}) as present, count(distinct {column}) as variety from log_events"
    for key, column in (("time", "event_time"), ("status", "status"), ("raw", "raw"), ("origin", "origin"), ("sequence", "sequence"))
) + ")"
_NORM = "lower(regexp_replace({c}, '^[$]', ''))"


def _profile_sql(cap: int, where: str = "true", limit: str = "") -> str:
    return f"""with {LOG_EVENTS_SQL}, {_ENTRIES},
v as (select key, array_to_string(list_sort(list(value))[1:{cap}], '|') as values
      from (select distinct key, value from entries) group by 1)
select e.key, count(*) as count, case when bool_and(try_cast(value as double) is not null) then 'number' else 'string' end as type,
 'message' as source, any_value(v.values) as values
from entries e join v on v.key = e.key where {where} group by e.key order by count desc, e.key {limit}"""


def _nearest_sql(names: str, known: str, limit: int, norm: str = "lower({c})") -> str:
    """First known key in (count, key) order with the smallest distance up to the limit."""
    return f"""select name, arg_min(key, struct_pack(d := dist, r := -n, k := key)) nearest,
 cast(min(dist) as int) distance from (
  select a.name, b.key, b.count as n, levenshtein({norm.format(c='a.name')}, {norm.format(c='b.key')}) dist
  from {names} a, {known} b
  where abs(length({norm.format(c='a.name')}) - length({norm.format(c='b.key')})) <= {limit})
 where dist <= {limit} group by name"""


ORACLES = {
    "field_union": f"with {LOG_EVENTS_SQL}, {_ENTRIES} select distinct key from entries",
    "field_profile": _profile_sql(5),
    "field_profile_named": _profile_sql(3, "contains(lower(e.key), 't')", "limit 2"),
    "field_values": f"with {LOG_EVENTS_SQL} select distinct f_type as value from parsed where f_type <> '' order by 1 limit 4",
    "value_sample": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}
select key, array_to_string(list_sort(list(value))[1:4], '|') as values from (select distinct key, value from entries) group by 1""",
    "merge_profiles": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}
select e.key, cast(count(*) as double) as count, max(case when status = 'warn' then 'number' end) as type, 'message' as source,
 array_to_string(list_sort(list(distinct value)), '|') as values
from entries e join log_events l on l.sequence = e.sequence group by e.key""",
    "column_ranking": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}, {_CORE}, s as (
 select key, count(*) present, count(distinct value) variety from entries group by 1
 union all select * from core where key <> '@raw')
select row_number() over (order by case key when '@time' then 0 when '@status' then 1 else 2 end, present desc, variety desc, key) as position,
 key, present, variety from s order by 1 limit 8""",
    "column_ranking_narrow": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}, {_CORE}, s as (
 select key, count(*) present, count(distinct value) variety from entries group by 1
 union all select * from core where key <> '@raw'),
r as (select row_number() over (order by case key when '@time' then 0 when '@status' then 1 else 2 end, present desc, variety desc, key) as position,
 key, present, variety from s order by 1 limit 3)
select * from r union all select 4, * from core where key = '@raw'""",
    "listed_columns": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}, s as (
 select e.key, min(struct_pack(t := l.event_time, s := l.sequence)) seen from entries e join log_events l on l.sequence = e.sequence
 group by 1),
r as (select key, 4 place, seen from s union all select '@time', 1, null union all select '@status', 2, null union all select '@raw', 3, null)
select row_number() over (order by place, seen, key) as position, key from r""",
    "expanded_rows": f"""with {LOG_EVENTS_SQL}, {_ENTRIES}
select sequence, row_number() over (partition by sequence order by case key when 'type' then 0 when 'k' then 1 else 2 end, key) as position,
 key, value from entries""",
    "kept_fields": f"""with {LOG_EVENTS_SQL} select sequence,
 concat_ws(',', case when f_amount is not null then concat('amount=', f_amount) end,
           case when f_status is not null then concat('http.status=', f_status) end) fields from parsed""",
    "selected_fields": f"""with {LOG_EVENTS_SQL} select sequence, f_type as type, f_status as "http.status" from parsed""",
    "resolve_fields": f"""with {LOG_EVENTS_SQL}, {_WORDS_SQL}, {_KNOWN_SQL},
twice as (select key from known union all select lower(key) from known where key like '$User1%'),
asked as (select name from words union select concat('uSER', cast(user_id as varchar)) from events),
j as (select name, max(case when key = name then key end) exact, count(key) matches, min(key) first_key
      from asked left join twice on {_NORM.format(c='key')} = {_NORM.format(c='name')} group by 1)
select name, case when exact is not null or matches = 1 then 'ok' when matches = 0 then 'unknown' else 'ambiguous' end status,
 case when exact is not null or matches = 1 then coalesce(exact, first_key) end field, matches from j""",
    "unknown_fields": f"""with {LOG_EVENTS_SQL}, {_WORDS_SQL}, {_KNOWN_SQL}
select name as field from words where length(name) <= 4 and not regexp_matches(name, '^[@$]') and name not in (select key from known)""",
    "suggest_fields": f"with {LOG_EVENTS_SQL}, {_WORDS_SQL}, {_KNOWN_SQL} {_nearest_sql('words', 'known', 2)}",
    "word_corrections": f"""with w as (select unnest(regexp_split_to_array(lower(text), '[^a-z]+')) w from documents),
known as (select w as key, count(*) as count from w where w <> '' group by 1),
b as (select unnest(regexp_split_to_array(lower(text), '[^a-z]+')) w from benchmark),
names as (select distinct concat('x', substr(w, 2)) as name from b where w <> '')
{_nearest_sql('names', 'known', 1)}""",
    "field_candidates": f"""with {LOG_EVENTS_SQL}, {_WORDS_SQL}, {_KNOWN_SQL},
more as (select name from words union select left(name, 3) from words),
hits as (select name, key from more, known where contains({_NORM.format(c='key')}, {_NORM.format(c='name')})),
ranked as (select name, cast(row_number() over (partition by name order by key) as int) as position, key candidate from hits),
lonely as (select name from more where name not in (select name from hits))
select * from ranked where position <= 3
union all select name, 1, nearest from ({_nearest_sql('lonely', 'known', 2, _NORM)})""",
    "check_fields": f"""with {LOG_EVENTS_SQL}, {_WORDS_SQL}, {_KNOWN_SQL},
unknown as (select name from words where not regexp_matches(name, '^[@$]') and name not in (select key from known)),
best as ({_nearest_sql('unknown', 'known', 2)})
select w.name as field, case when u.name is null then 'known' else 'error' end status, b.nearest suggestion
from words w left join unknown u on u.name = w.name left join best b on b.name = w.name""",
    "mask_lines": f"with {DOCUMENT_LINES_SQL} select doc_id, line_no, {_mask_sql('line')} as template from document_lines",
    "template_counts": f"""with {DOCUMENT_LINES_SQL},
m as (select doc_id, line_no, trim(line) line, {_mask_sql('line')} as template from document_lines)
select template, count(*) as count, arg_min(line, struct_pack(d := doc_id, l := line_no)) example from m
where template <> '' group by 1""",
    "template_clusters": f"""with recursive {LOG_EVENTS_SQL},
t as (select raw, event_time, sequence, string_split({_mask_sql('raw')}, ' ') as w from log_events),
l as (select *, len(w) arity, row_number() over (partition by len(w) order by event_time, sequence) rn from t),
walk(arity, i, c) as (
  select distinct arity, cast(0 as bigint), cast([] as struct(t varchar[], n bigint, e varchar)[]) from l where arity > 1
  union all
  select arity, rn, case when best is null or hits[best] * 2 < arity then list_append(c, struct_pack(t := w, n := 1, e := raw))
    else list_transform(c, lambda x, j: case when j <> best then x else struct_pack(
      t := list_transform(x.t, lambda y, p: case when y = w[p] then y else '<*>' end), n := x.n + 1, e := x.e) end) end
  from (select *, list_position(hits, list_max(hits)) best from (
    select l.arity, l.rn, l.w, l.raw, k.c, list_transform(k.c, lambda x:
      len(list_filter(range(1, l.arity + 1), lambda p: x.t[p] = l.w[p] or x.t[p] = '<*>'))) hits
    from walk k join l on l.arity = k.arity and l.rn = k.i + 1))),
final as (select arity, unnest(arg_max(c, i)) s from walk group by 1)
select array_to_string(s.t, ' ') as template, s.n as count, s.e example from final
union all select w[1], count(*), arg_min(raw, struct_pack(a := event_time, b := sequence)) from l where arity = 1 group by 1""",
    "template_counts_urls": f"""with m as (select page_id, replace(url, '?', ' ') line from pages)
select {_mask_sql('line')} as template, count(*) as count, arg_min(line, page_id) example from m group by 1""",
}
