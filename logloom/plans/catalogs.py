"""Dataset references, catalog rollups, monitor checks and payloads over derived definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.operators import catalog as ca
from logloom.operators import lint as li
from logloom.plans.views import table
from logloom.sources.payload import extract_path, payload_rows


def _catalog(spark, sf_dir):
    """Datasets: market segments of every nation; five nations use names of their own."""
    customers = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("string")
    name = F.when(F.col("c_nationkey") < 5, F.concat("c_mktsegment", F.lit("-"), nation)).otherwise(F.col("c_mktsegment"))
    keyed = customers.select(F.concat(F.lit("nation-"), nation).alias("collection"), name.alias("name"), "c_custkey")
    return keyed.groupBy("collection", "name").agg(F.min("c_custkey").cast("string").alias("id"))


_CATALOG_SQL = """catalog as (
  select concat('nation-', cast(c_nationkey as varchar)) collection,
         case when c_nationkey < 5 then concat(c_mktsegment, '-', cast(c_nationkey as varchar)) else c_mktsegment end as name,
         cast(min(c_custkey) as varchar) id
  from customer group by 1, 2)"""


def _refs(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    nation, kind = F.col("c_nationkey").cast("string"), F.col("c_custkey") % 5
    ref = (
        F.when(kind == 0, F.concat(F.lit("nation-"), nation, F.lit("/"), "c_mktsegment"))
        .when(kind == 1, F.col("c_mktsegment"))
        .when(kind == 2, F.concat("c_mktsegment", F.lit("-"), nation))
        .when(kind == 3, F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")))
        .otherwise(F.col("c_name"))
    )
    return customers.select(ref.alias("ref"))


_REFS_SQL = """refs as (select distinct case c_custkey % 5
    when 0 then concat('nation-', cast(c_nationkey as varchar), '/', c_mktsegment) when 1 then c_mktsegment
    when 2 then concat(c_mktsegment, '-', cast(c_nationkey as varchar))
    when 3 then concat('00000000-0000-0000-0000-', lpad(cast(c_custkey as varchar), 12, '0')) else c_name end as ref
  from customer)"""


def _monitors(spark, sf_dir):
    """A monitor definition per order, with faults of every kind."""
    orders = table(spark, sf_dir, "orders")
    key, n = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 7
    operator = F.when(n == 1, "OVER").when(n == 2, "below").otherwise("ABOVE")
    unit = F.when(F.col("o_custkey") % 3 == 0, "hours").when(F.col("o_custkey") % 3 == 1, "minutes").otherwise("days")
    window = F.concat(F.lit("Last "), (F.col("o_custkey") % 40).cast("string"), F.lit(" "), unit)
    window = F.when(n == 3, F.lit("last week")).otherwise(window)
    action = (
        F.when(n == 4, '[{"type":"EMAIL"},7]').when(n == 5, "[]").when(n == 6, '[{"type":"SMS"}]')
        .otherwise('[{"type":"EMAIL","email":"a@example.com"},{"type":"INTEGRATION"}]')
    )
    source = F.concat(F.lit('["'), (F.col("o_custkey") % 3000).cast("string"), F.lit('"]'))
    query = F.concat(
        F.lit('[{"name":"q","select":["count(*)"],"where":"","from":'), source,
        F.when(n == 1, '},{"select":[],"from_expr":1}').otherwise("}"), F.lit("]"),
    )
    threshold = F.when(n == 2, "").otherwise(',"threshold":5')
    name = F.when(F.col("o_custkey") % 11 == 0, "").otherwise(F.concat(F.lit('"name":"m'), key, F.lit('",')))
    body = F.concat(
        F.lit("{"), name, F.lit('"comparison_operator":"'), operator, F.lit('","window":"'), window,
        F.lit('","actions":'), action, F.lit(',"queries":'), query, threshold, F.lit("}"),
    )
    return orders.select("o_orderkey", body.alias("definition"))


_MONITORS_SQL = """monitors as (select o_orderkey, concat('{',
   case when o_custkey % 11 = 0 then '' else concat('"name":"m', cast(o_orderkey as varchar), '",') end,
   '"comparison_operator":"', case o_orderkey % 7 when 1 then 'OVER' when 2 then 'below' else 'ABOVE' end,
   '","window":"', case when o_orderkey % 7 = 3 then 'last week' else concat('Last ', cast(o_custkey % 40 as varchar), ' ',
        case o_custkey % 3 when 0 then 'hours' when 1 then 'minutes' else 'days' end) end,
   '","actions":', case o_orderkey % 7 when 4 then '[{"type":"EMAIL"},7]' when 5 then '[]' when 6 then '[{"type":"SMS"}]'
        else '[{"type":"EMAIL","email":"a@example.com"},{"type":"INTEGRATION"}]' end,
   ',"queries":[{"name":"q","select":["count(*)"],"where":"","from":["', cast(o_custkey % 3000 as varchar), '"]',
        case when o_orderkey % 7 = 1 then '},{"select":[],"from_expr":1}' else '}' end, ']',
   case when o_orderkey % 7 = 2 then '' else ',"threshold":5' end, '}') definition from orders),
m as (select o_orderkey, definition::json d from monitors)"""


def _unknown_datasets(spark, sf_dir):
    return li.unknown_datasets(_monitors(spark, sf_dir), _catalog(spark, sf_dir)).select("o_orderkey", "id")


def _users(spark, sf_dir):
    """Catalog objects per customer: logins, heartbeat, widgets."""
    customers = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    body = F.concat(
        F.lit('{"last_logins":{"Password":'), F.lit("17845268"), F.lpad((F.col("c_custkey") % 97).cast("string"), 2, "0"),
        F.when(F.col("c_custkey") % 2 == 0, ',"SSO":1784526850').otherwise(""),
        F.lit('},"metadata":{"last_heartbeat_at":'), F.lit("1784526811000"), F.lit('},"widget_ids":['),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(key), F.lit('],"components":[1,2],"this_template_tags":{"log_type":"'),
        F.col("c_mktsegment"), F.lit('"}}'),
    )
    return customers.select("c_custkey", body.alias("definition"))


def _catalog_stats(spark, sf_dir):
    rows = ca.catalog_stats(_users(spark, sf_dir))
    return rows.select(
        "c_custkey", F.unix_seconds("last_login").alias("last_login"), F.unix_millis("last_activity").alias("last_activity"),
        "widgets", "components", "log_type",
    )


def _mask(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.substring("c_name", 10, 100).alias("digits")
    )
    return ca.mask_columns(customers, ["c_name", "c_mktsegment", "digits"])


def _payload(events):
    kind, name = F.col("event_id") % 4, F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return (
        F.when(kind == 0, F.concat(F.lit('{"data":[{"n":'), k, F.lit('},{"n":4367602734065516544}],"keys":[1]}')))
        .when(kind == 1, F.concat(F.lit('{"items":['), k, F.lit(',"x"],"total":2}')))
        .when(kind == 2, F.concat(F.lit('[{"n":'), k, F.lit("},"), k, F.lit("]")))
        .otherwise(F.concat(F.lit('{"name":"'), name, F.lit('"}')))
    )


def _payload_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = payload_rows(events.select("event_id", _payload(events).alias("body")), "body", ["top_keys", "data"])
    return rows.select("event_id", F.to_json("row").alias("row"))


def _extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return extract_path(events.select("event_id", _payload(events).alias("body")), "body", "$.data[*].n")


_PAYLOAD_SQL = "json_extract_string(props, '$.k')"

QUERIES = {
    "resolve_refs": lambda s, d: ca.resolve_refs(_refs(s, d), _catalog(s, d)),
    "qualify_names": lambda s, d: ca.qualify_names(_catalog(s, d)),
    "dataset_rollup": lambda s, d: ca.collections_rollup(_catalog(s, d)),
    "lint_monitors": lambda s, d: li.lint_monitors(_monitors(s, d)),
    "unknown_datasets": _unknown_datasets,
    "catalog_stats": _catalog_stats,
    "mask_secrets": _mask,
    "payload_rows": _payload_rows,
    "extract_path": _extract,
}


def _masked(column: str) -> str:
    return f"case when {column} = '' then '' when length({column}) < 12 then '…' else concat(left({column}, 8), '…') end"


ORACLES = {
    "resolve_refs": f"""with {_CATALOG_SQL}, {_REFS_SQL}, known as (
  select concat(collection, '/', name) as ref, 1 matches, min(id) id from catalog group by 1
  union all select name, count(*), min(id) from catalog group by 1)
select r.ref, case when r.ref like '00000000-%' then 'ok' when coalesce(k.matches, 0) = 0 then 'not_found'
   when k.matches > 1 then 'ambiguous' else 'ok' end status,
 case when r.ref like '00000000-%' then r.ref when k.matches = 1 then k.id end id,
 case when r.ref like '00000000-%' then 1 else coalesce(k.matches, 0) end matches
from refs r left join known k on k.ref = r.ref""",
    "qualify_names": f"""with {_CATALOG_SQL} select *, case when count(*) over (partition by name) > 1
 then concat(collection, '/', name) else name end label from catalog""",
    "dataset_rollup": f"""with {_CATALOG_SQL} select collection, count(*) datasets,
 array_to_string(list_sort(list(name)), ', ') as names from catalog group by 1""",
    "lint_monitors": f"""with {_MONITORS_SQL},
w as (select *, d->>'$.window' t, try_cast(regexp_extract(d->>'$.window', '^Last (\\d+) ', 1) as bigint)
        * case when d->>'$.window' like '%hours' then 60 when d->>'$.window' like '%days' then 1440 else 1 end mins from m),
a as (select o_orderkey, generate_subscripts(l, 1) - 1 i, unnest(l) v from (select o_orderkey, (d->'$.actions')::json[] l from m)),
q as (select o_orderkey, generate_subscripts(l, 1) - 1 i, unnest(l) v from (select o_orderkey, (d->'$.queries')::json[] l from m))
select o_orderkey, 'absent: name' problem from m where d->>'$.name' is null
union all select o_orderkey, 'absent: threshold' from m where d->>'$.threshold' is null
union all select o_orderkey, concat('no comparison: ', d->>'$.comparison_operator') from m
  where d->>'$.comparison_operator' not in ('BELOW', 'BELOW_OR_EQUAL', 'ABOVE', 'ABOVE_OR_EQUAL', 'EQUAL', 'NOT_EQUAL')
union all select o_orderkey, concat('unreadable span: ', t) from w where mins is null
union all select o_orderkey, concat('span under 5 minutes: ', t) from w where mins < 5
union all select o_orderkey, concat('span over 1 day: ', t) from w where mins > 1440
union all select o_orderkey, 'actions lists nothing' from m where json_array_length(d->'$.actions') = 0
union all select o_orderkey, concat('actions[', i, '] is no object') from a where json_type(v) <> 'OBJECT'
union all select o_orderkey, concat('actions[', i, '] mails nobody') from a
  where json_type(v) = 'OBJECT' and v->>'$.type' = 'EMAIL' and coalesce(v->>'$.email', '') = ''
union all select o_orderkey, concat('actions[', i, '] has an unheard-of type: ', v->>'$.type') from a
  where json_type(v) = 'OBJECT' and v->>'$.type' not in ('EMAIL', 'INTEGRATION')
union all select o_orderkey, concat('queries[', i, '] has no name') from q where v->>'$.name' is null
union all select o_orderkey, concat('queries[', i, '] selects nothing') from q where json_array_length(v->'$.select') = 0
union all select o_orderkey, concat('queries[', i, '] has no condition') from q where v->>'$.where' is null
union all select o_orderkey, concat('queries[', i, '] reads from nowhere') from q
  where json_type(v->'$.from') is distinct from 'ARRAY' and json_type(v->'$.from_expr') is distinct from 'VARCHAR'""",
    "unknown_datasets": f"""with {_CATALOG_SQL} select o_orderkey, cast(o_custkey % 3000 as varchar) id from orders
where cast(o_custkey % 3000 as varchar) not in (select id from catalog)""",
    "catalog_stats": """select c_custkey,
 greatest(cast(concat('17845268', lpad(cast(c_custkey % 97 as varchar), 2, '0')) as bigint),
          case when c_custkey % 2 = 0 then 1784526850 else 0 end) last_login,
 1784526811000 last_activity, case when c_custkey % 3 = 0 then 0 else 1 end widgets, 2 components, c_mktsegment log_type
from customer""",
    "mask_secrets": f"""select c_custkey, {_masked('c_name')} c_name, {_masked('c_mktsegment')} c_mktsegment,
 {_masked('substr(c_name, 10)')} digits from customer""",
    "payload_rows": f"""with k as (select event_id, event_type, {_PAYLOAD_SQL} k from events)
select event_id, unnest(case event_id % 4
  when 0 then [concat('{{"n":', k, '}}'), '{{"n":4367602734065516544}}']
  when 1 then [concat('{{"value":', k, '}}'), '{{"value":"x"}}']
  when 2 then [concat('{{"n":', k, '}}'), concat('{{"value":', k, '}}')]
  else [concat('{{"name":"', event_type, '"}}')] end) as row from k""",
    "extract_path": f"""with k as (select event_id, {_PAYLOAD_SQL} k from events)
select event_id, unnest([k, '4367602734065516544']) as value from k where event_id % 4 = 0""",
}
