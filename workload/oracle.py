"""For each checked query, SQL over the same tables that must give the same rows.

The statements are built from common table expressions that restate the
semantics with window functions and plain SQL aggregates, not from the plans
of the operators.
"""

from __future__ import annotations

from larder.plans.train import CLUSTERS, MAX_ITERATIONS, SEED
from larder.schema import FEATURE_SLOTS, IDENTITY_COLUMNS, RUN_FIELDS, TABLE_LAYOUT
from larder.sources.outputs import ALGORITHM
from workload.inputs import raw_product_select, separated_points
from workload.queries import (
    CENTRES,
    PAGE_LIMIT,
    PAGE_OFFSET,
    PUBLISHED_AT,
    RUN_ID,
    SCAN_LIMIT,
    VERSIONS,
)

BOUNDS = TABLE_LAYOUT.bounds
FEATURES = TABLE_LAYOUT.features
FIELDS = [name for name in TABLE_LAYOUT.columns if name != "code"]
FAMILY = {name: "nutrition" if name in BOUNDS else "info" for name in FIELDS}


def csv(items) -> str:
    return ", ".join(items)


def ascending(names) -> str:
    return csv(f"{name} asc nulls first" for name in names)


def rounded(names) -> str:
    return csv(f"round({name}, 6) + 0.0 as {name}" for name in names)


def number(name: str) -> str:
    return f"try_cast(replace(trim({name}), ',', '.') as double)"


def bounded(name: str) -> str:
    low, high = BOUNDS[name]
    value = number(name)
    return f"case when not isnan({value}) and {value} between {low} and {high} then {value} + 0.0 end"


RAW = f"raw as (select {raw_product_select('varchar')} from lineitem)"

KEYED = f"""keyed as (
  select * exclude (place) from (
    select trim(code) as code, {csv(FIELDS)},
      row_number() over (partition by trim(code) order by {ascending(FIELDS)}) as place
    from raw where length(trim(code)) > 0
  ) where place = 1)"""


def clean(trim_text: bool) -> str:
    texts = csv(f"trim({n}) as {n}" if trim_text else n for n in IDENTITY_COLUMNS[1:])
    return f"""typed as (
  select trim(code) as code, {texts}, {csv(f'{bounded(n)} as {n}' for n in FEATURES)}
  from raw where length(trim(code)) > 0),
clean as (
  select * exclude (place) from (
    select *, row_number() over (partition by code order by {ascending(FIELDS)}) as place
    from typed where coalesce({csv(FEATURES)}) is not null
  ) where place = 1)"""


IMPUTE = f"""medians as (
  select {csv(f'quantile_disc({n}, 0.5) as {n}' for n in FEATURES)} from clean),
filled as (
  select c.code, c.product_name, c.categories,
    {csv(f'coalesce(c.{n}, m.{n}) as {n}' for n in FEATURES)}
  from clean c, medians m)"""

SCALE = f"""spread as (
  select {csv(f'avg({n}) as a_{n}, stddev_samp({n}) as s_{n}' for n in FEATURES)} from filled),
scaled as (
  select code, product_name, categories, {csv(
    f'case when s_{n} = 0 then 0.0 else ({n} - a_{n}) / s_{n} end as {n}' for n in FEATURES)}
  from filled, spread),
prepared as (
  select code, coalesce(product_name, '') as product_name, coalesce(categories, '') as categories,
    {csv(f'{n} as f{i}' for i, n in enumerate(FEATURES))} from scaled)"""

CENTRE_TABLE = "centres(cluster, {}) as (values {})".format(
    csv(f"c{i}" for i in range(len(FEATURE_SLOTS))),
    csv(f"({k}, {csv(f'cast({x} as double)' for x in centre)})" for k, centre in enumerate(CENTRES)),
)
DISTANCE = " + ".join(f"(f{i} - c{i}) * (f{i} - c{i})" for i in range(len(FEATURE_SLOTS)))

ASSIGN = f"""{CENTRE_TABLE},
measured as (select p.*, c.cluster, {DISTANCE} as distance from prepared p, centres c),
assigned as (
  select * exclude (place) from (
    select *, row_number() over (partition by code order by round(distance, 9), cluster) as place
    from measured) where place = 1)"""

NORM = " + ".join(f"f{i} * f{i}" for i in range(len(FEATURE_SLOTS)))
INNER = " + ".join(f"a.f{i} * t.s{i}" for i in range(len(FEATURE_SLOTS)))

SILHOUETTE = f"""normed as (select *, {NORM} as norm from assigned),
totals as (
  select cluster, count(*) as n, sum(norm) as y,
    {csv(f'sum(f{i}) as s{i}' for i in range(len(FEATURE_SLOTS)))}
  from normed group by cluster),
compared as (
  select a.code, a.cluster = t.cluster as own, t.n,
    (t.n * a.norm + t.y - 2 * ({INNER})) / t.n as d
  from normed a, totals t),
scored as (
  select code, max(n) filter (own) as n, max(case when own and n > 1 then d * n / (n - 1) end) as a,
    min(d) filter (not own) as b
  from compared group by code)"""

RUN_EVENTS = """run_events as (
  select 'run-' || cast(user_id as varchar) as run_id, event_id as put_seq,
    case event_type when 'signup' then 'running' when 'purchase' then 'complete'
      when 'error' then 'failed' end as status,
    case when event_type = 'signup' then happened end as started_at,
    case when event_type = 'purchase' then happened end as completed_at,
    case when event_type = 'error' then happened end as failed_at,
    case when event_type = 'purchase' then cast(event_id as varchar) end as published_rows,
    case when event_type = 'purchase' then cast(cast(value as decimal(12,2)) as varchar) end
      as silhouette,
    case when event_type in ('view', 'click') then event_type end as source
  from (select *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as happened from events))"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def cells_of(source: str, fields=None) -> str:
    """Non-blank cells of a table with one row per key."""
    return " union all ".join(
        f"select code as row_key, '{FAMILY[n]}' as family, '{n}' as qualifier, {n} as value "
        f"from {source} where length(trim({n})) > 0"
        for n in fields or FIELDS
    )


def count_as(name: str, key: str, source: str, where: str = "true") -> str:
    return (
        f"select '{name}' as table_name, cast(count(distinct {key}) as bigint) as rows "
        f"from {source} where {where}"
    )


CLEAN_TRIMMED = (RAW, clean(True))
PREPARED = (RAW, clean(False), IMPUTE, SCALE)
ASSIGNED = (*PREPARED, ASSIGN)
ANY_FILLED = " or ".join(f"length(trim({n})) > 0" for n in FIELDS)

WORDS = """words as (
  select unnest(string_split_regex(lower(text), '\\W+')) as word from documents)"""
WORD_COUNT = with_(WORDS) + (
    "select word, cast(count(*) as bigint) as count from words where length(word) > 0 group by word"
)

FAULTY = """predictions as (
  select trim(code) || case when categories is null then '?' else '' end as code
  from raw where length(trim(code)) > 0)"""

LAST_PUT = " union all ".join(
    f"select row_key, '{FAMILY[n]}' as family, '{n}' as qualifier, value from ("
    f"select trim(code) as row_key, {n} as value, row_number() over (partition by trim(code) "
    f"order by {csv(f'{m} desc nulls last' for m in FIELDS)}) as place "
    f"from raw where length(trim(code)) > 0 and length(trim({n})) > 0) where place = 1"
    for n in FIELDS
)

CURRENT_ROW = csv(
    [f"'{v}' as version, cast(count(*) as bigint) as count, '{at}' as created_at"
     for v, at in VERSIONS.items()][-1:]
)

ORACLE: dict[str, str] = {
    "tsv_scan": with_(RAW)
    + f"select {csv(f'''nullif({n}, '') as {n}''' for n in TABLE_LAYOUT.columns)} from raw",
    "parse_locale_numbers": with_(RAW)
    + "select code, "
    + csv(f"case when not isnan({number(n)}) then {number(n)} end as {n}" for n in FEATURES)
    + ", "
    + " + ".join(f"coalesce(cast(isnan({number(n)}) as int), 0)" for n in FEATURES)
    + " as nan_fields from raw",
    "bound_to_null": with_(RAW)
    + f"select code, {csv(f'{bounded(n)} as {n}' for n in FEATURES)} from raw",
    "clean_products": with_(*CLEAN_TRIMMED) + "select * from clean",
    "dedupe_by_key": with_(RAW, KEYED) + "select * from keyed",
    "impute_median": with_(*CLEAN_TRIMMED, IMPUTE)
    + f"select code, {csv(f'{n} as {n}__imputed' for n in FEATURES)} from filled",
    "standardize": with_(*CLEAN_TRIMMED, IMPUTE, SCALE)
    + f"select code, {rounded(FEATURES)} from scaled",
    "prepare_products": with_(*PREPARED)
    + f"select code, product_name, categories, {rounded(FEATURE_SLOTS)} from prepared",
    "vector_round_trip": with_(*PREPARED)
    + f"select code, {rounded(FEATURE_SLOTS)} from prepared",
    "products_to_cells": with_(RAW, KEYED) + cells_of("keyed"),
    "cells_to_products": with_(RAW, KEYED)
    + "select code, "
    + csv(f"case when length(trim({n})) > 0 then {n} end as {n}" for n in FIELDS)
    + f" from keyed where {ANY_FILLED}",
    "scan_first_keys": with_(RAW, KEYED, f"cells as ({cells_of('keyed')})")
    + "select * from cells where row_key in "
    + f"(select distinct row_key from cells order by row_key limit {SCAN_LIMIT})",
    "cell_merge_latest": """select cast(user_id as varchar) as row_key, 'event' as family,
  event_type as qualifier, cast(cast(value as decimal(12,2)) as varchar) as value
from (select *, row_number() over (
    partition by user_id, event_type order by ts desc, event_id desc) as place
  from events where value is not null) where place = 1""",
    "seed_raw": with_(RAW) + LAST_PUT,
    "table_row_counts": with_(RAW, KEYED, clean(False), RUN_EVENTS)
    + " union all ".join(
        [
            count_as("raw", "code", "keyed", ANY_FILLED),
            count_as("prepared", "code", "clean"),
            count_as("results", "code", "clean"),
            count_as("runs", "run_id", "run_events"),
        ]
    ),
    "prepared_cells": with_(*PREPARED)
    + f"select code, product_name, categories, {rounded(FEATURE_SLOTS)} from prepared",
    "snapshot_refresh": with_(RAW, clean(False))
    + " union all ".join(
        f"select '{version}' as version, cast(count(*) as bigint) as count, "
        f"'{created_at}' as created_at from clean"
        for version, created_at in VERSIONS.items()
    ),
    "snapshot_write_read": with_(*PREPARED)
    + f"select code, product_name, categories, {rounded(FEATURE_SLOTS)} from prepared",
    "current_snapshot": with_(RAW, clean(False)) + f"select {CURRENT_ROW} from clean",
    "page_rows": with_(*PREPARED)
    + f"""select '{list(VERSIONS)[-1]}' as version,
  (select cast(count(*) as bigint) from prepared) as total,
  cast({PAGE_OFFSET} as bigint) as "offset", cast({PAGE_LIMIT} as bigint) as "limit",
  cast(row_number as bigint) as row_number, code, trim(product_name) as product_name, categories,
  {rounded(FEATURE_SLOTS)}
from (select *, row_number() over (order by code) as row_number from prepared)
where row_number > {PAGE_OFFSET} and row_number <= {PAGE_OFFSET + PAGE_LIMIT}""",
    "publish_results": with_(RAW, clean(False))
    + f"""select '{RUN_ID}:' || code as result_key, '{RUN_ID}' as run_id,
  cast(length(code) % {CLUSTERS} as varchar) as cluster, '{PUBLISHED_AT}' as created_at,
  coalesce(product_name, '') as product_name, coalesce(categories, '') as categories
from clean""",
    "unknown_codes": with_(*CLEAN_TRIMMED, FAULTY)
    + "select distinct code from predictions where code not in (select code from clean)",
    "duplicate_codes": with_(RAW, FAULTY)
    + "select code, cast(count(*) as bigint) as count from predictions "
    + "group by code having count(*) > 1",
    "run_lifecycle": with_(RUN_EVENTS)
    + "select run_id, "
    + csv(f"arg_max({n}, put_seq) filter ({n} is not null) as {n}" for n in RUN_FIELDS)
    + " from run_events group by run_id",
    "result_cells": with_(*CLEAN_TRIMMED)
    + " union all ".join(
        f"select '{RUN_ID}:' || code as row_key, '{family}' as family, '{name}' as qualifier, "
        f"{value} as value from clean"
        for family, name, value in [
            ("model", "run_id", f"'{RUN_ID}'"),
            ("model", "cluster", f"cast(length(code) % {CLUSTERS} as varchar)"),
            ("model", "created_at", f"'{PUBLISHED_AT}'"),
            ("info", "product_name", "coalesce(product_name, '')"),
            ("info", "categories", "coalesce(categories, '')"),
        ]
    ),
    "kmeans_assign": with_(*ASSIGNED)
    + "select code, cast(cluster as int) as cluster, round(distance, 6) as distance from assigned",
    "lloyd_step": with_(*ASSIGNED)
    + "select cast(cluster as int) as cluster, "
    + csv(f"round(avg({n}), 6) + 0.0 as {n}" for n in FEATURE_SLOTS)
    + " from assigned group by cluster",
    "silhouette": with_(*ASSIGNED, SILHOUETTE)
    + """select round(avg(case when n = 1 then 0.0 when a < b then 1 - a / b
  when a > b then b / a - 1 else 0.0 end), 6) + 0.0 as silhouette from scored""",
    "cluster_sizes": with_(*ASSIGNED)
    + "select cast(cluster as int) as cluster, cast(count(*) as bigint) as count "
    + "from assigned group by cluster",
    "run_metrics": with_(*ASSIGNED, "sizes as (select cluster, count(*) as n from assigned group by 1)")
    + f"""select '{ALGORITHM}' as algorithm, {CLUSTERS} as cluster_count,
  '{{' || string_agg('"' || cluster || '":' || n, ',' order by cluster) || '}}' as cluster_sizes,
  (select cast(count(*) as bigint) from raw) as input_rows,
  {MAX_ITERATIONS} as max_iterations, cast({SEED} as bigint) as seed,
  cast(sum(n) as bigint) as usable_rows
from sizes""",
    "kmeans_fit": with_(f"points as (select l_linenumber % 4 as g, {csv(separated_points('varchar'))} from lineitem)")
    + f"""select cast(row_number() over (order by {csv(FEATURE_SLOTS)}) - 1 as int) as cluster, *
from (select {csv(f"round(avg({n}), 6) + 0.0 as {n}" for n in FEATURE_SLOTS)} from points group by g)""",
    "segment_products": with_(*CLEAN_TRIMMED)
    + "select code, product_name, categories, true as nearest, true as centred from clean",
    "segment_prepared": "select cast(vec_id as varchar) as code, '' as product_name, "
    "cast(label as varchar) as categories, true as nearest, true as centred from embeddings",
    "saved_model": "select cast(vec_id as varchar) as code, true as same from embeddings",
    "tracked_runs": with_(RAW, clean(False))
    + """select 'good' as run_id, 'complete' as status, cast(count(*) as varchar) as published_rows,
  '0.5' as silhouette, 'data-mart' as source from clean
union all select 'bad', 'failed', null, null, null""",
    "predictions_sink": with_(*CLEAN_TRIMMED)
    + f"select *, cast(length(code) % {CLUSTERS} as int) as cluster from clean",
    "word_count": WORD_COUNT,
    "word_count_lines": WORD_COUNT,
}
