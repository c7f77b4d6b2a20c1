"""DuckDB statements for the pN_ queries that SQL can express."""

_LATEST = """
latest as (
  select * from (
    select *, row_number() over (partition by image_id order by scanned_at desc nulls last, ingested_at desc nulls last{ties}) as rn
    from image_metrics where image_id is not null) where rn = 1)
"""


def _score(name: str) -> str:
    return f"case when isnan({name}) then null else {name} end"


def _p1() -> str:
    names = ["sharpness", "face_sharpness", "exposure_score", "total_score"]
    parts = " union all ".join(
        f"select image_id, cast(floor(1e18 / (60 + rank() over (order by {n} desc))) as bigint) as part from s where {n} is not null" for n in names
    )
    return (
        "with" + _LATEST.format(ties="".join(f", {_score(n)} desc nulls last" for n in names))
        + f", s as (select image_id, {', '.join(f'{_score(n)} as {n}' for n in names)} from latest)"
        + f", parts as ({parts} union all select image_id, 0 from s)"
        + ", sums as (select image_id, cast(sum(part) as bigint) as fused from parts group by image_id)"
        + " select image_id, fused, rank() over (order by fused desc) as position from sums"
    )


_CELLS = """
with cells as (
  select distinct image_id, replace(replace(trim(lower(composition)), ' ', '-'), '_', '-') as c, year as y
  from image_metrics where image_id is not null),
size as (select count(distinct image_id) // 20 as s from cells),
have as (
  select t.target_id, t.min_rows, t.target_permille, count(distinct p.image_id) as available
  from sample_targets t left join cells p
    on t.composition is not distinct from p.c and t.year is not distinct from p.y
  group by all)
"""

_TOP3 = "with" + _LATEST.format(ties="") + """,
ranked as (
  select trigger_word, year, image_id, total_score,
    row_number() over (partition by trigger_word, year order by total_score desc, image_id) as "rank"
  from latest where total_score is not null and not isnan(total_score))
"""

_LEAKS = r"""
with words as (
  select 0 as kind, doc_id as id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null
  union all
  select 1, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from eval_items where text is not null),
runs as (
  select distinct kind, id, array_to_string(w[i:i + 12], ' ') as run
  from (select kind, id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)),
leaks as (select distinct d.id as doc_id, e.id as item_id from runs d join runs e on d.run = e.run and d.kind = 0 and e.kind = 1)
"""

_VECTORS = """
with recursive vectors as (
  select distinct image_id, feature_vector::double[] as v from image_metrics
  where image_id is not null and len(feature_vector) = 64 and len(list_filter(feature_vector, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(feature_vector, lambda x: x <> 0)) > 0),
unit as (select image_id, v, sqrt(list_dot_product(v, v)) as n from vectors),
near as (
  select distinct a.image_id as a, b.image_id as b, list_dot_product(a.v, b.v) / (a.n * b.n) as similarity
  from unit a join unit b on a.image_id < b.image_id where list_dot_product(a.v, b.v) / (a.n * b.n) > 0.94)
"""
_REACH = """,
links as (select a as u, b as w from near where 1 - similarity < 0.05 union select b, a from near where 1 - similarity < 0.05),
reach(id, other) as (select distinct image_id, image_id from unit union select r.id, l.w from reach r join links l on l.u = r.other)
"""

SQL = {
    "p1_fused_ranking": _p1(),
    "p2_found": _CELLS + "select target_id from have, size where available < greatest(min_rows, cast(ceil(target_permille * s / 1000.0) as bigint))",
    "p3_found": _VECTORS + _REACH + "select id as image_id from reach group by id having count(*) >= 10",
    "p4_found": _VECTORS + "select distinct a as image_id_a, b as image_id_b from near where similarity >= 0.98",
    "p5_found": _TOP3 + 'select image_id from ranked where "rank" <= 3',
    "p5_top3": _TOP3 + 'select trigger_word, year, image_id, total_score, "rank" from ranked where "rank" <= 3',
    "p8_found": _LEAKS + "select doc_id, item_id from leaks",
    "p8_report": _LEAKS + "select e.item_id, count(l.doc_id) as documents from (select distinct item_id from eval_items) e left join leaks l on l.item_id = e.item_id group by 1",
}
