"""DuckDB statements with the rows that the catalogue's queries must give.

DuckDB's patterns know only ASCII white space and have no literal quoting, so
white space is spelled out and triggers are escaped by a function.
"""

from __future__ import annotations

from framewright.functions import geometry, text
from framewright.operators import ranking, selection

WS = r"\s\x0B\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
POOL, SEATS, CLOSE = 100, 30, 0.6
METRICS = ranking.METRICS


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def regex(pattern: str) -> str:
    return quote(pattern.replace(r"\s", f"[{WS}]"))


def strip(x: str, chars: str = WS) -> str:
    return f"regexp_replace({x}, {quote(f'^[{chars}]+|[{chars}]+$')}, '', 'g')"


def sub(x: str, pattern: str, replacement: str, flags: str = "gi") -> str:
    return f"regexp_replace({x}, {regex(pattern)}, {quote(replacement)}, {quote(flags)})"


def words(x: str) -> str:
    return f"case when {strip(x)} = '' then 0 else len(string_split_regex({strip(x)}, {quote(f'[{WS}]+')})) end"


def chain(source: str, steps: list[tuple[str, str]]) -> str:
    """Nested selects, each adding one column that the next ones may use."""
    sql = source
    for name, expr in steps:
        sql = f"select *, {expr} as {name} from ({sql})"
    return sql


REC = """select * replace (regexp_replace(lower(trim(composition)), '[ _]', '-', 'g') as composition) from (
  select *, row_number() over (partition by path order by scanned_at desc nulls last, ingested_at desc nulls last, total_score desc nulls last) as rn_
  from image_metrics where path is not null) where rn_ = 1"""
DOCS = "select doc_id, text, trigger_word from documents"

# ---- captions ----------------------------------------------------------------------------------


def has_hands(x: str) -> str:
    return "(" + " or ".join(f"contains(lower({x}), {quote(w)})" for w in text.HAND_WORDS) + ")"


def ends(x: str) -> str:
    return f"(right({x}, 1) in ('.', '!', '?'))"


def count_of(x: str, phrase: str) -> str:
    return f"((length({x}) - length(replace({x}, {quote(phrase)}, ''))) // {len(phrase)})"


def audit(source: str, caption: str, trigger: str) -> str:
    usable = f"coalesce({strip(trigger)}, '') <> ''"
    rules = [
        "case when n_ < 20 then 'Too short (' || n_ || ' words, minimum 20)' when n_ > 95 then 'Too long (' || n_ || ' words, maximum 95)' end",
        f"case when c_ = 0 then 'Missing trigger word ''' || {trigger} || '''' when c_ > 1 then 'Duplicate trigger word ''' || {trigger} || ''' (' || c_ || ' occurrences)' end",
        *[f"case when {count_of('low_', shot)} > 1 then {quote(f"Duplicate framing phrase '{shot}'")} end" for shot in text.FRAMINGS],
        *[f"case when regexp_matches(t_, {regex(p)}, 'i') then {quote(f"Banned cliché / meta-fluff: '{name}'")} end" for p, name in text.BANNED],
        f"case when not {has_hands('t_')} then {quote("Missing explicit hand placement (state location or 'hands are out of frame')")} end",
        f"case when not {ends('t_')} then 'Missing terminal punctuation' end",
    ]
    return chain(
        source,
        [
            ("t_", strip(f"coalesce({caption}, '')")), ("low_", "lower(t_)"), ("n_", words("t_")),
            ("c_", f"case when {usable} then len(regexp_extract_all(t_, '(?i)\\b' || regexp_escape({trigger}) || '\\b')) end"),
            ("v_", f"case when t_ = '' then ['Caption is empty'] else list_filter([{', '.join(rules)}], lambda x: x is not null) end"),
            ("p_", "len(v_) = 0"),
        ],
    )


AUDIT = audit(DOCS, "text", "trigger_word")


def sanitized(source: str, caption: str, name: str) -> str:
    steps = [("s_", strip(f"coalesce({caption}, '')"))]
    expr = "s_"
    for pattern, replacement in text.SANITIZE:
        expr = sub(expr, pattern, replacement)
    steps += [
        ("s1_", expr), ("s2_", f"case when {has_hands('s1_')} then s1_ else regexp_replace(s1_, '[. ]+$', '') || '. Hands are out of frame.' end"),
        ("s3_", strip(sub("s2_", r"\s+", " "))), ("s4_", sub(sub("s3_", r"\s+([.,;])", r"\1"), r",\s*\.", ".")), (name, f"case when {ends('s4_')} then s4_ else s4_ || '.' end"),
    ]
    return chain(source, steps)


def lead(trigger: str, composition: str) -> str:
    nouns = "[" + ", ".join(map(quote, text.CLASS_NOUNS)) + "]"
    subject = f"case when list_has_any(string_split_regex(lower({trigger}), {quote(f'[{WS}]+')}), {nouns}) then {trigger} else {trigger} || ' woman' end"
    shot = f"case {composition} when 'close-up' then 'close-up' when 'medium' then 'waist-up' when 'full-body' then 'full-body' else 'portrait' end"
    return f"({subject} || ', a ' || {shot} || ' shot')"


def cleaned(source: str, raw: str, trigger: str, opening: str) -> str:
    edge = r" ,.\-"
    noun = "(?:woman|man|person|model)"
    steps = [
        ("a1_", strip(f"coalesce({raw}, '')")),
        ("a2_", "regexp_replace(regexp_replace(a1_, '^```[a-zA-Z]*\\n?', ''), '\\n?```$', '')"),
        ("a3_", strip("replace(a2_, '`', '')", "\"' ")),
        ("a4_", strip(sub("a3_", text.PREAMBLES[0], "", "i"))), ("a5_", strip(sub("a4_", text.PREAMBLES[1], "", "i"))),
        ("a6_", f"string_split_regex(a5_, {regex('(?i)' + chr(92) + 'n' + chr(92) + 's*tags?' + chr(92) + 's*:')})[1]"),
        ("a7_", sub("a6_", r"(?m)^tags?\s*:.*$", "")),
        ("l1_", f"list_filter(list_transform(string_split(a7_, chr(10)), lambda x: {strip('x')}), lambda x: x <> '' and not regexp_matches(x, {regex('(?i)^tags?' + chr(92) + 's*:')}))"),
        ("l2_", f"list_filter(list_transform(l1_, lambda x: {strip(sub(strip(sub('x', r'^[-*•' + chr(92) + r'd.]+\s*', '', 'i')), text.RUBRIC, '', 'i'))}), lambda x: x <> '')"),
        ("d1_", strip("coalesce(array_to_string(l2_, ' '), '')")), ("line_", sub(sub("d1_", r"\*{1,2}([^*]+)\*{1,2}", r"\1"), r"\s*;\s*", ", ")), ("few_", words("line_")),
    ]
    last = "line_"
    for i in range(text.LOOP_TURNS):
        begun = f"case when starts_with(lower({last}), lower({opening})) then {strip(f'substr({last}, length({opening}) + 1)', edge)} else {last} end"
        free = f"regexp_replace({begun}, '(?i)^(?:' || regexp_escape({trigger}) || {regex(chr(92) + 'b' + chr(92) + 's*' + noun + '?' + chr(92) + 's*[,:-]?' + chr(92) + 's*)+')}, '')"
        steps.append((f"b{i}_", strip(sub(strip(free, edge), text.INTRO, "", "i"), edge)))
        last = f"b{i}_"
    steps += [
        ("e1_", f"regexp_replace({last}, '(?i)\\b' || regexp_escape({trigger}) || {regex(chr(92) + 's+' + noun + chr(92) + 'b')}, 'the subject', 'g')"),
        ("e2_", f"regexp_replace(e1_, '(?i)\\b' || regexp_escape({trigger}) || '\\b', 'she', 'g')"),
        ("e3_", f"case when {' or '.join(f'starts_with(lower(e2_), {quote(c)})' for c in text.CONTINUATIONS)} then {opening} || ' ' || e2_ when e2_ <> '' then {opening} || ', ' || lower(e2_[1]) || substr(e2_, 2) else {opening} || '.' end"),
        ("e4_", strip(sub("e3_", r"\s+", " "))), ("e5_", f"case when {ends('e4_')} then e4_ else e4_ || '.' end"), ("many_", words("e5_")),
        ("reason", f"""case when coalesce({strip(raw)}, '') = '' then 'Empty response body' when line_ = '' then 'Empty response after stripping preambles and tags'
          when few_ < 5 then 'Description too short (' || few_ || ' words)' when many_ < 15 then 'Description too short (' || many_ || ' words)'
          when many_ > 130 then 'Description too long (' || many_ || ' words)' else 'OK' end"""),
        ("ok", "reason = 'OK'"), ("clean", "case when ok then e5_ else '' end"),
    ]
    return chain(source, steps)


ATTEMPTS = chain(
    f"""select a.attempt_id, a.image_id, a.attempt, a.content, coalesce(r.trigger_word, 'subject') as trigger, r.composition
    from (select distinct attempt_id, image_id, attempt, content from caption_attempts) a left join ({REC}) r on r.image_id = a.image_id""",
    [("opening", lead("trigger", "composition"))],
)
CLEAN = cleaned(ATTEMPTS, "content", "trigger", "opening")
CHECKED = audit(CLEAN, "clean", "trigger")
CHOSEN = f"""select image_id, attempt, clean, ok and p_ as good from ({CHECKED}) where ok"""
PAIRS = f"""select r.image_id, case when c.image_id is null then 'missing' when {strip("coalesce(c.content, '')")} = '' then 'empty'
  when coalesce({strip('r.trigger_word')}, '') <> '' and not contains(lower({strip("coalesce(c.content, '')")}), lower(r.trigger_word)) then 'trigger_missing' else 'ok' end as status
  from ({REC}) r left join (select * from (select image_id, content, row_number() over (partition by image_id order by attempt desc, attempt_id desc) as k from caption_attempts) where k = 1) c
  on c.image_id = r.image_id"""

# ---- sizes, scores, pools ----------------------------------------------------------------------

_LONG = "greatest(width, height)"
_FACE = "face_box is not null"


def snap(x: str) -> str:
    return f"greatest(64, cast(round_even({x} / 64.0, 0) * 64 as int))"


def number(m: str) -> str:
    return f"case when {m} is null or isnan({m}) then 0.0::double else {m} end"


CEILINGS = "select " + ", ".join(f"coalesce(quantile_cont({m}, 0.95) filter (where {m} > 0 and not isnan({m})), 1.0::double) as ceil_{m}" for m in METRICS) + f" from ({REC})"


def unit(m: str) -> str:
    return f"least(1.0::double, ({number(m)}) / ceil_{m})"


_W = {k: f"{v}::double" for k, v in ranking.WEIGHTS.items()}
BASE = (
    f"select *, {_W['sharpness']} * {unit('sharpness')} + {_W['face_sharpness']} * {unit('face_sharpness')} + {_W['exposure_score']} * ({number('exposure_score')})"
    f" + {_W['contrast']} * {unit('contrast')} + {_W['colorfulness']} * {unit('colorfulness')} + {_W['noise']} * (1.0::double - {unit('noise')}) as base_score"
)
POSE = "case when head_pose in ('frontal', 'three-quarter-left', 'three-quarter-right') then 0.05::double when head_pose = 'profile' then -0.05::double else 0.0::double end"
HANDS = "case when hands_truncated then -0.05::double else 0.0::double end"
GLASSES = "case when has_sunglasses then -0.15::double else 0.0::double end"


def stratified(where: str = "true", balance: bool = True) -> str:
    """The second pass's pool with ``place``."""
    records = f"select * from ({REC}) where {where}"
    ceil = CEILINGS.replace(f"({REC})", f"({records})")
    targets = ranking.composition_targets(POOL)
    seats = "case comp " + " ".join(f"when '{c}' then {n}" for c, n in targets.items()) + " end"
    order = "case comp when 'close-up' then 1 when 'medium' then 2 else 3 end"
    stage = "case when ry <= share and years > 1 then 1 else 2 end" if balance else "2"
    return f"""
with scored as (select * replace (round(base_score + {POSE} + {HANDS} + {GLASSES}, 9) as total_score),
    case when composition in ('close-up', 'medium', 'full-body') then composition else 'medium' end as comp
    from ({BASE} from ({records}), ({ceil}))),
heads as (select *, row_number() over (partition by comp order by total_score desc, path) as rc from scored),
first as (select * from (select *, row_number() over (order by {order}, rc) as turn from heads where rc <= {seats}) where turn <= {POOL}),
rest as (select * from scored where path not in (select path from first)),
ranked as (select *, row_number() over (partition by year order by total_score desc, path) as ry, row_number() over (order by total_score desc, path) as rk,
    {POOL} - (select count(*) from first) as free, (select count(*) from (select distinct year from rest)) as years from rest),
bins as (select *, greatest(1, free // years) as share, min(rk) over (partition by year) as yf from ranked),
turns as (select *, {stage} as stage, row_number() over (order by {stage}, case when {stage} = 1 then yf end, rk) as turn from bins),
chosen as (select path, composition, year, head_pose, total_score, feature_vector from first union all
    select path, composition, year, head_pose, total_score, feature_vector from turns where turn <= free),
pool as (select *, row_number() over (order by total_score desc, path) as place from chosen)"""


USABLE = "len(feature_vector) = 64 and len(list_filter(feature_vector, lambda x: x is null or not isfinite(x))) = 0"
FEATURES = stratified(USABLE).replace("with scored", "with recursive scored", 1) + """,
unit as (select path, composition, year, head_pose, total_score, place - 1 as i, feature_vector::double[] as v, sqrt(list_dot_product(feature_vector::double[], feature_vector::double[])) as n from pool),
d as (select a.i as a, b.i as b, a.path as pa, b.path as pb,
    round(case when a.i = b.i then 0.0 when a.n = 0 or b.n = 0 then 1.0 else greatest(0.0, least(2.0, 1 - list_dot_product(a.v, b.v) / (a.n * b.n))) end, 9) as dist from unit a, unit b)"""

GREEDY = f""", close as (select u.i, list(d.b) filter (where d.b < u.i and d.dist < {CLOSE}) as earlier from unit u join d on d.a = u.i group by 1),
  step(i, kept) as (select 0::bigint, [0::bigint] union all
    select s.i + 1, case when list_has_any(coalesce(c.earlier, []::bigint[]), s.kept) then s.kept else list_append(s.kept, s.i + 1) end from step s join close c on c.i = s.i + 1)"""
_SAME = "len(list_filter(p.chosen, lambda j: {0}[j + 1] = {0}[i + 1]))"
_QUOTA = "case comps[i + 1] " + " ".join(f"when '{c}' then {n}" for c, n in selection.composition_quota(SEATS).items()) + " else 0 end"
_IN_COMP = f"coalesce({_SAME.format('comps')} < {_QUOTA}, false)"
_IN_YEAR = f"(years[i + 1] is null or len(ys) < 2 or {_SAME.format('years')} < {SEATS} // len(ys) + case when list_position(ys, years[i + 1]) <= {SEATS} % len(ys) then 1 else 0 end)"
_TIER = f"case when {_IN_COMP} and {_IN_YEAR} then 0 when {_IN_COMP} then -1 when {_IN_YEAR} then -2 else -3 end"
_FAR = f"p.near[i + 1] * case when coalesce(poses[i + 1], '') <> '' and {_SAME.format('poses')} = 0 then 1.05::double else 1.0::double end"
QUOTA_FIRST = GREEDY + f""",
  alive as (select *, row_number() over (order by i) - 1 as s from unit where list_contains((select kept from step order by i desc limit 1), i)),
  mat as (select a.s as i, list(d.dist order by b.s) as row from d join alive a on a.i = d.a join alive b on b.i = d.b group by 1),
  attr as (select list(composition order by s) as comps, list(year order by s) as years, list(head_pose order by s) as poses, count(*) as n, coalesce(list_sort(list(distinct year) filter (where year is not null)), []::int[]) as ys from alive),
  pick(k, chosen, near) as (select 1, [0::bigint], (select row from mat where i = 0) union all
    select q.k + 1, list_append(q.chosen, m.i), list_transform(list_zip(q.near, m.row), lambda x: least(x[1], x[2])) from (
      select p.*, list_max(list_transform(list_filter(range(n), lambda i: not list_contains(p.chosen, i)), lambda i: {{'t': {_TIER}, 'f': {_FAR}, 'i': -i}})) as best from pick p, attr where p.k < {SEATS}) q
      join mat m on m.i = -q.best.i)
  select path, turn from (select unnest(chosen) as s, unnest(range(1, len(chosen) + 1)) as turn from (select chosen from pick order by k desc limit 1)) join alive using (s)"""

VERDICTS = f"""select r.path, coalesce(v.is_single, true) as v_single, case when lower(trim(v.lighting)) = 'outdoor' then 'Outdoor' else 'Indoor' end as v_lighting,
  coalesce(v.has_sunglasses, false) as v_sunglasses, coalesce(v.has_face_occlusion, false) as v_occlusion from ({REC}) r left join (
  select * from (select *, row_number() over (partition by path order by checked_at desc nulls last, is_single desc nulls last, lighting desc nulls last, has_sunglasses desc nulls last, has_face_occlusion desc nulls last) as k
    from vlm_verdicts) where k = 1) v on v.path = r.path"""


def _picked(order_by: str) -> str:
    """The portfolio's paths with their seats, from the last state of a stage."""
    return f" select path, seat from (select unnest(refined) as i, unnest(range(1, len(refined) + 1)) as seat from (select refined from {order_by} order by k desc limit 1)) join unit using (i)"


# The fold's state is two lists of places, the portfolio and the pool; each recursion step is one swap.
REFINE = (
    FEATURES
    + QUOTA_FIRST.replace("\n  select path, turn from (", ",\n  sel as (select alive.i, turn from (", 1)
    + f"""),
  facts as (select list(composition order by i) as comps, list(total_score order by i) as scores, list(v_single order by i) as single, list(v_lighting = 'Outdoor' order by i) as outdoor, list(v_sunglasses order by i) as glasses, list(v_occlusion order by i) as covered
    from unit join ({VERDICTS}) using (path)),
  dupes as (select list(nr order by i) as near from (select a as i, list(b) filter (where dist < 0.05) as nr from d group by 1)),
  middle as (select list(m order by pos) as mv from (select pos, median(x) as m from (select unnest(v) as x, unnest(range(64)) as pos from unit join sel using (i)) group by 1)),
  gone as (select list(i order by away, i) as removed from (select *, row_number() over (order by away desc, i desc) as r, count(*) over () as n from (
    select i, round(case when n = 0 then 1.0 else 1 - list_dot_product(v, mv) / (n * sqrt(list_dot_product(mv, mv))) end, 9) as away from unit join sel using (i), middle)) where r <= greatest(1, trunc(n * 0.05)::int)),
  stage_a(k, refined, rest) as (
    select 0, (select list(i order by turn) from sel, gone where not list_contains(removed, i)), (select list(i order by i) from unit where i not in (select sel.i from sel, gone where not list_contains(removed, sel.i)))
    union all
    select k + 1, case when new is null then refined else list_append(refined, new) end, list_filter(rest, lambda x: x is distinct from new) from (
      select *, coalesce(list_filter(fresh, lambda x: comps[x + 1] is not distinct from comps[removed[k + 1] + 1])[1], fresh[1]) as new from (
        select a.*, comps, removed, list_filter(rest, lambda x: not list_has_any(near[x + 1], refined)) as fresh from stage_a a, facts, dupes, gone where k < len(removed)))),
  stage_b(k, refined, rest, several, seen) as (
    select 0, refined, rest, list_filter(refined, lambda x: not single[x + 1]), refined from (select * from stage_a order by k desc limit 1), facts
    union all
    select k + 1, case when new is null then left_ else list_append(left_, new) end, list_filter(rest, lambda x: x is distinct from new), several, list_concat(seen, case when new is null then cand else cand[1:list_position(cand, new)] end) from (
      select *, list_filter(cand, lambda x: single[x + 1])[1] as new from (select *, list_filter(rest, lambda x: not list_has_any(near[x + 1], left_)) as cand from (
        select b.*, single, near, list_filter(refined, lambda x: x <> several[k + 1]) as left_ from stage_b b, facts, dupes where k < len(several))))),
  stage_c(k, refined, rest, problem, seen) as (
    select 0, refined, rest, list_filter(refined, lambda x: glasses[x + 1] or covered[x + 1]), seen from (select * from stage_b order by k desc limit 1), facts
    union all
    select k + 1, case when new is not null then list_append(left_, new) when DROP_ and glasses[problem[k + 1] + 1] then left_ else refined end, list_filter(rest, lambda x: x is distinct from new), problem,
      list_concat(seen, case when new is null then cand else cand[1:list_position(cand, new)] end) from (
      select *, list_filter(cand, lambda x: single[x + 1] and not glasses[x + 1] and not covered[x + 1])[1] as new from (
        select *, list_transform(list_sort(list_transform(list_filter(rest, lambda x: not list_has_any(near[x + 1], refined)),
          lambda x: {{'m': comps[x + 1] is distinct from comps[problem[k + 1] + 1], 's': -scores[x + 1], 'x': x}})), lambda t: t.x) as cand from (
          select c.*, single, glasses, covered, comps, scores, near, list_filter(refined, lambda x: x <> problem[k + 1]) as left_ from stage_c c, facts, dupes where k < len(problem))))),
  share_ as (select len(list_filter(refined, lambda x: outdoor[x + 1])) > len(list_filter(refined, lambda x: not outdoor[x + 1])) as outs, greatest(len(list_filter(refined, lambda x: outdoor[x + 1])), len(list_filter(refined, lambda x: not outdoor[x + 1]))) as have
    from (select * from stage_b order by k desc limit 1), facts),
  begin_d as (select *, have - trunc(len(refined) * 0.7::double)::int as most, list_transform(list_sort(list_transform(refined, lambda x: {{'s': scores[x + 1], 'x': x}})), lambda t: t.x) as weak from (select * from stage_c order by k desc limit 1), facts, share_),
  stage_d(k, refined, rest, seen, vacant, most, leaving) as (
    select 0, case when most > 0 then weak else refined end, rest, seen, case when most > 0 then list_filter(weak, lambda x: outdoor[x + 1] = outs) else []::bigint[] end, most, []::bigint[] from begin_d
    union all
    select k + 1, case when new is null then refined else list_append(refined, new) end, list_filter(rest, lambda x: x is distinct from new), list_concat(seen, case when new is null then reach else list_filter(reach, lambda x: x <= new) end),
      vacant, most, case when new is null then leaving else list_append(leaving, vacant[k + 1]) end from (
      select *, list_filter(reach, lambda x: outdoor[x + 1] <> outs and (single[x + 1] or list_contains(seen, x)))[1] as new from (
        select *, list_filter(cand, lambda x: len(list_filter(cand, lambda y: y <= x and not list_contains(seen, y))) <= 6) as reach from (
          select d.*, outs, single, outdoor, list_sort(list_filter(rest, lambda x: comps[x + 1] is not distinct from comps[vacant[k + 1] + 1] and not list_has_any(near[x + 1], refined))) as cand
          from stage_d d, facts, dupes, share_ where k < len(vacant) and len(leaving) < most)))),
  result_d as (select 0 as k, list_filter(refined, lambda x: not list_contains(leaving, x)) as refined, rest from (select * from stage_d order by k desc limit 1)),
  begin_e as (select rest, list_transform(list_sort(list_transform(refined, lambda x: {{'s': scores[x + 1], 'x': x}})), lambda t: t.x) as weak from result_d, facts),
  stage_e(k, weak, rest, leaving, arriving) as (
    select 0, weak, rest, []::bigint[], []::bigint[] from begin_e
    union all
    select k + 1, weak, list_filter(rest, lambda x: x is distinct from new), case when new is null then leaving else list_append(leaving, weak[k + 1]) end, case when new is null then arriving else list_append(arriving, new) end from (
      select e.*, list_filter(list_sort(rest), lambda x: comps[x + 1] is not distinct from comps[weak[k + 1] + 1] and scores[x + 1] > scores[weak[k + 1] + 1] and not list_has_any(near[x + 1], weak))[1] as new
      from stage_e e, facts, dupes where k < greatest(1, trunc(len(weak) * 0.1::double)::int) and k < len(weak))),
  result_e as (select 0 as k, list_concat(list_filter(weak, lambda x: not list_contains(leaving, x)), arriving) as refined from (select * from stage_e order by k desc limit 1))"""
)

_BLUR = f"""
select path, x0, y0, x1, y1 from (
  select path, greatest(0, greatest(0, trunc(lx)::int) - {geometry.PAD}) as x0, least(width, least(width, trunc(hx)::int) + {geometry.PAD}) as x1,
    case when (ly + hy) / 2 < m then greatest(0, greatest(0, trunc(ly)::int) - {geometry.PAD}) else greatest(height - m, greatest(height - m, trunc(ly)::int) - {geometry.PAD}) end as y0,
    case when (ly + hy) / 2 < m then least(m, least(m, trunc(hy)::int) + {geometry.PAD}) else least(height, least(height, trunc(hy)::int) + {geometry.PAD}) end as y1
  from (select *, list_min(list_transform(b.poly, lambda p: p.x)) as lx, list_max(list_transform(b.poly, lambda p: p.x)) as hx,
      list_min(list_transform(b.poly, lambda p: p.y)) as ly, list_max(list_transform(b.poly, lambda p: p.y)) as hy
    from (select r.path, r.width, r.height, trunc(r.height * 0.15)::int as m, unnest(o.boxes) as b from ({REC}) r join ocr_boxes o on o.path = r.path))
  where b.prob > 0.3 and length(trim(b.text)) >= 2 and ((ly + hy) / 2 < m or (ly + hy) / 2 >= height - m))
where x1 > x0 and y1 > y0"""

# ---- pixels ------------------------------------------------------------------------------------


def _value(a: int, b: int, c: int) -> str:
    return f"case when p_partkey % 5 = 0 and (y < 1 or y >= 11) then 3 else (p_partkey * {a} + y * {b} + x * {c}) % 256 end"


GRID = f"""select *, round_even(0.299::double * r + 0.587::double * g + 0.114::double * b, 0)::int as c from (
  select p_partkey as img_id, y, x, {_value(13, 5, 3)} as b, {_value(31, 17, 7)} as g, {_value(7, 11, 19)} as r
  from part, (select unnest(range(12)) as y), (select unnest(range(12)) as x))"""


def _sides(axis: str, other: str) -> str:
    w = f"over (partition by img_id, {other} order by {axis})"
    return f"coalesce(lag(c) {w}, lead(c) {w}, c) + coalesce(lead(c) {w}, lag(c) {w}, c)"


def _sharpness(grid: str) -> str:
    return f"select img_id, var_pop(lap::double) as s from (select *, {_sides('x', 'y')} + {_sides('y', 'x')} - 4 * c as lap from ({grid})) group by img_id"


_FACE_GRID = f"select g.* from ({GRID}) g where x >= greatest(img_id % 6 - 2, 0) and x < img_id % 6 + 4 and y >= img_id % 5 and y < img_id % 5 + 5"
_NOISE = f"""select img_id, round(avg(m), 6) as noise from (select img_id, abs(c - list_sort(list_concat(coalesce(lag(t) over w, t), t, coalesce(lead(t) over w, t)))[5]) as m
  from (select *, [coalesce(lag(c) over v, c), c, coalesce(lead(c) over v, c)] as t from ({GRID}) window v as (partition by img_id, y order by x)) window w as (partition by img_id, x order by y)) group by 1"""
_LINES = f"""select img_id, axis, spot, avg((b + g + r) / 3.0) as level from (select img_id, 'row' as axis, y as spot, b, g, r from ({GRID}) union all select img_id, 'col', x, b, g, r from ({GRID})) group by all"""
_NEAR = {
    "r": "x >= 2 - rad and x < 2 + rad and y >= 4 - rad and y < 4 + rad",
    "l": "x >= lx - rad and x < lx + rad and y >= 4 - rad and y < 4 + rad",
    "s": "y >= 7 and y < 7 + trunc(d * 0.4)::int and x >= 6 - rad and x < 6 + rad",
}
_PATCHES = f"""select img_id, d, avg(c) filter (where {_NEAR['r']}) as er, avg(c) filter (where {_NEAR['l']}) as el, avg(c) filter (where {_NEAR['s']}) as sk
  from (select *, greatest(2, trunc(d * 0.22)::int) as rad from (select *, 8 + img_id % 3 as lx, (6 + img_id % 3)::double as d from ({GRID}))) group by all"""

_CROP = f"""select path, w, h, case when w > 1024 then greatest(0, least(w - 1024, trunc(cx - 512.0)::int)) else 0 end as x,
  case when w <= 1024 and h > 1024 then greatest(0, least(h - 1024, case when {_FACE} then trunc(cy - 1024 * 0.35::double)::int else trunc(cy - 512.0)::int end)) else 0 end as y
  from (select *, case when {_FACE} then (face_box.x + face_box.w / 2.0::double) * sc else w / 2.0::double end as cx, case when {_FACE} then (face_box.y + face_box.h / 2.0::double) * sc else h / 2.0::double end as cy
    from (select *, case when height < width then round_even(width * sc, 0)::int else 1024 end as w, case when height < width then 1024 else round_even(height * sc, 0)::int end as h
      from (select *, 1024.0::double / (case when height < width then height else width end) as sc from ({REC}))))"""
_FORM = "case when lower(path) like '%.png' then {0} when lower(path) like '%.webp' then {1} else {2} end"
_EXT, _NAME = _FORM.format("'.png'", "'.webp'", "'.jpg'"), _FORM.format("'PNG'", "'WEBP'", "'JPEG'")

SQL: dict[str, str] = {
    "caption_audit_flags": f"select doc_id, n_ as words, array_to_string(v_, '; ') as violations, p_ as passed from ({AUDIT})",
    "caption_audit_report": f"select count(*) as total, count(*) filter (where p_) as passed_count, case when count(*) > 0 then round(count(*) filter (where p_) * 100.0::double / count(*), 6) else 0.0 end as pass_rate from ({AUDIT})",
    "caption_violation_histogram": f"select trim(regexp_replace(v, '\\(\\d+.*?\\)', '', 'g')) as violation, count(*) as n from (select unnest(v_) as v from ({AUDIT})) group by 1",
    "caption_failed_sample": f"select doc_id, array_to_string(v_, '; ') as violations from ({AUDIT}) where not p_ order by doc_id limit 5",
    "caption_clean": f"select attempt_id, ok, clean as text, reason from ({CLEAN})",
    "caption_sanitize": f"select doc_id, out as text from ({sanitized(DOCS, 'text', 'out')})",
    "first_passing_attempt": f"""select image_id, attempt, case when good then clean else fixed end as caption, not good as repaired from (
        select *, row_number() over (partition by image_id order by good desc, case when good then attempt else -attempt end, clean) as k from ({sanitized(CHOSEN, 'clean', 'fixed')})) where k = 1""",
    "recaption_report": f"with c as materialized (select image_id, ok, clean from ({CLEAN})) select count(*) filter (where ok) as succeeded, count(*) as total from (select image_id, bool_or(ok) as ok from c group by 1)",
    "caption_lead": f"select image_id, {lead('trigger_word', 'composition')} as lead from ({REC})",
    "caption_composition": "select doc_id, case when contains(lower(coalesce(text, '')), 'close-up') then 'close-up' when contains(lower(coalesce(text, '')), 'full-body') then 'full-body' else 'medium' end as composition from documents",
    "retry_temperature": "select distinct attempt_id, round(case when attempt = 1 then 0.2::double else least(0.5::double, 0.2::double + 0.15::double * (attempt - 1)) end, 6) as temperature from caption_attempts",
    "destination_slug": f"select image_id, 'flux-' || replace(lower(trigger_word), '_', '-') || '-lora' as slug from ({REC})",
    "prompt_assembly": f"""select image_id, 'Open with ''' || {lead('trigger_word', 'composition')} || '''. Place the hands' || case when hands_truncated and hand_status is not null then ' (Note: ' || hand_status || ')' else '' end || '.'
        || case when coalesce(year, 0) <> 0 then ' Note that the photo was captured in ' || year || '.' else '' end as prompt from ({REC})""",
    "feedback_prompt": f"""select doc_id, 'Describe the picture.' || case when len(v_) > 0 then chr(10) || chr(10) || 'Your previous caption was rejected for these reasons:' || chr(10) || '- '
        || array_to_string(v_, chr(10) || '- ') || chr(10) || 'Write a corrected caption.' else '' end as prompt from ({AUDIT})""",
    "verdict_parse": "select path, checked_at, coalesce(is_single, false) as is_single, case when contains(coalesce(lighting, ''), 'Outdoor') then 'Outdoor' else 'Indoor' end as lighting, coalesce(has_sunglasses, false) as has_sunglasses, coalesce(has_face_occlusion, false) or coalesce(has_sunglasses, false) as has_face_occlusion from (select distinct * from vlm_verdicts)",
    "pair_validation": PAIRS,
    "package_summary": f"""select *, case when images = 0 then 'no images' when missing > 0 then 'missing captions' when invalid > 0 then 'invalid captions' else 'packaged' end as verdict from (
        select count(*) as images, count(*) filter (where status = 'missing') as missing, count(*) filter (where status in ('empty', 'trigger_missing')) as invalid from ({PAIRS}))""",
    "distinct_paths": "select path, row_number() over (order by path) - 1 as ord from (select distinct path from image_metrics)",
    "dimension_report": f"select path, case when width is null or height is null then 'Failed to load' else width || 'x' || height end as size from ({REC}) order by path limit 20",
    "resolution_filter": f"select path, width, height from ({REC}) where least(width, height) >= 1024 and width is not null and height is not null",
    "era_window": f"select path, year from ({REC}) where year between 2018 and 2022 or not exists (select 1 from ({REC}) where year between 2018 and 2022)",
    "era_window_empty_fallback": f"select path, year from ({REC}) where year between 1901 and 1901 or not exists (select 1 from ({REC}) where year between 1901 and 1901)",
    "capture_dates": f"select image_id, case when captured_at is null or year(captured_at) not between 1970 and 2100 or (image_id % 7 <> 0 and image_id % 11 = 0) then scanned_at else date_trunc('day', captured_at)::timestamp end as taken from ({REC})",
    "composition_class": f"select path, case when rt >= 0.040 then 'close-up' when rt >= 0.025 then 'medium' when rt is not null then 'full-body' end as composition from (select *, (face_box.w::bigint * face_box.h)::double / nullif(width::bigint * height, 0) as rt from ({REC}))",
    "head_pose": """select p_partkey, case when span <= 1e-5 then 'frontal' when q < 0.25 or q > 0.75 then 'profile' when q < 0.40 then 'three-quarter-right' when q > 0.60 then 'three-quarter-left' else 'frontal' end as head_pose
        from (select *, a + b as span, a / nullif(a + b, 0) as q from (select p_partkey, abs(p_partkey * 11 % 1000 / 100.0::double - p_partkey * 3 % 1000 / 100.0::double) as a, abs(p_partkey * 11 % 1000 / 100.0::double - p_partkey * 7 % 1000 / 100.0::double) as b from part))""".replace("% 1000", "% 100"),
    "canonical_scale": f"""select path, greatest(1, round_even(width * s, 0)::int) as w, greatest(1, round_even(height * s, 0)::int) as h, round(s, 9) as scale
        from (select *, case when {_LONG} > 1024 then 1024.0::double / {_LONG} else 1.0::double end as s from ({REC}))""",
    "detection_scale": f"""select path, case when l > 4000 then trunc(width * 4 * (4000.0::double / l))::int else width * 4 end as w, case when l > 4000 then trunc(height * 4 * (4000.0::double / l))::int else height * 4 end as h
        from (select *, {_LONG} * 4 as l from ({REC}))""",
    "native_boxes": f"select path, trunc(face_box.x / 3000.0::double * width)::int as x, trunc(face_box.y / 3000.0::double * height)::int as y, trunc(face_box.w / 3000.0::double * width)::int as w, trunc(face_box.h / 3000.0::double * height)::int as h from ({REC}) where face_box is not null",
    "aspect_bucket": f"""select path, {snap('case when big then trunc(nh * (width::double / height))::int else width end')} as w, {snap('case when big then nh else height end')} as h
        from (select *, width::bigint * height > 1048576 as big, trunc(sqrt(1048576.0::double / (width::double / nullif(height, 0))))::int as nh from ({REC}))""",
    "square_crop": _CROP,
    "watermark_boxes": f"select *, count(*) as n from ({_BLUR}) group by all",
    "watermark_free": f"select path from ({REC}) where path in (select path from ocr_boxes) and path not in (select path from ({_BLUR}))",
    "format_resolution": f"select path, {_NAME} as format, {_EXT} as ext, lower(path) like '%.webp' as discouraged from ({REC})",
    "output_numbering": f"""select path, 'velqo_' || case when k < 1000 then lpad(k::varchar, 3, '0') else k::varchar end || {_EXT} as out_name, {_NAME} as format
        from (select *, row_number() over (order by path) as k from ({REC}) where width > 0 and height > 0 and path not in (select path from ({_BLUR})))""",
    "pixel_laplacian": f"select img_id, round(s, 6) as sharpness from ({_sharpness(GRID)})",
    "pixel_face_sharpness": f"select p_partkey as img_id, round(coalesce(s, 0.0), 6) as face_sharpness from part left join ({_sharpness(_FACE_GRID)}) f on f.img_id = p_partkey",
    "pixel_exposure": f"select img_id, round(greatest(0.0, 1.0 - avg(case when c < 15 or c >= 240 then 1.0::double else 0.0::double end)), 6) as exposure_score from ({GRID}) group by 1",
    "pixel_contrast": f"select img_id, round(stddev_pop(c::double), 6) as contrast from ({GRID}) group by 1",
    "pixel_colorfulness": f"select img_id, round(sqrt(var_pop(rg) + var_pop(yb)) + 0.3::double * sqrt(avg(rg) * avg(rg) + avg(yb) * avg(yb)), 6) as colorfulness from (select img_id, abs(r - g)::double as rg, abs(0.5::double * (r + g) - b) as yb from ({GRID})) group by 1",
    "pixel_noise": _NOISE,
    "letterbox": f"""select p_partkey as img_id, coalesce(lb, false) as letterboxed from part left join (select img_id, bool_or(head / 1.0 > 0.5 and tail / 1.0 > 0.5) as lb from (
        select img_id, axis, sum(case when spot < 1 and level < 18 then 1 else 0 end) as head, sum(case when spot >= 11 and level < 18 then 1 else 0 end) as tail from ({_LINES}) group by all) group by 1) q on q.img_id = p_partkey""",
    "sunglasses_patches": f"select img_id, coalesce(d > 5 and sk > 50 and (er + el) * 0.5 < 70 and (er + el) * 0.5 / nullif(sk, 0) < 0.55, false) as has_sunglasses from ({_PATCHES})",
    "robust_ceiling": "select " + ", ".join(f"round(ceil_{m}, 6) as ceil_{m}" for m in METRICS) + f" from ({CEILINGS})",
    "composite_score": f"select path, round(base_score, 6) as base_score from ({BASE} from ({REC}), ({CEILINGS}))",
    "score_adjustments": f"select path, round({POSE} + {HANDS} + {GLASSES}, 6) as adjustment, round({POSE} + {HANDS}, 6) as adjustment_any_eyewear from ({REC})",
    "stratified_topn": stratified() + " select path, place from pool",
    "stratified_topn_nobalance": stratified(balance=False) + " select path, place from pool",
    "year_bins": f"select year, count(*) as n, min(path) as first_path from ({REC}) group by 1",
    "composition_quota": f"select composition, available, case composition {' '.join(f"when '{c}' then {n}" for c, n in selection.composition_quota(SEATS).items())} end as seats from (select case when composition in ('close-up', 'medium', 'full-body') then composition else 'medium' end as composition, count(*) as available from ({REC}) group by 1)",
    "cosine_pairs": FEATURES + " select least(pa, pb) as a, greatest(pa, pb) as b, round(dist, 6) as distance from d where a < b",
    "near_duplicates": FEATURES + f" select least(pa, pb) as a, greatest(pa, pb) as b, round(dist, 6) as distance from d where a < b and dist < {CLOSE}",
    "greedy_dedup": FEATURES + GREEDY + """
        select path from unit where list_contains((select kept from step order by i desc limit 1), i)""",
    "farthest_first": FEATURES + f""", mat as (select a as i, list(case when a = b then -1.0::double else dist end order by b) as row from d group by 1),
        step(k, last, near) as (select 1, 0::bigint, (select row from mat where i = 0)
            union all select s.k + 1, m.i, list_transform(list_zip(s.near, m.row), lambda x: least(x[1], x[2])) from step s join mat m on m.i = list_position(s.near, list_max(s.near)) - 1 where s.k < {SEATS})
        select u.path, s.k as turn from step s join unit u on u.i = s.last""",
    "quota_farthest_first": FEATURES + QUOTA_FIRST,
    "median_vector": FEATURES + " select pos, round(median(x), 6) as value from (select unnest(v) as x, unnest(range(64))::int as pos from unit) group by 1",
    "consensus_outliers": FEATURES + """, mid as (select list(m order by pos) as mv from (select pos, median(x) as m from (select unnest(v) as x, unnest(range(64)) as pos from unit) group by 1)),
        away as (select path, round(case when n = 0 then 1.0 else 1 - list_dot_product(v, mv) / (n * sqrt(list_dot_product(mv, mv))) end, 9) as distance from unit, mid)
        select path, round(distance, 6) as distance from (select *, row_number() over (order by distance desc, path desc) as k, count(*) over () as n from away) where k <= greatest(1, trunc(n * 0.05)::int)""",
    "verdict_join_failopen": VERDICTS,
    "lighting_counts": f"select count(*) filter (where v_single and v_lighting <> 'Outdoor') as indoor, count(*) filter (where v_single and v_lighting = 'Outdoor') as outdoor from ({VERDICTS})",
}


def _inside(p: str) -> str:
    return f"({p}.x > 0.02 and {p}.x < 0.98::double and {p}.y > 0.02 and {p}.y < 0.98::double)"


def _hand(x: str, y: str) -> str:
    return f"list_transform(range(21), lambda i: {{'x': ({x}) / 100.0::double, 'y': {y}}})"


def _cut(hand: str) -> str:
    return f"({_inside(hand + '[1]')} and not (" + " and ".join(_inside(f"{hand}[{i + 1}]") for i in (4, 8, 12, 16, 20)) + "))"


_TWO = [_hand(f"(p_partkey * {a} + i * 7) % 101", f"(p_partkey + i * {a}) % 97 / 96.0::double") for a in (3, 5, 9)]
SQL["hand_truncation"] = f"""select p_partkey, n as hand_count, n > 0 and cut as hands_truncated, case when n = 0 then null when cut then 'hands partially cropped at image edge' else n || ' hands visible' end as hand_status from (
    select p_partkey, case p_partkey % 4 when 0 then 0 when 1 then 1 else 2 end as n, case p_partkey % 4 when 0 then false when 1 then {_cut('h3')} else {_cut('h5')} or {_cut('h9')} end as cut
    from (select p_partkey, {_TWO[0]} as h3, {_TWO[1]} as h5, {_TWO[2]} as h9 from part))"""
SQL["face_geometry_filter"] = f"""select path, case when q >= 0.040 then 'close-up' when q >= 0.025 then 'medium' else 'full-body' end as composition,
    case when pr + pl <= 1e-5 then 'frontal' when pr / (pr + pl) < 0.25 or pr / (pr + pl) > 0.75 then 'profile' when pr / (pr + pl) < 0.40 then 'three-quarter-right' when pr / (pr + pl) > 0.60 then 'three-quarter-left' else 'frontal' end as head_pose,
    1 as hand_count, cut as hands_truncated, case when cut then 'hands partially cropped at image edge' else '1 hands visible' end as hand_status
  from (select *, {_cut('h')} as cut, (bw::bigint * bh)::double / (w::bigint * hh) as q, abs(nx - rx) as pr, abs(nx - lx) as pl from (
    select *, trunc(0.2::double * w)::int as bw, trunc(0.25::double * hh)::int as bh, {_hand('(k * 3 + i * 7) % 101', '0.5::double')} as h from (
    select p_partkey::varchar as path, p_partkey as k, p_partkey * 37 % 2000 + 500 as w, p_partkey * 41 % 2000 + 500 as hh, 0.5::double + p_partkey * 19 % 50 * 0.01::double as score, p_partkey * 23 % 60 * 0.01::double as y,
      0.40::double - (p_partkey * 3 + 1) % 10 * 0.005::double as rx, 0.43::double + (p_partkey * 7 + 2) % 10 * 0.005::double as lx, 0.40::double + (p_partkey * 11 + 3) % 20 * 0.005::double as nx,
      0.26::double + p_partkey * 13 % 20 * 0.01::double as ny, 0.31::double + (p_partkey * 17 + 5) % 20 * 0.01::double as my, (0.30::double + 0.31::double) * 0.5::double as eye from part where p_partkey % 9 > 1)))
  where least(w, hh) >= 1024 and score >= 0.65 and y <= 0.48 and sqrt((lx - rx) ** 2 + (0.31::double - 0.30::double) ** 2) >= 0.040 and my > eye + 0.025::double and ny >= eye - 0.03::double and ny <= my + 0.03::double and bw > 0 and bh > 0"""
for _name, _stage in (("outlier_replacement", "stage_a"), ("single_subject_swap", "stage_b"), ("face_integrity_swap", "stage_c"), ("lighting_rebalance", "result_d"), ("aesthetic_lift", "result_e")):
    SQL[_name] = REFINE.replace("DROP_", "true" if _stage == "stage_c" else "false") + _picked(_stage)
# The whole run: an era first, pictures without a usable vector only leave after the second pass, production distance.
_ERA = f"(year between 2015 and 2025 or not exists (select 1 from ({REC}) where year between 2015 and 2025))"
SQL["curation"] = (
    REFINE.replace("DROP_", "false").replace(stratified(USABLE).replace("with scored", "with recursive scored", 1), stratified(_ERA).replace("with scored", "with recursive scored", 1))
    .replace("place - 1 as i", "row_number() over (order by place) - 1 as i").replace(" from pool),", f" from pool where {USABLE}),", 1).replace(f"d.dist < {CLOSE}", "d.dist < 0.05")
    + _picked("result_e").replace("select path, seat", "select seat, path, composition, year, head_pose, total_score")
)
SQL["composition_class_counts"] = f"select composition, count(*) as n from ({SQL['composition_class']}) group by 1"
SQL["picture_metrics"] = (
    "select img_id, sharpness, face_sharpness, exposure_score, contrast, colorfulness, noise, letterboxed from "
    + " join ".join(f"({SQL[k]}) {k} using (img_id)" if i else f"({SQL[k]}) {k}" for i, k in enumerate(("pixel_laplacian", "pixel_face_sharpness", "pixel_exposure", "pixel_contrast", "pixel_colorfulness", "pixel_noise", "letterbox")))
)
