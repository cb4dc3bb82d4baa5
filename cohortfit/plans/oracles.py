"""The registered queries once more, as SQL for an independent engine."""

from __future__ import annotations

M = 2147483647


def h01(*parts: str) -> str:
    """Uniform number from the first six hex digits of an md5; parts are SQL text."""
    joined = " || ':' || ".join(parts)
    return f"(cast(('0x' || substr(md5({joined}), 1, 6)) as bigint) / cast(16777216 as double))"


def txt(expr: str) -> str:
    return f"cast({expr} as varchar)"


def split_case(group: str, key: str) -> str:
    return (
        f"case when row_number() over (partition by {group} order by md5('123:' || {txt(key)}), {key}) "
        f"<= ceil(cast(0.33 as double) * count(*) over (partition by {group})) then 'test' else 'train' end"
    )


EVT = "evt as (select event_id, event_type, user_id, ts, value from events)"
ORD = """ord as (
  select o_orderkey, c_mktsegment as segment, cast(o_orderstatus = 'F' as int) as label,
         o_orderpriority, o_totalprice, c_acctbal
  from orders join customer on o_custkey = c_custkey)"""
DOC = """doc as (
  select d.doc_id, d.lang, d.source, l.quality, cast(d.n_chars as double) as n_chars,
         cast(len(string_split(d.text, ' ')) as double) as n_words,
         cast(len(list_distinct(string_split(lower(d.text), ' '))) as double) / len(string_split(d.text, ' ')) as unique_ratio,
         cast(length(regexp_replace(d.text, '[^A-Za-z ]', '', 'g')) as double) / nullif(cast(d.n_chars as double), 0) as letter_share,
         cast(length(regexp_replace(d.text, '[^0-9]', '', 'g')) as double) / nullif(cast(d.n_chars as double), 0) as digit_share
  from documents d join labels l on d.doc_id = l.doc_id)"""

EVT_MASKED = f"""{EVT}, masked as (
  select event_id, event_type,
         case when {h01("'7'", "'value'", txt("event_id"))} >= 0.05 then value end as value
  from evt)"""

EVT_NAN = "evt as (select event_id, event_type, case when event_id % 7 <> 0 then value end as value from events)"


def _mask(column: str) -> str:
    return f"case when {h01(repr('7'), repr(column), txt('o_orderkey'))} >= 0.05 then {column} end as {column}"


ORD_MASKED = f"""{ORD}, masked as (
  select o_orderkey, segment, label, {_mask("o_orderpriority")}, {_mask("o_totalprice")}, {_mask("c_acctbal")}
  from ord)"""


def encoded(with_split: bool) -> str:
    where = "where split = 'train'" if with_split else ""
    keep = "m.split, " if with_split else ""
    return f"""
with {ORD_MASKED}, m as (
  select *, {split_case("segment", "o_orderkey")} as split from masked
), stats as (
  select segment, list_sort(list(distinct coalesce(o_orderpriority, '~null'))) as cats,
         median(o_totalprice) as m1, median(c_acctbal) as m2
  from m {where} group by segment
), vec as (
  select m.segment, m.o_orderkey, m.label, {keep}
         list_concat(list_transform(cats, lambda z: cast(z = coalesce(o_orderpriority, '~null') as double)),
                     [coalesce(o_totalprice, m1), coalesce(c_acctbal, m2)]) as v
  from m join stats s on m.segment = s.segment)
select segment, o_orderkey, label, {"split, " if with_split else ""}
       {", ".join(f"round(v[{i + 1}], 6) as f{i}" for i in range(8))}
from vec"""


def auc_sql(source: str, group: str, label: str, score: str) -> str:
    return f"""
select {group}, (sum(case when y = 1 then r else 0 end) - sum(y) * (sum(y) + 1) / 2.0)
       / nullif(cast(sum(y) as double) * (count(*) - sum(y)), 0) as auc
from (select {group}, {label} as y,
             rank() over (partition by {group} order by {score})
             + (count(*) over (partition by {group}, {score}) - 1) / 2.0 as r
      from {source}) group by {group}"""


def prf(prefix: str = "") -> str:
    def part(share):
        return f"""({share(f"{prefix}tp", f"{prefix}fp", f"{prefix}fn")} * ({prefix}tp + {prefix}fn)
          + {share(f"{prefix}tn", f"{prefix}fn", f"{prefix}fp")} * ({prefix}tn + {prefix}fp)) / nullif({prefix}tp + {prefix}fp + {prefix}tn + {prefix}fn, 0)"""

    precision = part(lambda t, f, _: f"(case when {t} + {f} = 0 then 0 else cast({t} as double) / nullif({t} + {f}, 0) end)")
    recall = part(lambda t, _, n: f"(case when {t} + {n} = 0 then 0 else cast({t} as double) / nullif({t} + {n}, 0) end)")
    f1 = part(
        lambda t, f, n: f"(case when 2 * {t} + {f} + {n} = 0 then 0 else 2.0 * {t} / nullif(cast(2 * {t} + {f} + {n} as double), 0) end)"
    )
    return precision, recall, f1


def counts(label: str, predicted: str, prefix: str = "", where: str = "true") -> str:
    cells = {"tp": (1, 1), "fp": (0, 1), "tn": (0, 0), "fn": (1, 0)}
    return ", ".join(
        f"count(*) filter (where {label} = {y} and {predicted} = {p} and {where}) as {prefix}{n}"
        for n, (y, p) in cells.items()
    )


def metric_ctes(source: str, group: str, label: str, score: str) -> str:
    """CTEs ``scored`` .. ``metric`` over a source that has a split column."""
    p = f"(case when {score} > 0.5 then 1 when {score} is not null then 0 end)"
    sides = []
    for s in ("train", "test"):
        precision, recall, f1 = prf(f"{s}_")
        sides += [
            f"round({precision}, 3) as {s}_precision",
            f"round({recall}, 3) as {s}_recall",
            f"round({f1}, 3) as {s}_f1",
            f"round({s}_auc, 3) as {s}_auc",
        ]
    return f"""
cnt as (select {group}, {counts(label, p, "train_", "split = 'train'")}, {counts(label, p, "test_", "split = 'test'")}
        from {source} group by {group}),
aucs as ({auc_sql(f"(select *, concat_ws('|', {group}, split) as gs from {source})", "gs", label, score)}),
metric as (
  select c.{group}, {", ".join(sides)}, 1 - test_auc as loss
  from (select c.*, a.auc as train_auc, b.auc as test_auc from cnt c
        left join aucs a on a.gs = concat_ws('|', c.{group}, 'train')
        left join aucs b on b.gs = concat_ws('|', c.{group}, 'test')) c)"""


DOC_METRIC = f"""
with {DOC}, ds as (select *, {split_case("lang", "doc_id")} as split from doc),
{metric_ctes("ds", "lang", "quality", "letter_share")}"""

HOURLY = f"""{EVT}, hourly as (
  select event_type, cast((day(ts) - 1) * 24 + hour(ts) as int) as trial_id, round(avg(value), 6) as loss
  from evt group by all)"""

DIMS = {"max_depth": (3, 18, 1), "lambda": (1, 15, None), "subsample": (0.5, 1.0, None), "colsample_bytree": (0.5, 1.0, None)}


def snap(value: str, step) -> str:
    return value if step is None else f"floor({value} / cast({step} as double) + 0.5) * {step}"


def drawn(name: str, group: str) -> str:
    low, high, step = DIMS[name]
    u = h01("'50'", group, txt("trial_id"), repr(name))
    return snap(f"(cast({low} as double) + (cast({high} as double) - cast({low} as double)) * {u})", step)


DRAWS = f"""draws as (
  select *, {", ".join(f'{drawn(d, "event_type")} as "{d}"' for d in DIMS)} from hourly)"""
ROUNDED = ", ".join(f'round("{d}", 9) as "{d}"' for d in DIMS)
GROUPS_25 = "hourly as (select event_type, cast(t as int) as trial_id from (select distinct event_type from events), range(25) r(t))"

BEST_DRAW = "best as (select * from (select *, row_number() over (partition by event_type order by loss, trial_id) as rn from draws) where rn = 1)"

# Trees


def mixed(value: str, key: int, source: str, keep: str) -> str:
    """Nested selects that add ``mix`` to ``source``: the integer generator, step by step."""
    a = f"select {keep}, {value} as v0, ({value} + {key}) % {M} as v from {source}"
    b = f"select {keep}, v0, (v * v + {key}) % {M} as v from ({a})"
    c = f"select {keep}, v0, (v * v + v0) % {M} as v from ({b})"
    return f"select {keep}, (v * 48271) % {M} as mix from ({c})"


FEATURES = ("n_chars", "n_words", "unique_ratio", "letter_share", "digit_share")


def binned_ctes(max_bins: int) -> str:
    probs = ", ".join(f"cast({i} as double) / {max_bins}" for i in range(1, max_bins))
    longs = " union all ".join(
        f"select d.lang, d.doc_id, d.split, {i} as f, coalesce(d.{c}, s.m{i}, 0) as v from ds d join med s on d.lang = s.lang"
        for i, c in enumerate(FEATURES)
    )
    return f"""{DOC}, ds as (select *, {split_case("lang", "doc_id")} as split from doc),
med as (select lang, {", ".join(f"median({c}) as m{i}" for i, c in enumerate(FEATURES))} from ds where split = 'train' group by lang),
longs as materialized ({longs}),
cuts as materialized (
  select lang, f, case when count(distinct v) <= {max_bins}
                       then list_sort(list_distinct(list(v)))[:-2]
                       else list_sort(list_distinct(quantile_cont(v, [{probs}]))) end as cuts
  from longs where split = 'train' group by lang, f),
bins as materialized (
  select l.lang, l.doc_id, l.f, len(list_filter(c.cuts, lambda z: z < l.v)) as b
  from longs l join cuts c on l.lang = c.lang and l.f = c.f)"""


SCALED = "cast(1048576 as double)"
GAIN = "0.5 * ((gl * gl / (hl + 1.0) + (gt - gl) * (gt - gl) / ((ht - hl) + 1.0)) - gt * gt / (ht + 1.0))"


def best_cte(name: str, rows: str, keys: str, allowed: str = "") -> str:
    """CTEs for the best split per key from rows with g and h."""
    return f"""
{name}_h as (select {keys}, b.f, b.b, sum(r.g) as g, sum(r.h) as h
  from {rows} r join bins b on r.lang = b.lang and r.doc_id = b.doc_id group by {keys}, b.f, b.b),
{name}_c as (select *, {GAIN} as gain from (
  select {keys.replace("r.", "")}, f, b,
    cast(sum(g) over w as double) / {SCALED} as gl, cast(sum(h) over w as double) / {SCALED} as hl,
    cast(sum(g) over t as double) / {SCALED} as gt, cast(sum(h) over t as double) / {SCALED} as ht
  from {name}_h window w as (partition by {keys.replace("r.", "")}, f order by b rows unbounded preceding),
                       t as (partition by {keys.replace("r.", "")}, f))),
{name} as materialized (
  select n.*, b.f, b.b, b.gain, b.gl, b.hl from
    (select {keys.replace("r.", "")}, max(gt) as gt, max(ht) as ht from {name}_c group by all) n
  left join (select * from (
    select *, row_number() over (partition by {keys.replace("r.", "")} order by gain desc, f, b) as rn from {name}_c
    where hl >= 1 and ht - hl >= 1 and gain > 1e-6 {allowed}) where rn = 1) b
  using ({keys.replace("r.", "")}))"""


GRADS = "floor((1 / (1 + exp(-margin)) - label) * 1048576 + cast(0.5 as double))"
HESS = "floor((1 / (1 + exp(-margin))) * (1 - 1 / (1 + exp(-margin))) * 1048576 + cast(0.5 as double))"


def boosted_trees(rounds=3, depth=2, max_bins=16, subsample=0.8, colsample=0.6, seed=5) -> str:
    n = len(FEATURES)
    keep = max(1, int(colsample * n))
    row_hash = f"cast(('0x' || substr(md5('17:row:' || {txt('doc_id')}), 1, 7)) as bigint)"
    parts = [
        binned_ctes(max_bins),
        """ok as (select lang from ds where split = 'train' group by lang
  having count(distinct quality) = 2)""",
        f"""s0 as materialized (select lang, doc_id, quality as label, split = 'test' as is_test,
  {row_hash} as rh, cast(0 as double) as margin from ds where lang in (select lang from ok))""",
    ]
    nodes, aucs = [], []
    for t in range(rounds):
        key = (seed * 40014 + t * 40692 + 1) % M
        parts.append(
            f"a{t} as (select f from ({mixed('cast(f * 69621 + 1 as bigint)', key, f'(select cast(unnest(range({n})) as bigint) as f)', 'f')}) order by mix, f limit {keep})"
        )
        parts.append(
            f"""q{t} as materialized (select *, cast({GRADS} as bigint) as g, cast({HESS} as bigint) as h,
  not is_test and cast(mix as double) / cast({M} as double) < cast({subsample} as double) as used, cast(1 as bigint) as node
  from ({mixed('rh', key, f's{t}', 'lang, doc_id, label, is_test, rh, margin')}))"""
        )
        here = f"q{t}"
        for d in range(depth):
            name = f"b{t}_{d}"
            parts.append(
                best_cte(
                    name,
                    f"(select * from {here} where used and node >= {1 << d})",
                    "r.lang, r.node",
                    f"and f in (select f from a{t})",
                )
            )
            parts.append(
                f"""q{t}_{d} as materialized (select r.* replace (
    case when s.f is null then r.node else 2 * r.node + cast(b.b > s.b as int) end as node)
  from {here} r left join {name} s on r.lang = s.lang and r.node = s.node
  left join bins b on b.lang = r.lang and b.doc_id = r.doc_id and b.f = s.f)"""
            )
            here = f"q{t}_{d}"
        grown = [f"select lang, cast(1 as bigint) as node, gt as g, ht as h from b{t}_0"]
        for d in range(depth):
            grown.append(f"select lang, 2 * node, gl, hl from b{t}_{d} where f is not null")
            grown.append(f"select lang, 2 * node + 1, gt - gl, ht - hl from b{t}_{d} where f is not null")
        rules = " union all ".join(f"select lang, node, f, b from b{t}_{d} where f is not null" for d in range(depth))
        parts.append(
            f"""n{t} as materialized (select {t} as round, x.lang, x.node, -(x.g / (x.h + 1.0)) * cast(0.3 as double) as value, r.f, r.b
  from ({" union all ".join(grown)}) x left join ({rules}) r on x.lang = r.lang and x.node = r.node)"""
        )
        parts.append(
            f"""s{t + 1} as materialized (select r.lang, r.doc_id, r.label, r.is_test, r.rh, r.margin + coalesce(n.value, 0) as margin
  from {here} r left join n{t} n on r.lang = n.lang and r.node = n.node)"""
        )
        parts.append(
            f"auc{t} as (select {t} as round, * from ({auc_sql(f'(select * from s{t + 1} where is_test)', 'lang', 'label', 'margin')}))"
        )
        nodes.append(f"select * from n{t}")
        aucs.append(f"select * from auc{t}")
    parts.append(
        f"""best as (select lang, coalesce(arg_max(round, (auc, -round)) filter (where auc is not null), {rounds - 1}) as best_iteration
  from ({" union all ".join(aucs)}) group by lang)"""
    )
    parts.append(
        f"""kept as (select n.*, coalesce(b.best_iteration, {rounds - 1}) as best_iteration,
    row_number() over (partition by n.lang order by n.round, n.node) - 1 as position
  from ({" union all ".join(nodes)}) n left join best b on n.lang = b.lang
  where n.round <= coalesce(b.best_iteration, {rounds - 1}))"""
    )
    return f"""
with {", ".join(parts)}
select k.lang, cast(k.best_iteration as int) as best_iteration, {rounds} as n_rounds, cast(k.position as int) as position,
  coalesce(k.f, -1) as node_feature, round(coalesce(c.cuts[k.b + 1], 0), 6) as node_threshold,
  cast(coalesce(l.position, -1) as int) as node_left, cast(coalesce(l.position + 1, -1) as int) as node_right,
  round(k.value, 8) as node_value
from kept k left join kept l on k.lang = l.lang and k.round = l.round and l.node = 2 * k.node
left join cuts c on c.lang = k.lang and c.f = k.f"""


SPLIT_GAIN = f"""
with {binned_ctes(16)},
rows0 as (select *, cast({GRADS} as bigint) as g, cast({HESS} as bigint) as h
  from (select lang, doc_id, quality as label, cast(0 as double) as margin from ds where split = 'train')),
{best_cte("s", "rows0", "r.lang")}
select lang, cast(f as int) as feature, cast(b as int) as bin, round(gain, 9) as gain, round(gl, 9) as gl,
  round(hl, 9) as hl, round(gt, 9) as gt, round(ht, 9) as ht from s"""

# Tuning


def fold(first: str, step: str, done: str, columns: str) -> str:
    """A left fold over each group's ordered history as a recursive CTE."""
    return f"""
with recursive {HOURLY},
o as (select *, row_number() over (partition by event_type order by trial_id) as i from hourly),
f as (
  select event_type, i, trial_id, {first} from o where i = 1
  union all
  select o.event_type, o.i, o.trial_id, {step} from f join o on o.event_type = f.event_type and o.i = f.i + 1
  where not ({done}))
select event_type, {columns} from (select *, row_number() over (partition by event_type order by i desc) as z from f) where z = 1"""


SEARCH_STOP = fold(
    "loss as best, 1 as stale",
    """case when loss < best - abs(best * cast(0.005 as double)) then loss else best end,
       case when loss < best - abs(best * cast(0.005 as double)) then 0 else stale + 1 end""",
    "f.stale >= 25",
    "best as best_loss, stale, cast(case when stale >= 25 then trial_id end as bigint) as stopped_at",
)
EARLY_STOP = fold(
    "loss as best, trial_id as top",
    "case when loss > best then loss else best end, case when loss > best then o.trial_id else top end",
    "f.trial_id - f.top >= 25",
    "cast(top as bigint) as best_round, best as best_score, cast(trial_id as bigint) as last_round",
)


def guided_search(first=1000, count=5, candidates=24) -> str:
    limits = ", ".join(f"('{d}', cast({lo} as double), cast({hi} as double), cast({step or 0} as double))" for d, (lo, hi, step) in DIMS.items())
    unpivot = " union all ".join(f"select event_type, '{d}' as dim, good, \"{d}\" as m from ranked" for d in DIMS)

    def u(tag):
        return h01("'50'", "event_type", txt("trial_id"), "dim", txt("i"), f"'{tag}'")

    return f"""
with {HOURLY}, {DRAWS}, lim(dim, low, high, step) as (values {limits}),
ranked as (select *, row_number() over (partition by event_type order by loss, trial_id)
    <= least(25, ceil(0.25 * sqrt(count(*) over (partition by event_type)))) as good from draws),
obs as (select * from ({unpivot}) join lim using (dim)),
comp as materialized (
  select event_type, dim, good, m, least(greatest(m - coalesce(lag(m) over w, low), coalesce(lead(m) over w, high) - m,
      (high - low) / least(100.0, count(*) over (partition by event_type, dim, good) + 1.0)), high - low) as s,
    row_number() over w as k
  from obs window w as (partition by event_type, dim, good order by m)
  union all
  select event_type, dim, good, (low + high) / 2, high - low, count(*) + 1 from obs group by event_type, dim, good, low, high),
size as (select event_type, dim, good, count(*) as n from comp group by all),
cand as (
  select *, {u("pick")} as u1, {u("radius")} as u2, {u("angle")} as u3
  from (select distinct event_type from draws), lim, (select cast(unnest(range({first}, {first + count})) as int) as trial_id), (select unnest(range({candidates})) as i)),
x as materialized (
  select c.*, least(greatest(p.m + p.s * sqrt(-2 * ln(1 - u2)) * cos(2 * pi() * u3), low), high) as x
  from cand c join size z on z.event_type = c.event_type and z.dim = c.dim and z.good
  join comp p on p.event_type = c.event_type and p.dim = c.dim and p.good and p.k = floor(c.u1 * z.n) + 1),
dens as (
  select x.event_type, x.dim, x.trial_id, x.i, any_value(x.x) as x, any_value(x.step) as step,
    ln(sum(exp(-0.5 * ((x.x - p.m) / p.s) * ((x.x - p.m) / p.s)) / p.s) filter (where p.good) / count(*) filter (where p.good))
    - ln(sum(exp(-0.5 * ((x.x - p.m) / p.s) * ((x.x - p.m) / p.s)) / p.s) filter (where not p.good) / count(*) filter (where not p.good)) as ratio
  from x join comp p on p.event_type = x.event_type and p.dim = x.dim group by x.event_type, x.dim, x.trial_id, x.i),
top as (select *, row_number() over (partition by event_type, dim, trial_id order by ratio desc, i) as z from dens)
select event_type, trial_id, {", ".join(
    f'''round(max(case when dim = '{d}' then case when step > 0 then floor(x / step + 0.5) * step else x end end), 6) as "{d}"''' for d in DIMS
)} from top where z = 1 group by event_type, trial_id"""


# Registry

VERSIONS = """
last as (select event_type as name, max(day(ts)) as v from events group by 1),
req as (select min(event_id) as seq, event_type as name, 'run-' || cast(user_id as varchar) as run_id
        from events group by event_type, user_id),
ver as (select seq, r.name, cast(l.v + row_number() over (partition by r.name order by seq) as int) as version, run_id,
               'runs/' || run_id || '/models' as source
        from req r join last l on r.name = l.name)"""
STAGES = f"""{VERSIONS},
moves as (select e.event_id as moved, v.name, v.version from events e
  join ver v on v.name = e.event_type and v.run_id = 'run-' || cast(e.user_id as varchar) where e.event_id > v.seq),
wish as (select name, version, max(moved) as moved, max(max(moved)) over (partition by name) as latest from moves group by name, version),
cur as (select v.name, v.version, v.run_id, v.source,
  case when w.moved is null then 'None' when w.moved < w.latest then 'Archived' else 'Production' end as stage
  from ver v left join wish w on v.name = w.name and v.version = w.version)"""

# Scoring

STUMPS = """stump as (
  select segment, round(avg(o_totalprice), 2) as price, round(avg(c_acctbal), 2) as balance, round(avg(label), 3) as rate
  from ord where segment <> 'MACHINERY' group by segment)"""


def stump_probability(price: str, balance: str) -> str:
    first = f"case when {price} <= price then -rate else rate end"
    second = (
        f"case when {balance} <= balance then 0.25 when {price} <= price * 2 then -0.5 else rate + 0.5 end"
    )
    return f"case when rate is not null then 1 / (1 + exp(-cast(({first}) + ({second}) as double))) end"


SCORED = f"""{ORD}, {STUMPS}, scored as (
  select o.segment, o.o_orderkey, {stump_probability("o_totalprice", "c_acctbal")} as p
  from ord o left join stump s on o.segment = s.segment)"""
RAW_SCORED = f"""{ORD_MASKED}, {STUMPS}, med as (
  select segment, median(o_totalprice) as m1, median(c_acctbal) as m2 from masked group by segment),
scored as (
  select o.segment, o.o_orderkey, o.label, o.o_totalprice, o.c_acctbal,
    {stump_probability("coalesce(o_totalprice, m1)", "coalesce(c_acctbal, m2)")} as p
  from masked o join med m on o.segment = m.segment left join stump s on o.segment = s.segment)"""


def _synthetic_profile() -> str:
    g, i = "segment", txt("o_orderkey")

    def u(tag):
        return h01("'11'", f"'{tag}'", g, i)

    def value(k):
        normal = f"sqrt(-2 * ln(1 - {u(f'r{k}')})) * cos(2 * pi() * {u(f'a{k}')})"
        if k > 10:
            return normal
        centre = h01("'11'", f"'centre{k}'", g, txt("cls"))
        return f"{normal} + (2 * {centre} - 1)"

    def masked(name, expr):
        return f"case when {h01(repr('11'), repr(name), i)} >= 0.05 then {expr} end"

    return f"""
with {ORD}, c as (select segment, o_orderkey, case when {u("class")} < 0.5 then 0 else 1 end as cls from ord),
l as (select *, case when {u("flip")} < 0.4 then (case when {u("redraw")} < 0.5 then 0 else 1 end) else cls end as lab,
       {value(1)} as x1, {value(2)} as x2, {value(20)} as x20 from c),
q as (select segment, quantile_cont(x1, 0.25) as a, quantile_cont(x1, 0.5) as b, quantile_cont(x1, 0.75) as d from l group by 1),
t as (select l.*, {masked("categorical_feature_01", "case when x1 <= a then 0 when x1 <= b then 1 when x1 <= d then 2 else 3 end")} as cat,
       {masked("numeric_feature_02", "x2")} as n2, {masked("numeric_feature_20", "x20")} as n20
      from l join q using (segment))
select segment as group_name, count(*) as n_rows, cast(sum(lab) as bigint) as n_positive, count(*) filter (where lab <> cls) as n_flipped,
  count(*) filter (where n2 is null) as n_missing_02, count(*) filter (where cat is null) as n_missing_cat,
  count(*) filter (where cat = 3) as n_top_quartile, round(avg(n2), 6) as mean_02, round(avg(n20), 6) as mean_20
from t group by segment"""


def _prf_select() -> str:
    precision, recall, f1 = prf()
    return f"""
with {DOC}, c as (select lang, {counts("quality", "cast(letter_share > 0.93 as int)")} from doc group by lang)
select lang, round({precision}, 9) as precision, round({recall}, 9) as recall, round({f1}, 9) as f1 from c"""


METRIC_NAMES = [f"{s}_{m}" for s in ("train", "test") for m in ("precision", "recall", "f1", "auc")]

def quartile_sql(events: str) -> str:
    return f"""with {events}, q as (
  select event_type, quantile_cont(value, 0.25) as a, quantile_cont(value, 0.5) as b, quantile_cont(value, 0.75) as c
  from evt group by event_type)
select event_id, event_type, case when value <= a then 0 when value <= b then 1 when value <= c then 2 when value is not null then 3 end as quartile
from evt join q using (event_type)"""


def impute_sql(events: str, name: str) -> str:
    return f"""with {events}, m as (select *, {split_case("event_type", "event_id")} as split from {name}),
d as (select event_type, median(value) as md from m where split = 'train' group by event_type)
select event_id, event_type, split, round(coalesce(value, md), 6) as value from m join d using (event_type)"""


ORACLES = {
    "group_list": """select event_type, printf('group_%02d', row_number() over (order by event_type)) as group_name
from (select distinct event_type from events)""",
    "feature_projection": f"with {ORD} select segment, label, o_orderpriority, o_totalprice, c_acctbal from ord",
    "group_filter": f"with {ORD} select o_orderkey, o_totalprice from ord where segment = 'BUILDING'",
    "synth_features_profile": _synthetic_profile(),
    "quartile_bins": quartile_sql(EVT),
    "quartile_bins_nan": quartile_sql(EVT_NAN),
    "missing_mask": f"with {EVT_MASKED} select event_id, event_type, value from masked",
    "median_impute": impute_sql(EVT_MASKED, "masked"),
    "median_impute_nan": impute_sql(EVT_NAN, "evt"),
    "train_test_split": f"with {ORD} select o_orderkey, segment, {split_case('segment', 'o_orderkey')} as split from ord",
    "split_counts": f"""with {ORD}, m as (select segment, {split_case("segment", "o_orderkey")} as split from ord)
select segment, split, count(*) as n_rows from m group by segment, split""",
    "onehot_train_categories": f"""with {ORD_MASKED}, m as (select *, {split_case("segment", "o_orderkey")} as split from masked)
select segment, array_to_string(list_sort(list(distinct coalesce(o_orderpriority, '~null'))), '|') as categories
from m where split = 'train' group by segment""",
    "encoded_matrix": encoded(True),
    "encoded_matrix_all_rows": encoded(False),
    "group_auc": f"with {DOC} select lang, round(auc, 9) as auc from ({auc_sql('doc', 'lang', 'quality', 'letter_share')})",
    "group_auc_orders": f"with {ORD} select segment, round(auc, 9) as auc from ({auc_sql('ord', 'segment', 'label', 'o_totalprice')})",
    "group_weighted_prf": _prf_select(),
    "metric_row": f"{DOC_METRIC} select * replace (round(loss, 9) as loss) from metric",
    "trial_loss": f"with {ORD} select segment, round(1 - auc, 9) as loss from ({auc_sql('ord', 'segment', 'label', 'c_acctbal')})",
    "split_gain": SPLIT_GAIN,
    "boosted_trees_grouped": boosted_trees(),
    "boosted_trees_levelwise": boosted_trees(),
    "early_stop_round": EARLY_STOP,
    "search_stop": SEARCH_STOP,
    "trial_draws": f"with {GROUPS_25}, {DRAWS} select event_type, trial_id, {ROUNDED} from draws",
    "trial_draws_shared": f"""with {GROUPS_25} select event_type, trial_id, {", ".join(
        f'round({drawn(d, repr("shared"))}, 9) as "{d}"' for d in DIMS)} from hourly""",
    "trial_types": f"""with {HOURLY}, {DRAWS} select event_type, trial_id, cast(max_depth as int) as max_depth, 1000 as n_estimators,
  round("lambda", 9) as "lambda", round(subsample, 9) as subsample, round(colsample_bytree, 9) as colsample_bytree from draws""",
    "best_trial": """select event_type, event_id as trial_id, value as loss from (
  select *, row_number() over (partition by event_type order by value, event_id) as rn from events) where rn = 1""",
    "best_params_long": f"""with {HOURLY}, {DRAWS}, {BEST_DRAW}
{" union all ".join(f"select event_type, '{d}' as parameter, round({chr(34)}{d}{chr(34)}, 9) as value from best" for d in DIMS)}
union all select event_type, 'n_estimators', cast(1000 as double) from best
union all select event_type, 'random_state', cast(1 as double) from best""",
    "metrics_long": f"""{DOC_METRIC} {" union all ".join(
        f"select lang, '{m}' as metric, {m} as value from metric" for m in METRIC_NAMES)}
union all select lang, 'best_iteration', cast(0 as double) from metric""",
    "model_stats_row": f"""
with {HOURLY}, {DRAWS}, {BEST_DRAW},
es as (select *, cast(value > 20 as int) as label, value / 50.0 as score, {split_case("event_type", "event_id")} as split from evt),
{metric_ctes("es", "event_type", "label", "score")}
select b.event_type, md5('run') as run_id, b.trial_id, {", ".join(METRIC_NAMES)}, {ROUNDED}
from best b join metric m on b.event_type = m.event_type""",
    "guided_search": guided_search(),
    "experiment_upsert": "select distinct source as experiment from documents",
    "run_open": """select distinct md5(source || ':one-model-a-group:0') as run_id, source as experiment,
  'one-model-a-group' as run_name from documents""",
    "register_name": """select distinct lang || '/' || source as name from documents
where lang || '/' || source not in (
  select lang || '/' || source from documents join labels using (doc_id) where toxic = 1)""",
    "new_version": f"with {VERSIONS} select seq, name, version, run_id, source from ver",
    "promote_archive": f"with {STAGES} select name, version, run_id, source, stage from cur",
    "resolve_stage": f"""with {STAGES} select name, version, run_id, source from (
  select *, row_number() over (partition by name order by version desc) as rn from cur where stage = 'Production') where rn = 1""",
    "scaled_column": f"with {ORD} select o_orderkey, o_totalprice, o_totalprice * 2 as o_totalprice_scaled from ord",
    "score_fixed_models": f"with {SCORED} select segment, o_orderkey, round(p, 9) as probability from scored",
    "score_proba_array": f"with {SCORED} select segment, o_orderkey, round(1 - p, 9) as p0, round(p, 9) as p1 from scored",
    "hard_class": f"with {SCORED} select o_orderkey, case when p > 0.5 then 1 when p is not null then 0 end as predicted from scored",
    "score_raw_rows": f"with {RAW_SCORED} select segment, o_orderkey, label, round(p, 9) as probability from scored",
    "score_missing_model": f"with {RAW_SCORED} select segment, count(*) as rows_without_model from scored where p is null group by segment",
    "scored_row_projection": f"""with {RAW_SCORED} select round(p, 9) as label_probability, segment, o_orderkey, label, o_totalprice, c_acctbal
from scored""",
}
