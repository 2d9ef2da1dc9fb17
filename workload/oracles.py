"""The same results in plain SQL over the same tables, with columns of the same names."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Dataset number -> event type; interpolated columns as (name, expression) of their dataset.
TYPES = ["purchase", "click", "view", "signup", "error"]
PREFIXES = ["Energy", "Task_0", "Task_1", "Task_2", "Task_3"]
COLUMNS = [
    ("Energy__NodePower", 0, "v"),
    ("Energy__EpochTime", 0, "ep"),
    ("Task_0__CPUUtilization", 1, "v"),
    ("Task_1__RSS", 2, "v*1024"),
    ("Task_2__ReadMB", 3, "v"),
    ("Task_3__CurrPower", 4, "v"),
    ("Task_3__EpochTime", 4, "ep"),
]
JOB = "f as file_label, g as group_name"
AT = f"{JOB}, t as \"ElapsedTime\""
ZERO = "(uid % 5 = 0 and g = 'g0')"
NO_ENERGY = "not (uid % 4 = 0 and et = 'purchase')"

EVENTS = """ev as (
  select 'u'||user_id||'_run' f, case when day(ts)<=15 then 'g0' else 'g1' end g,
         epoch_us(ts)//1000000 ep, event_id id, user_id uid, event_type et, value v
  from events),
e as (select *, ep - min(ep) over (partition by f, g) t from ev)"""


def aligned(keep: str = "true", energy: str | None = None) -> str:
    """CTEs up to `al`: one row per time and combination of rows, columns c0.. and row numbers i0.."""
    joins, picks, has = [], [], []
    for n, et in enumerate(TYPES):
        joins.append(f"left join k d{n} on d{n}.f=tl.f and d{n}.g=tl.g and d{n}.t=tl.t and d{n}.et='{et}'")
        picks.append(f"d{n}.id i{n}")
        has.append(f"bool_or(et='{et}') h{n}")
    for c, (_, n, x) in enumerate(COLUMNS):
        x = energy if energy and c == 0 else x
        for name in ("ep", "t", "v"):
            x = x.replace(name, f"d{n}.{name}") if x == name or name in x.replace("ep", "ep") else x
        picks.append(f"({x})::double c{c}")
    ties = ", ".join(f"i{n} nulls first" for n in range(len(TYPES)))
    return f"""with {EVENTS},
k as (select * from e where {keep}),
hs as (select f, g, {', '.join(has)} from k group by f, g),
tl as (select distinct f, g, t from k),
al as (select *, row_number() over (partition by f, g order by t nulls first, {ties}) rn
  from (select tl.f, tl.g, tl.t, {', '.join(picks)} from tl {' '.join(joins)}))"""


def filled(keep: str = "true", energy: str | None = None) -> str:
    """CTEs up to `it`: columns interpolated by row position, dataset flags h0.."""
    near, fill = [], []
    for c in range(len(COLUMNS)):
        near += [
            f"last_value(c{c} ignore nulls) over a pv{c}",
            f"last_value(case when c{c} is not null then rn end ignore nulls) over a pr{c}",
            f"first_value(c{c} ignore nulls) over z nv{c}",
            f"first_value(case when c{c} is not null then rn end ignore nulls) over z nr{c}",
        ]
        fill.append(
            f"coalesce(c{c}, case when pr{c} is not null and nr{c} is not null "
            f"then pv{c}+(rn-pr{c})*((nv{c}-pv{c})/(nr{c}-pr{c})) end) c{c}"
        )
    flags = ", ".join(f"h{n}" for n in range(len(TYPES)))
    return f"""{aligned(keep, energy)},
nb as (select *, {', '.join(near)} from al
  window a as (partition by f, g order by rn rows between unbounded preceding and current row),
         z as (partition by f, g order by rn rows between current row and unbounded following)),
it as (select f, g, t, rn, {flags}, {', '.join(fill)} from nb join hs using (f, g))"""


def fixed(x: str) -> str:
    """The sum of a column in whole numbers of 2^-64."""
    return f"sum(({x} * 18446744073709551616.0::double)::hugeint)"


def broken(s: str) -> str:
    """What such a sum stands for: its whole part and the rest, each as a double, added."""
    one, half = "18446744073709551616::hugeint", "4294967296"
    below = f"((({s}) % {one} + {one}) % {one})"
    small = f"({below} // {half})::double / {half}.0::double + ({below} % {half})::double / {half}.0::double / {half}.0::double"
    return f"((({s}) - {below}) // {one})::double + ({small})"


def profile(keep: str = "true") -> str:
    """CTEs up to `pr`: epoch, power and energy columns on the power branch.

    Sums are exact, as those they are held against are: of whole numbers of 2^-64.
    """
    return f"""{filled(keep)},
st as (select *, case when h0 then c0 when h4 then c5 end w, h0 or h4 has_power,
  cast(trunc(case when h0 then c1 when h4 then c6 end) as bigint) epoch,
  t - lag(t) over (partition by f, g order by rn) step from it),
dd as (select *, case when has_power then coalesce(step, 0) end dt,
  case when has_power then coalesce(step, 0)*w end inc from st),
ss as (select *, {fixed("inc")} over (partition by f, g order by rn rows unbounded preceding) s from dd),
pr as (select * exclude (s), case when inc is not null then {broken("s")} end used from ss)"""


def nearest(rows: str, prices: str, x: str, by: str = "") -> str:
    """CTEs up to `na`: `rows` with time e and price p of the nearest row of `prices`, later on a tie."""
    same = f"l.{by}=b.{by} and " if by else ""
    same2 = f"k1.{by}=b.{by} and " if by else ""
    return f"""k1 as (select l.*, b.e be, b.p bp from {rows} l asof left join {prices} b on {same}l.{x}>=b.e),
k2 as (select k1.*, b.e fe, b.p fp from k1 asof left join {prices} b on {same2}k1.{x}<=b.e),
na as (select *, case when be is null or (fe is not null and fe-{x}<={x}-be) then fe else be end pe,
  case when be is null or (fe is not null and fe-{x}<={x}-be) then fp else bp end pp from k2)"""


EVENT_PRICES = "ps as (select ep//900*900 e, qz(avg(v),4) p from ev group by 1)"


def cols(names: list[tuple[str, int]], digits: int) -> str:
    return ", ".join(
        f'qz(c{c},{3 if name.endswith("EpochTime") else digits}) "{name}"' for name, c in names
    )


ALL = [(name, c) for c, (name, _, _) in enumerate(COLUMNS)]

ORACLES["job_id_of_file"] = f"""with {EVENTS}
select distinct f as file_label, split_part(f,'_',1) job_id from e"""

ORACLES["elapsed_validation"] = f"""with {EVENTS}
select f as file_label, count(*) filter (v-20>=0) valid_rows, count(*) filter (v-20<0) bad_rows,
  count(*) filter (v-20<0)>0 quarantined from e group by f"""

ORACLES["quarantine"] = f"""with {EVENTS}
select distinct f as file_label, 'invalid_elapsed' reason from e where id % 997 = 0"""

ORACLES["fractional_time"] = f"""with {EVENTS}
select {JOB}, id event_id, case when v-5>=0 then cast(trunc(v-5) as bigint) end "ElapsedTime" from e"""

_prefix = "case et " + " ".join(f"when '{e}' then '{p}'" for e, p in zip(TYPES, PREFIXES)) + " end"
ORACLES["row_index_time"] = f"""with {EVENTS}
select {JOB}, {_prefix} prefix, id event_id,
  row_number() over (partition by f, g, et order by t, id) - 1 "ElapsedTime" from e"""

ORACLES["row_number_as_time"] = f"""with {EVENTS}
select {JOB}, {_prefix} prefix, id event_id, row_number() over (partition by f, g, et order by id) - 1 "ElapsedTime" from e"""

ORACLES["drop_zero_power"] = f"""with {EVENTS}
select {JOB}, {_prefix} prefix, count(*) n from e where not ({ZERO} and et='purchase') group by f, g, et"""

_catalog = f"""ca as (select f, g, uid, unnest({TYPES!r}) et from (select distinct f, g, uid from e))"""
_counts = """n as (select f, g, et, count(*) n from e group by f, g, et),
dg as (select ca.*, coalesce(n,0) n, et='signup' and uid%3=0 er from ca left join n using (f, g, et))"""
ORACLES["frame_diagnostics_per_job"] = f"""with {EVENTS}, {_catalog}, {_counts}
select {JOB}, count(*) filter (not er and n=0) empty,
  count(*) filter (not er and n>0 and et='purchase' and {ZERO}) zero_power,
  count(*) filter (er) errors, count(*) total from dg group by f, g"""

ORACLES["files_without_usable_data"] = f"""with {EVENTS}
select f as file_label, 0 empty, count(distinct g) zero_power, 0 errors, count(distinct g) total
from e where uid%5=0 group by f"""

ORACLES["first_usable_group_of_file"] = f"""with {EVENTS}
select f as file_label, min(g) group_name from e where not {ZERO} group by f"""

ORACLES["timeline"] = f"with {EVENTS} select distinct {AT} from e"

ORACLES["align_frames"] = f"{aligned()} select {AT}, {cols(ALL, 6)} from al"
ORACLES["interpolate_rows"] = f"{filled()} select {AT}, {cols(ALL, 6)} from it"
ORACLES["epoch_resolve"] = f"""{profile(NO_ENERGY)} select {AT}, epoch "EpochTime" from pr"""
ORACLES["task_derivatives"] = f"""{filled()}
select {AT}, qz(c3/1024.0,6) "Task_1__RSS_MB", qz(c2/32.0,6) "Task_0__CPUUtilization_normalized" from it"""
ORACLES["power_resolve"] = f"""{profile(NO_ENERGY)} select {AT}, qz(w,6) "NodePower" from pr"""
ORACLES["elapsed_difference"] = f"""{profile()} select {AT}, dt "ElapsedTime_Diff" from pr"""
ORACLES["energy_from_power"] = f"""{profile()}
select {AT}, dt::double "ElapsedTime_Diff", qz(w,4) "NodePower", qz(inc,4) "Energy_Increment_J",
  qz(qz(used,4),2) "Energy_used_J" from pr"""
NO_POWER = "not (uid % 2 = 0 and et = 'error')"
ORACLES["power_from_energy"] = f"""{filled(NO_POWER, "t*2.0+v")},
m as (select *, t - lag(t) over w step, coalesce(c0 - lag(c0) over w, 0) gain from it
  window w as (partition by f, g order by rn)),
n as (select *, case when h4 then coalesce(step, 0)*c5 end inc from m),
s as (select *, {fixed("inc")} over (partition by f, g order by rn rows unbounded preceding) s from n),
o as (select * exclude (s), {broken("s")} total from s)
select {AT}, case when h4 then qz(c5,4) when h0 and step>0 then qz(gain/step,4) end "NodePower",
  case when h4 then qz(inc,4) when h0 then qz(gain,4) end "Energy_Increment_J",
  case when h4 then case when inc is not null then qz(total,4) end when h0 then qz(c0,4) end "Energy_used_J" from o"""

APPLIANCES = """ap(pos, name, watts) as (values (0,'a hair dryer',1800.0::double),(1,'a microwave oven',1200),
  (2,'an electric kettle',1500),(3,'a vacuum cleaner',800),(4,'a refrigerator',150),(5,'a light bulb',60),
  (6,'a washing machine',500),(7,'a gaming PC',400),(8,'a laptop',60),(9,'a dishwasher',1000))"""


def appliance(rows: str, joules: str, key: str) -> str:
    """CTEs up to `aq`: `rows` (with a unique `key`) plus name, amount, unit and sentence."""
    return f"""{APPLIANCES},
ax as (select r.{key} kk, pos, name, {joules}/watts secs, abs({joules}/watts/60.0-10.0) d,
  {joules}/watts/60.0 between 1 and 120 ok from {rows} r, ap where {joules}>0 and not isnan({joules})),
ab as (select kk, arg_min({{'n': name, 's': secs}}, {{'o': case when ok then 0 else 1 end, 'd': d, 'p': pos}}) b
  from ax group by kk),
ac as (select kk, b.n an, b.s s, case when b.s<60 then 's' when b.s<3600 then 'm' else 'h' end au,
  case when b.s<60 then printf('%.1f',b.s)::double when b.s<3600 then printf('%.1f',b.s/60.0)::double
       else printf('%.2f',b.s/3600.0)::double end aa from ab),
aq as (select r.*, coalesce(an,'negligible usage') an, coalesce(aa,0.0::double) aa, coalesce(au,'s') au,
  case when an is null then 'Energy use too small to compare with everyday appliances.'
       else 'That''s about the same energy as using '||an||' for '||aa::varchar||' '
         ||case au when 's' then 'seconds' when 'm' then 'minutes' else 'hours' end||'.' end sentence
  from {rows} r left join ac on kk=r.{key})"""




def metrics(keep: str = "true") -> str:
    """CTEs up to `mx`: the figures of every job with power."""
    return f"""{profile(keep)},
p6 as (select f, g, t, w, used from pr where has_power),
mt as (select f, g, f||g kf, max(used) ets, max(t)::double tts,
  arg_max({{'w': w, 't': t}}, {{'w': w, 't': -t}}) filter (w is not null) pk from p6 group by f, g),
{appliance('mt', 'ets', 'kf')},
mx as (select *, case when tts<>0 then ets/tts else 'nan'::double end av,
  coalesce(pk.w,'nan'::double) pw, case when pk is null then 'nan'::double else pk.t::double end pt,
  case when tts<>0 then ets*tts else 'nan'::double end edp from aq)"""


ORACLES["job_metrics_of_events"] = f"""{metrics()}
select {JOB}, qz(ets,4) energy_to_solution_j, qz(tts,4) time_to_solution_s, qz(av,4) average_power_w,
  qz(pw,4) peak_power_w, qz(pt,4) peak_power_time_s, cast(qz(edp,-4) as decimal(38,0))::double energy_delay_product,
  an appliance_name, qz(aa,4) appliance_amount, au appliance_unit, sentence appliance_description from mx"""


def _two(x: str) -> str:
    return f"case when isnan({x}) then 'nan' else printf('%.2f',{x}) end"


_SUMMARY = f"""sm as (
  select f, g, 1 ord, 'Energy-to-solution' m, {_two('ets')} v, 'J' u,
    'Total energy consumed by the job from start to finish.' d from mx
  union all select f, g, 2, 'Time-to-solution', {_two('tts')}, 's', 'Elapsed time for the job.' from mx
  union all select f, g, 3, 'Average power', {_two('av')}, 'W', 'Mean power draw.' from mx
  union all select f, g, 4, 'Peak power', {_two('pw')}, 'W', 'Peak power observed at t='||{_two('pt')}||'s.' from mx
  union all select f, g, 5, 'Energy delay product', {_two('edp')}, 'J*s', 'Energy-delay product.' from mx
  union all select f, g, 6, 'Appliance comparison', {_two('aa')},
    case au when 's' then 'seconds' when 'm' then 'minutes' else 'hours' end, 'Equivalent to running '||an||'.' from mx)
select {JOB}, ord, m "Metric", case when ord=5 and v<>'nan' then (qz(case when ord=5 and v<>'nan' then v end,-4))::decimal(38,0)::varchar
  else v end "Value", u "Unit", d "Description" from sm"""

ORACLES["job_summary_rows"] = f"{metrics()}, {_SUMMARY}"

ORACLES["appliance_comparison"] = f"""with li as (select l_orderkey, l_linenumber, l_extendedprice*l_quantity j,
  row_number() over () kk0 from lineitem), {appliance('li', 'j', 'kk0')}
select l_orderkey, l_linenumber, an "name", aa amount, au unit, sentence from aq"""


def described(values: str, keys: str, digits: int) -> str:
    """Statistics of `values` (keys, metric, x), quartiles by nearest rank."""
    by = f"{keys}, metric" if keys else "metric"
    pick = ", ".join(
        f"max(case when rn = floor({q}*(n-1)+0.5)+1 then x end) q{int(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    stats = ", ".join(
        f"case when regexp_matches(metric,'EpochTime$|RSS$|_J$') then qz({x},0) else qz({x},{digits}) end \"{name}\""
        for x, name in zip(
            ("me", "sd", "mi", "q25", "q50", "q75", "ma"), ("mean", "std", "min", "q25", "q50", "q75", "max")
        )
    )
    return f"""rk as (select *, row_number() over (partition by {by} order by x nulls last) rn,
  count(x) over (partition by {by}) n from {values}),
ds as (select {by}, count(x) c, count(*)-count(x) nc, avg(x) me, stddev_samp(x) sd, min(x) mi, max(x) ma, {pick}
  from rk group by {by})
select {by}, c "count", nc null_count, {stats} from ds"""


_ITEMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
ORACLES["describe_table"] = (
    "with va as ("
    + " union all ".join(f"select '{c}' metric, {c}::double x from lineitem" for c in _ITEMS)
    + "), "
    + described("va", "", 6)
)
_wide = " union all ".join(
    [f"select {JOB}, 'ElapsedTime' metric, t::double x from al"]
    + [f"select {JOB}, '{name}', c{c} from al" for name, c in ALL]
)
_text = " union all ".join(
    f"select c_nationkey, '{name}' metric, count({x}) \"count\", count(*)-count({x}) null_count, "
    + ", ".join(f'null::double "{s}"' for s in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    + f", min({x})::varchar min_text, max({x})::varchar max_text from customer group by c_nationkey"
    for name, x in (("c_name", "c_name"), ("c_mktsegment", "c_mktsegment"), ("in_debt", "(c_acctbal<0)"))
)
ORACLES["describe_customers"] = (
    "with va as (select c_nationkey, 'c_acctbal' metric, c_acctbal::double x from customer), num as (with "
    + described("va", "c_nationkey", 4)
    + f") select *, null::varchar min_text, null::varchar max_text from num union all {_text}"
)
ORACLES["describe_jobs"] = f"{aligned()}, va as ({_wide}), " + described("va", "file_label, group_name", 4)


def ranged(x: str, low: float, high: float | None, dtype: str) -> str:
    keep = f"{x}>={low}" + (f" and {x}<={high}" if high is not None else "")
    if dtype == "float":
        return f"qz(case when {keep} then cast(cast({x} as float) as double) end,3)"
    return f"case when {keep} then cast(trunc({x}) as bigint) end"


def cleaned(used: str = "used") -> str:
    """Select list of the cleaned table."""
    rules = [
        ('"ElapsedTime"', "t", 0, 9.2e18, "bigint"),
        ('"Energy__NodePower"', "c0", 0, 10000, "float"),
        ('"Energy__EpochTime"', "c1", 0, 4102444800, "bigint"),
        ('"Task_0__CPUUtilization"', "c2", 0, 100, "float"),
        ('"Task_1__RSS"', "c3", 0, 9.2e18, "bigint"),
        ('"Task_2__ReadMB"', "c4", 0, None, "float"),
        ('"Task_3__CurrPower"', "c5", 0, 10000, "float"),
        ('"Task_3__EpochTime"', "c6", 0, 4102444800, "bigint"),
        ('"EpochTime"', "epoch", 0, 4102444800, "bigint"),
        ('"Task_1__RSS_MB"', "(c3/1024.0)", 0, 1e6, "float"),
        ('"Task_0__CPUUtilization_normalized"', "(c2/32.0)", 0, 1, "float"),
        ('"ElapsedTime_Diff"', "dt", 0, 31536000000, "bigint"),
        ('"NodePower"', "w", 0, 10000, "float"),
        ('"Energy_Increment_J"', "inc", 0, None, "float"),
        ('"Energy_used_J"', used, 0, None, "float"),
    ]
    return f"{JOB}, " + ", ".join(f"{ranged(x, lo, hi, ty)} {name}" for name, x, lo, hi, ty in rules)


ORACLES["clean_and_narrow"] = f"{profile()} select {cleaned()} from pr"

_priced = f"{profile()}, {EVENT_PRICES}, {nearest('pr', 'ps', 'epoch')}"
_cost = "used/3600000.0*pp"
ORACLES["nearest_price_of_job_rows"] = f"""{_priced}
select {AT}, pe "PriceEpochTime", pp "Price_EUR_per_MWh", qz({_cost},4) "Cumulative_cost_EUR" from na"""
ORACLES["job_costs"] = f"""{_priced}
select {JOB}, qz(max({_cost}),4) total_cost_eur, qz({broken(fixed("inc/3600000000.0*pp"))},4) cost_eur_integrated
from na group by f, g"""
ORACLES["job_tables"] = f"""{profile()}, {EVENT_PRICES},
fg as (select f, min(g) g from pr group by f),
pf as (select pr.* from pr join fg using (f, g)), {nearest('pf', 'ps', 'epoch')}
select {cleaned()}, qz(pp,3) "Price_EUR_per_MWh", qz({_cost},3) "Cumulative_cost_EUR" from na"""
ORACLES["stream_job_tables"] = f"""{profile()},
fg as (select f, min(g) g from pr group by f),
pf as (select pr.* from pr join fg using (f, g))
select {cleaned()} from pf"""
# Users whose last notice was in the second batch have all datasets, the others two of them.
_new = "(uid % 2 = 1 or uid % 3 = 0)"
ORACLES["stream_changing_tables"] = f"""{profile(f"({_new} or et in ('purchase', 'click'))")},
fg as (select f, min(g) g from pr group by f),
us as (select distinct f, uid from e),
pf as (select pr.*, uid, i1 from pr join fg using (f, g) join al using (f, g, rn) join us using (f))
select {cleaned()}, case when {_new} then qz(2*c2, 3) end note, case when not {_new} and i1 is not null then 'L' || uid end "text" from pf"""
# No file has a third group, and the bad times of g1 count only where g1 is the first one.
ORACLES["first_group_tables"] = f"""{profile()},
fg as (select f, min(g) g from pr group by f),
bad as (select distinct f, g from e where g='g1' and id % 7 = 0),
pf as (select pr.* from pr join fg using (f, g) where not exists (select 1 from bad where bad.f=fg.f and bad.g=fg.g))
select {cleaned()} from pf"""
ORACLES["split_jobs"] = ORACLES["interpolate_rows"]

# Every user has datasets of their own: the wide rows, column by column, under the user's names.
_own = " union all ".join(
    f"""select {AT}, 'n' || regexp_extract(f, '[0-9]+') || '__{name}' "column", qz(c{c},{3 if name.endswith("EpochTime") else 6}) "value" from it where c{c} is not null"""
    for name, c in ALL
)
ORACLES["own_path_cells"] = f"{filled()} {_own}"
ORACLES["own_path_energy"] = ORACLES["energy_from_power"]
ORACLES["own_path_tables"] = f"""select file_label, group_name, "ElapsedTime", "EpochTime", "NodePower", "ElapsedTime_Diff", "Energy_Increment_J", "Energy_used_J",
  "Price_EUR_per_MWh", "Cumulative_cost_EUR" from ({ORACLES["job_tables"]})"""
ORACLES["stream_objects"] = f"""with {EVENTS}, n as (select f, et, min(id) id from e group by f, et)
select f file_label, 'runs' bucket, arg_max(et, id)||'/'||f||'.h5' "key" from n group by f"""

NO_ZERO = f"not ({ZERO} and et='purchase')"
REPORT = [
    ("ElapsedTime", "t"),
    *[(name, f"c{c}") for name, c in ALL],
    ("EpochTime", "epoch"),
    ("Task_1__RSS_MB", "c3/1024.0"),
    ("Task_0__CPUUtilization_normalized", "c2/32.0"),
    ("ElapsedTime_Diff", "dt"),
    ("NodePower", "w"),
    ("Energy_Increment_J", "inc"),
    ("Energy_used_J", "used"),
    ("Price_EUR_per_MWh", "pp"),
    ("Cumulative_cost_EUR", _cost),
]
_reported = f"{profile(NO_ZERO)}, {EVENT_PRICES}, {nearest('pr', 'ps', 'epoch')}"
_report = " union all ".join(f"select {JOB}, '{name}' metric, ({x})::double x from na" for name, x in REPORT)
ORACLES["job_report_statistics"] = f"{_reported}, va as ({_report}), " + described("va", "file_label, group_name", 3)
_whole = ("ElapsedTime", "EpochTime")
ORACLES["job_report_combined"] = f"{_reported} select {JOB}, " + ", ".join(
    f'{x} "{name}"' if name in _whole else f'qz({x},3) "{name}"' for name, x in REPORT
) + " from na"
_filled = "+".join(f"(count({x})>0)::int" for _, x in REPORT)
ORACLES["job_report_counts"] = f"{_reported} select {JOB}, count(*) n_rows, {_filled} n_columns from na group by f, g"
ORACLES["job_report_summary"] = f"{metrics(NO_ZERO)}, {_SUMMARY}"
ORACLES["job_report_costs"] = f"""{_reported}
select {JOB}, qz(max({_cost}),4) total_cost_eur, qz({broken(fixed("inc/3600000000.0*pp"))},4) cost_eur_integrated
from na group by f, g"""
ORACLES["job_report_prices"] = f"""{profile(NO_ZERO)}, {EVENT_PRICES},
b as (select f, g, min(epoch) lo, max(epoch) hi from pr group by f, g having count(epoch)>0),
c as (select f, g, e from b join ps on e between lo and hi
  union select f, g, min(e) from b join ps on e>=lo group by f, g
  union select f, g, max(e) from b join ps on e<lo group by f, g)
select {JOB}, e "EpochTime", qz(p,4) "Price_EUR_per_MWh" from c join ps using (e)"""

ORACLES["nearest_price_of_shipments"] = f"""with li as (
  select l_orderkey, l_linenumber, epoch_us(l_shipdate)//1000000 x from lineitem),
ps as (select epoch_us(o_orderdate)//1000000 e, qz(avg(o_totalprice),4) p from orders
  group by 1),
{nearest('li', 'ps', 'x')}
select l_orderkey, l_linenumber, x, pe "PriceEpochTime", pp "Price_EUR_per_MWh" from na"""

ORACLES["nearest_price_by_priority"] = f"""with li as (
  select o_orderkey, o_orderpriority, epoch_us(o_orderdate)//1000000 x from orders),
ps as (select o_orderpriority, epoch_us(o_orderdate)//1000000 e, qz(avg(o_totalprice),4) p from orders
  group by 1, 2),
{nearest('li', 'ps', 'x', 'o_orderpriority')}
select o_orderkey, o_orderpriority, x, pe "PriceEpochTime", pp "Price_EUR_per_MWh" from na"""

ORACLES["price_points_of_blocks"] = f"""with {EVENTS}
select ep//900*900 "EpochTime", min(v) "Price_EUR_per_MWh" from e where id%13<>0 and v>=5 group by 1"""

ORACLES["price_block_starts"] = """select
  cast(floor((epoch_us(ts)//1000 - 1705000000000)/1000) as bigint) block from events"""

ORACLES["price_block_cover_of_customers"] = """with b as (
  select o_custkey, min(epoch_us(o_orderdate)//1000000) lo, max(epoch_us(o_orderdate)//1000000) hi from orders group by 1),
w as (select distinct epoch_us(o_orderdate)//1000000//604800 k from orders),
bl as (select k*604800 block from w),
f as (select o_custkey, min(block) block from b join bl on block>=lo group by 1),
l as (select o_custkey, max(block) block from b join bl on block<lo group by 1)
select o_custkey, block from f union select o_custkey, block from l
union select o_custkey, block from b join bl on block between lo and hi"""

ORACLES["epoch_bounds_of_jobs"] = f"""{profile()}
select {JOB}, min(epoch) min_ts, max(epoch) max_ts, count(epoch) n from pr group by f, g"""

_paths = """pa as (select *, string_split(url,'/') parts, string_split(url,'/')[3] host,
  string_split(url,'/')[4:] below from pages)"""


ORACLES["record_vectors"] = """with v as (select vec_id, label, embedding, len(embedding) n from embeddings),
c as (select vec_id, unnest(range(n)) k, unnest(embedding) x from v)
select (vec_id // 10)::varchar file_label, vec_id, (k + 1)::int "at", 'v_' || k metric, qz(x, 6) "value" from c
union all select (vec_id // 10)::varchar, vec_id, (n + 1)::int, 'label', label::double from v"""


def _prefix_sql(parts: str) -> str:
    named = f"list_filter(case when len({parts})>1 then {parts}[2:] else {parts} end, lambda p: p<>'')"
    return f"""array_to_string(list_transform(case when len({named})>0 then {named} else {parts} end,
  lambda p: replace(p,'/','_')),'__')"""


ORACLES["dataset_prefixes"] = f"""with {_paths}
select page_id, {_prefix_sql('parts')} of_all, {_prefix_sql('below')} of_path, {_prefix_sql("[url,'']")} of_empty from pa"""
ORACLES["dataset_catalog_of_pages"] = f"""with {_paths}, ds as (select distinct host, below from pa)
select host file_label, below[1] group_name, array_to_string(below,'/') "path", {_prefix_sql('below')} prefix,
  row_number() over (partition by host, below[1] order by below) dataset_ord from ds"""
ORACLES["array_rows"] = """with u as (select vec_id, label, unnest(embedding)::double x,
  generate_subscripts(embedding,1)-1 pos from embeddings)
select vec_id::varchar file_label, case when label%2=0 then pos//8 else pos end row_idx,
  case when label%2=0 then 'col_'||(pos%8) else 'value' end "column", qz(x,6) "value" from u"""
ORACLES["landed_frames"] = f"""with {_paths}
select host file_label, 'g' group_name, page_id::bigint "ElapsedTime", page_id::bigint row_idx, url, length(html)::bigint chars,
  starts_with(url,'https') secure, null::bigint col_0, null::bigint col_1 from pa
union all select 'v'||vec_id, 'g', 0, 0, null, null, null, label::bigint, label::bigint+9007199254740993 from embeddings
union all select 'v'||vec_id, 'g', 1, 1, null, null, null, label::bigint*2, label::bigint-1 from embeddings"""
ORACLES["table_names"] = f"""with {_paths}
select page_id, 'job_'||replace(array_to_string(below,'/'),'/','_') table_name from pa"""

_objects = f"""{_paths}, ob as (select page_id, array_to_string(below,'/')||
  case when page_id%3=0 then '.csv' when page_id%7=0 then '_batch.h5' else '.h5' end k, length(html) chars from pa),
ol as (select *, regexp_replace(regexp_replace(k,'^.*/',''),'(.)\\.[^.]+$','\\1') stem from ob)"""
ORACLES["object_inventory_filter"] = f"""with {_objects}
select page_id, k "key", stem file_label from ol where starts_with(k,'en/') and ends_with(k,'.h5')"""
ORACLES["file_labels"] = f"""with {_objects} select page_id, stem file_label from ol where not contains(stem,'batch')"""
ORACLES["discovered_files"] = f"""with {_objects}
select stem file_label, '/data/'||k "path", 0 src_ord from ol where page_id%2=0
union all select stem, k, 1 from ol where page_id%2=1 and ends_with(k,'.h5')"""
ORACLES["latest_file_per_label"] = f"""with {_paths}, r as (select below[1] file_label, url "path", (page_id%2)::int src_ord,
  row_number() over (partition by below[1] order by page_id%2 desc, url desc) rn from pa)
select file_label, "path", src_ord from r where rn=1"""

_notices = """nt as (select event_id, event_id%11=0 nothing, case when user_id%7<>0 then 'b' end b,
  case when user_id%9<>0 then event_type||'/'||event_id||case when value<20 then '.csv' else '.h5' end end k from events),
nr as (select event_id, case when not nothing then b end b, case when not nothing then k end k,
  case when nothing then 'no_records' when b is null or k is null then 'missing_key'
       when not ends_with(k,'.h5') then 'not_h5' end reason from nt)"""
ORACLES["notification_filter"] = f"""with {_notices}
select event_id, b bucket, k "key", case when ends_with(k,'.h5') then event_id::varchar end file_label, reason from nr"""
ORACLES["notification_audit"] = f"""with {_notices}
select coalesce(reason,'accepted') reason, count(*) records from nr group by 1"""
ORACLES["object_names"] = f"""with {_paths}, n as (select page_id, host,
  regexp_replace(case when page_id%5=0 then '../'||url else url end,'[^A-Za-z0-9._-]','_','g') s from pa)
select page_id, s safe, s<>'' and not contains(s,'..') "valid", host||'/'||s "key" from n"""
ORACLES["objects_of_user"] = f"""with {_objects}
select k "key", case when page_id%5<>0 then chars else 0 end size,
  case when page_id%4<>0 then strftime(make_timestamp((1700000000+page_id*3600)*1000000),'%Y-%m-%dT%H:%M:%S')
    ||case when page_id%3=0 then '.123456' else '' end||'+00:00' end last_modified
from ol where starts_with(k,'en/')"""
ORACLES["labels_to_rescan"] = """select doc_id file_label, lang, source from documents
where doc_id not in (select doc_id from labels)"""
ORACLES["masked_secrets"] = """with n as (select c_custkey, case when c_custkey%10=0 then null
  when c_custkey%10=1 then 'abc' when c_custkey%10=2 then '' else c_name end s from customer)
select c_custkey, case when s is null or s='' then '<missing>' when length(s)<=4 then repeat('*',length(s))
  else left(s,4)||'***' end masked from n"""


def spell_out(sql: str) -> str:
    """Replace `qz(x,digits)` by the arithmetic of `adapters.quantized`."""
    while (start := sql.rfind("qz(")) >= 0:
        depth, end = 1, start + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        x, digits = sql[start + 3 : end - 1].rsplit(",", 1)
        scale = f"1e{int(digits)}"
        sql = f"{sql[:start]}(round(({x})::double*{scale}-0.12893761::double)/{scale}+0.0::double){sql[end:]}"
    return sql


ORACLES = {name: spell_out(sql) for name, sql in ORACLES.items()}
