"""The SQL each registered query is checked against, written for an independent engine."""

from __future__ import annotations

GROUP = "fips, fsa_county, source, program_year, pasture_type"
WINDOW = "fips, fsa_county, program_year, pasture_type"


def _code(x: str) -> str:
    return f"lpad(cast({x} as varchar), cast(greatest(length(cast({x} as varchar)), 5) as integer), '0')"


def _shift(n: str) -> str:
    return f"(case when {n} % 2 = 0 then 4746 else 9128 end)"


NATION_OBS = f"""
l as (select s_nationkey n, src, cast(l_shipdate as date) d, cast(l_quantity as bigint) q
  from lineitem join supplier on l_suppkey = s_suppkey, (values ('all'),('A'),('N'),('R')) v(src)
  where src = 'all' or src = l_returnflag),
m as (select n, src, cast(date_trunc('quarter', d) as date) mo, sum(q) sq from l group by all),
mc as (select n, src, mo, ntile(6) over (partition by src order by sq, n, mo) - 1 k from m),
w as (select n, src, cast(date_trunc('week', d) as date) wk, max(q) mq from l group by all),
obs as (select {_code('w.n')} fips, w.src source,
    cast(w.wk + {_shift('w.n')} as date) usdm_date,
    cast(case when mq < case w.src when 'all' then 20 else 8 end then 0 else mc.k end as integer) drought_class
  from w join mc on w.n = mc.n and w.src = mc.src and mc.mo = cast(date_trunc('quarter', w.wk) as date))"""

RAW_CLASS = "case when l_quantity = 50 then null else cast((cast(l_quantity as bigint) - 1) // 9 as integer) end"

NATION_RAW = f"""
raw_obs as (select {_code('s_nationkey')} fips, l_returnflag source,
    cast(date_trunc('week', l_shipdate) as date) usdm_date, {RAW_CLASS} drought_class
  from lineitem join supplier on l_suppkey = s_suppkey)"""

SUPPLIER_OBS = f"""
raw_obs as (select {_code('l_suppkey')} fips, l_returnflag source,
    cast(cast(date_trunc('week', l_shipdate) as date) + {_shift('(l_suppkey // 2)')} as date) usdm_date,
    {RAW_CLASS} drought_class
  from lineitem),
obs as (select * from (select fips, source, usdm_date,
    case when count(drought_class) = count(*) then max(drought_class) end drought_class
  from raw_obs group by all) where drought_class is not null)"""


def _windows(units: str, key: str, shared: int, own: int, era: str, name: str = "") -> str:
    return f"""
{name}xwalk_n as (select distinct office, n from (select {shared} + {key} // 2 office, {key} n from {units}
  union all select {own} + {key}, {key} from {units} where {key} % 5 = 0)),
{name}xwalk as (select {_code('office')} fsa_county, {_code('n')} fips from {name}xwalk_n),
{_window_rows(name + 'ngp', name + 'xwalk_n', era)}"""


def _window_rows(name: str, units: str, era: str = "x.n") -> str:
    return f"""
{name} as (select {_code('x.n')} fips, {_code('x.office')} fsa_county,
    cast(y + case when {era} % 2 = 0 then 13 else 25 end as integer) program_year, 'P' || p pasture_type,
    cast(make_date(y - case when p = 0 then 1 else 0 end,
      case p when 0 then 11 when 1 then 2 when 2 then 4 else 5 end, 1 + cast(x.office % 20 as integer))
      + {_shift(era)} as date) window_start,
    cast(make_date(y, case p when 0 then 4 when 1 then 8 when 2 then 11 else 7 end,
      1 + cast(x.office % 20 as integer)) + {_shift(era)} as date) window_end
  from {units} x, (select unnest(range(1995, 2002))::integer y), (select unnest(range(0, 4))::integer p))"""


NATION_WINDOWS = _windows("nation", "n_nationkey", 0, 100, "x.n")
SUPPLIER_WINDOWS = _windows("supplier", "s_suppkey", 10**12, 0, "(x.n // 2)")

# The windows and observations of the other binding beside those of this one.
OTHER_WINDOWS = {
    "nation": _windows("supplier", "s_suppkey", 10**12, 0, "(x.n // 2)", "other_"),
    "supplier": _windows("nation", "n_nationkey", 0, 100, "x.n", "other_"),
}
OTHER_OBS = {
    "nation": SUPPLIER_OBS.replace("raw_obs", "other_raw").replace("\nobs as", "\nother_obs as"),
    "supplier": NATION_OBS.replace("\nobs as", "\nother_obs as"),
}

RUNS = """
c as (select fips, source, usdm_date, case when drought_class < 3 then 0 else drought_class end drought_class from obs),
f as (select *, case when drought_class <> lag(drought_class) over s then 1 else 0 end chg
  from c window s as (partition by fips, source order by usdm_date)),
g as (select *, sum(chg) over (partition by fips, source order by usdm_date) run from f),
runs as (select fips, source, drought_class, min(usdm_date) run_start,
    cast(max(usdm_date) + 6 as date) run_end, count(*) run_weeks
  from g group by fips, source, drought_class, run)"""

CLIP = """
clip as (select n.fips, n.fsa_county, r.source, n.program_year, n.pasture_type, r.drought_class,
    greatest(n.window_start, r.run_start) clip_start, least(n.window_end, r.run_end) clip_end,
    cast(least(n.window_end, r.run_end) - greatest(n.window_start, r.run_start) + 1 as integer) clip_days
  from ngp n join runs r on n.fips = r.fips and n.window_start <= r.run_end and r.run_start <= n.window_end)"""

# Each tier as its own ranking query, unlike the single window pass of the library.
TIERS = f"""
d2 as (select {GROUP}, clip_start, clip_end, clip_days from clip where drought_class = 3),
t_d2 as (select {GROUP}, clip_start, 'D2' event, 5 ord, cast(clip_end - (clip_days - 56) as date) dt from (
  select *, row_number() over (partition by {GROUP} order by clip_start) k from d2 where clip_days >= 56) where k = 1),
t_d2a as (select {GROUP}, clip_start, 'D2a_2026' event, 3 ord, cast(clip_end - (clip_days - 28) as date) dt from (
  select *, row_number() over (partition by {GROUP} order by clip_start) k from d2 where clip_days >= 28) where k = 1),
t_d2b as (select {GROUP}, clip_start, 'D2b_2026' event, 4 ord, cast(clip_end - (clip_days - 49) as date) dt from (
  select *, row_number() over (partition by {GROUP} order by clip_start) k from d2 where clip_days >= 49) where k = 1),
cum as (select *, sum(clip_days) over (partition by {GROUP}, drought_class order by clip_start) tot
  from clip where drought_class in (4, 5)),
t_b as (select {GROUP}, clip_start, case drought_class when 4 then 'D3b' else 'D4b' end event,
    case drought_class when 4 then 1 else 2 end ord, cast(clip_end - cast(tot - 28 as integer) as date) dt from (
  select *, row_number() over (partition by {GROUP}, drought_class order by clip_start) k
  from cum where tot >= 28) where k = 1),
t_a as (select {GROUP}, clip_start, case drought_class when 4 then 'D3a' else 'D4a' end event,
    case drought_class when 4 then 6 else 7 end ord, clip_start dt from clip where drought_class in (4, 5)),
nb as (select *, lag(drought_class, 1) over s c1, lag(drought_class, 2) over s c2,
    lag(clip_days, 1) over s l1, lag(clip_days, 2) over s l2
  from clip window s as (partition by {GROUP} order by clip_start)),
t_s as (select {GROUP}, clip_start, 'D2b_2026' event, 0 ord, cast(clip_end - (clip_days + l2 - 49) as date) dt
  from nb where c2 = 3 and c1 = 0 and drought_class = 3 and l2 < 49 and l1 = 7 and clip_days + l2 >= 49),
tiers as (select * from t_s union all select * from t_b union all select * from t_d2a
  union all select * from t_d2b union all select * from t_d2 union all select * from t_a)"""

FACTOR = """cast(case
    when program_year between 2008 and 2011 then case event when 'D4b' then 3 when 'D4a' then 3
      when 'D3b' then 3 when 'D3a' then 2 when 'D2' then 1 else 0 end
    when program_year between 2012 and 2025 then case event when 'D4b' then 5 when 'D4a' then 4
      when 'D3b' then 4 when 'D3a' then 3 when 'D2' then 1 else 0 end
    when program_year >= 2026 then case event when 'D4b' then 5 when 'D4a' then 4 when 'D3b' then 4
      when 'D3a' then 3 when 'D2b_2026' then 2 when 'D2a_2026' then 1 else 0 end
    else 0 end as integer)"""

ELIG = f"""
scored as (select * from (select *, {FACTOR} drought_factor from tiers) where drought_factor > 0),
firsts as (select * from (select *, row_number() over (
    partition by {GROUP}, drought_factor order by dt, clip_start, ord) k from scored) where k = 1),
peaks as (select *, max(drought_factor) over (partition by {GROUP} order by dt, clip_start, ord
    rows between unbounded preceding and current row) peak from firsts),
elig as (select {GROUP}, event, dt qualifying_date, drought_factor from peaks where drought_factor = peak)"""


def _with(*parts: str, final: str) -> str:
    return "with " + ",".join(parts) + "\n" + final


def nation(final: str, *extra: str) -> str:
    return _with(NATION_OBS, NATION_WINDOWS, RUNS, CLIP, TIERS, ELIG, *extra, final=final)


def supplier(final: str, *extra: str) -> str:
    return _with(SUPPLIER_OBS, SUPPLIER_WINDOWS, RUNS, CLIP, TIERS, ELIG, *extra, final=final)


def raw(final: str, *extra: str) -> str:
    return _with(NATION_RAW, *extra, final=final)


# Weekly files as a manifest would list them: one per flag, supplier and week.
FILES = f"""
files as (select distinct l_returnflag source,
    'USDM_' || l_suppkey || '_' || cast(date_trunc('week', l_shipdate) as date) || '.parquet' file
  from lineitem),
manifest as (select source, 's3a://archive/' || source || '/' || file url, file from files)"""


def files(final: str, *extra: str) -> str:
    return _with(FILES, *extra, final=final)


FANOUT = """
pairs as (select distinct fips, fsa_county from elig),
cells as (select source, program_year, pasture_type, fips, fsa_county, max(drought_factor) drought_factor
  from elig group by all),
off_span as (select fsa_county, count(*) n_fips from pairs group by fsa_county having count(*) > 1),
unit_span as (select fips, count(*) n_offices from pairs group by fips having count(*) > 1),
off_cells as (select source, program_year, pasture_type, fsa_county, min(drought_factor) lowest,
    max(drought_factor) highest from cells where fsa_county in (select fsa_county from off_span) group by all),
unit_cells as (select source, program_year, pasture_type, fips, min(drought_factor) lowest,
    max(drought_factor) highest from cells where fips in (select fips from unit_span) group by all)"""

CODES = """
codes as (select
    cast(dense_rank() over (order by pasture_type) - 1 as integer) as type,
    cast(dense_rank() over (order by fsa_county) - 1 as integer) as county,
    cast(dense_rank() over (order by fips) - 1 as integer) as fips,
    cast(program_year - min(program_year) over () as integer) as year,
    cast(dense_rank() over (order by event) - 1 as integer) as event,
    cast(dayofyear(qualifying_date) as integer) qy,
    cast(year(qualifying_date) - program_year as integer) qo,
    drought_factor df,
    cast(dense_rank() over (order by source) - 1 as integer) as source,
    program_year, qualifying_date
  from elig)"""

DICTIONARY = """
dict as (select dim, value, cast(row_number() over (partition by dim order by value) - 1 as integer) code from (
  select 'type' dim, pasture_type as value from elig union select 'county', fsa_county from elig
  union select 'fips', fips from elig union select 'event', event from elig
  union select 'source', source from elig))"""
