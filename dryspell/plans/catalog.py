"""Every registered query with the SQL it is checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import functions as F

from dryspell.functions.dates import date_decode
from dryspell.functions.levels import collapse_levels, level_code, level_label
from dryspell.functions.text import csv_line
from dryspell.lineage import materialize, shared_dir, spread
from dryspell.model import BELOW_D2, D2, GROUP_KEY, LADDER, WINDOW_KEY
from dryspell.operators import (
    aggregate, dictionary, listings, quality, scoring, sketches, tiers, units,
)
from dryspell.operators.runs import run_length_encode
from dryspell.plans import bindings as b
from dryspell.plans import oracle as o
from dryspell.plans import run_state
from dryspell.plans.determine import (
    clipped_runs, dated_events, determine, drought_runs, weekly_series,
)
from dryspell.sinks import columnar, report

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


class Binding(NamedTuple):
    """One way to derive the domain tables from the given ones, with the SQL that does the same."""

    suffix: str
    sources: tuple[str, ...]
    observations: Callable
    windows: Callable
    sql: Callable
    rows: Callable = lambda spark, sf_dir: None

    def inputs(self, spark, sf_dir):
        return self.observations(spark, sf_dir), self.windows(spark, sf_dir)

    def runs(self, spark, sf_dir):
        return drought_runs(self.observations(spark, sf_dir))

    def clipped(self, spark, sf_dir, **join):
        observations, windows = self.inputs(spark, sf_dir)
        rows = self.rows(spark, sf_dir)
        if rows is not None:
            observations = spread(observations, rows, "fips", "source")
        return clipped_runs(windows, drought_runs(observations), rows=rows, **join)

    def clipped_by_window(self, spark, sf_dir):
        """``clipped`` dealt by window and source: tasks of passes over windows hold no more as the tables grow."""
        pairs, rows = self.clipped(spark, sf_dir), self.rows(spark, sf_dir)
        return pairs if rows is None else spread(pairs, rows, *GROUP_KEY)

    def result(self, spark, sf_dir):
        return determine(*self.inputs(spark, sf_dir))


NATION = Binding("", b.SOURCES, b.nation_observations, b.nation_windows, o.nation)
SUPPLIER = Binding(
    "_by_supplier", b.FLAGS, b.supplier_observations, b.supplier_windows, o.supplier, b.line_items
)


def on_both(name: str, final, *extra: str):
    """Register a query on both bindings. ``final`` is SQL, or makes it from the sources."""

    def add(fn):
        for binding in (NATION, SUPPLIER):
            text = final(binding.sources) if callable(final) else final
            register(name + binding.suffix, binding.sql(text, *extra))(partial(fn, binding))
        return fn

    return add


# --- weekly table -------------------------------------------------------------------------------


@register(
    "worst_class_weekly",
    o.raw("""select fips, source, usdm_date,
      case when count(drought_class) = count(*) then max(drought_class) end drought_class
    from raw_obs group by fips, source, usdm_date"""),
)
def worst_class_weekly(spark, sf_dir):
    return aggregate.worst_class(b.nation_raw(spark, sf_dir), ["fips", "source", "usdm_date"])


_WIDE_CELL = """case when count(*) filter (source = '{0}') = count(drought_class) filter (source = '{0}')
      then max(drought_class) filter (source = '{0}') end as "{0}\""""


@register(
    "weekly_wide",
    o.raw(f"""select fips, usdm_date, {', '.join(_WIDE_CELL.format(s) for s in b.FLAGS)}
    from raw_obs group by fips, usdm_date"""),
)
def weekly_wide(spark, sf_dir):
    return aggregate.weekly_wide(b.nation_raw(spark, sf_dir), b.FLAGS)


_PIVOT = """select fips, usdm_date, max(drought_class) filter (source = 'all') as "all",
    max(drought_class) filter (source = 'A') as "A", max(drought_class) filter (source = 'N') as "N",
    max(drought_class) filter (source = 'R') as "R" from obs group by fips, usdm_date"""


@register("wide_by_source", o.nation(_PIVOT))
def wide_by_source(spark, sf_dir):
    observations = b.nation_observations(spark, sf_dir)
    return aggregate.pivot_sources(observations, b.SOURCES).orderBy("fips", "usdm_date")


@register(
    "long_from_wide",
    o.nation(
        """select fips, usdm_date, source, case when drought_class < 3 then 0 else drought_class end drought_class
        from (unpivot wide on "all", "A", "N", "R" into name source value drought_class)""",
        f"wide as ({_PIVOT})",
    ),
)
def long_from_wide(spark, sf_dir):
    return aggregate.long_from_wide(wide_by_source(spark, sf_dir), b.SOURCES)


@register(
    "class_labels",
    o.nation("""select source, drought_class,
      ['None', 'D0', 'D1', 'D2', 'D3', 'D4'][drought_class + 1] as label,
      drought_class as code, count(*) as n from obs group by all"""),
)
def class_labels(spark, sf_dir):
    labelled = b.nation_observations(spark, sf_dir).withColumn("label", level_label("drought_class"))
    return labelled.withColumn("code", level_code("label")).groupBy(
        "source", "drought_class", "label", "code"
    ).agg(F.count(F.lit(1)).alias("n"))


# --- runs ---------------------------------------------------------------------------------------


@on_both("runs_rle", "select * from runs")
def runs_rle(binding, spark, sf_dir):
    return binding.runs(spark, sf_dir)


@on_both("runs_rle_blocked", "select * from runs")
def runs_rle_blocked(binding, spark, sf_dir):
    return drought_runs(binding.observations(spark, sf_dir), block_days=366)


def _arrivals(observations):
    """Observations with the build they arrive in (``arrival``), the class they arrive with (``told``) and the
    build that corrects it (``mended``). Years come one after the other; of those before the last build every
    17th week is late, and every 17th is wrong at first. Both are mended by the last build."""
    phase = F.pmod(F.year("usdm_date") - 2005, F.lit(12))
    due = F.when(phase <= 2, 1).when(phase <= 4, 2).otherwise(3)
    draw = F.when(due < 3, F.pmod(F.xxhash64("fips", "source", "usdm_date"), F.lit(17)))
    wrong = F.coalesce(draw == 1, F.lit(False))
    return observations.select(
        "*", F.when(draw == 0, F.lit(3)).otherwise(due).alias("arrival"),
        F.when(wrong, 5 - F.col("drought_class")).otherwise(F.col("drought_class")).alias("told"),
        F.when(wrong, F.lit(3)).alias("mended"),
    )


@on_both("runs_by_builds", "select * from runs")
def runs_by_builds(binding, spark, sf_dir):
    """Runs carried over three builds, with late and corrected weeks in the last."""
    observations = binding.observations(spark, sf_dir)
    observations = observations.withColumn("drought_class", collapse_levels("drought_class"))
    told = materialize(_arrivals(observations))
    root = f"{shared_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    for build in (1, 2, 3):
        mended = F.col("mended") <= build
        value = F.when(F.coalesce(mended, F.lit(False)), F.col("drought_class")).otherwise(F.col("told"))
        now = told.where(F.col("arrival") <= build).withColumn("drought_class", value)
        new = now.where((F.col("arrival") == build) | (F.col("mended") == build))
        columns = ["fips", "source", "usdm_date", "drought_class"]
        run_state.advance(spark, root, new.select(*columns), now.select(*columns))
    return run_state.read_runs(spark, root)


@register(
    "runs_over_gaps",
    o.nation("""select *, run_end - run_start + 1 - 7 * run_weeks as gap_days from runs
      where run_end - run_start + 1 > 7 * run_weeks"""),
)
def runs_over_gaps(spark, sf_dir):
    runs = run_length_encode(aggregate.long_from_wide(
        aggregate.pivot_sources(b.nation_observations(spark, sf_dir), b.SOURCES), b.SOURCES
    ))
    gap = F.datediff("run_end", "run_start") + 1 - 7 * F.col("run_weeks")
    return runs.withColumn("gap_days", gap).where(F.col("gap_days") > 0)


# --- units and windows --------------------------------------------------------------------------


@register(
    "units_mapped",
    o.nation(
        "select * from offices join xwalk using (fsa_county)",
        o._window_rows("own", "(select distinct office, office n from xwalk_n)"),
        """offices as (select fsa_county, program_year, pasture_type, window_start, window_end
          from own)""",
    ),
)
def units_mapped(spark, sf_dir):
    return units.map_units(b.nation_offices(spark, sf_dir), b.nation_crosswalk(spark, sf_dir))


@register(
    "unresolved_units",
    o.supplier(
        "select distinct fsa_county from ngp where fsa_county not in (select fsa_county from other)",
        o._windows("nation", "n_nationkey", 0, 100, "x.n", "nation_"),
        "other as (select fsa_county from nation_xwalk)",
    ),
)
def unresolved_units(spark, sf_dir):
    """Offices of the suppliers that the crosswalk of the nations does not know."""
    return units.unresolved_units(b.supplier_windows(spark, sf_dir), b.nation_crosswalk(spark, sf_dir))


_OBSERVED = "select * from obs where fips in (select fips from other_ngp)"


@register("observed_units_only", o.nation(_OBSERVED, o.OTHER_WINDOWS["nation"]))
def observed_units_only(spark, sf_dir):
    """Observations of the nations whose code has a window among the suppliers."""
    return units.observed_only(b.nation_observations(spark, sf_dir), b.supplier_windows(spark, sf_dir))


@register("observed_units_only_by_supplier", o.supplier("select * from obs where fips in (select fips from ngp)"))
def observed_units_only_by_supplier(spark, sf_dir):
    """Observations of the suppliers that have a window, so of every supplier that the table of suppliers lists."""
    return units.observed_only(*SUPPLIER.inputs(spark, sf_dir))


@register("clipped_runs", o.nation("select * from clip"))
def clipped_runs_direct(spark, sf_dir):
    return NATION.clipped(spark, sf_dir, bin_days=None)


@on_both("clipped_runs_binned", "select * from clip")
def clipped_runs_binned(binding, spark, sf_dir):
    return binding.clipped(spark, sf_dir)


@on_both("clipped_runs_salted", "select * from clip")
def clipped_runs_salted(binding, spark, sf_dir):
    return binding.clipped(spark, sf_dir, salts=4)


@on_both("clipped_runs_joined_by_source", "select * from clip")
def clipped_runs_joined_by_source(binding, spark, sf_dir):
    return binding.clipped(spark, sf_dir, sources=binding.sources)


_REASONS = """select reason, count(*) n_windows from (
    select case when n.window_start is null or n.window_end is null or n.window_start > n.window_end
        then 'no usable dates' when s.fips is null then 'unit never observed' else 'used' end reason
    from (select fips, fsa_county, program_year, pasture_type, window_start,
            case when pasture_type = 'P0' then null else window_end end window_end from ngp) n
    left join (select distinct fips from other_obs) s on n.fips = s.fips)
    group by reason"""


def _coverage(windows, observations):
    """Windows of one pasture type lose their end; units are those the other binding observed."""
    end = F.when(F.col("pasture_type") != "P0", F.col("window_end"))
    return quality.coverage(windows.withColumn("window_end", end), observations)


@register("silent_drops", o.nation(_REASONS, o.OTHER_OBS["nation"]))
def silent_drops(spark, sf_dir):
    return _coverage(b.nation_windows(spark, sf_dir), b.supplier_observations(spark, sf_dir))


@register("silent_drops_by_supplier", o.supplier(_REASONS, o.OTHER_OBS["supplier"]))
def silent_drops_by_supplier(spark, sf_dir):
    return _coverage(b.supplier_windows(spark, sf_dir), b.nation_observations(spark, sf_dir))


# --- tiers --------------------------------------------------------------------------------------


def _tier_rows(binding, spark, sf_dir, names):
    kept = tiers.event_rows(tiers.date_tiers(binding.clipped_by_window(spark, sf_dir)))
    labels = F.array(*[F.lit(t) for t in tiers.EVENT_ORDER])
    kept = kept.withColumn("tier", F.element_at(labels, F.col("event_order") + 1))
    return kept.where(F.col("tier").isin(*names)).drop("event_order", "event")


_TIER = f"""select {o.GROUP}, clip_start, dt qualifying_date,
    ['D2_Sandwich', 'D3b', 'D4b', 'D2a_2026', 'D2b_2026', 'D2', 'D3a', 'D4a'][ord + 1] as tier from """


@on_both(
    "tier_consecutive",
    _TIER + "(select * from t_d2 union all select * from t_d2a union all select * from t_d2b)",
)
def tier_consecutive(binding, spark, sf_dir):
    return _tier_rows(binding, spark, sf_dir, ["D2", "D2a_2026", "D2b_2026"])


@on_both("tier_cumulative", _TIER + "t_b")
def tier_cumulative(binding, spark, sf_dir):
    return _tier_rows(binding, spark, sf_dir, ["D3b", "D4b"])


@on_both("tier_immediate", _TIER + "t_a")
def tier_immediate(binding, spark, sf_dir):
    return _tier_rows(binding, spark, sf_dir, ["D3a", "D4a"])


@on_both("tier_sandwich", _TIER + "t_s")
def tier_sandwich(binding, spark, sf_dir):
    return _tier_rows(binding, spark, sf_dir, ["D2_Sandwich"])


@on_both(
    "pattern_match",
    f"select {o.GROUP}, clip_start from p where drought_class = 3 and c1 = 0 and c2 = 3",
    f"""p as (select *, lead(drought_class, 1) over s c1, lead(drought_class, 2) over s c2
      from clip window s as (partition by {o.GROUP} order by clip_start))""",
)
def pattern_match(binding, spark, sf_dir):
    found = tiers.match_pattern(
        binding.clipped_by_window(spark, sf_dir), GROUP_KEY, "clip_start", "drought_class",
        [D2, BELOW_D2, D2],
    )
    return found.where("matched").select(*GROUP_KEY, "clip_start")


# --- scoring ------------------------------------------------------------------------------------


_SCORED = f"""select {o.GROUP}, clip_start, ord as event_order, event, dt as qualifying_date,
    drought_factor from scored"""


@on_both("events_scored", _SCORED)
def events_scored(binding, spark, sf_dir):
    return scoring.score_events(dated_events(*binding.inputs(spark, sf_dir)))


@on_both("events_scored_by_table", _SCORED)
def events_scored_by_table(binding, spark, sf_dir):
    ladder = spark.createDataFrame(
        [tuple(r) for r in LADDER], "event string, first_year int, last_year int, factor int"
    )
    return scoring.score_events(dated_events(*binding.inputs(spark, sf_dir)), ladder)


_RUNGS = """whole as (select ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][cast(p_partkey % 5 as int) + 1] event,
      cast(p_partkey // 5 * 4 as int) first_year, cast(p_partkey // 5 * 4 + p_size % 4 as int) last_year,
      cast(1 + p_size % 5 as int) factor from part),
    rungs as (select event, first_year, factor,
      case when first_year < max(first_year) over (partition by event) then last_year end last_year from whole)"""


def _rungs(spark, sf_dir):
    """A ladder of one rung a part, with gaps; the last rung of each event is open."""
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    first = F.expr("p_partkey div 5 * 4")
    whole = b.table(spark, sf_dir, "part").select(
        F.element_at(names, (F.col("p_partkey") % 5 + 1).cast("int")).alias("event"),
        first.cast("int").alias("first_year"), (first + F.col("p_size") % 4).cast("int").alias("last_year"),
        (1 + F.col("p_size") % 5).cast("int").alias("factor"),
    )
    ends = whole.groupBy("event").agg(F.max("first_year").alias("_end"))
    last = F.when(F.col("first_year") < F.col("_end"), F.col("last_year"))
    return whole.join(ends, "event").select("event", "first_year", last.alias("last_year"), "factor")


@register(
    "orders_scored_by_rungs",
    f"""with {_RUNGS}, o as (select o_orderkey, o_orderpriority event, cast(o_orderkey % 20011 as int) program_year from orders)
    select o.*, factor drought_factor from o join rungs r on o.event = r.event
      and program_year >= first_year and (last_year is null or program_year <= last_year)""",
)
def orders_scored_by_rungs(spark, sf_dir):
    """Orders as events of their priority, scored by a ladder that grows with the data."""
    orders = b.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("event"),
        (F.col("o_orderkey") % 20011).cast("int").alias("program_year"),
    )
    return scoring.score_events(orders, _rungs(spark, sf_dir))


@register(
    "rung_overlaps",
    f"""with {_RUNGS}, n as (select event, first_year, last_year,
        lead(first_year) over (partition by event order by first_year, last_year nulls last) overlap
      from (select event, first_year, last_year + 2 last_year from rungs))
    select * from n where overlap is not null and (last_year is null or overlap <= last_year)""",
)
def rung_overlaps(spark, sf_dir):
    """Rungs that overlap once all of them last two years longer."""
    longer = _rungs(spark, sf_dir).withColumn("last_year", F.col("last_year") + 2)
    return scoring.overlapping_rungs(longer)


@on_both("eligibility", "select * from elig")
def eligibility(binding, spark, sf_dir):
    return binding.result(spark, sf_dir)


@on_both("eligibility_blocked_salted", "select * from elig")
def eligibility_blocked_salted(binding, spark, sf_dir):
    return determine(*binding.inputs(spark, sf_dir), block_days=366, salts=4)


@on_both("eligibility_from_wide", "select * from elig")
def eligibility_from_wide(binding, spark, sf_dir):
    """From the weekly table with one column per source, as it is stored."""
    observations, windows = binding.inputs(spark, sf_dir)
    wide = aggregate.pivot_sources(observations, binding.sources)
    return determine(weekly_series(wide, binding.sources), windows)


@on_both("eligibility_joined_by_source", "select * from elig")
def eligibility_joined_by_source(binding, spark, sf_dir):
    return determine(*binding.inputs(spark, sf_dir), sources=binding.sources)


# --- consumers ----------------------------------------------------------------------------------


@on_both(
    "grain_max_unit",
    """select source, program_year, pasture_type, fsa_county, max(drought_factor) drought_factor
    from elig group by all""",
)
def grain_max_unit(binding, spark, sf_dir):
    return units.reduce_grain(binding.result(spark, sf_dir), "max", "fsa_county")


@on_both(
    "grain_max_fips",
    """select source, program_year, pasture_type, fips, max(drought_factor) drought_factor
    from elig group by all""",
)
def grain_max_fips(binding, spark, sf_dir):
    return units.reduce_grain(binding.result(spark, sf_dir), "max", "fips")


@on_both("grain_principal", "select * from elig where fips = fsa_county")
def grain_principal(binding, spark, sf_dir):
    return units.reduce_grain(binding.result(spark, sf_dir), "principal")


@register(
    "slice_max_attrs",
    o.nation(
        """select s.fips, s.drought_factor, a.name, a.region from (select fips, max(drought_factor) drought_factor
          from elig where pasture_type = 'P1' and program_year = 2012 and source = 'all' group by fips) s
        left join attrs a on s.fips = a.fips""",
        f"""attrs as (select {o._code('n_nationkey')} fips, n_name as name, r_name as region
          from nation join region on n_regionkey = r_regionkey)""",
    ),
)
def slice_max_attrs(spark, sf_dir):
    regions = b.table(spark, sf_dir, "region")
    attrs = b.table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        b.unit_code("n_nationkey").alias("fips"), F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
    )
    return units.factor_map(NATION.result(spark, sf_dir), attrs, 2012, "P1", "all")


def _sensitivity_sql(sources):
    tops = ", ".join(
        f"max(drought_factor) filter (source = '{s}') as \"factor_{s}\"" for s in sources
    )
    names = [f'"factor_{s}"' for s in sources]
    missing = " or ".join(f"{n} is null" for n in names)
    return f"""select * from (select {o.WINDOW}, {tops} from elig
      where source in ({', '.join(repr(s) for s in sources)}) group by {o.WINDOW})
      where {missing} or greatest({', '.join(names)}) <> least({', '.join(names)})"""


@on_both("source_sensitivity", _sensitivity_sql)
def source_sensitivity(binding, spark, sf_dir):
    return units.source_sensitivity(binding.result(spark, sf_dir), binding.sources)


@on_both(
    "payable_capped",
    f"""select e.*, least(drought_factor, cast((window_end - window_start + 1) // 30 as integer)) payable_months
    from elig e left join ngp using ({o.WINDOW})""",
)
def payable_capped(binding, spark, sf_dir):
    observations, windows = binding.inputs(spark, sf_dir)
    months = F.expr("cast((datediff(window_end, window_start) + 1) div 30 as int)")
    caps = windows.withColumn("max_months", months)
    return units.payable(determine(observations, windows), caps)


# --- invariants, on tables that break them ------------------------------------------------------


@on_both(
    "dup_keys",
    f"""select {o.WINDOW}, count(*) n from (select fips, fsa_county, program_year,
      case when pasture_type = 'P3' then 'P2' else pasture_type end pasture_type from ngp)
    group by all having count(*) > 1""",
)
def dup_keys(binding, spark, sf_dir):
    """Windows of one pasture type filed under another."""
    kind = F.when(F.col("pasture_type") == "P3", F.lit("P2")).otherwise(F.col("pasture_type"))
    misfiled = binding.windows(spark, sf_dir).withColumn("pasture_type", kind)
    return quality.duplicate_keys(misfiled, WINDOW_KEY)


@on_both(
    "null_rows",
    f"""select {o.WINDOW}, event, drought_factor from ngp left join elig using ({o.WINDOW})
    where event is null or drought_factor is null""",
)
def null_rows(binding, spark, sf_dir):
    """Windows next to their events: those without any have missing fields."""
    observations, windows = binding.inputs(spark, sf_dir)
    joined = windows.select(*WINDOW_KEY).join(
        determine(observations, windows), list(WINDOW_KEY), "left"
    )
    return quality.null_rows(joined.select(*WINDOW_KEY, "event", "drought_factor"))


@on_both(
    "ladder_violations",
    """select * from (select * replace (program_year - 12 as program_year) from elig)
    where (program_year <= 2011 and drought_factor not in (1, 2, 3))
      or (program_year between 2012 and 2025 and drought_factor not in (1, 3, 4, 5))
      or drought_factor not between 1 and 5""",
)
def ladder_violations(binding, spark, sf_dir):
    """Events filed twelve years early, under the ladder of another era."""
    result = binding.result(spark, sf_dir)
    return quality.outside_ladder(result.withColumn("program_year", F.col("program_year") - 12))


@on_both(
    "date_outside_window",
    f"""select e.*, window_start, cast(window_end - 60 as date) window_end from elig e
    join ngp using ({o.WINDOW}) where qualifying_date < window_start or qualifying_date > window_end - 60""",
)
def date_outside_window(binding, spark, sf_dir):
    """Events against windows that close sixty days early."""
    observations, windows = binding.inputs(spark, sf_dir)
    shorter = windows.withColumn("window_end", F.date_sub("window_end", 60))
    return quality.outside_window(determine(observations, windows), shorter)


# --- fan-out ------------------------------------------------------------------------------------


def _fanout(binding, spark, sf_dir):
    return units.fanout_report(units.cell_factors(binding.result(spark, sf_dir)))


@on_both("spanning_units", "select * from off_span", o.FANOUT)
def spanning_units(binding, spark, sf_dir):
    found = _fanout(binding, spark, sf_dir)["offices_spanning"]
    return found.orderBy(F.desc("n_fips"), "fsa_county")


@on_both("split_units", "select * from unit_span", o.FANOUT)
def split_units(binding, spark, sf_dir):
    found = _fanout(binding, spark, sf_dir)["units_spanning"]
    return found.orderBy(F.desc("n_offices"), "fips")


# The nations of an office lie in different eras and share no cell, so only suppliers are compared.
@register(
    "disagree_by_office", o.supplier("select * from off_cells where highest > lowest", o.FANOUT)
)
def disagree_by_office(spark, sf_dir):
    return _fanout(SUPPLIER, spark, sf_dir)["offices_disagree"]


@on_both("disagree_by_unit", "select * from unit_cells where highest > lowest", o.FANOUT)
def disagree_by_unit(binding, spark, sf_dir):
    return _fanout(binding, spark, sf_dir)["units_disagree"]


_METRICS = """
metrics as (
  select 'n_records' metric, count(*) as value from elig
  union all select 'first_year', min(program_year) from elig
  union all select 'last_year', max(program_year) from elig
  union all select 'n_pairs', count(*) from pairs
  union all select 'n_units', count(distinct fips) from elig
  union all select 'n_offices', count(distinct fsa_county) from elig
  union all select 'n_types', count(distinct pasture_type) from elig
  union all select 'n_sources', count(distinct source) from elig
  union all select 'n_offices_spanning', count(*) from off_span
  union all select 'n_units_split', count(*) from unit_span
  union all select 'n_offices_disagree', count(*) from off_cells where highest > lowest
  union all select 'n_offices_touched', count(*) from off_cells
  union all select 'n_units_disagree', count(*) from unit_cells where highest > lowest
  union all select 'n_units_touched', count(*) from unit_cells)"""


def _reported(binding, spark, sf_dir):
    result = materialize(binding.result(spark, sf_dir))
    return result, units.fanout_report(materialize(units.cell_factors(result)))


@on_both("qa_summary", "select * from metrics", o.FANOUT, _METRICS)
def qa_summary(binding, spark, sf_dir):
    return report.qa_summary(*_reported(binding, spark, sf_dir))


_COUNTED = "(select distinct program_year, fips, fsa_county, pasture_type, source from elig)"


@on_both(
    "sketch_counts",
    f"""select year, metric, n, true as near from (
      select program_year as year, count(distinct (fips, fsa_county)) n_pairs, count(distinct fips) n_units,
        count(distinct fsa_county) n_offices, count(distinct pasture_type) n_types, count(distinct source) n_sources
      from {_COUNTED} group by grouping sets ((program_year), ()))
    unpivot (n for metric in (n_pairs, n_units, n_offices, n_types, n_sources))""",
)
def sketch_counts(binding, spark, sf_dir):
    """Distinct counts of each program year and of all (null year), with whether the merged yearly sketches are
    within four standard errors of them."""
    result, names = materialize(binding.result(spark, sf_dir)), list(sketches.RESULT_COUNTS)
    parts = materialize(sketches.sketches(result, ["program_year"], sketches.RESULT_COUNTS))
    year, every = F.col("program_year").alias("year"), F.lit(None).cast("int").alias("year")

    def both(count):
        return count(["program_year"]).select(year, *names).unionByName(count([]).select(every, *names))

    exact = both(lambda by: sketches.exact_counts(result, sketches.RESULT_COUNTS, by)).unpivot("year", names, "metric", "n")
    guess = both(lambda by: sketches.estimates(parts, names, by)).unpivot("year", names, "metric", "guess")
    same = exact["year"].eqNullSafe(guess["year"]) & (exact["metric"] == guess["metric"])
    near = F.abs(F.col("guess") - F.col("n")) <= 4 * sketches.relative_error() * F.col("n")
    return exact.join(guess, same).select(exact["year"], exact["metric"], "n", near.alias("near"))


@register(
    "csv_lines",
    o.supplier(
        """select '  ' || source || ',' || program_year || ',' || pasture_type || ',' || fsa_county || ','
          || lowest || ',' || highest as line from off_cells where highest > lowest""",
        o.FANOUT,
    ),
)
def csv_lines(spark, sf_dir):
    columns = [*units.CELL_KEY, "fsa_county", "lowest", "highest"]
    return disagree_by_office(spark, sf_dir).select(csv_line(columns).alias("line"))


def _fixed_lines(section: int, lines: list[str]) -> str:
    rows = ", ".join(
        f"({section}, {i - len(lines)}, 0, '', '', '', '', '{t}')" for i, t in enumerate(lines)
    )
    return f"select * from (values {rows}) v(section, rank, weight, k1, k2, k3, k4, text)"


def _report_sql() -> str:
    labels = ", ".join(f"('{m}', {i}, '{t}')" for i, (m, t) in enumerate(report.SUMMARY))
    parts = [_fixed_lines(s, lines) for s, lines in report.FIXED_LINES.items()]
    parts.append(
        "select 1, 0, place, '', '', '', '', label || ': ' || value from metrics "
        f"join (values {labels}) v(metric, place, label) using (metric)"
    )
    for section, unit, count, found in (
        (3, "fsa_county", "n_fips", "off_span"), (4, "fips", "n_offices", "unit_span"),
    ):
        parts.append(
            f"select {section}, 0, -{count}, {unit}, '', '', '', '  ' || {unit} || ',' || {count} "
            f"from {found}"
        )
    for section, unit, cells in ((5, "fsa_county", "off_cells"), (6, "fips", "unit_cells")):
        parts.append(
            f"select {section}, 0, 0, source, cast(program_year as varchar), pasture_type, {unit}, "
            f"'  ' || source || ',' || program_year || ',' || pasture_type || ',' || {unit} || ',' || "
            f"lowest || ',' || highest from {cells} where highest > lowest"
        )
    return " union all ".join(parts)


@on_both("qa_report", _report_sql(), o.FANOUT, _METRICS)
def qa_report(binding, spark, sf_dir):
    return report.report_lines(*_reported(binding, spark, sf_dir))


# --- columnar document --------------------------------------------------------------------------


def _codes(binding, spark, sf_dir):
    """The result, its dictionary and its codes; the first two are materialized."""
    result = materialize(binding.result(spark, sf_dir))
    entries = columnar.record_dictionary(result)
    return result, entries, columnar.record_codes(result, entries)


@on_both("web_dictionary", "select * from dict", o.DICTIONARY)
def web_dictionary(binding, spark, sf_dir):
    result = materialize(binding.result(spark, sf_dir))
    return dictionary.sorted_dictionary(result, columnar.DIMS)


@on_both("web_codes", "select * exclude (program_year, qualifying_date) from codes", o.CODES)
def web_codes(binding, spark, sf_dir):
    codes = _codes(binding, spark, sf_dir)[2].select(*columnar.RECORD_FIELDS)
    return codes.orderBy(*columnar.RECORD_ORDER)


@on_both(
    "web_roundtrip",
    """select fips, county, type, event, source, program_year, qy, qo, qualifying_date,
      cast(make_date(program_year + qo, 1, 1) + qy - 1 as date) decoded from codes""",
    o.CODES,
)
def web_roundtrip(binding, spark, sf_dir):
    return _codes(binding, spark, sf_dir)[2].select(
        "fips", "county", "type", "event", "source", "program_year", "qy", "qo", "qualifying_date",
        date_decode("qy", "qo", "program_year").alias("decoded"),
    )


_CELL_ORDER = "order by event, qy, qo, df, source"


@on_both(
    "web_arrays",
    "select type, county, fips, year, "
    + ", ".join(
        f"string_agg({c}, ',' {_CELL_ORDER}) as {c}s" for c in ("event", "qy", "qo", "df", "source")
    )
    + " from codes group by type, county, fips, year",
    o.CODES,
)
def web_arrays(binding, spark, sf_dir):
    cells = columnar.record_cells(_codes(binding, spark, sf_dir)[2])
    return cells.select(
        *columnar.CELL,
        *[columnar.cell_text(c).alias(f"{c}s") for c in ("event", "qy", "qo", "df", "source")],
    )


# Place of each record array in the document's line order.
_ARRAY_PARTS = {f: 19 + 3 * i for i, f in enumerate(columnar.RECORD_FIELDS)}


@on_both(
    "web_document",
    """select 0 part, 0 k0, 0 k1, 0 k2, 0 k3, '{"schema":"eligibility-columns/1","dataset":"eligibility",'
      || '"license":"CC0-1.0","year0":' || min(program_year) || ',"years":[' || min(program_year) || ','
      || max(program_year) || ']' as text from elig
    union all select 17, 0, 0, 0, 0, ',"n":' || count(*) from elig
    union all select 46, 0, 0, 0, 0, '}' union all """
    + " union all ".join(
        f"""select {1 + 3 * i}, 0, 0, 0, 0, ',"{field}":[' union all select {3 + 3 * i}, 0, 0, 0, 0, ']'
        union all select {2 + 3 * i}, code, 0, 0, 0, case when code > 0 then ',' else '' end
          || '"' || value || '"' from dict where dim = '{dim}'"""
        for i, (field, dim) in enumerate(columnar.DICTIONARY_FIELDS)
    )
    + " union all "
    + " union all ".join(
        f"""select {p - 1}, 0, 0, 0, 0, ',"{f}":[' union all select {p + 1}, 0, 0, 0, 0, ']'
        union all select {p}, type, county, fips, year, lead || body_{f} from bodies"""
        for f, p in _ARRAY_PARTS.items()
    ),
    o.DICTIONARY, o.CODES,
    "cells_ as (select type, county, fips, year, "
    + ", ".join(
        f"string_agg(codes.{f}, ',' order by codes.event, qy, qo, df, codes.source) body_{f}"
        for f in columnar.RECORD_FIELDS
    )
    + " from codes group by codes.type, codes.county, codes.fips, codes.year)",
    """bodies as (select *, case when row_number() over (order by type, county, fips, year) = 1
      then '' else ',' end lead from cells_)""",
)
def web_document(binding, spark, sf_dir):
    result, entries, codes = _codes(binding, spark, sf_dir)
    return columnar.document_lines(result, entries, materialize(columnar.record_cells(codes)))


# --- manifests and listings ---------------------------------------------------------------------


def _manifest(spark, sf_dir):
    week = F.trunc(F.col("l_shipdate").cast("date"), "week").cast("string")
    name = F.concat(F.lit("USDM_"), F.col("l_suppkey").cast("string"), F.lit("_"), week)
    files = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source"), F.concat(name, F.lit(".parquet")).alias("file")
    ).distinct()
    url = F.concat(F.lit("s3a://archive/"), F.col("source"), F.lit("/"), F.col("file"))
    return files.select("source", url.alias("url"), "file")


def _lines_and_orders(spark, sf_dir):
    """Line items with the weeks they were shipped and ordered in. Both tables grow alike: joined sort-merge, over
    as many tasks as the line items need, so that one task sorts and counts a bounded number of them."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_suppkey", "l_shipdate")
    lines = spread(lines, lines.count(), "l_orderkey", for_join=True)
    orders = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    orders = orders.hint("merge")
    week = lambda c: F.trunc(F.col(c).cast("date"), "week").cast("string")
    return lines.join(orders, "l_orderkey").select(
        "l_returnflag", F.col("l_suppkey").cast("string").alias("unit"),
        week("l_shipdate").alias("shipped"), week("o_orderdate").alias("ordered"),
    )


def _lines_as_files(lines, week, rows):
    """Nearly every line item makes a key of its own, so they are dealt by key before they are counted."""
    key = F.concat_ws("/", F.lit("data"), F.col("l_returnflag"), F.concat_ws("_", "unit", week))
    keys = spread(lines.select(key.alias("key")), rows, "key")
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"))


_BUILT = """built as (select distinct 'USDM_' || l_suppkey || '_' || cast(date_trunc('week', o_orderdate) as date)
    || '.parquet' file from lineitem join orders on l_orderkey = o_orderkey)"""


@register(
    "manifest_pending",
    o.files("select * from manifest where file not in (select file from built)", _BUILT),
)
def manifest_pending(spark, sf_dir):
    """Files named by ship week that no order week of their supplier built."""
    built = _lines_and_orders(spark, sf_dir).select(F.concat(
        F.lit("USDM_"), F.col("unit"), F.lit("_"), F.col("ordered"), F.lit(".parquet")
    ).alias("file")).distinct()
    return listings.pending(_manifest(spark, sf_dir), built)


@register(
    "completeness_gate",
    o.files("select file, count(distinct source) = 3 as posted from manifest group by file"),
)
def completeness_gate(spark, sf_dir):
    return listings.completeness_gate(_manifest(spark, sf_dir), required_sources=b.FLAGS)


@register(
    "completeness_gate_listed",
    o.files("""select file, bool_and(url in (select url from manifest where file in (
      select file from built))) as posted from manifest group by file""", _BUILT),
)
def completeness_gate_listed(spark, sf_dir):
    manifest = _manifest(spark, sf_dir)
    pending_urls = manifest_pending(spark, sf_dir).select("url")
    there = manifest.select("url").join(pending_urls, "url", "left_anti")
    return listings.completeness_gate(manifest, posted=there)


@register("manifest_nested", o.files("select file, source, url from manifest"))
def manifest_nested(spark, sf_dir):
    return listings.unnest(listings.nest_by_source(_manifest(spark, sf_dir)))


_LISTED = """{0} as (select 'data/' || l_returnflag || '/' || l_suppkey || '_'
    || cast(date_trunc('week', {1}) as date) as key, count(*) as size
  from lineitem join orders on l_orderkey = o_orderkey group by 1)"""
_RECONCILED = """select * from (select coalesce(w.key, h.key) as key,
    case when h.key is null then 'missing' when w.key is null then '{0}'
      when w.size <> h.size then 'size mismatch' end as problem,
    w.size as expected_size, h.size as actual_size
  from want w full join have h on w.key = h.key) where problem is not null{1}"""


def _listing_pair(spark, sf_dir):
    """Files by ship week, expected, and by order week, listed."""
    lines = _lines_and_orders(spark, sf_dir)
    rows = b.table(spark, sf_dir, "lineitem").count()
    return _lines_as_files(lines, "shipped", rows), _lines_as_files(lines, "ordered", rows)


_LISTING_SQL = (_LISTED.format("want", "l_shipdate"), _LISTED.format("have", "o_orderdate"))


@register("listing_reconcile", o._with(*_LISTING_SQL, final=_RECONCILED.format("unexpected", "")))
def listing_reconcile(spark, sf_dir):
    return listings.reconcile(*_listing_pair(spark, sf_dir))


@register(
    "listing_reconcile_subset",
    o._with(*_LISTING_SQL, final=_RECONCILED.format("unexpected", " and problem <> 'unexpected'")),
)
def listing_reconcile_subset(spark, sf_dir):
    return listings.reconcile(*_listing_pair(spark, sf_dir), exact=False)


@register(
    "url_manifest",
    """with listing as (select 'pages/' || regexp_replace(url, '^[a-z]+://', '') as key from pages
      union all select 'pages/_cache/' || regexp_replace(url, '^[a-z]+://', '') from pages)
    select key, 'https://files.example.org/' || replace(replace(replace(replace(replace(key,
      '%', '%25'), ' ', '%20'), '#', '%23'), '?', '%3F'), '+', '%2B') as url
    from listing where not regexp_matches(key, '(^|/)_')""",
)
def url_manifest(spark, sf_dir):
    path = F.regexp_replace("url", "^[a-z]+://", "")
    pages = b.table(spark, sf_dir, "pages")
    published = pages.select(F.concat(F.lit("pages/"), path).alias("key"))
    cached = pages.select(F.concat(F.lit("pages/_cache/"), path).alias("key"))
    return listings.url_manifest(
        published.unionByName(cached), "https://files.example.org", "pages"
    )
