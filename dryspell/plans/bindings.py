"""Domain tables derived from the benchmark tables.

Two bindings of the same shape. ``nation``: few units with dense weekly series, aggregated from every
line item. ``supplier``: one unit per supplier, so units and windows grow with the data.

Dates move by whole weeks so that the program years fall in all three ladder eras.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize, spread
from dryspell.operators.aggregate import worst_class

SOURCES = ("all", "A", "N", "R")
FLAGS = ("A", "N", "R")

# Shift of even and odd units, in days and in years.
SHIFT_DAYS = (4746, 9128)
SHIFT_YEARS = (13, 25)

# Fixed values of the four windows a year: years back and month of the start, month of the end.
WINDOW_SHAPES = ((0, 1, 11, 4), (1, 0, 2, 8), (2, 0, 4, 11), (3, 0, 5, 7))
FIRST_YEAR, LAST_YEAR = 1995, 2001

# Offsets of the codes of shared and of own offices.
NATION_OFFICES = (0, 100)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit_code(number) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(5)), F.lit("0"))


def _shift(number: Column, amounts) -> Column:
    return F.when(number % 2 == 0, F.lit(amounts[0])).otherwise(F.lit(amounts[1]))


def line_items(spark: SparkSession, sf_dir: str) -> int:
    """Number of line items; weekly cells and runs of the suppliers are no more."""
    return table(spark, sf_dir, "lineitem").count()


def _lines(spark, sf_dir) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.trunc(day, "week").alias("week"),
        F.trunc(day, "quarter").alias("quarter"),
    )


def nation_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fips, source, usdm_date, drought_class``: the class is the sextile of the quarter's quantity,
    weak weeks are set to 0."""
    lines = _lines(spark, sf_dir).join(
        table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n")),
        "s_suppkey",
    )
    # Combined map-side to a row per nation, flag, week and quarter. Written out because it is used
    # twice below: the line items are read once.
    weekly = materialize(lines.groupBy("n", "flag", "week", "quarter").agg(
        F.sum("q").alias("q_sum"), F.max("q").alias("q_max")
    ))
    both = weekly.withColumn("source", F.explode(F.array(F.lit("all"), F.col("flag"))))
    quarters = both.groupBy("n", "source", "quarter").agg(F.sum("q_sum").alias("q_sum"))
    # At most nations x quarters rows per source.
    by_source = Window.partitionBy("source").orderBy("q_sum", "n", "quarter")
    classes = quarters.select(
        "n", "source", "quarter", (F.ntile(6).over(by_source) - 1).alias("level")
    )
    weeks = (
        both.groupBy("n", "source", "week").agg(F.max("q_max").alias("q_max"))
        .withColumn("quarter", F.trunc("week", "quarter"))
    )
    weak = F.col("q_max") < F.when(F.col("source") == "all", F.lit(20)).otherwise(F.lit(8))
    return weeks.join(classes, ["n", "source", "quarter"]).select(
        unit_code("n").alias("fips"),
        "source",
        F.date_add("week", _shift(F.col("n"), SHIFT_DAYS)).alias("usdm_date"),
        F.when(weak, F.lit(0)).otherwise(F.col("level")).alias("drought_class"),
    )


def _crosswalk(units: DataFrame, shared_offset: int, own_offset: int) -> DataFrame:
    """Offices cover two units each; every fifth unit also has an office of its own."""
    n = F.col("n")
    shared = units.select((F.expr("n div 2") + shared_offset).cast("bigint").alias("office"), n)
    own = units.where(n % 5 == 0).select((n + own_offset).cast("bigint").alias("office"), n)
    return shared.unionByName(own).distinct()


def _windows(crosswalk: DataFrame, era: str = "n") -> DataFrame:
    n, office, year = F.col("n"), F.col("office"), F.col("year")
    shapes = F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in zip(("kind", "back", "from_month", "to_month"), s)])
        for s in WINDOW_SHAPES
    ])
    day = F.lit(1) + (office % 20).cast("int")
    shift = _shift(F.expr(era), SHIFT_DAYS)
    years = F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))).alias("year")
    return (
        crosswalk.select("office", "n", years)
        .select("office", "n", "year", F.inline(shapes))
        .select(
            unit_code(n).alias("fips"),
            unit_code(office).alias("fsa_county"),
            (year + _shift(F.expr(era), SHIFT_YEARS)).cast("int").alias("program_year"),
            F.concat(F.lit("P"), F.col("kind").cast("string")).alias("pasture_type"),
            F.date_add(F.make_date(year - F.col("back"), F.col("from_month"), day), shift)
            .alias("window_start"),
            F.date_add(F.make_date(year, F.col("to_month"), day), shift).alias("window_end"),
        )
    )


def _coded(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.select(unit_code("office").alias("fsa_county"), unit_code("n").alias("fips"))


def _nations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n"))


def _suppliers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("n"))


def nation_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(_crosswalk(_nations(spark, sf_dir), *NATION_OFFICES))


def nation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_crosswalk(_nations(spark, sf_dir), *NATION_OFFICES))


def nation_offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as the offices publish them: one per office, year and pasture type."""
    offices = _crosswalk(_nations(spark, sf_dir), *NATION_OFFICES).select("office").distinct()
    return _windows(offices.withColumn("n", F.col("office"))).drop("fips")


def nation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw classes, several per unit, source and week, some unknown."""
    lines = _lines(spark, sf_dir).join(
        table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n")),
        "s_suppkey",
    )
    return lines.select(
        unit_code("n").alias("fips"), F.col("flag").alias("source"),
        F.col("week").alias("usdm_date"), raw_class().alias("drought_class"),
    )


def raw_class() -> Column:
    return F.when(F.col("q") != 50, F.floor((F.col("q") - 1) / 9).cast("int"))


# Suppliers of one office share an era, so that their determinations can be compared.
SUPPLIER_ERA = "{0} div 2"


def supplier_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worst class per supplier, flag and week. Line items are combined under the number of their
    supplier; the code is made afterwards, once per cell.

    They are dealt by cell before: most cells hold a single line item, so that combining them where they are
    read only fills a table of as many cells as a piece of the file has rows.
    """
    n = F.col("n")
    raw = _lines(spark, sf_dir).select(
        F.col("s_suppkey").alias("n"), F.col("flag").alias("source"), "week",
        raw_class().alias("drought_class"),
    )
    cell = ["n", "source", "week"]
    raw = spread(raw, line_items(spark, sf_dir), *cell)
    cells = worst_class(raw, cell).where(F.col("drought_class").isNotNull())
    return cells.select(
        unit_code(n).alias("fips"), "source",
        F.date_add("week", _shift(F.expr(SUPPLIER_ERA.format("n")), SHIFT_DAYS)).alias("usdm_date"),
        "drought_class",
    )


# Suppliers with an office of their own share its code.
SUPPLIER_OFFICES = (10**12, 0)


def supplier_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(_crosswalk(_suppliers(spark, sf_dir), *SUPPLIER_OFFICES))


# Suppliers whose windows one task makes and writes: some 34 windows each.
SUPPLIERS_A_TASK = 2_000


def supplier_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once in pieces of equal size, however many suppliers there are, as several joins read them.

    Joined sort-merge: the file is a small part of its rows in memory, and the overlap join repeats them per
    time bin and source, so by the file's size Spark would collect and broadcast millions of them.
    """
    suppliers = _suppliers(spark, sf_dir)
    pieces = 1 + suppliers.count() // SUPPLIERS_A_TASK
    crosswalk = _crosswalk(suppliers, *SUPPLIER_OFFICES).repartition(pieces, "office", "n")
    return materialize(_windows(crosswalk, SUPPLIER_ERA.format("n"))).hint("merge")
