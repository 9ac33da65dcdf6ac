"""Column names, schemas and the fixed rules of the eligibility program."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# Drought classes in rising order. The position in this tuple is the class ordinal.
CLASS_LEVELS = ("None", "D0", "D1", "D2", "D3", "D4")
BELOW_D2, D2, D3, D4 = 0, 3, 4, 5

WEEK_DAYS = 7

SERIES_KEY = ("fips", "source")
WINDOW_KEY = ("fips", "fsa_county", "program_year", "pasture_type")
GROUP_KEY = ("fips", "fsa_county", "source", "program_year", "pasture_type")

RESULT_COLUMNS = (*GROUP_KEY, "event", "qualifying_date", "drought_factor")

# Column headings of the published tables.
PUBLISHED_NAMES = {
    "fips": "FIPS",
    "fsa_county": "FSA County",
    "source": "source",
    "program_year": "Program Year",
    "pasture_type": "Pasture Type",
    "event": "Qualifying Drought Event",
    "qualifying_date": "Qualifying Date",
    "drought_factor": "Drought Factor",
}

RAW_OBSERVATION_SCHEMA = T.StructType([
    T.StructField("STATEFP", T.StringType()),
    T.StructField("COUNTYFP", T.StringType()),
    T.StructField("usdm_date", T.DateType()),
    T.StructField("usdm_class", T.StringType()),
])

CROSSWALK_SCHEMA = T.StructType([
    T.StructField("FSA_STCOU", T.StringType()),
    T.StructField("FIPS_C", T.StringType()),
])

GRAZING_SCHEMA = T.StructType([
    T.StructField("Program Year", T.IntegerType()),
    T.StructField("State FSA Code", T.StringType()),
    T.StructField("County FSA Code", T.StringType()),
    T.StructField("Pasture Type", T.StringType()),
    T.StructField("Grazing Period Start Date", T.DateType()),
    T.StructField("Grazing Period End Date", T.DateType()),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("FIPS", T.StringType()),
    T.StructField("FSA County", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("Program Year", T.IntegerType()),
    T.StructField("Pasture Type", T.StringType()),
    T.StructField("Qualifying Drought Event", T.StringType()),
    T.StructField("Qualifying Date", T.DateType()),
    T.StructField("Drought Factor", T.IntegerType()),
])


class Rung(NamedTuple):
    """Monthly payments an event earns in a span of program years; ``None`` leaves the span open."""

    event: str
    first_year: int
    last_year: int | None
    factor: int


# The payment ladder of each era. Events and years not listed earn nothing.
LADDER = (
    Rung("D2", 2008, 2011, 1),
    Rung("D3a", 2008, 2011, 2),
    Rung("D3b", 2008, 2011, 3),
    Rung("D4a", 2008, 2011, 3),
    Rung("D4b", 2008, 2011, 3),
    Rung("D2", 2012, 2025, 1),
    Rung("D3a", 2012, 2025, 3),
    Rung("D3b", 2012, 2025, 4),
    Rung("D4a", 2012, 2025, 4),
    Rung("D4b", 2012, 2025, 5),
    Rung("D2a_2026", 2026, None, 1),
    Rung("D2b_2026", 2026, None, 2),
    Rung("D3a", 2026, None, 3),
    Rung("D3b", 2026, None, 4),
    Rung("D4a", 2026, None, 4),
    Rung("D4b", 2026, None, 5),
)

# Fixed values: (last program year of the era, factors its ladder can award).
ERA_FACTORS = (
    (2011, (1, 2, 3)),
    (2025, (1, 3, 4, 5)),
    (None, (1, 2, 3, 4, 5)),
)


class ValidationError(ValueError):
    """An invariant was violated; the message holds the count and a sample."""
