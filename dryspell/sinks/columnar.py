"""The column-oriented, dictionary-coded JSON document.

The document is built as a sorted table of text lines and written with ``write.text``. Its part files
in name order are one valid JSON document, and no task ever holds more than its own lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dryspell.functions.dates import date_code, date_decode
from dryspell.lineage import materialize
from dryspell.operators.dictionary import encode, sorted_dictionary
from dryspell.operators.quality import assert_empty, value_mismatch

# Dictionary of each coded column.
DIMS = {
    "type": "pasture_type",
    "county": "fsa_county",
    "fips": "fips",
    "event": "event",
    "source": "source",
}

# Document fields in their frozen order.
DICTIONARY_FIELDS = (
    ("types", "type"), ("counties", "county"), ("fips_codes", "fips"), ("events", "event"),
    ("sources", "source"),
)
RECORD_FIELDS = ("type", "county", "fips", "year", "event", "qy", "qo", "df", "source")

# Total order of the records.
RECORD_ORDER = ("type", "county", "fips", "year", "event", "qy", "qo", "df", "source")

CELL = ("type", "county", "fips", "year")
SCHEMA_NAME = "eligibility-columns/1"


def first_year(eligibility: DataFrame) -> Column:
    return eligibility.agg(F.min("program_year")).scalar()


def record_dictionary(eligibility: DataFrame) -> DataFrame:
    return materialize(sorted_dictionary(eligibility, DIMS))


def record_codes(eligibility: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Integer-coded records, with ``qualifying_date`` and ``program_year`` kept beside the codes."""
    qy, qo = date_code("qualifying_date", "program_year")
    year = F.col("program_year") - first_year(eligibility)
    named = eligibility.select(
        *[F.col(c).alias(f"_in_{d}") for d, c in DIMS.items()],
        "program_year", "qualifying_date", year.alias("year"), qy.alias("qy"), qo.alias("qo"),
        F.col("drought_factor").alias("df"),
    )
    coded = encode(named, dictionary, {d: f"_in_{d}" for d in DIMS})
    return coded.select(*RECORD_FIELDS, "program_year", "qualifying_date")


def round_trip_failures(codes: DataFrame) -> DataFrame:
    """Records whose date the codes do not give back exactly."""
    back = codes.withColumn("decoded", date_decode("qy", "qo", "program_year"))
    return value_mismatch(back, "qualifying_date", "decoded")


def record_cells(codes: DataFrame) -> DataFrame:
    """Records gathered per (type, county, fips, year) in record order. An escalating window holds one
    record per factor and source, so a cell is small whatever the size of the table."""
    rest = [c for c in RECORD_ORDER if c not in CELL]
    return codes.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("records"))


def _joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def cell_text(field: str) -> Column:
    """The values of one field in a cell, separated by commas."""
    if field in CELL:
        return _joined(F.transform("records", lambda _: F.col(field)))
    return _joined(F.col(f"records.{field}"))


def _json_string(value: Column) -> Column:
    text = F.to_json(F.array(value))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _line(part: int, text: Column, keys: list[Column]) -> list[Column]:
    keys = keys + [F.lit(0)] * (len(CELL) - len(keys))
    return [F.lit(part).alias("part"),
            *[k.cast("int").alias(f"k{i}") for i, k in enumerate(keys)], text.alias("text")]


def document_lines(
    eligibility: DataFrame,
    dictionary: DataFrame,
    cells: DataFrame,
    schema: str = SCHEMA_NAME,
    dataset: str = "eligibility",
    license_name: str = "CC0-1.0",
) -> DataFrame:
    """``part, k0..k3, text``: sorted by all but the text, the texts are the document. All three
    inputs are materialized."""
    totals = eligibility.agg(
        F.min("program_year").alias("lo"), F.max("program_year").alias("hi"),
        F.count(F.lit(1)).alias("n"),
    )
    head = F.to_json(F.struct(
        F.lit(schema).alias("schema"), F.lit(dataset).alias("dataset"),
        F.lit(license_name).alias("license"), F.col("lo").alias("year0"),
        F.array("lo", "hi").alias("years"),
    ), {"ignoreNullFields": "false"})
    head = F.substring(head, F.lit(1), F.length(head) - 1)
    parts = [totals.select(*_line(0, head, []))]

    def framed(part: int, field: str) -> list[DataFrame]:
        return [
            totals.select(*_line(part - 1, F.lit(f',"{field}":['), [])),
            totals.select(*_line(part + 1, F.lit("]"), [])),
        ]

    part = 2
    for field, dim in DICTIONARY_FIELDS:
        comma = F.when(F.col("code") > 0, F.lit(",")).otherwise(F.lit(""))
        entry = F.concat(comma, _json_string(F.col("value")))
        entries = dictionary.where(F.col("dim") == dim)
        parts += [*framed(part, field), entries.select(*_line(part, entry, [F.col("code")]))]
        part += 3
    parts.append(totals.select(*_line(part, F.concat(F.lit(',"n":'), F.col("n").cast("string")), [])))
    part += 2
    first_cell = cells.agg(F.min(F.struct(*CELL))).scalar()
    lead = F.when(F.struct(*CELL) == first_cell, F.lit("")).otherwise(F.lit(","))
    fields = []
    for field in RECORD_FIELDS:
        parts += framed(part, field)
        fields.append(F.struct(F.lit(part).alias("part"), cell_text(field).alias("body")))
        part += 3
    bodies = cells.select(*CELL, lead.alias("lead"), F.inline(F.array(*fields)))
    parts.append(bodies.select(
        "part", *[F.col(c).cast("int").alias(f"k{i}") for i, c in enumerate(CELL)],
        F.concat("lead", "body").alias("text"),
    ))
    parts.append(totals.select(*_line(part, F.lit("}"), [])))
    return reduce(DataFrame.unionByName, parts)


def write_document(eligibility: DataFrame, path: str, **header) -> None:
    """Check that the codes lose nothing, then write the document. ``eligibility`` is materialized."""
    dictionary = record_dictionary(eligibility)
    codes = record_codes(eligibility, dictionary)
    assert_empty(round_trip_failures(codes), "dates lost by the date codes")
    lines = document_lines(eligibility, dictionary, materialize(record_cells(codes)), **header)
    keys = [f"k{i}" for i in range(len(CELL))]
    lines.orderBy("part", *keys).select("text").write.mode("overwrite").text(path)


#: A shard holds its records under these names, in the order of the document.
SHARD_KEYS = ("part", *[f"k{i}" for i in range(len(CELL))])


def shard_counts(codes: DataFrame) -> DataFrame:
    """``program_year, year, n, offset``: the records of each year, and those of earlier years. One row a year."""
    counts = codes.groupBy("program_year", "year").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("program_year").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))


def shard_lines(cells: DataFrame, counts: DataFrame) -> DataFrame:
    """``program_year, part, k0..k3, text``: sorted by all but the text, the texts of a year are one JSON
    document with its records. Both inputs are materialized."""
    firsts = cells.groupBy("year").agg(F.min(F.struct(*CELL)).alias("first"))
    known = counts.select("program_year", "year", "n")
    head = F.concat(F.lit('{"program_year":'), F.col("program_year").cast("string"), F.lit(',"n":'), F.col("n").cast("string"))
    parts, part, fields = [known.select("program_year", *_line(0, head, []))], 2, []
    for field in RECORD_FIELDS:
        parts.append(known.select("program_year", *_line(part - 1, F.lit(f',"{field}":['), [])))
        parts.append(known.select("program_year", *_line(part + 1, F.lit("]"), [])))
        fields.append(F.struct(F.lit(part).alias("part"), cell_text(field).alias("body")))
        part += 3
    parts.append(known.select("program_year", *_line(part, F.lit("}"), [])))
    lead = F.when(F.struct(*CELL) == F.col("first"), F.lit("")).otherwise(F.lit(","))
    bodies = cells.join(firsts, "year").join(known.select("program_year", "year"), "year")
    bodies = bodies.select("program_year", *CELL, lead.alias("lead"), F.inline(F.array(*fields)))
    parts.append(bodies.select(
        "program_year", "part", *[F.col(c).cast("int").alias(f"k{i}") for i, c in enumerate(CELL)],
        F.concat("lead", "body").alias("text"),
    ))
    return reduce(DataFrame.unionByName, parts)


def write_shards(eligibility: DataFrame, path: str) -> None:
    """The document in a compressed shard for each program year, each readable alone.

    ``dictionary`` holds the values of all codes once, ``index`` a line for each year with its folder, the
    number of its records and of those in earlier years. The part files of a year, in name order, are one gzip
    stream with one JSON document. ``eligibility`` is materialized.
    """
    dictionary = record_dictionary(eligibility)
    codes = record_codes(eligibility, dictionary)
    assert_empty(round_trip_failures(codes), "dates lost by the date codes")
    cells = materialize(record_cells(codes))
    counts = materialize(shard_counts(codes))
    lines = shard_lines(cells, counts).repartitionByRange("program_year", *SHARD_KEYS)
    lines.sortWithinPartitions("program_year", *SHARD_KEYS).select("program_year", "text").write.mode(
        "overwrite"
    ).option("compression", "gzip").partitionBy("program_year").text(f"{path}/shards")
    folder = F.concat(F.lit("shards/program_year="), F.col("program_year").cast("string")).alias("shard")
    index = counts.select("program_year", folder, "offset", F.col("n").alias("count"))
    index.orderBy("program_year").write.mode("overwrite").json(f"{path}/index")
    names = {dim: field for field, dim in DICTIONARY_FIELDS}
    field = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("dim")]
    dictionary.select(field.alias("field"), "code", "value").orderBy("field", "code").write.mode(
        "overwrite"
    ).json(f"{path}/dictionary")


def read_shards(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """The records of the shards as ``program_year`` and codes; of one year, only its shard is read."""
    arrays = ", ".join(f"{f} array<int>" for f in RECORD_FIELDS if f != "year")
    texts = spark.read.schema("text string, program_year int").text(f"{path}/shards", wholetext=True)
    if year is not None:
        texts = texts.where(F.col("program_year") == year)
    # The files of a year are pieces of one document; a year has a few of them.
    name = F.col("_metadata.file_path")
    whole = texts.withColumn("name", name).groupBy("program_year").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "text"))), lambda x: x["text"]), "").alias("text")
    )
    fields = [f for f in RECORD_FIELDS if f != "year"]
    parsed = whole.select("program_year", F.from_json("text", arrays).alias("r"))
    return parsed.select("program_year", F.inline(F.arrays_zip(*[F.col(f"r.{f}").alias(f) for f in fields])))
