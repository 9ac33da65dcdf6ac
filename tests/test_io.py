"""Sources, sinks, the incremental build and the publication, on files."""

from __future__ import annotations

import csv
import glob
import gzip
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from dryspell import determine, ingest, publish, versions
from dryspell.__main__ import main
from dryspell.model import CROSSWALK_SCHEMA, GRAZING_SCHEMA, RAW_OBSERVATION_SCHEMA, ValidationError
from dryspell.operators import listings, units
from dryspell.operators.aggregate import long_from_wide
from dryspell.plans import bindings
from dryspell.plans.archive import live_files, rebuild
from dryspell.sinks import columnar
from dryspell.sinks.manifests import write_file_manifest, write_url_manifest
from dryspell.sinks.tables import write_combined, write_weeks
from dryspell.sources import listings as files
from dryspell.sources import manifests, tables
from dryspell.streaming.weekly_build import weekly_build_stream

from evaluator import tuesday

SOURCES = ["src-a", "src-b"]


def lines_of(folder):
    out = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part) as f:
            out += f.read().splitlines()
    return out


def weekly_file(spark, root, source, week, rows):
    path = f"{root}/{source}/USDM_{week}.parquet"
    data = [(s, c, week, k) for s, c, k in rows]
    spark.createDataFrame(data, RAW_OBSERVATION_SCHEMA).write.parquet(path)
    return path


@pytest.fixture
def archive(spark, tmp_path):
    """Three weeks from two sources; the third is missing from the second source."""
    root = str(tmp_path / "raw")
    listed = {s: [] for s in SOURCES}
    for i in range(3):
        for source in SOURCES:
            if (i, source) == (2, "src-b"):
                continue
            rows = [("01", "001", "D2"), ("01", "001", "D4" if i == 1 else "D0"),
                    ("01", "003", "None"), (None, "005", "D4"), ("01", "007", None),
                    ("01", "007", "D3")]
            listed[source].append(weekly_file(spark, root, source, tuesday(i), rows))
    paths = {}
    for source, urls in listed.items():
        paths[source] = str(tmp_path / f"{source}.txt")
        with open(paths[source], "w") as f:
            f.write("\n".join(["https://x/readme.txt", *urls]) + "\n")
    return paths, listed


def test_manifests(spark, archive):
    paths, listed = archive
    manifest = manifests.load_manifests(spark, paths)
    found = {(r.source, r.url, r.file) for r in manifest.collect()}
    assert found == {(s, u, os.path.basename(u)) for s, urls in listed.items() for u in urls}
    raw = manifests.raw_observations(manifests.read_manifest_files(manifest))
    assert raw.count() == 5 * 5
    assert {r.source for r in raw.select("source").distinct().collect()} == set(SOURCES)
    empty = manifests.read_manifest_files(manifest.where("false"))
    assert empty.columns == [*RAW_OBSERVATION_SCHEMA.fieldNames(), "source", "file"] and empty.isEmpty()


def scanned_files(df):
    """How many files the scan of the raw rows opened, read from the plan that ran."""
    df.collect()

    def scans(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(plan.plan())
        if name == "FileSourceScanExec":
            return [plan.metrics().apply("numFiles").value()]
        return [n for k in range(plan.children().size()) for n in scans(plan.children().apply(k))]

    return scans(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("spans", [2, 64])
def test_manifest_scan_opens_what_is_named(spark, tmp_path, monkeypatch, spans):
    """Nine plain files in two folders, two of them named: the others are never opened."""
    root = str(tmp_path / "raw folder")
    monkeypatch.setattr(manifests.url_spans, "__defaults__", (spans,))
    urls = []
    for i in range(9):
        folder = f"{root}/tmp/{i}"
        row = spark.createDataFrame([("01", "001", tuesday(i), "D2")], RAW_OBSERVATION_SCHEMA)
        row.coalesce(1).write.parquet(folder)
        os.makedirs(f"{root}/20{i % 2}+1", exist_ok=True)
        urls.append(f"{root}/20{i % 2}+1/USDM_{tuesday(i)}.parquet")
        os.rename(glob.glob(f"{folder}/part-*")[0], urls[-1])

    def listed(numbers):
        rows = [("a", f"file://{urls[i]}", os.path.basename(urls[i])) for i in numbers]
        return manifests.read_manifest_files(spark.createDataFrame(rows, "source string, url string, file string"))

    found = listed([2, 4, 6])
    assert sorted(r.usdm_date for r in found.collect()) == [tuesday(2), tuesday(4), tuesday(6)]
    assert scanned_files(found) == [3]
    assert listed(range(9)).count() == 9
    assert listed([1, 2, 3]).count() == 3


def test_incremental_build(spark, archive, tmp_path):
    paths, listed = archive
    weekly, ledger = str(tmp_path / "weekly"), str(tmp_path / "ledger")
    manifest = manifests.load_manifests(spark, paths)
    first = ingest(spark, manifest, SOURCES, weekly, ledger, required_sources=SOURCES)
    assert first.built.count() == 2 and first.skipped.count() == 1
    wide = tables.read_archive(spark, weekly, ledger, SOURCES)
    cells = {(r.fips, r.usdm_date): (r["src-a"], r["src-b"]) for r in wide.collect()}
    assert cells == {
        ("01001", tuesday(0)): (3, 3), ("01001", tuesday(1)): (5, 5),
        ("01003", tuesday(0)): (0, 0), ("01003", tuesday(1)): (0, 0),
        ("01007", tuesday(0)): (None, None), ("01007", tuesday(1)): (None, None),
    }
    assert long_from_wide(wide).count() == 8
    before = sorted(glob.glob(f"{weekly}/usdm_date={tuesday(0)}/*/*/*"))
    (waits,) = first.skipped.collect()
    assert (waits.missing_sources, waits.unposted) == (["src-b"], [])

    again = ingest(spark, manifest, SOURCES, weekly, ledger, required_sources=SOURCES)
    assert again.built.isEmpty() and again.skipped.count() == 1 and again.version == first.version

    # The literal gate only asks that what is listed is there.
    posted = manifest.select("url")
    third = ingest(spark, manifest, SOURCES, weekly, ledger, posted=posted)
    assert [r.file for r in third.built.collect()] == [f"USDM_{tuesday(2)}.parquet"]
    week = tables.read_archive(spark, weekly, ledger, SOURCES).where(F.col("usdm_date") == tuesday(2))
    assert {(r.fips, r["src-a"], r["src-b"]) for r in week.collect()} == {
        ("01001", 3, None), ("01003", 0, None), ("01007", None, None)
    }
    # Weeks built before are not touched.
    assert sorted(glob.glob(f"{weekly}/usdm_date={tuesday(0)}/*/*/*")) == before


def named(spark, rows):
    data = [(s, u, os.path.basename(u)) for s, u in rows]
    return spark.createDataFrame(data, "source string, url string, file string")


def cells(wide):
    return sorted((r.fips, r.usdm_date, r["src-a"], r["src-b"]) for r in wide.collect())


@pytest.fixture
def store(spark, tmp_path):
    weekly, state = str(tmp_path / "weekly"), str(tmp_path / "state")

    def build(rows, **options):
        return ingest(spark, named(spark, rows), SOURCES, weekly, state, **options)

    def read(at=None):
        return cells(tables.read_archive(spark, weekly, state, SOURCES, at))

    return build, read


def test_two_files_of_one_week_in_two_builds(spark, tmp_path, store):
    """Both survive; a unit that both hold becomes one row, unknown where one of them does not know."""
    build, read = store
    root, week = str(tmp_path / "raw"), tuesday(0)
    a = weekly_file(spark, root, "src-a", week, [("01", "001", "D2"), ("01", "005", "D1"), ("01", "007", None)])
    b = weekly_file(spark, root, "src-a/late", f"{week}_more", []).replace(f"{week}_more", str(week))
    spark.createDataFrame(
        [("01", "003", week, "D4"), ("01", "005", week, "D3"), ("01", "007", week, "D0")], RAW_OBSERVATION_SCHEMA
    ).write.parquet(f"{root}/second/USDM_{week}b.parquet")
    b = f"{root}/second/USDM_{week}b.parquet"
    build([("src-a", a)])
    one = build([("src-a", a), ("src-a", b)])
    assert [r.file for r in one.built.collect()] == [os.path.basename(b)] and one.version.number == 2
    assert read() == [("01001", week, 3, None), ("01003", week, 5, None), ("01005", week, 4, None),
                      ("01007", week, None, None)]


def test_source_that_lists_a_built_file_later(spark, archive, store):
    _, listed = archive
    build, read = store
    (a, b), week = (listed["src-a"][0], listed["src-b"][0]), tuesday(0)
    first = build([("src-a", a)])
    assert read() == [("01001", week, 3, None), ("01003", week, 0, None), ("01007", week, None, None)]
    second = build([("src-b", b)])
    assert read() == [("01001", week, 3, 3), ("01003", week, 0, 0), ("01007", week, None, None)]
    assert build([("src-a", a), ("src-b", b)]).built.isEmpty()
    # The version before is still whole.
    assert read(first.version) == [("01001", week, 3, None), ("01003", week, 0, None), ("01007", week, None, None)]
    assert second.version.number == 2


def test_build_that_dies_before_the_commit(spark, archive, store, monkeypatch):
    """Rows are written, the version is not: nothing changed, and the next build is whole."""
    _, listed = archive
    build, read = store
    every = [(s, u) for s, urls in listed.items() for u in urls]
    build(every[:1])
    before = read()

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("dryspell.plans.ingest.commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            build(every)
    assert read() == before
    # Between the manifest and the log row the same holds.
    with monkeypatch.context() as broken:
        broken.setattr("dryspell.versions.Version", die)
        with pytest.raises(RuntimeError, match="lost"):
            build(every)
    assert read() == before
    assert build(every).version.number == 2 and len(read()) == 9


def test_concurrent_builds_of_one_version(spark, tmp_path):
    root, rows = str(tmp_path), spark.createDataFrame([("x",)], "file string")
    one = versions.commit(rows, root, versions.NOTHING)
    lost = 0
    try:
        versions.commit(rows, root, versions.NOTHING)
    except versions.ConcurrentBuild:
        lost = 1
    newest = versions.newest(spark, root)
    assert newest.number == 1 and (newest == one) == bool(lost)
    with pytest.raises(LookupError):
        versions.version(spark, root, 2)


def test_file_whose_rows_all_fall_away(spark, tmp_path, store):
    build, read = store
    url = weekly_file(spark, str(tmp_path / "raw"), "src-a", tuesday(0), [(None, "001", "D2")])
    assert build([("src-a", url)]).built.count() == 1
    assert build([("src-a", url)]).built.isEmpty() and read() == []


def test_unposted_files_are_skipped(spark, archive, store):
    """A file is skipped when one of its URLs is not there, and says which; the rest is built."""
    _, listed = archive
    build, read = store
    there = [u for urls in listed.values() for u in urls]
    gone = listed["src-a"][0].replace("src-a", "src-b-not-there")
    rows = [("src-a", listed["src-a"][0]), ("src-b", gone), ("src-a", listed["src-a"][1]), ("src-b", listed["src-b"][1])]
    posted = spark.createDataFrame([(f"file://{u}",) for u in there], "url string")
    found = build(rows, posted=posted)
    assert [r.file for r in found.built.collect()] == [os.path.basename(listed["src-a"][1])]
    (skipped,) = found.skipped.collect()
    assert skipped.file == os.path.basename(gone) and [os.path.basename(os.path.dirname(u)) for u in skipped.unposted] == ["src-b-not-there"]
    assert {d for _, d, _, _ in read()} == {tuesday(1)}
    listing = files.posted_files(spark, [os.path.dirname(os.path.dirname(listed["src-a"][0]))])
    assert {u for u in there} <= {r.url for r in listing.collect()}
    assert build(rows, posted=listing).built.isEmpty()


def test_posted_keys_of_a_saved_listing(spark, archive, tmp_path, store):
    """A store's listing, as URLs, gates the build: what the store does not list is skipped."""
    _, listed = archive
    build, read = store
    root = os.path.dirname(os.path.dirname(listed["src-a"][0]))
    keys = [{"Key": u.removeprefix(f"{root}/"), "Size": 1} for u in listed["src-a"][:2]]
    (tmp_path / "s3").mkdir()
    (tmp_path / "s3" / "1.json").write_text(json.dumps({"Contents": keys}))
    posted = files.posted_keys(files.object_listing(spark, str(tmp_path / "s3")), f"file://{root}/")
    found = build([("src-a", u) for u in listed["src-a"]], posted=posted)
    assert found.built.count() == 2 and [len(r.unposted) for r in found.skipped.collect()] == [1]
    assert {week for _, week, _, _ in read()} == {tuesday(0), tuesday(1)}


def test_superseded_pieces_are_not_listed(spark, archive, store, tmp_path):
    """Files of pieces that a later build replaced stay on disk for older versions and leave the inventory."""
    _, listed = archive
    build, _ = store
    build([("src-a", listed["src-a"][0])])
    second = build([("src-b", listed["src-b"][0])])
    every = files.file_inventory(spark, str(tmp_path / "weekly")).withColumn("path", F.concat(F.lit("weekly/"), "path"))
    pieces = versions.entries(spark, str(tmp_path / "state"), second.version, tables.PIECE_SCHEMA)
    live = [r.path for r in live_files(every, pieces).collect() if "/part-" in r.path]
    assert every.where("path like '%/part-%'").count() > len(live) > 0
    assert {p.split("build=")[1].split("/")[0] for p in live} == {pieces.first().build}


def test_many_files_that_are_not_there(spark, archive, monkeypatch):
    paths, listed = archive
    monkeypatch.setattr(manifests.url_spans, "__defaults__", (1,))
    gone = named(spark, [("src-a", u) for u in [*listed["src-a"], listed["src-a"][0].replace("USDM", "x_USDM")]])
    with pytest.raises(ValidationError, match="not there"):
        manifests.read_manifest_files(gone)


def test_manifest_that_lists_a_file_twice(spark, archive, tmp_path):
    manifest = manifests.load_manifests(spark, archive[0])
    with pytest.raises(ValidationError, match="weekly manifest"):
        ingest(spark, manifest.unionByName(manifest), SOURCES, "w", "l")


def test_stream_builds_what_arrives(spark, archive, tmp_path):
    _, listed = archive
    inbox, weekly = tmp_path / "inbox", str(tmp_path / "weekly")
    state, progress = str(tmp_path / "state"), str(tmp_path / "progress")
    inbox.mkdir()
    read = []

    def arrive(name, rows, **gate):
        (inbox / name).write_text("".join(f"{','.join(r)}\n" for r in rows))
        query = weekly_build_stream(spark, str(inbox), SOURCES, weekly, state, progress, **gate)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        found = tables.read_archive(spark, weekly, state, SOURCES)
        return {r.usdm_date for r in found.select("usdm_date").distinct().collect()}

    a, b = listed["src-a"], listed["src-b"]
    both = {"required_sources": SOURCES}
    assert arrive("1.csv", [("src-a", a[0]), ("src-a", a[1])], **both) == set()
    assert arrive("2.csv", [("src-b", b[0])], **both) == {tuesday(0)}
    # Lines of built files say nothing new; a batch reads its own lines only.
    assert arrive("3.csv", [("src-b", b[1]), ("src-a", a[2]), ("src-a", a[0])], **both) == {tuesday(0), tuesday(1)}
    assert read == [2, 1, 3] and versions.newest(spark, state).number == 2


def test_stream_waits_for_posted_files_and_takes_late_sources(spark, archive, tmp_path):
    """A file that three batches complete is built once, after a restart each; a late source adds its rows."""
    _, listed = archive
    inbox, weekly = tmp_path / "inbox", str(tmp_path / "weekly")
    state, progress = str(tmp_path / "state"), str(tmp_path / "progress")
    inbox.mkdir()
    a, b = listed["src-a"][0], listed["src-b"][0]

    def arrive(name, *rows):
        (inbox / name).write_text("".join(f"{','.join(r)}\n" for r in rows))
        weekly_build_stream(
            spark, str(inbox), SOURCES, weekly, state, progress, ["src-a"], gate_posted=True
        ).awaitTermination()
        return versions.newest(spark, state).number, cells(tables.read_archive(spark, weekly, state, SOURCES))

    week = tuesday(0)
    alone = [("01001", week, 3, None), ("01003", week, 0, None), ("01007", week, None, None)]
    assert arrive("1.csv", ("src-a", a, "listed")) == (0, [])
    assert arrive("2.csv", ("", b, "posted")) == (0, [])
    assert arrive("3.csv", ("", a, "posted")) == (1, alone)
    assert arrive("4.csv", ("", a, "posted"), ("src-a", a, "listed")) == (1, alone)
    assert arrive("5.csv", ("src-b", b, "listed")) == (
        2, [("01001", week, 3, 3), ("01003", week, 0, 0), ("01007", week, None, None)]
    )


def test_weekly_files(spark, tmp_path):
    data = [(f"{u:05d}", tuesday(i), (u + i) % 6, None) for u in range(40) for i in range(5)]
    wide = spark.createDataFrame(data, "fips string, usdm_date date, a int, b int")
    write_weeks(wide, str(tmp_path / "w"))
    assert len(glob.glob(f"{tmp_path}/w/usdm_date=*")) == 5
    back = tables.read_weekly(spark, str(tmp_path / "w"), ["a", "b"])
    assert sorted(back.select(*wide.columns).collect(), key=str) == sorted(wide.collect(), key=str)
    write_combined(back, str(tmp_path / "all"))
    combined = spark.read.parquet(str(tmp_path / "all"))
    assert combined.count() == 200
    part = sorted(glob.glob(f"{tmp_path}/all/part-*"))[0]
    assert ".zstd." in part
    firsts = [tuple(r) for r in spark.read.parquet(part).select("fips", "usdm_date").collect()]
    assert firsts == sorted(firsts)


def test_input_tables(spark, tmp_path):
    pairs = [("01001", "01001"), ("01001", "01003"), ("01001", "01001")]
    extra = spark.createDataFrame(pairs, CROSSWALK_SCHEMA).withColumn("name", F.lit("x"))
    extra.write.parquet(str(tmp_path / "x"))
    crosswalk = tables.read_crosswalk(spark, str(tmp_path / "x"))
    assert crosswalk.count() == 2
    grazing = [(2024, "01", "001", "p", date(2023, 11, 1), date(2024, 4, 1))]
    spark.createDataFrame(grazing, GRAZING_SCHEMA).write.parquet(str(tmp_path / "g"))
    windows = tables.read_windows(spark, str(tmp_path / "g"))
    mapped = units.map_units(windows, crosswalk)
    assert sorted((r.fips, r.fsa_county, r.program_year) for r in mapped.collect()) == [
        ("01001", "01001", 2024), ("01003", "01001", 2024)
    ]


@pytest.fixture(scope="module")
def published(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    windows = bindings.nation_windows(spark, sf_dir)
    eligibility = determine(bindings.nation_observations(spark, sf_dir), windows)
    return out, publish(eligibility, windows, out)


def test_published_tables(spark, published):
    out, result = published
    rows = sorted(tuple(r) for r in result.collect())
    for reader, kind in ((tables.read_result_csv, "csv"), (tables.read_result_parquet, "parquet")):
        back = reader(spark, f"{out}/eligibility_{kind}")
        assert back.columns == result.columns
        assert sorted(tuple(r) for r in back.collect()) == rows
    header = next(csv.reader([lines_of(f"{out}/eligibility_csv")[0]]))
    assert header[:2] == ["FIPS", "FSA County"] and header[-1] == "Drought Factor"


def test_published_document(published):
    out, result = published
    document = json.loads("\n".join(lines_of(f"{out}/eligibility_json")))
    assert list(document) == [
        "schema", "dataset", "license", "year0", "years", "types", "counties", "fips_codes",
        "events", "sources", "n", "type", "county", "fips", "year", "event", "qy", "qo", "df",
        "source",
    ]
    assert document["n"] == result.count() == len(document["type"])
    order = list(zip(*[document[f] for f in columnar.RECORD_ORDER]))
    assert order == sorted(order)
    for name in ("types", "counties", "fips_codes", "events", "sources"):
        assert document[name] == sorted(set(document[name]))
    decoded = set()
    for i in range(document["n"]):
        year = document["year0"] + document["year"][i]
        day = date.fromordinal(
            date(year + document["qo"][i], 1, 1).toordinal() + document["qy"][i] - 1
        )
        decoded.add((
            document["fips_codes"][document["fips"][i]],
            document["counties"][document["county"][i]],
            document["sources"][document["source"][i]], year,
            document["types"][document["type"][i]], document["events"][document["event"][i]], day,
            document["df"][i],
        ))
    assert decoded == {tuple(r) for r in result.collect()}


def test_published_shards(spark, published):
    """Each year's files are one gzip stream of one JSON document; together they hold the whole document."""
    out, result = published
    document = json.loads("\n".join(lines_of(f"{out}/eligibility_json")))
    index = [json.loads(x) for x in lines_of(f"{out}/eligibility_shards/index")]
    records, seen = [], 0
    for entry in index:
        parts = sorted(glob.glob(f"{out}/eligibility_shards/{entry['shard']}/part-*"))
        shard = json.loads(gzip.decompress(b"".join(open(p, "rb").read() for p in parts)))
        assert (shard["program_year"], shard["n"], entry["offset"]) == (entry["program_year"], entry["count"], seen)
        rows = list(zip(*[shard[f] for f in columnar.RECORD_ORDER]))
        assert len(rows) == shard["n"] and rows == sorted(rows)
        assert set(shard["year"]) == {shard["program_year"] - document["year0"]}
        records += rows
        seen += entry["count"]
    assert sorted(records) == list(zip(*[document[f] for f in columnar.RECORD_ORDER]))
    entries = [json.loads(x) for x in lines_of(f"{out}/eligibility_shards/dictionary")]
    for field, _ in columnar.DICTIONARY_FIELDS:
        assert [e["value"] for e in entries if e["field"] == field] == document[field]
    year = index[1]["program_year"]
    one = columnar.read_shards(spark, f"{out}/eligibility_shards", year)
    assert one.count() == index[1]["count"] == result.where(F.col("program_year") == year).count()
    assert columnar.read_shards(spark, f"{out}/eligibility_shards").count() == seen == result.count()


def test_published_report(published):
    out, result = published
    text = lines_of(f"{out}/report")
    assert text[0] == "Eligibility report"
    assert f"Records: {result.count()}" in text
    assert text.index("Offices covering several units") < text.index(
        "Units split over several offices"
    )


def test_an_empty_result_is_published(spark, tmp_path):
    observations = spark.createDataFrame(
        [], "fips string, source string, usdm_date date, drought_class int"
    )
    windows = spark.createDataFrame([], (
        "fips string, fsa_county string, program_year int, pasture_type string, "
        "window_start date, window_end date"
    ))
    publish(determine(observations, windows), windows, str(tmp_path / "out"))
    document = json.loads("\n".join(lines_of(tmp_path / "out" / "eligibility_json")))
    assert document["n"] == 0 and document["year0"] is None and document["types"] == []
    assert "Records: 0" in lines_of(tmp_path / "out" / "report")


def test_nothing_is_published_when_an_invariant_fails(spark, published, tmp_path):
    _, result = published
    early = result.withColumn("program_year", F.col("program_year") - 12)
    windows = spark.createDataFrame([], (
        "fips string, fsa_county string, program_year int, pasture_type string, "
        "window_start date, window_end date"
    ))
    with pytest.raises(ValidationError, match="no rung"):
        publish(early, windows, str(tmp_path / "bad"))
    assert not os.path.exists(tmp_path / "bad")


def test_inventory_and_manifests(spark, tmp_path):
    root = tmp_path / "data"
    (root / "sub dir").mkdir(parents=True)
    (root / "b.txt").write_text("12345")
    (root / "sub dir" / "a#1.txt").write_text("1")
    (root / ".hidden").write_text("x")
    inventory = files.file_inventory(spark, str(root))
    assert [(r.path, r.size) for r in inventory.collect()] == [("b.txt", 5), ("sub dir/a#1.txt", 1)]
    write_file_manifest(inventory, str(tmp_path / "m"))
    entries = [json.loads(x) for x in lines_of(tmp_path / "m")]
    assert [e["path"] for e in entries] == ["b.txt", "sub dir/a#1.txt"]
    assert set(entries[0]) == {"path", "size", "mtime"}

    listing = files.inventory_listing(inventory, "pre")
    (tmp_path / "s3").mkdir()
    (tmp_path / "s3" / "1.json").write_text(json.dumps(
        {"Contents": [{"Key": "pre/b.txt", "Size": 5}, {"Key": "pre/_cache/z", "Size": 1}]}, indent=1
    ))
    (tmp_path / "s3" / "2.json").write_text(json.dumps({"RequestCharged": None}))
    remote = files.object_listing(spark, str(tmp_path / "s3"))
    problems = {(r.key, r.problem) for r in listings.reconcile(listing, remote).collect()}
    assert problems == {("pre/sub dir/a#1.txt", "missing"), ("pre/_cache/z", "unexpected")}
    with pytest.raises(ValidationError, match="2 row.*listing differences"):
        listings.verify(listing, remote)
    listings.verify(listing, listing)

    write_url_manifest(listing.unionByName(remote), "https://x.example/", str(tmp_path / "u"), "pre")
    assert lines_of(tmp_path / "u") == [
        "https://x.example/pre/b.txt", "https://x.example/pre/b.txt",
        "https://x.example/pre/sub%20dir/a%231.txt",
    ]


def test_archive_from_files(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "out")
    paths = {}
    for source in SOURCES:
        urls = [
            weekly_file(spark, root, source, tuesday(i), [("01", "001", "D2"), ("01", "001", "D0"),
                                                         ("01", "003", "D3"), ("01", "009", "D4")])
            for i in range(9)
        ]
        paths[source] = str(tmp_path / f"{source}.txt")
        with open(paths[source], "w") as f:
            f.write("\n".join(urls))
    pairs = [("01001", "01001"), ("01001", "01003")]
    spark.createDataFrame(pairs, CROSSWALK_SCHEMA).write.parquet(str(tmp_path / "x"))
    grazing = [(2024, "01", "001", "p", date(2024, 1, 9), date(2024, 12, 1))]
    spark.createDataFrame(grazing, GRAZING_SCHEMA).write.parquet(str(tmp_path / "g"))
    # A week that only one source lists, and one that is listed but not there, are skipped and reported.
    with open(paths["src-a"], "a") as f:
        f.write(f"\n{weekly_file(spark, root, 'src-a', tuesday(9), [('01', '001', 'D4')])}\n")
    for source in SOURCES:
        with open(paths[source], "a") as f:
            f.write(f"\n{root}/{source}/USDM_2030-01-01.parquet\n")
    result, build = rebuild(spark, paths, str(tmp_path / "x"), str(tmp_path / "g"), out,
                            "https://x.example", "pre")
    waits = {r.file: (r.missing_sources, len(r.unposted)) for r in build.skipped.collect()}
    assert waits == {f"USDM_{tuesday(9)}.parquet": (["src-b"], 0), "USDM_2030-01-01.parquet": ([], 2)}
    assert build.built.count() == 9
    report = lines_of(f"{out}/result/report")
    assert "Weekly files skipped" in report and f"  USDM_{tuesday(9)}.parquet,src-b," in "\n".join(report)
    expected = {
        (fips, "01001", source, 2024, "p", event, day, factor)
        for source in SOURCES
        for fips, event, day, factor in [
            ("01001", "D2", date(2024, 3, 4), 1), ("01003", "D3a", date(2024, 1, 9), 3),
            ("01003", "D3b", date(2024, 2, 5), 4),
        ]
    }
    assert {tuple(r) for r in result.collect()} == expected
    assert json.loads("\n".join(lines_of(f"{out}/result/eligibility_json")))["n"] == 6
    listed = lines_of(f"{out}/url_manifest")
    assert len(listed) == 9
    # A second run from the command line finds nothing to build and publishes the same result.
    main([
        *[f"--manifest={s}={p}" for s, p in paths.items()], f"--crosswalk={tmp_path / 'x'}",
        f"--windows={tmp_path / 'g'}", f"--out={out}", "--base-url=https://x.example",
        "--prefix=pre", "--salts=2",
    ])
    back = tables.read_result_parquet(spark, f"{out}/result/eligibility_parquet")
    assert {tuple(r) for r in back.collect()} == expected
    assert lines_of(f"{out}/url_manifest") == listed
    assert listed[0].startswith("https://x.example/pre/data/weekly/usdm_date=2024-01-02/file=USDM_2024-01-02.parquet/build=")
