"""Compressed landing files, and what landing writes besides the rows that it keeps."""

from __future__ import annotations

import gzip
import os
from pathlib import Path

import pytest
from conftest import FLIGHT
from pyspark.sql import functions as F

from faremill import queries
from faremill.operators.runs import route_files
from faremill.plans import pipeline
from faremill.schemas import BUSINESS_COLUMNS
from faremill.sources import claims, landing, tables
from faremill.sources.tables import Warehouse
from faremill.storage import scratch_path

HEADER = ",".join(BUSINESS_COLUMNS)


def line(**changes):
    return ",".join((FLIGHT | changes)[name] for name in BUSINESS_COLUMNS)


def write(path, *lines, age=0):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = ("\n".join(lines) + "\n").encode()
    path.write_bytes(gzip.compress(text) if path.suffix == ".gz" else text)
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


@pytest.fixture
def root(tmp_path):
    return tmp_path / "raw"


@pytest.fixture
def warehouse(spark):
    house = Warehouse(scratch_path(spark, "wh"), prefix=f"t{os.urandom(4).hex()}_")
    tables.create_all(spark, house)
    return house


def outcomes(spark, warehouse):
    return {r.target_name: r for r in tables.read_table(spark, warehouse, "ops.ingest_files").collect()}


def size(folder):
    return sum(p.stat().st_size for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file())


@pytest.fixture
def many_rows(monkeypatch):
    """2,000 rows that take some 90 bytes each as text."""

    def rows(spark, folder, columns=BUSINESS_COLUMNS, dirty=False):
        named = {name: F.lit(FLIGHT[name]) for name in BUSINESS_COLUMNS}
        named["Additional_Info"] = F.when(F.col("id") % 4 == 0, "A").otherwise("N")
        return spark.range(0, 2000, 1, 2).select(*[named[name].alias(name) for name in columns])

    monkeypatch.setattr(queries, "raw_flights", rows)
    return 2000 * len(line(Additional_Info="N"))


def test_f1_compressed_csv_is_routed_under_its_own_name(spark):
    names = ["a.csv", "s/a.csv.gz", "B.CSV.GZ", "x.xlsx.gz", "z.zip.gz", "n.gz", "acsv.gz", ".csv.gz", "a.csv.gz.gz"]
    files = spark.createDataFrame([(f"/raw/{name}",) for name in names], "path string")
    found = [(r.target_name, r.action) for r in route_files(files).collect()]
    assert found[:3] == [("a.csv", "csv"), ("a.csv", "csv"), ("B.CSV", "csv")]
    assert [action for _, action in found[3:]] == ["ignored"] * 6
    assert [name for name, _ in found[3:]] == [name for name in names[3:]]


def test_f1_compressed_csv_lands_like_any_other(spark, root, warehouse):
    backwards = BUSINESS_COLUMNS[::-1]
    write(root / "a.csv", HEADER, line(Airline="old"), age=100)
    write(root / "new" / "a.csv.gz", HEADER, line(Airline="new"), "too,short")
    write(root / "b.csv.gz", ",".join(backwards), ",".join((FLIGHT | {"Airline": "b"})[name] for name in backwards))
    write(root / "c.csv.gz", HEADER, line(Airline="c", Route='"A\n-B"'))
    write(root / "d.csv.gz", "Price", "1")
    write(root / "e.csv.gz", HEADER, *[line(Airline=str(i)) for i in range(1000)])
    (root / "e.csv.gz").write_bytes((root / "e.csv.gz").read_bytes()[:-200])
    pipeline.land(spark, str(root), warehouse)
    rows = {r.Airline: r for r in landing.read_converted(spark, warehouse.converted).collect()}
    assert set(rows) == {"new", "b", "c"} and rows["c"].Route == "A\n-B" and rows["b"].Price == FLIGHT["Price"]
    assert [r.malformed_record for r in landing.malformed_rows(spark, warehouse.converted).collect()] == ["too,short"]
    found = {name: (r.status, r.superseded, r.message) for name, r in outcomes(spark, warehouse).items() if name != "a.csv"}
    assert found == {
        "b.csv": ("ok", False, None), "c.csv": ("ok", False, None),
        "d.csv": ("error", False, "d.csv: unrecognised header"), "e.csv": ("error", False, "e.csv: cannot be read"),
    }


def test_f1_patterns_of_landed_files(spark, root):
    for name in ("a.csv", "acsv", "b.csv.gz", "c.CSV", "d.gz", "e.csv.zip"):
        write(root / name, HEADER, line(Airline=name))
    rows = landing.scan_files(spark, [str(root)], landing.LANDED_OR_PACKED).where("layout IS NULL")
    assert sorted(r.Airline for r in rows.collect()) == ["a.csv", "acsv", "b.csv.gz"]


def test_f1_the_mixed_files_are_small(spark, many_rows):
    assert size(queries._mixed_files(spark, "")) < many_rows / 2


def test_f1_text_of_malformed_lines_is_kept_once(spark, root):
    write(root / "a.csv", HEADER, line(), "too,short", line() + ",more")
    rows = landing.scan_files(spark, [str(root)]).where("malformed_record IS NOT NULL").collect()
    assert sorted(r.malformed_record for r in rows) == [line() + ",more", "too,short"]
    assert {r[name] for r in rows for name in BUSINESS_COLUMNS} == {None}


def test_f1_the_scan_has_no_method_that_the_jvm_only_interprets(spark, root):
    write(root / "a.csv", HEADER, line())
    rows = spark.createDataFrame([(*FLIGHT.values(), None, "a", None, 0)], landing.STAGED)
    backwards = sum((11 - i) << (landing.SLOT_BITS * i) for i in range(11))
    debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package
    for frame in (landing.scan_files(spark, [str(root)]), landing._by_own_header(rows, {"a": backwards})):
        parts = debug.codegenStringSeq(frame._jdf.queryExecution().executedPlan())
        assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_f2_a_reading_by_records_that_does_not_count_is_not_written(spark, root, warehouse, monkeypatch):
    written, real = [], landing.write_converted
    monkeypatch.setattr(landing, "write_converted", lambda rows, path: written.append(path.rsplit("/", 1)[-1]) or real(rows, path))
    write(root / "stray.csv", HEADER, line(Airline="s"), 'a,"b,c')
    pipeline.land(spark, str(root), warehouse)
    assert written == ["by=lines"]
    write(root / "breaks.csv", HEADER, line(Airline="b", Route='"A\nB"'))
    write(root / "stray.csv", HEADER, line(Airline="s"), 'a,"b,c')
    pipeline.land(spark, str(root), warehouse)
    assert "by=records" in written and "by=records-again" not in written
    assert sorted(r.Airline for r in landing.read_converted(spark, warehouse.converted).collect()) == ["b", "s", "s"]


def test_f2_a_file_that_changes_between_the_readings_is_left(spark, root, warehouse, monkeypatch):
    write(root / "breaks.csv", HEADER, line(Airline="b", Route='"A\nB"'))
    write(root / "good.csv", HEADER, line(Airline="g"))
    real = landing.write_converted

    def late(rows, path):
        if path.endswith("by=records"):
            write(Path(claims.claim_folder(str(root), "r1")) / "breaks.csv", HEADER, line(Airline="changed"), age=-60)
            rows = landing.scan_files(spark, [f"{claims.claim_folder(str(root), 'r1')}/breaks.csv"], whole=True)
        real(rows, path)

    monkeypatch.setattr(landing, "write_converted", late)
    pipeline.land(spark, str(root), warehouse, run_id="r1")
    assert [r.Airline for r in landing.read_converted(spark, warehouse.converted).collect()] == ["g"]
    assert outcomes(spark, warehouse)["breaks.csv"].status == "skipped" and (root / "breaks.csv").exists()


def test_f2_the_files_with_breaks_are_small(spark, many_rows, monkeypatch):
    sizes, land = [], pipeline.land
    monkeypatch.setattr(queries.pipeline, "land", lambda spark, root, house: sizes.append(size(root)) or land(spark, root, house))
    found = {r.Airline: r.flights for r in queries.landing_breaks(spark, "").where("Airline = 'malformed'").collect()}
    assert found == {"malformed": 2000} and sizes[0] < many_rows / 2


def test_f3_the_files_of_overlapping_runs_are_small(spark, many_rows, monkeypatch):
    sizes, list_run = [], pipeline.list_run
    monkeypatch.setattr(
        queries.pipeline, "list_run", lambda spark, root, house, run: sizes.append(size(root)) or list_run(spark, root, house, run)
    )
    found = {(r.run, r.Airline): r.flights for r in queries.landing_overlap(spark, "").collect()}
    assert found == {("one", "Blue"): 2000, ("two", "Blue"): 500, ("left", "Blue"): 2000}
    assert sizes[0] < many_rows / 2 and sizes[1] < many_rows / 4
