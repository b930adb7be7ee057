import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from helpers import rows

from incidentlens.functions.spatial import HexGrid
from incidentlens.operators.aggregates import hex_density, top_k
from incidentlens.operators.records import add_hex_cell, flag_coords, in_region, keep_valid, typed
from incidentlens.plans import job, queries
from incidentlens.plans.queries import delivery_path, queries as all_queries
from incidentlens.schema import RAW_COLUMNS
from incidentlens.sources.csv import scan_csv
from incidentlens.sources.scratch import scratch_path

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("job"))
    reports = job.run(spark, delivery_path(spark, sf_dir), out)
    return out, {name: report.collect() for name, report in reports.items()}


TABLES = {
    "aggregated/precinct_summary": "precinct_summary",
    "aggregated/monthly_trend": "monthly_trend",
    "aggregated/hex_density": "hex_density",
    "aggregated/top10_precincts": "top_precincts",
    "features/circles": "feature_circles",
    "features/heat": "heat_points",
    "features/labels": "feature_labels",
    "features/borough_month_lines": "borough_month_lines",
}


@pytest.mark.parametrize("table, query", TABLES.items())
def test_tables_equal_the_queries(spark, sf_dir, run, table, query):
    written = spark.read.parquet(f"{run[0]}/{table}.parquet")
    expected = all_queries()[query](spark, sf_dir)
    assert written.dtypes == expected.dtypes
    assert Counter(rows(written)) == Counter(rows(expected))


def test_reports_agree(run):
    _, reports = run
    quality = {r.measure: r.records for r in reports["quality"]}
    (store,), (summary,), (storage,) = reports["store"], reports["summary"], reports["storage"]
    assert store.records_read == quality["all records"]
    assert store.records_dropped == quality["invalid coordinates"]
    assert store.records_read == store.records_dropped + store.records_retained
    assert summary.records_read == store.records_retained
    assert summary.outliers + summary.records_in_region == summary.records_read
    assert storage.ratio == pytest.approx(storage.raw_mb / storage.stored_mb)
    assert len(storage.partitions) == 6
    names = [r.borough_name for r in reports["borough months"]]
    assert names == ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"]


def test_known_numbers(spark, sf_dir, run):
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("numbers are known for one size")
    _, reports = run
    quality = {r.measure: r.records for r in reports["quality"]}
    assert quality == {
        "all records": 15000, "null LAW_CAT_CD": 161, "null KY_CD": 212, "null AGE_GROUP": 246,
        "null PERP_SEX": quality["null PERP_SEX"], "null PERP_RACE": quality["null PERP_RACE"],
        "null Latitude": 320, "null Longitude": 349, "invalid coordinates": 1011,
    }
    (summary,) = reports["summary"]
    assert tuple(summary) == (13989, 817, 13172, 43, 333)
    top = spark.read.parquet(f"{run[0]}/aggregated/top10_precincts.parquet")
    got = [(r.ARREST_PRECINCT, r.ARREST_BORO, r.total_arrests) for r in top_k(top, 10).collect()]
    assert got == [
        (8, "M", 662), (8, "S", 629), (12, "K", 623), (3, "M", 615), (11, "B", 599),
        (12, "Q", 598), (4, "Q", 593), (2, "Q", 548), (1, "M", 547), (10, "K", 547),
    ]


def test_running_twice_changes_nothing(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    out = str(tmp_path / "out")
    seen = []
    for _ in range(2):
        job.run(spark, delivery_path(spark, small), out)
        tables = [f"{out}/{table}.parquet" for table in TABLES] + [f"{out}/raw", f"{out}/processed"]
        seen.append([Counter(rows(spark.read.parquet(path))) for path in tables])
    assert seen[0] == seen[1]


def test_a_later_delivery_replaces_all(spark, tmp_path):
    out = str(tmp_path / "out")
    job.run(spark, delivery_path(spark, "/root/testdata/sf0.001"), out)
    first = spark.read.parquet(f"{out}/processed").count()
    two = [delivery_path(spark, "/root/testdata/sf0.001")] * 2
    job.run(spark, two, out)
    assert spark.read.parquet(f"{out}/processed").count() == 2 * first


def test_datasets_follow_their_sources(spark, tmp_path):
    """Other content below the same path gives other records."""
    def write(keys):
        sf = "/root/testdata/sf0.001"
        for table in queries.SOURCE_TABLES:
            df = spark.read.parquet(f"{sf}/{table}.parquet")
            if table == "orders":
                df = df.where(f"o_orderkey <= {keys}")
            df.write.mode("overwrite").parquet(str(tmp_path / f"{table}.parquet"))

    write(20)
    few = queries.flagged_records(spark, str(tmp_path)).count()
    write(400)
    assert queries.flagged_records(spark, str(tmp_path)).count() > few


def test_datasets_that_are_gone_are_written_again(spark, tmp_path, monkeypatch):
    paths = iter([str(tmp_path / "a"), str(tmp_path / "b")])
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: next(paths))
    def write(path):
        spark.range(3).write.parquet(path)

    sf = "/root/testdata/sf0.001"
    first = queries._dataset(spark, sf, "test", write)
    assert queries._dataset(spark, sf, "test", write) == first == str(tmp_path / "a")
    (tmp_path / "a").rename(tmp_path / "elsewhere")
    assert queries._dataset(spark, sf, "test", write) == str(tmp_path / "b")


def test_other_region_and_grid(spark, tmp_path):
    delivery = delivery_path(spark, "/root/testdata/sf0.001")
    ring, grid = queries.CONCAVE_RING, HexGrid(edge_m=2000.0)
    job.run(spark, delivery, str(tmp_path), ring=ring, grid=grid)
    valid = keep_valid(flag_coords(typed(scan_csv(spark, delivery)), ring))
    expected = hex_density(add_hex_cell(in_region(valid, ring), grid))
    written = spark.read.parquet(f"{tmp_path}/aggregated/hex_density.parquet")
    assert Counter(rows(written)) == Counter(rows(expected))
    assert spark.read.parquet(f"{tmp_path}/processed").count() == valid.count()


def test_command_line(spark, sf_dir, tmp_path):
    delivery = delivery_path(spark, "/root/testdata/sf0.001")
    done = subprocess.run(
        [sys.executable, "-m", "incidentlens", "--csv", delivery, "--out", str(tmp_path / "o")],
        cwd=ROOT, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "records_in_region" in done.stdout and "Precinct " in done.stdout


def test_records_with_too_few_or_too_many_fields_are_counted(spark, tmp_path):
    full = ",".join(f"v{i}" for i in range(len(RAW_COLUMNS)))
    lines = [",".join(RAW_COLUMNS), full, "short,row", full, full + ",more", "one"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    report = job.ingest(spark, f"file:{tmp_path}/in.csv", f"file:{tmp_path}/raw")
    counts = {r.measure: r.records for r in report.collect()}
    assert (counts["all records"], counts["corrupt records"]) == (5, 3)
    assert job.read_flagged(spark, f"file:{tmp_path}/raw").count() == 5


def test_a_resumed_run_starts_at_the_step_that_failed(spark, sf_dir, tmp_path, monkeypatch):
    out, delivery = str(tmp_path), delivery_path(spark, sf_dir)
    with monkeypatch.context() as broken:
        broken.setattr(job, "process", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run(spark, delivery, out)
    stored_files = {p: p.stat().st_mtime_ns for p in (tmp_path / "processed").rglob("*.parquet")}
    reports = job.run(spark, delivery, out, resume=True)
    assert list(reports) == ["summary", "storage", "borough months"]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "processed").rglob("*.parquet")} == stored_files
    assert job.run(spark, delivery, out, resume=True) == {}
    # Other parameters are another run, which does everything.
    assert len(job.run(spark, delivery, out, ring=queries.CONCAVE_RING, resume=True)) == 5
    assert len(job.run(spark, delivery, out)) == 5


def test_intermediate_tables_need_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session, "name")
