"""Summaries kept by delivery, deliveries picked up as they arrive, and corrections by key."""

import shutil
from collections import Counter
from pathlib import Path

import pytest
from helpers import RAW_ROW, rows
from pyspark.sql import functions as F

from incidentlens.operators.aggregates import cells_from, grouped, precincts_from, totals_from, trend_from
from incidentlens.operators.records import add_hex_cell, in_region, keep_valid
from incidentlens.plans import corrections, deliveries
from incidentlens.plans.fixture import corrections as late_records
from incidentlens.plans.queries import delivery_path, flagged_records, stored_records
from incidentlens.schema import RAW_COLUMNS
from incidentlens.sources.store import partition_names, read_partitioned, write_partitioned
from incidentlens.streaming import pickup


def bag(df):
    return Counter(rows(df.select(*sorted(df.columns))))


def tables(groups):
    return [bag(table(groups)) for table in (precincts_from, trend_from, cells_from, totals_from)]


@pytest.fixture(scope="module")
def named(spark, sf_dir):
    number = F.pmod(F.crc32(F.col("ARREST_KEY").cast("binary")), F.lit(5))
    return stored_records(spark, sf_dir).withColumn("delivery", F.concat(F.lit("d"), number)).persist()


def of_all(records):
    return tables(grouped(add_hex_cell(in_region(records))))


def listed(spark, path):
    return dict(rows(deliveries.manifest(spark, path).select("delivery", "records")))


def test_add_replace_and_take_back_equal_a_full_run(spark, named, tmp_path):
    path = str(tmp_path)
    deliveries.put(spark, path, named.where("delivery IN ('d0', 'd1')"))
    assert tables(deliveries.groups(spark, path)) == of_all(named.where("delivery IN ('d0', 'd1')"))
    deliveries.put(spark, path, named.where("delivery = 'd2' AND LAW_CAT_CD = 'F'"))
    deliveries.put(spark, path, named.where("delivery IN ('d2', 'd3', 'd4')"))
    assert tables(deliveries.groups(spark, path)) == of_all(named)
    deliveries.take_back(spark, path, "d1", "d9")
    rest = named.where("delivery <> 'd1'")
    assert tables(deliveries.groups(spark, path)) == of_all(rest)
    expected = Counter(r[0] for r in rows(in_region(rest).select("delivery")))
    assert listed(spark, path) == dict(expected)
    deliveries.compact(spark, path)
    assert tables(deliveries.groups(spark, path)) == of_all(rest)
    assert len(list((tmp_path / "groups").iterdir())) == 1 and len(list((tmp_path / "manifest").iterdir())) == 1
    deliveries.put(spark, path, named.where("delivery = 'd1'"))
    assert tables(deliveries.groups(spark, path)) == of_all(named)


def test_a_failure_before_the_manifest_changes_nothing(spark, named, tmp_path, monkeypatch):
    path = str(tmp_path)
    deliveries.put(spark, path, named.where("delivery = 'd0'"))
    before = tables(deliveries.groups(spark, path))
    with monkeypatch.context() as broken:
        broken.setattr(deliveries, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            deliveries.put(spark, path, named.where("delivery IN ('d0', 'd1')"))
    assert tables(deliveries.groups(spark, path)) == before
    # A driver that was lost while it wrote the manifest leaves a version that isn't complete.
    shutil.copytree(tmp_path / "manifest" / "000000001", tmp_path / "manifest" / "000000002")
    (tmp_path / "manifest" / "000000002" / "_SUCCESS").unlink()
    assert tables(deliveries.groups(spark, path)) == before
    deliveries.put(spark, path, named.where("delivery = 'd1'"))
    assert set(listed(spark, path)) == {"d0", "d1"}


def test_of_two_changes_at_once_one_fails(spark, named, tmp_path):
    path = str(tmp_path)
    deliveries.put(spark, path, named.where("delivery = 'd0'"))
    seen = deliveries._versions(spark, path)
    deliveries.put(spark, path, named.where("delivery = 'd1'"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        deliveries._commit(spark, path, deliveries.manifest(spark, path), seen)
    assert set(listed(spark, path)) == {"d0", "d1"}


def test_no_delivery(spark, named, tmp_path):
    assert deliveries.manifest(spark, str(tmp_path)).isEmpty()
    with pytest.raises(ValueError):
        deliveries.groups(spark, str(tmp_path))
    deliveries.put(spark, str(tmp_path), named.limit(0), expected=["empty"])
    assert listed(spark, str(tmp_path)) == {"empty": 0}
    assert deliveries.groups(spark, str(tmp_path)).isEmpty()


def csv_file(folder, name, *changes):
    lines = [",".join(RAW_COLUMNS)]
    for change in changes:
        values = {**RAW_ROW, "OFNS_DESC": '"OFFENSE, 1"', **change}
        lines.append(",".join(values[c] for c in RAW_COLUMNS))
    Path(folder).mkdir(exist_ok=True)
    Path(folder, name).write_text("\n".join(lines) + "\n")


def test_only_new_files_are_read(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    csv_file(folder, "a.csv", {"ARREST_KEY": "1"}, {"ARREST_KEY": "2"})
    csv_file(folder, "b +c=1.csv", {"ARREST_KEY": "3"})
    assert pickup.run(spark, folder, out) == ["a.csv", "b +c=1.csv"]
    assert pickup.run(spark, folder, out) == []
    raw = tmp_path / "out" / "raw"
    before = {p: p.stat().st_mtime_ns for p in raw.rglob("*.parquet")}
    csv_file(folder, "c.csv", {"ARREST_KEY": "4", "Latitude": "N/A"}, {"ARREST_KEY": "5", "ARREST_PRECINCT": "9"})
    assert pickup.run(spark, folder, out) == ["c.csv"]
    after = {p: p.stat().st_mtime_ns for p in raw.rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    kept = pickup.records(spark, out)
    assert sorted(rows(kept.select("ARREST_KEY", "delivery", "coord_valid"))) == [
        ("1", "a.csv", True), ("2", "a.csv", True), ("3", "b +c=1.csv", True), ("4", "c.csv", False), ("5", "c.csv", True),
    ]
    assert listed(spark, f"{out}/summaries") == {"a.csv": 2, "b +c=1.csv": 1, "c.csv": 1}
    assert tables(deliveries.groups(spark, f"{out}/summaries")) == of_all(keep_valid(kept.drop("is_corrupt", "delivery")))


def test_a_failure_in_between_changes_nothing(spark, tmp_path, monkeypatch):
    """Lost after the records were written, and lost before a batch was complete."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    csv_file(folder, "a.csv", {"ARREST_KEY": "1"})
    with monkeypatch.context() as broken:
        broken.setattr(deliveries, "put", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pickup.run(spark, folder, out)
    assert pickup.run(spark, folder, out) == ["a.csv"]
    # A batch whose commit is missing is written again, and its first files don't count.
    csv_file(folder, "b.csv", {"ARREST_KEY": "2"}, {"ARREST_KEY": "3"})
    assert pickup.ingest_new(spark, folder, out) == 1
    for log in (tmp_path / "out" / "checkpoint" / "commits", tmp_path / "out" / "raw" / "_spark_metadata"):
        (log / "1").unlink()
        (log / ".1.crc").unlink(missing_ok=True)
    assert pickup.records(spark, out).count() == 1
    assert pickup.run(spark, folder, out) == ["b.csv"]
    assert sorted(r[0] for r in rows(pickup.records(spark, out).select("ARREST_KEY"))) == ["1", "2", "3"]


def test_batches_of_files_and_wrong_headers(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(5):
        csv_file(folder, f"{i}.csv", {"ARREST_KEY": str(i)})
    assert pickup.ingest_new(spark, folder, out, files_per_batch=2) == 3
    assert pickup.records(spark, out).count() == 5
    swapped = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    Path(folder, "wrong.csv").write_text(",".join(swapped) + "\n" + ",".join(["1"] * 19) + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        pickup.run(spark, folder, out)
    assert pickup.records(spark, out).count() == 5
    assert pickup.run(spark, folder, out, check_header=False) == [*[f"{i}.csv" for i in range(5)], "wrong.csv"]


def test_picked_up_records_equal_the_ingested_ones(spark, sf_dir, tmp_path):
    pickup.ingest_new(spark, delivery_path(spark, sf_dir), str(tmp_path))
    kept = pickup.records(spark, str(tmp_path))
    assert bag(kept.drop("delivery", "is_corrupt")) == bag(flagged_records(spark, sf_dir))
    assert kept.where("is_corrupt").isEmpty()


@pytest.fixture()
def dataset(spark, sf_dir, tmp_path):
    path = str(tmp_path / "stored")
    write_partitioned(keep_valid(flagged_records(spark, sf_dir)), path)
    return path


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def merged_plainly(before, changes):
    """Rows as dicts; those with a key replace what has that key, the latest one."""
    kept = {}
    for change in changes:
        old = kept.get(change["ARREST_KEY"])
        if old is None or change["delivered"] > old["delivered"]:
            kept[change["ARREST_KEY"]] = change
    rest = [r for r in before if r["ARREST_KEY"] not in kept]
    return [*rest, *[c for c in kept.values() if c["coord_valid"]]]


def test_corrections_replace_records_by_key(spark, sf_dir, dataset):
    columns = sorted(read_partitioned(spark, dataset).columns)
    late = late_records(flagged_records(spark, sf_dir))
    before = [r.asDict() for r in read_partitioned(spark, dataset).collect()]
    expected = merged_plainly(before, [r.asDict() for r in late.collect()])
    untouched = {p: t for p, t in files(dataset).items() if "BORO=K" not in str(p) and "BORO=Q" not in str(p)}
    assert corrections.merge(spark, dataset, late) == ["K", "Q"]
    once = bag(read_partitioned(spark, dataset))
    assert once == Counter(tuple(r[c] for c in columns) for r in expected)
    assert untouched.items() <= files(dataset).items() and len(untouched) >= 4
    # Again, as after a failure: nothing changes any more.
    corrections.merge(spark, dataset, late)
    assert bag(read_partitioned(spark, dataset)) == once


def test_a_borough_may_appear_and_disappear(spark, sf_dir, dataset):
    all_records = flagged_records(spark, sf_dir)
    moved = all_records.where("ARREST_BORO = 'S'").withColumns({"ARREST_BORO": F.lit("new/1"), "delivered": F.lit(1)})
    count = moved.where("coord_valid").count()
    assert corrections.merge(spark, dataset, moved) == ["S", "new%2F1"]
    names = partition_names(spark, dataset)
    assert "S" not in names and "new%2F1" in names
    assert read_partitioned(spark, dataset).where("ARREST_BORO = 'new/1'").count() == count


def test_missing_boroughs_and_keys(spark, sf_dir, dataset):
    total = read_partitioned(spark, dataset).count()
    nameless = read_partitioned(spark, dataset).where("ARREST_BORO IS NULL")
    some = nameless.count()
    template = flagged_records(spark, sf_dir).where("coord_valid").limit(1)
    added = template.withColumns({"ARREST_BORO": F.lit(""), "ARREST_KEY": F.lit("late"), "delivered": F.lit(1)})
    keyless = template.withColumns({"ARREST_KEY": F.lit(None).cast("string"), "ARREST_BORO": F.lit(None).cast("string"), "delivered": F.lit(1)})
    corrections.merge(spark, dataset, added.unionByName(keyless).unionByName(keyless))
    assert read_partitioned(spark, dataset).count() == total + 3
    assert read_partitioned(spark, dataset).where("ARREST_BORO IS NULL").count() == some + 3
    assert corrections.merge(spark, dataset, added.limit(0)) == []


def test_the_latest_of_a_very_frequent_key(spark, sf_dir):
    template = flagged_records(spark, sf_dir).limit(1).drop("ARREST_KEY", "ARREST_PRECINCT")
    many = template.join(F.broadcast(spark.range(20_000)), F.lit(True)).select(
        F.lit("one").alias("ARREST_KEY"), F.col("id").cast("int").alias("ARREST_PRECINCT"), *template.columns, F.col("id").alias("delivered")
    ).drop("id")
    found = corrections.latest(many)
    assert rows(found.select("ARREST_KEY", "ARREST_PRECINCT", "delivered")) == [("one", 19_999, 19_999)]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text
