import csv
from collections import Counter
from pathlib import Path

import pytest
from helpers import RAW_ROW, rows, stored
from pyspark.sql import functions as F

from incidentlens.plans.fixture import raw_records
from incidentlens.schema import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA, STORED_SCHEMA
from incidentlens.sources.csv import scan_csv
from incidentlens.sources.scratch import materialise, scratch_path
from incidentlens.sources.store import (
    data_files,
    partition_list,
    read_partitioned,
    storage_report,
    write_partitioned,
    write_table,
)


def csv_file(tmp_path, lines, header=RAW_COLUMNS):
    path = tmp_path / "delivery.csv"
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def line(**changes):
    values = {**RAW_ROW, "OFNS_DESC": '"OFFENSE, 1"', **changes}
    return ",".join(values[name] for name in RAW_COLUMNS)


def test_csv_values(spark, tmp_path):
    row = scan_csv(spark, csv_file(tmp_path, [line(LAW_CODE="", PD_DESC=' "a ')])).first()
    assert row.OFNS_DESC == "OFFENSE, 1" and row.LAW_CODE is None
    assert row.asDict() == {**RAW_ROW, "LAW_CODE": None, "PD_DESC": ' "a '}


def test_csv_doubled_quotes_stay(spark, tmp_path):
    path = csv_file(tmp_path, [line(PD_DESC='"say ""x"" now"')])
    assert '""x""' in scan_csv(spark, path).first().PD_DESC


def test_csv_of_wrong_length(spark, tmp_path):
    path = csv_file(tmp_path, ["7,01/01/2025", line(ARREST_KEY="8") + ",more", line()])
    got = scan_csv(spark, path, keep_corrupt=True).orderBy("ARREST_KEY").cache()
    assert [r.ARREST_KEY for r in got.collect()] == ["1", "7", "8"]
    assert [r[CORRUPT_COLUMN] is None for r in got.collect()] == [True, False, False]
    assert got.where("ARREST_KEY = 7").first().Location is None
    got.unpersist()


def test_csv_header_is_checked(spark, tmp_path):
    swapped = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    path = csv_file(tmp_path, [line()], swapped)
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        scan_csv(spark, path).collect()
    # Without the check columns go by position, whatever the header says.
    assert scan_csv(spark, path, check_header=False).first().ARREST_KEY == "1"


def test_csv_checked_header_with_corrupt_column(spark, tmp_path):
    assert scan_csv(spark, csv_file(tmp_path, [line()]), keep_corrupt=True).count() == 1
    assert len(RAW_SCHEMA) == 19


def test_csv_folder_of_deliveries(spark, tmp_path):
    for name in ("q1", "q2"):
        (tmp_path / name).mkdir()
        csv_file(tmp_path / name, [line(ARREST_KEY=name)])
    got = scan_csv(spark, [str(tmp_path / "q1"), str(tmp_path / "q2")])
    assert {r.ARREST_KEY for r in got.collect()} == {"q1", "q2"}


def test_csv_round_trip_keeps_every_record(spark, sf_dir, tmp_path):
    records = raw_records(spark, sf_dir)
    records.write.option("header", True).csv(str(tmp_path / "d"))
    back = scan_csv(spark, str(tmp_path / "d"))
    assert Counter(rows(back)) == Counter(rows(records))


BOROUGHS = ["K", None, "", "02", "Q", "K"]


def test_partition_keys_survive(spark, tmp_path):
    path = str(tmp_path / "s")
    df = stored(spark, *[{"ARREST_BORO": b, "ARREST_KEY": str(i)} for i, b in enumerate(BOROUGHS)])
    write_partitioned(df, path)
    back = read_partitioned(spark, path)
    assert back.schema.names == df.schema.names
    got = {r.ARREST_KEY: r.ARREST_BORO for r in back.collect()}
    assert got == {"0": "K", "1": None, "2": None, "3": "02", "4": "Q", "5": "K"}
    names = {r.partition for r in partition_list(spark, path).collect()}
    assert names == {"K", "02", "Q", "__HIVE_DEFAULT_PARTITION__"}


def test_rewriting_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "s")
    write_partitioned(stored(spark, {"ARREST_BORO": "K"}, {"ARREST_BORO": "Q"}), path)
    for _ in range(2):
        write_partitioned(stored(spark, {"ARREST_BORO": "M"}), path)
        assert [r.ARREST_BORO for r in read_partitioned(spark, path).collect()] == ["M"]
    table = str(tmp_path / "t")
    write_table(spark.range(3), table)
    write_table(spark.range(2), table)
    assert spark.read.parquet(table).count() == 2


def by_number(spark, n, **values):
    """``n`` stored records in 16 partitions; columns not given are NULL."""
    return spark.range(0, n, 1, 16).select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in STORED_SCHEMA
        ]
    )


@pytest.fixture
def small_partitions(spark):
    """Shuffle partitions are split where they exceed the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    yield
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_a_large_precinct_is_split_over_tasks(spark, tmp_path, small_partitions):
    """A precinct with most of the records must not become one task and one file."""
    path = str(tmp_path / "s")
    number = F.col("id")
    df = by_number(
        spark, 60_000, ARREST_KEY=F.sha2(number.cast("string"), 256),
        ARREST_BORO=F.when(number % 20 == 0, "Q").otherwise("K"),
        ARREST_PRECINCT=F.when(number % 20 == 0, number % 60).otherwise(75),
    )
    write_partitioned(df, path)
    back = read_partitioned(spark, path)
    hot = back.where("ARREST_PRECINCT = 75").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 20_000
    assert back.count() == 60_000 and back.where("ARREST_BORO = 'Q'").count() == 3_000
    assert back.select("ARREST_KEY").distinct().count() == 60_000


def test_files_hold_few_precincts(spark, tmp_path, small_partitions):
    path = str(tmp_path / "s")
    number = F.col("id")
    df = by_number(
        spark, 80_000, ARREST_KEY=F.sha2(number.cast("string"), 256), ARREST_BORO=F.lit("K"),
        ARREST_PRECINCT=number * 7919 % 40,
    )
    write_partitioned(df, path)
    per_file = (
        read_partitioned(spark, path)
        .groupBy(F.input_file_name())
        .agg(F.count_distinct("ARREST_PRECINCT").alias("precincts"))
        .collect()
    )
    assert len(per_file) >= 4
    assert sum(r.precincts for r in per_file) < 40 * 2


def test_files_are_ordered_by_precinct(spark, tmp_path):
    path = str(tmp_path / "s")
    df = stored(spark, *[{"ARREST_PRECINCT": p} for p in (5, 1, None, 3, 2)])
    write_partitioned(df, path)
    (file,) = Path(path, "ARREST_BORO=K").glob("*.parquet")
    got = [r.ARREST_PRECINCT for r in spark.read.parquet(str(file)).collect()]
    assert got == [None, 1, 2, 3, 5]
    assert ".snappy." in file.name


def test_records_per_file_can_be_limited(spark, tmp_path):
    path = str(tmp_path / "s")
    write_partitioned(stored(spark, *[{}] * 10), path, max_records_per_file=3)
    assert data_files(spark, path).count() == 4
    assert read_partitioned(spark, path).count() == 10


def test_storage_report_counts_data_files_only(spark, tmp_path):
    raw_path, stored_path = str(tmp_path / "r"), str(tmp_path / "s")
    df = stored(spark, {}, {"ARREST_BORO": "Q"})
    write_table(df, raw_path)
    write_partitioned(df, stored_path)
    row = storage_report(spark, raw_path, stored_path).first()
    def size(path):
        return sum(f.stat().st_size for f in Path(path).rglob("*.parquet")) / 2**20

    assert row.raw_mb == pytest.approx(size(raw_path))
    assert row.stored_mb == pytest.approx(size(stored_path))
    assert row.ratio == pytest.approx(row.raw_mb / row.stored_mb)
    assert row.partitions == ["K", "Q"]


def test_storage_report_without_stored_data(spark, tmp_path):
    (tmp_path / "s").mkdir()
    write_table(stored(spark, {}), str(tmp_path / "r"))
    row = storage_report(spark, str(tmp_path / "r"), str(tmp_path / "s")).first()
    assert (row.stored_mb, row.ratio, row.partitions) == (0.0, 0.0, [])


def test_scratch_tables_are_below_the_shared_folder(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(f"{shared}/incidentlens/") and a.endswith("/x") and a != b


def test_scratch_falls_back_to_the_warehouse(spark, monkeypatch):
    get = spark.conf.get
    monkeypatch.setattr(
        spark.conf, "get", lambda key, *default: default[0] if "checkpoint" in key else get(key)
    )
    assert scratch_path(spark, "x").startswith(get("spark.sql.warehouse.dir"))


def test_materialised_tables_keep_their_schema(spark):
    df = spark.range(3).withColumn("n", F.lit(None).cast("string"))
    copy = materialise(df)
    assert copy.schema.names == ["id", "n"] and copy.count() == 3
    assert "incidentlens" in copy.inputFiles()[0]


def test_csv_written_by_others(spark, tmp_path):
    path = tmp_path / "d.csv"
    with path.open("w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(RAW_COLUMNS)
        writer.writerow([RAW_ROW[name] for name in RAW_COLUMNS])
    assert scan_csv(spark, str(path)).first().asDict() == RAW_ROW
