"""What the physical plans must and must not contain."""

import pytest

from incidentlens.operators.aggregates import grouped, top_k
from incidentlens.operators.quality import store_report
from incidentlens.operators.records import in_region
from incidentlens.plans import queries as registered
from incidentlens.plans.queries import CONCAVE_RING, celled_records, flagged_records, stored_records
from incidentlens.sources.store import data_files, read_partitioned

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


@pytest.fixture(scope="module", autouse=True)
def whole_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def plans(spark, sf_dir, whole_filters):
    return {name: plan(query(spark, sf_dir)) for name, query in registered.queries().items()}


def test_no_python_and_no_pair_joins(plans):
    for name, text in plans.items():
        for node in (*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


# Points meet the cells of areas, edges their areas, and groups the deliveries that count.
JOINING = {"area_join", "area_totals", "area_cells", "deliveries_trend", "deliveries_cells", "pickup_precincts"}


def test_no_other_query_joins(plans):
    assert not [name for name, text in plans.items() if "Join" in text and name not in JOINING]


def test_rectangle_reaches_the_scan(plans):
    for name in ("precinct_summary", "hex_density", "monthly_trend", "spatial_filter"):
        (scan,) = scans(plans[name])
        assert "GreaterThan(Longitude,-74.3)" in scan, name
        assert "LessThan(Longitude,-73.65)" in scan, name


def test_box_of_a_polygon_reaches_the_scan(plans):
    (scan,) = scans(plans["polygon_filter"])
    west = min(x for x, _ in CONCAVE_RING)
    assert f"GreaterThan(Longitude,{west})" in scan


def test_lookups_prune(plans):
    assert "EqualTo(ARREST_PRECINCT,8)" in plans["precinct_lookup"]
    (scan,) = scans(plans["borough_scan"])
    assert "PartitionFilters: [isnotnull(ARREST_BORO" in scan and "= M)]" in scan
    (scan,) = scans(plans["category_by_month"])
    assert "EqualTo(ARREST_PRECINCT,8)" in scan and "EqualTo(LAW_CAT_CD,F)" in scan


def test_only_needed_columns_are_read(spark, sf_dir, plans):
    (scan,) = scans(plan(store_report(flagged_records(spark, sf_dir))))
    assert "ReadSchema: struct<coord_valid:boolean>" in scan
    (scan,) = scans(plans["spatial_outliers"])
    assert "ReadSchema: struct<Latitude:double,Longitude:double>" in scan
    (scan,) = scans(plans["precinct_summary"])
    read = scan.split("ReadSchema: ")[1]
    assert read.startswith(
        "struct<LAW_CAT_CD:string,ARREST_PRECINCT:int,Latitude:double,Longitude:double>"
    )


def test_summaries_combine_before_the_shuffle(plans):
    for name in ("precinct_summary", "hex_density", "monthly_trend", "category_by_month"):
        text = plans[name]
        assert "partial_" in text[text.index("Exchange hashpartitioning"):], name


def test_all_summaries_share_one_scan_and_one_shuffle(spark, sf_dir):
    text = plan(grouped(celled_records(spark, sf_dir)))
    assert len(scans(text)) == 1 and text.count("Exchange") == 1


def test_top_k_sorts_no_more_than_it_must(plans):
    assert "TakeOrderedAndProject" in plans["top_precincts"]
    assert "TakeOrderedAndProject" in plans["feature_labels"]


def test_record_queries_do_not_shuffle(plans):
    for name in ("scan_csv", "typed_records", "coord_flag", "raw_roundtrip", "store_filter", "spatial_filter", "polygon_filter",
                 "long_polygon_filter", "hex_assign", "precinct_lookup", "borough_scan"):
        assert "Exchange" not in plans[name], name


def test_file_sizes_come_without_content(spark, sf_dir):
    from incidentlens.plans.queries import stored_path

    (scan,) = scans(plan(data_files(spark, stored_path(spark, sf_dir))))
    assert "content" not in scan


def test_written_datasets_are_reused(spark, sf_dir):
    first, second = (stored_records(spark, sf_dir).inputFiles() for _ in range(2))
    assert first == second


def test_region_of_stored_records_needs_no_join(spark, sf_dir):
    from incidentlens.plans.queries import stored_path

    text = plan(in_region(read_partitioned(spark, stored_path(spark, sf_dir))))
    assert "Join" not in text and "Exchange" not in text


def test_generated_methods_are_short_enough_to_compile(spark, sf_dir):
    """The JVM leaves methods of 8,000 bytes and more to its interpreter."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, query in registered.queries().items():
            if name == "batch_run":
                continue
            parts = query(spark, sf_dir)._jdf.queryExecution().debug().codegenToSeq()
            sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
            assert max(sizes, default=0) < 8000, name
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
