"""What grows with the records and what does not, read from the metrics of executed plans."""

import pytest
from pyspark.sql import functions as F

from incidentlens.operators.aggregates import grouped, hex_density, monthly_trend, precinct_summary
from incidentlens.operators.lookups import borough_scan, category_by_month, precinct_lookup
from incidentlens.operators.records import add_hex_cell
from incidentlens.plans.queries import region_records
from incidentlens.schema import STORED_SCHEMA
from incidentlens.sources.store import read_partitioned, write_partitioned, write_table


@pytest.fixture(autouse=True)
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def metric(df, node, name):
    """Run ``df`` and sum a metric over its plan's nodes of a kind."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()

    def total(plan):
        here = plan.metrics().apply(name).value() if plan.nodeName().startswith(node) else 0
        children = plan.children()
        return here + sum(total(children.apply(i)) for i in range(children.size()))

    return total(execution.executedPlan())


@pytest.mark.parametrize(
    "summary",
    [
        lambda df: precinct_summary(df),
        lambda df: monthly_trend(df),
        lambda df: hex_density(add_hex_cell(df)),
        lambda df: grouped(add_hex_cell(df)),
    ],
)
def test_summaries_shuffle_groups_not_records(spark, sf_dir, tmp_path, summary):
    records = region_records(spark, sf_dir)
    shuffled = []
    for copies in (1, 5):
        many = records.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
        # The same number of tasks, each with more records.
        table = write_table(many.repartition(2, "ARREST_KEY"), str(tmp_path / str(copies)))
        shuffled.append(metric(summary(table.coalesce(2)), "Exchange", "shuffleRecordsWritten"))
    assert 0 < shuffled[1] <= shuffled[0] * 1.01


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """40 precincts in two boroughs, in files of half a megabyte."""
    path = str(tmp_path_factory.mktemp("clustered"))
    number = F.col("id")
    values = {
        "ARREST_KEY": F.sha2(number.cast("string"), 256),
        "ARREST_BORO": F.when(number % 2 == 0, "K").otherwise("Q"),
        "ARREST_PRECINCT": number * 7919 % 40,
        "LAW_CAT_CD": F.lit("F"),
    }
    df = spark.range(0, 80_000, 1, 16).select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in STORED_SCHEMA
        ]
    )
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    write_partitioned(df, path)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return read_partitioned(spark, path)


def test_precinct_filters_skip_records(clustered):
    one = precinct_lookup(clustered, 8).select("ARREST_KEY")
    assert one.count() == 2_000
    assert metric(one, "Scan parquet", "numOutputRows") < 20_000
    by_month = category_by_month(clustered, 8, "F")
    assert metric(by_month, "Scan parquet", "numOutputRows") < 20_000


def test_borough_filter_reads_one_directory(clustered):
    one = borough_scan(clustered, "Q").select("ARREST_KEY")
    assert metric(one, "Scan parquet", "numOutputRows") == 40_000
    assert metric(one, "Scan parquet", "numPartitions") == 1
