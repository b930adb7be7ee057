"""Incident records and areas derived from the given tables.

None of the given tables has coordinates, so one text record is derived from
every order, and one area from every supplier. The statements run unchanged in Spark and in other SQL engines;
which value exercises which rule is listed in FIXTURES.md.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_TABLES = ("orders", "customer", "nation")

RAW_RECORDS_SQL = """
SELECT CAST(k AS STRING) AS ARREST_KEY,
  CASE WHEN k % 109 = 0 THEN NULL WHEN k % 107 = 0 THEN '13/45/2025'
       ELSE concat(lpad(CAST(month(d) AS STRING),2,'0'),'/',lpad(CAST(day(d) AS STRING),2,'0'),'/',CAST(year(d) AS STRING)) END AS ARREST_DATE,
  CAST(100 + k % 800 AS STRING) AS PD_CD, concat('PD ', CAST(k % 40 AS STRING)) AS PD_DESC,
  CASE WHEN k % 71 = 0 THEN NULL ELSE CAST(100 + k % 60 AS STRING) END AS KY_CD,
  concat('OFFENSE, ', CAST(k % 12 AS STRING)) AS OFNS_DESC, concat('PL ', CAST(k % 300 AS STRING)) AS LAW_CODE,
  CASE WHEN n = 24 OR k % 79 = 0 THEN 'I' WHEN k % 89 = 0 THEN NULL WHEN k % 83 = 0 THEN '(null)'
       WHEN k % 10 < 5 THEN CASE n % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'V' END
       ELSE CASE st WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'V' END END AS LAW_CAT_CD,
  CASE WHEN k % 97 = 0 THEN NULL ELSE CASE rg WHEN 0 THEN 'B' WHEN 1 THEN 'K' WHEN 2 THEN 'M' WHEN 3 THEN 'Q' ELSE 'S' END END AS ARREST_BORO,
  CASE WHEN k % 103 = 0 THEN 'N/A' ELSE CAST(1 + n % 12 AS STRING) END AS ARREST_PRECINCT,
  CAST(k % 3 AS STRING) AS JURISDICTION_CODE,
  CASE WHEN k % 61 = 0 THEN '(null)' ELSE CASE substr(pr,1,1) WHEN '1' THEN '<18' WHEN '2' THEN '18-24' WHEN '3' THEN '25-44' WHEN '4' THEN '45-64' ELSE '65+' END END AS AGE_GROUP,
  CASE WHEN k % 59 = 0 THEN '(null)' WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS PERP_SEX,
  CASE WHEN k % 53 = 0 THEN '(null)' ELSE concat('R', CAST(k % 6 AS STRING)) END AS PERP_RACE,
  concat(CAST(900000 + k AS STRING), CASE WHEN k % 113 = 0 THEN '.0' ELSE '' END) AS X_COORD_CD,
  CASE WHEN k % 127 = 0 THEN '1,234' ELSE CAST(120000 + k AS STRING) END AS Y_COORD_CD,
  CASE WHEN k % 47 = 0 THEN NULL ELSE concat(substr(CAST(la AS STRING),1,2),'.',substr(CAST(la AS STRING),3),ta) END AS Latitude,
  CASE WHEN k % 43 = 0 THEN NULL ELSE concat('-',substr(CAST(lo AS STRING),1,2),'.',substr(CAST(lo AS STRING),3),tb) END AS Longitude,
  CASE WHEN k % 47 = 0 OR k % 43 = 0 THEN NULL ELSE concat('POINT (-',substr(CAST(lo AS STRING),1,2),'.',substr(CAST(lo AS STRING),3),tb,' ',substr(CAST(la AS STRING),1,2),'.',substr(CAST(la AS STRING),3),ta,')') END AS Location
FROM (SELECT o_orderkey AS k, o_orderdate AS d, o_orderstatus AS st, o_orderpriority AS pr, n_nationkey AS n, n_regionkey AS rg,
  CASE WHEN o_orderkey % 41 = 0 THEN 41500000 WHEN o_orderkey % 37 = 0 THEN 40400000
       ELSE 40450000 + (n_nationkey * 7 % 25) * 18000 + (o_orderkey * 7919) % 20000 END AS la,
  CASE WHEN o_orderkey % 31 = 0 THEN 73650000
       ELSE 74250000 - (n_nationkey * 11 % 25) * 22000 - (o_orderkey * 104729) % 20000 END AS lo,
  CASE WHEN o_orderkey % 41 = 0 OR o_orderkey % 37 = 0 THEN '' ELSE lpad(CAST((o_orderkey * 31337) % 10000000 AS STRING),7,'0') END AS ta,
  CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE lpad(CAST((o_orderkey * 77261) % 10000000 AS STRING),7,'0') END AS tb
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) t
"""

AREA_TABLE = "supplier"
# Twelve directions in thousandths, a step of 30 degrees each, for four rings: an outline,
# a hole in it, a part to the east, and an island in the hole.
RING_STEPS = [
    (ring, place, dx, dy)
    for ring in range(4)
    for place, (dx, dy) in enumerate(
        [
            (1000, 0), (866, 500), (500, 866), (0, 1000), (-500, 866), (-866, 500),
            (-1000, 0), (-866, -500), (-500, -866), (0, -1000), (500, -866), (866, -500),
        ]
    )
]

VERTICES_SQL = """
SELECT concat('A', CAST(k AS STRING)) AS area, ring, place,
  CAST((lon0 + CASE ring WHEN 2 THEN 3 * radius ELSE 0 END) * 100000 + dx * radius * share AS DOUBLE) / 1e11 AS lon,
  CAST(lat0 * 100000 + dy * radius * share AS DOUBLE) / 1e11 AS lat
FROM (SELECT *, -74250000 + k * 102947 % 550000 AS lon0, 40450000 + k * 104729 % 450000 AS lat0,
    CASE WHEN k = 1 THEN 2000000 WHEN k % 10 = 0 THEN 150000 + k % 7 * 10000 ELSE 4000 + k * 31 % 40 * 1000 END AS radius,
    CASE ring WHEN 0 THEN 60 + (k * place * 13 + place * 7) % 41 WHEN 1 THEN 30 WHEN 2 THEN 50 ELSE 10 END AS share
  FROM (SELECT CAST(s_suppkey AS BIGINT) AS k, ring, place, CAST(dx AS BIGINT) AS dx, CAST(dy AS BIGINT) AS dy FROM {steps}) t) t
WHERE ring = 0 OR (ring = 1 AND k % 3 = 0) OR (ring = 2 AND k % 5 = 0) OR (ring = 3 AND k % 15 = 0)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 text columns of every record, not yet written anywhere."""
    # Statistics decide the joins: the few nations are broadcast, customers only
    # while they are small, and otherwise both sides are shuffled on the key,
    # where adaptive execution splits a customer with a large share of orders.
    statement = RAW_RECORDS_SQL
    for name in SOURCE_TABLES:
        statement = statement.replace(f" {name} ", f" {{{name}}} ")
    return spark.sql(statement, **{name: table(spark, sf_dir, name) for name in SOURCE_TABLES})


def area_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of areas: stars of several sizes around the city, one of them over all of it."""
    steps = ", ".join(f"struct({ring} AS ring, {place} AS place, {dx} AS dx, {dy} AS dy)" for ring, place, dx, dy in RING_STEPS)
    exploded = f"{{supplier}} LATERAL VIEW inline(array({steps})) t AS ring, place, dx, dy"
    return spark.sql(VERTICES_SQL.replace("{steps}", exploded), supplier=table(spark, sf_dir, AREA_TABLE))


# Late records for some keys of two boroughs: moved, moved and then of another category, and
# with a position that can't be right. The order is that of the deliveries.
CORRECTIONS_SQL = [
    "CAST(ARREST_KEY AS BIGINT) % 5 = 0",
    "CAST(ARREST_KEY AS BIGINT) % 10 = 0",
    "CAST(ARREST_KEY AS BIGINT) % 15 = 0",
]


def corrections(flagged: DataFrame) -> DataFrame:
    """Flagged records that correct some of these, with the number of their delivery."""
    some = flagged.where("coord_valid AND ARREST_BORO IN ('K', 'Q')")
    first = some.where(CORRECTIONS_SQL[0]).selectExpr("*", "1 AS delivered").withColumns(
        {"ARREST_PRECINCT": F.col("ARREST_PRECINCT") + 100, "ARREST_BORO": F.lit("Q")}
    )
    second = first.where(CORRECTIONS_SQL[1]).withColumns({"LAW_CAT_CD": F.lit("V"), "delivered": F.lit(2)})
    third = first.where(CORRECTIONS_SQL[2]).withColumns({"coord_valid": F.lit(False), "delivered": F.lit(3)})
    return first.unionByName(second).unionByName(third)
