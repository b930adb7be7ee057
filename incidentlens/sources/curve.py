"""Records stored along a curve, so that filters on any of several columns skip files.

Sorted by one column, files are narrow in that one and as wide as the whole in the others.
Here every column is cut at its quantiles into 64 parts of about equal size, and the bits
of the parts' numbers are interleaved: records that are near each other on this curve are
near in all columns, and the minima and maxima in file footers become narrow in each.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlens.schema import PARTITION_COLUMN

CURVE_COLUMNS = ("ARREST_PRECINCT", "ARREST_DATE", "Latitude", "Longitude")
BITS = 6
# Relative error of the quantiles: a tenth of a part.
_ACCURACY = 10 << BITS
_SEED = 23


def _number(name: str, df: DataFrame) -> Column:
    value = F.col(name)
    return F.unix_date(value) if dict(df.dtypes)[name] == "date" else value.cast("double")


def cut_points(df: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """The quantiles that part each column, rising and without repeats; from one scan of them.

    A value that many records share is one cut point, so its records stay together.
    """
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = df.agg(*[F.percentile_approx(_number(c, df), shares, _ACCURACY).alias(c) for c in columns]).first()
    return [sorted(set(found[c] or [])) for c in columns]


def curve_position(df: DataFrame, columns: Sequence[str], cuts: list[list[float]]) -> Column:
    """The place on the curve: a bigint of ``BITS`` bits for every column; missing values are low."""
    parts = []
    for name, points in zip(columns, cuts, strict=True):
        number = _number(name, df).cast("double")
        constant = F.array(*map(F.lit, map(float, points))) if points else F.array().cast("array<double>")
        below = F.size(F.filter(constant, lambda point: point <= number))
        parts.append(F.coalesce(below, F.lit(0)).cast("bigint"))
    place = F.lit(0).cast("bigint")
    for bit in range(BITS):
        for i, part in enumerate(parts):
            one = F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(parts) + i))
    return place


def write_along_curve(
    df: DataFrame, path: str, columns: Sequence[str] = CURVE_COLUMNS, rows_per_file: int = 2_000_000
) -> None:
    """Replace the dataset at ``path``: a directory per borough, files along the curve.

    The ranges are cut by sampled size, also within one place that many records share, so
    a borough with a third of all records has a third of the files.
    """
    files = max(1, -(-df.count() // rows_per_file))
    placed = df.withColumns(
        {"_place": curve_position(df, columns, cut_points(df, columns)), "_tie": F.rand(_SEED)}
    )
    (
        placed.repartitionByRange(files, PARTITION_COLUMN, "_place", "_tie")
        .sortWithinPartitions(PARTITION_COLUMN, "_place")
        .drop("_place", "_tie")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )
