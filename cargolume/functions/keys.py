"""Content-addressed keys and row hashes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume.schemas import ROUTE_COLUMNS

SEPARATOR = "\x1f"  # cannot occur in a city or vehicle name
NULL_MARK = "\x1e"  # concat_ws would drop a null and let two keys meet


def route_key(columns=ROUTE_COLUMNS, digits=10) -> Column:
    """RT- plus the first hex digits of sha1 over the natural key.

    The key needs no join, does not depend on row order, and never changes when routes are added.
    40 bits suit some thousands of routes; pass more digits for millions.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.concat(F.lit("RT-"), F.substring(F.sha1(F.concat_ws(SEPARATOR, *parts)), 1, digits))


def spread_key(column="Shipment_ID") -> Column:
    """Uniform text order over ids: the tie-break for every order inside a day or class.

    A hash prefix splits a hot day or class into equal slices that keep the order.
    """
    return F.sha1(F.col(column).cast("string"))


def uniform(seed, *columns) -> Column:
    """A repeatable number in [0, 1) per row, independent of partitioning and retries."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def row_digest(df: DataFrame) -> list[Column]:
    cols = [F.col(c) for c in df.columns]
    return [F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)"), F.xxhash64(F.lit(2), *cols).cast("decimal(38,0)")]
