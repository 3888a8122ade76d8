"""What the corpus operators share: reading tables and cutting lineage in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.session import work_path

# A null id sorts before every other one; no real id takes this value.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: lost executors lose no finished part, and later reads prune columns.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_rows(df: DataFrame, most: int, *keys: str) -> list:
    """At most ``most`` rows, those of the least hash of ``keys``, as a list for the driver.

    The rows are counted first; all but those below a hash bound that leaves a little more than ``most``
    are dropped where they lie, so what is sent does not grow with their number.
    """
    total, draw = df.count(), F.xxhash64(*keys)
    if total > most:
        share = min(1.0, (1.1 * most + 1000) / total)
        df = df.where(draw < int(-(2 ** 63) + share * 2 ** 64) if share < 1 else F.lit(True))
    rows = df.withColumn("_draw", draw).collect()
    return sorted(rows, key=lambda r: (r["_draw"], *(r[k] for k in keys)))[:most]


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """Just the named columns, cast; a column that is missing is null.  Others are never read."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (df[f"`{have[name.lower()]}`"] if name.lower() in have else F.lit(None)).cast(kind)
        .alias(name) for name, kind in kinds.items()])


def ascii_lower(text: str) -> Column:
    """A-Z only; other letters keep their case.  Texts of plain ASCII take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
