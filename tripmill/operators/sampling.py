"""Exact seeded samples and slices without a global sort.

Rows are ordered by the MD5 of seed and unique key. The first and the last row of a slice are found by
counting hash prefixes: at most 65,536 counts come to the driver whatever the table size, and a
prefix that still holds many rows is counted again by longer prefixes. The slice itself is then one
scan that keeps the rows between the two; its rows come in no particular order, whatever its size.

Where slices of one table are asked for again and again, ``store_ranked`` lays it out by the hash once and
keeps the counts beside it; a slice then reads its own part of the files.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill import settings as S
from tripmill.operators.events import trip_to_envelope, trip_to_ride_event
from tripmill.operators.validation import validate_envelopes

PREFIX_CHARACTERS = 4  # hexadecimal, so 16 ** 4 prefixes are counted at once
HASH_CHARACTERS = 32
FEW = 10_000           # rows of one prefix that are ordered instead of counted further
HASH = "_hash"         # column of a stored order
ROW_GROUP_BYTES = 1 << 20
PART_ROWS = 500_000    # rows of a file of a stored order, which a task sorts without spilling


def seeded_order(key: str, seed: int = S.SAMPLE_SEED) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def _counts(hashed: DataFrame, prefix: str) -> list[tuple[str, int]]:
    """Rows by the next characters after a prefix, in order."""
    longer = F.substring("_hash", 1, len(prefix) + PREFIX_CHARACTERS)
    return sorted((r["p"], r["count"]) for r in hashed.where(F.col("_hash").startswith(prefix))
                  .groupBy(longer.alias("p")).count().collect())


def _bound(hashed: DataFrame, key: str, counts: list[tuple[str, int]], position: int):
    """Hash and key of the row at a position; nothing beyond the last row."""
    while True:
        for prefix, n in counts:
            if position < n:
                break
            position -= n
        else:
            return None
        if n <= FEW or len(prefix) >= HASH_CHARACTERS:
            group = hashed.where(F.col("_hash").startswith(prefix)).select("_hash", key)
            return group.orderBy("_hash", key).offset(position).limit(1).first()
        counts = _counts(hashed, prefix)


def rank_slice(df: DataFrame, key: str, start: int, stop: int,
               seed: int = S.SAMPLE_SEED) -> DataFrame:
    """The rows at positions ``start`` to ``stop - 1`` of the seeded order; ``key`` is unique."""
    if start < 0 or stop < start:
        raise ValueError("positions must satisfy 0 <= start <= stop")
    keys = df.select(key).withColumn("_hash", seeded_order(key, seed))
    counts = _counts(keys, "")
    total = sum(n for _, n in counts)
    if start >= min(stop, total):
        return df.limit(0)
    order = F.struct(seeded_order(key, seed).alias("_hash"), F.col(key).alias("_key"))

    def at(position: int) -> Column:
        found = _bound(keys, key, counts, position)
        return F.struct(F.lit(found["_hash"]).alias("_hash"), F.lit(found[key]).alias("_key"))

    wanted = F.lit(True)
    if start:
        wanted &= order >= at(start)
    if stop < total:
        wanted &= order <= at(stop - 1)
    return df.where(wanted)


# ---- stored order ------------------------------------------------------------------------------------

ROWS, DIRECTORY = "rows", "directory"


@dataclass(frozen=True)
class RankedTable:
    """A table laid out in its seeded order, with a directory of how many rows each hash prefix has."""

    path: str
    key: str
    schema: StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        stored = StructType([StructField(HASH, StringType()), *self.schema.fields])
        return spark.read.schema(stored).parquet(f"{self.path}/{ROWS}")

    def counts(self, spark: SparkSession) -> list[tuple[str, int]]:
        """At most 65,536 rows, whatever the size of the table."""
        found = spark.read.schema("prefix string, n long").parquet(f"{self.path}/{DIRECTORY}").collect()
        return sorted((r["prefix"], r["n"]) for r in found)


def store_ranked(df: DataFrame, key: str, path: str, seed: int = S.SAMPLE_SEED,
                 parts: int | None = None) -> RankedTable:
    """Lay a table out by the hash of seed and unique key and count its prefixes.

    Each file holds a range of hashes in order, in row groups that are small beside it, so a later range
    of hashes reads only the groups it touches. Without ``parts`` there is a file for every
    ``PART_ROWS`` rows, and at least as many as the session shuffles into. Rows are dealt by the hash, but
    it is added behind the shuffle.
    """
    if HASH in df.columns:
        raise ValueError(f"the table has a column {HASH}")
    # Hashes are even, so ranges of equal width hold equally many rows: no sampling pass is needed.
    n = parts or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                     math.ceil(df.count() / PART_ROWS))
    place = F.floor(F.conv(F.substring(seeded_order(key, seed), 1, 8), 16, 10).cast("long") * n / 2 ** 32)
    dealt = df.repartitionById(n, F.coalesce(place.cast("int"), F.lit(0)))
    hashed = dealt.withColumn(HASH, seeded_order(key, seed)).select(
        HASH, *[F.col(f"`{c}`") for c in df.columns])
    hashed.sortWithinPartitions(HASH, key).write.mode("overwrite").option(
        "parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", ROW_GROUP_BYTES // 16).option(
        "compression", "zstd").parquet(f"{path}/{ROWS}")
    table = RankedTable(path, key, df.schema)
    table.rows(df.sparkSession).groupBy(
        F.substring(HASH, 1, PREFIX_CHARACTERS).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/{DIRECTORY}")
    return table


def stored_slice(spark: SparkSession, table: RankedTable, start: int, stop: int) -> DataFrame:
    """The rows at positions ``start`` to ``stop - 1``, as one scan between two hashes.

    The directory names the prefixes of both ends; only the rows of these two are read to find where
    the slice begins and ends.
    """
    if start < 0 or stop < start:
        raise ValueError("positions must satisfy 0 <= start <= stop")
    rows, counts = table.rows(spark), table.counts(spark)
    total = sum(n for _, n in counts)
    names = [F.col(f"`{f.name}`") for f in table.schema.fields]
    if start >= min(stop, total):
        return rows.limit(0).select(*names)
    key = F.col(f"`{table.key}`")
    wanted = F.lit(True)
    if start:
        first = _bound(_in_prefixes(rows, counts, start), table.key, counts, start)
        wanted &= (F.col(HASH) >= first[HASH]) & ((F.col(HASH) > first[HASH])
                                                  | (key >= F.lit(first[table.key])))
    if stop < total:
        last = _bound(_in_prefixes(rows, counts, stop - 1), table.key, counts, stop - 1)
        wanted &= (F.col(HASH) <= last[HASH]) & ((F.col(HASH) < last[HASH])
                                                 | (key <= F.lit(last[table.key])))
    return rows.where(wanted).select(*names)


def _in_prefixes(rows: DataFrame, counts: list[tuple[str, int]], position: int) -> DataFrame:
    """The rows of the prefix that holds a position, as a range that the scan can use."""
    for prefix, n in counts:
        if position < n:
            return rows.where((F.col(HASH) >= prefix) & (F.col(HASH) <= prefix + "g"))
        position -= n
    return rows.limit(0)


def stored_record(spark: SparkSession, table: RankedTable, index: int) -> DataFrame:
    """The row at a position of the stored order; an index beyond the table is an error."""
    if index < 0 or index >= sum(n for _, n in table.counts(spark)):
        raise IndexError(f"record index {index} is out of range")
    return stored_slice(spark, table, index, index + 1)


def seeded_sample(df: DataFrame, key: str, n: int | None = None,
                  seed: int = S.SAMPLE_SEED) -> DataFrame:
    """Exactly ``n`` rows; all rows if ``n`` is absent, zero or not below the row count."""
    return rank_slice(df, key, 0, n, seed) if n else df


def record_at_index(df: DataFrame, key: str, index: int, seed: int = S.SAMPLE_SEED) -> DataFrame:
    """The row at a position of the seeded order; an index beyond the table is an error.

    The counts tell both, so the row itself is not looked up before the caller asks for it.
    """
    keys = df.select(key).withColumn("_hash", seeded_order(key, seed))
    found = _bound(keys, key, _counts(keys, ""), index) if index >= 0 else None
    if found is None:
        raise IndexError(f"record index {index} is out of range")
    return df.where(F.col(key) == found[key])


def batch_slice(trips: DataFrame | RankedTable, key: str, start: int, size: int,
                seed: int = S.SAMPLE_SEED) -> DataFrame:
    """Consecutive rows of the seeded order as envelopes; bad rows carry a reason, the rest goes
    on. Of a stored order only the slice is read."""
    if isinstance(trips, RankedTable):
        spark = SparkSession.getActiveSession()
        return trip_to_envelope(stored_slice(spark, trips, start, start + size))
    return trip_to_envelope(rank_slice(trips, key, start, start + size, seed))


def shuffled_replay(trips: DataFrame, key: str, max_events: int | None = None,
                    seed: int = S.SAMPLE_SEED) -> DataFrame:
    """Ride events in seeded random order, all of them or the first ``max_events``."""
    rows = rank_slice(trips, key, 0, max_events, seed) if max_events else trips
    return trip_to_ride_event(rows.orderBy(seeded_order(key, seed), key))


def load_transform_validate(trips: DataFrame | RankedTable, key: str, start: int, size: int,
                            check_zones: bool = False) -> DataFrame:
    """Slice, envelope and validation as one plan over one scan; ``error`` is the first problem."""
    return validate_envelopes(batch_slice(trips, key, start, size), check_zones)
