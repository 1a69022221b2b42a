"""What several text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import fresh_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes an Arrow batch may hold: long texts arrive a few hundred at a time, not ten thousand.
BATCH_BYTES = 2 << 20


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need no installed
    copy of it."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves the file to the executors as long as the application lives.
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted([*package.rglob("*.py"), *package.rglob("*.txt")]):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)


def for_python(spark: SparkSession) -> None:
    """Ready the session for Python functions: the package is sent, and the bytes that Spark hands over
    at once are bounded; a smaller bound of the user stays. Short rows still go in large batches."""
    send_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(spark.conf.get(key, None) or 0)
    if held <= 0 or held > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def n_words(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: the rows as a table in the shared folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Words of 64 bits that a filter of keys has; a table of that many rows, 2 MB, goes to every task.
FILTER_WORDS = 131_072


def maybe_in(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the one column of ``keys`` (64-bit hashes), and the others.

    Keys set bits of a table of bounded size, which is sent to the rows, so that rows which are surely
    none need no shuffle. With very many keys all bits are set; the first part is then all rows.
    """
    bit = F.pmod(F.col(keys.columns[0]), F.lit(FILTER_WORDS * 64))
    words = keys.select((bit / 64).cast("int").alias("_word"),
                        F.expr("1L").alias("_one"), (bit % 64).cast("int").alias("_bit")).select(
        "_word", F.call_function("shiftleft", F.col("_one"), F.col("_bit")).alias("_bits")) \
        .groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    words = written(words, fresh_folder(rows.sparkSession, "filter"))  # as often as it is read
    held = F.pmod(key, F.lit(FILTER_WORDS * 64))
    marked = rows.withColumn("_at", held).withColumn("_word", (F.col("_at") / 64).cast("int")).join(
        F.broadcast(words), "_word", "left")
    is_in = F.coalesce(F.call_function(
        "shiftrightunsigned", F.col("_bits"), (F.col("_at") % 64).cast("int")).bitwiseAND(F.lit(1))
        == 1, F.lit(False))
    return (marked.where(is_in).select(*rows.columns), marked.where(~is_in).select(*rows.columns))
