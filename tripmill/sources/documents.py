"""Stored files and documents: catalogue, JSON objects, text and table previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import settings as S

CORRUPT = "_corrupt_record"


def dataset_catalog(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Key, size and time of every file under ``root`` that ends in ``suffix``.

    The file content is a column of this source too, but it is not selected and so not read. Tasks
    are still planned by file size: for very many large files set
    ``spark.sql.files.maxPartitionNum``.
    """
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(
            F.col("path").alias("key"), F.col("length").alias("size"),
            F.col("modificationTime").alias("last_modified"),
        )
        .where(F.col("key").endswith(suffix))
    )


def read_json_docs(spark: SparkSession, path: str, schema: str,
                   one_object_per_file: bool = False) -> DataFrame:
    """JSON objects by a declared schema; text that is no object is kept in ``_corrupt_record``.

    JSON lines split into many tasks; ``one_object_per_file`` reads each file as one object.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING")
        .option("multiLine", str(one_object_per_file).lower())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def text_preview(text: Column) -> list[Column]:
    """The beginning of a text, marked if cut, and the length of the whole text."""
    shown = F.when(
        F.length(text) > S.PREVIEW_CHARACTERS,
        F.concat(F.substring(text, 1, S.PREVIEW_CHARACTERS), F.lit("...")),
    ).otherwise(text)
    return [shown.alias("content"), F.length(text).cast("bigint").alias("full_length")]


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: its key, preview and full length."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("key"), *text_preview(F.col("value")))


def table_preview(df: DataFrame, *key: str) -> DataFrame:
    """First rows by ``key`` beside the row count and the column names of the whole table.

    The count is a scalar subquery (an aggregate without columns) and the first rows are a top-k
    per task, so no sort of the table takes place.
    """
    rows = df.select(F.count(F.lit(1))).scalar()
    return df.orderBy(*key).limit(S.PREVIEW_ROWS).select(
        rows.alias("row_count"), F.lit(",".join(df.columns)).alias("column_names"), "*"
    )
