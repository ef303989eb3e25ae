"""Text lines, delimited fields and SequenceFiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import java_split, parse_int


def read_lines(spark: SparkSession, paths: str | Sequence[str], position: bool = False) -> DataFrame:
    """One row per text line; ``position`` adds a sortable place in the files."""
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    if not position:
        return lines
    # Split offset first: ids grow within one split only.
    place = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    return lines.select("value", place.alias("position"))


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = "\t", *,
                    strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Positional fields of each line under the schema's names and types.

    Trailing empty fields count as absent and absent fields are NULL. A field that
    does not fit its type is NULL, or fails the job if ``strict``.
    """
    parts = lines.select(*keep, java_split(F.col("value"), sep).alias("_parts"))

    def field(index: int, f: T.StructField):
        text = F.get("_parts", F.lit(index))
        if isinstance(f.dataType, T.IntegerType):
            return parse_int(text, strict).alias(f.name)
        return (text.cast(f.dataType) if strict else text.try_cast(f.dataType)).alias(f.name)

    return parts.select(*keep, *[field(i, f) for i, f in enumerate(schema.fields)])


def tag_source(df: DataFrame, tags: Mapping[str, str], name: str = "type") -> DataFrame:
    """Tag rows by a piece of the path of the file they were read from.

    ``df`` must come straight from a file reader. The first matching piece wins.
    """
    tag = F.lit(None).cast("string")
    for piece, value in reversed(list(tags.items())):
        tag = F.when(F.contains(F.col("_metadata.file_path"), F.lit(piece)), F.lit(value)).otherwise(tag)
    return df.withColumn(name, tag)


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    """The text values of a SequenceFile with null keys, as ``value`` lines.

    Spark SQL has no reader for this format, so this goes through an RDD.
    """
    pairs = spark.sparkContext.sequenceFile(
        path, "org.apache.hadoop.io.NullWritable", "org.apache.hadoop.io.Text")
    return spark.createDataFrame(pairs.map(lambda pair: (pair[1],)), "value string")
