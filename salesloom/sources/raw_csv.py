"""CSV by RFC 4180: quotes are doubled, quoted text may hold commas and line breaks, blank (quoted) and NULL (nothing) differ.

Files are read with their schema in one pass. A quoted line break stops Spark from splitting a file, so large files are only split where
there is none: ``line_breaks=None`` looks for one first, in a parallel scan of the lines, True and False are for those who know.

``ordered=True`` adds ``file_position``, by which rows sort as they stand in the files: name of the file (numbers in it count as numbers),
start of the block that a task read, and the row within the block. The number of a row depends on the rows before it in the same task
only through an offset, so the order within a block is the file's however Spark deals out the blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import schemas
from salesloom.session import shuffles_dropped
from salesloom.sources.tables import RawTables

OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": ""}
CORRUPT = "_corrupt_record"
#: Stands for a quoted blank between Spark's reader and read_csv(); a private character, whose own fields private_marks() counts.
_BLANK = "\ue000"
POSITION = "file_position"


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a field may hold a line break: some line of the files has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def private_marks(spark: SparkSession, path: str) -> int:
    """Lines with a field that is the private character and would be read as a blank."""
    return spark.read.text(path).where(F.col("value").rlike(f'(^|,)"?{_BLANK}"?(,|$)')).count()


def _position() -> Column:
    name = F.col("_metadata.file_name")
    part = lambda k: F.regexp_extract(name, r"^(\D*)(\d*)(.*)$", k)
    return F.struct(
        part(1).alias("name"), F.coalesce(F.expr(r"try_cast(regexp_extract(_metadata.file_name, '^(\\D*)(\\d*)(.*)$', 2) AS decimal(38,0))"), F.lit(0)).alias("number"),
        part(3).alias("rest"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _scan(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool | None, ordered: bool = False) -> DataFrame:
    if line_breaks is None:
        line_breaks = has_line_breaks(spark, path)
    df = spark.read.schema(schema).options(**OPTIONS, mode="PERMISSIVE", multiLine=line_breaks, emptyValue=_BLANK,
                                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    if ordered:
        df = df.select("*", _position().alias(POSITION))
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType) and f.name != CORRUPT]
    return df.withColumns({c: F.when(F.col(c) == _BLANK, "").otherwise(F.col(c)) for c in texts}) if texts else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool | None = None, ordered: bool = False) -> DataFrame:
    return _scan(spark, path, schema, line_breaks, ordered)


def write_csv(df: DataFrame, path: str, compression: str = "none", mode: str = "overwrite") -> str:
    """CSV part files with a header; NULL is written as nothing, a blank as a pair of quotes. Packed files, as ``gzip`` makes them, are read back like others."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).options(**OPTIONS, emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression).csv(path)
    return path


def read_raw(spark: SparkSession, folder: str, line_breaks: bool | None = None, ordered: bool = False) -> RawTables:
    """``folder`` holds customers.csv, products.csv, orders.csv, order_items.csv and returns.csv.

    Each may be one file or a directory of part files. Values that don't fit their type are read as NULL; corrupt_rows() counts their
    rows. With ``ordered`` the cleaning rules keep the first of several rows of a key as it stands in the files (C1).
    """
    return RawTables(**{name: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema, line_breaks, ordered) for name, schema in schemas.RAW.items()})


def corrupt_rows(spark: SparkSession, folder: str, line_breaks: bool | None = None) -> DataFrame:
    """Rows per raw file, and those with a value that doesn't fit its type or with too many or too few columns."""
    def count(name: str, schema: T.StructType) -> DataFrame:
        df = _scan(spark, f"{folder.rstrip('/')}/{name}.csv", T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]), line_breaks)
        # a hash of all columns goes along, else the reader would skip their values and find nothing wrong
        counted = df.agg(F.count(F.lit(1)).alias("row_count"), F.bit_xor(F.hash(*schema.fieldNames())).alias("h"),
                         F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"))
        return counted.select(F.lit(name).alias("table_name"), "row_count", F.when(F.col("h").isNull(), 0).otherwise(F.col("bad")).alias("corrupt_count"))

    return reduce(DataFrame.unionByName, [count(n, s) for n, s in schemas.RAW.items()])
