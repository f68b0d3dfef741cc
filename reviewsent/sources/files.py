"""CSV and parquet sources and the parquet sink."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from reviewsent.schema import REVIEWS
from reviewsent.sources.shared import stage_table


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = REVIEWS,
             header: bool = False) -> DataFrame:
    """Quoted CSV with line breaks inside fields and ``"`` as its own escape.

    ``schema=None`` infers the types, at the price of one more pass over the file. A
    multi-line file cannot be split, so one file is one task: bring large data as many
    files, or read it with :func:`read_csv_split`, and convert it once with :func:`csv_to_parquet`.
    """
    reader = spark.read.option("header", header).option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def read_csv_split(spark: SparkSession, path: str | list[str], schema: StructType = REVIEWS, header: bool = False) -> DataFrame:
    """:func:`read_csv` of files of any size by as many tasks as they have ranges of bytes.

    A line break ends a record where the quotes before it are even in number. The ranges are read as lines; one pass
    counts the quotes per range, a sum over the ranges of a file (a row each) says in which state each range begins, and
    running sums inside the ranges number the records. Lines with one number are joined, those of records that reach
    across ranges after another shuffle, and parsed by Spark's CSV functions.

    A quote must not stand inside a field that is not quoted. The line end of a file is that of its first line,
    of Unix or of Windows; the latter is a plain line break inside fields. ``header`` leaves out
    the first record of each file; the names are those of ``schema``. Empty records are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    ranges, earlier = ["file", "range"], Window.partitionBy("file").orderBy("range")
    before = lambda column: (F.sum(column).over(earlier) - F.col(column))
    returned = F.col("line").endswith("\r")
    quotes = lines.groupBy(*ranges).agg(F.sum(_quotes(F.col("line"))).alias("quotes"), F.min_by(returned, "at").alias("returned"))
    windows = F.first("returned").over(earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    quotes = stage_table(quotes.select(*ranges, before("quotes").alias("quotes_before"), windows.alias("windows")), "quotes")

    so_far = Window.partitionBy(*ranges).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.col("quotes_before") + F.sum(_quotes(F.col("line"))).over(so_far) - _quotes(F.col("line"))
    begins = lines.join(quotes, ranges).withColumn("begins", (inside % 2 == 0).cast("int"))
    line = F.when(F.col("windows") & returned, F.substring("line", F.lit(1), F.length("line") - 1)).otherwise(F.col("line"))
    numbered = begins.select(*ranges, "at", line.alias("line"), F.sum("begins").over(so_far).alias("number"))
    # the lines of a record within its range, which lie together already
    parts = stage_table(numbered.groupBy(*ranges, "number").agg(
        F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines")).select(
        *ranges, "number", F.array_join(F.transform("lines", lambda p: p["line"]), "\n").alias("text")), "records")
    counts = parts.groupBy(*ranges).agg(F.max("number").alias("records"))
    counts = stage_table(counts.select(*ranges, "records", before("records").alias("records_before")), "counts")
    # lines before the first record of a range have number 0, and so belong to the last one before
    parts = parts.join(counts, ranges).withColumn("record", F.col("number") + F.col("records_before"))
    at_border = (F.col("number") == 0) | (F.col("number") == F.col("records"))
    joined = parts.where(at_border).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("range", "text"))).alias("parts"))
    joined = joined.select("record", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    records = parts.where(~at_border).select("record", "text").unionByName(joined)
    records = records.where(F.col("text") != "")
    if header:
        records = records.where(F.col("record") > 1)
    parsed = F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"', "multiLine": "true"})
    return records.select(parsed.alias("row")).select(*(F.col("row")[name].alias(name) for name in schema.names))


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV that :func:`read_csv` reads back as it was, but for empty strings, which become null."""
    (df.write.mode("overwrite").option("header", header).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def rename_columns(df: DataFrame, *names: str) -> DataFrame:
    """Name all columns by position."""
    return df.toDF(*names)


def read_stage(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet stage table, only the named columns if any are named."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_verified(df: DataFrame, path: str) -> DataFrame:
    """Overwrite ``path`` with ``df``, read it back and compare the row counts.

    The written rows are counted while they are written, not in a second run of the plan.
    """
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    rows = back.count()
    if rows != written.get["rows"]:
        raise RuntimeError(f"{path}: wrote {written.get['rows']} rows, read back {rows}")
    return back


def csv_to_parquet(spark: SparkSession, csv_path: str | list[str], parquet_path: str,
                   schema: StructType | None = REVIEWS, header: bool = False,
                   key: str | None = "doc_id", split: bool = False) -> DataFrame:
    """Convert CSV to parquet and return the written table: without a shuffle, a task per file, or with ``split``
    by :func:`read_csv_split`.

    Reviews have no row key, so each row gets one. It depends on the order of the
    input files, which is why it is written with the rows and never computed again.
    """
    df = (read_csv_split if split else read_csv)(spark, csv_path, schema, header)
    if key:
        df = df.select(F.monotonically_increasing_id().alias(key), "*")
    return write_verified(df, parquet_path)
