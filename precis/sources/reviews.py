"""Raw review files and the table of cleaned reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed values. Columns of the public customer review files, all of them text.
REVIEW_FILE_COLUMNS = (
    "marketplace",
    "customer_id",
    "review_id",
    "product_id",
    "product_parent",
    "product_title",
    "product_category",
    "star_rating",
    "helpful_votes",
    "total_votes",
    "vine",
    "verified_purchase",
    "review_headline",
    "review_body",
    "review_date",
)
REVIEW_SCHEMA = StructType([StructField(name, StringType()) for name in REVIEW_FILE_COLUMNS])


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    quote: str | None = '"',
    partitions: int | None = None,
) -> DataFrame:
    """Tab-separated reviews with a header, all strings, gzipped or not; a path may be a folder or a pattern.

    Without a schema the header names the columns. An unclosed quote at the start of a field takes in the next tab;
    `quote=""` reads quotes as plain characters. A gzipped file is one task: `partitions` spreads its rows after the
    scan, which pays when there are fewer files than cores.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", quote or "")
    if schema is not None:
        # Columns are matched by the schema's position, so a header in another order must not pass silently.
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    return df if partitions is None else df.repartition(partitions)


def read_damaged_reviews(spark: SparkSession, path: str | list[str], schema: StructType | None = None, header: str | None = None) -> DataFrame:
    """Every line of tab-separated reviews as a row: the schema's columns, `state` and `raw`.

    An unclosed quote at the start of a field swallows the tabs after it, so the line comes out with too few fields.
    `state` is `good` for lines that have all fields when quotes are read as quotes; `mended` for lines that have them only
    when quotes are plain characters, and those fields are given; `quarantined` for lines that have them neither way: their
    columns are null and `raw` holds the line, which is null for the others. No line is lost but the headers.

    Without a schema the first line of the first file names the columns. Lines equal to the header are headers, one per
    file; `header` says how it reads where that differs from the column names. Line breaks inside fields end a line.
    Files are read once.
    """
    if schema is None:
        schema = StructType([StructField(name, StringType()) for name in spark.read.option("sep", "\t").option("header", True).csv(path).columns])
    names = schema.fieldNames()
    header = "\t".join(names) if header is None else header
    lines = spark.read.text(path).filter((F.col("value") != header) & (F.col("value") != ""))
    checked = StructType([*(StructField(f"_f{i}", StringType()) for i in range(len(names))), StructField("_damaged", StringType())])
    options = {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"}
    quoted = F.from_csv("value", checked.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    plain = F.split("value", "\t", -1)
    read = lines.select("value", quoted.alias("_q"), plain.alias("_p"))
    # In the last field an unclosed quote has nothing to swallow, but the reader drops it.
    last = F.element_at("_p", -1)
    open_end = last.startswith('"') & ~(last.endswith('"') & (F.length(last) > 1))
    whole = F.size("_p") == len(names)
    state = F.when(F.col("_q._damaged").isNull() & ~(whole & open_end), "good").when(whole, "mended").otherwise("quarantined")
    read = read.withColumn("state", state)

    def field(at: int) -> Column:
        # An empty field is null, as it is when it is read by a CSV reader.
        mended = F.when(F.get("_p", F.lit(at)) != "", F.get("_p", F.lit(at)))
        return F.when(F.col("state") == "good", F.col(f"_q._f{at}")).when(F.col("state") == "mended", mended)

    return read.select(*(field(i).alias(name) for i, name in enumerate(names)), "state", F.when(F.col("state") == "quarantined", F.col("value")).alias("raw"))


def table_format(spark: SparkSession) -> str:
    """Delta where the session has it, else parquet."""
    extensions = spark.conf.get("spark.sql.extensions", None) or ""
    return "delta" if "DeltaSparkSessionExtension" in extensions else "parquet"


def save_cleaned(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Store a table, replacing what was there."""
    df.write.format(fmt or table_format(df.sparkSession)).mode("overwrite").save(path)


def load_cleaned(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return spark.read.format(fmt or table_format(spark)).load(path)
