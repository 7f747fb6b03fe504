"""Training pairs, predictions and metrics as files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions.text import strip

# Quotes doubled inside quoted fields and spaces kept: what other CSV readers and writers expect.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_pairs(
    spark: SparkSession,
    train: str | None = None,
    validation: str | None = None,
    test: str | None = None,
    multiline: bool = False,
    formats: dict[str, str] | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """The given splits as one table with a `split` column. Each path ends in `.csv` or `.json` (JSON lines).

    All columns are strings, JSON values in their JSON spelling, so splits of different formats fit together.
    `formats` names the format of a split whose path has no such ending, such as a folder of part files. `multiline`
    lets quoted CSV fields hold line breaks, at the price of one task per file; cleaned texts have none.

    Without `fields` a JSON file is read twice, first for the names it holds. With them it is read once, each line as a
    value of whatever shape, see `read_json_fields`.
    """
    paths = {"train": train, "validation": validation, "test": test}
    paths = {split: path for split, path in paths.items() if path is not None}
    if not paths:
        raise ValueError("no path given for any split")
    tables = []
    for split, path in paths.items():
        fmt = (formats or {}).get(split, path.rstrip("/").split(".")[-1])
        if fmt not in ("csv", "json"):
            raise ValueError(f"cannot tell the format of split {split!r} from {path!r}; pass it in `formats`")
        if fmt == "csv":
            df = spark.read.options(**CSV_OPTIONS, multiLine=multiline).csv(path)
        else:
            df = spark.read.json(path, primitivesAsString=True) if fields is None else read_json_fields(spark, path, fields)
        tables.append(df.withColumn("split", F.lit(split)))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def read_json_fields(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """The named top-level fields of JSON lines as strings, in one job and without inferring a schema.

    Lines may differ in shape: a field that a line lacks, or holds as JSON null, is null; strings come as they are, numbers
    and truth values as text, arrays and objects in their JSON spelling with keys in order. A line that is no object has
    no fields, nor has one that is no JSON.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.try_parse_json("value").alias("_line"))
    return lines.select(*(F.try_variant_get("_line", f"$[{_quoted(name)}]", "string").alias(name) for name in fields))


def _quoted(name: str) -> str:
    """A name as a step of a path."""
    if "'" in name and '"' in name:
        raise ValueError(f"a field's name can't hold both kinds of quotes: {name!r}")
    return f'"{name}"' if "'" in name else f"'{name}'"


def write_pairs_csv(df: DataFrame, path: str) -> None:
    """Pairs as CSV part files with a header, written by the executors. Tables with a `split` get a folder each."""
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS)
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.csv(path)


def write_predictions(df: DataFrame, path: str, prediction: str, key: str) -> None:
    """One prediction per line in order of `key`, over part files in name order; line breaks become spaces."""
    line = strip(F.regexp_replace(F.coalesce(F.col(prediction), F.lit("")), r"\s*[\r\n]+\s*", " "))
    df.select(key, line.alias("value")).orderBy(key).select("value").write.mode("overwrite").text(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """One JSON record per split."""
    df.write.mode("overwrite").json(path)
