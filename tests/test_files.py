from __future__ import annotations

import csv
import gzip
import json

import pytest
from pyspark.sql import functions as F

from precis.plans import flows
from precis.sources import pairs, reviews
from precis.streaming import summaries as streaming

TEXTS = ['he said "hi", ok', "  leading", "trailing  ", 'back\\"slash', "line\nbreak", "tab\there", "é", "a,b"]


def test_csv_pairs_survive_spark_and_other_readers(spark, tmp_path):
    df = spark.createDataFrame([(t, str(i)) for i, t in enumerate(TEXTS)], "text string, summary string")
    pairs.write_pairs_csv(df.coalesce(1), str(tmp_path / "train"))
    back = pairs.read_pairs(spark, str(tmp_path / "train"), formats={"train": "csv"}, multiline=True)
    assert sorted((r.summary, r.text, r.split) for r in back.collect()) == [(str(i), t, "train") for i, t in enumerate(TEXTS)]
    (file,) = (tmp_path / "train").glob("*.csv")
    with open(file, newline="", encoding="utf-8") as f:
        assert [(r["text"], r["summary"]) for r in csv.DictReader(f)] == [(t, str(i)) for i, t in enumerate(TEXTS)]


def test_split_table_is_written_to_a_folder_each(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", "train"), ("c", "d", "validation")], "text string, summary string, split string")
    pairs.write_pairs_csv(df, str(tmp_path / "out"))
    assert spark.read.options(**pairs.CSV_OPTIONS).csv(str(tmp_path / "out/split=train")).first() == ("a", "b")


def test_each_split_has_a_format_of_its_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,summary\nx,y\n")
    (tmp_path / "b.json").write_text(json.dumps({"text": "u", "summary": 5}) + "\n")
    got = pairs.read_pairs(spark, train=str(tmp_path / "a.csv"), test=str(tmp_path / "b.json"))
    assert sorted((r.split, r.text, r.summary) for r in got.collect()) == [("test", "u", "5"), ("train", "x", "y")]
    with pytest.raises(ValueError, match="cannot tell the format"):
        pairs.read_pairs(spark, train="x.txt")
    with pytest.raises(ValueError, match="no path given"):
        pairs.read_pairs(spark)


def test_reviews_from_gzipped_tsv(spark, tmp_path):
    path = tmp_path / "r.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write('product_id\treview_headline\treview_body\np1\t"open\tbody one\np2\thead\t"quoted field"\n')
    plain = reviews.read_reviews(spark, str(path), quote="", partitions=2).orderBy("product_id").collect()
    assert [tuple(r) for r in plain] == [("p1", '"open', "body one"), ("p2", "head", '"quoted field"')]
    assert all(f.dataType.simpleString() == "string" for f in reviews.read_reviews(spark, str(path)).schema)
    assert reviews.read_reviews(spark, str(path)).filter("product_id = 'p2'").first().review_body == "quoted field"


def test_a_schema_that_does_not_fit_the_header_is_refused(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("product_id\tother\np\tx\n")
    with pytest.raises(Exception, match="(?i)header"):
        reviews.read_reviews(spark, str(tmp_path / "r.tsv"), reviews.REVIEW_SCHEMA).collect()


def test_cleaned_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    reviews.save_cleaned(spark.range(3), path)
    reviews.save_cleaned(spark.range(2), path)
    assert reviews.load_cleaned(spark, path).count() == 2


def test_predictions_are_lines_in_order(spark, tmp_path):
    df = spark.range(100).repartition(7).select("id", F.concat(F.lit(" a\r\n"), F.col("id"), F.lit(" ")).alias("p"))
    pairs.write_predictions(df, str(tmp_path / "p"), "p", "id")
    text = "".join(f.read_text() for f in sorted((tmp_path / "p").glob("part-*")))
    assert text.splitlines() == [f"a {i}" for i in range(100)]


def test_metrics_are_one_record_per_split(spark, tmp_path):
    pairs.write_metrics(spark.createDataFrame([("a", 1.5), ("b", 2.5)], "split string, rouge1 double"), str(tmp_path / "m"))
    lines = [json.loads(x) for f in (tmp_path / "m").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted((x["split"], x["rouge1"]) for x in lines) == [("a", 1.5), ("b", 2.5)]


def test_prepare_reviews(spark, tmp_path):
    raw = tmp_path / "raw.tsv.gz"
    with gzip.open(raw, "wt") as f:
        f.write("product_id\treview_headline\treview_body\n")
        f.writelines(f"p{i % 5}\tHead <b>{i}</b>\tBody number {i}. &#34;\n" for i in range(200))
    paths = flows.prepare_reviews(spark, str(raw), str(tmp_path / "out"), fraction=0.5)
    cleaned = spark.read.parquet(paths["cleaned"])
    both = pairs.read_pairs(spark, paths["train"], paths["validation"], formats={"train": "csv", "validation": "csv"})
    assert 60 < cleaned.count() == both.count() < 140
    assert cleaned.filter("review_headline not rlike '^Head  [0-9]+$'").count() == 0
    assert both.select("text", "summary").exceptAll(cleaned.select("review_body", "review_headline")).count() == 0


def test_prepare_reviews_by_key(spark, tmp_path):
    """A sample by hash is split by another hash: both splits are there in their shares."""
    raw = tmp_path / "raw.tsv"
    lines = [f"r{i}\tp\thead {i}\tbody {i}\n" for i in range(2000)]
    raw.write_text("review_id\tproduct_id\treview_headline\treview_body\n" + "".join(lines))
    paths = flows.prepare_reviews(spark, str(raw), str(tmp_path / "out"), fraction=0.5, key="review_id")
    formats = {"train": "csv", "validation": "csv"}
    both = pairs.read_pairs(spark, paths["train"], paths["validation"], formats=formats)
    counts = dict(map(tuple, both.groupBy("split").count().collect()))
    assert 900 < sum(counts.values()) < 1100
    assert 0.75 < counts["train"] / sum(counts.values()) < 0.85


def test_stream_gives_each_text_once_over_restarts(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema("id bigint, text string").parquet(source)
        query = streaming.summarize_stream(stream, "text", lambda ts: [t.upper() for t in ts], sink, state, prefix=None, available_now=True)
        query.awaitTermination()
        return sorted((r.id, r.summary) for r in spark.read.parquet(sink).collect())

    spark.range(5).selectExpr("id", "concat('t', id) as text").write.parquet(source)
    assert run() == [(i, f"T{i}") for i in range(5)]
    spark.range(5, 8).selectExpr("id", "concat('t', id) as text").write.mode("append").parquet(source)
    assert run() == [(i, f"T{i}") for i in range(8)]


def test_extractive_stream(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, "b c. a a. b.")], "id int, text string").write.parquet(source)
    stats = spark.createDataFrame([("a", 8, 0.8), ("b", 1, 0.1), ("c", 1, 0.1)], "token string, count bigint, p double")
    for _ in range(2):
        stream = spark.readStream.schema("id int, text string").parquet(source)
        streaming.summarize_stream_extractive(stream, stats, "id", "text", sink, state, min_tokens=2, available_now=True).awaitTermination()
    assert [(r.id, r.summary) for r in spark.read.parquet(sink).collect()] == [(1, "a a.")]


def test_lines_that_a_quote_has_swallowed(spark, tmp_path):
    lines = {
        "a.tsv": ["id\ttitle\tbody", '1\tplain\tbody "quoted" inside', '2\t"open\tbody', '3\t"closed title"\tbody', '4\t"tab\tinside"\tbody'],
        "b.tsv": ["id\ttitle\tbody", "5\tshort", "6\ttoo\tmany\tfields", '7\tlast\t"open', "8\t\t", '9\t"never', "", "\t\t", "10\té\t" + "x" * 40_000],
    }
    for name, text in lines.items():
        (tmp_path / name).write_text("\n".join(text) + "\n")
    rows = reviews.read_damaged_reviews(spark, str(tmp_path)).collect()
    got = {r.id or r.raw or "": (r.state, r.title, r.body, r.raw) for r in rows}
    assert len(rows) == 11  # every line that isn't a header or empty
    assert got == {
        "1": ("good", "plain", 'body "quoted" inside', None),
        "2": ("mended", '"open', "body", None),
        "3": ("good", "closed title", "body", None),
        "4": ("good", "tab\tinside", "body", None),
        "5\tshort": ("quarantined", None, None, "5\tshort"),
        "6\ttoo\tmany\tfields": ("quarantined", None, None, "6\ttoo\tmany\tfields"),
        "7": ("mended", "last", '"open', None),
        "8": ("good", None, None, None),
        '9\t"never': ("quarantined", None, None, '9\t"never'),
        "": ("good", None, None, None),
        "10": ("good", "é", "x" * 40_000, None),
    }


def test_json_lines_of_any_shape(spark, tmp_path):
    lines = [
        '{"text": "a \\"b\\"", "summary": 3}', '{"text": [1, "x", null], "summary": {"b": 1, "a": [true]}}', '{"text": null}', "[1]", "not json", "",
        '{"summary": 1.50, "text": true, "other": {}}', '{"text": "", "summary": 12345678901234567890}', '{"it\'s": 1, "text": "t"}',
    ]
    (tmp_path / "x.json").write_text("\n".join(lines))
    rows = pairs.read_pairs(spark, train=str(tmp_path / "x.json"), fields=["text", "summary", "it's"]).collect()
    got = [(r.text, r.summary, r["it's"], r.split) for r in rows]
    want = [
        ('a "b"', "3", None), ('[1,"x",null]', '{"a":[true],"b":1}', None), (None, None, None), (None, None, None), (None, None, None),
        ("true", "1.5", None), ("", "12345678901234567890", None), ("t", None, "1"),
    ]
    assert sorted(map(repr, got)) == sorted(repr((*w, "train")) for w in want)


def test_a_text_that_is_delivered_again_has_one_summary(spark, tmp_path):
    """The same file twice in a run, once more after a restart, then new rows with a null key among them."""
    schema = "id int, text string"

    def deliver(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in" / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        streaming.summarize_stream(stream, "text", lambda texts: [t.upper() for t in texts], str(tmp_path / "out"), str(tmp_path / "state"), available_now=True, key="id", prefix="").awaitTermination()
        return sorted(map(repr, map(tuple, spark.read.parquet(str(tmp_path / "out")).select("id", "summary").collect())))

    rows = [(1, "a"), (2, "b")]
    deliver("first", rows)
    deliver("again", rows)
    assert run() == ["(1, 'A')", "(2, 'B')"]
    deliver("later", [*rows, (None, "c")])
    deliver("last", [(None, "c"), (3, None)])
    assert run() == ["(1, 'A')", "(2, 'B')", "(3, None)", "(None, 'C')"]
