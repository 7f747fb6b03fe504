"""WARC archives: written with revisit records, read back by verified chains of record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precis.functions.text import let
from precis.llm.common import saved

# Fixed by the format.
MAGIC = "WARC/1.1"
BREAK = "\r\n"
GAP = "\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: each five hexadecimal digits are four letters."""

    def letters(hexed: Column) -> Column:
        groups = [F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
        letter = lambda v, shift: F.substring(F.lit(_ALPHABET), F.shiftright(v, shift) % 32 + 1, F.lit(1))
        return F.concat(*(let(g, lambda v: F.concat(*(letter(v, s) for s in (15, 10, 5, 0)))) for g in groups))

    return let(F.sha1(payload), letters)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """`(record)`: one WARC record per row, without the gap that ends it.

    Of rows with equal payloads of at least `least` bytes, that with the smallest key is a response and the others
    revisit it; smaller ones are all responses. A null payload is empty, a null key comes after all others, and rows
    of one key and payload are alike. Line breaks in a url are dropped, as a header can't hold them.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    own = pages.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{url}`").alias("_url"), payload.alias("_html"))
    own = own.withColumn("_digest", payload_digest(F.encode("_html", "UTF-8"))).withColumn("_size", F.octet_length("_html"))
    # Counted by task before the shuffle; only digests that occur again are joined back.
    again = own.filter(F.col("_size") >= least).groupBy("_digest").agg(F.min("_key").alias("_first"), F.count("*").alias("_n"))
    again = saved(again.filter("_n > 1 and _first is not null").select("_digest", "_first"), "warc-repeats")
    typed = own.join(again, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_first")) & (F.col("_size") >= least)
    number = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("_size").cast("string"), F.lit(GAP)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("_html")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    head = F.concat(
        F.lit(f"{MAGIC}{BREAK}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", number(F.col("_key"))),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("_url", "[\r\n]+", "")), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", number(F.col("_first"))), line("WARC-Profile", F.lit(_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
    )
    return typed.select(let(block, lambda b: F.concat(head, line("Content-Length", F.octet_length(b).cast("string")), F.lit(BREAK), b)).alias("record"))


def write(pages: DataFrame, path: str, records_per_file: int = 2000, **settings) -> None:
    """Writes the records as archive files below `path`, each closed by an empty line pair; files stay splittable."""
    made = records(pages, **settings).write.option("lineSep", GAP).option("maxRecordsPerFile", records_per_file)
    made.option("compression", "none").text(path)


class _Record:
    """A candidate: takes the bytes that follow its header until its block is full."""

    def __init__(self, place: int, header: bytes, keep: bool):
        fields = dict(re.findall(rb"(?m)^([A-Za-z-]+):[ \t]*(.*?)\r?$", header))
        fields = {name.lower(): value.decode("utf-8", "replace") for name, value in fields.items()}
        self.place, self.kind = place, fields.get(b"warc-type")
        self.key = _page(fields.get(b"warc-record-id"))
        self.refers = _page(fields.get(b"warc-refers-to"))
        self.url = fields.get(b"warc-target-uri")
        self.stated = (fields.get(b"warc-payload-digest") or "").removeprefix("sha1:") or None
        length = fields.get(b"content-length", "")
        self.valid = length.isdigit() and len(length) < 16
        self.length = int(length) if self.valid else 0
        self.after = place + len(header) + 2 * len(GAP) + self.length
        self.http, self.seen = b"", 0
        self.in_payload = not fields.get(b"content-type", "").startswith("application/http")
        self.size, self.sha1 = 0, hashlib.sha1()
        self.held: list[bytes] | None = [] if keep else None

    @property
    def full(self) -> bool:
        return self.seen >= self.length

    def take(self, data: bytes) -> None:
        data = data[: self.length - self.seen]
        self.seen += len(data)
        if not self.in_payload:
            self.http += data
            head, gap, data = self.http.partition(GAP.encode())
            self.in_payload = bool(gap)
            if not gap:
                return
            self.http = head
        self.size += len(data)
        self.sha1.update(data)
        if self.held is not None:
            self.held.append(data)

    def row(self) -> tuple:
        size, digest = self.size, base64.b32encode(self.sha1.digest()).decode()
        if self.kind == "revisit":  # its payload is that of the record it refers to
            stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", self.http)
            size, digest = int(stated[1]) if stated else None, self.stated
        body = b"".join(self.held) if self.held is not None else None
        return self.kind, self.key, self.url, self.refers, size, digest, self.stated in (None, digest), body


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


_FIELDS = "kind string, key bigint, url string, refers_to bigint, payload_bytes bigint, payload_digest string, intact boolean, payload binary"
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every empty line pair, in order within each split; any file system that Spark reads."""
    read = spark.read.option("lineSep", GAP).text(path)
    file = F.xxhash64("_metadata.file_path").alias("file")
    return read.select(file, F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("piece"))


def _scan(pieces: DataFrame, keep: bool) -> DataFrame:
    """Candidates of every split, and a row per split with its length (`kind` null, `place` null).

    A candidate is any line that reads like the start of a record, also one inside a payload. `place` and `after`, its
    successor, count from where the split's pieces begin. A block that the split doesn't end in has `whole` false.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, waiting, rows = None, 0, [], []
        start = re.compile(rb"(?:\A|\n)(" + re.escape(MAGIC.encode()) + rb"\r\n)")

        def done(records: list[_Record], whole: bool) -> None:
            rows.extend((*now, r.place, r.after, whole, *(r.row() if whole else (r.kind, *[None] * 7))) for r in records)

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *_KINDS]
            names = ["file", "split", "place", "after", "whole", *(f.split()[0] for f in _FIELDS.split(", "))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
            rows.clear()
            return made

        for batch in batches:
            files, splits, values = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                here = files[i].as_py(), splits[i].as_py()
                if here != now:
                    if now:
                        done(waiting, False)
                        rows.append((*now, None, at, None, *[None] * 8))
                    now, at, waiting = here, 0, []
                piece = values[i].as_py()
                whole = piece + GAP.encode()
                for record in waiting:
                    record.take(whole)
                if any(r.full for r in waiting):
                    done([r for r in waiting if r.full], True)
                    waiting = [r for r in waiting if not r.full]
                for found in start.finditer(piece):
                    record = _Record(at + found.start(1), piece[found.start(1) :], keep)
                    if record.valid:
                        waiting.append(record)
                if any(r.full for r in waiting):  # an empty block
                    done([r for r in waiting if r.full], True)
                    waiting = [r for r in waiting if not r.full]
                at += len(whole)
            yield batch_of()
        if now:
            done(waiting, False)
            rows.append((*now, None, at, None, *[None] * 8))
            yield batch_of()

    return pieces.mapInArrow(candidates, f"file bigint, split bigint, place bigint, after bigint, whole boolean, {_FIELDS}")


def reachable(successors: DataFrame) -> DataFrame:
    """`(file, at)`: of `(file, at, after)`, the places that the chain from place 0 of the file comes through.

    Pointer jumping: in each round every place jumps twice as far as before, and what a reached place jumps to is
    reached, so the number of rounds is the logarithm of the longest chain. Tables are stored between rounds.
    """
    nodes = saved(successors.select("file", "at", F.col("after").alias("to"), (F.col("at") == 0).alias("reached")), "warc-chain")
    while True:
        a = nodes.filter("to is not null").select("file", F.col("at").alias("from"), F.col("to").alias("at"), F.col("reached").alias("r"))
        both = a.join(nodes.select("file", "at", "to"), ["file", "at"])
        own = nodes.select("file", "at", F.lit(None).cast("long").alias("to"), "reached")
        far = both.select("file", F.col("from").alias("at"), "to", F.col("r").alias("reached"))
        met = both.select("file", "at", F.lit(None).cast("long"), "r")
        nodes = own.union(far).union(met).groupBy("file", "at").agg(F.max("to").alias("to"), F.max("reached").alias("reached"))
        nodes = saved(nodes, "warc-chain")
        if not nodes.filter("reached and to is not null").limit(1).count():
            return nodes.filter("reached").select("file", "at")


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """`(file, at, kind, key, url, refers_to, payload_bytes, payload_digest, intact)` and, if asked for, `payload`.

    Every task scans its splits for candidate records and works out where each one's successor would start, its
    payload's length and digest. Only candidates that the chain from the start of their file comes through are
    records; text inside a payload that looks like one isn't. `at` is the byte in the file. A record that reaches over
    a split's end is put together from its pieces, by place. `intact` is false where the digest isn't the stated one.
    For revisits length and digest are those stated, of the payload they refer to.
    """
    found = saved(_scan(_pieces(spark, path), payload), "warc-candidates")
    lengths = found.filter("place is null").select("file", "split", F.col("after").alias("length"))
    # A few numbers per split: the rows of a file's window are its splits.
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = saved(lengths.withColumn("base", F.coalesce(F.sum("length").over(before), F.lit(0))), "warc-splits")
    placed = found.filter("place is not null").join(splits.select("file", "split", "base"), ["file", "split"])
    placed = placed.withColumn("at", F.col("base") + F.col("place")).withColumn("after", F.col("base") + F.col("after"))
    real = saved(reachable(placed.select("file", "at", "after")), "warc-reached")
    kept = placed.join(real, ["file", "at"])
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    whole = kept.filter("whole").select("file", "at", *names)

    spans = saved(kept.filter("not whole").select("file", "at", "after"), "warc-open")
    over = (F.col("base") < F.col("after")) & (F.col("base") + F.col("length") > F.col("at"))
    # Records don't overlap, so at most two of them are open in a split: few rows are sent, and only their pieces are moved.
    parts = F.broadcast(spans.join(splits, "file").filter(over).select("file", "split", "base", "at", "after"))
    marked = _numbered(_pieces(spark, path)).join(parts, ["file", "split"]).withColumn("where", F.col("base") + F.col("place"))
    inside = (F.col("where") < F.col("after")) & (F.col("where") + F.octet_length("piece") + len(GAP) > F.col("at"))
    # One group is one record.
    lists = marked.filter(inside).groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("where", "piece"))).alias("pieces"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, at, pieces in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                first = pieces[0]
                record = _Record(at, first["piece"][at - first["where"] :], payload)
                for p in pieces[1:]:
                    record.take(p["piece"] + GAP.encode())
                rows.append((file, at, *record.row()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (2 + len(_KINDS))
            kinds = [pa.int64(), pa.int64(), *_KINDS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "at", *names])

    out = whole.unionByName(lists.mapInArrow(put_together, f"file bigint, at bigint, {_FIELDS}"))
    return out if payload else out.drop("payload")


def _numbered(pieces: DataFrame) -> DataFrame:
    """The pieces with their `place`, counted from where the split's pieces begin."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            own = []
            for here in zip(*(batch.column(i).to_pylist() for i in range(2)), (len(p.as_py()) for p in batch.column(2)), strict=True):
                if here[:2] != now:
                    now, at = here[:2], 0
                own.append(at)
                at += here[2] + len(GAP)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], names=[*batch.schema.names, "place"])

    return pieces.mapInArrow(places, "file bigint, split bigint, piece binary, place bigint")
