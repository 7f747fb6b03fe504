"""Chat formatting: conversations as a prefix tree whose shared turns are written once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precis.llm.common import saved, with_totals_before

# Strings that chat models take for control tokens. None ends as another begins.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
# Tokens of a block, one turn more or less.
BLOCK_CHARS = 1 << 16


@dataclass(frozen=True)
class Template:
    """A turn is `<s>role`, a line break, the text and `</s>`; text under the loss mask is that of `learned` roles.

    A control string inside a role or text gets a backslash after its first character, one more than it may have
    there, so what is written holds none and reading takes one backslash away again.
    """

    learned: tuple[str, ...] = ("assistant",)

    @property
    def _any(self) -> str:
        return "|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in CONTROLS)

    def escape(self, text: str) -> str:
        return re.sub(self._any, lambda m: (g := [x for x in m.groups() if x is not None])[0] + "\\" + g[1] + g[2], text)

    def unescape(self, text: str) -> str:
        def less(m: re.Match) -> str:
            first, slashes, rest = (x for x in m.groups() if x is not None)
            return first + slashes[1:] + rest

        return re.sub(self._any, less, text)

    def head(self, role: str) -> str:
        return "<s>" + self.escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn as written, and from where to where it is under the loss mask (0, 0 if it isn't)."""
        head, body = self.head(role), self.escape(text)
        span = (len(head), len(head) + len(body)) if role in self.learned else (0, 0)
        return head + body + "</s>", *span

    def turns(self, written: str) -> list[tuple[str, str]]:
        """Roles and texts of what `turn` wrote, in order."""
        found = re.findall(r"<s>([^\n]*)\n(.*?)</s>", written, re.DOTALL)
        plain = lambda r: re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(r))
        return [(plain(r), self.unescape(t)) for r, t in found]


def _named(turns: DataFrame, template: Template, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn as written, with a number `c` of its conversation, its `depth` there, and two names.

    `n1, n2` name it with all before it, `p1, p2` the turn before (0, 0 if none). A conversation's rows come sorted and
    are read one by one with the name so far carried over batches, so it needs no more memory than a batch.
    """
    own = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    sorted_turns = own.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    kind = own.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, c bigint, depth int, n1 bigint, n2 bigint, p1 bigint, p2 bigint, text string, size bigint, loss_from bigint, loss_to bigint"
    number = lambda half: int.from_bytes(half, "little", signed=True)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, depth, name, names, now = TaskContext.get().partitionId() << 40, -1, b"", (0, 0), None
        for batch in batches:
            rows = []
            for key, r, t in zip(*(batch.column(x).to_pylist() for x in ("conv", "role", "text")), strict=True):
                if depth < 0 or not (key == now or (key != key and now != now)):
                    c, depth, name, names, now = c + 1, -1, b"", (0, 0), key
                part, start, end = template.turn(r, t)
                before, depth = names, depth + 1
                name = hashlib.blake2b(name + part.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                names = number(name[:8]), number(name[8:])
                rows.append((c, depth, *names, *before, part, len(part), start, end))
            columns = zip(*rows, strict=True) if rows else [[]] * 10
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), *[pa.int64()] * 3]
            made = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
            fields = ["conv", "c", "depth", "n1", "n2", "p1", "p2", "text", "size", "loss_from", "loss_to"]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *made], names=fields)

    return sorted_turns.mapInArrow(chain, schema)


def write(
    turns: DataFrame,
    path: str,
    template: Template | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> None:
    """Writes `path/blocks` and `path/conversations`.

    Conversations that begin with the same turns share them: the turns form a tree, which is written depth first, each
    turn once. A run of turns between two forks is a segment; a segment is cut into blocks of about `BLOCK_CHARS`
    tokens, never inside a turn:

    - `block`, its number, and `start`, where its first token stands in the whole output (a token is a code point);
      numbers go up as starts do and are the same;
    - `first`, the first block of its segment;
    - `text`; `turns`, where each turn ends and from where to where it is under the loss mask, counted in the block;
    - `position`, the position id of its first token; the others follow one by one;
    - `attends`, the spans of ancestors that its tokens see besides those before them in the block: first block, start
      in the output, length, one span per segment. Tokens of other branches are not in them;
    - `turns_before`, how many turns these spans hold.

    `conversations` holds `conv` and `block`: a conversation is its block's ancestors and the block's turns up to
    `n_turns` in all. Rows of a conversation go by turn, ties by role and text; null roles and texts are empty; a null
    id is a conversation. A conversation is never one row: its turns are rows from end to end, sorted and read as a
    stream, so one that holds a third of the table takes one task long but no more memory. Copies and shared turns
    are counted and joined as rows. Only the forks on a path come together in one row.
    """
    template = template or Template()
    every = saved(_named(turns, template, conv, turn, role, text), "chat-turns")
    last = [F.max_by(n, "depth").alias(n) for n in ("n1", "n2")]
    ends = saved(every.groupBy("c").agg(F.first("conv").alias("conv"), F.max("depth").alias("depth"), *last), "chat-ends")
    # Equal conversations have one path; the last turn's name names it.
    one = ends.groupBy("n1", "n2").agg(F.min("c").alias("c")).select("c")
    kept = saved(every.drop("conv", "text").join(one, "c", "left_semi"), "chat-paths")

    # A segment begins where a tree does or after a turn that is followed by different ones.
    nodes = kept.groupBy("n1", "n2").agg(*(F.min(x).alias(x) for x in ("depth", "p1", "p2")))
    forks = nodes.groupBy("p1", "p2").agg(F.count("*").alias("ways")).filter("ways > 1")
    heads = nodes.join(forks, ["p1", "p2"], "left").filter("depth = 0 OR ways > 1")
    heads = saved(heads.select("n1", "n2", F.struct("n1", "n2").alias("head")), "chat-heads")
    along = Window.partitionBy("c").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = saved(kept.drop("p1", "p2").join(heads, ["n1", "n2"], "left"), "chat-marked")
    # Lexicographic order of the segments on a path is depth-first order.
    forked = marked.filter("head IS NOT NULL").select("n1", "n2", F.collect_list("head").over(along).alias("path"))
    order = forked.dropDuplicates(["n1", "n2"]).withColumn("one", F.lit(1).cast("long"))
    segments = saved(with_totals_before(order, [F.col("path")], {"rank": "one"}, "chat-order").drop("one"), "chat-segments")
    ranks = segments.select(F.col("n1").alias("h1"), F.col("n2").alias("h2"), "rank")
    within = marked.withColumn("head", F.last("head", ignorenulls=True).over(along))
    within = within.withColumn("h1", F.col("head.n1")).withColumn("h2", F.col("head.n2"))
    # A turn has the same depth, size and segment on every path through it.
    facts = [F.min(x).alias(x) for x in ("c", "depth", "size", "loss_from", "loss_to", "h1", "h2")]
    tree = within.groupBy("n1", "n2").agg(*facts).join(ranks, ["h1", "h2"]).drop("h1", "h2")
    placed = with_totals_before(tree, [F.col("rank"), F.col("depth")], {"start": "size"}, "chat-starts")
    cell = Window.partitionBy("rank", F.floor(F.col("start") / BLOCK_CHARS))
    placed = saved(placed.withColumn("block", F.min("start").over(cell)), "chat-tree")

    spans = placed.groupBy("rank").agg(F.min("start").alias("first"), F.sum("size").alias("size"))
    spans = saved(spans.join(ranks, "rank"), "chat-spans")
    above = segments.select("rank", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("h"))
    above = above.select(F.col("rank").alias("below"), F.col("h.n1").alias("h1"), F.col("h.n2").alias("h2")).join(spans, ["h1", "h2"])
    span = F.struct(F.col("first").alias("block"), F.col("first").alias("start"), "size")
    attends = above.groupBy("below").agg(F.sort_array(F.collect_list(span)).alias("attends"), F.sum("size").alias("before"))

    texts = placed.join(every.select("c", "depth", "text"), ["c", "depth"])
    parts = F.struct("start", "depth", "size", "loss_from", "loss_to", "text")
    # One group is one block.
    blocks = texts.groupBy("rank", "block").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    blocks = blocks.join(spans.select("rank", "first"), "rank").join(attends.withColumnRenamed("below", "rank"), "rank", "left")
    none = F.array().cast("array<struct<block:bigint,start:bigint,size:bigint>>")
    earlier = F.array(F.struct(F.col("first").alias("block"), F.col("first").alias("start"), (F.col("block") - F.col("first")).alias("size")))

    def in_block(p: Column) -> Column:
        at = p["start"] - F.col("block")
        return F.struct((at + p["size"]).alias("end"), (at + p["loss_from"]).alias("loss_from"), (at + p["loss_to"]).alias("loss_to"))

    blocks = blocks.select(
        "block",
        "first",
        F.col("block").alias("start"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        F.transform("parts", in_block).alias("turns"),
        (F.coalesce("before", F.lit(0)) + F.col("block") - F.col("first")).alias("position"),
        F.get("parts", F.lit(0))["depth"].alias("turns_before"),
        F.concat(F.coalesce("attends", none), F.when(F.col("block") > F.col("first"), earlier).otherwise(none)).alias("attends"),
    )
    blocks.repartitionByRange("block").sortWithinPartitions("block").write.parquet(f"{path}/blocks")
    # A path that ends inside another one adds no block: it is the first turns up to its last turn's block.
    named = ends.join(placed.select("n1", "n2", "block"), ["n1", "n2"])
    named.select("conv", "block", (F.col("depth") + 1).alias("n_turns")).write.parquet(f"{path}/conversations")


def token_columns(blocks: DataFrame) -> DataFrame:
    """The blocks with `position_ids` and `loss_mask` spelled out, one number per token (code point)."""
    n = F.length("text")
    ids = F.when(n > 0, F.sequence(F.col("position"), F.col("position") + n - 1)).otherwise(F.array().cast("array<bigint>"))
    learned = lambda i: F.exists("turns", lambda t: (t["loss_from"] <= i) & (i < t["loss_to"]))
    mask = F.transform(ids, lambda p: learned(p - F.col("position")).cast("int"))
    return blocks.withColumn("position_ids", ids).withColumn("loss_mask", mask)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """`(leaf, n_turns, place, text, turns)`: the blocks of each path that a conversation has, cut to its turns."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ends = spark.read.parquet(f"{path}/conversations").select("block", "n_turns").distinct()
    firsts = F.array_distinct(F.concat(F.transform("attends", lambda a: a["block"]), F.array("first")))
    on_path = ends.join(blocks.select("block", "first", "attends"), "block").select(F.col("block").alias("leaf"), "n_turns", F.explode(firsts).alias("first"))
    found = saved(on_path, "chat-ends").join(blocks.select("first", "block", "text", "turns", "turns_before"), "first")
    found = found.filter("block <= leaf").withColumn("turns", F.slice("turns", F.lit(1), F.col("n_turns") - F.col("turns_before")))
    text = F.substring("text", F.lit(1), F.element_at("turns", -1)["end"].cast("int"))
    return found.select("leaf", "n_turns", F.col("block").alias("place"), text.alias("text"), "turns")


def read(spark: SparkSession, path: str, template: Template | None = None) -> DataFrame:
    """`(conv, n_turns, turns, formatted, learned)`: every conversation put together again from the blocks.

    `turns` are roles and texts as they were, `formatted` is the conversation as a model sees it, `learned` the text
    under the loss mask, unescaped. A conversation is one row here and must fit in it; `digests` has no such limit.
    """
    template = template or Template()
    conversations = spark.read.parquet(f"{path}/conversations")
    # One group is one path.
    piece = F.struct("place", "text", "turns").alias("piece")
    whole = _pieces(spark, path).select("leaf", "n_turns", piece).groupBy("leaf", "n_turns").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.struct([("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            turns_of, formatted, learned = [], [], []
            for pieces in batch.column("pieces").to_pylist():
                text = "".join(p["text"] for p in pieces)
                formatted.append(text)
                turns_of.append([{"role": r, "text": t} for r, t in template.turns(text)])
                masked = [template.unescape(p["text"][t["loss_from"] : t["loss_to"]]) for p in pieces for t in p["turns"]]
                learned.append("".join(masked))
            held = [batch.column("leaf"), batch.column("n_turns"), pa.array(turns_of, pa.list_(struct)), pa.array(formatted), pa.array(learned)]
            yield pa.RecordBatch.from_arrays(held, names=["leaf", "n_turns", "turns", "formatted", "learned"])

    schema = "leaf bigint, n_turns int, turns array<struct<role:string,text:string>>, formatted string, learned string"
    paths = saved(whole.mapInArrow(put_together, schema), "chat-read").withColumnRenamed("leaf", "block")
    return conversations.join(paths, ["block", "n_turns"]).select("conv", "n_turns", "turns", "formatted", "learned")


def digests(spark: SparkSession, path: str, template: Template | None = None) -> DataFrame:
    """`(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)` of every conversation in the blocks.

    What `read` gives as a row is read as a stream of sorted blocks here and hashed as it comes: a role, a line break,
    the text and a line break per turn; the text under the loss mask. A long conversation takes one task long but is
    never held.
    """
    template = template or Template()
    laid = _pieces(spark, path).repartition("leaf", "n_turns").sortWithinPartitions("leaf", "n_turns", "place")
    fields = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def finished() -> pa.RecordBatch:
            rows, done[:] = list(done), []
            columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], names=fields)

        for batch in batches:
            for leaf, n, text, turns in zip(*(batch.column(x).to_pylist() for x in ("leaf", "n_turns", "text", "turns")), strict=True):
                if now != (leaf, n):
                    if now:
                        done.append((*now, said.hexdigest(), chars, loss.hexdigest(), size))
                    now, said, loss, chars, size = (leaf, n), hashlib.sha256(), hashlib.sha256(), 0, 0
                for r, t in template.turns(text):
                    said.update(f"{r}\n{t}\n".encode("utf-8", "surrogatepass"))
                for t in turns:
                    masked = template.unescape(text[t["loss_from"] : t["loss_to"]])
                    loss.update(masked.encode("utf-8", "surrogatepass"))
                    chars += len(masked)
                size += len(text)
            yield finished()
        if now:
            done.append((*now, said.hexdigest(), chars, loss.hexdigest(), size))
            yield finished()

    schema = "leaf bigint, n_turns int, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    found = saved(laid.mapInArrow(stream, schema), "chat-digests").withColumnRenamed("leaf", "block")
    conversations = spark.read.parquet(f"{path}/conversations")
    return conversations.join(found, ["block", "n_turns"]).select("conv", *fields[1:])
