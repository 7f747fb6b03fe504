"""Sentence ends learned from the corpus itself, without labels (Kiss and Strunk 2006).

A word that the corpus nearly always writes with a full stop is an abbreviation. How sure that is follows from counts alone:
the likelihood of its stops if stops fell on words evenly, against the likelihood if nearly all of its occurrences had
one; short words and words with stops inside count for more, occurrences without a stop for less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.functions.text import let, strip
from precis.operators.lookups import looked_up
from precis.session import stored

# Fixed values of the published method: the share of stops that an abbreviation has, and the score it takes.
SHARE = 0.99
ENOUGH = 0.3
# A piece between white space: marks that open it, its word (letters, digits, and what may stand between them), a full stop.
WORD = r"^[^\p{L}\p{N}]*([\p{L}\p{N}](?:[\p{L}\p{N}.'-]*[\p{L}\p{N}])?)(\.?)"
# `WHITESPACE` as ranges, which the matcher tests in few steps.
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_GAP = f"[{_SPACE}]+"
# The end of a piece that closes with one of `.!?:` and marks, and the space after it. Looked for from where its marks
# begin, so that a long run of them is passed over once; looking back, the matcher sees half of a character beyond U+FFFF.
_CLOSED = r"(?=[^\p{L}\p{N} ])(?<![^\p{L}\p{N}\p{Cs} ])([^\p{L}\p{N} .!?:]*+[.!?:][^\p{L}\p{N} ]*+) "
# White space is looked through from its first character only, which is where a break in it begins.
_BREAK = rf"[.!?][{_SPACE}]+|(?=[{_SPACE}])(?<![{_SPACE}])[{_SPACE}]*[\r\n][{_SPACE}]*"
# What follows the last white space; the matcher goes there from the end, so a long word costs no more than its length.
_LAST = rf"(?s)^(?:.*[{_SPACE}])?+(.+)$"


def word_types(df: DataFrame, text: str) -> DataFrame:
    """`(word, n_stop, n_other, n_small, n_large_inside)` per lower-cased word of the corpus.

    With a full stop after it and without; begun with a small letter; begun with a capital where no sentence begins,
    that is after a piece that ends in none of `.!?:`. Counts are combined before the shuffle.
    """
    spaced = F.regexp_replace(strip(F.coalesce(F.col(text), F.lit(""))), _GAP, " ")
    # A piece with which a sentence may begin is marked by a line break, which no piece holds by now.
    marked = F.concat(F.lit("\n"), F.regexp_replace(spaced, _CLOSED, "$1 \n"))
    # A piece is looked into once for all its occurrences.
    each = df.select(F.explode(F.split(marked, " ", -1)).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
    inside = (~F.col("piece").startswith("\n")).alias("inside")
    word = F.regexp_extract("piece", WORD, 1).alias("_word")
    parted = each.select(word, (F.regexp_extract("piece", WORD, 2) == ".").alias("stop"), inside, "n").filter("_word != ''")
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return parted.groupBy(F.lower("_word").alias("word")).agg(
        count(F.col("stop")).alias("n_stop"),
        count(~F.col("stop")).alias("n_other"),
        count(F.col("_word").rlike(r"^\p{Ll}")).alias("n_small"),
        count(F.col("_word").rlike(r"^\p{Lu}") & F.col("inside")).alias("n_large_inside"),
    )


def rate_abbreviations(types: DataFrame) -> DataFrame:
    """`types` with `score` and `abbreviation`. Words without a letter, or never before a full stop, score 0.

    Each count of the formula is of the whole corpus: n words, of them `stops` before a full stop.
    """
    stops = types.agg(F.sum("n_stop")).scalar().cast("double")
    words = types.agg(F.sum(F.col("n_stop") + F.col("n_other"))).scalar().cast("double")
    own, without = F.col("n_stop").cast("double"), F.col("n_other").cast("double")
    even = stops / words
    # A corpus in which every word has a stop says nothing.
    by_chance = own * F.log(even) + without * F.log(F.greatest(1 - even, F.lit(1e-12)))
    as_rule = own * F.log(F.lit(SHARE)) + without * F.log(F.lit(1 - SHARE))
    inner = F.length("word") - F.length(F.replace(F.col("word"), F.lit("."), F.lit("")))
    letters = (F.length("word") - inner).cast("double")
    score = -2 * (by_chance - as_rule) * F.exp(-letters) * (inner + 1) * F.pow(letters, -without)
    rated = F.when((F.col("n_stop") > 0) & F.col("word").rlike(r"\p{L}"), score).otherwise(F.lit(0.0))
    return types.withColumn("score", rated).withColumn("abbreviation", F.col("score") >= ENOUGH)


def learn_sentence_ends(df: DataFrame, text: str) -> DataFrame:
    """`(word, abbreviation, starts)`: what `learned_sentences` looks up; words that are neither are left out.

    A word `starts` sentences if the corpus knows it with a small letter, and with a capital only where a sentence may
    begin: after an abbreviation its capital then shows a new sentence.
    """
    rated = rate_abbreviations(stored(word_types(df, text), "word-types"))
    starts = (F.col("n_small") > 0) & (F.col("n_large_inside") == 0)
    return rated.select("word", "abbreviation", starts.alias("starts")).filter(F.col("abbreviation") | F.col("starts"))


def learned_sentences(df: DataFrame, ends: DataFrame, text: str, into: str) -> DataFrame:
    """`df` with the text as `into`, stripped, one sentence per line; null gives null.

    `!`, `?` and a line break end a sentence. A full stop before white space does, unless an abbreviation or a single
    letter stands before it and no word that starts sentences follows with a capital, or a number stands before it and
    a small letter follows. White space after an end becomes the line break, any other stays.
    """
    given = strip(F.col(text))
    body = F.coalesce(given, F.lit(""))
    one = df.withColumn("_there", F.col(text).isNotNull())
    one = one.withColumn("_pieces", F.split(body, _BREAK, -1)).withColumn("_breaks", F.regexp_extract_all(body, F.lit(f"({_BREAK})"), F.lit(1)))

    def sides(own: Column, at: Column) -> Column:
        """Of a full stop, the words beside it: what is looked up, and what their own letters say."""
        stop = own.startswith(".") & ~own.rlike("[\\r\\n]")
        last = F.regexp_extract(F.regexp_extract(F.get("_pieces", at), _LAST, 1), WORD, 1)
        first = F.regexp_extract(F.get("_pieces", at + 1), WORD, 1)

        def told(words: Column) -> Column:
            before, after = words["last"], words["first"]
            return F.struct(
                before.alias("before"),
                F.lower(after).alias("after"),
                before.rlike(r"^\p{L}$").alias("single"),
                after.rlike(r"^\p{Lu}").alias("capital"),
                (before.rlike(r"^\p{N}+$") & after.rlike(r"^\p{Ll}")).alias("number"),
            )

        return F.when(stop, let(F.struct(F.lower(last).alias("last"), first.alias("first")), told))

    # Worked out once per break. Only a full stop's neighbours are looked up; places of other breaks stay, without a word.
    one = one.withColumn("_sides", F.transform("_breaks", sides))
    flags = F.transform("_sides", lambda s: F.when(s.isNotNull(), F.struct(s["single"].alias("single"), s["capital"].alias("capital"), s["number"].alias("number"))))
    one = one.withColumn("_flags", flags)
    asked = {"_before": F.col("_sides.before"), "_after": F.col("_sides.after")}
    table = ends.select("word", F.struct("abbreviation", "starts").alias("_known"))
    kept = [c for c in df.columns if c != into]
    found = looked_up(one, table, asked, "word", "_known", keep=[*kept, "_there", "_pieces", "_breaks", "_flags"])

    def shown(bound: Column, own: Column, at: Column) -> Column:
        flag = F.get(bound["flags"], at)
        short = F.coalesce(F.get(bound["before"], at)["abbreviation"], F.lit(False)) | flag["single"]
        opens = F.coalesce(F.get(bound["after"], at)["starts"], F.lit(False)) & flag["capital"]
        # Whether the full stop at this break ends no sentence.
        holds = flag.isNotNull() & ((short & ~opens) | flag["number"])
        return F.concat(F.get(bound["pieces"], at), F.when(holds, own).otherwise(F.concat(F.regexp_extract(own, "^[.!?]", 0), F.lit("\n"))))

    # Bound outside the lambda, where they would be looked up anew at each break.
    told = F.struct(F.col("_before").alias("before"), F.col("_after").alias("after"), F.col("_flags").alias("flags"), F.col("_pieces").alias("pieces"), F.col("_breaks").alias("breaks"))
    heads = let(told, lambda bound: F.transform(bound["breaks"], lambda own, at: shown(bound, own, at)))
    lines = F.concat(F.array_join(heads, ""), F.element_at("_pieces", -1))
    return found.select(*[F.col(f"`{c}`") for c in kept], F.when(F.col("_there"), lines).alias(into))
