"""Cleaning and sentence functions over string columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Whitespace as the cleaner understands it: the Unicode White_Space characters and the four
# ASCII separators U+001C to U+001F. Spelled out because Java's and RE2's `\s` each cover fewer.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value. What the cleaner blanks out: numeric entities, tags, [[...]] marks, line breaks.
MARKUP = r"&[#0-9]+;|<[^>]+>|\[\[[^\]]+\]\]|[\r\n]+"
# Fixed value. Where a text may be cut: end punctuation together with the whitespace after it.
SENTENCE_BREAK = "[?!.][" + WHITESPACE + "]+"


def strip(col: Column) -> Column:
    """Remove whitespace at both ends (`trim` alone knows only the space)."""
    return F.btrim(col, F.lit(WHITESPACE))


def word_count(col: Column) -> Column:
    """Number of pieces between single spaces: what a text costs in tokens."""
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1


def strip_markup(col: Column) -> Column:
    """Blank out each piece of markup, then strip.

    Whitespace at the ends can be in no tag, entity or mark, so one strip at the end gives what a strip before and
    after would. The look-ahead lets the matcher pass over a plain character with a single test.
    """
    return strip(F.regexp_replace(col, rf"(?=[&<\[\r\n])(?:{MARKUP})", " "))


def words(col: Column) -> Column:
    """Pieces between single spaces, empty ones included."""
    return F.split(col, " ", -1)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def truncate_at_sentence(col: Column, max_tokens: int) -> Column:
    """The longest run of leading fragments that costs at most `max_tokens`, stripped.

    The fragments are the sentences and the breaks between them, in turn; each costs its number of words. What is
    kept is a prefix of the text, so the fold sums up one length instead of building strings.

    A run that holds `max_tokens` spaces costs more than that, so nothing after that space is kept and no fragment
    after it needs a look; the fragment the space is in costs too much as far as the space already.
    """
    # A sentence and its break cost at least one each, so later sentences are never reached.
    reach = max_tokens // 2 + 2

    def price(pair: Column) -> Column:
        sentence, end = pair["sentence"], F.coalesce(pair["end"], F.lit(""))
        return F.struct(
            word_count(sentence).alias("sentence_cost"),
            F.length(sentence).alias("sentence_length"),
            word_count(end).alias("end_cost"),
            F.length(end).alias("end_length"),
        )

    def take(acc: Column, part: Column) -> Column:
        with_sentence = acc["cost"] + part["sentence_cost"]
        with_end = with_sentence + part["end_cost"]
        kept = (
            F.when(with_sentence > max_tokens, F.lit(0))
            .when(with_end > max_tokens, part["sentence_length"])
            .otherwise(part["sentence_length"] + part["end_length"])
        )
        return F.struct(with_end.alias("cost"), (acc["kept"] + kept).alias("kept"))

    def cut(text: Column, pieces: Column) -> Column:
        head = F.substring(text, F.lit(1), F.length(text) - F.length(F.element_at(pieces, -1)))
        breaks = F.regexp_extract_all(head, F.lit(SENTENCE_BREAK), F.lit(0))
        # The last of `reach` pieces is the whole unread rest.
        sentences = F.slice(pieces, 1, reach - 1)
        kept = F.aggregate(
            F.transform(F.arrays_zip(sentences.alias("sentence"), breaks.alias("end")), price),
            F.struct(F.lit(0).alias("cost"), F.lit(0).alias("kept")),
            take,
            lambda acc: acc["kept"],
        )
        return strip(F.substring(text, F.lit(1), kept))

    def within_reach(text: Column) -> Column:
        return F.substring(text, F.lit(1), F.length(F.substring_index(text, " ", max_tokens)) + 1)

    return let(
        let(col, within_reach),
        lambda text: let(F.split(text, SENTENCE_BREAK, reach), lambda pieces: cut(text, pieces)),
    )


def clean_text(col: Column, max_tokens: int) -> Column:
    """Markup removed and cut at a sentence end within the budget; null and empty give the empty string."""
    return F.coalesce(truncate_at_sentence(strip_markup(col), max_tokens), F.lit(""))


def newline_sentences(col: Column) -> Column:
    """The stripped text with one sentence per line."""
    return F.regexp_replace(strip(col), "([.!?])[" + WHITESPACE + "]+", "$1\n")


def sentences(col: Column) -> Column:
    """The non-empty sentences of a text, in order."""
    lines = F.transform(F.split(newline_sentences(col), "\n", -1), strip)
    return F.filter(lines, lambda line: F.length(line) > 0)


def first_words(col: Column, n: int | Column) -> Column:
    """The first `n` words of a text."""
    return F.array_join(F.slice(words(col), F.lit(1), n if isinstance(n, Column) else F.lit(n)), " ")
