"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import SPACES, let, words_of

# Fixed by the result contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of the languages expected.
STOP_WORDS = {
    "en": ["a", "and", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with"],
    "de": ["auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "im", "in", "ist", "mit", "nicht", "sich", "und", "von", "zu"],
    "fr": ["au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une"],
    "es": ["con", "de", "del", "el", "en", "es", "la", "las", "los", "no", "para", "por", "que", "se", "su", "un", "una", "y"],
}


@dataclass(frozen=True)
class Rule:
    """Keeps a text when `low <= part / whole <= high`; texts of fewer than `least` words pass.

    With `listed`, so do texts in a language that has no list of words.
    """

    name: str
    part: str
    whole: str
    low: float | None
    high: float | None
    least: int = 0
    listed: bool = False


#: Part and whole name counts of `counts`.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, least=50, listed=True),
    Rule("capitals", "n_capitals", "n_letters", None, 0.6),
    Rule("shouting", "n_shouts", "n_words", None, 0.2),
    Rule("bullets", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("trailing_dots", "n_dotted_lines", "n_lines", None, 0.3, least=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5, least=50),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more.

    Windows are told apart by a 64-bit hash of their words. Sorting the hashes shows which repeat; only a text that
    has such windows sorts the positions as well, and each repeated window adds the words up to the next one's start.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            near = lambda x, j: x["h"].eqNullSafe(F.get(p, j)["h"])
            at = F.sort_array(F.transform(F.filter(p, lambda x, j: near(x, j - 1) | near(x, j + 1)), lambda x: x["i"]))
            return let(
                at,
                lambda a: F.aggregate(
                    F.zip_with(a, F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: F.least(F.coalesce(y - x, F.lit(WINDOW)), F.lit(WINDOW))),
                    F.lit(0).cast("long"),
                    lambda total, x: total + x,
                ),
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(pairs, twice))

    def hashed(w: Column) -> Column:
        window = lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW)))
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window)

    return let(words, lambda w: F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(let(hashed(w), covered)))


def counts(text: Column, stop_words: dict[str, list[str]] | None = None, lang: Column | None = None) -> Column:
    """The counts that rules are made of, as one struct of longs; a null text counts like an empty one.

    `listed` is 1 if the text's language has a list of stop words. Without a language, that is a text of which at least
    half the letters are Latin.
    """
    lists = stop_words or STOP_WORDS
    every = sorted({w for words in lists.values() for w in words})
    known = F.lit(None).cast("boolean") if lang is None else F.lower(F.substring_index(lang, "-", 1)).isin(*lists)

    def removed(t: Column, pattern: str) -> Column:
        return F.length(t) - F.length(F.regexp_replace(t, pattern, ""))

    def of(t: Column) -> Column:
        solid = F.translate(t, SPACES, "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")

        def with_words(w: Column) -> Column:
            def with_lines(ls: Column) -> Column:
                found = {
                    "n_words": F.size(w),
                    "word_chars": F.length(solid),
                    "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
                    "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
                    "n_repeat_words": _repeat_words(w),
                    "n_lines": F.size(ls),
                    "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(every))),
                    "listed": F.coalesce(known, 2 * removed(t, r"\p{IsLatin}+") >= removed(t, r"\p{L}+")),
                    "n_letters": removed(t, r"\p{L}+"),
                    "n_capitals": removed(t, r"\p{Lu}+"),
                    "n_shouts": F.length(t) - F.length(F.translate(t, "!", "")),
                    "n_bullet_lines": F.size(F.filter(ls, lambda x: F.trim(x).substr(1, 1).isin("-", "*", "•"))),
                    "n_dotted_lines": F.size(F.filter(ls, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
                }
                return F.struct(*(c.cast("long").alias(name) for name, c in found.items()))

            return let(lines, with_lines)

        return let(words_of(t), with_words)

    return let(F.coalesce(text, F.lit("")), of)


def base_failed(found: Column) -> Column:
    return (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])


def broken_rules(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a text breaks, `base` first; compared without division, so an empty whole passes."""

    def broken(rule: Rule) -> Column:
        part, whole = found[rule.part], found[rule.whole]
        out = F.lit(False)
        if rule.low is not None:
            out = out | (part < F.lit(rule.low) * whole)
        if rule.high is not None:
            out = out | (part > F.lit(rule.high) * whole)
        out = out & (found["n_words"] >= rule.least)
        return out & (found["listed"] == 1) if rule.listed else out

    names = [F.when(base_failed(found), F.lit("base")), *(F.when(broken(r), F.lit(r.name)) for r in rules)]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def _column(name: str | None) -> Column | None:
    return None if name is None else F.col(f"`{name}`")


def assess(docs: DataFrame, text: str = "text", into: str = "quality", rules: tuple[Rule, ...] = RULES, lang: str | None = None) -> DataFrame:
    """The rows with a struct column `into` (replaced if there): the counts, `broken` and `kept`.

    One projection without user functions or shuffles, so a hot source or repeated rows cost what others do. Null and
    empty texts have no words and break the base rule. Texts are read whole. `lang` names the column of their language.
    """
    verdict = lambda c: let(broken_rules(c, rules), lambda b: F.struct(c.alias("counts"), b.alias("broken"), (F.size(b) == 0).alias("kept")))
    return docs.withColumn(into, let(counts(F.col(f"`{text}`"), lang=_column(lang)), verdict))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str | None = None) -> DataFrame:
    """The rows that break no rule, with their own columns."""
    good = let(counts(F.col(f"`{text}`"), lang=_column(lang)), lambda c: F.size(broken_rules(c, rules)) == 0)
    return docs.filter(good)
