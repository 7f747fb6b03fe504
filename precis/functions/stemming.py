"""English word stems as a column expression (Porter 1980, with the later changes in common use).

The metrics of `operators.evaluation` use it; pass `stemmed_tokens` wherever a tokenizer is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from precis.functions.text import let
from precis.functions.tokens import word_tokens

# Fixed values. Words with stems of their own.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
# Fixed values. Suffixes and what they become in the steps that ask for a stem of some length.
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "fulli": "ful",
    "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = dict.fromkeys(
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(), ""
)

# `y` is a vowel after a consonant. Whether a stem is long enough is asked by how often consonants follow vowels in it.
VOWEL = "(?:[aeiou]|(?<=[^aeiou])y)"
CONSONANT = "(?:[^aeiouy]|(?<![^aeiou])y)"
ONE_OR_MORE = f"{VOWEL}{CONSONANT}"
TWO_OR_MORE = f"{VOWEL}{CONSONANT}+{VOWEL}+{CONSONANT}"
EXACTLY_ONE = f"^{CONSONANT}*{VOWEL}+{CONSONANT}+{VOWEL}*$"
# Consonant, vowel, consonant at the end, the last not w, x or y; or a vowel and a consonant alone.
CLOSED = f"{CONSONANT}{VOWEL}(?![wxy]){CONSONANT}$|^{VOWEL}{CONSONANT}$"
DOUBLE = f"({CONSONANT})\\1$"


def drop(text: Column, n: int | Column) -> Column:
    """The text without its last `n` characters."""
    return F.substring(text, F.lit(1), F.length(text) - n)


def _one_of(suffixes: Iterable[str]) -> str:
    return f"(?:{'|'.join(suffixes)})$"


def _plurals(w: Column) -> Column:
    return (
        F.when(w.rlike("^.ies$"), drop(w, 1))
        .when(w.rlike("(?:sses|ies)$"), drop(w, 2))
        .when(w.rlike("[^s]s$|^s$"), drop(w, 1))
        .otherwise(w)
    )


def _past_and_ing(w: Column) -> Column:
    def mend(stem: Column) -> Column:
        return (
            F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(DOUBLE), F.when(stem.rlike("[^lsz]$"), drop(stem, 1)).otherwise(stem))
            .when(stem.rlike(EXACTLY_ONE) & stem.rlike(CLOSED), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    return (
        F.when(w.rlike("^.ied$"), drop(w, 1))
        .when(w.endswith("ied"), drop(w, 2))
        .when(w.endswith("eed"), F.when(drop(w, 3).rlike(ONE_OR_MORE), drop(w, 1)).otherwise(w))
        .when(w.rlike(f"{VOWEL}.*(?:ed|ing)$"), let(F.regexp_replace(w, "(?:ed|ing)$", ""), mend))
        .otherwise(w)
    )


def _final_y(w: Column) -> Column:
    return F.regexp_replace(w, f"(?<=.{CONSONANT})y$", "i")


def _adverbs(w: Column) -> Column:
    return F.when(w.endswith("alli") & drop(w, 4).rlike(ONE_OR_MORE), drop(w, 2)).otherwise(w)


def _suffixes(rules: dict[str, str], long_enough: str) -> Callable[[Column], Column]:
    """The longest suffix that fits is replaced if the stem before it is long enough."""
    pattern = _one_of(sorted(rules, key=len, reverse=True))
    news = F.create_map(*[F.lit(text) for rule in rules.items() for text in rule])

    def replace(w: Column, suffix: Column) -> Column:
        stem = drop(w, F.length(suffix))
        # `logi` asks for a stem with its `l`; `ion` goes only after s or t.
        measured = F.when(suffix == "logi", F.concat(stem, F.lit("l"))).otherwise(stem)
        fits = measured.rlike(long_enough) & ((suffix != "ion") | stem.rlike("[st]$"))
        return F.when((suffix != "") & fits, F.concat(stem, news[suffix])).otherwise(w)

    return lambda w: let(F.regexp_extract(w, pattern, 0), lambda suffix: replace(w, suffix))


def _final_e(w: Column) -> Column:
    stem = drop(w, 1)
    droppable = stem.rlike(TWO_OR_MORE) | (stem.rlike(EXACTLY_ONE) & ~stem.rlike(CLOSED))
    return F.when(w.endswith("e") & droppable, stem).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & drop(w, 1).rlike(TWO_OR_MORE), drop(w, 1)).otherwise(w)


def stems(words: Column) -> Column:
    """An array of lower-case words as an array of stems; words of one or two letters are their own."""
    out = words
    for step in (
        _plurals,
        _past_and_ing,
        _final_y,
        _adverbs,
        _suffixes(STEP_2, ONE_OR_MORE),
        _suffixes(STEP_3, ONE_OR_MORE),
        _suffixes(STEP_4, TWO_OR_MORE),
        _final_e,
        _final_ll,
    ):
        out = F.transform(out, step)
    own = F.create_map(*[F.lit(text) for pair in IRREGULAR.items() for text in pair])
    return F.zip_with(
        words, out, lambda word, stem: F.when(F.length(word) <= 2, word).otherwise(F.coalesce(own[word], stem))
    )


def stemmed_tokens(col: Column) -> Column:
    """Word tokens, those of more than three letters as their stems."""
    return let(
        word_tokens(col),
        lambda tokens: F.zip_with(
            tokens, stems(tokens), lambda token, stem: F.when(F.length(token) > 3, stem).otherwise(token)
        ),
    )
