"""Column expressions that turn text into terms. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termscape.functions.stopwords import ENGLISH_DEFAULT

#: A word: a maximal run of letters, marks and digits.
WORD = r"[\p{L}\p{M}\p{N}]+"

#: Characters that Java's ``\s`` matches, for trimming.
WHITESPACE = " \t\n\x0b\f\r"

#: Suffix rules of the rule-based normalizer: (suffix, replacement, shortest word).
#: The first rule that fits a word is used.
SUFFIX_RULES: tuple[tuple[str, str, int], ...] = (
    ("sses", "ss", 6),
    ("ss", "ss", 4),
    ("ies", "y", 5),
    ("ing", "", 6),
    ("ed", "", 5),
    ("s", "", 4),
)


def letter_word(min_length: int = 3) -> str:
    """Pattern of a whole word made only of at least ``min_length`` letters.

    The look-behind and look-ahead pin the match to word borders, so one pass of the regex does
    what extracting every word and filtering the array by shape would do.
    """
    return rf"(?<![\p{{L}}\p{{M}}\p{{N}}])\p{{L}}{{{min_length},}}+(?![\p{{M}}\p{{N}}])"


def whitespace_tokens(text: Column) -> Column:
    """Lower-cased pieces between whitespace characters, punctuation kept.

    Trailing empty pieces are dropped and inner ones kept, as ``pyspark.ml.feature.Tokenizer`` does.
    """
    trimmed = F.rtrim(F.lower(text), F.lit(WHITESPACE))
    return F.when(
        (trimmed == "") & (text != ""), F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, r"\s"))


def words(text: Column) -> Column:
    """Every word of the text, in order, in its original case."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def letter_words(text: Column, min_length: int = 3) -> Column:
    """Words of only letters and at least ``min_length`` code points, in their original case."""
    return F.regexp_extract_all(text, F.lit(letter_word(min_length)), F.lit(0))


def lower_all(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.lower(w))


def without_stop_words(
    tokens: Column, stop_words: Sequence[str] = ENGLISH_DEFAULT, case_sensitive: bool = False
) -> Column:
    """Drop stop words. ``isin`` on a literal list becomes one hash-set probe per token."""
    if not stop_words:
        return tokens
    if case_sensitive:
        return F.filter(tokens, lambda w: ~w.isin(list(stop_words)))
    lowered = sorted({w.lower() for w in stop_words})
    return F.filter(tokens, lambda w: ~F.lower(w).isin(lowered))


def with_term_shape(tokens: Column, min_length: int = 3) -> Column:
    """Keep tokens of only letters and at least ``min_length`` code points."""
    return F.filter(
        tokens, lambda w: (F.length(w) >= min_length) & w.rlike(r"^\p{L}+$")
    )


def strip_suffix(word: Column) -> Column:
    """Rule-based normal form of one word."""
    lowered = F.lower(word)
    result = None
    for suffix, replacement, shortest in SUFFIX_RULES:
        fits = lowered.endswith(suffix) & (F.length(word) >= shortest)
        stem = F.concat(
            F.substring(word, F.lit(1), F.length(word) - len(suffix)), F.lit(replacement)
        )
        result = F.when(fits, stem) if result is None else result.when(fits, stem)
    return result.otherwise(word)


def suffix_rules_sql(word: str = "word") -> str:
    """``strip_suffix`` as SQL text on ``word``, a form in which it can be stored."""
    cases = " ".join(
        f"WHEN endswith(lower({word}), '{suffix}') AND length({word}) >= {shortest} "
        f"THEN concat(substring({word}, 1, length({word}) - {len(suffix)}), '{replacement}')"
        for suffix, replacement, shortest in SUFFIX_RULES
    )
    return f"CASE {cases} ELSE {word} END"


def normalized(tokens: Column, normalizer: Callable[[Column], Column] | None) -> Column:
    """Apply a word-to-word column function to every token."""
    return tokens if normalizer is None else F.transform(tokens, normalizer)


def clean_terms(
    text: Column,
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    case_sensitive: bool = False,
    min_length: int = 3,
    normalizer: Callable[[Column], Column] | None = None,
) -> Column:
    """Text to lower-cased terms: words, normal forms, stop words, shape filter, lower case."""
    if normalizer is None:
        # Shape and stop-word filters commute, so the shape test can live in the extraction regex.
        found = letter_words(text, min_length)
    else:
        found = with_term_shape(normalized(words(text), normalizer), min_length)
    if case_sensitive:
        return lower_all(without_stop_words(found, stop_words, case_sensitive=True))
    lowered = sorted({w.lower() for w in stop_words})
    terms = lower_all(found)
    return F.filter(terms, lambda w: ~w.isin(lowered)) if lowered else terms


def terms_of(
    words: Column, stop_words: Sequence[str] = ENGLISH_DEFAULT, case_sensitive: bool = False, min_length: int = 3
) -> Column:
    """Words in normal form to terms: shape filter, stop words, lower case."""
    found = with_term_shape(words, min_length)
    return lower_all(without_stop_words(found, stop_words, case_sensitive))


def joined(items: Column, separator: str = ", ") -> Column:
    """Array of strings as one string."""
    return F.array_join(items, separator)
