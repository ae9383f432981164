"""Text expressions: trimming, term tests, word n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space. SQL trim() alone takes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word is a run of two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True if any term is a substring. No terms, no match."""
    test = F.lit(False)
    for term in terms:
        test = test | F.contains(text, F.lit(term))
    return test


def any_label_contains(labels: Column, terms: Sequence[str]) -> Column:
    """True if any label, lower-cased, contains any term.

    The labels are tested as one text. A NUL between them, which no term has,
    keeps a term from matching across two labels; unlike a test per array
    element this stays inside generated code.
    """
    return contains_any(or_empty(F.lower(F.array_join(labels, "\0"))), terms)


def words(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-cased words in order, without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    if not stop_words:
        return found
    # One array of the two sorts of words per row is cheaper than a test per stop word.
    return F.filter(found, lambda w: ~w.isin(list(stop_words)))


def unigrams_and_bigrams(tokens: Column) -> Column:
    """Words followed by every pair of neighbours, joined by one space."""
    n = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(tokens, pairs)
