"""Text column functions (X1, X2, X5, X17-X21, L5, S7 line strip).

Java regexes treat ``\\s`` as ASCII unless ``(?U)`` is set; Python's ``str.split`` and
``str.strip`` use Unicode whitespace, so the Unicode flag is on wherever the reference
relied on Python's rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.scalar import as_col

WS = r"(?U)\s+"
# ASCII punctuation: hex 21-2F, 3A-40, 5B-60, 7B-7E (Python's string.punctuation).
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"


def split_space(c: str | Column) -> Column:  # X1: one space, empties kept
    return F.split(as_col(c), " ")


def split_whitespace(c: str | Column) -> Column:  # X2: any whitespace run, no empties
    # a plain split leaves '' at a padded start; array_remove (code-generated) drops it
    return F.array_remove(F.split(as_col(c), WS), "")


def word_count(c: str | Column) -> Column:  # X5 of X2, without building the array
    return F.regexp_count(as_col(c), F.lit(r"(?U)\S+"))


def strip_unicode(c: str | Column) -> Column:  # S7: Python str.strip()
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def drop_ascii_punct(c: str | Column) -> Column:  # X18
    return F.regexp_replace(as_col(c), ASCII_PUNCT, "")


def collapse_ws(c: str | Column) -> Column:  # X19
    return F.regexp_replace(as_col(c), WS, " ")


def letters_only(c: str | Column) -> Column:  # X20: Python isalpha()
    return as_col(c).rlike(r"^\p{L}+$")


def join_tokens(arr: Column, sep: str = " ") -> Column:  # X21
    return F.array_join(arr, sep)


def letter_tokens(c: str | Column) -> Column:
    """Lower-case runs of letters; every other character separates tokens."""
    return F.array_remove(F.split(F.lower(as_col(c)), r"[^\p{L}]+"), "")


def clean_sentence(c: str | Column) -> Column:
    """L4: split on whitespace, lower, drop ASCII punctuation inside tokens, keep tokens
    made of letters only, join with one space.

    Punctuation removal never touches whitespace, so it can run once on the whole text;
    the whitespace-delimited runs made only of letters are then found by one regex
    (no per-token regex calls, no lambda).
    """
    text = drop_ascii_punct(F.lower(as_col(c)))
    return join_tokens(F.regexp_extract_all(text, F.lit(r"(?U)(?<!\S)\p{L}+(?!\S)"), 0))


# The "basic_english" normalisation rules (pattern -> replacement), applied
# in this order after lower-casing, then the text is split on whitespace.
BASIC_ENGLISH_RULES = (
    (r"'", " '  "),
    (r'"', ""),
    (r"\.", " . "),
    (r"<br \/>", " "),
    (r",", " , "),
    (r"\(", " ( "),
    (r"\)", " ) "),
    (r"!", " ! "),
    (r"\?", " ? "),
    (r";", " "),
    (r":", " "),
    (r"(?U)\s+", " "),
)


def basic_english_tokens(c: str | Column) -> Column:
    """The basic English tokenizer.

    Equivalent to applying ``BASIC_ENGLISH_RULES`` in order and splitting on whitespace,
    in three cheap passes and one token scan: since the text is split at the end, the
    spacing the rules add around ' . , ( ) ! ? only makes each of those characters a
    token of its own, which one replacement does for all of them.  The order of the three
    deletions/replacements (quote, <br />, ; and :) is the rules' order.
    """
    s = F.translate(F.lower(as_col(c)), '"', "")
    # one pass for "<br />" (-> spaces) and for spacing ' . , ( ) ! ?: spacing those
    # characters can neither create nor split a "<br />", so the order between them is
    # free; ; and : become spaces afterwards, as in the rules
    s = F.regexp_replace(s, r"<br />|([',.()!?])", " $1 ")
    s = F.translate(s, ";:", "  ")
    return split_whitespace(s)


def basic_english_tokens_by_rules(c: str | Column) -> Column:
    """The literal rule chain (12 regex passes); kept to test the fast form against."""
    s = F.lower(as_col(c))
    for pat, rep in BASIC_ENGLISH_RULES:
        s = F.regexp_replace(s, pat, rep)
    return F.filter(F.split(s, WS), lambda t: t != "")


def truncate_words(c: str | Column, n: int) -> Column:
    """The first n whitespace-separated words joined by one space.

    The truncation is the feature, so only the first n words are scanned: one regex
    captures them (up to n-1 word+space pairs, then a word) and the whitespace inside
    the capture is collapsed.  Same result as joining ``slice(split, 1, n)``."""
    head = F.regexp_extract(as_col(c), r"(?U)^\s*((?:\S+\s+){0,%d}\S+)" % (n - 1), 1)
    return F.regexp_replace(head, WS, " ")


def remove_stop_words(tokens: Column, stop_words) -> Column:
    """L3: keep repeats of non-stop words (``array_except`` would drop them)."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(tokens, lambda t: ~F.array_contains(stops, t))
