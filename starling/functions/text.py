"""Text expressions: tags, words, matches, censoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a link, as part of a word, and as a letter.
URL = r"(https?|ftp)://[^\t\r\n /$.?#][^\t\r\n ]*"
WORD_CHARS = r"[a-zA-Z0-9'-]+"
LETTER = r"[a-zA-Z]"

# Runs of letters and digits of any script, and the runs between them. Characters beyond U+FFFF end a run.
_ALNUM = r"[\p{IsAlphabetic}\p{IsDigit}&&[\x{0}-\x{FFFF}]]"
_RUNS = rf"{_ALNUM}+|(?:(?!{_ALNUM})[\s\S])+"


def join_tags(tags: Column) -> Column:
    """Comma text of an array of tags; a null array gives empty text."""
    return F.concat_ws(",", tags)


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def split_tags(tags: Column) -> Column:
    """Split on commas; empty items at the end are dropped, others are kept."""
    trimmed = F.regexp_replace(tags, ",+$", "")
    return F.when((trimmed == "") & (tags != ""), F.array().cast("array<string>")).otherwise(F.split(trimmed, ","))


def prefix_until(text: Column, sep: str) -> Column:
    """Text before the first separator; empty where there is none."""
    at = F.locate(sep, text)
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).when(text.isNotNull(), F.lit(""))


def append(text: Column, suffix: str) -> Column:
    return F.concat(text, F.lit(suffix))


def strip_urls(text: Column) -> Column:
    """Links become one space, so the words around them stay apart."""
    return F.regexp_replace(text, URL, " ")


def tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits, apostrophes and hyphens."""
    return F.regexp_extract_all(text, F.lit(WORD_CHARS), F.lit(0))


def is_word(token: Column) -> Column:
    return token.rlike(LETTER)


def words(text: Column) -> Column:
    """Lower-cased tokens with at least one letter.

    Lower-casing comes after the split: some letters outside ASCII have lower-case forms inside it.
    """
    return F.transform(F.filter(tokens(text), is_word), F.lower)


def effective_words(text: Column, stop: Sequence[str]) -> Column:
    """Number of words outside links that are not stop words."""
    return F.size(F.filter(words(strip_urls(text)), lambda w: ~w.isin(*stop) if stop else F.lit(True)))


def count_matches(text: Column, pattern: Column) -> Column:
    """Non-overlapping, case-sensitive occurrences; none for an empty pattern or empty text."""
    removed = F.length(text) - F.length(F.replace(text, pattern, F.lit("")))
    return F.coalesce((removed / F.nullif(F.length(pattern), F.lit(0))).cast("bigint"), F.lit(0).cast("bigint"))


def runs_of(text: Column) -> Column:
    """Runs of letters and digits, and the runs between them: joined they are the text."""
    return F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0))


def mask_runs(text: Column, is_banned: Callable[[Column], Column], mask_last: bool) -> Column:
    """Star out the inside of the runs whose lower case is banned; of the last one only if mask_last is set."""
    runs = runs_of(text)

    def mask(run: Column) -> Column:
        starred = F.concat(F.left(run, F.lit(1)), F.repeat(F.lit("*"), F.length(run) - 2), F.right(run, F.lit(1)))
        return F.when(is_banned(F.lower(run)), starred).otherwise(run)

    if mask_last:
        return F.array_join(F.transform(runs, mask), "")
    body = F.transform(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))), mask)
    return F.concat(F.array_join(body, ""), F.coalesce(F.try_element_at(runs, F.lit(-1)), F.lit("")))


def censor(text: Column, banned: Sequence[str], mask_last: bool = False) -> Column:
    """Star out the inside of banned words, whatever their case; for lists that fit into an expression.

    A word that ends the text is left alone unless mask_last is set.
    """
    terms = [term for term in banned if len(term) > 2]
    return mask_runs(text, lambda run: run.isin(*terms), mask_last) if terms else text


def rot13(text: Column) -> Column:
    """Shift lower-case letters by half the alphabet; other characters stay."""
    plain = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(text, plain, plain[13:] + plain[:13])


def format_contact(uid: Column, screen_name: Column, description: Column, latest_post: Column) -> Column:
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (uid, screen_name, description, latest_post)]
    return F.concat_ws("\t", *fields)


def format_topic(word: Column, score: Column) -> Column:
    return F.format_string("%s:%.2f", word, score)


def format_post(impact: Column, tid: Column, text: Column) -> Column:
    return F.concat_ws("\t", impact.cast("string"), tid.cast("string"), text)
