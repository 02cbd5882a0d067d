"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# What counts as a link, a mention and a repost marker in a post.
URL_PATTERN = r"https?:\/\/[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b([-a-zA-Z0-9()@:%_\+.~#?&//=]*)"
MENTION_PATTERN = r"@[A-Za-z0-9-_]+"
REPOST_PREFIX_PATTERN = r"^RT\s+@[A-Za-z0-9_-]+:?\s*"
# gensim's documented simple_preprocess defaults.
TOKEN_PATTERN = r"(?U)((?:(?!\d)\w)+)"
TOKEN_MIN_LEN = 2
TOKEN_MAX_LEN = 15


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def title_case(text: Column) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the others."""
    chars = F.split(F.lower(text), "")
    before = F.concat(F.array(F.lit("")), F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))))
    cased = F.zip_with(chars, before, lambda x, p: F.when(p.rlike(r"\p{L}"), x).otherwise(F.upper(x)))
    return F.array_join(cased, "")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, "")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION_PATTERN, "")


def strip_repost_prefix(text: Column) -> Column:
    return F.regexp_replace(text, REPOST_PREFIX_PATTERN, "")


def strip_noise(text: Column) -> Column:
    return strip_mentions(strip_urls(text))


def tokenize(text: Column) -> Column:
    """Lower-cased runs of non-digit word characters, 2 to 15 long, not starting with ``_``."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 1)
    return F.filter(
        runs,
        lambda t: F.length(t).between(TOKEN_MIN_LEN, TOKEN_MAX_LEN) & ~t.startswith("_"),
    )


def remove_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True if ``text`` contains one of the literal ``terms``."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | text.contains(term)
    return hit


def topic_flag(text: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    low = F.lower(text)
    return contains_any(low, include) & ~contains_any(low, exclude)


def natural_sort_key(text: Column) -> Column:
    """Sort key in which digit runs compare as numbers of any length.

    A run becomes its number of digits (as ten digits), then the digits without leading zeros.
    """
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), 1)
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), _sized(p)).otherwise(p))
    return F.array_join(padded, "")


def _sized(digits: Column) -> Column:
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.concat(F.lpad(F.length(short).cast("string"), 10, "0"), short)
