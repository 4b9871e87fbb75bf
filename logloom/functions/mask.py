"""Masking of the variable parts of a log line (native expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.coerce import as_column

# What counts as a variable token, and the punctuation around it.
NUMBER = r"-?\d+(?:\.\d+)?(?:ms|us|ns|s|m|h|d|%|b|kb|mb|gb|KB|MB|GB)?"
UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
HEX = r"[0-9a-fA-F]{12,}"
PUNCTUATION = r"""["',;:()\[\]{}]"""
SPACE = r"[\s\u000b\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def has_words(line: Column | str) -> Column:
    """Whether a line holds anything but whitespace."""
    return as_column(line).rlike("[^" + SPACE[1:-2] + "]")


def words(line: Column | str) -> Column:
    """Whitespace-separated tokens of a line."""
    return F.filter(F.split(as_column(line), SPACE), lambda w: w != "")


def _mask_core(part: Column) -> Column:
    for core, tag in ((NUMBER, "<num>"), (UUID, "<uuid>"), (HEX, "<hex>")):
        part = F.regexp_replace(part, f"^({PUNCTUATION}*)(?:{core})({PUNCTUATION}*)$", f"$1{tag}$2")
    return part


def mask_token(token: Column) -> Column:
    """Mask one token: the value after ``key=``, each path segment, else the token itself."""
    prefix = F.regexp_extract(token, r"^((?:[^=]+=)*)([\s\S]*)$", 1)
    rest = F.regexp_extract(token, r"^((?:[^=]+=)*)([\s\S]*)$", 2)
    masked = F.when(
        F.contains(rest, F.lit("/")),
        F.array_join(F.transform(F.split(rest, "/", -1), _mask_core), "/"),
    ).otherwise(_mask_core(rest))
    return F.concat(prefix, masked)


def mask_tokens(line: Column | str) -> Column:
    """Masked tokens of a line.

    Only a token with a digit, or a run of hex letters, can change: lines
    without any, and most words of the others, skip the regex work.
    """
    variable = r"\d|[a-fA-F]{12}"
    text = as_column(line)
    masked = F.transform(
        words(text), lambda w: F.when(w.rlike(variable), mask_token(w)).otherwise(w)
    )
    return F.when(text.rlike(variable), masked).otherwise(words(text))


def mask_line(line: Column | str) -> Column:
    """Template of a line: masked tokens joined by one blank."""
    return F.array_join(mask_tokens(line), " ")
