"""Text cleaning, language tags and content versions as column functions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLEANING_VERSION = "clean-v1"

# fixed values: white space that NFKC leaves alone
SPACES = "\\t-\\r\\x1c-\\x20\\x85\\u1680\\u2028\\u2029"
#: Steps after NFKC, valid for Java and Python alike; the order matters.
STEPS = (
    (r"\r\n?", "\n"),
    (r"(?s)<!--.*?-->", ""),
    ("[\\u200b\\u200c\\u200d\\ufeff]", ""),
    ("[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]", "\n"),
    ("(?<![\\t\\x1f\\x20\\u1680])[\\t\\x1f\\x20\\u1680]++\\n", "\n"),
    (r"\n{3,}", "\n\n"),
)
_STEPS = tuple((re.compile(p), r) for p, r in STEPS)
_STRIP = re.compile(f"\\A[{SPACES}]+")
_WS = "".join(chr(c) for c in range(0x3000) if re.match(f"[{SPACES}]", chr(c)))


def clean_value(value: str | None) -> str:
    """The cleaned text of one value; null is ''."""
    text = unicodedata.normalize("NFKC", value) if value and not value.isascii() else value or ""
    for pattern, to in _STEPS:
        text = pattern.sub(to, text)
    return text.strip(_WS)


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode NFKC; Spark has no built-in for it. ASCII values pass as they are, null stays null."""
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


def strip_spaces(column: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(column, f"\\A[{SPACES}]+", ""), f"(?<![{SPACES}])[{SPACES}]++\\z", "")


def clean_normalised(column: Column) -> Column:
    """Cleaning of a text that is in NFKC already: all JVM-side. Null is ''."""
    text = F.coalesce(column, F.lit(""))
    for pattern, to in STEPS:
        text = F.regexp_replace(text, pattern, to)
    return strip_spaces(text)


def clean_text(column: Column) -> Column:
    """NFKC, one line end, no HTML comments or invisible characters, no trailing blanks, at most one blank line, stripped."""
    return clean_normalised(nfkc(F.coalesce(column, F.lit(""))))


def language_tag(column: Column) -> Column:
    """zh when there are CJK characters, at least a fifth as many as Latin letters; else en with any Latin letter; else unknown."""
    cjk, latin = F.regexp_count(column, F.lit("[\\u3400-\\u9fff]")), F.regexp_count(column, F.lit("[A-Za-z]"))
    return F.when((cjk > 0) & (cjk >= latin * F.lit(0.2)), "zh").when(latin > 0, "en").otherwise("unknown")


def content_hash(raw_context: Column, raw_text: Column, version: str = CLEANING_VERSION) -> Column:
    """sha-256 of version, context and text, as delivered, with NUL between; null counts as ''."""
    nul = F.lit("\0")
    return F.sha2(F.concat(F.lit(version), nul, F.coalesce(raw_context, F.lit("")), nul, F.coalesce(raw_text, F.lit(""))), 256)


def paragraphs(*parts: Column) -> Column:
    """The parts that aren't null or empty, with a blank line between."""
    return F.concat_ws("\n\n", *(F.nullif(p, F.lit("")) for p in parts))


def model_input(context: Column, target: Column) -> Column:
    return F.concat(F.lit("[CONTEXT]\n"), F.coalesce(F.nullif(context, F.lit("")), F.lit("(none)")), F.lit("\n\n[TARGET]\n"), target)


def number_in_url(column: Column) -> Column:
    """The number that ends an issue or pull URL, else null."""
    return F.nullif(F.regexp_extract(column, r"/(?:issues|pulls)/([0-9]+)$", 1), F.lit("")).try_cast("int")
