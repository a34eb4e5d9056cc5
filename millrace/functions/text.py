"""Text functions as Column builders.

White space is Unicode's and U+001C to U+001F, as Python's ``\\s``. Two ways of cleaning
differ in order: ``clean_strip_first`` removes tags and then decodes entities, so an escaped
tag stays as text; ``clean_decode_first`` decodes, so it goes.
"""

from __future__ import annotations

import html
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The code points that are white space.
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_ODD = r"\x09-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of white space, as a class that the JVM need not look up by property.
SPACE = f"[ {_ODD}]+"
#: Runs that are not one plain space already, so that most of a text is left as it is.
_TO_ONE = f"[{_ODD}][ {_ODD}]*| [ {_ODD}]+"
TAG = r"<[^>]+>"
BRACKET_TAG = r"\[\[[^\]]*\]\]"


#: A character reference as ``html.unescape`` takes it, closed by a semicolon or not.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescape(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda found: [html.unescape(x) for x in found], na_action="ignore")


def decode_entities(x: Column, names: Iterable[str] | None = None) -> Column:
    """HTML entities decoded as by ``html.unescape``; with ``names`` these alone, and only where a semicolon closes them.

    Spark has no built-in, so an Arrow UDF decodes the references. It runs on every row, whatever
    conditions stand about it, so it is sent the references alone, and null where there are none;
    the text about them stays in the JVM.
    """
    pattern = F.lit(_REFERENCE if names is None else f"&(?:{'|'.join(names)});")
    found = F.when(F.contains(x, F.lit("&")), F.regexp_extract_all(x, pattern, F.lit(0)))
    decoded = _unescape(F.when(F.size(found) > 0, found))
    between = F.zip_with(F.split(x, pattern, -1), decoded, lambda text, ref: F.concat(text, F.coalesce(ref, F.lit(""))))
    return F.when(decoded.isNotNull(), F.array_join(between, "")).otherwise(x)


def normalize_whitespace(x: Column) -> Column:
    return F.btrim(F.regexp_replace(x, _TO_ONE, " "))


def trim(x: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(x, F.lit(SPACES))


def strip_html(x: Column, names: Iterable[str] | None = None) -> Column:
    return decode_entities(F.regexp_replace(x, TAG, " "), names)


def clean_strip_first(x: Column, names: Iterable[str] | None = None) -> Column:
    return normalize_whitespace(strip_html(x, names))


def clean_decode_first(x: Column, names: Iterable[str] | None = None) -> Column:
    return normalize_whitespace(F.regexp_replace(F.regexp_replace(decode_entities(x, names), BRACKET_TAG, " "), TAG, " "))


def content_hash(x: Column) -> Column:
    return F.sha2(x, 256)


def text_hash(x: Column) -> Column:
    """Of the trimmed, lower-cased text."""
    return F.sha2(F.lower(trim(x)), 256)


def review_id(x: Column) -> Column:
    return F.substring(text_hash(x), 1, 16)


def truncate(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def enrich(title: Column, category: Column, text: Column) -> Column:
    """What is embedded in place of the bare text; never stored."""
    name = F.coalesce(F.nullif(title, F.lit("")), category)
    return F.concat(F.lit("Product: "), name, F.lit(" | Review: "), text)


def parent_of(chunk_id: Column) -> Column:
    return F.split_part(chunk_id, F.lit("-"), F.lit(1))


def strip_fence(x: Column) -> Column:
    """A model's answer without a leading ```json and a trailing ```."""
    return trim(F.regexp_replace(F.regexp_replace(trim(x), "^```json", ""), "```$", ""))


def json_field(x: Column, field: str) -> Column:
    """A string field of a JSON object; null for anything else, a bare string included."""
    return F.try_variant_get(F.try_parse_json(x), f"$.{field}", "string")


def python_float(x: Column) -> Column:
    """A rating as Python prints it: 5.0, or None."""
    return F.coalesce(x.cast("double").cast("string"), F.lit("None"))


def context_line(rank: Column, rating: Column, document: Column) -> Column:
    return F.concat(F.lit("["), rank.cast("string"), F.lit("] (rating "), python_float(rating), F.lit(") "), document)
