"""Text expressions: file-name keys, page markers, entity normalisation, white space as Unicode knows it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide results.
PREFIX = r"(?i)(DOC_\d{4})"
KEY_NOISE = r"[^a-z0-9\\s]+"  # a literal backslash is kept: the class holds it, not white space
PAGE_MARKER = r"(?i)^\s*Page\s+(\d+)\s+of\s+(\d+)\s*\z"
LINE_BREAK = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"
#: White space in the sense of Unicode, with the four information separators.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(x: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+\z", "")


def doc_prefix(name: Column) -> Column:
    """The first DOC_ with four digits, in capitals; '' without one."""
    return F.upper(F.regexp_extract(name, PREFIX, 1))


def base_name(path: Column) -> Column:
    """The last part of a path without its last extension."""
    name = F.regexp_extract(F.regexp_replace(path, r"/+\z", ""), r"([^/]*)\z", 1)
    return strip(F.regexp_replace(name, r"(?<=[^.])(\.[^.]+)\z", ""))


def title_key(path: Column) -> Column:
    """A key that names of one document share: no DOC_ prefix, lower case, runs of other characters one space."""
    plain = F.lower(F.regexp_replace(base_name(path), r"(?i)DOC_\d{4}", ""))
    return strip(F.regexp_replace(F.regexp_replace(plain, KEY_NOISE, " "), r"\\s+", " "))


def entity_text(text: Column) -> Column:
    """Lower case without marks other than hyphen and underscore, white space runs one space."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w\s-]", ""), rf"{BLANK}+", " "))


def clipped(text: Column, most: int = 500) -> Column:
    """Stripped; a longer text is cut to most code points, three of them dots."""
    s = strip(text)
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most - 3), F.lit("..."))).otherwise(s)


def json_text(x: Column) -> Column:
    """A JSON string literal; characters beyond ASCII stay as they are."""
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(x, F.lit("")).alias("v"))), r'^\{"v":|\}\z', "")


def safe_name(number: Column, name: Column) -> Column:
    """DOC_%04d_ and the name's letters, digits, spaces, dots, hyphens and underscores."""
    return F.concat(F.format_string("DOC_%04d_", number), strip(F.regexp_replace(name, r"[^\p{L}\p{Nd} ._-]", "")))


def page_label(name: Column, page: Column) -> Column:
    """A stamp for a page: the name's DOC_ number, else its first two parts, else the name; with the page on three digits."""
    number = F.regexp_extract(name, r"^(DOC_\d+)", 1)
    parts = F.split(name, "_")
    two = F.when(F.size(parts) >= 2, F.concat_ws("_", F.slice(parts, 1, 2))).otherwise(name)
    return F.upper(F.format_string("%s-%03d", F.when(number != "", number).otherwise(two), page))


def utf8(content: Column) -> Column:
    """Text of bytes; bytes that are no UTF-8 are dropped."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def printable_runs(content: Column, least: int = 4) -> Column:
    """Runs of at least so many printable Latin-1 characters of binary content, one a line; a run at the very end is dropped."""
    latin, shown = F.decode(content, "ISO-8859-1"), r"\x20-\x7e\xa1-\xac\xae-\xff"
    return F.array_join(F.regexp_extract_all(latin, F.lit(rf"([{shown}]{{{least},}})(?=[^{shown}])"), 1), "\n")


def relevance(status: Column, explanation: Column) -> Column:
    """'status: explanation', the status Unknown where there is none."""
    return F.concat(F.coalesce(status, F.lit("Unknown")), F.lit(": "), F.coalesce(explanation, F.lit("")))


def utc_text(moment: Column) -> Column:
    """A moment as ISO text that ends in Z, with microseconds; the session's zone must be UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def stamp(moment: Column) -> Column:
    """A moment for file names: 20240131_235959."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")
