"""Text clean-up for symbols and summaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: what does not count as a word character.
NON_WORD = r"[^\p{L}\p{N}_]"

# a record is parts between blanks, a part is entries between commas; both may be quoted or escaped
_QUOTED = r'\\.|"(?:[^"\\]++|\\.)*+"'
_PART = rf'(?:[^ \\"]++|{_QUOTED})++'
_ENTRY = rf'(?:[^,\\"]++|{_QUOTED})++'

SUMMARY_CHARS = 75


def sanitize(text: Column | str) -> Column:
    """Every character that is not a letter, digit or underscore becomes an underscore."""
    return F.regexp_replace(text, NON_WORD, "_")


def summarize(text: Column | str, chars: int = SUMMARY_CHARS) -> Column:
    """At most ``chars`` characters, ``..`` where cut, double quotes as ``&quot;``."""
    text = F.col(text) if isinstance(text, str) else text
    cut = F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit(".."))).otherwise(text)
    return F.replace(cut, F.lit('"'), F.lit("&quot;"))


def strip_empty_fields(line: Column | str) -> Column:
    """Drop ``name=`` entries without a value from an encoded record.

    Symbols and fields are taken apart first, so a field never becomes a symbol. A line that
    does not fall into parts and entries is returned as it is.
    """
    line = F.col(line) if isinstance(line, str) else line
    parts = F.regexp_extract_all(line, F.lit(_PART), F.lit(0))

    def filled(part):
        entries = F.regexp_extract_all(part, F.lit(_ENTRY), F.lit(0))
        return F.array_join(F.filter(entries, lambda e: ~F.endswith(e, F.lit("=")) | F.endswith(e, F.lit("\\="))), ",")

    kept = F.filter(F.transform(parts, filled), lambda p: p != "")
    return F.when(F.array_join(parts, " ") == line, F.array_join(kept, " ")).otherwise(line)
