"""String helpers that follow Unicode whitespace, not just the space character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space: what \s and \p{Z} cover plus the separators they miss.
BLANK_CLASS = r"\s\p{Z}\x0b\x1c-\x1f\x85"


def is_nonblank(text: Column) -> Column:
    """True when ``text`` holds at least one character that is not white space."""
    return F.coalesce(text.rlike(f"[^{BLANK_CLASS}]"), F.lit(False))


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text, rf"^[{BLANK_CLASS}]+|[{BLANK_CLASS}]+\z", "")


def preview(text: Column, n: int, always_dots: bool = False, dots: bool = True) -> Column:
    """First ``n`` characters, with ``...`` when cut (or always, or never)."""
    cut = F.substring(text, 1, n)
    if not dots:
        return cut
    dotted = F.concat(cut, F.lit("..."))
    return dotted if always_dots else F.when(F.length(text) > n, dotted).otherwise(text)


def escape_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def json_text(value: Column) -> Column:
    """Compact JSON of a struct, null fields kept; a null struct is ``{}``."""
    return F.coalesce(F.to_json(value, {"ignoreNullFields": "false"}), F.lit("{}"))
