"""Normalisation of codes, names and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lower_code(x: Column | str) -> Column:
    return F.lower(F.trim(x))


# Fixed value: characters that end a word in a title.
WORD_BREAKS = r"\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"


def upper_code(x: Column | str) -> Column:
    return F.upper(F.trim(x))


def title_name(x: Column | str) -> Column:
    """Title case; a word starts after white space or any of the fixed punctuation marks."""
    parts = F.regexp_extract_all(F.trim(x), F.lit(f"[^{WORD_BREAKS}]+|[{WORD_BREAKS}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(
        F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, F.lit(2), F.length(p))))), "")


def composite_key(*parts: Column | str) -> Column:
    """Parts joined by '-'; NULL if any part is NULL."""
    pieces: list[Column] = []
    for p in parts:
        if pieces:
            pieces.append(F.lit("-"))
        pieces.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat(*pieces)


def has_text(x: Column | str) -> Column:
    return F.coalesce(F.length(F.trim(x)), F.lit(0)) > 0


def route_label(origin: Column, destination: Column, placeholder: str = "??") -> Column:
    p = F.lit(placeholder)
    return F.concat(F.coalesce(origin, p), F.lit(" -> "), F.coalesce(destination, p))


def same_place(origin: Column, destination: Column, placeholder: str = "??") -> Column:
    """Two unknown places count as the same place."""
    p = F.lit(placeholder)
    return F.coalesce(origin, p) == F.coalesce(destination, p)
