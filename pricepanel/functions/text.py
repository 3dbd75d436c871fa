"""Text helpers for entity identifiers and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def short_label(entity: Column) -> Column:
    """First four letters, upper case, of the next-to-last dash-separated token."""
    return F.upper(F.substring(F.try_element_at(F.split(entity, "-"), F.lit(-2)), 1, 4))


def strip_suffix(name: Column, suffix: str) -> Column:
    return F.replace(name, F.lit(suffix), F.lit(""))


def display_name(entity: Column, names: dict[str, str]) -> Column:
    """Look up a display name; the identifier itself when there is none."""
    if not names:
        return entity
    mapping = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, entity), entity)
