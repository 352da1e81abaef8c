"""Text, array and label expressions. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(column: Column | str) -> Column:
    """Lower case without leading and trailing blanks (blanks only, not tabs)."""
    return F.trim(F.lower(column))


def array_count(array: Column | str, value) -> Column:
    """How often ``value`` occurs in an array; 0 for an empty one."""
    return F.size(F.filter(array, lambda item: item == F.lit(value))).cast("long")


def label_for(key: Column | str, labels: Mapping, default: str) -> Column:
    """Look a key up in a small literal map; unknown and null keys get ``default``."""
    key = F.col(key) if isinstance(key, str) else key
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    if not pairs:
        return F.lit(default)
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def decode_string_list(column: Column | str) -> Column:
    """JSON array of strings → array column; malformed text becomes null."""
    return F.from_json(column, "array<string>")


def encode_string_list(column: Column | str) -> Column:
    """Array column → JSON array text."""
    return F.to_json(column)


def version_number(name: Column | str) -> Column:
    """``v12`` → 12; names of another form give null."""
    name = F.col(name) if isinstance(name, str) else name
    return F.nullif(F.regexp_extract(name, r"^v(\d+)", 1), F.lit("")).try_cast("int")
