"""File name, suffix and stem of a path, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-case text after the last dot of the base name, '' when there is none.

    A dot that opens the name (``.csv``) or closes it (``name.``) starts no suffix.
    """
    return F.lower(F.regexp_extract(base_name(path), r"^.+\.([^.]+)$", 1))


def stem(path: Column) -> Column:
    """The base name without its last suffix."""
    return F.regexp_replace(base_name(path), r"^(.+)\.[^.]+$", "$1")


def route_key(source: Column, destination: Column) -> Column:
    """``Source-Destination``; a NULL side is left out together with the dash."""
    return F.concat_ws("-", source, destination)
