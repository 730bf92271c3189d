"""Text keys and dictionary lookups shared by the naming rules."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_literal(mapping: Mapping) -> Column:
    """A MapType literal; Catalyst folds it into one constant that ships with the plan."""
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def lookup(mapping: Mapping, key: Column) -> Column:
    """The dictionary's value for ``key``; null for a missing or null key, so no row is ever lost."""
    return map_literal(mapping)[key]


def plain_text(text: Column) -> Column:
    """Trimmed of spaces and lower case."""
    return F.lower(F.trim(text.cast("string")))


def text_key(text: Column) -> Column:
    """Lookup key of a name: plain text with each run of blanks, hyphens and underscores one space."""
    return F.regexp_replace(plain_text(text), r"[\s_-]+", " ")


def place_key(text: Column) -> Column:
    """Like :func:`text_key`, but hyphens and underscores stay."""
    return F.regexp_replace(plain_text(text), r"\s+", " ")


def lookup_name(aliases: Mapping, text: Column) -> Column:
    """Canonical name of a text by its key.

    An alias is its own key, so plain text that is one already is found without building the key; only
    other spellings pay for the regular expression.
    """
    return F.coalesce(lookup(aliases, plain_text(text)), lookup(aliases, text_key(text)))
