"""Canonical pollutant, unit and state names as native column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazelake.dictionaries import (
    DEFAULT_UNITS,
    PLACE_STATES,
    POLLUTANT_ALIASES,
    STATE_ALIASES,
    UNIT_ALIASES,
)
from hazelake.functions.text import lookup, lookup_name, place_key, plain_text, text_key


def canonical_pollutant(name: Column) -> Column:
    """``pm-25``, ``PM 2.5`` → ``PM2.5``; a name without an alias is only trimmed and upper-cased."""
    return F.coalesce(
        lookup_name(POLLUTANT_ALIASES, name),
        F.upper(F.trim(name.cast("string"))),
    )


def unit_key(unit: Column) -> Column:
    """Plain text with ``m³`` as ``m3``, both micro signs as ``u`` and no white space."""
    cubed = F.replace(plain_text(unit), F.lit("m³"), F.lit("m3"))
    return F.translate(cubed, "µμ \t\n\x0b\f\r", "uu")


def canonical_unit(unit: Column | None, pollutant: Column) -> Column:
    """Canonical unit; a blank or absent one falls back to the usual unit of the canonical pollutant.

    Only the name changes: values are never converted between units.
    """
    default = lookup(DEFAULT_UNITS, pollutant)
    if unit is None:
        return default
    key = unit_key(unit)
    return F.coalesce(lookup(UNIT_ALIASES, key), F.when(key != "", key), default)


def canonical_state(state: Column) -> Column:
    """State or federal territory by alias, else the key in title case; blank text is null."""
    key = text_key(state)
    return F.coalesce(lookup_name(STATE_ALIASES, state), F.when(key != "", F.initcap(key)))


def state_from_place(place: Column) -> Column:
    """State of a known place fragment inside a station name; the last-listed fragment wins."""
    return state_from_place_key(place_key(place))


def state_from_place_key(key: Column) -> Column:
    """:func:`state_from_place` for a key that is already a column, so it is computed once."""
    hits = [F.when(key.contains(part), F.lit(state)) for part, state in PLACE_STATES.items()]
    return F.coalesce(*reversed(hits))
