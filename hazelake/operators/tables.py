"""Dictionaries that live in tables: aliases of names, and hints inside place names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.functions.text import place_key, text_key

#: A dictionary of up to so many entries, some tens of megabytes, is sent to every task; a larger one is shuffled.
MOST_BROADCAST = 200_000
#: Parts that the rows of each alias are dealt to where both sides are shuffled.
SALTS = 16


class AmbiguousAlias(ValueError):
    """One alias stands for several names."""


def checked_aliases(aliases: DataFrame) -> DataFrame:
    """``key, name`` of a dictionary ``alias, name``, one row for each key.

    Aliases are compared by their text key, so that ``PM-2.5`` and ``pm 2.5`` are one. Repeated entries count once; a key
    with two names is an error that names the first few. A null alias or name says nothing.
    """
    entries = aliases.select(text_key(F.col("alias")).alias("key"), "name").where("key is not null and name is not null")
    known = entries.groupBy("key").agg(F.min("name").alias("name"), F.max("name").alias("other"))
    twice = known.where(F.col("name") != F.col("other")).orderBy("key").limit(5).collect()
    if twice:
        raise AmbiguousAlias("; ".join(f"{row.key!r} means {row.name!r} and {row.other!r}" for row in twice))
    return known.select("key", "name")


def with_names(
    df: DataFrame, text_col: str, aliases: DataFrame, name_col: str, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """``df`` with the name that its text is an alias of as ``name_col``; null where it is none, so that no row is lost.

    A dictionary that a count shows to be small is broadcast, and the rows stay where they are. Otherwise both sides are
    shuffled, each alias to ``SALTS`` places among which its rows are dealt, so that one alias that holds a third of all
    rows is no single task.
    """
    known = checked_aliases(aliases).select(F.col("key").alias("_alias"), F.col("name").alias("_name"))
    keyed = df.withColumn("_alias_key", text_key(F.col(f"`{text_col}`")))
    same = F.col("_alias_key") == F.col("_alias")
    if known.limit(most_broadcast + 1).count() <= most_broadcast:
        joined = keyed.join(F.broadcast(known), same, "left")
    else:
        salted = keyed.withColumn("_salt", F.floor(F.rand(7) * SALTS).cast("int"))
        copies = known.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        here = same & (F.col("_salt") == F.col("_copy"))
        joined = salted.hint("shuffle_hash").join(copies.hint("shuffle_hash"), here, "left")
    names = [F.col(f"`{name}`") for name in df.columns if name != name_col]
    return joined.select(*names, F.col("_name").alias(name_col))


def _windows(key: Column, length: int) -> Column:
    """All substrings of one length."""
    starts = F.sequence(F.lit(1), F.length(key) - length + 1)
    found = F.transform(starts, lambda at: F.substring(key, at, F.lit(length)))
    return F.when(F.length(key) >= length, found).otherwise(F.array().cast("array<string>"))


def states_of_places(places: DataFrame, hints: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``place, state`` of the distinct texts of ``places(place)`` that hold a hint of ``hints(hint, state, rank)``.

    Of several hints in a place the one of the highest rank decides, of equal ranks the later in the alphabet. Substrings of the lengths that
    occur among the hints are looked up by equality, so that thousands of hints cost no more than one; the driver sees
    the lengths only. Each distinct place is looked at once.
    """
    keyed = hints.select(place_key(F.col("hint")).alias("hint"), "state", "rank").where("hint <> '' and state is not null")
    lengths = sorted(row[0] for row in keyed.select(F.length("hint")).distinct().collect())
    named = places.select("place").distinct().withColumn("key", place_key(F.col("place")))
    if not lengths:
        return named.select("place", F.lit(None).cast("string").alias("state")).limit(0)
    windows = [_windows(F.col("key"), length) for length in lengths]
    pieces = named.select("place", F.explode(F.array_distinct(F.concat(*windows))).alias("hint"))
    small = keyed.limit(most_broadcast + 1).count() <= most_broadcast
    found = pieces.join(F.broadcast(keyed) if small else keyed, "hint")
    return found.groupBy("place").agg(F.max_by("state", F.struct("rank", "hint", "state")).alias("state"))


def with_place_state(df: DataFrame, place_col: str, hints: DataFrame, state_col: str = "state") -> DataFrame:
    """``df`` with the state that a table of hints gives its place; a state that is there already stays."""
    places = df.select(F.col(f"`{place_col}`").alias("place")).where("place is not null")
    known = states_of_places(places, hints).select(F.col("place").alias("_place"), F.col("state").alias("_state"))
    joined = df.join(known, F.col(f"`{place_col}`") == F.col("_place"), "left")
    own = F.col(f"`{state_col}`") if state_col in df.columns else F.lit(None).cast("string")
    names = [F.col(f"`{name}`") for name in df.columns if name != state_col]
    return joined.select(*names, F.coalesce(own, F.col("_state")).alias(state_col))
