import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazelake.dictionaries import (
    DEFAULT_UNITS,
    PLACE_STATES,
    POLLUTANT_ALIASES,
    STATE_ALIASES,
    UNIT_ALIASES,
)
from hazelake.functions.naming import (
    canonical_pollutant,
    canonical_state,
    canonical_unit,
    state_from_place,
)
from hazelake.functions.text import lookup, text_key
from hazelake.operators.standardize import with_pollutant_and_unit, with_state


def applied(spark, texts, expression):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, x string")
    return [row.y for row in rows.select("i", expression.alias("y")).orderBy("i").collect()]


def check(spark, cases, function):
    texts = list(cases)
    assert dict(zip(texts, applied(spark, texts, function(F.col("x"))))) == cases


def test_every_pollutant_alias_in_any_dress(spark):
    dressed = {}
    for alias, name in POLLUTANT_ALIASES.items():
        dressed[alias] = name
        dressed[f"  {alias.upper()} "] = name
        dressed[alias.replace(" ", " \t ")] = name
        dressed[alias.replace(" ", "_-")] = name
    check(spark, dressed, canonical_pollutant)


def test_pollutants_without_alias_keep_their_upper_case_text(spark):
    check(
        spark,
        {
            "pm-10": "PM10",
            "pm2_5": "PM2_5",
            "pm 25": "PM 25",
            " mystery  gas ": "MYSTERY  GAS",
            "\tco": "\tCO",
            "co\t": "CO\t",
            "-co": "-CO",
            "": "",
            "   ": "",
            None: None,
        },
        canonical_pollutant,
    )


def test_canonical_pollutants_are_fixed_points(spark):
    names = {name: name for name in set(POLLUTANT_ALIASES.values())}
    # A name whose key is no alias stays as it is, underscores included.
    check(spark, names, canonical_pollutant)


def test_units(spark):
    cases = {
        "µg/m³": "ug/m3",
        "μg/m³": "ug/m3",
        "ΜG/M³": "ug/m3",
        " UG / M3 ": "ug/m3",
        "ugm-3": "ug/m3",
        "u g\tm 3": "ug/m3",
        "ppmv": "ppm",
        "PPBV": "ppb",
        "%": "percent",
        "Percentage": "percent",
        "C": "celsius",
        "deg C": "celsius",
        "particles/cm3": "particles/cm3",
        "particles/cm³": "particles/cm3",
        "mg/m3": "mg/m3",
        "ug/m ³": "ug/m³",
        "³": "³",
        "": "ppm",
        "  \t": "ppm",
        None: "ppm",
    }
    check(spark, cases, lambda x: canonical_unit(x, F.lit("CO")))


def test_each_unit_alias_and_default(spark):
    check(spark, UNIT_ALIASES, lambda x: canonical_unit(x, F.lit(None).cast("string")))
    check(spark, DEFAULT_UNITS | {"OTHER": None}, lambda x: canonical_unit(None, x))


def test_pollutant_and_unit_of_a_frame(spark):
    raw = spark.createDataFrame(
        [
            ("Sulphur dioxide", " PPBV "),
            ("so2", "mg/m3"),
            ("OZONE", None),
            ("radon", None),
        ],
        "pollutant string, unit string",
    )
    found = [(row.pollutant, row.unit) for row in with_pollutant_and_unit(raw).collect()]
    plain = raw.select(canonical_pollutant(F.col("pollutant")).alias("p"), "unit")
    assert found == [tuple(r) for r in plain.select("p", canonical_unit(F.col("unit"), F.col("p"))).collect()]
    assert found[2] == ("O3", DEFAULT_UNITS["O3"]) and found[3] == ("RADON", None)


def test_frame_columns_may_be_named_otherwise_or_missing(spark):
    raw = spark.createDataFrame([("o3", "ppbv")], "name string, measure string")
    named = with_pollutant_and_unit(raw, "name", "measure")
    assert named.columns == ["name", "measure", "pollutant", "unit"]
    assert named.first()[2:] == ("O3", "ppb")
    without = with_pollutant_and_unit(raw.select("name"), "name")
    assert without.first() == ("o3", "O3", "ppm")
    ignored = with_pollutant_and_unit(raw, "name", None)
    assert ignored.first().unit == "ppm"


def test_states(spark):
    cases = dict(STATE_ALIASES) | {
        "  Wilayah_Persekutuan--Labuan": "Labuan",
        "W.P.  Putrajaya": "Putrajaya",
        "new   south wales": "New South Wales",
        "w.p. kuala-lumpur north": "W.p. Kuala Lumpur North",
        "_johor_": " Johor ",
        "\t": " ",
        "": None,
        "   ": None,
        None: None,
    }
    check(spark, cases, canonical_state)
    check(spark, {name: name for name in set(STATE_ALIASES.values())}, canonical_state)


def test_places(spark):
    cases = {f"The {part.upper()} station": state for part, state in PLACE_STATES.items()} | {
        "Setia \t Eco  Park": "Selangor",
        "setia-eco-park": None,
        "Cyberjaya near KLCC": "Kuala Lumpur",
        "KLCC near Cyberjaya": "Kuala Lumpur",
        "Setia Eco Park, Cyberjaya": "Selangor",
        "elsewhere": None,
        "": None,
        None: None,
    }
    check(spark, cases, state_from_place)


def test_state_of_a_frame(spark):
    raw = spark.createDataFrame(
        [
            ("malacca", "near KLCC"),
            ("ruritania", None),
            (None, "Roof above KLCC"),
            ("", "Cyberjaya lakeside"),
            ("", None),
        ],
        "state string, location_name string",
    )
    expected = ["Melaka", "Ruritania", "Kuala Lumpur", "Selangor", None]
    states = with_state(raw)
    assert states.columns == ["state", "location_name"]
    assert [row.state for row in states.collect()] == expected
    assert with_state(raw.drop("location_name")).collect()[2].state is None
    assert with_state(raw.drop("state")).collect()[2].state == "Kuala Lumpur"
    renamed = raw.withColumnsRenamed({"state": "s", "location_name": "p"})
    assert with_state(renamed, "s", "p").collect()[0].state == "Melaka"


def test_lookup_never_fails(spark):
    assert applied(spark, ["a", "z", None], lookup({"a": "A", "b": "B"}, F.col("x"))) == ["A", None, None]


ALPHABET = st.sampled_from(list("abcPM 2._-\t\n5kl") + ["pm25", "co", "kl", "wp ", "µ", "É"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=6).map("".join), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_against_a_plain_model(spark, texts):
    def key(text):
        spaced = re.sub("[_-]+", " ", text.strip(" ").lower())
        return re.sub(r"[ \t\n\x0b\f\r]+", " ", spaced)

    assert applied(spark, texts, text_key(F.col("x"))) == [key(text) for text in texts]
    pollutants = [POLLUTANT_ALIASES.get(key(text), text.strip(" ").upper()) for text in texts]
    assert applied(spark, texts, canonical_pollutant(F.col("x"))) == pollutants
    known = [STATE_ALIASES.get(key(text)) for text in texts]
    states = applied(spark, texts, canonical_state(F.col("x")))
    assert [b for a, b in zip(known, states) if a] == [a for a in known if a]
    assert all((state is None) == (key(text) == "") for text, state in zip(texts, states))
