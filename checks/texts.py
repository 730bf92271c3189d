"""Text lists the check queries spread over the rows of ``events``; shared by Spark and SQL.

Every row of the table gets some text of each list, so each rule meets all its cases and the amount of
work grows with the table.
"""

# Pollutant spellings with the divisor that brings the table's values into the pollutant's range.
POLLUTANTS = [
    ("pm25", 1),
    ("PM 2.5", 1),
    (" Pm2.5 ", 1),
    ("PM-2.5", 1),
    ("pm_25", 1),
    ("pm2_5", 1),
    ("pm10", 1),
    ("PM 10", 1),
    ("pm__10", 1),
    ("pm1", 1),
    ("co", 11),
    ("Carbon  Monoxide", 11),
    ("carbon_-monoxide", 11),
    ("no2", 310),
    ("Nitrogen-Dioxide", 310),
    ("o3", 1900),
    ("OZONE", 1900),
    ("so2", 590),
    ("Sulphur Dioxide", 590),
    ("sulfur dioxide", 590),
    ("no", 1),
    ("Nitric Oxide", 1),
    ("bc", 1),
    ("black\tcarbon", 1),
    ("temperature", 1),
    ("relativehumidity", 1),
    ("Relative Humidity", 1),
    ("humidity", 1),
    ("um003", 1),
    ("mystery gas", 1),
    ("\tco", 1),
    ("", 1),
    (None, 1),
]
UNITS = [
    "µg/m³",
    "μg/m³",
    "UG/M3",
    " ugm-3 ",
    "ug m3",
    "ppm",
    "PPMV",
    "ppb",
    "ppbv",
    "%",
    "Percentage",
    "C",
    "degC",
    "particles/cm3",
    "mg / m3",
    "ug/m ³",
    "",
    "  ",
    None,
]
STATES = [
    "wp kuala lumpur",
    "W.P.  Putrajaya",
    "wilayah_persekutuan labuan",
    "penang",
    "Malacca",
    "n-sembilan",
    "KL",
    "selangor ",
    "  JOHOR",
    "Sabah",
    "new south  wales",
    "w.p. kuala-lumpur north",
    "_johor_",
    "\t",
    "",
    None,
    None,
]
PLACES = [
    "KLCC",
    "Sejati Residences Cyberjaya",
    "Setia  Eco\tPark",
    "Taman Tun Dr. Ismail",
    "taman tun dr ismail (TTDI)",
    "Bukit Bintang near Cyberjaya",
    "Cyberjaya KLCC",
    "setia eco park",
    "bukit-bintang",
    "Some Other Place",
    "",
    None,
]
