"""Word lists, limits and constants the cleaning rules look values up in."""

# Every spelling of a pollutant, after key normalisation, and its canonical name.
POLLUTANT_ALIASES = {
    "co": "CO",
    "carbon monoxide": "CO",
    "no": "NO",
    "nitric oxide": "NO",
    "no2": "NO2",
    "nitrogen dioxide": "NO2",
    "o3": "O3",
    "ozone": "O3",
    "so2": "SO2",
    "sulfur dioxide": "SO2",
    "sulphur dioxide": "SO2",
    "pm1": "PM1",
    "pm10": "PM10",
    "pm 10": "PM10",
    "pm2.5": "PM2.5",
    "pm25": "PM2.5",
    "pm 2.5": "PM2.5",
    "bc": "BC",
    "black carbon": "BC",
    "temperature": "TEMPERATURE",
    "relativehumidity": "RELATIVE_HUMIDITY",
    "relative humidity": "RELATIVE_HUMIDITY",
    "humidity": "RELATIVE_HUMIDITY",
    "um003": "PARTICLE_COUNT_0_3UM",
}

# Spellings of units, after unit normalisation, and the canonical unit.
UNIT_ALIASES = {
    "ug/m3": "ug/m3",
    "ugm-3": "ug/m3",
    "ugm3": "ug/m3",
    "ppm": "ppm",
    "ppmv": "ppm",
    "ppb": "ppb",
    "ppbv": "ppb",
    "%": "percent",
    "percent": "percent",
    "percentage": "percent",
    "c": "celsius",
    "celsius": "celsius",
    "degc": "celsius",
    "particles/cm3": "particles/cm3",
}

# The unit assumed when a reading names none.
DEFAULT_UNITS = {
    "CO": "ppm",
    "NO": "ppm",
    "NO2": "ppm",
    "O3": "ppm",
    "SO2": "ppm",
    "PM1": "ug/m3",
    "PM2.5": "ug/m3",
    "PM10": "ug/m3",
    "BC": "ug/m3",
    "TEMPERATURE": "celsius",
    "RELATIVE_HUMIDITY": "percent",
    "PARTICLE_COUNT_0_3UM": "particles/cm3",
}

# Spellings of Malaysian states and federal territories, after key normalisation.
STATE_ALIASES = {
    "johor": "Johor",
    "kedah": "Kedah",
    "kelantan": "Kelantan",
    "melaka": "Melaka",
    "malacca": "Melaka",
    "negeri sembilan": "Negeri Sembilan",
    "n sembilan": "Negeri Sembilan",
    "pahang": "Pahang",
    "penang": "Pulau Pinang",
    "pulau pinang": "Pulau Pinang",
    "perak": "Perak",
    "perlis": "Perlis",
    "sabah": "Sabah",
    "sarawak": "Sarawak",
    "selangor": "Selangor",
    "terengganu": "Terengganu",
    "wp kuala lumpur": "Kuala Lumpur",
    "w.p. kuala lumpur": "Kuala Lumpur",
    "wilayah persekutuan kuala lumpur": "Kuala Lumpur",
    "kuala lumpur": "Kuala Lumpur",
    "kl": "Kuala Lumpur",
    "wp labuan": "Labuan",
    "w.p. labuan": "Labuan",
    "wilayah persekutuan labuan": "Labuan",
    "labuan": "Labuan",
    "wp putrajaya": "Putrajaya",
    "w.p. putrajaya": "Putrajaya",
    "wilayah persekutuan putrajaya": "Putrajaya",
    "putrajaya": "Putrajaya",
}

# Place-name fragments and the state they lie in. When a place name holds several
# fragments, the one listed last decides.
PLACE_STATES = {
    "cyberjaya": "Selangor",
    "setia eco park": "Selangor",
    "taman tun dr. ismail": "Kuala Lumpur",
    "taman tun dr ismail": "Kuala Lumpur",
    "ttdi": "Kuala Lumpur",
    "klcc": "Kuala Lumpur",
    "bukit bintang": "Kuala Lumpur",
}

# Inclusive upper limits of the first five risk labels, per pollutant.
RISK_LIMITS = {
    "PM2.5": [12.0, 35.4, 55.4, 150.4, 250.4],
    "PM10": [54.0, 154.0, 254.0, 354.0, 424.0],
    "CO": [4.4, 9.4, 12.4, 15.4, 30.4],
    "O3": [0.054, 0.070, 0.085, 0.105, 0.200],
    "NO2": [0.053, 0.100, 0.360, 0.649, 1.249],
    "SO2": [0.035, 0.075, 0.185, 0.304, 0.604],
}
RISK_LABELS = [
    "good",
    "moderate",
    "unhealthy_sensitive",
    "unhealthy",
    "very_unhealthy",
    "hazardous",
]
UNKNOWN_RISK = "unknown"

# The two public sources, the country of the daily one, and how their dumps are named.
DAILY_SOURCE = "opendosm"
STATION_SOURCE = "openaq"
SOURCES = (DAILY_SOURCE, STATION_SOURCE)
DAILY_COUNTRY = "Malaysia"
SNAPSHOT_GLOBS = {DAILY_SOURCE: "*.json", STATION_SOURCE: "*_measurements_*.json"}
SNAPSHOT_PREFIXES = {
    DAILY_SOURCE: "opendosm_air_pollution",
    STATION_SOURCE: "openaq_measurements",
}

# Page size and history window of the landing jobs.
PAGE_LIMIT = 1000
DAYS_PER_MONTH = 30
HISTORY_MONTHS = 6
