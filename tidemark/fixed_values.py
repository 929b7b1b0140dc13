"""Names, codes, limits and patterns that results depend on.

They must equal the published market formats exactly; nothing here is logic.
"""

# Region codes kept by ingestion, in display order.
REGIONS = ("NSW1", "QLD1", "VIC1", "SA1", "TAS1")

# Feed precedence for actuals; a feed not listed ranks after all of these.
SOURCE_PRECEDENCE = ("mmsdm", "report_archive")

# Market rules.
SPIKE_THRESHOLD = 300.0
DAY_OFFSET_MINUTES = 245
INTERVALS_PER_DAY = 288
MIN_FORECAST_PERIODS = 40
EARLY_CUTOFF_HOURS = 13
DECISION_CUTOFF_HOURS = 20
FINAL_DELAY_MINUTES = 5
RUN_LEAD_MINUTES = 30
ROLLING_ROWS = 7

# Rows a healthy day holds per table family, and the share below which it is thin.
EXPECTED_ROWS_PER_DAY = {"dispatch": 1440, "predispatch": 13000}
THIN_SHARE = 0.8
THIN_DAYS = 3

# Range reads.
PAGE_ROWS = 10000
MAX_PAGE_ROWS = 50000
LOOKAHEAD_DAYS = 3

# Column allow-lists per warehouse table: (column, Spark type).
KEEP = {
    "dispatchprice": (
        ("settlementdate", "timestamp_ntz"), ("regionid", "string"),
        ("intervention", "int"), ("rrp", "double"), ("price_status", "string"),
        ("apcflag", "int"), ("marketsuspendedflag", "int"),
        ("raise6secrrp", "double"), ("raise60secrrp", "double"),
        ("raise5minrrp", "double"), ("raiseregrrp", "double"),
        ("lower6secrrp", "double"), ("lower60secrrp", "double"),
        ("lower5minrrp", "double"), ("lowerregrrp", "double"),
        ("raise1secrrp", "double"), ("lower1secrrp", "double"),
    ),
    "dispatchregionsum": (
        ("settlementdate", "timestamp_ntz"), ("regionid", "string"),
        ("intervention", "int"), ("totaldemand", "double"),
        ("availablegeneration", "double"), ("availableload", "double"),
        ("demandforecast", "double"), ("dispatchablegeneration", "double"),
        ("dispatchableload", "double"), ("netinterchange", "double"),
        ("excessgeneration", "double"), ("initialsupply", "double"),
        ("clearedsupply", "double"), ("uigf", "double"),
        ("semischedule_clearedmw", "double"),
        ("semischedule_compliancemw", "double"),
        ("totalintermittentgeneration", "double"),
    ),
    "predispatchprice": (
        ("predispatchseqno", "string"), ("run_datetime", "timestamp_ntz"),
        ("datetime", "timestamp_ntz"), ("regionid", "string"),
        ("intervention", "int"), ("rrp", "double"), ("eep", "double"),
        ("lastchanged", "timestamp_ntz"),
        ("rrp1", "double"), ("rrp2", "double"), ("rrp3", "double"),
        ("rrp4", "double"), ("rrp5", "double"), ("rrp6", "double"),
        ("rrp7", "double"), ("rrp8", "double"),
    ),
    "predispatchregionsum": (
        ("predispatchseqno", "string"), ("run_datetime", "timestamp_ntz"),
        ("datetime", "timestamp_ntz"), ("regionid", "string"),
        ("intervention", "int"), ("totaldemand", "double"),
        ("availablegeneration", "double"), ("availableload", "double"),
        ("demandforecast", "double"), ("netinterchange", "double"),
        ("excessgeneration", "double"), ("initialsupply", "double"),
        ("clearedsupply", "double"), ("uigf", "double"),
        ("ss_solar_uigf", "double"), ("ss_wind_uigf", "double"),
        ("semischedule_clearedmw", "double"), ("lastchanged", "timestamp_ntz"),
    ),
}

# Provenance columns every stored row carries.
PROVENANCE = (
    ("source", "string"), ("known_at", "timestamp_ntz"),
    ("known_at_kind", "string"), ("ingested_at", "timestamp_ntz"),
    ("source_file", "string"),
)

# Run identifiers in coalescing order, and the texts that mean "missing".
VINTAGE_COLUMNS = ("run_datetime", "predispatchseqno", "lastchanged")
MISSING_TEXTS = ("nan", "NaT", "None", "", "<NA>")

# Report label -> warehouse table.
TABLE_ALIASES = {
    "PREDISPATCHREGION_PRICES": "PREDISPATCHPRICE",
    "PREDISPATCHREGION_SOLUTION": "PREDISPATCHREGIONSUM",
}

# File-name stamps and the report time format.
PUBLISHED_STAMP = r"(?i)_(\d{14})\.(?:zip|csv)$"
INTERVAL_STAMP = r"_(\d{12})(?:_|\.)"
RUN_STAMP = r"_(\d{12})_"
DAY_STAMP = r"_(\d{8})"
CURRENT_PATH_MARK = "Current"
REPORT_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"

# Scenario prices of one forecast row.
SENSITIVITY_COLUMNS = ("rrp1", "rrp2", "rrp3", "rrp4", "rrp5", "rrp6", "rrp7", "rrp8")

# Seasons by month number.
SUMMER_MONTHS = (12, 1, 2)
WINTER_MONTHS = (6, 7, 8)

# Dictionary timing classes in reading order; anything else comes last.
TIMING_ORDER = ("key", "target", "outcome")
SAFE_TIMINGS = ("key", "target", "feature")

# Benchmark periods: first day after the period -> label; the rest takes the last one.
BENCHMARK_PERIODS = (("2025-01-01", "2023-24"), ("2026-01-01", "2025"))
BENCHMARK_LAST_PERIOD = "2026"

# Exploration defaults.
EXCEEDANCE_THRESHOLDS = (100, 200, 300, 500, 1000, 5000)
HISTOGRAM_RANGE = (-200.0, 500.0)
HISTOGRAM_BINS = 200
CLIP_RANGE = (-200.0, 2000.0)
