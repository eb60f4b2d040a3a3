"""They must equal the ones of the market feed and its consumers."""

# --- fixed values: scopes -------------------------------------------------
GLOBAL_LOC = 0

# --- fixed values: regions ------------------------------------------------
FIRST_REGION, LAST_REGION = 10000001, 10000069
REGIONS_WITHOUT_FEED = (10000024, 10000026)
SELECTABLE_REGIONS_BELOW = 11000000
UNSELECTABLE_REGIONS = (10000004, 10000017)
EMPIRE_CLASS = 2

# --- fixed values: feed ---------------------------------------------------
FIRST_STRUCTURE_ID = 100000000
MARKET_STRUCTURE_TYPES = (35826, 35827, 35833, 35834, 40340)
SNAPSHOTS_PER_BUCKET, BUCKETS = 100, 10

# --- fixed values: depth statistics ----------------------------------------
OUTLIER_FACTOR = 100
BEST_SHARE = 20  # the best twentieth, five percent, of the volume
EMPTY_STATISTIC = 0.01

# --- fixed values: lifetimes ------------------------------------------------
AGGREGATE_TTL_SECONDS = 5400
RETENTION_DAYS = 2

# --- fixed values: the item board --------------------------------------------
BOARD_STATION = 60003760
BOARD_ITEMS = (
    (34, "Tritanium"),
    (35, "Pyrite"),
    (36, "Mexallon"),
    (37, "Isogen"),
    (38, "Nocxium"),
    (39, "Zydrine"),
    (40, "Megacyte"),
    (11399, "Morphite"),
    (44992, "PLEX"),
    (40520, "Skill Injector"),
)

# --- fixed values: names of the eight statistics in a lookup document ---------
STATISTIC_NAMES = (
    "weightedAverage",
    "max",
    "min",
    "stddev",
    "median",
    "volume",
    "orderCount",
    "percentile",
)

# --- fixed values: column order of the snapshot file ---------------------------
SNAPSHOT_COLUMNS = (
    "order_id",
    "type_id",
    "issued",
    "buy",
    "volume",
    "volume_entered",
    "min_volume",
    "price",
    "station_id",
    "range",
    "duration",
    "region_id",
    "order_set",
)

# --- fixed values: pasted lines --------------------------------------------------
# (pattern, group of the name, group of the quantity or None for one unit);
# tried from the top on the trimmed, lower-cased line, the first match decides.
PASTE_SKIP = "blueprint copy"
PASTE_TRIM = " \t\n\r\0\x0b"
PASTE_RULES = (
    (r"^(30 day pilot.*)\t(\d+)\t(.*)$", 1, 2),
    (r"^(.*) \((\d+) units\)$", 1, 2),
    (r"^(.*)\t.*\t(\d+)$", 1, 2),
    (r"^(\d+) (.*)$", 2, 1),
    (r"^(.*)\t([\d\.,]+)\t", 1, 2),
    (r"^(.*):\s+([\d.,]+)", 1, 2),
    (r"^(.*)\t([\d.,]+)", 1, 2),
    (r"^\[(.*),.*]", 1, None),
    (r"^(.*), Qty: (\d+)", 1, 2),
    (r"^.*\t(.*)\t.*", 1, None),
    (r"^(.*)", 1, None),
)
# Rules whose quantity loses its commas before it is read as a number.
PASTE_RULES_WITHOUT_COMMAS = (6, 7)
