"""They decide results, so they are stated once, plainly, in natural order."""

# Missing-value markers of the buoy text format.
MISSING_DIRECTION = 999
MISSING_SPEED = 99.0
MISSING_WAVE = 99.0
MISSING_TIDE = 99.0

# What an unreadable token becomes, per column, in file order after the time columns.
OBSERVATION_FILLS = [
    ("wind_direction", "int", 999),
    ("wind_speed", "double", 999.9),
    ("wind_gust", "double", 999.9),
    ("wave_height", "double", 99.0),
    ("dominant_wave_period", "double", 99.0),
    ("average_wave_period", "double", 99.0),
    ("measured_wave_direction", "rounded_int", 999.9),
    ("sea_level_pressure", "double", 999.9),
    ("air_temp", "double", 999.9),
    ("water_temp", "double", 999.9),
    ("dew_point_temp", "double", 999.9),
    ("visibility", "double", 999.9),
    ("tide", "double", 99.0),
]

# Files from this year on carry a minute column, so measurements start one field later.
MINUTE_COLUMN_SINCE = 2005
START_FIELD_WITHOUT_MINUTE = 5
START_FIELD_WITH_MINUTE = 6

# Buoy readings up to and including this instant are not loaded.
EARLIEST_ARCHIVE_TIME = "1999-12-31T23:59:59Z"

# Tide readings below this many millimetres are implausible.
TIDE_FLOOR_MM = -2743

# Rings of cells around a cell in which stations count, and the coast buffer in degrees.
DISK_RINGS = 2
COAST_BUFFER_DEG = 0.6

# Grid step of the wind source in degrees.
WIND_STEP_DEG = 0.25

# Vector search: half width of the time window and the distance bound.
MATCH_WINDOW_MINUTES = 30
SEARCH_RADIUS = 10.0

# Near-real-time files reach back this many days; re-reads of the feed this many 5-minute steps.
REALTIME_DAYS = 45
LATEST_LOOKBACK_STEPS = 576

# Number of work buckets, and size of a backfill batch.
WORK_BUCKETS = 40
BACKFILL_BATCH = 5

# Parameter that carries the usable tide record of an inventory.
TIDE_PARAMETER = "Verified 6-Minute Water Level"

# Named filming spots: (name, latitude, longitude). Clip names carry local time of this zone.
SPOTS = [
    ("jocko's", 21.6217, -158.0838),
    ("laniakea", 21.6190, -158.0852),
    ("alamoanabeachpark", 21.291794, -157.848113),
    ("hi-haleiwa", 21.6028, -158.1074),
    ("sunsetbeach", 33.88073, -78.51223),
]
SPOT_ZONE = "Pacific/Honolulu"

EARTH_RADIUS_M = 6371008.7714
