"""Fixed values and tunables.

The block below holds values that must equal the reference's for the same
results; they are stated plainly and kept together.
"""

# ---- fixed values (must match the reference's rules) ----------------------
REJECT_RATE_ALERT_THRESHOLD = 0.02        # alert when reject ratio > 0.02 (strict)
FRESHNESS_ALERT_THRESHOLD_MINUTES = 10    # alert when newest valid reading > 10 min old
LAT_RANGE = (48.0, 49.5)                  # inclusive bounding box, latitude
LON_RANGE = (1.5, 3.0)                    # inclusive bounding box, longitude
CAPACITY_TOLERANCE = 2                    # bikes + docks may exceed capacity by 2 at ingest
AUDIT_CAPACITY_TOLERANCE = 5              # functional audit tolerance (dashboard, notebook)
EARTH_RADIUS_KM = 6371.0                  # haversine radius
TRUE_FLAG = "OUI"                         # feed encodes booleans as this string
HISTOGRAM_BINS = 30
TOP_N_STATIONS = 10
LATEST_ALERTS = 20
LATENCY_TARGET_MINUTES = 5                # from observation to the stored row
TOP_FEATURES = 15
RECOMMEND_TOP_N = 3
POLL_INTERVAL_SECONDS = 60
PAGE_SIZE = 100                           # records per fetched envelope
ALERT_TYPES = ("TAUX_REJET_ELEVE", "FRAICHEUR_DEGRADEE", "API_REPONSE_VIDE",
               "API_INDISPONIBLE", "SCHEMA_INVALIDE")
SEVERITIES = ("INFO", "WARNING", "CRITICAL")
# column length limits of the relational model (become quality predicates)
MAX_LEN_STATION_ID = 64
MAX_LEN_NAME = 255
MAX_LEN_COMMUNE = 128
MAX_LEN_BATCH_ID = 64
MAX_LEN_ALERT_TYPE = 64
INT4_MAX = 2147483647
# demand-model hyper-parameters of the reference notebook
SPLIT_TRAIN_PERCENT = 80
RF_TREES, RF_DEPTH = 200, 12
GBT_ROUNDS, GBT_DEPTH, GBT_STEP = 200, 3, 0.1
SEED = 42
# ---------------------------------------------------------------------------

# Feed-gap alert (re-aimed API_INDISPONIBLE): gap between consecutive fetch
# minutes of one source longer than this many minutes.
FEED_GAP_MINUTES = 10

# Topic / source names used by the pipeline.
SOURCE_STATIONS = "stations"
SOURCE_AVAILABILITY = "disponibilite"

# Offsets of the derived topics: slot number in the high bits, page in the low ones.
PAGES_PER_SLOT = 1 << 32
