"""They must equal the archive format's own for results to agree."""

# --- fixed values: format versions -------------------------------------------
SIDECAR_FORMAT_VERSION = 1
MANIFEST_FORMAT_VERSION = 1
PARQUET_FORMAT_VERSION = 1
SCHEMA_NESTED = 1
SCHEMA_FLATTENED = 2
SUPPORTED_SCHEMA_VERSIONS = (SCHEMA_NESTED, SCHEMA_FLATTENED)

# --- fixed values: stream kinds and their published directory -----------------
KINDS = ("vehicle_position", "trip_update", "alert", "mixed", "auto")
FEED_TYPE_BY_KIND = {
    "vehicle_position": "vehicle_positions",
    "trip_update": "trip_updates",
    "alert": "service_alerts",
    "mixed": "mixed",
    "auto": "mixed",
}

# --- fixed values: statuses ---------------------------------------------------
PARSE_STATUSES = ("valid", "empty_body", "protobuf_decode", "protobuf_required_field")
DATASET_STATUSES = ("ready", "no_captured_responses")
PUBLICATION_OPEN = ("pending", "retry", "uploading")
PUBLICATION_DONE = ("verified", "retired")
PERMANENT_CATEGORIES = ("local_integrity", "remote_integrity", "dataset_invalid")
NETWORK_CATEGORIES = ("dns", "connect", "tls", "timeout", "network")

# --- fixed values: ingest rules -----------------------------------------------
PROTOBUF_MEDIA_TYPES = (
    "application/x-protobuf",
    "application/protobuf",
    "application/octet-stream",
    "application/vnd.google.protobuf",
)
SAFE_HEADERS = ("Content-Type", "Content-Length", "ETag", "Last-Modified", "Date")
FUTURE_TOLERANCE_S = 5 * 60
STALE_AFTER_S = 24 * 60 * 60

# --- fixed values: shapes -----------------------------------------------------
ID_PATTERN = r"^[a-z0-9][a-z0-9_-]{0,62}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
SEGMENT_PATTERN = r"^[A-Za-z0-9_.=-]+$"
SHA256_PATTERN = r"^[a-fA-F0-9]{64}$"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
RETAINED_PREFIX = "@retained/"

# --- fixed values: defaults ---------------------------------------------------
CLOSE_DELAY_S = 15 * 60
RAW_RETENTION_S = 7 * 24 * 60 * 60
PARQUET_RETENTION_S = 7 * 24 * 60 * 60
METADATA_RETENTION_S = 30 * 24 * 60 * 60
PAUSE_AT_PERCENT = 90.0
RESUME_AT_PERCENT = 80.0
ROW_GROUP_BYTES = 128 << 20
ROW_GROUP_ROWS = 100_000
RETRY_BASE_S = 5 * 60
RETRY_MAX_S = 6 * 60 * 60
RETRY_MAX_DOUBLINGS = 6

# --- fixed values: histogram bucket bounds ------------------------------------
BODY_BYTES_BUCKETS = tuple(256.0 * 4**k for k in range(10))
COMPACTION_SECONDS_BUCKETS = tuple(0.1 * 4**k for k in range(9))
PUBLICATION_SECONDS_BUCKETS = tuple(0.25 * 4**k for k in range(10))
FETCH_SECONDS_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

# --- fixed values: FNV-1a, 64 bit, as decimals --------------------------------
FNV64_OFFSET = 14695981039346656037
FNV64_PRIME = 1099511628211
TWO_64 = 18446744073709551616

# Seconds between year 1 and 1970: an instant past 2^63 minus this wraps around.
UNIX_TO_YEAR_ONE_S = 62135596800
