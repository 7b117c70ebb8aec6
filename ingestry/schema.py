"""Canonical record shape, rule constants and reason codes.

Fixed values: records, rules and texts that must be just so for identical results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must match exactly) ---------------------------------
CANONICAL_FIELDS = (
    "student_id",
    "first_name",
    "last_name",
    "grade_level",
    "school_id",
    "email",
    "enrollment_status",
    "updated_at",
    "guardian_contact",
)

REQUIRED_FIELDS = (
    "student_id",
    "first_name",
    "last_name",
    "school_id",
    "email",
    "enrollment_status",
    "updated_at",
)

ENROLLMENT_STATUSES = ("active", "inactive", "graduated", "transferred", "withdrawn")

MAX_FIELD_LENGTHS = (
    ("student_id", 64),
    ("first_name", 100),
    ("last_name", 100),
    ("school_id", 64),
    ("email", 255),
    ("guardian_contact", 255),
    ("enrollment_status", 32),
)

STATUS_ALIASES = {
    "active": "active",
    "enrolled": "active",
    "enrolled_active": "active",
    "inactive": "inactive",
    "unenrolled": "inactive",
    "not_enrolled": "inactive",
    "on_leave": "inactive",
    "graduated": "graduated",
    "grad": "graduated",
    "transferred": "transferred",
    "transfer": "transferred",
    "transferred_out": "transferred",
    "withdrawn": "withdrawn",
    "withdrew": "withdrawn",
    "dropped": "withdrawn",
}

GRADE_ALIASES = {
    "pk": -1,
    "prek": -1,
    "pre_k": -1,
    "k": 0,
    "kg": 0,
    "kindergarten": 0,
}

MIN_GRADE_LEVEL = -1
MAX_GRADE_LEVEL = 12

EMAIL_PATTERN = r"^[^@\s,;]+@[^@\s,;.]+(\.[^@\s,;.]+)+$"

FUTURE_SKEW = "INTERVAL 1 DAY"

MALFORMED_ROW = "MALFORMED_ROW"
MISSING_REQUIRED_FIELD = "MISSING_REQUIRED_FIELD"
INVALID_EMAIL = "INVALID_EMAIL"
INVALID_GRADE_LEVEL = "INVALID_GRADE_LEVEL"
INVALID_TIMESTAMP = "INVALID_TIMESTAMP"
UNKNOWN_ENROLLMENT_STATUS = "UNKNOWN_ENROLLMENT_STATUS"
FIELD_TOO_LONG = "FIELD_TOO_LONG"
DUPLICATE_STUDENT_ID = "DUPLICATE_STUDENT_ID"
TRANSFORM_FAILED = "TRANSFORM_FAILED"

DETAIL_MORE_VALUES = "row has more values than the header"
DETAIL_FEWER_VALUES = "row has fewer values than the header"
DETAIL_MISSING = "{field} is missing or blank"
DETAIL_EMAIL = "email is not a valid address"
DETAIL_STATUS = "enrollment_status does not map to a canonical status"
DETAIL_TIMESTAMP = "updated_at is not an ISO 8601 timestamp"
DETAIL_FUTURE = "updated_at is too far in the future"
DETAIL_GRADE = "grade_level is not a supported grade (PK, K, 1-12)"
DETAIL_TOO_LONG = "{field} is longer than {limit} characters"

CSV_SOURCE_SYSTEM = "csv"
API_SOURCE_SYSTEM = "api"
DEFAULT_CHUNK_SIZE = 5000
ERROR_TEXT_LIMIT = 2000

RUN_STATUSES = ("running", "completed", "failed")

EXCEL_SUFFIXES = (".xls", ".xlsx", ".xlsm", ".xlsb")
IMAGE_SUFFIXES = (".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp")
WORD_SUFFIXES = (".doc", ".docx")
# What an upload of another type is told.
EMPTY_NAME = "filename is empty"
EXCEL_REFUSED = "Excel files are not supported yet. Export as CSV."
PDF_REFUSED = "PDF files are not supported yet. Export as CSV."
IMAGE_REFUSED = "Image files are not supported yet. Export as CSV."
WORD_REFUSED = "Word documents are not supported yet. Export as CSV."
OTHER_REFUSED = "uploaded file type is not supported yet. Export as CSV."
RECORD_LIST_KEYS = ("data", "students", "items", "results")
FAILURE_EVENTS = ("job_failed", "sync_failed", "file_failed")
# --- end of fixed values -------------------------------------------------------------

# Bookkeeping columns the adapters add. Never part of raw_payload; kept in quarantine.
EXTRA_COLUMNS = "_extra_columns"
ROW_ORDINAL = "_row_ordinal"
IS_CSV = "_is_csv"
SOURCE_OBJECT = "_source_object"
CHUNK_INDEX = "_chunk_index"
FILE_ORDINAL = "_file_ordinal"

STUDENT_SCHEMA = T.StructType(
    [
        T.StructField("student_id", T.StringType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("grade_level", T.ShortType(), True),
        T.StructField("school_id", T.StringType(), False),
        T.StructField("email", T.StringType(), False),
        T.StructField("enrollment_status", T.StringType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
        T.StructField("guardian_contact", T.StringType(), True),
        T.StructField("source_system", T.StringType(), False),
        T.StructField("raw_payload", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("last_written_at", T.TimestampType(), False),
    ]
)

TARGET_COLUMNS = tuple(f.name for f in STUDENT_SCHEMA.fields)
