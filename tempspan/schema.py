"""Column names and types of the data that the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of an observation file in their standard order, with the
# type each one is read as.
OBSERVATION_FIELDS: dict[str, str] = {
    "DTG": "string",
    "LOCATION": "string",
    "NAME": "string",
    "LATITUDE": "double",
    "LONGITUDE": "double",
    "ALTITUDE": "double",
    "U_BOOL_10": "string",
    "T_DRYB_10": "double",
    "TN_10CM_PAST_6H_10": "double",
    "T_DEWP_10": "double",
    "T_DEWP_SEA_10": "double",
    "T_DRYB_SEA_10": "double",
    "TN_DRYB_10": "double",
    "T_WETB_10": "double",
    "TX_DRYB_10": "double",
    "U_10": "double",
    "U_SEA_10": "double",
}
REQUIRED_FIELDS = ("DTG", "LOCATION")
TIME_FIELD = "DTG"
# How observation times are printed, as a format and as a pattern.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"
HEADER_MARK = "#"

STATION = "LOCATION"
DAY = "DATE"
TX = "TX_DRYB_10"
TN = "TN_DRYB_10"

# The station and first year that a job covers unless told otherwise.
DEFAULT_STATION = "260_T_a"
DEFAULT_STATION_NAME = "De Bilt"
DEFAULT_START_YEAR = 2003

# Fixed value: how result dates are written, e.g. "31 Jul 2003".
RESULT_DATE_FORMAT = "dd MMM yyyy"

LINES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])
"""One text line: the file it came from, that file's size in bytes, the byte position of
the block (or line) inside the file, and the text."""
