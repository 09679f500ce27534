"""Record layouts and output table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: the 28 fields of an accounting line in line order - column name,
# RADIUS attribute name, kind (ts = event time, long/int = safe number with 0 for bad
# text, str = text kept as is; the 22/24-column forms read accessType as text),
# and whether the 22/24-column record keeps the field
FIELDS_28 = [
    ("date", "Date", "ts", True),
    ("timestamp", "Timestamp", "long", True),
    ("acctStatusType", "Acct-Status-Type", "str", True),
    ("acctSessionId", "Acct-Session-Id", "str", True),
    ("sessionTime", "Acct-Session-Time", "long", True),
    ("outputOctets", "Acct-Output-Octets", "long", True),
    ("outputGigawords", "Acct-Output-Gigawords", "long", True),
    ("inputOctets", "Acct-Input-Octets", "long", True),
    ("inputGigawords", "Acct-Input-Gigawords", "long", True),
    ("outputPackets", "Acct-Output-Packets", "long", False),
    ("inputPackets", "Acct-Input-Packets", "long", False),
    ("nasIdentifier", "NAS-Identifier", "str", True),
    ("nasIpAddress", "NAS-IP-Address", "str", True),
    ("nasPort", "NAS-Port", "long", True),
    ("clientId", "ClientId", "str", True),
    ("accessType", "AccessType", "int", True),
    ("userName", "User-Name", "str", True),
    ("callingStationId", "Calling-Station-Id", "str", True),
    ("circuitId", "DSLForum-Agent-Circuit-Id", "str", True),
    ("remoteId", "DSLForum-Agent-Remote-Id", "str", True),
    ("framedIPAddress", "Framed-IP-Address", "str", True),
    ("connectInfo", "Connect-Info", "str", True),
    ("terminateCause", "Acct-Terminate-Cause", "str", True),
    ("natStartPort", "NAT-Start-Port", "int", False),
    ("natEndPort", "NAT-End-Port", "int", False),
    ("delayTime", "Acct-Delay-Time", "int", False),
    ("natIPAddress", "NAT-IP-Address", "str", False),
    ("mac", "User-Mac", "str", True),
]
FIELD_NAMES_28 = [name for name, _, _, _ in FIELDS_28]
RADIUS_NAMES_28 = [radius for _, radius, _, _ in FIELDS_28]
FIELD_KINDS_28 = [kind for _, _, kind, _ in FIELDS_28]
N_FIELDS = len(FIELDS_28)
CDR22_POSITIONS = [i for i, (_, _, _, kept) in enumerate(FIELDS_28) if kept]
CDR22_NAMES = [FIELD_NAMES_28[i] for i in CDR22_POSITIONS]
CDR24_NAMES = CDR22_NAMES + ["accessNode", "day"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


# Output document tables (the search-index template, as Spark schemas).
# timestamp is epoch milliseconds; agg2 documents carry no ``samples``.
INDEX_DOC_1_SCHEMA = T.StructType([
    T.StructField("value", T.LongType()), T.StructField("timestamp", T.LongType()),
    T.StructField("aggName", T.StringType()), T.StructField("aggField1", T.StringType()),
    T.StructField("nasIpAddress", T.StringType()),
])
INDEX_DOC_2_SCHEMA = T.StructType([
    T.StructField("mean", T.DoubleType()), T.StructField("stdDev", T.DoubleType()),
    T.StructField("timestamp", T.LongType()), T.StructField("aggName", T.StringType()),
    T.StructField("aggField1", T.StringType()), T.StructField("nasIpAddress", T.StringType()),
])

# fixed values: field types of the index template (keyword/date/long/double/boolean)
INDEX_TEMPLATE_FIELDS = {
    "metricName": "keyword", "timestamp": "date", "date": "date", "count": "long",
    "value": "long", "samples": "long", "avg": "double", "stdDev": "double",
    "nasIpAddress": "keyword", "accessNode": "keyword", "isShort": "boolean",
    "acctTerminateCause": "keyword", "accessType": "keyword", "aggField1": "keyword",
    "aggField2": "keyword", "aggField3": "keyword", "aggField4": "keyword",
}
_TEMPLATE_TYPES = {"keyword": T.StringType(), "date": T.TimestampType(), "long": T.LongType(),
                   "double": T.DoubleType(), "boolean": T.BooleanType()}
INDEX_TEMPLATE_SCHEMA = T.StructType(
    [T.StructField(k, _TEMPLATE_TYPES[v]) for k, v in INDEX_TEMPLATE_FIELDS.items()])
