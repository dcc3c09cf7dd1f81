"""Column contracts: the event keys that are read, the tables that are written.

``LOG_COLUMNS`` is the single source for the projection, its coercions, the
violations report and the sink's schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class LogColumn:
    """One column of the log table.

    kind: text, uint8..uint64, float, ipv4 for coerced values; date, instant and
    clock for the three columns derived from the event time.
    source: the event key, or for ``tool_*`` columns the enriched column.
    """

    name: str
    kind: str
    source: str

    @property
    def from_tool(self) -> bool:
        return self.name.startswith("tool_")


# The log table's columns in insert order, with their kind and event key.
LOG_COLUMNS = (
    LogColumn("log_id", "uint64", "logid"),
    LogColumn("date", "date", "eventtime"),
    LogColumn("eventtime", "instant", "eventtime"),
    LogColumn("time", "clock", "time"),
    LogColumn("tool_id", "uint32", "tool_id"),
    LogColumn("tool_name", "text", "tool_name"),
    LogColumn("tool_url", "text", "tool_url"),
    LogColumn("tool_score", "float", "tool_score"),
    LogColumn("tool_risk", "text", "tool_risk"),
    LogColumn("tool_ai_category", "text", "tool_ai_category"),
    LogColumn("sessionid", "text", "sessionid"),
    LogColumn("duration", "uint32", "duration"),
    LogColumn("srcip", "ipv4", "srcip"),
    LogColumn("srcname", "text", "srcname"),
    LogColumn("srcport", "uint16", "srcport"),
    LogColumn("srcintf", "text", "srcintf"),
    LogColumn("srcintfrole", "text", "srcintfrole"),
    LogColumn("srccountry", "text", "srccountry"),
    LogColumn("srcmac", "text", "srcmac"),
    LogColumn("devtype", "text", "devtype"),
    LogColumn("osname", "text", "osname"),
    LogColumn("devid", "text", "devid"),
    LogColumn("dstip", "ipv4", "dstip"),
    LogColumn("dstname", "text", "dstname"),
    LogColumn("dstport", "uint16", "dstport"),
    LogColumn("dstintf", "text", "dstintf"),
    LogColumn("dstintfrole", "text", "dstintfrole"),
    LogColumn("dstcountry", "text", "dstcountry"),
    LogColumn("appcat", "text", "appcat"),
    LogColumn("app", "text", "app"),
    LogColumn("appid", "uint32", "appid"),
    LogColumn("apprisk", "text", "apprisk"),
    LogColumn("action", "text", "action"),
    LogColumn("policyid", "uint32", "policyid"),
    LogColumn("policytype", "text", "policytype"),
    LogColumn("type", "text", "type"),
    LogColumn("subtype", "text", "subtype"),
    LogColumn("level", "text", "level"),
    LogColumn("proto", "uint8", "proto"),
    LogColumn("rcvdbyte", "uint64", "rcvdbyte"),
    LogColumn("rcvdpkt", "uint64", "rcvdpkt"),
    LogColumn("sentbyte", "uint64", "sentbyte"),
    LogColumn("sentpkt", "uint64", "sentpkt"),
)

# Sink type of each unsigned width: the narrowest signed Spark type that holds it.
UINT_TYPES = {
    "uint8": (2**8 - 1, "smallint"),
    "uint16": (2**16 - 1, "int"),
    "uint32": (2**32 - 1, "bigint"),
    "uint64": (2**64 - 1, "decimal(20,0)"),
}

# Keys that may name the destination, the first non-empty one wins.
URL_KEYS = ("dstname", "url", "URL", "tool_url", "hostname")

# Extra candidates a caller may append for records that came from CEF lines.
CEF_URL_KEYS = ("dhost", "request", "dst")

# Keys that may carry the event time, the first non-empty one wins.
TIME_KEYS = ("eventtime", "timestamp")


def event_keys(extra: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Every event key some operator reads, each once."""
    keys = [c.source for c in LOG_COLUMNS if not c.from_tool]
    return tuple(dict.fromkeys([*keys, *TIME_KEYS, *URL_KEYS, *extra]))


def event_field(key: str) -> str:
    """Struct field that holds an event key. Spark resolves field names ignoring
    case, so a key with capitals gets a name of its own."""
    return key if key == key.lower() else f"{key.lower()}__cased"


# Dimension of known tools, as operators expect it after `normalise_tools`.
TOOL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("has_ai", T.StringType()),
        T.StructField("ai_category", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("risk", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
