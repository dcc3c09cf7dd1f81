"""Match events to known tools; keep the AI ones; say what became of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.functions.text import lookup_key
from logsieve.operators.events import event_sql
from logsieve.operators.lookup import PreparedTools, lookup_join, normalise_tools, tools_by_key
from logsieve.schema import URL_KEYS

REASONS = ("bad_json", "no_url", "no_match", "not_ai", "kept")

# Enriched column -> column of the lookup. `tool_url` is the event's own text.
_TOOL_COLUMNS = {
    "tool_id": "id",
    "tool_name": "name",
    "tool_score": "score",
    "tool_risk": "risk",
    "tool_ai_category": "ai_category",
}


_REASON = """CASE WHEN event IS NULL THEN 'bad_json' WHEN key = '' THEN 'no_url'
    WHEN _has_ai IS NULL THEN 'no_match' WHEN NOT _has_ai THEN 'not_ai' ELSE 'kept' END"""


def with_lookup_key(
    events: DataFrame, url_keys: tuple[str, ...] = URL_KEYS, event: str = "event"
) -> DataFrame:
    """Add `tool_url` (the first non-empty candidate as written) and `key`. A candidate
    of white space counts as present, and leaves the event without a key."""
    get = event_sql(events, event)
    url = "coalesce({}, '')".format(", ".join(f"nullif({get(k)}, '')" for k in url_keys))
    return events.withColumn("tool_url", F.expr(url)).withColumn(
        "key", lookup_key(F.col("tool_url"))
    )


def _tool_side(lookup: DataFrame, *more: str) -> DataFrame:
    return lookup.selectExpr(
        "key", *[f"{source} AS {name}" for name, source in _TOOL_COLUMNS.items()], *more
    )


def enrich(
    events: DataFrame, tools: DataFrame, url_keys: tuple[str, ...] = URL_KEYS
) -> DataFrame:
    """Events whose destination is an AI tool, with the six tool columns.

    The AI test comes after a key's latest row is chosen (a later non-AI row must hide
    an earlier AI one) and before the join, which keeps the broadcast side small.
    """
    lookup = _tool_side(tools_by_key(tools).filter("has_ai"))
    keyed = with_lookup_key(events.filter(F.col("event").isNotNull()), url_keys)
    # Events without a key go with the join: no tool has an empty one.
    return lookup_join(keyed, lookup, bound=normalise_tools(tools)).drop("key")


def classify(
    events: DataFrame, tools: DataFrame | PreparedTools, url_keys: tuple[str, ...] = URL_KEYS
) -> DataFrame:
    """Every event with a `reason`, one of `REASONS`, and the tool columns where a tool
    matched. The events of reason `kept` are those `enrich` returns."""
    keyed = with_lookup_key(events, url_keys)
    if isinstance(tools, PreparedTools):
        joined = lookup_join(keyed, _tool_side(tools.by_key, "has_ai AS _has_ai"), how="left", fits=tools.fits)
    else:
        lookup = _tool_side(tools_by_key(tools), "has_ai AS _has_ai")
        joined = lookup_join(keyed, lookup, how="left", bound=normalise_tools(tools))
    return joined.withColumn("reason", F.expr(_REASON)).drop("key", "_has_ai")


def drop_audit(classified: DataFrame) -> DataFrame:
    """How many events met each fate."""
    return classified.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
