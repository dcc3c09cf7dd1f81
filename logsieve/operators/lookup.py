"""The tools dimension: normalising, one row per key, and the join to it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.functions.text import is_true, lookup_key

# A dimension is broadcast only when measured to be within both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Tasks over which each key of a join without broadcast is dealt.
SALTS = 16

TOOL_COLUMNS = ("id", "name", "url", "has_ai", "ai_category", "score", "risk", "updated_at")


def normalise_tools(tools: DataFrame) -> DataFrame:
    """Add `key` (the url, lower case and stripped) and drop rows without one; `has_ai`
    becomes a boolean and an absent score 0. Columns a source lacks come out NULL."""
    have = dict(tools.dtypes)

    def column(name: str, kind: str) -> str:
        return f"try_cast({name if name in have else 'NULL'} AS {kind}) AS {name}"

    flag = F.col("has_ai") if "has_ai" in have else F.lit(None).cast("string")
    keyed = tools.withColumns(
        {
            "key": lookup_key(F.col("url").cast("string")),
            "has_ai": is_true(flag, have.get("has_ai", "string")),
        }
    )
    return keyed.selectExpr(
        "key",
        column("id", "BIGINT"),
        column("name", "STRING"),
        column("url", "STRING"),
        "has_ai",
        column("ai_category", "STRING"),
        f"coalesce({column('score', 'DOUBLE').removesuffix(' AS score')}, 0D) AS score",
        column("risk", "STRING"),
        column("updated_at", "TIMESTAMP"),
    ).filter("key <> ''")


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by the `order` columns, NULLs first. An aggregate,
    so each task reduces its rows before the shuffle and a key with very many versions
    costs no more than any other."""
    rank = ", ".join([*order, *(c for c in df.columns if c not in [*keys, *order])])
    best = df.groupBy(*keys).agg(F.expr(f"max(struct({rank}))").alias("_best"))
    return best.selectExpr(*[c if c in keys else f"_best.{c} AS {c}" for c in df.columns])


def tools_by_key(tools: DataFrame) -> DataFrame:
    """The lookup: normalised tools, of each key the latest (`updated_at`, then `id`)."""
    return latest_per(normalise_tools(tools), ["key"], ["updated_at", "id"])


@dataclass(frozen=True)
class PreparedTools:
    """A lookup as `tools_by_key` gives it, and whether it was measured to fit a broadcast."""

    by_key: DataFrame
    fits: bool


def fits_broadcast(df: DataFrame) -> bool:
    """Measure a dimension against the broadcast bounds: one aggregate over it."""
    texts = [f"coalesce(octet_length({name}), 0)" for name, kind in df.dtypes if kind == "string"]
    width = " + ".join([str(16 * len(df.columns)), *texts])
    rows, size = df.selectExpr("count(1)", f"coalesce(sum({width}), 0)").first()
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


def lookup_join(
    events: DataFrame,
    lookup: DataFrame,
    key: str = "key",
    how: str = "inner",
    bound: DataFrame | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Join events to a lookup with at most one row per key and no empty key; `how` is
    inner or left. `bound` is a frame the lookup is a reduction of: cheaper to measure,
    and small enough if the lookup is made from it. `fits` says that it was measured before.

    A lookup within the bounds is broadcast and the events stay where they are. A
    larger one is joined by one shuffle of the events, dealt to SALTS tasks per key: every
    row of the lookup is there SALTS times (the lookup is the small side), so a key that
    a third of all events share is spread whatever the session's settings, and adaptive
    execution can split what is still too large. The events are read once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    if fits is None:
        fits = (bound is not None and fits_broadcast(bound)) or fits_broadcast(lookup)
    if fits:
        return events.join(F.broadcast(lookup), key, how)

    if how == "inner":
        events = events.filter(F.col(key) != "")
    # Rows are dealt in turn, in the order of their split: alike ones are spread too.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn(
        "_salt", F.col("_salt").cast("bigint")
    )
    salted = events.withColumn("_salt", salt).hint("shuffle_merge")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")

