"""Columns derived from the event payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The event types for which each payload field is kept.
PAYLOAD_FIELDS = {
    "action": ("IssuesEvent", "PullRequestEvent", "IssueCommentEvent", "WatchEvent"),
    "ref": ("PushEvent", "CreateEvent", "DeleteEvent"),
    "ref_type": ("CreateEvent", "DeleteEvent"),
    "number": ("IssuesEvent", "PullRequestEvent"),
}

_PARSED_TYPES = sorted({name for names in PAYLOAD_FIELDS.values() for name in names})


def derive_columns(events: DataFrame) -> DataFrame:
    """Add action, ref, ref_type and number.

    json_tuple parses the payload once for all four fields, inside generated
    code; types that keep no field are not parsed.
    """
    wanted = F.when(F.col("type").isin(_PARSED_TYPES), F.col("payload"))
    parsed = events.select("*", F.json_tuple(wanted, *PAYLOAD_FIELDS).alias(*(f"_{n}" for n in PAYLOAD_FIELDS)))
    derived = {
        name: F.when(F.col("type").isin(*types), F.col(f"_{name}")) for name, types in PAYLOAD_FIELDS.items()
    }
    derived["number"] = derived["number"].try_cast("int")
    return parsed.withColumns(derived).drop(*(f"_{name}" for name in PAYLOAD_FIELDS))


def with_variant(events: DataFrame) -> DataFrame:
    """Add ``payload_variant``: the payload parsed once and kept, so that later reads parse nothing; the text stays as it is.

    Text that is no JSON, or names a field twice, has a null one.
    """
    return events.withColumn("payload_variant", F.try_parse_json("payload"))


def derive_from_variant(events: DataFrame) -> DataFrame:
    """The columns of :func:`derive_columns`, from ``payload_variant``."""
    kinds = {name: "int" if name == "number" else "string" for name in PAYLOAD_FIELDS}
    return events.withColumns({
        name: F.when(F.col("type").isin(*types), F.try_variant_get("payload_variant", f"$.{name}", kinds[name]))
        for name, types in PAYLOAD_FIELDS.items()
    })
