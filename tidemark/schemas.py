"""Table schemas."""

from __future__ import annotations

from pyspark.sql.types import DataType, StructType


def _struct(**fields: str | DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


# The column layout of the archive, lake, serving and stream tables.
ACTOR = _struct(
    id="string", login="string", display_login="string", gravatar_id="string", url="string", avatar_url="string"
)
REPO = _struct(id="string", name="string", url="string")
ORG = _struct(id="string", login="string", gravatar_id="string", url="string", avatar_url="string")

# One archive line. `created_at` stays text here so that a bad value can be
# reported; `payload` as a string keeps the raw JSON text of the object.
RAW_EVENT = _struct(
    id="string",
    type="string",
    created_at="string",
    public="boolean",
    actor=ACTOR,
    repo=REPO,
    org=ORG,
    payload="string",
    _corrupt_record="string",
)

LAKE = _struct(
    id="string",
    type="string",
    created_at="timestamp_ntz",
    public="boolean",
    actor=ACTOR,
    repo=REPO,
    org=ORG,
    payload="string",
    action="string",
    ref="string",
    ref_type="string",
    number="integer",
)

SERVING = _struct(
    event_type="string", actor_login="string", repo_name="string", created_at="timestamp_ntz", action="string"
)

# Mergeable partial state. A count is additive; an exact distinct count is not,
# so its state is the set of members, one row each. Members carry their number of
# events, so that a member can be taken back; files from before that have none.
DAY_KEYS = ("date", "event_type", "repo_name")
MINUTE_KEYS = ("minute", "event_type")

_PARTITIONS = {"source": "string", "run": "string", "batch_id": "long", "month": "integer"}

DAY_PARTIAL = _struct(
    date="date", event_type="string", repo_name="string", cnt="long", **_PARTITIONS
)
DAY_MEMBER = _struct(
    date="date", event_type="string", repo_name="string", actor_login="string", cnt="long", **_PARTITIONS
)
MINUTE_PARTIAL = _struct(minute="timestamp_ntz", event_type="string", cnt="long", **_PARTITIONS)
