"""Message decoding and item rows."""

import datetime as dt
import json

import pytest

from helpers import content
from tidemark.sources.items import generate_items, generate_items_copy, read_items
from tidemark.sources.messages import decode_messages, kafka_messages, kafka_options, rejected_messages

D = dt.datetime

GOOD = '{"user_id": 5, "ts": "2024-01-01 10:00:00.123999", "event_type": "click", "extra": [1, 2]}'
BAD = (
    "not json",
    '{"user_id": 5}',
    '{"ts": "2024-01-01 10:00:00"}',
    '{"ts": "never", "event_type": "x"}',
    "",
    '{"user_id": 5, "ts"',
)


def _values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_good_message_is_typed_and_cut_to_milliseconds(spark):
    assert content(decode_messages(_values(spark, GOOD)), "user_id", "timestamp", "event_type") == [
        (5, D(2024, 1, 1, 10, 0, 0, 123000), "click")]


def test_every_message_is_decoded_or_rejected(spark):
    values = _values(spark, GOOD, *BAD, None)
    assert decode_messages(values).count() == 1
    assert {v for (v,) in content(rejected_messages(values), "value")} == {*BAD, None}


def test_user_id_beyond_32_bits_is_null(spark):
    text = json.dumps({"user_id": 3000000000, "ts": "2024-01-01T10:00:00Z", "event_type": "x"})
    assert content(decode_messages(_values(spark, text)), "user_id", "timestamp") == [(None, D(2024, 1, 1, 10))]


def test_message_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "m")
    _values(spark, GOOD).write.text(path)
    plan = decode_messages(spark.read.text(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("json_tuple(") == 1 and "from_json" not in plan


def test_kafka_source_asks_for_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_messages(spark, "broker:9092", "key_value")


# Sample rows of both item sets and the draw that gives them.
@pytest.mark.parametrize(
    "generate, draw, now, row",
    [
        (generate_items, 4152594847, "2025-05-20 11:07:38",
         ("id_4847", "Item 47", 4152595694, D(2025, 5, 18, 0, 33, 31))),
        (generate_items_copy, 3727389041, "2025-05-20 11:14:10",
         ("id_9041", "name_41", 372738904100, D(2025, 5, 19, 9, 23, 29))),
    ],
)
def test_known_draw_gives_the_sample_row(spark, generate, draw, now, row):
    assert content(generate(spark.range(1), now, seed=draw), "id", "name", "value", "timestamp") == [row]


def test_draws_are_repeatable_and_spread(spark):
    one, two = (generate_items(spark.range(500), "2025-05-20 11:07:38", seed=3) for _ in range(2))
    assert content(one, "*") == content(two, "*")
    assert one.select("value").distinct().count() == 500


def test_very_large_row_ids(spark):
    assert generate_items(spark.range(2**62, 2**62 + 3), "2025-05-20 11:07:38").count() == 3


def test_item_scan(spark, tmp_path):
    line = '{"id": "id_4847", "name": "Item 47", "value": 4152595694, "timestamp": "2025-05-18 00:33:31"}'
    (tmp_path / "items.ndjson").write_text(line + "\n")
    assert content(read_items(spark, str(tmp_path / "items.ndjson")), "*") == [
        ("id_4847", "Item 47", 4152595694, D(2025, 5, 18, 0, 33, 31))]


def test_kafka_options_name_where_a_first_run_begins():
    plain = kafka_options("broker:9092", "events")
    assert plain == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "events", "startingOffsets": "earliest"}
    assert kafka_options("b", "t", "latest", failOnDataLoss="false")["startingOffsets"] == "latest"


def test_messages_need_a_date(spark):
    values = spark.createDataFrame([('{"user_id":1,"ts":"12:30","event_type":"x"}',)], "value STRING")
    assert decode_messages(values).count() == 0 and rejected_messages(values).count() == 1
