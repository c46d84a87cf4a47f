"""Wire decode of malformed records and the encode -> decode round trip."""

from roadpulse.schemas import VEHICLE
from roadpulse.sources.feeds import derive_feed
from roadpulse.sources.wire import decode, encode, split_dead_letters
from tests.conftest import SF_SMALL


def test_malformed_inputs_become_null_rows(spark):
    raw = spark.createDataFrame([
        ("a", '{"id":"x","timestamp":"2024-01-01T14:18:00+07:00","speed":"12","year":70.5,"extra":1}'),
        ("b", "not json"), ("c", "[1]"), ("d", ""), ("e", None),
        ("f", '{"id":"y","timestamp":"2024-01-01T14:18:00.123456","location":[10.4120,106.7]}'),
    ], "key string, value string")
    rows = decode(raw, VEHICLE).collect()
    assert len(rows) == 6
    x = rows[0]
    assert x.id == "x" and x.speed is None and x.year is None
    assert x.timestamp.isoformat() == "2024-01-01T07:18:00"
    for r in rows[1:5]:
        assert all(v is None for v in r)
    y = rows[5]
    assert y.timestamp.microsecond == 123456 and y.location == "[10.412,106.7]"


def test_dead_letter_split(spark):
    raw = spark.createDataFrame([("a", '{"id":"x"}'), ("b", "not json"), ("c", '"id":"z"}')],
                                "key string, value string")
    good, bad = split_dead_letters(raw, VEHICLE)
    assert [r.id for r in good.collect()] == ["x"]
    assert sorted(r.key for r in bad.collect()) == ["b", "c"]


def test_roundtrip_is_lossless(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = derive_feed(ev, VEHICLE)
    back = decode(encode(rows, VEHICLE), VEHICLE)
    assert rows.count() == back.count()
    assert rows.exceptAll(back).count() == 0 and back.exceptAll(rows).count() == 0
