import json

import pytest

from clickloom.catalog import modelling
from clickloom.sources.scans import scan_requests
from clickloom.streaming.requests import decode, encode
from conftest import SMALL

FEATURES = ["I1", "C1"]


def one(name, data, shape=None):
    return {"name": name, "shape": shape or [len(data), 1], "datatype": "INT32", "data": data}


@pytest.fixture(scope="module")
def decoded(spark, tmp_path_factory):
    requests = [
        {"id": "good", "inputs": [one("C1", [-5, 6, 7]), one("I1", [1, None, 3])]},
        {"id": "also", "inputs": [one("I1", [9]), one("C1", [8]), one("extra", [1])]},
        {"id": "short", "inputs": [one("I1", [1, 2]), one("C1", [1])]},
        {"id": "missing", "inputs": [one("I1", [1, 2])]},
        {"id": "twice", "inputs": [one("I1", [1]), one("I1", [1]), one("C1", [1])]},
        {"id": "shape", "inputs": [one("I1", [1], [2, 1]), one("C1", [1])]},
        {"id": "empty", "inputs": []},
    ]
    path = tmp_path_factory.mktemp("requests") / "r.json"
    path.write_text("\n".join(json.dumps(r) for r in requests))
    return decode(scan_requests(spark, str(path)), FEATURES)


def test_rows_keep_position_and_nulls(decoded):
    got = sorted(tuple(r)[1:] for r in decoded[0].collect() if r["id"] == "also")
    assert got == [("also", 0, 9, 8)]
    good = [tuple(r)[1:] for r in decoded[0].orderBy("pos").collect() if r["id"] == "good"]
    assert good == [("good", 0, 1, -5), ("good", 1, None, 6), ("good", 2, 3, 7)]


def test_rejects_carry_a_reason(decoded):
    assert {r["id"]: r["reason"] for r in decoded[1].collect()} == {
        "short": "row counts differ",
        "missing": "missing feature",
        "twice": "duplicate input",
        "shape": "shape does not match data",
        "empty": "no inputs",
    }


def test_encode_restores_record_order_and_keeps_equal_ids_apart(spark):
    df = spark.createDataFrame(
        [(1, "r", 2, 0.3), (1, "r", 0, 0.1), (2, "r", 0, 0.9), (1, "r", 1, 0.2)],
        "request long, id string, pos int, score double",
    )
    assert sorted(r["OUTPUT0"] for r in encode(df).collect()) == [[0.1, 0.2, 0.3], [0.9]]


def test_stream_equals_batch(spark):
    batch = modelling.score_requests(spark, SMALL)
    stream = modelling.score_stream(spark, SMALL)
    assert batch.count() == stream.count() > 0
    assert batch.exceptAll(stream).isEmpty()


def test_empty_and_out_of_range_requests_are_rejected(spark):
    from clickloom.sources.scans import REQUEST_SCHEMA
    from clickloom.streaming.requests import decode

    def one(name, data):
        return {"name": name, "shape": [len(data), 1], "datatype": "INT32", "data": data}

    rows = [("none", [one("a", []), one("b", [])]), ("large", [one("a", [3_000_000_000]), one("b", [1])]), ("good", [one("a", [None]), one("b", [1])])]
    good, bad = decode(spark.createDataFrame(rows, REQUEST_SCHEMA), ["a", "b"])
    assert [r.id for r in good.collect()] == ["good"]
    assert {(r.id, r.reason) for r in bad.collect()} == {("none", "no records"), ("large", "value out of range")}
