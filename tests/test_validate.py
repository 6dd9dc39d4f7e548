"""Validator table test: one hand-written message per rule, exact reason strings."""

import json

import pytest

from txrisk import schema as S
from txrisk.functions import validate as V

BASE = {
    "transaction_id": "t-1", "amount": 12.5, "currency": "USD", "timestamp": "2025-03-01T10:00:00+07:00",
    "customer_id": "CUST00001", "is_fraud": 0, "transaction_type": "purchase", "transaction_status": "completed",
    "location": "VN", "payment_method": "credit_card", "merchant_category": "travel", "device_os": "iOS",
    "fraud_rules": ["high_amount"],
}


def msg(**changes):
    d = dict(BASE)
    for k, v in changes.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    ("base", msg(), None),
    ("bracket in a string", msg(note='a] x'), None),
    ("extra field", msg(note="x"), None),
    ("amount true", msg(amount=True), None),
    ("is_fraud 1.0", msg(is_fraud=1.0), None),
    ("is_fraud false", msg(is_fraud=False), None),
    ("is_fraud true", msg(is_fraud=True), None),
    ("timestamp Z", msg(timestamp="2025-03-01T10:00:00Z"), None),
    ("date only", msg(timestamp="2025-03-01"), None),
    ("amount int", msg(amount=7), None),
    ("id missing", msg(transaction_id=...), S.MSG_TRANSACTION_ID),
    ("id empty", msg(transaction_id=""), S.MSG_TRANSACTION_ID),
    ("id number", msg(transaction_id=5), S.MSG_TRANSACTION_ID),
    ("customer missing", msg(customer_id=...), S.MSG_CUSTOMER_ID),
    ("customer number", msg(customer_id=5), S.MSG_CUSTOMER_ID),
    ("amount string", msg(amount="12"), S.MSG_AMOUNT),
    ("amount null", msg(amount=None), S.MSG_AMOUNT),
    ("amount missing", msg(amount=...), S.MSG_AMOUNT),
    ("currency short", msg(currency="US"), S.MSG_CURRENCY),
    ("currency number", msg(currency=840), S.MSG_CURRENCY),
    ("timestamp text", msg(timestamp="x"), S.MSG_TIMESTAMP),
    ("timestamp number", msg(timestamp=1700000000), S.MSG_TIMESTAMP),
    ("timestamp missing", msg(timestamp=...), S.MSG_TIMESTAMP),
    ("timestamp no date", msg(timestamp="T10:00"), S.MSG_TIMESTAMP),
    ("timestamp bad month", msg(timestamp="2025-13-01T10:00:00"), S.MSG_TIMESTAMP),
    ("label 2", msg(is_fraud=2), S.MSG_IS_FRAUD),
    ("label string", msg(is_fraud="1"), S.MSG_IS_FRAUD),
    ("label missing", msg(is_fraud=...), S.MSG_IS_FRAUD),
    ("type", msg(transaction_type="loan"), S.MSG_TRANSACTION_TYPE),
    ("status", msg(transaction_status="open"), S.MSG_TRANSACTION_STATUS),
    ("location empty", msg(location=""), "Missing field: location."),
    ("device null", msg(device_os=None), "Missing field: device_os."),
    ("payment zero", msg(payment_method=0), "Missing field: payment_method."),
    ("payment empty list", msg(payment_method=[]), "Missing field: payment_method."),
    ("category missing", msg(merchant_category=...), "Missing field: merchant_category."),
    ("several", msg(amount="x", currency="EURO", is_fraud=3, location=""),
     "; ".join([S.MSG_AMOUNT, S.MSG_CURRENCY, S.MSG_IS_FRAUD, "Missing field: location."])),
    ("duplicate key, last wins", msg()[:-1] + ', "amount": "12"}', S.MSG_AMOUNT),
    ("duplicate key fixed", msg(amount="12")[:-1] + ', "amount": 12.5}', None),
    ("array", "[1,2]", S.MSG_NOT_OBJECT),
    ("string", '"text"', S.MSG_NOT_OBJECT),
    ("number", "7", S.MSG_NOT_OBJECT),
]

MALFORMED = [msg() + "] x", msg() + '] {"a":1}', "{bad", "", '{"a":1} x', '{"a":1}{"a":2}', '{"a":1},{"a":2}', "   ", '{"amount": NaN}']


@pytest.fixture(scope="module")
def results(spark):
    rows = [(i, text) for i, (_, text, _) in enumerate(CASES)]
    rows += [(100 + i, t) for i, t in enumerate(MALFORMED)]
    rows += [(200, None)]
    df = spark.createDataFrame(rows, "id int, value string")
    return {r["id"]: r for r in V.validate(df).select("id", "status", "error_reason").collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_reason(results, i):
    _, _, expected = CASES[i]
    r = results[i]
    assert r["error_reason"] == expected
    assert r["status"] == ("valid" if expected is None else "invalid")


@pytest.mark.parametrize("i", range(len(MALFORMED)))
def test_malformed(results, i):
    r = results[100 + i]
    assert r["status"] == "malformed"
    assert r["error_reason"].startswith(S.JSON_DECODE_PREFIX)


def test_tombstone(results):
    assert results[200]["status"] == "tombstone"
    assert results[200]["error_reason"] is None


def test_binary_value(spark):
    df = spark.createDataFrame([(bytearray(msg().encode()),)], "value binary")
    assert V.validate(df).first()["status"] == "valid"


def test_typed_transactions(spark):
    df = spark.createDataFrame([(msg(is_fraud=True, amount=True),)], "value string")
    r = V.typed_transactions(V.validate(df)).first()
    assert r["is_fraud"] == 1 and r["amount"] == 1.0 and r["fraud_rules"] == ["high_amount"]
    assert r["timestamp"] is not None


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(msg(),)], "value string")
    plan = V.validate(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_status_alone_copies_no_document(spark):
    df = spark.createDataFrame([(msg(),), ("[1]",), ("",), (msg() + msg(),), ("null",), ("7",), (None,)], "value string")
    status = V.validate(df).select("status", "error_reason")
    assert "AS payload" not in status._jdf.queryExecution().optimizedPlan().toString()
    read = V.validate(df).selectExpr("status", "to_json(payload) AS doc").collect()
    assert [r["status"] for r in read] == ["valid", "invalid", "malformed", "malformed", "invalid", "invalid", "tombstone"]
    assert [r["doc"] for r in read][1:] == ["[1]", None, None, "null", "7", None]
