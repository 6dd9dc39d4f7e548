"""Record validator for wire messages (B20-B31), as native variant expressions.

A message is UTF-8 JSON text.  It is parsed once into a ``variant``; every rule
is then a Catalyst expression over that variant (type via ``schema_of_variant``,
value via ``try_variant_get``), so validation runs inside whole-stage codegen
with no Python UDF.

Strict parse: ``try_parse_json('[' || text || ']')`` must give an array with
exactly one element.  The wrapper rejects trailing text, blank input and two
documents, which a bare ``try_parse_json`` would partly accept.

Semantics follow the reference validator's Python rules:
* ids must be non-empty strings; ``amount`` must be a JSON number or boolean
  (a Python bool is an int); ``currency`` a 3-character string;
* ``timestamp`` an ISO-8601 string (see ``iso_time``);
* ``is_fraud`` equal to 0 or 1 as Python compares it (``true``, ``1.0`` pass,
  the string ``"1"`` fails);
* enumerations exact; presence fields truthy (not null, ``""``, 0, false, ``[]``, ``{}``);
* all failing rules are reported, joined by ``"; "`` in fixed order; a payload
  that is not an object reports only that.
Known differences: Spark's JSON parser rejects ``NaN``/``Infinity`` (the
message is routed as malformed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import documents
from txrisk.functions.iso_time import iso_timestamp

NUMERIC_TYPES = ["TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE"]
MALFORMED_REASON = S.JSON_DECODE_PREFIX + "message is not a single JSON document"

STATUS_VALID = "valid"
STATUS_INVALID = "invalid"
STATUS_MALFORMED = "malformed"
STATUS_TOMBSTONE = "tombstone"


# A bracket that ends an array and is followed by none of , ] } or the end: fine only inside a string.
ODD_BRACKET = r"\]\s*[^\s,\]}]"


def _wrapped(text: Column) -> Column:
    """The text as the only element of an array, parsed; null if it is no JSON there.

    The parser ignores what follows the wrapper's end, so a text with an odd bracket,
    which might end it early, must also parse as the value of an object.
    """
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    value = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(~text.rlike(ODD_BRACKET) | value.isNotNull(), array)


def strict_parse(text: Column) -> Column:
    """variant of a text holding exactly one JSON document, else null."""
    w = _wrapped(text)
    one = F.try_variant_get(w, "$[0]", "variant")
    two = F.try_variant_get(w, "$[1]", "variant")
    return F.when(one.isNotNull() & two.isNull(), one)


def strict_documents(texts: DataFrame, text: str = "value") -> DataFrame:
    """The rows with ``doc``, the ``strict_parse`` of their text, in its place: parsed once, and copied once if it is one document."""
    others = [F.col(c) for c in texts.columns if c != text]
    two = F.try_variant_get("_w", "$[1]", "variant")
    return (texts.select(*others, _wrapped(F.col(text)).alias("_w"))
            .select(*others, "_w", two.isNull().alias("_single"))
            .select(*others, F.when(F.col("_single"), F.try_variant_get("_w", "$[0]", "variant")).alias("doc")))


def _as_string(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


RULE_FIELDS = ["transaction_id", "customer_id", "amount", "currency", "timestamp", "is_fraud",
               "transaction_type", "transaction_status", *S.PRESENCE_FIELDS]


class _Field:
    """A field of the payload as its own variant (``_v_<f>``) plus its type name (``_t_<f>``).

    Type names: STRING, BIGINT, DOUBLE, DECIMAL(p,s), BOOLEAN, VOID (JSON null),
    ARRAY<..>, OBJECT<..>; SQL null when the field is absent.  Values are read
    from the variant only inside a branch guarded by the type, so each row pays
    for one value conversion per rule at most.
    """

    def __init__(self, name: str):
        self.v = F.col(f"_v_{name}")
        self.t = F.col(f"_t_{name}")

    def s(self) -> Column:
        return F.try_variant_get(self.v, "$", "string")

    def d(self) -> Column:
        return F.try_variant_get(self.v, "$", "double")

    def is_string(self) -> Column:
        return F.coalesce(self.t == "STRING", F.lit(False))

    def is_number(self) -> Column:
        return F.coalesce(self.t.isin(NUMERIC_TYPES) | self.t.startswith("DECIMAL"), F.lit(False))

    def string_where(self, pred) -> Column:
        """A string field whose value satisfies ``pred`` (False for other types)."""
        return F.coalesce(F.when(self.t == "STRING", pred(self.s())), F.lit(False))

    def nonempty_string(self) -> Column:
        return self.string_where(lambda s: F.length(s) > 0)

    def truthy(self) -> Column:
        """Python truthiness (absent and null are falsy)."""
        return F.coalesce(
            F.when(self.t == "STRING", F.length(self.s()) > 0)
             .when(self.t == "BOOLEAN", F.try_variant_get(self.v, "$", "boolean"))
             .when(self.is_number(), self.d() != 0)
             .when(self.t.startswith("ARRAY"),
                   F.coalesce(F.array_size(F.try_variant_get(self.v, "$", "array<variant>")), F.lit(0)) > 0)
             .when(self.t.startswith("OBJECT"), self.t != "OBJECT<>"),
            F.lit(False))


def rule_failures() -> list[tuple[Column, str]]:
    """(is_bad, message) in report order, over the ``_v_/_t_`` field columns."""
    f = {name: _Field(name) for name in RULE_FIELDS}
    ts_ok = F.col("_time_ok")
    fr = f["is_fraud"]
    label_ok = F.coalesce(F.when(fr.t == "BOOLEAN", F.lit(True))
                           .when(fr.is_number(), fr.d().isin(0.0, 1.0)), F.lit(False))
    amount = f["amount"]
    return [
        (~f["transaction_id"].nonempty_string(), S.MSG_TRANSACTION_ID),
        (~f["customer_id"].nonempty_string(), S.MSG_CUSTOMER_ID),
        (~(amount.is_number() | F.coalesce(amount.t == "BOOLEAN", F.lit(False))), S.MSG_AMOUNT),
        (~f["currency"].string_where(lambda s: F.length(s) == 3), S.MSG_CURRENCY),
        (~ts_ok, S.MSG_TIMESTAMP),
        (~label_ok, S.MSG_IS_FRAUD),
        (~f["transaction_type"].string_where(lambda s: s.isin(S.VALID_TRANSACTION_TYPES)), S.MSG_TRANSACTION_TYPE),
        (~f["transaction_status"].string_where(lambda s: s.isin(S.VALID_TRANSACTION_STATUSES)),
         S.MSG_TRANSACTION_STATUS),
        *[(~f[name].truthy(), S.MSG_MISSING_FIELD.format(name)) for name in S.PRESENCE_FIELDS],
    ]


_FIELDS_STRUCT = "struct<" + ",".join(f"`{n}`:variant" for n in RULE_FIELDS) + ">"


def validate(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``payload`` (variant), ``status`` and ``error_reason``.

    Built as successive projections -- parse once, cast the object once into a
    struct of the checked fields, take each field's type once, evaluate the
    rules as a bit set, then derive reason and status -- so no expensive
    expression is referenced more than once by the next step and Catalyst keeps
    the steps apart instead of re-parsing per rule.  ``payload`` stays outside the
    generator that keeps filters above, so a reader of the status alone does not
    pay for a copy of every document.

    ``value`` may be string or binary (binary is decoded as UTF-8; invalid
    sequences are replaced, as a lossy decode would).
    """
    raw = F.col(value_col)
    if dict(messages.dtypes).get(value_col) == "binary":
        raw = F.make_valid_utf8(F.col(value_col).cast("string"))
    keep = [F.col(c) for c in messages.columns]
    rules = rule_failures()
    bits = F.lit(0)
    for i, (bad, _) in enumerate(rules):
        bits = bits + F.when(bad, F.lit(1 << i)).otherwise(F.lit(0))
    reasons = F.concat_ws(S.REASON_SEPARATOR, *[
        F.when(F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(msg)) for i, (_, msg) in enumerate(rules)])
    # A text whose array has an object first holds more than nothing; only other texts are asked for their first element.
    single = F.try_variant_get("_w", "$[1]", "variant").isNull() & (
        F.col("_fs").isNotNull() | F.try_variant_get("_w", "$[0]", "variant").isNotNull())
    parsed = ["_tomb", "_w", "_one", "_obj"]
    return (messages
            .select(*keep, raw.isNull().alias("_tomb"),
                    _wrapped(raw).alias("_w"))
            .select(*keep, "_tomb", "_w",
                    F.try_variant_get("_w", "$[0]", _FIELDS_STRUCT).alias("_fs"))
            .select(*keep, "_tomb", "_w", "_fs", single.alias("_one"))
            .select(*keep, "_tomb", "_w", "_one", F.col("_fs").isNotNull().alias("_obj"),
                    *[F.col(f"_fs.`{n}`").alias(f"_v_{n}") for n in RULE_FIELDS])
            .select(*keep, *parsed,
                    *[F.col(f"_v_{n}") for n in RULE_FIELDS],
                    *[F.schema_of_variant(f"_v_{n}").alias(f"_t_{n}") for n in RULE_FIELDS])
            .withColumn("_time_ok", _Field("timestamp").string_where(lambda s: iso_timestamp(s).isNotNull()))
            .select(*keep, *parsed, bits.alias("_bits"))
            .select(*keep, F.when(F.col("_one"), F.try_variant_get("_w", "$[0]", "variant")).alias("payload"),
                    F.when(F.col("_tomb"), F.lit(None).cast("string"))
                     .when(~F.col("_one"), F.lit(MALFORMED_REASON))
                     .when(~F.col("_obj"), F.lit(S.MSG_NOT_OBJECT))
                     .when(F.col("_bits") != 0, reasons).alias("_reason"),
                    F.when(F.col("_tomb"), F.lit(STATUS_TOMBSTONE))
                     .when(~F.col("_one"), F.lit(STATUS_MALFORMED))
                     .when(~F.col("_obj") | (F.col("_bits") != 0), F.lit(STATUS_INVALID))
                     .otherwise(F.lit(STATUS_VALID)).alias("_status"))
            .select(*keep, "payload", F.inline(F.array(F.struct(
                F.col("_reason").alias("error_reason"), F.col("_status").alias("status"))))))


def typed_transactions(validated: DataFrame) -> DataFrame:
    """Valid messages as typed transaction rows (the landing record).

    Fields keep the wire semantics: ``timestamp`` is parsed to a timestamp,
    ``is_fraud`` becomes 0/1 (booleans included); unknown fields and values that a field's
    type cannot hold stay in the variant column ``extra``.
    """
    names = S.TRANSACTION_SCHEMA.fieldNames()
    passthrough = [F.col(c).alias(f"kafka_{c}" if c in (*names, documents.EXTRA) else c) for c in validated.columns
                   if c not in ("payload", "status", "error_reason", "value")]
    valid = validated.filter(F.col("status") == STATUS_VALID).select(
        *passthrough, "payload", iso_timestamp(_as_string(F.col("payload"), "timestamp")).alias("_time"))
    return documents.typed(valid, "payload", special={"timestamp": F.col("_time")}).drop("_time")
