"""Column expressions: surrogate keys and the dimension classifications.

All are native Catalyst expressions (md5, concat, CASE), so they stay inside
whole-stage codegen and constant-fold where possible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk import schema as S


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _case(pairs: list[tuple[str, Column]], default: str) -> Column:
    out = F.lit(default)
    for label, cond in reversed(pairs):
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


# --- surrogate keys (S1-S3) -------------------------------------------------

def payment_method_key(payment_method: Column | str = "payment_method") -> Column:
    return F.md5(_c(payment_method).cast("string"))


def location_key(location: Column | str = "location", latitude: Column | str = "latitude",
                 longitude: Column | str = "longitude", fmt: str | None = None) -> Column:
    """md5(location || text(latitude) || text(longitude)); null if any part is null.

    ``fmt`` (e.g. ``'%.6f'``) switches to a fixed decimal text for coordinates,
    avoiding the scientific notation Spark uses for very small doubles.
    """
    if fmt is None:
        lat, lon = _c(latitude).cast("string"), _c(longitude).cast("string")
    else:
        lat, lon = F.format_string(fmt, _c(latitude)), F.format_string(fmt, _c(longitude))
    return F.md5(F.concat(_c(location), lat, lon))


def time_key(ts: Column | str = "timestamp") -> Column:
    return F.md5(_c(ts).cast("string"))


# --- classifications (B10-B16) ----------------------------------------------

def age_group(age: Column | str = "customer_age") -> Column:
    a = _c(age)
    pairs = []
    for label, lo, hi in S.AGE_GROUPS:
        pairs.append((label, a < hi if lo is None else a.between(lo, hi)))
    return _case(pairs, S.AGE_GROUP_DEFAULT)


def device_type(os_col: Column | str = "device_os") -> Column:
    o = _c(os_col)
    return _case([("Mobile", o.isin(S.DEVICE_MOBILE_OS)), ("Desktop", o.isin(S.DEVICE_DESKTOP_OS))], "Other")


def continent(location: Column | str = "location") -> Column:
    loc = _c(location)
    return _case([(name, loc.isin(codes)) for name, codes in S.CONTINENTS], "Other")


def merchant_risk(category: Column | str = "merchant_category") -> Column:
    cat = _c(category)
    return _case([(name, cat.isin(vals)) for name, vals in S.MERCHANT_RISK], "Low Risk")


def payment_risk(method: Column | str = "payment_method") -> Column:
    m = _c(method)
    return _case([(name, m.isin(vals)) for name, vals in S.PAYMENT_RISK], "Standard Risk")


def time_of_day(hour: Column | str = "transaction_hour") -> Column:
    h = _c(hour)
    return _case([(name, h.between(lo, hi)) for name, lo, hi in S.TIME_OF_DAY], "Evening")


def day_type(day_name: Column | str = "day_of_week") -> Column:
    return F.when(_c(day_name).isin(S.WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def day_name(ts: Column | str = "timestamp") -> Column:
    """English day name of a timestamp."""
    return F.date_format(_c(ts), "EEEE")


def padded_id(prefix: str, num: Column | str, width: int) -> Column:
    """Prefix + number, zero-padded to at least ``width`` digits, e.g. CUST00042; longer numbers stay whole."""
    digits = _c(num).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))
