"""ISO 8601 timestamps as the reference's wire format allows them, in native expressions.

Accepted are a date alone, or a date, any one character, and a time:

* dates ``2025-03-08``, ``20250308``, ``2025-W10``, ``2025W10``, ``2025-W10-6``, ``2025W106`` (a week alone is its Monday);
* times ``10``, ``10:15``, ``1015``, ``10:15:00``, ``101500``, with a fraction of a second of any length after a point or a
  comma (cut to microseconds);
* offsets ``+05``, ``+05:30``, ``+0530``, with seconds if need be, under 24 hours; a trailing ``Z`` is ``+00:00``.  One
  stray character before the offset is passed over, as the reference's parser does.

Years go from 1, hours to 23, seconds to 59; a week 53 must exist in its year.  A time without an offset is taken in the
session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The usual form, which Spark's own cast reads alike.
USUAL = r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-](0\d|1[0-7]):[0-5]\d)?$"

_DATE = (r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-W(\d{2})(?:-([1-9])(?!\d))?"
         # digits after a compact week: the first is the weekday if it is the only one or their number is even
         r"|(\d{4})W(\d{2})(?:([1-9])(?=(?:\d(?:\d\d)*)?(?!\d))|(?!\d)|(?=\d\d\d(?:\d\d)*(?!\d))))")
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,](\d+))?"
GENERAL = rf"(?s)^{_DATE}(?:.{_CLOCK}(?:[^Z+-]?([+-]){_CLOCK})?)?$"

#: year, month, day, week year, week, weekday, hour, minute, second, fraction, sign, and the offset's last four.
_PARTS = "$1$4|$2$5|$3$6|$7$10|$8$11|$9$12|$13|$14$16|$15$17|$18|$19|$20|$21$23|$22$24|$25"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _general(text: Column) -> Column:
    """Timestamp of a text that fits ``GENERAL``; null if a part is out of its range."""
    parts = F.split(F.regexp_replace(text, GENERAL, _PARTS), r"\|", -1)
    micros = lambda x: F.rpad(F.substring(x, 1, 6), 6, "0")
    # missing parts are 0; parts 9 and 14 are fractions, part 10 is the sign
    numbers = lambda p: F.transform(p, lambda x, i: F.when(i == 10, F.when(x == "-", -1).otherwise(1))
                                    .otherwise(F.coalesce(F.when(i.isin(9, 14), micros(x)).otherwise(x).try_cast("long"), F.lit(0))))
    return bound(bound(parts, numbers), lambda n: bound(_date(n), lambda date: _instant(n, date)))


def _date(n: Column) -> Column:
    at = lambda i: F.get(n, F.lit(i)).cast("int")
    fourth = F.make_date(F.greatest(at(3), F.lit(1)), F.lit(1), F.lit(4))        # January 4th is in week 1
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (at(4) - 1) * 7)
    exists = at(4).between(1, 52) | ((at(4) == 53) & (F.weekofyear(monday) == 53))
    of_week = F.when(exists, F.date_add(monday, F.greatest(at(5), F.lit(1)) - 1))
    of_date = F.concat_ws("-", F.lpad(at(0).cast("string"), 4, "0"), F.lpad(at(1).cast("string"), 2, "0"), F.lpad(at(2).cast("string"), 2, "0"))
    return F.when(at(3) > 0, of_week).when(at(0) > 0, of_date.try_cast("date"))


def _instant(n: Column, date: Column) -> Column:
    at = lambda i: F.get(n, F.lit(i))
    clock = lambda i: (at(i) * 3600 + at(i + 1) * 60 + at(i + 2)) * 1_000_000 + at(i + 3)
    in_range = (at(6) <= 23) & (at(7) <= 59) & (at(8) <= 59) & (at(5) <= 7) & (clock(11) < 86_400_000_000)
    return F.when(in_range & date.isNotNull(), F.timestamp_micros(F.unix_micros(date.cast("timestamp")) + clock(6) - at(10) * clock(11)))


def iso_timestamp(text: Column) -> Column:
    """The instant that an ISO 8601 text names, null if it is none."""
    zulu = F.when(text.endswith("Z"), F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit("+00:00"))).otherwise(text)
    usual = F.when(text.rlike(USUAL), F.try_to_timestamp(text))
    return F.coalesce(usual, bound(zulu, lambda z: F.when(z.rlike(GENERAL), _general(z))))
