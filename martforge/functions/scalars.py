"""Column expressions (all JVM-side built-ins, so they stay in whole-stage codegen).

Timestamps are ``timestamp_ntz`` throughout: every expression here is
independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# --- fixed values -----------------------------------------------------------
# Reporting zones and the fixed KST offset used for the second reporting day.
UTC = "utc"
KST = "kst"
ZONES = (UTC, KST)
KST_OFFSET_HOURS = 9
# Text timestamp format of the freshness report ('%Y-%m-%d %H:%i:%s' in MySQL).
REPORT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Money type of published totals.
MONEY = "decimal(38,10)"
MONEY_SCALE = 10
COUNTER = "decimal(38,0)"
# ---------------------------------------------------------------------------

EPOCH_DAY = _dt.date(1970, 1, 1)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(value: _dt.datetime | _dt.date) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on the session zone.

    (A Python ``datetime`` passed to ``lit`` becomes a session-zone
    ``timestamp``, which shifts when cast to ``timestamp_ntz`` under a
    non-UTC session.)
    """
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def hex_address(c: Column | str) -> Column:
    """binary/number -> ``0x``-prefixed lower-case hex text."""
    return F.lower(F.concat(F.lit("0x"), F.hex(_c(c))))


def epoch_to_ts(c: Column | str) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` (UTC wall time), zone independent."""
    return F.timestamp_add("SECOND", _c(c), ntz_lit(_dt.datetime(1970, 1, 1)))


def ts_to_epoch(c: Column | str) -> Column:
    """``timestamp_ntz`` -> whole epoch seconds (fraction truncated).

    Built from the day number and the clock fields, so no time zone (and no
    daylight-saving rule of the session zone) is involved.
    """
    c = _c(c)
    days = F.datediff(F.to_date(c), F.lit(EPOCH_DAY)).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def kst(c: Column | str) -> Column:
    """UTC wall time -> KST wall time (fixed +9 h)."""
    return F.timestamp_add("HOUR", F.lit(KST_OFFSET_HOURS), _c(c))


def zone_time_columns(base_ts: Column) -> list[Column]:
    """the four derived columns ``ts_utc, dt_utc, ts_kst, dt_kst``."""
    ts_utc = base_ts
    ts_kst = kst(base_ts)
    return [
        ts_utc.alias("ts_utc"),
        F.to_date(ts_utc).alias("dt_utc"),
        ts_kst.alias("ts_kst"),
        F.to_date(ts_kst).alias("dt_kst"),
    ]


def load_stamp(load_ts: _dt.datetime) -> list[Column]:
    """a load-time stamp in both zones, passed in (never the wall clock)."""
    return zone_time_columns(ntz_lit(load_ts))


def report_ts(c: Column | str) -> Column:
    """text timestamp ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(c), REPORT_TS_FORMAT)


def midnight_distance(ts: Column | str) -> Column:
    """F8: minutes from the nearest reporting midnight, six branches (fixed values).

    00:00 -> 0, 00:mm -> mm, 23:mm -> 60-mm, 14:mm -> 660-mm,
    15:mm -> 600+mm, anything else 9999. Hours 14/15 are the KST midnight
    seen on a UTC clock, penalised by 600 so a true midnight sample wins.
    """
    h = F.hour(_c(ts))
    m = F.minute(_c(ts))
    return (
        F.when((h == 0) & (m == 0), F.lit(0))
        .when(h == 0, m)
        .when(h == 23, F.lit(60) - m)
        .when(h == 14, F.lit(60) - m + F.lit(600))
        .when(h == 15, m + F.lit(600))
        .otherwise(F.lit(9999))
    )


def early_morning_shift(date_col: Column | str, ts: Column | str, minutes: int = 5) -> Column:
    """Samples before 00:05 belong to the previous reporting day."""
    return F.when(
        (F.hour(_c(ts)) == 0) & (F.minute(_c(ts)) < minutes), F.date_sub(_c(date_col), 1)
    ).otherwise(_c(date_col))


def cancelled_flag(closed_type: Column | str) -> Column:
    """``closed_type == 0`` -> 0, anything else (NULL included) -> 1."""
    return F.when(_c(closed_type) == 0, F.lit(0)).otherwise(F.lit(1))


def _shifted(digits: Column, places: Column) -> Column:
    """Integer text times ``10 ** -places`` as decimal(38,10), rounded once (HALF_UP).

    The text goes through scientific notation, so any number of digits and any
    exponent is exact; NULL only where 28 integer digits do not hold the result.
    """
    return F.concat(digits, F.lit("E"), (-places.cast("int")).cast("string")).try_cast(MONEY)


def scale_units(value: Column | str, decimals: Column | str) -> Column:
    """raw token units -> tokens, exact, as decimal(38,10).

    Values of up to 38 digits and any ``decimals``. NULL where an input is NULL or the
    result has more than 28 integer digits; ``scale_units_double`` covers those.
    """
    return _shifted(_c(value).cast("decimal(38,0)").cast("string"), _c(decimals))


def scale_units_double(value: Column | str, decimals: Column | str) -> Column:
    """F10 as a double: never NULL where both inputs are set."""
    return _c(value).cast("double") * F.pow(F.lit(10.0), -_c(decimals).cast("double"))


LIMB = "decimal(38,0)"
LIMB_DIGITS = 13  # 39 digits are three limbs; sums of limb products stay within 28 digits


def _limbs(digits: Column) -> list[Column]:
    """Three limbs of 13 digits of a text of up to 39 digits, smallest first."""
    padded = F.lpad(digits, 3 * LIMB_DIGITS, "0")
    return [F.substring(padded, 1 + LIMB_DIGITS * k, LIMB_DIGITS).cast("decimal(13,0)") for k in (2, 1, 0)]


def _long_product(a: Column, b: Column) -> Column:
    """Digits of the exact product of two digit texts, by limbs of 13 digits."""
    x, y = _limbs(a), _limbs(b)
    base = F.lit(10**LIMB_DIGITS).cast(LIMB)
    columns = []
    for k in range(5):
        terms = [(x[i] * y[k - i]).cast(LIMB) for i in range(3) if 0 <= k - i < 3]
        total = terms[0]
        for t in terms[1:]:
            total = (total + t).cast(LIMB)
        columns.append(total)

    def carry_on(state: Column, column: Column) -> Column:
        total = (state["carry"] + column).cast(LIMB)
        rest = (total % base).cast(LIMB)
        digits = F.concat(F.lpad(rest.cast("string"), LIMB_DIGITS, "0"), state["digits"])
        return F.struct(((total - rest) / base).cast(LIMB).alias("carry"), digits.alias("digits"))

    start = F.struct(F.lit(0).cast(LIMB).alias("carry"), F.lit("").alias("digits"))
    return F.aggregate(F.array(*columns), start, carry_on, lambda s: F.concat(s["carry"].cast("string"), s["digits"]))


PRICE_SCALE = 18


def usd_value(value: Column | str, price: Column | str, decimals: Column | str) -> Column:
    """``value * price / 10**decimals`` as decimal(38,10), exact and rounded once.

    Prices keep all their digits (up to 18 after the point). Products of up to
    19 by 18 digits are one decimal multiplication; wider ones are multiplied by limbs.
    NULL where an input is NULL or the result has more than 28 integer digits;
    ``usd_value_double`` covers those.
    """
    v, p = _c(value).cast("decimal(38,0)"), _c(price).cast(f"decimal(38,{PRICE_SCALE})")
    short = v.try_cast("decimal(19,0)") * p.try_cast("decimal(18,9)")  # decimal(38,9)
    sign = F.when((v < 0) != (p < 0), F.lit("-")).otherwise(F.lit(""))
    wide = _shifted(F.concat(sign, _long_product(F.abs(v).cast("string"), unscaled(p))), _c(decimals).cast("int") + PRICE_SCALE)
    fits = (p.try_cast("decimal(18,9)") == p) & v.try_cast("decimal(19,0)").isNotNull()
    # the long product stands in the plan once, and is computed only where the short one does not hold
    return F.coalesce(F.when(fits, _shifted(short.cast("string"), _c(decimals))), wide)


def unscaled(p: Column) -> Column:
    """Digits of |p| * 10**18: whole and fractional digits joined."""
    a = F.abs(p)
    part = (a % 1).cast("decimal(18,18)") * F.lit(10**PRICE_SCALE).cast("decimal(19,0)")
    return F.concat(F.floor(a).cast("string"), F.lpad(part.cast("decimal(18,0)").cast("string"), PRICE_SCALE, "0"))


def usd_value_double(value: Column | str, price: Column | str, decimals: Column | str) -> Column:
    """F11 as a double: never NULL where all inputs are set."""
    return _c(value).cast("double") * _c(price).cast("double") * F.pow(F.lit(10.0), -_c(decimals).cast("double"))


def safe_cast(c: Column | str, data_type: DataType | str) -> Column:
    """string -> number; malformed text becomes NULL (ANSI-safe)."""
    return _c(c).try_cast(data_type)


def money_sum(c: Column | str, wide: bool = False) -> Column:
    """A2: exact decimal sum published as decimal(38,10).

    ``wide`` is for inputs of more than 10 decimals (H2): whole and fractional parts are
    summed apart, since a sum of decimal(38,18) would hold only 20 integer digits.
    """
    if not wide:
        return F.sum(_c(c)).cast(MONEY)
    whole = F.floor(_c(c)).cast("decimal(38,0)")
    part = (_c(c) - whole).cast("decimal(18,18)")
    return (F.sum(whole).cast("decimal(28,0)") + F.sum(part).cast("decimal(28,18)").cast("decimal(28,10)")).cast(MONEY)


def exact_avg(c: Column | str) -> Column:
    """A3: unweighted mean of a decimal column, as a double.

    ``double(sum) / count`` is computed from an exact decimal sum, so it does
    not depend on the order rows are added in.
    """
    return F.try_divide(F.sum(_c(c)).cast("double"), F.count(_c(c)))
