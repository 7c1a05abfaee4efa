"""Text to dates, timestamps and key types, independent of ANSI mode and session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A zone written behind a date and a time of day: Z, an offset, or a name.
_OWN_ZONE = r"^\d{4}-.*:.*([zZ]|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+(/[A-Za-z_]+)*([+-]\d+)?)$"

CLOCK_POLICIES = ("earlier", "later", "null", "raise")
_DAY = 24 * 3600 * 1_000_000


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _or_raise(text: Column, parsed: Column, what: str) -> Column:
    """``parsed``, but a text that gave nothing stops the job."""
    message = F.concat(F.lit(f"cannot read as {what}: "), text.cast("string"))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def parse_date(col: Column | str, strict: bool = False) -> Column:
    """ISO date or date-time text to a date; bad text gives null, or an error if ``strict``."""
    text = _as_column(col)
    parsed = F.try_to_date(text)
    return _or_raise(text, parsed, "a date") if strict else parsed


def wall_clock_instant(wall: Column, zone: str, twice: str = "earlier", never: str = "later") -> Column:
    """The instant at which clocks in ``zone`` show ``wall``, a wall clock written as if it were UTC.

    When clocks go back they show some times ``twice``: ``earlier`` and ``later`` are the two instants.
    When they go forward they show some ``never``: ``later`` reads such a time with the offset before
    the change, ``earlier`` with the offset after it. Both may also be ``null`` or ``raise``. The offsets
    are those of a day before and after, so a zone must not change its clocks twice in two days.
    """
    for policy in (twice, never):
        if policy not in CLOCK_POLICIES:
            raise ValueError(f"a policy is one of {CLOCK_POLICIES}, not {policy!r}")
    own = F.to_utc_timestamp(wall, zone)
    if (twice, never) == ("earlier", "later"):  # what Spark does
        return own
    micros = F.unix_micros(wall)

    def with_offset_of(probe: Column) -> Column:
        return F.timestamp_micros(micros - F.unix_micros(F.from_utc_timestamp(probe, zone)) + F.unix_micros(probe))

    before = with_offset_of(F.timestamp_micros(micros - _DAY))
    after = with_offset_of(F.timestamp_micros(micros + _DAY))

    def shown(instant: Column) -> Column:
        return F.from_utc_timestamp(instant, zone) == wall

    def chosen(policy: str, what: str) -> Column:
        shown_as = F.to_timestamp_ntz(F.lit("1970-01-01")) + F.make_dt_interval(secs=F.unix_seconds(wall))
        message = F.concat(F.lit(f"clocks in {zone} show this time {what}: "), shown_as.cast("string"))
        return {
            "earlier": F.least(before, after),
            "later": F.greatest(before, after),
            "null": F.lit(None).cast("timestamp"),
            "raise": F.raise_error(message).cast("timestamp"),
        }[policy]

    repeated = (before != after) & shown(before) & shown(after)
    return F.when(~shown(own), chosen(never, "never")).when(repeated, chosen(twice, "twice")).otherwise(own)


def parse_timestamp(
    col: Column | str, zone: str = "UTC", strict: bool = False, twice: str = "earlier", never: str = "later"
) -> Column:
    """ISO text to a timestamp; text without a zone of its own is read in ``zone``.

    The wall clock is read as UTC and then moved by the zone, so the outcome does not depend on the
    zone of the session. Text without a date gives null: cast to a timestamp it would mean today.
    ``twice`` and ``never`` say what happens to times that :func:`wall_clock_instant` finds two instants
    or none for; a null that they give counts as unreadable if ``strict``.
    """
    text = F.trim(_as_column(col))
    date_only = ~text.rlike("[T :]")
    midnight = F.concat(text.try_cast("date").cast("string"), F.lit("T00:00:00Z"))
    has_date = F.substring(text, 5, 1) == "-"

    def as_utc(seconds: str) -> Column:
        return F.concat(text, F.lit(seconds + "Z")).try_cast("timestamp")

    wall_clock = F.when(date_only, midnight.try_cast("timestamp")).when(
        has_date, F.coalesce(as_utc(""), as_utc(":00"), as_utc(":00:00"))
    )
    own_zone = F.when(text.rlike(_OWN_ZONE), text.try_cast("timestamp"))
    parsed = F.coalesce(wall_clock_instant(wall_clock, zone, twice, never), own_zone)
    return _or_raise(text, parsed, "a timestamp") if strict else parsed


def cast_key(col: Column | str, data_type: str, strict: bool = True) -> Column:
    """A join key as ``data_type``; text that does not fit raises, or gives null if not ``strict``."""
    key = _as_column(col)
    cast = key.try_cast(data_type)
    return _or_raise(key, cast, data_type) if strict else cast
