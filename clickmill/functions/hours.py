"""Event hours (epoch milliseconds) and ingest dates."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmill.schema import INGEST_DATE, MS_PER_HOUR

MS_PER_DAY = 24 * MS_PER_HOUR
FIRST_DAY, LAST_DAY = (day.toordinal() - date(1970, 1, 1).toordinal() for day in (date(1600, 1, 1), date.max))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hour_bucket(millis) -> Column:
    """Start of the hour holding an epoch-millisecond time; exact before 1970 too."""
    millis = _col(millis)
    return millis - F.pmod(millis, F.lit(MS_PER_HOUR).cast("long"))


def hour_bucket_literal(millis) -> Column:
    """Divide and multiply as doubles, which truncates nothing: the time itself comes back.

    Kept only to show why hour_bucket differs.
    """
    return _col(millis) / F.lit(MS_PER_HOUR) * F.lit(MS_PER_HOUR)


def hour_day(hour) -> Column:
    """The UTC date that holds an hour, NULL for none; times before the year 1600 or after 9999 go to the first or last date."""
    hour = _col(hour)
    days = ((hour - F.pmod(hour, F.lit(MS_PER_DAY).cast("long"))) / MS_PER_DAY).cast("long")
    bounded = F.least(F.greatest(days, F.lit(FIRST_DAY)), F.lit(LAST_DAY)).cast("int")
    return F.when(hour.isNotNull(), F.date_from_unix_date(bounded))


def within_hours(hours: int, now: int | Column | None = None, hour="timestamp_hour") -> Column:
    """Hours no older than `hours` before `now` (epoch seconds, default the current time).

    The bare column stands on one side, so parquet statistics can skip row groups.
    """
    now = F.unix_timestamp() if now is None else F.lit(now).cast("long")
    return _col(hour) >= (now - F.lit(hours * 3600)) * F.lit(1000)


def date_parts(day: date | Column | None = None) -> list[Column]:
    """year, month and day columns of the ingest date, today unless one is given."""
    if day is None:
        day = F.current_date()
    elif isinstance(day, date):
        day = F.lit(day)
    return [
        part(day).alias(name)
        for part, name in zip((F.year, F.month, F.dayofmonth), INGEST_DATE, strict=True)
    ]
