"""Time expressions: parsing, UTC ISO text, flooring, spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsift.contracts import ISO_OUTPUT_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Extra explicit patterns tried after the built-in ISO parser (configurable;
# the reference's free-form fallback guesses, we do not).
EXTRA_PATTERNS: tuple[str, ...] = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ",
    "yyyy-MM-dd'T'HH:mm:ssZ",
    "yyyy-MM-dd HH:mm:ss.SSSSSSZ",
    "yyyy-MM-dd HH:mm:ssZ",
)

#: Text that begins with a year.
DATE_FIRST = r"^\s*[+-]?\d{4}"


def parse_ts(c, extra_patterns: tuple[str, ...] = EXTRA_PATTERNS) -> Column:
    """String -> TIMESTAMP (UTC session), null when nothing parses (H8, H9).

    The built-in parser covers all eight contract formats ('T' or space,
    optional fraction, 'Z' or an offset).  A TIMESTAMP input passes through.
    A time of day without a date is no timestamp: it would take today's date.
    """
    x = _col(c)
    s = x.cast("string")
    tries = [x.try_cast("timestamp")]
    tries += [F.try_to_timestamp(s, F.lit(p)) for p in extra_patterns]
    return F.when(s.rlike(DATE_FIRST), F.coalesce(*tries))


def iso_utc(c) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` text of a UTC timestamp."""
    return F.date_format(_col(c), ISO_OUTPUT_PATTERN)


def floor_time(c, seconds: int = 1) -> Column:
    """Round down to a multiple of n seconds (H12); right for pre-1970 too."""
    x = _col(c).cast("timestamp")
    if seconds == 1:
        return F.date_trunc("second", x)
    micros = F.unix_micros(x)
    step = F.lit(int(seconds) * 1_000_000)
    return F.timestamp_micros(micros - F.pmod(micros, step))


def span_days(a, b) -> Column:
    """Whole elapsed 24 h periods between two instants (H13), not midnights."""
    d = F.unix_micros(_col(b).cast("timestamp")) - F.unix_micros(_col(a).cast("timestamp"))
    return F.floor(d / F.lit(86_400_000_000)).cast("long")


def display_ts(c) -> Column:
    """'YYYY-MM-DD HH:MM:SS' of parseable text, else the raw text."""
    x = _col(c)
    return F.coalesce(F.date_format(parse_ts(x), "yyyy-MM-dd HH:mm:ss"), x.cast("string"))


def to_ntz(c) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ wall time in the (UTC) session zone."""
    return _col(c).cast("timestamp_ntz")
