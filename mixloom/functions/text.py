"""Title normalisation and time formatting, all in built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a title loses.
DROPPED = ".,/#!$%^*;:{}=_`~()@"
# All white space of Unicode; the last of it is U+3000.
SPACES = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def normalize_name(text) -> Column:
    """Lower case, dropped characters to blanks, blanks squeezed and stripped.

    Every kind of white space becomes a blank in the same pass, which leaves
    only runs of blanks to the regular expression.
    """
    blanked = DROPPED + SPACES
    plain = F.translate(F.lower(text), blanked, " " * len(blanked))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def _moment(epoch, zone: str) -> Column:
    # Zone-less arithmetic, so the session's time zone never shifts the result.
    seconds = F.col(epoch) if isinstance(epoch, str) else epoch
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def date_text(epoch, zone: str = "UTC") -> Column:
    """Epoch seconds as ``yyyy-MM-dd`` in ``zone``."""
    return _moment(epoch, zone).cast("date").cast("string")


def time_text(epoch, zone: str = "UTC") -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in ``zone``."""
    return _moment(epoch, zone).cast("string")
