"""Names, labels and times written in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and their plain forms.
ACCENTED, PLAIN = "áàäâãéèëêíìïîóòöôõúùüûñç", "aaaaaeeeeiiiiooooouuuunc"


def folded_name(name: Column) -> Column:
    """A key that ignores case, accents and outer white space."""
    return F.translate(F.lower(F.trim(name)), ACCENTED, PLAIN)


def beam_label(index: Column) -> Column:
    """VB for the vertical beam 0, B1 to B4 for the slant ones, BT for a collapsed point."""
    return F.when(index == 0, "VB").when(index < 0, "BT").otherwise(F.concat(F.lit("B"), index.cast("string")))


def joined_flags(**flags: Column) -> Column:
    """The names of the true flags, in the order given, joined by semicolons."""
    return F.concat_ws(";", *(F.when(c, F.lit(n)) for n, c in flags.items()))


#: The accepted forms of a reading's time, tried in this order.
TIME_FORMS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
)


def parsed_time(text: Column) -> Column:
    """The first accepted form that fits, or null."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(text), F.lit(f)) for f in TIME_FORMS)).cast("timestamp_ntz")


DAY = 86_400.0


def stem_time(stem: Column) -> Column:
    """Seconds since 1970 of the first fourteen digits of a file's stem, or null."""
    digits = F.regexp_extract(stem, r"(\d{14})", 1)
    return F.unix_timestamp(F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMddHHmmss"))).cast("double")


def decoded_epoch(value: Column, hint: Column) -> Column:
    """Seconds since 1970 of a clock value whose epoch is not known.

    Candidates are seconds since 2000, day numbers (1 is 0001-01-01 plus 366 days),
    seconds and milliseconds since 1970, each in its plausible range. The one nearest
    to ``hint`` wins if within seven days; else the first, in that order.
    """
    candidates = F.array(
        F.when((value > 1e7) & (value < 4e9), value + 946_684_800.0),
        F.when((value > 6e5) & (value < 8e5), (value - 719_529.0) * DAY),
        F.when((value > 3e8) & (value < 4e9), value),
        F.when((value > 3e11) & (value < 4e12), value / 1000.0),
    )
    kept = F.filter(candidates, lambda x: x.isNotNull())
    near = F.array_min(F.transform(kept, lambda x: F.struct(F.abs(x - hint).alias("d"), x.alias("x"))))
    return F.when(near["d"] <= 7 * DAY, near["x"]).otherwise(F.try_element_at(kept, F.lit(1)))
