"""Scalar column functions. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.constants import CAPACITY_FACTOR, OUTPUT_SUFFIX, UNKNOWN_SIZE_BYTES

# The characters Python's str.isspace accepts, as a class for Java
# regular expressions (plain \s is ASCII only) and one by one for trimming.
SPACE = r"[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_MAX_BIGINT = 2**63 - 1


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def decode_payload(raw: Column | str) -> Column:
    """BINARY -> STRING: UTF-8 where valid, otherwise latin-1."""
    text = _col(raw).cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(_col(raw), "ISO-8859-1"))


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(SPACES))


def collapse_whitespace(text: Column | str) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(_col(text), rf"(?U){SPACE}+", " "))


def char_length(text: Column | str) -> Column:
    return F.length(_col(text)).cast("bigint")


def byte_length(text: Column | str) -> Column:
    return F.octet_length(_col(text)).cast("bigint")


def basename(path: Column | str) -> Column:
    """Last path component; trailing slashes do not count."""
    return F.regexp_extract(_col(path), "([^/]+)/*$", 1)


def output_name(folder: str, name: Column | str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), _col(name), F.lit(OUTPUT_SUFFIX))


def drop_output_suffix(name: Column | str) -> Column:
    return F.regexp_replace(_col(name), r"\.txt\z", "")


def estimated_size(content_length: Column | str) -> Column:
    """Digits are a size; anything else counts as an unknown size."""
    text = _col(content_length)
    size = F.coalesce(text.try_cast("bigint"), F.lit(_MAX_BIGINT))
    return F.when(text.rlike(r"^[0-9]+\z"), size).otherwise(
        F.lit(UNKNOWN_SIZE_BYTES).cast("bigint")
    )


def needed_space(size: Column | str) -> Column:
    return F.floor(_col(size).cast("double") * F.lit(CAPACITY_FACTOR).cast("double"))


def node_label(worker: Column | str, cores_per_node: int) -> Column:
    return F.when(_col(worker) < cores_per_node, F.lit("N0")).otherwise(F.lit("N1"))


def _sized(amount: Column | str, power: int, pattern: str, unit: str) -> Column:
    value = _col(amount).cast("double") / F.lit(float(1024**power))
    return F.concat(F.call_function("format_number", value, F.lit(pattern)), F.lit(unit))


def as_gigabytes(amount: Column | str) -> Column:
    return _sized(amount, 3, "0.00", " GB")


def as_megabytes(amount: Column | str) -> Column:
    return _sized(amount, 2, "0.0", " MB")


def as_elapsed(seconds: Column | str) -> Column:
    """Whole seconds as `[D day[s], ]H:MM:SS`."""
    whole = _col(seconds).cast("bigint")
    days = F.floor(whole / F.lit(86400))  # rounds down, also for negative values
    rest = F.pmod(whole, F.lit(86400))
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(rest / 3600),
        F.floor(F.pmod(rest, F.lit(3600)) / 60),
        F.pmod(rest, F.lit(60)),
    )
    prefix = F.when(days == 0, F.lit("")).otherwise(
        F.concat(
            days.cast("string"),
            F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")),
        )
    )
    return F.concat(prefix, clock)


def from_iso(text: Column | str) -> Column:
    return F.to_timestamp(_col(text))


def to_iso(moment: Column | str) -> Column:
    """ISO-8601; the fraction has six digits and is left out when it is zero."""
    value = _col(moment)
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(value, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", F.lit("")).otherwise(fraction))


def add_to_counter(counter: Column | str, amount: Column | str) -> Column:
    return F.coalesce(_col(counter), F.lit(0).cast("bigint")) + _col(amount)


def list_add(items: Column | str, item: Column | str) -> Column:
    """Append unless present; an absent list counts as empty."""
    have = F.coalesce(_col(items), F.array().cast("array<string>"))
    return F.when(F.array_contains(have, _col(item)), have).otherwise(
        F.array_append(have, _col(item))
    )


def list_remove(items: Column | str, item: Column | str) -> Column:
    """Remove the first occurrence; unchanged when there is none."""
    have = _col(items)
    at = F.array_position(have, _col(item)).cast("int")
    rest = F.greatest(F.size(have) - at, F.lit(0))
    return F.when(
        at > 0,
        F.concat(
            F.slice(have, F.lit(1), at - 1),
            F.slice(have, at + 1, rest),
        ),
    ).otherwise(have)
