"""Scalar functions: guards for spreadsheet text, number formats, lengths, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that start a formula.
FORMULA = "^[=+\\-@\\t\\r]"


def guard_text(s: Column) -> Column:
    """A quote before text that a spreadsheet would take for a formula."""
    return F.when(s.rlike(FORMULA), F.concat(F.lit("'"), s)).otherwise(s)


def csv_cell(s: Column) -> Column:
    """Guarded and quoted, quotes doubled."""
    return F.concat(F.lit('"'), F.replace(guard_text(s), F.lit('"'), F.lit('""')), F.lit('"'))


def finite_or_null(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def twelve_digits(v: Column) -> Column:
    """Text with 12 significant digits; blank where not finite."""
    finite = finite_or_null(v)
    return F.when(finite.isNull(), "").otherwise(F.format_string("%.12g", finite))


def significant(v: Column, digits: int = 4) -> Column:
    """Rounded to significant digits, halves away from zero."""
    power = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(v))))
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * F.floor(F.abs(v) * power + 0.5) / power)


_DECIMAL = r"^([+-]?)([0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE]([+-]?[0-9]+))?$"


def _decimal(s: Column) -> dict[str, Column]:
    """Parts of decimal text: digits without leading zeros, and the power of ten of the first one (null beyond 32 bits)."""
    body, e = F.regexp_extract(s, _DECIMAL, 2), F.regexp_extract(s, _DECIMAL, 3)
    whole, fraction = F.regexp_extract(body, r"^([0-9]*)", 1), F.regexp_extract(body, r"\.([0-9]*)$", 1)
    digits = F.regexp_replace(F.concat(whole, fraction), "^0+", "")
    power = F.when(e == "", F.lit(0)).otherwise(e.try_cast("int")) - F.length(fraction) + F.length(digits) - 1
    return {"good": s.rlike(_DECIMAL) & power.isNotNull(), "negative": F.regexp_extract(s, _DECIMAL, 1) == "-", "digits": digits, "power": power}


def fits_fifteen_digits(s: Column) -> Column:
    """Decimal text that a spreadsheet holds exactly: at most 15 significant digits, a magnitude it knows, and no integer from 1E15 on."""
    d = _decimal(s)
    places = F.length(F.regexp_replace(d["digits"], "0+$", ""))
    integer = d["power"] >= places - 1
    return F.coalesce(d["good"] & (places <= 15) & ((places == 0) | (d["power"].between(-307, 307) & (~integer | (d["power"] < 15)))), F.lit(False))


def four_digit_text(s: Column) -> Column:
    """Decimal text with four significant digits, halves up in size; with an exponent from 1e5 on and below 1e-3; other text as it is."""
    d = _decimal(s)
    head = F.rpad(F.substring(d["digits"], 1, 4), 4, "0").cast("int") + (F.substring(d["digits"], 5, 1) >= "5").cast("int")
    power = d["power"] + (head == 10_000).cast("int")
    digits = F.regexp_replace(F.when(head == 10_000, "1").otherwise(head.cast("string")), "0+$", "")
    n, first, rest = F.length(digits), F.substring(digits, 1, 1), F.substr(digits, F.lit(2))
    pointed = lambda a, b: F.when(b == "", a).otherwise(F.concat(a, F.lit("."), b))
    below = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    above = pointed(F.rpad(F.substr(digits, F.lit(1), power + 1), power + 1, F.lit("0")), F.when(n > power + 1, F.substr(digits, power + 2)).otherwise(""))
    text = F.when((power < -3) | (power >= 5), F.concat(pointed(first, rest), F.lit("e"), power.cast("string"))).when(power < 0, below).otherwise(above)
    return F.when(~F.coalesce(d["good"], F.lit(False)), s).when(d["digits"].rlike("^0*$"), "0").otherwise(F.concat(F.when(d["negative"], "-").otherwise(""), text))


def escape_cell_codes(s: Column) -> Column:
    """Text that looks like an _xHHHH_ code gets its underscore encoded; codes don't overlap."""
    return F.regexp_replace(s, "_([xX][0-9a-fA-F]{4}_)", "_x005F_$1")


def wrapped(s: Column, width: int = 60) -> Column:
    """A line break after every ``width`` code points."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.char_length(s), F.lit(1)) - 1) / width).cast("int")),
                        lambda i: F.substr(s, i * width + 1, F.lit(width)))
    return F.array_join(parts, "\n")


def safe_file_name(s: Column) -> Column:
    """Other characters as single hyphens, none at the ends; "channel" where nothing is left."""
    safe = F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(F.btrim(safe) == "", "channel").otherwise(safe)


def json_escape(s: Column) -> Column:
    for mark, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        s = F.replace(s, F.lit(mark), F.lit(code))
    return s


def index_ignoring_case(values: Column, target: Column) -> Column:
    """Place from 0, or -1."""
    return (F.array_position(F.transform(values, F.lower), F.lower(target)) - 1).cast("int")


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| over the larger; infinite unless both are positive and finite."""
    good = (a > 0) & (b > 0) & (a < float("inf")) & (b < float("inf")) & ~F.isnan(a) & ~F.isnan(b)
    return F.when(good, F.abs(a - b) / F.greatest(a, b)).otherwise(F.lit(float("inf")))


def nice_length(v: Column) -> Column:
    """Largest of 1, 2, 5 x 10^n that isn't over v."""
    base = F.pow(F.lit(10.0), F.floor(F.log10(v)))
    return base * F.when(v / base >= 5, 5.0).when(v / base >= 2, 2.0).otherwise(1.0)


def print_size_cm(pixels: Column, dpi: Column | float) -> Column:
    return pixels * 2.54 / dpi


def covered_pixels(start: Column, length: Column) -> tuple[Column, Column]:
    """First pixel and end pixel whose centres lie in [start, start + length)."""
    return F.ceil(start - 0.5), F.ceil(start + length - 0.5)


def bucket(v: Column, size: int) -> Column:
    return F.floor(v / size).cast("long")


def sha256_hex(v: Column) -> Column:
    return F.sha2(v, 256)
