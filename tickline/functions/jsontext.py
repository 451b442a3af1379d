"""JSON text pieces built with built-in column functions (no Python per row).

Used where the exact bytes matter: the canonical text that is hashed into an
``event_id``. Numbers follow Python's ``repr`` of a float, which is what the
producer hashes:

* between 1e-4 and 1e16 (exclusive) plain notation with the shortest round-trip
  digits and at least one fraction digit (``250.5``, ``100.0``, ``0.0001``);
* otherwise ``d[.ddd]e+XX`` / ``d[.ddd]e-XX`` (``1e+16``, ``1.5e-05``).

Java's ``Double.toString`` (what ``cast(double as string)`` and ``to_json`` print)
switches to ``1.0E7`` layout outside [1e-3, 1e7) and, on JDK 17, sometimes prints
one digit more than the shortest; see :func:`python_float_text`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _escaped_char(c: Column) -> Column:
    """One character the way Python's ``json.dumps`` writes it: printable ASCII as is, the usual short
    escapes, everything else as ``\\uXXXX`` (two of them beyond the basic plane)."""
    units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
    long = F.concat(F.lit("\\u"), F.substring(units, 1, 4), F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(F.lit("")))
    out = F.when(c.rlike(r"^[ !#-\[\]-~]$"), c).when(c.isin('"', "\\"), F.concat(F.lit("\\"), c))
    for raw, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = out.when(c == raw, F.lit(short))
    return out.otherwise(long)


def json_string(text: Column) -> Column:
    """A JSON string literal for ``text`` with Python's (ASCII-only) escapes."""
    text = text.cast("string")
    quote = F.lit('"')
    plain = text.rlike(r"\A[ !#-\[\]-~]*\z")
    escaped = F.array_join(F.transform(F.split(text, ""), _escaped_char), "")
    return F.when(plain, F.concat(quote, text, quote)).otherwise(F.concat(quote, escaped, quote))


def python_float_text(x: Column) -> Column:
    """``repr(float(x))`` for a finite DOUBLE column; ``NaN``, ``Infinity`` and ``-Infinity`` for others.

    Fast path: between 1e-3 and 1e7 Java prints the same text as Python, and
    with at most 15 significant digits it is the shortest one. Otherwise the
    digits are taken from ``%.15e`` (16 digits) when that round-trips, else from
    ``%.16e`` (17 digits), trailing zeros dropped, and laid out the way Python
    does (plain between 1e-4 and 1e16, else ``d.ddde±XX``). The round-trip test
    also corrects JDK 17's occasional 17-digit output (``5.5938493878276624E16``).
    Subnormal numbers (below 2.3e-308) have fewer digits than that: theirs are the
    first of ``%.0e``, ``%.1e``, ... that round-trips.
    """
    x = x.cast("double")
    java = x.cast("string")
    ax = F.abs(x)
    # at most 16 characters leave at most 15 digits (the point takes one)
    fast = (ax >= F.lit(1e-3)) & (ax < F.lit(1e7)) & (F.length(java) <= 16)
    special = F.isnan(x) | (ax == F.lit(float("inf")))  # NaN is greater than any number in Spark
    return F.when(fast | (ax == 0) | special, java).otherwise(bound(x, _exact_text))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _exact_text(x: Column) -> Column:
    s16 = F.format_string("%.15e", x)
    text = F.when(s16.cast("double") == x, s16).otherwise(F.format_string("%.16e", x))
    shorter = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda d: F.call_function("format_string", F.concat(F.lit("%."), d.cast("string"), F.lit("e")), x))
    first = F.get(F.filter(shorter, lambda t: t.cast("double") == x), 0)
    text = F.when(F.abs(x) < F.lit(2.3e-308), F.coalesce(first, text)).otherwise(text)
    return bound(text, lambda t: _layout(t, x))


def _layout(text: Column, x: Column) -> Column:
    """Python's layout of a number in ``d.ddde±XX`` form."""
    exp = F.substring_index(text, "e", -1).cast("int")
    digits = F.rtrim(F.regexp_replace(F.substring_index(text, "e", 1), r"[-.]", ""), F.lit("0"))
    return bound(F.struct(exp.alias("exp"), digits.alias("digits"), F.length(digits).alias("n")), lambda r: _digits_text(r["exp"], r["digits"], r["n"], x))


def _digits_text(exp: Column, digits: Column, n: Column, x: Column) -> Column:
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    point = exp + 1
    wide = F.when(
        n <= point, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0"))
    ).otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.lit(32))))
    narrow = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    plain = F.concat(sign, F.when(exp >= 0, wide).otherwise(narrow))
    mantissa = F.when(n > 1, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), F.lit(32)))).otherwise(digits)
    sci = F.concat(
        sign,
        mantissa,
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exp).cast("string"),
    )
    return F.when((exp >= -4) & (exp < 16), plain).otherwise(sci)
