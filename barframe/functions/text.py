"""Text columns: numbers as text, markers, symbols, message parts, commands."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from barframe.fixed_values import (
    CHANGE_MARKERS,
    HIGH_CHANGE,
    MESSAGE_LIMIT,
    PREVIEW_LENGTH,
    STRIKE_MARKERS,
    SYMBOL_LENGTH,
    TREND_DOWN,
    TREND_FLAT,
    TREND_HIGH,
    TREND_LOW,
    TREND_UP,
)

Rules = Mapping[str, Mapping]  # column -> {band: marker, 'values': {pattern: marker}}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- predicates and bands -------------------------------------------------------------


def any_word(lowered: Column | str, words: Sequence[str]) -> Column:
    """Does the lower-cased text hold any of the words, also inside other words?

    Plain substring searches; one pattern of all words takes three times as long.
    """
    return reduce(or_, [F.contains(_col(lowered), F.lit(w)) for w in words], F.lit(False))


def name_matches(col: Column | str, pattern: str) -> Column:
    return _col(col).rlike(pattern)


def same_text(a: Column | str, b: Column | str) -> Column:
    return F.upper(_col(a)) == F.upper(_col(b))


def trend_band(prob: Column | str, hi: float = TREND_HIGH, lo: float = TREND_LOW) -> Column:
    p = _col(prob)
    return F.when(p > hi, TREND_UP).when(p < lo, TREND_DOWN).otherwise(TREND_FLAT)


def change_band(col: Column | str, high: float = HIGH_CHANGE) -> Column:
    c = _col(col)
    return (
        F.when(F.abs(c) >= high, "high_change")
        .when(c > 0, "positive")
        .when(c < 0, "negative")
        .when(c == 0, "zero")
    )


def strike_band(col: Column | str, atm: float | Column = 0) -> Column:
    c = _col(col).cast("double")
    return F.when(c == atm, "atm").when(c < atm, "itm").when(c > atm, "otm")


def pattern_marker(col: Column | str, patterns: Mapping[str, str]) -> Column:
    """The marker of the first pattern found in the text, in any case."""
    text = F.lower(_col(col).cast("string"))
    found = [F.when(F.contains(text, F.lit(p.lower())), F.lit(m)) for p, m in patterns.items()]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


# ---- numbers as text --------------------------------------------------------------------


def fixed_point(col: Column | str, places: int = 2) -> Column:
    """Fixed number of decimals, halves to even, no grouping."""
    return F.call_function("format_number", _col(col), F.lit("0." + "0" * places if places else "0"))


def percent_text(col: Column | str, places: int = 1) -> Column:
    return F.concat(fixed_point(_col(col) * 100, places), F.lit("%"))


def timestamp_text(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd HH:mm:ss")


def float_text(col: Column | str) -> Column:
    """A double with the fewest digits that read back the same: plain from 1e-4 up to 1e16,
    with at least one decimal, and as ``1e+16`` or ``1e-05`` outside."""
    x = _col(col).cast("double")
    short = x.cast("string")
    plain = F.regexp_replace(x.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0*$", "$1")
    mantissa = F.regexp_replace(F.substring_index(short, "E", 1), r"\.0$", "")
    power = F.substring_index(short, "E", -1).cast("int")
    scientific = F.concat(
        mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.format_string("%02d", F.abs(power))
    )
    return (
        F.when(F.isnan(x), "nan")
        .when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(~F.contains(short, F.lit("E")), short)
        .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain)
        .otherwise(scientific)
    )


def value_text(col: Column | str, dtype: str) -> Column:
    """A cell as text by its type name (as in ``df.dtypes``)."""
    c = _col(col)
    return float_text(c) if dtype in ("double", "float") else c.cast("string")


def is_numeric(dtype: str) -> bool:
    return dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal")


def render_cell(
    col: Column | str, column: str, dtype: str, rules: Rules | None = None, atm_strike: float = 0
) -> Column:
    """The cell of ``column`` as text, with the marker its rule gives; NULL gives ''."""
    c, text = _col(col), value_text(col, dtype)
    rule = (rules or {}).get(column)
    if rule is None:
        return F.coalesce(text, F.lit(""))
    if is_numeric(dtype):
        defaults = STRIKE_MARKERS if column == "Strike" else CHANGE_MARKERS
        mark = {band: F.lit(rule.get(band, marker) + " ") for band, marker in defaults.items()}
        if column == "Strike":
            band = strike_band(c, float(atm_strike))
            out = (
                F.when(band == "atm", F.concat(mark["atm"], F.lit("<b>"), text, F.lit("</b>")))
                .when(band == "itm", F.concat(mark["itm"], text))
                .otherwise(F.concat(mark["otm"], text))
            )
        else:
            band = change_band(c)
            signed = F.concat(F.when(c > 0, "+").otherwise(""), text)
            out = (
                F.when(band == "high_change", F.concat(mark["high_change"], F.lit("<b><u>"), signed, F.lit("</u></b>")))
                .when(band == "positive", F.concat(mark["positive"], signed))
                .when(band == "negative", F.concat(mark["negative"], signed))
                .otherwise(F.concat(mark["zero"], signed))
            )
    else:
        marker = pattern_marker(c, rule.get("values", {}))
        out = F.coalesce(F.concat(marker, F.lit(" "), text), text)
    return F.when(c.isNull(), "").otherwise(out)


# ---- symbols and column names -------------------------------------------------------------


def option_symbol(col: Column | str) -> Column:
    """Short form of an option symbol: family, five characters before the first CE or PE, side."""
    s = _col(col)

    def family(name: str, short: str) -> Column:
        parts = F.replace(F.replace(s, F.lit("NSE:"), F.lit("")), F.lit(name), F.lit(short))

        def side(code: str) -> Column:
            strike = F.right(F.substring_index(parts, code, 1), F.lit(5))
            return F.when(F.contains(parts, F.lit(code)), F.concat(F.lit(f"{short} "), strike, F.lit(f" {code}")))

        return F.when(F.contains(s, F.lit(name)), F.coalesce(side("CE"), side("PE")))

    cut = F.when(
        F.length(s) > SYMBOL_LENGTH, F.concat(F.substring(s, 1, SYMBOL_LENGTH), F.lit("..."))
    ).otherwise(s)
    bank = F.contains(s, F.lit("BANKNIFTY"))
    return (
        F.when(s.isNull() | s.isin("", "N/A"), s)
        .when(bank, F.coalesce(family("BANKNIFTY", "BN"), cut))
        .otherwise(F.coalesce(family("NIFTY", "NF"), cut))
    )


def change_columns(columns: Sequence[str]) -> list[str]:
    """The change columns of an option table."""
    return [c for c in columns if "OI_" in c and c != "OI_Time"]


def period_label(column: str) -> str:
    return column.replace("OI_", "").replace("m", "min")


# ---- messages -----------------------------------------------------------------------------


def text_parts(col: Column | str, limit: int = MESSAGE_LIMIT) -> Column:
    """The text cut in parts of ``limit`` characters; an empty text is one empty part.

    One pass of a pattern, where repeated ``substring`` would start from the front each time.
    """
    c = _col(col)
    return F.when(c == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(c, F.lit(f"(?s).{{1,{limit}}}"), F.lit(0))
    )


def preview(col: Column | str, length: int = PREVIEW_LENGTH) -> Column:
    return F.concat(F.substring(_col(col), 1, length), F.lit("..."))


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.trim(F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit(""))))


def fill_lines(text: str, values: Mapping[str, Column]) -> Column:
    """A text with ``{name}`` places filled from columns; a NULL shows as N/A."""
    pieces = []
    for part in re.split(r"(\{\w+\})", text):
        name = part[1:-1] if re.fullmatch(r"\{\w+\}", part) else None
        if name:
            pieces.append(F.coalesce(values[name].cast("string"), F.lit("N/A")))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


# ---- commands -----------------------------------------------------------------------------


def is_command(text: Column | str) -> Column:
    return F.coalesce(F.startswith(_col(text), F.lit("/")), F.lit(False))


def words(text: Column | str) -> Column:
    """The parts between white space."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def command_name(text: Column | str) -> Column:
    """First word in lower case, without leading slashes and without what follows ``@``."""
    first = F.lower(F.get(words(text), F.lit(0)))
    return F.substring_index(F.regexp_replace(first, "^/+", ""), "@", 1)


def command_args(text: Column | str) -> Column:
    parts = words(text)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
