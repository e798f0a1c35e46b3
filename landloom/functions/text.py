"""Text, number and key helpers as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Roman numeral symbols for thousands, hundreds, tens, ones.
ROMAN_DIGITS = [
    ["", "M", "MM", "MMM"],
    ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"],
    ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"],
    ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"],
]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: Column | str) -> Column:
    """Integer value, null when the text is no integer."""
    return F.trim(col(c).cast("string")).try_cast("int")


def pad_number(n: Column | str, width: int) -> Column:
    """Zero-padded digits; ``#`` signs when the number is too wide."""
    n = col(n)
    text = F.format_string(f"%0{width}d", F.abs(n).cast("long"))
    body = F.when(F.length(text) > width, F.lit("#" * width)).otherwise(text)
    return F.when(n.isNotNull(), F.concat(F.when(n < 0, "-").otherwise(""), body))


def roman(n: Column | str) -> Column:
    """Roman numeral for 1..3999, otherwise null."""
    n = col(n).cast("int")
    parts = [
        F.element_at(F.array(*[F.lit(s) for s in digits]),
                     (F.floor(n / F.lit(base)) % 10).cast("int") + 1)
        for digits, base in zip(ROMAN_DIGITS, (1000, 100, 10, 1))
    ]
    return F.when(n.between(1, 3999), F.concat(*parts))


def plain_number(c: Column | str) -> Column:
    """Up to nine decimals without trailing zeros."""
    text = F.round(col(c).cast("decimal(38,12)"), 9).cast("decimal(38,9)").cast("string")
    text = F.regexp_replace(text, r"(\.\d*[1-9])0+$", "$1")
    return F.regexp_replace(text, r"\.0+$", "")


def truncate_dots(c: Column | str, limit: int) -> Column:
    """Trimmed text of at most ``limit`` characters, marked with dots when cut."""
    s = F.trim(col(c))
    cut = F.concat(F.substring(s, 1, limit - 3), F.lit("...")) if limit > 3 else F.substring(s, 1, limit)
    return F.when(F.length(s) > limit, cut).otherwise(s)


def capped_list(c: Column | str, limit: int = 196) -> Column:
    """Joined text; beyond ``limit`` characters the rest becomes `` ...``."""
    s = col(c)
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit), F.lit(" ..."))).otherwise(s)


def append_line(a: Column | str, b: Column | str) -> Column:
    """Append ``b`` on a new line; no second line break after an empty or ended text."""
    a, b = col(a), col(b)
    head = F.when((a == "") | a.endswith("\n"), a).otherwise(F.coalesce(F.concat(a, F.lit("\n")), F.lit("")))
    return F.concat(head, F.coalesce(b, F.lit("")))


def unescape_newlines(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("\\n"), F.lit("\n"))


def quoted(c: Column | str) -> Column:
    return F.concat(F.lit('"'), col(c), F.lit('"'))


def bracketed(c: Column | str) -> Column:
    return F.concat(F.lit("("), col(c), F.lit(")"))


def squeeze_spaces(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\s\s+", " ")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def half_even_int(c: Column | str) -> Column:
    """Double to integer, ties to the even neighbour."""
    return F.rint(col(c).cast("double")).cast("long")


def half_away_int(c: Column | str) -> Column:
    """Decimal to integer, ties away from zero."""
    return F.round(col(c), 0).cast("long")


def hex_key(c: Column | str) -> Column:
    return F.lower(F.hex(col(c).cast("long")))


def version_begin(feature_id: Column | str) -> Column:
    """ISO begin text from the 16 characters behind a 16-character id."""
    f = col(feature_id)
    cut = lambda pos, n: F.substring(f, pos, n)
    return F.concat(cut(17, 4), F.lit("-"), cut(21, 2), F.lit("-"), cut(23, 2), F.lit("T"),
                    cut(26, 2), F.lit(":"), cut(28, 2), F.lit(":"), cut(30, 2), F.lit("Z"))


def compact_time(iso: Column | str) -> Column:
    """``2024-01-01T00:00:07Z`` to ``20240101T000007Z``."""
    return F.translate(col(iso), "-:", "")


def delivery_time(c: Column | str) -> Column:
    """Delivery timestamp with or without a fraction, as seconds text."""
    return F.regexp_extract(F.trim(col(c)), r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(\.\d+)?Z$", 1)


def municipality_key(land, region, county, municipality) -> Column:
    """Two digits state, region as it is, two digits county, three digits municipality."""
    return F.concat(pad_number(safe_int(land), 2), col(region),
                    pad_number(safe_int(county), 2), pad_number(safe_int(municipality), 3))


def catalogue_key(land, region, county, municipality, place) -> Column:
    """Key into the street catalogue; a missing region counts as 0."""
    return F.concat(municipality_key(land, F.coalesce(col(region), F.lit("0")), county, municipality), col(place))


def district_key(land, number) -> Column:
    return F.concat(pad_number(safe_int(land), 2), pad_number(safe_int(number), 4))


def sheet_key(land, district, number) -> Column:
    return F.concat(district_key(land, district), F.lit("-"), F.trim(col(number)))


def parcel_number(gml_id="gml_id", counter="zaehler", denominator="nenner",
                  code="flurstueckskennzeichen") -> Column:
    """Counter/denominator text; widths depend on the state in the id."""
    state = F.substring(col(gml_id), 3, 2)
    count, below = safe_int(counter), safe_int(denominator)
    below0 = F.coalesce(below, F.lit(0))
    slash = F.lit("/")
    return (
        F.when(state == "SL", F.concat(pad_number(count, 4), slash, pad_number(below0, 4)))
        .when(state == "TH", F.concat(pad_number(count, 5), slash, pad_number(below0, 4)))
        .when(state == "SN", F.concat(pad_number(count, 5), slash, F.substring(col(code), 15, 4)))
        .otherwise(F.concat(pad_number(count, 5), slash, pad_number(below0 % 1000, 3)))
    )


def parcel_key(land="land", district="gemarkungsnummer", section="flurnummer", **kw) -> Column:
    """``SSDDDD-FFF-number`` key of a parcel."""
    dash = F.lit("-")
    return F.concat(district_key(land, district), dash,
                    pad_number(F.coalesce(safe_int(section), F.lit(0)), 3), dash, parcel_number(**kw))


def code_to_key(code: Column | str) -> Column:
    """Parcel key from the fixed-width parcel code (6/3/5/3 characters)."""
    c = col(code)
    below = F.coalesce(F.nullif(F.substring(c, 15, 3), F.lit("___")), F.lit("000"))
    return F.concat(F.substring(c, 1, 6), F.lit("-"), F.substring(c, 7, 3), F.lit("-"),
                    F.substring(c, 10, 5), F.lit("/"), below)


def coordinate_text(x: Column, y: Column) -> Column:
    """Both coordinates times ten as eight digits."""
    return F.concat_ws(" ", pad_number(half_even_int(x * 10), 8), pad_number(half_even_int(y * 10), 8))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
