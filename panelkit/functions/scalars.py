"""Column expressions (built-in Spark functions only, so they stay inside
whole-stage codegen). ANSI mode stays on: every conversion is a ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.constants import NULL_TOKENS, SESSION_YEAR_OFFSET, VOTE_MAP

# Java regex with (?U): \s covers Unicode white space such as NBSP, like
# Python's str.strip / \s on text.
_STRIP_RE = r"(?U)^\s+|\s+$"
_WS_RE = r"(?U)\s+"
# Strings a lenient numeric parser accepts: decimal or scientific notation,
# inf / infinity / nan, optional sign, surrounding white space. Java-style
# suffixes such as '1d' or '1f' are refused (a plain cast would accept them).
NUMERIC_RE = (r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Strip leading / trailing white space (Unicode aware)."""
    return F.regexp_replace(col(c), _STRIP_RE, "")


def collapse_ws(c) -> Column:
    """Collapse each run of white space into one space."""
    return F.regexp_replace(col(c), _WS_RE, " ")


def norm_key(c) -> Column:
    """Join-key normalisation: text, upper case, stripped."""
    return F.upper(strip(col(c).cast("string")))


def null_tokens(c, tokens=tuple(NULL_TOKENS)) -> Column:
    c = col(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def clean_text(c) -> Column:
    """Strip, collapse white space, turn null tokens into NULL."""
    return null_tokens(collapse_ws(strip(c)))


def is_numeric_text(c) -> Column:
    return col(c).rlike(NUMERIC_RE)


def safe_double(c) -> Column:
    """Text or number -> DOUBLE; unparsable -> NULL; NaN -> NULL."""
    s = strip(col(c).cast("string"))
    v = F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))
    return F.nanvl(v, F.lit(None).cast("double"))


_INT_RE = r"^\s*[+-]?\d+(\.0*)?\s*$"


def safe_int(c) -> Column:
    """Integer-valued text or number -> INT, else NULL (one regex, one cast)."""
    s = col(c).cast("string")
    return F.when(s.rlike(_INT_RE), F.trim(s).try_cast("double").try_cast("int"))


def to_int(df, name: str) -> Column:
    """INT view of a column: a plain cast for numbers, ``safe_int`` for text."""
    from pyspark.sql import types as T
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return c.try_cast("int")
    if isinstance(dt, T.NumericType):
        return F.when(c == F.floor(c), c.try_cast("int"))
    return safe_int(c)


_TIME_RE = r"([T ]\s*\d{1,2}:\d{2}.*)?$"
_HALF_DAY_RE = r"(?i)^[T ]\s*(\d{1,2})(:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*([ap])\.?m\.?\s*$"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_RE = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
             r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
# Date forms after ISO text: (regex, groups of year, month, day, time). 01/02/2003 is 2 January
# in the first form and 1 February in the second.
DATE_FORMS = (
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})" + _TIME_RE, (3, 1, 2, 4)),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})" + _TIME_RE, (3, 2, 1, 4)),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _TIME_RE, (1, 2, 3, 4)),
    (r"^(\d{4})(\d{2})(\d{2})" + _TIME_RE, (1, 2, 3, 4)),
    (r"(?i)^(\d{1,2})[ -]" + _MONTH_RE + r"\.?,?[ -](\d{4})" + _TIME_RE, (3, 2, 1, 4)),
    (r"(?i)^" + _MONTH_RE + r"\.? (\d{1,2}),? (\d{4})" + _TIME_RE, (3, 1, 2, 4)),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{2})" + _TIME_RE, (3, 1, 2, 4)),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{2})" + _TIME_RE, (3, 2, 1, 4)),
)
#: Forms whose order of month and day the text alone doesn't tell.
MONTH_FIRST, DAY_FIRST = (1, 7), (2, 8)
#: Two-digit years from here on are of the 20th century.
CENTURY_FROM = 69


def _time_of_day(t: Column) -> Column:
    """Time text as `` hh:mm...``; 12-hour times become 24-hour ones."""
    hour = F.regexp_extract(t, _HALF_DAY_RE, 1).try_cast("int")
    late = F.when(F.lower(F.regexp_extract(t, _HALF_DAY_RE, 3)) == "p", 12).otherwise(0)
    half = F.concat(F.lit(" "), (hour % 12 + late).cast("string"), F.regexp_extract(t, _HALF_DAY_RE, 2))
    return F.when(t.rlike(_HALF_DAY_RE) & hour.between(1, 12), half).otherwise(F.regexp_replace(t, r"^[T ]\s*", " "))


def read_date(c, form: int, kind: str) -> Column:
    """Text -> ``kind`` under one form: 0 is ISO, i is ``DATE_FORMS[i - 1]``; NULL if it isn't of that form."""
    s = strip(col(c).cast("string"))
    if form == 0:
        return s.try_cast(kind)
    rx, (y, m, d, t) = DATE_FORMS[form - 1]
    month, year = F.regexp_extract(s, rx, m), F.regexp_extract(s, rx, y)
    if _MONTH_RE in rx:
        names = F.array(*[F.lit(x) for x in _MONTHS])
        month = F.array_position(names, F.lower(F.substring(month, 1, 3))).cast("string")
    year = F.when(F.length(year) == 2, F.concat(F.when(year >= f"{CENTURY_FROM}", "19").otherwise("20"), year)).otherwise(year)
    iso = F.concat(F.concat_ws("-", year, month, F.regexp_extract(s, rx, d)), _time_of_day(F.regexp_extract(s, rx, t)))
    return F.when(s.rlike(rx), F.trim(iso).try_cast(kind))


def parse_date(c, kind: str, day_first: bool | None = None) -> Column:
    """Text (or a date / timestamp) -> ``kind``: ISO, else the first of ``DATE_FORMS`` that gives a
    date, else NULL. With ``day_first`` given, the forms of the other order are left out."""
    other = () if day_first is None else MONTH_FIRST if day_first else DAY_FIRST
    return F.coalesce(*[read_date(c, i, kind) for i in range(len(DATE_FORMS) + 1) if i not in other])


def year_from_date(c, day_first: bool | None = None) -> Column:
    """Date text of a known form (or a date / timestamp) -> year INT."""
    return F.year(parse_date(c, "date", day_first))


def year_from_session(c) -> Column:
    return F.lit(SESSION_YEAR_OFFSET) + safe_int(c)


def encode_target(c) -> Column:
    """Outcome text -> 1 (yes) / 0 (anything else, also NULL).

    A numeric target arrives as e.g. ``1.0``; the trailing ``.0`` is removed
    before the lookup so it maps like ``1``.
    """
    s = F.upper(strip(col(c).cast("string")))
    s = F.regexp_replace(s, r"^([+-]?\d+)\.0+$", "$1")
    m = F.create_map(*[x for k, v in VOTE_MAP.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[s], F.lit(0)).cast("int")


def pct(a, b) -> Column:
    """100 * a / b with 0 on a zero or NULL denominator."""
    return F.coalesce(F.try_divide(col(a) * 100.0, col(b)), F.lit(0.0))


def truncate_label(c, n: int = 40) -> Column:
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def is_inf(c) -> Column:
    return F.abs(col(c)) == F.lit(float("inf"))


def clip(c, lo, hi) -> Column:
    """Clip keeping NULL as NULL (greatest / least skip NULL arguments)."""
    c = col(c)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.least(c, hi), lo))


def is_alpha(c, n: int | None = None) -> Column:
    rep = "+" if n is None else "{%d}" % n
    return col(c).rlike(r"^\p{L}" + rep + "$")


def present(df, c: str) -> Column:
    """The column with NaN as NULL, whatever its type."""
    x = F.col(f"`{c}`")
    return F.when(~F.isnan(x), x) if df.schema[c].dataType.typeName() in ("double", "float") else x


def nan_to_null(c) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def share(part, whole) -> Column:
    """part / whole as DOUBLE, as SQL without ANSI errors divides: 0 / 0 is NaN, another part of 0 infinite."""
    a, b = col(part).cast("double"), col(whole).cast("double")
    of_nothing = F.when(a == 0, F.lit(float("nan"))).otherwise(a * F.lit(float("inf")))
    return F.when(b == 0, of_nothing).otherwise(a / b)


def finite(c) -> Column:
    """DOUBLE; NaN and infinite -> NULL."""
    return F.when(F.abs(col(c)) < float("inf"), col(c))


def order_key(c) -> Column:
    """The order-preserving 64-bit image of a DOUBLE: the bits of |x|, negated below 0.

    NULL and NaN give NULL; -0.0 is 0. Powers of two scale exactly, so the exponent and the 52
    bits of the fraction come out of plain arithmetic."""
    x = nan_to_null(col(c).cast("double"))
    a = F.abs(x)
    guess = F.floor(F.log2(a))
    # log2 may round over a power of two
    e = (guess - (a < F.pow(F.lit(2.0), guess)).cast("long") + (a >= F.pow(F.lit(2.0), guess + 1)).cast("long"))
    normal = F.shiftleft(e + 1023, 52) + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0 ** 52)).cast("long")
    tiny = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    bits = (F.when(a == 0, F.lit(0).cast("long")).when(a == F.lit(float("inf")), F.lit(2047 << 52).cast("long"))
            .when(a < F.lit(2.0 ** -1022), tiny).otherwise(normal))
    return F.when(x < 0, -bits).otherwise(bits)


def to_order_key(value: float) -> int:
    """The order key of a DOUBLE (a Python number)."""
    import struct
    bits = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -bits if value < 0 else bits


def from_order_key(key: int) -> float:
    """The DOUBLE of an order key (a Python number)."""
    import struct
    value = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -value if key < 0 else value
