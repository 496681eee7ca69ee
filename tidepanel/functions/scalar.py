"""Scalar expressions: tickers, dates, powers, clipping and the inverse normal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange code of a vendor ticker -> ISO country code.
COUNTRY_CODES = {
    "AU": "AU", "AV": "AT", "BB": "BE", "BZ": "BR", "CA": "CA", "CB": "CO", "CH": "CN",
    "CI": "CL", "CN": "CA", "CP": "CZ", "DC": "DK", "EY": "EG", "FH": "FI", "FP": "FR",
    "GA": "GR", "GR": "DE", "GY": "DE", "HB": "HU", "HK": "HK", "ID": "IE", "IJ": "ID",
    "IM": "IT", "IN": "IN", "IT": "IL", "JP": "JP", "KS": "KR", "LN": "GB", "MF": "MX",
    "MK": "MY", "NA": "NL", "NO": "NO", "NZ": "NZ", "PE": "PE", "PL": "PT", "PM": "PH",
    "PW": "PL", "QD": "QA", "RM": "RU", "SJ": "ZA", "SM": "ES", "SP": "SG", "SS": "SE",
    "SW": "CH", "TB": "TH", "TI": "TR", "TT": "TW", "UH": "AE", "US": "US", "UQ": "US",
}

# Wichura (1988), algorithm AS 241, PPND16. Highest power first.
CENTRAL_TOP = (
    2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
    4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
    1.3314166789178437745e2, 3.3871328727963666080e0,
)
CENTRAL_BOTTOM = (
    5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
    2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
    4.2313330701600911252e1, 1.0,
)
MIDDLE_TOP = (
    7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
    1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
    4.63033784615654529590e0, 1.42343711074968357734e0,
)
MIDDLE_BOTTOM = (
    1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
    1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
    2.05319162663775882187e0, 1.0,
)
TAIL_TOP = (
    2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
    2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
    5.46378491116411436990e0, 6.65790464350110377720e0,
)
TAIL_BOTTOM = (
    2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
    7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
    5.99832206555887937690e-1, 1.0,
)


def canonical_ticker(vendor: Column) -> Column:
    """First token and mapped last token; null for fewer than two tokens or an unknown country."""
    tokens = F.split(F.trim(vendor), r"\s+")
    codes = F.create_map(*[F.lit(x) for pair in COUNTRY_CODES.items() for x in pair])
    country = F.try_element_at(codes, F.element_at(tokens, -1))
    named = F.concat(F.element_at(tokens, 1), F.lit(" "), country)
    return F.when(F.size(tokens) >= 2, named)


def country_token(vendor: Column) -> Column:
    """Second token when split at single blanks."""
    return F.get(F.split(vendor, " "), F.lit(1))


def quote_symbol(symbol: Column, suffix: str = "-USD") -> Column:
    return F.concat(F.upper(symbol), F.lit(suffix))


def signed_power(x: Column, exponent: float = 1.5) -> Column:
    return F.signum(x) * F.pow(F.abs(x), F.lit(exponent))


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    start = F.lit(coefficients[0])
    return reduce(lambda total, c: total * x + F.lit(c), coefficients[1:], start)


def _ratio(x: Column, top: Sequence[float], bottom: Sequence[float]) -> Column:
    return _polynomial(x, top) / _polynomial(x, bottom)


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal for p strictly inside (0, 1), else null."""
    q = p - 0.5
    inner = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    near, far = r - 1.6, r - 5.0
    outer = F.when(r <= 5.0, _ratio(near, MIDDLE_TOP, MIDDLE_BOTTOM)).otherwise(
        _ratio(far, TAIL_TOP, TAIL_BOTTOM)
    )
    central = q * _ratio(inner, CENTRAL_TOP, CENTRAL_BOTTOM)
    value = F.when(F.abs(q) <= 0.425, central).otherwise(F.signum(q) * outer)
    return F.when((p > 0) & (p < 1), value)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def rescale(rank: Column, low: float = 0.001, high: float = 0.999) -> Column:
    return rank * F.lit(high - low) + F.lit(low)


def guarded_ratio(a: Column, b: Column, missing: bool = False, infinite: bool = False) -> Column:
    """a / b with a zero denominator read as 1e-8; optionally also a missing or infinite one."""
    tiny = F.lit(1e-8)
    floor = F.when(b == 0, tiny)
    if infinite:
        floor = floor.when(F.abs(b) == F.lit(float("inf")), tiny)
    if missing:
        floor = floor.when(b.isNull(), tiny)
    return a / floor.otherwise(b)


def compact_date(c: Column) -> Column:
    """Date from an int or string yyyyMMdd."""
    return F.to_date(c.cast("string"), "yyyyMMdd")


def iso_date(c: Column) -> Column:
    return F.to_date(c, "yyyy-MM-dd")


def date_number(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def mean_of(columns: Sequence[Column]) -> Column:
    return sum(columns[1:], columns[0]) / len(columns)
