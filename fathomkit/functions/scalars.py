"""Column helpers shared by batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing entry.
SENTINELS = ("(null)", "#N/A", "")

# Month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Offence text per crime group; everything else is "Other".
CRIME_GROUPS = {
    "Weapon": ("CPW", "POSSESSION OF WEAPON"),
    "Property/Theft": (
        "ROBBERY", "BURGLARY", "GRAND LARCENY AUTO", "GRAND LARCENY", "PETIT LARCENY",
    ),
    "Violence": ("ASSAULT", "CRIMINAL MISCHIEF"),
    "Trespass": ("CRIMINAL TRESPASS",),
}

# Race text to group label; everything else is "Other".
RACE_GROUPS = {
    "BLACK": "Black",
    "WHITE HISPANIC": "White Hispanic",
    "BLACK HISPANIC": "Black Hispanic",
    "WHITE": "White",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rd(c: Column | str, digits: int) -> Column:
    """Round half up after dropping float noise below 1e-9."""
    return F.round(F.round(_col(c), 9), digits)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, for a zero denominator."""
    return F.try_divide(top, bottom)


def sentinel_to_null(c: Column | str, sentinels: Sequence[str] = SENTINELS) -> Column:
    c = _col(c)
    return F.when(~c.isin(*sentinels), c)


def yes_flag(c: Column | str, yes: str = "Y") -> Column:
    """1 where the text equals ``yes``; anything else, null included, is 0."""
    return F.coalesce(_col(c) == yes, F.lit(False)).cast("byte")


def contains_flag(c: Column | str, needle: str) -> Column:
    return F.coalesce(F.contains(_col(c), F.lit(needle)), F.lit(False)).cast("byte")


def to_number(c: Column | str) -> Column:
    """Numeric value of a text; unreadable text is null."""
    return _col(c).try_cast("double")


def recode(c: Column | str, mapping: Mapping[str, str], default: str | None = "Other") -> Column:
    c, out = _col(c), None
    for source, target in mapping.items():
        out = (F if out is None else out).when(c == source, target)
    return out.otherwise(default)


def bucket_recode(
    c: Column | str, buckets: Mapping[str, Sequence[str]], default: str = "Other"
) -> Column:
    c, out = _col(c), None
    for label, members in buckets.items():
        out = (F if out is None else out).when(c.isin(*members), label)
    return out.otherwise(default)


def month_number(c: Column | str, months: Sequence[str] = MONTHS) -> Column:
    """1-based month of a month name; unknown names are null."""
    table = F.create_map(*[F.lit(x) for i, m in enumerate(months, 1) for x in (m, i)])
    return F.try_element_at(table, _col(c))


def season(month: Column | str) -> Column:
    m = _col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def threshold_label(c: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first step whose bound the value reaches."""
    out = None
    for bound, label in steps:
        out = (F if out is None else out).when(c >= bound, label)
    return out.otherwise(default)


# The texts of the skew classes, and the skewness from which on a distribution counts as skewed.
SKEW_TEXTS = {
    "right": "right-skewed (positive tail)", "none": "approximately normal (symmetric)",
    "left": "left-skewed (negative tail)",
}
SKEW_BOUND = 0.5


def skew_label(skew: Column, bound: float = SKEW_BOUND, texts: Mapping[str, str] = SKEW_TEXTS) -> Column:
    """Class of a skewness; strictly inside the bounds it is symmetric."""
    inside = float(np.nextafter(-bound, 0.0))
    return threshold_label(skew, [(bound, texts["right"]), (inside, texts["none"])], texts["left"])


def shorten(c: Column | str, n: int) -> Column:
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("."))).otherwise(c)


def day_first_date(c: Column | str) -> Column:
    """Date of a d/m/y text; invalid text is null."""
    return F.expr("try_to_date({}, 'd/M/yyyy')".format(c)) if isinstance(c, str) else (
        F.try_to_date(c, "d/M/yyyy")
    )


def swap_day_month(d: Column) -> Column:
    """Undo a swapped day and month; a date that cannot be swapped stays."""
    swapped = F.try_make_timestamp(
        F.year(d), F.dayofmonth(d), F.month(d), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")
    return F.coalesce(swapped, d)


def month_first_date(c: Column) -> Column:
    return F.try_to_date(c, "M/d/yyyy")


def clock_text(c: Column, fmt: str = "h:mm:ss a") -> Column:
    """``HH:mm`` of a time-of-day text; unreadable text is kept."""
    parsed = F.coalesce(F.try_to_timestamp(c, F.lit("H:mm:ss")), F.try_to_timestamp(c, F.lit(fmt)))
    return F.coalesce(F.date_format(parsed, "HH:mm"), c)


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def bernoulli_loglik(y: Column, eta: Column) -> Column:
    return y * eta - softplus(eta)


def key_bucket(keys: Sequence[Column], buckets: int, seed: int) -> Column:
    """Repeatable pseudo-random bucket of a row, taken from its key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets))


def key_uniform(keys: Sequence[Column], seed: int) -> Column:
    """Repeatable uniform number in [0, 1) of a row, taken from its key."""
    return key_bucket(keys, 1 << 52, seed) / F.lit(float(1 << 52))


# Wichura's rational approximations of the normal quantile (AS 241), numerator
# and denominator per region, highest power first.
_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_TAIL = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _rational(region, x: Column) -> Column:
    top, bottom = (F.lit(cs[0]) for cs in region)
    for a, b in zip(*(cs[1:] for cs in region)):
        top, bottom = top * x + a, bottom * x + b
    return top / bottom


# Cody's rational approximations of the error function (1969), numerator and denominator per region, highest
# power first: erf(x) / x in x^2 up to 0.46875, exp(x^2) erfc(x) up to 4, and its expansion in 1 / x^2 beyond.
_ERF = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2,
     3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
_ERFC = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1,
     2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3,
     1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
_ERFC_FAR = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
     1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2,
     2.33520497626869185e-3),
)


def log_normal_cdf(z: Column) -> Column:
    """Logarithm of the standard normal distribution function, to a relative error of about 1e-14 of the function, also
    where the function itself underflows."""
    x = F.abs(z) / 2 ** 0.5
    far = 1 / (x * x)
    scaled = F.when(x <= 4, _rational(_ERFC, x)).otherwise(
        (1 / np.pi ** 0.5 - far * _rational(_ERFC_FAR, far)) / x)  # exp(x^2) erfc(x)
    near = z / 2 ** 0.5 * _rational(_ERF, x * x)
    tail = F.when(z < 0, F.log(scaled / 2) - x * x).otherwise(F.log1p(-scaled * F.exp(-x * x) / 2))
    return F.when(x <= 0.46875, F.log((1 + near) / 2)).otherwise(tail)


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, for 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(r <= 5, _rational(_TAIL, r - 1.6)).otherwise(_rational(_FAR, r - 5))
    return F.when(F.abs(q) <= 0.425, q * _rational(_CENTRE, 0.180625 - q * q)).otherwise(F.sign(q) * outer)
