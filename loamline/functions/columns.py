"""Column expressions shared by the operators: all are built-in functions, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "(unknown)"
CORPORATE = "@corp.example"


def email_bucket(email: Column) -> Column:
    """NULL addresses share one bucket."""
    return F.coalesce(email, F.lit(UNKNOWN))


def is_corporate(email: Column, suffix: str = CORPORATE) -> Column:
    return email.endswith(suffix)


def prefer_corporate(a: Column, b: Column, suffix: str = CORPORATE) -> Column:
    """Whichever is corporate, ``a`` first; else the first that is there."""
    return F.when(is_corporate(a, suffix), a).when(is_corporate(b, suffix), b).otherwise(F.coalesce(a, b))


def preferred(email: Column, suffix: str = CORPORATE) -> Column:
    """Aggregate: the smallest corporate address, else the smallest address."""
    return F.min(F.when(email.isNotNull(), F.struct(F.when(is_corporate(email, suffix), 0).otherwise(1), email.alias("email"))))["email"]


def latest(value: Column, time: Column) -> Column:
    """Aggregate: the non-null value of the latest time, the largest of ties."""
    return F.max(F.when(value.isNotNull(), F.struct(time, value.alias("v"))))["v"]


def earliest(value: Column, time: Column) -> Column:
    """Aggregate: the non-null value of the earliest time, the smallest of ties."""
    return F.min(F.when(value.isNotNull(), F.struct(time, value.alias("v"))))["v"]


def normalize_email(email: Column) -> Column:
    """Trimmed, lower case, empty as NULL."""
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def model_family(model: Column, families: tuple[str, ...] = ("large", "medium", "small")) -> Column:
    out = F
    for f in families:
        out = out.when(F.lower(model).contains(f), f)
    return out.otherwise("other")


def model_version(model: Column, vendor: str = "acme", families: tuple[str, ...] = ("large", "medium", "small")) -> Column:
    """The id without its context suffix and its vendor and family prefix."""
    return F.regexp_replace(F.regexp_replace(model, r"\[1m\]$", ""), f"(?i)^{vendor}-({'|'.join(families)})-", "")


def is_long_context(model: Column) -> Column:
    return model.contains("[1m]")


def slug(label: Column) -> Column:
    return F.regexp_replace(label, "[ .:]", "_")


def tier(raw: Column, prefix: str = "Product ") -> Column:
    """A tier label without the product's name; blank as NULL."""
    return F.nullif(F.trim(F.regexp_replace(raw, f"^{prefix}", "")), F.lit(""))


def value_kind(kind: Column, temporality: Column) -> Column:
    """gauge_last, hist_sum, sum_delta or sum_cumulative; only sum_delta adds up."""
    delta = temporality.isin("1", "AGGREGATION_TEMPORALITY_DELTA")
    return F.when(kind == "gauge", "gauge_last").when(kind == "histogram", "hist_sum").when((kind == "sum") & delta, "sum_delta").otherwise("sum_cumulative")


def first_truthy(attrs: Column, keys: list[str]) -> Column:
    """The first attribute that is there and is not empty, 0 or false."""
    one = lambda k: F.when(~F.lower(F.element_at(attrs, k)).isin("", "0", "false", "0.0"), F.element_at(attrs, k))
    return F.coalesce(*[one(k) for k in keys])


def to_bool(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("true", "t", "1", "yes")


def parse_date(text: Column) -> Column:
    """ISO or month/day/year; blank and anything else NULL."""
    iso = F.try_to_date(F.nullif(F.trim(text), F.lit("")), "yyyy-MM-dd")
    return F.coalesce(iso, F.try_to_date(F.nullif(F.trim(text), F.lit("")), "M/d/yyyy"))


def as_of_from_path(path: Column) -> Column:
    """The single distinct valid eight-digit date in a file name, else NULL."""
    runs = F.regexp_extract_all(path, F.lit(r"(?<![0-9])([0-9]{8})(?![0-9])"), 1)
    dates = F.array_distinct(F.filter(F.transform(runs, lambda x: F.try_to_date(x, "yyyyMMdd")), lambda d: d.isNotNull()))
    return F.when(F.size(dates) == 1, F.get(dates, F.lit(0)))
