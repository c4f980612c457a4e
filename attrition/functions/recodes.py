"""Column expressions for the conditional recodes (all JVM-side `when` chains)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attrition.functions import values as V


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_id(c: Column | str) -> Column:
    """Not null and not one of the all-zero sentinel ids."""
    c = _c(c)
    return c.isNotNull() & ~c.isin(*V.SENTINEL_IDS)


def age_band(birth: Column | str, today: Column | str) -> Column:
    """Age band from a birth date; a null birth date falls into the last band."""
    age = F.floor(F.datediff(_c(today), _c(birth)) / V.DAYS_PER_YEAR)
    out = None
    for upper, label in V.AGE_BANDS:
        out = F.when(age <= upper, label) if out is None else out.when(age <= upper, label)
    return out.otherwise(V.AGE_BAND_ELSE)


def attribution_channel(c: Column | str) -> Column:
    """Keep the organic / acquisition groupings, everything else (and null) is 'Outros'."""
    c = _c(c)
    out = None
    for kept in V.KEPT_GROUPINGS:
        label = F.lit(V.GROUPING_RENAMES.get(kept, kept))
        out = F.when(c == kept, label) if out is None else out.when(c == kept, label)
    return out.otherwise(V.OTHER_LABEL)


def media_source(c: Column | str, sources=V.MEDIA_SOURCES) -> Column:
    c = _c(c)
    return F.when(c.isNull(), V.NULL_SOURCE_LABEL).when(c.isin(*sources), c).otherwise(V.OTHER_LABEL)


def daypart_flags(hour: Column | str) -> dict[str, Column]:
    """Four 0/1 int flags; a null hour gives 0 everywhere."""
    h = _c(hour)
    flags = {}
    for name, low, high, inclusive in V.DAYPARTS:
        upper = (h <= high) if inclusive else (h < high)
        flags[name] = F.when((h >= low) & upper, 1).otherwise(0)
    return flags


def dimension_value(dim: Column, index: int) -> Column:
    """Value of an exploded {index, value} element when it has `index` and is non-empty."""
    return F.when((dim["index"] == index) & (dim["value"] != ""), dim["value"])


def first_dimension(arr: Column | str, index: int) -> Column:
    """First value with the given index in an array<struct<index,value>>; null if none."""
    found = F.filter(_c(arr), lambda x: x["index"] == index)
    return F.get(F.transform(found, lambda x: x["value"]), 0)


def login_flag(value: Column | str) -> Column:
    return F.when(_c(value) == V.LOGGED_IN_VALUE, 1)


def whitelist(c: Column | str, allowed) -> Column:
    """The value when it is listed, else null."""
    c = _c(c)
    return F.when(c.isin(*allowed), c)


def product_class(dept: Column | str, fix_tail: bool = False) -> Column:
    """core / calda / null.

    Default reproduces the upstream rule: a department that is *not* in the
    tail list is 'calda' and a listed tail department is null. ``fix_tail``
    swaps that to the evident intent.
    """
    d = _c(dept)
    tail = d.isin(*V.TAIL_PRODUCTS) if fix_tail else ~d.isin(*V.TAIL_PRODUCTS)
    return F.when(d.isin(*V.CORE_PRODUCTS), V.CORE_LABEL).when(tail, V.TAIL_LABEL)


def region_bucket(region: Column | str, fix_region: bool = False) -> Column:
    r = _c(region)
    out = None
    for label, states in V.REGION_BUCKETS:
        out = F.when(r.isin(*states), label) if out is None else out.when(r.isin(*states), label)
    pattern = V.NORDESTE_PATTERN_FIXED if fix_region else V.NORDESTE_PATTERN
    return out.when(r.like(pattern), V.NORDESTE)


def channel_latency0(is_first: Column, grouping: Column | str, true_direct: Column | str,
                     channel: Column | str) -> Column:
    """First visit -> 'install : <grouping>'; true-direct -> 'Direto'; else the channel."""
    direct = _c(true_direct).cast("string") == "true"
    return (F.when(is_first, F.concat(F.lit(V.INSTALL_CHANNEL_PREFIX), _c(grouping)))
            .when(direct, F.lit(V.DIRECT_LABEL))
            .otherwise(_c(channel)))


def action_recode(c: Column | str) -> Column:
    c = _c(c)
    return (F.when(c == V.DELIVERY_ERROR_EVENT, V.DELIVERY_ERROR_LABEL)
            .when(c.isin(*V.LOGIN_ACTIONS), V.LOGIN_ACTION_LABEL)
            .otherwise(c))


def sex_normalise(c: Column | str) -> Column:
    c = _c(c)
    return (F.when(c.isin(*V.SEX_MALE), "M")
            .when(c.isin(*V.SEX_FEMALE), "F")
            .otherwise(V.MISSING_LABEL))


def channel_bucket(c: Column | str) -> Column:
    c = _c(c)
    return (F.when(c.like(V.INSTALL_CHANNEL_PATTERN), c)
            .when(c.isin(*V.KEPT_CHANNELS), c)
            .otherwise(V.OTHER_CHANNELS_LABEL))
