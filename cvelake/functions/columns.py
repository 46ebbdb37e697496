"""Column-level building blocks (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# CPE 2.3 formatted-string field positions and the "any" /
# "not applicable" sentinels; the CVE identifier pattern.
CPE_VENDOR, CPE_PRODUCT, CPE_VERSION = 3, 4, 5
CPE_SENTINELS = ("*", "-", "")
CVE_ID_PATTERN = "^CVE-[0-9]{4}-[0-9]+$"
CVE_ID_FIND = "(?i)CVE-[0-9]{4}-[0-9]+"


def null_sentinel(c: Column) -> Column:
    """``*``, ``-`` and the empty string mean "no value"."""
    return F.when(c.isin(*CPE_SENTINELS), F.lit(None)).otherwise(c)


def cpe_parts(uri: Column, escape_aware: bool = False) -> Column:
    """Split a CPE URI on ``:``. The default is the naive split (an escaped
    ``\\:`` splits too); ``escape_aware`` keeps escaped colons inside a field."""
    return F.split(uri, r"(?<!\\):" if escape_aware else ":")


def cpe_field(parts: Column, index: int) -> Column:
    """Field ``index`` of a split URI, NULL when the URI is too short."""
    return null_sentinel(F.get(parts, index))


def first_value(arr: Column, lang: str = "en") -> Column:
    """``value`` of the first ``{lang, value}`` element in ``lang``, else NULL."""
    return F.get(F.filter(arr, lambda x: x["lang"] == lang), 0)["value"]


# The risk score bands, in order (base + EPSS x weight, taken
# when EPSS is above the floor; KEV entries always take the first band), the
# CVSS multiplier for everything else, and the tier thresholds.
KEV_BAND = (90.0, 10)
EPSS_BANDS = ((0.5, 70.0, 20), (0.1, 40.0, 50))  # (EPSS above, base, weight)
CVSS_WEIGHT = 4
TIERS = ((90, "CRITICAL"), (70, "HIGH"), (40, "MEDIUM"))  # else LOW


def risk_score(kev_flag: Column, epss: Column, cvss_v3: Column) -> Column:
    """0-100 priority score: KEV first, then EPSS bands, then CVSS v3.

    NULL EPSS counts as 0 and a NULL CVSS score as 0.
    """
    e = F.coalesce(epss, F.lit(0.0))
    out = F.when(F.coalesce(kev_flag, F.lit(False)), F.lit(KEV_BAND[0]) + e * KEV_BAND[1])
    for floor, base, weight in EPSS_BANDS:
        out = out.when(e > floor, F.lit(base) + e * weight)
    return out.otherwise(F.coalesce(cvss_v3, F.lit(0.0)) * CVSS_WEIGHT)


def risk_tier(score: Column) -> Column:
    out = None
    for threshold, name in TIERS:
        out = F.when(score >= threshold, name) if out is None else out.when(score >= threshold, name)
    return out.otherwise("LOW")


def labelled(label: str, c: Column) -> Column:
    """``label + c`` when ``c`` is non-empty, else NULL (skipped by concat_ws)."""
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit(label), c))


def pipe_joined(values: Column) -> Column:
    """Distinct values of a collected column, sorted, joined by `` | ``."""
    return F.concat_ws(" | ", F.array_sort(F.array_distinct(values)))


def truncate_text(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def exact_mean(c: Column, scale: int = 1_000_000) -> Column:
    """Mean of a score, summed exactly in millionths as a decimal: the result does
    not depend on summation order, and the sum can't overflow."""
    units = F.sum(F.round(c * scale).cast("decimal(20,0)"))
    return units.cast("double") / F.count(c) / scale
