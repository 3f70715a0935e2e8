"""Column expressions shared by the operators. All JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- price per GPU-hour (P1) ------------------------------------------------

def price_per_gpu_hour(price="price_per_hour", gpus="gpu_count") -> Column:
    """Record form: 0.0 when there is no GPU, else price / count."""
    return F.when(_c(gpus) > 0, _c(price) / _c(gpus)).otherwise(F.lit(0.0))


def ppgh(price="price_per_hour", gpus="gpu_count") -> Column:
    """SQL form: plain division, NULL (not an ANSI error) on a zero count."""
    return F.try_divide(_c(price), _c(gpus))


# ---- quality tags (P2a, P2b, P2c): three rules, kept apart on purpose (D1) --

def quality_at_ingest(gpu_name="gpu_type", gpu_memory="gpu_memory_gb") -> Column:
    """Tag given while normalising raw items: memory 0 counts as missing."""
    name, mem = _c(gpu_name), _c(gpu_memory)
    return (F.when(name.isNull() | (name == "") | (name == "Unknown"), "unknown_gpu")
             .when(mem.isNull() | (mem == 0), "missing_memory")
             .otherwise("ok"))


def quality_view(gpu_count="gpu_count", gpu_type="gpu_type", gpu_memory="gpu_memory_gb") -> Column:
    """Tag synthesized by the canonical view for rows that carry none.

    A NULL gpu_count matches no branch about CPUs and falls through.
    """
    return (F.when(_c(gpu_count) <= 0, "cpu_only")
             .when(_c(gpu_type) == "Unknown", "unknown_gpu")
             .when(_c(gpu_memory).isNull(), "missing_memory")
             .otherwise("ok"))


def quality_backfill(gpu_count="gpu_count", gpu_type="gpu_type", gpu_memory="gpu_memory_gb") -> Column:
    """Tag written when old files are upgraded: NULL gpu_count is cpu_only too."""
    return (F.when(_c(gpu_count).isNull() | (_c(gpu_count) <= 0), "cpu_only")
             .when(_c(gpu_type) == "Unknown", "unknown_gpu")
             .when(_c(gpu_memory).isNull(), "missing_memory")
             .otherwise("ok"))


# ---- provider aliases (P3) --------------------------------------------------

# The collector's provider alias table (lower-cased name -> stored name).
PROVIDER_ALIASES = {
    "aws": "aws", "gcp": "gcp", "azure": "azure", "lambda": "lambda", "runpod": "runpod",
    "tensordock": "tensordock", "vastai": "vastai", "datacrunch": "datacrunch", "cudo": "cudo",
    "nebius": "nebius",
}


def normalize_provider(provider="provider", aliases: dict[str, str] | None = None) -> Column:
    """Lower-case, then map through the alias table; unknown names pass through."""
    aliases = PROVIDER_ALIASES if aliases is None else aliases
    low = F.lower(_c(provider))
    mapping = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    return F.coalesce(F.try_element_at(mapping, low), low)


# ---- time labels (P5, P10, P11, P13) ---------------------------------------

def day(ts="timestamp") -> Column:
    return F.to_date(_c(ts))


def snapshot_stamp(ts="timestamp") -> Column:
    """File stamp of a snapshot, e.g. 20240131T120000Z."""
    return F.date_format(_c(ts), "yyyyMMdd'T'HHmmss'Z'")


def snapshot_filename(ts="timestamp") -> Column:
    return F.concat(F.lit("snapshot_"), snapshot_stamp(ts), F.lit(".parquet"))


def hours_between(later, earlier) -> Column:
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(3_600_000_000.0)


def freshness_state(age_hours) -> Column:
    """Dataset freshness: <=24 h fresh, <=72 h stale, else outdated."""
    h = _c(age_hours)
    return F.when(h <= 24, "fresh").when(h <= 72, "stale").otherwise("outdated")


def provider_state(listings_in_latest, age_hours) -> Column:
    """Per-provider coverage: in latest -> green; seen within 7 days -> yellow; else red."""
    return (F.when(_c(listings_in_latest) > 0, "green")
             .when(_c(age_hours) <= 7 * 24, "yellow")
             .otherwise("red"))


def availability_label(available="available") -> Column:
    a = _c(available)
    return F.when(a, "yes").when(~a, "no").otherwise("unknown")


# ---- geography labels (P6, P7, P8) ------------------------------------------

def region_display(canonical="region_canonical", raw="region") -> Column:
    return F.coalesce(_c(canonical), _c(raw))


def metro(canonical="region_canonical") -> Column:
    """Metro = canonical region without a trailing '-zone'."""
    return F.regexp_replace(_c(canonical), "-zone$", "")


# Ordered literal replacements that shorten metro names.
METRO_REPLACEMENTS = [
    ("us-east-", ""), ("us-west-", ""), ("us-central-", ""), ("us-south-", ""),
    ("us-north-", ""), ("us-gov-", "gov:"), ("-att", ""), ("saltlakecity", "saltlake"),
]


def title_case(s) -> Column:
    """Python ``str.title``: upper-case a letter that follows a non-letter, lower-case the rest."""
    chars = F.split(_c(s), "")
    titled = F.transform(
        chars,
        lambda ch, i: F.when((i == 0) | ~F.element_at(chars, i).rlike(r"^\p{L}$"), F.upper(ch))
                       .otherwise(F.lower(ch)))
    return F.when(_c(s).isNull(), F.lit(None)).when(_c(s) == "", F.lit("")).otherwise(F.array_join(titled, ""))


def metro_label(m) -> Column:
    out = _c(m)
    for old, new in METRO_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return title_case(out)


def market_segment(provider="provider", hyperscalers=("aws", "gcp", "azure", "oci")) -> Column:
    """Marketplace vs hyperscaler bucket of a provider."""
    return F.when(_c(provider).isin(*hyperscalers), "hyperscaler").otherwise("marketplace")


def r6(c) -> Column:
    """Round a double result to 6 places so sum order cannot flip the last bits."""
    return F.round(_c(c), 6)
