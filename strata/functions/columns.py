"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Referrer substrings and the traffic source each one stands for,
# tried in this order.
REFERRER_SUBSTRINGS = [
    ("linkedin", "Linkedin"),
    ("t.co", "Twitter"),
    ("google", "Google"),
    ("lnkd", "Linkedin"),
]
# Fixed value: the source of a referrer that is one of our own sites.
OWN_SITE = "On Site"

# The same sources by host name, so that "t.co" no longer matches "reddit.com".
REFERRER_HOSTS = [
    ("linkedin.com", "Linkedin"),
    ("t.co", "Twitter"),
    ("google.com", "Google"),
    ("lnkd.in", "Linkedin"),
]


def names(columns: str | Iterable[str]) -> list[str]:
    """One name or several, as a list."""
    return [columns] if isinstance(columns, str) else list(columns)


def column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def band(value: str | Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the highest threshold that ``value`` is strictly above; ``default`` if none (or null)."""
    value = column(value)
    label = None
    for threshold, name in sorted(bands, key=lambda b: -b[0]):
        test = value > F.lit(threshold)
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return F.lit(default) if label is None else label.otherwise(F.lit(default))


def referrer_rules(own_sites: Iterable[str] = ()) -> list[tuple[str, str]]:
    """The substring rules, followed by one rule per own site."""
    return REFERRER_SUBSTRINGS + [(site, OWN_SITE) for site in own_sites]


def classify_by_rules(value: str | Column, rules: Sequence[tuple[str, str]], by_host: bool = False) -> Column:
    """First matching rule's label, else the value itself.

    A rule matches when the value contains its pattern; with ``by_host`` when the
    host of the URL is the pattern or one of its subdomains.
    """
    value = column(value)
    if not rules:
        return value
    if by_host:
        host = F.regexp_extract(value, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/:?#]+)", 1)
        tests = [(host == F.lit(p)) | host.endswith("." + p) for p, _ in rules]
    else:
        tests = [value.contains(p) for p, _ in rules]
    label = F.when(tests[0], F.lit(rules[0][1]))
    for test, (_, name) in zip(tests[1:], rules[1:]):
        label = label.when(test, F.lit(name))
    return label.otherwise(value)


def join_arrays(left: Column, right: Column) -> Column:
    """Concatenate two arrays of one type, either of which may be null."""
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.concat(left, right))


def keep_tail(array: Column, n: int | None) -> Column:
    """The last ``n`` elements, or all of them."""
    if n is None:
        return array
    return F.slice(array, F.greatest(F.size(array) - F.lit(n - 1), F.lit(1)), F.lit(n))


def datelist_bits(dates: str | Column, as_of: str | Column, days: int = 32) -> Column:
    """Fold an array of dates into a bitmap whose top bit is the as-of day.

    Bit ``days - 1 - k`` is set when the entity was active ``k`` days before
    ``as_of``; dates outside the last ``days`` days are ignored.
    """
    as_of = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of

    def add(bits: Column, day: Column) -> Column:
        ago = F.datediff(as_of, day)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(days - 1) - ago)
        return F.when((ago >= 0) & (ago < days), bits.bitwiseOR(bit)).otherwise(bits)

    return F.aggregate(column(dates), F.lit(0).cast("bigint"), add)


def top_bits_mask(first: int, count: int, days: int = 32) -> int:
    """Mask of ``count`` days starting ``first`` days before the as-of day."""
    return ((1 << count) - 1) << (days - first - count)


def active_days(bits: str | Column, first: int = 0, count: int = 32, days: int = 32) -> Column:
    """Number of active days among ``count`` days starting ``first`` days ago."""
    mask = F.lit(top_bits_mask(first, count, days)).cast("bigint")
    return F.bit_count(column(bits).bitwiseAND(mask))


def bits_text(bits: str | Column, days: int = 32) -> Column:
    """The bitmap as a string of ``days`` zeros and ones, as-of day first."""
    return F.lpad(F.bin(column(bits)), days, "0")


def hash_bucket(key: str | Column, salt: str, buckets: int = 10_000) -> Column:
    """Reproducible bucket of a key: leading 32 bits of md5(salt + key), modulo ``buckets``."""
    digest = F.md5(F.concat(F.lit(salt), column(key).cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def ip_number(ip: str | Column) -> Column:
    """Dotted IPv4 text as a number; null when it is not four numbers of 0..255."""
    ip = column(ip)
    parts = F.split(ip, r"\.")
    value = F.lit(0).cast("bigint")
    valid = F.size(parts) == 4
    for i in range(4):
        octet = F.get(parts, F.lit(i)).try_cast("bigint")
        value = value * 256 + octet
        valid = valid & octet.between(0, 255)
    return F.when(valid, value)


def number_ip(number: str | Column) -> Column:
    """A number of 0..2^32-1 as dotted IPv4 text."""
    number = column(number)
    octets = [F.shiftright(number, s).bitwiseAND(F.lit(255).cast("bigint")).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)
