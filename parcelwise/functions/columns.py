"""Column expressions: text, time, numbers and rule lookups, all evaluated by Catalyst."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rounder = Callable[[Column, int], Column]


def half_up(value: Column, digits: int) -> Column:
    """Rounding that another engine reproduces bit by bit: floor(x * 10^d + 0.5) / 10^d."""
    factor = F.lit(float(10**digits))
    return F.floor(value * factor + F.lit(0.5)).cast("double") / factor


def contains_one(text: Column, words: Iterable[str]) -> Column:
    """Whether the text holds any of the words, by comparing bytes: a small part of a regular expression's time."""
    found = None
    for w in words:
        hit = text.contains(F.lit(w))
        found = hit if found is None else found | hit
    return F.lit(False) if found is None else found


def searched(text: Column, pattern: str) -> Column:
    """``rlike``; a pattern that is a choice of plain words is looked up as words."""
    return contains_one(text, pattern.split("|")) if re.fullmatch(r"[A-Za-z0-9 ]+(\|[A-Za-z0-9 ]+)*", pattern) else text.rlike(pattern)


def squeezed(value: Column) -> Column:
    """Runs of white space as one blank, none at the ends; only text that has such a run goes through the pattern."""
    bare = F.trim(value)
    runs = contains_one(bare, ["  ", "\t", "\n", "\x0b", "\f", "\r"])
    return F.when(runs, F.trim(F.regexp_replace(bare, r"\s+", " "))).otherwise(bare)


def timestamp_of(iso: Column) -> Column:
    """ISO text with a trailing Z or offset as a timestamp; null if it is none. Seconds with a Z need no rewriting, and Spark reads
    a Z faster than an offset."""
    return F.try_to_timestamp(F.when((F.length(iso) == 20) & iso.endswith("Z"), iso).otherwise(F.regexp_replace(iso, "Z$", "+00:00")))


def iso_of_epoch(epoch: Column) -> Column:
    """UTC ISO text of an epoch in milliseconds (above 10^10) or seconds."""
    seconds = F.when(epoch > 10**10, F.floor(epoch / 1000)).otherwise(epoch).cast("long")
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_key(when: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.date_format(when, "yyyyMMdd").cast("int")


def digits_or_zero(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).otherwise(F.lit(0))


def fingerprint(columns: Iterable[Column], algorithm: str = "md5", null_mark: str = "\\N") -> Column:
    """Hex digest of canonical field texts; nulls and blanks differ, and no value runs into the next."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.when(contains_one(t, ["\\", "|"]), F.regexp_replace(t, r"([\\|])", r"\\$1")).otherwise(t), F.lit(null_mark)) for t in texts]
    text = F.concat_ws("|", *parts)
    return {"md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256)}[algorithm](text.cast("binary"))


def last_match(text: Column, rules: dict[str, list[str]], default: Column) -> Column:
    """The last rule with a keyword in the text."""
    chain = None
    for name, words in reversed(rules.items()):
        if words:
            hit = contains_one(F.lower(text), [w.lower() for w in words])
            chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return default if chain is None else chain.otherwise(default)


def first_match(text: Column, rules: dict[str, list[str]], default: str) -> Column:
    return last_match(text, dict(reversed(rules.items())), F.lit(default))


def band(value: Column, bands: list[tuple[str, float]], nulls_last_band: bool = True) -> Column:
    """The name of the half-open band that a value lies in. Values below all floors take the first band; a null takes
    the last band, or none."""
    chain = None
    for (name, _), (_, ceiling) in zip(bands, bands[1:], strict=False):
        chain = F.when(value < ceiling, name) if chain is None else chain.when(value < ceiling, name)
    last = F.lit(bands[-1][0])
    chain = last if chain is None else chain.otherwise(last)
    return chain if nulls_last_band else F.when(value.isNotNull(), chain)


def lookup(value: Column, table: dict[str, str], default: str | None = None) -> Column:
    """A small literal map; a missing key gives the default."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(pairs[value], F.lit(default))
