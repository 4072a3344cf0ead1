"""Mention filters: length limits and blocked terms by entity type, and place and affiliation rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import strip

#: Result classes of a geocoder that name no place one can study.
NO_PLACE = tuple("aeroway amenity building craft highway leisure man_made office place_of_worship railway shop waterway".split())
#: Country codes that are places although they have two letters.
COUNTRY_CODES = tuple("AU BR CA CH CN DE ES FI FR GB IN IT JP MX NO PL PT RU SE UK US".split())
ROLES = ("Object of study", "Location of research")


@dataclass
class MentionFilter:
    """Blocked lower-case terms (for all types under ``_all``) and least lengths (``_default`` for other types)."""

    blocked: dict[str, set[str]] = field(default_factory=dict)
    min_length: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, blocked: set[str] | dict | None = None, min_length: int | dict | None = None) -> MentionFilter:
        """From loose settings: a set blocks for all types, a number is every type's least length."""
        groups = blocked if isinstance(blocked, dict) else {"_all": blocked or set()}
        least = min_length if isinstance(min_length, dict) else {"_default": min_length or 1}
        return cls({k if k == "_all" else k.lower(): {t.lower() for t in v} for k, v in groups.items()}, {k if k == "_default" else k.lower(): n for k, n in least.items() if n > 0})

    def reason(self, text: str = "text", entity: str = "entity") -> Column:
        """too_short before blocked, null for a kept mention. Settings are configuration: literals in the plan."""
        t, kind = F.lower(strip(F.col(text))), F.lower(F.col(entity))
        least = F.lit(self.min_length.get("_default", 1))
        for k, n in self.min_length.items():
            if k != "_default":
                least = F.when(kind == k, n).otherwise(least)
        stop = t.isin(*sorted(self.blocked.get("_all", ())))
        for k, terms in self.blocked.items():
            if k != "_all":
                stop = stop | ((kind == k) & t.isin(*sorted(terms)))
        return F.when(F.length(t) < least, "too_short").when(stop, "blocked")

    def apply(self, mentions: DataFrame) -> DataFrame:
        return mentions.where(self.reason().isNull())

    def stats(self, mentions: DataFrame, keys: list[str]) -> DataFrame:
        marked = mentions.withColumn("_why", self.reason())
        count = lambda c, n: F.count_if(c).alias(n)
        return marked.groupBy(*keys).agg(F.count("*").alias("total"), count(F.col("_why").isNull(), "kept"), count(F.col("_why") == "too_short", "too_short"), count(F.col("_why") == "blocked", "blocked"))


def valid_place(raw: str = "osm") -> Column:
    c, i, r = (F.col(f"{raw}.{n}") for n in ("class", "importance", "place_rank"))
    return ~F.coalesce(c.isin(*NO_PLACE), F.lit(False)) & (F.coalesce(i, F.lit(0.0)) >= 0.2) & (F.coalesce(r, F.lit(0)) <= 25)


def offsets_hold(text: str, start: str, end: str, mention: str) -> Column:
    """Whether the span lies in the text and reads as the mention, case aside."""
    inside = (F.col(start) >= 0) & (F.col(end) <= F.length(text)) & (F.col(start) < F.col(end))
    return F.coalesce(inside & (F.lower(F.substring(F.col(text), F.col(start) + 1, F.col(end) - F.col(start))) == F.lower(mention)), F.lit(False))


def has_link(linking: str = "linking") -> Column:
    return F.coalesce(F.size(linking) > 0, F.lit(False))
