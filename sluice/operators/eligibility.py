"""Which documents take part: blank texts, corpus profiles, field filters, strata. All are Columns, so they reach the scan."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

_SPACES = ("category categoria template file ficheiro wikibooks wikilivros help ajuda portal".split(), "predefini[cç][aã]o", "wikip[eé]dia")
RESERVED_TITLE = r"(?iuU)\A\s*(?:" + "|".join([*_SPACES[0], *_SPACES[1:]]) + r")\s*:"
REDIRECT = r"(?iuU)\A\s*#\s*redire(?:ct|cionamento)"
#: Least characters of the longest paragraph.
PARAGRAPH = 300
#: Characters of the text in which redirects and disambiguations are looked for.
LEAD = 1500


def article(text: Column, title: Column) -> Column:
    """No reserved title, redirect or disambiguation, and at least one paragraph of PARAGRAPH characters."""
    title, lead = F.coalesce(title, F.lit("")), F.lower(F.substring(text, 1, LEAD))
    plain, accented = "desambiguacao", "desambiguação"
    long_one = F.exists(F.split(text, r"(?U)\n\s*\n+"), lambda p: F.length(T.strip(p)) >= PARAGRAPH)
    return ~title.rlike(RESERVED_TITLE) & ~lead.rlike(REDIRECT) & ~lead.contains(plain) & ~lead.contains(accented) & ~F.lower(title).contains(accented) & long_one


def main_namespace(ns: Column) -> Column:
    """Is this the number 0; text that is no number, and null, aren't."""
    return F.coalesce(T.strip(ns.cast("string")).try_cast("int") == 0, F.lit(False))


#: Profiles by name: (text, title, namespace) -> Column. An unknown name asks for a text that isn't blank, no more.
PROFILES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "wikibooks_ptbr": lambda text, title, ns: article(text, title),
    "wikipedia_ptbr": lambda text, title, ns: main_namespace(ns) & article(text, title),
}


def eligible(text: Column, title: Column | None = None, ns: Column | None = None, profile: str | None = None) -> Column:
    """Does a document take part. ``ns`` is the namespace where the record has one; where it has none it counts as 0."""
    title = F.lit(None).cast("string") if title is None else title
    own = PROFILES.get(profile or "", lambda *_: F.lit(True))(text, title, F.lit(0) if ns is None else ns)
    return ~T.blank(text) & own


def matches(filters: dict[str, object], resolve: Callable[[str], Column | None]) -> Column:
    """All of {path: value or list of values} hold; a path that isn't there is null, and null equals null."""

    def one(path: str, wanted: object) -> Column:
        actual = resolve(path)
        actual = F.lit(None) if actual is None else actual
        values = wanted if isinstance(wanted, list) else [wanted]
        return reduce(lambda a, b: a | b, [actual.eqNullSafe(F.lit(v)) for v in values], F.lit(False))

    return reduce(lambda a, b: a & b, [one(p, w) for p, w in filters.items()], F.lit(True))


def resolver(df: DataFrame) -> Callable[[str], Column | None]:
    """Column of a dotted path of df, null where a part of it is missing from the schema."""

    def resolve(path: str) -> Column | None:
        kind = df.schema
        for part in path.split("."):
            if not hasattr(kind, "fieldNames") or part not in kind.fieldNames():
                return None
            kind = kind[part].dataType
        return F.col(".".join(f"`{p}`" for p in path.split(".")))

    return resolve


def stratum(df: DataFrame, paths: list[str]) -> Column:
    """Array of the values at these paths as text: "<missing>" without such a path, "None" for null."""
    find = resolver(df)
    return F.array(*(F.lit("<missing>") if find(p) is None else F.coalesce(find(p).cast("string"), F.lit("None")) for p in paths)).cast("array<string>")
