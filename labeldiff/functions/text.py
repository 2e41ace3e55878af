"""Text, date and version expressions."""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of Unicode, as Python's \s sees it.
SPACE = r"(?U)\s+"


def collapsed(value: Column) -> Column:
    """Runs of white space to one space, none at the ends; nothing left is null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(value, SPACE, " "), "^ | $", ""), F.lit(""))


@lru_cache(maxsize=1)
def special_folds() -> tuple[str, str]:
    """Lower-case characters that case folding changes further, as a JSON object (one literal, where a map of literals would be hundreds of nodes of every plan), and a pattern of few ranges that covers all of them but the sharp s."""
    every = map(chr, (*range(128, 0xD800), *range(0xE000, 0x110000)))
    found = {c: c.casefold() for c in every if c.lower() == c != c.casefold()}
    ranges: list[list[int]] = []
    for c in map(ord, found):
        if c == 0xDF:
            continue
        if ranges and c - ranges[-1][1] < 64:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return json.dumps(found), "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def folded(value: Column) -> Column:
    """Unicode case folding: lower case, and then what folding changes further. A text with characters near those goes character by character; the sharp s of any other is replaced."""
    changes, near = special_folds()
    low, special = F.lower(value), F.from_json(F.lit(changes), "map<string,string>")
    each = F.transform(F.split(low, ""), lambda c: F.coalesce(F.try_element_at(special, c), c))
    return F.when(F.rlike(low, F.lit(near)), F.array_join(each, "")).otherwise(F.replace(low, F.lit("ß"), F.lit("ss")))


def heading(value: Column) -> Column:
    """For matching: folded, collapsed; null is empty."""
    return F.coalesce(collapsed(folded(value)), F.lit(""))


def mapped_heading(value: Column) -> Column:
    """For the concept map: the heading without its leading number (1, 2.3, 4.5.6)."""
    return F.coalesce(collapsed(F.regexp_replace(heading(value), r"^\d+(?:\.\d+)*\s*", "")), F.lit(""))


def tokens(value: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"(?U)(\S+)"), F.lit(1))


def mentions(value: Column, term: str) -> Column:
    """Whether a term occurs as a whole word, whatever the case."""
    return F.rlike(value, F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])\Q"), F.lit(term.replace(r"\E", r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])")))


def words(value: Column) -> Column:
    """For content scores: folded words (letters and digits, joined by hyphens or apostrophes) and comparison signs."""
    return F.regexp_extract_all(folded(F.coalesce(value, F.lit(""))), F.lit(r"([\p{L}\p{N}]+(?:[-'][\p{L}\p{N}]+)*|[<>]=?|=)"), F.lit(1))


def contains_folded(value: Column, needle: str) -> Column:
    return F.contains(F.lower(value), F.lit(needle.lower()))


def is_number(version: Column) -> Column:
    """Decimal digits only, of any script; empty is none."""
    return F.rlike(version, F.lit(r"^\p{Nd}+$"))


def leading_number(version: Column) -> Column:
    """Leading ASCII digits as a number, else 0."""
    return F.coalesce(F.regexp_extract(version, "^[0-9]+", 0).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def version_key(version: Column) -> list[Column]:
    """Sort key: numeric versions first, by value, then by text."""
    return [F.when(F.rlike(version, F.lit("[^0-9]")), 1).otherwise(0), leading_number(version), version]


def descending_version(version: Column) -> Column:
    """The number of a numeric version, else -1."""
    return F.when(is_number(version), version.try_cast("decimal(38,0)")).otherwise(F.lit(-1).cast("decimal(38,0)"))


def version_direction(old: Column, new: Column) -> Column:
    """-1, 0 or 1 for numeric versions; null otherwise."""
    return F.when(is_number(old) & is_number(new), direction(old.try_cast("decimal(38,0)"), new.try_cast("decimal(38,0)")))


def direction(old: Column, new: Column) -> Column:
    return F.when(old.isNull() | new.isNull(), F.lit(None).cast("int")).when(old < new, -1).when(old > new, 1).otherwise(0)


def lenient_date(value: Column) -> Column:
    """ISO, "January 5, 2020", "Jan 5, 2020" or 20200105; null if none fits."""
    v = F.trim(value)
    forms = (("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"), ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"), ("MMMM d, yyyy", r"^[A-Za-z]{4,} \d{1,2}, \d{4}$"), ("yyyyMMdd", r"^\d{8}$"))
    return F.coalesce(*[F.when(F.rlike(v, F.lit(shape)), F.try_to_date(F.initcap(F.lower(v)) if "MMM" in form else v, form)) for form, shape in forms])


def strict_date(value: Column) -> Column:
    """"Jan 05, 2020" only."""
    return F.when(F.rlike(value, F.lit(r"^[A-Z][a-z]{2} \d{2}, \d{4}$")), F.try_to_date(value, "MMM dd, yyyy"))


def ordinal(day: Column) -> Column:
    """Days since year 1, the first day being 1; -1 for null."""
    return F.coalesce(F.datediff(day, F.lit("0001-01-01").cast("date")) + 1, F.lit(-1))


def utc_text(at: Column) -> Column:
    """ISO 8601 with Z; microseconds only where there are any."""
    return F.when(F.date_format(at, "SSSSSS") == "000000", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def safe_segment(value: Column) -> Column:
    """Whether a value may be a path segment."""
    return F.rlike(value, F.lit(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$")) & ~value.isin(".", "..")


def cleaned_segment(value: Column) -> Column:
    """Other characters to underscores, no dots or spaces at the ends, at most 128 characters; "unknown" if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9._-]", "_"), r"^[. ]+|[. ]+$", "")
    return F.substring(F.coalesce(F.nullif(s, F.lit("")), F.lit("unknown")), 1, 128)


def first_spellings(values: Column) -> Column:
    """Distinct values whatever their case, in order, in their first spelling; blanks dropped."""
    kept = F.filter(values, lambda v: v.isNotNull() & (F.length(F.trim(v)) > 0))
    alike = F.transform(kept, folded)
    return F.filter(F.transform(kept, lambda v, i: F.when(F.array_position(alike, alike[i]) == i + 1, v)), lambda v: v.isNotNull())


def first_text(meta: Column, names: tuple[str, ...]) -> Column:
    """The first of a variant's fields that is a non-blank string, trimmed."""
    one = lambda n: F.when(F.schema_of_variant(F.try_variant_get(meta, f"$.{n}", "variant")) == "STRING", F.nullif(F.trim(F.try_variant_get(meta, f"$.{n}", "string")), F.lit("")))
    return F.coalesce(*[one(n) for n in names])


@F.pandas_udf(StringType())
def normalized_name(names: pd.Series) -> pd.Series:
    """NFKC, case folded, white space collapsed: no built-in does NFKC."""
    import unicodedata

    return names.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFKC", s).casefold().split()))
