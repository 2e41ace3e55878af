"""Sections of two versions matched in phases, for many version pairs at once.

Rows of both sides are one table: pair_id, side ("old" or "new"), section_id and the phases' keys. They are dealt by
pair_id once; each exact phase is a window over (pair_id, key) in that same partitioning, so five phases cost one
shuffle. A key matches if it occurs once on each side among what earlier phases left over; a null key takes no part.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from labeldiff.functions import text
from labeldiff.values import CONTENT_MARGIN, CONTENT_THRESHOLD, CONTENT_WEIGHTS


Hold = Callable[[DataFrame], DataFrame]


def as_is(rows: DataFrame) -> DataFrame:
    """Where a caller does not ask for intermediate results to be held, Spark plans all as one."""
    return rows


def exact_phases(sides: DataFrame, phases: Mapping[str, Column], agree: Mapping[str, tuple[Column, Callable[[Column, Column], Column]]] | None = None) -> DataFrame:
    """sides with ``partner`` (the other side's section_id) and ``method`` (the phase); null where unmatched.

    agree: for a phase a value of each section and whether two sections' values may match; those whose values do not are
    left to later phases. The other side's value comes through the phase's own window, so nothing is joined.
    """
    rows = sides.repartition("pair_id").withColumn("partner", F.lit(None).cast(sides.schema["section_id"].dataType)).withColumn("method", F.lit(None).cast("string"))
    old = F.col("side") == "old"
    for name, key in phases.items():
        rows = rows.withColumn("_key", F.when(F.col("partner").isNull(), key))
        group = Window.partitionBy("pair_id", "_key")
        count = lambda side: F.count(F.when(side, 1)).over(group)  # noqa: B023,E731
        mine = lambda side: F.max(F.when(side, F.col("section_id"))).over(group)  # noqa: B023,E731
        single = F.col("_key").isNotNull() & (count(old) == 1) & (count(~old) == 1)
        if name in (agree or {}):
            value, alike = agree[name]
            its = lambda side: F.max(F.when(side, F.struct(value.alias("v")))).over(group)["v"]  # noqa: B023,E731
            single = single & alike(its(old), its(~old))
        rows = rows.withColumn("_partner", F.when(single, F.when(old, mine(~old)).otherwise(mine(old))))
        rows = rows.withColumn("method", F.when(F.col("_partner").isNotNull(), name).otherwise(F.col("method"))).withColumn("partner", F.coalesce("partner", "_partner"))
    return rows.drop("_key", "_partner")


def standard_phases() -> dict[str, Column]:
    """The five exact phases over sections with xml_id, code, locator, heading, parent code / heading / depth and depth."""
    norm = text.heading(F.col("heading"))
    same = lambda *c: F.to_json(F.struct(*[F.coalesce(x.cast("string"), F.lit("\0")).alias(f"k{i}") for i, x in enumerate(c)]))
    return {
        "SOURCE_SECTION_ID": F.col("section_id").cast("string"),
        "XML_IDENTIFIER": F.nullif(F.col("xml_id"), F.lit("")),
        "SECTION_CODE": F.nullif(F.col("code"), F.lit("")),
        "SOURCE_LOCATOR": F.col("locator"),
        "HEADING_AND_PARENT": F.when(norm != "", same(norm, F.col("parent_code"), F.col("parent_heading"), F.col("parent_depth"), F.col("depth"))),
    }


def with_parents(sections: DataFrame) -> DataFrame:
    """Parent signature of each section: its parent's code, normalized heading and depth, or <root>."""
    above = sections.select("pair_id", "side", F.col("section_id").alias("parent_id"), F.coalesce("code", F.lit("")).alias("parent_code"), text.heading(F.col("heading")).alias("parent_heading"), F.col("depth").alias("parent_depth"))
    joined = sections.join(above, ["pair_id", "side", "parent_id"], "left")
    root = F.col("parent_depth").isNull()
    return joined.withColumn("parent_code", F.when(root, "<root>").otherwise(F.col("parent_code"))).withColumn("parent_heading", F.when(root, "<root>").otherwise(F.col("parent_heading"))).withColumn("parent_depth", F.coalesce("parent_depth", F.lit(-1)))


def locator_agrees() -> dict[str, tuple[Column, Callable[[Column, Column], Column]]]:
    """What the locator phase asks for besides: the same code or the same heading."""
    value = F.struct(F.col("code").alias("code"), text.heading(F.col("heading")).alias("heading"))
    return {"SOURCE_LOCATOR": (value, lambda a, b: a["code"].eqNullSafe(b["code"]) | a["heading"].eqNullSafe(b["heading"]))}


def ratio(least: float = 0.0):
    """A function of two token lists: SequenceMatcher's ratio without its popularity heuristic, or 0 where an upper bound of it (shared tokens) is below ``least``."""

    @F.pandas_udf(DoubleType())
    def of(old: pd.Series, new: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        def one(a, b):
            m = SequenceMatcher(a=list(a), b=list(b), autojunk=False)
            return m.ratio() if not least or m.quick_ratio() >= least else 0.0

        return pd.Series([one(a, b) for a, b in zip(old, new, strict=True)], dtype=float)

    return of


def content_candidates(rows: DataFrame, least: float) -> DataFrame:
    """(pair_id, old_id, new_id): every old and new section of a pair whose common tokens can reach a ratio of ``least``.

    A prefix filter over multisets. A ratio 2M/(a+b) of at least r asks for M >= r * a / (2 - r) common tokens, so two
    sections that reach it share a token among the a - M + 1 rarest of either (by sections of the pair that have it).
    Only those few tokens are joined, so pairs of sections without a rare token in common are never made. All windows
    are in the one partitioning by pair.
    """
    counts = rows.select("pair_id", "side", "section_id", "depth", "_n", F.explode("_t").alias("tok")).groupBy("pair_id", "side", "section_id", "depth", "_n", "tok").agg(F.count(F.lit(1)).alias("k")).repartition("pair_id")
    counts = counts.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("pair_id", "tok")))
    ahead = Window.partitionBy("pair_id", "side", "section_id").orderBy("df", "tok").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.col("_n") - F.ceil(F.col("_n") * F.lit(least / (2 - least)) - F.lit(1e-9)) + 1
    rare = counts.withColumn("_before", F.coalesce(F.sum("k").over(ahead), F.lit(0))).where((F.col("df") > 1) & (F.col("_before") < prefix))
    side = lambda s: rare.where(F.col("side") == s).select("pair_id", "tok", F.col("section_id").alias(f"{s}_id"), F.col("depth").alias(f"{s}_depth"), F.col("_n").alias(f"{s}_n"))
    both = side("old").join(side("new"), ["pair_id", "tok"])
    near = (F.abs(F.col("old_depth") - F.col("new_depth")) <= 1) & (2 * F.least("old_n", "new_n") >= least * (F.col("old_n") + F.col("new_n")))
    return both.where(near).select("pair_id", "old_id", "new_id").distinct()


def content_scores(left: DataFrame, threshold: float = CONTENT_THRESHOLD, hold: Hold = as_is) -> DataFrame:
    """(pair_id, old_id, new_id, score) of unmatched sections that are alike enough.

    left: unmatched rows with pair_id, side, section_id, text, heading, depth and parent signature.
    """
    c, h, p = CONTENT_WEIGHTS
    rows = left.withColumn("_t", text.words(F.col("text"))).withColumn("_n", F.size("_t")).withColumn("_parent", F.struct("parent_code", "parent_heading", "parent_depth"))
    rows = hold(rows.where("_n > 0").select("pair_id", "side", "section_id", "depth", "_t", "_n", "_parent", text.heading(F.col("heading")).alias("_h")))
    least = (threshold - h - p) / c
    cut = lambda x: rows.where(F.col("side") == x).select("pair_id", F.col("section_id").alias(f"{x}_id"), F.col("_t").alias(f"{x}_t"), F.split("_h", "").alias(f"{x}_h"), F.col("_parent").alias(f"{x}_p"))
    pairs = content_candidates(rows, least).join(cut("old"), ["pair_id", "old_id"]).join(cut("new"), ["pair_id", "new_id"])
    blank = lambda x: F.filter(x, lambda s: s != "")
    score = c * ratio(least - 1e-9)("old_t", "new_t") + h * ratio()(blank(F.col("old_h")), blank(F.col("new_h"))) + F.when(F.col("old_p") == F.col("new_p"), p).otherwise(0.0)
    return hold(pairs.select("pair_id", "old_id", "new_id", score.alias("score")).where(F.col("score") >= threshold))


def mutual_best(scores: DataFrame, margin: float = CONTENT_MARGIN) -> DataFrame:
    """Pairs that are each other's best (ties to the smaller id) and lead the second best by the margin on both sides."""
    by_old, by_new = (Window.partitionBy("pair_id", a).orderBy(F.desc("score"), b) for a, b in (("old_id", "new_id"), ("new_id", "old_id")))
    ranked = scores.withColumns({"_ro": F.row_number().over(by_old), "_rn": F.row_number().over(by_new), "_so": F.lead("score").over(by_old), "_sn": F.lead("score").over(by_new)})
    leads = lambda second: F.col(second).isNull() | (F.col("score") - F.col(second) >= margin)
    return ranked.where((F.col("_ro") == 1) & (F.col("_rn") == 1) & leads("_so") & leads("_sn")).select("pair_id", "old_id", "new_id", "score")


def outcomes(matched: DataFrame) -> DataFrame:
    """Full outcome, a row per match or single section: (pair_id, old_id, new_id, method, status)."""
    old, new = matched.where("side = 'old'"), matched.where("side = 'new' AND partner IS NULL")
    left = old.select("pair_id", F.col("section_id").alias("old_id"), F.col("partner").alias("new_id"), "method")
    right = new.select("pair_id", F.lit(None).cast(matched.schema["section_id"].dataType).alias("old_id"), F.col("section_id").alias("new_id"), "method")
    status = F.when(F.col("method").isNull(), "UNMATCHED").when(F.col("method") == "CONTENT_ASSISTED", "HEURISTIC").otherwise("EXACT")
    return left.unionByName(right).withColumn("status", status).withColumn("method", F.coalesce("method", F.lit("UNMATCHED")))


def match_sections(sections: DataFrame, hold: Hold = as_is, keep: list[str] | None = None) -> DataFrame:
    """All six phases over sections of many pairs; sections with partner and method. ``hold`` is given what several later steps read.

    keep: the columns that the caller reads (default: all); of sections that the exact phases match only these are held.
    """
    found = exact_phases(with_parents(sections), standard_phases(), locator_agrees())
    if keep is not None:
        found = found.select(*[F.when(F.col("partner").isNull(), F.col(c)).alias(c) if c not in {*keep, "partner", "method"} else F.col(c) for c in found.columns])
    found = hold(found)
    rest = found.where("partner IS NULL").drop("partner", "method")
    best = hold(mutual_best(content_scores(rest, hold=hold)))
    link = best.select("pair_id", F.lit("old").alias("side"), F.col("old_id").alias("section_id"), F.col("new_id").alias("partner")).union(best.select("pair_id", F.lit("new"), "new_id", "old_id"))
    rest = rest.select(*(found.columns[:-2] if keep is None else keep)).join(link, ["pair_id", "side", "section_id"], "left").withColumn("method", F.when(F.col("partner").isNotNull(), "CONTENT_ASSISTED"))
    names = rest.columns
    return found.where("partner IS NOT NULL").select(*names).unionByName(rest)
