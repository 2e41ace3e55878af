"""License scan: ordered signature rules with a keyword prefilter and interval-containment suppression.

DataFrame functions only; one projection over the documents, no shuffle, no Python on the executors.

1. A single case-blind expression of all keywords drops nearly all texts; the others are normalized once: words (ASCII
   letters, digits and everything beyond ASCII), A-Z lowered, joined by single spaces.
2. The rules whose keyword occurs are tried; each match becomes an interval of word numbers with label, priority and
   rule number.
3. A detection is suppressed if another one contains its interval and has a higher priority, or the same priority and
   a longer interval, or the same of both and an earlier rule. So "cc by 4 0" silences "cc by", and a whole notice
   silences the name within it. Sorted by start, one pass per priority decides this, however many detections there are.
4. The base phrases are counted on their own, so a suppressed detection never hides them.

Defined results: null and empty texts have no words and no labels, score 0; equal intervals of one label count once;
extra columns are ignored by ``scan_report`` and kept by ``scan``; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh
from labeldiff.llm.license_rules import BASE, rules

#: What separates words, as a class of a Java expression.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Score of a detection by priority.
CONFIDENCE = {3: 0.99, 2: 0.9, 1: 0.5}
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def loosely(words: str) -> str:
    """The words of a phrase with any separators between them."""
    return GAP.join(map(re.escape, words.split()))


def any_of(phrases) -> str:
    """A case-blind expression of phrases that start at the start of a word."""
    return rf"(?i)(?<!{WORD[:-1]})(?:{'|'.join(map(loosely, phrases))})"


def normalized(text: Column) -> Column:
    """Lower-case words, each with a space on either side of it: " a  b "."""
    words = F.regexp_replace(text, GAP, "  ")
    return F.translate(F.regexp_replace(F.concat(F.lit("  "), words, F.lit("  ")), "^ +| +$", " "), UPPER, LOW)


def places(x: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often a phrase occurs in normalized text x, and the word numbers of its first and last place."""
    mark, n = "".join(f" {w} " for w in phrase.split()), len(phrase.split())
    count = ((F.length(x) - F.length(F.replace(x, F.lit(mark), F.lit("")))) / len(mark)).cast("long")
    words = lambda s: ((F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))) / 2).cast("long")
    first = words(F.substring_index(x, mark, 1))
    last = words(x) - words(F.substring_index(x, mark, -1)) - F.lit(n)
    return count, first, last


def detections(flat: Column) -> Column:
    """array<struct<start, end, priority, rule, label>> of all rules' matches in text of single-spaced words."""
    by_keyword: dict[str, list] = {}
    for k, r in enumerate(rules()):
        by_keyword.setdefault(r.keyword, []).append(F.struct(F.lit(k).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(rf"(?<![^ ])(?:{r.pattern})(?![^ ])").alias("pattern")))
    table = F.array(*[F.struct(F.lit(f" {word}").alias("keyword"), F.array(*own).alias("rules")) for word, own in by_keyword.items()])
    none = F.array().cast("array<struct<start:int,end:int,priority:int,rule:int,label:string>>")

    def matches(r: Column) -> Column:
        # \u0001 opens a match and \u0002 closes it; neither occurs in normalized text. Few rules match, so only those are folded.
        marked = F.regexp_replace(flat, r["pattern"], F.lit("\u0001$0\u0002"))
        return F.transform(F.array(marked), lambda z: F.when(F.contains(z, F.lit("\u0001")), intervals(z, r)).otherwise(none))[0]

    def intervals(z: Column, r: Column) -> Column:
        parts = F.split(z, "\u0001")
        spaces = lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("int")
        # Fold over the parts: the word number where the next part starts, and the matches so far.
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

        def step(s: Column, p: Column) -> Column:
            hit = F.instr(p, "\u0002") > 0
            own = F.struct(s["at"].alias("start"), (s["at"] + spaces(F.substring_index(p, "\u0002", 1)) + 1).alias("end"))
            return F.struct((s["at"] + spaces(p)).alias("at"), F.when(hit, F.concat(s["found"], F.array(own))).otherwise(s["found"]).alias("found"))

        found = F.aggregate(parts, start, step, lambda s: s["found"])
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label")))

    padded = F.array(F.concat(F.lit(" "), flat))
    gated = F.flatten(F.transform(padded, lambda x: F.flatten(F.transform(F.filter(table, lambda t: F.contains(x, t["keyword"])), lambda t: t["rules"]))))
    return F.flatten(F.transform(gated, matches))


def unsuppressed(found: Column) -> Column:
    """The detections that no stronger one contains. Sorted by start, then by end downwards, a detection is contained in
    an earlier one exactly if some earlier end reaches its end; the largest ends are kept by priority."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("weak"), d["rule"].alias("rule"), d["label"].alias("label"))))
    none = F.struct(F.lit(0).alias("e1"), F.lit(0).alias("e2"), F.lit(0).alias("e3"), F.array().cast("array<struct<start:int,end:int,priority:int,rule:int,label:string>>").alias("kept"))

    def step(s: Column, d: Column) -> Column:
        end, level = -d["back"], -d["weak"]
        reach = F.when(level == 3, s["e3"]).when(level == 2, F.greatest(s["e2"], s["e3"])).otherwise(F.greatest(s["e1"], s["e2"], s["e3"]))
        own = F.struct(d["start"].alias("start"), end.alias("end"), level.alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"))
        return F.struct(
            F.when(level == 1, F.greatest(s["e1"], end)).otherwise(s["e1"]).alias("e1"),
            F.when(level == 2, F.greatest(s["e2"], end)).otherwise(s["e2"]).alias("e2"),
            F.when(level == 3, F.greatest(s["e3"], end)).otherwise(s["e3"]).alias("e3"),
            F.when(reach < end, F.concat(s["kept"], F.array(own))).otherwise(s["kept"]).alias("kept"),
        )

    return F.aggregate(order, none, step, lambda s: s["kept"])


def scan(docs: DataFrame, text_col: str = "text", prefix: str = "license_") -> DataFrame:
    """docs with ``<prefix>detections``, the unsuppressed ones: array<struct<start, end, priority, rule, label>> in words. The name has underscores behind where a column has it."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keys = any_of(sorted({r.keyword for r in rules()}))
    none = F.array().cast("array<struct<start:int,end:int,priority:int,rule:int,label:string>>")
    flat = F.trim(F.regexp_replace(normalized(text), " +", " "))
    # The one-element array binds the normalized text to a variable, so that it is not computed anew for every rule.
    found = F.transform(F.array(flat), lambda x: unsuppressed(detections(x)))[0]
    return docs.withColumn(fresh(docs.columns, f"{prefix}detections"), F.when(F.rlike(text, F.lit(keys)), found).otherwise(none))


def scan_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, base phrases' places, base labels, all labels, score and the kept detections."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = any_of(p for p, _ in BASE)
    rows = scan(docs.select("doc_id", "text")).withColumn("_x", F.when(F.rlike(text, F.lit(base)), normalized(text)).otherwise(F.lit("")))
    found = {label: places(F.col("_x"), phrase) for phrase, label in BASE}
    rows = rows.select(
        "doc_id",
        F.size(F.array_remove(F.split(text, GAP), "")).cast("long").alias("n_words"),
        *[c.alias(f"_n_{label}") for label, (c, _, _) in found.items()],
        *[F.when(c > 0, f).alias(f"_f_{label}") for label, (c, f, _) in found.items()],
        *[F.when(c > 0, x).alias(f"_l_{label}") for label, (c, _, x) in found.items()],
        F.col("license_detections").alias("detections"),
    )
    labels = list(found)
    base_labels = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"`_n_{x}`") > 0, F.lit(x)) for x in labels])))
    every = F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("detections", lambda d: d["label"]))))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0))
    score = F.when(best == 3, CONFIDENCE[3]).when((best == 2) | (F.size(base_labels) > 0), CONFIDENCE[2]).when(best == 1, CONFIDENCE[1]).otherwise(0.0)
    least = lambda kind, f: f(*[F.col(f"`_{kind}_{x}`") for x in labels])
    return rows.select(
        "doc_id",
        "n_words",
        sum((F.col(f"`_n_{x}`") for x in labels[1:]), F.col(f"`_n_{labels[0]}`")).alias("n_base"),
        least("f", F.least).alias("first_word"),
        least("l", F.greatest).alias("last_word"),
        F.concat_ws(",", base_labels).alias("base_labels"),
        F.concat_ws(",", every).alias("labels"),
        score.cast("double").alias("score"),
        F.to_json("detections").alias("detections"),
    )
