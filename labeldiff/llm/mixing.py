"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Tokens are raked to three marginals at once: source, language and topic. A cell is a (source, language, topic); a
document of a cell is drawn with probability min(1, s * l * t), one factor for each of its labels. The factors are
fitted, bounds included, such that the tokens drawn in expectation have the target share for every label and are the
budget, a share of all tokens, in sum. So what is drawn meets the targets; nothing is clipped afterwards.

Targets default to tempered shares, share^alpha normalized (alpha 1 keeps the corpus' shares, 0 makes all equal). No
label can give more tokens than it has: at a budget of b its share of the draw is at most its own share / b. A target
beyond that is put to this bound and the others are scaled to fill the rest, until all can be met (``feasible``); with
``budget=None`` the budget is the largest at which all targets are met as they were asked. ``marginals`` states for each
label its share, the target asked, the feasible one and the share drawn in expectation, and ``Mix.error`` the largest
difference of the last two; a fit that ends above ``TOLERANCE`` warns.

Cells are aggregated by Spark. Up to ``MAX_CELLS`` of them are fitted on the driver and broadcast (a bounded size);
beyond that the same updates run as aggregates and joins over the table of cells, in at most ``ROUNDS`` rounds.

Topics: a text is of the topic of ``LEXICON`` of which it has the most different words, three at least, else of the form
it is written in (legal, table, code, contact, noise, prose). A column with topics may be named instead.

A document is drawn if the hash of its id is below its probability, so the draw is the same in each run and at each
partitioning.

Defined results: null source or language is the empty label; a null or empty text has no tokens and weighs nothing; a
target for a label without tokens is dropped and the rest rescaled; a cell without tokens has the budget as its
probability; without any tokens all is drawn; equal ids are drawn together; an empty table gives no rows; extra columns
are kept.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh, stored

#: Cells that are fitted on the driver, at most; rounds of either way; largest error of a label's share that passes without a warning.
MAX_CELLS, DRIVER_ROUNDS, ROUNDS, TOLERANCE = 200_000, 4000, 40, 1e-3
KINDS = ("source", "lang", "topic")

#: Words that tell a text's topic, in English, German, French and Spanish.
LEXICON = {
    "health": "doctor patient hospital disease medicine treatment symptoms vaccine arzt krankheit medikament médecin maladie enfermedad médico hospital",
    "finance": "bank market stock investment price interest economy tax loan aktie zinsen steuer wirtschaft banque économie bolsa impuesto economía",
    "technology": "software computer internet data algorithm device network server programm rechner daten logiciel ordinateur réseau programa ordenador",
    "science": "theory experiment physics chemistry biology research laboratory energy forschung versuch energie recherche expérience investigación teoría",
    "sport": "game team player match season coach league goal spiel mannschaft trainer équipe joueur entraîneur partido equipo jugador",
    "politics": "government president election parliament minister party vote regierung wahl partei gouvernement élection gobierno elección partido",
    "arts": "music film painting novel theatre artist museum album musik gemälde künstler musique peinture música pintura artista",
    "travel": "hotel flight airport tourist beach journey restaurant reise flughafen strand voyage aéroport plage viaje aeropuerto playa",
}
#: What separates words: white space and ASCII punctuation.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def form_of(text: Column, low: Column) -> Column:
    """How a text is written: legal, table, code, contact, noise or prose. First that fits. low: the text in lower case."""
    n = F.greatest(F.length(text), F.lit(1))
    many = lambda mark, share: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit(""))) > n * share
    has = lambda word: F.contains(low, F.lit(word))
    return (
        F.when(has("copyright") | has("license") | has("licence") | has("reserved") & F.rlike(low, F.lit(r"rights\s+reserved")), "legal")
        .when(F.contains(text, F.lit("|")) & many("|", 0.02), "table")
        .when(F.contains(text, F.lit("{")) & many("{", 0.005) | F.contains(text, F.lit(";")) & many(";", 0.02), "code")
        .when(F.contains(text, F.lit("@")) & F.rlike(text, F.lit(r"\w@\w+\.\w")), "contact")
        .when(F.contains(text, F.lit("*")) & many("*", 0.01) | F.contains(text, F.lit("#")) & many("#", 0.01) | F.contains(text, F.lit("!")) & many("!", 0.02), "noise")
        .otherwise("prose")
    )


def topic_of(text: Column, low: Column | None = None, words: Column | None = None) -> Column:
    """The topic of the lexicon with the most different words in the text (of equals the first), else the text's form. low, words: the text in lower case and its words, where they are there already."""
    low = F.lower(text) if low is None else low
    words = F.split(low, GAPS) if words is None else words
    every = sorted({w for own in LEXICON.values() for w in own.split()})
    known = F.array_intersect(words, F.array(*map(F.lit, every)))
    best = F.transform(F.array(known), lambda x: F.array_max(F.array(*[F.struct(F.size(F.array_intersect(x, F.array(*map(F.lit, sorted(set(own.split())))))).alias("n"), F.lit(-k).alias("k"), F.lit(t).alias("t")) for k, (t, own) in enumerate(LEXICON.items())])))[0]
    return F.when(F.size(known) < 3, form_of(text, low)).otherwise(F.when(best["n"] >= 3, best["t"]).otherwise(form_of(text, low)))


def tokens_of(words: Column) -> Column:
    """Words, of those that a split gives."""
    return F.size(F.array_remove(words, "")).cast("long")


def tempered(share: Mapping[str, float], alpha: float) -> dict[str, float]:
    raised = {k: v**alpha for k, v in share.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()}


def rescaled(target: Mapping[str, float], present: Mapping[str, float]) -> dict[str, float]:
    kept = {k: target.get(k, 0.0) for k, v in present.items() if v > 0}
    total = sum(kept.values())
    if total <= 0:
        raise ValueError("no target covers what is in the table")
    return {k: v / total for k, v in kept.items()}


def feasible(target: Mapping[str, float], share: Mapping[str, float], budget: float) -> dict[str, float]:
    """The targets with none above share / budget: those beyond are put to it, the others are scaled to fill the rest, until it holds."""
    out, full = dict(target), set()
    while True:
        over = {k for k in out if k not in full and out[k] > share[k] / budget + 1e-15}
        if not over:
            return out
        full |= over
        rest = 1.0 - sum(share[k] / budget for k in full)
        free = sum(target[k] for k in out if k not in full)
        out = {k: share[k] / budget if k in full else target[k] * rest / free if free > 0 else 0.0 for k in out}


class Mix(NamedTuple):
    """What was fitted. cells: (source, lang, topic, p, and for each label its ``<kind>_target``, feasible, and ``<kind>_drawn``, expected); labels: (kind, label, share, asked, target, drawn); budget: the share of tokens that is drawn; error: of the worst label."""

    cells: DataFrame
    labels: DataFrame
    budget: float
    error: float


LABELS = "kind string, label string, share double, asked double, target double, drawn double"


def goals(sums: Mapping[str, Mapping[str, float]], budget: float | None, targets: Mapping[str, Mapping[str, float]], alpha: Mapping[str, float]) -> tuple[dict, dict, float]:
    """The targets asked and the feasible ones by kind and label, and the budget. sums: shares by kind and label."""
    asked = {k: rescaled(targets[k], sums[k]) if k in targets else tempered(sums[k], alpha[k]) for k in KINDS}
    if budget is None:
        budget = min(sums[k][v] / t for k in KINDS for v, t in asked[k].items() if t > 0)
    # A draw has no more than all tokens of the labels that a target names.
    budget = min([1.0, budget, *(sum(sums[k][v] for v, t in asked[k].items() if t > 0) for k in KINDS)])
    return asked, {k: feasible(asked[k], sums[k], budget) for k in KINDS}, budget


def fit_here(n: np.ndarray, codes: list[np.ndarray], goal: list[np.ndarray], budget: float) -> tuple[np.ndarray, list[np.ndarray], float]:
    """Probabilities of the cells, the labels' drawn shares and the largest error. n: shares of the cells; codes: each cell's label numbers by kind."""
    factors = [np.where(g > 0, 1.0, 0.0) for g in goal]
    prob = lambda: np.minimum(1.0, budget * np.prod([f[c] for f, c in zip(factors, codes, strict=True)], axis=0))
    for _ in range(DRIVER_ROUNDS):
        for f, c, g in zip(factors, codes, goal, strict=True):
            p = prob()
            now, full = np.bincount(c, n * p, len(g)), np.bincount(c, n * (p >= 1), len(g))
            # What is at its bound stays; the rest is scaled to what is wanted besides.
            part = (budget * g > full) & (now > full)
            top, base = np.where(part, budget * g - full, budget * g), np.where(part, now - full, now)
            np.multiply(f, np.divide(top, base, out=np.ones_like(g), where=base > 0), out=f)
            np.minimum(f, 1e150, out=f)
        p = prob()
        got = [np.bincount(c, n * p, len(g)) / budget for c, g in zip(codes, goal, strict=True)]
        error = max(float(np.abs(a - g).max()) for a, g in zip(got, goal, strict=True))
        if error <= TOLERANCE / 1000:
            break
    return p, got, error


def fit(rows: DataFrame, budget: float | None = 0.8, targets: Mapping[str, Mapping[str, float]] | None = None, alpha: Mapping[str, float] | None = None, max_cells: int = MAX_CELLS) -> Mix | None:
    """rows: (source, lang, topic, tokens). None if there are no tokens."""
    targets, alpha = targets or {}, {"source": 0.7, "lang": 0.7, "topic": 0.7} | dict(alpha or {})
    cells = stored(rows.groupBy(*KINDS).agg(F.sum("tokens").cast("double").alias("n")).where("n > 0"), "cells")
    some = cells.orderBy(*KINDS).limit(max_cells + 1).collect()
    if not some:
        return None
    if len(some) > max_cells:
        return fit_there(cells, budget, targets, alpha)
    total = sum(r.n for r in some)
    names = [sorted({r[j] for r in some}) for j in range(3)]
    number = [{v: i for i, v in enumerate(x)} for x in names]
    codes = [np.array([number[j][r[j]] for r in some]) for j in range(3)]
    n = np.array([r.n / total for r in some])
    shares = {k: dict(zip(names[j], np.bincount(codes[j], n).tolist(), strict=True)) for j, k in enumerate(KINDS)}
    asked, goal, budget = goals(shares, budget, targets, alpha)
    p, got, error = fit_here(n, codes, [np.array([goal[k][v] for v in names[j]]) for j, k in enumerate(KINDS)], budget)
    warned(error)
    spark = rows.sparkSession
    labels = [(k, v, shares[k][v], asked[k][v], goal[k][v], float(got[j][number[j][v]])) for j, k in enumerate(KINDS) for v in names[j]]
    schema = ", ".join([*(f"{k} string" for k in KINDS), "p double", *(f"{k}_{x} double" for k in KINDS for x in ("target", "drawn"))])
    made = [(*r[:3], float(q), *(x for j, k in enumerate(KINDS) for x in (goal[k][r[j]], float(got[j][number[j][r[j]]])))) for r, q in zip(some, p, strict=True)]
    return Mix(F.broadcast(spark.createDataFrame(made, schema)), spark.createDataFrame(labels, LABELS), budget, error)


def warned(error: float) -> None:
    if error > TOLERANCE:
        warnings.warn(f"a label's share of the draw is {error:.2g} off its target", stacklevel=3)


def fit_there(cells: DataFrame, budget: float | None, targets: Mapping[str, Mapping[str, float]], alpha: Mapping[str, float]) -> Mix:
    """What ``fit_here`` does, over tables: labels and cells may be of any number."""
    total = cells.agg(F.sum("n")).first()[0]
    spark = cells.sparkSession
    labels = {}
    for k in KINDS:
        t = cells.groupBy(F.col(k).alias("label")).agg((F.sum("n") / total).alias("share"))
        if k in targets:
            t = t.join(spark.createDataFrame([(v, float(x)) for v, x in targets[k].items()], "label string, w double"), "label", "left").na.fill(0.0, ["w"])
        else:
            t = t.withColumn("w", F.pow("share", F.lit(float(alpha[k]))))
        whole = t.agg(F.sum("w")).first()[0]
        if not whole:
            raise ValueError("no target covers what is in the table")
        labels[k] = stored(t.select("label", "share", (F.col("w") / whole).alias("asked")), "labels")
    if budget is None:
        budget = min(t.where("asked > 0").agg(F.min(F.col("share") / F.col("asked"))).first()[0] for t in labels.values())
    budget = min([1.0, budget, *(t.where("asked > 0").agg(F.sum("share")).first()[0] for t in labels.values())])
    for k, t in labels.items():
        # A label is full if its target, scaled, is above what it has; a scale only grows, so this ends.
        scale = 1.0
        while True:
            full = F.col("asked") * scale > F.col("share") / budget
            taken, free = t.agg(F.sum(F.when(full, F.col("share") / budget).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("asked")))).first()
            new = (1.0 - taken) / free if free > 0 else scale
            if new <= scale * (1 + 1e-12):
                break
            scale = new
        labels[k] = stored(t.withColumn("target", F.least(F.col("asked") * scale, F.col("share") / budget)), "labels")
    now = cells.select(*KINDS, (F.col("n") / total).alias("n"), *[F.lit(1.0).alias(f"f_{k}") for k in KINDS])
    p = F.least(F.lit(1.0), F.lit(budget) * F.col("f_source") * F.col("f_lang") * F.col("f_topic"))
    error = float("inf")
    for _ in range(ROUNDS):
        for k in KINDS:
            ratio = now.groupBy(k).agg(F.sum(F.col("n") * p).alias("_now"), F.sum(F.when(p >= 1, F.col("n")).otherwise(0.0)).alias("_full")).join(labels[k].select(F.col("label").alias(k), (F.col("target") * budget).alias("_want")), k)
            part = (F.col("_want") > F.col("_full")) & (F.col("_now") > F.col("_full"))
            ratio = ratio.select(k, F.when(part, (F.col("_want") - F.col("_full")) / (F.col("_now") - F.col("_full"))).when(F.col("_now") > 0, F.col("_want") / F.col("_now")).otherwise(1.0).alias("_r"))
            now = now.join(ratio, k).withColumn(f"f_{k}", F.least(F.lit(1e150), F.col(f"f_{k}") * F.col("_r"))).drop("_r")
        now = stored(now, "factors")
        got = {k: now.groupBy(F.col(k).alias("label")).agg((F.sum(F.col("n") * p) / budget).alias("drawn")) for k in KINDS}
        error = max(got[k].join(labels[k], "label").agg(F.max(F.abs(F.col("drawn") - F.col("target")))).first()[0] for k in KINDS)
        if error <= TOLERANCE / 4:
            break
    warned(error)
    out, every = now.select(*KINDS, p.alias("p")), None
    for k in KINDS:
        side = stored(labels[k].join(got[k], "label"), "labels")
        out = out.join(side.select(F.col("label").alias(k), F.col("target").alias(f"{k}_target"), F.col("drawn").alias(f"{k}_drawn")), k)
        one = side.select(F.lit(k).alias("kind"), "label", "share", "asked", "target", "drawn")
        every = one if every is None else every.unionByName(one)
    return Mix(stored(out.select(*KINDS, "p", *[f"{k}_{x}" for k in KINDS for x in ("target", "drawn")]), "cells"), every, budget, error)


def marked_rows(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """docs with the labels of their cell and their tokens, and the names of these columns, which clash with none. The only step that reads texts."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    label = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    names = {k: fresh(docs.columns, f"mix_{k}") for k in (*KINDS, "tokens")}
    low, words = (fresh([*docs.columns, *names.values()], x) for x in ("_low", "_words"))
    made = {"source": label(source_col), "lang": label(lang_col), "topic": label(topic_col) if topic_col else topic_of(text, F.col(low), F.col(words)), "tokens": tokens_of(F.col(words))}
    # Columns of their own, so that the text is lowered and split once.
    rows = docs.withColumn(low, F.lower(text)).withColumn(words, F.split(F.col(low), GAPS))
    return rows.withColumns({names[k]: c for k, c in made.items()}).drop(low, words), names


def weighed(marked: DataFrame, names: Mapping[str, str], budget: float | None, targets: Mapping | None = None, alpha: Mapping | None = None, id_col: str = "doc_id") -> tuple[DataFrame, dict[str, str], Mix | None]:
    """marked rows with weight (by what their cell's share of tokens is multiplied), probability, whether they are drawn, and their labels' targets and expected shares; the names of these columns; the fit. Reads the rows twice."""
    mix = fit(marked.select(*[F.col(f"`{names[k]}`").alias(k) for k in (*KINDS, "tokens")]), budget, targets, alpha)
    extra = [f"{k}_{x}" for k in KINDS for x in ("target", "drawn")]
    names = {**names, **{k: fresh([*marked.columns, *names.values()], f"mix_{k}") for k in ("weight", "probability", "drawn", *extra)}}
    if mix is None:
        whole = marked.withColumns({names["weight"]: F.lit(1.0), names["probability"]: F.lit(1.0), names["drawn"]: F.lit(True), **{names[x]: F.lit(None).cast("double") for x in extra}})
        return whole, names, None
    own = {k: fresh([*marked.columns, *names.values()], f"_cell_{k}") for k in (*KINDS, "p")}
    cells = mix.cells.withColumnsRenamed({**{k: own[k] for k in (*KINDS, "p")}, **{x: names[x] for x in extra}})
    joined = marked.join(cells, [F.col(f"`{names[k]}`") == F.col(own[k]) for k in KINDS], "left")
    chance = F.coalesce(own["p"], F.lit(mix.budget))
    u = (F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit("mix")), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    joined = joined.withColumns({names["weight"]: chance / F.lit(mix.budget), names["probability"]: chance, names["drawn"]: u < chance})
    return joined.drop(*own.values()), names, mix


def probabilities(docs: DataFrame, budget: float | None = 0.8, targets: Mapping | None = None, alpha: Mapping | None = None, id_col: str = "doc_id", **columns: str) -> tuple[DataFrame, dict[str, str], Mix | None]:
    """docs with all that ``weighed`` adds, and the names it has."""
    marked, names = marked_rows(docs, **columns)
    return weighed(marked, names, budget, targets, alpha, id_col)


def report(docs: DataFrame, budget: float | None = 0.8, alpha: Mapping | None = None) -> DataFrame:
    """One row per document: its cell, tokens, weight, probability, draw, and what is asked and expected of its labels."""
    # Texts are read once: the marked rows are narrow without them.
    marked, names = marked_rows(docs.select("doc_id", "source", "lang", "text"))
    got, names, _ = weighed(stored(marked.drop("text"), "marked"), names, budget, alpha=alpha)
    return got.select("doc_id", "source", "lang", *[F.col(names[k]).alias(k) for k in ("topic", "tokens", "weight", "probability", "drawn", *[f"{k}_{x}" for k in KINDS for x in ("target", "drawn")])])


def draw(docs: DataFrame, budget: float | None = 0.8, alpha: Mapping | None = None) -> DataFrame:
    """The documents that are drawn; their columns unchanged."""
    marked, names = marked_rows(docs)
    got, names, _ = weighed(stored(marked, "marked"), names, budget, alpha=alpha)
    return got.where(F.col(names["drawn"])).select(*[F.col(f"`{c}`") for c in docs.columns])
