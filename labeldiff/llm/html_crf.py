"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

Each leaf block (``html_blocks``) is a position of the chain with two states, boilerplate and main text. A block's
features (ancestor tags, names in their attributes, form of its text, place on the page) and pairs of neighbouring
states have weights, trained to maximise the L2-regularised likelihood of labelled pages: forward-backward over all
chains at once, gradient steps with per-weight rates (Adam). Training sees ``TRAIN_PAGES`` pages of a fixed grammar, so
the model does not depend on the data or its size and is the same in each run; it has a few thousand weights, which are
broadcast. Pages are decoded one by one in a single pass without shuffle.

Defined results: null and empty pages, and pages without main text, give an empty text; a page of plain text is one
block; malformed markup never fails; repeated rows are decoded alike; extra columns are kept; whole pages are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh, received, shipped
from labeldiff.llm.html_blocks import blocks
from labeldiff.llm.labelled_pages import labelled_pages

#: Labelled pages, gradient steps, L2 penalty, least number of blocks that have a feature.
TRAIN_PAGES, STEPS, PENALTY, MIN_COUNT = 900, 150, 0.5, 3


#: Weights are whole multiples of this, so sums that come and go with open elements are exact.
UNIT = 2.0**-40


class Crf:
    """weights: feature -> score of main text over boilerplate; moves[a][b]; begins[b]; ends[a]."""

    def __init__(self, weights: dict[str, float], moves, begins, ends):
        self.weights, self.moves, self.begins, self.ends = weights, moves, begins, ends
        self.units = {f: round(w / UNIT) for f, w in weights.items()}

    def decode(self, chain: list[tuple[str, ...]], gains: list[int] | None = None) -> list[int]:
        """The most probable states. gains: what each block has from features that are not listed, in units."""
        if not chain:
            return []
        get, (m00, m01), (m10, m11) = self.units.get, *self.moves
        back, a, b = [], self.begins[0], self.begins[1]
        for k, feats in enumerate(chain):
            gain = (sum([get(f, 0) for f in feats]) + (gains[k] if gains else 0)) * UNIT
            if k:
                from0, from1 = a + m00 >= b + m10, a + m01 >= b + m11
                back.append((0 if from0 else 1, 0 if from1 else 1))
                a, b = max(a + m00, b + m10), max(a + m01, b + m11)
            b += gain
        state = int(b + self.ends[1] > a + self.ends[0])
        path = [state]
        for step in reversed(back):
            state = step[state]
            path.append(state)
        return path[::-1]


def train(pages: list[tuple[str, list[int]]]) -> Crf:
    chains, truth = [], []
    for page, labels in pages:
        feats = [b.features for b in blocks(page)]
        if len(feats) != len(labels):
            raise ValueError("a labelled page has other blocks than labels")
        if feats:
            chains.append(feats)
            truth.append(labels)
    count: dict[str, int] = {}
    for feats in chains:
        for f in (x for b in feats for x in b):
            count[f] = count.get(f, 0) + 1
    names = sorted(f for f, n in count.items() if n >= MIN_COUNT)
    number = {f: k for k, f in enumerate(names)}
    n, width = len(chains), max(map(len, chains))
    size = np.array([len(c) for c in chains])
    y = np.zeros((n, width), int)
    row, col, feat = [], [], []
    for i, feats in enumerate(chains):
        y[i, : len(feats)] = truth[i]
        for t, b in enumerate(feats):
            for f in b:
                if f in number:
                    row.append(i)
                    col.append(t)
                    feat.append(number[f])
    row, col, feat = np.array(row), np.array(col), np.array(feat)
    inside = np.arange(width)[None, :] < size[:, None]
    each = np.arange(n)
    m = len(names)
    theta, first, second = np.zeros(m + 8), np.zeros(m + 8), np.zeros(m + 8)  # weights, 4 moves, 2 begins, 2 ends
    pairs = inside[:, 1:]
    seen = np.zeros(m + 8)
    spot = row * width + col
    seen[:m] = np.bincount(feat, y[row, col], m)
    for a in (0, 1):
        for b in (0, 1):
            seen[m + 2 * a + b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & pairs).sum()
        seen[m + 4 + a] = (y[:, 0] == a).sum()
        seen[m + 6 + a] = (y[each, size - 1] == a).sum()
    for step in range(1, STEPS + 1):
        w, moves, begins, ends = theta[:m], theta[m : m + 4].reshape(2, 2), theta[m + 4 : m + 6], theta[m + 6 :]
        emit = np.zeros((n, width, 2))
        emit[:, :, 1] = np.bincount(spot, w[feat], n * width).reshape(n, width)
        ahead = np.zeros((n, width, 2))
        ahead[:, 0] = begins + emit[:, 0]
        for t in range(1, width):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves[None], axis=1) + emit[:, t]
        behind = np.zeros((n, width, 2))
        behind[each, size - 1] = ends
        for t in range(width - 2, -1, -1):
            after = np.logaddexp.reduce(moves[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where((t < size - 1)[:, None], after, behind[:, t])
        total = np.logaddexp.reduce(ahead[each, size - 1] + ends, axis=1)
        state = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        both = np.exp(ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]) * pairs[:, :, None, None]
        expected = np.zeros(m + 8)
        expected[:m] = np.bincount(feat, state[row, col, 1], m)
        expected[m : m + 4] = both.sum((0, 1)).reshape(-1)
        expected[m + 4 : m + 6] = state[:, 0].sum(0)
        expected[m + 6 :] = state[each, size - 1].sum(0)
        slope = seen - expected - PENALTY * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w = theta[:m]
    return Crf({f: float(x) for f, x in zip(names, w, strict=True)}, theta[m : m + 4].reshape(2, 2).tolist(), theta[m + 4 : m + 6].tolist(), theta[m + 6 :].tolist())


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_pages(TRAIN_PAGES))


def main_text(page: str, model: Crf) -> str:
    chain = blocks(page, model.units)
    states = model.decode([b.features for b in chain], [b.gain for b in chain])
    return "\n".join(b.text for b, s in zip(chain, states, strict=True) if s)


def add_text(model, n_keep: int, names: list[str]):
    def run(batches):
        crf = received(model)
        for batch in batches:
            text = [main_text(p.as_py() or "", crf) for p in batch.column(n_keep)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=names)

    return run


def extract(pages: DataFrame, model: Crf | None = None, html_col: str = "html", keep: list[str] | None = None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The columns ``keep`` (default: all), the main text and its code points, named with underscores behind where a column has that name."""
    keep = pages.columns if keep is None else keep
    text = fresh(keep, text)
    n_chars = fresh([*keep, text], n_chars)
    kept = pages.select(*[F.col(f"`{c}`") for c in keep])
    sent = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias(fresh(keep, "_html")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{text}` string", f"`{n_chars}` long"])
    shared = shipped(pages.sparkSession, model or default_model())
    return sent.mapInArrow(add_text(shared, len(keep), [*keep, text, n_chars]), schema)
