"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's score comes from its own features and those of the
lines beside it; a transition score couples neighbours. Forward-backward gives each
line's marginal, and the length-weighted mean of the marginals is the document's
evidence, which a logistic curve fitted on other labelled rows turns into a score.

Defined cases: null and empty texts are one empty line and get a score like any other; a
very long text is read whole, its features some lines at a time, and its chain is one; an
empty table gives no rows; without labelled rows of both classes every score is the share of good rows (0.5
without any). Repeated rows and ties are scored alike; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

OWN = 14  # features of a line alone
FEATURES = 3 * OWN + 3  # its own, those of the lines before and after, and three about its place
_BYTE = {name: np.zeros(256, bool) for name in ("letter", "upper", "digit", "space", "stop", "odd")}
_BYTE["letter"][list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_BYTE["upper"][65:91] = True
_BYTE["digit"][48:58] = True
_BYTE["space"][[9, 10, 11, 12, 13, 32]] = True
_BYTE["stop"][list(b".,;:!?'\"()-")] = True
_BYTE["odd"][33:127] = True
_BYTE["odd"] &= ~(_BYTE["letter"] | _BYTE["digit"] | _BYTE["stop"])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def line_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, its bytes, the number of lines in each text)."""
    data, starts, ends = blocks.separated(column)
    breaks = np.flatnonzero(data == 10)  # the separator ends a text's last line
    first = np.concatenate(([0], breaks[:-1] + 1))
    size = breaks - first
    doc = np.searchsorted(starts, first, side="right") - 1
    lines = np.bincount(doc, minlength=len(starts))
    add = lambda mask: np.add.reduceat(mask, first, dtype=np.int64)
    letter, space = add(_BYTE["letter"][data]), add(_BYTE["space"][data]) - 1
    ws, we = blocks.runs(~_BYTE["space"][data])
    of = np.searchsorted(first, ws, side="right") - 1
    words = np.bincount(of, minlength=len(first))
    low = _LOWER[data]
    hashes = blocks.range_hashes(blocks.prefix_sums(blocks.BYTE_VALUES[low]), ws, we)
    same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]))) if len(ws) else np.zeros(0, bool)
    order = np.lexsort((hashes, of))
    new = np.ones(len(ws), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    kinds = np.bincount(of[order][new], minlength=len(first))
    odd_word = np.zeros(len(ws), bool)
    if len(ws):
        odd_word = np.add.reduceat(_BYTE["odd"][data], ws, dtype=np.int64) > 0
    text = blocks.range_hashes(blocks.prefix_sums(blocks.BYTE_VALUES[data]), first, breaks)
    order = np.lexsort((text, doc))
    fresh = np.ones(len(first), bool)
    fresh[1:] = (text[order][1:] != text[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    group = np.cumsum(fresh) - 1
    copies = np.zeros(len(first))
    copies[order] = np.bincount(group)[group]
    n, w = np.maximum(size, 1), np.maximum(words, 1)
    last = data[np.maximum(breaks - 1, 0)]
    own = np.column_stack([
        letter / n, add(_BYTE["upper"][data]) / n, add(_BYTE["digit"][data]) / n, space / n, add(_BYTE["stop"][data]) / n, np.sqrt(add(_BYTE["odd"][data]) / n),
        np.log1p(size) / 6, np.log1p(words) / 4, np.minimum((size - space) / w, 20) / 10, np.sqrt(np.bincount(of, same, len(first)) / w), kinds / w,
        np.bincount(of, odd_word, len(first)) / w, (size > 0) & _BYTE["stop"][last], np.minimum(copies - 1, 5) / 5,
    ])
    begin = np.concatenate(([True], doc[1:] != doc[:-1]))
    end = np.concatenate((doc[1:] != doc[:-1], [True]))
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[begin], after[end] = 0, 0
    return np.column_stack([own, before, after, begin, end, np.log1p(lines[doc]) / 5]), np.maximum(size, 1), lines


def _chains(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts from the longest on, so that those with a t-th line are always a first part."""
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    alive = np.searchsorted(-lines[order], -np.arange(1, lines.max() + 1), side="right")
    return order, start, alive


def marginals(unary: np.ndarray, move: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once: P(good) of each line, expected transitions, log partition of each chain."""
    order, start, alive = _chains(lines)
    alpha, beta = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    for t, k in enumerate(alive):
        at = start[:k] + t
        alpha[at] = unary[at] + (np.logaddexp(alpha[at - 1, :1] + move[0], alpha[at - 1, 1:] + move[1]) if t else 0)
    for t in range(len(alive) - 2, -1, -1):
        nxt = start[: alive[t + 1]] + t + 1
        s = unary[nxt] + beta[nxt]
        beta[nxt - 1] = np.logaddexp(move[:, 0] + s[:, :1], move[:, 1] + s[:, 1:])
    final = np.cumsum(lines) - 1
    z = np.logaddexp(alpha[final, 0], alpha[final, 1])
    each = np.repeat(z, lines)
    good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - each, 0))
    inner = np.ones(len(unary), bool)
    inner[np.cumsum(lines) - lines] = False
    j = np.flatnonzero(inner)
    pair = np.exp(alpha[j - 1][:, :, None] + move + (unary[j] + beta[j])[:, None, :] - each[j][:, None, None])
    return good, pair.sum(axis=0), z


def train(x: np.ndarray, lines: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of the chains whose lines all carry their text's label, by Adam on the mean log-likelihood."""
    label = np.repeat(y, lines).astype(np.float64)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(lines) - lines] = False
    pair_label = label[inner].astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (pair_label, pair_label), 1)
    theta, m, v = np.zeros(x.shape[1] + 5), 0.0, 0.0
    weight = len(x)
    for step in range(1, rounds + 1):
        w, b, move = theta[: x.shape[1]], theta[x.shape[1]], theta[-4:].reshape(2, 2)
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ w + b
        good, pairs, _ = marginals(unary, move, lines)
        gap = label - good
        grad = np.concatenate((x.T @ gap, [gap.sum()], (seen - pairs).ravel())) / weight - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[: x.shape[1] + 1], theta[-4:].reshape(2, 2)


#: A text of more lines than this is scored by itself, so many lines at a time.
LONG = 20_000


def long_chain(unary: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(good) of each line of one chain, as marginals() has it, from the log-odds of each line alone; step by step, in a few numbers a line."""
    (m00, m01), (m10, m11) = np.exp(move - move.max()).tolist()
    n, own = len(unary), np.clip(unary, -50, 50).tolist()
    ahead, behind = [0.0] * n, [0.0] * n
    odds = 0.0  # log-odds of good by what comes before, and then by what comes after
    for t in range(n):
        if t:
            e = math.exp(ahead[t - 1])
            odds = math.log((m01 + m11 * e) / (m00 + m10 * e))
        ahead[t] = min(max(odds + own[t], -600.0), 600.0)
    odds = 0.0
    for t in range(n - 2, -1, -1):
        e = math.exp(min(max(odds + own[t + 1], -600.0), 600.0))
        odds = behind[t] = math.log((m10 + m11 * e) / (m00 + m01 * e))
    return 1 / (1 + np.exp(-np.clip(np.array(ahead) + np.array(behind), -700, 700)))


def long_features(text: bytes, at_once: int = LONG):
    """Yields (features, bytes) of the lines of one text, at_once lines at a time, as line_features() has them of the whole text."""
    data = np.frombuffer(text + b"\n", np.uint8)
    stops = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], stops[:-1] + 1))
    n, cuts = len(stops), list(range(0, len(stops), at_once))
    hashes = np.empty(n, np.uint64)
    for a in cuts:
        b = min(n, a + at_once)
        part = data[starts[a] : stops[b - 1] + 1]
        hashes[a:b] = blocks.range_hashes(blocks.prefix_sums(blocks.BYTE_VALUES[part]), starts[a:b] - starts[a], stops[a:b] - starts[a])
    _, of, count = np.unique(hashes, return_inverse=True, return_counts=True)
    copies = np.minimum(count[of] - 1, 5) / 5
    for a in cuts:
        b = min(n, a + at_once)
        lo, hi = max(0, a - 1), min(n, b + 1)  # with the lines beside
        x, size, _ = line_features(pa.array([data[starts[lo] : stops[hi - 1]].tobytes()], pa.binary()))
        near = np.concatenate(([0.0] * (lo == 0), copies[lo:hi], [0.0] * (hi == n)))
        near = near if lo == 0 else np.concatenate(([0.0], near))
        near = near if hi == n else np.concatenate((near, [0.0]))
        x[:, OWN - 1], x[:, 2 * OWN - 1], x[:, 3 * OWN - 1] = copies[lo:hi], near[:-2], near[2:]
        x[:, -1] = np.log1p(n) / 5
        inner = slice(a - lo, a - lo + b - a)
        x, size = x[inner], size[inner]
        x[:, -3], x[:, -2] = np.arange(a, b) == 0, np.arange(a, b) == n - 1
        yield x, size


@dataclass
class QualityModel:
    weights: np.ndarray | None
    move: np.ndarray | None
    curve: tuple[float, float, float]
    prior: float

    def lines(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of every line, its length, and the number of lines in each text."""
        x, size, lines = line_features(column)
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ self.weights[:-1] + self.weights[-1]
        return marginals(unary, self.move, lines)[0], size, lines

    def evidence(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The length-weighted mean of the marginals, and the same of their limited log-odds."""
        good, size, lines = self.lines(column)
        first = np.cumsum(lines) - lines
        mean = lambda v: np.add.reduceat(v * size, first) / np.add.reduceat(size, first)
        p = np.clip(good, 1e-4, 1 - 1e-4)
        return mean(good), mean(np.log(p / (1 - p)))

    def long_evidence(self, text: bytes) -> tuple[float, float]:
        """evidence() of one text of very many lines."""
        unary, size = (np.concatenate(parts) for parts in zip(*((x @ self.weights[:-1] + self.weights[-1], size) for x, size in long_features(text))))
        good = long_chain(unary, self.move)
        p = np.clip(good, 1e-4, 1 - 1e-4)
        return float(np.average(good, weights=size)), float(np.average(np.log(p / (1 - p)), weights=size))

    def score(self, column) -> np.ndarray:
        if self.weights is None:
            return np.full(len(column), self.prior)
        a, b, c = self.curve
        raw, off = blocks.utf8(column)
        if len(off) == 2 and np.count_nonzero(raw == 10) > LONG:  # sliced() gives a large text alone
            good, odds = (np.array([v]) for v in self.long_evidence(raw.tobytes()))
        else:
            good, odds = self.evidence(column)
        return 1 / (1 + np.exp(-np.clip(a + b * good + c * odds, -35, 35)))


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", doc_id: str = "doc_id", max_rows: int = 6000, max_lines: int = 300_000) -> QualityModel:
    """labelled has doc_id, text and label (0 or 1). About max_rows rows are used, of about max_lines lines, none with more than a fiftieth of these: lines of two thirds train the field, the rest the curve."""
    from .toxicity import _logistic

    rows = labelled.where(labelled[label].isNotNull()).select(labelled[doc_id].alias("doc_id"), labelled[text].alias("text"), labelled[label].cast("long").alias("y"))
    # how many rows there are is told without their texts; lines are counted in the rows of the sample only
    total = rows.count()
    if total > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * max_rows / total) + 1)
    n_lines = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))) + 1
    rows = rows.where(n_lines <= max_lines // 50)
    of_lines = rows.agg(F.coalesce(F.sum(n_lines), F.lit(0))).first()[0]
    if of_lines > max_lines:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * max_lines / of_lines) + 1)

    def featured(batches):
        for batch in blocks.sliced(batches, "text"):
            x, size, lines = line_features(batch.column(1))
            first = np.cumsum(lines) - lines
            flat = x.astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([flat[s : s + k].tobytes() for s, k in zip(first, lines)], pa.binary()), pa.array([size[s : s + k].astype(np.int64).tobytes() for s, k in zip(first, lines)], pa.binary())], names=["doc_id", "y", "x", "size"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.select("doc_id", "text", "y").mapInArrow(featured, f"doc_id {kind}, y long, x binary, size binary").toPandas()  # bounded by max_lines
    if got["y"].nunique() < 2:
        return QualityModel(None, None, (0.0, 0.0, 0.0), float(got["y"].mean()) if len(got) else 0.5)
    got = got.sort_values("doc_id", kind="stable", ignore_index=True)
    y, part = got["y"].to_numpy(), np.arange(len(got)) % 3
    chains = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["x"]]
    lines = np.array([len(c) for c in chains])
    pick = np.flatnonzero(part > 0) if len(set(y[part > 0])) == 2 and len(set(y[part == 0])) == 2 else np.arange(len(got))
    weights, move = train(np.concatenate([chains[i] for i in pick]).astype(np.float64), lines[pick], y[pick])
    model = QualityModel(weights, move, (0.0, 0.0, 0.0), float(y.mean()))
    rest = np.flatnonzero(part == 0) if len(pick) < len(got) else pick
    x, n = np.concatenate([chains[i] for i in rest]).astype(np.float64), lines[rest]
    unary = np.zeros((len(x), 2))
    unary[:, 1] = x @ weights[:-1] + weights[-1]
    good = marginals(unary, move, n)[0]
    size = np.concatenate([np.frombuffer(got["size"][i], np.int64) for i in rest])
    first = np.cumsum(n) - n
    p = np.clip(good, 1e-4, 1 - 1e-4)
    mean = lambda v: np.add.reduceat(v * size, first) / np.add.reduceat(size, first)
    model.curve = tuple(_logistic(np.column_stack([mean(good), mean(np.log(p / (1 - p)))]), y[rest], 0.1))
    return model


def predict(docs: DataFrame, model: QualityModel, threshold: float = 0.7, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            score = shared.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
