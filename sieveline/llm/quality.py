"""Quality classifier (operator 8): a linear-chain conditional random field over a document's lines.

Every line is good or bad. Its features are coarse bins of surface signals (letter cases, symbols, separators,
repeated words, lengths) of the line itself and of the lines before and after it. Only documents are labelled, so the
lines' labels are learnt in rounds: at first a line has its document's label; then lines of bad documents that look
good by themselves are good (one line at least stays bad), so that the transitions see good lines beside bad ones.
Forward-backward gives every line's marginal of being good; the document's quality is the mean of the marginals
weighted by line length, put on a probability scale by a logistic fit on the training documents.

The model is fitted on at most SAMPLE labelled documents outside the held-out fold, of at most SAMPLE_LINES lines
together; their features, not their texts, come to the driver. Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null counts as empty; an empty text is one empty line and gets a score; long texts are scored whole;
equal texts have equal scores; without usable labels of both classes every score is 0.5; an empty table gives an
empty result; other columns are not read by `scores` and are kept as they are by `accepted`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import Stages, pick, text_steps
from sieveline.llm.samples import held_out, labelled_sample

#: labelled documents that the model is fitted on, at most
SAMPLE = 4000
#: lines of these together, at most: documents that don't fit any more, in the order of a hash, are left out
SAMPLE_LINES = 400_000
#: documents of a lower score are rejected
CUT = 0.3

_LOWER, _UPPER, _DIGITS = bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58))
_COMMON = b" \t.,;:'\"-()?"
_OTHER_ASCII = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _COMMON)
#: upper ends of the bins of each signal
EDGES = (
    (0.02, 0.08, 0.2, 0.5, 0.8),  # upper-case letters among ASCII letters
    (0.002, 0.01, 0.04, 0.1, 0.2),  # unusual symbols among bytes
    (0.01, 0.03, 0.1, 0.3),  # digits among bytes
    (0.02, 0.1, 0.3, 0.6),  # words equal to the word before
    (0.2, 0.4, 0.6, 0.8, 0.95),  # distinct words among words
    (0.02, 0.1, 0.3),  # words of one byte that is no letter or digit
    (2.5, 4, 6, 8, 12, 20),  # bytes for each word
    (0, 20, 60, 150, 400, 1200),  # bytes
    (0.5,),  # the line stood before in the document
)
BINS = [len(e) + 1 for e in EDGES]
OWN = sum(BINS)
#: one-hot bins of the line and of its neighbours, a bin for "no neighbour" each, and a constant
WIDTH = 3 * OWN + 3


def line_signals(line: bytes, seen: set) -> tuple:
    n = len(line)
    words = line.split()
    k = len(words)
    lower, upper = n - len(line.translate(None, _LOWER)), n - len(line.translate(None, _UPPER))
    letters, size, count = lower + upper or 1, n or 1, k or 1
    again = line in seen
    seen.add(line)
    lone = 0
    if b" | " in line or b" - " in line or b" * " in line:
        lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    return (
        upper / letters,
        (n - len(line.translate(None, _OTHER_ASCII))) / size,
        (n - len(line.translate(None, _DIGITS))) / size,
        sum(map(eq, words, words[1:])) / count,
        len(set(words)) / count if k else 1.0,
        lone / count,
        n / count,
        n,
        float(again),
    )


def document_lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split(b"\n")


def binned(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the lines of all texts: bins (lines x signals, as columns of the one-hot block), lengths, lines of each text."""
    signals, counts = [], []
    for text in texts:
        seen: set = set()
        lines = document_lines(text)
        signals += [line_signals(x, seen) for x in lines]
        counts.append(len(lines))
    values = np.array(signals)
    base = np.concatenate(([0], np.cumsum(BINS)[:-1]))
    bins = np.stack([np.searchsorted(np.array(e), values[:, i], "left") for i, e in enumerate(EDGES)], axis=1) + base
    return bins, values[:, 7] + 1, np.array(counts)


def features(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the active features of every line."""
    ends = np.cumsum(counts)
    first, last = np.zeros(len(bins), dtype=bool), np.zeros(len(bins), dtype=bool)
    first[ends - counts], last[ends - 1] = True, True
    before = np.concatenate((bins[:1], bins[:-1])) + OWN
    after = np.concatenate((bins[1:], bins[-1:])) + 2 * OWN
    before[first], after[last] = 3 * OWN, 3 * OWN + 1
    return np.concatenate((bins, before, after, np.full((len(bins), 1), 3 * OWN + 2)), axis=1)


class Chains:
    """Lines of many documents, walked position by position: step t holds the t-th line of every document that has one."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left") if len(sizes) else []
        self.steps = [starts[:a] + t for t, a in enumerate(active)]

    def marginals(self, local: np.ndarray, trans: np.ndarray, pairs: bool = False):
        """Marginals of state 1 and, if asked, the expected transition counts, by scaled forward-backward."""
        p = np.exp(local - local.max(axis=1, keepdims=True))
        a = np.exp(trans)
        forward, backward = np.empty_like(p), np.empty_like(p)
        for t, at in enumerate(self.steps):
            f = p[at] * (forward[self.steps[t - 1][: len(at)]] @ a) if t else p[at]
            forward[at] = f / f.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(len(self.steps) - 1, -1, -1):
            at = self.steps[t]
            b = np.ones((len(at), 2))
            if t + 1 < len(self.steps):
                following = self.steps[t + 1]
                x = p[following] * backward[following]
                here = x @ a.T
                scale = here.sum(axis=1, keepdims=True)
                b[: len(following)] = here / scale
                if pairs:
                    joint = forward[at[: len(following)], :, None] * a * x[:, None, :]
                    expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            backward[at] = b
        m = forward * backward
        m = m[:, 1] / m.sum(axis=1)
        return (m, expected) if pairs else m


@dataclass
class Model:
    weights: np.ndarray  # of state good against bad, by feature
    trans: np.ndarray
    slope: float
    shift: float

    def lines(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Every line's marginal of being good."""
        local = np.zeros((len(bins), 2))
        local[:, 1] = self.weights[features(bins, counts)].sum(axis=1)
        return Chains(counts).marginals(local, self.trans)

    def qualities(self, bins: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The length-weighted mean of the lines' marginals and the number of bad lines, by document."""
        good = self.lines(bins, counts)
        cut = np.cumsum(counts) - counts
        return np.add.reduceat(good * lengths, cut) / np.add.reduceat(lengths, cut), np.add.reduceat(good < 0.5, cut, dtype=np.int64)

    def quality(self, texts: list) -> np.ndarray:
        return self.qualities(*binned(texts))[0]

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(quality) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _adam(gradient: Callable, x: np.ndarray, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def fit(texts: list, labels: np.ndarray, steps: int = 120) -> Model:
    return fit_lines(*binned(texts), labels, steps) if len(texts) else NONE


NONE = Model(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, 0.0)


def fit_lines(bins: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 120) -> Model:
    labels = np.asarray(labels)
    if len(set(labels.tolist())) < 2:
        return NONE
    active, chains, n = features(bins, counts), Chains(counts), len(bins)
    flat, own = active.ravel(), np.repeat(labels, counts)
    first = np.zeros(n, dtype=bool)
    first[np.cumsum(counts) - counts] = True

    def trained(line_label: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Weights and transitions for lines of known labels."""
        pairs = 2 * line_label[:-1][~first[1:]] + line_label[1:][~first[1:]]
        seen = np.bincount(pairs, minlength=4)[:4]
        held = np.bincount(active[line_label == 1].ravel(), minlength=WIDTH)

        def gradient(x):
            local = np.zeros((n, 2))
            local[:, 1] = x[:WIDTH][active].sum(axis=1)
            good, expected = chains.marginals(local, x[WIDTH:].reshape(2, 2), pairs=True)
            g = np.bincount(flat, weights=np.repeat(good, active.shape[1]), minlength=WIDTH) - held
            return np.concatenate((g, expected.ravel() - seen)) / n + 1e-4 * x

        return _adam(gradient, start, steps, 0.1)

    x = trained(own, np.zeros(WIDTH + 4))
    # a line by itself, without its chain: how often lines of its bins stand in good documents, by naive odds
    alone = bins.astype(np.int64)
    good, bad = (np.bincount(alone[own == k].ravel(), minlength=OWN)[:OWN] + 1.0 for k in (1, 0))
    odds = (np.log(good / good.sum()) - np.log(bad / bad.sum()))[alone].sum(axis=1)
    worst = np.minimum.reduceat(odds, np.flatnonzero(first))
    x = trained(np.where((own == 0) & (odds > 0) & (odds > np.repeat(worst, counts)), 1, own), x)
    model = Model(x[:WIDTH], x[WIDTH:].reshape(2, 2), 1.0, 0.0)
    z = _logit(model.qualities(bins, lengths, counts)[0])

    def logistic(ab):
        r = 1 / (1 + np.exp(-(ab[0] * z + ab[1]))) - labels
        return np.array([(r * z).mean(), r.mean()]) + 1e-3 * (ab - np.array([1.0, 0.0]))

    model.slope, model.shift = _adam(logistic, np.array([1.0, 0.0]), 300, 0.05).tolist()
    return model


def fitted(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, most_lines: int = SAMPLE_LINES) -> Model:
    def work(batches):
        for batch in batches:
            for d, h, text, label in zip(*(batch.column(k) for k in range(4)), strict=True):
                bins, lengths, _ = binned([text.as_py()])
                columns = [[d.as_py()], [h.as_py()], [label.as_py()], [len(bins)], [bins.astype(np.uint8).tobytes()], [lengths.astype(np.int64).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["doc_id", "h", "label", "n", "bins", "lengths"])

    stages = Stages(docs.sparkSession, "quality")
    lines = stages.write(labelled_sample(docs, labels, "quality", most).mapInArrow(work, "doc_id long, h long, label int, n long, bins binary, lengths binary"), "lines")
    held, chosen = 0, []
    for r in sorted(lines.select("h", "doc_id", "n").collect()):  # `most` rows of three numbers
        if held + r.n <= most_lines:
            held += r.n
            chosen.append(r.doc_id)
    if not chosen:
        return NONE
    rows = sorted(lines.where(F.col("doc_id").isin(chosen)).collect(), key=lambda r: (r.h, r.doc_id))  # `most_lines` lines
    bins = np.concatenate([np.frombuffer(r.bins, dtype=np.uint8).reshape(-1, len(EDGES)) for r in rows]).astype(np.int64)
    return fit_lines(bins, np.concatenate([np.frombuffer(r.lengths, dtype=np.int64) for r in rows]), np.array([r.n for r in rows]), np.array([r.label for r in rows]))


def _scored(model: Model, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of lines, and number of bad lines of each text."""
    out = [(np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for step in text_steps(texts):
        own = binned(step)
        quality, bad = model.qualities(*own)
        out.append((model.score(quality), own[2], bad))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def line_labels(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, line (from 0), p_good and good (1 from a half on) of every line of every row."""

    def work(batches):
        for batch in batches:
            for d, text in zip(batch.column(0), batch.column(1), strict=True):
                bins, _, counts = binned([text.as_py()])
                p = model.lines(bins, counts)
                yield pa.RecordBatch.from_arrays([pa.array([d.as_py()] * len(p), pa.int64()), pa.array(np.arange(len(p))), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "line", "p_good", "good"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, line long, p_good double, good int")


def scores(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `cut` on), n_lines and n_bad_lines of every row."""
    model = fitted(docs, labels, most)

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, _scored(model, batch.column(1).to_pylist()))], ["doc_id", "score", "n_lines", "n_bad_lines"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, score double, n_lines long, n_bad_lines long").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "n_lines", "n_bad_lines")


def accepted(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns."""
    model = fitted(docs, labels, most)
    text = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scored(model, batch.column(text).to_pylist())[0] >= cut))

    return docs.mapInArrow(work, docs.schema)
