"""Toxicity (operator 1): cumulative-link ordinal regression over sparse text features.

Features are the distinct lower-case words of a text and the distinct beginnings of its words. The labels only say
toxic or not, so the grades to learn are derived from them: 0 for clean documents, and for toxic ones 1 to 3 by
thirds of the number of distinct marked words (words that occur in several toxic documents of the sample and hardly
in clean ones). P(grade > k) = logistic(w.x - theta_k): one weight vector for all thresholds, which are ordered. A
proximal step keeps the weights sparse, and only features that are more frequent in toxic documents than by chance
are fitted, so that long clean texts gather no weight. The output is the expected severity, the sum of P(grade > k) over k.

The model is fitted on at most SAMPLE labelled documents outside the held-out fold. Their features are counted where the
texts are; the driver gets the at most FEATURES most telling ones, and which of them each document has. Words of over LONGEST characters
count by their beginning only.

Defined cases: null counts as empty; an empty text has the severity of no features; texts are read whole; equal texts
have equal severities; without labels of both classes every severity is 0; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import Stages, pick
from sieveline.llm.samples import labelled_sample

#: labelled documents that the model is fitted on, at most
SAMPLE = 8000
#: features that are fitted, at most
FEATURES = 50_000
GRADES = 4
PREFIX = 5
LONGEST = 64
#: documents that a feature must occur in, and that a marked word must
COMMON, MARKED = 4, 5
#: standard deviations by which a feature must be more frequent in toxic documents
TELLING = 4
#: words whose features a worker remembers
REMEMBERED = 500_000

_WORD = re.compile(r"\w+")


def word_set(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def word_features(word: str) -> tuple[str, ...]:
    own = (f"{word[:PREFIX]}-",) if len(word) > PREFIX else ()
    return own if len(word) > LONGEST else (word, *own)


@dataclass
class Model:
    weights: dict[str, float]
    theta: np.ndarray  # ordered thresholds
    _known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "theta": self.theta}

    def __setstate__(self, state):
        self.__init__(**state)

    def strength(self, text: str | None) -> float:
        """w.x of a text."""
        known, found = self._known, set()
        for word in word_set(text):
            own = known.get(word)
            if own is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                own = known[word] = tuple(f for f in word_features(word) if f in self.weights)
            if own:
                found.update(own)
        return sum(self.weights[f] for f in sorted(found))

    def above(self, strength: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return _logistic(np.asarray(strength)[:, None] - self.theta)

    def severity(self, texts: list) -> np.ndarray:
        return self.above(np.array([self.strength(t) for t in texts], dtype=float)).sum(axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def is_marked(is_word, every, inside):
    """Whether a feature is a word of toxic documents: numbers of arrays or columns."""
    return is_word & (inside >= MARKED) & (every - inside <= inside / 20)


def grades(marked: np.ndarray, toxic: np.ndarray, n: int = GRADES) -> np.ndarray:
    """Grade 0 for clean documents, 1 to n - 1 for toxic ones by their number of distinct marked words."""
    cuts = np.quantile(marked[toxic == 1], [k / (n - 1) for k in range(1, n - 1)])
    return np.where(toxic == 1, 1 + (marked[:, None] > cuts).sum(axis=1), 0)


def fit(rows: Iterable[tuple[str, int]]) -> Model:
    """From texts and whether they are toxic; for small samples: `fitted` does the same by Spark."""
    rows = list(rows)
    toxic = np.array([label for _, label in rows])
    sets = [{f for w in word_set(text) for f in word_features(w)} for text, _ in rows]
    every, inside = Counter(f for s in sets for f in s), Counter(f for s, t in zip(sets, toxic, strict=True) if t for f in s)
    share = toxic.mean() if len(toxic) else 0
    names = sorted(f for f, n in every.items() if n >= COMMON and inside[f] - n * share > TELLING * np.sqrt(n * share * (1 - share)))
    words = {f for f, n in every.items() if is_marked(not f.endswith("-"), n, inside[f])}
    place = {f: k for k, f in enumerate(names)}
    pairs = [(i, place[f]) for i, s in enumerate(sets) for f in s if f in place]
    return fit_features(names, np.array(pairs, dtype=np.int64).reshape(-1, 2), toxic, np.array([len(s & words) for s in sets], dtype=np.int64))


def fit_features(names: list[str], pairs: np.ndarray, toxic: np.ndarray, marked: np.ndarray, penalty: float = 1e-4, steps: int = 400) -> Model:
    """From the features' names, the pairs (document, feature), and each document's label and number of marked words."""
    if len(set(toxic.tolist())) < 2:
        return Model({}, np.full(GRADES - 1, 40.0))
    grade = grades(marked, toxic)
    row, col = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].T
    n, at = len(toxic), np.arange(len(toxic))
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / n

    def gradient(w, theta):
        """Of the negative log-likelihood, with P(grade = k) = P(> k - 1) - P(> k)."""
        score = np.bincount(row, weights=w[col], minlength=n)
        up = np.concatenate((np.ones((n, 1)), _logistic(score[:, None] - theta), np.zeros((n, 1))), axis=1)
        p, d = np.maximum(up[at, grade] - up[at, grade + 1], 1e-9), up * (1 - up)
        dz = (d[at, grade] - d[at, grade + 1]) / p * weight
        gw = -np.bincount(col, weights=dz[row], minlength=len(names))
        gt = [(((grade == k + 1).astype(float) - (grade == k)) * d[:, k + 1] / p * weight).sum() for k in range(GRADES - 1)]
        return gw, np.array(gt)

    # the step follows from the largest curvature, by power iteration over features and thresholds
    v, curve = np.ones(len(names) + 1), 1.0
    for _ in range(30):
        z = (np.bincount(row, weights=v[:-1][col], minlength=n) - v[-1]) * weight
        v = np.concatenate((np.bincount(col, weights=z[row], minlength=len(names)), [-z.sum()]))
        curve = np.linalg.norm(v) or 1.0
        v = v / curve
    rate = 1 / curve
    w, theta = np.zeros(len(names)), np.linspace(0.5, 1.5, GRADES - 1)
    vw, vt = w, theta
    for t in range(1, steps + 1):
        gw, gt = gradient(vw, vt)
        new_w = vw - rate * gw
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
        new_t = np.sort(vt - rate * gt)
        m = (t - 1) / (t + 2)
        vw, vt = new_w + m * (new_w - w), np.sort(new_t + m * (new_t - theta))
        w, theta = new_w, new_t
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if x}, theta)


def fitted(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, most_features: int = FEATURES) -> Model:
    def work(batches):
        for batch in batches:
            for d, text, label in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                own = ["", *sorted({f for w in word_set(text.as_py()) for f in word_features(w)})]  # a text without words has a row, too
                yield pa.RecordBatch.from_arrays([pa.array([d.as_py()] * len(own), pa.int64()), pa.array([label.as_py()] * len(own), pa.int32()), pa.array(own, pa.string())], ["doc_id", "label", "f"])

    stages = Stages(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels, "toxic", most)
    held = stages.write(sample.mapInArrow(work, "doc_id long, label int, f string"), "features")
    rows = sorted(held.groupBy("doc_id").agg(F.max("label").alias("label")).collect())  # `most` rows of two numbers
    toxic = np.array([r.label for r in rows], dtype=np.int64)
    if len(set(toxic.tolist())) < 2:
        return fit_features([], np.zeros((0, 2), dtype=np.int64), toxic, toxic)
    share = float(toxic.mean())
    stats = held.where("f <> ''").groupBy("f").agg(F.count("*").alias("every"), F.sum("label").alias("inside"))
    more = (F.col("inside") - F.col("every") * share) / F.sqrt(F.col("every") * (share * (1 - share)))
    is_word = is_marked(~F.col("f").endswith("-"), F.col("every"), F.col("inside"))
    stats = stats.select("f", (F.col("every") >= COMMON).alias("common"), more.alias("more"), is_word.alias("marked"))
    stats = stages.write(stats.where((F.col("common") & (F.col("more") > TELLING)) | F.col("marked")), "telling")
    names = sorted(r.f for r in stats.where("common and more > %d" % TELLING).orderBy(F.desc("more"), "f").limit(most_features).collect())
    place, doc = {f: k for k, f in enumerate(names)}, {r.doc_id: k for k, r in enumerate(rows)}
    # the features of a document that are fitted: a small share of its words
    own = held.join(stats, "f").groupBy("doc_id").agg(F.count_if("marked").alias("marked"), F.collect_list(F.when(F.col("common") & (F.col("more") > TELLING), F.col("f"))).alias("fs")).collect()
    marked, pairs = np.zeros(len(rows), dtype=np.int64), []
    for r in own:
        marked[doc[r.doc_id]] = r.marked
        pairs += [(doc[r.doc_id], place[f]) for f in r.fs if f in place]
    return fit_features(names, np.array(pairs, dtype=np.int64).reshape(-1, 2), toxic, marked)


def severities(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, severity (0 to GRADES - 1), p_toxic (P(grade > 0)), grade (the likeliest) and toxic (p_toxic of a half or more)."""
    model = fitted(docs, labels, most)

    def work(batches):
        for batch in batches:
            up = model.above(np.array([model.strength(t) for t in batch.column(1).to_pylist()], dtype=float).reshape(-1))
            each = -np.diff(np.concatenate((np.ones((len(up), 1)), up, np.zeros((len(up), 1))), axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(up.sum(axis=1)), pa.array(up[:, 0]), pa.array(each.argmax(axis=1).astype(np.int32))], ["doc_id", "severity", "p_toxic", "grade"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, severity double, p_toxic double, grade int").withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))
