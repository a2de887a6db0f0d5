"""Learnt operators: held-out accuracy, and the probabilities against enumeration. The pipeline."""

from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import quality, toxicity
from sieveline.llm.common import table
from sieveline.llm.queries import QUERIES

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def area(scores, labels):
    rank = np.argsort(np.argsort(scores))
    n1 = labels.sum()
    return (rank[labels == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(labels) - n1))


def test_quality_of_held_out_documents(spark):
    rows = QUERIES["op8_quality_classifier"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert area(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.97
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95 and rows["score"].between(0, 1).all()


def test_toxicity_of_held_out_documents(spark):
    from sieveline.llm.samples import held_out

    # words of four languages: the smaller tables have a handful of toxic documents of each
    rows = QUERIES["op1_toxicity"](spark, LARGER).join(table(spark, LARGER, "labels").select("doc_id", F.col("toxic").alias("label")), "doc_id").where(held_out(F.col("doc_id"))).toPandas()
    assert area(rows["severity"].to_numpy(), rows["label"].to_numpy()) > 0.95
    assert (rows["toxic"] == rows["label"]).mean() > 0.95 and rows["severity"].between(0, toxicity.GRADES - 1).all()
    # the order of the grades, on documents that nothing was fitted on: words that only toxic documents of this fold hold
    texts = {r["doc_id"]: set(r["text"].lower().split()) for r in table(spark, LARGER, "documents").where(held_out(F.col("doc_id"))).join(table(spark, LARGER, "labels").select("doc_id"), "doc_id").collect()}
    toxic_of = dict(zip(rows["doc_id"], rows["label"], strict=True))
    inside, outside = Counter(w for i, t in texts.items() if toxic_of[i] for w in t), {w for i, t in texts.items() if not toxic_of[i] for w in t}
    bad = {w for w, n in inside.items() if n >= 3 and w not in outside}
    marked = rows[rows["label"] == 1].assign(n=lambda r: [len(texts[i] & bad) for i in r["doc_id"]])
    print("rank correlation of severity and marked words, held out:", marked["severity"].corr(marked["n"], method="pearson"))
    by_grade = marked.groupby("grade")["n"].mean()
    assert marked["severity"].rank().corr(marked["n"].rank()) > 0.5 and by_grade.is_monotonic_increasing


def test_spark_and_plain_fits_agree(spark):
    """The model that Spark's counts give is the one of the plain version over the same sample."""
    from sieveline.llm.samples import labelled_sample

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = sorted(labelled_sample(docs, labels, "toxic", 300).collect(), key=lambda r: r["doc_id"])
    plain, own = toxicity.fit((r["text"], r["label"]) for r in rows), toxicity.fitted(docs, labels, 300)
    assert plain.weights == own.weights and plain.weights and (plain.theta == own.theta).all()


def test_the_sample_follows_from_the_rows(spark):
    """Of several texts with one doc_id the same one is chosen, however the rows are dealt."""
    from sieveline.llm.samples import labelled_sample

    rows = [(i % 40, f"text {i} " * (1 + i % 7)) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = [sorted(map(tuple, labelled_sample(spark.createDataFrame(rows, "doc_id long, text string").repartition(n, F.rand(n)), labels, "quality", 30).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) <= 30


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 5, 2])
    local, trans = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    got, pairs = quality.Chains(counts).marginals(local, trans, pairs=True)
    at, want, expected = 0, [], np.zeros((2, 2))
    for n in counts:
        total, own, trans_sum = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in product((0, 1), repeat=int(n)):
            w = np.exp(sum(local[at + i, s] for i, s in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            own += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                trans_sum[a, b] += w
        want += (own / total).tolist()
        expected += trans_sum / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, expected)


def test_thresholds_share_weights_and_are_ordered():
    rng = np.random.default_rng(1)
    bad = ["vile", "rotten", "awful", "nasty"]
    texts, labels = [], []
    for _ in range(400):
        words = [f"w{i}" for i in rng.integers(0, 60, 30)]
        n = int(rng.integers(0, 5)) if rng.random() < 0.4 else 0
        texts.append(" ".join(words + bad[:n]))
        labels.append(int(n > 0))
    model = toxicity.fit(zip(texts, labels, strict=True))
    assert (np.diff(model.theta) >= 0).all() and set(model.weights) <= {f for w in bad for f in toxicity.word_features(w)} | set(model.weights)
    clean, mild, severe = model.severity(["w1 w2 w3", "w1 vile w2", "w1 vile rotten awful nasty"])
    assert clean < mild < severe
    up = model.above(np.array([model.strength(texts[0])]))
    assert (np.diff(up, axis=1) <= 0).all()


@pytest.mark.parametrize("operator", ["quality", "toxicity"])
def test_odd_rows_get_a_score(spark, docs, none, operator):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (8, 0, 1), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    run = quality.scores if operator == "quality" else toxicity.severities
    assert run(docs, labels).count() == 12
    assert run(none, labels).count() == 0 and run(docs, labels.limit(0)).count() == 12
    if operator == "quality":
        assert {r["score"] for r in run(docs, labels.limit(0)).collect()} == {0.5}
        assert quality.accepted(docs, labels).schema == docs.schema


def test_bad_lines_of_a_mixed_document_are_told(spark):
    """Documents are labelled, lines are not: good lines of bad documents come out as good, their neighbours as bad."""
    good = [f"An ordinary sentence about gears and shafts, number {'one two three four five six seven'.split()[i % 7]}." for i in range(7)]
    rng = np.random.default_rng(3)
    texts, labels, truth = [], [], []
    for k in range(300):
        bad = k % 2
        lines = [good[i] for i in rng.integers(0, 7, 12)]
        kinds = np.zeros(12, dtype=int)
        if bad:
            at = int(rng.integers(0, 8))
            kinds[at : at + 4] = 1
            lines = ["## $$ @@ || ## %% ^^" if x else line for line, x in zip(lines, kinds, strict=True)]
        texts.append("\n".join(lines))
        labels.append(1 - bad)
        truth.append(1 - kinds)
    model = quality.fit(texts[:200], np.array(labels[:200]))
    rows = quality.line_labels(spark.createDataFrame(list(enumerate(texts[200:])), "doc_id long, text string"), model).orderBy("doc_id", "line").collect()
    got = np.array([r["good"] for r in rows]).reshape(100, 12)
    assert (got == np.array(truth[200:])).mean() > 0.97
    score = model.score(model.quality(texts[200:]))
    assert ((score >= 0.5) == np.array(labels[200:])).all()


def test_long_document_is_scored_whole():
    good, bad = "An ordinary sentence about gears and shafts.", "AB## CD## AB## CD## AB## CD##"
    model = quality.fit(["\n".join([good] * 5), "\n".join([bad] * 5)] * 20, np.array([1, 0] * 20))
    mixed = model.quality(["\n".join([good] * 50), "\n".join([good] * 50 + [bad] * 50), "\n".join([bad] * 50), ""])
    assert mixed[0] > mixed[1] > mixed[2] and 0 <= mixed[3] <= 1


def test_pipeline_keeps_what_each_stage_keeps(spark):
    docs, columns = table(spark, "/root/testdata/sf0.001", "documents"), None
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, "/root/testdata/sf0.001")
        columns = columns or docs.columns
        assert new.columns == columns
        assert new.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        docs = new
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"]: r["decoded"] for r in out.collect()} == {r["doc_id"]: r["text"] for r in docs.collect()}


def test_pipeline_with_odd_rows(spark, docs, tmp_path):
    """Nulls, empties, repeats, a very long text and clashing names, with labels of both classes and a benchmark."""
    good, bad = "An ordinary sentence about gears and shafts, written with some care.", "## $$ @@ || ## %% ^^ && ## $$"
    item = "a passage of the benchmark that nobody should train on at all ever"
    extra = [(100 + k, "\n".join(f"{line} {k} {j}" for j in range(4))) for k, line in enumerate([good, bad] * 30)]
    extra += [(300, f"Before it. {item.title()}. After it."), (None, f"{good} nothing else here 1"), (301, None), (301, "the same id with other words in it, quite different")]
    more = spark.createDataFrame([(i, t, "en", "src", len(t) if t else None, 0.5, "z", 9) for i, t in extra], docs.schema)
    docs.union(more).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + k, 1 - k % 2, 0) for k in range(60)] + [(None, 1, 0), (300, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf_dir = f"file://{tmp_path}"
    left, kept = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf_dir)
        assert left.schema == table(spark, sf_dir, "documents").schema
        kept[name] = [r["doc_id"] for r in left.collect()]
    ids = {k: {i for i in v if i is not None} for k, v in kept.items()}
    assert {100 + k for k in range(0, 60, 2)} <= ids["quality classifier"] and not ids["quality classifier"] & {100 + k for k in range(1, 60, 2)}
    assert kept["simhash near-dedup"].count(301) <= 2 and 2 not in ids["simhash near-dedup"] and 1 in ids["simhash near-dedup"]
    assert ids["simhash near-dedup"] - ids["benchmark decontamination"] == {300}
    assert sorted(kept["pii"], key=repr) == sorted(kept["benchmark decontamination"], key=repr)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"] for r in out), key=repr) == sorted(kept["pii"], key=repr)
    assert {r["doc_id"]: r["decoded"] for r in out if r["doc_id"]} == {r["doc_id"]: r["text"] or "" for r in left.collect() if r["doc_id"]}


def test_pipeline_of_empty_tables(spark, docs, tmp_path):
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"file://{tmp_path}/{name}.parquet")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 7
    docs.limit(0).write.mode("overwrite").parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
