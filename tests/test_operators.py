import uuid

import pytest
from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.operators import annotation as A, evidence as E, inventory as I, ranking as R, routing, sampling as S, snapshots as N


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_identity_is_a_version_5_uuid(spark):
    for path in ("a/b.pdf", "卷/a\nb.PDF"):
        got = one(spark, T.file_instance_id(F.lit("root"), F.lit(path)))
        assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, f"corpus://file-instance/root/{path}"))
    assert one(spark, T.file_instance_id(F.lit("root"), F.lit("/abs"))) is None
    assert one(spark, T.file_instance_id(F.lit("root"), F.lit(""))) is None


@pytest.mark.parametrize(
    ("counts", "failures", "status"),
    [([50, 80], 0, "text_present"), ([0, 0], 0, "text_absent"), ([0, 80], 0, "mixed_or_uncertain"), ([], 2, "check_failed"), ([], 0, "mixed_or_uncertain"), ([90], 1, "mixed_or_uncertain")],
)
def test_text_layer(spark, counts, failures, status):
    from sieveline.sources.documents import layer

    column = T.text_layer_status(F.array(*map(F.lit, counts)).cast("array<int>"), F.lit(failures), 50)
    assert one(spark, column) == status == layer(counts, failures, 50)


@pytest.mark.parametrize(("n", "pages"), [(0, []), (1, [0]), (2, [0, 1]), (3, [0, 1, 2]), (4, [0, 2, 3])])
def test_probe_pages(spark, n, pages):
    assert one(spark, T.probe_pages(F.lit(n))) == pages


@pytest.mark.parametrize(("n", "pages"), [(10, [0, 1, 2, 4, 6]), (5, [0, 1, 2, 3]), (3, [0, 1, 2]), (1, [0]), (0, [])])
def test_ocr_pages(spark, n, pages):
    assert one(spark, T.ocr_pages(F.lit(n))) == pages


def test_filenames(spark):
    names = frame(spark, "name string", ("【2024-03】轴承\n强度分析.pdf",), ("plain.pdf",), (None,), ("【2024-03】x.PDF",), ("【２０２４-03】x.pdf",))
    rows = names.select(T.filename_part(F.col("name"), 1).alias("y"), T.filename_part(F.col("name"), 3).alias("t"), T.filename_status(F.col("name")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [("2024", "轴承\n强度分析", "matched"), (None, None, "unmatched"), (None, None, "error"), ("2024", "x", "matched"), ("２０２４", "x", "matched")]


def test_signals(spark):
    got = spark.createDataFrame([("A机1\t\n\r\x00\ufffd\ue000",), ("",), (None,)], "t string").select(T.quality_signals(F.col("t")).alias("s")).select("s.*").collect()
    first = got[0].asDict()
    want = {"replacement_char_count": 1, "private_use_char_count": 1, "control_char_count": 1, "printable_char_count": 4, "ascii_letter_count": 1, "cjk_char_count": 1, "digit_count": 1, "whitespace_count": 3, "suspicious_char_count": 3}
    assert {k: first[k] for k in want} == want
    assert all(v == 0 for v in got[1].asDict().values())
    assert all(v is None for v in got[2].asDict().values())


def test_evidence_is_cut_at_the_cap(spark):
    out = E.assemble(F.array(F.lit("x" * 13000)), F.array(F.lit(0)), 12000)
    row = spark.range(1).select(*(c.alias(k) for k, c in out.items())).first()
    assert (row["evidence_char_count"], row["evidence_truncated"], row["raw_text_char_count"]) == (12000, True, 13000)
    ocr = E.assemble_ocr(F.array(F.lit("abcdef"), F.lit("ghijkl")), F.array(F.lit(0), F.lit(1)), 4, 100)
    row = spark.range(1).select(*(c.alias(k) for k, c in ocr.items())).first()
    assert (row["raw_chars"], row["stored_chars"], row["globally_truncated"]) == (12, [4, 4], False)


def test_reading_order(spark):
    rows = frame(spark, "d array<struct<box:array<struct<x:double,y:double>>,text:string,score:double>>", ([([(0.0, 40.0)], "second", 0.9), ([(0.0, 10.0)], "first", 0.8), ([(1.0, 1.0)], " \t", 0.1), ([], "last", 0.5)],))
    assert [x["text"] for x in rows.select(E.reading_order(F.col("d")).alias("o")).first()["o"]] == ["first", "second", "last"]


def test_hamilton_ties_go_to_the_smaller_key(spark):
    got = R.hamilton(frame(spark, "k string, c long", ("c", 1), ("a", 1), ("b", 1)), ["k"], "c", F.lit(2))
    assert {r["k"]: (r["floor_share"], r["share"]) for r in got.collect()} == {"a": (0, 1), "b": (0, 1), "c": (0, 0)}
    zero = R.hamilton(frame(spark, "k string, c long", ("a", 0),), ["k"], "c", F.lit(5)).first()
    assert (zero["share"], zero["remainder"]) == (0, 0)


def test_quotas(spark):
    counts = frame(spark, "k string, n long", ("big", 100), ("medium", 10), ("small", 3), ("empty", 0))
    got = {r["k"]: r["final_quota"] for r in R.quotas(counts, ["k"], "n", 50, 5).collect()}
    assert got == {"big": 40, "medium": 7, "small": 3}
    assert R.quotas(frame(spark, "k string, n long", ("only", 4)), ["k"], "n", 1000, 5).first()["final_quota"] == 4
    with pytest.raises(Exception, match="target is smaller"):
        R.quotas(counts, ["k"], "n", 6, 5).collect()


@pytest.mark.parametrize(("n", "k"), [(10, 10), (20, 10), (4, 10), (10, 4), (23, 10), (7, 1), (1, 3), (97, 13)])
def test_evenly_spaced(spark, n, k):
    rows = spark.range(n).withColumn("g", F.lit("x")).orderBy(F.rand(3))
    want = list(range(n)) if n <= k else [0] if k == 1 else sorted({(i * (n - 1) + (k - 1) // 2) // (k - 1) for i in range(k)})
    assert sorted(r["id"] for r in R.evenly_spaced(rows, ["g"], ["id"], k).collect()) == want


def test_duplicates(spark):
    files = frame(
        spark, "source_root_id string, relative_path string, file_instance_id string, sha256 string, hash_status string, parent_group string",
        ("r", "b", "2", "h", "success", "g"), ("r", "a", "1", "h", "success", "g"), ("r", "c", "3", "h", "failed", "g"), ("r", "d", "4", "u", "success", "g"),
    )
    rows = {r["file_instance_id"]: (r["group_size"], r["is_representative"]) for r in I.exact_duplicates(files).collect()}
    assert rows == {"1": (2, True), "2": (2, False)}
    assert {r["file_instance_id"] for r in I.collapse_duplicates(files, I.exact_duplicates(files)).collect()} == {"1", "3", "4"}
    assert I.duplicate_violations(files, I.exact_duplicates(files)).count() == 0
    assert I.exact_duplicates(files.limit(0)).count() == 0


def test_distributions(spark):
    v = frame(spark, "v long", (1,), (2,), (3,), (10,), (None,))
    assert tuple(I.distribution(v, "v").first()) == (4, 1, 2.5, 7.9, 8.95, 9.79, 10)
    assert tuple(I.nearest_rank(v, "v").first()) == (4, 1, 1, 3, 10, 10)
    assert I.distribution(v.limit(0), "v").first()["median"] is None


def records(spark, n=60):
    rows = []
    for i in range(n):
        layer = ("text_present", "mixed_or_uncertain", "text_absent", "text_present")[i % 4]
        rows.append((f"id{i:02d}", "root", f"g{i % 3}", f"g{i % 3}/{i:03d}.pdf", "partial" if i % 15 == 7 else "success", "success", 3, layer, "unmatched" if i % 5 == 0 else "matched", f"h{i // 2}" if i < 8 else f"u{i}", "success"))
    return spark.createDataFrame(rows, "file_instance_id string, source_root_id string, parent_group string, relative_path string, inventory_status string, pdf_open_status string, page_count int, text_layer_status string, filename_parse_status string, sha256 string, hash_status string")


def test_pools_are_disjoint_and_independent_of_input_order(spark):
    files = records(spark)
    targets = {"text_absent": 6, "mixed_text": 5, "filename_unmatched": 4}
    got = []
    for f in (files, files.repartition(7).orderBy(F.rand(5))):
        pools = S.calibration_pools(f, I.exact_duplicates(f), 12, 2, targets)
        got.append(sorted(map(tuple, pools.collect())))
    assert got[0] == got[1]
    ids = [r[0] for r in got[0]]
    assert len(ids) == len(set(ids))
    counts = {p: sum(r[3] == p for r in got[0]) for p in S.POOLS}
    assert counts["main"] == 12 and counts["source_quality_exception"] == 4 and counts["text_absent"] == 6


def test_snapshot_diff_and_reconcile(spark):
    schema = "source_root_id string, relative_path string, size_bytes long, mtime_ns long, file_instance_id string, batch_id int"
    before = frame(spark, schema, ("r", "a", 1, 1, "a", 1), ("r", "b", 1, 1, "b", 1), ("r", "c", 1, 1, "c", 1))
    after = frame(spark, schema, ("r", "b", 2, 1, "b", 1), ("r", "c", 1, 1, "c", 1), ("r", "d", 1, 1, "d", 1))
    assert {r["relative_path"]: r["change"] for r in N.snapshot_diff(before, after).collect()} == {"a": "missing", "b": "metadata_changed", "d": "added"}
    assert N.diff_summary(N.snapshot_diff(after, after)).agg(F.sum("n")).first()[0] == 0
    assert {r["file_instance_id"]: r["action"] for r in N.reconcile(after, before).collect()} == {"b": "reprocess", "c": "reuse", "d": "process"}


def test_rules(spark):
    schema = "calibration_item_id long, pool_name string, role string, " + ", ".join(f"{s} double" for s in routing.SIGNALS)
    rows = frame(spark, schema, (1, "main", "positive", 0.6, 0.0, 0.0, 0.5, 0.6), (2, "main", "negative", 0.5, 0.0, 0.0, 0.9, 0.5), (3, "main", None, 0.1, 0.0, 0.0, 0.9, None))
    out = routing.evaluate_trigger(rows, routing.threshold_rule("replacement_char_rate", ">=", 0.5)).first()
    assert (out["recall"], out["false_positives"], out["main_triggered"]) == (1.0, 1, 2)
    assert rows.where(routing.threshold_rule("suspicious_char_rate", ">=", 0.0)).count() == 2
    best = routing.best(routing.rule_search(rows), ["signal", "threshold"]).first()
    assert (best["recall"], best["main_triggered"], best["false_positives"]) == (1.0, 1, 0)
    with pytest.raises(ValueError, match="does not allow"):
        routing.threshold_rule("printable_char_ratio", ">=", 0.5)
    with pytest.raises(ValueError, match="must differ"):
        routing.or_rule(("control_char_rate", ">=", 0.1), ("control_char_rate", ">=", 0.2))


def test_annotation_pairs(spark):
    base = dict(primary_domain="D01", taxonomy_fit="clear_fit", confidence="high", evidence_usability="usable", secondary_domains=["D02"], evidence_revision="e", taxonomy_revision="t", prompt_revision="p", schema_revision="s", peer_annotation_visible=False, superseded=False, retry_count=0)
    cases = {"agreed": {}, "primary_domain": {"primary_domain": "D02"}, "evidence_contract_differs": {"prompt_revision": "q"}, "low_confidence": {"confidence": "low"}, "evidence_retry_required": {"evidence_usability": "unreadable"}}
    schema = "item_id string, side string, primary_domain string, taxonomy_fit string, confidence string, evidence_usability string, secondary_domains array<string>, evidence_revision string, taxonomy_revision string, prompt_revision string, schema_revision string, peer_annotation_visible boolean, superseded boolean, retry_count int"
    rows = [(name, side, *(base | (change if side == "b" else {})).values()) for name, change in cases.items() for side in "ab"]
    paired = A.pairs(spark.createDataFrame(rows, schema))
    assert {r["item_id"]: r["reason"] for r in A.agreement(paired).collect()} == {k: k for k in cases}
    retry = {r["item_id"]: r for r in A.retry_decisions(paired).collect()}["evidence_retry_required"]
    assert (retry["required"], retry["triggered_by_a"], retry["triggered_by_b"], retry["reasons"]) == (True, False, True, "b.evidence_usability=unreadable")
    assert A.superseded(paired).count() == 2


def test_ranks_by_range_equal_the_window(spark):
    """A group that is too large for one task is ranked in ranges, with the same places."""
    import random

    from sieveline.operators import ranking as R

    rng = random.Random(1)
    rows = [(rng.choice(("a", "a", "a", "b", None)), f"p{i:05d}", i) for i in rng.sample(range(3000), 1200)]
    df = spark.createDataFrame(rows, "g string, p string, i long").repartition(5)
    want = sorted(map(tuple, R.ranked(df, ["g"], ["p"]).select("i", "idx", "n").collect()))
    assert sorted(map(tuple, R.ranked(df, ["g"], ["p"], most=1).select("i", "idx", "n").collect())) == want
    assert R.ranked_by_range(df, ["g"], ["p"]).columns == [*df.columns, "idx", "n"]
    places = {r["i"]: r["at"] for r in R.numbered(df.select("i"), ["i"], "at").collect()}
    assert places == {i: k for k, i in enumerate(sorted(r[2] for r in rows))}
    assert R.numbered(df.limit(0), ["i"], "at").count() == 0


def test_distribution_of_negative_and_repeated_values(spark):
    import numpy as np

    from sieveline.operators import inventory as I

    values = [-3.5, -3.5, -1.0, 0.0, 0.25, 0.25, 2.0, 7.0, 1e6, None]
    row = I.distribution(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    known = sorted(v for v in values if v is not None)
    assert row["count"] == 9 and (row["min"], row["max"]) == (-3.5, 1e6)
    for name, p in (("median", 0.5), ("p90", 0.9), ("p99", 0.99)):
        assert abs(row[name] - np.quantile(known, p)) < 1e-3
    assert I.distribution(spark.createDataFrame([], "v double"), "v").first()["count"] == 0


def test_pair_search_equals_brute_force(spark):
    import random

    from sieveline.operators import routing as R

    rng = random.Random(2)
    names = list(R.SIGNALS)
    rows = [(i, rng.choice(("main", "audit")), rng.choice(("positive", "negative", None)), *(rng.choice((None, 0.0, 0.1, 0.2, 0.5, 1.0)) for _ in names)) for i in range(60)]
    df = spark.createDataFrame(rows, "calibration_item_id long, pool_name string, role string, " + ", ".join(f"{n} double" for n in names))
    want = {}
    grid = {n: {r[3 + k] for r in rows if r[2] and r[3 + k] is not None} for k, n in enumerate(names)}
    hit = lambda r, n, t: r[3 + names.index(n)] is not None and (r[3 + names.index(n)] <= t if R.SIGNALS[n] == "<=" else r[3 + names.index(n)] >= t)
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            for x in grid[a]:
                for y in grid[b]:
                    own = [r for r in rows if hit(r, a, x) or hit(r, b, y)]
                    want[a, x, b, y] = tuple(sum(map(f, own)) for f in (lambda r: r[2] == "positive", lambda r: r[2] == "negative", lambda r: r[1] == "main"))
    got = {(r["left_signal"], r["left_threshold"], r["right_signal"], r["right_threshold"]): (r["true_positives"], r["false_positives"], r["main_triggered"]) for r in R.pair_search(df).collect()}
    assert got == want
    with pytest.raises(Exception, match="too many thresholds"):
        R.pair_search(df, most=2).collect()


def test_best_pairs_equal_the_best_of_all_pairs(spark):
    import random

    from sieveline.operators import routing as R

    names = list(R.SIGNALS)
    key = ["left_signal", "left_threshold", "right_signal", "right_threshold"]
    for seed in (2, 3, 5):
        rng = random.Random(seed)
        values = (*((None,) if seed % 2 else ()), *(k / 10 for k in range(-1 - seed, 12)))  # without nulls recall is full
        role = lambda v: "positive" if max(x or 0 for x in v) > 1 else rng.choice(("positive", "negative", "negative", None, "other"))  # noqa: E731, B023
        rows = [(i, rng.choice(("main", "audit", None)), role(v), *v) for i in range(40 + 30 * seed) for v in [[rng.choice(values) for _ in names]]]
        if seed == 5:  # no positive row, and a signal without values
            rows = [(*r[:2], "negative" if r[2] == "positive" else r[2], None, *r[4:]) for r in rows]
        df = spark.createDataFrame(rows, "calibration_item_id long, pool_name string, role string, " + ", ".join(f"{n} double" for n in names))
        want = R.best(R.pair_search(df), [key[1], key[3]], [key[0], key[2]]).collect()
        got = R.best_pairs(df).collect()
        columns = (*key, "true_positives", "false_positives", "main_triggered", "recall", "main_rate")
        assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(tuple(r[c] for c in columns) for r in want)
        assert len(got) == (6 if seed == 5 else 10)


def test_pair_search_query_takes_any_number_of_thresholds(spark, tmp_path):
    import numpy as np

    from sieveline.plans import catalogue

    n = 5000  # more than 2000 reviewed values of a signal
    spark.range(n).selectExpr("id as doc_id", "repeat('a', cast(100 + id * 7919 % 5003 as int)) as text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(n).selectExpr("id as doc_id", "cast(id * 31 % 101 > 60 or id % 7 < 4 and id % 4 < 3 as int) as quality", "0 as toxic").where("doc_id % 3 <> 0").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r["left_signal"], r["right_signal"]): r for r in catalogue.QUERIES["pair_search"](spark, str(tmp_path)).collect()}
    assert len(got) == 10
    # one pair of signals by numpy: all thresholds of the one against all of the other
    ids = np.array([i for i in range(n) if i % 23])
    length = 100 + ids * 7919 % 5003 + ids % 7 + ids % 4 + ids % 5
    x, y = (ids % 7) / length, (ids % 4) / length
    seen, main, good = ids % 3 != 0, ids % 2 == 0, (ids * 31 % 101 > 60) | (ids % 7 < 4) & (ids % 4 < 3)
    positive, negative = seen & ~good, seen & good
    grid_x, grid_y = np.unique(x[seen]), np.unique(y[seen])
    assert len(grid_x) > 2000 and len(grid_y) > 2000
    best = None
    for a in grid_x:
        hit = x >= a
        # rows at or above each right threshold that the left one leaves out, besides those that it takes
        of = lambda rows: rows[hit].sum() + (rows & ~hit).sum() - np.searchsorted(np.sort(y[rows & ~hit]), grid_y)  # noqa: E731, B023
        tp, fp = of(positive), of(negative)
        k = min(np.flatnonzero(tp == tp.max()), key=lambda j: (fp[j], grid_y[j]))
        rule = (-tp[k], fp[k], a, grid_y[k], of(main)[k])
        best = rule if best is None or rule < best else best
    r = got["replacement_char_rate", "private_use_char_rate"]
    assert (-r["true_positives"], r["false_positives"], r["left_threshold"], r["right_threshold"], r["main_triggered"]) == best


def test_runs_are_hashed_from_shorter_runs_and_words_are_matched_once(spark):
    import random
    import re

    from sieveline.operators import items as I

    rng = random.Random(3)
    parts = ("a", "B", "c1", "É", "ɏ", "日本", "ß", "x")
    texts = ["", None, "!?", "a", " ".join("abcdefghijklm"), ". a.B!c " * 9] + [rng.choice((" ", "--", "𝄞", "\n")).join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "document_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts[::3])), "item_id long, text string")
    for words in (1, 2, 3, 5, 13):
        def runs(t):
            w = re.findall("[a-z0-9À-ɏ]+", (t or "").lower())
            return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}

        want = {(i, j): len(runs(a) & runs(b)) for i, a in enumerate(texts) for j, b in enumerate(texts[::3])}
        got = {(r["document_id"], r["item_id"]): r["shared"] for r in I.training_exclusions(docs, items, words).collect()}
        assert got == {k: n for k, n in want.items() if n}
    # a text's words are looked for in one pass: what they are not is never matched, and no filter repeats it
    plan = I.grams(docs, "document_id", 13)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "split(" not in plan
