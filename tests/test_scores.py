"""Scores, curves, fairness, care plans and outreach against brute force on small tables."""

import random
from pathlib import Path

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carepanel.operators import care_plan, curves, drivers, fairness, outreach, scoring
from carepanel.operators.drivers import LinearTerm
from carepanel.sources import contact_log, sinks

STEP = 0.01


def scored(spark, n=400, seed=7):
    rng = random.Random(seed)
    data = [(i, round(rng.choice([rng.random(), 0.35, 0.5]), 4), int(rng.random() < 0.3), rng.choice("aab")) for i in range(n)]
    return data, spark.createDataFrame(data, "patient_id long, probability double, y_true int, grp string")


def brute_auroc(data):
    pos = [p for _, p, y, *_ in data if y]
    neg = [p for _, p, y, *_ in data if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(data):
    total, recall, out = sum(y for _, _, y, *_ in data), 0.0, 0.0
    for t in sorted({p for _, p, *_ in data}, reverse=True):
        flagged = [y for _, p, y, *_ in data if p >= t]
        now = sum(flagged) / total
        out += (now - recall) * sum(flagged) / len(flagged)
        recall = now
    return out


def test_metrics(spark):
    data, df = scored(spark)
    m = curves.evaluate(df).first()
    assert m.auroc == pytest.approx(brute_auroc(data), abs=6e-5)
    assert m.pr_auc == pytest.approx(brute_ap(data), abs=6e-5)
    assert m.brier == pytest.approx(sum((p - y) ** 2 for _, p, y, _ in data) / len(data), abs=6e-5)
    assert m.tp == sum(p >= 0.5 and y for _, p, y, _ in data) and m.tp + m.fp + m.fn + m.tn == len(data)
    by = {r.grp: r.auroc for r in curves.evaluate(df, groups=("grp",)).collect()}
    assert by["b"] == pytest.approx(brute_auroc([d for d in data if d[3] == "b"]), abs=6e-5)


def test_metrics_with_one_class_are_undefined(spark):
    df = spark.createDataFrame([(0.2, 0), (0.8, 0)], "probability double, y_true int")
    m = curves.evaluate(df).first()
    assert (m.auroc, m.pr_auc, m.recall, m.f1) == (None, None, 0.0, 0.0)


def test_sweep(spark):
    data, df = scored(spark)
    swept = {round(r.threshold, 3): r for r in curves.sweep(df).collect()}
    assert len(swept) == 101
    for k in range(101):
        t = k * STEP
        r = swept[round(t, 3)]
        assert r.tp == sum(p >= t and y for _, p, y, _ in data), t
        assert r.tp + r.fp + r.fn + r.tn == len(data)
    assert swept[1.0].flagged == 0 and swept[1.0].precision is None and swept[1.0].f1 == 0.0
    # 35 steps of 0.01 lie just above 0.35, so a probability of 0.35 is not flagged there
    assert swept[0.35].tp + swept[0.35].fp == sum(p >= 35 * STEP for _, p, *_ in data)
    best = curves.recommended_threshold(curves.sweep(df)).first()
    costs = {t: r.fn * 10 + r.fp for t, r in swept.items()}
    assert best.threshold == min(costs, key=lambda t: (costs[t], t))


def test_champion_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("logreg", 0.5, 0), ("gbm", 0.5, 1)], "model string, pr_auc double, model_order int")
    assert curves.champion(df).first().champion == "logreg"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=6).filter(sum))
def test_percentages_sum_to_exactly_100(spark, counts):
    df = spark.createDataFrame(list(enumerate(counts)), "i int, patients long")
    got = {r.i: r.pct_of_panel for r in scoring.exact_percentages(df, "i").collect()}
    assert sum(round(v * 10) for v in got.values()) == 1000
    assert all(abs(got[i] - 100 * c / sum(counts)) < 0.1 for i, c in enumerate(counts))


def test_percentages_of_nothing(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "i int, patients long")
    assert [r.pct_of_panel for r in scoring.exact_percentages(df, "i").collect()] == [0.0, 0.0]


def test_scores_round_half_to_even_and_ties_go_up(spark):
    df = spark.createDataFrame([(1, 0.125), (2, 0.135), (3, 0.5), (4, 0.9)], "patient_id long, probability double")
    out = {r.patient_id: r for r in scoring.score_frame(df, (50.0, 90.0)).collect()}
    assert out[1].risk_score == 12 and out[3].tier == "Medium" and out[4].tier == "High" and out[3].predicted_label == 1


def test_subgroups(spark):
    data, df = scored(spark, 300)
    df = df.withColumns({"y_pred": (F.col("probability") >= 0.4).cast("int"), "none": F.lit("Unknown")})
    table = {r.subgroup: r for r in fairness.subgroup_metrics(df, ["grp", "none"]).collect()}
    assert set(table) == {"a", "b"}
    for g in "ab":
        part = [d for d in data if d[3] == g]
        pos = [d for d in part if d[2]]
        assert table[g].n == len(part) and table[g].reliable == (len(part) >= 100)
        assert table[g].auroc == pytest.approx(brute_auroc(part), abs=6e-5)
        assert table[g].recall_tpr == pytest.approx(sum(d[1] >= 0.4 for d in pos) / len(pos), abs=6e-5)
    gaps = fairness.fairness_gaps(fairness.subgroup_metrics(df, ["grp"])).first()
    if not table["b"].reliable:
        assert gaps.equal_opportunity_diff == 0.0 and gaps.worst_fnr_subgroup == "a"


def test_subgroup_predictions_need_not_follow_the_probability(spark):
    data = [(1, 0.3, 1, 0), (2, 0.3, 0, 1), (3, 0.3, 1, 1), (4, 0.1, 0, 0), (5, 0.9, 0, 1)]
    df = spark.createDataFrame([(i, p, y, q, "g") for i, p, y, q in data], "patient_id long, probability double, y_true int, y_pred int, grp string")
    r = fairness.subgroup_metrics(df, ["grp"]).first()
    assert r.auroc == pytest.approx(brute_auroc(data)) and r.recall_tpr == 0.5 and r.selection_rate == 0.6


def test_one_class_subgroup_has_no_auroc(spark):
    df = spark.createDataFrame([(0.3, 0, 0, "g")] * 3, "probability double, y_true int, y_pred int, grp string")
    r = fairness.subgroup_metrics(df, ["grp"]).first()
    assert (r.auroc, r.recall_tpr, r.fnr) == (None, None, None)


def test_contributions_and_factors(spark):
    terms = [LinearTerm("age_midpoint", 0.1, 50.0, fill=50.0), LinearTerm("insulin", 1.0, 0.5, level="Up"), LinearTerm("insulin", -1.0, 0.5, level="No")]
    df = spark.createDataFrame([(1, 75.0, "Up"), (2, None, "No"), (3, 52.5, "Other")], "id long, age_midpoint double, insulin string")
    explained = drivers.with_contributions(df, terms)
    got = {(r.id, r.feature): r.contribution for r in drivers.contribution_rows(explained, "id").collect()}
    assert got[1, "age_midpoint"] == pytest.approx(2.5) and got[2, "age_midpoint"] == 0.0
    assert (got[1, "insulin"], got[2, "insulin"], got[3, "insulin"]) == (1.0, -1.0, 0.0)
    assert rows(drivers.top_factors(explained, "id")) == [(1, "age: 75; insulin: Up"), (2, "no elevated risk factors"), (3, "age: 52.5")]
    share = {r.feature: r.relative_influence for r in drivers.global_importance(explained, terms).collect()}
    assert sum(share.values()) == pytest.approx(100)


def test_care_plan_keeps_the_first_rule_of_a_category(spark):
    df = spark.createDataFrame([(1, 92, "High", "prior inpatient visits: 3; insulin: Down; prior admissions: 3"), (2, 10, "Low", "procedures: 2")],
                               "patient_id long, risk_score int, tier string, top_3_risk_factors string")
    steps = rows(care_plan.plan_steps(care_plan.care_plans(df)), "patient_id", "step", "category", "priority")
    assert steps == [
        (1, 1, "Escalation", "High"), (1, 2, "Transitional care", "High"), (1, 3, "Diabetes management", "High"), (1, 4, "Primary care", "High"),
        (2, 1, "Primary care", "Medium"), (2, 2, "Post-procedure", "Low"),
    ]


def test_statuses_partition_the_panel(spark):
    scores = spark.createDataFrame([(i, 90 - i, t, "f") for i, t in enumerate(["High", "High", "Low", "Medium", "Odd", "High"])], "patient_id long, risk_score int, tier string, top_3_risk_factors string")
    log = spark.sql("SELECT * FROM VALUES (0L, DATE'2024-03-25'), (1L, DATE'2024-03-01'), (2L, DATE'2024-03-25'), (4L, DATE'2024-03-25') AS t(patient_id, last_contacted)")
    status = outreach.contact_status(scores, log, "2024-04-01")
    assert rows(status, "patient_id", "status") == [(0, "Due"), (1, "Overdue"), (2, "Scheduled"), (3, "New"), (4, "Scheduled"), (5, "New")]
    assert [r.patient_id for r in outreach.outreach_queue(status).collect()] == [1, 3, 5, 0]
    counts = outreach.queue_counts(status).first()
    assert (counts.due_today, counts.overdue, counts.never_contacted, counts.scheduled) == (4, 1, 2, 2)


def test_score_100_falls_out_of_the_bands(spark):
    df = spark.createDataFrame([(0,), (5,), (99,), (100,)], "risk_score int")
    bands = {r.band: r.patients for r in outreach.score_bands(df).collect()}
    assert len(bands) == 20 and sum(bands.values()) == 3 and bands["95-100"] == 1
    assert {r.band: r.patients for r in outreach.score_bands(df, keep_outside=True).collect()}["out_of_range"] == 1


def test_contact_log_versions(spark, tmp_path):
    root = str(tmp_path / "log")
    assert contact_log.read_contact_log(spark, root).count() == 0
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "patient_id long")
    assert contact_log.save_contacts(spark, root, ids(3, 1, 1), "2024-01-01").endswith("v000001")
    contact_log.save_contacts(spark, root, ids(1, 2), "2024-02-01")
    assert [(r[0], str(r[1])) for r in rows(contact_log.read_contact_log(spark, root))] == [(1, "2024-02-01"), (2, "2024-02-01"), (3, "2024-01-01")]
    (tmp_path / "log" / "v000003").mkdir()  # a write that never finished
    assert contact_log.read_contact_log(spark, root).count() == 3


def test_versioned_sink(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    assert sinks.write_versioned(df, root).endswith("v001")
    assert sinks.write_versioned(df.where("i = 2"), root).endswith("v002")
    read = lambda name: spark.read.option("header", True).csv(f"{root}/{name}").count()
    assert (read("v001"), read("v002"), sinks.read_latest(spark, root).count()) == (2, 1, 1)
    odd = [(1, "a\nb"), (2, 'say "hi", ok'), (3, ""), (4, None), (5, " sp "), (6, "back\\slash")]
    snapshot = sinks.write_versioned(spark.createDataFrame(odd, "i int, s string"), root)
    assert sinks.latest_manifest(spark, root)["tables"]["snapshot"]["path"] == snapshot
    assert not (Path(root) / "LATEST").exists()  # a pointer, never a folder written over
    back = {r.i: r.s for r in sinks.read_latest(spark, root).collect()}
    assert back == dict(odd)


def test_a_failed_run_leaves_the_old_set_readable(spark, tmp_path):
    root = str(tmp_path / "set")
    one = spark.createDataFrame([(1, "x")], "i int, s string")
    assert sinks.write_tables({"a": one, "b": one, "empty": one.limit(0)}, root, skip_empty=True) == ["a", "b"]
    broken = spark.range(3).selectExpr("CAST(id AS INT) AS i", "CAST(raise_error('lost executor') AS STRING) AS s")
    with pytest.raises(Exception):
        sinks.write_tables({"a": one.union(one), "b": broken}, root)
    assert sinks.read_published(spark, root, "a").count() == 1 and sinks.read_published(spark, root, "b").count() == 1
    with pytest.raises(KeyError):
        sinks.read_published(spark, root, "empty")
    sinks.write_tables({"a": one.union(one)}, root)
    assert sinks.read_published(spark, root, "a").count() == 2


def test_contact_log_writers_from_one_version_both_survive(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "log")
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "patient_id long")
    contact_log.save_contacts(spark, root, ids(1, 2), "2024-01-01")
    jobs = [(ids(2, 3), "2024-02-01"), (ids(4,), "2024-03-01"), (ids(5, 1), "2024-04-01")]
    with ThreadPoolExecutor(3) as pool:
        written = list(pool.map(lambda job: contact_log.save_contacts(spark, root, *job), jobs))
    assert sorted(w[-7:] for w in written) == ["v000002", "v000003", "v000004"]
    got = {r[0]: str(r[1]) for r in contact_log.read_contact_log(spark, root).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[4] == "2024-03-01" and got[3] == "2024-02-01"
    assert got[1] in ("2024-01-01", "2024-04-01") and got[5] == "2024-04-01"


def test_contact_log_skips_a_torn_claim(spark, tmp_path):
    root = str(tmp_path / "log")
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "patient_id long")
    contact_log.save_contacts(spark, root, ids(1), "2024-01-01")
    (tmp_path / "log" / "_claims" / "v000002").touch()  # a writer that claimed and died
    (tmp_path / "log" / "v000002").mkdir()
    assert contact_log.save_contacts(spark, root, ids(2), "2024-02-01", patience=0.5).endswith("v000003")
    assert sorted(r[0] for r in contact_log.read_contact_log(spark, root).collect()) == [1, 2]
    assert contact_log._decision(spark, root, 2) == contact_log.ABANDONED
    assert not contact_log._create_new(spark, f"{root}/_decided/v000002", contact_log.COMMITTED)  # the late writer loses
