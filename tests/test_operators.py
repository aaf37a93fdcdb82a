from pathlib import Path

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators import agreement, checks, cluster, dedup, export, labeling, sampling
from tallymill.operators.components import connected_components
from tallymill.operators.timestamps import found_instants

REC = "record_id string, source_name string, line_no bigint, input_text string, output_text string, extra string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        [("r1", "b", 2, "q", "a", "x"), ("r2", "a", 9, "q", "a", None), ("r3", "a", 3, "q", "b", ""), ("r4", "c", 1, None, "a", "y"), ("r5", "c", 2, None, "a", "z"), ("r6", "c", 3, "", "", "z")], REC
    )


def test_exact_dedup_keeps_the_first_in_order(records):
    assert [r[:2] for r in rows(dedup.exact_entries(records))] == [("r1", "r2"), ("r5", "r4")]
    assert [r[0] for r in rows(dedup.exact_kept(records).select("record_id"))] == ["r2", "r3", "r4", "r6"]
    assert rows(dedup.exact_entries(records.limit(0))) == []
    h = records.where("record_id = 'r1'").select(schema.content_hash(F.col("input_text"), F.col("output_text"))).first()[0]
    assert h == hashlib.sha256(b"q\x1fa").hexdigest()


def test_id_collapse_counts(records):
    twice = records.unionByName(records.where("record_id < 'r3'")).unionByName(records.limit(1))
    got = {r["record_id"]: r["copies"] for r in dedup.collapse_ids(twice).collect()}
    assert got["r2"] == 2 and got["r3"] == 1 and sum(got.values()) == 9


def test_near_chain_boundary_and_remap(spark):
    import math

    v = lambda deg: [math.cos(math.radians(deg)), math.sin(math.radians(deg))]
    x = spark.createDataFrame([(1, v(0)), (2, v(20)), (3, v(40)), (4, v(200)), (5, [0.0, 0.0]), (6, None), (7, v(200))], "id bigint, vec array<double>")
    pairs = dedup.cosine_pairs(x, 0.93, block_rows=2)
    assert {(r.a, r.b) for r in pairs.collect()} == {(1, 2), (2, 3), (4, 7)}
    got = {r.dropped: (r.kept, r.similarity, r.via_chain) for r in dedup.near_entries(x, pairs, 0.93).collect()}
    assert got[2] == (1, round(math.cos(math.radians(20)), 6), False) and got[3][0] == 1 and got[3][2] and got[7] == (4, 1.0, False)
    exact = spark.createDataFrame([("e1", "2", "h")], "dropped_record_id string, kept_record_id string, content_hash string")
    near = spark.createDataFrame([("2", "1")], "dropped string, kept string")
    assert rows(dedup.remap_entries(exact, near)) == [("e1", "1", "h")]
    edge = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, math.sqrt(0.75)])], "id bigint, vec array<double>")
    assert dedup.cosine_pairs(edge, 0.5).count() == 1 and dedup.cosine_pairs(x.limit(0), 0.5).count() == 0


def test_run_dedup_end_to_end(spark):
    texts = ["la carte des débits reste lente", "La carte des débits reste lente", "autre chose ici", "autre chose ici", None]
    r = spark.createDataFrame([(f"r{i}", "s", i, t, "a", "x") for i, t in enumerate(texts)], REC).where("input_text IS NOT NULL")
    out = dedup.run_dedup(r)
    report = out["report"].first().asDict()
    assert report["exact_dropped"] == 1 and report["near_dropped"] == 1 and report["records_out"] == 2
    entries = out["exact"].select(F.col("dropped_record_id").alias("dropped"), F.col("kept_record_id").alias("kept")).unionByName(out["near"].select("dropped", "kept"))
    checks.require_sound(checks.check_dedup(out["report"], out["kept"], entries))


def test_calibration_sweep_and_ties(spark):
    sweep = lambda d: dedup.calibration_sweep(spark.createDataFrame(d, "similarity double, duplicate boolean"))
    one = sweep([(1.0, True), (0.8, True), (0.6, False), (0.0, False)])
    assert [(r.threshold, r.f1) for r in one.orderBy("threshold").collect()] == [(0.3, 0.8), (0.7, 1.0), (0.9, 0.666667)]
    assert dedup.best_threshold(one).first().threshold == 0.7
    assert dedup.best_threshold(sweep([(1.0, True), (0.8, True), (0.9, False), (0.85, False), (0.2, False)])).first().threshold == 0.95
    assert dedup.best_threshold(sweep([(1.0, True)])).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 200)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and got[200] == 200 and len(got) == 44
    assert connected_components(links.limit(0)).count() == 0


@pytest.mark.parametrize("sizes,k,want", [([50, 3, 2], 10, [8, 1, 1]), ([5, 4, 3], 2, [1, 1, 0]), ([1, 1, 1], 3, [1, 1, 1]), ([4], 9, [4]), ([], 5, [])])
def test_quotas(spark, sizes, k, want):
    strata = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "stratum string, size bigint")
    quotas = sampling.stratum_quotas(strata, k)
    assert [r.quota for r in quotas.orderBy("stratum").collect()] == want
    checks.require_sound(checks.check_quotas(quotas, k))


def test_sample_is_the_least_hashes(spark):
    data = [("x" if i % 5 else None, f"r{i}") for i in range(400)]
    got = rows(sampling.stratified_sample(spark.createDataFrame(data, "stratum string, record_id string"), 40, 1750).select("stratum", "key"))
    score = lambda r: hashlib.sha256(f"1750\x1f{r}".encode()).hexdigest()
    for s in ("x", ""):
        mine = [k for t, k in got if t == s]
        assert sorted(mine) == sorted(sorted([r for t, r in data if (t or "") == s], key=score)[: len(mine)])
    assert len(got) == 40


def test_labelling_budget_collisions_and_failures(spark):
    recs = spark.createDataFrame([(f"r{i}", "s", i, f"q{i}", f"a{i}", "") for i in range(1, 7)], REC)
    shots = spark.createDataFrame([("q2", "a2")], "input_text string, output_text string")

    def judge(q, a):
        if q == "q1":
            raise labeling.JudgeRefusal("no")
        if q == "q3":
            raise labeling.JudgeParse("bad")
        return {"task_type": "other", "outcome": "correct", "confidence": "high", "rationale": "r", "model_id": "m"}

    labels = labeling.run_labeling(recs, shots, 4, judge, "tax-1")
    assert {r.record_id: r.bucket for r in labels.collect()} == {"r1": "refused", "r2": "fewshot_collision", "r3": "failed", "r4": "labeled", "r5": "labeled", "r6": "skipped_budget"}
    checks.require_sound(checks.check_labels(labels, 4))
    with pytest.raises(ValueError):
        labeling.run_labeling(recs.unionByName(recs), shots, 4)
    with pytest.raises(ValueError):
        labeling.budget_buckets(recs, shots, 0)


def test_fake_judge_by_digest(spark):
    got = spark.createDataFrame([("q", "a")], "q string, a string").select(labeling.fake_verdict(F.col("q"), F.col("a")).alias("v")).first().v
    d = hashlib.sha256("fake-judge\x1fq\x1fa".encode()).digest()
    assert (got.task_type, got.outcome, got.confidence) == (schema.TASK_TYPES[d[0] % 5], schema.OUTCOMES[d[1] % 4], schema.CONFIDENCES[d[2] % 3]) and d.hex()[:8] in got.rationale


def _cells(spark, m, names="CPIU"):
    return spark.createDataFrame([(names[i], names[j], m[i][j]) for i in range(len(m)) for j in range(len(m))], "human string, judge string, n bigint")


def test_kappa_by_hand(spark):
    cells = _cells(spark, [[4, 1, 0, 0], [0, 2, 1, 0], [1, 0, 1, 0], [0, 0, 0, 0]])
    g = agreement.global_kappa(cells).first()
    assert (g.po, g.pe, g.kappa, g.status) == (0.7, 0.38, round(16 / 31, 6), "ok")
    by = {r["class"]: (r.status, r.kappa) for r in agreement.class_kappa(cells).collect()}
    assert by["C"] == ("ok", 0.6) and by["P"] == ("ok", round(11 / 21, 6)) and by["I"] == ("insufficient_support", None) and by["U"] == ("absent", None)
    assert agreement.global_kappa(_cells(spark, [[5]], "C")).first().status == "undefined_single_class"
    assert agreement.global_kappa(_cells(spark, [[5, 0], [0, 5]])).first().kappa == 1.0
    assert agreement.global_kappa(_cells(spark, [[0, 5], [5, 0]])).first().kappa == -1.0


def test_bootstrap_by_hand(spark):
    pairs = spark.createDataFrame([(i, str(h), str(j)) for i, (h, j) in enumerate(zip([0, 0, 1, 0], [0, 0, 1, 1]))], "i int, human string, judge string")
    first = agreement.draws(1750, 10, 5)[0].tolist()
    assert first == [1, 3, 2, 4, 0]
    got = agreement.resample_rows(spark, 1750, 7, 5, slices=3).orderBy("b").collect()
    want = agreement.draws(1750, 7, 5)
    assert all(sorted(r.i for r in got if r.b == b) == sorted(want[b].tolist()) for b in range(7))
    whole = spark.createDataFrame([(b, i) for b in range(3) for i in range(4)] + [(3, 0)] * 4, "b int, i int")
    r = agreement.bootstrap_kappa(pairs, whole).first()
    assert (r.resamples, r.degenerate, r.lower, r.upper) == (4, 1, 0.5, 0.5)


def test_match_ledger(spark):
    ids = lambda xs: spark.createDataFrame([(f"r{x}",) for x in xs], "record_id string")
    r = agreement.match_accounting(ids(range(1, 7)), ids(range(4, 10))).first()
    assert (r.judged_in, r.human_in, r.n_matched, r.judge_only, r.human_only) == (6, 6, 3, 3, 3)
    buckets = spark.createDataFrame([("r7", "refused"), ("r8", "fewshot_collision"), ("r4", "labeled")], "record_id string, bucket string")
    assert rows(agreement.human_only_causes(buckets, ids([4, 7, 8, 9]))) == [("r7", "refused"), ("r8", "fewshot_collision"), ("r9", "not_in_run")]
    bands = spark.createDataFrame([(-0.1,), (0.2,), (0.21,), (0.81,), (None,)], "k double").select(agreement.landis_koch(F.col("k")).alias("b"))
    assert [r.b for r in bands.collect()] == ["poor", "slight", "fair", "almost perfect", None]


def test_hdbscan_finds_the_blobs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.05, (30, 4)) for c in (0, 1, 2)] + [rng.uniform(-9, 9, (6, 4))])
    label = cluster.hdbscan_labels(x, 5)
    assert all(len(set(label[k : k + 30])) <= 2 and np.bincount(label[k : k + 30][label[k : k + 30] >= 0]).max() > 20 for k in (0, 30, 60)) and len(set(label) - {-1}) == 3
    assert (cluster.hdbscan_labels(x[:3], 5) == -1).all()
    df = spark.createDataFrame([(f"r{i:03d}", v.tolist()) for i, v in enumerate(x)] + [("null", None)], "record_id string, vec array<double>")
    ids = cluster.cluster_ids(cluster.cluster_rows(df))
    report = cluster.clustering_report(ids).collect()
    assert sum(r["size"] for r in report) == 97 and all(r.cluster_id == "noise" or r.cluster_id.startswith("cl-") for r in report)
    checks.require_sound(checks.check_partition(ids, df))


def test_hdbscan_query_clusters_the_whole_table(spark, tmp_path):
    from tallymill.plans import registry

    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.05, (24, 3)) for c in (0.0, 1.0, 2.0)])
    # every blob holds rows of both labels
    rows_ = [(i, v.tolist(), f"label{i % 2}") for i, v in enumerate(x)]
    spark.createDataFrame(rows_, "vec_id bigint, embedding array<double>, label string").write.parquet(f"file://{tmp_path}/embeddings.parquet")
    got = {r.key: r.cluster_id for r in registry.QUERIES["hdbscan_clusters"](spark, f"file://{tmp_path}").collect()}
    want = cluster.hdbscan_labels(x, 5)
    assert len(got) == 72 and len({(got[i], want[i]) for i in range(72)}) == len(set(want)) == len(set(got.values()))


def test_hdbscan_beyond_one_task(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, 0.05 + 0.02 * c, (30, 4)) for c in (0.0, 1.0, 2.0)] + [rng.uniform(-1, 3, (10, 4))])
    rng.shuffle(x)
    data = [(f"r{i:03d}", v.tolist(), "big") for i, v in enumerate(x)] + [("null", None, "big"), ("one", [1.0] * 4, "small")]
    df = spark.createDataFrame(data, "record_id string, vec array<double>, g string")
    want = cluster.hdbscan_labels(x, 5)
    monkeypatch.setattr(cluster, "MAX_GROUP", 50)
    for block in (16, 1000):
        monkeypatch.setattr(cluster, "BLOCK_ROWS", block)
        got = {r["key"]: r["label"] for r in cluster.cluster_rows(df, group="g").collect()}
        assert len(got) == 102 and got["null"] == got["one"] == -1
        pairs_ = {(got[f"r{i:03d}"], want[i]) for i in range(100)}
        assert len(pairs_) == len({a for a, _ in pairs_}) == len({b for _, b in pairs_}) >= 4


def test_trees_of_block_pairs_hold_the_whole_tree():
    rng = np.random.default_rng(12)
    x = rng.normal(size=(60, 3))
    d = cluster._distances(x, x)
    core = np.partition(d, 4, axis=1)[:, 4]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None])
    at, codes, lengths = np.arange(60), [], []
    for i in range(0, 60, 25):
        for j in range(i, 60, 25):
            a, b = at[i : i + 25], at[j : j + 25]
            c, v = cluster._pair_tree(reach[i : i + 25, j : j + 25], a if i == j else np.concatenate([a, b]), i == j)
            codes.append(c)
            lengths.append(v)
    codes, lengths = np.concatenate(codes), np.concatenate(lengths)
    kept = cluster._forest(codes, lengths)
    whole, length = cluster._pair_tree(reach, at, True)
    assert set(codes[kept]) == set(whole)
    assert np.allclose(np.sort(length), np.sort(cluster._spanning_tree(x, core)[:, 2]), atol=1e-7)


def test_gate_and_manifest():
    good = {"status": "ok", "kappa": 0.6, "lower": 0.5, "upper": 0.7}
    d = export.evaluate_gate(good, ready=True, same_instrument=True, labels_sha256="f" * 64)
    assert d.verdict == "passed" and d.straddles
    low = {**good, "kappa": 0.59}
    assert export.evaluate_gate(low, ready=True, same_instrument=True, labels_sha256="f" * 64).verdict == "blocked"
    assert export.evaluate_gate(low, ready=True, same_instrument=True, labels_sha256="f" * 64, override="why").verdict == "passed_with_override"
    with pytest.raises(export.ExportInputError):
        export.evaluate_gate(good, ready=True, same_instrument=True, labels_sha256="f" * 64, override="why")
    with pytest.raises(export.ExportInputError):
        export.evaluate_gate(low, ready=False, same_instrument=True, labels_sha256="f" * 64, override="why")
    m = export.Manifest(1750, 10, 1, 1, 1, 7, 7, 5, 5, 1, 4, "0" * 64, (("source_log", "a.jsonl", "f" * 64),), (("dim", 512),), d)
    assert m.coherent() == [] and m.render() == m.render() and '"volatile": null' in m.render()
    assert "export counts" in export.Manifest(1750, 10, 1, 1, 1, 7, 7, 5, 5, 1, 3, "0" * 64, (), (), d).coherent()


def test_golden_lines_and_writer(spark, tmp_path):
    from tallymill.sources.sinks import ArtifactsPresent, annotation_sheet, current_export, preview, refuse_mixed, write_export

    r = spark.createDataFrame([("s", 1, "q\né", "a"), ("s", 2, "q2", "a2")], "source_name string, line_no bigint, input_text string, output_text string")
    r = r.withColumns({"source_kind": F.lit("generic_jsonl"), "span_id": F.lit(None).cast("string"), "task_id": F.lit(None).cast("string"), "timestamp": F.lit(None).cast("string"), "metadata": F.create_map(F.lit("k"), F.lit("v"))})
    r = r.withColumn("record_id", schema.record_id(*[F.col(c) for c in ("source_kind", "source_name", "line_no", "input_text", "output_text")]))
    shots = spark.createDataFrame([("q2", "a2")], "input_text string, output_text string")
    labels = labeling.run_labeling(r, shots.limit(0), 10)
    hashes = shots.select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    golden = export.golden_records(r, labels, r.select("record_id", F.lit("noise").alias("cluster_id")), hashes)
    checks.require_sound(checks.check_golden(golden, hashes))
    checks.require_sound(checks.check_records(r))
    folder = write_export(golden, "{}\n", f"file://{tmp_path}/out")
    text = "".join(p.read_text() for p in sorted(Path(folder.removeprefix("file://"), "golden.jsonl").glob("part-*")))
    assert current_export(spark, f"file://{tmp_path}/out") == folder and write_export(golden, "{}\n", f"file://{tmp_path}/out") == current_export(spark, f"file://{tmp_path}/out") != folder
    with pytest.raises(ArtifactsPresent):
        refuse_mixed(spark, f"file://{tmp_path}/out", "annotation")
    refuse_mixed(spark, f"file://{tmp_path}/out", "judge")
    import json

    line = json.loads(text)
    assert list(line) == sorted(line) and line["provenance"]["span_id"] is None and Path(folder.removeprefix("file://"), "meta.json").read_text() == "{}\n"
    assert annotation_sheet(r, "tax").count() == 2 and r.select(preview(F.col("input_text"), 3)).first()[0] == "q␤é"
    with pytest.raises(Exception, match="without text or stratum"):
        export.golden_records(r, labels, r.limit(0).select("record_id", F.lit("x").alias("cluster_id")), hashes).collect()


def test_found_instants_edges(spark):
    kind = "line_no bigint, source_name string, meta struct<id:string,ts:string,conv:string>, tz string, utc string"
    t = spark.createDataFrame([(1, "s", (None, "06/01/2025 02:18", None), "x", "y"), (2, "s", (None, "2025-01-06T02:18:00+00:00", None), "x", "y"), (3, None, (None, "1736125362", None), None, None), (4, "t", (None, "2025-01-06 10:00", None), None, None), (5, "s", None, None, None)], kind)
    s = spark.createDataFrame([("s", "Europe/Paris", "mdy", 1)], "source_name string, tz string, date_order string, line_no int")
    assert rows(found_instants(t, s)) == [(1, "2025-06-01T00:18:00.000000Z"), (3, "2025-01-06T01:02:42.000000Z")]
    assert found_instants(t.limit(0), s).count() == 0


def test_join_of_hot_keys(spark):
    from tallymill.operators.skew import join_counted

    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i == 7 else f"k{i % 40}") for i in range(600)], "id long, k string")
    keyed = rows.where("k IS NOT NULL").groupBy("k").count().withColumnRenamed("count", "n").where("k <> 'k1'")
    for share in (1, 3, 10**9):
        for how in ("inner", "left"):
            got = sorted(map(tuple, join_counted(rows, keyed, "k", how=how, share=share).select("id", "k", "n").collect()), key=str)
            assert got == sorted(map(tuple, rows.join(keyed, "k", how).select("id", "k", "n").collect()), key=str)
    assert join_counted(rows.limit(0), keyed.limit(0), ["k"]).count() == 0
