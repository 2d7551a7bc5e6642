"""Operators against plain Python on small and awkward inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import geometry as G
from corvane.functions import scalar as S
from corvane.operators import dedupe, evaluate, graph, labels, merge, metrics, split, tiling
from corvane.plans import catalogue, fixtures


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_clamp_and_round(spark):
    assert one(spark, S.clamp01(F.lit(float("nan")))) == 1.0 and one(spark, S.clamp01(F.lit(-2.0))) == 0.0 and one(spark, S.clamp01(F.lit(None).cast("double"))) is None
    assert [one(spark, S.round_half_even(F.lit(x))) for x in (0.5, 1.5, 2.5, 2.500001, 150 * 0.07)] == [round(x) for x in (0.5, 1.5, 2.5, 2.500001, 150 * 0.07)]


def test_hex_round_trip(spark):
    for x in (0, 1, -1, -4, 1 << 62):
        assert one(spark, S.hex_to_long(S.long_to_hex(F.lit(x).cast("long")))) == x
    assert one(spark, S.hamming(F.lit(-1).cast("long"), F.lit(-4).cast("long"))) == 2


def test_axis_starts(spark):
    def plain(length, size, step):
        if length <= size:
            return [0]
        out = [i * step for i in range((length - size) // step + 1)]
        return out if out[-1] == length - size else [*out, length - size]

    cases = [(a, b, c) for a in (1, 639, 640, 641, 1000, 1024, 2200) for b in (416, 640) for c in (1, 208, 384, 640)]
    df = spark.createDataFrame(cases, "l int, s int, t int").select("l", "s", "t", G.axis_starts(F.col("l"), F.col("s"), F.col("t")).alias("v"))
    for r in df.collect():
        assert r.v == plain(r.l, r.s, r.t)


def area(p):
    return abs(sum(p[i][0] * p[(i + 1) % len(p)][1] - p[(i + 1) % len(p)][0] * p[i][1] for i in range(len(p)))) / 2 if len(p) > 2 else 0.0


def halfplane(p, axis, bound, above):
    """The part of a closed polygon on one side, walking its edges."""
    out = []
    for a, b in zip(p[-1:] + p[:-1], p):
        ins = [(v[axis] >= bound) if above else (v[axis] <= bound) for v in (a, b)]
        if ins[0] != ins[1]:
            d = b[axis] - a[axis]
            t = (bound - a[axis]) / d if abs(d) >= 1e-9 else 0.0
            cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
            cut[axis] = float(bound)
            out.append(tuple(cut))
        if ins[1]:
            out.append(b)
    return out


def test_clip_polygons_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.vec_id, r.window_idx): r for r in catalogue.polygon_clip_tile(spark, sf).collect()}
    want = {}
    for r in fixtures.polygons(spark, sf).collect():
        p = list(zip(r.flat[::2], r.flat[1::2]))
        for w, (x0, y0) in enumerate(((0, 0), (320, 0), (0, 320), (320, 320))):
            q = p
            for axis, bound, above in ((0, x0, True), (0, x0 + 320, False), (1, y0, True), (1, y0 + 320, False)):
                q = halfplane(q, axis, bound, above) if q else q
            if len(q) >= 3 and area(q) > 1 and area(q) / area(p) >= 0.1:
                xs, ys = [v[0] for v in q], [v[1] for v in q]
                if max(xs) - min(xs) > 1 and max(ys) - min(ys) > 1:
                    want[r.vec_id, w] = (len(q), area(q))
    assert set(got) == set(want)
    for k, (n, a) in want.items():
        assert got[k].n_points == n and abs(got[k].area - a) < 1e-5


def test_split_counts_edges(spark):
    got = {(r.n, r.valid_ratio): (r.train, r.valid, r.test) for r in catalogue.split_counts_table(spark, None).collect()}
    assert got[0, 0.07] == (0, 0, 0) and got[1, 0.07] == (1, 0, 0) and got[2, 0.07] == (1, 1, 0) and got[3, 0.07] == (1, 1, 1)
    for n in range(3, 201):
        for v in (0.07, 0.1):
            assert sum(got[n, v]) == n and min(got[n, v]) >= 1


def test_matching_equals_the_sequential_matcher(spark):
    rng = random.Random(8)
    box = lambda: (lambda x, y: (x, y, x + rng.randrange(5, 40), y + rng.randrange(5, 40)))(rng.randrange(80), rng.randrange(80))
    dets = [(i, rng.randrange(6), "g1", round(rng.random(), 1), *box()) for i in range(200)]
    gts = [(1000 + i, rng.randrange(6), "g1", 0.0, *box()) for i in range(60)]
    schema = "event_id long, image_id long, grp string, score double, x1 long, y1 long, x2 long, y2 long"
    d, g = spark.createDataFrame(dets, schema), spark.createDataFrame(gts, schema)

    def iou(a, b):
        w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)

    for thr in (0, 3):
        taken, want = set(), {}
        for x in sorted(dets, key=lambda r: (-r[3], r[0])):
            over = [(iou(x[4:], y[4:]), -y[0]) for y in gts if y[1] == x[1]]
            best = max(over, default=(0, 0))
            hit = best[0] > 0 and best[0] >= 0.5 + 0.05 * thr and -best[1] not in taken
            taken |= {-best[1]} if hit else set()
            want[x[0]] = int(hit)
        got = {r.event_id: r.tp for r in evaluate.flags(evaluate.matched(d, g), F.array(F.lit(thr))).collect()}
        assert got == want

    kept = {}
    for x in sorted(dets, key=lambda r: (-r[3], r[0])):
        k = kept.setdefault(x[1], [])
        if len(k) < 9 and all(iou(x[4:], y[4:]) <= 0.3 for y in k):
            k.append(x)
    got = {(r.image_id, r.event_id) for r in evaluate.suppressed(d, 0.3, 9).collect()}
    assert got == {(x[1], x[0]) for k in kept.values() for x in k}


def test_no_truth_and_no_detections(spark):
    schema = "event_id long, image_id long, grp string, score double, x1 long, y1 long, x2 long, y2 long"
    d = spark.createDataFrame([(1, 1, "g01", 0.9, 0, 0, 10, 10)], schema)
    g = spark.createDataFrame([(2, 2, "g02", 0.0, 0, 0, 10, 10)], schema)
    ap = {(r.subset, r.thr_idx): r.ap for r in evaluate.average_precision(d, g).collect()}
    assert ap["g01", 0] is None and ap["g02", 0] == 0.0 and ap["overall", 0] == 0.0
    at = {r.subset: r for r in evaluate.at_confidence(d, g).collect()}
    assert math.isnan(at["g01"].recall) and math.isnan(at["g01"].f1) and at["g02"].precision == 0.0 and at["g02"].fn == 1
    perfect = evaluate.average_precision(d, d).filter("subset = 'overall' and thr_idx = 9").first()
    assert perfect.ap == 1.0
    assert evaluate.average_precision(d.limit(0), g.limit(0)).count() == 0


def test_known_average_precisions(spark):
    got = {r.subset: r.ap for r in catalogue.eval_ap_by_subset(spark, "/root/testdata/sf0.01").filter("thr_idx = 0").collect()}
    assert {k: v and round(v, 6) for k, v in got.items()} == {"overall": 0.168566, "g01": 0.264777, "g02": 0.190657, "g03": None, "g04": 0.210434, "g05": 0.218355}


def test_near_pairs_equal_all_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(31) for _ in range(60)]
    sigs = [b ^ (1 << rng.randrange(31)) ^ (1 << rng.randrange(31)) for b in base] + base + base[:5]
    df = spark.createDataFrame(list(enumerate(sigs)), "doc_id long, sig long")
    first = {a: sigs.index(a) for a in sigs}
    want = {(i, j, sigs.count(a), sigs.count(b), (a ^ b).bit_count()) for a, i in first.items() for b, j in first.items() if i < j and (a ^ b).bit_count() <= 2}
    assert {tuple(r) for r in dedupe.near_document_pairs(df).collect()} == want
    for threshold, bits in ((0, 32), (3, 32), (4, 64)):
        got = {(r.a, r.b) for r in dedupe.near_pairs(df, threshold, bits).collect()}
        assert got == {(a, b) for a in first for b in first if a < b and (a ^ b).bit_count() <= threshold}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    labels_ = {r.node: r.label for r in graph.components(edges).collect()}
    assert {labels_[i] for i in range(61)} == {0} and labels_[101] == 100


def test_unique_names_and_dense_ids(spark):
    df = spark.createDataFrame([("p", i, n) for i, n in enumerate(["a.jpg", "a.jpg", "b.jpg", "a.jpg", "c"])], "part string, image_id long, file_name string")
    images, anns = merge.merge_parts(df, spark.createDataFrame([("p", 1, 1), ("p", 9, 1), ("p", 1, 2)], "part string, image_id long, ann_pos int"), stretch=2)
    assert [(r.new_id, r.file_name) for r in images.orderBy("new_id").collect()] == [(1, "a.jpg"), (2, "a_1.jpg"), (3, "b.jpg"), (4, "a_2.jpg"), (5, "c")]
    assert [(r.new_ann_id, r.new_id) for r in anns.orderBy("new_ann_id").collect()] == [(1, 2), (2, 2)]


@pytest.mark.parametrize("line,error", [("", None), ("0 1", "too_few_values"), ("0 a 1 1 1", "non_numeric"), ("0 .1 .2 .3 .4 .5", "invalid_polygon"), ("0 .5 .5 0 .1", "invalid_bbox"), ("x .5 .5 .2 .1", None), ("0 .5 .5 .1 .9 .1 .1", None)])
def test_convert_policy(spark, line, error):
    r = labels.convert(spark.createDataFrame([(line,)], "line string")).first()
    assert r.error == error and (r.xc is None) == (line == "" or error is not None)


def test_policies_differ(spark):
    lines = spark.createDataFrame([("0 1.2 .5 .3 .4",), ("bad .5 .5 .2 .2",), ("0 .5 .5 0 .2",)], "line string")
    assert labels.audit(lines).count() == 1
    assert labels.evaluation(lines, F.lit(100), F.lit(100)).count() == 3
    assert labels.convert(lines).filter("error is null").count() == 2


def test_splits_hold_their_constraints(spark):
    s = split.assign(fixtures.sources(spark, "/root/testdata/sf0.01"))
    assert split.empty_cells(s).count() == 0
    alone = s.dropDuplicates(["content_hash"])
    assert split.leaks(alone).count() == 0


def test_best_epoch_takes_the_first_tie_and_missing_metrics_last(spark):
    rows = spark.createDataFrame([("a", 1, None, 0.1, None, 0.1), ("a", 2, 0.2, 0.2, 0.5, None), ("a", 3, 0.3, 0.3, 0.5, 0.3), ("b", 7, 0.1, 0.1, None, 0.1)], "stage string, epoch int, precision double, recall double, mAP50 double, mAP50_95 double")
    got = {r.stage: r for r in metrics.best_epoch(rows).collect()}
    assert got["a"].best_epoch == 2 and math.isnan(got["a"].mAP50_95) and got["b"].best_epoch == 7 and math.isnan(got["b"].mAP50)


def test_empty_tiles_are_capped(spark):
    tiles = spark.createDataFrame([(1, "02", i, False, 2, int(i == 3)) for i in range(6)] + [(2, "01", i, False, None, 0) for i in range(4)] + [(3, "04", 0, True, 0, 0)], "image_id long, grp string, window_idx int, ignore_negative boolean, max_empty int, n_ann long")
    assert sorted((r.image_id, r.window_idx) for r in tiling.cap_empty(tiles).collect()) == [(1, 0), (1, 1), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)]


def test_names_are_those_of_one_pass_over_the_rows(spark):
    def plain(names):
        taken, out = set(), []
        for x in names:
            stem, dot, tail = x.rpartition(".")
            base, tail = (stem, dot + tail) if stem else (x, "")
            k, new = 0, x
            while new in taken:
                k += 1
                new = f"{base}_{k}{tail}"
            taken.add(new)
            out.append(new)
        return out

    rng = random.Random(5)
    cases = [["a.jpg", "a.jpg", "a_1.jpg"], ["a_1.jpg", "a.jpg", "a.jpg", "a_1.jpg", "a_1_1.jpg"], ["x", "x", "x_1", ".jpg", ".jpg"]]
    cases += [[rng.choice(["a", "a_1", "a_2", "a_1_1", "b", "b_01", "c.d"]) + rng.choice([".jpg", ".png", ""]) for _ in range(40)] for _ in range(3)]
    for names in cases:
        df = spark.createDataFrame(list(enumerate(names)), "i int, file_name string")
        got = {r.i: r.file_name for r in merge.unique_names(df, "file_name", [F.col("i")]).collect()}
        assert [got[i] for i in range(len(names))] == plain(names)


def test_fixed_point_text(spark):
    rng = random.Random(1)
    xs = [0.0, 1.0, 0.1234565, 5e-7, 2**-30, 2.5, 0.125, 99.995] + [rng.random() for _ in range(500)] + [(rng.randrange(10**6) + 0.5) / 1e6 for _ in range(500)] + [k / 2**7 for k in range(129)]
    for digits in (6, 2):
        for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", S.fixed(F.col("x"), digits).alias("t")).collect():
            assert r.t == f"{r.x:.{digits}f}"
    assert one(spark, S.percent(F.lit(0.29496))) == "29.50%"


def test_curve_of_scores_crowded_near_zero(spark):
    rng = random.Random(2)
    rows = [(i, "all", rng.choice([1e-9, 1e-5, 0.001, 0.5]) * rng.random() if i % 50 else 0.0, rng.randrange(2)) for i in range(600)]
    got = {r.event_id: (r["rank"], r.ctp) for r in evaluate.curve(spark.createDataFrame(rows, "event_id long, subset string, score double, tp int"), ["subset"]).collect()}
    hits = 0
    for n, (i, _, _, tp) in enumerate(sorted(rows, key=lambda r: (-r[2], r[0]))):
        hits += tp
        assert got[i] == (n + 1, hits)


def test_arguments_and_private_columns(spark):
    for bad in ({"slice_size": 0, "overlap": 0.1}, {"slice_size": 1, "overlap": 0.9}, {"slice_size": 1, "overlap": 0.1, "batch": 0}, {"slice_size": 1, "overlap": 0.1, "near_threshold": -1}):
        with pytest.raises(ValueError):
            evaluate.check_arguments(**bad)
    evaluate.check_arguments(768, 0.25)
    assert evaluate.public(spark.range(1).select(F.col("id").alias("_a"), F.col("id").alias("b"))).columns == ["b"]


def test_metrics_as_json_with_nan_and_null(spark):
    import json

    rows = evaluate.json_of(evaluate.summary_rows(fixtures.detections(spark, "/root/testdata/sf0.001"), fixtures.truth(spark, "/root/testdata/sf0.001"))).collect()
    got = {r.subset: json.loads(r.value) for r in rows}
    assert got["g03"]["map50"] is None and math.isnan(got["g03"]["recall_at_conf"]) and got["g03"]["ap_by_iou"]["0.50"] is None
    assert len(got["overall"]["ap_by_iou"]) == 10 and got["overall"]["name"] == "overall" and "NaN" in next(r.value for r in rows if r.subset == "g03")
