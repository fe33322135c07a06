"""Capped merges, overlap padding, cross-talk and speaker assignment on literal and random spans."""

import random

from pyspark.sql import functions as F

from utterframe.operators import turns as tn
from utterframe.operators import vad

REGION = "video_id string, ridx int, start double, end double"
TURN = "video_id string, tidx int, start double, end double, speaker string"
WORD = "video_id string, widx int, text string, start double, end double"


def regions(spark, spans):
    return spark.createDataFrame([("v", i, float(a), float(b)) for i, (a, b) in enumerate(spans)], REGION)


def spans(df, *order):
    return [(r.start, r.end) for r in df.orderBy(*order).collect()]


def test_merge_under_and_over_the_cap(spark):
    assert spans(vad.merge_regions(regions(spark, [(0, 10), (12, 20), (25, 40)]), 90.0), "cidx") == [(0, 40)]
    assert spans(vad.merge_regions(regions(spark, [(0, 20), (25, 45), (48, 60)]), 50.0), "cidx") == [(0, 45), (48, 60)]
    assert spans(vad.merge_regions(regions(spark, []), 50.0), "cidx") == []


def test_a_later_region_may_shorten_a_chunk(spark):
    assert spans(vad.merge_regions(regions(spark, [(0, 30), (5, 10)]), 50.0), "cidx") == [(0, 10)]


def test_forced_split(spark):
    pieces = spans(vad.force_split(vad.merge_regions(regions(spark, [(0, 200)]), 90.0), 90.0), "cidx", "piece")
    assert len(pieces) == 3 and pieces[-1][1] == 200 and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False))
    assert spans(vad.force_split(vad.merge_regions(regions(spark, [(0, 200)]), 0.0), 0.0), "cidx") == [(0, 200)]


def test_padding(spark):
    chunks = regions(spark, [(0, 30), (30, 60), (60, 90)])
    assert spans(vad.pad_overlap(chunks, 2.5, F.lit(90.0), ["ridx"]), "idx") == [(0, 32.5), (27.5, 62.5), (57.5, 90)]
    assert spans(vad.superchunks(regions(spark, [(0, 10), (95, 100)]), 90.0, 2.0, F.lit(100.0)), "idx") == [(0, 12), (93, 100)]


def test_cross_talk_against_a_sweep(spark):
    random.seed(3)
    rows = [(f"v{v}", i, float(a), float(a + random.randrange(0, 6)), random.choice("ABC")) for v in range(80) for i in range(random.randrange(0, 8)) for a in [random.randrange(20)]]
    want = set()
    for v in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == v]
        points = sorted({p for r in mine for p in r[2:4]})
        hot = [(a, b) for a, b in zip(points, points[1:], strict=False) if len({r[4] for r in mine if r[2] <= a and b <= r[3]}) > 1]
        merged = []
        for a, b in hot:
            if merged and merged[-1][1] == a:
                merged[-1] = (merged[-1][0], b)
            else:
                merged.append((a, b))
        want |= {(v, *m) for m in merged}
    assert {tuple(r) for r in tn.overlap_regions(spark.createDataFrame(rows, TURN)).collect()} == want


def test_speakers_of_words(spark):
    turns = spark.createDataFrame([("v", 0, 0.0, 4.0, "A"), ("v", 1, 5.0, 10.0, "B"), ("v", 2, 5.0, 10.0, "C")], TURN)
    words = spark.createDataFrame([("v", 0, "x", 0.0, 1.0), ("v", 1, "y", 5.0, 6.0), ("v", 2, "z", 4.0, 4.5), ("u", 0, "w", 0.0, 1.0)], WORD)
    plain = {(r.video_id, r.widx): r.speaker for r in tn.assign_speakers(words, turns).collect()}
    assert plain == {("v", 0): "A", ("v", 1): "B", ("v", 2): None, ("u", 0): None}
    near = {(r.video_id, r.widx): r.speaker for r in tn.assign_speakers(words, turns, fill_nearest=True).collect()}
    assert near == {("v", 0): "A", ("v", 1): "B", ("v", 2): "A", ("u", 0): None}
    regions_ = tn.overlap_regions(turns)
    flags = {(r.video_id, r.widx): r.overlap for r in tn.flag_overlap(words, regions_).collect()}
    assert flags == {("v", 0): False, ("v", 1): True, ("v", 2): False, ("u", 0): False}


def test_shift(spark):
    local = spark.createDataFrame([("v", 0, 0, "x", 1.0, 1.5)], "video_id string, chunk_idx int, widx int, text string, start double, end double")
    chunks = spark.createDataFrame([("v", 0, 10.0)], "video_id string, idx int, start double")
    assert [(r.start, r.end, r.speaker, r.overlap) for r in tn.shift_to_video(local, chunks).collect()] == [(11.0, 11.5, None, False)]
