"""Text expressions, gates, packaging, files, job state, browsing and the command line."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from utterframe import cli, config
from utterframe.functions import text as tx
from utterframe.operators import browse, package, quality
from utterframe.operators.jobstore import JobStore
from utterframe.operators.order import numbered
from utterframe.sources import files, media


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def test_text_as_python_has_it(spark):
    for s in ["Hello, World!", "it's_ok 42", "", "Ünïcödé-ß", "हिन्दी।", "a²½Ⅷ"]:
        import re

        assert one(spark, tx.normalize, s) == re.sub(r"[^\w]", "", s).lower()
        assert one(spark, tx.quoted, s) == repr(s)
    for s in ["  a ", "  a　", "\x1ca\x1f", "​a"]:
        assert one(spark, tx.strip, s) == s.strip()
    for s, want in [("a.", True), ("a. ", True), ('a."', False), ("好。", True), ("؟", True), ("", False), ("a", False)]:
        assert one(spark, tx.ends_sentence, s) is want
    for v in [0.125, 1.005, 2.675, -0.0, 1e10, 3.14159]:
        assert one(spark, lambda c: tx.fixed(c, 2), v, "double") == f"{v:.2f}"
        assert one(spark, lambda c: tx.rounded(c, 3), v, "double") == round(v, 3)
    assert one(spark, lambda c: tx.segment_id(F.lit("v"), c), 7, "int") == "v_00007"
    assert one(spark, lambda c: tx.segment_id(F.lit("v"), c), 123456, "int") == "v_123456"


def test_ids(spark):
    cases = {
        "dQw4w9WgXcQ": "dQw4w9WgXcQ", "https://www.youtube.com/watch?v=dQw4w9WgXcQ&t=1": "dQw4w9WgXcQ",
        "https://youtu.be/dQw4w9WgXcQ": "dQw4w9WgXcQ", "https://www.youtube.com/shorts/dQw4w9WgXcQ": "dQw4w9WgXcQ", "nothing": None,
    }
    got = media.ad_hoc(spark.createDataFrame([(u,) for u in cases], "url string")).collect()
    assert {r.url: r.video_id for r in got} == cases
    assert [r.error is None for r in got] == [v is not None for v in cases.values()]


def test_a_failing_channel_is_a_row(spark):
    def listing(channel):
        if channel == "bad":
            raise RuntimeError("no such channel")
        return ["a", "", " b "]

    got = media.discover(spark.createDataFrame([("good",), ("bad",)], "channel string"), listing, max_concurrency=1).collect()
    assert sorted(((r.video_id, r.error) for r in got), key=str) == sorted([("a", None), ("b", None), (None, "no such channel")], key=str)


def test_downloads(spark):
    def runner(args, timeout=None):
        if args[0] == "ffprobe":
            return media.Ran(0, "12.5\n") if timeout == 30.0 else media.Ran(1)
        assert timeout == 7 and args[1:9] == ["-f", "bestaudio/best", "-x", "--audio-format", "opus", "--no-keep-video", "--no-playlist", "-o"]
        assert args[10:14] == ["--print", "after_move:filepath", "--limit-rate", "1M"]
        return media.Ran(1, "", "gone") if args[-1].endswith("x") else media.Ran(0, "log\n" + args[9].replace("%(ext)s", "opus") + "\n\n")

    rows = spark.createDataFrame([("a", None, "u/a", None), ("x", None, "u/x", None)], "video_id string, channel string, url string, error string")
    got = media.download(rows, "/tmp/utterframe-none", runner, audio_format="opus", rate_limit="1M", timeout_s=7).orderBy("video_id").collect()
    assert [(r.video_id, r.raw_path, r.duration_s, r.error) for r in got] == [("a", "/tmp/utterframe-none/a.opus", 12.5, None), ("x", None, None, "gone")]
    assert "--limit-rate" not in media.download_arguments("u", "v", "f", "m4a")


def test_playlist():
    assert media.playlist(lambda args, timeout: media.Ran(0, f"{args[-1]}1\n{timeout}\n"))("c") == ["c1", "300.0"]
    with pytest.raises(RuntimeError, match="no such"):
        media.playlist(lambda args, timeout: media.Ran(1, "", "no such channel"))("c")


def test_local_folder(spark, tmp_path):
    for name in ["b.MP3", "_a.wav", "notes.txt"]:
        (tmp_path / name).write_bytes(b"")
    assert [r.video_id for r in media.local_files(spark, str(tmp_path)).collect()] == ["_a", "b"]
    assert media.local_files(spark, str(tmp_path / "none")).count() == 0


SEG = "video_id string, idx int, duration double, language string, has_overlap boolean, measured double"


def test_gates_in_order(spark):
    rows = [
        ("a", 0, 5.0, "en", True, 4.0), ("a", 1, 0.5, "en", False, 4.0), ("a", 2, 5.0, "fr", False, 4.0), ("a", 3, 5.0, None, False, None),
        ("a", 4, 5.0, "en", False, 1.234), ("a", 5, 5.0, "en", False, 3.0),
    ]
    seen = spark.sparkContext.accumulator(0)

    def score(df):
        @F.udf("double")
        def measure(v):
            seen.add(1)
            return v

        blank = F.lit(None).cast("double")
        return df.withColumns({"sig": blank, "bak": blank, "ovr": measure("measured")})

    cfg = config.Filter(reject_overlapping_speech=True, min_duration_s=1.0, allowed_languages=["en"], min_dnsmos_ovr=2.5)
    got = quality.filter_segments(spark.createDataFrame(rows, SEG), cfg, score).orderBy("idx").collect()
    assert [r.reason for r in got] == [
        "overlapping multi-speaker speech detected", "duration 0.50s below min_duration_s", "language 'fr' not in allowed_languages",
        "dnsmos scoring failed", "dnsmos_ovr 1.23 below threshold", None,
    ]
    assert [r.passed for r in got] == [False] * 5 + [True] and got[0].dnsmos_ovr is None and seen.value >= 3
    off = quality.filter_segments(spark.createDataFrame(rows, SEG), config.Filter(enabled=False), score)
    assert off.where("passed").count() == 6
    unscored = quality.filter_segments(spark.createDataFrame(rows, SEG), config.Filter(min_dnsmos_ovr=None, reject_overlapping_speech=False), score)
    assert unscored.where("passed and dnsmos_ovr is null").count() == 6


def packaged(spark):
    word = "array<struct<text:string,start:double,end:double,speaker:string,overlap:boolean>>"
    rows = [
        ("vid1", 0, 100.0, 102.0, "hi", [("hi", 100.5, 102.0, "A", False)], "A", False, False),
        ("vid1", 1, 103.0, 106.0, "yo", [("yo", 103.0, 106.0, None, True)], "B", False, True),
        ("_vid2", 0, 0.0, 4.0, "é \"q\"", [("é", 0.0, 4.0, "", False)], "A", True, False),
    ]
    ddl = f"video_id string, idx int, start double, end double, text string, words {word}, speaker string, exceeds_max_duration boolean, has_overlap boolean"
    videos = spark.createDataFrame([("vid1", "u1"), ("_vid2", "u2")], "video_id string, url string")
    return package.documents(spark.createDataFrame(rows, ddl), videos)


def test_documents_on_disk(spark, tmp_path):
    out = str(tmp_path)
    assert files.write_documents(packaged(spark), out) == 3
    body = json.loads(Path(out, "vid1_00000.json").read_text(encoding="utf-8"))
    assert list(body)[:4] == ["segment_id", "video_id", "source_url", "start"] and body["duration"] == 2.0 and body["language"] is None
    assert (body["words"][0]["clip_start"], body["words"][0]["clip_end"]) == (0.5, 2.0)
    docs = files.read_documents(spark, out)
    totals = package.dataset_totals(docs).first()
    assert tuple(totals) == (3, 2, 2, 9.0)
    assert {tuple(r) for r in package.speaker_stats(docs).collect()} == {("A", 2, 6.0), ("B", 1, 3.0)}
    assert [tuple(r) for r in package.speaker_hours(docs, "path").collect()] == [("A", 2, 6 / 3600), ("B", 1, 3 / 3600)]
    assert files.write_manifest(docs, f"{out}/manifest.jsonl") == 3
    lines = [json.loads(x) for x in Path(out, "manifest.jsonl").read_text(encoding="utf-8").splitlines()]
    assert [x["segment_id"] for x in lines] == ["_vid2_00000", "vid1_00000", "vid1_00001"]
    files.write_csv(package.listing(docs, "flac").orderBy("no"), f"{out}/m.csv")
    assert Path(out, "m.csv").read_bytes().decode() == 'no,filename,text\r\n1,_vid2_00000.flac,"é ""q"""\r\n2,vid1_00000.flac,hi\r\n3,vid1_00001.flac,yo\r\n'
    kept, removed = package.kept_speakers(docs, ["A"])
    assert (kept.count(), removed.count()) == (2, 1)
    (tmp_path / "vid1_00001.flac").write_bytes(b"")
    assert files.remove_segments(out, spark.createDataFrame([("vid1_00001",)], "segment_id string")) == 1 and not (tmp_path / "vid1_00001.json").exists()
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        files.read_documents(spark, out).collect()


def test_browsing(spark):
    docs = packaged(spark).withColumn("dnsmos_ovr", F.when(F.col("idx") == 0, 3.14159) if "idx" in packaged(spark).columns else F.lit(3.14159))
    label = browse.choices(docs, "vid1", "A").first()["label"]
    assert label == "vid1_00000  |  A  |  2.0s, dnsmos=3.14"
    assert [r.segment_id for r in browse.choices(docs, "All", None).collect()] == ["_vid2_00000", "vid1_00000", "vid1_00001"]
    assert {tuple(r) for r in browse.facets(docs).collect()} == {("video", "All"), ("speaker", "All"), ("video", "vid1"), ("video", "_vid2"), ("speaker", "A"), ("speaker", "B")}
    spoken = {(r.segment_id, r.text): r.speaker for r in browse.transcript(docs).collect()}
    assert spoken == {("vid1_00000", "hi"): "A", ("vid1_00001", "yo"): "B", ("_vid2_00000", "é"): "A"}
    flags = spark.createDataFrame([("s", i, i * 0.5, i * 0.5 + 0.5, f) for i, f in enumerate([False, True, True, False, True])], "s string, i int, start double, end double, overlap boolean")
    assert sorted((r.start, r.end) for r in browse.overlap_ranges(flags, ["s"], "i").collect()) == [(0.5, 1.5), (2.0, 2.5)]


def test_numbers_without_one_task(spark):
    df = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    got = numbered(df, "k").collect()
    assert [r.k for r in sorted(got, key=lambda r: r.no)] == sorted(r.k for r in got) and {r.no for r in got} == set(range(1, 1001))
    assert numbered(df.limit(0), "k").count() == 0


def test_job_store(spark, tmp_path):
    store = JobStore(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "u1", 0), ("a", "u2", 1), ("b", "u3", 2)], "video_id string, url string, r int")
    assert store.add("videos", rows, "r") == 2 and store.add("videos", rows, "r") == 0
    assert {r.video_id: r.url for r in store.read("videos").collect()} == {"a": "u1", "b": "u3"}
    store.update("videos", spark.createDataFrame([("a", "RUNNING", None)], "video_id string, status string, url string"))
    assert {r.video_id: (r.status, r.url) for r in store.read("videos").collect()} == {"a": ("RUNNING", None), "b": ("PENDING", "u3")}
    assert store.recover_stale_running(3600) == 0
    assert store.read("videos").where("status = 'RUNNING'").count() == 1
    assert store.recover_stale_running() == 1
    assert store.read("videos").where("status = 'PENDING'").count() == 2
    born = store.get("videos", "b")["created_at"]
    store.put("videos", spark.createDataFrame([("b", "DONE"), ("c", "DONE")], "video_id string, status string"))
    assert {r.video_id: r.status for r in store.read("videos").collect()} == {"a": "PENDING", "b": "DONE", "c": "DONE"}
    assert store.get("videos", "b")["created_at"] == born and store.get("videos", "z") is None and store.get("superchunks", "a", 0) is None
    store.put("videos", spark.createDataFrame([("b", "PENDING")], "video_id string, status string"), without=spark.createDataFrame([("c",)], "video_id string"))
    assert len([p for p in tmp_path.rglob("videos-*") if p.is_dir()]) <= 2
    assert store.reset("a") == {"videos": 1, "superchunks": 0, "segments": 0}
    assert [r.PENDING for r in store.counts().collect()] == [1]


def test_config_and_cli(spark, tmp_path, capsys):
    path = tmp_path / "c.yaml"
    body = f"paths:\n  output_dir: {tmp_path}/out\n  db_path: {tmp_path}/db\nvad:\n  overlap_s: 1.5\n"
    path.write_text(body + "  loudness: 3\nunknown: 1\n")
    with pytest.raises(ValueError, match="unknown"):
        config.load_config(path)
    path.write_text(body + "asr:\n  diarize_fill_nearest: true\nresources:\n  ram_floor_mb: 1\nqueues:\n  maxsize_per_stage: 2\n")
    cfg = config.load_config(path)
    assert cfg.asr.diarize_fill_nearest and cfg.filter.reject_overlapping_speech and cfg.download.audio_format == "m4a"
    assert cfg.vad.overlap_s == 1.5 and cfg.vad.max_superchunk_s == 90.0
    files.write_documents(packaged(spark), cfg.paths.output_dir)
    args = ["--config", str(path)]
    for command, said in [("check-config", "OK"), ("status", "videos PENDING=0"), ("manifest", "3 segments"), ("stats", "A: 2 segments"), ("view", "vid1_00000")]:
        assert cli.main([command, *args], spark) == 0
        assert said in capsys.readouterr().out
    assert cli.main(["filter-speakers", *args, "--keep", "A", "--dry-run"], spark) == 0
    assert "kept 2, removed 1 (dry run)" in capsys.readouterr().out
    cli.main(["filter-speakers", *args, "--keep", "A"], spark)
    assert files.read_documents(spark, cfg.paths.output_dir).count() == 2
    cli.main(["reset", *args, "--yes"], spark)
    assert "videos" in capsys.readouterr().out


def test_costs():
    assert config.estimate_cost({"vad": 3e6}, "vad", 2.5) == 7_500_000 and config.estimate_cost({}, "vad", 2.5) == 0
    assert config.estimate_cost({"vad": 3e6}, "vad", -1) == 0
    assert config.worker_specs(config.Asr(num_workers=0)) == [("cpu", 0)]
    assert config.worker_specs(config.Asr(num_workers=0), [1, 2]) == [("cuda", 1), ("cuda", 2)]
    assert config.worker_specs(config.Asr(num_workers=1, device="cpu"), [1, 2]) == [("cpu", 0)]
    assert [config.compute_type(config.Asr(compute_type=c), d) for c, d in (("auto", "cuda"), ("auto", "cpu"), ("int4", "cuda"))] == ["float16", "int8", "int4"]
