"""The whole run and the streaming barrier, with stand-ins for models and tools."""

import json
from dataclasses import replace
from pathlib import Path

from utterframe import config
from utterframe.operators import rechunk
from utterframe.operators.jobstore import JobStore
from utterframe.pipeline import Models, run
from utterframe.sources.media import Ran
from utterframe.streaming import barrier


def setting(tmp_path, **models):
    def runner(args, timeout=None):
        Path(args[-1]).parent.mkdir(parents=True, exist_ok=True)
        Path(args[-1]).write_bytes(b"sound")
        return Ran(0)

    def words(path, start, end):
        with open(tmp_path / "heard", "a") as f:
            f.write(f"{start}\n")
        said = [("Good", 0.0, 0.5), ("evening.", 0.5, 1.0)] if start == 0 else [("We", 0.2, 0.5), ("leave", 0.5, 0.7), ("now.", 0.7, 1.2)]
        return [{"text": t, "start": s, "end": e} for t, s, e in said], "en"

    sound = tmp_path / "in"
    sound.mkdir()
    (sound / "talk.mp3").write_bytes(b"x")
    cfg = config.Config(
        sources=config.Sources(local_dir=str(sound)), paths=config.Paths(str(tmp_path / "work"), str(tmp_path / "out"), str(tmp_path / "db")),
        vad=config.Vad(max_superchunk_s=6.0, overlap_s=0.0), rechunk=config.Rechunk(min_segment_s=0.1, max_segment_s=2.0),
        filter=config.Filter(min_dnsmos_ovr=2.5),
    )
    made = {
        "speech": lambda vad: lambda path: [(0.0, 5.0), (5.0, 10.0)], "words": lambda asr: words, "listing": lambda c: [], "runner": runner,
        "score": lambda gate: lambda path: (4.0, 4.0, 4.0),
    } | models
    heard = lambda: (tmp_path / "heard").read_text().split() if (tmp_path / "heard").exists() else []
    return cfg, Models(**made), words, runner, heard


def test_run(spark, tmp_path):
    cfg, models, _, _, heard = setting(tmp_path)
    assert run(spark, cfg, models) == {"DONE": 2}
    docs = [json.loads(p.read_text()) for p in sorted((tmp_path / "out").glob("*.json"))]
    assert [d["text"] for d in docs] == ["Good evening.", "We leave now."] and {d["language"] for d in docs} == {"en"}
    assert (tmp_path / "out" / "talk_00000.flac").exists()
    store = JobStore(spark, cfg.paths.db_path)
    assert store.get("videos", "talk")["status"] == "DONE" and store.get("segments", "talk", 1)["output_json_path"].endswith("talk_00001.json")
    n = len(heard())
    assert run(spark, cfg, models) == {"DONE": 2} and len(heard()) == n


def test_a_chunk_that_fails_once_is_heard_again(spark, tmp_path):
    cfg, models, words, _, heard = setting(tmp_path)

    def broken(path, start, end):
        if start > 0:
            raise RuntimeError("no memory")
        return words(path, start, end)

    assert run(spark, cfg, replace(models, words=lambda asr: broken)) == {}
    store = JobStore(spark, cfg.paths.db_path)
    assert store.get("videos", "talk")["status"] == "PENDING" and store.get("superchunks", "talk", 1)["error"] == "no memory"
    assert heard() == ["0.0"]
    assert run(spark, cfg, models) == {"DONE": 2}
    assert heard() == ["0.0", "5.0"]  # the chunk that was DONE isn't heard again
    assert store.get("videos", "talk")["status"] == "DONE" and store.get("superchunks", "talk", 1)["status"] == "DONE"
    assert sorted(json.loads(p.read_text())["text"] for p in (tmp_path / "out").glob("*.json")) == ["Good evening.", "We leave now."]


def test_slices_that_fail_and_clips_that_are_rejected(spark, tmp_path):
    cfg, models, _, runner, _ = setting(tmp_path, score=lambda gate: lambda path: (1.0, 1.0, 1.0 if path.endswith("00000.flac") else 4.0))

    def cut(args, timeout=None):
        return Ran(1, "", "disk full") if args[-1].endswith("00001.flac.tmp") else runner(args)

    assert run(spark, cfg, replace(models, runner=cut)) == {"FAILED": 2}
    store = JobStore(spark, cfg.paths.db_path)
    assert store.get("segments", "talk", 0)["error"] == "filtered: dnsmos_ovr 1.00 below threshold"
    assert store.get("segments", "talk", 1)["error"] == "disk full" and store.get("segments", "talk", 1)["text"] == "We leave now."
    assert not list((tmp_path / "out").glob("*.flac*")) and not list((tmp_path / "out").glob("*.json"))


def test_barrier(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def put(name, video, idx, n, text):
        word = {"widx": 0, "text": text, "start": idx * 10.0, "end": idx * 10.0 + 1, "speaker": None, "overlap": False}
        row = {"video_id": video, "chunk_idx": idx, "n_chunks": n, "chunk_start": idx * 10.0, "chunk_end": idx * 10.0 + 10, "status": "DONE", "words": [word]}
        (source / name).write_text(json.dumps(row))

    segment = lambda df: rechunk.rechunk(rechunk.merge_superchunks(df), gap=0.25, longest=20.0, shortest=0.1)

    def go():
        barrier.run_incrementally(spark, str(source), str(tmp_path / "state"), str(tmp_path / "out"), segment, files_per_batch=1).awaitTermination()
        return sorted((r.video_id, r.text) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put("1.json", "a", 0, 2, "one.")
    put("2.json", "b", 0, 1, "whole.")
    assert go() == [("b", "whole.")]
    put("3.json", "a", 1, 2, "two.")
    assert go() == [("a", "one. two."), ("b", "whole.")]
