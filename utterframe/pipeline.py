"""The whole run: sources to packaged segments, one table after the other; models and tools are callables.

Every stage's result is a version in the job store or a table in the work folder, so that a run that stopped goes on
from what is there (``resume`` first sets what was RUNNING to PENDING). A video is DONE when all its chunks are and its
segments are judged; until then every run drives it again and hears only the chunks that aren't DONE: the words of the
others come from the store.

The work and output folders and the job store are paths that the driver and all executors share; media files, clips and
documents are written there by tools and tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe.config import Asr, Config, Filter, Vad
from utterframe.functions.text import segment_id, strip
from utterframe.operators import jobstore, package, quality, rechunk, turns, vad
from utterframe.operators.turns import first_seen_mode, words_payload
from utterframe.sources import files, media
from utterframe.sources.media import Runner

#: What each factory makes of its settings, once in a worker, is called with paths and gives plain data.
SpeechModel = Callable[[Vad], Callable[[str], list[tuple[float, float]]]]
WordModel = Callable[[Asr], Callable[[str, float, float], tuple[list[dict], str | None]]]
TurnModel = Callable[[Asr], Callable[[str], list[tuple[float, float, str]]]]
ScoreModel = Callable[[Filter], Callable[[str], tuple[float | None, float | None, float | None]]]

WORD = "struct<text:string,start:double,end:double>"


@dataclass(frozen=True)
class Models:
    speech: SpeechModel
    words: WordModel
    listing: Callable[[str], list[str]]
    runner: Runner
    turns: TurnModel | None = None
    score: ScoreModel | None = None


def per_row(df: DataFrame, load: Callable, call: Callable, columns: str) -> DataFrame:
    """Adds columns that a worker's model gives for each row, and error for rows on which it failed."""
    from pyspark.sql import types as T

    added = T._parse_datatype_string(columns).fields
    schema = T.StructType([*df.schema.fields, *added, T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    out.append((*call(model, row), None))
                except Exception as e:  # noqa: BLE001  a row's failure is data
                    out.append((*[None] * len(added), str(e)))
            more = pd.DataFrame(out, columns=[*(f.name for f in added), "error"], index=pdf.index, dtype=object)
            yield pd.concat([pdf, more], axis=1)

    return df.mapInPandas(run, schema)


def superchunks_of(media_: DataFrame, models: Models, cfg: Config) -> DataFrame:
    """video_id, idx, start, end of each standardized file's speech."""
    call = lambda model, row: ([{"start": float(a), "end": float(b)} for a, b in model(row["standardized_path"])],)
    heard = per_row(media_, partial(models.speech, cfg.vad), call, "regions array<struct<start:double,end:double>>")
    region = heard.select("video_id", "bound", F.posexplode("regions").alias("ridx", "r")).select("video_id", "bound", "ridx", "r.start", "r.end")
    merged = vad.force_split(vad.merge_regions(region, cfg.vad.max_superchunk_s, ["ridx"]), cfg.vad.max_superchunk_s)
    bounded = merged.join(media_.select("video_id", "bound"), "video_id")
    return vad.pad_overlap(bounded, cfg.vad.overlap_s, F.col("bound"), ["cidx", "piece"]).select("video_id", "idx", "start", "end")


def words_of(chunks: DataFrame, media_: DataFrame, models: Models, cfg: Config, known: DataFrame) -> DataFrame:
    """video_id, chunk_idx, chunk_start, chunk_end, language, words (chunk time) or error.

    Chunks that ``known`` has as DONE, with the same bounds, aren't heard again.
    """
    placed = chunks.select("video_id", F.col("idx").alias("chunk_idx"), F.col("start").alias("chunk_start"), F.col("end").alias("chunk_end"))
    stored = known.where("status = 'DONE'").select(
        "video_id", F.col("idx").alias("chunk_idx"), F.col("start_s").alias("chunk_start"), F.col("end_s").alias("chunk_end"), words_payload(F.col("words_json")).alias("p")
    )
    keys = ["video_id", "chunk_idx", "chunk_start", "chunk_end"]
    kept = F.transform("p.words", lambda w: F.struct(w["text"].alias("text"), w["start"].alias("start"), w["end"].alias("end")))
    again = placed.join(stored, keys).select(*keys, F.coalesce(kept, F.array().cast(f"array<{WORD}>")).alias("words"), "p.language", F.lit(None).cast("string").alias("error"))
    fresh = placed.join(stored, keys, "left_anti").join(media_.select("video_id", "standardized_path"), "video_id")
    call = lambda model, row: model(row["standardized_path"], row["chunk_start"], row["chunk_end"])
    heard = per_row(fresh, partial(models.words, cfg.asr), call, f"words array<{WORD}>, language string")
    return heard.select(*again.columns).unionByName(again)


def turns_of(media_: DataFrame, models: Models, cfg: Config) -> DataFrame:
    call = lambda model, row: ([{"start": float(a), "end": float(b), "speaker": s} for a, b, s in model(row["standardized_path"])],)
    found = per_row(media_.select("video_id", "standardized_path"), partial(models.turns, cfg.asr), call, "turns array<struct<start:double,end:double,speaker:string>>")
    return found.select("video_id", F.posexplode("turns").alias("tidx", "t")).select("video_id", "tidx", "t.start", "t.end", "t.speaker")


def segment_videos(heard: DataFrame, spoken: DataFrame | None, cfg: Config) -> DataFrame:
    """Segments with language of the videos all of whose chunks are heard."""
    timed = F.filter("words", lambda w: w["start"].isNotNull() & w["end"].isNotNull())
    one = heard.where("error is null").select("video_id", "chunk_idx", "chunk_start", "chunk_end", F.posexplode_outer(timed).alias("widx", "w"))
    shifted = one.select(
        "video_id", "chunk_idx", "chunk_start", "chunk_end", "widx", strip(F.coalesce("w.text", F.when(F.col("widx").isNotNull(), ""))).alias("text"),
        (F.col("w.start") + F.col("chunk_start")).alias("start"), (F.col("w.end") + F.col("chunk_start")).alias("end"),
        F.lit(None).cast("string").alias("speaker"), F.lit(False).alias("overlap"),
    )
    if spoken is not None:
        keyed = shifted.withColumn("key", F.struct("chunk_idx", "widx"))
        named = turns.assign_speakers(keyed, spoken, fill_nearest=cfg.asr.diarize_fill_nearest, key="key")
        shifted = turns.flag_overlap(named, turns.overlap_regions(spoken), key="key").drop("key")
    ready = heard.groupBy("video_id").agg(F.bool_and(F.col("error").isNull()).alias("ok")).where("ok").select("video_id")
    stream = rechunk.merge_superchunks(shifted.join(ready, "video_id", "left_semi"))
    c = cfg.rechunk
    cut = rechunk.rechunk(
        stream, gap=c.silence_fallback_ms / 1000, longest=c.max_segment_s, shortest=c.min_segment_s, split_on_speaker=c.split_on_speaker_change,
        in_place=True,
    )
    language = first_seen_mode(heard.where("error is null"), ["video_id"], "language", "chunk_idx", "language")
    return cut.join(language, "video_id", "left")


def run(spark: SparkSession, cfg: Config, models: Models) -> dict[str, int]:
    """Runs what is pending and returns the counts of segments by outcome."""
    store = jobstore.JobStore(spark, cfg.paths.db_path)
    work = cfg.paths.work_dir.rstrip("/")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    if cfg.sources.local_dir:
        found = media.local_files(spark, cfg.sources.local_dir).withColumns({"error": F.lit(None).cast("string"), "source_rank": F.lit(0)})
    else:
        urls = spark.createDataFrame([(u,) for u in cfg.sources.video_urls], "url string")
        channels = spark.createDataFrame([(c,) for c in cfg.sources.channels], "channel string")
        d = cfg.discover
        found = media.discover_sources(urls, channels, models.listing, max_concurrency=d.max_concurrency, delay_s=d.request_delay_s)
    found = keep(found, "sources")
    store.add("videos", found.where("error is null").select("video_id", "channel", "url", "source_rank"), "source_rank")
    waiting = jobstore.by_status(store.read("videos"), "PENDING")
    videos = keep(waiting.select("video_id", "channel", "url"), "videos")
    store.update("videos", videos.select("video_id", F.lit("RUNNING").alias("status")))
    if cfg.sources.local_dir:
        got = media.local_results(videos).withColumn("duration_s", F.lit(None).cast("double"))
    else:
        d = cfg.download
        got = media.download(
            videos.withColumn("error", F.lit(None).cast("string")), f"{work}/raw", models.runner, audio_format=d.audio_format,
            rate_limit=d.rate_limit, timeout_s=d.timeout_s, max_concurrency=d.max_concurrency,
        )
    got = keep(got, "media")
    std = keep(media.standardize(got.where("error is null"), work, models.runner, cfg.standardize.sample_rate), "standardized")
    probed = std.where("error is null").drop("error").join(got.select("video_id", "raw_path", "duration_s"), "video_id")
    measured = media.with_duration(probed, "standardized_path", models.runner)
    media_ = keep(measured.withColumn("bound", vad.clamp_duration(F.col("probed_s"), F.col("duration_s"))).drop("probed_s"), "probed")
    supers = keep(superchunks_of(media_, models, cfg), "superchunks")
    heard = keep(words_of(supers, media_, models, cfg, store.read("superchunks")), "words")
    spoken = keep(turns_of(media_, models, cfg), "turns") if cfg.asr.diarize and models.turns else None
    segments = keep(segment_videos(heard, spoken, cfg), "segments")

    store.put("superchunks", heard.select(
        "video_id", F.col("chunk_idx").alias("idx"), F.col("chunk_start").alias("start_s"), F.col("chunk_end").alias("end_s"),
        F.to_json(F.struct("words", "language")).alias("words_json"), F.when(F.col("error").isNull(), "DONE").otherwise("FAILED").alias("status"), "error",
    ), without=supers.select("video_id").distinct())

    sliced = keep(slice_all(segments.join(media_.select("video_id", "raw_path"), "video_id"), cfg, models.runner), "sliced")
    cut = sliced.where("slice_error is null").withColumn("duration", F.col("end") - F.col("start"))
    score = (lambda df: quality.score_by_windows(df, partial(models.score, cfg.filter))) if models.score else (
        lambda df: df.withColumns({c: F.lit(None).cast("double") for c in ("sig", "bak", "ovr")})
    )
    judged = keep(quality.filter_segments(cut, cfg.filter, score), "judged")
    files.remove_files(judged.where("not passed").select("audio_path"))
    docs = package.documents(judged.where("passed"), store.read("videos"))
    files.write_documents(docs, cfg.paths.output_dir)
    outcome = F.when(F.col("passed"), "DONE").otherwise("FAILED")
    failed_cuts = sliced.where("slice_error is not null").select("*", F.lit(False).alias("passed"), F.lit(None).cast("double").alias("dnsmos_ovr"), F.col("slice_error").alias("why"))
    every = judged.withColumn("why", F.concat(F.lit("filtered: "), "reason")).select(failed_cuts.columns).unionByName(failed_cuts)
    name = segment_id(F.col("video_id"), F.col("idx"))
    out = F.lit(cfg.paths.output_dir.rstrip("/") + "/")
    store.put("segments", every.select(
        "video_id", "idx", name.alias("segment_id"), F.col("start").alias("start_s"), F.col("end").alias("end_s"),
        "text", F.to_json("words").alias("words_json"), "speaker", F.col("exceeds_max_duration").cast("int").alias("exceeds_max_duration"),
        "dnsmos_ovr", F.when(F.col("passed"), F.col("audio_path")).alias("output_audio_path"),
        F.when(F.col("passed"), F.concat(out, name, F.lit(".json"))).alias("output_json_path"), outcome.alias("status"),
        F.when(~F.col("passed"), F.col("why")).alias("error"),
    ), without=segments.select("video_id").distinct())

    # last: only now is a video done, and one with a failed chunk waits for the next run
    failed = got.where("error is not null").select("video_id", "error").unionByName(std.where("error is not null").select("video_id", "error"))
    broken = heard.where("error is not null").select("video_id").distinct().withColumn("__broken", F.lit(True))
    ended = media_.join(broken, "video_id", "left").select(
        "video_id", "raw_path", "standardized_path", "duration_s", F.when(F.col("__broken"), "PENDING").otherwise("DONE").alias("status"), F.lit(None).cast("string").alias("error")
    )
    store.update("videos", ended)
    store.update("videos", failed.select("video_id", "error", F.lit("FAILED").alias("status")))
    return {r["status"]: r["n"] for r in store.read("segments").groupBy("status").agg(F.count("*").alias("n")).collect()}


def slice_all(segments: DataFrame, cfg: Config, runner: Runner) -> DataFrame:
    """Cuts each segment from its source; adds audio_path, slice_error. A clip that is there is not cut again."""
    from pathlib import Path

    from pyspark.sql import types as T

    p = cfg.package
    name = F.concat(F.lit(f"{cfg.paths.output_dir.rstrip('/')}/"), F.format_string("%s_%05d", "video_id", "idx"), F.lit(f".{p.audio_format}"))
    args = package.slice_arguments(F.col("raw_path"), F.concat("audio_path", F.lit(".tmp")), F.col("start"), F.col("end"), fmt=p.audio_format, rate=p.sample_rate, channels=p.channels)
    ready = segments.withColumn("audio_path", name).withColumn("slice_args", args)
    schema = T.StructType([*ready.drop("slice_args").schema.fields, T.StructField("slice_error", T.StringType())])

    def work(batches):
        for batch in batches:
            import pyarrow as pa

            errors = []
            for path, command in zip(batch.column("audio_path").to_pylist(), batch.column("slice_args").to_pylist(), strict=True):
                error = None
                if not Path(path).exists():
                    Path(path).parent.mkdir(parents=True, exist_ok=True)
                    try:
                        got = runner(command, None)
                        error = (got.err.strip() or f"code {got.code}") if got.code else None
                    except Exception as e:  # noqa: BLE001  a row's failure is data
                        error = str(e)
                    if error:
                        Path(f"{path}.tmp").unlink(missing_ok=True)
                    elif Path(f"{path}.tmp").exists():
                        Path(f"{path}.tmp").replace(path)
                errors.append(error)
            kept = batch.drop_columns(["slice_args"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(errors, pa.string())], names=[*kept.schema.names, "slice_error"])

    return ready.mapInArrow(work, schema)
