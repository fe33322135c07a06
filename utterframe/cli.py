"""Command line: check-config, run, resume, status, reset, manifest, stats, filter-speakers, transcribe, view."""

from __future__ import annotations

import argparse
import importlib
import sys
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from utterframe.config import Config, load_config
from utterframe.operators import browse, package
from utterframe.operators.jobstore import STATUSES, JobStore
from utterframe.operators.order import numbered
from utterframe.session import ensure_importable
from utterframe.sources import files, media


def session() -> SparkSession:
    return ensure_importable(SparkSession.builder.appName("utterframe").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def load_models(path: str):
    """``module:attribute`` of a ``pipeline.Models``."""
    module, _, attribute = path.partition(":")
    return getattr(importlib.import_module(module), attribute)


def write_listings(spark: SparkSession, cfg: Config) -> int:
    docs = files.read_documents(spark, cfg.paths.output_dir)
    n = files.write_manifest(docs, f"{cfg.paths.output_dir}/manifest.jsonl")
    files.write_csv(package.listing(docs, cfg.package.audio_format).orderBy("no"), f"{cfg.paths.output_dir}/metadata.csv")
    return n


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    top = argparse.ArgumentParser(prog="utterframe", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *extra: tuple[tuple, dict]) -> None:
        sub = commands.add_parser(name)
        sub.add_argument("--config", "-c", required=True)
        for args, options in extra:
            sub.add_argument(*args, **options)

    models = (("--models",), {"required": True, "help": "module:attribute of the models to run"})
    command("check-config")
    command("run", models)
    command("resume", models)
    command("status")
    command("reset", (("--video-id",), {}), (("--yes", "-y"), {"action": "store_true"}))
    command("manifest")
    command("stats")
    command("filter-speakers", (("--keep",), {"action": "append", "required": True}), (("--dry-run",), {"action": "store_true"}))
    command("transcribe", (("--input-dir",), {"required": True}), (("--output",), {"required": True}), (("--model",), {"required": True}))
    command("view", (("--video",), {}), (("--speaker",), {}))
    given = top.parse_args(argv)
    cfg = load_config(given.config)
    if given.command == "check-config":
        print(f"OK: {given.config}\n{asdict(cfg)}")
        return 0
    spark = spark or session()
    out = cfg.paths.output_dir
    if given.command in ("run", "resume"):
        from utterframe.pipeline import run

        if given.command == "resume":
            print(f"{JobStore(spark, cfg.paths.db_path).recover_stale_running(0)} running rows are pending again")
        print(run(spark, cfg, load_models(given.models)))
        print(f"{write_listings(spark, cfg)} segments in the manifest")
    elif given.command == "status":
        found = {r["table_name"]: r for r in JobStore(spark, cfg.paths.db_path).counts().collect()}
        for table in ("videos", "superchunks", "segments"):
            print(table, *(f"{s}={found[table][s] if table in found else 0}" for s in STATUSES))
    elif given.command == "reset":
        what = f"video {given.video_id}" if given.video_id else "ALL videos"
        if not given.yes and input(f"Remove the job state of {what} in {cfg.paths.db_path}? [y/N] ").strip().lower() not in ("y", "yes"):
            print("kept")
            return 1
        print(JobStore(spark, cfg.paths.db_path).reset(given.video_id))
    elif given.command == "manifest":
        print(f"{write_listings(spark, cfg)} segments in the manifest")
    elif given.command == "stats":
        docs = files.read_documents(spark, out)
        totals = package.dataset_totals(docs).first()
        print(f"{totals['num_segments']} segments, {totals['num_videos']} videos, {totals['num_speakers']} speakers, {totals['total_duration'] / 3600:.2f} hours")
        for r in package.speaker_hours(docs, "path").collect():
            print(f"{r['speaker']}: {r['segments']} segments, {r['hours']:.2f} hours")
    elif given.command == "filter-speakers":
        kept, removed = package.kept_speakers(files.read_documents(spark, out), given.keep)
        n_kept, n_removed = kept.count(), removed.count()
        if not given.dry_run:
            files.remove_segments(out, removed)
            write_listings(spark, cfg)
        print(f"kept {n_kept}, removed {n_removed}" + " (dry run)" * given.dry_run)
    elif given.command == "transcribe":
        rows = media.transcribe(media.local_files(spark, given.input_dir), load_models(given.model))
        listed = numbered(rows, "filename").select("no", "filename", "duration_s", "text").orderBy("no")
        files.write_csv(listed, given.output)
        print(f"{len(Path(given.output).read_text(encoding='utf-8').splitlines()) - 1} files")
    elif given.command == "view":
        docs = files.read_documents(spark, out)
        for r in browse.choices(docs, given.video, given.speaker).collect():
            print(r["label"])
        print(browse.facets(docs).groupBy("facet").agg(F.count("*").alias("n")).collect())
    return 0


if __name__ == "__main__":
    sys.exit(main())
