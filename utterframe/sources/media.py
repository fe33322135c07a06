"""Media listings and files. External tools are callables that run in workers, so that any of them can be replaced.

A failing row becomes an error row and never fails its neighbours.
"""

from __future__ import annotations

import subprocess
import time
import wave
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The form of an id, where it stands in a link, and the extensions of audio files.
VIDEO_ID = r"[A-Za-z0-9_-]{11}"
IN_LINK = rf"(?:v=|youtu\.be/|/shorts/)({VIDEO_ID})"
WATCH_URL = "https://www.youtube.com/watch?v="
AUDIO_EXTENSIONS = (".mp3", ".wav", ".m4a", ".flac", ".ogg", ".opus", ".aac", ".mp4", ".webm")

Listing = Callable[[str], list[str]]


@dataclass(frozen=True)
class Ran:
    code: int
    out: str = ""
    err: str = ""


#: Arguments and a timeout in seconds (None: none) -> what came of it.
Runner = Callable[[list[str], float | None], Ran]
#: How long listings and probes may take, in seconds.
LISTING_TIMEOUT, PROBE_TIMEOUT = 300.0, 30.0


def run_command(args: list[str], timeout: float | None = None) -> Ran:
    done = subprocess.run(args, capture_output=True, stdin=subprocess.DEVNULL, timeout=timeout, text=True)
    return Ran(done.returncode, done.stdout, done.stderr)


def playlist(runner: Runner = run_command) -> Listing:
    """Lists a channel's video ids by the usual tool."""

    def listing(channel: str) -> list[str]:
        got = runner(["yt-dlp", "--flat-playlist", "--print", "id", channel], LISTING_TIMEOUT)
        if got.code:
            raise RuntimeError(f"listing {channel} failed ({got.code}): {got.err.strip()}")
        return got.out.splitlines()

    return listing


def video_id(url: Column, bare: str = rf"^{VIDEO_ID}$", link: str = IN_LINK) -> Column:
    """The id that a link or a bare id names, else null."""
    return F.when(url.rlike(bare), url).otherwise(F.nullif(F.regexp_extract(url, link, 1), F.lit("")))


def ad_hoc(urls: DataFrame) -> DataFrame:
    """video_id, channel (null), url as given, of single links; those without an id carry an error."""
    found = video_id(F.col("url"))
    error = F.when(found.isNull(), F.concat(F.lit("no video id in: "), F.col("url")))
    return urls.select(found.alias("video_id"), F.lit(None).cast("string").alias("channel"), "url", error.alias("error"))


def discover(channels: DataFrame, listing: Listing, *, max_concurrency: int = 3, delay_s: float = 0.0) -> DataFrame:
    """video_id, channel, url, error: what each channel lists; a channel that fails is one error row.

    At most ``max_concurrency`` channels are listed at a time, each task waiting ``delay_s`` after each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for channel in pdf["channel"]:
                try:
                    rows += [(v, channel, WATCH_URL + v, None) for v in (x.strip() for x in listing(channel)) if v]
                except Exception as e:  # noqa: BLE001  every failure of a channel is data
                    rows.append((None, channel, None, str(e)))
                time.sleep(delay_s)
            yield pd.DataFrame(rows, columns=["video_id", "channel", "url", "error"], dtype=object)

    dealt = channels.select("channel").repartition(max_concurrency)
    return dealt.mapInPandas(run, "video_id string, channel string, url string, error string")


def discover_sources(urls: DataFrame, channels: DataFrame, listing: Listing, *, max_concurrency: int = 3, delay_s: float = 0.0) -> DataFrame:
    """Single links first, then channels, by source_rank; duplicates stay, the job store drops them."""
    one = ad_hoc(urls).withColumn("source_rank", F.lit(0))
    return one.unionByName(discover(channels, listing, max_concurrency=max_concurrency, delay_s=delay_s).withColumn("source_rank", F.lit(1)))


def parse_duration(text: Column) -> Column:
    """Seconds that a probe printed, else null."""
    return F.trim(text).try_cast("double")


def download_arguments(url: str, video_id: str, folder: str, audio_format: str, rate_limit: str | None = None) -> list[str]:
    """The best audio, converted, its path printed."""
    limit = ["--limit-rate", rate_limit] if rate_limit else []
    return [
        "yt-dlp", "-f", "bestaudio/best", "-x", "--audio-format", audio_format, "--no-keep-video", "--no-playlist",
        "-o", f"{folder}/{video_id}.%(ext)s", "--print", "after_move:filepath", *limit, url,
    ]


def download(
    videos: DataFrame, folder: str, runner: Runner, *, audio_format: str = "m4a", rate_limit: str | None = None,
    timeout_s: float | None = 900, max_concurrency: int = 5,
) -> DataFrame:
    """video_id, channel, raw_path, duration_s, error: fetches each video, at most ``max_concurrency`` at a time, and
    probes it; the last printed line is the file. ``folder`` must be a path that all machines share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        for pdf in batches:
            rows = []
            for v, channel, url in zip(pdf["video_id"], pdf["channel"], pdf["url"], strict=True):
                try:
                    got = runner(download_arguments(url, v, folder, audio_format, rate_limit), timeout_s)
                    lines = [line.strip() for line in got.out.splitlines() if line.strip()]
                    if got.code or not lines:
                        raise RuntimeError(got.err.strip() or f"no file (code {got.code})")
                    rows.append((v, channel, lines[-1], probe_duration(lines[-1], runner), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((v, channel, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["video_id", "channel", "raw_path", "duration_s", "error"]).astype({"duration_s": "float64"})

    wanted = videos.where("error is null").select("video_id", "channel", "url").repartition(max_concurrency)
    return wanted.mapInPandas(run, "video_id string, channel string, raw_path string, duration_s double, error string")


def probe_duration(path: str, runner: Runner) -> float | None:
    """Seconds of a file, or None; never raises."""
    try:
        if path.lower().endswith(".wav") and Path(path).exists():
            with wave.open(path) as w:
                return w.getnframes() / w.getframerate()
        got = runner(["ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "default=nw=1:nk=1", path], PROBE_TIMEOUT)
        return float(got.out.strip()) if got.code == 0 else None
    except Exception:  # noqa: BLE001
        return None


def with_duration(df: DataFrame, path_col: str, runner: Runner, alias: str = "probed_s") -> DataFrame:
    """Adds the probed seconds of each file, null where the probe fails."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{alias: pd.Series([probe_duration(p, runner) for p in pdf[path_col]], index=pdf.index, dtype="float64")})

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField(alias, T.DoubleType())]))


def standardize_arguments(raw: str, out: str, rate: int = 16000) -> list[str]:
    return ["ffmpeg", "-y", "-i", raw, "-ac", "1", "-ar", str(rate), "-c:a", "pcm_s16le", out]


def standardize(media: DataFrame, folder: str, runner: Runner, rate: int = 16000) -> DataFrame:
    """video_id, standardized_path, error: mono PCM copies for the models."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for v, raw in zip(pdf["video_id"], pdf["raw_path"], strict=True):
                out = f"{folder}/{v}.wav"
                try:
                    got = runner(standardize_arguments(raw, out, rate), None)
                    if got.code:
                        raise RuntimeError(got.err.strip() or f"code {got.code}")
                    rows.append((v, out, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((v, None, str(e)))
            yield pd.DataFrame(rows, columns=["video_id", "standardized_path", "error"], dtype=object)

    return media.select("video_id", "raw_path").mapInPandas(run, "video_id string, standardized_path string, error string")


def audio_files(listing: DataFrame, path_col: str = "path", extensions: tuple[str, ...] = AUDIO_EXTENSIONS) -> DataFrame:
    """The rows whose file name ends like an audio file's, in any case, by path."""
    name = F.lower(F.element_at(F.split(path_col, "/"), -1))
    extension = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    return listing.where(extension.isin(*extensions)).orderBy(path_col)


def local_files(spark: SparkSession, folder: str) -> DataFrame:
    """video_id (the file's stem), channel, url (its path) of the audio files directly in a folder; none if it's missing.

    Listed by the driver: Spark's own file sources skip names that begin with an underscore, which ids may.
    """
    root = Path(folder)
    rows = [(p.stem, None, str(p)) for p in (sorted(root.iterdir()) if root.is_dir() else ()) if p.is_file()]
    listed = spark.createDataFrame(rows, "video_id string, channel string, url string")
    return audio_files(listed, "url")


def local_results(files: DataFrame) -> DataFrame:
    """raw_path of each file that is there, an error for the others."""

    @F.pandas_udf("boolean")
    def there(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: Path(p).exists())

    found = files.withColumn("__there", there("url"))
    return found.select(
        "video_id", "channel", F.when(F.col("__there"), F.col("url")).alias("raw_path"),
        F.when(~F.col("__there"), F.concat(F.lit("file not found: "), F.col("url"))).alias("error"),
    )


def transcribe(files: DataFrame, load: Callable[[], Callable]) -> DataFrame:
    """filename, duration_s, text of each file, by a model made once in a worker: path -> (seconds, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = [(Path(p).name, *model(p)) for p in pdf["url"]]
            yield pd.DataFrame([(n, round(float(d), 3), t.strip()) for n, d, t in rows], columns=["filename", "duration_s", "text"])

    return files.select("url").mapInPandas(run, "filename string, duration_s double, text string")
