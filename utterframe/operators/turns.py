"""Speaker turns: cross-talk regions, speaker assignment, majority votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterframe.functions.times import intersects


def overlap_regions(turns: DataFrame) -> DataFrame:
    """video_id, start, end: maximal spans in which two speakers or more are active.

    Each speaker's turns become islands first, so that nobody counts twice; then a sweep over +1 and -1 marks.
    """
    solo = Window.partitionBy("video_id", "speaker").orderBy("start", "end", "tidx")
    before = F.max("end").over(solo.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    islands = (
        turns.where("end > start").withColumn("__new", fresh)
        .withColumn("__g", F.sum("__new").over(solo.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("video_id", "speaker", "__g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    marks = islands.select("video_id", F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("k")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("k"))
    )).alias("m")).groupBy("video_id", "m.at").agg(F.sum("m.k").alias("k"))
    along = Window.partitionBy("video_id").orderBy("at")
    active = marks.withColumns({
        "n": F.sum("k").over(along.rowsBetween(Window.unboundedPreceding, 0)), "until": F.lead("at").over(along)
    }).where("n >= 2")
    joined = active.withColumn("__new", F.when(F.lag("until").over(along).eqNullSafe(F.col("at")), 0).otherwise(1))
    named = joined.withColumn("__g", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy("video_id", "__g").agg(F.min("at").alias("start"), F.max("until").alias("end")).drop("__g")


def _with_spans(words: DataFrame, spans: DataFrame, columns: list[str], alias: str) -> DataFrame:
    """Words with an array of all spans of their video, null for none, by start.

    Spans are far fewer than words: a task holds those of its videos, and words pass by unsorted. Words that lie by video
    already aren't shuffled.
    """
    listed = spans.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(alias))
    return words.join(listed.hint("shuffle_hash"), "video_id", "left")


def assign_speakers(words: DataFrame, turns: DataFrame, *, fill_nearest: bool = False, key: str = "widx") -> DataFrame:
    """Each word with the speaker of the turn it overlaps most (ties: the earlier turn); else, if asked for, of the
    turn whose middle is nearest; else null.

    Turns come to the words, not words to the turns; only unassigned words of videos with turns look for the nearest.
    """
    def best(t: Column) -> Column:
        met = F.filter(t, lambda x: intersects(F.col("start"), F.col("end"), x["start"], x["end"]))
        shared = lambda x: F.least(F.col("end"), x["end"]) - F.greatest(F.col("start"), x["start"])
        ranked = F.transform(met, lambda x: F.struct(shared(x).alias("o"), (-x["tidx"]).alias("t"), x["speaker"].alias("who")))
        return F.array_max(F.filter(ranked, lambda x: x["o"] > 0))

    listed = _with_spans(words.drop("speaker"), turns, ["start", "end", "tidx", "speaker"], "__turns")
    found = listed.select(*words.drop("speaker").columns, F.when(F.col("__turns").isNotNull(), best(F.col("__turns"))).alias("__best"), F.col("__turns").isNotNull().alias("__any"))
    named = found.withColumn("speaker", F.col("__best.who")).drop("__best")
    if not fill_nearest:
        return named.drop("__any")
    lost = F.col("__any") & F.col("speaker").isNull()
    near = nearest_turns(named.where(lost).drop("__any", "speaker"), turns)
    return named.where(~lost).drop("__any").unionByName(near)


def nearest_turns(words: DataFrame, turns: DataFrame) -> DataFrame:
    """The words with the speaker of the turn whose middle is nearest to theirs, ties to the earlier turn.

    Words and turns of a video stand in one order by their middles; the nearest turn is the last before or the first
    after.
    """
    middle = F.col("start") + F.col("end")
    middles = turns.groupBy("video_id", middle.alias("m")).agg(
        F.struct(F.min("tidx").alias("t"), F.min_by("speaker", "tidx").alias("who"), F.first(middle).alias("m")).alias("turn")
    )
    word = F.struct(*words.columns)
    listed = words.select("video_id", middle.alias("m"), F.lit(None).cast(middles.schema["turn"].dataType).alias("turn"), word.alias("word"), F.lit(1).alias("kind"))
    marked = middles.select("video_id", "m", "turn", F.lit(None).cast(listed.schema["word"].dataType).alias("word"), F.lit(0).alias("kind"))
    along = Window.partitionBy("video_id").orderBy("m", "kind")
    back = Window.partitionBy("video_id").orderBy(F.desc("m"), "kind")
    upto = [Window.unboundedPreceding, Window.currentRow]
    both = marked.unionByName(listed).withColumns({
        "before": F.last("turn", True).over(along.rowsBetween(*upto)), "after": F.last("turn", True).over(back.rowsBetween(*upto)),
    }).where("kind = 1")
    rank = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.m") - F.col("m")).alias("d"), F.col(f"{c}.t").alias("t"), F.col(f"{c}.who").alias("who")))
    return both.select("word.*", F.least(rank("before"), rank("after"))["who"].alias("speaker"))


def flag_overlap(words: DataFrame, regions: DataFrame, key: str = "widx") -> DataFrame:
    """Each word with overlap: whether it shares time with a cross-talk region."""
    listed = _with_spans(words.drop("overlap"), regions, ["start", "end"], "__regions")
    hit = F.exists("__regions", lambda x: intersects(F.col("start"), F.col("end"), x["start"], x["end"]))
    return listed.withColumn("overlap", F.coalesce(hit, F.lit(False))).drop("__regions")


def first_seen_mode(df: DataFrame, by: list[str], value: str, order: Column | str, alias: str) -> DataFrame:
    """The commonest non-empty value of each group, ties to the one seen first; null where there is none."""
    at = F.col(order) if isinstance(order, str) else order
    given = df.withColumn("__v", F.nullif(F.col(value), F.lit(""))).withColumn("__at", at)
    counted = given.groupBy(*by, "__v").agg(F.count("__v").alias("__n"), F.min("__at").alias("__first"))
    rank = F.when(F.col("__v").isNotNull(), F.struct("__n", (-F.col("__first")).alias("f")))
    return counted.groupBy(*by).agg(F.max_by("__v", rank).alias(alias))


def shift_to_video(words: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk-local word times as video times, without speaker or overlap yet.

    A task holds its chunks' begins, so that words pass unsorted.
    """
    begins = chunks.select("video_id", F.col("idx").alias("chunk_idx"), F.col("start").alias("__at"))
    moved = words.join(begins.hint("shuffle_hash"), ["video_id", "chunk_idx"])
    return moved.withColumns({
        "start": F.col("start") + F.col("__at"), "end": F.col("end") + F.col("__at"),
        "speaker": F.lit(None).cast("string"), "overlap": F.lit(False),
    }).drop("__at")


def words_payload(stored: Column) -> Column:
    """Struct (words, language) of a stored payload: an object, or a bare list of words as older runs wrote it."""
    word = "text: string, start: double, end: double, speaker: string, overlap: boolean"
    as_object = F.from_json(stored, f"words array<struct<{word}>>, language string")
    as_list = F.from_json(stored, f"array<struct<{word}>>")
    is_list = F.startswith(F.ltrim(stored), F.lit("["))
    return F.when(is_list, F.struct(as_list.alias("words"), F.lit(None).cast("string").alias("language"))).otherwise(as_object)
