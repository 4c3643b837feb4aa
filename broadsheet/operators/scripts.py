"""Two-host scripts: segments, voices and the episode timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_mod
from ..functions.text import WS, strip
from ..plans.ordered import previous_value, running_totals

# Hosts, pause, cross-fade, speaking pace.
HOSTS = ("Alex", "Sam")
DEFAULT_HOST = "Alex"
PAUSE_MS = 300
CROSSFADE_MS = 1000
MS_PER_WORD = 400

# Voice pools in rotation order, as (display name, voice id).
VOICE_POOLS = {
    "edge_male": [
        ("Guy", "en-US-GuyNeural"),
        ("Christopher", "en-US-ChristopherNeural"),
        ("Eric", "en-US-EricNeural"),
        ("Roger", "en-US-RogerNeural"),
        ("Steffan", "en-US-SteffanNeural"),
    ],
    "edge_female": [
        ("Jenny", "en-US-JennyNeural"),
        ("Aria", "en-US-AriaNeural"),
        ("Michelle", "en-US-MichelleNeural"),
    ],
    "elevenlabs_male": [
        ("Brian", "nPczCjzI2devNBz1zQrb"),
        ("Daniel", "onwK4e9ZLuTAKqWW03F9"),
        ("Drew", "29vD33N1CtxCmqQRPOHJ"),
        ("Charlie", "IKne3meq5aSn9XLyUdCD"),
        ("Chris", "iP95p4xoKVk53GoZ742B"),
        ("Bill", "pqHfZKP75CvOlQylNhV4"),
        ("Josh", "TxGEqnHWrfWFTfGW9XjX"),
        ("Liam", "TX3LPaxmHKxFdv7VOQHJ"),
    ],
    "elevenlabs_female": [
        ("Alice", "Xb7hH8MSUJpSbSDYk0k2"),
        ("Sarah", "EXAVITQu4vr4xnSDxMaL"),
        ("Matilda", "XrExE9yKIg1WjnnlVkGX"),
        ("Rachel", "21m00Tcm4TlvDq8ikWAM"),
        ("Lily", "pFZP5JQG7iQjIQuC4Bku"),
    ],
}

_LABEL = rf"(?iud)^({'|'.join(HOSTS)})[{WS}]*:[{WS}]*(.+)"


def is_label(line: Column) -> Column:
    """A stripped line that names a host and says something. A bare label is not one."""
    return line.rlike(_LABEL)


def speaker(line: Column) -> Column:
    first = F.lower(F.left(line, F.lit(1)))
    return F.when(first == "a", HOSTS[0]).otherwise(HOSTS[1])


def said(line: Column) -> Column:
    """The dialogue of a label line; any other line is all dialogue."""
    return F.when(is_label(line), strip(F.regexp_extract(line, _LABEL, 2))).otherwise(line)


def script_segments(script: Column) -> Column:
    """``array<struct<speaker, dialogue>>`` of one script text.

    Lines are stripped and blank ones dropped. As no line holds a newline, the
    newline is free to mark where a segment starts.
    """
    lines = F.filter(F.transform(F.split(script, "\n", -1), strip), lambda s: s != "")
    tagged = F.transform(
        lines,
        lambda s: F.when(is_label(s), F.concat(F.lit("\n"), speaker(s), F.lit(":"), said(s)))
        .otherwise(F.concat(F.lit(" "), s)),
    )
    chunks = F.split(F.array_join(tagged, ""), "\n", -1)
    spoken = F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))
    return F.transform(
        spoken,
        lambda c: F.struct(
            F.substring_index(c, ":", 1).alias("speaker"),
            F.substr(c, F.instr(c, ":") + 1).alias("dialogue"),
        ),
    )


def parse_scripts(scripts: DataFrame, key: str, text: str = "script") -> tuple[DataFrame, DataFrame]:
    """Segments of every script, and the keys of scripts without any."""
    parsed = scripts.select(key, script_segments(F.col(text)).alias("_s"))
    rows = parsed.select(key, F.posexplode("_s").alias("seg_idx", "_s"))
    segments = rows.select(key, "seg_idx", F.col("_s.speaker").alias("speaker"), F.col("_s.dialogue").alias("dialogue"))
    return segments, parsed.filter(F.size("_s") == 0).select(key)


def transcript_segments(
    turns: DataFrame, key: str, order: str, text: str, chunk: int | None = None
) -> DataFrame:
    """Segments of a transcript stored as rows: a script too long for one value.

    Every row holds one or more lines. Segments are numbered by a running count
    of labels that never needs a whole transcript in one task.
    """
    lines = turns.select(key, order, F.posexplode(F.split(text, "\n", -1)).alias("_no", "_line"))
    lines = lines.withColumn("_line", strip(F.col("_line"))).filter(F.col("_line") != "")
    options = {"chunk": chunk} if chunk else {}
    numbered = running_totals(
        lines.withColumn("_label", is_label(F.col("_line"))), [key], order,
        {"_seg": F.col("_label").cast("bigint")}, ties=["_no"], **options,
    )
    spoken = numbered.filter(F.col("_seg") > 0)
    parts = F.array_sort(F.collect_list(F.struct(order, "_no", said(F.col("_line")).alias("_t"))))
    return spoken.groupBy(key, F.col("_seg").alias("seg_no")).agg(
        F.max(F.when(F.col("_label"), speaker(F.col("_line")))).alias("speaker"),
        F.array_join(F.transform(parts, lambda p: p["_t"]), " ").alias("dialogue"),
        F.count("*").alias("n_lines"),
    )


def spoken_ms(dialogue: Column) -> Column:
    """Estimated length of a dialogue at the speaking pace."""
    words = F.filter(F.split(dialogue, rf"[{WS}]+", -1), lambda w: w != "")
    return (F.size(words) * MS_PER_WORD).cast("bigint")


def timeline(
    segments: DataFrame, episode: str = "episode", intro_ms: int = 0, chunk: int | None = None
) -> DataFrame:
    """Start and end of every segment, with the pause put before a change of speaker.

    ``segments`` has the episode column, ``idx``, ``speaker`` and ``dur_ms``. An
    intro shifts everything by its length less the cross-fade.
    """
    options = {"chunk": chunk} if chunk else {}
    known = previous_value(segments, [episode], "idx", "speaker", "_before", **options)
    pause = F.when(F.col("_before").isNotNull() & (F.col("_before") != F.col("speaker")), PAUSE_MS).otherwise(0)
    paused = known.withColumn("pause_ms", pause.cast("bigint"))
    summed = running_totals(
        paused, [episode], "idx", {"end_ms": F.col("dur_ms") + F.col("pause_ms")}, **options
    )
    shift = intro_ms - CROSSFADE_MS if intro_ms > 0 else 0
    end = F.col("end_ms") + shift
    return summed.select(
        episode, "idx", "speaker", "dur_ms", "pause_ms",
        (end - F.col("dur_ms")).alias("start_ms"), end.alias("end_ms"),
    )


def episode_length(timed: DataFrame, episode: str = "episode", intro_ms: int = 0, outro_ms: int = 0) -> DataFrame:
    """Total length per episode: speech, pauses and music less one cross-fade per piece of music."""
    pieces = (intro_ms > 0) + (outro_ms > 0)
    music = intro_ms + outro_ms - CROSSFADE_MS * pieces
    return timed.groupBy(episode).agg(
        (F.sum(F.col("dur_ms") + F.col("pause_ms")) + music).cast("bigint").alias("total_ms"),
        F.count("*").alias("n_segments"),
    )


def voice_index(day: Column, role: Column, size: int) -> Column:
    """Position in a pool of ``size`` voices for a day (text) and a role."""
    return md5_mod(F.concat(day, F.lit("-"), role), size)


def daily_voice(pool: list[tuple[str, str]], day: Column, role: Column) -> Column:
    """``struct<name, voice_id>`` of the voice a role has on a day."""
    voices = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("voice_id")) for n, v in pool])
    return F.get(voices, voice_index(day, role, len(pool)).cast("int"))


def host_voices(day: Column, male: str, female: str, pin_alex: Column | None = None, pin_sam: Column | None = None) -> Column:
    """``struct<alex, sam>`` voice ids. Pins count only when both are set."""
    rotated = F.struct(
        daily_voice(VOICE_POOLS[male], day, F.lit("Alex"))["voice_id"].alias("alex"),
        daily_voice(VOICE_POOLS[female], day, F.lit("Sam"))["voice_id"].alias("sam"),
    )
    if pin_alex is None or pin_sam is None:
        return rotated
    pinned = (F.coalesce(pin_alex, F.lit("")) != "") & (F.coalesce(pin_sam, F.lit("")) != "")
    return F.when(pinned, F.struct(pin_alex.alias("alex"), pin_sam.alias("sam"))).otherwise(rotated)


def voice_of(speaker_name: Column, voices: Column) -> Column:
    """Voice id of a speaker; an unknown speaker gets the first host's voice."""
    return F.when(speaker_name == "Sam", voices["sam"]).otherwise(voices["alex"])
