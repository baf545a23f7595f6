"""Scalar expressions: text, geometry, kinematics, parsing."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgrain.functions.arrays import clip


def stable_hash(*parts: Column) -> Column:
    """A number from 0 to 2^60 - 1 that depends on the values alone, by the first 15 digits of an MD5; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 15), 16, 10).cast("bigint")


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_prompt(text: Column) -> Column:
    """Stripped, underscores and line breaks as spaces."""
    return F.regexp_replace(strip(text), "[_\n]", " ")


def clean_label(text: Column) -> Column:
    """Lower case, stripped, underscores as spaces."""
    return F.replace(strip(F.lower(text)), F.lit("_"), F.lit(" "))


def prompt(task: Column, state_bins: Column, actions: bool = True) -> Column:
    """The task and the binned state as a prompt."""
    return F.concat(F.lit("Task: "), task, F.lit(", State: "), F.array_join(state_bins.cast("array<string>"), " "), F.lit(";\nAction: " if actions else ";\n"))


def between_marks(text: Column, start: str, end: str) -> Column:
    """What stands between the first ``start`` and the next ``end``; null without ``start``."""
    return F.when(F.contains(text, F.lit(start)), F.split_part(F.split_part(text, F.lit(start), F.lit(2)), F.lit(end), F.lit(1)))


def letterbox(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """Size and padding of an image resized with its proportions kept."""
    ratio = F.greatest(width / F.lit(float(to_width)), height / F.lit(float(to_height)))
    w, h = (width / ratio).cast("int"), (height / ratio).cast("int")
    left, top = F.floor((F.lit(to_width) - w) / 2).cast("int"), F.floor((F.lit(to_height) - h) / 2).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), left.alias("left"), (F.lit(to_width) - w - left).alias("right"), top.alias("top"), (F.lit(to_height) - h - top).alias("bottom"))


def even_size(x: Column, factor: float) -> Column:
    """Scaled and rounded up to an even number."""
    return (F.ceil(x * factor / 2) * 2).cast("bigint")


def axis_angle(x: Column, y: Column, z: Column, w: Column) -> Column:
    """Quaternion to axis-angle; zero where there is no rotation."""
    c = clip(w, -1.0, 1.0)
    den = F.sqrt(1 - c * c)
    scale = F.when(F.abs(den) <= 1e-8, F.lit(0.0)).otherwise(2 * F.acos(c) / den)
    return F.array(x * scale, y * scale, z * scale)


def linear_to_radian(x: Column, arm: float, horn: float) -> Column:
    """Opening of a linear gripper as the angle of its horn."""
    value = (F.lit(horn**2) + x * x - F.lit(arm**2)) / (F.lit(2 * horn) * x)
    return F.asin(clip(value, -1.0, 1.0))


def rescale(x: Column, low: float, high: float) -> Column:
    return (x - low) / (high - low)


def unscale(x: Column, low: float, high: float) -> Column:
    return x * (high - low) + low


def frame_at(seconds: Column, fps: Column, frames: Column) -> Column:
    """The frame nearest to a time, half to even, inside the recording."""
    return F.greatest(F.lit(0), F.least(F.bround(seconds * fps).cast("bigint"), frames - 1))


def json_object(text: Column) -> Column:
    """The outermost object in free text."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def wave_embedding(x: Column, dims: int, shortest: float, longest: float) -> Column:
    """Sines and cosines at periods in geometric progression."""
    half = dims // 2
    periods = [shortest * (longest / shortest) ** (i / max(1, half - 1)) for i in range(half)]
    angle = [x * (2 * math.pi / p) for p in periods]
    return F.array(*(F.sin(a) for a in angle), *(F.cos(a) for a in angle))


def warmup_cosine(step: Column, warmup: int, total: int, peak: float, end: float) -> Column:
    """Linear warm-up, then cosine decay."""
    progress = clip((step - warmup) / F.lit(float(max(1, total - warmup))), 0.0, 1.0)
    return F.when(step < warmup, peak * (step + 1) / F.lit(float(warmup + 1))).otherwise(end + (peak - end) * 0.5 * (1 + F.cos(math.pi * progress)))


def warmup_inverse_root(step: Column, warmup: int, peak: float, timescale: float) -> Column:
    """Linear warm-up, then decay with the inverse root of the steps since."""
    return F.when(step < warmup, peak * (step + 1) / F.lit(float(warmup + 1))).otherwise(peak / F.sqrt((timescale + (step - warmup)) / F.lit(timescale)))


def action_token(token: Column, vocabulary: int, kept: int = 128) -> Column:
    """An action token as one of the last of a vocabulary, before the ``kept`` special ones; the same turns it back."""
    return (F.lit(vocabulary - 1 - kept) - token).cast("bigint")


def byte_to_unit(x: Column) -> Column:
    """A byte's value in [-1, 1]."""
    return x / 255 * 2 - 1


def unit_to_byte(x: Column) -> Column:
    """A value in [-1, 1] as a byte's value."""
    return F.round((x + 1) / 2 * 255).cast("bigint")


def data_url(image: Column, kind: str = "png") -> Column:
    return F.concat(F.lit(f"data:image/{kind};base64,"), F.base64(image))


def episode_number(name: Column) -> Column:
    """The number in ``episode_000012`` and the like, or -1."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(name, r"(\d+)", 1), F.lit("")), F.lit("999999999999")).cast("bigint"), F.lit(-1).cast("bigint"))


def task_of_file(path: Column) -> Column:
    """The task that a recording's file is named after: no folder, extension or closing ``demo``, underscores as spaces."""
    name = F.regexp_replace(F.regexp_replace(path, r"^.*[/\\\\]", ""), r"\.[^.]*$", "")
    return F.trim(F.replace(F.regexp_replace(name, r"_demo$", ""), F.lit("_"), F.lit(" ")))


def episode_path(episode: Column, chunk_size: int = 1000) -> Column:
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(episode / chunk_size).cast("bigint"), episode.cast("bigint"))
