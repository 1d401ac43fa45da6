"""Keys, names and text built from columns (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def traj_key(user_id, label_idx, plt_idx) -> Column:
    """``UUU_LLLL_PPPP``; pads with zeros and never truncates (unlike lpad)."""
    return F.format_string("%03d_%04d_%04d", _c(user_id).cast("int"),
                           _c(label_idx).cast("int"), _c(plt_idx).cast("int"))


def zfill3(user_id) -> Column:
    """User folder name: the id padded to three digits."""
    return F.format_string("%03d", _c(user_id).cast("int"))


def image_name(key, mode=None) -> Column:
    """``trajectory_<key>_<mode>.png``; ``unknown`` when there is no mode column."""
    m = F.lit("unknown") if mode is None else _c(mode)
    return F.concat(F.lit("trajectory_"), _c(key), F.lit("_"), m, F.lit(".png"))


def image_stem(key, mode=None) -> Column:
    """The image name without the ``.png`` suffix (the vector key of images)."""
    m = F.lit("unknown") if mode is None else _c(mode)
    return F.concat(F.lit("trajectory_"), _c(key), F.lit("_"), m)


def key_from_name(stem) -> Column:
    """Parts 2-4 of the stem split on ``_`` (``trajectory_160_0001_0002_bus`` -> ``160_0001_0002``)."""
    parts = F.split(_c(stem), "_")
    return F.concat_ws("_", F.get(parts, 1), F.get(parts, 2), F.get(parts, 3))


# Fixed value: the key pattern of image and multimodal vector tables.
KEY_PATTERN = r"trajectory_(.*)_[a-z]+$"


def key_from_regex(stem) -> Column:
    """Group 1 of ``trajectory_(.*)_[a-z]+$``; no match gives null."""
    return F.when(_c(stem).rlike(KEY_PATTERN),
                  F.regexp_extract(_c(stem), KEY_PATTERN, 1))


def base64_url(content) -> Column:
    """``data:image/png;base64,<base64>`` without line breaks."""
    return F.concat(F.lit("data:image/png;base64,"),
                    F.translate(F.base64(_c(content)), "\r\n", ""))


def point_line(lat, lon, ts) -> Column:
    """``(lat.6f, lon.6f, yyyy-MM-dd HH:mm:ss)``."""
    return F.format_string("(%.6f, %.6f, %s)", _c(lat), _c(lon),
                           F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss"))


def point_text(points) -> Column:
    """Newline-joined point lines of an ordered ``array<struct<lat,lon,ts>>``."""
    return F.array_join(F.transform(_c(points), lambda p: point_line(p["lat"], p["lon"], p["ts"])), "\n")


# Fixed value: the placeholder the prompt template carries.
PROMPT_TOKEN = "{trajectory_data}"


def fill_prompt(template: str, text) -> Column:
    """Put the point text into the template at its placeholder."""
    return F.replace(F.lit(template), F.lit(PROMPT_TOKEN), _c(text))
