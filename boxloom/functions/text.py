"""Scalar functions on paths, ids, frame numbers and review notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_path(c: Column) -> Column:
    """Forward slashes, no outer space, no leading ``./``, lower case."""
    return F.lower(F.regexp_replace(F.trim(F.translate(c, "\\", "/")), r"^(\./)+", ""))


def normal_url(c: Column) -> Column:
    """Without scheme and ``www.``, in lower case."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, "^[a-zA-Z]+://", "")), r"^www\.", "")


def slug(c: Column) -> Column:
    """Lower-case letters and digits joined by single underscores."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def safe_sequence(path: Column) -> Column:
    """The first part of a path that starts with ``MVI_``, else the parent, else the stem."""
    parts = F.filter(F.split(F.translate(path, "\\", "/"), "/"), lambda p: p != "")
    marked = F.filter(parts, lambda p: p.startswith("MVI_"))
    parent = F.when(F.size(parts) > 1, F.element_at(parts, -2))
    return F.coalesce(F.get(marked, F.lit(0)), parent, F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", ""))


def frame_number(name: Column) -> Column:
    """The number of ``img00012`` or ``clip_f12``; null without one."""
    digits = F.coalesce(F.nullif(F.regexp_extract(name, r"img(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(name, r"_f(\d+)", 1), F.lit("")))
    return digits.try_cast("bigint")


def unsafe_path(c: Column) -> Column:
    """Absolute, with a drive or scheme, or going up."""
    return c.startswith("/") | c.contains("..") | c.contains(":")


def parse_bool(c: Column) -> Column:
    """``1``, ``true``, ``yes`` and ``y`` in any case are true, other texts false, null null."""
    return F.lower(F.trim(c)).isin("1", "true", "yes", "y")


def finite_double(c: Column) -> Column:
    """The number of a text; null for what is no finite number."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def note_camera_view(note: Column) -> Column:
    """Camera view from words of a review note."""
    n = F.lower(note)
    return F.when(n.contains("aerial") | n.contains("overhead"), "OVERHEAD_TOP_DOWN").when(n.contains("dashcam"), "FRONT_DASHCAM").otherwise("ROADSIDE_LEVEL")


def note_weather(note: Column) -> Column:
    """Weather from words of a review note."""
    return F.when(F.lower(note).contains("wet-road"), "RAIN_OR_WET_ROAD").otherwise("UNKNOWN")
