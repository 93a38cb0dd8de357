"""Column expressions: tags, hashes, boxes, names. No UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The managed tags, in the order in which they are written.
DUP_TAGS = ("dup_repeat", "dup_repeat_keep", "dup_repeat_drop", "dup_near", "dup_near_keep", "dup_near_drop")


def texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tags_or_empty(tags: Column) -> Column:
    return F.coalesce(tags, F.array().cast("array<string>"))


def has_any(tags: Column, wanted: Sequence[str]) -> Column:
    return F.coalesce(F.arrays_overlap(F.filter(tags_or_empty(tags), lambda t: t.isNotNull()), texts(wanted)), F.lit(False))


def has_all(tags: Column, wanted: Sequence[str]) -> Column:
    return F.size(F.array_except(texts(wanted), tags_or_empty(tags))) == 0


def has_none(tags: Column, unwanted: Sequence[str]) -> Column:
    return ~has_any(tags, unwanted)


def without(tags: Column, managed: Sequence[str]) -> Column:
    """Unmanaged tags, in order, repeated ones kept."""
    return F.filter(tags_or_empty(tags), lambda t: ~t.isin(*managed))


def with_managed(tags: Column, managed: Sequence[str], wanted: Column) -> Column:
    """Unmanaged tags, then the managed ones that are wanted, in their fixed order; unchanged if they are so already."""
    new = F.concat(without(tags, managed), F.filter(texts(managed), lambda t: F.array_contains(wanted, t)))
    now = F.filter(tags_or_empty(tags), lambda t: t.isin(*managed))
    return F.when(now == F.filter(texts(managed), lambda t: F.array_contains(wanted, t)), tags_or_empty(tags)).otherwise(new)


def appended(tags: Column, new: Sequence[str]) -> Column:
    """tags and those of new that are missing, in order."""
    return F.concat(tags_or_empty(tags), F.array_except(texts(new), tags_or_empty(tags)))


def family_codes(tags: Column, family: str) -> Column:
    """The numbers of tags family_<digits>."""
    return F.transform(F.filter(tags_or_empty(tags), lambda t: t.rlike(f"^{family}_[0-9]+$")), lambda t: F.substring_index(t, "_", -1).cast("int"))


def family_set(tags: Column, family: str, value: Column) -> Column:
    """Tags whose family is the one tag family_<value>, at the end; unchanged where it is so already."""
    tag = F.concat(F.lit(f"{family}_"), value.cast("string"))
    mine = F.filter(tags_or_empty(tags), lambda t: t.rlike(f"^{family}_[0-9]+$"))
    rest = F.filter(tags_or_empty(tags), lambda t: ~t.rlike(f"^{family}_[0-9]+$"))
    return F.when(mine == F.array(tag), tags_or_empty(tags)).otherwise(F.concat(rest, F.array(tag)))


def normal_hash(h: Column) -> Column:
    return F.lower(F.trim(F.coalesce(h, F.lit(""))))


def hash_bits(h: Column) -> Column:
    """The 64 bits of up to 16 hex digits; null where they are none."""
    return F.when(h.rlike("^[0-9a-f]{1,16}$"), F.conv(h, 16, -10).cast("bigint"))


def stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"[^/\\]*$", 0)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def name_key(path: Column, by: str = "stem") -> Column:
    """What names are matched by: the stem, or (by="name") the stem and the suffix in lower case."""
    if by not in ("stem", "name"):
        raise ValueError(f"by: stem or name, not {by}")
    return stem(path) if by == "stem" else F.concat(stem(path), suffix(path))


def suffix(path: Column) -> Column:
    """The last .ext of a name, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.regexp_extract(path, r"[^/\\]*$", 0), r"(?<=.)(\.[^.]*)$", 1))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def box_valid(b: Column) -> Column:
    """b: array of x, y, w, h relative to the image."""
    return F.coalesce((F.size(b) == 4) & F.forall(b, finite) & (F.get(b, 2) > 0) & (F.get(b, 3) > 0), F.lit(False))


def box_issue(b: Column, tol: float = 0.001) -> Column:
    """invalid, no_overlap or partial; null for a box inside the image."""
    x, y, w, h = (F.get(b, k) for k in range(4))
    inside = (x >= -tol) & (y >= -tol) & (x + w <= 1 + tol) & (y + h <= 1 + tol)
    off = (x >= 1) | (y >= 1) | (x + w <= 0) | (y + h <= 0)
    return F.when(~box_valid(b), "invalid").when(inside, F.lit(None)).when(off, "no_overlap").otherwise("partial")


def box_overflow(b: Column) -> Column:
    x, y, w, h = (F.get(b, k) for k in range(4))
    return F.greatest(-x, -y, x + w - 1, y + h - 1, F.lit(0.0))


def box_clipped(b: Column) -> Column:
    """The part inside the image, 6 decimals; null if nothing is left."""
    x, y, w, h = (F.get(b, k) for k in range(4))
    x1, y1 = F.greatest(x, F.lit(0.0)), F.greatest(y, F.lit(0.0))
    x2, y2 = F.least(x + w, F.lit(1.0)), F.least(y + h, F.lit(1.0))
    out = F.array(*[F.bround(v, 6) for v in (x1, y1, x2 - x1, y2 - y1)])
    return F.when((F.get(out, 2) > 0) & (F.get(out, 3) > 0), out)


def box_overlap(b: Column) -> Column:
    """The share of a box that is inside the image."""
    x, y, w, h = (F.get(b, k) for k in range(4))
    iw = F.greatest(F.least(x + w, F.lit(1.0)) - F.greatest(x, F.lit(0.0)), F.lit(0.0))
    ih = F.greatest(F.least(y + h, F.lit(1.0)) - F.greatest(y, F.lit(0.0)), F.lit(0.0))
    return F.coalesce(F.try_divide(iw * ih, w * h), F.lit(0.0))


def box_action(b: Column, tol: float = 0.001, clip: float = 0.02) -> Column:
    """keep, clip or delete."""
    issue, w, h = box_issue(b, tol), F.get(b, 2), F.get(b, 3)
    gone = issue.isin("invalid", "no_overlap") | (w > 1) | (h > 1) | (box_overflow(b) > clip) | box_clipped(b).isNull()
    return F.when(issue.isNull(), "keep").when(gone, "delete").otherwise("clip")


def iou(a: Column, b: Column) -> Column:
    ax, ay, aw, ah = (F.get(a, k) for k in range(4))
    bx, by, bw, bh = (F.get(b, k) for k in range(4))
    iw = F.greatest(F.least(ax + aw, bx + bw) - F.greatest(ax, bx), F.lit(0.0))
    ih = F.greatest(F.least(ay + ah, by + bh) - F.greatest(ay, by), F.lit(0.0))
    return F.coalesce(F.try_divide(iw * ih, aw * ah + bw * bh - iw * ih), F.lit(0.0))


def pixel_corners(b: Column, width: Column, height: Column) -> Column:
    """x1, y1, x2, y2 in whole pixels, half to even."""
    x, y, w, h = (F.get(b, k) for k in range(4))
    return F.array(F.rint(x * width), F.rint(y * height), F.rint((x + w) * width), F.rint((y + h) * height))


def relative_box(corners: Column, width: Column, height: Column) -> Column:
    x1, y1, x2, y2 = (F.get(corners, k) for k in range(4))
    return F.array(F.bround(x1 / width, 6), F.bround(y1 / height, 6), F.bround((x2 - x1) / width, 6), F.bround((y2 - y1) / height, 6))


def corner_delta(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda p, q: F.abs(p - q)))


def lenient_bool(v: Column) -> Column:
    """true/1/yes and false/0/no in any case, alone or in a list of one; else null."""
    v = F.lower(F.trim(F.regexp_replace(v, r'^\s*\[\s*|\s*\]\s*$|"', "")))
    return F.when(v.isin("true", "1", "yes", "1.0"), True).when(v.isin("false", "0", "no", "0.0"), False)
