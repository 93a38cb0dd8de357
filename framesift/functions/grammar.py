"""Short texts that users give on the driver: lists of names, class grammars, thresholds, attribute and field specs."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A class of an attribute, a field with its range, ranges of thresholds, the keypoint schemas and their fields.
ATTRIBUTE_CLASS = r"(?P<label>[^-]+)-(?P<attr>[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z][A-Za-z0-9]*)*)_(?P<code>\d+)"
FIELD_RANGE = r"([A-Za-z][A-Za-z0-9_]*):([0-9]+)-([0-9]+)"
THRESHOLDS = {"edge": "[0, 0.5)", "clip": "(0, 0.5)", "iou": "(0, 1]"}
POINT_COUNTS, KEYPOINT_PREFIX, RESERVED_ATTRIBUTE = (42, 68), "kpt", "label_id"
KEYPOINTS_FIELD, KEYPOINTS_68_FIELD, FACE_LABEL = "keypoints", "keypoints_68", "kpt_face"


def names(text: str | None, repeated: str = "error") -> list[str]:
    """The names of a comma-separated list. repeated: error, drop (the first stays) or keep; an empty list is an error."""
    out = [x.strip() for x in (text or "").split(",") if x.strip()]
    if not out:
        raise ValueError("no names")
    if repeated == "keep":
        return out
    once = list(dict.fromkeys(out))
    if repeated == "error" and len(once) < len(out):
        raise ValueError("repeated names: " + ", ".join(sorted({x for x in out if out.count(x) > 1})))
    return once


@dataclass(frozen=True)
class AttributeClasses:
    """Classes label-attribute_code of one attribute, by label and code, and plain labels beside them."""

    attribute: str
    by_code: Mapping[tuple[str, int], str]
    plain: tuple[str, ...]

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(sorted({label for label, _ in self.by_code}))


def attribute_classes(classes: Sequence[str]) -> AttributeClasses | None:
    """The rules behind a list of classes; None where all are plain labels.

    One attribute only, each code of a label once, and no plain label that is an attribute's label too.
    """
    found = {c: m for c in classes if (m := re.fullmatch(ATTRIBUTE_CLASS, c))}
    if not found:
        return None
    kinds = sorted({m["attr"] for m in found.values()})
    if len(kinds) > 1:
        raise ValueError("classes of several attributes: " + ", ".join(kinds))
    by_code: dict[tuple[str, int], str] = {}
    for c in classes:
        if c in found:
            key = (found[c]["label"], int(found[c]["code"]))
            if key in by_code:
                raise ValueError(f"one code twice: {by_code[key]}, {c}")
            by_code[key] = c
    plain = tuple(c for c in classes if c not in found)
    both = sorted(set(plain) & {label for label, _ in by_code})
    if both:
        raise ValueError("plain labels that are labels of the attribute too: " + ", ".join(both))
    return AttributeClasses(kinds[0], by_code, plain)


def threshold(value: float | str, kind: str) -> float:
    """A finite number in the range of its kind."""
    span, x = THRESHOLDS[kind], float(value)
    low, high = (float(v) for v in span[1:-1].split(","))
    if not (math.isfinite(x) and (low < x or span[0] == "[" and low == x) and (x < high or span[-1] == "]" and high == x)):
        raise ValueError(f"{kind}: {value} is not in {span}")
    return x


def select_attribute(text: str) -> tuple[str, list[str]]:
    """name=a,b to the name and its options, each once."""
    name, eq, rest = text.partition("=")
    options = list(dict.fromkeys(x.strip() for x in rest.split(",") if x.strip()))
    if not (eq and name.strip() and options):
        raise ValueError(f"not of the form name=option,option: {text}")
    if name.strip() == RESERVED_ATTRIBUTE:
        raise ValueError(f"{RESERVED_ATTRIBUTE} is reserved")
    return name.strip(), options


def select_attributes(items: Sequence[str]) -> dict[str, list[str]]:
    out = [select_attribute(x) for x in items]
    if len(dict(out)) < len(out):
        raise ValueError("an attribute is given twice")
    return dict(out)


def field_range(text: str) -> tuple[str, int, int]:
    """name:low-high."""
    m = re.fullmatch(FIELD_RANGE, text.strip())
    if not m or int(m[2]) > int(m[3]):
        raise ValueError(f"not of the form name:low-high: {text}")
    return m[1], int(m[2]), int(m[3])


def report_name(dataset: str) -> str:
    """A dataset's name as part of a file name."""
    return re.sub(r"[^\w.-]", "_", dataset)


def refuse_keypoint_classes(classes: Sequence[str]) -> None:
    bad = [c for c in classes if c.startswith(KEYPOINT_PREFIX)]
    if bad:
        raise ValueError("classes of keypoints among those of boxes: " + ", ".join(bad))


def require_keypoint_label(label: str) -> None:
    if not label.startswith(KEYPOINT_PREFIX):
        raise ValueError(f"a label of keypoints begins with {KEYPOINT_PREFIX}: {label}")


def require_project(existing: Mapping[str, set[str]] | None, classes: Sequence[str], attributes: Sequence[str] = ()) -> None:
    """A project that exists already must have just these classes, and each attribute at each of them."""
    if existing is None:
        return
    if set(existing) != set(classes):
        raise ValueError(f"the project has classes {sorted(existing)}, not {sorted(classes)}")
    gaps = [f"{c}: {','.join(missing)}" for c in classes if (missing := [a for a in attributes if a not in existing[c]])]
    if gaps:
        raise ValueError("the project lacks attributes; " + "; ".join(gaps))


def labels_of_task(task: Mapping[str, int], project: Mapping[str, int]) -> Mapping[str, int]:
    """A task's labels, else those of its project."""
    return task or project


def skeleton_schema(text: str) -> tuple[list[str], list[list[int]]]:
    """Names and edges of the one category of a keypoint file: 42 or 68 names, edges of two or more places among them."""
    categories = json.loads(text).get("categories")
    if not isinstance(categories, list) or len(categories) != 1 or not isinstance(categories[0], dict):
        raise ValueError("a keypoint file has one category")
    points, edges = categories[0].get("keypoints"), categories[0].get("skeleton")
    if not isinstance(points, list) or len(points) not in POINT_COUNTS or not all(isinstance(p, str) and p for p in points):
        raise ValueError("42 or 68 names of keypoints are needed")
    if not isinstance(edges, list) or not edges:
        raise ValueError("a category needs edges")
    for e in edges:
        if not isinstance(e, list) or len(e) < 2 or not all(type(i) is int and 0 <= i < len(points) for i in e):
            raise ValueError(f"no edge among {len(points)} points: {e}")
    return points, edges


def drawing_template(text: str, points: Sequence[str]) -> dict[str, tuple[float, float]]:
    """The place of each keypoint in a drawing, from a JSON map of names to [x, y]; just these names."""
    places = json.loads(text)
    if not isinstance(places, dict) or set(places) != set(points):
        raise ValueError("a template has a place for each keypoint, and no more")
    for p in points:
        if not (isinstance(places[p], list) and len(places[p]) == 2 and all(isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) for v in places[p])):
            raise ValueError(f"no place: {p} {places[p]}")
    return {p: (float(places[p][0]), float(places[p][1])) for p in points}


def keypoint_target(n_points: int, field: str, label: str) -> tuple[str, str]:
    """The field and label for faces of so many points: 68 points have a field of their own."""
    if n_points == POINT_COUNTS[1]:
        if field not in (KEYPOINTS_FIELD, KEYPOINTS_68_FIELD) or label != FACE_LABEL:
            raise ValueError(f"68 points belong into {KEYPOINTS_68_FIELD}, with label {FACE_LABEL}")
        return KEYPOINTS_68_FIELD, FACE_LABEL
    if field == KEYPOINTS_68_FIELD:
        raise ValueError(f"{KEYPOINTS_68_FIELD} is for 68 points")
    return field, label


def stored_value(text: Column) -> Column:
    """A stored value as text; blank ones are missing."""
    return F.nullif(F.trim(text), F.lit(""))


def same_number(text: Column, value: Column) -> Column:
    """Whether a stored text is the number: "2" is 2, "2.0" and " 2" are not."""
    return F.coalesce(F.when(text.rlike("^-?[0-9]+$"), text.try_cast("bigint") == value), F.lit(False))
