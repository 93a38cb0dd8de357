"""License scans: sparse TF-IDF cosine of license lines to templates, and inheritance from the nearest directory.

Whole files, lines and overlapping blocks of lines with license words are compared with each template, notices and full
texts; terms weigh by their rarity over all documents. Versions and variants are read from what matched. A file
that is mostly license text speaks for its directory; files without a license of their own take that of the nearest
directory above them that has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framesift.llm.common import table, written

# License notices by identifier, and the full texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT/short": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-3-Clause/short": "Use of this source code is governed by a BSD-style license.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0/short": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0/short": "Licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0/short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0/short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0/short": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0/short": "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
} | {f"{x.stem}/text": x.read_text() for x in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))}
CUE = re.compile(r"licen[sc]|copyright|spdx|redistribut|public domain|permission is hereby|copyleft|warrant(?:y|ies)\b|creative commons", re.I)
WORD = re.compile(r"[a-z]+(?:\+\+)?|\d+(?:\.\d+)*")
LEAST = 0.6  # cosine that counts as a match
FILE_SHARE = 0.5  # of a file's words that license lines make up in a license file
WINDOW = 4  # lines with cues at most two lines apart are read together, and each line alone
HEADER = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48)  # lines of the blocks that begin at or up to two lines before a line with a cue
LONG = 64  # lines of the shortest of the blocks of doubling length that begin at every quarter of their length
VERSION = re.compile(r"\bv(?:ersion|\.)?\s*(\d+(?:\.\d+)*)|licen[sc]e[s-]*\s*(\d+\.\d+)", re.I)
GNU = re.compile(r"(affero|lesser|library)?\s*general\s+public\s+licen[sc]e", re.I)
CC = re.compile(r"\bcc[ -](by(?:[ -](?:nc|nd|sa))*)\b|attribution((?:[\s-]+(?:non-?commercial|no-?deriv\w*|share-?alike))*)", re.I)


def terms(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def term_counts(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those with each term of the templates: over all documents, counted in the tasks.
    What comes to the driver is bounded by the templates' terms."""
    vocabulary = frozenset(t for x in TEMPLATES.values() for t in terms(x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, count = 0, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                count.update(vocabulary.intersection(WORD.findall((text or "").lower())))
        count[""] = n
        yield pa.RecordBatch.from_pydict({"term": list(count), "n": list(count.values())})

    got = docs.select(F.col("text").cast("string")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n")).collect()
    counts = {r[0]: r[1] for r in got}
    return counts.pop("", 0), counts


def named(template: str, part: str, text: str) -> str:
    """The identifier of a template, with the version and variant that the part which matched, or else its text, states.

    A license that has versions and states none anywhere is named without one.
    """
    name = template.split("/")[0]
    family = name.rsplit("-", 1)[0]
    if family in ("GPL", "LGPL", "AGPL"):
        if m := GNU.search(part):
            family = {"affero": "AGPL", "lesser": "LGPL", "library": "LGPL"}.get((m[1] or "").lower(), "GPL")
    elif name.startswith("CC-BY"):
        if m := CC.search(part):
            more = (m[1] or m[2] or "").lower()
            family = "-".join(["CC-BY", *[k for k, w in (("NC", "nc|non-?comm"), ("ND", "nd|no-?deriv"), ("SA", "sa|share")) if re.search(rf"\b(?:{w})", more)]])
        m = re.search(r"\b([1-4]\.\d)\b", part)
        return f"{family}-{m[1]}" if m else family
    elif name == "BSD-3-Clause":
        if template.endswith("/short") or re.search(r"neither\s+the\s+names?|endorse\s+or\s+promote", text, re.I):
            return "BSD-4-Clause" if re.search(r"all\s+advertising\s+materials", text, re.I) else name
        return "BSD-2-Clause"
    elif family not in ("Apache", "MPL"):
        return name
    m = VERSION.search(part) or VERSION.search(text)
    if not m:
        return family
    version = m[1] or m[2]
    return f"{family}-{version if '.' in version else version + '.0'}"


class Matcher:
    def __init__(self, n_docs: int, counts: dict[str, int]):
        self.n, self.counts = n_docs, counts
        self.names = list(TEMPLATES)
        self.index: dict[str, list[tuple[int, float]]] = {}
        for k, text in enumerate(TEMPLATES.values()):
            v = {t: (1 + math.log(c)) * self.idf(t) for t, c in terms(text).items()}
            size = math.sqrt(sum(x * x for x in v.values()))
            for t, x in v.items():
                self.index.setdefault(t, []).append((k, x / size))

    def idf(self, term: str) -> float:
        return math.log((2 + self.n) / (1 + self.counts.get(term, 0)))

    def best(self, counted: Counter) -> tuple[float, str | None]:
        scores, size = [0.0] * len(self.names), 0.0
        for t, c in counted.items():
            x = (1 + math.log(c)) * self.idf(t)
            size += x * x
            for k, w in self.index.get(t, ()):
                scores[k] += x * w
        if not size:
            return 0.0, None
        return max(zip((s / math.sqrt(size) for s in scores), self.names, strict=True))

    def scan(self, text: str) -> tuple[str | None, float, bool]:
        """License, cosine, and whether the text is a license file. Whole texts without a cue have none."""
        if not CUE.search(text):
            return None, 0.0, False
        lines = text.split("\n")
        n, cued = len(lines), [k for k, x in enumerate(lines) if CUE.search(x)]
        found: list[tuple[float, str, int, str]] = []

        def compare(part: str, counted: Counter) -> None:
            score, name = self.best(counted)
            if name and score >= LEAST:
                found.append((score, name, len(part.split()), part))

        for k in cued:
            for s in [lines[k], *[s for s in re.split(r"(?<=[.!?])\s+", lines[k]) if CUE.search(s)]]:
                compare(s, terms(s))
        runs = [[cued[0], cued[0]]]
        for k in cued[1:]:
            if k - runs[-1][1] <= 2 and k - runs[-1][0] < WINDOW:
                runs[-1][1] = k
            else:
                runs.append([k, k])
        spans = {(a, b + 1) for a, b in runs if b > a} | {(0, n)}
        spans |= {(a, a + m) for k in cued for a in range(max(0, k - 2), k + 1) for m in HEADER if k < a + m <= n}
        m = LONG
        while m < n:
            step = m // 4
            spans |= {(a, min(n, a + m)) for k in cued for a in range(max(0, (k - m) // step + 1) * step, k + 1, step)}
            m *= 2
        by_line: dict[int, Counter] = {}
        at, counted, end = None, Counter(), 0
        for a, b in sorted(spans):
            if a != at:
                at, counted, end = a, Counter(), a
            for k in range(end, b):
                if k not in by_line:
                    by_line[k] = terms(lines[k])
                for t, c in by_line[k].items():
                    counted[t] += c
            end = b
            compare("\n".join(lines[a:b]), counted)
        if not found:
            return None, 0.0, False
        score, name, _, part = max(found)
        return named(name, part, text), score, max(f[2] for f in found) >= FILE_SHARE * max(1, len(text.split()))


def scanned(files: DataFrame) -> DataFrame:
    """files(doc_id, path, text) to (doc_id, path, license, score, is_license_file), a row for each row.

    Null and empty texts have no license; null ids and paths stay null; other columns are ignored.
    """
    n, counts = term_counts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(n, counts)
        for batch in batches:
            got = [matcher.scan(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())], names=["doc_id", "path", "license", "score", "is_license_file"])

    x = files.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"))
    return x.mapInArrow(run, "doc_id long, path string, license string, score double, is_license_file boolean")


def _directory(path):
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(scan: DataFrame) -> DataFrame:
    """scan(doc_id, path, license, score, is_license_file) with inherited_license, inherited_from and final_license.

    A directory's license is that of its best scored license file (ties: the smallest path, then license). A null path
    inherits nothing. scan should be written already: it is read twice.
    """
    own = scan.where("is_license_file and license is not null and path is not null").withColumn("dir", _directory(F.col("path")))
    own = own.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("b")).select(F.col("dir").alias("above"), F.col("b.license").alias("inherited_license"))
    # few: one row for each directory, not for each file
    dirs = scan.where("path is not null").select(_directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("depth", "above"))
    nearest = above.join(own, "above").withColumn("r", F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("depth")))).where("r = 1")
    nearest = nearest.select("dir", "inherited_license", F.col("above").alias("inherited_from"))
    x = scan.withColumn("dir", _directory(F.col("path"))).join(nearest, "dir", "left")
    return x.select("doc_id", "path", "license", "score", "is_license_file", "inherited_license", "inherited_from", F.coalesce("license", "inherited_license").alias("final_license"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents, at paths of source, lang and doc_id: see scanned() and inherited()."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    return inherited(written(scanned(docs), "licenses"))
