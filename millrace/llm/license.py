"""Licence scans: TF-IDF cosine to templates, and inheritance along directories.

Every line of a file, every run of neighbouring lines that speak of licences,
and the whole file are compared with the templates as sparse TF-IDF vectors.
Document frequencies of the templates' words are counted over all files.  A
line can only reach the threshold if it has a word that matters in a template
(see ``strong_terms``), so other lines are passed over without loss.  Runs are
looked at by themselves and bridged over up to BRIDGE other lines, such as
blank ones; a bridged run may still leave out lines at its ends.

Templates are one-line declarations, the standard headers and the full texts in
``licences/`` (none is at hand for AGPL-3.0 and CC-BY-NC-4.0).  Full texts of
over LONG words are compared with what has at least half as many.  Where the
licences of a family share their wording, the telling words decide.

A file without a licence of its own takes that of the nearest directory above
it that has a licence file.  Paths are joined directory by directory; only
distinct directories are taken apart into their ancestors.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import prepared, settle
from millrace.llm.words import raw, runs, word_hashes, word_spans

THRESHOLD = 0.7
#: Lines without a strong word that a run may hold between others.
BRIDGE = 4
#: Words of a template that is only compared with texts of at least half its length.
LONG = 400
FILE_NAMES = r"(?i)^(un)?licen[cs]e|^copying|^notice"

# Wording by which licences are declared.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, dedicated to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited."),
]


def _gnu(what: str, name: str, version: str) -> str:
    return (
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
        f"General Public License as published by the Free Software Foundation; either version {version} of the License, "
        f"or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {name} General Public License for more details. You should have received a copy of the GNU {name} "
        f"General Public License along with this {what}"
    )


_OLD = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_NEW = ". If not, see https://www.gnu.org/licenses/"

#: The headers that the licences themselves ask for.
HEADERS = [
    *[("GPL-2.0", _gnu("program", "", "2") + end) for end in (_OLD, _NEW)],
    *[("GPL-3.0", _gnu("program", "", "3") + end) for end in (_OLD, _NEW)],
    *[("LGPL-2.1", _gnu("library", "Lesser", "2.1") + end) for end in (_OLD, _NEW)],
    *[("LGPL-3.0", _gnu("library", "Lesser", "3") + end) for end in (_OLD, _NEW)],
    ("AGPL-3.0", _gnu("program", "Affero", "3") + _NEW),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "Apache-2.0",
        TEMPLATES[1][1] + " Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    *[
        (f"CC-{short}-4.0", f"This work is licensed under a Creative Commons Attribution{name} 4.0 International License.")
        for short, name in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"))
    ],
]
FULL_TEXTS = [
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC",
    "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
]
TEMPLATES += HEADERS + [(n, pkgutil.get_data("millrace.llm", f"licences/{n}.txt").decode()) for n in FULL_TEXTS]

_GNU = {("", "2"): "GPL-2.0", ("", "3"): "GPL-3.0", ("lesser", "2 1"): "LGPL-2.1", ("lesser", "3"): "LGPL-3.0", ("affero", "3"): "AGPL-3.0"}

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(128) if not chr(b).isalnum() and b != 10]] = 32


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (letters and digits), their first bytes, and each text's first word (n + 1)."""
    plain = _PLAIN[data]
    starts, ends, first = word_spans(plain, at)
    return word_hashes(plain, starts, ends), starts, first


class Templates:
    """The templates' words as sorted hashes, and one row of word counts per template."""

    def __init__(self, templates: list[tuple[str, str]]) -> None:
        self.names = [n for n, _ in templates]
        texts = [np.frombuffer(t.encode(), np.uint8) for _, t in templates]
        found = [hashed_words(t, np.array([0, len(t)]))[0] for t in texts]
        self.words = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        self.counts = np.zeros((len(texts), len(self.words)))
        for i, hashes in enumerate(found):
            np.add.at(self.counts[i], np.searchsorted(self.words, hashes), 1)

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """The number of every word, -1 for one that no template has."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def _numbers(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.terms(hashed_words(data, np.array([0, len(data)]))[0]).tolist() if len(self.words) else []

    def told(self, name: str, terms: np.ndarray, file: np.ndarray) -> str:
        """The licence of a family that the telling words of a stretch, and of its file, name."""
        if not hasattr(self, "telling"):
            asked = "version 2 1 3 affero lesser redistribution endorse disclaimer"
            self.telling = dict(zip(asked.split(), self._numbers(asked)))
        word = self.telling
        has = lambda w, among=terms: word[w] >= 0 and bool((among == word[w]).any())
        if name in _GNU.values() and len(terms) < LONG:
            kind = "affero" if has("affero") else "lesser" if has("lesser") else ""
            after = np.flatnonzero(terms[:-1] == word["version"]) + 1
            for k in after.tolist():
                number = next((n for n in "23" if terms[k] == word[n]), "")
                if number == "2" and k + 1 < len(terms) and terms[k + 1] == word["1"]:
                    number = "2 1"
                if number:
                    other = _GNU.get((kind, number), name)
                    return other if other in self.names else name
        if name in ("BSD-2-Clause", "BSD-3-Clause") and has("redistribution") and len(terms) < LONG:
            # the permission is the same; the third clause is further down
            other = "BSD-3-Clause" if has("endorse", file) else "BSD-2-Clause" if has("disclaimer", file) else name
            return other if other in self.names else name
        return name


def idf(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.log((1 + documents) / (1 + frequency)) + 1


def strong_terms(weighted: np.ndarray, threshold: float) -> np.ndarray:
    """Words without which no text reaches the threshold.

    In every template the lightest words whose joint length is below
    ``threshold`` of the template's are weak there.  A text whose common words
    with a template are all weak has a cosine below the threshold, by the
    Cauchy-Schwarz inequality.  A word is strong if it is not weak everywhere.
    """
    strong = np.zeros(weighted.shape[1], bool)
    for row in weighted:
        order = np.argsort(row, kind="stable")
        part = np.sqrt(np.cumsum(row[order] ** 2)) / max(np.linalg.norm(row), 1e-12)
        strong[order[(part >= threshold) & (row[order] > 0)]] = True
    return strong


def _frequencies(templates: Templates):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(templates.words), np.int64), 0
        for batch in batches:
            data, at = raw(batch["text"])
            n += batch.num_rows
            for i, j in runs(at):
                hashes, _, first = hashed_words(data[at[i] : at[j]], at[i : j + 1] - at[i])
                term = templates.terms(hashes)
                owner = np.repeat(np.arange(j - i), np.diff(first))[term >= 0]
                pairs = np.unique(owner * len(templates.words) + term[term >= 0])
                total += np.bincount(pairs % len(templates.words), minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(total))), pa.array(np.append(n, total))], names=["term", "n"]
        )

    return work


SCANNED = (
    "uid long, found array<struct<licence:string,similarity:double,first_line:long,last_line:long>>, whole boolean"
)
_FOUND = pa.list_(
    pa.struct([("licence", pa.string()), ("similarity", pa.float64()), ("first_line", pa.int64()), ("last_line", pa.int64())])
)


def _scanner(templates: Templates, weights: np.ndarray, threshold: float):
    weighted = templates.counts * weights
    unit = weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    sizes = templates.counts.sum(axis=1)
    needs = np.where(sizes > LONG, sizes / 2, 0)
    strong = strong_terms(weighted[needs == 0], threshold)
    telling = strong_terms(weighted[needs > 0], threshold)
    by_need = np.argsort(needs, kind="stable")
    unit, needs, names = unit[by_need], needs[by_need], [templates.names[k] for k in by_need]

    def best(terms: np.ndarray) -> tuple[float, str]:
        """The nearest template; words of no template have the least weight."""
        known = terms[terms >= 0]
        vector = np.bincount(known, minlength=len(weights)) * weights
        other = len(terms) - len(known)
        length = np.sqrt((vector**2).sum() + other)
        alike = unit[: np.searchsorted(needs, len(terms), "right")] @ vector / max(length, 1e-12)
        top = max(range(len(alike)), key=lambda k: (alike[k], names[k]), default=None)
        return (0.0, "") if top is None else (min(1.0, float(alike[top])), names[top])

    def scan(terms: np.ndarray, lines: np.ndarray) -> tuple[list, bool]:
        speaking = np.unique(lines[(terms >= 0) & strong[terms]])
        found: dict[str, tuple] = {}

        def look(low: int, high: int) -> None:
            part = terms[np.searchsorted(lines, low) : np.searchsorted(lines, high, "right")]
            alike, name = best(part)
            if alike < threshold:
                return
            name = templates.told(name, part, terms)
            if alike > found.get(name, (0.0,))[0]:
                found[name] = (alike, low, high)

        for line in speaking.tolist():
            look(line, line)
        spans = set()
        for gap in range(BRIDGE + 1):
            breaks = np.flatnonzero(np.diff(speaking) > gap + 1)
            if len(speaking):
                spans.update(zip(speaking[np.append(0, breaks + 1)].tolist(), speaking[np.append(breaks, -1)].tolist()))
        for low, high in sorted(spans):
            if high > low:
                look(low, high)
        whole = best(terms)[0] >= threshold
        if whole:
            look(int(lines[0]), int(lines[-1]))
        rows = [{"licence": n, "similarity": a, "first_line": f, "last_line": t} for n, (a, f, t) in found.items()]
        return sorted(rows, key=lambda r: (-r["similarity"], r["first_line"], r["licence"])), whole

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = raw(batch["text"])
            found, wholes = [], []
            for i, j in runs(at):
                part = data[at[i] : at[j]]
                hashes, starts, first = hashed_words(part, at[i : j + 1] - at[i])
                terms = templates.terms(hashes)
                breaks = np.flatnonzero(part == 10)
                line = np.searchsorted(breaks, starts)
                base = np.searchsorted(breaks, at[i:j] - at[i])
                hits = np.concatenate([[0], np.cumsum((terms >= 0) & strong[terms])])[first]
                long_hits = np.concatenate([[0], np.cumsum((terms >= 0) & telling[terms])])[first]
                least = needs[needs > 0].min(initial=np.inf)
                for k in range(j - i):
                    long = first[k + 1] - first[k] >= least and long_hits[k] < long_hits[k + 1]
                    if hits[k] == hits[k + 1] and not long:
                        found.append([])
                        wholes.append(False)
                    else:
                        own = slice(first[k], first[k + 1])
                        rows, whole = scan(terms[own], line[own] - base[k])
                        found.append(rows)
                        wholes.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch["uid"], pa.array(found, _FOUND), pa.array(wholes, pa.bool_())], names=["uid", "found", "whole"]
            )

    return work


def scan_texts(rows: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``uid, found, whole`` for ``rows(uid, text)``: the licences declared, best first, with their lines
    (from 0), and whether the text as a whole is one.  Null and empty texts declare none."""
    known = Templates(templates)
    counts = rows.mapInArrow(_frequencies(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r["term"]: r["n"] for r in counts.collect()}  # one row per word of the templates
    frequency = np.array([sums.get(t, 0) for t in range(len(known.words))], np.float64)
    return rows.mapInArrow(_scanner(known, idf(sums.get(-1, 0), frequency), threshold), SCANNED)


def scan_files(
    files: DataFrame, path_col: str = "path", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, names: str = FILE_NAMES,
) -> DataFrame:
    """One row per file: ``uid, path, licence, similarity, origin, from_dir, found``.

    ``origin`` is ``header`` for a licence the file declares itself, ``file``
    where it is a licence file (by its name, or because its whole text is one),
    ``inherited`` for that of the nearest directory above it, else null.  Of
    several declared licences the most similar counts, then the first line,
    then the name.  Of several licence files in a directory, the licence that
    most of them declare, then the name.  Files with null paths are in no
    directory.  ``/`` parts a path; the directory of a path without one is ''.
    Repeated paths are files of their own; other columns are ignored.
    """
    prepared(files.sparkSession)
    rows = files.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{path_col}`").cast("string").alias("path"),
        F.col(f"`{text_col}`").alias("text"),
    )
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "/+$", "")
    # path and text of a row are found again by its number
    scanned = scan_texts(rows.select("uid", "text"), templates, threshold)
    paths = rows.select("uid", "path", folder.alias("dir"), F.coalesce(name.rlike(names), F.lit(False)).alias("named"))
    known = settle(paths.join(scanned, "uid"), "licences")
    known = known.withColumn("first", F.try_element_at("found", F.lit(1)))
    known = known.withColumn("is_file", F.col("first").isNotNull() & (F.col("named") | F.col("whole")))

    votes = known.filter("is_file and path is not null").groupBy("dir", F.col("first.licence").alias("licence"))
    votes = votes.agg(F.count("*").alias("files"), F.max("first.similarity").alias("similarity"))
    best = Window.partitionBy("dir").orderBy(F.desc("files"), "licence")
    declared = votes.withColumn("place", F.row_number().over(best)).filter("place = 1")
    declared = declared.select(F.col("dir").alias("from_dir"), F.col("licence").alias("dir_licence"), F.col("similarity").alias("dir_similarity"))

    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = known.filter("path is not null").select("dir").distinct().withColumn("from_dir", F.explode(F.array_distinct(above)))
    nearest = (
        folders.join(declared, "from_dir")
        .groupBy("dir")
        .agg(F.max_by(F.struct("from_dir", "dir_licence", "dir_similarity"), F.length("from_dir")).alias("near"))
    )
    out = known.join(nearest, "dir", "left")
    inherited = F.col("first").isNull() & F.col("near").isNotNull() & F.col("path").isNotNull()
    return out.select(
        "uid",
        "path",
        F.coalesce("first.licence", F.when(inherited, F.col("near.dir_licence"))).alias("licence"),
        F.coalesce("first.similarity", F.when(inherited, F.col("near.dir_similarity"))).alias("similarity"),
        F.when(F.col("is_file"), "file").when(F.col("first").isNotNull(), "header").when(inherited, "inherited").alias("origin"),
        F.when(inherited, F.col("near.from_dir")).alias("from_dir"),
        "found",
    )
