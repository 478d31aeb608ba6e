"""Licences of documents by sparse TF-IDF cosine, and inheritance along directories.

Every line of a text, every few neighbouring lines (a header may stand anywhere, wrapped at
will) and the whole text (a licence file) are compared with templates: lines with short notices
and standard headers, the whole text with notices and with the full texts of licences, which
decide if they fit. Lines that are a licence's title or an SPDX tag are compared with those, all of whose words
they must hold; a text that is a title, but for copyright lines, is a licence file. Any named licence wins over `All rights reserved`. The vocabulary is that of the templates without function words;
weights are inverse document frequencies counted over all documents. Words outside of the
vocabulary count with the weight of an unseen word, so a licence mentioned in passing inside a
long line stays far from its template. Documents without a licence of their own inherit from
the nearest directory above them that holds a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postgauge.llm.tables import map_beside, materialise, small

#: Short notices by which public licences are commonly declared.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("Proprietary", "All rights reserved."),
)
_GNU = (
    "{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
    "the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
)
_CC = "This work is licensed under a Creative Commons {0} 4.0 International License."
#: The standard headers of public licences, as a source file has them over several lines.
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-1.0", _GNU.format("This program", "General Public License", "1")),
    ("GPL-2.0", _GNU.format("This program", "General Public License", "2")),
    ("GPL-3.0", _GNU.format("This program", "General Public License", "3")),
    ("LGPL-2.0", _GNU.format("This library", "Library General Public License", "2")),
    ("LGPL-2.1", _GNU.format("This library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("This library", "Lesser General Public License", "3")),
    ("AGPL-3.0", _GNU.format("This program", "Affero General Public License", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)
#: Titles of licence files.
TITLES = (
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL-2.0", "GNU General Public License v2.0"), ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License v3.0"), ("GPL-3.0", "GNU General Public License, version 3"),
    ("LGPL-2.1", "GNU Lesser General Public License v2.1"), ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License v3.0"), ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License v3.0"), ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("MPL-2.0", "Mozilla Public License, version 2.0"),
)
#: Identifiers that SPDX tags give to licences; a GNU one may go on with `-only`, `-or-later` or `+`.
SPDX = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 "
    "GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0"
).split()
TAGS = tuple((name, f"SPDX-License-Identifier: {name}{end}") for name in SPDX for end in ("", *(("-only", "-or-later") if "GPL" in name else ())))
WINDOW_LINES, WINDOW_TERMS, FILE_FLOOR, EXACT_FLOOR = 12, 60, 0.8, 0.9
_COPYRIGHT = re.compile(r"(?i)\W*(?:copyright\b|\(c\)|©|all rights reserved)")
STOP_WORDS = frozenset("a an and any are as by for form forms from in is it not of on or the this to use with you may".split())
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def terms(text: str) -> Counter:
    return Counter(w for w in _WORD.findall(text.lower()) if w not in STOP_WORDS)


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """Names and whole texts of licences; the Affero licence is GPL 3 under its own name."""
    read = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    read["AGPL-3.0"] = re.sub(r"(?i)(GNU)\s+(General\s+Public\s+License)", r"\1 Affero \2", read["GPL-3.0"])
    return tuple(read.items())


def windows(lines: list[Counter], known) -> Iterator[Counter]:
    """Neighbouring lines put together, from one with a known word to another."""
    at = [k for k, line in enumerate(lines) if line.keys() & known]
    for n, begin in enumerate(at):
        joined, done = Counter(lines[begin]), begin + 1
        for end in at[n + 1 : n + WINDOW_LINES]:
            if end - begin >= WINDOW_LINES:
                break
            for line in lines[done : end + 1]:
                joined.update(line)
            done = end + 1
            if joined.total() > WINDOW_TERMS:
                break
            yield joined


def vocabulary(templates) -> list[str]:
    return sorted({w for _, text in templates for w in terms(text)})


def document_frequencies(docs: DataFrame, words: list[str], text: str) -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each word of the vocabulary."""

    def start():
        known = {w: k for k, w in enumerate(words)}

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            found = [sorted({known[w] for w in set(_WORD.findall((x.as_py() or "").lower())) & known.keys()}) for x in columns[0]]
            return [pa.array(found, pa.list_(pa.int32()))]

        return work

    found = map_beside(docs, [F.col(text)], start, "found array<int>", carry=[])
    counts = found.select(F.explode(F.array_append("found", F.lit(-1))).alias("k")).groupBy("k").count().collect()
    by_word = {r["k"]: r["count"] for r in counts}  # one row for each word of the templates
    return by_word.pop(-1, 0), {words[k]: n for k, n in by_word.items()}


class Matcher:
    """Best template of a piece of text."""

    def __init__(self, templates, n: int, frequencies: dict[str, int]):
        self.unseen = math.log(n + 1) + 1
        self.idf = {w: math.log((n + 1) / (frequencies.get(w, 0) + 1)) + 1 for w in vocabulary(templates)}
        self.vectors = []
        for name, text in templates:
            weights = {w: c * self.idf[w] for w, c in terms(text).items()}
            self.vectors.append((name, weights, math.sqrt(sum(x * x for x in weights.values()))))

    def best(self, found: Counter, floor: float = 0.0, whole: bool = False) -> tuple[float, str | None]:
        """Cosine and name; with `whole`, of the templates all of whose words were found."""
        if not found.keys() & self.idf.keys():
            return 0.0, None
        weights = {w: c * self.idf.get(w, self.unseen) for w, c in found.items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        if floor and math.sqrt(sum(x * x for w, x in weights.items() if w in self.idf)) < floor * norm * (1 - 1e-9):
            return 0.0, None  # no cosine is above the share of the known words
        scores = []
        for k, (name, vector, size) in enumerate(self.vectors):
            if whole and not vector.keys() <= weights.keys():
                continue
            dot = sum(x * weights[w] for w, x in vector.items() if w in weights)
            scores.append((dot / (norm * size), -k, name))
        score, _, name = max(scores, default=(0.0, 0, None))
        return score, name


def own_licenses(docs: DataFrame, templates=TEMPLATES, floor: float = 0.7, text: str = "text", carry=None) -> DataFrame:
    """`row`, license, score and `whole`: whether the document is a licence file."""
    full = full_texts()
    n, frequencies = document_frequencies(docs, vocabulary((*templates, *HEADERS, *TITLES, *TAGS, *full)), text)

    def start():
        matcher, headers, titles, tags, files = (Matcher(x, n, frequencies) for x in (templates, HEADERS, TITLES, TAGS, full))
        known = matcher.idf.keys() | headers.idf.keys()
        any_known = known | titles.idf.keys() | tags.idf.keys()

        def judge(value: str | None) -> tuple[str | None, float, bool]:
            lines = [terms(line) for line in (value or "").split("\n")]
            if not any(line.keys() & any_known for line in lines):
                return None, 0.0, False
            total = Counter()
            for line in lines:
                total.update(line)
            score, name = files.best(total, FILE_FLOOR)
            if score >= FILE_FLOOR:
                return name, score, True
            stated = [m.best(line, EXACT_FLOOR, whole=True) for line in lines for m in (titles, tags)]
            score, name = max(stated, key=lambda x: x[0])
            if score >= EXACT_FLOOR:
                # A title by itself makes a file: nothing stands beside it but copyright lines.
                rest = sum((terms(x) for x in value.split("\n") if not _COPYRIGHT.match(x)), Counter())
                as_title, title = titles.best(rest, EXACT_FLOOR, whole=True)
                if as_title >= EXACT_FLOOR:
                    return title, as_title, True
            found = [x for x in stated if x[0] >= EXACT_FLOOR] + [matcher.best(line) for line in lines]
            found += [headers.best(line, floor) for line in lines]
            found += [m.best(w, floor) for w in windows(lines, known) for m in (matcher, headers)]
            # The best named licence; without one, `Proprietary`.
            score, name = max(found, key=lambda x: (x[0] >= floor and x[1] != "Proprietary", x[0]))
            as_file, file_name = matcher.best(total)
            if as_file >= floor:
                better = score >= floor and (score > as_file or file_name == "Proprietary")
                return (name if better else file_name), max(score, as_file), True
            return (name, score, False) if score >= floor else (None, score, False)

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            judged = [judge(x.as_py()) for x in columns[0]]
            types = pa.string(), pa.float64(), pa.bool_()
            return [pa.array(list(c), t) for c, t in zip(zip(*judged) if judged else [()] * 3, types, strict=True)]

        return work

    return map_beside(docs, [F.col(text)], start, "license string, score double, whole boolean", carry)


def directory(path: str) -> Column:
    """What stands before the last slash; the root, an empty string, without one."""
    return F.when(F.col(path).contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan_licenses(
    docs: DataFrame, path: Column, templates=TEMPLATES, floor: float = 0.7, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, path, license, origin (`file`, `header`, `inherited`, null), from_directory.

    A null text has no licence; a null path lies in no directory and inherits nothing. Where a
    directory has several licence files, the most frequent licence counts, then the smaller
    name. Rows that repeat are judged each; extra columns of `docs` are not looked at. Ids and
    texts may be null; an empty table gives no rows.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), path.alias("path"))
    own = own_licenses(named, templates, floor, "text", carry=["doc_id", "path"])
    own = materialise(own.select("row.doc_id", "row.path", "license", "whole").withColumn("directory", directory("path")))
    files = own.where("whole and path is not null").groupBy("directory", "license").count()
    first = W.partitionBy("directory").orderBy(F.desc("count"), "license")  # as many rows as there are licences
    holders = files.withColumn("k", F.row_number().over(first)).where("k = 1").select(F.col("directory").alias("above"), "license")
    # A directory and those above it: src/a/b, src/a, src, and the root.
    directories = own.where("path is not null").select("directory").distinct()
    parts = F.split("directory", "/")
    depth = F.explode(F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(parts)))).alias("depth")
    above = directories.select("directory", depth).withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = above.join(holders, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", "license")).alias("near"))
    nearest = materialise(nearest.select("directory", F.col("near.license").alias("inherited"), F.col("near.above").alias("from_directory")))
    joined = own.join(small(nearest, 100_000), "directory", "left")
    mine, has_path = F.col("license").isNotNull(), F.col("path").isNotNull()
    origin = F.when(F.col("whole"), "file").when(mine, "header").when(has_path & F.col("inherited").isNotNull(), "inherited")
    inherits = ~mine & has_path
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", F.when(inherits, F.col("inherited"))).alias("license"),
        origin.alias("origin"),
        F.when(inherits, F.col("from_directory")).alias("from_directory"),
    )
