"""License scan: TF-IDF cosine to templates, then nearest-ancestor inheritance.

Every line of every text is a sparse vector over its words, weighted by the inverse
document frequency that the words of the templates have among all lines of all texts.
A header is a line, or up to ``RUN_LINES`` adjacent ones with blank lines left out: wrapped
headers are joined where each line has a fair share of template words. Signs that mark
comments are no words. A header matches the template of highest cosine if that is ``CLOSE``
or more. The whole text of a license file is compared with the whole templates too, and a
match there goes before those of its lines. A file's own license is its best match. A file without one takes the license of the nearest directory
above it that holds a license file with a match: each directory is joined with its own
ancestors by path, the deepest license wins, and files take that of their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import plainly_named, quoted, stored

CLOSE = 0.75
#: Adjacent lines of a header at most, and the share of template words in the squared length
#: of a line that may be joined with others.
RUN_LINES, LOOSE = 8, 0.25
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"

#: License name and the text of a header or of a license's first words.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "The MIT License (MIT)"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited."),
]

#: License name and the whole text of short licenses, without its copyright line.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_NO_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
WHOLE = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _NO_NAMES + _BSD_END),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
]

_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


VOCABULARY = sorted({w for _, t in TEMPLATES + WHOLE for w in words_of(t)})
_KNOWN = frozenset(VOCABULARY)


def line_counts(files: DataFrame) -> dict[str, int]:
    """How many lines hold each word of the templates, and, at '', how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for line in (text.as_py() or "").split("\n"):
                    counts[""] += 1
                    counts.update(_KNOWN.intersection(words_of(line)))
        yield pa.record_batch(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    found = files.select("text").mapInArrow(run, "word string, n bigint")
    return dict(found.groupBy("word").agg(F.sum("n")).collect())  # a row for each word


class Matcher:
    """The templates as unit vectors; a word outside them weighs as much as a new one."""

    def __init__(self, counts: dict[str, int]):
        lines = counts.get("", 0)
        self.weights = {w: math.log((1 + lines) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}
        self.new = math.log(1 + lines) + 1
        self.headers = [(name, self._unit(text)) for name, text in TEMPLATES]
        self.whole = [(name, self._unit(text)) for name, text in WHOLE]

    def _unit(self, text: str) -> dict[str, float]:
        vector = {w: n * self.weights[w] for w, n in Counter(words_of(text)).items()}
        size = math.sqrt(sum(x * x for x in vector.values()))
        return {w: x / size for w, x in vector.items()}

    def known_share(self, counted: Counter) -> float:
        """Share of template words in the squared length, an upper bound of squared cosines."""
        ours = sum((n * self.weights[w]) ** 2 for w, n in counted.items() if w in _KNOWN)
        others = sum((n * self.new) ** 2 for w, n in counted.items() if w not in _KNOWN)
        return ours / (ours + others) if ours else 0.0

    def closest(self, counted: Counter, templates: list) -> tuple[str, float] | None:
        """License and cosine of the closest template, the first of equally close ones."""
        if not _KNOWN.intersection(counted):
            return None
        vector = {w: n * self.weights.get(w, self.new) for w, n in counted.items()}
        size = math.sqrt(sum(x * x for x in vector.values()))
        name, cosine = max(
            ((name, sum(x * vector.get(w, 0.0) for w, x in t.items())) for name, t in templates),
            key=lambda m: m[1],
        )
        return name, cosine / size

    def best(self, line: str) -> tuple[str, float] | None:
        return self.closest(Counter(words_of(line)), self.headers)

    def own(self, text: str, license_file: bool, close: float) -> tuple[str | None, float | None, int | None]:
        """License, score and line of the best header, or of the whole text of a license file."""
        out: tuple[str | None, float | None, int | None] = (None, None, None)
        together: Counter = Counter()
        run: list[Counter] = []  # the counts of the runs that end at the line before
        starts: list[int] = []
        for i, line in enumerate(text.split("\n")):
            words = words_of(line)
            if not words:
                continue
            counted = Counter(words)
            if license_file:
                together.update(counted)
            share = self.known_share(counted) if _KNOWN.intersection(counted) else 0.0
            joined = [c + counted for c in run] if share >= LOOSE else []
            tried = [(i, counted, share), *((s, c, self.known_share(c)) for s, c in zip(starts, joined))]
            for start, counts, bound in tried:
                if bound >= close**2:
                    found = self.closest(counts, self.headers)
                    if found and found[1] >= close and (out[1] is None or found[1] > out[1]):
                        out = (*found, start)
            if share >= LOOSE:
                run, starts = [counted, *joined][: RUN_LINES - 1], [i, *starts][: RUN_LINES - 1]
            else:
                run, starts = [], []
        if license_file:
            found = self.closest(together, self.whole)
            if found and found[1] >= close:
                out = (*found, 0)
        return out


def matched(files: DataFrame, close: float = CLOSE) -> DataFrame:
    """``files`` without ``text``, with ``license``, ``score`` and ``line_no`` of the own license.

    The highest score wins, then the line where the run of lines that has it ends first, then
    the shorter run. A whole text counts as its first line. All three are null where nothing
    is close.
    """
    matcher = Matcher(line_counts(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            flags = columns.pop("_license_file").to_pylist()
            texts = columns.pop("text")
            found = [matcher.own(t.as_py() or "", bool(f), close) for t, f in zip(texts, flags)]
            for j, (name, kind) in enumerate((("license", pa.string()), ("score", pa.float64()), ("line_no", pa.int64()))):
                columns[name] = pa.array([f[j] for f in found], kind)
            yield pa.record_batch(list(columns.values()), list(columns))

    given = files.drop("license", "score", "line_no")
    plain = plainly_named(given)
    kept = [f for f in plain.schema if f.name != "text"]
    added = [T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("line_no", T.LongType())]
    is_file = F.col("path").rlike(LICENSE_FILE) if "path" in plain.columns else F.lit(False)
    rows = plain.withColumn("_license_file", is_file)
    out = rows.mapInArrow(run, T.StructType([*kept, *added]))
    return out.toDF(*[c for c in given.columns if c != "text"], *[f.name for f in added])


def directory(path: Column) -> Column:
    """What stands before the last slash, empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame) -> DataFrame:
    """``(dir, from_dir, license)``: for each directory, the nearest license at or above it.

    Of several license files in one directory the highest score counts, then the name.
    """
    placed = files.select(directory(F.col("path")).alias("dir"), "path", "license", "score")
    held = (
        placed.filter(F.col("path").rlike(LICENSE_FILE) & F.col("license").isNotNull())
        .groupBy("dir")
        .agg(F.max(F.struct("score", "license"))["license"].alias("license"))
        .select(F.col("dir").alias("from_dir"), "license")
    )
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")
    )
    steps = placed.select("dir").distinct().withColumn("from_dir", F.explode(F.array_distinct(above)))
    return (
        steps.join(held, "from_dir")
        .groupBy("dir")
        .agg(F.max_by(F.struct("from_dir", "license"), F.length("from_dir")).alias("nearest"))
        .select("dir", "nearest.from_dir", "nearest.license")
    )


def scan(files: DataFrame, close: float = CLOSE) -> DataFrame:
    """``files`` (``path, text`` and others), without text, with the license of each.

    Added: ``license``, ``score``, ``line_no`` of the own match, ``origin`` ('own',
    'inherited' or null) and ``from_dir`` of an inherited one. A null or empty text has
    no own license; a null path lies in no directory and inherits nothing. Repeated rows
    are files of their own. Columns of those names are replaced. An empty table gives an
    empty table.
    """
    own = stored(matched(files.drop("origin", "from_dir"), close), "own-licenses")
    theirs = inherited(own.filter("path IS NOT NULL")).select(
        F.col("dir").alias("_dir"), "from_dir", F.col("license").alias("_license")
    )
    joined = own.join(theirs, directory(F.col("path")) == F.col("_dir"), "left")
    mine = F.col("license").isNotNull()
    return joined.select(
        *[quoted(c) for c in own.columns if c not in ("license", "score", "line_no")],
        F.coalesce("license", "_license").alias("license"),
        "score",
        "line_no",
        F.when(mine, "own").when(F.col("_license").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )
