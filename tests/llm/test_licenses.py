"""License scan against a plain walk up the directories."""

import math
import random
import re
import textwrap
from collections import Counter

from millrace.llm import licenses as lic

SCHEMA = "doc_id bigint, path string, text string, license string, dir string"
MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def files():
    rng = random.Random(6)
    out = []
    for i in range(300):
        folder = "/".join(rng.choice("ab") for _ in range(rng.randint(0, 4)))
        name = "LICENSE" if rng.random() < 0.15 else f"f{i}.txt"
        lines = [" ".join(rng.choice("the of under work use words that say little".split()) for _ in range(rng.randint(1, 30))) for _ in range(3)]
        if name == "LICENSE" or rng.random() < 0.2:
            lines.insert(rng.randrange(3), rng.choice([MIT, APACHE, "Licensed under CC BY-NC 4.0.", "all RIGHTS reserved"]))
        out.append((i, f"{folder}/{name}" if folder else name, "\n".join(lines)))
    return out + [(900, None, MIT), (901, "x/y.txt", None), (902, "", ""), (903, "a/z.txt", "word " * 100_000), (None, "b/n.txt", MIT), out[0]]


def plain(rows):
    counts = Counter()
    for _, _, text in rows:
        for line in (text or "").split("\n"):
            counts[""] += 1
            counts.update(set(lic.words_of(line)) & set(lic.VOCABULARY))
    matcher = lic.Matcher(counts)
    own = []
    for _, _, text in rows:
        found = [(m[1], -i, m[0]) for i, line in enumerate((text or "").split("\n")) if (m := matcher.best(line)) and m[1] >= lic.CLOSE]
        own.append(max(found, key=lambda f: f[:2]) if found else None)
    held = {}
    for (_, path, _), o in zip(rows, own):
        if o and path is not None and path.rsplit("/", 1)[-1] == "LICENSE":
            folder = path.rpartition("/")[0]
            held[folder] = max(held.get(folder, (0, "")), (o[0], o[2]))
    out = []
    for (i, path, _), o in zip(rows, own):
        row = (o[2], "own", None) if o else (None, None, None)
        if not o and path is not None:
            folder = path.rpartition("/")[0]
            while True:
                if folder in held:
                    row = (held[folder][1], "inherited", folder)
                    break
                if not folder:
                    break
                folder = folder.rpartition("/")[0]
        out.append((str(i), str(path), *row))
    return sorted(out, key=str)


def test_equals_plain_walk(spark):
    rows = files()
    frame = spark.createDataFrame([(i, p, t, "old", "x") for i, p, t in rows], SCHEMA)
    out = lic.scan(frame)
    assert "text" not in out.columns and "dir" in out.columns
    got = [(str(r.doc_id), str(r.path), r.license, r.origin, r.from_dir) for r in out.collect()]
    assert sorted(got, key=str) == plain(rows)


def test_close_lines_and_others(spark):
    lines = [MIT, "Released under the MIT license", "This work is licensed under the GNU General Public License, version 2.", "they released the prisoners under the law of the work"]
    frame = spark.createDataFrame([(i, f"p/{i}", t, None, None) for i, t in enumerate(lines)], SCHEMA)
    got = {r.doc_id: r.license for r in lic.scan(frame).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "GPL-2.0", 3: None}


def test_empty_table(spark):
    assert lic.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def cosine(a, b, counts):
    """Of two texts, from the definition alone."""
    lines = counts[""]
    weight = lambda w: math.log((1 + lines) / (1 + counts[w])) + 1 if w in lic.VOCABULARY else math.log(1 + lines) + 1
    x, y = ({w: n * weight(w) for w, n in Counter(re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", t.lower())).items()} for t in (a, b))
    size = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(w, 0) for w, v in x.items()) / size if size else 0.0


WRAPPED = {
    "GPL-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "GPL-2.0": """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.""",
    "Apache-2.0": """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including""",
    "AGPL-3.0": "/* SPDX-License-Identifier: AGPL-3.0-only */",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this""",
}


def test_wrapped_headers_and_whole_files(spark):
    code = "def value():\n    return the_sum_of_all(things)\n" * 30
    rows = [(i, f"src/{i}.py", f"{code}\n{text}\n\n{code}") for i, text in enumerate(WRAPPED.values())]
    whole = dict(lic.WHOLE)
    for k, name in enumerate(whole):
        text = f"Copyright (c) 2020 Some One\n\n{textwrap.fill(whole[name], 72)}\n"
        rows += [(100 + k, f"lib{k}/LICENSE", text), (200 + k, f"lib{k}/deep/er/code.py", code)]
    rows += [(300, "gpl/COPYING", "   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n" + code)]
    rows += [(301, "gpl/a/b.py", code), (302, "other/c.py", code)]
    frame = spark.createDataFrame([(*r, None, "`") for r in rows], "doc_id bigint, path string, text string, license string, `a``b` string")
    out = lic.scan(frame).collect()
    got = {r.doc_id: (r.license, r.origin) for r in out}
    assert [got[i] for i in range(len(WRAPPED))] == [(name, "own") for name in WRAPPED]
    assert [got[100 + k] for k in range(len(whole))] == [(name, "own") for name in whole]
    assert [got[200 + k] for k in range(len(whole))] == [(name, "inherited") for name in whole]
    assert (got[300], got[301], got[302]) == (("GPL-3.0", "own"), ("GPL-3.0", "inherited"), (None, None))
    # The scores are the cosines of the best runs of lines, or of whole license files.
    counts = Counter()
    for _, _, text in rows:
        for line in text.split("\n"):
            counts[""] += 1
            counts.update(set(re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", line.lower())))
    for r in out:
        if r.origin == "own" and r.doc_id != 300:
            text = next(t for i, _, t in rows if i == r.doc_id)
            lines = [x for x in text.split("\n") if x.strip()]
            runs = [" ".join(lines[i : i + n]) for i in range(len(lines)) for n in range(1, lic.RUN_LINES + 1)]
            tried = [(text, t) for _, t in lic.WHOLE] if r.doc_id >= 100 else [(x, t) for x in set(runs) if re.search("licen|perm|redis|mozilla", x.lower()) for _, t in lic.TEMPLATES]
            assert abs(max(cosine(x, t, counts) for x, t in tried) - r.score) < 1e-9
