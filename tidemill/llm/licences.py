"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

A passage is any run of words with a cue, across line ends, up to the size of the longest template (24 words at least),
or, in a licence file, any window of a template's length, half overlapping the next. Its words and word pairs are weighted by their rarity among the templates; unknown ones weigh as the rarest, so prose
that only mentions a licence stays far from all templates. A file without a header of its own takes the licence of
the licence file in the nearest directory above it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sinks.layers import store

THRESHOLD = 0.55
AROUND = 24

#: Usual statements and first sentences of common licences (fixed values).
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-or-later", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0"],
    "ISC": ["Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "SPDX-License-Identifier: ISC"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has dedicated this work to the public domain under CC0.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}

_CUES = ("licen[cs]", "spdx", "permission is hereby", "permission to use copy", "public domain", "under cc", "free software", "redistribution and use", "under the terms")
_CUE = re.compile("|".join(_CUES))  # in the words of a text with one blank between them
#: Texts that can hold a cue, by a fast search that never misses one.
_MAYBE_CUE = "(?i)" + "|".join(c.replace(" ", r"(?:[^a-z0-9]|\x{17F})+") for c in _CUES)
_FILE = re.compile(r"(?i)(^|/)(un)?licen[cs]e[^/]*$|(^|/)copying[^/]*$")
_TERM = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")


def terms(words: list[str]) -> Counter:
    return Counter(words) + Counter(zip(words, words[1:]))


def words_of(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Templates:
    """Weighted templates with an index from terms to templates: a passage meets only those that share a term."""

    def __init__(self, templates: dict[str, list[str]]):
        given = [(name, words_of(text)) for name, texts in sorted(templates.items()) for text in texts]
        bags = [(name, terms(words)) for name, words in given]
        self.sizes = sorted({max(1, len(words)) for _, words in given})
        self.reach = max([AROUND, *self.sizes])
        used = Counter(t for _, bag in bags for t in bag)
        self.weight = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in used.items()}
        self.unknown = math.log(1 + len(bags)) + 1
        self.names = [name for name, _ in bags]
        self.index: dict = {}
        for i, (_, bag) in enumerate(bags):
            vector = {t: (1 + math.log(n)) * self.weight[t] for t, n in bag.items()}
            norm = math.sqrt(sum(v * v for v in vector.values()))
            for t, v in vector.items():
                self.index.setdefault(t, []).append((i, v / norm))

    def best(self, words: list[str]) -> tuple[float, str]:
        """Cosine and name of the nearest template; the first name of equals."""
        vector = {t: (1 + math.log(n)) * self.weight.get(t, self.unknown) for t, n in terms(words).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        near: dict[int, float] = {}
        for t, v in vector.items():
            for i, w in self.index.get(t, ()):
                near[i] = near.get(i, 0.0) + v * w / norm
        if not near:
            return 0.0, ""
        top = max(near, key=lambda i: (round(near[i], 9), -i))
        return min(near[top], 1.0), self.names[top]

    def best_window(self, words: list[str]) -> tuple[float, str]:
        """The best of all windows of a template's length, each half overlapping the next, from the first word to the last."""
        found = (0.0, "")
        for size in self.sizes:
            step = max(1, size // 2)
            for start in range(0, max(1, len(words) - size + step), step):
                found = max(found, self.best(words[start : start + size]), key=lambda x: x[0])
        return found

    def nearest(self, words: list[str]) -> list[str]:
        """The run of up to ``reach`` words with a cue that comes nearest to a template; none without a cue.

        Runs grow word by word from each start, so all of them are compared. A run that begins with a word of no
        template before its cue is farther from every template than the run after that word, and is left out.
        """
        cues, most, run = cue_places(words), 0.0, []
        steps = [1.0] + [math.log(n + 1) - math.log(n) for n in range(1, self.reach + 1)]
        squares = [1.0] + [(1 + math.log(n + 1)) ** 2 - (1 + math.log(n)) ** 2 for n in range(1, self.reach + 1)]
        first = 0
        for cue in cues:
            for start in range(max(first, cue - self.reach + 1), cue + 1):
                if start < cue and words[start] not in self.index:
                    continue
                counts: dict = {}
                near: dict[int, float] = {}
                norm = 0.0
                for at in range(start, min(start + self.reach, len(words))):
                    changed: list[int] = []
                    for t in (words[at],) if at == start else (words[at], (words[at - 1], words[at])):
                        n = counts.get(t, 0)
                        counts[t] = n + 1
                        weight = self.weight.get(t, self.unknown)
                        norm += squares[n] * weight * weight
                        for i, w in self.index.get(t, ()):
                            near[i] = near.get(i, 0.0) + steps[n] * weight * w
                            changed.append(i)
                    if at >= cue:
                        for i in near if at == cue else changed:  # a template that gains nothing only falls back
                            if near[i] * near[i] > most * norm * (1 + 1e-12):
                                most, run = near[i] * near[i] / norm, words[start : at + 1]
            first = cue + 1
        return run


def cue_places(words: list[str]) -> list[int]:
    """The words in which a cue begins, in order."""
    ends = list(accumulate((len(w) + 1 for w in words)))
    return sorted({bisect_right(ends, m.start()) for m in _CUE.finditer(" ".join(words))})


def scan_licences(docs: DataFrame, path: str = "path", text: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``license``, ``similarity``, ``how`` (``header``, ``file``, ``inherited`` or ``none``) and ``from_dir`` to each row.

    ``header``: the best passage of the text, of all there are, comes within ``threshold`` of a template. ``file``: the row is a licence
    file by name, and its windows are compared too, from its first word to its last; it speaks for its directory. Rows without either inherit from the nearest
    directory at or above their own that has a licence file (of several, the least name); ``from_dir`` is that
    directory. Null or empty texts have no header; a null path has no directory and inherits nothing. Repeated rows
    stay. Columns with the new names are replaced. An empty table gives an empty one.
    """
    new = ("license", "similarity", "how", "from_dir")
    names = [c for c in docs.columns if c not in new and c != text]
    known = Templates(templates or TEMPLATES)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kept = [f"_c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(names, kept)], F.col(path).alias("_path"), F.col(text).alias("_text"))
    schema = T.StructType([*rows.select(*kept, "_path").schema, T.StructField("_license", T.StringType()), T.StructField("_similarity", T.DoubleType()), T.StructField("_file", T.BooleanType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("_text"), "")
            cued = pc.match_substring_regex(texts, _MAYBE_CUE).to_pylist()
            found: list[tuple[str | None, float, bool]] = []
            for i, place in enumerate(batch.column("_path").to_pylist()):
                file = bool(place and _FILE.search(place))
                best = (0.0, "")
                if file or cued[i]:
                    body = texts[i].as_py()
                    words = words_of(body)
                    best = shared.value.best(shared.value.nearest(words))
                    if file:
                        best = max(best, shared.value.best_window(words), key=lambda x: x[0])
                found.append((best[1] if best[0] >= threshold else None, best[0], file))
            license, similarity, file = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in [*kept, "_path"]], pa.array(license, pa.string()), pa.array(similarity, pa.float64()), pa.array(file, pa.bool_())],
                names=[*kept, "_path", "_license", "_similarity", "_file"],
            )

    scanned = store(rows.mapInArrow(scan, schema), "licences").withColumn("_dir", F.regexp_replace("_path", "/?[^/]*$", ""))
    declared = scanned.filter(F.col("_file") & F.col("_license").isNotNull() & F.col("_dir").isNotNull()).groupBy(F.col("_dir").alias("up"))
    declared = declared.agg(F.min("_license").alias("_given"))
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, 1, n)))
    folders = scanned.filter(F.col("_license").isNull() & F.col("_dir").isNotNull()).select("_dir").distinct()
    chain = folders.select("_dir", F.explode(F.array_distinct(F.concat(above, F.array("_dir")))).alias("up"))
    nearest = chain.join(declared, "up").groupBy("_dir").agg(F.max_by(F.struct("_given", "up"), F.length("up")).alias("near"))
    joined = scanned.join(nearest, "_dir", "left")
    license = F.coalesce("_license", "near._given")
    how = F.when(F.col("_license").isNotNull(), F.when(F.col("_file"), "file").otherwise("header")).when(F.col("near").isNotNull(), "inherited").otherwise("none")
    from_dir = F.when(F.col("_license").isNull(), F.col("near.up"))
    return joined.select(*[F.col(k).alias(c) for k, c in zip(kept, names)], license.alias("license"), F.col("_similarity").alias("similarity"), how.alias("how"), from_dir.alias("from_dir"))
