"""License scan: TF-IDF cosine to license templates, inherited down directories.

There are two sets of templates: ``TEMPLATES``, the short notices and headers that
files carry, and the whole license texts of the folder ``license_texts``. Words
are runs of letters and digits (A-Z folded); a word's weight is its inverse
document frequency among the templates of its set, and a word that no template
has weighs as the rarest. Passages are compared with templates by the cosine of
sparse TF-IDF vectors, computed from the template words they have.

* Headers: the passages are every line, and every window of as many consecutive
  words as a notice has, from every word that the notice has too. A notice is found
  wrapped over lines, inside a longer line or between sentences; comment markers
  don't count (signs are no words, and the words of ``MARKERS`` are left out at
  line starts). The best passage at ``HEADER`` or above gives a file its own
  license. The opening that the BSD licenses share (``OPENING``) says "BSD" where
  nothing else is found.
* License files: whole texts, without lines that name a copyright holder, are
  compared with notices and whole license texts. A
  text at ``FILE`` or above is a license file of its directory; a file without an
  own license inherits from the nearest directory above it that has one.

Windows are first bounded from above: the dot product is a difference of running
sums, and the squared length is at least the sum of squared weights. Only windows
whose bound passes, best bounds first, are compared exactly.

Inheritance is a join of paths: the distinct directories of the files, with each
of their ancestors, meet the directories of license files, and the deepest
wins. Files join their directory only, so a directory with a third of all
files is one row of the other side.

Defined results: null and empty texts have no license of their own; a null path
has no directory and inherits nothing; ties go to the template that comes first;
of several license files in one directory the best match counts, then the first
license by name; repeated rows are separate files; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import FOLDED_WORD_BYTES, Block, slices, span_hashes, stored

HEADER = 0.75
FILE = 0.75

# The usual short notices and headers of these licenses.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""),
]
OPENING = [("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met")]
MARKERS = ["rem", "dnl", "c"]
WINDOWS_AT_ONCE, WORDS_AT_ONCE = 4096, 1 << 19


def license_texts() -> list[tuple[str, str]]:
    """(name, whole text) of the folder ``license_texts``; read on the driver. The AGPL-3.0
    is the GPL-3.0 with its own name in place of the GPL's."""
    files = sorted((f for f in resources.files("snapfeed.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    texts = [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files]
    gpl = dict(texts)["GPL-3.0"]
    agpl = re.sub("GNU(\\s+)GENERAL PUBLIC LICENSE", r"GNU\1AFFERO GENERAL PUBLIC LICENSE", gpl)
    return [*texts, ("AGPL-3.0", re.sub("GNU(\\s+)General(\\s+)Public(\\s+)License", r"GNU\1Affero General\2Public\3License", agpl))]

GAPS = np.ones(256, dtype=bool)
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
WORD_TABLE = np.where(GAPS, np.uint64(0), FOLDED_WORD_BYTES)


def words_of(texts: list[str]) -> tuple[Block, np.ndarray]:
    block = Block(pa.array(texts, pa.string()), GAPS)
    return block, span_hashes(block.buf, WORD_TABLE, block.starts)


def holder_lines(buf: np.ndarray, starts: np.ndarray, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """First words of lines that only name a holder: "Copyright" with a year or sign, "All rights"."""
    copyright, c, everything, rights = words_of(["copyright c all rights"])[1]
    begin = np.flatnonzero(first[:-1])
    one, two, byte = hashes[begin], hashes[begin + 1], buf[starts[begin + 1]]
    signed = (two == c) | (byte >= 128) | (byte >= 48) & (byte <= 57)
    return begin[(one == copyright) & signed | (one == everything) & (two == rights)]


class Templates:
    """Template vectors over the sorted template vocabulary."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        block, hashes = words_of([t for _, t in templates])
        each = [Counter(hashes[a:b].tolist()) for a, b in zip(block.first[:-1], block.first[1:], strict=True)]
        self.lengths = block.counts
        seen = Counter(w for c in each for w in c)
        self.vocabulary = np.array(sorted(seen), dtype=np.uint64)
        n = len(templates)
        self.idf = np.log((1 + n) / (1 + np.array([seen[int(w)] for w in self.vocabulary]))) + 1
        self.unknown = np.log(1 + n) + 1
        self.matrix = np.zeros((len(self.vocabulary), n))
        for j, c in enumerate(each):
            for w, k in c.items():
                i = int(np.searchsorted(self.vocabulary, np.uint64(w)))
                self.matrix[i, j] = k * self.idf[i]
        self.matrix /= np.maximum(np.sqrt((self.matrix ** 2).sum(0)), 1e-300)

    def best(self, group: np.ndarray, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best template and cosine of each of ``n`` passages; ``group``: the passage of each word."""
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        known = self.vocabulary[place] == hashes
        # term counts of (passage, known word) and of unknown words, each by sorting
        top = len(self.vocabulary)
        key, count = np.unique(group[known] * top + place[known], return_counts=True)
        at, word = key // top, key % top
        weight = count * self.idf[word]
        square = np.bincount(at, weights=weight ** 2, minlength=n)
        which, cosine = np.zeros(n, dtype=np.int64), np.zeros(n)
        # passages that could reach a template: most of their squared length is known words
        rest = np.bincount(group[~known], minlength=n) * self.unknown ** 2  # at least this, if no unknown word repeats
        able = np.flatnonzero((square > 0) & (square >= 0.25 * rest))
        if not len(able):
            return which, cosine
        mine = np.isin(group, able) & ~known
        order = np.lexsort((hashes[mine], group[mine]))
        g, h = group[mine][order], hashes[mine][order]
        new = np.ones(len(g), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(g)))
        unknown = np.bincount(g[starts], weights=(times * self.unknown) ** 2, minlength=n)
        local = np.full(n, -1)
        local[able] = np.arange(len(able))
        take = local[at] >= 0
        row, word, weight = local[at[take]], word[take], weight[take]
        length = np.sqrt(square[able] + unknown[able])
        scores = np.stack([np.bincount(row, weights=weight * self.matrix[word, j], minlength=len(able)) for j in range(len(self.names))], axis=1)
        scores /= length[:, None]
        which[able], cosine[able] = scores.argmax(1), scores.max(1)
        return which, cosine

    def windows(self, doc: np.ndarray, n: int, hashes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Best template and cosine of the windows of each of ``n`` documents, for those
        that have a window at ``least`` or above (-1 and 0: none). ``doc``: of each word, ascending."""
        which, cosine = np.full(n, -1), np.zeros(n)
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        known = self.vocabulary[place] == hashes
        squares = np.concatenate([[0.0], np.cumsum(np.where(known, self.idf[place], self.unknown) ** 2)])
        stop = np.searchsorted(doc, doc, side="right")
        # running sums over known words only; ``before``: known words before a word
        at, before = np.flatnonzero(known), np.concatenate([[0], np.cumsum(known)])
        place = place[at]
        found = []
        for j, size in enumerate(self.lengths.tolist()):
            value = (self.idf * self.matrix[:, j])[place]
            dots = np.concatenate([[0.0], np.cumsum(value)])
            start = np.flatnonzero(value)
            begin = at[start]
            end = np.minimum(begin + size, stop[begin])
            dot, square = dots[before[end]] - dots[start], squares[end] - squares[begin]
            take = np.flatnonzero(dot * dot >= (least * least - 1e-9) * square)
            bound = np.minimum(dot[take] / np.sqrt(square[take]), 1)
            found.append((begin[take], end[take], bound, np.full(len(take), j)))
        begin, end, bound, of = (np.concatenate(f) for f in zip(*found, strict=True))
        owner = doc[begin]
        order = np.lexsort((begin, of, -bound, owner))
        begin, end, bound, owner = begin[order], end[order], bound[order], owner[order]
        few = 2
        while len(begin):
            # the best few bounds of each document, then more of what can still beat its best
            few *= 2
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            now = np.flatnonzero(rank < few)[:WINDOWS_AT_ONCE]
            now = now[:max(1, int(np.searchsorted(np.cumsum(end[now] - begin[now]), WORDS_AT_ONCE)))]
            size = end[now] - begin[now]
            group = np.repeat(np.arange(len(now)), size)
            words = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[now], size)
            template, score = self.best(group, len(now), hashes[words])
            score = np.round(score, 12)
            best = np.lexsort((template, -score, owner[now]))
            best = best[np.append(True, owner[now][best][1:] != owner[now][best][:-1])]
            mine = owner[now][best]
            better = (score[best] >= least) & (score[best] > cosine[mine])
            which[mine[better]], cosine[mine[better]] = template[best][better], score[best][better]
            left = np.ones(len(begin), dtype=bool)
            left[now] = False
            left &= bound > cosine[owner]
            begin, end, bound, owner = begin[left], end[left], bound[left], owner[left]
        return which, cosine


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, keep: tuple[str, ...] = ("path",), whole: list[tuple[str, str]] | None = None) -> DataFrame:
    """``keep`` columns and per file: own license (best line or window), its cosine, and
    the license and cosine of the whole text. ``whole``: license texts (None: ``license_texts``)."""
    kinds = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    known, opening = Templates(templates), Templates(OPENING)
    texts = Templates([*templates, *OPENING, *(license_texts() if whole is None else whole)])
    markers = words_of(MARKERS)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                block = Block(part.column("text"), GAPS)
                hashes = span_hashes(block.buf, WORD_TABLE, block.starts)
                doc = block.doc
                lines = np.searchsorted(np.sort(np.concatenate([np.flatnonzero(block.buf == 10), block.offsets[1:-1]])), block.starts, side="right")
                which, cosine = known.best(lines, int(lines.max(initial=-1)) + 1, hashes)
                owner = np.zeros(len(which), dtype=np.int64)
                owner[lines] = doc
                best = np.zeros(block.n)
                np.maximum.at(best, owner, cosine)
                own = np.full(block.n, -1)
                hits = np.flatnonzero((cosine >= HEADER) & (cosine == best[owner]))[::-1]
                own[owner[hits]] = which[hits]
                first = np.append(True, lines[1:] != lines[:-1])[:len(lines)]
                says = ~(first & np.isin(hashes, markers))
                near, near_cosine = known.windows(doc[says], block.n, hashes[says], HEADER)
                better = near_cosine > best
                own[better], best[better] = near[better], near_cosine[better]
                names = [known.names[i] if i >= 0 else None for i in own]
                open_which, open_cosine = opening.windows(doc[says], block.n, hashes[says], HEADER)
                for i in np.flatnonzero((own < 0) & (open_which >= 0)):
                    names[i], best[i] = opening.names[open_which[i]], open_cosine[i]
                told = ~np.isin(lines, lines[holder_lines(block.buf, block.starts, first, hashes)])
                file_which, file_cosine = texts.best(doc[told], block.n, hashes[told])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(best),
                     pa.array([texts.names[i] if c >= FILE else None for i, c in zip(file_which, file_cosine, strict=True)], pa.string()), pa.array(file_cosine)],
                    [*keep, "own_license", "cosine", "file_license", "file_cosine"])

    return files.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{kinds}, own_license string, cosine double, file_license string, file_cosine double")


def inherit(scanned: DataFrame) -> DataFrame:
    """Adds license, how (header, file, inherited, none) and from_dir."""
    scanned = stored(scanned.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)), "scanned")
    offered = scanned.where("file_license is not null and dir is not null").groupBy(F.col("dir").alias("at"))
    offered = offered.agg(F.min(F.struct((-F.col("file_cosine")).alias("worse"), "file_license")).alias("best"))
    offered = offered.select("at", F.col("best.file_license").alias("offered"))
    dirs = scanned.where("dir is not null").select(F.col("dir").alias("of")).distinct()
    above = dirs.withColumn("steps", F.split("of", "/")).select("of", F.explode(F.sequence(F.lit(1), F.size("steps"))).alias("depth"), "steps")
    above = above.select("of", "depth", F.array_join(F.slice("steps", F.lit(1), F.col("depth")), "/").alias("at"))
    nearest = above.join(offered, "at").groupBy("of").agg(F.max_by(F.struct("at", "offered"), "depth").alias("near"))
    rows = scanned.join(nearest, F.col("dir") == F.col("of"), "left")
    own, whole, near = F.col("own_license"), F.col("file_license"), F.col("near.offered")
    how = F.when(whole.isNotNull(), "file").when(own.isNotNull(), "header").when(near.isNotNull(), "inherited").otherwise("none")
    rows = rows.withColumns({"license": F.coalesce(whole, own, near), "how": how})
    return rows.withColumn("from_dir", F.when(F.col("how") == "inherited", F.col("near.at"))).drop("near", "of", "dir")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files source/language/doc_id (unknown parts: "unknown")."""
    part = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("unknown")), "/", "_")
    return docs.select("doc_id", F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"), F.col("text").cast("string").alias("text"))
