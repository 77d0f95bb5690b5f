"""Operator 3: licence notices in texts by patience alignment with templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
CORE = re.compile(r"\{([^{}]*)\}")
#: A template counts as found if at least this share of its words is aligned.
COVERAGE = 0.8
#: A window of the text is aligned: so many times the template's words at most.
SPREAD = 2
#: Templates of so many words at most that name no words in braces must be there word for word.
FEW = 12

# Notices and opening paragraphs of public licences. Words in braces tell a licence
# from its relatives and must stand in the text as they are, without a word between.
_GNU = "it under the terms of the {GNU %sGeneral Public License as published by the Free Software Foundation, either version %s} of the License, or (at your option) any later version."
NOTICES: dict[str, str] = {
    "AGPL-3.0": "This work is licensed under the {GNU Affero General Public License, version 3}.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify " + _GNU % ("Affero ", "3"),
    "AGPL-3.0-title": "{GNU Affero General Public License Version 3, 19 November 2007}",
    "Apache-2.0": "Licensed under the {Apache License, Version 2.0}.",
    "Apache-2.0-header": "Licensed under the {Apache License, Version 2.0} (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http www.apache.org licenses LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD": "Released under the {BSD License}.",
    "BSD-2-Clause": "Released under the {BSD 2-Clause License}.",
    "BSD-3-Clause": "Released under the {BSD 3-Clause License}.",
    # The opening is that of the two-clause licence too.
    "BSD-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-3.0": "Licensed under {CC BY 3.0}.",
    "CC-BY-4.0": "Licensed under {CC BY 4.0}.",
    "CC-BY-NC-4.0": "Licensed under {CC BY-NC 4.0}.",
    "CC-BY-SA-3.0": "Licensed under {CC BY-SA 3.0}.",
    "CC-BY-SA-4.0": "Licensed under {CC BY-SA 4.0}.",
    "CC0-1.0": "Licensed under {CC0 1.0}.",
    "EPL-1.0": "This work is licensed under the {Eclipse Public License, version 1.0}.",
    "EPL-1.0-header": "This program and the accompanying materials are made available under the terms of the {Eclipse Public License v1.0} which accompanies this distribution",
    "EPL-2.0": "This work is licensed under the {Eclipse Public License, version 2.0}.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the {Eclipse Public License 2.0} which is available at",
    "GPL-2.0": "This work is licensed under the {GNU General Public License, version 2}.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify " + _GNU % ("", "2"),
    "GPL-3.0": "This work is licensed under the {GNU General Public License, version 3}.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify " + _GNU % ("", "3"),
    "LGPL-2.1": "This work is licensed under the {GNU Lesser General Public License, version 2.1}.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify " + _GNU % ("Lesser ", "2.1"),
    "LGPL-3.0": "This work is licensed under the {GNU Lesser General Public License, version 3}.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify " + _GNU % ("Lesser ", "3"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the {MIT License}.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MPL-2.0": "This work is licensed under the {Mozilla Public License, version 2.0}.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Of the full texts in the folder `licenses` the words that tell each from its relatives.
TITLES: dict[str, str] = {
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "CC0-1.0": "CC0 1.0 Universal",
    "EPL-1.0": "Eclipse Public License - v 1.0",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MPL-2.0": "Mozilla Public License Version 2.0",
}


def default_templates() -> dict[str, str]:
    """The notices, and the full texts under their names with -full; read by the driver."""
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in (Path(__file__).parent / "licenses").glob("*.txt")}
    for name, title in TITLES.items():
        texts[name] = re.sub(r"[\W_]+".join(map(re.escape, WORD.findall(title))), r"{\g<0>}", texts[name], count=1, flags=re.IGNORECASE)
    return NOTICES | {f"{name}-full": text for name, text in texts.items()}


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def increasing(seq: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence of distinct numbers, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(seq)
    for i, x in enumerate(seq):
        pile = bisect_left(tops, x)
        back[i] = at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(x)
            at.append(i)
        else:
            tops[pile], at[pile] = x, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b): equal ends, anchors unique to both, then each gap in turn.

    Gaps are kept on a stack of their own, so deep nesting is no matter; a gap without an anchor
    that is unique on both sides is left unaligned.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        pairs = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in where]
        anchors = [pairs[k] for k in increasing([j for _, j in pairs])]
        found += anchors
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(found)


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], coverage: float):
        self.coverage = coverage
        self.templates = []
        for name, t in sorted(templates.items()):
            if w := words_of(t):
                core = words_of(" ".join(CORE.findall(t)))
                self.templates.append((name, w, Counter(w), core or (w if len(w) <= FEW else [])))
        self.known = {w for _, ws, _, _ in self.templates for w in ws}

    @staticmethod
    def cores(words: list[str], places: dict[str, list[int]], core: list[str]) -> list[int]:
        """Where the words of the core stand in the text without a word between."""
        return [p for p in places.get(core[0], ()) if words[p : p + len(core)] == core]

    def windows(self, words: list[str], places: dict[str, list[int]], template: list[str], need: Counter, core: list[str]) -> list[tuple[float, int, int]]:
        """(coverage, first word, word behind the last) of the best window around each place of the
        template's rarest words, where it reaches the coverage and holds the core.

        A window reaches SPREAD times the template to both sides. At most (1 - coverage) of the
        template may be missing, so among any floor((1 - coverage) * n) + 1 of its words one is
        there: the windows of that many rarest words miss no alignment that spans no more.
        """
        n = len(template)
        # No alignment can cover more than the words that are there at all.
        if len(words) < self.coverage * n or sum(min(c, len(places.get(w, ()))) for w, c in need.items()) < self.coverage * n:
            return []
        at = self.cores(words, places, core) if core else []
        if core and not at:
            return []
        spare = int((1 - self.coverage) * n + 1e-9) + 1
        rare, got = [], 0
        for w in sorted(need, key=lambda w: (len(places.get(w, ())), w)):
            rare.append(w)
            got += need[w]
            if got >= spare:
                break
        found, tried, done = [], set(), -1
        reach = SPREAD * n
        for p in sorted({p for w in rare for p in places.get(w, ())}):
            if p < done:
                continue
            # The places that the word's own places in the template give, as they stand and with room
            # for words between, then a wide window: where copies stand side by side, no word is
            # unique in the wide one.
            best = (0.0, 0, 0)
            own = [p - j for j, w in enumerate(template) if w == words[p]]
            for low, high in [*((k - m, k + n + m) for m in (0, spare) for k in own), (p - reach, p + reach)]:
                low, high = max(0, low), min(len(words), high)
                if (low, high) in tried:
                    continue
                tried.add((low, high))
                pairs = align(words[low:high], template)
                if len(pairs) >= self.coverage * n:
                    share, first, last = len(pairs) / n, low + pairs[0][0], low + pairs[-1][0] + 1
                    k = bisect_left(at, first)
                    if core and (k == len(at) or at[k] + len(core) > last):
                        continue
                    if (share, first - last) > (best[0], best[1] - best[2]):
                        best = (share, first, last)
            if best[0]:
                found.append(best)
                # Words inside a match that holds this one are not tried again; one that lies
                # elsewhere leaves them to be tried.
                if best[1] <= p < best[2]:
                    done = best[2]
        return found

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, word behind the last) of each notice found.

        Of found notices that overlap in the text the one with the most words aligned stays (so a
        whole licence comes before a notice inside it), then the one of the greatest coverage, then
        the first by name. The text between those that stay is scanned again, so a notice that
        loses one place to a better one is still found at its others. The list is ordered by
        coverage, then by the template's words, then by name.
        """
        words = words_of(text)
        kept: list[tuple[float, int, str, int, int]] = []
        todo = [(0, len(words))]
        while todo:
            start, stop = todo.pop()
            part = words[start:stop]
            places: dict[str, list[int]] = {}
            for i, w in enumerate(part):
                if w in self.known:
                    places.setdefault(w, []).append(i)
            found = [(-round(share * len(t)), -share, name, high - low, start + low, start + high) for name, t, need, core in self.templates for share, low, high in self.windows(part, places, t, need, core)]
            spans: list[tuple[int, int]] = []
            for aligned, share, name, _, low, high in sorted(set(found)):
                # The kept spans are disjoint and in order: only the neighbours can overlap.
                at = bisect_left(spans, (low, high))
                if (at == 0 or spans[at - 1][1] <= low) and (at == len(spans) or high <= spans[at][0]):
                    spans.insert(at, (low, high))
                    kept.append((share, round(aligned / share), name, low, high))
            if spans:
                todo += zip([start, *(b for _, b in spans)], [*(a for a, _ in spans), stop], strict=True)
        return [(name, -share, low, high) for share, _, name, low, high in sorted((share, -n, name, low, high) for share, n, name, low, high in kept)]


MATCHES = "array<struct<license:string,coverage:double,start:int,stop:int>>"


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Every licence notice found in each whole text, one row for each row of docs.

    Returns doc_id, n_matches (notices, each occurrence of a template counted), best (the template of the greatest coverage, then of the most words,
    then first by name; null if none), best_coverage (0 if none) and matches (an array of license,
    coverage, start and stop, in words of the text, one for each occurrence, disjoint). Null texts count as empty and match nothing;
    null and repeated doc_ids stay; further columns are not read; an empty table gives an empty
    result. templates are texts by name, in which words in braces must be matched as they stand;
    templates of at most FEW words without braces must be there word for word, others with the
    given coverage. Each text is scanned where it lies; nothing is shuffled or sampled.
    """
    chosen = dict(default_templates() if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, coverage)
        for batch in batches:
            found = [scanner.scan(t.as_py() or "") for t in batch.column(1)]
            best = [f[0] if f else None for f in found]
            kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([b and b[0] for b in best], pa.string()),
                    pa.array([b[1] if b else 0.0 for b in best], pa.float64()),
                    pa.array([[dict(zip(("license", "coverage", "start", "stop"), m, strict=True)) for m in f] for f in found], kind),
                ],
                ["doc_id", "n_matches", "best", "best_coverage", "matches"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id long, n_matches int, best string, best_coverage double, matches {MATCHES}")
