"""Licence texts inside documents, by the Dice coefficient of word bigrams with templates.

Text is lower-cased and cut into words of letters and digits. A passage is a stretch of words
between two bigrams of a template; its Dice coefficient with the template is twice the number
of shared distinct bigrams over the sum of both numbers of distinct bigrams. Sizes bound it: a
passage whose number of distinct bigrams is outside [t / (2 - t), (2 - t) / t] times the template's
can't reach t, nor can a template of which the text has too few bigrams at all, so most templates
are never compared. Of templates that match one stretch, the one that shares most bigrams counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.wordcache import text_groups

THRESHOLD = 0.8

_GNU = (
    "This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind}General "
    "Public License as published by the Free Software Foundation{either} version {version} of the License, or (at your "
    "option) any later version."
)
_CC = "This work is licensed under a Creative Commons {kind} 4.0 International License."
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
# Public licence notices, in their customary wording.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-2.0", _GNU.format(what="program", colon=";", kind="", either="; either", version="2")),
    ("GPL-3.0", _GNU.format(what="program", colon=":", kind="", either=", either", version="3")),
    ("LGPL-2.1", _GNU.format(what="library", colon=";", kind="Lesser ", either="; either", version="2.1")),
    ("LGPL-3.0", _GNU.format(what="program", colon=":", kind="Lesser ", either=", either", version="3")),
    ("AGPL-3.0", _GNU.format(what="program", colon=":", kind="Affero ", either=", either", version="3")),
    ("CC-BY-4.0", _CC.format(kind="Attribution")),
    ("CC-BY-SA-4.0", _CC.format(kind="Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", _CC.format(kind="Attribution-NonCommercial")),
    ("CC-BY-ND-4.0", _CC.format(kind="Attribution-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", _CC.format(kind="Attribution-NonCommercial-ShareAlike")),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission."),
    ("BSD", _BSD.partition(": ")[0]),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# How a licence is named in one sentence.
NAMES = [
    ("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0"]),
    ("MIT", ["MIT License"]),
    ("GPL-2.0", ["GNU General Public License, version 2", "GNU GPL v2"]),
    ("GPL-3.0", ["GNU General Public License, version 3", "GNU GPL v3"]),
    ("LGPL-2.1", ["GNU Lesser General Public License, version 2.1"]),
    ("LGPL-3.0", ["GNU Lesser General Public License, version 3"]),
    ("AGPL-3.0", ["GNU Affero General Public License, version 3"]),
    ("MPL-2.0", ["Mozilla Public License, version 2.0"]),
    ("EPL-2.0", ["Eclipse Public License, version 2.0"]),
    ("BSD-2-Clause", ["BSD 2-Clause License"]),
    ("BSD-3-Clause", ["BSD 3-Clause License"]),
    ("ISC", ["ISC License"]),
    ("CC0-1.0", ["CC0 1.0"]),
    ("CC-BY-4.0", ["CC BY 4.0"]),
    ("CC-BY-SA-4.0", ["CC BY-SA 4.0"]),
    ("CC-BY-NC-4.0", ["CC BY-NC 4.0"]),
    ("CC-BY-ND-4.0", ["CC BY-ND 4.0"]),
    ("CC-BY-NC-SA-4.0", ["CC BY-NC-SA 4.0"]),
]
LEADS = [f"{subject}{verb} under {article}" for subject in ("", "this work is ", "this software is ")
         for verb in ("licensed", "released", "distributed", "available") for article in ("", "the ", "the terms of the ")]
# (licence, template): whole notices, and every sentence that names a licence.
TEMPLATES = NOTICES + [(licence, lead + name) for licence, names in NAMES for name in names for lead in LEADS]

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.ids: dict[bytes, int] = {}
        listed: dict[tuple[str, frozenset], None] = {}
        for name, text in templates:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text.encode())]
            if len(w) > 1:  # a template without a bigram can't be found
                listed[name, frozenset(zip(w, w[1:]))] = None
        self.base = len(self.ids) + 1
        self.names = [name for name, _ in listed]
        self.sets = [np.array(sorted(a * self.base + b for a, b in grams), np.int64) for _, grams in listed]
        self.grams = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.int64)
        self.number = np.full(self.base**2, -1, np.int32)
        self.number[self.grams] = np.arange(len(self.grams))
        self.has = np.array([np.isin(self.grams, s) for s in self.sets], np.int32).reshape(len(self.sets), len(self.grams))
        t = threshold
        self.least = np.array([max(1, int(np.ceil(t / (2 - t) * len(s) - 1e-9))) for s in self.sets])
        self.most = [int((2 - t) / t * len(s) + 1e-9) for s in self.sets]

    def scan(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """Licence, first and last word (exclusive) and coefficient of each passage found, in order.

        Passages don't overlap: the one that shares most bigrams with its template comes first, then the
        better coefficient, the earlier, the shorter, the licence in the alphabet.
        """
        words = words_of(text)
        get = self.ids.get
        w = np.fromiter((get(x, 0) for x in words), np.int64, len(words))
        known = self.number[w[:-1] * self.base + w[1:]]  # 0 is no word of a template, so no bigram with it is known
        at = np.flatnonzero(known >= 0)
        if not len(at):
            return []
        present = np.unique(known[at])
        wanted = np.flatnonzero(self.has[:, present].sum(1) >= self.least)
        if not len(wanted):
            return []
        # every other word has a number of its own too, so that bigrams are counted for what they are
        first, last = int(at[0]), int(at[-1])
        local: dict[bytes, int] = {}
        full = w[first : last + 2].copy()
        for i in np.flatnonzero(full == 0).tolist():
            full[i] = local.setdefault(words[first + i], self.base + len(local))
        pair = np.unique(full[:-1] * (self.base + len(local)) + full[1:], return_inverse=True)[1]
        following = next_same(pair)
        found = []
        for k in wanted.tolist():
            hits = at[self.has[k, known[at]] > 0] - first
            found += [(n, d, a + first, b + first, self.names[k])
                      for n, d, a, b in self.passages(pair, following, hits, len(self.sets[k]), int(self.least[k]), self.most[k])]
        taken, out = np.zeros(len(words), bool), []
        for _, d, a, b, name in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[3], f[4])):
            if not taken[a:b].any():
                taken[a:b] = True
                out.append((name, a, b, d))
        return sorted(out, key=lambda r: r[1])

    def passages(
        self, pair: np.ndarray, following: np.ndarray, hits: np.ndarray, size: int, least: int, most: int,
    ) -> list[tuple[int, float, int, int]]:
        """Shared bigrams, coefficient and place of all stretches that may be chosen for one template.

        From a start only those ends count at which one more bigram of the template comes in: an end
        further on has no better coefficient and overlaps. So there are as many ends as the template has bigrams
        at most, however long a text is and however often it repeats itself.
        """
        found = []
        first = np.ones(len(pair), np.int8)  # 1 where a bigram occurs first, seen from the start at hand
        done = len(pair)
        ends: dict[int, int] = {}  # bigram of the template -> where it occurs first
        for start in hits[::-1].tolist():
            again = following[start:done]
            first[again[again < len(pair)]] = 0
            done = start
            ends[int(pair[start])] = start
            stops = np.sort(np.fromiter(ends.values(), np.int64, len(ends)))
            seen, total, at = [], 0, start
            while len(seen) < len(stops) and total <= most:  # block by block, until there are too many bigrams
                upto = min(at + _LOOK, int(stops[-1]) + 1)
                so_far = total + np.cumsum(first[at:upto], dtype=np.int64)
                here = stops[len(seen) : np.searchsorted(stops, upto)]
                seen += so_far[here - at].tolist()
                at, total = upto, int(so_far[-1])
            inner, both = np.arange(1, len(seen) + 1), size + np.array(seen)
            for i in np.flatnonzero((inner >= least) & (2 * inner >= self.threshold * both)).tolist():
                found.append((i + 1, 2 * (i + 1) / int(both[i]), start, int(stops[i]) + 2))
        return found


_LOOK = 256


def next_same(values: np.ndarray) -> np.ndarray:
    """For each place the next one of the same value, or the length."""
    order = np.argsort(values, kind="stable")
    out = np.full(len(values), len(values), np.int64)
    same = values[order[1:]] == values[order[:-1]]
    out[order[:-1][same]] = order[1:][same]
    return out


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, license, first_word, last_word (exclusive), dice: a row per passage found.

    `templates`: (licence, text), several to a licence if need be. Words are numbered from 0. Passages of a
    text don't overlap. Null and empty texts, and templates of fewer than two words, have
    no rows. Repeated rows are scanned each. Only the id and the text column are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch, texts in text_groups(batches, "text"):
            rows = [(i, *r) for i, t in enumerate(texts) for r in scanner.scan(t)]
            owner, name, a, b, d = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(owner, pa.int64())), pa.array(name, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.float64())],
                ["id", "license", "first_word", "last_word", "dice"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, license string, first_word long, last_word long, dice double")
    return out.withColumnRenamed("id", id_col)


@query("op8_license_scan")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Licence passages of all documents."""
    return scan_licenses(table(spark, folder, "documents", "doc_id", "text"))
