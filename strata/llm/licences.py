"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Units are single lines, and paragraphs: lines joined up to a line without a word (blank, or a comment's frame), as
notices are wrapped. A softmax regression over hashed word n-grams (1 to 3 words) tells licence families from
``unknown``. It is trained on variants of the templates below and on a bounded sample of the corpus'
own paragraphs as unknowns; its probabilities are calibrated on held-out variants by a temperature, and
the threshold of a licence by the held-out unknowns. A paragraph that it names is confirmed if enough of
a template's word pairs occur in it; in a paragraph, the lines that hold them are the notice.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BASE, LOWER, PUNCT, U64, buffers, mix64, pick, pieces, prefix_hash, span_hash, table, words

# Licence families and how their notices read.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "Released under the Apache 2.0 License", "SPDX-License-Identifier: Apache-2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Released under the BSD 3-Clause License", "Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "Available under CC BY 3.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Available under CC BY-NC-SA 4.0"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Available under CC BY-SA 3.0"],
    "CC0": ["Licensed under CC0 1.0", "Released into the public domain under CC0 1.0 Universal", "This is free and unencumbered software released into the public domain"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GPLv3", "Released under the GNU GPL v2", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3", "Released under the LGPL 2.1", "SPDX-License-Identifier: LGPL-2.1-only"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL": ["Licensed under the Mozilla Public License, version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "Proprietary": ["All rights reserved", "Copyright. All rights reserved", "Proprietary and confidential. All rights reserved"],
}
UNKNOWN = "unknown"
#: Bounds of the training data: corpus texts sampled for unknowns (in expectation), lines of each, variants of a template.
SAMPLE_TEXTS, SAMPLE_LINES, VARIANTS = 1000, 20, 60
MAX_N, CONFIRM = 3, 0.6


def grams(data: np.ndarray, off: np.ndarray, low: int = 1, high: int = MAX_N):
    """(line, hash, number of words) of all word n-grams; case and punctuation do not count, n-grams stay in their line."""
    data = LOWER[data]
    starts, ends, row = words(data, off, PUNCT)
    w = span_hash(prefix_hash(data), starts, ends)
    rows, out, h = [], [], np.zeros(len(w), U64)
    for n in range(1, high + 1):
        m = max(0, len(w) - n + 1)
        h = h[:m] * U64(BASE) + w[n - 1:]
        ok = row[:m] == row[n - 1:]
        if n >= low:
            rows.append(row[:m][ok]), out.append(mix64(h[ok] + U64(n)))
    return np.concatenate(rows), np.concatenate(out)


def _pack(lines: list[str]):
    raw = [x.encode() for x in lines]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


class Classifier:
    def __init__(self, unknowns: list[str], seed: int = 3, epochs: int = 40):
        rng = np.random.default_rng(seed)
        self.names = [*TEMPLATES, UNKNOWN]
        noise = np.array([w for x in unknowns for w in x.split()] or ["text"])
        lines, y = [], []
        for k, name in enumerate(TEMPLATES):
            for t in TEMPLATES[name]:
                for v in range(VARIANTS):
                    parts = t.split()
                    if v and len(parts) > 6:
                        parts = [p for p in parts if rng.random() > 0.05]
                    before = list(rng.choice(noise, rng.integers(0, 6))) if v % 3 == 1 else []
                    after = list(rng.choice(noise, rng.integers(0, 6))) if v % 3 == 2 else []
                    lines.append(" ".join([*before, *parts, *after]))
                    y.append(k)
        # licence words in no licence's order, and templates' beginnings, are unknown as well
        vocabulary = np.array([w for ts in TEMPLATES.values() for t in ts for w in t.split()])
        odd = [" ".join([*rng.choice(noise, rng.integers(3, 15)), *rng.choice(vocabulary, rng.integers(1, 3))]) for _ in range(20 * VARIANTS)]
        lines += unknowns + odd
        y = np.array(y + [len(TEMPLATES)] * (len(unknowns) + len(odd)))
        known = np.unique(grams(*_pack([t for ts in TEMPLATES.values() for t in ts]))[1])
        self.vocabulary = known
        # most hashes miss these 2^16 bits, before the search
        self.bloom = np.zeros(1 << 16, bool)
        self.bloom[(known & U64(0xFFFF)).astype(np.int64)] = True
        self.templates = [[np.unique(grams(*_pack([t]), 2, 2)[1]) for t in ts] for ts in TEMPLATES.values()]
        self.temperature, self.least = 1.0, 0.5
        row, f = self._features(*_pack(lines))
        held = rng.random(len(lines)) < 0.2
        self.W, self.b = np.zeros((len(known), len(self.names))), np.zeros(len(self.names))
        train = np.flatnonzero(~held)
        X = np.zeros((len(lines), len(known)), np.float32)  # of the bounded training sample alone
        np.add.at(X, (row, f), 1)
        G, gb = np.full_like(self.W, 1e-6), np.full_like(self.b, 1e-6)
        for _ in range(epochs):
            rng.shuffle(train)
            for i in range(0, len(train), 512):
                o = train[i:i + 512]
                p = self._softmax(X[o] @ self.W + self.b)
                p[np.arange(len(o)), y[o]] -= 1
                g = X[o].T @ p / len(o) + 1e-4 * self.W
                G += g * g
                self.W -= 0.3 * g / np.sqrt(G)
                d = p.mean(0)
                gb += d * d
                self.b -= 0.3 * d / np.sqrt(gb)
        z = self._logits(row, f, len(lines))
        loss = lambda t: -np.log(self._softmax(z[held] / t)[np.arange(held.sum()), y[held]] + 1e-12).mean()
        self.temperature = float(min(np.linspace(0.5, 3, 26), key=loss))
        wrong = 1 - self._softmax(z[held & (y == len(TEMPLATES))] / self.temperature)[:, -1]
        self.least = float(np.clip(np.quantile(wrong, 0.999) if len(wrong) else 0.5, 0.5, 0.9))

    @staticmethod
    def _softmax(z):
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def _features(self, data, off):
        row, h = grams(data, off)
        some = self.bloom[(h & U64(0xFFFF)).astype(np.int64)]
        row, h = row[some], h[some]
        i = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        ok = self.vocabulary[i] == h
        order = np.lexsort((i[ok], row[ok]))
        return row[ok][order], i[ok][order]

    def _logits(self, row, f, n):
        z = np.tile(self.b, (n, 1))
        np.add.at(z, row, self.W[f])
        return z

    def scan(self, data: np.ndarray, off: np.ndarray):
        """(line, family, probability, share of the best template) of the lines named a licence. Lines without a known n-gram
        have the bias alone and are unknown."""
        row, f = self._features(data, off)
        lines, short = np.unique(row, return_inverse=True)
        if not len(lines):
            return
        p = self._softmax(self._logits(short, f, len(lines)) / self.temperature)
        best = p[:, :-1].argmax(1)
        for j in np.flatnonzero((p.argmax(1) < len(TEMPLATES)) & (1 - p[:, -1] >= self.least)):
            i = int(lines[j])
            mine = np.unique(grams(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]), 2, 2)[1])
            share = lambda k: max(float(np.isin(t, mine).mean()) if len(t) else 0.0 for t in self.templates[k])
            yield i, self.names[best[j]], float(p[j, best[j]]), share(best[j])


    def _name(self, data):
        """(family, probability) of one unit, or None."""
        row, f = self._features(data, np.array([0, len(data)]))
        p = self._softmax(self._logits(row, f, 1) / self.temperature)[0]
        k = int(p[:-1].argmax())
        return (k, float(p[k])) if len(f) and p.argmax() < len(TEMPLATES) and 1 - p[-1] >= self.least else None

    def _windows(self, data, cuts, a, b, confirm):
        """(first line, line after, family by number, share) of the runs of lines, among lines a to b, that hold ``confirm`` of a
        template's word pairs, the shortest first, and what of the template adjoins them. Runs of a family do not meet."""
        raw = LOWER[data[cuts[a]:cuts[b]]]
        starts, ends, _ = words(raw, np.array([0, len(raw)]), PUNCT)
        w = span_hash(prefix_hash(raw), starts, ends)
        h = mix64(w[:-1] * U64(BASE) + w[1:] + U64(2))
        line = np.searchsorted(cuts[a:b + 1] - cuts[a], starts, "right") - 1
        for k, templates in enumerate(self.templates):
            runs = []
            for t in templates:
                at = np.flatnonzero(np.isin(h, t))
                if not len(t) or len(np.unique(h[at])) / len(t) < confirm:
                    continue
                low, high, own, left, held = line[at], line[at + 1], np.searchsorted(t, h[at]), 0, Counter()
                for r in range(len(at)):
                    held[own[r]] += 1
                    while held[own[left]] > 1 or (len(held) - 1) / len(t) >= confirm:
                        held[own[left]] -= 1
                        if not held[own[left]]:
                            del held[own[left]]
                        left += 1
                    if len(held) / len(t) >= confirm:
                        runs.append((high[r] - low[left], low[left], high[r] + 1, t, at, low, high))
            taken = []
            for _, x, y, t, at, low, high in sorted(runs, key=lambda z: z[:2]):
                if any(x < d and c < y for c, d in taken):
                    continue
                size = lambda x, y: len(np.unique(h[at[(low >= x) & (high < y)]]))
                while True:
                    more = [(u, v) for u, v in ((x - 1, y), (x, y + 1)) if u >= 0 and v <= b - a and size(u, v) > size(x, y)]
                    if not more:
                        break
                    x, y = more[0]
                taken.append((x, y))
                yield a + int(x), a + int(y), k, size(x, y) / len(t)

    def scan_wrapped(self, data: np.ndarray, cuts: np.ndarray, row: np.ndarray, named: list, confirm: float):
        """(first line, line after, family, probability, share) of the notices of several lines. ``named`` is what ``scan`` says of the
        lines ``cuts``. A paragraph without such a notice is classified as a whole, if none of its lines is named."""
        if len(row) < 2:
            return
        blank = np.add.reduceat((~PUNCT[data]).astype(np.int64), cuts[:-1]) == 0
        first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | blank[:-1]]))
        after = np.append(first[1:], len(row))
        off = cuts[np.append(first, len(row))]
        part, f = self._features(data, off)
        some = (after - first - blank[after - 1] > 1)[part]  # those of one line are seen as lines
        part, f = part[some], f[some]
        here, short = np.unique(part, return_inverse=True)
        if not len(here):
            return
        p = self._softmax(self._logits(short, f, len(here)) / self.temperature)
        pair = np.unique(short * len(self.vocabulary) + f)
        short, f = pair // len(self.vocabulary), pair % len(self.vocabulary)
        full = np.zeros(len(here), bool)
        for t in (t for ts in self.templates for t in ts if len(t)):
            mine = np.zeros(len(self.vocabulary), bool)
            mine[np.searchsorted(self.vocabulary, t)] = True
            full |= np.bincount(short, mine[f], len(here)) / len(t) >= confirm
        lines = {(i, family): share for i, family, _, share in named}
        busy = {i for i, *_ in named}
        for j in np.flatnonzero(full | (p.argmax(1) < len(TEMPLATES)) & (1 - p[:, -1] >= self.least)):
            a, b = int(first[here[j]]), int(after[here[j]])
            found = False
            for x, y, k, share in self._windows(data, cuts, a, b, confirm) if full[j] else ():
                name = self._name(data[cuts[x]:cuts[y]]) if y - x > 1 else None
                if name and name[0] == k and not any(lines.get((i, self.names[k]), 0) >= confirm for i in range(x, y)):
                    found = True
                    yield x, y, self.names[k], name[1], share
            if not found and not any(i in busy for i in range(a, b)) and p[j].argmax() < len(TEMPLATES) and 1 - p[j, -1] >= self.least:
                k = int(p[j, :-1].argmax())
                mine = np.unique(grams(data[cuts[a]:cuts[b]], np.array([0, cuts[b] - cuts[a]]), 2, 2)[1])
                yield a, b, self.names[k], float(p[j, k]), max(float(np.isin(t, mine).mean()) if len(t) else 0.0 for t in self.templates[k])


def split_lines(data: np.ndarray, off: np.ndarray):
    """Offsets of all lines, and the row and number of each (from 0) in its row. Line ends belong to the line before."""
    cuts = np.unique(np.concatenate([off, np.flatnonzero(data == 10) + 1]))
    starts = cuts[:-1] if len(cuts) > 1 else np.zeros(0, np.int64)
    row = np.searchsorted(off, starts, "right") - 1
    first = np.searchsorted(starts, off[:-1])
    return cuts, row, np.arange(len(starts)) - first[row]


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, lines: int = SAMPLE_LINES) -> Classifier:
    """Fit with unknowns from about ``texts`` texts chosen by hash, up to ``lines`` lines of each, and the paragraphs
    that these make, without those that hold half of a template's word pairs."""
    rows = pick(docs, "doc_id", "text").filter(F.col("text").isNotNull())
    chance = min(1.0, texts / max(rows.count(), 1))
    got = rows.filter(F.pmod(F.xxhash64(F.lit("licence"), "doc_id"), F.lit(1 << 30)) < int(chance * (1 << 30)))
    got = got.select(F.slice(F.transform(F.split("text", "\n"), lambda x: F.substring(x, 1, 400)), 1, lines).alias("l")).collect()
    wrapped = [" ".join(g).strip() for r in got for word, g in groupby(r["l"], lambda x: any(not PUNCT[c] for c in x.encode())) if word]
    unknowns = sorted({x.strip() for r in got for x in r["l"] if x.strip()} | set(wrapped))
    marks = [np.unique(grams(*_pack([t]), 2, 2)[1]) for ts in TEMPLATES.values() for t in ts]
    pairs = [grams(*_pack([x]), 2, 2)[1] for x in unknowns]
    every = np.unique(np.concatenate(marks))
    return Classifier([x for x, g in zip(unknowns, pairs) if not np.isin(g, every).any() or not any(np.isin(m, g).mean() >= 0.5 for m in marks if len(m))])


def scan(docs: DataFrame, model: Classifier, confirm: float = CONFIRM) -> DataFrame:
    """(doc_id, paragraph, family, probability, template_share, confirmed, text): one row for each licence line or wrapped notice.

    Whole texts are scanned; ``paragraph`` is the number of the (first) line, from 0. Lines that a confirmed notice
    of several lines covers have no row of their own for its family. Null or empty texts have none; equal rows give equal
    rows; a null id stays null. A named paragraph under ``confirm`` is kept as unconfirmed.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            data, off = buffers(b.column(1))
            out = []
            for i, d, o in pieces(data, off):
                cuts, row, number = split_lines(d, o)
                named = list(model.scan(d, cuts))
                joined = list(model.scan_wrapped(d, cuts, row, named, confirm))
                covered = {(k, family) for x, y, family, _, share in joined if share >= confirm for k in range(x, y)}
                units = [(k, k + 1, family, p, share) for k, family, p, share in named if (k, family) not in covered] + joined
                for k, end, family, p, share in sorted(units):
                    out.append((i + int(row[k]), int(number[k]), family, p, share, share >= confirm, d[cuts[k]:cuts[end]].tobytes().decode().strip()))
            if out:
                r, *cols = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(r)), *[pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string()))]],
                                                 names=["doc_id", "paragraph", "family", "probability", "template_share", "confirmed", "text"])

    return pick(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, paragraph int, family string, probability double, template_share double, confirmed boolean, text string")


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
