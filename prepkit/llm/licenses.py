"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Texts become 3-word shingles (letters and digits, A-Z in lower case). For each template length there is a
window size and a step such that a passage as long as the template lies whole in some window. Windows begin with
the text and end with it, so what is found in a text depends on that text alone: a template is found where a
window holds the asked share of its shingles, from the first to the last of them. From the size follows the least Jaccard similarity of that window and the template, and from it the number of bands, so
that a passage that holds the asked share of the template shares a band with a chance of at least 0.999.
Minima are taken once per block of four shingles and hash function, and windows are joined from blocks.
What bands miss is retrieved exactly: a window that holds ``s`` of a template's ``n`` shingles holds ``m`` of
any ``n - s + m`` of them, so windows with that many of a fixed part of the template are compared as well.
A window that shares a band with a template is compared shingle by shingle, within its own document.
Nothing is shuffled; templates are few and travel with the tasks.

Defined cases: a null or empty text, or one of fewer than three words, matches nothing; templates of fewer
than three words are refused; rows that share a key are judged apart; overlapping windows that hold the
same template are one span.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm import exchange as X
from prepkit.llm import words as W

SHINGLE, BLOCK = 3, 4
CONTAINMENT, CHANCE = 0.8, 0.999
MAX_TEMPLATES = 10_000

# Usual short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}

#: Of a template's shingles, one in so many must be met in its fixed part.
MET_PER = 16

_U = np.uint64


def all_templates() -> dict[str, str]:
    """The notices, and the terms of whole licenses (``license_texts``, read where the driver runs)."""
    texts = sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
    return TEMPLATES | {f"{p.stem}-text": p.read_text("utf-8") for p in texts}


class Plan(NamedTuple):
    """How templates of one number of shingles are looked for: windows in blocks, and bands."""

    shingles: int
    window: int
    step: int
    rows: int
    bands: int


def plan(shingles: int, containment: float = CONTAINMENT, chance: float = CHANCE) -> Plan:
    """Windows that hold any passage of the length whole, and bands for the similarity that follows."""
    step = max(1, -(-shingles // (2 * BLOCK)))
    window = -(-shingles // BLOCK) + 1 + step
    # At worst, the share asked for is in the window and nothing else of it is in the template.
    shared = math.ceil(containment * shingles)
    least = shared / (window * BLOCK + shingles - shared)
    rows = 2 if least >= 0.4 and shingles >= 16 else 1
    bands = math.ceil(math.log(1 - chance) / math.log(1 - least**rows))
    return Plan(shingles, window, step, rows, bands)


class TemplateIndex:
    """Band keys of all templates."""

    def __init__(self, templates: Mapping[str, str], containment: float = CONTAINMENT):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.names = sorted(templates)
        self.containment = containment
        self.sets = []
        for name in self.names:
            chunk = next(W.chunks(pa.array([templates[name]])))
            own = np.unique(W.row_windows(W.find_words(chunk, W.LETTERS, W.LOWER), SHINGLE)[1])
            if not len(own):
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            self.sets.append(own)
        self.plans: list[tuple[Plan, list[tuple[np.ndarray, np.ndarray]]]] = []
        most = 0
        for size in sorted({len(s) for s in self.sets}):
            p = plan(size, containment)
            most = max(most, p.rows * p.bands)
            self.plans.append((p, []))
        self.factors = np.random.default_rng(7).integers(0, 2**63, most, dtype=np.uint64) * _U(2) + _U(1)
        for p, tables in self.plans:
            own = [k for k, s in enumerate(self.sets) if len(s) == p.shingles]
            least = np.stack([[self.minima(self.sets[k], f) for f in range(p.rows * p.bands)] for k in own])
            for band in range(p.bands):
                keys = _band(least[:, band * p.rows : (band + 1) * p.rows].T)
                order = np.argsort(keys)
                tables.append((keys[order], np.array(own)[order]))

        # Fixed parts of all templates, and how many of a part a passage holds at least.
        self.met = np.array([max(1, len(s) // MET_PER) for s in self.sets])
        sizes = [len(s) - math.ceil(containment * len(s)) + m for s, m in zip(self.sets, self.met, strict=True)]
        parts = [s[:n] for s, n in zip(self.sets, sizes, strict=True)]
        hashes = np.concatenate(parts) if parts else np.zeros(0, _U)
        order = np.argsort(hashes, kind="stable")
        self.part = hashes[order]
        self.part_of = np.repeat(np.arange(len(parts)), [len(s) for s in parts])[order]

    def minima(self, shingles: np.ndarray, f: int):
        return _scatter(shingles, self.factors[f]).min()

    def find(self, found: W.Words) -> list[tuple[int, int, int, int]]:
        """Row, template, and first and last word of every verified match of a chunk."""
        place, hashes = W.row_windows(found, SHINGLE)
        if not len(hashes):
            return []
        text = _Layout(found.row[place], len(found.first) - 1)
        every = [text.windows(p) for p, _ in self.plans]
        least: list[list[np.ndarray]] = [[] for _ in self.plans]
        for f, factor in enumerate(self.factors):
            levels = _levels(np.minimum.reduceat(_scatter(hashes, factor), text.edges), max(p.window for p, _ in self.plans))
            for (p, _), windows, own in zip(self.plans, every, least, strict=True):
                if f < p.rows * p.bands:
                    own.append(_window_minima(levels, windows.start, windows.end))
        at, of = self._parts_met(hashes)
        out = []
        for (p, tables), windows, minima in zip(self.plans, every, least, strict=True):
            seen: set[tuple[int, int]] = set()
            for band, (keys, which) in enumerate(tables):
                got = _band(np.stack(minima[band * p.rows : (band + 1) * p.rows]))
                low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
                for w in np.flatnonzero(high > low).tolist():
                    seen.update((w, k) for k in which[low[w] : high[w]].tolist())
            seen.update(self._windows_met(p, text, windows, at, of))
            for w, k in sorted(seen):
                a, b = text.shingles(p, windows, w)
                hit = np.flatnonzero(X.is_in(hashes[a:b], self.sets[k])) + a
                if len(np.unique(hashes[hit])) >= self.containment * len(self.sets[k]):
                    out.append((int(windows.row[w]), k, int(place[hit[0]]), int(place[hit[-1]]) + SHINGLE))
        return out

    def _parts_met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles in fixed parts, and the templates of these."""
        low, high = np.searchsorted(self.part, hashes, "left"), np.searchsorted(self.part, hashes, "right")
        n = high - low
        at = np.repeat(np.arange(len(hashes)), n)
        first = np.repeat(np.cumsum(n) - n, n)
        return at, self.part_of[np.repeat(low, n) + np.arange(len(at)) - first]

    def _windows_met(self, p: Plan, text: _Layout, windows: _Windows, at: np.ndarray, of: np.ndarray) -> list[tuple[int, int]]:
        """Windows, and templates of the plan's length of whose fixed part they hold enough."""
        own = np.array([len(s) == p.shingles for s in self.sets])[of] if len(of) else np.zeros(0, bool)
        row, which = text.row[at[own]], of[own]
        block = (at[own] - text.cut[row]) // BLOCK
        found = []
        for back in range(-(-p.window // p.step)):
            window = block // p.step - back
            good = (window >= 0) & (window * p.step + p.window > block)
            found.append((windows.first[row] + window)[good] * len(self.sets) + which[good])
        pairs, n = np.unique(np.concatenate(found), return_counts=True)
        window, which = pairs // len(self.sets), pairs % len(self.sets)
        good = n >= self.met[which]
        return list(zip(window[good].tolist(), which[good].tolist(), strict=True))


class _Windows(NamedTuple):
    """The row of each window, its first block and the block after its last, and the first window of each row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


class _Layout:
    """Blocks of the shingles of a chunk; blocks and windows begin with each row."""

    def __init__(self, row: np.ndarray, n_rows: int):
        self.row = row
        self.cut = np.searchsorted(row, np.arange(n_rows + 1))
        blocks = -(-np.diff(self.cut) // BLOCK)
        self.first = np.concatenate(([0], np.cumsum(blocks)))
        of = np.repeat(np.arange(n_rows), blocks)
        self.edges = self.cut[of] + (np.arange(len(of)) - self.first[of]) * BLOCK

    def windows(self, p: Plan) -> _Windows:
        n = -(-np.diff(self.first) // p.step)
        first = np.concatenate(([0], np.cumsum(n)))
        row = np.repeat(np.arange(len(n)), n)
        start = self.first[row] + (np.arange(len(row)) - first[row]) * p.step
        return _Windows(row, start, np.minimum(start + p.window, self.first[row + 1]), first)

    def shingles(self, p: Plan, windows: _Windows, w: int) -> tuple[int, int]:
        """The first shingle of a window, and the one after its last."""
        a = int(self.edges[windows.start[w]])
        return a, min(a + p.window * BLOCK, int(self.cut[windows.row[w] + 1]))


def _scatter(hashes: np.ndarray, factor) -> np.ndarray:
    h = hashes * factor
    return h ^ (h >> _U(29))


def _band(least: np.ndarray) -> np.ndarray:
    """One key from the minima (in rows) of a band."""
    key = np.zeros(least.shape[1], _U)
    for row in least:
        key = W.mix(key + row)
    return key


def _levels(blocks: np.ndarray, most: int) -> np.ndarray:
    """Least values of 1, 2, 4 ... blocks from each block on, as far as ``most`` blocks ask for."""
    out = [blocks]
    while 2 ** len(out) <= min(most, len(blocks)):
        low, width = out[-1], 2 ** (len(out) - 1)
        out.append(np.minimum(low, np.concatenate((low[width:], np.full(width, low[-1])))))
    return np.stack(out)


def _window_minima(levels: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least values of the blocks from ``start`` up to ``end``."""
    level = np.frexp(end - start)[1] - 1
    return np.minimum(levels[level, start], levels[level, end - (1 << level)])


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``key, n_words`` and ``matches`` (template, first and last word) of every row."""
    index = TemplateIndex(templates, containment)
    kind = pa.list_(pa.struct([("template", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for batch in batches:
            for chunk in W.chunks(batch.column(1)):
                found = W.find_words(chunk, W.LETTERS, W.LOWER)
                n = chunk.high - chunk.low
                spans: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(n)]
                for r, k, a, b in index.find(found):
                    first = int(found.first[r])
                    spans[r].setdefault(index.names[k], []).append((a - first, b - first))
                cells = [
                    sorted(
                        ({"template": t, "start": a, "end": b} for t, own in row.items() for a, b in _union(own)),
                        key=lambda m: (m["start"], m["template"]),
                    )
                    for row in spans
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.low, n), pa.array(np.diff(found.first), pa.int64()), pa.array(cells, kind)],
                    ["key", "n_words", "matches"],
                )

    cells = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind_of = cells.schema["key"].dataType.simpleString()
    shape = f"key {kind_of}, n_words long, matches array<struct<template:string,start:bigint,end:bigint>>"
    return cells.mapInArrow(find, shape).withColumnRenamed("key", key)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
