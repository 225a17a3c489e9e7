"""Licence scan by a trained paragraph classifier.

Every sentence of every text is a paragraph. Sparse word n-grams (one, two and three words, hashed) feed a
multinomial logistic regression over licence families, with a class for other licences and one for ordinary
text. Probabilities are calibrated by a temperature on sentences left out of the fit, and the threshold of unknown
licences on others. A family is
reported only if one of its templates confirms it: enough of the template's n-grams stand in the
paragraph; a licence sentence that no template confirms is reported as unknown.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, sample_texts, slices, table, whole_text
from .wordhash import mix, word_hashes

# Sentences by which licences are commonly declared.
TEMPLATES = {
    "agpl": ["This work is licensed under the GNU Affero General Public License, version 3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "Licensed under the AGPL v3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "apache": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License", "distributed under the Apache License 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License", "Licensed under the BSD license", "SPDX-License-Identifier: BSD-3-Clause"],
    "boost": ["Distributed under the Boost Software License, Version 1.0", "Licensed under the Boost Software License", "SPDX-License-Identifier: BSL-1.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0", "available under the Creative Commons Attribution license"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "This work is licensed under CC BY-NC 3.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "text is available under the Creative Commons Attribution-ShareAlike License"],
    "cc0": ["To the extent possible under law, the author has waived all copyright", "Released into the public domain", "Licensed under CC0 1.0 Universal"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the Eclipse Public License", "SPDX-License-Identifier: EPL-2.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "Licensed under the GPL v2", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License", "SPDX-License-Identifier: ISC"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "Licensed under the LGPL v2.1"],
    "mit": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "Licensed under the MIT license", "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "ofl": ["This Font Software is licensed under the SIL Open Font License, Version 1.1", "Licensed under the SIL Open Font License", "SPDX-License-Identifier: OFL-1.1"],
    "unlicense": ["This is free and unencumbered software released into the public domain", "Released under the Unlicense", "SPDX-License-Identifier: Unlicense"],
    "zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications", "Licensed under the zlib License", "SPDX-License-Identifier: Zlib"],
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN, ORDINARY = len(FAMILIES), len(FAMILIES) + 1
CLASSES = [*FAMILIES, "unknown", "none"]
BITS = 16
#: Documents of the sample whose sentences stand for ordinary text.
FIT_DOCUMENTS = 1000
#: Ordinary sentences are fitted in stretches of so many words, each word cut, and of so many characters in all: what the fit holds is bounded whatever the texts are.
WINDOW_WORDS, WORD_CHARS, WINDOW_CHARS = 60, 40, 4_000_000
#: Share of ordinary sentences that may pass for an unknown licence; the least probability for that is calibrated, and no less than ``UNKNOWN_LEAST``.
UNKNOWN_SHARE, UNKNOWN_LEAST = 0.001, 0.9
#: Words that a declaration of an unknown licence has at least; a word or two, without a template, tell nothing.
UNKNOWN_WORDS = 3
#: Share of a template's n-grams that a paragraph must have.
CONFIRMED = 0.5
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all sentences of ``texts``: text of each, first and last word (exclusive), and per n the n-gram hashes by first word.

    A sentence ends at a line break, and after . ! ? before a blank. Hashes of n-grams that would leave their sentence are
    those of their first word.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    block = b"\n".join(raw) + b"\n"
    data = np.frombuffer(block, dtype=np.uint8)
    ends_here = data == 10
    ends_here[:-1] |= _STOP[data[:-1]] & _GAP[data[1:]]
    words, _, begins = word_hashes([block[:-1].translate(_TABLE).decode("utf-8", "surrogatepass")], lower=False, places=True)
    number = np.concatenate(([0], np.cumsum(ends_here)))[begins]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    last = np.append(first[1:], len(words))
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), begins[first], side="right") if len(first) else first
    two, three = words.copy(), words.copy()
    if len(words) > 1:
        same = number[1:] == number[:-1]
        two[:-1][same] = mix(words[:-1] * np.uint64(3) + words[1:])[same]
    if len(words) > 2:
        same = number[2:] == number[:-2]
        three[:-2][same] = mix(words[:-2] * np.uint64(9) + words[1:-1] * np.uint64(3) + words[2:])[same]
    return owner, first, last, [words, two, three]


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    unknown_from: float = UNKNOWN_LEAST

    def probabilities(self, first: np.ndarray, last: np.ndarray, by_n: list[np.ndarray]) -> np.ndarray:
        """Of each sentence, one column per class."""
        total = np.add.reduceat(sum(self.weights[_buckets(h, n)] for n, h in enumerate(by_n)), first, axis=0)
        z = (total / (3 * np.sqrt(last - first))[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def windows(texts: list[str], rng: random.Random) -> list[str]:
    """Stretches of at most ``WINDOW_WORDS`` words that cover the sentences of ``texts``, each once, shuffled, ``WINDOW_CHARS`` characters at most."""
    found, held = [], 0
    for t in rng.sample(texts, len(texts)):
        for sentence in re.split(r"\n|[.!?] |[。！？]", t):
            words = sentence.split()
            for at in range(0, len(words), WINDOW_WORDS):
                window = " ".join(w[:WORD_CHARS] for w in words[at : at + WINDOW_WORDS])
                if "licen" not in window.lower():
                    found.append(window)
                    held += len(window)
        if held > WINDOW_CHARS:
            break
    rng.shuffle(found)
    sizes = np.cumsum([len(w) for w in found])
    return found[: int(np.searchsorted(sizes, WINDOW_CHARS, side="right"))]


def examples(texts: list[str], seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Sentences and classes: variations of the templates, declarations of other licences, and sentences of ``texts``."""
    rng = random.Random(seed)
    pool = windows(texts, rng) or ["plain text"]
    some = lambda: " ".join(rng.choice(pool).split()[: rng.randint(0, 3)]).strip(".!?,")
    made = ("Orchid", "Harbour", "Nimbus", "Quartz", "Falcon", "Meadow", "Copper", "Juniper", "Lantern", "Acme", "Contoso", "Zephyr")
    other = ("Licensed under the {} Public License, version {}", "Released under the {} License", "Use of this work is governed by the {} Commercial License {}", "Licensed under {} {}", "distributed under the terms of the {} Licence", "All rights reserved under the {} End User License Agreement")
    rows: list[tuple[str, int]] = []
    for _ in range(60):
        for k, family in enumerate(FAMILIES):
            for template in TEMPLATES[family]:
                words = [w for w in template.split() if rng.random() > 0.06]
                rows.append((f"{some()} {' '.join(words)} {some()}", k))
        for form in other:
            rows.append((f"{some()} {form.format(rng.choice(made), rng.randint(1, 5))} {some()}", UNKNOWN))
    rows += [(s, ORDINARY) for s in pool[: 6 * len(rows)]]
    rng.shuffle(rows)
    rows = [(re.sub(r"[.!?]+(?=\s)", "", " ".join(s.split())), k) for s, k in rows]
    rows = [(s, k) for s, k in rows if any(c.isalnum() for c in s)]
    return [s for s, _ in rows], np.array([k for _, k in rows])


def train(texts: list[str], epochs: int = 6) -> Classifier:
    sentences, labels = examples(texts)
    _, first, last, by_n = grams(sentences)
    assert len(labels) == len(first), "every example is one sentence"
    index = np.concatenate([_buckets(h, n) for n, h in enumerate(by_n)]).reshape(3, -1)
    cut, last_part = len(first) * 7 // 10, len(first) * 17 // 20  # the rest: one part for the temperature, another for the threshold
    m = Classifier(np.zeros((1 << BITS, len(CLASSES)), dtype=np.float32), np.zeros(len(CLASSES)))
    squares = np.full_like(m.weights, 1e-3)
    for _ in range(epochs):
        for at in range(0, cut, 64):
            rows = np.arange(at, min(cut, at + 64))
            a, b = first[rows[0]], last[rows[-1]]
            p = m.probabilities(first[rows] - a, last[rows] - a, [h[a:b] for h in by_n])
            p[np.arange(len(rows)), labels[rows]] -= 1
            g = p / (3 * np.sqrt(last[rows] - first[rows]))[:, None]
            each = np.repeat(g, last[rows] - first[rows], axis=0).astype(np.float32)
            for n in range(3):
                own, back = np.unique(index[n, a:b], return_inverse=True)
                grad = np.stack([np.bincount(back, each[:, k], len(own)) for k in range(len(CLASSES))], 1).astype(np.float32)
                squares[own] += grad * grad
                m.weights[own] -= 0.5 * grad / np.sqrt(squares[own])
            m.bias -= 0.02 * p.mean(axis=0)
    held = lambda a, b: m.probabilities(first[a:b] - first[a], last[a:b] - first[a], [h[first[a] : last[b - 1]] for h in by_n])
    if cut < last_part < len(first):
        fits = {}
        for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0):
            m.temperature = t
            fits[t] = -np.log(held(cut, last_part)[np.arange(last_part - cut), labels[cut:last_part]] + 1e-9).mean()
        m.temperature = min(fits, key=fits.get)
        ordinary = 1 - held(last_part, len(first))[labels[last_part:] == ORDINARY, ORDINARY]
        m.unknown_from = max(UNKNOWN_LEAST, float(np.quantile(ordinary, 1 - UNKNOWN_SHARE))) if len(ordinary) else UNKNOWN_LEAST
    return m


def _template_grams() -> list[list[np.ndarray]]:
    out = []
    for family in FAMILIES:
        _, first, last, by_n = grams([t.replace(". ", " ") for t in TEMPLATES[family]])
        out.append([np.unique(by_n[1][a : b - 1] if b - a > 1 else by_n[0][a:b]) for a, b in zip(first, last, strict=True)])
    return out


def _scanned(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    known = _template_grams()
    for batch, texts in slices(batches):
        found: list[list[tuple[str, float]]] = [[] for _ in texts]
        at: dict[int, int] = {}
        sentences = np.zeros(len(texts), dtype=np.int64)
        owner, first, last, by_n = grams(texts)
        if len(first):
            np.add.at(sentences, owner, 1)
            p = model.probabilities(first, last, by_n)
            for s in np.flatnonzero(p[:, ORDINARY] < 0.5):
                k = int(p[s, :ORDINARY].argmax())
                own = np.unique(by_n[1][first[s] : max(first[s] + 1, last[s] - 1)])
                sure = k < UNKNOWN and any(np.isin(t, own, assume_unique=True).mean() >= CONFIRMED for t in known[k])
                if sure or last[s] - first[s] >= UNKNOWN_WORDS and 1 - p[s, ORDINARY] > model.unknown_from:
                    family, own_text = CLASSES[k] if sure else "unknown", found[owner[s]]
                    if own_text and own_text[-1][0] == family and at[owner[s]] == s - 1:  # sentences in a row are one finding
                        own_text[-1] = (family, max(own_text[-1][1], float(p[s, k])))
                    else:
                        own_text.append((family, float(p[s, k])))
                    at[owner[s]] = s
        families = [",".join(sorted({f for f, _ in r})) for r in found]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sentences, pa.int64()), pa.array([len(r) for r in found], pa.int64()), pa.array([sum(f == "unknown" for f, _ in r) for r in found], pa.int64()),
            pa.array(families), pa.array([max((q for _, q in r), default=0.0) for r in found], pa.float64()),
        ], names=["doc_id", "n_sentences", "n_licence", "n_unknown", "families", "confidence"])


SCHEMA = "doc_id long, n_sentences long, n_licence long, n_unknown long, families string, confidence double"


def fitted(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Classifier:
    """The classifier, with ordinary sentences from at most ``fit_documents`` of these documents."""
    return train(sample_texts(docs, fit_documents))


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """Licence declarations in every whole text; one row per input row.

    n_sentences, n_licence (findings; successive sentences of one family are one), n_unknown (of these, ones that no template confirms),
    families (sorted, comma-joined, "unknown" among them) and the highest probability. A null or empty text has none.
    Rows may repeat, texts may be very long; other columns are ignored. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(lambda it: _scanned(it, model), SCHEMA)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fitted(docs))
