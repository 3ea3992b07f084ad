"""License scan: a trained paragraph classifier, applied in DataFrame functions only.

Training (on the driver, from the templates below): paragraphs are made from each family's
templates by dropping, changing and surrounding words, and unknown paragraphs from ordinary
and licence-like sentences of no family, from licences that are not listed, from negated
templates and from mixtures of the templates' words. A multinomial logistic regression over the
presence of word bigrams learns the families and the unknown class; a temperature, fitted
on made paragraphs that training has not seen, calibrates its probabilities.

Scan: a paragraph is a block of lines up to a blank one, with its lines joined, so wrapped notices
are read whole; paragraphs of any length are read in windows of two times ``stride`` words, one
stride further each time. The hashes of a window's distinct bigrams meet the weights (a table
whose size is that of the templates) and are summed. A family is predicted where it is the
most probable class of a window or its template comparison confirms it, and its calibrated
probability against the unknown class is at least ``min_probability``; so one paragraph can have
several. It is confirmed where one of its templates has at least ``min_cover`` of its bigrams in
the window, together with all bigrams of one of the family's deciding sets (name and version), or
where the template is longer than a name (``long_template`` bigrams).

Defined cases: null and empty texts have no paragraphs; windows without a known bigram are
unknown, which training checks by the intercepts; repeated rows are reported as often as they
come; a null id is reported as null; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
#: Sentences by which the families announce themselves.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0", "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.", "The MIT License", "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "GNU General Public License, version 3", "This work is licensed under the GNU General Public License, version 3.", "either version 3 of the GNU General Public License, or (at your option) any later version",
        _GNU.format("General Public License", 3), "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "gpl-2.0": (
        "GNU General Public License, version 2", "This work is licensed under the GNU General Public License, version 2.", "either version 2 of the GNU General Public License, or (at your option) any later version",
        _GNU.format("General Public License", 2), "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "agpl-3.0": (
        "GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3.", _GNU.format("Affero General Public License", 3), "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "lgpl-2.1": (
        "GNU Lesser General Public License, version 2.1", "Licensed under the GNU Lesser General Public License, version 2.1.", _GNU.format("Lesser General Public License", "2.1"), "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "lgpl-3.0": (
        "GNU Lesser General Public License, version 3", "Licensed under the GNU Lesser General Public License, version 3.", _GNU.format("Lesser General Public License", 3), "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "bsd-2-clause": ("Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "SPDX-License-Identifier: ISC"),
}
#: For each family, sets of bigrams (parted by |) of which one set has to be there whole.
DECIDING: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("apache license|license version|version 2|2 0", "apache 2|2 0"),
    "mit": ("mit license", "identifier mit"),
    "gpl-3.0": ("gnu general|general public|public license|version 3", "identifier gpl|gpl 3"),
    "gpl-2.0": ("gnu general|general public|public license|version 2", "identifier gpl|gpl 2"),
    "agpl-3.0": ("gnu affero|affero general|version 3", "identifier agpl|agpl 3"),
    "lgpl-2.1": ("gnu lesser|lesser general|version 2|2 1", "identifier lgpl|lgpl 2|2 1"),
    "lgpl-3.0": ("gnu lesser|lesser general|version 3", "identifier lgpl|lgpl 3"),
    "bsd": ("bsd 3|3 clause",), "bsd-2-clause": ("bsd 2|2 clause",),
    "mpl-2.0": ("mozilla public|public license|2 0", "identifier mpl|mpl 2|2 0"),
    "cc-by-4.0": ("cc by|by 4|4 0", "commons attribution|attribution 4|4 0"),
    "cc-by-sa-4.0": ("by sa|sa 4|4 0", "attribution sharealike|sharealike 4|4 0"),
    "cc-by-nc-4.0": ("by nc|nc 4|4 0", "attribution noncommercial|noncommercial 4|4 0"),
    "unlicense": ("unencumbered software|public domain",), "isc": ("identifier isc",),
}
#: Families whose long templates name nothing that another family's don't have: they need a deciding set at any length.
NAMED_ONLY = ("gpl-3.0", "gpl-2.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0")
#: Sentences of no family, and of licences that aren't listed, for the unknown class.
OTHERS = (
    "All rights reserved.", "The driver was licensed by the city in 1998.", "A license plate was found near the river.",
    "This work is the property of its author and may not be copied.", "The restaurant is licensed to sell beer and wine.",
    "Released under pressure from the public.", "The software was released in version 3 of the programme.", "Permission is required before you enter.",
    "The general public was asked to stay at home.", "See the terms of use of this site.", "The version of this file is not known.",
    "Subject to change without notice.", "Licensed under the terms agreed by both parties.", "He works under a license from the state.",
    "This project is funded by the ministry.", "Use of this text is free of charge for schools.",
    "Licensed under the Apache License, Version 1.1.", "Licensed under the GNU Free Documentation License, version 1.3.", "Licensed under the Eclipse Public License, version 2.0.",
    "Licensed under the Mozilla Public License, version 1.1.", "Licensed under CC BY 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "Released under the Microsoft Public License.", "Released under the BSD 4-Clause License.", "Licensed under the Academic Free License, version 3.0.",
    "This work is licensed under the GNU General Public License, version 1.", "Released under the Boost Software License.",
)
#: What turns a notice round, before "licensed" or "released".
NEGATIONS = ("not", "no longer", "never", "neither")
UNKNOWN = "unknown"


@dataclass(frozen=True)
class LicenseSpec:
    copies: int = 24
    steps: int = 300
    penalty: float = 1e-3
    min_probability: float = 0.6
    min_cover: float = 0.7
    long_template: int = 16
    stride: int = 96
    seed: int = 3


def tokens(text: str) -> list[str]:
    """Lower-cased runs of ASCII letters and digits."""
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def ngrams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:]))  # noqa: B905


@dataclass(frozen=True)
class LicenseModel:
    families: list[str]  # the last is the unknown class
    grams: list[tuple[str, ...]]
    weights: np.ndarray  # grams x families, divided by the temperature
    bias: np.ndarray
    templates: list[tuple[str, set]]  # family and n-grams
    deciding: list[tuple[str, set]]


def _made(rng: np.random.Generator, spec: LicenseSpec, families: list[str]) -> list[tuple[set, int]]:
    every = [tokens(t) for ts in TEMPLATES.values() for t in ts]
    plain = [w for t in (*OTHERS, *sum(TEMPLATES.values(), ())) for w in tokens(t)]
    junk = lambda n: ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9))) for _ in range(n)]
    out = []
    for k, f in enumerate(families[:-1]):
        for t in TEMPLATES[f]:
            words = tokens(t)
            for _ in range(spec.copies):
                w = list(words)
                for _ in range(int(rng.integers(0, 1 + len(w) // 6))):
                    i = int(rng.integers(len(w)))
                    w[i : i + 1] = [] if rng.random() < 0.5 else junk(1)
                out.append((ngrams(junk(int(rng.integers(0, 12))) + w + junk(int(rng.integers(0, 12)))), k))
    unknown = len(families) - 1
    for w in every:  # each notice turned round, whole and with words around it
        for i in (i for i, x in enumerate(w) if x in ("licensed", "released") and spec.copies):
            for no in NEGATIONS:
                turned = w[:i] + no.split() + w[i:]
                out += [(ngrams(turned), unknown), (ngrams(junk(3) + turned + junk(3)), unknown)]
    for o in OTHERS:
        out += [(ngrams(junk(int(rng.integers(0, 6))) + tokens(o) + junk(int(rng.integers(0, 6)))), unknown) for _ in range(spec.copies // 4)]
    for _ in range(spec.copies * 12):
        kind = rng.integers(4)
        if kind == 0:
            w = junk(int(rng.integers(1, 40)))
        elif kind == 1:
            w = junk(int(rng.integers(0, 6))) + tokens(OTHERS[rng.integers(len(OTHERS))]) + junk(int(rng.integers(0, 6)))
        elif kind == 2:
            w = [plain[i] for i in rng.integers(0, len(plain), int(rng.integers(3, 30)))]
        else:  # a fragment of a template, too short to tell
            t = every[rng.integers(len(every))]
            i = int(rng.integers(len(t)))
            w = junk(4) + t[i : i + 2] + junk(4)
        out.append((ngrams(w), unknown))
    return out


@lru_cache(maxsize=4)
def train(spec: LicenseSpec = LicenseSpec()) -> LicenseModel:
    """Fit the classifier and its temperature on made paragraphs."""
    families = [*TEMPLATES, UNKNOWN]
    templates = [(f, ngrams(tokens(t))) for f, ts in TEMPLATES.items() for t in ts]
    deciding = [(f, {tuple(g.split()) for g in d.split("|")}) for f, ds in DECIDING.items() for d in ds]
    turned = [ngrams([*no.split(), x]) for no in NEGATIONS for x in ("licensed", "released")]
    grams = sorted(set().union(*[g for _, g in (*templates, *deciding)], *[ngrams(tokens(o)) for o in OTHERS], *turned))
    place = {g: i for i, g in enumerate(grams)}

    def matrix(made):
        x = np.zeros((len(made), len(grams)), np.float32)
        for row, (g, _) in zip(x, made, strict=True):
            row[[place[a] for a in g if a in place]] = 1
        return x, np.array([k for _, k in made])

    x, y = matrix(_made(np.random.default_rng(spec.seed), spec, families))
    goal = np.eye(len(families))[y]
    w, b = np.zeros((len(grams), len(families)), np.float32), np.zeros(len(families))
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(spec.steps):  # gradient descent with momentum
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = ((p - goal) / len(y)).astype(np.float32)
        vw = 0.9 * vw - 2.0 * (x.T @ d + spec.penalty * w)
        vb = 0.9 * vb - 2.0 * d.sum(0)
        w, b = w + vw, b + vb
    x, y = matrix(_made(np.random.default_rng(spec.seed + 1), spec, families))

    def loss(t: float) -> float:
        z = (x @ w + b) / t
        z -= z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]))

    heat = min((0.25, 0.35, 0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0), key=loss)
    if b.argmax() != len(families) - 1:
        raise ValueError("the intercepts don't make a paragraph without known bigrams unknown")
    return LicenseModel(families, grams, w.astype(float) / heat, b / heat, templates, deciding)


def _met(docs: DataFrame, keys: DataFrame, spec: LicenseSpec, id_col: str, text_col: str) -> DataFrame:
    """__id, __row, __n (paragraph), __window and the distinct known bigrams (g, lead) of each window."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    blocks = F.split(text, r"\n[ \t\x0B\f\r]*\n\s*")
    rows = docs.select(F.col(id_col).alias("__id"), F.monotonically_increasing_id().alias("__row"), F.posexplode(blocks).alias("__n", "__block"))
    # An empty word at either end of a block is part of no known n-gram.
    w = F.split("__block", "[^a-z0-9]+")
    rows = rows.select("__id", "__row", "__n", w.alias("__w"))
    w = F.col("__w")
    pair = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1)).alias("key"), F.floor(i / spec.stride).cast("int").alias("at"))
    pairs = F.when(F.size(w) >= 2, F.transform(F.sequence(F.lit(0), F.size(w) - 2), pair))
    grams = rows.select("__id", "__row", "__n", F.explode(pairs).alias("__p"))
    met = grams.select("__id", "__row", "__n", F.col("__p.key").alias("__key"), F.col("__p.at").alias("__at")).join(F.broadcast(keys), "__key")
    # A stride is the second half of one window and the first of the next.
    met = met.withColumn("__window", F.explode(F.when(F.col("__at") > 0, F.array(F.col("__at") - 1, "__at")).otherwise(F.array("__at"))))
    return met.groupBy("__id", "__row", "__n", "__window").agg(F.collect_set(F.struct("__g", "lead")).alias("__gs"))


def scan(docs: DataFrame, spec: LicenseSpec = LicenseSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, paragraph (from 0), first_word, family, probability, cover, confirmed.

    Rows are the paragraphs and the families predicted for them, each from its best window.
    """
    spark, model = docs.sparkSession, train(spec)
    k, wanted = len(model.families), [*model.templates, *model.deciding]
    parts = range(0, len(wanted), 60)
    masks = [[sum(1 << t for t, (_, own) in enumerate(wanted[at : at + 60]) if g in own) for at in parts] for g in model.grams]
    # What a gram can add at most to a family's lead over the unknown class.
    lead = (model.weights[:, :-1] - model.weights[:, -1:]).max(1)
    start = float((model.bias[:-1] - model.bias[-1]).max())
    rows = [(i, list(g), [int(x) for x in m], float(d), [float(v) for v in ws]) for i, (g, m, d, ws) in enumerate(zip(model.grams, masks, lead, model.weights, strict=True))]
    table = spark.createDataFrame(rows, "g int, gram array<string>, mask array<long>, lead double, w array<double>")
    keys = table.select(F.xxhash64(F.get("gram", F.lit(0)), F.get("gram", F.lit(1))).alias("__key"), F.col("g").alias("__g"), "lead")
    table = table.select(F.col("g").alias("__g"), "mask", *[F.get("w", F.lit(j)).alias(f"w{j}") for j in range(k)])

    group = ("__id", "__row", "__n", "__window")
    total = F.aggregate("__gs", F.lit(0.0), lambda a, x: a + x["lead"])
    # Only where the leads' sum is positive can a family come out before the unknown class.
    near = _met(docs, keys, spec, id_col, text_col).where(total + start > 0)
    met = near.select(*group, F.explode("__gs.__g").alias("__g")).join(F.broadcast(table), "__g")
    held = [F.sum(F.shiftright(F.get("mask", F.lit(t // 60)), t % 60).bitwiseAND(F.lit(1))).alias(f"t{t}") for t in range(len(wanted))]
    sums = met.groupBy(*group).agg(*[F.sum(f"w{j}").alias(f"s{j}") for j in range(k)], *held)
    z = F.array(*[F.col(f"s{j}") + F.lit(float(model.bias[j])) for j in range(k)])
    whole = {}
    for t, (f, own) in enumerate(model.deciding, len(model.templates)):
        whole.setdefault(f, []).append(F.col(f"t{t}") == len(own))

    def judged(j: int, f: str) -> Column:
        own = [(t, g) for t, (name, g) in enumerate(model.templates) if name == f]
        named = reduce(Column.__or__, whole[f])
        covers = [F.col(f"t{t}") / F.lit(float(len(g))) for t, g in own]
        sure = [(c >= spec.min_cover) & (named | F.lit(len(g) >= spec.long_template and f not in NAMED_ONLY)) for c, (_, g) in zip(covers, own, strict=True)]
        return F.struct(F.lit(f).alias("family"), (1 / (1 + F.exp(F.get("__z", F.lit(k - 1)) - F.get("__z", F.lit(j))))).alias("probability"),
                        F.greatest(*covers, F.lit(0.0)).alias("cover"), reduce(Column.__or__, sure).alias("confirmed"), (F.get("__z", F.lit(j)) == F.array_max("__z")).alias("top"))

    scored = sums.withColumn("__z", z)
    found = scored.select(*group, F.explode(F.array(*[judged(j, f) for j, f in enumerate(model.families[:-1])])).alias("f"))
    found = found.where((F.col("f.top") | F.col("f.confirmed")) & (F.col("f.probability") >= spec.min_probability))
    best = F.max(F.struct(F.col("f.confirmed").alias("confirmed"), F.col("f.cover").alias("cover"), F.col("f.probability").alias("probability"), (-F.col("__window")).alias("w"))).alias("b")
    out = found.groupBy("__id", "__row", "__n", F.col("f.family").alias("family")).agg(best)
    return out.select(F.col("__id").alias(id_col), F.col("__n").alias("paragraph"), (-F.col("b.w") * spec.stride).alias("first_word"), "family", "b.probability", "b.cover", "b.confirmed")
