"""Licence scan: a trained paragraph classifier with template comparison.

A paragraph is a block of lines up to a blank line; comment signs at the start of
its lines are dropped, so wrapped and commented notices read as one.  It is judged
in windows of ``WINDOW`` words, each half over the next, so a notice counts whatever
stands beside it in a long line.  A window is described by its word 1- and
2-grams.  A multinomial logistic regression with an L1 penalty learns the licence
families from the notices below, thinned at random and set into other text, and
the class ``unknown`` from the corpus's own windows.  The probabilities are
calibrated on wordings and windows that the model has not seen: a temperature, and
the least licence probability at which hardly any ordinary window passes.

A window that passes is compared with the notices of every family that is not
improbable in it (``FAMILY_LEAST``): a family is confirmed by one of its names, by an
SPDX line with its identifier, or by a notice without a name of which enough word
pairs lie in the window, so a line that names two licences gets both.  A family
whose name stands in a narrower one's notices (``NARROWER``) gives way to it.  A
passing window without a confirmed family counts as ``unknown``.

Training sees the windows of about ``TRAIN_TEXTS`` texts, of these about
``TRAIN_WINDOWS``, both taken by a hash, so any partitioning takes the same ones.
Scoring reads every window of every text in one scan, by a look-up of the n-grams
with a weight; the model is some thousand n-grams whatever the input.

Defined results: null and empty texts have no paragraph and no family.  Equal
texts get equal results; families come sorted, so there are no ties.  Without any
corpus window (an empty table) there is nothing to learn ``unknown`` from, and
no family is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.names import quoted
from encore.session import materialize

TRAIN_TEXTS = 2_000        # expected texts of the sample
TRAIN_WINDOWS = 4_000      # expected windows of the sample
COPIES = 12                # thinned copies of each notice
LASSO = 0.0005
FALSE_ALARMS = 0.001       # share of unseen ordinary windows that may pass
FAMILY_LEAST = 1e-6        # least probability of a family that is compared
CONFIRM = 0.7              # share of a notice's word pairs in the window
WINDOW, STEP = 64, 32      # words

# Names of licences, their SPDX identifiers, and the wording of their notices.
LICENCES = {
    "apache-2.0": (["Apache License, Version 2.0", "Apache 2.0 license"], ["Apache-2.0"], [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."]),
    "mit": (["MIT License"], ["MIT"], [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."]),
    "gpl": (["GNU General Public License", "GNU GPL", "GPLv3", "GPLv2", "GPL-3.0", "GPL-2.0",
             "GNU General Public License, version 3", "GNU General Public License v2.0 or later"], ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
                                                           "GPL-3.0-or-later", "GPL-2.0", "GPL-3.0"], [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."]),
    "lgpl": (["GNU Lesser General Public License", "GNU LGPL", "LGPLv3", "LGPL-2.1", "GNU Lesser General Public License, version 2.1"],
             ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"], [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation"]),
    "agpl": (["GNU Affero General Public License", "GNU AGPL", "AGPL-3.0"], ["AGPL-3.0-only", "AGPL-3.0-or-later"], [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation"]),
    "gfdl": (["GNU Free Documentation License"], ["GFDL-1.3-or-later"], [
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.3 or any later version"]),
    "bsd": (["BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "BSD-style license"],
            ["BSD-3-Clause", "BSD-2-Clause"], [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."]),
    "isc": (["ISC License"], ["ISC"], [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]),
    "zlib": (["zlib License"], ["Zlib"], [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software."]),
    "boost": (["Boost Software License, Version 1.0"], ["BSL-1.0"], [
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt"]),
    "mpl-2.0": (["Mozilla Public License, version 2.0", "Mozilla Public License"], ["MPL-2.0"], [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"]),
    "epl": (["Eclipse Public License 2.0", "Eclipse Public License v1.0"], ["EPL-2.0", "EPL-1.0"], [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at"]),
    "cddl": (["Common Development and Distribution License"], ["CDDL-1.0", "CDDL-1.1"], [
        "The contents of this file are subject to the terms of the Common Development and Distribution License "
        "(the License). You may not use this file except in compliance with the License."]),
    "eupl": (["European Union Public Licence", "European Union Public License"], ["EUPL-1.2"], [
        "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission"]),
    "artistic-2.0": (["Artistic License 2.0", "Perl Artistic License"], ["Artistic-2.0"], []),
    "ofl": (["SIL Open Font License, Version 1.1"], ["OFL-1.1"], [
        "This Font Software is licensed under the SIL Open Font License, Version 1.1."]),
    "ms-pl": (["Microsoft Public License"], ["MS-PL"], []),
    "psf": (["Python Software Foundation License", "PSF License"], ["PSF-2.0"], []),
    "postgresql": (["PostgreSQL License"], ["PostgreSQL"], []),
    "openssl": (["OpenSSL License"], ["OpenSSL"], [
        "This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit"]),
    "unicode": (["Unicode License"], ["Unicode-3.0", "Unicode-DFS-2016"], []),
    "odbl": (["Open Database License"], ["ODbL-1.0"], [
        "This database is made available under the Open Database License"]),
    "wtfpl": (["Do What The F*ck You Want To Public License", "WTFPL"], ["WTFPL"], []),
    "unlicense": (["Unlicense"], ["Unlicense"], [
        "This is free and unencumbered software released into the public domain."]),
    "cc0": (["CC0 1.0 Universal", "Creative Commons Zero"], ["CC0-1.0"], [
        "This work is dedicated to the public domain under CC0 1.0 Universal."]),
    "cc-by": (["CC BY 4.0", "Creative Commons Attribution 4.0 International License",
               "Creative Commons Attribution 3.0 License"], ["CC-BY-4.0", "CC-BY-3.0"], []),
    "cc-by-sa": (["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
                 ["CC-BY-SA-4.0", "CC-BY-SA-3.0"], []),
    "cc-by-nd": (["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
                 ["CC-BY-ND-4.0"], []),
    "cc-by-nc": (["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
                 ["CC-BY-NC-4.0"], []),
    "cc-by-nc-sa": (["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
                     "License"], ["CC-BY-NC-SA-4.0"], []),
    "cc-by-nc-nd": (["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
                     "License"], ["CC-BY-NC-ND-4.0"], []),
    "public-domain": (["public domain"], [], ["This work has been released into the public domain by its author."]),
    "all-rights-reserved": ([], [], ["All rights reserved.", "Copyright 2024 the authors. All rights reserved."]),
}
WAYS = ["Licensed under the {}.", "Released under the {}.", "This project is licensed under the terms of the {}.",
        "This work is licensed under a {}.", "available under the {}"]
UNSEEN_WAYS = ["Distributed under the terms of the {}.", "You may use it under {}"]      # these only calibrate
# a family whose name stands in the notices of a narrower one
NARROWER = {"public-domain": ["cc0", "unlicense"]}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *LICENCES]
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
MARKS = re.compile(r"^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--)?[ \t]*", re.M)
BLANK = re.compile(r"\n[ \t\r*#/;%-]*\n")


def notices(family: str, ways: list[str] = WAYS) -> list[str]:
    names, spdx, texts = LICENCES[family]
    named = [w.format(n) for n in names for w in ways]
    return named + ([f"SPDX-License-Identifier: {i}" for i in spdx] + texts if ways is WAYS else [])


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def paragraphs(text: str | None) -> list[list[str]]:
    """The words of each paragraph that has any."""
    found = [words(MARKS.sub("", p)) for p in BLANK.split(text or "")]
    return [p for p in found if p]


def windows(n: int) -> list[tuple[int, int]]:
    """Begin and end of the windows of a paragraph of ``n`` words."""
    return [(at, min(at + WINDOW, n)) for at in range(0, max(1, n - WINDOW + STEP), STEP)]


def grams(w: list[str]) -> list[str]:
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def _pairs(w: list[str]) -> frozenset[str]:
    return frozenset(f"{a} {b}" for a, b in zip(w, w[1:]))


def _said(w: list[str], part: list[str]) -> bool:
    """Are the words there in a row?"""
    n = len(part)
    return any(w[i:i + n] == part for i in range(len(w) - n + 1) if w[i] == part[0])


NAMES = {f: [words(n) for n in names] for f, (names, _, _) in LICENCES.items()}
IDENTIFIERS = {f: [words(i) for i in spdx] for f, (_, spdx, _) in LICENCES.items()}
SPDX = ["spdx", "license", "identifier"]
# a notice that holds a name of its family counts only together with one of its names
TEXTS = {f: [(_pairs(words(t)), any(_said(words(t), n) for n in NAMES[f])) for t in texts]
         for f, (_, _, texts) in LICENCES.items()}


def confirmed(w: list[str], family: str) -> bool:
    """Is the family named in these words, or does one of its notices lie in them?"""
    named = any(_said(w, n) for n in NAMES[family])
    if named or (_said(w, SPDX) and any(_said(w, i) for i in IDENTIFIERS[family])):
        return True
    mine = _pairs(w)
    return any(len(t & mine) >= CONFIRM * len(t) for t, by_name in TEXTS[family] if not by_name)


def confirmed_families(w: list[str], families: list[str]) -> list[str]:
    found = [f for f in families if confirmed(w, f)]
    return [f for f in found if not any(n in found for n in NARROWER.get(f, []))]


class Model:
    """Weights by n-gram (a row of classes), bias, temperature, least probability."""

    def __init__(self, weights: dict[str, np.ndarray], bias: np.ndarray):
        self.place = {g: i for i, g in enumerate(weights)}
        self.matrix = np.vstack([*weights.values(), np.zeros_like(bias)])      # the last row: no weight
        self.bias = bias
        self.temperature, self.least = 1.0, 0.5

    def logits(self, w: list[str], spans: list[tuple[int, int]]) -> np.ndarray:
        """A row for each span of the words."""
        get, none = self.place.get, len(self.place)
        one = np.fromiter((get(x, none) for x in w), np.int64, len(w))
        two = np.fromiter((get(f"{a} {b}", none) for a, b in zip(w, w[1:])), np.int64, max(len(w) - 1, 0))
        sums = lambda rows: np.vstack([np.zeros_like(self.bias), np.cumsum(self.matrix[rows], axis=0)])
        s1, s2 = sums(one), sums(two)
        a, b = np.array(spans).T
        return self.bias + s1[b] - s1[a] + s2[np.maximum(b - 1, a)] - s2[a]

    def probabilities(self, z: np.ndarray) -> np.ndarray:
        e = np.exp((z - z.max(axis=-1, keepdims=True)) / self.temperature)
        return e / e.sum(axis=-1, keepdims=True)

    def families(self, w: list[str]) -> list[str] | None:
        """Confirmed families of a paragraph, ``[unknown]`` where a window passes
        without one, or None for an ordinary paragraph."""
        spans = windows(len(w))
        p = self.probabilities(self.logits(w, spans))
        found: set[str] = set()
        passing = np.flatnonzero(1.0 - p[:, 0] >= self.least)
        for k in passing:
            a, b = spans[k]
            likely = [FAMILIES[i] for i in np.flatnonzero(p[k, 1:] >= FAMILY_LEAST) + 1]
            found.update(confirmed_families(w[a:b], likely))
        return (sorted(found) or [UNKNOWN]) if len(passing) else None


def _set_into(notice: list[str], ordinary: list[list[str]], rng) -> list[str]:
    """A thinned notice, alone or with ordinary words before and after it."""
    keep = [x for x in notice if rng.random() > 0.06] or notice
    if ordinary and rng.random() < 0.6:
        other = ordinary[int(rng.integers(len(ordinary)))]
        room = max(0, WINDOW - len(keep))
        n = int(rng.integers(0, room + 1))
        k = int(rng.integers(0, n + 1))
        keep = other[:k] + keep + other[k:n]
    return keep[:WINDOW]


def _examples(ordinary: list[list[str]], ways: list[str], copies: int, seed: int) -> list[tuple[int, list[str]]]:
    rng = np.random.default_rng(seed)
    out = [(0, w) for w in ordinary]
    for label, family in enumerate(LICENCES, 1):
        for text in notices(family, ways):
            out += [(label, _set_into(words(text), ordinary, rng)) for _ in range(copies)]
    order = rng.permutation(len(out))
    return [out[i] for i in order]


def _sample(docs: DataFrame, text_col: str, train_texts: int, train_windows: int) -> list[list[str]]:
    """About ``train_windows`` ordinary windows, by hash."""
    text = docs[quoted(text_col)]
    whole = 1 << 40
    share = int(min(1.0, train_texts / max(1, docs.count())) * whole)
    texts = docs.select(text.alias("_t")).where(F.col("_t").isNotNull() & (F.pmod(F.xxhash64("_t"), F.lit(whole)) < F.lit(share)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [" ".join(w[a:b]) for t in batch.column("_t").to_pylist() for w in paragraphs(t) for a, b in windows(len(w))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["w"])
    found = materialize(texts.mapInArrow(cut, "w string"), "windows")
    share = int(min(1.0, train_windows / max(1, found.count())) * whole)
    rows = found.where(F.pmod(F.xxhash64("w", F.lit(1)), F.lit(whole)) < F.lit(share)).orderBy("w").collect()
    return [r["w"].split() for r in rows]


def fit(docs: DataFrame, text_col: str = "text", train_texts: int = TRAIN_TEXTS,
        train_windows: int = TRAIN_WINDOWS) -> Model | None:
    spark = docs.sparkSession
    # what matches a notice is no example of an ordinary window
    ordinary = [w for w in _sample(docs, text_col, train_texts, train_windows) if not any(confirmed(w, f) for f in LICENCES)]
    if not ordinary:
        return None
    # every fifth window is kept back for calibration, with wordings that do not train
    seen, unseen = [w for i, w in enumerate(ordinary) if i % 5], ordinary[::5]
    rows = [(y, grams(w)) for y, w in _examples(seen, WAYS, COPIES, 5)]
    train = materialize(spark.createDataFrame(rows, "label int, grams array<string>").repartition(4), "train")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=50_000, minDF=2.0).fit(train)
    model = LogisticRegression(family="multinomial", regParam=LASSO, elasticNetParam=1.0, maxIter=40,
                               standardization=False).fit(
        materialize(vectors.transform(train).select("features", "label"), "train"))
    matrix = model.coefficientMatrix.toArray()
    if matrix.shape[0] < len(FAMILIES):
        raise ValueError("a licence family has no training example")
    weights = {g: matrix[:, i] for i, g in enumerate(vectors.vocabulary) if np.any(matrix[:, i])}
    return _calibrated(Model(weights, model.interceptVector.toArray()), _examples(unseen, UNSEEN_WAYS, 4, 6))


def _calibrated(model: Model, held_out: list[tuple[int, list[str]]]) -> Model:
    y = np.array([label for label, _ in held_out])
    z = np.vstack([model.logits(w, [(0, len(w))]) for _, w in held_out])

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(z)[np.arange(len(y)), y], 1e-12)).sum()

    model.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=loss)
    alarms = np.sort(1.0 - model.probabilities(z)[y == 0, 0])
    if len(alarms):
        model.least = float(np.clip(alarms[int((1.0 - FALSE_ALARMS) * (len(alarms) - 1))], 0.1, 0.9))
    return model


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``(id_col, families, n_license_paragraphs, n_unknown)`` of every text:
    the sorted confirmed families, the paragraphs that carry one, and those
    that look like a licence of no known family."""
    model = model or fit(docs, text_col)
    rows = docs.select(docs[quoted(id_col)].alias("_id"), docs[quoted(text_col)].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families, n, unknown = [], [], []
            for text in batch.column("_text"):
                found = [model.families(p) for p in paragraphs(text.as_py())] if model else []
                known = [f for f in found if f and f != [UNKNOWN]]
                families.append(sorted({x for f in known for x in f}))
                n.append(len(known))
                unknown.append(found.count([UNKNOWN]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(families, pa.list_(pa.string())), pa.array(n, pa.int64()),
                 pa.array(unknown, pa.int64())], names=["_id", "families", "n_license_paragraphs", "n_unknown"])
    known = T.StructType.fromDDL("families array<string>, n_license_paragraphs long, n_unknown long")
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), *known.fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def op9_license_scan(spark, d):
    return scan(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op9_license_scan": op9_license_scan}
ORACLE: dict[str, str] = {}
