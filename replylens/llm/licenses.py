"""Licence scans with a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replylens.llm.common import map_batches

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices by label: a text of the licence, and phrases without which it is not this licence.
TEMPLATES = {
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        ["gnu general public license version 3"],
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        ["gnu general public license version 2"],
    ),
    "lgpl": (
        "is licensed under the GNU Lesser General Public License as published by the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", ["apache license version 2 0"]),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", ["cc by 4 0"]),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", ["cc by nc 4 0"]),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", ["cc by sa 4 0"]),
    "mit-release": ("Released under the MIT License.", ["under the mit license"]),
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        ["redistribution and use in source and binary forms", "with or without modification"],
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted",
        ["permission to use copy modify", "fee is hereby granted"],
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ["mozilla public license v 2 0"],
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        ["unencumbered software released into the public domain"],
    ),
    "reserved": ("All rights reserved.", ["all rights reserved"]),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        ["gnu affero general public license version 3"],
    ),
    "cc0-1.0": ("CC0 1.0 Universal", ["cc0 1 0"]),
    "cc-by-nd-4.0": ("Licensed under CC BY-ND 4.0.", ["cc by nd 4 0"]),
    "cc-by-nc-sa-4.0": ("Licensed under CC BY-NC-SA 4.0.", ["cc by nc sa 4 0"]),
    "cc-by-nc-nd-4.0": ("Licensed under CC BY-NC-ND 4.0.", ["cc by nc nd 4 0"]),
    "epl-2.0": ("Eclipse Public License 2.0", ["eclipse public license 2 0"]),
    "bsl-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", ["boost software license version 1 0"]),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software.",
        ["will the authors be held liable for any damages"],
    ),
}

# Identifiers of the SPDX list by label; suffixes as -only, -or-later and + are the same label.
IDENTIFIERS = {
    "agpl-3.0": ["AGPL-3.0"],
    "apache-2.0": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause", "0BSD"],
    "bsl-1.0": ["BSL-1.0"],
    "cc-by-4.0": ["CC-BY-4.0"],
    "cc-by-nc-4.0": ["CC-BY-NC-4.0"],
    "cc-by-nc-nd-4.0": ["CC-BY-NC-ND-4.0"],
    "cc-by-nc-sa-4.0": ["CC-BY-NC-SA-4.0"],
    "cc-by-nd-4.0": ["CC-BY-ND-4.0"],
    "cc-by-sa-4.0": ["CC-BY-SA-4.0"],
    "cc0-1.0": ["CC0-1.0"],
    "epl-2.0": ["EPL-2.0"],
    "gpl-2.0": ["GPL-2.0"],
    "gpl-3.0": ["GPL-3.0"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.0", "LGPL-2.1", "LGPL-3.0"],
    "mit-release": ["MIT"],
    "mpl-2.0": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
    "zlib": ["Zlib"],
}

# Further texts of the same labels: titles, file headers, other short notices, and the
# paragraphs of whole licence texts, each by itself as names and line numbers stand between.
TEXTS = {
    "gpl-3.0": [
        ("GNU GENERAL PUBLIC LICENSE Version 3", ["gnu general public license version 3"]),
        (
            "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
            ["gnu general public license is a free copyleft license for software"],
        ),
        (
            "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
            "either version 3 of the License, or (at your option) any later version",
            ["gnu general public license as published by", "version 3 of the license"],
        ),
        (
            "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
            "version 3 of the License",
            ["gnu general public license as published by", "version 3 of the license"],
        ),
    ],
    "gpl-2.0": [
        ("GNU GENERAL PUBLIC LICENSE Version 2", ["gnu general public license version 2"]),
        (
            "it under the terms of the GNU General Public License as published by the Free Software Foundation; "
            "either version 2 of the License, or (at your option) any later version",
            ["gnu general public license as published by", "version 2 of the license"],
        ),
        (
            "it under the terms of the GNU General Public License as published by the Free Software Foundation; "
            "version 2 of the License",
            ["gnu general public license as published by", "version 2 of the license"],
        ),
    ],
    "lgpl": [
        ("GNU LESSER GENERAL PUBLIC LICENSE Version", ["gnu lesser general public license version"]),
        ("GNU LIBRARY GENERAL PUBLIC LICENSE Version", ["gnu library general public license version"]),
        (
            "it under the terms of the GNU Library General Public License as published by the Free Software Foundation",
            ["gnu library general public license"],
        ),
    ],
    "apache-2.0": [
        ("Apache License Version 2.0", ["apache license version 2 0"]),
        ("Apache License 2.0", ["apache license 2 0"]),
        (
            "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
            "http://www.apache.org/licenses/LICENSE-2.0",
            ["you may not use this file except in compliance with the license", "apache org licenses license 2 0"],
        ),
    ],
    "cc-by-4.0": [
        ("Creative Commons Attribution 4.0 International", ["creative commons attribution 4 0"]),
    ],
    "cc-by-nc-4.0": [
        ("Creative Commons Attribution-NonCommercial 4.0 International", ["creative commons attribution noncommercial 4 0"]),
    ],
    "cc-by-sa-4.0": [
        ("Creative Commons Attribution-ShareAlike 4.0 International", ["creative commons attribution sharealike 4 0"]),
    ],
    "cc-by-nd-4.0": [
        ("Attribution-NoDerivatives 4.0 International", ["attribution noderivatives 4 0"]),
    ],
    "cc-by-nc-sa-4.0": [
        ("Attribution-NonCommercial-ShareAlike 4.0 International", ["attribution noncommercial sharealike 4 0"]),
    ],
    "cc-by-nc-nd-4.0": [
        ("Attribution-NonCommercial-NoDerivatives 4.0 International", ["attribution noncommercial noderivatives 4 0"]),
    ],
    "agpl-3.0": [
        ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3", ["gnu affero general public license version 3"]),
        (
            "it under the terms of the GNU Affero General Public License as published by the Free Software "
            "Foundation, either version 3 of the License, or (at your option) any later version",
            ["gnu affero general public license as published by", "version 3 of the license"],
        ),
    ],
    "epl-2.0": [("Eclipse Public License - v 2.0", ["eclipse public license v 2 0"])],
    "zlib": [
        (
            "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
            "and to alter it and redistribute it freely, subject to the following restrictions",
            ["permission is granted to anyone to use this software", "alter it and redistribute it freely"],
        ),
    ],
    "bsl-1.0": [
        (
            "Distributed under the Boost Software License, Version 1.0.",
            ["boost software license version 1 0"],
        ),
    ],
    "mit-notice": [
        (
            "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.",
            ["this permission notice shall be included in all copies or substantial portions of the software"],
        ),
    ],
    "mit-release": [("The MIT License (MIT)", ["the mit license mit"])],
    "bsd": [
        (
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer.",
            ["redistributions of source code must retain the above copyright notice"],
        ),
        (
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution.",
            ["redistributions in binary form must reproduce the above copyright notice"],
        ),
        ("BSD 3-Clause License", ["bsd 3 clause license"]),
        ("BSD 2-Clause License", ["bsd 2 clause license"]),
        (
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
            ["governed by a bsd style license"],
        ),
    ],
    "isc": [("ISC License Copyright", ["isc license"])],
    "mpl-2.0": [
        ("Mozilla Public License Version 2.0", ["mozilla public license version 2 0"]),
    ],
    "unlicense": [
        ("For more information, please refer to <https://unlicense.org>", ["unlicense org"]),
        (
            "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
            "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
            ["anyone is free to copy modify publish use compile sell or distribute this software"],
        ),
    ],
}


def with_identifiers(texts: dict, identifiers: dict) -> dict:
    """``texts`` and, for every identifier, the line of a file's head that names it."""
    lines = {
        label: [(f"SPDX-License-Identifier: {name}", [f"spdx license identifier {name}"]) for name in names]
        for label, names in identifiers.items()
    }
    return {label: texts.get(label, []) + lines.get(label, []) for label in [*texts, *lines]}


FORMS = with_identifiers(TEXTS, IDENTIFIERS)

RARE_WORDS = 4  # of each template, those that the corpus has least
MIN_SHARE = 0.6
SLACK = 8  # words by which a key phrase may lie outside the template's own length

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters (A-Z in lower case) and all characters beyond ASCII."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def forms_of(templates: dict, forms: dict) -> list[tuple[str, list[bytes], list[list[bytes]]]]:
    """Label, words and key phrases of every text of the labels of ``templates``."""
    texts = [(label, *form) for label in templates for form in [templates[label], *forms.get(label, [])]]
    return [(label, words_of(text), [words_of(k) for k in keys]) for label, text, keys in texts]


def fit_idf(
    df: DataFrame, text_col: str = "text", templates: dict = TEMPLATES, forms: dict = FORMS
) -> dict[bytes, float]:
    """Rarity, over all rows of ``df``, of every word that a template has.

    The number of those words is that of the templates, whatever the corpus holds.
    """
    vocabulary = {w for _, words, _ in forms_of(templates, forms) for w in words}

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for text in batch.column(0).to_pylist():
                found.update(vocabulary.intersection(words_of(text)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode() for w in found] + [""], pa.string()),
                    pa.array([*found.values(), batch.num_rows], pa.int64()),
                ],
                ["word", "n"],
            )

        return each

    counted = map_batches(df.select(text_col), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"].encode(): r["n"] for r in counted.collect()}
    rows = counts.get(b"", 0)
    return {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _starts(words: list[bytes], phrase: list[bytes], low: int = 0, high: int | None = None) -> list[int]:
    """Places where the phrase's words stand one after another."""
    high, n = len(words) if high is None else min(high, len(words)), len(phrase)
    found, at = [], max(low, 0) - 1
    while True:
        try:
            at = words.index(phrase[0], at + 1, high)
        except ValueError:
            return found
        if at + n <= high and words[at : at + n] == phrase:
            found.append(at)


class Scanner:
    """Base phrases and the method's labels of one text after another."""

    def __init__(
        self, idf: dict[bytes, float], phrases: dict, templates: dict, min_share: float, forms: dict = FORMS
    ) -> None:
        self.min_share = min_share
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.forms = forms_of(templates, forms)
        #: word -> (number of the form, place in it), for the rarest words of each form only
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, words, _) in enumerate(self.forms):
            rare = sorted(set(words), key=lambda w: (-idf.get(w, 0.0), w))[:RARE_WORDS]
            for place, word in enumerate(words):
                if word in rare:
                    self.index.setdefault(word, []).append((number, place))
        self.wanted = set(self.index) | {p[0] for p, _ in self.phrases}

    def matches(self, words: list[bytes]) -> dict[str, float]:
        """Verified labels with the share of the template's words that stand in their place."""
        votes: dict[tuple[int, int], set[bytes]] = {}
        index = self.index
        for at, word in enumerate(words):
            if word in index:
                for number, place in index[word]:
                    votes.setdefault((number, at - place), set()).add(word)
        found: dict[str, float] = {}
        for (number, start), agreeing in votes.items():
            label, template, keys = self.forms[number]
            if len(agreeing) < min(2, len(set(template))):
                continue
            window = words[max(start, 0) : start + len(template)]
            aligned = sum(a == b for a, b in zip(window, template[max(-start, 0) :]))
            share = aligned / len(template)
            if share < self.min_share or share <= found.get(label, 0.0):
                continue
            low, high = start - SLACK, start + len(template) + SLACK
            if all(_starts(words, key, low, high) for key in keys):
                found[label] = share
        return found

    def __call__(self, text: str | None) -> tuple:
        words = words_of(text)
        if self.wanted.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        starts: list[int] = []
        base: set[str] = set()
        for phrase, label in self.phrases:
            places = _starts(words, phrase)
            starts += places
            base.update([label] if places else [])
        own = self.matches(words)
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | set(own))),
            1.0 if base else max(own.values(), default=0.0),
        )


def scan_licenses(
    df: DataFrame,
    idf: dict[bytes, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict = PHRASES,
    templates: dict = TEMPLATES,
    min_share: float = MIN_SHARE,
    forms: dict = FORMS,
) -> DataFrame:
    """The columns of ``RESULT`` for every row of ``df``.

    A label has its template and further ``forms`` (title, file header, short notice,
    identifier, paragraph of the licence). One is a candidate where two of its rarest words
    stand at their relative places; it is accepted if ``min_share`` of its words do and each
    of its key phrases is there. An empty table gives no rows. ``score`` is 1 with a base phrase, else the largest such share, else 0. A null or
    empty text has no words and no labels. Repeated rows and null ids are passed on; other
    columns are not read.
    """

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        scan = Scanner(idf, phrases, templates, min_share, forms)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [column.split()[0] for column in RESULT.split(", ")]

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = [scan(text) for text in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

        return each

    return map_batches(df.select(id_col, text_col), make, RESULT)
