import re
from collections import Counter

import pytest

from replylens.llm import licenses
from tests.llm.helpers import DOCUMENTS, clash, hard_rows, make_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words, starts, labels = re.findall(WORD, (text or "").translate(LOWER)), [], set()
    for phrase, label in licenses.PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    "MIT License, mit-license; the MIT\nLICENSE", "apache apache license license", "CC BY-NC cc, by CC-BY", "ccby cc bye",
    "GNU General Public License " * 3, "gnu general public", "the mit licenses", "é mit license ñ",
    f"{make_text(1, 200)} " + licenses.TEMPLATES["mit-notice"][0] + f" {make_text(2, 50)}",
    licenses.TEMPLATES["bsd"][0].upper(),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_base_places_match_brute_force(spark, documents):
    rows = hard_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    rows += [tuple(r) for r in documents.collect()]
    df = clash(spark.createDataFrame(rows, DOCUMENTS))
    found = licenses.scan_licenses(df, licenses.fit_idf(df)).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter((doc, *base(text)) for doc, text, *_ in rows)
    for r in found:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("label", licenses.TEMPLATES)
def test_every_template_is_found(label):
    scan = licenses.Scanner({}, licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_SHARE)
    text = f"{make_text(7, 30)}\n{licenses.TEMPLATES[label][0]}\n{make_text(8, 30)}"
    assert label in scan(text)[5].split(",")
    assert label not in scan(make_text(7, 60))[5].split(",")


def test_positions_and_key_phrases_decide():
    scan = licenses.Scanner({}, licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_SHARE)
    words = licenses.TEMPLATES["mpl-2.0"][0].split()
    assert scan(" ".join(reversed(words)))[5] == ""
    assert scan(licenses.TEMPLATES["mpl-2.0"][0].replace("Mozilla", "Other"))[5] == ""


def test_rarity_is_counted_over_all_rows(spark):
    rows = [(i, "license apache" if i < 2 else "license", None, None, None) for i in range(10)]
    idf = licenses.fit_idf(spark.createDataFrame(rows, DOCUMENTS))
    assert idf[b"apache"] > idf[b"license"] and idf[b"mozilla"] > idf[b"apache"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert licenses.scan_licenses(empty, licenses.fit_idf(empty)).count() == 0


GPL = (
    "This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General "
    "Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n"
    "# (at your option) any later version.\n"
)


@pytest.mark.parametrize(
    "text, label",
    [
        ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\nCopyright (C) 2007", "gpl-3.0"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\nCopyright (C) 1989", "gpl-2.0"),
        (GPL.format(3), "gpl-3.0"),
        (GPL.format(2), "gpl-2.0"),
        ("under the terms of the GNU General Public License version 2 as published by the Free", "gpl-2.0"),
        ("the GNU General Public License as published by the Free Software Foundation; version 2 of the License.", "gpl-2.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "lgpl"),
        ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", "apache-2.0"),
        ("available under Apache License 2.0 from", "apache-2.0"),
        ("a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
        ("Creative Commons Attribution-NonCommercial 4.0 International Public License", "cc-by-nc-4.0"),
        ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0"),
        ("The MIT License (MIT)\nCopyright (c) 2015", "mit-release"),
        ("BSD 3-Clause License\nCopyright (c) 2017", "bsd"),
        ("ISC License\n\nCopyright (c) 2004", "isc"),
        ("Mozilla Public License Version 2.0\n1. Definitions", "mpl-2.0"),
        ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "agpl-3.0"),
        (GPL.format(3).replace("General", "Affero General"), "agpl-3.0"),
        ("CC0 1.0 Universal", "cc0-1.0"),
        ("Eclipse Public License 2.0", "epl-2.0"),
        ("Eclipse Public License - v 2.0", "epl-2.0"),
        ("Attribution-NonCommercial-NoDerivatives 4.0", "cc-by-nc-nd-4.0"),
        ("Attribution-NonCommercial-ShareAlike 4.0 International", "cc-by-nc-sa-4.0"),
        ("CC BY-ND 4.0", "cc-by-nd-4.0"),
        ("CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"),
        ("// SPDX-License-Identifier: Apache-2.0\n", "apache-2.0"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later\n", "gpl-3.0"),
        ("/* SPDX-License-Identifier: GPL-2.0+ */", "gpl-2.0"),
        ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl"),
        ("SPDX-License-Identifier: MIT", "mit-release"),
        ("Distributed under the Boost Software License, Version 1.0. (See", "bsl-1.0"),
    ],
)
def test_titles_and_file_headers(text, label):
    scan = licenses.Scanner({}, licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_SHARE)
    labels = scan(f"{make_text(7, 30)}\n{text}\n{make_text(8, 30)}")[5].split(",")
    assert set(labels) - set(licenses.PHRASES.values()) == {label}


def test_other_licences_of_the_family_do_not_match():
    scan = licenses.Scanner({}, licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_SHARE)
    affero = GPL.format(3).replace("General", "Affero General")
    for text in (affero, "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", GPL.format(1)):
        assert not {"gpl-2.0", "gpl-3.0", "lgpl"} & set(scan(text)[5].split(","))


LICENSE_FILES = {
    "mit-notice": """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.""",
    "bsd": """Copyright (c) 2019, Some Body

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.""",
    "apache-2.0": """you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing""",
    "zlib": """Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "unlicense": """Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
}


@pytest.mark.parametrize("label", LICENSE_FILES)
def test_whole_texts_without_a_title(label):
    scan = licenses.Scanner({}, licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_SHARE)
    assert scan(LICENSE_FILES[label])[5] == label


def by_brute_force(text, idf):
    """Labels of the method and their largest share, by trying every place for every form."""
    words, found = licenses.words_of(text), {}
    for label, form, keys in licenses.forms_of(licenses.TEMPLATES, licenses.FORMS):
        rare = set(sorted(set(form), key=lambda w: (-idf.get(w, 0.0), w))[: licenses.RARE_WORDS])
        for start in range(-len(form), len(words)):
            here = [w for i, w in enumerate(form) if 0 <= start + i < len(words) and words[start + i] == w]
            near = words[max(0, start - licenses.SLACK) : max(0, start + len(form) + licenses.SLACK)]
            joined = b" " + b" ".join(near) + b" "
            if len(rare & set(here)) >= min(2, len(set(form))) and len(here) / len(form) >= licenses.MIN_SHARE:
                if all(b" " + b" ".join(key) + b" " in joined for key in keys):
                    found[label] = max(found.get(label, 0), len(here) / len(form))
    return found


def test_labels_and_score_match_brute_force(spark, documents):
    texts = [f"{make_text(i, 9)} {text} {make_text(-i, 9)}" for i, text in enumerate(LICENSE_FILES.values())]
    texts += [t.replace("the", "a") for t in texts] + TEXTS + [GPL.format(2)[:140], "SPDX-License-Identifier: BSD"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [tuple(r) for r in documents.limit(120).collect()]
    df = spark.createDataFrame(rows, DOCUMENTS)
    idf = licenses.fit_idf(df)
    found = {(r["doc_id"], r["n_words"]): r for r in licenses.scan_licenses(df, idf).collect()}
    labelled = 0
    for doc, text, *_ in rows:
        r, own = found[doc, len(licenses.words_of(text))], by_brute_force(text, idf)
        labels = set(filter(None, r["base_labels"].split(","))) | set(own)
        assert r["labels"] == ",".join(sorted(labels))
        assert r["score"] == pytest.approx(1.0 if r["base_labels"] else max(own.values(), default=0.0))
        labelled += bool(own)
    assert labelled >= len(LICENSE_FILES)
