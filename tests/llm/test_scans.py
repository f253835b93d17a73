"""Licence scan, toxicity and language identification."""

import random

import numpy as np
import pytest

from quarry.llm import langid as L
from quarry.llm import licenses as S
from quarry.llm import toxicity as X
from tests.llm.conftest import ENGLISH, GERMAN, fold, sentence

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""


@pytest.mark.parametrize("text, want", [
    (MIT, ["MIT"]), (GPL, ["GPL-3-or-later"]),
    ("bla bla\nReleased under the MIT License.\nfoo", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("text\nLicensed under CC BY-NC 4.0.\nmore", ["CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3"]),
    ("Released under the MIT License.\nLicensed under CC BY 4.0.", ["CC-BY-4.0", "MIT"]),
    ("license to kill. The licence of poets!", []), ("", []), (None, []),
])
def test_known_texts(spark, text, want):
    r = S.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["licenses"] == want and r["n_licenses"] == len(want)
    for span in r["spans"]:
        assert S.normalise(text[span["start"]:span["end"]])


def test_rules_are_ordered_and_their_sentences_too():
    rules = S.expand_rules()
    at = lambda *ids: [(x, i, 0, 0) for i, x in enumerate(ids)]
    assert S.match_rules(at("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse"), rules) == (["BSD-3-Clause"], 0)
    assert S.match_rules(at("bsd-use", "bsd-source", "bsd-binary"), rules) == (["BSD-2-Clause"], 0)
    assert S.match_rules(at("bsd-source", "bsd-use"), rules) == ([], 2)
    far = [("bsd-use", 0, 0, 0), ("bsd-source", 1, 0, 0), ("bsd-binary", 9, 0, 0)]
    assert S.match_rules(far, rules) == ([], 3)


def test_scan_of_awkward_documents(odd_docs, doc_rows, no_docs):
    assert S.scan_licenses(odd_docs).count() == len(doc_rows)
    assert S.scan_licenses(no_docs).count() == 0


FREE = "This {} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\nthe Free Software Foundation{} either version {} of the License, or\n(at your option) any later version."


@pytest.mark.parametrize(("text", "want"), [
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ('The contents of this file are subject to the Mozilla Public License Version\n1.1 (the "License"); you may not use this file except in compliance with\nthe License. You may obtain a copy of the License at\nhttp://www.mozilla.org/MPL/', "MPL-1.1"),
    (FREE.format("program", ";", "", ";", 2), "GPL-2-or-later"),
    (FREE.format("program", ":", "", ",", 3), "GPL-3-or-later"),
    (FREE.format("library", ";", "Lesser ", ";", 2.1), "LGPL-2.1-or-later"),
    (FREE.format("program", ":", "Lesser ", ",", 3), "LGPL-3-or-later"),
    (FREE.format("program", ":", "Affero ", ",", 3), "AGPL-3-or-later"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2.", "GPL-2"),
])
def test_standard_headers_with_marks_inside(spark, text, want):
    r = S.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r["licenses"], r["unmatched"]) == ([want], False)


def test_lines_with_a_licence_are_all_found(spark, tmp_path):
    """Against a search for the four lines that the generated documents carry."""
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["licenses"] for r in S.scan_licenses(docs).collect()}
    rows = docs.collect()
    assert any(got.values())
    for r in rows:
        want = sorted({v for k, v in lines.items() if k in r["text"].split("\n")})
        assert [x for x in got[r["doc_id"]] if x != "All-Rights-Reserved"] == want, r["doc_id"]
        assert ("All-Rights-Reserved" in got[r["doc_id"]]) == ("All rights reserved" in r["text"])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distances():
    terms = {"idiot": 1.0, "moron": 1.0, "scum": 1.0, "worthless": 1.0, "lowe*": 1.0}
    auto = X.Automaton(terms)
    rng = random.Random(1)
    letters = "abdeilmnorstuwz"
    words = {"idiot", "idot", "idiott", "idoit", "ldiot", "scum", "scun", "moron", "mroon", "lowe", "lower", "lowest", "love", "worthles", "wortless", "worthlessss", "i", "id"}
    for w in ("idiot", "moron", "worthless", "scum"):
        for _ in range(150):
            x = list(w)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(x) + 1)
                x[at:at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
            words.add("".join(x))
    words = sorted(w for w in words if w)
    buf = (" ".join(words) + " ").encode()
    b, starts, ends = X.split_words(buf)
    term, kind = auto.run(b, starts, ends)
    for w, t, k in zip(words, term.tolist(), kind.tolist(), strict=True):
        if w.startswith("lowe"):
            want = X.STEM_HIT
        else:
            near = [edits(w, x) for x in terms if not x.endswith("*") and (len(x) >= X.EDIT_FROM or w == x)]
            want = X.EXACT if w in terms else X.FUZZY if min(near) <= 1 else X.NONE
        assert k == want, (w, auto.keys[t - 1])


def toxic_corpus(n=420):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, ENGLISH, rng.randint(10, 40))
        toxic = i % 4 == 0
        w = text.split()
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["blorgle", "snivelworm", "gruntpig"]))
        elif i % 8 == 1:  # quoted, not abusive
            at = rng.randrange(len(w))
            w[at:at] = ["the", "word", '"' + rng.choice(["blorgle", "gruntpig"]) + '"', "quoted"]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_terms_inside_a_stem_keep_their_edits():
    auto = X.Automaton({"loser": 2.0, "lose*": 1.0})
    b, starts, ends = X.split_words(b"loser looser l0ser losr lose losesueno los closed")
    term, kind = auto.run(b, starts, ends)
    assert [(auto.keys[i - 1] if i else None, k) for i, k in zip(term, kind, strict=True)] == [
        ("loser", X.EXACT), *[("loser", X.FUZZY)] * 4, ("lose*", X.STEM_HIT), (None, X.NONE), (None, X.NONE)]


def test_a_stem_needs_more_than_its_strongest_word(spark):
    odd = ["losesu", "losena", "loseto", "losemi"]
    # the filler words differ, so no text is a near copy of another
    rows = [(int(i < 90), " ".join(f"w{i}x{j}" for j in range(8)) + (" loser" if i < 80 else f" {odd[i % 4]}" if i < 88 or i in (100, 101) else "")) for i in range(400)]
    words = X.learn_lexicon(spark.createDataFrame(rows, "toxic int, text string"), 90, 310)
    assert "loser" in words and not any(w.endswith("*") and "loser".startswith(w[:-1]) for w in words)


def test_toxicity_learns_terms_misspellings_and_quotation(spark):
    rows, labels = toxic_corpus()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in X.toxicity(docs, marks).collect()}
    held = [i for i in range(len(rows)) if fold(i, 3) == 1]
    assert all(out[i]["held_out"] == (fold(i, 3) == 1) for i in out)
    right = np.mean([out[i]["predicted"] == labels[i][2] for i in held])
    assert right > 0.93
    model = X.train(docs, marks)
    plain, typo, clean = model.score([b"the man is a snivelworm and a gruntpig", b"the man is a snivelworn and a gruntpigg", b"the man is a friend and a neighbour"])
    assert plain > 0.7 and typo > clean


def test_toxicity_of_awkward_documents(spark, odd_docs, doc_rows, no_docs):
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(60)] + [(None, 1, 1), (9, 1, None), (9, 1, 0)], "doc_id long, quality int, toxic int")
    out = X.toxicity(odd_docs, labels).collect()
    assert len(out) == len(doc_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert X.toxicity(no_docs, labels).count() == 0
    assert {r["score"] for r in X.toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}


def test_presence_against_sets():
    text = "Straße ÉTÉ été x1y 2" * 3
    got = L.presence([text.encode(), b"", None])
    assert got[0].any() and got[1].sum() == got[2].sum() == L.presence([b""])[0].sum()
    assert (L.presence(["ÉTÉ".encode()]) == L.presence(["été".encode()])).all()
    assert (L.presence([b"Hello, World"]) == L.presence([b"hello  world"])).mean() > 0.99


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"word{i % 400}" for i in range(3000)).encode()
    whole = L.presence([text])
    monkeypatch.setattr(L, "PIECE", 97)
    assert (whole <= L.presence([text])).all()


def test_languages(spark, odd_docs, doc_rows, no_docs):
    rng = random.Random(2)
    rows = [(i, sentence(rng, ENGLISH if i % 2 else GERMAN, 30), "en" if i % 2 else "de") for i in range(120)] + [(900, "the of and", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert len(out) == len(rows)
    assert np.mean([out[i]["lang_pred"] == lang for i, _, lang in rows if lang and fold(i, 3) == 1]) > 0.95
    odd = L.identify(odd_docs).collect()
    assert len(odd) == len(doc_rows)
    for r in odd:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (fold(r["doc_id"], 3) == 1)
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (200, 201, 202, 205))
    assert L.identify(no_docs).count() == 0
    bare = L.identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r["lang_pred"] for r in bare} == {"und"}


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
THIRD = """3. Neither the name of {} nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement: This product includes software
   developed by the University of California, Berkeley and its contributors.
4. Neither the name of the University nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.
"""


def scanned(spark, texts):
    out = S.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)).collect()
    return [(r["licenses"], r["unmatched"]) for r in sorted(out, key=lambda r: r["doc_id"])]


def test_usual_texts_in_their_usual_wording(spark):
    cases = {
        BSD.format(""): "BSD-2-Clause", BSD.format(THIRD.format("the copyright holder")): "BSD-3-Clause", BSD.format(THIRD.format("Example Org. Inc.")): "BSD-3-Clause",
        BSD.format(THIRD.format("the University of California, Berkeley")): "BSD-3-Clause", BSD.format(ADVERT): "BSD-4-Clause",
        "// SPDX-License-Identifier: Apache-2.0\nint x;": "Apache-2.0", "# SPDX-License-Identifier: MIT": "MIT", "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2-or-later",
        "SPDX-License-Identifier: LGPL-2.1+": "LGPL-2.1-or-later", "SPDX-License-Identifier: GPL-3.0-only": "GPL-3",
        "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/": "Apache-2.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n": "GPL-3",
        "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991": "GPL-2", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999": "LGPL-2.1",
        "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007": "AGPL-3", "Mozilla Public License Version 2.0": "MPL-2.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "Licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
        "Boost Software License - Version 1.0 - August 17th, 2003": "BSL-1.0", "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License v2.0": None,
        "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0": "EPL-2.0", "Eclipse Public License - v 1.0": "EPL-1.0",
        "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not\nclaim that you wrote it.": "Zlib",
        "Licensed to the Apache Software Foundation (ASF) under one or more\ncontributor license agreements.  See the NOTICE file.\nThe ASF licenses this file to You under the Apache License, Version 2.0\n(the \"License\"); you may not use this file except in compliance with\nthe License.  You may obtain a copy of the License at\n": "Apache-2.0",
        MIT.replace("\n\nTHE SOFTWARE IS", "\n\nThe Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS"): "JSON",
    }
    for (text, want), got in zip(cases.items(), scanned(spark, cases)):
        if want:
            assert got[0] == [want], (text, got)
    both = scanned(spark, ["SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0", "SPDX-License-Identifier: Own-1.0"])
    assert both == [(["Apache-2.0", "GPL-2", "MIT"], False), ([], True)]


def test_an_unknown_clause_gives_no_weaker_licence(spark):
    altered = [BSD.format(THIRD.format("the copyright holder").replace("promote products", "advertise products")), BSD.format("3. You must send us a postcard.\n"),
               BSD.format(ADVERT.replace("display the following", "hide the following")), MIT.replace("\n\nTHE SOFTWARE IS", "\n\nThe Software shall not be used on Sundays.\n\nTHE SOFTWARE IS")]
    for (licenses, unmatched), text in zip(scanned(spark, altered), altered):
        assert licenses == [] and unmatched, text


def test_every_rule_by_its_canonical_text_and_with_an_altered_clause(spark):
    wording = {}
    for ident, text, versions in S.SENTENCES:
        for v in versions or ("",):
            wording.setdefault(ident.replace("{v}", v), text.replace("{v}", v).replace("{name}", "example org"))
    cases, broken = [], []
    for name, ids in S.expand_rules():
        ids = [i.removeprefix("=") for i in ids if i != "|"]
        if not all(i in wording for i in ids):
            continue  # a version that no sentence has
        lines = [wording[i] for i in ids]
        cases.append((name, ". \n".join(lines) + "."))
        for k in range(len(lines)):
            words = lines[k].split()
            words[len(words) // 2] = "zebra"
            broken.append((name, ". \n".join([*lines[:k], " ".join(words), *lines[k + 1:]]) + "."))
    assert len({n for n, _ in cases}) > 50
    for (name, text), got in zip(cases, scanned(spark, [t for _, t in cases])):
        assert got == ([name], False), (name, text, got)
    same = {"JSON": {"JSON", "MIT"}}  # its name line alone names MIT
    for (name, text), (licenses, _) in zip(broken, scanned(spark, [t for _, t in broken])):
        assert set(licenses) <= same.get(name, {name}), (name, text, licenses)
        if len(text.split(". \n")) == 1:
            assert licenses == [], (name, text)


def test_a_split_lexicon_finds_what_one_automaton_finds():
    rng = random.Random(4)
    terms = {"".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 9))): rng.random() for _ in range(120)} | {"abca*": 1.0, "zz" * 40: 2.0}
    words = [w for t in terms for w in (t.rstrip("*"), t.rstrip("*")[1:], t.rstrip("*") + "x", t[:2] + "q" + t[3:])] + ["abcazzz", "nothing"]
    buf = " ".join(words).encode()
    whole, split = X.Automaton(terms), X.Lexicon(terms, 64)
    assert len(split.parts) > 5 and sorted(split.keys) == sorted(whole.keys)
    (t1, k1), (t2, k2) = whole.run(*X.split_words(buf)), split.run(*X.split_words(buf))
    assert (k1 == k2).all()
    name = lambda auto, t: "" if t == 0 else auto.keys[t - 1]
    for a, b, k in zip(t1, t2, k1):
        assert (a == 0) == (b == 0)
        if k in (X.EXACT, X.STEM_HIT):
            assert name(whole, a) == name(split, b)
    assert X.Lexicon({}).run(*X.split_words(buf))[0].sum() == 0


def test_one_case_folding_for_learning_and_scoring(spark):
    clean = ["слово дома тихо город", "река лес поле гора", "The calm river runs by"]
    rows = [(i, f"{clean[i % 3]} {i}", 0) for i in range(0, 300)] + [(1000 + i, f"{clean[i % 2]} {'дурак' if i % 2 else 'ДУРАК'} {i * 7}", 1) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    model = X.train(docs, labels)
    assert "дурак" in model.auto.keys
    probe = spark.createDataFrame([(1, "дом ДУРАК лес"), (2, "дом дурак лес"), (3, "дом Дурак лес"), (4, "дом тихо лес")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in X.predict(probe, model).collect()}
    assert got[1] == got[2] == got[3] > 0.7 > got[4]
