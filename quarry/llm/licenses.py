"""Licence scan by sentence rules (operator 4).

A text is cut into sentences at line ends and sentence marks. Each sentence is
normalised (A-Z lower-cased, everything but letters, digits and the dots of
version numbers becomes one blank) and looked up among known licence
sentences; lines that a licence text was wrapped at are joined again when the
joined sentence is known, and parts at a mark inside a known sentence likewise. The identifiers found, in text order, are matched
against ordered rules: at each position the first rule whose identifiers
follow one another there wins and takes them; up to GAP other sentences may
stand before an identifier, none before one marked ``=``. A rule that ends
with ``|`` holds only if a known sentence or the end follows: with a clause
that is not known it is no licence rather than a weaker one. ``{name}`` in a sentence
stands for up to NAME_WORDS words (a holder's name). Numbers and letters of
lists are not part of a sentence. SPDX lines give one identifier per licence
named. Sentences and rules are small constants, so the scan is one pass over
the texts with no shuffle.

Defined results: null or empty text has no sentences and no licences; a
sentence that names a licence but belongs to no rule, or an SPDX name that no
rule gives, is reported as ``unmatched``; repeated rows are scanned each; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Well-known licence sentences, normalised; {v} stands for each version listed.
SENTENCES = [
    ("mit-name", "released under the mit license", ()),
    ("mit-name", "licensed under the mit license", ()),
    ("mit-name", "this project is licensed under the mit license", ()),
    ("mit-name", "the mit license mit", ()),
    ("mit-name", "mit license", ()),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", ()),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ()),
    ("as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ()),
    ("apache-name:{v}", "licensed under the apache license version {v}", ("1.0", "1.1", "2.0")),
    ("apache-name:{v}", "released under the apache license version {v}", ("1.0", "1.1", "2.0")),
    ("apache-name:{v}", "licensed under the apache license version {v} the license", ("1.0", "1.1", "2.0")),
    ("apache-comply", "you may not use this file except in compliance with the license", ()),
    ("apache-copy", "you may obtain a copy of the license at", ()),
    ("gpl-name:{v}", "this work is licensed under the gnu general public license version {v}", ("1", "2", "3", "2.0", "3.0")),
    ("gpl-name:{v}", "licensed under the gnu general public license version {v}", ("1", "2", "3", "2.0", "3.0")),
    ("gpl-name:{v}", "released under the gnu general public license version {v}", ("1", "2", "3", "2.0", "3.0")),
    ("gpl-free", "this program is free software", ()),
    ("gpl-terms:{v}+", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version", ("1", "2", "3")),
    ("gpl-terms:{v}", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version {v}", ("1", "2", "3")),
    ("lgpl-name:{v}", "licensed under the gnu lesser general public license version {v}", ("2.1", "3", "3.0")),
    ("lgpl-terms:{v}+", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version {v} of the license or at your option any later version", ("2.1", "3")),
    ("agpl-terms:{v}+", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version {v} of the license or at your option any later version", ("3",)),
    ("agpl-name:{v}", "licensed under the gnu affero general public license version {v}", ("3", "3.0")),
    ("bsd-use", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ()),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ()),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ()),
    ("bsd-endorse", "neither the name of {name} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ()),
    ("bsd-endorse", "neither the names of {name} nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission", ()),
    ("bsd-endorse", "the name of {name} may not be used to endorse or promote products derived from this software without specific prior written permission", ()),
    ("bsd-advert", "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by {name}", ()),
    ("bsd-disclaimer", "this software is provided by {name} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", ()),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ()),
    ("mpl-name:{v}", "this source code form is subject to the terms of the mozilla public license v {v}", ("1.1", "2.0")),
    ("mpl-name:{v}", "the contents of this file are subject to the mozilla public license version {v} the license", ("1.1",)),
    ("cc-by:{v}", "licensed under cc by {v}", ("2.0", "3.0", "4.0")),
    ("cc-by-sa:{v}", "licensed under cc by sa {v}", ("2.0", "3.0", "4.0")),
    ("cc-by-nc:{v}", "licensed under cc by nc {v}", ("2.0", "3.0", "4.0")),
    ("cc-by-nd:{v}", "licensed under cc by nd {v}", ("2.0", "3.0", "4.0")),
    ("cc-by-nc-sa:{v}", "licensed under cc by nc sa {v}", ("2.0", "3.0", "4.0")),
    ("cc-by-nc-nd:{v}", "licensed under cc by nc nd {v}", ("2.0", "3.0", "4.0")),
    ("cc0", "licensed under cc0 1.0", ()),
    *[(f"{key}:{{v}}", form.format(words), ("2.0", "3.0", "4.0")) for key, words in (
        ("cc-by", "attribution"), ("cc-by-sa", "attribution sharealike"), ("cc-by-nc", "attribution noncommercial"), ("cc-by-nd", "attribution noderivatives"),
        ("cc-by-nc-sa", "attribution noncommercial sharealike"), ("cc-by-nc-nd", "attribution noncommercial noderivatives")) for form in (
        "this work is licensed under a creative commons {} {{v}} international license", "licensed under a creative commons {} {{v}} international license",
        "this work is licensed under the creative commons {} {{v}} international license", "licensed under the creative commons {} {{v}} international license",
        "creative commons {} {{v}} international license")],
    ("json-clause", "the software shall be used for good not evil", ()),
    ("apache-text:{v}", "apache license version {v} january 2004", ("2.0",)),
    ("asf-grant", "licensed to the apache software foundation asf under one or more contributor license agreements", ()),
    ("apache-name:{v}", "the asf licenses this file to you under the apache license version {v} the license", ("2.0",)),
    ("gpl-text:{v}", "gnu general public license version {v} 29 june 2007", ("3",)),
    ("gpl-text:{v}", "gnu general public license version {v} june 1991", ("2",)),
    ("lgpl-text:{v}", "gnu lesser general public license version {v} 29 june 2007", ("3",)),
    ("lgpl-text:{v}", "gnu lesser general public license version {v} february 1999", ("2.1",)),
    ("agpl-text:{v}", "gnu affero general public license version {v} 19 november 2007", ("3",)),
    ("mpl-text:{v}", "mozilla public license version {v}", ("1.1", "2.0")),
    ("boost-text", "boost software license version 1.0 august 17th 2003", ()),
    ("boost-name", "distributed under the boost software license version 1.0", ()),
    ("epl-name:{v}", "this program and the accompanying materials are made available under the terms of the eclipse public license v {v}", ("1.0", "2.0")),
    ("epl-name:{v}", "this program and the accompanying materials are made available under the terms of the eclipse public license {v}", ("1.0", "2.0")),
    ("epl-text:{v}", "eclipse public license v {v}", ("1.0", "2.0")),
    ("zlib-as-is", "this software is provided as is without any express or implied warranty", ()),
    ("zlib-grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions", ()),
    ("zlib-origin", "the origin of this software must not be misrepresented", ()),
    ("public-domain", "this is free and unencumbered software released into the public domain", ()),
    ("reserved", "all rights reserved", ()),
]
#: Licence and the identifiers that must follow one another, most specific first.
RULES = [
    ("BSD-4-Clause", ("bsd-use", "=bsd-source", "=bsd-binary", "=bsd-advert", "=bsd-endorse", "|")),
    ("BSD-3-Clause", ("bsd-use", "=bsd-source", "=bsd-binary", "=bsd-endorse", "|")),
    ("BSD-2-Clause", ("bsd-use", "=bsd-source", "=bsd-binary", "=bsd-disclaimer")),
    ("BSD-2-Clause", ("bsd-use", "=bsd-source", "=bsd-binary", "|")),
    ("JSON", ("mit-grant", "=mit-notice", "=json-clause")),
    ("JSON", ("mit-name", "mit-grant", "=mit-notice", "=json-clause")),
    ("MIT", ("mit-name", "mit-grant", "=mit-notice", "=as-is")),
    ("MIT", ("mit-grant", "=mit-notice", "=as-is")),
    ("MIT", ("mit-grant", "=mit-notice", "|")),
    ("MIT", ("mit-name",)),
    ("Apache-{v}", ("apache-name:{v}", "apache-comply", "apache-copy")),
    ("Apache-{v}", ("asf-grant", "apache-name:{v}", "apache-comply", "apache-copy")),
    ("Apache-{v}", ("asf-grant", "apache-name:{v}")),
    ("Apache-{v}", ("apache-name:{v}",)),
    ("Apache-{v}", ("apache-text:{v}",)),
    ("GPL-{v}", ("gpl-text:{v}",)),
    ("LGPL-{v}", ("lgpl-text:{v}",)),
    ("AGPL-{v}", ("agpl-text:{v}",)),
    ("MPL-{v}", ("mpl-text:{v}",)),
    ("BSL-1.0", ("boost-text",)),
    ("BSL-1.0", ("boost-name",)),
    ("EPL-{v}", ("epl-name:{v}",)),
    ("EPL-{v}", ("epl-text:{v}",)),
    ("Zlib", ("zlib-as-is", "zlib-grant", "=zlib-origin")),
    ("Zlib", ("zlib-grant", "=zlib-origin")),
    ("GPL-{v}-or-later", ("gpl-free", "gpl-terms:{v}+")),
    ("GPL-{v}", ("gpl-free", "gpl-terms:{v}")),
    ("GPL-{v}", ("gpl-name:{v}",)),
    ("LGPL-{v}-or-later", ("gpl-free", "lgpl-terms:{v}+")),
    ("LGPL-{v}-or-later", ("lgpl-terms:{v}+",)),
    ("LGPL-{v}", ("lgpl-name:{v}",)),
    ("AGPL-{v}-or-later", ("gpl-free", "agpl-terms:{v}+")),
    ("AGPL-{v}-or-later", ("agpl-terms:{v}+",)),
    ("AGPL-{v}", ("agpl-name:{v}",)),
    ("ISC", ("isc-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("MPL-{v}", ("mpl-name:{v}", "apache-comply", "apache-copy")),
    ("MPL-{v}", ("mpl-name:{v}", "apache-comply")),
    ("MPL-{v}", ("mpl-name:{v}",)),
    ("CC-BY-NC-SA-{v}", ("cc-by-nc-sa:{v}",)),
    ("CC-BY-NC-ND-{v}", ("cc-by-nc-nd:{v}",)),
    ("CC-BY-NC-{v}", ("cc-by-nc:{v}",)),
    ("CC-BY-SA-{v}", ("cc-by-sa:{v}",)),
    ("CC-BY-ND-{v}", ("cc-by-nd:{v}",)),
    ("CC-BY-{v}", ("cc-by:{v}",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("public-domain",)),
    ("All-Rights-Reserved", ("reserved",)),
]
#: Sentences that add to the licence before them.
CLAUSES = ("bsd-advert", "bsd-endorse", "json-clause")
GAP = 3
NAME_WORDS = 12
_MARKER = re.compile(r"\s*(?:\(?(?:[0-9]{1,2}|[ivx]{1,4}|[a-z])[.)]|[-*\u2022])\s+", re.IGNORECASE)
_ITEM = re.compile(r"(?:[0-9]{1,2}|[ivx]{1,4}|[a-z])\Z")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.IGNORECASE)
_FAMILY = re.compile(r"((?:A|L)?GPL)-([0-9])(?:\.([0-9]))?(-only|-or-later|\+)?\Z", re.IGNORECASE)
_CUT = re.compile(r"\n|[.;:!?](?=\s|$)")
_OTHER = re.compile(r"[^a-z0-9.\x80-\U0010ffff]+|\.(?![0-9])|(?<![0-9])\.")
_UPPER = {c: c + 32 for c in range(65, 91)}


def known_sentences(sentences=SENTENCES) -> dict[str, str]:
    """Normalised sentence to identifier; sentences with a name in them are in ``named_sentences``."""
    return {t.replace("{v}", v): i.replace("{v}", v) for i, t, versions in sentences for v in versions or ("",) if "{name}" not in t}


def named_sentences(sentences=SENTENCES) -> list[tuple[str, re.Pattern, str]]:
    """(words before the name, pattern of the whole sentence, identifier)."""
    out = []
    for ident, text, _ in sentences:
        if "{name}" in text:
            head, tail = text.split("{name}")
            out.append((head, re.compile(re.escape(head) + rf"(?:\S+ ){{0,{NAME_WORDS - 1}}}\S+" + re.escape(tail) + r"\Z"), ident))
    return out


def normalise(sentence: str) -> str:
    return " ".join(_OTHER.sub(" ", sentence.translate(_UPPER)).split())


def beginnings(known: dict[str, str], named=()) -> set[str]:
    """Proper beginnings of the known sentences, by words."""
    heads = [head.split() for head, _, _ in named]
    return {" ".join(words[:k]) for words in map(str.split, known) for k in range(1, len(words))} | {" ".join(h[:k]) for h in heads for k in range(1, len(h) + 1)}


def recognise(text: str, known: dict[str, str], longest: int, begun: set[str], named=()) -> tuple[list[tuple[str, int, int, int]], int]:
    """The known sentences (identifier, sentence number, start, end) in text order, and the number of all; a joined sentence counts as one, an unknown line each."""
    cuts = [(0, 0, True)] + [(m.start(), m.end(), m.group() != "\n") for m in _CUT.finditer(text)] + [(len(text), len(text), True)]
    parts = []  # normalised words, start, end, whether the sentence ends here
    for (_, lo, _), (hi, _, ends) in zip(cuts, cuts[1:], strict=False):
        marker = _MARKER.match(text, lo, hi)
        words = normalise(text[marker.end() if marker else lo:hi])
        parts.append(("" if _ITEM.match(words) else words, lo, hi, ends))  # "1" of a list is no sentence
    heads = tuple(head for head, _, _ in named)
    out, i, number = [], 0, 0
    while i < len(parts):
        joined, best, k, size = "", None, i, 0
        while k < len(parts) and size <= longest + NAME_WORDS:
            if parts[k][0]:
                joined = f"{joined} {parts[k][0]}".strip()
                size = joined.count(" ") + 1
            if joined in known:
                best = (k, known[joined])
            inside = joined.startswith(heads) if heads else False
            if inside:
                ident = next((i for head, whole, i in named if joined.startswith(head) and whole.match(joined)), None)
                # a name at the end of a sentence ends with its last line
                if ident and (parts[k][3] or k + 1 == len(parts) or not parts[k + 1][0]):
                    best = (k, ident)
                    break
            if parts[k][3] and joined not in begun and not inside:
                break
            k += 1
        number += bool(parts[i][0])
        if best and parts[i][0]:
            out.append((best[1], number, parts[i][1], parts[best[0]][2]))
            i = best[0]
        i += 1
    return out, number


def spdx_names(text: str, names: dict[str, str]) -> list[tuple[str, int, int]]:
    """(identifier, start, end) for every licence that the SPDX lines name; ``names``: lower case to licence."""
    out = []
    for line in _SPDX.finditer(text):
        words = list(re.finditer(r"[A-Za-z0-9.+-]+", line.group(1)))
        skip = False
        for word in words:
            x = word.group().rstrip(".")
            if skip or x.upper() in ("AND", "OR") or not x.strip("-+."):
                skip = False
                continue
            if x.upper() == "WITH":
                skip = True  # an exception's name follows
                continue
            family = _FAMILY.match(x)
            if family:
                kind, major, minor, more = family.groups()
                x = f"{kind.upper()}-{major}{'.' + minor if minor and minor != '0' else ''}{'-or-later' if more in ('+', '-or-later') else ''}"
            at = line.start(1) + word.start()
            out.append((f"spdx:{names.get(x.lower(), x)}", at, at + len(word.group())))
    return out


def expand_rules(rules=RULES, versions=("1", "1.0", "1.1", "2", "2.0", "2.1", "3", "3.0", "4.0")) -> list[tuple[str, tuple[str, ...]]]:
    out = []
    for name, ids in rules:
        for v in versions if "{v}" in name else ("",):
            out.append((name.replace("{v}", v), tuple(i.replace("{v}", v) for i in ids)))
    return out


def match_rules(found: list[tuple], rules: list[tuple[str, tuple[str, ...]]], gap: int = GAP, total: int | None = None) -> tuple[list[str], int]:
    """(licences in text order, number of identifiers that no rule took); ``total``: sentences of the text (the last one found ends it by default)."""
    by_first: dict[str, list] = {}
    for name, ids in rules:
        by_first.setdefault(ids[0], []).append((name, ids))

    def holds(i: int, ids: tuple[str, ...]) -> int:
        """Identifiers that the rule takes from place ``i`` on, 0 if it does not hold."""
        closed = ids[-1] == "|"
        ids = ids[:-1] if closed else ids
        part = found[i:i + len(ids)]
        if len(part) < len(ids) or any(x[0] != want.removeprefix("=") for x, want in zip(part, ids)):
            return 0
        if any(b[1] - a[1] > (1 if want.startswith("=") else gap + 1) for a, b, want in zip(part, part[1:], ids[1:])):
            return 0
        after = found[i + len(ids)][1] if i + len(ids) < len(found) and found[i + len(ids)][0] not in CLAUSES else None
        if closed and (after is None or after > part[-1][1] + 1) and part[-1][1] != (part[-1][1] if total is None else total):
            return 0
        return len(ids)

    out, left, i = [], 0, 0
    while i < len(found):
        for name, ids in by_first.get(found[i][0], ()):
            taken = holds(i, ids)
            if taken:
                out.append(name)
                i += taken
                break
        else:
            left += 1
            i += 1
    return out, left


def scan_licenses(docs: DataFrame, sentences=SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, licenses (distinct, sorted), n_licenses, sentence_ids (in text order), spans (start, end in characters) and unmatched."""
    known, ordered, slots = known_sentences(sentences), expand_rules(rules), named_sentences(sentences)
    names = {n.lower(): n for n, _ in ordered}
    spdx = set(names.values())
    begun = beginnings(known, slots)
    longest = max(t.count(" ") + 1 for t in known)
    # a text can hold a known sentence only if it has one of these words, one from each sentence
    common = ("licen", "copyright", "permi", "redistribut", "software", "rights reserved")
    rest = sorted({t for t in known if not any(c in t for c in common)})
    hint = re.compile("|".join([*common, *(re.escape(t.split()[0]) for t in rest)]), re.IGNORECASE | re.ASCII)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.schema([("doc_id", batches_type[0]), ("licenses", pa.list_(pa.string())), ("n_licenses", pa.int64()), ("sentence_ids", pa.list_(pa.string())),
                          ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("unmatched", pa.bool_())])
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                found, total = recognise(text, known, longest, begun, slots) if text and hint.search(text) else ([], 0)
                licenses, left = match_rules(found, ordered, total=total)
                lines = spdx_names(text, names) if found or text and hint.search(text) else []
                licenses += [x[0][5:] for x in lines if x[0][5:] in spdx]
                left += sum(x[0][5:] not in spdx for x in lines)
                found = sorted([*found, *((x, 0, lo, hi) for x, lo, hi in lines)], key=lambda x: x[2])
                rows.append((sorted(set(licenses)), len(set(licenses)), [x[0] for x in found], [{"start": x[2], "end": x[3]} for x in found], left > 0))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t.type) for c, t in zip(cols, list(kind)[1:], strict=True)]], schema=kind)

    import pyarrow as pa

    id_type = docs.schema["doc_id"].dataType.simpleString()
    batches_type = [{"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())]
    ids = docs["doc_id"] if id_type in ("bigint", "int") else docs["doc_id"].cast("string").alias("doc_id")
    named = "bigint" if id_type == "bigint" else "int" if id_type == "int" else "string"
    return docs.select(ids, F.col("text").cast("string")).mapInArrow(
        scan, f"doc_id {named}, licenses array<string>, n_licenses bigint, sentence_ids array<string>, spans array<struct<start:int,end:int>>, unmatched boolean")
