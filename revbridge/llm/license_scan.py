"""License scans by ordered signature rules.

A text becomes its words (runs of letters, digits and non-ASCII, A-Z lowered),
joined by single spaces; signatures are regexes over that.  Hundreds of them are
made from hand-written clauses and headers (`CLAUSES`, `NOTICES`) and from license
names and the wordings that cite them (`FAMILIES`, `WORDINGS`).  Every rule names a keyword that any text it matches must hold: an
Aho-Corasick pass over the words finds the keywords, and only their rules run.
Detections overlap, so they are resolved in the order of the rules: a higher
priority comes first, then the longer, then the earlier one, and a detection
that lies inside an accepted one is suppressed.

Texts are scanned where they are, whole, one at a time; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes that separate words, as spaces: all ASCII but digits and a-z (A-Z are lowered before).
_SEPARATE = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else 32 for c in range(256))

#: Base phrases and their labels (fixed values of the scan's contract).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: label, name (a regex over words), keyword of the name, SPDX identifiers as words.
FAMILIES = (
    ("mit", r"(?:mit|expat|x11)", "mit|expat|x11", "mit|x11|mit 0"),
    ("apache", r"apache(?: software)?", "apache", "apache 2 0|apache 1 1|apache 1 0"),
    ("agpl", r"(?:gnu )?affero general public", "affero", "agpl 3 0|agpl 3 0 only|agpl 3 0 or later|agpl 1 0"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public", "lesser|library", "lgpl 2 1|lgpl 3 0|lgpl 2 0|lgpl 2 1 or later|lgpl 3 0 or later"),
    ("gpl", r"(?:gnu )?general public", "general", "gpl 2 0|gpl 3 0|gpl 2 0 only|gpl 2 0 or later|gpl 3 0 only|gpl 3 0 or later"),
    ("gfdl", r"(?:gnu )?free documentation", "documentation", "gfdl 1 2|gfdl 1 3"),
    ("bsd", r"(?:(?:2|3|4|two|three|four) clause )?bsd(?: (?:2|3|4) clause)?", "bsd", "bsd 2 clause|bsd 3 clause|bsd 4 clause|0bsd"),
    ("isc", r"(?:isc|internet systems consortium)", "isc|consortium", "isc"),
    ("mpl", r"mozilla public", "mozilla", "mpl 2 0|mpl 1 1|mpl 1 0"),
    ("epl", r"eclipse public", "eclipse", "epl 1 0|epl 2 0"),
    ("eupl", r"european union public", "european", "eupl 1 1|eupl 1 2"),
    ("cddl", r"common development and distribution", "distribution", "cddl 1 0|cddl 1 1"),
    ("cpl", r"common public", "common", "cpl 1 0"),
    ("cpal", r"common public attribution", "attribution", "cpal 1 0"),
    ("artistic", r"artistic", "artistic", "artistic 1 0|artistic 2 0"),
    ("boost", r"boost software", "boost", "bsl 1 0"),
    ("zlib", r"zlib(?: libpng)?", "zlib", "zlib"),
    ("wtfpl", r"do what the fuck you want to public", "fuck", "wtfpl"),
    ("python", r"(?:python software foundation|psf)", "python|psf", "psf 2 0|python 2 0"),
    ("php", r"php", "php", "php 3 01|php 3 0"),
    ("ruby", r"ruby", "ruby", "ruby"),
    ("openssl", r"openssl", "openssl", "openssl"),
    ("postgresql", r"postgresql", "postgresql", "postgresql"),
    ("odbl", r"open (?:data commons open )?database", "database", "odbl 1 0"),
    ("odc by", r"open data commons attribution", "commons", "odc by 1 0"),
    ("pddl", r"public domain dedication and", "dedication", "pddl 1 0"),
    ("ofl", r"(?:sil )?open font", "font", "ofl 1 1|ofl 1 0"),
    ("ms-pl", r"microsoft public", "microsoft", "ms pl"),
    ("ms-rl", r"microsoft reciprocal", "reciprocal", "ms rl"),
    ("osl", r"open software", "software", "osl 3 0|osl 2 1"),
    ("afl", r"academic free", "academic", "afl 3 0|afl 2 1"),
    ("ecl", r"educational community", "educational", "ecl 2 0|ecl 1 0"),
    ("lppl", r"latex project public", "latex", "lppl 1 3c|lppl 1 3a"),
    ("qpl", r"q public", "public", "qpl 1 0"),
    ("upl", r"universal permissive", "permissive", "upl 1 0"),
    ("vim", r"vim", "vim", "vim"),
    ("w3c", r"w3c(?: software)?", "w3c", "w3c"),
    ("ijg", r"independent jpeg group", "jpeg", "ijg"),
    ("libpng", r"libpng", "libpng", "libpng|libpng 2 0"),
    ("curl", r"curl", "curl", "curl"),
    ("beerware", r"beerware", "beerware", "beerware"),
    ("bsl", r"business source", "business", "busl 1 1"),
    ("sspl", r"server side public", "server", "sspl 1 0"),
    ("elastic", r"elastic", "elastic", "elastic 2 0"),
    ("polyform", r"polyform (?:noncommercial|small business|strict|shield)", "polyform", "polyform noncommercial 1 0 0|polyform strict 1 0 0"),
    ("openrail", r"(?:creativeml |bigscience )?open ?rail(?: m)?", "openrail|rail", "openrail"),
    ("llama", r"llama (?:2 |3 )?community", "llama", "llama2|llama3"),
)

#: How a text names the license it is under; {n} is a family's name.  Priority, confidence, wording.
WORDINGS = (
    (80, 0.95, r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{n} licen[sc]e(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)?)?"),
    (70, 0.90, r"(?:subject to|governed by|covered by|see) (?:the )?(?:terms of (?:the )?)?{n} licen[sc]e(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)?)?"),
    (60, 0.80, r"{n} licen[sc]e v(?:ersion)? ?[0-9]+(?: [0-9]+)?(?: or (?:any )?later)?"),
    (50, 0.70, r"{n} licen[sc]es?"),
)

#: Wordings of their own: label, priority, confidence, keyword, regex.
NOTICES = (
    ("all rights reserved", 40, 0.6, "reserved", r"all rights reserved"),
    ("copyright", 30, 0.3, "copyright", r"copyright (?:c )?[0-9]{4}"),
    ("unlicense", 60, 0.8, "unlicense", r"the unlicense"),
    ("unlicense", 110, 1.0, "spdx", r"spdx license identifier unlicense"),
    ("public domain", 45, 0.7, "domain", r"(?:released|dedicated|placed) (?:to|into|in) the public domain"),
    ("mit", 90, 0.98, "granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", 90, 0.95, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", 90, 0.9, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", 90, 0.9, "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost", 90, 0.95, "machine", r"machine executable object code generated by a source language processor"),
    ("gpl", 90, 0.95, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 91, 0.95, "lesser", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", 91, 0.95, "affero", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("unlicense", 90, 0.95, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("proprietary", 45, 0.7, "proprietary", r"proprietary and confidential"),
    ("proprietary", 45, 0.7, "prohibited", r"(?:copying|reproduction|distribution) (?:or [a-z]+ )?(?:of [a-z ]{1,40} )?is (?:strictly )?prohibited"),
)

#: Clauses and headers as they stand in license texts (words of the text itself): label,
#: confidence, keyword, words.  A clause speaks for a license that several may share.
CLAUSES = (
    ("mit", 0.95, "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 0.9, "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 0.85, "noninfringement", "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", 0.85, "tort", "whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
    ("bsd", 0.95, "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 0.95, "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 0.95, "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 0.95, "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", 0.85, "procurement", "procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd", 0.85, "disclaimed", "merchantability and fitness for a particular purpose are disclaimed"),
    ("apache", 0.95, "compliance", "you may not use this file except in compliance with the license"),
    ("apache", 0.95, "permissions", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache", 0.9, "writing", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", 0.95, "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache", 0.95, "prominent", "you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache", 0.9, "trademarks", "this license does not grant permission to use the trade names trademarks service marks or product names of the licensor"),
    ("gpl", 0.95, "redistribute", "this program is free software you can redistribute it and or modify it"),
    ("gpl", 0.95, "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", 0.9, "received", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", 0.9, "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", 0.9, "freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", 0.9, "corresponding", "accompany it with the complete corresponding machine readable source code"),
    ("lgpl", 0.95, "received", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("lgpl", 0.9, "library", "this library is free software you can redistribute it and or modify it"),
    ("agpl", 0.95, "remotely", "your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("agpl", 0.95, "received", "you should have received a copy of the gnu affero general public license along with this program"),
    ("gfdl", 0.95, "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", 0.95, "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", 0.9, "obtain", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", 0.95, "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", 0.9, "recipient", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("cddl", 0.95, "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", 0.95, "eupl", "licensed under the eupl"),
    ("isc", 0.9, "disclaims", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", 0.85, "whatsoever", "be liable for any special direct indirect or consequential damages or any damages whatsoever"),
    ("zlib", 0.95, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 0.95, "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost", 0.95, "reproduce", "to use reproduce display distribute execute and transmit the software"),
    ("artistic", 0.95, "package", "you may make and give away verbatim copies of the source form of the standard version of this package without restriction"),
    ("artistic", 0.9, "executables", "rename any non standard executables so the names do not conflict with standard executables"),
    ("ofl", 0.95, "font", "this font software is licensed under the sil open font license"),
    ("ofl", 0.95, "reserved", "no modified version of the font software may use the reserved font name"),
    ("wtfpl", 0.95, "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("beerware", 0.95, "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("unlicense", 0.95, "jurisdictions", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("cc0", 0.95, "waived", "has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", 0.9, "credit", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", 0.9, "remix", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-nc", 0.9, "commercial", "you may not use the material for commercial purposes"),
    ("cc-by-nd", 0.9, "remix", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("psf", 0.9, "psf", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", 0.95, "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", 0.95, "php", "this product includes php software freely available from"),
    ("bsl", 0.9, "production", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("elastic", 0.95, "managed", "you may not provide the software to third parties as a hosted or managed service"),
    ("proprietary", 0.8, "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", 0.7, "secrets", "contains trade secrets and confidential information"),
    ("proprietary", 0.7, "reproduced", "no part of this publication may be reproduced stored in a retrieval system or transmitted"),
    ("proprietary", 0.7, "decompile", "you may not reverse engineer decompile or disassemble the software"),
)


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]
    pattern: str


def creative_commons() -> list[Signature]:
    """The six licenses and the dedication, in short and long names."""
    long = {"by": "attribution", "nc": "noncommercial|non commercial", "nd": "noderivatives|no derivatives|noderivs", "sa": "sharealike|share alike"}
    out = []
    for parts in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        label, names = "cc-" + parts.replace(" ", "-"), [f"(?:{long[p]})" for p in parts.split()]
        version = r"(?: [0-9] [0-9])?(?: (?:international|unported|generic))?"
        out += [
            Signature(label, 80 + len(parts), 0.95, ("cc",), rf"(?:licensed|released|available|published) under (?:a |the )?cc {parts}{version}"),
            Signature(label, 60 + len(parts), 0.85, ("cc",), rf"cc {parts} [0-9] [0-9]"),
            Signature(label, 60 + len(parts), 0.9, ("creative",), rf"creative commons {' '.join(names)}{version}"),
            Signature(label, 85 + len(parts), 0.98, ("creativecommons",), rf"creativecommons org licenses {parts}(?: [0-9] [0-9])?"),
        ]
    out.append(Signature("cc0", 80, 0.95, ("cc0",), r"cc0(?: 1 0)?(?: universal)?"))
    out.append(Signature("cc0", 85, 0.98, ("creativecommons",), r"creativecommons org publicdomain zero 1 0"))
    return out


@cache
def signatures() -> tuple[Signature, ...]:
    """All rules in their order: priority, then label and pattern."""
    out = creative_commons()
    for label, name, keywords, ids in FAMILIES:
        keys = tuple(keywords.split("|"))
        out += [Signature(label, p, c, keys, w.format(n=name)) for p, c, w in WORDINGS]
        out += [Signature(label, 100 + len(i), 1.0, ("spdx",), f"spdx license identifier {i}") for i in ids.split("|")]
    out += [Signature(label, p, c, (k,), r) for label, p, c, k, r in NOTICES]
    out += [Signature(label, 88, c, (k,), words) for label, c, k, words in CLAUSES]
    return tuple(sorted(out, key=lambda s: (-s.priority, s.label, s.pattern)))


@cache
def _compiled() -> tuple[ahocorasick.Automaton, tuple[re.Pattern, ...]]:
    gate: dict[str, list[int]] = {}
    for i, s in enumerate(signatures()):
        for k in s.keywords:
            gate.setdefault(k, []).append(i)
    automaton = ahocorasick.Automaton()
    for k, rules in gate.items():
        automaton.add_word(f" {k} ", tuple(rules))
    automaton.make_automaton()
    return automaton, tuple(re.compile(rf"(?<= ){s.pattern}(?= )") for s in signatures())


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SEPARATE).split()


@dataclass(frozen=True)
class Detection:
    label: str
    confidence: float
    start: int
    end: int  # words, end exclusive
    rule: int


def detections(words: list[bytes]) -> list[Detection]:
    """All matches of the gated rules, those inside an accepted one suppressed; by start."""
    automaton, patterns = _compiled()
    text = " " + b" ".join(words).decode("utf-8", "replace") + " "
    # a keyword's closing space opens the next one: single spaces are shared
    rules = sorted({r for _, found in automaton.iter(text.replace(" ", "  ")) for r in found})
    matches = []
    for r in rules:
        matches += [(r, m.start(), m.end()) for m in patterns[r].finditer(text)]
    if not matches:
        return []
    all_rules = signatures()
    matches.sort(key=lambda m: (-all_rules[m[0]].priority, m[1] - m[2], m[1], m[0]))
    inside = _Containment([a for _, a, _ in matches])
    accepted = []
    for r, a, b in matches:
        if inside.furthest_end(a) < b:
            inside.accept(a, b)
            accepted.append((r, a, b))
    starts = list(accumulate((len(w) + 1 for w in text[1:-1].split(" ")), initial=1))
    out = [
        Detection(all_rules[r].label, all_rules[r].confidence, bisect_right(starts, a) - 1, bisect_right(starts, b - 1), r)
        for r, a, b in accepted
    ]
    return sorted(out, key=lambda d: (d.start, d.end, d.rule))


class _Containment:
    """Accepted intervals, asked for the furthest end of those that start at or before a place."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.tree = [-1] * (len(self.starts) + 1)

    def accept(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.tree):
            self.tree[i] = max(self.tree[i], end)
            i += i & -i

    def furthest_end(self, start: int) -> int:
        i, best = bisect_right(self.starts, start), -1
        while i:
            best = max(best, self.tree[i])
            i -= i & -i
        return best


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase's words stand consecutively."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in BASE:
        if f" {phrase} ".encode() not in joined:
            continue
        parts = [p.encode() for p in phrase.split()]
        n, at = len(parts), -1
        try:
            while True:
                at = words.index(parts[0], at + 1)
                if words[at : at + n] == parts:
                    out.append((at, label))
        except ValueError:
            pass
    return sorted(out)


#: Every signature and base phrase holds one of these; a text without any is clean.
_TRIGGERS = (b"licen", b"spdx", b"reserved", b"copyright", b"domain", b"permission", b"redistribut", b"warranty", b"machine", b"unencumbered", b"proprietary", b"prohibited", b"commons", b"cc by", b"cc0") + tuple(sorted({f" {k} ".encode() for _, _, k, _ in CLAUSES}))


def scan(text: str | None) -> tuple[int, list[tuple[int, str]], list[Detection]]:
    """(number of words, base places, detections) of one whole text."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    if not any(t in joined for t in _TRIGGERS):
        return len(words), [], []
    return len(words), base_places(words), detections(words)


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:long,end:long,confidence:double>>"
)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan every text of `docs`: one row per row, `doc_id` and the columns of SCHEMA.

    `labels` holds the base labels and those of the detections, `score` the
    highest confidence among them (a base phrase counts 0.7; none: 0), `spans`
    the detections in words.  Null text counts as empty: no words, empty labels,
    null places.  A null doc_id stays null; repeated rows are scanned each; other
    columns of `docs`, whatever their names, play no part.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                n, base, found = scan(t.as_py())
                labels = {d.label for d in found} | {x for _, x in base}
                score = max([d.confidence for d in found] + [0.7] * bool(base), default=0.0)
                rows.append({
                    "n_words": n, "n_base": len(base),
                    "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
                    "base_labels": ",".join(sorted({x for _, x in base})), "labels": ",".join(sorted(labels)), "score": score,
                    "spans": [{"label": d.label, "start": d.start, "end": d.end, "confidence": d.confidence} for d in found],
                })
            out = pa.Table.from_pylist(rows, schema=_ARROW).combine_chunks()
            for part in out.to_batches():
                yield pa.RecordBatch.from_arrays([batch.column(0), *part.columns], ["doc_id", *_ARROW.names])

    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


_ARROW = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]))),
])
