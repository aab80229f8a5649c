"""License scan (operator 4): ordered signature rules.

A text becomes its words, lower-cased and joined by one space.  Rules are
regular expressions over that string, each with keywords; a rule is tried only
on texts that hold one of them.  Every string that a rule matches has one of its
keywords among its words, since they are taken from all those strings.  A detection within another is dropped; of
detections that overlap otherwise, the one whose rule comes earlier stays, and
specific rules (a license with its version, a tag) stand before general ones.

Input cases: a null or empty text has no words and no labels; repeated rows
give repeated results; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm.common import slices, table, with_python

#: Every byte outside words becomes a space; A-Z are lower-cased.  Words: runs of 0-9, a-z and what isn't ASCII.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The phrases of the contract and their labels.
BASE = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern
    keywords: frozenset[bytes]
    confidence: float


#: Words that are no keywords unless a rule names them so.
COMMON = frozenset(
    "licensed released distributed available under the terms of license licence version free software public general open source "
    "as published by foundation either only or later".split()
)


def strings(pattern: str) -> set[str]:
    """All strings that match a pattern of characters, classes, (?:a|b) groups and '?'."""

    def choice(at: int) -> tuple[set[str], int]:
        out: set[str] = set()
        while True:
            one, at = sequence(at)
            out |= one
            if at == len(pattern) or pattern[at] == ")":
                return out, at
            at += 1

    def sequence(at: int) -> tuple[set[str], int]:
        out = {""}
        while at < len(pattern) and pattern[at] not in "|)":
            if pattern.startswith("(?:", at):
                part, at = choice(at + 3)
            elif pattern[at] == "[":
                end = pattern.index("]", at)
                members = re.sub(r"(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), pattern[at + 1 : end])
                part, at = set(members), end
            else:
                part = {pattern[at]}
            at += 1
            if at < len(pattern) and pattern[at] == "?":
                part, at = part | {""}, at + 1
            out = {a + b for a in out for b in part}
        return out, at

    return choice(0)[0]


def keyword_of(string: str, wanted: str) -> bytes:
    """``wanted`` if it is a word of the string, else its longest word that isn't common."""
    words = string.split()
    return (wanted if wanted in words else max([w for w in words if w not in COMMON] or words, key=len)).encode()


#: Licenses with versions: label, names, short names, versions, words in between.
VERSIONED = [
    ("gpl", ["gnu general public licen[sc]e", "general public licen[sc]e"], ["gpl", "gplv", "gnu gpl"], ["1", "2", "3"], b"general"),
    ("lgpl", ["gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "lesser general public licen[sc]e"], ["lgpl", "lgplv", "gnu lgpl"], ["2", "2 1", "3"], b"general"),
    ("agpl", ["gnu affero general public licen[sc]e", "affero general public licen[sc]e"], ["agpl", "agplv", "gnu agpl"], ["1", "3"], b"affero"),
    ("gfdl", ["gnu free documentation licen[sc]e"], ["gfdl", "gnu fdl"], ["1 1", "1 2", "1 3"], b"documentation"),
    ("apache", ["apache licen[sc]e", "apache software licen[sc]e"], ["apache", "asl"], ["1 0", "1 1", "2 0"], b"apache"),
    ("mpl", ["mozilla public licen[sc]e"], ["mpl"], ["1 0", "1 1", "2 0"], b"mozilla"),
    ("epl", ["eclipse public licen[sc]e"], ["epl"], ["1 0", "2 0"], b"eclipse"),
    ("eupl", ["european union public licen[sc]e"], ["eupl"], ["1 0", "1 1", "1 2"], b"european"),
    ("cddl", ["common development and distribution licen[sc]e"], ["cddl"], ["1 0", "1 1"], b"distribution"),
    ("cpl", ["common public licen[sc]e"], ["cpl"], ["0 5", "1 0"], b"common"),
    ("osl", ["open software licen[sc]e"], ["osl"], ["1 0", "2 0", "2 1", "3 0"], b"open"),
    ("afl", ["academic free licen[sc]e"], ["afl"], ["1 2", "2 0", "2 1", "3 0"], b"academic"),
    ("artistic", ["artistic licen[sc]e", "perl artistic licen[sc]e"], ["artistic"], ["1 0", "2 0"], b"artistic"),
    ("bsl", ["boost software licen[sc]e"], ["boost"], ["1 0"], b"boost"),
    ("ofl", ["sil open font licen[sc]e", "open font licen[sc]e"], ["ofl", "sil ofl"], ["1 0", "1 1"], b"font"),
    ("odbl", ["open database licen[sc]e"], ["odbl"], ["1 0"], b"database"),
    ("zpl", ["zope public licen[sc]e"], ["zpl"], ["1 1", "2 0", "2 1"], b"zope"),
    ("php", ["php licen[sc]e"], ["php licen[sc]e"], ["3 0", "3 01"], b"php"),
    ("python", ["python software foundation licen[sc]e"], ["psf"], ["2", "2 0"], b"python"),
    ("ms-pl", ["microsoft public licen[sc]e"], ["ms pl"], ["1 0"], b"microsoft"),
    ("ms-rl", ["microsoft reciprocal licen[sc]e"], ["ms rl"], ["1 0"], b"microsoft"),
    ("busl", ["business source licen[sc]e"], ["busl"], ["1 0", "1 1"], b"business"),
    ("sspl", ["server side public licen[sc]e"], ["sspl"], ["1"], b"server"),
    ("elastic", ["elastic licen[sc]e"], ["elv2"], ["2 0"], b"elastic"),
    ("cecill", ["cecill free software licen[sc]e", "cecill licen[sc]e"], ["cecill"], ["1 0", "2 0", "2 1"], b"cecill"),
    ("openrail", ["open rail licen[sc]e", "openrail m licen[sc]e"], ["openrail"], ["1 0"], b"openrail"),
]
#: Licenses without versions: label and signatures.
NAMED = [
    ("mit", ["mit licen[sc]e", "the mit licen[sc]e mit", "expat licen[sc]e", "mit x11 licen[sc]e"], b"mit"),
    ("bsd-2-clause", ["bsd 2 clause", "2 clause bsd", "simplified bsd licen[sc]e", "freebsd licen[sc]e"], b"bsd"),
    ("bsd-3-clause", ["bsd 3 clause", "3 clause bsd", "new bsd licen[sc]e", "modified bsd licen[sc]e"], b"bsd"),
    ("bsd-4-clause", ["bsd 4 clause", "4 clause bsd", "original bsd licen[sc]e"], b"bsd"),
    ("bsd", ["bsd licen[sc]e", "bsd style licen[sc]e", "bsd licensed"], b"bsd"),
    ("isc", ["isc licen[sc]e", "internet software consortium licen[sc]e"], b"isc"),
    ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"], b"zlib"),
    ("unlicense", ["the unlicense", "unlicense org"], b"unlicense"),
    ("wtfpl", ["wtfpl", "do what the fuck you want to public licen[sc]e"], b"public"),
    ("cc0", ["cc0", "cc0 1 0 universal", "creative commons zero"], b"cc0"),
    ("public-domain", ["released into the public domain", "dedicated to the public domain", "public domain dedication", "in the public domain"], b"domain"),
    ("proprietary", ["all rights reserved", "proprietary and confidential", "unauthorized copying of this file"], b"reserved"),
    ("postgresql", ["postgresql licen[sc]e"], b"postgresql"),
    ("openssl", ["openssl licen[sc]e"], b"openssl"),
    ("ncsa", ["university of illinois ncsa open source licen[sc]e", "ncsa licen[sc]e"], b"ncsa"),
    ("beerware", ["beer ware licen[sc]e", "beerware"], b"beerware"),
]
#: Short names that also mean other things (a server, a sports league, a library): only with a word of licensing beside them.
SHARED_NAMES = frozenset("apache mpl epl cpl osl afl artistic boost ofl zpl psf".split())
#: Signatures of license texts and file headers: label, words, and one word that the others seldom hold.
BODIES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", b"granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", b"substantial"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy", b"granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", b"permission"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software", b"disclaims"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", b"permission"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", b"redistribution"),
    ("bsd", "redistributions of source code must retain the above copyright notice", b"redistributions"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", b"redistributions"),
    ("bsd-3-clause", "neither the name of the (?:copyright holder|copyright owner|university|author|organization) nor the names of its contributors may be used to endorse or promote products", b"endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", b"advertising"),
    ("apache-2.0", "you may obtain a copy of the licen[sc]e at https? www apache org licenses licen[sc]e 2 0", b"apache"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e", b"unless"),
    ("gpl-3", "the gnu general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works", b"copyleft"),
    ("agpl-3", "the gnu affero general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works", b"copyleft"),
    ("lgpl-3", "this version of the gnu lesser general public licen[sc]e incorporates the terms and conditions of version 3", b"incorporates"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[sc]e", b"affero"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e", b"general"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", b"redistribute"),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e", b"general"),
    ("gpl", "this program is free software you can redistribute it and or modify it", b"redistribute"),
    ("gpl", "either version [123](?: [0-9])? of the licen[sc]e or at your option any later version", b"either"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", b"documentation"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", b"mpl"),
    ("mpl", "this source code form is subject to the terms of the mozilla public licen[sc]e", b"mozilla"),
    ("mpl", "the contents of this file are subject to the mozilla public licen[sc]e", b"mozilla"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", b"eclipse"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e", b"distribution"),
    ("zlib", "this software is provided as is without any express or implied warranty", b"warranty"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", b"misrepresented"),
    ("unlicense", "this is free and unencumbered software released into the public domain", b"unencumbered"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", b"compile"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e", b"verbatim"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", b"retain"),
    ("cc0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright", b"waived"),
    ("ofl", "this font software is licensed under the sil open font licen[sc]e", b"font"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", b"package"),
    ("python", "this licen[sc]e agreement is between the python software foundation", b"python"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", b"openssl"),
    ("sspl-1", "if you make the functionality of the program or a modified version available to third parties as a service", b"functionality"),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", b"hosted"),
    ("proprietary", "this software is the confidential and proprietary information of", b"proprietary"),
    ("proprietary", "no part of this (?:document|publication|software|book) may be reproduced", b"reproduced"),
]
#: Creative Commons: elements and versions.
CC = {"by": ["by", "attribution"], "by-sa": ["by sa", "attribution share ?alike"], "by-nd": ["by nd", "attribution no ?derivatives"], "by-nc": ["by nc", "attribution non ?commercial"], "by-nc-sa": ["by nc sa", "attribution non ?commercial share ?alike"], "by-nc-nd": ["by nc nd", "attribution non ?commercial no ?derivatives"]}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules, specific ones first."""
    out: list[Rule] = []

    def add(label: str, pattern: str, keyword: bytes | str, confidence: float) -> None:
        word = keyword.decode() if isinstance(keyword, bytes) else keyword
        words = frozenset(keyword_of(string, word) for string in strings(pattern))
        out.append(Rule(label, re.compile(rf"(?<= ){pattern}(?= )".encode()), words, confidence))

    def dashed(version: str) -> str:
        return version.replace(" ", ".")

    for label, _, short, versions, _ in VERSIONED:  # tags
        for v in versions:
            for name in short:
                add(f"{label}-{dashed(v)}", rf"spdx licen[sc]e identifier {name} {v}(?: 0)?(?: only| or later)?", "spdx", 1.0)
    for label, names, _ in NAMED:
        add(label, rf"spdx licen[sc]e identifier {label.replace('-', ' ')}", "spdx", 1.0)
    for kind in CC:
        for v in CC_VERSIONS:
            add(f"cc-{kind}-{dashed(v)}", rf"spdx licen[sc]e identifier cc {kind.replace('-', ' ')} {v}", "spdx", 1.0)
            add(f"cc-{kind}-{dashed(v)}", rf"creativecommons org licenses {kind.replace('-', ' ')} {v}", "creativecommons", 1.0)
    for kind, names in sorted(CC.items(), key=lambda x: -len(x[0])):
        for v in CC_VERSIONS:
            for name, start, word in ((names[0], "cc", b"cc"), (names[1], "creative commons", b"commons")):
                add(f"cc-{kind}-{dashed(v)}", rf"{start} {name}(?: licen[sc]e)?(?: international| unported)? {v}", word, 0.95)
    for label, text, word in BODIES:
        add(label, text, word, 0.95)
    for label, names, short, versions, word in VERSIONED:
        for v in reversed(versions):
            for name in names:
                add(f"{label}-{dashed(v)}", rf"{name}(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?{v}(?: only| or later)?", word, 0.95)
            for name in short:
                numbered, own = rf"{name} ?v? ?(?:version )?{v}(?: only| or later)?", name.split()[-1]
                if name in SHARED_NAMES:
                    add(f"{label}-{dashed(v)}", rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{numbered}", own, 0.9)
                    add(f"{label}-{dashed(v)}", rf"licen[sc]e[ds]? (?:is |the |type |under )?{numbered}", own, 0.8)
                    add(f"{label}-{dashed(v)}", rf"{numbered} licen[sc]e[ds]?", own, 0.8)
                    continue
                add(f"{label}-{dashed(v)}", numbered, own, 0.8)
                if " " not in name and not v.startswith("0"):
                    add(f"{label}-{dashed(v)}", rf"{name}v{v}", f"{name}v{v.split()[0]}", 0.9)
    for label, names, word in NAMED:
        for name in names:
            add(label, name, word, 0.8)
            add(label, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{name}", word, 0.9)
    for kind, names in sorted(CC.items(), key=lambda x: -len(x[0])):
        add(f"cc-{kind}", f"cc {names[0]}", b"cc", 0.7)
        add(f"cc-{kind}", f"creative commons {names[1]}", b"commons", 0.7)
    for label, names, _, _, word in VERSIONED:
        for name in names:
            add(label, name, word, 0.7)
            add(label, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{name}", word, 0.8)
    return tuple(out)


@functools.cache
def by_keyword() -> dict[bytes, tuple[int, ...]]:
    out: dict[bytes, list[int]] = {}
    for i, rule in enumerate(rules()):
        for word in rule.keywords:
            out.setdefault(word, []).append(i)
    return {k: tuple(v) for k, v in out.items()}


class Detection(NamedTuple):
    rule: int
    start: int
    end: int


def resolved(found: list[Detection]) -> list[Detection]:
    """Detections that lie in no other, an earlier rule's winning among equal
    intervals; of those that then still overlap, the earlier rule's stays."""
    outer: list[Detection] = []
    for d in sorted(found, key=lambda d: (d.start, -d.end, d.rule)):
        if not outer or d.end > outer[-1].end:  # none that starts before reaches as far
            outer.append(d)
    kept = [False] * len(outer)
    for i in sorted(range(len(outer)), key=lambda i: (outer[i].rule, i)):
        left, right = i - 1, i + 1
        while left >= 0 and outer[left].end > outer[i].start and not kept[left]:
            left -= 1
        while right < len(outer) and outer[right].start < outer[i].end and not kept[right]:
            right += 1
        kept[i] = not (left >= 0 and outer[left].end > outer[i].start) and not (right < len(outer) and outer[right].start < outer[i].end)
    return [d for d, k in zip(outer, kept, strict=True) if k]


def detect(words: list[bytes], text: bytes) -> list[Detection]:
    """Detections in ``text``, the words joined by spaces with a space at both ends."""
    index = by_keyword()
    tried = sorted({i for word in index.keys() & set(words) for i in index[word]})
    return resolved([Detection(i, m.start(), m.end()) for i in tried for m in rules()[i].pattern.finditer(text)])


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()
    if by_keyword().keys().isdisjoint(words):
        return len(words), 0, None, None, "", "", 0.0
    line = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in BASE.items():
        at = line.find(b" " + phrase + b" ")
        while at >= 0:
            places.append(at)
            base.add(label)
            at = line.find(b" " + phrase + b" ", at + 1)
    found = detect(words, line)
    labels = base | {rules()[d.rule].label for d in found}
    score = max([rules()[d.rule].confidence for d in found] + [0.7] * bool(base), default=0.0)
    first = line.count(b" ", 0, min(places)) if places else None
    last = line.count(b" ", 0, max(places)) if places else None
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan_text(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
