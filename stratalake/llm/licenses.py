"""Licence statements in whole texts by ordered signature rules.

A rule has a label, keywords that every match of its pattern holds, a pattern over the lower-cased text
and a priority. Rules come from the families below (name, version and usual
statements), several hundred in all, and are ordered by priority: full statements before identifiers
before bare names. Detections that lie within a detection of higher priority are suppressed; of equal
spans the one of higher priority stays. Beside the rules, base phrases are found on the word sequence:
they always stay.

Keywords are pieces of text, not words: they are looked for wherever a match could stand, also within a
longer word ("gpl" in "gplv3") or beside a mark. Patterns run only over texts that hold, of every group of
keywords of the rule, at least one. Nothing is shuffled. A null text is the empty text: no words, no labels, score 0. Repeated
rows stay; an empty table gives no rows; columns not named in ``keep`` do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store
from stratalake.llm import text as tx

#: Base phrases and labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # what every match holds: groups joined by "&", each with its alternatives joined by "|"
    pattern: str
    priority: int  # smaller comes first


#: Between a name and its version: "gpl v3", "gplv3", "gpl, version 3", "gpl-3"; the second also without a mark.
_V, _OPT = r"(?:,? ?(?:version |v\.? ?)|-v?)", r"(?:,? ?(?:version |v\.? ?)?|-v?)"
#: Ends of names in identifiers.
_END = r"(?:-only|-or-later|\+)?"

#: label: (names as pattern, keywords of the name)
NAMED = {
    "mit": (r"(?:the )?mit(?:/x11)?", "mit"),
    "isc": (r"(?:the )?isc", "isc"),
    "zlib": (r"(?:the )?zlib(?:/libpng)?", "zlib"),
    "apache-1.1": (rf"apache(?: software)?(?: license)?{_OPT}1\.1", "apache"),
    "apache-2.0": (rf"apache(?: software)?(?: license)?{_OPT}2(?:\.0)?", "apache"),
    "bsd-2-clause": (r"(?:the )?(?:simplified bsd|freebsd|bsd[ -]2[ -]clause|2[ -]clause bsd|two[ -]clause bsd)", "bsd"),
    "bsd-3-clause": (r"(?:the )?(?:new bsd|modified bsd|revised bsd|bsd[ -]3[ -]clause|3[ -]clause bsd|three[ -]clause bsd)", "bsd"),
    "bsd-4-clause": (r"(?:the )?(?:original bsd|old bsd|bsd[ -]4[ -]clause|4[ -]clause bsd)", "bsd"),
    "gpl-1.0": (rf"(?:gnu )?(?:gpl|general public license){_V}1(?:\.0)?{_END}", "gpl|general public"),
    "gpl-2.0": (rf"(?:gnu )?(?:gpl|general public license){_V}2(?:\.0)?{_END}", "gpl|general public"),
    "gpl-3.0": (rf"(?:gnu )?(?:gpl|general public license){_V}3(?:\.0)?{_END}", "gpl|general public"),
    "lgpl-2.1": (rf"(?:gnu )?(?:lgpl|lesser general public license){_V}2\.1{_END}", "lgpl|lesser general"),
    "lgpl-3.0": (rf"(?:gnu )?(?:lgpl|lesser general public license){_V}3(?:\.0)?{_END}", "lgpl|lesser general"),
    "agpl-3.0": (rf"(?:gnu )?(?:agpl|affero general public license){_V}3(?:\.0)?{_END}", "agpl|affero"),
    "fdl-1.3": (rf"(?:gnu )?(?:g?fdl|free documentation license){_V}1\.[1-3]{_END}", "fdl|free documentation"),
    "mpl-1.1": (rf"(?:mozilla public license|mpl){_OPT}1\.1", "mozilla|mpl"),
    "mpl-2.0": (rf"(?:mozilla public license|mpl){_OPT}2(?:\.0)?", "mozilla|mpl"),
    "epl-1.0": (rf"(?:eclipse public license|epl)(?: -)?{_OPT}1(?:\.0)?", "eclipse|epl"),
    "epl-2.0": (rf"(?:eclipse public license|epl)(?: -)?{_OPT}2(?:\.0)?", "eclipse|epl"),
    "cddl-1.0": (r"(?:common development and distribution license|cddl)(?:(?:,? (?:version |v)?|-)1\.[01])?", "common development|cddl"),
    "cpl-1.0": (r"(?:common public license(?:,? (?:version |v)?1\.0)?|cpl-1\.0)", "common public|cpl"),
    "eupl-1.2": (rf"(?:european union public licence|eupl)(?:{_OPT}1\.[12])?", "european union|eupl"),
    "artistic-1.0": (r"(?:artistic license,? ?(?:version |v)?|artistic-)1(?:\.0)?", "artistic"),
    "artistic-2.0": (r"(?:artistic license,? ?(?:version |v)?|artistic-)2(?:\.0)?", "artistic"),
    "boost-1.0": (r"(?:boost software license(?:,? ?(?:-|version )? ?1\.0)?|bsl-1\.0)", "boost|bsl-1.0"),
    "unlicense": (r"(?:the )?unlicense", "unlicense"),
    "wtfpl": (r"wtfpl", "wtfpl"),
    "0bsd": (r"(?:0bsd|zero[ -]clause bsd)", "0bsd|clause bsd"),
    "postgresql": (r"postgresql licen[cs]e", "postgresql"),
    "python-2.0": (r"(?:(?:python software foundation|psf) license(?:,? ?(?:version )?2)?|(?:python|psf)-2\.0)", "python|psf"),
    "ruby": (r"ruby(?:'s)? license", "ruby"),
    "php-3.01": (r"(?:php license(?:,? ?(?:version )?3\.01?)?|php-3\.01?)", "php"),
    "ofl-1.1": (r"(?:(?:sil )?open font license(?:,? ?(?:version )?1\.1)?|ofl-1\.1)", "open font|ofl-1.1"),
    "odbl-1.0": (r"(?:open database license|odbl(?:-1\.0)?)", "open database|odbl"),
    "openssl": (r"openssl license", "openssl"),
    "ncsa": (r"(?:university of illinois/)?ncsa(?: open source)? license", "ncsa"),
    "ms-pl": (r"(?:microsoft public license|ms-pl)", "microsoft|ms-pl"),
    "ms-rl": (r"(?:microsoft reciprocal license|ms-rl)", "microsoft|ms-rl"),
    "json": (r"json license", "json"),
    "vim": (r"vim license", "vim"),
    "upl-1.0": (r"(?:universal permissive license|upl-1\.0)", "universal|upl-1.0"),
    "osl-3.0": (r"(?:open software license(?:,? ?(?:v(?:ersion)?\.? ?)?3\.0)?|osl-3\.0)", "open software|osl-3.0"),
    "afl-3.0": (r"(?:academic free license(?:,? ?(?:v(?:ersion)?\.? ?)?3\.0)?|afl-3\.0)", "academic|afl-3.0"),
    "bsl-1.1": (r"(?:business source license(?:,? ?(?:version )?1\.1)?|busl-1\.1)", "business|busl"),
    "elastic-2.0": (r"(?:elastic license(?:,? ?(?:version )?2(?:\.0)?)?|elastic-2\.0)", "elastic"),
    "sspl-1.0": (r"(?:server side public license|sspl-1\.0)", "server side|sspl"),
    "cc0-1.0": (r"cc0(?:[ -]1\.0)?", "cc0"),
    "cc-by-nc-nd": (r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|noncommercial)[ -](?:nd|noderiv\w*)", "cc|creative commons"),
    "cc-by-nc-sa": (r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|noncommercial)[ -](?:sa|sharealike)", "cc|creative commons"),
    "cc-by-nc": (r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|noncommercial)", "cc|creative commons"),
    "cc-by-nd": (r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nd|noderiv\w*)", "cc|creative commons"),
    "cc-by-sa": (r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:sa|sharealike)", "cc|creative commons"),
}
#: Whole statements, before everything else: label, keyword, pattern.
STATEMENTS = (
    ("mit", "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms, with or without modification"),
    ("apache-2.0", "apache license", r"licensed under the apache license, version 2\.0"),
    ("gpl", "gnu", r"under the terms of the gnu general public license"),
    ("lgpl", "gnu", r"under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "gnu", r"under the terms of the gnu affero general public license"),
    ("mpl-2.0", "mozilla", r"subject to the terms of the mozilla public license, v\. 2\.0"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("zlib", "warranty", r"provided 'as-is', without any express or implied warranty"),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|to|into) the public domain"),
    ("public-domain", "domain", r"(?:this (?:work|file) is )?in the public domain"),
    ("reserved", "reserved", r"all rights (?:are )?reserved"),
    ("copyright", "copyright", r"copyright (?:\(c\)|©|&copy;) ?\d{4}"),
    ("copyright", "copyright", r"copyright \d{4}"),
    ("cc", "creative", r"creative commons attribution"),
)
#: Places of a name: priority, pattern around it, keywords of the place.
PLACES = (
    (1, r"spdx-license-identifier:? (?:{name}|{id})", "spdx-license-identifier"),
    (2, r"licen[cs]ed (?:under|according to)(?: the terms of)? (?:the )?{name}(?: licen[cs]e)?", "licensed |licenced "),
    (2, r"(?:released|distributed|available|published|provided|made available) under (?:the terms of )?(?:the )?{name}(?: licen[cs]e)?", "released under|distributed under|available under|published under|provided under"),
    (3, r"under (?:the terms of |the conditions of )?(?:the )?{name} licen[cs]e", "license|licence"),
    (3, r"licen[cs]e: ?{name}", "license|licence"),
    (4, r"{name} licen[cs]ed?", "license|licence"),
    (5, r"https?://(?:www\.)?(?:opensource\.org/licenses|spdx\.org/licenses|creativecommons\.org/licenses)/{id}", "org/licenses/"),
)


def rules() -> list[Rule]:
    """All rules by priority, then in the order above."""
    out = [Rule(label, keyword, pattern, 0) for label, keyword, pattern in STATEMENTS]
    for priority, place, keyword in PLACES:
        for label, (name, own) in NAMED.items():
            out.append(Rule(label, keyword if "{id}" in place else f"{keyword}&{own}", place.replace("{name}", f"(?:{name})").replace("{id}", re.escape(label)), priority))
    return sorted(out, key=lambda r: r.priority)


class Scanner:
    """Compiled rules and base phrases; built once per worker."""

    def __init__(self, ordered: list[Rule], base: dict[str, str]):
        self.rules = [(r, re.compile(rf"(?<![\w-]){r.pattern}(?!\w)")) for r in ordered]
        self.needs = [[frozenset(group.split("|")) for group in r.keyword.split("&")] for r in ordered]
        self.words = sorted({k for need in self.needs for group in need for k in group})
        self.first = sorted({k for need in self.needs for k in need[0]})
        self.base = list(zip(tx.hash_words(list(base), tx.ALNUM), base.values()))

    def found(self, raw: bytes) -> set[str]:
        """Keywords in a text given as bytes; none when no rule can match."""
        lowered = raw.lower()  # letters of ASCII only
        found = {k for k in self.first if k.encode() in lowered}
        return found and found | {k for k in self.words if k.encode() in lowered}

    def detections(self, text: str, found: set[str]) -> list[tuple[int, int, str]]:
        """(begin, end, label) of the rule detections that no earlier one contains, in order of place."""
        kept: list[tuple[int, int, str]] = []
        for (rule, pattern), need in zip(self.rules, self.needs):
            if any(found.isdisjoint(group) for group in need):
                continue
            for m in pattern.finditer(text):
                if not any(a <= m.start() and m.end() <= b for a, b, _ in kept):
                    kept.append((m.start(), m.end(), rule.label))
        return sorted(kept)


_scanners: dict[int, Scanner] = store.remembered({})


def scan(docs: DataFrame, ordered: list[Rule] | None = None, base: dict[str, str] = BASE, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with n_words, n_base, first_word, last_word, base_labels, labels, score, n_rules and spans.

    ``spans`` are the rule detections (begin, end in code points, label). The score rises with their
    number and with base places: 1 - 0.5 ^ (both together).
    """
    ordered = rules() if ordered is None else ordered
    schema = docs.select(*keep).schema
    made = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_rules long, spans array<struct<begin:int,end:int,label:string>>"
    names = [*keep, *(part.split()[0] for part in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_rules", "spans"))]
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((tuple(ordered), tuple(base.items())))
        if key not in _scanners:
            _scanners[key] = Scanner(ordered, base)
        scanner = _scanners[key]
        for batch in batches:
            n = batch.num_rows
            column = batch.column(len(keep))
            count, places = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base_labels: list[set[str]] = [set() for _ in range(n)]
            labels: list[set[str]] = [set() for _ in range(n)]
            spans: list[list] = [[] for _ in range(n)]
            for w in tx.words(column, tx.ALNUM):
                bounds = w.bounds()
                rows = slice(w.first, w.first + w.rows)
                count[rows] = np.diff(bounds)
                for phrase, label in scanner.base:
                    for_start = np.flatnonzero(w.hash[: max(0, len(w.hash) - len(phrase) + 1)] == phrase[0]) if len(phrase) else []
                    for i in for_start:
                        row = w.row[i]
                        if i + len(phrase) <= bounds[row + 1] and (w.hash[i : i + len(phrase)] == phrase).all():
                            at, place = w.first + row, i - bounds[row]
                            places[at] += 1
                            first[at], last[at] = min(first[at], place), max(last[at], place)
                            base_labels[at].add(label)
            for at in range(n):
                raw = column[at].as_buffer() if column[at].is_valid else None
                found = scanner.found(raw.to_pybytes()) if raw is not None else set()
                if found:
                    lowered = column[at].as_py().translate(_LOWER)
                    spans[at] = [{"begin": a, "end": b, "label": x} for a, b, x in scanner.detections(lowered, found)]
                    labels[at] = {s["label"] for s in spans[at]}
            rules_found = np.array([len(s) for s in spans], np.int64)
            none = places == 0
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)], pa.array(count), pa.array(places), pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([",".join(sorted(x)) for x in base_labels]), pa.array([",".join(sorted(x | y)) for x, y in zip(base_labels, labels)]),
                    pa.array(1 - 0.5 ** (places + rules_found)), pa.array(rules_found), pa.array(spans, span),
                ],
                names,
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{kept}, {made}" if kept else made)


_LOWER = {c: c + 32 for c in range(65, 91)}
