"""License scan by ordered signature rules (operator 2).

Several hundred regexes, each with a label, a priority and keywords that any match
contains. A text is searched for the keywords first (one Aho-Corasick pass), and a
regex runs only where all its keywords occur. Detections are then taken in order of
priority and length; one that lies inside an accepted detection is suppressed, unless
its rule is marked as always kept.

Texts are lower-cased A-Z only. Words are runs of digits, a-z and non-ASCII
characters. Null and empty texts have no words, no labels and score 0. Repeated rows
give repeated results; extra columns are ignored."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B

_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORD_CHAR = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORDS = re.compile(_WORD_CHAR + "+")


@dataclass(frozen=True)
class Rule:
    """``keywords``: every match contains all of them. ``always``: never suppressed."""

    label: str
    form: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    weight: float
    always: bool = False


# Phrases whose places the contract counts, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (label, names as written in prose, SPDX identifiers, a piece of its web address).
LICENSES = (
    ("apache-2.0", ("apache", "apache 2.0", "asl 2.0"), ("apache-2.0",), "apache.org/licenses"),
    ("mit", ("mit", "expat"), ("mit", "mit-0"), "opensource.org/licenses/mit"),
    ("isc", ("isc",), ("isc",), "opensource.org/licenses/isc"),
    ("bsd-2-clause", ("2-clause bsd", "simplified bsd", "freebsd"), ("bsd-2-clause",), "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", ("3-clause bsd", "new bsd", "modified bsd", "revised bsd"), ("bsd-3-clause",), "opensource.org/licenses/bsd-3-clause"),
    ("bsd", ("bsd", "bsd-style"), ("0bsd", "bsd-4-clause"), "opensource.org/licenses/bsd-license"),
    ("gpl-2.0", ("gnu gpl version 2", "gnu gpl v2", "gplv2", "gpl version 2"), ("gpl-2.0-only", "gpl-2.0-or-later", "gpl-2.0"), "gnu.org/licenses/old-licenses/gpl-2.0"),
    ("gpl-3.0", ("gnu gpl version 3", "gnu gpl v3", "gplv3", "gpl version 3"), ("gpl-3.0-only", "gpl-3.0-or-later", "gpl-3.0"), "gnu.org/licenses/gpl-3.0"),
    ("gpl", ("gnu general public", "gnu gpl", "gpl"), ("gpl-1.0-or-later",), "gnu.org/licenses/gpl"),
    ("lgpl", ("gnu lesser general public", "gnu library general public", "gnu lgpl", "lgpl"), ("lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0-only", "lgpl-3.0-or-later"), "gnu.org/licenses/lgpl"),
    ("agpl", ("gnu affero general public", "affero general public", "gnu agpl", "agpl"), ("agpl-3.0-only", "agpl-3.0-or-later"), "gnu.org/licenses/agpl"),
    ("gfdl", ("gnu free documentation", "gfdl"), ("gfdl-1.3-only", "gfdl-1.3-or-later"), "gnu.org/licenses/fdl"),
    ("mpl", ("mozilla public", "mpl"), ("mpl-1.1", "mpl-2.0"), "mozilla.org/mpl"),
    ("epl", ("eclipse public", "epl"), ("epl-1.0", "epl-2.0"), "eclipse.org/legal/epl"),
    ("cddl", ("common development and distribution", "cddl"), ("cddl-1.0", "cddl-1.1"), "opensource.org/licenses/cddl"),
    ("cpl", ("common public",), ("cpl-1.0",), "opensource.org/licenses/cpl"),
    ("eupl", ("european union public", "eupl"), ("eupl-1.1", "eupl-1.2"), "eupl.eu"),
    ("artistic", ("artistic", "perl artistic"), ("artistic-1.0", "artistic-2.0"), "opensource.org/licenses/artistic"),
    ("boost", ("boost software", "boost"), ("bsl-1.0",), "boost.org/license_1_0"),
    ("zlib", ("zlib", "zlib/libpng", "libpng"), ("zlib", "libpng"), "opensource.org/licenses/zlib"),
    ("unlicense", ("unlicense",), ("unlicense",), "unlicense.org"),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public"), ("wtfpl",), "wtfpl.net"),
    ("psf", ("python software foundation", "psf"), ("psf-2.0", "python-2.0"), "docs.python.org/3/license"),
    ("php", ("php",), ("php-3.0", "php-3.01"), "php.net/license"),
    ("ofl", ("sil open font", "open font"), ("ofl-1.1",), "scripts.sil.org/ofl"),
    ("ms-pl", ("microsoft public", "ms-pl"), ("ms-pl",), "opensource.org/licenses/ms-pl"),
    ("ms-rl", ("microsoft reciprocal", "ms-rl"), ("ms-rl",), "opensource.org/licenses/ms-rl"),
    ("sspl", ("server side public", "sspl"), ("sspl-1.0",), "mongodb.com/licensing/server-side-public-license"),
    ("busl", ("business source",), ("busl-1.1",), "mariadb.com/bsl"),
    ("elastic", ("elastic",), ("elastic-2.0",), "elastic.co/licensing/elastic-license"),
    ("ecl", ("educational community",), ("ecl-2.0",), "opensource.org/licenses/ecl"),
    ("afl", ("academic free",), ("afl-3.0",), "opensource.org/licenses/afl"),
    ("osl", ("open software",), ("osl-3.0",), "opensource.org/licenses/osl"),
    ("upl", ("universal permissive",), ("upl-1.0",), "oss.oracle.com/licenses/upl"),
    ("ncsa", ("university of illinois/ncsa open source", "ncsa"), ("ncsa",), "opensource.org/licenses/ncsa"),
    ("postgresql", ("postgresql",), ("postgresql",), "postgresql.org/about/licence"),
    ("cecill", ("cecill", "cecill-b", "cecill-c"), ("cecill-2.1", "cecill-b", "cecill-c"), "cecill.info/licences"),
    ("odbl", ("open database", "odbl"), ("odbl-1.0",), "opendatacommons.org/licenses/odbl"),
    ("odc-by", ("open data commons attribution", "odc-by"), ("odc-by-1.0",), "opendatacommons.org/licenses/by"),
    ("pddl", ("public domain dedication and",), ("pddl-1.0",), "opendatacommons.org/licenses/pddl"),
    ("ogl", ("open government",), ("ogl-uk-3.0",), "nationalarchives.gov.uk/doc/open-government-licence"),
    ("openrail", ("openrail", "openrail-m", "bigscience rail"), (), "huggingface.co/spaces/bigscience/license"),
    ("llama", ("llama community", "llama 2 community", "llama 3 community"), (), "ai.meta.com/llama/license"),
    ("cc0", ("cc0", "creative commons zero"), ("cc0-1.0",), "creativecommons.org/publicdomain/zero"),
    ("cc-by-nc-nd", ("cc by-nc-nd", "attribution-noncommercial-noderivatives"), ("cc-by-nc-nd-4.0", "cc-by-nc-nd-3.0"), "creativecommons.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", ("cc by-nc-sa", "attribution-noncommercial-sharealike"), ("cc-by-nc-sa-4.0", "cc-by-nc-sa-3.0"), "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc", ("cc by-nc", "attribution-noncommercial"), ("cc-by-nc-4.0", "cc-by-nc-3.0"), "creativecommons.org/licenses/by-nc"),
    ("cc-by-nd", ("cc by-nd", "attribution-noderivatives"), ("cc-by-nd-4.0", "cc-by-nd-3.0"), "creativecommons.org/licenses/by-nd"),
    ("cc-by-sa", ("cc by-sa", "attribution-sharealike"), ("cc-by-sa-4.0", "cc-by-sa-3.0"), "creativecommons.org/licenses/by-sa"),
    ("cc-by", ("creative commons attribution",), ("cc-by-4.0", "cc-by-3.0"), "creativecommons.org/licenses/by/"),
)

# Fixed values: (label, sentence of the licence's own text, a keyword of it).
NOTICES = (
    ("mit", "permission is hereby granted, free of charge, to any person", "hereby granted"),
    ("isc", "permission to use, copy, modify, and/or distribute this software", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use"),
    ("bsd-3-clause", "neither the name of", "neither the name"),
    ("gpl", "this program is free software", "free software"),
    ("gpl", "either version 2 of the license, or (at your option) any later version", "at your option"),
    ("gpl-3.0", "either version 3 of the license, or (at your option) any later version", "at your option"),
    ("lgpl", "this library is free software", "free software"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "in compliance with"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "source code form"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", "released into the public domain", "public domain"),
    ("public-domain", "dedicated to the public domain", "public domain"),
    ("zlib", "this software is provided 'as-is', without any express or implied warranty", "as-is"),
    ("proprietary", "proprietary and confidential", "proprietary"),
    ("proprietary", "may not be reproduced without", "be reproduced"),
    ("proprietary", "unauthorized copying of this", "unauthorized copying"),
    ("copyright", "no part of this publication may be reproduced", "be reproduced"),
)

# A name with one of these names its licence even without the word "license".
DISTINCT = ("gnu ", "gpl", "bsd", "cc by", "creative commons", "apache 2")


def _gap(text: str) -> str:
    """``text`` as a pattern in which any white space fits a blank and any two or three
    dash or blank characters fit a dash."""
    return "".join(r"\s+" if c == " " else r"[\s-]" if c == "-" else re.escape(c) for c in text)


def _longest_literal(text: str) -> str:
    return max(re.split(r"[ -]", text), key=len)


def phrase_pattern(phrase: str) -> str:
    """Places where the words of ``phrase`` stand consecutively."""
    return f"(?<!{_WORD_CHAR})" + f"{_SEP}+".join(map(re.escape, phrase.split())) + f"(?!{_WORD_CHAR})"


def _build() -> tuple[Rule, ...]:
    rules = [Rule(label, "phrase", phrase_pattern(phrase), (max(phrase.split(), key=len),), 100, 0.5, True)
             for phrase, label in PHRASES.items()]
    version = r"(?:,?\s+(?:version\s+|v\.?\s?)?\d+(?:\.\d+)*)?"
    for label, names, ids, address in LICENSES:
        for spdx in ids:
            rules.append(Rule(label, "spdx", rf"spdx-license-identifier\s*:\s*{re.escape(spdx)}(?![\w.-]*[\w])",
                              ("spdx-license-identifier", spdx), 90, 0.99))
        rules.append(Rule(label, "address", re.escape(address), (address,), 80, 0.95))
        for name in names:
            body, key = _gap(name), _longest_literal(name)
            rules.append(Rule(label, "grant", r"\b(?:licen[sc]ed|released|distributed|available|published|provided)"
                              rf"\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{body}\b"
                              rf"(?:\s+(?:public\s+)?licen[sc]e)?{version}", ("under", key), 70, 0.95))
            rules.append(Rule(label, "name", rf"\b{body}\s+(?:public\s+)?licen[sc]e\b{version}", ("licen", key), 50, 0.8))
            if any(m in name for m in DISTINCT):
                rules.append(Rule(label, "mention", rf"\b{body}\b{version}", (key,), 40, 0.5))
    for label, sentence, key in NOTICES:
        rules.append(Rule(label, "notice", rf"\b{_gap(sentence)}", (max(key.split(), key=len),), 75, 0.9))
    rules.append(Rule("copyright", "holder", r"(?:\bcopyright\s+(?:\(c\)|©)?\s*|©\s*|\(c\)\s+copyright\s+)\d{4}", (), 30, 0.3))
    return tuple(rules)


RULES = _build()
#: A text without any of these has no match of any rule without going further.
_HOLDER_KEYS = ("copyright", "©")


class Scanner:
    """Finds and resolves detections in one lower-cased text."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = [(r, re.compile(r.pattern)) for r in rules]
        keys = sorted({k for r in rules for k in r.keywords} | set(_HOLDER_KEYS))
        # one pass finds the rarer keywords; the others are looked for only then
        self.gates = sorted({max(r.keywords, key=len) if r.keywords else k
                             for r in rules for k in (_HOLDER_KEYS if not r.keywords else ("",))})
        self.automaton = ahocorasick.Automaton()
        for key in keys:
            if key in self.gates:
                self.automaton.add_word(key, key)
        self.automaton.make_automaton()

    def detections(self, low: str) -> list[tuple[int, int, Rule]]:
        present = {key for _, key in self.automaton.iter(low)}
        if not present:
            return []
        out = []
        for rule, pattern in self.rules:
            if rule.keywords:
                if max(rule.keywords, key=len) not in present or not all(k in low for k in rule.keywords):
                    continue
            elif not present.intersection(_HOLDER_KEYS):
                continue
            out += [(m.start(), m.end(), rule) for m in pattern.finditer(low)]
        return out

    @staticmethod
    def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule, bool]]:
        """All detections in order of their place, each with whether it is kept.

        Candidates go by (priority, length, place). ``ends`` holds, per start of an
        accepted detection in order, the furthest end of any start up to it, so that
        containment is one look-up."""
        order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
        starts: list[int] = []
        ends: list[int] = []
        out = []
        for start, end, rule in order:
            at = bisect.bisect_right(starts, start)
            inside = at > 0 and ends[at - 1] >= end
            kept = rule.always or not inside
            if kept and not rule.always:
                starts.insert(at, start)
                ends.insert(at, max(end, ends[at - 1] if at else end))
                for i in range(at + 1, len(ends)):
                    if ends[i] >= end:
                        break
                    ends[i] = end
            out.append((start, end, rule, kept))
        return sorted(out, key=lambda d: (d[0], d[1], d[2].label))


@lru_cache(1)
def _scanner() -> Scanner:
    return Scanner()


_DETECTION = pa.struct([("label", pa.string()), ("form", pa.string()), ("start", pa.int64()),
                        ("end", pa.int64()), ("kept", pa.bool_())])
_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, detections array<struct<label string, form string, start long, end long, kept boolean>>")


def _scan_text(scanner: Scanner, low: str) -> tuple:
    found = scanner.detections(low)
    if not found:
        return 0, None, None, "", "", 0.0, []
    resolved = scanner.resolve(found)
    base = [(s, r.label) for s, _, r, _ in resolved if r.form == "phrase"]
    first = last = None
    if base:
        starts = [m.start() for m in _WORDS.finditer(low)]
        first, last = (bisect.bisect_left(starts, p) for p in (base[0][0], base[-1][0]))
    miss = 1.0
    for label in {r.label for _, _, r, kept in resolved if kept}:
        miss *= 1.0 - max(r.weight for _, _, r, kept in resolved if kept and r.label == label)
    return (len(base), first, last, ",".join(sorted({x for _, x in base})),
            ",".join(sorted({r.label for _, _, r, kept in resolved if kept})), 1.0 - miss,
            [{"label": r.label, "form": r.form, "start": s, "end": e, "kept": k} for s, e, r, k in resolved])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = _scanner()
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(_DETECTION)]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    for batch in batches:
        for row, end, data, offsets in B.blocks(batch.column(1)):
            low = B.lower_ascii(data)
            _, _, first = B.spans(low, offsets, B.NOT_WORD)
            body, cuts = low.tobytes(), offsets.tolist()
            rows = [_scan_text(scanner, body[a:b].decode()) for a, b in zip(cuts, cuts[1:])]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, end - row), pa.array(first[1:] - first[:-1]), *columns], names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word count, base places, labels, score, and every
    detection with its character span and whether it was kept. One narrow pass."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(_scan_batches, _SCHEMA)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``; ``n_suppressed`` counts detections that lost to another."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("n_suppressed", F.size(F.filter("detections", lambda d: ~d["kept"])).cast("long")).drop("detections")
