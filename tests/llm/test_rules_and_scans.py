"""Quality rules and license scan against plain versions."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from wordmill.llm import license_scan as L
from wordmill.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(wins)
    covered = {j for i, w in enumerate(wins) if count[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_plain_ones(spark, some_texts, odd):
    d = spark.createDataFrame([(i, t) for i, t in some_texts.items()], "doc_id long, text string")
    for df in (d, odd):
        rows = df.select("doc_id", "text").collect()
        got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                      for r in Q.ledger(df).collect())
        assert got == Counter((r["doc_id"], *plain_measures(r["text"])) for r in rows)


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(Q.ORACLE).fetchall())
    got = sorted(tuple(r) for r in Q.op1_quality_rules(spark, sf).collect())
    assert got == want


def test_ablation_equals_recounting(spark, sf):
    led = Q.ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    bits = [r["failed_bits"] for r in led.select("failed_bits").collect()]
    policy = Q.POLICIES["v2"]
    for r in Q.ablation(led, policy).collect():
        bit = 1 << next(x.bit for x in Q.RULES if x.name == r["rule"])
        assert r["n_failed"] == sum(1 for b in bits if b & bit)
        assert r["n_failed_alone"] == sum(1 for b in bits if b & policy.mask == bit)
    kept = Q.apply_policy(led, Q.POLICIES["v1-base"]).filter("kept").count()
    assert kept == sum(1 for b in bits if not b & Q.BASE_BITS)


def test_empty_tables(empty):
    assert Q.apply_policy(Q.ledger(empty)).count() == 0 and L.scan(empty).count() == 0


LWORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_places(text):
    words = LWORD.findall((text or "").encode().lower().decode())
    found = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return (len(words), len(found), min(found)[0] if found else None, max(found)[0] if found else None,
            ",".join(sorted({x for _, x in found})))


LICENSED = ["All rights reserved. all  RIGHTS-reserved", "CC BY-NC 4.0 cc/by", "xcc by", "cc byé", "ccc by cc by",
            "GNU General Public License v3", "general, public; license", "All rights\nreserved.", "cc 1 by"]


def test_base_places_equal_plain_ones(spark, some_texts, odd):
    texts = list(some_texts.values()) + LICENSED
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for df in (d, odd):
        rows = df.select("doc_id", "text").collect()
        got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                      for r in L.scan(df).collect())
        assert got == Counter((r["doc_id"], *plain_places(r["text"])) for r in rows)


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("SPDX-License-Identifier: GPL-2.0-only", {"gpl-2.0"}),
    ("Permission is hereby granted, free of charge, to any person", {"mit"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}),
    ("See https://www.gnu.org/licenses/gpl-3.0.html", {"gpl-3.0"}),
    ("nothing to see, mit freundlichen Grüßen", set()),
])
def test_labels(text, labels):
    s = L.Scanner()
    kept = {r.label for _, _, r, k in s.resolve(s.detections(text.encode().lower().decode())) if k}
    assert kept == labels


def test_hundreds_of_rules_and_gates_lose_no_match():
    """Running every regex without the keyword gates finds the same."""
    s = L.Scanner()
    assert len(L.RULES) >= 300
    texts = [f"licensed under the terms of the {n} license version 2.0, {a}" for _, names, _, a in L.LICENSES for n in names]
    texts += [x for _, x, _ in L.NOTICES] + LICENSED + ["© 2020 someone", "Copyright (c) 1999"]
    for t in texts:
        low = t.encode().lower().decode()
        every = sorted((m.start(), m.end(), r.label, r.form) for r, p in s.rules for m in p.finditer(low))
        assert every == sorted((a, b, r.label, r.form) for a, b, r in s.detections(low)), t


def test_containment_suppression_equals_a_pairwise_one():
    import random
    rnd = random.Random(5)
    rules = [L.Rule(f"l{p}", "x", "", (), p, 0.5, p == 9) for p in range(10)]
    for _ in range(300):
        found = [(a, a + rnd.randint(1, 9), rnd.choice(rules)) for a in (rnd.randint(0, 20) for _ in range(12))]
        kept = []
        for d in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label)):
            inside = any(k[0] <= d[0] and d[1] <= k[1] for k in kept if not k[2].always)
            if d[2].always or not inside:
                kept.append(d)
        got = [(a, b, r) for a, b, r, k in L.Scanner.resolve(found) if k]
        assert sorted(map(str, got)) == sorted(map(str, kept))


def test_scores_lie_between_0_and_1(odd):
    assert L.scan(odd).filter(~F.col("score").between(0, 1)).count() == 0
