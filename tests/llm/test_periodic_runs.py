"""Periodic runs against plain versions."""

import hashlib
import random
import re
import zlib

import pytest

from wordmill.llm import periodic_runs as R


def plain_lyndon(ranks):
    """By definition: the longest prefix that is smaller than all its proper suffixes."""
    out = []
    for i in range(len(ranks)):
        best = 1
        for j in range(i + 1, len(ranks) + 1):
            w = ranks[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_grouping_gives_lyndon_arrays(letters):
    rnd = random.Random(letters)
    for n in [0, 1, 2, 3, 5, 8, 13, 21, 30] * 12:
        w = [rnd.randrange(letters) for _ in range(n)]
        assert R.lyndon_array(w) == plain_lyndon(w)
        up = [-x for x in w]
        assert R.lyndon_array(up) == plain_lyndon(up)


def plain_runs(words, min_words=R.MIN_WORDS):
    """Every period over the whole text, by maximal stretches of equal words."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_words, 3 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def texts(seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(60):
        w = []
        while len(w) < rnd.choice([0, 20, 60, 200]):
            base = [rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))]
            if rnd.random() < 0.2:  # a repetition of repetitions
                base = base * rnd.randint(1, 9) + [rnd.choice("xy")]
            w += (base * rnd.randint(1, 12))[:rnd.randint(1, 90)]
        out.append(w)
    return [*out, ["a"] * 5_000, ["a", "b"] * 700 + ["a"]]


def test_runs_equal_every_period_tried():
    for w in texts(1):
        assert R.runs_of([x.encode() for x in w]) == plain_runs(w)
    some = [w for w in texts(2) if len(w) > 40]
    for w in some[:10]:
        assert R.runs_of([x.encode() for x in w], 4) == plain_runs(w, 4)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2])) if runs else (None, None, None)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def answer(r):
    return (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"])


def test_query_equals_the_plain_version(spark, sf):
    got = {r["doc_id"]: answer(r) for r in R.op12_periodic_runs(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [r for r in rows if len(r["text"] or "") < 9_000]
    assert len(short) > 900
    for r in short:
        assert got[r["doc_id"]] == plain_row(r["doc_id"], r["text"])
    assert sum(a[0] > 0 for a in got.values()) > 50


def test_odd_texts(spark, tmp_path, odd, empty):
    path = f"{tmp_path}/documents.parquet"
    odd.write.parquet(path)
    rows = R.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert len(rows) == odd.count()
    want = sorted((str(plain_row(r["doc_id"], r["text"])) for r in odd.filter("length(text) < 1000 OR text IS NULL").collect()))
    long = {str(answer(r)) for r in rows}
    assert set(want) <= long
    nines = next(r for r in rows if r["length"] == 9_000)
    assert (nines["start"], nines["period"], nines["exponent_milli"]) == (0, 1, 9_000_000)
    assert R.periodic_runs(empty).count() == 0
    kept = R.periodic_runs(odd, odd.drop("text").columns, prefix="found")
    assert kept.count() == odd.count() and set(odd.drop("text").columns) < set(kept.columns)


def test_no_exchange(spark, sf):
    plan = R.op12_periodic_runs(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
