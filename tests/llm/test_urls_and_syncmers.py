"""URL filters and document fingerprints against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.llm import syncmers as S
from wordmill.llm import url_filters as U

URLS = ["http://A.com/fr/x", "https://m.Example.org/es/1?q", "http://example.org/en/1", "http://example.org/en/2",
        "http://x.org", "http://x.org#f", "http://x.org?/es/", "a://b.net/c://d", "nourl", "", None, "://", "://x.com/de/",
        "http://notexample.org/es/", "http://com/fr/", "http://sub.com/de/y#z", "http://ü.com/fr/é", "line\nbreak://H.Org/a\nb?c"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_equal_plain_ones(spark):
    d = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("html", F.lit(""))
    got = {r["page_id"]: tuple(r)[1:] for r in U.judged_pages(U.parsed_pages(d)).collect()}
    assert got == {i: plain(u) for i, u in enumerate(URLS)}


def exact_rank(links, seeds):
    """The fixed point of the propagation, by elimination."""
    hosts = sorted({h for e in links for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    flow = np.zeros((len(hosts), len(hosts)))
    out = Counter()
    for s, _, n in links:
        out[s] += n
    for s, d, n in links:
        flow[at[d], at[s]] += U.DAMPING * n / out[s]
    rank = np.linalg.solve(np.eye(len(hosts)) - flow, [(1 - U.DAMPING) * seeds.get(h, 0.0) for h in hosts])
    return dict(zip(hosts, rank / rank.sum()))


def test_page_rank_equals_a_plain_one(spark):
    rnd = random.Random(1)
    links = list({(f"h{rnd.randrange(12)}", f"h{rnd.randrange(12)}"): None for _ in range(40)})
    links = [(s, d, float(rnd.randint(1, 4))) for s, d in links if s != d]
    seeds = {"h1": 0.25, "h2": 0.5, "lonely": 0.25}
    tables = (spark.createDataFrame(links, "src string, dst string, n double"),
              spark.createDataFrame(list(seeds.items()), "host string, weight double"))
    want = exact_rank(links, seeds)
    # no sum of doubles reaches the second tolerance: the steps end when the change stalls
    for tolerance in (1e-9, 0.0):
        got = {r["host"]: r["rank"] for r in U.page_rank(*tables, tolerance).collect()}
        assert set(got) <= set(want) and all(abs(got.get(h, 0.0) - want[h]) < 1e-8 for h in want)


def test_parent_domains(spark):
    hosts = ["a.b.example.org", "b.example.org", "example.org", "org", "", "1.2.3.4", "1.2.3.4:80", "x..y.z", ".a.b.c", "m.site.net:8"]
    got = {tuple(r) for r in U.parent_domains(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    assert got == {("a.b.example.org", "b.example.org"), ("b.example.org", "example.org"), ("m.site.net:8", "site.net:8")}


PAGES = [(1, "http://good.com/fr/1", '<a href="http://friend.net/x">'), (2, "http://bad.com/de/1", "no links"),
         (3, "http://farm.net/1", "<a href='//bad.com/'> <a HREF=http://BAD.com/2>"), (4, "http://friend.net/1", None),
         (5, "http://alone.net/", ""), (6, None, None), (7, "x", "y"), (1, "http://good.com/fr/1", None)]


def test_trust_flows_forward_and_distrust_backward(spark):
    d = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    rows = U.filter_urls(d).collect()
    assert len(rows) == len(PAGES)
    by = {r["page_id"]: r for r in rows}
    assert by[3]["verdict"] == "block" and by[3]["distrust"] > 0 and by[3]["trust"] == 0
    assert by[4]["verdict"] == "allow" and by[4]["trust"] > 0 and by[4]["distrust"] == 0
    assert by[5]["verdict"] == by[6]["verdict"] == by[7]["verdict"] == "allow"
    assert (by[1]["rule"], by[2]["rule"]) == ("com/fr/", "com/de/")
    assert U.filter_urls(d.filter("false")).count() == 0


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    """30 one-page hosts in a row, the last one linking to a host of many blocked pages."""
    heavy = 10_000
    names = [f"c{i}.net" for i in range(30)] + ["bad.com"]
    pages = spark.createDataFrame([(i, f"http://{a}/", f"<a href='http://{b}/'>") for i, (a, b) in enumerate(zip(names, names[1:]))],
                                  "page_id long, url string, html string")
    blocked = spark.range(heavy).select((F.col("id") + 100).alias("page_id"), F.lit("http://bad.com/de/").alias("url"),
                                        F.lit("").alias("html"))
    rows = {r["host"]: r for r in U.filter_urls(pages.unionByName(blocked)).collect()}
    want = exact_rank([(b, a, 1.0) for a, b in zip(names, names[1:])], {"bad.com": 1.0})
    for name in names[:-1]:
        assert abs(rows[name]["distrust"] - want[name] * heavy) < 1e-3 and rows[name]["verdict"] == "block"


@pytest.mark.parametrize("travels", [64 << 20, 0])
def test_page_rank_converges_on_cycles(spark, monkeypatch, travels):
    monkeypatch.setattr(U, "MAX_BROADCAST_BYTES", travels)
    links = [("a", "b", 1.0), ("b", "a", 3.0), ("b", "c", 1.0), ("c", "a", 1.0)]
    got = U.page_rank(spark.createDataFrame(links, "src string, dst string, n double"),
                      spark.createDataFrame([("a", 1.0)], "host string, weight double"), 1e-4)
    want = exact_rank(links, {"a": 1.0})
    got = {r["host"]: r["rank"] for r in got.collect()}
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 2e-4 for h in want)


def plain_verdicts(pages):
    """``{row: (host, path, rule, verdict)}`` of ``(url, html)`` rows, ranks by elimination."""
    judged = [plain(u) for u, _ in pages]
    count = Counter(h for h, *_ in judged)
    links = Counter()
    for (host, *_), (_, html) in zip(judged, pages):
        to = {plain("http:" + u if u.startswith("//") else u)[0]
              for u in re.findall(r"""(?i)href\s*=\s*["']?((?:https?:)?//[^\s"'<>]+)""", html or "")}
        for t in to - {"", host} if host else ():
            links[host, t] += 1.0
    ups = set()
    for host in count:
        while len(host.split(".")) > 2 and all(host.split(".")) and not re.fullmatch(r"[0-9.]+(:[0-9]*)?", host):
            ups.add((host, host.split(".", 1)[1]))
            host = host.split(".", 1)[1]
    for s, d in ups:
        links[s, d] += 1.0
        links[d, s] += 1.0
    forward = [(s, d, n) for (s, d), n in links.items()]
    marks = {}
    for verdict, graph in (("allow", forward), ("block", [(d, s, n) for s, d, n in forward])):
        seeds = Counter(h for h, _, _, v in judged if v == verdict and h)
        total = sum(seeds.values())
        rank = exact_rank(graph, {h: n / total for h, n in seeds.items()}) if total else {}
        marks[verdict] = {h: rank.get(h, 0.0) * total / n for h, n in count.items()}
    out = []
    for host, path, rule, verdict in judged:
        bad = marks["block"][host] >= U.MIN_DISTRUST and marks["block"][host] > U.RATIO * marks["allow"][host]
        # within the tolerance of the iteration either verdict is right
        close = abs(marks["block"][host] - U.MIN_DISTRUST) < 1e-3 or (
            marks["block"][host] > U.MIN_DISTRUST and abs(marks["block"][host] - U.RATIO * marks["allow"][host]) < 1e-3)
        out.append((host, path, rule, verdict or (None if close else "block" if bad else "allow")))
    return out


def test_url_query_equals_a_plain_filter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    want = dict(zip([p["page_id"] for p in pages], plain_verdicts([(p["url"], p["html"]) for p in pages])))
    got = {r["page_id"]: tuple(r)[1:5] for r in U.op5_url_filters(spark, sf).collect()}
    assert len(got) == len(pages)
    assert all(got[i][:3] == w[:3] and (w[3] is None or got[i][3] == w[3]) for i, w in want.items())
    assert sum(w[3] is None for w in want.values()) < len(want) / 10


def test_distrust_passes_between_hosts_of_a_domain(spark):
    rows = [("http://a.farm.com/de/", "")] * 40 + [("http://b.farm.com/x", ""), ("http://c.d.farm.com/x", None),
                                                 ("http://other.com/x", "<a href='//www.good.com'>"), ("http://www.good.com/fr/", "")]
    rows += [("http://long.com/" + "p" * 100_000, "<a href='http://x.com/'> " * 5_000), (None, None), ("", "")]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: tuple(r)[1:5] for r in U.filter_urls(d).collect()}
    want = plain_verdicts(rows)
    assert all(got[i] == w for i, w in enumerate(want))
    assert [w[3] for w in want[40:44]] == ["block", "block", "allow", "allow"]


def test_url_filter_uses_no_python(spark, sf, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    cut = U.cut_lineage
    monkeypatch.setattr(U, "cut_lineage", kept)
    plans.append(U.op5_url_filters(spark, sf)._jdf.queryExecution().executedPlan().toString())
    assert not any(re.search("Python|Pandas|Arrow|MapIn", p) for p in plans)
    assert sum(p.count("FileScan") for p in plans) == 1


def test_no_python_in_native_plans(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = S.next_documents(S.fingerprints(docs), ["text", "print"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan) and plan.count("Exchange hashpartitioning") == 1


def hashes_of(spark, words):
    """Spark's own hashes, for the plain version."""
    rows = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    return {r["w"]: r["h"] for r in rows}


def test_anchors_are_closed_syncmers(spark):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(30)}" for _ in range(60)]
    h = hashes_of(spark, words)
    pairs = [(h[a], h[b]) for a, b in zip(words, words[1:])]
    inner = {tuple(r[:2]): r[2] for r in spark.createDataFrame(pairs, "a long, b long").distinct().select(
        "a", "b", F.xxhash64("a", "b")).collect()}
    m = [inner[p] for p in pairs]
    want = 0
    for i in range(len(words) - S.K + 1):
        window = m[i:i + S.K - S.S + 1]
        want += min(window) in (window[0], window[-1])
    d = spark.createDataFrame([(" ".join(words),)], "text string")
    assert d.select(F.size(S.anchors(F.col("text"))).alias("n")).first()["n"] == want


def test_anchors_do_not_depend_on_the_surroundings(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(passage,), (f"before it {passage} and after",), ("a  b\t" + passage.replace(" ", "\n"),)]
    got = [r["a"] for r in spark.createDataFrame(rows, "text string").select(S.anchors(F.col("text")).alias("a")).collect()]
    assert all(set(got[0]) <= set(x) for x in got)
    pos = spark.createDataFrame([(got[0], got[1])], "a array<long>, b array<long>").select(
        S.offsets_agree(F.col("a"), F.col("b")).alias("o")).first()["o"]
    assert pos["n"] == len(set(got[0]))


def test_short_texts(spark):
    rows = [(t,) for t in ("", " \n", "one", "one  two", "one two three", "one two three")]
    got = [r["f"] for r in spark.createDataFrame(rows, "text string").select(S.fingerprint(F.col("text")).alias("f")).collect()]
    assert got[0] == got[1] == [] and [len(x) for x in got[2:]] == [1, 1, 1, 1]
    assert got[4] == got[5] != got[3]


def test_next_documents_over_many_ranges(spark):
    rnd = random.Random(4)
    for ids in ([rnd.choice([None, *range(40)]) for _ in range(80)], [None] * 5, [7], [],
                [rnd.randrange(-2**62, 2**62) for _ in range(90)]):
        rows = [(i, "t%03d" % rnd.randrange(200)) for i in ids]
        d = spark.createDataFrame(rows, "doc_id long, text string")
        o = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        want = sorted([(a[0], a[1], b[1]) for a, b in zip(o, o[1:] + o[:1])], key=str)
        for size in (3, 1000):
            assert sorted([tuple(r) for r in S.next_documents(d, ["text"], size).collect()], key=str) == want


def test_fingerprint_query_equals_plain_edits(spark, sf):
    texts = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    edited = {}
    for (d, t), (_, n) in zip(texts, texts[1:] + texts[:1]):
        k = len(t) // 3
        edited[d] = (len(t), hashlib.sha256((t[:len(t) - k] + n[:k]).encode()).hexdigest())
    rows = S.op10_syncmer_fingerprints(spark, sf).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == edited
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    nearer = [r["near_edited"] > r["near_next"] for r in rows if r["n_chars"] > 200]
    assert sum(nearer) / len(nearer) > 0.98
    by = {}
    for (d, t) in texts:
        by.setdefault(t, set()).add(next(r["fingerprint"] for r in rows if r["doc_id"] == d))
    assert all(len(x) == 1 for x in by.values())


def test_odd_and_empty_documents(odd, empty):
    prints = S.fingerprints(odd)
    assert S.next_documents(prints, ["text", "print"]).count() == odd.count()
    assert S.next_documents(S.fingerprints(empty), ["text", "print"]).count() == 0


def plain_compared(a, b):
    """Likeness, anchors on the best shift and that shift, of lists of (hash, place)."""
    first = [{h: p for h, p in reversed(x)} for x in (a, b)]
    votes = Counter(first[1][h] - first[0][h] for h in first[0].keys() & first[1].keys())
    union = first[0].keys() | first[1].keys()
    shift = max(votes, key=lambda d: (votes[d], d), default=None)
    n = 0 if shift is None else len(set(a) & {(h, p - shift) for h, p in b})
    return (len(first[0].keys() & first[1].keys()) / len(union) if union else 1.0), n, shift


def test_whole_anchor_arrays_equal_a_plain_comparison(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randrange(v)}" for _ in range(n)) for v, n in
             ((5, 60), (5, 80), (40, 200), (40, 90), (900, 500), (900, 400), (2, 3), (1, 50))] + ["", "one two", "one two"]
    texts += [texts[4][:900] + " x " + texts[2], texts[4]]
    rows = spark.createDataFrame([(x, y) for x in texts for y in texts], "x string, y string").select(
        S.placed_anchors(F.col("x")).alias("a"), S.placed_anchors(F.col("y")).alias("b"))
    for r in rows.select("a", "b", S.compared(F.col("a"), F.col("b")).alias("c")).collect():
        assert tuple(r["c"]) == plain_compared([tuple(x) for x in r["a"]], [tuple(x) for x in r["b"]])


def test_a_short_passage_shared_by_long_documents_is_found_at_its_place(spark):
    passage = [f"shared{i}" for i in range(100)]
    first, second = ([f"{side}{i}" for i in range(20_000)] for side in "ab")
    first[15_000:15_100], second[300:400] = passage, passage
    d = spark.createDataFrame([(2, " ".join(first)), (1, " ".join(second))], "doc_id long, text string")
    inside = d.select(F.size(S.anchors(F.lit(" ".join(passage))))).first()[0]
    r = next(r for r in S.compared_documents(d).collect() if r["doc_id"] == 2)
    assert r["near_next"] > 0
    assert (r["next_n"], r["next_shift"]) == (inside, 300 - 15_000)
    assert r["edited_shift"] == 0 and r["edited_n"] > 8_000
