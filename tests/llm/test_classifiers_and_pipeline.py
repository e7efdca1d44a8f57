"""Language identification, quality classifier and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from wordmill.llm import language_id as L
from wordmill.llm import quality_classifier as Q

SF1 = "/root/testdata/sf0.1"


def held(doc_id, m, r):
    return zlib.crc32(str(doc_id).encode()) % m == r


def test_language_held_out_accuracy(spark, sf):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = L.op8_language_id(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in rows)
    out = [r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(out) / len(out) > 0.98


def test_language_ignores_labels_of_held_out_rows(spark, sf):
    """Changing lang, source and every held-out label changes no prediction."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 300")
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(d, L.fit(d, ~L.held_out())).collect()} for d in (docs, other))
    assert a == b


def test_kernel_of_presence_features():
    import pyarrow as pa
    from wordmill.llm import textbytes as B
    _, _, data, offsets = next(B.blocks(pa.array(["abc abc", "ABC  abc!", "xyz", ""])))
    x = L.presence(data, offsets)
    assert set(np.unique(x)) == {0.0, 1.0} and not x[3].any()
    assert (x[0] == L.presence(np.frombuffer(b"abc abc", np.uint8), np.array([0, 7]))[0]).all()
    grams = {s[i:i + k] for s in (b"xyz",) for k in (1, 2, 3, 4) for i in range(len(s) - k + 1)}
    assert 0 < x[2].sum() <= len(grams)


def test_language_odd_and_empty(spark, odd, empty):
    got = {r["doc_id"]: r["lang_pred"] for r in L.predict(odd.filter("doc_id IS NOT NULL"), L.fit_texts(["hello there"], ["en"]),
                                                           pred_name="p_", score_name="s_").select("doc_id", F.col("p_").alias("lang_pred")).collect()}
    assert got[1] == got[2] == "und" and got[3] == "en" and got[6] == "en"
    assert L.predict(odd, None, pred_name="p_", score_name="s_").filter("p_ <> 'und'").count() == 0
    assert L.predict(odd, L.fit(odd), ["doc_id", "score"], "p_", "s_").count() == odd.count()
    assert L.predict(empty, L.fit(empty), pred_name="p_", score_name="s_").count() == 0


def test_quality_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = Q.op9_quality_classifier(spark, SF1).collect()
    assert len(rows) == spark.read.parquet(f"{SF1}/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    out = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in out) / len(out) > 0.95
    assert sum(a for a, b in out if b == 1) / sum(b for _, b in out) > 0.98


def test_quality_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    for model in (Q.fit(odd, labels), Q.UNFITTED, Q.fit(odd, labels.filter("quality = 1"))):
        rows = Q.score(odd, model, ["doc_id", "score"], "q_").collect()
        assert len(rows) == odd.count()
        assert all(0.0 <= r["q_"] <= 1.0 and (r["text"] or r["q_"] == 0.0) for r in rows)
    assert Q.score(empty, Q.fit(empty, labels), name="q_").count() == 0


def test_fitting_does_not_use_more_than_asked(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q._label_rows(labels, ~Q.held_out(), 5).collect()
    assert len(rows) == 10 and not any(held(r["doc_id"], 5, 0) for r in rows)
    assert Q.fit(docs, labels, ~Q.held_out(), 20).usable


FOREIGN = {
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. ",
    "czech": "Všichni lidé se rodí svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím. ",
    "chinese": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом. ",
}


def folded(text):
    out = []
    for b in (text or "").encode():
        c = b + 32 if 65 <= b <= 90 else b
        out.append(c if 97 <= c <= 122 or c >= 128 else 32)
    return out


def plain_trigrams(text):
    f = folded(text)
    return [tuple(f[i:i + 3]) for i in range(len(f) - 2) if sum(c != 32 for c in f[i:i + 3]) >= 2]


def test_known_share_equals_a_plain_one(some_texts):
    import pyarrow as pa
    from wordmill.llm import textbytes as B
    texts = list(some_texts.values())
    train, rest = texts[:40], [*texts[40:70], "", "ab", None, "1 2 3", *FOREIGN.values()]
    seen = {g for t in train for g in plain_trigrams(t)}
    known = L._known_of(train)
    got = [x for _, _, d, o in B.blocks(pa.array(rest, pa.string()), 5_000) for x in zip(*map(np.ndarray.tolist, L.known_share(d, o, known)))]
    for t, (share, n) in zip(rest, got, strict=True):
        grams = plain_trigrams(t)
        assert n == len(grams) and abs(share - (sum(g in seen for g in grams) / n if n else 1.0)) < 1e-12


def plain_kernel_model(texts, langs):
    """Presence sets, kernel |A & B| / sqrt(|A| |B|), ridge on the Nystroem features."""
    def grams(seg):
        f, out = [int(L._FOLD[b]) for b in seg], set()
        for k in L.ORDERS:
            for i in range(len(f) - k + 1):
                g = 0
                for b in f[i:i + k]:
                    g = (g << 8 | b) & 0xFFFFFFFF
                h = (g * 0x9E3779B1 + k * 0x05EBCA6B & 0xFFFFFFFF) * 0xC2B2AE35 & 0xFFFFFFFF
                out.add(h >> (32 - L.DIMS.bit_length() + 1))
        return out

    def segs(t):
        b = t.encode()
        return [b[i:i + L.SEGMENT] for i in range(0, max(len(b), 1), L.SEGMENT)]

    def k(a, b):
        return len(a & b) / max(len(a) * len(b), 1) ** 0.5
    names = sorted(set(langs))
    marks = [grams(segs(t)[0]) for n in names for t in [t for t, y in zip(texts, langs) if y == n][:L.LANDMARKS]]
    rows = [(grams(s), names.index(y), len(s)) for t, y in zip(texts, langs) for s in segs(t)]
    total = [sum(n for _, y, n in rows if y == i) for i in range(len(names))]
    w = np.array([n / total[y] * len(rows) / len(names) for _, y, n in rows])
    k_mm = np.array([[k(a, b) for b in marks] for a in marks])
    value, vector = np.linalg.eigh(k_mm)
    keep = value > 1e-6 * value.max()
    half = vector[:, keep] / np.sqrt(value[keep])
    z = np.array([[k(x, m) for m in marks] for x, _, _ in rows]) @ half
    target = np.array([[1.0 if y == i else -1.0 for i in range(len(names))] for _, y, _ in rows])
    beta = np.linalg.solve(z.T @ (z * w[:, None]) + L.RIDGE * np.eye(z.shape[1]), z.T @ (target * w[:, None]))

    def score(text):
        parts = segs(text)
        f = np.array([[k(grams(s), m) for m in marks] for s in parts]) @ half @ beta
        f = (f * np.array([len(s) for s in parts])[:, None]).sum(0) / max(sum(map(len, parts)), 1)
        return names[int(f.argmax())], min(max((f.max() + 1) / 2, 0.0), 1.0)
    return score


def test_language_scores_equal_a_plain_kernel_ridge(spark, sf):
    rows = [r for r in spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 150 AND length(text) < 900").orderBy("doc_id").collect()
            if r["lang"] is not None]
    train, test = rows[:36], rows[36:50]
    model = L.fit_texts([r["text"] for r in train], [r["lang"] for r in train])
    plain = plain_kernel_model([r["text"] for r in train], [r["lang"] for r in train])
    d = spark.createDataFrame([(r["doc_id"], r["text"]) for r in test], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(d, model).collect()}
    for r in test:
        lang, score = plain(r["text"])
        assert got[r["doc_id"]][0] == lang and abs(got[r["doc_id"]][1] - score) < 1e-3


def test_language_stage_rejects_unlearned_languages_and_no_clean_text(spark, sf):
    rnd = np.random.default_rng(4)
    noise = " ".join("".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 10))) for _ in range(150))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [*(t * 3 for t in FOREIGN.values()), noise, "123 !!", ""]
    planted = spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    out = C.language(spark, docs.unionByName(planted, allowMissingColumns=True), sf)
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    letters = {r["doc_id"] for r in docs.filter(F.col("text").rlike("\\p{L}")).select("doc_id").collect()}
    assert kept == letters  # every clean document, and none of the planted ones


def test_quality_scores_equal_a_plain_compression_score(spark, sf):
    import math
    import zstandard
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    m = Q.fit(docs, labels, ~Q.held_out())
    rows = docs.filter("doc_id < 40").collect()
    got = {r["doc_id"]: r["score"] for r in Q.score(docs.filter("doc_id < 40"), m).collect()}

    def size(part, body=None):
        kw = {"dict_data": zstandard.ZstdCompressionDict(body), "write_dict_id": False} if body else {}
        return len(zstandard.ZstdCompressor(level=Q.LEVEL, write_content_size=False, write_checksum=False, **kw).compress(part))
    for r in rows:
        t = (r["text"] or "").encode()
        parts = [t[i:i + Q.SEGMENT] for i in range(0, len(t), Q.SEGMENT)]
        if not parts:
            assert got[r["doc_id"]] == 0.0
            continue
        sizes = [(size(p), size(p, m.good), size(p, m.bad)) for p in parts]
        plain, good, bad = (sum(s[i] for s in sizes) for i in range(3))
        gap, ratio, best = (bad - good) / min(good, bad), math.log(plain / len(t)), math.log(min(good, bad) / len(t))
        gaps = [(s[2] - s[1]) / min(s[1], s[2]) for s, p in zip(sizes, parts) if len(p) >= Q.SEGMENT // 4]
        worst = min(gaps) if gaps else gap
        x = [gap, worst, ratio, best, gap * ratio, ratio * ratio, gap * abs(gap), math.log(len(t)), worst * abs(worst)]
        z = sum((a - b) / c * w for a, b, c, w in zip(x, m.mean, m.scale, m.weights)) + m.weights[-1]
        assert abs(got[r["doc_id"]] - 1 / (1 + math.exp(-min(max(z, -30), 30)))) < 1e-9


def plain_stage(name, docs, spark, sf):
    """Ids that a stage keeps, from the operators' own results."""
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    if name == "quality":
        m = Q.fit(d, spark.read.parquet(f"{sf}/labels.parquet"), ~Q.held_out())
        sizes = Q.Sizes(m.good, m.bad)
        scores = Q.score_texts(m, sizes, [(r[1] or "").encode() for r in docs])
        return {r[0] for r, s in zip(docs, scores) if s >= Q.THRESHOLD}
    if name == "language":
        return {r[0] for r in docs if r[1] and any(c.isalpha() for c in r[1])}
    from test_near_dups import plain_components
    return {d for d, (_, _, kept) in plain_components([(r[0], r[1]) for r in docs]).items() if kept}


def test_stages_keep_what_plain_versions_keep(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 400").withColumn("lang_pred", F.lit("clash"))
    for name, stage in C.STAGES[:-1]:
        before = [tuple(r)[:5] for r in docs.collect()]
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == docs.columns
        assert {r["doc_id"] for r in after.select("doc_id").collect()} == plain_stage(name, before, spark, sf)
        docs = after
    assert {r["doc_id"] for r in C.pack(spark, docs, sf).collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_runs_on_the_whole_table(spark, sf):
    assert [n for n, _ in C.STAGES] == ["quality", "language", "near_dedup", "packing"]
    rows = C.run(spark, sf).collect()
    assert 500 < len({r["doc_id"] for r in rows}) < 1000


def test_stages_on_odd_and_empty_tables(spark, odd, empty, sf):
    wide = odd.withColumn("quality_score", F.lit("clash")).withColumn("row_of_id", F.lit(1)).withColumn("gone_id", F.lit(2))
    for docs in (wide, wide.filter("false")):
        for name, stage in C.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() <= max(docs.count() * 20, 0)


def test_rows_of_one_id_with_different_texts_are_kept(spark, sf):
    """Only near duplicates go: id 7 stands for two unrelated texts, one of them a copy of
    that of id 3; id 9 repeats one row; ids 5 and 8 are near each other."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(7, a), (7, b), (3, b), (9, c), (9, c), (8, d + " end"), (8, a + " " + c), (5, d), (None, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    out = C.near_dedup(spark, docs, sf)
    assert out.columns == docs.columns
    want = [(7, a), (3, b), (9, c), (8, a + " " + c), (5, d), (None, d)]
    assert sorted((tuple(r)[:2] for r in out.collect()), key=str) == sorted(want, key=str)
