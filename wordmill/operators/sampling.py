"""Deterministic sampling and splitting (M1-M9).

Every row gets the key ``(md5(seed ':' id), id)``; a sample of size ``q`` is the first
``q`` rows in key order, so samples with one seed are nested and independent of the
partitioning. Exact prefixes are found without a global sort:

1. count rows per (stratum, leading 4 hex digits of the hash): at most 65,536 buckets
   per stratum, partially aggregated before the shuffle;
2. a running sum over that small table finds, per stratum, the one bucket where the
   quota ends; only the rows of that bucket (about n/65,536 per stratum) are ranked,
   giving the key of the q-th row as a threshold;
3. the output is a narrow filter ``key <= threshold`` against a broadcast table of one
   row per stratum.

Per-class quotas for few-shot draws (M5) use ranking windows instead, in two levels:
Spark plans the first with a partial ``WindowGroupLimit`` before the shuffle, so each task
ships at most ``n`` rows per class; they meet in ``SALTS`` shares of a class, of which the
second level takes ``n`` rows each. No task holds more of a class than that.

The approximate stratified draw (``stratified_approximate``) counts nothing: it compares
a row's hash with a threshold per class.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.functions.hashing import hash_bucket, id_string, seeded_hash
from wordmill.session import broadcast_if_small, cut_lineage

_H, _ID, _B = "_wm_h", "_wm_id", "_wm_b"

# Shares of a class in which the rows drawn by the input tasks meet first (M5).
SALTS = 1024

# Hash digits compared with a threshold: 52 bits, exact in a double.
_DIGITS = 13


def _keyed(df: DataFrame, seed, id_cols) -> DataFrame:
    return (df.withColumn(_H, seeded_hash(seed, id_cols))
            .withColumn(_ID, id_string(id_cols)))


def _key() -> Column:
    return F.struct(F.col(_H), F.col(_ID))


def _join(a: DataFrame, b: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a NULL stratum matches a NULL stratum; keeps ``a``'s columns."""
    named = b.select(*[F.col(c).alias(f"_wm_k{i}") for i, c in enumerate(cols)],
                     *[c for c in b.columns if c not in cols])
    on = F.lit(True)
    for i, c in enumerate(cols):
        on = on & a[c].eqNullSafe(named[f"_wm_k{i}"])
    return a.join(named, on, how).drop(*[f"_wm_k{i}" for i in range(len(cols))])


def _bucket_counts(x: DataFrame, strata: Sequence[str]) -> DataFrame:
    """``(strata..., _wm_b, _c)``, written once: sizes, quotas and boundaries come from it."""
    return cut_lineage(x.groupBy(*strata, hash_bucket(F.col(_H)).alias(_B)).agg(F.count(F.lit(1)).alias("_c")))


def _thresholds(x: DataFrame, counts: DataFrame, quotas: DataFrame, strata: Sequence[str],
                tags: Sequence[str] = ()) -> DataFrame:
    """``(strata..., tags..., _mode, _tk)``: per stratum 'all', 'none' or the key of the
    last row inside the quota. ``quotas`` has columns ``(strata..., tags..., _q)``; ``tags``
    tell several quotas of one stratum apart (the shares of a ladder)."""
    s, t = list(strata), list(tags)
    w = Window.partitionBy(*s).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    cum = _join(counts.withColumn("_cum", F.sum("_c").over(w)), quotas, s, "inner")
    part = (cum.filter((F.col("_cum") - F.col("_c") < F.col("_q")) & (F.col("_cum") >= F.col("_q")))
            .select(*s, _B, *t, (F.col("_q") - (F.col("_cum") - F.col("_c"))).alias("_need")))
    part = broadcast_if_small(cut_lineage(part))
    boundary = _join(x.withColumn(_B, hash_bucket(F.col(_H))), part, s + [_B], "inner")
    rw = Window.partitionBy(*s, *t, _B).orderBy(F.col(_H), F.col(_ID))
    thr = (boundary.withColumn("_rn", F.row_number().over(rw))
           .filter(F.col("_rn") == F.col("_need"))
           .select(*s, *t, _key().alias("_tk")))
    totals = _join(counts.groupBy(*s).agg(F.sum("_c").alias("_n")), quotas, s, "inner")
    modes = totals.select(*s, *t, F.when(F.col("_q") >= F.col("_n"), "all")
                          .when(F.col("_q") <= 0, "none").otherwise("thr").alias("_mode"))
    return cut_lineage(_join(modes, thr, s + t, "left"))


def _total(counts: DataFrame) -> int:
    return counts.agg(F.sum("_c")).first()[0] or 0


def _flagged(x: DataFrame, thr: DataFrame, strata: Sequence[str], out_col: str) -> DataFrame:
    j = _join(x, broadcast_if_small(thr), list(strata), "left")
    flag = (F.when(F.col("_mode") == "all", True).when(F.col("_mode") == "thr", _key() <= F.col("_tk"))
            .otherwise(False))
    return j.withColumn(out_col, flag).drop(_H, _ID, "_mode", "_tk")


def mark_prefix(df: DataFrame, quota, *, seed, id_cols, strata: Sequence[str] = (),
                out_col: str = "_in") -> DataFrame:
    """Add boolean ``out_col``: row is among the first ``quota`` rows of its stratum in
    hash order. ``quota`` is an int (same for every stratum), a table ``(strata..., _q)``,
    or a function: of the number of rows without strata, of the table of stratum sizes
    ``(strata..., _k)`` with strata. Strata without a quota row get ``False``; NULL is a
    stratum like any other. Three passes over the keys: counts, boundary buckets, marks."""
    s = list(strata) or ["_wm_s"]
    x = _keyed(df, seed, id_cols)
    if not strata:
        x = x.withColumn("_wm_s", F.lit(0))
    counts = _bucket_counts(x, s)
    sizes = counts.groupBy(*s).agg(F.sum("_c").alias("_k"))
    if callable(quota):
        quota = quota(sizes) if strata else quota(_total(counts))
    quotas = sizes.select(*s, F.lit(quota).cast("long").alias("_q")) if isinstance(quota, int) \
        else quota.select(*s, F.col("_q").cast("long"))
    out = _flagged(x, _thresholds(x, counts, cut_lineage(quotas), s), s, out_col)
    return out if strata else out.drop("_wm_s")


# M1
def sample_fraction(df: DataFrame, frac: float, *, seed, id_cols) -> DataFrame:
    """Exact ``round(frac * n)`` rows (half to even), without replacement; samples with
    the same seed are nested. ``id_cols`` must be unique: rows that share an id share
    its key and are kept or dropped together."""
    if not 0 <= frac <= 1:
        raise ValueError("frac must be within [0, 1]")
    return mark_prefix(df, lambda n: round(frac * n), seed=seed, id_cols=id_cols).filter("_in").drop("_in")


# M2 / M3 / M8
def split(df: DataFrame, valid_share: float, *, seed, id_cols, part_col: str = "part",
          names: tuple[str, str] = ("train", "valid"), group_key: str | Column | None = None) -> DataFrame:
    """Add ``part_col``: ``ceil(valid_share * n)`` rows in hash order are ``names[1]``.
    ``group_key`` (e.g. a hash of the normalised text) keeps copies on one side; the
    share then applies to distinct groups, and rows without a key are one group."""
    if not 0 < valid_share < 1:
        raise ValueError("valid_share must be within (0, 1)")
    def quota(n):
        return math.ceil(valid_share * n)
    if group_key is not None:
        gk = F.col(group_key) if isinstance(group_key, str) else group_key
        keyed = df.withColumn("_wm_g", gk)
        groups = keyed.select("_wm_g").distinct().withColumn("_wm_gid", F.coalesce(F.col("_wm_g").cast("string"), F.lit("")))
        marked = mark_prefix(groups, quota, seed=seed, id_cols=["_wm_gid"]).drop("_wm_gid")
        j = _join(keyed, marked, ["_wm_g"], "inner")
        return (j.withColumn(part_col, F.when(F.col("_in"), names[1]).otherwise(names[0]))
                .drop("_in", "_wm_g"))
    marked = mark_prefix(df, quota, seed=seed, id_cols=id_cols)
    return marked.withColumn(part_col, F.when(F.col("_in"), names[1]).otherwise(names[0])).drop("_in")


def _largest_remainder(counts: DataFrame, p: Column, label_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Quotas over a small table of class counts ``(by..., label, _k)``, per ``by`` group."""
    g = Window.partitionBy(*by)
    n = F.sum("_k").over(g)
    m = n - F.ceil((F.lit(1.0) - p) * n)
    c = (counts.withColumn("_n", n).withColumn("_m", m)
         .withColumn("_exact", F.col("_k") * F.col("_m") / F.col("_n"))
         .withColumn("_f", F.floor("_exact"))
         .withColumn("_r", F.col("_exact") - F.col("_f")))
    c = c.withColumn("_left", F.col("_m") - F.sum("_f").over(g))
    order = Window.partitionBy(*by).orderBy(F.col("_r").desc(), F.col(label_col).asc())
    c = c.withColumn("_pos", F.row_number().over(order))
    return c.select(*by, label_col, (F.col("_f") + F.when(F.col("_pos") <= F.col("_left"), 1).otherwise(0))
                    .cast("long").alias("_q"))


def stratified_quotas(df: DataFrame, p: float, *, label_col: str) -> DataFrame:
    """``(label, _q)``: kept rows ``m = n - ceil((1-p) n)`` spread over classes by the
    largest remainder of ``k m / n``, ties to the smaller label."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_k"))
    return _largest_remainder(counts, F.lit(float(p)), label_col)


def stratified_ladder(df: DataFrame, fractions: Sequence[float], *, label_col: str, seed,
                      id_cols) -> list[DataFrame]:
    """M4 at every share of a ladder, thresholds from one pass.

    The bucket counts of all classes are written once; class sizes, the quotas of all
    (share, class) pairs and their boundary buckets come from that table. Each returned
    sample is a narrow filter of ``df`` against the thresholds of its share. A share
    ``>= 1`` keeps every row, as in ``stratified_fraction``."""
    fr = ladder(fractions)
    spark = df.sparkSession
    x = _keyed(df.select(*([id_cols] if isinstance(id_cols, str) else id_cols), label_col), seed, id_cols)
    counts = _bucket_counts(x, [label_col])
    sizes = counts.groupBy(label_col).agg(F.sum("_c").alias("_k"))
    shares = F.explode(F.array(*[F.struct(F.lit(i).alias("_share"), F.lit(float(f)).alias("_p"))
                                 for i, f in enumerate(fr)])).alias("_sp")
    quotas = cut_lineage(_largest_remainder(sizes.select("*", shares).select(label_col, "_k", "_sp.*"), F.col("_p"),
                                            label_col, by=["_share"]))
    thr = _thresholds(x, counts, quotas, [label_col], ["_share"])
    keyed = _keyed(df, seed, id_cols)
    return [df if f >= 1.0 else
            _flagged(keyed, thr.filter(F.col("_share") == i).drop("_share"), [label_col], "_in")
            .filter("_in").select(*df.columns) for i, f in enumerate(fr)]


# M4
def stratified_fraction(df: DataFrame, p: float, *, label_col: str, seed, id_cols) -> DataFrame:
    """Keep ``n - ceil((1-p) n)`` rows spread over the classes (NULL is one of them) by
    the largest remainder of ``k m / n``, ties to the smaller label; no-op when ``p >= 1``."""
    if p >= 1.0:
        return df
    return (mark_prefix(df, lambda sizes: _largest_remainder(sizes, F.lit(float(p)), label_col), seed=seed,
                        id_cols=id_cols, strata=[label_col]).filter("_in").drop("_in"))


def hash_threshold(share: float) -> str:
    """The hash prefix below which a share of all hashes lies (``share`` < 1)."""
    return format(math.ceil(share * 16 ** _DIGITS), f"0{_DIGITS}x")


def stratified_approximate(df: DataFrame, p: float | Mapping, *, label_col: str, seed, id_cols) -> DataFrame:
    """M4 without counting: a narrow filter that keeps the rows whose hash lies below the
    threshold of their class. ``p`` is one share for all classes or a mapping from label
    (None for rows without one) to share; labels outside it keep nothing.

    A class of ``k`` rows keeps a binomial number of them, ``k p`` with a standard deviation
    of ``sqrt(k p (1 - p))``. The kept rows are a prefix of the class in key order, so they
    nest with those of ``stratified_fraction`` with the same seed. A row with a null id has
    no hash; only a share of 1 keeps it."""
    shares = dict(p) if isinstance(p, Mapping) else None
    bad = [f for f in (shares.values() if shares is not None else [p]) if f < 0]
    if bad:
        raise ValueError(f"shares must not be negative: {bad}")

    def below(share: float) -> Column:
        if math.ceil(share * 16 ** _DIGITS) >= 16 ** _DIGITS:
            return F.lit(True)
        return F.substring(seeded_hash(seed, id_cols), 1, _DIGITS) < F.lit(hash_threshold(share))

    if shares is None:
        return df.filter(below(p))
    kept = F.lit(False)
    for label, share in shares.items():
        same = F.col(label_col).isNull() if label is None else F.col(label_col).eqNullSafe(F.lit(label))
        kept = kept | (same & below(share))
    return df.filter(kept)


# M5
def per_class(df: DataFrame, n: int, *, label_col: str, seed, id_cols) -> DataFrame:
    """``n`` rows per class in hash order; a smaller class keeps all its rows. The rows of a
    class meet in shares by input task first, and the result does not depend on them."""
    x = _keyed(df, seed, id_cols).withColumn("_wm_salt", F.spark_partition_id() % SALTS)
    for by in ([label_col, "_wm_salt"], [label_col]):
        w = Window.partitionBy(*by).orderBy(F.col(_H), F.col(_ID))
        x = x.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    return x.drop("_wm_salt", _H, _ID)


# M6
def first_n(df: DataFrame, n: int, *, seed, id_cols) -> DataFrame:
    """``min(n, len)`` rows overall in hash order (a top-k: TakeOrderedAndProject)."""
    x = _keyed(df, seed, id_cols)
    return x.orderBy(F.col(_H), F.col(_ID)).limit(n).drop(_H, _ID)


# M7
def fraction_ladder(num_percentiles: int = fixed.NUM_PERCENTILES) -> list[float]:
    """The learning-curve shares: i / num_percentiles for i in ``LADDER_RANGE``."""
    return [i / num_percentiles for i in range(*fixed.LADDER_RANGE)]


def ladder(fractions: Sequence[float] | None = None) -> list[float]:
    """The learning-curve shares; any list is accepted, values above 1 are rejected."""
    fr = list(fractions) if fractions is not None else fraction_ladder()
    bad = [f for f in fr if not 0 < f <= 1]
    if bad:
        raise ValueError(f"shares must lie in (0, 1]: {bad}")
    return fr


def nested_samples(df: DataFrame, fractions: Sequence[float], *, seed, id_cols,
                   frac_col: str = "percentage") -> DataFrame:
    """All ladder samples in one pass: every row, tagged with each share whose sample
    holds it. Nesting means a row is in every share at or above its own threshold."""
    fr = ladder(fractions)
    keyed = _keyed(df, seed, id_cols).withColumn("_wm_s", F.lit(0))
    counts = _bucket_counts(keyed.select(_H, "_wm_s"), ["_wm_s"])
    n = _total(counts)
    quotas = df.sparkSession.createDataFrame([(0, i, round(f * n)) for i, f in enumerate(fr)],
                                             "_wm_s int, _share int, _q long")
    thr = _thresholds(keyed.select(_H, _ID, "_wm_s"), counts, quotas, ["_wm_s"], ["_share"])
    # one row per share: they become literals, and only a row's own shares are expanded
    t = {r["_share"]: (r["_mode"], r["_tk"]) for r in thr.collect()}
    inside = F.array(*[F.when(_flag(*t.get(i, (None, None)), _key()), F.lit(float(f))) for i, f in enumerate(fr)])
    return (keyed.withColumn(frac_col, F.explode(F.array_compact(inside))).drop(_H, _ID, "_wm_s"))


def _flag(mode: str | None, tk, key: Column) -> Column:
    if mode == "all":
        return F.lit(True)
    if mode == "thr":
        return key <= F.struct(F.lit(tk[0]).alias(_H), F.lit(tk[1]).alias(_ID))
    return F.lit(False)


def ladder_splits(df: DataFrame, fractions: Sequence[float], valid_share: float, *, seed, split_seed,
                  id_cols, out_col: str = "_wm_parts") -> DataFrame:
    """Every (sample, split) pair of a learning curve from one pass over the ids.

    Share ``i`` is M1 at ``fractions[i]`` (first ``round(f n)`` rows in ``seed`` order)
    split by M2 (first ``ceil(valid_share q_i)`` rows of that sample in ``split_seed``
    order are 'valid'). The thresholds of all shares come from two aggregates over
    ``(id, share)`` rows that carry no other column; they are one row per share, so
    they become literals and each share is a narrow filter on ``out_col[i]``
    ('train', 'valid' or NULL). Equal to ``split(sample_fraction(df, f), ...)`` per share."""
    fr = ladder(fractions)
    if not 0 < valid_share < 1:
        raise ValueError("valid_share must be within (0, 1)")
    keys = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    spark = df.sparkSession
    x = _keyed(df.select(*keys), seed, id_cols).withColumn("_wm_s", F.lit(0))
    counts = _bucket_counts(x, ["_wm_s"])
    n = _total(counts)
    q = [round(f * n) for f in fr]
    qv = [math.ceil(valid_share * k) for k in q]
    q1 = spark.createDataFrame([(0, i, k) for i, k in enumerate(q)], "_wm_s int, _share int, _q long")
    # one row per share on each side: bounded by the length of the ladder
    t1 = {r["_share"]: (r["_mode"], r["_tk"]) for r in _thresholds(x, counts, q1, ["_wm_s"], ["_share"]).collect()}
    held = F.array(*[F.when(_flag(*t1.get(i, (None, None)), _key()), F.lit(i)) for i in range(len(fr))])
    sampled = _keyed(x.select(*keys, F.explode(F.array_compact(held)).alias("_share")), split_seed, id_cols)
    q2 = spark.createDataFrame(list(enumerate(qv)), "_share int, _q long")
    thr2 = _thresholds(sampled, _bucket_counts(sampled, ["_share"]), q2, ["_share"])
    t2 = {r["_share"]: (r["_mode"], r["_tk"]) for r in thr2.collect()}
    k1, k2 = _key(), F.struct(seeded_hash(split_seed, id_cols).alias(_H), F.col(_ID))
    parts = []
    for i in range(len(fr)):
        in_sample = _flag(*t1.get(i, (None, None)), k1)
        valid = _flag(*t2.get(i, (None, None)), k2)
        parts.append(F.when(in_sample & valid, "valid").when(in_sample, "train"))
    return _keyed(df, seed, id_cols).withColumn(out_col, F.array(*parts)).drop(_H, _ID)


# M9
def realised_rate(sample: DataFrame, population: DataFrame, nominal_rows: float | None = None) -> DataFrame:
    """``(percentage, labelled_share)``: the nominal rows per population row as the
    reference reports it, and the true share of the population that was drawn."""
    n = F.count(F.lit(1))
    drawn = sample.select(n).scalar()
    return population.agg(F.try_divide(F.lit(float(nominal_rows)) if nominal_rows is not None else drawn, n).alias("percentage"),
                          F.try_divide(drawn, n).alias("labelled_share"))
