"""Document fingerprints from closed syncmers (operator 10, DataFrame functions only).

A window of ``K`` consecutive words is an anchor if the smallest hash of its inner
windows of ``S`` words is the first or the last one. Whether a window is an anchor
depends on its own words only, so texts that share a passage share its anchors wherever
it stands and whatever surrounds it. Texts are compared by all their anchors and the
places (in words) where these stand: the likeness is the Jaccard similarity of the whole
anchor sets, and the shift is the one on which most shared anchors agree, each voting
with its first places; the anchors on that shift are then counted at all places. The
fingerprint that is shown is the ``SIZE`` smallest distinct anchor hashes, sorted: a
bottom-k sample of the anchor set. Nothing is compared by it.

A text with fewer than ``K`` words has one anchor, all its words; without words the
fingerprint is empty. Null texts are empty. Equal texts have equal fingerprints; two
texts without anchors have likeness 1, one without and another 0. Without a shared
anchor there is no shift (null), and no anchor is on it (0).

The neighbour of a document is the one with the next smaller id (after the smallest:
the largest). Documents are dealt into id ranges bounded by ids of the table; the row
that follows a range's last one is sent along with it, so every text is shuffled once
and each range is a window of its own. Rows with the same id follow each other in
order of their text; a null id comes last. Extra columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 4, 2
#: Anchor hashes of a shown fingerprint.
SIZE = 64
#: Documents of one id range, and the most ranges (then they get longer).
RANGE_ROWS = 2_000
MAX_RANGES = 100_000

_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _least(values: Column, i: Column, n: int) -> Column:
    return F.least(*[F.get(values, i + j) for j in range(n)])


def placed_anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The anchors of a text in order of place, as ``struct(h, p)``: hash and place of the
    first word."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def inner(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(*[x if j == 0 else F.get(h, i + j) for j in range(s)]))

    def chosen(h: Column, m: Column) -> Column:
        # inner windows of the window at i: places i .. i + k - s
        def pick(x: Column, i: Column) -> Column:
            last = F.get(m, i + (k - s))
            low = F.least(*[x if j == 0 else F.get(m, i + j) for j in range(k - s + 1)])
            anchor = F.xxhash64(x, last, F.get(h, i), F.get(h, i + (k - 1)))
            return F.when((low == x) | (low == last), F.struct(anchor.alias("h"), i.alias("p")))
        whole = F.slice(m, 1, F.size(h) - (k - 1))
        return F.filter(F.transform(whole, pick), lambda a: a.isNotNull())

    def of(h: Column) -> Column:
        return (F.when(F.size(h) == 0, F.array().cast("array<struct<h:bigint,p:int>>"))
                .when(F.size(h) < k, F.array(F.struct(F.xxhash64(h).alias("h"), F.lit(0).alias("p"))))
                .otherwise(_let(inner(h), lambda m: chosen(h, m))))
    return _let(hashes, of)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Hashes of the anchors of a text in order of place."""
    return F.transform(placed_anchors(text, k, s), lambda a: a["h"])


def _sample(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def fingerprint(text: Column, size: int = SIZE) -> Column:
    """The smallest distinct anchor hashes, sorted."""
    return _sample(anchors(text), size)


def shown(print_: Column) -> Column:
    return F.array_join(F.transform(print_, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ",")


def _most_common(values: Column) -> Column:
    """The value that occurs most often, the largest of several; null if there is none."""
    def of(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull())
        return _let(starts, lambda at: F.array_max(F.transform(at, lambda i, j: F.struct(
            (F.coalesce(F.get(at, j + 1), F.size(s)) - i).alias("n"), F.get(s, i).alias("value")))))
    return _let(F.sort_array(values), of)["value"]


def compared(a: Column, b: Column) -> Column:
    """``struct(likeness, n, shift)`` of two arrays of placed anchors: Jaccard similarity of
    the two sets, the shift of places on which most shared anchors agree by their first
    places, and the number of places of ``a`` whose anchor ``b`` has at that shift. Two
    sorts; no step compares every anchor of one text with every anchor of the other."""
    # places of a are negative: in a run of equal hashes the first place of a comes right
    # before the first place of b
    rows = F.concat(F.transform(a, lambda x: F.struct(x["h"].alias("h"), (-1 - x["p"]).alias("q"))),
                    F.transform(b, lambda x: F.struct(x["h"].alias("h"), x["p"].alias("q"))))

    def of(c: Column) -> Column:
        def shift(x: Column, i: Column) -> Column:
            before = F.get(c, i - 1)
            return F.when((x["q"] >= 0) & (before["q"] < 0) & (before["h"] == x["h"]), x["q"] + before["q"] + 1)
        shifts = F.filter(F.transform(c, shift), lambda x: x.isNotNull())
        union = F.size(F.filter(c, lambda x, i: (i == 0) | (F.get(c, i - 1)["h"] != x["h"])))
        return F.struct(shifts.alias("shifts"), union.alias("union"), _most_common(shifts).alias("shift"))

    def counted(r: Column) -> Column:
        at = [F.transform(side, lambda x: F.xxhash64(x["h"], x["p"] - d)) for side, d in ((a, F.lit(0)), (b, r["shift"]))]
        likeness = F.when(r["union"] == 0, F.lit(1.0)).otherwise(F.size(r["shifts"]) / r["union"])
        return F.struct(likeness.alias("likeness"),
                        F.when(r["shift"].isNull(), F.lit(0)).otherwise(F.size(F.array_intersect(*at))).alias("n"),
                        r["shift"].alias("shift"))
    return _let(_let(F.sort_array(rows), of), counted)


def offsets_agree(a: Column, b: Column) -> Column:
    """Positional matching of two anchor arrays (as from ``anchors``) by their order: the
    shift on which most shared anchors agree, with its number of anchors, as
    ``struct(n, shift)``; null without a shared anchor."""
    placed = [F.transform(x, lambda h, i: F.struct(h.alias("h"), i.alias("p"))) for x in (a, b)]
    return _let(compared(*placed), lambda r: F.when(r["shift"].isNotNull(), F.struct(r["n"], r["shift"])))


def _cuts_below(cuts: list[int], x: Column) -> Column:
    """How many of the sorted cuts are smaller than ``x``, by halving steps."""
    table = F.from_json(F.lit(str(cuts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(len(cuts).bit_length(), 1)))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) < x, at + step).otherwise(at))


def _bounds(ids: DataFrame, range_rows: int) -> list[int]:
    """Ids that end ranges of about ``range_rows`` documents, the largest id last. One
    number per range reaches the driver, ``MAX_RANGES`` at most."""
    parts = min(max(1, -(-ids.count() // range_rows)), MAX_RANGES)
    shares = [i / parts for i in range(1, parts)] or [1.0]
    near = ids.agg(F.percentile_approx("doc_id", F.from_json(F.lit(str(shares)), "array<double>"),
                                       max(10_000, 10 * parts))).first()[0]
    # percentiles of large ids are rounded: the ranges end with ids that occur
    some = ids.filter("doc_id IS NOT NULL")
    ends = some.groupBy(_cuts_below(sorted(set(near or [])), F.col("doc_id")).alias("r")).agg(F.max("doc_id").alias("end"))
    return sorted(r["end"] for r in ends.collect())


def next_documents(docs: DataFrame, keep: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` (``doc_id`` and the columns ``keep``) with ``next_<column>`` of the row
    that follows in descending order of ``doc_id``; after the last comes the first."""
    cuts = _bounds(docs.select("doc_id"), range_rows)
    rows = docs.select("doc_id", *keep)
    order = [F.col("doc_id").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in keep[:1]]]
    # range r holds the ids above cut r - 1 and up to cut r; null ids end range 0
    ends = F.from_json(F.lit(str(cuts)), "array<bigint>")
    home = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_cuts_below(cuts, F.col("doc_id")))
    # the first row of a range (its id is the cut) also ends the range above, the first
    # of all ends range 0
    homed = rows.withColumn("home", home)
    first_of_range = F.get(ends, F.col("home")) == F.col("doc_id")
    guest = F.when(first_of_range, (F.col("home") + 1) % F.lit(max(len(cuts), 1)))
    both = F.array(F.struct(F.col("home").alias("range"), F.lit(False).alias("extra")),
                   F.struct(guest.alias("range"), F.lit(True).alias("extra")))
    ranged = (homed.withColumn("at", F.explode(F.filter(both, lambda x: x["range"].isNotNull())))
              .select("doc_id", *keep, "at.*"))
    w = Window.partitionBy("range").orderBy("extra", *order)
    out = ranged.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in keep],
                        F.lead(F.lit(True)).over(w).alias("found"))
    if not cuts:
        # no row has an id: all are one range, whose last row is followed by its first
        every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = out.select("doc_id", "extra", *keep, *[F.when(F.col("found"), F.col(f"next_{c}")).otherwise(
            F.first(c).over(every)).alias(f"next_{c}") for c in keep])
    return out.filter(~F.col("extra")).select("doc_id", *keep, *[f"next_{c}" for c in keep])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, print)``: one narrow pass."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("print", fingerprint(F.col("text")))


def compared_documents(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each of ``docs`` (``doc_id``, ``text``) with its edited text and its next document."""
    pairs = next_documents(docs, ["text"], range_rows)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = pairs.select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text", F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"))
    placed = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[
        placed_anchors(F.col(c)).alias(name) for c, name in (("text", "own"), ("edited", "changed"), ("next_text", "next"))])
    out = placed.select("doc_id", "n_chars", "edited_sha256", *[
        shown(_sample(F.transform(c, lambda a: a["h"]))).alias(name)
        for c, name in (("own", "fingerprint"), ("changed", "edited_fingerprint"))],
        compared(F.col("own"), F.col("changed")).alias("e"), compared(F.col("own"), F.col("next")).alias("x"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      F.col("e.likeness").alias("near_edited"), F.col("x.likeness").alias("near_next"),
                      *[F.col(f"{s}.{f}").alias(f"{name}_{f}") for s, name in (("e", "edited"), ("x", "next")) for f in ("n", "shift")])


def op10_syncmer_fingerprints(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, each with its edited text and its next document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return compared_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                          F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
