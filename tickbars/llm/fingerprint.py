"""Document fingerprints from closed syncmers, with Spark's own functions only.

A text is read as pieces of up to ``piece`` characters without white space,
counted from the start of each word. Of every run of ``size`` pieces the inner
runs of two pieces are hashed; the run is an anchor if the smallest of these
hashes is the first or the last. That depends on the run alone, so an anchor
survives any change outside of it. A fingerprint lists a text's anchors in
order, each as 32 bits.

The neighbour of a document is found by buckets of the order of (doc_id, hash
of the text): within a bucket by a window, from bucket to bucket through the
bucket's first document, so that no task orders all documents. Buckets are cut
at quantiles of a sample of that order, so neither far ids nor rows without an
id nor many rows of one id make a bucket large. Cuts decide about the size of
tasks only, never about results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Syncmers:
    """``piece``: characters of a piece; ``size``: pieces of an anchor; ``bucket``: documents of a bucket, about;
    ``buckets``: most buckets, beyond which they get larger; ``drawn``: rows per bucket that its cut is taken from."""

    piece: int = 4
    size: int = 6
    bucket: int = 128
    buckets: int = 4096
    drawn: int = 32


def with_anchors(df: DataFrame, text: str, target: str, spec: Syncmers = Syncmers()) -> DataFrame:
    """``df`` with the anchors of a text column as array<int>.

    In a text with fewer than two runs of ``size`` pieces every two pieces are
    an anchor, or the only piece is; a text without pieces, or null, has none.
    """
    inner, last = f"_{target}_inner", spec.size - 2
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{spec.piece}}}"), F.lit(0))
    hashed = df.withColumn(inner, F.transform(pieces, lambda p: F.xxhash64(p)))
    hashed = hashed.withColumn(f"{inner}_n", F.size(inner))
    pairs = F.zip_with(F.slice(inner, 1, F.col(f"{inner}_n") - 1), F.slice(inner, 2, F.col(f"{inner}_n") - 1), lambda a, b: F.xxhash64(a, b))
    paired = hashed.withColumn(f"{inner}_p", F.when(F.col(f"{inner}_n") > 1, pairs).otherwise(F.col(inner)))

    def at(i: Column, k: int) -> Column:
        return F.get(f"{inner}_p", i + k)

    def closed(i: Column) -> Column:
        least = F.least(*[at(i, k) for k in range(last + 1)])
        return (least == at(i, 0)) | (least == at(i, last))

    places = F.filter(F.sequence(F.lit(0), F.col(f"{inner}_n") - spec.size), closed)
    anchors = F.transform(places, lambda i: F.xxhash64(*[at(i, k) for k in range(0, last + 1, 2)]))
    chosen = F.when(F.col(f"{inner}_n") >= 2 * spec.size, anchors).otherwise(F.col(f"{inner}_p"))
    made = paired.withColumn(target, F.transform(chosen, lambda a: F.shiftright(a, 32).cast("int")))
    return made.drop(inner, f"{inner}_n", f"{inner}_p")


def as_text(anchors: str) -> Column:
    """The fingerprint as a string: eight hexadecimal digits per anchor."""
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.hex(a.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def _common(a: Column, b: Column) -> Column:
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return 2.0 * F.size(F.array_intersect(a, b)) / total


def likeness(a: str, b: str, stretch: int = 8) -> Column:
    """Share of common anchors, 0 to 1, in place or anywhere, whichever is larger.

    In place, anchors match within the same ``stretch`` of their lists, so a
    line that a text repeats counts as often as it stands there. Two
    fingerprints without anchors are alike.
    """

    def placed(anchors: str) -> Column:
        return F.transform(anchors, lambda x, i: F.xxhash64(x, F.floor(i / stretch)))

    none = F.size(a) + F.size(b) == 0
    return F.when(none, F.lit(1.0)).otherwise(F.greatest(_common(F.col(a), F.col(b)), _common(placed(a), placed(b))))


def _place() -> Column:
    """(doc_id, hash of the text) as a string that sorts like the pair, null ids first."""

    def sortable(x: Column) -> Column:
        return F.lpad(F.hex(x.bitwiseXOR(F.lit(-(2**63)))), 16, "0")

    known = F.when(F.col("doc_id").isNull(), "0").otherwise("1")
    return F.concat(known, sortable(F.coalesce("doc_id", F.lit(0).cast("long"))), sortable(F.xxhash64("text")))


def _cuts(docs: DataFrame, spec: Syncmers) -> list[str]:
    """Ascending places that part the rows into buckets of about equal size."""
    count = docs.count()
    wanted = min(spec.buckets, -(-count // spec.bucket))
    if wanted < 2:
        return []
    sample = docs.sample(min(1.0, wanted * spec.drawn / count), seed=1)
    drawn = sorted(row.place for row in sample.select(_place().alias("place")).collect())
    step = max(1, len(drawn) // wanted)
    return sorted(set(drawn[step::step]))


def _with_bucket(docs: DataFrame, cuts: list[str], width: int = 64) -> DataFrame:
    """``docs`` with _place and _bucket, the number of cuts up to it, looked up in two steps."""

    def up_to(places: Column) -> Column:
        return F.size(F.filter(places, lambda p: p <= F.col("_place")))

    placed = docs.withColumn("_place", _place())
    if not cuts:
        return placed.withColumn("_bucket", F.lit(0))
    every, all_cuts = (F.split(F.lit(",".join(c)), ",") for c in (cuts[::width], cuts))
    coarse = F.greatest(up_to(every) - 1, F.lit(0)) * width
    return placed.withColumn("_coarse", coarse).withColumn(
        "_bucket", F.col("_coarse") + up_to(F.slice(all_cuts, F.col("_coarse") + 1, F.lit(width)))
    ).drop("_coarse")


def with_next(docs: DataFrame, spec: Syncmers = Syncmers()) -> DataFrame:
    """``docs`` (doc_id, text) with anchors, next_text and next_anchors, those of the next document in descending doc_id.

    After the last comes the first. Rows of one doc_id follow the hash of their
    text, rows without an id come last. Rows equal in doc_id and text share a
    bucket.
    """
    cuts = _cuts(docs, spec)
    keyed = _with_bucket(docs, cuts)
    order = Window.partitionBy("_bucket").orderBy(F.col("_place").desc())
    own = with_anchors(keyed, "text", "anchors", spec)
    inner = own.withColumns({f"_next_{c}": F.lead(c).over(order) for c in ("text", "anchors")})

    # The first document of the bucket that follows; one row per bucket, ``spec.buckets`` at most.
    tops = keyed.groupBy("_bucket").agg(F.max("_place").alias("_top"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("_bucket").desc())
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = tops.select(F.col("_bucket").alias("_of"), F.coalesce(F.lead("_top").over(down), F.first("_top").over(whole)).alias("_place"))
    heads = docs.withColumn("_place", _place()).join(F.broadcast(chain), "_place")
    heads = heads.groupBy(F.col("_of").alias("_bucket")).agg(F.first("text").alias("_head_text"))
    heads = with_anchors(heads, "_head_text", "_head_anchors", spec)

    # Only the last document of a bucket takes its neighbour from there.
    joined = inner.join(heads.hint("merge"), "_bucket")
    within = F.col("_next_text").isNotNull()
    following = [F.when(within, F.col(f"_next_{c}")).otherwise(F.col(f"_head_{c}")).alias(f"next_{c}") for c in ("text", "anchors")]
    return joined.select(*docs.columns, "anchors", *following)


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as many first characters of ``following``."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - third), F.substring(following, F.lit(1), third))


def fingerprints(docs: DataFrame, spec: Syncmers = Syncmers()) -> DataFrame:
    """Per row of (doc_id, text): n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    both = with_next(plain, spec)
    both = both.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    both = with_anchors(both, "edited", "edited_anchors", spec)
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"),
        likeness("anchors", "next_anchors").alias("near_next"),
    )
