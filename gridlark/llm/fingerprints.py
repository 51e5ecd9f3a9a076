"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits. DataFrame functions only.

The word 5-grams of a text (lower-cased; all words as one shingle where there are fewer) are hashed once, to 64 bits. The top bits choose one of
``K`` bins, each bin keeps its smallest hash. An empty bin takes the value of another: probes go through the bins in an order that
depends on the empty bin alone (double hashing with an odd step, which meets every bin), until one isn't empty; so two documents fill a bin from the
same place whenever both could. Of each bin's value, hashed once more with the bin's number, the lowest ``BITS`` bits are kept; so bins filled
from one place don't collide together. Two fingerprints agree in a bin by chance with probability 2**-BITS, so likeness is
``(agreement - 2**-BITS) / (1 - 2**-BITS)``, cut to 0..1.

The hashes of a text are sorted within its row, with a sentinel at the start of each bin; a bin's smallest hash is what follows its
sentinel. There is no explode, so nothing is shuffled for fingerprints, and a row's cost is n log n in its words.

Defined cases: a null text is empty; a text without words has an empty fingerprint, of likeness 1 to its equals and 0 to others; equal
texts have equal fingerprints; repeated ids are ordered by text; a table of one row has itself as its next; rows without an id have no place in the
order and are left out; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS

N = 5
K = 128
BITS = 8
PROBES = 12  # probes written out, with an early end; the rest of the order is searched by a filter
PARTS = 64  # ranges of about as many ids each, by approximate quantiles
STRIDE = 1024  # documents of a bucket, about, in the search for the next one
_SHIFT = 63 - (K.bit_length() - 1)  # hashes are cut to 63 bits, so they sort as unsigned


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row; inside a lambda an expression would be computed for each element."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, n: int = N) -> Column:
    """63-bit hashes of the n-word shingles of a text, repeated shingles included; empty where it has no words."""
    words = F.split(F.regexp_replace(F.lower(text), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", ""), f"{SPACE_CLASS}+")
    return _let(
        words,
        lambda w: F.when((F.size(w) == 1) & (w[0] == ""), F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, n)), 1))
        ),
    )


def _probes() -> tuple[list[int], list[int]]:
    """Start and odd step of the probe order of each bin, from a multiplicative hash of its number."""
    mixed = [(b + 1) * 0x9E3779B97F4A7C15 % 2**64 for b in range(K)]
    return [x >> 40 & (K - 1) for x in mixed], [(x >> 20 & (K - 1)) | 1 for x in mixed]


def bins(hashes: Column) -> Column:
    """The K low-order values of the densified bins; empty where there are no hashes."""
    marks = F.array(*(F.lit(b << _SHIFT) for b in range(K)))
    start, step = (F.array(*map(F.lit, x)) for x in _probes())
    top = lambda x: F.shiftright(x, _SHIFT)

    def smallest(s: Column) -> Column:
        # A sentinel has no low bits; what follows it in its bin, if anything, is the bin's smallest hash. A hash equal to
        # a sentinel (2**-56 each) reads as one and is dropped with it by array_distinct, so K sentinels remain.
        follows = F.transform(s, lambda x, i: F.when(x == F.shiftleft(top(x), _SHIFT), F.when(top(F.get(s, i + 1)) == top(x), F.get(s, i + 1)).otherwise(F.lit(-1))))
        return F.filter(follows, lambda x: x.isNotNull())

    def dense(v: Column) -> Column:
        def fill(x: Column, i: Column) -> Column:
            at = lambda a: F.get(v, (F.get(start, i) + a * F.get(step, i)).bitwiseAND(F.lit(K - 1)))
            rest = F.element_at(F.filter(F.transform(F.sequence(F.lit(PROBES), F.lit(K - 1)), at), lambda y: y >= 0), 1)
            value = F.when(x >= 0, x).otherwise(F.coalesce(*(F.nullif(at(F.lit(a)), F.lit(-1)) for a in range(PROBES)), rest))
            return F.xxhash64(value, i).bitwiseAND(F.lit((1 << BITS) - 1))

        return F.transform(v, fill)

    filled = _let(F.sort_array(F.array_distinct(F.concat(hashes, marks))), lambda s: _let(smallest(s), dense))
    return F.when(F.size(hashes) > 0, filled).otherwise(F.array().cast("array<bigint>"))


def packed(values: Column) -> Column:
    """Hexadecimal string of the values, BITS bits each."""
    width = BITS // 4
    return F.array_join(F.transform(values, lambda x: F.lower(F.lpad(F.hex(x), width, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two documents by their bins, with bias correction."""
    chance = 2.0**-BITS
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(K))
    value = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(value)


def fingerprint_bins(text: Column) -> Column:
    return _let(shingle_hashes(text), bins)


def edited_text(text: Column, after: Column) -> Column:
    """The text whose last half of code points is replaced by as many of the first code points of ``after``, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(after, F.lit(1), half))


def id_buckets(rows: DataFrame) -> tuple[Column, Column]:
    """Part and bucket of a ``doc_id``, both in order of ids, such that a bucket has about ``STRIDE`` ids however dense they are.

    Quantiles cut the ids into ``PARTS`` parts; the range and number of ids of a part give the width of its buckets, a power of two. What reaches the
    driver are three numbers a part.
    """
    cuts = rows.agg(F.percentile_approx("doc_id", [k / PARTS for k in range(1, PARTS)], F.lit(10_000))).first()[0] or []
    part = F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in sorted({*cuts}))), lambda x: x <= F.col("doc_id")))
    seen = {r.part: r for r in rows.groupBy(part.alias("part")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).collect()}
    shift = {k: max(0, ((r.hi - r.lo + 1) * STRIDE // r.n).bit_length() - 1) for k, r in seen.items()}
    width = F.get(F.array(*(F.lit(min(shift.get(k, 0), 63)) for k in range(PARTS + 1))), part)
    return part, F.call_function("shiftright", F.col("doc_id"), width)


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its text edited with the next document's, and the likenesses.

    Documents are dealt out by buckets of ids; a window finds the next one within a bucket. The last of a bucket (one in
    some ``STRIDE``) takes the first of the next bucket that isn't empty, which a window over the buckets of a part finds, and one over the parts for the
    last bucket of each. All branches read the same shuffle of texts. Rows of one id are in one task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).where("doc_id is not null")
    part, bucket = id_buckets(rows)
    # The filter that the join of the buckets would add is written out, so that all branches read one and the same shuffle.
    rows = rows.withColumn("part", part).withColumn("bucket", bucket).where("part is not null and bucket is not null")
    w = Window.partitionBy("part", "bucket").orderBy("doc_id", "text")
    seen = rows.withColumn("after", F.lead("text").over(w)).withColumn("first", F.row_number().over(w) == 1)

    def finished(x: DataFrame) -> DataFrame:
        edited = x.withColumn("edited", edited_text(F.col("text"), F.col("after"))).withColumn("edited_bins", fingerprint_bins(F.col("edited")))
        return edited.select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            packed(F.col("bins")).alias("fingerprint"),
            packed(F.col("edited_bins")).alias("edited_fingerprint"),
            likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
            likeness(F.col("bins"), F.col("after_bins")).alias("near_next"),
        )

    printed = seen.withColumn("bins", fingerprint_bins(F.col("text"))).withColumn("after_bins", F.lead("bins").over(w))
    inner = finished(printed.where("after is not null"))
    buckets = rows.groupBy("part", "bucket").agg(F.count("*").alias("n"))
    order = Window.orderBy("part")  # over a row for each part
    heads = buckets.groupBy("part").agg(F.min("bucket").alias("head"))
    heads = heads.select("part", F.coalesce(F.lead(F.struct("part", "head")).over(order), F.first(F.struct("part", "head")).over(order)).alias("next"))
    following = F.lead("bucket").over(Window.partitionBy("part").orderBy("bucket"))
    ranges = buckets.withColumn("after_bucket", following).join(heads, "part")
    ranges = ranges.select("part", "bucket", F.when(F.col("after_bucket").isNull(), F.col("next.part")).otherwise(F.col("part")).alias("after_part"), F.coalesce("after_bucket", F.col("next.head")).alias("after_bucket"))
    firsts = seen.where("first").select(F.col("part").alias("after_part"), F.col("bucket").alias("after_bucket"), F.col("text").alias("after"), fingerprint_bins(F.col("text")).alias("after_bins"))
    lasts = seen.where("after is null").select("doc_id", "text", "part", "bucket", fingerprint_bins(F.col("text")).alias("bins"))
    return inner.union(finished(lasts.join(ranges, ["part", "bucket"]).join(firsts, ["after_part", "after_bucket"])))
