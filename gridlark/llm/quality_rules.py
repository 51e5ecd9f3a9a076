"""Quality rules with adaptive thresholds from mergeable quantile sketches. DataFrame functions only.

Each document gets whole-text statistics. No threshold is fixed: for each (language, source) and statistic a quantile sketch is
kept as counts by log-linear bucket (values below ``2**FINE`` exactly, larger ones to 1/2048 of their value), so sketches merge by addition, in any
order and with the same result, and combine before the shuffle. A document fails a rule if its value is beyond a fence: ``q3 + WIDTH (q3 - q1)``
above, ``q1 - WIDTH (q3 - q1)`` below, with the quartiles of its group and nothing added. The statistics have spread in any prose: share of word
characters that are neither letters nor digits; mean word length; share of words of up to three characters; diversity of words (the logarithm of the
distinct words by that of all words, which hardly depends on a text's length).

A group's fence lies between those of its language at half and at double width: so a source of mostly junk doesn't set its own norm, and one of mostly
copies, without spread, doesn't reject all else. Groups of fewer than ``MIN_GROUP`` documents use their language's fence. A language of fewer
documents, or with less than a quarter of the corpus's spread (as copies may give it), stands back for the whole corpus. All by merging.

Documents are joined with the thresholds by (language, source). Adaptive execution broadcasts these when their measured size is small, and splits a
hot source otherwise.

Defined cases: a null or empty text has no words and fails the base rules; null language or source is a group of its own; repeated rows are
counted and kept each; in ``kept_documents`` rows of one id share a verdict, kept if any is, and rows without an id have one each; extra columns are
ignored by ``evaluate`` and kept by ``kept_documents``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, WORD_CLASS, Scratch

MIN_WORDS = 50
MIN_GROUP = 30
FINE = 11  # bits of a sketch's buckets
#: Rules: statistic, which sides have a fence, and its width in quartile distances (even).
RULES = {"mark_permyriad": ("max", 6), "word_length_milli": ("min max", 4), "short_word_permyriad": ("min max", 4), "diversity_permyriad": ("min", 4)}
#: Fences: side and statistic.
FENCES = [(side, rule) for rule, (sides, _) in RULES.items() for side in sides.split()]


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Each window is a long: the upper bits of its hash, then its position. Sorted, windows of equal hashes are neighbours; of these, usually few, the
    words themselves are sorted and compared. The positions of equal windows, sorted, cover 3 words each less the overlap with the next.
    """

    def count(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w)))
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.call_function("shiftleft", F.xxhash64(F.slice(w, i, 3)), bits).bitwiseOR(i.cast("long")))
        high = lambda x: F.call_function("shiftrightunsigned", x, bits)
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def alike(s: Column) -> Column:
            twin = lambda x, i: (high(x) == high(F.get(s, i + 1))) | (high(x) == high(F.get(s, i - 1)))
            spelled = lambda x: F.struct(F.concat_ws(" ", F.slice(w, x.bitwiseAND(mask).cast("int"), 3)).alias("s"), x.bitwiseAND(mask).alias("p"))
            return F.transform(F.filter(s, lambda x, i: F.coalesce(twin(x, i), F.lit(False))), spelled)

        def repeated(s: Column) -> Column:
            twin = lambda x, i: (x.s == F.get(s, i + 1).s) | (x.s == F.get(s, i - 1).s)
            return F.transform(F.filter(s, lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x.p)

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return _let(F.sort_array(windows), lambda s: _let(F.sort_array(alike(s)), lambda q: _let(F.sort_array(repeated(q)), covered)))

    return F.when(n_words >= 4, _let(words, count)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, *also: str) -> DataFrame:
    """``doc_id, lang, source`` and the columns ``also``, with base counts of the whole text and the statistics of the rules."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", *also, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")
    n_words = F.regexp_count(text, F.lit(f"{WORD_CLASS}+")).cast("long")
    spaces = F.regexp_count(text, F.lit(SPACE_CLASS))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CLASS))
    words = F.split(F.regexp_replace(text, f"^{SPACE_CLASS}+", ""), f"{SPACE_CLASS}+")
    words = _let(words, lambda w: F.when(F.element_at(w, -1) == "", F.slice(w, 1, F.size(w) - 1)).otherwise(w))
    counted = rows.select(
        "doc_id", "lang", "source", *also,
        n_words.alias("n_words"),
        (F.length(text) - spaces).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.length(text) - spaces - F.regexp_count(text, F.lit(r"[\p{L}\p{N}]"))).cast("long").alias("n_marks"),
        (n_words - F.regexp_count(text, F.lit(f"{WORD_CLASS}{{4,}}"))).cast("long").alias("n_short_words"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _let(words, lambda w: F.struct(F.size(F.array_distinct(w)).cast("long").alias("d"), _repeat_words(w, F.size(w)).alias("r"))).alias("_w"),
    )
    share = lambda a, b, k: F.expr(f"coalesce({a} * {k} div nullif({b}, 0), 0)")
    named = counted.withColumn("n_repeat_words", F.col("_w.r")).withColumn("n_distinct", F.col("_w.d")).drop("_w")
    # A millionth is added as the logarithms may round a whole number down.
    diversity = F.when(F.col("n_words") > 1, F.floor(F.log("n_distinct") / F.log("n_words") * 10000 + 1e-6)).otherwise(F.lit(10000)).cast("long")
    return named.withColumns({"mark_permyriad": share("n_marks", "word_chars", 10000), "word_length_milli": share("word_chars", "n_words", 1000), "short_word_permyriad": share("n_short_words", "n_words", 10000), "diversity_permyriad": diversity})


def bucket_of(x: Column) -> Column:
    """Bucket of a non-negative long: itself below ``2**FINE``, then ``2**FINE`` for each doubling."""
    e = F.greatest(F.length(F.bin(x)) - FINE - 1, F.lit(0))
    return F.when(x < 2**FINE, x).otherwise(e * 2**FINE + F.call_function("shiftright", x, e)).cast("int")


def bucket_floor(b: Column) -> Column:
    """The smallest value of a bucket."""
    e = F.greatest(F.floor(b / 2**FINE).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (b - e * 2**FINE).cast("long"), e)


def sketches(stats: DataFrame) -> DataFrame:
    """``(lang, source, rule, bucket, n)``: the quantile sketches; the stack is a row for each rule and document, combined at once."""
    stacked = stats.select("lang", "source", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), bucket_of(F.col(r)).alias("bucket")) for r in RULES))).alias("x"))
    return stacked.groupBy("lang", "source", "x.rule", "x.bucket").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """First and third quartile of each group's merged sketch, with its number of documents. Windows run over buckets."""
    merged = sketch.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rule")
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bucket")))
    found = ranked.groupBy(*by, "rule").agg(F.max("total").alias("docs"), at(1).alias("b1"), at(3).alias("b3"))
    return found.select(*by, "rule", "docs", bucket_floor(F.col("b1")).alias("q1"), bucket_floor(F.col("b3")).alias("q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """``(lang, source)`` with columns of fences: a statistic fails above its ``max_`` or below its ``min_``."""
    own, lang, whole = (quartiles(sketch, by).select(*(F.col(x).alias(f"{p}_{x}") for x in [*by, "rule", "docs", "q1", "q3"])) for p, by in (("o", ["lang", "source"]), ("l", ["lang"]), ("w", [])))
    joined = own.join(lang, F.col("o_lang").eqNullSafe(F.col("l_lang")) & (F.col("o_rule") == F.col("l_rule"))).join(whole, F.col("o_rule") == F.col("w_rule"))
    spread = lambda p: F.col(f"{p}_q3") - F.col(f"{p}_q1")
    fence = {"max": lambda p, width: F.col(f"{p}_q3") + width * spread(p), "min": lambda p, width: F.col(f"{p}_q1") - width * spread(p)}
    usual = (F.col("l_docs") >= MIN_GROUP) & (spread("l") * 4 >= spread("w"))
    out = []
    for side, rule in FENCES:
        at, width = fence[side], RULES[rule][1]
        wide = lambda k: F.when(usual, at("l", k)).otherwise(at("w", k))  # noqa: B023, E731
        low, high = (width // 2, 2 * width) if side == "max" else (2 * width, width // 2)
        level = F.when(F.col("o_docs") >= MIN_GROUP, F.least(F.greatest(at("o", width), wide(low)), wide(high))).otherwise(wide(width))
        out.append(F.max(F.when(F.col("o_rule") == rule, level)).alias(f"{side}_{rule}"))
    return joined.groupBy(F.col("o_lang").alias("_lang"), F.col("o_source").alias("_source")).agg(*out)


def _verdicts(stats: DataFrame, fences: DataFrame, *also: str) -> DataFrame:
    out = stats.join(fences, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    passed = F.lit(True)
    for side, rule in FENCES:
        passed = passed & (F.col(rule) <= F.col(f"max_{rule}") if side == "max" else F.col(rule) >= F.col(f"min_{rule}"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*also, *columns, base_failed.alias("base_failed"), (~base_failed & passed).alias("kept"), *RULES, *(f"{side}_{rule}" for side, rule in FENCES))


def evaluate(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each document: base counts, ``base_failed`` and ``kept``, with each rule's value and fences."""
    stats = Scratch(spark, "quality").save(statistics(docs), "stats")
    return _verdicts(stats, thresholds(sketches(stats)))


def kept_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    scratch = Scratch(spark, "quality")
    stats = scratch.save(statistics(docs), "stats")
    fences = scratch.save(thresholds(sketches(stats)), "fences")
    kept = _verdicts(stats, fences).where("kept").select(F.col("doc_id").alias("_kept"))
    named = docs.join(kept, docs.doc_id.cast("long") == kept._kept, "left_semi")
    # Rows without an id can't be named: their texts, if there are any, decide on their own.
    bare = docs.where(docs.doc_id.isNull())
    if bare.isEmpty():
        return named
    row = F.struct(*docs.columns)
    tagged = bare.select(F.col("doc_id"), "lang", "source", "text", row.alias("_row"))
    good = _verdicts(statistics(tagged, "_row"), fences, "_row")
    return named.unionByName(good.where("kept").select("_row.*"))


#: The same rules as DuckDB SQL. Quartiles are those of the sketches: values count as the floor of their bucket.
ORACLE_SQL = r"""
with d as (select row_number() over () r, doc_id, lang, source, coalesce(text, '') t from documents),
w as (select r, doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from d),
win as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] s from (select r, ws, unnest(range(1, len(ws) - 1)) i from w where len(ws) > 3)),
twice as (select r, i from (select r, i, count(*) over (partition by r, s) c from win) where c > 1),
rep as (select r, count(distinct i + k) n from twice, (values (0), (1), (2)) v(k) group by r),
c as (select w.r, doc_id, lang, source, len(ws) n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) n_symbols,
  len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(rep.n, 0) n_repeat_words, len(regexp_extract_all(t, '[\p{L}\p{N}]')) inner_chars, len(list_filter(ws, lambda x: length(x) <= 3)) n_short, len(list_distinct(ws)) n_distinct
  from w left join rep using (r)),
v as (select *, coalesce((word_chars - inner_chars) * 10000 // nullif(word_chars, 0), 0) v1, coalesce(word_chars * 1000 // nullif(n_words, 0), 0) v2, coalesce(n_short * 10000 // nullif(n_words, 0), 0) v3,
  case when n_words > 1 then cast(floor(ln(n_distinct) / ln(n_words) * 10000 + 1e-6) as bigint) else 10000 end v4 from c),
s as (select lang, source, rule, cast(x as bigint) >> greatest(length(bin(cast(x as bigint))) - 12, 0) << greatest(length(bin(cast(x as bigint))) - 12, 0) x
  from (select lang, source, unnest([1, 2, 3, 4]) rule, unnest([v1, v2, v3, v4]) x from v)),
o as (select lang, source, rule, count(*) n, list_sort(list(x)) q from s group by all),
l as (select lang, rule, count(*) n, list_sort(list(x)) q from s group by all),
a as (select rule, count(*) n, list_sort(list(x)) q from s group by all),
j as (select o.lang, o.source, o.rule, o.n, o.q[(o.n + 3) // 4] o1, o.q[(3 * o.n + 3) // 4] o3, l.n ln, l.q[(l.n + 3) // 4] l1, l.q[(3 * l.n + 3) // 4] l3, a.q[(a.n + 3) // 4] a1, a.q[(3 * a.n + 3) // 4] a3
  from o join l on o.lang is not distinct from l.lang and o.rule = l.rule join a on a.rule = o.rule),
k as (select *, case when rule = 1 then 6 else 4 end wd, case when ln >= 30 and (l3 - l1) * 4 >= a3 - a1 then l1 else a1 end b1, case when ln >= 30 and (l3 - l1) * 4 >= a3 - a1 then l3 else a3 end b3 from j),
f as (select lang, source, rule,
  case when n >= 30 then least(greatest(o3 + wd * (o3 - o1), b3 + wd // 2 * (b3 - b1)), b3 + 2 * wd * (b3 - b1)) else b3 + wd * (b3 - b1) end hi,
  case when n >= 30 then least(greatest(o1 - wd * (o3 - o1), b1 - 2 * wd * (b3 - b1)), b1 - wd // 2 * (b3 - b1)) else b1 - wd * (b3 - b1) end lo from k),
g as (select lang, source, max(hi) filter (rule = 1) h1, max(hi) filter (rule = 2) h2, max(lo) filter (rule = 2) l2, max(hi) filter (rule = 3) h3, max(lo) filter (rule = 3) l3, max(lo) filter (rule = 4) l4 from f group by all)
select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols, cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and v1 <= h1 and v2 between l2 and h2 and v3 between l3 and h3 and v4 >= l4 kept
from v join g on v.lang is not distinct from g.lang and v.source is not distinct from g.source
"""
