"""Mixing, fingerprints, quality rules, classifier and pipeline against brute force."""

import hashlib
import re
import statistics
import zlib

import numpy as np
import pytest
from conftest_llm import SMALL, rows_of

from gridlark.llm import entries, fingerprints, mixing, quality_classifier, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- mixing


def water_fill(budget, children):
    """Whole-token shares of (capacity, weight) children, by repeated redistribution."""
    order = sorted(children, key=lambda k: (children[k][0] / children[k][1], k))
    left, weight, out = budget, sum(w for _, w in children.values()), {}
    for at, k in enumerate(order):
        c, w = children[k]
        if c * weight > left * w:
            for j in order[at:]:
                out[j] = min(children[j][0], left * children[j][1] // weight)
            return out
        out[k], left, weight = c, left - c, weight - w
    return out


def brute_mix(docs, permille, weights, epochs):
    leaves = {}
    for d in docs:
        n = re.search(r"([0-9]+)$", d["source"] or "")
        domain = "other" if not n else "even" if int(n[1]) % 2 == 0 else "odd"
        leaves.setdefault((domain, d["lang"], d["source"]), []).append(len(WORD.findall(d["text"] or "")))
    tokens = {k: sum(v) for k, v in leaves.items()}
    weight = lambda level, name: weights.get(level, {}).get(name, 1)
    budget = {(): sum(tokens.values()) * permille // 1000}
    for depth, level in enumerate(mixing.LEVELS):
        nxt = {}
        for node, b in budget.items():
            kids = {}
            for leaf, t in tokens.items():
                if leaf[:depth] == node:
                    c, w = kids.get(leaf[: depth + 1], (0, weight(level, leaf[depth])))
                    kids[leaf[: depth + 1]] = (c + t * epochs, w)
            nxt |= water_fill(b, kids)
        budget = nxt
    return tokens, budget


@pytest.mark.parametrize(("permille", "epochs"), [(300, 1), (1400, 4), (2500, 2)])
def test_mixing(spark, permille, epochs):
    docs = rows_of(f"{SMALL}/documents.parquet")
    tokens, budget = brute_mix(docs, permille, entries.WEIGHTS, epochs)
    out = mixing.mix(spark, spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3), share_permille=permille, weights=entries.WEIGHTS, seed=17, max_epochs=epochs).collect()
    taken, partial = {}, {}
    for r in out:
        leaf = (r.domain, r.lang, r.source)
        taken[leaf] = taken.get(leaf, 0) + r.n_tokens * r.copies
        partial.setdefault(leaf, []).append((r.copies, r.n_tokens))
    sizes = {}
    for d in docs:
        sizes[d["doc_id"]] = len(WORD.findall(d["text"] or ""))
    for leaf, want in budget.items():
        got = taken.get(leaf, 0)
        # The prefix ends with the document that reaches the budget.
        assert want <= got or got == tokens[leaf] * epochs
        copies = {c for c, _ in partial.get(leaf, [])}
        assert max(copies, default=0) - min(copies, default=0) <= 1 and max(copies, default=0) <= epochs
        if got > want:
            assert got - want < max(n for _, n in partial[leaf])
    assert len({r.doc_id for r in out}) == len(out) and all(sizes[r.doc_id] == r.n_tokens for r in out)


def test_mixing_prefix(spark):
    """The documents taken once more than the rest are the prefix, in the order of the seeded hash, that reaches the budget."""
    docs = rows_of(f"{SMALL}/documents.parquet")
    tokens, budget = brute_mix(docs, 1400, entries.WEIGHTS, 4)
    out = mixing.mix(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), share_permille=1400, weights=entries.WEIGHTS, seed=17, max_epochs=4)
    copies = {r.doc_id: r.copies for r in out.collect()}
    leaves = {}
    for d in docs:
        n = re.search(r"([0-9]+)$", d["source"] or "")
        leaves.setdefault(("other" if not n else "even" if int(n[1]) % 2 == 0 else "odd", d["lang"], d["source"]), []).append((d["doc_id"], len(WORD.findall(d["text"] or ""))))
    pairs = {(leaf, min(budget[leaf] // tokens[leaf], 4)) for leaf in leaves if tokens[leaf]}
    ask = [(d, w) for leaf, w in pairs for d, _ in leaves[leaf]]
    order = {d: int(hashlib.md5(f"17:{w}:{d}".encode()).hexdigest()[:15], 16) for d, w in ask}
    for leaf, whole in pairs:
        rest = budget[leaf] - whole * tokens[leaf]
        for d, n in sorted(leaves[leaf], key=lambda x: (order[x[0]], x[0])):
            assert copies.get(d, 0) == whole + (rest > 0)
            rest -= n


def test_mixing_sql(spark):
    from conftest_llm import oracle, sorted_rows

    assert sorted_rows(entries.queries()["op6_mixing"](spark, SMALL)) == oracle(entries.oracle_sql()["op6_mixing"])


def test_allocation_of_large_budgets(spark):
    """Capacities beyond 2**53 whose ratios to weights differ by one in the last place are shared exactly."""
    big = 2**60
    rows = [("d", "l", "s1", big + 1), ("d", "l", "s2", big), ("d", "l", "s3", big * 3), ("d", "l", "s4", 5)]
    from pyspark.sql import functions as F

    out = mixing.allocate(spark.createDataFrame(rows, "domain string, lang string, source string, capacity long"), F.lit(big * 2 + 7).cast("long"), {"source": {"s3": 3}})
    want = water_fill(big * 2 + 7, {r[2]: (r[3], 3 if r[2] == "s3" else 1) for r in rows})
    assert {r.source: r.budget for r in out.collect()} == want


def test_mixing_odd(spark, odd, empty):
    out = mixing.mix(spark, odd, share_permille=1000, weights={}, seed=1).collect()
    assert sum(r.n_tokens for r in out) == sum(len(WORD.findall(r.text or "")) for r in odd.collect())
    assert mixing.mix(spark, empty, share_permille=1000, weights={}, seed=1).count() == 0
    assert mixing.mixed_documents(spark, odd, share_permille=1000, weights={}, seed=1).columns == odd.columns
    none = mixing.mix(spark, odd, share_permille=1000, weights={"lang": {"en": 0}}, seed=1).collect()
    assert {r.lang for r in none} <= {"xx", None}


# ---- fingerprints


def jaccard(a, b, n=5):
    sets = []
    for t in (a, b):
        w = WORD.findall(t.lower())
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    x, y = sets
    return len(x & y) / len(x | y) if x or y else 1.0


def test_fingerprints(spark):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in rows_of(f"{SMALL}/documents.parquet")))
    df = entries.queries()["op8_fingerprints"](spark, SMALL)
    out = {r.doc_id: r for r in df.collect()}
    assert not re.search("Python|Pandas|Arrow", plans(df))
    assert out.keys() == {d for d, _ in docs}
    errors = []
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        r, half = out[doc_id], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) in (0, fingerprints.K * fingerprints.BITS // 4)
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert abs(statistics.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.25 and statistics.pstdev(errors) < 0.05
    same = {}
    for doc_id, text in docs:
        assert same.setdefault(text, out[doc_id].fingerprint) == out[doc_id].fingerprint


def test_fingerprint_ranges(spark):
    """Gaps between ids, over several ranges, in any order."""
    docs = [(k * 517 % 10007, f"text {k} " * (k % 7)) for k in range(1, 60)]
    out = {r.doc_id: r for r in fingerprints.fingerprint_pairs(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    docs.sort()
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        assert out[doc_id].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert out[doc_id].near_next == pytest.approx(jaccard(text, after), abs=0.35)


@pytest.mark.parametrize("ids", ["dense", "hashes", "clustered", "repeated"])
def test_fingerprint_order(spark, ids):
    """The next document is found whatever the density of ids, and with rows of one id."""
    import random

    rng = random.Random(3)
    made = {"dense": range(3000), "hashes": [rng.randrange(-(2**63), 2**63) for _ in range(300)], "clustered": [*range(10**6, 10**6 + 300), -(2**63), 2**63 - 1, 5], "repeated": [k // 7 for k in range(200)]}[ids]
    docs = sorted((k, f"t{i % 5} of {k} " * (i % 3)) for i, k in enumerate(made))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).selectExpr("*", "1 as part", "2 as bucket", "'x' as after")
    out = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.fingerprint_pairs(df).collect())
    want = [(k, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()) for (k, t), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True)]
    assert out == sorted(want)


def test_densified_likeness(spark):
    """Short texts, whose bins are mostly empty, are estimated without bias."""
    pairs = [(" ".join(f"a{k}x{i}" for i in range(14)), " ".join([f"a{k}x{i}" for i in range(11)] + [f"b{k}x{i}" for i in range(3)])) for k in range(60)]
    df = spark.createDataFrame(pairs, "x string, y string")
    got = [r[0] for r in df.select(fingerprints.likeness(fingerprints.fingerprint_bins(df.x), fingerprints.fingerprint_bins(df.y))).collect()]
    assert statistics.mean(got) == pytest.approx(jaccard(*pairs[0]), abs=0.06)


def test_fingerprints_odd(spark, odd, empty):
    out = fingerprints.fingerprint_pairs(odd).collect()
    assert len(out) == 10
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "" and by[1].near_next == 1 and by[3].near_next == 0
    assert fingerprints.fingerprint_pairs(empty).count() == 0
    one = fingerprints.fingerprint_pairs(odd.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1


# ---- quality rules


def base_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def check_base(r, text):
    n, chars, symbols, dups, repeats = base_counts(text)
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats), r.doc_id
    assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
    assert not (r.base_failed and r.kept)


def test_quality_rules(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in rows_of(f"{SMALL}/documents.parquet")}
    df = entries.queries()["op9_quality_rules"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", plans(df))
    out = df.collect()
    assert {r.doc_id for r in out} == docs.keys()
    for r in out:
        check_base(r, docs[r.doc_id])
    quality = {r["doc_id"]: r["quality"] for r in rows_of(f"{SMALL}/labels.parquet")}
    good = [r for r in out if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def brute_fences(stats, side, width):
    """Fences of each (lang, source) of ``{(lang, source): values}``, by sorting; large values count as the floor of their bucket."""

    def quartiles(values):
        low = sorted(v >> max(v.bit_length() - 12, 0) << max(v.bit_length() - 12, 0) for v in values)
        return low[-(-len(low) // 4) - 1], low[-(-3 * len(low) // 4) - 1]

    fence = lambda q, k: q[1] + k * (q[1] - q[0]) if side == "max" else q[0] - k * (q[1] - q[0])
    whole, out = quartiles([v for vs in stats.values() for v in vs]), {}
    for lang, source in stats:
        own, same = stats[lang, source], [v for k, vs in stats.items() if k[0] == lang for v in vs]
        wide = quartiles(same)
        if len(same) < 30 or 4 * (wide[1] - wide[0]) < whole[1] - whole[0]:
            wide = whole
        if len(own) < 30:
            out[lang, source] = fence(wide, width)
        else:
            low, high = sorted([fence(wide, width // 2), fence(wide, 2 * width)])
            out[lang, source] = min(max(fence(quartiles(own), width), low), high)
    return out


def test_quality_fences(spark):
    """``kept`` against brute force, with groups above and below the least size; fences follow their group."""
    import math
    import random
    import unicodedata
    from collections import Counter

    rng = random.Random(5)
    prose = lambda low, high: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(low, high))) for _ in range(120))
    planted = {-1: prose(11, 13), -2: prose(2, 3)} | {-k: prose(1, 9) for k in range(3, 43)}
    docs = [r for r in rows_of("/root/testdata/sf0.1/documents.parquet") if r["source"] in ("src1", "src2", "src18", "src44") or r["doc_id"] % 50 == 0]
    docs += [{"doc_id": k, "text": text, "lang": "zz", "source": "planted"} for k, text in planted.items()]
    # Mostly copies: without spread, so the language's fence at half width holds; and a language of copies, where the corpus's does.
    copy = docs[0]["text"]
    docs += [{"doc_id": -100 - k, "text": copy if k % 4 else docs[k]["text"], "lang": docs[0]["lang"], "source": "copies"} for k in range(60)]
    docs += [{"doc_id": -200 - k, "text": copy if k % 10 else docs[k]["text"], "lang": "yy", "source": f"s{k % 2}"} for k in range(80)]
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs], "doc_id long, text string, lang string, source string")
    values, groups = {}, {}
    for r in docs:
        text = r["text"] or ""
        words = WORD.findall(text)
        n, chars = len(words), sum(map(len, words))
        marks = chars - sum(unicodedata.category(c)[0] in "LN" for c in text)
        share = lambda a, b, k: a * k // b if b else 0
        diversity = math.floor(math.log(len(set(words))) / math.log(n) * 10000 + 1e-6) if n > 1 else 10000
        values[r["doc_id"]] = dict(zip(quality_rules.RULES, (share(marks, chars, 10000), share(chars, n, 1000), share(sum(len(w) <= 3 for w in words), n, 10000), diversity), strict=True))
        groups[r["doc_id"]] = (r["lang"], r["source"])
    fences = {}
    for side, rule in quality_rules.FENCES:
        stats = {}
        for k, v in values.items():
            stats.setdefault(groups[k], []).append(v[rule])
        fences[side, rule] = brute_fences(stats, side, quality_rules.RULES[rule][1])
    sizes = Counter(groups.values())
    assert any(n < quality_rules.MIN_GROUP for n in sizes.values()) and sum(n >= quality_rules.MIN_GROUP for n in sizes.values()) >= 3
    out = quality_rules.evaluate(spark, df).collect()
    assert len(out) == len(docs)
    for r in out:
        v = values[r.doc_id]
        ends = {k: f[groups[r.doc_id]] for k, f in fences.items()}
        assert {x: r[x] for x in v} == v and {k: r["_".join(k)] for k in ends} == ends
        assert r.kept == (not r.base_failed and all(v[rule] <= end if side == "max" else v[rule] >= end for (side, rule), end in ends.items()))
    for f in fences.values():
        assert len({f[g] for g, n in sizes.items() if n >= quality_rules.MIN_GROUP}) >= 3
    # Only long or only short words are rejected, the other planted texts are not.
    kept = {r.doc_id: r for r in out if r.doc_id < 0}
    assert [k for k, r in kept.items() if not r.kept and -43 < k < -2] == [] and not kept[-1].kept and not kept[-2].kept
    assert sum(r.kept for k, r in kept.items() if k <= -100) >= 0.9 * sum(not r.base_failed for k, r in kept.items() if k <= -100)


def test_quality_fences_adapt(spark):
    """In sf0.1 most groups have fences of their own; longer words in one source move its fences, and hardly any others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en' or source in ('src1', 'src2')")
    rules = quality_rules.FENCES
    ends = lambda df: {(r._lang, r._source): tuple(r["_".join(k)] for k in rules) for r in quality_rules.thresholds(quality_rules.sketches(quality_rules.statistics(df))).collect()}
    before = ends(docs)
    for at in range(len(rules)):
        assert len({x[at] for x in before.values()}) > len(before) / 2
    from pyspark.sql import functions as F

    longer = F.when((F.col("source") == "src1") & (F.col("lang") == "en"), F.regexp_replace("text", "([a-z]{5})", "$1a")).otherwise(F.col("text"))
    after = ends(docs.withColumn("text", longer))
    at = [i for i, (_, rule) in enumerate(rules) if rule == "word_length_milli"]
    moved = {k: max(abs(after[k][i] - before[k][i]) for i in at) for k in before}
    assert moved["en", "src1"] > 200
    # Others follow only where the language's fences bound theirs.
    others = [d for k, d in moved.items() if k != ("en", "src1")]
    assert sum(d == 0 for d in others) >= 0.7 * len(others) and sorted(others)[len(others) * 9 // 10] <= moved["en", "src1"] / 4


def test_quality_sql(spark):
    from conftest_llm import oracle, sorted_rows

    for d in (SMALL, "/root/testdata/sf0.01"):
        assert sorted_rows(entries.queries()["op9_quality_rules"](spark, d)) == oracle(entries.oracle_sql()["op9_quality_rules"], d)


def test_quality_no_id(spark):
    """Rows without an id have a verdict each; clashing column names stay."""
    good = [r["text"] for r in rows_of(f"{SMALL}/documents.parquet") if r["lang"] == "en" and r["text"]]
    rows = [(k if k % 3 else None, t, "en", "s", k, "x") for k, t in enumerate(good)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long, kept string")
    verdict = {r.doc_id: r.kept for r in quality_rules.evaluate(spark, df.withColumn("doc_id", df.n_words)).collect()}
    kept = quality_rules.kept_documents(spark, df)
    assert kept.columns == df.columns and {r.n_words for r in kept.collect()} == {k for k, v in verdict.items() if v}


def test_quality_repeats(spark):
    texts = ["", "a", "a b", "a b c", "a b c a b c", "a a a a", "a b a b a b", "x a b c y a b c a b c", "a b c d a b c e b c d", " a  b\tc\n", "l\nl\n \n\nl", "\n".join(["q w e r"] * 5), " ".join(map(str, range(200_000))) + " 5 6 7"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality_rules.statistics(df).withColumnRenamed("source", "_s").selectExpr("*", "false as base_failed", "false as kept").collect():
        n, chars, symbols, dups, repeats = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats), texts[r.doc_id][:80]


def test_sketch(spark):
    from pyspark.sql import functions as F

    values = [*range(200), 1000, 1023, 1024, 10**6, 2**40 + 12345]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    b = quality_rules.bucket_of(F.col("v"))
    rows = df.select("v", b.alias("b"), quality_rules.bucket_floor(b).alias("f")).orderBy("v").collect()
    assert all(r.f <= r.v <= r.f * 2049 / 2048 + 1 for r in rows) and [r.b for r in rows] == sorted(r.b for r in rows)
    data = [("en", "s", v % 97) for v in range(400)] + [(None, None, 500)] * 40
    stats = spark.createDataFrame(data, "lang string, source string, v long").withColumns({r: F.col("v") for r in quality_rules.RULES})
    got = {(r.lang, r.rule): (r.docs, r.q1, r.q3) for r in quality_rules.quartiles(quality_rules.sketches(stats), ["lang"]).collect()}
    rule = next(iter(quality_rules.RULES))
    assert got[(None, rule)] == (40, 500, 500)
    own = sorted(v % 97 for v in range(400))
    assert got[("en", rule)] == (400, own[99], own[299])


def test_quality_odd(spark, odd, empty):
    out = quality_rules.evaluate(spark, odd).collect()
    assert len(out) == 10
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in out:
        check_base(r, texts[r.doc_id])
    assert quality_rules.evaluate(spark, empty).count() == 0
    assert quality_rules.kept_documents(spark, odd).columns == odd.columns


# ---- classifier


def test_classifier(spark):
    d = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in entries.queries()["op10_quality_classifier"](spark, d).collect()}
    labels = {r["doc_id"]: r["quality"] for r in rows_of(f"{d}/labels.parquet")}
    assert len(out) == 1000
    for k, r in out.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    test = [(out[k].predicted, y) for k, y in labels.items() if out[k].held_out]
    assert statistics.mean(a == b for a, b in test) >= 0.9
    assert statistics.mean(a == 1 for a, b in test if b == 1) >= 0.95


def test_isotonic():
    """Never decreasing, and the least-squares fit among all such curves, by minimax over blocks."""
    from itertools import pairwise

    rng = np.random.default_rng(3)
    for trial in range(60):
        total = rng.integers(0, 5, 40).astype(float) * (trial > 0)
        good = np.minimum(total, rng.integers(0, 5, 40))
        curve = quality_classifier.isotonic(total, good)
        assert len(curve) == 40 and all(a <= b for a, b in pairwise(curve)) and (curve >= 0).all() and (curve <= 1).all()
        p = quality_classifier.PSEUDO
        g, n = good + p * (good.sum() / total.sum() if total.sum() else 0.5), total + p
        mean = lambda i, j: g[i : j + 1].sum() / n[i : j + 1].sum()  # noqa: B023, E731
        want = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
        assert np.allclose(curve, want)


def test_classifier_brute_force(spark):
    """Scores against a fit over all rows at once: least squares on stacked rows, in place of summed equations."""
    d, q = "/root/testdata/sf0.01", quality_classifier
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in rows_of(f"{d}/documents.parquet")}
    labels = {r["doc_id"]: r["quality"] for r in rows_of(f"{d}/labels.parquet")}
    ids = sorted(k for k in labels if zlib.crc32(str(k).encode()) % 3 != 1)
    x, y = np.array([q.text_stats(docs[k]) for k in ids]), np.array([labels[k] for k in ids], float)
    folds = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in ids], "k long").selectExpr("k", f"pmod(xxhash64(k), {q.FOLDS})").collect()}
    fold = np.array([folds[k] for k in ids])
    mean, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-12)) + 1e-6
    w = np.where(y > 0.5, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))

    def fit(at):
        z = q._lift(x[at], mean, scale)
        ridge = np.diag(np.sqrt([q.RIDGE] * q.FEATURES + [1e-6]))
        root = np.sqrt(w[at])
        return np.linalg.lstsq(np.concatenate([z * root[:, None], ridge]), np.concatenate([y[at] * root, np.zeros(len(ridge))]), rcond=None)[0]

    raw = np.zeros(len(y))
    for k in range(q.FOLDS):
        raw[fold == k] = q._lift(x[fold == k], mean, scale) @ fit(fold != k)
    curve = q.isotonic(np.bincount(q._bin(raw), minlength=q.SCORE_BINS).astype(float), np.bincount(q._bin(raw), weights=y, minlength=q.SCORE_BINS))
    beta = fit(y >= 0)
    out = {r.doc_id: r.score for r in entries.queries()["op10_quality_classifier"](spark, d).collect()}
    errors = [abs(out[k] - curve[q._bin(q._lift(q.text_stats(t)[None], mean, scale) @ beta)][0]) for k, t in docs.items()]
    assert len(out) == len(docs) and sum(e > 1e-6 for e in errors) <= 0.01 * len(errors)


def test_classifier_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (7, 1), (8, 1), (None, 1), (9, None)], "doc_id long, quality int")
    assert len(quality_classifier.classify(spark, odd, labels).collect()) == 10
    none = quality_classifier.classify(spark, odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_classifier.classify(spark, empty, labels).count() == 0


# ---- pipeline


def test_pipeline(spark):
    import corpus_pipeline
    from conftest_llm import rows_of as rows
    from test_ngram_join import brute
    from test_text_ops import library

    from gridlark.llm import pii

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, seen = docs.columns, docs
    from gridlark.llm.common import Scratch

    scratch = Scratch(spark, "test")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        seen = scratch.save(stage(spark, seen, SMALL), name)
        got[name] = seen.collect()
        assert name == "bpe" or seen.columns == names
    verdict = {r.doc_id: r.kept for r in quality_rules.evaluate(spark, docs).collect()}
    assert {r.doc_id for r in got["quality_rules"]} == {k for k, v in verdict.items() if v}
    groups = brute([(r.doc_id, r.text) for r in got["quality_rules"]], 5, 80, 100)
    assert {r.doc_id for r in got["near_duplicates"]} == {k for k, (_, c) in groups.items() if c == k}
    before = {r.doc_id: r.text for r in got["near_duplicates"]}
    for r in got["pii"]:
        assert r.text == pii.masked(before[r.doc_id], pii.all_spans(before[r.doc_id], pii.potentials())[1]) and r.n_chars == len(r.text)
    clean = {r.doc_id: r.text for r in got["pii"]}
    mixed = {r.doc_id: r.text for r in got["mixing"]}
    assert mixed.items() <= clean.items() and 0 < len(mixed) < len(clean)
    want = dict(zip(mixed, library(list(mixed.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in got["bpe"]} == {k: len(ids) for k, (ids, _) in want.items()}
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(got["bpe"])
    assert rows(f"{SMALL}/documents.parquet")


def test_pipeline_odd(spark, odd, empty, tmp_path):
    """Odd rows, rows without an id, repeated rows and columns named as the stages' own; and an empty table."""
    import random

    import corpus_pipeline

    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 200))) for _ in range(40)]
    rows = [(k if k % 5 else None, t, "en", "s4", len(t), k) for k, t in enumerate(prose, 100)]
    rows += [rows[1], (900, prose[1], "en", "s4", 0, 900), (901, prose[2] + " more", None, None, None, 901)]
    whole = odd.unionByName(spark.createDataFrame(rows, odd.schema)).selectExpr("*", "a as tokens", "a as component_id", "a as _kept", "a as kept", "a as n_words")
    for k, df in enumerate((whole, empty)):
        df.repartition(3).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()
        assert bool(out) == (k == 0)
        if k == 0:
            ids = [r.doc_id for r in out]
            assert ids.count(None) > 0 and len([x for x in ids if x is not None and x >= 900]) <= 2 and not {1, 2, 3, 4, 5, 6} & {*ids}
    docs = spark.read.parquet(f"{tmp_path}/0/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, "")
    assert kept.columns == docs.columns
    unique = corpus_pipeline.STAGES[1][1](spark, kept, "")
    assert unique.columns == docs.columns
    want = {r.doc_id for r in kept.collect()}
    got = sorted((r.doc_id for r in unique.collect()), key=str)
    assert {*got} == want - {900, 901} and got.count(101) == 2 and got.count(None) == sum(r[0] is None for r in rows)
