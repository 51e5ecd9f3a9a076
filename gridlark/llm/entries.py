"""Queries of the training-data operators, for the driver's contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprints, mixing, ngram_join, pii, quality_classifier, quality_rules, url_filter, warc_zip

WEIGHTS = {"domain": {"even": 3, "odd": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.jaccard_components(spark, table(spark, d, "documents"), n=4, num=85, den=100)


def _url_filter(spark: SparkSession, d: str) -> DataFrame:
    """Fetch times and the dated list are derived from the pages: see URL_SQL, which states the same rule."""
    pages = table(spark, d, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int")))
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    domain, host = F.regexp_extract("host", "([^.]+[.][^.]+)$", 1), F.col("host")
    number = lambda name, a, n: F.conv(F.substring(F.md5(F.col(name).cast("binary")), a, n), 16, 10).cast("long")
    numbered = hosts.withColumn("domain", domain).select("host", "domain", number("host", 1, 4).alias("h1"), number("host", 5, 4).alias("h2"), number("domain", 1, 4).alias("d1"), number("domain", 5, 4).alias("d2"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    entry = lambda name, pattern, action, at: F.struct(F.lit(name).alias("list_name"), pattern.alias("pattern"), F.lit(action).alias("action"), at.alias("listed_at"))
    # Domains are listed, removed and listed again.
    first, ended = F.col("d1") % 365, F.col("d1") % 365 + 100 + F.col("d2") % 100
    rows = F.array(
        entry("hosts", host, "add", day(F.col("h1") % 600)), entry("hosts", host, "remove", day(F.col("h1") % 600 + F.col("h2") % 200)),
        entry("paths", F.concat(host, F.lit("/en")), "add", day(F.col("h2") % 700)),
        *(entry("domains", F.col("domain"), action, day(at)) for action, at in (("add", first), ("remove", ended), ("add", ended + 90))),
    )
    entries = numbered.select(F.explode(rows).alias("e")).select("e.*")
    out = url_filter.filter_urls(captures, entries)
    return out.select("page_id", F.col("fetched_at").cast("string").alias("fetched_at"), "n_matches", "matched", "blocked")


URL_SQL = r"""
with pages2 as (
  select page_id, cast(date '2024-01-01' + cast((page_id * 37) % 730 as integer) as date) fetched_at,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) path from pages),
hosts as (select distinct host, cast(concat('0x', substr(md5(host), 1, 4)) as bigint) h1, cast(concat('0x', substr(md5(host), 5, 4)) as bigint) h2, regexp_extract(host, '([^.]+[.][^.]+)$', 1) dom from pages2 where host <> ''),
doms as (select distinct dom, cast(concat('0x', substr(md5(dom), 1, 4)) as bigint) % 365 d1, cast(concat('0x', substr(md5(dom), 5, 4)) as bigint) % 100 + 100 d2 from hosts),
spans as (
  select 'hosts' list_name, host pattern, cast(date '2024-01-01' + cast(h1 % 600 as integer) as date) a, cast(date '2024-01-01' + cast(h1 % 600 + h2 % 200 as integer) as date) b from hosts where h2 % 200 > 0
  union all select 'paths', host || '/en', cast(date '2024-01-01' + cast(h2 % 700 as integer) as date), null from hosts
  union all select 'domains', dom, cast(date '2024-01-01' + cast(d1 as integer) as date), cast(date '2024-01-01' + cast(d1 + d2 as integer) as date) from doms
  union all select 'domains', dom, cast(date '2024-01-01' + cast(d1 + d2 + 90 as integer) as date), null from doms),
hits as (
  select p.page_id, count(*) n, min(s.list_name || ':' || s.pattern) m from pages2 p join spans s
    on (s.pattern = p.host or (s.list_name = 'domains' and ends_with(p.host, '.' || s.pattern)) or (s.list_name = 'paths' and s.pattern = p.host || '/en' and (p.path = '/en' or starts_with(p.path, '/en/'))))
    and s.a <= p.fetched_at and (s.b is null or s.b > p.fetched_at) group by 1)
select p.page_id, cast(p.fetched_at as varchar) fetched_at, coalesce(h.n, 0) n_matches, h.m matched, h.n is not null blocked from pages2 p left join hits h using (page_id)
"""


def _warc_zip(spark: SparkSession, d: str) -> DataFrame:
    return warc_zip.round_trip(spark, table(spark, d, "pages")).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
with x as (select page_id, octet_length(encode(coalesce(html, ''))) n, sha1(coalesce(html, '')) d from pages),
m as (select d, max(page_id) main from x where n >= 1000 group by d)
select page_id, n payload_bytes, d payload_digest, case when main <> page_id then 'revisit' else 'response' end record_type,
  case when main <> page_id then main end refers_to from x left join m using (d)
"""


def _chat_format(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe_rows(spark))
    return chat.digests(chat.format_records(chat.gather_records(rows)))


def _pii_crf(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(table(spark, d, "documents"))


def _mixing(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.mix(spark, table(spark, d, "documents"), share_permille=1400, weights=WEIGHTS, seed=17, max_epochs=4)
    return out.select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def _bpe_chunks(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"), tokenizer_path())


def _fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(table(spark, d, "documents"))


def _quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.evaluate(spark, table(spark, d, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier.classify(spark, table(spark, d, "documents"), table(spark, d, "labels"))


JACCARD_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) >= 4 then list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) s from w),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
pairs as (select a, b from e union all select b, a from e),
reach(x, y) as (select distinct doc_id, doc_id from documents union select x, b from reach join pairs on y = a)
select d.doc_id, coalesce(max(n.n), 0) n_shingles, min(y) component_id from documents d left join n using (doc_id) join reach on x = d.doc_id group by 1
"""

_CONTROLS = ", ".join(f"'{c}'" for c in chat.CONTROLS)
#: What escaping adds: a sign for each sign, for each place where a control string begins and, in roles, for each line feed.
_ADDED = f"(length({{0}}) - length(replace({{0}}, '{chat.ESCAPE}', '')) + coalesce(list_sum(list_transform([{_CONTROLS}], lambda c: (length({{0}}) - length(replace({{0}}, c, ''))) // length(c))), 0))"
CHAT_SQL = f"""
with r as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations where conv_id is not null
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
x as (select *, length('{chat.START}') + length(r) + {_ADDED.format("r")} + length(r) - length(replace(r, chr(10), '')) + 1 + length(t) + {_ADDED.format("t")} + length('{chat.END}') + 1 n from r),
g as (select conv_id, count(*) n_turns, string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t) whole, coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '') loss, sum(n) n from x group by 1)
select cast(conv_id as bigint) conv_id, n_turns, sha256(whole) turns_sha256, cast(length(loss) as bigint) loss_chars, sha256(loss) loss_sha256, cast(n as bigint) formatted_chars from g
"""


def _mixing_sql() -> str:
    """The mix as SQL: water-filling by windows over siblings, level by level, then each leaf's prefix by a running sum."""
    parts = [
        r"t as (select doc_id, lang, source, case when regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' then 'other' when right(source, 1) in ('0', '2', '4', '6', '8') then 'even' else 'odd' end as domain, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) n from documents)",
        "leaf as (select domain, lang, source, sum(n) tokens, cast(sum(n) * 4 as hugeint) c from t group by all)",
        "l0 as (select *, sum(tokens) over () * 1400 // 1000 b from leaf)",
    ]
    for k, level in enumerate(mixing.LEVELS):
        above, here = ", ".join(mixing.LEVELS[:k]), ", ".join(mixing.LEVELS[: k + 1])
        by = f"partition by {above}" if above else ""
        weight = " ".join(f"when '{name}' then {w}" for name, w in WEIGHTS.get(level, {}).items())
        weight = f"case {level} {weight} else 1 end" if weight else "1"
        order = f"{by} order by c // w, c % w * 1000000000000000000 // w, {level} nulls first"
        parts += [
            f"n{k} as (select {here}, sum(c) c, max(b) b, cast({weight} as hugeint) w from l{k} group by {here})",
            f"o{k} as (select *, row_number() over ({order}) i, b - coalesce(sum(c) over ({order} rows between unbounded preceding and 1 preceding), 0) left_, sum(w) over ({by}) - coalesce(sum(w) over ({order} rows between unbounded preceding and 1 preceding), 0) w_ from n{k})",
            f"f{k} as (select *, min(case when c * w_ > left_ * w then i end) over ({by}) stop from o{k})",
            f"g{k} as (select *, max(case when i = stop then left_ end) over ({by}) sl, max(case when i = stop then w_ end) over ({by}) sw from f{k})",
            f"s{k} as (select {here}, case when c * w_ <= left_ * w then c else least(c, greatest(sl, 0) * w // sw) end nb from g{k})",
            f"l{k + 1} as (select l{k}.* exclude (b), nb b from l{k} join s{k} on {' and '.join(f'l{k}.{x} is not distinct from s{k}.{x}' for x in mixing.LEVELS[: k + 1])})",
        ]
    parts += [
        "plan as (select *, case when tokens > 0 then least(b // tokens, 4) else 0 end whole from l3)",
        "taken as (select t.*, whole, b - whole * tokens rest, cast('0x' || substr(md5('17:' || whole || ':' || doc_id), 1, 15) as bigint) h from t join plan on t.domain = plan.domain and t.lang is not distinct from plan.lang and t.source is not distinct from plan.source)",
        "placed as (select *, coalesce(sum(n) over (partition by domain, lang, source order by h, doc_id rows between unbounded preceding and 1 preceding), 0) before from taken)",
    ]
    return "with " + ",\n".join(parts) + "\nselect doc_id, domain, lang, source, cast(n as bigint) n_tokens, cast(whole + case when before < rest then 1 else 0 end as integer) copies from placed where whole + case when before < rest then 1 else 0 end > 0"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": _ngram_jaccard,
        "op2_url_filter": _url_filter,
        "op3_warc_zip": _warc_zip,
        "op4_chat_format": _chat_format,
        "op5_pii_crf": _pii_crf,
        "op6_mixing": _mixing,
        "op7_bpe_chunks": _bpe_chunks,
        "op8_fingerprints": _fingerprints,
        "op9_quality_rules": _quality_rules,
        "op10_quality_classifier": _quality_classifier,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": JACCARD_SQL, "op2_url_filter": URL_SQL, "op3_warc_zip": WARC_SQL, "op4_chat_format": CHAT_SQL, "op6_mixing": _mixing_sql(), "op9_quality_rules": quality_rules.ORACLE_SQL}
