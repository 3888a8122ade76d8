"""The corpus operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.llm.centroids import centroid_clusters
from wayflux.llm.common import table
from wayflux.llm.decontaminate import contamination
from wayflux.llm.fingerprints import edited_fingerprints
from wayflux.llm.language import page_languages
from wayflux.llm.mixing import document_rates
from wayflux.llm.near_dup import NearDup, near_dup_groups
from wayflux.llm.pseudonyms import Pseudonyms, pseudonym_report
from wayflux.llm.quality_rules import quality_report
from wayflux.llm.reputation import Rule, path_of, url_verdicts
from wayflux.llm.secrets import secret_report
from wayflux.llm.spellings import spelling_report
from wayflux.llm.token_files import token_table
from wayflux.llm.toxicity import learn, toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary files have ``name``."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_rows() -> Column:
    """Labels may be learnt only where the checksum of the id leaves a remainder by five."""
    return ~_held_out()


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup sketches of all documents, compared with their edited versions and with the next."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all pages; likelihoods of texts are learnt from the documents."""
    return page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), usable=training_rows())
    return toxicity_scores(docs, model).withColumn("held_out", _held_out())


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back."""
    return token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents by patterns and by entropy."""
    return secret_report(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's cell of source, language and topic, its calibrated rate, and the draw."""
    return document_rates(table(spark, sf_dir, "documents"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 % of their three-word shingles."""
    return near_dup_groups(table(spark, sf_dir, "documents"), NearDup(shingle=3, least=85))


#: Rules by host and path; the longest that fits wins.
URL_RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
             Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
             Rule("block", "com", "/de/"))


def _page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad when the document that its address names is labelled toxic or of low quality."""
    named = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(
        path_of("url"), r"^/[a-z]{2}/([0-9]{1,18})", 1).try_cast("bigint").alias("doc_id"))
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    return named.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "page_id", F.coalesce(bad, F.lit(False)).cast("int").alias("bad"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by rules, else by the reputation of their hosts."""
    return url_verdicts(table(spark, sf_dir, "pages"), _page_outcomes(spark, sf_dir), URL_RULES).withColumns(
        {c: F.round(c, 6) for c in ("mean", "lower")})


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal numbers, dates and addresses replaced.  The key of a real
    run comes from the setting ``spark.wayflux.pseudonym.key``."""
    key = spark.conf.get("spark.wayflux.pseudonym.key", "key of the test tables")
    return pseudonym_report(table(spark, sf_dir, "documents"), Pseudonyms(key.encode()))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in all documents."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents, one occurrence in 97 mistyped."""
    return spelling_report(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, and verdicts of a list learnt from labels outside the held-out fifth."""
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                          usable=training_rows())


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all vectors of 64 components after three rounds."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_fingerprints, op2_language, op3_toxicity, op4_token_files, op5_secrets, op6_mixing,
        op7_near_dup, op8_url_filter, op9_pseudonyms, op10_decontaminate, op11_spellings,
        op12_quality_rules, op13_centroids)}


#: Rates of bad outcomes are shrunk level by level; {strength} of a level is a query of one row.
_STRENGTH = """(select case when count(*) < 2 or m.mean * (1 - m.mean) <= 0 or sum(n) * sum(n) <= sum(n * n) then 1000.0
    when (sum(n * pow(bad * 1.0 / n - m.mean, 2)) - (count(*) - 1) * m.mean * (1 - m.mean)) <= 0 then 1000.0
    else least(greatest(m.mean * (1 - m.mean) * (sum(n) - sum(n * n) * 1.0 / sum(n))
        / (sum(n * pow(bad * 1.0 / n - m.mean, 2)) - (count(*) - 1) * m.mean * (1 - m.mean)) - 1, 1.0), 1000.0) end
    from {level}, m where n > 0 group by m.mean)"""

_OP8 = f"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
urls as (
  select page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from cut),
outcome as (
  select page_id, max(case when toxic = 1 or quality = 0 then 1 else 0 end) as bad from urls join labels
    on doc_id = try_cast(regexp_extract(path, '^/[a-z]{{2}}/([0-9]{{1,18}})', 1) as bigint) group by page_id),
parts as (select page_id, host, string_split(regexp_extract(host, '^[^:]*'), '.') as labels from urls),
hosts as (
  select host, count(bad) as n, coalesce(sum(bad), 0) as bad, array_to_string(any_value(labels)[-2:], '.') as domain,
    any_value(labels)[-1] as suffix from parts left join outcome using (page_id) group by host),
domains as (select domain, sum(n) as n, sum(bad) as bad, any_value(suffix) as suffix from hosts group by domain),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from hosts group by suffix),
m as (select case when sum(n) > 0 then (sum(bad) + 0.5) / (sum(n) + 1) else 0.5 end as mean from hosts),
k as (select coalesce({_STRENGTH.format(level='suffixes')}, 1000.0) as ks,
  coalesce({_STRENGTH.format(level='domains')}, 1000.0) as kd, coalesce({_STRENGTH.format(level='hosts')}, 1000.0) as kh),
s as (select suffix, (bad + ks * m.mean) / (n + ks) as mean from suffixes, k, m),
d as (select domain, (domains.bad + kd * s.mean) / (domains.n + kd) as mean from domains join s using (suffix), k),
h as (select host, (hosts.bad + kh * d.mean) / (hosts.n + kh) as mean, n, kh from hosts join d using (domain), k),
rules(verdict, host, path) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit as (
  select page_id, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(verdict, length(r.host || r.path)) as verdict from urls u join rules r
    on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path) group by page_id)
select u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, case when mean - 1.2816
    * sqrt(mean * (1 - mean) / (n + kh + 1)) > 0.5 then 'block' else 'allow' end) as verdict,
  round(mean, 6) as mean, round(mean - 1.2816 * sqrt(mean * (1 - mean) / (n + kh + 1)), 6) as lower
from urls u left join fit using (page_id) left join h on h.host = u.host"""

_OP10 = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
item as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
spots as (
  select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from item where len(w) > 0),
windows as (select distinct item_id, list_slice(w, k, k + 9) as words from spots),
sizes as (select distinct len(words) as size from windows),
places as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k from doc, sizes where len(w) >= size),
hits as (
  select doc_id, k, size, item_id from places p join windows v on list_slice(p.w, k, k + size - 1) = v.words),
found as (
  select doc_id, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as listed from hits group by doc_id),
words as (
  select doc_id, count(distinct place) as n_hit from (
    select doc_id, unnest(range(k, k + size)) as place from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, n_hit is not null as contaminated
from doc left join found using (doc_id) left join words using (doc_id)"""

#: Pairs by the variants of each word without one code point; the checksum is computed from its rule.
_OP11 = r"""
with recursive steps as (
  select i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) t(i)),
tab as (select list(cast(v as bigint) order by i) as t from steps),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents),
cells as (
  select run, count(*) as times, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x
  from runs group by doc_id, run),
sums as (
  select run, times, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(1, len(x) + 1, 2),
      lambda i: cast((instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1 as bigint))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as h from cells, tab),
typed as (
  select times, case when h % 97 = 0 then left(run, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2)
    else run end as word from sums),
words as materialized (
  select word, cast(sum(times) as bigint) as n from typed where length(word) >= 5 group by word having sum(times) >= 3),
cuts as materialized (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as part
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.part = b.part and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cuts a join words b on a.part = b.word
  union select b.word, a.word, a.n from cuts a join words b on a.part = b.word),
best as (
  select word, count(*) as n_near, max(near_n) as top, min(struct_pack(a := -near_n, b := near)).b as form from pairs group by word),
formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 2 * w.n then form end as form,
    case when top >= 2 * w.n then top end as form_n from words w left join best using (word)),
walk as (
  select word, word as place, 0 as hops from formed
  union all select walk.word, form, hops + 1 from walk join formed on formed.word = walk.place where form is not null)
select word, form, (select arg_max(place, hops) from walk where walk.word = formed.word) as root, n, n_near, form_n from formed"""

_NEAREST = """
a{r} as materialized (
  select vec_id, row, any_value(v) as v, min(struct_pack(d := d, k := k)) as m from (
    select vec_id, row, v, k, cast(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) as bigint) as d
    from vecs, c{r}) group by vec_id, row)"""
_MEANS = """
s{r} as (
  select k, i, sum(x) as s, count(*) as n from (
    select m.k as k, unnest(range(1, 65)) as i, unnest(v) as x from a{p}) group by k, i),
m{r} as (select k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c from s{r} group by k),
c{r} as materialized (select k, coalesce(m{r}.c, c{p}.c) as c from c{p} left join m{r} using (k))"""

_OP13 = """
with vecs as materialized (
  select vec_id, row_number() over () as row,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (
  select row_number() over (order by sha256('1:' || vec_id), v) - 1 as k, v as c from vecs
  order by sha256('1:' || vec_id), v limit 16),""" + ",".join(
    [_NEAREST.format(r=0)] + [_MEANS.format(r=r, p=r - 1) + "," + _NEAREST.format(r=r) for r in (1, 2, 3)]) + """
select vec_id, cast(m.k as int) as cluster, m.d as distance, cast(sum(m.d) over (partition by m.k) as bigint) as cluster_inertia,
  cast(sum(m.d) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from a3 join c3 on k = m.k"""


def oracle_sql() -> dict[str, str]:
    """The operators that SQL can express; the others are tested against brute force."""
    return {"op8_url_filter": _OP8, "op10_decontaminate": _OP10, "op11_spellings": _OP11,
            "op13_centroids": _OP13}
