"""The contract queries: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import (
    decontamination,
    divergence,
    language_model,
    order_minhash,
    packing,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    token_files,
    top_k,
    url_filters,
    vector_codes,
)
from quotelake.llm.common import table, written
from quotelake.llm.registry import query
from quotelake.session import new_path

# Fixed values of the contract.
URL_RULES = [
    url_filters.Rule("org/", "allow"),
    url_filters.Rule("example.org/es/", "block"),
    url_filters.Rule("example.org/en/1", "block"),
    url_filters.Rule("com/fr/", "allow"),
    url_filters.Rule("com/de/", "block"),
]


def _stated_sql(value) -> str:
    """The longest rule that fits, as ``value(rule)``."""
    cases = ""
    for rule in sorted(URL_RULES, key=lambda r: (-len(r.text), r.text)):
        cases += (
            f" when (host = '{rule.host}' or ends_with(host, '.{rule.host}'))"
            f" and starts_with(path, '{rule.path}') then '{value(rule)}'"
        )
    return f"case{cases} end"


URL_SQL = f"""
with cut as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as tail
    from pages),
named as (
    select page_id, regexp_extract(tail, '^([^/?#]*)', 1) as raw,
        substr(tail, length(regexp_extract(tail, '^([^/?#]*)', 1)) + 1) as rest
    from cut),
parts as (
    select row_number() over () as r, page_id,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^([^?#]*)', 1) as path,
        regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) as query,
        regexp_extract(rest, '#([\\s\\S]*)$', 1) as fragment
    from named),
lists as (
    select *, list_filter(string_split(host, '.'), lambda x: x <> '') as h,
        list_filter(string_split(path, '/'), lambda x: x <> '') as s,
        list_sort(list_distinct(list_filter(list_transform(string_split(query, '&'),
            lambda x: split_part(x, '=', 1)), lambda x: x <> ''))) as k
    from parts),
tokens as (
    select r, page_id, host, path, list_filter([
        'host1=' || h[-1], 'host2=' || h[-2], 'host3=' || h[-3],
        case when len(h) > 3 then 'hosts=' || array_to_string(list_reverse(h[:-4]), '/') end,
        'path1=' || s[1], 'path2=' || s[2],
        case when len(s) > 2 then 'paths=' || array_to_string(s[3:], '/') end,
        case when len(k) > 0 then 'query=' || array_to_string(k, '&') end,
        case when fragment <> '' then 'fragment=' || fragment end], lambda x: x is not null) as t
    from lists),
marks as (
    select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
    from labels where doc_id is not null group by doc_id),
sets as (
    select r, list_sort(list_filter(t, lambda x, i: (m >> (i - 1)) & 1 = 1)) as items
    from tokens, range(1, 512) masks(m) where m < (1 << len(t))),
labelled as (select r, bad from tokens join marks on page_id = doc_id),
size as (select count(*) as n, coalesce(sum(bad), 0) / greatest(count(*), 1)::double as base from labelled),
mined as (
    select items, array_to_string(items, ' ') as text, sum(bad) / count(*)::double as confidence,
        sum(bad) / any_value(n)::double as support
    from sets join labelled using (r), size group by items
    having sum(bad) >= 5 and sum(bad) / count(*)::double >= greatest(0.3e0, 1.5e0 * any_value(base))),
best as (
    select r, max({{'c': confidence, 's': support, 't': text}}) as b
    from sets join mined using (items) group by r)
select page_id, host, path, {_stated_sql(lambda r: r.text)} as rule,
    coalesce({_stated_sql(lambda r: r.verdict)}, case when b is not null then 'block' else 'allow' end) as verdict,
    b['t'] as mined_rule, round(b['c'], 6) as mined_confidence
from tokens left join best using (r)
"""


@query(URL_SQL)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by stated and mined rules."""
    pages, labels = (table(spark, sf_dir, n) for n in ("pages", "labels"))
    return url_filters.judge_urls(pages, labels, URL_RULES)


@query()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by its words' shares and by the model."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality and toxicity, and whether it is kept."""
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return quality.judge(docs, labels)


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 100 bytes."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    r"""
with normal as (
    select 'd' as kind, doc_id as id, text from documents
    union all select 'b', item_id, text from benchmark),
worded as (
    select kind, id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from normal),
items as (
    select id as item_id, w, least(len(w), 10) as l from worded where kind = 'b' and len(w) > 0),
known as (
    select distinct item_id, l, array_to_string(w[i:i + l - 1], ' ') as gram
    from (select *, unnest(range(1, len(w) - l + 2)) as i from items)),
windows as (
    select id as doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') as gram
    from (
        select id, w, l, unnest(range(1, len(w) - l + 2)) as i
        from worded, (select distinct l from known) where kind = 'd' and len(w) >= l)),
hits as (select doc_id, i, windows.l, item_id from windows join known using (gram)),
covered as (
    select doc_id, count(distinct i + k) as n from hits, lateral (select unnest(range(l)) as k) group by doc_id),
named as (
    select doc_id, count(distinct item_id) as n,
        array_to_string(list_sort(list(distinct item_id::varchar)), ',') as ids
    from hits group by doc_id)
select id as doc_id, len(w) as n_words, coalesce(covered.n, 0) as n_hit,
    coalesce(named.n, 0) as n_items, sha256(coalesce(named.ids, '')) as items_sha256,
    coalesce(covered.n, 0) > 0 as contaminated
from worded left join covered on id = covered.doc_id left join named on id = named.doc_id
where kind = 'd'
"""
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document is in the benchmark."""
    docs, benchmark = (table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    found = decontamination.find_windows(docs, benchmark)
    n_hit = decontamination.hit_words("hits")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    shown = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return found.select("doc_id", shown, "component_id")


@query()
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next one's."""
    found = order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.shown("signature").alias("fingerprint"),
        order_minhash.shown("edited_signature").alias("edited_fingerprint"),
        order_minhash.likeness("signature", "edited_signature").alias("near_edited"),
        order_minhash.likeness("signature", "next_signature").alias("near_next"),
    )


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every piece of every document."""
    pieces = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the secrets of every document."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, shown), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


@query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, read back from the written files."""
    folder = new_path(spark, "token-ids")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_ids(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    digests = written(token_files.token_digests(spark, folder), "token-digests")
    return token_files.with_starts(digests)


@query(
    r"""
with worded as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents),
kept as (select lang, term, count(*) as c from worded group by all having count(distinct r) >= 3),
here as (select lang, source, term, count(*) as c from worded join kept using (lang, term) group by all),
langs as (select lang, sum(c)::hugeint as n, count(*)::hugeint as v from kept group by lang),
pairs as (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
groups as (
    select p.lang, p.source, coalesce(h.n, 0)::hugeint as n, coalesce(l.v, 0) as v, coalesce(l.n, 0) as lang_n
    from pairs p left join (select lang, source, sum(c) as n from here group by all) h using (lang, source)
    left join langs l using (lang)),
grid as (
    select g.lang, g.source, k.term, coalesce(h.c, 0) as c,
        1 + 1000000000::hugeint * (coalesce(h.c, 0) + 1) // (g.n + g.v) as p,
        1 + 1000000000::hugeint * (k.c + 1) // (g.lang_n + g.v) as q
    from groups g join kept k using (lang) left join here h on h.lang = g.lang and h.source = g.source and h.term = k.term),
pair as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
whole as (
    select a.lang, a.source, b.source as item, coalesce(value, 0) as value
    from pairs a join pairs b on a.lang = b.lang and a.source <> b.source
    left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source),
terms as (select lang, source, term as item, (p - q) * (p - q) // q as value from grid where c > 0 and p > q),
ranked as (
    select lang, source, 'pair' as part, item, value,
        row_number() over (partition by lang, source order by value desc, encode(item)) as rank from whole
    union all
    select lang, source, 'term', item, value,
        row_number() over (partition by lang, source order by value desc, encode(item)) from terms)
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= 200
"""
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far sources lie from each other, and the terms that set each apart."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def _codes_sql(rounds: int = 6) -> str:
    """Assignment and update of all codebooks, round after round."""
    usable = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    steps = f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v
    from embeddings where {usable}),
cut as (
    select vec_id, label, i::bigint as part, v[i * len(v) // 8 + 1:(i + 1) * len(v) // 8] as v
    from kept, range(8) parts(i)),
seeds as (select vec_id, row_number() over (order by vec_id) - 1 as entry from (select vec_id from kept order by vec_id limit 16)),
book0 as materialized (select part, entry, v as e from cut join seeds using (vec_id))"""
    far = "list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    for i in range(rounds + 1):
        steps += f""",
near{i} as materialized (
    select vec_id, part, min(struct_pack(far := {far}, entry := entry)) as best
    from cut join book{i} using (part) group by vec_id, part)"""
        if i < rounds:
            steps += f""",
mean{i} as (
    select part, entry, place, sum(x)::bigint as s, count(*) as n
    from (select part, best.entry as entry, unnest(v) as x, unnest(range(len(v))) as place
        from cut join near{i} using (vec_id, part)) group by all),
book{i + 1} as materialized (
    select part, entry, coalesce(m.e, b.e) as e from book{i} b left join (
        select part, entry, list((s - ((s % n) + n) % n) // n order by place) as e from mean{i} group by all) m
    using (part, entry))"""
    return steps + f""",
coded as (
    select vec_id, string_agg(printf('%02x', best.entry), '' order by part) as code, sum(best.far)::bigint as error
    from near{rounds} group by vec_id),
labelled as (select kept.vec_id, label, code, error from kept join coded using (vec_id)),
sums as (select label, sum(error)::bigint as label_error from labelled group by label)
select vec_id, code, error, label_error,
    (select sha256(string_agg(array_to_string(e, ','), ',' order by part, entry)) from book{rounds}) as codebooks_sha256
from labelled join sums on labelled.label is not distinct from sums.label
"""


@query(_codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the digest of the codebooks."""
    codes, books = vector_codes.fit_codes(table(spark, sf_dir, "embeddings"))
    found = vector_codes.with_label_error(codes).drop("label")
    return found.withColumn("codebooks_sha256", F.lit(vector_codes.codebook_digest(books)))


@query(
    """
with kept as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
    from embeddings where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from kept q join kept c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
)
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best matches of every hundredth vector."""
    return top_k.top_matches(table(spark, sf_dir, "embeddings"))
