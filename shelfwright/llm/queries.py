"""Registered queries of this subpackage, ``opN_<name>``, with the SQL that must agree where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.bindings.registry import query, table
from shelfwright.llm import (
    bpe_tree,
    conversation_repair,
    deobfuscate,
    extendible_dedup,
    importance,
    langid,
    ngram_join,
    pseudo_lm,
    secret_scan,
    sp_viterbi,
    template_decon,
    token_files,
    warc,
)
from shelfwright.session import workspace

PIECE_MODEL, BYTE_MODEL, END_ID = "piece_bpe_32k.model", "byte_bpe_50k.json", 2


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts encoded into flat files in the shared folder, and what the files hold of each document."""
    path = workspace(spark, "tokens")
    token_files.write(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_MODEL), END_ID)
    return token_files.digest(spark, path)


@query("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicate documents: five-word shingles, similarity 0.8 or more."""
    return ngram_join.link_components(spark, table(spark, sf_dir, "documents"))


@query("op9_exact_dedup", """
    with d as (
        select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
        from documents
    )
    select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
        doc_id is not distinct from max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
    from d
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the copy that stays."""
    return extendible_dedup.mark_copies(spark, table(spark, sf_dir, "documents"))


@query("op1_language_bitmask_filter")
def op1_language_bitmask_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; nothing is learned from the held-out fold."""
    documents = table(spark, sf_dir, "documents")
    fold = langid.held_out(F.col("doc_id"))
    model = langid.learn(documents.where(~fold))
    return langid.predict(spark, documents, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op4_pseudo_likelihood")
def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under a network trained on all of them."""
    return pseudo_lm.train_and_score(spark, table(spark, sf_dir, "documents"))


# The rules of ``template_decon`` in SQL; the expressions are the same for both engines.
_SLOTS = "[chr(57345), chr(57346), chr(57347)]"
_LEAKS_SQL = rf"""
    with src as (
        select 'i' as k, item_id as id, coalesce(text, '') as t from benchmark where item_id is not null
        union all select 'd', doc_id, coalesce(text, '') from documents
    ), named as (
        select *, regexp_replace(t, '{template_decon.NAMES}', '\1 ' || chr(57345) || ' ', 'g') as n from src
    ), numbered as (
        select *, regexp_replace(n, '{template_decon.NUMBERS}', ' ' || chr(57346) || ' ', 'g') as m from named
    ), cut as (
        select *, regexp_replace(m, '{template_decon.UNITS}', chr(57346) || ' ' || chr(57347) || ' \2', 'g') as u from numbered
    ), worded as (
        select *, list_filter(string_split_regex(lower(u), '{template_decon.BREAKS}'), lambda w: w <> '') as words from cut
    ), sized as (
        select id as item_id, words, least(len(words), {template_decon.WINDOW}) as size from worded where k = 'i' and len(words) >= {template_decon.SHORT}
    ), of_items as (
        select item_id, pos, size, len(words) - size + 1 as windows, array_to_string(words[pos + 1:pos + size], ' ') as w,
            len(list_filter(words[pos + 1:pos + size], lambda x: list_contains({_SLOTS}, x))) as slots
        from (select *, unnest(range(len(words) - size + 1)) as pos from sized)
    ), of_docs as (
        select id as doc_id, place, size, array_to_string(words[place + 1:place + size], ' ') as w
        from (select id, words, size, unnest(range(len(words) - size + 1)) as place
            from worded, (select distinct size from sized) where k = 'd' and len(words) >= size)
    ), candidates as (
        select doc_id, item_id, place - pos as apart, size, least(greatest({template_decon.MIN_WORDS} - size + 1, 1), ceil(windows / 2)) as needed,
            count(distinct pos) as n_windows, count(distinct case when slots = 0 then pos end) as n_plain, min(pos) as low, max(pos) as high
        from of_items join of_docs using (size, w) where size - slots >= {template_decon.LITERAL}
        group by all having count(distinct pos) >= needed
    ), slots as (
        select k, id, place, slot, case slot when chr(57345) then regexp_extract_all(t, '{template_decon.NAMES}', 2)
            when chr(57346) then regexp_extract_all(n, '{template_decon.NUMBERS}', 1) else regexp_extract_all(m, '{template_decon.UNITS}', 1) end[nth] as value
        from (select *, words[place + 1] as slot, len(list_filter(words[1:place + 1], lambda x: x = words[place + 1])) as nth
            from (select *, unnest(range(len(words))) as place from worded)
            where list_contains({_SLOTS}, words[place + 1]))
    ), checked as (
        select c.doc_id, c.item_id, c.apart, count(distinct (a.slot, a.value)) as n_values, count(distinct (a.slot, a.value, b.value)) as n_pairs,
            bool_and(a.value = b.value) as same
        from candidates c join slots a on a.k = 'i' and a.id = c.item_id and a.place between c.low and c.high + c.size - 1
        join slots b on b.k = 'd' and b.id = c.doc_id and b.place = a.place + c.apart and b.slot = a.slot group by all
    ), judged as (
        select c.*, coalesce(same, true) or n_values < n_pairs as exact
        from candidates c left join checked using (doc_id, item_id, apart) where n_values is null or n_values = n_pairs or n_plain >= needed
    ), plain as (
        select k, id, t, list_filter(string_split_regex(lower(t), '{template_decon.BREAKS}'), lambda w: w <> '') as words from src
    ), copy_sized as (
        select id as item_id, words, least(len(words), {template_decon.WINDOW}) as size from plain where k = 'i' and len(words) >= {template_decon.LINE}
    ), copy_items as (
        select item_id, pos, size, len(words) - size + 1 as windows, array_to_string(words[pos + 1:pos + size], ' ') as w
        from (select *, unnest(range(len(words) - size + 1)) as pos from copy_sized)
    ), copy_docs as (
        select id as doc_id, place, size, array_to_string(words[place + 1:place + size], ' ') as w
        from (select id, words, size, unnest(range(len(words) - size + 1)) as place
            from plain, (select distinct size from copy_sized) where k = 'd' and len(words) >= size)
    ), lines as (
        select id as doc_id, list_filter(string_split_regex(lower(line), '{template_decon.BREAKS}'), lambda w: w <> '') as words
        from (select id, unnest(string_split_regex(t, '[\n\r]+')) as line from src where k = 'd')
    ), copies as (
        select doc_id, item_id, count(distinct pos) as n_windows from copy_items join copy_docs using (size, w)
        group by doc_id, item_id, place - pos, size, windows
        having count(distinct pos) >= least(greatest({template_decon.MIN_WORDS} - size + 1, 1), ceil(windows / 2))
        union all select doc_id, id, 1 from lines join plain on k = 'i' and plain.words = lines.words
        where len(lines.words) between 1 and {template_decon.LINE - 1}
    ), found as (
        select doc_id, item_id, n_windows, exact from judged union all select doc_id, item_id, n_windows, true from copies
    )
    select doc_id, item_id, n_windows, case when exact then 'exact' else 'reparameterised' end as kind
    from (select *, row_number() over (partition by doc_id, item_id order by n_windows desc, exact desc) as r from found) where r = 1
"""


@query("op5_template_decontamination", _LEAKS_SQL)
def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the items that they contain."""
    return template_decon.find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_sentencepiece_viterbi")
def op6_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and whether its ids decode to it."""
    return sp_viterbi.round_trip(spark, table(spark, sf_dir, "documents"), sp_viterbi.load(public_tokenizers.path(PIECE_MODEL)))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op10_pii_deobfuscation")
def op10_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, also disguised."""
    return deobfuscate.scan(table(spark, sf_dir, "documents"))


@query("op7_warc", """
    with p as (
        select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes from pages
    ), m as (
        select *, max(page_id) over (partition by payload) as first from p
    )
    select page_id, payload_bytes, sha1(payload) as payload_digest,
        case when payload_bytes >= 1000 and page_id <> first then 'revisit' else 'response' end as record_type,
        case when payload_bytes >= 1000 and page_id <> first then first end as refers_to
    from m
""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived in the shared folder, and what the archives hold of each."""
    path = workspace(spark, "warc")
    warc.write(spark, table(spark, sf_dir, "pages"), path)
    return warc.pages_of(warc.read(spark, path))


@query("op11_importance_resampling", rf"""
    with steps as (
        select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as step
        from range(256) t(i)
    ), texts as (
        select 'd' as k, doc_id, row_number() over () as r, text from documents union all select 'b', null, row_number() over (), text from benchmark
    ), words as (
        select k, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from texts
    ), counted as (
        select k, r, word, count(*) as n from (select k, r, unnest(words) as word from words) group by all
    ), coded as (
        select word, hex(encode(word)) as h from (select distinct word from counted)
    ), buckets as (
        select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::bigint)),
            lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) % {importance.BUCKETS} as bucket from coded, steps
    ), hits as (
        select k, r, bucket, sum(n) as n from counted join buckets using (word) group by all
    ), totals as (
        select bucket, coalesce(sum(n) filter (k = 'd'), 0) as s, coalesce(sum(n) filter (k = 'b'), 0) as t from hits group by all
    ), gains as (
        select bucket, floor(1000 * ln((t + 1)::double * ((select sum(s) from totals) + {importance.BUCKETS})::double
            / ((s + 1)::double * ((select sum(t) from totals) + {importance.BUCKETS})::double)))::bigint as gain from totals
    ), sums as (
        select r, sum(n)::bigint as n, sum(n * gain)::bigint as total from hits join gains using (bucket) where k = 'd' group by all
    ), weighed as (
        select doc_id, coalesce(n, 0)::bigint as n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::bigint as weight,
            ('0x' || sha256('{importance.SEED}:' || coalesce(doc_id::varchar, ''))[1:8])::bigint as h
        from texts left join sums using (r) where k = 'd'
    ), scored as (
        select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from weighed
    ), ranked as (
        select *, row_number() over (partition by n_features >= {importance.LEAST_WORDS} order by score desc, doc_id nulls first, n_features) as place,
            count(*) over (partition by n_features >= {importance.LEAST_WORDS}) as n from scored
    )
    select doc_id, n_features, weight, score,
        case when n_features >= {importance.LEAST_WORDS} and place <= {importance.PERCENT} * n // 100 then place end as rank from ranked
""")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document for the benchmark's distribution, and the ranks of those drawn."""
    return importance.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its audit of every conversation, after planted damage."""
    return conversation_repair.repair(spark, conversation_repair.damage(table(spark, sf_dir, "conversations")))[0]


@query("op13_bpe_tree")
def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe_tree.round_trip(spark, table(spark, sf_dir, "documents"), bpe_tree.load(public_tokenizers.path(BYTE_MODEL)))
