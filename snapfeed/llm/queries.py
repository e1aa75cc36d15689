"""The registered queries of this package (one per operator, and the pipeline)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfeed.llm import blockrank, bpe, flatgraph, guesscost, katz, licenses, minhash, mixing, pairwise, repair, rules, warc, wrapper
from snapfeed.llm.registry import ORACLE, REGISTRY, query  # noqa: F401
from snapfeed.session import read_table


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_minhash_dedup")
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op10_katz_lm")
def op10_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read_table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ranker = pairwise.train(docs, read_table(spark, sf_dir, "labels"))
    scored = pairwise.classify(docs, ranker, ["doc_id"])
    return scored.select("doc_id", (~pairwise.training_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


_OP2_SQL = """
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), d as (
    select payload_digest as digest, max(page_id) as first from p where payload_bytes >= 1000 group by 1 having count(*) > 1
)
select page_id, payload_bytes, payload_digest,
       case when first is not null and page_id <> first then 'revisit' else 'response' end as record_type,
       case when page_id <> first then first end as refers_to
from p left join d on payload_digest = digest and payload_bytes >= 1000
"""


@query("op1_vector_dedup")
def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query("op2_warc", _OP2_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(read_table(spark, sf_dir, "pages"))


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licenses.document_files(read_table(spark, sf_dir, "documents"))
    found = licenses.inherit(licenses.scan(files, keep=("doc_id", "path")))
    return found.select("doc_id", "path", "license", "how", "from_dir", F.round("cosine", 6).alias("cosine"))


# The program over turns as a recursive query: a cell is the cost (nine digits) and
# the audit, so the least text is the cheapest edit list with the least audit.
_OP12_SQL = """
with recursive c as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           list_reduce([cast(4294967295 as bigint)] || list_transform(
               string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ascii(x) as bigint)),
               lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))) as crc
    from conversations
), d as (
    select conv_id, turn, xor(crc, 4294967295) % 20 as how, role, text from c
), e as (
    select conv_id, turn, case when how = 4 then 'user' else role end as role,
           case when how = 1 then '' when how = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from d, unnest(case when how = 3 then [1, 2] else [1] end) as u(k) where how <> 0
), r as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from e
), f as (
    select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as spoken
    from r
), g as (
    select *, case when spoken = '' then 'b' when again then 'd' when right(spoken, 1) not in ('.', '!', '?') then 't' else '' end as fault,
           coalesce(lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal
    from f
), s as (
    select conv_id, cast(0 as bigint) as i, '000000000' as n, cast(null as varchar) as s, '000000005I' as u, '000000010II' as a from (select distinct conv_id from g)
    union all
    select conv_id, i, n, s, u, a from (
        select conv_id, i, n, s, u, least(a, lpad(cast(cast(left(u, 9) as int) + 5 as varchar), 9, '0') || substr(u, 10) || 'I') as a from (
            select conv_id, i, n, s, a,
                   least(u, lpad(cast(cast(left(n, 9) as int) + 5 as varchar), 9, '0') || substr(n, 10) || 'I',
                         lpad(cast(cast(left(s, 9) as int) + 5 as varchar), 9, '0') || substr(s, 10) || 'I',
                         lpad(cast(cast(left(a, 9) as int) + 5 as varchar), 9, '0') || substr(a, 10) || 'I') as u from (
                select s.conv_id, g.i,
                       lpad(cast(cast(left(n, 9) as int) + 2 as varchar), 9, '0') || substr(n, 10) || 'D' as n,
                       least(lpad(cast(cast(left(s, 9) as int) + 2 as varchar), 9, '0') || substr(s, 10) || 'D',
                             case when fault in ('', 't') and left(role, 1) = 's'
                                  then lpad(cast(cast(left(n, 9) as int) + if(fault = 't', 5, 0) as varchar), 9, '0') || substr(n, 10) || 'K' end) as s,
                       least(lpad(cast(cast(left(u, 9) as int) + 2 as varchar), 9, '0') || substr(u, 10) || 'D',
                             case when fault in ('', 't') then
                                 lpad(cast(cast(left(least(n, s, a), 9) as int) + if(left(role, 1) = 'u', 0, 1) + if(fault = 't', 5, 0) as varchar), 9, '0')
                                 || substr(least(n, s, a), 10) || if(left(role, 1) = 'u', 'K', 'R') end) as u,
                       least(lpad(cast(cast(left(a, 9) as int) + 2 as varchar), 9, '0') || substr(a, 10) || 'D',
                             case when fault in ('', 't') then
                                 lpad(cast(cast(left(u, 9) as int) + if(left(role, 1) = 'a', 0, 1) + if(fault = 't', 5, 0) as varchar), 9, '0')
                                 || substr(u, 10) || if(left(role, 1) = 'a', 'K', 'R') end) as a
                from s join g on s.conv_id is not distinct from g.conv_id and g.i = s.i + 1)))
), best as (
    select conv_id, least(n, a) as best from s qualify row_number() over (partition by conv_id order by i desc) = 1
), w as (
    select conv_id, cast(left(best, 9) as bigint) as cost, substr(best, 10) as audit from best
), letters as (
    select conv_id, p, substr(audit, p, 1) as edit,
           count(*) filter (where substr(audit, p, 1) <> 'I') over (partition by conv_id order by p) as i
    from w, unnest(range(1, length(audit) + 1)) as u(p)
), said as (
    select l.conv_id, l.p, l.edit, g.role, g.text, row_number() over (partition by l.conv_id order by l.p) as k
    from letters l left join g on g.conv_id is not distinct from l.conv_id and g.i = l.i and l.edit <> 'I' where l.edit <> 'D'
), shift as (
    select *, max(case when k = 1 and edit = 'K' and left(role, 1) = 's' then 1 else 0 end) over (partition by conv_id) as after from said
), repaired as (
    select conv_id, string_agg(case when edit = 'K' then role || ':' || text
                                    else if((k - after) % 2 = 1, 'user', 'assistant') || ':' || coalesce(text, '') end, chr(10) order by k) as repaired
    from shift group by 1
), counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'b') as blank,
           count(*) filter (where fault = 'd') as duplicate, count(*) filter (where fault = 't') as truncated, count(*) filter (where illegal) as illegal
    from g group by 1
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted t on t.conv_id is not distinct from o.conv_id
left join w on w.conv_id is not distinct from o.conv_id
left join repaired r on r.conv_id is not distinct from o.conv_id
"""


@query("op12_conversation_repair", _OP12_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(read_table(spark, sf_dir, "conversations")))


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guesscost.report(read_table(spark, sf_dir, "documents"))


_OP13_SQL = r"""
with d as (
    select row_number() over () as ref, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
), q as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), s as (
    select count(*) as n, cast(sum(len(terms)) as bigint) as total from d where len(terms) > 0
), p as (
    select ref, any_value(doc_id) as doc_id, term, count(*) as tf, any_value(size) as size
    from (select ref, doc_id, len(terms) as size, unnest(terms) as term from d) group by ref, term
), w as (
    select term, cast(floor(1000 * ln((2.0 * any_value(n) + 2) / (2 * count(*) + 1))) as bigint) as w from p, s group by term
), scored as (
    select item_id, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // total)))) as bigint) as score
    from q join p using (term) join w using (term), s group by item_id, ref
), ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from scored where score > 0
)
select * from ranked where rank <= 50
"""


@query("op13_lexical_search", _OP13_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockrank.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
