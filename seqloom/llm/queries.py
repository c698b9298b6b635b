"""Registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ship_package
from . import byte_bpe, chat_format, embedding_dedup, fim, language_id, minhash, packing, pii, slack_packing, spelling, substring_dedup, topk, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, oracle: str | None = None):
    """Register ``fn(table) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


@query("op6_byte_level_bpe", "documents")
def byte_level_bpe(documents: DataFrame) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN), ranks)


@query("op10_best_fit_packing", "documents")
def best_fit_packing(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_language_id", "documents")
def identify_language(documents: DataFrame) -> DataFrame:
    model = language_id.train(documents.filter(~language_id.held_out(F.col("doc_id"))))
    predicted = language_id.classify(documents, model)
    return predicted.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query(
    "op5_minhash_near_dedup", "documents",
    r"""
    with recursive ws as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') l from documents),
    words as (select doc_id, unnest(l) w, generate_subscripts(l, 1) i from ws),
    runs as (select doc_id, list(w) over (partition by doc_id order by i rows between current row and 3 following) r from words),
    sets as (select distinct doc_id, hash(array_to_string(r, ' ')) s from runs where len(r) = 4 union all select doc_id, hash(array_to_string(l, ' ')) from ws where len(l) between 1 and 3),
    sizes as (select doc_id, count(*) n from sets group by 1),
    shared as (select a.doc_id x, b.doc_id y, count(*) k from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    pairs as (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * k >= 80 * (a.n + b.n - k)),
    links as (select x, y from pairs union all select y, x from pairs),
    reach as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
    least as (select x doc_id, min(y) m from reach group by 1)
    select doc_id, coalesce(n, 0) n_shingles, coalesce(least(m, doc_id), doc_id) component_id, coalesce(m >= doc_id, true) kept
    from ws left join sizes using (doc_id) left join least using (doc_id)
    """,
)
def minhash_near_dedup(documents: DataFrame) -> DataFrame:
    return minhash.near_duplicates(documents, words=4)


@query(
    "op2_substring_dedup", "documents",
    r"""
    with ws as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') l from documents),
    words as (select doc_id, unnest(l) w, generate_subscripts(l, 1) i from ws),
    runs as (select *, list(w) over (partition by doc_id order by i rows between current row and 12 following) r from words),
    wins as (select doc_id, i, w, case when len(r) = 13 then array_to_string(r, ' ') end win from runs),
    firsts as (select win, min(doc_id) d from wins where win is not null group by 1),
    marked as (select doc_id, i, w, coalesce(d < doc_id, false) hit from wins left join firsts using (win)),
    judged as (select doc_id, i, w, bool_or(hit) over (partition by doc_id order by i rows between 12 preceding and current row) gone from marked),
    kept as (select doc_id, count(*) filter (where gone) n_removed, string_agg(w, ' ' order by i) filter (where not gone) k from judged group by 1)
    select doc_id, cast(len(l) as bigint) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(k, '')) kept_sha256 from ws left join kept using (doc_id)
    """,
)
def substring_removal(documents: DataFrame) -> DataFrame:
    kept = substring_dedup.remove_repeats(documents)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_pii", "documents")
def personal_data(documents: DataFrame) -> DataFrame:
    found = pii.detect(documents)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op1_url_filter", "pages",
    """
    with found as (select page_id, url, coalesce(strpos(url, '://'), 0) i from pages),
    rest as (select page_id, case when i > 0 then substr(url, i + 3) else '' end r from found),
    cut as (select page_id, regexp_extract(r, '^[^/?#]*') h, r from rest),
    parsed as (select row_number() over () n, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
      regexp_extract(substr(r, length(h) + 1), '^[^?#]*') path from cut),
    rules(r_host, r_path, verdict) as (values ('net','/','block'), ('example.net','/en/','allow'), ('example.com','/de/','block'), ('org','/fr/','allow')),
    best as (select n, arg_max(r_host || r_path, length(r_host || r_path)) rule, arg_max(verdict, length(r_host || r_path)) verdict
      from parsed join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path) group by n)
    select page_id, host, path, rule, coalesce(verdict, 'allow') verdict from parsed left join best using (n)
    """,
)
def url_rules(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(pages, rules)


@query(
    "op3_chat_format", "conversations",
    r"""
    with given as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
      union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    near as (select *, lag(role) over w before, lead(role) over w after,
      length(text) + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2 escaped,
      length(role) + length(role) - length(replace(role, '\', '')) + (length(role) - length(replace(role, '<|', ''))) // 2
        + length(role) - length(replace(role, chr(10), '')) named
      from given window w as (partition by conv_id order by turn nulls first, role, text))
    select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) turns_sha256,
      cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) loss_chars,
      sha256(coalesce(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text), '')) loss_sha256,
      cast(sum(escaped + case when before is not distinct from role then 8 else 10 + named end + case when after is not distinct from role then 0 else 8 end) as bigint) formatted_chars
    from near group by conv_id
    """,
)
def chat_formatting(conversations: DataFrame) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    given = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").unionByName(probe)
    return chat_format.digest(chat_format.format_chats(given))


@query(
    "op7_exact_top_k", "embeddings",
    """
    with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) u from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    pairs as (select q.vec_id query_id, v.vec_id, list_sum(list_transform(list_zip(q.u, v.u), lambda p: p[1] * p[2])) score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
    ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from pairs)
    select query_id, cast(rank as int) rank, vec_id, cast(score as bigint) score from ranked where rank <= 5
    """,
)
def exact_top_k(embeddings: DataFrame) -> DataFrame:
    return topk.top_k(embeddings, F.col("vec_id") % 50 == 0, k=5)


@query(
    "op9_embedding_near_dedup", "embeddings",
    """
    with recursive v as (select vec_id, cast(embedding as double[]) u from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs as (select a.vec_id x, b.vec_id y from v a join v b on a.vec_id < b.vec_id where list_cosine_similarity(a.u, b.u) >= 0.9),
    links as (select x, y from pairs union all select y, x from pairs),
    reach as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
    counted as (select x vec_id, count(*) n_links from links group by 1), least as (select x vec_id, min(y) m from reach group by 1)
    select vec_id, coalesce(n_links, 0) n_links, coalesce(least(m, vec_id), vec_id) component_id, coalesce(m >= vec_id, true) kept
    from embeddings left join counted using (vec_id) left join least using (vec_id)
    """,
)
def embedding_near_dedup(embeddings: DataFrame) -> DataFrame:
    return embedding_dedup.near_duplicates(embeddings)


@query(
    "op13_fill_in_middle", "documents",
    """
    with hashed as (select doc_id, coalesce(text, '') t, cast(length(coalesce(text, '')) as bigint) n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) d from documents),
    numbers as (select *, cast('0x' || substr(d, 1, 8) as bigint) h1, cast('0x' || substr(d, 9, 8) as bigint) h2,
      cast('0x' || substr(d, 17, 8) as bigint) h3, cast('0x' || substr(d, 25, 8) as bigint) h4 from hashed),
    chosen as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
      case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end form from numbers)
    select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
      sha256(case form when 'plain' then t
        when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
        else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end) output_sha256,
      sha256(t) restored_sha256 from chosen
    """,
)
def fill_in_middle(documents: DataFrame) -> DataFrame:
    return fim.digest(fim.transform(documents))


@query("op12_minimum_slack_packing", "documents")
def minimum_slack_packing(documents: DataFrame) -> DataFrame:
    return slack_packing.pack(documents, public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op11_spelling_variants", "documents",
    """
    with recursive runs as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) run from documents),
    given as (select translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') r, coalesce(cast(doc_id as varchar), '') || ':' id from runs where length(run) >= 7),
    counted as (select r, id || r s, count(*) n from given group by 1, 2),
    bytes as (select r, n, hex(s) x, strlen(s) k from counted),
    hashed as (select r, n, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(0, k), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint))),
      lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, range(0, 8)), lambda y, z: xor(y >> 1, cast(3988292384 as bigint) * (y & 1))))), 4294967295) h from bytes),
    spared as (select case when h % 31 = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end word, n from hashed),
    w as (select word, cast(sum(n) as bigint) n from spared where length(word) >= 7 group by 1 having sum(n) >= 2),
    v as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) x from (select *, unnest(range(0, length(word))) i from w)),
    near as (select a.word, b.word near, b.n near_n from v a join v b on a.i = b.i and a.x = b.x and a.word <> b.word
      union select v.word, w.word, w.n from v join w on v.x = w.word union select w.word, v.word, v.n from v join w on v.x = w.word),
    best as (select word, count(*) n_near, arg_max(struct_pack(a := near, b := near_n), (near_n, -place)) b
      from (select *, row_number() over (partition by word order by near) place from near) group by 1),
    judged as (select w.word, n, coalesce(n_near, 0) n_near, case when b.b >= 10 * n then b.a end form, case when b.b >= 10 * n then b.b end form_n from w left join best using (word)),
    steps as (select word, form root, 1 step from judged where form is not null
      union all select steps.word, judged.form, step + 1 from steps join judged on judged.word = root where judged.form is not null),
    roots as (select word, arg_max(root, step) root from steps group by 1)
    select word, form, coalesce(root, word) root, n, n_near, form_n from judged left join roots using (word)
    """,
)
def spelling_variants(documents: DataFrame) -> DataFrame:
    return spelling.variants(documents)
