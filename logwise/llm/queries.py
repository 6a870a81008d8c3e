"""Registered queries of the operators, each over its whole table.

Keys without an entry in ``ORACLES`` are checked against brute force, exact
round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.llm import chat, codes, divergence, fingerprints, language, lattice, lm, mixing, mtree, ngram_join, paragraphs, pieces
from logwise.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document, over_limit above 4096."""
    return pieces.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@register
def op4_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole document and their decoding, as digests."""
    return pieces.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


#: Conversation -1 holds the template's own control strings as text.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, then read back from the output."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    messages = rows.unionByName(extra).withColumn("content", chat.text_part(F.col("text")))
    done = chat.format_chat(messages)
    back = done.select(
        "conv_id",
        "formatted",
        "expanded_tokens",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "expanded_tokens",
    )


_ESC = r"regexp_replace(regexp_replace(replace(coalesce(text, ''), '\', '\\'), '\[(/?(?:INST|SYS|ASST|ROLE|MSG|IMAGE|AUDIO|DOC)[\]:])', '[\\\1', 'g'), '<(/?s>)', '<\\\1', 'g')"
ORACLES["op7_chat_format"] = rf"""
with c as (
  select conv_id, turn, role, text from conversations
  union all select -1, t, case t when 0 then 'user' else 'assistant' end, '{CONTROL_TEXT}' from range(2) r(t)
), e as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    case when role = 'assistant' then coalesce(text, '') else '' end as loss,
    case role when 'user' then 13 when 'system' then 11 when 'assistant' then 10
      else 17 + length(coalesce(role, '')) end + length({_ESC}) as chars
  from c
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(length(loss)) as bigint) as loss_chars,
  sha256(string_agg(loss, '' order by turn, role, text)) as loss_sha256,
  cast(3 + sum(chars) as bigint) as formatted_chars,
  cast(0 as bigint) as expanded_tokens
from e group by conv_id
"""


@register
def op8_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every query row (ids divisible
    by 50) over all other rows."""
    rows = read_table(spark, sf_dir, "embeddings")
    return mtree.top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


ORACLES["op8_top_inner_products"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as z
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.z) = len(q.z)
  where q.vec_id % 50 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


@register
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine >= 0.95 between all embeddings, and their components."""
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by the random field."""
    return language.identify(read_table(spark, sf_dir, "documents"))


#: Domain of a source by its number; other names belong to "other".
DOMAINS = {"web": (0, 4), "news": (5, 9), "books": (10, 14), "forum": (15, 19)}
#: Relative weights per level of the mixture; unlisted names weigh 1.
MIX_WEIGHTS = {
    "domain": {"web": 4, "news": 2, "books": 3, "forum": 1},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 2},
    "source": {},
}
MIX_EPOCHS, MIX_SEED = 4, 20


def domain_of(source: Column) -> Column:
    """Domain of a source name such as ``src12``."""
    number = F.regexp_extract(source, r"^src(\d{1,4})$", 1)
    number = F.when(number == "", None).otherwise(number).cast("int")
    out = F.lit("other")
    for name, (low, high) in DOMAINS.items():
        out = F.when(number.between(low, high), name).otherwise(out)
    return out


@register
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to target weights, as many tokens as the table has."""
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, domain_of(F.col("source")), MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def _sql_weight(column: str, weights: dict[str, int]) -> str:
    whens = " ".join(f"when '{k}' then {v}" for k, v in weights.items())
    return f"(case {column} {whens} else 1 end)" if whens else "1"


def _sql_level(name: str, path: list[str], above: str) -> str:
    """Budgets of one level: nodes, their level, the common level."""
    cols, parent = ", ".join(path), ", ".join(path[:-1]) or "1"
    join = f"join {above} using ({', '.join(path[:-1])})" if path[:-1] else f"cross join {above}"
    return f"""
{name}_n as (
  select {cols}, cap, {_sql_weight(path[-1], MIX_WEIGHTS[path[-1]])} as w, total
  from (select {cols}, cast(sum(cap) as bigint) as cap from leaves group by {cols}) {join}
), {name}_l as (
  select *, (total - coalesce(sum(cap) over (p rows between unbounded preceding and 1 preceding), 0))::double
      / sum(w) over (p rows between current row and unbounded following) as lv
  from {name}_n window p as (partition by {parent} order by cap::double / w, {path[-1]})
), {name} as (
  select {cols}, case when cap <= lv * w then cap
      else least(cap, cast(floor(max(case when cap > lv * w then lv end) over (partition by {parent}) * w) as bigint)) end as total
  from {name}_l
)"""


ORACLES["op1_source_mix"] = f"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as n_tokens,
    try_cast(regexp_extract(source, '^src([0-9]{{1,4}})$', 1) as integer) as num
  from documents
), light as (
  select doc_id, lang, source, n_tokens,
    case {' '.join(f"when num between {a} and {b} then '{k}'" for k, (a, b) in DOMAINS.items())} else 'other' end as domain
  from d
), leaves as (
  select domain, lang, source, cast(sum(n_tokens) as bigint) as tokens, cast(sum(n_tokens) * {MIX_EPOCHS} as bigint) as cap
  from light group by all
), root as (
  select cast(least(sum(tokens), sum(cap)) as bigint) as total from leaves
),{_sql_level("l1", ["domain"], "root")},{_sql_level("l2", ["domain", "lang"], "l1")},{_sql_level("l3", ["domain", "lang", "source"], "l2")}
, plan as (
  select domain, lang, source, total as budget,
    case when tokens > 0 then total // tokens else 0 end as epochs,
    total - case when tokens > 0 then total // tokens else 0 end * tokens as rest
  from leaves join l3 using (domain, lang, source)
), ranked as (
  select *, sum(n_tokens) over (partition by domain, lang, source
    order by md5('{MIX_SEED}:' || epochs || ':' || coalesce(cast(doc_id as varchar), ''))) as upto
  from light join plan using (domain, lang, source)
), t as (
  select *, epochs + case when rest > 0 and upto <= rest then 1 else 0 end as times from ranked
)
select doc_id, domain, lang, source, n_tokens, unnest(range(cast(times as bigint))) as epoch from t where times > 0
"""


@register
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 3-word-shingle Jaccard >= 0.9."""
    return ngram_join.join_documents(read_table(spark, sf_dir, "documents"))


@register
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole document by the recurrent model."""
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


@register
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that occur in an earlier document or place."""
    return paragraphs.repeated_passages(read_table(spark, sf_dir, "documents")).drop("text_hash")


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings after six rounds of refinement."""
    return codes.codes_with_digest(read_table(spark, sf_dir, "embeddings"))


def _sql_codes() -> str:
    """The rounds written out: one pair of tables (nearest entry, next
    codebook) per round."""
    parts, entries, rounds = codes.PARTS, codes.ENTRIES, codes.ROUNDS
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} as materialized (
  select pos, part, n, (min((list_sum(list_transform(list_zip(part, e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), entry))) as best
  from parts join book{r} using (pos) group by all
)""")
        if r < rounds:
            steps.append(f"""
mean{r} as (
  select pos, entry, list((s - ((s % c) + c) % c) // c order by place) as e
  from (select pos, best[2] as entry, place, sum(n * part[place]) as s, sum(n) as c
        from near{r}, (select unnest(range(1, 65)) as place) where place <= len(part) group by all)
  group by all
), book{r + 1} as materialized (
  select pos, entry, coalesce(m.e, b.e) as e from book{r} b left join mean{r} m using (pos, entry)
)""")
    return f"""
with v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor({codes.SCALE} * cast(x as double)) as hugeint)) as z
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as materialized (
  select vec_id, label, pos, z[pos * len(z) // {parts} + 1 : (pos + 1) * len(z) // {parts}] as part
  from v, (select unnest(range({parts})) as pos)
), parts as materialized (select pos, part, count(*) as n from cut group by all)
, book0 as materialized (
  select pos, entry, part as e
  from cut join (select vec_id, row_number() over (order by vec_id) - 1 as entry from v) using (vec_id) where entry < {entries}
),{",".join(steps)}
, coded as (
  select vec_id, label, string_agg(printf('%02x', best[2]), '' order by pos) as code, cast(sum(best[1]) as bigint) as error
  from cut join near{rounds} using (pos, part) group by all
), digest as (
  select sha256(string_agg(cast(x as varchar), ',' order by pos, entry, place)) as codebooks_sha256
  from (select pos, entry, unnest(e) as x, unnest(range(len(e))) as place from book{rounds})
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded, digest
"""


ORACLES["op11_vector_codes"] = _sql_codes()


@register
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.compare_edited(read_table(spark, sf_dir, "documents"))


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, and their leading terms."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def _sql_share(count: str, total: str) -> str:
    return f"(1 + (1000000000 * (cast({count} as hugeint) + 2)) // ({total}))"


def _sql_divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"


ORACLES["op13_source_divergence"] = f"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{divergence.TERM}') as terms
  from documents
), t as materialized (select lang, source, row, unnest(terms) as term from d
), kept as materialized (
  select lang, term from t group by all having count(distinct row) >= {divergence.LEAST_DOCS}
), occ as materialized (select lang, source, term, count(*) as c from t join kept using (lang, term) group by all
), g as materialized (
  select lang, source, coalesce(n, 0) as n, coalesce(v, 0) as v from (select distinct lang, source from d)
  left join (select lang, source, sum(c) as n from occ group by all) using (lang, source)
  left join (select lang, count(*) as v from kept group by all) using (lang)
), p as materialized (
  select lang, source, term, coalesce(c, 0) as c, {_sql_share("coalesce(c, 0)", "n + 2 * v")} as p
  from g join kept using (lang) left join occ using (lang, source, term)
), q as (
  select lang, term, {_sql_share("sum(c)", "any_value(n + 2 * v)")} as q
  from occ join (select lang, sum(n) as n, any_value(v) as v from g group by all) using (lang) group by all
), pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as item, sum({_sql_divergence("a.p", "b.p")}) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  ) s on s.lang = a.lang and s.source = a.source and s.item = b.source
), term as (
  select lang, source, 'term' as part, term as item, {_sql_divergence("p", "q")} as value
  from p join q using (lang, term) where c > 0 and p > q
), r as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pair union all select * from term)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from r where part = 'pair' or rank <= {divergence.TOP_TERMS}
"""
