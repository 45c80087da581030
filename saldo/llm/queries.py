"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import bpe, decontam, hostrules, langid, linededup, merkle, neardup, pii, preference, quotes, toxicity, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}
_statements: dict[str, str] = {}


def _query(statement: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _registered[fn.__name__] = fn
        if statement:
            _statements[fn.__name__] = statement
        return fn

    return register


def llm_queries() -> dict[str, Query]:
    """Registered queries by name."""
    return dict(_registered)


def llm_oracles() -> dict[str, str]:
    """Statements of the queries that SQL can express."""
    return dict(_statements)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(buckets: int) -> Column:
    """The hash class that the result contracts divide documents by."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(buckets))


@_query(
    """
    with l as (
      select distinct doc_id, source, trim(x) as line
      from (select doc_id, source, unnest(string_split(text, chr(10))) as x from documents) where trim(x) <> ''),
    t as (select source, count(*) as pages from documents group by 1),
    f as (
      select l.source, list(line) as lines
      from (select source, line, count(*) as n from l where source is not null group by 1, 2) l join t using (source)
      where n >= 5 and n > pages * 0.1 group by 1),
    d as (
      select doc_id, string_split(text, chr(10)) as parts, coalesce(f.lines, []) as lines
      from documents left join f using (source))
    select doc_id, array_to_string(kept, chr(10)) as text, cast(coalesce(len(parts) - len(kept), 0) as integer) as lines_dropped
    from (select doc_id, parts, list_filter(parts, lambda x: trim(x) = '' or not list_contains(lines, trim(x))) as kept from d)
    """
)
def op1_line_dedup(spark, sf):
    """Documents without the boilerplate lines of their source. A null text stays null."""
    cleaned = linededup.remove_boilerplate(table(spark, sf, "documents"))
    return cleaned.select("row.doc_id", F.col("text_kept").alias("text"), "lines_dropped")


@_query()
def op2_language_id(spark, sf):
    """Language and score of every whole text; learned outside the held-out hash class."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.filter(F.coalesce(fold(4) != 2, F.lit(True))))
    found = langid.predict(docs, model)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


#: Of the registered query only; a deployment passes a secret of its own.
SURROGATE_KEY = "registered-query"


@_query()
def op3_pii_surrogates(spark, sf):
    """Every text with surrogates for its personal data and secrets, and the kinds found. A null text stays null."""
    replaced = pii.replace_entities(table(spark, sf, "documents"), SURROGATE_KEY)
    return replaced.select("row.doc_id", F.col("text_clean").alias("text"), F.size("kinds").alias("n_entities"), "kinds")


@_query(
    """
    with p as (
      select page_id, coalesce(html, '') as payload, sha256(coalesce(html, '')) as payload_digest from pages),
    f as (
      select payload_digest, min(page_id) as first_id from p where strlen(payload) >= 100 group by 1)
    select page_id, strlen(payload) as payload_bytes, payload_digest,
      case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
      case when page_id <> first_id then first_id end as refers_to
    from p left join f using (payload_digest)
    """
)
def op4_warc(spark, sf):
    """Digest, kind and reference of every page, read back from the archives. A null page is empty."""
    index, folder = warc.archive(table(spark, sf, "pages"))
    return warc.read_archives(index, folder).drop("payload", "url")


@_query()
def op5_near_duplicates(spark, sf):
    """The class of every document: the smallest id that links of 0.8 or more over five-word shingles lead to."""
    return neardup.classes(table(spark, sf, "documents"))


@_query()
def op6_decontamination(spark, sf):
    """Every document and benchmark item that match, with their smallest edit distance."""
    return decontam.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query()
def op7_byte_bpe(spark, sf):
    """Digests of the token ids of every whole text and of what they decode to. A null text is empty."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf, "documents"), codec)


@_query()
def op8_toxicity(spark, sf):
    """Toxicity scores of all documents, learned from the labels outside the held-out hash class."""
    docs = table(spark, sf, "documents")
    learned = table(spark, sf, "labels").filter(F.coalesce(fold(3) != 1, F.lit(True)))
    found = toxicity.score(docs, toxicity.fit(docs, learned))
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")


@_query()
def op9_host_rules(spark, sf):
    """Counts of every whole text and the verdict of its own rule and its source."""
    return hostrules.judge(table(spark, sf, "documents")).drop("n_lines")


@_query(
    r"""
    with recursive n as (
      select conv_id, turn, min(text) as said,
        lower(trim(regexp_replace(min(text), '\s+', ' ', 'g'))) as t from conversations group by 1, 2),
    h as (select conv_id, t, min(turn) as first_turn from n where t <> '' group by 1, 2),
    p as (
      select n.conv_id, n.turn, coalesce(h1.first_turn, h2.first_turn) as parent
      from n left join n n1 on n1.conv_id = n.conv_id and n1.turn = n.turn - 1
        left join h h1 on h1.conv_id = n.conv_id and h1.t = n1.t and h1.first_turn < n.turn
        left join n n2 on n2.conv_id = n.conv_id and n2.turn = n.turn - 2
        left join h h2 on h2.conv_id = n.conv_id and h2.t = n2.t and h2.first_turn < n.turn),
    w as (
      select conv_id, turn, turn as root, 0 as depth from p where parent is null
      union all
      select p.conv_id, p.turn, w.root, w.depth + 1 from p join w on p.conv_id = w.conv_id and p.parent = w.turn)
    select c.conv_id, c.turn, c.role, c.text as own_text,
      case when p.parent is not null then c.conv_id end as parent_conv, p.parent as parent_turn,
      c.conv_id as root_conv, w.root as root_turn, w.depth
    from conversations c join p using (conv_id, turn) join w using (conv_id, turn)
    """
)
def op10_quotation_linking(spark, sf):
    """Every turn, written as a mail reply, with what it says itself, its parent, root and depth."""
    replies = quotes.as_replies(table(spark, sf, "conversations"))
    linked = quotes.conversations(replies, "conv_id", "turn", "text")
    renamed = {"parent_thread": "parent_conv", "parent_place": "parent_turn", "root_thread": "root_conv", "root_place": "root_turn"}
    return linked.select("row.conv_id", "row.turn", "row.role", "own_text", *[F.col(a).alias(b) for a, b in renamed.items()], "depth")


@_query()
def op11_feast_whitening(spark, sf):
    """Leading eight components of all embeddings; the deviation is null where it passes the range of a long."""
    found = whitening.whiten(table(spark, sf, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@_query(
    r"""
    with recursive base as (
      select doc_id, source, text,
        list_reduce(range(8 * len(doc_id::varchar)), lambda c, i:
          xor(xor(c, case when i % 8 = 0 then ascii(substr(doc_id::varchar, (i // 8 + 1)::int, 1)) else 0 end) >> 1,
            3988292384 * (xor(c, case when i % 8 = 0 then ascii(substr(doc_id::varchar, (i // 8 + 1)::int, 1)) else 0 end) & 1)), 4294967295) as crc,
        coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
        coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
      from documents),
    hashed as (
      select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        case when xor(crc, 4294967295) % 5 = 0 then sha256(head || coalesce(strlen(text) || ':' ||
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as tampered
      from base),
    leaf as (
      select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by source) as n, row_number() over () as i from hashed),
    up as (
      select 0 as lvl, source, pos, n, leaf as d from leaf
      union all
      select lvl + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' order by pos)) from up where n > 1
      group by lvl, source, n, pos // 16),
    sub as (
      select source, lvl as tall, d as subroot, row_number() over (order by source nulls first) - 1 as pos,
        count(*) over () as n from up where n = 1),
    above as (
      select 0 as lvl, pos, n, subroot as d from sub
      union all
      select lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' order by pos)) from above where n > 1
      group by lvl, n, pos // 16),
    step as (
      select lvl, source, pos, coalesce(string_agg(d, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
        coalesce(string_agg(d, '') over (w rows between 1 following and unbounded following), '') as r
      from up where n > 1 window w as (partition by lvl, source, pos // 16 order by pos)),
    above_step as (
      select lvl, pos, coalesce(string_agg(d, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
        coalesce(string_agg(d, '') over (w rows between 1 following and unbounded following), '') as r
      from above where n > 1 window w as (partition by lvl, pos // 16 order by pos)),
    walk as (
      select i, 0 as lvl, leaf.source, leaf.pos, sub.pos as top_pos, tall, coalesce(tampered, leaf) as d, '' as proof
      from leaf join sub on leaf.source is not distinct from sub.source
      union all
      select i, walk.lvl + 1, walk.source, case when walk.lvl < tall then walk.pos // 16 end,
        case when walk.lvl < tall then top_pos else top_pos // 16 end, tall,
        sha256(coalesce(s.l, a.l) || d || coalesce(s.r, a.r)), proof || coalesce(s.l, a.l) || coalesce(s.r, a.r)
      from walk
        left join step s on walk.lvl < tall and s.lvl = walk.lvl and s.pos = walk.pos and s.source is not distinct from walk.source
        left join above_step a on walk.lvl >= tall and a.lvl = walk.lvl - tall and a.pos = top_pos
      where s.l is not null or a.l is not null)
    select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
    from leaf join sub on leaf.source is not distinct from sub.source
      join (select i, arg_max(d, lvl) as folded_root, arg_max(proof, lvl) as proof from walk group by i) using (i)
      cross join (select d as root from above where n = 1)
    """
)
def op12_merkle_manifest(spark, sf):
    """Proof digests of all documents; every fifth folds a tampered leaf. Null ids are never tampered."""
    docs = table(spark, sf, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", ascii_uppercase, ascii_uppercase.lower())
    tampered = F.when(fold(5) == 0, merkle.leaf_digest(*head, lowered))
    found = merkle.proofs(merkle.manifest(docs, merkle.leaf_digest(*head, F.col("text")), carry={"tampered": tampered}))
    folded = merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("path"))
    proven = found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.siblings_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


@_query()
def op13_preference_quality(spark, sf):
    """Quality scores of all documents, learned from the labels outside the held-out hash class."""
    docs = table(spark, sf, "documents")
    learned = table(spark, sf, "labels").filter(F.coalesce(fold(4) != 2, F.lit(True)))
    found = preference.score(docs, learned)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
