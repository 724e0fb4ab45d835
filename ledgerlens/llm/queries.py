"""The registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import mine_collocations
from .decontaminate import decontaminate
from .html_extract import extract_text
from .jaccard_join import jaccard_components
from .langid import identify_languages, train_languages
from .merkle import merkle_manifest, proof_text
from .mixing import mix
from .packing import pack_documents
from .quality_rules import quality_rules, train_quality
from .secret_scan import BASE_KINDS, scan_secrets
from .toxicity import score_toxicity
from .unigram_tokens import count_tokens, read_vocabulary
from .zip_warc import round_trip

TOXIC_FROM = 0.3
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
SEQUENCE_TOKENS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=5, percent=75)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(documents, table(spark, sf_dir, "labels"))
    return quality_rules(documents, model, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10, carry=["doc_id"])
    ids = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Production weights of the mixture: domains, languages (inside a domain), sources (inside a language).
DOMAINS = {"web": 0.5, "books": 0.3, "code": 0.2}
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
MIX_SEED, MIX_EPOCHS = 20240611, 4


def domain_of_source():
    """A source's domain, by the last digit of its number."""
    digit = F.substring("source", -1, 1)
    return F.when(digit.isin("0", "1", "2", "3", "4"), "web").when(digit.isin("5", "6", "7"), "books").otherwise("code")


def mixture(documents: DataFrame) -> DataFrame:
    return mix(
        documents, domain_of_source(), F.col("supply") * 0.5, DOMAINS, LANGUAGES, {}, seed=MIX_SEED, max_epochs=MIX_EPOCHS
    )


def op5_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixture(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return chosen.select("row.doc_id", "domain", "language", "origin", "n_tokens", F.col("epoch").cast("int").alias("epoch"))


def id_remainder(modulus: int):
    """crc32 of the id as text: the fixed fold of the learned queries. A row without an id is never learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(documents, documents, table(spark, sf_dir, "labels"), carry=["doc_id"]).select("row.doc_id", "score")
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(4) == 2, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_languages(table(spark, sf_dir, "documents"), id_remainder(5) != 0)
    found = identify_languages(table(spark, sf_dir, "documents"), model, carry=["doc_id"])
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", F.coalesce(id_remainder(5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score"
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "row.doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("secrets")).alias("spans"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), read_vocabulary(VOCABULARY), carry=["doc_id"])
    return counted.select("row.doc_id", "n_tokens")


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    definition = Path(public_tokenizers.path(WORD_TOKENIZER)).read_text(encoding="utf-8")
    packed = pack_documents(table(spark, sf_dir, "documents"), definition, SEQUENCE_TOKENS, carry=["doc_id"])
    return packed.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as a later reader finds them: where 7 divides the crc32 of the id as text, ``n_chars`` is one more."""
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    n_chars = F.when(id_remainder(7) == 0, one_more).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    manifest = merkle_manifest(table(spark, sf_dir, "documents"), found={"n_chars": n_chars})
    proof = F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256")
    return manifest.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_ngram_jaccard_join,
        op3_quality_rules,
        op4_benchmark_decontamination,
        op5_mixing_to_weights,
        op6_toxicity,
        op7_language_id,
        op8_secret_scans,
        op9_token_counts,
        op10_zip_warc,
        op11_best_fit_packing,
        op12_phrase_collocations,
        op13_merkle_manifest,
    )
}


def _op5_sql() -> str:
    def case(column: str, weights: dict[str, float]) -> str:
        return f"case {column} " + " ".join(f"when '{k}' then {v}" for k, v in weights.items()) + " else 1.0 end"

    def fill(nodes: str, parents: str) -> str:
        over = f"partition by {parents}" if parents else ""
        order = f"{over} order by cap / weight, name"
        return f"""
          select *, least(cap, weight * greatest(max(step) over ({over}), 0.0)) as share from (
            select *, (budget - coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0.0))
              / sum(weight) over ({order} rows between current row and unbounded following) as step from ({nodes}))"""

    return f"""
      with docs as (
        select doc_id, coalesce(lang, 'unknown') as language, coalesce(source, 'unknown') as origin,
          case when source is null then 'code' when right(source, 1) in ('0', '1', '2', '3', '4') then 'web'
            when right(source, 1) in ('5', '6', '7') then 'books' else 'code' end as domain,
          len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as n_tokens, text
        from documents),
      leaves as (
        select domain, language, origin, cast(sum(n_tokens) as bigint) as supply, {MIX_EPOCHS}.0 * sum(n_tokens) as cap
        from docs where n_tokens > 0 group by all),
      d as ({fill(f"select domain, domain as name, cast(sum(cap) as double) as cap, {case('domain', DOMAINS)} as weight, (select 0.5 * sum(supply) from leaves) as budget from leaves group by domain", "")}),
      l as ({fill(f"select domain, language, language as name, cast(sum(leaves.cap) as double) as cap, {case('language', LANGUAGES)} as weight, any_value(d.share) as budget from leaves join d using (domain) group by domain, language", "domain")}),
      s as ({fill("select domain, language, origin, origin as name, cast(leaves.cap as double) as cap, supply, 1.0 as weight, l.share as budget from leaves join l using (domain, language)", "domain, language")}),
      t as (select domain, language, origin, cast(floor(share + 1e-6) as bigint) as take, supply from s),
      o as (
        select docs.*, take // supply as epochs, take % supply as rest,
          ('0x' || left(md5('{MIX_SEED}:' || (take // supply) || ':' || doc_id), 8))::bigint as draw
        from docs join t using (domain, language, origin) where n_tokens > 0 and take > 0),
      c as (
        select *, epochs + cast(sum(n_tokens) over (partition by domain, language, origin order by draw, doc_id, md5(text)
          rows between unbounded preceding and current row) <= rest as bigint) as copies from o)
      select doc_id, domain, language, origin, cast(n_tokens as bigint) as n_tokens, cast(e as integer) as epoch
      from (select *, unnest(range(copies)) as e from c where copies > 0)"""


def _op10_sql() -> str:
    return """
      with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages),
      q as (select *, max(page_id) over (partition by digest) as best from p),
      alphabet as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as a)
      select page_id, cast(strlen(html) as bigint) as payload_bytes,
        list_aggregate([substr(a, 1 + cast((('0x' || substr(digest, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31 as integer), 1)
          for i in range(32)], 'string_agg', '') as payload_digest,
        case when page_id = best then 'response' else 'revisit' end as record_type,
        case when page_id = best then null else best end as refers_to
      from q, alphabet"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2_SQL = f"""
  with recursive
  words as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
  shingles as (
    select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
  sets as (select doc_id, count(*) as n, md5(string_agg(shingle, chr(10) order by shingle)) as content from shingles group by doc_id),
  classes as (select content, any_value(n) as n, min(doc_id) as first_id from sets group by content),
  members as (select first_id as class, n, shingle from classes join shingles on doc_id = first_id),
  links as (
    select a.class as x, b.class as y from members a join members b on a.shingle = b.shingle and a.class < b.class
    group by a.class, b.class, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
  reach as (
    select first_id as x, first_id as y from classes
    union
    select reach.x, case when reach.y = links.x then links.y else links.x end
    from reach join links on reach.y in (links.x, links.y)),
  lowest as (select x, min(y) as component_id from reach group by x)
  select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id
  from words left join sets using (doc_id) left join classes using (content, n) left join lowest on first_id = x"""

_OP4_SQL = f"""
  with docs as (
    select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
  items as (
    select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
  wanted as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i : i + 9], ' ') as words
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
  starts as (
    select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as words
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
          from docs cross join (select distinct size from wanted) sizes)),
  found as (select doc_id, i, size, item_id from starts join wanted using (size, words)),
  hits as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as place from found) group by doc_id),
  matched as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id)
  select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
  from docs left join hits using (doc_id) left join matched using (doc_id)"""


def _op13_sql() -> str:
    def tagged(column: str) -> str:
        return f"coalesce(strlen(cast({column} as varchar)) || ':' || cast({column} as varchar), '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(concat(" + ", ".join(map(tagged, ("doc_id", "source", "lang", n_chars, "text"))) + "))"

    crc32 = """xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(id)), lambda i: ord(id[i + 1])::bigint)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end))))"""

    def tree(nodes: str, leaves: str) -> str:
        return f"""{nodes}(level, branch, place, size, digest) as (
          select 0, branch, place, size, digest from {leaves}
          union all
          select level + 1, branch, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' order by place))
          from {nodes} where size > 1 group by level, branch, place // 2, size)"""

    def fold(name: str, start: str, nodes: str) -> str:
        return f"""{name}(id, subbranch, level, branch, place, size, digest, proof) as (
          {start}
          union all
          select id, subbranch, f.level + 1, f.branch, f.place // 2, (f.size + 1) // 2,
            case when f.place % 2 = 0 then sha256(f.digest || coalesce(s.digest, '')) else sha256(s.digest || f.digest) end,
            proof || coalesce(s.digest, '')
          from {name} f left join {nodes} s on s.level = f.level and s.branch = f.branch and s.place = xor(f.place, 1)
          where f.size > 1)"""

    return f"""
      with recursive
      rows as (
        select doc_id, coalesce(':' || lang, '-') as branch, {leaf("n_chars")} as digest,
          case when {crc32} % 7 = 0 then {leaf("n_chars + 1")} else {leaf("n_chars")} end as found
        from (select *, cast(doc_id as varchar) as id from documents)),
      leaves as (
        select *, row_number() over () as id, row_number() over (partition by branch order by doc_id nulls first, digest) - 1 as place,
          count(*) over (partition by branch) as size from rows),
      {tree("nodes", "leaves")},
      subroots as (select branch, digest from nodes where size = 1),
      ranked as (
        select branch as name, digest, '' as branch, row_number() over (order by branch) - 1 as place, count(*) over () as size from subroots),
      {tree("tops", "ranked")},
      root as (select digest from tops where size = 1),
      {fold("low", "select id, branch, 0, branch, place, size, found, '' from leaves", "nodes")},
      {fold("high", "select id, name, 0, r.branch, r.place, r.size, low.digest, proof from low join ranked r on r.name = subbranch where low.size = 1", "tops")}
      select doc_id, leaves.digest as leaf, subroots.digest as subroot, root.digest as root, sha256(proof) as proof_sha256,
        high.digest as folded_root, high.digest = root.digest as verified
      from high join leaves using (id) join subroots on subroots.branch = subbranch, root where high.size = 1"""


_OP12_SQL = f"""
  with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\\x0A-\\x0D]+')) as piece from documents),
  words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
  sizes as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
  found as (
    select lang, p as m, array_to_string(w[i : i + p - 1], ' ') as phrase
    from (select lang, w, p, unnest(range(1, len(w) - p + 2)) as i from words, (select unnest(range(1, 5)) as p) orders)),
  counts as (select lang, m, phrase, count(*) as f from found group by all having count(*) >= 30),
  candidates as (select *, string_split(phrase, ' ') as v from counts where m >= 2),
  cuts as (
    select c.lang, c.phrase, c.m, c.f as a, k, l.f as l, r.f as r, cast(2000000::hugeint * c.f // (l.f + r.f) as bigint) as score
    from (select *, unnest(range(1, m)) as k from candidates) c
    join counts l on l.lang = c.lang and l.phrase = array_to_string(v[: k], ' ')
    join counts r on r.lang = c.lang and r.phrase = array_to_string(v[k + 1 :], ' ')),
  scored as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
  inner_ as (
    select lang, array_to_string(v[i : i + p - 1], ' ') as phrase, max(f) as longer
    from (select lang, v, f, p, unnest(range(1, m - p + 2)) as i from candidates, (select unnest([2, 3]) as p) where p < m) group by all),
  kept as (
    select scored.* from scored left join inner_ using (lang, phrase) where 100::hugeint * coalesce(longer, 0) < 80::hugeint * a)
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from kept join sizes using (lang) qualify rank <= 2000"""


#: The others train a model, parse markup or text by rules of their own, or read a vocabulary file.
ORACLE: dict[str, str] = {
    "op2_ngram_jaccard_join": _OP2_SQL,
    "op4_benchmark_decontamination": _OP4_SQL,
    "op5_mixing_to_weights": _op5_sql(),
    "op10_zip_warc": _op10_sql(),
    "op12_phrase_collocations": _OP12_SQL,
    "op13_merkle_manifest": _op13_sql(),
}
