"""The operators' queries on the given tables, and their SQL where SQL can say what they return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.llm import (
    alignment,
    chat,
    fim,
    line_dedup,
    mixing,
    neighbours,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    url_filters,
)
from dryspell.shipping import ship

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TARGETS = mixing.Targets(
    source={"src0": 0.2, **{f"src{k}": 0.04 for k in range(1, 20)}},
    lang={"en": 0.6, "de": 0.13, "fr": 0.13, "es": 0.12},
    topic={"prose": 0.8, "record": 0.06, "table": 0.05, "markup": 0.05, "note": 0.03},
)
RATE = 0.5

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), TARGETS, RATE)
    return mixed.select("doc_id", "topic", "n_tokens", "keep_rate", "kept")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(table(spark, sf_dir, "documents"), VOCABULARY))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links"
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    known = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 3 != 1, F.lit(False))
    shown = turns.withColumn("shown", chat.transcript_text(
        F.col("role"), F.coalesce("text", F.lit("")), F.col("conv_id"), F.col("turn")
    ))
    model = chat.train(shown.where(known), "conv_id", "turn", "shown", "role")
    found = chat.parse(shown, model, "conv_id", "turn", "shown")
    return found.select(
        "conv_id", "turn", (~known).alias("held_out"), "role", "found_role",
        F.sha2("turn_text", 256).alias("turn_sha256"),
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return lines.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "found")).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, field).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "content_share", "kept",
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_packing, op3_quality_classifier, op4_ngram_join, op5_url_filters,
        op6_chat, op7_neighbours, op8_line_dedup, op9_pii, op10_quality_rules,
        op11_fill_in_middle, op12_alignment, op13_suffix_dedup,
    )
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}', '{h}{p}')" for h, p, v in RULES)

ORACLES: dict[str, str] = {
    "op5_url_filters": f"""
with rules(rhost, rpath, rverdict, rtext) as (values {_RULE_ROWS}),
p as (
  select row_number() over () as id, page_id,
    case when contains(url, '://')
      then translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{url_filters.UPPER}', '{url_filters.LOWER}')
      else '' end as host,
    case when contains(url, '://') then regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') else '' end as path
  from pages
),
best as (
  select p.id, arg_max(rtext, length(rtext)) as rule, arg_max(rverdict, length(rtext)) as rverdict
  from p join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by p.id
)
select page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict from p left join best using (id)
""",
    "op8_line_dedup": f"""
with d as (select row_number() over () as id, doc_id, coalesce(text, '') as text from documents),
l as (
  select id, doc_id, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as pos
  from d
),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{url_filters.UPPER}', '{url_filters.LOWER}') as key
  from l
),
r as (
  select key, min(doc_id) as keeper from k where length(key) >= 10 and doc_id is not null
  group by key having count(distinct doc_id) >= 2
),
m as (select k.*, coalesce(k.doc_id > r.keeper, false) as gone from k left join r using (key))
select min(doc_id) as doc_id, count(*) as n_lines,
  cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by id
""",
    "op11_fill_in_middle": """
with d as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
),
u as (
  select *, cast('0x' || substring(h, 1, 8) as bigint) % (n + 1) as c1,
    cast('0x' || substring(h, 9, 8) as bigint) % (n + 1) as c2,
    cast('0x' || substring(h, 17, 8) as bigint) % 100 as whole, cast('0x' || substring(h, 25, 8) as bigint) % 100 as turned
  from d
),
f as (
  select *, least(c1, c2) as a, greatest(c1, c2) as b,
    case when n = 0 or whole >= 90 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when turned < 20 then 'spm' else 'psm' end as form
  from u
),
p as (
  select *, substring(text, 1, a) as pre, substring(text, a + 1, b - a) as mid, substring(text, b + 1, n - b) as suf from f
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
  case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(case form when 'plain' then text else pre || mid || suf end) as restored_sha256
from p
""",
}
