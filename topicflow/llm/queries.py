"""The operators' registered queries, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .common import ascii_lower, id_remainder, workspace
from .embed_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .line_dedup import line_dedup
from .lm_score import lm_scores
from .mixing import mix_sources
from .pii import listed, pii_spans
from .quality import fit_quality, quality_score
from .simhash import simhash_components
from .token_files import read_tokens, write_tokens
from .url_rules import judge_urls, mine_rules
from .variants import spelling_variants
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scores(docs, id_remainder(F.col("doc_id"), 7) != 2, public_tokenizers.path("word_bpe_49k.json"))
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _table(spark, sf_dir, "pages").select("page_id", "url"), _table(spark, sf_dir, "labels")
    return judge_urls(pages, mine_rules(pages, labels, exact=True))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "token-files")
    write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_tokens(spark, path, derive={"ids_crc32": F.crc32("ids")})


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words cut, runs cut, and the SHA-256 of the text that is left."""
    cut = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "removed_words", "removed_runs", F.sha2("text", 256).alias("text_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = encode_documents(_table(spark, sf_dir, "documents"), path, decode=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = fit_quality(docs, labels.filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_sha256", F.sha2(ascii_lower(F.col("text")), 256))
    return exact_dedup(docs, carry=["text_sha256"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "documents").select("doc_id", pii_spans(F.coalesce("text", F.lit(""))).alias("found"))
    base = F.filter("found", lambda s: s["base"])
    of_kind = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(of_kind, k))).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"), typos=97)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_score": op1_lm_score,
        "op2_url_rules": op2_url_rules,
        "op3_mixing": op3_mixing,
        "op4_token_files": op4_token_files,
        "op5_simhash": op5_simhash,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_line_dedup": op7_line_dedup,
        "op8_bpe": op8_bpe,
        "op9_quality": op9_quality,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_pii": op11_pii,
        "op12_variants": op12_variants,
        "op13_whitening": op13_whitening,
    }


_MIXING_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, '')) as k
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as r
  from sized group by source),
weighted as (
  select *, [5.0, 2.0, 1.0][(r % 3 + 1)::int]::double as w, source_size * 3.0::double as cap from sources),
levels as (
  select *, cap / w as ratio,
         ((sum(source_size) over ())::double - coalesce(sum(cap) over (order by cap / w, r rows between unbounded preceding and 1 preceding), 0))
         / (sum(w) over () - coalesce(sum(w) over (order by cap / w, r rows between unbounded preceding and 1 preceding), 0)) as level
  from weighted),
targets as (
  select source, source_size,
         least(cap, coalesce((select arg_min(level, (ratio, r)) from levels where level <= ratio) * w, cap))::double as target
  from levels),
placed as (
  select s.doc_id, s.size, t.source_size, t.target,
         case when source_size > 0 then floor(t.target / t.source_size) else 1 end as epochs,
         coalesce(sum(s.size) over (partition by s.source order by s.k, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (size * (epochs + case when source_size > 0 and target - epochs * source_size > 0
                                   and before + size / 2 <= target - epochs * source_size then 1 else 0 end))::bigint as taken
from placed
"""

_EXACT_SQL = """
with n as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from max(doc_id) over w as kept, text_sha256
from n window w as (partition by text_sha256)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": _MIXING_SQL, "op10_exact_dedup": _EXACT_SQL}
