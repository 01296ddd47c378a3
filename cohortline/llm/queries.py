"""The registered queries of the operators and their expected results in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.align_tokens import align_tokens
from cohortline.llm.common import table
from cohortline.llm.decontaminate import contaminated
from cohortline.llm.exact_dedup import exact_dedup
from cohortline.llm.html_tree import extract
from cohortline.llm.licences import scan_licences
from cohortline.llm.matched_packing import pack_matched
from cohortline.llm.packing import pack_documents
from cohortline.llm.prefix_trie import ordered_turns, prefix_trie, shared_heads, with_ends
from cohortline.llm.quality import classify, train_quality
from cohortline.llm.secrets import find_secrets
from cohortline.llm.simhash import near_duplicates
from cohortline.llm.suffix_dedup import remove_repeats
from cohortline.llm.token_files import read_tokens, write_tokens
from cohortline.llm.tokens import vocabulary
from cohortline.sources.shared import new_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the row that stays of its group of equal texts. Odd rows: see `exact_dedup`."""
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def held_out(doc_id: Column | str) -> Column:
    """Rows that no model may learn from."""
    return F.crc32(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))) % 4 == 2


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with what repeats in it. Odd rows: see `remove_repeats`."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens. Odd rows: see `pack_documents`."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source and language are the directories."""
    part = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", part("source"), part("lang"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan_licences(docs.withColumn("path", path))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they come back from token files. Odd rows: see `write_tokens` and `read_tokens`."""
    folder = new_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary())
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its secrets. Odd rows: see `find_secrets`."""
    return find_secrets(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its score, by a model of the labels that are not held out. Odd rows: see `train_quality` and `classify`."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_quality(docs, labels.filter(~held_out("doc_id")))
    return classify(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its fingerprint and component. Odd rows: see `near_duplicates`."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page with its main text. Odd rows: see `extract`."""
    return extract(table(spark, sf_dir, "pages"))


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the links of its tokens. Odd rows: see `align_tokens`."""
    return align_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_matched_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. Odd rows: see `pack_matched`."""
    pieces = pack_matched(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin like the first of their hundred, and the trie of all their prefixes."""
    convs, turns = shared_heads(ordered_turns(table(spark, sf_dir, "conversations")))
    return with_ends(prefix_trie(convs, turns)).drop("key_a", "key_b")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_exact_dedup, op2_suffix_dedup, op3_packing, op4_decontaminate, op5_licences, op6_token_files, op7_secrets, op8_quality,
        op9_simhash, op10_html, op11_align_tokens, op12_matched_packing, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL}


OP1_SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
       row_number() over w = 1 as kept, text_sha256
from t
window w as (partition by text_sha256 order by chars desc, doc_id nulls last)
"""
