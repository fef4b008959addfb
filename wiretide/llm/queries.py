"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiretide.llm import (
    conversation_trie, cover_tree, interpolation, language_id, license_scan, mixing, near_duplicates, packing, periodic_runs, repetition,
    token_files, toxicity, url_filter,
)
from wiretide.llm.common import fold, id_crc32, read_table, ship_package
from wiretide.sources.storage import materialize, work_folder

WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op2_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    # Counting words is the only work on texts; what follows needs three narrow columns.
    sizes = materialize(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    taken = mixing.with_copies(sizes, "source", "doc_id", F.col("size"), "mix", "mix")
    return taken.select("doc_id", "size", "mix.source_size", "mix.target", (F.col("size") * F.col("mix.copies")).alias("taken"))


def op3_url_filter(spark, sf_dir):
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op4_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 5)
    model = language_id.fit(docs.filter(part != 0))
    found = language_id.identify(docs, model, part=part)
    return found.select("doc_id", (F.col("part") == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op5_cover_tree(spark, sf_dir):
    return cover_tree.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_repetition(spark, sf_dir):
    return repetition.judge(read_table(spark, sf_dir, "documents"))


def op7_token_files(spark, sf_dir):
    folder = work_folder(spark, "tokens")
    files = token_files.write_token_files(read_table(spark, sf_dir, "documents"), folder, tokenizer_path(BYTE_TOKENIZER))
    return token_files.read_token_files(spark, folder, files)


def op8_toxicity(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    part = fold(F.col("doc_id"), 5)
    model = toxicity.fit(docs.filter(part != 0), labels.filter(part != 0))
    found = toxicity.score(docs, model, part=part)
    return found.select("doc_id", (F.col("part") == 0).alias("held_out"), "score", "predicted")


def op9_near_duplicates(spark, sf_dir):
    # Two-word shingles, as this query's contract has them.
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)


def op10_interpolation(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    found = interpolation.score_documents(docs, fold(F.col("doc_id"), 7) != 2)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_license_scan(spark, sf_dir):
    return license_scan.scan_documents(read_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    # Every conversation takes up to five turns of the first one of its hundred.
    return conversation_trie.prefix_trie(turns, base=lambda c: c - c % 100, head=lambda c: id_crc32(c) % 6, most_head=5)


def op13_periodic_runs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    h = id_crc32(F.col("doc_id"))
    g = F.floor(h / 10)
    # A tenth of the texts gets a period planted, from a place and of a length that follow from the id.
    planted = periodic_runs.with_period(docs.select("doc_id", "text"), h % 10 == 0, lambda n: g % n, lambda n, a: 1 + F.floor((n - a) / (3 + g % 8)))
    return periodic_runs.summarize(planted)


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _with_package(f)
    for f in (
        op1_packing, op2_mixing, op3_url_filter, op4_language_id, op5_cover_tree, op6_repetition, op7_token_files,
        op8_toxicity, op9_near_duplicates, op10_interpolation, op11_license_scan, op12_conversation_trie, op13_periodic_runs,
    )
}
