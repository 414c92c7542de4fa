"""The corpus operators as queries over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import (
    conversation_trie,
    decontaminate,
    divergence,
    logbilinear,
    mil,
    mixing,
    multi_index,
    neardup,
    secrets,
    tokens,
    toxicity,
    warc,
    whitening,
)
from rosterlake.llm.common import Scratch, crc_mod, table
from rosterlake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def settings(spark: SparkSession) -> None:
    """Row batches that reach Python stay small however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def tokenizer_path() -> str:
    """Vocabulary file of the fixed tokenizer; a worker opens it where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_distribution_divergence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    references = divergence.references(docs, Scratch(spark, "references"))
    judged = divergence.judge(docs.select("doc_id", "text"), references)
    return judged.select("doc_id", *[f.name for f in divergence.ADDED])


@query
def op2_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counted = mixing.systematic_copies(docs, Scratch(spark, "mix"))
    return counted.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op4_token_orc(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "tokens")
    return tokens.round_trip(docs, scratch, tokenizer_path())


@query
def op6_secret_automaton(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


@query
def op9_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "neardup"))


@query
def op5_attention_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = mil.train(docs, labels, held_out)
    scored = mil.classify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op3_toxicity_channel(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, labels, held_out, Scratch(spark, "toxicity"))
    scored = toxicity.classify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_benchmark_leaks(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items, Scratch(spark, "leaks"))


@query
def op10_warc_archives(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return warc.round_trip(pages, Scratch(spark, "warc"))


@query
def op7_logbilinear(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 10) == 0
    return logbilinear.score_texts(docs, held_out, Scratch(spark, "logbilinear"))


@query
def op11_conversation_trie(spark, sf_dir):
    conversations, scratch = table(spark, sf_dir, "conversations"), Scratch(spark, "trie")
    placed, sizes = conversation_trie.numbered(conversation_trie.turns(conversations), scratch)
    path, lengths = conversation_trie.forked(placed, sizes)
    nodes, ends = conversation_trie.prefix_trie(path, lengths, scratch)
    return conversation_trie.described(nodes, ends)


@query
def op12_embedding_whitening(spark, sf_dir):
    return whitening.components(table(spark, sf_dir, "embeddings"), Scratch(spark, "whitening"))


@query
def op13_multi_index(spark, sf_dir):
    embeddings, scratch = table(spark, sf_dir, "embeddings"), Scratch(spark, "multi-index")
    return multi_index.neighbours(embeddings, scratch, F.col("vec_id") % 50 == 0)
