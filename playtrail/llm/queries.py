"""One query per operator over its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from . import attribution, brown, centroids, decontamination, jaccard, mixing, neighbours, pii, prefix_trie, quality, token_store, toxicity, transcripts
from .common import table
from .registry import query


@query("op7_mix", mixing.ORACLE_SQL)
def op7_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op1_pii")
def op1_pii(spark, sf_dir):
    return pii.detect(table(spark, sf_dir, "documents"))


@query("op10_neighbours", neighbours.ORACLE_SQL)
def op10_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.where(F.col("vec_id") % 50 == 0), vectors)


@query("op6_quality")
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op3_jaccard", jaccard.ORACLE_SQL)
def op3_jaccard(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op9_decontaminate")
def op9_decontaminate(spark, sf_dir):
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_brown")
def op2_brown(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return brown.score(docs, *brown.fit(docs))


@query("op4_tokens")
def op4_tokens(spark, sf_dir):
    return attribution.token_counts(table(spark, sf_dir, "documents"))


@query("op5_transcripts")
def op5_transcripts(spark, sf_dir):
    """Roles are hidden, transcripts are marked in several ways, and the recovered roles are held against the given."""
    chats = table(spark, sf_dir, "conversations")
    raw = transcripts.raw_transcripts(chats)
    return transcripts.summary(transcripts.parse(raw, transcripts.fit(raw)), chats.select("conv_id", "turn", "role"))


@query("op11_prefix_trie", prefix_trie.ORACLE_SQL)
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.regrouped(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


@query("op12_centroids", centroids.ORACLE_SQL)
def op12_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_token_store")
def op13_token_store(spark, sf_dir):
    from public_tokenizers import path
    return token_store.digests(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
