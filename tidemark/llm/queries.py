"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (ann, context_tree, decontaminate, divergence, langid, licenses, line_dedup, merkle, mixing,
                          ngram_join, pii, token_counts, warc)
from tidemark.llm.oracles import ORACLE

#: Vocabulary file of the token counts.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_classes(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


@query
def op2_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.match_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13)
    n_hit = decontaminate.hit_words(F.col("spans"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        decontaminate.over_limit(n_hit, F.col("n_words"), 5).alias("contaminated"))


@query
def op3_personal_data(spark, sf_dir):
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    count = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *count, F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


@query
def op4_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    return langid.identify(docs, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op5_license_scan(spark, sf_dir):
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    labels = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    covered = licenses.covered_words(F.col("matches"))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(0.0).alias("score"),
        labels(F.filter("matches", lambda m: m["whole"])).alias("whole_texts"))


@query
def op6_warc_archives(spark, sf_dir):
    return warc.capture_history(_table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_source_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_token_counts(spark, sf_dir):
    with open(VOCABULARY, "rb") as f:
        raw = f.read()
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), token_counts.read_pieces(raw), token_counts.word_end(raw))


@query
def op9_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed_col="n_removed")


@query
def op10_nearest_neighbours(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


@query
def op12_lm_score(spark, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    scored = context_tree.score_texts(_table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_merkle_manifest(spark, sf_dir):
    proved = merkle.audit(_table(spark, sf_dir, "documents"),
                          F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def catalog() -> tuple[dict, dict]:
    import corpus_pipeline

    oracle = dict(ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        oracle["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(QUERIES), oracle
