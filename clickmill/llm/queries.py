"""The registered queries of the operators, each over its whole table."""

from pyspark.sql import functions as F

from clickmill.llm import alignment, brown, decontamination, kmtree, mixing, oracle, packing, quality, rangejoin, sharding, simhash, sitetree, spelling, toxicity
from clickmill.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer() -> str:
    return tokenizer("word_bpe_49k.json")


def op1_quality(spark, sf_dir):
    return quality.rate_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_embedding_near_dup(spark, sf_dir):
    return rangejoin.near_duplicates(spark, table(spark, sf_dir, "embeddings"), least=0.93)


def op3_lm_scoring(spark, sf_dir):
    """Every seventh document, by CRC-32 of its id, is held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return brown.score(spark, docs, ~held_out).withColumn("held_out", held_out)


def op4_ann(spark, sf_dir):
    """Every hundredth vector, by its id, is a query."""
    return kmtree.search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_toxicity(spark, sf_dir):
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark, sf_dir):
    dealt = sharding.shard(spark, table(spark, sf_dir, "documents"), shards=8)
    return dealt.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_packing(spark, sf_dir):
    return packing.pack(spark, table(spark, sf_dir, "documents"), word_tokenizer(), capacity=4096, end_id=1)


def op8_mixing(spark, sf_dir):
    """position, position_2 and position_3 are the times of a document's copies, -1 for those not taken; sorted by the first."""
    plan = mixing.mix(spark, table(spark, sf_dir, "documents"), weights=(1, 2, 3), most_passes=3)
    names = ("position", "position_2", "position_3")
    times = [F.coalesce(F.get("positions", F.lit(i)), F.lit(-1.0)).alias(name) for i, name in enumerate(names)]
    return plan.select("*", *times).drop("positions").orderBy("position", "doc_id")


def op9_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(spark, docs, shingle_words=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_html(spark, sf_dir):
    return sitetree.extract(spark, table(spark, sf_dir, "pages"))


def op11_spelling(spark, sf_dir):
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op12_alignment(spark, sf_dir):
    sides = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return alignment.link_counts(spark, table(spark, sf_dir, "documents"), *sides, keep=["doc_id"]).select("row.doc_id", "*").drop("row")


def op13_decontamination(spark, sf_dir):
    found = decontamination.find(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_embedding_near_dup": op2_embedding_near_dup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_ann": op4_ann,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_html": op10_html,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL = {"op2_embedding_near_dup": oracle.NEAR_VECTORS, "op8_mixing": oracle.MIX, "op13_decontamination": oracle.LEAKS}
