"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gableboard.llm import (chat, conversation_repair, credentials, decontaminate, jaccard, language_id, packing, page_diff, phrase_mining,
                            suffix_tree, topk, toxicity, url_rules)
from gableboard.llm.tables import id_remainder, read


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = language_id.fit(docs.filter(~held_out))
    found = language_id.predict(docs, model, keep=["doc_id", held_out.alias("held_out")])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(read(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(read(spark, folder, "documents"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.extract(read(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.hits(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents")).drop("ids")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score(docs, model, keep=["doc_id", held_out.alias("held_out")])


def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_tree.score(read(spark, folder, "documents"), id_remainder("doc_id", 7) != 2)
    return found.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.scan(read(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(credentials.joined(F.col("strong")), 256).alias("base_sha256"),
                        credentials.joined(F.col("all")).alias("spans"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    # The contract's own conversation.
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    done = chat.formatted(turns.unionByName(more))
    read_back = done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                            chat.under_mask(F.col("formatted"), F.col("mask")).alias("loss"))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read_back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                            F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
                            F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                            F.length("formatted").cast("long").alias("formatted_chars"))


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage: by the hash of `conv_id:turn`, rows are dropped, emptied, stripped of stops, repeated or made the user's."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(known("role")).alias("role")
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text")).alias("text")
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.filter(kind != 0).select("conv_id", "turn", role, text, copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations")
    return conversation_repair.repair(damaged(turns), turns)


def op12_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.collocations(phrase_mining.frequencies(read(spark, folder, "documents")))


#: The contract's rules: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.filtered(read(spark, folder, "pages"), URL_RULES)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}
