"""The queries of the operators and their SQL, for the registry of the library's driver."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    decontamination, exact_stream, fuzzy_lines, language_id, near_vectors, ngram_join, pieces, resampling, secret_scan,
    surrogates, token_counts, tool_links, vector_codes,
)
from larder.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.fit_language_model(docs.filter(~held_out))
    return language_id.identify_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))

    def line(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    order = F.create_map(*[F.lit(x) for k, kind in enumerate(secret_scan.KINDS) for x in (kind, k)])
    every = F.transform(F.array_sort(F.transform(F.concat("base", "lexed"), lambda x: F.struct(
        x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(line(F.col("base")).cast("binary"), 256).alias("base_sha256"), line(every).alias("spans"),
                        F.size("lexed").cast("long").alias("n_lexed"))


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, b"key of the check run")


@query
def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


#: The tool that the turns of the conversations are read as calls of.
REPLY = {"type": "object", "required": ["text", "words"], "additionalProperties": False, "properties": {
    "text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 3, "maximum": 60}, "after": {"type": "string"}}}


@query
def op6_tool_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn is a call of a tool that replies, and refers to the call two turns before; the assistant's
    next turn is its result."""
    turns = table(spark, folder, "conversations")

    def ident(back: int):
        return F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))

    place = F.xxhash64("text").alias("place")
    arguments = F.to_json(F.struct(
        F.coalesce("text", F.lit("")).alias("text"), F.size(F.split("text", " ")).alias("words"),
        F.when(F.col("turn") >= 2, F.struct(ident(2).alias("$ref"))).alias("after")))
    calls = turns.filter("role = 'user'").select("conv_id", "turn", place, ident(0).alias("call_id"),
                                                 F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = turns.filter("role = 'assistant'").select("conv_id", "turn", place, ident(1).alias("call_id"),
                                                        F.col("text").alias("content"))
    return tool_links.link_tool_calls(turns.filter("role IS NULL OR role NOT IN ('user', 'assistant')"), calls, results, {"reply": REPLY})


@query
def op7_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs, counts=True)


@query
def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, folder, "documents"))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


@query
def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.vector_links(table(spark, folder, "embeddings"))


@query
def op11_exact_stream(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_stream.exact_duplicates(spark, f"{folder}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vector_codes.compress_vectors(table(spark, folder, "embeddings"))
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return vector_codes.label_errors(coded).select("vec_id", digits.alias("code"), "error", "label_error",
                                                   F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"))
