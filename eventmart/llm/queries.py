"""The operators as queries over the given tables. Each returns the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import alignment, conversations, decontaminate, jaccard, language, licenses, lm, mixing, quality, secrets, suffixes, surrogates, toxicity
from eventmart.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    _QUERIES[run.__name__] = configured
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir), keep=["doc_id"])
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("secret_spans", lambda s: s["layer"] == 0)
    of_kind = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform(base, as_text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secret_spans", as_text), ",").alias("spans"),
        "n_layers",
        "n_left_packed",
    )


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = language.held_out(F.col("doc_id"), 3, 1)
    model = language.train(docs.filter(~out))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(_documents(spark, sf_dir), benchmark, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(_documents(spark, sf_dir))
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_slot")


@_query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(_documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 != 2, keep=["doc_id"])
    return scored.select("doc_id", *lm.RESULTS.fieldNames())


@_query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(_documents(spark, sf_dir), keep=["doc_id"]))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_letters", "rule_bits",
    )


@_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard.link(_documents(spark, sf_dir))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.cut_repeats(_documents(spark, sf_dir))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(_documents(spark, sf_dir), keep=["doc_id"])
    first = F.get("licenses", F.lit(0))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        first["license"].alias("license"),
        F.coalesce(first["score"], F.lit(0.0)).alias("score"),
        F.array_join(F.transform("licenses", lambda s: s["license"]), ",").alias("licenses"),
    )


# The key of the registered query. A user has a secret one.
SURROGATE_KEY = "corpus"


@_query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = surrogates.replace_personal_data(_documents(spark, sf_dir), SURROGATE_KEY, keep=["doc_id"])
    return rows.select("doc_id", "text", "n_entities", F.array_join("entity_kinds", ",").alias("entity_kinds"))


# Where the public vocabulary files are.
TOKENIZERS = "/opt/tokenizers"


@_query
def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    return alignment.align_tokens(_documents(spark, sf_dir), a, b, keep=["doc_id"], digest=True)


@_query
def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found, repaired = conversations.repair(conversations.damage(rows))
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    found = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    digests = conversations.digests(repaired)
    found = found.join(digests, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("_id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@_query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = language.held_out(F.col("doc_id"), 3, 1)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~out)
    model = toxicity.train(docs.filter(~out), labels)
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "score", "predicted")
