"""Policy documents, question answering over them and structured look-ups."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions import text
from ..operators import enrich, retrieve
from . import fixed_values as fixed

Encoder = Callable[[list[str]], list[list[float]]]

# Fixed format: the sentence that describes a policy.
POLICY_DOCUMENT = (
    "Policy {number} is a {tier}-tier auto insurance policy in {state} with coverage limits "
    "of {csl} (CSL). It was bound on {bound} with a ${deductible} deductible and an annual "
    "premium of ${premium}. This policy has {umbrella}. It covers car {car} for customer "
    "{customer}."
)


def policy_text() -> Column:
    limit = F.col("umbrella_limit")
    umbrella = F.when(limit > 0, F.concat(F.lit("$"), text.thousands(limit),
                                          F.lit(" umbrella coverage"))
                      ).otherwise("no umbrella coverage")
    return text.template(
        POLICY_DOCUMENT,
        number=F.col("policy_number"), tier=F.col("policy_csl_tier"),
        state=F.col("policy_state"), csl=F.col("policy_csl"),
        bound=F.col("policy_bind_date"), deductible=text.thousands(F.col("policy_deductable")),
        premium=text.money(F.col("policy_annual_premium")), umbrella=umbrella,
        car=F.col("car_id"), customer=F.col("customer_id"))


def policy_documents(policies: DataFrame) -> DataFrame:
    return policies.select("policy_number", policy_text().alias("document"))


def embed(documents: DataFrame, text_column: str, encode: Encoder,
          output: str = "embedding") -> DataFrame:
    """Add an embedding column from a caller-supplied `encode(list[str]) -> list[list[float]]`.

    Runs on the executors in Arrow batches; the library ships no encoder. A NULL text has no
    vector.
    """
    @F.pandas_udf("array<float>")
    def encoded(texts: pd.Series) -> pd.Series:
        known = texts.dropna()
        vectors = [[float(x) for x in vector] for vector in encode(list(known))]
        return pd.Series(vectors, index=known.index, dtype=object).reindex(texts.index)

    return documents.withColumn(output, encoded(F.col(text_column)))


ANSWER_PROMPT = (
    "Answer from the policy passages below only and cite the policy numbers; say so if they "
    "do not contain the answer. Passages: {context} Question: {question}"
)


def answer(questions: DataFrame, documents: DataFrame, fn: enrich.Generator, model_name: str,
           embedding_model: str, k: int = fixed.TOP_K) -> DataFrame:
    """Retrieve, assemble context, generate an answer and log what was used, per question.

    `questions` has query_id, question, query_type, embedding; `documents` has policy_number,
    document, embedding. Output: the retrieval history table, for any number of questions.
    """
    hits = retrieve.topk_l2(
        questions.select("query_id", "embedding"),
        documents.select("policy_number", "embedding"), "query_id", "policy_number",
        "embedding", k)
    # k rows per question pick their texts; Spark broadcasts them if they are few.
    with_text = documents.select("policy_number", "document").join(hits, "policy_number")
    context = retrieve.assemble_context(
        with_text.withColumn("_label", F.concat(F.lit("Policy "), "policy_number")),
        "query_id", "_label", "document")
    log = retrieve.retrieval_log(hits, "query_id", "policy_number", fixed.SCORE_FORMAT)
    prepared = (
        questions.drop("embedding").join(log, "query_id").join(context, "query_id")
        .withColumnRenamed("retrieved_ids", "retrieved_policy_ids")
        .withColumn("embedding_model", F.lit(embedding_model))
        .withColumn("_prompt", text.template(ANSWER_PROMPT, context=F.col("context"),
                                             question=F.col("question")))
        .drop("context")
    )
    return enrich.generate(prepared, "_prompt", fn, model_name, output="answer",
                           error_prefix=fixed.ERROR_PREFIX)


# --------------------------------------------------- the question types as plain queries

def lookup_by_number(policies: DataFrame, number: int) -> DataFrame:
    return policies.where(F.col("policy_number") == number)


def top_premiums(policies: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
    return policies.select("policy_number", "policy_csl_tier", "policy_state",
                           "policy_annual_premium").orderBy(
        F.desc("policy_annual_premium"), "policy_number").limit(k)


def umbrella_in_state(policies: DataFrame, state: str) -> DataFrame:
    return policies.where((F.col("policy_state") == state) & (F.col("umbrella_limit") > 0)
                          ).select("policy_number", "policy_state", "umbrella_limit")


def with_deductible(policies: DataFrame, amount: int) -> DataFrame:
    return policies.where(F.col("policy_deductable") == amount).select(
        "policy_number", "policy_deductable", "policy_csl_tier")


def tier_by_state(policies: DataFrame, tier: str) -> DataFrame:
    return policies.where(F.col("policy_csl_tier") == tier).groupBy("policy_state").agg(
        m.rows().alias("policies"))
