"""Mixing sources to target weights, measured in tokens of a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from panelloom.functions import text as T
from panelloom.operators.ranking import running_totals
from panelloom.runtime import bounded, materialise, pick

#: A byte-level BPE of a public tokenizer (base64 token and rank per line), which lies outside of the repository.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that tokenizer splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_count(path: str = TOKENIZER):
    """A function of a text column: its number of tokens; null and empty texts have 0. The vocabulary is read once per worker."""

    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("mix", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


def sized(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, seed: int = 42) -> DataFrame:
    """(doc_id, source, order_key, n_tokens) of the documents whose source has a target and whose text has a token.

    The hash-random order key depends on doc_id and seed alone, so it is the same on every run and in every partition.
    Written once to the shared folder: tokens are counted once.
    """
    wanted = bounded(clean_targets(targets).select("source"))
    docs = pick(documents, "doc_id", "source", "text").select("doc_id", T.source_key(F.col("source")).alias("source"), "text").join(wanted, "source", "left_semi")
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "source", key.alias("order_key"), token_count(path)(F.col("text")).alias("n_tokens"))
    return materialise(rows, "sized").where("n_tokens > 0")


def clean_targets(targets: DataFrame) -> DataFrame:
    """Targets by normalised source; repeated sources add up, and the largest repeat cap holds. Shares of 0 or less are left out."""
    rows = pick(targets, "source", "target_share", "max_repeats").select(T.source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("bigint").alias("max_repeats"))
    return rows.where("source is not null and target_share > 0").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.greatest(F.max("max_repeats"), F.lit(0)).alias("max_repeats")
    )


def budgets(docs: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Per target source: tokens available, its exact budget, whole epochs and the tokens of the last, partial epoch.

    Sources without documents have no budget, and their share is spread over the others in proportion. Without a given
    ``total`` the mix is the largest in which no present source needs more than ``max_repeats`` epochs; with one, a budget
    beyond the cap is cut to it, so the source falls short and the report shows it.
    """
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n_docs"))
    rows = clean_targets(targets).join(have, "source", "left").fillna(0, ["available", "n_docs"])
    present = (F.col("available") > 0) & (F.col("max_repeats") > 0)
    bound = rows.where(present).agg(
        F.sum("target_share").alias("present"), F.min(F.col("available") * F.col("max_repeats") / F.col("target_share")).alias("most")
    ).first()
    whole = F.lit(bound.present).cast("double")
    share = F.when(present, F.col("target_share") / whole)
    size = F.lit(float(total)) if total is not None else F.lit(bound.most).cast("double") * whole
    cap = F.col("available") * F.col("max_repeats")
    budget = F.coalesce(F.least(F.floor(share * size + 1e-6), cap), F.lit(0)).cast("bigint")
    out = rows.withColumn("share_among_present", share).withColumn("budget", budget)
    epochs = F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(0)
    return out.select(
        "source", "target_share", "max_repeats", "n_docs", "available", "share_among_present", "budget", epochs.alias("epochs"),
        (F.col("budget") - epochs * F.col("available")).alias("rest"),
    )


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str = TOKENIZER, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, order_key, repeats): every document of the mix and how often it is taken.

    Documents are range-sorted within their source by a hash-random key and distributed prefix sums of their tokens are cut
    at the budget: whole epochs take all, the last epoch the documents whose prefix still fits. A source therefore misses
    its budget by less than one document, and is never over it. A source with a third of all documents is spread over
    many tasks. Null or empty texts and sources without a target are not in the mix.
    """
    docs = sized(documents, targets, path, seed)
    return _cut(docs, materialise(budgets(docs, targets, total), "budgets"))


def _cut(docs: DataFrame, plan: DataFrame) -> DataFrame:
    placed = running_totals(docs, ["source"], ["order_key", "doc_id"], F.col("n_tokens"))
    last = (F.col("before") + F.col("n_tokens") <= F.col("rest")).cast("bigint")
    rows = placed.join(bounded(plan.select("source", "epochs", "rest")), "source").withColumn("repeats", F.col("epochs") + last)
    return rows.where("repeats > 0").select("doc_id", "source", "n_tokens", "order_key", "repeats")


def shares(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str = TOKENIZER, seed: int = 42) -> DataFrame:
    """One row per target: the share wanted and reached, tokens and documents used, and the most repeats of a document."""
    docs = sized(documents, targets, path, seed)
    plan = materialise(budgets(docs, targets, total), "budgets")
    used = _cut(docs, plan).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("docs_used"), F.max("repeats").alias("most_repeats")
    )
    rows = plan.join(used, "source", "left").fillna(0, ["tokens", "docs_used", "most_repeats"])
    rows = materialise(rows, "shares")
    whole = F.lit(rows.agg(F.sum("tokens")).first()[0]).cast("bigint")
    return rows.select(
        "source", "target_share", "share_among_present", F.try_divide("tokens", whole).alias("reached_share"), "max_repeats", "most_repeats",
        "n_docs", "docs_used", "available", "budget", "tokens",
    )
