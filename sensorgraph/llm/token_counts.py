"""Exact token-length histogram and the answers its running sums give for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.operators.storage import stored

#: Lengths are summed in blocks of this width first, so that no task orders all lengths.
BLOCK = 1024


def _encoder(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Documents per encoded length: ``length``, ``n_docs``.

    Null and empty texts have length 0; repeated rows count each time; an empty table gives no row. ``vocabulary`` is
    the path of a byte-level rank file (default: the 50k file of the public tokenizers), present on all executors.
    Each task sends one row per length it met, so the shuffle does not grow with the documents' text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = _encoder(vocabulary), {}
        for batch in batches:
            for text in batch.column(0):
                length = len(encoder.encode_ordinary(text.as_py() or ""))
                found[length] = found.get(length, 0) + 1
        yield pa.record_batch([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["length", "n_docs"])

    small_batches(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "length long, n_docs long")
    # Written, because every use of the sums reads it twice and the texts should be encoded once.
    return stored(counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs")), "length-histogram")


def length_sums(histogram: DataFrame) -> DataFrame:
    """Running sums of a histogram, one row per length.

    ``docs_at_least``, ``tokens_at_least`` (suffix sums, the length included), ``docs_below``, ``tokens_below``,
    ``truncated_tokens`` (all documents cut to the row's length), ``share_at_most``. The sums over the lengths run in
    two levels: a window over block totals (longest length / 1024 rows), then one per block.
    """
    tokens = F.col("length") * F.col("n_docs")
    block = F.floor(F.col("length") / BLOCK)
    blocks = histogram.groupBy(block.alias("__block")).agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "__block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in "dt"],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"],
    )
    within = Window.partitionBy("__block").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    rows = histogram.withColumn("__block", block).join(blocks, "__block")
    below_docs = F.col("d_before") + F.coalesce(F.sum("n_docs").over(within), F.lit(0))
    below_tokens = F.col("t_before") + F.coalesce(F.sum(tokens).over(within), F.lit(0))
    summed = rows.select("*", below_docs.alias("docs_below"), below_tokens.alias("tokens_below"))
    at_least = F.col("d_all") - F.col("docs_below")
    return summed.select(
        "length",
        "n_docs",
        tokens.alias("n_tokens"),
        "docs_below",
        "tokens_below",
        at_least.alias("docs_at_least"),
        (F.col("t_all") - F.col("tokens_below")).alias("tokens_at_least"),
        (F.col("tokens_below") + F.col("length") * at_least).alias("truncated_tokens"),
        ((F.col("docs_below") + F.col("n_docs")) / F.col("d_all")).alias("share_at_most"),
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Tokens left when every document is cut to ``limit``, and the documents cut: one row per limit.

    The row of the first length at or above the limit holds all that is needed; above the longest document nothing
    is cut. An empty table gives zeros.
    """
    found = sums.agg(
        F.max(F.struct("length", (F.col("tokens_below") + F.col("n_tokens")).alias("t"))).alias("last"),
        *[
            F.min(F.when(F.col("length") >= n, F.struct("length", "tokens_below", "docs_at_least", "n_docs"))).alias(f"l{n}")
            for n in limits
        ],
    )
    answers = [
        F.struct(
            F.lit(int(n)).alias("limit"),
            F.coalesce(F.col(f"l{n}.tokens_below") + n * F.col(f"l{n}.docs_at_least"), F.col("last.t"), F.lit(0)).alias("tokens"),
            F.coalesce(
                F.col(f"l{n}.docs_at_least") - F.when(F.col(f"l{n}.length") == n, F.col(f"l{n}.n_docs")).otherwise(0), F.lit(0)
            ).alias("docs_cut"),
        )
        for n in limits
    ]
    return found.select(F.inline(F.array(*answers)))


def length_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least a share of the documents does not exceed, one row per share."""
    found = sums.agg(*[F.min(F.when(F.col("share_at_most") >= q, F.col("length"))).alias(f"q{k}") for k, q in enumerate(shares)])
    return found.select(
        F.inline(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{k}").alias("length")) for k, q in enumerate(shares)]))
    )


