"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources alike) and 1 (as they
are), normalised. The exponent is bisected: the flattest mix whose most repeated source stays within a repetition
limit, or the mix of a target entropy. The weights are realised within a token budget: a source's quota is as many whole
passes over its documents as fit, and a part of one more pass. Each pass is a permutation of blocks, and of the
documents in a block; the part ends where the quota does. Blocks are shares of a source by a hash, so the one source
that holds a third of all rows is spread like the others, and only a single block of a source is ever put in order.
"""

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazelake.llm.common import WORD, checkpointed, hinted, on_plain_names, only

#: Blocks of a source; at most one of them is put in order document by document.
BLOCKS = 1024
#: Limit of the registered query and of the pipeline.
MAX_REPETITION = 1.25
#: Halvings of the interval of the exponent.
STEPS = 30
SEED = "mix"


def _key(source: Column) -> Column:
    """Text key of a source; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _permuted(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` with tokens and the two keys that order a pass: of the block, then of the document in it."""
    doc_key = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    block = F.conv(F.substring("_doc_key", 1, 8), 16, 10).cast("long") % blocks
    return (
        docs.withColumn("_tokens", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"))
        .withColumn("_source", _key(F.col("source")))
        .withColumn("_doc_key", doc_key)
        .withColumn("_block_key", F.md5(F.concat_ws("|", F.lit(SEED), F.col("_source"), block.cast("string"))))
    )


def _exponent(shares: DataFrame, meets) -> float:
    """Smallest exponent of [0, 1] that ``meets`` accepts, to 2**-STEPS; 1 if none does.

    ``meets(row)`` gets the sums over all sources of ``share**exponent`` (``total``), the largest
    ``share**exponent / share`` (``most``) and the sum of ``share**exponent * exponent * ln(share)`` (``drift``).
    """

    def tried(exponent: float) -> bool:
        raised = F.pow("share", F.lit(exponent))
        row = shares.agg(
            F.sum(raised).alias("total"),
            F.max(raised / F.col("share")).alias("most"),
            F.sum(raised * exponent * F.ln("share")).alias("drift"),
        ).first()
        return meets(row)

    if tried(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if tried(middle) else (middle, high)
    return high


def source_plan(
    docs: DataFrame,
    budget: int | None = None,
    max_repetition: float | None = MAX_REPETITION,
    target_entropy: float | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row per source with tokens: ``_source, weight, passes, last_block, last_doc``.

    ``budget`` is in tokens, all tokens there are by default. With ``target_entropy`` (in nats) the exponent is the
    smallest whose mix has at most that entropy, else the smallest that repeats no source more than
    ``max_repetition`` times. A document is taken ``passes`` times, and once more if its block comes before
    ``last_block``, or is that block and its own key is not after ``last_doc``.
    """
    rows = _permuted(only(docs, "doc_id", "text", "source"), blocks).where("_tokens > 0")
    rows = rows.select("_source", "_block_key", "_doc_key", "_tokens")
    by_block = checkpointed(rows.groupBy("_source", "_block_key").agg(F.sum("_tokens").alias("n")))
    everything = by_block.agg(F.sum("n")).first()[0] or 0
    budget = everything if budget is None else budget
    sizes = by_block.groupBy("_source").agg(F.sum("n").alias("all"))
    shares = checkpointed(sizes.withColumn("share", F.col("all") / F.lit(float(max(everything, 1)))))
    if not everything:
        exponent, total = 1.0, 1.0
    else:
        if target_entropy is not None:
            exponent = _exponent(
                shares, lambda r: log(r["total"]) - r["drift"] / r["total"] <= target_entropy
            )
        else:
            exponent = _exponent(shares, lambda r: r["most"] / r["total"] * budget / everything <= max_repetition)
        total = shares.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0]
    quota = F.floor(F.col("weight") * F.lit(float(budget))).cast("long")
    sources = (
        shares.withColumn("weight", F.pow("share", F.lit(exponent)) / F.lit(float(total)))
        .withColumn("passes", F.floor(quota / F.col("all")).cast("long"))
        .withColumn("rest", quota - F.col("passes") * F.col("all"))
    )
    in_order = Window.partitionBy("_source").orderBy("_block_key")
    last = (
        by_block.withColumn("through", F.sum("n").over(in_order))
        .join(sources, "_source")
        .where(F.col("through") > F.col("rest"))
        .groupBy("_source", "weight", "passes", "rest")
        .agg(F.min(F.struct("_block_key", (F.col("through") - F.col("n")).alias("before"))).alias("last"))
        .select("_source", "weight", "passes", "rest", "last.before", F.col("last._block_key").alias("last_block"))
    )
    last = checkpointed(last)
    ends = last.select(F.col("_source"), F.col("last_block").alias("_block_key"), "before", "rest")
    in_block = Window.partitionBy("_source").orderBy("_doc_key")
    last_doc = (
        rows.join(hinted(ends), ["_source", "_block_key"])
        .groupBy("_source", "_doc_key", "before", "rest")
        .agg(F.sum("_tokens").alias("n"))
        .withColumn("through", F.col("before") + F.sum("n").over(in_block))
        .where(F.col("through") <= F.col("rest"))
        .groupBy("_source")
        .agg(F.max("_doc_key").alias("last_doc"))
    )
    plan = last.join(last_doc, "_source", "left")
    return checkpointed(
        plan.select("_source", "weight", "passes", "last_block", F.coalesce("last_doc", F.lit("")).alias("last_doc"))
    )


def with_copies(docs: DataFrame, plan: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with ``n_tokens``, ``weight`` and ``copies``, how often the mix takes the document.

    Rows with one id in one source are taken alike. Documents without tokens are taken 0 times, and the weight of a source
    without tokens is 0. Columns of these names that ``docs`` has already are replaced.
    """
    rows = _permuted(docs.drop("n_tokens", "weight", "copies"), blocks).join(hinted(plan), "_source", "left")
    partly = (F.col("_block_key") < F.col("last_block")) | (
        (F.col("_block_key") == F.col("last_block")) & (F.col("_doc_key") <= F.col("last_doc"))
    )
    copies = F.when(F.col("_tokens") > 0, F.col("passes") + F.coalesce(partly, F.lit(False)).cast("long"))
    return (
        rows.withColumn("n_tokens", F.col("_tokens"))
        .withColumn("weight", F.coalesce("weight", F.lit(0.0)))
        .withColumn("copies", F.coalesce(copies, F.lit(0)).cast("long"))
        .drop("_tokens", "_source", "_doc_key", "_block_key", "passes", "last_block", "last_doc")
    )


def mixed(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, otherwise unchanged; further columns may have any names."""

    def taken(rows: DataFrame) -> DataFrame:
        copies = with_copies(rows, source_plan(rows, **limits), limits.get("blocks", BLOCKS)).where("copies > 0")
        return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))

    return on_plain_names(docs, ("doc_id", "text", "source"), taken)


def mixing_plan(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, weight, copies`` of every row of ``docs(doc_id, text, source, …)``."""
    rows = only(docs, "doc_id", "text", "source")
    return with_copies(rows, source_plan(rows)).select(
        "doc_id", "source", "n_tokens", F.round("weight", 6).alias("weight"), "copies"
    )


MIXING_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS k, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS doc_key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n
  FROM documents
), p AS (
  SELECT *, md5('{SEED}|' || k || '|' || (('0x' || substr(doc_key, 1, 8))::BIGINT % {BLOCKS})::VARCHAR) AS block_key FROM d
), sizes AS (
  SELECT k, sum(n)::BIGINT AS every FROM p WHERE n > 0 GROUP BY k
), shares AS (
  SELECT k, every, every / (SELECT sum(every) FROM sizes)::DOUBLE AS share FROM sizes
), alls AS (
  SELECT list(share) AS s FROM shares
), halves AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM alls
  UNION ALL
  SELECT step + 1,
    CASE WHEN list_max(list_transform(s, lambda x: pow(x, (low + high) / 2) / x))
      / list_sum(list_transform(s, lambda x: pow(x, (low + high) / 2))) <= {MAX_REPETITION} THEN low ELSE (low + high) / 2 END,
    CASE WHEN list_max(list_transform(s, lambda x: pow(x, (low + high) / 2) / x))
      / list_sum(list_transform(s, lambda x: pow(x, (low + high) / 2))) <= {MAX_REPETITION} THEN (low + high) / 2 ELSE high END
  FROM halves, alls WHERE step < {STEPS}
), exponent AS (
  SELECT CASE WHEN list_max(list_transform(s, lambda x: 1 / x)) / len(s) <= {MAX_REPETITION} THEN 0.0 ELSE high END AS a
  FROM halves, alls WHERE step = {STEPS}
), weights AS (
  SELECT k, every, pow(share, a) / (SELECT sum(pow(share, a)) FROM shares, exponent) AS weight FROM shares, exponent
), quotas AS (
  SELECT k, weight, quota // every AS passes, quota % every AS rest
  FROM (SELECT *, floor(weight * (SELECT sum(every) FROM sizes)::DOUBLE)::BIGINT AS quota FROM weights)
), through AS (
  SELECT *, sum(n) OVER (PARTITION BY k ORDER BY block_key, doc_key) AS upto FROM p WHERE n > 0
), taken AS (
  SELECT DISTINCT k, doc_key FROM through JOIN quotas USING (k) WHERE upto <= rest
)
SELECT p.doc_id, p.source, p.n AS n_tokens, round(coalesce(q.weight, 0), 6) AS weight,
  CASE WHEN p.n > 0 THEN q.passes + (t.k IS NOT NULL)::BIGINT ELSE 0 END AS copies
FROM p LEFT JOIN quotas q USING (k) LEFT JOIN taken t ON t.k = p.k AND t.doc_key = p.doc_key
"""
