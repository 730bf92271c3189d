"""The corpus pipeline: operators of ``hazelake.llm`` applied to ``documents``, stage by stage."""

from hazelake.llm.common import staged, table
from hazelake.llm.decontamination import decontaminated
from hazelake.llm.language_id import accepted
from hazelake.llm.mixing import mixed
from hazelake.llm.simhash_dedup import one_per_group
from hazelake.llm.token_shards import token_shards


def language_id(spark, docs, sf_dir):
    """Documents whose language is clear."""
    return accepted(docs)


def simhash_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return one_per_group(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that overlap with no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them, within the tokens there are."""
    return mixed(docs)


def token_ids(spark, docs, sf_dir):
    """``doc_id, start, n_tokens, ids_crc32`` of the documents, as read back from the shards they were written to."""
    return token_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

#: No SQL: the first stage compares sizes of compressed texts.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage; every stage is written as Parquet and read again as the next one's ``docs``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
