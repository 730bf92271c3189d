"""The registered queries of the operators, each over its whole table, and their SQL where it can express them."""

from hazelake.llm.collocations import COLLOCATIONS_SQL, collocations
from hazelake.llm.common import table
from hazelake.llm.decontamination import CONTAMINATION_SQL, contamination
from hazelake.llm.language_id import predict_languages
from hazelake.llm.manifest import MANIFEST_SQL, audit
from hazelake.llm.mixing import MIXING_SQL, mixing_plan
from hazelake.llm.quality import quality
from hazelake.llm.simhash_dedup import near_duplicates as near_texts
from hazelake.llm.substring_dedup import SUBSTRING_SQL, substring_dedup
from hazelake.llm.token_counts import token_counts
from hazelake.llm.token_shards import token_shards
from hazelake.llm.toxicity import toxicity
from hazelake.llm.url_filter import learn_lexicon, url_verdicts
from hazelake.llm.vector_dedup import near_duplicates as near_vectors


def op1_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_verdicts(pages, learn_lexicon(pages, "html"))


def op3_language_id(spark, sf_dir):
    return predict_languages(table(spark, sf_dir, "documents"))


def op4_vector_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_simhash_dedup(spark, sf_dir):
    return near_texts(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark, sf_dir):
    return mixing_plan(table(spark, sf_dir, "documents"))


def op10_token_shards(spark, sf_dir):
    return token_shards(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op12_manifest(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


def op13_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_url_filter": op2_url_filter,
    "op3_language_id": op3_language_id,
    "op4_vector_dedup": op4_vector_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_shards": op10_token_shards,
    "op11_collocations": op11_collocations,
    "op12_manifest": op12_manifest,
    "op13_quality": op13_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": CONTAMINATION_SQL,
    "op8_substring_dedup": SUBSTRING_SQL,
    "op9_source_mixing": MIXING_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op12_manifest": MANIFEST_SQL,
}
