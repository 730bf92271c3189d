"""SimHash near-duplicates by anchor points of a covering code.

Two segments of 23 of the fingerprint's 64 bits are covered by the perfect Golay code: every pattern lies within its
covering radius 3 of exactly one codeword. The pair of codewords next to a fingerprint is its anchor. A fingerprint
within t bits of another lies, segment by segment, within the covering radius plus the bits by which the two differ
there of the other's anchor. So every distinct fingerprint stays at home at its own anchor and visits each anchor whose
covering radius it exceeds by t bits in all; at an anchor, homes are compared with visitors, on all 64 bits.
"""

from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import checkpointed, hinted, on_plain_names, only, shuffled, sliced, staged
from hazelake.llm.components import components

#: Words of a shingle, and differing bits of linked fingerprints.
SHINGLE, THRESHOLD = 3, 2
#: Bits beyond the covering radius for which anchors are tabulated.
BEYOND = 2
SEED = 42
#: Fixed values of the binary Golay code: length of a word, check bits, generator polynomial.
LENGTH, CHECKS, GENERATOR = 23, 11, 0b101011100011
#: First bit of each covered segment; the 18 highest bits take no part in the anchors.
SEGMENTS = (0, 23)
#: Shingles whose bits are counted at a time.
RUN = 1 << 16
#: Distinct fingerprints that one task replicates to their anchors.
FINGERPRINTS_PER_TASK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the hashes of all shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(shingles), RUN):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[start : start + RUN]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in sliced(batches, 512):
        found = np.array([fingerprint(text) for text in batch.column(1).to_pylist()], "<u8").view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "bits"])


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    return rest


@cache
def anchor_offsets() -> tuple[list[np.ndarray], ...]:
    """For 0, 1 and 2 bits beyond the radius and each syndrome: what to add to a word to get the codewords so near.

    The codewords for n bits are those next to the words at n bits' distance which no fewer bits lead to.
    """
    bits = 1 << np.arange(LENGTH)
    patterns = [np.zeros(1, np.int64), bits]
    patterns.append(np.array([a | b for i, a in enumerate(bits) for b in bits[:i]]))
    patterns.append(np.array([a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]))
    leader = np.zeros(1 << CHECKS, np.int64)
    every = np.concatenate(patterns)
    leader[_syndrome(every)] = every
    reached = []
    for beyond in range(BEYOND + 1):
        flips = patterns[beyond]
        at = _syndrome(flips)
        reached.append([np.unique(flips ^ leader[s ^ at]) for s in range(1 << CHECKS)])
    for s in range(1 << CHECKS):
        reached[2][s] = np.setdiff1d(reached[2][s], np.union1d(reached[0][s], reached[1][s]))
        reached[1][s] = np.setdiff1d(reached[1][s], reached[0][s])
    return tuple(reached)


def anchors_of(bits: int, beyond: int) -> np.ndarray:
    """Anchors whose covering radius the fingerprint exceeds by at most ``beyond`` bits; the first is its own."""
    near = anchor_offsets()
    words = np.array([bits >> first & (1 << LENGTH) - 1 for first in SEGMENTS])
    sets = [[word ^ near[n][s] for n in range(beyond + 1)] for word, s in zip(words, _syndrome(words), strict=True)]
    return np.concatenate(
        [
            (sets[0][i][:, None] << LENGTH | sets[1][j][None, :]).ravel()
            for i in range(beyond + 1)
            for j in range(beyond + 1 - i)
        ]
    )


def _replicate(batches, beyond: int):
    for batch in sliced(batches, 4096):
        bits = batch.column(0).to_pylist()
        found = [anchors_of(b & (1 << 64) - 1, beyond) for b in bits]
        every = np.repeat(np.array(bits, np.int64), [len(x) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(np.concatenate(found))], names=["bits", "anchor"])


def links(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``a < b`` for the pairs of the distinct fingerprints of ``classes(bits)`` that differ in so few bits, each once."""
    if not 0 <= threshold <= BEYOND:
        raise ValueError(f"The threshold may not exceed {BEYOND} bits")
    tasks = classes.count() // FINGERPRINTS_PER_TASK + 1
    dealt = classes.select("bits").repartition(tasks, "bits")

    def at_anchors(beyond: int, name: str) -> DataFrame:
        rows = dealt.mapInArrow(partial(_replicate, beyond=beyond), "bits long, anchor long")
        return rows.withColumnRenamed("bits", name)

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    # Spark takes the visitors to be as few as the homes, and would broadcast them.
    pairs = at_anchors(0, "a").join(shuffled(at_anchors(threshold, "b")), "anchor")
    return pairs.where(near & (F.col("a") < F.col("b"))).select("a", "b")


def _marked(docs: DataFrame) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(_fingerprints, f"doc_id {id_type}, bits long")


def _grouped(marked: DataFrame, threshold: int) -> DataFrame:
    """``bits, root, component_id`` of each distinct fingerprint of ``marked(doc_id, bits)``."""
    classes = checkpointed(marked.groupBy("bits").agg(F.min("doc_id").alias("first")))
    found = components(links(classes, threshold))
    rooted = classes.join(found, classes["bits"] == found["node"], "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("bits", "root", "component_id")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs(doc_id, text, …)``.

    Words are split at ASCII blanks after A-Z were lower-cased. Null and empty texts have fingerprint 0 and are linked
    like others. Equal fingerprints are one class, compared once; repeated rows share its component. A null id is
    never the smallest of a component, unless there is no other.
    """
    marked = staged(_marked(docs), "fingerprints")
    return shuffled(marked).join(_grouped(marked, threshold), "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_fingerprint(batches, text_at: int):
    for batch in sliced(batches, 512):
        found = np.array([fingerprint(text) for text in batch.column(text_at).to_pylist()], "<u8").view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "_bits"])


def _fingerprinted(docs: DataFrame) -> DataFrame:
    """``docs`` and ``_bits``, the fingerprint of each row."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(partial(_with_fingerprint, text_at=docs.columns.index("text")), f"{types}, _bits long")


def _one_per_group(docs: DataFrame, threshold: int) -> DataFrame:
    marked = staged(_marked(docs), "fingerprints")
    groups = staged(_grouped(marked, threshold), "groups")
    of_rows = shuffled(marked.where("doc_id is not null")).join(shuffled(groups), "bits")
    ids = of_rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("component_id") == F.col("doc_id")).alias("first")
    )
    odd = checkpointed(ids.where("rows > 1 or not first"))
    once = docs.where("doc_id is not null").join(hinted(odd.select("doc_id")), "doc_id", "left_anti")
    leading = of_rows.where(F.col("component_id") == F.col("doc_id")).join(odd.select("doc_id"), "doc_id")
    leading = leading.select(F.col("doc_id").alias("_id"), F.col("bits").alias("_first"), F.col("root").alias("_root")).distinct()
    repeated = _fingerprinted(docs.join(hinted(odd.where("first").select("doc_id")), "doc_id", "left_semi"))
    of_first = (F.col("doc_id") == F.col("_id")) & (F.col("_bits") == F.col("_first"))
    repeated = repeated.join(hinted(leading), of_first).dropDuplicates(["_root"])
    lone = groups.where("component_id is null").select(F.col("bits").alias("_lone"), F.col("root").alias("_root"))
    without = _fingerprinted(docs.where("doc_id is null"))
    without = without.join(hinted(lone), F.col("_bits") == F.col("_lone")).dropDuplicates(["_root"])
    return reduce(DataFrame.unionByName, (part.select(*docs.columns) for part in (once, repeated, without)))


def one_per_group(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each group of :func:`near_duplicates` of ``docs``, unchanged: the one with the smallest id.

    Of several rows of a group with that id, and in a group without any id, one row stays; an id may be the smallest of
    several groups. Of the texts of whole rows only those of repeated or missing ids are read twice. Further columns may
    have any names.
    """
    return on_plain_names(docs, ("doc_id", "text"), lambda rows: _one_per_group(rows, threshold))
