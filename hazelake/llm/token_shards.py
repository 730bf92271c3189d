"""Token ids as binary shards, compressed by a Re-Pair grammar per shard.

Documents are put in order of their ids, encoded, and cut into shards of about a million ids. In a shard, frequent
pairs of neighbouring symbols are replaced by nonterminals again and again. A shard stores the rules, the length
each nonterminal expands to, the sequence that is left, and how many symbols and ids each document has; no symbol spans two
documents, so that any document is decoded alone.

A shard is a row of a Parquet table, so that tasks that are repeated or lost leave nothing half-written behind:

    shard long               order among all shards: writing task << 32 | number in the task
    n_ids long               ids of all documents
    doc_ids array<long>      documents in order
    doc_symbols array<int>   symbols of each document in ``sequence``
    doc_tokens array<int>    ids of each document
    rules binary             left and right symbol of each rule, unsigned 16 bit, little-endian
    lengths binary           ids that each rule expands to, unsigned 32 bit, little-endian
    sequence binary          symbols, unsigned 16 bit, little-endian; from the vocabulary's size on, rules
"""

import uuid
import zlib
from functools import cache, partial
from itertools import batched

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazelake.llm.common import hinted, only, pieces_of, ragged, shared_dir, sliced
from hazelake.llm.spans import span_hashes

END_ID = 2
SHARD_IDS = 1 << 20
#: Rounds of replacement, pairs replaced in a round at most, and how often a pair must stand in a shard.
ROUNDS, ROUND_PAIRS, LEAST_COUNT = 6, 4096, 12
SYMBOLS = 1 << 16
#: Distinct cuts whose ids a Python worker remembers, some 40 bytes each; beyond that it starts anew.
REMEMBERED = 1_000_000
#: Base of a cut's second hash.
OTHER_BASE = 0xD6E8FEB86659FD93
#: Bytes of texts that are encoded together; a longer text is a run of its own.
RUN_BYTES = 2 << 20
#: Cuts that are joined to one text for the tokenizer.
JOINED = 512

_SHARD = pa.schema(
    [
        ("shard", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_symbols", pa.list_(pa.int32())),
        ("doc_tokens", pa.list_(pa.int32())),
        ("rules", pa.binary()),
        ("lengths", pa.binary()),
        ("sequence", pa.binary()),
    ]
)
SHARD_SCHEMA = (
    "shard long, n_ids long, doc_ids array<long>, doc_symbols array<int>, doc_tokens array<int>, "
    "rules binary, lengths binary, sequence binary"
)


@cache
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True
_STOP, _SMALL = np.zeros(256, bool), np.zeros(256, bool)
_STOP[[44, 46]] = True
_SMALL[97:123] = True


def cuts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the cuts of the texts ``data[offset:next offset]`` begin and end.

    Spaces and line ends part cuts, texts do, and so does a full stop or comma between a small letter and a blank of the
    same text: there pre-tokens end anyway.
    """
    n = len(data)
    blank, border = _BLANK[data], np.zeros(n + 1, bool)
    border[offsets] = True
    begins = np.zeros(n, bool)
    begins[1:] = blank[:-1]
    begins[1:-1] |= _STOP[data[1:-1]] & _SMALL[data[:-2]] & blank[2:] & ~border[2:-1]
    begins |= border[:-1]
    begins &= ~blank
    ends = border.copy()
    ends[:-1] |= blank | begins
    ends[1:] &= ~blank
    ends[0] = False
    return np.flatnonzero(begins), np.flatnonzero(ends)


class Encoder:
    """Ids of texts.

    Each distinct cut is encoded once and known by two hashes of 64 bits from then on, so that what is remembered
    is a few arrays of numbers. A cut that shares the first hash with another is encoded wherever it stands.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.size = self.tokenizer.get_vocab_size()
        if self.size > 60_000:
            raise ValueError("Shards hold 16-bit symbols; the vocabulary leaves no room for rules")
        special = self.tokenizer.get_added_tokens_decoder()
        self.between_id = next((i for i, t in special.items() if not (t.lstrip or t.rstrip or t.single_word)), None)
        self.between = None if self.between_id is None else special[self.between_id].content
        self._forget()

    def _forget(self):
        self.known, self.other = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of the texts ``data[offset:next offset]``."""
        if len(self.known) > REMEMBERED:
            self._forget()
        begins, ends = cuts_of(data, offsets)
        first, second = span_hashes(data, begins, ends), span_hashes(data, begins, ends, OTHER_BASE)
        distinct, at, cut = np.unique(first, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            texts = self._texts(data, begins, ends, at[new])
            self._learn(distinct[new], second[at[new]], texts, place[new])
            place = np.searchsorted(self.known, distinct)
        slot = place[cut]
        lengths, sources = self.lengths[slot], self.starts[slot]
        flat, odd = self.flat, np.flatnonzero(self.other[slot] != second)
        if len(odd):  # another cut of the same first hash is known
            ids, own = self._encoded(self._texts(data, begins, ends, odd))
            lengths[odd], sources[odd] = own, len(flat) + np.cumsum(own) - own
            flat = np.concatenate([flat, ids])
        ids = flat[ragged(sources, lengths)]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return np.split(ids, totals[np.searchsorted(begins, offsets[1:-1])])

    @staticmethod
    def _texts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: np.ndarray) -> list[str]:
        whole = data.tobytes()
        return [whole[a:b].decode() for a, b in zip(begins[which].tolist(), ends[which].tolist(), strict=True)]

    def _learn(self, first: np.ndarray, second: np.ndarray, cuts: list[str], place: np.ndarray) -> None:
        """Remember new cuts, whose hashes ascend, at their places among the known ones."""
        ids, lengths = self._encoded(cuts)
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.known, self.other = np.insert(self.known, place, first), np.insert(self.other, place, second)
        self.starts, self.lengths = np.insert(self.starts, place, starts), np.insert(self.lengths, place, lengths)
        self.flat = np.concatenate([self.flat, ids])

    def _encoded(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts and how many each has; many go to the tokenizer in one text with a special token between them."""
        made = []
        for some in batched(cuts, JOINED):
            alone = some if self.between is None else [c for c in some if self.between in c]
            if not alone:
                ids = np.array(self._encode(self.between.join(some)), np.uint16)
                parts = ids == self.between_id
                made.append((ids[~parts], np.bincount(np.cumsum(parts)[~parts], minlength=len(some))))
            else:
                each = [np.array(self._encode(c), np.uint16) for c in some]
                made.append((np.concatenate(each), np.array([len(x) for x in each])))
        ids, lengths = (np.concatenate(x) for x in zip(*made, strict=True))
        return ids, lengths.astype(np.int64)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


def compress(sequence: np.ndarray, ends: np.ndarray, base: int):
    """Re-Pair: ``rules, lengths, sequence, ends`` for ids below ``base``; ``ends`` marks the last symbols of documents.

    A round counts all neighbouring pairs that no document ends between, gives the most frequent ones a nonterminal
    each, and replaces them from left to right.
    """
    rules, lengths = np.zeros((0, 2), np.uint16), np.ones(base, np.uint32)
    for _ in range(ROUNDS):
        pairs = sequence[:-1].astype(np.uint32) << 16 | sequence[1:]
        inside = ~ends[:-1]
        ordered = np.sort(pairs[inside])
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        counts = np.diff(np.append(first, len(ordered)))
        room = min(ROUND_PAIRS, SYMBOLS - base - len(rules))
        often = np.flatnonzero(counts >= LEAST_COUNT)
        often = np.sort(often[np.argsort(-counts[often], kind="stable")[:room]])
        if not len(often):
            break
        chosen = ordered[first[often]]
        near = np.zeros(1 << 16, bool)
        near[(chosen * np.uint32(2654435761)) >> np.uint32(16)] = True
        at = np.flatnonzero(near[(pairs * np.uint32(2654435761)) >> np.uint32(16)] & inside)
        place = np.minimum(np.searchsorted(chosen, pairs[at]), len(chosen) - 1)
        at, place = at[chosen[place] == pairs[at]], place[chosen[place] == pairs[at]]
        run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])  # of overlapping pairs every other one is replaced
        odd = (np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 1
        at, place = at[~odd], place[~odd]
        used, place = np.unique(place, return_inverse=True)
        sequence = sequence.copy()
        sequence[at] = base + len(rules) + place
        ends = ends.copy()
        ends[at] = ends[at + 1]
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence, ends = sequence[keep], ends[keep]
        added = np.stack([chosen[used] >> 16, chosen[used] & 0xFFFF], axis=1).astype(np.uint16)
        lengths = np.concatenate([lengths, lengths[added].sum(axis=1).astype(np.uint32)])
        rules = np.concatenate([rules, added])
    return rules, lengths[base:], sequence, ends


class Grammar:
    """Decodes symbols of one shard."""

    def __init__(self, rules: bytes, lengths: bytes, base: int):
        pairs = np.frombuffer(rules, "<u2").reshape(-1, 2).astype(np.int64)
        self.lengths = np.concatenate([np.ones(base, np.int64), np.frombuffer(lengths, "<u4").astype(np.int64)])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ids = np.zeros(int(self.lengths.sum()), np.uint32)
        self.ids[:base] = np.arange(base)
        starts, sizes, ids = self.starts.tolist(), self.lengths.tolist(), self.ids
        for symbol, (left, right) in enumerate(pairs.tolist(), base):
            a, m, n = starts[symbol], sizes[left], sizes[right]
            ids[a : a + m] = ids[starts[left] : starts[left] + m]
            ids[a + m : a + m + n] = ids[starts[right] : starts[right] + n]

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        return self.ids[ragged(self.starts[symbols], self.lengths[symbols])]


def decode_document(shard: dict, number: int, base: int) -> np.ndarray:
    """Ids of the document at ``number`` in a shard's row, without decoding the others."""
    first = sum(shard["doc_symbols"][:number])
    symbols = np.frombuffer(shard["sequence"], "<u2", shard["doc_symbols"][number], 2 * first)
    return Grammar(shard["rules"], shard["lengths"], base)(symbols)


def _shard_row(number: int, doc_ids: list, ids: list[np.ndarray], base: int) -> pa.RecordBatch:
    sequence = np.concatenate(ids)
    tokens = np.array([len(x) for x in ids], np.int32)
    ends = np.zeros(len(sequence), bool)
    ends[np.cumsum(tokens) - 1] = True
    rules, lengths, sequence, ends = compress(sequence, ends, base)
    row = {
        "shard": number,
        "n_ids": int(tokens.sum()),
        "doc_ids": doc_ids,
        "doc_symbols": np.diff(np.flatnonzero(ends), prepend=-1).astype(np.int32).tolist(),
        "doc_tokens": tokens.tolist(),
        "rules": rules.astype("<u2").tobytes(),
        "lengths": lengths.astype("<u4").tobytes(),
        "sequence": sequence.astype("<u2").tobytes(),
    }
    return pa.RecordBatch.from_pylist([row], schema=_SHARD)


@cache
def _encoder(path: str) -> Encoder:
    """One per Python worker: cuts that one task has met are known to the next."""
    return Encoder(path)


def _shards(batches, path: str, end_id: int, shard_ids: int):
    encode, task, made = _encoder(path), TaskContext.get().partitionId(), 0
    doc_ids, ids, size, end = [], [], 0, np.array([end_id], np.uint16)
    for batch in batches:
        numbers = batch.column(0).to_pylist()
        for first, data, offsets in pieces_of(batch.column(1), RUN_BYTES):
            for doc_id, found in zip(numbers[first:], encode(data, offsets), strict=False):
                doc_ids.append(doc_id)
                ids.append(np.concatenate([found, end]))
                size += len(found) + 1
                if size >= shard_ids:
                    yield _shard_row(task << 32 | made, doc_ids, ids, encode.size)
                    doc_ids, ids, size, made = [], [], 0, made + 1
    if ids:
        yield _shard_row(task << 32 | made, doc_ids, ids, encode.size)


def write_shards(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> None:
    """Encode ``docs(doc_id, text, …)`` in ascending order of ids and write the shards to the folder ``path``.

    A null text is empty, and still ends with ``end_id``; null ids come first; rows of one id are ordered by a hash of the
    text, then the text.
    """
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text").drop("mark")
    made = ordered.mapInArrow(
        partial(
            _shards,
            path=tokenizer or public_tokenizers.path("word_bpe_49k.json"),
            end_id=end_id,
            shard_ids=shard_ids,
        ),
        SHARD_SCHEMA,
    )
    made.write.option("compression", "zstd").parquet(path)


def _documents(batches, base: int):
    for batch in sliced(batches, 1):
        (row,) = batch.to_pylist()
        ids = Grammar(row["rules"], row["lengths"], base)(np.frombuffer(row["sequence"], "<u2"))
        data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(row["doc_tokens"], dtype=np.int64)
        starts = ends - row["doc_tokens"]
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts + row["before"]),
                pa.array(ends - starts),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_documents(spark: SparkSession, path: str, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards at ``path``.

    ``start`` counts the ids of all documents before; the checksum is of the ids as little-endian unsigned 32-bit
    integers. The driver gets one total for each task that wrote.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    task = F.shiftright("shard", 32)
    totals = shards.groupBy(task.alias("task")).agg(F.sum("n_ids").alias("n")).orderBy("task").collect()
    ends = np.cumsum([r["n"] for r in totals], dtype=np.int64).tolist()
    offsets = spark.createDataFrame(
        [(r["task"], end - r["n"]) for r, end in zip(totals, ends, strict=True)], "task long, offset long"
    )
    earlier = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("shard", task.alias("task"), "n_ids").withColumn(
        "inside", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))
    )
    places = places.join(F.broadcast(offsets), "task").select("shard", (F.col("offset") + F.col("inside")).alias("before"))
    base = _tokenizer(tokenizer or public_tokenizers.path("word_bpe_49k.json")).get_vocab_size()
    return shards.join(hinted(places), "shard").mapInArrow(
        partial(_documents, base=base), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_shards(docs: DataFrame) -> DataFrame:
    """Write ``docs`` as shards to a new folder of the shared folder, and return what ``read_documents`` finds there."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/token-shards-{uuid.uuid4().hex}"
    write_shards(docs, path)
    return read_documents(spark, path)
