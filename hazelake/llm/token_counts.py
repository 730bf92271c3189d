"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

1. Documents are taken in blocks of bounded size. A block is split into pre-tokens, and its (pre-token, document,
   frequency) triples leave it as one row per bucket of pre-tokens (a hash of the text).
2. Rows are shuffled by bucket. There each distinct pre-token is given to the tokenizer once; its number of pieces
   is multiplied with the frequencies and summed per document of the block.
3. The partial sums of a block meet again and are added. No id of any document is ever kept.

A pre-token that stands in every document is one entry per block, so no key is hot.
"""

import re
import zlib
from collections.abc import Iterator
from functools import cache, partial
from itertools import batched

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazelake.llm.common import only, pack, ragged, sliced, unpack

#: Raw text of a block, at most (a longer document is a block of its own).
BLOCK_BYTES = 8 << 20
#: Distinct pre-tokens whose counts one task remembers; beyond that it starts anew and counts some again.
REMEMBERED = 500_000

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PRE_TOKEN = regex.compile(PRE_TOKEN)
_ODD_BLANKS = re.compile(r" (?:\s|$)")
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7e\xa0-\xff]*")

_TRIPLES = pa.schema(
    [
        ("block", pa.string()),
        ("bucket", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("bytes", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.string())),
        ("frequencies", pa.binary()),
    ]
)
_SUMS = pa.schema(
    [
        ("block", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("bytes", pa.list_(pa.int64())),
        ("sums", pa.binary()),
    ]
)
_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


class PreTokens:
    """Splits a text as the tokenizer does before it looks for pieces; special strings stand alone."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        specials.sort(key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None

    def ordinary(self, text: str) -> list[str]:
        # Beyond Latin-1 the library itself decides what a letter is, as its Unicode tables may be of another age.
        if _PLAIN.fullmatch(text):
            return _PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.ordinary(text)
        return [
            token
            for i, part in enumerate(self.special.split(text))
            if part
            for token in ([part] if i % 2 else self.ordinary(part))
        ]

    def sizes(self, tokens: list[str]) -> list[int]:
        return [
            len(e)
            for some in batched(tokens, 4096)
            for e in self.tokenizer.encode_batch_fast(list(some), add_special_tokens=False)
        ]


@cache
def pre_tokens(path: str) -> PreTokens:
    """One per Python worker, since a tokenizer that is let go does not give all its memory back."""
    return PreTokens(path)


class _Block:
    """Pre-token frequencies of some documents.

    A blank before a visible character always begins a pre-token, so a text may be cut there; equal cuts are split
    into pre-tokens only once per block. A cut is known by its text after the blank, the first cut of a text by a
    one-tuple, and a pre-token of a text with odd blanks, which is split as a whole, by a pair.
    """

    def __init__(self, split: PreTokens):
        self.split, self.bytes = split, 0
        self.cuts: dict = {}
        self.doc_ids, self.sizes, self.found = [], [], []

    def add(self, doc_id, text: str, size: int) -> None:
        known = self.cuts
        if _ODD_BLANKS.search(text):
            keys = [(token, None) for token in self.split(text)]
        else:
            keys = text.split(" ")
            keys[0] = (keys[0],)
        self.found.append(np.fromiter((known.setdefault(k, len(known)) for k in keys), np.int32, len(keys)))
        self.doc_ids.append(doc_id)
        self.sizes.append(size)
        self.bytes += size

    def _pre_tokens(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens; the numbers of those of every cut; how many each cut has."""
        number: dict[str, int] = {}
        flat, lengths = [], []
        for key in self.cuts:
            if isinstance(key, str):
                tokens = self.split(" " + key)
            else:
                tokens = self.split(key[0]) if len(key) == 1 else [key[0]]
            flat.extend(number.setdefault(token, len(number)) for token in tokens)
            lengths.append(len(tokens))
        return list(number), np.array(flat, np.int64), np.array(lengths, np.int64)

    def rows(self, name: str, buckets: int) -> Iterator[dict]:
        tokens, flat, lengths = self._pre_tokens()
        starts = np.cumsum(lengths) - lengths
        cuts = np.concatenate(self.found)
        docs = np.repeat(np.arange(len(self.found)), [len(x) for x in self.found])
        token = flat[ragged(starts[cuts], lengths[cuts])]
        doc = np.repeat(docs, lengths[cuts])
        yield {"block": name, "bucket": zlib.crc32(name.encode()) % buckets, "doc_ids": self.doc_ids, "bytes": self.sizes}
        if not tokens:
            return
        bucket_of = np.fromiter((zlib.crc32(t.encode()) % buckets for t in tokens), np.int64, len(tokens))
        order = np.argsort(bucket_of, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        pairs, counts = np.unique(place[token] * len(self.found) + doc, return_counts=True)
        at, doc = np.divmod(pairs, len(self.found))
        first = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
        for bucket in range(buckets):
            a, b = first[bucket], first[bucket + 1]
            if a < b:
                i, j = np.searchsorted(at, [a, b])
                yield {
                    "block": name,
                    "bucket": bucket,
                    "pieces": [tokens[k] for k in order[a:b]],
                    "frequencies": pack(np.bincount(at[i:j] - a, minlength=b - a), doc[i:j], counts[i:j]),
                }


def _triples(batches, path: str, buckets: int, block_bytes: int):
    from pyspark import TaskContext

    split, task, made = pre_tokens(path), TaskContext.get().partitionId(), 0
    block = _Block(split)
    for batch in sliced(batches, 256):
        texts = batch.column(1).fill_null("")
        sizes = pc.binary_length(texts.cast(pa.binary())).to_pylist()
        for doc_id, text, size in zip(batch.column(0).to_pylist(), texts.to_pylist(), sizes, strict=True):
            block.add(doc_id, text, size)
            if block.bytes >= block_bytes or len(block.found) >= 1 << 16:
                yield from _as_batches(block.rows(f"{task}-{made}", buckets))
                block, made = _Block(split), made + 1
    if block.found:
        yield from _as_batches(block.rows(f"{task}-{made}", buckets))


def _as_batches(rows):
    for some in batched(rows, 64):
        yield pa.RecordBatch.from_pylist(list(some), schema=_TRIPLES)


def _partial_sums(batches, path: str):
    split, known = pre_tokens(path), {}
    for batch in sliced(batches, 64):
        rows = batch.to_pylist()
        new = list({t for row in rows for t in row["pieces"] or () if t not in known})
        if len(known) > REMEMBERED:
            known, new = {}, list({t for row in rows for t in row["pieces"] or ()})
        known.update(zip(new, split.sizes(new), strict=True))
        out = []
        for row in rows:
            if row["doc_ids"] is not None:
                out.append({k: row[k] for k in ("block", "doc_ids", "bytes")})
                continue
            width, doc, count = unpack(row["frequencies"])
            size = np.repeat([known[t] for t in row["pieces"]], width)
            out.append({"block": row["block"], "sums": pack(np.bincount(doc, size * count.astype(np.int64)))})
        yield pa.RecordBatch.from_pylist(out, schema=_SUMS)


def _added(rows: pa.Table) -> pa.Table:
    rows = rows.to_pylist()
    head = next(row for row in rows if row["doc_ids"] is not None)
    total = np.zeros(len(head["doc_ids"]), np.int64)
    for row in rows:
        if row["sums"] is not None:
            (part,) = unpack(row["sums"])
            total[: len(part)] += part
    return pa.table([head["doc_ids"], head["bytes"], total], schema=_COUNTS)


def token_counts(
    docs: DataFrame, tokenizer: str | None = None, limit: int = 512, buckets: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text, …)``.

    A null text counts as empty (0 bytes, 0 tokens); repeated rows and ids are counted each; a null id stays null.
    ``tokenizer`` is the file of a byte-level BPE; no end or special tokens are added, special strings inside a text are
    one token as the library has it.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(256, 4 * shuffled)
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    triples = rows.mapInArrow(
        partial(_triples, path=path, buckets=buckets, block_bytes=block_bytes),
        "block string, bucket int, doc_ids array<long>, bytes array<long>, pieces array<string>, frequencies binary",
    )
    sums = triples.repartition("bucket").mapInArrow(
        partial(_partial_sums, path=path), "block string, doc_ids array<long>, bytes array<long>, sums binary"
    )
    counts = sums.groupBy("block").applyInArrow(_added, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
