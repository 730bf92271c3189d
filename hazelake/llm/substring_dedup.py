"""Substring dedup: words covered by a run of words that also stands earlier in the corpus are removed.

A window is ``WINDOW`` words. So that no document need be matched against the whole corpus, windows are dealt out by their
minimizer, the smallest hash of ``GRAM`` consecutive words in them: equal windows have the same one. Consecutive
windows with one minimizer are a segment.

1. Segments whose minimizer stands nowhere else cannot hold a repeated window and go.
2. Of segments with the same words only the earliest is looked at; the windows of the others are all repeated.
3. What is left is dealt out to shards by minimizer, with the words. A shard gets a compressed FM-index; its segments
   are streamed through it by backward search, whose interval after a whole window tells equal windows. Of the equal ones
   the earliest stays. A minimizer that stands in more segments than a shard should hold has its windows grouped as
   they are instead, in an aggregation that needs no shard.
4. Removed stretches meet their documents again.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import only, pieces_of, ragged, sliced, staged
from hazelake.llm.fm_index import FMIndex
from hazelake.llm.spans import edges, span_hashes

WINDOW, GRAM = 20, 8
#: Segments that a shard holds on average, and from how many of one minimizer its windows are grouped instead.
SHARD_SEGMENTS, MOST_OF_ONE = 8192, 4096
#: Segments that leave a task together.
FOUND_ROWS = 65536

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of _ODD modulo 2**64.
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = ["doc_id", "mark", "at"]


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts ``data[offset:next offset]``, and how many words stand before each text."""
    inside = ~_BLANK[data]
    starts, ends = edges(inside)
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    parted = np.unique(border[inside[border] & inside[border - 1]])  # a text that ends in a word before one that begins so
    starts, ends = np.sort(np.concatenate([starts, parted])), np.sort(np.concatenate([ends, parted]))
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of each run of ``width`` values, by runs of doubled width."""
    at, wide = np.arange(len(values)), 1
    while wide < width:
        step = min(wide, width - wide)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        wide += step
    return at


def segments(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """``rows, keys, starts, windows, contents`` of the segments of some documents, from the hashes of their words.

    Document i has the words from ``bounds[i]`` on. A key is the minimizer, ``starts`` the word of the document that a
    segment begins with, ``windows`` how many windows it has, and ``contents`` a hash of its words.
    """
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    count, size = len(hashes) - window + 1, len(hashes) - gram + 1
    if count <= 0:
        return nothing
    grams = np.zeros(size, np.uint64)
    for i in range(gram):
        grams = _mixed(grams * _ODD + hashes[i : i + size])
    at = _smallest(grams, window - gram + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.flatnonzero(row[window - 1 :] == row[:count])  # windows within one document
    if not len(whole):
        return nothing
    first = np.ones(len(whole), bool)
    first[1:] = (at[whole[1:]] != at[whole[:-1]]) | (whole[1:] != whole[:-1] + 1)
    begin = np.flatnonzero(first)
    starts, windows = whole[begin], np.diff(np.append(begin, len(whole)))
    contents = span_hashes_of(hashes, starts, starts + windows + window - 1) + windows.astype(np.uint64)
    keys, rows = grams[at[starts]].view(np.int64), row[starts]
    return rows, keys, starts - bounds[rows], windows, _mixed(contents).view(np.int64)


def span_hashes_of(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of words, which may overlap, from the hashes of the words."""
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes) - 1, _ODD)]), dtype=np.uint64)
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes) - 1, _INVERSE)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(hashes) * power, dtype=np.uint64)])
    return (sums[ends] - sums[starts]) * back[starts]


def _find(batches, window: int):
    for batch in batches:
        for first, data, offsets in pieces_of(batch.column(2)):
            rows, key, at, windows, content = segments(*word_hashes(data, offsets), window)
            for i in range(0, len(rows), FOUND_ROWS):
                cut = slice(i, i + FOUND_ROWS)
                of = pa.array(first + rows[cut])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(of), batch.column(1).take(of), pa.array(at[cut].astype(np.int32)),
                        pa.array(windows[cut].astype(np.int32)), pa.array(key[cut]), pa.array(content[cut]),
                    ],
                    names=["doc_id", "mark", "at", "windows", "key", "content"],
                )


def _cut(batches, window: int):
    """The word hashes of the wanted segments of each document."""
    unpack = zstandard.ZstdDecompressor()
    for batch in sliced(batches, 64):
        for row in batch.to_pylist():
            data = np.frombuffer(unpack.decompress(row["text"]), np.uint8)
            hashes = word_hashes(data, np.array([0, len(data)]))[0].view(np.int64)
            wanted = row["wanted"]
            words = [hashes[w["at"] : w["at"] + w["windows"] + window - 1] for w in wanted]
            yield pa.RecordBatch.from_pylist(
                [
                    {"key": w["key"], "hot": w["hot"], "doc_id": row["doc_id"], "mark": row["mark"], "at": w["at"], "words": x}
                    for w, x in zip(wanted, words, strict=True)
                ],
                schema=pa.schema(
                    [
                        ("key", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("mark", pa.int64()),
                        ("at", pa.int32()), ("words", pa.list_(pa.int64())),
                    ]
                ),
            )


def _packed(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for batch in sliced(batches, 256):
        texts = [pack.compress((text or "").encode()) for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["doc_id", "mark", "text"]
        )


def _repeated_in(window: int):
    """The windows of a shard that stand earlier in it, as runs ``doc_id, mark, at, windows``."""

    def search(shard: pa.Table) -> pa.Table:
        lists = shard.column("words").combine_chunks()
        words, ends = np.asarray(lists.flatten()), np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
        sizes = np.diff(ends, prepend=0)
        # One sequence of numbers from 1 on, with a 0 after each segment.
        numbers = np.unique(words, return_inverse=True)[1] + 1
        text = np.zeros(len(words) + len(sizes), np.int64)
        text[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = numbers
        first = np.cumsum(sizes + 1) - sizes - 1
        windows = sizes - window + 1
        starts, segment = ragged(first, windows), np.repeat(np.arange(len(sizes)), windows)
        low, _ = FMIndex(text).intervals(text, starts, window)
        at = shard.column("at").to_numpy()[segment] + starts - first[segment]
        ids = shard.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        marks = shard.column("mark").to_numpy()
        order = np.lexsort((at, marks[segment], ids[segment]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        earliest = np.full(len(text) + 1, len(order), np.int64)
        np.minimum.at(earliest, low, rank)
        later = np.flatnonzero(rank > earliest[low])
        # Windows at one place of one document may be met in equal rows; they are not later than each other.
        best = order[earliest[low[later]]]
        same = (ids[segment[later]] == ids[segment[best]]) & (marks[segment[later]] == marks[segment[best]]) & (at[later] == at[best])
        later = later[~same]
        joined = (np.diff(later) == 1) & (np.diff(segment[later]) == 0)
        begin = np.flatnonzero(np.concatenate([[True], ~joined])) if len(later) else np.zeros(0, np.int64)
        run = np.diff(np.append(begin, len(later)))
        rows = segment[later[begin]]
        return pa.table(
            {
                "doc_id": shard.column("doc_id").take(pa.array(rows)),
                "mark": pa.array(marks[rows]),
                "at": pa.array(at[later[begin]].astype(np.int32)),
                "windows": pa.array(run.astype(np.int32)),
            }
        )

    return search


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, mark, at, windows``: runs of windows of ``docs(doc_id, mark, text)`` that also start earlier.

    Earlier is by (doc_id, mark, start), where ``mark`` tells rows with one id apart; a null id comes first.
    """
    found = docs.mapInArrow(
        partial(_find, window=window), "doc_id long, mark long, at int, windows int, key long, content long"
    )
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    often = staged(found.join(keys, "key"), "segments")
    place = F.struct(*_PLACE)
    contents = often.groupBy("key", "content").agg(F.min(place).alias("first"), F.first("windows").alias("windows"))
    contents = staged(contents, "contents")
    copies = often.join(contents.select("key", "content", "first"), ["key", "content"]).where(place > F.col("first"))
    several = contents.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = contents.join(several, "key").select(
        F.col("first.doc_id").alias("doc_id"),
        F.col("first.mark").alias("mark"),
        F.struct(F.col("first.at").alias("at"), "windows", "key", (F.col("n") > MOST_OF_ONE).alias("hot")).alias("wanted"),
    )
    wanted = wanted.groupBy("doc_id", "mark").agg(F.collect_list("wanted").alias("wanted"))
    texts = _texts(docs)
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["mark"] == wanted["mark"])
    cut = staged(
        texts.join(wanted, same)
        .select(texts["doc_id"], texts["mark"], "text", "wanted")
        .mapInArrow(partial(_cut, window=window), "key long, hot boolean, doc_id long, mark long, at int, words array<long>"),
        "segment-words",
    )
    shards = max(1, -(-cut.where("not hot").count() // SHARD_SEGMENTS))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    searched = (
        cut.where("not hot")
        .withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(_repeated_in(window), "doc_id long, mark long, at int, windows int")
    )
    singles = (
        cut.where("hot")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.size("words") - window)))
        .select("doc_id", "mark", (F.col("at") + F.col("i")).alias("at"), F.slice("words", F.col("i") + 1, window).alias("words"))
    )
    earliest = singles.groupBy("words").agg(F.min(place).alias("first"))
    grouped = singles.join(earliest, "words").where(place > F.col("first"))
    return (
        copies.select(*_PLACE, "windows")
        .unionByName(searched)
        .unionByName(grouped.select(*_PLACE, F.lit(1).alias("windows")))
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.mapInArrow(_packed, "doc_id long, mark long, text binary")


def _without(batches, window: int):
    unpack = zstandard.ZstdDecompressor()
    for batch in sliced(batches, 128):
        out = []
        for row in batch.to_pylist():
            words = unpack.decompress(row["text"]).split()
            gone = np.zeros(len(words) + 1, np.int64)
            for run in row["runs"] or ():
                gone[run["at"]] += 1
                gone[run["at"] + run["windows"] + window - 1] -= 1
            kept = np.cumsum(gone[:-1]) == 0
            text = b" ".join(w for w, keep in zip(words, kept.tolist(), strict=True) if keep)
            out.append((row["doc_id"], len(words), int(len(words) - kept.sum()), text.decode()))
        ids, sizes, removed, texts = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "text"],
        )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every row of ``docs(doc_id, text, …)``; the words kept, joined by spaces.

    Words are split at ASCII blanks. Null, empty and short texts lose nothing. Rows with one id and different texts
    are documents of their own, in the order of a hash of their texts; equal rows lose the same. A null id comes before
    all others.
    """
    rows = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text"
    )
    runs = repeated_windows(rows, window).groupBy("doc_id", "mark")
    runs = runs.agg(F.collect_set(F.struct("at", "windows")).alias("runs"))
    texts = _texts(rows)
    same = texts["doc_id"].eqNullSafe(runs["doc_id"]) & (texts["mark"] == runs["mark"])
    return (
        texts.join(runs, same, "left")
        .select(texts["doc_id"], "text", "runs")
        .mapInArrow(partial(_without, window=window), "doc_id long, n_words long, n_removed long, text string")
    )


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, from ``without_repeats``."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SUBSTRING_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS s FROM d)
), firsts AS (
  SELECT t, min(struct_pack(d := doc_id, s := s)) AS f FROM windows GROUP BY t HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, s FROM windows JOIN firsts USING (t) WHERE struct_pack(d := doc_id, s := s) > f
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM repeated
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
), lost AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""
