"""Phrases whose words stand together oftener than their parts explain, mined by partitions (SON).

The documents are dealt out to :data:`SHARDS` shards. Of a phrase that stands ``SUPPORT`` times in a language, some
shard holds at least its proportional part: if every shard had less than ``SUPPORT`` times its share of the language's
words, the sum would be less than ``SUPPORT``. So

1. every shard is mined completely: all phrases of 1 to 4 words are counted, those that reach the support lowered to
   the shard's share are locally frequent;
2. the locally frequent phrases of all shards are the candidates, and all of them are counted in all shards;
3. the documents are read again for the words of those that reach the support, and counted by these words.

A shard is no task. Tasks count runs of bounded size and deal the counts out to buckets by a hash of the phrase; a
bucket sees what all shards count of its phrases, so that nothing but the number of buckets grows with the corpus.
Steps 1 and 2 know phrases by hashes; two phrases of one hash can only make a candidate too many, since step 3 counts
words.
"""

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazelake.llm.common import hinted, only, pack, sliced, staged, unpack
from hazelake.llm.spans import MIX, counted, edges, followed, mixed, span_hashes

#: Least count of a phrase, words of the longest, phrases that are reported of a language.
SUPPORT, LONGEST, REPORTED = 30, 4, 2000
#: A score is floor(SCALE * a / (l + r)); a phrase goes if COVERS percent of it stand inside one longer phrase.
SCALE, COVERS = 2_000_000, 80
#: Shards of the corpus. More shards mean lower local supports.
SHARDS = 8
#: Bytes of text that are counted together, and bytes of the corpus for each bucket.
RUN_BYTES, BUCKET_BYTES = 6 << 20, 8 << 20
#: Bits of a phrase's hash that tell it from others of its bucket.
KEY_BITS = 32
#: The table that marks frequent phrases has so many bits for each, and 2**MOST_BITS at most: 32 MB.
BITS_EACH, MOST_BITS = 32, 28
#: Bits of the table that are one value when it is put together.
MARK_BITS = 16
#: Base of a second hash, by which phrases of one hash are told apart.
OTHER_BASE = 0xD6E8FEB86659FD93
NO_LANG = "und"

# Lower case, tabs as blanks, and what parts pieces as line ends.
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\x09.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz\x20" + b"\n" * 9
)


def _runs(batches, most: int):
    """``(number, lang, texts)``: the texts of each language in runs of about ``most`` bytes, parted by line ends."""
    held, size, number = {}, 0, 0
    for batch in sliced(batches, 256):
        texts = batch.column(1).cast(pa.large_binary()).to_pylist()
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            for part in _parts(text, most):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size >= most:
                    for key in held:
                        yield number, key, b"\n".join(held[key])
                    held, size, number = {}, 0, number + 1
    for key in held:
        yield number, key, b"\n".join(held[key])


def _parts(text: bytes | None, most: int):
    """A very long text cut where pieces end anyway; any other as it is."""
    while text and len(text) > most:
        head = text[:most].translate(_TABLE)
        cut = head.rfind(b"\n") + 1
        if not cut:  # one piece longer than a run stays whole
            end = text.translate(_TABLE).find(b"\n", most)
            cut = len(text) if end < 0 else end + 1
        yield text[:cut]
        text = text[cut:]
    if text:
        yield text


class Phrases:
    """The phrases of a run of texts of one language."""

    def __init__(self, texts: bytes):
        self.data = texts.translate(_TABLE)
        array = np.frombuffer(self.data, np.uint8)
        parts = array == 10
        self.starts, self.ends = edges(~(parts | (array == 32)))
        self.piece = np.cumsum(parts, dtype=np.int32)[self.starts]
        self.array = array

    def hashes(self):
        """For 1 to 4 words in turn: at which words phrases begin, and their hashes."""
        words = span_hashes(self.array, self.starts, self.ends)
        yield np.arange(len(words)), words
        here = words
        for k in range(1, LONGEST):
            here = followed(here[:-1], words[k:]) if len(here) else here
            whole = np.flatnonzero(self.piece[k:] == self.piece[: max(len(self.piece) - k, 0)])
            yield whole, here[whole]

    def text(self, at: int, words: int) -> str:
        span = self.data[self.starts[at] : self.ends[at + words - 1]]
        return b" ".join(span.split()).decode(errors="replace")


def _of_lang(hashes: np.ndarray, lang: str) -> np.ndarray:
    """Hashes that differ from language to language, as their phrases are others."""
    return mixed(hashes ^ np.uint64(zlib.crc32(lang.encode())))


def _keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of a hash that stand for the phrase: its bucket, then ``KEY_BITS`` more."""
    return hashes >> np.uint64(64 - KEY_BITS - bits)


_PACKS = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("words", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary())])


def _count(batches, bits: int, run_bytes: int):
    """Per run and bucket: keys (as differences) and counts of all its phrases. The first bucket tells the words."""
    task = TaskContext.get().partitionId()
    for number, lang, texts in _runs(batches, run_bytes):
        phrases = Phrases(texts)
        keys, counts = _merged([counted(np.sort(_keys(_of_lang(h, lang), bits))) for _, h in phrases.hashes()])
        bounds = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
        low = (keys & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
        rows = []
        for bucket, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            words = 0 if bucket else len(phrases.starts)
            if b > a or words:
                steps = np.diff(low[a:b], prepend=np.uint32(0))
                rows.append((lang, (task + number) % SHARDS, words, bucket, pack(steps, counts[a:b])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKS, strict=True)], schema=_PACKS)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several lists of keys and counts, ascending, and the sums of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _summed(packs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several packs, and the sums of their counts."""
    return _merged([(np.cumsum(steps, dtype=np.uint32), n) for steps, n in map(unpack, packs)])


def _frequent(support: int):
    def of_bucket(table: pa.Table) -> pa.Table:
        """One bucket of a language: keys whose phrases are frequent in some shard and reach the support in all."""
        shards = np.asarray(table["shard"])
        local = []
        for shard in np.unique(shards):
            rows = table.filter(pa.array(shards == shard))
            local.append((rows["least"][0].as_py(), *_summed(rows["counts"].to_pylist())))
        candidates = np.unique(np.concatenate([keys[n >= least] for least, keys, n in local]))
        total = np.zeros(len(candidates), np.int64)
        for _, keys, n in local:
            if len(keys) and len(candidates):
                at = np.minimum(np.searchsorted(keys, candidates), len(keys) - 1)
                total += np.where(keys[at] == candidates, n[at], 0)
        kept = candidates[total >= support].astype(np.uint64)
        whole = (np.uint64(table["bucket"][0].as_py()) << np.uint64(KEY_BITS)) | kept
        return pa.table({"keys": pa.array([whole.astype("<u8").tobytes()], pa.binary()), "n": pa.array([len(whole)], pa.int64())})

    return of_bucket


def _marks(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys in a table of 2**bits marks."""
    return (mixed(keys * MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _mark_blocks(batches, bits: int, block_bits: int):
    """The marks of each batch's keys, in blocks of bytes: ``block, marks``."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8")
        places = np.unique(_marks(keys, bits))
        blocks, first = np.unique(places >> block_bits, return_index=True)
        made = []
        for some in np.split(places & ((1 << block_bits) - 1), first[1:]):
            marks = np.zeros(1 << block_bits, bool)
            marks[some] = True
            made.append(zstandard.compress(np.packbits(marks, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(made[: len(blocks)], pa.binary())], names=["block", "marks"])


def _united(table: pa.Table) -> pa.Table:
    """The marks of one block in all batches."""
    every = [np.frombuffer(zstandard.decompress(some), np.uint8) for some in table["marks"].to_pylist()]
    marks = np.bitwise_or.reduce(every)
    return table.slice(0, 1).set_column(1, "marks", pa.array([zstandard.compress(marks.tobytes(), 3)], pa.binary()))


def _recount(batches, bits: int, run_bytes: int, table: bytes, table_bits: int):
    """The phrases of each run that the table marks: their words, and how often they stand in the run."""
    marks = np.frombuffer(zstandard.decompress(table), np.uint8)
    for _, lang, texts in _runs(batches, run_bytes):
        phrases = Phrases(texts)
        words = span_hashes(phrases.array, phrases.starts, phrases.ends, OTHER_BASE)
        for k, (at, h) in enumerate(phrases.hashes(), 1):
            place = _marks(_keys(_of_lang(h, lang), bits), table_bits)
            marked = np.flatnonzero(marks[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            if not len(marked):
                continue
            h, at = h[marked], at[marked]
            other = words[at]
            for j in range(1, k):
                other = followed(other, words[at + j])
            order = np.lexsort((other, h))
            h, other, at = h[order], other[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (other[1:] != other[:-1])]))
            n = np.diff(np.append(first, len(h)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(first), pa.string()),
                    pa.array(np.full(len(first), k, np.int32)),
                    pa.array([phrases.text(i, k) for i in at[first].tolist()], pa.string()),
                    pa.array(n.astype(np.int64)),
                ],
                names=["lang", "words", "phrase", "n"],
            )


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to 4 words that stand ``support`` times in their language, and the words of each language.

    The first frame is ``lang, words, phrase, f``, the second ``lang, n``, of ``docs(text, lang, …)``; both are stored in
    the shared folder. A null language is ``und``; null and empty texts hold no words, and a language without words has
    no row. Every row counts, repeated ones too.
    """
    rows = only(docs, "lang", "text").select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (-(-size // bucket_bytes) - 1).bit_length())
    counts = staged(
        rows.mapInArrow(partial(_count, bits=bits, run_bytes=run_bytes), "lang string, shard int, words long, bucket long, counts binary"),
        "phrase-counts",
    )
    shares = counts.groupBy("lang", "shard").agg(F.sum("words").alias("own"))
    words = staged(shares.groupBy("lang").agg(F.sum("own").alias("n")), "lang-words")
    own = F.col("own").cast("decimal(20,0)")
    least = shares.join(words, "lang").select(
        "lang", "shard", F.greatest(F.lit(1), F.ceil(own * F.lit(support) / F.col("n"))).cast("long").alias("least")
    )
    keys = staged(
        counts.drop("words").join(hinted(least), ["lang", "shard"])
        .groupBy("lang", "bucket").applyInArrow(_frequent(support), "keys binary, n long"),
        "frequent-keys",
    )
    found = keys.agg(F.sum("n")).first()[0] or 0
    table_bits = max(MARK_BITS, min(MOST_BITS, (BITS_EACH * found).bit_length()))
    mark = partial(_mark_blocks, bits=table_bits, block_bits=MARK_BITS)
    blocks = keys.where("n > 0").select("keys").mapInArrow(mark, "block long, marks binary")
    blocks = blocks.groupBy("block").applyInArrow(_united, "block long, marks binary")
    table = np.zeros((1 << (table_bits - MARK_BITS), 1 << (MARK_BITS - 3)), np.uint8)
    for block, marks in blocks.toLocalIterator():
        table[block] = np.frombuffer(zstandard.decompress(marks), np.uint8)
    again = partial(
        _recount, bits=bits, run_bytes=run_bytes, table=zstandard.compress(table.tobytes(), 3), table_bits=table_bits
    )
    phrases = (
        rows.mapInArrow(again, "lang string, words int, phrase string, n long")
        .groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    )
    return staged(phrases, "frequent-phrases"), words


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def collocations(docs: DataFrame, support: int = SUPPORT, reported: int = REPORTED, **sizes: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``reported`` collocations of each language of ``docs``.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. A phrase of
    2 to 4 words with ``a`` occurrences is cut after each word in turn; its score is the lowest
    floor(2000000 * a / (l + r)), the first such cut counts. Phrases of which 80 % stand inside one longer phrase are left
    out. Ties of score and count are ordered by the bytes of the phrase. No rows where no phrase reaches the support.
    """
    found, words = frequent_phrases(docs, support, **sizes)
    candidates = found.where("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _part(F.lit(1), F.col("k"))).withColumn("rest", _part(F.col("k") + 1, F.col("words") - F.col("k")))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    twice = (_exact("l") + _exact("r")).alias("both")
    score = F.expr("cast(scaled div both as long)")
    scored = cuts.select("*", (_exact("a") * F.lit(SCALE).cast("decimal(7,0)")).alias("scaled"), twice).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = [(length, at) for length in range(2, LONGEST) for at in range(1, LONGEST - length + 2)]
    inside = F.array(
        *(F.when(F.col("words") >= F.lit(at + length - 1), F.when(F.col("words") > F.lit(length), _part(F.lit(at), F.lit(length)))) for length, at in spans)
    )
    longer = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(F.array_compact(inside))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * COVERS)
    )
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= reported)
    return first.join(hinted(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
        SELECT coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents)
), lines AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), numbered AS (
    SELECT row_number() OVER () AS line, lang, words FROM lines WHERE len(words) > 0
), placed AS (
    SELECT line, lang, unnest(words) AS word, unnest(range(len(words))) AS place FROM numbered
), totals AS (
    SELECT lang, count(*) AS n FROM placed GROUP BY lang
), runs AS (
    SELECT lang, word AS w1,
        lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
    FROM placed WINDOW p AS (PARTITION BY line ORDER BY place)
), f AS (
    SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, 1 AS k, w1 AS phrase FROM runs
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
        UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
    ) GROUP BY lang, k, phrase HAVING count(*) >= 30
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1
), cuts AS (
    SELECT lang, phrase, k, a, words, unnest(range(1, k)) AS cut FROM candidates
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, cuts.cut, x.f AS l, y.f AS r,
        (2000000::HUGEINT * cuts.a) // (x.f::HUGEINT + y.f) AS score
    FROM cuts
    JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(words[1:cut], ' ')
    JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
), best AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored
    ) WHERE nth = 1
), kept AS (
    SELECT * FROM best WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = best.lang AND c.phrase <> best.phrase
            AND contains(' ' || c.phrase || ' ', ' ' || best.phrase || ' ')
            AND 100::HUGEINT * c.a >= 80::HUGEINT * best.a)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) JOIN totals USING (lang) WHERE rank <= 2000
"""
