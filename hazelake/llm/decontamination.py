"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is a fixed mask over ``SPAN`` consecutive words that ignores some of them. Every window of a benchmark item and of
a document is hashed once per mask over the words that the mask looks at; equal hashes are hits, whatever stands at
the ignored places. The three masks ignore every place of the span once, so a window with any one word replaced still
hits. A hit is verified on the words themselves: around it, both texts must agree in ``MIN_EQUAL`` aligned words.

An item of at most ``SPAN`` words is one window of its own length. From ``TOLERANT`` words on, one of them may be replaced;
a shorter item must stand whole. Scripts without blanks have a word per character.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import BROADCAST_ROWS, checkpointed, hinted, on_plain_names, only

SPAN = 12
#: Places of the span that each mask ignores.
IGNORED = ((1, 4, 7, 10), (2, 5, 8, 11), (0, 3, 6, 9))
#: Words on both sides of a hit that are compared too, and how many must agree in all.
FLANK, MIN_EQUAL = 6, 12
#: Hashes of benchmark windows that are broadcast at a time; a larger benchmark takes several passes.
KEYS_PER_PASS = BROADCAST_ROWS
#: Bytes of their rows, estimated, that are broadcast at a time.
BYTES_PER_PASS = 128 << 20
#: Words from which on a short item may differ in one.
TOLERANT = 8
#: Windows of a document that are looked up in one go. All hits of a run are in memory at once.
RUN = 256
#: Longer words are compared by their SHA-256, so that a row of the benchmark is bounded.
LONG_WORD = 64
#: Blocks of scripts that put no blanks between words: Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"
WORD = rf"[[{UNSPACED}]&&[\p{{L}}\p{{N}}]]\p{{M}}*|[[\p{{L}}\p{{N}}]&&[^{UNSPACED}]]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; single letters, with their marks, of scripts without blanks."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _windows(df: DataFrame, shortest: int = SPAN) -> DataFrame:
    """A row for each ``at`` of ``df(id, words)`` from which on there are so many words."""
    hashed = df.where(F.size("words") >= shortest).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - shortest)))


def _run_windows(docs: DataFrame, shortest: int) -> DataFrame:
    """Like :func:`_windows` for ``docs(doc_id, words)``, but ``words`` are those of a run and ``FLANK`` around it.

    The generated code holds the rows that it makes of one row until it has made them all. So a long document is dealt
    out first, by an expression that Spark evaluates row by row; a run has all the words that its windows are hashed and
    compared on.
    """
    starts = F.sequence(F.lit(0), F.size("words") - shortest, F.lit(RUN))

    def run(start: Column) -> Column:
        lead = F.least(start, F.lit(FLANK))
        return F.struct(lead.alias("lead"), F.slice("words", start - lead + 1, FLANK + RUN + SPAN + FLANK).alias("words"))

    runs = docs.select("doc_id", F.inline(F.when(F.size("words") >= shortest, F.transform(starts, run))))
    hashed = runs.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    last = F.least(F.col("lead") + (RUN - 1), F.size("words") - shortest)
    return hashed.withColumn("at", F.explode(F.sequence("lead", last)))


def _places(length: int) -> list[list[int]]:
    """What each mask of a window of so many words looks at; all words of one that must stand whole."""
    if length < TOLERANT:
        return [list(range(length))]
    return [[i for i in range(length) if i not in ignored] for ignored in IGNORED]


def _hashes(length: int) -> list[Column]:
    """One hash per mask of the window of so many words at ``at``."""
    return [
        F.xxhash64(F.lit(mask + len(IGNORED) * (SPAN - length)), *(F.get("hashes", F.col("at") + i) for i in places))
        for mask, places in enumerate(_places(length))
    ]


def _keys(lengths: list[int]) -> Column:
    """The hashes of the windows of these lengths at ``at``; null where the text ends before."""
    fits = {length: F.col("at") + length <= F.size("words") for length in lengths}
    if len(lengths) == 1:
        return F.array(*_hashes(lengths[0]))
    return F.array(*(F.when(fits[length], key) for length in lengths for key in _hashes(length)))


def _comparable(word: Column) -> Column:
    return F.when(F.length(word) > LONG_WORD, F.sha2(word, 256)).otherwise(word)


def _items(benchmark: DataFrame) -> DataFrame:
    return only(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("words"))


def _short_lengths(benchmark: DataFrame) -> list[int]:
    """Lengths of the items that are shorter than the span."""
    size = F.size("words")
    found = _items(benchmark).where((size > 0) & (size < SPAN)).select(size.alias("n")).distinct().collect()
    return sorted(row.n for row in found)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, key, item_at, around, least`` for each mask and window of every item.

    ``around`` are the words from ``FLANK`` before the window to ``FLANK`` after the span, null where the item has none, and
    ``least`` is how many of them must agree.
    """
    none = F.lit(None).cast("string")
    around = F.concat(
        F.array_repeat(none, FLANK), F.transform("words", _comparable), F.array_repeat(none, SPAN + FLANK)
    )
    size = F.size("words")
    least = F.when(size > SPAN, MIN_EQUAL).when(size >= TOLERANT, size - 1).otherwise(size)
    rows = _items(benchmark).withColumns({"padded": around, "least": least})
    parts = []
    for length in [SPAN, *_short_lengths(benchmark)]:
        of_length = rows.where(size >= SPAN if length == SPAN else size == length)
        parts.append(
            _windows(of_length, length).select(
                "item_id",
                F.col("at").alias("item_at"),
                F.slice("padded", F.col("at") + 1, SPAN + 2 * FLANK).alias("around"),
                "least",
                F.explode(_keys([length])).alias("key"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, keys_per_pass: int = KEYS_PER_PASS, bytes_per_pass: int = BYTES_PER_PASS
) -> DataFrame:
    """``doc_id, item_id`` once for each verified overlap of ``docs(doc_id, text)`` with ``benchmark(item_id, text)``.

    The keys of the benchmark and their bytes are counted, and broadcast in parts of bounded size, one pass over ``docs``
    for each. A key has the few words around its window with it, not the item, and so has a hit those of the document.
    """
    keys = benchmark_windows(benchmark).distinct()
    size = 64 + 16 * F.size("around") + F.octet_length(F.array_join("around", ""))
    count, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    passes = max(1, -(-count // keys_per_pass), -(-total // bytes_per_pass))
    lengths = [*_short_lengths(benchmark), SPAN]
    rows = only(docs, "doc_id", "text").select("doc_id", words(F.col("text")).alias("words"))
    windows = _run_windows(rows, lengths[0]).select("doc_id", "words", "at", F.explode(_keys(lengths)).alias("key"))
    windows = windows.where("key is not null")
    share = F.pmod(F.xxhash64("key", F.lit(passes)), F.lit(passes))
    hits = reduce(
        DataFrame.unionByName, (windows.join(F.broadcast(keys.where(share == i)), "key") for i in range(passes))
    )
    own = F.array(*(F.get("words", F.col("at") + i) for i in range(-FLANK, SPAN + FLANK)))
    hits = hits.select("doc_id", "item_id", "around", "least", own.alias("own"))
    equal = F.size(
        F.filter(
            F.sequence(F.lit(0), F.lit(SPAN + 2 * FLANK - 1)),
            lambda i: _comparable(F.get("own", i)) == F.get("around", i),
        )
    )
    # As an aggregate the comparison stays above the join, which then runs in the generated code of the windows.
    best = hits.groupBy("doc_id", "item_id").agg(F.max(equal - F.col("least")).alias("beyond"))
    return checkpointed(best.where(F.col("beyond") >= 0).select("doc_id", "item_id"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, first_item`` of every row of ``docs``.

    ``n_items`` counts the benchmark items that the document overlaps with, ``first_item`` is the smallest of them. Rows
    with the same id share their findings, null being one id. Null and empty texts and items overlap with
    nothing; a short item marks each text that it stands in. Items are told apart by id; rows of one id are one item,
    also for a null id.
    """
    found = (
        overlaps(docs, benchmark)
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("first_item"), F.lit(True).alias("hit"))
    )
    found = found.withColumnRenamed("doc_id", "found_id")
    return (
        only(docs, "doc_id")
        .join(hinted(found), F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
        .select(
            "doc_id",
            F.coalesce("hit", F.lit(False)).alias("contaminated"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            "first_item",
        )
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that overlap with the benchmark, unchanged; further columns may have any names."""

    def clean(rows: DataFrame) -> DataFrame:
        found = overlaps(rows, benchmark).select(F.col("doc_id").alias("found_id")).distinct()
        return rows.join(hinted(found), rows["doc_id"].eqNullSafe(F.col("found_id")), "left_anti")

    return on_plain_names(docs, ("doc_id", "text"), clean)


#: The same in SQL, on the words instead of their hashes.
CONTAMINATION_SQL = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS ws
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS ws
  FROM benchmark
), dw AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - {SPAN} + 2)) AS p FROM d
), bw AS (
  SELECT item_id, ws, unnest(range(1, len(ws) - {SPAN} + 2)) AS q FROM b
), masks AS (
  SELECT * FROM (VALUES {", ".join(f"({m}, {[i for i in range(SPAN) if i not in out]})" for m, out in enumerate(IGNORED))}) AS v(m, places)
), dk AS (
  SELECT doc_id, ws, p, m, array_to_string(list_transform(places, lambda i: ws[p + i]), ' ') AS k FROM dw, masks
), bk AS (
  SELECT item_id, ws AS bs, q, m, array_to_string(list_transform(places, lambda i: ws[q + i]), ' ') AS k FROM bw, masks
), hits AS (
  SELECT doc_id, item_id FROM dk JOIN bk USING (m, k)
  WHERE len(list_filter(range(-{FLANK}, {SPAN + FLANK}), lambda i: p + i >= 1 AND q + i >= 1
    AND p + i <= len(ws) AND q + i <= len(bs) AND ws[p + i] = bs[q + i])) >= {MIN_EQUAL}
), found AS (
  SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item FROM (SELECT DISTINCT * FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, f.n_items IS NOT NULL AS contaminated, coalesce(f.n_items, 0) AS n_items, f.first_item
FROM documents d LEFT JOIN found f ON d.doc_id IS NOT DISTINCT FROM f.doc_id
"""
