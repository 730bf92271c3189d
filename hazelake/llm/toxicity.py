"""Toxicity: class-conditional Kneser-Ney models compared by length-normalised log-likelihood.

The models are over words. Each class has its own counts of expressions, of documents that hold them, so that one long
text does not decide. What a class has seen too rarely is smoothed by continuation counts, which both classes share: how
many different words an expression follows. An expression speaks for a class only if its counts in the two differ more
than chance would have it; all others are left to the shared counts and say nothing.

Documents are read in runs. A run's pairs of a word and the one before it, with their counts by fold and class, are dealt
out to buckets by the word, so that a bucket sees all counts and all predecessors of its words. What is left of
it, the expressions that speak, grows with the corpus; it is joined to the words of every text as a sorted table.

The mean ratio per word is turned into a probability by a logistic curve. It is fitted on the labelled texts, each
scored by counts of the other folds.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import fold_of, hinted, only, pack, pieces_of, staged, unpack
from hazelake.llm.spans import edges, mixed, span_hashes

DISCOUNT = 0.75
#: Likelihood-ratio statistic from which counts differ by more than chance: one word in a thousand exceeds it by chance.
SPEAKS = 10.83
#: Fold 0 is held out; the curve is fitted by scoring each of the others with the counts of the rest.
FOLDS = 5
#: Width of the steps in which mean ratios are counted for the curve.
STEP = 0.0005
#: Bytes that are looked at together when texts are counted and scored, and bytes of labelled text for each bucket.
RUN_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
#: Bits of a word's hash that tell it from others of its bucket.
KEY_BITS = 32
#: Kinds of labelled documents: ``2 * fold + class``.
KINDS = 2 * FOLDS

# Words are runs of letters and digits; all bytes of other alphabets are letters.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What stands before the first word of a text.
_START = np.uint64(1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts ``data[offset:next offset]``, and the text it stands in."""
    inside = _WORD[data]
    starts, ends = edges(inside)
    border = offsets[1:-1]
    parted = border[(border > 0) & (border < len(data))]
    parted = np.unique(parted[inside[parted] & inside[parted - 1]])  # a text that ends in a word before one that begins so
    starts, ends = np.sort(np.concatenate([starts, parted])), np.sort(np.concatenate([ends, parted]))
    hashes = span_hashes(_LOWER[data], starts, ends)
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def _key(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS - bits)


def _count(batches, bits: int):
    """Per run and bucket of words: words, words before them, kinds of the documents, and how many hold the pair."""
    for batch in batches:
        kinds = np.asarray(batch.column(1)).astype(np.uint64)
        for first, data, offsets in pieces_of(batch.column(0), RUN_BYTES):
            hashes, row = _words(data, offsets)
            before = np.full(len(hashes), _START, np.uint64)
            follows = row[1:] == row[:-1]
            before[1:][follows] = hashes[:-1][follows]
            words, before = _key(hashes, bits), mixed(before) >> np.uint64(32)
            kind = kinds[first + row]
            # A document counts a word once: by the first place it stands at.
            order = np.lexsort((np.arange(len(words)), row, words))
            once = np.zeros(len(words), np.int64)
            if len(order):
                w, r = words[order], row[order]
                once[order[np.concatenate([[True], (w[1:] != w[:-1]) | (r[1:] != r[:-1])])]] = 1
            order = np.lexsort((kind, before, words))
            w, b, k = words[order], before[order], kind[order]
            if not len(w):
                continue
            begin = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (b[1:] != b[:-1]) | (k[1:] != k[:-1])]))
            w, b, k, n = w[begin], b[begin], k[begin], np.add.reduceat(once[order], begin)
            bounds = np.searchsorted(w, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
            low = (w & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
            spans = [(i, x, y) for i, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if y > x]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in spans], pa.int64()),
                    pa.array([pack(np.diff(low[x:y], prepend=np.uint32(0)), b[x:y], k[x:y], n[x:y]) for _, x, y in spans], pa.binary()),
                ],
                names=["bucket", "pairs"],
            )


def word_counts(pairs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words, counts, continuations`` of a bucket: documents of each kind, and different words before each word."""
    parts = [unpack(p) for p in pairs]
    words = np.concatenate([np.cumsum(p[0], dtype=np.uint32) for p in parts])
    before, kind, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    order = np.lexsort((before, words))
    words, before, kind, n = words[order], before[order], kind[order], n[order]
    fresh = np.concatenate([[True], words[1:] != words[:-1]])
    begin = np.flatnonzero(fresh)
    counts = np.zeros((len(begin), KINDS), np.int64)
    np.add.at(counts, (np.cumsum(fresh) - 1, kind), n)
    pair = fresh.copy()
    pair[1:] |= before[1:] != before[:-1]
    return words[begin], counts, np.add.reduceat(pair.astype(np.int64), begin)


def without_fold(counts: np.ndarray, fold: int) -> np.ndarray:
    """Counts by class, without the documents of a fold; fold 0 is held out and so never among them."""
    kept = counts.reshape(*counts.shape[:-1], FOLDS, 2).copy()
    kept[..., fold, :] = 0
    return kept.sum(axis=-2)


def differs(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of the counts of words in both classes against the totals."""
    share = totals / max(totals.sum(), 1)
    expected = counts.sum(axis=1, keepdims=True) * share
    return 2 * np.where(counts > 0, counts * np.log(np.maximum(counts, 1) / np.maximum(expected, 1e-300)), 0).sum(axis=1)


def _speaking(totals: np.ndarray):
    def of_bucket(table: pa.Table) -> pa.Table:
        """The words of a bucket that speak with any fold left out; the first row carries the sums of all its words."""
        words, counts, continuations = word_counts(table["pairs"].to_pylist())
        speaks = np.zeros(len(words), bool)
        for fold in range(FOLDS):
            speaks |= differs(without_fold(counts, fold), without_fold(totals, fold)) >= SPEAKS
        bucket = np.uint64(table["bucket"][0].as_py())
        keys = bucket << np.uint64(KEY_BITS) | words[speaks].astype(np.uint64)
        # What the discount takes from each class, with each fold left out.
        taken = [np.minimum(without_fold(counts, fold), DISCOUNT).sum(axis=0).tolist() for fold in range(FOLDS)]
        row = {
            "keys": keys.astype("<u8").tobytes(),
            "counts": counts[speaks].astype("<i8").tobytes(),
            "continuations": continuations[speaks].astype("<i8").tobytes(),
            "words": len(words),
            "pairs": int(continuations.sum()),
            "taken": [x for pair in taken for x in pair],
        }
        return pa.Table.from_pylist([row], _FOUND)

    return of_bucket


_FOUND = pa.schema(
    [
        ("keys", pa.binary()), ("counts", pa.binary()), ("continuations", pa.binary()),
        ("words", pa.int64()), ("pairs", pa.int64()), ("taken", pa.list_(pa.float64())),
    ]
)


def log_ratios(counts: np.ndarray, continuations: np.ndarray, totals: np.ndarray, taken: np.ndarray, words: int, pairs: int) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary): interpolated Kneser-Ney with shared continuation counts."""
    shared = (continuations + 0.5) / (pairs + 0.5 * (words + 1))
    weight = taken / np.maximum(totals, 1)
    p = np.maximum(counts - DISCOUNT, 0) / np.maximum(totals, 1) + weight * shared[:, None]
    return np.log(p[:, 1]) - np.log(p[:, 0])


class Model:
    """Ratios of the words that speak, and the logistic curve."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray, bits: int, intercept: float = 0.0, slope: float = 0.0):
        speaks = ratios != 0
        self.packed = zstandard.compress(keys[speaks].astype("<u8").tobytes() + ratios[speaks].astype("<f4").tobytes(), 3)
        self.bits, self.intercept, self.slope = bits, intercept, slope

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        data = zstandard.decompress(self.packed)
        n = len(data) // 12
        return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<f4", n, 8 * n)


def _mean_ratios(data: np.ndarray, offsets: np.ndarray, bits: int, tables: list, which: np.ndarray) -> np.ndarray:
    """Mean ratio per word of each text, by the table its row names."""
    hashes, row = _words(data, offsets)
    keys, n = _key(hashes, bits), len(offsets) - 1
    total = np.zeros(n)
    for k, (known, ratios) in enumerate(tables):
        of = np.flatnonzero(which[row] == k) if len(tables) > 1 else np.arange(len(keys))
        if len(known) and len(of):
            at = np.minimum(np.searchsorted(known, keys[of]), len(known) - 1)
            total += np.bincount(row[of], np.where(known[at] == keys[of], ratios[at], 0), minlength=n)
    return total / np.maximum(np.bincount(row, minlength=n), 1)


def _score(batches, models: list[Model]):
    """The last column, a text, becomes its mean ratio; with several models the first column is the number of the row's."""
    tables = [model.table() for model in models]
    for batch in batches:
        which = np.asarray(batch.column(0)) if len(tables) > 1 else np.zeros(batch.num_rows, np.int32)
        means = np.zeros(batch.num_rows)
        for first, data, offsets in pieces_of(batch.column(batch.num_columns - 1), RUN_BYTES):
            rows = len(offsets) - 1
            means[first : first + rows] = _mean_ratios(data, offsets, models[0].bits, tables, which[first : first + rows])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(means)], names=[*batch.schema.names[:-1], "ratio"])


def _fit_curve(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through counts at ``x``, with a weak pull of the slope to zero."""
    scale = max(float(np.abs(x).max()), STEP)
    z, weights = x / scale, positive + negative
    beta = np.array([np.log((positive.sum() + 0.5) / (negative.sum() + 0.5)), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta[0] + beta[1] * z, -30, 30)))
        slope = np.array([(positive - weights * p).sum(), ((positive - weights * p) * z).sum() - 1e-3 * beta[1]])
        w = weights * p * (1 - p)
        bend = np.array([[w.sum() + 1e-6, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 1e-3]])
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1] / scale)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``docs(doc_id, text, …)`` and ``labels(doc_id, toxic, …)``, from labelled rows outside fold 0.

    A document that is labelled several times is toxic if one label says so; labels other than 0 and 1 are ignored. All
    labelled texts are counted. The driver gets the words that speak, one row per bucket, and one row per step of the
    curve.
    """
    fold = fold_of(F.col("doc_id"), FOLDS)
    marks = (
        only(labels, "doc_id", "toxic")
        .where(F.col("toxic").isin(0, 1) & (fold != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    rows = only(docs, "doc_id", "text").join(hinted(marks), "doc_id").withColumn("fold", fold)
    size, toxic, every = rows.agg(F.sum(F.octet_length("text")), F.sum("label"), F.count(F.lit(1))).first()
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    if not toxic or toxic == every:  # nothing to compare
        return Model(*nothing, 0, 0.0 if toxic else -30.0)
    bits = max(4, (-(-(size or 0) // BUCKET_BYTES) - 1).bit_length())
    kinds = rows.select("text", (2 * F.col("fold") + F.col("label")).alias("kind"))
    pairs = staged(kinds.mapInArrow(partial(_count, bits=bits), "bucket long, pairs binary"), "toxicity-pairs")
    totals = np.zeros(KINDS, np.int64)
    for row in pairs.mapInArrow(_totals, "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n")).collect():
        totals[row["kind"]] = row["n"]
    found = pairs.groupBy("bucket").applyInArrow(
        _speaking(totals), "keys binary, counts binary, continuations binary, words long, pairs long, taken array<double>"
    ).collect()
    keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in found] or [nothing[0]])
    counts = np.concatenate([np.frombuffer(r["counts"], "<i8").reshape(-1, KINDS) for r in found] or [np.zeros((0, KINDS))])
    continuations = np.concatenate([np.frombuffer(r["continuations"], "<i8") for r in found] or [nothing[1]])
    words, types = sum(r["words"] for r in found), sum(r["pairs"] for r in found)
    taken = np.sum([r["taken"] for r in found] or [np.zeros(KINDS)], axis=0).reshape(FOLDS, 2)
    order = np.argsort(keys)
    keys, counts, continuations = keys[order], counts[order], continuations[order]
    models = []
    for left_out in range(FOLDS):
        own, of = without_fold(counts, left_out), without_fold(totals, left_out)
        ratios = log_ratios(own, continuations, of, taken[left_out], words, types) if of.all() else np.zeros(len(keys))
        models.append(Model(keys, np.where(differs(own, of) >= SPEAKS, ratios, 0.0), bits))
    step = F.round(F.col("ratio") / STEP).cast("int").alias("step")
    by_step = (
        rows.select("fold", "label", "text")
        .mapInArrow(partial(_score, models=models), "fold int, label int, ratio double")
        .groupBy(step)
        .agg(F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative"))
        .toPandas()
    )
    at, positive, negative = (by_step[c].to_numpy(float) for c in ("step", "positive", "negative"))
    models[0].intercept, models[0].slope = _fit_curve(at * STEP, positive, negative)
    return models[0]


def _totals(batches):
    """How many words the documents of each kind hold, each word once a document."""
    for batch in batches:
        total = np.zeros(KINDS, np.int64)
        for pairs in batch.column(1).to_pylist():
            _, _, kind, n = unpack(pairs)
            total += np.bincount(kind, n, minlength=KINDS).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(KINDS, dtype=np.int32)), pa.array(total)], names=["kind", "n"])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text, …)``.

    ``labels(doc_id, toxic, …)`` teaches through documents outside fold 0 only; a score depends on the text alone. A
    null or empty text has a mean ratio of 0 and so the score of the curve there. Without labels of both kinds every
    score is about 0, or 0.5 if all labels are toxic. Repeated rows are scored each; a null id counts as held out.
    """
    model = learn(docs, labels)
    rows = only(docs, "doc_id", "text").select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "text")
    scored = rows.mapInArrow(
        partial(_score, models=[model]), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, ratio double"
    )
    score = 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.col("ratio"))))
    return scored.withColumn("score", score).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
