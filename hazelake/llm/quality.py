"""Quality: naive Bayes support vectors, a linear hinge-loss model over n-gram indicators scaled by log-count ratios.

A text is read as three sequences: of tokens (words and digits in lower case, and runs of marks), of the shapes of its
bytes, where equal neighbours count once, and of what a token repeats: the one before it, the one before that, both or
neither. Its indicators say which tokens, pairs of tokens, triples of shapes and pairs of repeats occur in it; each
n-gram is one of 2**``BITS`` by a hash. An indicator is scaled by its log-count ratio, the logarithm of how
much oftener texts of label 1 hold it than texts of label 0, counted over all labelled texts. A support vector machine
is fitted on the scaled vectors of a bounded sample by dual coordinate descent: one example after the other gets the
weight that is best with all others kept, until no weight moves.

The margin is turned into a probability by a logistic curve. It is fitted on the margins of one fold under a machine
that was fitted on the others.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import fold_of, hinted, only, pieces_of, staged
from hazelake.llm.spans import followed, span_hashes

BITS = 20
#: Slots whose counts are one value when they are added up.
BLOCK = 1 << 12
#: A document is of quality from this score on.
LEAST_SCORE = 0.3
#: Fold 0 is held out; the curve is fitted on this one.
FOLDS, CURVE_FOLD = 5, 1
#: Bounds of the sample for the machine: texts of each label, and indicators of all of them together.
SAMPLE_TEXTS, SAMPLE_INDICATORS = 4_000, 8_000_000
#: Added to the counts of texts; cost of a margin below 1; passes over the sample at most, and when they may end.
SMOOTHING, COST, PASSES, STILL = 1.0, 1.0, 30, 1e-3
#: Bytes of a text that are looked at together.
RUN_BYTES = 1 << 20

# Classes of bytes: 0 blanks, 1 letters (all bytes of other alphabets among them), 2 digits, else the mark itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:33] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Shapes: classes that tell capitals (3) and other alphabets (4) apart, and line ends (5) from blanks.
_SHAPE = _CLASS.copy()
_SHAPE[65:91], _SHAPE[128:], _SHAPE[10] = 3, 4, 5


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _indicators(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Distinct ``row << BITS | slot`` of the texts ``data[offset:next offset]``."""
    kind = _CLASS[data]
    inner = np.zeros(len(data) + 1, bool)  # where a run of one kind ends: at a change of kind and between texts
    inner[1:-1] = kind[1:] != kind[:-1]
    inner[offsets] = True
    cuts = np.flatnonzero(inner)
    starts, ends = cuts[:-1], cuts[1:]
    token = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[token], ends[token]
    row = row_of_token = np.searchsorted(offsets, starts, side="right") - 1
    one = span_hashes(_LOWER[data], starts, ends)
    found = [row << BITS | _slots(one)]
    if len(one) > 1:
        near = row[1:] == row[:-1]
        found.append((row[1:] << BITS | _slots(followed(one[:-1], one[1:])))[near])
    if len(one) > 3:
        last, other = (one[2:] == one[1:-1]), (one[2:] == one[:-2])
        repeats = (last << 1 | other).astype(np.uint64)
        near = row_of_token[3:] == row_of_token[:-3]
        pairs = followed(repeats[:-1] << np.uint64(2) | repeats[1:], np.uint64(2))
        found.append((row_of_token[3:] << BITS | _slots(pairs))[near])
    shape = _SHAPE[data]
    first = np.ones(len(data), bool)
    first[1:] = shape[1:] != shape[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(first)
    shapes, row = shape[at].astype(np.uint64), np.searchsorted(offsets, at, side="right") - 1
    if len(at) > 2:
        near = row[2:] == row[:-2]
        three = shapes[:-2] << np.uint64(16) | shapes[1:-1] << np.uint64(8) | shapes[2:]
        found.append((row[2:] << BITS | _slots(followed(three, np.uint64(3))))[near])
    return np.unique(np.concatenate(found))


def _rows_of(column):
    """``(first row, rows, distinct row << BITS | slot)`` of a text column, a bounded part of it at a time.

    A very long text is read in parts that overlap at a blank, and its indicators are joined.
    """
    for first, data, offsets in pieces_of(column, RUN_BYTES):
        rows = len(offsets) - 1
        if rows > 1 or len(data) <= 2 * RUN_BYTES:
            yield first, rows, _indicators(data, offsets)
            continue
        parts, start = [], 0
        while start < len(data):
            stop = min(start + RUN_BYTES, len(data))
            while stop < len(data) and _CLASS[data[stop]]:
                stop += 1
            lead = start
            for _ in range(4):  # some tokens and blanks before, for the n-grams across the cut
                while lead and not _CLASS[data[lead - 1]]:
                    lead -= 1
                while lead and _CLASS[data[lead - 1]]:
                    lead -= 1
            part = data[lead:stop]
            parts.append(_indicators(part, np.array([0, len(part)])))
            start = stop
        yield first, 1, np.unique(np.concatenate(parts))


def _count(batches):
    """Per task: in how many texts of each label every slot's indicator stands, in blocks; the slot behind all counts texts."""
    total = np.zeros((2, (1 << BITS) + BLOCK), np.int64)
    for batch in batches:
        labels = np.asarray(batch.column(1))
        total[:, 1 << BITS] += np.bincount(labels, minlength=2)
        for first, rows, found in _rows_of(batch.column(0)):
            of = labels[first : first + rows][found >> BITS]
            for label in range(2):
                total[label] += np.bincount(found[of == label] & ((1 << BITS) - 1), minlength=total.shape[1])
    blocks = [(label, block) for label in range(2) for block in range(total.shape[1] // BLOCK)]
    parts = [total[label, block * BLOCK : (block + 1) * BLOCK] for label, block in blocks]
    held = [i for i, part in enumerate(parts) if part.any()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([blocks[i][0] for i in held], pa.int32()),
            pa.array([blocks[i][1] for i in held], pa.int32()),
            pa.array([zstandard.compress(parts[i].tobytes(), 1) for i in held], pa.binary()),
        ],
        names=["label", "block", "counts"],
    )


def _added(table: pa.Table) -> pa.Table:
    """The counts of one block in all tasks."""
    total = np.zeros(BLOCK, np.int64)
    for counts in table["counts"].to_pylist():
        total += np.frombuffer(zstandard.decompress(counts), np.int64)
    return table.slice(0, 1).set_column(2, "counts", pa.array([zstandard.compress(total.tobytes(), 3)], pa.binary()))


def _slots_of(batches):
    """``mark, label, fold, slots``: the indicators of each text."""
    for batch in batches:
        for first, rows, found in _rows_of(batch.column(3)):
            bounds = np.searchsorted(found, np.arange(rows + 1) << BITS)
            every = (found & ((1 << BITS) - 1)).astype("<i4")
            slots = pa.array([every[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(first, rows) for i in range(3)), slots], names=["mark", "label", "fold", "slots"]
            )


def log_count_ratios(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """log of (share of an indicator among those of label 1) / (the same of label 0), counts smoothed."""
    p, q = ones + SMOOTHING, zeros + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def _scaled(ratios: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The scaled indicators of a text as a vector of length 1."""
    values = ratios[slots]
    return values / max(float(np.sqrt(values @ values)), 1e-12)


def fit_machine(examples: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the scaled indicators and a bias, by dual coordinate descent on the hinge loss.

    ``examples`` are slots, ``labels`` 1 or -1, ``costs`` the upper bounds of the dual variables. The bias is one more
    feature of value 1.
    """
    vectors = [_scaled(ratios, slots) for slots in examples]
    squares = np.array([float(x @ x) + 1 for x in vectors])
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(examples))
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        most = 0.0
        for i in order.permutation(len(examples)).tolist():
            slots, x, y = examples[i], vectors[i], labels[i]
            slope = y * (float(weights[slots] @ x) + bias) - 1
            if (alpha[i] <= 0 and slope >= 0) or (alpha[i] >= costs[i] and slope <= 0):
                continue
            most = max(most, abs(slope))
            before = alpha[i]
            alpha[i] = min(max(before - slope / squares[i], 0), costs[i])
            step = (alpha[i] - before) * y
            weights[slots] += step * x
            bias += step
        if most < STILL:
            break
    return weights, bias


def fit_curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through weighted 0/1 labels, with a weak pull of both to zero."""
    a, b = 0.0, 1.0
    for _ in range(50):
        z = np.clip(a + b * margins, -30, 30)
        p = 1 / (1 + np.exp(-z))
        slope = np.array([(weights * (labels - p)).sum() - 1e-2 * a, (weights * (labels - p) * margins).sum() - 1e-2 * b])
        w = weights * p * (1 - p)
        cross = (w * margins).sum()
        bend = np.array([[w.sum() + 1e-2, cross], [cross, (w * margins * margins).sum() + 1e-2]])
        step = np.clip(np.linalg.solve(bend, slope), -3, 3)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 1e-3))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``mark, label, fold, text`` of the labelled documents outside fold 0."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    marks = (
        only(labels, "doc_id", "quality")
        .where(F.col("quality").isin(0, 1) & (fold != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    rows = only(docs, "doc_id", "text").join(hinted(marks), "doc_id")
    return rows.select(F.xxhash64("doc_id", "text").alias("mark"), "label", fold.alias("fold"), "text")


class Model:
    """What scores a text: the slots' log-count ratios and weights, the bias and the curve."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, bias: float, intercept: float, slope: float):
        tables = np.concatenate([ratios.astype(np.float32), weights.astype(np.float32)])
        self.packed = zstandard.compress(tables.tobytes(), 3)
        self.numbers = bias, intercept, slope


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``docs(doc_id, text, …)`` and ``labels(doc_id, quality, …)``, from labelled rows outside fold 0.

    Counts are over all labelled texts. The machine is fitted on the texts whose hashes come first, up to
    ``SAMPLE_TEXTS`` of each label and ``SAMPLE_INDICATORS`` in all; a text is weighed so that both labels cost alike,
    the curve so that they stand as often as among all. A document labelled twice is of quality 0 if one label says so;
    other labels are ignored. With one label only every score is that label, without any it is 0.5.
    """
    rows = _labelled(docs, labels)
    blocks = rows.select("text", "label").mapInArrow(_count, "label int, block int, counts binary")
    blocks = blocks.groupBy("label", "block").applyInArrow(_added, blocks.schema)
    counts = np.zeros((2, (1 << BITS) + BLOCK))
    for label, block, packed in blocks.toLocalIterator():
        counts[label, block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(zstandard.decompress(packed), np.int64)
    texts, counts = counts[:, 1 << BITS].copy(), counts[:, : 1 << BITS]
    ratios = log_count_ratios(counts[1], counts[0])
    if not texts.all():
        return Model(ratios, np.zeros(1 << BITS), 0.0, 0.0 if not texts.any() else 30.0 if texts[1] else -30.0, 0.0)
    share = [min(1.0, 1.2 * SAMPLE_TEXTS / total + 100 / total) for total in texts]
    near = F.pmod("mark", F.lit(1 << 20)) < F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])) * (1 << 20)
    drawn = rows.where(near)
    marks = staged(drawn.select("mark", "label").distinct(), "sample")
    heads = [marks.where(F.col("label") == k).select("mark").orderBy("mark").limit(SAMPLE_TEXTS) for k in range(2)]
    chosen = drawn.join(F.broadcast(heads[0].union(heads[1]).distinct()), "mark").dropDuplicates(["mark"])
    sample = chosen.mapInArrow(_slots_of, "mark long, label int, fold int, slots binary")
    examples, signs, folds, size = [], [], [], 0
    for _, label, fold, slots in sample.orderBy("mark").toLocalIterator():
        size += len(slots) // 4
        if size > SAMPLE_INDICATORS:
            break
        examples.append(np.frombuffer(slots, "<i4"))
        signs.append(1.0 if label == 1 else -1.0)
        folds.append(fold)
    y = np.array(signs)
    own = np.array([(y < 0).sum(), (y > 0).sum()])
    if not own.all():
        return Model(ratios, np.zeros(1 << BITS), 0.0, 30.0 if texts[1] > texts[0] else -30.0, 0.0)
    balance = len(y) / (2 * own)
    costs = COST * np.where(y > 0, balance[1], balance[0])
    others = np.array(folds) != CURVE_FOLD

    def machine(of: np.ndarray) -> tuple[np.ndarray, float]:
        some = np.flatnonzero(of)
        return fit_machine([examples[i] for i in some], y[some], ratios, costs[some])

    aside = np.flatnonzero(~others)
    if len(set(y[others])) < 2 or len(set(y[aside])) < 2:
        aside, others = np.arange(len(y)), np.ones(len(y), bool)
    weights, bias = machine(others)
    margins = np.array([weights[examples[i]] @ _scaled(ratios, examples[i]) + bias for i in aside])
    prior = texts / texts.sum() * len(y) / own
    curve = fit_curve(margins, (y[aside] > 0).astype(float), np.where(y[aside] > 0, prior[1], prior[0]))
    return Model(ratios, *machine(np.ones(len(y), bool)), *curve)


def _score(batches, packed: bytes, numbers: tuple[float, float, float]):
    """The last column, a text, becomes its score."""
    ratios, weights = np.frombuffer(zstandard.decompress(packed), np.float32).reshape(2, -1).astype(np.float64)
    (bias, intercept, slope), products, squares = numbers, ratios * weights, ratios * ratios
    for batch in batches:
        margins = np.zeros(batch.num_rows)
        for first, rows, found in _rows_of(batch.column(batch.num_columns - 1)):
            row, slots = found >> BITS, found & ((1 << BITS) - 1)
            length = np.sqrt(np.bincount(row, squares[slots], minlength=rows))
            margins[first : first + rows] = np.bincount(row, products[slots], minlength=rows) / np.maximum(length, 1e-12)
        scores = 1 / (1 + np.exp(-np.clip(intercept + slope * (margins + bias), -30, 30)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "score"])


def quality(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text, …)``.

    A score depends on the text alone; ``labels(doc_id, quality, …)`` teaches through documents outside fold 0 only. A null or
    empty text has no indicator, so its score is what the bias says. Repeated rows are scored each; a null id has the
    remainder of the empty text, 0, and so is held out.
    """
    model = learn(docs, labels)
    rows = only(docs, "doc_id", "text").select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "text")
    scored = rows.mapInArrow(
        partial(_score, packed=model.packed, numbers=model.numbers),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double",
    )
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))
