"""Collocations, manifest and quality against brute force, on odd rows and on held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import oracle
from hazelake.llm import collocations as collocations_module
from hazelake.llm.collocations import COLLOCATIONS_SQL, collocations, frequent_phrases
from hazelake.llm.manifest import (
    MANIFEST_SQL,
    append_log,
    audit,
    fold,
    height_of,
    path_in,
    position,
    siblings,
)
from hazelake.llm.quality import fit_machine, log_count_ratios, quality
from hazelake.llm.spans import edges, span_hashes

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# --- spans ---


def test_span_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abc  abc x " + b"y" * 1_200_000 + b" abc", np.uint8)
    starts, ends = edges(data != 32)
    hashes = span_hashes(data, starts, ends)
    assert hashes[0] == hashes[1] == hashes[-1]
    assert len(set(hashes.tolist())) == 3
    assert len(span_hashes(data[:0], starts[:0], ends[:0])) == 0


# --- collocations ---


def phrases_by_brute_force(rows):
    counts, words_of = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return counts, words_of


def collocations_by_brute_force(rows, support, reported):
    counts, words_of = phrases_by_brute_force(rows)
    frequent = {key: n for key, n in counts.items() if n >= support}
    out = []
    for lang in words_of:
        kept = []
        for (of, words), a in frequent.items():
            if of != lang or len(words) == 1:
                continue
            cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            inside = any(
                g == lang and len(longer) > len(words) and 100 * f >= 80 * a
                and any(longer[i : i + len(words)] == words for i in range(len(longer)))
                for (g, longer), f in frequent.items()
            )
            if not inside:
                phrase = " ".join(words)
                kept.append((-score, -a, phrase.encode(), phrase, counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(kept)[:reported], 1):
            out.append((lang, rank, phrase, -a, left, right, words_of[lang], -score))
    return sorted(out)


def odd_texts():
    rng = random.Random(5)
    words = ["Ab", "ab", "cé", "日本", "x", "y z", "\x01", "long" * 30]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", "\t", "  ", ". ", "\n", ", ", " ", " "]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), (" . \n", "fr"), ("Ab cé x y " * 50, "en"), ("Ab cé x y " * 50, "en")]


@pytest.mark.parametrize("run_bytes", [300, 1 << 20])
def test_collocations_equal_brute_force(spark, run_bytes):
    rows = odd_texts()
    docs = spark.createDataFrame([(i, t, g, "s", 1, "x") for i, (t, g) in enumerate(rows)], SCHEMA + ", phrase string")
    found = collocations(docs.repartition(3), support=5, reported=7, run_bytes=run_bytes, bucket_bytes=1000)
    assert sorted(map(tuple, found.collect())) == collocations_by_brute_force(rows, 5, 7)


def test_frequent_phrases_and_words_of_languages(spark):
    rows = odd_texts()
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g) in enumerate(rows)], SCHEMA)
    found, words = frequent_phrases(docs.repartition(4), support=3, run_bytes=200, bucket_bytes=500)
    counts, words_of = phrases_by_brute_force(rows)
    expected = {(g, " ".join(w)): n for (g, w), n in counts.items() if n >= 3}
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == expected
    assert {r.lang: r.n for r in words.collect()} == {g: n for g, n in words_of.items() if n}


def test_a_full_table_of_marks_changes_nothing(spark, monkeypatch):
    """Every phrase passes for a frequent one; the counts by words leave the right ones."""
    monkeypatch.setattr(collocations_module, "MARK_BITS", 5)
    monkeypatch.setattr(collocations_module, "MOST_BITS", 5)
    rows = odd_texts()
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g) in enumerate(rows)], SCHEMA)
    found = collocations(docs, support=5, reported=7)
    assert sorted(map(tuple, found.collect())) == collocations_by_brute_force(rows, 5, 7)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0)], SCHEMA)).collect() == []


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits in the arithmetic of scores."""
    a, both = 9 * 10**15, 19 * 10**15 + 1
    score = spark.sql(
        f"select cast(cast({a} as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast({both} as decimal(20,0))) as long) x"
    ).first()[0]
    assert score == 2_000_000 * a // both


# --- manifest ---


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def manifest_by_brute_force(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    langs = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([x[2] for x in sorted(by_lang[g], key=lambda x: x[:3])]) for g in langs]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for place, (g, tree) in enumerate(zip(langs, trees, strict=True)):
        for i, (_, _, leaf, row) in enumerate(sorted(by_lang[g], key=lambda x: x[:3])):
            found, at = [], i
            crc = zlib.crc32(b"" if row[0] is None else str(row[0]).encode())
            node = leaf_of(*row[:4], row[4] + 1) if crc % 7 == 0 and row[4] is not None else leaf
            for levels, start in ((tree, i), (top, place)):
                at = start
                for level in levels[:-1]:
                    pair = [node if j == at else level[j] for j in range(at & ~1, min((at & ~1) + 2, len(level)))]
                    found += [level[j] for j in range(at & ~1, min((at & ~1) + 2, len(level))) if j != at]
                    node, at = h(*pair), at >> 1
            root = top[-1][0]
            out.append((row[0], leaf, tree[-1][0], root, h(*found), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33])
def test_postorder_positions_and_paths(leaves):
    hashes = [hashlib.sha256(bytes([i])).digest() for i in range(leaves)]
    height, levels = height_of(leaves), levels_of([x.hex() for x in hashes])
    log = append_log(hashes, height)
    assert len(log) == sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for index, node in enumerate(nodes):
            assert log[position(level, index, leaves)].hex() == node
    for i, leaf in enumerate(hashes):
        path = path_in(b"".join(log), i, leaves, height)
        assert fold(leaf, path).hex() == levels[-1][0]
        assert fold(hashes[0] + b"x", path).hex() != levels[-1][0]
        assert len(siblings(path)) <= height


def manifest_rows():
    rng = random.Random(3)
    rows = [(i, f"text {i}" * rng.randint(0, 3), rng.choice(["en", "de", "é", None]), "s", rng.choice([i, None])) for i in range(0, 150, 2)]
    rows += [(None, None, None, None, None), (None, "a", "en", "s", 3), (8, "other", "en", "s", 5), (8, "other", "en", "s", 5)]
    return rows + [(-5, "alone", "zz", None, 1), (10**15, "日本 \x00 text", "en", "", 0)]


@pytest.mark.parametrize("levels", [1, 2, 3, 10])
def test_manifest_equals_brute_force(spark, levels):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, b"x", 1) for r in rows], SCHEMA + ", hash binary, number int").repartition(5)
    found = audit(docs, levels=levels)
    assert sorted(map(tuple, found.collect()), key=repr) == manifest_by_brute_force(rows)


def test_manifest_of_many_groups_and_of_nothing(spark):
    rows = [(i, "t", f"g{i % 37}", "s", i) for i in range(80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, audit(docs, levels=2).collect()), key=repr) == manifest_by_brute_force(rows)
    assert audit(spark.createDataFrame([], SCHEMA)).collect() == []
    one = audit(spark.createDataFrame([(3, "t", "en", "s", 1)], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h()


@pytest.mark.parametrize(("query", "sql"), [(audit, MANIFEST_SQL), (collocations, COLLOCATIONS_SQL)])
def test_queries_equal_sql(spark, documents, query, sql):
    connection = oracle.connect(SF_DIR)
    assert oracle.spark_rows(query(documents)) == oracle.sql_rows(connection, sql)


# --- quality ---


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality(docs, labels)
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    low = [r for r in rows if r.quality == 0]
    assert sum(r.predicted == 0 for r in low) >= 0.8 * len(low) > 0
    high = [r for r in rows if r.quality == 1]
    assert sum(r.predicted == 1 for r in high) >= 0.98 * len(high)
    assert scored.count() == docs.count()


def test_quality_ignores_held_out_labels_and_extra_columns(spark, frame):
    texts = [(i, f"good text number {i} here" if i % 2 else f"bad !!! ### {i} $$$") for i in range(60)]
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = frame(texts)
    labels = spark.createDataFrame([(i, i % 2, 0, "t") for i, _ in texts], "doc_id long, quality int, toxic int, text string")
    lies = spark.createDataFrame([(i, (i + (i in held)) % 2, 1, "t") for i, _ in texts], labels.schema)
    first = {r.doc_id: r for r in quality(docs, labels).collect()}
    second = {r.doc_id: r for r in quality(docs, lies).collect()}
    assert first == second
    assert {i for i, r in first.items() if r.held_out} == set(held)
    assert all(r.predicted == i % 2 for i, r in first.items())


def test_quality_of_odd_rows(spark, frame):
    texts = [(i, "fine words here" if i % 2 else "!!! ###") for i in range(40)]
    odd = [(None, "fine words here"), (100, None), (101, ""), (102, "a " * 900_000), (103, "x" * 2_500_000), (1, "fine words here")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (1, 1), (3, 7), (None, 1)], "doc_id long, quality int")
    rows = quality(frame(texts + odd), labels).collect()
    assert len(rows) == 46 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[100].score == by_id[101].score and by_id[None].held_out
    none = labels.where("doc_id < 0")
    assert {r.score for r in quality(frame(texts), none).collect()} == {0.5}
    assert all(r.predicted == 1 for r in quality(frame(texts), labels.where("quality = 1")).collect())
    assert quality(frame(texts).where("doc_id < 0"), labels).collect() == []


def test_long_texts_have_the_indicators_of_their_parts(spark, frame, monkeypatch):
    from hazelake.llm import quality as module
    import pyarrow as pa

    text = "".join(random.Random(1).choice(["ab ", "AB! ", "12\n", "é, ", "ab ab ab "]) for _ in range(2000))
    (whole,) = [found for _, _, found in module._rows_of(pa.array([text]))]
    monkeypatch.setattr(module, "RUN_BYTES", 500)
    (parts,) = [found for _, _, found in module._rows_of(pa.array([text]))]
    assert whole.tolist() == parts.tolist()


def test_machine_is_optimal():
    """The dual variables' conditions hold: the margin problem is solved, not only improved."""
    rng = np.random.default_rng(2)
    ratios = log_count_ratios(rng.integers(0, 9, 30).astype(float), rng.integers(0, 9, 30).astype(float))
    examples = [np.unique(rng.integers(0, 30, 6)) for _ in range(40)]
    y = np.where(rng.random(40) < 0.5, 1.0, -1.0)
    weights, bias = fit_machine(examples, y, ratios, np.ones(40))
    x = np.zeros((40, 31))
    for i, slots in enumerate(examples):
        values = ratios[slots]
        x[i, slots], x[i, 30] = values / np.sqrt(values @ values), 1
    w = np.append(weights, bias)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()

    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(0, 0.01, 31)) >= best - 1e-2
