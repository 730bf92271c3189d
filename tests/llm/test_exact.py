"""Operators whose results a few lines of Python can give, over whole tables and odd texts."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from hazelake.llm import decontamination, fm_index, simhash_dedup, substring_dedup, token_shards
from hazelake.llm.common import hinted
from hazelake.llm.decontamination import contamination, decontaminated, overlaps
from hazelake.llm.language_id import accepted
from hazelake.llm.mixing import mixed
from hazelake.llm.token_counts import token_counts

LONG = "word " * 40_000
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a  b\n\n c <|endoftext|> x<|endoftext|>y  <|endoftext|> don't ''s 123abc \x1c\x1d x"),
    (5, "日本語 é́ ΑΣ Σ\x85 \u00a0 naïve"),
    (6, LONG),
    (7, "The same text, twice."),
    (7, "The same text, twice."),
    (None, "without id"),
]


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda x: (x[0] or -1, str(x[1])))


@pytest.fixture(scope="module", params=["table", "odd"])
def docs(request, documents, frame):
    return documents if request.param == "table" else frame(ODD)


def test_token_counts(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = []
    for doc_id, text in pairs(docs):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((doc_id, len((text or "").encode()), n, n > 512))
    found = [tuple(r) for r in token_counts(docs, buckets=5, block_bytes=20_000).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_token_shards(docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, wanted = 0, []
    for doc_id, text in pairs(docs):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        wanted.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in token_shards.token_shards(docs).collect()), key=lambda r: r[1]) == wanted


def test_one_document_is_decoded_alone(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    token_shards.write_shards(documents, path, shard_ids=20_000)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(pairs(documents))
    shards = [r.asDict() for r in spark.read.parquet(path).collect()]
    assert len(shards) > 1
    for shard in shards[:3]:
        k = len(shard["doc_ids"]) // 2
        ids = token_shards.decode_document(shard, k, library.get_vocab_size()).tolist()
        assert ids == [*library.encode(texts[shard["doc_ids"][k]], add_special_tokens=False).ids, 2]


def test_grammar_shrinks_and_comes_back():
    ids = np.array(([5, 6, 7, 8] * 500 + [9] * 501), np.uint16)
    ends = np.zeros(len(ids), bool)
    ends[[999, len(ids) - 1]] = True
    rules, lengths, sequence, ends = token_shards.compress(ids, ends, 100)
    grammar = token_shards.Grammar(rules.tobytes(), lengths.tobytes(), 100)
    assert len(sequence) < 200 and (grammar(sequence) == ids).all() and ends.sum() == 2


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("threshold", [1, 2])
def test_near_texts(docs, threshold):
    rows = [(i, plain_fingerprint(t)) for i, t in pairs(docs)]
    marks = sorted({m for _, m in rows})
    linked = [(a, b) for i, a in enumerate(marks) for b in marks[:i] if (a ^ b).bit_count() <= threshold]
    root = roots(marks, linked)
    least = {}
    for i, m in rows:
        if i is not None:
            least[root[m]] = min(i, least.get(root[m], i))
    wanted = [(i, f"{m:016x}", least.get(root[m])) for i, m in rows]
    found = [tuple(r) for r in simhash_dedup.near_duplicates(docs, threshold).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_anchors_meet_all_close_fingerprints(spark):
    pick = np.random.default_rng(1)
    base = pick.integers(0, 1 << 63, 60)
    near = [int(b) ^ sum(1 << int(i) for i in pick.choice(63, n, replace=False)) for b in base for n in (1, 2, 4)]
    marks = sorted({int(x) for x in base} | set(near))
    classes = spark.createDataFrame([(m,) for m in marks], "bits long")
    for threshold in (0, 1, 2):
        wanted = {(a, b) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= threshold}
        found = [tuple(r) for r in simhash_dedup.links(classes, threshold).collect()]
        assert set(found) == wanted and len(found) == len(wanted)
    with pytest.raises(ValueError):
        simhash_dedup.links(classes, 3)


def test_visitors_of_anchors_are_never_broadcast(spark, documents, plan_of):
    """However few bytes Spark takes the fingerprints for: each of them visits thousands of anchors."""
    pairs = plan_of(simhash_dedup.links(spark.range(1000).toDF("bits")))
    assert "SortMergeJoin" in pairs and "Broadcast" not in pairs
    last = re.search(r"\w+Join", plan_of(simhash_dedup.near_duplicates(documents)))
    assert last[0] == "SortMergeJoin"


def test_sides_that_are_too_long_to_broadcast_are_shuffled(spark, plan_of):
    few, many = spark.range(5), spark.range(50)
    assert "BroadcastHashJoin" in plan_of(many.join(hinted(few, 5), "id"))
    assert "SortMergeJoin" in plan_of(many.join(hinted(few, 4), "id"))


def test_one_text_of_each_group_stays(frame):
    rows = [(1, None), (2, ""), (4, "q w e"), (4, "q w e"), (None, "Q w e"), (5, "a b"), (None, "x y z"), (None, "X y\nz")]
    kept = simhash_dedup.one_per_group(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted((str(r.doc_id), (r.text or "").lower().split()) for r in kept.collect()) == [
        ("1", []),
        ("4", ["q", "w", "e"]),
        ("5", ["a", "b"]),
        ("None", ["x", "y", "z"]),
    ]


def test_each_group_of_a_repeated_id_keeps_a_text(frame):
    rows = [(1, "a b c"), (3, "one two"), (3, "three four"), (3, "A b c"), (4, "three  four"), (5, "one two"), (5, "alone")]
    kept = simhash_dedup.one_per_group(frame(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [
        (1, "a b c"), (3, "one two"), (3, "three four"), (5, "alone")
    ]


def test_near_copies_go_and_others_stay(documents, frame):
    """Of each group that fingerprints at 2 bits link, the document with the smallest id stays."""
    base = [f"w{i}" for i in range(400)]
    rows = [(100_000 + k, " ".join(base[: 400 - k])) for k in range(5)] + pairs(documents)
    marks = {i: plain_fingerprint(t) for i, t in rows}
    linked = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 2]
    found = [r.doc_id for r in simhash_dedup.one_per_group(frame(rows)).collect()]
    assert sorted(found) == sorted(set(roots(marks, linked).values()))


def test_stages_keep_columns_of_any_name(spark):
    """Names that operators add, with dots, and twice: rows come through whole."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "_copy", "_source", "_bits", "found_id", "a.b", "Doc_Id", "score", "root"]
    words = "the people of this country and the house were there with all that they had "
    rows = [(i, f"{words} {i} " * 4, "en", "s", i, f"c{i}", i, i, i, f"d{i}", f"e{i}", f"f{i}", f"g{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, [f"n{i}" for i in range(len(names))]).toDF(*names)
    benchmark = spark.createDataFrame([(1, "nothing of the kind stands anywhere")], "item_id long, text string")
    for stage in (accepted, simhash_dedup.one_per_group, lambda d: decontaminated(d, benchmark), mixed):
        kept = stage(docs)
        assert kept.columns == names
        found = [tuple(r) for r in kept.collect()]
        assert found and set(found) <= set(rows)


@pytest.mark.parametrize("run", [1, 5, 256])
def test_overlaps_do_not_depend_on_runs(spark, frame, monkeypatch, run):
    pick = np.random.default_rng(7)
    items = [[f"i{n}w{k}" for k in range(n)] for n in (3, 8, 11, 12, 13, 30, 60)]
    rows = []
    for i in range(80):
        words = [f"x{pick.integers(40)}" for _ in range(int(pick.integers(1, 700)))]
        for item in (items[k] for k in pick.choice(len(items), 2)):
            at, some = int(pick.integers(len(words) + 1)), item[: int(pick.integers(len(item) // 2, len(item) + 1))]
            if some and i % 3 == 0:
                some[int(pick.integers(len(some)))] = "other"
            words[at:at] = some
        rows.append((i, " ".join(words)))
    benchmark = spark.createDataFrame([(len(x), " ".join(x)) for x in items], "item_id long, text string")
    monkeypatch.setattr(decontamination, "RUN", 1 << 20)
    wanted = sorted(tuple(r) for r in overlaps(frame(rows), benchmark).collect())
    monkeypatch.setattr(decontamination, "RUN", run)
    assert sorted(tuple(r) for r in overlaps(frame(rows), benchmark).collect()) == wanted
    assert {i for _, i in wanted} == {len(x) for x in items} and 40 < len(wanted) < 160


def test_a_long_document_full_of_hits(spark, frame):
    """A hit has the words around it with it: with the whole document each, these would be over 20 GB in one task."""
    item = " ".join(f"w{i}" for i in range(40))
    benchmark = spark.createDataFrame([(7, item), (8, "nothing of the kind stands anywhere")], "item_id long, text string")
    found = contamination(frame([(1, f"{item} " * 750), (2, "a b c")]), benchmark)
    assert sorted(tuple(r) for r in found.collect()) == [(1, True, 1, 7), (2, False, 0, None)]


def plain_substring_dedup(rows):
    seen, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").split()
        gone = set()
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if seen.setdefault(window, (doc_id, s)) != (doc_id, s):
                gone.update(range(s, s + 20))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("most_of_one", [4096, 1])
def test_substring_dedup(frame, documents, monkeypatch, most_of_one):
    monkeypatch.setattr(substring_dedup, "MOST_OF_ONE", most_of_one)
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, t) for i, t in pairs(documents)][:120]
    rows += [(10_000 + i, f"{i} x {passage} y {i * 7} " + ("z " * 60 if i % 3 else "")) for i in range(30)]
    rows += [(20_000, None), (20_001, ""), (20_002, "short text")]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame(rows)).collect()}
    assert found == plain_substring_dedup(rows)


def test_substring_dedup_of_equal_and_unnamed_rows(frame):
    text = " ".join(map(str, range(30)))
    rows = [(5, text), (5, text), (6, text + " x"), (None, None)]
    found = substring_dedup.without_repeats(frame(rows))
    assert sorted((str(r.doc_id), r.n_removed) for r in found.collect()) == [("5", 0), ("5", 0), ("6", 30), ("None", 0)]


def test_fm_index_counts_patterns():
    text = np.array([*np.random.default_rng(3).integers(1, 4, 400), 0])
    index = fm_index.FMIndex(text)
    starts = np.arange(390)
    low, high = index.intervals(text, starts, 5)
    windows = [tuple(text[s : s + 5]) for s in starts]
    everywhere = [tuple(text[s : s + 5]) for s in range(397)]
    assert (high - low).tolist() == [everywhere.count(w) for w in windows]
    assert len(set(low.tolist())) == len(set(windows))


def test_empty_tables(frame):
    empty = frame(ODD).limit(0)
    assert token_counts(empty).count() == 0
    assert token_shards.token_shards(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert simhash_dedup.one_per_group(empty).count() == 0
    assert substring_dedup.substring_dedup(empty).count() == 0
