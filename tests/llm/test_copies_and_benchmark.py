import random
from itertools import combinations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_data import PROSE, SF_DIR

from pulseframe.llm import components, dart_minhash, decontaminate
from pulseframe.llm.common import WordHashes, table, word_hashes

VOCABULARY = [f"w{n}" for n in range(3000)]


def prose(seed, n):
    pick = random.Random(seed)
    return [pick.choice(VOCABULARY) for _ in range(n)]


def edited(base, seed, changes):
    pick, out = random.Random(seed), list(base)
    for at in pick.sample(range(len(out)), changes):
        out[at] = f"edit{seed}x{at}"
    return out


def text_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- op4


def test_signatures_estimate_weighted_similarity():
    pick, errors = np.random.default_rng(5), []
    for _ in range(60):
        a = pick.integers(0, 2**63, 300).astype("u8")
        b = np.concatenate([a[100:], pick.integers(0, 2**63, 100).astype("u8")])
        wa, wb = pick.integers(1, 6, 300), pick.integers(1, 6, 300)
        left, right = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
        keys = left.keys() | right.keys()
        true = sum(min(left.get(k, 0), right.get(k, 0)) for k in keys) / sum(max(left.get(k, 0), right.get(k, 0)) for k in keys)
        rows = dart_minhash.throw(np.concatenate([a, b]), np.concatenate([wa, wb]), np.repeat([0, 1], 300), 2)
        errors.append((rows[0] == rows[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.04


def test_signatures_do_not_depend_on_the_batch():
    sets = [np.unique(dart_minhash.shingles(word_hashes(" ".join(prose(s, n)), WordHashes())), return_counts=True)
            for s, n in ((1, 6), (2, 60), (3, 3000), (4, 5))]
    alone = [dart_minhash.throw(e, w, np.zeros(len(e), "i8"), 1)[0] for e, w in sets]
    owner = np.repeat(np.arange(4), [len(e) for e, _ in sets])
    both = dart_minhash.throw(np.concatenate([e for e, _ in sets]), np.concatenate([w for _, w in sets]), owner, 4)
    assert (both == np.stack(alone)).all() and not (both == dart_minhash.EMPTY).any()


def test_classes_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.near_duplicates(docs).collect()}
    assert got == brute.classes(rows)


def test_chains_and_groups_of_mutual_strangers(spark):
    """A chain a-b-c whose ends differ, and many edits of one text that are alike only through it or not at all."""
    base, rows = prose(1, 400), []
    chain = [base]
    for k in range(6):
        chain.append(edited(chain[-1], k, 7))
    rows += [(n, " ".join(w)) for n, w in enumerate(chain)]
    family = prose(2, 300)
    rows += [(100 + n, " ".join(edited(family, 50 + n, 9 if n % 2 else 14))) for n in range(60)]
    rows += [(900 + n, " ".join(prose(900 + n, 200))) for n in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.near_duplicates(text_rows(spark, rows)).collect()}
    assert got == brute.classes(rows)
    assert len({got[n] for n in range(7)}) == 1


def test_edge_rows_of_copies(spark, edge_docs, no_docs):
    rows = dart_minhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert got[1] == got[2] == got[7] == {1}
    assert got[5] == got[9] == {5} and got[6] == {5}
    assert got[3] == {3} and got[4] == {4} and got[8] == {8} and got[None] == {None}
    assert dart_minhash.near_duplicates(no_docs).count() == 0
    kept = dart_minhash.without_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, 4, 5, 8, None]
    assert dart_minhash.without_copies(no_docs).count() == 0


def test_rows_with_null_ids_share_the_class_of_their_text(spark):
    rows = [(None, "one two three four five six"), (7, "one two three four five six"), (None, "alone in the world")]
    got = {(r["doc_id"], r["class_id"]) for r in dart_minhash.near_duplicates(text_rows(spark, rows)).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}


def test_texts_outside_all_buckets_are_not_shuffled(spark, monkeypatch):
    """Of texts and signatures only those of buckets' members, and few others, pass the filter before the joins."""
    family = prose(3, 200)
    rows = [(n, " ".join(prose(5000 + n, 30))) for n in range(400)]
    rows += [(1000 + n, " ".join(edited(family, n, 1))) for n in range(5)] + [(None, "no id at all here")]
    passed, plain = [], dart_minhash.in_filter

    def spied(rows, packed, bits):
        found = plain(rows, packed, bits)
        passed.append({r["doc_id"] for r in found.collect()})
        return found

    monkeypatch.setattr(dart_minhash, "in_filter", spied)
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.near_duplicates(text_rows(spark, rows)).collect()}
    assert {got[1000 + n] for n in range(5)} == {1000} and all(got[n] == n for n in range(400))
    assert len(passed) == 2
    for ids in passed:
        assert {1000 + n for n in range(5)} <= ids and len(ids) < 20


def test_components(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 101), (101, 100), (200, 200), (None, 1), (300, 41), (41, 400)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert all(got[n] == 0 for n in range(41))
    assert got[41] == got[300] == got[400] == 41 and got[101] == 100 and got[200] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- op6


def test_overlaps_of_the_table(spark):
    docs, benchmark = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    whole = {(d, i) for d, t in texts for i, x in items if brute.holds(t, x)}
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.overlaps(docs, benchmark).collect()}
    assert whole and set(found) == whole
    by_doc, by_item = dict(texts), dict(items)
    for (d, i), r in found.items():
        assert brute.words(by_doc[d])[r["start"]:r["end"]] == brute.words(by_item[i])
        assert r["equal_words"] == r["item_length"] == len(brute.words(by_item[i]))


@pytest.mark.parametrize(("length", "changes", "part", "expected"), [
    (40, 0, 40, True), (40, 3, 40, True), (20, 2, 20, True), (15, 2, 15, True), (40, 0, 20, True), (60, 8, 60, True),
    (40, 0, 7, False), (40, 30, 40, False), (12, 0, 12, True),
])
def test_substitutions_and_parts(spark, length, changes, part, expected):
    item = prose(length, length)
    docs = [
        (seed, " ".join(prose(1000 + seed, 100) + edited(item[:part], seed, min(changes, part - 1)) + prose(2000 + seed, 100)))
        for seed in range(8)
    ]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"] for r in decontaminate.overlaps(text_rows(spark, docs), benchmark).collect()}
    assert found == ({d for d, _ in docs} if expected else set())


def test_edge_rows_of_the_benchmark(spark, edge_docs, no_docs):
    schema = "item_id long, text string, seed string, item_words string"
    benchmark = spark.createDataFrame(
        [(3, PROSE, "x", "y"), (2, PROSE.upper(), "x", "y"), (4, "", "x", "y"), (5, None, "x", "y"), (6, "tiny", "x", "y"), (None, PROSE, "x", "y")],
        schema,
    )
    found = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontaminate.overlaps(edge_docs, benchmark).collect()}
    n = len(PROSE.split())
    assert found == {(5, 2, 0, n), (6, 2, 0, n), (9, 2, 0, n), (8, 6, 0, 1)}
    kept = decontaminate.without_contaminated(edge_docs, benchmark)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 3, 4, 7, None]
    assert decontaminate.overlaps(no_docs, benchmark).count() == 0
    assert decontaminate.overlaps(edge_docs, benchmark.limit(0)).count() == 0


def test_every_way_to_change_a_fifth_of_the_words_leaves_a_seed():
    for length in range(6, 21):
        item = np.arange(1, length + 1, dtype="u8")
        end, masks = np.array([length]), decontaminate.masks_of(length)
        own = set(zip(*map(np.ndarray.tolist, decontaminate.seeds(item, end, masks)), strict=True))
        for places in combinations(range(length), length // 5):
            text = item.copy()
            text[list(places)] += np.uint64(1000)
            assert own & set(zip(*map(np.ndarray.tolist, decontaminate.seeds(text, end, masks)), strict=True)), (length, places)


def test_overlaps_equal_brute_force_with_substitutions(spark):
    """Items of 6 to 40 words inside longer texts with up to a fifth of their words changed, against all alignments."""
    pick, items, docs = random.Random(3), [], []
    for n in range(60):
        items.append((n, prose(500 + n, 6 + n % 35)))
    for d in range(240):
        item = items[d % 60][1]
        changes = min(d // 60, len(item) // 5 + (d % 7 == 0))
        docs.append((d, prose(9000 + d, pick.randint(0, 30)) + edited(item, d, changes) + prose(19000 + d, pick.randint(0, 30))))

    def agrees(text, item):
        for diagonal in range(1 - len(item), len(text)):
            equal = np.array([0 <= diagonal + k < len(text) and text[diagonal + k] == w for k, w in enumerate(item)])
            if equal.sum() >= 0.8 * len(item) or decontaminate.best_segment(equal)[2] >= 12:
                return True
        return False

    by_word = {}
    for d, text in docs:
        for w in text:
            by_word.setdefault(w, set()).add(d)
    expected = {
        (d, i) for i, item in items for d in set().union(*(by_word.get(w, set()) for w in item)) if agrees(dict(docs)[d], item)
    }
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = decontaminate.overlaps(text_rows(spark, [(d, " ".join(w)) for d, w in docs]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(expected) > 180


def test_rows_without_ids_are_decided_by_their_text(spark):
    item = " ".join(prose(77, 20))
    rows = [(None, "before " + item), (None, "clean text of some words that no item has"), (1, item), (1, "another clean text")]
    benchmark = spark.createDataFrame([(None, item)], "item_id long, text string")
    docs = text_rows(spark, rows).withColumn("__contaminated", F.lit("clash"))
    kept = decontaminate.without_contaminated(docs, benchmark)
    assert sorted(r["text"] for r in kept.collect()) == sorted([rows[1][1], rows[3][1]])
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, benchmark).collect()] == [(1, None)]


def test_the_filter_holds_all_seeds_and_grows_with_them(spark):
    benchmark = spark.createDataFrame([(n, " ".join(prose(n, 40))) for n in range(30)], "item_id long, text string")
    keyed = decontaminate.item_seeds(decontaminate.benchmark_items(benchmark))
    masks, bits = decontaminate.masks_and_bits(keyed)
    assert tuple(masks) == decontaminate.MASKS and bits == 24
    hashes = np.array([r["seed"] for r in keyed.collect()], "i8").view("u8")
    packed = decontaminate.bloom(keyed, bits)
    for k in range(decontaminate.PROBES):
        at = decontaminate.probe(hashes, k, bits)
        assert ((packed[at >> 3] >> (at & 7).astype("u1")) & 1).all()
    assert [decontaminate.filter_bits(n) for n in (0, 1 << 18, (1 << 18) + 1, 1 << 22, 1 << 40)] == [24, 24, 25, 28, 28]


def test_copies_are_decided_by_their_text(spark):
    one, two = " ".join(prose(41, 60)), " ".join(prose(42, 60))
    rows = [(1, one), (2, one), (2, two), (None, two + " more"), (None, "alone as can be"), (None, "alone as can be"), (7, None), (None, "")]
    docs = text_rows(spark, rows).withColumn("__row", F.lit("clash"))
    kept = dart_minhash.without_copies(docs)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(found, key=str) == sorted([(1, one), (2, two), (None, "alone as can be"), (7, None)], key=str)
