"""Near-duplicate documents: DartMinHash signatures, banded joining, exact verification, classes.

A document is the multiset of its five-word shingles; similarity is the weighted Jaccard index, the sum of smaller
counts over the sum of larger ones. DartMinHash throws darts at the (weight, rank) plane of every shingle. The plane is
cut into dyadic regions; how many darts a region holds and where they land follow from a hash of shingle and region, so
two documents see the same darts. A dart below the shingle's weight counts for one of ``COORDINATES`` coordinates, and
each coordinate keeps its dart of the lowest rank. Regions are thrown from the lowest ranks upwards until every
coordinate has a dart, about COORDINATES * ln COORDINATES darts whatever the length of the document. Two documents agree in a
coordinate with the probability of their similarity.

``BANDS`` bands of ``ROWS`` coordinates miss a pair of similarity 0.8 with probability (1 - 0.8^8)^50 = 1e-4 and a pair
of 0.9 with 4e-13. Within a band's bucket no pairs of members are listed. First every member is compared exactly with the
bucket's smallest member, its pivot, and what is similar is connected. Then only links between different classes of a
bucket matter. They are looked for in blocks of at most ``BLOCK`` members a side, inside the tasks: pairs of different
classes whose distances to the pivot differ by 0.2 at most (the weighted Jaccard distance is a metric) and whose signatures
agree in a share of ``LIKELY`` coordinates, which a pair of similarity 0.8 misses with probability 2e-4, are compared
exactly, and links go out. A bucket of M members in different classes costs comparisons of signatures, and M times M / ``BLOCK``
rows with their element sets; its tasks hold two blocks each.

Defined cases: words are lower-case runs of letters, digits and underscores; texts with the same words are copies (one
node, so copies cost nothing after the first shuffle); a text of one to four words is one shingle; NULL and empty texts
have no words and are copies of each other. Every input row gives an output row. A row with a NULL id gets the class of
its text, which is NULL if no other id has the text. Texts whose smallest ids are the same share a class. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pulseframe.llm.common import WordHashes, map_texts, mix, slices, word_hashes
from pulseframe.llm.components import components
from pulseframe.llm.decontaminate import PROBES, bloom, probe
from pulseframe.sources.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 50, 8
COORDINATES = BANDS * ROWS
# Ranks are fixed-point numbers of 58 fractional bits. Region 0 of the ranks ends at 2^-14, each further one doubles.
RANK_BITS, BASE = 58, 14
LEVELS = BASE + 5
# Links between classes: members of a block, and the least share of equal coordinates (one byte of each is kept).
BLOCK = 512
LIKELY = 0.73
# Bits per id of the filter that leaves texts outside all buckets out of the shuffles, and its size as a power of two.
BITS_PER_ID = 16
LEAST_FILTER_BITS, MOST_FILTER_BITS = 20, 28
# Documents and shingles that are thrown at once.
DOCS_AT_ONCE, SHINGLES_AT_ONCE = 128, 30_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles in order; fewer words give one shingle, none give none."""
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, "u8")
    for k in range(size):
        total = mix(total * GOLDEN + words[k:len(words) - size + 1 + k])
    return total


@lru_cache(maxsize=256)
def poisson_steps(mean: float) -> np.ndarray:
    """The distribution function of a Poisson number, up to where it is 1 in double precision."""
    top = int(mean + 12 * mean ** 0.5 + 24)
    return np.minimum(1.0, np.cumsum([exp(n * log(mean) - mean - lgamma(n + 1)) for n in range(top)]))


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Signatures (``count`` rows of ``COORDINATES`` ranks) of the weighted sets whose elements belong to ``owner``.

    A set without elements has a row of ``EMPTY``.
    """
    lowest = np.full(count * COORDINATES, EMPTY, "u8")
    for level in range(LEVELS + 1):
        bits = RANK_BITS - BASE + max(0, level - 1)  # the region's height is 2^bits in fixed point
        floor = np.uint64(0 if level == 0 else 1 << bits)
        height = 2.0 ** (bits - RANK_BITS)
        stripe, low = 0, 0
        inside = np.arange(len(elements))
        while len(inside):
            width = 1 if stripe == 0 else 1 << (stripe - 1)
            region = mix(elements[inside] + np.uint64((level * 64 + stripe + 1) * int(GOLDEN) & int(EMPTY)))
            steps = poisson_steps(COORDINATES * height * width)
            darts = np.searchsorted(steps, (region >> np.uint64(11)).astype("f8") * 2.0 ** -53, side="right")
            of = np.repeat(np.arange(len(inside)), darts)
            number = (np.arange(len(of)) - np.repeat(np.cumsum(darts) - darts, darts)).astype("u8")
            first = mix(region[of] + (number + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
            second = mix(first ^ GOLDEN)
            at = inside[of]
            if stripe:
                third = (mix(second ^ GOLDEN) >> np.uint64(11)).astype("f8") * 2.0 ** -53
                below = low + third * width < weights[at]
                at, first, second = at[below], first[below], second[below]
            place = owner[at] * COORDINATES + (((first >> np.uint64(32)) * np.uint64(COORDINATES)) >> np.uint64(32)).astype("i8")
            np.minimum.at(lowest, place, floor + (second >> np.uint64(64 - bits)))
            low += width
            stripe += 1
            inside = inside[weights[inside] > low]
        unfilled = (lowest.reshape(count, COORDINATES) == EMPTY).any(axis=1)[owner]
        if not unfilled.any():
            break
        elements, weights, owner = elements[unfilled], weights[unfilled], owner[unfilled]
    return lowest.reshape(count, COORDINATES)


def bands(signatures: np.ndarray) -> np.ndarray:
    """One hash per band, different for equal ranks in different bands."""
    cut = signatures.reshape(len(signatures), BANDS, ROWS)
    total = np.broadcast_to(np.arange(BANDS, dtype="u8"), cut.shape[:2]).copy()
    for row in range(ROWS):
        total = mix(total * GOLDEN + cut[:, :, row])
    return total


def sketched(
    texts: list[str | None], cache: WordHashes
) -> tuple[list[bytes], list[np.ndarray | None], list[bytes | None]]:
    """Of every text a digest of its words, its band hashes and the lowest byte of each coordinate (None without words)."""
    words = [word_hashes(t, cache) for t in texts]
    keys = [xxhash.xxh3_128_digest(w.tobytes()) for w in words]
    out: list[np.ndarray | None] = [None] * len(texts)
    low: list[bytes | None] = [None] * len(texts)
    sets: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if sets:
            owner = np.repeat(np.arange(len(sets)), [len(s[1]) for s in sets])
            found = throw(np.concatenate([s[1] for s in sets]), np.concatenate([s[2] for s in sets]), owner, len(sets))
            for (number, _, _), row, ranks in zip(sets, bands(found), found.astype("u1"), strict=True):
                out[number], low[number] = row.view("i8"), ranks.tobytes()
            sets.clear()

    size = 0
    for number, w in enumerate(words):
        if len(w):
            elements, weights = np.unique(shingles(w), return_counts=True)
            if sets and (len(sets) >= DOCS_AT_ONCE or size + len(elements) > SHINGLES_AT_ONCE):
                flush()
                size = 0
            sets.append((number, elements, weights))
            size += len(elements)
    flush()
    return keys, out, low


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key (digest of the words), bands and low bytes of every row; rows without words have no bands."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, found, low = sketched(part.column("text").to_pylist(), cache)
                ends = np.cumsum([0, *(0 if f is None else BANDS for f in found)])
                flat = [f for f in found if f is not None]
                values = np.concatenate(flat) if flat else np.zeros(0, "i8")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64())),
                     pa.array(low, pa.binary())],
                    names=["doc_id", "key", "bands", "low"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(work, "doc_id long, key binary, bands array<long>, low binary")


def elements(words: np.ndarray) -> np.ndarray:
    """The shingles of a text as a sorted set: the n-th copy of a shingle is an element of its own, so the Jaccard index
    of two such sets is the weighted one of the multisets."""
    found, counts = np.unique(shingles(words), return_counts=True)
    more = np.repeat(found, counts)
    copy = np.arange(len(more)) - np.repeat(np.cumsum(counts) - counts, counts)
    repeated = copy > 0
    more[repeated] = mix(more[repeated] + copy[repeated].astype("u8") * GOLDEN)
    return np.sort(more)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted sets. Two empty ones are equal."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges two sorted runs
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (total - shared)


def element_sets(docs: DataFrame) -> DataFrame:
    """doc_id and elements (as bytes) of every row."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        cache = WordHashes()
        return {"doc_id": rows["doc_id"], "elements": [elements(word_hashes(t, cache)).tobytes() for t in rows["text"]]}

    return map_texts(docs.select("doc_id", "text"), "text", work, "doc_id long, elements binary")


def compared(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``pairs`` (id, pivot) with their exact similarity; ``members`` holds (id, elements) of all that occur in pairs."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        found = [
            similarity(np.frombuffer(a, "u8"), np.frombuffer(b, "u8"))
            for a, b in zip(rows["elements"], rows["pivot_elements"], strict=True)
        ]
        return {"id": rows["id"], "pivot": rows["pivot"], "similarity": found}

    own = members.select("id", "elements")
    other = members.select(F.col("id").alias("pivot"), F.col("elements").alias("pivot_elements"))
    both = pairs.join(own, "id").join(other, "pivot").select("id", "pivot", "elements", "pivot_elements")
    scored = map_texts(both, "elements", work, "id long, pivot long, similarity double")
    return scored.groupBy("id", "pivot").agg(F.max("similarity").alias("similarity"))


def with_pivots(members: DataFrame) -> DataFrame:
    """``members`` (band, id) of buckets with at least two of them, with the bucket's smallest member as ``pivot``."""
    pivots = (
        members.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
        .select("band", "pivot")
    )
    return members.join(pivots, "band").select("band", "id", "pivot")


def in_filter(rows: DataFrame, packed: np.ndarray, bits: int) -> DataFrame:
    """``rows`` without most of those whose doc_id is not in the filter; an exact join has to follow."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)
    names = rows.columns

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            hashes = batch.column("__seed").to_numpy().view("u8")
            passed = np.ones(batch.num_rows, bool)
            for k in range(PROBES):
                at = probe(hashes, k, bits)
                passed &= (held[at >> 3] >> (at & 7).astype("u1")) & 1 == 1
            yield batch.select(names).filter(pa.array(passed))

    return rows.withColumn("__seed", F.xxhash64("doc_id")).mapInArrow(work, rows.schema)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row: the smallest id among all documents connected by similarity."""
    sketch = stage(sketches(docs), "sketches")
    nodes = stage(sketch.groupBy("key").agg(F.min("doc_id").alias("node")), "nodes")
    chosen = sketch.join(nodes.withColumnRenamed("node", "doc_id"), ["key", "doc_id"], "left_semi")
    bucket = stage(with_pivots(chosen.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))), "buckets")
    involved = stage(bucket.select(F.col("id").alias("doc_id")).distinct(), "involved")
    bits = (max(1, involved.count()) * BITS_PER_ID - 1).bit_length()
    bits = min(max(bits, LEAST_FILTER_BITS), MOST_FILTER_BITS)
    packed = bloom(involved.select(F.xxhash64("doc_id").alias("seed")), bits)
    narrow = in_filter(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), packed, bits)
    narrow = narrow.join(involved, "doc_id", "left_semi")
    likely = in_filter(sketch.select("doc_id", "key", "low"), packed, bits)
    low = (
        likely.join(nodes.withColumnRenamed("node", "doc_id"), ["key", "doc_id"], "left_semi")
        .groupBy("doc_id").agg(F.min("low").alias("low"))
    )
    members = element_sets(narrow).join(low, "doc_id").withColumnRenamed("doc_id", "id")
    members = stage(members, "members")

    scored = stage(compared(bucket.where("id > pivot").select("id", "pivot").distinct(), members), "compared")
    edges = scored.where(F.col("similarity") >= SIMILARITY).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    classes = components(edges)
    more = stage(links_between(bucket, scored, classes, members), "links")
    if not more.isEmpty():
        classes = components(edges.unionByName(more))
    known = nodes.join(classes, "node", "left").select("key", F.coalesce("component", "node").alias("class_id"))
    return sketch.select("doc_id", "key").join(known, "key").select("doc_id", "class_id")


def links_between(bucket: DataFrame, scored: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different classes; one link at least for every two classes
    that a block of the bucket connects."""
    others = (
        bucket.where("id > pivot").join(scored, ["id", "pivot"])
        .join(classes.withColumnRenamed("node", "id"), "id", "left")
        .select("band", "id", "similarity", F.coalesce("component", "id").alias("class"))
    )
    mixed = (
        others.groupBy("band")
        .agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count(F.lit(1)).alias("members"))
        .where("least < most").select("band", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = others.join(mixed, "band").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    facing = placed.join(members, "id").select(
        "band", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "id", "class",
        "similarity", "low", "elements",
    )

    def compare(group: pa.Table) -> pa.Table:
        left = group["left"][0].as_py()
        side = group["own"].to_numpy() == left
        ids, label, near = group["id"].to_numpy(), group["class"].to_numpy(), group["similarity"].to_numpy()
        ranks = np.frombuffer(b"".join(group["low"].to_pylist()), "u1").reshape(len(ids), COORDINATES)
        sets = group["elements"]
        least = COORDINATES * (LIKELY + (1 - LIKELY) / 256)
        rows = np.flatnonzero(side)
        columns = rows if left == group["right"][0].as_py() else np.flatnonzero(~side)
        agreed: list[tuple[int, int, int]] = []
        for row in rows:
            open_ = columns[(label[columns] != label[row]) & (np.abs(near[columns] - near[row]) <= 1 - SIMILARITY + 1e-9)]
            shared = (ranks[open_] == ranks[row]).sum(axis=1)
            agreed += [(-int(n), int(row), int(c)) for n, c in zip(shared, open_, strict=True) if n >= least]
        joined: dict[int, int] = {}  # classes that this block has connected, each with a smaller one

        def root(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        links = []
        for _, row, column in sorted(agreed):  # the likeliest first, so that few are left to compare
            one, two = root(int(label[row])), root(int(label[column]))
            if one != two and similarity(*(np.frombuffer(sets[n].as_py(), "u8") for n in (row, column))) >= SIMILARITY:
                joined[max(one, two)] = min(one, two)
                links.append((int(ids[row]), int(ids[column])))
        return pa.table({
            "a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())
        })

    return facing.groupBy("band", "left", "right").applyInArrow(compare, "a long, b long").distinct()


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class: the one with the smallest id, a NULL id last, the first in the written order on ties.

    Rows are numbered first and each is decided by its own text, so an id that stands for several texts loses none that is
    nobody's copy, and rows with NULL ids fold like any others.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")).withColumnRenamed("doc_id", row)
    named = numbered.select(row, F.col("doc_id").alias("id")).join(classes, row)
    decided = stage(named.select(row, "id", "class_id"), "classes")
    first = decided.groupBy("class_id").agg(
        F.min(F.struct(F.col("id").isNull(), "id", row)).alias("kept"), F.count(F.lit(1)).alias("rows")
    ).where("rows > 1").select("class_id", F.col("kept")[row].alias("kept"))
    dropped = stage(decided.join(first, "class_id").where(F.col(row) != F.col("kept")).select(row), "copies")
    return numbered.join(dropped, row, "left_anti").select(*[numbered[f"`{name}`"] for name in docs.columns])
