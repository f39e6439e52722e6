"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed.

A seed is a hash of the words at the ones of a fixed mask; words at its zeros may differ. Seeds of all benchmark items
are joined with the seeds of all documents. So that a document's seeds need no shuffle unless they can match, a
document first asks a Bloom filter, sized by the number of seeds (64 bits a seed or more, so that one seed in some 10,000
passes by chance, from 2 MB up to 32 MB; beyond that more documents pass, and none is lost); only documents with a hit
leave their task, with their words as hashes. Each joined seed gives a diagonal (document position minus item position); along it, the words of item and document are
compared one by one, and the best segment (+1 for equal words, -2 for others) counts if it has ``LEAST_WORDS`` equal
words, or if ``LEAST_SHARE`` of all words of the item agree; then it reaches from the first to the last of them.

Items of 16 words and more have seeds of six words, shorter ones of four. Every way to change a fifth of the words leaves a
seed: enumerated for items of 6 to 25 words, sampled above (50,000 ways each for 30 to 60 words, none missed).

Defined cases: texts and items are told apart by digests of their texts and words, never by their ids. Items that are
equal word by word count as the one with the smallest id; an item whose ids are all NULL is looked for like any other
and reported with a NULL item_id (one row a document for all such items). Items of fewer than six words match only
documents that equal them, as part of a text they would match everywhere. NULL and empty texts have no words and match
nothing. ``overlaps`` does not report rows with a NULL doc_id, ``without_contaminated`` decides them by their text. Rows
that repeat a document id are taken together; ties between segments go to the first. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.llm.common import WordHashes, map_texts, mix, slices, word_hashes
from pulseframe.sources.staging import stage

# The masks with six ones for items of ``LONG`` words and more, and those with four ones for shorter items.
MASKS = ("111111", "11011011", "1101000111", "11100100101")
LIGHT_MASKS = ("1111", "110011")
WEIGHT = 6
LONG = 16
BITS_PER_SEED = 64
LEAST_FILTER_BITS, MOST_FILTER_BITS = 24, 28
PROBES = 3
LEAST_WORDS = 12
LEAST_SHARE = 0.8
MISMATCH = -2


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def seeds(words: np.ndarray, ends: np.ndarray, masks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of all seeds of texts that lie one behind the other in ``words``, ``ends`` at their ends.

    A text shorter than ``WEIGHT`` has one more seed, of all its words, at its first position.
    """
    hashes, places = [], []
    numbers = {mask: number for number, mask in enumerate(MASKS + LIGHT_MASKS)}
    times = _multipliers(max(map(len, MASKS)))
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(words))  # words from here to the end of the text
    for mask in masks:
        if len(words) < len(mask):
            continue
        total = np.full(len(words) - len(mask) + 1, numbers[mask], "u8")
        for k, one in enumerate(mask):
            if one == "1":
                total += words[k:len(words) - len(mask) + 1 + k] * times[k]
        fits = np.flatnonzero(left[:len(total)] >= len(mask))
        hashes.append(mix(total[fits]))
        places.append(fits)
    starts = ends - np.diff(ends, prepend=0)
    for start, end in zip(starts, ends, strict=True):
        if 0 < end - start < WEIGHT:
            hashes.append(mix((words[start:end] * times[:end - start]).sum(dtype="u8", keepdims=True) + np.uint64(99 + end - start)))
            places.append(np.array([start]))
    if not hashes:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    return np.concatenate(hashes), np.concatenate(places)


def masks_of(length: int) -> Sequence[str]:
    """The masks for an item of so many words."""
    return MASKS if length >= LONG else LIGHT_MASKS if length >= WEIGHT else ()


def probe(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The ``k``-th bit of every seed in a filter of 2^``bits`` bits."""
    return (mix(hashes + np.uint64(k)) >> np.uint64(64 - bits)).astype("i8")


def digest(text: str | Column) -> Column:
    """Sixteen bytes that tell texts (or bytes) apart; NULL for NULL."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item (a digest of the words), item_id and ``item_words`` (hashes as bytes) of the distinct items."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        cache = WordHashes()
        return {"item_id": rows["item_id"], "item_words": [word_hashes(t, cache).tobytes() for t in rows["text"]]}

    narrow = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = map_texts(narrow, "text", work, "item_id long, item_words binary").where(F.octet_length("item_words") > 0)
    return words.groupBy("item_words").agg(F.min("item_id").alias("item_id")).select(
        digest("item_words").alias("item"), "item_id", "item_words")


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, item and item_at of every seed of every item, with the item's number of words."""
    schema = "seed long, item binary, item_at int, item_length int"

    def work(rows: dict[str, list]) -> dict[str, list]:
        out = {n: [] for n in ("seed", "item", "item_at", "item_length")}
        for item, held in zip(rows["item"], rows["item_words"], strict=True):
            words = np.frombuffer(held, "u8")
            hashes, places = seeds(words, np.array([len(words)]), masks_of(len(words)))
            out["seed"] += hashes.view("i8").tolist()
            out["item"] += [item] * len(hashes)
            out["item_at"] += places.tolist()
            out["item_length"] += [len(words)] * len(hashes)
        return out

    return map_texts(items.select("item", "item_words"), "item_words", work, schema)


def masks_and_bits(keyed: DataFrame) -> tuple[list[str], int]:
    """The masks that some item needs, and the size of the filter for so many seeds as a power of two."""
    row = keyed.agg(
        F.count(F.lit(1)).alias("seeds"),
        F.coalesce(F.max(F.col("item_length") >= LONG), F.lit(False)).alias("long"),
        F.coalesce(F.max(F.col("item_length").between(WEIGHT, LONG - 1)), F.lit(False)).alias("short"),
    ).first()
    masks = [*(MASKS if row["long"] else ()), *(LIGHT_MASKS if row["short"] else ())]
    return masks, filter_bits(row["seeds"])


def filter_bits(count: int) -> int:
    """The power of two of the filter's bits for so many seeds."""
    return min(max((max(1, count) * BITS_PER_SEED - 1).bit_length(), LEAST_FILTER_BITS), MOST_FILTER_BITS)


def bloom(keyed: DataFrame, bits: int) -> np.ndarray:
    """The filter as packed bits, built in the tasks as bitmaps of 4 KB; what is collected is the filter, 32 MB at most."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("seed").to_numpy().view("u8")
            for k in range(PROBES):
                yield pa.RecordBatch.from_arrays([pa.array(probe(hashes, k, bits) + 1)], names=["bit"])

    size = 1 << 15  # bits of one bitmap
    maps = keyed.select("seed").mapInArrow(work, "bit long").groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    packed = np.zeros((1 << bits) // 8, "u1")
    for row in maps.toArrow().to_pylist():
        at = (row["part"] - 1) * size // 8
        packed[at:at + size // 8] = np.frombuffer(row["map"], "u1")
    return packed


def documents_with_hits(docs: DataFrame, packed: np.ndarray, masks: Sequence[str], bits: int) -> DataFrame:
    """doc_id, key (a digest of the text), words (hashes as bytes) and hits (seed, position) of the documents that pass the
    filter."""
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    masks = tuple(masks)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cache = shared.value, WordHashes()

        def passes(at: np.ndarray) -> np.ndarray:
            return (held[at >> 3] >> (at & 7).astype("u1")) & 1 == 1

        for batch in batches:
            for part in slices(batch, "text"):
                ids, keys = part.column("doc_id").to_pylist(), part.column("key").to_pylist()
                words = [word_hashes(t, cache) for t in part.column("text").to_pylist()]
                ends = np.cumsum([len(w) for w in words])
                hashes, places = seeds(np.concatenate(words), ends, masks)
                for k in range(PROBES):  # later probes see only what passed the earlier ones
                    kept = passes(probe(hashes, k, bits))
                    hashes, places = hashes[kept], places[kept]
                of = np.searchsorted(ends, places, side="right")
                order = np.argsort(of, kind="stable")
                out = {"doc_id": [], "key": [], "words": [], "hits": []}
                for d, chosen in zip(*_grouped(of[order], order), strict=True):
                    start = ends[d] - len(words[d])
                    out["doc_id"].append(ids[d])
                    out["key"].append(keys[d])
                    out["words"].append(words[d].tobytes())
                    out["hits"].append([
                        {"seed": int(s), "at": int(p)}
                        for s, p in zip(hashes[chosen].view("i8"), places[chosen] - start, strict=True)
                    ])
                kind = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["key"], pa.binary()),
                     pa.array(out["words"], pa.binary()), pa.array(out["hits"], kind)],
                    names=["doc_id", "key", "words", "hits"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest("text").alias("key"))
    return narrow.mapInArrow(work, "doc_id long, key binary, words binary, hits array<struct<seed: long, at: int>>")


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Runs of equal sorted keys with their values."""
    if not len(keys):
        return [], []
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate([[0], cuts])].tolist(), np.split(values, cuts)


def best_segment(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and number of equal words of the segment with the highest score; the first one on ties."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.argmax(score[:end + 1] == low[end])) if end else 0
    return start, end, int(equal[start:end].sum())


def text_overlaps(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with hits (doc_id, key, ...), and one row per text and diagonal that holds an item: key, item_id,
    start, end, equal_words, item_length. Texts that occur often are compared once."""
    items = stage(benchmark_items(benchmark), "benchmark-items")
    keyed = stage(item_seeds(items), "benchmark-seeds")
    masks, bits = masks_and_bits(keyed)
    hit = stage(documents_with_hits(docs, bloom(keyed, bits), masks, bits), "benchmark-hits")
    texts = hit.dropDuplicates(["key"])
    diagonals = (
        texts.select("key", F.explode("hits").alias("hit"))
        .select("key", F.col("hit.seed").alias("seed"), F.col("hit.at").alias("at"))
        .join(keyed.select("seed", "item", "item_at"), "seed")
        .select("key", "item", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
        .join(items, "item")
    )
    # Only the words of the document that lie along the diagonal, as bytes of the hashes.
    first = F.greatest("diagonal", F.lit(0))
    length = (F.octet_length("item_words") / 8).cast("int") - (first - F.col("diagonal"))
    facing = diagonals.join(texts.select("key", "words"), "key").select(
        "key", "item_id", "diagonal", "item_words",
        F.substring("words", first * 8 + 1, length * 8).alias("facing"),
    )

    def work(rows: dict[str, list]) -> dict[str, list]:
        out = {n: [] for n in ("key", "item_id", "start", "end", "equal_words", "item_length")}
        for key, item, diagonal, item_bytes, facing_bytes in zip(
            rows["key"], rows["item_id"], rows["diagonal"], rows["item_words"], rows["facing"], strict=True
        ):
            words, there = np.frombuffer(item_bytes, "u8"), np.frombuffer(facing_bytes, "u8")
            skipped = max(0, -diagonal)
            agree = words[skipped:skipped + len(there)] == there
            start, end, equal = best_segment(agree)
            same = np.flatnonzero(agree)
            if len(same) >= LEAST_SHARE * len(words):
                start, end, equal = int(same[0]), int(same[-1]) + 1, len(same)
            whole = len(words) >= WEIGHT or (equal == len(words) == len(there))
            if whole and (equal >= LEAST_WORDS or equal >= LEAST_SHARE * len(words)):
                at = max(diagonal, 0)
                for name, value in zip(out, (key, item, at + start, at + end, equal, len(words)), strict=True):
                    out[name].append(value)
        return out

    schema = "key binary, item_id long, start long, end long, equal_words long, item_length long"
    return hit, map_texts(facing, "facing", work, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it contains: where, how many words agree, and the item's length.

    ``start`` and ``end`` are word positions in the document.
    """
    hit, found = text_overlaps(docs, benchmark)
    found = stage(found, "benchmark-found")
    named = hit.where("doc_id IS NOT NULL").select("doc_id", "key").join(found, "key")
    best = F.max_by(F.struct("start", "end", "equal_words", "item_length"), F.struct("equal_words", -F.col("start")))
    return named.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item. Every row is decided by its own text, whatever its id."""
    _, found = text_overlaps(docs, benchmark)
    bad = stage(found.select(F.col("key").alias("__contaminated")).distinct(), "contaminated")
    return docs.join(bad, digest(docs["text"]) == bad["__contaminated"], "left_anti")
