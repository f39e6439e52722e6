"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and of a piece BPE (B) cover the same bytes.

Every text is encoded whole by both tokenizers. Byte offsets where a token of A and one of B end together, and where both
go on with a space-marked token, are anchors. They cut a document into windows, pairs of token-id tuples, and equal
windows align alike, so a batch keeps the links and the group string of a window once. All ends of a slice's documents are
put in order at once: every end is one link, every end of both sides closes a group.

A document is then a list of window codes, and a batch of documents a dictionary of windows. Corpus-wide counts of linked
id pairs come from the dictionaries: a batch sends each of its distinct pairs once, and gets the corpus-wide counts of
those pairs back. So no document is tokenised twice, a pair that is everywhere is one row per batch, and no table of
counts is broadcast or collected. A batch and its counts meet as a group, and one batch at a time is sent to a Python worker.

NULL and empty texts, and texts whose tokens do not join to a space and the text, have no tokens: zeros and an empty
group string. Every row of the input gives a row, with repeated and NULL keys kept apart. Other columns are ignored.
One text is held by one task as a whole; a batch ends after ``BATCH_BYTES`` of text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulseframe.llm import bpe
from pulseframe.llm.common import slices
from pulseframe.sources.staging import fresh_path

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
# The same vocabulary as ranks.
A_RANKS = bpe.RANKS
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
# Text bytes after which a batch ends. A batch is one staged row, of about as many bytes.
BATCH_BYTES = 4 << 20
# Batches that a file of staged rows holds: its writer and its reader have all rows of a file in memory.
FILE_BATCHES = 4
SLICE_BYTES = 1 << 19
# Between the two id lists of a window; no vocabulary is that large.
SEPARATOR = 0xFFFFFFFF
SPACE = "▁"

BATCHES = (
    "batch long, keys array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups_sha256 array<string>, n_windows binary, codes binary, window_links binary, window_pairs binary,"
    " pairs array<long>, pair_links array<long>"
)
DIGESTS = (
    "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def byte_level_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves, the others
    for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(rest)}


class Coder:
    """A tokenizer, the bytes of each of its tokens, their lengths, and whether they begin with a space."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.lengths = [len(t) for t in tokens]
        self.sizes = np.array(self.lengths, "i4")
        self.spaced = np.array([t[:1] == b" " for t in tokens], bool)


class ByteCoder(Coder):
    """Texts of Latin-1 characters, which both libraries class alike, are encoded by the rank file of the same
    vocabulary, in a third of the time; all others by the library of ``path``."""

    def __init__(self, path: str, ranks: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        self.ranks = ranks and bpe.encoding(ranks)
        alphabet = byte_level_alphabet()
        size = self.coder.get_vocab_size(with_added_tokens=True)
        entries = (self.coder.id_to_token(i) or "" for i in range(size))
        super().__init__([bytes(map(alphabet.__getitem__, e)) if all(c in alphabet for c in e) else e.encode() for e in entries])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._by_ranks(t) or self.coder.encode(" " + t, add_special_tokens=False).ids for t in texts]

    def _by_ranks(self, text: str) -> list[int] | None:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return self.ranks and bpe.encode_to_list(" " + text, self.ranks)


class PieceCoder(Coder):
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.coder = p = SentencePieceProcessor(model_file=path)
        super().__init__([
            bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(p.get_piece_size())
        ])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def coders(a_file: str, b_file: str, a_ranks: str | None = A_RANKS) -> tuple[ByteCoder, PieceCoder]:
    return ByteCoder(a_file, a_ranks), PieceCoder(b_file)


@lru_cache(maxsize=2)
def written(size: int) -> list[bytes]:
    """Every id below ``size`` after a comma, after a semicolon, after a bar and after a line end."""
    return [b"%c%d" % (mark, i) for mark in b",;|\n" for i in range(size)]


class Alignment(NamedTuple):
    """Two encodings of the same bytes, all ends of tokens of either side in order: one end is one link, of the tokens
    that reach up to it."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    pairs: np.ndarray  # a << 32 | b of every link
    in_a: np.ndarray  # whether a token of A, of B ends at an end
    in_b: np.ndarray

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every end that both sides share: the tokens of A, the tokens of B and the links up to it."""
        shared = np.flatnonzero(self.in_a & self.in_b)
        return np.cumsum(self.in_a)[shared], np.cumsum(self.in_b)[shared], shared + 1

    def said(self, opening: np.ndarray | None = None) -> bytes:
        """The groups as ``a1,a2|b1;a3|b2``. Groups that begin with the tokens ``opening`` of A follow a line end in place of
        a semicolon."""
        a_stops, b_stops, _ = self.groups()
        size = int(max(self.a_ids.max(), self.b_ids.max())) + 1
        strings = written(1 << (size - 1).bit_length())
        size = len(strings) // 4
        shared = self.in_a & self.in_b
        before = np.cumsum(shared) - shared  # groups that end earlier
        a_said, b_said = self.a_ids.astype("i8"), self.b_ids.astype("i8")
        a_said[np.append(0, a_stops[:-1])] += size
        b_said[np.append(0, b_stops[:-1])] += 2 * size
        if opening is not None:
            a_said[opening] += 2 * size  # from semicolon to line end
        out = np.empty(len(a_said) + len(b_said), "i8")
        out[np.arange(len(a_said)) + np.append(0, b_stops[:-1])[before[self.in_a]]] = a_said
        out[np.arange(len(b_said)) + a_stops[before[self.in_b]]] = b_said
        return b"".join(map(strings.__getitem__, out.tolist()))[1:]


def alignment(a_ids: np.ndarray, b_ids: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Alignment:
    """Align two encodings of the same bytes, given as ids and as the sizes of all tokens."""
    a_ends, b_ends = np.cumsum(a_sizes[a_ids], dtype="i8"), np.cumsum(b_sizes[b_ids], dtype="i8")
    at_a, at_b = np.zeros(a_ends[-1] + 1, bool), np.zeros(a_ends[-1] + 1, bool)
    at_a[a_ends], at_b[b_ends] = True, True
    ends = np.flatnonzero(at_a | at_b)
    in_a, in_b = at_a[ends], at_b[ends]
    pairs = a_ids[np.cumsum(in_a) - in_a].astype("i8") << 32 | b_ids[np.cumsum(in_b) - in_b]
    return Alignment(a_ids, b_ids, pairs, in_a, in_b)


def align(a: list[int], b: list[int], a_lengths: list[int], b_lengths: list[int]) -> tuple[str, int, list[int]]:
    """Groups as ``a1,a2|b1;a3|b2``, their number, and the linked pairs ``a << 32 | b`` of all overlapping tokens. Both
    lists cover the same number of bytes."""
    found = alignment(*(np.array(x, "i8") for x in (a, b, a_lengths, b_lengths)))
    return found.said().decode(), len(found.groups()[0]), found.pairs.tolist()


class Windows(NamedTuple):
    """The windows of a run of verified documents, each with the bytes of A's ids, a separator and B's ids, and where it ends
    among the tokens of A, the tokens of B and the links. Every document ends a window, as the next begins with a space."""

    ids: pa.LargeBinaryArray
    a_stops: np.ndarray
    b_stops: np.ndarray
    link_stops: np.ndarray


def windows_of(found: Alignment, a: Coder, b: Coder) -> Windows:
    """Cut verified documents at their anchors."""
    a_ids, b_ids = found.a_ids, found.b_ids
    a_open, b_open = np.append(a.spaced[a_ids[1:]], True), np.append(b.spaced[b_ids[1:]], True)
    a_stops, b_stops, link_stops = found.groups()
    anchors = a_open[a_stops - 1] & b_open[b_stops - 1]
    a_stops, b_stops = a_stops[anchors], b_stops[anchors]
    # Window k holds A's ids, one separator and B's ids, so it ends at a_stops[k] + b_stops[k] + k + 1.
    stops = a_stops + b_stops + np.arange(1, len(a_stops) + 1)
    a_counts, b_counts = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
    flat = np.full(int(stops[-1]), SEPARATOR, "<u4")
    starts = stops - a_counts - b_counts - 1
    flat[np.arange(len(a_ids)) + np.repeat(starts - (a_stops - a_counts), a_counts)] = a_ids
    flat[np.arange(len(b_ids)) + np.repeat(starts + a_counts + 1 - (b_stops - b_counts), b_counts)] = b_ids
    ends = pa.py_buffer(np.append(0, stops * 4).astype("i8"))
    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, ends, pa.py_buffer(flat)])
    return Windows(ids, a_stops, b_stops, link_stops[anchors])


class Batch:
    """Documents on their way to one staged row. ``windows`` numbers the windows of the batch; the group string and the links
    of each are kept once, when it first occurs."""

    def __init__(self, a: Coder, b: Coder) -> None:
        self.a, self.b, self.bytes = a, b, 0
        self.windows: dict[bytes, int] = {}
        self.strings: list[bytes] = []
        self.links: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.flat: list[np.ndarray] = []

    def add(self, keys: list[int | None], encoded: list[tuple[list[int], list[int]] | None]) -> None:
        """Documents with the ids of both sides, or None for one without tokens."""
        some = [e for e in encoded if e]
        facts = iter(self._add_verified(some)) if some else iter(())
        self.rows += [(key, *next(facts)) if e else (key, 0, 0, 0, 0, "", 0) for key, e in zip(keys, encoded)]

    def _add_verified(self, some: list[tuple[list[int], list[int]]]) -> Iterator[tuple]:
        a_ids, b_ids = (np.concatenate([np.array(e[side], "i4") for e in some]) for side in (0, 1))
        found = alignment(a_ids, b_ids, self.a.sizes, self.b.sizes)
        cut = windows_of(found, self.a, self.b)
        coded = cut.ids.dictionary_encode()
        known = self.windows
        before = len(known)
        # Numbered as they first occur, in the slice and in the batch.
        numbers = np.array([known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()], "i8")
        codes = numbers[coded.indices.to_numpy()]
        # Numbers rise as windows first occur, so a window is new where its number passes all earlier ones.
        fresh = codes > np.append(before - 1, np.maximum(np.maximum.accumulate(codes), before - 1)[:-1])
        if fresh.any():
            a_counts, b_counts, links = (np.diff(stops, prepend=0) for stops in cut[1:])
            ends = np.repeat(fresh, links)
            news = Alignment(a_ids[np.repeat(fresh, a_counts)], b_ids[np.repeat(fresh, b_counts)], found.pairs[ends],
                             found.in_a[ends], found.in_b[ends])
            opening = np.cumsum(a_counts[fresh]) - a_counts[fresh]
            self.strings += news.said(opening).split(b"\n")
            self.links.append(links[fresh])
            self.pairs.append(news.pairs)
        self.flat.append(codes.astype("<u4"))
        n_a, n_b = (np.array([len(e[side]) for e in some]) for side in (0, 1))
        stops = np.searchsorted(cut.a_stops, np.cumsum(n_a)) + 1
        n_links = np.diff(cut.link_stops[stops - 1], prepend=0)
        groups = n_a + n_b - n_links  # every shared end closes a group
        said, at = self.strings, codes.tolist()
        for i, (start, stop) in enumerate(zip([0, *stops.tolist()], stops.tolist())):
            digest = hashlib.sha256(b";".join(map(said.__getitem__, at[start:stop]))).hexdigest()
            yield int(n_a[i]), int(n_b[i]), int(groups[i]), int(n_links[i]), digest, stop - start

    def row(self, number: int) -> dict:
        names = ("keys", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_windows")
        columns = {name: [r[i] for r in self.rows] for i, name in enumerate(names)}
        codes = np.concatenate(self.flat) if self.flat else np.zeros(0, "<u4")
        links = np.concatenate([np.zeros(0, "<u4"), *self.links]).astype("<u4")
        pairs, where = np.unique(np.concatenate([np.zeros(0, "i8"), *self.pairs]), return_inverse=True)
        used = np.repeat(np.bincount(codes, minlength=len(links)), links)  # how often each window's links occur
        counts = np.bincount(where, weights=used, minlength=len(pairs)).astype("i8")  # sums below 2**53
        return columns | {
            "batch": number, "n_windows": np.array(columns["n_windows"], "<u4").tobytes(), "codes": codes.tobytes(),
            "window_links": links.tobytes(), "window_pairs": where.astype("<u4").tobytes(), "pairs": pairs,
            "pair_links": counts,
        }


def encoded_batches(
    docs: DataFrame, key: str, text: str, a_file: str, b_file: str, a_ranks: str | None
) -> DataFrame:
    """One row per batch of documents: what is known of each document, its window codes, and the batch's dictionary."""
    fields = T.StructType.fromDDL(BATCHES)
    arrow = to_arrow_schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coders(a_file, b_file, a_ranks)
        open_batch, number = Batch(a, b), TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            row = open_batch.row(number)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = part.to_pydict()
                texts = [t or "" for t in rows["text"]]
                encoded = []
                for t, a_ids, b_ids in zip(texts, a.encode(texts), b.encode(texts)):
                    whole = b" " + t.encode()
                    fits = (
                        t and b"".join(map(a.tokens.__getitem__, a_ids)) == whole
                        and b"".join(map(b.tokens.__getitem__, b_ids)) == whole
                    )
                    encoded.append((a_ids, b_ids) if fits else None)
                    open_batch.bytes += len(whole)
                open_batch.add(rows["key"], encoded)
                if open_batch.bytes >= BATCH_BYTES:
                    yield out()
                    open_batch, number = Batch(a, b), number + 1
        if open_batch.rows:
            yield out()

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(work, fields)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair`` (A's id << 32 | B's id), ``total`` (links corpus-wide that hold it) and ``best`` (whether that is the
    most for its id of B)."""
    own = F.inline(F.arrays_zip("pairs", "pair_links")).alias("pair", "links")
    counts = batches.select(own).groupBy("pair").agg(F.sum("links").alias("total"))
    piece = F.col("pair").bitwiseAND(F.lit(SEPARATOR)).alias("piece")
    most = counts.groupBy(piece).agg(F.max("total").alias("most"))
    # At most one row per id of B; AQE decides by its measured size whether to broadcast it.
    return counts.withColumn("piece", piece).join(most, "piece").select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best")
    )


def alignment_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
    a_ranks: str | None = A_RANKS,
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, ``n_best`` and ``count_sum`` of its links by the
    corpus-wide counts of their pairs, and the SHA-256 of its groups. Writes the batches to the shared folder."""
    spark = docs.sparkSession
    path = fresh_path(spark, "alignments")
    encoded = encoded_batches(docs, key, text, a_file, b_file, a_ranks)
    encoded.write.options(compression="zstd", maxRecordsPerFile=FILE_BATCHES).parquet(path)
    batches = spark.read.schema(T.StructType.fromDDL(BATCHES)).parquet(path)
    counts = pair_counts(batches)
    asked = batches.select(F.col("batch").alias("asker"), F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(counts, "pair").select("asker", "at", "total", "best")
    fields = T.StructType.fromDDL(DIGESTS)
    arrow = to_arrow_schema(fields)

    def work(batch: pa.Table, told: pa.Table) -> pa.Table:
        row = {name: batch.column(name)[0] for name in batch.schema.names}
        plain = {n: row[n].values for n in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        best, total = scores(row, told)
        plain |= {"key": row["keys"].values, "n_best": best, "count_sum": total}
        return pa.Table.from_arrays([pa.array(plain[f.name], f.type) for f in arrow], schema=arrow)

    done = batches.drop("pairs", "pair_links").groupBy("batch").cogroup(told.groupBy("asker"))
    return done.applyInArrow(work, fields).withColumnRenamed("key", key)


def scores(row: dict, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """``n_best`` and ``count_sum`` of every document of a batch, from what is told of its distinct pairs."""
    numbers = lambda name: np.frombuffer(row[name].as_py(), "<u4")
    sizes, codes = numbers("n_windows"), numbers("codes")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if not len(codes):
        return np.zeros(len(sizes), "i8"), np.zeros(len(sizes), "i8")
    at, total, best = (told.column(n).to_numpy() for n in ("at", "total", "best"))
    totals, bests = np.zeros(len(at), "i8"), np.zeros(len(at), "i8")
    totals[at], bests[at] = total, best
    links, pairs = numbers("window_links"), numbers("window_pairs")
    starts = np.cumsum(links, dtype="i8") - links
    out = []
    for values in (bests, totals):
        windows = np.add.reduceat(values[pairs], starts)
        sums = np.zeros(len(sizes), "i8")
        np.add.at(sums, owner, windows[codes])
        out.append(sums)
    return out[0], out[1]
