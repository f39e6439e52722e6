"""Suffix-array deduplication: bytes of every ``WINDOW``-byte string that also starts anywhere else are removed.

Suffixes are sorted by a distributed difference-cover algorithm over names. Sorting one entry per byte would move many
times the input, so the text is first reduced to a string of phrases: a phrase begins where the hash of eight bytes is the
smallest of ``DENSE`` neighbouring ones, which depends on the bytes around it alone, so that equal strings are cut alike.
Then, for the string of phrases of every region that can hold a repeat:

1. positions 1 and 2 modulo 3 are sampled, their triples of phrases sorted and named by rank,
2. the names of a region, those of residue 1 before those of residue 2, are a string of their own, whose triples are
   sorted and named again; the recursion ends there, as such a rank covers nine phrases and every window holds at least
   eleven whole ones,
3. positions 0 modulo 3 are merged in: their phrase and the rank of the next position meet those of residue 1, their
   two phrases and the rank after those meet residue 2, and each takes the rank of its equals,
4. every byte position is merged in by the bytes before its first phrase, the rank of that phrase and the bytes after
   the ranked ones; in that order neighbours are compared, and equal ones are windows that occur twice.

Before that, whole texts that equal another one are settled at once, one of them staying as a partner for the rest, and
regions are left out where the 264 bytes after every sparse phrase start occur nowhere else. Both lose no repeat.

Sorting is asked for in batches of texts: a batch sends each of its distinct keys once to the key's range and gets a rank
or an answer back, so a passage that is everywhere is one key per batch. Keys of bytes are 64-bit hashes beside the number
of their range. The batches are tables in the shared folder, bucketed by batch, so that no text is ever shuffled.

NULL and empty texts have no bytes, and keep the digest of nothing; strings within shorter texts are never removed.
Repeated rows and NULL ids are rows of their own. Other columns are ignored. One text is held by one task as a whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulseframe.llm.common import mix, slices
from pulseframe.sources.staging import fresh_path, stage

WINDOW = 400
GRAM = 8
SPARSE, DENSE = 128, 28
# Bytes after a sparse phrase start that are within every window it is the first one of.
PROBE = WINDOW - SPARSE - GRAM
# Phrases that a rank stands for.
RANKED = 9
# Text bytes of a batch, of a bucket of the batch table, and of texts that are worked on at once.
BATCH_BYTES, BUCKET_BYTES, SLICE_BYTES = 4 << 20, 32 << 20, 1 << 19
# Positions that are searched for smallest values at once.
PLACES = 1 << 16
# Keys that a range gets on average when all of them differ.
RANGE_KEYS = 1 << 20
FACTOR = 0x9E3779B97F4A7C15  # odd; any odd number with mixed bits does

TEXTS = "batch long, keys array<long>, sizes binary, data binary"
REGIONS = (
    "batch long, done_keys array<long>, done_bytes array<long>, done_removed array<long>, done_spans array<long>,"
    " done_sha256 array<string>, keys array<long>, settled binary, sizes binary, data binary, owners binary,"
    " starts binary, lengths binary"
)
RESULT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# --- strings of bytes -------------------------------------------------------------------------------------------------


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, mixed."""
    wide = data.astype("u8")
    for step in (1, 2, 4):
        wide = wide[:-step] | wide[step:] << np.uint64(8 * step)
    return mix(wide)


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of ``width`` values below 2^48 is, from every position on; the last of equal ones.

    It never moves back. A block of positions is worked on at once, with the place in the block below each value, so one
    minimum finds value and place.
    """
    places = np.arange(PLACES - 1, -1, -1, dtype="u8")
    out = np.empty(max(0, len(values) - width + 1), "i4")
    for start in range(0, len(out), PLACES - width + 1):
        low = values[start:start + PLACES] << np.uint64(16)
        low |= places[:len(low)]
        span = 1
        while span < width:
            step = min(span, width - span)
            low = np.minimum(low[step:], low[:-step])
            span += step
        out[start:start + len(low)] = start + PLACES - 1 - (low & np.uint64(PLACES - 1)).astype("i4")
    return out


def powers_of(factor: int, count: int) -> np.ndarray:
    out = np.full(count, factor, "u8")
    out[0] = 1
    return np.cumprod(out)


# The powers for slices of usual size are worked out once per worker.
slice_powers = lru_cache(maxsize=2)(powers_of)


class Hashes:
    """Hashes of all substrings of a piece of data, by prefix sums over its grams."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values) + 1
        powers, self.back = (
            slice_powers(f, 2 * SLICE_BYTES)[:n] if n <= 2 * SLICE_BYTES else powers_of(f, n)
            for f in (FACTOR, pow(FACTOR, -1, 1 << 64))
        )
        self.sums = np.zeros(n, "u8")
        np.cumsum(values * powers[:-1], out=self.sums[1:])

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Of the bytes from ``start`` up to ``stop`` + 7: of the grams that begin in between."""
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])


class Strings:
    """Several strings in one array of bytes, with the grams of all positions; none counts across an end."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray) -> None:
        self.data, self.sizes = data, sizes.astype("i8")
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.values = grams(data) if len(data) >= GRAM else np.zeros(0, "u8")
        self.order = self.values >> np.uint64(16)

    def positions(self, room: int) -> np.ndarray:
        """Positions with at least ``room`` bytes up to the end of their string."""
        counts = np.maximum(self.sizes - room + 1, 0)
        return np.arange(counts.sum()) + np.repeat(self.begins - (np.cumsum(counts) - counts), counts)


def sparse_starts(strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every sparse phrase start the first and the last window that it is the first start of, and the hash behind it."""
    at = strings.positions(WINDOW)
    if not len(at):
        return at, at, np.zeros(0, "u8")
    first = first_smallest(strings.order, SPARSE)[at]
    new = np.flatnonzero(np.diff(first, prepend=-1))
    starts = first[new].astype("i8")
    probes = Hashes(strings.values).between(starts, starts + PROBE - GRAM + 1)
    return at[new], at[np.append(new[1:], len(at)) - 1], probes


class Phrases:
    """The phrases of strings: where they start, the string they are of, their place in it and their symbols."""

    def __init__(self, strings: Strings) -> None:
        near = strings.positions(DENSE + GRAM - 1)
        self.first = first_smallest(strings.order, DENSE)
        found = self.first[near]
        self.starts = found[np.diff(found, prepend=-1) > 0].astype("i8")
        self.owner = np.searchsorted(strings.ends, self.starts, side="right")
        opens = np.flatnonzero(np.diff(self.owner, prepend=-1))
        self.place = np.arange(len(self.starts)) - np.repeat(opens, np.diff(np.append(opens, len(self.starts))))
        self.hashes = Hashes(strings.values)
        last = np.append(self.owner[1:] != self.owner[:-1], True)
        # The last phrase of a string has no end of its own; whole windows never ask for it.
        stops = np.where(last, self.starts, np.append(self.starts[1:], 0))
        lengths = (stops - self.starts).astype("u8")
        self.symbols = mix(self.hashes.between(self.starts, stops) + lengths)

    def after(self, values: np.ndarray, steps: int) -> np.ndarray:
        """``values`` of the phrase ``steps`` later in the same string, 0 behind its end."""
        out = np.zeros(len(values), values.dtype)
        same = self.owner[steps:] == self.owner[:-steps]
        out[:-steps][same] = values[steps:][same]
        return out


# --- asking for ranks and answers -------------------------------------------------------------------------------------


def distinct(columns: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers, sorted, and for each row its number among them."""
    order = np.lexsort(tuple(columns[::-1])) if len(columns) > 1 else np.argsort(columns[0])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[order[1:]] != column[order[:-1]]
    where = np.empty(len(order), "i8")
    where[order] = np.cumsum(new) - 1
    return [c[order][new] for c in columns], where


def in_range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a key among ``ranges`` equal ones, in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype("i8")


def of_name(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys >> np.uint64(32)).astype("i8")


def numbers(value: bytes | None, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(value or b"", kind)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def mapped(df: DataFrame, work: Callable[[dict], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """Columns by name from each row of ``df``."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            for out in work(row):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def asked(
    batches: DataFrame, ask: Callable[[dict], Sequence[np.ndarray]], answer: Callable[[list[np.ndarray]], np.ndarray],
    name: str, width: int, ranges: int, locate: Callable[[np.ndarray, int], np.ndarray] = in_range,
) -> DataFrame:
    """``batches`` with a column ``name``: for each of the sorted distinct keys (of ``width`` numbers) that ``ask`` gives
    for a batch, what ``answer`` says of it among the keys of its range from all batches. Written to the shared folder."""

    def send(row: dict) -> Iterator[dict[str, list]]:
        keys, _ = distinct(ask(row))
        if not len(keys[0]):
            return
        range_of = locate(keys[0], ranges)
        cuts = np.flatnonzero(np.diff(range_of, prepend=-1))
        yield {
            "range": range_of[cuts], "batch": [row["batch"]] * len(cuts),
            "keys": [
                np.stack([k[start:stop] for k in keys]).tobytes()
                for start, stop in zip(cuts, np.append(cuts[1:], len(range_of)))
            ],
        }

    def reply(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")
        sent = [numbers(k, "<u8").reshape(width, -1) for k in table.column("keys").to_pylist()]
        said = answer([np.concatenate([k[i] for k in sent]) for i in range(width)])
        cuts = np.cumsum([k.shape[1] for k in sent])[:-1]
        return pa.table({
            "batch": table.column("batch"), "range": table.column("range"),
            "said": pa.array([s.tobytes() for s in np.split(said, cuts)], pa.binary()),
        })

    sent = mapped(batches, send, "range long, batch long, keys binary")
    said = sent.groupBy("range").applyInArrow(reply, "batch long, range long, said binary")
    told = said.groupBy("batch").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("range", "said"))), lambda s: s["said"]).alias(name)
    )
    return batches.join(stage(told, name).hint("shuffle_hash"), "batch", "left")


def told(row: dict, name: str, kind: str) -> np.ndarray:
    return numbers(b"".join(row[name] or ()), kind)


def occurrences(keys: list[np.ndarray]) -> np.ndarray:
    """0 for a key that one batch sent, 1 for the first of several senders, 2 for the others."""
    _, where = distinct(keys)
    counts = np.bincount(where)
    first = np.full(len(counts), len(where))
    np.minimum.at(first, where, np.arange(len(where)))
    return np.where(counts[where] < 2, 0, np.where(first[where] == np.arange(len(where)), 1, 2)).astype("u1")


def ranks(keys: list[np.ndarray]) -> np.ndarray:
    """The place of each key among the distinct ones of its range, from 1."""
    _, where = distinct(keys)
    return (where + 1).astype("<u4")


def merged_ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks for positions of residue 0: of the equal position of residue 1 or 2, or a new one (odd) for its equals.

    Keys are the first phrase, the residue, the second phrase, the rank one or two positions on (by residue), and the
    position's own rank; for residue 0 the last two are the ranks one and two positions on.
    """
    symbol, residue, second, near, last = keys
    is_0, is_1, is_2 = (residue == r for r in range(3))
    out = np.zeros(len(symbol), "<u8")
    _, by_one = distinct([symbol[is_0 | is_1], near[is_0 | is_1]])
    _, by_two = distinct([
        symbol[is_0 | is_2], second[is_0 | is_2], np.where(is_0, last, near)[is_0 | is_2],
    ])
    found = []
    for groups, other, own in ((by_one, is_1[is_0 | is_1], last[is_1]), (by_two, is_2[is_0 | is_2], last[is_2])):
        known = np.zeros(groups.max(initial=-1) + 1, "u8")
        known[groups[other]] = own
        found.append(known[groups[~other]])
    fresh = by_one[~is_1[is_0 | is_1]].astype("u8") << np.uint64(1) | np.uint64(1)
    out[is_0] = np.where(found[0] > 0, found[0], np.where(found[1] > 0, found[1], fresh))
    return out


# --- what the batches ask ---------------------------------------------------------------------------------------------


def texts_of(row: dict) -> list[bytes]:
    ends = np.cumsum(numbers(row["sizes"]), dtype="i8").tolist()
    return [row["data"][a:b] for a, b in zip([0, *ends], ends)]


def copy_keys(row: dict) -> list[np.ndarray]:
    found = [xxhash.xxh3_128_intdigest(t) for t in texts_of(row) if len(t) >= WINDOW]
    return [np.array([f >> 64 for f in found], "u8"), np.array([f & (1 << 64) - 1 for f in found], "u8")]


def copy_states(row: dict) -> np.ndarray:
    """For each text whether it is alone (0), the one that stays as a partner (1) or another copy (2)."""
    keys = copy_keys(row)
    unique, where = distinct(keys)
    said = told(row, "copies", "u1")[where]
    first = np.zeros(len(where), bool)
    first[np.unique(where, return_index=True)[1]] = True
    repeated = np.bincount(where, minlength=len(unique[0]))[where] > 1
    local = np.where(first, np.where(said == 2, 2, np.where(repeated, 1, said)), 2)
    out = np.zeros(len(numbers(row["sizes"])), "u1")
    out[numbers(row["sizes"]) >= WINDOW] = local
    return out


def text_slices(row: dict, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, Strings]]:
    """The chosen texts of a batch in bounded slices, with their numbers."""
    sizes = numbers(row["sizes"]).astype("i8")
    ends, data = np.cumsum(sizes), np.frombuffer(row["data"], "u1")
    picked, held = [], 0
    for text in [*np.flatnonzero(chosen), None]:
        if text is not None:
            picked.append(text)
            held += sizes[text]
        if picked and (text is None or held >= SLICE_BYTES):
            parts = [data[ends[t] - sizes[t]:ends[t]] for t in picked]
            yield np.array(picked), Strings(np.concatenate(parts), sizes[picked])
            picked, held = [], 0


def probed(row: dict) -> np.ndarray:
    return (numbers(row["sizes"]) >= WINDOW) & (copy_states(row) < 2)


def probe_keys(row: dict) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, "u8"), *(sparse_starts(s)[2] for _, s in text_slices(row, probed(row)))])]


def regions(row: dict) -> Iterator[dict[str, list]]:
    """What is settled of a batch, and the texts and regions of it that can hold a repeated window."""
    sizes, states, texts = numbers(row["sizes"]).astype("i8"), copy_states(row), texts_of(row)
    found = [
        (numbers_, strings.begins, strings.ends, *sparse_starts(strings))
        for numbers_, strings in text_slices(row, (sizes >= WINDOW) & (states < 2))
    ]
    keys, where = distinct([np.concatenate([np.zeros(0, "u8"), *(f[-1] for f in found)])])
    repeated = (told(row, "probes", "u1") > 0) | (np.bincount(where, minlength=len(keys[0])) > 1)
    owners, starts, lengths, used = [], [], [], 0
    for numbers_, begins, ends, opens, closes, probes in found:
        hit = repeated[where[used:used + len(probes)]]
        used += len(probes)
        opens, closes = opens[hit], closes[hit]
        text = np.searchsorted(ends, opens, side="right")
        apart = np.ones(len(opens), bool)
        apart[1:] = (text[1:] != text[:-1]) | (opens[1:] - closes[:-1] > WINDOW)
        new = np.flatnonzero(apart)
        stops = closes[np.append(new, len(opens))[1:] - 1] + WINDOW
        owners.append(numbers_[text[new]])
        starts.append(opens[new] - begins[text[new]])
        lengths.append(stops - opens[new])
    owners, starts, lengths = (np.concatenate([np.zeros(0, "i8"), *x]) for x in (owners, starts, lengths))
    live = np.zeros(len(sizes), bool)
    live[owners] = True
    done, names = np.flatnonzero(~live | (states > 0)), row["keys"]
    kept = [b"" if states[t] else texts[t] for t in done]
    # A partner stays among the texts, under no key; its own row is settled.
    open_ = np.flatnonzero(live)
    yield {
        "batch": [row["batch"]], "done_keys": [[names[t] for t in done]], "done_bytes": [sizes[done]],
        "done_removed": [np.where(states[done] > 0, sizes[done], 0)], "done_spans": [(states[done] > 0).astype("i8")],
        "done_sha256": [[hashlib.sha256(k).hexdigest() for k in kept]],
        "keys": [[None if states[t] else names[t] for t in open_]],
        "sizes": [sizes[open_].astype("<u4").tobytes()], "data": [b"".join(texts[t] for t in open_)],
        "owners": [(np.cumsum(live) - 1)[owners].astype("<u4").tobytes()], "starts": [starts.astype("<u4").tobytes()],
        "lengths": [lengths.astype("<u4").tobytes()], "settled": [states[open_].tobytes()],
    }


def region_strings(row: dict) -> Strings:
    sizes = numbers(row["sizes"]).astype("i8")
    data, begins = np.frombuffer(row["data"], "u1"), np.cumsum(sizes) - sizes
    lengths = numbers(row["lengths"]).astype("i8")
    starts = begins[numbers(row["owners"])] + numbers(row["starts"])
    at = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return Strings(data[at], lengths)


def no_keys(count: int) -> list[np.ndarray]:
    return [np.zeros(0, "u8")] * count


def triple_keys(row: dict) -> list[np.ndarray]:
    """Step 1: the triples of phrases at the sampled positions."""
    if not row["lengths"]:
        return no_keys(3)
    phrases = Phrases(region_strings(row))
    sampled = phrases.place % 3 > 0
    return [s[sampled] for s in (phrases.symbols, phrases.after(phrases.symbols, 1), phrases.after(phrases.symbols, 2))]


def named(row: dict, keys: list[np.ndarray], name: str, ranges: np.ndarray) -> np.ndarray:
    """Names of keys over all ranges: the range in the upper half, the rank in it below, in the order of the keys."""
    _, where = distinct(keys)
    return (ranges.astype("u8") << np.uint64(32) | told(row, name, "<u4")[where].astype("u8"))


class Ranked:
    """The phrases of a batch with what the steps so far have said of them."""

    def __init__(self, row: dict, ranges: int) -> None:
        self.strings = region_strings(row)
        self.phrases = p = Phrases(self.strings)
        self.sampled = p.place % 3 > 0
        keys = [s[self.sampled] for s in (p.symbols, p.after(p.symbols, 1), p.after(p.symbols, 2))]
        names = np.zeros(len(p.symbols), "u8")
        names[self.sampled] = named(row, keys, "triples", in_range(keys[0], ranges))
        # Step 2: in the string of names, the next ones of a residue are three and six positions on.
        self.rank_keys = [n[self.sampled] for n in (names, p.after(names, 3), p.after(names, 6))]
        if "ranks" in row:
            self.ranks = np.zeros(len(p.symbols), "u8")
            self.ranks[self.sampled] = named(row, self.rank_keys, "ranks", of_name(self.rank_keys[0], ranges)) << np.uint64(1)
            # Step 3: what residue 0 shares with the others.
            residue = (p.place % 3).astype("u8")
            one, two = p.after(self.ranks, 1), p.after(self.ranks, 2)
            self.merge_keys = [
                p.symbols, residue, np.where(residue == 1, 0, p.after(p.symbols, 1)).astype("u8"),
                np.where(residue == 2, two, one), np.where(residue == 0, two, self.ranks),
            ]
        if "merged" in row:
            _, where = distinct(self.merge_keys)
            said = told(row, "merged", "<u8")[where]
            fresh = in_range(p.symbols, ranges).astype("u8") << np.uint64(33) | said
            own = np.where(said & np.uint64(1) > 0, fresh, said)
            self.ranks = np.where(self.sampled, self.ranks, own)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Step 4: every window position and its key."""
        p, at = self.phrases, self.strings.positions(WINDOW)
        first = p.first[at].astype("i8")
        phrase = np.searchsorted(p.starts, first)
        stop = at + WINDOW - GRAM + 1
        behind = p.starts[phrase + RANKED]
        before = p.hashes.between(at, first) + (first - at).astype("u8")
        key = mix(mix(before) ^ mix(self.ranks[phrase] + np.uint64(1)) * np.uint64(3))
        return at, mix(key + p.hashes.between(behind, stop))


def rank_keys(row: dict, ranges: int) -> list[np.ndarray]:
    return Ranked(row, ranges).rank_keys if row["lengths"] else no_keys(3)


def merge_keys(row: dict, ranges: int) -> list[np.ndarray]:
    return Ranked(row, ranges).merge_keys if row["lengths"] else no_keys(5)


def window_keys(row: dict, ranges: int) -> list[np.ndarray]:
    return [Ranked(row, ranges).windows()[1]] if row["lengths"] else no_keys(1)


def cleaned(row: dict, ranges: int) -> Iterator[dict[str, list]]:
    """The result for all texts of a batch."""
    yield {
        "key": row["done_keys"], "n_bytes": row["done_bytes"], "n_removed": row["done_removed"],
        "n_spans": row["done_spans"], "kept_sha256": row["done_sha256"],
    }
    if not row["lengths"]:
        return
    ranked = Ranked(row, ranges)
    at, keys = ranked.windows()
    unique, where = distinct([keys])
    hit = at[(told(row, "windows", "u1")[where] > 0) | (np.bincount(where)[where] > 1)]
    # From the regions to their texts, and from windows to the bytes they cover.
    region = np.searchsorted(ranked.strings.ends, hit, side="right")
    sizes = numbers(row["sizes"]).astype("i8")
    ends = np.cumsum(sizes)
    shift = (ends - sizes)[numbers(row["owners"])] + numbers(row["starts"]) - ranked.strings.begins
    hit = hit + shift[region]
    cover = np.bincount(hit, minlength=len(row["data"]) + 1) - np.bincount(hit + WINDOW, minlength=len(row["data"]) + 1)
    gone = np.cumsum(cover)[:-1] > 0
    data = np.frombuffer(row["data"], "u1")
    out: dict[str, list] = {name: [] for name in ("key", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
    for text, settled in enumerate(row["settled"]):
        if settled:
            continue
        own = gone[ends[text] - sizes[text]:ends[text]]
        out["key"].append(row["keys"][text])
        out["n_bytes"].append(len(own))
        out["n_removed"].append(int(own.sum()))
        out["n_spans"].append(int((np.diff(own.astype("i1"), prepend=0) > 0).sum()))
        kept = data[ends[text] - sizes[text]:ends[text]][~own]
        out["kept_sha256"].append(hashlib.sha256(kept.tobytes()).hexdigest())
    yield out


# --- the operator -----------------------------------------------------------------------------------------------------


def text_batches(docs: DataFrame, key: str, text: str) -> DataFrame:
    fields = T.StructType.fromDDL(TEXTS)
    arrow = to_arrow_schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def out() -> pa.RecordBatch:
            row = [number, keys, np.array([len(t) for t in texts], "<u4").tobytes(), b"".join(texts)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = part.to_pydict()
                keys += rows["key"]
                texts += [(t or "").encode() for t in rows["text"]]
                held += sum(map(len, texts[-part.num_rows:]))
                if held >= BATCH_BYTES:
                    yield out()
                    number, keys, texts, held = number + 1, [], [], 0
        if keys:
            yield out()

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(work, fields)


def bucketed(df: DataFrame, label: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by batch. A task holds few batches, so it writes few files."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    path = fresh_path(spark, label)
    df.write.bucketBy(buckets, "batch").option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its bytes, how many of them are removed, in how many runs, and the SHA-256 of the rest."""
    total = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    buckets = total // BUCKET_BYTES + 1
    ranges = max(32, total // SPARSE * 2 // RANGE_KEYS)
    texts = bucketed(text_batches(docs, key, text), "texts", buckets)
    texts = asked(texts, copy_keys, occurrences, "copies", 2, ranges)
    texts = asked(texts, probe_keys, occurrences, "probes", 1, ranges)
    rows = bucketed(mapped(texts, regions, REGIONS), "regions", buckets)
    inside = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    ranges = max(32, inside // RANGE_KEYS)
    rows = asked(rows, triple_keys, ranks, "triples", 3, ranges)
    rows = asked(rows, lambda row: rank_keys(row, ranges), ranks, "ranks", 3, ranges, of_name)
    rows = asked(rows, lambda row: merge_keys(row, ranges), merged_ranks, "merged", 5, ranges)
    rows = asked(rows, lambda row: window_keys(row, ranges), occurrences, "windows", 1, ranges)
    return mapped(rows, lambda row: cleaned(row, ranges), RESULT).withColumnRenamed("key", key)
