"""Prefix trie of conversations: which opening turns are shared, by whom, and how many words sharing them saves.

Conversations are sequences of turn digests. Sorted, equal openings stand together, and the trie is the order itself: the
distinct sequences are dealt out in key ranges (shards), and each shard writes its part of the trie as balanced
parentheses in preorder. ``find_close`` over range min-max blocks of the excess delimits a subtree, the rank of leaf
pairs counts its leaves, and cumulative arrays give its members and savings. Nodes on the way to a shard's first or last
sequence may go on in the shards beside it (shared spines): each shard counts what it opens itself, and the parts merge by
one sum per node. A first turn that everybody shares is thus one row per shard, and equal conversations are folded to one
row before anything is sorted.

The turns of a conversation are ordered by turn, NULL first, ties by digest; NULL roles and texts are empty, rows without
conv_id take no part, a repeated row is a further turn, and no rows give no nodes. Other columns are ignored. Turns are
compared by the 128-bit digest of role and text. A conversation is one row of digests (16 bytes a turn), so that its turns
fit one task; texts of any length stay where they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulseframe.sources.staging import stage

KEY_BYTES = 16
# Digest bytes of the sequences of a shard, and ids in a part of a list of ids.
SHARD_BYTES = 8 << 20
PART_IDS = 50_000
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODES = (
    "shard int, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, open boolean"
)


def conversation_turns(rows: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each a digest (hexadecimal) and a number of words."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = rows.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t")
    )
    ordered = F.sort_array(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def rebuilt_conversations(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first ``crc32(conv_id) % most`` turns replaced by those of the first conversation of
    its family."""
    head = F.slice("turns", 1, most - 1).alias("head")
    heads = turns.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("family"), head)
    shared = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int").alias("shared")
    named = turns.select("conv_id", "turns", shared, (F.col("conv_id") - F.col("conv_id") % family).alias("family"))
    none = F.slice("turns", 1, 0)
    opening = F.coalesce(F.slice("head", F.lit(1), F.col("shared")), none)
    rest = F.filter("turns", lambda _, at: at >= F.col("shared"))
    return named.join(heads, "family", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``keys`` (the digests of its turns in a row) and ``words`` (of each turn)."""
    return conversations.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("keys"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with the lowest and highest excess of its blocks, and of blocks of blocks."""

    BLOCK = 256

    def __init__(self, bits: np.ndarray) -> None:
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype="i8")
        starts = np.arange(0, len(bits), self.BLOCK)
        low, high = np.minimum.reduceat(self.excess, starts), np.maximum.reduceat(self.excess, starts)
        self.levels = [(low, high)]
        while len(low) > 1:
            pairs = np.arange(0, len(low), 2)
            low, high = np.minimum.reduceat(low, pairs), np.maximum.reduceat(high, pairs)
            self.levels.append((low, high))

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Where each of ``opens`` closes: the first later place with an excess one lower than at it."""
        target, closes = self.excess[opens] - 1, np.full(len(opens), -1, "i8")
        waiting, at = np.arange(len(opens)), opens + 1
        while len(waiting):
            found = self.excess[at] == target[waiting]
            closes[waiting[found]] = at[found]
            at = at[~found] + 1
            waiting = waiting[~found]
            inside = at % self.BLOCK != 0
            for one in waiting[~inside]:
                closes[one] = self._from_block(int(opens[one]) // self.BLOCK + 1, int(target[one]))
            waiting, at = waiting[inside], at[inside]
        return closes

    def _from_block(self, block: int, target: int) -> int:
        level = 0
        while not self._holds(level, block, target):
            block += 1
            while block % 2 == 0 and level + 1 < len(self.levels):
                level, block = level + 1, block // 2
        while level:
            level, block = level - 1, block * 2
            block += not self._holds(level, block, target)
        start = block * self.BLOCK
        return start + int(np.argmax(self.excess[start:start + self.BLOCK] == target))

    def _holds(self, level: int, block: int, target: int) -> bool:
        low, high = self.levels[level]
        return bool(low[block] <= target <= high[block])


def shared_turns(one: bytes, other: bytes) -> int:
    """How many leading digests two sequences share."""
    most = min(len(one), len(other)) // KEY_BYTES
    if one[:most * KEY_BYTES] == other[:most * KEY_BYTES]:
        return most
    low, high = 0, most  # binary search for the first difference
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if one[:middle * KEY_BYTES] == other[:middle * KEY_BYTES] else (low, middle)
    return low


def shard_nodes(shard: int, rows: list[tuple], before: int, after: int) -> dict[str, list]:
    """The nodes of a shard. ``rows`` are its sorted distinct (keys, words, conversations, smallest conv_id); ``before``
    and ``after`` are the turns its first and last sequence share with the shards beside it, -1 where there is none."""
    bits, digests, parents, depths, words = [1], [hashlib.md5(b"")], [-1], [0], [0]
    ends, least = [0], [None]
    path, last = [0], b""
    for keys, counts, number, first in rows:
        depth = shared_turns(last, keys)
        bits += [0] * (len(path) - 1 - depth)
        del path[depth + 1:]
        for turn in range(depth, len(keys) // KEY_BYTES):
            digest = digests[path[-1]].copy()
            digest.update(keys[turn * KEY_BYTES:(turn + 1) * KEY_BYTES])
            digests.append(digest)
            parents.append(path[-1])
            depths.append(turn + 1)
            words.append(counts[turn])
            ends.append(0)
            least.append(None)
            path.append(len(digests) - 1)
            bits.append(1)
        ends[path[-1]] += number
        for node in reversed(path):  # an ancestor that has a smaller one has ancestors that have
            if least[node] is not None and least[node] <= first:
                break
            least[node] = first
        last = keys
    bits += [0] * len(path)

    bits = np.array(bits, "u1")
    opens = np.flatnonzero(bits)
    count = len(opens)
    size = (Parentheses(bits).find_close(opens) - opens + 1) // 2
    start, stop = np.arange(count), np.arange(count) + size
    depth, up = np.array(depths), np.array(parents)
    # The way to the first sequence is an unbroken run of nodes, that to the last one is the path left.
    on_first = np.zeros(count, bool)
    on_first[:len(rows[0][0]) // KEY_BYTES + 1] = True
    on_last = np.zeros(count, bool)
    on_last[path] = True
    taken_over, goes_on = on_first & (depth <= before), on_last & (depth <= after)
    leaf = (size == 1) & ~(goes_on & (depth == after))
    new_child = np.bincount(up[1:][~taken_over[1:]], minlength=count)

    def within(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[stop] - sums[start]

    members, word = within(np.array(ends, "i8")), np.array(words, "i8")
    saved = within(members * word - np.where(taken_over, 0, word))
    is_open = taken_over | goes_on
    names = [d.digest() for d in digests]
    parent_id = [None if p < 0 or is_open[p] else least[p] for p in parents]
    return {
        "shard": [shard] * count, "node": names, "parent": [names[p] if p >= 0 else None for p in parents],
        "depth": depth, "conv_id": least, "parent_conv_id": parent_id, "n_convs": members, "n_children": new_child,
        "n_leaves": within(leaf.astype("i8")), "saved_tokens": saved, "open": is_open,
    }


def _mapped(df: DataFrame, work, schema: str) -> DataFrame:
    """``df.mapInArrow`` where ``work`` yields columns by name from a stream of rows."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(r.values()) for batch in batches for r in batch.to_pylist())
        for out in work(rows):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def _nodes_by_shard(rows: Iterator[tuple]) -> Iterator[dict[str, list]]:
    current, held, beside = None, [], (-1, -1)
    for shard, keys, words, number, first, before, after in rows:
        if shard != current:
            if held:
                yield shard_nodes(current, held, *beside)
            current, held, beside = shard, [], (before, after)
        held.append((keys, words, number, first))
    if held:
        yield shard_nodes(current, held, *beside)


def _parts(rows: Iterator[tuple]) -> Iterator[dict[str, list]]:
    """Sorted (node, conv_id) as parts of id lists: node, first id, ids joined by commas."""
    out: dict[str, list] = {"node": [], "first": [], "ids": []}
    node, ids, size = None, [], 0

    def close() -> None:
        if ids:
            out["node"].append(node)
            out["first"].append(ids[0])
            out["ids"].append(",".join(map(str, ids)))

    for one, conv_id in rows:
        if one != node or len(ids) >= PART_IDS:
            close()
            size += len(ids)
            node, ids = one, []
            if size >= PART_IDS:
                yield out
                out, size = {"node": [], "first": [], "ids": []}, 0
        ids.append(conv_id)
    close()
    yield out


def _digests(rows: Iterator[tuple]) -> Iterator[dict[str, list]]:
    """The digest of each node's parts, streamed in order."""
    nodes: list[bytes] = []
    digests: list[str] = []
    current = None
    for node, _, ids in rows:
        if nodes and nodes[-1] == node:
            current.update(b",")
        else:
            if nodes:
                digests.append(current.hexdigest())
            if len(nodes) >= PART_IDS:
                yield {"node": nodes, "ends_sha256": digests}
                nodes, digests = [], []
            nodes.append(node)
            current = hashlib.sha256()
        current.update(ids.encode())
    if nodes:
        digests.append(current.hexdigest())
        yield {"node": nodes, "ends_sha256": digests}


def end_digests(found: DataFrame) -> DataFrame:
    """``node`` and the digest of the ascending ids of the conversations that end there. The ids of a node are sorted in
    ranges, so a node with a third of them is split, and join as parts of ``PART_IDS``, which one task streams."""
    ids = found.select(F.unhex(F.md5("keys")).alias("node"), "conv_id")
    ranges = ids.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    parts = _mapped(ranges, _parts, "node binary, first long, ids string")
    whole = parts.repartition("node").sortWithinPartitions("node", "first")
    return _mapped(whole, _digests, "node binary, ends_sha256 string")


def _beside(ordered: DataFrame) -> DataFrame:
    """``shard`` and the turns shared with the shards before and after it; one row per shard."""
    ends = ordered.groupBy("shard").agg(F.min("keys").alias("low"), F.max("keys").alias("high"))
    order = Window.orderBy("shard")
    near = ends.select("shard", F.lag("high").over(order), "low", "high", F.lead("low").over(order))

    def work(rows: Iterator[tuple]) -> Iterator[dict[str, list]]:
        shared = lambda one, other: -1 if one is None or other is None else shared_turns(one, other)
        for shard, earlier, low, high, later in rows:
            yield {"shard": [shard], "before": [shared(earlier, low)], "after": [shared(high, later)]}

    return _mapped(near, work, "shard int, before int, after int")


def trie_nodes(found: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per node of the trie over ``found`` (see ``sequences``). Distinct sequences, their order and the nodes of
    the shards are written to the shared folder."""
    distinct = found.groupBy("keys", "words").agg(F.count("*").alias("number"), F.min("conv_id").alias("first"))
    distinct = stage(distinct, "sequences")
    total = distinct.agg(F.sum(F.length("keys") + KEY_BYTES)).first()[0] or 0
    ordered = distinct.repartitionByRange(total // shard_bytes + 1, "keys").withColumn("shard", F.spark_partition_id())
    ordered = stage(ordered, "ordered").select("shard", "keys", "words", "number", "first")
    sharded = ordered.join(_beside(ordered), "shard").repartition("shard").sortWithinPartitions("shard", "keys")
    nodes = stage(_mapped(sharded, _nodes_by_shard, NODES), "nodes")

    figures = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    parts = nodes.where("open")
    spines = parts.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(n).alias(n) for n in figures]
    )
    ids = spines.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    spines = spines.join(ids, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    # A spine node is looked up once per shard, so the children of a hot one are spread over its shards.
    local = parts.select("shard", F.col("node").alias("parent")).join(ids, "parent")
    closed = nodes.where("NOT open").join(local, ["shard", "parent"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above")
    )
    columns = ["node", "conv_id", "depth", "parent_conv_id", *figures]
    return closed.select(columns).unionByName(spines.select(columns))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie over the rebuilt conversations of ``rows`` (conv_id, turn, role, text)."""
    found = stage(sequences(rebuilt_conversations(conversation_turns(rows))), "conversations")
    nodes = trie_nodes(found).join(end_digests(found), "node", "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
