import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from tests_data import SF_DIR

from pulseframe.llm import prefix_trie, suffix_array, token_align
from pulseframe.llm.common import table


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or (0 if not isinstance(x, str) else x)) for x in r))


# ---- op11


def plain_trie(rows):
    conversations = {}
    for c, t, role, text in rows:
        if c is not None:
            conversations.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for c, turns in conversations.items():
        conversations[c] = [x[2:] for x in sorted(turns, key=lambda x: x[:2])]
    members, ends, children = {}, {}, {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + -c % 20
        rebuilt = tuple(conversations.get(base, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append(c)
        ends.setdefault(rebuilt, []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[b] for b in below) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[b] for b in below)
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
         sha(",".join(map(str, sorted(ends.get(p, [])))).encode()))
        for p, m in members.items()
    ]


@pytest.mark.parametrize("length", [2, 10, 300, 5000])
def test_find_close(length):
    pick = random.Random(length)
    for _ in range(10):
        bits, depth = [1], 1
        while len(bits) < length:
            opening = depth == 1 or pick.random() < 0.5
            bits.append(int(opening))
            depth += 1 if opening else -1
        bits = np.array(bits + [0] * depth, "u1")
        stack, closes = [], {}
        for at, bit in enumerate(bits):
            if bit:
                stack.append(at)
            else:
                closes[stack.pop()] = at
        opens = np.flatnonzero(bits)
        assert prefix_trie.Parentheses(bits).find_close(opens).tolist() == [closes[o] for o in opens]


def test_shared_turns():
    keys = [bytes([i]) * 16 for i in range(9)]
    for n in range(9):
        for m in range(9):
            assert prefix_trie.shared_turns(b"".join(keys[:n]), b"".join(keys[:m])) == min(n, m)
    assert prefix_trie.shared_turns(b"".join(keys), b"".join(keys[:4]) + bytes(16) * 5) == 4


def test_trie_of_the_table(spark):
    rows = table(spark, SF_DIR, "conversations")
    expected = plain_trie([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert ordered(prefix_trie.prefix_trie(rows).collect()) == ordered(expected)


@pytest.mark.parametrize("shard_bytes", [100, 700, 1 << 20])
def test_trie_over_shards(spark, shard_bytes):
    """Hot first turns, equal conversations, prefixes of one another, NULLs and repeated rows, cut into shards."""
    pick = random.Random(3)
    rows = []
    for c in [*range(-45, 300), None]:
        shared = pick.randint(0, 6)
        for t in range(pick.randint(1, 9)):
            text = f"turn {t}" if t < shared else pick.choice(["", None, f" own\t{c}\x0b{t}\n ", "a b  c", "é\xa0x y"])
            rows.append((c, pick.choice([t, t, t, None]) if t == 0 else t, pick.choice(["user", "user", None]), text, "x", 1))
    rows += [r for r in rows if r[0] == 40]
    names = "conv_id long, turn long, role string, text string, keys string, shard int"
    data = spark.createDataFrame(rows, names).repartition(3)
    turns = prefix_trie.rebuilt_conversations(prefix_trie.conversation_turns(data))
    found = prefix_trie.sequences(turns)
    nodes = prefix_trie.trie_nodes(found, shard_bytes).join(prefix_trie.end_digests(found), "node", "left")
    got = [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or sha(b""))
        for r in nodes.collect()
    ]
    # Ties in turn (conversation 40) are ordered by digest, so the plain version gets them in that order.
    digest = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    plain = sorted((r[:4] for r in rows), key=digest)
    assert ordered(got) == ordered(plain_trie(plain))


def test_ends_of_a_hot_node(spark, monkeypatch):
    """Thousands of equal conversations: their ids join in order over several parts and tasks."""
    monkeypatch.setattr(prefix_trie, "PART_IDS", 100)
    keys = bytes(range(16))
    found = spark.range(5000).selectExpr("id AS conv_id").repartition(7)
    from pyspark.sql import functions as F

    found = found.withColumn("keys", F.lit(keys))
    rows = prefix_trie.end_digests(found).collect()
    assert [(r.node, r.ends_sha256) for r in rows] == [
        (hashlib.md5(keys).digest(), sha(",".join(map(str, range(5000))).encode()))
    ]


def test_trie_of_nothing(spark):
    empty = table(spark, SF_DIR, "conversations").limit(0)
    assert prefix_trie.prefix_trie(empty).collect() == []


def test_turnless_conversations(spark):
    """A conversation that loses all its turns is a member of the root alone."""
    lost = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = spark.createDataFrame([(lost, 0, "user", "gone")], "conv_id long, turn long, role string, text string")
    assert ordered(prefix_trie.prefix_trie(rows).collect()) == [
        (lost, 0, None, 1, 0, 1, 0, sha(str(lost).encode()))
    ]


# ---- op12


def plain_removal(rows, width=suffix_array.WINDOW):
    seen = Counter()
    texts = [(k, (t or "").encode()) for k, t in rows]
    for _, b in texts:
        seen.update(b[i:i + width] for i in range(len(b) - width + 1))
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\x01" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def planted_texts(seed):
    pick = random.Random(seed)
    passages = [
        "".join(pick.choice("abcdé \n") for _ in range(pick.choice([300, 399, 400, 401, 450, 800, 3000]))) for _ in range(20)
    ]
    rows = []
    for k in range(150):
        text = ""
        for _ in range(pick.randint(0, 4)):
            passage = pick.choice(passages)
            start = pick.randint(0, len(passage)) if pick.random() < 0.7 else 0
            text += passage[start:pick.randint(start, len(passage)) if pick.random() < 0.5 else None]
            text += "".join(pick.choice("xyz ") for _ in range(pick.choice([0, 0, 30, 300])))
        rows.append((k, text))
    return rows + [
        (1000, None), (1001, ""), (1002, "a" * 5000), (1003, "ab" * 900 + "q"), (1004, "b" + "a" * 399), (1005, "x" * 400),
        (1006, "x" * 400), (None, "x" * 399), (None, passages[5]), (7, passages[5]), (7, "zz"), (1010, "y" * 401),
        (1011, "y" * 400), (1012, "once " + "".join(pick.choice("abc ") for _ in range(20_000))),
    ]


@pytest.mark.parametrize("seed, batch_bytes", [(1, 5_000), (2, 40_000), (3, 1 << 22)])
def test_removed_bytes_are_those_of_the_plain_version(spark, monkeypatch, seed, batch_bytes):
    """Passages cut anywhere, runs of one letter, copies, texts at the limit, NULLs and repeated ids."""
    monkeypatch.setattr(suffix_array, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(suffix_array, "SLICE_BYTES", batch_bytes // 4)
    rows = planted_texts(seed)
    docs = spark.createDataFrame([(*r, "x", b"y") for r in rows], "doc_id long, text string, key string, data binary")
    got = suffix_array.without_repeats(docs.repartition(4))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert ordered(got.collect()) == ordered(plain_removal(rows))


def test_removed_bytes_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    got = suffix_array.without_repeats(docs).collect()
    expected = plain_removal([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert ordered(got) == ordered(expected)
    assert any(r[2] for r in expected)


def test_removal_of_edge_cases(spark, edge_docs, no_docs):
    expected = plain_removal([tuple(r) for r in edge_docs.where("doc_id IS NULL OR doc_id NOT IN (3, 4)").select("doc_id", "text").collect()])
    whole = [(3, 150_000, 150_000, 1, sha(b"")), (4, 200_000, 200_000, 1, sha(b""))]
    assert ordered(suffix_array.without_repeats(edge_docs).collect()) == ordered(expected + whole)
    assert suffix_array.without_repeats(no_docs).collect() == []


def test_equal_windows_are_cut_alike():
    """Phrase starts in a window depend on the window alone."""
    pick = random.Random(9)
    middle = bytes(pick.choice(b"abc") for _ in range(900))
    cuts = []
    for _ in range(5):
        before = bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 200)))
        data = np.frombuffer(before + middle + before, "u1")
        strings = suffix_array.Strings(data, np.array([len(data)]))
        phrases = suffix_array.Phrases(strings)
        inside = phrases.starts[(phrases.starts >= len(before) + 28) & (phrases.starts < len(before) + 850)]
        cuts.append((inside - len(before)).tolist())
    assert all(c == cuts[0] for c in cuts)


def test_smallest_of_a_width():
    pick = np.random.default_rng(4)
    for width in (1, 2, 5, 28, 128):
        values = pick.integers(0, 50, 400).astype("u8")
        got = suffix_array.first_smallest(values, width)
        for i in range(400 - width + 1):
            window = values[i:i + width]
            assert got[i] == i + width - 1 - int(np.argmin(window[::-1]))


def test_smallest_across_blocks():
    """Places do not depend on where a block of positions ends, and never move back."""
    values = np.random.default_rng(5).integers(0, 1 << 48, 3 * suffix_array.PLACES // 2).astype("u8")
    values[-suffix_array.PLACES:] %= 3
    got = suffix_array.first_smallest(values, 128)
    windows = np.lib.stride_tricks.sliding_window_view(values, 128)[:, ::-1]
    assert (got == np.arange(len(got)) + 127 - windows.argmin(axis=1)).all()
    assert (np.diff(got) >= 0).all()


def test_regions_look_at_a_text_once(monkeypatch):
    """Phrase starts of a batch are found once; its regions are those of all windows whose start's probe is repeated."""
    pick = random.Random(6)
    shared = bytes(pick.choice(b"abcd") for _ in range(1500))
    parts = [bytes(pick.choice(b"wxyz") for _ in range(n)) for n in (900, 100, 2000, 50)]
    texts = [shared + parts[0], parts[1] + shared[300:], parts[2], shared[:700] + parts[3] + shared[700:], b"short", b""]
    row = {
        "batch": 1, "keys": list(range(6)), "sizes": np.array([len(t) for t in texts], "<u4").tobytes(),
        "data": b"".join(texts), "copies": None, "probes": None,
    }
    row["copies"] = [np.zeros(4, "u1").tobytes()]
    row["probes"] = [np.zeros(len(suffix_array.distinct(suffix_array.probe_keys(row))[0][0]), "u1").tobytes()]
    calls = []
    plain = suffix_array.sparse_starts
    monkeypatch.setattr(suffix_array, "sparse_starts", lambda s: calls.append(len(s.data)) or plain(s))
    [out] = suffix_array.regions(row)
    assert calls == [sum(len(t) for t in texts[:4])]
    assert out["done_keys"] == [[2, 4, 5]] and out["keys"] == [[0, 1, 3]]
    inside = [[False] * len(t) for t in texts]
    live = [0, 1, 3]
    for owner, start, length in zip(*(np.frombuffer(out[n][0], "<u4") for n in ("owners", "starts", "lengths"))):
        inside[live[owner]][start:start + length] = [True] * int(length)
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    for text, covered in zip(texts, inside):
        assert all(all(covered[i:i + 400]) for i in range(len(text) - 399) if seen[text[i:i + 400]] > 1)
    assert sum(map(sum, inside)) < 3 * 1500


# ---- op13


def plain_alignment(rows):
    a, b = token_align.coders(token_align.A_FILE, token_align.B_FILE)
    counts, found = Counter(), []
    for key, text in rows:
        whole = b" " + (text or "").encode()
        [a_ids], [b_ids] = a.encode([text or ""]), b.encode([text or ""])
        joined = [b"".join(c.tokens[i] for i in ids) for c, ids in ((a, a_ids), (b, b_ids))]
        if not text or joined != [whole, whole]:
            found.append((key, [], [], [], []))
            continue
        spans = []
        for coder, ids in ((a, a_ids), (b, b_ids)):
            ends = np.cumsum([coder.lengths[i] for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links, start = [], 0
        for (x, y), i in zip(spans[0], a_ids):
            while spans[1][start][1] <= x:
                start += 1
            at = start
            while at < len(b_ids) and spans[1][at][0] < y:
                links.append((i, b_ids[at]))
                at += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            sides = [
                ",".join(str(i) for (x, y), i in zip(span, ids) if low <= x and y <= cut)
                for span, ids in zip(spans, (a_ids, b_ids))
            ] if len(a_ids) < 3000 else None
            groups.append("|".join(sides) if sides else None)
            low = cut
        counts.update(links)
        found.append((key, a_ids, b_ids, groups, links))
    most = Counter()
    for (_, piece), n in counts.items():
        most[piece] = max(most[piece], n)
    return [
        (key, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
         sum(counts[p] for p in links), sha(";".join(groups).encode()) if groups and groups[0] else "" if not groups else None)
        for key, a_ids, b_ids, groups, links in found
    ]


def same_alignment(got, expected):
    got, expected = ordered(got), ordered(expected)
    assert len(got) == len(expected)
    for mine, plain in zip(got, expected):
        assert mine[:7] == plain[:7]
        assert plain[7] is None or mine[7] == plain[7]


ODD_TEXTS = [
    "", None, " ", "  two  spaces ", "\n\n", "<s> </s> <unk> <|endoftext|> <0x0A>", "▁ is a mark", "日本語 テキスト 🙂🙂",
    "a\x00b", "tab\tand\r\nlines", "é è ê", "x" * 3000, "word " * 2000, " lead", "trail ", "don't they've I'll", "1234 5678",
]


def test_alignment_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents").where("length(text) < 6000")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same_alignment(token_align.alignment_digests(docs).collect(), plain_alignment(rows))


@pytest.mark.parametrize("batch_bytes", [50, 4_000, 1 << 20])
def test_alignment_of_odd_texts(spark, monkeypatch, batch_bytes):
    """Counts are corpus-wide, whatever the batches; control strings are plain text; a text that does not join to
    itself has no tokens."""
    monkeypatch.setattr(token_align, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(token_align, "SLICE_BYTES", 64)
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "nobody's text"), (4, "again"), (4, "again")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, pair int").repartition(3)
    got = token_align.alignment_digests(docs).collect()
    same_alignment(got, plain_alignment(rows))
    assert next(r for r in got if r.doc_id == 6).n_a == 0


def test_alignment_of_edge_cases(spark, edge_docs, no_docs):
    got = token_align.alignment_digests(edge_docs).collect()
    same_alignment(got, plain_alignment([tuple(r) for r in edge_docs.select("doc_id", "text").collect()]))
    assert token_align.alignment_digests(no_docs).collect() == []


def test_memory_of_alignment_is_bounded_by_batches(spark, monkeypatch, tmp_path):
    """However many batches a task has, a file holds few of them, and each is sent to a worker as a group of its own."""
    monkeypatch.setattr(token_align, "BATCH_BYTES", 1_000)
    monkeypatch.setattr(token_align, "SLICE_BYTES", 64)
    monkeypatch.setattr(token_align, "FILE_BATCHES", 3, raising=False)
    monkeypatch.setattr(token_align, "fresh_path", lambda *_: str(tmp_path / "staged"))
    rows = [(k, f"text {k} of some words " * 20) for k in range(30)]
    found = token_align.alignment_digests(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    staged = [pq.read_metadata(f).num_rows for f in (tmp_path / "staged").glob("*.parquet")]
    assert max(staged) <= 3 < sum(staged)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan
    same_alignment(found.collect(), plain_alignment(rows))


def test_window_alignment():
    lengths = [0, 1, 2, 3]
    assert token_align.align([3, 1], [1, 2, 1], lengths, lengths) == ("3|1,2;1|1", 2, [3 << 32 | 1, 3 << 32 | 2, 1 << 32 | 1])
    assert token_align.align([2, 2], [1, 2, 1], lengths, lengths) == (
        "2,2|1,2,1", 1, [2 << 32 | 1, 2 << 32 | 2, 2 << 32 | 2, 2 << 32 | 1]
    )


def test_every_token_has_bytes():
    a, b = token_align.coders(token_align.A_FILE, token_align.B_FILE)
    assert min(a.lengths) > 0 and min(b.lengths) > 0
    assert sorted(token_align.byte_level_alphabet().values()) == list(range(256))


def test_ranks_and_json_give_the_same_ids():
    """Random Latin-1 texts with controls, odd white space, contractions and control strings, by either file."""
    ranked, plain = token_align.ByteCoder(token_align.A_FILE, token_align.A_RANKS), token_align.ByteCoder(token_align.A_FILE, None)
    pick = random.Random(8)
    usual = list(" \n\tab1'\xe9\xa0\x85\x1c\x1d") + ["'s", "'re", "<|endoftext|>", "  "]
    texts = [
        "".join(chr(pick.randrange(256)) if pick.random() < 0.3 else pick.choice(usual) for _ in range(pick.randint(0, 60)))
        for _ in range(3000)
    ]
    assert ranked.encode(texts) == plain.encode(texts)


def test_documents_of_a_slice_are_aligned_at_once(monkeypatch):
    a, b = token_align.coders(token_align.A_FILE, token_align.B_FILE)
    texts = ["one two two", "two", "", "one two two", " two  spaces\nand a line", "x"]
    encoded = [(i, j) if t else None for t, i, j in zip(texts, a.encode(texts), b.encode(texts))]
    calls, align_all = [], token_align.alignment
    monkeypatch.setattr(token_align, "alignment", lambda *ids: calls.append(ids) or align_all(*ids))
    batch = token_align.Batch(a, b)
    batch.add(list(range(6)), encoded)
    assert len(calls) == 1
    batch.add([6, None], [encoded[4], None])  # nothing new
    assert len(batch.strings) == len(batch.windows) == sum(len(x) for x in batch.links)
    for (key, n_a, n_b, groups, links, digest, _), pair in zip(batch.rows, [*encoded, encoded[4], None]):
        if not pair:
            assert (n_a, n_b, groups, links, digest) == (0, 0, 0, 0, "")
            continue
        said, n, linked = plain_groups(pair, a, b)
        assert (n_a, n_b, groups, links) == (len(pair[0]), len(pair[1]), n, linked)
        assert digest == hashlib.sha256(said.encode()).hexdigest()


def plain_groups(pair, a, b):
    """Groups of one document by walking both lists, their string, their number and the number of links."""
    ends = [list(np.cumsum([coder.lengths[i] for i in ids])) for coder, ids in zip((a, b), pair)]
    shared = sorted(set(ends[0]) & set(ends[1]))
    part = lambda side, low, high: ",".join(str(i) for i, end in zip(pair[side], ends[side]) if low < end <= high)
    said = ";".join(f"{part(0, low, high)}|{part(1, low, high)}" for low, high in zip([0, *shared], shared))
    return said, len(shared), len(set(ends[0]) | set(ends[1]))
