"""Secrets in texts: three base patterns, and random strings shown by the token-efficiency test.

A BPE vocabulary packs words into few tokens and random strings into many, so a low ratio of characters to tokens
exposes keys that no pattern knows. Candidates are runs of key characters; known digests (hexadecimal runs of digest
length), UUIDs, numbers and identifiers are not tested. An identifier is made of words that take few tokens, numbers,
words with a short number (``build12``), and, for up to three quarters of its parts, short tags (``v2``, ``x86``, ``utf8mb4``).
Short parts take few characters a token by nature, so a candidate only looks random if unknown parts are at least half of
its letters and digits. What base patterns leave of a run is a candidate of its own. If a candidate as a whole does not
look random, its parts between separators are tested, each with as many of the next ones as the least length takes; a span
of such parts ends where words, numbers, digests or UUIDs begin.

Offsets count code points, ends are exclusive. NULL is an empty text; an empty text has no spans. Spans of equal start
are in the order of ``KINDS``. Repeated rows give repeated rows; other columns are ignored. Whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from pulseframe.llm.bpe import RANKS, encode, encoding
from pulseframe.llm.common import map_texts

# The three base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

# The token-efficiency test: shortest candidate, highest ratio of characters to tokens that still looks random.
RANDOM_LEAST = 20
RANDOM_RATIO = 2.1
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{RANDOM_LEAST},}}")
# A maximal lower-case run of the hex pattern's length; the same matches as the pattern with its length test.
HEX_LONG = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+")
SEPARATORS = "+/_=-"
SHORT_WORD = 3
# A tag is made of short words and short numbers in turn.
TAG = re.compile(r"[A-Za-z]+|[0-9]+")
TAG_PIECES, TAG_DIGITS = 4, 4
UNKNOWN, PLAIN, TAGGED = range(3)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def is_digest(part: str) -> bool:
    return bool(len(part) in DIGEST_LENGTHS and DIGEST.fullmatch(part) or UUID.fullmatch(part))


def is_word(part: str, coder) -> bool:
    """Whether letters are short or take few tokens."""
    return len(part) <= SHORT_WORD or len(part) > RANDOM_RATIO * len(encode(part, coder))


def kind_of(part: str, coder) -> int:
    """``PLAIN`` for digests, numbers, words and longer words with one short number, ``TAGGED`` for other short mixtures of
    words and numbers, else ``UNKNOWN``."""
    if part.isdigit() or is_digest(part):
        return PLAIN
    if part.isalpha():
        return PLAIN if is_word(part, coder) else UNKNOWN
    pieces = TAG.findall(part)
    if len(pieces) > TAG_PIECES or not all(len(p) <= TAG_DIGITS if p.isdigit() else is_word(p, coder) for p in pieces):
        return UNKNOWN
    return PLAIN if len(pieces) == 2 and len(pieces[0]) > SHORT_WORD and pieces[0].isalpha() else TAGGED


def is_identifier(kinds: list[int]) -> bool:
    """Whether parts of these kinds make an identifier: none unknown, a quarter plain."""
    return UNKNOWN not in kinds and 4 * kinds.count(TAGGED) <= 3 * len(kinds)


def looks_random(candidate: str, coder, parts: list[tuple[int, int]], kinds: list[int]) -> bool:
    """Whether a candidate takes many tokens, and not only because its words and numbers are short."""
    size = [b - a for a, b in parts]
    known = 0 if UNKNOWN not in kinds else sum(n for n, k in zip(size, kinds, strict=True) if k != UNKNOWN)
    return 2 * known <= sum(size) and len(candidate) <= RANDOM_RATIO * len(encode(candidate, coder))


def random_parts(candidate: str, coder, parts: list[tuple[int, int]], kinds: list[int]) -> list[tuple[int, int]]:
    """Spans of the parts of a candidate that look random though the whole does not."""
    digest = [is_digest(candidate[a:b]) for a, b in parts]
    plain = [kind == PLAIN for kind in kinds]
    marked = [False] * len(parts)
    reach = last = 0
    for first in range(len(parts)):
        while last < len(parts) and parts[last][1] - parts[first][0] < RANDOM_LEAST:
            last += 1
        if last == len(parts):
            break
        last = max(last, first)
        window = slice(first, last + 1)
        if any(digest[window]) or is_identifier(kinds[window]):
            continue
        if looks_random(candidate[parts[first][0]:parts[last][1]], coder, parts[window], kinds[window]):
            for n in range(max(first, reach), last + 1):
                marked[n] = True
            reach = last + 1
    found, n = [], 0
    while n < len(parts):
        if not marked[n]:
            n += 1
            continue
        stop = n
        while stop < len(parts) and marked[stop]:
            stop += 1
        first, end = n, stop
        while plain[first] and first < end - 1:
            first += 1
        while plain[end - 1] and end - 1 > first:
            end -= 1
        if parts[end - 1][1] - parts[first][0] < RANDOM_LEAST:  # short without the plain parts at its ends
            first, end = n, stop
        while first and not plain[first - 1]:
            first -= 1
        while end < len(parts) and not plain[end]:
            end += 1
        start, close = parts[first][0], parts[end - 1][1]
        while close < len(candidate) and candidate[close] == "=":
            close += 1
        if found and found[-1][1] > start:
            start = found.pop()[0]
        found.append((start, close))
        n = max(stop, end)
    return found


def random_spans(text: str, coder, covered: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What lies outside the ``covered`` spans and has short tokens."""
    found, at = [], 0
    for m in CANDIDATE.finditer(text):
        while at < len(covered) and covered[at][2] <= m.start():
            at += 1
        stretches, start, n = [], m.start(), at
        while n < len(covered) and covered[n][0] < m.end():
            stretches.append((start, covered[n][0]))
            start = max(start, covered[n][2])
            n += 1
        for start, end in [*stretches, (start, m.end())]:
            if (start, end) != m.span():  # no separator that only led on to a base span
                while start < end and text[start] in SEPARATORS:
                    start += 1
                while start < end and text[end - 1] in SEPARATORS and (text[end - 1] != "=" or end != m.end()):
                    end -= 1
            candidate = text[start:end]
            if len(candidate) < RANDOM_LEAST:
                continue
            parts = [m.span() for m in PART.finditer(candidate)]
            kinds = [kind_of(candidate[a:b], coder) for a, b in parts]
            if is_identifier(kinds):
                continue
            if looks_random(candidate, coder, parts, kinds):
                found.append((start, 3, end))
            else:
                found += [(start + a, 3, start + b) for a, b in random_parts(candidate, coder, parts, kinds)]
    return found


def spans(text: str | None, coder) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text, both by start, then kind."""
    base = base_spans(text) if text else []
    return base, sorted(base + random_spans(text, coder, base)) if text else []


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def redact(text: str | None, found: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; spans that touch or overlap become one mark."""
    if not found:
        return text
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans of every text."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        coder = encoding(ranks)
        out = {"key": rows["key"], "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
        for t in rows["text"]:
            base, every = spans(t, coder)
            kinds = [kind for _, kind, _ in base]
            for number, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(kinds.count(number))
            out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            out["spans"].append(written(every))
        return out

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    schema = "key long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(narrow, "text", work, schema).withColumnRenamed("key", key)


def redact_documents(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``docs``, all columns and rows, with every secret of ``text`` replaced by a mark."""
    schema = docs.schema
    at = schema.fieldNames().index(text)

    def work(batches):
        import pyarrow as pa

        from pulseframe.llm.common import slices

        coder = encoding(ranks)
        for batch in batches:
            for part in slices(batch, text):
                clean = [redact(t, spans(t, coder)[1]) for t in part.column(at).to_pylist()]
                columns = part.columns
                columns[at] = pa.array(clean, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(work, schema)
