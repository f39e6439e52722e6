"""Byte-level BPE: encode whole texts into token ids, and ids back into bytes.

The vocabulary is a local rank file that every executor can open (its path is a parameter); each Python worker loads
it once. A long text is cut before encoding, only where a piece of the pattern ends in any case, so that the ids are
those of the uncut text while the working memory follows the chunk and not the text.

NULL and empty texts have no ids and decode to no bytes. Repeated rows give repeated rows; ids are a pure function of
the text. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from pulseframe.llm.common import map_texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHUNK = 50_000
# A single space between two other characters always opens the next piece; a digit after a letter does, too.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=[A-Za-z])(?=[0-9])")
# White space as the pattern knows it. Long runs would exhaust the backtracking stack of the regex engine.
WHITE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """Parts of a text that encode independently, each with a flag: whether it is one piece by itself.

    A run of at least 1,000 white-space characters is one piece except its last character, which opens what follows
    (at the end of the text it is one piece as a whole). Between such runs, parts have about ``size`` characters as
    long as a safe cut exists.
    """
    start = 0
    runs = WHITE_RUN.finditer(text) if len(text) >= 1000 else ()
    for run in runs:
        stop = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _cut(text[start:run.start()], size))
        yield text[run.start():stop], True
        start = stop
    yield from ((part, False) for part in _cut(text[start:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        found = SAFE_CUT.search(text, start + size)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    if start < len(text):
        yield text[start:]


def encode_to_list(text: str | None, coder: tiktoken.Encoding, size: int = CHUNK) -> list[int]:
    """Token ids of a whole text, without special tokens."""
    if not text:
        return []
    if len(text) < 1000:
        return coder.encode_ordinary(text)
    return list(chain.from_iterable(
        coder._encode_single_piece(part) if single else coder.encode_ordinary(part) for part, single in chunks(text, size)
    ))


def encode(text: str | None, coder: tiktoken.Encoding, size: int = CHUNK) -> np.ndarray:
    """The same as unsigned 32-bit numbers."""
    return np.array(encode_to_list(text, coder, size), "<u4")


def decode(ids: np.ndarray, coder: tiktoken.Encoding) -> bytes:
    """The bytes of token ids. They need not be valid UTF-8 where ids were cut inside a character."""
    return coder.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit numbers) and ``n_tokens`` of every text."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        coder = encoding(ranks)
        ids = [encode(t, coder) for t in rows["text"]]
        return {"key": rows["key"], "n_tokens": [len(i) for i in ids], "ids": [i.tobytes() for i in ids]}

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return map_texts(narrow, "text", work, "key long, n_tokens long, ids binary").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, key: str = "doc_id", ranks: str = RANKS) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        coder = encoding(ranks)
        decoded = [decode(np.frombuffer(i or b"", "<u4"), coder) for i in rows["ids"]]
        return {"key": rows["key"], "n_tokens": rows["n_tokens"], "ids": rows["ids"], "decoded": decoded}

    narrow = encoded.withColumnRenamed(key, "key").select("key", "n_tokens", "ids")
    return map_texts(narrow, "ids", work, "key long, n_tokens long, ids binary, decoded binary").withColumnRenamed(
        "key", key
    )


def token_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Encode and decode every text and return the token count and the SHA-256 of both results.

    The same functions as above, without sending ids and bytes to the JVM and back.
    """

    def work(rows: dict[str, list]) -> dict[str, list]:
        coder, out = encoding(ranks), {"key": rows["key"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in rows["text"]:
            ids = encode(t, coder)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decode(ids, coder)).hexdigest())
        return out

    narrow = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return map_texts(
        narrow, "text", work, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("key", key)
