"""What several operators share: reading tables, mapping Arrow batches in bounded slices, words as 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORD = re.compile(r"\w+")
# Text bytes that a slice of an Arrow batch holds before the next slice begins; one longer text is a slice alone.
SLICE_BYTES = 1 << 20
# Distinct words whose hashes a task remembers.
CACHE_WORDS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts pass ``limit`` bytes, so that what is worked out at once stays bounded."""
    sizes = np.cumsum(np.fromiter((n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()), "i8"))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    df: DataFrame, text: str, work: Callable[[dict[str, list]], dict[str, Sequence]], schema: str
) -> DataFrame:
    """Apply ``work`` to bounded slices of the rows of ``df``.

    ``work`` gets the columns of a slice as lists and returns the columns of ``schema`` as lists or arrays; a slice
    without output rows returns empty ones.
    """
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                out = work(part.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(mapped, fields)


class WordHashes(dict):
    """The 64-bit hash of a word, worked out once while the cache has room."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the lower-case words (runs of letters, digits and underscores) of a text; NULL has none."""
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(cache.__getitem__, words), "u8", len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of a public pseudo-random generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
