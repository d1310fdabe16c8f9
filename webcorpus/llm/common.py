"""Word hashing and small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from webcorpus.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: the 64-bit golden ratio


def prepare(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch of texts: by bytes, and by rows of a few kilobytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows as a table in a folder: computed once, lineage cut, safe to lose executors.

    What was shuffled for it is deleted at the end of the write; else it stays until the driver
    happens to collect its garbage, and the shuffles of all steps are on disk at once.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table of its own in the shared folder."""
    return stored(df, scratch_path(df.sparkSession, label))


def words(text: bytes) -> list[bytes]:
    """Words between the ASCII blanks 0x20 and 0x09 to 0x0D, with A-Z in lower case."""
    return text.lower().split()


class WordHashes(dict):
    """64-bit hash by word, remembered for a bounded number of words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)  # fixed values of the finaliser
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k words, by position; none where there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * ODD + hashes[j : j + n]
    return mix(out)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; a text of fewer words is one shingle, an empty one none."""
    if 0 < len(hashes) < k:
        return grams(hashes, len(hashes))
    return np.unique(grams(hashes, k))


def groups(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(keys)]))
    yield from zip(starts.tolist(), ends.tolist())


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of whole groups of rows that come sorted by the key: memory of a batch and one group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # where the last group begins
        if held and keys[0] != held[0].column(key)[0].as_py() or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


class Union:
    """Disjoint sets of small integers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
