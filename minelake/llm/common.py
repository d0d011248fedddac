"""Shared helpers: table reads, the shared folder, and vectorised word hashing.

Word hashing works on Arrow string buffers directly: all texts of a block are
one ``uint8`` array plus document offsets, so a block of many documents costs
a few numpy passes and no Python string per word.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from minelake.session import ensure_checkpoint_dir

#: bytes of text handled at once by the numpy passes (one longer text is its own block)
BLOCK_BYTES = 1 << 20

U = np.uint64
_BYTE_BASE = U(0x9E3779B97F4A7C15 | 1)
_WORD_BASE = U(0xD6E8FEB86659FD93 | 1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so that workers can
    import it on a cluster where it is not installed."""
    sc = spark.sparkContext
    if any(x.startswith("minelake-") for x in sc._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    # the driver serves this file to the executors for as long as the session lasts
    path = Path(tempfile.mkdtemp(prefix="minelake-"), f"minelake-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(path))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage,
    survives a lost executor and is computed a single time."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a permutation of the 64-bit words)."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inv = base, U(pow(int(base), -1, 1 << 64))
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, b in (("up", self.base), ("down", self.inv)):
                a = np.full(size, b, U)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def byte_table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: words of ``[^\x20\x09-\x0D]+``: UTF-8 bytes other than six ASCII white spaces
SPACE_WORDS = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a block of documents: byte spans, hashes and document bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACE_WORDS, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        n = len(data)
        m = table[data]
        first = m.copy()
        first[1:] &= ~m[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = m[begins]
        self.starts = np.flatnonzero(first)
        last = m
        if n:
            last = m.copy()
            last[:-1] &= ~m[1:] | first[1:]
        self.ends = np.flatnonzero(last) + 1
        #: word index at which each document begins, and the total at the end
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same for the same bytes in any document."""
        if not len(self.starts):
            return np.zeros(0, U)
        up, down = _byte_powers.upto(len(self.data) + 1)
        p = np.zeros(len(self.data) + 1, U)
        np.cumsum((self.data.astype(U) + U(1)) * up[:-1], out=p[1:])
        return mix64((p[self.ends] - p[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U) * _WORD_BASE)


class Rolling:
    """Rabin-Karp hashes of any word span: prefix sums of hash * base**position."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = _word_powers.upto(len(hashes) + 1)
        self.p = np.zeros(len(hashes) + 1, U)
        np.cumsum((hashes | U(1)) * up[:-1], out=self.p[1:])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.p[end] - self.p[begin]) * self.down[begin] + (end - begin).astype(U))

    def windows(self, length: int) -> np.ndarray:
        """Hash of every window of ``length`` words, crossing documents or not."""
        n = len(self.p) - length
        if n <= 0:
            return np.zeros(0, U)
        return mix64((self.p[length:] - self.p[:n]) * self.down[:n] + U(length))


def text_blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of at most
    ``block_bytes`` bytes; a null text counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + block_bytes, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
