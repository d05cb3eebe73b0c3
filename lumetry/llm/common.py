"""What several operators share: reading tables, cutting lineage, hashing inside tasks."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetry.session import shared_folder

U64 = np.uint64


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where it is; a cluster gets it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_working: ContextVar[tuple[list[str], ...]] = ContextVar("working", default=())


def settled(df: DataFrame, name: str = "rows", keep: bool = False, by: str | None = None) -> DataFrame:
    """`df`, written once to the shared folder and read again.

    Cuts the lineage: what follows reads files that outlive any executor, and never computes `df` twice. Inside
    `working_tables` the files go when that ends; those to `keep` stay, or go with the `working_tables` around that.
    by: a column with a folder for each of its values, so that those not asked for are not read.
    """
    return settled_rounds([df], name, keep, by)


def settled_rounds(rounds: Iterable[DataFrame], name: str = "rows", keep: bool = False, by: str | None = None) -> DataFrame:
    """Like `settled`, of tables of one schema that are written one after the other; at least one."""
    path = ""
    for df in rounds:
        if not path:
            path = f"{shared_folder(df.sparkSession)}/{name}"
            if working := _working.get()[: -1 if keep else None]:
                working[-1].append(path)
        (df.write.partitionBy(by) if by else df.write).mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that operators settle inside it when it ends. Write an operator's result before that: Spark reads
    those tables when the result is computed."""
    made: list[str] = []
    token = _working.set((*_working.get(), made))
    try:
        yield
    finally:
        _working.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partitions(df: DataFrame) -> int:
    """The number of partitions that the session shuffles into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def empty(df: DataFrame) -> bool:
    return not df.take(1)


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores before it as it takes to be none of these, whatever their case."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def digest(column: str | F.Column) -> F.Column:
    """128 bits of a value: equal values have equal digests, and no two others are expected to."""
    return F.unhex(F.substring(F.sha2(F.encode(column, "utf-8"), 256), 1, 32))


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers (the public splitmix64 finaliser)."""
    x = np.asarray(x, U64) + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


MULTIPLIER = 0x9E3779B97F4A7C55  # odd, hence invertible modulo 2**64
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of MULTIPLIER and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((MULTIPLIER, pow(MULTIPLIER, -1, 2**64))):
            steps = np.full(max(n, 1 << 20), base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each symbols[start:end], whatever its place: differences of one running polynomial."""
    power, inverse = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, U64)
    values = symbols.astype(U64)
    values += U64(1)
    values *= power[: len(symbols)]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def blocks(texts: list[str], size: int) -> Iterator[slice]:
    """Slices of consecutive texts of about `size` characters; a longer text is a slice of its own."""
    first = total = 0
    for i, text in enumerate(texts):
        if i > first and total + len(text) > size:
            yield slice(first, i)
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def spans(counts: np.ndarray) -> np.ndarray:
    """The edges of consecutive runs of these lengths: 0 and the running sums."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])


def gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one after the other."""
    edges = spans(counts)
    return np.repeat(starts - edges[:-1], counts) + np.arange(edges[-1])


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the texts after lower-casing A-Z.

    Returns their hashes, their first and last + 1 bytes in the joined UTF-8 (each text followed by a line end), and the
    edges of the texts in the list of words.
    """
    joined = "\n".join(texts) + "\n"
    data = np.frombuffer(joined.encode(), np.uint8)
    inside = WORD_BYTE[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        change = np.concatenate([np.zeros(1, np.int64), change])
    starts, ends = change[0::2], change[1::2]
    hashes = span_hashes(LOWER[data], starts, ends)
    if joined.isascii():
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    else:
        sizes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
    edges = np.searchsorted(starts, spans(sizes + 1))
    return hashes, starts, ends, edges
