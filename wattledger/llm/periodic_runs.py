"""Periodic runs of words, caught by power-of-two blocks.

A catcher holds one completed block of B words, B a power of two, and watches the words appended
after it: whenever the last B words equal its block, at a distance p between B and 2B-1, a square of
period p may be there. The block and its echo are then compared backwards and forwards word by word,
which gives the longest stretch of period p around them. A stretch of three periods holds a whole
aligned block in its first two, so no run escapes, and a block is watched for 2B words only, so all
catchers of a size look at n words together. Those of one size advance in step: their blocks and
suffixes are numbers, doubled in length from size to size. The smallest size watches all distances
up to 15, since runs have 24 words at least.

Squares met again inside a stretch already found are part of it, and squares inside a run whose
period divides theirs are repetitions of that run.
"""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import boxed, text_batches, unboxed

# Fixed values of the contract.
LEAST_LENGTH = 24
LEAST_PERIODS = 3

FIRST_BLOCK = 8
#: Comparisons of catchers that are held at once.
CELLS = 1 << 20
DOUBLE = np.uint64(0x9E3779B97F4A7C15)

DIGEST = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
    + [T.StructField(c, T.StringType(), False) for c in ("runs_sha256", "collapsed_sha256")]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def with_echo(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of a text after the contract's rewriting; a null id counts as an empty string."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading words of two equally long stretches agree, compared in growing steps."""
    at, step = 0, 64
    while at < len(left):
        differ = np.flatnonzero(left[at : at + step] != right[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return len(left)


def _stretch(ids: np.ndarray, at: int, p: int) -> tuple[int, int]:
    """First word and end of the longest stretch of period p that holds the words at and at + p."""
    ahead = _agree(ids[at : len(ids) - p], ids[at + p :])
    back = _agree(ids[:at][::-1], ids[p : at + p][::-1])
    return at - back, at + ahead + p


def _caught(marks: np.ndarray, block: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Distance and start of the blocks met again at distances low to high, by distance and start."""
    starts = np.arange(0, len(marks), block)
    at, found = max(1, CELLS // (high - low + 1)), []
    away = np.arange(low, high + 1)
    for part in (starts[i : i + at] for i in range(0, len(starts), at)):
        ends = part[:, None] + away
        same = marks[np.minimum(ends, len(marks) - 1)] == marks[part][:, None]
        i, j = np.nonzero(same & (ends < len(marks)))
        found.append((away[j], part[i]))
    p, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((s, p))
    return p[order], s[order]


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers, by start, then period."""
    n, runs = len(ids), []
    if n < LEAST_LENGTH:
        return runs
    longest = n // LEAST_PERIODS
    # The furthest-reaching run known at each word.
    reach, period = np.zeros(n, np.int64), np.ones(n, np.int64)
    marks, block = ids.astype(np.uint64), 1
    low = 1
    while low <= longest:
        while block < FIRST_BLOCK or 2 * block <= low:
            mixed = (marks ^ (marks >> np.uint64(29))) * DOUBLE
            marks, block = mixed[: n - 2 * block + 1] + (marks[block:] ^ (marks[block:] >> np.uint64(31))), 2 * block
        p_all, s_all = _caught(marks, block, low, min(2 * block - 1, longest))
        edges = np.flatnonzero(np.diff(p_all, prepend=-1, append=-1)) if len(p_all) else []
        for i, j in zip(edges[:-1], edges[1:]):
            p, starts = int(p_all[i]), s_all[i:j]
            starts = starts[(reach[starts] < starts + p) | (p % period[starts] != 0)]
            done = -1
            for s in starts:
                if s + p + block <= done:
                    continue
                first, end = _stretch(ids, int(s), p)
                done = end
                if end - first < 2 * p or (reach[first] >= end and p % period[first] == 0):
                    continue
                here = slice(first, end)
                further = reach[here] < end
                reach[here][further], period[here][further] = end, p
                if end - first >= max(LEAST_LENGTH, LEAST_PERIODS * p):
                    runs.append((first, end - first, p))
        low = 2 * block
    return sorted((r for r in runs if _smallest(ids, *r)), key=lambda r: (r[0], r[2]))


def _smallest(ids: np.ndarray, first: int, length: int, p: int) -> bool:
    """Whether no smaller period fits; one that does divides p."""
    cycle = ids[first : first + 2 * p]
    return not any(p % d == 0 and np.array_equal(cycle[:p], cycle[d : p + d]) for d in _divisors(p))


def _divisors(p: int) -> list[int]:
    small = [d for d in range(1, int(p**0.5) + 1) if p % d == 0]
    return sorted({d for s in small for d in (s, p // s)} - {p})


def _numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays when every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for first, length, p in runs:
        change[first + p] += 1
        change[first + length] -= 1
    return np.cumsum(change[:n]) == 0


def digest(words: list[bytes]) -> tuple:
    runs = find_runs(_numbers(words))
    best = (None, None, None)
    for r in runs:
        # Compared as exact fractions; equal ones keep the earlier.
        if best[0] is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = [w for w, stays in zip(words, kept_words(len(words), runs)) if stays] if runs else words
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest())


@F.pandas_udf(DIGEST)
def _digests(doc_id: pd.Series, text: pd.Series) -> pd.DataFrame:
    rows = [digest(with_echo(words_of(t), None if pd.isna(i) else int(i))) for i, t in zip(doc_id, text)]
    out = pd.DataFrame(rows, columns=DIGEST.fieldNames())
    return out.astype({c: "Int64" for c in ("n_runs", "start", "length", "period", "exponent_milli")})


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


@F.pandas_udf(RUNS)
def periodic_runs(text: pd.Series) -> pd.Series:
    """Runs of each text as an array of (start, length, period) in words; null text has none."""
    return pd.Series(
        [[dict(zip(("start", "length", "period"), r)) for r in find_runs(_numbers(words_of(t)))] for t in text],
        dtype=object,
    )


@F.pandas_udf(T.StringType())
def _collapsed(text: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        words = words_of(t)
        runs = find_runs(_numbers(words))
        if not runs:
            return t
        stays = kept_words(len(words), runs)
        return b" ".join(w for w, s in zip(words, stays) if s).decode("utf-8", "surrogatepass")

    return pd.Series([one(t) for t in text], dtype=object)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs`, every run of `text` cut to its first period.

    Texts with runs come back as their words with single spaces; others, null and empty ones stay
    as they are. Repeated rows stay; an empty table gives an empty table.
    """
    text_batches(docs.sparkSession)
    return unboxed(boxed(docs), docs, _collapsed("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """Run counts and digests per row of `docs` (doc_id, text), other columns left out.

    Null and empty texts have no words and no runs. Null ids count as an empty string in the
    rewriting; repeated rows stay; an empty table gives an empty result.
    """
    text_batches(docs.sparkSession)
    found = docs.select("doc_id", _digests("doc_id", "text").alias("found"))
    return found.select("doc_id", *(F.col("found")[c].alias(c) for c in DIGEST.fieldNames()))
