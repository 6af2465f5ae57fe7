"""Removal of repeated byte strings with a suffix order built column by column.

A byte is removed if it lies in a string of LENGTH bytes that also starts in a document of smaller
id. Two equal strings of LENGTH bytes hold the same k-mers, so the smallest k-mer hash of a string
says where it may meet its equals. Neighbouring strings with the same smallest hash form a piece:

1. Each task lists the hashes of its pieces; per hash range, those of more than one document are
   marked. Five bytes per piece are shuffled, no text.
2. Marked pieces go to the block of their hash, each distinct one once per task, with the places
   where it occurs.
3. A block holds a collection of strings. Its Burrows-Wheeler transform is built from the last
   column of the strings to the first: a round inserts one symbol of each string, which gives the
   place of its next longer suffix, and updates the common prefixes of neighbours
   (`ColumnwiseIndex`). The columns are kept in sequence and rewritten once a round. Runs of
   suffixes with a common prefix of LENGTH are the equal strings; their smallest document is known
   to all of them.
4. Removed spans return to the batch of their document and are united there.

Batches, blocks and collections are bounded by bytes, and a text that repeats in a million documents
is indexed once. Shuffles carry packed arrays rather than a row per position: one per batch and block.
So a batch takes texts of many Arrow batches, and a large table has fewer and larger blocks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import staged, text_batches
from wattledger.llm.packing import pack, unpack

#: Length of a repeated string (fixed by the contract), and of the k-mers that place it.
LENGTH = 50
KMER = 20
#: Most strings that start in one piece; a longer run of the same smallest hash is cut.
PIECE_STARTS = LENGTH - KMER + 2
#: Strings whose hashes are worked on at once.
STRETCH = 1 << 16
#: Lengths of pieces that share a collection, and the bytes after which the next one begins.
COLLECTION_STEP = 5
COLLECTION_BYTES = 1 << 20
#: Text bytes whose pieces are found at once, that a task holds at once, and per block of hashes.
PIECE_BYTES = 2 << 20
BATCH_BYTES = 16 << 20
BLOCK_BYTES = 12 << 20
#: Beyond so many blocks they grow instead, up to GROWN times their bytes.
FAN_OUT = 512
GROWN = 4
#: Occurrences of pieces whose strings are looked up at once.
OCCURRENCES = 1 << 16
#: Stands for a null id: larger than any other.
NO_ID = (1 << 63) - 1

HASH_BYTES = 5
MULTIPLIER = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)


def kmer_hashes(data: np.ndarray, k: int = KMER) -> np.ndarray:
    """A mixed 64-bit polynomial hash of every k bytes, by doubling."""
    parts, width = {1: data.astype(np.uint64) + np.uint64(1)}, 1
    power = {1: MULTIPLIER}
    while 2 * width <= k:
        x = parts[width]
        parts[2 * width] = x[:-width] * np.uint64(power[width]) + x[width:]
        power[2 * width] = power[width] * power[width] % (1 << 64)
        width *= 2
    out, done = parts[width], width
    while done < k:
        more = 1 << ((k - done).bit_length() - 1)
        tail = parts[more][done:]
        out = out[: len(tail)] * np.uint64(power[more]) + tail
        done += more
    out = (out ^ (out >> np.uint64(29))) * MIX
    return out ^ (out >> np.uint64(32))


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def least_hashes(data: np.ndarray) -> np.ndarray:
    """Smallest k-mer hash of every string of LENGTH bytes, in stretches that fit a processor's cache."""
    out = np.empty(max(0, len(data) - LENGTH + 1), np.uint64)
    for s in range(0, len(out), STRETCH):
        part = data[s : s + STRETCH + LENGTH - 1]
        out[s : s + STRETCH] = window_minima(kmer_hashes(part), LENGTH - KMER + 1)
    return out


def pieces(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """hash, document number, first start and number of starts of every piece of the joined texts.

    Every text has LENGTH bytes at least.
    """
    least = least_hashes(data)
    begins = np.cumsum(lengths) - lengths
    ends = begins + lengths - LENGTH + 1
    edge = np.zeros(len(least) + 1, np.int8)
    edge[begins] += 1
    np.subtract.at(edge, ends, 1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    breaks = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=breaks[1:])
    breaks[begins] = True
    start = np.flatnonzero(breaks & inside)
    doc = np.searchsorted(begins, start, side="right") - 1
    n = np.minimum(np.append(start[1:], len(least)), ends[doc]) - start
    parts = -(-n // PIECE_STARTS)
    again = np.repeat(np.arange(len(start)), parts)
    part = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
    start, n = start[again] + part * PIECE_STARTS, n[again] - part * PIECE_STARTS
    return least[start], doc[again], start, np.minimum(n, PIECE_STARTS)


def batch_pieces(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """`pieces` of a batch, some texts at a time."""
    ends = np.cumsum(lengths)
    parts = np.flatnonzero(np.diff(ends // PIECE_BYTES, prepend=-1))
    found = []
    for a, b in itertools.pairwise([*parts.tolist(), len(lengths)]):
        begin = ends[a] - lengths[a]
        value, doc, start, n = pieces(data[begin : ends[b - 1]], lengths[a:b])
        found.append((value, doc + a, start + begin, n))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


class ColumnwiseIndex:
    """Suffix order of a collection of byte strings, built by rounds from their ends.

    After round t every suffix of up to t symbols is in order. `symbol` is the transform: the
    symbol before each suffix (0 at the start of a string, else byte + 1). `common` is the common
    prefix of a suffix with the one before it, `owner` and `length` name the suffix. Equal
    suffixes are in the order of their strings. Strings have at most 255 symbols.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self._lengths, self._ends = lengths, np.cumsum(lengths)
        # UTF-8 has no byte 255, so that symbols fit into one byte.
        kind = np.uint8 if data.max(initial=0) < 255 else np.uint16
        self._data = np.append(data.astype(kind) + kind(1), kind(0))
        m = len(lengths)
        self.symbol = self._before(np.arange(m), 0)
        self.common = np.zeros(m, np.uint8)
        # Owner and length of a suffix in one number: they move together.
        self._name = np.arange(m, dtype=np.int32 if m < 1 << 23 else np.int64) << 8
        self._newest = np.arange(m)
        for t in range(1, int(lengths.max(initial=0)) + 1):
            self._insert(t)
        self.owner, self.length = self._name.astype(np.int64) >> 8, self._name.astype(np.int64) & 255

    def _before(self, strings: np.ndarray, t: int) -> np.ndarray:
        """The symbol before the suffix of t symbols."""
        inside = self._lengths[strings] > t
        return self._data[np.where(inside, self._ends[strings] - t - 1, -1)]

    def _insert(self, t: int) -> None:
        # Sorting the transform stably maps each suffix to the one that its symbol extends it to.
        order = np.argsort(self.symbol, kind="stable")
        n, ended = len(order), len(self.symbol) - int(np.count_nonzero(self.symbol))
        going = np.zeros(n, bool)
        going[self._newest] = self.symbol[self._newest] != 0
        near = np.flatnonzero(going[order])
        at = order[near]
        strings = self._name[at] >> 8
        new = near - ended + len(self._lengths)
        c = self.symbol[at]
        before = order[near - 1]
        next_rank = np.minimum(near + 1, n - 1)
        after = order[next_rank]
        has_before = (near > 0) & (self.symbol[before] == c)
        has_after = (next_rank > near) & (self.symbol[after] == c)
        shared = RangeMinima(self.common)
        front = np.zeros(len(at), np.uint8)
        front[has_before] = shared.between(before[has_before] + 1, at[has_before]) + np.uint8(1)
        behind = shared.between(at[has_after] + 1, after[has_after]) + np.uint8(1)
        kept = np.ones(n + len(at), bool)
        kept[new] = False
        self.symbol = self._merged(kept, new, self.symbol, self._before(strings, t))
        self._name = self._merged(kept, new, self._name, strings << 8 | t)
        self.common = self._merged(kept, new, self.common, front)
        self.common[new[has_after] + 1] = behind
        self._newest = new

    @staticmethod
    def _merged(kept: np.ndarray, new: np.ndarray, old: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(kept), old.dtype)
        out[kept] = old
        out[new] = values
        return out


class RangeMinima:
    """Minima of ranges: two windows of a power of two, beyond the widest also of whole groups between."""

    LEVELS = 7
    GROUP = 1 << (LEVELS - 1)

    def __init__(self, x: np.ndarray):
        self._n, self._groups = len(x), len(x) // self.GROUP
        self._near = self._doubled(x, self.LEVELS)
        widest = self._near[-self._n :][: self._groups * self.GROUP : self.GROUP]
        self._far = self._doubled(widest, 64)

    @staticmethod
    def _doubled(x: np.ndarray, levels: int) -> np.ndarray:
        """Minima of 1, 2, 4 ... numbers from every place on, one table after the other."""
        n, width = len(x), 1
        tables = np.empty((max(1, min(levels, n.bit_length())), n), x.dtype)
        tables[0] = x
        for last, table in itertools.pairwise(tables):
            np.minimum(last[: n - 2 * width + 1], last[width : n - width + 1], out=table[: n - 2 * width + 1])
            width *= 2
        return tables.ravel()

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first..last, both included; no range is empty."""
        end = last + 1
        level = np.minimum(_log2(end - first), self.LEVELS - 1)
        row = level * self._n
        out = np.minimum(self._near[row + first], self._near[row + end - (1 << level)])
        wide = np.flatnonzero(end - first > 2 * self.GROUP)
        low, high = -(-first[wide] // self.GROUP), end[wide] // self.GROUP
        level = _log2(high - low)
        row = level * self._groups
        out[wide] = np.minimum(out[wide], np.minimum(self._far[row + low], self._far[row + high - (1 << level)]))
        return out


def _log2(x: np.ndarray) -> np.ndarray:
    """Rounded down; x is positive."""
    return np.frexp(x)[1].astype(np.int64) - 1


def smallest_holder(data: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Per string and start with LENGTH bytes left: the smallest `least` of any string that holds them."""
    index = ColumnwiseIndex(data, lengths)
    long = index.length >= LENGTH
    owner, size, common = index.owner[long], index.length[long], index.common[long]
    first = np.ones(len(owner), bool)
    # Between two suffixes with a common prefix of LENGTH lies no shorter one.
    first[1:] = common[1:] < LENGTH
    at = np.flatnonzero(first)
    out = np.empty(len(owner), np.int64)
    if len(owner):
        group = np.minimum.reduceat(least[owner], at)
        starts = lengths - LENGTH + 1
        base = np.cumsum(starts) - starts
        out[base[owner] + lengths[owner] - size] = np.repeat(group, np.diff(np.append(at, len(owner))))
    return out


def by_collection(data: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """`smallest_holder` of pieces, in one collection per length that their hashes reach.

    Pieces of different hashes share no string of LENGTH bytes. Hashes whose longest pieces are
    about as long go together, so that no collection takes rounds for strings it doesn't have.
    """
    begins = np.cumsum(lengths) - lengths
    starts = lengths - LENGTH + 1
    base = np.cumsum(starts) - starts
    _, group = np.unique(batch_pieces(data, lengths)[0], return_inverse=True)
    longest = np.zeros(group.max(initial=0) + 1, np.int64)
    np.maximum.at(longest, group, lengths)
    kind = longest // COLLECTION_STEP
    order = np.lexsort((group, kind[group]))
    edges = np.flatnonzero(np.diff(group[order], prepend=-1))
    filled = np.concatenate(([0], np.cumsum(lengths[order])))[edges] // COLLECTION_BYTES
    kinds = kind[group[order[edges]]]
    cuts = edges[(np.diff(filled, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0)]
    out = np.empty(int(starts.sum()), np.int64)
    for a, b in itertools.pairwise([*cuts.tolist(), len(order)]):
        own = np.sort(order[a:b])
        out[_ranges(base[own], starts[own])] = smallest_holder(
            data[_ranges(begins[own], lengths[own])], lengths[own], least[own]
        )
    return out


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame, np.ndarray, np.ndarray]]:
    """Number, rows, joined bytes and lengths of batches; numbers are unique within a stage."""
    task = TaskContext.get().partitionId()
    for number, rows in enumerate(_by_bytes(frames)):
        data = np.frombuffer(b"".join(rows["text"]), np.uint8)
        yield (task << 32) | number, rows, data, rows["text"].map(len).to_numpy()


def _by_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in frames of BATCH_BYTES of text."""
    held, size = [], 0
    for frame in frames:
        sizes = frame["text"].map(len).to_numpy()
        cuts = (size + np.cumsum(sizes)) // BATCH_BYTES
        for cut, rows in frame.groupby(cuts, sort=False):
            if cut and held:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
            held.append(rows)
            size += int(sizes[cuts == cut].sum())
    if held:
        yield pd.concat(held, ignore_index=True)


def _hash_lists(blocks: int) -> Callable:
    """Hashes of all pieces, by block; and the documents of the batch with its first block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, rows, data, lengths in _batches(frames):
            value, doc, _, _ = batch_pieces(data, lengths)
            block = (value % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(blocks + 1))
            out = []
            for b in range(blocks):
                own = order[edges[b] : edges[b + 1]]
                if not len(own):
                    continue
                short = np.ascontiguousarray(value[own] // np.uint64(blocks)).view(np.uint8).reshape(-1, 8)
                counts = np.bincount(doc[own], minlength=len(lengths)).astype(np.uint32)
                out.append((b, batch, pack(counts), short[:, :HASH_BYTES].tobytes(), None, None))
            if out:
                ids, marks = pack(rows["id"].to_numpy(np.int64)), pack(rows["mark"].to_numpy(np.int64))
                out[batch % len(out)] = (*out[batch % len(out)][:4], ids, marks)
            yield pd.DataFrame(out, columns=["block", "batch", "counts", "hashes", "ids", "marks"])

    return run


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Per batch: a bit for each of its hashes that another document has, too."""
    short = [np.frombuffer(x, np.uint8).reshape(-1, HASH_BYTES) for x in frame["hashes"]]
    counts = [unpack(x, np.uint32) for x in frame["counts"]]
    value = np.zeros((sum(map(len, short)), 8), np.uint8)
    value[:, :HASH_BYTES] = np.concatenate(short)
    value = value.view(np.uint64).ravel()
    doc = np.repeat(np.arange(sum(map(len, counts))), np.concatenate(counts))
    order = np.argsort(value, kind="stable")
    v, d = value[order], doc[order]
    at = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    size = np.diff(np.append(at, len(v)))
    several = d[at] != d[at + size - 1]
    marked = np.empty(len(value), bool)
    marked[order] = np.repeat(several, size)
    edges = np.cumsum([len(x) for x in short])[:-1]
    return pd.DataFrame(
        {
            "batch": frame["batch"],
            "block": frame["block"],
            "counts": frame["counts"],
            "bits": [np.packbits(x).tobytes() for x in np.split(marked, edges)],
            "ids": frame["ids"],
            "marks": frame["marks"],
        }
    )


def _flags(frame: pd.DataFrame) -> pd.DataFrame:
    """Per document with a shared hash: its bits, ordered by block and then by place."""
    frame = frame.sort_values("block")
    known = frame["ids"].notna()
    ids, marks = unpack(frame["ids"][known].iloc[0], np.int64), unpack(frame["marks"][known].iloc[0], np.int64)
    docs, bits = [], []
    for counts, packed in zip(frame["counts"], frame["bits"], strict=True):
        n = unpack(counts, np.uint32)
        docs.append(np.repeat(np.arange(len(n)), n))
        bits.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=int(n.sum())))
    doc, bit = np.concatenate(docs), np.concatenate(bits)
    order = np.argsort(doc, kind="stable")
    edges = np.searchsorted(doc[order], np.arange(len(ids) + 1))
    bit = bit[order]
    out = [
        (ids[i], marks[i], np.packbits(own).tobytes())
        for i in range(len(ids))
        if (own := bit[edges[i] : edges[i + 1]]).any()
    ]
    return pd.DataFrame(out, columns=["id", "mark", "flags"])


def _marked_pieces(blocks: int) -> Callable:
    """Marked pieces by block: each distinct one of the batch once, and where it occurs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, rows, data, lengths in _batches(frames):
            value, doc, start, n = batch_pieces(data, lengths)
            block = (value % np.uint64(blocks)).astype(np.int64)
            edges = np.searchsorted(doc, np.arange(len(lengths) + 1))
            flag = np.zeros(len(value), bool)
            for i, bits in enumerate(rows["flags"]):
                own = np.argsort(block[edges[i] : edges[i + 1]], kind="stable") + edges[i]
                flag[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
            kept = np.flatnonzero(flag)
            kept = kept[np.argsort(block[kept], kind="stable")]
            cuts = np.searchsorted(block[kept], np.arange(blocks + 1))
            text, begins = data.tobytes(), np.cumsum(lengths) - lengths
            ids, marks = rows["id"].to_numpy(np.int64), rows["mark"].to_numpy(np.int64)
            out = []
            for b in range(blocks):
                own = kept[cuts[b] : cuts[b + 1]]
                if not len(own):
                    continue
                distinct: dict[bytes, int] = {}
                number = [
                    distinct.setdefault(text[s:e], len(distinct))
                    for s, e in zip(start[own].tolist(), (start[own] + n[own] + LENGTH - 1).tolist(), strict=True)
                ]
                docs, local = np.unique(doc[own], return_inverse=True)
                out.append(
                    (
                        b,
                        batch,
                        pack(np.array([len(x) for x in distinct], np.uint8)),
                        pack(np.frombuffer(b"".join(distinct), np.uint8)),
                        pack(np.array(number, np.uint32)),
                        pack(local.astype(np.uint32)),
                        pack((start[own] - begins[doc[own]]).astype(np.int64)),
                        pack(np.diff(ids[docs], prepend=0)),
                        pack(marks[docs]),
                    )
                )
            yield pd.DataFrame(
                out, columns=["block", "batch", "sizes", "data", "piece", "doc", "start", "ids", "marks"]
            )

    return run


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    """Per batch: spans of its documents that start in a smaller document, too."""
    distinct: dict[bytes, int] = {}
    holder: list[np.ndarray] = []
    read = []
    for r in frame.itertuples(index=False):
        text = unpack(r.data, np.uint8).tobytes()
        ends = np.cumsum(unpack(r.sizes, np.uint8).astype(np.int64)).tolist()
        number = np.array(
            [distinct.setdefault(text[s:e], len(distinct)) for s, e in zip([0, *ends], ends, strict=False)], np.int64
        )
        ids = np.cumsum(unpack(r.ids, np.int64))
        piece, doc = number[unpack(r.piece, np.uint32)], unpack(r.doc, np.uint32).astype(np.int64)
        holder.append(np.stack((piece, ids[doc])))
        read.append((r.batch, piece, doc, unpack(r.start, np.int64), ids, r.marks))
    least = np.full(len(distinct), NO_ID, np.int64)
    for piece, ids in holder:
        np.minimum.at(least, piece, ids)
    lengths = np.array([len(x) for x in distinct], np.int64)
    smallest = by_collection(np.frombuffer(b"".join(distinct), np.uint8), lengths, least)
    del distinct, holder
    starts = lengths - LENGTH + 1
    base = np.cumsum(starts) - starts
    out = []
    for batch, piece, doc, start, ids, marks in read:
        found = []
        for a in range(0, len(piece), OCCURRENCES):
            own = slice(a, a + OCCURRENCES)
            of, step, size = _gone(piece[own], ids[doc[own]], smallest, base, starts)
            found.append((doc[own][of].astype(np.uint32), start[own][of] + step, size))
        docs, begin, size = map(np.concatenate, zip(*found, strict=True))
        if len(docs):
            out.append((batch, pack(docs), pack(begin), pack(size), pack(ids), marks))
    return pd.DataFrame(out, columns=["batch", "doc", "start", "size", "ids", "marks"])


def _gone(
    piece: np.ndarray, ids: np.ndarray, smallest: np.ndarray, base: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Number of the occurrence, first start in it and bytes of every run of strings of a smaller document."""
    n = starts[piece]
    of = np.repeat(np.arange(len(piece)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    gone = smallest[base[piece][of] + step] < ids[of]
    edge = np.ones(len(of), bool)
    edge[1:] = of[1:] != of[:-1]
    first = gone.copy()
    first[1:] &= edge[1:] | ~gone[:-1]
    last = gone.copy()
    last[:-1] &= edge[1:] | ~gone[1:]
    f, e = np.flatnonzero(first), np.flatnonzero(last)
    return of[f], step[f], e - f + LENGTH


def _united(frame: pd.DataFrame) -> pd.DataFrame:
    """Per document: the union of its spans."""
    ids, marks, begin, end = [], [], [], []
    for r in frame.itertuples(index=False):
        doc, s = unpack(r.doc, np.uint32), unpack(r.start, np.int64)
        ids.append(unpack(r.ids, np.int64)[doc])
        marks.append(unpack(r.marks, np.int64)[doc])
        begin.append(s)
        end.append(s + unpack(r.size, np.int64))
    i, m, b, e = map(np.concatenate, (ids, marks, begin, end))
    order = np.lexsort((b, m, i))
    i, m, b, e = i[order], m[order], b[order], e[order]
    out = []
    edges = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (m[1:] != m[:-1]))))
    for s, t in zip(edges, np.append(edges[1:], len(i)), strict=True):
        reach = np.maximum.accumulate(e[s:t])
        fresh = np.flatnonzero(np.concatenate(([True], b[s + 1 : t] > reach[:-1])))
        stop = reach[np.append(fresh[1:] - 1, t - s - 1)]
        out.append((i[s], m[s], b[s:t][fresh].tolist(), stop.tolist()))
    return pd.DataFrame(out, columns=["id", "mark", "starts", "stops"])


@F.pandas_udf(T.BinaryType())
def _cut(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
    out = []
    for t, a, b in zip(text, starts, stops, strict=True):
        if t is None:
            out.append(None)
            continue
        parts, at = [], 0
        for s, e in zip(a, b, strict=True):
            parts.append(t[at:s])
            at = e
        out.append(b"".join((*parts, t[at:])))
    return pd.Series(out, dtype=object)


def block_count(total: int, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of `block_bytes` of text; of up to GROWN times as much where there would be over FAN_OUT.

    Each batch has a row for each block, so that many small blocks cost more than the pieces in them.
    """
    least = max(1, math.ceil(total / block_bytes))
    return min(least, max(FAN_OUT, math.ceil(least / GROWN)))


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, starts, stops, kept for every row of `docs` (doc_id, text).

    starts and stops bound the removed runs in bytes (null: none), kept is the rest. Null text is
    empty. Rows of equal id never remove each other's bytes; a null id is larger than all others.
    An empty table gives an empty result.
    """
    text_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.hash(text).cast("long").alias("mark"),
        text.alias("text"),
        F.col("doc_id").isNull().alias("nameless"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = block_count(total, block_bytes)
    long_rows = rows.where(F.octet_length("text") >= LENGTH).select("id", "mark", "text")
    lists = long_rows.mapInPandas(
        _hash_lists(blocks), "block int, batch long, counts binary, hashes binary, ids binary, marks binary"
    )
    shared = lists.groupBy("block").applyInPandas(
        _shared, "batch long, block int, counts binary, bits binary, ids binary, marks binary"
    )
    flags = staged(
        shared.groupBy("batch").applyInPandas(_flags, "id long, mark long, flags binary").distinct(), "shared-hashes"
    )
    marked = long_rows.join(flags, ["id", "mark"]).mapInPandas(
        _marked_pieces(blocks),
        "block int, batch long, sizes binary, data binary, piece binary, doc binary, start binary, ids binary, marks binary",
    )
    repeated = marked.groupBy("block").applyInPandas(
        _repeated, "batch long, doc binary, start binary, size binary, ids binary, marks binary"
    )
    spans = staged(
        repeated.groupBy("batch")
        .applyInPandas(_united, "id long, mark long, starts array<long>, stops array<long>")
        .distinct(),
        "repeated-spans",
    )
    joined = rows.join(spans, ["id", "mark"], "left")
    has = F.col("starts").isNotNull()
    return joined.select(
        F.when(~F.col("nameless"), F.col("id")).alias("doc_id"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        "starts",
        "stops",
        F.coalesce(_cut(F.when(has, F.col("text")), "starts", "stops"), "text").alias("kept"),
    )


def repeat_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of `docs`."""
    n_kept = F.octet_length("kept")
    return remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - n_kept).cast("long").alias("n_removed"),
        F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
