"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its features are counts over its bytes, those of the lines before and
after it, and its place at an end of the document; a 2 x 2 table scores neighbouring labels. The
forward-backward algorithm gives each line's probability of being good, and their mean, weighted by
line length, is the document's. Two calibration parameters turn it into the score.

Training takes the label of the document for each of its lines. The sample is bounded by
FIT_DOCUMENTS documents, the first by hash of their id, and by FIT_LINES neighbouring lines from
the middle of each. Scoring takes whole texts. Labels, language, source and id are no features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import crc_fold, text_batches

FIT_DOCUMENTS = 3000
FIT_LINES = 120
STEPS = 150
PENALTY = 1e-3
#: Documents with this score at least are predicted to be good (fixed by the contract).
ACCEPT = 0.7
HELD_OUT = (4, 2)

#: Bytes of text, and documents, that are worked on at once.
BATCH_BYTES = 4 << 20
BATCH_DOCUMENTS = 128
#: Padded lines of the texts whose marginals are computed at once, some 60 bytes each.
BATCH_CELLS = 1 << 20

# Classes of bytes that are counted in each line.
UPPER, LOWER, HIGH, DIGIT, SYMBOL, PIPE, LOUD, STOP, OTHER, SPACE = range(10)
N_OWN = 15


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = SPACE
    table[65:91], table[97:123], table[128:], table[48:58] = UPPER, LOWER, HIGH, DIGIT
    for chars, kind in ((b"#*$%&<>", SYMBOL), (b"|", PIPE), (b"!?", LOUD), (b".,;:", STOP)):
        table[list(chars)] = kind
    return table


CLASSES = _classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line, the lines per text, and the lengths of the lines in bytes."""
    lines = [t.encode("utf-8", "surrogatepass").split(b"\n") for t in texts]
    per_text = np.array([len(x) for x in lines], np.int64)
    flat = [x for of in lines for x in of]
    data = np.frombuffer(b"\n".join(flat) + b"\n", np.uint8)
    kinds = CLASSES[data]
    starts = np.concatenate(([0], np.flatnonzero(data == 10)[:-1] + 1))
    n = {k: np.add.reduceat(kinds == k, starts, dtype=np.int64).astype(np.float64) for k in range(10)}
    size = np.diff(np.concatenate((starts, [len(data)]))).astype(np.float64) - 1
    words, fresh, again = np.empty(len(flat)), np.empty(len(flat)), np.zeros(len(flat))
    at = 0
    for of in lines:
        seen: set[bytes] = set()
        for x in of:
            w = x.split()
            words[at], fresh[at] = len(w), len(set(w))
            if w:
                again[at] = x in seen
                seen.add(x)
            at += 1
    w, b = np.maximum(words, 1), np.maximum(size, 1)
    letters = n[UPPER] + n[LOWER] + n[HIGH]
    own = np.stack(
        [
            np.log1p(size) / 6,
            n[UPPER] / np.maximum(letters, 1),
            n[DIGIT] / b,
            np.minimum(n[SYMBOL] / w, 3),
            np.minimum(n[LOUD] / w, 3),
            np.minimum(n[PIPE] / w, 3),
            np.minimum(n[OTHER] / w, 3),
            np.minimum(n[STOP] / w, 3),
            letters / b,
            np.minimum(b / w / 10, 3),
            n[HIGH] / b,
            1 - fresh / w,
            again,
            words == 0,
            words < 3,
        ],
        axis=1,
    )
    return own, per_text, size


def with_neighbours(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Bias, own features, those of the line before and after, and marks of the first and last line."""
    first = np.zeros(len(own), bool)
    ends = np.cumsum(per_text)
    first[ends - per_text] = True
    last = np.zeros(len(own), bool)
    last[ends - 1] = True
    before = np.vstack((own[:1], own[:-1]))
    after = np.vstack((own[1:], own[-1:]))
    before[first], after[last] = 0, 0
    return np.column_stack((np.ones(len(own)), own, before, after, first, last))


@dataclass
class Crf:
    """Weights of the good label (bad has none), neighbour scores, calibration."""

    weights: np.ndarray
    links: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def marginals(self, logits: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) per line of a (documents, lines) block, summed P of neighbour labels, log-likelihood scale."""
        good = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        node = np.stack((1 - good, good), axis=2)
        node[~mask] = 1.0
        link = np.exp(self.links)
        docs, length = logits.shape
        ahead = np.empty((length, docs, 2))
        ahead[0] = node[:, 0] / node[:, 0].sum(1, keepdims=True)
        for t in range(1, length):
            step = (ahead[t - 1] @ link) * node[:, t]
            ahead[t] = step / step.sum(1, keepdims=True)
        back = np.ones((docs, 2))
        out = np.empty((docs, length))
        pairs = np.zeros((docs, 2, 2))
        for t in range(length - 1, -1, -1):
            both = ahead[t] * back
            out[:, t] = both[:, 1] / both.sum(1)
            if t:
                came = node[:, t] * back
                pair = ahead[t - 1][:, :, None] * link * came[:, None, :]
                inside = mask[:, t]
                pairs[inside] += pair[inside] / pair[inside].sum((1, 2), keepdims=True)
                new = came @ link.T
                new /= new.sum(1, keepdims=True)
                # Beyond a document's end nothing is known.
                back = np.where(inside[:, None], new, 1.0)
        return out, pairs, good

    def document(self, texts: list[str]) -> np.ndarray:
        """Log-odds of the length-weighted mean of P(good), per text."""
        own, per_text, size = line_features(texts)
        logits = with_neighbours(own, per_text) @ self.weights
        ends = np.cumsum(per_text)
        out = np.empty(len(texts))
        for part in grouped(per_text):
            block, mask = padded([logits[ends[i] - per_text[i] : ends[i]] for i in part])
            good, _, _ = self.marginals(block, mask)
            for row, i in enumerate(part):
                length = size[ends[i] - per_text[i] : ends[i]] + 1
                out[i] = np.average(good[row, : per_text[i]], weights=length)
        out = np.clip(out, 1e-9, 1 - 1e-9)
        return np.log(out / (1 - out))

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-(self.slope * self.document(texts) + self.shift)))


def grouped(per_text: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of the texts in groups of like line counts, bounded in texts and in padded lines.

    A text of more lines than a group may hold is a group of its own.
    """
    order = np.argsort(per_text, kind="stable")
    start = 0
    for at in range(1, len(order) + 1):
        if (
            at == len(order)
            or at - start == BATCH_DOCUMENTS
            or (at - start + 1) * per_text[order[at]] > BATCH_CELLS
        ):
            yield order[start:at]
            start = at


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, rows))
    block, mask = np.zeros((len(rows), length)), np.zeros((len(rows), length), bool)
    for i, x in enumerate(rows):
        block[i, : len(x)], mask[i, : len(x)] = x, True
    return block, mask


def train(lines: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> Crf:
    """Fit by Adam on the mean log-likelihood per line; each document counts alike."""
    width = lines[0].shape[1]
    crf = Crf(np.zeros(width), np.zeros((2, 2)))
    order = np.argsort([len(x) for x in lines], kind="stable")
    blocks = []
    for at in range(0, len(order), 4 * BATCH_DOCUMENTS):
        part = order[at : at + 4 * BATCH_DOCUMENTS]
        _, mask = padded([np.zeros(len(lines[i])) for i in part])
        feats = np.zeros((*mask.shape, width), np.float32)
        feats[mask] = np.vstack([lines[i] for i in part])
        blocks.append((feats, mask, labels[part].astype(float), mask.sum(1)))
    m = v = np.zeros(width + 4)
    for step in range(1, steps + 1):
        grad = np.zeros(width + 4)
        for feats, mask, y, n in blocks:
            good, pairs, _ = crf.marginals(feats @ crf.weights, mask)
            error = np.where(mask, y[:, None] - good, 0) / n[:, None]
            grad[:width] += np.einsum("dt,dtf->f", error, feats)
            true = np.zeros((len(y), 2, 2))
            true[np.arange(len(y)), y.astype(int), y.astype(int)] = n - 1
            grad[width:] += ((true - pairs) / n[:, None, None]).sum(0).ravel()
        grad = grad / len(lines) - PENALTY * np.concatenate((crf.weights, crf.links.ravel()))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        crf.weights = crf.weights + move[:width]
        crf.links = crf.links + move[width:].reshape(2, 2)
    return crf


def calibrate(crf: Crf, x: np.ndarray, y: np.ndarray) -> None:
    """Slope and shift by penalised logistic regression on the documents' log-odds."""
    a = np.array([1.0, 0.0])
    design = np.column_stack((x, np.ones(len(x))))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        a = a + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * (a - [1.0, 0.0])), -1, 1)
    crf.slope, crf.shift = max(float(a[0]), 1e-3), float(a[1])


def _sampled(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        for text, quality in zip(batch["text"], batch["quality"], strict=True):
            own, per_text, size = line_features([text or ""])
            x = with_neighbours(own, per_text).astype(np.float32)
            at = max(0, (len(x) - FIT_LINES) // 2)
            x = x[at : at + FIT_LINES]
            yield pd.DataFrame(
                {
                    "quality": [int(quality)],
                    "lines": [x.tobytes()],
                    "sizes": [size[at : at + FIT_LINES].astype(np.float32).tobytes()],
                }
            )


def fit(docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS) -> Crf:
    """Train on a bounded sample of labelled documents outside the held-out fold.

    Without both labels the model is a constant: the share of good labels, 1 without any.
    """
    text_batches(docs.sparkSession)
    fold, held = HELD_OUT
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (crc_fold(F.col("doc_id"), fold) != held))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(documents)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "quality")
    rows = texts.mapInPandas(_sampled, "quality int, lines binary, sizes binary").limit(documents).collect()
    y = np.array([r["quality"] for r in rows], float)
    if len(set(y)) < 2:
        return Crf(np.zeros(1), np.zeros((2, 2)), constant=float((y.sum() + 1) / (len(y) + 1)))
    width = 3 * N_OWN + 3
    lines = [np.frombuffer(r["lines"], np.float32).reshape(-1, width).astype(np.float64) for r in rows]
    crf = train(lines, y)
    x = np.empty(len(rows))
    for i, (r, f) in enumerate(zip(rows, lines, strict=True)):
        block, mask = padded([f @ crf.weights])
        good, _, _ = crf.marginals(block, mask)
        p = np.clip(np.average(good[0], weights=np.frombuffer(r["sizes"], np.float32) + 1), 1e-9, 1 - 1e-9)
        x[i] = np.log(p / (1 - p))
    calibrate(crf, x, y)
    return crf


def scorer(crf: Crf):
    """A vectorised function from whole text to score; null text is empty."""

    @F.pandas_udf(T.DoubleType())
    def score(text: pd.Series) -> pd.Series:
        out, part, size = [], [], 0
        for t in text:
            part.append(t or "")
            size += len(part[-1])
            if size >= BATCH_BYTES:
                out.append(crf.score(part))
                part, size = [], 0
        if part:
            out.append(crf.score(part))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return score


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs` (doc_id, text).

    Null and empty texts are scored as one empty line. Repeated rows are scored alike. An empty
    table gives an empty result.
    """
    fold, held = HELD_OUT
    scored = docs.select("doc_id", scorer(fit(docs, labels))("text").alias("score"))
    return scored.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), fold) == held).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are predicted to be good, with their own columns."""
    return docs.where(scorer(fit(docs, labels))("text") >= ACCEPT)
