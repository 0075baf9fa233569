"""Language identification by error-correcting output codes.

Each learned language gets a codeword; each bit of it is predicted by a logistic
classifier on byte n-grams (1 to 4 bytes of the lower-cased text, hashed into
``BINS`` bins). A text goes to the codeword with the least loss, where each bit's
loss is weighted by how well that bit separates that language on the sample. A
text is ambiguous if the second codeword is nearly as close.

Learned from at most about ``per_language`` documents of each language (a
documented bound), whole texts; scoring reads every text once, without shuffle.

Defined cases: null texts and texts without a letter of any script are ``und``
with score 0; so is everything if no language can be learned. With one language
every text with a letter gets it. Null languages are not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import checksum_mod, narrow, ready
from ticketloom.llm.features import letters, sampled
from ticketloom.llm.textbytes import BASE, Texts, lowered, mix64, pieces

BINS = 1 << 13
SIZES = (1, 2, 3, 4)
FOLDS = 3
AMBIGUOUS = 0.1


def bins(t: Texts) -> np.ndarray:
    """The bin of the n-gram that ends at each byte, one row for each size."""
    buf = lowered(t.buf)
    code = np.zeros(len(buf), dtype=np.uint64)
    out = np.empty((len(SIZES), len(buf)), dtype=np.int32)
    for row, size in enumerate(SIZES):
        code[size - 1 :] += buf[: len(buf) - size + 1].astype(np.uint64) << np.uint64(8 * (size - 1))
        key = (code + np.uint64(size)) * np.uint64(BASE)
        out[row] = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 13)).astype(np.int32)
    return out


def shares_of_bins(found: np.ndarray, t: Texts, i: int) -> np.ndarray:
    """Square roots of the shares of the bins in text i, of n-grams that start in it."""
    spans = [found[row, t.bounds[i] + size - 1 : t.bounds[i + 1]] for row, size in enumerate(SIZES)]
    counts = sum(np.bincount(span, minlength=BINS) for span in spans)
    return np.sqrt(counts / max(1, sum(map(len, spans))))


def histograms(t: Texts) -> np.ndarray:
    """``shares_of_bins`` of each text."""
    found = bins(t)
    return np.array([shares_of_bins(found, t, i) for i in range(t.n)], dtype=np.float32).reshape(t.n, BINS)


def codewords(k: int) -> np.ndarray:
    """k rows of +1 and -1: all splits up to 5 languages, beyond a hashed code of
    some 10 log2(k) columns with different rows and no constant column."""
    if k <= 5:
        splits = [[1 if (s >> i) & 1 else -1 for i in range(k)] for s in range(1, 1 << (k - 1))]
        return np.array(splits, dtype=np.float64).T.reshape(k, -1)
    width, salt = int(np.ceil(10 * np.log2(k))), 0
    while True:
        grid = mix64(np.arange(k * width, dtype=np.uint64) + np.uint64(salt * 1_000_003 + 1)).reshape(k, width)
        code = np.where(grid >> np.uint64(63), 1.0, -1.0)
        code = code[:, np.abs(code.sum(axis=0)) < k]
        if len(np.unique(code, axis=0)) == k:
            return code
        salt += 1


@dataclass
class Decoder:
    names: list[str]
    code: np.ndarray
    trust: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def decide(self, t: Texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous, for each text."""
        has = letters(t)
        if not self.names:
            return ["und"] * t.n, np.zeros(t.n), np.zeros(t.n, bool)
        share = 1.0 / np.sqrt(max(len(self.names), 1))
        chance = shares(self.losses(histogram_margins(t, self.weight, self.bias)))
        order = np.argsort(-chance, axis=1, kind="stable")
        best = chance[np.arange(t.n), order[:, 0]]
        second = chance[np.arange(t.n), order[:, 1]] if len(self.names) > 1 else np.zeros(t.n)
        names = [self.names[j] if ok else "und" for j, ok in zip(order[:, 0], has, strict=True)]
        close = has & (best - second < AMBIGUOUS * share * 2)
        return names, np.where(has, best, 0.0), close

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Logistic loss of every bit against every codeword, weighted by trust."""
        signed = margins[:, None, :] * self.code[None, :, :]
        return (np.logaddexp(0, -signed) * self.trust[None, :, :]).sum(axis=2)


def shares(loss: np.ndarray) -> np.ndarray:
    """Losses to shares of one: a codeword that loses 1 more is e**4 times less likely."""
    odds = np.exp(-4.0 * (loss - loss.min(axis=1, keepdims=True)))
    return odds / odds.sum(axis=1, keepdims=True)


def histogram_margins(t: Texts, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Margins of all bits, worked out text by text: they don't depend on the texts beside it."""
    found, weight = bins(t), weight.astype(np.float64)
    out = np.empty((t.n, len(bias)))
    for i in range(t.n):
        x = shares_of_bins(found, t, i)
        on = np.flatnonzero(x)
        out[i] = x[on] @ weight[on] + bias
    return out


def fit(names: np.ndarray, x: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-5) -> Decoder:
    """All bit classifiers at once, by Adam over the whole sample."""
    learned = sorted(set(names.tolist()))
    if len(learned) < 2:
        return Decoder(learned, np.ones((len(learned), 1)), np.ones((len(learned), 1)), np.zeros((BINS, 1), np.float32), np.zeros(1, np.float32))
    label = np.searchsorted(learned, names)
    code = codewords(len(learned))
    target = code[label]
    per_class = np.bincount(label, minlength=len(learned))
    importance = (1.0 / per_class[label] / len(learned))[:, None].astype(np.float32)
    weight, bias = np.zeros((BINS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, rounds + 1):
        margin = x @ weight + bias
        error = (-target / (1 + np.exp(np.clip(target * margin, -30, 30)))).astype(np.float32) * importance
        grad = x.T @ error + decay * weight
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
        bias -= rate * error.sum(axis=0)
    right = (x @ weight + bias) * target > 0
    trust = np.stack([right[label == c].mean(axis=0) for c in range(len(learned))]) + 1e-3
    return Decoder(learned, code, trust / trust.sum(axis=1, keepdims=True), weight, bias)


def train(docs: DataFrame, per_language: int = 400, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Decoder:
    """Learns only rows whose id's crc32 mod 3 is not 1. ``per_language`` bounds the sample."""
    ready(docs.sparkSession)
    rows = narrow(docs, id=id_col, text=text, label=lang).where("label IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(checksum_mod("id", FOLDS) != 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in pieces(batches):
            has = letters(t)
            packed = [x.astype(np.float16).tobytes() for x in histograms(t)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, type=pa.binary())], names=["id", "label", "packed"])
            yield out.filter(pa.array(has))

    table = sampled(rows, "label", per_language).select("id", "label", "text").mapInArrow(task, "id bigint, label string, packed binary").toArrow()
    table = table.sort_by([("id", "ascending"), ("packed", "ascending")])
    x = np.frombuffer(b"".join(table.column("packed").to_pylist()), dtype=np.float16).reshape(-1, BINS)
    return fit(np.array(table.column("label").to_pylist(), dtype=object), x.astype(np.float32))


def predict(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 400) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, lang_pred, score, ambiguous."""
    model = train(docs, per_language, id_col, text, lang)
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.code, model.trust, model.weight, model.bias))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*sent.value)
        for batch, t in pieces(batches, limit=1 << 19):
            names, best, close = decoder.decide(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(best), pa.array(close)],
                                             names=["id", "lang_pred", "score", "ambiguous"])

    out = narrow(docs, id=id_col, text=text).mapInArrow(task, "id bigint, lang_pred string, score double, ambiguous boolean")
    return out.select(F.col("id").alias(id_col), (checksum_mod("id", FOLDS) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")
