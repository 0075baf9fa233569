"""Toxicity by a factorization machine over hashed terms.

The score of a text is the logistic of a bias, a weight for each distinct term
and, for every pair of its terms, the product of their factor vectors. Pairs are
never listed: with s the sum and q the sum of squares of the factors, all pairs
together give half of (s * s - q). So two terms that are harmless alone can be
toxic together, and the other way round.

Trained on a sample of labelled rows of at most about ``per_label`` rows for
each label (a documented bound), by Adam on the driver over the sample's packed
hashes. Terms in fewer than ``least`` sampled rows carry no weight. Of the others
those do that have ``evidence``, a chi-square with the label: by themselves, or by
the company they keep. For the latter a machine over all terms learns one half of
the sample, and in the other half the pairs that it sees of a term are tested
against what the terms telling by themselves leave unexplained; and the other way
round. So neither do the rare words of a long text collide with a toxic one, nor do
many neutral words add up.
Scoring reads every text once, in the scan, and needs no shuffle.

Defined cases: null and empty texts have no terms and score the bias; a label
other than 0 or 1 or null is not learned; a document with several labels is
toxic if one says so; without any label of both kinds the score is the share of
label 1 learned (0 without labels). Rows that repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from ticketloom.llm.common import BROADCAST_BYTES, checksum_mod, narrow, ready, whole_rows
from ticketloom.llm.features import collected, known, rows_of, sampled, sized, summed, telling, terms, vocabulary
from ticketloom.llm.textbytes import Texts, own_text, pieces
from ticketloom.session import stage

FOLDS = 5
#: Steps of training at least.
STEPS = 300
#: Rows whose factors the driver holds at once.
ROWS = 512


@dataclass
class Machine:
    vocab: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def score(self, t: Texts) -> np.ndarray:
        owner, hashes = terms(t)
        at, on = known(hashes, self.vocab)
        return logistic(self.bias + interactions(self.weight, self.factor, at[on], owner[on], t.n))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def interactions(weight: np.ndarray, factor: np.ndarray, at: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Linear and pairwise part for texts 0 .. n-1; ``owner`` ascends."""
    own = factor[at]
    total = summed(own, owner, n)
    squares = summed((own * own).sum(axis=1), owner, n)
    return summed(weight[at], owner, n) + 0.5 * ((total * total).sum(axis=1) - squares)


def fit(labels: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, rank: int = 6, least: int = 3, evidence: float = 15.0, epochs: int = 8, batch: int = 256,
        rate: float = 0.02, decay: float = 3e-4, seed: int = 5) -> Machine:
    """Adam on the logistic loss; both labels count alike in the loss up to a factor of 3."""
    y = labels.astype(np.float64)
    every = vocabulary(hashes, least)
    vocab = telling(y, bounds, hashes, every, evidence)
    if evidence > 0 and len(vocab) < len(every):
        company = together(y, bounds, hashes, every, vocab, evidence, rank=rank, epochs=epochs, batch=batch, rate=rate, decay=decay, seed=seed)
        vocab = np.union1d(vocab, company)
    return learn(y, bounds, hashes, vocab, rank, epochs, batch, rate, decay, seed)


def together(y: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, vocab: np.ndarray, single: np.ndarray, evidence: float, **how) -> np.ndarray:
    """Terms whose pairs with other terms of a text tell the label in rows not learned
    from, beyond what the terms ``single`` say."""
    order = np.random.default_rng(how["seed"]).permutation(len(y))
    halves = [np.sort(order[::2]), np.sort(order[1::2])]
    found = [np.zeros(0, np.uint64)]
    for one, other in (halves, halves[::-1]):
        if len(set(y[one])) < 2 or len(set(y[other])) < 2:
            continue
        b, h = rows_of(bounds, hashes, one)
        whole = learn(y[one], b, h, vocab, **how)
        alone = learn(y[one], b, h, single, **how)
        b, h = rows_of(bounds, hashes, other)
        rest = y[other] - scores(alone, b, h)
        rest -= rest.mean()
        at, on = known(h, vocab)
        owner = np.repeat(np.arange(len(other), dtype=np.int32), np.diff(b))[on]
        at = at[on]
        # the factors of some rows at a time: there are ``rank`` numbers for each term of each row
        pull = np.empty(len(at))
        for low in range(0, len(other), ROWS):
            a, z = np.searchsorted(owner, [low, low + ROWS])
            own, mine = whole.factor[at[a:z]], owner[a:z] - low
            pull[a:z] = ((summed(own, mine, ROWS)[mine] - own) * own).sum(axis=1)
        n = np.maximum(np.bincount(at, minlength=len(vocab)), 1)
        # within a term's rows: does the pull of its pairs go with the label?
        pull -= (np.bincount(at, pull, len(vocab)) / n)[at]
        within = rest[owner] - (np.bincount(at, rest[owner], len(vocab)) / n)[at]
        both = np.bincount(at, pull * within, len(vocab))
        spread = np.bincount(at, pull * pull * within * within, len(vocab))
        found.append(vocab[(both > 0) & (both * both >= evidence * np.maximum(spread, 1e-12))])
    return np.unique(np.concatenate(found))


def scores(machine: Machine, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Scores of packed rows, some at a time."""
    out = np.empty(len(bounds) - 1)
    for low in range(0, len(out), ROWS):
        high = min(len(out), low + ROWS)
        at, on = known(hashes[bounds[low] : bounds[high]], machine.vocab)
        owner = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
        out[low:high] = logistic(machine.bias + interactions(machine.weight, machine.factor, at[on], owner[on], high - low))
    return out


def learn(y: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, vocab: np.ndarray, rank: int, epochs: int, batch: int, rate: float, decay: float, seed: int) -> Machine:
    """The machine over the terms of ``vocab``."""
    share = float(y.mean()) if len(y) else 0.0
    if not len(vocab) or share in (0.0, 1.0):
        bias = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Machine(np.zeros(0, np.uint64), float(bias), np.zeros(0, np.float32), np.zeros((0, rank), np.float32))
    rng = np.random.default_rng(seed)
    at_all, on = known(hashes, vocab)
    kept = np.concatenate([[0], np.cumsum(on)])[bounds]
    at_all = at_all[on]
    weight = np.zeros(len(vocab), np.float32)
    factor = rng.normal(0, 0.01, (len(vocab), rank)).astype(np.float32)
    moments = [np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(factor), np.zeros_like(factor)]
    bias = float(np.log(share / (1 - share)))
    importance = np.where(y > 0, min(3.0, (1 - share) / share), 1.0)
    step = 0
    # a small sample takes more rounds, to make as many steps
    for _ in range(max(epochs, -(-STEPS * batch // len(y)))):
        order = rng.permutation(len(y))
        for low in range(0, len(order), batch):
            rows = np.sort(order[low : low + batch])
            sizes = kept[rows + 1] - kept[rows]
            owner = np.repeat(np.arange(len(rows)), sizes)
            at = np.concatenate([at_all[kept[r] : kept[r + 1]] for r in rows])
            own = factor[at]
            total = summed(own, owner, len(rows))
            squares = summed((own * own).sum(axis=1), owner, len(rows))
            raw = bias + summed(weight[at], owner, len(rows)) + 0.5 * ((total * total).sum(axis=1) - squares)
            error = ((logistic(raw) - y[rows]) * importance[rows] / len(rows)).astype(np.float32)
            bias -= rate * float(error.sum())
            used, place = np.unique(at, return_inverse=True)
            toward = error[owner]
            grad_w = np.bincount(place, toward, len(used)).astype(np.float32) + decay * weight[used]
            spread = toward[:, None] * (total[owner] - own)
            grad_f = np.stack([np.bincount(place, spread[:, k], len(used)) for k in range(rank)], axis=1).astype(np.float32) + decay * factor[used]
            step += 1
            for value, grad, m, v in ((weight, grad_w, moments[0], moments[1]), (factor, grad_f, moments[2], moments[3])):
                m[used] = 0.9 * m[used] + 0.1 * grad
                v[used] = 0.99 * v[used] + 0.01 * grad * grad
                value[used] -= rate * (m[used] / (1 - 0.9 ** min(step, 500))) / (np.sqrt(v[used] / (1 - 0.99 ** min(step, 5000))) + 1e-4)
    return Machine(vocab, bias, weight, factor)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 8000, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Machine:
    """Learns only rows whose id's crc32 mod 5 is not 0. ``per_label`` bounds the sample's rows,
    ``features.SAMPLE_BYTES`` its texts."""
    ready(docs.sparkSession)
    marks = narrow(labels, id=id_col, label=F.col(toxic).cast("int")).where("label IN (0, 1) AND id IS NOT NULL")
    marks = marks.where(checksum_mod("id", FOLDS) != 0).groupBy("id").agg(F.max("label").alias("label"))
    chosen = stage(sampled(sized(marks, docs, id_col, text), "label", per_label, "bytes").select("id", "label"), "toxicity-sample")
    if chosen.count() * 16 <= BROADCAST_BYTES:  # bounded by 2 * per_label
        chosen = F.broadcast(chosen)
    return fit(*collected(narrow(docs, id=id_col, text=text).join(chosen, "id"), terms))


def score(docs: DataFrame, model: Machine, text: str = "text") -> DataFrame:
    """``row`` (the row of docs as it is), ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.vocab, model.bias, model.weight, model.factor))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*sent.value)
        for batch, t in pieces(own_text(batches, place)):
            out = machine.score(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.astype(np.float64)), pa.array((out >= 0.5).astype(np.int32))], names=["row", "score", "predicted"])

    rows, place = whole_rows(docs, text)
    schema = rows.select("row").schema.add("score", DoubleType()).add("predicted", IntegerType())
    return rows.mapInArrow(task, schema)


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", per_label: int = 8000) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score, predicted."""
    model = train(docs, labels, per_label, id_col, text)
    rows = score(narrow(docs, **{id_col: id_col, "text": text}), model)
    out = rows.select(F.col(f"row.{id_col}").alias(id_col), "score", "predicted")
    return out.select(id_col, (checksum_mod(id_col, FOLDS) == 0).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", per_label: int = 8000) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, unchanged."""
    model = train(docs, labels, per_label, id_col, text)
    return score(docs, model, text).where("predicted = 0").select("row.*")
