"""Quality grades by ordinal cumulative-link regression on graded ratings.

Grades 0 .. K-1 share one weight vector over hashed words and word shapes; they
differ in K-1 ascending thresholds: P(grade > k) is the logistic of the text's
value less threshold k. That gives an expected grade and a tail probability
P(grade >= g) to select by.

Trained on at most about ``per_grade`` rated rows of each grade (a documented
bound); features whose chi-square with every threshold is under ``evidence``
carry no weight. Scoring reads each text once in the scan, without a shuffle.

Defined cases: null and empty texts have no features and get the value 0, which
the thresholds turn into the grades' prior; null ratings are not learned; of
several ratings of a document the lowest counts. With one grade only it has
probability 1; without ratings the expected grade is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import BROADCAST_BYTES, checksum_mod, narrow, ready
from ticketloom.llm.features import collected, known, sampled, sized, summed, telling, terms_and_shapes, vocabulary
from ticketloom.llm.textbytes import Texts, pieces
from ticketloom.session import stage

FOLDS = 5
#: Steps of training at least.
STEPS = 300


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Scale:
    """Weights by term, and the thresholds; ``grades`` are K of them."""

    vocab: np.ndarray
    weight: np.ndarray
    cuts: np.ndarray

    def tails(self, t: Texts) -> np.ndarray:
        """P(grade > k) for k = 0 .. K-2, a row for each text."""
        owner, hashes = terms_and_shapes(t)
        at, on = known(hashes, self.vocab)
        value = values(self.weight, at[on], owner[on], t.n)
        return logistic(value[:, None] - self.cuts[None, :])


def values(weight: np.ndarray, at: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Mean weight of a text's known features times the root of their number."""
    sizes = np.bincount(owner, minlength=n)
    return summed(weight[at].astype(np.float64), owner, n) / np.sqrt(np.maximum(sizes, 1))


def fit(grades: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, least: int = 3, evidence: float = 12.0, epochs: int = 12, batch: int = 256, rate: float = 0.05,
        decay: float = 1e-5, seed: int = 11) -> Scale:
    """Adam on the likelihood of the grades. Steps between thresholds are kept
    positive as exponentials, so the order of the grades always holds."""
    k = int(grades.max()) + 1 if len(grades) else 1
    if k < 2:
        return Scale(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    common = vocabulary(hashes, least)
    vocab = np.unique(np.concatenate([telling((grades > c).astype(np.float64), bounds, hashes, common, evidence) for c in range(k - 1)]))
    at_all, on = known(hashes, vocab)
    kept = np.concatenate([[0], np.cumsum(on)])[bounds]
    at_all = at_all[on].astype(np.int32)
    share = np.clip(np.array([(grades <= c).mean() for c in range(k - 1)]), 1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(k - 1))
    steps = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    weight = np.zeros(len(vocab))
    m, v = np.zeros_like(weight), np.zeros_like(weight)
    cm, cv = np.zeros(k - 1), np.zeros(k - 1)
    rng = np.random.default_rng(seed)
    padded = lambda c: np.concatenate([[-np.inf], c, [np.inf]])
    step = 0
    # a small sample takes more rounds, to make as many steps
    for _ in range(max(epochs, -(-STEPS * batch // len(grades)))):
        order = rng.permutation(len(grades))
        for low in range(0, len(order), batch):
            rows = np.sort(order[low : low + batch])
            sizes = kept[rows + 1] - kept[rows]
            owner = np.repeat(np.arange(len(rows)), sizes)
            at = np.concatenate([at_all[kept[r] : kept[r + 1]] for r in rows])
            scale = 1.0 / np.sqrt(np.maximum(sizes, 1))
            value = summed(weight[at], owner, len(rows)) * scale
            cuts = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])
            y = grades[rows].astype(int)
            upper = logistic(padded(cuts)[y + 1] - value)
            lower = logistic(padded(cuts)[y] - value)
            gap = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper) / gap, lower * (1 - lower) / gap
            error = (du - dl) / len(rows)  # slope of the loss in the value
            toward_cut = np.zeros(k + 1)
            np.add.at(toward_cut, y + 1, -du / len(rows))
            np.add.at(toward_cut, y, dl / len(rows))
            toward_cut = toward_cut[1:k]
            toward_step = np.cumsum(toward_cut[::-1])[::-1] * np.concatenate([[1.0], np.exp(steps[1:])])
            used, place = np.unique(at, return_inverse=True)
            grad = np.bincount(place, (error * scale)[owner], len(used)) + decay * weight[used]
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * grad
            v[used] = 0.99 * v[used] + 0.01 * grad * grad
            weight[used] -= rate * m[used] / (np.sqrt(v[used]) + 1e-5)
            cm, cv = 0.9 * cm + 0.1 * toward_step, 0.99 * cv + 0.01 * toward_step**2
            steps -= rate * cm / (np.sqrt(cv) + 1e-5)
    cuts = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])
    return Scale(vocab, weight, cuts)


def train(docs: DataFrame, ratings: DataFrame, grade: Column, per_grade: int = 6000, id_col: str = "doc_id", text: str = "text") -> Scale:
    """Learns only rows whose id's crc32 mod 5 is not 0. ``grade`` is an expression
    over ``ratings`` that gives whole numbers from 0. ``per_grade`` bounds the sample's
    rows, ``features.SAMPLE_BYTES`` its texts."""
    ready(docs.sparkSession)
    marks = narrow(ratings, id=id_col, label=grade.cast("int")).where("label >= 0 AND id IS NOT NULL")
    marks = marks.where(checksum_mod("id", FOLDS) != 0).groupBy("id").agg(F.min("label").alias("label"))
    chosen = stage(sampled(sized(marks, docs, id_col, text), "label", per_grade, "bytes").select("id", "label"), "quality-sample")
    if chosen.count() * 16 <= BROADCAST_BYTES:  # bounded by per_grade rows a grade
        chosen = F.broadcast(chosen)
    return fit(*collected(narrow(docs, id=id_col, text=text).join(chosen, "id"), terms_and_shapes))


def grade(docs: DataFrame, model: Scale, select_from: int = 1, select_at: float = 0.5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, expected_grade, tails
    (P(grade >= 1), P(grade >= 2), ...), tail_prob = P(grade >= select_from), selected."""
    sent = docs.sparkSession.sparkContext.broadcast((model.vocab, model.weight, model.cuts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = Scale(*sent.value)
        for batch, t in pieces(batches):
            tails = scale.tails(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                                             names=["id", "expected_grade", "tails"])

    rows = narrow(docs, id=id_col, text=text).mapInArrow(task, "id bigint, expected_grade double, tails array<double>")
    tail = F.coalesce(F.get("tails", F.lit(select_from - 1)), F.lit(1.0 if select_from <= 0 else 0.0))
    return rows.select(F.col("id").alias(id_col), (checksum_mod("id", FOLDS) == 0).alias("held_out"), "expected_grade", "tails",
                       tail.alias("tail_prob"), (tail >= select_at).alias("selected"))
