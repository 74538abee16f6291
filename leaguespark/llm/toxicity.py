"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its lower-cased words and their beginnings of ``STEMS``
characters, hashed into ``BUCKETS``; a document is the set of its terms, with
values scaled to length one.  The machine is

    logit = b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so that a pair of terms, such as an insult with a group it is aimed at, has a
weight of its own (the product of two factor rows), which additive weights miss.

Training takes at most ``MAX_POSITIVE`` and ``MAX_NEGATIVE`` labelled texts, chosen
by a hash (a documented bound on the fit alone).  Labels and hashes of the texts are
grouped first, so a text that stands in many rows is one text of each label it has,
and a group of copies can't fill the sample; only the chosen texts are fetched.
Spark deals the hashed rows into ``PARTS`` groups, once, and keeps them over the
rounds; in each round every group takes one AdaGrad pass from the shared weights,
and each weight becomes the mean over the groups that changed it.  Terms in fewer
than ``MIN_ROWS`` training rows are left out.  A share of the rows is kept from
training and calibrates the logit (slope and intercept, by Newton steps, with the
two sampling rates as weights).  Every row of the input is scored, over its whole
text.

Defined cases: null and wordless texts have no terms and score the intercept;
null labels are not learned from; without labels of both classes the score is the
share of label 1 (0 without labels); repeated rows are learned from once and scored
alike; an existing column ``__score`` is replaced; an empty table is scored as empty;
labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import small_batches, stash, unit_hash

BUCKETS = 1 << 18
FACTORS = 4
STEMS = (3, 4, 5)
MIN_ROWS = 4
MAX_POSITIVE = 8_000
MAX_NEGATIVE = 16_000
ROUNDS = 10
PARTS = 4
RATE = 1.0
RIDGE = 3e-3
DAMPING = 0.1
CALIBRATION = 0.15
SEED = 5

#: Bytes that part words: ASCII other than letters and digits.
_SPLIT = bytes(b if re.match(rb"[0-9A-Za-z\x80-\xff]", bytes([b])) else 32 for b in range(256))


def terms_of(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a text, sorted."""
    if not text:
        return np.empty(0, np.int32)
    words = set(text.lower().encode("utf-8", "replace").translate(_SPLIT).decode().split())
    terms = {zlib.crc32(w.encode()) for w in words}
    for n in STEMS:  # hashed apart for each length; shorter words have none
        terms.update(zlib.crc32(s.encode(), n) for s in {w[:n] for w in words if len(w) > n})
    return np.unique(np.fromiter(terms, np.int64, len(terms)) % BUCKETS).astype(np.int32)


class FactorizationMachine:
    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.bias = 0.0
        self.linear = np.zeros(BUCKETS, np.float32)
        self.factors = rng.normal(0, 0.05, (BUCKETS, FACTORS)).astype(np.float32)
        self.known = np.ones(BUCKETS, bool)
        self.slope, self.intercept = 1.0, 0.0

    def logit(self, terms: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        rows, x = self.factors[terms], 1 / math.sqrt(max(1, len(terms)))
        sums = rows.sum(0) * x
        pairs = 0.5 * float((sums * sums).sum() - (rows * rows).sum() * x * x)
        return self.bias + float(self.linear[terms].sum()) * x + pairs, rows, sums

    def score(self, text: str | None) -> float:
        terms = terms_of(text)
        z = self.slope * self.logit(terms[self.known[terms]])[0] + self.intercept
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

    def train(self, rows: list[tuple[np.ndarray, int]]) -> None:
        """One AdaGrad pass."""
        g_bias = DAMPING
        g_linear = np.full(BUCKETS, DAMPING, np.float32)
        g_factors = np.full((BUCKETS, FACTORS), DAMPING, np.float32)
        for terms, label in rows:
            z, own, sums = self.logit(terms)
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - label
            x = 1 / math.sqrt(max(1, len(terms)))
            g_bias += error * error
            self.bias -= RATE * error / math.sqrt(g_bias)
            grad = error * x + RIDGE * self.linear[terms]
            g_linear[terms] += grad * grad
            self.linear[terms] -= RATE * grad / np.sqrt(g_linear[terms])
            grad = error * (x * sums - x * x * own) + RIDGE * own
            g_factors[terms] += grad * grad
            self.factors[terms] -= 0.2 * RATE * grad / np.sqrt(g_factors[terms])

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Slope and intercept by weighted logistic regression, with a weak prior on slope 1."""
        if not len(logits):
            return
        theta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(theta[0] * logits + theta[1], -30, 30)))
            r, w = weights * (labels - p), weights * p * (1 - p)
            grad = np.array([(r * logits).sum() - 0.01 * (theta[0] - 1), r.sum() - 0.01 * theta[1]])
            hess = np.array([[(w * logits**2).sum() + 0.01, (w * logits).sum()], [(w * logits).sum(), w.sum() + 0.01]])
            step = np.linalg.solve(hess, grad)
            theta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        if theta[0] > 0:
            self.slope, self.intercept = float(theta[0]), float(theta[1])


def with_keys(docs: DataFrame) -> DataFrame:
    """The columns, and __h1 and __h2, by which equal texts are one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"__h1": F.xxhash64(text), "__h2": F.xxhash64(F.lit(1), text)})


def choose(labelled: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """(h1, h2, label, u) of the chosen texts, and the rate at which each label was taken; labelled: __h1, __h2, label."""
    rows = labelled.select(F.col("__h1").alias("h1"), F.col("__h2").alias("h2"), F.col("label").cast("int").alias("label")).filter("label IN (0, 1)")
    texts = stash(rows.distinct().withColumn("u", unit_hash("h1", "h2", F.lit(SEED))))
    found = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen, rates = texts.limit(0), {}
    for label, most in ((0, MAX_NEGATIVE), (1, MAX_POSITIVE)):
        if label in found:
            rates[label] = min(1.0, most / found[label])
            # The first by hash; what can't be among them is left out before they are ordered.
            near = texts.filter((F.col("label") == label) & (F.col("u") < 1.2 * rates[label]))
            chosen = chosen.unionByName(near.orderBy("u", "h1", "h2").limit(most))
    return stash(chosen), rates


def training_rows(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(u, label, terms) of the chosen texts; texts: text, __h1, __h2."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # at most as many as are chosen
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in (2, 3, 1)), strict=True))
            new = [i for i, key in enumerate(keys) if key not in seen and not seen.add(key)]
            terms = [terms_of(batch.column(4)[i].as_py()) for i in new]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(new, pa.int64())) for c in batch.columns[:4]), pa.array(terms, pa.list_(pa.int32()))], ["u", "label", "h1", "h2", "terms"])

    few = F.broadcast(chosen)  # at most MAX_POSITIVE + MAX_NEGATIVE rows of 28 bytes
    rows = texts.select("__h1", "__h2", F.col("text").cast("string").alias("text")).join(few, (F.col("__h1") == F.col("h1")) & (F.col("__h2") == F.col("h2")))
    found = rows.select("u", "label", "h1", "h2", "text").mapInArrow(hashed, "u double, label int, h1 long, h2 long, terms array<int>")
    return stash(found).dropDuplicates(["h1", "h2", "label"]).select("u", "label", "terms")


def _rows_of(table: pa.Table) -> list[tuple[np.ndarray, int]]:
    table = table.combine_chunks().sort_by([("u", "ascending"), ("label", "ascending")])
    return [(np.asarray(terms.values), label) for terms, label in zip(table["terms"], table["label"].to_pylist(), strict=True)]


def _learner(shared, turn: int):
    """A pass over one group; returns what it changed."""

    def learn(group):
        rows = [(terms[shared.value.known[terms]], label) for terms, label in _rows_of(group)]
        order = np.random.default_rng(turn).permutation(len(rows))
        old, new = shared.value, FactorizationMachine()
        new.bias, new.linear, new.factors = old.bias, old.linear.copy(), old.factors.copy()
        new.train([rows[i] for i in order])
        at = np.flatnonzero(new.linear != old.linear).astype(np.int32)
        return pa.table({"part": group["part"][:1], "bias": [new.bias], "at": [at.tobytes()], "linear": [new.linear[at].tobytes()], "factors": [new.factors[at].tobytes()]})

    return learn


def fit(labelled: DataFrame, texts: DataFrame | None = None) -> FactorizationMachine:
    """A calibrated machine from rows of (text, label).

    ``texts`` are the rows to fetch the chosen texts from, if not the labelled ones;
    both then carry ``with_keys``, so that a join with labels moves no texts.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    labelled = labelled if "__h1" in labelled.columns else with_keys(labelled)
    chosen, rates = choose(labelled)
    sample = stash(training_rows(labelled if texts is None else texts, chosen))
    model = FactorizationMachine()
    if set(rates) != {0, 1}:
        model.slope, model.intercept = 0.0, 500.0 if set(rates) == {1} else -500.0
        return model
    frequent = sample.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_ROWS)
    model.known = np.zeros(BUCKETS, bool)
    model.known[frequent.select("term").toArrow()["term"].to_numpy()] = True  # at most BUCKETS numbers
    # Both the held-back rows and the groups follow from the hash, so reruns agree.
    slot = F.floor(F.col("u") * (1 << 40)) % 1000
    sample = sample.withColumn("back", slot < int(1000 * CALIBRATION)).withColumn("part", (slot % PARTS).cast("int"))

    # Dealt once, each group to a task of its own, and kept over the rounds: dealt in each, every round would leave the whole sample in shuffle files.
    dealt = sample.filter("NOT back").repartitionById(PARTS, "part").persist()
    try:
        for turn in range(ROUNDS):
            shared = spark.sparkContext.broadcast(model)

            learned = dealt.groupBy("part").applyInArrow(_learner(shared, turn), "part int, bias double, at binary, linear binary, factors binary")
            touched, linear, factors = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.float64), np.zeros((BUCKETS, FACTORS))
            biases = []
            for row in sorted(learned.collect(), key=lambda r: r.part):  # PARTS rows of bounded size
                at = np.frombuffer(row.at, np.int32)
                touched[at] += 1
                linear[at] += np.frombuffer(row.linear, np.float32)
                factors[at] += np.frombuffer(row.factors, np.float32).reshape(-1, FACTORS)
                biases.append(row.bias)
            shared.unpersist()
            if not biases:
                break
            at = touched > 0
            model.bias = float(np.mean(biases))
            model.linear[at] = linear[at] / touched[at]
            model.factors[at] = factors[at] / touched[at, None]
    finally:
        dealt.unpersist()

    shared = spark.sparkContext.broadcast(model)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.asarray(t.values) for t in batch.column(1)]
            z = [shared.value.logit(t[shared.value.known[t]])[0] for t in terms]
            yield pa.record_batch([batch.column(0), pa.array(z, pa.float64())], ["label", "z"])

    back = sample.filter("back").select("label", "terms").mapInArrow(logits, "label int, z double").toArrow()
    labels, z = back["label"].to_numpy(), back["z"].to_numpy()
    order = np.lexsort((z, labels))
    labels, z = labels[order], z[order]
    if len(set(labels.tolist())) == 2:
        model.calibrate(z, labels, np.where(labels == 1, 1 / rates[1], 1 / rates[0]))
    return model


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """The documents' columns and __score."""
    docs = docs.drop("__score")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = names.index("text")
        for batch in batches:
            scores = pa.array([shared.value.score(t.as_py()) for t in batch.column(at_text)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, "__score"])

    return docs.mapInArrow(apply, docs.limit(0).withColumn("__score", F.lit(None).cast("double")).schema)
