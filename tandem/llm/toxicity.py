"""Toxicity: maximum-scoring segments over token log-odds, calibrated by extreme values.

*Log-odds.* In how many toxic and how many clean labelled documents a word stands is compared under
an informative Dirichlet prior, the counts of both together; equal texts count once. Only words whose
log-odds stand out of their own error are kept. Words that are not kept fall back on their first
letters, counted the same way.

*Segments.* A word scores its log-odds less a drift that makes the expected score of clean text
negative. A linear-time scan finds all maximal scoring segments of a text. Most words only cost the
drift, so the scan runs over the scoring words and sums of what lies between.

*Calibration.* Over clean documents the best segment of n words exceeds x with probability
1 - exp(-K n exp(-lambda x)). Lambda solves sum p(s) exp(lambda s) = 1 over the scores of clean
words, K is fitted to the best segments of clean documents. A segment then counts lambda x - ln(K n);
the best one and the sum of all significant ones go through a logistic fit to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import held_out, release, word_list, worker_store
from tandem.session import stage

SAMPLE_ROWS = 20_000
PRIOR = 0.05
LEAST_Z = 3.0
DISCOUNT = 2.0
LEAST_COUNT = 4
STEM_BYTES = 5
DRIFT = 0.5
THRESHOLD = 0.3
SEED = 7


@dataclass
class ToxicityModel:
    """Scores of words and stems, and what calibrates a document's segments."""

    words: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)
    drift: float = DRIFT
    decay: float = 1.0
    constant: float = 1e-3
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def scores(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.words.get, words, [np.nan] * len(words)), np.float64, len(words))
        if self.stems:
            missing = np.isnan(found)
            stems = [w[:STEM_BYTES] if len(w) > STEM_BYTES else b"" for w in words]
            found[missing] = np.fromiter(map(self.stems.get, stems, [0.0] * len(words)), np.float64, len(words))[missing]
        return np.nan_to_num(found) - self.drift

    def features(self, text: str | None) -> tuple[int, float, float, list[tuple[int, int, float]]]:
        """Words, evidence of the best segment, summed evidence of significant ones, and these as (start, end, score)."""
        words = word_list(text)
        segments = maximal_segments(self.scores(words)) if words else []
        floor = np.log(self.constant * max(1, len(words)))
        evidence = [self.decay * s - floor for *_, s in segments]
        best = max(evidence, default=-floor)
        kept = [s for s, e in zip(segments, evidence) if e > 0]
        return len(words), float(best), float(sum(e for e in evidence if e > 0)), kept

    def probability(self, best: float, total: float) -> float:
        bias, by_best, by_total = self.weights
        return float(1 / (1 + np.exp(-np.clip(bias + by_best * squashed(best) + by_total * squashed(total), -40, 40))))


def squashed(evidence: float) -> float:
    """Evidence on a scale that one overwhelming passage does not leave."""
    return float(np.sign(evidence) * np.log1p(abs(evidence)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence as (start, end, score), in order, in linear time.

    Each candidate keeps the sum before it and the sum at its end. A new candidate looks back for the
    last one that starts lower, and swallows all from there on if its end is the higher one.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at end, last candidate that starts lower
    for at in positive.tolist():
        start, end, low, high = at, at + 1, float(total[at]), float(total[at + 1])
        back = len(found) - 1
        while True:
            while back >= 0 and found[back][2] >= low:
                back = found[back][4]
            if back < 0 or found[back][3] >= high:
                break
            start, low, following = found[back][0], found[back][2], found[back][4]
            del found[back:]
            back = following
        found.append((start, end, low, high, back))
    return [(start, end, high - low) for start, end, low, high, _ in found]


# ------------------------------------------------------------------ learning


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """text and toxic of about ``rows`` labelled documents that may be learned from, by a hash of their id.

    Toxic labels are taken first, up to half of the rows. An id with several labels is toxic if any
    is; NULL labels do not count.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = stage(known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("__toxic")), "labels")
    sizes = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}
    toxic = min(sizes.get(1, 0), rows // 2)
    scale = 1 << 40
    share = {1: toxic / max(1, sizes.get(1, 0)), 0: (rows - toxic) / max(1, sizes.get(0, 0))}
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("__id")), F.lit(scale))
    limit = F.when(F.col("__toxic") == 1, F.lit(int(scale * min(1.0, share[1])))).otherwise(F.lit(int(scale * min(1.0, share[0]))))
    # At most about SAMPLE_ROWS ids by construction.
    chosen = F.broadcast(stage(known.filter(draw < limit), "labels"))
    return docs.join(chosen, F.col("doc_id").cast("long") == F.col("__id")).select("text", F.col("__toxic").alias("toxic"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("toxicity")
    counts: dict[tuple[bool, bytes], list[int]] = {}

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        columns = [
            pa.array([k[0] for k in keys], pa.bool_()),
            pa.array([k[1] for k in keys], pa.binary()),
            pa.array([counts[k][0] for k in keys], pa.int64()),
            pa.array([counts[k][1] for k in keys], pa.int64()),
        ]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, ["stem", "token", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(word_list(text))
            stems = {word[:STEM_BYTES] for word in words if len(word) > STEM_BYTES}
            for key in (*((False, w) for w in words), *((True, w) for w in stems)):
                counts.setdefault(key, [0, 0])[toxic] += 1
            if len(counts) > 200_000:
                yield flush()
    yield flush()


def log_odds(counted: DataFrame, n_clean: int, n_toxic: int, prior: float = PRIOR, least_z: float = LEAST_Z, least_count: int = LEAST_COUNT) -> DataFrame:
    """stem, token, clean, delta of the tokens of ``counted`` (stem, token, clean, toxic) that stand out.

    ``delta`` is the log-odds of toxic over clean documents under a Dirichlet prior that weighs as
    much as the share ``prior`` of all documents and is distributed as tokens are over all of them;
    it is kept where it exceeds ``least_z`` times its error, less ``DISCOUNT`` errors, so that rare
    words weigh what they are sure to.
    """
    weight = prior * (n_clean + n_toxic)
    alpha = F.lit(prior) * (F.col("clean") + F.col("toxic"))

    def log_odd(count: str, n: int) -> Column:
        with_it = F.col(count) + alpha
        return F.log(with_it / (F.lit(n + weight + 1e-9) - with_it))

    error = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("clean") + alpha))
    scored = counted.withColumn("delta", log_odd("toxic", n_toxic) - log_odd("clean", n_clean)).withColumn("z", F.col("delta") / error)
    kept = (F.abs("z") >= least_z) & (F.col("clean") + F.col("toxic") >= least_count)
    sure = F.col("delta") - F.lit(DISCOUNT) * error * F.signum("delta")
    return scored.filter(kept).select("stem", "token", "clean", sure.alias("delta"))


def karlin_decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(shares * exp(x * scores)) = 1 for scores of negative mean; 1 if there is none."""
    if not (scores > 0).any() or (scores * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum())
    while value(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return high


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a weighted logistic regression, by Newton steps; the first is the bias."""
    x = np.column_stack([np.ones(len(features)), features])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (labels - p)) - ridge * beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _features(model) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        rows = [model.value.features(t.as_py()) for t in texts]
        n, best, total, _ = zip(*rows) if rows else ((), (), (), ())
        s = [max((score for *_, score in r[3]), default=0.0) for r in rows]
        columns = [pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(total, pa.float64()), pa.array(s, pa.float64())]
        return pa.StructArray.from_arrays(columns, ["n", "best", "total", "score"])

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "n long, best double, total double, score double")("text")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> ToxicityModel:
    """A model of a bounded sample of labelled documents. Without labels of both kinds nothing is toxic."""
    spark = docs.sparkSession
    sample = stage(labelled_sample(docs, labels, rows, seed), "labelled")
    texts = stage(sample.filter("text IS NOT NULL").groupBy("text").agg(F.max("toxic").alias("toxic")), "texts")
    n_toxic, n_all = texts.agg(F.sum("toxic"), F.count("*")).first()
    counted = texts.mapInArrow(_counts, "stem boolean, token binary, clean long, toxic long")
    counted = stage(counted.groupBy("stem", "token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "counts")
    n_clean = counted.filter("NOT stem").agg(F.sum("clean")).first()[0] or 0
    model = ToxicityModel()
    kept = log_odds(counted, n_all - (n_toxic or 0), n_toxic or 0).collect()  # of a bounded sample, and only what stands out
    clean_scores, clean_counts = [], []
    for row in kept:
        (model.stems if row["stem"] else model.words)[bytes(row["token"])] = row["delta"]
        if not row["stem"]:
            clean_scores.append(row["delta"] - model.drift)
            clean_counts.append(row["clean"])
    clean_scores.append(-model.drift)
    clean_counts.append(max(1, n_clean - sum(clean_counts)))
    shares = np.array(clean_counts, float)
    model.decay = karlin_decay(np.array(clean_scores), (shares + 0.5) / (shares + 0.5).sum())
    model.constant = 1.0
    raw = _collected(sample, model, spark)
    # Score of the best segment, from its evidence at K = 1; K by maximum likelihood over clean documents.
    clean = raw[raw[:, 3] == 0]
    if len(clean):
        best = np.maximum(0.0, clean[:, 1] + np.log(np.maximum(1, clean[:, 0])))
        model.constant = float(np.clip(((best > 0).sum() + 0.5) / (np.maximum(1, clean[:, 0]) * np.exp(-best)).sum(), 1e-12, 1.0))
    rows_ = _collected(sample, model, spark)
    if len(np.unique(rows_[:, 3])) < 2:
        model.weights = (-40.0, 0.0, 0.0)
        return model
    # Weights that undo the sampling of toxic documents.
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out("doc_id")).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    share = rows_[:, 3].mean()
    weights = np.where(rows_[:, 3] == 1, known / share, (1 - known) / (1 - share))
    features = np.array([[squashed(b), squashed(t)] for b, t in rows_[:, 1:3]])
    model.weights = tuple(float(w) for w in logistic(features, rows_[:, 3], weights))
    return model


def _collected(sample: DataFrame, model: ToxicityModel, spark) -> np.ndarray:
    """Words, best evidence, total evidence and label of the sample."""
    sent = spark.sparkContext.broadcast(model)
    read = sample.select(_features(sent).alias("f"), "toxic").select("f.n", "f.best", "f.total", "toxic").toArrow()
    return np.column_stack([read.column(c).to_numpy().astype(float) for c in ("n", "best", "total", "toxic")]) if read.num_rows else np.empty((0, 4))


# ------------------------------------------------------------------ scoring


def toxicity(text: str | Column, model: ToxicityModel, spark) -> Column:
    """Struct column score and passages of a text; passages are word positions [start, end) with their evidence."""
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_store("toxicity")
        for batch in batches:
            scores, passages = [], []
            for value in batch:
                _, best, total, kept = sent.value.features(value.as_py())
                scores.append(sent.value.probability(best, total))
                passages.append([{"start": a, "end": b, "score": s} for a, b, s in kept])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(passages, kind)], ["score", "passages"])
        release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = "score double, passages array<struct<start: int, end: int, score: double>>"
    return F.arrow_udf(run, kind)(F.col(text) if isinstance(text, str) else text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and passages of every row of ``docs`` (doc_id, text).

    Only the text enters a score. NULL and empty texts have no words and score as a clean text does.
    Rows are neither joined nor shuffled for scoring: rows with the same id, or none, each get
    their score. Other columns are ignored.
    """
    model = train(docs, labels)
    read = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity("text", model, docs.sparkSession).alias("t"))
    return read.select(
        "doc_id", "held_out", "t.score", (F.col("t.score") >= threshold).cast("int").alias("predicted"), "t.passages"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; columns stay as they are."""
    model = train(docs, labels)
    scored = docs.withColumn("__toxicity", toxicity("text", model, docs.sparkSession)["score"])
    return scored.filter(F.col("__toxicity") < threshold).select(*docs.columns)
