"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text becomes its byte n-grams of two, three and four bytes within and across words, hashed into
buckets. Its vector is the mean of the buckets' embeddings, and a linear softmax over that mean
gives a probability per language. Embeddings and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled rows; a part of the sample is kept back to fit the
temperature and the rejection threshold. Since mean and softmax layer are both linear, a trained
model is one table of bucket by language, which is what tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import held_out, worker_store

SAMPLE_ROWS = 4_000
BUCKETS = 1 << 15
WIDTH = 16
EPOCHS = 6
RATE = 0.5
SIZES = (2, 3, 4)
# Share of texts of the kept-back part that may be rejected.
REJECTED = 0.01
SEED = 3
UNKNOWN = "und"
SLICE = 1 << 20

_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def subwords(raw: bytes) -> np.ndarray:
    """Buckets of all n-grams of a folded text; letters count, everything else is a blank."""
    codes = np.frombuffer(raw, np.uint8).astype(np.uint32)
    parts = []
    for size in SIZES:
        if len(codes) < size:
            continue
        value = np.full(len(codes) - size + 1, size, np.uint32)
        for i in range(size):
            value = value * np.uint32(0x01000193) ^ codes[i : len(codes) - size + 1 + i]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA6B)
        parts.append(value >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def folded(text: str) -> bytes:
    return b" " + text.lower().encode().translate(_FOLD) + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """Languages in order, the table of bucket by language, temperature, and the score to reject below."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        """Mean over the whole text, in slices so that a very long text needs little memory."""
        raw, total, count = folded(text), np.zeros(len(self.languages)), 0
        for start in range(0, len(raw), SLICE):
            # Slices overlap by what the longest n-gram reaches; shorter ones meet twice at the seam, which averages out.
            buckets = subwords(raw[start : start + SLICE + SIZES[-1] - 1])
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            count += len(buckets)
        return total / max(1, count) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether that is below the rejection threshold."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        probabilities = softmax(self.logits(text)[None] / self.temperature)[0]
        best = int(probabilities.argmax())
        score = float(min(1.0, probabilities[best]))
        return self.languages[best], score, score < self.threshold


def softmax(logits: np.ndarray) -> np.ndarray:
    value = np.exp(logits - logits.max(axis=1, keepdims=True))
    return value / value.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], epochs: int = EPOCHS, rate: float = RATE, width: int = WIDTH, seed: int = SEED) -> LanguageModel:
    """Train on rows with letters; without any the model knows no language. Rows are used in a seeded order."""
    rows = [(t, y) for t, y in zip(texts, labels) if has_letter(t)]
    languages = sorted({y for _, y in rows})
    k = len(languages)
    if k < 2:
        return LanguageModel(languages, np.zeros((BUCKETS, k), np.float32), np.zeros(k))
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    bags = []
    for i in order:
        counts = np.bincount(subwords(folded(rows[i][0])), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        bags.append((used, (counts[used] / max(1, counts.sum())).astype(np.float32), languages.index(rows[i][1])))
    back = bags[: len(bags) // 5] if len(bags) >= 50 else []
    train = bags[len(back) :]
    embedding = random.uniform(-1 / width, 1 / width, (BUCKETS, width)).astype(np.float32)
    layer, bias = np.zeros((width, k), np.float32), np.zeros(k, np.float32)
    weight = len(train) / (k * np.maximum(1, np.bincount([y for *_, y in train], minlength=k)))
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for j in random.permutation(len(train)):
            used, share, y = train[j]
            hidden = share @ embedding[used]
            error = softmax((hidden @ layer + bias)[None])[0].astype(np.float32)
            error[y] -= 1
            pace = np.float32(rate * (1 - step / steps) * min(4.0, weight[y]))
            back_hidden = layer @ error
            layer -= pace * np.outer(hidden, error)
            bias -= pace * np.float32(0.1) * error
            # A mean over many buckets moves little by a plain step, so its gradient is scaled up.
            embedding[used] -= pace * np.float32(20) * share[:, None] * back_hidden
            step += 1
    model = LanguageModel(languages, (embedding @ layer).astype(np.float32), bias.astype(np.float64))
    return calibrate(model, back or train)


def calibrate(model: LanguageModel, bags: list[tuple]) -> LanguageModel:
    """Temperature of least log-loss, and the threshold that rejects a small share of right answers.

    A little of the truth is spread over the other languages, as after one more error than was seen,
    so that scores stay below certainty when everything kept back is right.
    """
    logits = np.array([share @ model.table[used] for used, share, _ in bags]) + model.bias
    truth = np.array([y for *_, y in bags])
    grid = np.geomspace(0.02, 20, 100)
    spread = 1 / (len(truth) + 2)
    target = np.full(logits.shape, spread / max(1, logits.shape[1] - 1))
    target[np.arange(len(truth)), truth] = 1 - spread
    losses = [-(target * np.log(np.maximum(softmax(logits / t), 1e-12))).sum(axis=1).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    best = softmax(logits / model.temperature)
    right = best.max(axis=1)[best.argmax(axis=1) == truth]
    model.threshold = float(np.quantile(right, REJECTED)) if len(right) else 0.0
    return model


# ------------------------------------------------------------------ Spark


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """About ``rows`` labelled rows that may be learned from, chosen by a hash of their id and spread over languages.

    Each language gives an equal share, or all it has. Rows without text or language are not labelled.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    counts = labelled.groupBy("lang").count()
    shares = {r["lang"]: r["count"] for r in counts.orderBy(F.desc("count")).limit(rows).collect()}
    if not shares:
        return labelled.select("text", "lang").limit(0)
    each = rows / len(shares)
    scale = 1 << 40
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(scale))
    limits = F.create_map(*[F.lit(v) for lang, n in shares.items() for v in (lang, int(scale * min(1.0, each / n)))])
    return labelled.filter(draw < F.element_at(limits, F.col("lang"))).select("text", "lang")


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> LanguageModel:
    """A model of a bounded sample of ``docs`` (doc_id, text, lang)."""
    sample = sorted((r["lang"], r["text"]) for r in training_sample(docs, rows, seed).collect())
    return fit([t for _, t in sample], [y for y, _ in sample], seed=seed)


def predicted(text: str | Column, model: LanguageModel, spark) -> Column:
    """Struct column lang, score, rejected for a text."""
    sent = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_store("language")
        for batch in batches:
            rows = [sent.value.predict(t.as_py()) for t in batch]
            langs, scores, rejected = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"]
            )

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(predict, "lang string, score double, rejected boolean")(F.col(text) if isinstance(text, str) else text)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row.

    A text that is NULL or has no letter is ``und`` with score 0 and rejected; every other one gets
    the likeliest learned language, and ``rejected`` says that its score is below the calibrated
    threshold. Without anything to learn from all are ``und``. Only the text enters a prediction;
    rows are neither joined nor shuffled, and other columns are ignored.
    """
    model = model or train(docs)
    read = docs.select("doc_id", held_out("doc_id").alias("held_out"), predicted("text", model, docs.sparkSession).alias("p"))
    return read.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected")
