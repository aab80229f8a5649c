"""Language ID (operator 6): averaged hashed subword embeddings with a linear softmax.

A text's subwords are the runs of one to three letters of its words, the edge
of a word counting as a letter; each is hashed into one of ``BUCKETS`` rows of
an embedding table.  The mean embedding goes through a linear softmax.  Table
and softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of the labelled documents (``sample`` of them, about equally
many of each language).  A fifth of the sample is kept back: on it the
softmax's temperature is fitted, and what is rejected.  Predictions read whole
texts.

A prediction is rejected if no language is likely enough, or if the text's
subwords are not those of the languages it is said to be in.  The second does
not depend on how many languages are learned: ``familiarity`` is the mean log
probability of the subwords under the predicted mixture of the languages'
subword frequencies, plus the entropy of the likeliest one, so texts of learned
languages lie about zero.  The least familiarity is fitted between right
predictions and negatives: the texts of each language with that language left
out, and texts with their letters shuffled.

Input cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected; so is every text if nothing is labelled; rows without a language
teach nothing; a null doc_id is never held out and teaches nothing; repeated
rows get the same result; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm.common import slices, table, with_python
from webledger.llm.pretoken import LETTER, classes, parts

BUCKETS, WIDTH = 4096, 16
#: Labelled documents that are fitted on, about.
SAMPLE = 4000
#: Characters of the short excerpt that each of them also gives, so that short texts are learned and calibrated too.
EXCERPT = 60
#: Share of right, whole calibration texts that may be rejected, and the confidence that is always enough:
#: a text in two languages by halves stays, one that is as much of three or of none goes.
MAY_REJECT, ENOUGH = 0.001, 0.4
#: Share of the negatives that the least familiarity is fitted to reject.
REJECTED = 0.95
UNKNOWN = "und"


def subword_counts(text: str) -> np.ndarray:
    """How often each bucket's subwords occur in ``text``; all zero without a letter."""
    out = np.zeros(BUCKETS, np.int64)
    for part in parts(text.lower()):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = classes()[points] == LETTER
        if not letter.any():
            continue
        code = np.zeros(len(points) + 2, np.uint32)
        code[1:-1] = np.where(letter, points, 0)
        # One word edge between words, whatever stands there.
        code = code[np.append(True, (code[1:] != 0) | (code[:-1] != 0))]
        inside = code != 0
        one = code * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + code[1:] * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + code[2:] * np.uint32(0x165667B1)
        for h, whole in ((one, inside), (two, inside[:-1] | inside[1:]), (three, inside[1:-1])):
            h = h[whole]
            out += np.bincount((h ^ (h >> np.uint32(16))) * np.uint32(0x9E3779B1) >> np.uint32(20), minlength=BUCKETS)
    return out


@dataclass
class Model:
    """``weights[b]`` is bucket b's embedding times the softmax's matrix: the
    mean over subwords of these, plus ``bias``, gives the logits."""

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    #: Frequency of each bucket in each language, and the least familiarity of a text that is not rejected.
    frequencies: np.ndarray | None = None
    least: float = -np.inf

    def familiarity(self, counts: np.ndarray, p: np.ndarray) -> float:
        """How much a text with these subword counts is made of the subwords of
        the languages that ``p`` mixes; about zero for a text of one of them."""
        seen = np.flatnonzero(counts)
        own = self.frequencies[int(p.argmax())]
        return float(counts[seen] @ np.log(p @ self.frequencies[:, seen]) / counts.sum() - own @ np.log(own))

    def confidences(self, x: np.ndarray) -> np.ndarray:
        return softmax((x @ self.weights + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated confidence, and whether to reject."""
        counts = subword_counts(text or "")
        total = counts.sum()
        if not total or not self.langs:
            return UNKNOWN, 0.0, True
        p = self.confidences(counts / total)
        best = int(p.argmax())
        strange = self.frequencies is not None and self.familiarity(counts, p) < self.least
        return self.langs[best], float(p[best]), bool(strange or p[best] < self.reject_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Sparse:
    """Rows of mean subword counts of which only what is not zero is held."""

    def __init__(self, rows: list[bytes]) -> None:
        size = np.array([len(r) // 4 for r in rows], np.int64)
        self.ends = np.append(0, np.cumsum(size))
        self.bucket = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(r, np.uint16, n) for r, n in zip(rows, size.tolist(), strict=True))])
        self.mean = np.concatenate([np.zeros(0, np.float16), *(np.frombuffer(r, np.float16, n, 2 * n) for r, n in zip(rows, size.tolist(), strict=True))])

    @staticmethod
    def packed(counts: np.ndarray) -> bytes:
        at = np.flatnonzero(counts)
        return at.astype(np.uint16).tobytes() + (counts[at] / max(1, counts.sum())).astype(np.float16).tobytes()

    def some(self) -> np.ndarray:
        """Which rows are not all zero."""
        return np.diff(self.ends) > 0

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS))
        for i, r in enumerate(rows.tolist()):
            a, b = self.ends[r], self.ends[r + 1]
            out[i, self.bucket[a:b]] = self.mean[a:b]
        return out

    def logits(self, rows: np.ndarray, model: Model) -> np.ndarray:
        parts_ = [self.dense(rows[at : at + 256]) @ model.weights + model.bias for at in range(0, len(rows), 256)]
        return np.concatenate([np.zeros((0, len(model.langs))), *parts_])

    def sums(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(BUCKETS)
        for at in range(0, len(rows), 256):
            out += self.dense(rows[at : at + 256]).sum(axis=0)
        return out


def fit(x: Sparse, rows: np.ndarray, y: np.ndarray, classes_: int, epochs: int = 40, batch: int = 32, rate: float = 30.0) -> tuple[np.ndarray, np.ndarray]:
    """Embedding table times matrix, and bias, by stochastic gradient descent
    on some ``rows`` of x, with languages ``y``."""
    rng = np.random.default_rng(0)
    table_ = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    matrix, bias = rng.uniform(-1 / WIDTH, 1 / WIDTH, (WIDTH, classes_)), np.zeros(classes_)
    steps, step = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at : at + batch]
            xs = x.dense(rows[some])
            seen = np.flatnonzero(xs.any(axis=0))  # only these rows of the table change
            xs = xs[:, seen]
            hidden = xs @ table_[seen]
            off = softmax(hidden @ matrix + bias)
            off[np.arange(len(some)), y[some]] -= 1
            off /= len(some)
            lr = rate * (1 - step / steps)
            back = off @ matrix.T
            matrix -= lr / 10 * hidden.T @ off
            bias -= lr / 100 * off.sum(axis=0)
            table_[seen] -= lr * xs.T @ back
            step += 1
    return table_ @ matrix, bias


def calibrated(model: Model, x: Sparse, rows: np.ndarray, y: np.ndarray, whole: np.ndarray) -> Model:
    """Fits the temperature, then the confidence to reject below, on ``rows`` that weren't trained on."""
    if not len(rows):
        return model
    z = x.logits(rows, model)
    loss = {t: -np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in np.geomspace(0.25, 8, 41)}
    model.temperature = float(min(loss, key=loss.get))
    p = softmax(z / model.temperature)
    right = whole & (p.argmax(axis=1) == y)
    if right.any():
        model.reject_below = float(min(ENOUGH, np.quantile(p[right].max(axis=1), MAY_REJECT)))
    return model


def frequencies(x: Sparse, rows: np.ndarray, y: np.ndarray, langs: int) -> np.ndarray:
    """How often each language has each bucket's subwords, none never."""
    sums = np.stack([x.sums(rows[y == k]) for k in range(langs)])
    return (sums + 1e-4) / (sums + 1e-4).sum(axis=1, keepdims=True)


def familiarities(model: Model, x: Sparse, rows: np.ndarray) -> list[float]:
    p = softmax(x.logits(rows, model) / model.temperature)
    return [model.familiarity(x.dense(rows[i : i + 1])[0], q) for i, q in enumerate(p)]


def with_negatives(model: Model, x: Sparse, rows: np.ndarray, y: np.ndarray, whole: np.ndarray, shuffled: np.ndarray) -> Model:
    """Fits the least familiarity on rows that weren't trained on: between what right
    predictions have, whole or short, and what the negatives have."""
    right = x.logits(rows, model).argmax(axis=1) == y if len(rows) else np.zeros(0, bool)
    good = [familiarities(model, x, rows[some]) for some in (right & whole, right & ~whole) if some.any()]
    if not good:
        return model
    bad = familiarities(model, x, shuffled)
    for k in range(len(model.langs)) if len(model.langs) > 1 else ():
        others = [i for i in range(len(model.langs)) if i != k]
        less = Model([model.langs[i] for i in others], model.weights[:, others], model.bias[others], model.temperature, 0.0, model.frequencies[others])
        bad += familiarities(less, x, rows[(y == k) & whole])
    low = float(min(np.quantile(g, MAY_REJECT) for g in good))
    model.least = min(low, (low + float(np.quantile(bad, REJECTED))) / 2) if bad else low
    return model


def shuffled_letters(text: str, seed: int) -> str:
    """``text`` with its letters dealt anew over the places of letters."""
    at = [i for i, c in enumerate(text) if c.isalpha()]
    out, order = list(text), np.random.default_rng(seed).permutation(len(at)).tolist()
    for i, k in zip(at, order, strict=True):
        out[i] = text[at[k]]
    return "".join(out)


def is_held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from text and language of documents that aren't held out."""
    labelled = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~is_held_out()
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    langs = sorted(counts)
    each = -(-sample // len(langs))
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1_000_000))
    chosen = F.lit(False)
    for lang in langs:
        chosen = chosen | ((F.col("lang") == lang) & (place < int(1_000_000 * min(1, each / counts[lang]))))
    schema = "doc_id long, lang string, fold int, whole binary, short binary, shuffled binary"

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.to_pydict()
            whole, short, shuffled = [], [], []
            for doc, text, fold in zip(rows["doc_id"], rows["text"], rows["fold"], strict=True):
                at = doc * 7919 % max(1, len(text) - EXCERPT)
                mixed = shuffled_letters(text, doc % 2**32) if fold == 0 else None
                for out, t in ((whole, text), (short, text[at : at + EXCERPT]), (shuffled, mixed)):
                    out.append(None if t is None else Sparse.packed(subword_counts(t)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows["doc_id"], "lang": rows["lang"], "fold": pa.array(rows["fold"], pa.int32()), "whole": whole, "short": short, "shuffled": pa.array(shuffled, pa.binary()),
            })

    rows = (
        with_python(labelled).where(chosen).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(5)).cast("int"))
        .limit(2 * each * len(langs))
        .mapInArrow(features, schema).toArrow().combine_chunks()
    )
    return model_of(rows, langs)


def model_of(rows: pa.Table, langs: list[str]) -> Model:
    """A model from the features of labelled rows, in an order of their own."""
    whole, short = rows["whole"].to_pylist(), rows["short"].to_pylist()
    lang, doc, fold = np.array([langs.index(g) for g in rows["lang"].to_pylist()], np.int64), rows["doc_id"].to_numpy(), rows["fold"].to_numpy()
    order = np.lexsort((np.array([xxhash.xxh64_intdigest(w) for w in whole], np.uint64), lang, doc))
    n, shuffled = len(whole), [r for r in rows["shuffled"].to_pylist() if r]
    x = Sparse([*(whole[i] for i in order), *(short[i] for i in order), *shuffled])
    y, fold = np.tile(lang[order], 2), np.tile(fold[order], 2)
    some = x.some()[: 2 * n]
    train, test = np.flatnonzero(some & (fold > 0)), np.flatnonzero(some & (fold == 0))
    if not len(train):
        train, test = np.flatnonzero(some), train
    weights, bias = fit(x, train, y[train], len(langs))
    is_whole = train[train < n]
    model = Model(langs, weights, bias, frequencies=frequencies(x, is_whole, y[is_whole], len(langs)))
    model = calibrated(model, x, test, y[test], test < n)
    return with_negatives(model, x, test, y[test], test < n, np.arange(2 * n, 2 * n + len(shuffled)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return (
        with_python(docs).select(F.col("doc_id").cast("long"), is_held_out().alias("held_out"), F.col("text").cast("string"))
        .mapInArrow(run, schema)
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not model.predict(t)[2] for t in batch.column("text").to_pylist()], pa.bool_()))

    return with_python(docs).mapInArrow(run, docs.schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
