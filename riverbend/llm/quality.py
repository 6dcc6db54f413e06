"""Quality by gated-attention multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, its whole text.  Every
passage is encoded by what its characters and words look like (shares of
letter cases, digits, marks, repeats and so on), then by a learned layer.
The label belongs to the document only; gated attention learns which
passages tell it (``a = softmax(w . (tanh(V h) * sigmoid(U h)))``), and the
weighted passage vector is scored by a logistic layer.

The model is fitted on at most ``EXAMPLES`` labelled documents by full-batch
Adam with numpy, and has a few thousand numbers; scoring is one pass over
the texts in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm.common import as_bytes, fit_sample, held_out, small_batches
from riverbend.session import release, save

#: Labelled documents that are learned from, at most; longer ones than so many passages are left out of the fit.
EXAMPLES, FIT_PASSAGES = 6_000, 400
PASSAGE = 64
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY = 250, 0.02, 1e-4

#: Classes of bytes: a passage is described by the share of each.
_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "end": b".", "comma": b",;:",
            "shout": b"!?", "table": b"|\t", "symbol": b"#$%&*+<=>@\\^_`{}~/[]", "quote": b"\"'()-", "line": b"\n\r\x0b\x0c", "space": b" "}
_CLASS = np.full(256, len(_CLASSES), np.int64)  # last: control and non-ASCII bytes
for _n, _bytes in enumerate(_CLASSES.values()):
    _CLASS[list(_bytes)] = _n
_N_CLASSES = len(_CLASSES) + 1
N_FEATURES = _N_CLASSES + 7


def encode(text: bytes) -> np.ndarray:
    """One row of features for each passage; one row of zeros for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros((1, N_FEATURES))
    size = -(-n // PASSAGE)
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | (data >= 9) & (data <= 13)
    begins = ~blank & np.concatenate(([True], blank[:-1]))
    passage = np.maximum(np.cumsum(begins) - 1, 0) // PASSAGE
    shares = np.bincount(passage * _N_CLASSES + _CLASS[data], minlength=size * _N_CLASSES).reshape(size, -1).astype(float)
    total = shares.sum(axis=1)
    out = np.empty((size, N_FEATURES))
    out[:, :_N_CLASSES] = np.sqrt(shares / total[:, None])
    counts = np.full(size, PASSAGE)
    counts[-1] = n - PASSAGE * (size - 1)
    seen: set[bytes] = set()
    for p in range(size):
        own = words[p * PASSAGE:(p + 1) * PASSAGE]
        distinct = set(own)
        out[p, _N_CLASSES] = len(distinct) / len(own)
        out[p, _N_CLASSES + 1] = len(distinct - seen) / len(distinct)  # new to the document
        out[p, _N_CLASSES + 2] = sum(a == b for a, b in zip(own, own[1:], strict=False)) / len(own)
        seen |= distinct
    out[:, _N_CLASSES + 3] = np.log(total / counts)
    out[:, _N_CLASSES + 4] = counts / PASSAGE
    out[:, _N_CLASSES + 5] = np.log1p(n) / 10
    out[:, _N_CLASSES + 6] = np.log1p(size) / 5
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """Weights: encoder E, e; gate V, U, w; output c, b."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 0, steps: int = STEPS):
        self.prior = float((labels.sum() + 1) / (len(labels) + 2))
        x = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng = np.random.default_rng(seed)
        f = N_FEATURES
        self.weights = {"E": rng.normal(0, f**-0.5, (f, HIDDEN)), "e": np.zeros(HIDDEN), "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
                        "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "w": rng.normal(0, GATE**-0.5, GATE), "c": np.zeros(HIDDEN),
                        "b": np.array(np.log(self.prior / (1 - self.prior)))}
        self.learned = len(set(labels.tolist())) == 2
        if self.learned:
            self._fit(bags, labels.astype(float), steps)

    def _forward(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        m = self.weights
        h = np.tanh((x - self.mean) / self.scale @ m["E"] + m["e"])
        t, s = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
        g = (t * s) @ m["w"]
        g = np.exp(g - np.repeat(np.maximum.reduceat(g, starts), sizes))
        a = g / np.repeat(np.add.reduceat(g, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ m["c"] + m["b"])}

    def _gradients(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        m, r = self.weights, self._forward(x, starts, sizes)
        h, t, s, a = r["h"], r["t"], r["s"], r["a"]
        d = (r["p"] - labels) / len(labels)
        dz = np.repeat(d, sizes)[:, None] * m["c"]
        da = (dz * h).sum(axis=1)
        dg = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dt, ds = dg[:, None] * m["w"] * s * (1 - t * t), dg[:, None] * m["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ m["V"].T + ds @ m["U"].T) * (1 - h * h)
        return {"E": ((x - self.mean) / self.scale).T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ dg,
                "c": r["z"].T @ d, "b": d.sum()}

    def _fit(self, bags: list[np.ndarray], labels: np.ndarray, steps: int) -> None:
        sizes = np.array([len(b) for b in bags])
        starts, x = np.concatenate(([0], np.cumsum(sizes)[:-1])), np.concatenate(bags)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in self._gradients(x, starts, sizes, labels).items():
                g = g + DECAY * self.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.weights[k] = self.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document and the attention weight of every passage."""
        sizes = np.array([len(b) for b in bags], np.int64)
        if not self.learned or not bags:
            return np.full(len(bags), self.prior), np.repeat(1 / np.maximum(sizes, 1), sizes)
        r = self._forward(np.concatenate(bags), np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return r["p"], r["a"]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        examples: int = EXAMPLES, modulus: int = 4, remainder: int = 2) -> AttentionModel:
    """Learns from labelled rows that are not held out.  Without both labels
    every score is the share of label 1 (one half without any label)."""
    small_batches(docs.sparkSession)
    sample, path = save(fit_sample(docs, labels, label_col, lambda c: ~held_out(c, modulus, remainder), examples, id_col, text_col), "quality-fit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encode(t) for t in as_bytes(batch.column("text"))]
            kept = [len(b) <= FIT_PASSAGES for b in bags]
            own = pa.array([b.astype(np.float32).tobytes() if k else None for b, k in zip(bags, kept, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), own], names=["id", "label", "bag"])

    found = sample.mapInArrow(run, "id long, label int, bag binary").where("bag is not null").orderBy("id").collect()  # bounded by `examples`
    release(docs.sparkSession, path)
    bags = [np.frombuffer(bytes(r.bag), np.float32).reshape(-1, N_FEATURES).astype(float) for r in found]
    return AttentionModel(bags, np.array([r.label for r in found]))


def score(text: Column, model: AttentionModel) -> Column:
    """Score of each text, 0 to 1.  Null counts as empty: one passage of zeros."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        own = as_bytes(texts)
        for lo in range(0, len(own), 64):
            out.append(sent.value.score([encode(t) for t in own[lo:lo + 64]])[0])
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return run(text)


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of ``op3_quality``: one row for each row of ``docs``."""
    model = fit(docs, labels)
    out = docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
