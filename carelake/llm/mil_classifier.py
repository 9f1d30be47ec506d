"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is encoded by measures of its
characters and words (nothing else: no label, language, source or id). A hidden layer encodes a
passage as h = tanh(Wx + b); its gated attention weight is the softmax over the bag of
w . (tanh(Vh) * sigmoid(Uh)); the document's score is the sigmoid of a linear form of the weighted
sum of h. All weights are learned from document labels by full-batch Adam.

Training takes at most ``SAMPLE_DOCS`` labelled documents outside the held-out fold (those with
the smallest hashes of their ids); of one with more than ``SAMPLE_PASSAGES`` passages as many at even distances, and of
rows that repeat an id one. That bounds what the driver gathers. Scoring covers all documents and whole texts, in the scan's task.

Cases: a null or empty text is one passage of zeros and gets a score. Repeated rows give one
result each. A null id is scored and never held out. A repeated label counts once, as its largest
value; null labels are ignored. Without labels, the score is 0.5; labels of one kind only train
towards that kind. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE_WORDS = 64
SAMPLE_DOCS = 4000
SAMPLE_PASSAGES = 256
THRESHOLD = 0.3
HIDDEN, GATE, STEPS, RATE, DECAY = 12, 8, 150, 0.03, 1e-4

# Classes of bytes: 0 lower case, 1 upper case, 2 digit, 3 white space, 4 symbol, 5 pause mark,
# 6 exclamation or question mark, 7 bar, 8 beyond ASCII, 9 line end, 10 the rest.
_CLASS = np.full(256, 10, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 8
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 9
_CLASS[np.frombuffer(b"#*$%&<>@^~=+_\\/{}[]", np.uint8)] = 4
_CLASS[np.frombuffer(b".,;:'\"()-", np.uint8)] = 5
_CLASS[np.frombuffer(b"!?", np.uint8)], _CLASS[124] = 6, 7
_N_CLASS = 11
N_FEATURES = _N_CLASS + 7
_MIX = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def encode_passages(raw: bytes, passage_words: int = PASSAGE_WORDS) -> np.ndarray:
    """One row of measures per passage of ``passage_words`` words; one row of zeros without words."""
    a = np.frombuffer(raw, np.uint8)
    cls = _CLASS[a]
    inside = (cls != 3) & (cls != 9)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if n == 0:
        return np.zeros((1, N_FEATURES), np.float32)
    k = (n + passage_words - 1) // passage_words
    word_passage = np.arange(n) // passage_words
    words = np.bincount(word_passage, minlength=k).astype(np.float64)
    cuts = starts[::passage_words].copy()
    cuts[0] = 0
    byte_passage = np.repeat(np.arange(k), np.diff(np.append(cuts, len(a))))
    share = np.bincount(byte_passage * _N_CLASS + cls, minlength=k * _N_CLASS).reshape(k, _N_CLASS).astype(np.float64)
    share /= share.sum(axis=1, keepdims=True)
    length = (ends - starts).astype(np.float64)
    mean = np.bincount(word_passage, length, k) / words
    spread = np.sqrt(np.maximum(np.bincount(word_passage, length**2, k) / words - mean**2, 0))
    # a hash per word: the sum of its mixed bytes by place
    place = np.arange(len(a)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(a)]))))
    mixed = (a.astype(np.uint64) + np.uint64(1)) * _MIX[place & 63] * inside
    h = np.add.reduceat(mixed, starts)
    order = np.lexsort((h, word_passage))
    first = np.ones(n, bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (word_passage[order][1:] != word_passage[order][:-1])
    distinct = np.bincount(word_passage[order], first, k) / words
    twin = np.zeros(n)
    twin[1:] = (h[1:] == h[:-1]) & (word_passage[1:] == word_passage[:-1])
    adjacent = np.bincount(word_passage, twin, k) / words
    capital = np.bincount(word_passage, cls[starts] == 1, k) / words
    brief = np.bincount(word_passage, length <= 3, k) / words
    return np.column_stack([share, mean / 10, spread / 10, distinct, adjacent, capital, brief,
                            np.log1p(words) / 5]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """x: standard passages of all bags in a row; starts: first passage of each bag."""
        w, sizes = self.w, np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * g) @ w["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        att = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(att[:, None] * h, starts)
        return {"bag": bag, "h": h, "t": t, "g": g, "att": att, "z": z, "p": _sigmoid(z @ w["c"] + w["d"][0])}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, starts)["p"]


def train(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3, steps: int = STEPS) -> Model:
    """Learn from bags of passages and their 0/1 labels."""
    r = np.random.default_rng(seed)
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((1, N_FEATURES))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    w = {"W": r.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, GATE)),
         "U": r.normal(0, 0.3, (HIDDEN, GATE)), "w": r.normal(0, 0.3, GATE), "c": np.zeros(HIDDEN), "d": np.zeros(1)}
    model = Model(mean, scale, w)
    if not bags:
        return model
    x, y = (x - mean) / scale, np.asarray(labels, np.float64)
    starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        f = model.forward(x, starts)
        dp = (f["p"] - y) / len(y)  # of the log loss by the logit
        dz = dp[:, None] * w["c"]
        along = (dz[f["bag"]] * f["h"]).sum(axis=1)
        de = f["att"] * (along - np.add.reduceat(f["att"] * along, starts)[f["bag"]])
        dt = de[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * w["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["att"][:, None] * dz[f["bag"]] + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
        grad = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dp, "d": np.array([dp.sum()])}
        for k, g in grad.items():
            g = g + DECAY * w[k]
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            w[k] -= RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_docs: int = SAMPLE_DOCS,
        sample_passages: int = SAMPLE_PASSAGES) -> Model:
    """Train on a bounded sample of labelled documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("__id"), F.col(label_col).cast("int").alias("__y"))
    known = (known.where(F.col("__id").isNotNull() & F.col("__y").isNotNull() & ~held_out(F.col("__id")))
             .groupBy("__id").agg(F.max("__y").alias("__y"))
             .orderBy(F.xxhash64("__id"), "__id").limit(sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = [encode_passages(t.as_py() or b"") for t in b.column(1).cast(pa.binary())]
            # of a longer document, passages at even distances from its first to its last
            bags = [x[np.linspace(0, len(x) - 1, sample_passages).astype(int)] if len(x) > sample_passages else x for x in bags]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([x.tobytes() for x in bags], pa.binary())], names=["id", "y", "bag"])

    rows = (docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("text").alias("__text"))
            .join(F.broadcast(known), "__id").select("__id", "__text", "__y")
            .mapInArrow(run, "id bigint, y int, bag binary")
            .groupBy("id").agg(F.max("y").alias("y"), F.min("bag").alias("bag")).collect())  # one row of a repeated id
    rows.sort(key=lambda r: (r["id"], r["y"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    return train(bags, np.array([1.0 if r["y"] > 0 else 0.0 for r in rows]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.score([encode_passages(t.as_py() or b"") for t in b.column(1).cast(pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    got = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id bigint, score double, predicted int")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
