"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded by
a small layer over its features; a gated attention, tanh of one projection times the
sigmoid of another, weighs the passages; the score is a logistic function of the weighted
sum of their encodings. It is trained on the driver from a bounded sample of labelled
documents; scoring reads every passage of every document.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import documents, field_list, with_column, with_row_hash

THRESHOLD = 0.3
PASSAGE_WORDS = 64
#: Bound of the training sample: labelled documents, each with all its passages.
TRAIN_DOCUMENTS = 4_000
FOLDS = 5
HIDDEN = 16
GATE = 8
EPOCHS = 250

# Classes of characters; anything else is a letter of another script or a sign.
CLASSES = ("lower", "upper", "digit", "space", "stop", "comma", "bang", "bar", "sign", "other")
STOPS, COMMAS = ".:;?", ",-'\""


def class_table() -> np.ndarray:
    """Class of each code point below 0x250; the last entry stands for the rest."""
    table = np.full(0x251, CLASSES.index("other"), np.uint8)
    for i in range(0x250):
        c = chr(i)
        kind = "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "space" if c.isspace() else None
        kind = kind or ("stop" if c in STOPS else "comma" if c in COMMAS else "bang" if c == "!" else "bar" if c == "|" else "sign" if i < 0x7F else "other")
        table[i] = CLASSES.index(kind)
    return table


N_FEATURES = len(CLASSES) + 6


def passage_features(words: list[str], table: np.ndarray) -> list[float]:
    text = " ".join(words)
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0x250)
    share = np.bincount(table[points], minlength=len(CLASSES)) / max(1, len(points))
    n = max(1, len(words))
    own = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [*share.tolist(), len(own) / n, again / n, max(own.values(), default=0) / n, min(2.0, len(text) / n / 10), sum(not w.isalpha() for w in own) / n, n / PASSAGE_WORDS]


def bag(text: str, table: np.ndarray) -> np.ndarray:
    """Features by passage; an empty text is one empty passage."""
    words = text.split()
    return np.array([passage_features(words[s : s + PASSAGE_WORDS], table) for s in range(0, max(1, len(words)), PASSAGE_WORDS)], np.float64)


class Model:
    """Parameters by name; every method takes passages as rows and the first row of each bag."""

    def __init__(self, mean, scale, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.w = mean, scale, weights

    @staticmethod
    def start(x: np.ndarray) -> "Model":
        r = np.random.default_rng(7)
        f = x.shape[1]
        shapes = {"E": (f, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "c0": (1,)}
        return Model(x.mean(0), x.std(0) + 1e-6, {k: r.normal(0, 0.3, s) * (k not in ("e", "c0")) for k, s in shapes.items()})

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        w = self.w
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (v * u) @ w["a"]
        sizes = np.diff(np.append(first, len(x)))
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, first), sizes))
        attention = s / np.repeat(np.add.reduceat(s, first), sizes)
        z = np.add.reduceat(attention[:, None] * h, first)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["c0"], -30, 30)))
        return {"x": x, "h": h, "v": v, "u": u, "attention": attention, "sizes": sizes, "z": z, "p": p}

    def gradients(self, t: dict, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        d = (t["p"] - y) / len(y)
        dz = np.repeat(d[:, None] * w["c"], t["sizes"], axis=0)
        da = (dz * t["h"]).sum(1)
        ds = t["attention"] * (da - np.repeat(np.add.reduceat(t["attention"] * da, first), t["sizes"]))
        gate = ds[:, None] * w["a"]
        dv, du = gate * t["u"] * (1 - t["v"] ** 2), gate * t["v"] * t["u"] * (1 - t["u"])
        dh = (dz * t["attention"][:, None] + dv @ w["V"].T + du @ w["U"].T) * (1 - t["h"] ** 2)
        return {"E": t["x"].T @ dh, "e": dh.sum(0), "V": t["h"].T @ dv, "U": t["h"].T @ du, "a": (t["v"] * t["u"]).T @ ds, "c": t["z"].T @ d, "c0": d.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    x = np.concatenate(bags)
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1])).astype(np.int64)
    model = Model.start(x)
    m, v = ({k: np.zeros_like(a) for k, a in model.w.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        for k, g in model.gradients(model.forward(x, first), first, labels).items():
            g = g + 1e-4 * model.w[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
            model.w[k] -= 0.03 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, n: int = TRAIN_DOCUMENTS) -> Model | float:
    """A model of labels.quality, from at most n labelled documents outside the held-out fold, picked by a
    hash of doc_id. A document with several labels has the one that most of them give, 1 on a tie. Of rows that
    repeat a doc_id the text with the smallest hash teaches. Null ids and labels teach nothing. Without
    documents of both labels, the score that all documents get."""
    sample = labels.filter("doc_id is not null and quality is not null").filter(~held_out())
    sample = sample.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)  # n rows: small enough to broadcast
    table = class_table()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "label"]].assign(bag=[bag(t, table).ravel() for t in batch["text"]])

    texts = with_row_hash(documents(docs)).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", "row_hash").alias("text"))
    rows = texts.mapInPandas(encode, "doc_id bigint, label double, bag array<double>").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows])
    if len(set(y)) < 2:
        return float(y[0]) if len(y) else 1.0
    return fit([np.array(r["bag"]).reshape(-1, N_FEATURES) for r in rows], y)


def score_quality(docs: DataFrame, model: Model | float, *extra: str) -> DataFrame:
    """doc_id, score for every row of docs (doc_id, text), empty and null texts too, and the named extra columns."""
    table = class_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if isinstance(model, float):
                scores = np.full(len(texts), model)
            else:
                bags = [bag(t, table) for t in texts]
                first = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1])).astype(np.int64)
                scores = model.forward(np.concatenate(bags), first)["p"]
            yield with_column(batch.drop_columns(["text"]), "score", scores, pa.float64())

    d = documents(docs, *extra)
    return d.mapInArrow(run, f"{field_list(d, 'text')}, score double")
