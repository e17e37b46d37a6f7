"""Quality classifier by attention over passages (multiple-instance learning).

A document is a bag of passages of `PASSAGE` words, the last one shorter. Each passage is described
by what its characters and words look like and encoded by a hidden layer. Gated attention,
softmax of w . (tanh(V h) * sigmoid(U h)), weights the passages; the weighted sum of their encodings
is scored by a logistic output. Everything is learned together, from labels of documents alone.

The model is fitted on the driver on a bounded sample, those `most` (`SAMPLE`) of the labelled
documents that are there whose ids hash lowest, with all their passages: a few bytes per word. Scoring
takes every passage of every text, in one pass without a shuffle.

Defined cases: a null or empty text is one passage without words. Rows whose label is null or not 0
or 1 teach nothing; of several labels of an id the lowest counts. Without labels of both kinds every
text scores the share of ones, and 0.5 where there are no labels. Repeated rows score alike, and teach
once per id. Very long texts are described in pieces. An empty table gives no rows. Other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.batches import bounded, extended, pieces, utf8

PASSAGE = 64
SAMPLE = 3000

# ---- passages --------------------------------------------------------------------------------

_CLASSES = {
    "blank": b" \t", "line": b"\n\r", "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)),
    "digit": b"0123456789", "stop": b".!?", "pause": b",;:", "exclaim": b"!",
    "symbol": b"#$%&*+/<=>@\\^_`{|}~", "bar": b"|", "bracket": b"()[]{}<>\"'",
    "beyond": bytes(range(128, 256)), "control": bytes([*range(0, 9), *range(14, 32), 127]),
}
_IN_CLASS = np.zeros((len(_CLASSES), 256), np.uint8)
for _row, _members in zip(_IN_CLASS, _CLASSES.values()):
    _row[list(_members)] = 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15 | 1, np.uint64), dtype=np.uint64)
FEATURES = len(_CLASSES) + 11


SLICE = 1 << 20  # bytes described at once; a single passage may be longer


def passages(text: bytes) -> np.ndarray:
    """One row of features per passage; a text without words has one row."""
    raw = np.frombuffer(text, np.uint8)
    # First byte of each word, and the byte after its last.
    edges = np.flatnonzero(np.diff(~_SPACE[raw], prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        out = np.zeros((1, FEATURES))
        out[0, -1] = 1
        return out
    bounds = np.append(starts[::PASSAGE], len(raw))
    bounds[0] = 0
    parts, first = [], 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE, "right")) - 1)
        own = slice(first * PASSAGE, last * PASSAGE)
        a, b = bounds[first], bounds[last]
        parts.append(_described(raw[a:b], starts[own] - a, stops[own] - a))
        first = last
    return np.concatenate(parts)


def _described(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The features of some passages of whole words."""
    n = -(-len(starts) // PASSAGE)
    out = np.zeros((n, FEATURES))
    first = starts[::PASSAGE].copy()
    first[0] = 0
    counts = np.diff([*first, len(raw)]).astype(float)
    for i, members in enumerate(_IN_CLASS):
        out[:, i] = np.add.reduceat(members[raw], first, dtype=np.int64) / counts
    # A number per word: a polynomial over its bytes.
    value = (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[_places(starts, len(raw)) & 255]
    value[_SPACE[raw]] = 0
    word = np.add.reduceat(value, starts)
    word ^= word >> np.uint64(29)
    of = np.arange(len(word)) // PASSAGE
    heads = np.arange(0, len(word), PASSAGE)
    words = np.bincount(of, minlength=n).astype(float)
    length = (stops - starts).astype(float)
    mean = np.bincount(of, length, n) / words
    same = np.zeros(len(word), bool)
    same[1:] = word[1:] == word[:-1]
    same[heads] = False
    order = np.lexsort((word, of))
    w, o = word[order], of[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    runs = np.diff(np.flatnonzero(np.append(new, True)))
    most = np.maximum.reduceat(runs, np.searchsorted(o[new], np.arange(n)))
    # The last byte of a word tells commas and stops, the first a capital.
    end, start = raw[stops - 1], raw[starts]
    k = len(_CLASSES)
    out[:, k] = np.log1p(words)
    out[:, k + 1] = mean / 10
    out[:, k + 2] = np.sqrt(np.maximum(np.bincount(of, length**2, n) / words - mean**2, 0)) / 10
    out[:, k + 3] = np.log1p(np.maximum.reduceat(length, heads)) / 5
    out[:, k + 4] = np.bincount(of, same, n) / words
    out[:, k + 5] = np.bincount(o[new], minlength=n) / words
    out[:, k + 6] = most / words
    out[:, k + 7] = np.bincount(of, _IN_CLASS[3][start], n) / words
    out[:, k + 8] = np.bincount(of, _IN_CLASS[5][end], n) / words
    out[:, k + 9] = np.bincount(of, _IN_CLASS[8][end] | _IN_CLASS[7][end], n) / words
    return out


def _places(starts: np.ndarray, size: int) -> np.ndarray:
    """Each byte's distance from the start of its word; 0 before the first word."""
    place = np.zeros(size, np.int64)
    place[starts[0]:] = np.arange(starts[0], size) - np.repeat(
        starts, np.diff([*starts, size])
    )
    return place


# ---- model -----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Of bags of passages that begin at `firsts`."""
        return _forward(self.weights, self.normal(features), firsts)["score"]

    def normal(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.spread, -8, 8)


def _forward(p: dict, x: np.ndarray, firsts: np.ndarray) -> dict:
    sizes = np.diff([*firsts, len(x)])
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, firsts), sizes))
    a = e / np.repeat(np.add.reduceat(e, firsts), sizes)
    z = np.add.reduceat(a[:, None] * h, firsts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes,
            "score": _sigmoid(z @ p["c"] + p["d"])}


def _gradients(p: dict, x: np.ndarray, firsts: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(p, x, firsts)
    h, t, g, a = f["h"], f["t"], f["g"], f["a"]
    out = (f["score"] - y) / len(y)
    dz = np.repeat(out[:, None] * p["c"], f["sizes"], axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, firsts), f["sizes"]))
    dt, dg = de[:, None] * p["w"] * g, de[:, None] * p["w"] * t
    dV, dU = dt * (1 - t**2), dg * g * (1 - g)
    dh = (a[:, None] * dz + dV @ p["V"].T + dU @ p["U"].T) * (1 - h**2)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dV, "U": h.T @ dU,
            "w": (t * g).T @ de, "c": f["z"].T @ out, "d": out.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gates: int = 12,
        steps: int = 150, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the mean log loss, all bags at a time."""
    x = np.concatenate(bags)
    firsts = np.cumsum([0, *map(len, bags)])[:-1]
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-6, {})
    x = model.normal(x)
    rng = np.random.default_rng(seed)
    p = {
        "W": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), "b": np.zeros(hidden),
        "V": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "U": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "w": rng.normal(0, gates**-0.5, gates), "c": rng.normal(0, hidden**-0.5, hidden),
        "d": np.zeros(1),
    }
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    for step in range(1, steps + 1):
        slope = _gradients(p, x, firsts, labels)
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            grad = slope[k] + decay * p[k]
            m[k] += 0.1 * (grad - m[k])
            v[k] += 0.001 * (grad**2 - v[k])
            p[k] -= pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model.weights = p
    return model


# ---- on Spark --------------------------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    """0 to 4 by the id's CRC-32; 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in pieces(batch, batch["text"]):
            bags = []
            for text in utf8(texts):
                bags.append(passages(text).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows["id"], rows["quality"], pa.array(bags, pa.binary())],
                names=["id", "quality", "bag"],
            )


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", most: int = SAMPLE) -> Model | float:
    """A model, or the constant score where the labels are of one kind."""
    bounded(docs.sparkSession)
    marked = labels.select(
        F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("quality")
    ).filter((fold(F.col("id")) != 0) & F.col("quality").isin(0, 1) & F.col("id").isNotNull())
    marked = marked.groupBy("id").agg(F.min("quality").alias("quality"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # Of the labelled ids that are there, at most `most` rows of two numbers: their broadcast has a
    # fixed bound.
    marked = marked.join(texts.select("id").distinct(), "id", "left_semi")
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(most)
    # A repeated id stands for one text, the same on each run.
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "quality").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    ).select("id", "quality", "least.text")
    rows = sample.select("id", "quality", "text").mapInArrow(
        _sampled, "id long, quality int, bag binary"
    )
    rows = sorted(rows.collect())
    y = np.array([r.quality for r in rows], float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return fit([np.frombuffer(r.bag).reshape(-1, FEATURES) for r in rows], y)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, texts in pieces(batch, batch["text"]):
                if isinstance(model, float):
                    found = np.full(len(rows), model)
                else:
                    bags = [passages(t) for t in utf8(texts)]
                    firsts = np.cumsum([0, *map(len, bags)])[:-1]
                    found = model.scores(np.concatenate(bags), firsts)
                yield pa.RecordBatch.from_arrays(
                    [rows["row"], rows["text"], pa.array(found, pa.float64())],
                    names=["row", "text", "score"],
                )

    return run


def score(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """`row` (the other columns), `text` and `score`, 0 to 1."""
    bounded(docs.sparkSession)
    rows = docs.select(
        F.struct(
            F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in docs.columns if c != text]
        ).alias("row"),
        F.col(f"`{text}`").alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scored(shared), extended(rows.schema, "score double"))


def report(docs: DataFrame, labels: DataFrame, least: float = 0.3, doc_id: str = "doc_id",
           text: str = "text", most: int = SAMPLE) -> DataFrame:
    model = train(docs, labels, doc_id, text, most=most)
    rows = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return rows.select(
        "row.doc_id", (fold(F.col("row.doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, doc_id: str = "doc_id",
              text: str = "text", most: int = SAMPLE) -> DataFrame:
    """The documents that score `least` or more; columns stay as they are."""
    model = train(docs, labels, doc_id, text, most=most)
    rows = score(docs, model, text).filter(F.col("score") >= least)
    return rows.select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    )
