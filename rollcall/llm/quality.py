"""Quality classifier: attention-based multiple-instance learning in numpy.

A document is a bag of passages of ``PASSAGE`` bytes.  Every passage of the
whole text becomes a feature vector (byte frequencies, and for each distance
up to ``LAGS`` how often a byte recurs at that distance, which shows repeated
words).  The network encodes passages, learns gated attention weights for them
from document labels alone, and scores the weighted sum of the encodings.

Learning uses a bounded sample: ``max_documents`` labelled documents (the
smallest hashes of doc_id) and at most ``passages_each`` evenly spaced
passages of each.  Scoring reads every passage.

Edge cases: null and empty texts are one passage of zeros and get a score;
rows of ``labels`` with null doc_id or quality are not learned from; with no
usable label every score is 0.5; equal texts get equal scores; repeated rows
and extra columns change nothing in a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, text_bytes

PASSAGE, LAGS, HIDDEN, ATTENTION = 512, 24, 32, 16
FEATURES = 256 + LAGS + 2
#: passages that are encoded together
CHUNK = 2048


def passages(data: bytes) -> np.ndarray:
    """``(passages, FEATURES)`` of one text."""
    n = max(1, -(-len(data) // PASSAGE))
    whole = np.zeros(n * PASSAGE, dtype=np.uint8)
    whole[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    size = np.full(n, PASSAGE, dtype=np.float32)
    size[-1] = max(1, len(data) - (n - 1) * PASSAGE)
    rows = whole.reshape(n, PASSAGE)
    out = np.zeros((n, FEATURES), dtype=np.float32)
    counts = np.bincount((np.arange(n)[:, None] * 256 + rows).ravel(), minlength=n * 256).reshape(n, 256)
    counts[:, 0] = 0  # padding
    out[:, :256] = np.sqrt(counts / size[:, None])
    for lag in range(1, LAGS + 1):
        same = (rows[:, lag:] == rows[:, :-lag]) & (rows[:, lag:] != 0)
        out[:, 255 + lag] = same.sum(axis=1) / size
    out[:, -2] = out[:, 256:256 + LAGS].max(axis=1)
    out[:, -1] = size / PASSAGE
    return out


@dataclass
class AttentionNetwork:
    p: dict[str, np.ndarray]
    shift: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: passages of all bags one after another; ``starts``: where each bag begins."""
        p = self.p
        h = np.tanh(((x - self.shift) / self.scale) @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "z": z, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["c0"])))}

    def scores(self, bags: list[bytes]) -> list[float]:
        """Bags are encoded in groups of about ``CHUNK`` passages."""
        out, x, starts, n = [], [], [], 0
        for i, data in enumerate(bags):
            x.append(passages(data))
            starts.append(n)
            n += len(x[-1])
            if n >= CHUNK or i + 1 == len(bags):
                out += self.forward(np.concatenate(x), np.array(starts))["y"].astype(float).tolist()
                x, starts, n = [], [], 0
        return out


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = 25, rate: float = 0.003, seed: int = 7) -> AttentionNetwork:
    """Adam on the cross-entropy of the document labels."""
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags)
    shift, scale = everything.mean(axis=0), everything.std(axis=0) + 0.02
    sizes = {"W": (FEATURES, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,)}
    p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32) for k, s in sizes.items()}
    p |= {"b": np.zeros(HIDDEN, np.float32), "c0": np.zeros((), np.float32)}
    net = AttentionNetwork(p, shift, scale)
    mean, square, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 32):
            pick = order[i:i + 32]
            x = np.concatenate([bags[j] for j in pick])
            starts = np.cumsum([0, *(len(bags[j]) for j in pick[:-1])])
            f = net.forward(x, starts)
            bag, h, t, g, a = f["bag"], f["h"], f["t"], f["g"], f["a"]
            d = (f["y"] - y[pick]) / len(pick)
            dz = d[:, None] * p["c"]
            da = (dz[bag] * h).sum(axis=1)
            ds = a * (da - np.add.reduceat(a * da, starts)[bag])
            dt = ds[:, None] * p["w"] * g * (1 - t * t)
            dg = ds[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {"c": f["z"].T @ d, "c0": d.sum(), "w": (t * g).T @ ds, "V": h.T @ dt, "U": h.T @ dg,
                    "W": ((x - shift) / scale).T @ dh, "b": dh.sum(axis=0)}
            step += 1
            for k in p:
                q = grad[k] + 1e-4 * p[k]
                mean[k] += 0.1 * (q - mean[k])
                square[k] += 0.001 * (q * q - square[k])
                p[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_documents: int = 4000,
        passages_each: int = 24) -> AttentionNetwork | None:
    """Learn ``labels.quality`` from a bounded sample; ``usable`` is a condition on ``doc_id``."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & usable).select(
        "doc_id", F.col("quality").cast("int").alias("quality"))
    # at most max_documents rows, so the broadcast is bounded
    chosen = known.orderBy(F.xxhash64("doc_id"), "quality").limit(max_documents)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "quality", "text", F.xxhash64("doc_id", "text").alias("h"))

    def cut(batches):
        for b in batches:
            data = []
            for t in text_bytes(b):
                x = passages(t)
                data.append(x[np.unique(np.linspace(0, len(x) - 1, passages_each).astype(int))].tobytes())
            yield {"quality": b.column(0), "data": data, "h": b.column("h")}

    # rows may share an id: of twice as many as asked for the ones with the least hashes stay, whatever task ends first
    got = arrow_rows(rows, "quality int, data binary, h bigint", cut).orderBy("h", "quality").limit(2 * max_documents).toArrow()
    bags = sorted(zip(got.column("data").to_pylist(), got.column("quality").to_pylist(), strict=True))
    if not bags:
        return None
    return train([np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES) for b, _ in bags],
                 np.array([q for _, q in bags], dtype=np.float32))


def score(docs: DataFrame, network: AttentionNetwork | None, carried: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) and ``score`` of every whole text."""
    carried = list(docs.columns if carried is None else carried)
    src = docs.select(*dict.fromkeys([*carried, "text"]))
    out = src.select(*carried).withColumn("score", F.lit(0.0)).schema

    def run(batches):
        for b in batches:
            bags = text_bytes(b)
            yield {n: b.column(n) for n in carried if n != "score"} | {
                "score": [0.5] * len(bags) if network is None else network.scores(bags)}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    return arrow_rows(src, schema, run)
