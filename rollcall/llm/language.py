"""Language ID by a byte convolutional network, trained here in numpy.

Texts are cut into windows of ``WINDOW`` bytes (A-Z lower-cased, the last one
padded with zero bytes).  Filters of widths 2, 3 and 4 run over the one-hot
bytes, each keeps its maximum over the window, and a softmax layer gives the
languages.  A document's prediction sums the log-probabilities of all its
windows, so the whole text counts.  The one-hot convolution is a table look-up
per byte; for prediction the tables are folded over byte pairs.

Learning uses a bounded sample: ``max_documents`` labelled documents (the
smallest hashes of doc_id), ``windows_each`` evenly spaced windows of each.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
rows with null lang or null doc_id are not learned from; without any labelled
row all predictions are ``und``; equal texts get equal predictions; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, arrow_rows

WINDOW, FILTERS, WIDTHS = 128, 12, (2, 3, 4)
UNDETERMINED = "und"
#: windows that go through the network together
CHUNK = 512
_LETTER = regex.compile(r"\p{L}")


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; false for null ids."""
    return F.coalesce(F.crc32(id_column.cast("string")) % parts == part, F.lit(False))


def windows(text: str) -> np.ndarray:
    """All windows of a text, one row each; none for an empty text."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES)
    n = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


@dataclass
class ByteNetwork:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: (width, 256, FILTERS)
    dense: np.ndarray         # (len(WIDTHS) * FILTERS, languages)
    bias: np.ndarray

    def __post_init__(self):
        self.folded = None

    def __getstate__(self):
        return {**self.__dict__, "folded": None}

    def _fold(self):
        """Tables over byte pairs, so a filter needs half the look-ups."""
        if self.folded is None:
            self.folded = []
            for t in self.tables:
                steps = []
                for j in range(0, len(t), 2):
                    two = j + 1 < len(t)
                    steps.append((j, two, (t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, FILTERS) if two else t[j]))
                self.folded.append(steps)
        return self.folded

    def pooled(self, w: np.ndarray, where: bool = False):
        """Largest value of each filter in each window (and its place)."""
        pairs = w[:, :-1].astype(np.int32) * 256 + w[:, 1:]
        best, place = [], []
        for steps, t in zip(self._fold(), self.tables, strict=True):
            n = WINDOW - len(t) + 1
            z = None
            for j, two, table in steps:
                part = table[(pairs if two else w)[:, j:j + n]]
                z = part if z is None else np.add(z, part, out=z)
            if where:
                at = z.argmax(axis=1)
                place.append(at)
                best.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0])
            else:
                best.append(z.max(axis=1))
        return np.concatenate(best, axis=1), place

    def log_probabilities(self, w: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(w), CHUNK):
            logits = np.maximum(self.pooled(w[i:i + CHUNK])[0], 0) @ self.dense + self.bias
            logits -= logits.max(axis=1, keepdims=True)
            out.append(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)


def train(w: np.ndarray, labels: list[str], epochs: int = 12, rate: float = 0.01, seed: int = 8) -> ByteNetwork:
    """Adam on the cross-entropy of windows ``w``; classes weigh alike."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS]
    params += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32),
               np.zeros(len(languages), np.float32)]
    weight = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))
    means, squares, steps = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 64):
            pick = order[i:i + 64]
            x = w[pick]
            net = ByteNetwork(languages, params[:-2], params[-2], params[-1])
            # tables change at every step, so they are not folded here
            net.folded = [[(j, False, t[j]) for j in range(len(t))] for t in net.tables]
            top, place = net.pooled(x, where=True)
            act = np.maximum(top, 0)
            logits = act @ params[-2] + params[-1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= (weight[y[pick]] / len(pick))[:, None].astype(np.float32)
            grads = [np.zeros_like(q) for q in params]
            grads[-2], grads[-1] = act.T @ p, p.sum(axis=0)
            back = (p @ params[-2].T) * (top > 0)
            for g, at, k in zip(grads, place, range(len(WIDTHS)), strict=False):
                d = back[:, k * FILTERS:(k + 1) * FILTERS]
                for j in range(len(g)):
                    np.add.at(g[j], (np.take_along_axis(x, at + j, axis=1), np.arange(FILTERS)[None, :]), d)
            steps += 1
            for q, g, m, v in zip(params, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return ByteNetwork(languages, params[:-2], params[-2], params[-1])


def fit(docs: DataFrame, usable: Column, max_documents: int = 4000, windows_each: int = 4,
        max_languages: int = 256) -> ByteNetwork | None:
    """Learn from ``text`` and ``lang`` of a bounded sample of the usable rows: of
    each language the rows with the least hashes, an equal share of
    ``max_documents`` (its own rows, if it has fewer), so that a rare language is
    learned too.  Of more than ``max_languages`` the commonest are learned."""
    rows = (docs.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("lang", "text", F.xxhash64("doc_id", "text").alias("h")))

    def cut(batches):
        for b in batches:
            langs, data, hashes = [], [], []
            for lang, text, h in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if _LETTER.search(text):
                    w = windows(text)
                    for i in np.unique(np.linspace(0, len(w) - 1, windows_each).astype(int)):
                        langs.append(lang)
                        data.append(w[i].tobytes())
                        hashes.append(h)
            yield {"lang": langs, "data": data, "h": hashes}

    known = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(max_languages).collect()
    if not known:
        return None
    share = -(-max_documents // len(known))
    # the hashes of a language are spread evenly, so those below this border are a little over its share
    least = {r.lang: -2**63 + min(1.0, 1.2 * share / r.n + 40 / r.n) * 2**64 for r in known}
    border = F.create_map(*[F.lit(x) for lang, top in least.items() for x in (lang, int(min(top, 2**63 - 1)))])
    near = rows.where(F.col("h") <= F.try_element_at(border, F.col("lang")))
    got = (arrow_rows(near, "lang string, data binary, h bigint", cut)
           .orderBy("h", "lang", "data").limit(2 * (share + 40) * len(known) * windows_each).toArrow())
    if not got.num_rows:
        return None
    data = got.column("data").to_pylist()
    langs = got.column("lang").to_pylist()
    order = sorted(range(len(data)), key=lambda i: (data[i], langs[i]))
    w = np.frombuffer(b"".join(data[i] for i in order), dtype=np.uint8).reshape(-1, WINDOW)
    return train(w, [langs[i] for i in order])


def predict(docs: DataFrame, network: ByteNetwork | None, *carried: Column) -> DataFrame:
    """``doc_id, carried..., lang_pred, score`` of every whole text.  ``score``
    is the mean probability of the predicted language over the windows."""
    src = docs.select("doc_id", "text", *carried)
    kept = [f for f in src.schema if f.name != "text"]

    def run(batches):
        for b in batches:
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                if network is None or not text or not _LETTER.search(text):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = network.log_probabilities(windows(text))
                best = int(p.sum(axis=0, dtype=np.float64).argmax())
                langs.append(network.languages[best])
                scores.append(min(1.0, float(np.exp(p[:, best]).mean())))
            yield {f.name: b.column(f.name) for f in kept} | {"lang_pred": langs, "score": scores}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return arrow_rows(src, f"{schema}, lang_pred string, score double", run)
