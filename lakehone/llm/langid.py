"""Language identification: a byte convolutional network, trained in numpy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_batches


WINDOW = 256
#: Windows that the network is trained on, and documents that they are drawn from (at most WINDOWS_EACH of one), at most.
SAMPLE_DOCS, WINDOWS_EACH = 6000, 3
WIDTHS, FILTERS, EMBED = (2, 3, 4), 10, 6
LETTER = regex.compile(r"\p{L}")


def windows(raw: bytes) -> np.ndarray:
    """All bytes in windows of WINDOW, the last one padded with zeros."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class Network:
    """Bytes -> embeddings -> filters of several widths -> ReLU -> maximum over the window -> softmax."""

    def __init__(self, labels: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, wide, f = labels, max(WIDTHS), len(WIDTHS) * FILTERS
        # One matrix for all widths: narrow filters have zeros at the end.
        self.mask = np.concatenate([np.repeat(np.arange(wide) < w, EMBED)[:, None] * np.ones((1, FILTERS)) for w in WIDTHS], 1).astype(np.float32)
        self.p = {"e": rng.normal(0, 0.5, (256, EMBED)), "w": rng.normal(0, 1, (wide * EMBED, f)) / np.sqrt(wide * EMBED) * self.mask, "b": np.zeros(f), "v": rng.normal(0, 0.1, (f, len(labels))), "c": np.zeros(len(labels))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def columns(self, x: np.ndarray) -> np.ndarray:
        e = self.p["e"][x]
        e = np.concatenate([e, np.zeros((len(x), max(WIDTHS) - 1, EMBED), np.float32)], 1).reshape(len(x), -1)
        view = np.lib.stride_tricks.sliding_window_view(e, max(WIDTHS) * EMBED, 1)[:, ::EMBED]
        return view.reshape(-1, max(WIDTHS) * EMBED)

    def forward(self, x: np.ndarray, keep: bool = False):
        cols = self.columns(x)
        z = (cols @ self.p["w"]).reshape(len(x), WINDOW, -1)
        if not keep:
            top = np.maximum(z.max(1) + self.p["b"], 0)
            out = top @ self.p["v"] + self.p["c"]
            out = np.exp(out - out.max(1, keepdims=True))
            return out / out.sum(1, keepdims=True)
        at = z.argmax(1)
        top = np.take_along_axis(z, at[:, None], 1)[:, 0] + self.p["b"]
        out = np.maximum(top, 0) @ self.p["v"] + self.p["c"]
        out = np.exp(out - out.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True), top, at, cols

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 2) -> None:
        """Adam on cross entropy, classes weighted evenly."""
        rng = np.random.default_rng(seed)
        weight = 1 / np.maximum(np.bincount(y, minlength=len(self.labels)), 1)
        weight = (weight / weight[y].mean()).astype(np.float32)
        m, v, t = {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        wide = max(WIDTHS)
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                i = order[at : at + batch]
                prob, top, where, cols = self.forward(x[i], True)
                d = prob
                d[np.arange(len(i)), y[i]] -= 1
                d *= weight[y[i]][:, None] / len(i)
                g = {"v": np.maximum(top, 0).T @ d, "c": d.sum(0)}
                dt = (d @ self.p["v"].T) * (top > 0)
                g["b"] = dt.sum(0)
                flat = (np.arange(len(i))[:, None] * WINDOW + where).reshape(-1)
                taken = cols[flat].reshape(*where.shape, -1)
                g["w"] = np.einsum("nfk,nf->kf", taken, dt) * self.mask
                back = np.einsum("nf,kf->nfk", dt, self.p["w"]).reshape(-1, wide, EMBED)
                rows = (flat[:, None] % WINDOW + np.arange(wide)).reshape(-1)
                docs_ = np.repeat(np.repeat(np.arange(len(i)), where.shape[1]), wide)
                ok = rows < WINDOW
                g["e"] = np.zeros_like(self.p["e"])
                np.add.at(g["e"], x[i][docs_[ok], rows[ok]], back.reshape(-1, EMBED)[ok])
                t += 1
                step = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                for k in g:
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.001 * (g[k] ** 2 - v[k])
                    self.p[k] -= (step * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and mean probability of each whole text, windows weighted by their bytes."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.labels:
            return out
        total = np.zeros((len(texts), len(self.labels)))
        held: list[np.ndarray] = []
        owners: list[int] = []

        def flush():
            if held:
                x = np.concatenate(held)
                who = np.repeat(owners, [len(h) for h in held])
                for at in range(0, len(x), 64):
                    part = x[at : at + 64]
                    np.add.at(total, who[at : at + 64], self.forward(part) * (part > 0).sum(1)[:, None])
                held.clear()
                owners.clear()

        for i, text in enumerate(texts):
            if text and LETTER.search(text):
                raw = text.encode()
                for at in range(0, len(raw), WINDOW * 4096):
                    held.append(windows(raw[at : at + WINDOW * 4096]))
                    owners.append(i)
                    if sum(map(len, held)) > 4096:
                        flush()
                out[i] = ("", 0.0)
        flush()
        for i, (lang, _) in enumerate(out):
            if lang == "":
                k = int(total[i].argmax())
                out[i] = (self.labels[k], float(min(1.0, total[i, k] / max(total[i].sum(), 1e-9))))
        return out


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame) -> Network:
    """A network from text and lang of rows of docs (text, lang) with lang known and a letter in the text.

    From at most SAMPLE_DOCS different texts, drawn by hash with about as many of each language; at most WINDOWS_EACH windows of each, anywhere in
    the text.  Copies of a text count once; a text with two languages counts for both.  Rows without lang, text or a letter teach nothing; from
    an empty table nothing is learned; other columns are ignored.
    """
    known = docs.where("lang is not null and text is not null").select("lang", F.xxhash64("text").alias("h"), "text")
    once = known.select("lang", "h").distinct()
    drawn = once.join(once.groupBy("lang").count(), "lang").withColumn("draw", F.pmod("h", F.lit(1 << 40)).cast("double") * F.col("count"))
    # Texts stay on the executors: those that are drawn are known by hash.
    ids = drawn.orderBy("draw", "h", "lang").limit(SAMPLE_DOCS).select("h", "lang")
    chosen = known.join(F.broadcast(ids), ["h", "lang"], "left_semi").dropDuplicates(["h", "lang"]).select("lang", "h", "text")

    def cut(batches):
        for batch in batches:
            langs, out, hs = [], [], []
            for lang, h, text in zip(*(c.to_pylist() for c in batch.columns)):
                if LETTER.search(text):
                    w = windows(text.encode())
                    rng = np.random.default_rng(h & 0xFFFFFFFF)
                    for i in rng.permutation(len(w))[:WINDOWS_EACH]:
                        langs.append(lang)
                        hs.append(h)
                        out.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hs, pa.int64()), pa.array(out, pa.binary())], ["lang", "h", "w"])

    got = chosen.mapInArrow(cut, "lang string, h long, w binary").orderBy("h", "lang", "w").limit(SAMPLE_DOCS * WINDOWS_EACH).toPandas()
    labels = sorted(set(got.lang))
    net = Network(labels)
    if len(labels) > 1:
        x = np.stack([np.frombuffer(bytes(w), np.uint8) for w in got.w])
        net.train(x, np.searchsorted(labels, got.lang.to_numpy(object)))
    return net


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text).

    `und` with score 0 if the text is null or has no letter, or nothing could be learned; ties go to the language first by code point; rows
    that repeat, repeat; an empty table gives an empty result; other columns are ignored.
    """
    lower_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def split_of(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4
