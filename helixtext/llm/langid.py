"""Language identification: a bidirectional gated recurrent network over bytes.

The network labels every byte. It reads windows of bytes, each one run of bytes
between white space (cut at WINDOW bytes), forwards and backwards; a document's
probabilities are the mean of those of its positions, over its whole text.
Equal windows get equal labels, so a task computes each of them once. Training
is by backpropagation through time, in numpy, on a bounded sample of documents.

Defined cases: a null text or one without any letter is ``und`` with score 0;
rows with a null language are predicted but not learned from; repeated rows get
equal results; without a single learned language everything is ``und``; columns
other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Documents of each language that the network learns from, at most.
MOST_OF_LANGUAGE = 300
#: Bytes in a window, at most.
WINDOW = 24
HIDDEN = 12
STEPS = 700
#: Weight of a word in capitals beside the word as it was found.
CAPITALS = 0.02
BATCH = 256
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    #: For each direction: input rows by byte (256 x 3H), recurrent weights (H x 3H); gates in the order update, reset, new.
    weights: dict[str, np.ndarray]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def start(languages: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w[f"e{d}"] = rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
        w[f"u{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(np.float32)
        w[f"o{d}"] = rng.normal(0, 0.3, (HIDDEN, languages)).astype(np.float32)
    w["c"] = np.zeros(languages, np.float32)
    return w


def run_one_way(x: np.ndarray, active: list[int], e: np.ndarray, u: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """States of all positions. x: windows x positions, longest window first; active: how many windows reach a position."""
    n, t = x.shape
    states = np.zeros((t, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    for i in range(t - 1, -1, -1) if back else range(t):
        k = active[i]
        g = e[x[:k, i]]
        p = h[:k]
        r = p @ u
        zr = sigmoid(g[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
        z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(g[:, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])
        out = new + z * (p - new)
        if keep is not None:
            keep.append((i, k, p.copy(), z, reset, new, r[:, 2 * HIDDEN :]))
        states[i, :k] = out
        h[:k] = out
    return states


def labels(x: np.ndarray, active: list[int], w: dict[str, np.ndarray], keep: dict | None = None) -> np.ndarray:
    """Probabilities: positions x windows x languages."""
    f = run_one_way(x, active, w["ef"], w["uf"], False, keep.setdefault("f", []) if keep is not None else None)
    b = run_one_way(x, active, w["eb"], w["ub"], True, keep.setdefault("b", []) if keep is not None else None)
    logits = f @ w["of"] + b @ w["ob"] + w["c"]
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    if keep is not None:
        keep["states"] = f, b
    return p


def gradients(x: np.ndarray, lengths: np.ndarray, y: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of all positions and its gradients, by backpropagation through time."""
    active = [int((lengths > i).sum()) for i in range(x.shape[1])]
    keep: dict = {}
    p = labels(x, active, w, keep)
    t, n, _ = p.shape
    mask = (np.arange(t)[:, None] < lengths[None]).astype(np.float32)
    total = mask.sum()
    hit = p[:, np.arange(n), y]
    loss = float(-(np.log(hit + 1e-9) * mask).sum() / total)
    d = p.copy()
    d[:, np.arange(n), y] -= 1
    d *= (mask / total)[:, :, None]
    g = {"c": d.sum((0, 1))}
    for way, states in zip("fb", keep["states"], strict=True):
        u, o = w[f"u{way}"], w[f"o{way}"]
        g[f"o{way}"] = np.einsum("tnh,tnl->hl", states, d)
        back = d @ o.T
        ge, gu = np.zeros_like(w[f"e{way}"]), np.zeros_like(u)
        carry = np.zeros((n, HIDDEN), np.float32)
        for i, k, before, z, reset, new, rn in reversed(keep[way]):
            dh = back[i, :k] + carry[:k]
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dreset = dnew * rn * reset * (1 - reset)
            dg = np.concatenate([dz, dreset, dnew], 1)
            dr = np.concatenate([dz, dreset, dnew * reset], 1)
            np.add.at(ge, x[:k, i], dg)
            gu += before.T @ dr
            carry[:k] = dh * z + dr @ u.T
        g[f"e{way}"], g[f"u{way}"] = ge, gu
    return loss, g


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of WINDOW bytes at most as rows of bytes (0 behind the end), and their lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    x = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w in words), np.uint8).reshape(len(words), WINDOW)
    return x, lengths


def fit(words: list[bytes], y: np.ndarray, weight: np.ndarray, languages: int, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on batches drawn by weight, each language equally often."""
    rng = np.random.default_rng(seed)
    w = start(languages, seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    x, lengths = windows(words)
    groups = [np.flatnonzero(y == c) for c in range(languages)]
    shares = [np.cumsum(weight[g]) / weight[g].sum() for g in groups]
    for step in range(1, steps + 1):
        at = np.concatenate([g[np.minimum(np.searchsorted(s, rng.random(BATCH // languages)), len(g) - 1)] for g, s in zip(groups, shares, strict=True)])
        at = at[np.argsort(-lengths[at], kind="stable")]
        t = int(lengths[at].max())
        _, g = gradients(x[at, :t], lengths[at], y[at], w)
        rate = 0.02 * (1 - step / (steps + 1))
        for k in w:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
            w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def word_sums(words: list[str], w: dict[str, np.ndarray]) -> np.ndarray:
    """For each word the sums of its positions' probabilities, and the number of positions."""
    out = np.zeros((len(words), len(w["c"]) + 1), np.float32)
    parts: list[bytes] = []
    of = []
    for i, word in enumerate(words):
        raw = word.encode("utf-8", "replace")
        for k in range(0, len(raw), WINDOW):
            parts.append(raw[k : k + WINDOW])
            of.append(i)
    of = np.array(of, np.int64)
    for a in range(0, len(parts), 20_000):
        x, lengths = windows(parts[a : a + 20_000])
        order = np.argsort(-lengths, kind="stable")
        for b in range(0, len(order), 2048):
            at = order[b : b + 2048]
            n = lengths[at]
            t = int(n[0])
            active = [int((n > i).sum()) for i in range(t)]
            p = labels(x[at, :t], active, w)
            p *= (np.arange(t)[:, None] < n[None])[:, :, None]
            np.add.at(out, of[a + at], np.concatenate([p.sum(0), n[:, None].astype(np.float32)], 1))
    return out


def train(spark: SparkSession, docs: DataFrame, most: int = MOST_OF_LANGUAGE, steps: int = STEPS) -> Network:
    """docs: doc_id, text, lang; at most ``most`` documents of each language are read."""
    chosen = common.bounded_sample(docs.where(F.col("text").isNotNull()).select("doc_id", "lang"), "doc_id", "lang", most).dropDuplicates()
    words = (
        docs.select("doc_id", "text", "lang")
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .select("lang", F.explode(F.split("text", r"\s+")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .toPandas()
        .sort_values(["lang", "word"])
    )
    languages = sorted(words["lang"].unique().tolist())
    if not languages:
        return Network([], {})
    parts = [(raw[k : k + WINDOW], language, n) for word, language, n in zip(words["word"], words["lang"], words["n"], strict=True) for raw in [word.encode("utf-8", "replace")] for k in range(0, len(raw), WINDOW)]
    # words in capitals are rare in the sample, but whole texts of them occur
    parts += [(raw.decode("utf-8", "ignore").upper().encode()[:WINDOW], language, CAPITALS * n) for raw, language, n in parts]
    parts = [p for p in parts if p[0]]
    at = {language: i for i, language in enumerate(languages)}
    y = np.array([at[language] for _, language, _ in parts])
    # square root: the few most frequent words don't fill the batches
    weight = np.sqrt(np.array([n for _, _, n in parts], float))
    return Network(languages, fit([p for p, _, _ in parts], y, weight, len(languages), steps))


def _scores(key: str, broadcast) -> common.WordScores:
    w = broadcast.value.weights
    return common.kept(f"language {key}", lambda: common.WordScores(lambda words: word_sums(words, w), len(w["c"]) + 1))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, network: Network, keep_text: bool = False) -> DataFrame:
    """The columns of docs (text if wanted) but any lang_pred and score, with those two anew."""
    docs = docs.drop("lang_pred", "score")
    kept = [c for c in docs.columns if keep_text or c != "text"]
    if not network.languages:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    broadcast = docs.sparkSession.sparkContext.broadcast(network)
    key, languages = network.key, network.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(key, broadcast)
        for batch in common.small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in common.slices(texts):
                cut = [t.split() if has_letter(t) else [] for t in texts[a:b]]
                counts = np.array([len(w) for w in cut])
                values = scores.of([w for words in cut for w in words])
                has = np.flatnonzero(counts)
                pooled = np.zeros((len(cut), len(languages)))
                if len(has):
                    sums = np.add.reduceat(values.astype(np.float64), (np.cumsum(counts) - counts)[has], axis=0)
                    pooled[has] = sums[:, :-1] / sums[:, -1:]
                best = pooled.argmax(1)
                names = pa.array([languages[k] if n else UNKNOWN for k, n in zip(best, counts, strict=True)], pa.string())
                sure = pa.array(np.clip(np.round(pooled[np.arange(len(cut)), best], 6), 0, 1))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in kept), names, sure], [*kept, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")
