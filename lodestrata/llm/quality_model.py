"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words; every passage of the whole text is encoded. Labels are known for
documents alone: gated attention, learned from them, weighs the passages, and the weighted sum
of their encodings gives the document's score::

    e = tanh(W x + b)    a = softmax(w . (tanh(V e) * sigmoid(U e)))    score = sigmoid(c . sum(a e) + d)

A passage's features are ``COUNTS`` numpy counts over bytes and words (letter case, digits, symbols, marks, word length, repeated words,
n-grams and lines) and ``LEXICAL`` signed buckets of its hashed, A-Z lower-cased words and word pairs. The model is trained with Adam on
the driver, ``EPOCHS`` times over at most ``SAMPLE`` labelled documents, drawn by hash of the id from all of them,
and at most ``BAG`` passages of each, evenly spaced: documented bounds of training alone. Scores read every passage.

Defined cases: a null, empty or blank text is one passage without words and gets the model's score for that;
with no labels, or labels of one class only, every score is the share of label 1 (0.5 with none); label rows that repeat a
document count by their smallest label; null labels teach nothing; repeated rows get equal
results; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean, small
from lodestrata.llm.quality_rules import _SYMBOL, _keyed, _repeated, covered

PASSAGE, SAMPLE, BAG, HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 64, 6000, 256, 16, 20, 256, 0.01, 1e-3, 5
"""EPOCHS, RATE and DECAY have the least loss on a quarter of the learned rows that the others do not see."""
COUNTS, LEXICAL = 14, 128
FEATURES = COUNTS + LEXICAL


def _lut(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_UPPER, _DIGIT, _SHOUT, _STOP = _lut(bytes(range(65, 91))), _lut(b"0123456789"), _lut(b"!?"), _lut(b".,;:")
_ODD = _lut(b"/\\@_=~^{}[]()\"'+-")


def passages(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, passages of each row) of a slice of bytes; rows without a word have one."""
    n = len(starts)
    begin, end, row = W.spans(W.SPACE[data], starts, ends)
    words = W.range_hash(data, begin, end)
    count = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    per_row = np.maximum(1, -(-count // PASSAGE))
    out = np.zeros((int(per_row.sum()), FEATURES))
    if not len(row):
        return out, per_row
    first_word = np.cumsum(count) - count
    first_passage = np.cumsum(per_row) - per_row
    mine = first_passage[row] + (np.arange(len(row)) - first_word[row]) // PASSAGE
    total = len(out)
    size = np.bincount(mine, minlength=total).astype(np.float64)
    whole = np.maximum(size, 1)
    sums = lambda flags: np.bincount(mine, weights=flags, minlength=total)

    def inside(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(mask, out=c[1:])
        return sums((c[end] - c[begin]).astype(np.float64))

    chars = inside((data & 0xC0) != 0x80)
    letters = np.maximum(chars, 1)
    lines = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 10, out=lines[1:])
    gap = np.append(begin[1:], len(data))
    l_begin, l_end, l_row = W.spans(data == 10, starts, ends)
    twice = _repeated(_keyed(W.range_hash(data, l_begin, l_end), l_row))
    in_line = np.searchsorted(l_begin, begin, side="right") - 1
    keys = _keyed(words, row)
    plain = W.LOWER[data]
    lower = W.range_hash(plain, begin, end)
    pairs = W.grams(lower, 2)
    together = np.flatnonzero(mine[:-1] == mine[1:]) if len(mine) > 1 else np.zeros(0, np.int64)
    for keys_, owner in ((lower, mine), (pairs[together], mine[together])):
        sign = 1.0 - 2.0 * (keys_ >> np.uint64(63)).astype(np.float64)
        cell = owner * LEXICAL + (keys_ % np.uint64(LEXICAL)).astype(np.int64)
        out[:, COUNTS:] += np.bincount(cell, weights=sign, minlength=total * LEXICAL).reshape(total, LEXICAL)
    out[:, COUNTS:] /= np.sqrt(whole)[:, None]
    out[:, :COUNTS] = np.stack(
        [
            np.log1p(size), chars / whole, inside(_UPPER[data]) / letters, inside(_DIGIT[data]) / letters, inside(_SYMBOL[data]) / whole, inside(_SHOUT[data]) / whole,
            inside(_STOP[data]) / whole, inside(data >= 0xC0) / letters, inside(_ODD[data]) / whole, sums((lines[gap] - lines[end]).astype(np.float64)) / whole,
            sums(_repeated(keys)) / whole, sums(covered(words, row, 3)) / whole, sums(covered(words, row, 8)) / whole, sums(twice[in_line]) / whole,
        ],
        axis=1,
    )
    return out, per_row


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = W.buffers(column)
    found = []
    for lo, hi in W.slices(offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        found.append(passages(raw[offsets[lo] : offsets[hi]], at[:-1], at[1:]))
    if not found:
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(model: dict, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict]:
    """Scores of bags whose passages lie in a row, and what ``train`` needs of the way there."""
    x = (x - model["mean"]) / model["scale"]
    e = np.tanh(np.clip(x, -8, 8) @ model["W"] + model["b"])
    t, g = np.tanh(e @ model["V"]), _sigmoid(e @ model["U"])
    logit = (t * g) @ model["w"]
    first = np.cumsum(sizes) - sizes
    top = np.maximum.reduceat(logit, first)
    weight = np.exp(logit - np.repeat(top, sizes))
    attention = weight / np.repeat(np.add.reduceat(weight, first), sizes)
    z = np.add.reduceat(e * attention[:, None], first, axis=0)
    score = _sigmoid(z @ model["c"] + model["d"])
    return score, {"x": np.clip(x, -8, 8), "e": e, "t": t, "g": g, "a": attention, "z": z, "first": first}


def gradient(model: dict, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict:
    """The gradient of the mean log loss of bags by each learned part of the model."""
    score, way = forward(model, x, sizes)
    off = (score - y) / len(y)
    dz = np.repeat(off[:, None] * model["c"], sizes, axis=0)
    # attention: da_i = a_i (dz . e_i - sum_j a_j dz . e_j)
    pull = (dz * way["e"]).sum(axis=1)
    mean = np.add.reduceat(way["a"] * pull, way["first"])
    dlogit = way["a"] * (pull - np.repeat(mean, sizes))
    dh = dlogit[:, None] * model["w"]
    dt, dg = dh * way["g"] * (1 - way["t"] ** 2), dh * way["t"] * way["g"] * (1 - way["g"])
    de = dz * way["a"][:, None] + dt @ model["V"].T + dg @ model["U"].T
    dx = de * (1 - way["e"] ** 2)
    return {"W": way["x"].T @ dx, "b": dx.sum(axis=0), "V": way["e"].T @ dt, "U": way["e"].T @ dg, "w": ((way["t"] * way["g"]) * dlogit[:, None]).sum(axis=0), "c": way["z"].T @ off, "d": off.sum()}


def train(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> dict:
    """A model from bags and their labels, by Adam on the mean log loss of batches of bags; small sets are gone through more often."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or y.min() == y.max():
        return {"share": share}
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.standard_normal(shape) / np.sqrt(shape[0])
    model = {"mean": x.mean(axis=0), "scale": x.std(axis=0) + 1e-6, "W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, HIDDEN), "U": draw(HIDDEN, HIDDEN),
             "w": draw(HIDDEN), "c": draw(HIDDEN), "d": np.array(np.log(share / (1 - share)))}
    learned = ("W", "b", "V", "U", "w", "c", "d")
    m, v = ({k: np.zeros_like(model[k]) for k in learned} for _ in range(2))
    first, step = np.cumsum(sizes) - sizes, 0
    batches = -(-len(y) // BATCH)
    for _ in range(epochs * max(1, -(-8 // batches))):
        order = rng.permutation(len(y))
        for part in np.array_split(order, batches):
            step += 1
            rows = np.concatenate([np.arange(first[k], first[k] + sizes[k]) for k in part])
            grad = gradient(model, x[rows], sizes[part], y[part])
            for k in learned:
                g = grad[k] + DECAY * model[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model[k] = model[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def score_bags(model: dict, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if "share" in model:
        return np.full(len(sizes), model["share"])
    return forward(model, x, sizes)[0] if len(sizes) else np.zeros(0)


@lean
def _bagged(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            x, sizes = bags(part.column("text"))
            end = np.cumsum(sizes)
            held = [x[e - s : e][np.unique(np.linspace(0, s - 1, min(s, BAG)).astype(np.int64))] for e, s in zip(end.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([h.astype(np.float32).tobytes() for h in held], pa.binary())], ["doc_id", "label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1); at most ``sample`` labelled documents are read."""
    drawn = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    known = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # ``sample`` rows
    rows = sorted(known.mapInArrow(_bagged, "doc_id long, label int, bag binary").collect(), key=lambda r: (r["doc_id"], r["bag"]))
    if not rows:
        return {"share": 0.5}
    x = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows]
    return train(np.concatenate(x).astype(np.float64), np.array([len(k) for k in x]), np.array([float(r["label"] > 0) for r in rows]))


def score_documents(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every document; no shuffle."""

    @lean
    def scored(batches):
        for batch in small(batches, 2048):
            x, sizes = bags(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(score_bags(model, x, sizes), 9))], ["doc_id", "score"])

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(scored, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double")
