"""Document quality by attention over passages (multiple-instance learning)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.llm.tables import columns, written
from lendscope.llm.words import Words, chunks, mix, split_words

PASSAGE_WORDS = 64
BUCKETS = 256
WIDTH = 24
SAMPLE_DOCUMENTS = 6_000  # the fit sees no more labelled documents than this,
SAMPLE_PASSAGES = 60_000  # nor more passages
EPOCHS = 12
BATCH = 64
BLOCK = 4_096
THRESHOLD = 0.3
FOLDS = 5

with np.errstate(over="ignore"):
    _PAIR_BUCKET = (mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(77)) % np.uint64(BUCKETS)).astype(np.int64)
_KIND = np.zeros((6, 256))
_KIND[0, 97:123] = 1
_KIND[1, 65:91] = 1
_KIND[2, 48:58] = 1
_KIND[3, 128:] = 1
_KIND[4, [44, 46]] = 1
_KIND[5] = 1 - _KIND[:5].sum(axis=0)
_KIND[5, [9, 10, 11, 12, 13, 32]] = 0
FEATURES = BUCKETS + 6 + 4


class Passages(NamedTuple):
    """Word ranges of passages; ``first[i]:first[i + 1]`` are those of document i, one at least."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _passages(words: Words, size: int = PASSAGE_WORDS) -> Passages:
    counts = np.diff(words.first)
    n = np.maximum(-(-counts // size), 1)
    first = np.concatenate([[0], np.cumsum(n)])
    document = np.repeat(np.arange(len(n)), n)
    start = words.first[document] + (np.arange(len(document)) - first[document]) * size
    return Passages(start, np.minimum(start + size, words.first[document + 1]), first)


def _features(words: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row per passage: shares of byte pairs in hashed buckets, kinds of characters, and word statistics."""
    n, count = len(start), end - start
    out = np.zeros((n, FEATURES), np.float32)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    left, right = words.starts[start[full]], words.ends[end[full] - 1]
    size = right - left
    owner = np.repeat(full, size)
    at = np.arange(int(size.sum())) + np.repeat(left - np.cumsum(size) + size, size)
    byte = words.data[at].astype(np.int64)
    pair = (byte[:-1] << 8 | byte[1:])[owner[:-1] == owner[1:]]
    same = owner[:-1][owner[:-1] == owner[1:]]
    pairs = np.bincount(same * BUCKETS + _PAIR_BUCKET[pair], minlength=n * BUCKETS).reshape(n, BUCKETS)
    out[:, :BUCKETS] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    for k, kind in enumerate(_KIND):
        out[full, BUCKETS + k] = np.add.reduceat(kind[byte], np.cumsum(size) - size) / size
    word = np.arange(int(count.sum())) + np.repeat(start - np.cumsum(count) + count, count)
    passage = np.repeat(np.arange(n), count)
    hashes, lengths = words.hashes[word], (words.ends - words.starts)[word]
    with np.errstate(over="ignore"):
        _, once = np.unique(hashes + mix(passage.astype(np.uint64)), return_index=True)
    known = np.bincount(passage[once], minlength=n)
    out[:, BUCKETS + 6] = known / np.maximum(count, 1)
    out[:, BUCKETS + 7] = np.log1p(np.bincount(passage, lengths, n) / np.maximum(count, 1))
    out[:, BUCKETS + 8] = np.log1p(count)
    out[:, BUCKETS + 9] = np.bincount(passage, words.data[words.ends[word] - 1] == 46, n) / np.maximum(count, 1)
    return out


class Model(NamedTuple):
    """Weights of the encoder (a, a0), the gated attention (v, u, w) and the classifier (c, c0)."""

    mean: np.ndarray
    scale: np.ndarray
    a: np.ndarray
    a0: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    c0: np.ndarray


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _encode(model: Model, x: np.ndarray):
    h = np.tanh(((x - model.mean) / model.scale) @ model.a + model.a0)
    t, s = np.tanh(h @ model.v), _sigmoid(h @ model.u)
    return h, t, s, (t * s) @ model.w


def _bags(h: np.ndarray, energy: np.ndarray, first: np.ndarray):
    """Attention weights that add up to one in each bag, and the weighted mean of its passages."""
    starts, sizes = first[:-1], np.diff(first)
    top = np.repeat(np.maximum.reduceat(energy, starts), sizes)
    weight = np.exp(energy - top)
    weight = weight / np.repeat(np.add.reduceat(weight, starts), sizes)
    return weight, np.add.reduceat(h * weight[:, None], starts)


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Adam on the log loss of bags. x has a row per passage, ``first`` the bags, label 0 or 1 per bag."""
    rng = np.random.default_rng(seed)
    d, k = x.shape[1], WIDTH
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    shapes = {"a": (d, k), "a0": (k,), "v": (k, k), "u": (k, k), "w": (k,), "c": (k,), "c0": (1,)}
    p = {n: (rng.normal(size=s) / np.sqrt(s[0]) if n not in ("a0", "c0") else np.zeros(s)).astype(np.float32)
         for n, s in shapes.items()}
    m, v2 = ({n: np.zeros_like(q) for n, q in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        for bag in np.array_split(rng.permutation(len(label)), max(1, len(label) // BATCH)):
            sizes = np.diff(first)[bag]
            at = np.concatenate([[0], np.cumsum(sizes)])
            rows = np.arange(at[-1]) + np.repeat(first[bag] - at[:-1], sizes)
            model = Model(mean, scale, *p.values())
            xs = (x[rows] - mean) / scale
            h, t, s, energy = _encode(model, x[rows])
            weight, z = _bags(h, energy, at)
            error = (_sigmoid(z @ p["c"] + p["c0"]) - label[bag]) / len(bag)
            dz = np.repeat(error[:, None] * p["c"], sizes, axis=0)
            dweight = (dz * h).sum(axis=1)
            denergy = weight * (dweight - np.repeat(np.add.reduceat(weight * dweight, at[:-1]), sizes))
            dt, ds = denergy[:, None] * p["w"] * s * (1 - t * t), denergy[:, None] * p["w"] * t * s * (1 - s)
            dh = (dz * weight[:, None] + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
            grad = {"a": xs.T @ dh + 1e-4 * p["a"], "a0": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds,
                    "w": (t * s).T @ denergy, "c": z.T @ error, "c0": error.sum(keepdims=True)}
            step += 1
            rate = 5e-3 * (1 - epoch / epochs) + 2e-4
            for n, g in grad.items():
                m[n] = 0.9 * m[n] + 0.1 * g
                v2[n] = 0.99 * v2[n] + 0.01 * g * g
                p[n] = (p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v2[n] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return Model(mean.astype(np.float32), scale.astype(np.float32), *p.values())


def score(model: Model, words: Words) -> np.ndarray:
    """Scores of documents; passages are encoded in blocks, so a text of any length fits."""
    passages = _passages(words)
    encoded, energies = [], []
    for at in range(0, len(passages.start), BLOCK):
        h, _, _, energy = _encode(model, _features(words, passages.start[at:at + BLOCK], passages.end[at:at + BLOCK]))
        encoded.append(h)
        energies.append(energy)
    _, z = _bags(np.concatenate(encoded), np.concatenate(energies), passages.first)
    return _sigmoid((z @ model.c + model.c0).astype(np.float64))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", 1 << 20):
            words = split_words(part.column("text"))
            passages = _passages(words)
            x = _features(words, passages.start, passages.end).astype(np.float16)
            blobs = [x[a:b].tobytes() for a, b in zip(passages.first[:-1], passages.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(blobs, pa.binary())], names=["quality", "x"])


def held_out(doc_id, folds: int = FOLDS):
    """Rows kept from learning: crc32 of doc_id as text is a multiple of ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def learn(documents: DataFrame, labels: DataFrame, documents_limit: int = SAMPLE_DOCUMENTS,
          passages_limit: int = SAMPLE_PASSAGES) -> Model | float:
    """A model from labelled documents outside the held-out fold; a constant score if one label is missing.

    The fit reads a bounded sample: the ``documents_limit`` labelled rows whose ids have the least hashes,
    whole texts, of which as many as have ``passages_limit`` passages. Their features, not their
    texts, come to the driver: at most passages_limit * FEATURES half-precision numbers are kept.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("quality").cast("long").alias("quality"))
    order = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    # More ids than needed, as labels may name documents that do not exist.
    chosen = written(known.orderBy(order, "doc_id").limit(documents_limit))
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    blobs, label, n = [], [], 0
    # Written first: all tasks work at once, and the rows are then read one partition at a time.
    for row in written(rows.mapInArrow(_sample_features, "quality long, x binary")).toLocalIterator():
        x = np.frombuffer(row.x, np.float16).reshape(-1, FEATURES)
        if n + len(x) <= passages_limit:
            n += len(x)
            blobs.append(x)
            label.append(row.quality)
    label = np.array(label, np.float32)
    if len(label) < 2 or label.min() == label.max():
        return float((label.sum() + 1) / (len(label) + 2))
    first = np.concatenate([[0], np.cumsum([len(x) for x in blobs])])
    return fit(np.concatenate(blobs).astype(np.float32), first, label)


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``documents`` with held_out, score and predicted.

    Every whole text is cut into passages of PASSAGE_WORDS words. A passage is encoded from
    its characters and words, a gate gives it an attention weight, and the weighted mean of all
    passages gives the score: 0 to 1, higher if label 1 is likelier. A text that is null, empty or
    blank has one empty passage and a score like any other. doc_id, lang and source take no
    part. Labels other than 0 and 1 are left out; of contradicting labels of one document 0 counts.
    Columns named like the three added ones are replaced.
    """
    model = learn(documents, labels)
    carried = [c for c in documents.columns if c not in ("held_out", "score", "predicted")]
    base = documents.select(*columns(carried))
    if isinstance(model, float):
        scored = base.withColumn("score", F.lit(model))
    else:
        plain = base.toDF(*[f"c{i}" for i in range(len(carried))])  # any names are fine, dots included
        text = f"c{carried.index('text')}"

        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, text, 1 << 20):
                    values = score(model, split_words(part.column(text)))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())],
                                                     names=[*part.schema.names, "score"])

        schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
        scored = plain.mapInArrow(scores, schema).toDF(*carried, "score")
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})


def good_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose score is ``threshold`` or more, with all their columns, whatever their names."""
    names = documents.columns
    plain = [c.alias(n if n in ("doc_id", "text") else f"c{i}") for i, (n, c) in enumerate(zip(names, columns(names), strict=True))]
    scored = quality_scores(documents.select(*plain), labels, threshold).where("predicted = 1")
    return scored.drop("held_out", "score", "predicted").toDF(*names)
