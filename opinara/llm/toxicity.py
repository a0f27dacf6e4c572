"""Toxicity by a convolutional text classifier trained in numpy.

Words are hashed to embedding rows; filters one, two and three words wide slide over
the whole text; the largest value of every filter feeds a logistic layer. The driver
fits the few hundred thousand numbers of the model on a bounded sample of labelled
rows; tasks score all rows with it. Decision thresholds are calibrated by language.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import add_column, utf8
from opinara.llm.hashing import hashed_words

BUCKETS = 1 << 16
DIMENSIONS = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
#: A word is the sum of the vectors of its first so many bytes (0: all).
LEADS = (0, 6, 8)
_TOKENS_AT_ONCE = 60_000


@dataclass
class Model:
    embedding: np.ndarray  # (BUCKETS + 1, DIMENSIONS); the last row is the blank beyond a text's end
    filters: list[np.ndarray]  # for each width: (width, DIMENSIONS, FILTERS)
    shift: np.ndarray  # (widths * FILTERS,)
    weight: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)


def word_rows(texts: list[bytes]) -> list[np.ndarray]:
    """(words, 3) embedding rows of each text: of the word and of two beginnings of it."""
    parts = [hashed_words(texts, lead) for lead in LEADS]
    rows = np.stack([(h >> np.uint64(20)).astype(np.int64) % BUCKETS for h, _ in parts], axis=1).astype(np.int32)
    return np.split(rows, np.cumsum(parts[0][1])[:-1]) if texts else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _responses(model: Model, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors, and the response of every filter at every place (one matrix product)."""
    x = model.embedding[rows[:, 0]] + model.embedding[rows[:, 1]] + model.embedding[rows[:, 2]]
    flat = np.concatenate([k.transpose(1, 0, 2).reshape(DIMENSIONS, -1) for k in model.filters], axis=1)
    y = x @ flat
    out = np.empty((len(rows), len(WIDTHS) * FILTERS), np.float32)
    at = 0
    for w, kernel in enumerate(model.filters):
        mine = out[:, w * FILTERS : (w + 1) * FILTERS]
        mine[:] = y[:, at : at + FILTERS]
        for k in range(1, len(kernel)):
            mine[:-k] += y[k:, at + k * FILTERS : at + (k + 1) * FILTERS]
        at += len(kernel) * FILTERS
    return x, out


_PAD = np.full((max(WIDTHS), 3), BUCKETS, np.int32)


def largest(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """(texts, filters) largest responses; 0 for a text without words. Long texts go in overlapping pieces."""
    values = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
    pieces, owner = [], []
    for k, t in enumerate(texts):
        padded = np.concatenate([t, _PAD])
        for at in range(0, len(t), _TOKENS_AT_ONCE):
            pieces.append(padded[at : min(at + _TOKENS_AT_ONCE, len(t)) + len(_PAD)])
            owner.append(k)
    if owner:
        values[np.unique(owner)] = -np.inf
    at = 0
    while at < len(pieces):
        end, held = at + 1, len(pieces[at])
        while end < len(pieces) and held + len(pieces[end]) <= _TOKENS_AT_ONCE:
            held += len(pieces[end])
            end += 1
        sizes = np.array([len(p) for p in pieces[at:end]])
        starts = np.cumsum(sizes) - sizes
        cuts = np.stack([starts, starts + sizes - len(_PAD)], axis=1).ravel()
        top = np.maximum.reduceat(_responses(model, np.concatenate(pieces[at:end]))[1], cuts, axis=0)[::2]
        for k, row in zip(owner[at:end], top, strict=True):
            np.maximum(values[k], row, out=values[k])
        at = end
    return values


def score(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Score of each text (as embedding rows) between 0 and 1."""
    return _sigmoid(np.maximum(largest(model, texts) + model.shift, 0) @ model.weight + model.bias)


def _first_guess(texts: list[np.ndarray], labels: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Random embedding whose first number is the row's shrunken log odds of label 1; and which rows live.

    Rows that fewer than three texts use are blank, so that words seen by chance cannot decide.
    """
    use = np.zeros((2, BUCKETS + 1))
    for t, y in zip(texts, labels, strict=True):
        use[int(y), np.unique(t)] += 1
    live = use.sum(axis=0) >= 3
    odds = np.log((use[1] + 0.5) / (labels.sum() + 1)) - np.log((use[0] + 0.5) / ((1 - labels).sum() + 1))
    sure = use.sum(axis=0) / (use.sum(axis=0) + 8)
    embedding = rng.normal(0, 0.1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    embedding[:, 0] = odds * sure / 2
    embedding[~live] = 0
    return embedding, live


def fit(texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None], epochs: int = 10, seed: int = 7, rate: float = 0.005) -> Model:
    """Train on whole texts; a fifth of them calibrates the bias and the thresholds.

    Without labels of both kinds the model scores all texts with the share of label 1
    (0.5 without any).
    """
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    filters = [rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    weight = rng.normal(0, 0.1, n).astype(np.float32)
    blank = np.zeros((BUCKETS + 1, DIMENSIONS), np.float32)
    model = Model(blank, filters, np.zeros(n, np.float32), weight, 0.0)
    share = float(np.mean(labels)) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        weight[:] = 0
        share = min(max(share, 0.01), 0.99)
        model.bias = float(np.log(share / (1 - share)))
        return model
    order = rng.permutation(len(texts))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    model.embedding, live = _first_guess([texts[k] for k in train], labels[train], rng)
    embedding = model.embedding
    filters[0][0, 0, : FILTERS // 2] = 1
    weight[: FILTERS // 2] = 0.5
    rate_of = {1: 0.5 / max(labels[train].mean(), 1e-6), 0: 0.5 / max(1 - labels[train].mean(), 1e-6)}
    balance = np.array([rate_of[int(y)] for y in labels])
    bias = np.full(1, -1, np.float32)
    dense = [*model.filters, model.shift, model.weight, bias]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in dense]
    row_moments = [np.zeros_like(embedding), np.zeros_like(embedding)]
    step = 0
    for epoch in range(epochs):
        train = rng.permutation(train)
        for at in range(0, len(train), 64):
            batch = train[at : at + 64]
            mine = [texts[b] for b in batch if len(texts[b])]
            batch = np.array([b for b in batch if len(texts[b])])
            if not len(batch):
                continue
            rows = np.concatenate([p for t in mine for p in (t, _PAD)])
            x, out = _responses(model, rows)
            places = np.empty((len(batch), n), np.int64)
            begin = 0
            for k, t in enumerate(mine):
                places[k] = begin + out[begin : begin + len(t)].argmax(axis=0)
                begin += len(t) + len(_PAD)
            hidden = np.maximum(out[places, np.arange(n)] + model.shift, 0)
            drop = ((rng.random(hidden.shape) < 0.8) / 0.8).astype(np.float32)
            used = hidden * drop
            p = _sigmoid(used @ model.weight + bias[0])
            delta = ((p - labels[batch]) * balance[batch] / len(batch)).astype(np.float32)
            back = delta[:, None] * model.weight[None, :] * drop * (hidden > 0)
            grads: list[np.ndarray] = []
            touched, changes = [], []
            for w, kernel in enumerate(model.filters):
                span = slice(w * FILTERS, (w + 1) * FILTERS)
                g = np.empty_like(kernel)
                for k in range(len(kernel)):
                    word = places[:, span] + k
                    g[k] = np.einsum("bfd,bf->df", x[word], back[:, span])
                    change = (back[:, span, None] * kernel[k].T[None, :, :]).reshape(-1, DIMENSIONS)
                    for part in range(3):
                        touched.append(rows[word, part].ravel())
                        changes.append(change)
                grads.append(g + 1e-4 * kernel)
            grads += [back.sum(axis=0), used.T @ delta + 1e-3 * model.weight, delta.sum(keepdims=True)]
            ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g_rows = np.zeros((len(ids), DIMENSIONS), np.float32)
            np.add.at(g_rows, inverse, np.concatenate(changes))
            g_rows = (g_rows + 1e-4 * embedding[ids]) * live[ids, None]
            step += 1
            now = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            m, v = row_moments
            m[ids] = 0.9 * m[ids] + 0.1 * g_rows
            v[ids] = 0.999 * v[ids] + 0.001 * g_rows**2
            embedding[ids] -= now * m[ids] / (np.sqrt(v[ids]) + 1e-7)
            for value, g, (m, v) in zip(dense, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g**2
                value -= now * m / (np.sqrt(v) + 1e-7)
    model.bias = float(bias[0])
    _calibrate(model, [texts[h] for h in held], labels[held], [langs[h] for h in held])
    return model


def _best_logit(logits: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1: half way between neighbours, nearest to 0 among equals."""
    order = np.sort(np.unique(logits))
    cuts = np.concatenate([[0.0], (order[1:] + order[:-1]) / 2])
    hit = [((logits >= c) & (labels == 1)).sum() for c in cuts]
    f1 = np.array([2 * h / max(1, (logits >= c).sum() + (labels == 1).sum()) for h, c in zip(hit, cuts, strict=True)])
    best = cuts[f1 >= f1.max() - 1e-9]
    return float(best[np.argmin(np.abs(best))])


def _calibrate(model: Model, texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None], enough: int = 20) -> None:
    """Shift the bias so that 0.5 is the best cut overall; then a threshold for each language.

    A language needs `enough` texts of label 1 for a threshold of its own.
    """
    if not labels.any():
        return
    p = np.clip(score(model, texts).astype(float), 1e-9, 1 - 1e-9)
    logits = np.log(p / (1 - p))
    cut = _best_logit(logits, labels)
    model.bias -= cut
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([x == lang for x in langs])
        if labels[mine].sum() >= enough:
            model.thresholds[lang] = float(_sigmoid(np.array(_best_logit(logits[mine] - cut, labels[mine]))))


def train(docs: DataFrame, labels: DataFrame, max_each: int = 3000) -> Model:
    """Fit on docs (doc_id, text, lang) with labels (doc_id, toxic 0 or 1).

    At most `max_each` ids of each label are learnt from, the first by hash of the id.
    They are chosen among the labels alone, so that only these texts leave their tasks,
    as word rows of twelve bytes a word. Labels that are null or of another value, and
    ids without a document, teach nothing; a document with several labels counts once for each.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null")
    known = known.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("__toxic")).distinct()
    chosen = [known.where(F.col("__toxic") == k).orderBy(F.xxhash64("__id"), "__id").limit(max_each) for k in (0, 1)]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    sample = rows.join(F.broadcast(chosen[0].union(chosen[1])), F.col("id") == F.col("__id"))

    def build():
        return lambda batch: pa.array([t.tobytes() for t in word_rows(utf8(batch.column(0)))], pa.binary())

    found = add_column(sample.select("id", "text", "lang", "__toxic"), "words", "binary", build, ["text"])
    found = found.select("id", "words", "lang", "__toxic").toArrow().to_pylist()
    found.sort(key=lambda r: (r["id"], r["__toxic"], r["words"]))
    return fit([np.frombuffer(r["words"], np.int32).reshape(-1, 3) for r in found], np.array([r["__toxic"] for r in found]), [r["lang"] for r in found])


def toxicity(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with one more column (a present one is replaced): the score of the whole text, 0 to 1.

    The score depends on the text alone. Null and empty texts score as a text without
    words; repeated rows score alike; no row goes.
    """
    # Plain arrays: a class would be looked up by name in tasks that may not have the package.
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def build():
        model = Model(**sent.value)
        return lambda batch: pa.array(score(model, word_rows(utf8(batch.column(0)))), pa.float64())

    return add_column(docs, out, "double", build, [text])


def rejected(model: Model, score_column: str = "toxicity", lang: str = "lang"):
    """Whether a row's score reaches the threshold of its language (0.5 where it has none)."""
    threshold = F.lit(0.5)
    for name, value in model.thresholds.items():
        threshold = F.when(F.col(lang) == name, F.lit(value)).otherwise(threshold)
    return F.col(score_column) >= threshold
