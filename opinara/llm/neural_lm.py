"""Log-bilinear language model trained with noise-contrastive estimation.

Tokens fall into classes: the most frequent ones have one each, the end of a text has
one, all others share classes by their last two bytes. The model predicts the class
from those of the tokens before: context vectors by distance add up to a prediction,
whose products with the class vectors, normalised over all classes, are their
probabilities. Within a shared class a token has its add-one share. Tasks train on
their own rows in numpy, and the parameters are averaged; counts cover all rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import slices, utf8
from opinara.session import saved

SINGLE, SHARED = 191, 64
CLASSES = SINGLE + SHARED + 1
END = CLASSES - 1
CONTEXT = 4
DIMENSIONS = 32
NOISE = 64
BATCH = 1024
_CHUNK = 512
_END_TOKEN = b"\n"
_SHAPES = [(CONTEXT, CLASSES, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,)]


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) tokens between ASCII white space; the end is not among them."""
    return text.lower().split()


def shared_class(token: bytes) -> int:
    return SINGLE + zlib.crc32(token[-2:]) % SHARED


@dataclass
class Counts:
    """What the training rows hold: totals, the known tokens, and the classes."""

    total: int  # tokens, ends included
    distinct: int
    known: list[bytes]  # most frequent first
    counts: np.ndarray  # of the known tokens
    ends: int
    class_tokens: np.ndarray  # (CLASSES,) training tokens of each class
    class_distinct: np.ndarray

    def classes(self) -> np.ndarray:
        """Class of every known token."""
        return np.array([k if k < SINGLE else shared_class(t) for k, t in enumerate(self.known)], np.int32)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token binary, n) over all rows of texts (one column), an end for each row included."""

    def run(batches):
        held: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["token", "n"])
            held.clear()
            return out

        for batch in slices(batches):
            for text in utf8(batch.column(0)):
                held.update(tokens_of(text))
                held[_END_TOKEN] += 1
            if len(held) > 300_000:
                yield rows()
        if held:
            yield rows()

    return texts.mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def gathered(counts: DataFrame, max_known: int) -> Counts:
    """Totals and the `max_known` most frequent tokens; the rest stay in the table."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.col("token") == F.lit(_END_TOKEN)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.where(F.col("token") != F.lit(_END_TOKEN)).orderBy(F.desc("n"), "token").limit(max_known).toArrow()
    known = top.column(0).to_pylist()
    single = frozenset(known[:SINGLE])

    def run(batches):
        n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if token != _END_TOKEN and token not in single:
                    k = shared_class(token)
                    n[k] += c
                    v[k] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(v[some])], ["k", "n", "v"])

    sums = counts.mapInArrow(run, "k bigint, n bigint, v bigint").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    class_tokens, class_distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in sums.collect():
        class_tokens[r.k], class_distinct[r.k] = r.n, r.v
    known_n = np.array(top.column(1).to_pylist(), np.int64)
    m = min(SINGLE, len(known))
    class_tokens[:m] = known_n[:m]
    class_distinct[:m] = 1
    class_tokens[END], class_distinct[END] = ends, min(1, ends)
    return Counts(int(total), int(distinct), known, known_n, int(ends), class_tokens, class_distinct)


class Model:
    """Context vectors by distance, class vectors and class biases."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        sizes = np.cumsum([math.prod(s) for s in _SHAPES])
        self.context, self.target, self.bias = (p.reshape(s) for p, s in zip(np.split(flat, sizes[:-1]), _SHAPES, strict=True))

    @classmethod
    def start(cls, noise: np.ndarray, seed: int = 5) -> Model:
        """Small random vectors; the biases are the log shares, so that it begins as the class shares."""
        rng = np.random.default_rng(seed)
        model = cls(np.zeros(sum(math.prod(s) for s in _SHAPES), np.float32))
        model.context[:] = rng.normal(0, 0.05, _SHAPES[0])
        model.target[:] = rng.normal(0, 0.05, _SHAPES[1])
        model.bias[:] = np.log(noise)
        return model

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        q = self.context[0].take(contexts[:, 0], axis=0)
        for k in range(1, CONTEXT):
            q += self.context[k].take(contexts[:, k], axis=0)
        return q

    def log_probabilities(self, contexts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Normalised natural log-probability of each class after its context."""
        longest = lambda m: float(np.sqrt((m * m).sum(axis=-1)).max())
        small = CONTEXT * longest(self.context) * longest(self.target) + float(np.abs(self.bias).max()) < 80
        out = np.empty(len(classes))
        for at in range(0, len(classes), _CHUNK):
            part = slice(at, at + _CHUNK)
            logits = self.predicted(contexts[part]) @ self.target.T
            logits += self.bias
            if not small:  # else no exponential overflows
                logits -= logits.max(axis=1)[:, None]
            mine = logits[np.arange(len(logits)), classes[part]]
            np.exp(logits, out=logits)
            out[part] = mine - np.log(logits.sum(axis=1))
        return out


def noise_shares(counts: Counts) -> np.ndarray:
    n = counts.class_tokens + 1.0
    return n / n.sum()


def _add_rows(into: np.ndarray, classes: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to that of its class; rows of a class are summed side by side."""
    order = np.argsort(classes.astype(np.int16), kind="stable")
    sorted_ = classes[order]
    first = np.flatnonzero(np.diff(sorted_, prepend=-1))
    into[sorted_[first]] += np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def train_batch(model: Model, memory: np.ndarray, contexts: np.ndarray, classes: np.ndarray, noise: np.ndarray, rng, rate: float) -> None:
    """One step of noise-contrastive estimation; the batch shares its noise classes."""
    drawn = rng.choice(CLASSES, NOISE, p=noise)
    offset = np.log(NOISE * noise).astype(np.float32)
    q = model.predicted(contexts)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    own = model.target.take(classes, axis=0)
    d_own = sigmoid((q * own).sum(axis=1) + model.bias[classes] - offset[classes]) - 1
    d_noise = sigmoid(q @ model.target[drawn].T + model.bias[drawn] - offset[drawn])
    n = len(classes)
    d_own, d_noise = (d_own / n).astype(np.float32), (d_noise / n).astype(np.float32)
    d_q = d_own[:, None] * own + d_noise @ model.target[drawn]
    slope = Model(np.zeros_like(model.flat))
    for k in range(CONTEXT):
        _add_rows(slope.context[k], contexts[:, k], d_q)
    _add_rows(slope.target, classes, d_own[:, None] * q)
    _add_rows(slope.target, drawn, d_noise.T @ q)
    slope.bias[:] = np.bincount(classes, weights=d_own, minlength=CLASSES)
    slope.bias += np.bincount(drawn, weights=d_noise.sum(axis=0), minlength=CLASSES)
    memory += slope.flat**2
    model.flat -= rate * slope.flat / (np.sqrt(memory) + 1e-8)


class _NumberOf(dict):
    """Known token to its number; -1 for others."""

    def __missing__(self, token: bytes) -> int:
        return -1


class _Reader:
    """Turns texts into known-token numbers and classes within a task."""

    def __init__(self, counts: Counts):
        self.number = _NumberOf((t, k) for k, t in enumerate(counts.known))
        self.of_number = counts.classes().astype(np.int64)

    def classes(self, text: bytes) -> np.ndarray:
        """Class of each token and of the end."""
        return self.read(text)[2]

    def read(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(tokens, number of each or -1, class of each and the end)."""
        tokens = tokens_of(text)
        number = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        classes = np.full(len(tokens) + 1, END, np.int64)
        known = number >= 0
        classes[:-1][known] = self.of_number[number[known]]
        rare = np.flatnonzero(~known)
        classes[rare] = [shared_class(tokens[k]) for k in rare.tolist()]
        return tokens, number, classes


def contexts_of(classes: list[np.ndarray], taken: np.ndarray | None = None) -> np.ndarray:
    """The CONTEXT classes before every class (or the taken ones), nearest first; ends stand before a text."""
    if not classes:
        return np.zeros((0, CONTEXT), np.int64)
    pad = np.full(CONTEXT, END, np.int64)
    padded = np.concatenate([part for c in classes for part in (pad, c)])
    place = np.repeat(np.arange(1, len(classes) + 1) * CONTEXT, [len(c) for c in classes])
    place += np.arange(len(place))
    if taken is not None:
        place = place[taken]
    return padded[place[:, None] - np.arange(1, CONTEXT + 1)]


def _averaged(blobs: DataFrame) -> np.ndarray | None:
    """Weighted mean of the parameter rows (weight, flat), in rounds of 64 rows a task."""

    def run(batches):
        total, weight = None, 0.0
        for batch in batches:
            for w, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(flat, np.float32).astype(float) * w
                total = part if total is None else total + part
                weight += w
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], ["weight", "flat"]
            )

    n = blobs.count()
    while n > 64:
        blobs = saved(blobs.repartition(-(-n // 64)).mapInArrow(run, "weight double, flat binary"), "lm-mean")
        n = blobs.count()
    found = [(r.weight, np.frombuffer(r.flat, np.float32).astype(float)) for r in blobs.collect()]
    weight = sum(w for w, _ in found)
    return (sum(w * f for w, f in found) / weight).astype(np.float32) if found else None


def fit(texts: DataFrame, counts: Counts, rounds: int = 2, share: float = 1.0, rate: float = 0.15, seed: int = 5) -> Model:
    """Train on texts (one column): each task in `rounds` passes, averaged after each.

    The hash of a text tells which pass reads it, so that all passes together learn once
    from every position of every text, however large the corpus. A caller may have them
    learn from a random `share` of the positions only.
    """
    spark = texts.sparkSession
    column = F.col(texts.columns[0]).cast("string")
    # Plain arrays: a class would be looked up by name in tasks that may not have the package.
    sent = spark.sparkContext.broadcast(vars(counts))
    noise = noise_shares(counts)
    model = Model.start(noise, seed)
    for number in range(rounds):
        flat = model.flat

        def run(batches, flat=flat, number=number):
            reader = _Reader(Counts(**sent.value))
            mine = Model(flat.copy())
            memory = np.full_like(flat, 1e-6)
            rng = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
            seen = 0
            left: list[tuple[np.ndarray, np.ndarray]] = []
            for batch in slices(batches, 256):
                read = [reader.classes(t) for t in utf8(batch.column(0))]
                classes = np.concatenate(read) if read else np.zeros(0, np.int64)
                taken = np.arange(len(classes)) if share >= 1 else np.flatnonzero(rng.random(len(classes)) < share)
                rng.shuffle(taken)
                left.append((contexts_of(read, taken), classes[taken]))
                if sum(len(c) for _, c in left) < BATCH:
                    continue
                contexts, classes = np.concatenate([c for c, _ in left]), np.concatenate([c for _, c in left])
                ends = len(classes) // BATCH * BATCH
                for at in range(0, ends, BATCH):
                    train_batch(mine, memory, contexts[at : at + BATCH], classes[at : at + BATCH], noise, rng, rate)
                left = [(contexts[ends:], classes[ends:])]
                seen += ends
            rest = sum(len(c) for _, c in left)
            if rest:
                train_batch(mine, memory, np.concatenate([c for c, _ in left]), np.concatenate([c for _, c in left]), noise, rng, rate)
                seen += rest
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([mine.flat.tobytes()], pa.binary())], ["weight", "flat"])

        mine = texts.where(F.pmod(F.coalesce(F.crc32(column), F.lit(0)), F.lit(rounds)) == number)
        mean = _averaged(saved(mine.mapInArrow(run, "weight double, flat binary"), "lm-round"))
        if mean is not None:
            model = Model(mean)
    return model


_PART = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "rest array<struct<token: binary, n: int>>"
)


def language_scores(docs: DataFrame, held_out: Column, max_known: int = 200_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of docs.

    docs: (doc_id, text). Rows for which `held_out` is false train the model. Texts of
    any length are scored whole; null is empty, and an empty text is its end alone.
    Repeated rows train and score as often as they occur. Without any training row
    each class is as likely as another. An empty table gives no rows.

    Tasks know the `max_known` most frequent tokens; the counts of all other tokens are
    joined to the few places where these occur.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    training = rows.where(~F.col("held_out")).select("text")
    table = saved(token_counts(training), "lm-counts")
    counts = gathered(table, max_known)
    model = fit(training, counts)
    sent = spark.sparkContext.broadcast((vars(counts), model.flat))

    def run(batches):
        given, flat = sent.value
        counts, model = Counts(**given), Model(flat)
        reader = _Reader(counts)
        log_count = np.log10(counts.counts + 1.0)
        within = np.log10(counts.class_tokens + counts.class_distinct + 1.0)
        within[:SINGLE] = within[END] = 0
        unit = math.log10(counts.total + counts.distinct + 1)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 128):
            read = [reader.read(t) for t in utf8(batch.column(2))]
            classes = np.concatenate([c for _, _, c in read])
            logs = model.log_probabilities(contexts_of([c for _, _, c in read]), classes) / math.log(10) - within[classes]
            at = 0
            out = []
            for doc, held, (tokens, number, own) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), read, strict=True):
                n = len(own)
                known = number[number >= 0]
                rest = Counter(tokens[k] for k in np.flatnonzero(number < 0).tolist())
                base = float(log_count[known].sum()) + math.log10(counts.ends + 1) - n * unit
                score = float(logs[at : at + n].sum()) + float(log_count[known[known >= SINGLE]].sum())
                out.append((row, doc, held, n, len(known) + (counts.ends > 0), base, score, [{"token": t, "n": c} for t, c in rest.items()]))
                row += 1
                at += n
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int32())])))
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    parts = saved(rows.mapInArrow(run, _PART), "lm-parts")
    rest = parts.select("row", F.explode("rest").alias("r")).select("row", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    rare = table.where(F.col("token") != F.lit(_END_TOKEN))
    sums = (
        rest.join(rare, "token")
        .groupBy("row")
        .agg(F.sum("times").cast("long").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"))
    )
    joined = parts.drop("rest").join(saved(sums, "lm-rare"), "row", "left")
    more = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
