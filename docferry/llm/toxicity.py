"""Toxicity by a bag of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

A word stands for its character n-grams (with its ends marked) hashed into ``buckets`` rows of an embedding table; its
vector is their mean, so an unseen misspelling shares most n-grams with the word it stems from. A passage of
``passage`` words is the mean of its words' vectors, and a linear softmax gives its two classes. A text is as toxic as its
most toxic passage (passages overlap by half), so the score of a long text is not diluted. In training the passage
that counts is chosen anew in every epoch; embeddings and the linear layer are learned together by gradient steps with
per-weight step sizes.

The model is fitted on the driver from at most ``max_rows`` labelled rows of at most ``max_bytes`` of text (documented
bounds: the rows with the least hashes of their ids, rows of the rarer class first up to half; a text that exceeds the
bytes left is passed over, and the next ones are taken); scoring covers all rows.
Since the output is linear in the mean, a trained n-gram is one number, and scoring needs a table of ``buckets`` numbers.

Defined results: null and empty texts have the score of a passage without words (the bias); labels other than 0 and 1
and null labels take no part; with no label or one class only, every score is the share of class 1 (0 without labels);
a document with several labels is toxic if one says so; null ids are scored like others (crc32 of the empty text).
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docferry.llm.common import LOWER, give_back, id_remainder, mix64, named, powers, running_hash, slices, utf8_bytes, word_bounds

MAX_ROWS = 8_000
MAX_BYTES = 24 << 20
THRESHOLD = 0.3
#: Bytes of text that are scored together; their n-grams take some 200 times as much.
SCORE_BYTES = 1 << 18
#: The same in training, on the driver.
TRAIN_BYTES = 1 << 16
#: Words whose n-grams are averaged together.
MEAN_WORDS = 1 << 14
#: Rows of the embedding table that are drawn together.
DRAWN_ROWS = 1 << 14


@dataclasses.dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dim: int = 8
    least: int = 3
    most: int = 6
    passage: int = 8
    #: Rounds over the rows, more where they have fewer than ``least_steps`` steps of ``batch`` rows.
    epochs: int = 5
    least_steps: int = 300
    rate: float = 0.5
    #: Steps in which a text counts as a whole, before its passages do.
    whole_steps: int = 40
    batch: int = 64
    seed: int = 7


#: Between words: all ASCII bytes but letters and digits.
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[0x80:] = False
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_EDGE = np.uint8(0x20)


def grams(column, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams in order of their words, the first n-gram of each word (and their number), the first word of each
    row, and a hash of each word."""
    data, rows = utf8_bytes(column)
    data = LOWER[data]
    starts, ends, words = word_bounds(data, rows, _BETWEEN)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), words, np.zeros(0, np.uint64)
    # every word on its own with a mark on both ends
    sizes = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.full(first[-1], _EDGE, np.uint8)
    inner = np.ones(first[-1], dtype=bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    lead = np.repeat(starts - first[:-1] - 1, sizes)
    place = np.arange(first[-1])
    marked[inner] = data[(place + lead)[inner]]
    left = np.repeat(first[1:], sizes) - place  # bytes to the end of the word
    running = running_hash(marked)
    inverse = powers(len(running), inverse=True)
    found, owner = [], []
    word = np.repeat(np.arange(len(starts)), sizes)
    for n in range(settings.least, settings.most + 1):
        at = np.flatnonzero(left >= n)
        found.append(mix64((running[at + n] - running[at]) * inverse[at] + np.uint64(n)))
        owner.append(word[at])
    # the whole word too, so that short words have something
    found.append(mix64((running[first[1:]] - running[first[:-1]]) * inverse[first[:-1]]))
    owner.append(np.arange(len(starts)))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(found)[order] & np.uint64(settings.buckets - 1)).astype(np.int64)
    return buckets, np.searchsorted(owner[order], np.arange(len(starts) + 1)), words, found[-1]


def passages(n_words: int, size: int) -> np.ndarray:
    """First words of the passages of a text: every half passage; the last one ends with the text."""
    if n_words <= size:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n_words - size, size // 2), n_words - size)


def passage_scores(word_values: np.ndarray, size: int) -> np.ndarray:
    """The mean of the word values in each passage."""
    starts = passages(len(word_values), size)
    total = np.concatenate([[0.0], np.cumsum(word_values)])
    stops = np.minimum(starts + size, len(word_values))
    return (total[stops] - total[starts]) / np.maximum(stops - starts, 1)


@dataclasses.dataclass
class Model:
    settings: Settings
    #: What each n-gram adds to the log odds, times the number of n-grams of its word.
    values: np.ndarray
    bias: float

    def score(self, column) -> np.ndarray:
        """Probability of class 1 of each row."""
        buckets, first, rows, _ = grams(column, self.settings)
        words = _word_means(self.values[buckets].astype(np.float64), first)
        logits = np.asarray([passage_scores(words[a:b], self.settings.passage).max() for a, b in zip(rows, rows[1:], strict=False)]) + self.bias
        return 1 / (1 + np.exp(-logits))


def _word_means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)


class Words:
    """The distinct words of the training texts with their n-grams, and each text as numbers of words."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, settings: Settings):
        known, numbers, n_known = np.zeros(0, np.uint64), np.zeros(0, np.int32), 0
        self.texts: list[np.ndarray] = []
        found_all, sizes = bytearray(), [np.zeros(0, np.int64)]
        for part, goes_on in _steps(texts, settings.batch):
            buckets, first, rows, keys = grams(part, settings)
            distinct, at, where = np.unique(keys, return_index=True, return_inverse=True)
            # sorted arrays: a dictionary of all words would take several times as much
            place = np.searchsorted(known, distinct)
            new = np.ones(len(distinct), bool)
            inside = place < n_known
            new[inside] = known[place[inside]] != distinct[inside]
            own = np.empty(len(distinct), np.int32)
            own[~new] = numbers[place[~new]]
            own[new] = np.arange(n_known, n_known + new.sum())
            known, numbers = np.insert(known, place[new], distinct[new]), np.insert(numbers, place[new], own[new])
            n_known = len(known)
            found, n = _gathered(buckets, first, at[new])
            found_all += found.astype(np.int32).tobytes()
            sizes.append(n)
            own = own[where]
            of_rows = [own[a:b].copy() for a, b in zip(rows, rows[1:], strict=False)]
            if goes_on:
                self.texts[-1] = np.concatenate([self.texts[-1], of_rows.pop(0)])
            self.texts += of_rows
        self.grams = np.frombuffer(found_all, np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of some words in order, and how many each has."""
        return _gathered(self.grams, self.first, words)

    def means(self, values: np.ndarray) -> np.ndarray:
        """The mean over each word's n-grams of a number per bucket."""
        out = np.zeros(len(self.first) - 1)
        for start in range(0, len(out), MEAN_WORDS):
            first = self.first[start : start + MEAN_WORDS + 1]
            own = values[self.grams[first[0] : first[-1]]]
            out[start : start + MEAN_WORDS] = np.add.reduceat(own, first[:-1] - first[0]) / np.diff(first)
        return out


def _steps(texts: pa.Array | pa.ChunkedArray, batch: int) -> Iterator[tuple[pa.Array, bool]]:
    """The texts in parts of at most ``batch`` rows and TRAIN_BYTES; whether the first row goes on with the text before.

    A longer text is cut between words.
    """
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        for start in range(0, len(chunk), batch):
            rows = pa.RecordBatch.from_arrays([chunk[start : start + batch]], ["text"])
            for part in slices([rows], "text", TRAIN_BYTES):
                part = part.column("text")
                data, _ = utf8_bytes(part)
                if len(part) > 1 or len(data) <= TRAIN_BYTES:
                    yield part, False
                    continue
                between = np.flatnonzero(_BETWEEN[data])
                wanted = np.searchsorted(between, np.arange(TRAIN_BYTES, len(data), TRAIN_BYTES))
                cuts = [0, *np.unique(between[wanted[wanted < len(between)]]).tolist(), len(data)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    yield pa.array([data[a:b].tobytes()], pa.large_binary()), a > 0


def _gathered(values: np.ndarray, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the ranges ``at``, which begin at ``first``, one after the other; and the ranges' sizes."""
    sizes = first[at + 1] - first[at]
    ends = np.cumsum(sizes)
    return values[np.arange(sizes.sum()) + np.repeat(first[at] - ends + sizes, sizes)], sizes


#: Steps after which the passages that count are judged by the present weights.
JUDGE_STEPS = 16


def fit(words: Words, labels: np.ndarray, settings: Settings) -> Model:
    """Embeddings and linear softmax, learned together."""
    share = float(labels.mean()) if len(labels) else 0.0
    constant = Model(settings, np.zeros(settings.buckets, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    if len(labels) == 0 or share in (0.0, 1.0):
        return constant
    rng = np.random.default_rng(settings.seed)
    table = np.empty((settings.buckets, settings.dim), np.float32)
    for start in range(0, settings.buckets, DRAWN_ROWS):
        rows = table[start : start + DRAWN_ROWS]
        rows[:] = rng.normal(0, 0.1, rows.shape)
    weights = rng.normal(0, 0.1, (settings.dim, 2)).astype(np.float32)
    bias = np.log(np.asarray([1 - share, share], np.float32))
    squares = [np.full(settings.buckets, 1e-8, np.float32), np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)]
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    steps, step, odds = -(-len(words.texts) // settings.batch), 0, np.zeros(0)
    for _ in range(max(settings.epochs, -(-settings.least_steps // steps))):
        order = rng.permutation(len(words.texts))
        for start in range(0, len(order), settings.batch):
            chosen = order[start : start + settings.batch]
            passage = settings.passage if step >= settings.whole_steps else 1 << 30
            if step % JUDGE_STEPS == 0:
                odds = words.means(table @ (weights[:, 1] - weights[:, 0]))
            step += 1
            hidden = np.zeros((len(chosen), settings.dim), np.float32)
            ids, shares, owner = [], [], []
            for k, d in enumerate(chosen):
                own = words.texts[d]
                if not len(own):
                    continue
                at = passages(len(own), passage)
                best = at[int(np.argmax(passage_scores(odds[own], passage)))] if len(at) > 1 else 0
                own = own[best : best + passage]
                found, sizes = words.of(own)
                ids.append(found)
                shares.append(np.repeat(1.0 / (sizes * len(own)), sizes).astype(np.float32))
                owner.append(np.full(len(found), k))
                hidden[k] = shares[-1] @ table[found]
            logits = hidden @ weights + bias
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(chosen)), labels[chosen]] -= 1
            slope = (chance * balance[chosen][:, None]).astype(np.float32)
            back = slope @ weights.T
            for value, square, gradient in ((weights, squares[1], hidden.T @ slope), (bias, squares[2], slope.sum(axis=0))):
                square += gradient**2
                value -= settings.rate * 0.3 * gradient / np.sqrt(square)
            if ids:
                ids, shares, owner = np.concatenate(ids), np.concatenate(shares), np.concatenate(owner)
                rows, where = np.unique(ids, return_inverse=True)
                change = np.stack([np.bincount(where, weights=back[owner, c] * shares, minlength=len(rows)) for c in range(settings.dim)], axis=1).astype(np.float32)
                squares[0][rows] += (change**2).mean(axis=1)
                table[rows] -= settings.rate * change / np.sqrt(squares[0][rows])[:, None]
    return Model(settings, table @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


def training_rows(df: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, usable: Column | None, max_rows: int, max_bytes: int) -> tuple[pa.ChunkedArray, np.ndarray]:
    """At most ``max_rows`` labelled texts, half of the rarer class if there are as many, in order of the hash of their ids.

    Ids are chosen first, from narrow columns; texts are read for the chosen ones only.
    """
    spark, docs = df.sparkSession, df if usable is None else df.where(usable)
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("mark"))
    known = marks.join(docs.select(F.col(doc_id).alias("id")).distinct(), "id")
    ranked = known.select("id", "mark", F.xxhash64(F.col("id").cast("string"), F.lit("fit")).alias("order"))
    by_class = [ranked.where(F.col("mark") == m).orderBy("order", "id").limit(max_rows).collect() for m in (0, 1)]
    half = max_rows // 2
    chosen = [r for m in (0, 1) for r in by_class[m][: max(half, max_rows - len(by_class[1 - m]))]]
    nothing = pa.chunked_array([], pa.string()), np.zeros(0, np.int64)
    if not chosen:
        return nothing
    ids = spark.createDataFrame(chosen, ranked.schema)
    # at most max_rows ids, so they go to all tasks
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("value")).join(F.broadcast(ids), "id").where("value IS NOT NULL")
    sized = rows.withColumn("size", F.octet_length("value"))
    sizes = sized.select("order", "size").orderBy("order", "size").limit(max_rows).collect()
    room, fit_in = max_bytes, []
    for r in sizes:
        # a text that is too long for what is left makes way for those after it
        if r.size <= room:
            room -= r.size
            fit_in.append((r.order, r.size))
    if not fit_in:
        return nothing
    taken = spark.createDataFrame([(o, n, c) for (o, n), c in Counter(fit_in).items()], "order long, size int, n_taken int")
    # texts of one id and one size: as many as have room
    place = F.row_number().over(Window.partitionBy("order", "size").orderBy("value"))
    found = sized.join(F.broadcast(taken), ["order", "size"]).withColumn("place", place).where((F.col("place") <= max_rows) & (F.col("place") <= F.col("n_taken")))
    texts = found.orderBy("order", "size", "value").select("mark", "value").toArrow()
    return texts.column("value"), texts.column("mark").to_numpy()


def train(df: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", usable: Column | None = None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, settings: Settings = Settings()) -> Model:
    """A model from the labelled rows of ``df`` for which ``usable`` holds."""
    texts, marks = training_rows(df, labels, doc_id=doc_id, text=text, label=label, usable=usable, max_rows=max_rows, max_bytes=max_bytes)
    words = Words(texts if 0 < marks.sum() < len(marks) else texts[:0], settings)
    # the driver keeps word numbers only while it learns
    del texts
    give_back()
    model = fit(words, marks, settings)
    del words
    give_back()
    return model


def score(df: DataFrame, model: Model, *, text: str = "text", into: str = "score") -> DataFrame:
    """The rows with the probability of class 1; a column of that name is replaced."""
    names = [c for c in df.columns if c.lower() != into.lower()]
    # mapInArrow cannot look up every name that a column may have
    base = df.select(*(c.alias(f"c{i}") for i, c in enumerate(named(names))))
    place = base.columns[[n.lower() for n in names].index(text.lower())]
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*base.schema, StructField("score", DoubleType())])

    def add(batches):
        for batch in slices(batches, place, SCORE_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch.column(place)))], schema.names)
        give_back()

    return base.mapInArrow(add, schema).toDF(*names, into)


def toxicity(df: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows whose id's crc32 modulo 4 is 2 are kept out of training."""
    held_out = id_remainder(doc_id, 4) == 2
    model = train(df, labels, doc_id=doc_id, text=text, usable=~held_out)
    rows = df.select(F.col(doc_id).alias("doc_id"), id_remainder(doc_id, 4).alias("_r"), F.col(text).alias("text"))
    scored = score(rows, model, text="text", into="score")
    return scored.select("doc_id", (F.col("_r") == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
