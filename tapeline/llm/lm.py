"""Language-model scoring: a log-bilinear model over word classes, trained in numpy by noise-contrastive estimation.

A word's probability is that of its class after the classes of the two words before it, times
the word's share of its class. Frequent words are classes of their own; the others, known or
not, share classes by their endings. The log-bilinear part maps the two context classes'
vectors by a matrix each, adds them, and multiplies with the class vectors: one batched
product gives the normalised log-probabilities of all contexts.

All training text counts: word counts and class trigram counts are sums over the whole
corpus. The trigram counts are bounded by the number of classes cubed, so the model is
fitted on the driver from complete, bounded statistics.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import staged, text_slices, with_row_key

FOLDS, HELD_FOLD = 7, 2
#: Words with more than 1/HEAD of all tokens are looked up in memory: fewer than HEAD, of at most HEAD_BYTES each.
HEAD = 2_000_000
HEAD_BYTES = 64
#: Classes: the end of a text, the SINGLES most frequent words, ENDINGS groups of other words.
SINGLES, ENDINGS = 94, 32
CLASSES = 1 + SINGLES + ENDINGS
START = CLASSES  # context class before the first word
DIMENSIONS, NOISE, STEPS, RATE = 32, 8, 80, 0.05
#: Distinct words that a task counts before it gives them out.
HELD_WORDS = 400_000
END = b""  # no word is empty


def _ending(word: bytes) -> int:
    return 1 + SINGLES + zlib.crc32(word[-3:]) % ENDINGS


class LogBilinear:
    """score(c | a, b) = (left[a] + right[b]) . target[c] + bias[c], with left and right the mapped context vectors."""

    def __init__(self, classes: int = CLASSES, dimensions: int = DIMENSIONS, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        small = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
        self.context = small(classes + 1, dimensions)
        self.far = small(dimensions, dimensions) + np.eye(dimensions, dtype=np.float32) * 0.1
        self.near = small(dimensions, dimensions) + np.eye(dimensions, dtype=np.float32)
        self.target = small(classes, dimensions)
        self.bias = np.zeros(classes, np.float32)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.context[a] @ self.far + self.context[b] @ self.near) @ self.target.T + self.bias

    def fit(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, counts: np.ndarray, steps: int = STEPS, noise: int = NOISE, rate: float = RATE) -> None:
        """Noise-contrastive estimation on counted trigrams, by Adam.

        The noise is the classes' own distribution, `noise` samples a word. With the counts at
        hand its share is taken as an expectation: a context seen n times meets class c
        n * noise * P(c) times as noise.
        """
        total = counts.sum()
        if not total:
            return
        classes = len(self.bias)
        prior = (np.bincount(c, counts, classes) + 1.0) / (total + classes)
        self.bias[:] = np.log(prior)
        offset = np.log(noise * prior).astype(np.float32)
        pairs, of = np.unique(a.astype(np.int64) * (classes + 1) + b, return_inverse=True)
        far, near = pairs // (classes + 1), pairs % (classes + 1)
        seen = np.zeros((len(pairs), classes), np.float32)
        np.add.at(seen, (of, c), counts / total)
        weight = seen.sum(axis=1, keepdims=True)
        expected = weight * (noise * prior).astype(np.float32)
        names = ("context", "far", "near", "target", "bias")
        moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in names}
        for step in range(1, steps + 1):
            hidden = self.context[far] @ self.far + self.context[near] @ self.near
            odds = np.clip(hidden @ self.target.T + self.bias - offset, -30, 30)
            data = 1 / (1 + np.exp(-odds))  # how sure the model is that a class is data, not noise
            slope = seen * (1 - data) - expected * data
            back = slope @ self.target
            gradient = {
                "far": self.context[far].T @ back,
                "near": self.context[near].T @ back,
                "target": slope.T @ hidden,
                "bias": slope.sum(axis=0),
                "context": np.zeros_like(self.context),
            }
            np.add.at(gradient["context"], far, back @ self.far.T)
            np.add.at(gradient["context"], near, back @ self.near.T)
            for n in names:
                first, second = moments[n]
                first += 0.1 * (gradient[n] - first)
                second += 0.01 * (gradient[n] ** 2 - second)
                getattr(self, n)[...] += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)

    def table(self) -> np.ndarray:
        """log10 probability of each class after each two context classes, in one batched product and a softmax."""
        classes = len(self.bias)
        a, b = np.divmod(np.arange((classes + 1) ** 2), classes + 1)
        scores = self.scores(a, b)
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return (scores / np.log(10)).reshape(classes + 1, classes + 1, classes)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks


def _count_words(rows: DataFrame) -> DataFrame:
    """(word, c) over all rows; the end of a text is the empty word. Tasks add up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        held: Counter[bytes] = Counter()
        for _, texts in text_slices(batches):
            for text in texts:
                held.update(_words(text))
            held[END] += len(texts)
            if len(held) >= HELD_WORDS:
                yield out()
                held.clear()
        if held:
            yield out()

    return rows.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Classes and counts of the frequent words; everything about a class that a word's share needs."""

    def __init__(self, head: dict[bytes, int], singles: list[bytes], mass: np.ndarray) -> None:
        self.place = {word: i for i, word in enumerate(head)}
        own = {word: 1 + i for i, word in enumerate(singles)}
        own[END] = 0
        self.classes = np.array([own[w] if w in own else _ending(w) for w in head] + [0], np.int64)
        self.log_count = np.log10(np.array(list(head.values()) + [0], np.float64) + 1)
        self.log_mass = np.log10(mass)  # of each class: tokens + distinct words + one unknown

    def texts(self, texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, place in the head or -1, class, end of each text), the end token included."""
        words = [[*_words(t), END] for t in texts]
        get = self.place.get
        at = np.fromiter((get(w, -1) for own in words for w in own), np.int64)
        classes = self.classes[at]
        rest = np.flatnonzero(at < 0)
        ends = np.cumsum([len(own) for own in words])
        if len(rest):
            flat = [w for own in words for w in own]
            classes[rest] = [_ending(flat[i]) if flat[i] else 0 for i in rest.tolist()]
        return words, at, classes, ends


def _contexts(classes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the second and the first word before each word, START where there is none."""
    begins = np.append(0, ends[:-1])
    near = np.append(START, classes[:-1])
    near[begins] = START
    far = np.append(START, near[:-1])
    far[begins] = START
    return far, near


def _class_trigrams(rows: DataFrame, words: object) -> DataFrame:
    """(code, n): how often each class follows each two classes."""
    wide = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*words.value)
        counts = np.zeros(wide * wide * CLASSES, np.int64)
        waiting: list[np.ndarray] = []
        for _, texts in text_slices(batches):
            _, _, classes, ends = vocabulary.texts(texts)
            far, near = _contexts(classes, ends)
            waiting.append((far * wide + near) * CLASSES + classes)
            if sum(map(len, waiting)) > 2_000_000:
                counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
                waiting = []
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
        code = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(counts[code])], ["code", "n"])

    return rows.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _class_mass(counts: DataFrame, singles: list[bytes]) -> np.ndarray:
    """Of each class: its training tokens, its distinct words and one for what is unknown."""
    own = {word: 1 + i for i, word in enumerate(singles)} | {END: 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            classes = np.array([own[w] if w in own else _ending(w) for w in batch.column("word").to_pylist()], np.int64)
            tokens += np.bincount(classes, batch.column("c").to_numpy(), CLASSES).astype(np.int64)
            distinct += np.bincount(classes, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(tokens), pa.array(distinct)], ["class", "tokens", "words"])

    mass = np.ones(CLASSES)
    for r in counts.mapInArrow(run, "class long, tokens long, words long").groupBy("class").agg((F.sum("tokens") + F.sum("words")).alias("m")).collect():
        mass[r["class"]] += r["m"]
    return mass


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """Each row's id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Trains on the rows whose crc32(id as text) mod 7 is not 2 and scores all. Null texts count
    as empty (the end token only), null ids as the empty text; rows that repeat are trained on and scored each.
    An empty table gives no rows; without training rows all counts are 0 and the model is uniform over the classes.
    Counts of rare words meet their places by a shuffled join, so the vocabulary may be of any size.
    """
    spark = df.sparkSession
    plain = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = with_row_key(plain, "id", "text").withColumn("text", F.col("text").cast("string"))
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % FOLDS
    rows = rows.withColumn("held_out", fold == HELD_FOLD)
    training = rows.where(~F.col("held_out"))
    counts = staged(_count_words(training))
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sums["n"] or 0, sums["v"]
    frequent = counts.where((F.col("c") * head > n) & (F.octet_length("word") <= HEAD_BYTES)).toArrow()
    order = np.lexsort((np.array([zlib.crc32(w) for w in frequent["word"].to_pylist()], np.int64), -frequent["c"].to_numpy()))
    words, c = frequent["word"].to_pylist(), frequent["c"].to_pylist()
    in_order = {bytes(words[i]): c[i] for i in order}
    singles = [w for w in in_order if w != END][:SINGLES]
    vocabulary = spark.sparkContext.broadcast((in_order, singles, _class_mass(counts, singles)))
    trigrams = _class_trigrams(training, vocabulary).toArrow()
    code, times = trigrams["code"].to_numpy(), trigrams["n"].to_numpy().astype(np.float64)
    model = LogBilinear()
    model.fit(code // CLASSES // (CLASSES + 1), code // CLASSES % (CLASSES + 1), code % CLASSES, times)
    fitted = spark.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*vocabulary.value)
        own_model = LogBilinear()
        vars(own_model).update(fitted.value)
        table = own_model.table()
        for part, texts in text_slices(batches):
            own, at, classes, ends = words.texts(texts)
            begins = np.append(0, ends[:-1])
            far, near = _contexts(classes, ends)
            known = at >= 0
            log_count = np.where(known, words.log_count[at], 0.0)
            log_class = table[far, near, classes].astype(np.float64) - words.log_mass[classes]
            rare = [Counter(own[i][j - b] for j in (np.flatnonzero(~known[b:e]) + b).tolist()) for i, (b, e) in enumerate(zip(begins.tolist(), ends.tolist()))]
            arrays = [
                pa.array(ends - begins),
                pa.array(np.add.reduceat(known.astype(np.int64), begins)),
                pa.array(np.add.reduceat(log_count, begins)),
                pa.array(np.add.reduceat(log_class, begins)),
                pa.array([list(x) for x in rare], pa.list_(pa.binary())),
                pa.array([list(x.values()) for x in rare], pa.list_(pa.int64())),
            ]
            names = ["row_key", "id", "held_out", "n_tokens", "known", "log_count", "log_class", "rare", "times"]
            yield pa.RecordBatch.from_arrays([part.column("row_key"), part.column("id"), part.column("held_out"), *arrays], names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row_key long, id {kind}, held_out boolean, n_tokens long, known long, log_count double, log_class double, rare array<binary>, times array<long>"
    local = staged(rows.select("row_key", "id", "held_out", "text").mapInArrow(run, schema))
    places = local.select("row_key", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row_key", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    met = places.join(counts, "word")
    found = met.groupBy("row_key").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_count"))
    full = local.drop("rare", "times").join(found, "row_key", "left")
    log_count = F.col("log_count") + F.coalesce("more_count", F.lit(0.0))
    return full.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (log_count - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (log_count + F.col("log_class")).alias("score"),
    )
