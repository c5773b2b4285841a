"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document has a label.  A sentence s has the probability
p(s) = sigmoid(bias + sum of its words' weights); the document is toxic if any sentence is, by noisy-or with a leak:

    P = 1 - (1 - leak) * product over sentences of (1 - p(s))

The leak takes up labels that no sentence explains, so that the number of sentences alone does not add up to a toxic
document.  A word's weight is the sum of the weights of its features: the word and its first 3, 4 and 5 letters, which
carries over to inflected forms.  Only features get a weight that are commoner in documents of label 1 than chance would
explain: by Chernoff's bound on the binomial, fewer than one feature of all would be so by chance.  Weights, bias and
leak are fitted to the documents' labels alone by full-batch gradient steps, weights kept from falling below zero.
The sentences whose own probability reaches 1/2 are those that ``locate`` returns.

Classes, copies and the documents that hold a feature are counted by Spark over all labelled rows that are not held out.
Equal texts of one label are one text that carries its rows as weight, so copies count in the classes' shares but are
no evidence of their own for a feature.  The gradient steps take a bounded sample: of each class ``FIT_ROWS`` / 2
texts of any length, ``FIT_BYTES`` / 2 bytes together at most (one text at least), in the order of the text's hash over
its weight (priority sampling: a text with many copies is drawn surely and stands for them, the others stand for the
rest of their class).  Of the sample only the features with a weight to learn reach the driver, ``FIT_FEATURES`` at most
(those with the most evidence), as sentences with equal features and their number.  Scoring and locating cover every row
and whole texts.

Defined cases: null text is the empty text, whose score is the leak.  Rows with null id or null label are not learnt
from, and such ids are not held out; every row is scored, repeated rows each.  Without labels of both classes the score
is the share of label 1 (0 without labels).  An empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import drop_stored, store, table

FIT_ROWS = 6000
FIT_BYTES = FIT_ROWS * 20_000
FIT_FEATURES = 50_000  # features that the fit takes at most
FOLDS = 5
STEPS, RATE, DECAY = 200, 0.1, 1e-4
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
KEPT_WORDS = 120_000
FILTER_BITS = 1 << 25  # 4 MB
KEPT_COUNTS = 200_000  # features whose counts a task holds before it sends them on


def features(word: str) -> list[str]:
    return [f"{word}$", *[f"{word[:k]}-" for k in (3, 4, 5) if len(word) >= k]]


def bags(text: str | None) -> list[set[str]]:
    """The different words of each sentence that has any."""
    found = (set(WORD.findall(s)) for s in SENTENCE.findall((text or "").lower()))
    return [words for words in found if words]


@dataclass
class Model:
    """weights holds the features whose weight is not zero."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -40.0
    leak: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return self.weights, self.bias, self.leak

    def __setstate__(self, state):
        (self.weights, self.bias, self.leak), self.known = state, {}

    def word(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def logits(self, text: str | None) -> list[float]:
        return [self.bias + sum(map(self.word, sorted(words))) for words in bags(text)]

    def score(self, text: str | None) -> float:
        return self.combined(self.logits(text))

    def combined(self, logits: list[float]) -> float:
        total = np.logaddexp(0.0, np.array(logits, dtype=float)).sum() - np.log1p(-self.leak)
        return float(min(1.0, max(0.0, -np.expm1(-total))))

    def judged(self, text: str | None) -> tuple[float, int, int | None]:
        """The score, how many sentences reach probability 1/2, and the first one's place in the text."""
        logits, count, first = [], 0, None
        for s in SENTENCE.finditer(text or ""):
            if words := set(WORD.findall(s[0].lower())):
                logits.append(self.bias + sum(map(self.word, sorted(words))))
                if logits[-1] >= 0:
                    count, first = count + 1, s.start() if first is None else first
        return self.combined(logits), count, first


def feature_counts(texts: DataFrame) -> DataFrame:
    """Rows (feature, held_by, held_toxic): how many of the rows (toxic, text) hold a feature, those of label 1 apart."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, list[int]] = {}

        def sent() -> pd.DataFrame:
            out = pd.DataFrame({"feature": list(counts), "held_by": [n for n, _ in counts.values()],
                                "held_toxic": [n for _, n in counts.values()]})
            counts.clear()
            return out

        for part in parts:
            for toxic, text in zip(part["toxic"], part["text"]):
                words = set(WORD.findall((text or "").lower()))
                for f in {f for word in words for f in features(word)}:
                    held = counts.setdefault(f, [0, 0])
                    held[0] += 1
                    held[1] += int(toxic)
                if len(counts) >= KEPT_COUNTS:
                    yield sent()
        if counts:
            yield sent()

    return texts.select("toxic", "text").mapInPandas(run, "feature string, held_by long, held_toxic long").groupBy(
        "feature").agg(F.sum("held_by").alias("held_by"), F.sum("held_toxic").alias("held_toxic"))


def learnt(counts: DataFrame, n_texts: int, n_toxic: int, most: int = FIT_FEATURES) -> list[str]:
    """Features commoner in documents of label 1 than chance explains, those with the most evidence, in order."""
    share, base = F.col("held_toxic") / F.col("held_by"), F.lit(n_toxic / n_texts)
    excess = (F.when(share > 0, share * F.ln(share / base)).otherwise(0.0)
              + F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - base))).otherwise(0.0))
    least = float(np.log(max(counts.count(), 1)))
    evidence = F.col("held_by") * excess
    rows = counts.filter((share > base) & (evidence > least)).orderBy(evidence.desc(), "feature").limit(most).select(
        "feature").collect()
    return sorted(r["feature"] for r in rows)


def sparse_bags(text: str | None, ids: dict[str, int]) -> tuple[list[int], list[int], list[int]]:
    """Sentences of a text by their known features: how many have the same ones, how many ones, and these in a row."""
    groups = Counter(tuple(sorted(ids[f] for word in words for f in features(word) if f in ids)) for words in bags(text))
    order = sorted(groups)
    return [groups[g] for g in order], [len(g) for g in order], [f for g in order for f in g]


def fit(names: list[str], rows: list, labels: np.ndarray, weights: np.ndarray) -> Model:
    """Noisy-or over sentences, fitted to document labels; ``rows`` holds each document's ``sparse_bags``."""
    y = np.asarray(labels, dtype=float)
    weights = np.asarray(weights, dtype=float) / max(float(np.sum(weights)), 1e-9)
    often, doc, sentence, feature = array("d"), array("i"), array("i"), array("i")  # a fifth of what lists would take
    for d, (counts, sizes, ids) in enumerate(rows):
        for n, size in zip(counts, sizes):
            sentence.extend([len(doc)] * size)
            often.append(n)
            doc.append(d)
        feature.extend(ids)
    often = np.array(often)
    doc, sentence, feature = (np.array(x, dtype=np.int64) for x in (doc, sentence, feature))
    theta = np.zeros(len(names) + 2)  # weights, bias, leak's logit-like parameter
    theta[-2], theta[-1] = -9.0, -3.0
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, theta[feature], len(doc)) + theta[-2]
        total = np.bincount(doc, often * np.logaddexp(0, z), len(y)) + np.logaddexp(0, theta[-1])
        slope = weights * np.where(y > 0, -1 / np.expm1(np.maximum(total, 1e-6)), 1.0)
        by_sentence = slope[doc] * often / (1 + np.exp(-np.clip(z, -60, 60)))
        gradient = np.append(np.bincount(feature, by_sentence[sentence], len(names)),
                             [by_sentence.sum(), slope.sum() / (1 + np.exp(-theta[-1]))])
        mean, spread = 0.9 * mean + 0.1 * gradient, 0.999 * spread + 0.001 * gradient ** 2
        theta -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-6)
        theta[:-2] = np.maximum(theta[:-2] * (1 - RATE * DECAY), 0)
    return Model({f: float(theta[i]) for i, f in enumerate(names) if abs(theta[i]) > 1e-3}, float(theta[-2]),
                 float(-np.expm1(-np.logaddexp(0, theta[-1]))))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def may_hold(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A condition that is true of every value in ``column`` of ``keys`` and false of most others.

    Two bits for each value in a Bloom filter of ``FILTER_BITS`` bits, whatever the table's size: a fuller filter lets
    more other values through, and the join that follows takes them out.
    """
    def bits(value: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(value, F.lit(salt)), F.lit(FILTER_BITS)) for salt in (1, 2)]

    at = F.explode(F.array(*bits(F.col(column))))
    words = keys.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("mask")).toArrow()  # FILTER_BITS / 64 rows at most
    masks = np.zeros(FILTER_BITS // 64, np.int64)
    masks[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    filled = keys.sparkSession.sparkContext.broadcast(masks)

    @F.pandas_udf("boolean")
    def held(one: pd.Series, two: pd.Series) -> pd.Series:
        found = [filled.value[b.to_numpy() >> 6] >> (b.to_numpy() & 63) & 1 for b in (one, two)]
        return pd.Series((found[0] & found[1]).astype(bool))

    return lambda value: held(*bits(value))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (toxic, text_key, text, n): the texts of each label that are not held out, and how many rows have them."""
    return stored_labelled(docs, labels)[0]


def stored_labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """The rows of ``labelled`` as a stored table, and its path."""
    spark = docs.sparkSession
    labels = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out("doc_id")).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    docs = docs.filter(F.col("doc_id").isNotNull()).filter(~held_out("doc_id")).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    # ids and hashes first: of copies only the text of the smallest id is wanted, and only wanted texts are shuffled
    keys, path = store(spark, docs.select("doc_id", "text_key").join(labels.hint("merge"), "doc_id").groupBy(
        "toxic", "text_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")), "labelled-keys")
    wanted = docs.filter(may_hold(keys, "doc_id")(F.col("doc_id"))).groupBy("doc_id", "text_key").agg(
        F.any_value("text").alias("text"))
    texts, texts_path = store(spark, wanted.join(keys.hint("merge"), ["doc_id", "text_key"]).select(
        "toxic", "text_key", "text", "n"), "labelled")
    drop_stored(spark, path)
    return texts, texts_path


def sample(texts: DataFrame, toxic: int, rows: int, n_bytes: int) -> list[tuple[int, float]]:
    """(text_key, weight) of a bounded sample of a class by priorities; the weights add up to about the class's rows."""
    chance = (F.pmod(F.xxhash64("text_key"), F.lit(2 ** 53)) + F.lit(1)) / F.lit(float(2 ** 53))
    first = (texts.filter(F.col("toxic") == toxic)
             .select("text_key", "n", F.octet_length("text").alias("bytes"), (chance / F.col("n")).alias("priority"))
             .orderBy("priority", "text_key").limit(rows + 1).collect())
    taken, held = [], 0
    for r in first:
        if taken and (len(taken) >= rows or held + r["bytes"] > n_bytes):
            edge = r["priority"]  # the first that is left out
            return [(t["text_key"], max(t["n"], 1 / edge)) for t in taken]
        taken.append(r)
        held += r["bytes"]
    return [(t["text_key"], float(t["n"])) for t in taken]


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model:
    """Fit to labels (doc_id, toxic) of documents (doc_id, text) that are not held out."""
    spark = docs.sparkSession
    texts, texts_path = stored_labelled(docs, labels)
    classes = {r["toxic"]: r for r in texts.groupBy("toxic").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")
                                                                 ).collect()}
    if len(classes) < 2:
        return Model(leak=1 - 1e-9 if 1 in classes else 0.0)
    counts, counts_path = store(spark, feature_counts(texts), "features")
    names = learnt(counts, classes[0]["texts"] + classes[1]["texts"], classes[1]["texts"])
    weight = {}
    for label, row in sorted(classes.items()):
        drawn = sample(texts, label, fit_rows // 2, fit_bytes // 2)
        scale = row["n"] / sum(w for _, w in drawn)
        weight |= {(label, key): w * scale for key, w in drawn}
    known = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([(y, key, *sparse_bags(text, known.value)) for y, key, text in
                                zip(part["toxic"], part["text_key"], part["text"])],
                               columns=["toxic", "text_key", "counts", "sizes", "ids"])

    chosen = spark.createDataFrame(list(weight), "toxic int, text_key long")
    rows = texts.join(F.broadcast(chosen), ["toxic", "text_key"]).select("toxic", "text_key", "text").mapInPandas(
        run, "toxic int, text_key long, counts array<int>, sizes array<int>, ids array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["text_key"]))
    model = fit(names, [(r["counts"], r["sizes"], r["ids"]) for r in rows], np.array([r["toxic"] for r in rows]),
                np.array([weight[r["toxic"], r["text_key"]] for r in rows]))
    for path in (texts_path, counts_path):
        drop_stored(spark, path)
    return model


def scorer(model: Model) -> Callable[[Column], Column]:
    """The probability of a column of texts."""
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.score(t) for t in part], dtype="float64")

    return score


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the document's probability as the column ``out``, which must not be one of the table's."""
    if out in docs.columns:
        raise ValueError(f"the table has a column {out}; name another with out=")
    return docs.withColumn(out, scorer(model)(F.col(text)))


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows (doc_id, start, stop, sentence, probability) for the sentences that reach ``least``."""
    edge = float(np.log(least / (1 - least)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                for s in SENTENCE.finditer(text or ""):
                    words = set(WORD.findall(s[0].lower()))
                    z = model.bias + sum(map(model.word, sorted(words)))
                    if words and z >= edge:
                        rows.append((doc_id, s.start(), s.end(), s[0], 1 / (1 + np.exp(-z))))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "stop", "sentence", "probability"])

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, start long, stop long, sentence string, probability double")


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, score, n_offending, first_offending) for every row of ``docs``.

    The last two: how many sentences ``locate`` returns, and where in the text the first one starts (null without).
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [model.judged(t) for t in part.column("text").to_pylist()]
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.int64(), pa.int64())))],
                names=["doc_id", "score", "n_offending", "first_offending"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, n_offending long, first_offending long")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return judged(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                                      "n_offending", "first_offending")
