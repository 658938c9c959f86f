"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trapiche.llm.common import fresh, named

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
UNDETERMINED = "und"
# Labelled rows that the classifier is fitted on, at most, in even shares per language.
TRAINING_ROWS = 4_000
FOLDS = 5
# Characters counted at a time, which bounds the memory of a very long text.
BLOCK = 1 << 20
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space for what is no letter."""
    points = map(chr, range(sys.maxunicode + 1))
    return np.array([ord(c.lower()[0]) if c.isalpha() else SPACE for c in points], np.uint32)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram of letters occurs; None for a text without letters."""
    counts, seen = np.zeros(FEATURES, np.int64), False
    text = text or ""
    for start in range(0, len(text), BLOCK):
        # Blocks overlap, so that n-grams across a border are counted once.
        lead = min(start, max(ORDERS) - 1)
        raw = text[start - lead : start + BLOCK].encode("utf-32-le", "surrogatepass")
        chars = _letters()[np.frombuffer(raw, "<u4")]
        seen = seen or bool((chars[lead:] != SPACE).any())
        value = np.zeros(len(chars), np.uint32)
        for order in ORDERS:
            # value[i] holds the n-gram that ends at i.
            value[order - 1 :] = (
                value[order - 2 : len(chars) - 1] if order > 1 else 0
            ) * np.uint32(0x01000193) + chars[order - 1 :]
            ends = value[max(order - 1, lead) :] * np.uint32(0x9E3779B1)
            ends ^= np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)
            counts += np.bincount((ends * np.uint32(0xC2B2AE35)) >> np.uint32(17), minlength=FEATURES)
    return counts if seen else None


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, the number of documents that hold each feature; feature -1 counts documents."""
    held, documents = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for i in range(batch.num_rows):
            counts = ngram_counts(batch["text"][i].as_py())
            if counts is not None:
                held += counts > 0
                documents += 1
    used = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(held[used], documents))],
        ["feature", "documents"],
    )


@dataclass(frozen=True)
class Weights:
    """A fitted classifier; all of it has a size fixed by FEATURES and the languages."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        scores = self.weights[:, used] @ tfidf(used, counts, self.idf) + self.bias
        return softmax(scores / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if self.languages else None
        if counts is None:
            return UNDETERMINED, 0.0
        used = np.flatnonzero(counts)
        odds = self.probabilities(used, counts[used])
        best = int(odds.argmax())
        return self.languages[best], float(odds[best])


def tfidf(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic counts times inverse document frequency, of length one."""
    values = (1 + np.log(counts)) * idf[used]
    return values / max(np.linalg.norm(values), 1e-12)


def softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=0))
    return odds / odds.sum(axis=0)


def fit_ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    classes: int,
    features: int,
    l1: float = 0.005,
    l2: float = 0.005,
    alpha: float = 1.0,
    beta: float = 1.0,
    epochs: int = 3,
    seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader with elastic net over rows (class, features, values).

    Weights are a closed form of the gradient sums z and squared gradients n of a coordinate:
    zero while |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt n) / alpha + l2). The last
    coordinate is the bias.
    """
    z, n = np.zeros((classes, features + 1)), np.zeros((classes, features + 1))

    def leader(at) -> np.ndarray:
        shrunk = np.maximum(np.abs(z[:, at]) - l1, 0) * np.sign(z[:, at])
        return -shrunk / ((beta + np.sqrt(n[:, at])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, used, values = rows[i]
            at, x = np.append(used, features), np.append(values, 1.0)
            w = leader(at)
            wrong = softmax(w @ x)
            wrong[label] -= 1
            gradient = wrong[:, None] * x
            step = (np.sqrt(n[:, at] + gradient**2) - np.sqrt(n[:, at])) / alpha
            z[:, at] += gradient - step * w
            n[:, at] += gradient**2
    w = leader(slice(None))
    return w[:, :features].astype(np.float32), w[:, features]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of scores (classes x rows) under which the labels are likeliest."""
    if scores.shape[1] == 0:
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    rows = np.arange(len(labels))
    loss = [-np.log(softmax(scores / t)[labels, rows] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def held_out(id_column: Column) -> Column:
    """One of five by the crc32 of the id as text; a row without id is held out too."""
    fold = F.crc32(id_column.cast("string")) % FOLDS
    return F.coalesce(fold == 0, F.lit(True))


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """At most `rows` labelled rows (id, text, lang): even shares per language, by a hash."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return labelled
    share = max(2, rows // len(sizes))
    at = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # About twice the share passes the threshold, so the ranking sees a bounded number of rows.
    bound = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, 2.0 * share / n)])
    chosen = labelled.select("*", at.alias("at")).where(F.col("at") < bound[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at", "id"))
    ranked = chosen.select("id", "text", "lang", rank.alias("rank"))
    return ranked.where(F.col("rank") <= share).select("id", "text", "lang")


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [_packed(ngram_counts(t.as_py())) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["lang"], pa.array(packed, pa.binary())], ["id", "lang", "packed"]
        )


def _packed(counts: np.ndarray | None) -> bytes | None:
    """Used features, then how often each occurs."""
    if counts is None:
        return None
    used = np.flatnonzero(counts)
    return np.stack([used, counts[used]]).astype("<i4").tobytes()


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAINING_ROWS,
) -> Weights:
    """Fit on the rows that are not held out and have a language.

    Document frequencies count all of them. The classifier is fitted on a sample of at most
    `rows` of them; a fifth of the sample sets the temperature instead. Nothing to learn from
    gives a classifier without languages.
    """
    labelled = named(docs, id=id_col, text=text_col, lang=lang_col).where(
        ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    frequencies = (
        labelled.select("text")
        .mapInArrow(_document_frequencies, "feature long, documents long")
        .groupBy("feature")
        .sum("documents")
        .collect()
    )
    held, documents = np.zeros(FEATURES), 0
    for feature, count in frequencies:
        if feature < 0:
            documents = count
        else:
            held[feature] = count
    idf = np.log((1 + documents) / (1 + held)) + 1
    sample = _sample(labelled, rows).mapInArrow(
        _sparse, "id long, lang string, packed binary"
    )
    collected = sample.where("packed IS NOT NULL").collect()
    collected.sort(key=lambda r: (r["id"], r["lang"], bytes(r["packed"])))
    languages = tuple(sorted({r["lang"] for r in collected}))
    if not languages:
        return Weights((), idf, np.zeros((0, FEATURES), np.float32), np.zeros(0), 1.0)
    ready = []
    for r in collected:
        used, counts = np.frombuffer(r["packed"], "<i4").reshape(2, -1).astype(np.int64)
        ready.append((languages.index(r["lang"]), used, tfidf(used, counts, idf)))
    fitted, spared = [r for i, r in enumerate(ready) if i % 5], ready[::5]
    if len({label for label, _, _ in fitted}) < len(languages):
        fitted, spared = ready, []
    weights, bias = fit_ftrl(fitted, len(languages), FEATURES)
    scores = [weights[:, used] @ values + bias for _, used, values in spared]
    labels = np.array([label for label, _, _ in spared], int)
    stacked = np.array(scores).T.reshape(len(languages), len(spared))
    return Weights(languages, idf, weights, bias, fit_temperature(stacked, labels))


def predict_of(text: Column, model: Weights) -> Column:
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score"])

    # Not called deterministic, lest a filter on the result computes it a second time.
    return predict.asNondeterministic()(text)


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model: Weights | None = None,
) -> DataFrame:
    """Every row with `held_out`, `lang_pred` and `score` beside its own columns.

    Names that `docs` has already get an underscore. A prediction reads the text alone, all of
    it. Null texts and texts without a letter are `und` with score 0, and so is everything when
    there is nothing to learn from. Rows without an id are held out. An empty table gives an
    empty result. Nothing is shuffled but feature counts and the training sample.
    """
    model = model or train(docs, id_col, text_col, lang_col)
    found, *result = fresh(docs, "found", "held_out", "lang_pred", "score")
    judged = docs.withColumn(found, predict_of(F.col(f"`{text_col}`"), model))
    return judged.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        held_out(F.col(f"`{id_col}`")).alias(result[0]),
        F.col(f"{found}.lang_pred").alias(result[1]),
        F.col(f"{found}.score").alias(result[2]),
    )
