"""Toxicity by a classifier chain over bag-of-words models."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trapiche.llm.common import fresh, named
from trapiche.llm.language import fit_ftrl

FEATURES = 1 << 18
# Labelled rows that the chain is fitted on, at most, in even shares per combination of labels.
TRAINING_ROWS = 6_000
FOLDS = 5
THRESHOLD = 0.5
# Lengths of the word beginnings that are features of their own.
STEMS = (4, 5, 6, 7)

_WORD = re.compile(r"\w+")


def word_features(text: str | None) -> np.ndarray:
    """The hashed distinct words of the whole text and their beginnings, in order.

    Beginnings stand for stems, so that a form that training never saw still counts.
    """
    words = set(_WORD.findall((text or "").lower()))
    stems = {w[:n] + "-" for w in words for n in STEMS if len(w) >= n}
    hashes = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words | stems]
    return np.unique(np.array(hashes, np.int64) % FEATURES)


@dataclass(frozen=True)
class Link:
    """A logistic model of one category: weights of words, of earlier categories, and a bias."""

    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def probability(
        self, used: np.ndarray, before: Sequence[float], shift: float = 0.0
    ) -> float:
        score = self.weights[used].sum() + self.earlier @ np.array(before, float) + self.bias
        return float(1 / (1 + np.exp(-np.clip(score + shift, -500, 500))))


def fit_link(rows: list[tuple[int, np.ndarray, list[float]]], chained: int) -> Link:
    """Elastic-net logistic regression over rows (label, words, earlier probabilities)."""
    extra = np.arange(FEATURES, FEATURES + chained)
    ready = [
        (label, np.append(used, extra), np.append(np.ones(len(used)), before))
        for label, used, before in rows
    ]
    weights, bias = fit_ftrl(ready, 2, FEATURES + chained, l1=5.0, l2=0.01, alpha=0.3)
    own = weights[1] - weights[0]
    return Link(own[:FEATURES], own[FEATURES:].astype(float), float(bias[1] - bias[0]))


@dataclass(frozen=True)
class Chain:
    """Models in chain order. `shifts` turn odds in the even sample into odds among all labels."""

    categories: tuple[str, ...]
    links: tuple[Link, ...]
    shifts: tuple[float, ...]

    def probabilities(self, text: str | None) -> list[float]:
        used = word_features(text)
        if not len(used):
            return [0.0] * len(self.links)
        before: list[float] = []
        found = []
        for link, shift in zip(self.links, self.shifts):
            found.append(link.probability(used, before, shift))
            before.append(link.probability(used, before))
        return found


def prior_shift(sampled: tuple[int, int], whole: tuple[int, int]) -> float:
    """Difference in log odds between (outside, inside) counts of all labels and of a sample."""
    if 0 in sampled or 0 in whole:
        return 0.0
    return float(np.log(whole[1] / whole[0]) - np.log(sampled[1] / sampled[0]))


def fit_chain(
    rows: list[tuple[np.ndarray, list[int]]], categories: Sequence[str], folds: int = FOLDS
) -> Chain:
    """Fit the categories in order.

    What a later model learns from earlier categories are probabilities of models that did not
    see the row: each row's fold is predicted by models of the other folds. The models that the
    chain keeps are fitted on all rows.
    """
    before: list[list[float]] = [[] for _ in rows]
    links = []
    for k in range(len(categories)):
        labelled = [(labels[k], used, list(b)) for (used, labels), b in zip(rows, before)]
        links.append(fit_link(labelled, k))
        for fold in range(folds):
            inside = range(fold, len(rows), folds)
            others = [r for i, r in enumerate(labelled) if i % folds != fold]
            model = fit_link(others, k)
            for i in inside:
                before[i].append(model.probability(rows[i][0], labelled[i][2]))
    return Chain(tuple(categories), tuple(links), (0.0,) * len(links))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        used = [word_features(t.as_py()).astype("<i4").tobytes() for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["labels"], pa.array(used, pa.binary())], ["id", "labels", "used"]
        )


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    rows: int = TRAINING_ROWS,
) -> Chain | None:
    """Fit on labelled documents, at most `rows` of them; None when there are none.

    `categories` names each category, in chain order, with an SQL condition over `labels`; a null
    condition counts as not in the category, and rows with no label at all are left out. Of
    documents that share an id one text is taken.
    """
    conditions = [F.expr(c) for c in categories.values()]
    marks = F.array(*[F.coalesce(c, F.lit(False)).cast("int") for c in conditions])
    known = reduce(Column.__or__, [c.isNotNull() for c in conditions])
    label_rows = labels.where(known).select(
        F.col(f"`{label_id_col}`").alias("label_id"), marks.alias("labels")
    )
    # One label per document: of several the largest.
    label_rows = label_rows.groupBy("label_id").agg(F.max("labels").alias("labels"))
    sizes = {tuple(r["labels"]): r["count"] for r in label_rows.groupBy("labels").count().collect()}
    if not sizes:
        return None
    share = max(2, rows // len(sizes))
    at = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / float(1 << 30)
    bound = F.lit(0.0)
    for combination, n in sizes.items():
        this = F.col("labels") == F.array(*map(F.lit, combination))
        bound = F.when(this, F.lit(2.0 * share / n)).otherwise(bound)
    chosen = label_rows.select("*", at.alias("at")).where(F.col("at") < bound)
    rank = F.row_number().over(Window.partitionBy("labels").orderBy("at", "label_id"))
    chosen = chosen.select("*", rank.alias("rank")).where(F.col("rank") <= share)
    # At most `rows` ids: small enough for every task, whatever the number of documents.
    texts = named(docs, id=id_col, text=text_col).join(
        F.broadcast(chosen), F.col("id") == F.col("label_id")
    )
    # An id that repeats gives one text, so that what is collected stays within `rows`.
    one_each = texts.groupBy("id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.max("labels").alias("labels")
    )
    collected = (
        one_each.select("id", "text", "labels")
        .mapInArrow(_features, "id long, labels array<int>, used binary")
        .collect()
    )
    if not collected:
        return None
    collected.sort(key=lambda r: (r["id"], bytes(r["used"]), r["labels"]))
    ready = [(np.frombuffer(r["used"], "<i4").astype(np.int64), list(r["labels"])) for r in collected]
    chain = fit_chain(ready, list(categories))

    def counts(k: int, rows: Iterable[tuple[Sequence[int], int]]) -> tuple[int, int]:
        rows = list(rows)
        return sum(n for y, n in rows if not y[k]), sum(n for y, n in rows if y[k])

    shifts = tuple(
        prior_shift(counts(k, ((y, 1) for _, y in ready)), counts(k, sizes.items()))
        for k in range(len(categories))
    )
    return replace(chain, shifts=shifts)


def score_toxicity(
    docs: DataFrame,
    chain: Chain | None,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    categories: Sequence[str] = (),
) -> DataFrame:
    """Every row with `p_<category>` per category, and `flagged` for the last one.

    Names that `docs` has already get an underscore. Null texts and texts without words have
    probability 0 throughout, and so has everything without a chain, whose categories are then
    named by `categories`. An empty table gives an empty result. Nothing is shuffled.
    """
    categories = chain.categories if chain else tuple(categories)
    fields = [f"p{i}" for i in range(len(categories))]

    @F.pandas_udf(", ".join(f"{f} double" for f in fields))
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = [chain.probabilities(t) if chain else [0.0] * len(fields) for t in batch]
            yield pd.DataFrame(odds, columns=fields, dtype=float)

    found, flagged, *names = fresh(docs, "found", "flagged", *[f"p_{c}" for c in categories])
    # Not called deterministic, lest a filter on the result computes it a second time.
    judged = docs.withColumn(found, scores.asNondeterministic()(F.col(f"`{text_col}`")))
    return judged.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"{found}.{f}").alias(n) for f, n in zip(fields, names)],
        (F.col(f"{found}.{fields[-1]}") >= threshold).alias(flagged),
    )
