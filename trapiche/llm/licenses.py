"""License scans in DataFrame operations only: cosine to templates, then path inheritance."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import fresh, row_count
from trapiche.sinks.writers import store

LEAST_COSINE = 0.6

# How files commonly state their license, by its public short identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "This work is licensed under the GNU Affero General Public License, version 3",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Licensed under Creative Commons Attribution 4.0"),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "Licensed under Creative Commons Attribution-NonCommercial 4.0",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "Licensed under Creative Commons Attribution-ShareAlike 4.0",
    ),
    "CC0-1.0": ("Released into the public domain under CC0 1.0", "CC0 1.0 Universal"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "SPDX-License-Identifier: GPL-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "ISC": ("Released under the ISC License", "SPDX-License-Identifier: ISC"),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-3.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": ("All rights reserved", "Copyright. All rights reserved"),
}

# Words of a full text count as alike in its gate down to this part of the greatest squared weight.
GATE_STEP = 0.6
# Part of the squared weights of a full text that its words outside the heavy ones may have.
HEAVY_REST = 0.18

_SCORE = "struct<score: double, license: string>"


@functools.cache
def full_texts() -> dict[str, tuple[str, ...]]:
    """The full texts of the public licences, by identifier."""
    found = resources.files(__package__).joinpath("license_texts").iterdir()
    return {f.name.removesuffix(".txt"): (f.read_text("utf-8"),) for f in sorted(found, key=str)}


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def held_words(texts: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """`digest` of each text and `words`, the distinct template words that it holds.

    The only place where all texts are cut into words; stored, because frequencies and both
    gates read it.
    """
    held = F.array_intersect(_words(F.col("text")), _literals(vocabulary))
    return store(texts.select(_digest(F.col("text")).alias("digest"), held.alias("words")))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def inverse_frequencies(
    held: DataFrame, vocabulary: Sequence[str]
) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template word over all texts, and of any other word.

    Counted before the shuffle; the driver sees one number per template word.
    """
    words = held.select(F.explode("words").alias("word"))
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    documents = row_count(held)
    idf = {w: math.log((1 + documents) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
    return idf, math.log(1 + documents) + 1


def _literals(words: Sequence[str]) -> Column:
    """A constant array of template words, by one call whatever their number."""
    return F.expr(f"split('{' '.join(words)}', ' ')") if words else F.expr("array('')")


def _numbers(values: Iterable[float]) -> Column:
    """A constant array of numbers, by one call."""
    return F.expr(f"cast(split('{' '.join(map(repr, values))}', ' ') as array<double>)")


def _weight(count: float, idf: float) -> float:
    return (1 + math.log(count)) * idf


def unit_vector(words: Sequence[str], idf: Mapping[str, float]) -> dict[str, float]:
    vector = {w: _weight(n, idf[w]) for w, n in Counter(words).items()}
    norm = math.sqrt(sum(v * v for v in vector.values()))
    return {w: v / norm for w, v in vector.items()}


def markers(vector: Mapping[str, float], least: float) -> list[str]:
    """The heaviest words of a template without which no cosine reaches `least`.

    A text that shares only the other words has at most their norm as its cosine.
    """
    rest, chosen = 1.0, []
    for word, value in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if rest < least * least:
            break
        chosen.append(word)
        rest -= value * value
    return chosen


def gate(vector: Mapping[str, float]) -> list[tuple[list[str], float]]:
    """The words of a full text in groups of like weight, each with its greatest squared weight.

    No cosine is above the norm of the shared part of the template, so a text whose shared words
    have less than the squared cosine by these squares cannot reach it.
    """
    ranked = sorted(vector.items(), key=lambda x: (-x[1], x[0]))
    groups: list[tuple[list[str], float]] = []
    for word, value in ranked:
        if not groups or value * value < groups[-1][1] * GATE_STEP:
            groups.append(([], value * value))
        groups[-1][0].append(word)
    return groups


def _norm(words: Column, idf: Column, other: float) -> Column:
    """Length of the TF-IDF vector of all words, by one pass over the sorted words."""
    start = F.struct(
        F.lit("").alias("word"), F.lit(0.0).alias("count"), F.lit(0.0).alias("squares")
    )

    def closed(state: Column) -> Column:
        weight = (1 + F.log(state["count"])) * F.coalesce(idf[state["word"]], F.lit(other))
        return state["squares"] + F.when(state["count"] > 0, weight * weight).otherwise(0.0)

    def step(state: Column, word: Column) -> Column:
        same = state["word"] == word
        return F.struct(
            word.alias("word"),
            F.when(same, state["count"] + 1).otherwise(1.0).alias("count"),
            F.when(same, state["squares"]).otherwise(closed(state)).alias("squares"),
        )

    return F.sqrt(F.aggregate(F.array_sort(words), start, step, closed))


def _best(
    text: Column, vectors: Sequence[tuple[str, dict[str, float]]], idf: dict[str, float], other: float
) -> Column:
    """The template nearest to a text: struct(score, license); the later name on ties."""
    table = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair])
    known = F.array(*map(F.lit, idf))

    def scores(words: Column, own: Column, norm: Column) -> Column:
        def weight(word: str) -> Column:
            count = F.size(F.filter(own, lambda w: w == word)).cast("double")
            return F.when(count > 0, (1 + F.log(count)) * idf[word]).otherwise(0.0)

        return F.array_max(
            F.array(
                *[
                    F.struct(
                        (
                            sum((weight(w) * v for w, v in vector.items()), F.lit(0.0)) / norm
                        ).alias("score"),
                        F.lit(name).alias("license"),
                    )
                    for name, vector in vectors
                ]
            )
        )

    return _let(
        _words(text),
        lambda words: _let(
            F.struct(
                words.alias("words"),
                F.filter(words, lambda w: F.array_contains(known, w)).alias("own"),
                _norm(words, table, other).alias("norm"),
            ),
            lambda s: scores(s["words"], s["own"], s["norm"]),
        ),
    )


def heavy_words(vector: Mapping[str, float], least: float) -> tuple[list[str], int]:
    """The heaviest words of a full text, and how many of them any text within `least` shares.

    The other words have HEAVY_REST of the squares at most, so these must bring what is missing.
    """
    rest, words, mass, needed = 1.0, [], 0.0, 0
    ranked = sorted(vector.items(), key=lambda x: (-x[1], x[0]))
    for word, value in ranked:
        if rest <= HEAVY_REST:
            break
        words.append(word)
        rest -= value * value
    for word in words:
        if mass + 1e-9 >= least * least - max(rest, 0.0):
            break
        mass += vector[word] ** 2
        needed += 1
    return words, needed


def _passes(
    words: Column, vectors: Sequence[tuple[str, dict[str, float]]], least: float
) -> Column:
    """Whether these distinct words of a text are enough of some full text's words for it to be
    within `least` of that."""

    def mass(vector: dict[str, float]) -> Column:
        parts = [
            F.size(F.array_intersect(words, _literals(some))) * F.lit(greatest)
            for some, greatest in gate(vector)
        ]
        return sum(parts, F.lit(0.0))

    heavy = [heavy_words(vector, least) for _, vector in vectors]
    every = sorted({w for words, _ in heavy for w in words})
    fewest = min(needed for _, needed in heavy)
    enough = least * least - 1e-9

    def any_passes(own: Column) -> Column:
        tests = [
            (F.size(F.array_intersect(own, _literals(some))) >= needed) & (mass(vector) >= enough)
            for (some, needed), (_, vector) in zip(heavy, vectors)
        ]
        return functools.reduce(lambda x, y: x | y, tests)

    # The constant set of heavy words is built once, not for each text.
    return _let(
        F.filter(words, lambda w: w.isin(every)),
        lambda own: (F.size(own) >= fewest) & any_passes(own),
    )


def _with_digests(texts: DataFrame, digests: DataFrame) -> DataFrame:
    """`digest` and `text` of the texts that have one of these digests."""
    keyed = texts.select(_digest(F.col("text")).alias("digest"), "text")
    return keyed.join(store(digests.distinct()), "digest", "left_semi")


def full_matches(
    texts: DataFrame,
    held: DataFrame,
    vectors: Sequence[tuple[str, dict[str, float]]],
    idf: dict[str, float],
    other: float,
    least: float,
) -> DataFrame:
    """`digest` and `full`, the nearest full text, of each distinct text within `least` of one."""
    spark = texts.sparkSession
    passed = held.where(_passes(F.col("words"), vectors, least)).select("digest")
    counted = (
        _with_digests(texts, passed)
        .dropDuplicates(["digest"])
        .select("digest", F.explode(_words(F.col("text"))).alias("word"))
        .groupBy("digest", "word")
        .count()
    )
    forms = spark.range(1).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("license"),
                        F.lit(number).alias("form"),
                        F.arrays_zip(
                            _literals(list(vector)).alias("word"),
                            _numbers(vector.values()).alias("value"),
                        ).alias("words"),
                    )
                    for number, (name, vector) in enumerate(vectors)
                ]
            )
        ).alias("f")
    )
    forms = forms.select("f.license", "f.form", F.inline("f.words").alias("word", "value"))
    known = spark.range(1).select(
        F.inline(F.arrays_zip(_literals(list(idf)), _numbers(idf.values()))).alias("word", "idf")
    )
    weighed = counted.join(known, "word", "left").select(
        "digest",
        "word",
        ((1 + F.log("count")) * F.coalesce("idf", F.lit(other))).alias("weight"),
    )
    norms = weighed.groupBy("digest").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    dots = (
        weighed.join(forms, "word")
        .groupBy("digest", "form", "license")
        .agg(F.sum(F.col("weight") * F.col("value")).alias("dot"))
    )
    score = F.struct((F.col("dot") / F.col("norm")).alias("score"), "license")
    best = dots.join(norms, "digest").groupBy("digest").agg(F.max(score).alias("full"))
    return best.where(F.col("full")["score"] >= least)


def notice_matches(
    texts: DataFrame,
    held: DataFrame,
    templates: Mapping[str, Sequence[str]],
    idf: dict[str, float],
    other: float,
    least: float,
) -> DataFrame:
    """What notices say of each distinct text that is within `least` of one: `digest`; `spoken`,
    the nearest one of a text that has no word which the notices of that licence lack; `head`,
    the nearest one of the whole text and of its lines.
    """
    forms = [(name, template_words(text)) for name, found in templates.items() for text in found]
    vectors = [(name, unit_vector(words, idf)) for name, words in forms]
    marked = sorted({m for _, vector in vectors for m in markers(vector, least)})
    if not marked:
        nothing = [F.lit(None).cast(_SCORE).alias(c) for c in ("spoken", "head")]
        return held.select("digest", *nothing).where("false")
    may_match = rf"(?<![a-z0-9])(?:{'|'.join(marked)})(?![a-z0-9])"
    candidates = held.where(F.arrays_overlap("words", _literals(marked))).select("digest")
    lines = F.filter(F.split("text", "[\r\n]+"), lambda x: F.lower(x).rlike(may_match))
    # The words of each licence's notices: a file of nothing else is a licence file.
    said = F.create_map(
        *[
            x
            for name, found in templates.items()
            for x in (
                F.lit(name),
                _literals(sorted({w for text in found for w in template_words(text)})),
            )
        ]
    )

    def judged(best: Column) -> Column:
        only = F.size(F.array_except(_words(F.col("text")), said[best["license"]])) == 0
        return F.struct(best.alias("best"), only.alias("only"))

    # Texts without any marker are told by themselves and stay out of the join: by a plain
    # search for its letters first, by the borders of the word where these are found.
    marker_in = _let(
        F.lower("text"),
        lambda t: functools.reduce(lambda x, y: x | y, [F.contains(t, F.lit(m)) for m in marked])
        & t.rlike(may_match),
    )
    scored = _with_digests(texts.where(marker_in), candidates).select(
        "digest",
        _let(_best(F.col("text"), vectors, idf, other), judged).alias("whole"),
        F.array_max(F.transform(lines, lambda x: _best(x, vectors, idf, other))).alias("line"),
    )
    best = F.col("whole.best")
    spoken = F.when((best["score"] >= least) & F.col("whole.only"), best)
    head = _let(F.greatest(best, "line"), lambda x: F.when(x["score"] >= least, x))
    # Tested behind the aggregate: a filter on the scores would move below the join.
    return (
        scored.select("digest", spoken.alias("spoken"), head.alias("head"))
        .groupBy("digest")
        .agg(F.max("spoken").alias("spoken"), F.max("head").alias("head"))
        .where("head IS NOT NULL")
    )


def directory_of(path: Column) -> Column:
    """The path without its last part; the empty text for a path without directories."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, the empty one included, as structs (depth, directory)."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")
        ),
    )


def scan_licenses(
    files: DataFrame,
    path: Column,
    text_col: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    least: float = LEAST_COSINE,
    texts: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Every row with `license`, `score`, `origin` and `license_dir` beside its own columns.

    A file whose whole text is within `least` cosine of the full text of a licence (`texts`, the
    public ones by default), or is within it of a notice (`templates`) and has no word that the
    notices of that licence lack, is a licence file (`file`) and speaks for its directory. Else
    the better of its best line and its whole text against the notices counts (`header`). A file
    with neither inherits (`inherited`) from the licence file of its nearest directory upwards;
    of several in one directory the highest score counts, then the last name. Others have a
    null license and score 0. Null texts, empty texts and null paths match nothing; a null path
    inherits nothing. Names that `files` has already get an underscore. All texts are cut into
    words once; only those that share enough template words are scored, once per distinct text
    in its matches. Rows meet their text's match and their directory in joins that adaptive
    execution splits.
    """
    forms = [(name, template_words(text)) for name, found in templates.items() for text in found]
    texts = full_texts() if texts is None else texts
    wholes = [(name, template_words(text)) for name, found in texts.items() for text in found]
    vocabulary = sorted({w for _, words in forms for w in words})
    full_vocabulary = sorted({w for _, words in wholes for w in words})
    bodies = files.select(F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    known = sorted({*vocabulary, *full_vocabulary})
    held = held_words(bodies, known)
    every, other = inverse_frequencies(held, known)
    idf = {w: every[w] for w in vocabulary}
    matches = notice_matches(bodies, held, templates, idf, other, least)
    full = F.lit(None).cast(_SCORE)
    if wholes:
        full_idf = {w: every[w] for w in full_vocabulary}
        vectors = [(name, unit_vector(words, full_idf)) for name, words in wholes]
        matches = matches.join(
            full_matches(bodies, held, vectors, full_idf, other, least), "digest", "full"
        )
        full = F.col("full")
    matches = store(matches.select("digest", F.coalesce(full, "spoken").alias("own"), "head"))

    directory, digest, *result = fresh(
        files, "directory", "digest", "license", "score", "origin", "license_dir"
    )
    keyed = files.withColumns(
        {directory: directory_of(path), digest: _digest(F.col(f"`{text_col}`"))}
    )
    speaking = (
        keyed.select(F.col(directory).alias("directory"), F.col(digest).alias("digest"))
        .where("directory IS NOT NULL")
        .join(matches.where("own IS NOT NULL"), "digest")
    )
    licensed = store(speaking.groupBy("directory").agg(F.max("own").alias("found")))
    directories = keyed.select(F.col(directory).alias("of")).where("of IS NOT NULL").distinct()
    above = directories.select("of", F.inline(_ancestors(F.col("of"))))
    nearest = store(
        above.join(licensed, F.col("above") == F.col("directory"))
        .groupBy("of")
        .agg(F.max(F.struct("depth", "above", "found")).alias("nearest"))
    )
    rows = (
        keyed.alias("rows")
        .join(matches.alias("own"), F.col(f"rows.{digest}") == F.col("own.digest"), "left")
        .join(nearest.alias("near"), F.col(f"rows.{directory}") == F.col("near.of"), "left")
    )
    own, head = F.col("own.own"), F.col("own.head")
    inherited = F.col("near.nearest.found")
    found = F.coalesce(own, head, inherited)
    origin = (
        F.when(own.isNotNull(), "file")
        .when(head.isNotNull(), "header")
        .when(inherited.isNotNull(), "inherited")
    )
    return rows.select(
        *[F.col(f"rows.`{c}`") for c in files.columns],
        found["license"].alias(result[0]),
        F.round(F.coalesce(found["score"], F.lit(0.0)), 6).alias(result[1]),
        origin.alias(result[2]),
        F.when(origin == "inherited", F.col("near.nearest.above")).alias(result[3]),
    )
