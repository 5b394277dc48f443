"""Personal data in free text: a semi-Markov conditional random field over candidate segments.

The field scores whole segments, not single words: a candidate's score is the sum of its features' weights, and so is
that of two entities that follow each other. A text's labelling is a set of candidates of which none overlap; what lies
between has score 0. Dynamic programming over the candidates, whose length is bounded by their patterns, finds the best
labelling, and with it boundaries and kinds at once. Texts are looked at one by one, so nothing is shuffled.

The weights come from :mod:`distriq.llm.pii_train`, which fits them on a bounded sample.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distriq.llm.pii_lattice import REACH, Candidate, Floor, candidates, clusters, link

WEIGHTS = Path(__file__).with_name("pii_weights.json")


class Weights(dict):
    """Weights of features; one that isn't known has 0."""

    def __missing__(self, feature: str) -> float:
        return 0.0


def load_weights(path: str | Path = WEIGHTS) -> dict[str, float]:
    return Weights(json.loads(Path(path).read_text(encoding="utf-8")))


@lru_cache(maxsize=4)
def _default_weights() -> dict[str, float]:
    return load_weights()


_FLOORS: list[Floor] = []


def _floor(weights: dict[str, float]) -> Floor:
    """The floor of these weights, worked out once."""
    if not _FLOORS or _FLOORS[0].weights is not weights:
        _FLOORS[:] = [Floor(weights)]
    return _FLOORS[0]


def score(features: tuple[str, ...], weights: dict[str, float]) -> float:
    return sum(map(weights.__getitem__, features)) if isinstance(weights, Weights) else sum(weights.get(f, 0.0) for f in features)


def predecessors(cluster: list[Candidate]) -> list[tuple[int, list[int]]]:
    """Of each candidate (before, near): the candidates that end before it, in the order of their ends, are those beyond
    its reach, ``before`` of them, and then those ``near`` it, of which there are as many as reach has room for.
    """
    ends = sorted(range(len(cluster)), key=lambda i: cluster[i].end)
    out, far, close = [], 0, 0
    for c in cluster:  # by start, so both bounds only move on
        while close < len(ends) and cluster[ends[close]].end <= c.start:
            close += 1
        while far < close and cluster[ends[far]].end < c.start - REACH:
            far += 1
        out.append((far, ends[far:close]))
    return out


def best_path(cluster: list[Candidate], weights: dict[str, float]) -> list[Candidate]:
    """The labelling of a cluster with the highest score; of equal ones the one with fewer entities.

    Of all labellings that end beyond a candidate's reach only the best one matters to it, so the work grows with the
    number of candidates, not of their pairs.
    """
    if len(cluster) == 1:
        return cluster if score(cluster[0].features, weights) > 0 else []
    ends = sorted(range(len(cluster)), key=lambda i: cluster[i].end)
    best = [0.0] * len(cluster)
    back = [-1] * len(cluster)
    far_best, far_at, passed = 0.0, -1, 0
    for i, (far, near) in enumerate(predecessors(cluster)):
        while passed < far:
            j = ends[passed]
            passed += 1
            if best[j] > far_best:
                far_best, far_at = best[j], j
        value, at = far_best, far_at
        for j in near:
            here = best[j] + score(link(cluster[j], cluster[i]), weights)
            if here > value:
                value, at = here, j
        best[i], back[i] = value + score(cluster[i].features, weights), at
    top = max(range(len(cluster)), key=lambda i: best[i])
    if best[top] <= 0:
        return []
    out = []
    while top >= 0:
        out.append(cluster[top])
        top = back[top]
    return out[::-1]


def marginals(cluster: list[Candidate], weights: dict[str, float]) -> tuple[float, list[float], dict[tuple[int, int], float]]:
    """Log of the partition function, the probabilities of each candidate, and of each pair of successive entities within reach."""
    own = [score(c.features, weights) for c in cluster]
    ends = sorted(range(len(cluster)), key=lambda i: cluster[i].end)
    before = predecessors(cluster)
    links = [{j: score(link(cluster[j], c), weights) for j in near} for c, (_, near) in zip(cluster, before)]
    forward = [0.0] * len(cluster)
    sums = [0.0]  # of nothing and of the labellings that end with each of the first so many, by their ends
    for i, (far, near) in enumerate(before):
        while len(sums) <= far:
            sums.append(_log_sum([sums[-1], forward[ends[len(sums) - 1]]]))
        forward[i] = own[i] + _log_sum([sums[far], *(forward[j] + links[i][j] for j in near)])
    # what can follow a candidate: nothing, what is near, and all that begin beyond its reach
    after: list[list[float]] = [[0.0] for _ in cluster]
    backward = [0.0] * len(cluster)
    later = [-math.inf] * (len(cluster) + 1)  # by start, of those from each on
    begins = [c.start for c in cluster]
    for i in range(len(cluster) - 1, -1, -1):
        backward[i] = _log_sum([*after[i], later[bisect_right(begins, cluster[i].end + REACH)]])
        later[i] = _log_sum([later[i + 1], own[i] + backward[i]])
        for j in before[i][1]:
            after[j].append(links[i][j] + own[i] + backward[i])
    # a labelling ends with some candidate or has none
    total = _log_sum([0.0, *forward])
    single = [math.exp(f + b - total) for f, b in zip(forward, backward)]
    pairs = {(j, i): math.exp(forward[j] + links[i][j] + own[i] + backward[i] - total) for i, (_, near) in enumerate(before) for j in near}
    return total, single, pairs


def _log_sum(values: list[float]) -> float:
    top = max(values)
    if top == -math.inf:
        return top
    return top + math.log(sum(math.exp(v - top) for v in values))


def mentions(text: str, weights: dict[str, float] | None = None) -> list[Candidate]:
    """The personal data of a text, in order, none overlapping."""
    weights = _default_weights() if weights is None else weights
    return [c for cluster in clusters(candidates(text, _floor(weights))) for c in best_path(cluster, weights)]


def masked(text: str, found: list[Candidate]) -> str:
    """``text`` with ``[KIND]`` in place of each mention; all else is left as it is."""
    out, at = [], 0
    for c in found:
        out += [text[at : c.start], f"[{c.kind}]"]
        at = c.end
    return "".join([*out, text[at:]])


MENTIONS = "doc_id long, kind string, start_pos int, end_pos int, mention string"


def find_mentions(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per mention: doc_id, kind, start_pos and end_pos (of its first and last character, counted from 1 in Unicode characters), mention.

    NULL and empty texts have none. A document that comes twice gives its rows twice.
    """

    weights = _default_weights()  # goes with the function, so that workers need no file

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MENTIONS.split(", ")]
        for batch in batches:
            yield pd.DataFrame([(d, c.kind, c.start + 1, c.end, t[c.start : c.end]) for d, t in zip(batch["d"].tolist(), batch["t"].tolist()) for c in mentions(t, weights)], columns=names)

    return documents.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t")).filter(F.length("t") > 0).mapInPandas(scan, MENTIONS)


def redact(documents: DataFrame, text: str = "text", into: str = "redacted") -> DataFrame:
    """``documents`` with column ``into``: the text with a typed placeholder for each mention. NULL stays NULL.

    All rows and columns are kept; a column already called ``into`` is replaced.
    """

    weights = _default_weights()

    @F.pandas_udf("string")
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([masked(t, mentions(t, weights)) if t else t for t in texts], dtype=object)

    return documents.withColumn(into, replaced(F.col(f"`{text}`")))
