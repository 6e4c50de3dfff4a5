"""Toxicity by the nearest labelled examples (operator 5).

The examples are a bounded sample of labelled rows, held as TF-IDF vectors over the terms
that go with the label. A text is scored by the votes of its nearest examples by cosine,
found exactly in an inverted index with block maxima.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, shared_table, text_blocks, text_bytes

MAX_EXAMPLES = 20_000  # labelled rows the model is fitted on, those with the least hash
MAX_TERMS = 4096
# A term is kept if its chi-square against the label reaches this: beyond what chance
# gives the best of a million terms.
MIN_CHI2 = 30.0
NEIGHBOURS = 25
BLOCK = 64
THRESHOLD = 0.3

_TERM = re.compile(r"[^\W\d_]+")


def term_counts(text: bytes | None) -> Counter[str]:
    return Counter(_TERM.findall((text or b"").decode().lower()))


class Index(NamedTuple):
    """Examples in blocks of ``BLOCK``, and for each term its postings by block.

    Term t has entries ``starts[t]:starts[t + 1]``: a block, the greatest weight in it,
    and the postings ``first[e]:first[e + 1]`` of examples in it.
    """

    vocabulary: dict[str, int]
    idf: np.ndarray
    starts: np.ndarray
    blocks: np.ndarray
    maxima: np.ndarray
    first: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    labels: np.ndarray
    ids: np.ndarray


def weigh(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a unit TF-IDF vector."""
    terms = np.array(sorted(counts), dtype=np.int64)
    values = (1 + np.log([counts[t] for t in terms.tolist()])) * idf[terms]
    return terms, values / (np.linalg.norm(values) or 1.0)


def build_index(
    vocabulary: list[str], idf: np.ndarray, vectors: list, labels: np.ndarray, ids: np.ndarray
) -> Index:
    """Index of examples ``(terms, weights)``; similar ones are put in one block."""
    lead = [tuple(terms[np.argsort(-weights, kind="stable")].tolist()) for terms, weights in vectors]
    order = sorted(range(len(vectors)), key=lambda i: (lead[i], ids[i]))
    by_term: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
    for place, i in enumerate(order):
        for term, weight in zip(vectors[i][0].tolist(), vectors[i][1].tolist()):
            by_term[term].append((place, weight))
    starts, blocks, maxima, first, examples, weights = [0], [], [], [0], [], []
    for own in by_term:
        for place, weight in own:
            if len(blocks) == starts[-1] or blocks[-1] != place // BLOCK:
                blocks.append(place // BLOCK)
                maxima.append(0.0)
                first.append(first[-1])
            maxima[-1] = max(maxima[-1], weight)
            first[-1] += 1
            examples.append(place)
            weights.append(weight)
        starts.append(len(blocks))
    return Index(
        {term: n for n, term in enumerate(vocabulary)},
        idf,
        *(np.array(x, dtype=np.int64) for x in (starts, blocks)),
        np.array(maxima),
        *(np.array(x, dtype=np.int64) for x in (first, examples)),
        np.array(weights),
        labels[order],
        ids[order],
    )


def nearest(
    index: Index, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1
) -> tuple[np.ndarray, np.ndarray]:
    """The k examples of largest cosine above 0, ties to the earlier; exact.

    Blocks are visited by their upper bound, the sum of the query's weights times the
    block maxima, a few at a time, until no block left can reach the k-th best. ``skip``
    is left out.
    """
    entries = [np.arange(index.starts[t], index.starts[t + 1]) for t in terms.tolist()]
    entry = np.concatenate([*entries, np.zeros(0, dtype=np.int64)])
    best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0)
    if not len(entry):
        return best_ids, best
    of_query = np.repeat(weights, [len(e) for e in entries])
    places, row = np.unique(index.blocks[entry], return_inverse=True)
    bounds = np.bincount(row, weights=of_query * index.maxima[entry], minlength=len(places))
    visit = np.argsort(-bounds, kind="stable")
    bounds, places = bounds[visit], places[visit]
    turn = np.empty(len(visit), dtype=np.int64)
    turn[visit] = np.arange(len(visit))
    turns = turn[row]
    order = np.argsort(turns, kind="stable")
    entry, of_query, turns = entry[order], of_query[order], turns[order]
    done, step = 0, 8
    while done < len(places):
        least = best[-1] - 1e-9 if len(best) == k else 0.0
        stop = min(done + step, int(np.searchsorted(-bounds, -least, side="right")))
        if stop <= done:
            break
        low, high = np.searchsorted(turns, (done, stop))
        own = entry[low:high]
        sizes = index.first[own + 1] - index.first[own]
        posting = np.repeat(index.first[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        slot = np.repeat(turns[low:high] - done, sizes) * BLOCK + index.examples[posting] % BLOCK
        values = np.repeat(of_query[low:high], sizes) * index.weights[posting]
        scores = np.bincount(slot, weights=values, minlength=(stop - done) * BLOCK)
        hit = np.flatnonzero(scores)
        ids = places[done + hit // BLOCK] * BLOCK + hit % BLOCK
        scores = np.concatenate([best, scores[hit][ids != skip]])
        ids = np.concatenate([best_ids, ids[ids != skip]])
        top = np.lexsort((ids, -np.round(scores, 9)))[:k]
        best_ids, best = ids[top], scores[top]
        done, step = stop, 2 * step
    return best_ids, best


def vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    """Share of positive labels, each weighed by the inverse of its distance."""
    weights = 1 / (0.05 + np.maximum(0.0, 1 - cosines))
    return float((weights * labels).sum() / weights.sum())


class Calibration(NamedTuple):
    """Non-decreasing steps from votes to probabilities; ``none`` for texts without
    an example near them."""

    votes: np.ndarray
    shares: np.ndarray
    none: float

    def __call__(self, value: float | None) -> float:
        if value is None or not len(self.votes):
            return self.none
        return float(np.interp(value, self.votes, self.shares))


def calibrate(votes: list[float | None], labels: np.ndarray, least: int = 20) -> Calibration:
    """Shares of positive labels by vote, pooled until they rise (isotonic fit).

    ``least`` rows are pooled at the least. Shares are smoothed by one row each way.
    """
    without = [y for v, y in zip(votes, labels) if v is None]
    none = (sum(without) + 0.0) / max(1, len(without))
    pairs = sorted((v, y) for v, y in zip(votes, labels) if v is not None)
    pools: list[list[float]] = []  # rows, sum of votes, sum of labels
    for i, (v, y) in enumerate(pairs):
        if pools and pools[-1][0] < least:
            pools[-1] = [pools[-1][0] + 1, pools[-1][1] + v, pools[-1][2] + y]
        else:
            pools.append([1, v, y])
        full = pools[-1][0] >= least or i == len(pairs) - 1
        while full and len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    shares = [(y + 1) / (n + 2) for n, _, y in pools]
    return Calibration(np.array([v / n for n, v, _ in pools]), np.maximum.accumulate(shares or [0.0])[: len(pools)], none)


class Model(NamedTuple):
    index: Index
    calibration: Calibration
    k: int

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, float]]]:
        """Probability, and the nearest examples with their cosines as evidence."""
        known = self.index.vocabulary
        found = Counter(t for t in _TERM.findall((text or b"").decode().lower()) if t in known)
        counts = {known[term]: n for term, n in found.items()}
        if not counts:
            return self.calibration.none, []
        places, cosines = nearest(self.index, *weigh(counts, self.index.idf), self.k)
        if not len(places):
            return self.calibration.none, []
        value = self.calibration(vote(self.index.labels[places], cosines))
        return value, list(zip(self.index.ids[places].tolist(), cosines.tolist()))


def held_out(id_col):
    """Rows no label is learned from: crc32 of the id as text is 2 modulo 4."""
    part = F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2
    return F.coalesce(part, F.lit(False))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
    k: int = NEIGHBOURS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit to at most ``max_examples`` labelled rows that are not held out.

    Rows without an id or a label are left out; of several labels of a document the
    largest counts. What reaches the driver is bounded by ``max_examples`` vectors over
    ``MAX_TERMS`` terms.
    """
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y"))
    known = known.filter("_id IS NOT NULL AND _y IS NOT NULL").filter(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg((F.max("_y") > 0).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(max_examples)
    rows = documents.select(documents[id_col].alias("_id"), documents[text_col].alias("_text"))
    # At most max_examples ids and labels.
    sample = shared_table(rows.join(F.broadcast(chosen), "_id"), "toxicity-examples")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, toxic = Counter(), Counter()
            for text, y in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                terms = set(term_counts(text))
                rows.update(terms)
                if y:
                    toxic.update(terms)
            made = {"term": list(rows), "n": list(rows.values()), "p": [toxic[t] for t in rows]}
            yield pa.RecordBatch.from_pydict(made)

    counts = sample.select("_text", "_y").mapInArrow(count, "term string, n bigint, p bigint")
    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0))).first()
    n, p = F.col("n"), F.col("p")
    gap = p * F.lit(total - positive) - (n - p) * F.lit(positive)
    spread = n.cast("double") * (total - n) * positive * (total - positive)
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    chi2 = gap.cast("double") * gap * total / spread
    kept = counts.filter(spread > 0).withColumn("chi2", chi2).filter(F.col("chi2") >= MIN_CHI2)
    terms = kept.orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).collect()
    vocabulary = [row["term"] for row in terms]
    idf = np.log(1 + total / np.array([row["n"] for row in terms] or [1.0]))
    number = {term: i for i, term in enumerate(vocabulary)}

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, ys = batch.columns
            found = [term_counts(text) for text in text_bytes(texts)]
            own = [[(number[t], n) for t, n in f.items() if t in number] for f in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": ids.cast(pa.string()),
                    "y": ys,
                    "terms": pa.array([[t for t, _ in f] for f in own], pa.list_(pa.int64())),
                    "times": pa.array([[n for _, n in f] for f in own], pa.list_(pa.int64())),
                }
            )

    fields = "id string, y int, terms array<bigint>, times array<bigint>"
    rows = sample.select("_id", "_text", "_y").mapInArrow(select, fields).collect()
    rows = sorted(rows, key=lambda r: (r["id"], r["terms"], r["times"]))
    vectors = [weigh(dict(zip(r["terms"], r["times"])), idf) for r in rows]
    ids = np.array([r["id"] for r in rows], dtype=object)
    index = build_index(vocabulary, idf, vectors, np.array([r["y"] for r in rows]), ids)
    place = {i: n for n, i in enumerate(index.ids.tolist())}
    votes: list[float | None] = []
    for row, (terms_, weights) in zip(rows, vectors):
        near, cosines = nearest(index, terms_, weights, k, skip=place[row["id"]])
        votes.append(vote(index.labels[near], cosines) if len(near) else None)
    return Model(index, calibrate(votes, np.array([r["y"] for r in rows])), k)


def toxicity_scores(
    documents: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, held_out, score, predicted, evidence)`` for every row of ``documents``.

    ``evidence`` lists the three nearest examples as id:cosine. A null text counts as
    empty; a text without a term of the model gets the share of positives among such
    examples, 0 if the model has none. Ids may be null (never held out) or repeat. Other
    columns are ignored. Whole texts are scored, whatever their length.
    """

    def work(texts: list[bytes | None]) -> dict[str, list]:
        scored = [model.score(text) for text in texts]
        return {
            "score": [value for value, _ in scored],
            "predicted": pa.array([int(value >= threshold) for value, _ in scored], pa.int32()),
            "evidence": [",".join(f"{i}:{c:.4f}" for i, c in near[:3]) for _, near in scored],
        }

    fields = "score double, predicted int, evidence string"
    scored = map_texts(documents, id_col, text_col, fields, work)
    return scored.withColumn("held_out", held_out(F.col(id_col)))


def reject_toxic(
    documents: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """``documents`` without the rows scored at or above the threshold."""
    at = documents.schema.fieldNames().index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, at):
                keep = [model.score(text)[0] < threshold for text in texts]
                yield part.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
