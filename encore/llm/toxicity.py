"""Toxicity by the nearest labelled examples.

Documents and examples are TF-IDF vectors over every term that any example
holds; the cosine to every example is exact. A term weighs its inverse document
frequency times its evidence, the squared correlation of its presence with the
label in the sample, shrunk for terms of few examples, plus 1 / n, what chance
alone gives. Plain TF-IDF would let
common prose decide: held-out toxic documents found fall from nine in ten to
four in ten. No term is left out, so a document finds its neighbours by its
plain words where it has no telling ones.

The examples lie in an inverted index. The lists of rare words are added up per
document; those of common words are rows of a matrix, and one product gives what
they add to all cosines of a batch of documents, in single precision. Whatever comes
near the k-th cosine so found is computed again in double. The nearest examples vote
with weights that fall with their distance; one more vote, at the distance of
strangers, is the toxic rate of the sample. A logistic curve, fitted on the
examples' own leave-one-out votes, makes the vote a probability, and the
nearest examples are returned as evidence.

Terms are runs of letters, A-Z lowered, by 64-bit hash. Document frequencies
are counted over all documents.

Scale: the sample has at most ``fit_rows`` labelled documents, and it ends with
the document that brings its distinct (document, term) pairs to ``fit_terms``
(documented bounds), so the index goes with the tasks; the curve is fitted on at
most ``fit_votes`` of these examples. Counting and scoring are
passes over all whole texts without a shuffle of them; counts are added up in
each task first, and only of terms that some example holds.

Cases: null or wordless text, or text without any example's term, has no
neighbour and gets the strangers' vote; ties go to the smaller example number;
repeated rows are scored each; null ids are kept and not held out; without
usable labels every score is 0.5; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm import wordhash as wh
from encore.llm.common import byte_buffer, pieces, written
from encore.llm.labelled import fit_calibration, held_out, logistic, sampled_documents

FIT_ROWS = 20_000
FIT_TERMS = 8_000_000
FIT_VOTES = 4000
SHRINK = 5
NEIGHBOURS = 10
# queries multiplied at once
BLOCK = 128
DENSE = 512
# more than single precision can be off in a sum of products of unit vectors
ROUNDING = 1e-4
THRESHOLD = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term of a piece."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    text = np.where(_LETTER[data], _LOWER[data], 0x20).astype(np.uint8)
    starts, ends, first = wh.word_spans(text, offsets)
    return wh.rows_of(first), wh.word_hashes(text, starts, ends)


def _counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in row order, with counts."""
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row)))


def _text_pieces(column):
    data, offsets = byte_buffer(column)
    for a, b in pieces(offsets):
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class Index:
    """Examples' vectors as an inverted index: per term a list of examples and weights.
    The ``DENSE`` longest lists, of common words, are also rows of a matrix, ``dense``."""

    def __init__(self, terms: np.ndarray, factor: np.ndarray, n_examples: int, row, term, weight, labels):
        self.terms, self.factor, self.labels, self.examples = terms, factor, labels, n_examples
        # numbers as narrow as they may be: the index goes to every executor
        order = np.lexsort((row, term))
        self.place, self.weight = row.astype(np.min_scalar_type(n_examples))[order], weight.astype(np.float32, copy=False)[order]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))]).astype(np.int32)
        self.common = np.argsort(-np.diff(self.begin), kind="stable")[:DENSE].astype(np.int32)
        self.column = np.full(len(terms), len(self.common), np.int16)
        self.column[self.common] = np.arange(len(self.common))

    @cached_property
    def dense(self) -> np.ndarray:
        matrix = np.zeros((len(self.common), self.examples), np.float32)
        for weights, lo, hi in zip(matrix, self.begin[self.common], self.begin[self.common + 1]):
            weights[self.place[lo:hi]] = self.weight[lo:hi]
        return matrix

    def __getstate__(self) -> dict:
        """Without the matrix, which every process makes from the lists."""
        return {name: value for name, value in vars(self).items() if name != "dense"}

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples that share a term, and their cosines."""
        return self.nearest_of_each(term, weight, np.array([0, len(term)]), k, np.array([skip]))[0]

    def nearest_of_each(self, term: np.ndarray, weight: np.ndarray, cut: np.ndarray, k: int,
                        skip: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of several queries: query i has the terms from ``cut[i]`` to ``cut[i + 1]``."""
        column, found = self.column[term], []
        query = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        for lo in range(0, len(cut) - 1, BLOCK):
            hi = min(lo + BLOCK, len(cut) - 1)
            own = cut[lo] + np.flatnonzero(column[cut[lo]:cut[hi]] < len(self.common))
            factors = np.zeros((hi - lo, len(self.common)), np.float32)
            factors[query[own] - lo, column[own]] = weight[own]
            for i, near in zip(range(lo, hi), factors @ self.dense):
                at = slice(cut[i], cut[i + 1])
                found.append(self._nearest(near, term[at], weight[at], column[at], k, -1 if skip is None else skip[i]))
        return found

    def _nearest(self, near: np.ndarray, term, weight, column, k: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of one query; ``near`` holds what its common words add to each cosine, in single precision."""
        listed = column == len(self.common)
        first, last = self.begin[term[listed]], self.begin[term[listed] + 1]
        posting = _spans(first, last)
        score = np.bincount(self.place[posting], np.repeat(weight[listed], last - first) * self.weight[posting],
                            minlength=self.examples)
        near += score
        # exact cosines of all that may be among the nearest
        least = np.partition(near, -k - 1)[-k - 1] - ROUNDING if len(near) > k else 0
        place = np.flatnonzero((near >= least) & (near > 0))
        cosine = score[place] + (self.dense[np.ix_(column[~listed], place)] * weight[~listed, None]).sum(0)
        place, cosine = place[place != skip], cosine[place != skip]
        best = np.lexsort((place, -np.round(cosine, 12)))[:k]
        return place[best], cosine[best]


def _vectors(terms: np.ndarray, factor: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray):
    """Unit vectors of distinct (row, term) pairs over the examples' terms: row, term number, weight."""
    at = np.minimum(np.searchsorted(terms, term), max(len(terms) - 1, 0))
    own = np.flatnonzero(terms[at] == term) if len(terms) else np.empty(0, np.int64)
    row, at = row[own], at[own]
    return row, at, _unit(factor, row, at, count[own])


def _unit(factor: np.ndarray, row: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Weights of the rows' terms, each row's of norm 1."""
    weight = np.log(count)
    weight += 1
    weight *= factor[at]
    norm = np.sqrt(np.bincount(row, weight ** 2, minlength=row.max() + 1 if len(row) else 0))
    weight /= np.maximum(norm, 1e-12)[row]
    return weight


def _vote(cosine: np.ndarray, label: np.ndarray, strangers: float) -> float:
    weight = 1 / (0.05 + np.maximum(1 - cosine, 0))
    alone = 1 / 1.05
    return float((weight @ label + alone * strangers) / (weight.sum() + alone))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", *,
        fit_rows: int = FIT_ROWS, fit_terms: int = FIT_TERMS, fit_votes: int = FIT_VOTES, neighbours: int = NEIGHBOURS) -> dict:
    """Term weights, example index and calibration."""
    def example_terms(batches):
        for batch in batches:
            terms, counts = [], []
            for a, b, data, offsets in _text_pieces(batch.column(0)):
                row, term, count = _counted(*_terms(data, offsets))
                cut = np.searchsorted(row, np.arange(1, b - a))
                terms += np.split(term.view(np.int64), cut)
                counts += np.split(count.astype(np.int32), cut)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column(1), "example": batch.column(2), "label": batch.column(3),
                "terms": pa.array(terms, pa.list_(pa.int64())), "counts": pa.array(counts, pa.list_(pa.int32()))})

    sample = sampled_documents(docs, labels, label, fit_rows, id_col, text_col)
    examples = written(sample.select("__text", F.xxhash64("__id").alias("key"), F.col("__id").cast("long"), "__label").mapInArrow(
        example_terms, "key long, example long, label int, terms array<long>, counts array<int>"), "examples")
    # one window over at most fit_rows pairs of numbers
    before = F.sum(F.size("terms")).over(Window.orderBy("key")) - F.size("terms")
    chosen = examples.select("key", before.alias("before")).where(F.col("before") < fit_terms).select("key")
    examples = examples.join(F.broadcast(chosen), "key", "left_semi")
    table = examples.select("key", "example", "label", "terms", "counts").toArrow().combine_chunks().sort_by(
        [("example", "ascending"), ("key", "ascending")])
    y, key, ids = (table[c].to_numpy() for c in ("label", "key", "example"))
    y = y.astype(float)
    n, t = len(y), float(y.sum())
    if n == 0 or t == 0 or t == n:
        return {"constant": 0.5 if n == 0 else min(max(t / n, 0.02), 0.98)}
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(table["terms"]).to_numpy())])
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(first))
    term, count = pc.list_flatten(table["terms"]).to_numpy().view(np.uint64), pc.list_flatten(table["counts"]).to_numpy()
    terms = np.unique(term)
    at = np.empty(len(term), np.int32)
    # by parts, and without what is no longer needed: the driver's memory is small
    for lo in range(0, len(term), 1 << 20):
        at[lo:lo + (1 << 20)] = np.searchsorted(terms, term[lo:lo + (1 << 20)])
    del table, term
    factor = _inverse_frequencies(docs, text_col, terms) * evidence(
        np.bincount(at, minlength=len(terms)), np.bincount(at, y[row], minlength=len(terms)), n, t)
    weight = _unit(factor, row, at, count)
    strangers = (t + 0.5) / (n + 1)
    # the curve has two numbers: the votes of fit_votes examples, by the hash of their ids, settle it
    judged = np.sort(np.argsort(key, kind="stable")[:fit_votes])
    raw = np.full(len(judged), strangers)
    own = _spans(first[judged], first[judged + 1])
    cut = np.concatenate([[0], np.cumsum(first[judged + 1] - first[judged])])
    judged_at, judged_weight, weight = at[own], weight[own], weight.astype(np.float32)
    del count, own
    index = Index(terms, factor, n, row, at, weight, y)
    del row, at, weight
    for i, (found, cosine) in enumerate(index.nearest_of_each(judged_at, judged_weight, cut, neighbours, judged)):
        raw[i] = _vote(cosine, y[found], strangers)
    vars(index).pop("dense", None)
    return {"index": index, "ids": ids, "strangers": strangers, "k": neighbours,
            "curve": fit_calibration(raw, y[judged])}


def evidence(holding: np.ndarray, toxic: np.ndarray, n: int, t: float) -> np.ndarray:
    """Squared correlation of a term's presence with the label, shrunk for terms of few
    examples, plus 1 / n: of ``n`` examples, ``t`` of them toxic, ``holding`` have the
    term, and ``toxic`` of these are."""
    among = holding * (n - holding) * t * (n - t)
    squared = np.where(among > 0, (toxic * n - holding * t) ** 2 / np.maximum(among, 1), 0.0)
    return squared * holding / (holding + SHRINK) + 1 / n


def _inverse_frequencies(docs: DataFrame, text_col: str, terms: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of each term, over all rows."""
    def counted(batches):
        total, n = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, offsets in _text_pieces(batch.column(0)):
                _, term, _ = _counted(*_terms(data, offsets))
                at = np.searchsorted(terms, term)
                at[at == len(terms)] = 0
                np.add.at(total, at[terms[at] == term], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.append(some, -1), pa.int32()),
                                          "n": pa.array(np.append(total[some], n), pa.int64())})

    if not len(terms):
        return np.empty(0)
    table = (docs.select(F.col(text_col).cast("string")).mapInArrow(counted, "at int, n long")
             .groupBy("at").agg(F.sum("n").alias("n")).toArrow())
    df = np.zeros(len(terms) + 1)
    df[table["at"].to_numpy()] = table["n"].to_numpy()
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


def score_batch(model: dict, column) -> tuple[list[float], list[np.ndarray], list[np.ndarray]]:
    """Scores, nearest examples' ids and cosines of a column of texts."""
    index, k = model["index"], model["k"]
    slope, shift = model["curve"]
    none = logistic(np.array(slope * model["strangers"] + shift)).item()
    scores, ids, cosines = [none] * len(column), [np.empty(0, np.int64)] * len(column), [np.empty(0)] * len(column)
    known: dict[bytes, tuple] = {}
    for a, b, data, offsets in _text_pieces(column):
        row, at, weight = _vectors(index.terms, index.factor, *_counted(*_terms(data, offsets)))
        cut = np.flatnonzero(np.diff(row, prepend=-1, append=-2))
        keys = [at[lo:hi].tobytes() + weight[lo:hi].tobytes() for lo, hi in zip(cut[:-1], cut[1:])]
        new = {key: i for i, key in enumerate(keys) if key not in known}
        first, last = cut[list(new.values())], cut[[i + 1 for i in new.values()]]
        own = _spans(first, last)
        each = index.nearest_of_each(at[own], weight[own], np.concatenate([[0], np.cumsum(last - first)]), k) if new else []
        for key, (found, cosine) in zip(new, each):
            vote = _vote(cosine, index.labels[found], model["strangers"])
            known[key] = (logistic(np.array(slope * vote + shift)).item(), model["ids"][found], cosine)
        for lo, key in zip(cut, keys):
            r = a + row[lo]
            scores[r], ids[r], cosines[r] = known[key]
    return scores, ids, cosines


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", *,
          threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted``, and as evidence
    ``nearest`` (labelled examples' ids) with their ``cosines``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(batches):
        for batch in batches:
            if "constant" in model:
                n = batch.num_rows
                found = [model["constant"]] * n, [[]] * n, [[]] * n
            else:
                found = score_batch(model, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found[0], pa.float64()),
                 pa.array(found[1], pa.list_(pa.int64())), pa.array(found[2], pa.list_(pa.float64()))],
                names=[id_col, "held_out", "score", "nearest", "cosines"])

    made = (docs.select(F.col(text_col).cast("string"), F.col(id_col), held_out(F.col(id_col)).alias("__held"))
            .mapInArrow(scored, f"`{id_col}` {id_type}, held_out boolean, score double, nearest array<long>, cosines array<double>"))
    return made.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "nearest", "cosines")
