"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a document gets a label, good or bad. Its features are shape
measures of the line (letters, case, digits, symbols, word lengths, repeated
words, repeated lines) and those of the lines before and after it; transitions
between neighbouring labels are learned with them. Forward-backward gives each
line's probability of being good; their mean, weighted by the lines' lengths,
is the document's quality, which a logistic curve maps to the probability of
label 1.

Only documents are labelled. The lines of a document start with its label;
then, in documents labelled 0, lines that a first model without transitions
finds good are relabelled good (the worst line stays bad), and the field is
trained on these sequences.

Scale: the model is fitted on the driver from at most ``fit_rows`` labelled
documents, whole, that have at most ``fit_lines`` lines together and a
twentieth of these each (documented bounds); in training a long document's
lines are several chains of ``chain`` lines. Scoring is one pass over all texts, whole, without a shuffle.

Cases: null text is empty; an empty text is one empty line and gets a score;
a document with one line has no neighbours; repeated rows are scored each;
null ids are kept and not held out; without any usable label every score is
0.5; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm import wordhash as wh
from encore.llm.common import byte_buffer, pieces, written
from encore.llm.labelled import fit_calibration, held_out, logistic, sampled_documents

FIT_ROWS = 4000
FIT_LINES = 400_000
CHAIN = 200
THRESHOLD = 0.3

_UPPER, _LETTER, _DIGIT, _SYMBOL, _CLOSE, _CALL, _BLANK = (np.zeros(256, bool) for _ in range(7))
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_DIGIT[0x30:0x3A] = True
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_CLOSE[[ord(c) for c in ".,;:?"]] = True
_CALL[ord("!")] = True
_BLANK[[0x20, 0x09]] = True
SHAPES = 14


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of a piece, each row's first line number (one more
    entry at the end), and the lines' lengths in bytes."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # a row that ends with a line break has one more, empty, line
    row = np.sort(np.concatenate([np.arange(rows), np.searchsorted(offsets, breaks, "right") - 1]), kind="stable")
    first = np.searchsorted(row, np.arange(rows + 1))
    end = np.empty(len(begin), np.int64)
    end[:-1] = begin[1:] - 1
    end[first[1:] - 1] = offsets[1:]
    size = end - begin


    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return (total[end] - total[begin]).astype(float)

    starts, ends, _ = wh.word_spans(data, offsets)
    hashes = wh.word_hashes(data, starts, ends)
    line = np.searchsorted(begin, starts, "right") - 1
    # empty rows share their begin with the next row's first line: words go to the last of these
    n_words = np.bincount(line, minlength=len(begin)).astype(float)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    again = np.bincount(line[same], minlength=len(begin))
    distinct = np.unique(wh.mix(hashes ^ wh.mix(line.astype(np.uint64), 5), 5), return_index=True)[1]
    fresh = np.bincount(line[distinct], minlength=len(begin))
    total = np.concatenate([[np.uint64(0)], np.cumsum(wh.mix(hashes, 6), dtype=np.uint64)])
    at = np.searchsorted(line, np.arange(len(begin) + 1))
    bag = total[at[1:]] - total[at[:-1]]
    key = wh.mix(bag ^ wh.mix(row.astype(np.uint64), 7), 7)
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    letters, some, words = count(_LETTER), np.maximum(size, 1), np.maximum(n_words, 1)
    symbols, calls, closes, upper = count(_SYMBOL), count(_CALL), count(_CLOSE), count(_UPPER)
    cols = [letters / some, upper / np.maximum(letters, 1), count(_DIGIT) / some, symbols / some,
            np.minimum(symbols / words, 4), np.minimum(calls / words, 4), np.minimum(closes / words, 4),
            np.log1p(n_words), np.minimum(letters / words, 30) / 10,
            again / words, 1 - fresh / words, np.log(times[back]) * (n_words > 0), count(_BLANK) / some, (n_words == 0).astype(float)]
    return np.stack(cols, 1), first, size


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it (zero
    where there is none, with a mark)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = np.zeros((len(x), 2))
    edge[first[:-1], 0] = 1
    edge[first[1:] - 1, 1] = 1
    before[edge[:, 0] > 0] = 0
    after[edge[:, 1] > 0] = 0
    return np.concatenate([x, before, after, edge], 1)


def forward_backward(good: np.ndarray, first: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chains of lines with evidence ``good`` (log odds): the probability
    that each line is good, and the expected number of transitions [from, to]
    over all chains (0 bad, 1 good). All chains advance together."""
    n, length = len(good), np.diff(first)
    emit = np.stack([np.zeros(n), good], 1)
    ahead, back = emit.copy(), np.zeros((n, 2))
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    still = [int(np.searchsorted(-length, -t, "left")) for t in range(1, longest)]  # chains longer than t
    for t, k in enumerate(still, 1):
        at = start[:k] + t
        a = ahead[at - 1]
        for s in (0, 1):
            ahead[at, s] += np.logaddexp(a[:, 0] + transition[0, s], a[:, 1] + transition[1, s])
    for t, k in zip(range(longest - 1, 0, -1), reversed(still)):
        at = start[:k] + t
        b = back[at] + emit[at]
        for s in (0, 1):
            back[at - 1, s] = np.logaddexp(b[:, 0] + transition[s, 0], b[:, 1] + transition[s, 1])
    both = ahead + back
    norm = np.logaddexp(both[:, 0], both[:, 1])
    marginal = np.exp(both[:, 1] - norm)
    inner = np.ones(n, bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    to = np.flatnonzero(inner)
    expected = np.empty((2, 2))
    for s in (0, 1):
        for u in (0, 1):
            expected[s, u] = np.exp(ahead[to - 1, s] + transition[s, u] + emit[to, u] + back[to, u] - norm[to]).sum()
    return marginal, expected


def _fit_field(x: np.ndarray, y: np.ndarray, first: np.ndarray, chained: bool, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by gradient steps (Adam) on the likelihood."""
    w, transition = np.zeros(x.shape[1]), np.zeros((2, 2))
    params = np.zeros(len(w) + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    inner = np.ones(len(x), bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    seen = np.bincount(2 * y[to - 1].astype(int) + y[to].astype(int), minlength=4).reshape(2, 2)
    for t in range(1, steps + 1):
        w, transition = params[:-4], params[-4:].reshape(2, 2)
        if chained:
            p, expected = forward_backward(x @ w, first, transition)
            jump = ((expected - seen) / len(x)).ravel() + 1e-3 * transition.ravel()
        else:
            p, jump = logistic(x @ w), np.zeros(4)
        slope = np.concatenate([x.T @ (p - y) / len(x) + 1e-4 * w, jump])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        params = params - 0.15 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return params[:-4], params[-4:].reshape(2, 2)


def document_quality(marginal: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities, weighted by length (an empty line by one)."""
    weight = np.maximum(size, 1).astype(float)
    total = np.concatenate([[0], np.cumsum(weight * marginal)])
    whole = np.concatenate([[0], np.cumsum(weight)])
    return (total[first[1:]] - total[first[:-1]]) / (whole[first[1:]] - whole[first[:-1]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", *,
        fit_rows: int = FIT_ROWS, fit_lines: int = FIT_LINES, chain: int = CHAIN, steps: int = 120) -> dict:
    """The model from a bounded sample of labelled documents."""
    def features(batches):
        for batch in batches:
            data, offsets = byte_buffer(batch.column(0))
            out, at = [], []
            for a, b in pieces(offsets):
                x, first, size = line_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                for r in range(b - a):
                    lo, hi = first[r], first[r + 1]
                    if hi - lo <= max(fit_lines // 20, 1):
                        out.append(np.concatenate([x[lo:hi], size[lo:hi, None]], 1).ravel())
                        at.append(a + r)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_pydict({"x": pa.array(out, pa.list_(pa.float64())), "__label": batch.column(1).take(at),
                                              "__id": batch.column(2).take(at)})

    sample = sampled_documents(docs, labels, label, fit_rows, id_col, text_col)
    made = written(sample.select("__text", "__label", F.xxhash64("__id", "__text").alias("__id"))
                   .mapInArrow(features, "x array<double>, __label int, __id long"), "lines")
    # one narrow row per sampled document: those that fit together, in the order of their hash
    sizes = made.groupBy("__id").agg(F.sum(F.size("x") / (SHAPES + 1)).alias("n"))
    fitting = sizes.withColumn("total", F.sum("n").over(Window.orderBy("__id"))).where(F.col("total") <= fit_lines)
    rows = made.join(F.broadcast(fitting.select("__id")), "__id").toPandas().sort_values("__id")
    tables = [np.asarray(v).reshape(-1, SHAPES + 1) for v in rows["x"]]
    y = rows["__label"].to_numpy()
    if not len(y) or y.min() == y.max():
        return {"constant": 0.5 if not len(y) else float(np.clip(y.mean(), 0.02, 0.98))}
    first = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
    flat = np.concatenate(tables)
    x, size = flat[:, :-1], flat[:, -1]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    wide = np.concatenate([with_neighbours((x - mean) / scale, first), np.ones((len(x), 1))], 1)
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    line_label = y[doc].astype(float)
    chains = np.concatenate([*(np.arange(a, b, chain) for a, b in zip(first[:-1], first[1:])), first[-1:]])
    w, _ = _fit_field(wide, line_label, chains, False, steps)
    alone = logistic(wide @ w)
    worst = np.full(len(y), 2.0)
    np.minimum.at(worst, doc, alone)
    line_label[(line_label == 0) & (alone > 0.5) & (alone > worst[doc])] = 1
    w, transition = _fit_field(wide, line_label, chains, True, steps)
    marginal, _ = forward_backward(wide @ w, first, transition)
    return {"mean": mean, "scale": scale, "w": w, "transition": transition,
            "curve": fit_calibration(document_quality(marginal, first, size), y.astype(float))}


def score_piece(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of a piece's rows."""
    if "constant" in model:
        return np.full(len(offsets) - 1, model["constant"])
    x, first, size = line_features(data, offsets)
    wide = with_neighbours((x - model["mean"]) / model["scale"], first)
    marginal, _ = forward_backward(wide @ model["w"][:-1] + model["w"][-1], first, model["transition"])
    slope, shift = model["curve"]
    return logistic(slope * document_quality(marginal, first, size) + shift)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", *, keep: list[str] | None = None,
          threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the kept columns (default: the id), ``held_out``, ``score``, ``predicted``."""
    keep = keep or [id_col]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def scored(batches):
        for batch in batches:
            data, offsets = byte_buffer(batch.column(0))
            found = [score_piece(model, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in pieces(offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], batch.column(1), pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())],
                names=[*keep, "held_out", "score"])

    return (docs.select(F.col(text_col).cast("string").alias("__text"), held_out(F.col(id_col)).alias("__held"),
                        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
            .mapInArrow(scored, fields + ", held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
