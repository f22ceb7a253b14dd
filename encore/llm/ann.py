"""Nearest neighbours: a hash-prefix forest, then an exact pass under its bounds.

Each tree gives a vector a long hash string: a row of symbols, each the axis
(and its sign) that a random rotation of the centred vector points to most.
A tree is the array of these strings in sorted order, over all vectors. A
query descends to the vectors with its longest prefix, which are those beside
it in the array, up to ``reach`` on either side; then all trees ascend
together, one bit of prefix at a time, until ``candidates`` vectors are found.
Candidates are ranked by their exact Euclidean distance. The forest sees a
bounded number of vectors at any table size, so what it finds is only a bound:
the distance of its (k + 1)-th id, which no true neighbour exceeds. An exact
pass then holds every query against all vectors: products in single precision
leave out what surely lies beyond the bound, with a margin over their rounding
error, and the rest is compared in double precision. The result is exact
whatever ``reach`` and ``candidates`` are; they decide only how tight the bound
is.

Scale: equal vectors form one class, kept with its k + 1 smallest ids, so a
vector that fills a third of the table is one entry. The sorted arrays are
range-partitioned by (tree, string, class) with dense positions and cut into
chunks of ``chunk`` positions that overlap by ``reach``; no chunk is larger
whatever the strings, and blocks hold about ``BLOCK_ROWS`` vectors. Strings travel without the vectors. Candidates meet the
vectors in blocks: a query is sent to a block once, with its candidates there,
and returns its k + 1 nearest classes. The forest's work per query is bounded by
trees * 2 * reach. The exact pass is a grid of vector blocks and groups of about
``QUERY_ROWS`` queries, so a task's memory is bounded; each cell returns k + 1
ids a query. Its work is queries * vectors.

Cases: vectors that are null, zero, or hold null or non-finite components take
no part; vectors of other lengths are searched each among their own, the
forest bounding the most common length alone (ties: the longer), the others go
to the exact pass without a bound; a null id takes no part; repeated rows (equal id and vector) count
once; an id with several vectors has each of them as a row, and none of them
answers that id's queries; other columns are not read; fewer candidates than
k are all returned; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import scratch_path, shuffle_partitions, written
from encore.operators.keys import dense_ids

TREES = 40
SYMBOLS = 5
REACH = 400
CANDIDATES = 20_000
CHUNK = 8192
BLOCK_ROWS = 50_000
# queries of one cell of the exact pass; queries and vectors compared at once in it; distances computed at once
QUERY_ROWS = 16_384
QUERY_TILE = 512
VECTOR_TILE = 4096
PAIRS = 1 << 16


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def rotations(dim: int, trees: int, symbols: int, seed: int = 17) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(trees * symbols)]
                    ).reshape(trees, symbols, dim, dim).astype(np.float32)


def hash_strings(x: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Hash string of each centred vector in each tree, as a 63-bit number."""
    trees, symbols, dim, _ = turns.shape
    bits = max(1, (2 * dim - 1).bit_length())
    out = np.zeros((len(x), trees), np.int64)
    x = x.astype(np.float32)
    rows = np.arange(len(x))
    for t in range(trees):
        for s in range(min(symbols, 63 // bits)):
            y = x @ turns[t, s]
            axis = np.abs(y).argmax(1)
            out[:, t] = (out[:, t] << bits) | (axis * 2 + (y[rows, axis] > 0))
    return out


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading bits, of 64, that two numbers share."""
    x = (a ^ b).astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        x |= x >> np.uint64(s)
    return 64 - np.bitwise_count(x).astype(np.int64)


def least_ids(query: np.ndarray, score: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k nearest distinct codes (ties: the smaller), by query and nearness."""
    order = np.lexsort((score, code, query))
    new = np.ones(len(order), bool)
    new[1:] = (query[order][1:] != query[order][:-1]) | (code[order][1:] != code[order][:-1])
    order = order[new]
    order = order[np.lexsort((code[order], score[order], query[order]))]
    q = query[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q, "left") < k]


def nearest_ids(x: np.ndarray, code: np.ndarray, at: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int):
    """Each query's k nearest distinct codes within its bound, exactly: query,
    code, distance. Vector i holds the codes ``code[at[i]:at[i + 1]]``."""
    out = [(np.empty(0, np.int64), np.empty(0, code.dtype), np.empty(0))]
    if not len(x) or not len(queries):
        return out[0]
    dim, eps = x.shape[1], float(np.finfo(np.float32).eps)
    margin, least = (2 * dim + 16) * eps, dim * float(np.finfo(np.float32).tiny)
    with np.errstate(all="ignore"):  # what overflows isn't left out
        middle = x.mean(0)
        scale = max(np.abs(x - middle).max(), np.abs(queries - middle).max()) or 1.0
        flat = ((x - middle) / scale).astype(np.float32)
        length = ((flat.astype(np.float64) ** 2).sum(1) * (1 - margin)).astype(np.float32)
        flat *= -2
    steps = [0, *(VECTOR_TILE >> s for s in (4, 2)), *range(VECTOR_TILE, len(x), VECTOR_TILE)]
    steps = [*[s for s in steps if s < len(x)], len(x)]
    for lo in range(0, len(queries), QUERY_TILE):
        q, limit = queries[lo:lo + QUERY_TILE], bound[lo:lo + QUERY_TILE].copy()
        with np.errstate(all="ignore"):
            q32 = ((q - middle) / scale).astype(np.float32)
            own = (q32.astype(np.float64) ** 2).sum(1) * (1 - margin)
        best = out[0]
        for a, b in zip(steps[:-1], steps[1:]):
            with np.errstate(all="ignore"):
                gap = q32 @ flat[a:b].T
                gap += length[a:b]
                far = ((limit / scale) ** 2 * (1 + margin) - own + least).astype(np.float32)
                one, two = np.nonzero(~(gap > far[:, None]))
            for c in range(0, len(one), PAIRS):
                i, j = one[c:c + PAIRS], two[c:c + PAIRS] + a
                d = np.sqrt(((x[j] - q[i]) ** 2).sum(1))
                near = d <= limit[i]
                i, j, d = i[near], j[near], d[near]
                if not len(i):
                    continue
                n = at[j + 1] - at[j]
                member = np.repeat(at[j] - np.cumsum(n) + n, n) + np.arange(n.sum())
                merged = [np.concatenate(pair) for pair in zip(best, (np.repeat(i, n), code[member], np.repeat(d, n)))]
                keep = least_ids(merged[0], merged[2], merged[1], k)
                best = tuple(m[keep] for m in merged)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(q)) == k)
                limit[full] = np.minimum(limit[full], best[2][np.searchsorted(best[0], full, "right") - 1])
        out.append((best[0] + lo, best[1], best[2]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where("id is not null and v is not null").withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))
    fine = F.forall(v, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    return rows.where(fine & F.exists(v, lambda x: x != 0))


def search(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, every: int = 100, k: int = 10,
           trees: int = TREES, symbols: int = SYMBOLS, reach: int = REACH, candidates: int = CANDIDATES,
           chunk: int = CHUNK) -> DataFrame:
    """For each id divisible by ``every``: its k nearest rows as query_id, rank,
    vec_id, score."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vec_col)
    lengths = rows.groupBy(F.size("v").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    dim = common["d"] if common else 1
    total = lengths.agg(F.sum("count")).first()[0] or 0
    blocks = max(shuffle_partitions(spark), -(-total // BLOCK_ROWS))
    asks = F.col("id") % every == 0
    by_vector = Window.partitionBy("v").orderBy("id")
    few = rows.groupBy("v", "id").agg(F.lit(1).alias("one")).select(
        "v", "id", F.row_number().over(by_vector).alias("n")).where(F.col("n") <= k + 1)
    asking = rows.where(asks).select("v").distinct().withColumn("asks", F.lit(True))
    classes = written(few.groupBy("v").agg(F.min("id").alias("cid"), F.array_sort(F.collect_list("id")).alias("ids"))
                      .join(asking, "v", "left").select("cid", "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"),
                                                        F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block"))
                      # an id with several vectors may lead several classes: the vector's hash tells them apart
                      .withColumn("cid", F.xxhash64("cid", "v")), "classes")
    usual = classes.where(F.size("v") == dim)
    asked_classes = classes.where("asks").count()
    centre = usual.agg(*[F.avg(F.col("v")[i]).alias(f"c{i}") for i in range(dim)]).first()
    centre = np.array([c or 0.0 for c in centre], np.float64)
    groups = max(1, -(-asked_classes // QUERY_ROWS))

    def strings(batches):
        turns = rotations(dim, trees, symbols)
        for batch in batches:
            h = hash_strings(_matrix(batch.column(1)) - centre, turns)
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), "h": pa.array(h.ravel()),
                "cid": pa.array(np.repeat(np.asarray(batch.column(0)), trees)),
                "asks": pa.array(np.repeat(np.asarray(batch.column(2), dtype=bool), trees)),
                "block": pa.array(np.repeat(np.asarray(batch.column(3)), trees))})

    forest = usual.select("cid", "v", "asks", "block").mapInArrow(
        strings, "tree int, h long, cid long, asks boolean, block int")
    forest = dense_ids(forest, ["tree", "h", "cid"], "place", scratch_path(spark, "forest"), blocks)
    span = F.array_distinct(F.transform(F.array(*[F.lit(x) for x in (-reach, 0, reach)]),
                                        lambda x: F.floor((F.col("place") + x) / chunk)))
    chunks = forest.select("*", F.explode(span).alias("chunk"))

    def beside(key, table):
        """The prefix neighbours of a chunk's queries, nearest first."""
        place = np.asarray(table["place"])
        order = np.argsort(place)
        place = place[order]
        tree, h, cid, block = (np.asarray(table[c])[order] for c in ("tree", "h", "cid", "block"))
        own = np.flatnonzero(np.asarray(table["asks"], dtype=bool)[order] & (place // chunk == key[0].as_py()))
        lo, hi = np.searchsorted(tree, tree[own], "left"), np.searchsorted(tree, tree[own], "right")
        out = []
        for p, a, b in zip(own, np.maximum(lo, own - reach), np.minimum(hi, own + reach + 1)):
            near = np.concatenate([np.arange(a, p), np.arange(p + 1, b)])
            out.append((cid[p], cid[near], common_prefix(h[near], h[p]).astype(np.int8), block[near]))
        return pa.table({"cid": pa.array([x[0] for x in out], pa.int64()),
                         "near": pa.array([x[1] for x in out], pa.list_(pa.int64())),
                         "prefix": pa.array([x[2] for x in out], pa.list_(pa.int8())),
                         "blocks": pa.array([x[3] for x in out], pa.list_(pa.int32()))})

    found = chunks.groupBy("chunk").applyInArrow(beside, "cid long, near array<long>, prefix array<tinyint>, blocks array<int>")

    def ascend(key, table):
        """One query's trees ascend together until enough candidates are found."""
        near, prefix, block = (np.asarray(table[c].combine_chunks().flatten()) for c in ("near", "prefix", "blocks"))
        order = np.lexsort((near, -prefix.astype(np.int64)))
        near, prefix, block = near[order], prefix[order], block[order]
        first = np.sort(np.unique(near, return_index=True)[1])
        if len(first) > candidates:  # the level that completes the number is taken whole
            first = first[prefix[first] >= prefix[first[candidates - 1]]]
        near, block = near[first], block[first]
        order = np.argsort(block, kind="stable")
        near, block = near[order], block[order]
        cut = np.flatnonzero(np.diff(block)) + 1
        parts = np.split(near, cut) if len(near) else []
        return pa.table({"cid": pa.array([key[0].as_py()] * len(parts), pa.int64()),
                         "block": pa.array(block[np.concatenate([[0], cut])] if len(near) else [], pa.int32()),
                         "near": pa.array(parts, pa.list_(pa.int64()))})

    chosen = found.groupBy("cid").applyInArrow(ascend, "cid long, block int, near array<long>")
    asked = chosen.join(usual.where("asks").select("cid", F.col("v").alias("qv")), "cid")

    def ranked(key, base, queries):
        ids = np.asarray(base["cid"])
        order = np.argsort(ids)
        ids, x = ids[order], _matrix(base["v"])[order]
        out = [[], [], []]
        for q, v, near in zip(queries["cid"].to_pylist(), _matrix(queries["qv"]), queries["near"]):
            near = np.sort(np.asarray(near.values))
            d = np.sqrt(((x[np.searchsorted(ids, near)] - v) ** 2).sum(1))
            # whole distances decide; classes at the k-th distance all stay, ids break the tie later
            keep = np.flatnonzero(d <= np.partition(d, k)[k]) if len(d) > k + 1 else np.arange(len(d))
            out[0].append(np.full(len(keep), q))
            out[1].append(near[keep])
            out[2].append(d[keep])
        flat = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.table({"cid": pa.array(flat[0].astype(np.int64)), "near": pa.array(flat[1].astype(np.int64)),
                         "score": pa.array(flat[2].astype(np.float64))})

    nearest = (usual.select("cid", "v", "block").groupBy("block").cogroup(asked.groupBy("block"))
               .applyInArrow(ranked, "cid long, near long, score double"))
    # a class holds all its equal rows at distance 0 to one another
    own = usual.where("asks").select("cid", F.col("cid").alias("near"), F.lit(0.0).alias("score"))
    members = usual.select(F.col("cid").alias("near"), F.explode("ids").alias("id"))
    best = Window.partitionBy("cid").orderBy("score", "id")
    bounds = (nearest.unionByName(own).join(members, "near").groupBy("cid", "id").agg(F.min("score").alias("score"))
              .withColumn("n", F.row_number().over(best)).where(F.col("n") == k + 1).select("cid", F.col("score").alias("bound")))

    def compared(key, base, queries):
        ids = base["ids"].combine_chunks()
        flat = ids.flatten()
        _, first, code = np.unique(np.asarray(flat), return_index=True, return_inverse=True)
        at = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))]).astype(np.int64)
        bound = np.asarray(queries["bound"].fill_null(np.inf))
        q, found, d = nearest_ids(_matrix(base["v"]), code, at, _matrix(queries["qv"]), bound, k + 1)
        return pa.table({"cid": pa.array(np.asarray(queries["cid"])[q], pa.int64()),
                         "id": flat.take(pa.array(first[found])), "score": pa.array(d, pa.float64())})

    every_group, every_block = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (groups, blocks))
    cells = (classes.select("v", "ids", F.size("v").alias("length"), "block", every_group.alias("group"))
             .groupBy("length", "block", "group"))
    asked_cells = (classes.where("asks").select("cid", F.col("v").alias("qv")).join(bounds, "cid", "left")
              .select("cid", "qv", "bound", F.size("qv").alias("length"), F.pmod("cid", F.lit(groups)).cast("int").alias("group"), every_block.alias("block"))
              .groupBy("length", "block", "group"))
    id_type = rows.schema["id"].dataType.simpleString()
    exact = cells.cogroup(asked_cells).applyInArrow(compared, f"cid long, id {id_type}, score double")
    answers = (exact.groupBy("cid", "id").agg(F.min("score").alias("score"))
               .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1))
    answers = answers.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("near"))
    queries = rows.where(asks).select("id", "v").distinct().join(classes.select("v", "cid"), "v").select(
        F.col("id").alias("query_id"), "cid")
    listed = queries.join(answers, "cid").select("query_id", F.slice(
        F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    return listed.select("query_id", F.posexplode("near").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
