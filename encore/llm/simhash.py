"""SimHash near-dedup with pigeonring filtering.

Fingerprints: 64 bits over word shingles; a bit is set if more than half of
the shingles' hashes have it. Distinct fingerprints link at a Hamming distance
of at most ``distance``; the components of these links are the groups.

Pigeonring: the bits are a ring of ``distance + 1`` segments. If two
fingerprints differ in at most ``distance`` bits, then from some segment on
every chain of l consecutive segments differs in at most
floor(l * distance / segments) bits: the first segment is equal, the next ones
stay within proportional budgets. Fingerprints meet in buckets of an equal
segment; pairs are dropped at the first chain over its budget, and only the
rest get the full check.

Scale: all is done on distinct fingerprints, so any number of copies costs one
row. Buckets are counted first. Buckets of at most ``bucket`` rows are
compared in tasks that hold about ``SHARD_ROWS`` rows of many buckets, and
return a spanning star per local group instead of pairs. A larger bucket (many
near copies, or far more documents than segment values) is dealt again by the
same rule: the bits that its key doesn't fix are a smaller ring, cut in as many
segments, and its fingerprints meet in buckets of one more equal segment. This
ends where at most ``LEAST_BITS`` bits are open, since no bucket of distinct
fingerprints can then hold more than 2 ** LEAST_BITS; for distances up to 3
that is after at most six rounds, beyond 3 rings are cut until there are
``MOST_RINGS`` and larger buckets are compared as they are. Components come from alternating
star contractions, written to the shared folder in each round.

Cases: null or wordless text has fingerprint zero and links like any other;
fewer words than a shingle count as one shingle; repeated rows share a
fingerprint; a null id is kept, and a component's id is its smallest non-null
id; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm import wordhash as wh
from encore.llm.common import byte_buffer, dealt, hot_join, pieces, shuffle_partitions, written

BUCKET = 4096
SHARD_ROWS = 200_000
# a ring of at most so many bits is not cut again
LEAST_BITS = 12
MOST_RINGS = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _shingle_spans(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of each shingle, and its row."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    a = first[:-1][row] + within
    return a, a + np.minimum(n[row], size) - 1, row


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """64-bit fingerprints of a piece's rows."""
    rows = len(offsets) - 1
    out = np.zeros(rows, np.uint64)
    starts, ends, first = wh.word_spans(data, offsets)
    if not len(starts):
        return out
    # words of a row joined by one space, A-Z lowered: drop all separators but
    # the one before each word that isn't its row's first
    row = wh.rows_of(first)
    inner = np.zeros(len(starts), bool)
    inner[1:] = row[1:] == row[:-1]
    text = _LOWER[data]
    keep = ~wh.SEPARATOR[data]
    text[starts[inner] - 1] = 0x20
    keep[starts[inner] - 1] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    text, starts, ends = text[keep].tobytes(), at[starts], at[ends - 1] + 1
    a, b, row = _shingle_spans(first, shingle)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[x:y], 42) for x, y in zip(starts[a].tolist(), ends[b].tolist())), np.uint64, len(a))
    present, begin, count = np.unique(row, return_index=True, return_counts=True)
    half = (count // 2).astype(np.int64)
    packed = np.zeros(len(present), np.uint64)
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        bits = np.unpackbits(np.ascontiguousarray(raw[:, byte])[:, None], axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        high = np.packbits(ones > half[:, None], axis=1, bitorder="little")[:, 0]
        packed |= high.astype(np.uint64) << np.uint64(8 * byte)
    out[present] = packed
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3) -> DataFrame:
    """id and ``__fp``, the fingerprint as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def made(batches):
        for batch in batches:
            data, offsets = byte_buffer(batch.column(1))
            found = [fingerprints_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], shingle)
                     for a, b in pieces(offsets)]
            fp = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "__fp": pa.array(fp.view(np.int64))})

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(made, f"`{id_col}` {id_type}, __fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cut_rings(rings: list[list[int]], parts: int) -> tuple[list[list[int]], list[int], list[list[int]]]:
    """Each ring, a list of bits, is cut in ``parts`` segments. For every segment in turn:
    the bits left when it is fixed, the mask of all bits fixed by then, and the
    masks of the chains of 2, 3, ... segments that start with it."""
    left, fixed, chains = [], [], []
    for ring in rings:
        cuts = [len(ring) * i // parts for i in range(parts + 1)]
        segments = [ring[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        masks = [sum(1 << bit for bit in segment) for segment in segments]
        for i, segment in enumerate(segments):
            left.append([bit for bit in ring if bit not in segment])
            fixed.append((1 << 64) - 1 - sum(1 << bit for bit in left[-1]))
            chains.append([sum(masks[(i + step) % parts] for step in range(n)) for n in range(2, parts + 1)])
    return left, fixed, chains


def _stars(fp: np.ndarray, ring: np.ndarray, key: np.ndarray, chains: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a task's buckets as (member, smallest member of its local group);
    ``chains`` holds the masks of the chains of each ring number."""
    order = np.lexsort((fp, key, ring))
    fp, ring, key = fp[order], ring[order], key[order]
    n = len(fp)
    new = np.ones(n, bool)
    new[1:] = (ring[1:] != ring[:-1]) | (key[1:] != key[:-1])
    begin = np.flatnonzero(new)
    left = np.repeat(np.append(begin[1:], n), np.diff(np.append(begin, n))) - np.arange(n)  # rows of its bucket from here on
    parent = np.arange(n)
    active = np.flatnonzero(left > 1)
    lag = 1
    while len(active):
        u, v = active, active + lag
        for chain in range(distance):  # chains over their budget are dropped
            differ = fp[u] ^ fp[v]
            near = np.bitwise_count(differ & chains[ring[u], chain]) <= (chain + 2) * distance // (distance + 1)
            u, v = u[near], v[near]
        near = np.bitwise_count(fp[u] ^ fp[v]) <= distance
        u, v = u[near], v[near]
        while len(u):  # hook the larger root to the smaller one, then flatten
            a, b = parent[u], parent[v]
            apart = a != b
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(flat := parent[parent], parent):
                parent = flat
        lag += 1
        active = active[left[active] > lag]
    linked = parent != np.arange(n)
    return fp[linked], fp[parent[linked]]


def _compared(met: DataFrame, chains: list[list[int]], distance: int) -> DataFrame:
    """Edges (a, b) of the buckets of one round, (ring, key), each within one task."""
    masks = np.array(chains, np.uint64).reshape(len(chains), distance)

    def compare(key, table):
        a, b = _stars(np.asarray(table["fp"]).astype(np.int64).view(np.uint64), np.asarray(table["ring"]).astype(np.int64),
                      np.asarray(table["key"]).astype(np.int64), masks, distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    shards = max(shuffle_partitions(met.sparkSession), -(-met.count() // SHARD_ROWS))
    sharded = met.select("fp", "ring", "key", F.pmod(F.xxhash64("ring", "key"), F.lit(shards)).alias("__shard"))
    return dealt(sharded, shards, "__shard").groupBy("__shard").applyInArrow(compare, "a long, b long")


def links(distinct: DataFrame, *, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) whose
    components are those of all links."""
    parts = distance + 1
    rings, rows, edges = [list(range(64))], distinct.select("fp", F.lit(0).alias("ring")), None
    while True:
        rings, fixed, chains = _cut_rings(rings, parts)
        masks = F.array(*[F.lit(_signed(mask)).cast("long") for mask in fixed])
        keys = (rows.select("fp", F.explode(F.array(*[(F.col("ring") * parts + i).cast("int") for i in range(parts)])).alias("ring"))
                .withColumn("key", F.col("fp").bitwiseAND(F.get(masks, F.col("ring")))))
        sizes = keys.groupBy("ring", "key").agg(F.count("*").alias("n")).where("n > 1")
        met = written(keys.join(sizes, ["ring", "key"]), "buckets")
        last = max(map(len, rings)) <= LEAST_BITS or len(rings) * parts > MOST_RINGS
        large = met.where(F.col("n") > bucket)
        last = last or large.isEmpty()
        found = _compared(met if last else met.where(F.col("n") <= bucket), chains, distance)
        edges = found if edges is None else edges.unionByName(found)
        if last:
            return edges
        rows = large.select("fp", "ring")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest
    node reachable. Alternating large and small stars until nothing changes."""
    edges = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        edges = written(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, distance: int = 2,
           bucket: int = BUCKET) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    marked = written(fingerprints(docs, id_col, text_col, shingle=shingle), "fingerprints")
    distinct = written(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "distinct")
    roots = components(links(distinct.select("fp"), distance=distance, bucket=bucket))
    classed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = classed.where("root is not null")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(linked.join(least, "root").select(F.col("fp").alias("__fp"), "component_id", F.col("n").alias("__rows")), "named")
    # a fingerprint of many copies meets its name where its rows are
    return hot_join(marked, named, ["__fp"], "__rows", how="inner").select(
        id_col, F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")
