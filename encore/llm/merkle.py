"""Merkle dataset manifest: a digest per document, one root, a proof for each.

A leaf is the SHA-256 of a row's fields. The leaves of a group, in id order, are
hashed up in runs of ``fanout`` to the group's subroot, and the subroots, in group
order, to the root. A node's step is one record: its place in its run and the
digests beside it. A proof is the records from a leaf to the root.

Levels are hashed page by page: ``PAGE`` consecutive nodes of a level are one task's
group, which goes up several levels at once and returns every node's step.

Proofs are made by pointer jumping. At first a node's segment (its records) and
pointer lead to its parent. A round joins the table with itself: nodes at levels
that divide by the present distance append the segment of the node they point to, so that the
distance doubles and the segments are concatenated, until every leaf's pointer is its
group's subroot; after 2^k levels only N / fanout^(2^k) nodes are left to be
joined. The same is done for the subroots, and a last join brings a leaf from
its subroot to the root.

Scale: the text is read once, by the hash; only digests, ids and records go on.
Positions are dense ids (range partitions and prefix sums). A group with a large share
of all leaves is joined by a broadcast of bounded size (``common.hot_join``). A join key
of a jump has at most fanout^distance rows, and where this is large the nodes joined
are few and broadcast (at most ``2 N / FEW``).

Cases: a null field is ``-``; null ids and null groups come first; rows that repeat an
id are ordered by their digest, equal rows by their place in the written leaves; a
group of one leaf is its own subroot, and a table of one row its own root (the proof is empty); very
long texts are hashed whole; other columns aren't read unless named in ``carry``;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import dealt, hot_join, scratch_path, shuffle_partitions, written
from encore.operators.keys import dense_ids

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
PAGE = 1024
RANGE_ROWS = 2_000_000
FEW = 1 << 30  # rows under one key from which on the nodes joined are broadcast
_TOP = -1      # the tree of the subroots


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of the fields in order: ``-`` for null, else bytes, colon, value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*coded).cast("binary"), 256))


def _digest(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def _records(level: list[bytes], fanout: int) -> list[bytes]:
    """Each node's record: place in its run, number of others, their digests."""
    out = []
    for lo in range(0, len(level), fanout):
        run = level[lo:lo + fanout]
        out += [bytes([i, len(run) - 1]) + b"".join(run[:i] + run[i + 1:]) for i in range(len(run))]
    return out


def _page_levels(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= PAGE:
        levels += 1
    return levels


def height(n: int, fanout: int) -> int:
    """Levels over ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _power(fanout: int, exponent: int) -> int:
    return min(fanout ** exponent, 2**62)  # beyond it every index is 0


def _climb(fanout: int, base: int, carry: Sequence[str]):
    """Hashes one page of nodes at level ``base`` up to the page's top (or the root)
    and returns a row per node. The top of a page in a larger tree comes without
    a segment: its record needs the pages beside it."""
    steps = _page_levels(fanout)

    def climb(key, table):
        tree, page, n = key[0].as_py(), key[1].as_py(), table["__n"][0].as_py()
        table = table.take(pa.array(np.argsort(np.asarray(table["__idx"]), kind="stable")))
        nodes, first, top = table["__digest"].to_pylist(), page * fanout ** steps, height(n, fanout)
        rows: list[tuple] = []  # level, index, digest, segment
        stop = min(base + steps, top)
        for level in range(base, stop):
            rows += zip([level] * len(nodes), range(first, first + len(nodes)), nodes, _records(nodes, fanout))
            nodes = [_digest(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
            first //= fanout
        rows.append((stop, first, nodes[0], b"" if stop == top else None))
        level, index, digest, segment = zip(*rows)
        out = {"__tree": pa.array([tree] * len(rows), pa.int64()), "__level": pa.array(level, pa.int32()),
               "__idx": pa.array(index, pa.int64()), "__n": pa.array([n] * len(rows), pa.int64()),
               "__digest": pa.array(digest, pa.binary()), "__seg": pa.array(segment, pa.binary()),
               "__root": pa.array([x == top for x in level], pa.bool_())}
        for c in carry:
            own, above = table[c].combine_chunks(), len(rows) - table.num_rows
            out[c] = pa.concat_arrays([own, pa.nulls(above, own.type)]) if above else own
        return pa.table(out)
    return climb


def forest(leaves: DataFrame, most: int, tasks: int, fanout: int, carry: Sequence[str] = ()) -> DataFrame:
    """All nodes over leaves (``__tree``, ``__idx``, ``__n`` leaves in the tree,
    ``__digest``, carried columns): level, index, digest, step to the parent, is root.
    ``most``: leaves of the largest tree."""
    steps, made, base, level = _page_levels(fanout), [], 0, leaves
    while True:
        own = list(carry) if base == 0 else []
        kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in leaves.schema if f.name in own)
        pages = dealt(level.withColumn("__page", F.expr(f"__idx div {fanout ** steps}")), tasks, "__tree", "__page")
        made.append(written(pages.groupBy("__tree", "__page").applyInArrow(
            _climb(fanout, base, own), "__tree long, __level int, __idx long, __n long, __digest binary, __seg binary,"
            " __root boolean" + kinds), "merkle-nodes"))
        base += steps
        if base >= height(most, fanout):
            break
        level = made[-1].where("__seg is null").select("__tree", "__idx", "__n", "__digest")
    nodes = made[0]
    for more in made[1:]:
        nodes = nodes.unionByName(more, allowMissingColumns=True)
    return nodes.where("__seg is not null")


def jump(nodes: DataFrame, most: int, tasks: int, fanout: int, carry: Sequence[str] = ()) -> DataFrame:
    """The leaves with their whole segments, by pointer jumping."""
    leaves = nodes.where("__level = 0").select("__tree", "__idx", "__digest", "__seg", *carry)
    upper = nodes.where("__level > 0 and not __root").select("__tree", "__level", "__idx", "__seg")
    names = leaves.columns
    distance = 1
    while distance < height(most, fanout):
        power = _power(fanout, distance)
        up = F.expr(f"__idx div {power}")
        longer = F.concat("__seg", F.coalesce("__more", F.lit(b""))).alias("__seg")
        ahead = upper.select(F.col("__tree").alias("__t"), F.col("__level").alias("__l"), F.col("__idx").alias("__i"),
                             F.col("__seg").alias("__more"))
        target = ahead.where(F.col("__l") == distance)
        target = F.broadcast(target) if power >= FEW else dealt(target, tasks, "__t", "__i")
        pointing = leaves.withColumn("__up", up)
        pointing = pointing if power >= FEW else dealt(pointing, tasks, "__tree", "__up")
        leaves = (pointing.join(target, [pointing["__tree"] == target["__t"], pointing["__up"] == target["__i"]], "left")
                  .select(*[longer if c == "__seg" else F.col(c) for c in names]))
        if 2 * distance < height(most, fanout):
            a = upper.where(F.col("__level") % (2 * distance) == 0).withColumns({"__up": up, "__above": F.col("__level") + distance})
            upper = written(a.join(ahead, [a["__tree"] == ahead["__t"], a["__above"] == ahead["__l"], a["__up"] == ahead["__i"]], "left")
                            .select("__tree", "__level", "__idx", longer), "merkle-jump")
        distance *= 2
    return leaves


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", *, fields: Sequence[str] = FIELDS,
             carry: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """One row per input row: the id, carried columns, ``leaf``, ``proof`` (records),
    ``subroot``, ``root``; digests as 32 bytes."""
    spark = docs.sparkSession
    kept = [f"__c{i}" for i in range(1 + len(carry))]
    leaves = written(docs.select(
        F.col(group_col).alias("__group"), leaf_digest([F.col(c) for c in fields]).alias("__digest"),
        *[F.col(c).alias(k) for c, k in zip([id_col, *carry], kept)],
        F.monotonically_increasing_id().alias("__place")), "merkle-leaves")
    tasks = max(shuffle_partitions(spark), -(-leaves.count() // RANGE_ROWS))
    ided = dense_ids(leaves, [F.asc_nulls_first("__group"), F.asc_nulls_first(kept[0]), F.asc("__digest"), F.asc("__place")],
                     "__at", scratch_path(spark, "merkle-order"), tasks)
    sizes = written(ided.groupBy("__group").agg(F.min("__at").alias("__tree"), F.count(F.lit(1)).alias("__n")), "merkle-groups")
    trees = written(dense_ids(sizes, [F.asc_nulls_first("__group")], "__rank", scratch_path(spark, "merkle-ranks")), "merkle-trees")
    most, groups = trees.agg(F.max("__n"), F.count(F.lit(1))).first()
    most = most or 0

    placed = (hot_join(ided.drop("__place"), trees.drop("__rank"), ["__group"], "__n", how="inner")
              .withColumn("__idx", F.col("__at") - F.col("__tree")))
    nodes = forest(placed.select("__tree", "__idx", "__n", "__digest", *kept), most, tasks, fanout, kept)
    proofs = jump(nodes, most, tasks, fanout, kept)

    subroots = nodes.where("__root").select("__tree", "__digest").join(trees, "__tree").select(
        F.lit(_TOP).cast("long").alias("__tree"), (F.col("__rank") - 1).alias("__idx"), F.lit(groups).cast("long").alias("__n"),
        "__digest", F.col("__tree").alias("__of"), F.col("__n").alias("__leaves"))
    upper = forest(subroots, groups, tasks, fanout, ["__of", "__leaves"])
    root = upper.where("__root").select("__digest").scalar()
    tops = written(jump(upper, groups, tasks, fanout, ["__of", "__leaves"]).select(
        F.col("__of").alias("__tree"), F.col("__digest").alias("__subroot"), F.col("__seg").alias("__rest"),
        root.alias("__all"), "__leaves"), "merkle-subroots")
    return hot_join(proofs, tops, ["__tree"], "__leaves", how="inner").select(
        *[F.col(k).alias(c) for c, k in zip([id_col, *carry], kept)], F.col("__digest").alias("leaf"),
        F.concat("__seg", "__rest").alias("proof"), F.col("__subroot").alias("subroot"), F.col("__all").alias("root"))


def siblings(proof: bytes) -> list[tuple[int, list[bytes]]]:
    """A proof's records: (place in the run, the others' digests)."""
    out, at = [], 0
    while at < len(proof):
        place, others = proof[at], proof[at + 1]
        out.append((place, [proof[i:i + 32] for i in range(at + 2, at + 2 + 32 * others, 32)]))
        at += 2 + 32 * others
    return out


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for place, others in siblings(proof):
        leaf = _digest([*others[:place], leaf, *others[place:]])
    return leaf


def verify(proofs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """The proofs with ``proof_sha256`` (H of all siblings), ``folded_root`` (of the
    claimed leaf, else the manifest's) and ``verified``; digests as lowercase hex."""
    claimed = F.col("leaf") if claimed is None else F.coalesce(claimed, F.col("leaf"))
    names = [c for c in proofs.columns if c not in ("leaf", "proof", "subroot", "root")]
    taken = proofs.select(claimed.alias("__claim"), "proof", "root", *names,
                          *[F.lower(F.hex(c)).alias(f"__{c}") for c in ("leaf", "subroot", "root")])

    def folded(batches):
        for batch in batches:
            leaf, proof, root = (batch.column(i).to_pylist() for i in range(3))
            found = [fold(x, p) for x, p in zip(leaf, proof)]
            digest = [_digest([d for _, others in siblings(p) for d in others]).hex() for p in proof]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], pa.array(digest, pa.string()), pa.array([x.hex() for x in found], pa.string()),
                 pa.array([x == r for x, r in zip(found, root)], pa.bool_())], schema.names)

    kinds = {f.name: f.dataType.simpleString() for f in taken.schema}
    given = [(c, kinds[c]) for c in names] + [(c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = pa.schema([pa.field(c, pa.null()) for c, _ in given] + [pa.field("verified", pa.bool_())])
    return taken.mapInArrow(folded, ", ".join(f"`{c}` {k}" for c, k in given) + ", verified boolean")
