"""Merkle manifest, line dedup and fill-in-middle against plain versions."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm import infill, linededup, merkle
from encore.llm.common import byte_buffer, hot_join, written
from tests.llm import helpers as h

# Merkle manifest -------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, fields=merkle.FIELDS):
    coded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*[coded(row[f]) for f in fields])


def plain_tree(digests, fanout):
    """Root, and per leaf its siblings from the leaf upwards."""
    paths, at = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(lo, min(lo + fanout, len(digests))) for lo in range(0, len(digests), fanout)]
        for run in runs:
            for i in run:
                for leaf in at[i]:
                    paths[leaf] += [digests[j] for j in run if j != i]
        at = [[leaf for i in run for leaf in at[i]] for run in runs]
        digests = [H(*[digests[i] for i in run]) for run in runs]
    return digests[0], paths


def plain_manifest(rows, fanout=2):
    none_first = lambda v, blank: (v is not None, v if v is not None else blank)
    groups = sorted({r["lang"] for r in rows}, key=lambda g: none_first(g, "") if g is None else (True, g.encode()))
    order, subroots, paths = [], [], []
    for g in groups:
        mine = sorted((r for r in rows if r["lang"] == g), key=lambda r: (*none_first(r["doc_id"], 0), plain_leaf(r)))
        root, found = plain_tree([plain_leaf(r) for r in mine], fanout)
        order.append(mine)
        subroots.append(root)
        paths.append(found)
    root, above = plain_tree(subroots, fanout)
    return sorted((str(r["doc_id"]), plain_leaf(r), s, root, H(*p, *up)) for mine, s, ps, up in zip(order, subroots, paths, above)
                  for r, p in zip(mine, ps))


def documents_of(rng, sizes):
    rows = [{"doc_id": i, "text": rng.choice(["", "é\n日", "x" * 70_000, "a:b", None]), "lang": g, "source": rng.choice(["s", None]),
             "n_chars": rng.choice([None, 0, -5, i])} for i, g in enumerate(g for g, n in sizes.items() for _ in range(n))]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows], h.DOC)


@pytest.mark.parametrize("fanout,page,sizes", [
    (2, 1024, {"en": 1}), (2, 4, {"en": 37, None: 5, "": 1, "Z": 2, "a": 16}), (3, 9, {"en": 28, "é": 3}), (5, 5, {c: 1 for c in "abcdefg"}),
    (2, 1024, {"en": 300, "de": 2})])
def test_manifest_matches_plain_trees(spark, monkeypatch, fanout, page, sizes):
    monkeypatch.setattr(merkle, "PAGE", page)
    rows = documents_of(random.Random(5), sizes)
    for r in rows[:2]:
        rows.append(dict(r))  # repeated rows
    if len(rows) > 5:
        rows[2]["doc_id"] = rows[3]["doc_id"] = None
    docs = frame(spark, rows).withColumn("__tree", F.lit("x")).withColumn("root", F.lit(1))
    got = merkle.verify(merkle.manifest(docs, fanout=fanout)).collect()
    assert all(r.verified and r.folded_root == r.root for r in got)
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == plain_manifest(rows, fanout)


def test_a_changed_row_is_found_and_others_hold(spark):
    rows = documents_of(random.Random(2), {"en": 20, "de": 3})
    found = merkle.manifest(frame(spark, rows), carry=["n_chars"])
    changed = F.when(F.col("doc_id") % 4 == 0, F.unhex(F.sha2(F.lit(b"other"), 256)))
    for r in merkle.verify(found, changed).collect():
        assert r.verified == (r.doc_id % 4 != 0) and (r.folded_root == r.root) == r.verified


def test_manifest_of_nothing(spark):
    assert merkle.verify(merkle.manifest(frame(spark, documents_of(random.Random(1), {"en": 1})).limit(0))).count() == 0


def test_large_groups_are_joined_apart(spark):
    rows = spark.range(500).selectExpr("if(id < 400, 'hot', if(id < 450, null, cast(id as string))) as k", "id")
    keyed = written(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")), "keyed")
    for share in (1e-4, 0.5, 2.0):
        import encore.llm.common as common
        before, common.HOT_SHARE = common.HOT_SHARE, share
        try:
            got = hot_join(rows.where("k is null or k != '499'"), keyed.where("k is null or k != '451'"), ["k"], "n").collect()
        finally:
            common.HOT_SHARE = before
        assert len(got) == 499
        assert all(r["last"] == (399 if r.id < 400 else 449 if r.id < 450 else None if r.id == 451 else r.id) for r in got)


# Line dedup ------------------------------------------------------------------


def plain_lines(rows, min_chars=20, min_documents=3):
    low = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(low(line), set()).add(i)
    least = lambda ids: max(ids, key=lambda i: (i is not None, i or 0))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(low(x)) < min_chars or len(held[low(x)]) < min_documents or least(held[low(x)]) == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines_match_a_plain_version(spark):
    rng = random.Random(4)
    pool = ["A line that many documents hold", "  a LINE that many documents hold\t", "Ünïcode lines of É and é over twenty", "ünïcode lines of É and é over twenty",
            "short", "", "x" * 19, "y" * 20, "\r", "one more line with twenty or so", "日本語の行" * 4]
    rows = [(i, "\n".join(rng.choice(pool + [f"a line of document {i} alone, {k}"]) for k in range(rng.randrange(0, 30)))) for i in range(40)]
    rows += [(None, "y" * 20), (None, pool[0]), (50, None), (51, ""), (52, "\n"), (53, "\n".join([pool[0]] * 5000)), rows[3], rows[3], (9, pool[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("x")).withColumn("__k1", F.lit(1)).repartition(7)
    got = linededup.drop_repeated_lines(docs, carry=["__k1"]).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got) == plain_lines(rows)
    assert {r["__k1"] for r in got} == {1}


def test_bitmaps_are_runs_of_kept_lines(spark):
    line = "one line of more than twenty characters"
    rows = [(i, f"{line}\n{i}\n{line}\n{line}\n{i}\n{i}") for i in range(3)]
    maps = linededup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(m.n_dropped, [tuple(r) for r in m.kept_runs]) for m in maps] == [(3, [(1, 1), (4, None)])] * 2


def test_lines_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string").limit(0)
    assert linededup.drop_repeated_lines(docs).count() == 0


def test_a_key_of_many_documents_is_parted(spark):
    """The ranges of the streamed rows cut through one key's documents."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one line that all documents do hold").alias("text"))
    lines = written(linededup.eligible_lines(rows, "doc_id", "text", 20), "lines")
    found = linededup.repeated_keys(lines, 3).collect()
    assert [(r["__keeper"], r["__holders"]) for r in found] == [(19_999, 20_000)]
    part = F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(linededup.ID_PARTS)).cast("int")
    dealt = lines.withColumn("__part", part).repartitionByRange(8, "__k1", "__k2", "__part").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 5_000


def test_line_dedup_stays_in_spark(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = linededup.drop_repeated_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Fill-in-middle --------------------------------------------------------------


def plain_infill(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, draw = len(units), infill.draws(doc_id)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or draw[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = draw[3] % 100 < spm_rate
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def infill_texts():
    rng = random.Random(6)
    some = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    texts = [None, "", "a", "\n", "a\nb", "\n\n", "é\n\nü<P", "x<P>y", "<", "a<S", "S>", "M>\n<", "a\r\nb c\x0bd"]
    texts += [some("ab\n é日🙂<PSM", rng.randrange(0, 3000)) for _ in range(60)]
    shared = some("abcdefgh é日\n", 9000)
    texts += [shared, "new start " + shared, shared + shared, "z" * 70_000, "z" * 40_000 + "\n" + "z" * 40_000, some("ab\n", 300_000)]
    return texts + [some("xy \n", at) + mark + some("xy\n", 50) for at in range(600, 640) for mark in ("<P>", "<S", "<M>")]


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (40, 0)])
def test_infill_matches_a_plain_version(spark, rate, spm_rate):
    texts = infill_texts()
    docs = h.documents(spark, texts).withColumn("form", F.lit("x")).withColumn("__text", F.lit("y"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("a\nb\nc")))
    made = infill.transform(docs, carry=["lang"], rate=rate, spm_rate=spm_rate)
    got = made.withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    want = {i: plain_infill(i, t, rate, spm_rate) for i, t in [*enumerate(texts), (None, "a\nb\nc")]}
    assert len(got) == len(want)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want[r.doc_id] and r.lang == "en"
        assert r.again == ("a\nb\nc" if r.doc_id is None else texts[r.doc_id] or "")


def test_chunks_depend_on_content_alone():
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdefghijk \n") for _ in range(60_000))
    data, offsets = byte_buffer(pa.array([shared, "moved by a few words " + shared], pa.string()))
    ends = infill.chunk_ends(data, offsets)
    raw, starts = data.tobytes(), [0, *ends[:-1].tolist()]
    chunks = [raw[a:b] for a, b in zip(starts, ends.tolist())]
    first = set(chunks[:sum(e <= offsets[1] for e in ends)])
    second = chunks[sum(e <= offsets[1] for e in ends):]
    assert b"".join(chunks) == raw and max(map(len, chunks)) <= infill.CHUNK_MOST
    assert sum(c in first for c in second) >= len(second) - 2


def test_summaries_start_anew_when_full():
    few, many = infill.Summaries(most=500), infill.Summaries()
    chunks = [bytes([65 + i % 20]) * 100 + b"\n\xc3\xa9" for i in range(200)]
    assert [few.of(c) for c in chunks] == [many.of(c) for c in chunks] and many.hits == 180 and len(few.kept) < 5


def test_infill_of_nothing(spark):
    assert infill.transform(h.documents(spark, ["a"]).limit(0)).count() == 0
    assert infill.transform(h.documents(spark, ["a\nb"]), rate=0).first().form == "plain"
    assert isinstance(infill.transform(h.documents(spark, ["a"])).schema["n"].dataType, T.LongType)
