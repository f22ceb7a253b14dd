import random

import pytest
from pyspark.sql import functions as F

from encore.llm import repeats, simhash
from tests.llm import helpers as h


def _texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "ñandú", "日本"]
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, other = fresh(12), fresh(25)
    texts = [None, "", " \t\n", "short one", fresh(80), fresh(80)]
    texts += [f"{fresh(9)}\n{passage}  {fresh(7)}" for _ in range(5)]
    texts += [fresh(5) + " " + other, other + "\r\n" + fresh(3), other, "x " * 50, f"{passage} {passage}"]
    texts += [fresh(6000)] + [texts[4]] * 3
    return texts


@pytest.mark.parametrize("blocks", [1, 5])
def test_repeats_match_brute_force(spark, blocks):
    texts = _texts()
    got = repeats.remove_repeats(h.documents(spark, texts), window=10, anchor=4, blocks=blocks, carry=["lang"]).collect()
    want = h.repeats(texts, 10)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == dict(enumerate(want))
    for r in got:
        assert sum(b - a for a, b in zip(r.first_words, r.end_words)) == r.n_removed
        assert all(b - a >= 10 for a, b in zip(r.first_words, r.end_words))
        assert r.lang == "en" and r.was_null == (texts[r.doc_id] is None)


def test_repeats_with_repeated_and_null_ids_and_clashing_columns(spark):
    text = " ".join(map(str, range(12)))
    docs = h.documents(spark, [text, text, None, "a b"], [7, 7, None, None])
    docs = docs.withColumn("__block", F.lit("x")).withColumn("n_words", F.lit("y")).withColumn("anchor", F.lit(1))
    got = repeats.remove_repeats(docs, window=10, anchor=4, blocks=3).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed) for r in got) == [
        (False, 12, 12), (False, 12, 12), (True, 0, 0), (True, 2, 0)]
    assert repeats.remove_repeats(docs.limit(0), window=10, anchor=4).count() == 0


def test_repeats_of_one_row_fill_no_block(spark):
    from encore.llm.common import block_of
    text = " ".join(map(str, range(12)))
    docs = h.documents(spark, [text] * 900 + ["a b"], [7] * 900 + [8]).repartition(30)
    dealt = docs.groupBy(block_of(8, "doc_id", "text").alias("b")).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 500
    got = repeats.remove_repeats(docs, window=10, anchor=4, blocks=8).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, got)) == [(7, 12, 12, 900), (8, 2, 0, 1)]


@pytest.mark.parametrize("bucket", [1, 4096])
def test_simhash_groups_match_brute_force(spark, bucket):
    rng = random.Random(8)
    base = [" ".join(f"t{rng.randrange(4000)}" for _ in range(300)) for _ in range(6)]
    texts = [None, "", "one", "Two Words", "ONE", *base]
    for b in base[:4]:
        for _ in range(9):
            w = b.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append("  ".join(w))
    texts += [base[0]] * 4
    ids = [None if i == 5 else 1000 - i for i in range(len(texts))]
    got = simhash.groups(h.documents(spark, texts, ids), bucket=bucket).collect()
    prints = [h.fingerprint(t) for t in texts]
    want = sorted((i is None, i or 0, f"{p:016x}", c) for i, p, c in zip(ids, prints, h.components(prints, ids, 2)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == want


def test_simhash_links_dense_fingerprints_either_way(spark, monkeypatch):
    """Fingerprints that crowd one bucket: rings cut once or often find the same groups."""
    rng = random.Random(5)
    prints = list({0xABCDEF << 40 | sum(1 << rng.randrange(40) for _ in range(3)) for _ in range(400)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = h.components(prints, signed, 2)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 50)
    for bucket in (2, 4096):
        found = {r.node: r.root for r in simhash.components(simhash.links(frame, bucket=bucket)).collect()}
        assert [found.get(p, p) for p in signed] == want


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_simhash_links_at_other_distances(spark, distance):
    rng = random.Random(distance)
    prints = list({0x1234567 << 36 | sum(1 << rng.randrange(36) for _ in range(4)) for _ in range(150)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = h.components(prints, prints, distance)
    found = {r.node: r.root for r in simhash.components(simhash.links(frame, distance=distance, bucket=20)).collect()}
    assert [found.get(p, p) for p in prints] == want


def test_rings_are_cut_until_few_bits_are_open():
    """The union of what is fixed and what is left is all bits; five rounds leave at most 2 ** 12 values at distance 2."""
    rings, rounds = [list(range(64))], 0
    while max(map(len, rings)) > simhash.LEAST_BITS:
        rings, fixed, chains = simhash._cut_rings(rings, 3)
        rounds += 1
        for left, mask, chain in zip(rings, fixed, chains):
            assert mask == (1 << 64) - 1 - sum(1 << b for b in left) and len(chain) == 2
            assert chain[-1] & mask and set(left) <= {b for b in range(64) if chain[-1] >> b & 1}
    assert rounds == 5 and len(rings) == 243 <= simhash.MOST_RINGS


def test_simhash_of_an_empty_table(spark):
    assert simhash.groups(h.documents(spark, ["x"]).limit(0)).count() == 0
