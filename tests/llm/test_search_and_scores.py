import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from encore.llm import ann, decontaminate, quality, toxicity, urlfilter
from encore.llm.common import byte_buffer
from encore.llm.labelled import fit_calibration, held_out, sampled_documents
from tests.llm import helpers as h

SF = "/root/testdata/sf0.01"


def test_nearest_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 8))
    x[50:130] = x[7]  # a vector that a fifth of the rows share
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(1000, None), (1100, [0.0] * 8), (1200, [float("nan")] * 8), (1300, [None] * 8), (1400, [1.0]), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    got = ann.search(frame, every=20, trees=12, symbols=3, reach=120, candidates=4000, chunk=64).collect()
    hit = 0
    for q in range(0, 400, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(400), d)) if i != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert np.allclose([m[2] for m in mine], [d[m[1]] for m in mine])
        assert all(a[2:] + a[1:2] <= b[2:] + b[1:2] for a, b in zip(mine, mine[1:]))
        hit += len({m[1] for m in mine} & set(want))
    assert hit >= 0.97 * 200
    assert {r.query_id for r in got} == set(range(0, 400, 20))
    few = ann.search(frame.where("vec_id < 4"), every=2, trees=3, symbols=2).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(q, k) for q in (0, 2) for k in (1, 2, 3)]
    assert ann.search(frame.limit(0)).count() == 0


def nearest(x, ids, every, k=10):
    """Brute force: (query_id, rank, vec_id) over the rows of a matrix."""
    out = []
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        hits = [ids[i] for i in np.lexsort((ids, d)) if i != q][:k]
        out += [(ids[q], n + 1, i) for n, i in enumerate(hits)]
    return sorted(out)


def test_exact_where_the_forest_sees_few_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 300)
    monkeypatch.setattr(ann, "QUERY_ROWS", 20)
    x = np.random.default_rng(5).standard_normal((3000, 32))
    x[1500:2000] = np.round(x[1500:2000] / 3)  # many equal distances
    x[2000:2100] += 1e4  # far from the middle
    x = x[(x != 0).any(1)]
    ids = np.arange(len(x))
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = ann.search(frame, every=50, trees=3, symbols=2, reach=10, candidates=30, chunk=256).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == nearest(x, ids, 50)


def test_each_vector_length_is_searched(spark):
    rng = np.random.default_rng(9)
    parts = [(d, np.arange(a, a + n), rng.standard_normal((n, d))) for d, a, n in ((6, 0, 90), (4, 100, 60), (9, 200, 1), (3, 300, 5))]
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for _, ids, x in parts for i, v in zip(ids, x)],
                                  "vec_id long, embedding array<double>")
    got = ann.search(frame, every=20, trees=3, symbols=2).collect()
    want = [w for _, ids, x in parts for w in nearest(x, ids, 20)]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(want)


def test_an_id_with_many_vectors_answers_once():
    rng = np.random.default_rng(8)
    x, q = rng.standard_normal((900, 4)) * 1e200, rng.standard_normal((7, 4)) * 1e200
    x = np.concatenate([x, rng.standard_normal((900, 4))])
    code = rng.integers(0, 60, len(x))
    for scale in (1.0, 1e-250):
        got = ann.nearest_ids(x * scale, code, np.arange(len(x) + 1), q * scale, np.full(7, np.inf), 5)
        want = []
        for i in range(7):
            d = np.sqrt(((x * scale - q[i] * scale) ** 2).sum(1))
            each = sorted((d[code == c].min(), c) for c in np.unique(code))[:5]
            want += [(i, c, e) for e, c in each]
        assert list(zip(*(g.tolist() for g in got))) == want


def test_recall_on_the_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    table = frame.toPandas()
    x = np.stack(table["embedding"]).astype(float)
    ids = table["vec_id"].to_numpy()
    got = ann.search(frame).toPandas()
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & set(got[got.query_id == ids[q]].vec_id))
        total += 10
    assert hit >= 0.9 * total


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = module.score(docs, module.fit(docs, labels)).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.predicted == held[label]).mean() >= least
    assert found.score.between(0, 1).all()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, module, label):
    texts = [None, "", "\n\n", "a", "a\n" * 3000, "x " * 9000, "good words here", "BAD!! BAD!!"] + [f"fine text {i}" for i in range(20)]
    docs = h.documents(spark, texts, [None, *range(1, len(texts))]).withColumn("__text", F.lit(1)).withColumn("score", F.lit(2))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 20)] + [(3, None), (None, 1), (4, 0), (4, 0)], f"doc_id long, {label} int")
    for known in (labels, labels.limit(0), labels.where(f"{label} = 1")):
        rows = module.score(docs, module.fit(docs, known)).collect()
        assert len(rows) == len(texts)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    assert module.score(docs.limit(0), module.fit(docs, labels)).count() == 0
    assert module.score(docs.limit(3), module.fit(docs.limit(0), labels)).count() == 3


def test_small_tables_find_their_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert found.toxic.sum() > 0 and (found.predicted == found.toxic).all()
    # half of the rows are toxic, by one of four words each
    texts = [f"some plain words number n{i} {'bad' + 'abcd'[i // 2 % 4] if i % 2 else 'good'}" for i in range(80)]
    docs = h.documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).toPandas()
    assert found.held_out.sum() > 5 and (found.predicted == found.doc_id % 2).all()


def test_training_sample_is_bounded_when_one_id_repeats(spark):
    docs = h.documents(spark, ["same text"] * 300 + ["other text", None], [1] * 300 + [1, 2])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    rows = sampled_documents(docs, labels, "toxic", 10, "doc_id", "text").collect()
    assert sorted(r["__id"] for r in rows) == [i for i in (1, 2) if zlib.crc32(str(i).encode()) % 5]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 4, 5, 8])
    good, transition = rng.standard_normal(8), rng.standard_normal((2, 2))
    marginal, expected = quality.forward_backward(good, first, transition)
    want, moves = np.zeros(8), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        paths = [[n >> i & 1 for i in range(b - a)] for n in range(1 << (b - a))]
        weight = np.array([np.exp(sum(good[a + i] * s for i, s in enumerate(p)) + sum(transition[x, y] for x, y in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        for p, w in zip(paths, weight):
            want[a:b] += w * np.array(p)
            for x, y in zip(p, p[1:]):
                moves[x, y] += w
    assert np.allclose(marginal, want) and np.allclose(expected, moves)


def test_block_max_index_is_exact():
    rng = np.random.default_rng(4)
    n, v = 700, 40
    dense = np.where(rng.random((n, v)) < 0.1, rng.random((n, v)), 0)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    row, term = np.nonzero(dense)
    index = toxicity.Index(np.arange(v, dtype=np.uint64), np.ones(v), n, row, term, dense[row, term], np.zeros(n))
    for q in range(0, n, 25):
        t = np.flatnonzero(dense[q])
        ids, cosine = index.nearest(t, dense[q, t], 10, skip=q)
        all_of = dense @ dense[q]
        all_of[q] = -1
        want = np.sort(all_of[all_of > 0])[::-1][:10]
        assert np.allclose(cosine, want) and np.allclose(all_of[ids], cosine)


@pytest.mark.parametrize("dense, block, n", [(0, 16, 300), (7, 4, 300), (40, 16, 300), (256, 16, 9), (3, 64, 30)])
def test_index_is_exact_in_every_layout(monkeypatch, dense, block, n):
    monkeypatch.setattr(toxicity, "DENSE", dense)
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(6)
    x = np.where(rng.random((n, 40)) < rng.random(40), rng.random((n, 40)), 0)
    x[n // 2:n // 2 + 3] = x[1]  # ties
    x[2] = 0
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32).astype(float)
    row, term = np.nonzero(x)
    index = toxicity.Index(np.arange(40, dtype=np.uint64), np.ones(40), n, row, term, x[row, term], np.zeros(n))
    for q in range(0, n, 3):
        t = np.flatnonzero(x[q])
        for skip in (-1, q):
            cosine = x @ x[q]
            ids = [i for i in np.lexsort((np.arange(n), -np.round(cosine, 12))) if cosine[i] > 0 and i != skip][:10]
            got = index.nearest(t, x[q, t], 10, skip=skip)
            assert got[0].tolist() == ids and np.allclose(got[1], cosine[ids], atol=1e-12)


def test_texts_are_searched_in_batches(monkeypatch):
    rng = np.random.default_rng(8)
    words = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 4)) for _ in range(120)]
    texts = [" ".join(words[int(w)] for w in np.minimum(rng.zipf(1.3, 12), 120) - 1) for _ in range(90)]
    row, term, count = toxicity._counted(*toxicity._terms(*byte_buffer(pa.array(texts[:60]))))
    terms = np.unique(term)
    factor = rng.random(len(terms)) + 0.5
    monkeypatch.setattr(toxicity, "DENSE", 9)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    index = toxicity.Index(terms, factor, 60, *toxicity._vectors(terms, factor, row, term, count), np.arange(60) % 2)
    calls = []
    whole = toxicity.Index.nearest_of_each
    monkeypatch.setattr(toxicity.Index, "nearest_of_each", lambda self, term, weight, cut, *more: calls.append(len(cut) - 1) or whole(self, term, weight, cut, *more))
    index.nearest(np.array([0]), np.array([1.0]), 10)
    assert "dense" in vars(index)
    model = {"index": pickle.loads(pickle.dumps(index)), "ids": np.arange(60), "strangers": 0.4, "k": 10, "curve": (3.0, -1.0)}
    assert "dense" not in vars(model["index"])  # the matrix does not go with the tasks
    calls.clear()
    found = toxicity.score_batch(model, pa.array([*texts, None, "", "zzzzz", texts[3], texts[80]]))
    assert calls == [len({tuple(sorted(Counter(t.split()).items())) for t in texts})]  # one call, each text once
    dense = np.zeros((95, len(terms)))
    row, at, weight = toxicity._vectors(terms, factor, *toxicity._counted(*toxicity._terms(*byte_buffer(pa.array([*texts, "", "", "", texts[3], texts[80]])))))
    dense[row, at] = weight
    for i, cosine in enumerate(dense @ dense[:60].astype(np.float32).astype(float).T):
        want = [j for j in np.lexsort((np.arange(60), -np.round(cosine, 12))) if cosine[j] > 0][:10]
        assert found[1][i].tolist() == want and np.allclose(found[2][i], cosine[want], atol=1e-12)
        vote = toxicity._vote(cosine[want], index.labels[want], 0.4)
        assert abs(found[0][i] - 1 / (1 + math.exp(1 - 3 * vote))) < 1e-9


def test_toxicity_matches_a_plain_version(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(h.documents(spark, [None, "", "12 34", "Zq", "zq zq ZQ"], [10**6 + i for i in range(5)])
                            .select([F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(t).alias(c) for c, t in docs.dtypes]))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    words = {r.doc_id: Counter(re.findall(rb"[a-z\x80-\xff]+", (r.text or "").encode().lower())) for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in words}
    ids = sorted(known)
    n, t = len(ids), sum(known.values())
    everywhere = Counter(w for c in words.values() for w in c)
    holding, toxic = Counter(w for i in ids for w in words[i]), Counter(w for i in ids if known[i] for w in words[i])
    factor = {}
    for w, a in holding.items():
        among = a * (n - a) * t * (n - t)
        found = (toxic[w] * n - a * t) ** 2 / among if among else 0
        factor[w] = (math.log((1 + len(words)) / (1 + everywhere[w])) + 1) * (found * a / (a + 5) + 1 / n)

    def vector(i):
        v = {w: (1 + math.log(c)) * factor[w] for w, c in words[i].items() if w in factor}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: vector(i) for i in words}
    strangers = (t + 0.5) / (n + 1)

    def vote(i, skip=None):
        cosine = {j: sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()) for j in ids if j != skip}
        near = sorted((j for j in cosine if cosine[j] > 0), key=lambda j: (-round(cosine[j], 6), j))[:10]
        weight = [1 / (0.05 + max(1 - cosine[j], 0)) for j in near]
        return [cosine[j] for j in near], (sum(w * known[j] for w, j in zip(weight, near)) + strangers / 1.05) / (sum(weight) + 1 / 1.05)

    slope, shift = fit_calibration(np.array([vote(i, i)[1] for i in ids]), np.array([known[i] for i in ids], float))
    assert len(got) == len(words) == docs.count() and sum(len(r.nearest) > 0 for r in got.values()) >= 0.95 * len(got)
    for i in words:
        cosine, raw = vote(i)
        assert np.allclose(got[i].cosines, cosine, atol=1e-5)
        assert abs(got[i].score - 1 / (1 + math.exp(-(slope * raw + shift)))) < 1e-3
    assert not got[10**6].nearest and not got[10**6 + 2].nearest


def test_example_terms_are_bounded(spark):
    docs = h.documents(spark, [f"word{'abcdefgh'[i % 8]} {'bad' if i % 2 else 'good'} more" for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert len(toxicity.fit(docs, labels)["ids"]) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(60))
    assert len(toxicity.fit(docs, labels, fit_terms=31)["ids"]) == 11  # three terms each; the row that reaches the bound counts


def test_folds_are_crc32(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_url_filters(spark):
    urls = [None, "", "no scheme", "https://WWW.Example.com/en/1?x#y", "http://blog.example.com/en/", "http://example.com/EN/", "https://net/es/",
            "http://a.net/fr/x", "http://a.net/fr", "https://x.com", "https://x.com/", "http://xcom/", "http://casino.org/a", "http://mycasino.org/",
            "http://casino.com/", "a://b://c.com/", "http://ads-casino.org/", "http://casino.org/a", "http://h\nx.com/\n?"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    got = {r.page_id: r for r in urlfilter.judge(frame).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        (None, "allow"), (None, "allow"), (None, "allow"), ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"),
        ("net/es/", "block"), ("net/fr/", "block"), (None, "allow"), (None, "allow"), ("com/", "allow"), (None, "allow"), (None, "block"),
        (None, "allow"), ("com/", "allow"), (None, "allow"), (None, "block"), (None, "block"), ("com/", "allow")]
    assert (got[3].host, got[3].path) == ("www.example.com", "/en/1") and (got[0].host, got[1].path) == ("", "")
    assert got[18].host == "h\nx.com" and got[18].path == "/\n"
    assert urlfilter.judge(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        urlfilter.judge(frame, words=["--"])


def test_site_rules_fit_by_prefix_whatever_the_token_counts(spark):
    sites = [("net", "/fr", "block"), ("shop", "", "block"), ("a.org", "/x/y1", "block")]
    urls = ["http://a.net/france/x", "http://a.net/fr", "http://a.net/fr/1", "http://net/de", "http://b.net/", "http://shopping.org/z",
            "http://x.shop/", "http://workshop.org/", "http://a.org/x/y12", "http://a.org/x/y2", "http://y1.com/", "http://fr.com/"]
    for more in ([], [f"http://n{i}.net/" for i in range(20)], [f"http://w{i}.com/fr/{i}/y1" for i in range(20)]):
        frame = spark.createDataFrame(list(enumerate(urls + more)), "page_id long, url string")
        got = {r.page_id: r.rule for r in urlfilter.judge(frame, sites=sites, words=["casino"]).collect()}
        assert [got[i] for i in range(len(urls))] == [
            "net/fr", "net/fr", "net/fr", None, None, "shop", "shop", None, "a.org/x/y1", None, None, None]
        assert not any(got[i] for i in range(len(urls), len(got)))


def _plain_pattern(pattern, place):
    """Whether a pattern fits, by a walk over its characters."""
    text = pattern.lower()
    names = [0]
    host = place.split("/")[0]
    if text.startswith("||"):
        text, names = text[2:], [0, *[i + 1 for i, c in enumerate(host) if c == "."]]
    elif text.startswith("|"):
        text = text[1:]
    else:
        names = range(len(place) + 1)
    last = text.endswith("|")
    text = text[:-1] if last else text
    at = set(names)
    for c in text:
        if c == "*":
            at = set(range(min(at), len(place) + 1)) if at else at
        elif c == "^":
            at = {i + 1 for i in at if i < len(place) and not re.match("[a-z0-9_.%-]", place[i])} | (at & {len(place)})
        else:
            at = {i + 1 for i in at if i < len(place) and place[i] == c}
    return len(place) in at if last else bool(at)


@pytest.mark.parametrize("broadcast_rules", [0, 100_000])
def test_pattern_tables_match_a_plain_walk(spark, monkeypatch, broadcast_rules):
    monkeypatch.setattr(urlfilter, "BROADCAST_RULES", broadcast_rules)
    patterns = ["||ads.example.com^", "||shop^", "/banner/*/img^", "|http", "track", "*.gif|", "||a.b|", "-ad-", "^q^", "|net/x", "/Promo",
                "||example.com^*^deep^", ".com/x$y", "||org/[a](b)", "ex*le", "|", "||", "", None, "track"]
    verdicts = [("allow" if i % 4 == 0 else "block") if i % 5 else None for i in range(len(patterns))]
    urls = ["http://ads.example.com/", "http://bads.example.com/", "http://x.shop", "http://shopping.org/", "http://z.de/banner/1/img/2",
            "http://z.de/banner/img", "http://track.de/", "http://mytracker.de/", "http://h.de/a.GIF", "http://h.de/a.gif.b", "http://a.b", "http://c.a.b",
            "http://a.b/", "http://z.de/x-ad-y", "http://z.de/q/", "http://z.de/qq", "http://net/x1", "http://b.net/x", "http://z.de/promo1",
            "http://www.Example.com/1/deep", "http://z.com/x$y", "http://o.org/[a](b)", "http://o.org/ab", "no scheme", None]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("pattern", F.lit(1))
    table = spark.createDataFrame(list(zip(patterns, verdicts)), "pattern string, verdict string").withColumn("host", F.lit("x"))
    got = {r.page_id: (r.pattern, r.verdict) for r in urlfilter.judge(frame, sites=[], words=[], patterns=table).collect()}
    chosen = {}
    for p, v in zip(patterns, verdicts):
        if p and p.strip("|"):
            chosen[p.lower()] = max(chosen.get(p.lower(), ""), v or "block")
    for i, url in enumerate(urls):
        place = re.split("[?#]", url.split("://", 1)[1])[0].lower() if url and "://" in url else ""
        fits = [p for p in chosen if url is not None and _plain_pattern(p, place)]
        best = max(fits, key=lambda p: (len(p), p), default=None)
        assert got[i] == (best, chosen[best] if best else "allow"), (url, fits)


def test_many_patterns_stay_out_of_the_plan(spark):
    table = spark.range(50_000).select(F.concat(F.lit("||host"), "id", F.lit(".com^")).alias("pattern"), F.lit("block").alias("verdict"))
    frame = spark.range(2_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.host"), F.col("id") * 50, F.lit(".com/a")).alias("url"))
    judged = urlfilter.judge(frame, sites=[], patterns=table)
    assert len(judged._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert judged.where("verdict = 'block' and pattern = concat('||host', page_id * 50, '.com^')").count() == 1_000
    empty = urlfilter.judge(frame, sites=[], words=[], patterns=table.limit(0))
    assert empty.where("verdict = 'allow'").count() == 2_000


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_decontamination_matches_brute_force(spark, broadcast_rows):
    rng = np.random.default_rng(6)
    make = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 300, n))
    items = [make(n) for n in (4, 5, 9, 12, 31, 60, 128)] + [None, "", make(20)]
    items.append(items[4])
    texts = [None, "", "a b"] + [f"{make(50)}\n{t} {make(900)}" for t in items if t]
    for t in items[3:7]:
        w = t.split()
        w[len(w) // 2] = "changed"
        texts += [" ".join(w).upper(), " ".join(w[: len(w) // 2]), " ".join(w[: int(len(w) * 0.9)])]
    docs = h.documents(spark, texts).withColumn("__key", F.lit(1)).withColumn("item_id", F.lit(2))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = decontaminate.contained_items(docs, bench, broadcast_rows=broadcast_rows, broadcast_bytes=broadcast_rows).collect()
    want = h.contained(texts, items)
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, j) for i, js in enumerate(want) for j in js]
    clean = decontaminate.clean_documents(docs, bench).collect()
    assert sorted(r.doc_id for r in clean) == [i for i, js in enumerate(want) if not js]
    assert decontaminate.contained_items(docs.limit(0), bench).count() == 0
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0
