"""Vector tree, source audit and fill-in-the-middle against brute force; odd rows and large groups in each."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm_operators import ODD, SCHEMA
from wxrisk.llm import fill_middle, source_audit, toxicity, vector_tree

# ---- fill in the middle


def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def middle_texts():
    draw = random.Random(4)
    passage = "".join(draw.choice("abc XYZ éß€😀\n1") for _ in range(20_000))
    texts = [None, "", "a", "é", "😀" * 9000, "a" * 9000, "1" * 9000, "one <P> two", "a<S", "<<S>>", "ab" * 300 + "é" * 900, passage, "x" + passage, passage * 70]
    for _ in range(300):
        k = draw.randrange(15_000)
        texts.append("".join(draw.choice("ab é1") for _ in range(draw.randrange(60))) + passage[k:k + draw.randrange(4000)])
    return list(enumerate(texts))


def test_middles_equal_plain_cuts(spark):
    rows = [*middle_texts(), (None, "no id at all"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("output", F.lit("clash")).withColumn("n", F.lit("clash"))
    found = [tuple(r) for r in fill_middle.transformed(docs).collect()]
    assert sorted(found, key=str) == sorted((brute_middle(*r) for r in rows), key=str)
    assert {f for _, _, f, *_ in found} == {"plain", "psm", "spm"}
    sums = {r.doc_id: r for r in fill_middle.digests(fill_middle.transformed(docs)).collect()}
    for i, text in rows:
        if text is not None and i != 7:
            assert sums[i].restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_chunks_follow_the_content_and_every_cut_is_found():
    text = middle_texts()[11][1].encode()
    shifted = ("é" * 700 + "ab ").encode() + text
    ends, moved = (set(fill_middle.chunk_ends(np.frombuffer(t, np.uint8)).tolist()) for t in (text, shifted))
    by = len(shifted) - len(text)
    assert len(ends) > 20 and len({e + by for e in ends} & moved) > 0.9 * len(ends)
    pieces, fill_middle.PIECE = fill_middle.PIECE, 1000
    assert set(fill_middle.chunk_ends(np.frombuffer(text, np.uint8)).tolist()) == ends
    fill_middle.PIECE = pieces
    kept = fill_middle.Summaries()
    whole = fill_middle.Cuttable(text, kept)
    assert kept.hits == 0
    fill_middle.Cuttable(shifted, kept)
    assert kept.hits > 0.8 * len(ends)
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text.decode())
    assert whole.n == len(units)
    for k in random.Random(1).sample(range(len(units) + 1), 400):
        begin = "".join(units[:k])
        assert whole.cut(k) == (len(begin.encode()), len(begin))


def test_summaries_of_a_full_cache_stay_right():
    small, text = fill_middle.Summaries(limit=2000), ("word 1 " * 40 + "é").encode() * 30
    a, b = fill_middle.Cuttable(text, small), fill_middle.Cuttable(text, fill_middle.Summaries())
    assert small.held <= 2000 and a.units.tolist() == b.units.tolist() and a.points.tolist() == b.points.tolist()


def test_middles_of_odd_rows_and_none(spark):
    odd, none = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([], SCHEMA)
    found = [tuple(r) for r in fill_middle.transformed(odd).collect()]
    assert sorted(found, key=str) == sorted((brute_middle(r[0], r[1]) for r in ODD), key=str)
    assert fill_middle.transformed(none).count() == 0


# ---- source audit


def brute_audit(rows, least, ranks):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, w) for name, s, w in docs if name == lang]
        frequency = Counter(t for _, w in own for t in set(w))
        kept = [t for t, n in frequency.items() if n >= least]
        counts = {s: Counter() for s, _ in own}
        for s, w in own:
            counts[s].update(t for t in w if frequency[t] >= least)
        total = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s, c in counts.items():
            pairs = sorted((-sum(abs(p(c, t) - p(o, t)) for t in kept), x.encode(), x) for x, o in counts.items() if x != s)
            out += [(lang, s, "pair", x, -v, k + 1) for k, (v, _, x) in enumerate(pairs)]
            more = sorted((p(total, t) - p(c, t), t.encode(), t) for t in kept if c[t] > 0 and p(c, t) > p(total, t))
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(more[:ranks])]
    return sorted(out)


def audit_rows():
    draw, rows = random.Random(6), []
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)] + ["élan", "ÉLAN", "ﬀ", "😀a", "Zed"]
    for k in range(500):
        lang = draw.choice(["en"] * 6 + ["de", "", None])
        source = draw.choice([None, "", *(f"s{j}" for j in range(9))]) if lang != "en" else draw.choice(["hot"] * 5 + [f"s{j}" for j in range(9)])
        top = len(words) if lang == "en" else 60
        rows.append((" ".join(draw.choice(words[:draw.randrange(2, top)]) for _ in range(draw.randrange(60))), lang, source))
    return [*rows, (None, "en", "empty"), ("", "xx", "a"), ("alone", "xx", "b"), ("12 34", None, None)]


@pytest.mark.parametrize("least, ranks, bucket", [(5, 50, 4096), (3, 7, 16), (10**6, 50, 4096)])
def test_audit_equals_brute_force(spark, monkeypatch, least, ranks, bucket):
    monkeypatch.setattr(source_audit, "BUCKET_TERMS", bucket)
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("clash")).withColumn("n", F.lit("clash"))
    found = source_audit.divergences(docs.repartition(5), least, ranks)
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, least, ranks)


def test_pairs_between_blocks_of_sources(spark):
    draw = random.Random(9)
    rows = [(" ".join(draw.choice("abcdefgh") for _ in range(20)), "en", f"s{k}") for k in range(90)]
    found = source_audit.divergences(spark.createDataFrame(rows, "text string, lang string, source string"), 3, 5)
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, 3, 5)


def test_audit_of_odd_rows_and_none(spark, monkeypatch):
    odd, none = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert sorted(map(tuple, source_audit.divergences(odd, 1).collect())) == brute_audit([r[1:4] for r in ODD], 1, 50)
    assert source_audit.divergences(none).count() == 0
    monkeypatch.setattr(source_audit, "MOST_HELD", 0)
    assert sorted(map(tuple, source_audit.divergences(odd, 1).collect())) == brute_audit([r[1:4] for r in ODD], 1, 50)


def test_shares_stay_exact_beyond_64_bit_products(spark):
    cases = [(5, 7), (10**14 + 3, 9 * 10**14 + 1), (9 * 10**14, 9 * 10**14), (1, 10**15)]
    want = [1 + 10**9 * a // b for a, b in cases]
    assert source_audit.share_of(np.array([a for a, _ in cases]), np.array([b for _, b in cases])).tolist() == want
    made = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a long, b long").withColumn("p", source_audit.share(F.col("a"), F.col("b")))
    assert [r.p for r in made.orderBy("k").collect()] == want


# ---- vector tree


def brute_neighbours(rows, k, every):
    def plays(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    width = max((len(v) for i, v in rows if i is not None and plays(v)), default=0)
    known = [(i, tuple(float(np.float32(x)) for x in v) + (0.0,) * (width - len(v))) for i, v in rows if i is not None and plays(v)]
    out = {}
    for i in {i for i, _ in known if i % every == 0}:
        q = min(v for j, v in known if j == i)
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in known if j != i)[:k]
        out[i] = [(j, -s) for s, j in best]
    return out


def test_neighbours_reach_the_recall_on_all_queries(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 16))
    rows = [(k, (centres[k % 40] + 0.4 * draw.normal(size=16)).astype(np.float32).tolist()) for k in range(6000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit("clash")).withColumn("leaf", F.lit("clash"))
    index = vector_tree.VectorIndex.built(vectors)
    queries = index.rows.where("vec_id % 20 = 0")
    index.calibrate(queries, 20)
    assert index.tree.leaves > 10 and index.visits < index.tree.leaves and index.calibrated_recall >= vector_tree.RECALL
    assert sum(index.sizes.values()) == 6000
    found = {}
    for r in vector_tree.neighbours(vectors).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_neighbours(rows, 20, 20)
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in best}) for q, best in want.items())
    assert hit >= 0.93 * 20 * len(want)
    vector_of = {i: np.array(v) for i, v in rows}
    for q, own in found.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - vector_of[q] @ vector_of[i]) < 1e-12 for i, s in own)


def test_equal_vectors_are_told_by_id_and_split_over_segments(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "SEGMENT", 50)
    monkeypatch.setattr(vector_tree, "VISITORS", 7)
    monkeypatch.setattr(vector_tree, "FIRST_LEAVES", 1)
    monkeypatch.setattr(vector_tree, "WIDER", 2)
    rows = [(k, [0.6, 0.8, 0.1] if k % 3 else [0.1 * (k % 7), 0.3, -0.2]) for k in range(600)]
    found = {}
    for r in vector_tree.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_neighbours(rows, 5, 20)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, float("nan")]), (80, [float("inf"), 1.0]), (100, [1.0, None]), (120, []), (None, [1.0, 1.0]),
            (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [2.0]), (140, [1.0, 1.0]), (140, [2.0, 1.0]), (3, [1.0, 1.0, 5.0])]
    found = {}
    for r in vector_tree.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    assert found == brute_neighbours(rows, 20, 20)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_tree.neighbours(none).count() == 0
    assert vector_tree.neighbours(spark.createDataFrame([(0, [1.0])], none.schema)).count() == 0
    assert vector_tree.neighbours(spark.createDataFrame([(1, [1.0]), (2, [1.0])], none.schema)).count() == 0


def test_all_leaves_make_the_search_exact(spark):
    draw = np.random.default_rng(5)
    rows = [(k, draw.normal(size=8).astype(np.float32).tolist()) for k in range(900)]
    index = vector_tree.VectorIndex.built(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), leaf_rows=40)
    assert index.visits == index.tree.leaves > 5
    queries = index.rows.where("vec_id % 100 = 0")
    found = {}
    for r in index.search(queries, 10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {q: [i for i, _ in best] for q, best in brute_neighbours(rows, 10, 100).items()}


# ---- block-max index of the toxicity examples


def test_each_text_is_spaced_once(monkeypatch):
    index = toxicity.ExampleIndex({"bad": 2.0, "^good": 1.0}, vocabulary=np.sort(toxicity.common.word_hashes(pa.array(["good day"]))[0]), word_idf=np.ones(2))
    index.add([(k, k % 2, *index.vector(t)) for k, t in enumerate(["good day", "bad day", "goodness"])])
    model = toxicity.ToxicityModel(index, 0.5, 0.5, np.array([1.0]), np.array([0.5]))
    texts = ["Bad DAY, good!", "goodness", "", "nothing known"]
    alone = [model.score(t) for t in texts]
    calls, plain = [], toxicity.spaced
    monkeypatch.setattr(toxicity, "spaced", lambda text: calls.append(text) or plain(text))
    assert model.scores(texts) == alone and calls == texts
    assert alone[0][2] == ["bad", "day", "good"] and alone[1][2] == ["^good"] and alone[2] == alone[3] == (0.5, [], [])


def test_blocks_that_cannot_reach_the_kth_cosine_are_skipped(monkeypatch):
    draw = np.random.default_rng(6)
    monkeypatch.setattr(toxicity, "DENSE", 20)
    words = ["".join(chr(97 + int(x)) for x in draw.integers(0, 26, 6)) for _ in range(400)]
    index = toxicity.ExampleIndex({w: float(1 + k % 5) for k, w in enumerate(dict.fromkeys(words))})
    texts = []
    for k in range(900):
        family = 40 + 9 * (k % 40)
        texts.append(" ".join(words[int(j)] for j in [*draw.integers(0, 40, 4), *draw.integers(family, family + 9, 12)]))
    vectors = index.vectors(texts)
    index.add([(k, k % 2, at, w) for k, (at, w, _) in enumerate(vectors)])
    dense = np.zeros((len(index.ids), len(index.values)))
    for row, (a, b) in enumerate(zip(index.begins[:-1], index.begins[1:], strict=True)):
        dense[row, index.columns[a:b]] = index.weights[a:b]
    asked = [(at, w) for at, w, _ in vectors[:200]]
    for leave in (None, list(range(200))):
        index.read = index.there = 0
        for j, ((at, w), (near, cosines)) in enumerate(zip(asked, index.nearest_of(asked, leave=leave), strict=True)):
            whole = dense[:, at] @ w
            if leave:
                whole[index.ids == j] = 0
            want = np.lexsort((np.arange(len(whole)), -np.round(whole, 12)))[:toxicity.NEIGHBOURS]
            want = want[whole[want] > 0]
            assert near.tolist() == want.tolist() and np.allclose(cosines, whole[want])
        assert 0 < index.read < 0.5 * index.there
