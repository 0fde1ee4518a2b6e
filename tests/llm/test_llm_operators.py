"""Operators without SQL against brute force, held-out labels and round trips; odd rows in all of them."""

import glob
import hashlib
import base64
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wxrisk.llm import block_labeller, chat, common, jaccard, license_scan, line_rules, mixing, spaced_seeds, toxicity, url_filter, warc
from wxrisk.llm.blocks import blocks_of
from wxrisk.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, rules string, size long"
LONG = "word " * 60_000 + "end."
ODD = [
    (1, None, "en", "a", None, "x", "y", 1), (2, "", "en", None, 0, None, None, None), (None, "one two three four five six", None, None, 3, "n", "r", 2),
    (3, "one two three four five six", "en", "a", 27, "n", "r", 2), (3, "one two three four five six", "en", "a", 27, "n", "r", 2),
    (4, LONG, "en", "b", len(LONG), "n", "r", 2), (5, " \n\t ", None, "b", 4, "n", "r", 2), (6, "one", "en", "b", 3, "n", "r", 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def grams(text, width):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} - {()} if len(words) < width else {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute_components(rows, width, percent):
    sets = [(i, grams(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    best = {}
    for k, (i, _) in enumerate(sets):
        best[find(k)] = min(i, best.get(find(k), i))
    return sorted((i, len(s), best[find(k)]) for k, (i, s) in enumerate(sets))


def near_copies(seed):
    draw, rows = random.Random(seed), []
    passage = [f"p{k}" for k in range(60)]
    for family in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(3, 90))]
        if family % 3 == 0:
            base = passage + base[:draw.randrange(3, 30)]
        for _ in range(draw.choice((1, 2, 6, 15))):
            words = list(base)
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
    return rows


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 60)])
def test_jaccard_components_equal_brute_force(spark, width, percent):
    rows = near_copies(width)
    found = jaccard.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), width, percent)
    assert sorted(map(tuple, found.collect())) == brute_components(rows, width, percent)


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5)], "x long, y long")
    labels = dict(map(tuple, components(chain, common.stages(chain, "t")).collect()))
    assert labels == {k: 0 for k in range(41)} | {100: 100, 101: 100}
    assert components(chain.limit(0), common.stages(chain, "t")).count() == 0


def test_jaccard_odd_rows(odd, none):
    found = sorted(jaccard.near_duplicate_components(odd).collect(), key=str)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert len(found) == len(ODD)
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[5] == (0, 5) and by_id[6] == (1, 6)
    assert by_id[3] == (3, 3) and by_id[None] == (3, 3)
    assert jaccard.near_duplicate_components(none).count() == 0
    kept = jaccard.one_of_each_group(odd).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "4", "5", "6"] and kept[0].asDict().keys() == odd.first().asDict().keys()


def test_toxicity_on_held_out_rows_and_odd_rows(spark, odd, none):
    folder = "/root/testdata/sf0.1"
    docs, labels = (common.table(spark, folder, t) for t in ("documents", "labels"))
    model = toxicity.fitted(docs, labels)
    rows = toxicity.scored(docs, model).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted == r.toxic == 1 for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.8 * sum(r.predicted for r in rows)
    found = toxicity.scored(odd, model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.scored(none, model).count() == 0
    assert toxicity.keep_harmless(odd, model).columns == odd.columns
    blank = toxicity.fitted(none.select("doc_id", "text"), labels)
    assert blank.score("idiot")[0] == 0.0


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(k, f"text number{k} {'vile' if k % 3 == 0 else 'kind'}") for k in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    other = labels.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.scored(docs, toxicity.fitted(docs, y)).select("doc_id", "score").collect() for y in (labels, other))
    assert one == two


def test_every_example_is_indexed_with_all_of_its_words(spark):
    draw = random.Random(8)
    rows = [(k, " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(30)), int(k % 10 == 0)) for k in range(200)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs = known.select("doc_id", "text").unionByName(known.select(F.col("doc_id") + 1000, F.concat("text", F.lit(" end"))).toDF("doc_id", "text"))
    model = toxicity.fitted(docs, known.select("doc_id", F.lit(1).alias("quality"), "toxic"))
    usable = {r.doc_id for r in known.where(~toxicity.is_held_out(F.col("doc_id"))).collect()}
    assert set(model.index.ids.tolist()) == usable
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    for k in usable:
        first = found[k + 1000].evidence[0]
        assert (first.doc_id, first.toxic) == (k, int(k % 10 == 0)) and first.cosine > 0.95


def test_block_max_search_is_exact():
    draw = np.random.default_rng(3)
    idf = {f"t{k}": 1.0 + k % 4 for k in range(40)}
    index = toxicity.ExampleIndex(idf, block=8)
    texts = [" ".join(f"t{t}" for t in draw.choice(40, draw.integers(1, 9))) for _ in range(300)]
    vectors = [index.vector(re.sub(r"\d+", lambda m: chr(97 + int(m[0]) // 26) + chr(97 + int(m[0]) % 26), t)) for t in texts]
    names = {f"t{chr(97 + k // 26)}{chr(97 + k % 26)}": v for k, v in enumerate(idf.values())}
    index = toxicity.ExampleIndex(names, block=8)
    vectors = [index.vector(re.sub(r"\d+", lambda m: chr(97 + int(m[0]) // 26) + chr(97 + int(m[0]) % 26), t)) for t in texts]
    index.add([(k, k % 2, *v) for k, v in enumerate(vectors)])
    dense = np.zeros((300, 40))
    for k, i in enumerate(index.ids):
        dense[k, vectors[i][0]] = vectors[i][1]
    for at, weights in vectors[:60]:
        query = np.zeros(40)
        query[at] = weights
        cosines = dense @ query
        order = np.lexsort((np.arange(300), -np.round(cosines, 12)))[:15]
        order = order[cosines[order] > 0]
        near, found = index.nearest(at, weights)
        assert near.tolist() == order.tolist() and np.allclose(found, cosines[order])


def test_license_phrases_and_edited_notices(spark, odd, none):
    rows = [(1, "Under the MIT License. CC-BY and cc by, CC BY"), (2, "licensed undr the Apache Licens, version 2.0 yes"),
            (3, "see: Redistribution and use in sorce and binary forms, with or without modifications are"), (4, "nothing here"), (5, "cc bye cc-by")]
    found = {r.doc_id: r for r in license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].last_word) == (11, 4, 2, 9)
    assert found[1].base_labels == "cc-by,mit" and found[1].score == 1.0
    assert found[2].base_labels == "" and found[2].labels == "apache" and found[2].spans[0].edits == 2 and found[2].spans[0].first_word == 0
    assert found[3].labels == "bsd" and found[3].spans[0].found.startswith("redistribution") and 0.9 < found[3].score < 1
    assert found[4].labels == "" and found[4].score == 0 and found[4].first_word is None
    assert found[5].n_base == 1 and found[5].first_word == 2
    blank = {r.doc_id: r for r in license_scan.scanned(odd).collect()}
    assert len(blank) == 7 and blank[1].n_words == 0 and blank[4].n_words == 60_001
    assert license_scan.scanned(none).count() == 0


def test_notices_are_told_from_like_ones():
    finder = license_scan.NoticeFinder()
    cases = {
        "Licensed under CC BY-NC 4.0.": {"cc-by-nc"}, "Licensed under CC BY-SA 4.0.": {"cc-by-sa"}, "Licensed under CC BY 4.0.": {"cc-by"},
        "Licensed under CC BY-ND 4.0.": set(), "Licensd undr CC BY-NC 4.0": {"cc-by-nc"}, "Licensed under CC BY-NC 3.0": {"cc-by-nc"},
        "released under the BSD license": set(), "released under the ISC license": set(), "released under the MIT license": {"mit"},
        "relesed undr the MIT licence": {"mit"}, "licensed under the GNU Lesser General Public License": {"lgpl"},
        "licensed under the GNU Library General Public License": set(), "licensed under the GNU General Publik License": {"gpl"},
        "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0. All rights reserved": {"cc-by-nc", "cc-by-sa", "all-rights-reserved"},
    }
    for text, labels in cases.items():
        spans = finder.scan(text.encode())[-1]
        assert {s["label"] for s in spans} == labels and len(spans) == len(labels), text
    assert license_scan.told_apart([(0, 30, 1, 2), (0, 30, 2, 0), (29, 50, 3, 1), (60, 90, 1, 3)]) == [(0, 30, 2, 0), (29, 50, 3, 1), (60, 90, 1, 3)]


def test_license_base_counts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in license_scan.scanned(docs).collect()}
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        places = [k for p in license_scan.PHRASES for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        got = found[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))


def test_fuzzy_notices_equal_search_everywhere():
    """The seeds lose nothing: wherever the pattern matches somewhere in the text, the notice is found."""
    finder, draw = license_scan.NoticeFinder(), random.Random(5)
    for number, (notice, _, edits) in enumerate(finder.notices):
        for _ in range(15):
            letters = list(notice.strip())
            for _ in range(draw.randint(0, edits)):
                k = draw.randrange(len(letters))
                letters[k] = draw.choice(("", letters[k] + "q", "z"))
            text = f" some words before {''.join(letters)} and after it "
            assert any(n == number for _, _, n, _ in finder.fuzzy(text)) == bool(finder.patterns[number].search(text))


PAGE = (
    "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li>"
    "<li><a href='/b'>News</a></li></ul></nav><!-- ad --><div class='ad'>Buy now.</div><article><h1>A &amp; B</h1><p>First   line<br>goes <b>o</b>n.</p>"
    "<p>Second paragraph, with a comma and an end.</p></article><footer>&copy; someone</footer></body></html>"
)


def test_blocks_decode_and_split():
    texts = [b.text for b in blocks_of(PAGE)]
    assert texts == ["Home", "News", "Buy now.", "A & B", "First line", "goes on.", "Second paragraph, with a comma and an end.", "© someone"]
    assert blocks_of("<p>cut &am") [0].text == "cut &am" and blocks_of("<script>x") == [] and blocks_of("a<!-- x") [0].text == "a"


def test_main_text_equals_the_article_on_unseen_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = block_labeller.fitted(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 1000"))
    found = {r.page_id: r for r in block_labeller.extracted(pages, model).collect()}
    for r in pages.collect():
        want = " ".join(b.text for b in blocks_of(r.html) if block_labeller.landmark(b))
        assert found[r.page_id].text == want and found[r.page_id].n_chars == len(want)
    plain = re.sub("article", "div", PAGE).replace("<footer>", "<div class='comments'>I do not think so.</div><footer>")
    odd = [(1, None, None), (2, "u", ""), (None, "u", PAGE), (3, "u", PAGE), (3, "u", PAGE), (4, "u", "<p>" + LONG), (5, "u", plain)]
    rows = block_labeller.extracted(spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("text", F.lit("clash")), model).collect()
    assert len(rows) == 7 and {r.text for r in rows if r.page_id in (3, None)} == {"A & B First line goes on. Second paragraph, with a comma and an end."}
    assert [r.n_chars for r in rows if r.page_id in (1, 2)] == [0, 0]
    assert "think" not in next(r.text for r in rows if r.page_id == 5)
    assert block_labeller.extracted(pages.limit(0), model).count() == 0


def test_labeller_gradients_are_slopes():
    draw = np.random.default_rng(1)
    model = block_labeller.Labeller()
    x, mask = block_labeller.padded([draw.random((n, block_labeller.INPUTS)).astype(np.float32) for n in (2, 5)])
    y = (draw.random(mask.shape) < 0.5).astype(np.float32)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    _, slopes = model.gradients(x, y, mask)
    for key in ("hf", "hb", "out", "xf"):
        model.weights[key][1, 0] += 1e-4
        up, _ = model.gradients(x, y, mask)
        model.weights[key][1, 0] -= 2e-4
        down, _ = model.gradients(x, y, mask)
        model.weights[key][1, 0] += 1e-4
        assert abs((up - down) / 2e-4 - slopes[key][1, 0]) < 1e-3


def test_warc_round_trip_with_segments_copies_and_nulls(spark, tmp_path):
    text = "x\r\n\r\nWARC/1.1 é" * 40
    rows = [(5, "http://a/", text), (2, "http://b/\n", text), (None, None, text), (7, None, None), (8, "u", ""), (9, "u", "only"), (9, "u", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    warc.write_archives(pages, str(tmp_path / "a"), chunk=50, records=4)
    back = sorted((tuple(r) for r in warc.read_back(spark, str(tmp_path / "a")).collect()), key=str)

    def sha(t):
        return base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()

    n = len(text.encode())
    assert back == sorted([
        (2, n, sha(text), "response", None), (5, n, sha(text), "revisit", 2), (None, n, sha(text), "revisit", 2), (7, 0, sha(""), "response", None),
        (8, 0, sha(""), "revisit", 7), (9, 4, sha("only"), "response", None), (9, 4, sha("only"), "revisit", 9)], key=str)
    whole = b"".join(open(f, "rb").read() for f in glob.glob(str(tmp_path / "a/*.gz")))
    kinds = [h["warc-type"] for h, _ in warc.parsed(whole)]
    assert kinds.count("continuation") >= 3 and kinds.count("revisit") == 4
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_back(spark, str(tmp_path / "b")).count() == 0


def test_a_cut_archive_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some text")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"))
    data = open(glob.glob(str(tmp_path / "a/*.gz"))[0], "rb").read()
    with pytest.raises(ValueError):
        list(warc.parsed(data[:-30]))


def test_url_rules_and_listed_urls(spark):
    urls = [(1, "HTTP://WWW.Example.com/en/1"), (2, "http://a.example.com/en/x?y"), (3, "http://x.net/es/"), (4, None), (5, "nothing"),
            (6, "http://bad.org/a.html#z"), (7, "https://www.bad.org/a/"), (8, "http://good.org/a"), (8, "http://good.org/a"), (None, "http://bad.org/a")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("bad.org/a",), ("bad.org/a",), (None,)], "canonical string")
    rules = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged_urls(pages, listed, rules).collect()}
    assert found == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("a.example.com", "/en/x", "example.com/en/", "block"),
        3: ("x.net", "/es/", "net/es/", "block"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("bad.org", "/a.html", None, "block"),
        7: ("www.bad.org", "/a/", None, "block"), 8: ("good.org", "/a", None, "allow"), None: ("bad.org", "/a", None, "block")}
    assert url_filter.judged_urls(pages, listed, rules).count() == 10
    assert url_filter.judged_urls(pages.limit(0), listed.limit(0), rules).count() == 0


def test_terms_are_counted_as_words_and_beginnings():
    columns = {t: k for k, t in enumerate(["grim", "^grim", "^grimm", "élan", "^élan", "x", "^none"])}
    texts = ["", " ", "Grim grim, GRIMMER grimm! élan-vital élans x x", "«grim» grim\u00a0“grimmest”\tx1x grim", "grim" * 5 + " " * 9]
    for text in texts:
        known: dict[int, int] = {}
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for term in [word] + ["^" + word[:n] for n in (4, 5, 6, 7) if len(word) > n]:
                if term in columns:
                    known[columns[term]] = known.get(columns[term], 0) + 1
        assert dict(toxicity.TermFinder(columns)(text)) == known
        assert not toxicity.TermFinder({})(text)


def test_line_rules_on_odd_rows_and_long_texts(spark, odd, none):
    found = {r.doc_id: r for r in line_rules.rule_verdicts(odd).collect()}
    assert found[4].n_words == 60_001 and found[4].n_repeat_words == 60_000 and found[4].base_failed and not found[4].kept
    assert (found[1].n_words, found[1].word_chars, found[1].kept) == (0, 0, False)
    good = " ".join(f"word{k}" for k in range(60)) + "."
    rows = [(1, good + "\nWe use cookies on this site."), (2, "Home | News | About | Contact\n" * 30 + "word " * 9), (3, good + "\n" + good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rules", F.lit("clash"))
    kept = {r.doc_id: r.text for r in line_rules.keep_clean(docs).collect()}
    assert kept == {1: good}
    assert line_rules.rule_verdicts(none).count() == 0


def test_line_reasons(spark):
    cases = {
        "four words and an x": "punctuation", "a line without end": "punctuation", "It ends here.": None, "quoted” \t\r": None,
        "Three word heading": None, " \t\x0b": None, "": None, "a line, \x85 with control": "punctuation",
        "# * b": "symbols", "one two three four # five six seven.": None, "so! very! loud!": "shouting", "one two three!": None,
        "All Rights Reserved": "boilerplate", "Home page": "navigation", "a b c d]": None, "a b c d}": None, "a b c d^": "punctuation",
        "a b c d\\": "punctuation",
    }
    rows = spark.createDataFrame(list(cases.items()), "line string, expected string")
    wrong = rows.withColumn("got", line_rules.line_reason(F.col("line"))).where("not got <=> expected").collect()
    assert not wrong


def test_decontamination_tolerates_substitutions_and_leaves_others(spark, odd, none):
    draw = random.Random(2)
    item = [f"w{draw.randrange(900)}" for _ in range(30)]
    worn = [w if k % 8 != 3 else "zz" for k, w in enumerate(item)]
    clean = [f"w{draw.randrange(900)}" for _ in range(300)]
    rows = [(1, "before " + " ".join(item).upper() + "! after"), (2, " ".join(worn)), (3, " ".join(clean)), (4, "a b " + " ".join(item[10:24])), (5, " ".join(item[:6])), (6, "Seven short words stand here right now")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "seven short words stand here right now"), (3, "the"), (4, None), (None, "")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash"))
    found = {(r.doc_id, r.item_id): r for r in spaced_seeds.leaks(docs, bench).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 1), (6, 2)}
    assert found[1, 1].matched == 30 and found[1, 1].starts_at == 1 and found[4, 1].starts_at == -8
    assert {r.doc_id for r in spaced_seeds.without_leaks(docs, bench).collect()} == {3, 5}
    assert spaced_seeds.leaks(odd, bench).count() == 0 and spaced_seeds.leaks(none, bench).count() == 0
    assert spaced_seeds.without_leaks(odd, bench.limit(0)).count() == len(ODD)


def test_perspectives_mask_only_the_speaker(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob lee", None), (1, 2, "ann", "x"), (None, 0, None, "y"), (2, 0, "system", "alone")]
    found = chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))).collect()
    assert len(found) == 9 and {r.perspective for r in found} == {"ann", "bob lee", "unknown"}
    for r in found:
        assert r.trained == (r.speaker == r.perspective)
        shown = r.segment[r.loss_start:r.loss_end]
        assert shown.endswith("<|im_end|>\n") if r.trained else shown == ""
        assert r.segment.count("<|im_end|>") == 1
    assert any(r.segment.startswith("<|im_start|>user name=bob_lee\n") for r in found)


def test_mixing_targets_and_odd_rows(spark, odd, none):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500)], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a 5, b 2, c 1, null 5 share 2415; a and null and c stop at twice their size, b takes the rest
    assert found["a"] == 200 and found["c"] == 20 and found[None] == 1000 and found["b"] == 2415 - 1220
    rows = mixing.mixed(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mixed(odd.repartition(3)).collect()))
    assert mixing.mixed(none).count() == 0 and mixing.emitted(none).count() == 0
    assert mixing.emitted(odd).count() == sum(r.copies for r in rows)


def test_word_hashes_agree_with_a_plain_split():
    texts = ["Aa  bb\tcc", "", None, "aa", "é bb"]
    words, starts = common.word_hashes(pa.array([t or "" for t in texts]))
    assert np.diff(starts).tolist() == [3, 0, 0, 1, 2]
    assert words[0] == words[3] and words[1] == words[5] and len(set(words.tolist())) == 4
