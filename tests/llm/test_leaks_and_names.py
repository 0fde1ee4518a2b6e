"""Long and short benchmark items, the recall of their masks, and helper names as columns of the input."""

import base64
import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from wxrisk.llm import chat, jaccard, line_rules, mixing, spaced_seeds, toxicity, url_filter, warc


def seeds_left(masks, words, changed):
    """Whether some window of some mask holds none of the changed words."""
    places = [{i + k for k, flag in enumerate(mask) if flag == "1"} for mask in masks for i in range(words - len(mask) + 1)]
    return any(not (p & changed) for p in places)


def missed(words, changes):
    return sum(not seeds_left(spaced_seeds.masks_for(words), words, set(c)) for c in combinations(range(words), changes))


def test_masks_leave_a_seed_for_what_the_check_accepts():
    for words in range(1, 15):
        allowed = words - -(-words * spaced_seeds.LEAST_PERCENT // 100)
        for changes in range(allowed + 1):
            assert missed(words, changes) == 0, (words, changes)
    assert missed(15, 3) <= 10 and missed(20, 4) <= 10  # of 455 and 4,845


def plain_leaks(docs, items):
    """Every alignment of every pair, word by word; True where the whole item or a run of words agrees."""
    found = {}
    for i, text in docs:
        words = text.lower().split()
        for k, item in items:
            own = item.lower().split()
            best = 0
            for shift in range(-len(own) + 1, len(words)):
                best = max(best, sum(0 <= j + shift < len(words) and words[j + shift] == w for j, w in enumerate(own)))
            if own and 100 * best >= 80 * len(own) and (len(own) > 4 or best == len(own)):
                found[i, k] = best
    return found


def test_short_items_equal_brute_force(spark):
    draw, vocabulary = random.Random(3), [f"w{k}" for k in range(500)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(1 + k % 14))) for k in range(42)]
    docs = []
    for k in range(120):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(40))]
        own = draw.choice(items)[1].split()
        for _ in range(draw.randrange(3)):
            own[draw.randrange(len(own))] = "other"
        at = draw.randrange(len(words) + 1)
        whole = words[:at] + own + words[at:]
        docs.append((k, " ".join(whole[k % 3:] if k % 2 else whole[:len(whole) - k % 3])))
    found = spaced_seeds.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    whole = {(r.doc_id, r.item_id): r.matched for r in found.collect() if 100 * r.matched >= 80 * r.item_words}
    assert whole == plain_leaks(docs, items)


def test_items_of_few_words_reject_nothing(spark):
    docs = spark.createDataFrame([(1, "the plain text of some page"), (2, "other words")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (2, "plain text"), (3, "text of some page here")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in spaced_seeds.leaks(docs, bench).collect()} == {(1, 1), (1, 2), (1, 3)}
    assert [r.doc_id for r in spaced_seeds.without_leaks(docs, bench).collect()] == [2]
    assert spaced_seeds.without_leaks(docs, bench.where("item_id < 3")).count() == 2


def test_long_items_and_long_documents(spark):
    draw = random.Random(1)
    item = [f"i{draw.randrange(5000)}" for _ in range(800)]
    words = [f"d{draw.randrange(9000)}" for _ in range(50_400)]
    for k in range(12):
        words[k * 4200:k * 4200] = item
    huge = [f"h{draw.randrange(20_000)}" for _ in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "start " + " ".join(huge)), (3, "clean " * 60_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(huge)), (9, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.item_words, r.matched, r.run_matched, r.starts_at) for r in spaced_seeds.leaks(docs, bench).collect()}
    assert len(words) == 60_000
    assert found == {(1, 7): (800, 800, 13, 46_200), (2, 8): (60_000, 60_000, 13, 1)}


HELPERS = ["_pinned", "_made", "_w", "_key", "_block", "_maybe", "_bits", "_source", "_kept_size", "_own_rules", "rules", "words", "copy", "copies", "rate", "target",
           "taken", "size", "source_size", "is_listed", "host", "path", "block", "w0", "digest", "kind", "node", "grams", "top", "component_id", "part", "begins", "shift", "doc",
           "item", "same", "agree", "seed", "at", "speaker", "perspective", "held_out", "score", "value", "lang_n", "bucket", "output", "n", "form"]


@pytest.fixture(scope="module")
def crowded(spark):
    """Documents with a column for each helper's name."""
    good = " ".join(f"word{k}" for k in range(60)) + "."
    rows = spark.createDataFrame([(1, good, "en", "a"), (2, good + " end.", "en", "b"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    return rows.select("*", *[F.lit(f"own {name}").alias(name) for name in HELPERS])


def test_helper_names_are_free_for_columns(spark, crowded):
    def kept_whole(made):
        assert made.columns[:len(crowded.columns)] == crowded.columns or set(crowded.columns) <= set(made.columns)
        for r in made.collect():
            assert all(r[name] == f"own {name}" for name in HELPERS if name != "copy")
        return made.count()

    bench = spark.createDataFrame([(1, "no such passage stands in any of these texts here at all")], "item_id long, text string")
    assert kept_whole(line_rules.keep_clean(crowded)) == 2
    assert kept_whole(spaced_seeds.without_leaks(crowded, bench)) == 3
    assert kept_whole(jaccard.one_of_each_group(crowded)) == 2
    assert kept_whole(mixing.emitted(crowded)) >= 1
    assert mixing.mixed(crowded).count() == 3 and spaced_seeds.leaks(crowded, bench).count() == 0
    labels = crowded.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fitted(crowded, labels)
    assert toxicity.scored(crowded, model).count() == 3 and kept_whole(toxicity.keep_harmless(crowded, model)) <= 3
    pages = crowded.withColumnsRenamed({"doc_id": "page_id", "text": "html", "lang": "url"})
    listed = spark.createDataFrame([("x.org/a",)], "canonical string")
    assert url_filter.judged_urls(pages, listed, ()).count() == 3
    rows = url_filter.listed_rows(crowded, "text", listed, "canonical")
    assert rows.count() == 3 and not any(r.is_listed for r in rows.collect())
    assert warc.round_trip(pages).count() == 3
    talks = crowded.withColumnRenamed("doc_id", "conv_id").withColumn("turn", F.lit(1)).withColumn("role", F.lit("ann"))
    assert chat.perspectives(talks).count() == 3


def test_filter_grows_with_the_list(spark):
    assert url_filter.blocks_for(0) == url_filter.LEAST_BLOCKS and url_filter.blocks_for(10**12) == url_filter.MOST_BLOCKS
    assert url_filter.blocks_for(80_000) == 10_000
    keys = spark.range(40_000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    asked = spark.range(20_000, 60_000).select(F.concat(F.lit("h.org/"), "id").alias("url"))
    assert url_filter.listed_rows(asked, "url", keys, "canonical").where("is_listed").count() == 20_000


def test_a_large_payload_is_cut_in_one_pass(spark, tmp_path):
    unit = "<p>körper 😀\r\n</p>" * 1000
    text = unit * 1200
    pages = spark.createDataFrame([(1, "u", text), (2, "v", "small")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"))
    found = {r.page_id: r for r in warc.read_back(spark, str(tmp_path / "a")).collect()}
    raw = text.encode()
    digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert len(raw) > 20_000_000 and (found[1].payload_bytes, found[1].payload_digest) == (len(raw), digest)
    assert found[2].payload_bytes == 5
