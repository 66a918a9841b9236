import random
import re

from clipstar.llm import decontaminate

DOCS = "doc_id long, text string, lang string, words string, hash string, item_id string"
ITEMS = "item_id long, text string, words string, row_key string"


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS))


def shingles(text, k=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set()


def brute(docs, items):
    out = set()
    for d, dt in docs:
        for i, it in items:
            s = shingles(it)
            k = min(5, len(next(iter(s), ())))  # an item of fewer words is one shingle of its own length
            if s and len(s & shingles(dt, k)) / len(s) >= 0.8:
                out.add((d, i))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdé") for _ in range(3)) for _ in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 6, 12, 30, 70])))) for i in range(40)]
    items += [(50, None), (51, "... !"), (52, ""), items[3], (None, "null item of just seven words here")]
    docs = []
    for d in range(120):
        body = [rng.choice(words) for _ in range(rng.choice([0, 4, 20, 300]))]
        for _ in range(rng.randint(0, 2)):
            passage = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if passage:
                    passage[rng.randrange(len(passage))] = rng.choice(words)
            at = rng.randint(0, len(body))
            body[at:at] = passage
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(body).title()))
    docs += [(500, None), (501, ""), docs[7], (None, docs[9][1]), (502, "z " * 5000 + (items[5][1] or "")),
             (503, "Null item of just, SEVEN words here")]
    d, i = frames(spark, docs, items)
    want = brute(docs, items)
    assert len(want) > 30
    got = decontaminate.find_items(d, i).collect()
    pairs = [(r.doc_id, r.item_id) for r in got]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert all(abs(r.containment - r.shared / r.item_shingles) < 1e-12 for r in got)


def test_short_items_are_found_inside_long_documents(spark):
    items = [(1, "One"), (2, "two three"), (3, "four, five six"), (4, "seven eight nine ten"), (5, "not there at all"), (6, "two")]
    docs = [(1, "w " * 3000 + "Two-three x " + "v " * 3000), (2, "a four five six b"), (3, "seven eight nine"),
            (4, "x seven EIGHT nine ten"), (5, "one"), (6, "twothree fourfive six seven")]
    d, i = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(d, i).collect()}
    assert got == brute(docs, items) == {(1, 2), (1, 6), (2, 3), (4, 4), (5, 1)}


def test_filter_keeps_clean_documents_and_columns(spark):
    item = "one two three four five six seven eight nine ten"
    docs, items = frames(spark, [(1, "clean text"), (2, f"so: {item}!"), (3, None), (None, "x"), (2, "other row")],
                         [(0, item)])
    got = decontaminate.decontaminate(docs, items)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.select("doc_id", "text").collect() if r.text) == [
        ("1", "clean text"), ("2", "other row"), ("None", "x")]
    assert got.count() == 4


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "some text")], [])
    assert decontaminate.find_items(docs, items).collect() == []
    docs, items = frames(spark, [], [(1, "some text")])
    assert decontaminate.find_items(docs, items).collect() == []
    assert decontaminate.decontaminate(docs, items).collect() == []
