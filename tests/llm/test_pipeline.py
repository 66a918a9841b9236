"""The pipeline's stages against a plain version of each, on the rows that the stage before kept."""
import random
import re
import zlib
from collections import Counter
from math import log

import corpus_pipeline
from clipstar.llm import language
from clipstar.llm.common import Saved, prepare
from tests.llm.test_decontaminate import shingles
from tests.llm.test_packing import check as check_packs
from tests.llm.test_simhash import plain_components, plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, words string"


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([8, 30, 60])))) for i in range(6)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 80, 600])))))
    for i in range(40):
        text = rng.choice(rows)[1]
        rows.append((200 + i, text.replace(" ", rng.choice(["  ", "\n", " "]))))  # exact copies
    for i in range(20):
        body = rng.choice([r for r in rows if len(r[1]) > 2000])[1].split()
        body[rng.randrange(len(body))] = "changed"
        rows.append((300 + i, " ".join(body)))  # near copies
    for i in range(15):
        body = rng.choice(rows)[1].split()
        body[len(body) // 2:len(body) // 2] = rng.choice(items)[1].split()
        rows.append((400 + i, " ".join(body)))  # leaks
    rows += [(500, None), (501, ""), (502, "12 34 -- 56"), (503, " \n"), (None, "a text without an id"), rows[4], rows[4]]
    rows.append((None, " ".join(rng.choice(words) for _ in range(40))))
    return rows, items


def keep_exact(rows):
    best = {}
    for i, t in rows:
        norm = re.sub("[\x20\x09-\x0d]", "", t or "")
        key = (-len(t or ""), i is None, i or 0)
        if norm not in best or key < best[norm][0]:
            best[norm] = (key, (i, t))
    return [r for _, r in best.values()]


def keep_language(rows):
    """All rows are labelled en, so the best mixture is that language alone; it must explain a text better than trigrams
    drawn from all buckets alike."""
    learnt = Counter()
    for i, t in rows:
        if t is not None and zlib.crc32(str("" if i is None else i).encode()) % 5:
            learnt.update(language.trigrams(t).tolist())
    total = sum(learnt.values()) + 0.5 * language.BUCKETS

    def gain(text):
        return sum(log((learnt[b] + 0.5) / total) + log(language.BUCKETS) for b in language.trigrams(text).tolist())
    return [r for r in rows if any(map(str.isalpha, r[1] or "")) and gain(r[1]) > 0]


def keep_near(rows):
    comps = plain_components([plain_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    return [r for r, c in zip(rows, comps) if r[0] == c]


def test_stages(spark, tmp_path):
    prepare(spark)
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], SCHEMA)
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    saved = Saved(spark, "test-pipeline")
    now = saved.table(docs)

    plain = [
        keep_language, keep_exact, keep_near,
        lambda rs: [r for r in rs if not any(len(shingles(t) & shingles(r[1])) >= 0.8 * len(shingles(t))
                                             for _, t in items)]]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "decontaminate", "packing"]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain):
        before = len(rows)
        rows = expected(rows)
        now = saved.table(stage(spark, now, sf))
        assert now.columns == docs.columns, name
        assert sorted(((r.doc_id, r.text) for r in now.collect()), key=str) == sorted(rows, key=str), name
        assert len(rows) < before, name
    check_packs(rows, corpus_pipeline.STAGES[-1][1](spark, now, sf).collect(), 4096)
    whole = corpus_pipeline.run(spark, sf).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted({(r.doc_id) for r in whole}, key=str) == sorted({i for i, _ in rows}, key=str)


def test_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).collect() == []
