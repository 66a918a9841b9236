import hashlib
import random
import re

from clipstar.llm import exact_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, kept string, name string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z") for i, t in texts], SCHEMA)


def brute(rows):
    norm = [re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in rows]
    groups = {}
    for n, (i, t) in zip(norm, rows):
        groups.setdefault(n, []).append((-len(t or ""), i is None, i or 0, i))
    return sorted(((i, min(groups[n], key=lambda x: x[:3])[3], len(groups[n]), hashlib.sha256(n.encode()).hexdigest())
                   for n, (i, t) in zip(norm, rows)), key=str)


def check(spark, rows, **kw):
    got = exact_dedup.duplicate_groups(frame(spark, rows), **kw).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert all(v == 1 for v in kept.values())


def test_matches_grouping_by_text(spark):
    rng = random.Random(1)
    parts = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(1, 30))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    rows += [(200 + i, " ".join(t)) for i, (_, t) in enumerate(rows[:20])]
    rows += [(300, None), (301, ""), (302, " \t\n"), (None, "ab"), (303, "x" * 5000), (304, "x" * 5001)]
    rows += [rows[3], rows[3]]
    check(spark, rows, block_bytes=8)


def test_prefix_and_position_do_not_collide(spark):
    check(spark, [(0, "aaaabbbb"), (1, "bbbbaaaa"), (2, "aaaabbbbaaaa"), (3, "aaaabbbbaaaabbbb"), (4, "aaaa"),
                  (5, "aaaabbbb "), (6, "aaaabbb")], block_bytes=4)


def test_empty_table(spark):
    assert exact_dedup.duplicate_groups(frame(spark, [])).collect() == []
    assert exact_dedup.drop_duplicates(frame(spark, [])).collect() == []


def test_drop_keeps_columns_and_one_row_each(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (3, "c"), (4, None), (5, ""), (None, "d")]
    got = exact_dedup.drop_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "rid", "kept", "name"]
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.doc_id) == [(1, "a b"), (3, "c"), (4, None)]
    assert got.count() == 4
