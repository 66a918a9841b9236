import random
import struct
import zlib

from tokenizers import Tokenizer

from clipstar.llm import packing

SCHEMA = "doc_id long, text string, lang string, rid string, start string, at string, length string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z", "w") for i, t in rows], SCHEMA)


def check(rows, got, capacity):
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = {}
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append(ids)
    cut = {}
    for r in got:
        cut.setdefault(r.doc_id, []).append(r)
    assert cut.keys() == want.keys()
    for i, docs in want.items():
        expected = sorted((s, len(ids[s:s + capacity]), zlib.crc32(struct.pack(f"<{len(ids[s:s + capacity])}I", *ids[s:s + capacity])), len(ids))
                          for ids in docs for s in range(0, len(ids), capacity))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in cut[i]) == expected
    packs = {}
    for r in got:
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(packs) == list(range(len(packs)))
    for spans in packs.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(packs)


def test_pieces_are_the_tokenizers_ids(spark):
    rng = random.Random(1)
    words = ["Hello", "it's", "WORLD!!", "don't,", "naïve", "État", "x1y2", "日本語", "áb", "12,000", "<b>", "\x1c",
             "a b", "İstanbul", "ΣΑΣ", "thea.", "###", "...", "'s", "it'S", "foo'd.", "<|endoftext|>", "🙂ok", "ß"]
    rows = [(i, rng.choice([" ", "\n", "\t  "]).join(rng.choice(words) for _ in range(rng.randint(0, 80))))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, "  "), (3, "again"), (None, "no id"), (103, " lead and trail "),
             (104, "long " * 3000)]
    check(rows, packing.pack(frame(spark, rows)).collect(), 4096)
    check(rows, packing.pack(frame(spark, rows), capacity=64).collect(), 64)


def test_plan_holds_every_piece_with_little_padding():
    rng = random.Random(7)
    for _ in range(30):
        capacity = rng.choice([16, 100, 4096])
        histogram = {}
        for _ in range(rng.randint(1, 3000)):
            n = min(capacity, max(1, int(rng.expovariate(4 / capacity))))
            histogram[n] = histogram.get(n, 0) + 1
        plan = packing.plan_packs(histogram, capacity)
        seen = {}
        for packs, pattern in plan:
            assert packs > 0 and sum(a * m for a, m in pattern) <= capacity
            for a, m in pattern:
                seen[a] = seen.get(a, 0) + m * packs
        assert seen == histogram
        tokens = sum(a * n for a, n in histogram.items())
        assert sum(p for p, _ in plan) <= 1.03 * tokens / capacity + 2


def test_equal_lengths_and_empty_table(spark):
    rows = [(i, "same text here") for i in range(500)]
    n = check(rows, packing.pack(frame(spark, rows), capacity=16).collect(), 16)
    assert n == 125
    assert packing.pack(frame(spark, [])).collect() == []
