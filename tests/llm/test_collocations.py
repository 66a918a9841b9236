"""Phrases against a plain count of all n-grams."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clipstar.llm import collocations as C

DOCS = "doc_id long, text string, lang string"


def plain(rows, min_count, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                longer[lang, w[i:i + size]] = max(longer[lang, w[i:i + size]], a)
    out = {}
    for (lang, w), a in candidates.items():
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if 100 * longer[lang, w] >= 80 * a:
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top]))


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "Ärger", "über", "a-b", "x", "日本", "the", "of", "\x1c", "E F"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(150))
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ".", "\n", "  ", "\t", "!x"])
                 for _ in range(rng.randint(0, 80))]
        text = " ".join(words) + (passage if rng.random() < 0.3 else "")
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    return rows + [rows[0]] * 20 + [(None, "en"), ("", None), (" .. \n\t", "de"), ("new york " * 3000, "fr")]


@pytest.mark.parametrize("seed, min_count, top", [(1, 5, 2000), (2, 12, 7), (3, 2, 50)])
def test_equals_a_plain_count(spark, seed, min_count, top):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS).repartition(5)
    got = sorted(tuple(r) for r in C.collocations(docs, min_count, top).collect())
    assert got == plain(rows, min_count, top)
    assert got


def test_a_small_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 15)
    monkeypatch.setattr(C, "_GATHER", 50)
    rows = corpus(4)
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS)
    assert sorted(tuple(r) for r in C.collocations(docs, 4, 2000).collect()) == plain(rows, 4, 2000)


def test_extra_columns_and_empty_tables(spark):
    rows = [(1, "aa bb cc. " * 40, "en", 3, "x")]
    docs = spark.createDataFrame(rows, DOCS + ", n int, phrase string")
    got = [tuple(r) for r in C.collocations(docs).collect()]
    assert got == [("en", 1, "aa bb cc", 40, 40, 40, 120, 1000000)]
    assert C.collocations(docs.limit(0)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, "one two", "en")], DOCS)).collect() == []


def test_every_phrase_starts_in_one_chunk_that_holds_it():
    rng = random.Random(5)
    texts = [" ".join(str(rng.randint(0, 30)) + rng.choice(["", "", "."]) for _ in range(400)) for _ in range(5)]
    words = C.words_of(pa.array(texts))
    code = words.hashes()
    start, stop, reach = C.chunk_bounds(words, code)
    assert len(start) > 20
    assert start[0] == 0 and (start[1:] == stop[:-1]).all() and stop[-1] == len(code)
    for a, b, c in zip(start, stop, reach):
        for i in range(a, b):
            whole = [k for k in range(1, 5) if i + k <= len(code) and words.piece[i] == words.piece[i + k - 1]]
            assert all(i + k <= c for k in whole)


def test_equal_passages_give_equal_chunks():
    rng = random.Random(6)
    passage = " ".join(str(rng.randint(0, 1000)) for _ in range(1000))
    chunks = []
    for before in ("", "other words before "):
        words = C.words_of(pa.array([before + passage]))
        start, _, reach = C.chunk_bounds(words, words.hashes())
        text = words.text.tobytes()
        chunks.append({text[words.start[a]:words.end[c - 1]] for a, c in zip(start, reach)})
    assert len(chunks[0] - chunks[1]) <= 1 and len(chunks[0]) > 10


def test_sliced_input():
    words = C.words_of(pa.array(["drop me", "Keep, THIS", "too"]).slice(1, 2))
    assert words.text.tobytes() == b"keep\nthis\ntoo\n" and words.each(np.arange(2)).tolist() == [0, 0, 1]
    assert np.diff(words.piece).tolist() == [1, 1]


def test_hashes_tell_words_apart():
    texts = ["a", "b", "ab", "ba", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "a" * 64, "a" * 65, "a" * 64 + "b", "ä", "日本"]
    h = C.words_of(pa.array(texts + texts[::-1])).hashes()
    assert len(set(h.tolist())) == len(texts) and (h == h[::-1]).all()
