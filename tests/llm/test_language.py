import zlib

from clipstar.llm import language
from clipstar.llm.common import read

SCHEMA = "doc_id long, text string, lang string, held_out string, score string, bucket string, n string"
EN = "the quick brown fox jumps over the lazy dog and then the hunter walks through the old forest with his friends "
DE = "der schnelle braune fuchs springt über den faulen hund und dann geht der jäger durch den alten wald mit freunden "


def frame(spark, rows):
    return spark.createDataFrame([(i, t, l, "x", "y", "z", "w") for i, t, l in rows], SCHEMA)


def rows():
    out = []
    for i in range(60):
        text, lang = ((EN, "en"), (DE, "de"))[i % 2]
        words = text.split()
        out.append((i, " ".join(words[i % 7:] + words[:i % 5]) * 3, lang))
    return out


def test_held_out_accuracy_on_the_documents_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    labels = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == labels.keys()
    test = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(test)) for i in labels)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[i].lang_pred == labels[i] for i in test) / len(test) > 0.97


def test_unknown_texts_and_odd_rows(spark):
    extra = [(100, None, "en"), (101, "", "en"), (102, "12 34 !!", "de"), (103, "der hund und der jäger", None),
             (None, "the dog and the hunter", "en"), (104, "a", "en"), (105, EN * 400, "en"), (105, EN * 400, "en")]
    got = {}
    for r in language.identify(frame(spark, rows() + extra)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.held_out))
    assert all(got[i][0][0] == "und" for i in (100, 101, 102))
    assert got[103][0][0] == "de" and got[None] == [("en", True)]
    assert got[105] == [("en", zlib.crc32(b"105") % 5 == 0)] * 2


def test_the_label_and_fold_are_not_inputs(spark):
    wrong = [(i, t, "en" if zlib.crc32(str(i).encode()) % 5 == 0 else l) for i, t, l in rows()]
    same = {r.doc_id: r.lang_pred for r in language.identify(frame(spark, wrong)).collect()}
    assert same == {i: l for i, _, l in rows()}


def test_mixture_finds_both_languages(spark):
    model = language.train(frame(spark, rows()))
    lang, score, found = model.infer(EN * 3 + DE)
    assert lang == "en" and 0.5 < score < 0.95 and {x for x, _ in found} == {"en", "de"}
    assert [x for x, _ in model.infer(EN * 3)[2]] == ["en"]


def test_nothing_to_learn_from_and_empty_table(spark):
    unlabelled = frame(spark, [(1, EN, None), (2, None, None)])
    assert [(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()] == [("und", 0.0)] * 2
    assert [r.doc_id for r in language.drop_unknown(unlabelled).collect()] == [1]
    assert language.identify(frame(spark, [])).collect() == []
    assert language.drop_unknown(frame(spark, [])).collect() == []


def test_filter_keeps_columns(spark):
    docs = frame(spark, rows() + [(100, None, "en"), (101, "...", "en")])
    got = language.drop_unknown(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == list(range(60))


def test_any_number_of_labels(spark):
    many = [(i, f"w{i} " * 5 + EN, f"x{i:03d}") for i in range(600)] + rows()
    got = [r.lang_pred for r in language.identify(frame(spark, many)).collect()]
    assert len(got) == len(many) and "und" not in got


def test_mixture_equals_a_plain_one(spark):
    """Expectation-maximisation and selection again, in plain steps over dictionaries."""
    from collections import Counter
    from math import log

    model = language.train(frame(spark, rows()))
    learnt = {}
    for i, text, lang in rows():
        if zlib.crc32(str(i).encode()) % 5:
            learnt.setdefault(lang, Counter()).update(language.trigrams(text).tolist())
    langs = sorted(learnt)

    def p(lang, b):
        return (learnt[lang][b] + 0.5) / (sum(learnt[lang].values()) + 0.5 * language.BUCKETS)

    def fit(some, counts, share):
        n = sum(counts.values())
        for _ in range(25):
            new = [0.0] * len(some)
            for b, c in counts.items():
                whole = sum(s * p(x, b) for s, x in zip(share, some))
                for k, x in enumerate(some):
                    new[k] += c * share[k] * p(x, b) / whole / n
            moved = max(abs(a - b) for a, b in zip(new, share))
            share = new
            if moved < 1e-3:
                break
        return share, sum(c * log(sum(s * p(x, b) for s, x in zip(share, some))) for b, c in counts.items())
    for text in (EN, DE * 2, EN + DE, EN * 3 + DE, "the fuchs", "qqq zzz xxx", "x"):
        counts = Counter(language.trigrams(text).tolist())
        share, _ = fit(langs, counts, [0.5, 0.5])
        first, second = sorted(range(2), key=lambda k: -share[k])
        one = sum(c * log(p(langs[first], b)) for b, c in counts.items())
        start = [max(share[k], 1e-3) for k in (first, second)]
        both, value = fit([langs[first], langs[second]], counts, [s / sum(start) for s in start])
        n = sum(counts.values())
        two = value - one > 0.5 * log(n) + 0.02 * n
        pick = (first, second)[both.index(max(both))] if two else first
        lang, score, found, gain = model.explain(text)
        assert lang == langs[pick] and abs(score - min(1.0, share[pick])) < 1e-6 and len(found) == (2 if two else 1)
        assert abs(gain - ((value if two else one) + n * log(language.BUCKETS))) < 1e-5


def test_texts_in_no_learnt_language_are_dropped(spark):
    odd = [(200, "ЖЩЪЫ ЭЮЯЖ ЩЪЫЭ " * 30, "en"), (201, "zqxjv kqzwx jjqpv " * 30, None), (202, EN + " 0x9f8e", None)]
    kept = {r.doc_id for r in language.drop_unknown(frame(spark, rows() + [(i, t, None) for i, t, _ in odd])).collect()}
    assert kept == {i for i, _, _ in rows()} | {202}
