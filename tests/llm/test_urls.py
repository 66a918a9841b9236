import itertools
import math
import re

from clipstar.llm import urls

SCHEMA = "page_id long, url string, html string, host string, rule string, token string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]


def rule_of(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def best_split(label, counts, total):
    """Best score over all splits into known words and single unknown letters."""
    base, best = math.log(total + 1), -math.inf
    for cuts in itertools.product([0, 1], repeat=len(label) - 1):
        words, start = [], 0
        for i, c in enumerate([*cuts, 1]):
            if c:
                words.append(label[start:i + 1])
                start = i + 1
        if all(w in counts or len(w) == 1 for w in words):
            best = max(best, sum(math.log(counts[w]) - base if w in counts else -base - math.log(10) for w in words))
    return best


def test_segmentation_is_the_likeliest():
    counts = {"the": 900, "them": 40, "men": 60, "me": 80, "n": 2, "others": 30, "other": 70, "he": 200, "s": 5, "a": 100}
    total = float(sum(counts.values()))
    base = math.log(total + 1)
    for label in ("themen", "theother", "others", "zzthe", "a", "amenq", "qqq", "thethethe"):
        words = urls.segment(label, counts, total)
        assert "".join(words) == label
        score = sum(math.log(counts[w]) - base if w in counts else len(w) * (-base - math.log(10)) for w in words)
        assert abs(score - best_split(label, counts, total)) < 1e-9
    assert urls.segment("theother", counts, total) == ["the", "other"]
    assert urls.segment("x" * 300, {}, 0.0) == ["x" * 300]


def brute(rows):
    counts = {}
    for _, _, html in rows:
        for w in re.split(r"[\W\d_]+", re.sub("<[^<>]*>", " ", (html or "").lower())):
            if w:
                counts[w] = counts.get(w, 0) + 1
    total = float(sum(counts.values()))

    def tokens(url):
        host, path = parts(url)
        found = [f"h:{w}" for l in re.split(r"[\W\d_]+", host) if l for w in urls.segment(l, counts, total)]
        return found + [f"p:{w}" for l in re.split(r"[\W\d_]+", path.lower()) if l for w in urls.segment(l, counts, total)]
    seen = {"block": {}, "allow": {}}
    pages = {"block": 0, "allow": 0}
    for _, url, _ in rows:
        if rule := rule_of(*parts(url)):
            pages[rule.verdict] += 1
            for t in tokens(url):
                seen[rule.verdict][t] = seen[rule.verdict].get(t, 0) + 1
    size = len(seen["block"].keys() | seen["allow"].keys()) + 1
    nb, na = sum(seen["block"].values()), sum(seen["allow"].values())
    out = []
    for i, url, _ in rows:
        host, path = parts(url)
        rule = rule_of(host, path)
        if not pages["block"] or not pages["allow"]:
            odds = -1.0
        else:
            odds = math.log(pages["block"] / pages["allow"]) + sum(
                math.log((seen["block"].get(t, 0) + 1) / (nb + size)) - math.log((seen["allow"].get(t, 0) + 1) / (na + size))
                for t in tokens(url))
        verdict = rule.verdict if rule else "block" if odds > 0 else "allow"
        out.append((i, host, path, rule.text if rule else None, verdict, None if rule else round(odds, 6)))
    return sorted(out, key=str)


def check(spark, rows):
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, None if r.rule else round(r.log_odds, 6))
                  for r in urls.judge(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_matches_brute_force(spark):
    html = "<html><p>spam farm casino news the daily paper</p><a href='x'>farm news</a> été</html>"
    hosts = ["spamfarm.example.com", "WWW.Example.com", "dailynews.example.net", "thepaper.org", "casinofarm.org", "example.com",
             "notexample.com", "net", "a.net:80", "xn--q.org"]
    paths = ["", "/", "/en/1", "/es/2", "/fr/x.html", "/de/casino?x=/en/", "/News/Daily#top", "?q=1", "#a/b"]
    rows = [(i, f"http://{h}{p}", html if i % 3 else None) for i, (h, p) in enumerate(itertools.product(hosts, paths))]
    rows += [(900, None, html), (901, "no scheme", ""), (902, "", None), (None, rows[5][1], html), (5, rows[5][1], "<" * 5000),
             (903, "http://" + "spamfarm" * 300, html), (904, "a\nb://x.com/\ny", html)]
    check(spark, rows)


def test_without_both_labels_and_empty(spark):
    check(spark, [(1, "http://a.com/x", "w"), (2, "http://b.org/x", "w")])
    assert urls.judge(frame(spark, [])).collect() == []


def test_long_hosts_long_words_and_joined_paths(spark):
    import random

    rng = random.Random(3)
    junk = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    word = "donaudampfschifffahrtsgesellschaft"
    html = f"the daily news of the {word} casino farm " * 3
    rows = [(1, f"http://{junk}.com/en/", html), (2, f"http://the{word}.org/casinofarm", html), (3, "http://a.com/news", html),
            (4, "http://b.net/es/casinofarm", html), (5, "http://c.org/dailycasinofarm", None)]
    got = {r.page_id: r for r in urls.judge(frame(spark, rows)).collect()}
    assert got[2].words == f"the {word} org" and got[1].host == junk + ".com" and "".join(got[1].words.split()) == junk + "com"
    assert got[5].verdict == "block" and got[5].log_odds > 0  # by its path's words


def test_stretch_hashes():
    text = "abcabcäbc"
    for size, h in zip((1, 3, 9), urls._run_hashes(text, (1, 3, 9, 10))):
        cut = [text[i:i + size] for i in range(len(text) - size + 1)]
        assert len(set(zip(cut, h.tolist()))) == len(set(cut)) == len(set(h.tolist()))
