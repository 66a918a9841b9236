import hashlib
import random
import re

from clipstar.llm import pii

SCHEMA = "doc_id long, text string, lang string, spans string, kind string, n_email string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
                if not 14 <= len(d) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows], SCHEMA)


def check(spark, rows):
    got = pii.find_pii(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        p = plain(t or "")
        want.append((i, *(sum(x.startswith(k + ":") for x in p) for k in PATTERNS),
                     hashlib.sha256(",".join(p).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) \
        == sorted(want, key=str)
    for r in got:
        base = [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert len(r.spans.split(",")) == len(r.scores.split(","))


def test_base_spans_match_the_patterns(spark):
    rng = random.Random(3)
    bits = ["a.b@c.de", "x@y", "@", "a@b@c.org", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.4", "..", "é",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "+1 (988) 555-2485", "+49 30 1234567",
            "++1", "0", "12", " ", "-", ".", "+", "🙂", "\n", "foo", "_%+-@a-b.c-", "4242424242424242424", "١٢"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 40))))
            for i in range(400)]
    rows += [(900, None), (901, ""), (None, "a@b.cd"), (902, "a@b.cd"), (902, "a@b.cd")]
    check(spark, rows)
    check(spark, [])


def test_long_runs_take_linear_time(spark):
    for unit in ("1", "a", "a.", "1.", "+1", "1 ", "@", "a@", "A1"):
        pii.find_spans(unit * 200_000)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")
    kinds = lambda t: [pii.KINDS[s.kind] for s in pii.find_spans(t)]
    assert kinds("my iban GB82 WEST 1234 5698 7654 32 thanks") == ["iban"]
    assert kinds("GB83 WEST 1234 5698 7654 32") == []
    assert kinds("social security 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    near, far = pii.find_spans("call +1 988 555 2485"), pii.find_spans("order +1 988 555 2485")
    assert near[0].score > far[0].score
    assert pii.redact("mail a@b.cd now") == "mail [email] now"
