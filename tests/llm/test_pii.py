import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import pii


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "iban":
        p = v.replace(" ", "")
        return 15 <= len(p) <= 34 and int("".join(str(int(c, 36)) for c in p[4:] + p[:4])) % 97 == 1
    return True


def brute(text, kinds):
    out = []
    for kind in kinds:
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pii.PLAIN[kind], text or "") if ok(kind, m[0])]
    return out


CASES = [
    "mail a.b@c.example.org, x@y and a@b.c%d@e.f or é👍 q@w-1.de.",
    "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.255 1..2.3.4",
    "card 4111 1111 1111 1111, 4111111111111112 and 5500-0000-0000-0004; 1 2 3",
    "call +49 (30) 1234-5678 or +1 2 or +123456789012345678 ++4930123456789.",
    "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not DE00370400440532013000",
    "", None, "@" * 50, "1" * 30000, "a" * 30000, "+1" + "-" * 500, "1 " * 5000, "a@" * 3000, "1.2.3.4 " * 900,
]


def spans(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.found] for r in pii.find_pii(df).collect()}


def test_cases(spark):
    got = spans(spark, CASES)
    for i, text in enumerate(CASES):
        assert [s for s in got[i] if not s.startswith("ssn")] == brute(text, [*pii.BASE, "iban"]), text and text[:60]


@pytest.mark.parametrize("kind", pii.BASE)
def test_fast_patterns_find_the_same(spark, kind):
    """The JVM's patterns against the plain ones, over random texts."""
    alphabet = {"email": "ab@.-% ", "ip": "12.5 0", "card": "14 -x", "phone": "+12()- ."}[kind]
    texts: list[str] = []

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet=alphabet, max_size=60))
    def gather(text):
        texts.append(text)

    gather()
    got = spans(spark, texts)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s.startswith(kind)] == brute(text, [kind]), text


def test_scores_and_words_nearby(spark):
    df = spark.createDataFrame([(1, "my ssn 123-45-6789"), (2, "code 123-45-6789"), (3, "mail me: a@b.c")], "doc_id long, text string")
    got = {r.doc_id: r.found for r in pii.find_pii(df).collect()}
    assert [s.kind for s in got[1]] == ["ssn"] and got[2] == []
    assert got[3][0].score == pytest.approx(1.0) and got[3][0].value == "a@b.c"


def test_odd_rows(odd, empty):
    assert pii.pii_digest(odd).count() == odd.count()
    assert pii.pii_digest(empty).count() == 0
