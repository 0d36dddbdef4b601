from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from zlib import crc32

import pytest

from shelfcast.llm import disclosure

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 13 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])]


def name(kind, value):
    if kind == "email":
        return kind, value.lower()
    return kind, value if kind == "ip" else re.sub("[^0-9]", "", value)


def words_of(text):
    """(start, word) outside base spans."""
    chars = list(text)
    for _, a, b in base(text):
        chars[a:b] = " " * (b - a)
    return [(m.start(), m[0].lower()) for m in re.finditer(r"[^\W\d_]+", "".join(chars)) if len(m[0]) >= 3]


def classes(word):
    return [word[:n] + "*" for n in (5, 3) if len(word) > n]


def brute(texts):
    """Per text: all spans; and term -> what it is generalised to."""
    texts = [t or "" for t in texts]
    df_entity, df_item, both, places = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    for text in texts:
        words, pairs = words_of(text), set()
        for i in {x for _, w in words for x in (w, *classes(w))}:
            df_item[i] += 1
        for e in {name(k, text[a:b]) for k, a, b in base(text)}:
            df_entity[e] += 1
        for k, a, b in base(text):
            before = [w for s, w in words if s < a][-12:]
            after = [w for s, w in words if s >= a][:12]
            for i in {x for w in before + after for x in (w, *classes(w))}:
                pairs.add((name(k, text[a:b]), i))
                places[name(k, text[a:b]), i].add(crc32(" ".join(before + after).encode()))
        for p in pairs:
            both[p] += 1
    n, loud = len(texts), set()
    for (e, i), k in both.items():
        if len(places[e, i]) > 1 and math.log2(n * k / (df_entity[e] * df_item[i])) + 1e-9 >= 0.8 * math.log2(n / df_entity[e]):
            loud.add(i)
    general = {i: next((c for c in classes(i) if c not in loud), None) for i in loud if not i.endswith("*")}
    return [base(t) + [("term", s, s + len(w)) for s, w in words_of(t) if w in general] for t in texts], general


def report(texts, ids):
    out = []
    for i, spans in zip(ids, brute(texts)[0], strict=True):
        def joined(x):
            return ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        own = [s for s in spans if s[0] != "term"]
        out.append((i is None, i or 0, *[sum(s[0] == k for s in spans) for k in PATTERNS], hashlib.sha256(joined(own).encode()).hexdigest(), joined(spans)))
    return sorted(out)


def found(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"]) for r in df.collect())


FILLER = [f"plain report number {chr(97 + i % 26)}{chr(97 + i // 26)}x about the weather and common things of the day" for i in range(60)]
TEXTS = [
    "The surgeon Zorblatt Quimper answers at zorblatt.q@mail.example.com every morning",
    "Write to ZORBLATT.Q@mail.example.com , Zorblatt will call back tomorrow evening",
    "Yesterday Zorblatt was seen near the harbour, without any address",
    "Zorblattisch is another word and Zorblunk too", "Zorblunk again, Zorblatton as well, Zorblattine",
    "copied line with Vexillon at 10.20.30.40 here", "copied line with Vexillon at 10.20.30.40 here",
    None, "", "   ", "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111", "+1 (743) 555-3824 or +12 34 or +1234567890123456 +",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 001.002.003.255 1.2.3 1..2.3.4", "a@b.c.d@e.f @x.y a@b a%b+c@d-e.f.. x@@y.z", "naïve été Straße İstanbul é@ü.de ü.x@y.de",
    "word " * 20_000 + "z@z.zz", "9" * 3_000, "a" * 4_000 + "@", *FILLER,
]


@pytest.fixture(scope="module")
def table(spark):
    ids = [None if t == "   " else i for i, t in enumerate(TEXTS)]
    rows = [*zip(ids, TEXTS, strict=True), (3, TEXTS[3]), (3, "same id other text Zorblatt")]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, spans string, term string, copies int")
    return df.repartition(4), [i for i, _ in rows], [t for _, t in rows]


def test_equals_definition(table):
    df, ids, texts = table
    assert found(disclosure.span_report(df)) == report(texts, ids)
    spans, general = brute(texts)
    assert {"zorblatt"} <= set(general) and "vexillon" not in general and ("term", 10, 18) in spans[2]


def test_sanitised_text(table):
    df, _, texts = table
    _, general = brute(texts)
    rows = disclosure.sanitise(df).collect()
    out = {r["doc_id"]: r for r in rows}
    word = general["zorblatt"] or ""
    assert out[2]["text"] == f"Yesterday {word} was seen near the harbour, without any address"
    assert out[1]["text"].startswith("Write to [EMAIL] , ") and out[7]["text"] is None and out[2]["copies"] == 1
    assert out[10]["text"] == "[CARD] and 4111-1111-1111-1112 and [CARD]"
    assert len(rows) == len(texts)


def test_base_spans_equal_the_patterns():
    import random

    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("ab.@-+ 0123456789()._%é\n") for _ in range(rng.randrange(60)))
        assert disclosure.base_spans(text) == base(text), text


def test_tables(spark, small_docs):
    rows = small_docs.select("doc_id", "text").collect()
    assert found(disclosure.span_report(small_docs)) == report([r["text"] for r in rows], [r["doc_id"] for r in rows])


def test_empty_table(no_docs):
    assert disclosure.span_report(no_docs).count() == 0 and disclosure.sanitise(no_docs).count() == 0


def test_long_runs_are_read_once():
    assert disclosure.base_spans("9" * 200_000) == [] and disclosure.base_spans("a" * 2_000_000 + "@" + "b" * 2_000_000) == []
    assert disclosure.base_spans("a" * 100_000 + "@b.cc") == [("email", 0, 100_005)]
