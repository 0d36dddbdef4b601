from __future__ import annotations

import re
from itertools import permutations

from shelfcast.llm import filteraudit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """Set of failing filters per row, by the definition."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            fails.add("E")
        out.append(fails)
    return out


def brute(rows, labels):
    fails = failures(rows)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    out = {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left, gone = list(mine), []
            for step, letter in enumerate(order, 1):
                hit = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                removed_by[letter] += len(hit)
                out[part, order, step] = [
                    len(left), len(hit), sum(letter in f for _, f in gone), sum(f == {letter} for _, f in mine),
                    sum(i in good for i, _ in hit), sum(i in toxic for i, _ in hit)]
                gone += hit
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def collected(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in df.collect()}


def long_text(n, distinct):
    return " ".join(f"w{i % distinct}" for i in range(n))


ROWS = [
    (1, long_text(250, 250), "en"), (2, long_text(250, 250), "en"), (3, long_text(250, 125), "en"), (4, long_text(250, 124), "en"),
    (5, None, "en"), (6, "", None), (7, "  \t\n", ""), (7, "  \t\n", ""), (8, "A B C | d", "de"), (9, "A B C | d", "en"), (10, "A B C | d", "en"),
    (None, long_text(250, 250), "en"), (None, None, None), (11, "word " * 40_000, "fr"), (11, "other " * 300, "fr"), (12, "É" * 30 + "E", "fr"),
    (0, "A B C | d", "fr"), (13, "naïve one " * 300, "fr"), (14, long_text(300, 300) + " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3, None),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 1, None), (8, None, 1), (None, 1, 1), (99, 1, 1), (10, 1, 0), (11, 0, 1)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 5, "x") for i, t, p in rows], "doc_id long, text string, lang string, mask int, part string")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_equals_the_definition(spark):
    docs, labels = frames(spark, ROWS, LABELS)
    assert collected(filteraudit.interaction_audit(docs, labels)) == brute(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = frames(spark, ROWS, [])
    assert collected(filteraudit.interaction_audit(docs, labels)) == brute(ROWS, [])
    none, labels = frames(spark, [], LABELS)
    assert filteraudit.interaction_audit(none, labels).count() == 0


def test_removal_steps():
    orders, steps = filteraudit.removal_steps()
    assert len(orders) == 120 and steps.shape == (120, 32)
    at = orders.index("CABED")
    assert steps[at, 0] == filteraudit.NEVER
    assert steps[at, 0b00011] == 2 and steps[at, 0b00100] == 1 and steps[at, 0b01000] == 5
