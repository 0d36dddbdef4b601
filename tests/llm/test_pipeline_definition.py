"""The whole pipeline against a plain-Python version of its stages 2 to 5 over a small corpus with planted cases.

Stage 1 is a fitted model: the documents that it keeps are taken from it, what it decides is tested on held-out rows elsewhere.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from shelfcast.llm import common as C
from shelfcast.llm import tokens
from tests.llm.test_text_operators import brute_components, brute_simhash, lower_ascii, pairs

CAPACITY = 1024


@pytest.fixture(scope="module")
def corpus(spark, sf_dir, tmp_path_factory):
    """The small tables with exact and near copies, shared passages, benchmark windows, odd texts, a null id and a repeated row."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = C.table(spark, sf_dir, "documents")
    rows = sorted(map(tuple, docs.collect()), key=lambda r: r[0])
    texts = [r[1] for r in rows]
    items = sorted(map(tuple, C.table(spark, sf_dir, "benchmark").collect()))
    long = [t for t in texts if len(t.split()) > 150]
    passage = " ".join(long[0].split()[20:90])
    words = long[1].split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    window = [t for _, t in items if len(t.split()) > 14]
    extra = [long[2], long[2], long[3], near,
             f"{texts[5]}\n{passage}\n{texts[6]}", f"{texts[7]} é{passage}ü {texts[8]}",
             " ".join(long[4].split()[:30] + window[0].split()[:12] + long[5].split()[:30]),
             " ".join(long[6].split()[:30]) + " " + window[1].upper(),
             " ".join(long[7].split()[:30] + window[2].split()[:9]),
             None, "", "  \n", "x", "a <|endoftext|> in the middle of a text that nothing else holds", "日本語 😀 " * 30]
    rows += [(1000 + i, t, "xx", "planted", len(t or "")) for i, t in enumerate(extra)]
    rows += [(None, "a text without an id and with words of its own", None, None, None), rows[9], rows[9]]
    spark.createDataFrame(rows, docs.schema).repartition(5).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        C.table(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    return folder


def one_per_component(rows):
    """Smallest id of each component of linked fingerprints; rows of one id and text count once."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    root = brute_components([brute_simhash(t) for _, t in rows])
    return [row for i, row in enumerate(rows) if i == root[i]]


def without_repeats(rows, length=200):
    bodies = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (doc, text), b in zip(rows, bodies, strict=True):
        gone = {j for i in range(len(b) - length + 1) if seen[b[i:i + length]] > 1 for j in range(i, i + length)}
        kept = bytes(x for j, x in enumerate(b) if j not in gone).decode("utf-8", "ignore")
        out.append((doc, kept if gone else text))
    return out


def clean_of(rows, items, window=10):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))

    leaks = set()
    for _, text in items:
        own = split(text)
        m = min(window, len(own))
        leaks |= {tuple(own[i:i + m]) for i in range(len(own) - m + 1)} if own else set()
    sizes = {len(x) for x in leaks}

    def leaked(t):
        own = split(t)
        return any(tuple(own[i:i + m]) in leaks for m in sizes for i in range(len(own) - m + 1))

    return [r for r in rows if not leaked(r[1])]


def test_pipeline_equals_its_definition(spark, corpus):
    from tokenizers import Tokenizer

    docs = C.table(spark, corpus, "documents")
    kept = pairs(C.persisted(corpus_pipeline.STAGES[0][1](spark, docs, corpus), "test-kept"), "doc_id", "text")
    single = one_per_component(kept)
    cut = without_repeats(single)
    want = clean_of(cut, pairs(C.table(spark, corpus, "benchmark"), "item_id", "text"))
    # every planted case is there: something goes at each stage
    assert len(want) < len(cut) == len(single) < len(kept)
    assert sum(a != b for a, b in zip(single, cut, strict=True)) >= 3

    tok = Tokenizer.from_file(tokens.tokenizer_path())
    ids = {doc: [*tok.encode(t or "", add_special_tokens=False).ids, tokens.END_ID] for doc, t in want}
    assert len(ids) == len(want)
    got = corpus_pipeline.run(spark, corpus).collect()
    assert {r["doc_id"] for r in got} == set(ids)
    at = dict.fromkeys(ids, 0)
    for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"])):
        own = ids[r["doc_id"]]
        assert (r["start"], r["doc_tokens"]) == (at[r["doc_id"]], len(own)) and r["length"] > 0
        at[r["doc_id"]] += r["length"]
        part = own[r["start"]:at[r["doc_id"]]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    assert at == {doc: len(own) for doc, own in ids.items()}

    room = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == room[r["sequence_id"]]
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= CAPACITY
    assert CAPACITY * len(room) - sum(room.values()) <= 0.01 * sum(room.values()) + CAPACITY
