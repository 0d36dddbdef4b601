from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import aligntokens
from shelfcast.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def plain():
    """The two tokenizers as their libraries give them: text -> [(id, bytes)]."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    level = decoders.ByteLevel()
    vocab = {i: p for p, i in tok.get_vocab().items()}
    letters = {}
    for b in range(256):  # the stand-in of a byte, asked from the library through one-byte decoding
        for c in range(0x21, 0x180):
            if chr(c) not in letters and level.decode([chr(c)]) == (chr(b) if b < 128 else "�") and b < 128:
                letters[chr(c)] = b
    own = aligntokens.byte_letters()
    assert all(own[c] == b for c, b in letters.items() if c in own and b >= 0x20)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))

    def a(text):
        return [(i, bytes(own[c] for c in vocab[i])) for i in tok.encode(" " + text, add_special_tokens=False).ids]

    def b(text):
        return [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
                for i in sp.encode(text)]

    return a, b


def brute(texts, plain):
    out, pairs, per_b = [], Counter(), {}
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = (f(text) if text else [] for f in plain)
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            out.append((0, 0, "", []))
            continue
        ends_a = np.cumsum([len(x) for _, x in a]).tolist()
        ends_b = np.cumsum([len(x) for _, x in b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(str(k) for k, _ in a[i:x]) + "|" + ",".join(str(k) for k, _ in b[j:y]))
            links.append((a[x - 1][0], b[y - 1][0]))
            i, j = x, y
        out.append((len(a), len(b), ";".join(groups), links))
        pairs.update(links)
    for (_, y), n in pairs.items():
        per_b[y] = max(per_b.get(y, 0), n)
    return [(n_a, n_b, len(links), len(links), sum(pairs[p] == per_b[p[1]] for p in links), sum(pairs[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if links else "", g) for n_a, n_b, g, links in out]


def found(df):
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in cols]) for r in df.collect())


def expected(rows, plain):
    got = brute([t for _, t in rows], plain)
    return sorted((i is None, i or 0, *g) for (i, _), g in zip(rows, got, strict=True))


ODD = ["a  double space", " leading", "trailing ", "tab\tand\nbreak\n\n two", "<|endoftext|> <s> </s> <unk> <0x41> end", "▁ and _ ▁▁x", "",
       None, "naïve 日本語 😀 Ωmega ﬁ ½", "no-break space　wide", "\x01 \x00 control", "x", " ", "é combining é", "\n", "word " * 30]


def test_equals_definition_on_odd_texts(spark, plain):
    rows = [*enumerate(ODD), (None, "no id here"), (3, "tab\tand\nbreak\n\n two"), (3, "tab\tand\nbreak\n\n two")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, groups string, n_a int").repartition(3)
    assert found(aligntokens.corpus_alignment(docs, with_groups=True)) == expected(rows, plain)


def test_equals_definition_on_the_tables(spark, small_docs, plain):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    assert found(aligntokens.corpus_alignment(small_docs, with_groups=True)) == expected(rows, plain)


def test_long_texts_and_small_memo(spark, plain, monkeypatch):
    text = " ".join(f"word{i % 9_000}x{i % 89} naïve" for i in range(60_000))
    monkeypatch.setattr(aligntokens, "WINDOW_CACHE", 500)
    tool = aligntokens.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    (a, b), = tool.ids([text])
    assert len(text) > aligntokens.RUN_CHARS
    assert (a.tolist(), b.tolist()) == tuple([i for i, _ in f(text)] for f in plain)
    nothing = a[:0]
    (first, codes), empty, again = tool.aligned([(a, b), (nothing, nothing), (a, b)])
    assert empty == ("", b"") and again == (first, codes) and tool.aligned([(a, b)])[0] == again
    assert first.count(";") + 1 == len(codes) // 4 == len(set(np.cumsum(tool.a_len[a])) & set(np.cumsum(tool.b_len[b])))


def test_linked_pairs_stay_under_the_bound(spark, small_docs):
    n = aligntokens.pair_counts(aligntokens.align(small_docs.select("doc_id", "text"), False)).count()
    assert 0 < n <= aligntokens.pair_bound(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def test_empty_table(spark, no_docs):
    out = aligntokens.corpus_alignment(no_docs)
    assert out.count() == 0 and {"n_a", "n_best", "count_sum", "groups_sha256"} <= set(out.columns) and "link_codes" not in out.columns
