from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import bitplanes, components, ctw, decontaminate, multiset, packing, repeats, simhash, tokens, toxicity
from shelfcast.llm import common as C


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.fixture(scope="module")
def tok():
    return tokens.PieceEncoder(tokens.tokenizer_path())


# ---------------------------------------------------------------- decontamination

def brute_hits(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))
    words, hit, found = split(text), set(), set()
    for item, body in items:
        own = split(body)
        m = min(window, len(own))
        for i in range(len(own) - m + 1 if own else 0):
            for p in range(len(words) - m + 1):
                if words[p:p + m] == own[i:i + m]:
                    hit |= set(range(p, p + m))
                    found |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(found)


def test_decontamination_matches_brute_force(spark, edge_docs, no_docs):
    items = [(1, "same row same row same row same row same row same"), (2, "TWO three"), (3, None), (4, ""), (None, "naïve 日本語"),
             (20, "word5x5 word6x6 word7x7 word8x8 word9x9 word10x10 word11x11 word12x12 word13x13 word14x14 word15x15"), (1, "six")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = edge_docs.where("doc_id not in (6, 7) or doc_id is null").unionByName(edge_docs.where("doc_id = 6"))
    for block_bytes in (1 << 20, 40):  # one pattern block, then several
        out = decontaminate.find_contamination(docs, bench, block_bytes=block_bytes)
        got = sorted(pairs(out, "text", "n_words", decontaminate.hit_words(), "hit_items"), key=str)
        want = sorted(((t, *brute_hits(t, items)) for t, in pairs(docs, "text")), key=str)
        assert got == want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for g in got if g[2] == 0)
    assert decontaminate.find_contamination(no_docs, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_pattern_tables_of_a_large_benchmark_stay_small():
    """A whole block of random words (few repeats): tables in bytes, and every planted window found."""
    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", dtype=np.uint8)
    body = letters[rng.integers(0, 26, decontaminate.BLOCK_BYTES)]
    body[rng.integers(0, len(body), len(body) // 7)] = 0x20
    body = body.tobytes().decode()
    items = [(str(i), body[i * 2000:(i + 1) * 2000]) for i in range(len(body) // 2000)]
    tracemalloc.start()
    tables = decontaminate.build_tables(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(t.memory() for t in tables) < 150 << 20 and peak < 500 << 20
    picks = rng.choice(len(items), 50, replace=False).tolist()
    for i in picks:
        words = items[i][1].split()
        at = int(rng.integers(0, len(words) - 10))
        doc = ["0", "zero", *words[at:at + 10], "1"]
        text = decontaminate.Words(decontaminate.normal(" ".join(doc)))
        found = [hit for t in tables for hit in t.scan(text)]
        assert found == [(2, 12, {items[i][0]})]
        doc[7] = "0"
        assert not [hit for t in tables for hit in t.scan(decontaminate.Words(decontaminate.normal(" ".join(doc))))]


def test_pattern_search_equals_direct_search():
    rng = np.random.default_rng(3)
    for words in (2, 4, 30):
        make = lambda n: " ".join(f"w{i}" for i in rng.integers(0, words, n))  # noqa: E731, B023
        items = [(str(i), make(int(n))) for i, n in enumerate(rng.integers(1, 14, 25))]
        tables = decontaminate.build_tables(items, window=5)
        for n in [0, 1, 2, 5, 300]:
            text = make(n)
            spans, found = [], set()
            for t in tables:
                for a, b, names in t.scan(decontaminate.Words(decontaminate.normal(text))):
                    spans.append((a, b))
                    found |= names
            hit = sum(b - a for a, b in decontaminate.merge_spans(spans))
            assert (n, hit, sorted(found)) == brute_hits(text, items, window=5)


# ---------------------------------------------------------------- tokens, packing, bit planes

def test_piece_encoder_equals_tokenizer(tok):
    odd = ["", " a", "a ", "a  b", "x\n\ny z", "x \n y", "don't stop. it's\nok", "ü²., b", "<|endoftext|> x", "1.5 a.b,c\nq;", "\n", "a\tb c  d",
           "日本語 テスト　x", "naïve Ωmega ǅ 😀 \U00020000字, а́б", "a²³ ①b ⅷc", "x y z", "\x01a \x01", "a \x1c b", "it's,\n're it", "-- a--b, (c). e"]
    assert [x.tolist() for x in tok.encode(odd)] == tok.raw(odd)
    many = [" ".join(f"w{i}{j}, the\nAnd" for j in range(50)) for i in range(40)]
    small = tokens.PieceEncoder(tokens.tokenizer_path(), capacity=300)  # the cache is trimmed again and again
    assert [x.tolist() for m in many for x in small.encode([m])] == small.raw(many)


def test_special_tokens_equal_a_fresh_tokenizer(spark, tok, tmp_path):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.tokenizer_path())
    texts = ["end <|endoftext|> x", "a<|endoftext|>b c", "<|endoftext|>", "x\n<|endoftext|>\ny  z", "<|endoftext|><|endoftext|> q", "<|endoftext| > plain text"]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [437, 220, 50256, 2124]
    assert [x.tolist() for x in tok.encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sums = {(i, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for i, ids in enumerate(want)}
    pieces = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pack(docs, with_ids=True).collect() if r.length == r.doc_tokens}
    assert pieces and all(ids == [*want[i], 0] for i, ids in pieces.items())
    bitplanes.write_ids(docs, str(tmp_path / "special"))
    assert set(pairs(bitplanes.document_checksums(spark, str(tmp_path / "special")), "doc_id", "n_tokens", "ids_crc32")) == sums


def test_packing_covers_every_id_once(edge_docs, no_docs, small_docs, tok):
    for docs in (edge_docs, small_docs):
        pieces = packing.pack(docs, with_ids=True).collect()
        want = Counter((i, tuple([*tok.raw([t or ""])[0], 0])) for i, t in pairs(docs, "doc_id", "text"))
        by_doc, by_seq = {}, {}
        for p in pieces:
            ids = np.frombuffer(p.ids, "<u4")
            assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
            by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
            by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert sum(p.length for p in pieces) == sum(len(k[1]) * n for k, n in want.items())
        for doc, ids in want:
            right = {(s, len(i)) for s, i in by_doc[doc, len(ids)] if tuple(ids[s:s + len(i)]) == tuple(i)}
            assert sum(n for _, n in right) == len(ids)
        padding = 0
        for spots in by_seq.values():
            end = 0
            for offset, length in sorted(spots):
                assert offset == end
                end += length
            assert end <= 1024
            padding += 0 if end & (end - 1) == 0 else 1024 - end
        assert padding < 1024 + 0.004 * sum(p.length for p in pieces)
        assert sorted(by_seq) == list(range(len(by_seq)))
    assert packing.pack(no_docs).count() == 0


def test_class_sizes_and_cuts():
    sizes = packing.class_sizes(1024)
    assert all(1024 - s * (1024 // s) <= 4 for s in sizes) and sizes[-1] == 1
    for n in (1, 2, 700, 1023, 1024, 1025, 5000):
        cut = packing.cut_lengths(n, 1024, sizes)
        assert sum(cut) == n and set(cut) <= set(sizes)


def test_bit_planes_round_trip(spark, edge_docs, no_docs, tok, tmp_path):
    for ids in (np.array([0, 1, 65535, 50256]), np.arange(1000) * 70, np.zeros(9, int)):
        planes = bitplanes.to_planes(ids.astype(np.uint32))
        assert bitplanes.from_planes(planes, len(ids)).tolist() == ids.tolist()
    parts = [b"abc", b"", b"\0\0\0", b"xyz" * 50]
    assert bitplanes.join_checksums([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))
    docs = edge_docs.where("doc_id != 9 or doc_id is null")
    for block in (64, 1 << 16):
        target = str(tmp_path / f"ids{block}")
        bitplanes.write_ids(docs, target, block_ids=block)
        got = sorted(pairs(bitplanes.document_checksums(spark, target), "doc_id", "start", "n_tokens", "ids_crc32"), key=lambda r: r[1])
        rows = sorted(pairs(docs, "doc_id", "text"), key=lambda r: (r[0] is not None, r[0] or 0))
        own = {(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in ((i, [*tok.raw([t or ""])[0], 0]) for i, t in rows)}
        assert {(g[0], g[2], g[3]) for g in got} == own and len(got) == len(rows)
        assert [g[1] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()
        ids = [g[0] for g in got]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    bitplanes.write_ids(no_docs, str(tmp_path / "none"))
    assert bitplanes.document_checksums(spark, str(tmp_path / "none")).count() == 0


def test_bit_planes_are_the_bits_and_checksums_those_of_the_ids(spark, edge_docs, tmp_path):
    import zstandard

    for ids in (np.array([3, 0, 50256, 65535, 1]), np.array([1 << 16, 7, (1 << 32) - 1])):
        frames = [zstandard.ZstdDecompressor().decompress(p) for p in bitplanes.to_planes(ids.astype(np.uint32))]
        assert len(frames) == (32 if ids.max() >= 1 << 16 else 16)
        assert frames == [np.packbits((ids >> b) & 1, bitorder="little").tobytes() for b in range(len(frames))]
    target = str(tmp_path / "segments")
    bitplanes.write_ids(edge_docs, target, block_ids=64)
    key = ("shard", "row", "part", "length")
    whole = {r[:4]: zlib.crc32(r[4]) for r in pairs(bitplanes.read_ids(spark, target), *key, "ids")}
    assert whole and whole == {r[:4]: r[4] for r in pairs(bitplanes.read_ids(spark, target, checksums=True), *key, "crc")}


# ---------------------------------------------------------------- simhash

def brute_simhash(text):
    words = re.findall("[^\x20\x09-\x0D]+", lower_ascii(text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_components_match_brute_force(edge_docs, small_docs, no_docs):
    docs = edge_docs.where("doc_id not in (6, 7) or doc_id is null").select("doc_id", "text").union(small_docs.select(F.col("doc_id") + 100, "text"))
    got = pairs(simhash.near_duplicates(docs), "doc_id", "fp", "component_id")
    rows = pairs(docs, "doc_id", "text")
    prints = [brute_simhash(t) for _, t in rows]
    root = brute_components(prints)
    low = {}
    for (i, _), r in zip(rows, root, strict=True):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    want = [(i, s, low[r]) for (i, _), s, r in zip(rows, signed, root, strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    whole = pairs(edge_docs, "text")
    assert kept.count() == len(set(brute_components([brute_simhash(t) for t, in whole])))
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("blocks_for", [10, 10**7, 10**10])
def test_simhash_links_at_any_block_count_and_tile(spark, blocks_for):
    rng = np.random.default_rng(blocks_for % 97)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64)]
    prints = {b ^ sum(1 << int(i) for i in rng.choice(64, k, replace=False)) for b in base for k in (0, 1, 3, 4, 5, 6)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = simhash.links(distinct, blocks_for, tile=3)
    roots = dict(pairs(components.connected(edges), "node", "root"))
    got = {}
    for s in signed:
        got.setdefault(roots.get(s, s), set()).add(s)
    want = {}
    for s, r in zip(signed, brute_components(prints), strict=True):
        want.setdefault(r, set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r for _, r in pairs(components.connected(edges), "node", "root")} == {0}
    assert components.connected(edges.limit(0)).count() == 0


# ---------------------------------------------------------------- multiset hash

def test_multiset_hash(edge_docs, no_docs, spark):
    a, b = "first line here now\nsecond line", "second line\nfirst line here now"
    assert multiset.render(multiset.vector(a)) == multiset.render(multiset.vector(b))
    assert multiset.render(multiset.vector("a\n")) != multiset.render(multiset.vector("a"))
    whole = multiset.add(multiset.vector("x y z w"), multiset.vector("p q"))
    assert np.array_equal(whole, multiset.vector("x y z w\np q"))
    assert np.array_equal(multiset.add(whole, multiset.vector("p q"), -1), multiset.vector("x y z w"))
    assert np.array_equal(multiset.parse(multiset.render(whole)), whole)
    docs = edge_docs.where("doc_id is not null and doc_id not in (8, 9)")
    for part_bytes in (16 << 20, 1000):  # one range, then many
        got = sorted(pairs(multiset.edited_fingerprints(docs, part_bytes=part_bytes), *[f.split()[0] for f in multiset.EDITED.split(", ")]))
        rows = sorted(pairs(docs, "doc_id", F.coalesce("text", F.lit("")).alias("text")))
        for (doc, text), (_, nxt), g in zip(rows, rows[1:] + rows[:1], got, strict=True):
            n = len(text) // 4
            edited = text[:len(text) - n] + nxt[:n]
            assert g[:3] == (doc, len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert g[3] == multiset.render(multiset.vector(text)) and g[4] == multiset.render(multiset.vector(edited))
            assert 0 <= g[5] <= 1 and 0 <= g[6] <= 1
    assert multiset.edited_fingerprints(edge_docs, part_bytes=1000).count() == edge_docs.count()
    assert multiset.edited_fingerprints(no_docs).count() == 0
    assert multiset.edited_fingerprints(edge_docs.where("doc_id = 4")).first().near_next == 1.0


def test_likeness_of_many_equal_lines():
    text = "a b c\n" * 100_000
    vec = multiset.vector(text)
    edited, edited_vec = multiset.edit_end(text, vec, len(text) * 3 // 4, "other words follow here")
    assert np.array_equal(edited_vec, multiset.vector(edited))
    assert multiset.likeness(vec, edited_vec) > 0.99
    assert multiset.likeness(*map(multiset.parse, (multiset.render(vec), multiset.render(edited_vec)))) > 0.99


# ---------------------------------------------------------------- repeats

def brute_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        keep = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(keep).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "gram", "chunk"), [(200, 64, 20_000), (40, 12, 3), (24, 8, 1)])
def test_repeats_match_brute_force(spark, edge_docs, no_docs, length, gram, chunk):
    rng = np.random.default_rng(length)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(2, 6)))
    passage = " ".join(word() for _ in range(70))
    rows = [(i, " ".join(word() for _ in range(40)) + passage[int(rng.integers(0, 60)):int(rng.integers(150, 330))] + " ".join(word() for _ in range(30)))
            for i in range(60)]
    rows += [(100, "ab" * 300), (101, passage), (102, passage * 2), (103, passage[:200]), (104, "x" * 500), (105, "x" * 199), (106, "y" * 201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        edge_docs.where("doc_id not in (6, 7) or doc_id is null").select("doc_id", "text")).repartition(4)
    got = pairs(repeats.removal_report(docs, length=length, gram=gram, chunk=chunk), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    own = pairs(docs, "doc_id", "text")
    want = [(i, *w) for (i, _), w in zip(own, brute_repeats([t for _, t in own], length), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert repeats.removal_report(no_docs).count() == 0


def test_spans_of_a_common_gram_are_not_copied_into_slices(spark, monkeypatch):
    """A line of 150 bytes between different texts: all spans share a gram, no window is repeated but those of two planted copies."""
    rng = np.random.default_rng(5)
    line = "".join(rng.choice(list("abcdefgh "), 150))
    text = lambda: "".join(rng.choice(list("abcdefgh "), 120)) + line + "".join(rng.choice(list("abcdefgh "), 120))
    rows = [(i, text()) for i in range(300)]
    rows.append((300, "z" * 9 + rows[0][1][30:] + "y" * 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    handed, original = [], type(docs).mapInArrow

    def counted(self, *args, **kwargs):
        handed.append(self.count())
        return original(self, *args, **kwargs)

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    got = pairs(repeats.removal_report(docs, chunk=20), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(got) == [(i, *w) for (i, _), w in zip(rows, brute_repeats([t for _, t in rows], 200), strict=True)]
    assert sum(r[2] > 0 for r in got) == 2
    assert max(handed) <= len(rows)


def test_remove_repeats_keeps_columns(edge_docs):
    out = repeats.remove_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    texts = dict(pairs(out.where("doc_id in (2, 4, 6, 8)"), "doc_id", "text"))
    assert texts == {2: "", 4: "one two", 6: "", 8: ""}


# ---------------------------------------------------------------- context tree

def brute_ctw(train, depth):
    counts, children = {}, {}
    for body in train:
        b = b"\xff" * depth + body + b"\xff"
        for i in range(depth, len(b)):
            for d in range(depth + 1):
                for j in range(8):
                    node = counts.setdefault((b[i - d:i], 1 << j | b[i] >> 8 - j), [0, 0])
                    node[b[i] >> 7 - j & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    for ctx, bits in counts:
        if ctx:
            children.setdefault((ctx[1:], bits), []).append((ctx, bits))
    log_w = {}
    for d in range(depth, -1, -1):
        for node, (a, b) in counts.items():
            if len(node[0]) == d:
                log_w[node] = kt(a, b) if d == depth else np.logaddexp(kt(a, b), sum(log_w[c] for c in children[node])) - math.log(2)

    def score(body):
        b, total = b"\xff" * depth + body + b"\xff", 0.0
        for i in range(depth, len(b)):
            for j in range(8):
                mixed, left, deepest = 0.0, 1.0, 0.5
                for d in range(depth + 1):
                    node = (b[i - d:i], 1 << j | b[i] >> 8 - j)
                    if node not in counts:
                        break
                    z, o = counts[node]
                    share = 1 if d == depth else math.exp(min(0, kt(z, o) - math.log(2) - log_w[node]))
                    deepest = (o + 0.5) / (z + o + 1)
                    mixed, left = mixed + left * share * deepest, left * (1 - share)
                p = mixed + left * deepest
                total += math.log10(p if b[i] >> 7 - j & 1 else 1 - p)
        return total

    return score


def test_context_tree_matches_brute_force(edge_docs, small_docs, no_docs):
    docs = edge_docs.where("doc_id not in (6, 7) or doc_id is null").select("doc_id", "text").unionByName(small_docs.where("doc_id between 20 and 50").select("doc_id", "text"))
    rows = pairs(docs, "doc_id", "text")
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    bodies = [lower_ascii(t).encode() for _, t in rows]
    words = [b.split() for b in bodies]
    counts = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    for depth, block_bytes in ((3, 4000), (2, 32 << 20)):
        score = brute_ctw([b for b, h in zip(bodies, held, strict=True) if not h], depth)
        want = sorted(((i, h, len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), n,
                        sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*ws, None]), score(b))
                       for (i, _), h, ws, b in zip(rows, held, words, bodies, strict=True)), key=lambda r: (str(r[0]), r[6]))
        got = sorted(pairs(ctw.score(docs, depth=depth, block_bytes=block_bytes), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
                     key=lambda r: (str(r[0]), r[6]))
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5]
            assert g[5:] == pytest.approx(w[5:], rel=1e-8, abs=1e-9)
    assert ctw.score(no_docs).count() == 0


def test_context_tree_slices_of_a_long_text():
    rng = np.random.default_rng(5)
    body = b" ".join(bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(1, 60, 900))
    bodies = [b"", b"ab c", body, b"tail"]
    whole = sorted((int(o), int(k)) for keys, owner in ctw.gram_slices(bodies, 5, 1 << 30) for k, o in zip(keys, owner, strict=True))
    assert len(whole) == sum(len(b) + 1 for b in bodies)
    for limit in (1, 7, 1000):
        assert whole == sorted((int(o), int(k)) for keys, owner in ctw.gram_slices(bodies, 5, limit) for k, o in zip(keys, owner, strict=True))
        assert max(len(keys) for keys, _ in ctw.gram_slices(bodies, 5, limit)) <= limit
        assert [w for words in ctw.word_slices(body, limit) for w in words] == body.split()


def test_context_tree_holds_one_long_text_in_bounded_memory():
    """50 MB in one document: neither the grams nor the words of a slice grow with the text."""
    body = b"lorem ipsum dolor sit amet " * (50_000_000 // 27)
    block = ctw._BlockCounts(0, 5)
    tracemalloc.start()
    block.add([body], False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(body)
    assert sum(block.words.values()) == 5 * (50_000_000 // 27)
    block.merge()
    assert int(block.counts.sum()) == len(body) + 1


def test_context_tree_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "abc") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    out = ctw.score(docs).collect()
    assert out and all(r.held_out and r.score == pytest.approx(4 * 8 * math.log10(0.5)) and r.n_known == 0 for r in out)


# ---------------------------------------------------------------- toxicity

def test_toxicity_learns_and_generalises(spark, edge_docs, no_docs):
    rng = np.random.default_rng(3)
    clean = ["the", "house", "is", "over", "there", "and", "nothing", "else", "matters", "today"]
    rows = []
    for i in range(600):
        words = list(rng.choice(clean, 40))
        toxic = i % 5 == 0
        if toxic:
            words[3:3] = ["zukrat" + rng.choice(["en", "um", "ix"]), "the", "zukratol"] if i % 2 else ["idiot", "moron"]
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).withColumn("out", toxicity.fold("doc_id") == 2)
    truth = {r[0]: r[2] for r in rows}
    held = [(truth[r.doc_id], r.score) for r in out.where("out").collect()]
    assert sum((s >= 0.3) == bool(t) for t, s in held) / len(held) > 0.97
    assert 0 < sum(t for t, _ in held) and min(model.label_model.accuracies().values()) >= 0
    marked = toxicity.score(edge_docs, model)
    assert marked.columns == [c for c in edge_docs.columns if c != "score"] + ["score"]
    assert all(0 <= r.score <= 1 for r in marked.collect())
    kept = toxicity.drop_toxic(docs.withColumn("_own", F.lit(1)), labels)
    assert set(kept.columns) == {"doc_id", "text", "_own"} and 470 < kept.count() < 500
    assert toxicity.score(no_docs, model).count() == 0
    bare = toxicity.train(docs, labels.limit(0))
    assert bare.score("nothing here") <= bare.score("you idiot moron")
    assert toxicity.drop_toxic(no_docs, labels).count() == 0


def test_shared_folder_tables_read_back(spark):
    df = C.persisted(spark.range(10).withColumn("t", F.lit("x")), "test")
    assert df.count() == 10 and df.columns == ["id", "t"]
