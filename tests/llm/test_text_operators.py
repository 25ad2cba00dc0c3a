"""Packing, decontamination, token counts, line dedup and near dedup against brute force."""

from __future__ import annotations

import array
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import decontamination as dc
from tidemark.llm import line_dedup as ld
from tidemark.llm import near_dedup as nd
from tidemark.llm.components import connected
from tidemark.llm.cutting_stock import best_pattern, solve
from tidemark.llm.packing import pack
from tidemark.llm.token_counts import splitter, token_counts
from tidemark.llm.word_ids import chunk_ids

#: Null, empty, blank, repeated, tied and long texts, and columns whose names clash with an operator's own.
ROWS = [
    (1, None, "x"),
    (2, "", "x"),
    (3, " \n\n ", "x"),
    (4, "one", "x"),
    (5, "the cat sat on the mat and the dog ran off to the old red barn today", "x"),
    (6, "The cat sat on the mat and the dog ran off to the old red barn today", "y"),
    (6, "The cat sat on the mat and the dog ran off to the old red barn today", "y"),
    (7, "Ünïcode ß <|endoftext|> don't  stop\t42² 中文", "z"),
    (8, " ".join(f"w{i % 977}" for i in range(9000)), "z"),
    (9, "shared line\nown line nine\n  SHARED Line \n", "z"),
    (10, "shared line\nown line ten", None),
]
SHAPE = "doc_id long, text string, n long"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(
        [(i, t, k, 7, 3, "c") for k, (i, t, _) in enumerate(rows)],
        "doc_id long, text string, n long, n_lines long, sequence_id long, items string",
    )


def vocabulary(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


# packing


def test_knapsack_and_patterns_cover_the_demand():
    value, pattern = best_pattern(np.array([3.0, 4.0, 0.0]), np.array([2, 3, 1]), 7)
    assert value == 10 and pattern.tolist() == [2, 1, 0]
    rng = np.random.default_rng(0)
    sizes = np.unique(rng.integers(5, 100, 30))
    demand = rng.integers(1, 60, len(sizes))
    found = solve(sizes, demand, 100)
    assert (sum(p * t for p, t in found) == demand).all()
    assert all((p * sizes).sum() <= 100 for p, _ in found)
    least = max((sizes @ demand) / 100, demand[sizes > 50].sum())  # by volume, and by pieces that exclude each other
    assert sum(t for _, t in found) <= 1.06 * least + 2
    assert solve([], [], 10) == []


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_round_trip(spark, capacity):
    rows = pack(frame(spark), capacity=capacity, with_ids=True).collect()
    tok = vocabulary("word_bpe_49k.json")
    expected = sorted([*tok.encode(t or "", add_special_tokens=False).ids, 2] for _, t, _ in ROWS)
    # Rows of one doc_id are packed each; equal pieces of theirs are alike, so one set is enough.
    by_doc = {}
    for r in rows:
        assert r.length == len(r.ids) and r.length <= capacity
        assert r.ids_crc32 == zlib.crc32(array.array("I", r.ids).tobytes())
        by_doc.setdefault(r.doc_id, {}).setdefault(r.start, []).append(r)
    texts = []
    for starts in by_doc.values():
        copies = len(starts[0])
        joined = [i for s in sorted(starts) for i in starts[s][0].ids]
        assert starts[0][0].doc_tokens == len(joined)
        texts.extend([joined] * copies)
    assert sorted(texts) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    assert pack(frame(spark, [])).count() == 0


def test_chunk_ids_equal_the_tokenizer():
    known, tok = chunk_ids("word_bpe_49k.json"), vocabulary("word_bpe_49k.json")
    rng = random.Random(1)
    letters = "aAzÉéßñ ÿİΣς́µ\x1c\x85 \t\n  .,'sdtll|<>09²½中🙂​"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25))) + rng.choice(["", "<|endoftext|>", "'ll"])
        assert known.of(text) == array.array("I", tok.encode(text, add_special_tokens=False).ids).tobytes(), text


# token counts


def test_token_counts(spark):
    rows = token_counts(frame(spark), limit=20).collect()
    tok = vocabulary("byte_bpe_50k.json")
    expected = []
    for i, t, _ in ROWS:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 20))
    assert sorted(map(tuple, rows)) == sorted(expected)
    assert token_counts(frame(spark, [])).count() == 0


def test_rare_pretokens_are_joined(spark, monkeypatch):
    """The same counts when nothing is known beforehand."""
    from tidemark.llm import token_counts as module

    monkeypatch.setattr(module, "_frequent", lambda *_: {})
    tok = vocabulary("byte_bpe_50k.json")
    got = {r.doc_id: r.n_tokens for r in token_counts(frame(spark)).collect()}
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t, _ in ROWS}


def test_pretokens_equal_the_tokenizer():
    split, tok = splitter("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.json")
    rng = random.Random(3)
    letters = "aZéÉßñ  ÿŸİΣ́µª \x1c\x85 \t\n\n\r  .,'sdtll<|09²½中🙂​-_#…’ɏÐ×÷"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25))) + rng.choice(["", "<|endoftext|>", "'ll a"])
        found, special = split.frequencies(text)
        assert special + sum(n * split.pieces(w) for w, n in found.items()) == len(tok.encode(text, add_special_tokens=False).ids), text


# decontamination

ITEMS = [
    (1, "The cat sat on the mat, and the dog ran"),
    (2, "one"),
    (3, None),
    (4, "--"),
    (5, "cat sat on the mat and the dog ran off to the old red barn today or tomorrow"),
    (5, "cat sat on the mat and the dog ran off to the old red barn today or tomorrow"),
    (6, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"),
]


def brute_passages(text, items, window=10):
    found = dc.words((text or "").encode())
    hit, named = set(), set()
    for item, body in items:
        wanted = dc.words((body or "").encode())
        size = min(window, len(wanted))
        for a in range(len(wanted) - size + 1) if size else ():
            for at in range(len(found) - size + 1):
                if found[at : at + size] == wanted[a : a + size]:
                    hit.update(range(at, at + size))
                    named.add(str(item))
    return len(found), len(hit), sorted(named)


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 60])
def test_passages(spark, monkeypatch, block):
    """Also block by block, when the benchmark is larger than what travels at once."""
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dc.find_passages(frame(spark), items).collect()
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows)
    assert got == sorted((i, *brute_passages(t, ITEMS)) for i, t, _ in ROWS)
    assert all(r.n_hit == sum(s.end - s.start for s in r.spans) for r in rows)
    none = dc.find_passages(frame(spark), items.where("false")).collect()
    assert len(none) == len(ROWS) and not any(r.n_hit for r in none)
    assert dc.find_passages(frame(spark, []), items).count() == 0


def test_search_equals_brute_force_on_few_words():
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for i in range(25)]
    known = dc.Benchmark([(str(i), t.encode()) for i, t in items], 10)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(400))) for _ in range(20)]
    numbers, named, spans = dc._search(known, [t.encode() for t in texts], [()] * 20, [()] * 20)
    for text, n, names, found in zip(texts, numbers, named, spans, strict=True):
        assert (n, sum(s["end"] - s["start"] for s in found), names) == brute_passages(text, items)


def test_null_and_repeated_item_ids(spark):
    rows = [(None, "alpha beta gamma"), (1, "gamma delta"), (1, "eins zwei"), (None, "delta omega"), (2, None), (3, "beta gamma")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma delta x"), (2, "zwei eins zwei"), (None, "delta omega"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r["items"], r.n_hit) for r in dc.find_passages(docs, items).collect()}
    assert got == {1: (["1", "3", None], 4), 2: (["1"], 2), None: ([None], 2), 4: ([], 0)}


def test_blocks_of_a_benchmark(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 60)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dc.find_passages(frame(spark), items).collect()
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows)
    assert got == sorted((i, *brute_passages(t, ITEMS)) for i, t, _ in ROWS)


def test_index_of_a_whole_block_is_small():
    """The largest block that is searched at once, indexed in a process of its own."""
    import subprocess
    import sys

    code = (
        "import resource, numpy as np\n"
        "from tidemark.llm import decontamination as dc\n"
        "rng = np.random.default_rng(1)\n"
        "base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "word = np.array([f'w{i}' for i in range(200_000)])\n"
        "size = dc.BLOCK_BYTES // 7 // 100\n"
        "items = [(str(i), ' '.join(word[rng.integers(0, 200_000, 100)]).encode()) for i in range(size)]\n"
        "index = dc.Benchmark(items, 10)\n"
        "assert sum(len(p.rows) for p in index.patterns) > 0.9 * size * 91\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) / 1024)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert float(out.stdout) < 500  # MB


# line dedup


def brute_lines(rows, min_docs):
    counts = {}
    for _, t, _ in rows:
        for key in {ld.line_key(x) for x in (t or "").encode().split(b"\n")}:
            counts[key] = counts.get(key, 0) + 1
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key := ld.line_key(x.encode())) or counts[key] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("sent", [ld.SENT_BYTES, -1])
def test_line_dedup(spark, monkeypatch, sent):
    """By the index that travels, and by the one that is probed where it is."""
    monkeypatch.setattr(ld, "SENT_BYTES", sent)
    monkeypatch.setattr(ld, "SHARD_KEYS", 1)
    monkeypatch.setattr(ld, "ROUTED_TOGETHER", 3)
    out = ld.dedup_lines(frame(spark), min_docs=2)
    assert {"n", "items", "sequence_id"} <= set(out.columns) and out.columns.count("n_lines") == 1
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out.collect())
    assert got == brute_lines(ROWS, 2)
    assert ld.dedup_lines(frame(spark, [])).count() == 0


def test_perfect_hash_is_minimal_and_prints_tell_strangers():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    prints, counts = rng.integers(0, 1 << 63, len(keys), dtype=np.uint64), rng.integers(2, 99, len(keys))
    perfect = ld.PerfectHash.build(keys, prints)
    assert sorted(perfect.slots(keys, prints)) == list(range(len(keys)))
    shard = ld.Shard.load(ld.Shard.build(keys, prints, counts))
    assert (shard.counts_of(keys, prints) == counts).all()
    strangers = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert not shard.counts_of(strangers, strangers).any()


def test_keys_that_share_half_their_hash_part_and_equal_ones_are_refused():
    same, other = np.full(300, 5, np.uint64), np.arange(300, dtype=np.uint64)
    for h1, h2 in ((same, other), (other, same)):
        slots = ld.PerfectHash.build(h1, h2).slots(h1, h2)
        assert sorted(slots) == list(range(300))
        shard = ld.Shard.load(ld.Shard.build(h1, h2, other + 2))
        assert (shard.counts_of(h1, h2) == np.arange(300) + 2).all()
    with pytest.raises(ValueError):
        ld.PerfectHash.build(same[:2], same[:2])


# near dedup


def test_full_sets_decide_whatever_the_signatures(spark):
    rng = np.random.default_rng(9)
    chunks, text = nd.chunks_for(0.8), b" ".join(b"w%d" % i for i in range(200))
    sig = lambda: rng.integers(0, 65536, chunks * nd.LENGTH).astype("<u2").tobytes()
    rows = [(0, 0, 0, i, sig(), t) for i, t in enumerate([text, text + b" more", b"quite another text of few words"])]
    members = spark.createDataFrame(rows, "group long, i int, j int, rep long, sig binary, text binary")
    assert [(r.a, r.b) for r in nd._verified(members, 5, (80, 100), chunks).collect()] == [(0, 1)]


def brute_components(rows, width, top, of):
    sets = {}
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if k else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and of * shared >= top * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies():
    rng = random.Random(4)
    base = [f"t{rng.randrange(3000)}" for _ in range(160)]
    rows, chain = [(1900, " ".join(base), "")], list(base)
    for i in range(60):  # copies of one text, each with one other word: mostly linked through the original
        copy = list(base)
        for _ in range(1 + i % 4):
            copy[rng.randrange(160)] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy), ""))
    for i in range(30):  # a chain in which only neighbours are alike
        chain = list(chain)
        for _ in range(3):
            chain[rng.randrange(160)] = f"c{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(chain), ""))
    return rows


@pytest.mark.parametrize("bounds", [(nd.BUCKET_MEMBERS, nd.COMPONENT_SHINGLES), (4, 900)])
def test_near_duplicates(spark, monkeypatch, bounds):
    """Also when every larger group is split into blocks."""
    monkeypatch.setattr(nd, "BUCKET_MEMBERS", bounds[0])
    monkeypatch.setattr(nd, "COMPONENT_SHINGLES", bounds[1])
    rows = ROWS + near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(frame(spark, rows), 3, (85, 100)).collect()}
    want = brute_components(rows, 3, 85, 100)
    assert {i: x for i, x in got.items()} == want
    assert nd.near_duplicates(frame(spark, [])).count() == 0
    alone = nd.near_duplicates(frame(spark, [(1, "a b c d e f g", ""), (2, None, "")])).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in alone} == {(1, 1, True), (2, 2, True)}


def test_missed_pairs_are_as_rare_as_said():
    assert nd.chunks_for(0.85) == 11 and nd.chunks_for(0.8) == 19


def test_connected_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(50, 90), rng.randrange(50, 90)) for _ in range(30)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != v}


def test_other_vocabularies_are_refused():
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        with pytest.raises(ValueError):
            splitter(name)
