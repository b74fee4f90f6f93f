"""Byte-pair codec, token alignment and prefix trie against brute force, and on awkward tables."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventgauge.llm import bpe_codec, prefix_trie, queries, token_alignment
from eventgauge.llm.shared import table

FOLDER = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Columns whose names clash with those the operators make.
SCHEMA = "doc_id long, text string, ids array<string>, slice string, pair int, code int, n_a string, held int"
LONG = " ".join("".join(random.Random(k).choices("etaoinséß'", k=7)) for k in range(40_000))
AWKWARD = [
    (1, None), (2, ""), (3, " "), (4, "  \n\t "), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, LONG),
    (7, "<|endoftext|> x <|endoftext|><|endoftext|>"), (8, "a▁b"), (9, "don't  WON'T 's\u0085 \x1c x　y"),
    (10, "naïve ☃ 😀\x00 é 漢字"), (11, "a" * 3000), (12, "</s><s><0x41>"), (13, "x  "), (14, "1½²٣ "),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, ["z"], "s", 1, 2, "n", 3) for i, t in rows], SCHEMA)


def awkward_texts(n, seed):
    parts = [*"ab'1!", "'s", "'ll", "re", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "é", "½", "--"]
    parts += ["<|endoftext|>", "<|endoftext", "漢字", "😀", "́", "qz", "▁", " the", "<0x41>", "ﬁ"]
    rng = random.Random(seed)
    out = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0x1F000, 0x1FFFF)])) for _ in range(rng.randint(0, 9))) for _ in range(n)]


# --- 13 ----------------------------------------------------------------------
def test_forced_pairs_are_inside_no_token():
    codec = bpe_codec.codec(BPE)
    for i in range(0, codec.size - 1, 37):
        b = codec.spelling[codec.begins[i] : codec.begins[i] + codec.lengths[i]]
        assert not codec.forced[b[:-1], b[1:]].any()
    assert codec.forced.mean() > 0.9


@pytest.mark.parametrize("specials", [True, False])
def test_ids_are_those_of_the_library(specials):
    codec, library = bpe_codec.ForcedBoundaryCodec(BPE, specials), Tokenizer.from_file(BPE)
    library.encode_special_tokens = not specials
    texts = [t or "" for _, t in AWKWARD] + awkward_texts(3000, 1) + ["ab" * 2000, " " * 999 + "x", "\n" * 700]
    ids, at = codec.encode(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    assert codec.decode(ids, at).to_pylist() == library.decode_batch(want, skip_special_tokens=False) == texts


def test_heap_and_rounds_agree(monkeypatch):
    texts = pa.array(["".join(random.Random(k).choices("etaoinshrdlu", k=300)) for k in range(20)])
    codec = bpe_codec.codec(BPE)
    rounds = codec.encode(texts)
    monkeypatch.setattr(bpe_codec, "LONG", 10)
    for a, b in zip(rounds, codec.encode(texts), strict=True):
        assert (a == b).all()


def test_decoding_odd_ids(spark):
    library = Tokenizer.from_file(BPE)
    lists = [[], [0, 99], [188], [188, 255, 64], [10**6, 64], [50256, 50256]]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lists)] + [(None, None)], "doc_id long, ids array<int>")
    found = {r.doc_id: r.text for r in bpe_codec.decoded(rows, BPE).collect()}
    for k, ids in enumerate(lists):
        assert found[k] == library.decode([i for i in ids if i < 10**6], skip_special_tokens=False)
    assert found[None] == ""


def test_codec_rows(spark):
    library = Tokenizer.from_file(BPE)

    def digest(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()

    rows = frame(spark, AWKWARD)
    found = bpe_codec.digests(bpe_codec.decoded(bpe_codec.encoded(rows, BPE), BPE)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted((str(i), *digest(t)) for i, t in AWKWARD)
    whole = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    for r in queries.op13_bpe_codec(spark, FOLDER).collect():
        assert tuple(r)[1:] == digest(whole.pop(r.doc_id))
    assert not whole
    assert bpe_codec.encoded(frame(spark, []), BPE).count() == 0


# --- 11 ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def coders():
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    return library, bpe_codec.codec(BPE, False), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def spelled(coders, text):
    """(A ids, B ids, A ends, B ends), or None without tokens."""
    library, codec, pieces = coders
    if not text:
        return None
    a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    said_a = [bytes(codec.spelling[codec.begins[i] : codec.begins[i] + codec.lengths[i]]) for i in a]
    said_b = [bytes([int(pieces.id_to_piece(i)[3:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
        return None
    return a, b, np.cumsum([len(x) for x in said_a]).tolist(), np.cumsum([len(x) for x in said_b]).tolist()


def linked(coders, text):
    """Groups written out and all linked pairs, by testing every pair of a group."""
    said = spelled(coders, text)
    if said is None:
        return None
    a, b, a_ends, b_ends = said
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        m, n = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
        for x in range(i, m):
            for y in range(j, n):
                if (a_ends[x - 1] if x else 0) < b_ends[y] and (b_ends[y - 1] if y else 0) < a_ends[x]:
                    links.append((a[x], b[y]))
        i, j = m, n
    return len(a), len(b), groups, links


def expected(coders, rows):
    known = {t: linked(coders, t) for t in {t for _, t in rows}}
    counts = collections.Counter(p for _, t in rows if known[t] for p in known[t][3])
    highest = collections.Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, t in rows:
        if not known[t]:
            out.append((str(i), 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = known[t]
        best = sum(counts[p] == highest[p[1]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((str(i), n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out)


def test_galloping():
    rng = np.random.default_rng(3)
    for n, m in ((0, 1), (1, 1), (3, 500), (200, 300), (1, 4000)):
        values = np.unique(rng.integers(0, 3 * m, m))
        ends = np.unique(rng.integers(0, values[-1] + 1, n)) if n else values[:0]
        zero = np.zeros(len(ends), np.int64)
        assert (token_alignment.galloped(ends, values, zero, zero + len(values)) == np.searchsorted(values, ends)).all()


def test_alignment_rows(spark, coders):
    # The long text goes through sections, the others through slices of several texts.
    rows = AWKWARD + [(100 + k, t) for k, t in enumerate(awkward_texts(300, 5))]
    want = expected(coders, [(i, t) for i, t in rows if i != 6] + [(6, LONG[:30_000])])
    given = frame(spark, [(i, t if i != 6 else LONG[:30_000]) for i, t in rows]).repartition(3)
    found = token_alignment.aligned(given, BPE, PIECES, limit=4_000)
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == want
    assert token_alignment.aligned(frame(spark, []), BPE, PIECES).count() == 0
    nothing = token_alignment.aligned(frame(spark, [(1, None), (2, "")]), BPE, PIECES).collect()
    assert sorted(tuple(r) for r in nothing) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_sections_with_a_text_that_is_not_spelled_back(spark):
    text = ("word " * 3000) + "▁ " + ("word " * 3000)
    found = token_alignment.aligned(frame(spark, [(1, text)]), BPE, PIECES, limit=5_000).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_query(spark, coders):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    found = queries.op11_token_alignment(spark, FOLDER).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected(coders, rows)


# --- 12 ----------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, depth string, k1 int, path string, cell int, n int"


def brute_trie(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    members, kids, sizes = {}, collections.defaultdict(list), {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        v = own.get(c - c % 100, [])[:h] + v[h:]
        sizes[c] = len(v)
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    leaves, saved = {}, {}
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        below = kids[node]
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = sum(saved[k] for k in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    out = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if sizes[c] == len(node))))
        up = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), up, len(held), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def trie_of(spark, rows, **more):
    given = spark.createDataFrame([(*r, "d", 1, "p", 2, 3) for r in rows], TURNS).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.trie(given, **more).collect()), key=lambda r: (r[1], r[0]))


def conversations(seed, n):
    """Many equal starts, copies, and turns that differ only in role."""
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["u", "a"]) if t > 1 else "u", rng.choice(["", "x", "é😀", "long text"]) if t else "hello")
        for c in rng.sample(range(400), n)
        for t in range(rng.choice([1, 2, 2, 3, 9]))
    ]


ODD_TURNS = [
    (0, 1, "u", "b"), (0, None, "s", "a"), (0, 2, None, None), (0, 2, None, None), (1, 0, "u", ""), (2, 0, "u", "é"),
    (None, 1, "u", "lost"), (101, 0, "u", "no head"), (205, 3, "u", "x"), (205, 3, "a", "x"), (7, None, None, None),
    *((100, t, "u", "t" * (t % 3)) for t in range(40)), *((150, t, "u", "t" * (t % 3)) for t in range(40)),
]


@pytest.mark.parametrize("more", [{}, {"group": 1, "bucket": 2}, {"group": 5, "bucket": 3}])
def test_trie(spark, more):
    for rows in (ODD_TURNS, conversations(1, 120)):
        if more.get("group") == 1:
            # Every shared prefix is a level of its own in Spark; keep them few.
            rows = [r for r in rows if (r[1] or 0) < 4]
        assert trie_of(spark, rows, **more) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "u", "x")]) == []


def test_trie_ends_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = [(c, 0, "u", "same") for c in range(500)]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_sql_and_query(spark):
    given = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in queries.op12_prefix_trie(spark, FOLDER).collect()), key=lambda r: (r[1], r[0]))
    assert found == brute_trie(given)
    with duckdb.connect() as engine:
        engine.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
        engine.executemany("insert into conversations values (?, ?, ?, ?)", ODD_TURNS)
        assert sorted(engine.execute(prefix_trie.SQL).fetchall(), key=lambda r: (r[1], r[0])) == brute_trie(ODD_TURNS)
