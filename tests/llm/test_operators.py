"""Each operator against a brute-force version, and on awkward tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventgauge.llm import (
    chat_format, components, exact_dedup, jaccard_join, lattice, lattice_lm, packing, piece_sampling, quality_rules,
    suffix_dedup, toxicity, warc,
)
from eventgauge.llm.shared import table

FOLDER = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, cell int, key string, words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, 1, 2, "k", 3) for i, t in rows], SCHEMA)


def long_text(n, seed=0):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé"), 5)) for _ in range(400)]
    return " ".join(rng.choice(words, n))


PASSAGE = long_text(60, 1)
AWKWARD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None),
    (6, long_text(20_000)), (7, PASSAGE + " tail " + long_text(40, 2)), (8, long_text(40, 3) + " " + PASSAGE),
    (9, PASSAGE + " tail " + long_text(40, 2) + " x"), (10, "naïve ☃ 😀 text\x1c\u3000 done"), (11, "a  b\t\nc"),
    (12, "<|endoftext|> [INST] \\ </s>"), (13, long_text(120, 4)), (14, long_text(120, 4)), (15, "a " * 300),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def given(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


def by_id(found):
    return {r.doc_id: r for r in found.collect()}


# --- 1 -----------------------------------------------------------------------
def counts_of(text):
    words = WORD.findall(text or "")
    grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    held = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(held)


def test_quality_counts(spark, awkward, documents, nothing):
    rule = quality_rules.Rule((quality_rules.Condition("symbol_share", True, 0.2),), 1.0, 1)
    for rows in (awkward, documents):
        texts = sorted((str(r.doc_id), counts_of(r.text)) for r in rows.collect())
        found = quality_rules.judged(rows, [rule]).collect()
        assert sorted((str(r.doc_id), tuple(r)[1:6]) for r in found) == texts
        for r in found:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            low = r.n_symbols / max(r.word_chars, 1) >= 0.2
            assert r.kept == (not r.base_failed and not low)
    assert quality_rules.judged(nothing, []).count() == 0


def test_decision_list_is_learned_and_keeps_clean_rows():
    rng = np.random.default_rng(3)
    n = 3000
    data = {f: rng.random(n) for f in quality_rules.FEATURES}
    bad = (data["symbol_share"] > 0.9) | ((data["upper_share"] > 0.8) & (data["line_words"] < 0.3))
    rules = quality_rules.learn(data, bad)
    verdict = np.logical_or.reduce([r.holds(data) for r in rules])
    assert verdict[bad].mean() > 0.9
    assert verdict[~bad].mean() < 0.02
    assert quality_rules.learn({f: np.zeros(0) for f in quality_rules.FEATURES}, np.zeros(0, bool)) == []


# --- 2 -----------------------------------------------------------------------
def test_packing(spark, awkward, documents, nothing):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(BPE)
    special = ["a <|endoftext|> b", "<|endoftext|>", " x<|endoftext|><|endoftext|>  y z", "<|endoftext| >", "one <|endoftext|>two <|x|>"]
    specials = frame(spark, list(enumerate(special)))
    for rows in (awkward, documents, specials):
        given = [(r.doc_id, r.text or "") for r in rows.select("doc_id", "text").collect()]
        pieces = packing.pack_documents(rows, BPE).collect()
        wanted = collections.Counter()
        for doc, text in given:
            ids = [*coder.encode(text, add_special_tokens=False).ids, 2]
            sizes = packing.cut(len(ids), 1024)
            assert sum(n for _, n in sizes) == len(ids) and all(n == 1024 for _, n in sizes[1:])
            for k, (start, size) in enumerate(sizes):
                crc = zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())
                wanted[(doc, k, start, size, crc)] += 1
        assert collections.Counter(tuple(r)[:5] for r in pieces) == wanted
        sequences = collections.defaultdict(list)
        for r in pieces:
            sequences[r.sequence_id].append((r.offset, r.length))
        for held in sequences.values():
            ends = list(itertools.accumulate(n for _, n in sorted(held)))
            assert [o for o, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 1024
        assert len(sequences) <= 1.05 * math.ceil(sum(r.length for r in pieces) / 1024) + 2
    assert packing.pack_documents(nothing, BPE).count() == 0
    found = packing.sequences(packing.pack_documents(documents, BPE), documents, BPE)
    assert max(len(r.ids) for r in found.collect()) <= 1024


def test_plan_uses_every_piece_and_prices_configurations():
    histogram = {1024: 5, 600: 40, 424: 37, 300: 100, 7: 1000, 1: 3}
    planned = packing.plan(histogram)
    used = collections.Counter()
    for config, n in planned:
        assert sum(k * v for k, v in config.items()) <= 1024
        for k, v in config.items():
            used[k] += n * v
    assert used == histogram
    assert sum(n for _, n in planned) <= math.ceil(sum(k * v for k, v in histogram.items()) / 1024) + 2
    lengths = np.array([3, 5])
    assert packing.dearest(np.array([3.0, 5.1]), lengths, np.array([9, 9]), 8) == {0: 1, 1: 1}
    assert packing.plan({}) == []


def least_sequences(sizes, capacity):
    """By trying every partition: the fewest sequences that hold the pieces."""

    def place(rest, free):
        if not rest:
            return len(free)
        found = [place(rest[1:], [*free, capacity - rest[0]])]
        for room in {r for r in free if r >= rest[0]}:
            left = list(free)
            left[left.index(room)] -= rest[0]
            found.append(place(rest[1:], left))
        return min(found)

    return place(sorted(sizes, reverse=True), [])


def test_the_program_proves_its_bound_and_covers_all_pieces():
    draw = np.random.default_rng(3)
    for _ in range(25):
        sizes = draw.integers(1, 40, draw.integers(1, 8)).tolist()
        lengths, counts = np.unique(sizes, return_counts=True)
        used, bound, dual = packing.fractional(lengths, counts, 40)
        fewest = least_sequences(sizes, 40)
        assert bound <= fewest + 1e-6
        # No configuration is worth more than one at the prices of the bound.
        assert packing.room_values(dual, lengths, 40)[40] <= 1 + 1e-6
        served = np.zeros(len(lengths))
        for config, n in used.items():
            assert sum(int(lengths[k]) * v for k, v in config) <= 40
            for k, v in config:
                served[k] += n * v
        assert (served >= counts * (1 - 1e-6)).all()
        planned = packing.plan(collections.Counter(sizes), 40)
        assert fewest <= sum(n for _, n in planned) <= fewest + 1


def test_the_program_serves_most_pieces_at_every_size():
    documents = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text")
    coder = packing.encoder(BPE)
    sizes = [len(x) + 1 for x in coder.encode(documents.combine_chunks().fill_null(""))]
    base = collections.Counter(n for size in sizes for _, n in packing.cut(size, 1024) if n < 1024)
    lengths = np.array(sorted(base))
    for times in (1, 10, 100, 1000):
        counts = np.array([base[k] * times for k in lengths.tolist()])
        used, bound, dual = packing.fractional(lengths, counts, 1024)
        assert sum(used.values()) <= 1.02 * bound + 1
        often = sorted(used.items(), key=lambda c: (-c[1], c[0]))
        worth = [c for c in often if sum(dual[k] * v for k, v in c[0]) >= 1 - packing.SLACK[3]]
        _, left = packing.rounded(worth, counts)
        assert left.sum() < 0.5 * counts.sum(), (times, left.sum() / counts.sum())
        histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        planned = sum(n for _, n in packing.plan(histogram))
        assert planned <= 1.005 * bound + 1
        assert planned <= 1.0005 * sum(n for _, n in packing.best_fit(histogram, 1024)) + 1


# --- 3 -----------------------------------------------------------------------
def test_sampled_segmentations(spark, awkward, nothing):
    found = piece_sampling.sampled(awkward, PIECES, k=3, with_ids=True).collect()
    assert all(r.round_trip for r in found)
    groups = collections.defaultdict(list)
    for r in found:
        groups[(r.doc_id, r.ids_crc32 if r.doc_id is None else 0)].append(r)
    for doc, rows in groups.items():
        if doc[0] in (6, 7, 10, 13):
            assert len({tuple(r.ids) for r in rows}) == 3
            values = [r.score for r in sorted(rows, key=lambda r: r["sample"])]
            assert values == sorted(values, reverse=True)
            assert all(0 <= r.inclusion <= 1 for r in rows)
    assert [(r.n_pieces, r.inclusion) for r in found if r.doc_id == 2] == [(0, 1.0)]
    back = piece_sampling.decoded(piece_sampling.encoded(awkward.filter("doc_id = 10"), PIECES), PIECES)
    assert back.first().text == dict(AWKWARD)[10]
    assert piece_sampling.sampled(nothing, PIECES).count() == 0


def every_way(text, vocabulary):
    whole = lattice.MARK + text
    known = {p: i for i, p in enumerate(vocabulary.pieces) if np.isfinite(vocabulary.weights[i]) and i not in vocabulary.byte}
    out = []

    def walk(at, ids, weight):
        if at == len(whole):
            out.append((tuple(ids), weight))
        for stop in range(at + 1, len(whole) + 1):
            if (i := known.get(whole[at:stop])) is not None:
                walk(stop, [*ids, i], weight + vocabulary.weights[i])

    walk(0, [], 0.0)
    return dict(out)


def test_pieces_are_decoded_without_a_list_of_them():
    """Decoding reads the pieces from one array; it spells what the pieces one by one spell."""
    vocabulary = lattice.vocabulary(PIECES)
    assert vocabulary.spelled.to_pylist() == vocabulary.decoded
    draw = np.random.default_rng(5)
    for text in ("", "a", " two  blanks ", "naïve 試 \U0001f9ea\x00", "word " * 500):
        ids = np.array(vocabulary.model.encode(text), np.int64) if text else np.zeros(0, np.int64)
        assert piece_sampling.decode(ids, vocabulary) == b"".join(vocabulary.decoded[i] for i in ids)[1:].decode()
    plain = [i for i, piece in enumerate(vocabulary.decoded) if piece.isascii()]
    ids = draw.choice(plain, 3000)
    assert piece_sampling.decode(ids, vocabulary) == b"".join(vocabulary.decoded[i] for i in ids)[1:].decode()


def test_samples_follow_the_gumbel_law():
    vocabulary = lattice.vocabulary(PIECES)
    ways = every_way("hats", vocabulary)
    total = np.logaddexp.reduce(list(ways.values()))
    first, inside, n = collections.Counter(), collections.Counter(), 3000
    for _, number, ids, chance, *_ in piece_sampling.sample_batch(["hats"] * n, list(range(n)), 2, vocabulary, vocabulary.weights):
        way = tuple(ids.tolist())
        assert abs(ways[way] - total - chance) < 1e-9
        first[way] += number == 0
        inside[way] += 1
    p = {w: math.exp(x - total) for w, x in ways.items()}
    for way, chance in p.items():
        assert abs(first[way] / n - chance) < 5 * math.sqrt(chance * (1 - chance) / n) + 1e-3
        second = chance + sum(q * chance / (1 - q) for w, q in p.items() if w != way)
        assert abs(inside[way] / n - second) < 5 * math.sqrt(max(second * (1 - second), 0) / n) + 2e-3


def test_samples_are_searched_for_all_texts_of_a_batch_at_once(monkeypatch):
    """Random numbers are drawn for a batch, not text by text."""
    vocabulary = lattice.vocabulary(PIECES)
    odd = ["", "a", " two  blanks ", "naïve 試 \U0001f9ea\x00", "\U0001f9ea" * 300 + "hats", "\U0001f9ea" * 300]
    drawn, uniforms = [], piece_sampling.uniforms
    monkeypatch.setattr(piece_sampling, "uniforms", lambda *x: drawn.append(1) or uniforms(*x))
    counts = []
    for times in (1, 60):
        drawn.clear()
        found = list(piece_sampling.sample_batch(odd * times, list(range(len(odd) * times)), 3, vocabulary, vocabulary.weights))
        counts.append(len(drawn))
        for n, _, ids, chance, *_ in found:
            assert piece_sampling.decode(ids, vocabulary) == odd[n % len(odd)]
            assert chance <= 0
        # Marks spelled by bytes have one way each.
        assert all(number == 0 for n, number, *_ in found if n % len(odd) in (0, 5))
        assert len({(n, tuple(ids.tolist())) for n, _, ids, *_ in found}) == len(found)
    assert counts[1] <= 2 * counts[0]


def test_samples_do_not_depend_on_the_other_rows(awkward):
    """Equal rows have equal samples, whatever rows share their batch."""

    def samples(rows):
        found = piece_sampling.sampled(rows, PIECES, k=3).collect()
        return collections.Counter((r.doc_id, r["sample"], r.n_pieces, r.ids_crc32) for r in found)

    once = samples(awkward.coalesce(1))
    assert samples(awkward.repartition(5)) == once
    assert samples(awkward.unionByName(awkward).coalesce(1)) == collections.Counter({k: 2 * n for k, n in once.items()})
    vocabulary = lattice.vocabulary(PIECES)
    whole = list(piece_sampling.sample_batch(["other words"] * 3 + ["word " * 500], [1, 2, 3, 4], 3, vocabulary, vocabulary.weights))
    alone = list(piece_sampling.sample_batch(["word " * 500], [4], 3, vocabulary, vocabulary.weights))
    assert [x[2].tolist() for x in whole if x[0] == 3] == [x[2].tolist() for x in alone]


# --- 4 -----------------------------------------------------------------------
def test_exact_dedup(spark, awkward, documents, nothing):
    for rows in (awkward, documents):
        groups = collections.defaultdict(list)
        for r in rows.select("doc_id", "text").collect():
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
        wanted = []
        for text, ids in groups.items():
            ids.sort(key=lambda i: (i is None, i))
            sha = hashlib.sha256(text.encode()).hexdigest()
            wanted += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
        found = [tuple(r) for r in exact_dedup.deduplicated(rows).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, wanted))
    assert exact_dedup.deduplicated(nothing).count() == 0
    stay = exact_dedup.without_duplicates(awkward)
    assert stay.columns == awkward.columns
    assert stay.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in AWKWARD})


def test_filter_has_all_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 20_000):
        keys = rng.integers(0, 2**63, n, dtype=np.uint64)
        built = exact_dedup.BinaryFuseFilter.unpack(exact_dedup.BinaryFuseFilter.build(keys).pack())
        assert built.has(keys).all()
        assert built.has(rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)).mean() < 0.02


# --- 5 -----------------------------------------------------------------------
def removed_by_force(texts, length):
    seen = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k + 1 : k + length + 1] = True
        rest = bytes(np.frombuffer(t, np.uint8)[~gone[1:-1]])
        yield int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(rest).hexdigest()


@pytest.mark.parametrize("shard_pieces", [suffix_dedup.SHARD_PIECES, 3])
def test_suffix_dedup(spark, awkward, documents, shard_pieces):
    for rows in (awkward, documents):
        texts = [(r.doc_id, (r.text or "").encode()) for r in rows.select("doc_id", "text").collect()]
        force = removed_by_force([t for _, t in texts], 200)
        wanted = [(i, len(t), *found) for (i, t), found in zip(texts, force, strict=True)]
        found = [tuple(r) for r in suffix_dedup.removed(rows, 200, shard_pieces).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, wanted))


def test_suffix_dedup_keeps_characters_and_columns(awkward, nothing):
    assert suffix_dedup.removed(nothing).count() == 0
    rest = suffix_dedup.without_repeats(awkward)
    assert rest.columns == awkward.columns and rest.count() == len(AWKWARD)
    assert by_id(rest)[4].text == "one"
    assert suffix_dedup.whole_characters("aé☃b".encode(), [(2, 5)]) == []
    assert suffix_dedup.whole_characters("aé☃b".encode(), [(0, 4)]) == [(0, 3)]


def test_suffix_array_orders_and_measures():
    data = np.frombuffer(b"banana bandana banana bandit", np.uint8)
    room = len(data) - np.arange(len(data))
    order, keys = suffix_dedup.suffix_array(data, room, 12)
    text = data.tobytes()
    assert [text[i : i + 12] for i in order] == sorted(text[i : i + 12] for i in range(len(text) - 11))
    common = suffix_dedup.common_prefixes(order, keys, np.array([0]), np.array([len(text) - 11]), len(text), 12)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :][:12], text[order[k] :][:12]
        assert common[k] == next((i for i in range(12) if a[i] != b[i]), 12)


# --- 6 -----------------------------------------------------------------------
def test_lm_scores(spark, awkward, documents, nothing):
    lower = {i: i + 32 for i in range(65, 91)}
    for rows in (awkward, documents):
        texts = [(r.doc_id, WORD.findall((r.text or "").translate(lower))) for r in rows.select("doc_id", "text").collect()]
        held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
        count = collections.Counter(w for i, words in texts if not held(i) for w in [*words, None])
        total, kinds = sum(count.values()), len(count)
        wanted = collections.Counter()
        for i, words in texts:
            tokens = [*words, None]
            base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
            wanted[(i, held(i), len(tokens), sum(count[w] > 0 for w in tokens), total, round(base, 5))] += 1
        found = lattice_lm.scored(rows, PIECES).collect()
        got = collections.Counter((*tuple(r)[:5], round(r.base_score, 5)) for r in found)
        assert got == wanted
        assert all(r.score < 0 for r in found)
    assert lattice_lm.scored(nothing, PIECES).count() == 0


def test_lattice_sums_all_segmentations():
    vocabulary = lattice.vocabulary(PIECES)
    words = ["hats", "the", "ü", "", "zq\x01"]
    built = lattice.Lattice.of(words, vocabulary)
    scores = built.scores(vocabulary, vocabulary.weights)
    back, front = built.backward(scores), built.forward(scores)
    assert np.allclose(back[built.roots], front[built.ends])
    for k in (0, 1):
        assert np.isclose(back[built.roots[k]], np.logaddexp.reduce(list(every_way(words[k], vocabulary).values())))


# --- 7 -----------------------------------------------------------------------
def sets_of(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


@pytest.mark.parametrize("chunk", [jaccard_join.CHUNK, 2])
def test_jaccard_join(spark, awkward, documents, chunk):
    for rows in (awkward, documents):
        texts = [(r.doc_id, sets_of(r.text)) for r in rows.select("doc_id", "text").collect()]
        nodes = collections.defaultdict(list)
        for i, s in texts:
            nodes[s].append(i)
        least = lambda ids: min(ids, key=lambda i: (i is None, i))
        linked = {s: [t for t in nodes if t != s and s and t and len(s & t) >= 0.8 * len(s | t)] for s in nodes}
        wanted = []
        for i, s in texts:
            if not s:
                wanted.append((i, i, i, 1, 0, 0))
                continue
            part, todo = {s}, [s]
            while todo:
                for t in linked[todo.pop()]:
                    if t not in part:
                        part.add(t)
                        todo.append(t)
            class_id = least([d for t in part for d in nodes[t]])
            wanted.append((i, class_id, least(nodes[s]), len(nodes[s]), len(linked[s]), sum(len(nodes[t]) for t in linked[s])))
        found = [tuple(r) for r in jaccard_join.joined(rows, chunk).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, wanted))


def test_near_copies_of_one_group_leave_one(spark, nothing):
    base = long_text(200, 9).split()
    rows = []
    for k in range(60):
        words = list(base)
        words[k] = f"w{k}"
        rows.append((100 - k, " ".join(words)))
    kept = jaccard_join.one_of_each(frame(spark, [*rows, (500, long_text(100, 10))]))
    assert sorted(r.doc_id for r in kept.collect()) == [41, 500]
    assert jaccard_join.joined(nothing).count() == 0


def test_bayes_bounds_and_components(spark):
    fewest = jaccard_join.least_matches(0.8, 1e-9, 60, 30)
    assert 0 < fewest[0] < 24 < 24 + fewest[1]
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(60, 70), (80, 70), (5, 5)], "u long, v long")
    found = {r.u: r.root for r in components.components(edges).collect()}
    assert found == {**{k: 1 for k in range(2, 41)}, 70: 60, 80: 60}


# --- 8 -----------------------------------------------------------------------
PAGES = [(1, "u", "<p>a</p>"), (2, None, "<p>a</p>"), (3, "u", None), (4, "u", ""), (5, "u\r\nx: y", "é" * 5000),
         (None, "u", "<p>a</p>"), (7, "u", "WARC/1.1\r\n\r\n"), (8, "v", "dup"), (8, "w", "dup")]


@pytest.mark.parametrize("least", [0, 6])
def test_warc_round_trip(spark, least):
    given = table(spark, FOLDER, "pages").select("page_id", "url", "html").collect()
    for rows in (PAGES, [(r.page_id, r.url, r.html) for r in given] * 2):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        groups = collections.defaultdict(list)
        for page, _, html in rows:
            groups[(html or "").encode()].append(page)
        wanted = []
        for payload, ids in groups.items():
            ids.sort(key=lambda i: (i is not None, i))
            digest = warc.base32_sha1(payload)
            for k, i in enumerate(ids):
                again = k < len(ids) - 1 and len(payload) >= least
                wanted.append((i, len(payload), digest, "revisit" if again else "response", ids[-1] if again else None))
        found = [tuple(r) for r in warc.write_and_read(pages, least).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, wanted))
    payloads = {r.page_id: bytes(r.payload) for r in warc.read(warc.archives(spark.createDataFrame(PAGES[4:5], "page_id long, url string, html string"))).collect()}
    assert payloads == {5: ("é" * 5000).encode()}
    assert warc.write_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_archives_are_refused():
    good = warc.record(1, "u", b"abc", warc.base32_sha1(b"abc"), 3, None)
    assert warc.parse(good)["payload"] == b"abc"
    for bad in (good.replace(b"WARC/1.1", b"WARC/0.1"), good[:-1], good.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"),
                good.replace(b"WARC-Date", b"WARC-Late"), good.replace(b"Content-Length: 3", b"Content-Length: x")):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
    import zstandard

    whole = warc.leading_frame(b"") + zstandard.ZstdCompressor().compress(good)
    assert list(warc.frames(iter([whole[:5], whole[5:20], whole[20:]]))) == [good]
    for bad in (whole[:6], whole[8:], whole[:-3]):
        with pytest.raises(warc.WarcError):
            list(warc.frames(iter([bad])))


# --- 9 -----------------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark, awkward, nothing):
    folder = "/root/testdata/sf0.1"
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fitted(documents, labels)
    held = toxicity.scored(documents, model).join(labels, "doc_id").filter("held_out").toPandas()
    # Some 300 toxic texts to learn from: few false alarms, and scores that order the classes.
    toxic, clean = held.loc[held["toxic"] == 1], held.loc[held["toxic"] == 0]
    assert clean["predicted"].mean() < 0.02
    assert (held["predicted"] == held["toxic"]).mean() > 0.92
    assert toxic["predicted"].mean() > 0.45
    above = (toxic["score"].to_numpy()[:, None] > clean["score"].to_numpy()).mean()
    assert above > 0.75
    found = toxicity.scored(awkward, model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.scored(nothing, model).count() == 0
    rest = toxicity.ordinary_documents(awkward, model)
    assert rest.columns == awkward.columns
    none = toxicity.fitted(nothing, spark.createDataFrame([], "doc_id long, toxic int, quality int"))
    assert {r.predicted for r in toxicity.scored(awkward, none).collect()} == {0}


def test_labelled_texts_are_bounded_evenly():
    assert toxicity.evenly(list(range(10)), 10) == list(range(10))
    assert toxicity.evenly(range(10), 5) == [0, 2, 4, 6, 8]
    assert toxicity.spread("é x", 4) == "é x"
    long = "".join(f"{k:06d} " for k in range(100_000)) + "é" * 50_000
    cut = toxicity.spread(long, 5000)
    assert 4000 < len(cut.encode()) <= 5000 and cut.startswith("000000 ") and cut.endswith("é")
    # Pieces from all over: the numbers in them rise and reach the last tenth.
    found = [int(x) for x in re.findall(r"\b\d{6}\b", cut)]
    assert found == sorted(found) and found[-1] > 90_000
    # One long text does not push the others out of the dictionary's windows.
    model = toxicity.dictionaries(["bad words here"] * 3, ["a " * 500_000, *["quite ordinary sentences"] * 9])
    assert model.ordinary


# --- 10 ----------------------------------------------------------------------
SAID = "</s>[INST] ok [/INST]"
CHATS = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID), (1, 0, "user", None), (1, 1, None, "x"), (2, 1, "assistant", "b\\"),
         (2, 0, "user", "a [/INST"), (3, 0, "narrator", "[ROLE] [[INST]"), (3, 0, "narrator", "[ROLE] [[INST]"),
         (None, 0, "user", "n"), (4, 0, "assistant", "</s </s></s>"), (4, None, "assistant", " \\</s>")]


def test_chat_round_trip(spark):
    given = table(spark, FOLDER, "conversations").collect()
    for rows in (CHATS, [(r.conv_id, r.turn, r.role, r.text) for r in given]):
        chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        groups = collections.defaultdict(list)
        for conv, turn, role, text in rows:
            groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
        found = {r.conv_id: r for r in chat_format.format_conversations(chats).collect()}
        assert set(found) == set(groups)
        for conv, turns in groups.items():
            turns.sort()
            body = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
            loss = "".join(text for *_, role, text in turns if role == "assistant")
            r = found[conv]
            assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(body.encode()).hexdigest())
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_conversations(empty).count() == 0


def test_turn_order_and_escapes(spark):
    chats = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    valid = {r.conv_id: r.valid for r in chat_format.turn_order(chats).collect()}
    assert (valid[-7], valid[2], valid[1], valid[3], valid[4]) == (True, True, False, False, False)
    writer = chat_format.Writer(chat_format.INSTRUCT)
    for text in ("[INST][INST]", "\\", "<\\/s>", "[[INST]INST]", SAID, "<s></s>\\\\"):
        safe = writer.escape(text)
        assert writer.unescape(safe) == text
        assert not any(m in safe for m in chat_format.INSTRUCT.guarded())


# --- pipeline ----------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "suffix_dedup", "packing"]
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER).cache()
        assert after.columns == columns
        assert 0 < after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_runs_do_not_depend_on_sections():
    draw = np.random.default_rng(5)
    texts = [draw.integers(97, 100, n).astype(np.uint8) for n in (0, 199, 200, 201, 5000, 1, 1300)]
    flat, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def windows(section):
        made = {}
        for text, first, n, anchor in zip(*suffix_dedup.runs(flat, offsets, 200, section), strict=True):
            for k in range(n):
                assert made.setdefault((int(text), int(first) + k), int(anchor)) == int(anchor)
        return made

    whole = windows(1 << 24)
    assert set(whole) == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - 199)}
    assert len(set(whole.values())) > 20
    for section in (1, 150, 777, 4096):
        assert windows(section) == whole


def test_runs_go_on_across_sections():
    flat = np.random.default_rng(6).integers(97, 123, 150_000).astype(np.uint8)
    offsets = np.array([0, 0, 70_000, 70_100, 150_000, 150_000])
    whole, cut = (suffix_dedup.runs(flat, offsets, 200, section) for section in (1 << 24, 1000))
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    text, first, windows, anchor = whole
    assert windows.sum() == 70_000 + 79_900 - 2 * 199
    # Two texts of random letters: no anchor comes twice, so no run was cut in two.
    assert len(np.unique(anchor)) == len(anchor)


def test_only_windows_that_may_recur_are_sorted():
    rng = np.random.default_rng(7)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    pieces, places, anchors = [], [], []
    # Of each anchor two pieces that share `left` bytes before it and `right` bytes from it on.
    for k, (left, right) in enumerate([(0, 40), (50, 100), (80, 120), (100, 150), (168, 200), (3, 199), (150, 60)] * 20):
        shared = letters(left), letters(right)
        for _ in range(2):
            place, rest = int(rng.integers(100, 169)), int(rng.integers(180, 200))
            before, after = letters(place) + shared[0], shared[1] + letters(rest)
            pieces.append(before[-place:] + after[:rest])
            places.append(place)
            anchors.append(k)
    counts = np.ones(len(pieces), np.int64)
    low, high = suffix_dedup.likely_windows(pieces, counts, np.array(anchors), np.array(places))
    seen = collections.Counter()
    for piece, anchor in zip(pieces, anchors, strict=True):
        seen.update((anchor, piece[w : w + 200]) for w in range(len(piece) - 199))
    sorted_ = exact = 0
    for k, (piece, anchor) in enumerate(zip(pieces, anchors, strict=True)):
        again = [w for w in range(len(piece) - 199) if seen[anchor, piece[w : w + 200]] > 1]
        assert all(low[k] <= w < high[k] for w in again)
        assert again or high[k] - low[k] <= 2 * 22
        sorted_, exact = sorted_ + max(0, high[k] - low[k]), exact + len(again)
    assert 0 < exact <= sorted_ < 0.6 * sum(len(p) - 199 for p in pieces)
    # A piece that is in two texts keeps all its windows.
    low, high = suffix_dedup.likely_windows(pieces, counts * 2, np.array(anchors), np.array(places))
    assert (low == 0).all() and (high == [len(p) - 199 for p in pieces]).all()


def test_windows_of_split_anchors_are_merged_in_several_tasks(spark):
    # Keys of three shards; those below 300 that 5 divides are in two of them.
    held = [(b"a", 0, list(range(300))), (b"b", 1, list(range(0, 300, 5))), (b"c", 2, list(range(300, 600)))]
    rows = [(p, part, [], [k + 7 for k in keys], keys) for p, part, keys in held]
    found = spark.createDataFrame(rows, "piece binary, part int, runs array<int>, windows array<int>, keys array<long>")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        made = suffix_dedup.merged(found).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(name, before)
    again = sorted((bytes(r.piece), list(r.runs)) for r in made)
    assert again == [(p, [k + 7] * 2) for p in (b"a", b"b") for k in range(0, 300, 5)]
    assert len({r.task for r in made}) > 1


def test_flat_bytes_of_slices():
    from eventgauge.llm.shared import flat_bytes, steps

    batch = pa.record_batch([pa.array(["ab", None, "", "cdé"])], ["text"])
    assert sum(s.num_rows for s in steps(iter([batch]), limit=2)) == 4
    flat, offsets = flat_bytes(pa.array(["xx", "ab", "cdé"]).slice(1))
    assert (bytes(flat), offsets.tolist()) == ("abcdé".encode(), [0, 2, 6])
