from __future__ import annotations

import gzip
import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stockflow.llm import cascade, fingerprint, html_text, lattice, minhash, packing, sharding, suffix, toxicity, warc
from stockflow.llm.components import connected
from stockflow.llm.queries import vocabulary
from stockflow.llm.storage import shared_dir

from . import brute


# --- 4, near duplicates ------------------------------------------------------


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_all_pairs(docs, rows, width):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width, 80).collect()}
    assert got == brute.near_duplicates(rows, width, 80)
    assert len({c for _, c in got.values()}) < len(rows) - 5


def test_near_duplicates_edge_cases(odd, nothing, rows):
    got = minhash.near_duplicates(odd, 4, 80).collect()
    assert len(got) == 17
    want = brute.near_duplicates(rows[:12], 4, 80)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash.near_duplicates(nothing, 4, 80).count() == 0


def test_star_leaves_are_linked(spark):
    """Leaves that are alike are linked although neither is like the hub; blocks are smaller than the bucket."""
    words = [f"w{i}" for i in range(200)]
    other = words[:20] + [f"v{i}" for i in range(45)] + words[65:]
    rows = [(0, " ".join(words))] + [(i, " ".join([*other[:-1], f"end{i}"])) for i in range(1, 9)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0} | dict.fromkeys(range(1, 9), 1)


def test_signature_agreement_is_the_similarity():
    rng, order = np.random.default_rng(1), minhash.probe_order(288)
    for n, shared in ((10, 8), (60, 40), (900, 600)):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2**63, 2 * n).astype(np.uint64))
            a, b = np.sort(pool[:n]), np.sort(pool[n - shared : 2 * n - shared])
            agree.append(np.mean(minhash.signature(a, order) == minhash.signature(b, order)))
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.03


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 2, repeated passages ----------------------------------------------------


@pytest.mark.parametrize("limit", [20_000, 2])
def test_repeats_equal_a_scan(docs, rows, limit):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.dedup_report(docs, 100, limit).collect()}
    assert got == {i: w[:4] for i, w in brute.repeats(rows, 100).items()}


@pytest.mark.parametrize("limit", [2, 5, 40])
def test_crowded_groups_in_rounds(spark, limit):
    """Groups far above the limit, of copies, of near copies and of different texts around one passage."""
    rng = random.Random(limit)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage = "the same thirty-two bytes of text " * 2, prose(60)
    texts = [f"{prose(rng.randint(5, 30))} {line}{prose(rng.randint(5, 30))}" for _ in range(60)]
    texts += [f"{prose(4)} {passage} {prose(4)}" for _ in range(50)] + [passage[k:] for k in range(0, 200, 9)]
    texts += ["ab" * 400, "x" * 900, "x" * 500 + "y", passage * 3]
    docs = list(zip(rng.sample(range(10_000), len(texts)), texts, strict=True))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.dedup_report(frame, 100, limit).collect()}
    want = brute.repeats(docs, 100)
    assert got == {i: w[:4] for i, w in want.items()}


def test_left_starts_and_grams():
    rng = np.random.default_rng(3)
    piece = rng.integers(97, 100, 160).astype(np.uint8).tobytes()
    left = suffix.left_starts([piece, piece[:120]], np.array([7, 3]), np.array([50, 0]), [(7, 52, 155), (3, 10, 110)], 100)
    assert left[0].tolist() == [0, 1, *range(6, 61)] and left[1].tolist() == [*range(10), *range(11, 21)]
    grams = suffix._small_grams(np.frombuffer(piece, np.uint8))
    for nth in (1, 2, 5, 500):
        found = suffix.nth_grams(piece, np.arange(61), 100, nth)
        for s in range(61):
            different = sorted({*grams[s : s + 69].tolist()})
            assert found[s] == different[min(nth, len(different)) - 1]


def test_repeats_edge_cases(odd, nothing, rows, docs):
    got = suffix.dedup_report(odd, 100).collect()
    want = brute.repeats(rows[:12], 100)
    assert len(got) == 17
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id][:4] for r in got if r.doc_id is not None)
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert suffix.dedup_report(nothing, 100).count() == 0
    texts = {r.doc_id: r.text for r in suffix.dedup_texts(docs, 100).collect()}
    assert all(len(texts[i].encode()) - len(w[4]) in range(0, 8) for i, w in brute.repeats(rows, 100).items())


def test_interval_tree_has_all_occurrences():
    """Every repeat that cannot be made longer, with all its places."""
    pieces = [b"abcxyzabcxyzabc", b"qabcxyzw", b"zzzzzz"]
    doc, start, found = suffix.repeats(pieces, np.array([1, 2, 3]), np.array([0, 0, 0]), 3)
    got = {(depth, frozenset(zip(doc[a : b + 1].tolist(), start[a : b + 1].tolist(), strict=True))) for depth, a, b in found}
    assert (9, frozenset({(1, 0), (1, 6)})) in got
    assert (6, frozenset({(1, 0), (1, 6), (2, 1)})) in got or (3, frozenset({(1, 0), (1, 6), (1, 12), (2, 1)})) in got
    assert (5, frozenset({(3, 0), (3, 1)})) in got


# --- 8, quality --------------------------------------------------------------


def test_quality_counts(docs, odd, nothing, rows):
    texts = dict(rows)
    for r in cascade.quality(docs).collect():
        counts, failed = brute.quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == failed and not (r.base_failed and r.kept)
    assert cascade.quality(odd).count() == 17 and cascade.quality(nothing).count() == 0


def test_cascade_order_changes_the_work_only():
    calls = Counter()

    def rule(name, rejects, work):
        def run(text):
            calls[name] += 1
            sum(range(work))
            return rejects(text)

        return cascade.Rule(name, run)

    rules = (rule("slow", lambda t: t.n_words % 2 == 0, 20_000), rule("idle", lambda t: False, 10), rule("sharp", lambda t: t.n_words > 3, 10))
    texts = [cascade.Text("w " * n) for n in [*range(1, 21)] * 10]
    judge = cascade.Cascade(rules, sample=40)
    got = [judge.rejects(t) for t in texts]
    assert got == [t.n_words % 2 == 0 or t.n_words > 3 for t in texts]
    assert judge.order[0].name == "sharp" and calls["slow"] < 40 + 0.4 * len(texts)


# --- 6, packing --------------------------------------------------------------


def check_packing(got, tokenizer, texts, capacity):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0][r.start : r.start + r.length]
        assert r.start == capacity * r.piece and len(ids) == r.length
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    for places in by.values():
        ends = [sum(n for _, n in sorted(places)[:k]) for k in range(len(places))]
        assert [o for o, _ in sorted(places)] == ends and sum(n for _, n in places) <= capacity
    return len(by)


def test_packing(docs, odd, nothing, rows):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer, texts = Tokenizer.from_file(path), dict(rows)
    for capacity in (256, 2048):
        got = packing.packed(docs, path, capacity).collect()
        total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())
        assert sum(r.length for r in got) == total
        assert check_packing(got, tokenizer, texts, capacity) <= 1.05 * total / capacity + 2
    assert check_packing([r for r in packing.packed(docs, path, 256, group=16).collect()], tokenizer, texts, 256)
    texts[None] = None
    odd_ = packing.packed(odd, path).collect()
    assert len({r.sequence_id for r in odd_}) <= 1.1 * sum(r.length for r in odd_) / 2048 + 1
    assert len({(r.doc_id, r.sequence_id, r.offset) for r in odd_}) == len(odd_)
    assert packing.packed(nothing, path).count() == 0


def test_encoder_equals_the_tokenizer():
    encoder = packing.Encoder(vocabulary("word_bpe_49k.json"))
    for text in ["", "  ", "It's   we'll é x　z <|endoftext|>", "don't' a_b_ ½x², ΑΣ ΟΔΟΣ, Ⅷ. i̇. É! é.", "áb,c.d!! ***"]:
        for _ in range(2):
            assert encoder.ids(text).tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_encoder_equals_the_tokenizer_on_marks_and_random_texts():
    encoder = packing.Encoder(vocabulary("word_bpe_49k.json"))
    rng = random.Random(2)
    pool = "abcJTİΣσıéñÉ'’“.,;:!?()019 \n\t\u0327\u030c\u0307क\u0958\u093cहिन्दी中ßẞ<|>_-\x1c\x85\u3000"
    texts = ["Σ İ(", "ह\u0958,", "J\u030c,"]
    texts += [f"a{chr(c)}!" for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    for text, want in zip(texts, encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert encoder.ids(text).tolist() == [*want.ids, 0], ascii(text)


def test_local_search_empties_bins():
    """One exchange lets a bin go that best fit has to open."""
    bins = packing.Bins(np.array([1]), 10)
    bins.lengths = [6, 4, 5, 3, 2]
    bins.members, bins.fill = [[0, 3], [2, 1], [4]], [9, 9, 2]
    bins.search()
    assert sum(f > 0 for f in bins.fill) == 2 and sorted(f for f in bins.fill if f) == [10, 10]


def test_local_search_leaves_no_step():
    """Hundreds of open bins: no pair of them has a step left that raises the sum of squares."""
    lengths = np.random.default_rng(1).integers(300, 1001, 1000)
    bins = packing.Bins(lengths, 2048)
    before = sum(f > 0 for f in bins.fill)
    assert sum(0 < f < 2048 for f in bins.fill) > 200
    bins.search()
    assert bins.fill == [sum(bins.lengths[i] for i in m) for m in bins.members]
    assert sorted(i for m in bins.members for i in m) == list(range(1000)) and max(bins.fill) <= 2048
    assert sum(f > 0 for f in bins.fill) <= before - 5
    open_ = [b for b, f in enumerate(bins.fill) if 0 < f < 2048]
    sizes = {b: [bins.lengths[i] for i in bins.members[b]] for b in open_}
    for light in open_:
        own = sizes[light]
        gives = {*own, *(a + b for k, a in enumerate(own) for b in own[:k])}
        for heavy in (b for b in open_ if b != light):
            nets = {g - t for g in gives for t in (0, *sizes[heavy]) if 0 < g - t <= 2048 - bins.fill[heavy]}
            assert all(n + bins.fill[heavy] <= bins.fill[light] for n in nets)


# --- 7, shards ---------------------------------------------------------------


def test_shards(spark, docs, odd, nothing, rows):
    text = lambda i: "same" if i % 3 == 0 else f"t{i % 300}" if i < 400 else f"own {i}"
    many = spark.createDataFrame([(i, text(i)) for i in range(900)], "doc_id long, text string")
    for frame, n in ((docs, len(rows)), (odd, 17), (many, 900)):
        got = sharding.shards(frame, 16, slice_rows=100).collect()
        counts = Counter(r.shard for r in got)
        assert len(got) == n and max(counts.values()) - min([*counts.values(), *([0] if len(counts) < 16 else [])]) <= 1
        for shard, count in counts.items():
            assert sorted(r.slot for r in got if r.shard == shard) == list(range(count))
    texts = dict(many.collect())
    by_text = defaultdict(Counter)
    for r in got:
        assert r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        by_text[texts[r.doc_id]][r.shard] += 1
    # 300 equal texts need six shards of 56; pairs stay together, but for few.
    same = by_text.pop("same")
    assert sum(n for _, n in same.most_common(6)) >= 200
    assert sum(len(c) > 1 for c in by_text.values()) <= 12
    assert sharding.shards(nothing, 16).count() == 0


def test_granted_moves_keep_counts():
    rng = np.random.default_rng(3)
    for _ in range(30):
        asked, spare = rng.integers(0, 50, (6, 6)), rng.integers(0, 40, 6)
        np.fill_diagonal(asked, 0)
        moves, back = sharding.granted(asked, spare)
        assert (moves <= asked).all() and (moves >= 0).all() and (back.sum(axis=1) <= spare).all()
        assert ((moves + back).sum(axis=0) == (moves + back).sum(axis=1)).all()


def test_linked_rows_are_exchanged_without_unlinked_ones(spark):
    """Every text occurs twice and nowhere is a document without links."""
    rows = [(i, f"pair {i * 7919 % 160}") for i in range(320)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 4, slice_rows=1000).collect()
    assert set(Counter(r.shard for r in got).values()) == {80}
    homes, texts = defaultdict(set), dict(rows)
    for r in got:
        homes[texts[r.doc_id]].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 8


def test_granted_circulation_is_the_largest():
    """Ten rows each way between two shards are granted, however many others ask; a cycle is found without spare rows."""
    asked = np.array([[0, 10, 0], [10, 0, 0], [0, 5, 0]])
    assert sharding.granted(asked, np.zeros(3, np.int64))[0].tolist() == [[0, 10, 0], [10, 0, 0], [0, 0, 0]]
    options = np.array([[0, 0, 4, 1], [3, 0, 0, 0], [0, 9, 0, 0], [0, 0, 0, 0]])
    moves = sharding.exchanged(options, np.zeros(4, np.int64))
    assert moves.tolist() == [[0, 0, 3, 0], [3, 0, 0, 0], [0, 3, 0, 0], [0, 0, 0, 0]]
    assert not sharding.exchanged(np.triu(np.ones((4, 4), np.int64), 1), np.zeros(4, np.int64)).any()


# --- 10, fingerprints --------------------------------------------------------


def test_fingerprints(docs, odd, nothing, rows):
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs, partitions=3).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    gaps = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (brute.jaccard(text, edited) == 1) <= (got[i].near_edited == 1)
        gaps += [got[i].near_edited - brute.jaccard(text, edited), got[i].near_next - brute.jaccard(text, following)]
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.12
    by_text = defaultdict(set)
    for i, text in ordered:
        by_text[text].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert fingerprint.fingerprints(odd, partitions=2).count() == 17
    assert all(r.near_next is None for r in fingerprint.fingerprints(odd, partitions=2).collect() if r.doc_id is None)
    assert fingerprint.fingerprints(nothing, partitions=2).count() == 0


def test_similarities_tell_near_copies_from_others(docs, rows):
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs, partitions=3).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    gaps = [got[i].near_next - brute.jaccard(t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)]
    for k, (i, t) in enumerate(ordered):
        n = len(t) // 4
        gaps.append(got[i].near_edited - brute.jaccard(t, t[: len(t) - n] + ordered[(k + 1) % len(ordered)][1][:n]))
    assert np.std(gaps) < 0.05 and max(map(abs, gaps)) < 0.18


def test_signature_equals_plain_sampling(spark):
    text = "a b b c c c longer words here a"
    frame = spark.createDataFrame([(1, text, "c c")], "doc_id long, text string, edited string")
    chunks = sorted(fingerprint._signatures(frame, ["doc_id"], 8).collect(), key=lambda r: r.chunk)
    got = [x for r in chunks for x in r.s0]
    assert len(chunks) == 2 and len(got) == 8
    signed = lambda h: h - 2**64 if h >= 2**63 else h

    def long_int(term, sample):
        """Spark's xxhash64 of (bigint, int): each value is hashed with the hash before as seed."""
        first = xxhash.xxh64(np.int64(term).tobytes(), seed=42).intdigest()
        return signed(xxhash.xxh64(np.int32(sample).tobytes(), seed=first).intdigest())

    for sample in range(8):
        least = math.inf
        for word, count in brute.words_of(text).items():
            term = signed(xxhash.xxh64(word.encode(), seed=42).intdigest())
            one, two = long_int(term, 2 * sample), long_int(term, 2 * sample + 1)
            u = lambda seed, field: ((seed >> 21 * field & (1 << 21) - 1) + 0.5) / (1 << 21)
            r = -math.log(u(one, 0) * u(one, 1))
            t = math.floor(math.log(count) / r + u(one, 2))
            least = min(least, math.log(-math.log(u(two, 0) * u(two, 1))) - r * (t - u(one, 2) + 1))
        assert math.isclose(least, got[sample], rel_tol=1e-9)


def test_signature_without_far_draws_is_the_same(spark):
    """Words that are passed over without logarithms change no entry, nor does counting common words once."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(2000)] + ["é", "x" * 50]
    rows = []
    for n in (0, 1, 2, 30, 3000):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for _ in range(n))
        kept = len(text) - len(text) // 4
        rows.append((n, text, text[:kept] + "".join(rng.choice(vocab) + " " for _ in range(n // 4)), kept))
    rows += [(-1, "a " * 500 + "b", None, 0), (-2, None, None, 0), (-3, "\n\n", "one", 0), (-4, "abc", "abd", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, edited string, kept long")
    got, plain = (
        {(r.doc_id, r.chunk): (r.s0, r.s1) for r in fingerprint._signatures(f, ["doc_id"], 64, reach).collect()}
        for f, reach in ((frame, fingerprint.REACH), (frame.drop("kept"), 1e12))
    )
    assert len(got) == 16 * len(rows) and got == plain
    assert {i for (i, _), (s0, _) in got.items() if None in s0} == {0, -2, -3}


def test_far_draws_are_told_without_logarithms(spark):
    """No word below the limit is passed over, and few others are computed."""
    rng, rows = random.Random(9), []
    for _ in range(20_000):
        q, b, p = (rng.random() * rng.random(), rng.random(), rng.random() * rng.random())
        weight, far = float(rng.choice([1, 1, 1, 2, 7])), 10 ** rng.uniform(-4, 1)
        r, w = -math.log(q), math.log(weight)
        rows.append((q, b, p, weight, far, -math.log(p) * math.exp(-r * (math.floor(w / r + b) - b + 1)) < far))
    frame = spark.createDataFrame(rows, "q double, b double, p double, weight double, far double, below boolean")
    asked = [(r.below, r.asked) for r in frame.withColumn("asked", fingerprint._within("far")).collect()]
    below, computed = sum(b for b, _ in asked), sum(a for _, a in asked)
    assert all(a for b, a in asked if b) and below <= computed < 2 * below


def test_successors_of_hashed_and_close_ids(spark):
    """The first id after each block, whatever lies between the ids."""
    rng = random.Random(5)
    for ids in ([rng.randrange(-(2**62), 2**62) for _ in range(300)], list(range(-70, 400)), [5], []):
        frame = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
        found = {r.block: r.next_id for r in fingerprint.block_successors(frame).collect()}
        ordered = sorted(ids)
        want = {b: next((i for i in ordered if i >> fingerprint.BLOCK_BITS > b), ordered[0]) for b in {i >> fingerprint.BLOCK_BITS for i in ids}}
        assert found == want


def test_fingerprint_of_a_long_text(spark):
    """A text of several million characters beside short ones."""
    rng = random.Random(6)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(20_000))
    docs = [(1, long), (2, long + " x"), (3, "a b")]
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(docs, "doc_id long, text string"), partitions=2).collect()}
    assert got[1].n_chars == len(long) and got[1].near_next > 0.99 and got[2].near_next < 0.1


# --- 5, WARC -----------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>é &amp; x</p>" * 20, "WARC/1.1\r\n\r\n" * 12
    rows = [(5, "http://a/\r\nX: y", big), (3, "http://b", big), (9, None, big), (4, "", None), (6, "u", "short"), (7, "u", "short"), (8, "v", other), (8, "v", other), (None, "w", big), (10, "w", other)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark, pages):
    folder = f"{shared_dir(spark)}/warc-test"
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages, folder).collect())
    big = len(("<p>é &amp; x</p>" * 20).encode())
    assert got == Counter({
        (3, big, "response", None): 1, (5, big, "revisit", 3): 1, (9, big, "revisit", 3): 1, (None, big, "response", None): 1,
        (4, 0, "response", None): 1, (6, 5, "response", None): 1, (7, 5, "response", None): 1,
        (8, 144, "response", None): 2, (10, 144, "revisit", 8): 1,
    })
    back = warc.read(spark, folder)
    assert {r.payload for r in back.where("record_type = 'response'").collect()} == {r.html or "" for r in pages.collect()}
    plan = back.where("record_type = 'revisit' and page_id = 5")
    assert [(r.target_uri, r.refers_to) for r in plan.collect()] == [("http://a/X:y", "<urn:page:3>")]
    digest = {r.page_id: r.payload_digest for r in warc.read(spark, folder, payload=False).collect()}
    assert digest[6] == hashlib.sha256(b"short").hexdigest()


def test_warc_skips_what_is_not_wanted(spark, pages):
    folder = f"{shared_dir(spark)}/warc-skip"
    warc.write(pages.coalesce(1), folder)
    reader = warc._Reader({"files": "[]", "payload": "true"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("page_id",), 1)])) == [GreaterThan(("page_id",), 1)]
    path = warc.files(spark, folder)[0]
    rows = list(reader.read(warc._File(path)))
    assert {r[0] for r in rows} == {"revisit"} and len(rows) == 3
    broken = path.removeprefix("file:") + ".cut"
    whole = gzip.open(path.removeprefix("file:")).read()
    open(broken, "wb").write(whole[:-7])
    with pytest.raises(ValueError):
        list(warc._Reader({"files": "[]"}).read(warc._File(broken)))


def test_warc_of_nothing(spark, pages):
    assert warc.round_trip(pages.where("false"), f"{shared_dir(spark)}/warc-none").count() == 0


# --- 3, HTML -----------------------------------------------------------------

LONG = "This paragraph is long enough to be taken for the text of an article by its ratio. " * 3


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain &lt;text&gt;", "plain <text>"),
        (f"<nav><a href=/>Home</a></nav><article><h1>T &amp; T</h1><p><b>{LONG}<br><p>Hi.</article><footer>&copy; me</footer>", f"T & T\n{LONG.strip()}\nHi."),
        (f"<div id=wrap><div class='top-menu'>Menu</div><div><p>{LONG}</p><p>a <i>b</i>\n c</p></div><div class=comments><p>{LONG}</p></div></div>", f"{LONG.strip()}\na b c"),
        (f"<main><header><h1>Head</h1></header><p>{LONG}</p><form>Mail</form><aside>{LONG}</aside><script>x='</p>'</script></main>", f"Head\n{LONG.strip()}"),
        ("<![if x]>hello<![endif]>", "hello"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<div class='page no-sidebar'><article><p>{LONG}</p></article></div>", LONG.strip()),
        (f"<article><h2 id=social-factors>Factors</h2><p class='share-price'>{LONG}</p></article>", f"Factors\n{LONG.strip()}"),
        # Whole names, but around the article, or around most of the text.
        (f"<div class=sidebar><article><p>{LONG}</p></article></div><footer>me</footer>", LONG.strip()),
        (f"<form><div><p>{LONG}</p><p>{LONG}</p></div></form><div class=ad>Buy</div>", f"{LONG.strip()}\n{LONG.strip()}"),
        # Comments that are longer than the article go.
        (f"<article><p>{LONG}</p></article><div id=comments><p>{LONG}{LONG}</p></div>", LONG.strip()),
        # The first block beside a container with most of the text.
        (f"<div><h1>One</h1><p>{LONG}</p><div>{f'<p>{LONG}</p>' * 20}</div></div>", "\n".join(["One", *[LONG.strip()] * 21])),
        # Two articles beside each other.
        (f"<article><p>{LONG}</p></article><article><p>{LONG}</p><p>{LONG}</p></article>", "\n".join([LONG.strip()] * 3)),
        # Hyphenated names: comments, menus and notices go, whatever their length.
        (f"<article><p>{LONG}</p></article><div class=comments-area><ol class=comment-list><li>{LONG}{LONG}</ol></div>", LONG.strip()),
        (f"<div><p>{LONG}</p><ul class=main-nav><li><a href=/>One</a><li><a href=/>Two</a></ul><div class=newsletter-signup>Sign up</div></div>", LONG.strip()),
        (f"<div><div class=cookie-banner>{LONG}</div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG.strip()}\n{LONG.strip()}"),
        # A formula in a sentence, and a paragraph that is only named like something else.
        (f"<article><p>{LONG}x <math><mi>y</mi><annotation>tex</annotation></math> z</p></article>", f"{LONG}x y z"),
        (f"<article><p class=share>{LONG}</p><p class=share><a href=/>Tweet</a></p><p>{LONG}</p></article>", f"{LONG.strip()}\n{LONG.strip()}"),
        # A comment that is never closed.
        (f"<article><p>{LONG}</p></article><!-- <p>gone", LONG.strip()),
        (f"<article><p>{LONG}</p></article><div class=has-comments><script>'<!--'</script></div>", LONG.strip()),
        # An inner article with 55% of the outer text is not all.
        (f"<main><p>{LONG}</p><article><p>{LONG}</p><p>{LONG[:40]}</p></article></main>", f"{LONG.strip()}\n{LONG.strip()}\n{LONG[:40].strip()}"),
    ],
)
def test_nothing_else_is_dropped(html, text):
    assert html_text.main_text(html) == text


def test_main_text_of_the_pages(spark, sf_dir):
    import html as entities
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        article = re.search("<article>(.*?)(</article>|$)", page.html, re.DOTALL)[1]
        blocks = (entities.unescape(re.sub("<[^>]*>", " ", b)) for b in re.split("</?(?:p|h1)>", article))
        want = "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)
    assert html_text.extract(pages.where("false")).count() == 0


def test_smoothing_and_threshold():
    assert np.allclose(html_text.smoothed(np.full(9, 4.0)), 4)
    assert html_text.smoothed(np.array([0, 0, 9.0, 0, 0])).argmax() == 2
    assert 2 < html_text.threshold(np.array([1.0, 1.5, 2, 40, 42, 50])) < 40


# --- 1, toxicity -------------------------------------------------------------


def test_lists_of_a_column_are_no_python_numbers():
    numbers = [list(range(i, i + 1000)) for i in range(300)]
    column = pa.chunked_array([pa.array(part, pa.list_(pa.int32())) for part in (numbers[:100], numbers[100:] + [[]])])
    tracemalloc.start()
    lists = toxicity.lists_of(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [p.tolist() for p in lists] == [*numbers, []]
    # The numbers themselves take 1.2 MB.
    assert peak < 600_000



def test_chain_learns_from_earlier_categories(spark):
    rng = np.random.default_rng(5)
    vocab = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(500):
        rude, shout = rng.random() < 0.4, rng.random() < 0.4
        words = list(rng.choice(vocab, 40))
        if rude:
            words += list(rng.choice(["vilexa", "vilexb", "vilexc"], 2))
        if shout:
            words.append("###")
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - int(shout), int(rude or shout)))
    docs = spark.createDataFrame([*rows, (9001, None), (9002, ""), (None, "vilexq vilexz ###")], "doc_id long, text string")
    table = spark.createDataFrame([r for r in labels if r[0] < 350] + [(None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxic(docs, docs, table, per_class=150).collect()}
    held = [r for r in labels if r[0] >= 350]
    assert np.mean([got[i].toxic == bool(t) for i, _, t in held]) > 0.95
    assert np.mean([(got[i].p_low_quality > 0.5) == (q == 0) for i, q, _ in held]) > 0.95
    assert len(got) == 503 and not got[9002].toxic and got[9001].p_toxic == got[9002].p_toxic
    none = toxicity.toxic(docs, docs, table.where("false")).collect()
    assert len(none) == 503 and not any(r.toxic for r in none)
    assert toxicity.toxic(docs.where("false"), docs, table, per_class=50).count() == 0


def test_threshold_is_for_the_mix_of_all_labels(spark):
    """8% toxic, sampled half and half: a word that a quarter of the clean texts have is not enough to flag."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1500):
        bad = i % 12 == 0
        words = list(rng.choice([f"word{n}" for n in range(200)], 30))
        words += ["mildly"] * (rng.random() < (0.9 if bad else 0.25)) + ["harshly"] * (rng.random() < (0.6 if bad else 0.005))
        rows.append((i, " ".join(words), 1, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.toxic(table, table, table, per_class=125).collect()}
    assert np.mean([got[i] for i, _, _, bad in rows if not bad]) < 0.05
    assert np.mean([got[i] for i, _, _, bad in rows if bad]) > 0.4
    p, y, n = np.array([0.9, 0.8, 0.7, 0.6, 0.1]), np.array([1.0, 0, 1, 0, 0]), np.array([1, 8, 1, 8, 8])
    assert toxicity.best_threshold(p, y, n) == toxicity.best_threshold(np.repeat(p, n), np.repeat(y, n)) != toxicity.best_threshold(p, y)


def test_out_of_fold_probabilities_do_not_leak():
    """Labels that features cannot explain give the later model no false trust in the earlier one."""
    rng = np.random.default_rng(2)
    places = [np.unique(rng.integers(0, 4000, 40)) for _ in range(300)]
    labels = np.column_stack((rng.integers(0, 2, 300), rng.integers(0, 2, 300)))
    models = toxicity.fit_chain(places, labels, np.arange(300) % 3)
    assert abs(models[1]["dense"][0]) < 4


# --- 9, sampled segmentations ------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return lattice.Model(vocabulary("piece_bpe_32k.model"))


def every_segmentation(model, text):
    """Ids and probability of all segmentations of a short text, by plain recursion over the vocabulary."""
    spelled = lattice.spaced(text)
    own = {piece: (i,) for i, piece in enumerate(model.spelling) if piece and i not in set(model.byte_ids.tolist())}
    weights = {}

    def follow(at, ids, log):
        if at == len(spelled):
            weights[ids] = math.exp(log)
            return
        width = len(spelled[at:].decode()[0].encode())
        for end in range(at + 1, len(spelled) + 1):
            if (found := own.get(spelled[at:end])) is not None:
                follow(end, ids + found, log + model.logs[found[0]])
        if spelled[at : at + width] not in own:
            follow(at + width, ids + tuple(int(model.byte_ids[b]) for b in spelled[at : at + width]), log + model.byte_log * width)

    follow(0, (), 0.0)
    whole = sum(weights.values())
    return {ids: w / whole for ids, w in weights.items()}


TINY = ["the", "a an", "on.”", "x  y", "(;\r\n", "né", "天 é!", "1 23", "\t\tif", "ab▁c"]


@pytest.mark.parametrize("text", TINY)
def test_all_segmentations_come_with_their_probability(model, text):
    want = every_segmentation(model, text)
    got = lattice.top_k(model, text, len(want) + 5, 11)
    assert {tuple(ids) for ids, _, _ in got} == set(want) and len(got) == len(want)
    for ids, log, inclusion in got:
        assert math.isclose(math.exp(log), want[tuple(ids)], rel_tol=1e-9) and inclusion == 1.0


def test_pairs_follow_sampling_without_replacement(model):
    """The first two samples are a and b with probability p(a) p(b) / (1 - p(a))."""
    even = lattice.Model(vocabulary("piece_bpe_32k.model"))
    even.logs = np.where(even.logs < 0, -1.0, 0.0)
    want = every_segmentation(even, "the on")
    n, pairs, weighed = 20_000, Counter(), Counter()
    for block in range(0, n, 2000):
        for one, two in lattice.sample_texts(even, [lattice.spaced("the on")] * 2000, list(range(block, block + 2000)), 2):
            pairs[tuple(one[0].tolist()), tuple(two[0].tolist())] += 1
            for ids, _, inclusion in (one, two):
                weighed[tuple(ids.tolist())] += 1 / inclusion
    assert all(a != b for a, b in pairs)
    chances = {(a, b): p * q / (1 - p) for a, p in want.items() for b, q in want.items() if a != b}
    assert math.isclose(sum(chances.values()), 1, rel_tol=1e-9)
    gaps = [(pairs[pair] - n * c) ** 2 / (n * c * (1 - c)) for pair, c in chances.items() if n * c > 20]
    assert len(gaps) > 20 and max(gaps) < 20 and np.mean(gaps) < 1.6
    # Horvitz-Thompson counts over inclusion scores are unbiased: one for every segmentation.
    for ids, p in want.items():
        if p > 0.05:
            assert abs(weighed[ids] / n - 1) < 0.1


def test_pieces_of_spaces_and_mixed_marks_are_sampled(model):
    import sentencepiece

    plain = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    for text in ("if x:\n    return 1", "He said “no.” Then", "a();\r\nb", "\t\tx = {}\r"):
        ids = [[x for x in s[0]] for seed in range(40) for s in lattice.top_k(model, text, 3, seed)]
        assert plain.encode(text) in ids
        assert all(plain.decode(i) == text for i in ids)


def test_no_piece_crosses_units(model):
    for text in ["if x:\n    return 1", "“a.”  ;\r\n (b)", "über 天地", *TINY]:
        raw = np.frombuffer(lattice.spaced(text), np.uint8)
        starts = set(model.starts(raw).tolist())
        for i in range(raw.size):
            for piece in (raw[i:j].tobytes() for j in range(i + 2, raw.size + 1)):
                if piece in model.spelling:
                    assert not starts & set(range(i + 1, i + len(piece)))


def test_very_long_words_and_texts(model):
    # No piece joins the four characters: one segmentation.
    for text, n in (("x" * 20_000, 2), ("天地玄黄" * 5000, 1), (" " * 5000, 2), ("word " * 60_000, 2)):
        samples = lattice.top_k(model, text, 2, 3)
        assert len({tuple(ids) for ids, _, _ in samples}) == len(samples) == n
        assert all(model.decode(ids) == text and math.isfinite(log) for ids, log, _ in samples)


def test_segmentations_are_distinct_and_decode(model, rows):
    for i, text in rows:
        samples = lattice.top_k(model, text, 3, i)
        assert len({tuple(s[0]) for s in samples}) == len(samples) == (3 if (text or "").strip() else len(samples))
        assert all(model.decode(ids) == (text or "") for ids, _, _ in samples)
        assert all(0 <= q <= 1 for _, _, q in samples)


def test_samples_depend_on_the_row_alone(model, rows):
    """Other texts of a block do not change a text's samples but for rounding."""
    together = lattice.sample_texts(model, [lattice.spaced(t) for _, t in rows], [i for i, _ in rows], 3)
    for (i, text), block in zip(rows, together, strict=True):
        alone = lattice.top_k(model, text, 3, i)
        assert [ids.tolist() for ids, _, _ in block] == [ids for ids, _, _ in alone]
        assert np.allclose([log for _, log, _ in block], [log for _, log, _ in alone])


def test_sampled_rows(spark, odd, nothing):
    path = vocabulary("piece_bpe_32k.model")
    got = lattice.sampled(odd, path, k=2).collect()
    assert all(r.decoded for r in got) and len({r.doc_id for r in got}) == 13
    assert lattice.sampled(nothing, path).count() == 0
