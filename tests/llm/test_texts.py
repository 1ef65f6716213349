"""Text operators against plain statements of what they compute."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orderlens.llm import maxent, ngram_join, packing, quality, queries, segment, substring
from orderlens.llm.words import U, mix, window_hashes, words_of


def key(row):
    return (row[0] is not None, row[0] or 0, *map(str, row[1:]))


def plain_words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def test_words_are_ascii_space_separated(docs):
    import pyarrow as pa

    texts = [r.text for r in docs.collect()]
    for chunk in (1, 100, 1 << 20):
        got = [words.data[s:e].tobytes() for words in words_of(pa.array(texts, pa.string()), False, chunk)
               for s, e in zip(words.starts, words.ends)]
        assert got == [w for t in texts for w in plain_words(t)]


def thue_morse(bits):
    """Two different words of 2**bits bytes that every polynomial with an odd
    base modulo 2**64 takes for one (from 1,024 bytes on)."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << bits))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_with_patterns_have_hashes_of_their_own(spark):
    import pyarrow as pa

    long = [w for bits in (10, 11, 12) for w in thue_morse(bits)]
    affixes = ["a" * n for n in range(1, 80)] + ["ab" * n for n in range(1, 40)] + [w[:n] for w in long for n in (1023, 1022)]
    affixes += [w[n:] for w in long for n in (1, 2)] + ["\x00" * n for n in range(1, 20)] + [f"{k}" for k in range(2000)]
    texts = [*long, *affixes]
    found = [int(h) for words in words_of(pa.array(texts, pa.string()), False) for h in words.hashes]
    assert len(set(found)) == len(set(texts))
    # the same in the operators: sets, windows and token counts tell the words apart
    one, other = long[2], long[3]
    rows = [(1, " ".join([one] * 4)), (2, " ".join([other] * 4)), (3, " ".join([one] * 4)),
            (4, " ".join(f"{one}{k}" for k in range(25))), (5, " ".join(f"{other}{k}" for k in range(25)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.join_components(df).collect())) == sorted(brute_join(rows))
    got = substring.cut_repeats(df).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_cut(rows))
    scored = maxent.score_texts(spark.createDataFrame([(1, one), (2, f"{one} {other}")], "doc_id long, text string"), F.lit(False)).collect()
    assert {r.n_known for r in scored} == {2, 3} and {r.train_tokens for r in scored} == {5}
    assert scored[0].base_score != scored[1].base_score


def brute_join(rows):
    """(doc_id, n_shingles, component_id) of each row, all pairs compared."""
    sets = []
    for _, text in rows:
        w = plain_words(text, lower=True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None \
                        and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    root = {c: min(r[0] for r, d in zip(rows, comp) if d == c and r[0] is not None) for c, r0 in zip(comp, rows) if r0[0] is not None}
    return [(r[0], len(s), root[c] if r[0] is not None else None) for r, s, c in zip(rows, sets, comp)]


def test_ngram_join_equals_brute_force(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in ngram_join.join_components(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_join(rows), key=key)
    assert ngram_join.join_components(no_docs).collect() == []


def test_ngram_join_of_random_near_copies(spark):
    rng = np.random.default_rng(3)
    base = [[f"v{rng.integers(60)}" for _ in range(rng.integers(3, 60))] for _ in range(12)]
    rows = []
    for i in range(160):
        w = list(base[i % 12])
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(len(w))] = f"v{rng.integers(60)}"
        rows.append((i, " ".join(w)))
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute_join(rows))


def test_links_in_blocks_equal_one_block():
    rng = np.random.default_rng(5)
    core = rng.integers(0, 1 << 62, 80, dtype=np.int64).astype(U)
    sets = [np.unique(np.concatenate([core[rng.random(80) < 0.93], rng.integers(0, 1 << 62, 6).astype(U)])) for _ in range(40)]
    kept = [np.array([7], np.int64)] * 40

    def parts(pairs):
        root = list(range(40))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    one = parts(ngram_join.links_in(7, kept, sets, 0))
    halves = [(i, j) for i, j in ngram_join.links_in(7, kept[:20], sets[:20], 0)]
    halves += [(i + 20, j + 20) for i, j in ngram_join.links_in(7, kept[20:], sets[20:], 0)]
    halves += ngram_join.links_in(7, kept, sets, 20)
    brute = [(i, j) for i in range(40) for j in range(i)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert one == parts(halves) == parts(brute)


def test_prefix_overlap_bound():
    t = ngram_join.SHARED
    tail = sum(math.comb(64, i) * 0.8**i * 0.2 ** (64 - i) for i in range(t))
    assert 20 < t < 40 and tail <= 1e-12


def brute_cut(rows, window=20):
    first = {}
    for place, (doc, text) in enumerate(rows):
        w = plain_words(text)
        for s in range(len(w) - window + 1):
            if doc is not None:
                k = tuple(w[s : s + window])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w, seen = plain_words(text), set()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if k in seen or (doc is not None and first[k] < doc):
                gone[s : s + window] = [True] * window
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_equals_brute_force(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    cut = substring.cut_repeats(docs)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cut.collect()]
    assert sorted(got, key=key) == sorted(brute_cut(rows), key=key)
    assert {r.kept_text for r in cut.where("doc_id = 8").collect()} == {"One TWO"}
    assert substring.cut_repeats(no_docs).collect() == []


def test_substring_of_random_overlaps(spark):
    rng = np.random.default_rng(9)
    passages = [[f"t{rng.integers(8)}" for _ in range(rng.integers(20, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = [f"u{rng.integers(30)}" for _ in range(rng.integers(0, 30))]
        p = passages[rng.integers(6)]
        lo = rng.integers(0, 15)
        rows.append((i, " ".join(w + p[lo:] + w[:5] + passages[0][:25])))
    got = substring.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_cut(rows))


def test_substring_cuts_the_first_of_two_copies(spark):
    """A passage once in a document and twice in a later one, between other words each time."""
    rows = []
    for i in range(60):
        p = [f"p{i}_{j}" for j in range(20 + i % 5)]
        a, b, c, d = ([f"{k}{i}_{j}" for j in range(30)] for k in "abcd")
        rows += [(2 * i, " ".join(a + p + b)), (2 * i + 1, " ".join(c + p + d + p + a[:9] + b[:9]))]
    got = substring.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_cut(rows))


def test_substring_of_different_texts_with_one_id(spark):
    p, q = ([f"{k}{j}" for j in range(30)] for k in "pq")
    a, b, c = ([f"{k}{j}" for j in range(200)] for k in "abc")
    rows = [(1, " ".join(p + q)), (2, " ".join(a + p + b + q[:25])), (2, " ".join(q + c[:10])), (2, " ".join(q + c[:10])),
            (2, " ".join(c[:25])), (2, None), (3, " ".join(b[:60] + p + c[:30])), (3, " ".join(a[5:40] + q[2:]))]
    got = substring.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(key, ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got))) == sorted(map(key, brute_cut(rows)))


def test_anchor_is_leftmost_smallest():
    g = np.random.default_rng(1).integers(0, 9, 200).astype(U)
    assert substring.anchors(g, 16).tolist() == [i + int(np.argmin(g[i : i + 16])) for i in range(185)]


def test_packing_round_trip(docs, no_docs):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    added = [(20, "x <|endoftext|> y"), (21, "<|endoftext|>"), (22, "a<|endoftext|><|endoftext|> b" * 300), (23, "<|endoftext|")]
    docs = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(added, "doc_id long, text string"))
    packed = packing.pack(packing.token_pieces(docs, packing.public_vocabulary())).collect()
    want = Counter()
    for r in docs.collect():
        ids = bpe.encode(r.text or "", add_special_tokens=False).ids + [0]
        lo, k = 0, 0
        while lo < len(ids):
            n = (len(ids) - 1) % 2048 + 1 if k == 0 else 2048
            want[r.doc_id, k, lo, n, zlib.crc32(np.array(ids[lo : lo + n], "<u4").tobytes())] += 1
            lo, k = lo + n, k + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    assert packing.pack(packing.token_pieces(no_docs, packing.public_vocabulary())).collect() == []


def test_bin_completion_meets_the_bound():
    rng = np.random.default_rng(2)
    for _ in range(20):
        h = Counter(int(x) for x in rng.integers(1, 101, 300))
        found = packing.plan(h, 100)
        used = Counter()
        for times, fill in found:
            assert sum(x * n for x, n in fill.items()) <= 100
            used.update({x: n * times for x, n in fill.items()})
        assert used == h
        assert sum(t for t, _ in found) <= packing.lower_bound(h, 100) + 2
    # 60 + 40 and 50 + 50 beat filling the longest first with what fits best alone
    assert sum(t for t, _ in packing.plan({60: 2, 40: 2, 50: 2, 30: 0}, 100)) == 3


def fewest_sequences(lengths, size):
    """By dynamic programming over sets of pieces: (sequences, tokens in the last)."""
    best = {0: (1, 0)}
    for s in range(1, 1 << len(lengths)):
        best[s] = min((k, used + x) if used + x <= size else (k + 1, x)
                      for i, x in enumerate(lengths) if s >> i & 1 for k, used in [best[s ^ 1 << i]])
    return best[(1 << len(lengths)) - 1][0]


def test_packing_branches_over_fillings():
    h = Counter([22, 21, 19, 17, 14, 13, 12, 12, 11, 8])
    assert sum(t for t, _ in packing.plan_patterns(h, 50)) == sum(t for t, _ in packing.best_fit_decreasing(h, 50)) == 4
    assert sum(t for t, _ in packing.plan(h, 50)) == 3
    rng = np.random.default_rng(4)
    for size in (20, 50, 100):
        for _ in range(40):
            lengths = [int(x) for x in rng.integers(size // 10, size // 2, 10)]
            found = packing.plan(Counter(lengths), size)
            assert all(sum(x * n for x, n in fill.items()) <= size for _, fill in found)
            assert sorted(x for t, fill in found for x, n in fill.items() for _ in range(n * t)) == sorted(lengths)
            assert sum(t for t, _ in found) == fewest_sequences(lengths, size)


def test_classifier_learns_and_scores_all(spark, docs, no_docs):
    good = [(i, f"plain words number {i} in a quiet sentence {i * 7}.", 1) for i in range(150)]
    bad = [(1000 + i, f"LOUD{i}!! WORDS!! {i}!! NOW!!", 0) for i in range(150)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    odd = spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    w = quality.fit(train, train.select("doc_id", "quality").unionByName(odd), "quality")
    new = spark.createDataFrame([(1, "some quiet words in a sentence."), (2, "BUY!! THIS!! TODAY!!")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(new, w).collect()}
    assert got[1] > 0.5 > got[2]
    scored = quality.score(docs, w).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.score(no_docs, w).collect() == []
    assert not quality.fit(no_docs, train.select("doc_id", "quality").limit(0), "quality").any()


def test_classifier_bound_holds_for_one_id_with_many_texts(spark):
    rows = [(1, f"text number {k} of one id") for k in range(300)] + [(2, "another")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1)], "doc_id long, quality int")
    assert quality.sample_rows(df, labels, "quality", max_rows=20).count() == 20
    assert quality.sample_rows(df, labels, "quality", max_rows=2000).count() == 601


def test_score_can_go_beside_a_column_of_its_name(spark, docs):
    w = np.zeros((1 << quality.BITS) + 1)
    got = quality.score(docs.withColumn("score", F.lit("mine")), w, keep=("doc_id", "score"), name="score_")
    assert got.columns == ["doc_id", "score", "score_"] and {(r.score, r.score_) for r in got.collect()} == {("mine", 0.5)}


def test_ftrl_step_by_hand():
    """Two steps on one feature, worked out from the update rule."""
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.05
    one = (np.array([0]), np.array([1.0], np.float32), 1)
    z = g = 0.5 - 1.0  # weight 0: probability a half
    n = g * g
    z -= (math.sqrt(n) - 0.0) / alpha * 0.0
    w = (math.copysign(l1, z) - z) / ((beta + math.sqrt(n)) / alpha + l2)
    assert quality.train_ftrl([one], bits=1, epochs=1)[0] == pytest.approx(w)
    g2 = 1 / (1 + math.exp(-w)) - 1.0
    z += g2 - (math.sqrt(n + g2 * g2) - math.sqrt(n)) / alpha * w
    n += g2 * g2
    w2 = (math.copysign(l1, z) - z) / ((beta + math.sqrt(n)) / alpha + l2)
    assert quality.train_ftrl([one, one], bits=1, epochs=1)[0] == pytest.approx(w2)


def test_maxent_counts_and_probabilities(docs, no_docs):
    held = quality.in_fold(F.col("doc_id"), 7, 2)
    got = maxent.score_texts(docs, held).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not fold(d) for w in [*plain_words(t, True), "end"])
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        w = [*plain_words(t, True), "end"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want.append((d, fold(d), len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=key) == sorted(want, key=key)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert maxent.score_texts(no_docs, held).collect() == []


def test_maxent_class_factor_sums_to_one():
    rng = np.random.default_rng(0)
    w, b = rng.normal(size=(maxent.FEATURES, maxent.CLASSES)), rng.normal(size=maxent.CLASSES)
    each, total = maxent.class_weights(w, b, rng.integers(0, maxent.FEATURES, (50, 3)))
    assert np.allclose((each / total[:, None]).sum(axis=1), 1)


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_segmentations_decode_and_differ(docs, no_docs):
    got = segment.sample_segmentations(docs, MODEL, k=3, with_ids=True).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    seen = set()
    for r in got:
        assert segment.decode(list(r.ids), MODEL) in texts[r.doc_id]
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_pieces
        assert 0 <= r.inclusion <= 1 and math.isfinite(r.log_inclusion) and r.log_prob <= 1e-9
        assert r.log_inclusion <= 0 and abs(math.exp(r.log_inclusion) - r.inclusion) < 1e-9
        if r.doc_id not in (None, 2):  # these ids are repeated
            assert (r.doc_id, r.ids_crc32) not in seen
            seen.add((r.doc_id, r.ids_crc32))
    again = segment.sample_segmentations(docs.repartition(5), MODEL, k=3).collect()
    assert Counter((r.doc_id, r.sample, r.ids_crc32) for r in got) == Counter((r.doc_id, r.sample, r.ids_crc32) for r in again)
    assert segment.sample_segmentations(no_docs, MODEL).collect() == []


def test_segmentations_decode_as_rows(docs, no_docs):
    got = segment.sample_segmentations(docs, MODEL, k=2, with_ids=True)
    back = segment.decode_ids(got.withColumn("text", F.lit("clash")), MODEL).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    assert len(back) > 20 and all(r.text in texts[r.doc_id] for r in back)
    odd = docs.sparkSession.createDataFrame([(1, None), (2, []), (3, [5, None]), (4, [10**6]), (5, [-1])], "k int, ids array<int>")
    assert {r.k: r.text for r in segment.decode_ids(odd, MODEL).collect()} == {1: None, 2: "", 3: None, 4: None, 5: None}
    assert segment.decode_ids(odd.where("1 = 0"), MODEL).collect() == []


def test_decoding_equals_sentencepiece(spark):
    sp, rng = segment.processor(MODEL), random.Random(4)
    n = sp.get_piece_size()
    some = [i for i in range(n) if sp.is_byte(i)] * 3 + [i for i in range(n) if sp.id_to_piece(i).startswith("\u2581")][:400] + list(range(600))
    rows = [(k, [rng.choice(some) for _ in range(rng.randint(0, 5))]) for k in range(3000)]
    rows += [(3000 + i, [i, i]) for i in range(600)]
    got = {r.k: r.text for r in segment.decode_ids(spark.createDataFrame(rows, "k int, ids array<int>"), MODEL).collect()}
    assert got == {k: sp.decode(ids) for k, ids in rows}


def test_segment_query_decodes_every_segmentation(spark, tmp_dir):
    texts = ["", None, " ", "a  b\nc", "\u2581x y", "caf\u00e9 \U0001f600 na\u00efve", "the cat sat on the mat " * 40, "\t\x00odd"]
    rows = [(i % 6, t) for i, t in enumerate(texts)] + [(None, "no key")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op5_segment(spark, tmp_dir).collect()
    assert len(got) >= len(rows) and all(r.restored for r in got)
    want = Counter((k, hashlib.sha256((t or "").replace("\u2581", " ").encode()).hexdigest()) for k, t in rows)
    assert Counter((r.doc_id, r.decoded_sha256) for r in got if r.sample == 0) == want


def test_segmentations_of_rare_words_avoid_the_shunned():
    """A word's second segmentation differs from the first, drawn by the masses left."""
    vocab = segment.vocabulary(MODEL)
    units, bounds, _ = segment.units_of(["cat"], vocab)
    lattice = segment.Lattice(units, bounds, vocab)
    n, ids, logs = lattice.sample(np.zeros(1, np.int64), np.array([7], U))
    shunned = [(ids.tolist(), float(logs[0]))]
    others = Counter()
    for seed in range(4000):
        path, log_prob = lattice.other(0, shunned, seed * 1000)
        assert path != shunned[0][0] and vocab.weight[path].sum() - lattice.after[0] == pytest.approx(log_prob)
        others[tuple(path)] += 1
    left = 1 - math.exp(logs[0])
    for path, count in others.most_common(3):
        assert abs(count / 4000 - math.exp(vocab.weight[list(path)].sum() - lattice.after[0]) / left) < 0.03


def test_segmentations_follow_the_lattice():
    vocab = segment.vocabulary(MODEL)
    units, bounds, _ = segment.units_of(["the cat"], vocab)
    lattice = segment.Lattice(units, bounds, vocab)

    def paths(at, end):
        if at == end:
            return [((), 0.0)]
        return [((int(lattice.ids[e]), *p), lattice.weight[e] + w) for e in range(lattice.ptr[at], lattice.ptr[at + 1])
                for p, w in paths(lattice.stop[e], end)]

    words = [paths(a, b) for a, b in zip(bounds, bounds[1:])]
    mass = {p + q: math.exp(v + w) for p, v in words[0] for q, w in words[1]}
    total = sum(mass.values())
    chance = {p: m / total for p, m in mass.items()}
    n = 6000
    samples = segment.segment_chunk(["the cat"] * n, mix(np.arange(n).astype(U) * U(5)), vocab, 3)
    first = Counter(tuple(s[0][0].tolist()) for s in samples)
    second = Counter(tuple(s[1][0].tolist()) for s in samples)
    for p in sorted(chance, key=chance.get)[-3:]:
        assert abs(first[p] / n - chance[p]) < 0.02
        assert abs(second[p] / n - sum(chance[q] * chance[p] / (1 - chance[q]) for q in chance if q != p)) < 0.03
    # inclusion scores make the samples an unbiased estimate of the whole mass
    assert abs(np.mean([sum(math.exp(x[1]) / x[3] for x in s) for s in samples]) - 1) < 0.01
    assert all(s[0][2] > s[1][2] > s[2][2] for s in samples)


def test_window_hash_depends_on_order():
    h = mix(np.arange(10).astype(U))
    assert window_hashes(h[:3], 3) != window_hashes(h[:3][::-1].copy(), 3)
