"""Cross-tokenizer alignment against a brute-force statement of it."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import align


@pytest.fixture(scope="module")
def plain():
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # the byte-level alphabet: printable characters stand for themselves, the others follow from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    names = {i: t for t, i in bpe.get_vocab().items()}

    def tokens(text):
        a = bpe.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        bytes_a = [bytes(byte_of[c] for c in names[i]) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, model.id_to_piece(i)) for i in b)]
        return a, bytes_a, b, bytes_b

    return tokens


def pieces():
    vocabulary, model = align.public_tokenizers_paths()
    return align.byte_level(*vocabulary)[1], align.piece_level(model)[1]


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(texts, tokens):
    """All pairs of each text, looked at one by one."""
    per, count = [], Counter()
    for text in texts:
        links, groups, n_a, n_b = [], [], 0, 0
        if text:
            a, bytes_a, b, bytes_b = tokens(text)
            want = b" " + text.encode()
            if b"".join(bytes_a) == want and b"".join(bytes_b) == want:
                sa, sb = spans(bytes_a), spans(bytes_b)
                links = [(x, y) for x, (lo, hi) in zip(a, sa) for y, (l2, h2) in zip(b, sb) if lo < h2 and l2 < hi]
                lo = 0
                for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
                    ga = [x for x, (s, e) in zip(a, sa) if lo <= s and e <= cut]
                    gb = [y for y, (s, e) in zip(b, sb) if lo <= s and e <= cut]
                    groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                    lo = cut
                n_a, n_b = len(a), len(b)
        per.append((n_a, n_b, groups, links))
        count.update(links)
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if links else "") for n_a, n_b, groups, links in per]


TEXTS = [None, "", " ", "a", "hello world", "hello  world ", " leading", "x <|endoftext|> y <s> </s> <unk> [INST]", "a ▁b", "▁",
         "été naïve 日本語 \U0001F600\U0001F469‍\U0001F4BB", "tab\tand\nnewline\r\n\n\n   indent", "é combining \x00 nul \x1f", "no" * 300,
         "don't it's we'll 12345 3.14 foo_bar(baz) https://ex.am/ple?q=1", " non-breaking　wide", "the the the the cat"]


def rows_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = align.align(df, *align.public_tokenizers_paths())
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r[1:]) for r in sorted(out.collect(), key=lambda r: r[0])]


def test_equals_brute_force(spark, plain, docs):
    more = [r["text"][:4000] for r in docs.where("text is not null").collect()]
    texts = TEXTS + more
    assert rows_of(spark, texts) == brute(texts, plain)


def test_equals_brute_force_on_given_texts(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy(F.length("text")).limit(60)
    texts = [r["text"] for r in docs.collect()]
    assert rows_of(spark, texts) == brute(texts, plain)


def test_small_memory_and_long_windows_change_nothing(spark, plain, monkeypatch):
    monkeypatch.setattr(align, "MEMO", 3)
    monkeypatch.setattr(align, "LONG", 4)
    left, right = pieces()
    for text in ("hello big wide world " * 5, "x" * 500, "日本語 " * 20):
        a, bytes_a, b, _ = plain(text)
        small = align.Aligner(left, right).document(b" " + text.encode(), a, b)
        assert small[0] == len(a) and b"".join(bytes_a) == b" " + text.encode()
        assert (small[2], small[3], small[4]) == tuple(brute([text], plain)[0][k] for k in (2, 3, 6))


def test_windows_begin_at_verified_anchors(plain):
    left, right = pieces()
    import numpy as np
    a, bytes_a, b, bytes_b = plain("one two  three four's")
    cut_a, cut_b = align.windows_of(np.array(a), np.array(b), left, right)
    assert len(cut_a) == len(cut_b) > 3
    for lo_a, hi_a, lo_b, hi_b in zip(cut_a, cut_a[1:], cut_b, cut_b[1:]):
        whole = b"".join(bytes_a[lo_a:hi_a])
        assert whole == b"".join(bytes_b[lo_b:hi_b]) and whole[:1] == b" "


def test_repeated_rows_null_ids_clashing_columns_empty_table(spark, docs, no_docs):
    clash = docs.withColumn("row", F.lit("x")).withColumn("pair", F.lit("x")).withColumn("links", F.lit("x"))
    rows = align.align(clash, *align.public_tokenizers_paths()).collect()
    assert len(rows) == docs.count()
    assert len({tuple(r) for r in rows if r["doc_id"] == 2}) == 1
    assert all(tuple(r[1:]) == (0, 0, 0, 0, 0, 0, "") for r in rows if r["doc_id"] in (4, 5))
    assert align.align(no_docs, *align.public_tokenizers_paths()).count() == 0
