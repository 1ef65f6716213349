"""Compression bands against plain statements of the counts."""

import random
import re

import pytest

from orderlens.llm import compression

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("etaoinshrdlucmfwyp") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_counts_equal_plain_statement(spark):
    rnd = random.Random(3)
    texts = [None, "", " \t\r\n", "a", "a a a", "a a a a", "x\ny\nx\n \n \nx", "é ß 日本 #*$%&|<> a|b",
             "one two three four one two three", "  \x1c \x85 odd\x0bspace\x0c."]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "#", " \t", "é ", "|<"]) for _ in range(rnd.randint(0, 160))) for _ in range(150)]
    texts += [prose(k, 80) for k in range(5)]
    rows = compression.judge_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[1:7]) == plain_counts(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert not (r["kept"] and r["base_failed"])


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    rnd = random.Random(9)
    blob = " ".join("".join(chr(rnd.randint(33, 0x24F)) for _ in range(24)) for _ in range(400))
    loop = " ".join(f"{w} {k}" for k in range(900) for w in ("item number again in stock",))
    mixed = prose(5, 600) + "\n" + "".join(f"entry {k} of the same list as the entry before it\n" for k in range(400))
    texts = {"prose": prose(1, 700), "short prose": prose(2, 60), "long prose": prose(3, 30_000), "noise": blob, "loop": loop, "mixed": mixed}
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id string, text string")
    got = {r["doc_id"]: r for r in compression.judge_texts(df).collect()}
    assert {k for k, r in got.items() if r["kept"]} == {"prose", "short prose", "long prose"}
    assert got["noise"]["reason"] == "incompressible" and got["loop"]["reason"] == "repetitive"
    assert not got["mixed"]["kept"] and got["mixed"]["n_bad_chunks"] > 0


def test_chunks_cover_the_text():
    for n in (0, 1, 4095, 4096, 4097, 6143, 6144, 8192, 100_001):
        raw = bytes(k % 251 for k in range(n))
        parts = compression.chunks_of(raw)
        assert b"".join(parts) == raw and all(len(p) <= 4096 * 1.5 for p in parts)


def test_repeated_rows_null_ids_clashing_columns_empty_table(spark, docs, no_docs):
    rows = compression.judge_texts(docs).collect()
    assert len(rows) == docs.count()
    assert len({tuple(r) for r in rows if r["doc_id"] == 2}) == 1
    assert all(r["base_failed"] and not r["kept"] and r["ratio"] == 0 for r in rows if r["doc_id"] in (4, 5))
    empty = compression.judge_texts(no_docs)
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


@pytest.mark.parametrize("size, value, side", [(500, 1.0, -1), (500, 2.0, 0), (500, 3.5, 1), (10**6, 7.0, 0), (10**6, 9.0, 1)])
def test_limits_follow_the_length(size, value, side):
    assert compression.outside(size, value, compression.BANDS) == side
