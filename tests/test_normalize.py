"""T0 against the sentencepiece normalizer."""

import random

import pytest

from pairforge.functions.normalize import nmt_nfkc, normalize_nmt_nfkc, rewrite

spm = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)


def test_every_code_point(library):
    for cp in range(1, 0x30000):
        if not 0xD800 <= cp < 0xE000:
            assert rewrite(chr(cp)) == library.normalize(chr(cp)), hex(cp)


def test_pairs_of_combining_marks(library):
    marks = [chr(cp) for cp in (*range(0x300, 0x370), 0x3099, 0x309A, 0xFF9E, 0xFF9F)]
    for base in "aAeuüsṣαωカｶㄱ가Å①Ａ":
        for a in marks:
            assert rewrite(base + a) == library.normalize(base + a), ascii(base + a)
    for base in "aαs":
        for a in marks:
            for b in marks:
                assert rewrite(base + a + b) == library.normalize(base + a + b), ascii(base + a + b)


def test_hangul_and_random_sequences(library):
    draw = random.Random(5)
    signs = [chr(cp) for cp in (*range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A8, 0x11C3), 0xAC00, 0xAC01, 0x3131, 0xFFA1, 0xFFC2)]
    other = [chr(cp) for cp in (0x41, 0x61, 0x66, 0x69, 0xFB01, 0x301, 0x308, 0x323, 0x327, 0x344, 0x345, 0x3B1, 0x1F00, 0x313, 0x212B, 0x1, 0x9, 0x20, 0xA0, 0x200B, 0xFF5E)]
    for pool in (signs, other, signs + other):
        for _ in range(4000):
            t = "".join(draw.choice(pool) for _ in range(draw.randint(1, 7)))
            assert rewrite(t) == library.normalize(t), ascii(t)


def test_rows_done_by_spark_equal_those_done_in_python(spark):
    draw = random.Random(6)
    texts = ["".join(chr(draw.choice([*range(1, 128), 32, 32, 9, 10])) for _ in range(draw.randint(0, 30))) for _ in range(400)]
    texts += ["", "   ", "\t\n", "x\x0bé ", "é  ü", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.n for r in df.select("k", normalize_nmt_nfkc("t").alias("n")).collect()}
    assert got == {i: nmt_nfkc(t) for i, t in enumerate(texts)}
