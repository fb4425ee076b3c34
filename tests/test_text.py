import random
import unicodedata

import pytest

from corpusmill.functions import byte_symbols, text
from corpusmill.operators.records import chunk_text
from corpusmill.operators.tokenizer import SPECIAL_TOKENS
from tests.helpers import column


def test_nonblank_and_strip_agree_with_python(spark):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    got = column(spark, chars, lambda c: text.nonblank(c))
    assert got == [bool(c.strip()) for c in chars]
    around = [c + "a b" + c + c for c in chars]
    assert column(spark, around, text.strip) == [s.strip() for s in around]
    assert column(spark, ["", "   ", None], text.nonblank) == [False, False, False]
    assert column(spark, ["", " 　", "​"], text.strip) == ["", "", "​"]


def test_chunks(spark):
    texts = ["", "x" * 511, "y" * 512, "z" * 513, "w" * 1024, "😀" * 513, "  lead", "a\n" * 600]
    texts.append("a" * 512 + " " * 512 + "b")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted(map(tuple, chunk_text(df).collect()))
    want = sorted(
        (i, k // 512, t[k : k + 512])
        for i, t in enumerate(texts)
        for k in range(0, len(t), 512)
        if t[k : k + 512].strip()
    )
    assert got == want
    assert [r[1] for r in got if r[0] == 8] == [0, 2]


def test_stable_blocks_do_not_change(spark):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    skipped = [c for c, u in zip(chars, column(spark, chars, text._unstable)) if not u]
    assert len(skipped) > 30_000
    assert all(unicodedata.normalize("NFKC", c) == c for c in skipped)
    rng = random.Random(1)
    for _ in range(200):
        s = "".join(rng.choices(skipped, k=200))
        assert unicodedata.normalize("NFKC", s) == s


def test_nfkc(spark):
    rows = ["ﬁ", "Ａｂ１", "é", "①", "plain", "", None, "각", "，你好", "ｶﾞ"]
    want = [unicodedata.normalize("NFKC", r) if r is not None else None for r in rows]
    assert column(spark, rows, text.normalize_nfkc) == want


def test_split_special(spark):
    rows = ["<|im_start|>user\nhi<|im_end|>", "a<s></s>b", "<unk>", "none <here", "", "<<s>>"]
    want = [
        ["<|im_start|>", "user\nhi", "<|im_end|>"],
        ["a", "<s>", "</s>", "b"],
        ["<unk>"],
        ["none <here"],
        [],
        ["<", "<s>", ">"],
    ]
    assert column(spark, rows, lambda c: text.split_special(c, SPECIAL_TOKENS)) == want


@pytest.mark.parametrize("prefix", [False, True])
def test_pretokenize_agrees_with_the_tokenizers_package(spark, prefix):
    pre_tokenizers = pytest.importorskip("tokenizers").pre_tokenizers
    theirs = pre_tokenizers.ByteLevel(add_prefix_space=prefix)
    rng = random.Random(2)
    alphabet = "ab '  \n\t1.,!éß你　 ٣s t'll'S😀-_"
    rows = ["".join(rng.choices(alphabet, k=rng.randrange(0, 40))) for _ in range(3000)]
    words = column(spark, rows, lambda c: text.pretokenize(c, prefix))
    symbols = {ord(s): b for b, s in enumerate(byte_symbols.SYMBOLS)}
    for row, got in zip(rows, words):
        want = [
            bytes(symbols[ord(c)] for c in piece).decode()
            for piece, _ in theirs.pre_tokenize_str(row)
        ]
        assert got == want, row


def test_byte_symbols_round_trip(spark):
    rows = ["plain", "\x00\x7f é 你 😀", "\n", ""]
    symbols = column(spark, rows, byte_symbols.to_symbols)
    assert symbols[2] == "Ċ" and len(symbols[1]) == len(rows[1].encode())
    assert column(spark, symbols, byte_symbols.from_symbols) == rows
    assert column(spark, ["ÿa"], byte_symbols.from_symbols) == ["�a"]


def test_newline_is_the_199th_symbol():
    assert sorted(byte_symbols.SYMBOLS).index(byte_symbols.SYMBOLS[10]) + 5 == 203
