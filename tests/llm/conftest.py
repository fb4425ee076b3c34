import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, key string, score double"


def prose(seed, n):
    rng = random.Random(seed)
    syllables = "the of an er in on re ed tion ing ha we lo mi su ka".split()
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, n, 9)) + "."


ITEMS = [(1, prose(901, 40)), (2, "Only four words here"), (3, None), (4, ""), (2, "Only four words here"), (10, prose(901, 30))]


def hard_texts():
    """Texts for all operators: copies, near copies, passages, secrets, odd and empty ones."""
    base = prose(1, 300)
    words = base.split(" ")
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in range(10, 290, 9)]
    far = [" ".join(w if i % 7 else "x" + w for i, w in enumerate(words))]
    passage = prose(2, 90)
    shared = [prose(100 + k, 30) + " " + passage + " " + prose(200 + k, 30 + k) for k in range(6)]
    secret = "ab12" * 5
    return [
        base,
        base,
        *near,
        *far,
        *shared,
        None,
        "",
        " \n\t ",
        "one",
        "One two",
        "ONE two",
        "é É ñandú 數據",
        "a " * 900,
        "abcabcabc" * 300,
        "line one of it\n" * 40,
        prose(3, 20_000),
        ITEMS[0][1],
        "x " + ITEMS[0][1].upper() + " y",
        "before only FOUR words, here after",
        f'token = "{secret}" and password: {secret}xyz, AKIA{"Q7" * 8} tail',
        f"PassWord='short' secret = 'Zx9Kq2Lm8Vn4Bt7Yw1Rc' 0123456789abcdef {'f' * 15}",
        "key Zx9Kq2Lm8Vn4Bt7Yw1RcPd3 plain-words-with-hyphens aaaaaaaaaaaaaaaaaaaaaaaa 12345678901234567890123",
        "😀é " * 30 + "api_key:ABCDEFGHIJKLMNOP" + "É" * 3,
        "cr\r\nline\vtab\tform\f nbsp\u00a0wide\u3000end  two  spaces\n\nlines ",
        "<|endoftext|> as text",
    ]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t), i, "k", 0.5) for i, t in enumerate(hard_texts())]
    rows += [rows[1], rows[1], (None, "a null id " * 3, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="session")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def tuples(df, *columns):
    """Rows as tuples, in an order that takes nulls."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
