import json
import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import merging
from corpusmill.functions.byte_symbols import SYMBOLS
from corpusmill.functions.merging import WordMerger, array_encoder
from corpusmill.operators import evaluate
from corpusmill.operators.tokenizer import SPECIAL_TOKENS, Tokenizer, decode, encode, token_to_id
from corpusmill.operators.training_samples import (
    answer_header_ids,
    pretrain_samples,
    sft_samples,
    supervised_tokens,
)
from corpusmill.operators.merge_passes import MergePasses
from corpusmill.operators.pair_index import PairIndex
from corpusmill.operators.vocabulary import train_bpe, word_counts
from corpusmill.session import BATCH_BYTES
from corpusmill.sources.tokenizer_json import (
    chat_template,
    model_document,
    read_tokenizer_files,
    tokenizer_from,
    write_tokenizer_files,
)
from corpusmill.sources.tokenizer_store import load_tokenizer, save_tokenizer


def corpus(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def package_tokenizer(texts, vocab_size, min_frequency=2, prefix_space=False):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    tok.normalizer = tokenizers.normalizers.NFKC()
    tok.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=prefix_space)
    tok.decoder = tokenizers.decoders.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=vocab_size, min_frequency=min_frequency, show_progress=False,
        special_tokens=list(SPECIAL_TOKENS),
        initial_alphabet=tokenizers.pre_tokenizers.ByteLevel.alphabet(),
    )
    tok.train_from_iterator(texts, trainer=trainer)
    return tok


def merges_of(tok):
    return tuple(map(tuple, json.loads(tok.to_str())["model"]["merges"]))


def random_texts(seed, n=60):
    rng = random.Random(seed)
    syllables = ["ab", "ba", "aa", "abc", "c", "é", "你", "the", "th", "e", "ｆ", "1"]
    return [
        " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(12))
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "seed, refresh, top, hot, look",
    [(1, 48, 256, 9999, 0), (2, 1, 256, 9999, 0), (3, 5, 3, 9999, 0), (4, 5, 9, 7, 0), (5, 48, 256, 9999, 50_000), (6, 2, 9, 30, 900)],
)
def test_training_and_coding_agree_with_the_tokenizers_package(spark, seed, refresh, top, hot, look):
    texts = random_texts(seed)
    words = word_counts(corpus(spark, texts))
    ours = train_bpe(words, 261 + 40, refresh=refresh, top_pairs=top, hot_pairs=hot, look_words=look)
    theirs = package_tokenizer(texts, 261 + 40)
    assert ours.merges == merges_of(theirs)
    assert dict(ours.ids) == theirs.get_vocab()
    texts += ["<|im_start|>user\nabcthe  é<|im_end|>", "", "<s>你<unk>", "x <", "＜s＞ ab", "á b"]
    df = encode(corpus(spark, texts), ours)
    rows = decode(decode(df, ours, out="plain", skip_special=True), ours).collect()
    got = {r.text: (r.ids, r.decoded, r.plain) for r in rows}
    theirs.add_special_tokens(list(SPECIAL_TOKENS))
    for text in texts:
        ids = theirs.encode(text).ids
        want = (
            ids,
            theirs.decode(ids, skip_special_tokens=False),
            theirs.decode(ids, skip_special_tokens=True),
        )
        assert got[text] == want, text


def test_prefix_space_agrees_with_the_tokenizers_package(spark):
    texts = random_texts(9)
    ours = train_bpe(word_counts(corpus(spark, texts), add_prefix_space=True), 281, add_prefix_space=True)
    theirs = package_tokenizer(texts, 281, prefix_space=True)
    assert ours.merges == merges_of(theirs)
    texts = ["<s>ab the</s>", " ab", "\nab", "ab<unk> c"]
    got = {r.text: r.ids for r in encode(corpus(spark, texts), ours).collect()}
    theirs.add_special_tokens(list(SPECIAL_TOKENS))
    assert got == {t: theirs.encode(t).ids for t in texts}


def words_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, freq long")


def test_training_stops(spark):
    words = words_table(spark, {"ab": 5, "cd": 1})
    assert train_bpe(words, 261).merges == ()
    assert train_bpe(words, 400).merges == (("a", "b"),)
    assert train_bpe(words, 400, min_frequency=1).merges == (("a", "b"), ("c", "d"))
    assert train_bpe(words_table(spark, {"a": 9}), 400).merges == ()


def test_ties_overlaps_and_repeated_tokens(spark):
    assert train_bpe(words_table(spark, {"ba": 3, "ab": 3}), 262).merges == (("a", "b"),)
    assert train_bpe(words_table(spark, {"aaaa": 3}), 270).merges == (("a", "a"), ("aa", "aa"))
    words = {"abc": 10, "xabc": 9, "bcd": 30, "ab": 25, "bc": 24, "abcd": 3}
    texts = [" ".join([w] * n) for w, n in words.items()]
    got = train_bpe(word_counts(corpus(spark, texts)), 275)
    assert got.merges == merges_of(package_tokenizer(texts, 275))


def test_continuing_prefix(spark):
    tok = train_bpe(words_table(spark, {"abab": 4, "b": 1}), 264, continuing_prefix="##")
    assert tok.tokens[261:] == ("##a", "##b", "a##b"[0] + "b")
    assert tok.merges == (("a", "##b"),)
    assert tok.encode_word("abab") == [tok.ids["ab"], tok.ids["##a"], tok.ids["##b"]]
    assert tok.encode_word("zz")[1] == tok.unk_id


@pytest.fixture(scope="module")
def tok(spark):
    return train_bpe(word_counts(corpus(spark, random_texts(5))), 291)


def test_long_words_and_nulls(spark, tok):
    texts = ["ab" * 50_000, None, "é" * 1000]
    rows = {r.text: r.ids for r in encode(corpus(spark, texts), tok).collect()}
    assert rows[None] is None
    back = decode(encode(corpus(spark, texts[:1]), tok), tok).first().decoded
    assert back == texts[0]


def test_round_trip_is_nfkc(spark, tok):
    texts = random_texts(6) + ["  two  spaces ", "\x00\x7f", "😀"]
    rows = decode(encode(corpus(spark, texts), tok), tok).collect()
    assert all(r.decoded == unicodedata.normalize("NFKC", r.text) for r in rows)
    broken = spark.createDataFrame([([tok.ids[SYMBOLS[0xE4]], tok.ids["a"], 9999],)], "ids array<int>")
    assert decode(broken, tok).first().decoded == "�a"


def test_token_names(spark, tok):
    df = spark.createDataFrame([("<s>",), ("a",), ("nope",), (None,)], "token string")
    got = {r.token: r.id for r in token_to_id(df, tok).collect()}
    assert got == {"<s>": 1, "a": tok.ids["a"], "nope": 0, None: 0}


def test_save_and_load(spark, tok, tmp_path):
    save_tokenizer(spark, tok, f"{tmp_path}/t")
    assert load_tokenizer(spark, f"{tmp_path}/t") == tok


@pytest.mark.parametrize("prefix_space", [False, True])
def test_files_of_other_tools(spark, tmp_path, prefix_space):
    tokenizers = pytest.importorskip("tokenizers")
    texts = random_texts(11) + ["two  spaces", "<s>ﬁ</s>", "\x00é"]
    words = word_counts(corpus(spark, texts), add_prefix_space=prefix_space)
    tok = train_bpe(words, 290, add_prefix_space=prefix_space)
    write_tokenizer_files(tok, f"{tmp_path}/ours")
    assert read_tokenizer_files(f"{tmp_path}/ours") == tok
    other = tokenizers.Tokenizer.from_file(f"{tmp_path}/ours/tokenizer.json")
    ids = {r.text: r.ids for r in encode(corpus(spark, texts), tok).collect()}
    assert ids == {t: other.encode(t).ids for t in texts}
    assert all(other.decode(i) == decode_one(spark, tok, i) for i in ids.values())
    # And the way back, from a file that the package has written.
    (tmp_path / "theirs").mkdir()
    theirs = package_tokenizer(texts, 290, prefix_space=prefix_space)
    theirs.save(f"{tmp_path}/theirs/tokenizer.json")
    assert read_tokenizer_files(f"{tmp_path}/theirs") == tok
    roles = json.loads((tmp_path / "ours" / "special_tokens_map.json").read_text())
    assert roles["additional_special_tokens"] == ["<s>", "</s>"] and roles["pad_token"] == "<|im_end|>"


def decode_one(spark, tok, ids):
    return decode(spark.createDataFrame([(ids,)], "ids array<int>"), tok, skip_special=True).first().decoded


def test_the_chat_template_frames_like_render_chat(tok):
    jinja2 = pytest.importorskip("jinja2")
    chat = [{"role": r, "content": f"{r} says"} for r in ("system", "user", "tool", "assistant")]
    shown = jinja2.Template(chat_template(tok)).render(messages=chat, add_generation_prompt=True)
    framed = [f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in chat if m["role"] != "tool"]
    assert shown == "".join(framed) + "<|im_start|>assistant\n"


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": None},
        {"model": {"dropout": 0.1}}, {"model": {"type": "Unigram"}}, {"model": {"merges": ["a zz"]}},
        {"model": {"merges": ["a b c"]}}, {"model": {"vocab": {"a": 0, "b": 2}}},
        {"added_tokens": [{"id": 0, "content": "<unk>", "special": True, "lstrip": True}]},
        {"added_tokens": [{"id": 7, "content": "<s>", "special": True}]},
        {"post_processor": {"type": "TemplateProcessing"}},
    ],
)
def test_files_that_ask_for_something_else_are_refused(tok, change):
    document = model_document(tok)
    for key, value in change.items():
        document[key] = document[key] | value if key == "model" else value
    with pytest.raises(ValueError, match="tokenizer file"):
        tokenizer_from(document)


def test_two_thousand_merges_equal_those_of_the_package(spark):
    """Real words: the smallest documents, trained well beyond the byte pairs."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    ours = train_bpe(word_counts(corpus(spark, texts).repartition(4)), 261 + 2000, refresh=50)
    theirs = merges_of(package_tokenizer(texts, 261 + 2000))
    assert len(theirs) >= 2000 and ours.merges == theirs


def test_a_round_reads_the_entries_of_its_pairs(spark):
    counts = {f"w{i:04}": 5 + i % 7 for i in range(2000)} | {"zqzq": 100_000}
    index = PairIndex(words_table(spark, counts), list(range(256)), list(range(256)), 1000)
    try:
        z, q = ord("z"), ord("q")
        assert index.best(1, 1)[0] == [(z, q, 200_000)]
        index.merge([(z, q, 256)])
        log = index._read(index.folder[-1])
        assert {r.word for r in log.collect()} == {"zqzq"}
        assert index.hot[(256, 256)] == 100_000 and (z, q) not in index.hot
        before = len(index.folder)
        index.merge([(256, 256, 257)], fold=True)
        assert index.made == {256: [1], 257: [2]} and len(set(index.folder)) == 2 and len(index.folder) == before + 1
        assert index.best(1, 1)[0][0][2] < 100_000
    finally:
        index.close()


@pytest.mark.parametrize("passes, sample", [(0, 9), (40, 0), (40, 9), (40, 300), (40, 50_000), (13, 40)])
def test_passes_foretell_merges_and_never_change_them(spark, passes, sample):
    texts = random_texts(7)
    ours = train_bpe(word_counts(corpus(spark, texts)), 261 + 40, pass_merges=passes, sample_words=sample)
    theirs = package_tokenizer(texts, 261 + 40)
    assert ours.merges == merges_of(theirs) and dict(ours.ids) == theirs.get_vocab()


def test_frequent_merges_are_found_in_few_passes(spark, monkeypatch):
    """The words of a frequent pair are not written again for each merge."""
    rounds, passes, confirm = [], [], MergePasses.confirm

    def counted(self, planned, least):
        passes.append(confirm(self, planned, least))
        return passes[-1]

    monkeypatch.setattr(PairIndex, "merge", lambda self, *_, **__: rounds.append(1))
    monkeypatch.setattr(MergePasses, "confirm", counted)
    ours = train_bpe(word_counts(corpus(spark, random_texts(8))), 261 + 40)
    assert len(ours.merges) == sum(passes) == 40 and not rounds and len(passes) <= 4


def test_a_wrong_forecast_is_not_applied(spark):
    counts = {"ab": 9, "cd": 8, "ef": 7}
    passes = MergePasses(words_table(spark, counts), list(range(256)), list(range(256)), 10)
    try:
        a, b, c, d, e, f = map(ord, "abcdef")
        assert passes.best(1) == (a, b)
        assert passes.confirm([(a, b, 256), (e, f, 257), (c, d, 258)], 1) == 1
        assert passes.merges == [(a, b, 256)] and passes.counts == {(c, d): 8, (e, f): 7}
        assert passes.confirm([(c, d, 257), (e, f, 258)], 8) == 1
    finally:
        passes.close()


def test_the_sample_holds_frequent_words_and_stands_for_rare_ones(spark):
    counts = {f"rare{i}": 2 for i in range(4000)} | {f"often{i}": 5000 + i for i in range(50)}
    passes = MergePasses(words_table(spark, counts), list(range(256)), list(range(256)), 500)
    passes.close()
    weights = dict(zip(passes.sample, passes.weights))
    assert 300 < len(weights) <= 500
    assert all(weights[w.encode()] == n for w, n in counts.items() if n > 2)
    rare = sum(n for w, n in weights.items() if w.startswith(b"rare"))
    assert 0.7 * 8000 < rare < 1.3 * 8000


def test_a_batch_of_many_words_is_encoded_in_parts(monkeypatch):
    merger = WordMerger({}, list(range(256)), list(range(256)), {(97, 98): (0, 256)})
    texts = [None, [], ["ab", "b", "abab"] * 7, ["x"], None, [f"ab{i}" for i in range(40)], []]
    want = [t and [i for w in t for i in merger.encode([w])[0].as_py()] for t in texts]
    most = []
    monkeypatch.setattr(merging, "WORDS", 9)
    encode_words = merger.encode
    monkeypatch.setattr(merger, "encode", lambda words: most.append(len(words)) or encode_words(words))
    rows = pa.array([["aa"], *texts], pa.list_(pa.string())).slice(1)
    assert array_encoder(merger)(rows).to_pylist() == want
    assert max(most) <= 9


def test_batches_for_arrow_functions_end_after_some_bytes(spark):
    """Long texts do not come to a worker 10,000 at a time."""

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["size"])

    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("some words "), 1000).alias("text"))
    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 40_000_000 and max(found) < 2 * BATCH_BYTES


def test_samples(spark, tok):
    texts = ["ab", "the th " * 30, ""]
    rows = pretrain_samples(corpus(spark, texts).withColumn("k", F.col("text")), tok, 16).collect()
    for r in rows:
        ids = ([3, *sum((tok.encode_word(w) for w in words_of(r.k)), [])])[:16]
        padded = ids + [0] * (16 - len(ids))
        mask = [1] * len(ids) + [0] * (16 - len(ids))
        assert (r.x, r.y, r["mask"]) == (padded[:-1], padded[1:], mask[1:])
    chat = "<|im_start|>user\nab<|im_end|>\n<|im_start|>assistant\nthe<|im_end|>\n"
    one = corpus(spark, [chat]).withColumnRenamed("text", "rendered")
    plain = sft_samples(one, tok, 64).first()
    assert plain["mask"] == [int(y != 4) for y in plain.y]
    answer = sft_samples(one, tok, 64, "assistant").first()
    header = answer_header_ids(tok)
    ids = [3, *answer.y] if answer.x[0] == 3 else None
    at = next(i for i in range(len(ids)) if ids[i : i + len(header)] == header) + len(header)
    end = ids.index(4, at)
    assert answer["mask"] == [int(at <= i <= end) for i in range(1, 64)]
    total = supervised_tokens(sft_samples(one, tok, 64, "assistant")).first().supervised
    assert total == end - at + 1
    with pytest.raises(ValueError):
        sft_samples(one, tok, 64, "other")


def words_of(text):
    import regex

    return regex.findall(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", text)


def test_evaluation(spark, tok):
    words = spark.createDataFrame([("ab",), ("zzzzz",), ("q",)], "word string")
    sized = {r.word: (r.tokens, r.token_class) for r in evaluate.coverage(words, tok).collect()}
    assert sized["q"] == (1, "1") and sized["zzzzz"] == (5, ">3")
    texts = corpus(spark, ["ab <s>", " ab ", "ﬁ"])
    share = evaluate.round_trip(texts, tok).first()
    assert share.texts == 3 and share.round_trip == pytest.approx(1 / 3)
    kept = {r.text: (r.present, r.kept) for r in evaluate.special_retention(texts, tok).collect()}
    assert kept["ab <s>"] == (["<s>"], ["<s>"]) and kept[" ab "] == ([], [])
    unknown = Tokenizer(tokens=tuple(t for t in tok.tokens[:261] if t != "z"), merges=())
    oov = evaluate.oov_rate(words, unknown).first()
    assert oov.oov == pytest.approx(1 / 3)
    chats = spark.sql("SELECT array(named_struct('role','user','content','ab')) AS messages")
    check = evaluate.chat_check(chats, tok).first()
    assert check.frames_kept
    assert not evaluate.chat_check(chats, tok, max_length=3).first().frames_kept
    report = evaluate.tokenizer_report(texts, chats, words, tok).collect()
    found = {(r.metric, r.group): r.value for r in report}
    assert found["vocab_size", "all"] == tok.vocab_size
    assert {g for m, g in found if m == "special_id"} == {"<s>", "</s>", "<|im_start|>", "<|im_end|>"}
