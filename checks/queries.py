"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks import inputs as I
from corpusmill.functions import byte_symbols, chat, samples, text
from corpusmill.functions.sql import register_sql
from corpusmill.functions.strict_json import parse_line
from corpusmill.operators import evaluate, profile, ranks, records
from corpusmill.operators import tokenizer as coding
from corpusmill.operators import training_samples as training
from corpusmill.operators import vocabulary
from corpusmill.plans.training import pretrain_batches, write_file_batches
from corpusmill.session import scratch_path
from corpusmill.sources import arrays, lines, ranges, sinks, tokenizer_store
from corpusmill.sources import tokenizer_json as tokenizer_json_files
from corpusmill.streaming.prepare import stream_prepare

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def _sample_text(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[_joined(F.col(c)).alias(c) for c in ("x", "y", "mask")])


def _exploded(df: DataFrame, col: str = "messages") -> DataFrame:
    return df.select("conv_id", F.posexplode(col).alias("pos", "m")).select(
        "conv_id", "pos", "m.role", "m.content"
    )


# Sources and sinks ----------------------------------------------------------


@query
def read_lines(spark, sf):
    numbered = lines.number_lines(lines.read_lines(spark, I.stored_texts(spark, sf)))
    return numbered.select("line_no", "value")


@query
def parse_json_strict(spark, sf):
    parsed = records.parse_json_strict(I.raw_lines(spark, sf), keep_malformed=True)
    return parsed.select(
        "line_no",
        F.col("v").isNotNull().cast("int").alias("is_json"),
        F.try_variant_get("v", F.lit("$.title"), "string").alias("title"),
    )


@query
def detect_layout(spark, sf):
    path = scratch_path(spark, "layouts")
    value = F.to_json("conversations")
    conv = I.raw_conversations(spark, sf)
    listed = conv.select(F.lit("array").alias("kind"), value.alias("value"))
    single = conv.select(
        F.lit("jsonl").alias("kind"), F.to_json(F.struct("conversations")).alias("value")
    )
    listed.unionByName(single).write.partitionBy("kind").text(path)
    found = lines.layouts(spark, path)
    return found.select(
        F.regexp_extract("file", "kind=([a-z]+)", 1).alias("kind"), "layout"
    ).distinct()


@query
def read_json_array(spark, sf):
    path = scratch_path(spark, "arrays")
    conv = I.raw_conversations(spark, sf)
    grouped = conv.groupBy(F.floor(F.col("conv_id") / 64).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("conv_id", "conversations"))).alias("r")
    )
    grouped.select("bucket", F.to_json("r").alias("value")).write.partitionBy("bucket").text(path)
    found = arrays.read_json_array(spark, path)
    turns = F.try_variant_get("v", F.lit("$.conversations"), "array<variant>")
    return found.select(
        F.try_variant_get("v", F.lit("$.conv_id"), "bigint").alias("conv_id"),
        F.size(turns).alias("turns"),
        F.array_join(
            F.transform(turns, lambda t: F.try_variant_get(t, F.lit("$.value"), "string")), "|"
        ).alias("texts"),
    )


@query
def write_jsonl(spark, sf):
    path = scratch_path(spark, "chats")
    sinks.write_jsonl(I.messages(spark, sf), path, "messages")
    back = records.parse_json_strict(lines.read_lines(spark, path))
    return (
        back.withColumn("rendered", chat.render_chat_list(F.col("v")))
        .groupBy("rendered")
        .agg(F.count(F.lit(1)).alias("chats"))
    )


@query
def write_samples(spark, sf):
    path = scratch_path(spark, "samples")
    docs = I.documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text")
    made = pretrain_batches(docs, I.byte_tokenizer(), 32, I.MAX_LENGTH)
    sinks.write_samples(made, path)
    back = spark.read.parquet(path)
    return training.supervised_tokens(back, ["batch_id"])


@query
def file_batches(spark, sf):
    path = scratch_path(spark, "file-batches")
    texts = I.documents(spark, sf).orderBy("doc_id").select(F.to_json(F.struct("text")).alias("value"))
    texts.write.text(f"{path}/in")
    made = write_file_batches(spark, f"{path}/in", I.byte_tokenizer(), f"{path}/out", 32, shards=5, shards_per_job=2)
    return training.supervised_tokens(made, ["batch_id"])


@query
def line_index(spark, sf):
    index = lines.line_index(spark, I.stored_texts(spark, sf))
    files = index.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("byte_len").alias("bytes")
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "file",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("r0"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("b0"),
    )
    return index.join(starts, "file").select(
        (F.col("r0") + F.col("row_id")).alias("row_id"),
        (F.col("b0") + F.col("byte_offset")).alias("byte_offset"),
        "byte_len",
    )


@query
def lookup_rows(spark, sf):
    wanted = I.table(spark, sf, "labels").filter("toxic = 1")
    found = ranks.lookup_rows(I.documents(spark, sf), wanted, "doc_id")
    return found.select("doc_id", "lang", "n_chars")


@query
def saved_tokenizer(spark, sf):
    path = scratch_path(spark, "tokenizer")
    tokenizer_store.save_tokenizer(spark, I.tokenizer(spark, sf), path)
    return tokenizer_store.load_tokenizer(spark, path).vocab_table(spark)


@query
def tokenizer_json(spark, sf):
    path = scratch_path(spark, "tokenizer-json")
    tokenizer_json_files.write_tokenizer_files(I.tokenizer(spark, sf), path)
    return tokenizer_json_files.read_tokenizer_files(path).vocab_table(spark)


@query
def lookup_lines(spark, sf):
    """Long lines of the stored documents, found in the index and read by their bytes."""
    index = lines.line_index(spark, I.stored_texts(spark, sf))
    asked = index.filter("byte_len > 512").select("file", "row_id")
    return ranges.lookup_lines(index, asked).groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


# Projections and filters ----------------------------------------------------


@query
def nonblank(spark, sf):
    pieces = I.documents(spark, sf).select(
        "doc_id", F.posexplode(F.split("text", "[\n.]")).alias("pos", "piece")
    )
    return pieces.select(
        "doc_id", "pos", text.nonblank(F.col("piece")).cast("int").alias("filled")
    )


@query
def extract_text(spark, sf):
    parsed = records.parse_json_strict(I.raw_lines(spark, sf))
    return records.extract_text(parsed).select("line_no", "text")


@query
def chunk_text(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "text")
    return records.chunk_text(docs).select("doc_id", "chunk_idx", "text")


@query
def map_roles(spark, sf):
    conv = I.raw_conversations(spark, sf)
    return _exploded(conv.select("conv_id", chat.map_roles(F.col("conversations")).alias("messages")))


@query
def prepend_system(spark, sf):
    conv = I.raw_conversations(spark, sf)
    mapped = chat.map_roles(F.col("conversations"))
    return _exploded(conv.select("conv_id", chat.prepend_system(mapped).alias("messages")))


@query
def to_chat(spark, sf):
    parsed = records.parse_json_strict(I.conversation_lines(spark, sf))
    return _exploded(records.to_chat(parsed))


@query
def render_chat(spark, sf):
    shown = F.col("messages")
    return I.messages(spark, sf).select(
        "conv_id",
        chat.render_chat(shown).alias("rendered"),
        chat.render_chat(shown, add_generation_prompt=True).alias("prompt"),
    )


@query
def render_instruction(spark, sf):
    return I.instruction_records(spark, sf).select(
        "item_id", chat.render_instruction(parse_line(F.col("value"))).alias("rendered")
    )


@query
def render_messages(spark, sf):
    return I.message_records(spark, sf).select(
        "conv_id", chat.render_messages(parse_line(F.col("value"))).alias("rendered")
    )


@query
def render_fallback(spark, sf):
    docs = I.documents(spark, sf)
    value = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.array("text")).substr(
        F.lit(2), F.length(F.to_json(F.array("text"))) - 2
    )).otherwise(F.to_json(F.struct("doc_id", "lang", F.array("source", F.col("n_chars").cast("string")).alias("info"))))
    made = docs.select("doc_id", value.alias("value"))
    return made.select(
        "doc_id",
        chat.render_fallback(parse_line(F.col("value")), F.col("value")).alias("rendered"),
    )


@query
def render_any(spark, sf):
    rows = (
        I.instruction_records(spark, sf)
        .select(F.concat(F.lit("i"), "item_id").alias("id"), "value")
        .unionByName(
            I.message_records(spark, sf).select(F.concat(F.lit("m"), "conv_id").alias("id"), "value")
        )
        .unionByName(
            I.messages(spark, sf).select(
                F.concat(F.lit("c"), "conv_id").alias("id"), F.to_json("messages").alias("value")
            )
        )
        .unionByName(
            I.table(spark, sf, "labels").select(
                F.concat(F.lit("f"), "doc_id").alias("id"),
                F.to_json(F.struct(F.array().cast("array<string>").alias("messages"), "quality")).alias("value"),
            )
        )
    )
    return records.render_records(rows).select("id", "rendered")


@query
def with_bos(spark, sf):
    return I.documents(spark, sf).select("doc_id", chat.with_bos(F.col("text")).alias("text"))


def _doc_ids(spark, sf) -> DataFrame:
    """Byte ids of each document."""
    docs = I.documents(spark, sf).select("doc_id", "text")
    return coding.encode(docs, I.byte_tokenizer()).drop("text")


def _chat_ids(spark, sf) -> DataFrame:
    """Byte ids of each framed chat."""
    shown = I.messages(spark, sf).select(
        "conv_id", chat.render_chat(F.col("messages")).alias("text")
    )
    return coding.encode(shown, I.byte_tokenizer()).drop("text")


@query
def truncate_pad(spark, sf):
    padded = samples.truncate_pad(F.col("ids"), I.MAX_LENGTH, 0)
    return _doc_ids(spark, sf).select("doc_id", _joined(padded).alias("ids"))


@query
def length_mask(spark, sf):
    mask = samples.length_mask(F.col("ids"), I.MAX_LENGTH)
    return _doc_ids(spark, sf).select("doc_id", _joined(mask).alias("mask"))


@query
def pad_value_mask(spark, sf):
    padded = _chat_ids(spark, sf).select(
        "conv_id", samples.truncate_pad(F.col("ids"), I.MAX_LENGTH, 4).alias("ids")
    )
    return padded.select(
        "conv_id", _joined(samples.pad_value_mask(F.col("ids"), 4)).alias("mask")
    )


@query
def assistant_mask(spark, sf):
    header = training.answer_header_ids(I.byte_tokenizer())
    return _chat_ids(spark, sf).select(
        "conv_id", _joined(samples.assistant_mask(F.col("ids"), header, 4)).alias("mask")
    )


@query
def shift_xy(spark, sf):
    padded = _doc_ids(spark, sf).select(
        "doc_id",
        samples.truncate_pad(F.col("ids"), I.MAX_LENGTH, 0).alias("p"),
        samples.length_mask(F.col("ids"), I.MAX_LENGTH).alias("m"),
    )
    shifted = padded.select("doc_id", samples.shift_xy(F.col("p"), F.col("m")).alias("s"))
    return _sample_text(shifted.select("doc_id", "s.*"), "doc_id")


@query
def pretrain_samples(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "text")
    made = training.pretrain_samples(docs, I.tokenizer(spark, sf), I.MAX_LENGTH)
    return _sample_text(made, "doc_id")


def _sft(spark, sf, mask: str) -> DataFrame:
    shown = I.messages(spark, sf).select(
        "conv_id", chat.render_chat(F.col("messages")).alias("rendered")
    )
    made = training.sft_samples(shown, I.tokenizer(spark, sf), I.MAX_LENGTH, mask)
    return _sample_text(made, "conv_id")


@query
def sft_samples(spark, sf):
    return _sft(spark, sf, "pad_value")


@query
def sft_samples_assistant(spark, sf):
    return _sft(spark, sf, "assistant")


@query
def take_lines(spark, sf):
    return ranks.take_lines(I.raw_lines(spark, sf), 600).select(
        "line_no", (F.col("value") == "").cast("int").alias("is_empty")
    )


# Text and tokens ------------------------------------------------------------

# The full-width forms of the ASCII letters and digits.
ASCII = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@query
def normalize_nfkc(spark, sf):
    wide = "".join(chr(ord(c) + 0xFEE0) for c in ASCII)
    return I.documents(spark, sf).select(
        "doc_id", text.normalize_nfkc(F.translate("text", ASCII, wide)).alias("text")
    )


@query
def split_special(spark, sf):
    specials = coding.SPECIAL_TOKENS
    parts = text.split_special(chat.render_chat(F.col("messages")), specials)
    return (
        I.messages(spark, sf)
        .select("conv_id", F.posexplode(text.flag_special(parts, specials)).alias("pos", "p"))
        .select("conv_id", "pos", "p.part", F.col("p.special").cast("int").alias("special"))
    )


@query
def pretokenize(spark, sf):
    words = text.pretokenize(F.col("text"))
    spaced = text.pretokenize(F.col("text"), add_prefix_space=True)
    return I.documents(spark, sf).select(
        "doc_id",
        F.size(words).alias("words"),
        F.md5(F.array_join(words, "|")).alias("digest"),
        F.get(spaced, F.lit(0)).alias("first_spaced"),
    )


@query
def byte_symbol_map(spark, sf):
    symbols = byte_symbols.to_symbols(F.col("word"))
    return I.document_words(spark, sf).select(
        "word", symbols.alias("symbols"), byte_symbols.from_symbols(symbols).alias("back")
    )


@query
def word_counts(spark, sf):
    return I.document_words(spark, sf)


@query
def pair_counts(spark, sf):
    return vocabulary.pair_counts(I.document_words(spark, sf))


@query
def train_bpe(spark, sf):
    return I.tokenizer(spark, sf).merge_table(spark)


@query
def encode(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "text")
    return coding.encode(docs, I.tokenizer(spark, sf)).select(
        "doc_id", F.size("ids").alias("tokens"), _joined(F.col("ids")).alias("ids")
    )


@query
def decode(spark, sf):
    tok = I.tokenizer(spark, sf)
    shown = I.messages(spark, sf).select(
        "conv_id", chat.render_chat(F.col("messages")).alias("text")
    )
    ids = coding.encode(shown, tok)
    return ids.select(
        "conv_id",
        tok.decode(F.col("ids")).alias("decoded"),
        tok.decode(F.col("ids"), skip_special=True).alias("plain"),
    )


@query
def token_to_id(spark, sf):
    words = I.document_words(spark, sf).select(
        F.regexp_replace("word", " ", "Ġ").alias("token")
    )
    return coding.token_to_id(words.distinct(), I.tokenizer(spark, sf))


# Aggregations ---------------------------------------------------------------


@query
def count_lines(spark, sf):
    return profile.count_lines(lines.read_lines(spark, I.stored_texts(spark, sf)))


@query
def count_samples(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "source", "text")
    return profile.count_samples(records.chunk_text(docs), ["source"])


@query
def chunk_profile(spark, sf):
    docs = I.documents(spark, sf).select("lang", "text")
    return profile.profile_texts(records.chunk_text(docs), ["lang"])


@query
def corpus_profile(spark, sf):
    return profile.corpus_profile(I.raw_lines(spark, sf), 600, ["lang"])


@query
def scan_report(spark, sf):
    return profile.scan_report(I.raw_lines(spark, sf))


@query
def coverage(spark, sf):
    words = I.document_words(spark, sf).select("word")
    return evaluate.coverage(words, I.tokenizer(spark, sf)).select(
        "word", "tokens", "chars", F.round("chars_per_token", 6).alias("chars_per_token"), "token_class"
    )


@query
def coverage_summary(spark, sf):
    docs = I.documents(spark, sf).select("lang", "text")
    found = evaluate.coverage_summary(docs, I.tokenizer(spark, sf), "text", ["lang"])
    return found.withColumn("chars_per_token", F.round("chars_per_token", 6))


@query
def round_trip(spark, sf):
    docs = I.documents(spark, sf).select("lang", "text")
    return evaluate.round_trip(docs, I.tokenizer(spark, sf), "text", ["lang"])


@query
def special_retention(spark, sf):
    shown = I.messages(spark, sf).select(
        "conv_id",
        F.concat(F.lit("<s>"), chat.render_chat(F.col("messages")), F.lit("</s>")).alias("text"),
    )
    found = evaluate.special_retention(shown, I.tokenizer(spark, sf))
    return found.select(
        "conv_id", "tokens", F.array_join("present", " ").alias("present"),
        F.array_join("kept", " ").alias("kept"),
    )


@query
def chat_check(spark, sf):
    found = evaluate.chat_check(I.messages(spark, sf), I.tokenizer(spark, sf))
    return found.select("conv_id", "tokens", F.col("frames_kept").cast("int").alias("frames_kept"))


@query
def oov_rate(spark, sf):
    docs = I.documents(spark, sf).select("source", "text")
    return evaluate.oov_rate(docs, I.tokenizer(spark, sf), "text", ["source"])


@query
def tokenizer_report(spark, sf):
    found = evaluate.tokenizer_report(
        I.documents(spark, sf).select("lang", "text"),
        I.messages(spark, sf),
        I.document_words(spark, sf),
        I.tokenizer(spark, sf),
        "lang",
    )
    return found.withColumn("value", F.round("value", 6))


@query
def supervised_tokens(spark, sf):
    shown = I.messages(spark, sf).select(
        "conv_id", chat.render_chat(F.col("messages")).alias("rendered")
    )
    batched = ranks.epoch_batches(shown, 24, row_id="conv_id")
    made = training.sft_samples(batched, I.tokenizer(spark, sf), I.MAX_LENGTH)
    return training.supervised_tokens(made, ["batch_id"])


# Order and batches ----------------------------------------------------------


@query
def epoch_order(spark, sf):
    docs = I.documents(spark, sf).select("doc_id")
    first = ranks.epoch_order(docs, "doc_id", epoch=0).withColumn("epoch", F.lit(0))
    second = ranks.epoch_order(docs, "doc_id", epoch=1).withColumn("epoch", F.lit(1))
    return first.unionByName(second).select("epoch", "doc_id", "rank")


@query
def epoch_batches(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "lang")
    made = ranks.epoch_batches(docs, 48, accumulation=4, max_steps=200, row_id="doc_id")
    return made.withColumn("applied", F.col("applied").cast("int"))


@query
def text_batches(spark, sf):
    valid = records.valid_texts(I.raw_lines(spark, sf)).select("line_no")
    return ranks.text_batches(valid, 100)


@query
def stream_prepare_pretrain(spark, sf):
    return _streamed(spark, I.raw_lines(spark, sf).select("value"), "pretrain").select(
        "chunk_idx", "text"
    )


@query
def stream_prepare_chat(spark, sf):
    return _streamed(spark, I.conversation_lines(spark, sf).select("value"), "chat").select(
        "rendered"
    )


def _streamed(spark: SparkSession, values: DataFrame, kind_name: str) -> DataFrame:
    path = scratch_path(spark, "stream")
    values.write.text(f"{path}/in")
    run = stream_prepare(spark, f"{path}/in", kind_name, f"{path}/out", f"{path}/checkpoint")
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def sql_functions(spark, sf):
    register_sql(spark)
    header = training.answer_header_ids(I.byte_tokenizer())
    ids = _chat_ids(spark, sf).withColumnRenamed("ids", "token_ids")
    rows = I.messages(spark, sf).join(ids, "conv_id")
    listed = ", ".join(map(str, header))
    return rows.select(
        "conv_id",
        F.expr("render_chat(messages)").alias("rendered"),
        F.expr("size(chunk_text(render_chat(messages), 100))").alias("pieces"),
        _joined(F.expr(f"assistant_mask(token_ids, array({listed}), 4)")).alias("mask"),
    )
