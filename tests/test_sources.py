import io
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.records import prepare_lines
from corpusmill.plans.corpora import JobReport, chat_records, prepare_all
from corpusmill.plans.tokenizer import train_tokenizer
from corpusmill.sources.arrays import array_elements, read_json_array
from corpusmill.sources.lines import (
    detect_layout,
    layouts,
    line_index,
    number_lines,
    read_lines,
)
from corpusmill.sources.sinks import write_jsonl, write_samples
from corpusmill.sources.tokenizer_store import load_tokenizer
from corpusmill.sources.ranges import first_chars, lookup_lines
from corpusmill.streaming.prepare import stream_counts, stream_prepare


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_lines_and_numbers(small_splits, tmp_path):
    spark = small_splits
    first = "one\r\ntwo\rthree\n\nfive   still five\n" + "x" * 100 + "\nlast"
    second = "\n".join(f"line {i}" for i in range(60)) + "\n"
    write(tmp_path / "a.txt", first)
    write(tmp_path / "b.txt", second)
    rows = number_lines(read_lines(spark, str(tmp_path))).select("line_no", "value").collect()
    want = [
        *["one", "two", "three", "", "five   still five", "x" * 100, "last"],
        *[f"line {i}" for i in range(60)],
    ]
    assert [tuple(r) for r in sorted(rows)] == list(enumerate(want, 1))


def test_line_numbers_hold_when_the_splits_change(small_splits, tmp_path):
    write(tmp_path / "a.txt", "\n".join(f"line {i}" for i in range(200)))
    numbered = number_lines(read_lines(small_splits, str(tmp_path))).select("line_no", "value")
    want = [(i + 1, f"line {i}") for i in range(200)]
    for size in ("41", "1000", "77"):
        small_splits.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert sorted(map(tuple, numbered.collect())) == want


def test_each_file_of_a_folder_has_its_own_layout(spark, tmp_path):
    turn = [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]
    records = [json.dumps({"conversations": turn})] * 5
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "lines.jsonl", "\n".join(records * 40))
    write(folder / "array.json", "[" + ",\n".join(records) + "]")
    write(folder / "empty.jsonl", "")
    assert sorted(r.layout for r in layouts(spark, str(folder)).collect()) == ["array", "jsonl", "jsonl"]
    assert chat_records(spark, str(folder)).count() == 205


@pytest.mark.parametrize("tail", ["", "\n"])
def test_line_index(small_splits, tmp_path, tail):
    spark = small_splits
    rng = random.Random(5)
    files = {}
    for name in ("a", "b"):
        lines = ["é" * rng.randrange(0, 20) + "\r" * rng.randrange(2) for _ in range(50)]
        files[name] = ("\n".join(lines) + "z" + tail).encode()
        (tmp_path / name).write_bytes(files[name])
    rows = line_index(spark, str(tmp_path)).collect()
    for name, data in files.items():
        want, offset = [], 0
        for k, line in enumerate(io.BytesIO(data).readlines()):
            want.append((k, offset, len(line)))
            offset += len(line)
        got = sorted((r.row_id, r.byte_offset, r.byte_len) for r in rows if r.file.endswith(name))
        assert got == want


@pytest.mark.parametrize(
    "text, layout",
    [("", "jsonl"), ("\n \n　[1]", "array"), ('{"a":1}\n[2]', "jsonl"), ("[", "array"),
     ("\n" * 300 + " [", "array")],
)
def test_layout(small_splits, tmp_path, text, layout):
    path = write(tmp_path / "f.json", text)
    assert detect_layout(small_splits, path) == layout
    found = [r.layout for r in layouts(small_splits, path).collect()]
    assert found == [layout]


def test_layouts_read_the_first_bytes_only(spark, tmp_path, monkeypatch):
    texts = ["[" + "1," * 200_000 + "1]", "\n" * 10_000 + "{}\n" * 100_000, "\ufeff [1]", "", " \n"]
    files = [write(tmp_path / f"f{k}", t) for k, t in enumerate(texts)]
    rows = {r.file: r for r in first_chars(spark, files).collect()}
    assert [rows[f].first_char for f in files] == ["[", "{", "[", None, None]
    assert rows[files[0]].bytes_read == 4096 and rows[files[1]].bytes_read == 3 * 4096
    import gzip

    (tmp_path / "g.json.gz").write_bytes(gzip.compress(b" [1, 2]"))
    assert detect_layout(spark, str(tmp_path / "g.json.gz")) == "array"
    plan = layouts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan text" not in plan
    # A store that only Spark opens is scanned; the answers are the same.
    by_head = sorted(map(tuple, layouts(spark, str(tmp_path)).collect()))
    monkeypatch.setattr("corpusmill.sources.lines.reachable", lambda path: False)
    assert sorted(map(tuple, layouts(spark, str(tmp_path)).collect())) == by_head


def test_lookup_reads_the_asked_lines(small_splits, tmp_path):
    spark = small_splits
    lines = {f: [f"{f} {i} é{'x' * (i % 50)}" + "\r" * (i % 2) for i in range(3000)] for f in ("a", "b")}
    for name, own in lines.items():
        write(tmp_path / name, "\n".join(own))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    index = line_index(spark, str(tmp_path)).cache()
    asked = spark.range(0, 3500, 7).select(F.col("id").alias("row_id"))
    found = lookup_lines(index, asked.unionByName(asked))
    got = sorted((r.file[-1], r.row_id, r.value) for r in found.collect())
    assert got == sorted((f, i, own[i]) for f, own in lines.items() for i in range(0, 3000, 7))
    # A file that no line is asked of is not opened.
    (tmp_path / "a").unlink()
    one = index.filter("file like '%/b' and row_id = 2999").select("file", "row_id")
    assert [r.value for r in lookup_lines(index, one).collect()] == [lines["b"][2999]]
    (tmp_path / "b").write_bytes(b"short")
    with pytest.raises(Exception, match="ends before byte"):
        lookup_lines(index, one).collect()


def test_array_text_is_not_shuffled(spark, tmp_path):
    """Only the pieces around the ends of splits are grouped."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        values = [{"n": i, "t": "some, text [" * 5} for i in range(3000)]
        path = write(tmp_path / "f", json.dumps(values))
        rows = array_elements(spark, path)
        assert [json.loads(r.value.strip("[] \n") if 0 < r.idx < 2999 else r.value.strip("[] \n"))["n"]
                for r in sorted(rows.select("idx", "value").collect())] == list(range(3000))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        # By split or file for the small table, and one for the pieces that cross.
        assert sum("end_depth" in line and "idx" in line for line in moved) == 1
        observed = rows.observe("pieces", F.count(F.lit(1)).alias("n"))
        assert observed.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def array_values(spark, path):
    rows = read_json_array(spark, path).select("idx", F.to_json("v").alias("j")).collect()
    return [json.loads(r.j) for r in sorted(rows)]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", ["7", "37", "100000"])
def test_json_arrays(small_splits, tmp_path, indent, split):
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", split)
    rng = random.Random(6)
    words = ["a,b", '"', "\\", "],[", "}, {", "é你", "", "\\\\\"", "\n"]
    values = [
        rng.choice(
            [
                {"from": rng.choice(words), "value": [rng.choice(words), {"x": rng.choice(words)}]},
                rng.choice(words), 5, None, [], [1, [2, 3]], {}, True,
            ]
        )
        for _ in range(40)
    ]
    for name, data in (("one", values), ("two", values[::-1])):
        write(tmp_path / name, json.dumps(data, indent=indent, ensure_ascii=False))
    assert array_values(small_splits, str(tmp_path / "one")) == values
    both = read_json_array(small_splits, str(tmp_path)).count()
    assert both == 2 * len(values)


@pytest.mark.parametrize("text, n", [("[]", 0), (" [ ] \n", 0), ("[1]", 1), ('["a,]"]', 1)])
def test_short_arrays(small_splits, tmp_path, text, n):
    assert len(array_values(small_splits, write(tmp_path / "f", text))) == n


@pytest.mark.parametrize(
    "text", ["[1,]", "[1", "1]", "[1] [2]", "[1],[2]", '["a]', "[,1]", "[1}", "[[1]", "[1]]", "[", "[1 2]"]
)
def test_broken_arrays_fail(small_splits, tmp_path, text):
    with pytest.raises(Exception, match="not a JSON array"):
        array_values(small_splits, write(tmp_path / "f", text))


def test_long_strings_in_arrays(spark, tmp_path):
    values = ["z" * 50_000, "\"\\" * 30_000, {"a": "é" * 20_000}]
    assert array_values(spark, write(tmp_path / "f", json.dumps(values))) == values


def test_array_source_text(small_splits, tmp_path):
    path = write(tmp_path / "f", '[ {"a": 1.0, "b": 2} , 3 ]')
    rows = sorted(array_elements(small_splits, path).select("idx", "value").collect())
    assert [r.value for r in rows] == ['[ {"a": 1.0, "b": 2} ', " 3 ]"]


def test_jsonl_keeps_nulls(spark, tmp_path):
    df = spark.sql("SELECT array(named_struct('role','user','content',CAST(NULL AS STRING))) AS m")
    write_jsonl(df, f"{tmp_path}/o", "m")
    assert read_lines(spark, f"{tmp_path}/o").first().value == '[{"role":"user","content":null}]'


def test_sample_shards(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).alias("batch_id"), "id")
    write_samples(df, f"{tmp_path}/o", shards=3)
    back = spark.read.parquet(f"{tmp_path}/o").withColumn("f", F.col("_metadata.file_name"))
    assert back.count() == 100
    assert back.groupBy("batch_id").agg(F.countDistinct("f").alias("n")).filter("n > 1").count() == 0


RAW = ['{"text":"ab ab ab"}', "", "{bad", '{"text":"cd 你好"}', '{"text":5}', '{"text":"ab"}']
CHATS = [
    {"conversations": [{"from": "human", "value": "q,1"}, {"from": "gpt", "value": "a"}]},
    {"conversations": [{"from": "tool", "value": "q"}]},
    7,
]


def test_preparation_jobs(spark, tmp_path):
    raw = write(tmp_path / "raw.jsonl", "\n".join(RAW))
    for name, text in (
        ("array", json.dumps(CHATS, ensure_ascii=False)),
        ("jsonl", "\n".join(map(json.dumps, CHATS))),
    ):
        chats = write(tmp_path / name, text)
        out = f"{tmp_path}/out-{name}"
        done = prepare_all(spark, raw, f"{out}/p", chats, f"{out}/c")
        lost = {"blank_line": 1, "malformed": 1, "non_string": 1}
        assert done["pretrain"] == JobReport(True, 6, 3, lost)
        assert done["chat"] == JobReport(True, 3, 1, {"no_turns": 1, "not_object": 1})
        texts = [json.loads(r.value)["text"] for r in read_lines(spark, f"{out}/p").collect()]
        assert sorted(texts) == ["ab", "ab ab ab", "cd 你好"]
        (chat,) = [json.loads(r.value) for r in read_lines(spark, f"{out}/c").collect()]
        assert [m["role"] for m in chat] == ["system", "user", "assistant"]
    failed = prepare_all(spark, f"{tmp_path}/none", f"{tmp_path}/x", chats, f"{tmp_path}/y")
    assert failed["pretrain"] == JobReport(False) and failed["chat"].done


def test_tokenizer_job(spark, tmp_path):
    raw = write(tmp_path / "raw.jsonl", "\n".join(RAW))
    tok = train_tokenizer(spark, raw, f"{tmp_path}/tok", vocab_size=300)
    assert tok.merges[:1] == (("a", "b"),) and load_tokenizer(spark, f"{tmp_path}/tok") == tok
    assert train_tokenizer(spark, raw, vocab_size=300, max_lines=3).merges == (("a", "b"), ("Ġ", "ab"))
    assert train_tokenizer(spark, raw, vocab_size=300, test_mode=True) == tok


@pytest.mark.parametrize("kind, lines", [("pretrain", RAW), ("chat", [json.dumps(c) for c in CHATS])])
def test_stream_equals_batch(spark, tmp_path, kind, lines):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    for k in range(2):
        write(tmp_path / "in" / f"{k}.txt", "\n".join(lines))
        run = stream_prepare(spark, src, kind, out, mark)
        run.awaitTermination()
        counts = stream_counts(run)
        assert counts["read"] == len(lines) and counts["written"] == (3 if kind == "pretrain" else 1)
        assert counts["kept"] == (3 if kind == "pretrain" else 1)
        assert sum(n for c, n in counts.items() if c not in ("read", "written")) == len(lines)
    got = sorted(map(str, spark.read.parquet(out).collect()))
    want = sorted(map(str, prepare_lines(spark.read.text(src), kind).collect()))
    assert got == want and got


@pytest.mark.parametrize("kind", ["pretrain", "sft"])
def test_files_to_batches_and_again(spark, tmp_path, monkeypatch, kind):
    from corpusmill.plans import training
    from corpusmill.plans.training import pretrain_batches, sft_batches, write_file_batches
    from checks.inputs import byte_tokenizer

    tok = byte_tokenizer()
    (tmp_path / "in").mkdir()
    for k in range(2):
        turns = [{"role": "user", "content": f"q{k}"}, {"role": "assistant", "content": "a" * k}]
        records = [{"text": f"text {k} {i}"} if kind == "pretrain" else {"messages": turns} for i in range(57)]
        write(tmp_path / "in" / f"{k}.jsonl", "\n".join(["", *map(json.dumps, records), "{bad"]))
    once = write_file_batches(spark, str(tmp_path / "in"), tok, f"{tmp_path}/once", 4, kind, 24, shards=7)
    want = sorted(map(str, once.drop("shard").collect()))
    assert once.select("batch_id").distinct().count() == -(-once.count() // 4)
    assert once.groupBy("batch_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    # A run that is ended after its first shards is taken up where it was.
    encode, calls = training.pretrain_samples if kind == "pretrain" else training.sft_samples, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("ended")
        return encode(*args)

    name = "pretrain_samples" if kind == "pretrain" else "sft_samples"
    monkeypatch.setattr(training, name, failing)
    with pytest.raises(RuntimeError, match="ended"):
        write_file_batches(spark, str(tmp_path / "in"), tok, f"{tmp_path}/again", 4, kind, 24, shards=7, shards_per_job=3)
    first = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "again").rglob("*.parquet")}
    again = write_file_batches(spark, str(tmp_path / "in"), tok, f"{tmp_path}/again", 4, kind, 24, shards=7, shards_per_job=3)
    assert sorted(map(str, again.drop("shard").collect())) == want and len(calls) == 4
    assert first.items() <= {p.name: p.stat().st_mtime_ns for p in (tmp_path / "again").rglob("*.parquet")}.items()
    assert not (tmp_path / "again-ordered").exists()
    # And it is what the plan without files gives.
    lines = number_lines(read_lines(spark, str(tmp_path / "in")), "row_id")
    monkeypatch.undo()
    if kind == "pretrain":
        from corpusmill.operators.records import valid_texts

        plain = pretrain_batches(valid_texts(lines).select("row_id", "text"), tok, 4, 24)
    else:
        from corpusmill.operators.records import render_records

        plain = sft_batches(render_records(lines).select("row_id", "rendered"), tok, 4, 24)
    assert sorted(map(str, plain.select(*once.drop("shard").columns).collect())) == want
