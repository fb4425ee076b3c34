"""Classifier, line rules and language model: plain versions, trained behaviour, hard cases."""

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import line_crf, nbsvm, ppm
from tests.llm import brute
from tests.llm.conftest import prose, tuples


def labelled(spark):
    good = [(i, prose(i, 120), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "###" for w in prose(500 + i, 120).split()), 0) for i in range(30)]
    shout = [(200 + i, prose(700 + i, 120).upper().replace(" ", "!! "), 0) for i in range(30)]
    rows = good + bad + shout
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(1, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = nbsvm.quality_model(docs, labels, lambda rows: rows.filter("doc_id % 3 <> 0"))
    held = nbsvm.scored(docs, model).join(labels.dropna(), "doc_id").filter("doc_id % 3 = 0").collect()
    assert len(held) > 30 and all((r.score >= 0.7) == (r.quality == 1) for r in held)


def test_scores_of_hard_cases(spark, docs, empty):
    known, labels = labelled(spark)
    scored = nbsvm.scored(docs, nbsvm.quality_model(known, labels))
    assert scored.columns == docs.columns and scored.count() == docs.count()
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert nbsvm.scored(empty, nbsvm.quality_model(known, labels)).count() == 0
    one_class = nbsvm.quality_model(known, labels.filter("quality = 1"))
    assert abs(nbsvm.scored(known, one_class).first().score - 61 / 62) < 1e-6
    nothing = nbsvm.quality_model(known, labels.filter("false"))
    assert abs(nbsvm.scored(known, nothing).first().score - 0.5) < 1e-6


def test_dual_coordinate_descent_separates():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 1]), np.array([3, 2])]
    ones = [np.ones(2)] * 4
    weights, shift = nbsvm.dual_coordinate_descent(rows, ones, np.array([1.0, 1, -1, -1]), cost=10, rounds=50)
    assert [np.sign(weights[r].sum() + shift) for r in rows] == [1, 1, -1, -1]
    assert weights[0] > 0.4 and weights[3] < -0.4 and abs(weights[1]) < 0.2


def test_line_rules_equal_brute_force(spark, docs, pairs, empty):
    found = line_crf.line_rules(docs, line_crf.EVEN)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert tuples(found, *names) == sorted(((i, *brute.quality_rules(t)) for i, t in pairs), key=repr)
    assert found.filter("kept and base_failed").count() == 0
    assert line_crf.line_rules(empty, line_crf.EVEN).count() == 0


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(3)
    for n in (1, 2, 7):
        model = line_crf.LineModel(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=n).tolist()

        def weight(path):
            total = model.start[path[0]] + sum(s for s, y in zip(scores, path) if y)
            return total + sum(model.move[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=weight)
        assert model.decode(scores) == [bool(y) for y in best]


def test_gradient_steps_reach_the_optimum():
    """Chains of one line are a logistic regression with a known answer."""
    chains, labels = [], []
    for feature, ones in ((1, 8), (2, 2)):
        for k in range(10):
            row = np.zeros((1, line_crf.N_FEATURES))
            row[0, feature] = 1
            chains.append(row)
            labels.append(int(k < ones))
    model = line_crf.train(chains, np.array(labels), rounds=600, decay=0.0)
    start = model.start[1] - model.start[0]
    for feature, share in ((1, 0.8), (2, 0.2)):
        assert abs(1 / (1 + np.exp(-(start + model.emit[feature]))) - share) < 0.02


def test_line_field_learns_boilerplate(spark):
    docs, labels = labelled(spark)
    model = line_crf.fit(docs, labels.filter("doc_id % 3 <> 0"))
    held = line_crf.line_rules(docs, model).join(labels.dropna(), "doc_id").filter("doc_id % 3 = 0").collect()
    assert all(r.kept == (r.quality == 1) for r in held)
    assert line_crf.fit(docs, labels.filter("false")) is line_crf.EVEN


def test_lines_of_mixed_documents(spark):
    """Good lines between junk, and junk between good lines: each line is marked for itself."""
    import random

    rng = random.Random(2)
    licence = "ALL RIGHTS RESERVED $$$ COPY ONLY WITH NOTICE %%%"
    junk = lambda: " ".join("#" * rng.randint(3, 9) + rng.choice("ab") for _ in range(12))
    good = lambda k: [line for line in prose(k, 90).replace(". ", ".\n").split("\n")]
    rows, labels = [], []
    for i in range(60):
        lines = good(i)
        lines.insert(rng.randint(1, len(lines)), licence)
        rows.append((i, "\n".join(lines)))
        rows.append((100 + i, "\n".join(junk() for _ in range(10))))
        labels += [(i, 1), (100 + i, 0)]
    copies = [(500 + k, rows[0][1]) for k in range(9)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string").repartition(3)
    hashes = docs.select(F.explode(F.split("text", "\n")).alias("line")).select("line", F.xxhash64("line").alias("hash"))
    shared = {r.line for r in line_crf.common_lines(docs, hashes, 3).join(hashes, "hash").select("line").distinct().collect()}
    assert shared == {licence}
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    plain = line_crf.fit(docs, labels)
    model = line_crf.fit(docs, labels, common=3)

    def marks(lines, model=model):
        own = line_crf.read("\n".join(lines).encode())[1]
        return model.decode([float(sum(model.emit[k] for k in f)) for f, _ in own])

    mixed = [*good(900)[:4], *[junk() for _ in range(3)], *good(901)[:4]]
    assert marks(mixed) == marks(mixed, plain) == [True] * 4 + [False] * 3 + [True] * 4
    again = good(904)[:5]
    assert marks([*again, again[0], again[0]], plain)[:5] == [True] * 5
    assert marks([licence, *good(902)[:5]]) == [False] + [True] * 5
    table = spark.createDataFrame([(1, "\n".join(mixed)), (2, rows[1][1]), (3, "\n".join(good(903)))], "doc_id int, text string")
    share = {r.doc_id: r.content_share for r in line_crf.line_rules(table, model).collect()}
    assert 0.5 < share[1] < 0.9 and share[2] == 0 and share[3] == 1


def plain_ppm(train, text, order=4):
    """Log10 probability of a text and its end, symbol by symbol."""
    nodes = {}
    for t in train:
        b = b"\0" * order + t + b"\0"
        for i in range(order, len(b)):
            for k in range(order + 1):
                node = nodes.setdefault(b[i - k : i], {})
                node[b[i]] = node.get(b[i], 0) + 1
    total, b = 0.0, b"\0" * order + text + b"\0"
    for i in range(order, len(b)):
        p, out = 1.0, set()
        for k in range(order, -1, -1):
            node = {s: n for s, n in nodes.get(b[i - k : i], {}).items() if s not in out}
            if not node:
                continue
            n, kinds = sum(node.values()), len(node)
            out |= set(node)
            if len(out) == 256:
                kinds = 0
            if b[i] in node:
                p *= node[b[i]] / (n + kinds)
                break
            p *= kinds / (n + kinds)
        else:
            p /= 256 - len(out)
        total += np.log10(p)
    return total


def test_model_scores_equal_a_plain_trie(docs, pairs):
    learn = docs.filter("doc_id % 2 = 0 and length(text) < 4000")
    train = [brute.raw(t) for i, t in pairs if i is not None and i % 2 == 0 and t is not None and len(t) < 4000]
    # A bound above the number of bytes keeps every node.
    rows = ppm.score_texts(docs, learn, nodes=1 << 30).collect()
    assert len(rows) == len(pairs)
    scores = {r.doc_id: r.score for r in rows}
    for i, t in pairs:
        if len(t or "") < 400:
            assert abs(scores[i] - plain_ppm(train, brute.raw(t))) < 1e-3 * max(1, len(t or "")), t


def test_rare_contexts_score_as_in_a_plain_trie(docs, pairs):
    learn = docs.filter("doc_id % 2 = 0 and length(text) < 4000")
    train = [brute.raw(t) for i, t in pairs if i is not None and i % 2 == 0 and t is not None and len(t) < 4000]
    # With few strings in the task, nearly all go by the join.
    scores = {r.doc_id: r.score for r in ppm.score_texts(docs, learn, nodes=10).collect()}
    for i, t in pairs:
        if len(t or "") < 400:
            assert abs(scores[i] - plain_ppm(train, brute.raw(t))) < 1e-6 * max(1, len(t or "")), t


def test_base_scores_equal_brute_force(docs, pairs):
    known = [p for p in pairs if p[0] is not None]
    own = docs.filter("doc_id is not null")
    learn = own.filter(ppm.F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
    # With few frequent words, nearly all words go by the join.
    for frequent in (1 << 20, 10):
        rows = ppm.score_texts(own, learn, frequent=frequent).collect()
        expected = brute.base_scores(known)
        assert len(rows) == len(known)
        for r in rows:
            _, n, k, total, base = expected[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, total)
            assert abs(r.base_score - base) < 1e-9 * max(1, abs(base))


def test_scores_without_training_texts(docs, empty):
    rows = ppm.score_texts(docs, empty).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)
    sizes = {r.doc_id: len(brute.raw(r.text)) for r in docs.collect()}
    assert all(abs(r.score + (sizes[r.doc_id] + 1) * np.log10(256)) < 1e-2 * (1 + sizes[r.doc_id]) for r in rows)
    assert ppm.score_texts(empty, docs.select("doc_id", "text")).count() == 0
