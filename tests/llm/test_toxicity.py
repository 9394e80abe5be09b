"""Toxicity: gradient, planted documents, held-out labels, offending sentences, odd rows."""
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import toxicity as T

from .conftest import SF, WIDE  # noqa: F401

CLEAN = "The river runs past {}. We met there in the {}! Was it late? It was a fine day, and {} said so"
WORDS = [f"{a}{b}" for a in ("mor", "tel", "ban", "rik", "sul", "pen") for b in ("o", "ani", "etu", "al", "ine", "us")]


def corpus(n=400):
    rows, labels = [], []
    for k in range(n):
        text = CLEAN.format(*(WORDS[(k * p + q) % len(WORDS)] for p, q in ((1, 0), (5, 2), (7, 3))))
        toxic = k % 4 == 0
        text += f". You {('grubbing', 'grubbed', 'grubs')[k % 3] if toxic else 'went'} {WORDS[k % 11]}. Good bye."
        rows.append((k, text))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, docs_of):
    rows, labels = corpus()
    labels = spark.createDataFrame([(None, 1), (3, 0), (3, 0), (999_999, 1), (5, None), (6, 7), *labels], "doc_id bigint, toxic int")
    return T.fit(docs_of(rows), labels.filter(~T.held_out(labels["doc_id"])))


def test_gradient():
    some = np.random.default_rng(1)
    text = pa.array(["One two. three four!", "five", "", "two three. one " * 30], pa.string())
    (data, offsets, rows, _), = T._pieces(text)
    found = T.instances(data, offsets, np.arange(1 << 18) % 50)
    found["doc"] = rows[found["span"]]
    labels, theta = np.array([1, 0, 1, 0]), some.normal(0, 0.3, 52) - np.r_[np.zeros(50), 2, 2]
    _, gradient = T.loss_and_gradient(found, labels, theta)
    for k in (*range(0, 50, 7), 50, 51):
        e = np.eye(52)[k] * 1e-6
        assert abs((T.loss_and_gradient(found, labels, theta + e)[0] - T.loss_and_gradient(found, labels, theta - e)[0]) / 2e-6 - gradient[k]) < 1e-5


def test_instances():
    text = pa.array(["A b. C d!\nE", None, " ", "word " * 70, "é1x a"], pa.string())
    (data, offsets, rows, _), = T._pieces(text)
    found = T.instances(data, offsets, np.arange(T.FEATURES))
    spans = [(int(rows[s]), data[a:b].tobytes().decode()) for s, a, b in zip(found["span"], found["start"], found["end"])]
    assert [x for x in spans if x[0] != 3] == [(0, "A b"), (0, "C d"), (0, "E"), (4, "é1x a")]
    assert [len(x[1].split()) for x in spans if x[0] == 3] == [32, 32, 6]
    assert len(set(found["word"][found["sentence"] == 3])) == len(found["word"][found["sentence"] == 3]) == 1  # each word once a sentence


def test_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(T, "SPAN_BYTES", 64)
    monkeypatch.setattr(T, "PIECE_BYTES", 100)
    text = pa.array(["Some words here. " * 20, "x" * 300, "", "no stop at all " * 12], pa.string())
    seen = {}
    for data, offsets, rows, starts in T._pieces(text):
        for a, b, r, s in zip(offsets[:-1], offsets[1:], rows, starts):
            assert len(seen.get(int(r), b"")) == s
            seen[int(r)] = seen.get(int(r), b"") + data[a:b].tobytes()
    assert [seen[k].decode() for k in range(4)] == text.to_pylist()


def test_planted_documents(model, docs_of):
    clean = [(k, CLEAN.format("stones", "winter", "Ana") * (1 + k % 3)) for k in range(1000, 1040)]
    toxic = [(k, t + ". Nobody likes a grubber. " + "More of the river. " * 40) for k, t in ((k + 5000, t) for k, t in clean)]
    scores = {r._row.doc_id: r._score for r in T.toxicity_scores(docs_of(clean + toxic), model).collect()}
    assert all(scores[k] >= T.THRESHOLD for k, _ in toxic) and all(scores[k] < T.THRESHOLD for k, _ in clean)
    found = T.toxic_sentences(docs_of(toxic), model).collect()
    assert {r._sentence for r in found} == {"Nobody likes a grubber"}
    text = dict(toxic)
    assert all(text[r._row.doc_id].encode()[r._start:r._end].decode() == r._sentence for r in found)


def test_held_out_and_scores(spark):
    got = {r.doc_id: r for r in T.query(spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall()
    assert set(got) == {r[0] for r in rows}
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    found = [(r.score, labels[r.doc_id]) for r in T.query(spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in found if y == 1], [s for s, y in found if y == 0]
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.85
    assert sum(s >= 0.3 for s in clean) <= 0.02 * len(clean)


def test_odd_rows(model, docs_of, spark):
    rows = [(1, None), (2, ""), (3, " \n.!?"), (None, "You grubs"), (4, "You grubs"), (4, "You grubs"), (5, "plain words " * 60_000 + ". You grubs"), (6, "\U0001f600 ſ É\x00")]
    got = T.toxicity_scores(docs_of(rows), model).collect()
    by = {(r._row.doc_id, r._row.text): r._score for r in got}
    assert len(got) == len(rows) and by[1, None] == by[2, ""] == by[3, " \n.!?"] == pytest.approx(model.leak)
    assert by[None, "You grubs"] == by[4, "You grubs"] > 0.3 < by[5, rows[6][1]]
    none = docs_of(rows).limit(0)
    assert T.toxicity_scores(none, model).count() == T.toxic_sentences(none, model).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    untaught = T.fit(docs_of(rows), empty)
    assert {r._score for r in T.toxicity_scores(docs_of(rows), untaught).collect()} == {0.0} and T.toxic_sentences(docs_of(rows), untaught).count() == 0
