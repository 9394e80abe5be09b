"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and columns named like the operators' own."""
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import common, decontaminate, html_text, line_dedup, mixing, ppm, quality, secrets, simhash, substrings, warc

LINE = "this line is long enough to count as a shared one"
PROSE = " ".join(f"word{k}" for k in range(80))
LONG = " ".join(f"w{k % 977}x{k}" for k in range(60_000))


@pytest.fixture(scope="module")
def odd(docs_of):
    """Nulls in id, text and source; empty and blank texts; a long one; repeated rows; an id used twice."""
    return docs_of([(1, None), (2, ""), (3, " \n\t\x0b "), (4, PROSE), (4, PROSE), (4, PROSE + " tail"), (5, LONG, None), (None, PROSE), (None, None), (7, "ſ É ñ\U0001f600 A\x00b", None)]).cache()


@pytest.fixture(scope="module")
def none(docs_of, odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"WORD{k}" for k in range(20, 34))), (2, None), (None, "w5x5 w6x6"), (3, "..."), (1, "repeated id item"), (4, " ".join(f"word{k}" for k in range(20, 34)))],
                                 "item_id bigint, text string")


def test_ppm(odd, none):
    held = F.coalesce(F.col("doc_id") == 5, F.lit(False))
    rows = ppm.ppm_scores(odd, held).collect()
    assert len(rows) == 10 and {r._symbols for r in rows if not r._row.text} == {1}
    assert len({r._score for r in rows if r._row.text == PROSE}) == 1
    assert all(r._tokens == 1 and r._known == 1 for r in rows if not (r._row.text or "").strip(" \n\t\x0b"))
    assert ppm.ppm_scores(none, held).count() == 0
    untrained = ppm.ppm_scores(odd, F.lit(True)).collect()
    assert all(r._base == 0 and r._train_tokens == 0 and r._score < 0 for r in untrained)


def test_quality(odd, none):
    kept = quality.quality_filter(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0, len(r.text)) for r in kept.collect()) == sorted([(0, len(PROSE)), (4, len(PROSE)), (4, len(PROSE)), (4, len(PROSE) + 5)])  # the long text is mostly digits
    assert quality.quality_filter(none).count() == 0


def test_quality_order_follows_rejection_per_cost(docs_of):
    docs = docs_of([(k, "few words") for k in range(30)])
    planned = quality.plan_cascade(docs, quality.rules(F.col("text")), "doc_id")
    assert {name for name, _, _ in planned} == set(quality.rules(F.col("text")))
    assert [m[1] / m[2] for m in planned] == sorted((m[1] / m[2] for m in planned), reverse=True)


def test_line_dedup(odd, none, docs_of):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == 10 and all(r._kept == (r._row.text or "") and r._dropped == 0 for r in rows)
    assert line_dedup.dedup_lines(none).count() == 0
    docs = docs_of([(k, f"{LINE.upper()} \n own {k}\n\t{LINE}\nshort\n") for k in range(4)] + [(9, f" {LINE}"), (None, LINE)])
    got = {r._row.doc_id: (r._kept, r._lines, r._dropped) for r in line_dedup.dedup_lines(docs).collect()}
    assert got[9] == (f" {LINE}", 1, 0) and got[None] == ("", 1, 1)
    assert all(got[k] == (f" own {k}\nshort\n", 5, 2) for k in range(4))
    four = docs_of([(k, LINE) for k in range(4)])
    assert all(r._dropped == 0 for r in line_dedup.dedup_lines(four).collect())


def test_minimal_perfect_hash():
    digests = [hashlib.md5(str(k).encode()).digest() for k in range(5000)]
    hi, lo = line_dedup._halves(digests)
    found = line_dedup.MinimalPerfectHash.build(hi, lo)
    assert sorted(found.slots(hi, lo).tolist()) == list(range(5000))
    assert len(line_dedup.MinimalPerfectHash.build(hi[:0], lo[:0]).bits) == 0


def test_html(spark):
    page = "<title>x</title><nav>menu</nav><article><h1>A&nbsp;&lt;b&gt; </h1><p>one<br>two<p>three < 4 <script>var a='</p>';</script></article> tail"
    rows = [(1, "http://h/1", page, "s"), (1, "http://h/1", page, "s"), (2, None, None, "s"), (None, "not a url", "", "s"), (3, "http://h/2", "<article><p>cut off <b", "s"),
            (4, "http://h/3", "<p>" + "long " * 50_000, "s"), (5, "http://h/4", "plain text", "s"), (6, "http://h/5", "<!-- never closed <p>x</p>", "s")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, slot string")
    got = [(r._row.page_id, r._main) for r in html_text.extract(pages).collect()]
    assert got.count((1, "A <b>\none two\nthree < 4")) == 2
    assert dict(got) | {1: ""} == {1: "", 2: "", None: "", 3: "cut off", 4: ("long " * 50_000).strip(), 5: "plain text", 6: ""}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_copies_are_no_template(spark):
    pages = spark.createDataFrame([(k, f"http://h/{k}", "<body><article><p>The same story everywhere.</p></article></body>") for k in range(9)], "page_id bigint, url string, html string")
    assert {r._main for r in html_text.extract(pages).collect()} == {"The same story everywhere."}


def test_mixing_numbers_sources_without_python_rdds(spark, monkeypatch):
    """A Python RDD starts workers of its own, beside those of the SQL functions, and they stay."""
    names = [f"s{k:03d}" for k in range(50)] + [None]
    sized = spark.createDataFrame([(n, 100) for n in names], "source string, size bigint").repartition(7)

    def refused(self):
        raise AssertionError("a Python RDD")
    with monkeypatch.context() as m:
        m.setattr(type(sized), "rdd", property(refused))
        targets = {r.source: r.target for r in mixing.source_targets(sized, weights=(3, 2, 1), share=0.5).collect()}
    level = targets["s002"]
    assert [round(targets[n] / level, 6) for n in names] == [(3, 2, 1)[k % 3] for k in range(51)]


def test_mixing(odd, none, docs_of):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 10 and all(0 <= r._copies <= 2 for r in rows)
    assert {r._source_size for r in rows if r._row.source is None} == {60_000 + 4} and all(r._copies == 1 for r in rows if r._size == 0)
    assert mixing.mix(none).count() == 0
    empty = mixing.mix(docs_of([(k, None) for k in range(3)])).collect()
    assert [(r._target, r._copies) for r in empty] == [(0.0, 1)] * 3
    hot = mixing.mix(docs_of([(k, "a b c d", "a") for k in range(3000)] + [(k, "a b", "b") for k in range(3000, 3300)])).collect()
    taken = sum(r._copies * r._size for r in hot if r._row.source == "a")
    assert abs(taken - next(r._target for r in hot if r._row.source == "a")) <= 4


def test_substrings(odd, none, docs_of):
    rows = substrings.remove_repeats(odd).collect()
    assert len(rows) == 10
    for r in rows:
        text = (r._row.text or "").encode()
        assert r._bytes == len(text) and r._kept == (b"" if r._row.text == PROSE else b" tail" if r._row.doc_id == 4 else text)
    assert substrings.remove_repeats(none).count() == 0
    runs = substrings.remove_repeats(docs_of([(1, "a" * 199), (2, "a" * 200), (3, "b" * 201), (4, "c" * 5000)])).collect()
    assert {r._row.doc_id: r._removed for r in runs} == {1: 0, 2: 0, 3: 201, 4: 5000}


def test_warc(spark, tmp_path):
    rows = [(1, "http://h/\r\nX: y", "same", "s"), (2, None, "same", "s"), (None, "u", "same", "s"), (3, "u", None, "s"), (4, "u", "", "s"), (5, "u", "\r\n\r\nWARC/1.1\r\n" * 9, "s"),
            (6, "ü", "é" * 100_000, "s"), (1, "http://h/", "same", "s")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, body string")
    index = warc.write_archives(warc.plan_records(pages), f"file://{tmp_path}/a", archive_bytes=300)
    got = warc.read_records(index).collect()
    by_id = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in got}
    assert len(got) == 8 and index.select("path").distinct().count() > 1
    assert by_id == {1: (4, "response", None, "same"), 2: (4, "revisit", 1, ""), None: (4, "revisit", 1, ""), 3: (0, "response", None, ""), 4: (0, "revisit", 3, ""),
                     5: (126, "response", None, "\r\n\r\nWARC/1.1\r\n" * 9), 6: (200_000, "response", None, "é" * 100_000)}
    chosen = warc.read_records(index.filter("page_id IN ('2', '6')")).collect()
    assert sorted(r.page_id for r in chosen) == [2, 6]
    nothing = warc.write_archives(warc.plan_records(pages.limit(0)), f"file://{tmp_path}/b")
    assert warc.read_records(nothing).count() == 0
    assert warc.plan_records(pages, min_bytes=5).filter("refers_to IS NOT NULL").count() == 0


def test_warc_reads_are_dealt_by_bytes(spark, tmp_path, monkeypatch):
    """One archive, its index in one tiny file: the bytes to read decide the number of tasks."""
    pages = spark.range(300).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(string(id), 256), 20) AS html").coalesce(1)
    index = warc.write_archives(warc.plan_records(pages), f"file://{tmp_path}/a")
    total = index.agg({"length": "sum"}).first()[0]
    monkeypatch.setattr(warc, "TASK_BYTES", total // 6 + 1)
    got = warc.read_records(index)
    assert got.rdd.getNumPartitions() == 6
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got.collect()) == sorted((r.page_id, r.html) for r in pages.collect())


def test_coalesced_reads():
    assert warc.coalesced([(0, 10), (10, 5), (30, 5), (500, 5)], gap=20, most=100) == [(0, 35, [(0, 10), (10, 5), (30, 5)]), (500, 505, [(500, 5)])]


def test_simhash(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    of = {(r._row.doc_id, r._row.text): r._component for r in rows}
    assert len(rows) == 10 and of[1, None] == of[2, ""] == of[3, " \n\t\x0b "] == of[None, None] == 1 and of[None, PROSE] == of[4, PROSE] == 4
    assert simhash.near_duplicates(none).count() == 0


def test_secrets(odd, none, docs_of):
    rows = secrets.find_secrets(odd).collect()
    assert len(rows) == 10 and all(r._spans == [] and r._base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets.find_secrets(none).count() == 0
    long = docs_of([(1, "x = '" * 20_000 + "token = abcdef1"), (2, "a = a + " * 20_000)])
    assert {r._row.doc_id: len(r._spans) for r in secrets.find_secrets(long).collect()} == {1: 1, 2: 0}


def test_decontaminate(odd, none, benchmark):
    rows = decontaminate.decontaminate(odd, benchmark).collect()
    assert len(rows) == 10
    for r in rows:
        if (r._row.text or "").startswith(PROSE):
            assert [(s.first, s.last) for s in r._spans] == [(20, 33)] and r["_items"] == ["1", "4"]
            assert [r._row.text[o.start:o.end] for o in r._offsets] == [" ".join(f"word{k}" for k in range(20, 34))]
        elif r._row.text == LONG:
            assert r["_items"] == [""] and len(r._spans) == 1
        else:
            assert r._spans == [] and r["_items"] == []
    assert decontaminate.decontaminate(none, benchmark).count() == 0
    assert all(r._spans == [] for r in decontaminate.decontaminate(odd, benchmark.limit(0)).collect())
    blocks = decontaminate.decontaminate(odd, benchmark, block_bytes=200)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, rows))
    # the last block's scan and the offsets: no stage holds the automata of two blocks
    assert blocks._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2


def test_key_filter(spark):
    keys = spark.createDataFrame([(k, k % 7) for k in range(500)] + [(None, 1)], "a bigint, b int")
    member = common.key_filter(keys)
    rows = spark.createDataFrame([(k, k % 7) for k in range(1000)] + [(None, 1)], "a bigint, b int")
    inside = rows.mapInArrow(common.passing(member, "a", "b", True), rows.schema).collect()
    outside = rows.mapInArrow(common.passing(member, "a", "b", False), rows.schema).collect()
    assert len(inside) + len(outside) == 1001 and {tuple(r) for r in inside} >= {tuple(r) for r in keys.collect()} and len(inside) < 520


def test_stages_keep_columns(spark, odd, none):
    import corpus_pipeline
    for docs, least in ((odd, 1), (none, 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, "/root/testdata/sf0.001"))
            if name != "source_mixing":
                assert docs.columns == odd.columns
            assert docs.count() >= least, name


def test_ppm_counts_in_little_memory():
    """Counting 6 MB of text holds grams of a part of it and few words at a time; the counts are those of all of it."""
    import tracemalloc
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 300_000, 6_000))) for _ in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([False] * len(texts))], names=["_text", "_out"])
    grams = words = 0
    tracemalloc.start()
    for out in ppm._count(ppm.ORDER)(iter([batch])):
        n = out.column("n").to_numpy()
        is_word = out.column("gram").is_null().to_numpy(zero_copy_only=False)
        grams, words = grams + n[~is_word].sum(), words + n[is_word].sum()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert grams == sum(len(t) + 1 for t in texts) and words == 150 * 6_001
    assert peak < 100 << 20


def test_ppm_prices_in_little_memory():
    """The answers to a chunk peak at about four columns of longs, not seven; the arrays are those of all answers, by gram."""
    import tracemalloc
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    grams = rng.permutation(400_000).astype(np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(g), pa.nulls(len(g), pa.binary()), pa.array(g / 2.0)], names=["gram", "word", "value"]) for g in np.split(grams, 100)]
    known = ppm._Prices()
    tracemalloc.start()
    for b in batches:
        known.add(b)
    got, prices = known.arrays()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == np.arange(400_000)).all() and (prices == got / 2.0).all()
    assert peak < 40 * len(grams)
    known.add(pa.RecordBatch.from_arrays([pa.array([-1, -1]), pa.array([b"a", b"b"]), pa.array([2.0, 2.0])], names=["gram", "word", "value"]))
    assert known.counts["a".encode()] is known.counts["b".encode()] and known.counts[b"a"] == float(np.log10(3.0))
    assert ppm._union([np.zeros(0, np.int64), np.array([3, 1]), np.array([3])]).tolist() == [1, 3]
