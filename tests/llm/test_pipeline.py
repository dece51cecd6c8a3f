"""The pipeline, stage by stage, against plain Python on what the stage before has kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from lendscope.llm import line_dedup, mixing
from lendscope.llm.tables import table, written

from . import brute


def test_stages(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, small_dir))
        seen.append(name)
        if len(seen) < len(corpus_pipeline.STAGES):
            assert after.columns == columns
        before = {r.doc_id: r for r in docs.collect()}
        rows = after.collect()
        if len(seen) == 1:
            labels = {r.doc_id: r.quality for r in table(spark, small_dir, "labels").collect()}
            kept = {r.doc_id for r in rows}
            good = [i for i, q in labels.items() if q == 1]
            assert all(before[r.doc_id] == r for r in rows) and sum(i in kept for i in good) >= 0.9 * len(good)
            assert sum(labels.get(i) == 0 for i in kept) < sum(q == 0 for q in labels.values()) / 2
        elif len(seen) == 2:
            ids = sorted(before)
            want = brute.without_boilerplate([(before[i].source, before[i].text) for i in ids], line_dedup.RATIO, line_dedup.MIN_PAGES)
            assert {r.doc_id: (r.text, r.n_chars) for r in rows} == {i: (w[0], len(w[0])) for i, w in zip(ids, want, strict=True)}
        elif len(seen) == 3:
            want = brute.near_duplicates({i: r.text for i, r in before.items()})
            assert {r.doc_id for r in rows} == {i for i, w in want.items() if w[2]} and all(before[r.doc_id] == r for r in rows)
        elif len(seen) == 4:
            size = {}
            for r in before.values():
                size[r.source] = size.get(r.source, 0) + len(brute.WORD.findall(r.text))
            got = {}
            for r in rows:
                got[r.source] = got.get(r.source, 0) + len(brute.WORD.findall(r.text))
                assert before[r.doc_id].text.split()[:3] == r.text.split()[:3] or r.n_chars < 40
            want = brute.targets(size)
            assert all(abs(got.get(s, 0) - want[s]) <= 1 for s in want)
        else:
            pieces = after.groupBy("sequence_id").sum("length").collect()
            assert max(r[1] for r in pieces) <= 2048
            assert {r.doc_id for r in rows} == set(before)
        docs = after
    assert seen == [name for name, _ in corpus_pipeline.STAGES]


def test_one_of_many_copies_stays(spark, small_dir):
    same = "\n".join(f"line {k} of the text that a third of all rows hold" for k in range(12))
    near = [f"passage {k} with some words about the matter of near copies" for k in range(30)]
    rows = [(i, "web", same) for i in range(40)]
    rows += [(100 + i, "web", "\n".join([*near, f"version {i}"])) for i in range(40)]
    rows += [(200 + i, "web", "menu of the site\n" + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40)]
    rows += [(None, "web", same), (300, None, same), (301, "web", None), (302, "web", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_chars", F.length("text"))
    docs = docs.withColumn("kept", F.lit(1)).withColumn("host", F.lit("h"))
    after = written(corpus_pipeline.drop_boilerplate(spark, docs, small_dir))
    assert after.columns == docs.columns and after.count() == docs.count()
    texts = {r.doc_id: r.text for r in after.collect()}
    assert texts[0] == same and texts[100] == "\n".join([*near, "version 0"]) and texts[300] == same
    assert all("menu" not in texts[200 + i] and texts[200 + i].endswith(f"w{i}x29") for i in range(40))
    left = [r.text for r in corpus_pipeline.drop_near_copies(spark, after, small_dir).collect()]
    assert left.count(same) == 1 and sum("passage 7" in (t or "") for t in left) == 1
    assert corpus_pipeline.drop_boilerplate(spark, docs.limit(0), small_dir).count() == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return written(df.withColumns({"size": F.lit(1), "taken": F.lit("t"), "its_row": F.lit(0), "rep": F.lit(2), "component_id": F.lit("c")}))


def _words(n, seed):
    return " ".join(f"w{seed}x{k}" for k in range(n))


def test_near_copies_of_odd_rows(spark, small_dir):
    """Rows without id, with a repeated id, exact repeats, texts without words: one row of each group stays, no other goes."""
    near = _words(40, 1) + " tail"
    rows = [(None, _words(30, 0), "a"), (None, _words(30, 9), "a"), (5, _words(40, 1), "a"), (5, _words(40, 1), "a"), (5, _words(30, 2), None),
            (3, near, "a"), (None, near, "b"), (7, None, "a"), (8, "", "a"), (8, "", "a"), (None, " \t", None)]
    docs = _docs(spark, rows)
    after = corpus_pipeline.drop_near_copies(spark, docs, small_dir)
    assert after.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in after.collect()), key=repr)
    assert left == sorted([(None, _words(30, 0)), (None, _words(30, 9)), (5, _words(30, 2)), (3, near), (7, None), (8, ""), (8, ""), (None, " \t")], key=repr)


def test_mix_of_odd_rows(spark, small_dir):
    """The mixed table holds the words that the plan takes, rows without id or that repeat one included."""
    rows = [(None, _words(10, 0), "a"), (None, _words(6, 1), "a"), (4, _words(9, 2), "b"), (4, _words(9, 2), "b"), (4, _words(9, 3), "b"),
            (6, _words(1, 4), None), (7, None, "b"), (8, "", None)]
    docs = _docs(spark, rows)
    plan = mixing.mix(docs.select("doc_id", "source", "text")).agg(F.sum("taken")).first()[0]
    mixed = corpus_pipeline.mix_sources(spark, docs, small_dir)
    assert mixed.columns == docs.columns
    got = [r.text for r in mixed.collect()]
    assert sum(len(t.split()) for t in got) == plan == 44
    assert all(any((own or "").startswith(t) for _, own, _ in rows) for t in got)


def test_stages_of_nothing(spark, small_dir):
    docs = _docs(spark, [(1, "a b", "s")]).limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, small_dir).count() == 0
    assert corpus_pipeline.keep_good(spark, docs, small_dir).count() == 0
    assert corpus_pipeline.pack(spark, _docs(spark, [(None, "one two", "s"), (1, None, "s"), (1, "x", "s"), (1, "x", "s")]), small_dir).count() >= 4


def test_quality_of_odd_rows(spark, small_dir):
    """A row's fate depends on its text alone: equal texts go or stay together, whatever their ids."""
    good = table(spark, small_dir, "labels").where("quality = 1").select("doc_id").join(table(spark, small_dir, "documents"), "doc_id").first().text
    docs = _docs(spark, [(None, good, "a"), (1, good, "b"), (1, good, "b"), (2, None, "a"), (None, "", "a")])
    after = corpus_pipeline.keep_good(spark, docs, small_dir)
    assert after.columns == docs.columns and after.where(F.col("text") == good).count() in (0, 3)
