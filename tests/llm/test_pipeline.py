import zlib

import numpy as np

import corpus_pipeline
from shelfmark.llm import decontam


def test_pipeline_stages(spark, tmp_path):
    """Each stage takes effect on its own case and leaves the clean documents alone."""
    import random

    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(3, 9))) for _ in range(800)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows, labels = [], []
    for i in range(120):
        toxic = i % 5 == 0
        t = text(90)
        rows.append((i, t + (" horridword " + text(5) if toxic else ""), "en", "s", len(t)))
        if zlib.crc32(str(i).encode()) % 4 != 2:
            labels.append((i, 1, int(toxic)))
    clean = rows[1][1].split()
    near = " ".join(clean[:80] + [f"q{i}" for i in range(10)])
    shared = text(60)
    rows += [(200, near, "en", "s", len(near)), (201, text(70) + "\n" + shared, "en", "s", 0), (202, text(70) + "\n" + shared + "\n" + text(3), "en", "s", 0)]
    item = text(40)
    rows += [(203, text(60) + " " + item + " " + text(30), "en", "s", 0), (204, None, None, None, None), (205, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{i}"))
        before, docs = docs.columns, spark.read.parquet(str(tmp_path / f"stage{i}"))
        assert docs.columns == before
        kept.append({r.doc_id for r in docs.collect()})
    everything = {r[0] for r in rows}
    assert everything - kept[0] == set(range(0, 120, 5))
    assert kept[0] == kept[1]
    cut = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "stage1")).collect()}
    assert shared in cut[201].text and shared not in cut[202].text and cut[202].n_chars == len(cut[202].text)
    assert kept[1] - kept[2] == {200}
    assert kept[2] - kept[3] == {203}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == kept[3] and all(r.round_trip for r in out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, row string, th int"


def tables(spark, folder, docs, labels=(), items=()):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_on_nulls_repeated_rows_and_clashing_names(spark, tmp_path):
    """A repeated row stays once; null ids, null, empty and blank texts stay; columns named as an operator's own do no harm."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    texts = [(1, a), (1, a), (None, b), (2, None), (3, ""), (4, c), (5, c + " more"), (6, " \n\t"), (None, None)]
    tables(spark, tmp_path, [(i, t, None, None, None, 7, "x", 1) for i, t in texts])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted([1, None, 2, 3, 4, 6, None], key=str)
    assert all(r.round_trip for r in out)


def test_run_on_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_leaves_the_last_stage_s_rows_only(spark, tmp_path, monkeypatch):
    """A stage's rows are deleted when the next stage's are written, and the session's settings are as before."""
    import os

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    tables(spark, tmp_path, [(i, f"text number {i}", None, None, None, None, None, None) for i in range(5)])
    monkeypatch.setattr(corpus_pipeline, "shared_dir", lambda _: f"file://{tmp_path}/scratch")
    before = spark.conf.get(name)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 5
    assert os.listdir(tmp_path / "scratch") == ["stage3"] and spark.conf.get(name) == before


def test_decontamination_is_fitted_on_all_passages(spark, monkeypatch, tmp_path):
    """The stage's counts hold every passage of every document, whatever a sample's bound."""
    seen, real = [], decontam.cooccurrences

    def counted(*given):
        counts = real(*given)
        seen.extend(int(np.frombuffer(r.counts, np.int64).sum()) for r in counts.collect())
        return counts

    monkeypatch.setattr(decontam, "FIT_PASSAGES", 1, raising=False)
    monkeypatch.setattr(decontam, "cooccurrences", counted)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(words[(i * 7 + j) % 20] for j in range(n)) for i, n in enumerate([10, 64, 65, 300, 0, 129])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.createDataFrame([(1, " ".join(reversed(words)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    corpus_pipeline.drop_leaked(spark, docs, str(tmp_path)).collect()
    lengths = [len(t.split()[i : i + 64]) for t in texts for i in range(0, len(t.split()), 64)]
    assert sum(seen) == sum(n * n for n in lengths)
