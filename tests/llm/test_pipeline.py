"""The pipeline's stages, each on what the stage before it kept."""

import random

import pytest
from helpers import prose
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, tmp_path):
    rnd = random.Random(3)

    def passage(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(["ka", "lo", "mi", "ne", "ru", "so"]) for _ in range(r.randint(1, 3))) for _ in range(n)) + "."

    docs = [(i, "\n".join(passage(i * 10 + k, 30) for k in range(3))) for i in range(120)]
    toxic = set(range(0, 120, 6))
    docs = [(i, t + " vilewort grubnard snotfang vileworts" if i in toxic else t) for i, t in docs]
    item = passage(5000, 40)
    shared = passage(6000, 60)
    docs += [(200, docs[1][1]), (201, docs[2][1] + " so"), (202, passage(7000, 30) + "\n" + item), (203, passage(7001, 30) + "\n" + shared), (204, passage(7002, 30) + "\n" + shared), (205, passage(7003, 30) + " vilewort grubnard snotfang snotfangs"), (300, None), (301, "")]
    rows = [(i, t, "en", f"src{rnd.randrange(3)}", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item), (1, prose(1, 20))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        after = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if name != "packing":
            assert after.dtypes == now.dtypes
        now = after
        kept.append({r.doc_id: r for r in now.collect()})
    tox, line, near, clean, packed = kept
    ids = {i for i, _ in docs}
    assert set(tox) == ids - toxic - {205}
    assert set(line) == set(tox) and line[203].text.endswith(shared) and shared not in line[204].text and line[204].n_chars == len(line[204].text)
    assert line[200].text == "" and line[1].text == docs[1][1] and line[300].text is None
    assert set(near) == set(line) - {300, 301}  # what is empty is alike; the smallest id stays
    assert set(clean) == set(near) - {202}
    assert set(packed) == set(clean)
    again = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert again == set(packed)
    assert now.agg(F.sum("length")).first()[0] > 0


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ka", "lo", "mi", "ne", "ru", "so", "ti", "va"]) for _ in range(r.randint(2, 4))) for _ in range(n))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, gone string, h string, _held string, fp string, _hash string"


def tables(spark, path, docs):
    made = spark.createDataFrame([(i, t, None, None, None, "x", "y", "z", "w", "v") for i, t in docs], COLUMNS)
    spark.createDataFrame([(i, 0, int(i % 2)) for i in range(8)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, words(1, 30)), (1, None), (None, words(2, 20)), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return made


def test_stages_tell_rows_by_id_and_text(spark, tmp_path):
    """Rows that share an id or have none, nulls, other columns with names of the operators' own."""
    item, line = words(1, 30), words(50, 12)
    docs = [(1, words(10, 60)), (1, words(11, 60)), (None, words(12, 60)), (None, f"{words(13, 20)} {item}"), (2, f"{words(14, 20)} {item}"), (2, words(15, 60)), (None, None), (3, None), (4, ""), (5, f"{line}\n{words(16, 40)}"), (5, f"{line}\n{words(17, 40)}"), (6, words(10, 60)), (None, words(12, 60))]
    rows = tables(spark, tmp_path, docs)
    got = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, str(tmp_path))
        assert out.columns == rows.columns, name
        got[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        assert all(r.h == "y" and r.fp == "w" for r in out.collect())
    key = lambda some: sorted(some, key=str)
    assert got["toxicity"] == key(docs)  # its labels name no toxic words
    lines = got["line dedup"]
    assert len(lines) == len(docs) and sum(line in (t or "") for _, t in lines) == 1 and (None, None) in lines and (2, words(15, 60)) in lines
    assert (6, "") in lines and (1, words(10, 60)) in lines and sum(t == words(12, 60) for _, t in lines) == 2  # rows equal in id and text
    near = got["near copies"]
    assert (1, words(10, 60)) in near and (6, words(10, 60)) not in near and (1, words(11, 60)) in near and near.count((None, words(12, 60))) == 1 and (3, None) in near and (4, "") not in near
    assert got["decontamination"] == key([d for d in docs if item not in (d[1] or "")])


def test_stages_of_no_documents(spark, tmp_path):
    rows = tables(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, str(tmp_path)).count() == 0, name
