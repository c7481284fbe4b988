"""The stages one after the other on a planted table."""

import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

rng = random.Random(9)


def prose(n):
    return " ".join("".join(rng.choice(["an", "er", "ti", "on", "es", "re"]) for _ in range(3))
                    for _ in range(n)) + "."


def test_stages(spark, tmp_path):
    base, shared = prose(150), prose(60)
    rows = [(i, prose(80)) for i in range(300)]
    rows += [(300 + i, prose(20) + " !! $$ ## !! $$ ## " * 20) for i in range(60)]
    rows += [(400, base), (401, base), (402, base + " extra"), (403, prose(30) + shared),
             (404, shared + prose(30)), (405, "mail me at jo.do@mail.org " + prose(40)), (406, None),
             (407, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 0 if 300 <= i < 360 else 1, 0) for i in range(0, 360, 2)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), str(tmp_path))
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert set(seen["quality"]) == set(range(300)) | set(range(400, 408))
    assert set(seen["near_duplicates"]) == set(seen["quality"]) - {401, 402}
    text = {i: r["text"] for i, r in seen["repeated_passages"].items()}
    assert shared in text[403] and shared not in text[404] and text[400] == base
    assert all(r["n_chars"] == len(r["text"] or "") for r in seen["repeated_passages"].values())
    assert "jo.do@mail.org" not in seen["personal_data"][405]["text"]
    assert set(seen["packing"]) == set(seen["personal_data"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(docs.collect())


CLASH = "pii_counts component_id kept i h t key spans _i _h _spans _found sequence_id score".split()


def test_empty_table_and_clashing_columns(spark, tmp_path):
    rows = [(1, "mail jo.do@mail.org " + prose(40)), (2, prose(9_000)), (3, None), (4, ""),
            (None, prose(20)), (5, prose(30)), (5, prose(30))]
    rows += rows[:1]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASH]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), *[f"c{k}" for k in range(len(CLASH))]) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{c} string" for c in CLASH))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for given, n in ((docs, 7), (docs.limit(0), 0)):
        at = given
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            at.write.parquet(f"{tmp_path}/{n}-{k}")
            at = stage(spark, spark.read.parquet(f"{tmp_path}/{n}-{k}"), str(tmp_path))
            assert at.columns == names and at.dtypes == docs.dtypes
        left = at.collect()
        assert len(left) == n  # the repeated row goes
        assert all(r[c] == f"c{k}" for r in left for k, c in enumerate(CLASH))
        packed = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()
        assert len(packed) >= n and bool(packed) == bool(n)
