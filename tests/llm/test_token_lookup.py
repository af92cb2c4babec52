"""Tokens by their position in a token file."""

import random

import pytest
from pyspark.sql import functions as F

from lumentab.llm import dac


def test_tokens_by_position(spark, monkeypatch, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    from lumentab.llm.pieces import tokenizer_path

    monkeypatch.setattr(dac, "BLOCK_IDS", 300)
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice("tokens of several sizes 12345 straße zeta unbelievably".split()) for _ in range(rng.randrange(60))) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()) + [(500, None)], "doc_id long, text string").repartition(5)
    folder = str(tmp_path / "tokens")
    dac.write_tokens(docs, folder)
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    ids = []
    for i in sorted([*texts, 500]):
        ids += [*tokenizer.encode(texts.get(i, ""), add_special_tokens=False).ids, dac.END]
    asked = [0, 1, len(ids) - 1, len(ids), -1, 10 ** 9, *rng.sample(range(len(ids)), 200)]
    table = spark.createDataFrame([(p,) for p in asked + asked[:5]] + [(None,)], "position long")
    got = {r["position"]: r["token"] for r in dac.tokens_at(spark, folder, table).collect()}
    assert got == {p: ids[p] if p is not None and 0 <= p < len(ids) else -1 for p in [*asked, None]}
    whole = dac.tokens_at(spark, folder, spark.range(len(ids)).select(F.col("id").alias("position"))).orderBy("position").collect()
    assert [r["token"] for r in whole] == ids


def test_an_empty_file_has_no_tokens(spark, tmp_path):
    folder = str(tmp_path / "none")
    dac.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert [tuple(r) for r in dac.tokens_at(spark, folder, spark.range(1).select(F.col("id").alias("position"))).collect()] == [(0, -1)]
