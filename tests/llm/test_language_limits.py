"""Language identification: the rejection limits come from all training texts."""

import random

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import langid


@pytest.mark.parametrize("grams", [langid.MAX_GRAMS, 50])
def test_limits_are_of_all_training_texts(spark, monkeypatch, grams):
    monkeypatch.setattr(langid, "MAX_GRAMS", grams)
    rng, n = random.Random(3), 2060
    ids = spark.range(n).orderBy(F.xxhash64("id"), "id").collect()
    words = lambda k, letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(k))
    # the last ids by hash have texts that the language's others foretell badly
    rows = [(r.id, "x", words(6, "abc") if i < 2000 else words(6, "defghijklmnopqrstuvwxyz")) for i, r in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    found = langid.identify(docs, langid.train(spark, docs)).where("not accepted").count()
    assert found == 0
