import random
import re

import corpus_pipeline
from pyspark.sql import functions as F

from .test_language import SYLLABLES, text
from .test_packing import check, tokenizer  # noqa: F401
from .test_simhash import classes, fingerprint


def test_stages_take_effect(spark, documents, tmp_path, tokenizer):  # noqa: F811
    rng = random.Random(3)
    rows = [(i, text(rng, lang := rng.choice(sorted(SYLLABLES)), 150), lang) for i in range(80)]
    item = text(rng, "en", 25)
    rows += [(200, rows[5][1], "en"), (201, rows[6][1] + " changed", "en"), (202, None, None), (203, "Привет мир " * 40, None)]
    rows += [(204, text(rng, "en", 60) + " " + item + " " + text(rng, "en", 60), "en")]
    rows += [(205, text(rng, "de", 60) + " password=0123456789abcdef " + text(rng, "de", 60), "de")]
    folder = str(tmp_path)
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    known = [r for r in rows if r[0] not in (202, 203)]
    groups = classes([fingerprint(t) for _, t, _ in known], [i for i, _, _ in known])
    stay = [(i, re.sub("password=0123456789abcdef", "[SECRET]", t)) for i, t, _ in known if i in set(groups) and i != 204]
    assert {200, 204}.isdisjoint(i for i, _ in stay) and 205 in dict(stay)
    docs, columns = spark.read.parquet(f"{folder}/documents.parquet"), None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/stage{number}")
        columns = columns or docs.columns
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        docs = spark.read.parquet(f"{folder}/stage{number}")
    check(stay, docs.collect(), tokenizer, 4096)
    whole = corpus_pipeline.run(spark, folder).select(F.sum("length"), F.count("*")).first()
    assert whole == docs.select(F.sum("length"), F.count("*")).first()


def test_stages_accept_empty_tables(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), str(tmp_path)).count() == 0
