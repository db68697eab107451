import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from funnelwright.llm import batches, words


def test_pick_takes_exact_names_before_names_of_other_case(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id long, Text string, text string")
    assert batches.pick(df, "text", "id").collect()[0].asDict() == {"text": "b", "id": 1}
    assert batches.pick(df.select("id", F.col("id").alias("Other")), "OTHER").columns == ["OTHER"]
    with pytest.raises(ValueError):
        batches.pick(df, "missing")


def test_chunks_are_bounded_and_complete():
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a" * n for n in (5, 0, 9, 30, 1, 1)] + [None])})
    parts = list(batches.chunks(batch, "t", 10))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p["t"].to_pylist()) <= 10 for p in parts)
    joined = list(batches.merged(iter(parts), "t", 40))
    assert pa.Table.from_batches(joined).to_pydict() == batch.to_pydict() and len(joined) < len(parts)


def test_word_hashes_agree_exactly_when_words_do(rng, monkeypatch):
    texts = ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", "abc" * 5000]
    monkeypatch.setattr(words, "_BLOCK", 64)
    words._powers.cache_clear()
    data, offsets = words.buffer(pa.array(texts, pa.string()).slice(0))
    starts, ends = words.runs(words.NOT_SPACE[data], offsets)
    raw = data.tobytes()
    found = [raw[s:e] for s, e in zip(starts, ends, strict=True)]
    expected = [w for t in texts for w in (t or "").lower().replace("\n", " ").encode().split(b" ") if w]
    assert found == expected
    made = words.hashes(data, starts, ends).tolist()
    assert len(set(made)) == len(set(found)) and len(set(zip(made, found, strict=True))) == len(set(found))
    words._powers.cache_clear()
