"""What Python tasks hold at once: words and ids of few texts, and small batches of sets."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import prose

from millrace.llm import part_enum, tokens
from millrace.llm.arrow import batches_of

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k", True), ("word_bpe_49k", False)])
def test_few_texts_are_held_as_words_at_once(name, spaced, monkeypatch):
    encoder = tokens.Encoder(public_tokenizers.path(f"{name}.json"), spaced)
    held, plain = [], tokens.Encoder._some

    def seen(self, texts):
        held.append(texts)
        return plain(self, texts)

    monkeypatch.setattr(tokens.Encoder, "_some", seen)
    text = prose(1, 400)
    rows = [f"{k} {text}" for k in range(1000)] + ["", "one", " ".join([text] * 900)]
    found = encoder.encode(rows)
    assert sum(held, []) == rows
    most = [sum(len(x.encode()) for x in texts[1:]) for texts in held]
    assert len(held) > 2 and max(most) <= 1 << 20
    for k in (0, 999, 1000, 1001, 1002):
        ids = encoder.library.encode(rows[k], add_special_tokens=False).ids
        assert np.frombuffer(found[k], dtype="<u4").tolist() == ids


def test_a_column_is_encoded_text_by_text():
    encoder = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    rows = ["one two", None, "", "  three\n", "one"]
    whole = encoder.encode([x or "" for x in rows])
    for column in (pa.array(rows), pa.array(["cut", *rows])[1:], pa.array(rows, pa.large_string())):
        assert list(encoder.encoded(column)) == whole
    assert list(encoder.encoded(pa.array([None, None], pa.string()))) == [b"", b""]
    assert encoder.encode([]) == []


def _batches(df):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return [r.n for r in df.mapInArrow(run, "n bigint").collect()]


def test_batches_close_by_their_bytes(spark):
    df = spark.range(0, 3000, 1, 1).selectExpr("array_repeat(id, 100) as features")
    before = spark.conf.get(LIMIT)
    assert _batches(df) == [3000]
    with pytest.raises(ValueError), batches_of(spark, 1 << 18):
        assert sum(small := _batches(df)) == 3000 and max(small) < 600
        raise ValueError
    assert spark.conf.get(LIMIT) == before
    assert _batches(df) == [3000]
    spark.conf.set(LIMIT, "1m")
    try:
        with batches_of(spark, 1 << 18):
            pass
        assert spark.conf.get(LIMIT) in ("1m", "1048576b")
    finally:
        spark.conf.unset(LIMIT)


def test_sets_meet_python_in_small_batches(spark, monkeypatch):
    limits, plain = [], part_enum._stored

    def seen(df, name):
        limits.append((name, spark.conf.get(LIMIT)))
        return plain(df, name)

    monkeypatch.setattr(part_enum, "_stored", seen)
    before = spark.conf.get(LIMIT)
    words = prose(2, 60).split(" ")
    rows = [(1, " ".join(words)), (2, " ".join(words[:58])), (3, "a b"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = part_enum.grouped(docs, part_enum.Join())
    assert {"part-enum-sets", "part-enum-edges"} <= {name for name, _ in limits}
    assert all(limit in (str(4 << 20), f"{4 << 20}b") for _, limit in limits)
    assert spark.conf.get(LIMIT) == before
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}
