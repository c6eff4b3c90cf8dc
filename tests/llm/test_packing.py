import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import packing


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.tokenizer_path())


ODD = ["İstanbul ΣΑΣ é  a b \x85 \x1c\x1d", "don't I'LL 'ré ½ x²y", "<|endoftext|>a<|startoftext|>", "日本語テキスト ab́c", "soft­hyphen \x00 \x7f", "ªº µ ÀÞß × ÷ ÿ", "", " \n\t", "😀x😀", "a" * 3000]


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_words_have_the_ids_of_the_whole_text(model):
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choices(ODD, k=5)) for _ in range(30)] + ["".join(chr(rng.randrange(1, 0x250)) for _ in range(200)) for _ in range(100)]
    encode = packing.WordEncoder(packing.tokenizer_path(), cached=50)
    assert encode.by_word
    for _ in range(2):
        for text, got in zip(texts, encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(got, dtype="<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_pieces_against_plain_python(docs, model):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, *ODD]) if i % 7 == 0 else " ".join(f"w{rng.randrange(99)}é" for _ in range(rng.randint(0, 90)))) for i in range(150)] + [(500, "long text " * 9000), (3, "a repeated id")]
    pieces = packing.pack(docs(rows).repartition(5)).collect()
    tokens = {}
    for i, text in rows:
        tokens.setdefault(i, []).append(ids_of(model, text))
    by_doc, windows = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(len(x) for xs in tokens.values() for x in xs)
    for i, xs in tokens.items():
        if len(xs) == 1:
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p["start"]):
                part = xs[0][at : at + p["length"]]
                assert (p["start"], p["doc_tokens"]) == (at, len(xs[0]))
                assert p["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
                at += p["length"]
            assert at == len(xs[0])
    for n, held in sorted(windows.items()):
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at == packing.WINDOW or n == max(windows) and at < packing.WINDOW
    assert sorted(windows) == list(range(len(windows)))


def test_empty_table_and_clashing_columns(docs):
    assert packing.pack(docs([])).count() == 0
    more = docs([(None, "x"), (1, None)]).withColumn("ids", F.lit(1)).withColumn("pid", F.lit(2)).withColumn("place", F.lit(3))
    got = packing.pack(more).collect()
    assert {r["doc_id"] for r in got} == {None, 1}
    assert sum(r["length"] for r in got) == 3


def test_padded_length():
    assert [packing.padded_length(n) for n in (1, 2, 3, 4, 1000, 1024, 4096)] == [1, 2, 4096, 4, 4096, 1024, 4096]


def test_sequences_hold_the_stream(docs, model):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(None, "x"), (70, "long text " * 50)]
    got = sorted(packing.sequences(docs(rows).repartition(5), window=64).collect())
    assert [r["sequence_id"] for r in got] == list(range(len(got)))
    ids = [np.frombuffer(r["ids"], dtype="<u4").tolist() for r in got]
    assert all(r["length"] == len(x) == 64 for r, x in zip(got[:-1], ids, strict=False))
    assert len(ids[-1]) == packing.padded_length(got[-1]["length"], 64) and set(ids[-1][got[-1]["length"] :]) <= {packing.PAD_ID}
    stream = [i for r, x in zip(got, ids, strict=True) for i in x[: r["length"]]]
    wanted, at = [ids_of(model, t) for _, t in rows], 0
    assert len(stream) == sum(map(len, wanted))
    while at < len(stream):  # documents in turn, each closed by the end id
        n = stream.index(packing.END_ID, at) + 1 - at
        wanted.remove(stream[at : at + n])
        at += n
    for r in got:
        assert [b["offset"] for b in r["bounds"]] == [sum(b["length"] for b in r["bounds"][:k]) for k in range(len(r["bounds"]))]
        assert sum(b["length"] for b in r["bounds"]) == r["length"]


def test_the_pipeline_delivers_the_ids(spark, docs, model):
    import corpus_pipeline

    out = corpus_pipeline.pack(spark, docs([(i, "some words " * 700) for i in range(9)]), "").collect()
    heads = {r["sequence_id"]: r for r in out if r["sequence_ids"] is not None}
    assert heads.keys() == {r["sequence_id"] for r in out}
    stream = [i for _, r in sorted(heads.items()) for i in np.frombuffer(r["sequence_ids"], dtype="<u4").tolist()[: r["sequence_length"]]]
    assert stream == ids_of(model, "some words " * 700) * 9


@pytest.mark.parametrize("window", [8, 16])
def test_windows_and_parts_of_many_batches(window):
    """Whole windows and parts of windows hold every id once, wherever batches end or rows leave gaps."""
    import pyarrow as pa

    rng = random.Random(window)
    at, rows, ids = 3, [], {}
    for i in range(300):
        if rng.random() < 0.02:
            at += rng.randint(1, 40)  # rows of another task
        n = rng.choice((1, 2, 5, 9, 40))
        ids |= {at + j: 1000 * i + j for j in range(n)}
        rows.append((i, at, n, np.arange(1000 * i, 1000 * i + n, dtype="<u4").tobytes()))
        at += n
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    batches = []
    while rows:
        take = rng.randint(1, 30)
        part, rows = rows[:take], rows[take:]
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names=["doc_id", "place", "doc_tokens", "ids"]))
    found = {}
    for whole in (True, False):
        for out in packing._cut(window, whole)(iter(batches)):
            for r in out.to_pylist():
                got = np.frombuffer(r["ids"], dtype="<u4").tolist()
                assert (len(got) == window) == whole
                start = r["sequence_id"] * window + r["offset"]
                assert not found.keys() & set(range(start, start + len(got)))
                found |= {start + j: x for j, x in enumerate(got)}
                assert sum(b["length"] for b in r["bounds"]) == len(got)
                for b in r["bounds"]:
                    assert found[r["sequence_id"] * window + b["offset"]] == 1000 * b["doc_id"] + b["start"]
    assert found == ids
