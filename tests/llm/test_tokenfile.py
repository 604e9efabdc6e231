"""Token files against the library."""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from riskloom.llm import tokenfile, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return [x.ids for x in found.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, name string, base int")
    files = tokenfile.write_tokens(df, PATH, end_id=2)
    got = sorted(tokenfile.read_tokens(files).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    ids = library([t for _, t in rows])
    want = sorted((str(i), zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for (i, _), x in zip(rows, ids, strict=True))
    assert sorted((str(r.doc_id), zlib.crc32(r.ids)) for r in got) == want
    assert files.selectExpr("sum(docs)").first()[0] in (len(rows), None)


def test_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_edges(spark):
    rows = [(5, None), (-3, ""), (None, "no id"), (None, None), (7, "long text " * 30_000), (2, "a"), (2, "a"), (2, "b")]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])


def test_words_one_by_one(monkeypatch):
    texts = ["a b", " a b", "a  b ", "x\n y", "x \n\n y\t z", "it's 12,5 <|endoftext|> é", "\xa0a　 b", "", "one", " ", "a b" * 99]
    for path in (PATH, public_tokenizers.path("word_bpe_49k.json")):
        known = Tokenizer.from_file(path)
        known.encode_special_tokens = True
        want = [x.ids for x in known.encode_batch(texts, add_special_tokens=False)]
        own = tokens.WordwiseEncoder(path)
        assert [x.tolist() for x in own.encode([*texts, None])] == [*want, []]
        monkeypatch.setattr(tokens, "REMEMBERED", 1)
        monkeypatch.setattr(tokens, "AT_ONCE", 5)
        assert [x.tolist() for x in own.encode(texts)] == want
        monkeypatch.undo()


def own_memory():
    with open("/proc/self/smaps_rollup") as file:
        return sum(int(x.split()[1]) for x in file if x.startswith("Pss_Anon")) / 1024


def test_ids_read_are_given_back(spark, monkeypatch):
    # the reading function, in this process
    found = {}
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, schema: found.setdefault("read", f))
    folder = tempfile.mkdtemp()
    docs, each = 2_000, 1_000
    np.arange(docs * each).astype("<u2").tofile(f"{folder}/a.ids")
    np.arange(docs).astype("<i8").tofile(f"{folder}/a.docs")
    (np.arange(docs + 1) * each).astype("<i8").tofile(f"{folder}/a.offsets")
    row = {"name": "a", "folder": folder, "docs": docs, "tokens": docs * each, "base": 0, "type": "<u2"}
    tokenfile.read_tokens(spark.createDataFrame([row]))
    batch = pa.RecordBatch.from_pylist([row])
    first = next(found["read"](iter([batch])))
    assert first.column(3)[1].as_py() == np.arange(each, 2 * each).astype("<u4").tobytes()
    before = own_memory()
    for _ in range(20):
        for _ in found["read"](iter([batch])):
            pass
    assert own_memory() - before < 60  # of 160 MB read


def test_words_remembered():
    for path in (PATH, public_tokenizers.path("word_bpe_49k.json")):
        own = tokens.WordwiseEncoder(path)
        texts = ["a " + "b" * 1000, "c " + "日" * 1000, "one, two.\nThree; “one”, two"]
        known = Tokenizer.from_file(path)
        want = [x.ids for x in known.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in own.encode(texts)] == want
        assert max(map(len, own.known)) <= 40


def test_memory_of_words():
    """A worker keeps its words while it lives, beside whatever other stages leave in it."""
    before = own_memory()
    known = tokens._Known(lambda word: word.encode()[-6:])
    for i in range(760_000):
        known[f"word{i:020d}"]
    assert known["word00000000000000000000"] == b"000000"
    assert own_memory() - before < 90
