"""Pieces against the library's."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from riskloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "\ta\nb", "é́ﬁ", "ａ", "a▁b", "<s>hi</s>", "\x00x", "<0x41>", "aaaaaaa", "日本語の", "👍🏽x", " " * 40 + "x"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def test_as_the_library(library):
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("abctheoin  ▁'.é日ing") for _ in range(r.randrange(70))) for _ in range(1500)]
    texts += ["".join(r.choice("ab") for _ in range(r.randrange(50))) for _ in range(300)]
    model = pieces.PieceModel(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]
    assert got == library.encode(texts)
    assert [model.decode(np.array(x, "<u4").tobytes()) for x in got] == library.decode(got)


def test_words_share_their_prefixes(library):
    model = pieces.PieceModel(PATH)
    words = ["▁the", "▁they", "▁them", "▁themselves", "▁th", "▁zebra", "▁theology"]
    assert model.encode_words(words) == {w: library.encode(w[1:], out_type=str) for w in words}


MIXED = ["end.\nNext", "a,b;c", "x1y22", "(слово)word!!", "naïve—так?!", "...\n\n  ---", "日本a語.b", "▁.▁", "Ünïcödé's 'q'\t\r\n"]


def test_words_are_divided_where_no_piece_crosses(library):
    model = pieces.PieceModel(PATH)
    assert model.parts.findall(" end.\nNext it,  she") == [" end", ".", "\n", "Next", " it", ",", "  she"]
    r = random.Random(2)
    made = ["".join(r.choice("abeinoÉßжстия.,!?'\"-—…12\n\t ▁日数据─👍\x00") for _ in range(r.randrange(60))) for _ in range(3000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(MIXED + made)]
    assert got == library.encode(MIXED + made)
    # the endings of lines and sentences make no words of their own
    assert {"end", " end", "Next"} & set(model.known) == {" end", "Next"}
    assert not any("\n" in word and word.strip(" ") != "\n" for word in model.known)


def test_every_piece_and_border(library):
    model = pieces.PieceModel(PATH)
    r = random.Random(3)
    names = [x.replace(pieces.MARK, " ") for x in model.id]
    texts = names + ["".join(r.choices(names, k=r.randrange(2, 7))) for _ in range(20_000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]
    assert got == library.encode(texts)


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "AT_ONCE", 10)
    texts = ["one two three four", "five six seven one", "two eight nine ten"] * 2
    got = [np.frombuffer(x, "<u4").tolist() for x in pieces.PieceModel(PATH).encode(texts)]
    assert got == library.encode(texts)


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate([*ODD, None, "long " * 50_000])], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(odd).union(odd).withColumn("ids", docs["doc_id"] * 0)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert len(got) == docs.count()
    for r in got:
        want = library.encode(texts[r.doc_id])
        assert r.n_pieces == len(want)
        assert zlib.crc32(r.ids) == zlib.crc32(np.array(want, "<u4").tobytes())
        assert r.text == texts[r.doc_id].replace("▁", " ")


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(none, PATH), PATH).collect() == []
