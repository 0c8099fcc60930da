import random
import zlib

import numpy as np
import pytest

import edge
from hirelens.llm import tokens
from hirelens.llm.queries import END_ID, tokenizer_path
from hirelens.llm.tokenfiles import manifest, mapped, read_token_files, write_token_files

NASTY = ["", None, "  a  b", "foo\n\n\nbar. ", "x y z", "a \n<|endoftext|> b", "İ. İI, İ.", "tab\t\tx\r\ny", "  x",
         "a b <|endoftext|> c<|startoftext|>d <|endoftext|>", "<|endoftext|>", "<| endoftext |>", "x<|endof\ntext|>",
         "Å. " + "q" * 500, "\x1cfoo\x1d bar", "don't. we're, it's ok...,", "é. ñ, İ.", "1,000.5, x2.", "(so)\" *b* c%%%"]


def library(name):
    """The library's tokenizer as the file gives it."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path(name))


def file_bytes(name):
    with open(tokenizer_path(name), "rb") as f:
        return f.read()


def whole(tokenizer, texts):
    return [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_equal_those_of_whole_texts(spark, name, monkeypatch):
    from conftest import SF_SMALL
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + NASTY
    rng = random.Random(1)
    pieces = [" ", "\n", "  ", "\t", ".", ",", "'s", "é", "Ab", "c", "7", "<|", " ", "İ", "\x1f", "-", "漢", "!?"]
    texts += ["".join(rng.choice(pieces) for _ in range(40)) for _ in range(400)]
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    enc = tokens.Encoder(file_bytes(name))
    want = whole(library(name), texts)
    assert want[texts.index("<|endoftext|>")] == np.array([library(name).token_to_id("<|endoftext|>")], "<u2").tobytes()
    for lo, hi in tokens.some_texts(texts, 5000):
        assert enc.encode(texts[lo:hi]) == want[lo:hi]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_marks_as_text_on_request(name):
    plain = library(name)
    plain.encode_special_tokens = True
    enc = tokens.Encoder(file_bytes(name), special_as_text=True)
    assert enc.encode(NASTY) == whole(plain, NASTY)
    assert len(enc.encode(["<|endoftext|>"])[0]) > 2


def test_new_words_of_a_byte_level_file_are_encoded_together():
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **kw):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **kw)

    rng = random.Random(3)
    letters = "abcdefgé漢"
    texts = [rng.choice(["", " ", "  ", "\t"]).join(rng.choice([" ", "\n", "\n\n", " ", " "]) + "".join(rng.choices(letters, k=9)) + rng.choice(["", ".", "'s", "7"])
                                                   for _ in range(200)) for _ in range(50)]
    texts[1:1] = [None, "", " ", "\xa0 a", "\t", "a" * 300, " " + "b" * 300, "a\t\n b \r", "a<|endoftext|> b"]
    enc = tokens.Encoder(file_bytes("byte_bpe_50k.json"))
    enc.tokenizer = Counting(enc.tokenizer)
    assert enc.encode(texts) == whole(library("byte_bpe_50k.json"), texts)
    assert len(enc.known) > 5000 and enc.tokenizer.texts < 500


def test_token_files_round_trip(spark, tmp_path):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = edge.nasty() + [(100 + i, t) for i, t in enumerate(NASTY)]
    folder = str(tmp_path / "files")
    write_token_files(edge.docs(spark, rows), folder, path, END_ID)
    want = sorted((r[0] is not None, r[0] or 0, b) for r, b in zip(rows, whole(library("byte_bpe_50k.json"), [r[1] for r in rows])))
    got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [k if some else None for some, k, _ in want]
    at = 0
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert r["start"] == at and r["n_tokens"] == len(ids) and ids[-1] == END_ID
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.array(r["ids"][:-1], "<u2").tobytes()) for r in got) == want
    for s in manifest(spark, folder).collect():
        ids, offsets, _ = mapped(folder, s["name"], s["id_bytes"])
        assert ids.dtype == np.dtype("<u2") and offsets.dtype == np.dtype("<i8") and offsets[-1] == len(ids) == s["n_tokens"]


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    assert write_token_files(edge.docs(spark, []), folder, tokenizer_path("byte_bpe_50k.json"), END_ID).count() == 0
    assert read_token_files(spark, folder).count() == 0


def test_texts_are_looked_at_a_little_at_a_time():
    import pyarrow as pa
    texts = ["a" * 30, None, "", "b" * 500] + ["c" * (i % 7) for i in range(600)]
    got = list(tokens.some_rows(pa.array(["x", *texts]).slice(1), most=100, rows=64))
    assert [t for _, part in got for t in part] == texts
    assert [at for at, _ in got] == [sum(len(p) for _, p in got[:i]) for i in range(len(got))]
    assert all(len(p) <= 64 and sum(len(t or "") for t in p[:-1]) < 100 for _, p in got)
    assert list(tokens.some_rows(pa.array([], pa.string()))) == []


def test_new_chunks_are_told_without_a_walk_through_all_known():
    """op8_packing: a step's cost depends on its own chunks, not on what the worker remembers."""
    class Known(dict):
        def keys(self):
            raise AssertionError("walked through")

        __iter__ = keys

    e = tokens.Encoder(file_bytes("word_bpe_49k.json"))
    e.known = Known()
    for _ in range(2):  # learned, then remembered
        assert e.encode(NASTY) == whole(library("word_bpe_49k.json"), NASTY)
