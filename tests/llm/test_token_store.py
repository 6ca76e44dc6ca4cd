import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickerlens.llm import token_store as TS
from tickerlens.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", "Hello world.\nNext line, more text.", "  two  spaces ", "tab\there", "x\n\ny", "\nlead", "trail\n", "don't, won't.",
         "é à ü 日本語 テスト, ok.", "a b c", "nul\0byte here", "<|endoftext|> as text", "w. , . x", "word " * 30000, "z" * 50000,
         "emoji 😀😀, end.", "...", "a.b,c. d,.", " x", "Hello world.\nNext line, more text."]


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def expected(tok, text, end=0):
    return tok.encode(text or "", add_special_tokens=False).ids + [end]


def test_pieces_give_the_ids_of_the_whole_text(tok):
    enc = TS.PieceEncoder(PATH, "<u2")
    for _ in range(2):  # cold, then from memory
        got = enc.batch(TEXTS)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [expected(tok, t)[:-1] for t in TEXTS]


def test_pieces_and_their_runs_share_one_bounded_memory(tok, monkeypatch):
    monkeypatch.setattr(TS, "CACHE_WORDS", 100)
    enc = TS.PieceEncoder(PATH, "<u2")
    for k in range(10):
        words = [f"w{'abcdefghij'[k]}{'x' * i}" for i in range(60)]
        got = enc.batch([" ".join(["a", *words])])
        assert np.frombuffer(got[0], "<u2").tolist() == expected(tok, " ".join(["a", *words]))[:-1]
        held = sum(len(v) for v in vars(enc).values() if isinstance(v, dict) and v is not enc.letters)
        assert held <= 100 + len(words) + 10


def test_small_memory_gives_the_same(tok, monkeypatch):
    monkeypatch.setattr(TS, "CACHE_WORDS", 3)
    monkeypatch.setattr(TS, "ENCODE_CHARS", 10)
    enc = TS.PieceEncoder(PATH, "<u4")
    for t in TEXTS[:14]:
        assert np.frombuffer(enc.batch([t])[0], "<u4").tolist() == expected(tok, t)[:-1]


def test_round_trip_with_nulls_repeats_and_other_columns(spark, tok):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(3, None, 1), (3, "b", 2), (3, "a", 3), (None, "no id", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(5)
    folder = scratch_path(spark, "t")
    shards = TS.write_store(df, folder, PATH)
    got = TS.read_store(shards, folder, "<u2", docs_per_task=4).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    assert len(got) == len(order)
    for r, (i, t, _) in zip(got, order):
        ids = expected(tok, t)
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_table(spark):
    assert TS.token_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_latin_characters(tok, seed):
    """Words of any characters below U+0100, and some beyond, give the library's ids."""
    random.seed(seed)
    chars = [chr(c) for c in range(0x21, 0x7F)] + [chr(c) for c in range(0xA1, 0x100)] * 2 + list("'stredvml" * 9) + ["Ā", "日", "😀"]
    texts = [" ".join("".join(random.choices(chars, k=random.randint(1, 9))) for _ in range(60)) for _ in range(40)]
    enc = TS.PieceEncoder(PATH, "<u2")
    assert [np.frombuffer(g, "<u2").tolist() for g in enc.batch(texts)] == [expected(tok, t)[:-1] for t in texts]


def test_plain_call_knows_control_tokens():
    plain = Tokenizer.from_file(PATH)
    enc = TS.PieceEncoder(PATH, "<u2", spell_control=True)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "no control", "<|endoftext |>"]
    assert [np.frombuffer(g, "<u2").tolist() for g in enc.batch(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_memory_keeps_the_newer_half(monkeypatch):
    monkeypatch.setattr(TS, "CACHE_WORDS", 10)
    enc = TS.PieceEncoder(PATH, "<u2")
    enc.batch([" ".join(f"w{i}x" for i in range(20))])
    enc.batch(["other"])
    assert " w19x" in enc.known and " w2x" not in enc.known


def test_a_word_of_one_run_is_not_cut(tok, monkeypatch):
    monkeypatch.setattr(TS, "_TOKENS", None)  # what cuts words into runs
    enc = TS.PieceEncoder(PATH, "<u2")
    text = "plain words über alles ñandú"
    assert np.frombuffer(enc.batch([text])[0], "<u2").tolist() == expected(tok, text)[:-1]
