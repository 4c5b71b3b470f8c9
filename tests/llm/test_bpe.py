import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scarp.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.read_vocabulary(PATH))


def odd_texts():
    rng = random.Random(3)
    texts = ["", " ", "  a", "a  ", "a" * 1000, "ab" * 999, "it's I'LL we've", "<|endoftext|>a<|endoftext|><|endo",
             "日本語テキスト🎉👩‍👩‍👧 ", "﻿ é é", "x" * 5000 + "\n" * 400, "\x1c\x1d\x85\xa0  x　 y\n\n z"]
    alphabet = "ab c\n\t\x1c\x85\xa0 'sré1٣²½🎉́日#."
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(500)]


def test_equals_library(library, own):
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_heap_and_rounds_agree(own):
    rng = random.Random(5)
    for _ in range(50):
        word = bytes(rng.choice(b"abehnort ") for _ in range(rng.randint(1, 200)))
        assert own.merge_rounds([word])[0].tolist() == own.merge_long(word)


def test_long_text_in_pieces(own, monkeypatch):
    text = " ".join(odd_texts()[:40])
    whole = own.encode(text)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    assert own.encode(text) == whole


def test_digests_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "The cat sat", "x"), (1, "The cat sat", "y"), (None, "é <|endoftext|>", None), (3, None, "z"), (4, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.asDict() for r in bpe.encode_digests(df, PATH).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append({"doc_id": doc_id, "n_tokens": len(ids),
                     "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest()})
    assert got == sorted(want, key=str)
    assert bpe.encode_digests(df.limit(0), PATH).count() == 0
    table = {tuple(r.ids): r.decoded for r in bpe.encode_table(df, PATH).collect()}
    assert table[tuple(library.encode("The cat sat", add_special_tokens=False).ids)] == "The cat sat"
