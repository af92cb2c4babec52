"""Pieces of texts, and the table of those a worker knows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lumentab.llm import pieces, words

SIGNS = [*"abzAKIstvmldre'''0129.,!?-=<>|  \n\t\x1c\x1f\x85\xa0\x00éÉßÿÀ×÷ª½", "́", "̸", "̇", "̱", "⃣", "K", "İ", "क़",
         "ᄀ", "ᅡ", "Ω", "　", "‍", "\U0001F600", "中", "“", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "'ll", "it's", "word"]


@pytest.fixture
def table():
    pytest.importorskip("tokenizers")
    return pieces.PieceTable(pieces.tokenizer_path())


def encoded(table, texts):
    buf, offsets = words.text_buffers(pa.array(texts))
    ids, sizes = table.encode(buf, offsets, 2)
    assert table.lengths(buf, offsets).tolist() == [n - 1 for n in sizes.tolist()]
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def wanted(table, texts):
    return [[*e.ids, 2] for e in table.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("known", [3, 200, 500_000])
def test_pieces_of_odd_texts_join_to_whole_texts(table, monkeypatch, known):
    monkeypatch.setattr(pieces, "KNOWN", known)
    rng = random.Random(known)
    for _ in range(20):
        texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(40))) for _ in range(60)]
        assert encoded(table, texts) == wanted(table, texts)


def test_a_word_is_known_by_itself(table):
    texts = ["word (word) word, word's 1word2 Über (Über)"]
    assert encoded(table, texts) == wanted(table, texts)
    # word ( ) , 's 1 2 Über; white space alone makes seven.
    assert len(table.marks) == 8
    again = ["word,word Über(word)2,1 12 (Über's,"]
    assert encoded(table, again) == wanted(table, again) and len(table.marks) == 8


def test_a_full_table_keeps_what_is_met_often(table, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 40)
    often = "the same words come again"
    learnt = []
    learn = table.learn
    monkeypatch.setattr(table, "learn", lambda data, starts, ends: learnt.extend(
        data[s:e].tobytes().decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)) or learn(data, starts, ends))
    letters = "abcdefghijklmnop"
    for k in range(60):
        texts = [often, " ".join("x" + letters[k % 16] + letters[k // 16] + letters[j] for j in range(10))]
        assert encoded(table, texts) == wanted(table, texts)
        assert len(table.marks) <= 40
    # A table that starts anew when it is full meets them anew every third time.
    assert all(learnt.count(w) == 1 for w in often.split())


def test_other_rules_are_given_pieces_between_white_space(tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(pieces.tokenizer_path())
    other.pre_tokenizer = tokenizers.pre_tokenizers.Sequence([tokenizers.pre_tokenizers.WhitespaceSplit(), tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    table = pieces.PieceTable(str(tmp_path / "other.json"))
    texts = ["don't a.b,c 12,34 (word)", "word word. 1a"]
    assert encoded(table, texts) == wanted(table, texts)
    assert wanted(table, texts) != wanted(pieces.PieceTable(pieces.tokenizer_path()), texts)
