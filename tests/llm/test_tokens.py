import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from countlake.llm import byte_bpe, token_store

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ODD = "abcdeéèñ trhe中文字日本🙂🙃’́‍  \n\t0123'’ABC…ḦİΣ"


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return byte_bpe.ByteCoder(file.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=ODD, max_size=60)))
def test_ids_are_those_of_the_library(coder, reference, text):
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_every_token_encodes_to_itself(coder):
    assert all(coder.encode_part(t) == [r] for t, r in coder.ranks.items())


def test_long_parts_take_linear_work(coder, reference):
    for text in ("ab" * 60_000, "é" * 40_000, "x" * 100_000, " " * 50_000):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_remembering_is_bounded(coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for i in range(20):
        coder.encode(f"word{i} other{i}")
    assert len(coder) <= 5


def test_documents_are_encoded_whole_and_decoded(documents, odd_texts, reference):
    frame = documents(odd_texts, copies=2)
    got = byte_bpe.round_trip(frame, RANKS, P.PATTERN).collect()
    assert len(got) == 2 * len(odd_texts)
    for row in got:
        text = odd_texts[row.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    tokens = byte_bpe.encode(frame, RANKS, P.PATTERN)
    for row in byte_bpe.decode(tokens, RANKS).collect():
        assert bytes(row.content).decode() == (odd_texts[row.doc_id] or "")
    assert byte_bpe.encode(frame.limit(0), RANKS, P.PATTERN).count() == 0


# --- token store -----------------------------------------------------------

WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    with open(WORDS, "rb") as file:
        return token_store.WordCoder(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


PARTS = ["a", "B", "É", "ẖ", "H", "̱", "́", " ", "\n", "\x1c", "\x85", "\u3000", "'s", "'RE", "…", ",", "."]
PARTS += ["1", "٣", "ß", "İ", "Σ", "🙂", "<|", "<|endoftext|>", "<|startoftext|>", "\u00a0", "中", "क़", "ǅ", "ª"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=20).map("".join)), max_size=4))
def test_word_ids_are_those_of_the_library(words, library, texts):
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(i, "<u4").tolist() for i in words.encode(texts)] == expected


def test_letters_and_marks_are_encoded_apart(library, monkeypatch):
    with open(WORDS, "rb") as file:
        coder = token_store.WordCoder(file.read())
    apart, alone = ["haus***", "größe.", "Città,$$$", "año", "it's.", "x'"], ["'sword", "a1!", "中。", "б.", "s!!!!!"]
    real, others = coder._others, []

    def record(words, *learned):
        others.extend(words)
        return real(words, *learned)

    monkeypatch.setattr(coder, "_others", record)
    text = " \t".join(["", *apart, *alone, *apart, "größe"])
    found = [np.frombuffer(i, "<u4").tolist() for i in coder.encode([text, None, text])]
    expected = library.encode(text, add_special_tokens=False).ids
    assert found == [expected, [], expected]
    assert not {w.lower().encode() for w in apart if w != "it's."} & set(others)


def test_stored_tokens_come_back_in_order(spark, documents, odd_texts, library, tmp_path):
    ids = [900 - 7 * i for i in range(len(odd_texts))]
    frame = documents(odd_texts, ids=ids)
    token_store.write(frame, str(tmp_path / "t"), WORDS, partitions=3, page_rows=2)
    got = {r.key: r for r in token_store.checksums(token_store.read(spark, str(tmp_path / "t"))).collect()}
    at = 0
    for key, text in sorted(zip(ids, odd_texts)):
        tokens = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[key].start, got[key].n_tokens) == (at, len(tokens))
        assert got[key].ids_crc32 == zlib.crc32(np.array(tokens, "<u4").tobytes())
        at += len(tokens)
    one = token_store.read(spark, str(tmp_path / "t")).where(f"key = {ids[3]}").drop("ids")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key" in plan


def test_null_and_repeated_keys_have_places(spark, documents, tmp_path):
    frame = documents(["b c", "d", "e f g", ""], ids=[5, None, 5, 5])
    token_store.write(frame, str(tmp_path / "t"), WORDS)
    rows = token_store.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.key for r in rows] == [None, 5, 5, 5]
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    token_store.write(frame.limit(0), str(tmp_path / "none"), WORDS)
    assert token_store.read(spark, str(tmp_path / "none")).count() == 0
