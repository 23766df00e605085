import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from playmetrics.llm import bpe
from playmetrics.llm.queries import VOCABULARY, token_digests
from tests.llm.frames import AWKWARD, documents, plain

PIECES = [*"ab'stredvlm D9²½\t\n\r 　é中🎉\x1c!?\x85​́", "  ", "'re", "'ve", "'ll", "\n\n", "'S", " '", "<|endoftext|>"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_texts(seed, count, longest=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_pre_tokens_and_words_give_the_library_s_ids(ranks, library):
    texts = [*AWKWARD, *random_texts(1, 4000)]
    tokens, counts = bpe.pre_tokens(pa.array(texts, pa.string()))
    words, at = tokens.to_pylist(), 0
    for text, count in zip(texts, counts):
        own = words[at:at + count]
        at += count
        assert b"".join(own) == (text or "").encode()
        ids = [i for w in own for i in bpe.encode_word(w, ranks)]
        assert ids == library.encode_ordinary(text or ""), repr(text)
    assert at == len(words)


def test_pre_tokens_of_a_slice(ranks):
    texts = pa.array(["zero", "eins é", None, "two two", "x"])
    tokens, counts = bpe.pre_tokens(texts.slice(1, 3))
    assert tokens.to_pylist() == [b"eins", " é".encode(), b"two", b" two"]
    assert counts.tolist() == [2, 0, 2]


@pytest.mark.parametrize("alphabet", ["ab", "eéü", "0123456789", "中国人"])
def test_long_words(ranks, library, alphabet):
    rng = random.Random(len(alphabet))
    for length in (33, 200, 3000):
        word = "".join(rng.choice(alphabet) for _ in range(length))
        assert bpe.encode_word(word.encode(), ranks) == library.encode_ordinary(word)
        assert bpe._encode_long(word[:20].encode(), ranks) == bpe.encode_word(word[:20].encode(), ranks)
    assert len(bpe.encode_word(b"a" * 200_000, ranks)) == len(library.encode_ordinary("a" * 200_000))


@pytest.mark.parametrize("block_bytes, step", [(1 << 23, 1 << 21), (200, 50), (1, 1)])
def test_documents_against_the_library(spark, ranks, library, monkeypatch, block_bytes, step):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(bpe, "STEP_BYTES", step)
    texts = [*AWKWARD, *random_texts(2, 150)]
    rows = [(i // 2 if i % 7 else None, t, None, None) for i, t in enumerate(texts)]
    coded = bpe.decode(bpe.encode(documents(spark, rows), ranks), ranks).collect()
    got = sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in coded
                 if r["doc_id"] is not None)
    expected = []
    for i, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        if i is not None:
            expected.append((i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert got == sorted(expected)
    assert len(coded) == len(rows)


def test_alike_partitions(spark, ranks):
    """Tasks may have the same words, and the same documents."""
    df = plain(spark, ["one two one"] * 12, partitions=1)
    both = df.union(df).union(df)
    assert {r["n_tokens"] for r in token_digests(both).collect()} == {3}
    assert token_digests(both).count() == 36


def test_copies_side_by_side_stay_apart(spark, ranks, library, monkeypatch):
    """Blocks of one text that lie together have keys of their own, so tasks share them."""
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 200)
    monkeypatch.setattr(bpe, "STEP_BYTES", 100)
    text = "one two one " * 25
    df = plain(spark, [text] * 60, partitions=3)
    keys = [r["block"] for r in df.select("doc_id", "text").mapInArrow(
        bpe._sequencer(100, 200), "block long, doc_ids array<long>, counts binary, size long, sequence binary"
    ).collect()]
    assert len(keys) == len(set(keys)) == 60
    coded = bpe.encode(df, ranks).collect()
    expected = np.array(library.encode_ordinary(text), "<u4").tobytes()
    assert sorted(r["doc_id"] for r in coded) == list(range(60))
    assert {bytes(r["ids"]) for r in coded} == {expected}


def test_places_follow_the_shuffle_partitions(spark, monkeypatch):
    assert bpe._word_places(spark) == bpe.BUCKETS
    monkeypatch.setattr(bpe, "BUCKETS", 2)
    assert bpe._word_places(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("places", [1, 3, 100_000])
def test_any_number_of_places(spark, ranks, library, monkeypatch, places):
    monkeypatch.setattr(bpe, "_word_places", lambda _: places)
    texts = random_texts(3, 80)
    coded = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode(plain(spark, texts), ranks).collect()}
    assert coded == {
        i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in enumerate(texts)
    }


def test_planes_without_scripts_have_the_library_s_class():
    """Beside the code points that the next test encodes; unassigned planes in steps."""
    codes = [*range(0x80), *range(0x32400, 0xE0000, 61), *range(0xE0000, 0xE0200), *range(0xE0200, 0x110000, 61)]
    kinds = bpe._classes()
    for pattern, kind in ((r"\p{L}", bpe._LETTER), (r"\p{N}", bpe._NUMBER), (r"\s", bpe._SPACE)):
        one = tiktoken.Encoding("one", pat_str=pattern, special_tokens={},
                                mergeable_ranks={bytes([b]): b for b in range(256)})
        matched = [bool(ids) for ids in one.encode_ordinary_batch(list(map(chr, codes)), num_threads=1)]
        assert [kinds[c] == kind for c in codes] == matched


def test_young_letters_have_the_library_s_ids(ranks, library):
    """Every code point of the planes with letters, between letters, numbers and marks."""
    codes = [c for c in range(0x80, 0x32400) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}!{chr(c)}  " for c in codes]
    tokens, counts = bpe.pre_tokens(pa.array(texts))
    known = {}
    words = []
    for w in tokens.to_pylist():
        if w not in known:
            known[w] = bpe.encode_word(w, ranks)
        words.append(known[w])
    at = 0
    for text, count, expected in zip(texts, counts.tolist(), library.encode_ordinary_batch(texts, num_threads=4)):
        assert [i for w in words[at:at + count] for i in w] == expected, ascii(text)
        at += count


def test_a_block_that_changes_is_refused(ranks):
    words = pa.table({
        "count": pa.array([1], pa.int32()), "numbers": [bpe._packed(np.array([1]))],
        "lengths": [bpe._packed(np.array([1]))], "size": pa.array([1], pa.int64()),
        "ids": [bpe._packed(np.array([7]))],
    })
    with pytest.raises(RuntimeError, match="another order"):
        bpe._word_ids(words)


def test_empty_table(spark):
    assert token_digests(plain(spark, [])).collect() == []


def test_gaps_in_ids_are_refused(spark):
    with pytest.raises(ValueError, match="gaps"):
        bpe.decode(spark.range(1), {b"a": 0, b"b": 2})
