"""Token counts against the libraries on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from playmetrics.llm import queries, segments, token_counts
from tests.llm.frames import AWKWARD, documents, plain

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")
# characters that are, or look like, white space; control strings; marks that a tokenizer uses itself
PARTS = [
    "a", "b", "'s", "'", " ", "  ", "\n", "\t", "　", "\xa0", "\u0085", " ", "中", "é",
    "é", "1", "½", "!", "<|endoftext|>", "<|endo", "▁", "▁ ", "\x1c", "\x00", "᠎",
    "​", "<s>", "<unk>", "<0x41>", "😀", " ́", "\r\n", "Σ", "ς ",
]


def by_library(path, texts, specials_as_text=False):
    """The libraries as anyone would call them."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = specials_as_text
        return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    import sentencepiece
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(processor.encode(t or "")) for t in texts]


def run(df, name, **settings):
    found = token_counts.count_tokens(df, public_tokenizers.path(name), **settings).collect()
    return {r["doc_id"]: r for r in found}


def odd_texts(count, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(count)]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("specials_as_text", [False, True])
def test_counts_are_the_librarys(spark, name, specials_as_text):
    texts = [*AWKWARD, *odd_texts(2000), "<|endoftext|> a <|endoftext|>", "x" * 3000, "中" * 3000]
    got = run(plain(spark, texts), name, specials_as_text=specials_as_text, batch_bytes=100)
    path = public_tokenizers.path(name)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == by_library(path, texts, specials_as_text)
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len((t or "").encode()) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_all_three_files_are_cut(name):
    assert segments.load(segments.read_tokenizer(public_tokenizers.path(name))).cuts


def test_other_files_are_not_cut():
    spec = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel", "use_regex": True}}
    allowed = segments._json_allows_cuts
    assert allowed(spec)
    assert not allowed({**spec, "pre_tokenizer": None})
    assert not allowed({**spec, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}})
    assert not allowed({**spec, "normalizer": {"type": "Prepend"}})
    assert not allowed({**spec, "model": {"type": "Unigram"}})
    assert not allowed({**spec, "added_tokens": [{"content": "a b"}]})
    assert not allowed({**spec, "added_tokens": [{"content": "ab", "lstrip": True}]})


def test_query_on_the_supplied_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op12_token_counts(spark, folder).collect()}
    want = by_library(public_tokenizers.path("byte_bpe_50k.json"), [d["text"] for d in docs])
    assert len(got) == len(docs)
    for doc, n in zip(docs, want):
        r = got[doc["doc_id"]]
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024)
        assert r["n_bytes"] == len((doc["text"] or "").encode())


def test_empty_repeated_and_null_ids(spark):
    assert run(plain(spark, []), FILES[0]) == {}
    rows = [(1, "a b", "", ""), (1, "a b", "", ""), (None, "c", None, None), (None, None, None, None)]
    found = token_counts.count_tokens(documents(spark, rows), public_tokenizers.path(FILES[0]), 1)
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == [(1, 3, 2, True)] * 2 + [(None, 0, 0, False), (None, 1, 1, False)]


def test_batches_are_balanced_by_bytes():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 5000)
    lengths[100] = 10_000
    found = list(segments.runs(lengths, 1000))
    assert found[0][0] == 0 and found[-1][1] == 5000
    assert all(b == c for (_, b), (c, _) in zip(found, found[1:]))
    assert max(lengths[a:b].sum() for a, b in found if not a <= 100 < b) <= 1060
    assert list(segments.runs(np.zeros(0, np.int64), 10)) == []


def test_a_long_text_is_cut_and_pieces_seen_once():
    text = " ".join(f"word{i % 50}" for i in range(100_000))
    raw, edges = segments.joined(pa.array([text, None, ""]))
    starts = segments.cut_places(raw, edges)
    assert len(starts) == 100_000
    seen = []
    memo = segments.Memo(lambda texts: seen.extend(texts) or list(map(len, texts)))
    pieces = segments.pieces_of(raw, starts).dictionary_encode().dictionary.to_pylist()
    assert len(memo.of(pieces)) == len(seen) == 51
    memo.of(pieces)
    assert len(seen) == 51


def test_a_full_memo_changes_nothing():
    memo = segments.Memo(lambda texts: list(map(len, texts)), most=3)
    for words in ([b"a", b"bb"], [b"bb", b"ccc", b"dddd"], [b"a", b"eeeee"], [b"eeeee" * 20]):
        assert memo.of(words) == list(map(len, words))
    assert len(memo.known) == 3


def test_unknown_kinds_of_file_are_refused():
    with pytest.raises(ValueError, match="neither a .json nor a .model"):
        segments.read_tokenizer("ranks.tiktoken")
