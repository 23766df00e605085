"""The alignment against the libraries on whole texts and a token-by-token search for overlaps."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest

from playmetrics.llm import alignment, queries, segments
from tests.llm.frames import AWKWARD, documents, plain
from tests.llm.test_token_counts import odd_texts

A, B = map(public_tokenizers.path, queries.ALIGNED)


def library_tokens(text):
    """Ids and bytes of both sides, decoded by rules written down here once more."""
    from tokenizers import Tokenizer
    import sentencepiece

    tokenizer = library_tokens.__dict__.setdefault("a", Tokenizer.from_file(A))
    tokenizer.encode_special_tokens = True
    processor = library_tokens.__dict__.setdefault(
        "b", sentencepiece.SentencePieceProcessor(model_file=B)
    )
    seen = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    char = {b: chr(b) for b in seen}
    char |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in seen)}
    byte = {c: b for b, c in char.items()}
    first = tokenizer.encode(" " + text, add_special_tokens=False)
    side_a = [(i, bytes(byte[c] for c in tokenizer.id_to_token(i))) for i in first.ids]
    side_b = []
    for i in processor.encode(text):
        piece = processor.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            side_b.append((i, bytes([int(piece[3:5], 16)])))
        else:
            side_b.append((i, piece.replace("▁", " ").encode()))
    return side_a, side_b


def spans(side):
    place, found = 0, []
    for i, data in side:
        found.append((i, place, place + len(data)))
        place += len(data)
    return found


def slow(texts):
    """One result per text, by comparing every token with every other."""
    count, rows = Counter(), []
    for text in texts:
        side_a, side_b = library_tokens(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(d for _, d in s) != whole for s in (side_a, side_b)):
            rows.append(None)
            continue
        a, b = spans(side_a), spans(side_b)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, before = [], 0
        for cut in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, start, end in side if start >= before and end <= cut)
                for side in (a, b)
            ))
            before = cut
        rows.append((len(a), len(b), groups, links))
    best = {}
    for (a, b), k in count.items():
        best[b] = max(best.get(b, 0), k)
    found = []
    for row in rows:
        if row is None:
            found.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        found.append((
            n_a, n_b, len(groups), len(links), sum(count[p] == best[p[1]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return found


def run(df, **settings):
    found = alignment.align_documents(df, A, B, **settings).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in found}, len(found)


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 22])
def test_against_every_pair_of_tokens(spark, block_bytes):
    short = [t for t in AWKWARD if t is None or len(t) < 1000]
    texts = [*short, *odd_texts(120), "x" * 400, "中" * 200, "mixed\r\n<|endoftext|> text ▁", " ", "  a  "]
    got, rows = run(plain(spark, texts), block_bytes=block_bytes)
    want = slow(texts)
    assert rows == len(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] == 0 for w in want) > 10 and sum(w[4] for w in want) > 100


def test_query_on_the_supplied_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op11_cross_tokenizer_alignment(spark, folder).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in found}
    docs = sorted(docs, key=lambda d: len(d["text"] or ""))
    long = [d for d in docs if len(d["text"] or "") >= 6000]
    assert len(found) == len(docs)
    # counts go over the whole table; comparing all tokens of the longest texts takes too long
    for d in long:
        side_a, side_b = library_tokens(d["text"])
        assert got[d["doc_id"]][:2] == (len(side_a), len(side_b))
    if not long:
        assert [got[d["doc_id"]] for d in docs] == slow([d["text"] for d in docs])
    else:
        own = [d for d in docs if len(d["text"] or "") < 6000]
        for d, w in zip(own, slow([d["text"] for d in own])):
            assert got[d["doc_id"]][:4] == w[:4] and got[d["doc_id"]][6] == w[6]


def test_a_very_long_text(spark):
    text = " ".join(f"word{i % 977} élan" for i in range(20_000))
    (n_a, n_b, groups, links, best, total, digest), = run(plain(spark, [text, ""]))[0][0],
    side_a, side_b = library_tokens(text)
    assert (n_a, n_b) == (len(side_a), len(side_b))
    ends = [{end for _, _, end in spans(s)} for s in (side_a, side_b)]
    assert (groups, links) == (len(ends[0] & ends[1]), len(ends[0] | ends[1]))
    assert 0 < best <= links and total >= links


def test_ties_are_all_best(spark):
    """Every pair of a text that occurs once has the same count as its rivals, or is alone."""
    got, _ = run(plain(spark, ["zq xv", "zq xv"]))
    assert got[0] == got[1] == slow(["zq xv", "zq xv"])[0]


def test_empty_repeated_and_null_ids(spark):
    assert run(plain(spark, [])) == ({}, 0)
    rows = [(1, "a b", "", ""), (1, "a b", "", ""), (None, "a b", None, None), (None, None, None, None)]
    found = alignment.align_documents(documents(spark, rows), A, B).collect()
    want = slow(["a b"] * 3 + [None])
    assert sorted((tuple(r) for r in found), key=str) == sorted(
        [(i, *w) for (i, *_), w in zip(rows, want)], key=str
    )


def test_partitions_do_not_matter(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "élan", "x1", "中文", "’s"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), "", "") for i in range(120)]
    assert run(documents(spark, rows, 2)) == run(documents(spark, rows, 7), block_bytes=50)


def test_tokens_as_bytes():
    assert alignment.token_bytes(["Ġa", "Ċ", "é"], True) == [b" a", b"\n", b"\xe9"]
    assert alignment.token_bytes(["▁a", "<0x0A>", "é", "<0xZZ>"], False) == [b" a", b"\n", "é".encode(), b"<0xZZ>"]


def test_the_order_of_files_is_checked(spark):
    with pytest.raises(ValueError, match="must be a .json file"):
        alignment.align_documents(plain(spark, ["a"]), B, A)


def test_packed_numbers_come_back():
    import numpy as np
    numbers = np.array([0, 1, 255, 256, 2**32 - 1])
    assert alignment._unpacked(alignment._packed(numbers), 5).tolist() == numbers.tolist()
    assert alignment._unpacked(alignment._packed(numbers[:0]), 0).tolist() == []
    assert len(segments.cut_places(*segments.joined(pa.array(["", None]), " "))) == 0
