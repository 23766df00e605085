"""Cut texts where no token crosses, and let a tokenizer see each distinct piece once.

Both kinds of tokenizer file are handled: ``.json`` of the library ``tokenizers`` and ``.model`` of
``sentencepiece``. A text is cut before a blank that follows a character which is not white space.
For byte-level and word tokenizers of the first kind no pre-token reaches over such a place. A piece of
the second kind may only start with its mark for a blank, so no merge reaches over it either; there the
blank itself is left out, as the tokenizer puts one in front of every text. ``load`` looks at the
file and says whether it allows cuts; if not, whole texts are encoded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space beyond ASCII as UTF-8, and the mark that sentencepiece uses for a blank.
_WIDE_SPACES = (
    0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
MARK = "▁"
_BPE = 2


@dataclass(frozen=True)
class TokenizerFile:
    """A tokenizer file's name and bytes; they are read on the driver and broadcast."""

    name: str
    data: bytes


def read_tokenizer(path: str) -> TokenizerFile:
    """A vocabulary is small and fixed: some megabytes."""
    if not path.endswith((".json", ".model")):
        raise ValueError(f"{path} is neither a .json nor a .model file")
    with open(path, "rb") as file:
        return TokenizerFile(os.path.basename(path), file.read())


@dataclass(frozen=True)
class Loaded:
    """``ids`` encodes texts; ``cuts`` says whether pieces may be encoded apart, ``drops_blank`` whether
    a piece is to be given without its first blank; ``tokens`` are all tokens by id."""

    ids: Callable[[Sequence[str]], list[list[int]]]
    cuts: bool
    drops_blank: bool
    tokens: list[str]


def _json_allows_cuts(spec: dict) -> bool:
    steps = spec.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    regex = [s for s in steps if s.get("type") == "Split" or s.get("use_regex")]
    plain = all(s.get("type") in ("Split", "ByteLevel") for s in steps)
    prefix = any(s.get("add_prefix_space") for s in steps)
    patterns = [s["pattern"].get("Regex", "") for s in steps if s.get("type") == "Split"]
    # patterns that look behind, or take in white space after other characters, are not cut
    known = all("(?<" not in p and "\\s" in p for p in patterns)
    normalizer = spec.get("normalizer") or {}
    normalizers = normalizer.get("normalizers", [normalizer] if normalizer else [])
    local = all(n.get("type") in ("NFC", "Lowercase", "Replace") for n in normalizers)
    added = [t["content"] for t in spec.get("added_tokens", [])]
    loose = any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
    return bool(
        regex and plain and not prefix and known and local and not loose
        and not any(c.isspace() for token in added for c in token)
        and spec["model"].get("type") == "BPE"
    )


def _load_json(data: bytes, specials_as_text: bool) -> Loaded:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    text = data.decode("utf-8")
    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = specials_as_text

    def ids(texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return Loaded(ids, _json_allows_cuts(json.loads(text)), False, tokens)


def _load_model(data: bytes) -> Loaded:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    processor = sentencepiece.SentencePieceProcessor(model_proto=data)
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(data)
    tokens = [processor.id_to_piece(i) for i in range(processor.vocab_size())]
    norm, trainer = spec.normalizer_spec, spec.trainer_spec
    cuts = (
        norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix
        and not norm.remove_extra_whitespaces and trainer.model_type == _BPE
        and not trainer.treat_whitespace_as_suffix
        and not any(MARK in t.lstrip(MARK) for t in tokens)
    )
    return Loaded(lambda texts: processor.encode(list(texts), num_threads=1), cuts, True, tokens)


@lru_cache(maxsize=4)
def load(file: TokenizerFile, specials_as_text: bool = False) -> Loaded:
    """The tokenizer, kept by a Python worker for its next tasks.

    ``specials_as_text`` makes strings of special tokens inside texts ordinary text; otherwise they
    are handled as by the library's default.
    """
    if file.name.endswith(".json"):
        return _load_json(file.data, specials_as_text)
    return _load_model(file.data)


def joined(texts: pa.Array, lead: str = "") -> tuple[bytes, np.ndarray]:
    """All texts end to end, each with ``lead`` before it, and where each starts; then the end.

    A text that is null or empty has no bytes, and no ``lead``.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lead:
        front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", lead).cast(pa.large_string())
        texts = pc.binary_join_element_wise(front, texts, pa.scalar("", pa.large_string()))
    if not len(texts):
        return b"", np.zeros(1, np.int64)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = bytes(memoryview(data)[edges[0]:edges[-1]]) if data is not None else b""
    return raw, edges - edges[0]


def cut_places(raw: bytes, edges: np.ndarray) -> np.ndarray:
    """Where pieces start: at the start of every text that is not empty, and before each blank that
    follows a character other than white space, a control character or ``MARK``.

    The last blank of a text stays with what is before it: alone it would be an empty text to a
    tokenizer that puts a blank in front.
    """
    data = np.frombuffer(raw, np.uint8)
    starts = np.zeros(len(data), bool)
    blank = data == 0x20
    blank[edges[1:][edges[1:] > 0] - 1] = False
    at = np.flatnonzero(blank[1:]) + 1
    before = data[at - 1]
    fine = (before > 0x20) & (before != 0x7F)
    wide = np.flatnonzero(before >= 0x80)
    for char in (*map(chr, _WIDE_SPACES), MARK):
        code = char.encode("utf-8")
        own = wide[before[wide] == code[-1]]
        same = np.ones(len(own), bool)
        for back, byte in enumerate(reversed(code), 1):
            place = at[own] - back
            same &= (place >= 0) & (data[np.maximum(place, 0)] == byte)
        fine[own[same]] = False
    starts[at[fine]] = True
    starts[edges[:-1][np.diff(edges) > 0]] = True
    return np.flatnonzero(starts)


def pieces_of(raw: bytes, starts: np.ndarray) -> pa.Array:
    """The pieces that start at ``starts``, without a copy."""
    places = np.append(starts, len(raw)).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(raw)]
    )


def runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose lengths add up to about ``most``; one that is longer stands alone."""
    step = (np.cumsum(lengths, dtype=np.int64) - 1).clip(0) // max(most, 1)
    edges = np.flatnonzero(np.diff(step)) + 1
    for first, after in zip([0, *edges.tolist()], [*edges.tolist(), len(lengths)]):
        if after > first:
            yield first, after


class Memo:
    """Values of pieces, computed in batches of about equal bytes.

    The first ``most`` short pieces are remembered, which frequent ones are among; others are computed
    whenever a call brings them. A memo that a worker keeps serves its next tasks too.
    """

    def __init__(
        self, compute: Callable[[list[bytes]], list[Any]], batch_bytes: int = 1 << 18,
        most: int = 1 << 19, longest: int = 64,
    ):
        self.compute, self.batch_bytes, self.most, self.longest = compute, batch_bytes, most, longest
        self.known: dict[bytes, Any] = {}

    def of(self, pieces: list[bytes]) -> list[Any]:
        """The values of distinct pieces."""
        found = list(map(self.known.get, pieces))
        missing = [i for i, value in enumerate(found) if value is None]
        lengths = np.fromiter((len(pieces[i]) for i in missing), np.int64, len(missing))
        for first, after in runs(lengths, self.batch_bytes):
            own = missing[first:after]
            for i, value in zip(own, self.compute([pieces[i] for i in own])):
                found[i] = value
                if len(self.known) < self.most and len(pieces[i]) <= self.longest:
                    self.known[pieces[i]] = value
        return found


def as_texts(pieces: Sequence[bytes], skip: int = 0) -> list[str]:
    """Pieces for a tokenizer, without their first ``skip`` bytes."""
    return [p[skip:].decode("utf-8", "replace") for p in pieces]
