"""Byte-level BPE over Arrow batches.

The vocabulary writes each byte as one printable character. `encode` cuts a text into the matches of the
tokenizer's pattern, encodes each with the tokenizers library, and gives the ids with, on request, the byte and
character span of each token. `decode` reverses the byte table, so it gives the exact bytes again, also where a
character is split over several tokens.

Defined results: a null text is an empty text, which has no tokens; strings of special tokens in a text are
ordinary text; repeated rows stay repeated; a clashing column of the input is replaced. A match longer than
`LONG_PIECE` characters is encoded but not remembered, and memory for pieces is bounded by `CACHE_PIECES`.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meshroad.llm.common import field, release, with_columns_from

CACHE_PIECES = 300_000
LONG_PIECE = 64
# The pieces of a batch are gathered for about so many characters before new ones are encoded together.
GATHER_CHARS = 1_000_000
# So many pieces are encoded at once: the library's result objects take about a kilobyte each.
ENCODE_PIECES = 4_000


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    table = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder for one vocabulary; lives in a task. Without a pattern it only decodes."""

    def __init__(self, path: str, pattern: str | None = None):
        if pattern is not None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import regex
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True
            self.pieces = regex.compile(pattern).findall
        to_byte = byte_characters()
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(to_byte[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.cache: dict[str, bytes] = {}

    def _encode_new(self, pieces: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for i in range(0, len(pieces), ENCODE_PIECES):
            some = pieces[i:i + ENCODE_PIECES]
            made = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            found.update((p, np.array(e.ids, dtype="<u4").tobytes()) for p, e in zip(some, made))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (size < GATHER_CHARS or end == start):
                size += len(texts[end])
                end += 1
            cut = [self.pieces(t) for t in texts[start:end]]
            new = {p for c in cut for p in c} - self.cache.keys()
            if len(self.cache) + len(new) > CACHE_PIECES:
                self.cache.clear()
                new = {p for c in cut for p in c}
            found = self._encode_new(list(new))
            self.cache.update(found)
            get = self.cache.__getitem__
            out += [b"".join(map(get, c)) for c in cut]
            for p in new:
                if len(p) > LONG_PIECE:
                    del self.cache[p]
            start = end
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def spans(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte end, first character and end character of each token; tokens of one split character share it."""
        numbers = np.frombuffer(ids, dtype="<u4")
        ends = np.cumsum(self.lengths[numbers]) if len(numbers) else np.zeros(0, np.int64)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        starts_char = (raw & 0xC0) != 0x80
        char_of = np.cumsum(starts_char) - 1  # the character each byte belongs to
        begins = ends - self.lengths[numbers]
        return ends, char_of[begins] if len(ends) else ends, char_of[ends - 1] + 1 if len(ends) else ends


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the public 50k vocabulary of this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def encode(df: DataFrame, text: str = "text", *, path: str | None = None, pattern: str | None = None,
           spans: bool = False, decoded: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Add `token_ids` (packed little-endian unsigned 32-bit integers, as token shards hold them) and `n_tokens`.

    With `spans`, also `byte_end`, `char_start` and `char_end`, one entry for each token. With `decoded`, also the bytes
    that `decode` would give, made of the ids in the same Python worker instead of in a second one beside it.
    """
    added = [field("token_ids", T.BinaryType()), field("n_tokens", T.LongType())]
    if spans:
        added += [field(n, T.ArrayType(T.LongType())) for n in ("byte_end", "char_start", "char_end")]
    if decoded:
        added.append(field("decoded", T.BinaryType()))

    def make():
        codec = Codec(path or default_vocabulary()[0], pattern or default_vocabulary()[1])
        release()  # what reading the vocabulary took

        def work(columns):
            texts = [t or "" for t in columns[0].to_pylist()]
            ids = codec.encode(texts)
            out = [pa.array(ids, pa.binary()), [len(i) // 4 for i in ids]]
            if spans:
                found = [codec.spans(t, i) for t, i in zip(texts, ids)]
                out += [[f[k].tolist() for f in found] for k in range(3)]
            if decoded:
                out.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
            return out

        return work

    return with_columns_from(df, [text], make, added, keep)


def decode(df: DataFrame, token_ids: str = "token_ids", *, path: str | None = None, keep: list[str] | None = None,
           as_text: bool = False) -> DataFrame:
    """Add `decoded`, the bytes of the tokens; with `as_text` also `decoded_text`, where bytes that are no character
    (an id list cut inside one) become U+FFFD. Null ids decode to nothing."""
    added = [field("decoded", T.BinaryType())] + ([field("decoded_text", T.StringType())] if as_text else [])

    def make():
        codec = Codec(path or default_vocabulary()[0])

        def work(columns):
            raw = [codec.decode(i or b"") for i in columns[0].to_pylist()]
            return [pa.array(raw, pa.binary())] + ([[r.decode("utf-8", "replace") for r in raw]] if as_text else [])

        return work

    return with_columns_from(df, [token_ids], make, added, keep)
