"""Public tokenizers read from files, and exact encoding by forced boundaries.

The vocabulary is read once on the driver and reaches the executors as a
broadcast of its bytes; a vocabulary file is a fixed size, whatever the corpus.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Where the vocabulary files lie unless a caller or the environment says otherwise.
TOKENIZER_FOLDER = os.environ.get("CORPUSMILL_TOKENIZERS", "/opt/tokenizers")
DEFAULT_TOKENIZER = "byte_bpe_50k"

# Fixed value: the pre-tokenisation pattern of the byte-level vocabularies.
PRETOKEN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct fragments kept with their ids in one Python worker before the memory is emptied.
CACHE_FRAGMENTS = 400_000
#: Longer fragments are encoded but not remembered.
CACHE_FRAGMENT_BYTES = 64
#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 22


def vocabulary_file(name: str = DEFAULT_TOKENIZER, folder: str | None = None) -> bytes:
    """The bytes of a vocabulary file: one token in base64 and its rank on each line."""
    with open(os.path.join(folder or TOKENIZER_FOLDER, f"{name}.tiktoken"), "rb") as file:
        return file.read()


def read_ranks(content: bytes) -> dict[bytes, int]:
    ranks = {}
    for line in content.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


def joined_pairs(tokens) -> np.ndarray:
    """For each pair of bytes, at ``first * 256 + second``, whether any token holds it inside."""
    pairs = np.zeros(65536, bool)
    for token in tokens:
        if len(token) > 1:
            codes = np.frombuffer(token, np.uint8).astype(np.int64)
            pairs[codes[:-1] * 256 + codes[1:]] = True
    return pairs


def _ends_space(data: np.ndarray) -> np.ndarray:
    """Whether each byte is or ends a white-space character, or a control character some patterns take for one."""
    ends = ((data >= 9) & (data <= 13)) | ((data >= 0x1C) & (data <= 0x20))
    if len(data) > 1:
        two = np.zeros(len(data), bool)
        two[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        ends |= two
    if len(data) > 2:
        a, b, c = data[:-2], data[1:-1], data[2:]
        three = np.zeros(len(data), bool)
        three[2:] = (
            ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
            | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        )
        ends |= three
    return ends


class ForcedBoundaryEncoder:
    """Exact byte-pair encoding of many texts by cutting them where no token can reach across.

    A cut is certain where the pair of bytes around it occurs inside no token
    of the vocabulary.  Of these cuts the ones used lie before a plain space,
    tab or line end that follows something else: no match of the
    pre-tokenisation pattern runs over such a place and none on either side
    depends on the other, so fragments are encoded independently and their ids
    put together.  Fragments recur, so each distinct one is encoded once.
    """

    def __init__(self, content: bytes):
        import tiktoken

        ranks = read_ranks(content)
        self.joined = joined_pairs(ranks)
        self.encoding = tiktoken.Encoding("corpus", pat_str=PRETOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, list[int]] = {}

    def cuts(self, data: bytes) -> np.ndarray:
        """Offsets of the certain cuts inside the bytes of a text."""
        codes = np.frombuffer(data, np.uint8)
        if len(codes) < 2:
            return np.zeros(0, np.int64)
        space = ((codes >= 9) & (codes <= 13)) | (codes == 32)
        certain = space[1:] & ~_ends_space(codes)[:-1] & ~self.joined[codes[:-1].astype(np.int64) * 256 + codes[1:]]
        return np.flatnonzero(certain) + 1

    def _encode(self, fragment: bytes) -> list[int]:
        ids = self.encoding.encode_ordinary(fragment.decode("utf-8"))
        if len(fragment) <= CACHE_FRAGMENT_BYTES:
            if len(self.known) >= CACHE_FRAGMENTS:
                self.known.clear()
            self.known[fragment] = ids
        return ids

    def encode_bytes(self, data: bytes, cuts: np.ndarray | None = None) -> list[list[int]]:
        """The ids of each fragment of the bytes, in order."""
        if not data:
            return []
        cuts = self.cuts(data) if cuts is None else cuts
        known, encode = self.known.get, self._encode
        places = cuts.tolist()
        pieces = [data[i:j] for i, j in zip([0, *places], [*places, len(data)])]
        return [known(piece) or encode(piece) for piece in pieces]

    def encode_column(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of a column of texts: their arrays in order, and the number of ids of each text (null: none)."""
        from itertools import chain

        data, offsets, lengths = _utf8(texts)
        parts, counts = [], np.zeros(len(lengths), np.int64)
        start = 0
        while start < len(lengths):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1)
            end = min(end, len(lengths))
            block = data[offsets[start] : offsets[end]]
            if block:
                local = offsets[start : end + 1] - offsets[start]
                cuts = np.union1d(self.cuts(block), local[1:-1])
                cuts = cuts[(cuts > 0) & (cuts < len(block))]
                ids = self.encode_bytes(block, cuts)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                sums = np.concatenate([[0], np.cumsum(sizes)])
                at = np.searchsorted(np.concatenate([[0], cuts, [len(block)]]), local)
                counts[start:end] = np.diff(sums[at])
                parts.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sums[-1])))
            start = end
        return parts, counts

    def count_column(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text; null and empty texts have none."""
        return self.encode_column(texts)[1]


def _utf8(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of a string column without gaps, the offsets of its texts in them, and their lengths."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    values = texts.fill_null("").cast(pa.large_binary())
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if not len(values):
        return b"", np.zeros(1, np.int64), np.zeros(0, np.int64)
    data = b"" if buffers[2] is None else buffers[2].to_pybytes()[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    return data, offsets, np.diff(offsets)


@lru_cache(maxsize=2)
def encoder(content: bytes) -> ForcedBoundaryEncoder:
    """The worker's encoder of a vocabulary, built once."""
    return ForcedBoundaryEncoder(content)
