"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts each text where its last bits are zero, so the same passage is
cut the same way in every document that holds it. The inside of a chunk is encoded once and
remembered (bounded, for the length of a task); documents that share it reuse ids and decoded bytes.

Cuts fall anywhere, also inside a word, so the ids beside a cut may differ from those of the whole
text. Each join is therefore re-encoded: the stretch from the last sure boundary before the cut to
the first one after it, over as many chunks as it takes. The byte-level pattern starts a piece at each
sure boundary whatever surrounds it (where white space begins, behind it, and between an ASCII
letter and a mark), so both sides agree exactly with the encoding of the whole text. Texts with white space
beyond ASCII, where that is not certain, are encoded whole.

Defined cases: NULL text is the empty text, with no ids; special strings inside a text become their
special ids, as the library does by default; rows with the same id are separate rows; other columns
are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.common import random_words, ready, slices, text_or_empty, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_GEAR = random_words(17, 256)
_MASK = np.uint64(0x1FF << 40)
#: Pieces between sure boundaries: words with the space before them, marks behind ASCII letters,
#: runs of white space without their last character, and that character unless it is a space.
_PIECE = re.compile(
    rb" ?[A-Za-z]+(?=[ \n.,!?;:])| ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?=[ \t\n\r\x0b\x0c][^ \t\n\r\x0b\x0c])"
    rb"|[ \t\n\r\x0b\x0c](?=[^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+"
)
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: What a task remembers: pieces in each of two generations, and chunks.
_PIECES = 150_000
_CHUNKS = 10_000
SLICE = 2 << 20
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where the gear hash of the 32 bytes before a position asks for a cut, at whole characters."""
    hashed = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        hashed[step:] += hashed[:-step] << np.uint64(step)
    at = np.flatnonzero((hashed & _MASK) == 0) + 1
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


class Coder:
    """Encodes and decodes with the memory of one task."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.pieces: dict[bytes, tuple[bytes, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, bytes]] = {}
        self.chunks: dict[bytes, list] = {}

    def whole(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian, 32 bits) and decoded bytes of each piece, straight from the library."""
        coded = self.tokenizer.encode_batch_fast([x.decode() for x in pieces], add_special_tokens=False)
        ids = [x.ids for x in coded]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [(array("I", i).tobytes(), b.encode()) for i, b in zip(ids, back)]

    def learn(self, pieces: list[bytes]) -> None:
        """Have every piece in memory; what was not used for a while is forgotten."""
        new = set(pieces).difference(self.pieces)
        if len(self.pieces) + len(new) > _PIECES:
            self.older, self.pieces = self.pieces, {}
            new = set(pieces)
        again = new.intersection(self.older)
        self.pieces.update((x, self.older[x]) for x in again)
        new = list(new - again)
        self.pieces.update(zip(new, self.whole(new) if new else []))

    def joined(self, pieces: list[bytes]) -> tuple[bytes, bytes]:
        found = [self.pieces[x] for x in pieces]
        return b"".join([x[0] for x in found]), b"".join([x[1] for x in found])

    def texts(self, texts: list[bytes], cuts: list[list[int]]) -> list[tuple[bytes, bytes]]:
        """Ids and decoded bytes of each text, cut at the given places."""
        plans, wanted = [], []
        for text, ends in zip(texts, cuts):
            plan, carry, at = [], b"", 0
            for end in [*ends, len(text)]:
                chunk = text[at:end]
                at = end
                known = self.chunks.get(chunk)
                if known is None:
                    known = self.parts(chunk)
                    if known[1] is None and known[0]:
                        wanted += known[0]
                    if len(self.chunks) > _CHUNKS:
                        self.chunks.clear()
                    self.chunks[chunk] = known
                carry += known[2]
                if known[3] is not None:  # a sure boundary ends the stretch over the join
                    plan.append(carry)
                    wanted.append(carry)
                    plan.append(known)
                    carry = known[3]
            plan.append(carry)
            wanted.append(carry)
            plans.append(plan)
        self.learn(wanted)
        out = []
        for plan in plans:
            ids, back = [], []
            for step in plan:
                if isinstance(step, bytes):
                    one = self.pieces[step]
                else:
                    if step[1] is None:
                        step[1] = self.joined(step[0])
                        step[0] = None
                    one = step[1]
                ids.append(one[0])
                back.append(one[1])
            out.append((b"".join(ids), b"".join(back)))
        return out

    @staticmethod
    def parts(chunk: bytes) -> list:
        """``[inner pieces, their coding or None, head, tail or None]``.

        Head and tail touch the cuts and take part in the joins; without a sure boundary the whole
        chunk is head.
        """
        pieces = _PIECE.findall(chunk)
        if len(pieces) < 2:
            return [[], (b"", b""), chunk, None]
        return [pieces[1:-1], None, pieces[0], pieces[-1]]


def code(coder: Coder, array: pa.Array) -> list[tuple[bytes, bytes]]:
    """Ids and decoded bytes of each text of an Arrow string array."""
    data, offsets = utf8(array)
    ends = chunk_ends(data)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    odd = [i for i, x in enumerate(texts) if _OTHER_SPACE.search(x.decode())]
    bounds = np.searchsorted(ends, offsets)
    cuts = []
    for i in range(len(texts)):
        inside = ends[bounds[i] : bounds[i + 1]] - offsets[i]
        cuts.append(inside[inside > 0].tolist())
    plain = [i for i in range(len(texts)) if i not in set(odd)]
    out: list = [None] * len(texts)
    for i, x in zip(plain, coder.texts([texts[i] for i in plain], [cuts[i] for i in plain])):
        out[i] = x
    for i, x in zip(odd, coder.whole([texts[i] for i in odd]) if odd else []):
        out[i] = x
    return out


def encode_ids(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of every text and the text they decode to."""
    ready(documents.sparkSession)

    def run(batches):
        coder = Coder(path)  # its memory goes when the task ends
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = code(coder, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([np.frombuffer(x[0], "<u4").astype(np.int32) for x in found], pa.list_(pa.int32())),
                        pa.array([x[1].decode() for x in found], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return documents.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row."""
    ready(documents.sparkSession)

    def run(batches):
        coder = Coder(path)  # its memory goes when the task ends
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = code(coder, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x[0]) // 4 for x in found], pa.int64()),
                        pa.array([hashlib.sha256(x[0]).hexdigest() for x in found], pa.string()),
                        pa.array([hashlib.sha256(x[1]).hexdigest() for x in found], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
