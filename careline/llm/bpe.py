"""Byte-level BPE by prefix dynamic programming.

Every prefix of a piece of bytes has exactly one valid encoding, so it has exactly one valid
*last token*.  A table of these last tokens holds all prefixes' encodings at once: the encoding
of a prefix ends with its last token and goes on with that of the shorter prefix in front of it.
A token may follow another one only if the two, put together, are encoded as just these two.
Hence a piece is encoded in time linear in its length, bytes can be appended without touching
what is there, and after an edit only the entries near it have to be computed anew.
"""

import base64
import re
import zlib
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a task's tables of seams and prefixes, and bytes of its tables of texts, before they start anew;
#: results do not depend on them.
MEMO, MEMO_BYTES = 200_000, 96 << 20
#: Longer segments are encoded without being remembered.
MEMO_CHARS = 48

_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|\s ")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a rank file."""
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file's lines: base64 of the token's bytes, blank, rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class Vocabulary:
    """Ranks, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        ends: dict[bytes, set[int]] = {}
        for b in ranks:
            for n in {min(len(b), k) for k in (1, 2, 3)}:
                ends.setdefault(b[-n:], set()).add(len(b))
        #: Last bytes (three, or all if there are fewer) -> lengths of the tokens that can end there, long ones first.
        self._lengths = {e: sorted((n for k in range(1, len(e) + 1) for n in ends.get(e[-k:], ())
                                    if k == 3 or n == k or (k == len(e) and n <= k)), reverse=True) for e in ends}
        self._prefixes: dict[bytes, int] = {}
        self._whole: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}

    def merge(self, data: bytes, down_to: int = 1) -> list[int]:
        """The definition: merge the leftmost pair of lowest rank until none, or so many parts, are left.

        Only for the few bytes of one or two tokens; quadratic.
        """
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this one token."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merge(self.bytes_of[token]) == [token]
        return known

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this token joins; None for a single byte."""
        known = self._halves.get(token, ())
        if known == ():
            parts = self.merge(self.bytes_of[token], down_to=2)
            known = self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` in an encoding.

        Merges are undone from the latest on, and only the parts that touch the seam matter.  Could
        those have been joined before the merge that was just undone, the seam would not exist.
        Of two merges of one rank the one on the left comes first.
        """
        known = self._pairs.get(left << 32 | right)
        if known is None:
            if len(self._pairs) >= MEMO:
                self._pairs.clear()
            known = self._pairs[left << 32 | right] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < before:
                return False
            of_left, of_right = self.halves(left), self.halves(right)
            if of_left and (left > right or not of_right):
                before, left = left, of_left[1]
            elif of_right:
                before, right = right + 1, of_right[0]
            else:
                return True

    def lengths(self, end: bytes) -> list[int]:
        """Lengths to try for a token at an end of text, of which the last three bytes are given."""
        known = self._lengths.get(end)
        return self._lengths.setdefault(end, [2, 1] if len(end) > 1 else [1]) if known is None else known

    def last_token(self, prefix: bytes) -> int:
        """The one token that may end the encoding of these few bytes; remembered for all pieces."""
        known = self._prefixes.get(prefix)
        if known is not None:
            return known
        n = len(prefix)
        for length in self.lengths(prefix[-3:]):
            if length > n:
                continue
            token = self.ranks.get(prefix[n - length:])
            if token is not None and self.whole(token) and (
                    length == n or self.follows(self.last_token(prefix[:n - length]), token)):
                if len(self._prefixes) >= MEMO:
                    self._prefixes.clear()
                self._prefixes[prefix] = token
                return token
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece, from its prefixes' last tokens."""
        if len(piece) > MEMO_CHARS:
            return PrefixTable(self, piece).ids()
        out = []
        while piece:
            token = self.last_token(piece)
            out.append(token)
            piece = piece[:-len(self.bytes_of[token])]
        return out[::-1]


class PrefixTable:
    """The last token of each prefix of a piece of bytes of any length, open to appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; entries of the prefixes before stay as they are."""
        begin = len(self.data) + 1
        self.data += data
        for end in range(begin, len(self.data) + 1):
            self.last.append(self._last_of(end))

    def _last_of(self, end: int) -> int:
        data, last, v = self.data, self.last, self.vocabulary
        for length in v.lengths(data[max(0, end - 3):end]):
            start = end - length
            if start < 0:
                continue
            token = v.ranks.get(data[start:end])
            if token is not None and v.whole(token) and (start == 0 or v.follows(last[start], token)):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of ``[start, end)``; the number of entries computed anew.

        Entries up to ``start`` stay.  Those behind the edit follow from the bytes behind it and
        from as many entries as the longest token has bytes: once that many agree with the old
        ones, all others do, and are kept.
        """
        old, tail = self.last, self.data[end:]
        self.data = self.data[:start] + data + tail
        shift = len(data) - (end - start)
        self.last = old[:start + 1]
        agree = done = 0
        for at in range(start + 1, len(self.data) + 1):
            self.last.append(self._last_of(at))
            done += 1
            before = at - shift
            agree = agree + 1 if before > end and self.last[at] == old[before] else 0
            if agree >= self.vocabulary.longest:
                self.last += old[before + 1:]
                break
        return done

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the prefix of this length (the whole if None)."""
        at, out = len(self.data) if length is None else length, []
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[self.last[at]])
        return out[::-1]


class _Memo(dict):
    """Text -> ids as bytes of 32-bit numbers, computed when first asked for; bounded in bytes."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit, self.held = compute, limit, 0

    def __missing__(self, text: str) -> bytes:
        ids = self.compute(text)
        if len(text) <= MEMO_CHARS:
            self.held += 180 + len(text) + len(ids)  # with what Python needs for an entry and its two objects
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[text] = ids
        return ids


class Encoder:
    """Encodes texts: the pattern cuts them into pieces, a prefix table encodes each piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_bytes: int = MEMO_BYTES):
        self.vocabulary = Vocabulary(ranks)
        self.find = regex.compile(pattern).findall
        self.piece = _Memo(self._piece, memo_bytes // 4)
        self.spaced = _Memo(self._spaced, memo_bytes)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece; one that is a token as a whole is that token."""
        data = piece.encode("utf-8")
        whole = self.vocabulary.ranks.get(data)
        return array("i", self.vocabulary.encode(data) if whole is None else (whole,)).tobytes()

    def _spaced(self, segment: str) -> bytes:
        """Ids of a segment with a blank in front; letters, and letters with one sign, need no pattern."""
        if segment.isalpha():
            return self._piece(" " + segment)
        if segment[-1] in ",." and segment[:-1].isalpha():
            return self.spaced[segment[:-1]] + self.piece[segment[-1]]
        return self.pieces(" " + segment)

    def pieces(self, text: str) -> bytes:
        """Ids of a text, piece by piece."""
        return b"".join(map(self.piece.__getitem__, self.find(text)))

    def packed(self, text: str) -> bytes:
        """Ids of a text, as bytes of 32-bit numbers.

        A single blank between two other characters always begins a piece, so what stands
        between such blanks is encoded by itself, and only once if it comes again.
        """
        if text[:1] == " " or text[-1:] == " " or _ODD.search(text):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
        return self.pieces(first) + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return np.frombuffer(self.packed(text), np.int32).tolist()


def _share(spark: SparkSession, ranks_path: str):
    """The rank file's bytes as a broadcast variable; their size is the vocabulary's, whatever the corpus."""
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder for each worker; what it remembers is bounded, and serves the next task."""
    key = (zlib.crc32(shared.value), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(shared.value), pattern)
    return _ENCODERS[key]


def _ids_of(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    """The ids of each text of a batch."""
    parts = [encoder.packed(value.as_py() or "") for value in texts]
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(df: DataFrame, text: str, ranks_path: str, pattern: str, into: str = "ids") -> DataFrame:
    """``df`` with column ``into``: the token ids (array<int>) of the whole text.

    Special tokens are ordinary text.  Null and empty texts get an empty array; every row is
    encoded by itself, so ties, repeated rows and other columns do not matter.  A column that is
    named like ``into`` is replaced.
    """
    shared = _share(df.sparkSession, ranks_path)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, pattern)
        for texts in batches:
            yield _ids_of(encoder, texts)

    return df.withColumn(into, ids_of(F.col(text)))


def decode(df: DataFrame, ids: str, ranks_path: str, into: str = "decoded") -> DataFrame:
    """``df`` with column ``into``: the bytes (binary) that the ids stand for.

    Null and empty arrays get no bytes; an id outside the vocabulary raises an error.
    """
    shared = _share(df.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _byte_table(parse_ranks(shared.value))
        for arrays in batches:
            yield _bytes_of(table, arrays)

    return df.withColumn(into, bytes_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def encode_and_decode(df: DataFrame, text: str, ranks_path: str, pattern: str, into: str = "coded") -> DataFrame:
    """``df`` with the struct ``into``: ``ids`` as ``encode`` gives them, and ``decoded`` as ``decode`` does of these ids.

    One Python function does both, so a core has one worker with one rank table.
    """
    shared = _share(df.sparkSession, ranks_path)

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, pattern)
        table = _byte_table(encoder.vocabulary.ranks)
        for texts in batches:
            ids = _ids_of(encoder, texts)
            yield pa.StructArray.from_arrays([ids, _bytes_of(table, ids)], ["ids", "decoded"])

    return df.withColumn(into, code(F.col(text)))


def _bytes_of(table: pa.Array, arrays: pa.ListArray) -> pa.Array:
    """The bytes of each array of ids of a batch."""
    arrays = arrays.fill_null([]) if arrays.null_count else arrays
    ends, flat = arrays.offsets.to_numpy(), arrays.values.to_numpy(zero_copy_only=False)
    flat = flat[ends[0]:ends[-1]] if len(ends) else flat
    got = table.take(pa.array(flat, pa.int32()))
    if got.null_count:
        raise ValueError("an id that the vocabulary does not have")
    starts = np.frombuffer(got.buffers()[1], np.int32, len(got) + 1, got.offset * 4) if len(got) else np.zeros(1, np.int32)
    cuts = starts[ends - ends[0]].astype(np.int32)
    data = got.buffers()[2] or pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.binary(), len(arrays), [None, pa.py_buffer(cuts.tobytes()), data])


def _byte_table(ranks: dict[bytes, int]) -> pa.Array:
    """Bytes by id."""
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for data, i in ranks.items():
        table[i] = data
    return pa.array(table, pa.binary())


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one blank."""
    return F.concat_ws(" ", ids.cast("array<string>"))

