"""Byte-level BPE by prefix dynamic programming.

For each byte prefix of a piece there is exactly one token that can end its encoding:
the token ``t`` for which the prefix before ``t`` ends in a token that BPE would not
merge across the border to ``t``. Storing that last token per prefix gives the encoding
of every prefix, so bytes can be appended without a second pass, and an edit needs new
entries only until they agree with the old ones again.

Rules for odd input: NULL text is empty; an empty text has no ids; a piece of any length
costs time in proportion to its bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces kept in a worker's memory; when full it starts again. Results don't depend on it.
CACHED_PIECES = 500_000
#: Characters of text whose pieces are encoded together.
GROUP_CHARS = 2_000_000


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}


class Vocabulary:
    """Tokens, how each came from two others, and which pairs can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.halves = {}
        self.usable = {}
        for token, rank in ranks.items():
            halves = self._halves(token)
            if halves is not None:
                self.halves[rank] = halves
                self.usable[token] = rank
        self.pairs: dict[int, bool] = {}
        by_end: dict[bytes, set[int]] = {}
        for token in self.usable:
            by_end.setdefault(token[-3:], set()).add(len(token))
        short = {end: lengths for end, lengths in by_end.items() if len(end) < 3}
        #: Lengths, longest first, of the tokens that end in up to three given bytes.
        self.lengths = {}
        for end, lengths in by_end.items():
            own = lengths.union(*(short.get(end[i:], ()) for i in range(1, len(end))))
            self.lengths[end] = sorted(own, reverse=True)

    def lengths_at(self, end: bytes) -> list[int]:
        """As ``lengths``, for bytes that no token of three bytes or more ends in."""
        while end not in self.lengths:
            end = end[1:]
        return self.lengths[end]

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """The two ranks of the last merge of a token; None if merging never gives it."""
        ranks = self.ranks
        if len(token) == 1:
            return ranks[token], ranks[token]
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 40:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return ranks[parts[0]], ranks[parts[1]]

    def side_by_side(self, left: int, right: int) -> bool:
        """BPE leaves the border between the two tokens alone.

        Undo the merges next to the border, latest first; a merge across it would have
        come first if its rank is below that of the merge just undone.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[key] = self._side_by_side(left, right)
        return known

    def _side_by_side(self, left: int, right: int) -> bool:
        tokens, ranks, halves = self.tokens, self.ranks, self.halves
        limit = 1 << 40
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < limit:
                return False
            left_whole, right_whole = len(tokens[left]) == 1, len(tokens[right]) == 1
            if left_whole and right_whole:
                return True
            # at equal times the merge further left goes first
            if right_whole or (not left_whole and left > right):
                limit, left = left, halves[left][1]
            else:
                limit, right = right + 1, halves[right][0]


class PrefixEncoding:
    """The last token of every prefix of a byte string, open to appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def _extend(self, count: int) -> None:
        """Entries for the next ``count`` prefixes."""
        vocabulary, data, last = self.vocabulary, self.data, self.last
        usable, lengths, pairs = vocabulary.usable.get, vocabulary.lengths.get, vocabulary.pairs
        done = len(last)
        for end in range(done + 1, done + count + 1):
            tail = data[end - 3 if end > 3 else 0 : end]
            for length in lengths(tail) or vocabulary.lengths_at(tail):
                start = end - length
                if start < 0:
                    continue
                token = usable(data[start:end])
                if token is None:
                    continue
                if start == 0:
                    break
                left = last[start - 1]
                allowed = pairs.get(left << 32 | token)
                if allowed is None:
                    allowed = vocabulary.side_by_side(left, token)
                if allowed:
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            last.append(token)

    def append(self, data: bytes) -> None:
        self.data += data
        self._extend(len(data))

    def become(self, data: bytes) -> None:
        """Go over to other bytes; the entries of the common prefix hold."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        del self.last[same:]
        self.data = data
        self._extend(len(data) - same)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in the place of ``[start, stop)``; returns how many entries were made.

        Entries before ``start`` hold. Behind the new bytes entries are made until as
        many as the longest token has bytes agree with the old ones.
        """
        shift = len(data) - (stop - start)
        old = self.last
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[:start]
        same = 0
        while len(self.last) < len(self.data):
            at = len(self.last)
            self._extend(1)
            behind = at - shift
            unchanged = at >= start + len(data) and old[behind] == self.last[at]
            same = same + 1 if unchanged else 0
            if same >= self.vocabulary.longest:
                made = len(self.last) - start
                self.last += old[behind + 1 :]
                return made
        return len(self.last) - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (default: of all)."""
        at = len(self.data) if end is None else end
        found = []
        while at:
            token = self.last[at - 1]
            found.append(token)
            at -= len(self.vocabulary.tokens[token])
        return found[::-1]


class Pieces(dict):
    """Packed ids by piece of text."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces in sorted order, so that each goes on from the last one's prefixes."""
        ranks, encoding = self.vocabulary.ranks, PrefixEncoding(self.vocabulary)
        missing = sorted((x.encode("utf-8"), x) for x in pieces if x not in self)
        if len(self) + len(missing) > CACHED_PIECES:
            self.clear()
            missing = sorted((x.encode("utf-8"), x) for x in pieces)
        for data, piece in missing:
            whole = ranks.get(data)
            if whole is None:
                encoding.become(data)
                self[piece] = np.array(encoding.ids(), "<u4").tobytes()
            else:
                self[piece] = whole.to_bytes(4, "little")


class Codec:
    """Encoder and decoder of whole texts."""

    def __init__(self, raw_ranks: bytes, pattern: str):
        self.vocabulary = Vocabulary(parse_ranks(raw_ranks))
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(self.vocabulary)
        size = max(self.vocabulary.tokens) + 1
        self.token_bytes = [self.vocabulary.tokens.get(i) for i in range(size)]
        self.decimal = [str(i).encode() for i in range(size)]

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of every text; texts are taken in groups of some size to share prefixes."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [self.split(x) for x in texts]
        self.pieces.learn(set().union(*split))
        for pieces in split:
            yield np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def ids_text(self, ids: np.ndarray) -> bytes:
        return b",".join(map(self.decimal.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(raw_ranks: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(raw_ranks, pattern)


def _field(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def encode_texts(
    df: DataFrame, id_column: str, text_column: str, raw_ranks: bytes, pattern: str
) -> DataFrame:
    """(id, ids) of every text. ``raw_ranks`` is the content of a rank file."""
    shared = df.sparkSession.sparkContext.broadcast(raw_ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for batch in batches:
            ids = [x.astype("int32") for x in own.encode_all(_field(batch, "text"))]
            column = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "ids"])

    chosen = df.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, ids array<int>")


def decode_ids(
    df: DataFrame, id_column: str, ids_column: str, raw_ranks: bytes, pattern: str
) -> DataFrame:
    """(id, data): the bytes of every list of ids; NULL is the empty list."""
    shared = df.sparkSession.sparkContext.broadcast(raw_ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for batch in batches:
            data = [own.decode(np.array(x or [], "int64")) for x in _field(batch, "ids")]
            column = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "data"])

    chosen = df.selectExpr(f"`{id_column}` AS id", f"`{ids_column}` AS ids")
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, data binary")


def encode_digests(
    df: DataFrame,
    id_column: str,
    text_column: str,
    raw_ranks: bytes,
    pattern: str,
    with_ids: bool = False,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text, and ids if wanted.

    Encodes, decodes what was encoded, and sends on the digests, so that without
    ``with_ids`` no ids travel between Python and Spark.
    """
    shared = df.sparkSession.sparkContext.broadcast(raw_ranks)
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for batch in batches:
            counts, of_ids, of_bytes, lists = [], [], [], []
            for ids in own.encode_all(_field(batch, "text")):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(own.ids_text(ids)).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
                lists.append(ids.astype("int32") if with_ids else None)
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(of_ids, pa.string()),
                pa.array(of_bytes, pa.string()),
                pa.array(lists, pa.list_(pa.int32())),
            ]
            count = 5 if with_ids else 4
            yield pa.RecordBatch.from_arrays(columns[:count], names[:count])

    chosen = df.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text")
    kind = chosen.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return chosen.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
