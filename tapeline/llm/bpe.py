"""Byte-level BPE with a rank queue on a hierarchical bitmap.

A pre-token is a linked list of parts. Each mergeable pair of neighbours waits in the bucket
of its merge rank; a bitmap of 64-bit words, with bitmaps of non-zero words above it, gives the
lowest non-empty rank by three find-first-set steps, however long the pre-token is. Entries
whose pair has changed meanwhile are stale and skipped when they come up.

A long pre-token has a queue of its own. Short ones share one: all that wait at the lowest rank
anywhere merge at once, on arrays.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import give_back
from tapeline.llm.words import Known, gathered, slices

#: Chunks, and pre-tokens, that a worker remembers: a bound on memory, not on results.
REMEMBER = 600_000
#: Pre-tokens up to this many bytes merge side by side in one queue, unless there are too few to be worth it.
SHORT, FEW = 64, 500

_BIT = [1 << i for i in range(64)]


class RankQueue:
    """Positions by merge rank; pops the smallest (rank, position).

    low has a bit for each rank, mid a bit for each word of low that is not zero, top a bit
    for each word of mid. The lists are kept from one pre-token to the next: an emptied queue
    is all zeros.
    """

    def __init__(self, ranks: int) -> None:
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, waiting: list[int]) -> None:
        """Push position i with rank waiting[i], unless that is negative. The queue is empty."""
        low, mid, buckets, top = self.low, self.mid, self.buckets, 0
        for position, rank in enumerate(waiting):
            if rank < 0:
                continue
            if rank in buckets:
                buckets[rank].append(position)  # ascending, so it is a heap
                continue
            buckets[rank] = [position]
            word = rank >> 6
            high = word >> 6
            low[word] |= _BIT[rank & 63]
            mid[high] |= _BIT[word & 63]
            top |= 1 << high
        self.top = top

    def push(self, rank: int, position: int) -> None:
        if rank in self.buckets:
            heapq.heappush(self.buckets[rank], position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        high = word >> 6
        self.low[word] |= _BIT[rank & 63]
        self.mid[high] |= _BIT[word & 63]
        self.top |= 1 << high

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        high = (top & -top).bit_length() - 1
        x = self.mid[high]
        word = high << 6 | ((x & -x).bit_length() - 1)
        x = self.low[word]
        rank = word << 6 | ((x & -x).bit_length() - 1)
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        x &= x - 1
        self.low[word] = x
        if not x:
            x = self.mid[high]
            self.mid[high] = x & ~_BIT[word & 63]
            if not self.mid[high]:
                self.top = top & (top - 1)
        return rank, bucket[0]


class PairRanks:
    """The rank at which two tokens merge, for arrays of tokens: all splits of all tokens, sorted."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank) for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.append(table[:, 0], np.iinfo(np.int64).max), np.append(table[:, 1], -1)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class SharedQueue(RankQueue):
    """One queue for many pre-tokens. A bucket holds arrays of positions; all words' leftmost pairs of the lowest rank merge at once.

    Words do not touch each other, so each word still merges its own lowest rank first, leftmost among equals; what
    else of a word waits at the same rank goes back into the bucket, as a merge may bring up a lower one.
    """

    def put(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else []
        stops = [*starts[1:], len(ranks)]
        for rank, start, stop in zip(ranks[starts].tolist(), starts, stops):
            if rank in self.buckets:
                self.buckets[rank].append(positions[start:stop])
                continue
            self.buckets[rank] = [positions[start:stop]]
            word = rank >> 6
            high = word >> 6
            self.low[word] |= _BIT[rank & 63]
            self.mid[high] |= _BIT[word & 63]
            self.top |= 1 << high

    def take(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and all positions that wait there."""
        if not self.top:
            return None
        high = (self.top & -self.top).bit_length() - 1
        x = self.mid[high]
        word = high << 6 | ((x & -x).bit_length() - 1)
        x = self.low[word]
        rank = word << 6 | ((x & -x).bit_length() - 1)
        self.low[word] = x & (x - 1)
        if not self.low[word]:
            self.mid[high] &= ~_BIT[word & 63]
            if not self.mid[high]:
                self.top &= self.top - 1
        arrays = self.buckets.pop(rank)
        return rank, arrays[0] if len(arrays) == 1 else np.unique(np.concatenate(arrays))


class Encoder:
    """Encodes and decodes by a table {token bytes: rank}."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pieces = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.shared = SharedQueue(max(ranks.values()) + 1)
        self.pairs = PairRanks(ranks)
        self.byte_ids = np.array([ranks[bytes((b,))] for b in range(256)], np.int64)
        self.byte_pairs = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(self.tokens)] = [len(token) for token in self.tokens.values()]
        self.token_sizes, self.token_starts = sizes, np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join([self.tokens[i] for i in sorted(self.tokens)]), np.uint8)
        self.chunks = Known(REMEMBER)
        self.parts = Known(REMEMBER)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the lowest rank merges first, leftmost among equals."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        push, pop, longest = self.queue.push, self.queue.pop, self.longest
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        pairs = self.byte_pairs
        waiting = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank at which the pair that starts here waits
        waiting.append(-1)
        self.queue.fill(waiting)
        while (top := pop()) is not None:
            rank, start = top
            if waiting[start] != rank:
                continue  # stale
            middle = end[start]
            stop = end[start] = end[middle]
            waiting[middle] = waiting[start] = -1
            if stop < n:
                before[stop] = start
                if end[stop] - start <= longest:
                    rank = waiting[start] = ranks.get(piece[start : end[stop]], -1)
                    if rank >= 0:
                        push(rank, start)
            left = before[start]
            if left >= 0:
                rank = waiting[left] = ranks.get(piece[left:stop], -1) if stop - left <= longest else -1
                if rank >= 0:
                    push(rank, left)
        out, start = [], 0
        while start < n:
            stop = end[start]
            out.append(ranks[piece[start:stop]])
            start = stop
        return out

    def merge_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens one after the other, and how many each has."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        n, word = len(data), np.repeat(np.arange(len(pieces)), sizes)
        last = np.cumsum(sizes)[word]  # where the word ends
        token = np.append(self.byte_ids[data], 0)  # of the part that starts here
        end = np.arange(1, n + 1)
        before = np.arange(-1, n)
        before[np.cumsum(sizes) - sizes] = -1
        waiting = np.where(end < last, self.pairs.of(token[:-1], token[1:]), -1)
        alive = np.ones(n, bool)
        start = np.flatnonzero(waiting >= 0)
        self.shared.put(waiting[start], start)
        while (top := self.shared.take()) is not None:
            rank, start = top
            start = start[waiting[start] == rank]  # the others are stale
            if not len(start):
                continue
            first = np.append(True, word[start[1:]] != word[start[:-1]])
            if not first.all():
                again = start[~first]
                self.shared.put(np.full(len(again), rank), again)
                start = start[first]
            middle = end[start]
            stop = end[middle]
            end[start] = stop
            token[start] = rank
            alive[middle] = False
            waiting[middle] = waiting[start] = -1
            inner = stop < last[start]
            here, after = start[inner], stop[inner]
            before[after] = here
            left = before[start]
            some = left >= 0
            left, here_too = left[some], start[some]
            changed = np.concatenate([here, left])
            ranks = self.pairs.of(token[changed], np.concatenate([token[after], token[here_too]]))
            waiting[changed] = ranks
            found = ranks >= 0
            self.shared.put(ranks[found], changed[found])
        return token[:-1][alive].astype(np.uint32), np.bincount(word[alive], minlength=len(pieces))

    def _learn_parts(self, parts: list[str]) -> None:
        """Distinct pre-tokens at once."""
        data = [part.encode() for part in parts]
        short = [i for i, piece in enumerate(data) if len(piece) <= SHORT]
        if len(short) < FEW:
            short = []
        together = set(short)
        alone = [i for i in range(len(data)) if i not in together]
        if short:
            self.parts.learn([parts[i] for i in short], *self.merge_together([data[i] for i in short]))
        if alone:
            ids = [self.merge(data[i]) for i in alone]
            flat = np.array([i for own in ids for i in own], np.uint32)
            self.parts.learn([parts[i] for i in alone], flat, np.array([len(own) for own in ids]))

    def _learn_chunks(self, chunks: list[str]) -> None:
        """Distinct chunks at once: those that begin with a blank are split side by side, as no pre-token spans them."""
        joined = [c for c in chunks if c[0] in " \n" and not c[-1].isspace()]
        apart = list(set(chunks).difference(joined)) if len(joined) < len(chunks) else []
        pieces = self.pieces("".join(joined))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        many = np.diff(np.searchsorted(ends, np.cumsum([len(c) for c in joined]), "right"), prepend=0) if joined else np.empty(0, np.int64)
        for chunk in apart:
            own = self.pieces(chunk)
            pieces += own
            many = np.append(many, len(own))
        self.parts.trim()
        at = self.parts.find(pieces)
        if len(unknown := np.flatnonzero(at < 0)):
            missing = [pieces[i] for i in unknown.tolist()]
            self._learn_parts(list(dict.fromkeys(missing)))
            at[unknown] = self.parts.find(missing)
        np.add.at(self.parts.hits, at, 1)
        ids, ends = self.parts.ids(at)
        last = np.append(0, ends)[np.cumsum(many)]
        self.chunks.learn(joined + apart, ids, np.diff(last, prepend=0))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Distinct chunks of all of them are found in Arrow, and those not met before encoded once."""
        data = [text.encode() for text in texts]
        coded, many = _chunks(data)
        if not len(coded):
            return [np.empty(0, np.uint32) for _ in texts]
        self.chunks.trim()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        at = self.chunks.find(names)
        if len(unknown := np.flatnonzero(at < 0)):
            missing = [names[i] for i in unknown.tolist()]
            self._learn_chunks(missing)
            at[unknown] = self.chunks.find(missing)
        self.chunks.hits[at] += np.bincount(index, minlength=len(names))
        ids, ends = self.chunks.ids(at[index])
        last = np.append(0, ends)[np.cumsum(many)]
        return np.split(ids, last[:-1])

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian 32-bit integers."""
        return self.encode_all([text])[0].astype("<u4").tobytes()

    def decode_all(self, ids: list[np.ndarray]) -> list[bytes]:
        flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int64)
        data, ends = gathered(self.token_bytes, self.token_starts[flat], self.token_sizes[flat])
        last = np.append(0, ends)[np.cumsum([0, *(len(x) for x in ids)])]
        return [data[a:b].tobytes() for a, b in zip(last, last[1:])]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([np.frombuffer(ids, "<u4")])[0]


def _chunks(data: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The texts cut where a blank or newline follows a visible character, as a dictionary array, and how many chunks each has.

    No pre-token spans such a step. Nothing is cut after what is or may be other white space: ASCII
    controls, and characters whose first bytes are those of one.
    """
    sizes = np.array([len(x) for x in data], np.int64)
    whole = np.frombuffer(b"".join([b"\0\0\0", *data]), np.uint8)
    third, second, before, byte = whole[:-3], whole[1:-2], whole[2:-1], whole[3:]
    blank = (byte == 0x20) | (byte == 0x0A)
    wide = np.isin(third, (0xE1, 0xE2, 0xE3)) | ((second == 0xC2) & ((before == 0x85) | (before == 0xA0)))
    cut = blank & (before > 0x20) & ~wide
    ends = np.cumsum(sizes)
    cut[(ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(byte)).astype(np.int64)
    many = np.diff(np.searchsorted(starts, ends), prepend=0)
    column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(byte.tobytes()))
    return column.dictionary_encode(), many


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file; a Python worker reads the file once."""
    if (path, pattern) not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[path, pattern] = Encoder(ranks, pattern)
    return _encoders[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, its token ids (array of int) and the bytes they decode to.

    Null texts count as empty: no tokens. Ids of any type, repeated or null, pass through. No
    other column is read. One pass, no shuffle; a worker holds a slice of texts and a bounded store of chunks.
    """
    return _mapped(df, path, pattern, id_col, text_col, f"{id_col} {{id}}, ids array<int>, decoded binary", lambda ids, data: (ids.view(np.int32), data))


def digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `encode`, with n_tokens, ids_sha256 and decoded_sha256 instead of the ids and bytes themselves."""
    sha = lambda data: hashlib.sha256(data).hexdigest()
    schema = f"{id_col} {{id}}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(df, path, pattern, id_col, text_col, schema, lambda ids, data: (len(ids), sha(ids.tobytes()), sha(data)))


def _mapped(df: DataFrame, path: str, pattern: str, id_col: str, text_col: str, schema: str, shape) -> DataFrame:
    columns = [part.split()[0] for part in schema.split(",")][1:]
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for part, texts in slices(batches):
            encoded = own.encode_all(texts)
            rows = [shape(ids.astype("<u4"), data) for ids, data in zip(encoded, own.decode_all(encoded))]
            yield pa.RecordBatch.from_arrays([part.column("id").combine_chunks(), *[pa.array(list(x)) for x in zip(*rows)]], [id_col, *columns])
        give_back()

    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, schema.format(id=kind))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """All columns of `df` and `decoded`, the bytes of its array of ids; an unknown id or a null array gives null."""
    @F.pandas_udf("binary")
    def run(column):  # noqa: ANN001, ANN202
        tokens = encoder(path, pattern).tokens
        return column.map(lambda ids: None if ids is None or any(i not in tokens for i in ids) else b"".join(tokens[i] for i in ids))

    return df.withColumn("decoded", run(F.col(ids_col)))
