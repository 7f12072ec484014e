"""Hierarchical packing of documents into sequences of several context sizes.

Every document is tokenized and ended by one separator id.  Whole long windows are cut off first.  The
rest of a document goes to the smallest tier that holds it; tiers are packed from the longest down, gaps
are filled by the best-fitting rests of shorter tiers, and what is still open is closed by cutting a
shorter rest.  Sequences of shorter tiers are always exactly full, so only long windows can hold padding,
fewer than ``MIN_PIECE`` ids each.  The end of a partition is cut into powers of two.

Packing runs inside the scan's partitions and needs no shuffle.  A task holds one document and the rests
waiting (about ``FLUSH_TOKENS`` ids).
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTHS = (1024, 512, 256, 128)
SEPARATOR = 0
MIN_PIECE = 16
FLUSH_TOKENS = 512 * 1024
STEP_TOKENS = 64 * 1024
COMPARED = 20
# sequence ids: partition in the upper bits
LOCAL_BITS = 40

def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(byte): byte for byte in shown} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes.

    A vocabulary whose ids are in order of its merges, as in the file read here, gives the same ids with
    ``tiktoken``, which is several times faster; the first texts of a task are compared with ``tokenizers`` itself.
    With ``special_ids`` a special string in a text, like ``<|endoftext|>``, gets its own id, as ``tokenizers`` gives
    it by default; without, it is ordinary text.
    """

    def __init__(self, path: str, pattern: str, special_ids: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.reference = Tokenizer.from_file(path)
        self.reference.encode_special_tokens = not special_ids
        model = json.loads(self.reference.to_str())
        special = {token["content"]: token["id"] for token in model["added_tokens"]}
        if special_ids and any(token["single_word"] or token["lstrip"] or token["rstrip"] for token in model["added_tokens"]):
            raise ValueError("special strings that take blanks or word ends with them can't be encoded")
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special
        }
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special if special_ids else {})
        self.allowed = "all" if special_ids else set()
        self.to_compare = COMPARED

    def encode(self, text: str) -> bytes:
        try:
            ids = self.fast.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())
        except ValueError:
            # its pattern matcher gives up within runs of about a million blanks
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self.to_compare:
            self.to_compare -= 1
            if ids.tolist() != self.reference.encode(text, add_special_tokens=False).ids:
                raise ValueError("this vocabulary isn't in order of its merges")
        return ids.astype("<u4", copy=False).tobytes()


class Rest:
    """A run of ids of one document that waits for a place."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def split(self, length: int) -> tuple[Rest, Rest]:
        head = Rest(self.doc, self.start, self.ids[: 4 * length], self.total)
        return head, Rest(self.doc, self.start + length, self.ids[4 * length :], self.total)


class Waiting:
    """Rests ordered by length; the longest that fits is taken first, among equals the latest."""

    def __init__(self):
        self.by_length: dict[int, list[Rest]] = {}
        self.lengths: list[int] = []
        self.tokens = 0

    def add(self, rest: Rest) -> None:
        length = len(rest)
        if length not in self.by_length:
            self.by_length[length] = []
            insort(self.lengths, length)
        self.by_length[length].append(rest)
        self.tokens += length

    def take(self, most: int) -> Rest | None:
        """The longest rest of at most ``most`` ids."""
        at = bisect_right(self.lengths, most)
        return self._pop(at - 1) if at else None

    def take_to_cut(self, least: int) -> Rest | None:
        """The shortest rest that leaves at least ``MIN_PIECE`` ids when ``least`` are cut off."""
        at = bisect_right(self.lengths, least + MIN_PIECE - 1)
        return self._pop(at) if at < len(self.lengths) else None

    def _pop(self, at: int) -> Rest:
        length = self.lengths[at]
        rest = self.by_length[length].pop()
        if not self.by_length[length]:
            del self.by_length[length]
            self.lengths.pop(at)
        self.tokens -= length
        return rest


def fill(waiting: Waiting, size: int, exact: bool) -> list[Rest] | None:
    """Pieces of one sequence of ``size`` ids; None, with nothing taken, if an exact one can't be filled."""
    pieces: list[Rest] = []
    room = size
    while room and (rest := waiting.take(room)):
        pieces.append(rest)
        room -= len(rest)
    if room and (exact or room >= MIN_PIECE) and (rest := waiting.take_to_cut(room)):
        head, tail = rest.split(room)
        pieces.append(head)
        waiting.add(tail)
        room = 0
    if room and exact:
        for rest in pieces:
            waiting.add(rest)
        return None
    return pieces


def pack_waiting(waiting: Waiting, lengths: tuple[int, ...]) -> Iterator[tuple[int, list[Rest]]]:
    """Sequences of every tier, longest first, while rests of that tier wait."""
    for tier, size in enumerate(lengths):
        shorter = lengths[tier + 1] if tier + 1 < len(lengths) else 0
        while waiting.lengths and waiting.lengths[-1] > shorter:
            if waiting.tokens < size:
                break
            pieces = fill(waiting, size, exact=tier > 0)
            if pieces is None:
                break
            yield size, pieces


def drain(waiting: Waiting, longest: int) -> Iterator[tuple[int, list[Rest]]]:
    """The last rests of a partition as sequences whose lengths are powers of two."""
    while waiting.tokens:
        size = min(longest, 1 << (waiting.tokens.bit_length() - 1))
        pieces: list[Rest] = []
        room = size
        while room:
            rest = waiting.take(room) or waiting._pop(0)
            if len(rest) > room:
                rest, tail = rest.split(room)
                waiting.add(tail)
            pieces.append(rest)
            room -= len(rest)
        yield size, pieces


def balanced_steps(sequences: list[tuple[int, list[Rest]]], step_tokens: int) -> list[int]:
    """Group of each sequence: equal tokens first, then equal attention cost (sum of squared lengths)."""
    steps = max(1, round(sum(size for size, _ in sequences) / step_tokens))
    cost = [sum(len(piece) ** 2 for piece in pieces) for _, pieces in sequences]
    heap = [(0, 0, step) for step in range(steps)]
    chosen = [0] * len(sequences)
    for at in sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -cost[i])):
        tokens, spent, step = heapq.heappop(heap)
        chosen[at] = step
        heapq.heappush(heap, (tokens + sequences[at][0], spent + cost[at], step))
    return chosen


def pack_partition(documents, lengths, step_tokens, base: int, with_ids: bool) -> Iterator[list[tuple]]:
    """Rows of pieces for the ``(doc, ids)`` pairs of one partition."""
    waiting = Waiting()
    ready: list[tuple[int, list[Rest]]] = []
    separator = SEPARATOR.to_bytes(4, "little")
    longest = lengths[0]
    next_sequence, next_step, ready_tokens = base, base, 0

    def rows() -> list[tuple]:
        nonlocal next_sequence, next_step, ready_tokens
        out = []
        steps = balanced_steps(ready, step_tokens)
        for (size, pieces), step in zip(ready, steps):
            offset = 0
            for piece in pieces:
                row = (piece.doc, piece.start, len(piece), zlib.crc32(piece.ids), piece.total,
                       next_sequence, offset, size, next_step + step)
                out.append(row + (piece.ids,) if with_ids else row)
                offset += len(piece)
            next_sequence += 1
        next_step += max(steps, default=-1) + 1
        ready.clear()
        ready_tokens = 0
        return out

    for doc, ids in documents:
        ids += separator
        total = len(ids) // 4
        whole = total // longest * longest
        for start in range(0, whole, longest):
            ready.append((longest, [Rest(doc, start, ids[4 * start : 4 * (start + longest)], total)]))
        ready_tokens += whole
        if whole < total:
            waiting.add(Rest(doc, whole, ids[4 * whole :], total))
        if waiting.tokens >= FLUSH_TOKENS or ready_tokens >= FLUSH_TOKENS:
            ready.extend(pack_waiting(waiting, lengths))
            yield rows()
    ready.extend(pack_waiting(waiting, lengths))
    ready.extend(drain(waiting, longest))
    if ready:
        yield rows()


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    lengths: tuple[int, ...] = LENGTHS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = True,
    special_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``) packed into sequences.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, the ``tier`` (context
    size), the balanced ``step_group``, and ``ids`` (little-endian 32-bit) unless ``with_ids`` is off.
    A null text counts as empty and holds the separator only; a null id is kept as null; repeated rows are
    packed once each; an empty table gives no rows; other columns are ignored.  ``lengths`` are powers of
    two in falling order.  ``tokenizer_path`` is a byte-level vocabulary of ``tokenizers`` that every
    executor has, ``pattern`` what it cuts texts by.  With ``special_ids`` special strings in texts get their own ids.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
              ("tier", pa.int32()), ("step_group", pa.int64())]
    fields += [("ids", pa.binary())] if with_ids else []
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path, pattern, special_ids)
        base = TaskContext.get().partitionId() << LOCAL_BITS
        pairs = ((doc, encoder.encode(text or "")) for batch in batches for doc, text in zip(batch[0].to_pylist(), batch[1].to_pylist()))
        for rows in pack_partition(pairs, lengths, step_tokens, base, with_ids):
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, ddl + (", ids binary" if with_ids else ""))
