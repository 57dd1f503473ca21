"""Cost-balanced packing of tokenised documents into sequences of bounded length."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tideline.llm.shared import slices

CAPACITY = 2048
# Id that ends every document.
END_ID = 1
# Tokens that one packing window holds, at least; it bounds the memory of a task.
WINDOW_TOKENS = 2 << 20
# Attention work per token pair relative to the linear work per token: about 1 / (6 * width) for width 4096.
LINEAR_COST, QUADRATIC_COST = 1.0, 1 / 24_576

# Chunks between spaces that hold only these characters need no normalisation but lower case.
PLAIN = r"^[!-~À-ÖØ-öø-ÿ]*$"
# Fixed pattern: the pre-tokenisation of the vocabulary, for lower-case plain chunks.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
WORD_END = "</w>"


class WordEncoder:
    """Ids of the word-BPE vocabulary for many texts at once.

    White space never reaches an id, so each chunk between spaces is encoded on its own and each
    distinct chunk of a batch only once. Plain chunks go through a byte-level BPE over the same
    merges, in which a zero byte stands for the end of a word; all others through the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        special = set(self.tokenizer.get_added_tokens_decoder())
        to_byte = byte_alphabet()
        ranks = {}
        for token, i in vocabulary.items():
            if i not in special:
                ends = token.endswith(WORD_END)
                letters = token[: -len(WORD_END)] if ends else token
                ranks[bytes(to_byte[c] for c in letters) + b"\0" * ends] = i
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for token, i in ranks.items() if len(token) > 1 and token.endswith(b"\0")]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text closed by END_ID, and the offsets of the texts; null is empty."""
        lines = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        chunks = pc.split_pattern(lines, " ")
        distinct = chunks.values.dictionary_encode()
        ids, counts = self.chunk_ids(distinct.dictionary)
        ids, counts = np.append(ids, np.uint32(END_ID)), np.append(counts, 1)
        starts = np.cumsum(counts) - counts
        ends = chunks.offsets.to_numpy()[1:] - chunks.offsets[0].as_py()
        codes = np.insert(distinct.indices.to_numpy(zero_copy_only=False), ends, len(counts) - 1)
        sizes = counts[codes]
        after = np.cumsum(sizes)
        at = np.arange(after[-1] if len(after) else 0) + np.repeat(starts[codes] - (after - sizes), sizes)
        return ids[at], np.concatenate([[0], after[ends + np.arange(len(ends))]]).astype(np.int64)

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and the number of ids of each."""
        plain = pc.match_substring_regex(chunks, PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        counts = np.zeros(len(chunks), np.int64)
        parts = []
        if plain.any():
            marked = PIECES.sub("\\g<0>\0", "\n".join(chunks.filter(pa.array(plain)).to_pylist()).lower())
            ids = self.fast.encode_to_numpy(marked.replace("\n", ""))
            marks = np.frombuffer(marked.encode(), np.uint8)
            line_of_piece = np.cumsum(marks == 10)[marks == 0]
            ends = self.ends[ids]
            line_of_id = line_of_piece[np.cumsum(ends) - ends]
            counts[plain] = np.bincount(line_of_id, minlength=int(plain.sum()))
            parts.append(ids)
        if not plain.all():
            encoded = self.tokenizer.encode_batch_fast(chunks.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)
            counts[~plain] = [len(e.ids) for e in encoded]
            parts.append(np.array([i for e in encoded for i in e.ids], np.uint32))
        ids = np.concatenate(parts).astype(np.uint32) if parts else np.empty(0, np.uint32)
        # The plain chunks' ids come first: bring them into the order of the chunks.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        sizes = counts[order]
        first = np.empty(len(chunks), np.int64)
        first[order] = np.cumsum(sizes) - sizes
        after = np.cumsum(counts)
        at = np.arange(len(ids)) + np.repeat(first - (after - counts), counts)
        return ids[at], counts


def byte_alphabet() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable ones stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Piece:
    """A run of ids of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, size: int) -> tuple["Piece", "Piece"]:
        return (
            Piece(self.doc, self.start, self.ids[:size], self.total),
            Piece(self.doc, self.start + size, self.ids[size:], self.total),
        )


def balance(pieces: list[Piece], capacity: int, linear: float, quadratic: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill as many whole sequences as the pieces can, longest piece first, and return what is left.

    A piece goes to the sequence of lowest cost that has room for it. One that fits nowhere is cut:
    its head fills the sequence of lowest cost that has room at all, and so on.
    """
    count = sum(len(p.ids) for p in pieces) // capacity
    rows: list[list[Piece]] = [[] for _ in range(count)]
    cost, room, left = np.zeros(count), np.full(count, capacity), []
    for piece in sorted(pieces, key=lambda p: -len(p.ids)):
        while len(piece.ids):
            size = len(piece.ids)
            fits = room >= size
            if not fits.any():
                fits = room > 0
                if not fits.any():
                    left.append(piece)
                    break
            at = int(np.argmin(np.where(fits, cost, np.inf)))
            head, piece = piece.cut(min(size, int(room[at])))
            rows[at].append(head)
            room[at] -= len(head.ids)
            cost[at] += linear * len(head.ids) + quadratic * len(head.ids) ** 2
    return rows, left


def binary_sizes(total: int, capacity: int) -> list[int]:
    """Lengths of sequences that hold `total` < capacity ids without padding: its powers of two."""
    return [1 << k for k in reversed(range(capacity.bit_length())) if total >> k & 1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    window_tokens: int = WINDOW_TOKENS,
    linear: float = LINEAR_COST,
    quadratic: float = QUADRATIC_COST,
) -> DataFrame:
    """Pack every row of `docs` into token sequences; one output row per piece of a document.

    Columns: doc_id, start (ids of the document before the piece), length, doc_tokens, sequence_id,
    offset (in the sequence, without gaps) and ids (little-endian unsigned 32-bit).

    Each task packs the documents it reads, a window at a time, so ids are never shuffled and memory
    is bounded by the window and one document. All sequences of a window are full; what is left moves
    on to the next window, and at the end of a task into sequences whose lengths are powers of two,
    which need no padding. A sequence number holds the number of the task's partition, so a task that
    is run again gives the same rows.

    Null and empty texts are the end id alone. Repeated rows and rows with a null id are packed row by
    row. Texts of any length are cut at the capacity. Other columns are not read. An empty table gives
    no rows.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [T.StructField(doc_id, kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def rows_of(sequences: list[list[Piece]], first: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(sequences), 256):
            flat = [(first + at + k, p) for k, row in enumerate(sequences[at : at + 256]) for p in row]
            offsets, before, last = [], 0, -1
            for number, p in flat:
                before = before if number == last else 0
                offsets.append(before)
                before, last = before + len(p.ids), number
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p.doc for _, p in flat], id_type),
                    pa.array([p.start for _, p in flat], pa.int64()),
                    pa.array([len(p.ids) for _, p in flat], pa.int64()),
                    pa.array([p.total for _, p in flat], pa.int64()),
                    pa.array([n for n, _ in flat], pa.int64()),
                    pa.array(offsets, pa.int64()),
                    pa.array([p.ids.astype("<u4").tobytes() for _, p in flat], pa.binary()),
                ],
                schema.names,
            )

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        number = TaskContext.get().partitionId() << 33
        waiting: list[Piece] = []
        held, id_type = 0, None
        for batch in batches:
            encoder = encoder or WordEncoder(tokenizer)
            id_type = batch.schema.field(0).type
            for part in slices(batch, 1):
                ids, offsets = encoder.encode(part.column(1))
                full = []
                for doc, a, b in zip(part.column(0).to_pylist(), offsets, offsets[1:]):
                    whole = a + (b - a) // capacity * capacity
                    full += [[Piece(doc, int(s - a), ids[s : s + capacity], int(b - a))] for s in range(a, whole, capacity)]
                    if whole < b:
                        waiting.append(Piece(doc, int(whole - a), ids[whole:b].copy(), int(b - a)))
                        held += int(b - whole)
                yield from rows_of(full, number, id_type)
                number += len(full)
                if held >= window_tokens:
                    rows, waiting = balance(waiting, capacity, linear, quadratic)
                    yield from rows_of(rows, number, id_type)
                    number += len(rows)
                    held = sum(len(p.ids) for p in waiting)
        if waiting:
            rows, waiting = balance(waiting, capacity, linear, quadratic)
            for size in binary_sizes(sum(len(p.ids) for p in waiting), capacity):
                row = []
                while size:
                    head, rest = waiting[0].cut(min(size, len(waiting[0].ids)))
                    row.append(head)
                    size -= len(head.ids)
                    waiting[:1] = [rest] if len(rest.ids) else []
                rows.append(row)
            yield from rows_of(rows, number, id_type)

    return docs.select(doc_id, text).mapInArrow(pack_partition, schema)
