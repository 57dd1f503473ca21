"""Alignment of two tokenizers: links of overlapping tokens and common cuts, by merging all documents in lockstep."""

import functools
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.packing import byte_alphabet
from tideline.llm.shared import SLICE_BYTES, fresh, most_frequent, slices, written
from tideline.llm.transducer import spread

# Fixed pattern: the pre-tokenisation of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space above ASCII: texts that hold some are encoded in one piece.
RARE_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Tokens after which a long document goes on in a lane of its own, at the first common cut of the next PROBES tokens.
LANE, PROBES = 256, 16
# Id pairs whose counts every task holds: the most frequent ones. All others are joined.
HEAVY = 1 << 18
# Segments whose ids a task keeps from one slice to the next, at most; the first ones seen are the frequent ones.
KNOWN = 1 << 17
# Distinct pairs that a counting task holds before it passes their counts on.
HELD = 1 << 20


class Tokenizers:
    """A byte-level BPE (A) and a sentencepiece model with byte fallback (B), and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        with open(byte_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.a_bytes = _by_id(max(ranks.values()) + 1, {i: token for token, i in ranks.items()})
        self.b_bytes = _by_id(
            size, {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        )
        self.a_sizes = pc.binary_length(self.a_bytes).to_numpy().astype(np.int64)
        self.b_sizes = pc.binary_length(self.b_bytes).to_numpy().astype(np.int64)
        nothing = np.empty(0, np.int64)
        self.known, self.known_ids = pa.array([], pa.string()), ((nothing, nothing), (nothing, nothing))
        # Without a piece that goes on after a space inside it, no merge crosses a space after another character.
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, segments: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids and number of ids per segment for A and for B. A segment begins with a space, which B adds itself."""
        at = pc.index_in(segments, self.known)
        new = segments.filter(at.is_null())
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(new))
        texts = new.to_pylist()
        own = [self.a.encode_ordinary(t) for t in texts]
        other = self.b.encode([t[1:] for t in texts], num_threads=1)
        both = [(np.concatenate([ids, more]), np.concatenate([n, m])) for (ids, n), (more, m) in zip(self.known_ids, (_flat(own), _flat(other)))]
        found = tuple((ids[spread((np.cumsum(n) - n)[at], n[at])], n[at]) for ids, n in both)
        if len(self.known) < KNOWN:
            self.known = pa.concat_arrays([self.known, new.slice(0, KNOWN - len(self.known))])
            kept = [n[: len(self.known)] for _, n in both]
            self.known_ids = tuple((ids[: int(n.sum())], n) for (ids, _), n in zip(both, kept))
        return found


def _by_id(size: int, tokens: dict[int, bytes]) -> pa.Array:
    return pa.array([tokens.get(i, b"") for i in range(size)], pa.binary())


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


@functools.lru_cache(maxsize=2)
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    return Tokenizers(byte_path, piece_path)


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places of single spaces between other characters: a token of A and one of B begin at each."""
    space = ASCII_SPACE[data]
    inner = (data[1:-1] == 32) & ~space[:-2] & ~space[2:] if len(data) > 2 else np.empty(0, bool)
    return np.flatnonzero(inner) + 1


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a space and each text, one after another, and where each begins and the last one ends."""
    whole = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "")
    _, offsets, data = whole.buffers()
    places = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def as_strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The runs of bytes that begin at `starts`, the last one up to the end."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


@dataclass
class Aligned:
    """Alignment of some texts: counts per text, and all links with their text and pair code."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    valid: np.ndarray
    link_text: np.ndarray
    link_code: np.ndarray
    _groups: tuple

    def groups(self) -> list[memoryview]:
        """Per text its groups: ids of A, a bar, ids of B, semicolons between groups."""
        a, b, a_cut, b_cut, renderings = self._groups
        if not len(a):
            return [memoryview(b"")] * len(self.n_a)
        # A token's place: those of its side before it, and those of the other side in earlier groups, or up to its own.
        group_a = np.searchsorted(a_cut, np.arange(len(a)))
        group_b = np.searchsorted(b_cut, np.arange(len(b)))
        b_before = np.concatenate([[0], b_cut[:-1] + 1])
        order = np.empty(len(a) + len(b), np.int64)
        kind_a, kind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        kind_a[a_cut], kind_b[b_cut] = 1, 2
        last = np.cumsum(self.n_b)[self.n_b > 0] - 1
        kind_b[last] = 3
        order[np.arange(len(a)) + b_before[group_a]] = a * 4 + kind_a
        order[np.arange(len(b)) + a_cut[group_b] + 1] = b * 4 + kind_b
        rendered = renderings.take(pa.array(order))
        _, offsets, data = rendered.buffers()
        ends = np.frombuffer(offsets, np.int32)[rendered.offset : rendered.offset + len(order) + 1]
        bounds = ends[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        view = memoryview(data)
        return [view[x:y] for x, y in zip(bounds, bounds[1:])]


@functools.lru_cache(maxsize=2)
def _renderings(size: int) -> pa.Array:
    """Every id with what may follow it: a comma in its group, a bar after A's last, a semicolon after B's last, nothing."""
    return pa.array([f"{i}{after}" for i in range(size) for after in (",", "|", ";", "")], pa.string())


def lockstep(end_a: np.ndarray, end_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (token of A, token of B) and common cuts (last token of A, last token of B), by merging the token ends.

    One vector of pointers holds the current tokens of all lanes. A step emits their links, a cut where both end,
    and moves the pointer whose token ends first, or both; finished lanes leave the vector. A lane is a document,
    or a stretch of a long one between common cuts, so the number of steps does not grow with the longest document.
    """
    i, j = bounds_a[:-1], bounds_b[:-1]
    long = np.flatnonzero(np.diff(bounds_a) > 2 * LANE)
    if len(long):
        inner = (np.diff(bounds_a)[long] - 1) // LANE
        tries = (spread(np.ones(len(long), np.int64), inner) * LANE + np.repeat(bounds_a[long], inner))[:, None] + np.arange(PROBES)
        tries = np.minimum(tries, np.repeat(bounds_a[long + 1] - 1, inner)[:, None])
        at = np.searchsorted(end_b, end_a[tries])
        common = end_b[np.minimum(at, len(end_b) - 1)] == end_a[tries]
        found = np.flatnonzero(common.any(axis=1))
        first = common[found].argmax(axis=1)
        i = np.unique(np.concatenate([i, tries[found, first] + 1]))
        j = np.unique(np.concatenate([j, at[found, first] + 1]))
        i, j = i[i < len(end_a)], j[j < len(end_b)]
    stop = np.append(i[1:], len(end_a))
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        here, there = end_a[i], end_b[j]
        cut = here == there
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (here <= there), j + (there <= here)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    if not links_a:
        return (np.empty(0, np.int64),) * 4
    return np.concatenate(links_a), np.concatenate(links_b), np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def align_bytes(both: Tokenizers, data: np.ndarray, places: np.ndarray, whole: np.ndarray) -> Aligned:
    """Align texts given as bytes with their leading spaces. `whole` marks texts that are not to be cut at spaces.

    Segments between safe cuts are encoded once each, however often they occur."""
    n = len(places) - 1
    cuts = safe_cuts(data) if both.separable else np.empty(0, np.int64)
    owner = np.searchsorted(places, cuts, "right") - 1
    starts = np.unique(np.concatenate([places[:-1], cuts[~whole[owner]]]))
    distinct = as_strings(data, starts).dictionary_encode()
    codes = distinct.indices.to_numpy(zero_copy_only=False)
    (a, count_a), (b, count_b) = both.encode(distinct.dictionary)
    _, offsets, raw = distinct.dictionary.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(distinct.dictionary) + 1].astype(np.int64)
    expected = np.frombuffer(raw, np.uint8)[: ends[-1]]
    same = _equal_bytes(both.a_bytes, both.a_sizes, a, count_a, expected, ends) & _equal_bytes(both.b_bytes, both.b_sizes, b, count_b, expected, ends)
    text_of = np.searchsorted(places, starts, "right") - 1
    valid = np.bincount(text_of, ~same[codes], n) == 0
    valid &= np.diff(places) > 1
    kept = codes[valid[text_of]]
    text_of = text_of[valid[text_of]]
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    a, b = a[spread(first_a[kept], count_a[kept])], b[spread(first_b[kept], count_b[kept])]
    n_a = np.bincount(text_of, count_a[kept], n).astype(np.int64)
    n_b = np.bincount(text_of, count_b[kept], n).astype(np.int64)
    held = np.flatnonzero(n_a)
    bounds_a, bounds_b = np.concatenate([[0], np.cumsum(n_a[held])]), np.concatenate([[0], np.cumsum(n_b[held])])
    link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b]), bounds_a, bounds_b)
    text_a = np.repeat(held, n_a[held])
    link_text = text_a[link_a]
    return Aligned(
        n_a,
        n_b,
        np.bincount(text_a[cut_a], minlength=n),
        np.bincount(link_text, minlength=n),
        valid,
        link_text,
        a[link_a] * len(both.b_bytes) + b[link_b],
        (a, b, cut_a, cut_b, _renderings(max(len(both.a_bytes), len(both.b_bytes)))),
    )


def _equal_bytes(tokens: pa.Array, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, expected: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the joined bytes of each run of ids are the expected ones."""
    owner = np.repeat(np.arange(len(counts)), counts)
    same = np.bincount(owner, sizes[ids], len(counts)).astype(np.int64) == np.diff(ends)
    ids = ids[same[owner]]
    taken = tokens.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    places = np.frombuffer(offsets, np.int32)[taken.offset : taken.offset + len(ids) + 1]
    got = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if len(ids) else np.empty(0, np.uint8)
    want = expected[spread(ends[:-1][same], np.diff(ends)[same])]
    wrong = np.concatenate([[0], np.cumsum(got != want)])
    bounds = np.concatenate([[0], np.cumsum(np.diff(ends)[same])])
    same[same] = wrong[bounds[1:]] == wrong[bounds[:-1]]
    return same


def aligned_slices(both: Tokenizers, texts: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, Aligned]]:
    """(rows, alignment of their texts) for a batch, a slice of text at a time. A text longer than a slice comes in
    several parts, cut where tokens of both begin; if one part is not valid, none comes."""
    row = 0
    for part in slices(texts, column):
        data, places = spaced(part.column(column))
        rare = pc.fill_null(pc.match_substring_regex(part.column(column), RARE_SPACE), False)
        whole = rare.to_numpy(zero_copy_only=False).astype(bool)
        if len(part) > 1 or len(data) <= 2 * SLICE_BYTES or whole[0] or not both.separable:
            yield np.arange(row, row + len(part)), align_bytes(both, data, places, whole)
        else:
            cuts = safe_cuts(data)
            cuts = cuts[np.flatnonzero(np.diff(cuts // SLICE_BYTES, prepend=0))]
            bounds = [0, *cuts.tolist(), len(data)]
            pieces = [(data[a:b], np.array([0, b - a])) for a, b in zip(bounds, bounds[1:])]
            if all(align_bytes(both, *piece, whole).valid[0] for piece in pieces):
                for piece in pieces:
                    yield np.array([row]), align_bytes(both, *piece, whole)
        row += len(part)


def pair_counts(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """(pair, b, n, best): how many links of all texts hold each id pair, and whether no other pair of its B id has more.

    Tasks add up the counts of their pairs before they pass them on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(byte_path, piece_path)
        pairs, times = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for _, found in aligned_slices(both, batch, 0):
                own, n = np.unique(found.link_code, return_counts=True)
                every, at = np.unique(np.concatenate([pairs, own]), return_inverse=True)
                total = np.zeros(len(every), np.int64)
                total[at[: len(pairs)]] = times
                total[at[len(pairs) :]] += n
                pairs, times = every, total
                if len(pairs) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])
                    pairs, times = pairs[:0], times[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])

    size = tokenizers(byte_path, piece_path).b.get_piece_size()
    counts = docs.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", (F.col("pair") % size).cast("int")), "pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return written(counts.join(top, "b").select("pair", "b", "n", (F.col("n") == F.col("top")).alias("best")), "counts")


def align(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups) per row of `docs`, groups as `a1,a2|b1;a3|b2,b3`.

    Null and empty texts, and those whose tokens do not spell a space and the text, have zeros and no groups.
    Repeated rows and null ids are aligned row by row. Other columns are not read. An empty table gives no rows.
    """
    found = _documents(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), byte_path, piece_path, None, digest=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def _documents(own: DataFrame, byte_path: str, piece_path: str, heavy: tuple[np.ndarray, np.ndarray, np.ndarray] | None, digest: bool) -> DataFrame:
    """Alignment per row of (doc_id, text): counts, groups or their digest, sums over links with a heavy pair, other links."""
    schema = T.StructType(
        [T.StructField("doc_id", own.schema["doc_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        + [T.StructField("groups", T.StringType()), T.StructField("light", T.ArrayType(T.LongType()))]
    )
    sent = own.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, table = tokenizers(byte_path, piece_path), sent.value
        for batch in batches:
            n = len(batch)
            sums = np.zeros((6, n), np.int64)
            texts: list = [None] * n
            light_text, light = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for rows, found in aligned_slices(both, batch, 1):
                sums[:4, rows] += np.stack([found.n_a, found.n_b, found.n_groups, found.n_links])
                for row, groups in zip(rows.tolist(), found.groups()):
                    if not len(groups):
                        continue
                    if digest:
                        if texts[row] is None:
                            texts[row] = hashlib.sha256()
                        else:
                            texts[row].update(b";")
                        texts[row].update(groups)
                    else:
                        texts[row] = str(groups, "ascii") if texts[row] is None else f"{texts[row]};{str(groups, 'ascii')}"
                if table is not None:
                    pairs, counts, best = table
                    at = np.searchsorted(pairs, found.link_code)
                    hit = at < len(pairs)
                    hit[hit] = pairs[at[hit]] == found.link_code[hit]
                    owner, at = found.link_text[hit], at[hit]
                    # Sums of whole numbers, in two halves: a float holds each exactly.
                    low, high = (np.bincount(owner, half, len(rows)).astype(np.int64) for half in (counts[at] & 0xFFFFFF, counts[at] >> 24))
                    sums[5, rows] += low + (high << 24)
                    sums[4, rows] += np.bincount(owner, best[at], len(rows)).astype(np.int64)
                    light_text.append(rows[found.link_text[~hit]])
                    light.append(found.link_code[~hit])
            owner = np.concatenate(light_text)
            order = np.argsort(owner, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(light)[order]))
            shown = ["" if t is None else t.hexdigest() if digest else t for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), pa.array(shown, pa.string()), lists], schema.names)

    return own.mapInArrow(run, schema)


def score(docs: DataFrame, counts: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of `docs`.

    `counts` are those of `pair_counts`. The `heavy` most frequent pairs go to every task, whatever the size of
    the table; links with another pair are joined with their counts, and as these pairs are rare, no key of that
    join is hot. Odd input as in `align`.
    """
    some = most_frequent(counts, heavy).select("pair", "n", "best").toPandas().sort_values("pair")
    table = some["pair"].to_numpy(np.int64), some["n"].to_numpy(np.int64), some["best"].to_numpy(bool)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = _documents(own, byte_path, piece_path, table, digest=True)
    row = fresh(rows, "row")
    rows = written(rows.withColumn(row, F.monotonically_increasing_id()), "aligned")
    links = rows.select(row, F.explode("light").alias("pair"))
    rest = links.join(counts.hint("shuffle_merge"), "pair").groupBy(row).agg(F.sum("n").alias("more"), F.sum(F.col("best").cast("long")).alias("more_best"))
    joined = rows.join(rest, row, "left")
    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
