"""Word-BPE encoding through a memory-mapped lexicon of frequent words and exact merges for all others, and decoding."""

import functools
import heapq
import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tideline.llm.files import put
from tideline.llm.packing import byte_alphabet
from tideline.llm.shared import most_frequent, slices, written
from tideline.llm.transducer import Transducer, compile_words, spread
from tideline.session import scratch_dir

# Words of the lexicon, and bytes of a word in it, at most. Both decide on speed, not on results.
WORDS, LONGEST = 1 << 16, 48
# Pieces with more symbols are merged with a heap, shorter ones many at a time.
WIDE = 48
# Ids that one step of the decoder turns into text.
DECODE_IDS = 1 << 18
NO_RANK = np.int64(1) << 40
# Fixed pattern: words of these characters are their own composed form and have a plain lower case.
PLAIN = r"^[!-~À-ÖØ-öø-ÿ]*$"
# Fixed pattern: the pre-tokenisation of the vocabulary; a line feed is kept to tell words apart.
PIECES = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SUFFIX = "</w>"
# Marks a special token among pieces; no UTF-8 text holds this byte.
SPECIAL = b"\xff"


def split_words(texts: pa.Array) -> pa.ListArray:
    """The texts cut at spaces and line feeds; null is empty. White space never reaches an id of the vocabulary."""
    return pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")


def flat_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words, and where each starts and ends in them."""
    _, offsets, data = words.buffers()
    if not len(words):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8), places[:-1], places[1:]


class Merges:
    """The merge list of a vocabulary, applied to pieces as byte strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = sorted(byte_alphabet().items(), key=lambda item: item[1])
        self.inner = np.array([vocabulary[c] for c, _ in letters], np.int64)
        self.last = np.array([vocabulary[c + SUFFIX] for c, _ in letters], np.int64)
        pairs = np.array([(vocabulary[a] << 32 | vocabulary[b], vocabulary[a + b]) for a, b in model["merges"]], np.int64)
        self.merged = pairs[:, 1]
        self.rank_of_key = np.argsort(pairs[:, 0], kind="stable")
        self.key = pairs[self.rank_of_key, 0]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of the pairs in the merge list, NO_RANK for those not in it."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank_of_key[at], NO_RANK)

    def apply(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces data[start:end] one after another, and the number of ids of each."""
        sizes = end - start
        counts = np.zeros(len(sizes), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        lower = 0
        for width in (1, 4, 8, 12, 16, 24, WIDE):
            chosen = np.flatnonzero((sizes > lower) & (sizes <= width))
            lower = width
            for at in range(0, len(chosen), 1 << 16):
                some = chosen[at : at + (1 << 16)]
                ids, n = self._together(data, start[some], sizes[some], width)
                counts[some] = n
                parts.append((some, ids))
        for one in np.flatnonzero(sizes > WIDE):
            ids = self._alone(data[start[one] : end[one]])
            counts[one] = len(ids)
            parts.append((np.array([one]), ids))
        out = np.empty(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        for some, ids in parts:
            out[spread(first[some], counts[some])] = ids
        return out, counts

    def _together(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of at most `width` symbols, a row each: every round merges the leftmost pair of lowest rank of each row."""
        column = np.arange(width)
        inside = column < size[:, None]
        raw = data[np.where(inside, start[:, None] + column, 0)]
        symbols = np.where(column == size[:, None] - 1, self.last[raw], self.inner[raw])
        counts = size.copy()
        done = symbols
        rank = np.full((len(size), width), NO_RANK)
        if width > 1:
            rank[:, :-1] = np.where(inside[:, 1:], self.rank(symbols[:, :-1], symbols[:, 1:]), NO_RANK)
        row = np.arange(len(size))
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            going = best < NO_RANK
            if not going.all():
                done[row[~going]] = symbols[~going]
                row, symbols, rank, at, best = row[going], symbols[going], rank[going], at[going], best[going]
                if not len(row):
                    break
            each = np.arange(len(row))
            move = np.minimum(column + (column > at[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, move, axis=1)
            symbols[each, at] = self.merged[best]
            # The pair after the merged one moves up; the pairs on either side of the new symbol are looked up.
            rank = np.take_along_axis(rank, np.minimum(column + (column >= at[:, None]), width - 1), axis=1)
            counts[row] -= 1
            rank[:, -1] = NO_RANK
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.rank(symbols[left, at[left] - 1], symbols[left, at[left]])
            right = np.flatnonzero(at + 1 < counts[row])
            rank[right, at[right]] = self.rank(symbols[right, at[right]], symbols[right, at[right] + 1])
            ended = np.flatnonzero(at + 1 >= counts[row])
            rank[ended, at[ended]] = NO_RANK
        return done[column < counts[:, None]], counts

    def _alone(self, raw: np.ndarray) -> np.ndarray:
        """One long piece, with a heap of its pairs by rank and place."""
        symbols = [*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]
        n = len(symbols)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        ranks = self.rank(np.array(symbols[:-1]), np.array(symbols[1:])).tolist()
        heap = [(r, k, symbols[k], symbols[k + 1]) for k, r in enumerate(ranks) if r < NO_RANK]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(k: int) -> None:
            pair = symbols[k], symbols[after[k]]
            if pair not in known:
                known[pair] = int(self.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
            if known[pair] < NO_RANK:
                heapq.heappush(heap, (known[pair], k, *pair))

        while heap:
            rank, k, left, right = heapq.heappop(heap)
            j = after[k]
            if symbols[k] != left or j < 0 or symbols[j] != right:
                continue
            symbols[k], symbols[j] = int(self.merged[rank]), -1
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
                push(k)
            if before[k] >= 0:
                push(before[k])
        return np.array([s for s in symbols if s >= 0], np.int64)


class Encoder:
    """Ids of texts: frequent words from a transducer, the pieces of all others from it or by merging."""

    def __init__(self, path: str, lexicon: Transducer | None = None):
        self.path, self.merges, self.lexicon = path, Merges(path), lexicon
        self.special = self.merges.special
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        self.to_byte = byte_alphabet()

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        """The normaliser and pre-tokeniser for words that are not plain; few tables need them."""
        return Tokenizer.from_file(self.path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins in them and the last one ends."""
        words = split_words(texts)
        distinct = words.flatten().dictionary_encode()
        ids, counts = self.words(distinct.dictionary)
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        first, sizes = np.cumsum(counts) - counts, counts[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = words.offsets.to_numpy().astype(np.int64)
        return ids[spread(first[codes], sizes)].astype(np.int32), ends[places - places[0]]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without space or line feed one after another, and the number of ids of each."""
        known, ids, counts = self._lookup(words)
        if not known.all():
            rest = np.flatnonzero(~known)
            more, n = self._by_pieces(words.take(pa.array(rest)))
            counts[rest] = n
            out = np.empty(int(counts.sum()), np.int64)
            first = np.cumsum(counts) - counts
            out[spread(first[known], counts[known])] = ids
            out[spread(first[rest], n)] = more
            ids = out
        return ids, counts

    def _lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.lexicon is None:
            return np.zeros(len(words), bool), np.empty(0, np.int64), np.zeros(len(words), np.int64)
        return self.lexicon.lookup(*flat_bytes(words))

    def _by_pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        for content in self.special:
            plain &= ~pc.match_substring(words, content).to_numpy(zero_copy_only=False).astype(bool)
        # Plain words are cut all at once. Their pieces are in normal form, so that the lexicon may know them as words.
        lines = "\n".join(words.filter(pa.array(plain)).to_pylist()).lower()
        pieces = pa.array(PIECES.findall(lines), pa.string())
        breaks = pc.equal(pieces, "\n").to_numpy(zero_copy_only=False).astype(bool)
        owner = np.flatnonzero(plain)[np.cumsum(breaks)[~breaks]] if plain.any() else np.empty(0, np.int64)
        distinct = pieces.filter(pa.array(~breaks)).dictionary_encode()
        known, ids, counts = self._lookup(distinct.dictionary)
        rest = np.flatnonzero(~known)
        data, start, end = flat_bytes(distinct.dictionary)
        more, n = self.merges.apply(data, start[rest], end[rest])
        counts[rest] = n
        first = np.zeros(len(counts), np.int64)
        first[known] = np.cumsum(counts[known]) - counts[known]
        first[rest] = len(ids) + np.cumsum(n) - n
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        flat, sizes = np.concatenate([ids, more])[spread(first[codes], counts[codes])], counts[codes]
        if not plain.all():
            odd, n, odd_owner = self._odd_words(words, np.flatnonzero(~plain))
            flat, sizes, owner = np.concatenate([flat, odd]), np.concatenate([sizes, n]), np.concatenate([owner, odd_owner])
        total = np.bincount(owner, sizes, len(words)).astype(np.int64)
        # Pieces of a word follow one another in each of the two lists, and a word is in one of them.
        order = np.argsort(owner, kind="stable")
        begin = np.cumsum(sizes) - sizes
        return flat[spread(begin[order], sizes[order])], total

    def _odd_words(self, words: pa.Array, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their number and the word of each piece of words that need the normaliser or hold special tokens."""
        pieces, owner = [], []
        for k in chosen.tolist():
            word, at = words[k].as_py(), 0
            found = [(m.start(), m.end()) for m in self.special_pattern.finditer(word)] if self.special_pattern else []
            for a, b in [*found, (len(word), len(word))]:
                normal = self.tokenizer.normalizer.normalize_str(word[at:a]) if a > at else ""
                own = [bytes(self.to_byte[c] for c in p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)] if normal else []
                if b > a:
                    own.append(SPECIAL + word[a:b].encode())
                pieces += own
                owner += [k] * len(own)
                at = b
        distinct = pa.array(pieces, pa.binary()).dictionary_encode()
        ids: list[np.ndarray] = []
        for piece in distinct.dictionary.to_pylist():
            if piece.startswith(SPECIAL):
                ids.append(np.array([self.special[piece[1:].decode()]]))
            else:
                raw = np.frombuffer(piece, np.uint8)
                ids.append(self.merges.apply(raw, np.array([0]), np.array([len(raw)]))[0])
        codes = distinct.indices.to_pylist()
        flat = np.concatenate([ids[c] for c in codes]) if codes else np.empty(0, np.int64)
        return flat, np.array([len(ids[c]) for c in codes], np.int64), np.array(owner, np.int64)


def frequent_words(docs: DataFrame, text: str = "text", words: int = WORDS, longest: int = LONGEST) -> list[str]:
    """At most `words` of the most frequent words of all texts, of at most `longest` bytes each.

    Tasks hold four times as many words at most: beyond that they lower all counts by the one that would be
    dropped first and forget those at zero, so every word more frequent than that loss is found.
    """

    def pruned(counts: pa.Table, limit: int) -> pa.Table:
        if len(counts) <= limit:
            return counts
        n = counts["n"].to_numpy()
        least = np.partition(n, len(n) - limit - 1)[len(n) - limit - 1]
        return pa.table({"word": counts["word"], "n": n - least}).filter(pa.array(n > least))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        for batch in batches:
            for part in slices(batch, 0):
                own = pc.value_counts(split_words(part.column(0)).flatten())
                size = pc.binary_length(own.field("values"))
                own = own.filter(pc.and_(pc.greater(size, 0), pc.less_equal(size, longest)))
                both = pa.concat_tables([held, pa.table({"word": own.field("values"), "n": own.field("counts")})])
                held = both.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
                held = pruned(held, words) if len(held) > 4 * words else held
        yield from pruned(held, words).to_batches()

    counts = docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    chosen = most_frequent(written(counts, "words"), words).collect()
    return [r["word"] for r in sorted(chosen, key=lambda r: (-r["n"], r["word"]))]


def build_lexicon(docs: DataFrame, tokenizer: str, text: str = "text", words: int = WORDS) -> str:
    """Compile the frequent words of `docs` with their ids, and give every executor the file; returns its name.

    The file lies in the shared scratch folder. Executors fetch it once, also those that join later."""
    spark = docs.sparkSession
    chosen = frequent_words(docs, text, words)
    ids, counts = Encoder(tokenizer).words(pa.array(chosen, pa.string()))
    ends = np.cumsum(counts).tolist()
    entries = [(w.encode(), tuple(ids[b - n : b].tolist())) for w, b, n in zip(chosen, ends, counts.tolist())]
    packed = io.BytesIO()
    np.save(packed, compile_words(entries))
    location = put(spark, scratch_dir(spark, "lexicon") + ".npy", packed.getvalue())
    spark.sparkContext.addFile(location)
    return location.rpartition("/")[2]


@functools.lru_cache(maxsize=2)
def _encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    return Encoder(tokenizer, Transducer.open(SparkFiles.get(lexicon)) if lexicon else None)


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) per row of `docs`: the ids that the tokenizer gives the whole text, without special tokens added.

    `lexicon` is the name that `build_lexicon` returned; without it every word is merged. Null and empty texts
    have no ids. Special tokens that a text spells out are special ids, as the tokenizer has it. Repeated rows
    and null ids are encoded row by row. Other columns are not read. An empty table gives no rows.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ids, offsets = _encoder(tokenizer, lexicon).encode(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


@functools.lru_cache(maxsize=2)
def _token_texts(tokenizer: str) -> pa.Array:
    with open(tokenizer, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    texts: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        texts[i] = token
    return pa.array(texts, pa.string())


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`encoded` with the column `decoded`: the tokens of its ids joined by spaces, as a vocabulary without a decoder
    gives them, special tokens included. Ids that are not in the vocabulary are passed over; null ids stay null."""
    at = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // DECODE_IDS
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(sizes)]):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, joined(part.column(at))], schema.names)

    def joined(lists: pa.ListArray) -> pa.Array:
        texts = _token_texts(tokenizer)
        flat = lists.flatten()
        valid = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(texts))), False)
        tokens = texts.take(pc.if_else(valid, flat, 0))
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        held = pc.and_(valid, tokens.is_valid())
        if not pc.all(held).as_py() and len(flat):
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sizes = np.bincount(owner[held.to_numpy(zero_copy_only=False)], minlength=len(sizes))
            tokens = tokens.filter(held)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tokens), " ")
        return pc.if_else(lists.is_valid(), text, pa.scalar(None, pa.string()))

    return encoded.mapInArrow(run, schema)
