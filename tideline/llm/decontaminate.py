"""Benchmark decontamination: latent semantic and exact retrieval of passages, confirmed by common subsequences."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.shared import slices
from tideline.llm.words import Table, Words

# Hashed terms, latent dimensions, and dimensions beyond them that the randomised SVD works with.
BUCKETS, RANK, OVERSAMPLE = 1 << 17, 160, 16
# Words of a passage in the SVD, and documents as which a larger corpus counts there against the items.
FIT_WORDS, CORPUS_DOCS = 64, 1_000
# Terms of the SVD besides those of the benchmark: the most frequent ones that carry weight.
FIT_TERMS = 1 << 14
# Weight of a benchmark item against a passage of the corpus in the SVD, so that its space covers the benchmark.
ITEM_WEIGHT = 16.0
# Share of the squared basis that the indexed terms hold; the many terms with next to no weight are left out.
ENERGY = 0.99
# Terms in a larger share of the documents carry no weight in the latent space; the exact search keeps them.
MAX_SHARE = 0.05
# Share of an item's words that the exact search asks for at once, and pairs of item and word that it holds at once.
RUN, PAIRS = 0.15, 1 << 20
# Windows advance by STEP words; their lengths are STEP times these.
STEP, SIZES = 8, (2, 4, 8)
# Least cosine of a candidate, least share of the item's words in order, and of its answer's words.
CANDIDATE, COMMON, ANSWER = 0.15, 0.6, 0.5
# Blocks whose words are looked up in the basis at once.
GATHERED = 1 << 12
SEED = 7
# Parts in which products of a round are summed.
BLOCKS = 16
# Entries of a product that are taken at once, slices of text whose entries are sorted together, and pairs of document
# and term that a task of the SVD takes: at least where there are fewer tasks than cores, and else about.
ENTRIES, TOGETHER, TASK_PAIRS = 1 << 10, 4, (1 << 22, 1 << 24)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def document_shares(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that hold each hashed term, over all of `docs`, and their number. A document counts a term once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch, 0):
                words = Words(part.column(0))
                kind = np.int32 if len(part) * BUCKETS < 1 << 31 else np.int64
                pairs = np.sort(words.text_of_word().astype(kind) * kind(BUCKETS) + bucket(words.hashes()).astype(kind))
                pairs = pairs[np.diff(pairs, prepend=-1) != 0]
                total += np.bincount(pairs & (BUCKETS - 1), minlength=BUCKETS)
                n += len(part)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, BUCKETS)), pa.array(np.append(total[held], n))], ["term", "n"])

    rows = docs.select(text).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    shares = np.zeros(BUCKETS + 1, np.int64)
    shares[rows["term"].to_numpy(int)] = rows["n"].to_numpy(int)
    return shares[:BUCKETS], int(shares[BUCKETS])


def weights(shares: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency of each term, zero for those in more than MAX_SHARE of the documents."""
    # In a small corpus the share of a single document may exceed the bound.
    return np.where(shares <= max(MAX_SHARE * n, 2), positive_weights(shares, n), 0.0).astype(np.float32)


def positive_weights(shares: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency of each term, at least one for those in all documents."""
    return (np.log((n + 1) / (shares + 1)) + 1.0).astype(np.float32)


def vocabulary(items: list[str], shares: np.ndarray, idf: np.ndarray, terms: int = FIT_TERMS) -> np.ndarray:
    """Row of each hashed term in the SVD, -1 if it has none: the terms of the items, and the `terms` most frequent others."""
    chosen = np.zeros(BUCKETS, bool)
    chosen[np.argsort(-np.where(idf > 0, shares, 0), kind="stable")[:terms]] = True
    chosen[bucket(Words(pa.array(items, pa.string())).hashes())] = True
    chosen &= idf > 0
    return np.where(chosen, np.cumsum(chosen) - 1, -1).astype(np.int32)


def passages(texts: pa.Array, idf: np.ndarray, places: np.ndarray, size: int = FIT_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (passage, place of the term) of the TF-IDF rows of non-overlapping passages, and the squared length of
    each passage over all its terms. An entry weighs the idf of its term, divided by the length of its passage."""
    words = Words(texts)
    of = words.text_of_word()
    place = np.arange(len(words)) - words.offsets[:-1][of] if len(words) else np.empty(0, np.int64)
    first = np.concatenate([[0], np.cumsum(-(-np.diff(words.offsets) // size))])
    row, term = first[of] + place // size, bucket(words.hashes())
    squares = np.bincount(row, idf[term].astype(float) ** 2, int(first[-1]))
    place = places[term]
    keep = place >= 0
    return row[keep], place[keep], np.maximum(squares, 1e-18)


def _add(out: np.ndarray, row: np.ndarray, x: np.ndarray, place: np.ndarray) -> None:
    """Add x[place] to the rows of `out`; rows ascend. Few entries at once stay in the processor's cache."""
    some = np.empty((ENTRIES, x.shape[1]), np.float32)
    for at in range(0, len(row), ENTRIES):
        rows = row[at : at + ENTRIES]
        part = x.take(place[at : at + ENTRIES], axis=0, out=some[: len(rows)], mode="clip")
        start = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[start]] += np.add.reduceat(part, start, axis=0)


def _add_product(out: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], x: np.ndarray) -> None:
    """Add to `out` the product of passages with `x` and back, both without the weights of terms."""
    first = np.cumsum([0] + [len(squares) for _, _, squares in found])
    row = np.concatenate([r + at for (r, _, _), at in zip(found, first)])
    place = np.concatenate([p for _, p, _ in found])
    y = np.zeros((int(first[-1]), x.shape[1]), np.float32)
    _add(y, row, x, place)
    y /= np.concatenate([squares for _, _, squares in found])[:, None].astype(np.float32)
    # Sorted with their numbers, as numbers of 64 bits, entries are in order sooner than by an argument sort.
    order = np.sort(place.astype(np.int64) << 32 | np.arange(len(place))) & 0xFFFFFFFF
    _add(out, place[order], y, row[order])


def latent_basis(docs: DataFrame, items: list[str], idf: np.ndarray, places: np.ndarray, share: float = 1.0, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """Right singular vectors of the TF-IDF passages of all of `docs` (column text) and the items, by randomised SVD.

    Each round is a Spark job: tasks multiply their passages with the current directions and back, and the
    products are summed per block of terms, one after the other. The directions (terms by `rank` plus a margin) pass
    through the driver between rounds, a size that does not depend on the data, and are orthonormalised there. The
    sum over the passages of `docs` counts by `share` beside that over the items.
    """
    width, size = rank + OVERSAMPLE, int(places.max(initial=-1)) + 1
    block = max(1, -(-size // BLOCKS))
    weight = idf[places >= 0][:, None]
    own = passages(pa.array(items, pa.string()), idf, places)
    basis = np.random.default_rng(SEED).standard_normal((size, width)).astype(np.float32)
    for _ in range(rounds):
        weighted = basis * weight
        sent = docs.sparkSession.sparkContext.broadcast(weighted)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, held = None, []
            for batch in batches:
                for part in slices(batch, 0):
                    held.append(passages(part.column(0), idf, places))
                    if len(held) == TOGETHER:
                        total = np.zeros((size, width), np.float32) if total is None else total
                        _add_product(total, held, sent.value)
                        held = []
            if held:
                total = np.zeros((size, width), np.float32) if total is None else total
                _add_product(total, held, sent.value)
            if total is not None:
                for at in range(0, size, block):
                    yield pa.RecordBatch.from_pydict({"block": [at], "data": [total[at : at + block].tobytes()]})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    part = np.frombuffer(data.as_buffer(), np.float32)
                    totals[at] = totals[at] + part if at in totals else part.astype(float)
            for at, total in totals.items():
                yield pa.RecordBatch.from_pydict({"block": [at], "data": [total.astype(np.float32).tobytes()]})

        product = np.zeros((size, width), np.float32)
        _add_product(product, [own], weighted)
        product *= np.float32(ITEM_WEIGHT**2)
        parts = docs.select("text").mapInArrow(multiply, "block long, data binary")
        for got in parts.repartition(BLOCKS, "block").mapInArrow(add, "block long, data binary").toLocalIterator():
            product[got["block"] : got["block"] + block] += np.float32(share) * np.frombuffer(got["data"], np.float32).reshape(-1, width)
        product *= weight
        # Orthonormal columns through the small Gram matrix, by falling singular value.
        values, vectors = np.linalg.eigh((product.T @ product).astype(float))
        order = np.argsort(-values)
        values, vectors = values[order], vectors[:, order]
        scale = np.where(values > 1e-9 * max(values[0], 1e-30), 1 / np.sqrt(np.maximum(values, 1e-30)), 0.0)
        basis = (product @ (vectors * scale).astype(np.float32)).astype(np.float32)
        sent.unpersist()
    return np.ascontiguousarray(basis[:, :rank])


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two hash sequences, a bit per word of `b`."""
    masks: dict[int, int] = {}
    for k, h in enumerate(b.tolist()):
        masks[h] = masks.get(h, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for h in a.tolist():
        hit = row & masks.get(h, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


@dataclass
class Index:
    """The latent vectors of benchmark items, and their words for the checks that follow."""

    idf: np.ndarray
    positive: np.ndarray  # weights of the exact search, zero for no term
    basis: np.ndarray  # latent rows of the terms in use
    row_of: np.ndarray  # term to row of `basis`, -1 if it carries no weight
    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    groups: list[np.ndarray]  # items to compare with the windows of each size

    @classmethod
    def build(cls, items: list[tuple], idf: np.ndarray, positive: np.ndarray, places: np.ndarray, basis: np.ndarray) -> "Index":
        """Items without words cannot leak and are left out. The answer is the last sentence, or without an
        earlier one the last third of the words."""
        energy = np.square(basis).sum(axis=1)
        falling = np.argsort(-energy, kind="stable")
        used = falling[: int(np.searchsorted(np.cumsum(energy[falling]), ENERGY * energy.sum())) + 1]
        used = np.sort(used[energy[used] > 0])
        terms = np.flatnonzero(places >= 0)[used]
        row_of = np.full(BUCKETS, -1, np.int32)
        row_of[terms] = np.arange(len(terms))
        self = cls(idf, positive, basis[used] * idf[terms][:, None], row_of, [], [], [], np.empty((0, basis.shape[1]), np.float32), [])
        vectors, lengths = [], []
        for item, text in items:
            own = Words(pa.array([text], pa.string()))
            if not len(own):
                continue
            hashes = own.hashes()
            head = (text or "").rstrip(" \t\r\n.!?")
            cut = max(head.rfind(". "), head.rfind("? "), head.rfind("! "), head.rfind("\n"))
            before = len(Words(pa.array([head[: cut + 1]], pa.string()))) if cut >= 0 else 0
            before = before if 0 < before < len(own) else len(own) - max(1, len(own) // 3)
            rows = row_of[bucket(hashes)]
            self.ids.append(item)
            self.words.append(hashes)
            self.answers.append(hashes[before:])
            vectors.append(self.basis[rows[rows >= 0]].sum(axis=0))
            lengths.append(len(own))
        if vectors:
            self.vectors = _unit(np.array(vectors, np.float32))
        # A window is compared with the items about as long as it; longer items with the longest windows.
        bounds = [0] + [int(STEP * s * 0.75) for s in SIZES[1:]] + [1 << 40]
        n = np.array(lengths, int)
        self.groups = [np.flatnonzero((n >= bounds[k]) & (n < bounds[k + 1])) for k in range(len(SIZES))]
        return self


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def candidates(words: Words, index: Index, least: float = CANDIDATE) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, item, first word, last word, cosine) of windows whose latent cosine with an item reaches `least`.

    Words are summed in blocks of STEP, and windows are runs of blocks of one text, each summed by itself, so that
    nothing depends on the other texts. A window keeps its full length in the cosine, so that one with little in
    the latent space is near to nothing."""
    hashes = words.hashes()
    rows = index.row_of[bucket(hashes)]
    sizes = np.diff(words.offsets)
    blocks = -(-sizes // STEP)
    first = np.concatenate([[0], np.cumsum(blocks)])
    of = words.text_of_word()
    block = first[of] + (np.arange(len(words)) - words.offsets[:-1][of]) // STEP
    used = np.flatnonzero(rows >= 0)
    rank = index.vectors.shape[1]
    # The row after the last block stays zero: windows at the end of a text are filled up with it.
    sums = np.zeros((int(first[-1]) + 1, rank), np.float32)
    start = np.flatnonzero(np.diff(block[used], prepend=-1))
    for at in range(0, len(start), GATHERED):
        some = start[at : at + GATHERED]
        end = start[at + GATHERED] if at + GATHERED < len(start) else len(used)
        sums[block[used[some]]] = np.add.reduceat(index.basis[rows[used[some[0] : end]]], some - some[0], axis=0)
    squares = np.concatenate([[0.0], np.cumsum(np.bincount(block, index.idf[bucket(hashes)].astype(float) ** 2, int(first[-1])))])
    text_of_block = np.repeat(np.arange(len(sizes)), blocks)
    for size, items in zip(SIZES, index.groups):
        if not len(items) or not len(text_of_block):
            continue
        # Windows start at every half of their size; the last ones of a text end with it.
        here = np.arange(len(text_of_block))
        start = here[(here - first[text_of_block]) % max(1, size // 2) == 0]
        end = np.minimum(start + size, first[text_of_block[start] + 1])
        for at in range(0, len(start), 4096):
            a, b = start[at : at + 4096], end[at : at + 4096]
            latent = sums[a]
            for k in range(1, size):
                latent += sums[np.where(a + k < b, a + k, len(text_of_block))]
            norm = np.sqrt(np.maximum(squares[b] - squares[a], 1e-9)).astype(np.float32)
            # No cosine exceeds the share of a window's length that lies in the latent space.
            near = np.flatnonzero(np.einsum("ij,ij->i", latent, latent) >= (least * norm) ** 2)
            a, b = a[near], b[near]
            cosine = latent[near] @ index.vectors[items].T / norm[near, None]
            x, y = np.nonzero(cosine >= least)
            for i, j in zip(x.tolist(), y.tolist()):
                t = int(text_of_block[a[i]])
                base = int(words.offsets[t])
                lo = base + int(a[i] - first[t]) * STEP
                hi = min(base + int(b[i] - first[t]) * STEP, int(words.offsets[t + 1]))
                yield t, int(items[j]), lo, hi, min(1.0, float(cosine[i, j]))


@dataclass
class Keys:
    """The rarest words of each item, so many that a passage with `common` of the item's words holds some of them."""

    table: Table
    rank: np.ndarray  # of a key in the table, by item
    item: np.ndarray
    least: np.ndarray  # occurrences of keys in a passage, at least, per item
    length: np.ndarray  # words per item

    @classmethod
    def build(cls, index: Index, common: float) -> "Keys":
        hashes, of, least = [], [], []
        for item, own in enumerate(index.words):
            slack = len(own) - max(1, int(np.ceil(common * len(own) - 1e-9)))
            distinct, n = np.unique(own, return_counts=True)
            rarest = np.argsort(-index.positive[bucket(distinct)], kind="stable")
            held = np.cumsum(n[rarest])
            last = min(int(np.searchsorted(held, slack + max(1, round(RUN * len(own))))), len(held) - 1)
            hashes.append(distinct[rarest[: last + 1]])
            of.append(np.full(last + 1, item))
            least.append(int(held[last]) - slack)
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        table = Table(np.unique(flat))
        own = np.concatenate(of) if of else np.empty(0, np.int64)
        return cls(table, np.searchsorted(table.order, flat), own, np.array(least, int), np.array([len(w) for w in index.words], int))


def exact_candidates(words: Words, keys: Keys) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first word, last word) of windows four times as long as the item, starting at every second
    length, among them one around each passage of up to two lengths with the item's words in order.

    Such a passage holds `least` keys of the item within two lengths; items are taken together as far as their
    pairs with words stay below PAIRS."""
    at, rank = keys.table.find(words.hashes()) if len(keys.item) else (np.empty(0, np.int64), None)
    if not len(at):
        return
    of = words.text_of_word()
    order = np.argsort(rank, kind="stable")
    by_rank = at[order]
    first = np.searchsorted(rank[order], np.arange(len(keys.table.order) + 1))
    n = (first[1:] - first[:-1])[keys.rank]
    held = np.flatnonzero(n)
    total = np.cumsum(np.bincount(keys.item[held], n[held], len(keys.least)).astype(np.int64))
    lo = 0
    while lo < len(total):
        before = int(total[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
        some = held[np.searchsorted(keys.item[held], lo) : np.searchsorted(keys.item[held], hi)]
        lo = hi
        if not len(some):
            continue
        size = n[some]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        place = by_rank[np.repeat(first[keys.rank[some]], size) + step]
        pairs = np.sort(np.repeat(keys.item[some], size) * np.int64(len(words)) + place)
        item, place = pairs // len(words), pairs % len(words)
        end = np.arange(len(pairs)) + keys.least[item] - 1
        run = np.flatnonzero(end < len(pairs))
        end = end[run]
        same = (item[run] == item[end]) & (of[place[run]] == of[place[end]]) & (place[end] - place[run] < 2 * keys.length[item[run]])
        run = run[same]
        item, place = item[run], place[run]
        # A passage around the run starts in the same step of two lengths or in the one before.
        text = of[place]
        cell = (place - words.offsets[text]) // (2 * keys.length[item])
        found = np.unique(np.concatenate([np.stack([text, item, cell]), np.stack([text, item, np.maximum(cell - 1, 0)])], axis=1), axis=1)
        for t, i, c in found.T.tolist():
            a = int(words.offsets[t]) + c * 2 * int(keys.length[i])
            yield t, i, a, min(a + 4 * int(keys.length[i]), int(words.offsets[t + 1]))


def exact_cosine(hashes: np.ndarray, own: np.ndarray, weight: np.ndarray) -> float:
    """Largest TF-IDF cosine of an item with a run of as many words in `hashes`."""
    terms, n = np.unique(own, return_counts=True)
    item = n * weight[bucket(terms)].astype(float)
    rank = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    value = weight[bucket(hashes)].astype(float)
    dots = np.concatenate([[0.0], np.cumsum(np.where(terms[rank] == hashes, value * item[rank], 0.0))])
    squares = np.concatenate([[0.0], np.cumsum(value**2)])
    size = min(len(own), len(hashes))
    norm = np.sqrt(np.maximum(squares[size:] - squares[:-size], 1e-9))
    return min(1.0, float(((dots[size:] - dots[:-size]) / norm).max() / np.linalg.norm(item)))


def confirmed(words: Words, index: Index, keys: Keys, least: float, common: float, answer: float) -> list[tuple[int, int, int, int, float, float, float]]:
    """Candidates that hold `common` of the item's words in order and `answer` of its answer's: per text and item the best.

    A window of the latent search is widened by the length of the item on either side, within its text, as it may
    begin inside the passage. Texts and items that it misses, because the space is too small for the benchmark or
    the item's terms carry no weight there, are taken from the exact search, with the TF-IDF cosine over all terms."""
    hashes = words.hashes()
    best: dict[tuple[int, int], tuple] = {}
    tables = {}
    for t, item, lo, hi, cosine in candidates(words, index, least):
        own, reply = index.words[item], index.answers[item]
        done = best.get((t, item))
        if done and done[2] <= lo and done[3] >= hi:
            continue
        lo = max(int(words.offsets[t]), lo - len(own))
        hi = min(int(words.offsets[t + 1]), hi + len(own))
        # Words outside the item change nothing: a bound first, then the subsequence on the words inside it.
        if item not in tables:
            tables[item] = Table(np.unique(own))
        at, _ = tables[item].find(hashes[lo:hi])
        if len(at) < common * len(own):
            continue
        inside = hashes[lo:hi][at]
        share = common_length(inside, own) / len(own)
        if share < common or (done and (share, cosine) <= (done[5], done[4])):
            continue
        replied = common_length(inside, reply) / len(reply)
        if replied >= answer:
            best[t, item] = (t, item, lo, hi, cosine, share, replied)
    latent = set(best)
    for t, item, lo, hi in exact_candidates(words, keys):
        if (t, item) in latent:
            continue
        own, reply = index.words[item], index.answers[item]
        if item not in tables:
            tables[item] = Table(np.unique(own))
        at, _ = tables[item].find(hashes[lo:hi])
        if len(at) < common * len(own):
            continue
        inside = hashes[lo:hi][at]
        share = common_length(inside, own) / len(own)
        if share < common:
            continue
        replied = common_length(inside, reply) / len(reply)
        if replied < answer:
            continue
        cosine = exact_cosine(hashes[lo:hi], own, index.positive)
        done = best.get((t, item))
        if cosine >= least and (not done or (share, cosine) > (done[5], done[4])):
            best[t, item] = (t, item, lo, hi, cosine, share, replied)
    return [best[k] for k in sorted(best)]


def build_index(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item: str = "text") -> Index:
    """Index of the benchmark: document frequencies and the SVD from all of `docs`, and the items. However many the
    documents, together they count in the SVD as CORPUS_DOCS at most, so that its space covers the items. The benchmark
    is a stated set of queries and is collected. Items with a null id or no words are left out."""
    items = [(r[0], r[1]) for r in benchmark.select(item_id, item).filter(F.col(item_id).isNotNull()).distinct().orderBy(item_id).collect()]
    shares, n = document_shares(docs, text)
    idf = weights(shares, n)
    texts = [t or "" for _, t in items]
    places = vocabulary(texts, shares, idf)
    # A task's product has a fixed size: few tasks for few documents.
    least, most = TASK_PAIRS
    pairs = int(shares.sum())
    tasks = max(1, min(docs.sparkSession.sparkContext.defaultParallelism, pairs // least), pairs // most)
    basis = latent_basis(docs.select(F.col(text).alias("text")).coalesce(tasks), texts, idf, places, min(1.0, CORPUS_DOCS / max(n, 1)))
    return Index.build(items, idf, positive_weights(shares, n), places, basis)


def search(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text", item_type: T.DataType = T.LongType(), least: float = CANDIDATE, common: float = COMMON, answer: float = ANSWER) -> DataFrame:
    """(doc_id, item_id, start, end, cosine, common, answer) per document and benchmark item it holds a passage of.

    Start and end are places in words. Every window of every text is compared. Null and empty texts and an empty
    benchmark give no rows; repeated rows are searched each. Columns besides id and text are not read.
    """
    fields = [("start", T.LongType()), ("end", T.LongType()), ("cosine", T.DoubleType()), ("common", T.DoubleType()), ("answer", T.DoubleType())]
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", item_type)]
        + [T.StructField(n, t) for n, t in fields]
    )
    sent = docs.sparkSession.sparkContext.broadcast((index, Keys.build(index, common)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys = sent.value
        for batch in batches:
            for part in slices(batch, 1):
                words = Words(part.column(1))
                found = confirmed(words, index, keys, least, common, answer) if len(index.ids) else []
                if found:
                    rows = pa.array([f[0] for f in found], pa.int64())
                    base = [int(words.offsets[f[0]]) for f in found]
                    columns = [
                        part.column(0).take(rows),
                        pa.array([index.ids[f[1]] for f in found]),
                        pa.array([f[2] - b for f, b in zip(found, base)], pa.int64()),
                        pa.array([f[3] - b for f, b in zip(found, base)], pa.int64()),
                        *(pa.array([f[k] for f in found], pa.float64()) for k in (4, 5, 6)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def remove(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no passage of the benchmark, columns unchanged; null and empty texts stay."""
    at = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast((index, Keys.build(index, COMMON)))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys = sent.value
        for batch in batches:
            for part in slices(batch, at):
                hit = {f[0] for f in confirmed(Words(part.column(at)), index, keys, CANDIDATE, COMMON, ANSWER)} if len(index.ids) else set()
                yield part.filter(pa.array([i not in hit for i in range(len(part))], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
