"""SimHash near-duplicates: word-shingle fingerprints and a tiled exact comparison."""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.components import components
from tideline.llm.shared import fresh, written

SHINGLE, RADIUS, SEED = 3, 2, 42
# Fingerprints of one tile.
TILE = 4096
# Votes are counted for so many shingles at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit number: a bit is set if over half of the shingle hashes set it.

    Words are what white space leaves of the text with A-Z in lower case. Fewer words than a shingle
    make one shingle; no words give zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, runs), itertools.repeat(SEED))
    votes, n = np.zeros(64, np.int64), 0
    while len(some := np.fromiter(itertools.islice(hashes, CHUNK), "<u8")):
        votes += np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(some)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """`docs` with the fingerprint of every text as a long column; other columns stay as they are."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array((fingerprint(t.as_py(), shingle) for t in batch.column(at)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], schema.names)

    return docs.mapInArrow(add, schema)


def block_counts(fps: np.ndarray, blocks: int) -> np.ndarray:
    """Population counts of the equal parts of each fingerprint, one row per fingerprint."""
    width = 64 // blocks
    mask = np.uint64((1 << width) - 1)
    bits = fps.astype(np.int64).view(np.uint64)
    return np.stack([np.bitwise_count(bits >> np.uint64(width * k) & mask) for k in range(blocks)], axis=1)


def blocks_for(count: int) -> int:
    """Parts whose population counts make a tile key: more for more fingerprints, so tiles stay full but few
    tile pairs come within the radius. It moves work only; every pair within the radius is always compared."""
    return 2 if count < 1 << 17 else 4 if count < 1 << 25 else 8


def steps(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts within the radius, one of each pair of opposites, zero included."""

    def grow(k: int, left: int) -> Iterator[tuple[int, ...]]:
        if k == 0:
            yield ()
            return
        for d in range(-left, left + 1):
            for rest in grow(k - 1, left - abs(d)):
                yield (d, *rest)

    return [s for s in grow(blocks, radius) if s >= (0,) * blocks]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least index reachable from each of n nodes over the links (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (up := root[root] != root).any():
            root = np.where(up, root[root], root)


def compare(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints of two tiles within the radius: a spanning forest, no more."""
    both = np.concatenate([left, right])
    root = np.arange(len(both))
    for at in range(0, len(left), 256):
        near = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= radius
        a, b = np.nonzero(near)
        if len(a):
            a, b = root[a + at], root[b + len(left)]
            root = forest(a, b, len(both))[root]
    linked = np.flatnonzero(root != np.arange(len(both)))
    return both[linked], both[root[linked]]


def links(fps: DataFrame, radius: int = RADIUS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect the distinct long values `fp` at `radius` or fewer differing bits.

    Values are tiled by the population counts of their parts. Two values within the radius have counts
    that differ by no more than the radius in all, so only such tile pairs are compared, each pair of
    values by exclusive-or and bit count. Tiles of a full key are numbered and hold about `tile` values.
    From a tile pair come the links of a spanning forest, which keep every connection.
    """
    blocks = blocks or blocks_for(fps.count())
    offsets = steps(blocks, radius)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            counts = block_counts(fp, blocks)
            key = pa.array([bytes(row) for row in counts.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), key], ["fp", "key"])

    keys = fps.select("fp").mapInArrow(keyed, "fp long, key binary")
    parts = keys.groupBy("key").agg(F.ceil(F.count("*") / tile).alias("parts"))
    numbered = keys.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("fp"), "parts"))
    tiles = written(numbered.groupBy("key", "part").agg(F.collect_list("fp").alias("fps")), "tiles")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part, fp in zip(*(batch.column(k) for k in range(3))):
                own, targets = np.frombuffer(key.as_py(), np.uint8).astype(np.int64), []
                for step in offsets:
                    other = own + step
                    if ((other >= 0) & (other <= 64 // blocks)).all():
                        targets.append((bytes(other.astype(np.uint8)), not any(step)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t for t, _ in targets], pa.binary()),
                        pa.array([s for _, s in targets], pa.bool_()),
                        pa.array([part.as_py()] * len(targets), pa.int64()),
                        pa.array([fp.as_py()] * len(targets), pa.list_(pa.int64())),
                    ],
                    ["key", "same", "from_part", "others"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, others in zip(batch.column(0), batch.column(1)):
                a, b = compare(mine.values.to_numpy().view(np.uint64), others.values.to_numpy().view(np.uint64), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    reached = tiles.mapInArrow(reach, "key binary, same boolean, from_part long, others array<long>")
    pairs = tiles.join(reached, "key").filter("not same or part <= from_part").select("fps", "others")
    return pairs.mapInArrow(join, "a long, b long")


def classes(fps: DataFrame, doc_id: str, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for all distinct fingerprints of the table (doc_id, fp)."""
    first = written(fps.groupBy("fp").agg(F.min(doc_id).alias("first_id")), "firsts")
    roots = written(components(links(first, radius)), "roots")
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of `docs`, component_id the least id that links reach.

    Fingerprints are 16 lower-case hex digits. Null and empty texts have fingerprint zero, which links
    like any other. Repeated rows are kept; null ids never become a component id unless a component has
    no other. Columns besides id and text are not read. An empty table gives no rows.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fps = written(fingerprints(own, "text", shingle).select("doc_id", "fp"), "fps")
    found = fps.join(classes(fps, "doc_id", radius), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the least id.

    Columns are those of `docs`. Of repeated rows with that id one stays; null ids come last.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row_number")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = written(fingerprints(numbered, text, shingle, fp), "fingerprinted")
    own = rows.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    rooted = own.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"))
    rooted = written(rooted, "firsts")
    roots = components(links(rooted, radius)).withColumnRenamed("node", "fp")
    best = rooted.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("best").alias("best"))
    kept = best.select(F.col("best.row").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)
