"""Personal data: pattern spans, and a skip-chain conditional random field that adds what they miss."""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.shared import slices

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
# Fixed patterns of the query's contract; possessive runs match the same spans without backtracking.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")
MARKED = re.compile(r"[0-9@]|[(\[]at[)\]]")
TOKEN = re.compile(r"(?:[0-9@]|[(\[]at[)\]])[^\x20\x09-\x0D]*")
# Ways to write out the signs of an address.
SIGN = re.compile(r"[(\[](?:at|dot|\.|@)[)\]]")
EDGES = ".,;:!?\"'()[]{}<>|*#$%&"
SPACE = frozenset("\x20\t\n\x0b\x0c\r")

# Documents from which the field is fitted, tokens of one of them, and tokens of all, at most.
FIT_DOCS, FIT_DOC_TOKENS, FIT_TOKENS = 2_000, 400, 40_000
# Texts in which a pattern is likely to match; half of the documents of the fit are of this sort.
LIKELY = r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]|[0-9](\.[0-9]+){3}|([0-9][ -]?){14}"
# Marginal probability from which a token outside the pattern spans is marked.
THRESHOLD = 0.9
ROUNDS, DAMPING = 12, 0.5
MOMENTUM = 0.8

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: its local part starts with the run before it."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
        after = domain.end() if domain else at + 1
        at = text.find("@", after)


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    if not MARKED.search(text):
        return []
    found = [(a, b, 0) for a, b in emails(text)]
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = NOT_DIGITS.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def rendered(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or @, without the punctuation around them."""
    out, end = [], 0
    for m in TOKEN.finditer(text):
        a, end_before, end = m.start(), end, m.end()
        while a > end_before and text[a - 1] not in SPACE:
            a -= 1
        b = end
        while a < b and text[a] in EDGES:
            a += 1
        while b > a and text[b - 1] in EDGES:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


FEATURES = 38


def features(text: str, a: int, b: int) -> list[int]:
    """Indexes of the features a token has: shape of its digits and signs, and signs beside it."""
    token = text[a:b]
    digits = NOT_DIGITS.sub("", token)
    n, letters = len(digits), sum(c.isalpha() for c in token)
    # How many digits there are tells something of numbers only, not of names that hold some.
    on = [0] + [1 + (n > 0) + (n > 3) + (n > 6) + (n > 9) + (n > 13) + (n > 15) + (n > 19)] * (letters < 3)
    on += [9] * ("@" in token) + [10] * (letters == 0) + [11] * (0 < letters < 3) + [12] * (letters >= 3)
    on += [13] * (13 < n < 20 and luhn(digits)) + [14] * token.startswith("+") + [15] * (text[a - 1 : a] == "(")
    parts = token.split(".")
    on += [16] * (len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts))
    on += [17] * (len(parts) == 4) + [18] * ("-" in token) + [19] * ("@" in token and DOMAIN.search(token) is not None)
    on += [20] * ("=" in text[max(0, a - 4) : a]) + [21] * (text[max(0, a - 3) : a].rstrip("(").endswith("+1 "))
    # Numbers cut by signs: how many there are, how long they are, and which signs cut them.
    runs = re.findall("[0-9]+", token)
    sizes, signs = [len(r) for r in runs], NOT_DIGITS.findall(token)
    on += [22 + min(len(runs), 5)] if letters < 8 and runs else [22]
    on += [28] * (sizes == [4, 4, 4, 4]) + [29] * (sizes[-2:] == [3, 4] and letters == 0) + [30] * (sizes == [3])
    on += [31] * (len(runs) == 4 and all(len(r) < 4 and int(r) < 256 for r in runs))
    on += [32] * (SIGN.search(token) is not None) + [33] * (SIGN.search(token) is not None and letters > 7)
    on += [34] * (len(set(signs)) == 1 and len(signs) > 1 and letters == 0) + [35] * (text[b : b + 1] == ")")
    on += [36] * (n > 0 and text[b : b + 2] == " (") + [37] * (text[max(0, a - 2) : a] == ") ")
    return on


def keys(token: str) -> list[str]:
    """What makes two tokens equal or similar: the token itself, its digits from seven up, its last seven digits."""
    digits = NOT_DIGITS.sub("", token)
    own = ["=" + token.lower()]
    if len(digits) >= 7:
        own += ["#" + digits, "~" + digits[-7:]]
    if "@" in token:
        own.append("=" + token.lower().partition("@")[0])
    return own


@dataclass
class Graph:
    """Candidate tokens of some documents: feature rows, document, place, and links by type."""

    on: list[list[int]]
    place: list[tuple[int, int, int]]  # document, start, end
    label: list[int]  # kind of the pattern span that holds the token, OTHER outside
    links: list[tuple[int, int, int]]  # node, node, type: 0 next token, 1 equal, 2 similar


def graph(texts: list[str], spans: list[list[Span]]) -> Graph:
    """Tokens of each text, neighbours linked, and every token linked to the nearest earlier one that shares a key.

    Linking an occurrence to the one before it connects all occurrences with a number of links that grows
    with the tokens, not with their pairs."""
    g = Graph([], [], [], [])
    for d, text in enumerate(texts):
        if not MARKED.search(text):
            continue
        last: dict[str, int] = {}
        before = None
        # Spans of one kind do not overlap, so a place in each kind's list is enough.
        of_kind = [[s for s in spans[d] if s[2] == k] for k in range(OTHER)]
        at = [0] * OTHER
        for a, b in tokens(text):
            i = len(g.place)
            inside = []
            for k, own in enumerate(of_kind):
                while at[k] < len(own) and own[at[k]][1] <= a:
                    at[k] += 1
                if at[k] < len(own) and own[at[k]][0] < b:
                    inside.append((own[at[k]][0], k))
            g.on.append(features(text, a, b))
            g.place.append((d, a, b))
            g.label.append(min(inside)[1] if inside else OTHER)
            if before is not None and not text[before:a].strip(EDGES + " ") and a - before < 4:
                g.links.append((i - 1, i, 0))
            linked = set()
            for key in keys(text[a:b]):
                j = last.get(key)
                if j is not None and j not in linked:
                    linked.add(j)
                    g.links.append((j, i, 2 if key[0] == "~" else 1))
                last[key] = i
            before = b
    return g


@dataclass
class Field:
    """A fitted field: weight of each feature per label, and of each pair of labels per link type."""

    unary: np.ndarray
    pair: np.ndarray

    def marginals(self, g: Graph, seen: np.ndarray) -> np.ndarray:
        """Label probabilities of all tokens after loopy message passing; `seen` tokens keep their label."""
        n = len(g.place)
        theta = np.zeros((n, OTHER + 1))
        for i, on in enumerate(g.on):
            theta[i] = self.unary[on].sum(axis=0)
        label = np.array(g.label)
        theta[seen] = -30.0
        theta[seen, label[seen]] = 0.0
        if not g.links:
            return _softmax(theta)
        one = np.array(g.links)
        source = np.concatenate([one[:, 0], one[:, 1]])
        target = np.concatenate([one[:, 1], one[:, 0]])
        psi = self.pair[np.concatenate([one[:, 2], one[:, 2]])]
        psi[len(one) :] = psi[len(one) :].transpose(0, 2, 1)
        back = np.concatenate([np.arange(len(one)) + len(one), np.arange(len(one))])
        messages = np.zeros((len(source), OTHER + 1))
        for _ in range(ROUNDS):
            belief = theta.copy()
            np.add.at(belief, target, messages)
            h = (belief[source] - messages[back])[:, :, None] + psi
            top = h.max(axis=1)
            new = top + np.log(np.exp(h - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * new
        np.add.at(theta, target, messages)
        return _softmax(theta)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def altered(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its spans written so that the patterns refuse them, and where these now are.

    A span's own hash chooses among written-out signs, other separators and a missing plus sign; equal spans are
    altered alike. Spans that overlap an earlier one are left out of the choice but stay labelled by it."""
    out, moved, at, size = [], [], 0, 0
    for a, b, k in spans:
        if a < at:
            continue
        own = text[a:b]
        way = zlib.crc32(own.encode("utf-8", "surrogatepass")) % 4
        if k == 0:
            dot = (".", ".", "(dot)", "[dot]")[way]
            local, _, domain = own.partition("@")
            new = local + ("(at)", "[at]", "(at)", "[at]")[way] + domain.replace(".", dot)
        elif k == 1:
            new = own.replace(".", ("[.]", "(dot)", "-", "[dot]")[way])
        elif k == 2:
            digits = NOT_DIGITS.sub("", own)
            new = "./_:"[way].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            new = own[1:] if way == 0 else re.sub("[^0-9]+", ("", "-", ".", "/")[way], own[1:])
        out += [text[at:a], new]
        size += a - at
        moved.append((size, size + len(new), k))
        size, at = size + len(new), b
    return "".join(out) + text[at:], moved


def part_of(g: Graph, least: int, limit: int) -> Graph:
    """At most `limit` tokens of a graph from place `least % len` on, round its end, with the links among them."""
    n = len(g.on)
    if n <= limit:
        return g
    chosen = sorted((least + i) % n for i in range(limit))
    new = {old: i for i, old in enumerate(chosen)}
    links = [(new[a], new[b], t) for a, b, t in g.links if a in new and b in new]
    return Graph([g.on[i] for i in chosen], [g.place[i] for i in chosen], [g.label[i] for i in chosen], links)


def samples(text: str, limit: int = FIT_DOC_TOKENS) -> list[Graph]:
    """What the field learns from a text: its tokens with the labels of the patterns, and those of its altered copy,
    at most `limit` of each, from a place that the text's hash chooses."""
    spans = pattern_spans(text)
    copy, moved = altered(text, spans)
    pairs = [(text, spans), (copy, moved)] if moved else [(text, spans)]
    return [part_of(graph([t], [s]), zlib.crc32(t.encode("utf-8", "surrogatepass")), limit) for t, s in pairs]


def joined(graphs: list[Graph]) -> Graph:
    g = Graph([], [], [], [])
    for d, one in enumerate(graphs):
        n = len(g.on)
        g.on += one.on
        g.place += [(d, a, b) for _, a, b in one.place]
        g.label += one.label
        g.links += [(a + n, b + n, t) for a, b, t in one.links]
    return g


def fit_graph(g: Graph, rounds: int = 400, ridge: float = 3e-4) -> Field:
    """Feature and link weights of highest composite likelihood: each label given the labels its token is linked to, and
    each label given its features alone, without which the features would leave all to labels that are not known later.

    Both sorts are fitted together, with a ridge that falls for link types with few links. No tokens give feature weights of zero, with which nothing is marked. Link
    weights stay within three, so that messages around a cycle settle."""
    n, labels = len(g.on), OTHER + 1
    w, pair = np.zeros((FEATURES, labels)), np.zeros((3, labels, labels))
    if not n:
        return Field(w, pair)
    x = np.zeros((n, FEATURES), np.float32)
    for i, on in enumerate(g.on):
        x[i, on] = 1
    label = np.array(g.label)
    goal = np.eye(labels, dtype=np.float32)[label]
    # Per link type: how many linked tokens of each label come later and earlier.
    after, before = np.zeros((3, n, labels), np.float32), np.zeros((3, n, labels), np.float32)
    if g.links:
        a, b, t = np.array(g.links).T
        np.add.at(after, (t, a, label[b]), 1)
        np.add.at(before, (t, b, label[a]), 1)
    # Steps of a link type are scaled by its links, and by its most at a token, which keeps them stable on hubs.
    linked = (after + before).sum(axis=2)
    scale = np.maximum(1, linked.max(axis=1)) * np.maximum(1, (linked > 0).sum(axis=1))
    w_step, pair_step = np.zeros_like(w), np.zeros_like(pair)
    for _ in range(rounds):
        score = x @ w + sum(after[k] @ pair[k].T + before[k] @ pair[k] for k in range(3))
        miss, alone = _softmax(score) - goal, _softmax(x @ w) - goal
        w_step = MOMENTUM * w_step - x.T @ (miss + alone) / n - ridge * w
        slope = np.stack([(miss.T @ after[k] + before[k].T @ miss) / scale[k] for k in range(3)])
        pair_step = MOMENTUM * pair_step - slope - ridge * pair
        w, pair = w + w_step, np.clip(pair + pair_step, -3, 3)
    return Field(w, pair)


def fit(texts: list[str], limit: int = FIT_TOKENS) -> Field:
    """Fit the field to some texts, up to the text with which `limit` tokens are reached."""
    chosen, n = [], 0
    for text in texts:
        for g in samples(text):
            chosen.append(g)
            n += len(g.on)
        if n >= limit:
            break
    return fit_graph(joined(chosen))


def fit_sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = FIT_DOCS, limit: int = FIT_TOKENS) -> Field:
    """Fit the field on at most `rows` documents with a digit or @, half of them such that a pattern is likely to match.

    Documents are those least by a hash of the id; equal rows count once each. Features and links are taken in the
    tasks, at most FIT_DOC_TOKENS tokens from a text and its altered copy, so no text reaches the driver; it stops
    reading at `limit` tokens. Null and empty texts, and empty tables, give nothing to learn from.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    order = [F.xxhash64("doc_id"), F.xxhash64("text")]
    marked = own.withColumn("likely", F.col("text").rlike(LIKELY)).select("doc_id", "likely", *[h.alias(f"h{i}") for i, h in enumerate(order)])
    ranked = [marked.filter(F.col("likely") == flag).orderBy("h0", "h1").limit(rows // 2) for flag in (True, False)]
    least = ranked[0].unionByName(ranked[1]).select("h0", "h1").distinct()
    # Rows may repeat and are then taken together; the driver stops at the limit of tokens.
    hashed = own.select("text", *[h.alias(f"h{i}") for i, h in enumerate(order)])
    chosen = hashed.join(F.broadcast(least), ["h0", "h1"]).orderBy("h0", "h1").limit(rows).select("text")
    schema = "features array<array<int>>, label array<int>, links array<array<int>>"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
        for part in (p for batch in batches for p in slices(batch, 0)):
            found = [g for t in part.column(0).to_pylist() for g in samples(t or "")]
            columns = [[g.on for g in found], [g.label for g in found], [g.links for g in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["features", "label", "links"])

    graphs, n = [], 0
    for row in chosen.mapInArrow(extract, schema).toLocalIterator():
        graphs.append(Graph(row["features"], [(0, 0, 0)] * len(row["label"]), row["label"], [tuple(x) for x in row["links"]]))
        n += len(row["label"])
        if n >= limit:
            break
    return fit_graph(joined(graphs))


def added_spans(texts: list[str], spans: list[list[Span]], field: Field, threshold: float = THRESHOLD) -> list[list[Span]]:
    """Spans of tokens outside the pattern spans that the field marks; neighbours with one label are one span."""
    g = graph(texts, spans)
    added: list[list[Span]] = [[] for _ in texts]
    if not g.place:
        return added
    label = np.array(g.label)
    p = field.marginals(g, label != OTHER)
    best = p[:, :OTHER].argmax(axis=1)
    marked = (label == OTHER) & (p[np.arange(len(p)), best] >= threshold)
    for i in np.flatnonzero(marked):
        d, a, b = g.place[i]
        own = added[d]
        if i and marked[i - 1] and own and own[-1][2] == best[i] and a - own[-1][1] < 4 and not texts[d][own[-1][1] : a].strip(" ()"):
            own[-1] = (own[-1][0], b, int(best[i]))
        else:
            own.append((a, b, int(best[i])))
    return added


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base (its pattern spans) and spans (all spans).

    Spans are `kind:start:end` by start, then kind, in code points, end exclusive, joined by commas. Counts
    are those of the pattern spans, which always stay. Null and empty texts have none. Repeated rows are
    scanned each. Columns besides id and text are not read.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[doc_id].dataType)]
        + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, 1)):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [pattern_spans(t) for t in texts]
            more = added_spans(texts, base, field, threshold)
            every = [sorted(b + m, key=lambda s: (s[0], s[2])) for b, m in zip(base, more)]
            counts = [pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in range(OTHER)]
            columns = [part.column(0), *counts, pa.array(map(rendered, base)), pa.array(map(rendered, every))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(doc_id, text).mapInArrow(scan, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans are replaced as one."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, field: Field, text: str = "text", n_chars: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with personal data replaced by the name of its kind in angle brackets.

    `n_chars`, if there, becomes the new length; other columns and null texts stay as they are.
    """
    at = docs.columns.index(text)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, at)):
            texts = part.column(at).to_pylist()
            whole = [t or "" for t in texts]
            base = [pattern_spans(t) for t in whole]
            more = added_spans(whole, base, field, threshold)
            new = [t and redacted(t, sorted(b + m)) for t, b, m in zip(texts, base, more)]
            columns = list(part.columns)
            columns[at] = pa.array(new, part.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    out = docs.mapInArrow(replace, docs.schema)
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.coalesce(F.length(text).cast(docs.schema[n_chars].dataType), F.col(n_chars)))
    return out
