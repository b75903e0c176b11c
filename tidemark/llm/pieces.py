"""SentencePiece encoding and decoding as a relational lattice.

Per batch of texts, with columns instead of objects: the different words are taken out once; their substrings of
bounded length are exploded; an equi-join with the piece table, by hash and then by content, leaves the edges of each
word's lattice; edges are grouped by word and folded. For a unigram model the fold is Viterbi: best score per end
position. For a BPE model the highest sum of scores is not what the model means, so there the fold takes, per word,
the best edge that joins two neighbouring segments, until none does; ties go to the left.

Words are cut only where no piece of the model crosses, so folding words apart changes nothing. No text is shuffled:
words meet within a batch and in a bounded cache of each worker. Decoding is a Spark expression.
"""

from __future__ import annotations

import functools
import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import free_name, map_batches

SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
WIDE = 63  # boundaries that fit a word of bits; longer words are folded one by one
CACHE = 200_000  # words a worker remembers
BITS = 18


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces with scores, and how texts are prepared."""

    unigram: bool
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    prefix: bool
    bytes_: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(2)


def read_model(path: str) -> Model:
    """Reads a model file on the driver; models that rewrite texts before they cut them are refused."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, kinds = proto.normalizer_spec, tuple(p.type for p in proto.pieces)
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normaliser that keep white space are supported")
    if proto.trainer_spec.model_type not in (1, 2) or 4 in kinds:
        raise ValueError("only unigram and BPE models without user-defined pieces are supported")
    return Model(
        proto.trainer_spec.model_type == 1, tuple(p.piece for p in proto.pieces), tuple(p.score for p in proto.pieces),
        kinds, norm.add_dummy_prefix, proto.trainer_spec.byte_fallback,
    )


def word_pattern(pieces: list[str]) -> str:
    """A pattern that cuts texts where no piece crosses.

    Characters are spaces, letters or others. The finest cut that no pair of neighbours in any piece contradicts is
    taken: spaces and then letters or others; spaces and then anything; or the whole text. Numerals such as raised
    digits, which patterns take for letters, count as others where the pieces have them.
    """
    letter = re.compile(r"[^\W\d_]")
    numerals = "".join(sorted({c for p in pieces for c in p if letter.match(c) and not c.isalpha()}))
    kind = lambda c: "s" if c == SPACE else "l" if letter.match(c) and c not in numerals else "o"
    pairs = {kind(a) + kind(b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
    if pairs & {"ls", "os"}:
        return r"(?s:.+)"
    if pairs & {"lo", "ol"}:
        return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
    return rf"{SPACE}*[^\W\d_{numerals}]+|{SPACE}*(?:[\W\d_{numerals}](?<!{SPACE}))+|{SPACE}+"


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Encoder:
    """A model's piece table, by length, and the fold."""

    def __init__(self, model: Model):
        self.model = model
        normal = [i for i, k in enumerate(model.kinds) if k == 1]
        self.cut = re.compile(word_pattern([model.pieces[i] for i in normal])).findall
        self.longest = max((len(model.pieces[i]) for i in normal), default=1)
        self.powers = _powers(self.longest)
        order = sorted(set(model.scores), reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        self.rank = np.array([rank[s] for s in model.scores], np.int64)
        self.score = np.array(model.scores)
        self.table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in range(1, self.longest + 1):
            ids = np.array([i for i in normal if len(model.pieces[i]) == size], np.int64)
            if len(ids):
                points = _points([model.pieces[i] for i in ids]).reshape(len(ids), size)
                hashes = (points * self.powers[size - 1:: -1][:size]).sum(axis=1, dtype=np.uint64)
                by = np.argsort(hashes)
                if (np.diff(hashes[by]) == 0).any():
                    raise ValueError("two pieces share a hash")
                seen = np.zeros(1 << BITS, bool)
                seen[hashes >> np.uint64(64 - BITS)] = True
                self.table[size] = seen, hashes[by], ids[by], points[by]
        self.piece_id = {model.pieces[i]: i for i in normal}
        byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == 6}
        self.lone = functools.cache(lambda c: (
            [self.piece_id[c]] if c in self.piece_id
            else [byte[b] for b in c.encode("utf-8", "surrogatepass")] if model.bytes_ else [model.unknown]
        ))
        self.cache: dict[str, bytes] = {}

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, length, piece) of every substring of a word that is a piece, longer than one code point or not."""
        points = _points(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
        left = np.repeat(ends, sizes) - np.arange(len(points))
        hashes = np.zeros(len(points), np.uint64)
        at = np.arange(len(points))
        found = []
        for size in range(1, self.longest + 1):
            at = at[left[at] >= size]
            if not len(at):
                break
            hashes[at] = hashes[at] * BASE + points[at + (size - 1)]
            if size not in self.table:
                continue
            seen, known, ids, content = self.table[size]
            near = at[seen[hashes[at] >> np.uint64(64 - BITS)]]
            slot = np.minimum(np.searchsorted(known, hashes[near]), len(known) - 1)
            same = known[slot] == hashes[near]
            near, slot = near[same], slot[same]
            same = (points[near[:, None] + np.arange(size)] == content[slot]).all(axis=1)
            near, slot = near[same], slot[same]
            found.append((owner[near], place[near], np.full(len(near), size), ids[slot]))
        if not found:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def fold_merges(self, words: list[str]) -> list[bytes]:
        """BPE: bit i of a word's bounds says that a segment starts or ends at code point i. Gives packed ids."""
        word, start, size, piece = self.edges(words)
        order = np.argsort(word << 40 | self.rank[piece] << 8 | start)
        word, piece, size, start = word[order], piece[order], size[order], start[order]
        sizes = np.fromiter(map(len, words), np.uint64, len(words))
        one = np.uint64(1)
        bounds = (one << (sizes + one)) - one
        low = start.astype(np.uint64)
        high = low + size.astype(np.uint64)
        ends = (one << low) | (one << high)
        inner = (one << high) - (one << (low + one))
        live = np.flatnonzero(size > 1)
        while len(live):
            here = bounds[word[live]]
            inside = np.bitwise_count(here & inner[live])
            keep = ((here & ends[live]) == ends[live]) & (inside > 0)
            live, inside = live[keep], inside[keep]
            ready = live[inside == 1]
            if not len(ready):
                break
            first = np.ones(len(ready), bool)
            first[1:] = word[ready[1:]] != word[ready[:-1]]
            best = ready[first]
            bounds[word[best]] &= ~inner[best]
        here = bounds[word]
        chosen = np.flatnonzero(((here & ends) == ends) & ((here & inner) == 0))
        chosen = chosen[np.argsort(word[chosen] << 8 | start[chosen])]
        counts = np.bincount(word[chosen], minlength=len(words))
        at = np.concatenate([[0], np.cumsum(counts)]) * 4
        packed = piece[chosen].astype(np.int32).tobytes()
        out = [packed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for i in np.flatnonzero(counts != np.bitwise_count(bounds) - 1).tolist():  # a code point that is no piece
            w, bits = words[i], int(bounds[i])
            cuts = [k for k in range(len(w) + 1) if bits >> k & 1]
            out[i] = _pack(t for a, b in zip(cuts, cuts[1:], strict=False) for t in self._token(w[a:b]))
        return out

    def _token(self, part: str) -> list[int]:
        return self.lone(part) if len(part) == 1 else [self.piece_id[part]]

    def merge_long(self, word: str) -> list[int]:
        """The same fold for one word of any length, with a heap of edges between neighbours."""
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(word):
                piece = self.piece_id.get(word[a: after[b]])
                if piece is not None:
                    heapq.heappush(heap, (int(self.rank[piece]), a, b, after[b]))

        for i in range(len(word) - 1):
            offer(i, i + 1)
        gone = [False] * len(word)
        while heap:
            _, a, b, end = heapq.heappop(heap)
            if gone[a] or gone[b] or after[a] != b or after[b] != end:
                continue
            gone[b] = True
            after[a] = end
            if end < len(word):
                before[end] = a
            offer(before[a], a)
            offer(a, end)
        return [t for a in range(len(word)) if not gone[a] for t in self._token(word[a: after[a]])]

    def fold_viterbi(self, words: list[str]) -> list[list[int]]:
        """Unigram: the best score of every prefix, one length of prefix after the other, all words in step."""
        word, start, size, piece = self.edges(words)
        value = self.score[piece]
        normal = [s for s, k in zip(self.model.scores, self.model.kinds, strict=True) if k == 1]
        unknown = min(normal, default=0.0) - 10.0
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        known = np.zeros(int(sizes.sum()), bool)
        offset = np.cumsum(sizes) - sizes
        known[(offset[word] + start)[size == 1]] = True
        lone = np.flatnonzero(~known)
        owner = np.repeat(np.arange(len(words)), sizes)[lone]
        word, start = np.concatenate([word, owner]), np.concatenate([start, lone - offset[owner]])
        size, piece = np.concatenate([size, np.ones(len(lone), np.int64)]), np.concatenate([piece, np.full(len(lone), -1)])
        value = np.concatenate([value, np.full(len(lone), unknown)])
        base = np.cumsum(sizes + 1) - (sizes + 1)
        best = np.full(int((sizes + 1).sum()), -np.inf)
        back = np.zeros(len(best), np.int64)
        best[base] = 0.0
        end = start + size
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(1, int(sizes.max(initial=0)) + 2))
        for a, b in zip(cuts, cuts[1:], strict=False):
            rows = order[a:b]
            total = best[base[word[rows]] + start[rows]] + value[rows]
            top = np.lexsort((start[rows], -total, word[rows]))
            first = np.ones(len(top), bool)
            first[1:] = word[rows[top[1:]]] != word[rows[top[:-1]]]
            chosen = top[first]
            to = base[word[rows[chosen]]] + end[rows[chosen]]
            best[to], back[to] = total[chosen], rows[chosen]
        out = []
        for i, w in enumerate(words):
            ids, at = [], len(w)
            while at:
                row = back[base[i] + at]
                ids.append(self.lone(w[start[row]]) if piece[row] < 0 else [int(piece[row])])
                at = int(start[row])
            out.append([t for part in reversed(ids) for t in part])
        return out

    def learn(self, words: list[str]) -> None:
        """Encodes words into the cache."""
        if self.model.unigram:
            done = list(map(_pack, self.fold_viterbi(words)))
        else:
            short = [w for w in words if len(w) < WIDE]
            done = self.fold_merges(short) if short else []
            longer = [w for w in words if len(w) >= WIDE]
            words, done = short + longer, done + [_pack(self.merge_long(w)) for w in longer]
        self.cache.update(zip(words, done, strict=True))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.cut((SPACE if self.model.prefix else "") + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = {w for words in cut for w in words if w not in self.cache}
        if len(self.cache) + len(new) > CACHE:
            self.cache = {}
            new = {w for words in cut for w in words}
        if new:
            self.learn(list(new))
        get = self.cache.__getitem__
        out = [np.frombuffer(b"".join(map(get, words)), np.int32) for words in cut]
        if not self.model.bytes_:  # neighbouring unknown pieces are one
            unknown = self.model.unknown
            out = [a[(a != unknown) | np.concatenate([[True], a[:-1] != unknown])] if len(a) else a for a in out]
        return out


def _pack(ids) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


def _points(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).astype(np.uint64)


def piece_bytes(model: Model) -> list[bytes]:
    """What each piece id reads as."""
    return [
        b"" if k == 3 else bytes([int(p[3:5], 16)]) if k == 6 else " ⁇ ".encode() if k == 2 else p.replace(SPACE, " ").encode()
        for p, k in zip(model.pieces, model.kinds, strict=True)
    ]


_ready: list = [None, None]


def _of(tables) -> Encoder:
    """The encoder of a broadcast model, built once per worker process."""
    if _ready[0] is not tables:
        _ready[:] = [tables, Encoder(tables.value)]
    return _ready[1]


def _groups(texts: list[str | None], most: int):
    """Slices of a batch of about ``most`` characters."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode(docs: DataFrame, model: Model, text: str = "text", column: str = "piece_ids", most: int = 4_000_000) -> tuple[DataFrame, str]:
    """``docs`` with the piece ids of each text as ``array<int>`` in one more column, and its name.

    Null and empty texts have no pieces. Rows, also repeated ones, and other columns stay as they are; underscores go
    in front of the name if it is taken. A text is handled whole, about ``most`` characters of texts at a time.
    """
    name = free_name(docs, column)
    place = docs.columns.index(text)
    tables = docs.sparkSession.sparkContext.broadcast(model)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _of(tables)
        texts = batch.column(place).cast(pa.string()).to_pylist()
        parts = [p for a, b in _groups(texts, most) for p in encoder.encode(texts[a:b])]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, name])

    return map_batches(docs, fn, f"{docs._jdf.schema().toDDL()}, `{name}` array<int>"), name


def decode(rows: DataFrame, model: Model, ids: str = "piece_ids", column: str = "decoded") -> tuple[DataFrame, str]:
    """``rows`` with the text of the piece ids in one more column, and its name.

    Null and empty arrays give the empty text; ids that the model does not have, and nulls, read as the unknown piece,
    bytes that are no UTF-8 as U+FFFD. A literal U+2581 in a text comes back as a space: the model writes both alike.
    """
    name = free_name(rows, column)
    # Bytes as hex digits, since pieces of the byte kind are no text by themselves; one constant, folded once.
    parts = F.split(F.lit(",".join(p.hex() for p in piece_bytes(model))), ",")
    unknown = F.lit(piece_bytes(model)[model.unknown].hex())
    read = F.transform(F.coalesce(F.col(ids), F.array().cast("array<int>")), lambda i: F.coalesce(F.get(parts, i), unknown))
    text = F.make_valid_utf8(F.unhex(F.array_join(read, "")).cast("string"))
    if model.prefix:
        text = F.when(text.startswith(" "), F.substr(text, F.lit(2))).otherwise(text)
    return rows.withColumn(name, text), name
