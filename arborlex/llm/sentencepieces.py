"""Operator 3: sampled SentencePiece encoding by forward filtering and backward sampling, and
lossless decoding.

The vocabulary is that of a public model file (its path is a parameter).  The lattice of a text
has an edge for each vocabulary piece that matches at a place, and byte edges for characters that
are no piece themselves.  A text gets one blank in front, and a piece's mark of a word's beginning
stands for the blank; a literal U+2581 in a text therefore goes to byte pieces and survives.
Decoding joins the bytes of the pieces and takes the first blank off, which gives every text back.

Weights.  The log weight of a piece is ``-theta * log(rank + 1)``, since the scores of a merge-based model
are only ranks; a byte edge has the weight of the last rank.  Forward filtering sums the weights of all
segmentations up to each place, within each unit (blanks and the word after them: no piece
goes over a unit's end, which ``Vocabulary`` checks).  Backward sampling walks from a unit's end, taking
each edge with its share of the sum, so a segmentation comes with exactly its share of the lattice's
weight.  Each draw depends on the seed, the row key and the byte position only: any number of
partitions, retries and batch sizes give the same pieces.

Numpy does the work for a slice of texts at once: equal units share their lattice (kept by a task
for its later slices, up to a fixed size), and all occurrences are walked together.

Edge cases.  Null and empty texts have no pieces and decode to the empty text.  A null row key
counts as 0.  Repeated rows get equal pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, byte_slices, mix64, word_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA, SEED = 1.5, 3
MARK = "▁"
# Bytes of the texts that a task encodes at once, and places of the lattices that it keeps: what bounds its memory.
SLICE, KEPT_PLACES = 1 << 19, 1_000_000


class Vocabulary:
    """Arrays of a vocabulary: a trie over piece bytes as an open hash table, and log weights.

    The size is bounded by the vocabulary, so it may be broadcast.
    """

    def __init__(self, pieces: dict[int, bytes], byte_ids: np.ndarray, theta: float = THETA):
        for p in pieces.values():
            if b" " in p.lstrip(b" "):
                raise ValueError("a piece goes over a word's end")
        n = max([*pieces, *byte_ids.tolist()]) + 1
        self.byte_ids = byte_ids.astype(np.int32)
        self.longest = max(map(len, pieces.values()), default=1)
        ranks = {i: r for r, i in enumerate(sorted(pieces))}
        self.weight = np.full(n, -theta * np.log(len(pieces) + 1.0))
        for i, r in ranks.items():
            self.weight[i] = -theta * np.log(r + 1.0)
        texts = dict(pieces) | {int(i): bytes([b]) for b, i in enumerate(byte_ids)}
        self.length = np.zeros(n, np.int64)
        for i, p in texts.items():
            self.length[i] = len(p)
        self.begin = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.joined = np.frombuffer(b"".join(texts.get(i, b"") for i in range(n)), np.uint8)
        self._trie(pieces)
        self.single = {p for p in pieces.values() if len(p.decode()) == 1}

    def _trie(self, pieces: dict[int, bytes]) -> None:
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i, p in pieces.items():
            at = 0
            for b in p:
                at = edges.setdefault((at, b), len(ends))
                if at == len(ends):
                    ends.append(-1)
            ends[at] = i
        self.ends = np.array(ends, np.int32)
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.key, self.next = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        for (at, b), to in edges.items():
            k = at * 256 + b
            slot = self._slot(np.array([k]))[0]
            while self.key[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.key[slot], self.next[slot] = k, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie's next states, -1 where there is none."""
        key = state.astype(np.int64) * 256 + byte
        slot, out = self._slot(key), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.key[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.next[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def edges(self, b: np.ndarray, unit_end: np.ndarray):
        """(start, end, piece) of every edge; ``unit_end`` has, for each byte, where its unit ends."""
        lead = (b & 0xC0) != 0x80
        at = np.flatnonzero(lead).astype(np.int32)
        width = np.diff(np.append(at, len(b))).astype(np.int32)
        start, end, piece = [], [], []
        pos, state, origin = at, np.zeros(len(at), np.int32), np.arange(len(at), dtype=np.int32)
        whole = np.zeros(len(at), bool)
        for step in range(1, self.longest + 1):
            state = self.child(state, b[pos])
            live = state >= 0
            pos, state, origin = pos[live] + 1, state[live], origin[live]
            found = self.ends[state]
            hit = found >= 0
            start.append(at[origin[hit]])
            end.append(pos[hit])
            piece.append(found[hit])
            whole[origin[hit][width[origin[hit]] == step]] = True
            more = pos < unit_end[at[origin]]
            pos, state, origin = pos[more], state[more], origin[more]
            if not len(pos):
                break
        spelled = np.flatnonzero(np.repeat(~whole, width)).astype(np.int32)  # bytes of characters that are no piece
        start.append(spelled)
        end.append(spelled + 1)
        piece.append(self.byte_ids[b[spelled]])
        return np.concatenate(start), np.concatenate(end), np.concatenate(piece)


def load_vocabulary(path: str = MODEL, theta: float = THETA) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, np.zeros(256, np.int32)
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[i] = model.id_to_piece(i).replace(MARK, " ").encode()
    return Vocabulary(pieces, byte_ids, theta)


def _units(b: np.ndarray, doc_begin: np.ndarray) -> np.ndarray:
    """Starts of units: a blank after anything else, and the first byte of each text."""
    blank = b == 32
    begins = blank & ~np.concatenate([[False], blank[:-1]])
    begins[doc_begin] = True
    return np.flatnonzero(begins)


def _by_depth_and_end(depth: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The order by depth, then end: stable counting passes over 16 bits at a time."""
    order = np.argsort((end & 0xFFFF).astype(np.uint16), kind="stable")
    for digits in (end >> 16, depth & 0xFFFF, depth >> 16):
        if digits.any():
            order = order[np.argsort(digits[order].astype(np.uint16), kind="stable")]
    return order


def _lattice(vocabulary: Vocabulary, b: np.ndarray, first: np.ndarray):
    """Forward sums over distinct units laid end to end; ``first`` has their starts.

    Returns the edges ordered by their end, with each edge's running share among the edges that
    end there, and where the edges of each end begin.
    """
    first = first.astype(np.int32)
    last = np.append(first[1:], len(b)).astype(np.int32)
    unit_end = np.repeat(last, last - first)
    start, end, piece = vocabulary.edges(b, unit_end)
    unit_begin = np.repeat(first, last - first)
    depth = end - unit_begin[end - 1]
    order = _by_depth_and_end(depth, end)
    start, end, piece, depth = start[order], end[order], piece[order], depth[order]
    weight = vocabulary.weight[piece]
    # places are counted with their unit's number, so that a unit's first place is its own
    unit_of = np.cumsum(np.bincount(first, minlength=len(b))) - 1
    total = np.zeros(len(b) + len(first))  # log sums; a unit's first place has log weight 0
    source = start + unit_of[start]
    target = end + unit_of[end - 1]
    share = np.zeros(len(start))
    cut = np.flatnonzero(np.diff(np.concatenate([[-1], depth])))
    for lo, hi in zip(cut, np.append(cut[1:], len(depth)), strict=True):
        value = total[source[lo:hi]] + weight[lo:hi]
        group = np.flatnonzero(np.diff(np.concatenate([[-1], target[lo:hi]])))
        size = np.diff(np.append(group, hi - lo))
        top = np.repeat(np.maximum.reduceat(value, group), size)
        total[target[lo:hi][group]] = top[group] + np.log(np.add.reduceat(np.exp(value - top), group))
        share[lo:hi] = value
    # running shares are summed edge by edge within each end, so that they don't depend on other units
    share = np.exp(share - total[target])
    first_edge = np.zeros(len(b) + len(first), np.int64)
    group = np.flatnonzero(np.diff(np.concatenate([[-1], target])))
    first_edge[target[group]] = group
    last_edge = np.append(group[1:], len(target)) - 1
    at, stop = group, last_edge
    while len(at):
        more = at < stop
        at, stop = at[more] + 1, stop[more]
        share[at] += share[at - 1]
    share[last_edge] = 1.0  # the last edge takes what rounding leaves
    return source, piece, share, first_edge


class Lattices:
    """Lattices of the distinct units met so far in a process, laid end to end; begun anew when
    they hold ``most`` places.  They only save work: a unit's lattice is the same whenever it is made."""

    def __init__(self, vocabulary: Vocabulary, most: int = KEPT_PLACES):
        self.vocabulary, self.most = vocabulary, most
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.homes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.source, self.piece, self.share = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)
        self.first_edge, self.places, self.edges = np.zeros(0, np.int64), 0, 0

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        old = getattr(self, name)
        if len(old) < at + len(values):
            grown = np.zeros(2 * (at + len(values)), old.dtype)
            grown[:at] = old[:at]
            setattr(self, name, grown)
        getattr(self, name)[at:at + len(values)] = values

    def homes_of(self, hashes: np.ndarray, b: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """First places of the units (sorted distinct hashes), whose bytes stand at begin, length in ``b``."""
        if self.places > self.most:
            self._clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        if new.any():
            size = length[new]
            first = np.concatenate([[0], np.cumsum(size)])[:-1]
            units = b[np.repeat(begin[new] - first, size) + np.arange(size.sum())]
            source, piece, share, first_edge = _lattice(self.vocabulary, units, first)
            homes = first + np.arange(len(first)) + self.places
            self._put("source", self.edges, source + self.places)
            self._put("piece", self.edges, piece)
            self._put("share", self.edges, share)
            self._put("first_edge", self.places, first_edge + self.edges)
            self.places += len(first_edge)
            self.edges += len(source)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.homes = np.insert(self.homes, at[new], homes)
            at = np.searchsorted(self.hashes, hashes)
        return self.homes[at]


def encode_texts(lattices: Lattices, texts: list[bytes], keys: np.ndarray, seed: int = SEED):
    """Sampled pieces of the texts: (counts per text, ids of all texts end to end)."""
    filled = [b" " + t if t else b"" for t in texts]
    size = np.array([len(t) for t in filled])
    begin = np.concatenate([[0], np.cumsum(size)])
    b = np.frombuffer(b"".join(filled), np.uint8)
    if not len(b):
        return np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
    unit = _units(b, begin[:-1][size > 0])
    length = np.append(unit[1:], len(b)) - unit
    hashes, example, which = np.unique(word_hashes(b, unit, unit + length), return_index=True, return_inverse=True)
    home = lattices.homes_of(hashes, b, unit[example], length[example])[which]
    source, piece, share, first_edge = lattices.source, lattices.piece, lattices.share, lattices.first_edge
    # walk all occurrences back from their ends at once
    doc = np.repeat(np.arange(len(texts)), size)[unit]
    row = mix64(keys.astype(np.uint64)[doc] + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    base = begin[doc]
    shift = unit - base - home  # place in the text less place in the lattices
    place = home + length
    ids = np.full(len(b), -1, np.int32)
    while len(place):
        draw = mix64(row ^ ((place + shift).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        u = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = first_edge[place]
        todo = np.flatnonzero(u >= share[edge])
        while len(todo):
            edge[todo] += 1
            todo = todo[u[todo] >= share[edge[todo]]]
        place = source[edge]
        ids[base + place + shift] = piece[edge]
        left = place > home
        if not left.all():
            place, home, shift, row, base = place[left], home[left], shift[left], row[left], base[left]
    used = ids >= 0
    counts = np.diff(np.concatenate([[0], np.cumsum(used)])[begin])
    return counts, ids[used]


def decode_ids(vocabulary: Vocabulary, counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The texts of pieces laid end to end."""
    length = vocabulary.length[ids]
    stop = np.cumsum(length)
    b = vocabulary.joined[np.repeat(vocabulary.begin[ids] - (stop - length), length) + np.arange(length.sum())].tobytes()
    edge = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts)])]
    return [b[lo + 1:hi] if hi > lo else b"" for lo, hi in zip(edge[:-1], edge[1:], strict=True)]


def _bytes(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """(doc_id, n_pieces, n_bytes, ids, decoded_sha256) of every row of ``docs``.

    ``n_bytes`` counts byte pieces; ``decoded_sha256`` is the digest of the text that decoding the
    pieces gives.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())

    def run(batches):
        v = vocabulary.value
        is_byte = np.zeros(len(v.length), bool)
        is_byte[v.byte_ids] = True
        lattices = Lattices(v)
        for batch in batches:
            keys, texts = np.array([x or 0 for x in batch.column(0).to_pylist()], np.int64), _bytes(batch.column(1))
            for lo, hi in byte_slices(texts, SLICE):
                counts, ids = encode_texts(lattices, texts[lo:hi], keys[lo:hi].view(np.uint64), seed)
                stops = np.concatenate([[0], np.cumsum(counts)])
                spelled = np.concatenate([[0], np.cumsum(is_byte[ids])])[stops]
                digests = [hashlib.sha256(t).hexdigest() for t in decode_ids(v, counts, ids)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[lo:hi], pa.array(counts.astype(np.int64)), pa.array(np.diff(spelled).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids)), pa.array(digests)],
                    names=["doc_id", "n_pieces", "n_bytes", "ids", "decoded_sha256"])

    return bounded(docs).select(F.col(key).cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_pieces bigint, n_bytes bigint, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; null ids give the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())

    def run(batches):
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            counts = np.array([len(x) for x in lists], np.int64)
            texts = decode_ids(vocabulary.value, counts, np.concatenate([np.zeros(0, np.int64), *lists]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode() for t in texts])], names=["doc_id", "text"])

    return bounded(encoded).select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, "doc_id bigint, text string")
