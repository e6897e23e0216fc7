"""SentencePiece encoding and decoding with seeded merge-dropout.

A public vocabulary of merge type is applied as its library applies it: the best-scored adjacent
pair is merged until none is left. With dropout, each candidate merge that comes up is skipped if a
keyed hash of it says so. The key is of the text and the word's place in it, so each occurrence of a word
is drawn anew. Segmentations vary with the seed, and all of them decode to the text.

What is remembered is no cut but the tree of a word's decisions: the candidate that comes up, and
the one after it if it is merged or skipped. Occurrences walk down the trees of their words together.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, map_arrow, others, remembered, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 17
SPACE = "▁"
# Decisions that a Python worker remembers, about 30 bytes each with their words; words that walk together;
# characters of text in one batch, each of which takes some 100 bytes while it is cut.
REMEMBERED = 2_000_000
TOGETHER = 1 << 18
SLICE = 500_000
_MASK = (1 << 64) - 1
# Longest chunk that is merged together with others of its length, and the rank of no piece.
WORD, _NONE = 32, 1 << 30
_STIR = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their ids and scores; ids of single bytes; text of each id."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    pieces: list[str | None]

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, ids, byte_ids, pieces = {}, {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                pieces.append(None)
            elif model.is_control(i) or model.is_unknown(i):
                pieces.append("")
            else:
                scores[piece], ids[piece] = model.get_score(i), i
                pieces.append(piece)
        if not all(byte_ids):
            raise ValueError("the vocabulary has no byte pieces; text would be lost")
        if any(SPACE in p.lstrip(SPACE) for p in scores):
            raise ValueError("the vocabulary has pieces that run over a word's end")
        return cls(scores, ids, byte_ids, pieces)


def _chunk_pattern(vocabulary: Vocabulary) -> str:
    """Cuts a text only where no piece runs over the cut, so that chunks can be merged by themselves.

    Pieces do not run over a word's end. White space that is in no piece stands alone, and a text is
    cut after a letter that another sign follows, but for letters that some piece has before a sign.
    """
    letter = re.compile(r"[^\W\d_]")
    pairs = {pair for p in vocabulary.scores for pair in zip(p, p[1:])}
    signs: set[str] = set()
    while more := {a for a, b in pairs if letter.match(a) and a not in signs and (not letter.match(b) or b in signs)}:
        signs |= more
    used = set().union(*vocabulary.scores)
    gaps = re.escape("".join(c for c in "\n\t\r\v\f" if c not in used))
    odd = re.escape("".join(sorted(signs)))
    sign = f"(?:(?![{SPACE}{gaps}])[\\W\\d_{odd}])"
    return f"{SPACE}*{sign}*[^\\W\\d_{odd}]+|{SPACE}*{sign}+|{SPACE}+" + (f"|[{gaps}]" if gaps else "")


def _skipped(keys: np.ndarray, left, middle, stop, limit: int) -> np.ndarray:
    """Whether a candidate is skipped: its word's key, stirred with its three places."""
    with np.errstate(over="ignore"):
        x = keys.copy()
        for place, factor in zip((left, middle, stop), _STIR):
            x ^= np.asarray(place).astype(np.uint64) * np.uint64(factor)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x < np.uint64(min(limit, _MASK)) if limit <= _MASK else np.ones(len(x), bool)


def _with_room(rows: np.ndarray, size: int, fill: int) -> np.ndarray:
    """The array itself, or a copy that is longer by quarters until ``size`` rows fit."""
    room = len(rows)
    while room < size:
        room += room // 4
    if room == len(rows):
        return rows
    out = np.full((room, *rows.shape[1:]), fill, rows.dtype)
    out[: len(rows)] = rows
    return out


class _Trees:
    """The decisions met so far: a tree for each word, its results in the leaves."""

    NEW, LEAF = -2, -1

    def __init__(self):
        self.roots: dict[str, int] = {}
        self.size, self.used = 0, 0
        # Three places of a node's candidate, all below WORD + 1; a leaf has LEAF.
        self.places = np.full((1 << 14, 3), self.NEW, np.int8)
        # The node if merged and the one if skipped; of a leaf, where its ids begin and how many they are.
        self.following = np.full((1 << 14, 2), -1, np.int32)
        self.ids = np.zeros(1 << 14, np.int32)

    def _add(self, count: int) -> np.ndarray:
        self.size += count
        self.places = _with_room(self.places, self.size, self.NEW)
        self.following = _with_room(self.following, self.size, -1)
        return np.arange(self.size - count, self.size)

    def root(self, words: list[str]) -> np.ndarray:
        """Roots of different words; made where there are none."""
        new = [w for w in words if w not in self.roots]
        self.roots.update(zip(new, self._add(len(new)).tolist()))
        return np.fromiter(map(self.roots.__getitem__, words), np.int64, len(words))

    def step(self, nodes: np.ndarray, places: tuple, skipped: np.ndarray) -> np.ndarray:
        """Sets the candidates of nodes; gives the nodes that follow, made where there are none."""
        for k, place in enumerate(places):
            self.places[nodes, k] = place
        slots = nodes * 2 + skipped
        new = np.unique(slots[self.following.reshape(-1)[slots] < 0])
        made = self._add(len(new))
        self.following.reshape(-1)[new] = made
        return self.following.reshape(-1)[slots].astype(np.int64)

    def end(self, nodes: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> None:
        """Makes leaves of nodes: of each, the ids up to its end in ``flat``."""
        begins = np.concatenate([[0], ends[:-1]])
        nodes, first = np.unique(nodes, return_index=True)
        first = first[self.places[nodes, 0] == self.NEW]
        new = nodes[self.places[nodes, 0] == self.NEW]
        counts = (ends - begins)[first]
        picked = flat[_ranges(begins[first], counts)]
        self.ids = _with_room(self.ids, self.used + len(picked), 0)
        self.ids[self.used : self.used + len(picked)] = picked
        self.places[new, 0] = self.LEAF
        self.following[new] = np.stack([self.used + np.cumsum(counts) - counts, counts], axis=1)
        self.used += len(picked)

    def walk(self, nodes: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """The leaf that each key leads to from a node; -1 where the way is not known yet."""
        out = nodes.copy()
        rows = np.flatnonzero(nodes >= 0)
        while len(rows):
            at = out[rows]
            left, middle, stop = self.places[at].T
            inner = left >= 0
            rows, at, left, middle, stop = rows[inner], at[inner], left[inner], middle[inner], stop[inner]
            if limit:
                skipped = _skipped(keys[rows], left, middle, stop, limit)
            else:
                skipped = np.zeros(len(rows), bool)
            out[rows] = self.following.reshape(-1)[at * 2 + skipped]
            rows = rows[out[rows] >= 0]
        return out


def _numbered(chunks: list[str]) -> tuple[list[str], np.ndarray]:
    """The different chunks, and the number of each chunk among them."""
    try:
        found = pa.array(chunks, pa.string()).dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
    except UnicodeEncodeError:  # half of a surrogate pair
        numbers: dict[str, int] = {}
        own = [numbers.setdefault(c, len(numbers)) for c in chunks]
        return list(numbers), np.array(own, np.int64)


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of ranges, one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - counts), counts)


class Codec:
    """Encodes and decodes texts; remembers decisions about words."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.vocabulary, self.seed = vocabulary, seed
        self.limit = int(dropout * 2**64)
        self._spellings(vocabulary)
        best_first = sorted(set(vocabulary.scores.values()), reverse=True)
        rank = {score: r for r, score in enumerate(best_first)}
        self.ranks = {piece: rank[score] for piece, score in vocabulary.scores.items()}
        self._tables(vocabulary)
        self.trees = _Trees()
        self.chunks = re.compile(_chunk_pattern(vocabulary))

    def _spellings(self, vocabulary: Vocabulary) -> None:
        """UTF-8 of each id, also one after the other with begins and lengths."""
        byte_of = {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        self.spelled = [
            byte_of[i] if piece is None else piece.replace(SPACE, " ").encode("utf-8")
            for i, piece in enumerate(vocabulary.pieces)
        ]
        self.lengths = np.array([len(s) for s in self.spelled], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(self.spelled), np.uint8)

    def _tables(self, vocabulary: Vocabulary) -> None:
        """Id of each character, and rank and id of what two pieces make, sorted by the pair."""
        self.char_ids = np.full(0x110000, -1, np.int32)
        pairs: dict[int, tuple[int, int]] = {}
        ids, self.size = vocabulary.ids, len(vocabulary.pieces)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (self.ranks[piece], i)
        self.pair_keys = np.array(sorted(pairs), np.int64)
        made = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64).reshape(-1, 2)
        self.pair_ranks, self.pair_ids = made[:, 0].astype(np.int32), made[:, 1].astype(np.int32)

    def encode(self, text: str, variant: int = 0) -> list[int]:
        """Ids of a text. An empty text has none."""
        return self.encode_all([text], [variant])[0]

    def encode_all(self, texts: list[str], variants: list[int]) -> list[list[int]]:
        """Ids of each text."""
        flat, counts = self.encode_flat(texts, variants)
        ends = np.cumsum(counts).tolist()
        return [flat[b:e].tolist() for b, e in zip([0, *ends], ends)]

    def encode_flat(self, texts: list[str], variants: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has.

        Each word by the key of its text, variant and place. Words are cut together.
        """
        chunked = [self._chunks(t) for t in texts]
        counts = np.array([len(c) for c in chunked], np.int64)
        own = [self._key(t, v) if self.limit else 0 for t, v in zip(texts, variants)]
        keys = np.repeat(np.array(own, np.uint64), counts)
        keys += _ranges(np.zeros(len(counts), np.int64), counts).astype(np.uint64) * np.uint64(_STIR[0])
        keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(27)
        flat, sizes = self._cut_each(list(chain.from_iterable(chunked)), keys)
        return flat, np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])])

    def lossless(self, flat: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether each text's ids decode to it; the bytes of all ids are put together at once."""
        lengths = self.lengths[flat]
        data = self.letters[_ranges(self.begins[flat], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)].tolist()
        # The first byte is the space that every text begins with.
        return [
            data[b + 1 : e] == text.encode("utf-8", "surrogatepass")
            for b, e, text in zip([0, *ends], ends, texts)
        ]

    def _chunks(self, text: str) -> list[str]:
        """What is cut by itself. A space sign of the text's own is a chunk without a space: ``""``."""
        if not text:
            return []
        if SPACE not in text:
            return self.chunks.findall(SPACE + text.replace(" ", SPACE))
        out: list[str] = []
        for i, part in enumerate(text.split(SPACE)):
            if i:
                out.append("")
            out += self.chunks.findall((SPACE if not i else "") + part.replace(" ", SPACE))
        return out

    def _cut_each(self, chunks: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and how many each has; ``keys``: one of each."""
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for start in range(0, len(chunks), TOGETHER):
            if self.trees.size > REMEMBERED:
                self.trees = _Trees()
            found = self._cut_some(chunks[start : start + TOGETHER], keys[start : start + TOGETHER])
            for held, part in zip((flat, sizes), found):
                held.append(part)
        return np.concatenate(flat), np.concatenate(sizes)

    def _cut_some(self, chunks: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        trees = self.trees
        nodes = np.fromiter(map(trees.roots.get, chunks, repeat(-1)), np.int64, len(chunks))
        nodes = trees.walk(nodes, keys, self.limit)
        alone: dict[int, list[int]] = {}
        new = np.flatnonzero(nodes < 0)
        words, number = _numbered([chunks[i] for i in new.tolist()])
        lengths = np.fromiter(map(len, words), np.int64, len(words))[number]
        for n in np.unique(lengths).tolist():
            same = lengths == n
            places = new[same]
            if not 0 < n <= WORD:
                for i in places.tolist():
                    alone[i] = self._merged(chunks[i], keys[i]) if n else self._bytes(SPACE)
                continue
            own, which = np.unique(number[same], return_inverse=True)
            spelled = [words[j] for j in own.tolist()]
            points = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), np.uint32)
            symbols = self.char_ids[points].reshape(-1, n)
            plain = (symbols >= 0).all(axis=1)
            for i in places[~plain[which]].tolist():
                alone[i] = self._merged(chunks[i], keys[i])
            if plain.any():
                roots = np.full(len(own), -1)
                roots[plain] = trees.root([w for w, p in zip(spelled, plain.tolist()) if p])
                some = plain[which]
                at, which = places[some], which[some]
                nodes[at] = self._merge(symbols, which, roots[which], keys[at])
        known = nodes >= 0
        begins, sizes = trees.following[nodes].astype(np.int64).T
        sizes = np.where(known, sizes, 0)
        if not alone:
            return trees.ids[_ranges(begins, sizes)], sizes
        # Those cut alone go in between.
        more = sorted(alone)
        lengths = np.array([len(alone[i]) for i in more], np.int64)
        extra = np.fromiter(chain.from_iterable(alone[i] for i in more), np.int32, int(lengths.sum()))
        at = np.repeat(np.cumsum(sizes)[more], lengths)
        flat = np.insert(trees.ids[_ranges(begins, sizes)], at, extra)
        sizes[more] = lengths
        return flat, sizes

    def _cut_all(self, chunks: list[str], variant: int) -> dict[str, tuple[int, ...]]:
        keys = np.array([self._key(c, variant) for c in chunks], np.uint64)
        flat, sizes = self._cut_each(chunks, keys)
        ends = np.cumsum(sizes).tolist()
        return {c: tuple(flat[b:e].tolist()) for c, b, e in zip(chunks, [0, *ends], ends)}

    def _key(self, text: str, variant: int) -> int:
        seed = (self.seed << 8 | variant) & _MASK
        return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what each two pieces make."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], _NONE).astype(np.int32), self.pair_ids[at]

    def _merge(self, spelled: np.ndarray, which: np.ndarray, nodes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Merges of many words of one length at once: in each round every word's best pair.

        ``which``: the spelling of each word. From the roots of the words' trees to their leaves.
        """
        count, n = len(which), spelled.shape[1]
        symbols, alive = spelled[which], np.ones((count, n), bool)
        after = np.tile(np.arange(1, n + 1), (count, 1))
        before = np.tile(np.arange(-1, n - 1), (count, 1))
        ranks, made = np.full((count, n), _NONE, np.int32), np.zeros((count, n), np.int32)
        if n > 1:
            for held, found in zip((ranks, made), self._pairs(spelled[:, :-1], spelled[:, 1:])):
                held[:, :-1] = found[which]
        nodes, rows = nodes.copy(), np.arange(count)
        while len(rows):
            left = ranks[rows].argmin(axis=1)
            going = ranks[rows, left] < _NONE
            rows, left = rows[going], left[going]
            if not len(rows):
                break
            middle = after[rows, left]
            stop = after[rows, middle]
            merged = np.ones(len(rows), bool)
            if self.limit:
                merged = ~_skipped(keys[rows], left, middle, stop, self.limit)
                ranks[rows[~merged], left[~merged]] = _NONE
            nodes[rows] = self.trees.step(nodes[rows], (left, middle, stop), ~merged)
            r, a, m, s = rows[merged], left[merged], middle[merged], stop[merged]
            symbols[r, a] = made[r, a]
            after[r, a] = s
            alive[r, m] = False
            ranks[r, m] = _NONE
            ranks[r, a] = _NONE
            more = s < n
            r2, a2, s2 = r[more], a[more], s[more]
            before[r2, s2] = a2
            ranks[r2, a2], made[r2, a2] = self._pairs(symbols[r2, a2], symbols[r2, s2])
            first = before[r, a]
            some = first >= 0
            r3, a3, f3 = r[some], a[some], first[some]
            ranks[r3, f3], made[r3, f3] = self._pairs(symbols[r3, f3], symbols[r3, a3])
        self.trees.end(nodes, symbols[alive], np.cumsum(alive.sum(axis=1)))
        return nodes

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Spaces come from pieces only; bytes are text as they are."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def _bytes(self, text: str) -> list[int]:
        return [self.vocabulary.byte_ids[b] for b in text.encode("utf-8")]

    def _cut(self, chunk: str, variant: int) -> tuple[int, ...]:
        return tuple(self._merged(chunk, self._key(chunk, variant)) if chunk else self._bytes(SPACE))

    def _merged(self, chunk: str, key: int) -> list[int]:
        """Merges adjacent symbols, best score first and then from the left, and skips some."""
        get, n, limit = self.ranks.get, len(chunk), self.limit
        end = list(range(1, n + 1))  # of the symbol that begins here
        before = list(range(-1, n - 1))  # where the symbol before begins
        agenda = [
            (rank, i, i + 1, i + 2)
            for i in range(n - 1)
            if (rank := get(chunk[i : i + 2])) is not None
        ]
        heapq.heapify(agenda)
        word = np.array([key], np.uint64)
        while agenda:
            _, left, middle, stop = heapq.heappop(agenda)
            if end[left] != middle or before[middle] != left or end[middle] != stop:
                continue  # one of the two has been merged otherwise
            if limit and _skipped(word, left, middle, stop, limit)[0]:
                continue
            end[left] = stop
            before[middle] = -2
            if stop < n:
                before[stop] = left
                rank = get(chunk[left : end[stop]])
                if rank is not None:
                    heapq.heappush(agenda, (rank, left, stop, end[stop]))
            first = before[left]
            if first >= 0:
                rank = get(chunk[first:stop])
                if rank is not None:
                    heapq.heappush(agenda, (rank, first, left, stop))
        ids, out, at = self.vocabulary.ids, [], 0
        while at < n:
            piece = chunk[at : end[at]]
            found = ids.get(piece)
            if found is None:
                out += self._bytes(piece)
            else:
                out.append(found)
            at = end[at]
        return out


@any_names
def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", dropout: float = DROPOUT,
    seed: int = SEED, keep_text: bool = True,
) -> DataFrame:
    """All rows of ``docs`` with ``ids``, ``n_tokens`` and ``lossless``; ``text`` if it is kept.

    ``lossless``: the ids were decoded again and gave the text. Skips follow from a hash of the text and the
    word's place in it, so equal texts get equal ids, in every run and however rows are partitioned. NULL gives
    NULL ids, 0 tokens and lossless; an empty text gives no ids; an empty table an empty one. Columns named like
    the new ones are replaced. Whole texts are encoded.
    """
    made = StructType(
        [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", IntegerType()),
         StructField("lossless", BooleanType())]
    )
    inputs = [q(text).alias("_text")]
    # Another call begins with no memory, so that a measured run does not profit from one before it.
    call = uuid.uuid4().hex
    run = _encoder(vocabulary, dropout, seed, call)
    dropped = made.names if keep_text else [*made.names, text]
    return map_arrow(docs, others(docs, dropped), inputs, run, made, call)


def _encoder(vocabulary: Vocabulary, dropout: float, seed: int, call: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One codec per worker and call. What it remembers changes no result, so a lost worker loses time only.
        codec = remembered(call, lambda: Codec(vocabulary, dropout, seed))
        for batch in batches:
            texts = batch["_text"]
            start, size, held = 0, 0, []
            for i in range(batch.num_rows):
                held.append(texts[i].as_py() or "")
                size += len(held[-1])
                if size >= SLICE or i + 1 == batch.num_rows:
                    flat, counts = codec.encode_flat(held, [0] * len(held))
                    same = codec.lossless(flat, counts, held)
                    missing = pa.array(np.asarray(texts[start : i + 1].is_null()))
                    yield _encoded(batch["_row"][start : i + 1], flat, counts, same, missing)
                    start, size, held = i + 1, 0, []

    return run


def _encoded(
    rows: pa.Array, flat: np.ndarray, counts: np.ndarray, same: list[bool], missing: pa.Array
) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=missing)
    return pa.record_batch(
        [rows, lists, pa.array(counts, pa.int32()), pa.array(same)], names=["_row", "ids", "n_tokens", "lossless"]
    )


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text") -> DataFrame:
    """All rows with ``text``, the text of ``ids``; NULL for NULL. Other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch["_ids"].to_pylist()]
            yield pa.record_batch([batch["_row"], pa.array(texts, pa.string())], names=["_row", text])

    return map_arrow(
        rows, others(rows, [text]), [q(ids).alias("_ids")], run, StructType().add(text, "string")
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, Vocabulary.load(), keep_text=False)
