"""Encoding texts into pieces as shortest paths of a weighted transducer, and back.

A model file's pieces are compiled into one transducer over characters: the normaliser (a space in
front of the text, spaces as the pieces' space mark), an arc chain per piece that ends in the start
state, and for every character a chain of byte pieces. Composed with a text this gives a lattice, and
its shortest path in the tropical semiring, the least sum of weights, is the encoding. As no piece has
a space behind another character, paths meet before every run of spaces, and texts are encoded between
these places, each distinct stretch once.

The public models here are ranked by merges and have no probabilities; a piece's weight is that of
its rank by Zipf's law. Byte pieces weigh more than any piece, so that they stand in only for what has
no other path.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches, with_arrow_columns
from turnweave.llm.words import EXACT, _hashes, flat, lists, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BYTE_WEIGHT = 40.0
#: Encodings of short stretches that a worker keeps, up to twice as many.
KEPT, KEPT_BYTES = 60_000, 32
#: Stretches whose paths are looked for together, if they are short; the others go one by one.
TOGETHER, TOGETHER_BYTES = 4096, 128
#: Bits of a character in the key of an arc.
CHARACTER_BITS = 21
#: Rows decoded before they are passed on.
DECODED_ROWS = 512

ADDED = T.StructType([T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())])


class Transducer:
    """Pieces and bytes of a model as a transducer from characters to numbers.

    A state is a list of the arcs by character, and the weight and number with which a piece ends
    there and leads back to the start, or infinity.
    """

    def __init__(self, pieces: Iterable[tuple[int, str, float]], bytes_: dict[int, int]):
        """``pieces``: number, characters and weight; ``bytes_``: numbers of the byte pieces."""
        self.start: dict = {}
        self.longest = 1
        self.bytes = bytes_
        self.spelled: dict[int, bytes] = {number: bytes([value]) for value, number in bytes_.items()}
        for number, piece, weight in pieces:
            arcs, state = self.start, None
            for character in piece:
                state = arcs.setdefault(character, [{}, math.inf, -1])
                arcs = state[0]
            if state and (weight, number) < (state[1], state[2]):
                state[1], state[2] = weight, number
            self.longest = max(self.longest, len(piece))
            self.spelled[number] = piece.encode()
        self.byte_numbers = np.array([bytes_.get(b, -1) for b in range(256)], np.int32)
        self._flatten()
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _flatten(self) -> None:
        """The same arcs as sorted arrays: key of state and character, next state; and each state's end."""
        arcs, ends, todo = [], [(math.inf, -1)], [(0, self.start)]
        while todo:
            state, here = todo.pop()
            for character, (further, weight, number) in here.items():
                arcs.append((state << CHARACTER_BITS | ord(character), len(ends)))
                todo.append((len(ends), further))
                ends.append((weight, number))
        arcs.sort()
        # The last key is beyond all others.
        self.keys = np.array([key for key, _ in arcs] + [1 << 62], np.int64)
        self.next = np.array([state for _, state in arcs] + [0], np.int32)
        self.weights = np.array([weight for weight, _ in ends])
        self.numbers = np.array([number for _, number in ends], np.int32)

    def lattice(self, characters: np.ndarray, first: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Composition with many stretches at once: arcs as start, length, weight and number, by place of start.

        All places walk the transducer together, a character a step, until none is left.
        """
        place, state, found, step = np.arange(len(characters)), np.zeros(len(characters), np.int64), [], 0
        while len(place):
            inside = place + step < first[owner[place] + 1]
            place, state = place[inside], state[inside]
            key = state << CHARACTER_BITS | characters[place + step]
            at = np.searchsorted(self.keys, key)
            known = self.keys[at] == key
            place, state = place[known], self.next[at[known]].astype(np.int64)
            step += 1
            ends = np.isfinite(self.weights[state])
            found.append((place[ends], np.full(ends.sum(), step), self.weights[state[ends]], self.numbers[state[ends]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found))

    def shortest_of(self, stretches: list[bytes]) -> list[bytes]:
        """The numbers along each stretch's least path as 32-bit values; the same paths as ``shortest`` finds."""
        joined = b"".join(stretches)
        data = np.frombuffer(joined, np.uint8)
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        characters = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        first = np.searchsorted(leads, np.cumsum([0, *map(len, stretches)]))
        sizes = np.diff(first)
        owner = np.repeat(np.arange(len(stretches)), sizes)
        within = np.arange(len(characters)) - first[owner]
        widths = np.diff(np.append(leads, len(data)))

        start, length, weight, number = self.lattice(characters, first, owner)
        turn = np.argsort(within[start], kind="stable")
        start, length, weight, number = (x[turn] for x in (start, length, weight, number))
        # A stretch has one node more than characters.
        source = start + owner[start]
        target = source + length
        lone = np.argsort(within, kind="stable")
        nodes = len(characters) + len(stretches)
        best, back, last = np.full(nodes, math.inf), np.zeros(nodes, np.int64), np.full(nodes, -1, np.int64)
        best[first[:-1] + np.arange(len(stretches))] = 0.0
        longest = int(sizes.max(initial=0))
        arcs, places = (np.searchsorted(within[x], np.arange(longest + 1)) for x in (start, lone))
        for at in range(longest):
            some = slice(arcs[at], arcs[at + 1])
            a, b = source[some], target[some]
            total = best[a] + weight[some]
            less = total < best[b]
            a, b = a[less], b[less]
            best[b], back[b], last[b] = total[less], a, number[some][less]
            # Bytes may be the better way to the next character.
            here = lone[places[at] : places[at + 1]]
            a = here + owner[here]
            total = best[a] + BYTE_WEIGHT * widths[here]
            less = (best[a + 1] > best[a] + BYTE_WEIGHT) & (total < best[a + 1])
            a = a[less]
            best[a + 1], back[a + 1], last[a + 1] = total[less], a, -1
        return self._paths(first, owner, back, last, data, leads, widths)

    def _paths(self, first, owner, back, last, data, leads, widths) -> list[bytes]:
        """Numbers of each stretch, from its last node back to its first."""
        count = len(first) - 1
        begin = first[:-1] + np.arange(count)
        node, alive = first[1:] + np.arange(count), np.arange(count)
        taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            moving = node > begin[alive]
            node, alive = node[moving], alive[moving]
            if not len(node):
                break
            taken.append((alive, last[node], back[node] - alive))
            node = back[node]
        if not taken:
            return [b""] * count
        stretch, number, place = (np.concatenate(x) for x in zip(*taken))
        step = np.repeat(np.arange(len(taken)), [len(x) for x, _, _ in taken])
        order = np.lexsort((-step, stretch))
        stretch, number, place = stretch[order], number[order], place[order]
        size = np.where(number < 0, widths[place], 1)
        at = np.repeat(np.cumsum(size) - size, size)
        spelled = np.repeat(leads[place], size) + np.arange(size.sum()) - at
        number = np.repeat(number, size)
        out = np.where(number < 0, self.byte_numbers[data[spelled % max(1, len(data))]], number).astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(stretch, size, count))).astype(np.int64).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]

    def shortest(self, text: str) -> list[int]:
        """Numbers along the least path; among equal ones that whose last piece begins first."""
        size, start, longest = len(text), self.start, self.longest
        best = [0.0] + [math.inf] * size
        back, last = [0] * (size + 1), [-1] * (size + 1)
        for at in range(size):
            here, arcs, to = best[at], start, at
            for character in text[at : at + longest]:
                state = arcs.get(character)
                if state is None:
                    break
                to += 1
                arcs, weight, number = state
                if here + weight < best[to]:
                    best[to], back[to], last[to] = here + weight, at, number
            # Only where no piece ends behind the character its bytes may be the better way.
            if best[at + 1] > here + BYTE_WEIGHT:
                weight = BYTE_WEIGHT * len(text[at].encode())
                if here + weight < best[at + 1]:
                    best[at + 1], back[at + 1], last[at + 1] = here + weight, at, -1
        path: list[int] = []
        while size:
            number, begin = last[size], back[size]
            if number >= 0:
                path.append(number)
            else:
                path += [self.bytes[b] for b in reversed(text[begin].encode())]
            size = begin
        path.reverse()
        return path

    def encode_all(self, stretches: list[bytes]) -> list[bytes]:
        """The numbers of each stretch as 32-bit values. Short stretches are kept, recent ones longest."""
        found = [self.kept.get(x) for x in stretches]
        missing = []
        for i, stretch in enumerate(stretches):
            if found[i] is None:
                found[i] = self.older.get(stretch)
                if found[i] is None:
                    missing.append(i)
                else:
                    self.kept[stretch] = found[i]
        short = [i for i in missing if len(stretches[i]) <= TOGETHER_BYTES]
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            for i, numbers in zip(some, self.shortest_of([stretches[i] for i in some])):
                found[i] = numbers
        for i in missing:
            stretch = stretches[i]
            if len(stretch) > TOGETHER_BYTES:
                found[i] = array("i", self.shortest(stretch.decode())).tobytes()
            if len(stretch) <= KEPT_BYTES:
                if len(self.kept) >= KEPT:
                    self.older, self.kept = self.kept, {}
                self.kept[stretch] = found[i]
        return found

    def forget(self) -> None:
        """Give up what is kept, as a worker lives on after its task."""
        self.kept, self.older = {}, {}

    def decode(self, numbers: Iterable[int]) -> str:
        """The text of an encoding; bytes that are no text on their own become replacement marks."""
        whole = b"".join(map(self.spelled.__getitem__, numbers))
        return (whole[1:] if whole[:1] == b" " else whole).decode(errors="replace")


_loaded: dict[str, Transducer] = {}


def load(model: str = MODEL) -> Transducer:
    """The transducer of a model file, kept by path in each worker."""
    if model not in _loaded:
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        size = loaded.vocab_size()
        pieces, bytes_ = [], {}
        for number in range(size):
            piece = loaded.id_to_piece(number)
            if loaded.is_byte(number):
                bytes_[int(piece[3:-1], 16)] = number
            elif not (loaded.is_control(number) or loaded.is_unknown(number) or loaded.is_unused(number)):
                plain = piece.replace(MARK, " ")
                if " " in plain.lstrip(" "):
                    raise ValueError(f"piece {piece!r} has a space inside")
                pieces.append((number, plain, math.log(2 + number)))
        if len(bytes_) < 256:
            raise ValueError("the model has no byte pieces")
        _loaded[model] = Transducer(pieces, bytes_)
    return _loaded[model]


def stretches(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with a space before each text, stretches' starts and ends, and each text's first one.

    A stretch begins where a run of spaces begins. An empty text has none.
    """
    data, offsets = flat(texts)
    sizes = np.diff(offsets)
    filled = sizes > 0
    moved = offsets[:-1] + np.cumsum(filled) - filled  # where each text's added space stands
    out = np.empty(len(data) + filled.sum(), np.uint8)
    inner = np.ones(len(out), bool)
    inner[moved[filled]] = False
    out[inner], out[~inner] = data, 0x20
    space = out == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[moved[filled]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(out)) if len(starts) else starts
    return out, starts, ends, np.searchsorted(starts, np.append(moved, len(out)))


def encode_batch(texts: pa.Array, transducer: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """All piece numbers, and how many each text has."""
    data, starts, ends, first = stretches(texts)
    hashes = _hashes(data, starts, ends, EXACT.table)
    _, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    encoded = transducer.encode_all([raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist())])
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    pieces = np.frombuffer(b"".join(encoded), np.int32)
    begin = np.cumsum(sizes) - sizes
    counts = sizes[number]
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    total = np.concatenate([[0], np.cumsum(counts)])
    return pieces[np.repeat(begin[number], counts) + within], np.diff(total[first])


def encode_pieces(docs: DataFrame, text: str = "text", model: str = MODEL, decoded: str | None = None) -> DataFrame:
    """Add ``piece_ids`` and ``n_pieces``, and under the name ``decoded`` the text they decode to.

    Null and empty texts have no pieces and decode to an empty text. Columns of these names are
    replaced; rows are not moved.
    """
    added = ADDED if decoded is None else T.StructType([*ADDED, T.StructField(decoded, T.StringType())])

    def make(batches):
        transducer = load(model)
        for batch in slices(batches, text):
            numbers, counts = encode_batch(batch.column(text), transducer)
            made = {"piece_ids": lists(numbers, counts, pa.int32()), "n_pieces": pa.array(counts, pa.int64())}
            if decoded is not None:
                ends = np.cumsum(counts).tolist()
                texts = [transducer.decode(numbers[a:b].tolist()) for a, b in zip([0, *ends], ends)]
                made[decoded] = pa.array(texts, pa.string())
            yield batch, made
        transducer.forget()

    return with_arrow_columns(docs, text, added, make)


def decode_pieces(docs: DataFrame, pieces: str = "piece_ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add the text of a column of piece numbers; null gives null, no pieces an empty text."""
    keep = [c for c in docs.columns if c != name]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.StringType())])

    def make(batches):
        transducer = load(model)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODED_ROWS):
                batch = whole.slice(at, DECODED_ROWS)
                column = batch.column(pieces)
                values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
                some = column.is_valid().to_pylist()
                texts = [transducer.decode(values[a:b].tolist()) if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], some)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], schema.names)

    return bounded_batches(docs).select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(make, schema)
