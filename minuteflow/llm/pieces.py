"""SentencePiece encoding that keeps the place of every piece in the source, and decoding.

A text is normalised by the model's compiled character map: at each place the longest
entry of its trie that matches is replaced, and every normalised character records the
bytes it came from. White space becomes the mark ``▁``. The normalised text falls into
chunks before each mark that follows another character; no piece of a vocabulary that splits at
white space goes across (checked when the model is read), so each chunk is merged on its own,
by score and from the left, and its pieces are kept for the next time it comes up. Chunks not
seen before are merged many at a time, as rows of equal length. Pieces without an id fall back
to bytes. Spans of source bytes follow from the recorded alignment.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from minuteflow.llm.common import arrow_schema

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Chunks remembered by a worker, and characters of a text worked on at a time.
MOST = 500_000
LONGEST_KEPT = 64
RUN_CHARS = 1 << 20
ROWS_BYTES = 4 << 20
_CHUNKS = re.compile(r"[ ▁]+[^ ▁]*|[^ ▁]+")
_CUT = re.compile(r"(?<=[^ ▁])[ ▁]")
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
# The model type of the merging by scores.
_BPE = 2


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie and the texts it points to.

    The blob holds the size of the trie in bytes, its units (little-endian, 32 bits) and the
    replacements, each ended by a zero byte. A unit has a label in its low 8 bits (and bit 31 for
    a value), bit 8 where a key ends at it, and an offset in the bits from 10 on, shifted by 8 more
    if bit 9 is set.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = array("I", blob[4 : 4 + size])
        self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest entry at a place."""
        if not self.units:
            return None
        node = self._offset(self.units[0])
        best = None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit & 256:
                value = self.units[node] & 0x7FFFFFFF
                best = (i + 1 - at, value)
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]


class _Kept(dict):
    """Chunk -> pairs of an id and its source bytes; longer chunks are not remembered."""

    def __init__(self, spelled):
        self.spelled = spelled

    def __missing__(self, chunk: str) -> bytes:
        known = self.spelled(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = known
        return known


def _char_bytes(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class PieceModel:
    """A model file with merges by score and byte fallback."""

    @classmethod
    def of(cls, path: str) -> PieceModel:
        """The model of this worker process, shared by its tasks."""
        import sentencepiece

        made = sentencepiece.__dict__.setdefault("_piece_models", {})
        if path not in made:
            made[path] = cls(path)
        return made[path]

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            blob = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        kinds = {p.type for p in proto.pieces}
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        if (
            proto.trainer_spec.model_type != _BPE
            or not proto.trainer_spec.byte_fallback
            or proto.trainer_spec.treat_whitespace_as_suffix
            or not proto.normalizer_spec.escape_whitespaces
            or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
            or any(re.search(f"[^{MARK}]{MARK}", piece) for piece in normal)
        ):
            raise ValueError("only merges by score with byte fallback, split at white space")
        self.ids = normal
        # Equal scores share a place, the best is 0.
        places = {s: k for k, s in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        self.places = {p.piece: places[p.score] for p in proto.pieces if p.type == _NORMAL}
        self.bytes = {
            int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE
        }
        self.map = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.trims = proto.normalizer_spec.remove_extra_whitespaces
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.end_id = self.library.eos_id()
        self.kept = _Kept(self._spelled)
        self._index_pairs(len(proto.pieces))

    def _index_pairs(self, n_pieces: int) -> None:
        """Tables for merging many chunks: a symbol per piece or character, and what two make."""
        symbols = dict(self.ids)
        pairs = []
        for piece in self.ids:
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if all(len(x) == 1 or x in self.ids for x in (a, b)):
                    for x in (a, b):  # characters without an id come after the pieces
                        symbols.setdefault(x, n_pieces + len(symbols))
                    pairs.append((symbols[a], symbols[b], self.places[piece], self.ids[piece]))
        self.n_pieces = n_pieces
        self.unknown = max(symbols.values(), default=0) + 1
        table = np.array(sorted((a * self.unknown + b, p, m) for a, b, p, m in pairs), np.int64)
        self.pair_keys, self.pair_places, self.pair_makes = table.reshape(-1, 3).T.copy()
        self.char_symbols = np.full(0x110000, self.unknown, np.int64)
        self.piece_bytes = np.zeros(n_pieces, np.int64)
        for symbol, number in symbols.items():
            if len(symbol) == 1:
                self.char_symbols[ord(symbol)] = number
            if number < n_pieces:
                self.piece_bytes[number] = len(symbol.replace(MARK, " ").encode())
        self.char_symbols[ord(" ")] = self.char_symbols[ord(MARK)]
        # A mark in the source has other bytes than a space, so it is left to ``_spelled``.
        self.char_symbols[ord(MARK)] = self.unknown

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and symbol of what two symbols make; the place after the last if nothing."""
        keys = left * self.unknown + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        makes = self.pair_keys[at] == keys
        return np.where(makes, self.pair_places[at], len(self.places)), self.pair_makes[at]

    def learn(self, chunks: set[str]) -> None:
        """Merge all chunks of one length at once, a pair of each in every step."""
        by_length: dict[int, list[str]] = {}
        for chunk in chunks:
            if len(chunk) <= LONGEST_KEPT:
                by_length.setdefault(len(chunk), []).append(chunk)
        for length, group in by_length.items():
            codes = np.array(group, f"<U{length}").view("<u4").reshape(-1, length)
            symbols = self.char_symbols[codes]
            rows = np.flatnonzero((symbols < self.unknown).all(1))
            symbols = symbols[rows]
            places = self._pair(symbols[:, :-1], symbols[:, 1:])[0]
            while len(rows):
                n = symbols.shape[1]
                if n == 1:
                    self._keep(group, rows, symbols)
                    break
                best = places.argmin(1)  # the leftmost of equal ones
                going = places[np.arange(len(rows)), best] < len(self.places)
                self._keep(group, rows[~going], symbols[~going])
                symbols, places, best, rows = (x[going] for x in (symbols, places, best, rows))
                every = np.arange(len(rows))
                symbols[every, best] = self._pair(symbols[every, best], symbols[every, best + 1])[1]
                stay = np.ones(symbols.shape, bool)
                stay[every, best + 1] = False
                symbols = symbols[stay].reshape(len(rows), n - 1)
                stay = np.ones(places.shape, bool)
                stay[every, best] = False
                places = places[stay].reshape(len(rows), n - 2)
                for k, at in ((every[best > 0], best[best > 0] - 1), (every[best < n - 2], best[best < n - 2])):
                    places[k, at] = self._pair(symbols[k, at], symbols[k, at + 1])[0]

    def _keep(self, group: list[str], rows: np.ndarray, symbols: np.ndarray) -> None:
        whole = (symbols < self.n_pieces).all(1)
        rows, ids = rows[whole], symbols[whole]
        data = np.stack([ids, self.piece_bytes[ids]], -1).astype("<i4").tobytes()
        step = 8 * ids.shape[1]
        for k, row in enumerate(rows.tolist()):
            self.kept[group[row]] = data[k * step : (k + 1) * step]

    def normalised(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The normalised text, with the source bytes ``begin`` to ``end`` of each character."""
        data = text.encode()
        chars: list[str] = []
        begins: list[int] = []
        ends: list[int] = []
        at, spaced = 0, True
        while at < len(data):
            match = self.map.longest(data, at)
            if match is None:
                n = _char_bytes(data[at])
                new = data[at : at + n].decode()
            else:
                n, new = match[0], match[1].decode()
            for char in new:
                if self.trims and char == " " and spaced:
                    continue
                spaced = char == " "
                chars.append(MARK if spaced else char)
                begins.append(at)
                ends.append(at + n)
            at += n
        if self.trims:
            while chars and chars[-1] == MARK:
                del chars[-1], begins[-1], ends[-1]
        if self.prefix and chars:
            chars.insert(0, MARK)
            begins.insert(0, begins[0])
            ends.insert(0, begins[0])
        return "".join(chars), np.array(begins, np.int64), np.array(ends, np.int64)

    def merged(self, chunk: str) -> list[str]:
        """The pieces of a normalised chunk: the best scored pair first, from the left on ties."""
        if len(chunk) > LONGEST_KEPT:
            return self._merged_long(chunk)
        place, none = self.places.get, len(self.places)
        parts = list(chunk)
        pairs = [place(a + b, none) for a, b in zip(chunk, chunk[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = place(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = place(parts[i] + parts[i + 1], none)
        return parts

    def _merged_long(self, chunk: str) -> list[str]:
        """``merged`` with a heap, for long chunks."""
        parts: list[str | None] = list(chunk)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        agenda: list[tuple[int, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            both = parts[left] + parts[right]
            place = self.places.get(both)
            if place is not None:
                heapq.heappush(agenda, (place, left, right, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            # A pair of which a part was merged elsewhere is out of date.
            if parts[left] is None or parts[right] is None or parts[left] + parts[right] != both:
                continue
            if after[left] != right:
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in parts if p is not None]

    def pieces(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of a normalised chunk, and the number of characters up to the end of each.

        All bytes of a character without an id end with it.
        """
        ids, ends, at = [], [], 0
        for piece in self.merged(chunk):
            at += len(piece)
            known = self.ids.get(piece)
            own = [known] if known is not None else [self.bytes[b] for b in piece.encode()]
            ids += own
            ends += [at] * len(own)
        return ids, ends

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text the ids without the end id, and the source bytes ``begin`` to ``end`` of each."""
        if self.map.units or self.trims or not self.prefix:
            return [self.aligned(text) for text in texts]
        short = self._pairs([" " + t if 0 < len(t) <= RUN_CHARS else "" for t in texts])
        out = []
        for text, pairs in zip(texts, short, strict=True):
            if len(text) > RUN_CHARS:
                pairs = b"".join(self._pairs([run])[0] for run in _runs(" " + text))
            ids, size = np.frombuffer(pairs, "<i4").reshape(-1, 2).T
            # All bytes of one character span it, from its first id on.
            length, again = (size & 0x3FFFFFFF).astype(np.int64), size >> 30 & 1
            ends = np.cumsum(np.where(again, 0, length))
            # The leading mark is no byte of the source.
            out.append((ids, np.maximum(ends - length - 1, 0).astype(np.int32), (ends - 1).astype(np.int32)))
        return out

    def _pairs(self, texts: list[str]) -> list[bytes]:
        """The pairs of ``_Kept`` for texts where characters map to themselves."""
        found = [_CHUNKS.findall(text) for text in texts]
        if len(self.kept) > MOST:
            self.kept.clear()
        self.learn(set(chain.from_iterable(found)).difference(self.kept))
        return [b"".join(map(self.kept.__getitem__, chunks)) for chunks in found]

    def aligned(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encoded`` for any character map, by the alignment of every normalised character."""
        normal, begin, end = self.normalised(text)
        ids: list[int] = []
        firsts: list[int] = []
        lasts: list[int] = []
        at = 0
        for chunk in _CHUNKS.findall(normal):
            own, ends = self.pieces(chunk)
            ids += own
            start = 0
            for k, stop in enumerate(ends):
                if k and stop != ends[k - 1]:
                    start = ends[k - 1]
                firsts.append(at + start)
                lasts.append(at + stop - 1)
            at += len(chunk)
        return (
            np.array(ids, np.int32),
            begin[firsts].astype(np.int32) if ids else np.zeros(0, np.int32),
            end[lasts].astype(np.int32) if ids else np.zeros(0, np.int32),
        )

    def _spelled(self, chunk: str) -> bytes:
        """Pairs of an id and its source bytes; bit 30 marks further bytes of the same character."""
        pairs, at = [], 0
        for piece in self.merged(chunk.replace(" ", MARK)):
            size = len(chunk[at : at + len(piece)].encode())
            at += len(piece)
            own = self.ids.get(piece)
            if own is not None:
                pairs += (own, size)
                continue
            for byte in piece.encode():
                pairs += (self.bytes[byte], size)
                size |= 1 << 30
        return array("i", pairs).tobytes()


def _runs(text: str) -> Iterator[str]:
    """``text`` in runs of about ``RUN_CHARS`` characters, cut between chunks."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + RUN_CHARS) if len(text) - at > RUN_CHARS else None
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


_ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("begins", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("ends", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("decoded", T.StringType(), False),
    ]
)


def _installed(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes`` of the text, ``ids`` with the end id, ``begins`` and ``ends``
    (the source bytes of every id) and ``decoded``, what the model's library makes of the ids.

    ``model`` is the path of a model file on every executor, by default the installed one. The end
    id spans nothing, at the end of the text; so does a leading mark that was added. All byte ids
    of one character span it. A null or empty text has the end id alone. Rows are encoded one by
    one, so null and repeated ids and repeated rows do no harm; further columns are ignored; an empty
    table gives no rows. Very long texts are worked on in runs of ``RUN_CHARS`` characters; a
    task holds the ids of about ``ROWS_BYTES`` of texts, or of one text.
    """
    schema = arrow_schema(_ENCODED)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.of(model or _installed(MODEL))

        def done(rows: list) -> pa.RecordBatch:
            doc_ids, sizes, texts = zip(*rows, strict=True)
            made = zip(pieces.encoded(list(texts)), sizes, strict=True)
            ended = [
                (np.append(ids, pieces.end_id), np.append(begins, size), np.append(ends, size))
                for (ids, begins, ends), size in made
            ]
            lists = list(zip(*ended, strict=True))
            cuts = pa.array(np.cumsum([0, *(len(ids) for ids in lists[0])]), pa.int32())
            arrays = [
                pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x).astype(np.int32)))
                for x in lists
            ]
            decoded = pieces.library.decode([x.tolist() for x in lists[0]], num_threads=1)
            columns = [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()), *arrays]
            columns.append(pa.array(decoded, pa.string()))
            return pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                size = len(text.encode())
                if rows and held + size > ROWS_BYTES:
                    yield done(rows)
                    rows, held = [], 0
                rows.append((doc_id.as_py(), size, text))
                held += size
            if rows:
                yield done(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _ENCODED)
