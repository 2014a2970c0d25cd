"""Best-fit packing by bin completion.

Texts become token pieces of at most ``capacity``. Pieces of one length are
alike, so the search works on the histogram of lengths, which has ``capacity``
entries however many pieces there are. Sequences are completed around the longest piece
left: a depth-first branch and bound over whole packings chooses a filling for it, uses
that as often as the counts allow (or half as often, or once) and goes on with what is left.

The best-fit packing is the first incumbent. A branch is cut where the sequences it has used and a
lower bound for the rest cannot beat the incumbent, and a filling where it wastes more
than a better packing could. Dominated fillings (where pieces could make way for one longer
piece that is left) are passed over. The search ends when the incumbent meets the lower bound,
when nothing is left to try, or after about ``budget`` partial fillings. Then every piece
finds its place by its number among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from minuteflow.llm.common import arrow_schema, kept

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0
NODES = 2_000  # partial fillings looked at for one longest piece
BUDGET = 50_000  # partial fillings looked at in all
CHOICE = 20  # what a filling chosen counts against the budget besides


def completion(counts: np.ndarray, room: int, nodes: int = NODES) -> list[int]:
    """Lengths that fill ``room`` with the least waste, from pieces left in ``counts``.

    ``nodes`` bounds the search; the incumbent is the best-fit filling until a
    better one is found.
    """
    return _completed(counts, room, nodes)[0]


def _completed(counts: np.ndarray, room: int, nodes: int) -> tuple[list[int], int]:
    """The filling of least waste, and how many partial fillings were looked at."""
    left = [int(x) for x in np.flatnonzero(counts[: room + 1])][::-1]  # longest first
    best, rest = [], room
    for length in left:  # best fit: the longest piece that fits, again and again
        n = min(int(counts[length]), rest // length)
        best += [length] * n
        rest -= n * length
    least = rest
    lengths = np.array(left)
    after = np.cumsum((counts[lengths] * lengths)[::-1])[::-1] if left else lengths
    budget = nodes
    stack = [(0, room, ())]
    while stack and least and budget:
        budget -= 1
        k, rest, chosen = stack.pop()
        if rest < least:
            least = rest
            best = [x for x, n in chosen for _ in range(n)]
        # What is left cannot fill the room below the incumbent's waste.
        k = k + int(np.searchsorted(-lengths[k:], -rest)) if k < len(left) else k
        if k >= len(left) or rest - int(after[k]) >= least:
            continue
        length = left[k]
        most = min(int(counts[length]), rest // length)
        stack.append((k + 1, rest, chosen))
        for n in range(1, most + 1):
            stack.append((k + 1, rest - n * length, (*chosen, (length, n))))
    return best, nodes - budget


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound of the sequences that pieces need.

    Pieces over half the capacity have a sequence each. For every size ``a`` up to that half, the
    room these leave beside pieces of ``a`` or more is filled with the smaller ones of at least ``a``.
    """
    lengths = np.arange(capacity + 1)
    n, total = np.cumsum(counts[: capacity + 1]), np.cumsum(counts[: capacity + 1] * lengths)
    half = capacity // 2
    a = lengths[: half + 1]
    small = total[half] - np.r_[0, total[: half]]
    room = (n[capacity - a] - n[half]) * capacity - (total[capacity - a] - total[half])
    return int(n[capacity] - n[half] + max(0, -(-(small - room) // capacity).min()))


def dominated(left: np.ndarray, chosen: tuple[int, ...], rest: int) -> bool:
    """Whether one of the pieces ``left`` beside a filling could take the place of none, one or more
    of its pieces within the ``rest`` of the room; of pieces as long as it only if they are several.
    """
    free = left.copy()
    np.subtract.at(free, list(chosen), 1)
    others = int.from_bytes(np.packbits(free > 0, bitorder="little").tobytes(), "little")
    one, several = 0, 0  # bit s: a piece, or several, of the filling have length s together
    for length in chosen:
        several |= (several | one) << length
        one |= 1 << length
    # A longer piece may have 0 to ``rest`` more than several, or 1 to ``rest`` more than one or none.
    single = _spread((1 | one) << 1, rest - 1) if rest else 0
    return bool((_spread(several, rest) | single) & others)


def _spread(bits: int, most: int) -> int:
    """Bits shifted by 0, 1, ... and ``most``."""
    done = 0
    while done < most:
        step = min(done + 1, most - done)
        bits |= bits << step
        done += step
    return bits


class _Search:
    """Branch and bound over packings of a histogram of lengths."""

    def __init__(self, counts: np.ndarray, capacity: int, nodes: int, budget: int):
        self.left = counts.astype(np.int64).copy()
        self.capacity, self.nodes, self.budget = capacity, nodes, budget
        self.best = best_fit(counts, capacity)
        self.most, self.used = _sequences(self.best), 0
        self.lengths = np.arange(len(self.left))

    def spare(self) -> int:
        """What may be wasted from here on by a packing better than the incumbent."""
        return (self.most - 1 - self.used) * self.capacity - int(self.left @ self.lengths)

    def choices(self) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(times, filling) around the longest piece left: the one of least waste, then others, as
        often as they can be; then all of them half as often and once.
        """
        longest = int(np.flatnonzero(self.left)[-1])
        room = self.capacity - longest
        self.left[longest] -= 1
        first, seen = _completed(self.left, room, self.nodes)
        self.budget -= seen
        first = tuple(first)
        self.left[longest] += 1
        yield from self._uses((longest, *first), 1)
        if self.budget <= 0:
            return
        self.left[longest] -= 1
        others = [chosen for chosen in self._fillings(room) if chosen != first]
        self.left[longest] += 1
        for chosen in others:
            yield from self._uses((longest, *chosen), 1)
        for chosen in (first, *others):
            yield from self._uses((longest, *chosen), 2)

    def _uses(self, chosen: tuple[int, ...], part: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        lengths, uses = np.unique(chosen, return_counts=True)
        times = int((self.left[lengths] // uses).min())
        waste, spare = self.capacity - sum(chosen), self.spare()
        if waste:
            times = min(times, spare // waste)
        if spare >= 0 and times > 0:
            for n in (times,) if part == 1 else sorted({(times + 1) // 2, 1} - {times}, reverse=True):
                yield n, chosen

    def _fillings(self, room: int) -> list[tuple[int, ...]]:
        """Undominated fillings of ``room`` that a better packing could have, least waste first."""
        left = [int(x) for x in np.flatnonzero(self.left[: room + 1])][::-1]
        spare = self.spare() - (self.capacity - room)  # the longest piece is out of ``left``
        lengths = np.array(left, np.int64)
        after = np.cumsum((self.left[lengths] * lengths)[::-1])[::-1]
        found, stack, nodes = [], [(0, room, ())], self.nodes
        while stack and nodes:
            nodes -= 1
            self.budget -= 1
            k, rest, chosen = stack.pop()
            k = k + int(np.searchsorted(-lengths[k:], -rest)) if k < len(left) else k
            if k >= len(left):
                if rest <= spare and not dominated(self.left, chosen, rest):
                    found.append((rest, chosen))
                continue
            if rest - int(after[k]) > spare:
                continue
            most = min(int(self.left[left[k]]), rest // left[k])
            for n in range(most + 1):
                stack.append((k + 1, rest - n * left[k], chosen + (left[k],) * n))
        return [chosen for _, chosen in sorted(found, key=lambda f: f[0])]

    def run(self) -> list[tuple[int, tuple[int, ...]]]:
        """Packings that take another than the first choice never, once, twice, four times and so on."""
        bound, other, whole = least_sequences(self.left, self.capacity), 0, not self.left.any()
        while not whole and self.most > bound and self.budget > 0:
            whole = self._descend(bound, other)
            other = max(1, 2 * other)
        return self.best

    def _descend(self, bound: int, others: int) -> bool:
        """Search packings with at most ``others`` other choices; whether that left none out."""
        path: list[tuple[int, tuple[int, ...]]] = []
        levels, whole = [(enumerate(self.choices()), 0)], True  # with the other choices made above
        while levels:
            choices, before = levels[-1]
            again = len(path) == len(levels)
            if again:  # take back what this level chose before
                self._take(*path.pop(), -1)
            ended = self.most <= bound or (self.budget <= 0 and others)
            if again and before == others:
                ended, whole = True, False
            k, choice = (0, None) if ended else next(choices, (0, None))
            spent = before + (k > 0)
            if choice is None:
                levels.pop()
                continue
            self.budget -= CHOICE
            path.append(choice)
            self._take(*choice, 1)
            if not self.left.any():
                self.best, self.most = list(path), self.used
            elif self.used + least_sequences(self.left, self.capacity) < self.most:
                levels.append((enumerate(self.choices()), spent))
        return whole and self.budget > 0

    def _take(self, times: int, chosen: tuple[int, ...], sign: int) -> None:
        np.subtract.at(self.left, list(chosen), sign * times)
        self.used += sign * times


def bin_completion(
    counts: np.ndarray, capacity: int, nodes: int = NODES, budget: int = BUDGET
) -> list[tuple[int, tuple[int, ...]]]:
    """Fillings around the longest piece left, as (times, lengths).

    ``nodes`` partial fillings are looked at for one piece and about ``budget`` in all. Within them no
    packing has fewer sequences; where they end the search, the best packing found so far stays. If every
    length is there several times, the packing of a fewest-th part of all pieces, that often, is tried too.
    """
    best = _Search(counts, capacity, nodes, budget).run()
    fewest = int(counts[1:].max(initial=0) and counts[1:][counts[1:] > 0].min())
    if fewest > 1 and _sequences(best) > least_sequences(counts, capacity):
        part = _Search(counts // fewest, capacity, nodes, budget // 2).run()
        rest = bin_completion(counts % fewest, capacity, nodes, budget // 2)
        repeated = [*((fewest * times, chosen) for times, chosen in part), *rest]
        best = min(best, repeated, key=_sequences)
    return best


def _sequences(fillings: list[tuple[int, tuple[int, ...]]]) -> int:
    return sum(times for times, _ in fillings)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Fillings by best fit decreasing, as (times, lengths)."""
    left = counts.astype(np.int64).copy()
    fillings = []
    longest = len(left) - 1
    while True:
        while longest > 0 and not left[longest]:
            longest -= 1
        if longest <= 0:
            return fillings
        left[longest] -= 1
        chosen = (longest, *completion(left, capacity - longest, 0))
        left[longest] += 1
        lengths, uses = np.unique(chosen, return_counts=True)
        # At most 1 + capacity/length times a length is what ends a filling's use,
        # so the number of different fillings is bounded by the capacity alone.
        times = int((left[lengths] // uses).min())
        left[lengths] -= times * uses
        fillings.append((times, chosen))


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return list(zip(starts, np.diff([*starts, n]).tolist(), strict=True))


_PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("pid", T.LongType()),
        T.StructField("nth", T.LongType()),
    ]
)


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """The pieces of every row's tokens, each with its number ``nth`` among those of its length
    in its task ``pid``. Every text ends with token ``END_ID``.
    """
    schema = arrow_schema(_PIECES)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from minuteflow.llm.tokens import WordTokens

        encode = WordTokens.of(tokenizer or _installed(TOKENIZER), ranks or _installed(RANKS))
        end = np.array([END_ID], "<u4").tobytes()
        pid, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        try:
            for batch in batches:
                rows = []
                doc_ids = batch.column(0).to_pylist()
                for doc_id, tokens in zip(doc_ids, encode.encoded(batch.column(1)), strict=True):
                    ids = tokens.tobytes() + end
                    for k, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, k, start, length, crc, pid, int(seen[length])))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        finally:
            encode.forget()

    return docs.select("doc_id", "text").mapInArrow(pieces, _PIECES)


def _installed(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def places(fillings: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, ...]]:
    """(length, first, uses, base, offset, step) of every length in every filling.

    Of the pieces of ``length``, those numbered ``first`` to ``first + times * uses``
    go, ``uses`` to a sequence, to the sequences from ``base`` on, at ``offset``.
    """
    rows, used, base = [], {}, 0
    for times, chosen in fillings:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            uses = chosen.count(length)
            rows.append((length, used.get(length, 0), uses, base, offset))
            used[length] = used.get(length, 0) + times * uses
            offset += uses * length
        base += times
    return rows


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    ranks: str | None = None,
    nodes: int = NODES,
    budget: int = BUDGET,
) -> DataFrame:
    """Where every piece of every document goes: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``.

    A null or empty text is one piece of the end token. Null and repeated ids and
    repeated rows give pieces of their own; very long texts are cut into pieces that fill sequences but for
    the first; further columns are ignored; an empty table gives no rows. Texts are tokenised once and only their pieces are kept.
    """
    pieces = kept(token_pieces(docs, capacity, tokenizer, ranks), "pieces")
    # Numbers among all pieces of a length: those of earlier tasks come before.
    per_task = pieces.groupBy("length", "pid").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select(
        "length", "pid", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    table = places(bin_completion(counts, capacity, nodes, budget))
    by_length: dict[int, np.ndarray] = {}
    for length, *rest in table:
        by_length.setdefault(length, []).append(rest)
    by_length = {k: np.array(v, np.int64) for k, v in by_length.items()}
    schema = T.StructType(
        [
            *(f for f in _PIECES.fields if f.name not in ("pid", "nth")),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    names = [f.name for f in schema.fields]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.r_[True, np.diff(length[order]) > 0, True])
            for a, b in zip(bounds, bounds[1:], strict=False):
                own = order[a:b]
                size = int(length[own[0]])
                slots = by_length[size]
                row = slots[np.searchsorted(slots[:, 0], number[own], "right") - 1]
                k = number[own] - row[:, 0]
                sequence[own] = row[:, 2] + k // row[:, 1]
                offset[own] = row[:, 3] + k % row[:, 1] * size
            columns = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=names
            )

    return pieces.join(before, ["length", "pid"]).mapInArrow(place, schema)
