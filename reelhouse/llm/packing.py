"""Best-fit packing of documents into sequences by bin completion.

Documents are cut into pieces of at most the sequence length. Only the lengths of the
pieces matter for a packing, so the search works on how many pieces there are of each
length, a table of at most one row per possible length. It goes from the longest piece
down: the undominated fillings of what room the longest piece leaves are tried, the fullest
first, and branches whose waste rules out a better packing are cut. Best-fit packings of
all pieces, and of what beginnings of the search leave, are the incumbents. What comes out is a
list of fillings with the number of sequences that use each; the pieces are then joined to
their places by length and rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import pick, written
from .tokens import WordEncoder


@dataclass(frozen=True)
class Packing:
    """``nodes`` bounds the fillings tried, or dropped as dominated, beyond the first descent.

    ``starts`` is how many beginnings of the first descent are finished by best fit, and
    ``splits`` into how many parts the lengths are divided for packings of two parts.
    """

    length: int = 4096
    end_id: int = 1
    nodes: int = 20_000
    starts: int = 64
    splits: int = 24
    rank_parts: int = 4_096
    rank_block: int = 64


def pieces(docs: DataFrame, tokenizer: str, packing: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of each piece, and its ``ids`` on demand.

    Every row of ``docs`` has at least one piece, as a null or empty text still has the end
    id. Ids are the tokenizer's, without special tokens; repeated rows have pieces each.
    ``tag`` tells pieces of repeated ids apart.
    """
    size, end_id = packing.length, packing.end_id

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder.of(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for part in parts:
            rows = {"at": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for at, data in enumerate(encoder.encode(part["text"])):
                ids = np.frombuffer(data + end, encoder.dtype).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), size)):
                    own = ids[start : start + size].tobytes()
                    rows["at"].append(at)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(len(own) // 4)
                    rows["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        rows["ids"].append(own)
            at = rows.pop("at")
            if not with_ids:
                rows.pop("ids")
            out = pd.DataFrame(rows)
            out.insert(0, "doc_id", part["doc_id"].iloc[at].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    texts = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInPandas(cut, schema)


Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first
Completion = tuple[Filling, int, int]  # filling of a whole sequence, how many sequences have it, waste of each


class _Stock:
    """Pieces at hand: how many of each length, the lengths in order, and the sums they can give."""

    def __init__(self, histogram: dict[int, int], room: int) -> None:
        self.counts = {size: n for size, n in histogram.items() if n}
        self.lengths = sorted(self.counts)
        self.bits = sum(1 << size for size in self.lengths)
        self.room, self.all = room, (1 << (room + 1)) - 1
        self.sums: list[int] = []  # see reach; as many of them as are still right

    def add(self, size: int, n: int) -> None:
        """``n`` pieces more, or fewer where it is negative."""
        old = self.counts.get(size, 0)
        now, most = old + n, self.room // size
        at = bisect.bisect_left(self.lengths, size)
        if min(old, most) != min(now, most):
            del self.sums[at:]
        if not old:
            self.lengths.insert(at, size)
            self.bits |= 1 << size
        if now:
            self.counts[size] = now
        else:
            del self.counts[size]
            self.lengths.pop(at)
            self.bits &= ~(1 << size)

    def use(self, filling: Filling, times: int) -> None:
        for size, n in filling:
            self.add(size, -n * times)

    def reach(self, at: int) -> int:
        """The totals that pieces of the lengths up to place ``at`` can have, as bits."""
        for i in range(len(self.sums), at + 1):
            size, bits = self.lengths[i], self.sums[-1] if i else 1
            left, step = min(self.counts[size], self.room // size), 1
            while left and bits != self.all:
                step = min(step, left)
                bits |= bits << step * size & self.all
                left, step = left - step, 2 * step
            self.sums.append(bits)
        return self.sums[at] if at >= 0 else 1

    def fillings(self, room: int, hope: Callable[[], int]) -> Iterator[Filling | None]:
        """All undominated fillings of ``room``, those that leave least of it first, as long as that is at most ``hope()``.

        A filling is dominated if a longer piece at hand fits instead of one of its pieces or
        of none, or one that is as long or longer instead of several. A None is given
        wherever a filling begun turns out to be dominated; the first filling, the fullest one
        with the longest pieces, never is. Between two fillings the pieces may be used if they
        are put back.
        """
        total = room + 1
        while total > 0:
            total = (self.reach(bisect.bisect_right(self.lengths, room) - 1) & (1 << total) - 1).bit_length() - 1
            waste = room - total
            if waste > hope():
                return
            # Pieces that the waste has room for have to be used, all of them.
            short = {size: self.counts[size] for size in self.lengths[: bisect.bisect_right(self.lengths, waste)]}
            if sum(size * n for size, n in short.items()) > total:
                return
            yield from self._fillings(total, len(self.lengths), waste, short, (), 0, 0)

    def _fillings(self, left: int, top: int, waste: int, short: dict[int, int], chosen: Filling, one: int, more: int) -> Iterator[Filling | None]:
        """``chosen`` and pieces of the lengths before place ``top`` that have the total ``left``.

        ``one`` and ``more`` have the totals of single and of several pieces of ``chosen`` as bits.
        """
        if not left:
            yield chosen if short.items() <= dict(chosen).items() else None
            return
        for at in range(bisect.bisect_right(self.lengths, left, 0, min(top, len(self.lengths))) - 1, -1, -1):
            if not self.reach(at) >> left & 1:
                return
            size = self.lengths[at]
            for n in range(min(self.counts[size], left // size), 0, -1):
                if not self.reach(at - 1) >> (left - n * size) & 1:
                    continue
                own, single, several = (*chosen, (size, n)), one, more
                for _ in range(n):
                    several |= (several | single) << size
                    single |= 1 << size
                # What replaces pieces is longer than they are, so it has been passed over for good.
                if self._dominated(own, single, several, waste):
                    yield None
                else:
                    yield from self._fillings(left - n * size, at, waste, short, own, single, several)

    def _dominated(self, chosen: Filling, one: int, more: int, waste: int) -> bool:
        free = self.bits
        for size, n in chosen:
            if self.counts[size] == n:
                free &= ~(1 << size)
        longer, done = (one | more) << 1, 1
        while done < waste:
            step = min(done, waste - done)
            longer, done = longer | longer << step, done + step
        return bool(free & (more | longer if waste else more))

    def completions(self, packing: Packing, hope: Callable[[], int]) -> Iterator[Completion | None]:
        """Undominated fillings around the longest piece, each in as many sequences as can have it, then in fewer."""
        longest = self.lengths[-1]
        for fewer in (False, True):
            repeated = False
            self.add(longest, -1)
            for rest in self.fillings(packing.length - longest, hope):
                self.add(longest, 1)
                if rest is None:
                    yield None
                else:
                    own = dict(rest)
                    own[longest] = own.get(longest, 0) + 1
                    times = min(self.counts[size] // n for size, n in own.items())
                    waste = packing.length - sum(size * n for size, n in own.items())
                    filling = tuple(sorted(own.items(), reverse=True))
                    repeated |= times > 1
                    for n in range(times - 1, 0, -1) if fewer else (times,):
                        yield filling, n, waste
                self.add(longest, -1)
            self.add(longest, 1)
            if not repeated:
                return


def best_fit(histogram: dict[int, int], length: int) -> list[tuple[Filling, int]]:
    """The packing in which every piece, longest first, goes where it leaves least room.

    Sequences with the same filling are one entry. A piece that fits a sequence twice goes
    there twice, as the room then left is the least of all, so pieces of one length are
    placed together.
    """
    rooms: list[int] = []  # in order, of sequences that are begun
    groups: dict[int, list[tuple[Filling, int]]] = {}

    def put(room: int, filling: Filling, times: int) -> None:
        if times:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((filling, times))

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else length
            each = room // size
            if at < len(rooms):
                filling, times = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                filling, times = (), -(-left // each)
            full = min(times, left // each)
            put(room - each * size, (*filling, (size, each)), full)
            left -= full * each
            if full < times and left:
                put(room - left * size, (*filling, (size, left)), 1)
                full, left = full + 1, 0
            put(room, filling, times - full)
    return [entry for room in rooms for entry in groups[room]]


def fewest(histogram: dict[int, int], length: int) -> int:
    """A lower bound of the sequences: the larger of Martello and Toth's over all thresholds.

    Pieces longer than half share no sequence with each other, and what is at least as long
    as the threshold fits only what room those leave that are short enough.
    """
    sizes = sorted(histogram)
    sums, counts = [0], [0]
    for size in sizes:
        sums.append(sums[-1] + size * histogram[size])
        counts.append(counts[-1] + histogram[size])
    half, best = bisect.bisect_right(sizes, length // 2), 0
    for threshold in [0, *sizes[:half]]:
        low, high = bisect.bisect_left(sizes, threshold), max(half, bisect.bisect_right(sizes, length - threshold))
        room = (counts[high] - counts[half]) * length - (sums[high] - sums[half])
        best = max(best, counts[-1] - counts[half] + max(0, -(-(sums[half] - sums[low] - room) // length)))
    return best


def _bins(plan: list[tuple[Filling, int]]) -> int:
    return sum(n for _, n in plan)


def first_descent(histogram: dict[int, int], packing: Packing) -> list[tuple[Filling, int]]:
    """The best-fitting completion at every longest piece, in as many sequences as the pieces allow."""
    stock, plan = _Stock(histogram, packing.length), []
    while stock.lengths:
        filling, times, _ = next(c for c in stock.completions(packing, lambda: packing.length) if c is not None)
        stock.use(filling, times)
        plan.append((filling, times))
    return plan


def complete_bins(histogram: dict[int, int], packing: Packing = Packing()) -> list[tuple[Filling, int]]:
    """Fillings and the number of sequences that use each, over all pieces of ``histogram`` (length to count).

    The best-fit packing of all pieces is the first incumbent. The first descent takes the
    best-fitting completion at every longest piece, and as many sequences of it as the
    pieces allow; it is an incumbent too where it is better, as are its beginnings at up to
    ``packing.starts`` places, each with a best-fit packing of what is left. Where short
    pieces are worth more beside middling than beside long ones, pieces up to a length and
    longer ones are packed apart, for up to ``packing.splits`` lengths. Then the last
    decisions are taken back first and the other undominated completions tried, where the
    waste so far leaves hope of fewer sequences, until the lower bound is met, none is left,
    or ``nodes`` completions beyond the first descent were tried or found to be dominated.
    """
    stock = _Stock(histogram, packing.length)
    total = sum(size * n for size, n in histogram.items())
    bound = fewest(histogram, packing.length)
    best = best_fit(histogram, packing.length)
    best_bins = _bins(best)
    tried = bins = waste = 0
    descended = False
    trail: list[tuple[Completion, Iterator[Completion | None]]] = []  # decisions, and what else is to choose from

    def hope() -> int:
        """The waste that may be added if the sequences are to be fewer than the incumbent's, any in the first descent."""
        return (best_bins - 1) * packing.length - total - waste if descended else packing.length

    def take(choices: Iterator[Completion | None]) -> bool:
        nonlocal tried, bins, waste
        for choice in choices:
            tried += descended
            if choice is not None:
                stock.use(choice[0], choice[1])
                bins, waste = bins + choice[1], waste + choice[1] * choice[2]
                trail.append((choice, choices))
                return True
            if tried > packing.nodes:
                break
        return False

    def finish(steps: list[tuple[Filling, int]], rest: list[tuple[Filling, int]]) -> None:
        nonlocal best, best_bins
        found = _bins(steps) + _bins(rest)
        if found < best_bins:
            best_bins, best = found, [*steps, *rest]

    while best_bins > bound:
        while stock.lengths:
            if hope() < 0 or not take(stock.completions(packing, hope)):
                break
        else:
            steps = [(f, n) for (f, n, _), _ in trail]
            finish(steps, [])
            if not descended:
                left = dict(histogram)
                gap = -(-len(steps) // packing.starts)
                for i, (filling, times) in enumerate(steps):
                    for size, n in filling:
                        left[size] -= n * times
                    if i % gap == gap - 1 and best_bins > bound:
                        finish(steps[: i + 1], best_fit({size: n for size, n in left.items() if n}, packing.length))
                sizes = sorted(histogram)
                for cut in sorted({sizes[i * len(sizes) // packing.splits] for i in range(1, packing.splits)}):
                    if best_bins == bound:
                        break
                    low, high = ({k: n for k, n in histogram.items() if (k > cut) == above} for above in (False, True))
                    finish(*[min(best_fit(part, packing.length), first_descent(part, packing), key=_bins) for part in (low, high)])
        descended = True
        if best_bins == bound or tried > packing.nodes:
            break
        while trail:
            (filling, times, w), choices = trail.pop()
            stock.use(filling, -times)
            bins, waste = bins - times, waste - times * w
            if take(choices):
                break
        if not trail:
            break
    return best


def _places(plan: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, pieces in a sequence, first sequence, first offset) for each use of a length."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for size, n in filling:
            rank = used.get(size, 0)
            rows.append((size, rank, rank + n * times, n, sequence, offset))
            used[size] = rank + n * times
            offset += n * size
        sequence += times
    return rows


def packed(cut: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """The rows of ``cut`` (doc_id, piece, start, length, …), whose table must not change, with ``sequence_id`` and ``offset``.

    Pieces of one length are ranked by parts, so that a length which very many pieces have
    is not ordered in one task.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per length
    rows = _places(complete_bins(histogram, packing))
    plan = spark.createDataFrame(rows, "length long, low long, high long, each long, first_sequence long, first_offset long")
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(packing.rank_parts))
    keyed = cut.withColumn("_part", part)
    sums = keyed.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_inside", F.row_number().over(inside) - 1).join(sums, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_inside"))
    # The uses of a length are looked up by small blocks of ranks, so a rank meets few of them.
    block = lambda rank: F.floor(rank / F.lit(packing.rank_block))
    plan = plan.withColumn("_block", F.explode(F.sequence(block(F.col("low")), block(F.col("high") - 1))))
    placed = ranked.withColumn("_block", block(F.col("_rank"))).join(plan, ["length", "_block"]).where("_rank >= low and _rank < high")
    return placed.select(
        *cut.columns,
        (F.col("first_sequence") + F.floor((F.col("_rank") - F.col("low")) / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (F.col("_rank") - F.col("low")) % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, packing: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its place: ``sequence_id`` and ``offset``, gapless from 0."""
    cut = written(pieces(docs, tokenizer, packing, with_ids), "pieces")
    return packed(cut, packing)
